"""Operator 12 against tokenizers and sentencepiece themselves, token by token, in plain Python."""

import hashlib
from bisect import bisect_left
from collections import Counter

import numpy as np
import pytest

from provisio.llm import token_alignment as ta
from provisio.llm.queries import tokenizer_path

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


def brute(rows):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer, decoders

    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    alphabet = {chr(i if 33 <= i < 127 or 161 <= i < 173 or 174 <= i else 0): i for i in range(256)}
    alphabet = {c: i for c, i in alphabet.items() if c != "\0"}
    for n, i in enumerate([i for i in range(256) if chr(i) not in alphabet]):
        alphabet[chr(256 + n)] = i

    def piece(p):
        return bytes([int(p[3:5], 16)]) if len(p) == 6 and p[:3] == "<0x" else p.replace("▁", " ").encode()

    out, links, holders = [], [], Counter()
    for i, text in rows:
        want = (" " + (text or "")).encode()
        ta_ = [(t, bytes(alphabet[c] for c in a.id_to_token(t))) for t in a.encode(" " + text, add_special_tokens=False).ids] if text else []
        tb_ = [(t, piece(b.id_to_piece(t))) for t in b.encode(text)] if text else []
        if not text or b"".join(x for _, x in ta_) != want or b"".join(x for _, x in tb_) != want:
            ta_, tb_ = [], []
        spans = []
        for tokens in (ta_, tb_):
            at, own = 0, []
            for t, x in tokens:
                own.append((at, at + len(x), t))
                at += len(x)
            spans.append(own)
        cuts = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        held = [([], []) for _ in cuts]
        for k, own in enumerate(spans):
            for _, e, t in own:
                held[bisect_left(cuts, e)][k].append(str(t))
        groups = ["|".join(map(",".join, g)) for g in held]
        own = [(x, y) for s, e, x in spans[0] for s2, e2, y in spans[1] if s < e2 and s2 < e] if len(want) < 3000 else sweep(*spans)
        links.append(own)
        holders.update(set(own))
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if ta_ else ""
        out.append([-1 if i is None else i, len(ta_), len(tb_), len(groups), len(own), digest])
    top = {}
    for (x, _), n in holders.items():
        top[x] = max(top.get(x, 0), n)
    return sorted(tuple(r[:5] + [sum(holders[k] == top[k[0]] for k in own), sum(holders[k] for k in own), r[5]]) for r, own in zip(out, links))


def sweep(a, b):
    out, j = [], 0
    for s, e, x in a:
        while j and b[j - 1][1] > s:
            j -= 1
        while j < len(b) and b[j][0] < e:
            if b[j][1] > s:
                out.append((x, b[j][2]))
            j += 1
    return out


def rows_of(df):
    return sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups_sha256"])
                  for r in df.collect())


@pytest.mark.parametrize("chars", [ta.SLICE_CHARS, 5000])
def test_equals_brute_force(spark, sf_docs, chars):
    docs = sf_docs.where("n_chars < 4000").repartition(3)
    assert rows_of(ta.alignment(docs, A, B, chars)) == brute([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])


def test_edges(spark, edge_docs):
    from pyspark.sql import functions as F

    odd = ["</s> <s> <|endoftext|>", "▁x", "a ▁ b", "\x00a\r\n\t", "𝔘ñ́ 😀", " " * 3000 + "x", "\n" * 2500, "é", "  lead", "trail  "]
    more = spark.createDataFrame([(100 + k, t) for k, t in enumerate(odd)], "doc_id long, text string")
    docs = edge_docs.unionByName(more, allowMissingColumns=True)
    got = rows_of(ta.alignment(docs, A, B))
    assert got == brute([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    zero = {r[0] for r in got if r[7] == ""}
    assert {1, 2, 101, 102} <= zero and all(r[1:7] == (0,) * 6 for r in got if r[7] == "")
    assert ta.alignment(docs.limit(0), A, B).count() == 0
    assert {r[7] for r in rows_of(ta.alignment(docs.select("doc_id", F.lit(None).cast("string").alias("text")), A, B))} == {""}


def test_coalescing():
    start, end, kind = np.array([0, 2, 5, 0, 3, 5]), np.array([2, 5, 6, 3, 5, 6]), np.array([0, 0, 0, 1, 1, 1])
    assert ta.groups(start, end, kind).tolist() == [0, 0, 1, 0, 0, 1]


def test_a_file_that_is_not_in_rank_order_is_read_by_its_own_library():
    own = ta.ByteLevel(A)
    parts = ["Hello wörld 12345  \n\n it's", "<|endoftext|>", "x" * 3000]
    fast = own.ids(parts)
    own.fast = None
    assert own.ids(parts) == fast
