"""Operator 11 against plain Python: edits enumerated, and the index against the text itself."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from provisio.llm import spelling as sp


def is_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def cuts(w):
    return {w[:i] + w[i + 1:] for i in range(len(w))}


def brute(rows, every=31):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            if len(run) >= 7:
                counts[run] += 1
    n = {w: c for w, c in counts.items() if c >= 2}
    by = {}
    for w in n:
        for v in cuts(w) | {w}:
            by.setdefault(v, []).append(w)
    near = {w: {x for v in cuts(w) | {w} for x in by[v] if is_near(w, x)} for w in n}
    form = {}
    for w in n:
        if near[w]:
            best = min(near[w], key=lambda x: (-n[x], x))
            if n[best] >= 10 * n[w]:
                form[w] = best
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return out


def got(docs, **how):
    rows = [tuple(r) for r in sp.variants(docs, **how).select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("shard", [sp.SHARD_WORDS, 300, 7])
def test_equals_brute_force_in_one_shard_in_many_and_with_split_groups(spark, sf_docs, shard):
    docs = sf_docs.where("doc_id < 40" if shard == 7 else "true")
    assert got(docs, shard_words=shard) == brute([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])


def test_edges(spark, edge_docs):
    more = [(21, "abcdefgh " * 30 + "abcdefg abcdefg abbcdefgh abbcdefgh Abcdefgx abcdefgx xabcdefgh xabcdefgh ÀÀàààààà àààààààà àààààààà"),
            (22, "aaaaaaa " * 200 + "aaaaaaaa " * 20 + "aaaaaaab aaaaaaab aaaaaaaaa aaaaaaaaa ba aaaabaa aaaabaa baaaaaa baaaaaa a×b÷cdeÿ a×b÷cdeÿ a×b÷cdeÞ a×b÷cdeÞ"),
            (23, "short one\nwörterbücher wörterbücher wörterbucher wörterbucher " + "y" * 4000 + " " + "y" * 4000)]
    docs = edge_docs.unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    for every in (31, 1_000_003, 2):
        assert got(docs, delete_every=every) == brute(rows, every)
    assert sp.variants(docs.limit(0)).count() == 0
    assert sp.variants(docs.where("text is null")).count() == 0


def test_chains_are_followed_to_their_last_form(spark):
    chain = ["aaaaaaa", "aaaaaab", "aaaaabb", "aaaabbb"]
    docs = spark.createDataFrame([(1, " ".join(f"{w} " * (2 * 10 ** k) for k, w in enumerate(chain)))], "doc_id long, text string")
    roots = {r[0]: (r[1], r[2]) for r in got(docs, delete_every=1_000_003)}
    assert roots == {"aaaaaaa": ("aaaaaab", "aaaabbb"), "aaaaaab": ("aaaaabb", "aaaabbb"), "aaaaabb": ("aaaabbb", "aaaabbb"), "aaaabbb": (None, "aaaabbb")}


def test_bidirectional_index_counts_and_stays_synchronised():
    own = random.Random(3)
    words = sorted({"".join(own.choice("abc") for _ in range(own.randint(3, 6))) for _ in range(200)})
    index = sp.BiIndex([np.array([ord(c) - 96 for c in w]) for w in words], 3)
    text = "".join("$" + w for w in words)
    ring = text + text
    for _ in range(60):
        pattern, state = "", index.whole(1)
        for _ in range(own.randint(1, 7)):
            c, right = own.choice("abc$"), own.randint(0, 1)
            pattern = pattern + c if right else c + pattern
            state = index.extend(right, np.array([0 if c == "$" else ord(c) - 96]), state)
            starts = [i for i in range(len(text)) if ring.startswith(pattern, i)]
            assert state[2][0] == len(starts)
            if not starts:
                break
            smaller = sum(ring[i:i + len(text)] < min(ring[j:j + len(text)] for j in starts) for i in range(len(text)))
            assert state[0][0] == smaller
