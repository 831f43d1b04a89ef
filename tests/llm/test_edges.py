"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns, operator by operator."""

import hashlib
import zlib

import numpy as np
import pytest

from provisio.llm import chat_tree, decontaminate, embeddings, jaccard, language_id, licenses, lines, packing, substrings, toxicity
from provisio.llm.queries import tokenizer_path


def by_id(df, *cols):
    return sorted(map(tuple, df.select(*cols).toPandas().astype(object).where(lambda x: x.notna(), None).to_numpy().tolist()), key=repr)


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_decontaminate_edges(spark, edge_docs):
    items = bench(spark, [(1, "ONE"), (2, None), (3, ""), (4, " ".join(f"alpha{i} beta{i}" for i in range(7))), (5, "one"), (None, "b c"), (6, "--")])
    got = {(r["doc_id"], r["n_words"]): r for r in decontaminate.report(edge_docs, items).collect()}
    assert len(decontaminate.report(edge_docs, items).collect()) == edge_docs.count()
    assert sorted(got[4, 1]["items"]) == [1, 5] and got[5, 1]["n_hit"] == 1       # a short item is one window
    assert got[6, 80]["n_hit"] == 14 and list(got[6, 80]["items"]) == [4]          # 5 windows of 10 words cover 14
    assert got[None, 80]["n_hit"] == 14 and got[1, 0]["n_hit"] == 0 and got[11, 4]["n_hit"] == 0
    kept = decontaminate.remove(edge_docs, items, "documents")
    assert kept.columns == edge_docs.columns and {r["doc_id"] for r in kept.select("doc_id").collect()} == {1, 2, 3, 9, 10, 11, 12, 13, 14, 15, None}
    cut = {r["doc_id"]: r["text"] for r in decontaminate.remove(edge_docs, items, "spans").collect()}
    assert cut[4] == "" and cut[6].startswith("alpha7 beta7 ") and cut[1] is None and cut[11] == "a b c d"


def test_decontaminate_in_parts_and_empty(spark, edge_docs):
    items = bench(spark, [(i, " ".join(f"alpha{j} beta{j}" for j in range(i, i + 7))) for i in range(20)])
    whole = by_id(decontaminate.report(edge_docs, items), "doc_id", "n_words", "n_hit")
    parts = by_id(decontaminate.report(edge_docs, items, max_windows=7), "doc_id", "n_words", "n_hit")
    assert whole == parts
    none = decontaminate.report(edge_docs, bench(spark, []))
    assert none.where("contaminated").count() == 0 and none.count() == edge_docs.count()
    assert decontaminate.report(edge_docs.limit(0), items).count() == 0


def test_classifiers_edges(spark, edge_docs):
    labels = spark.createDataFrame([(6, 1), (4, 0), (4, 1), (None, 1), (99, 1)], "doc_id long, toxic int")
    got = toxicity.toxicity(edge_docs, labels).collect()
    assert len(got) == edge_docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    none = toxicity.toxicity(edge_docs, labels.limit(0)).collect()
    assert all(r["score"] < 1e-9 for r in none)
    assert toxicity.toxicity(edge_docs.limit(0), labels).count() == 0
    found = language_id.language_id(edge_docs).collect()
    assert len(found) == edge_docs.count()
    for r in found:
        assert (r["lang_pred"] == "und") == (r["doc_id"] in (1, 2, 3, 10) or (r["doc_id"] is None and r["score"] == 0))
    assert {r["lang_pred"] for r in language_id.language_id(edge_docs.withColumn("lang", edge_docs.lang.substr(9, 0)).drop("lang").withColumn(
        "lang", edge_docs.source.substr(1, 0)).where("false")).collect()} == set()


def test_chat_edges(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "a\\<s>b </s>[INST] x"), (2, 0, "user", "hi"), (2, 1, "assistant", None), (2, 1, "assistant", None),
            (3, None, None, None), (4, 0, "user", "hi"), (4, 1, "assistant", "a\\<s>b </s>[INST] x"), (None, 0, "assistant", "<|turn|><|end|>\\\\"),
            *[(5, k, "assistant" if k % 2 else "user", f"t{k} é😀") for k in range(300)]]
    conv = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, node string")
    path = tokenizer_path("byte_bpe_50k.tiktoken")
    nodes, whole = chat_tree.tree(conv, path)
    got = {r["conv_id"]: r for r in chat_tree.read_back(nodes, whole, path).collect()}
    assert len(got) == 6
    for c in got:
        turns = sorted(((t if t is not None else -1, r or "", x or "") for i, t, r, x in rows if i == c))
        assert got[c]["n_turns"] == len(turns)
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    # Shared turns are emitted once; the stream is gapless and depth-first: ancestors come before, positions follow them.
    n = sorted(nodes.collect(), key=lambda r: r["start"])
    assert n[0]["start"] == 0 and all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(n, n[1:]))
    assert all(r["position"] == sum(s["length"] for s in r["ancestors"]) and all(s["start"] + s["length"] <= r["start"] for s in r["ancestors"]) for r in n)
    assert sum(1 for r in n if r["parent"] is None) == 4          # "hi", conversations 3, null and 5
    empty_nodes, empty = chat_tree.tree(conv.limit(0), path)
    assert chat_tree.read_back(empty_nodes, empty, path).count() == 0


@pytest.mark.parametrize("text", ["", "\\", "\\\\<s>", "<<s>", "<s", "<\\s>", "a</s>[INST][/INST]<<SYS>>", "[[INST]", "<|end|>" * 3])
def test_escaping_is_reversible(text):
    out = chat_tree.escaped(text)
    assert chat_tree.unescaped(out) == text and not any(c in out for c in chat_tree.CONTROL)


def brute_windows(texts, n):
    words = [(t or "").encode().split() for t in texts]
    seen: dict = {}
    for w in words:
        for i in range(len(w) - n + 1):
            seen[tuple(w[i:i + n])] = seen.get(tuple(w[i:i + n]), 0) + 1
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - n + 1):
            if seen[tuple(w[i:i + n])] > 1:
                gone.update(range(i, i + n))
        out.append((len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return out


def test_substrings_edges(spark, edge_docs):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.select("doc_id", "text").collect()]
    for n in (35, 3):
        want = sorted((i, *b) for (i, _), b in zip([(-1 if i is None else i, t) for i, t in rows], brute_windows([t for _, t in rows], n)))
        got = sorted((-1 if r[0] is None else r[0], r[1], r[2], r[3] or "") for r in substrings.dedup(edge_docs, n).collect())
        assert got == want
    assert substrings.dedup(edge_docs.limit(0)).count() == 0


def test_jaccard_edges(spark, edge_docs):
    got = by_id(jaccard.similar(edge_docs), "doc_id", "n_shingles", "component_id")
    assert len(got) == edge_docs.count()
    comp = {(a, n): c for a, n, c in got}
    assert comp[4, 1] == 4 and comp[5, 1] == 4                    # A-Z lower-cased; a short text is one shingle
    assert comp[7, 76] == 6 and comp[8, 81] == 6 and comp[None, 76] == 6
    assert comp[12, 1] == 11 and comp[1, 0] == 1 and comp[2, 0] == 2 and comp[3, 0] == 3 and comp[None, 0] is None
    assert jaccard.similar(edge_docs.limit(0)).count() == 0


def test_jaccard_large_group_of_near_copies(spark):
    """Near copies of two texts, and texts between them: equal to brute force."""
    r = np.random.default_rng(3)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for k in range(150):
        t = list(base)
        for at in r.integers(0, 120, int(r.integers(0, 6))):
            t[at] = f"z{r.integers(0, 40)}"
        texts.append(t + [f"u{k}"] * int(r.integers(0, 2)) + ([f"v{i}" for i in range(int(r.integers(0, 60)))] if k % 5 == 0 else []))
    sets = [{tuple(t[i:i + 5]) for i in range(len(t) - 4)} for t in texts]
    up = list(range(len(sets)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            inter = len(sets[i] & sets[j])
            if 100 * inter >= 75 * (len(sets[i]) + len(sets[j]) - inter):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in jaccard.similar(docs).collect()}
    assert got == {i: (len(s), root(i)) for i, s in enumerate(sets)}


def test_packing_edges(spark, edge_docs):
    from tokenizers import Tokenizer

    path = tokenizer_path()
    slow = Tokenizer.from_file(path)
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.select("doc_id", "text").collect()]
    want = []
    for doc, t in rows:
        ids = slow.encode(t or "", add_special_tokens=False).ids + [1]
        for k, at in enumerate(range(0, len(ids), 4096)):
            want.append((doc if doc is not None else -1, k, at, len(ids[at:at + 4096]), zlib.crc32(np.array(ids[at:at + 4096], "<u4").tobytes())))
    got = packing.best_fit_packing(edge_docs, path).toPandas()
    assert sorted(map(tuple, got[["doc_id", "piece", "start", "length", "ids_crc32"]].fillna(-1).astype("int64").to_numpy().tolist())) == sorted(want)
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert s.offset.tolist() == [0, *s.length.cumsum().tolist()[:-1]] and s.length.sum() <= 4096
    assert packing.best_fit_packing(edge_docs.limit(0), path).count() == 0


def test_plan_uses_everything_once_and_fills_exactly():
    r = np.random.default_rng(1)
    for _ in range(20):
        counts = {int(k): int(v) for k, v in zip(r.integers(1, 65, 30), r.integers(1, 9, 30))}
        used: dict = {}
        for combo, times in packing.plan(counts, 64):
            assert sum(x * c for x, c in combo) <= 64 and times > 0
            for x, c in combo:
                used[x] = used.get(x, 0) + times * c
        assert used == counts
    assert sorted(packing.plan({40: 5, 24: 3, 10: 2, 14: 2}, 64)) == [(((40, 1), (10, 1), (14, 1)), 2), (((40, 1), (24, 1)), 3)]


def test_many_tiny_pieces_are_planned_at_once():
    counts = {1: 1_000_000, 2: 30_000, 700: 11, 4000: 3, 4096: 5}
    made = packing.plan(counts)
    assert len(made) < 40
    sequences = sum(t for _, t in made)
    assert sequences == -(-sum(k * v for k, v in counts.items()) // 4096)
    for x, rows in packing.slots(made).items():
        assert rows[0][0] == 0


def test_tiny_pieces_are_placed_once(spark):
    docs = spark.createDataFrame([(k, "" if k % 3 else "word " * (k % 50)) for k in range(6000)], "doc_id long, text string")
    got = packing.best_fit_packing(docs, tokenizer_path(), capacity=64).toPandas()
    assert got.sequence_id.nunique() <= -(-got.length.sum() // 64) + 1
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert s.offset.tolist() == [0, *s.length.cumsum().tolist()[:-1]] and s.length.sum() <= 64


def test_embeddings_edges(spark):
    v, w = [1.0, 0.0, 0.0], [0.99, 0.05, 0.0]
    rows = [(1, v, 0), (2, v, 0), (3, w, 0), (4, v, 1), (5, None, 0), (6, [0.0, 0.0, 0.0], 0), (7, [float("nan"), 1.0, 0.0], 0), (8, v, None), (9, [0.0, 1.0, 0.0], 0),
            (10, [1.0, None, 0.0], 0), (11, [], 0), (12, [2.0, 0.0], 0), (None, v, 1), (13, [float("inf"), 0.0, 0.0], 0), (9, [0.0, 1.0, 0.0], 0), (14, [-0.0, 2.0, 0.0], 0)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "vec_id long, embedding array<float>, label int, id string")
    got = by_id(embeddings.near_duplicates(df), "vec_id", "n_links", "component_id", "kept")
    want = [(1, 2, 1, True), (2, 2, 1, False), (3, 2, 1, False), (4, 1, 4, True), (None, 1, 4, False), (9, 2, 9, True), (9, 2, 9, True), (14, 2, 9, False)]
    want += [(i, 0, i, True) for i in (5, 6, 7, 8, 10, 11, 12, 13)]
    assert got == sorted(want, key=repr)
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


def test_lines_edges(spark, edge_docs):
    out = lines.dedup_lines(edge_docs)
    assert out.columns == edge_docs.columns
    got = by_id(out, "doc_id", "text")
    assert len(got) == edge_docs.count()
    text = dict(got)
    assert text[15] == "first line here\nsecond line there" and text[1] is None and text[3] == " \t\n \n" and text[4] == "one" and text[5] == ""
    assert [t for i, t in got if i == 7] == ["", ""] and text[12] == "" and text[11] == "a b c d"
    assert lines.dedup_lines(edge_docs.limit(0)).count() == 0


def test_licenses_edges(spark, edge_docs):
    assert licenses.license_scan(edge_docs).count() == 0
    rows = [(1, "x " * 50 + "released under the mit license" + " y" * 50), (2, licenses.TEMPLATES["mit-permission"]), (None, "Released under the MIT License."), (3, None)]
    rows += [(4, " ".join(licenses.TEMPLATES["gpl-3.0-header"].split()[:-15]) + " tail"), (5, "released under the apache license")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, at string")
    rows_ = licenses.license_scan(df).collect()
    best = {}
    for r in rows_:       # the best of each document: versions and wordings of one license share most of their words
        best[r["doc_id"]] = max(best.get(r["doc_id"], (0, "")), (r["containment"], r["license"]))
    assert best == {1: (1.0, "mit-notice"), 2: (1.0, "mit-permission"), None: (1.0, "mit-notice"), 4: (1.0, "gpl-notice-terms")}
    assert {r["license"] for r in rows_ if r["doc_id"] == 4} == {"gpl-notice-terms", "agpl-3.0-header", "gpl-3.0-header"}
    assert licenses.license_scan(df.limit(0)).count() == 0 and licenses.license_scan(df, {}).count() == 0


@pytest.mark.parametrize("text,license", [
    ("This project is licensed under the MIT License, see LICENSE.", "mit-notice-licensed"), ("It is distributed under the MIT license", "mit-notice-distributed"),
    ("Copyright. Licensed under an MIT license", "mit-notice-an"), ("code released under the GNU General Public License", "gpl-notice-released"),
    ("the work is licensed under CC BY-SA 4.0 and not sold", "cc-by-sa-4.0-notice-short"),
    ("To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work", "cc0-1.0-notice")])
def test_license_wordings(spark, text, license):
    df = spark.createDataFrame([(1, "some words before. " + text + " and some words after")], "doc_id long, text string")
    assert license in {r["license"] for r in licenses.license_scan(df).collect()}


def test_every_template_is_found_in_a_text_of_its_own(spark):
    names = sorted(licenses.TEMPLATES)
    df = spark.createDataFrame([(k, "w1 w2 w3 w4 " * 30 + licenses.TEMPLATES[n] + " v1 v2 v3 v4" * 30) for k, n in enumerate(names)], "doc_id long, text string")
    got = {(r["doc_id"], r["license"]) for r in licenses.license_scan(df).where("containment = 1").collect()}
    assert {(k, n) for k, n in enumerate(names)} <= got
