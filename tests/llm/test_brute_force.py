"""Results without SQL: brute force, recall and held-out accuracy on the small tables."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from provisio.llm import lines
from provisio.llm.queries import QUERIES, tokenizer_path

SF = "/root/testdata/sf0.001"


class Forest:
    def __init__(self):
        self.up = {}

    def root(self, x):
        while self.up.get(x, x) != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def line_shingles(line):
    """Runs of 5 characters at every position; a shorter line is one."""
    return {line[i:i + 5] for i in range(max(1, len(line) - 4))}


def brute_lines(rows, similarity=0.75):
    """(doc, kept text): rows by id; the first line of every component stays."""
    places, index = {}, {}
    for doc, text in rows:
        for at, raw in enumerate((text or "").split("\n")):
            norm = raw.strip(" \t\r\x0b\x0c").lower()
            if norm:
                places.setdefault(norm, []).append((doc, at))
    sets = {x: line_shingles(x) for x in places}
    for x, s in sets.items():
        for g in s:
            index.setdefault(g, []).append(x)
    forest, near = Forest(), 0
    for x, s in sets.items():
        for y in {y for g in s for y in index[g] if y < x}:
            both = len(s & sets[y])
            if both >= similarity * (len(s) + len(sets[y]) - both):
                forest.join(x, y)
                near += 1
    first = {}
    for x, p in places.items():
        r = forest.root(x)
        first[r] = min(first.get(r, p[0]), min(p))
    gone = {q for x, p in places.items() for q in p if q != first[forest.root(x)]}
    return {doc: "\n".join(raw for at, raw in enumerate(text.split("\n")) if (doc, at) not in gone) if text is not None else None
            for doc, text in rows}, near


def test_line_dedup_equals_brute_force(sf_docs):
    rows = sorted((r["doc_id"], r["text"]) for r in sf_docs.select("doc_id", "text").collect())
    want, _ = brute_lines(rows)
    got = {r["doc_id"]: r["text"] for r in lines.dedup_lines(sf_docs).select("doc_id", "text").collect()}
    differing = [d for d in want if got[d] != want[d]]
    assert len(differing) <= 0.01 * len(want)


def test_line_bands_have_high_recall(spark):
    """Edited copies of long lines, at similarities from 0.75 up: nearly all join their original."""
    r = np.random.default_rng(5)
    rows, n = [], 200
    for k in range(n):
        words = [f"w{r.integers(0, 10 ** 6)}" for _ in range(60)]
        rows.append((2 * k, " ".join(words)))
        for at in r.choice(60, int(r.integers(1, 3)), replace=False):
            words[at] = f"z{r.integers(0, 10 ** 6)}"
        rows.append((2 * k + 1, " ".join(words)))
    sim = [len(a & b) / len(a | b) for a, b in zip(*([line_shingles(t) for _, t in rows[i::2]] for i in (0, 1)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x["doc_id"]: x["text"] for x in lines.dedup_lines(docs).collect()}
    near = [k for k in range(n) if sim[k] >= 0.75]
    assert len(near) > 100 and sum(got[2 * k + 1] == "" for k in near) >= 0.97 * len(near)
    assert all(got[2 * k + 1] for k in range(n) if sim[k] < 0.75) and all(got[2 * k] for k in range(n))


def test_large_group_of_near_lines_is_one_component(spark):
    base = [f"word{i}" for i in range(50)]
    rows = [(k, " ".join(w if i != k % 50 else f"x{k}" for i, w in enumerate(base))) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want, _ = brute_lines(rows)
    assert {x["doc_id"]: x["text"] for x in lines.dedup_lines(docs).collect()} == want


def test_embedding_recall_against_brute_force(spark):
    """Planted groups of near vectors among random ones: every link found is right, and nearly all are found."""
    r = np.random.default_rng(2)
    base = r.normal(size=(1500, 32))
    near = [base[k] + r.normal(size=(int(r.integers(1, 30)), 32)) * 0.18 for k in range(60)]
    x = np.concatenate([base, *near])
    label = r.integers(0, 2, len(x))
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    links = (u @ u.T >= 0.93) & (label[:, None] == label[None])
    np.fill_diagonal(links, False)
    df = spark.createDataFrame([(int(i), v.tolist(), int(c)) for i, (v, c) in enumerate(zip(x, label))], "vec_id long, embedding array<double>, label int")
    from provisio.llm.embeddings import near_duplicates

    got = near_duplicates(df).toPandas().set_index("vec_id").sort_index()
    want = links.sum(axis=1)
    assert (got.n_links.to_numpy() <= want).all() and got.n_links.sum() >= 0.95 * want.sum() > 0
    forest = Forest()
    for a, b in zip(*np.nonzero(np.triu(links))):
        forest.join(int(a), int(b))
    assert (got.component_id.to_numpy() == [forest.root(i) for i in range(len(x))]).mean() >= 0.98
    assert (got.kept == (got.component_id == got.index)).all()


def test_held_out_accuracy(spark):
    lang = QUERIES["op3_language_id"](spark, SF).where("held_out").join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    right, n = lang.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count(F.lit(1))).first()
    assert n > 20 and right >= 0.95
    toxic = QUERIES["op2_toxicity"](spark, "/root/testdata/sf0.1").where("held_out").join(
        spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "toxic"), "doc_id").select("toxic", "score").toPandas()
    pos, neg = (toxic.score[toxic.toxic == c].to_numpy() for c in (1, 0))
    assert (pos[:, None] > neg[None]).mean() >= 0.95 and (pos >= 0.5).mean() >= 0.85 and (neg >= 0.5).mean() <= 0.01


def test_pipeline_against_plain_python(spark, sf_docs):
    """Each stage's rows, judged on its own input."""
    from provisio.llm.common import stored

    docs, seen = sf_docs, {}
    items = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", r["text"].lower()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    windows = {tuple(w[i:i + 10]) for w in items for i in range(max(1, len(w) - 9))}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stored(stage(spark, docs, SF), "test_stage")
        assert out.columns == sf_docs.columns
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        after = {r["doc_id"]: r["text"] for r in out.collect()}
        assert len(after) == out.count() and set(after) <= set(before)
        seen[name] = len(before) - len(after)
        if name == "language_id":
            assert all(re.search(r"[^\W\d_]", t) for t in after.values()) and seen[name] <= 0.02 * len(before)
        elif name == "line_dedup":
            want, _ = brute_lines(sorted(before.items()))
            assert set(after) == set(before) and sum(after[d] != want[d] for d in want) <= 0.01 * len(want)
            assert all(r["n_chars"] == len(r["text"]) for r in out.collect())
        elif name == "jaccard_join":
            sets = {}
            for d, t in before.items():
                w = re.findall(r"[^ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
                sets[d] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
            forest = Forest()
            for a in sets:
                for b in sets:
                    if a < b and sets[a] and sets[b]:
                        both = len(sets[a] & sets[b])
                        if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                            forest.join(a, b)
            assert set(after) == {d for d in before if forest.root(d) == d}
        else:
            words = {d: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)) for d, t in before.items()}
            hit = {d for d, w in words.items() if any(tuple(w[i:i + n]) in windows for n in {len(x) for x in windows} for i in range(len(w) - n + 1))}
            assert set(after) == set(before) - hit
        docs = out
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0] <= 4096


def test_tokenizer_equals_the_library():
    from tokenizers import Tokenizer

    from provisio.llm.word_bpe import WordBpe

    slow, fast = Tokenizer.from_file(tokenizer_path()), WordBpe(tokenizer_path(), max_cached=50)
    texts = ["don't I'LL it'sx 'S", "abc<|endoftext|>def  <|startoftext|>", "ΑΣ ΣΑΣ é é \x1c\x1da 12a3 　x\xa0y", "ĐŐ İstanbul ß ẞ ª²½ × ÷",
             "a\x00b \x01 c\x01", "\t\n  ", "emoji 😀a👩‍👩‍👧", "", None, "schßen enßheit GROẞ ŒUVRE œ"]
    assert fast.fast is not None
    for t, raw in zip(texts * 2, fast.ids(texts * 2, chars=20)):
        assert np.frombuffer(raw, "<u4").tolist() == slow.encode(t or "", add_special_tokens=False).ids
