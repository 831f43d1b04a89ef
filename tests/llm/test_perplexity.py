"""Operator 13 against a plain Python model: modified Kneser-Ney over dictionaries, one occurrence left out at a time."""

import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from provisio.llm import perplexity as px


def brute_base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    seen, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


class Brute:
    """Counts of all orders from the highest one's; every probability from whole tables, with one occurrence taken away first."""

    def __init__(self, texts, order):
        self.order = order
        top = Counter(g for t in texts for g in self.grams(t))
        self.counts = {order: top}
        for k in range(order - 1, 0, -1):
            self.counts[k] = Counter(g[1:] for g in self.counts[k + 1])
        self.d = {}
        for k, c in self.counts.items():
            n = Counter(c.values())
            if n[1] and n[2] and n[3] and n[4]:
                y = n[1] / (n[1] + 2 * n[2])
                own = [1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3]]
                self.d[k] = [min(max(x, 0), j) for j, x in enumerate(own, 1)]
            else:
                self.d[k] = [0.5, 1.0, 1.5]
        self.by_context = {k: defaultdict(dict) for k in self.counts}
        for k, c in self.counts.items():
            for g, n in c.items():
                self.by_context[k][g[:-1]][g] = n

    def grams(self, text):
        b = b" " * (self.order - 1) + b" ".join((text or "").encode().split())
        return [b[i:i + self.order] for i in range(len(b) - self.order + 1)]

    def p(self, g, less):
        """The probability of an n-gram's last byte, with ``less`` (0 or 1) of it taken out."""
        k = len(g)
        if not k:
            return 1 / 256
        mine = dict(self.by_context[k][g[:-1]])
        lower = less and mine[g] == 1
        mine[g] -= less
        total, d = sum(mine.values()), self.d[k]
        below = self.p(g[1:], 1 if lower else 0)
        if not total:
            return below
        own = lambda n: 0 if n <= 0 else d[min(n, 3) - 1]
        return (mine[g] - own(mine[g])) / total + sum(map(own, mine.values())) / total * below

    def perplexity(self, text):
        grams = self.grams(text)
        return 2 ** (-sum(math.log2(max(1e-12, self.p(g, 1))) for g in grams) / len(grams)) if grams else None


def check(docs, **how):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    brute = Brute([t for _, t in rows], px.ORDER)
    want = sorted(((-1 if i is None else i), *brute_base(t), brute.perplexity(t) or 0) for i, t in rows)
    got = sorted(((-1 if r["doc_id"] is None else r["doc_id"]), *(r[c] for c in px._COUNTS), r["perplexity"] or 0) for r in px.scores(docs, **how).collect())
    assert [g[:6] for g in got] == [w[:6] for w in want]
    assert all(g[6] == pytest.approx(w[6], rel=2e-3) for g, w in zip(got, want))


def test_model_equals_brute_force(spark, sf_docs):
    check(sf_docs.where("n_chars < 1500 and doc_id < 120"))


def test_small_blocks_and_edges(spark, edge_docs):
    check(px.stored(edge_docs.where("doc_id is null or doc_id != 9"), "edges"), block_bytes=3000)
    assert px.quality(edge_docs.limit(0)).count() == 0
    none = px.quality(edge_docs.withColumn("text", F.lit(None).cast("string"))).collect()
    assert len(none) == edge_docs.count() and all(r["base_failed"] and not r["kept"] and r["perplexity"] is None for r in none)


def test_long_texts_and_columns(spark, edge_docs):
    got = {r["doc_id"]: r for r in px.quality(edge_docs).where("doc_id is not null").collect()}
    assert got[9]["n_words"] == 60_000 and not got[9]["base_failed"]
    assert got[3]["n_words"] == 0 and got[3]["base_failed"] and got[13]["base_failed"]        # the latter repeats its line


def test_gibberish_and_repetition_are_rejected_and_clean_text_is_kept(spark, sf_docs):
    clean = sf_docs.where("lang = 'en' and n_chars > 300").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(-1, " ".join(f"zq{i * 7919 % 9973:x}kx%{i}" for i in range(80)), "en"), (-2, " ".join(f"{i}" * 9 for i in range(100, 160)), "en")], clean.schema)
    got = {r["doc_id"]: r for r in px.quality(px.stored(clean.unionAll(odd), "odd")).collect()}
    assert not got[-1]["kept"] and not got[-2]["kept"]
    judged = [r for i, r in got.items() if i >= 0 and not r["base_failed"]]
    assert sum(r["kept"] for r in judged) >= 0.95 * len(judged)
