"""Toxicity (operator 2): a character n-gram linear classifier whose features are scaled
by naive Bayes log-count ratios.

Features are the byte n-grams of 4 to 7 bytes of the whole text (A-Z lower-cased, white
space as blanks), hashed.  A feature's value is the logarithm of one plus its
occurrences per thousand bytes (smoothed for short texts), so a long clean text does not gather
score by its length.  ``train`` takes each feature's naive Bayes log-count ratio r, keeps all
features whose values differ significantly between the classes, and fits a logistic
regression on the values times r, by gradients that tasks add up over their documents.  Equal
texts of a class count once.  The sample it learns from is bounded by
``max_rows`` per class (taken in the order of a hash of the text, so it does not follow
the id or the source) and weighted back to the classes' shares.  ``score`` applies
the weights to every whole text.

A null or empty text has no features and gets the score of the intercept.  Without labels
of both classes the score is 1 if there are toxic labels alone, else 0.  A document
labelled more than once is toxic if any label says so.  Repeated rows are each scored,
a null id is kept (never held out), an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provisio.llm.common import slices, stored, texts, thinned

SIZES = (4, 5, 6, 7)
BITS = 22
MAX_ROWS = 3000
SHARD_BITS = 5
SHARDS = 1 << SHARD_BITS
STEPS, L2, PARTS = 60, 1e-3, 12   # of the fit; PARTS is the most vectors of weights a step sends to the driver
FOLDS = 5
PER, SMOOTH = 1000.0, 500.0   # a value's unit, and what short texts are lengthened by

_LOWER = bytes(c + 32 if 65 <= c <= 90 else 32 if c in (9, 10, 11, 12, 13) else c for c in range(256))


def fold(id_col: str = "doc_id"):
    """crc32 of the id as text, modulo 5; fold 0 is held out."""
    return F.crc32(F.col(id_col).cast("string")) % F.lit(FOLDS)


def hashed(text: str | None) -> list[np.ndarray]:
    """Hashed n-grams of a text, one array per size, one entry per position."""
    raw = (" " + (text or "") + " ").encode("utf-8", "surrogatepass").translate(_LOWER) if text else b""
    b = np.frombuffer(raw, dtype=np.uint8)
    out, word = [], b.astype(np.uint64)
    for n in range(2, SIZES[-1] + 1):
        if len(b) < n:
            break
        word = word[:len(b) - n + 1] | (b[n - 1:].astype(np.uint64) << np.uint64(8 * (n - 1)))
        if n in SIZES:
            mixed = (word + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            out.append((mixed >> np.uint64(64 - BITS)).astype(np.int64))
    return out


def values(counts: np.ndarray, positions: int) -> np.ndarray:
    return np.log1p(PER * counts / (positions + SMOOTH))


def features(text: str | None) -> tuple[np.ndarray, np.ndarray, int]:
    """(distinct features, their counts, positions) of a text."""
    got = hashed(text)
    if not got:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    return *np.unique(np.concatenate(got), return_counts=True), len(got[0])


def select(label: np.ndarray, flat: np.ndarray, count: np.ndarray, x: np.ndarray, n0: int,
           n1: int) -> tuple[np.ndarray, np.ndarray]:
    """The features whose values differ significantly between the classes, and the scale of each:
    its log-count ratio over its spread.  Arrays: one entry per document and feature."""
    kinds, flat = np.unique(flat, return_inverse=True)
    size, y = len(kinds), label == 1
    sums = [np.bincount(flat[s], weights=count[s], minlength=size) for s in (~y, y)]
    rate = [(c + 1.0) / (n + 2.0) for c, n in zip(sums, (n0, n1))]
    ratio = np.log(rate[1]) - np.log(rate[0])
    mean = [np.bincount(flat[s], weights=x[s], minlength=size) / n for s, n in ((~y, n0), (y, n1))]
    square = np.bincount(flat, weights=x * x, minlength=size) / (n0 + n1)
    spread = np.maximum(square - ((n0 * mean[0] + n1 * mean[1]) / (n0 + n1)) ** 2, 1e-6)
    z = np.abs(mean[1] - mean[0]) / np.sqrt(spread * (1 / n0 + 1 / n1))
    keep = np.flatnonzero(z > 6)
    return kinds[keep], ratio[keep] / np.sqrt(spread[keep])


def fit(slope, size: int, bias: float, steps: int = STEPS, memory: int = 10) -> tuple[np.ndarray, float]:
    """L-BFGS from zero weights and ``bias``; ``slope(w, bias)`` gives the loss and its gradients, without the penalty on w."""

    def at(p):
        loss, g, gb = slope(p[:-1], p[-1])
        return loss + 0.5 * L2 * (p[:-1] @ p[:-1]), np.append(g + L2 * p[:-1], gb)

    p = np.append(np.zeros(size), bias)
    loss, g = at(p)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    calls = 1
    while calls < steps and np.abs(g).max() > 1e-6:
        d, used = -g, []
        for s, y in reversed(past):
            used.append((s @ d) / (s @ y))
            d = d - used[-1] * y
        d *= (past[-1][0] @ past[-1][1]) / (past[-1][1] @ past[-1][1]) if past else 1 / max(1.0, np.linalg.norm(g))
        for (s, y), k in zip(past, reversed(used)):
            d = d + (k - (y @ d) / (s @ y)) * s
        rate, better = 1.0, False
        while calls < steps and not better:
            new = p + rate * d
            loss_new, g_new = at(new)
            calls, better = calls + 1, loss_new <= loss + 1e-4 * rate * (g @ d)
            rate /= 2
        if not better:
            break
        if (new - p) @ (g_new - g) > 0:
            past = [*past, (new - p, g_new - g)][-memory:]
        done = loss - loss_new <= 1e-7 * max(loss, 1e-3)
        p, loss, g = new, loss_new, g_new
        if done:
            break
    return p[:-1], float(p[-1])


def _gathered(rows: DataFrame) -> DataFrame:
    """A text's features, by range of their hashes."""

    def run(batches):
        for batch in batches:
            label, at = batch.column(2).to_pylist(), 0
            for ids, text in slices([batch], 500_000):
                out = []
                for t in text:
                    f, c, n = features(t)
                    cut = np.searchsorted(f, np.arange(SHARDS + 1) << (BITS - SHARD_BITS))
                    out.extend((label[at], n, k, f[i:j].astype("<i4").tobytes(), np.minimum(c[i:j], 65535).astype("<u2").tobytes())
                               for k, (i, j) in enumerate(zip(cut, cut[1:])) if j > i)
                    at += 1
                kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)],
                                                 names=["y", "positions", "shard", "grams", "counts"])

    return rows.mapInArrow(run, "y int, positions long, shard int, grams binary, counts binary")


def _chosen(gathered: DataFrame, n0: int, n1: int) -> tuple[np.ndarray, np.ndarray]:
    """The selected features in order, and the scale of each; every range is judged over the whole sample in a task."""

    def choose(part: pa.Table) -> pa.Table:
        grams = [np.frombuffer(g, "<i4") for g in part.column("grams").to_pylist()]
        count = np.concatenate([np.frombuffer(c, "<u2") for c in part.column("counts").to_pylist()]).astype(np.float64)
        own = np.repeat(np.arange(part.num_rows), [len(g) for g in grams])
        x = values(count, part.column("positions").to_numpy()[own])
        keep, scale = select(part.column("y").to_numpy()[own], np.concatenate(grams), count, x, n0, n1)
        return pa.table({"gram": keep.astype(np.int32), "scale": scale.astype(np.float64)})

    got = gathered.groupBy("shard").applyInArrow(choose, "gram int, scale double").toPandas().sort_values("gram")
    return got["gram"].to_numpy(dtype=np.int64), got["scale"].to_numpy(dtype=np.float64)


def _entries(rows: DataFrame, keep: np.ndarray, scale: np.ndarray) -> DataFrame:
    """(y, at, x): of each text, the places of its selected features in ``keep`` and their scaled values."""
    shared = rows.sparkSession.sparkContext.broadcast((keep, scale))

    def run(batches):
        keep, scale = shared.value
        for batch in batches:
            label, at = batch.column(2).to_pylist(), 0
            for ids, text in slices([batch], 500_000):
                out = []
                for t in text:
                    f, c, n = features(t)
                    place = np.minimum(np.searchsorted(keep, f), len(keep) - 1)
                    on = keep[place] == f
                    x = values(c[on], n) * scale[place[on]]
                    out.append((label[at], place[on].astype("<i4").tobytes(), x.astype("<f4").tobytes()))
                    at += 1
                yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], k) for i, k in enumerate((pa.int32(), pa.binary(), pa.binary()))],
                                                 names=["y", "at", "x"])

    return stored(rows.mapInArrow(run, "y int, at binary, x binary"), "toxicity_entries").coalesce(PARTS)


def _slope(entries: DataFrame, weight: tuple[float, float]):
    """What ``fit`` asks for: each task adds up its documents' losses and gradients and sends one vector."""

    def at(w: np.ndarray, bias: float) -> tuple[float, np.ndarray, float]:
        shared = entries.sparkSession.sparkContext.broadcast((w, bias))

        def run(batches):
            w, bias = shared.value
            loss, g, gb = 0.0, np.zeros(len(w)), 0.0
            for batch in batches:
                for y, places, x in zip(*(batch.column(k).to_pylist() for k in range(3))):
                    places, x = np.frombuffer(places, "<i4"), np.frombuffer(x, "<f4")
                    margin = float(w[places] @ x) + bias
                    off = weight[y] * (1 / (1 + np.exp(-np.clip(margin, -500, 500))) - y)
                    loss += weight[y] * np.logaddexp(0.0, -margin if y else margin)
                    g[places] += off * x   # a document's places are distinct
                    gb += off
            yield pa.RecordBatch.from_arrays([pa.array([loss]), pa.array([g.tobytes()], pa.binary()), pa.array([gb])], names=["loss", "g", "gb"])

        loss, g, gb = 0.0, np.zeros(len(w)), 0.0
        for r in entries.mapInArrow(run, "loss double, g binary, gb double").collect():
            loss, g, gb = loss + r["loss"], g + np.frombuffer(r["g"], np.float64), gb + r["gb"]
        shared.destroy()
        return loss, g, gb

    return at


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "toxic"):
    """(features, weights, intercept), learnt from the distinct texts of labelled documents outside fold 0: at most
    ``max_rows`` of each class.  The driver gets the selected features and sums over documents, never a document's entries."""
    marks = (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y"))
             .where("doc_id is not null and y in (0, 1)").groupBy("doc_id").agg(F.max("y").alias("y"))
             .where(fold() != 0))
    own = texts(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("text_hash"))
    marks = stored(own.join(marks, "doc_id").groupBy("text_hash", "y").agg(F.min("doc_id").alias("doc_id")), "toxicity_marks")
    total = {r["y"]: r["n"] for r in marks.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = (min(max_rows, total.get(c, 0)) for c in (0, 1))
    if not n0 or not n1:
        return np.zeros(0, np.int64), np.zeros(0), 30.0 if n1 else -30.0
    marks = thinned(marks, "y", total, max_rows, "text_hash")
    order = [F.xxhash64("text_hash"), F.col("text_hash")]
    sample = (marks.where("y = 1").orderBy(*order).limit(max_rows)
              .unionAll(marks.where("y = 0").orderBy(*order).limit(max_rows)))
    rows = texts(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
    picked = stored(rows.join(F.broadcast(sample), ["doc_id", "text_hash"])  # at most 2 x max_rows rows of three numbers
                    .dropDuplicates(["text_hash", "y"]).select("doc_id", "text", "y"), "toxicity_sample")
    keep, scale = _chosen(_gathered(picked), n0, n1)
    share = total[1] / (total[0] + total[1])
    bias = float(np.log(share / (1 - share)))
    if not len(keep):
        return keep, scale, bias
    w, bias = fit(_slope(_entries(picked, keep, scale), ((1 - share) / n0, share / n1)), len(keep), bias)
    return keep, w * scale, bias


def score(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    keep, weights, bias = model
    shared = docs.sparkSession.sparkContext.broadcast((keep, weights.astype(np.float64), bias))

    def run(batches):
        keep, weights, bias = shared.value
        table = np.zeros(1 << BITS, np.float64)
        table[keep] = weights
        known = np.zeros(1 << BITS, bool)
        known[keep] = True
        for ids, text in slices(batches):
            out = np.empty(len(ids))
            for i, t in enumerate(text):
                got = hashed(t)
                own = [h[known[h]] for h in got]
                f, c = np.unique(np.concatenate(own), return_counts=True) if own else (keep[:0], keep[:0])
                out[i] = bias + (table[f] * values(c, len(got[0]) if got else 0)).sum()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(1 / (1 + np.exp(-np.clip(out, -500, 500))))], names=["doc_id", "score"])

    scored = texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    return score(docs, train(docs, labels, max_rows))
