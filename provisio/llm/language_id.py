"""Language ID (operator 3): a byte convolutional network.

Bytes of the lower-cased text are cut into windows of 256.  Each byte is embedded;
filters of widths 2, 3 and 4 run over the window, their maxima are pooled, and a
softmax gives the window's languages.  A text's language is the one with the largest
mean probability over all its windows, weighted by their bytes; that mean is the score.

``train`` fits the network in numpy (Adam) on windows of at most ``max_docs`` labelled
documents per language, outside fold 0; ``predict`` covers every window of every text.
For the prediction the embedding and two neighbouring taps of a filter are folded into
one table over byte pairs, so a filter is one or two look-ups per position.

Null texts and texts without a letter get ``und`` and score 0, and so does every text
if no labelled document can be learnt from.  Repeated rows are each predicted, a null id
is kept (never held out), an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from provisio.llm.common import slices, texts, thinned

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBED = 8
MAX_DOCS = 400
WINDOWS_PER_DOC = 6
FOLDS = 5
UNDETERMINED = "und"

_LETTER = re.compile(r"[^\W\d_]")


def fold(id_col: str = "doc_id"):
    """crc32 of the id as text, modulo 5; fold 0 is held out."""
    return F.crc32(F.col(id_col).cast("string")) % F.lit(FOLDS)


def encoded(text: str) -> bytes:
    return text.lower().encode("utf-8", "surrogatepass")


def windows(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """All windows of a text, the last padded with zeros; the bytes in each."""
    n = -(-len(raw) // WINDOW)
    size = np.full(n, WINDOW)
    if n:
        size[-1] = len(raw) - WINDOW * (n - 1)
    return np.frombuffer(raw.ljust(n * WINDOW, b"\0"), np.uint8).reshape(n, WINDOW), size


class ByteCnn:
    def __init__(self, langs: list[str], seed: int = 7):
        r = np.random.default_rng(seed)
        self.langs = langs
        self.p = {"embed": r.normal(0, 0.5, (256, EMBED)), "out": r.normal(0, 0.1, (FILTERS * len(WIDTHS), len(langs))),
                  "bias": np.zeros(len(langs))}
        for w in WIDTHS:
            self.p[f"filter{w}"] = r.normal(0, (w * EMBED) ** -0.5, (w * EMBED, FILTERS))
            self.p[f"shift{w}"] = np.zeros(FILTERS)
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def step(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean cross-entropy on one batch of windows."""
        p, n = self.p, len(x)
        e = p["embed"][x]
        kept, pooled = [], []
        for w in WIDTHS:
            cols = np.concatenate([e[:, k:WINDOW - w + 1 + k] for k in range(w)], axis=2)
            a = cols @ p[f"filter{w}"] + p[f"shift{w}"]
            top = a.argmax(axis=1)
            best = np.take_along_axis(a, top[:, None], 1)[:, 0]
            kept.append((cols, top, best > 0))
            pooled.append(np.maximum(best, 0))
        h = np.concatenate(pooled, axis=1)
        z = h @ p["out"] + p["bias"]
        z = np.exp(z - z.max(axis=1, keepdims=True))
        z /= z.sum(axis=1, keepdims=True)
        z[np.arange(n), y] -= 1
        z /= n
        g = {"out": h.T @ z, "bias": z.sum(axis=0), "embed": np.zeros_like(p["embed"])}
        back = z @ p["out"].T
        rows = np.arange(n)
        for i, w in enumerate(WIDTHS):
            cols, top, on = kept[i]
            d = back[:, i * FILTERS:(i + 1) * FILTERS] * on
            picked = cols[rows[:, None], top]                       # (n, filters, w * embed)
            g[f"filter{w}"] = np.einsum("nfc,nf->cf", picked, d)
            g[f"shift{w}"] = d.sum(axis=0)
            into = (d[:, :, None] * p[f"filter{w}"].T[None]).reshape(n, FILTERS, w, EMBED)
            for k in range(w):
                np.add.at(g["embed"], x[rows[:, None], top + k].ravel(), into[:, :, k].reshape(-1, EMBED))
        return g

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 5, batch: int = 128, rate: float = 4e-3, seed: int = 3) -> ByteCnn:
        r = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        t = 0
        for _ in range(epochs):
            order = r.permutation(len(x))
            for at in range(0, len(order), batch):
                t += 1
                own = order[at:at + batch]
                for k, g in self.step(x[own], y[own]).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    s[k] = 0.999 * s[k] + 0.001 * g * g
                    self.p[k] -= rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(s[k] / (1 - 0.999 ** t)) + 1e-8)
        return self

    def tables(self) -> list[list[tuple[int, np.ndarray, bool]]]:
        """For each width: (offset, table, over byte pairs?) whose look-ups sum to the filter."""
        p, out = self.p, []
        for w in WIDTHS:
            tap = (p["embed"] @ p[f"filter{w}"].reshape(w, EMBED, FILTERS)).astype(np.float32)  # (w, 256, filters)
            tap[0] += p[f"shift{w}"]
            parts = []
            for k in range(0, w - 1, 2):
                parts.append((k, (tap[k + 1][:, None] + tap[k][None]).reshape(65536, FILTERS), True))
            if w % 2:
                parts.append((w - 1, tap[w - 1], False))
            out.append(parts)
        return out

    def probabilities(self, x: np.ndarray, tables, block: int = 128) -> np.ndarray:
        out = np.empty((len(x), len(self.langs)), np.float32)
        for at in range(0, len(x), block):
            b = x[at:at + block]
            pairs = b[:, :-1].astype(np.int32) | (b[:, 1:].astype(np.int32) << 8)
            pooled = []
            for w, parts in zip(WIDTHS, tables, strict=True):
                n = WINDOW - w + 1
                a = None
                for k, t, over_pairs in parts:
                    got = t.take((pairs if over_pairs else b)[:, k:k + n].ravel(), axis=0)
                    a = got if a is None else np.add(a, got, out=a)
                pooled.append(np.maximum(a.reshape(len(b), n, FILTERS).max(axis=1), 0))
            z = np.concatenate(pooled, axis=1) @ self.p["out"] + self.p["bias"]
            z = np.exp(z - z.max(axis=1, keepdims=True))
            out[at:at + block] = z / z.sum(axis=1, keepdims=True)
        return out


def train(docs: DataFrame, max_docs: int = MAX_DOCS, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> ByteCnn | None:
    """A network learnt from at most ``max_docs`` documents of each language outside fold 0."""
    known = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"),
                        F.col(text_col).cast("string").alias("text"))
    known = known.where((fold() != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    # one row per language
    known = thinned(known, "lang", {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}, max_docs)
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    picked = (known.withColumn("n", F.row_number().over(first)).where(F.col("n") <= max_docs)
              .select("lang", "text"))

    def cut(batches):
        for lang, text in slices(batches):
            out = []
            for name, t in zip(lang, text, strict=True):
                if not _LETTER.search(t):
                    continue
                x, size = windows(encoded(t))
                for i in np.unique(np.linspace(0, len(x) - 1, WINDOWS_PER_DOC).round().astype(int)):
                    out.append((name, x[i].tobytes()[:size[i]]))
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.binary())],
                                             names=["lang", "bytes"])

    got = sorted((r["lang"], bytes(r["bytes"])) for r in picked.mapInArrow(cut, "lang string, bytes binary").collect())
    langs = sorted({lang for lang, _ in got})
    if not langs:
        return None
    r = np.random.default_rng(5)
    x, y = [], []
    for lang, raw in got:
        # The whole window, and a short piece of it, as short texts give.
        for piece in (raw, raw[:int(r.integers(12, 100))]):
            x.append(np.frombuffer(piece.ljust(WINDOW, b"\0"), np.uint8))
            y.append(langs.index(lang))
    return ByteCnn(langs).fit(np.array(x), np.array(y))


def scored(model: ByteCnn, tables, text: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    lang, score = [UNDETERMINED] * len(text), np.zeros(len(text))
    own = [i for i, t in enumerate(text) if model and t and _LETTER.search(t)]
    if own:
        cut = [windows(encoded(text[i])) for i in own]
        p = model.probabilities(np.concatenate([c[0] for c in cut]), tables).astype(np.float64)
        size = np.concatenate([c[1] for c in cut])
        starts = np.cumsum([0] + [len(c[1]) for c in cut[:-1]])
        mean = np.add.reduceat(p * size[:, None], starts) / np.add.reduceat(size, starts)[:, None]
        for i, m in zip(own, mean, strict=True):
            lang[i], score[i] = model.langs[int(m.argmax())], min(1.0, float(m.max()))
    return lang, score


def predict(docs: DataFrame, model: ByteCnn | None, text_col: str = "text") -> DataFrame:
    """The documents with lang_pred and score beside their own columns (which must not have these names)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        tables = model.tables() if model else None
        for batch in batches:
            place = batch.schema.get_field_index(text_col)
            lang, score = [], []
            for _, text in slices([pa.RecordBatch.from_arrays([pa.array(range(batch.num_rows)), batch.column(place)], names=["i", "text"])]):
                got = scored(model, tables, text)
                lang += got[0]
                score.append(got[1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lang, pa.string()), pa.array(np.concatenate(score or [np.zeros(0)]))],
                                             names=[*batch.schema.names, "lang_pred", "score"])

    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.mapInArrow(run, schema)


def language_id(docs: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row."""
    found = predict(texts(docs), train(docs, max_docs))
    return found.select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")
