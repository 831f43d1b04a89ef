"""Substring dedup with a count-min prefilter (operator 5).

Words are what white space (space, and bytes 9 to 13) separates, unchanged.  A window is ``n`` neighbouring
words of one document; a word is removed if a window that covers it occurs anywhere else too.

1. The texts are stored as blocks, and a count-min sketch of all windows' hashes is merged
   by shard (``sketch``); each block learns which of its windows may repeat.
2. Only those are grouped exactly, by 96 bits of two independent hashes of their word sequences:
   each block sends its distinct ones, sorted and packed, to the shard of their range, which
   counts them and answers with one bit each.
3. Each block recomputes its windows, covers the words of the repeated ones and emits
   its documents.

The sketch only overestimates, so no repeated window is lost, and windows that it wrongly
proposes are dropped by the exact count.  Windows are judged on the input.  A window that a third
of all documents share is one entry per block, not per document.

Null and empty texts have no words and stay as they are.  Repeated rows repeat each
other's windows (a text of at least ``n`` words that occurs twice is removed whole, from
both); ids are only carried, so null and equal ids do no harm.  Empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress as picked

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provisio.llm import sketch as sk
from provisio.llm import wordhash as wh

N = 35


def window_hashes(parts: list[bytes | None], n: int, second: bool) -> tuple[np.ndarray, np.ndarray | None, list[int]]:
    """Both hashes of all windows of some texts in order, and the number of words of each text."""
    high, low, counts = [], [], []
    for _, texts in sk.pieces(parts):
        words = wh.split(texts, wh.SPACED)
        own = np.diff(words.first)
        counts.extend(own.tolist())
        if len(words.starts) < n:
            continue
        here = np.arange(len(words.starts) - n + 1)
        here = here[np.searchsorted(words.first, here, "right") == np.searchsorted(words.first, here + n - 1, "right")]
        high.append(wh.runs(wh.word_hashes(words, wh.SPACED, 1), n)[here])
        if second:
            low.append((wh.runs(wh.word_hashes(words, wh.SPACED, 2), n)[here] >> np.uint64(32)).astype(np.uint32))
    none = np.zeros(0, np.uint64)
    return np.concatenate(high or [none]), np.concatenate(low or [none.astype(np.uint32)]) if second else None, counts


def _distinct(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, group of each in that order, first of each group) of equal pairs."""
    order = np.lexsort((low, high))
    h, w = high[order], low[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (w[1:] != w[:-1])
    return order, np.cumsum(new) - 1, np.flatnonzero(new)


def repeated_spans(docs: DataFrame, n: int = N, id_col: str = "doc_id", text_col: str = "text"):
    """(blocks with the answers for their windows, bits of a shard's number)."""
    blocks = sk.pack(docs, id_col=id_col, text_col=text_col)
    bits = sk.cell_bits(blocks)
    shard_bits = max(0, bits - 21)  # a shard holds a million candidates at most

    known = sk.estimates(blocks, lambda parts: window_hashes(parts, n, False)[0], bits)

    def propose(batches):
        for block, _, parts, classes in sk.rows_of(batches, 1):
            high, low, _ = window_hashes(parts, n, True)
            maybe = sk.Estimate(high, classes, bits).of(high) > 0 if classes else np.zeros(0, bool)
            out = [(-block - 1, sk.compress(np.packbits(maybe).tobytes()), b"", b"")]  # for this block itself
            high, low = high[maybe], low[maybe]
            order, group, first = _distinct(high, low)
            several = np.bincount(group, minlength=len(first)) > 1 if len(group) else np.zeros(0, bool)
            high, low = high[order][first], low[order][first]
            shard = (high >> np.uint64(64 - shard_bits)).astype(np.int64) if shard_bits else np.zeros(len(high), np.int64)
            start = np.flatnonzero(np.diff(shard, prepend=-1))
            for a, b in zip(start.tolist(), np.append(start[1:], len(shard)).tolist()):
                out.append((int(shard[a]), sk.shrunk(np.diff(high[a:b], prepend=np.uint64(0))), low[a:b].tobytes(),
                            sk.compress(np.packbits(several[a:b]).tobytes())))
            yield pa.RecordBatch.from_arrays(
                [pa.array([block] * len(out), pa.int64()), pa.array([o[0] for o in out], pa.int64()),
                 *(pa.array([o[k] for o in out], pa.binary()) for k in (1, 2, 3))],
                names=["block", "shard", "high", "low", "several"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(t.column("block")[i].as_py(), t.column("shard")[i].as_py(), *(t.column(c)[i].as_py() for c in ("high", "low", "several")))
                for t in batches for i in range(t.num_rows)]
        schema = ["block", "shard", "bits"]
        if held[0][1] < 0:
            yield pa.RecordBatch.from_arrays([pa.array([h[0] for h in held], pa.int64()), pa.array([h[1] for h in held], pa.int64()),
                                              pa.array([h[2] for h in held], pa.binary())], names=schema)
            return
        high = [np.cumsum(sk.unshrunk(h[2], np.uint64), dtype=np.uint64) for h in held]
        low = [np.frombuffer(h[3], np.uint32) for h in held]
        several = [np.unpackbits(np.frombuffer(sk.expand(h[4]), np.uint8), count=len(w)) for h, w in zip(held, low, strict=True)]
        at = sk.offsets(len(w) for w in low)
        order, group, first = _distinct(np.concatenate(high), np.concatenate(low))
        total = np.bincount(group, weights=1 + np.concatenate(several)[order], minlength=len(first))
        again = np.empty(len(order), bool)
        again[order] = total[group] > 1
        found = [sk.compress(np.packbits(again[a:b]).tobytes()) for a, b in zip(at, at[1:])]
        yield pa.RecordBatch.from_arrays([pa.array([h[0] for h in held], pa.int64()), pa.array([h[1] for h in held], pa.int64()),
                                          pa.array(found, pa.binary())], names=schema)

    proposed = blocks.join(known, "block", "left").select("block", "ids", "sizes", "blob", "classes").mapInArrow(
        propose, "block long, shard long, high binary, low binary, several binary")
    answers = (proposed.groupBy("shard").applyInArrow(count, "block long, shard long, bits binary")
               .groupBy("block").agg(F.sort_array(F.collect_list(F.struct("shard", "bits"))).alias("answers")))
    return blocks.join(answers, "block").select("block", "ids", "sizes", "blob", "answers"), shard_bits


def _removed(parts: list[bytes | None], answers: list[dict], n: int, shard_bits: int) -> tuple[np.ndarray, list[int]]:
    """Which words of a block go, and the number of words of each text."""
    high, low, counts = window_hashes(parts, n, True)
    own = next(a["bits"] for a in answers if a["shard"] < 0)
    maybe = np.unpackbits(np.frombuffer(sk.expand(own), np.uint8), count=len(high)).astype(bool)
    order, group, first = _distinct(high[maybe], low[maybe])
    again = np.zeros(len(first), bool)
    at = 0
    # The shards follow each other as the sorted hashes do.
    top = high[maybe][order][first]
    top = (top >> np.uint64(64 - shard_bits)).astype(np.int64) if shard_bits else np.zeros(len(top), np.int64)
    for a in answers:
        if a["shard"] >= 0:
            k = int(np.searchsorted(top, a["shard"], "right")) - at
            again[at:at + k] = np.unpackbits(np.frombuffer(sk.expand(a["bits"]), np.uint8), count=k)
            at += k
    window = np.zeros(len(high), bool)
    picked_at = np.flatnonzero(maybe)
    window[picked_at[order]] = again[group] if len(group) else False
    words = np.array(counts, dtype=np.int64)
    windows = np.maximum(words - n + 1, 0)
    # Window k of a text starts at its word k.
    start = np.flatnonzero(window)
    text = np.searchsorted(np.cumsum(windows), start, "right")
    start = start - (np.cumsum(windows) - windows)[text] + (np.cumsum(words) - words)[text]
    cover = np.zeros(int(words.sum()) + 1, np.int32)
    np.add.at(cover, start, 1)
    np.add.at(cover, start + n, -1)
    return np.cumsum(cover[:-1]) > 0, counts


def dedup(docs: DataFrame, n: int = N, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, text (the kept words joined by a blank; null stays null)."""
    answered, shard_bits = repeated_spans(docs, n, id_col, text_col)

    def emit(batches):
        for _, ids, parts, answers in sk.rows_of(batches, 1):
            gone, counts = _removed(parts, answers, n, shard_bits)
            at = sk.offsets(counts)
            removed = [int(gone[a:b].sum()) for a, b in zip(at, at[1:])]
            kept = []
            for i, p in enumerate(parts):
                words = None if p is None else p.split()
                if removed[i]:
                    words = picked(words, (~gone[at[i]:at[i + 1]]).tolist())
                kept.append(None if words is None else b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "text"])

    return answered.mapInArrow(emit, "doc_id long, n_words long, n_removed long, text string")
