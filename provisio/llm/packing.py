"""Best-fit packing by exact complements (operator 9).

1. *Pieces.*  Every text becomes token ids plus an end id; documents longer than the
   capacity are cut into full pieces and a last, shorter one.
2. *Plan.*  Packing depends on lengths alone, and there are at most ``capacity`` different
   ones, so the plan is made from the histogram of lengths (never from rows).  Going from
   the longest length down, the gap it leaves is looked up among single lengths, pair sums
   and triple sums; a combination that fills it exactly is used as often as the counts of
   its members allow.  What has no exact complement is filled best-fit: the longest length
   that still fits, with the exact lookups tried again on what remains.
3. *Assignment.*  Pieces of one length are numbered (per-task counters plus offsets, so a
   length that a third of all pieces share is never in one task) and the plan maps
   (length, number) to a sequence and an offset.

A null text is an empty one (its sequence is the end id alone).  Repeated rows are packed
as often as they occur, a null id is kept, an empty table gives no rows, other columns
are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from provisio.llm.common import slices, stored, texts

CAPACITY = 4096
END_ID = 1


class _Stock:
    """How many pieces of each length are left; which lengths, pair and triple sums exist.

    The lengths in stock are the bits of one integer and, mirrored, of another, so that
    "is there a pair with this sum" is one shift and one AND."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.n = [0] * (capacity + 1)
        self.capacity, self.bits, self.mirror = capacity, 0, 0
        for length, c in counts.items():
            self.n[length] = c
            self.bits |= 1 << length
            self.mirror |= 1 << (capacity - length)

    def take(self, length: int, times: int) -> None:
        self.n[length] -= times
        if not self.n[length]:
            self.bits &= ~(1 << length)
            self.mirror &= ~(1 << (self.capacity - length))

    def has(self, used: dict[int, int], *more: int) -> bool:
        return all(self.n[x] >= used.get(x, 0) + more.count(x) for x in more)

    def largest(self, at_most: int) -> int:
        return (self.bits & ((1 << (at_most + 1)) - 1)).bit_length() - 1 if at_most > 0 else -1

    def pair(self, used: dict[int, int], total: int, *more: int) -> tuple[int, ...] | None:
        found = self.bits & (self.mirror >> (self.capacity - total)) & ((1 << (total // 2 + 1)) - 1)
        while found:  # the shortest partner first: it leaves with the longest
            low = found & -found
            a = low.bit_length() - 1
            if a and self.has(used, *more, a, total - a):
                return (a, total - a)
            found ^= low
        return None

    def exact(self, used: dict[int, int], gap: int) -> tuple[int, ...] | None:
        """Lengths in stock, beside ``used``, that sum to ``gap``: one, two or three."""
        if self.n[gap] and self.has(used, gap):
            return (gap,)
        if two := self.pair(used, gap):
            return two
        singles = self.bits & ((1 << (gap // 3 + 1)) - 1)
        while singles:
            low = singles & -singles
            a = low.bit_length() - 1
            if a and self.has(used, a) and (two := self.pair(used, gap - a, a)):
                return (a, *two)
            singles ^= low
        return None


Pattern = tuple[tuple[int, int], ...]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[Pattern, int]]:
    """Patterns ((length, copies) of one sequence, how many sequences) that use up all counts.

    Copies of one length are taken together, so a million pieces of one token are one step."""
    stock, out = _Stock({k: v for k, v in counts.items() if v > 0}, capacity), []
    while stock.bits:
        first = stock.bits.bit_length() - 1
        used, gap = {first: 1}, capacity - first
        while gap:
            if more := stock.exact(used, gap):
                for x in more:
                    used[x] = used.get(x, 0) + 1
                break
            fit = stock.largest(gap)
            while fit > 0 and not stock.has(used, fit):
                fit = stock.largest(fit - 1)
            if fit <= 0:
                break
            copies = min(gap // fit, stock.n[fit] - used.get(fit, 0))
            used[fit] = used.get(fit, 0) + copies
            gap -= copies * fit
        times = min(stock.n[x] // c for x, c in used.items())
        for x, c in used.items():
            stock.take(x, times * c)
        out.append((tuple(used.items()), times))
    return out


def slots(patterns: list[tuple[Pattern, int]]) -> dict[int, np.ndarray]:
    """By length: rows (first number, first sequence, offset, copies) of the plan, by first number."""
    used: dict[int, int] = {}
    rows: dict[int, list] = {}
    sequence = 0
    for combo, times in patterns:
        offset = 0
        for x, copies in combo:
            rows.setdefault(x, []).append((used.get(x, 0), sequence, offset, copies))
            used[x] = used.get(x, 0) + times * copies
            offset += x * copies
        sequence += times
    return {x: np.array(r, dtype=np.int64) for x, r in rows.items()}


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents as pieces: doc_id, piece, start, length, ids_crc32, and the task and the
    number within (task, length) that the assignment needs."""

    def cut(batches):
        from pyspark import TaskContext

        from provisio.llm.word_bpe import tokenizer

        bpe, task = tokenizer(tokenizer_path), TaskContext.get().partitionId()
        end = np.array([end_id], dtype="<u4").tobytes()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        full = capacity * 4
        for ids, text in slices(batches):
            out: list[tuple] = []
            for doc, raw in zip(ids, bpe.ids(text), strict=True):
                raw += end
                for k, at in enumerate(range(0, len(raw), full)):
                    part = raw[at:at + full]
                    n = len(part) // 4
                    out.append((doc, k, at // 4, n, zlib.crc32(part), task, int(seen[n])))
                    seen[n] += 1
            cols = list(zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _PIECE.types, strict=True)], schema=_PIECE)

    return texts(docs, id_col, text_col).mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids_crc32 long, task int, number long")


_PIECE = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids_crc32", pa.int64()), ("task", pa.int32()), ("number", pa.int64())])


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Assign stored pieces to sequences: adds sequence_id and offset.

    The driver sees one row per length (at most ``capacity``); the plan that goes to the
    tasks has a few entries per length for the same reason."""
    spark = cut.sparkSession
    by_task = cut.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = spark.sparkContext.broadcast(slots(plan(histogram, capacity)))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_task.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    numbered = cut.join(offsets, ["task", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("number") + F.col("before")).alias("number"))

    def place(batches):
        by_length = places.value
        for batch in batches:
            length, number = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 5))
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            for x in np.unique(length):
                rows, at = by_length[int(x)], np.flatnonzero(length == x)
                k = np.searchsorted(rows[:, 0], number[at], "right") - 1
                place_in, copies = number[at] - rows[k, 0], rows[k, 3]
                sequence[at] = rows[k, 1] + place_in // copies
                offset[at] = rows[k, 2] + place_in % copies * x
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return numbered.mapInArrow(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def best_fit_packing(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    cut = pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col)
    return pack(stored(cut, "pieces"), capacity)
