"""Blocks of texts, and a count-min sketch over hashes of their windows that needs no broadcast.

``pack`` writes the texts once as blocks: one row holds the compressed texts of some
documents.  Every later pass reads the same stored blocks, so a block's hashes come out
in the same order each time, and an answer for a block can be one small value per hash.

``estimates`` builds the sketch in two steps.  Each block counts its own hashes into
cells (``DEPTH`` rows of cells, a number of cells in proportion to the input) and sends
its distinct cells and counts to the shard that owns that range of cells.  The shard adds up all
blocks' counts, which makes the merged count-min sketch for its range, and sends
each block the merged count of the block's own cells, as a size class.  The smallest class over the
rows overestimates a hash's count (never underestimates it), so no hash that occurs
twice is missed.  Nothing whole is ever collected or broadcast: a shard has a fixed number of
cells, a block a fixed size, and both grow in number only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provisio.llm import wordhash as wh
from provisio.llm.common import stored, texts

BLOCK_BYTES = 8_000_000
DEPTH = 2
SHARD_BITS = 22
_BLOCK = "block long, ids array<long>, sizes array<int>, blob binary"
_FACTORS = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)]


def compress(raw: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(raw)


def expand(raw: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(raw)


def shrunk(values: np.ndarray) -> bytes:
    """Integers whose high bytes are mostly zero, byte plane by byte plane."""
    return compress(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes())


def unshrunk(raw: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(expand(raw), np.uint8).reshape(size, -1).T).view(dtype).ravel()


def pack(docs: DataFrame, block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents as stored blocks of about ``block_bytes`` (a longer text is a block alone).

    A null text has size -1.  Block ids are made of the task and a number, and are fixed once stored."""

    def run(batches):
        from pyspark import TaskContext

        task, number = TaskContext.get().partitionId(), 0

        def block(ids, parts):
            import zstandard

            return pa.RecordBatch.from_arrays(
                [pa.array([(task << 32) + number], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                 pa.array([[-1 if p is None else len(p) for p in parts]], pa.list_(pa.int32())),
                 pa.array([zstandard.ZstdCompressor(level=3).compress(b"".join(p for p in parts if p))], pa.binary())],
                names=["block", "ids", "sizes", "blob"])

        ids, parts, held = [], [], 0
        for batch in batches:
            text = batch.column(1).cast(pa.binary())
            for i, doc in enumerate(batch.column(0).to_pylist()):
                raw = text[i].as_py()
                n = len(raw) if raw else 0
                if ids and held + n > block_bytes:
                    yield block(ids, parts)
                    number, ids, parts, held = number + 1, [], [], 0
                ids.append(doc)
                parts.append(raw)
                held += n
        if ids:
            yield block(ids, parts)

    return stored(texts(docs, id_col, text_col).mapInArrow(run, _BLOCK), "blocks")


def rows_of(batches, extra: int = 0) -> Iterator[tuple]:
    """(block, ids, parts, further columns ...) of block rows, one at a time."""
    for batch in batches:
        for i in range(batch.num_rows):
            raw, at, parts = expand(batch.column(3)[i].as_py()), 0, []
            sizes = batch.column(2)[i].as_py()
            for n in sizes:
                parts.append(None if n < 0 else raw[at:at + n])
                at += max(0, n)
            yield (batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), parts,
                   *(batch.column(4 + k)[i].as_py() for k in range(extra)))


def pieces(parts: list[bytes | None], size: int = 500_000) -> Iterator[tuple[int, list[bytes]]]:
    """(number of the first, texts) in slices of about ``size`` bytes; a null text is empty here."""
    at = 0
    while at < len(parts):
        stop, n = at, 0
        while stop < len(parts) and (stop == at or n + len(parts[stop] or b"") <= size):
            n += len(parts[stop] or b"")
            stop += 1
        yield at, [p or b"" for p in parts[at:stop]]
        at = stop


def cell_bits(blocks: DataFrame, bytes_per_hash: int = 6) -> int:
    """Bits of a cell number: twice as many cells as the texts have words, or up to four times."""
    total = blocks.select(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, n: a + F.greatest(n, F.lit(0))))).first()[0] or 0
    return max(16, int(2 * total // bytes_per_hash).bit_length())


def cells(hashes: np.ndarray, row: int, bits: int) -> np.ndarray:
    return wh.mixed(hashes * _FACTORS[row] + np.uint64(row)) >> np.uint64(64 - bits)


def _counted(hashes: np.ndarray, row: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A block's distinct cells in order, and how many of its hashes are in each."""
    c = np.sort(cells(hashes, row, bits))
    first = np.flatnonzero(np.diff(c, prepend=c[:1] + np.uint64(1) if len(c) else c))
    return c[first], np.diff(np.append(first, len(c)))


def estimates(blocks: DataFrame, hashes_of: Callable[[list[bytes | None]], np.ndarray], bits: int) -> DataFrame:
    """(block, classes): what ``Estimate`` needs to give each hash of the block its size class."""
    own = min(bits, SHARD_BITS)

    def count(batches):
        for block, _, parts in rows_of(batches):
            h = hashes_of(parts)
            for row in range(DEPTH):
                cell, n = _counted(h, row, bits)
                shard = (cell >> np.uint64(own)).astype(np.int64)
                start = np.flatnonzero(np.diff(shard, prepend=-1))
                stop = np.append(start[1:], len(cell))
                out = []
                for a, b in zip(start.tolist(), stop.tolist()):
                    low = (cell[a:b] & np.uint64((1 << own) - 1)).astype(np.uint32)
                    out.append((int(shard[a]) * DEPTH + row, shrunk(np.diff(low, prepend=np.uint32(0))),
                                shrunk(np.minimum(n[a:b], 65535).astype(np.uint16))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * len(out), pa.int64()), pa.array([o[0] for o in out], pa.int64()),
                     pa.array([o[1] for o in out], pa.binary()), pa.array([o[2] for o in out], pa.binary())],
                    names=["block", "shard", "cells", "counts"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One shard: add all blocks' counts, answer each block in turn."""
        total = np.zeros(1 << own, np.uint32)
        held = list(batches)
        place = lambda t, i: np.cumsum(unshrunk(t.column("cells")[i].as_py(), np.uint32), dtype=np.uint32)
        for t in held:
            for i in range(t.num_rows):
                total[place(t, i)] += unshrunk(t.column("counts")[i].as_py(), np.uint16)
        for t in held:
            found = [compress(size_class(total[place(t, i)]).tobytes()) for i in range(t.num_rows)]
            yield pa.RecordBatch.from_arrays([t.column("block"), t.column("shard"), pa.array(found, pa.binary())],
                                             names=["block", "shard", "classes"])

    sent = blocks.mapInArrow(count, "block long, shard long, cells binary, counts binary")
    answered = sent.groupBy("shard").applyInArrow(merge, "block long, shard long, classes binary")
    return answered.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("shard", "classes"))).alias("classes"))


def size_class(counts: np.ndarray) -> np.ndarray:
    """0 for one, 1 for two, 2 for three and four, and so on by doubling."""
    return np.ceil(np.log2(np.maximum(counts, 1))).astype(np.uint8)


class Estimate:
    """The size classes of one block's hashes."""

    def __init__(self, hashes: np.ndarray, classes: list[dict], bits: int):
        self.bits, self.known = bits, []
        by_row = [b"".join(expand(c["classes"]) for c in classes if c["shard"] % DEPTH == row) for row in range(DEPTH)]
        for row in range(DEPTH):
            cell, _ = _counted(hashes, row, bits)
            got = np.frombuffer(by_row[row], np.uint8)
            more = got > 0
            self.known.append((cell[more], got[more]))

    def of(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), 255, np.uint8)
        for row, (cell, got) in enumerate(self.known):
            if not len(cell):
                return np.zeros(len(hashes), np.uint8)
            live = np.flatnonzero(out)
            c = cells(hashes[live], row, self.bits)
            at = np.minimum(np.searchsorted(cell, c), len(cell) - 1)
            out[live] = np.minimum(out[live], np.where(cell[at] == c, got[at], 0))
        return out


def offsets(sizes) -> list[int]:
    return [0, *accumulate(sizes)]
