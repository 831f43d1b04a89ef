"""Embedding near-dedup by sorted projection passes (operator 7).

Vectors are compared only when their labels are equal and not null, by cosine in double
precision; vectors that are null, zero or hold a null or non-finite component link with nothing.

1. Equal vectors of a label become one row with their number (a vector that a third of
   all rows share is one row from here on).
2. In each pass the vectors are ordered lexicographically by (label, the concatenated
   signs of random projections) and each is compared with its next ``WINDOW`` neighbours; passes have
   projections of their own.  All passes are one range partitioning by (pass, label, hash); a
   partition is streamed in order, and the last rows of each are compared with the first of
   the next in a second, small step.  Each partition sends a spanning forest of the pairs
   it verified, never all of them.
3. Components are formed over the pairs of all passes.  Inside each component all pairs are then
   compared exactly, in blocks, to count links: a pair of near neighbours that no window held
   is found if other vectors connect it.

What can be missed is a pair that no pass brings into one window and no chain of verified
pairs connects; ``tests/llm`` measures recall against brute force.  As more vectors of a label stand between two near
ones in each order, the number of passes follows the logarithm of the largest label (``passes_for``).  Counting links inside a component is
quadratic in that component; blocks of ``BLOCK`` vectors spread it over tasks, and
only counts are emitted.

Repeated rows are vectors of their own, and a null id is kept (its component is the least
id of its group, if any).  A vector of another length than its label's others links only with those of its
length.  Empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provisio.llm.common import stored
from provisio.llm.components import components

COSINE = 0.93
#: passes for a label of up to PASSES_UP_TO vectors, and further ones for each doubling beyond
PASSES = 16
PASSES_UP_TO = 50_000
MORE_PASSES = 2.7
WINDOW = 24
HASH_BITS = 62
BLOCK = 1024


def _matrix(column) -> np.ndarray:
    """A list column whose rows have one length, as unit vectors in double precision."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    x = flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


class _Forest:
    """Union-find over the rows of one task."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (p := self.up.get(x, x)) != x:
            self.up[x] = self.up.get(p, p)
            x = p
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def signatures(vectors: DataFrame, passes: int, bits: int) -> DataFrame:
    """(id, label, x) once per pass, with the pass and its concatenated sign hashes as one integer."""

    def sign(batches):
        for batch in batches:
            names, size = ("id", "label", "x"), batch.column(3).to_numpy()
            for n in np.unique(size):
                part = pa.Table.from_batches([batch]).filter(pa.array(size == n)).combine_chunks().to_batches()[0]
                x = _matrix(part.column(2))
                for p in range(passes):
                    planes = np.random.default_rng([p, int(n)]).normal(size=(x.shape[1], bits))
                    key = ((x @ planes > 0) << np.arange(bits - 1, -1, -1, dtype=np.int64)).sum(axis=1)
                    yield pa.RecordBatch.from_arrays(
                        [*(part.column(i) for i in range(3)), pa.array(np.full(len(x), p, np.int32)), pa.array(key)],
                        names=[*names, "pass", "key"])

    return vectors.select("id", "label", "x", F.size("x").alias("size")).mapInArrow(
        sign, "id long, label string, x array<double>, pass int, key long")


def _compare(group: np.ndarray, ids: np.ndarray, x: np.ndarray, window: int, cosine: float, forest: _Forest,
             from_: int = 0) -> list[tuple[int, int]]:
    """Verified pairs within ``window`` places whose later row is at ``from_`` or after."""
    out = []
    for step in range(1, min(window, len(ids) - 1) + 1):
        start = max(from_ - step, 0)
        a, b = slice(start, len(ids) - step), slice(start + step, len(ids))
        near = np.flatnonzero((group[a] == group[b]) & (np.einsum("ij,ij->i", x[a], x[b]) >= cosine))
        out.extend((int(ids[start + i]), int(ids[start + step + i])) for i in near if forest.join(int(ids[start + i]), int(ids[start + step + i])))
    return out


def neighbours(signed: DataFrame, window: int, cosine: float) -> DataFrame:
    """Verified pairs (a, b) of rows at most ``window`` apart in a pass's order."""
    parts = max(2, int(signed.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    schema = "kind int, task int, place int, a long, b long, pass int, label string, size int, x array<double>"

    def scan(batches):
        """Pairs of this partition (kind 0), and its first and last rows (kind 1 and 2)."""
        from pyspark import TaskContext

        task, forest = TaskContext.get().partitionId(), _Forest()
        held, first, number = None, None, 0

        def border(t: pa.Table, kind: int, place: list[int]):
            n = t.num_rows
            none = pa.nulls(n, pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array([kind] * n, pa.int32()), pa.array([task] * n, pa.int32()), pa.array(place, pa.int32()), t.column("id").combine_chunks(),
                 none, t.column("pass").combine_chunks(), t.column("label").combine_chunks(), pa.array([len(v) for v in t.column("x")], pa.int32()),
                 t.column("x").combine_chunks()], names=_NAMES)

        for batch in batches:
            t = pa.Table.from_batches([batch])
            old = held.num_rows if held is not None else 0
            t = pa.concat_tables([held, t]) if held is not None else t
            out = _pairs(t, window, cosine, forest, old)
            if first is None or first.num_rows < window:
                first = t.slice(0, window) if number == 0 or first is None else pa.concat_tables([first, t.slice(old, window - first.num_rows)])
            number += 1
            held = t.slice(max(0, t.num_rows - window))
            yield _edges(out)
        if held is not None:
            yield border(first, 1, list(range(window, window + first.num_rows)))
            yield border(held, 2, list(range(window - held.num_rows, window)))

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The last rows of one partition and the first of the next."""
        t = pa.Table.from_batches(list(batches)).sort_by("place")
        t = t.rename_columns({"a": "id"})
        old = int((t.column("kind").to_numpy() == 2).sum())
        found = _pairs(t, window, cosine, _Forest(), old) if 0 < old < t.num_rows else []
        yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in found], pa.int64()), pa.array([p[1] for p in found], pa.int64())], names=["a", "b"])

    ordered = signed.repartitionByRange(parts, "pass", "label", "key", "id").sortWithinPartitions("pass", "label", "key", "id")
    got = stored(ordered.mapInArrow(scan, schema), "neighbours")
    edges = got.where("kind = 0").select("a", "b")
    # Partitions without rows are skipped: the border of task k meets that of the next task that has one.
    rank = {t: i for i, t in enumerate(sorted(r["task"] for r in got.where("kind > 0").select("task").distinct().collect()))}
    seam = F.create_map(*[F.lit(v) for kv in rank.items() for v in kv])[F.col("task")] if rank else F.lit(0)
    borders = got.where("kind > 0").withColumn("seam", seam - F.when(F.col("kind") == 1, 1).otherwise(0))
    joined = borders.select("seam", "kind", "place", "a", "pass", "label", "size", "x").groupBy("seam").applyInArrow(across, "a long, b long")
    return edges.unionAll(joined)


_NAMES = ["kind", "task", "place", "a", "b", "pass", "label", "size", "x"]


def _edges(found: list[tuple[int, int]]) -> pa.RecordBatch:
    n = len(found)
    i32 = lambda v: pa.array([v] * n, pa.int32())
    return pa.RecordBatch.from_arrays(
        [i32(0), i32(None), i32(None), pa.array([p[0] for p in found], pa.int64()), pa.array([p[1] for p in found], pa.int64()), i32(None),
         pa.nulls(n, pa.string()), i32(None), pa.nulls(n, pa.list_(pa.float64()))], names=_NAMES)


def _pairs(t: pa.Table, window: int, cosine: float, forest: _Forest, old: int) -> list[tuple[int, int]]:
    """Verified pairs of a table in pass order, beyond those among its first ``old`` rows."""
    x = t.column("x").combine_chunks()
    size = np.diff(x.offsets.to_numpy()) if len(x) else np.zeros(0, np.int64)
    label = np.unique(t.column("label").to_numpy(zero_copy_only=False).astype(str), return_inverse=True)[1]
    group = np.unique(np.stack([t.column("pass").to_numpy(), label, size]), axis=1, return_inverse=True)[1].ravel() if len(x) else size
    ids, out = t.column("id").to_numpy(), []
    if len(set(size.tolist())) <= 1:
        return _compare(group, ids, _matrix(x), window, cosine, forest, old)
    for n in set(size.tolist()):  # other lengths are set apart
        on = np.flatnonzero(size == n)
        out += _compare(group[on], ids[on], _matrix(x.take(pa.array(on))), window, cosine, forest, int(np.searchsorted(on, old)))
    return out


def link_counts(grouped: DataFrame, cosine: float, block: int) -> DataFrame:
    """(id, links): for rows (component, id, copies, x), the copies of the other rows of the component
    within ``cosine``, by pairs of blocks."""
    sizes = grouped.groupBy("component").agg(F.count(F.lit(1)).alias("rows"))
    blocks = F.ceil(F.col("rows") / block).cast("int")
    spread = grouped.join(sizes, "component").withColumn("blocks", blocks)
    # Small components share tasks; a large one's rows are dealt to blocks and each block meets each.
    spread = spread.withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    met = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("component", "id", "copies", "x", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    tasks = F.when(F.col("j") > 0, F.xxhash64("component", "i", "j")).otherwise(F.pmod(F.xxhash64("component"), F.lit(4096)))

    def count(t: pa.Table) -> pa.Table:
        ids, copies, own = (t.column(c).to_numpy() for c in ("id", "copies", "own"))
        key = np.stack([t.column(c).to_numpy() for c in ("component", "i", "j")])
        part = np.unique(key, axis=1, return_inverse=True)[1].ravel()
        links = np.zeros(len(ids), np.int64)
        x = t.column("x").combine_chunks()
        order = np.argsort(part, kind="stable")
        for on in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
            v, i, j = _matrix(x.take(pa.array(on))), key[1][on[0]], key[2][on[0]]
            left, right = np.flatnonzero(own[on] == i), np.flatnonzero(own[on] == j)
            near = v[left] @ v[right].T >= cosine
            links[on[left]] += near @ copies[on][right]
            if i != j:
                links[on[right]] += near.T @ copies[on][left]
        return pa.table({"id": ids, "links": links})

    met = met.withColumn("task", tasks)
    return met.groupBy("task").applyInArrow(count, "id long, links long").groupBy("id").agg(F.sum("links").alias("links"))


def passes_for(rows: int) -> int:
    """Passes that keep the recall level: the more vectors a label has, the more stand between two near ones in a pass."""
    return PASSES + max(0, math.ceil(MORE_PASSES * math.log2(max(rows, 1) / PASSES_UP_TO)))


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, passes: int | None = None, window: int = WINDOW, block: int = BLOCK,
                    id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, n_links, component_id, kept for every row."""
    x = F.col(vec_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), x.alias("x"))
    bad = F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    some = F.exists("x", lambda v: v != 0)
    usable = F.coalesce(F.col("label").isNotNull() & (F.size("x") > 0) & ~bad & some, F.lit(False))
    # -0.0 equals 0.0, so both are one vector.
    rows = rows.withColumn("x", F.when(usable, F.transform("x", lambda v: F.when(v == 0, F.lit(0.0)).otherwise(v))))
    rows = rows.withColumn("digest", F.when(usable, F.struct("label", F.size("x").alias("n"), F.xxhash64("x").alias("h1"), F.hash("x").alias("h2"))))
    # id: a number of the distinct vector; least: the least vec_id among its copies.
    known = rows.where("digest is not null").groupBy("digest").agg(
        F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"), F.min_by("x", "vec_id").alias("x0"), F.first("x").alias("x1"))
    known = stored(known.select("digest", "copies", "least", F.col("digest.label").alias("label"), F.coalesce("x0", "x1").alias("x"),
                                F.xxhash64("digest").alias("id")), "vectors")
    if passes is None:
        passes = passes_for(known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0)
    signed = signatures(known, passes, HASH_BITS)
    found = components(neighbours(signed, window, cosine)).withColumnRenamed("component", "root")
    grouped = stored(known.join(found, "id").select(F.col("root").alias("component"), "id", "copies", "least", "x"), "grouped")
    named = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    counts = link_counts(grouped, cosine, block)
    linked = grouped.join(named, "component").join(counts, "id").select("id", "component_id", "links")
    per_vector = known.join(linked, "id", "left").select(
        "digest", (F.greatest(F.coalesce("links", F.lit(0)), F.col("copies")) - 1).alias("n_links"), F.coalesce("component_id", "least").alias("component_id"))
    out = rows.select("vec_id", "digest").join(per_vector, "digest", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
