"""Connected components of an edge table, by alternating large-star and small-star steps.

Each round is two aggregates and two joins on the edges, ends when every edge points at a root, and writes its
edges to the shared folder, so lineage stays short and a lost executor costs one
round at most.  A hub that a third of all edges meet is one partial minimum per
task in the aggregates; the joins are plain equi-joins, whose hot keys Spark splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provisio.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def _flat(edges: DataFrame) -> bool:
    """Whether every edge points at a root: no id points at two others, or is pointed at and points on."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")),
                                          F.struct(F.col("b").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("e"))
    ids = ends.groupBy("e.id").agg(F.sum("e.up").alias("up"), F.max("e.down").alias("down"))
    return ids.where("up > 1 or (up = 1 and down = 1)").isEmpty()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): every id of an edge and the least id it reaches.

    Null ids and loops are ignored; edges may repeat and point either way."""
    own = edges.select(F.greatest(F.col(a), F.col(b)).alias("a"), F.least(F.col(a), F.col(b)).alias("b"))
    known = stored(own.where("a is not null and b is not null and a != b").distinct(), "edges")
    while not _flat(known):
        known = stored(_small_star(_large_star(known)), "edges")
    ids = known.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return ids.unionAll(known.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
