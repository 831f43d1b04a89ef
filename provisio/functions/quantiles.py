"""Exact quantiles (linear interpolation, as pandas ``quantile``) without one-task buffers.

``percentile()`` keeps every distinct value of a group in one aggregation
buffer, and a group may hold a third of the data.  Here equal values are counted first, so a value that
a third of all rows share is one row; the distinct (group, value) pairs are put in order by range
partitioning, running counts give each pair the positions that it covers, and the pairs around each
wanted position are found by a join on the group.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provisio.functions.ranking import global_running_total


def grouped_quantiles(df: DataFrame, groups: Sequence[str], value: str,
                      qs: Sequence[float]) -> DataFrame:
    """Rows (groups..., q, value) with the exact linearly interpolated quantile."""
    groups = list(groups)
    vals = df.select(*groups, F.col(value).cast("double").alias("_x")).filter(F.col("_x").isNotNull())
    pairs = vals.groupBy(*groups, "_x").agg(F.count(F.lit(1)).alias("_c"))
    ranked = global_running_total(pairs, [(g, False) for g in groups] + [("_x", False)], "_c", "_upto")
    # one row per group: what lies before it in the global order, and its rows
    sizes = ranked.groupBy(*[F.col(g).alias(f"_g{k}") for k, g in enumerate(groups)]).agg(
        F.min(F.col("_upto") - F.col("_c")).alias("_off"), F.sum("_c").alias("_n"))
    wanted = (sizes.withColumn("q", F.explode(F.array(*[F.lit(float(q)) for q in qs])))
              .withColumn("_pos", (F.col("_n") - 1) * F.col("q"))
              .withColumn("_frac", F.col("_pos") - F.floor("_pos")))
    side = lambda name, at: F.struct(F.lit(name).alias("side"), (F.col("_off") + at.cast("long") + 1).alias("_rn"))
    picks = (wanted.withColumn("_p", F.explode(F.array(side("lo", F.floor("_pos")), side("hi", F.ceil("_pos")))))
             .select(*[f"_g{k}" for k in range(len(groups))], "q", "_frac", "_p.side", "_p._rn"))
    inside = (F.col("_rn") > F.col("_upto") - F.col("_c")) & (F.col("_rn") <= F.col("_upto"))
    for k, g in enumerate(groups):
        inside = inside & F.col(g).eqNullSafe(F.col(f"_g{k}"))
    # without groups, picks are two rows per quantile
    got = ranked.join(picks if groups else F.broadcast(picks), inside)
    res = got.groupBy(*groups, "q").agg(
        F.max(F.when(F.col("side") == "lo", F.col("_x"))).alias("_a"),
        F.max(F.when(F.col("side") == "hi", F.col("_x"))).alias("_b"),
        F.max("_frac").alias("_t"))
    return res.select(*groups, "q", (F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_t")).alias(value))


def quantile_scalar(df: DataFrame, value: str, q: float):
    """Scalar-subquery column with the exact quantile of one column."""
    return grouped_quantiles(df, [], value, [q]).select(value).scalar()
