"""Global ranks without a single-partition window.

``dense_rank() over (order by x)`` with no ``partitionBy`` moves every row to
one task.  Here the rows are range-partitioned, sorted inside each
partition, and written once with their partition and their place in it.  The
per-partition counts (one row per partition, so their size is bounded by the partition
count, not by the data) become offsets and are broadcast back.  Positions and
offsets are both read from the same stored rows: a range exchange samples its
bounds anew for each plan it is in, so counting in a second branch of one plan would give
duplicate and missing ranks.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from provisio.session import materialize

_POS_BITS = 33
_POS_MASK = (1 << _POS_BITS) - 1


def _sort_cols(order: Sequence[tuple[str, bool]]):
    return [F.col(c).desc_nulls_last() if desc else F.col(c).asc_nulls_last() for c, desc in order]


def _positions(keys: DataFrame, order: Sequence[tuple[str, bool]], out: str) -> DataFrame:
    """1-based position of each row of ``keys`` in the total ``order``.

    ``order`` must make rows unique (add a key as the last tie-breaker).
    Runs one job, which writes ``keys``.
    """
    cols = _sort_cols(order)
    n_parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_keys = keys.repartitionByRange(n_parts, *cols).sortWithinPartitions(*cols)
    with_id = materialize(
        sorted_keys
        .withColumn("_mid", F.monotonically_increasing_id())
        .withColumn("_pid", F.shiftright(F.col("_mid"), _POS_BITS))
        .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit(_POS_MASK))), "ranked")
    counts = with_id.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: bounded by spark.sql.shuffle.partitions
    offsets = counts.withColumn(
        "_off",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)))
    return (with_id.join(F.broadcast(offsets.select("_pid", "_off")), "_pid")
            .withColumn(out, (F.col("_off") + F.col("_pos") + 1).cast("long"))
            .drop("_mid", "_pid", "_pos", "_off"))


def global_dense_rank(df: DataFrame, value: str, out: str, descending: bool = True) -> DataFrame:
    """Add ``out`` = dense rank of ``value`` over the whole frame (NULLs last)."""
    distinct_vals = df.select(F.col(value).alias("_v")).distinct()
    ranked = _positions(distinct_vals, [("_v", descending)], out)
    # null-safe equi-join on the value; the value table has one row per distinct value
    return (df.join(ranked, on=F.col(value).eqNullSafe(F.col("_v")), how="left")
            .drop("_v"))


def global_row_number(df: DataFrame, order: Sequence[tuple[str, bool]], out: str) -> DataFrame:
    """Add ``out`` = 1..n in ``order``; ``order`` must end in a unique key."""
    return _positions(df, order, out)


def global_running_total(df: DataFrame, order: Sequence[tuple[str, bool]], weight: str, out: str) -> DataFrame:
    """Add ``out`` = the sum of ``weight`` up to and with each row in ``order`` (which must end in a unique key)."""
    cols = _sort_cols(order)
    n_parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stored = materialize(df.repartitionByRange(n_parts, *cols).sortWithinPartitions(*cols)
                         .withColumn("_pid", F.spark_partition_id()), "running")
    sums = stored.groupBy("_pid").agg(F.sum(weight).alias("_s"))
    # one row per partition: bounded by spark.sql.shuffle.partitions
    offsets = sums.select("_pid", F.coalesce(F.sum("_s").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    own = F.sum(weight).over(Window.partitionBy("_pid").orderBy(*cols).rowsBetween(Window.unboundedPreceding, 0))
    return (stored.withColumn("_own", own).join(F.broadcast(offsets), "_pid")
            .withColumn(out, F.col("_own") + F.col("_off")).drop("_own", "_off", "_pid"))
