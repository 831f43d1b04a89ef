"""Data-quality checks on the input tables (Q1-Q5, Q8, Q11-Q13, IO14).

Each check is ONE aggregate pass over its table (``count_if`` per column),
unpivoted to a long table afterwards; per-table reports are combined with
``unionByName``.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from provisio.operators.explore import numeric_columns

# Declared thresholds and range rules.
MAX_MISSING_PCT = 20.0
MAX_DUPLICATE_PCT = 5.0
RANGE_RULES = {
    "orders": [("qty", 1.0, 10000.0)],
    "inventory": [("unit_cost", 0.01, 1000.0), ("inventory", 0.0, None)],
}


def dq_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Q1: rows and columns per table."""
    out = None
    for name, df in tables.items():
        r = df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("dataset"), "rows", F.lit(len(df.columns)).alias("columns"))
        out = r if out is None else out.unionByName(r)
    return out


def dq_missing(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Q2: missing values per column (NULL, and NaN for floating columns)."""
    out = None
    for name, df in tables.items():
        dtypes = dict(df.dtypes)

        def miss(c):
            x = F.col(c)
            if dtypes[c] in ("double", "float"):
                return F.count_if(x.isNull() | F.isnan(x))
            return F.count_if(x.isNull())
        row = df.agg(*[miss(c).alias(c) for c in df.columns])
        long = row.unpivot([], df.columns, "column", "missing").withColumn("dataset", F.lit(name))
        out = long if out is None else out.unionByName(long)
    return out


def dq_duplicates(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Q3: fully duplicated rows beyond the first copy (group by all columns, null-safe)."""
    out = None
    for name, df in tables.items():
        groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_c"))
        r = groups.agg(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).cast("long").alias("duplicates"),
                       F.coalesce(F.sum("_c"), F.lit(0)).cast("long").alias("rows"))
        r = r.withColumn("dataset", F.lit(name))
        out = r if out is None else out.unionByName(r)
    return out


def dq_negatives(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Q4: negative values per numeric column; only columns with at least one."""
    out = None
    for name, df in tables.items():
        nums = numeric_columns(df)
        if not nums:
            continue
        row = df.agg(*[F.count_if(F.col(c) < 0).alias(c) for c in nums])
        long = (row.unpivot([], nums, "column", "negatives").filter(F.col("negatives") > 0)
                .withColumn("dataset", F.lit(name)))
        out = long if out is None else out.unionByName(long)
    return out


def profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, columns, duplicates and missing values of each table from ONE scan of it.

    Equal rows are counted first (partial in each task, then by the whole row, so a row that a third of the table
    repeats is one row per task), and everything else is weighted by these counts."""
    out = None
    for name, df in tables.items():
        floating = {c for c, t in df.dtypes if t in ("double", "float")}
        missing = [F.sum(F.when((F.col(c).isNull() | F.isnan(c)) if c in floating else F.col(c).isNull(), F.col("_c")).otherwise(0)).alias(f"_m{k}")
                   for k, c in enumerate(df.columns)]
        row = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_c")).agg(
            F.coalesce(F.sum("_c"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).alias("duplicates"), *missing)
        each = [F.coalesce(F.col(f"_m{k}"), F.lit(0)) for k in range(len(df.columns))]
        r = row.select(F.lit(name).alias("dataset"), "rows", F.lit(len(df.columns)).alias("columns"), "duplicates",
                       sum(each, F.lit(0)).cast("long").alias("missing_values"), F.array_max(F.array(*each)).alias("max_missing"))
        out = r if out is None else out.unionByName(r)
    return out


def lineage(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Q5, U4, IO7: per-dataset quality summary unioned, with the total record count."""
    everything = Window.partitionBy(F.lit(0))       # one row a table
    return (profile(tables).drop("max_missing").withColumn("total_records", F.sum("rows").over(everything))
            .withColumn("datasets", F.lit(len(tables)))
            .withColumn("status", F.lit("completed")))


#: how the lineage of one run is nested in its JSON document
LINEAGE_DOCUMENT = ("status string, total_records long, datasets int, "
                    "quality array<struct<dataset:string,rows:long,columns:int,duplicates:long,missing_values:long>>")


def lineage_document(found: DataFrame) -> DataFrame:
    """IO7: one JSON document of all tables' quality (``document``), from the rows of ``lineage``."""
    each = F.struct("dataset", "rows", "columns", "duplicates", "missing_values")
    whole = found.groupBy("status", "total_records", "datasets").agg(F.sort_array(F.collect_list(each)).alias("quality"))
    return whole.select(F.to_json(F.struct("status", "total_records", "datasets", "quality")).alias("document"))


def lineage_rows(documents: DataFrame) -> DataFrame:
    """The rows of ``lineage`` from its JSON documents."""
    read = documents.select(F.from_json("document", LINEAGE_DOCUMENT).alias("d")).select("d.*")
    return read.select("status", "total_records", "datasets", F.explode("quality").alias("q")).select("q.*", "total_records", "datasets", "status")


def dq_gate(tables: Mapping[str, DataFrame], max_missing_pct: float = MAX_MISSING_PCT,
            max_duplicate_pct: float = MAX_DUPLICATE_PCT) -> DataFrame:
    """Q11 (declared): missing share per column <= 20%, duplicate rows <= 5% per table."""
    return (profile(tables).withColumn("max_missing_pct", F.try_divide(F.col("max_missing"), F.col("rows")) * 100.0)
            .withColumn("duplicate_pct", F.try_divide(F.col("duplicates"), F.col("rows")) * 100.0)
            .withColumn("passed", (F.col("max_missing_pct") <= max_missing_pct)
                        & (F.col("duplicate_pct") <= max_duplicate_pct))
            .select("dataset", "rows", "max_missing_pct", "duplicate_pct", "passed"))


def range_violations(df: DataFrame, rules: Sequence[tuple[str, float | None, float | None]]) -> DataFrame:
    """Q12: rows that break any (column, low, high) rule, with the rule broken."""
    conds = []
    for c, lo, hi in rules:
        x = F.col(c)
        bad = F.lit(False)
        if lo is not None:
            bad = bad | (x < lo)
        if hi is not None:
            bad = bad | (x > hi)
        conds.append(F.when(bad, F.lit(c)))
    broken = F.filter(F.array(*conds), lambda v: v.isNotNull())
    return df.withColumn("broken_rules", broken).filter(F.size("broken_rules") > 0)


def dq_range_rules(tables: Mapping[str, DataFrame], rules=RANGE_RULES) -> DataFrame:
    """Q12 (declared): counts of rows outside the declared ranges per table and column; one scan of a table for all its rules."""
    out = None
    for name, df in tables.items():
        bad = []
        for c, lo, hi in rules.get(name, []):
            low = F.col(c) < lo if lo is not None else F.lit(False)
            bad.append((c, low | (F.col(c) > hi) if hi is not None else low))
        if not bad:
            continue
        row = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(b).alias(f"_v{k}") for k, (_, b) in enumerate(bad)])
        each = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_v{k}").alias("violations")) for k, (c, _) in enumerate(bad)]))
        r = row.select("rows", each.alias("v")).select(F.lit(name).alias("dataset"), "v.column", "v.violations", "rows")
        out = r if out is None else out.unionByName(r)
    return out


def validate_outputs(features: DataFrame, ml: DataFrame) -> DataFrame:
    """Q8: shapes, missing totals, distinct products, non-empty flags of the two feature tables."""
    def one(name, df):
        miss = sum((F.count_if(F.col(c).isNull()) for c in df.columns), F.lit(0))
        return df.agg(F.count(F.lit(1)).alias("rows"), miss.alias("missing_values"),
                      F.count_distinct("product_id").alias("products")).select(
            F.lit(name).alias("table"), "rows", F.lit(len(df.columns)).alias("columns"),
            "missing_values", "products", (F.col("rows") > 0).alias("non_empty"))
    return one("procurement_features", features).unionByName(one("ml_features", ml))


def input_profile(tables: Mapping[str, DataFrame], expected: Sequence[str]) -> DataFrame:
    """IO14: rows and columns per input; expected inputs that are absent are listed with 0 rows."""
    present = dq_report(tables).withColumn("present", F.lit(True))
    out = present
    for name in expected:
        if name not in tables:
            miss = present.limit(1).select(F.lit(name).alias("dataset"), F.lit(0).cast("long").alias("rows"),
                                           F.lit(0).alias("columns"), F.lit(False).alias("present"))
            out = out.unionByName(miss)
    total = present.select(F.sum("rows")).scalar()
    return out.withColumn("total_rows", total)
