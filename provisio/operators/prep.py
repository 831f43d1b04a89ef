"""Feature preparation for the models.

Statistics over the whole table (means, population standard deviations,
category codes) are scalar subqueries or small per-category tables; nothing is
collected to the driver.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provisio.functions.columns import finite0
from provisio.functions.quantiles import grouped_quantiles
from provisio.functions.ranking import global_row_number

# Model inputs of the reference (19 numeric + 3 encoded).
NUMERIC_FEATURES = ["qty_mean", "qty_std", "demand_variability", "revenue_per_unit", "profit_margin",
                    "order_frequency", "demand_growth_mean", "demand_trend_slope", "current_inventory",
                    "stockout_frequency", "low_stock_frequency", "fulfillment_days", "on_time_mean",
                    "delivery_reliability", "safety_stock", "reorder_point", "eoq", "days_supply",
                    "priority_score"]
CATEGORICAL = ["abc_category", "stock_status", "recommended_action"]
ENCODED = [f"{c}_encoded" for c in CATEGORICAL]
ML_COLUMNS = NUMERIC_FEATURES + ENCODED
TEST_PERCENT = 20


def label_encode(df: DataFrame, columns: Sequence[str] = CATEGORICAL) -> DataFrame:
    """alphabetical integer codes (LabelEncoder), ranked and joined without a bound on the labels."""
    out = df
    for c in columns:
        values = df.select(F.col(c).cast("string").alias("_v")).distinct()
        codes = global_row_number(values, [("_v", False)], "_code").select("_v", (F.col("_code") - 1).cast("int").alias(f"{c}_encoded"))
        out = out.join(codes, F.col(c).cast("string").eqNullSafe(F.col("_v")), "left").drop("_v")
    return out


def ml_features_raw(policy: DataFrame) -> DataFrame:
    """Encoded categoricals, existing feature columns, inf/NaN -> 0."""
    enc = label_encode(policy)
    cols = [c for c in ML_COLUMNS if c in enc.columns]
    return enc.select("product_id", *[finite0(c).alias(c) for c in cols])


def zscore_pop(df: DataFrame, columns: Sequence[str], digits: int | None = None) -> DataFrame:
    """(x - mean) / population std; a constant column becomes 0 (sklearn StandardScaler).

    Means and standard deviations of all columns come from ONE aggregate pass;
    the single row of statistics (2 numbers per column) is read on the driver,
    as Spark ML's own scalers do, and applied as literals."""
    stats = df.agg(*[F.avg(c).alias(f"m_{k}") for k, c in enumerate(columns)],
                   *[F.stddev_pop(c).alias(f"s_{k}") for k, c in enumerate(columns)]).first()
    cols = []
    for k, c in enumerate(columns):
        mu, sd = stats[f"m_{k}"], stats[f"s_{k}"]
        if sd is None or sd == 0:
            z = F.lit(0.0)
        else:
            z = (F.col(c) - F.lit(mu)) / F.lit(sd)
        cols.append((F.bround(z, digits) if digits is not None else z).alias(c))
    keep = [c for c in df.columns if c not in columns]
    return df.select(*keep, *cols)


def ml_features(policy: DataFrame, digits: int | None = None) -> DataFrame:
    """the standardized ML feature table."""
    raw = ml_features_raw(policy)
    return zscore_pop(raw, [c for c in ML_COLUMNS if c in raw.columns], digits)


def split_flag(key: str = "product_id", test_percent: int = TEST_PERCENT) -> F.Column:
    """deterministic 80/20 split by the md5 digest of the key's text (any key type; same rule in SQL)."""
    digest = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("long")
    return digest % 100 < test_percent


def train_test_split(df: DataFrame, key: str = "product_id") -> DataFrame:
    return df.withColumn("is_test", split_flag(key))


def training_rows(df: DataFrame, target: str) -> DataFrame:
    """Drop rows whose target is missing or NaN."""
    return df.filter(F.col(target).isNotNull() & ~F.isnan(F.col(target)))


def reliability_class(df: DataFrame, col: str = "delivery_reliability") -> DataFrame:
    """F8: Poor (0, .7], Average (.7, .9], Good (.9, 1]; 0 and anything outside -> NULL."""
    x = F.col(col)
    return df.withColumn("reliability_class",
                         F.when((x > 0) & (x <= 0.7), "Poor").when((x > 0.7) & (x <= 0.9), "Average")
                          .when((x > 0.9) & (x <= 1.0), "Good"))


# The inputs of the reference's supplier models.
SUPPLIER_FEATURES = ["qty_mean", "qty_std", "sales_sum", "current_inventory", "stockout_frequency", "demand_variability",
                     "fulfillment_days", "priority_score"]


def supplier_dataset(products: DataFrame) -> DataFrame:
    """The supplier models' table at product grain: eight features, the reliability and its class;
    rows with any missing value dropped."""
    columns = [*SUPPLIER_FEATURES, "delivery_reliability"]
    return reliability_class(products.select("product_id", *[F.col(c).cast("double").alias(c) for c in columns]).na.drop())


def minmax_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """F9 (declared): (x - min) / (max - min); constant -> 0 (one aggregate pass for the bounds)."""
    b = df.agg(*[F.min(c).alias(f"mn_{k}") for k, c in enumerate(columns)],
               *[F.max(c).alias(f"mx_{k}") for k, c in enumerate(columns)]).first()
    out = df
    for k, c in enumerate(columns):
        mn, mx = b[f"mn_{k}"], b[f"mx_{k}"]
        out = out.withColumn(f"{c}_minmax", F.lit(0.0) if mx == mn else (F.col(c) - F.lit(mn)) / F.lit(mx - mn))
    return out


def robust_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """F9 (declared): (x - median) / IQR with exact quantiles; IQR 0 -> x - median."""
    long = df.unpivot([], list(columns), "feature", "value")
    q = (grouped_quantiles(long, ["feature"], "value", [0.25, 0.5, 0.75]).groupBy("feature")
         .agg(F.max(F.when(F.col("q") == 0.25, F.col("value"))).alias("q1"),
              F.max(F.when(F.col("q") == 0.5, F.col("value"))).alias("med"),
              F.max(F.when(F.col("q") == 0.75, F.col("value"))).alias("q3")))
    out = df
    for c in columns:
        row = q.filter(F.col("feature") == c)
        med = row.select("med").scalar()
        iqr = row.select(F.col("q3") - F.col("q1")).scalar()
        out = out.withColumn(f"{c}_robust", F.when(iqr == 0, F.col(c) - med).otherwise((F.col(c) - med) / iqr))
    return out


def one_hot(df: DataFrame, column: str, max_values: int = 1000) -> DataFrame:
    """F10 (declared): one indicator column per category value (values known from the schema of the
    categorical: they are read from a small distinct table)."""
    found = df.select(column).where(F.col(column).isNotNull()).distinct().limit(max_values + 1).collect()
    if len(found) > max_values:  # each would be a column
        raise ValueError(f"{column} has over {max_values} values; encode it by its target mean instead")
    values = sorted(r[0] for r in found)
    out = df
    for v in values:
        out = out.withColumn(f"{column}_{v}", (F.col(column) == v).cast("int"))
    return out


def target_encode(df: DataFrame, column: str, target: str) -> DataFrame:
    """F10 (declared): mean target per category, joined back."""
    means = df.groupBy(column).agg(F.avg(target).alias(f"{column}_target_mean"))
    return df.join(means, column, "left")
