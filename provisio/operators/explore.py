"""Exploratory queries over the product table and the order lines.

All of these are aggregates or top-k's on product-grain data or single
aggregates over the order lines; wide statistics (correlations, moments,
completeness) are computed in ONE aggregate pass and unpivoted afterwards.
Money totals are summed as decimals so the result does not depend on the
order in which partitions are combined.
"""

from __future__ import annotations

from itertools import combinations
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from provisio.functions.columns import ratio
from provisio.functions.quantiles import grouped_quantiles, quantile_scalar

# The columns the reference studies.
CORRELATION_FEATURES = ["qty_mean", "sales_sum", "profit_sum", "current_inventory", "stockout_frequency",
                        "demand_variability", "fulfillment_days", "delivery_reliability", "reorder_point",
                        "safety_stock", "eoq", "priority_score"]
OUTLIER_COLUMNS = ["qty_sum", "sales_sum", "current_inventory", "priority_score"]
ML_NUMERIC = ["qty_mean", "qty_std", "demand_variability", "revenue_per_unit", "profit_margin",
              "order_frequency", "demand_growth_mean", "demand_trend_slope", "current_inventory",
              "stockout_frequency", "low_stock_frequency", "fulfillment_days", "on_time_mean",
              "delivery_reliability", "safety_stock", "reorder_point", "eoq", "days_supply", "priority_score"]
TARGETS = ["qty_mean", "stockout_frequency", "delivery_reliability"]
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
STRONG_CORRELATION = 0.7
IQR_FACTOR = 1.5


def money(c: str, scale: int = 2):
    return F.col(c).cast(f"decimal(22,{scale})")


def rnd(c, k: int = 6):
    c = F.col(c) if isinstance(c, str) else c
    return F.bround(c.cast("double"), k)


def portfolio_kpis(policy: DataFrame) -> DataFrame:
    """Products, revenue, profit, margin %, average priority."""
    return (policy.agg(F.count_distinct("product_id").alias("total_products"),
                       F.sum(money("sales_sum")).alias("_rev"),
                       F.sum(money("profit_sum", 4)).alias("_prof"),
                       F.avg("priority_score").alias("_prio"))
            .select("total_products",
                    F.col("_rev").cast("double").alias("total_revenue"),
                    F.col("_prof").cast("double").alias("total_profit"),
                    rnd(ratio(F.col("_prof").cast("double"), F.col("_rev").cast("double")) * 100.0).alias("profit_margin_pct"),
                    rnd("_prio").alias("avg_priority_score")))


def stock_counts(policy: DataFrame) -> DataFrame:
    """Products per stock status, share of products, stockout rate."""
    n = F.count(F.lit(1))
    st = F.col("stock_status")
    return policy.agg(
        n.alias("products"),
        F.count_if(st == "Reorder_Required").alias("reorder_required"),
        F.count_if(st == "Stockout").alias("stockout"),
        F.count_if(st == "Overstock").alias("overstock"),
        F.count_if(st == "Normal").alias("normal"),
        (F.count_if(st == "Reorder_Required") / n * 100.0).alias("reorder_pct"),
        (F.count_if(st == "Stockout") / n * 100.0).alias("stockout_pct"),
        (F.count_if(st == "Overstock") / n * 100.0).alias("overstock_pct"),
        (F.count_if(st == "Stockout") / n).alias("stockout_rate"))


def abc_summary(policy: DataFrame) -> DataFrame:
    """Products and revenue share per ABC class (totals as scalar subqueries)."""
    total_n = policy.select(F.count(F.lit(1))).scalar()
    total_rev = policy.select(F.sum(money("sales_sum"))).scalar()
    return (policy.groupBy("abc_category")
            .agg(F.count(F.lit(1)).alias("products"), F.sum(money("sales_sum")).alias("_rev"))
            .select("abc_category", "products",
                    (F.col("products") / total_n * 100.0).alias("product_pct"),
                    F.col("_rev").cast("double").alias("revenue"),
                    (F.col("_rev").cast("double") / total_rev.cast("double") * 100.0).alias("revenue_pct")))


def monthly_orders(lines: DataFrame) -> DataFrame:
    """Quantity, sales and distinct orders per calendar month."""
    return (lines.groupBy(F.date_trunc("month", F.col("order_date")).cast("timestamp_ntz").alias("month"))
            .agg(F.sum("qty").alias("qty"), F.sum("sales").cast("double").alias("sales"),
                 F.count_distinct("order_id").alias("orders")))


def peak_months(lines: DataFrame) -> DataFrame:
    """Month of highest quantity and of highest revenue (earliest on ties)."""
    m = monthly_orders(lines)
    return m.agg(F.max_by("month", F.struct("qty", -F.unix_timestamp("month"))).alias("peak_qty_month"),
                 F.max("qty").alias("peak_qty"),
                 F.max_by("month", F.struct("sales", -F.unix_timestamp("month"))).alias("peak_sales_month"),
                 F.max("sales").alias("peak_sales"))


def seasonality(lines: DataFrame) -> DataFrame:
    """Quantity by month, by quarter and by weekday (Mon..Sun), with the extremes flagged."""
    # one scan: at most 12 x 7 cells, which are then added up by each dimension
    cells = lines.groupBy("month", "quarter", "day_of_week").agg(F.sum("qty").alias("qty"))
    each = F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(c).alias("key"))
                               for d, c in (("month", "month"), ("quarter", "quarter"), ("weekday", "day_of_week"))]))
    u = cells.select("qty", each.alias("e")).groupBy("e.dimension", "e.key").agg(F.sum("qty").alias("qty"))
    names = F.when(F.col("dimension") == "weekday",
                   F.element_at(F.array(*[F.lit(d) for d in WEEKDAYS]), F.col("key") + 1))
    # at most 12 + 4 + 7 rows: the window over a dimension is tiny by construction
    from pyspark.sql import Window
    w = Window.partitionBy("dimension")
    return (u.withColumn("label", F.coalesce(names, F.col("key").cast("string")))
            .withColumn("is_peak", (F.col("qty") == F.max("qty").over(w)).cast("int"))
            .withColumn("is_low", (F.col("qty") == F.min("qty").over(w)).cast("int"))
            .select("dimension", "key", "label", "qty", "is_peak", "is_low"))


def department_performance(lines: DataFrame, top: int = 10) -> DataFrame:
    """Quantity, sales, profit, distinct products, margin % per department; top by sales."""
    agg = (lines.groupBy("department")
           .agg(F.sum("qty").alias("qty"), F.sum("sales").alias("_s"), F.sum("profit").alias("_p"),
                F.count_distinct("product_id").alias("products"))
           .select("department", "qty", F.col("_s").cast("double").alias("sales"),
                   F.col("_p").cast("double").alias("profit"), "products",
                   rnd(ratio(F.col("_p").cast("double"), F.col("_s").cast("double")) * 100.0, 2).alias("margin_pct")))
    return agg.orderBy(F.col("sales").desc(), F.col("department")).limit(top)


def department_monthly(lines: DataFrame, top: int = 8) -> DataFrame:
    """Monthly quantity of the `top` departments by number of order lines."""
    top_depts = (lines.groupBy("department").agg(F.count(F.lit(1)).alias("n"))
                 .orderBy(F.col("n").desc(), F.col("department")).limit(top).select("department"))
    # top-k result: at most `top` rows, so broadcasting it is bounded
    return (lines.join(F.broadcast(top_depts), "department", "left_semi")
            .groupBy("department", F.date_trunc("month", "order_date").cast("timestamp_ntz").alias("month"))
            .agg(F.sum("qty").alias("qty")))


def action_summary(policy: DataFrame) -> DataFrame:
    """Products per recommended action and share of all products."""
    total = policy.select(F.count(F.lit(1))).scalar()
    return (policy.groupBy("recommended_action").agg(F.count(F.lit(1)).alias("products"))
            .withColumn("pct", F.col("products") / total * 100.0))


def top_products(policy: DataFrame, names: DataFrame, k: int = 10) -> DataFrame:
    """Top k by revenue and top k by volume (ties by product id), name cut to 30 chars."""
    base = policy.select("product_id", "sales_sum", "qty_sum", "abc_category").join(names, "product_id", "left")
    by_rev = (base.orderBy(F.col("sales_sum").desc(), "product_id").limit(k)
              .withColumn("ranking", F.lit("revenue")))
    by_vol = (base.orderBy(F.col("qty_sum").desc(), "product_id").limit(k)
              .withColumn("ranking", F.lit("volume")))
    return (by_rev.unionByName(by_vol)
            .withColumn("name_prefix", F.substring("name", 1, 30)).drop("name"))


def delivery_extremes(policy: DataFrame) -> DataFrame:
    """5 best / 5 worst reliability, 10 best / 10 worst on-time rate."""
    cols = ["product_id", "delivery_reliability", "on_time_mean", "fulfillment_days"]
    p = policy.select(*cols)
    parts = [
        p.orderBy(F.col("delivery_reliability").desc(), "product_id").limit(5).withColumn("list", F.lit("best_reliability")),
        p.orderBy(F.col("delivery_reliability").asc(), "product_id").limit(5).withColumn("list", F.lit("worst_reliability")),
        p.orderBy(F.col("on_time_mean").desc(), "product_id").limit(10).withColumn("list", F.lit("best_on_time")),
        p.orderBy(F.col("on_time_mean").asc(), "product_id").limit(10).withColumn("list", F.lit("worst_on_time")),
    ]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def growth_extremes(policy: DataFrame, up: float = 0.1, down: float = -0.1, top: int = 15) -> DataFrame:
    """Every product growing > 0.1 or declining < -0.1, plus the top 15 by growth."""
    p = policy.select("product_id", "demand_growth_mean", "qty_mean", "stock_status")
    high = p.filter(F.col("demand_growth_mean") > up).withColumn("list", F.lit("high_growth"))
    low = p.filter(F.col("demand_growth_mean") < down).withColumn("list", F.lit("declining"))
    best = (p.orderBy(F.col("demand_growth_mean").desc(), "product_id").limit(top)
            .withColumn("list", F.lit("top_growth")))
    return high.unionByName(low).unionByName(best)


def high_risk_products(policy: DataFrame, freq: float = 0.2) -> DataFrame:
    """Stockout frequency > 0.2 or stock at/below reorder point, by priority (desc)."""
    return (policy.filter((F.col("stockout_frequency") > freq)
                          | (F.col("current_inventory") <= F.col("reorder_point")))
            .select("product_id", "stockout_frequency", "current_inventory", "reorder_point",
                    "priority_score", "stock_status")
            .orderBy(F.col("priority_score").desc(), "product_id"))


def insight_counts(policy: DataFrame) -> DataFrame:
    """Growth opportunities in class A, revenue in overstock, unreliable deliveries."""
    return policy.agg(
        F.count_if((F.col("demand_growth_mean") > 0.1) & (F.col("abc_category") == "A")).alias("high_opportunity"),
        F.coalesce(F.sum(F.when(F.col("stock_status") == "Overstock", money("sales_sum"))),
                   F.lit(0)).cast("double").alias("overstock_value"),
        F.count_if(F.col("delivery_reliability") < 0.8).alias("poor_suppliers"),
        F.count_if(F.col("stock_status") == "Stockout").alias("urgent_products"))


def metric_plausibility(policy: DataFrame) -> DataFrame:
    """How many reorder points, EOQs and safety stocks fall in a plausible range."""
    rop, eoq, ss = F.col("reorder_point"), F.col("eoq"), F.col("safety_stock")
    return policy.agg(
        F.count(F.lit(1)).alias("products"),
        F.count_if((rop > 0) & (rop <= F.col("qty_sum"))).alias("reasonable_reorder"),
        F.count_if((eoq > 0) & (eoq <= F.col("qty_sum") * 2)).alias("reasonable_eoq"),
        F.count_if((ss >= 0) & (ss <= F.col("qty_mean") * 2)).alias("reasonable_safety"))


def efficiency_metrics(policy: DataFrame) -> DataFrame:
    """Quantity per unit of stock, profit per stock value."""
    return policy.select(
        "product_id",
        (F.col("qty_sum") / (F.col("current_inventory") + 1.0)).alias("inventory_efficiency"),
        (F.col("profit_sum") / (F.col("current_unit_cost") * F.col("current_inventory") + 1.0))
        .alias("cost_efficiency"))


def class_quartiles(policy: DataFrame, columns: Sequence[str] = ("safety_stock", "fulfillment_days")) -> DataFrame:
    """Per ABC class box statistics (exact, linearly interpolated percentiles)."""
    aggs = []
    for c in columns:
        aggs += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    out = policy.groupBy("abc_category").agg(*aggs)
    for c in columns:
        q = (grouped_quantiles(policy, ["abc_category"], c, [0.25, 0.5, 0.75])
             .groupBy("abc_category")
             .agg(rnd(F.max(F.when(F.col("q") == 0.25, F.col(c)))).alias(f"{c}_q1"),
                  rnd(F.max(F.when(F.col("q") == 0.5, F.col(c)))).alias(f"{c}_median"),
                  rnd(F.max(F.when(F.col("q") == 0.75, F.col(c)))).alias(f"{c}_q3")))
        out = out.join(q, "abc_category", "left")
    return out


def histograms(policy: DataFrame, columns: Sequence[str] = ("priority_score", "eoq", "delivery_reliability",
                                                             "demand_growth_mean"), bins: int = 25) -> DataFrame:
    """Equal-width histogram over [min, max] per column (last bin closed).

    Columns are unpivoted to (feature, value); min/max per feature are a
    small table (one row per feature) joined back by feature."""
    long = policy.unpivot([], list(columns), "feature", "value").filter(F.col("value").isNotNull())
    bounds = long.groupBy("feature").agg(F.min("value").alias("mn"), F.max("value").alias("mx"))
    width = (F.col("mx") - F.col("mn")) / F.lit(float(bins))
    b = (F.when(width == 0, F.lit(0))
         .when(F.col("value") >= F.col("mx"), F.lit(bins - 1))
         .otherwise(F.floor((F.col("value") - F.col("mn")) / width).cast("int")))
    return (long.join(F.broadcast(bounds), "feature").withColumn("bin", b)
            .groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("count")))


def correlation_matrix(policy: DataFrame, features: Sequence[str] = CORRELATION_FEATURES) -> DataFrame:
    """Pearson correlation of every pair, ONE aggregate pass, unpivoted to (f1, f2, r)."""
    pairs = list(combinations(features, 2)) + [(f, f) for f in features]
    row = policy.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    long = row.unpivot([], [f"{a}|{b}" for a, b in pairs], "pair", "r")
    long = long.select(F.split("pair", r"\|").alias("p"), "r")
    upper = long.select(F.col("p")[0].alias("feature1"), F.col("p")[1].alias("feature2"), rnd("r").alias("correlation"))
    lower = (upper.filter(F.col("feature1") != F.col("feature2"))
             .select(F.col("feature2").alias("feature1"), F.col("feature1").alias("feature2"), "correlation"))
    return upper.unionByName(lower)


def strong_correlations(policy: DataFrame, threshold: float = STRONG_CORRELATION, top: int = 5) -> DataFrame:
    """Pairs (upper triangle) with |r| > 0.7, the 5 strongest."""
    pairs = list(combinations(CORRELATION_FEATURES, 2))
    order = {f"{a}|{b}": i for i, (a, b) in enumerate(pairs)}
    row = policy.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    long = row.unpivot([], list(order), "pair", "r").filter(F.abs("r") > threshold)
    pos = F.create_map(*[x for k, i in order.items() for x in (F.lit(k), F.lit(i))])
    return (long.withColumn("pair_index", pos[F.col("pair")])
            .orderBy(F.abs("r").desc(), "pair_index").limit(top)
            .select(F.split("pair", r"\|")[0].alias("feature1"), F.split("pair", r"\|")[1].alias("feature2"),
                    rnd("r").alias("correlation")))


def target_correlations(policy: DataFrame) -> DataFrame:
    """|corr| between every ML feature and each of the three targets."""
    pairs = [(f, t) for t in TARGETS for f in ML_NUMERIC if f != t]
    row = policy.agg(*[F.corr(f, t).alias(f"{f}|{t}") for f, t in pairs])
    long = row.unpivot([], [f"{f}|{t}" for f, t in pairs], "pair", "r")
    return long.select(F.split("pair", r"\|")[0].alias("feature"), F.split("pair", r"\|")[1].alias("target"),
                       rnd(F.abs("r")).alias("abs_correlation"))


def iqr_outliers(policy: DataFrame, columns: Sequence[str] = OUTLIER_COLUMNS, k: float = IQR_FACTOR) -> DataFrame:
    """Q9: quartiles (pandas linear interpolation), bounds and outlier counts per column.

    One long (feature, value) table; quartiles come from one distributed
    ranking job for all columns; bounds (one row per feature) are joined back."""
    long = policy.unpivot([], list(columns), "feature", "value")
    n = policy.select(F.count(F.lit(1))).scalar()
    q = (grouped_quantiles(long, ["feature"], "value", [0.25, 0.75]).groupBy("feature")
         .agg(F.max(F.when(F.col("q") == 0.25, F.col("value"))).alias("q1"),
              F.max(F.when(F.col("q") == 0.75, F.col("value"))).alias("q3"))
         .withColumn("lo", F.col("q1") - (F.col("q3") - F.col("q1")) * k)
         .withColumn("hi", F.col("q3") + (F.col("q3") - F.col("q1")) * k))
    x = F.col("value")
    return (long.join(F.broadcast(q), "feature")
            .groupBy("feature", "q1", "q3", "lo", "hi")
            .agg(F.count_if((x < F.col("lo")) | (x > F.col("hi"))).alias("outliers"))
            .select("feature", "outliers", rnd("q1").alias("q1"), rnd("q3").alias("q3"),
                    rnd("lo").alias("lower"), rnd("hi").alias("upper"),
                    (F.col("outliers") / n * 100.0).alias("pct")))


def skewed_features(ml: DataFrame, columns: Sequence[str] = ML_NUMERIC, threshold: float = 1.0) -> DataFrame:
    """Q10: population skewness (scipy default) of each feature, |skew| > 1 kept."""
    row = ml.agg(*[F.skewness(c).alias(c) for c in columns])
    long = row.unpivot([], list(columns), "feature", "skewness")
    return (long.filter(F.abs("skewness") > threshold)
            .select("feature", rnd("skewness", 4).alias("skewness")))


def numeric_columns(df: DataFrame) -> list[str]:
    """Numeric columns by type."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def dq_score(df: DataFrame, key: str = "product_id",
             checked: Sequence[str] | None = None) -> DataFrame:
    """Q6: completeness, uniqueness of the key, consistency (no negative quantity/sales/inventory), mean."""
    cols = df.columns
    nums = numeric_columns(df)
    checked = list(checked) if checked is not None else [
        c for c in nums if any(s in c for s in ("qty", "sales", "inv"))]
    n = F.count(F.lit(1))
    missing = sum((F.count_if(F.col(c).isNull()) for c in cols), F.lit(0))
    negatives = sum((F.count_if(F.col(c) < 0) for c in checked), F.lit(0))
    completeness = (n * len(cols) - missing) / (n * len(cols)) * 100.0
    uniqueness = F.count_distinct(key) / n * 100.0
    consistency = (n * len(nums) - negatives) / (n * len(nums)) * 100.0
    return (df.agg(completeness.alias("completeness"), uniqueness.alias("uniqueness"),
                   consistency.alias("consistency"))
            .withColumn("overall", rnd((F.col("completeness") + F.col("uniqueness") + F.col("consistency")) / 3.0)))


def feature_completeness(df: DataFrame) -> DataFrame:
    """Q7: non-missing share per numeric column, ascending."""
    nums = numeric_columns(df)
    row = df.agg(*[(F.count(c) / F.count(F.lit(1)) * 100.0).alias(c) for c in nums])
    return row.unpivot([], nums, "feature", "completeness_pct").orderBy("completeness_pct", "feature")


def describe_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Q15: count, mean, std, min, quartiles, max per column (exact percentiles).

    Columns are unpivoted to (feature, value) and summarised by feature; the
    quartiles of all columns come from one distributed ranking job."""
    long = df.unpivot([], list(columns), "feature", "value")
    v = F.col("value")
    stats = long.groupBy("feature").agg(
        F.count(v).alias("count"), rnd(F.avg(v)).alias("mean"), rnd(F.stddev_samp(v)).alias("std"),
        F.min(v).cast("double").alias("min"), F.max(v).cast("double").alias("max"))
    q = (grouped_quantiles(long, ["feature"], "value", [0.25, 0.5, 0.75]).groupBy("feature")
         .agg(rnd(F.max(F.when(F.col("q") == 0.25, v))).alias("q25"),
              rnd(F.max(F.when(F.col("q") == 0.5, v))).alias("q50"),
              rnd(F.max(F.when(F.col("q") == 0.75, v))).alias("q75")))
    return stats.join(q, "feature", "left")


def dataset_summary(df: DataFrame, name: str, date_cols: Sequence[str] = ()) -> DataFrame:
    """Q14: rows, columns, numeric/text column counts and date ranges of one table."""
    nums = numeric_columns(df)
    aggs = [F.count(F.lit(1)).alias("rows")]
    for c in date_cols:
        aggs += [F.min(c).cast("timestamp_ntz").alias(f"{c}_min"), F.max(c).cast("timestamp_ntz").alias(f"{c}_max")]
    return (df.agg(*aggs).withColumn("table", F.lit(name))
            .withColumn("columns", F.lit(len(df.columns)))
            .withColumn("numeric_columns", F.lit(len(nums)))
            .withColumn("other_columns", F.lit(len(df.columns) - len(nums))))
