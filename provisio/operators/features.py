"""Per-product features: demand, trend, inventory, delivery.

Shape of the plan (see ``procurement_features``):

* order lines -> sent to their product as they are, in order of month and order -> windows by product mark the
  first line of an order and of a month -> ONE aggregate by product, in the same partitioning: demand, delivery and trend;
* inventory -> ONE aggregate by product (the reference's three group-bys and
  two merges at the same grain are fused);
* the product-grain results are joined on the product key; they are already
  hash-partitioned by it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from provisio.functions.columns import exact_sum, mean_flag, mean_r4, r4, ratio, ratio0, weekday_mon0, in_months
from provisio.params import DeliveryParams, PolicyParams

# Season months.
HOLIDAY_MONTHS = (11, 12)
BACK_TO_SCHOOL_MONTHS = (8, 9)
SUMMER_MONTHS = (6, 7, 8)


def calendar_features(orders: DataFrame, date_col: str = "order_date") -> DataFrame:
    """Calendar parts of the order date and season flags."""
    d = F.col(date_col)
    return (orders
            .withColumn("year", F.year(d))
            .withColumn("month", F.month(d))
            .withColumn("quarter", F.quarter(d))
            .withColumn("day_of_week", weekday_mon0(d))
            .withColumn("day_of_year", F.dayofyear(d))
            .withColumn("week_of_year", F.weekofyear(d))
            .withColumn("is_weekend", (F.col("day_of_week") >= 5).cast("int"))
            .withColumn("is_holiday", in_months("month", HOLIDAY_MONTHS))
            .withColumn("is_back_to_school", in_months("month", BACK_TO_SCHOOL_MONTHS))
            .withColumn("is_summer", in_months("month", SUMMER_MONTHS)))


def calendar_names(orders: DataFrame, date_col: str = "order_date") -> DataFrame:
    """Month name, day name and days in the month of the order date."""
    d = F.col(date_col)
    return (orders
            .withColumn("month_name", F.date_format(d, "MMMM"))
            .withColumn("day_name", F.date_format(d, "EEEE"))
            .withColumn("days_in_month", F.dayofmonth(F.last_day(d))))


def shipment_flags(orders: DataFrame, p: DeliveryParams = DeliveryParams()) -> DataFrame:
    """Actual shipment days, delay against schedule, on-time/early/late flags."""
    return (orders
            .withColumn("actual_days", F.datediff("shipment_date", "order_date"))
            .withColumn("delay", F.col("actual_days") - F.col("scheduled_days"))
            .withColumn("on_time", (F.col("delay") <= p.on_time_max_delay).cast("int"))
            .withColumn("early", (F.col("delay") < p.early_below).cast("int"))
            .withColumn("late", (F.col("delay") > p.late_above).cast("int")))


def order_lines(orders_std: DataFrame, p: DeliveryParams = DeliveryParams()) -> DataFrame:
    """Standardized order lines with calendar and delivery columns; NULL products dropped
    (pandas group-by drops NaN keys)."""
    return shipment_flags(calendar_features(orders_std.filter(F.col("product_id").isNotNull())), p)


def _in_order(lines: DataFrame) -> DataFrame:
    """Lines with what a product's aggregate cannot see in one line: the first line of each order in a month (``new_order``), and on
    the first line of each month its quantity (``month_qty``), the month's place and the growth against the month before.

    The lines are sent to their product as they are, a few numbers each: a product has few lines a month, so rows that were
    aggregated by month and order before their shuffle were as many, and several times as wide.  One sort by month and order
    serves all windows; its rows spill, no table of orders or months is held."""
    at = lines.withColumn("year_month", (F.col("year") * 100 + F.col("month")).cast("int"))
    w = Window.partitionBy("product_id").orderBy("year_month", "order_id")
    place = Window.partitionBy("product_id").orderBy("year_month")
    same = lambda c: F.lag(c).over(w).eqNullSafe(F.col(c)) & (F.row_number().over(w) > 1)
    out = (at
           .withColumn("_new_month", ~same("year_month"))
           .withColumn("new_order", ((F.col("_new_month") | ~same("order_id")) & F.col("order_id").isNotNull()).cast("int"))
           .withColumn("_month", F.sum("qty").over(Window.partitionBy("product_id", "year_month")))
           .withColumn("_before", F.lag("_month").over(w))
           .withColumn("_place", (F.dense_rank().over(place) - 1).cast("double")))
    return (out.withColumn("month_qty", F.when(F.col("_new_month"), F.col("_month")))
            .withColumn("idx", F.when(F.col("_new_month"), F.col("_place")))
            .withColumn("growth", F.when(F.col("_new_month"), ratio(F.col("_month"), F.col("_before")) - F.lit(1.0)))
            .drop("_new_month", "_month", "_before", "_place"))


def _std(c: str):
    return r4(F.stddev_samp(F.col(c).cast("double")))


def _quarter_mode():
    """The most frequent quarter (the first of equals) from four counts: ``mode`` would make the
    whole product aggregate keep a map per group."""
    n = [F.count_if(F.col("quarter") == q) for q in range(1, 5)]
    most = F.greatest(*n)
    pick = F.when(n[0] == most, 1).when(n[1] == most, 2).when(n[2] == most, 3).otherwise(4)
    return F.when(most > 0, pick)


def _demand_aggs():
    return [
        r4(F.sum("qty")).alias("qty_sum"),
        mean_r4("qty").alias("qty_mean"),
        _std("qty").alias("qty_std"),
        r4(F.min("qty")).alias("qty_min"),
        r4(F.max("qty")).alias("qty_max"),
        F.count("qty").alias("qty_count"),
        r4(exact_sum("sales")).alias("sales_sum"),
        mean_r4("sales").alias("sales_mean"),
        _std("sales").alias("sales_std"),
        r4(exact_sum("profit")).alias("profit_sum"),
        mean_r4("profit").alias("profit_mean"),
        F.sum("new_order").alias("order_nunique"),
        mean_r4("is_holiday").alias("holiday_mean"),
        mean_r4("is_weekend").alias("weekend_mean"),
        _quarter_mode().alias("quarter_mode"),
    ]


def _demand_ratios(df: DataFrame, p: PolicyParams = PolicyParams()) -> DataFrame:
    return (df
            .withColumn("demand_variability", ratio0("qty_std", "qty_mean"))
            .withColumn("revenue_per_unit", ratio0("sales_sum", "qty_sum"))
            .withColumn("profit_margin", ratio0("profit_sum", "sales_sum"))
            .withColumn("order_frequency", F.col("order_nunique") / F.lit(p.days_per_year)))


def _delivery_aggs():
    return [
        mean_r4("actual_days").alias("ship_days_mean"),
        _std("actual_days").alias("ship_days_std"),
        mean_r4("delay").alias("delay_mean"),
        _std("delay").alias("delay_std"),
        mean_r4("on_time").alias("on_time_mean"),
        mean_r4("early").alias("early_mean"),
        mean_r4("late").alias("late_mean"),
    ]


def _trend_aggs(qty: str = "qty"):
    return [
        r4(F.avg("growth")).alias("demand_growth_mean"),
        r4(F.stddev_samp("growth")).alias("demand_growth_std"),
        r4(F.coalesce(F.regr_slope(qty, "idx"), F.lit(0.0))).alias("demand_trend_slope"),
    ]


def demand_aggregate(lines: DataFrame) -> DataFrame:
    """A1-A9 at product grain (without trend)."""
    return _demand_ratios(_in_order(lines).groupBy("product_id").agg(*_demand_aggs()))


def monthly_demand(lines: DataFrame) -> DataFrame:
    """Quantity per product and calendar month of the order."""
    return (lines.groupBy("product_id", "year", "month")
            .agg(F.sum("qty").alias("qty"))
            .withColumn("year_month", (F.col("year") * 100 + F.col("month")).cast("int")))


def monthly_demand_full(lines: DataFrame) -> DataFrame:
    """Quantity, sales, profit and distinct orders per product and month."""
    return (lines.groupBy("product_id", "year", "month")
            .agg(F.sum("qty").alias("qty"),
                 F.sum("sales").cast("double").alias("sales"),
                 F.sum("profit").cast("double").alias("profit"),
                 F.count_distinct("order_id").alias("orders"))
            .withColumn("year_month", (F.col("year") * 100 + F.col("month")).cast("int")))


def daily_demand_rate(lines: DataFrame) -> DataFrame:
    """Monthly quantity divided by the number of days in that month."""
    return (lines.withColumn("_dim", F.dayofmonth(F.last_day("order_date")))
            .groupBy("product_id", "year", "month")
            .agg(F.sum("qty").alias("qty"), F.max("_dim").alias("days_in_month"))
            .withColumn("daily_rate", F.col("qty") / F.col("days_in_month")))


def monthly_growth(monthly: DataFrame) -> DataFrame:
    """Growth against the previous present month; position index per product."""
    w = Window.partitionBy("product_id").orderBy("year_month")
    return (monthly
            # pandas pct_change: x / previous - 1
            .withColumn("growth", ratio(F.col("qty"), F.lag("qty").over(w)) - F.lit(1.0))
            .withColumn("idx", (F.row_number().over(w) - 1).cast("double")))


def demand_trend(monthly: DataFrame) -> DataFrame:
    """Growth mean/std, least-squares slope over 0..n-1 (0 if one month)."""
    return monthly_growth(monthly).groupBy("product_id").agg(*_trend_aggs())


def demand_features(lines: DataFrame) -> DataFrame:
    """A1-A14 with J1: demand and trend of a product from the same lines, so nothing is joined."""
    return _demand_ratios(_in_order(lines).groupBy("product_id").agg(*_demand_aggs(), *_trend_aggs("month_qty")))


def _inventory_aggs(p: PolicyParams = PolicyParams()):
    inv = F.col("inventory")
    return [
        mean_r4(inv).alias("inv_mean"),
        r4(F.stddev_samp(inv)).alias("inv_std"),
        r4(F.min(inv)).alias("inv_min"),
        r4(F.max(inv)).alias("inv_max"),
        F.count(inv).alias("inv_count"),
        mean_r4("unit_cost").alias("cost_mean"),
        r4(F.stddev_samp("unit_cost")).alias("cost_std"),
        F.min("year_month").alias("ym_min"),
        F.max("year_month").alias("ym_max"),
        mean_flag(inv == 0).alias("stockout_frequency"),
        mean_flag((inv > 0) & (inv <= p.low_stock_units)).alias("low_stock_frequency"),
        # latest month; ties broken by lowest stock, then lowest cost (deviation D11)
        F.max_by(F.struct(inv.alias("i"), F.col("unit_cost").alias("c")),
                 F.struct(F.col("year_month"), -inv, -F.col("unit_cost"))).alias("_cur"),
    ]


def inventory_features(inventory: DataFrame, p: PolicyParams = PolicyParams()) -> DataFrame:
    """One aggregate replaces three group-bys and two merges."""
    agg = inventory.filter(F.col("product_id").isNotNull()).groupBy("product_id").agg(*_inventory_aggs(p))
    return (agg
            .withColumn("inventory_variability", ratio0("inv_std", "inv_mean"))
            .withColumn("cost_variability", ratio0("cost_std", "cost_mean"))
            .withColumn("current_inventory", F.col("_cur.i"))
            .withColumn("current_unit_cost", F.col("_cur.c"))
            .drop("_cur"))


def current_inventory(inventory: DataFrame) -> DataFrame:
    """A19 alone: stock and cost at each product's latest month."""
    return (inventory.filter(F.col("product_id").isNotNull()).groupBy("product_id")
            .agg(F.max_by(F.struct(F.col("inventory").alias("i"), F.col("unit_cost").alias("c")),
                          F.struct(F.col("year_month"), -F.col("inventory"), -F.col("unit_cost")))
                 .alias("_cur"))
            .select("product_id", F.col("_cur.i").alias("current_inventory"),
                    F.col("_cur.c").alias("current_unit_cost")))


def _supplier_ratios(df: DataFrame) -> DataFrame:
    return (df.withColumn("delivery_reliability", F.lit(1.0) - F.col("late_mean"))
              .withColumn("fulfillment_consistency", ratio(F.lit(1.0), F.lit(1.0) + F.col("ship_days_std"))))


def supplier_features(lines: DataFrame, fulfil: DataFrame) -> DataFrame:
    """Delivery performance per product, fulfilment days left-joined."""
    return _supplier_ratios(lines.groupBy("product_id").agg(*_delivery_aggs()).join(fulfil, "product_id", "left"))


def demand_supplier_features(lines: DataFrame, fulfil: DataFrame) -> DataFrame:
    """Demand, trend and delivery features: the order lines are read once and sent once, to their product."""
    out = _demand_ratios(_in_order(lines).groupBy("product_id").agg(*_demand_aggs(), *_delivery_aggs(), *_trend_aggs("month_qty")))
    return _supplier_ratios(out.join(fulfil, "product_id", "left"))


FEATURE_COLUMNS = [
    "product_id",
    "qty_sum", "qty_mean", "qty_std", "qty_min", "qty_max", "qty_count",
    "sales_sum", "sales_mean", "sales_std", "profit_sum", "profit_mean", "order_nunique",
    "holiday_mean", "weekend_mean", "quarter_mode", "demand_variability", "revenue_per_unit",
    "profit_margin", "order_frequency", "demand_growth_mean", "demand_growth_std", "demand_trend_slope",
    "inv_mean", "inv_std", "inv_min", "inv_max", "inv_count", "cost_mean", "cost_std", "ym_min", "ym_max",
    "inventory_variability", "cost_variability", "stockout_frequency", "low_stock_frequency",
    "current_inventory", "current_unit_cost",
    "ship_days_mean", "ship_days_std", "delay_mean", "delay_std", "on_time_mean", "early_mean",
    "late_mean", "fulfillment_days", "delivery_reliability", "fulfillment_consistency",
]


def procurement_features(lines: DataFrame, inventory: DataFrame, fulfil: DataFrame,
                         p: PolicyParams = PolicyParams()) -> DataFrame:
    """J4 + P14: (demand, delivery) full-outer inventory on product, then NaN/NULL -> 0."""
    ds = demand_supplier_features(lines, fulfil)
    inv = inventory_features(inventory, p)
    merged = ds.join(inv, "product_id", "full").select(*FEATURE_COLUMNS)
    return merged.na.fill(0)


def procurement_master(lines: DataFrame, inventory: DataFrame, fulfil: DataFrame,
                       p: PolicyParams = PolicyParams()) -> DataFrame:
    """The exploratory notebook's variant of the product table.

    Products come from the order lines (left joins); monthly demand = quantity
    sum / 12; days of supply, reorder point and EOQ use it; NaN inputs are not
    filled before the metrics; status has no Overstock class."""
    from provisio.functions.columns import sqrt_nan
    from provisio.functions.ranking import global_dense_rank
    from provisio.session import materialize
    qty = F.col("qty")
    m = lines.groupBy("product_id").agg(
        r4(F.sum(qty)).alias("qty_sum"), mean_r4(qty).alias("qty_mean"), r4(F.stddev_samp(qty)).alias("qty_std"),
        r4(exact_sum("sales")).alias("sales_sum"), mean_r4("sales").alias("sales_mean"),
        r4(exact_sum("profit")).alias("profit_sum"), mean_r4("profit").alias("profit_mean"),
        F.count_distinct("order_id").alias("order_nunique"), mean_r4("is_holiday").alias("holiday_mean"),
        mean_r4("actual_days").alias("ship_days_mean"), mean_r4("delay").alias("delay_mean"),
        mean_r4("on_time").alias("on_time_mean"))
    inv = inventory.filter(F.col("product_id").isNotNull()).groupBy("product_id").agg(
        mean_flag(F.col("inventory") == 0).alias("stockout_frequency"),
        F.max_by(F.struct(F.col("inventory").alias("i"), F.col("unit_cost").alias("c")),
                 F.struct(F.col("year_month"), -F.col("inventory"), -F.col("unit_cost"))).alias("_cur"))
    j = (m.join(inv, "product_id", "left").join(fulfil.withColumnRenamed("fulfillment_days", "avg_fulfillment_days"),
                                                 "product_id", "left")
         .withColumn("current_inventory", F.col("_cur.i")).withColumn("unit_cost", F.col("_cur.c")).drop("_cur"))
    j = materialize(j, "procurement_master")
    monthly = F.col("qty_sum") / F.lit(12.0)
    daily = F.col("avg_monthly_demand") / F.lit(p.days_per_month)
    out = (j.withColumn("avg_monthly_demand", monthly)
           .withColumn("demand_variability", ratio("qty_std", "qty_mean"))
           .withColumn("days_supply", F.coalesce(ratio(F.col("current_inventory"), daily), F.lit(0.0)))
           .withColumn("safety_stock", F.coalesce(F.lit(p.z_service) * F.col("qty_std")
                                                  * sqrt_nan(F.col("avg_fulfillment_days") / F.lit(p.days_per_month)),
                                                  F.lit(0.0)))
           .withColumn("reorder_point", F.coalesce(daily * F.col("avg_fulfillment_days") + F.col("safety_stock"),
                                                   F.lit(0.0)))
           .withColumn("eoq", F.coalesce(sqrt_nan(ratio(F.lit(2.0) * F.col("avg_monthly_demand") * F.lit(p.setup_cost),
                                                        F.col("unit_cost") * F.lit(p.holding_rate))), F.lit(0.0))))
    n = out.select(F.count(F.lit(1)).cast("double")).scalar()
    out = global_dense_rank(out, "sales_sum", "_rr").withColumn("revenue_rank", F.col("_rr").cast("double")).drop("_rr")
    rank = F.col("revenue_rank")
    return (out.withColumn("abc_category", F.when(rank <= n * F.lit(p.class_a_share), "A")
                           .when(rank <= n * F.lit(p.class_b_share), "B").otherwise("C"))
            .withColumn("stock_status", F.when(F.col("current_inventory") == 0, "Stockout")
                        .when(F.col("current_inventory") <= F.col("reorder_point"), "Reorder_Required")
                        .otherwise("Normal")))


def rolling_trend(monthly: DataFrame, window_months: int = 6, seasonal_lag: int = 12,
                  quarter_lag: int = 4) -> DataFrame:
    """W7 (declared): 6-month moving average of monthly demand, and the quantity 12 and 4 present
    months earlier with the growth against them (windows per product: bounded by the calendar)."""
    w = Window.partitionBy("product_id").orderBy("year_month")
    lag12, lag4 = F.lag("qty", seasonal_lag).over(w), F.lag("qty", quarter_lag).over(w)
    return (monthly.select("product_id", "year_month", "qty")
            .withColumn("rolling_mean", F.avg("qty").over(w.rowsBetween(-(window_months - 1), 0)))
            .withColumn("qty_lag_12", lag12)
            .withColumn("qty_lag_4", lag4)
            .withColumn("growth_12", ratio(F.col("qty"), F.col("qty_lag_12")) - F.lit(1.0))
            .withColumn("growth_4", ratio(F.col("qty"), F.col("qty_lag_4")) - F.lit(1.0)))
