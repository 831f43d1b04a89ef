"""Queries over the product feature table and the inventory policy."""

from __future__ import annotations

from pyspark.sql import functions as F

from provisio.operators import features as fe
from provisio.operators import ingest
from provisio.operators import policy as po
from provisio.plans.catalog import query
from provisio.plans.oracle_base import with_ctes

DEMAND_COLS = ["product_id", "qty_sum", "qty_mean", "qty_std", "qty_min", "qty_max", "qty_count",
               "sales_sum", "sales_mean", "sales_std", "profit_sum", "profit_mean", "order_nunique",
               "holiday_mean", "weekend_mean", "quarter_mode", "demand_variability", "revenue_per_unit",
               "profit_margin", "order_frequency", "demand_growth_mean", "demand_growth_std",
               "demand_trend_slope"]
SUPPLIER_COLS = ["product_id", "ship_days_mean", "ship_days_std", "delay_mean", "delay_std",
                 "on_time_mean", "early_mean", "late_mean", "fulfillment_days",
                 "delivery_reliability", "fulfillment_consistency"]
INVENTORY_COLS = ["product_id", "inv_mean", "inv_std", "inv_min", "inv_max", "inv_count", "cost_mean",
                  "cost_std", "ym_min", "ym_max", "inventory_variability", "cost_variability",
                  "stockout_frequency", "low_stock_frequency", "current_inventory", "current_unit_cost"]
POLICY_ALL = fe.FEATURE_COLUMNS + po.POLICY_COLUMNS


def ts(c: str):
    """Dates leave the registered queries as timestamps (midnight)."""
    return F.col(c).cast("timestamp_ntz").alias(c)


def _cols(cols):
    return ", ".join(cols)


@query("scan_orders", with_ctes("SELECT order_id, product_id, supplier_id, department, CAST(order_date AS TIMESTAMP) AS order_date, "
                                "CAST(shipment_date AS TIMESTAMP) AS shipment_date, scheduled_days, qty, CAST(sales AS DOUBLE) AS sales, "
                                "CAST(profit AS DOUBLE) AS profit, discount FROM v_orders"))
def scan_orders(i):
    """IO1, P1, P2: order lines read, dates built from parts, discount typed."""
    return i.orders.select("order_id", "product_id", "supplier_id", "department", ts("order_date"),
                           ts("shipment_date"), "scheduled_days", "qty", F.col("sales").cast("double").alias("sales"),
                           F.col("profit").cast("double").alias("profit"), "discount")


@query("standardize_orders", with_ctes(
    "SELECT count(*) AS rows, count(*) FILTER (WHERE order_date IS NULL) AS bad_order_dates, "
    "count(*) FILTER (WHERE shipment_date IS NULL) AS bad_shipment_dates, "
    "count(*) FILTER (WHERE discount IS NULL) AS bad_discounts FROM v_orders"))
def standardize_orders(i):
    """Reject counts of the typing step (NULL per bad row)."""
    return ingest.date_rejects(i.orders)


@query("standardize_inventory", with_ctes(
    "SELECT product_id, year_month, inventory, unit_cost, CAST(month_date AS TIMESTAMP) AS month_date "
    "FROM inventory"))
def standardize_inventory(i):
    """Yyyymm -> first day of the month."""
    return i.inventory.select("product_id", "year_month", "inventory", "unit_cost", ts("month_date"))


@query("calendar_features", with_ctes(
    "SELECT order_id, product_id, CAST(order_date AS TIMESTAMP) AS order_date, year, month, quarter, day_of_week, day_of_year, week_of_year, "
    "is_weekend, is_holiday, is_back_to_school, is_summer FROM lines"))
def calendar_features(i):
    """P4-P7 on every order line."""
    return i.lines.select("order_id", "product_id", ts("order_date"), "year", "month", "quarter", "day_of_week",
                          "day_of_year", "week_of_year", "is_weekend", "is_holiday", "is_back_to_school",
                          "is_summer")


@query("calendar_names", with_ctes(
    "SELECT order_id, product_id, CAST(order_date AS TIMESTAMP) AS order_date, strftime(order_date, '%B') AS month_name, "
    "strftime(order_date, '%A') AS day_name, CAST(day(last_day(order_date)) AS INTEGER) AS days_in_month "
    "FROM v_orders"))
def calendar_names(i):
    """Month name, day name, days in month."""
    return fe.calendar_names(i.orders).select("order_id", "product_id", ts("order_date"), "month_name",
                                              "day_name", "days_in_month")


@query("shipment_flags", with_ctes(
    "SELECT order_id, product_id, actual_days, delay, on_time, early, late FROM lines"))
def shipment_flags(i):
    """P11-P13 on every order line."""
    return i.lines.select("order_id", "product_id", "actual_days", "delay", "on_time", "early", "late")


@query("demand_features", with_ctes(f"SELECT {_cols(DEMAND_COLS)} FROM demand"))
def demand_features(i):
    """Demand aggregate by product left-joined with its trend."""
    return fe.demand_features(i.product_lines).select(*DEMAND_COLS)


@query("monthly_demand", with_ctes("SELECT product_id, year, month, year_month, qty FROM monthly"))
def monthly_demand(i):
    """A10, P9."""
    return fe.monthly_demand(i.lines).select("product_id", "year", "month", "year_month", "qty")


@query("monthly_demand_full", with_ctes(
    "SELECT product_id, year, month, CAST(year * 100 + month AS INTEGER) AS year_month, sum(qty) AS qty, "
    "CAST(sum(sales) AS DOUBLE) AS sales, CAST(sum(profit) AS DOUBLE) AS profit, "
    "count(DISTINCT order_id) AS orders FROM lines GROUP BY product_id, year, month"))
def monthly_demand_full(i):
    """A11."""
    return fe.monthly_demand_full(i.lines).select("product_id", "year", "month", "year_month", "qty",
                                                  "sales", "profit", "orders")


@query("daily_demand_rate", with_ctes(
    "SELECT product_id, year, month, sum(qty) AS qty, CAST(max(day(last_day(order_date))) AS INTEGER) "
    "AS days_in_month, sum(qty) / max(day(last_day(order_date))) AS daily_rate "
    "FROM lines GROUP BY product_id, year, month"))
def daily_demand_rate(i):
    """A12."""
    return fe.daily_demand_rate(i.lines).select("product_id", "year", "month", "qty", "days_in_month",
                                                "daily_rate")


@query("monthly_growth", with_ctes("SELECT product_id, year_month, qty, growth, idx FROM growth"))
def monthly_growth(i):
    """W1, W2."""
    return fe.monthly_growth(fe.monthly_demand(i.lines)).select("product_id", "year_month", "qty", "growth", "idx")


@query("demand_trend", with_ctes(
    "SELECT product_id, demand_growth_mean, demand_growth_std, demand_trend_slope FROM trend"))
def demand_trend(i):
    """A13, A14."""
    return fe.demand_trend(fe.monthly_demand(i.lines))


@query("inventory_features", with_ctes(f"SELECT {_cols(INVENTORY_COLS)} FROM invf"))
def inventory_features(i):
    """A15-A19, J2."""
    return fe.inventory_features(i.inventory).select(*INVENTORY_COLS)


@query("current_inventory", with_ctes("SELECT product_id, current_inventory, current_unit_cost FROM cur"))
def current_inventory(i):
    """A19."""
    return fe.current_inventory(i.inventory)


@query("supplier_features", with_ctes(f"SELECT {_cols(SUPPLIER_COLS)} FROM supfeat"))
def supplier_features(i):
    """A20, A21, J3."""
    return fe.supplier_features(i.lines, i.fulfillment).select(*SUPPLIER_COLS)


@query("procurement_features", with_ctes(f"SELECT {_cols(fe.FEATURE_COLUMNS)} FROM features"))
def procurement_features(i):
    """The full outer merge of demand, inventory and delivery features."""
    return i.features


@query("inventory_policy", with_ctes(
    "SELECT product_id, safety_stock, daily_demand, reorder_point, annual_demand, eoq, days_supply FROM pol2"))
def inventory_policy(i):
    """M1-M6, M14."""
    return po.inventory_policy(i.features).select("product_id", "safety_stock", "daily_demand",
                                                  "reorder_point", "annual_demand", "eoq", "days_supply")


@query("revenue_rank", with_ctes("SELECT product_id, sales_sum, revenue_rank FROM pol2"))
def revenue_rank(i):
    """Dense revenue rank over all products without a single-partition window."""
    return po.revenue_rank(i.features).select("product_id", "sales_sum", "revenue_rank")


@query("abc_class", with_ctes("SELECT product_id, revenue_rank, abc_category FROM policy"))
def abc_class(i):
    """M7."""
    return i.policy.select("product_id", "revenue_rank", "abc_category")


@query("stock_status", with_ctes(
    "SELECT product_id, current_inventory, reorder_point, stock_status FROM policy"))
def stock_status(i):
    """M8."""
    return i.policy.select("product_id", "current_inventory", "reorder_point", "stock_status")


@query("priority_score", with_ctes("SELECT product_id, priority_score FROM policy"))
def priority_score(i):
    """M10."""
    return i.policy.select("product_id", "priority_score")


@query("recommended_action", with_ctes(
    "SELECT product_id, stock_status, demand_growth_mean, recommended_action FROM policy"))
def recommended_action(i):
    """M11."""
    return i.policy.select("product_id", "stock_status", "demand_growth_mean", "recommended_action")


@query("procurement_policy", with_ctes(f"SELECT {_cols(POLICY_ALL)} FROM policy"))
def procurement_policy(i):
    """Flagship: features + M1-M11 (the reference's procurement_features table)."""
    return i.policy.select(*POLICY_ALL)


@query("bounded_reorder", with_ctes(
    "SELECT product_id, daily_demand, reorder_point, eoq, reorder_point + daily_demand * 3.0 "
    "AS buffered_reorder_point, least(greatest(eoq, 1.0), 1000.0) AS order_quantity FROM pol2"))
def bounded_reorder(i):
    """M13 (declared): 3-day buffer, order quantity within 1..1000."""
    return po.bounded_reorder(po.inventory_policy(i.features))


@query("rolling_trend", with_ctes(
    "SELECT product_id, year_month, qty, avg(qty) OVER (PARTITION BY product_id ORDER BY year_month "
    "ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS rolling_mean, "
    "lag(qty, 12) OVER (PARTITION BY product_id ORDER BY year_month) AS qty_lag_12, "
    "lag(qty, 4) OVER (PARTITION BY product_id ORDER BY year_month) AS qty_lag_4, "
    "CASE WHEN lag(qty, 12) OVER w = 0 THEN (CASE WHEN qty > 0 THEN CAST('inf' AS DOUBLE) END) "
    "ELSE qty / lag(qty, 12) OVER w END - 1.0 AS growth_12, "
    "CASE WHEN lag(qty, 4) OVER w = 0 THEN (CASE WHEN qty > 0 THEN CAST('inf' AS DOUBLE) END) "
    "ELSE qty / lag(qty, 4) OVER w END - 1.0 AS growth_4 "
    "FROM monthly WINDOW w AS (PARTITION BY product_id ORDER BY year_month)"))
def rolling_trend(i):
    """W7 (declared): 6-month moving average, 12- and 4-month lags."""
    return fe.rolling_trend(fe.monthly_demand(i.lines))


MASTER_COLS = ["product_id", "qty_sum", "qty_mean", "qty_std", "sales_sum", "sales_mean", "profit_sum",
               "profit_mean", "order_nunique", "holiday_mean", "ship_days_mean", "delay_mean", "on_time_mean",
               "stockout_frequency", "avg_fulfillment_days", "current_inventory", "unit_cost",
               "avg_monthly_demand", "demand_variability", "days_supply", "safety_stock", "reorder_point", "eoq",
               "revenue_rank", "abc_category", "stock_status"]

_R = ("CASE WHEN {d} = 0 THEN (CASE WHEN {n} > 0 THEN CAST('inf' AS DOUBLE) WHEN {n} < 0 THEN CAST('-inf' AS DOUBLE) "
      "END) ELSE CAST({n} AS DOUBLE) / CAST({d} AS DOUBLE) END")


@query("procurement_master", with_ctes(
    "SELECT * EXCLUDE (n), CASE WHEN revenue_rank <= n * 0.2 THEN 'A' WHEN revenue_rank <= n * 0.5 THEN 'B' "
    "ELSE 'C' END "
    "AS abc_category, CASE WHEN current_inventory = 0 THEN 'Stockout' WHEN current_inventory <= reorder_point "
    "THEN 'Reorder_Required' ELSE 'Normal' END AS stock_status FROM ("
    "SELECT * EXCLUDE (n), n FROM (SELECT *, CAST(dense_rank() OVER (ORDER BY sales_sum DESC) AS DOUBLE) AS revenue_rank, "
    "CAST(count(*) OVER () AS DOUBLE) AS n, "
    "COALESCE(" + _R.format(n="current_inventory", d="avg_monthly_demand / 30.0") + ", 0.0) AS days_supply, "
    "COALESCE(avg_monthly_demand / 30.0 * avg_fulfillment_days + safety_stock, 0.0) AS reorder_point, "
    "COALESCE(CASE WHEN (" + _R.format(n="2.0 * avg_monthly_demand * 50.0", d="unit_cost * 0.2") + ") < 0 THEN NULL "
    "ELSE sqrt(" + _R.format(n="2.0 * avg_monthly_demand * 50.0", d="unit_cost * 0.2") + ") END, 0.0) AS eoq "
    "FROM (SELECT *, " + _R.format(n="qty_std", d="qty_mean") + " AS demand_variability, "
    "COALESCE(1.65 * qty_std * CASE WHEN avg_fulfillment_days / 30.0 < 0 THEN NULL "
    "ELSE sqrt(avg_fulfillment_days / 30.0) END, 0.0) AS safety_stock FROM ("
    "SELECT d.product_id, d.qty_sum, d.qty_mean, d.qty_std, d.sales_sum, d.sales_mean, d.profit_sum, "
    "d.profit_mean, d.order_nunique, d.holiday_mean, d.ship_days_mean, d.delay_mean, d.on_time_mean, "
    "i.stockout_frequency, f.fulfillment_days AS avg_fulfillment_days, c.current_inventory, "
    "c.current_unit_cost AS unit_cost, d.qty_sum / 12.0 AS avg_monthly_demand "
    "FROM dagg d LEFT JOIN iagg i ON d.product_id = i.product_id LEFT JOIN cur c ON d.product_id = c.product_id "
    "LEFT JOIN fulfil f ON d.product_id = f.product_id))) t) u"))
def procurement_master(i):
    """The notebook's product table (monthly demand = sum / 12)."""
    return fe.procurement_master(i.lines, i.inventory, i.fulfillment).select(*MASTER_COLS)
