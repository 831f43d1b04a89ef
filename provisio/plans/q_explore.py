"""Queries: data quality on the inputs and exploration of the product table."""

from __future__ import annotations

import os
import uuid
from itertools import combinations

from pyspark.sql import functions as F

from provisio.operators import explore as ex
from provisio.operators import features as fe
from provisio.operators import policy as po
from provisio.operators import quality as dq
from provisio.plans.catalog import query
from provisio.plans.oracle_base import with_ctes
from provisio.session import checkpoint_dir
from provisio.sources.tables import scan

RAW_ORDER_COLS = ["order_id", "product_id", "supplier_id", "department", "order_year", "order_month",
                  "order_day", "shipment_year", "shipment_month", "shipment_day", "scheduled_days", "qty",
                  "sales", "profit", "discount_text"]
RAW_ORDER_NUMERIC = [c for c in RAW_ORDER_COLS if c not in ("department", "discount_text")]
INV_COLS = ["product_id", "year_month", "inventory", "unit_cost"]
FUL_COLS = ["product_id", "fulfillment_days"]
POLICY_ALL = fe.FEATURE_COLUMNS + po.POLICY_COLUMNS
POLICY_TEXT = ["abc_category", "stock_status", "recommended_action"]
POLICY_NUMERIC = [c for c in POLICY_ALL if c not in POLICY_TEXT]
DESCRIBE_COLS = ["current_inventory", "reorder_point", "safety_stock", "eoq"]

RAW_CTE = """, raw_layout AS (
  SELECT order_id, product_id, supplier_id, department,
         CAST(year(order_date) AS INTEGER) AS order_year, CAST(month(order_date) AS INTEGER) AS order_month,
         CAST(day(order_date) AS INTEGER) AS order_day, CAST(year(shipment_date) AS INTEGER) AS shipment_year,
         CAST(month(shipment_date) AS INTEGER) AS shipment_month, CAST(day(shipment_date) AS INTEGER) AS shipment_day,
         scheduled_days, qty, sales, profit, CAST(discount AS VARCHAR) AS discount_text
  FROM v_orders),
inv_raw AS (SELECT product_id, year_month, inventory, unit_cost FROM inv_month),
mo AS (SELECT CAST(date_trunc('month', order_date) AS TIMESTAMP) AS month, sum(qty) AS qty,
              CAST(sum(sales) AS DOUBLE) AS sales FROM lines GROUP BY 1)
"""

TABLE_SQL = {"orders": ("raw_layout", RAW_ORDER_COLS), "inventory": ("inv_raw", INV_COLS),
             "fulfillment": ("fulfil", FUL_COLS)}


def _wq(select: str) -> str:
    """WITH <feature ctes>, <raw layouts> SELECT ..."""
    base = with_ctes("")
    return base.rstrip() + RAW_CTE + select


def _tables(i):
    return {"orders": i.raw_orders, "inventory": i.raw_inventory, "fulfillment": i.fulfillment}


def _union(parts):
    return " UNION ALL ".join(parts)


# ---------------------------------------------------------------- data quality

@query("dq_report", _wq(_union(
    [f"SELECT '{n}' AS dataset, count(*) AS rows, {len(cols)} AS columns FROM {t}"
     for n, (t, cols) in TABLE_SQL.items()])))
def dq_report(i):
    """Q1: rows and columns of each input."""
    return dq.dq_report(_tables(i))


def _missing_sql():
    parts = []
    for n, (t, cols) in TABLE_SQL.items():
        for c in cols:
            parts.append(f"SELECT '{n}' AS dataset, '{c}' AS column, count(*) FILTER (WHERE {c} IS NULL"
                         + (f" OR isnan({c})" if c in ("qty", "inventory", "unit_cost", "fulfillment_days") else "")
                         + f") AS missing FROM {t}")
    return _union(parts)


@query("dq_missing", _wq(_missing_sql()))
def dq_missing(i):
    """Q2: missing values per column of each input."""
    return dq.dq_missing(_tables(i))


@query("dq_duplicates", _wq(_union(
    [f"SELECT '{n}' AS dataset, CAST(COALESCE(sum(c - 1), 0) AS BIGINT) AS duplicates, "
     f"CAST(COALESCE(sum(c), 0) AS BIGINT) AS rows FROM (SELECT count(*) AS c FROM {t} GROUP BY ALL_COLS_{n})"
     for n, (t, cols) in TABLE_SQL.items()])
    .replace("GROUP BY ALL_COLS_orders", "GROUP BY " + ", ".join(RAW_ORDER_COLS))
    .replace("GROUP BY ALL_COLS_inventory", "GROUP BY " + ", ".join(INV_COLS))
    .replace("GROUP BY ALL_COLS_fulfillment", "GROUP BY " + ", ".join(FUL_COLS))))
def dq_duplicates(i):
    """Q3: duplicate rows beyond the first copy."""
    return dq.dq_duplicates(_tables(i))


def _neg_sql():
    nums = {"orders": RAW_ORDER_NUMERIC, "inventory": INV_COLS, "fulfillment": FUL_COLS}
    parts = []
    for n, (t, _) in TABLE_SQL.items():
        for c in nums[n]:
            parts.append(f"SELECT '{n}' AS dataset, '{c}' AS column, count(*) FILTER (WHERE {c} < 0) AS negatives "
                         f"FROM {t}")
    return f"SELECT * FROM ({_union(parts)}) WHERE negatives > 0"


@query("dq_negatives", _wq(_neg_sql()))
def dq_negatives(i):
    """Q4: negative values per numeric column, only columns that have some."""
    return dq.dq_negatives(_tables(i))


def _lineage_sql():
    rows = _union([f"SELECT '{n}' AS dataset, count(*) AS rows, {len(cols)} AS columns FROM {t}"
                   for n, (t, cols) in TABLE_SQL.items()])
    miss = f"SELECT dataset, sum(missing) AS missing_values FROM ({_missing_sql()}) GROUP BY dataset"
    dup = _union([f"SELECT '{n}' AS dataset, CAST(COALESCE(sum(c - 1), 0) AS BIGINT) AS duplicates FROM "
                  f"(SELECT count(*) AS c FROM {t} GROUP BY {', '.join(cols)})" for n, (t, cols) in TABLE_SQL.items()])
    return (f"SELECT r.dataset, r.rows, r.columns, m.missing_values, d.duplicates, "
            f"sum(r.rows) OVER () AS total_records, 3 AS datasets, 'completed' AS status "
            f"FROM ({rows}) r JOIN ({miss}) m ON r.dataset = m.dataset JOIN ({dup}) d ON r.dataset = d.dataset")


@query("lineage", _wq(_lineage_sql()))
def lineage(i):
    """Q5, U4, IO7: per-dataset quality summary and total records."""
    return dq.lineage(_tables(i))


@query("lineage_json", _wq(_lineage_sql()))
def lineage_json(i):
    """IO7: the lineage of all ingested tables written as one JSON document, read back and flattened."""
    path = os.path.join(checkpoint_dir(i.spark), "lineage", uuid.uuid4().hex)
    dq.lineage_document(dq.lineage(_tables(i))).write.text(path)
    return dq.lineage_rows(i.spark.read.text(path).withColumnRenamed("value", "document"))


def _gate_sql():
    rows = _union([f"SELECT '{n}' AS dataset, count(*) AS rows FROM {t}" for n, (t, cols) in TABLE_SQL.items()])
    miss = f"SELECT dataset, max(missing) AS max_missing FROM ({_missing_sql()}) GROUP BY dataset"
    dup = _union([f"SELECT '{n}' AS dataset, CAST(COALESCE(sum(c - 1), 0) AS BIGINT) AS duplicates FROM "
                  f"(SELECT count(*) AS c FROM {t} GROUP BY {', '.join(cols)})" for n, (t, cols) in TABLE_SQL.items()])
    return (f"SELECT r.dataset, r.rows, m.max_missing / r.rows * 100.0 AS max_missing_pct, "
            f"d.duplicates / r.rows * 100.0 AS duplicate_pct, "
            f"(m.max_missing / r.rows * 100.0 <= 20.0) AND (d.duplicates / r.rows * 100.0 <= 5.0) AS passed "
            f"FROM ({rows}) r JOIN ({miss}) m ON r.dataset = m.dataset JOIN ({dup}) d ON r.dataset = d.dataset")


@query("dq_gate", _wq(_gate_sql()))
def dq_gate(i):
    """Q11 (declared): missing <= 20% per column, duplicates <= 5%."""
    return dq.dq_gate(_tables(i))


@query("dq_range_rules", _wq(
    "SELECT 'orders' AS dataset, 'qty' AS column, count(*) FILTER (WHERE qty < 1.0 OR qty > 10000.0) AS violations,"
    " count(*) AS rows FROM raw_layout UNION ALL "
    "SELECT 'inventory', 'unit_cost', count(*) FILTER (WHERE unit_cost < 0.01 OR unit_cost > 1000.0), count(*) "
    "FROM inv_raw UNION ALL "
    "SELECT 'inventory', 'inventory', count(*) FILTER (WHERE inventory < 0.0), count(*) FROM inv_raw"))
def dq_range_rules(i):
    """Q12 (declared): rows outside quantity 1..10000, cost 0.01..1000, inventory >= 0."""
    return dq.dq_range_rules(_tables(i))


@query("input_profile", _wq(
    "SELECT dataset, rows, columns, present, sum(rows) OVER () AS total_rows FROM ("
    + _union([f"SELECT '{n}' AS dataset, count(*) AS rows, {len(cols)} AS columns, true AS present FROM {t}"
              for n, (t, cols) in TABLE_SQL.items()]) + ")"))
def input_profile(i):
    """IO14: rows and columns per input and the total."""
    return dq.input_profile(_tables(i), ["orders", "inventory", "fulfillment"])


@query("dataset_summary", _wq(
    "SELECT count(*) AS rows, CAST(min(order_date) AS TIMESTAMP) AS order_date_min, "
    "CAST(max(order_date) AS TIMESTAMP) AS order_date_max, CAST(min(shipment_date) AS TIMESTAMP) AS shipment_date_min, "
    "CAST(max(shipment_date) AS TIMESTAMP) AS shipment_date_max, 'orders' AS \"table\", 11 AS columns, "
    "8 AS numeric_columns, 3 AS other_columns FROM v_orders"))
def dataset_summary(i):
    """Q14: shape, date range and type counts of the standardized orders."""
    return ex.dataset_summary(i.orders, "orders", ["order_date", "shipment_date"])


# ---------------------------------------------------------------- exploration

@query("portfolio_kpis", _wq(
    "SELECT count(DISTINCT product_id) AS total_products, "
    "CAST(sum(CAST(sales_sum AS DECIMAL(22,2))) AS DOUBLE) AS total_revenue, "
    "CAST(sum(CAST(profit_sum AS DECIMAL(22,4))) AS DOUBLE) AS total_profit, "
    "round_even(CAST(sum(CAST(profit_sum AS DECIMAL(22,4))) AS DOUBLE) / "
    "CAST(sum(CAST(sales_sum AS DECIMAL(22,2))) AS DOUBLE) * 100.0, 6) AS profit_margin_pct, "
    "round_even(avg(priority_score), 6) AS avg_priority_score FROM policy"))
def portfolio_kpis(i):
    """A24, A33."""
    return ex.portfolio_kpis(i.policy_table)


@query("stock_counts", _wq(
    "SELECT count(*) AS products, count(*) FILTER (WHERE stock_status = 'Reorder_Required') AS reorder_required, "
    "count(*) FILTER (WHERE stock_status = 'Stockout') AS stockout, "
    "count(*) FILTER (WHERE stock_status = 'Overstock') AS overstock, "
    "count(*) FILTER (WHERE stock_status = 'Normal') AS normal, "
    "count(*) FILTER (WHERE stock_status = 'Reorder_Required') / count(*) * 100.0 AS reorder_pct, "
    "count(*) FILTER (WHERE stock_status = 'Stockout') / count(*) * 100.0 AS stockout_pct, "
    "count(*) FILTER (WHERE stock_status = 'Overstock') / count(*) * 100.0 AS overstock_pct, "
    "count(*) FILTER (WHERE stock_status = 'Stockout') / count(*) AS stockout_rate FROM policy"))
def stock_counts(i):
    """P20, A25."""
    return ex.stock_counts(i.policy_table)


@query("abc_summary", _wq(
    "SELECT abc_category, count(*) AS products, count(*) / (SELECT count(*) FROM policy) * 100.0 AS product_pct, "
    "CAST(sum(CAST(sales_sum AS DECIMAL(22,2))) AS DOUBLE) AS revenue, "
    "CAST(sum(CAST(sales_sum AS DECIMAL(22,2))) AS DOUBLE) / "
    "CAST((SELECT sum(CAST(sales_sum AS DECIMAL(22,2))) FROM policy) AS DOUBLE) * 100.0 AS revenue_pct "
    "FROM policy GROUP BY abc_category"))
def abc_summary(i):
    """A26."""
    return ex.abc_summary(i.policy_table)


@query("monthly_orders", _wq(
    "SELECT CAST(date_trunc('month', order_date) AS TIMESTAMP) AS month, sum(qty) AS qty, "
    "CAST(sum(sales) AS DOUBLE) AS sales, count(DISTINCT order_id) AS orders FROM lines GROUP BY 1"))
def monthly_orders(i):
    """A27, P10."""
    return ex.monthly_orders(i.lines)


@query("peak_months", _wq(
    "SELECT (SELECT month FROM mo ORDER BY qty DESC, month ASC LIMIT 1) AS peak_qty_month, "
    "(SELECT max(qty) FROM mo) AS peak_qty, "
    "(SELECT month FROM mo ORDER BY sales DESC, month ASC LIMIT 1) AS peak_sales_month, "
    "(SELECT max(sales) FROM mo) AS peak_sales"))
def peak_months(i):
    """A28."""
    return ex.peak_months(i.lines)


@query("seasonality", _wq(
    "SELECT dimension, key, COALESCE(CASE WHEN dimension = 'weekday' THEN "
    "list_extract(['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday'], key + 1) END, "
    "CAST(key AS VARCHAR)) AS label, qty, "
    "CAST(qty = max(qty) OVER (PARTITION BY dimension) AS INTEGER) AS is_peak, "
    "CAST(qty = min(qty) OVER (PARTITION BY dimension) AS INTEGER) AS is_low FROM ("
    "SELECT 'month' AS dimension, month AS key, sum(qty) AS qty FROM lines GROUP BY month UNION ALL "
    "SELECT 'quarter', quarter, sum(qty) FROM lines GROUP BY quarter UNION ALL "
    "SELECT 'weekday', day_of_week, sum(qty) FROM lines GROUP BY day_of_week)"))
def seasonality(i):
    """A29."""
    return ex.seasonality(i.lines)


@query("department_performance", _wq(
    "SELECT department, sum(qty) AS qty, CAST(sum(sales) AS DOUBLE) AS sales, CAST(sum(profit) AS DOUBLE) AS profit, "
    "count(DISTINCT product_id) AS products, "
    "round_even(CAST(sum(profit) AS DOUBLE) / CAST(sum(sales) AS DOUBLE) * 100.0, 2) AS margin_pct "
    "FROM lines GROUP BY department ORDER BY sales DESC, department LIMIT 10"))
def department_performance(i):
    """A30."""
    return ex.department_performance(i.lines)


@query("department_monthly", _wq(
    "SELECT department, CAST(date_trunc('month', order_date) AS TIMESTAMP) AS month, sum(qty) AS qty FROM lines "
    "WHERE department IN (SELECT department FROM lines GROUP BY department ORDER BY count(*) DESC, department "
    "LIMIT 8) GROUP BY 1, 2"))
def department_monthly(i):
    """A31."""
    return ex.department_monthly(i.lines)


@query("action_summary", _wq(
    "SELECT recommended_action, count(*) AS products, count(*) / (SELECT count(*) FROM policy) * 100.0 AS pct "
    "FROM policy GROUP BY recommended_action"))
def action_summary(i):
    """A32."""
    return ex.action_summary(i.policy_table)


@query("top_products", _wq(
    "SELECT product_id, sales_sum, qty_sum, abc_category, ranking, substr(p_name, 1, 30) AS name_prefix FROM ("
    "(SELECT product_id, sales_sum, qty_sum, abc_category, 'revenue' AS ranking FROM policy "
    "ORDER BY sales_sum DESC, product_id LIMIT 10) UNION ALL "
    "(SELECT product_id, sales_sum, qty_sum, abc_category, 'volume' AS ranking FROM policy "
    "ORDER BY qty_sum DESC, product_id LIMIT 10)) t LEFT JOIN part ON t.product_id = part.p_partkey"))
def top_products(i):
    """T1, P27."""
    names = scan(i.spark, i.sf_dir, "part", "p_partkey", "p_name").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name"))
    return ex.top_products(i.policy_table, names)


def _ext(col, order, k, label):
    return (f"(SELECT product_id, delivery_reliability, on_time_mean, fulfillment_days, '{label}' AS list "
            f"FROM policy ORDER BY {col} {order}, product_id LIMIT {k})")


@query("delivery_extremes", _wq(_union([
    _ext("delivery_reliability", "DESC", 5, "best_reliability"), _ext("delivery_reliability", "ASC", 5, "worst_reliability"),
    _ext("on_time_mean", "DESC", 10, "best_on_time"), _ext("on_time_mean", "ASC", 10, "worst_on_time")])))
def delivery_extremes(i):
    """T2, T3."""
    return ex.delivery_extremes(i.policy_table)


@query("growth_extremes", _wq(
    "SELECT product_id, demand_growth_mean, qty_mean, stock_status, 'high_growth' AS list FROM policy "
    "WHERE demand_growth_mean > 0.1 UNION ALL "
    "SELECT product_id, demand_growth_mean, qty_mean, stock_status, 'declining' FROM policy "
    "WHERE demand_growth_mean < -0.1 UNION ALL "
    "(SELECT product_id, demand_growth_mean, qty_mean, stock_status, 'top_growth' FROM policy "
    "ORDER BY demand_growth_mean DESC, product_id LIMIT 15)"))
def growth_extremes(i):
    """P22, T4."""
    return ex.growth_extremes(i.policy_table)


@query("high_risk_products", _wq(
    "SELECT product_id, stockout_frequency, current_inventory, reorder_point, priority_score, stock_status "
    "FROM policy WHERE stockout_frequency > 0.2 OR current_inventory <= reorder_point"))
def high_risk_products(i):
    """P21."""
    return ex.high_risk_products(i.policy_table)


@query("insight_counts", _wq(
    "SELECT count(*) FILTER (WHERE demand_growth_mean > 0.1 AND abc_category = 'A') AS high_opportunity, "
    "CAST(COALESCE(sum(CASE WHEN stock_status = 'Overstock' THEN CAST(sales_sum AS DECIMAL(22,2)) END), 0) "
    "AS DOUBLE) AS overstock_value, count(*) FILTER (WHERE delivery_reliability < 0.8) AS poor_suppliers, "
    "count(*) FILTER (WHERE stock_status = 'Stockout') AS urgent_products FROM policy"))
def insight_counts(i):
    """P23-P25."""
    return ex.insight_counts(i.policy_table)


@query("metric_plausibility", _wq(
    "SELECT count(*) AS products, "
    "count(*) FILTER (WHERE reorder_point > 0 AND reorder_point <= qty_sum) AS reasonable_reorder, "
    "count(*) FILTER (WHERE eoq > 0 AND eoq <= qty_sum * 2) AS reasonable_eoq, "
    "count(*) FILTER (WHERE safety_stock >= 0 AND safety_stock <= qty_mean * 2) AS reasonable_safety FROM policy"))
def metric_plausibility(i):
    """P26."""
    return ex.metric_plausibility(i.policy_table)


@query("efficiency_metrics", _wq(
    "SELECT product_id, qty_sum / (current_inventory + 1.0) AS inventory_efficiency, "
    "profit_sum / (current_unit_cost * current_inventory + 1.0) AS cost_efficiency FROM policy"))
def efficiency_metrics(i):
    """A39."""
    return ex.efficiency_metrics(i.policy_table)


@query("class_quartiles", _wq(
    "SELECT abc_category, min(safety_stock) AS safety_stock_min, max(safety_stock) AS safety_stock_max, "
    "min(fulfillment_days) AS fulfillment_days_min, max(fulfillment_days) AS fulfillment_days_max, "
    "round_even(quantile_cont(safety_stock, 0.25), 6) AS safety_stock_q1, "
    "round_even(quantile_cont(safety_stock, 0.5), 6) AS safety_stock_median, "
    "round_even(quantile_cont(safety_stock, 0.75), 6) AS safety_stock_q3, "
    "round_even(quantile_cont(fulfillment_days, 0.25), 6) AS fulfillment_days_q1, "
    "round_even(quantile_cont(fulfillment_days, 0.5), 6) AS fulfillment_days_median, "
    "round_even(quantile_cont(fulfillment_days, 0.75), 6) AS fulfillment_days_q3 FROM policy GROUP BY abc_category"))
def class_quartiles(i):
    """Exact quartiles per class without one-task percentile buffers."""
    return ex.class_quartiles(i.policy_table)


def _hist_sql(cols=("priority_score", "eoq", "delivery_reliability", "demand_growth_mean"), bins=25):
    parts = []
    for c in cols:
        w = f"((s.mx - s.mn) / {float(bins)!r})"
        b = (f"CASE WHEN {w} = 0 THEN 0 WHEN {c} >= s.mx THEN {bins - 1} "
             f"ELSE CAST(floor(({c} - s.mn) / {w}) AS INTEGER) END")
        parts.append(f"SELECT {b} AS bin, count(*) AS count, '{c}' AS feature FROM policy, "
                     f"(SELECT min({c}) AS mn, max({c}) AS mx FROM policy) s WHERE {c} IS NOT NULL GROUP BY 1")
    return _union(parts)


@query("histograms", _wq(_hist_sql()))
def histograms(i):
    """25 equal-width bins per column."""
    return ex.histograms(i.policy_table)


def _corr_sql():
    feats = ex.CORRELATION_FEATURES
    pairs = list(combinations(feats, 2)) + [(f, f) for f in feats]
    up = _union([f"SELECT '{a}' AS feature1, '{b}' AS feature2, round_even(corr({a}, {b}), 6) AS correlation "
                 f"FROM policy" for a, b in pairs])
    return (f"SELECT * FROM ({up}) UNION ALL SELECT feature2, feature1, correlation FROM ({up}) "
            f"WHERE feature1 <> feature2")


@query("correlation_matrix", _wq(_corr_sql()))
def correlation_matrix(i):
    """A36."""
    return ex.correlation_matrix(i.policy_table)


def _strong_sql():
    pairs = list(combinations(ex.CORRELATION_FEATURES, 2))
    up = _union([f"SELECT '{a}' AS feature1, '{b}' AS feature2, corr({a}, {b}) AS r, {k} AS k FROM policy"
                 for k, (a, b) in enumerate(pairs)])
    return (f"SELECT feature1, feature2, round_even(r, 6) AS correlation FROM ({up}) WHERE abs(r) > 0.7 "
            f"ORDER BY abs(r) DESC, k LIMIT 5")


@query("strong_correlations", _wq(_strong_sql()))
def strong_correlations(i):
    """A37."""
    return ex.strong_correlations(i.policy_table)


@query("target_correlations", _wq(_union(
    [f"SELECT '{f}' AS feature, '{t}' AS target, round_even(abs(corr({f}, {t})), 6) AS abs_correlation FROM policy"
     for t in ex.TARGETS for f in ex.ML_NUMERIC if f != t])))
def target_correlations(i):
    """A38."""
    return ex.target_correlations(i.policy_table)


def _iqr_sql():
    parts = []
    for c in ex.OUTLIER_COLUMNS:
        parts.append(
            f"SELECT count(*) FILTER (WHERE {c} < q.lo OR {c} > q.hi) AS outliers, round_even(q.q1, 6) AS q1, "
            f"round_even(q.q3, 6) AS q3, round_even(q.lo, 6) AS lower, round_even(q.hi, 6) AS upper, "
            f"'{c}' AS feature, count(*) FILTER (WHERE {c} < q.lo OR {c} > q.hi) / (SELECT count(*) FROM policy) "
            f"* 100.0 AS pct FROM policy, (SELECT q1, q3, q1 - (q3 - q1) * 1.5 AS lo, q3 + (q3 - q1) * 1.5 AS hi "
            f"FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM policy)) q "
            f"GROUP BY q.q1, q.q3, q.lo, q.hi")
    return _union(parts)


@query("iqr_outliers", _wq(_iqr_sql()))
def iqr_outliers(i):
    """Q9."""
    return ex.iqr_outliers(i.policy_table)


def _skew_sql():
    parts = []
    for c in ex.ML_NUMERIC:
        x = (f"(CASE WHEN {c} IS NULL OR isnan({c}) OR abs({c}) = CAST('inf' AS DOUBLE) THEN 0.0 "
             f"ELSE CAST({c} AS DOUBLE) END)")
        parts.append(f"SELECT '{c}' AS feature, (SELECT avg(pow(v - m, 3)) / pow(avg(pow(v - m, 2)), 1.5) FROM "
                     f"(SELECT {x} AS v, avg({x}) OVER () AS m FROM policy)) AS s")
    return f"SELECT feature, round_even(s, 4) AS skewness FROM ({_union(parts)}) WHERE abs(s) > 1"


@query("skewed_features", _wq(_skew_sql()))
def skewed_features(i):
    """Q10: population skewness of the cleaned ML features."""
    from provisio.functions.columns import finite0
    ml = i.policy_table.select(*[finite0(c).alias(c) for c in ex.ML_NUMERIC])
    return ex.skewed_features(ml)


def _dq_score_sql():
    cols = POLICY_ALL
    nums = POLICY_NUMERIC
    checked = [c for c in nums if any(s in c for s in ("qty", "sales", "inv"))]
    miss = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in cols)
    neg = " + ".join(f"count(*) FILTER (WHERE {c} < 0)" for c in checked)
    return (f"SELECT completeness, uniqueness, consistency, "
            f"round_even((completeness + uniqueness + consistency) / 3.0, 6) AS overall FROM ("
            f"SELECT (count(*) * {len(cols)} - ({miss})) / (count(*) * {len(cols)}) * 100.0 AS completeness, "
            f"count(DISTINCT product_id) / count(*) * 100.0 AS uniqueness, "
            f"(count(*) * {len(nums)} - ({neg})) / (count(*) * {len(nums)}) * 100.0 AS consistency FROM policy)")


@query("dq_score", _wq(_dq_score_sql()))
def dq_score(i):
    """Q6: completeness, uniqueness, consistency and their mean for the product table."""
    return ex.dq_score(i.policy_table.select(*POLICY_ALL))


@query("feature_completeness", _wq(_union(
    [f"SELECT '{c}' AS feature, count({c}) / count(*) * 100.0 AS completeness_pct FROM policy"
     for c in POLICY_NUMERIC])))
def feature_completeness(i):
    """Q7."""
    return ex.feature_completeness(i.policy_table.select(*POLICY_ALL))


@query("describe_features", _wq(_union(
    [f"SELECT count({c}) AS count, round_even(avg({c}), 6) AS mean, round_even(stddev_samp({c}), 6) AS std, "
     f"CAST(min({c}) AS DOUBLE) AS min, round_even(quantile_cont({c}, 0.25), 6) AS q25, "
     f"round_even(quantile_cont({c}, 0.5), 6) AS q50, round_even(quantile_cont({c}, 0.75), 6) AS q75, "
     f"CAST(max({c}) AS DOUBLE) AS max, '{c}' AS feature FROM policy" for c in DESCRIBE_COLS])))
def describe_features(i):
    """Q15."""
    return ex.describe_features(i.policy_table, DESCRIBE_COLS)
