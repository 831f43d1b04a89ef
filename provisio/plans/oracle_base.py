"""DuckDB SQL for the oracle: the stand-in inputs and the feature tables.

Written from the operator definitions, independently of the Spark plans.
Each query string is ``WITH <ctes> SELECT ...``; DuckDB drops the CTEs a query
does not reference.
"""

from __future__ import annotations


def r4(x: str) -> str:
    return f"round_even(CAST({x} AS DOUBLE), 4)"


def ratio(n: str, d: str) -> str:
    """pandas division: x/0 -> +-inf, 0/0 -> NULL."""
    return (f"(CASE WHEN ({d}) = 0 THEN (CASE WHEN ({n}) > 0 THEN CAST('inf' AS DOUBLE) "
            f"WHEN ({n}) < 0 THEN CAST('-inf' AS DOUBLE) END) "
            f"ELSE CAST({n} AS DOUBLE) / CAST({d} AS DOUBLE) END)")


def ratio0(n: str, d: str) -> str:
    return f"COALESCE({ratio(n, d)}, 0.0)"


def fill0(x: str) -> str:
    """pandas fillna(0) on a double: NULL and NaN -> 0."""
    return f"(CASE WHEN isnan(CAST({x} AS DOUBLE)) THEN 0.0 ELSE COALESCE(CAST({x} AS DOUBLE), 0.0) END)"


def sqrt_nan(x: str) -> str:
    return f"(CASE WHEN ({x}) < 0 THEN NULL ELSE sqrt({x}) END)"


def mean_r4(x: str, scale: int = 9) -> str:
    """Exact mean rounded half-even to 4 decimals (integer arithmetic on nine decimals)."""
    units = f"sum(CAST(CAST({x} AS DECIMAL(28,{scale})) * {10 ** scale} AS HUGEINT))"
    n = f"count({x})"
    m = f"({units} * 10000)"
    d = f"({n} * {10 ** scale})"
    a = f"abs({m})"
    q = f"({a} // {d})"
    r = f"({a} % {d})"
    rr = f"({q} + CASE WHEN 2 * {r} > {d} THEN 1 WHEN 2 * {r} = {d} THEN {q} % 2 ELSE 0 END)"
    return (f"(CASE WHEN {n} = 0 THEN NULL ELSE CAST(CASE WHEN {m} < 0 THEN -{rr} ELSE {rr} END AS DOUBLE)"
            f" / 10000.0 END)")


def dbl(v: float) -> str:
    return f"CAST({v!r} AS DOUBLE)"


CTE_INPUTS = f"""
raw_orders AS (
  SELECT l.l_orderkey AS order_id, l.l_partkey AS product_id, l.l_suppkey AS supplier_id,
         p.p_type AS department,
         CAST(o.o_orderdate AS DATE) AS order_date,
         CAST((((datediff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) % 8) + 8) % 8)
              AS INTEGER) AS _actual,
         CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) * 2 AS scheduled_days,
         l.l_quantity AS qty,
         CAST(l.l_extendedprice AS DECIMAL(12,2)) AS sales,
         CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2)))
              - CAST(l.l_quantity AS DECIMAL(12,0)) * CAST(p.p_retailprice AS DECIMAL(12,2))
              AS DECIMAL(18,4)) AS profit,
         l.l_discount AS discount
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                  JOIN part p ON l.l_partkey = p.p_partkey),
v_orders AS (
  SELECT order_id, product_id, supplier_id, department, order_date,
         CAST(order_date + _actual AS DATE) AS shipment_date, scheduled_days, qty, sales, profit, discount
  FROM raw_orders),
lines AS (
  SELECT *,
         CAST(year(order_date) AS INTEGER) AS year, CAST(month(order_date) AS INTEGER) AS month,
         CAST(quarter(order_date) AS INTEGER) AS quarter,
         CAST(isodow(order_date) - 1 AS INTEGER) AS day_of_week,
         CAST(dayofyear(order_date) AS INTEGER) AS day_of_year,
         CAST(weekofyear(order_date) AS INTEGER) AS week_of_year,
         CASE WHEN isodow(order_date) - 1 >= 5 THEN 1 ELSE 0 END AS is_weekend,
         CASE WHEN month(order_date) IN (11, 12) THEN 1 ELSE 0 END AS is_holiday,
         CASE WHEN month(order_date) IN (8, 9) THEN 1 ELSE 0 END AS is_back_to_school,
         CASE WHEN month(order_date) IN (6, 7, 8) THEN 1 ELSE 0 END AS is_summer,
         CAST(datediff('day', order_date, shipment_date) AS INTEGER) AS actual_days,
         CAST(datediff('day', order_date, shipment_date) - scheduled_days AS INTEGER) AS delay,
         CASE WHEN datediff('day', order_date, shipment_date) - scheduled_days <= 0 THEN 1 ELSE 0 END AS on_time,
         CASE WHEN datediff('day', order_date, shipment_date) - scheduled_days < -1 THEN 1 ELSE 0 END AS early,
         CASE WHEN datediff('day', order_date, shipment_date) - scheduled_days > 1 THEN 1 ELSE 0 END AS late
  FROM v_orders WHERE product_id IS NOT NULL),
inv_month AS (
  SELECT l.l_partkey AS product_id,
         CAST(year(l.l_shipdate) * 100 + month(l.l_shipdate) AS INTEGER) AS year_month,
         sum(CASE WHEN l.l_returnflag = 'R' THEN l.l_quantity ELSE 0.0 END) AS inventory,
         max(p.p_retailprice) * (1.0 + max(l.l_tax)) AS unit_cost
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  GROUP BY l.l_partkey, year(l.l_shipdate) * 100 + month(l.l_shipdate)),
inventory AS (
  SELECT product_id, year_month, inventory, unit_cost,
         CAST(strptime(CAST(year_month AS VARCHAR), '%Y%m') AS DATE) AS month_date
  FROM inv_month),
fulfil AS (SELECT p_partkey AS product_id, p_size / 5.0 AS fulfillment_days FROM part)
"""

CTE_FEATURES = f"""
qmode AS (
  SELECT product_id, quarter AS quarter_mode FROM (
    SELECT product_id, quarter,
           row_number() OVER (PARTITION BY product_id ORDER BY count(*) DESC, quarter ASC) AS rn
    FROM lines GROUP BY product_id, quarter) WHERE rn = 1),
dagg AS (
  SELECT product_id,
    {r4('sum(qty)')} AS qty_sum,
    {mean_r4('qty')} AS qty_mean,
    {r4('stddev_samp(qty)')} AS qty_std,
    {r4('min(qty)')} AS qty_min,
    {r4('max(qty)')} AS qty_max,
    count(qty) AS qty_count,
    {r4('sum(sales)')} AS sales_sum,
    {mean_r4('sales')} AS sales_mean,
    {r4('stddev_samp(CAST(sales AS DOUBLE))')} AS sales_std,
    {r4('sum(profit)')} AS profit_sum,
    {mean_r4('profit')} AS profit_mean,
    count(DISTINCT order_id) AS order_nunique,
    {mean_r4('is_holiday')} AS holiday_mean,
    {mean_r4('is_weekend')} AS weekend_mean,
    {mean_r4('actual_days')} AS ship_days_mean,
    {r4('stddev_samp(actual_days)')} AS ship_days_std,
    {mean_r4('delay')} AS delay_mean,
    {r4('stddev_samp(delay)')} AS delay_std,
    {mean_r4('on_time')} AS on_time_mean,
    {mean_r4('early')} AS early_mean,
    {mean_r4('late')} AS late_mean
  FROM lines GROUP BY product_id),
monthly AS (
  SELECT product_id, year, month, sum(qty) AS qty, CAST(year * 100 + month AS INTEGER) AS year_month
  FROM lines GROUP BY product_id, year, month),
growth AS (
  SELECT product_id, year, month, year_month, qty,
         {ratio('qty', 'prev')} - 1.0 AS growth,
         CAST(rn - 1 AS DOUBLE) AS idx
  FROM (SELECT *, lag(qty) OVER (PARTITION BY product_id ORDER BY year_month) AS prev,
               row_number() OVER (PARTITION BY product_id ORDER BY year_month) AS rn
        FROM monthly)),
trend AS (
  SELECT product_id,
         {r4('avg(growth)')} AS demand_growth_mean,
         {r4('stddev_samp(growth)')} AS demand_growth_std,
         {r4('COALESCE(regr_slope(qty, idx), 0.0)')} AS demand_trend_slope
  FROM growth GROUP BY product_id),
demand AS (
  SELECT d.product_id, qty_sum, qty_mean, qty_std, qty_min, qty_max, qty_count,
         sales_sum, sales_mean, sales_std, profit_sum, profit_mean, order_nunique,
         holiday_mean, weekend_mean, q.quarter_mode,
         {ratio0('qty_std', 'qty_mean')} AS demand_variability,
         {ratio0('sales_sum', 'qty_sum')} AS revenue_per_unit,
         {ratio0('profit_sum', 'sales_sum')} AS profit_margin,
         order_nunique / 365.0 AS order_frequency,
         t.demand_growth_mean, t.demand_growth_std, t.demand_trend_slope,
         ship_days_mean, ship_days_std, delay_mean, delay_std, on_time_mean, early_mean, late_mean
  FROM dagg d JOIN qmode q ON d.product_id = q.product_id
              LEFT JOIN trend t ON d.product_id = t.product_id),
supfeat AS (
  SELECT d.product_id, ship_days_mean, ship_days_std, delay_mean, delay_std, on_time_mean, early_mean,
         late_mean, f.fulfillment_days,
         1.0 - late_mean AS delivery_reliability,
         {ratio('1.0', '1.0 + ship_days_std')} AS fulfillment_consistency
  FROM dagg d LEFT JOIN fulfil f ON d.product_id = f.product_id),
cur AS (
  SELECT product_id, inventory AS current_inventory, unit_cost AS current_unit_cost FROM (
    SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY year_month DESC, inventory ASC,
                                 unit_cost ASC) AS rn
    FROM inventory WHERE product_id IS NOT NULL) WHERE rn = 1),
iagg AS (
  SELECT product_id,
    {mean_r4('inventory')} AS inv_mean,
    {r4('stddev_samp(inventory)')} AS inv_std,
    {r4('min(inventory)')} AS inv_min,
    {r4('max(inventory)')} AS inv_max,
    count(inventory) AS inv_count,
    {mean_r4('unit_cost')} AS cost_mean,
    {r4('stddev_samp(unit_cost)')} AS cost_std,
    min(year_month) AS ym_min, max(year_month) AS ym_max,
    avg(CASE WHEN inventory = 0 THEN 1.0 ELSE 0.0 END) AS stockout_frequency,
    avg(CASE WHEN inventory > 0 AND inventory <= 5 THEN 1.0 ELSE 0.0 END) AS low_stock_frequency
  FROM inventory WHERE product_id IS NOT NULL GROUP BY product_id),
invf AS (
  SELECT i.*, {ratio0('inv_std', 'inv_mean')} AS inventory_variability,
         {ratio0('cost_std', 'cost_mean')} AS cost_variability,
         c.current_inventory, c.current_unit_cost
  FROM iagg i JOIN cur c ON i.product_id = c.product_id),
features AS (
  SELECT COALESCE(d.product_id, i.product_id) AS product_id,
    {fill0('d.qty_sum')} AS qty_sum, {fill0('d.qty_mean')} AS qty_mean, {fill0('d.qty_std')} AS qty_std,
    {fill0('d.qty_min')} AS qty_min, {fill0('d.qty_max')} AS qty_max, COALESCE(d.qty_count, 0) AS qty_count,
    {fill0('d.sales_sum')} AS sales_sum, {fill0('d.sales_mean')} AS sales_mean,
    {fill0('d.sales_std')} AS sales_std, {fill0('d.profit_sum')} AS profit_sum,
    {fill0('d.profit_mean')} AS profit_mean, COALESCE(d.order_nunique, 0) AS order_nunique,
    {fill0('d.holiday_mean')} AS holiday_mean, {fill0('d.weekend_mean')} AS weekend_mean,
    COALESCE(d.quarter_mode, 0) AS quarter_mode,
    {fill0('d.demand_variability')} AS demand_variability, {fill0('d.revenue_per_unit')} AS revenue_per_unit,
    {fill0('d.profit_margin')} AS profit_margin, {fill0('d.order_frequency')} AS order_frequency,
    {fill0('d.demand_growth_mean')} AS demand_growth_mean, {fill0('d.demand_growth_std')} AS demand_growth_std,
    {fill0('d.demand_trend_slope')} AS demand_trend_slope,
    {fill0('i.inv_mean')} AS inv_mean, {fill0('i.inv_std')} AS inv_std, {fill0('i.inv_min')} AS inv_min,
    {fill0('i.inv_max')} AS inv_max, COALESCE(i.inv_count, 0) AS inv_count,
    {fill0('i.cost_mean')} AS cost_mean, {fill0('i.cost_std')} AS cost_std,
    COALESCE(i.ym_min, 0) AS ym_min, COALESCE(i.ym_max, 0) AS ym_max,
    {fill0('i.inventory_variability')} AS inventory_variability, {fill0('i.cost_variability')} AS cost_variability,
    {fill0('i.stockout_frequency')} AS stockout_frequency, {fill0('i.low_stock_frequency')} AS low_stock_frequency,
    {fill0('i.current_inventory')} AS current_inventory, {fill0('i.current_unit_cost')} AS current_unit_cost,
    {fill0('s.ship_days_mean')} AS ship_days_mean, {fill0('s.ship_days_std')} AS ship_days_std,
    {fill0('s.delay_mean')} AS delay_mean, {fill0('s.delay_std')} AS delay_std,
    {fill0('s.on_time_mean')} AS on_time_mean, {fill0('s.early_mean')} AS early_mean,
    {fill0('s.late_mean')} AS late_mean, {fill0('s.fulfillment_days')} AS fulfillment_days,
    {fill0('s.delivery_reliability')} AS delivery_reliability,
    {fill0('s.fulfillment_consistency')} AS fulfillment_consistency
  FROM demand d LEFT JOIN supfeat s ON d.product_id = s.product_id
  FULL OUTER JOIN invf i ON d.product_id = i.product_id),
pol1 AS (
  SELECT *,
    COALESCE(1.65 * qty_std * {sqrt_nan('fulfillment_days / 30.0')}, 0.0) AS safety_stock,
    qty_mean / 30.0 AS daily_demand,
    qty_sum * 1.0 AS annual_demand
  FROM features),
pol2 AS (
  SELECT *,
    COALESCE(daily_demand * fulfillment_days + safety_stock, 0.0) AS reorder_point,
    COALESCE({sqrt_nan(ratio('2.0 * annual_demand * 50.0', 'current_unit_cost * 0.2'))}, 0.0) AS eoq,
    {ratio0('current_inventory', 'daily_demand')} AS days_supply,
    CAST(dense_rank() OVER (ORDER BY sales_sum DESC) AS DOUBLE) AS revenue_rank,
    CAST(count(*) OVER () AS DOUBLE) AS n_products
  FROM pol1),
pol3 AS (
  SELECT *,
    CASE WHEN revenue_rank <= n_products * 0.2 THEN 'A'
         WHEN revenue_rank <= n_products * 0.5 THEN 'B' ELSE 'C' END AS abc_category,
    CASE WHEN current_inventory > reorder_point * 2.0 THEN 'Overstock'
         WHEN current_inventory = 0 THEN 'Stockout'
         WHEN current_inventory <= reorder_point THEN 'Reorder_Required' ELSE 'Normal' END AS stock_status,
    stockout_frequency * 40.0 + least(greatest(demand_growth_mean * 20.0, 0.0), 20.0)
      + (1.0 - revenue_rank / n_products) * 25.0 + (1.0 - delivery_reliability) * 15.0 AS priority_score
  FROM pol2),
policy AS (
  SELECT * EXCLUDE (n_products),
    CASE WHEN demand_growth_mean < -0.1 AND stock_status = 'Normal' THEN 'Decrease_Stock'
         WHEN demand_growth_mean > 0.1 AND stock_status = 'Normal' THEN 'Increase_Stock'
         WHEN stock_status = 'Overstock' THEN 'Reduce_Orders'
         WHEN stock_status = 'Reorder_Required' THEN 'Reorder_Soon'
         WHEN stock_status = 'Stockout' THEN 'Urgent_Reorder' ELSE 'Monitor' END AS recommended_action
  FROM pol3)
"""


def with_ctes(select: str) -> str:
    return "WITH " + CTE_INPUTS.strip() + ",\n" + CTE_FEATURES.strip() + "\n" + select
