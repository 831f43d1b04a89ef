"""Queries: the procurement cycle (suppliers, decisions, orders, negotiations, alerts, reports)."""

from __future__ import annotations

from pyspark.sql import functions as F

from provisio.operators import cycle as cy
from provisio.operators import features as fe
from provisio.plans.catalog import query
from provisio.plans.oracle_base import with_ctes
from provisio.sources import adapter

PD = repr(0.85 * 0.1)   # quality weight term, as the double Python computes it
PP = repr(1.0 * 0.3)    # price weight term

CYCLE_CTE = f""",
cur_stock AS (
  SELECT product_id, inventory AS current_stock FROM (
    SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY year_month DESC, inventory ASC) AS rn
    FROM inv_month) WHERE rn = 1),
supp_list AS (SELECT l_partkey AS product_id, list_sort(list(DISTINCT l_suppkey)) AS supplier_ids
              FROM lineitem GROUP BY l_partkey),
v_products AS (
  SELECT p_partkey AS product_id, p_name AS name, p_type AS category, p_size AS min_stock_level,
         p_size * 5 AS max_stock_level, p_retailprice / 20.0 AS unit_cost, p_size AS lead_time,
         CAST(COALESCE(c.current_stock, 0.0) AS BIGINT) AS current_stock, s.supplier_ids
  FROM part LEFT JOIN cur_stock c ON part.p_partkey = c.product_id
            LEFT JOIN supp_list s ON part.p_partkey = s.product_id),
sup_rel AS (SELECT supplier_id, 1.0 - avg(CAST(late AS DOUBLE)) AS reliability_score FROM lines GROUP BY supplier_id),
v_suppliers AS (
  SELECT s_suppkey AS supplier_id, s_name AS name, CAST(s_suppkey % 30 + 1 AS INTEGER) AS lead_time_days,
         ['Economy', 'Standard', 'Premium', 'Basic'][s_nationkey % 4 + 1] AS pricing_tier,
         COALESCE(r.reliability_score, 0.0) AS reliability_score
  FROM supplier LEFT JOIN sup_rel r ON supplier.s_suppkey = r.supplier_id),
sscore AS (
  SELECT supplier_id, name, reliability_score, lead_time_days, pricing_tier,
         CAST(CASE pricing_tier WHEN 'Economy' THEN 0.9 WHEN 'Standard' THEN 0.7 WHEN 'Premium' THEN 0.5
              ELSE 0.6 END AS DOUBLE) AS cost_competitiveness,
         CAST(0.85 AS DOUBLE) AS delivery_performance,
         reliability_score * 0.4 + CAST({PP} AS DOUBLE) + greatest(0.0, 1.0 - lead_time_days / 30.0) * 0.2
           + CAST({PD} AS DOUBLE) AS overall_score
  FROM v_suppliers),
ranked AS (SELECT *, row_number() OVER (ORDER BY overall_score DESC, supplier_id) AS rank FROM sscore),
bsup AS (
  SELECT product_id, supplier_id, name AS supplier_name, overall_score AS supplier_score FROM (
    SELECT p.product_id, r.supplier_id, r.name, r.overall_score,
           row_number() OVER (PARTITION BY p.product_id ORDER BY r.rank) AS rn
    FROM (SELECT product_id, unnest(supplier_ids) AS supplier_id FROM v_products) p
    JOIN ranked r ON p.supplier_id = r.supplier_id) WHERE rn = 1),
scored AS (SELECT product_id, qty_mean AS demand_pred, 0.9 * stockout_frequency + 0.05 AS risk_pred,
                  priority_score AS priority_pred FROM policy),
urgent AS (SELECT product_id, priority_pred FROM scored WHERE priority_pred > 60),
risky AS (SELECT product_id, risk_pred FROM scored WHERE risk_pred > 0.7
          AND product_id NOT IN (SELECT product_id FROM urgent)),
items AS (SELECT product_id, priority_pred AS ai_score, 'priority' AS source FROM urgent
          UNION ALL SELECT product_id, risk_pred, 'risk' FROM risky),
decisions AS (
  SELECT i.product_id, p.name AS product_name,
         COALESCE(CAST(b.supplier_id AS VARCHAR), 'DEFAULT') AS supplier_id,
         COALESCE(b.supplier_name, 'Default Supplier') AS supplier_name,
         CAST(greatest(0, p.max_stock_level - p.current_stock) AS BIGINT) AS order_quantity,
         CAST(p.unit_cost AS DECIMAL(18,4)) AS unit_price,
         CAST(CAST(greatest(0, p.max_stock_level - p.current_stock) AS BIGINT) * CAST(p.unit_cost AS DECIMAL(18,4))
              AS DECIMAL(18,4)) AS total_amount,
         'immediate' AS urgency, i.ai_score, i.source,
         concat_ws('; ', 'Immediate action required',
                   CASE WHEN p.current_stock < p.min_stock_level
                        THEN 'Below minimum stock level (' || CAST(p.min_stock_level AS VARCHAR) || ')' END,
                   CASE WHEN i.source = 'risk' AND i.ai_score > 0.7 THEN 'High stockout risk predicted' END,
                   CASE WHEN i.source = 'priority' AND i.ai_score > 70 THEN 'High procurement priority' END)
           AS justification,
         p.current_stock, p.min_stock_level
  FROM items i JOIN v_products p ON i.product_id = p.product_id LEFT JOIN bsup b ON i.product_id = b.product_id),
scheduled AS (
  SELECT i.product_id, p.name AS product_name,
         COALESCE(CAST(b.supplier_id AS VARCHAR), 'DEFAULT') AS supplier_id,
         COALESCE(b.supplier_name, 'Default Supplier') AS supplier_name,
         CAST(greatest(0, p.min_stock_level * 2 - p.current_stock) AS BIGINT) AS order_quantity,
         CAST(p.unit_cost AS DECIMAL(18,4)) AS unit_price,
         CAST(CAST(greatest(0, p.min_stock_level * 2 - p.current_stock) AS BIGINT) * CAST(p.unit_cost AS DECIMAL(18,4))
              AS DECIMAL(18,4)) AS total_amount,
         'scheduled' AS urgency, i.priority_pred AS ai_score, 'priority' AS source,
         CASE WHEN p.current_stock < p.min_stock_level
              THEN 'Below minimum stock level (' || CAST(p.min_stock_level AS VARCHAR) || ')' ELSE 'Standard reorder' END AS justification
  FROM scored i JOIN v_products p ON i.product_id = p.product_id LEFT JOIN bsup b ON i.product_id = b.product_id
  WHERE i.priority_pred > 40 AND i.priority_pred <= 60 AND i.product_id NOT IN (SELECT product_id FROM decisions)
    AND p.min_stock_level * 2 > p.current_stock),
porders AS (
  SELECT 'PO_20240131_080000_' || CAST(product_id AS VARCHAR) AS order_id, product_id, supplier_id,
         order_quantity AS quantity, unit_price, total_amount, 'critical' AS priority, 'pending' AS status,
         TIMESTAMP '2024-01-31 08:00:00' AS created_at, TIMESTAMP '2024-02-07 08:00:00' AS expected_delivery
  FROM decisions),
cands AS (
  SELECT order_id, product_id, supplier_id, quantity, unit_price AS original_price,
         CAST(unit_price * 0.95 AS DECIMAL(18,4)) AS target_price,
         CAST(total_amount * 0.05 AS DECIMAL(18,4)) AS expected_savings
  FROM porders WHERE total_amount > 1000.0),
offers AS (SELECT order_id, CAST(original_price * (1 - (product_id % 8) * 0.01) AS DECIMAL(18,4)) AS offer_price
           FROM cands),
negs AS (
  SELECT 'NEG_20240131_080000_' || c.order_id AS negotiation_id, c.order_id, c.product_id, c.supplier_id,
         c.original_price, greatest(o.offer_price, c.target_price) AS negotiated_price,
         CAST(c.original_price - greatest(o.offer_price, c.target_price) AS DECIMAL(18,4)) AS savings_amount,
         CAST(c.original_price - greatest(o.offer_price, c.target_price) AS DOUBLE) / CAST(c.original_price AS DOUBLE)
           AS savings_percentage,
         CAST(c.quantity * greatest(o.offer_price, c.target_price) AS DECIMAL(18,4)) AS new_total_amount
  FROM cands c JOIN offers o ON c.order_id = o.order_id WHERE o.offer_price < c.original_price),
lowstock AS (
  SELECT product_id, name, current_stock, min_stock_level,
         CASE WHEN min_stock_level = 0 THEN (CASE WHEN current_stock > 0 THEN CAST('inf' AS DOUBLE) END)
              ELSE CAST(current_stock AS DOUBLE) / CAST(min_stock_level AS DOUBLE) END AS stock_ratio
  FROM v_products),
alerts AS (
  SELECT 'ALERT_20240131_080000_low_stock_' || CAST(product_id AS VARCHAR) AS alert_id, 'low_stock' AS alert_type,
         CASE WHEN stock_ratio < 0.1 THEN 'high' ELSE 'medium' END AS severity, product_id,
         'Low stock alert for ' || name || ': ' || CAST(current_stock AS VARCHAR) || ' units remaining' AS message
  FROM lowstock WHERE stock_ratio <= 0.2
  UNION ALL
  SELECT 'ALERT_20240131_080000_high_value_order_' || CAST(product_id AS VARCHAR), 'high_value_order', 'high',
         product_id, 'High value order requires approval: $' || CAST(CAST(round(total_amount, 2) AS DECIMAL(18,2))
         AS VARCHAR)
  FROM decisions WHERE total_amount > 5000.0)
"""


def _wc(select: str) -> str:
    return with_ctes("").rstrip() + CYCLE_CTE + select


def money(c: str):
    return F.col(c).cast("double").alias(c)


@query("low_stock", _wc("SELECT product_id, name, current_stock, min_stock_level, stock_ratio FROM lowstock "
                        "WHERE stock_ratio <= 0.2"))
def low_stock(i):
    """C1."""
    return cy.low_stock(i.products)


@query("inventory_health", _wc(
    "SELECT count(*) AS products, count(*) FILTER (WHERE current_stock >= min_stock_level) AS healthy, "
    "COALESCE(avg(CASE WHEN current_stock >= min_stock_level THEN 1.0 ELSE 0.0 END), 0.0) AS health_score "
    "FROM v_products"))
def inventory_health(i):
    """C2."""
    return cy.inventory_health(i.products)


@query("inventory_status", _wc(
    "SELECT count(*) AS products, count(*) FILTER (WHERE current_stock = 0) AS out_of_stock, "
    "count(*) FILTER (WHERE current_stock > 0 AND current_stock < min_stock_level) AS below_minimum, "
    "count(*) FILTER (WHERE current_stock >= min_stock_level AND current_stock <= max_stock_level) AS normal, "
    "count(*) FILTER (WHERE current_stock > max_stock_level) AS above_maximum, "
    "avg(CASE WHEN current_stock >= min_stock_level THEN 1.0 ELSE 0.0 END) AS health_score FROM v_products"))
def inventory_status(i):
    """C28."""
    return cy.inventory_status(i.products)


@query("proxy_features", _wc(
    "SELECT product_id, CAST(current_stock AS DOUBLE) AS current_inventory, CAST(current_stock AS DOUBLE) AS qty_mean, "
    "0.2 AS demand_variability, unit_cost * 1.3 AS revenue_per_unit, 0.3 AS profit_margin, 4.0 AS order_frequency, "
    "CASE WHEN current_stock > min_stock_level THEN 0.1 ELSE 0.8 END AS stockout_frequency, "
    "0.85 AS delivery_reliability, 50.0 AS priority_score, 10.0 AS qty_std, 0.05 AS demand_growth_mean, "
    "0.02 AS demand_trend_slope, 0.15 AS low_stock_frequency, 2.0 AS fulfillment_days, 0.9 AS on_time_mean, "
    "CAST(min_stock_level AS DOUBLE) * 0.5 AS safety_stock, CAST(min_stock_level AS DOUBLE) AS reorder_point, "
    "100.0 AS eoq, 30.0 AS days_supply, 1 AS abc_category_encoded, "
    "CASE WHEN current_stock > min_stock_level THEN 0 ELSE 1 END AS stock_status_encoded FROM v_products"))
def proxy_features(i):
    """C18."""
    return cy.proxy_features(i.products)


@query("supplier_score", _wc("SELECT * FROM sscore"))
def supplier_score(i):
    """C3, C4, C25."""
    return i.scored_suppliers


@query("supplier_ranking", _wc("SELECT supplier_id, name, overall_score, rank FROM ranked"))
def supplier_ranking(i):
    """Global rank without a single-partition window."""
    return i.ranked_suppliers.select("supplier_id", "name", "overall_score", "rank")


@query("top_suppliers", _wc("SELECT supplier_id, name, overall_score FROM sscore "
                            "ORDER BY overall_score DESC, supplier_id LIMIT 5"))
def top_suppliers(i):
    """T6."""
    return cy.top_suppliers(i.scored_suppliers).select("supplier_id", "name", "overall_score")


@query("supplier_insights", _wc(
    "SELECT round_even(avg(overall_score), 9) AS average_supplier_score, "
    "(SELECT name FROM sscore ORDER BY overall_score DESC, supplier_id LIMIT 1) AS top_performing_supplier, "
    "max(overall_score) AS top_supplier_score, "
    "count(*) FILTER (WHERE overall_score < 0.7) AS suppliers_needing_improvement FROM sscore"))
def supplier_insights(i):
    """C5."""
    return cy.supplier_insights(i.scored_suppliers).withColumn(
        "average_supplier_score", F.bround("average_supplier_score", 9))


@query("supplier_policy", _wc(
    "SELECT supplier_id, name, reliability_score, lead_time_days, pricing_tier, cost_competitiveness, "
    "delivery_performance, overall_score, row_number() OVER (ORDER BY overall_score DESC, supplier_id) AS rank "
    "FROM sscore WHERE reliability_score >= 0.7"))
def supplier_policy(i):
    """C33 (declared): minimum reliability 0.7."""
    return cy.supplier_policy(i.scored_suppliers)


@query("best_supplier", _wc("SELECT * FROM bsup"))
def best_supplier(i):
    """W6, J6."""
    return cy.best_supplier(i.products, i.ranked_suppliers, i.supplier_pairs)


@query("supplier_recommend", _wc(
    "SELECT product_id, position, supplier_id, name, overall_score FROM ("
    "SELECT p.product_id, r.supplier_id, r.name, r.overall_score, "
    "row_number() OVER (PARTITION BY p.product_id ORDER BY r.rank) AS position "
    "FROM (SELECT product_id, unnest(supplier_ids) AS supplier_id FROM v_products) p "
    "JOIN ranked r ON p.supplier_id = r.supplier_id) WHERE position <= 3"))
def supplier_recommend(i):
    """C27."""
    return cy.supplier_recommend(i.products, i.ranked_suppliers, pairs=i.supplier_pairs)


@query("supplier_performance", _wc(
    "SELECT supplier_id, count(*) AS order_lines, count(DISTINCT order_id) AS orders, avg(on_time) AS on_time_rate, "
    "avg(actual_days) AS avg_lead_time_days, avg(delay) AS avg_delay_days FROM lines GROUP BY supplier_id"))
def supplier_performance(i):
    """C26."""
    return cy.supplier_performance(i.lines)


@query("quote_comparison", _wc(
    "SELECT product_id, arg_min(supplier_id, (quote_price, supplier_id)) AS best_supplier_id, "
    "CAST(min(quote_price) AS DOUBLE) AS best_price, CAST(max(quote_price) AS DOUBLE) AS highest_price, "
    "count(*) AS quotes, CAST(max(quote_price) - min(quote_price) AS DOUBLE) AS spread FROM ("
    "SELECT l_partkey AS product_id, l_suppkey AS supplier_id, "
    "CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) / sum(l_quantity) AS quote_price "
    "FROM lineitem GROUP BY 1, 2) GROUP BY product_id"))
def quote_comparison(i):
    """Cheapest quote per product; quotes = mean unit price per (product, supplier)."""
    q = cy.quote_comparison(adapter.supplier_quotes(i.spark, i.sf_dir))
    return q.select("product_id", "best_supplier_id", money("best_price"), money("highest_price"), "quotes",
                    money("spread"))


@query("priority_ranking", _wc(
    "SELECT product_id, priority_pred, row_number() OVER (ORDER BY priority_pred DESC, product_id) AS rank, "
    "CASE WHEN priority_pred > 80 THEN 'Critical' WHEN priority_pred > 60 THEN 'High' WHEN priority_pred > 40 "
    "THEN 'Medium' WHEN priority_pred > 20 THEN 'Low' ELSE 'Minimal' END AS priority_level FROM scored"))
def priority_ranking(i):
    """W5, S8."""
    return cy.priority_ranking(i.scored)


@query("urgent_items", _wc(
    "SELECT product_id, priority_pred, CASE WHEN priority_pred > 80 THEN 'Critical' ELSE 'High' END "
    "AS priority_level FROM urgent ORDER BY priority_pred DESC, product_id LIMIT 10"))
def urgent_items(i):
    """T5."""
    return cy.urgent_items(i.scored)


@query("high_risk_scored", _wc("SELECT product_id, risk_pred FROM scored WHERE risk_pred > 0.7"))
def high_risk_scored(i):
    """T7."""
    return cy.high_risk_scored(i.scored)


@query("risk_bands", _wc(
    "SELECT CASE WHEN risk_pred > 0.7 THEN 'High Risk' WHEN risk_pred > 0.4 THEN 'Medium Risk' "
    "WHEN risk_pred > 0.2 THEN 'Low Risk' ELSE 'Very Low Risk' END AS band, count(*) AS products "
    "FROM scored GROUP BY 1"))
def risk_bands(i):
    """S5."""
    return i.scored.groupBy(cy.risk_band("risk_pred").alias("band")).agg(F.count(F.lit(1)).alias("products"))


@query("risk_recommendations", _wc(
    "SELECT * FROM (SELECT 'Critical' AS priority, printf('Immediate reordering required for %d high-risk products', "
    "count(*) FILTER (WHERE risk_pred > 0.7)) AS action, 'Within 24 hours' AS timeline, "
    "count(*) FILTER (WHERE risk_pred > 0.7) > 0 AS keep FROM scored UNION ALL "
    "SELECT 'Medium', printf('Schedule reordering for %d medium-risk products', "
    "count(*) FILTER (WHERE risk_pred > 0.4 AND risk_pred <= 0.7)), 'Within 1 week', "
    "count(*) FILTER (WHERE risk_pred > 0.4 AND risk_pred <= 0.7) > 0 FROM scored UNION ALL "
    "SELECT 'Low', 'Monitor inventory levels and update forecasts', 'Ongoing', true) WHERE keep"))
def risk_recommendations(i):
    """S6."""
    return cy.risk_recommendations(i.scored).withColumn("keep", F.lit(True))


@query("procurement_schedule", _wc(
    "SELECT CASE WHEN priority_pred > 80 THEN 'immediate' WHEN priority_pred > 60 THEN 'this_week' "
    "WHEN priority_pred > 40 THEN 'next_week' ELSE 'this_month' END AS bucket, count(*) AS products "
    "FROM scored GROUP BY 1"))
def procurement_schedule(i):
    """S9."""
    return cy.procurement_schedule(i.scored)


@query("portfolio_risk", _wc(
    "SELECT round_even(avg(risk_pred), 9) AS average_stockout_risk, count(*) FILTER (WHERE risk_pred > 0.7) "
    "AS high_risk_products, CASE WHEN avg(risk_pred) > 0.7 THEN 'High' WHEN avg(risk_pred) > 0.4 THEN 'Medium' "
    "ELSE 'Low' END AS overall_risk_level FROM scored"))
def portfolio_risk(i):
    """S11."""
    return cy.portfolio_risk(i.scored).withColumn("average_stockout_risk", F.bround("average_stockout_risk", 9))


@query("critical_items", _wc(
    "SELECT product_id, 'Immediate procurement required' AS action FROM scored "
    "WHERE demand_pred > (SELECT avg(demand_pred) FROM scored) * 1.5 "
    "AND product_id IN (SELECT product_id FROM scored WHERE risk_pred > 0.7) "
    "AND product_id IN (SELECT product_id FROM urgent)"))
def critical_items(i):
    """J8, U3, S10, C19."""
    return cy.critical_items(i.scored).select("product_id", "action")


@query("action_plan", _wc(
    "SELECT product_id, risk_pred, (SELECT count(*) FROM urgent) AS urgent_count, "
    "'Emergency procurement for high-risk products' AS action FROM scored WHERE risk_pred > 0.7 "
    "ORDER BY risk_pred DESC, product_id LIMIT 5"))
def action_plan(i):
    """S12."""
    return cy.action_plan(i.scored)


DEC_COLS = ("product_id, product_name, supplier_id, supplier_name, order_quantity, "
            "CAST(unit_price AS DOUBLE) AS unit_price, CAST(total_amount AS DOUBLE) AS total_amount, urgency, "
            "ai_score, source, justification")


@query("procurement_decisions", _wc(f"SELECT {DEC_COLS} FROM decisions"))
def procurement_decisions(i):
    """C6-C9, J7, J9."""
    return i.decisions.select("product_id", "product_name", "supplier_id", "supplier_name", "order_quantity",
                              money("unit_price"), money("total_amount"), "urgency", "ai_score", "source",
                              "justification")


@query("order_justification", _wc("SELECT product_id, justification FROM decisions"))
def order_justification(i):
    """C8."""
    return i.decisions.select("product_id", "justification")


ORDER_COLS = ("order_id, product_id, supplier_id, quantity, CAST(unit_price AS DOUBLE) AS unit_price, "
              "CAST(total_amount AS DOUBLE) AS total_amount, priority, status, created_at, expected_delivery")


def _orders_df(i):
    return i.orders_out.select("order_id", "product_id", "supplier_id", "quantity", money("unit_price"),
                               money("total_amount"), "priority", "status", "created_at", "expected_delivery")


@query("procurement_orders", _wc(f"SELECT {ORDER_COLS} FROM porders"))
def procurement_orders(i):
    """C10."""
    return _orders_df(i)


def _decisions_df(d):
    return d.select("product_id", "product_name", "supplier_id", "supplier_name", "order_quantity", money("unit_price"),
                    money("total_amount"), "urgency", "ai_score", "source", "justification")


@query("scheduled_decisions", _wc(f"SELECT {DEC_COLS} FROM scheduled"))
def scheduled_decisions(i):
    """The second phase: next week's bucket, up to twice the minimum stock."""
    return _decisions_df(i.scheduled)


@query("automated_orders", _wc(
    "SELECT 'PO_20240131_080000_' || CAST(product_id AS VARCHAR) AS order_id, product_id, supplier_id, order_quantity AS quantity, "
    "CAST(total_amount AS DOUBLE) AS total_amount, CASE urgency WHEN 'immediate' THEN 'critical' ELSE 'high' END AS priority, justification "
    "FROM (SELECT product_id, supplier_id, order_quantity, total_amount, urgency, justification FROM decisions "
    "UNION ALL SELECT product_id, supplier_id, order_quantity, total_amount, urgency, justification FROM scheduled)"))
def automated_orders(i):
    """Immediate and scheduled orders together, critical and high."""
    both = i.decisions.unionByName(i.scheduled)
    orders = cy.procurement_orders(both).join(both.select("product_id", "justification"), "product_id")
    return orders.select("order_id", "product_id", "supplier_id", "quantity", money("total_amount"), "priority", "justification")


@query("savings_of_all_orders", _wc(
    "SELECT count(*) AS orders, CAST(COALESCE(sum(total_amount), 0) AS DOUBLE) AS total_value, "
    "CAST(COALESCE(sum(total_amount), 0) * 0.05 AS DOUBLE) AS savings_potential "
    "FROM (SELECT total_amount FROM decisions UNION ALL SELECT total_amount FROM scheduled)"))
def savings_of_all_orders(i):
    """Savings potential over both phases."""
    return cy.savings_potential(i.decisions, i.scheduled)


@query("savings_potential", _wc(
    "SELECT count(*) AS orders, CAST(COALESCE(sum(total_amount), 0) AS DOUBLE) AS total_value, "
    "CAST(COALESCE(sum(total_amount), 0) * 0.05 AS DOUBLE) AS savings_potential "
    "FROM (SELECT total_amount FROM decisions UNION ALL SELECT total_amount FROM scheduled)"))
def savings_potential(i):
    """5% of the value of all orders of the cycle, immediate and scheduled."""
    return cy.savings_potential(i.decisions, i.scheduled)


@query("negotiation_candidates", _wc(
    "SELECT order_id, product_id, supplier_id, quantity, CAST(original_price AS DOUBLE) AS original_price, "
    "CAST(target_price AS DOUBLE) AS target_price, CAST(expected_savings AS DOUBLE) AS expected_savings FROM cands"))
def negotiation_candidates(i):
    """C12."""
    return i.candidates.select("order_id", "product_id", "supplier_id", "quantity", money("original_price"),
                               money("target_price"), money("expected_savings"))


@query("apply_negotiations", _wc(
    "SELECT negotiation_id, order_id, product_id, supplier_id, CAST(original_price AS DOUBLE) AS original_price, "
    "CAST(negotiated_price AS DOUBLE) AS negotiated_price, CAST(savings_amount AS DOUBLE) AS savings_amount, "
    "savings_percentage, CAST(new_total_amount AS DOUBLE) AS new_total_amount FROM negs"))
def apply_negotiations(i):
    """C13, C14."""
    return i.negotiations.select("negotiation_id", "order_id", "product_id", "supplier_id", money("original_price"),
                                 money("negotiated_price"), money("savings_amount"), "savings_percentage",
                                 money("new_total_amount"))


@query("alerts", _wc("SELECT alert_id, alert_type, severity, product_id, message FROM alerts"))
def alerts(i):
    """C15, C16."""
    return i.alerts.select("alert_id", "alert_type", "severity", "product_id", "message")


@query("cycle_summary", _wc(
    "SELECT count(*) AS total_orders_created, CAST(COALESCE(sum(total_amount), 0) AS DOUBLE) AS total_order_value, "
    "(SELECT count(*) FROM alerts) AS alerts_generated, (SELECT count(*) FROM negs) AS negotiations_initiated, "
    "CAST(COALESCE(sum(total_amount), 0) * 0.05 AS DOUBLE) AS estimated_savings, 0.85 AS automation_rate, "
    "CASE WHEN (SELECT count(*) FROM alerts) > 5 THEN 'Increase monitoring frequency due to high alert volume' "
    "WHEN count(*) > 10 THEN 'Review supplier capacity and lead times' "
    "ELSE 'Continue normal procurement cycle' END AS next_cycle_recommendation FROM porders"))
def cycle_summary(i):
    """C17."""
    return cy.cycle_summary(i.orders_out, i.alerts, i.negotiations)


@query("order_approval", _wc(
    "SELECT order_id, product_id, CAST(total_amount AS DOUBLE) AS total_amount, "
    "CASE WHEN total_amount < 1000.0 THEN 'auto_approved' ELSE 'manual_approval_required' END AS approval "
    "FROM porders"))
def order_approval(i):
    """C20."""
    return cy.order_approval(i.orders_out).withColumn("total_amount", F.col("total_amount").cast("double"))


@query("order_status_update", _wc(
    f"SELECT order_id, product_id, supplier_id, quantity, CAST(unit_price AS DOUBLE) AS unit_price, "
    f"CAST(total_amount AS DOUBLE) AS total_amount, priority, "
    f"COALESCE(CASE WHEN product_id % 3 = 0 THEN 'approved' WHEN product_id % 3 = 1 THEN 'cancelled' END, status) "
    f"AS status, created_at, expected_delivery FROM porders"))
def order_status_update(i):
    """approve/cancel decisions applied to the orders."""
    o = _orders_df(i)
    return cy.apply_status_decisions(o, adapter.status_decisions(o, "order_id").select("order_id", "new_status"),
                                     "order_id")


@query("alert_resolution", _wc(
    "SELECT alert_id, alert_type, severity, product_id, "
    "CASE WHEN product_id % 3 = 0 THEN 'resolved' ELSE 'open' END AS status FROM alerts"))
def alert_resolution(i):
    """Alerts resolved by a decision table."""
    a = i.alerts.select("alert_id", "alert_type", "severity", "product_id").withColumn("status", F.lit("open"))
    dec = a.filter(F.col("product_id") % 3 == 0).select("alert_id", F.lit("resolved").alias("new_status"))
    return cy.apply_status_decisions(a, dec, "alert_id")


@query("negotiation_accept", _wc(
    "SELECT negotiation_id, product_id, CASE WHEN product_id % 3 = 0 THEN 'accepted' ELSE 'active' END AS status "
    "FROM negs"))
def negotiation_accept(i):
    """Negotiations accepted by a decision table."""
    n = i.negotiations.select("negotiation_id", "product_id").withColumn("status", F.lit("active"))
    dec = n.filter(F.col("product_id") % 3 == 0).select("negotiation_id", F.lit("accepted").alias("new_status"))
    return cy.apply_status_decisions(n, dec, "negotiation_id")


@query("orders_page", _wc(f"SELECT {ORDER_COLS} FROM porders WHERE status = 'pending' "
                          f"ORDER BY total_amount DESC, order_id LIMIT 100"))
def orders_page(i):
    """Pending orders, largest first, limit 100 offset 0."""
    return cy.page(_orders_df(i), [F.col("total_amount").desc(), "order_id"], 100, 0, status="pending")


@query("alerts_page", _wc("SELECT alert_id, alert_type, severity, product_id, message FROM alerts "
                          "WHERE severity = 'high' ORDER BY alert_id LIMIT 50"))
def alerts_page(i):
    """High-severity alerts, limit 50."""
    return cy.page(i.alerts.select("alert_id", "alert_type", "severity", "product_id", "message"),
                   ["alert_id"], 50, severity="high")


@query("negotiations_page", _wc(
    "SELECT negotiation_id, product_id, CAST(savings_amount AS DOUBLE) AS savings_amount FROM negs "
    "ORDER BY negotiation_id LIMIT 20"))
def negotiations_page(i):
    """Negotiations, limit 20."""
    return cy.page(i.negotiations.select("negotiation_id", "product_id", money("savings_amount")),
                   ["negotiation_id"], 20)


@query("order_flags", _wc(
    "SELECT o.order_id, o.product_id, CAST(o.total_amount AS DOUBLE) AS total_amount, "
    "o.total_amount >= 500.0 AS negotiation_eligible, o.total_amount >= 10000.0 AS bulk_order, "
    "l.stock_ratio <= 0.05 AS emergency FROM porders o LEFT JOIN lowstock l ON o.product_id = l.product_id"))
def order_flags(i):
    """C34 (declared)."""
    return cy.order_flags(i.orders_out, i.product_table).withColumn("total_amount", F.col("total_amount").cast("double"))


@query("savings_report", _wc(
    "SELECT category, count(*) AS negotiations, CAST(sum(savings_amount) AS DOUBLE) AS total_savings, "
    "round_even(avg(savings_percentage), 9) AS avg_savings_percentage FROM negs n JOIN v_products p "
    "ON n.product_id = p.product_id GROUP BY category"))
def savings_report(i):
    """C30."""
    return cy.savings_report(i.negotiations, i.product_table).withColumn(
        "avg_savings_percentage", F.bround("avg_savings_percentage", 9))


@query("dashboard_kpis", _wc(
    "SELECT count(DISTINCT order_id) AS orders, count(*) AS order_lines, "
    "CAST(COALESCE(sum(sales), 0) AS DOUBLE) AS order_value, avg(on_time) AS on_time_rate, "
    "count(DISTINCT product_id) AS products, 30 AS window_days FROM lines "
    "WHERE order_date > (SELECT max(order_date) FROM lines) - INTERVAL 30 DAY"))
def dashboard_kpis(i):
    """Last 30 days."""
    return cy.dashboard_kpis(i.lines)


@query("daily_report", _wc(
    "SELECT k.*, (SELECT count(*) FROM alerts) AS alerts, "
    "(SELECT count(*) FROM alerts WHERE severity = 'high') AS high_alerts FROM ("
    "SELECT count(DISTINCT order_id) AS orders, CAST(COALESCE(sum(sales), 0) AS DOUBLE) AS order_value "
    "FROM lines WHERE order_date > (SELECT max(order_date) FROM lines) - INTERVAL 1 DAY) k"))
def daily_report(i):
    """KPIs of the last day with the alert counts."""
    k = cy.dashboard_kpis(i.lines, 1).select("orders", "order_value")
    a = i.alerts
    return (k.withColumn("alerts", a.select(F.count(F.lit(1))).scalar())
            .withColumn("high_alerts", a.filter(F.col("severity") == "high").select(F.count(F.lit(1))).scalar()))


@query("trend_alerts", _wc(
    "SELECT 'high_demand_increase' AS alert_type, product_id AS entity_id, year_month FROM ("
    "SELECT product_id, year_month, qty, lag(qty) OVER (PARTITION BY product_id ORDER BY year_month) AS prev "
    "FROM monthly) WHERE (CASE WHEN prev = 0 THEN (CASE WHEN qty - prev > 0 THEN CAST('inf' AS DOUBLE) END) "
    "ELSE (qty - prev) / prev END) > 0.3 "
    "UNION ALL SELECT 'supplier_performance_decline', supplier_id, year_month FROM ("
    "SELECT supplier_id, year_month, r, lag(r) OVER (PARTITION BY supplier_id ORDER BY year_month) AS prev FROM ("
    "SELECT supplier_id, CAST(year * 100 + month AS INTEGER) AS year_month, avg(on_time) AS r FROM lines "
    "GROUP BY 1, 2)) WHERE prev - r > 0.1 "
    "UNION ALL SELECT DISTINCT 'delivery_delay', product_id, CAST(year * 100 + month AS INTEGER) FROM lines "
    "WHERE delay > 2"))
def trend_alerts(i):
    """C35 (declared): demand +30%, supplier on-time -0.1, delays > 2 days."""
    sm = (i.lines.groupBy("supplier_id", (F.col("year") * 100 + F.col("month")).cast("int").alias("year_month"))
          .agg(F.avg("on_time").alias("on_time_rate")))
    return cy.trend_alerts(fe.monthly_demand(i.lines), sm, i.lines)
