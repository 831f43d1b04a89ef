"""The procurement cycle as DataFrame operators.

Inputs are tables, not Python objects: a product master, a supplier master and
a table of model scores per product (``product_id, demand_pred, risk_pred,
priority_pred``).  The cycle time is a parameter, never ``now()``, so
results are reproducible.  Money is kept as exact decimals (prices have at
most four decimals), so totals, savings and alert texts do not depend on
summation order or floating-point formatting.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provisio.functions.columns import ratio
from provisio.functions.ranking import global_row_number
from provisio.params import CycleParams

# Fixed values throughout this module: thresholds, weights, days, and the names and texts of levels, orders and alerts.
MONEY = "decimal(18,4)"
DEFAULT_CYCLE_TIME = datetime(2024, 1, 31, 8, 0, 0)


def _ts(t: datetime):
    return F.lit(t.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def _stamp(t: datetime) -> str:
    return t.strftime("%Y%m%d_%H%M%S")


# ---------------------------------------------------------------- products

def low_stock(products: DataFrame, p: CycleParams = CycleParams()) -> DataFrame:
    """Stock / minimum <= 0.2, with the ratio."""
    return (products.withColumn("stock_ratio", ratio("current_stock", "min_stock_level"))
            .filter(F.col("stock_ratio") <= p.low_stock_ratio)
            .select("product_id", "name", "current_stock", "min_stock_level", "stock_ratio"))


def inventory_health(products: DataFrame) -> DataFrame:
    """Share of products with stock >= minimum."""
    return products.agg(F.count(F.lit(1)).alias("products"),
                        F.count_if(F.col("current_stock") >= F.col("min_stock_level")).alias("healthy"),
                        F.coalesce(F.avg((F.col("current_stock") >= F.col("min_stock_level")).cast("double")),
                                   F.lit(0.0)).alias("health_score"))


def inventory_status(products: DataFrame) -> DataFrame:
    """Products in stock-out, low, normal and over maximum, plus the health score."""
    s, mn, mx = F.col("current_stock"), F.col("min_stock_level"), F.col("max_stock_level")
    return products.agg(
        F.count(F.lit(1)).alias("products"),
        F.count_if(s == 0).alias("out_of_stock"),
        F.count_if((s > 0) & (s < mn)).alias("below_minimum"),
        F.count_if((s >= mn) & (s <= mx)).alias("normal"),
        F.count_if(s > mx).alias("above_maximum"),
        F.avg((s >= mn).cast("double")).alias("health_score"))


def proxy_features(products: DataFrame, p: CycleParams = CycleParams()) -> DataFrame:
    """The feature row the engine builds from the product master (fixed defaults)."""
    s, mn = F.col("current_stock").cast("double"), F.col("min_stock_level").cast("double")
    above = F.col("current_stock") > F.col("min_stock_level")
    return products.select(
        "product_id",
        s.alias("current_inventory"), s.alias("qty_mean"),
        F.lit(0.2).alias("demand_variability"),
        (F.col("unit_cost") * 1.3).alias("revenue_per_unit"),
        F.lit(0.3).alias("profit_margin"), F.lit(4.0).alias("order_frequency"),
        F.when(above, p.proxy_low_risk).otherwise(p.urgent_stockout_risk).alias("stockout_frequency"),
        F.lit(0.85).alias("delivery_reliability"), F.lit(50.0).alias("priority_score"),
        F.lit(10.0).alias("qty_std"), F.lit(0.05).alias("demand_growth_mean"),
        F.lit(0.02).alias("demand_trend_slope"), F.lit(0.15).alias("low_stock_frequency"),
        F.lit(2.0).alias("fulfillment_days"), F.lit(0.9).alias("on_time_mean"),
        (mn * 0.5).alias("safety_stock"), mn.alias("reorder_point"), F.lit(100.0).alias("eoq"),
        F.lit(30.0).alias("days_supply"), F.lit(1).alias("abc_category_encoded"),
        F.when(above, 0).otherwise(1).alias("stock_status_encoded"))


# ---------------------------------------------------------------- suppliers

def supplier_score(suppliers: DataFrame, p: CycleParams = CycleParams()) -> DataFrame:
    """Weighted supplier score and cost competitiveness by pricing tier."""
    tier = F.col("pricing_tier")
    comp = F.lit(p.tier_default)
    for name, v in reversed(list(p.tier_scores.items())):
        comp = F.when(tier == name, F.lit(v)).otherwise(comp)
    delivery = F.greatest(F.lit(0.0), F.lit(1.0) - F.col("lead_time_days") / F.lit(p.lead_days_scale))
    score = (F.col("reliability_score") * p.w_reliability + F.lit(p.price_score * p.w_price)
             + delivery * p.w_lead + F.lit(p.quality_score * p.w_quality))
    return suppliers.select("supplier_id", "name", "reliability_score", "lead_time_days", "pricing_tier",
                            comp.alias("cost_competitiveness"), F.lit(0.85).alias("delivery_performance"),
                            score.alias("overall_score"))


def supplier_ranking(scored_suppliers: DataFrame) -> DataFrame:
    """Rank 1..n by score (desc), ties by supplier id; no single-partition window."""
    return global_row_number(scored_suppliers, [("overall_score", True), ("supplier_id", False)], "rank")


def top_suppliers(scored_suppliers: DataFrame, k: int = 5) -> DataFrame:
    """The k best suppliers."""
    return scored_suppliers.orderBy(F.col("overall_score").desc(), "supplier_id").limit(k)


def supplier_insights(scored_suppliers: DataFrame, p: CycleParams = CycleParams()) -> DataFrame:
    """Mean score, top supplier and its score, how many need improvement (< 0.7)."""
    best = F.max_by(F.struct("name", "overall_score"), F.struct("overall_score", -F.col("supplier_id")))
    return scored_suppliers.agg(
        F.avg("overall_score").alias("average_supplier_score"),
        best.getField("name").alias("top_performing_supplier"),
        best.getField("overall_score").alias("top_supplier_score"),
        F.count_if(F.col("overall_score") < p.min_supplier_reliability).alias("suppliers_needing_improvement"))


def supplier_policy(scored_suppliers: DataFrame, p: CycleParams = CycleParams()) -> DataFrame:
    """C33 (declared): suppliers allowed by the minimum reliability, ranked within the allowed set."""
    allowed = scored_suppliers.filter(F.col("reliability_score") >= p.min_supplier_reliability)
    return supplier_ranking(allowed)


def _pairs(products: DataFrame, pairs: DataFrame | None) -> DataFrame:
    """The (product_id, supplier_id) table, or the pairs that a column ``supplier_ids`` of the products lists."""
    return products.select("product_id", F.explode("supplier_ids").alias("supplier_id")) if pairs is None else pairs


def best_supplier(products: DataFrame, ranked_suppliers: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """For each product, its best-ranked supplier among those that deliver it.

    A rank names one supplier, so the best one is a minimum of numbers, partial before its shuffle."""
    ranks = _pairs(products, pairs).join(ranked_suppliers.select("supplier_id", "rank"), "supplier_id")
    best = ranks.groupBy("product_id").agg(F.min("rank").alias("rank"))
    return best.join(ranked_suppliers, "rank").select(
        "product_id", "supplier_id", F.col("name").alias("supplier_name"), F.col("overall_score").alias("supplier_score"))


def supplier_recommend(products: DataFrame, ranked_suppliers: DataFrame, n: int = 3, pairs: DataFrame | None = None) -> DataFrame:
    """The n best suppliers of each product (rank of C3 among those that deliver it)."""
    from pyspark.sql import Window
    j = _pairs(products, pairs).join(ranked_suppliers.select("supplier_id", "name", "rank", "overall_score"), "supplier_id")
    # the first n of each task go to the shuffle, not all suppliers of a product
    w = Window.partitionBy("product_id").orderBy("rank")
    return (j.withColumn("position", F.row_number().over(w)).filter(F.col("position") <= n)
            .select("product_id", "position", "supplier_id", "name", "overall_score"))


def supplier_performance(lines: DataFrame) -> DataFrame:
    """Per supplier, order lines, distinct orders, on-time rate and mean shipment days."""
    return lines.groupBy("supplier_id").agg(
        F.count(F.lit(1)).alias("order_lines"), F.count_distinct("order_id").alias("orders"),
        F.avg("on_time").alias("on_time_rate"), F.avg("actual_days").alias("avg_lead_time_days"),
        F.avg("delay").alias("avg_delay_days"))


def quote_comparison(quotes: DataFrame) -> DataFrame:
    """Per product the cheapest quote (ties by supplier id) and the spread to the dearest."""
    cheapest = F.min_by(F.struct("supplier_id", "quote_price"), F.struct("quote_price", "supplier_id"))
    return quotes.groupBy("product_id").agg(
        cheapest.getField("supplier_id").alias("best_supplier_id"),
        F.min("quote_price").alias("best_price"), F.max("quote_price").alias("highest_price"),
        F.count(F.lit(1)).alias("quotes")).withColumn("spread", F.col("highest_price") - F.col("best_price"))


# ---------------------------------------------------------------- scores

def priority_level(score) -> F.Column:
    s = F.col(score) if isinstance(score, str) else score
    return (F.when(s > 80, "Critical").when(s > 60, "High").when(s > 40, "Medium").when(s > 20, "Low")
            .otherwise("Minimal"))


def risk_band(score) -> F.Column:
    """Stockout risk band."""
    s = F.col(score) if isinstance(score, str) else score
    return (F.when(s > 0.7, "High Risk").when(s > 0.4, "Medium Risk").when(s > 0.2, "Low Risk")
            .otherwise("Very Low Risk"))


def priority_ranking(scored: DataFrame) -> DataFrame:
    """Priority rank 1..n (ties by product id) and level."""
    r = global_row_number(scored.select("product_id", "priority_pred"),
                          [("priority_pred", True), ("product_id", False)], "rank")
    return r.withColumn("priority_level", priority_level("priority_pred"))


def urgent_items(scored: DataFrame, k: int | None = 10) -> DataFrame:
    """T5: Critical/High items, the first k by priority; all of them (in no order) if k is None."""
    urgent = (scored.filter(F.col("priority_pred") > 60).select("product_id", "priority_pred")
              .withColumn("priority_level", priority_level("priority_pred")))
    return urgent if k is None else urgent.orderBy(F.col("priority_pred").desc(), "product_id").limit(k)


def high_risk_scored(scored: DataFrame, p: CycleParams = CycleParams()) -> DataFrame:
    """Products with predicted risk > 0.7, highest first."""
    return (scored.filter(F.col("risk_pred") > p.stockout_risk_high).select("product_id", "risk_pred")
            .orderBy(F.col("risk_pred").desc(), "product_id"))


def procurement_schedule(scored: DataFrame) -> DataFrame:
    """Schedule bucket per product and bucket sizes."""
    lvl = priority_level("priority_pred")
    bucket = (F.when(lvl == "Critical", "immediate").when(lvl == "High", "this_week")
              .when(lvl == "Medium", "next_week").otherwise("this_month"))
    return scored.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("products"))


def risk_recommendations(scored: DataFrame) -> DataFrame:
    """Band counts and the recommendation rows they trigger."""
    r = F.col("risk_pred")
    c = scored.agg(F.count_if(r > 0.7).alias("high"), F.count_if((r > 0.4) & (r <= 0.7)).alias("medium"))
    rows = F.array(
        F.struct(F.lit("Critical").alias("priority"),
                 F.format_string("Immediate reordering required for %d high-risk products", "high").alias("action"),
                 F.lit("Within 24 hours").alias("timeline"), (F.col("high") > 0).alias("keep")),
        F.struct(F.lit("Medium").alias("priority"),
                 F.format_string("Schedule reordering for %d medium-risk products", "medium").alias("action"),
                 F.lit("Within 1 week").alias("timeline"), (F.col("medium") > 0).alias("keep")),
        F.struct(F.lit("Low").alias("priority"), F.lit("Monitor inventory levels and update forecasts").alias("action"),
                 F.lit("Ongoing").alias("timeline"), F.lit(True).alias("keep")))
    return (c.select(F.inline(rows)).filter("keep").drop("keep"))


def delivery_insights(scored_delivery: DataFrame, col: str = "reliability_pred") -> DataFrame:
    """Mean predicted delivery performance, counts per band and the text band."""
    x = F.col(col)
    out = scored_delivery.agg(F.avg(x).alias("average_performance"),
                              F.count_if(x > 0.9).alias("excellent"),
                              F.count_if((x >= 0.7) & (x <= 0.9)).alias("good"),
                              F.count_if((x >= 0.5) & (x < 0.7)).alias("average"),
                              F.count_if(x < 0.5).alias("poor"))
    a = F.col("average_performance")
    return out.withColumn("band", F.when(a > 0.85, "excellent").when(a > 0.70, "good")
                          .when(a > 0.50, "average").otherwise("poor"))


def portfolio_risk(scored: DataFrame) -> DataFrame:
    """Overall risk level from the mean predicted risk, and counts."""
    return (scored.agg(F.avg("risk_pred").alias("average_stockout_risk"),
                       F.count_if(F.col("risk_pred") > 0.7).alias("high_risk_products"))
            .withColumn("overall_risk_level", F.when(F.col("average_stockout_risk") > 0.7, "High")
                        .when(F.col("average_stockout_risk") > 0.4, "Medium").otherwise("Low")))


def critical_items(scored: DataFrame, k: int | None = None) -> DataFrame:
    """High demand (> 1.5 x mean prediction) AND high risk AND urgent
    (``k``: only among the first k urgent items, as a list of ten would have it)."""
    mean_demand = scored.select(F.avg("demand_pred")).scalar()
    high_demand = scored.filter(F.col("demand_pred") > mean_demand * 1.5).select("product_id")
    high_risk = high_risk_scored(scored).select("product_id")
    urgent = urgent_items(scored, k).select("product_id")
    return (high_demand.join(high_risk, "product_id", "left_semi")
            .join(urgent, "product_id", "left_semi")
            .withColumn("action", F.lit("Immediate procurement required")))


def action_plan(scored: DataFrame, k: int | None = None) -> DataFrame:
    """Five highest-risk products for emergency procurement, and the urgent count."""
    top5 = high_risk_scored(scored).limit(5)
    n_urgent = urgent_items(scored, k).select(F.count(F.lit(1))).scalar()
    return top5.withColumn("urgent_count", n_urgent).withColumn(
        "action", F.lit("Emergency procurement for high-risk products"))


# ---------------------------------------------------------------- decisions and orders

# The reasons an order gives.
_IMMEDIATE, _RISK, _PRIORITY = "Immediate action required", "High stockout risk predicted", "High procurement priority"
_BELOW, _STANDARD = "Below minimum stock level (", "Standard reorder"


def _decide(items: DataFrame, products: DataFrame, ranked_suppliers: DataFrame, urgency: str, p: CycleParams,
            pairs: DataFrame | None) -> DataFrame:
    """A decision for each item (product_id, ai_score, source): quantity, best supplier (or the default) and reasons.

    Immediate orders fill up to the maximum stock, scheduled ones to twice the minimum."""
    prod = products.select("product_id", "name", "current_stock", "min_stock_level", "max_stock_level", "unit_cost")
    d = items.join(prod, "product_id").join(best_supplier(products, ranked_suppliers, pairs), "product_id", "left")
    level = F.col("max_stock_level") if urgency == "immediate" else F.col("min_stock_level") * 2
    qty = F.greatest(F.lit(0), level - F.col("current_stock")).cast("long")
    price = F.col("unit_cost").cast(MONEY)
    reasons = F.concat_ws("; ",
                          F.lit(_IMMEDIATE if urgency == "immediate" else None),
                          F.when(F.col("current_stock") < F.col("min_stock_level"),
                                 F.concat(F.lit(_BELOW), F.col("min_stock_level").cast("string"), F.lit(")"))),
                          F.when((F.col("source") == "risk") & (F.col("ai_score") > 0.7), F.lit(_RISK)),
                          F.when((F.col("source") == "priority") & (F.col("ai_score") > 70), F.lit(_PRIORITY)))
    return d.select(
        "product_id", F.col("name").alias("product_name"),
        F.coalesce(F.col("supplier_id").cast("string"), F.lit(p.default_supplier)).alias("supplier_id"),
        F.coalesce(F.col("supplier_name"), F.lit("Default Supplier")).alias("supplier_name"),
        qty.alias("order_quantity"), price.alias("unit_price"), (qty * price).cast(MONEY).alias("total_amount"),
        F.lit(urgency).alias("urgency"), "ai_score", "source",
        F.when(reasons == "", _STANDARD).otherwise(reasons).alias("justification"))


def procurement_decisions(products: DataFrame, scored: DataFrame, ranked_suppliers: DataFrame,
                          p: CycleParams = CycleParams(), k: int | None = None, pairs: DataFrame | None = None) -> DataFrame:
    """Urgent items, then high-risk items not already urgent; quantity up to maximum
    stock, best supplier (or the default), justification text.  ``k`` limits the urgent items to the
    first k; by default every Critical/High item is decided.

    Deviation (J9): the reference maps a prediction row to a product by its
    position (off by one); here the product key is joined."""
    urgent = urgent_items(scored, k).select("product_id", F.col("priority_pred").alias("ai_score"),
                                           F.lit("priority").alias("source"))
    risky = (high_risk_scored(scored, p).join(urgent.select("product_id"), "product_id", "left_anti")
             .select("product_id", F.col("risk_pred").alias("ai_score"), F.lit("risk").alias("source")))
    return _decide(urgent.unionByName(risky), products, ranked_suppliers, "immediate", p, pairs)


def scheduled_decisions(products: DataFrame, scored: DataFrame, ranked_suppliers: DataFrame, immediate: DataFrame,
                        p: CycleParams = CycleParams(), pairs: DataFrame | None = None) -> DataFrame:
    """The items of next week's schedule bucket (S9) that are not ordered at once, up to twice their minimum stock.

    An item whose stock is there already is not ordered."""
    items = (scored.where(priority_level("priority_pred") == "Medium")
             .select("product_id", F.col("priority_pred").alias("ai_score"), F.lit("priority").alias("source"))
             .join(immediate.select("product_id"), "product_id", "left_anti"))
    return _decide(items, products, ranked_suppliers, "scheduled", p, pairs).where("order_quantity > 0")


def procurement_orders(decisions: DataFrame, cycle_time: datetime = DEFAULT_CYCLE_TIME,
                       p: CycleParams = CycleParams()) -> DataFrame:
    """Orders from the decisions (id from cycle time + product), pending, delivery + 7 days."""
    return decisions.select(
        F.concat(F.lit(f"PO_{_stamp(cycle_time)}_"), F.col("product_id").cast("string")).alias("order_id"),
        "product_id", "supplier_id", F.col("order_quantity").alias("quantity"), "unit_price", "total_amount",
        F.when(F.col("urgency") == "immediate", "critical").otherwise("high").alias("priority"),
        F.lit("pending").alias("status"), _ts(cycle_time).alias("created_at"),
        _ts(cycle_time + timedelta(days=p.delivery_days)).alias("expected_delivery"),
        F.lit(None).cast(MONEY).alias("negotiated_price"))


def savings_potential(immediate: DataFrame, scheduled: DataFrame | None = None,
                      p: CycleParams = CycleParams()) -> DataFrame:
    """5% of the value of all immediate and scheduled orders."""
    both = immediate.select("total_amount")
    if scheduled is not None:
        both = both.unionByName(scheduled.select("total_amount"))
    return both.agg(F.count(F.lit(1)).alias("orders"),
                    F.coalesce(F.sum("total_amount"), F.lit(0)).alias("_t")).select(
        "orders", F.col("_t").cast("double").alias("total_value"),
        (F.col("_t") * F.lit(p.savings_share).cast("decimal(4,2)")).cast("double").alias("savings_potential"))


def negotiation_candidates(orders: DataFrame, p: CycleParams = CycleParams()) -> DataFrame:
    """Orders above the auto-approve threshold: target price 95%, expected savings 5%."""
    return orders.filter(F.col("total_amount") > p.negotiation_min_total).select(
        "order_id", "product_id", "supplier_id", "quantity",
        F.col("unit_price").alias("original_price"),
        (F.col("unit_price") * F.lit(p.negotiation_target).cast("decimal(4,2)")).cast(MONEY).alias("target_price"),
        (F.col("total_amount") * F.lit(1 - p.negotiation_target).cast("decimal(4,2)")).cast(MONEY)
        .alias("expected_savings"),
        F.lit(1).alias("negotiation_round"), F.lit("active").alias("status"), F.lit("volume_discount").alias("strategy"))


def apply_negotiations(candidates: DataFrame, offers: DataFrame, cycle_time: datetime = DEFAULT_CYCLE_TIME,
                       p: CycleParams = CycleParams()) -> DataFrame:
    """C13, C14, IO10: accept supplier offers below the original price; the price never goes
    below the target; savings amount and share; valid for 30 days."""
    j = candidates.join(offers.select("order_id", "offer_price"), "order_id")
    final = F.greatest(F.col("offer_price").cast(MONEY), F.col("target_price"))
    return (j.filter(F.col("offer_price") < F.col("original_price"))
            .select(F.concat(F.lit(f"NEG_{_stamp(cycle_time)}_"), F.col("order_id")).alias("negotiation_id"),
                    "order_id", "product_id", "supplier_id", "original_price",
                    final.alias("negotiated_price"),
                    (F.col("original_price") - final).cast(MONEY).alias("savings_amount"),
                    ((F.col("original_price") - final).cast("double") / F.col("original_price").cast("double"))
                    .alias("savings_percentage"),
                    (F.col("quantity") * final).cast(MONEY).alias("new_total_amount"),
                    F.lit("automated_api").alias("negotiation_method"),
                    _ts(cycle_time).alias("created_at"),
                    _ts(cycle_time + timedelta(days=p.negotiation_valid_days)).alias("valid_until")))


def alerts(products: DataFrame, decisions: DataFrame, cycle_time: datetime = DEFAULT_CYCLE_TIME,
           p: CycleParams = CycleParams()) -> DataFrame:
    """C15, C16, IO9: low-stock alerts (high if ratio < 0.1) and high-value order alerts (> 5000)."""
    stamp = _stamp(cycle_time)
    low = low_stock(products, p).select(
        F.concat(F.lit(f"ALERT_{stamp}_low_stock_"), F.col("product_id").cast("string")).alias("alert_id"),
        F.lit("low_stock").alias("alert_type"),
        F.when(F.col("stock_ratio") < p.high_severity_ratio, "high").otherwise("medium").alias("severity"),
        "product_id",
        F.concat(F.lit("Low stock alert for "), F.col("name"), F.lit(": "), F.col("current_stock").cast("string"),
                 F.lit(" units remaining")).alias("message"))
    high = decisions.filter(F.col("total_amount") > p.high_value_amount).select(
        F.concat(F.lit(f"ALERT_{stamp}_high_value_order_"), F.col("product_id").cast("string")).alias("alert_id"),
        F.lit("high_value_order").alias("alert_type"), F.lit("high").alias("severity"), "product_id",
        F.concat(F.lit("High value order requires approval: $"),
                 F.round(F.col("total_amount"), 2).cast("decimal(18,2)").cast("string")).alias("message"))
    return (low.unionByName(high).withColumn("created_at", _ts(cycle_time))
            .withColumn("action_required", F.lit(True)))


def cycle_summary(orders: DataFrame, alert_rows: DataFrame, negotiations: DataFrame,
                  p: CycleParams = CycleParams()) -> DataFrame:
    """C17: orders, order value, alerts, negotiations, estimated savings and the advice."""
    o = orders.agg(F.count(F.lit(1)).alias("total_orders_created"),
                   F.coalesce(F.sum("total_amount"), F.lit(0)).alias("_v"))
    n_alerts = alert_rows.select(F.count(F.lit(1))).scalar()
    n_neg = negotiations.select(F.count(F.lit(1))).scalar()
    return o.select(
        "total_orders_created", F.col("_v").cast("double").alias("total_order_value"),
        n_alerts.alias("alerts_generated"), n_neg.alias("negotiations_initiated"),
        (F.col("_v") * F.lit(p.savings_share).cast("decimal(4,2)")).cast("double").alias("estimated_savings"),
        F.lit(0.85).alias("automation_rate")).withColumn(
        "next_cycle_recommendation",
        F.when(F.col("alerts_generated") > p.alert_advice_above, "Increase monitoring frequency due to high alert volume")
         .when(F.col("total_orders_created") > p.order_advice_above, "Review supplier capacity and lead times")
         .otherwise("Continue normal procurement cycle"))


def order_approval(orders: DataFrame, p: CycleParams = CycleParams()) -> DataFrame:
    """C20: auto-approve orders under 1000, the rest need a manual approval."""
    return orders.select("order_id", "product_id", "total_amount",
                         F.when(F.col("total_amount") < p.auto_approve_below, "auto_approved")
                         .otherwise("manual_approval_required").alias("approval"))


def apply_status_decisions(table: DataFrame, decisions: DataFrame, key: str, status_col: str = "status") -> DataFrame:
    """Left join of decisions on the key; the new status wins where one is given."""
    d = decisions.select(key, F.col("new_status"))
    return (table.join(d, key, "left")
            .withColumn(status_col, F.coalesce(F.col("new_status"), F.col(status_col))).drop("new_status"))


def order_flags(orders: DataFrame, products: DataFrame, p: CycleParams = CycleParams()) -> DataFrame:
    """C34 (declared): negotiation eligible (>= 500), bulk (>= 10000), emergency (stock/min <= 5%)."""
    pr = products.select("product_id", ratio("current_stock", "min_stock_level").alias("stock_ratio"))
    return orders.join(pr, "product_id", "left").select(
        "order_id", "product_id", "total_amount",
        (F.col("total_amount") >= p.min_negotiation_value).alias("negotiation_eligible"),
        (F.col("total_amount") >= p.bulk_order_threshold).alias("bulk_order"),
        (F.col("stock_ratio") <= p.emergency_share).alias("emergency"))


def trend_alerts(monthly: DataFrame, supplier_monthly: DataFrame, lines: DataFrame,
                 p: CycleParams = CycleParams()) -> DataFrame:
    """C35 (declared): demand up > 30% month over month, supplier on-time rate down > 0.1,
    order lines delayed > 2 days (counted per product)."""
    from pyspark.sql import Window
    wp = Window.partitionBy("product_id").orderBy("year_month")
    demand = (monthly.withColumn("_prev", F.lag("qty").over(wp))
              .filter(ratio(F.col("qty") - F.col("_prev"), F.col("_prev")) > p.demand_increase_alert)
              .select(F.lit("high_demand_increase").alias("alert_type"), F.col("product_id").alias("entity_id"),
                      "year_month"))
    ws = Window.partitionBy("supplier_id").orderBy("year_month")
    decline = (supplier_monthly.withColumn("_prev", F.lag("on_time_rate").over(ws))
               .filter(F.col("_prev") - F.col("on_time_rate") > p.supplier_decline_alert)
               .select(F.lit("supplier_performance_decline").alias("alert_type"),
                       F.col("supplier_id").alias("entity_id"), "year_month"))
    delays = (lines.filter(F.col("delay") > p.delay_alert_days)
              .groupBy("product_id", (F.year("order_date") * 100 + F.month("order_date")).cast("int").alias("year_month"))
              .agg(F.count(F.lit(1)).alias("_n"))
              .select(F.lit("delivery_delay").alias("alert_type"), F.col("product_id").alias("entity_id"), "year_month"))
    return demand.unionByName(decline).unionByName(delays)


def dashboard_kpis(lines: DataFrame, days: int = 30) -> DataFrame:
    """KPIs of the last N days before the latest order date."""
    last = lines.select(F.max("order_date")).scalar()
    recent = lines.filter(F.col("order_date") > F.date_sub(last, days))
    return recent.agg(F.count_distinct("order_id").alias("orders"), F.count(F.lit(1)).alias("order_lines"),
                      F.coalesce(F.sum("sales"), F.lit(0)).cast("double").alias("order_value"),
                      F.avg("on_time").alias("on_time_rate"),
                      F.count_distinct("product_id").alias("products")).withColumn("window_days", F.lit(days))


def savings_report(negotiations: DataFrame, products: DataFrame) -> DataFrame:
    """Negotiated savings grouped by product category."""
    return (negotiations.join(products.select("product_id", "category"), "product_id")
            .groupBy("category").agg(F.count(F.lit(1)).alias("negotiations"),
                                     F.sum(F.col("savings_amount")).cast("double").alias("total_savings"),
                                     F.avg("savings_percentage").alias("avg_savings_percentage")))


def page(df: DataFrame, order_cols, limit: int, offset: int = 0, **filters) -> DataFrame:
    """Filter on equality, order (with a key tie-break), offset, limit."""
    for c, v in filters.items():
        if v is not None:
            df = df.filter(F.col(c) == v)
    df = df.orderBy(*order_cols)
    if offset:
        df = df.offset(offset)
    return df.limit(limit)
