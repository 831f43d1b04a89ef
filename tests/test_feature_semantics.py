"""Hand-made frames for edge cases the generated tables never reach (FIXTURES section 4)."""

from __future__ import annotations

import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from provisio.functions.ranking import global_dense_rank, global_row_number
from provisio.functions.quantiles import grouped_quantiles
from provisio.operators import features as fe
from provisio.operators import ingest
from provisio.operators import policy as po

RAW_SCHEMA = ("order_id long, product_id long, supplier_id long, department string, order_year int, "
              "order_month int, order_day int, shipment_year int, shipment_month int, shipment_day int, "
              "scheduled_days int, qty double, sales decimal(12,2), profit decimal(18,4), discount_text string")


def raw(spark, rows):
    full = []
    for r in rows:
        d = dict(order_id=1, product_id=1, supplier_id=1, department="D", order_year=2020, order_month=1,
                 order_day=1, shipment_year=2020, shipment_month=1, shipment_day=3, scheduled_days=2, qty=1.0,
                 sales=Decimal("10.00"), profit=Decimal("1.0000"), discount_text="0.1")
        d.update(r)
        full.append(tuple(d[c.split()[0]] for c in RAW_SCHEMA.split(", ")))
    return spark.createDataFrame(full, RAW_SCHEMA)


def lines(spark, rows):
    return fe.order_lines(ingest.standardize_orders(raw(spark, rows)))


def inv(spark, rows):
    return ingest.standardize_inventory(
        spark.createDataFrame(rows, "product_id long, year_month int, inventory double, unit_cost double"))


def test_single_order_std_null_to_zero_and_slope_zero(spark):
    ln = lines(spark, [dict(qty=5.0)])
    d = fe.demand_features(ln).collect()[0]
    assert d.qty_std is None and d.demand_variability == 0.0
    assert d.demand_trend_slope == 0.0 and d.demand_growth_mean is None
    f = fe.procurement_features(ln, inv(spark, [(1, 202001, 3.0, 2.0)]),
                                spark.createDataFrame([(1, 6.0)], "product_id long, fulfillment_days double"))
    r = f.collect()[0]
    assert r.qty_std == 0.0 and r.demand_growth_mean == 0.0


def test_bad_dates_and_discount_become_null(spark):
    o = ingest.standardize_orders(raw(spark, [dict(order_month=2, order_day=30, discount_text="  - ")]))
    r = ingest.date_rejects(o).collect()[0]
    assert (r.bad_order_dates, r.bad_shipment_dates, r.bad_discounts) == (1, 0, 1)


def test_delay_edges(spark):
    rows = [dict(order_id=i, shipment_day=1 + a, scheduled_days=2) for i, a in enumerate([0, 1, 2, 3, 4])]
    got = sorted((r.delay, r.on_time, r.early, r.late)
                 for r in lines(spark, rows).select("delay", "on_time", "early", "late").collect())
    assert got == [(-2, 1, 1, 0), (-1, 1, 0, 0), (0, 1, 0, 0), (1, 0, 0, 0), (2, 0, 0, 1)]


def test_gap_months_growth_against_last_present_month(spark):
    rows = [dict(order_id=1, order_month=1, qty=10.0), dict(order_id=2, order_month=2, qty=20.0),
            dict(order_id=3, order_month=5, qty=10.0)]
    g = fe.monthly_growth(fe.monthly_demand(lines(spark, rows))).orderBy("year_month").collect()
    assert [r.growth for r in g] == [None, 1.0, -0.5]
    t = fe.demand_trend(fe.monthly_demand(lines(spark, rows))).collect()[0]
    assert t.demand_growth_mean == 0.25


def test_zero_demand_growth_inf(spark):
    rows = [dict(order_id=1, order_month=1, qty=0.0), dict(order_id=2, order_month=2, qty=5.0),
            dict(order_id=3, order_month=3, qty=0.0)]
    g = fe.monthly_growth(fe.monthly_demand(lines(spark, rows))).orderBy("year_month").collect()
    assert g[1].growth == math.inf and g[2].growth == -1.0


def test_quarter_mode_smallest_on_tie(spark):
    rows = [dict(order_id=1, order_month=1), dict(order_id=2, order_month=4), dict(order_id=3, order_month=5),
            dict(order_id=4, order_month=2)]
    assert fe.demand_aggregate(lines(spark, rows)).collect()[0].quarter_mode == 1


def test_rounding_half_even_mean(spark):
    # mean 0.03125 -> 0.0312 (half-even), not 0.0313
    rows = [dict(order_id=i, qty=(1.0 if i == 0 else 0.0)) for i in range(32)]
    assert fe.demand_aggregate(lines(spark, rows)).collect()[0].qty_mean == 0.0312


def _policy_frame(spark, rows):
    cols = ["product_id", "qty_sum", "qty_mean", "qty_std", "sales_sum", "fulfillment_days", "current_inventory",
            "current_unit_cost", "stockout_frequency", "demand_growth_mean", "delivery_reliability"]
    return spark.createDataFrame([tuple(float(x) if i else int(x) for i, x in enumerate(r)) for r in rows],
                                 ", ".join(f"{c} {'long' if c == 'product_id' else 'double'}" for c in cols))


def test_zero_cost_eoq_and_status_edges(spark):
    df = _policy_frame(spark, [
        (1, 30, 30, 0, 100, 30, 0, 0, 0, 0, 1),     # cost 0, demand > 0 -> EOQ inf; stock 0 -> Stockout
        (2, 0, 0, 0, 90, 30, 5, 0, 0, 0, 1),        # 0/0 -> EOQ 0; ROP 0 and stock 5 > 0 -> Overstock
        (3, 30, 30, 0, 80, 30, 30, 1, 0, 0, 1),     # ROP 30, stock = ROP -> Reorder_Required
        (4, 30, 30, 0, 80, 30, 60, 1, 0, 0, 1),     # stock = 2 ROP -> Normal
        (5, 30, 30, 0, 70, 30, 61, 1, 0, -0.5, 1),  # > 2 ROP -> Overstock
        (6, 30, 30, 0, 60, 30, 45, 1, 0, -0.5, 1),  # Normal, falling -> Decrease_Stock
    ])
    out = {r.product_id: r for r in po.procurement_policy(df).collect()}
    assert out[1].eoq == math.inf and out[1].stock_status == "Stockout"
    assert out[2].eoq == 0.0 and out[2].stock_status == "Overstock"
    assert out[3].stock_status == "Reorder_Required" and out[4].stock_status == "Normal"
    assert out[5].stock_status == "Overstock" and out[6].recommended_action == "Decrease_Stock"
    assert out[2].days_supply == math.inf


def test_rank_ties_dense_and_classes(spark):
    df = _policy_frame(spark, [(i, 1, 1, 0, s, 1, 1, 1, 0, 0, 1)
                               for i, s in enumerate([100, 100, 90, 80, 80, 70, 60, 50, 40, 30], start=1)])
    out = {r.product_id: r for r in po.procurement_policy(df).collect()}
    assert [out[i].revenue_rank for i in range(1, 11)] == [1, 1, 2, 3, 3, 4, 5, 6, 7, 8]
    assert [out[i].abc_category for i in range(1, 11)] == ["A", "A", "A", "B", "B", "B", "B", "C", "C", "C"]


def test_global_row_number_is_a_permutation(spark):
    df = spark.range(0, 5000).select((F.col("id") % 97).alias("v"), F.col("id"))
    r = global_row_number(df, [("v", True), ("id", False)], "rn")
    rows = r.orderBy("rn").collect()
    assert [x.rn for x in rows] == list(range(1, 5001))
    assert all((a.v, -a.id) >= (b.v, -b.id) for a, b in zip(rows, rows[1:]))


def test_dense_rank_matches_window(spark):
    df = spark.range(0, 3000).select((F.col("id") % 113).cast("double").alias("v"))
    r = global_dense_rank(df, "v", "dr")
    assert r.filter(F.col("dr") != (F.lit(113) - F.col("v")).cast("long")).count() == 0


@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.75, 1.0])
def test_grouped_quantiles_match_linear_interpolation(spark, q):
    import numpy as np
    vals = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0, 6.0]
    df = spark.createDataFrame([("a", v) for v in vals] + [("b", 7.0)], "g string, x double")
    got = {r.g: r.x for r in grouped_quantiles(df, ["g"], "x", [q]).collect()}
    assert got["a"] == pytest.approx(float(np.quantile(vals, q)))
    assert got["b"] == 7.0
