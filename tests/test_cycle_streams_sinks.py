"""Procurement cycle rules, streaming (stream result == batch result, late and duplicate rows)
and primary-key sinks, on hand-made frames."""

from __future__ import annotations

import os
import tempfile
import uuid
from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from provisio.operators import cycle as cy
from provisio.session import checkpoint_dir
from provisio.sources import sinks
from provisio.streaming import streams as st

PRODUCTS = ("product_id long, name string, category string, min_stock_level int, max_stock_level int, "
            "unit_cost double, lead_time int, current_stock long, supplier_ids array<long>")
SUPPLIERS = "supplier_id long, name string, lead_time_days int, pricing_tier string, reliability_score double"


def _products(spark):
    return spark.createDataFrame([
        (1, "bolt", "A", 10, 50, 2.5, 3, 0, [10, 11]),      # stock-out, ratio 0 -> high alert
        (2, "nut", "A", 10, 50, 1.0, 3, 2, [11]),           # ratio 0.2 -> medium alert
        (3, "gear", "B", 10, 50, 400.0, 3, 30, [12]),       # healthy
    ], PRODUCTS)


def _suppliers(spark):
    return spark.createDataFrame([
        (10, "s10", 3, "Economy", 0.9), (11, "s11", 30, "Premium", 0.95), (12, "s12", 15, "Basic", 0.5),
    ], SUPPLIERS)


def test_supplier_score_and_best_supplier(spark):
    sc = cy.supplier_score(_suppliers(spark))
    got = {r.supplier_id: r for r in sc.collect()}
    assert got[10].cost_competitiveness == 0.9 and got[11].cost_competitiveness == 0.5
    assert got[12].cost_competitiveness == 0.6
    assert abs(got[10].overall_score - (0.9 * 0.4 + 0.3 + 0.9 * 0.2 + 0.085)) < 1e-12
    ranked = cy.supplier_ranking(sc)
    assert sorted(r["rank"] for r in ranked.collect()) == [1, 2, 3]
    best = {r.product_id: r.supplier_id for r in cy.best_supplier(_products(spark), ranked).collect()}
    assert best[1] == 10 and best[2] == 11 and best[3] == 12


def test_decisions_orders_alerts_negotiations(spark):
    products, ranked = _products(spark), cy.supplier_ranking(cy.supplier_score(_suppliers(spark)))
    scored = spark.createDataFrame([(1, 10.0, 0.9, 85.0), (2, 5.0, 0.75, 30.0), (3, 1.0, 0.1, 10.0)],
                                   "product_id long, demand_pred double, risk_pred double, priority_pred double")
    d = {r.product_id: r for r in cy.procurement_decisions(products, scored, ranked).collect()}
    assert set(d) == {1, 2}                                   # urgent (1), high risk not urgent (2)
    assert d[1].order_quantity == 50 and d[1].total_amount == Decimal("125.0000")
    assert d[1].justification == ("Immediate action required; Below minimum stock level (10); "
                                  "High procurement priority")
    assert d[2].justification == ("Immediate action required; Below minimum stock level (10); "
                                  "High stockout risk predicted")
    orders = cy.procurement_orders(cy.procurement_decisions(products, scored, ranked),
                                   datetime(2024, 1, 31, 8, 0, 0))
    o = {r.product_id: r for r in orders.collect()}
    assert o[1].order_id == "PO_20240131_080000_1" and o[1].status == "pending"
    assert o[1].expected_delivery == datetime(2024, 2, 7, 8, 0, 0)
    al = {(r.alert_type, r.product_id): r for r in cy.alerts(products, cy.procurement_decisions(
        products, scored, ranked)).collect()}
    assert al[("low_stock", 1)].severity == "high" and al[("low_stock", 2)].severity == "medium"
    assert al[("low_stock", 1)].message == "Low stock alert for bolt: 0 units remaining"
    big = spark.createDataFrame([("PO_x", 7, "10", 100, Decimal("20.0000"))],
                                "order_id string, product_id long, supplier_id string, quantity long, "
                                "unit_price decimal(18,4)").withColumn(
        "total_amount", (F.col("quantity") * F.col("unit_price")).cast("decimal(18,4)"))
    cand = cy.negotiation_candidates(big)
    offers = spark.createDataFrame([("PO_x", Decimal("18.0000"))], "order_id string, offer_price decimal(18,4)")
    n = cy.apply_negotiations(cand, offers).collect()[0]
    assert n.negotiated_price == Decimal("19.0000")         # never below the 95% target
    assert n.savings_amount == Decimal("1.0000") and abs(n.savings_percentage - 0.05) < 1e-12


def _write_events(spark, folder, rows):
    df = spark.createDataFrame(rows, st.EVENT_SCHEMA)
    df.coalesce(1).write.mode("append").parquet(folder)


def test_stream_latest_stock_late_and_duplicate(spark):
    folder = tempfile.mkdtemp(prefix="provisio-events-", dir=checkpoint_dir(spark))
    t = lambda h, m=0: datetime(2024, 1, 1, h, m)
    _write_events(spark, folder, [
        (1, t(1), 5, "view", 10.0, '{"k": 1}'),
        (2, t(3), 5, "view", 7.0, '{"k": 2}'),
        (2, t(3), 5, "view", 7.0, '{"k": 2}'),          # duplicate delivery
        (3, t(2), 5, "view", 99.0, '{"k": 3}'),         # older than the stock already seen
        (4, t(2), 6, "error", 1.0, '{"k": 4}'),         # invalid: no product
    ])
    upd = st.updates(spark.readStream.schema(st.EVENT_SCHEMA).parquet(folder))
    latest = {r.product_id: r.stock for r in st.run_to_table(st.latest_stock(upd), ["product_id"]).collect()}
    assert latest == {5: 7.0}
    upd = st.updates(spark.readStream.schema(st.EVENT_SCHEMA).parquet(folder))
    dedup = st.run_to_table(st.dedup_late(upd), ["event_id"], "append")
    assert sorted(r.event_id for r in dedup.collect()) == [1, 2, 3, 4]
    upd = st.updates(spark.readStream.schema(st.EVENT_SCHEMA).parquet(folder))
    rej = st.run_to_table(st.rejected(upd).select("event_id", "ts"), ["event_id"], "append")
    assert [r.event_id for r in rej.collect()] == [4]
    # stream result equals the batch result over the same rows
    upd = st.updates(spark.readStream.schema(st.EVENT_SCHEMA).parquet(folder))
    w = st.run_to_table(st.windowed_counts(upd, "6 hours"), ["window_start", "window_end"])
    batch = st.updates(spark.read.schema(st.EVENT_SCHEMA).parquet(folder)).filter(F.col("product_id").isNotNull())
    assert w.select(F.sum("updates")).first()[0] == batch.count()


def test_append_with_primary_key_is_idempotent(spark):
    path = os.path.join(checkpoint_dir(spark), "test-sinks", uuid.uuid4().hex)
    df = spark.createDataFrame([("a", 1), ("b", 2), ("b", 2)], "order_id string, v int")
    sinks.append_with_key(spark, df, path, "order_id")
    sinks.append_with_key(spark, df, path, "order_id")
    more = spark.createDataFrame([("b", 3), ("c", 4)], "order_id string, v int")
    sinks.append_with_key(spark, more, path, "order_id")
    got = sorted((r.order_id, r.v) for r in spark.read.parquet(path).collect())
    assert got == [("a", 1), ("b", 2), ("c", 4)]
