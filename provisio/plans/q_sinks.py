"""Queries: sinks and sources round trips (IO3-IO10, IO15-IO16)."""

from __future__ import annotations

import os
import uuid
from datetime import timedelta

from pyspark.sql import functions as F

from provisio.operators import features as fe
from provisio.operators import ingest
from provisio.operators import policy as po
from provisio.operators.cycle import DEFAULT_CYCLE_TIME
from provisio.plans.catalog import query
from provisio.plans.q_cycle import ORDER_COLS, _orders_df, _wc
from provisio.plans.q_features import POLICY_ALL, ts
from provisio.plans.oracle_base import with_ctes
from provisio.session import checkpoint_dir
from provisio.sources import sinks


def _path(i, name):
    return os.path.join(checkpoint_dir(i.spark), "sinks", f"{name}-{uuid.uuid4().hex}")


@query("sink_roundtrip", with_ctes(f"SELECT {', '.join(POLICY_ALL)} FROM policy"))
def sink_roundtrip(i):
    """IO5, IO6: the product table written as parquet (overwrite) and read back."""
    p = _path(i, "procurement_features")
    sinks.write_table(i.policy_table.select(*POLICY_ALL), p)
    return sinks.read_table(i.spark, p)


@query("scan_ingested", with_ctes(
    "SELECT order_id, product_id, CAST(order_date AS TIMESTAMP) AS order_date, "
    "CAST(shipment_date AS TIMESTAMP) AS shipment_date, qty FROM v_orders"))
def scan_ingested(i):
    """IO3: ingested orders written, re-loaded with the required-column check, dates typed."""
    p = _path(i, "orders_ingested")
    sinks.write_table(i.orders, p)
    back = ingest.require_columns(sinks.read_table(i.spark, p), ["order_date", "shipment_date"], "orders_ingested")
    return back.select("order_id", "product_id", ts("order_date"), ts("shipment_date"), "qty")


def load_or_derive(i, path):
    """The feature table of ``path``; when it is missing, derived from the inputs and stored there."""
    if not sinks.path_exists(i.spark, path):
        sinks.write_table(i.features, path)
    return sinks.read_table(i.spark, path)


@query("sink_ingested", _wc(
    "SELECT 'orders' AS dataset, count(*) AS rows, CAST(sum(qty) AS DOUBLE) AS total FROM v_orders "
    "UNION ALL SELECT 'inventory', count(*), CAST(sum(inventory) AS DOUBLE) FROM inv_month "
    "UNION ALL SELECT 'fulfillment', count(*), CAST(sum(fulfillment_days) AS DOUBLE) FROM fulfil"))
def sink_ingested(i):
    """IO5: the three ingested tables written as CSV files and read back with their schemas; rows and a checksum of each."""
    out = None
    for name, df, c in (("orders", i.orders, "qty"), ("inventory", i.inventory, "inventory"), ("fulfillment", i.fulfillment, "fulfillment_days")):
        p = _path(i, name)
        sinks.write_table(df, p, "csv")
        back = sinks.read_table(i.spark, p, "csv", schema=df.schema)
        r = back.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col(c).cast("double")).alias("total")).select(F.lit(name).alias("dataset"), "rows", "total")
        out = r if out is None else out.unionByName(r)
    return out


@query("load_features", with_ctes(f"SELECT {', '.join(fe.FEATURE_COLUMNS)} FROM features"))
def load_features(i):
    """IO4: the first call finds no table, derives it from the inputs and stores it; the second loads it."""
    p = _path(i, "features")
    load_or_derive(i, p)
    return load_or_derive(i, p)


def _append_twice(i, df, key, name):
    p = _path(i, name)
    day = F.regexp_extract(key, r"_(\d{8})_", 1)     # every key names its cycle
    sinks.append_with_key(i.spark, df, p, key, day)
    sinks.append_with_key(i.spark, df, p, key, day)   # a re-run must not duplicate rows
    return i.spark.read.parquet(p).drop("_part")


@query("orders_append", _wc(f"SELECT {ORDER_COLS} FROM porders"))
def orders_append(i):
    """IO8: orders appended twice under a primary key: each order stored once."""
    return _append_twice(i, _orders_df(i), "order_id", "procurement_orders")


@query("alerts_append", _wc("SELECT alert_id, alert_type, severity, product_id, message FROM alerts"))
def alerts_append(i):
    """IO9."""
    a = i.alerts.select("alert_id", "alert_type", "severity", "product_id", "message")
    return _append_twice(i, a, "alert_id", "inventory_alerts")


@query("negotiations_append", _wc(
    "SELECT negotiation_id, product_id, supplier_id, CAST(original_price AS DOUBLE) AS original_price, "
    "CAST(negotiated_price AS DOUBLE) AS negotiated_price, CAST(savings_amount AS DOUBLE) AS savings_amount, "
    "savings_percentage, 'automated_api' AS negotiation_method, TIMESTAMP '2024-01-31 08:00:00' AS created_at, "
    "TIMESTAMP '2024-03-01 08:00:00' AS valid_until FROM negs"))
def negotiations_append(i):
    """IO10: negotiation results appended; valid for 30 days."""
    n = i.negotiations.select("negotiation_id", "product_id", "supplier_id",
                              *[F.col(c).cast("double").alias(c) for c in ("original_price", "negotiated_price",
                                                                            "savings_amount")],
                              "savings_percentage", "negotiation_method", "created_at", "valid_until")
    return _append_twice(i, n, "negotiation_id", "price_negotiations")


@query("sink_formats", _wc(
    "SELECT supplier_id, name, pricing_tier, overall_score FROM sscore"))
def sink_formats(i):
    """IO15 (declared): the same table as gzip CSV and gzip JSON; both copies are read back and a row is
    returned as often as both have it; a copy that lacks a row or has another is an error."""
    df = i.scored_suppliers.select("supplier_id", "name", "pricing_tier", "overall_score")
    pc, pj = _path(i, "csv"), _path(i, "json")
    sinks.write_table(df, pc, "csv", compression="gzip")
    sinks.write_table(df, pj, "json", compression="gzip")
    c = sinks.read_table(i.spark, pc, "csv", schema=df.schema)
    j = sinks.read_table(i.spark, pj, "json", schema=df.schema)
    apart = c.exceptAll(j).unionAll(j.exceptAll(c))
    return c.unionAll(apart.select("supplier_id", F.raise_error(F.lit("the copies differ")).alias("name"), "pricing_tier", "overall_score"))


@query("dev_sample", with_ctes(f"SELECT {', '.join(POLICY_ALL)} FROM policy ORDER BY product_id LIMIT 1000"))
def dev_sample(i):
    """IO16 (declared): development sample of 1000 products by key."""
    return sinks.dev_sample(i.policy_table.select(*POLICY_ALL), 1000, "product_id")
