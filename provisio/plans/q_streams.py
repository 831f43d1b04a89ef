"""Queries: Structured Streaming operators run to completion over the events table.

Each oracle is the batch equivalent in SQL: a stream that has consumed all
input must equal the batch query over the same rows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from provisio.plans.catalog import query
from provisio.sources.tables import scan
from provisio.streaming import streams as st

UPD = ("WITH upd AS (SELECT event_id, ts, CASE WHEN event_type <> 'error' THEN user_id END AS product_id, "
       "CAST(floor(value) AS DOUBLE) AS stock, CAST(json_extract_string(props, '$.k') AS BIGINT) AS order_id, "
       "event_type, value FROM events), val AS (SELECT * FROM upd WHERE product_id IS NOT NULL) ")
DAY_US = 86400 * 1000000
HOUR_US = 3600 * 1000000


def _bucket(size_us: int, off_us: int = 0) -> str:
    return f"make_timestamp(((epoch_us(ts) - {off_us}) // {size_us}) * {size_us} + {off_us})"


def _window_sql(size_us: int, off_us: int = 0) -> str:
    start = _bucket(size_us, off_us)
    return (UPD + f"SELECT {start} AS window_start, {start} + to_microseconds({size_us}) AS window_end, "
            "count(*) AS updates, count(*) FILTER (WHERE stock = 0) AS zero_stock_updates, "
            "CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value FROM val GROUP BY 1, 2")


def _ntz(df):
    """Event times leave the registered queries as wall-clock timestamps."""
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if t == "timestamp" else F.col(c)
                       for c, t in df.dtypes])


def _win(i, duration, slide=None, start=None):
    upd = st.updates(st.read_events(i.spark, i.sf_dir))
    return _ntz(st.run_to_table(st.windowed_counts(upd, duration, slide, start, st.event_span(i.spark, i.sf_dir)), ["window_start", "window_end"],
                                name="window"))


@query("stream_cycle_6h", _window_sql(6 * HOUR_US))
def stream_cycle_6h(i):
    """Every 6 hours (tumbling event-time window)."""
    return _win(i, "6 hours")


@query("stream_daily_check", _window_sql(DAY_US, 8 * HOUR_US))
def stream_daily_check(i):
    """Daily check at 08:00 (1-day windows starting 08:00)."""
    return _win(i, "1 day", "1 day", "8 hours")


# 1970-01-01 is a Thursday: a 4 days 9 hours offset starts the week on Monday 09:00
@query("stream_weekly_review", _window_sql(7 * DAY_US, (4 * 24 + 9) * HOUR_US))
def stream_weekly_review(i):
    """Weekly review, Monday 09:00 to Monday 09:00."""
    return _win(i, "7 days", "7 days", "4 days 9 hours")


def _state_sql(size_us: int, off_us: int, select: str) -> str:
    return (UPD + f", ranked AS (SELECT {_bucket(size_us, off_us)} AS window_start, product_id, stock, row_number() OVER (PARTITION BY "
            f"{_bucket(size_us, off_us)}, product_id ORDER BY ts DESC, event_id DESC) AS rn FROM val), state AS (SELECT r.window_start, r.product_id, "
            "r.stock, p.p_size AS lo, p.p_size * 5 AS hi FROM ranked r JOIN part p ON r.product_id = p.p_partkey WHERE rn = 1) " + select)


def _state(i, duration, start=None):
    """The last stock of each window and product, kept by the stream, and the product levels."""
    upd = st.updates(st.read_events(i.spark, i.sf_dir))
    state = st.run_to_table(st.window_stock(upd, duration, start, st.event_span(i.spark, i.sf_dir)), ["window_start", "product_id"], name="state")
    products = scan(i.spark, i.sf_dir, "part", "p_partkey", "p_size").select(
        F.col("p_partkey").alias("product_id"), F.col("p_size").alias("min_stock_level"), (F.col("p_size") * 5).alias("max_stock_level"))
    return state, products


@query("stream_cycle_decisions", _state_sql(6 * HOUR_US, 0, (
    "SELECT window_start, product_id, stock, CASE WHEN stock <= lo * 0.2 THEN 'immediate' ELSE 'scheduled' END AS urgency, "
    "CAST(CASE WHEN stock <= lo * 0.2 THEN hi ELSE lo * 2 END - stock AS BIGINT) AS order_quantity FROM state WHERE stock < lo")))
def stream_cycle_decisions(i):
    """The orders that the cycle of every 6 hours decides from the stock at its end."""
    return _ntz(st.cycle_decisions(*_state(i, "6 hours")))


@query("stream_daily_status", _state_sql(DAY_US, 8 * HOUR_US, (
    "SELECT window_start, count(*) AS products, count(*) FILTER (WHERE stock = 0) AS out_of_stock, "
    "count(*) FILTER (WHERE stock <> 0 AND stock <= lo * 0.2) AS low, "
    "count(*) FILTER (WHERE stock <> 0 AND stock > lo * 0.2 AND stock < lo) AS below_minimum, "
    "count(*) FILTER (WHERE stock <> 0 AND stock > lo * 0.2 AND stock >= lo) AS stocked FROM state GROUP BY 1")))
def stream_daily_status(i):
    """The daily check at 08:00: stock status of the products of the day."""
    return _ntz(st.daily_status(*_state(i, "1 day", "8 hours")))


@query("stream_supplier_review", _state_sql(7 * DAY_US, (4 * 24 + 9) * HOUR_US, (
    "SELECT window_start, l_suppkey AS supplier_id, count(*) AS products, count(*) FILTER (WHERE stock < lo) AS below_minimum, "
    "count(*) FILTER (WHERE stock < lo) > 0.3 * count(*) AS review "
    "FROM state JOIN (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) ON product_id = l_partkey GROUP BY 1, 2")))
def stream_supplier_review(i):
    """The weekly review, Monday 09:00: suppliers by the stock of what they deliver."""
    return _ntz(st.supplier_review(*_state(i, "7 days", "4 days 9 hours"), i.supplier_pairs))


@query("stream_rolling_kpis", UPD + (
    "SELECT window_start, window_start + INTERVAL 30 DAY AS window_end, count(*) AS updates, "
    "count(*) FILTER (WHERE stock = 0) AS zero_stock_updates, "
    "CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value FROM ("
    f"SELECT *, {_bucket(DAY_US)} - to_days(k) AS window_start FROM val, (SELECT unnest(range(0, 30)) AS k)) "
    "GROUP BY 1, 2"))
def stream_rolling_kpis(i):
    """KPIs over the last 30 days, sliding by one day."""
    return _win(i, "30 days", "1 day")


@query("stream_inventory_upsert", UPD + (
    "SELECT product_id, stock, ts AS updated_at, event_id FROM (SELECT *, row_number() OVER "
    "(PARTITION BY product_id ORDER BY ts DESC, event_id DESC) AS rn FROM val) WHERE rn = 1"))
def stream_inventory_upsert(i):
    """Latest stock per product from valid updates (late rows never overwrite newer stock)."""
    upd = st.updates(st.read_events(i.spark, i.sf_dir))
    return _ntz(st.run_to_table(st.latest_stock(upd), ["product_id"], name="upsert"))


@query("stream_rejects", UPD + "SELECT event_id, ts, event_type FROM upd WHERE product_id IS NULL")
def stream_rejects(i):
    """Invalid updates (no product id) routed to a reject table."""
    upd = st.updates(st.read_events(i.spark, i.sf_dir))
    return _ntz(st.run_to_table(st.rejected(upd).select("event_id", "ts", "event_type"), ["event_id"], "append",
                           name="rejects"))


@query("stream_supplier_response", UPD + (
    "SELECT u.event_id, u.order_id, u.ts, o.o_orderstatus AS previous_status, "
    "CASE WHEN u.event_type = 'purchase' THEN 'confirmed' ELSE 'acknowledged' END AS new_status "
    "FROM upd u JOIN orders o ON u.order_id = o.o_orderkey WHERE u.order_id IS NOT NULL"))
def stream_supplier_response(i):
    """Supplier responses (order id required) joined to the orders table."""
    upd = st.updates(st.read_events(i.spark, i.sf_dir))
    orders = scan(i.spark, i.sf_dir, "orders", "o_orderkey", "o_orderstatus").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status"))
    return _ntz(st.run_to_table(st.supplier_responses(upd, orders), ["event_id"], "append", name="responses"))


@query("stream_low_stock", UPD + (
    "SELECT v.event_id, v.product_id, v.ts, v.stock, p.p_size AS min_stock_level, "
    "v.stock / p.p_size AS stock_ratio, CASE WHEN v.stock / p.p_size < 0.1 THEN 'high' ELSE 'medium' END "
    "AS severity FROM val v JOIN part p ON v.product_id = p.p_partkey "
    "WHERE p.p_size <> 0 AND v.stock / p.p_size <= 0.2"))
def stream_low_stock(i):
    """Low-stock alerts from updates joined to product minimums."""
    upd = st.updates(st.read_events(i.spark, i.sf_dir))
    products = scan(i.spark, i.sf_dir, "part", "p_partkey", "p_size").select(
        F.col("p_partkey").alias("product_id"), F.col("p_size").alias("min_stock_level"))
    return _ntz(st.run_to_table(st.low_stock_alerts(upd, products), ["event_id"], "append", name="lowstock"))


@query("stream_dedup_late", UPD + "SELECT event_id, ts, product_id, stock, order_id, event_type, value FROM upd")
def stream_dedup_late(i):
    """Every event is delivered twice; the second delivery is dropped within the watermark."""
    upd = st.updates(st.read_events(i.spark, i.sf_dir).unionAll(st.read_events(i.spark, i.sf_dir)))
    return _ntz(st.run_to_table(st.dedup_late(upd, delay=st.event_span(i.spark, i.sf_dir)), [], "append", name="dedup"))
