"""Structured Streaming operators over inventory-update events.

The delay of a watermark is a parameter: an operator keeps state for rows up to that much older than
the newest it has seen and drops what is older.  A live source is given the lateness that it shows; a backfill reads
files in no order of time, so ``event_span`` gives it the span of its events.  Rows that are
dropped all the same are counted, and ``run_to_table`` fails rather than return a result without them.

The reference polls on a schedule and receives webhooks; here the same work
is event-time windows with watermarks, stream-static joins and streaming
aggregations.  ``run_to_table`` drives a query with ``availableNow`` into a
parquet table with one folder of updates per batch (``update`` output mode; a repeated batch replaces its folder) and
reads back the last version of every key, so windows that are still open
when the input ends are reported too and nothing is collected on the driver.
"""

from __future__ import annotations

import os
import threading
import uuid
from collections import Counter, defaultdict
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from provisio.session import checkpoint_dir
from provisio.sources.sinks import path_exists
from provisio.sources.tables import scan

EVENT_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
WATERMARK = "1 hour"


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File-stream source over the events table, one file or a folder of part files (new files are new batches)."""
    # a braced name is a pattern that matches exactly this name: the source takes a pattern where it takes no single file
    return (spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", 16)
            .parquet(os.path.join(sf_dir, "{events.parquet}")))


def event_span(spark: SparkSession, sf_dir: str) -> str:
    """The watermark delay that a backfill of the whole table needs: the span of its event times."""
    ts = F.col("ts").cast("timestamp")
    found = scan(spark, sf_dir, "events", "ts").agg((F.unix_seconds(F.max(ts)) - F.unix_seconds(F.min(ts)) + 1).alias("s")).first()
    return f"{found['s'] or 0} seconds"


def updates(events: DataFrame) -> DataFrame:
    """Inventory-update messages: product from the user id, stock = floor(value), order id from props;
    ``error`` events carry no product id and are invalid."""
    return events.select(
        # watermarks need an instant: wall-clock event time read in the session time zone
        "event_id", F.col("ts").cast("timestamp").alias("ts"),
        F.when(F.col("event_type") != "error", F.col("user_id")).alias("product_id"),
        F.floor("value").cast("double").alias("stock"),
        F.get_json_object("props", "$.k").cast("long").alias("order_id"),
        "event_type", "value")


def valid(upd: DataFrame) -> DataFrame:
    return upd.filter(F.col("product_id").isNotNull())


def rejected(upd: DataFrame) -> DataFrame:
    """Updates without a product id go to a reject stream."""
    return upd.filter(F.col("product_id").isNull())


def windowed_counts(upd: DataFrame, duration: str, slide: str | None = None, start: str | None = None,
                    delay: str = WATERMARK) -> DataFrame:
    """Per event-time window: updates, products, zero-stock updates, total value."""
    w = F.window("ts", duration, slide or duration, start) if start else F.window("ts", duration, slide or duration)
    v = valid(upd).withWatermark("ts", delay)
    return (v.groupBy(w.alias("w"))
            .agg(F.count(F.lit(1)).alias("updates"),
                 F.count_if(F.col("stock") == 0).alias("zero_stock_updates"),
                 F.sum(F.col("value").cast("decimal(18,2)")).alias("_value"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "updates",
                    "zero_stock_updates", F.col("_value").cast("double").alias("total_value")))


def window_stock(upd: DataFrame, duration: str, start: str | None = None, delay: str = WATERMARK) -> DataFrame:
    """The state that the scheduled reviews look at: each product's last stock in each window (by ts, event id).
    The state is one row per window and product, and a repeated or late row changes nothing that is newer."""
    w = F.window("ts", duration, duration, start) if start else F.window("ts", duration)
    return (valid(upd).withWatermark("ts", delay).groupBy(w.alias("w"), "product_id")
            .agg(F.max_by("stock", F.struct("ts", "event_id")).alias("stock"))
            .select(F.col("w.start").alias("window_start"), "product_id", "stock"))


LOW_STOCK = 0.2


def cycle_decisions(state: DataFrame, products: DataFrame) -> DataFrame:
    """What the cycle of each window orders: at or below a fifth of the minimum at once up to the maximum, below the
    minimum as scheduled, up to twice the minimum."""
    j = state.join(products.select("product_id", "min_stock_level", "max_stock_level"), "product_id").where(F.col("stock") < F.col("min_stock_level"))
    now = F.col("stock") <= F.col("min_stock_level") * LOW_STOCK
    level = F.when(now, F.col("max_stock_level")).otherwise(F.col("min_stock_level") * 2)
    return j.select("window_start", "product_id", "stock", F.when(now, "immediate").otherwise("scheduled").alias("urgency"),
                    (level - F.col("stock")).cast("long").alias("order_quantity"))


def daily_status(state: DataFrame, products: DataFrame) -> DataFrame:
    """Per day, how many of its products are out of stock, low, below their minimum or well stocked."""
    j = state.join(products.select("product_id", "min_stock_level"), "product_id")
    low = F.col("stock") <= F.col("min_stock_level") * LOW_STOCK
    out = F.col("stock") == 0
    below = F.col("stock") < F.col("min_stock_level")
    return j.groupBy("window_start").agg(
        F.count(F.lit(1)).alias("products"), F.count_if(out).alias("out_of_stock"), F.count_if(low & ~out).alias("low"),
        F.count_if(below & ~low & ~out).alias("below_minimum"), F.count_if(~below & ~low & ~out).alias("stocked"))


def supplier_review(state: DataFrame, products: DataFrame, pairs: DataFrame, share: float = 0.3) -> DataFrame:
    """Per week and supplier, the products of theirs that were updated, how many are below their minimum, and whether
    the supplier is reviewed (more than ``share`` of them)."""
    j = state.join(products.select("product_id", "min_stock_level"), "product_id").join(pairs, "product_id")
    found = j.groupBy("window_start", "supplier_id").agg(
        F.count(F.lit(1)).alias("products"), F.count_if(F.col("stock") < F.col("min_stock_level")).alias("below_minimum"))
    return found.withColumn("review", F.col("below_minimum") > F.lit(share) * F.col("products"))


def latest_stock(upd: DataFrame) -> DataFrame:
    """Latest stock per product; a late row never overwrites a newer one (ordered by ts, event id).
    State is one row per product and no row is too late for it, so there is no watermark."""
    return (valid(upd).groupBy("product_id")
            .agg(F.max_by(F.struct("stock", "ts", "event_id"), F.struct("ts", "event_id")).alias("l"))
            .select("product_id", F.col("l.stock").alias("stock"), F.col("l.ts").alias("updated_at"),
                    F.col("l.event_id").alias("event_id")))


def supplier_responses(upd: DataFrame, orders: DataFrame) -> DataFrame:
    """Responses need an order id; stream-static join to the orders table updates their status."""
    r = upd.filter(F.col("order_id").isNotNull()).select("event_id", "ts", "order_id", "event_type")
    return (r.join(orders, "order_id")
            .select("event_id", "order_id", "ts", F.col("status").alias("previous_status"),
                    F.when(F.col("event_type") == "purchase", "confirmed").otherwise("acknowledged")
                    .alias("new_status")))


def low_stock_alerts(upd: DataFrame, products: DataFrame, ratio: float = 0.2) -> DataFrame:
    """Stream-static join with product minimums; stock / minimum <= 0.2 raises an alert."""
    j = valid(upd).join(products.select("product_id", "min_stock_level"), "product_id")
    r = F.when(F.col("min_stock_level") == 0, F.lit(None).cast("double")).otherwise(
        F.col("stock") / F.col("min_stock_level"))
    return (j.withColumn("stock_ratio", r).filter(F.col("stock_ratio") <= ratio)
            .select("event_id", "product_id", "ts", "stock", "min_stock_level", "stock_ratio",
                    F.when(F.col("stock_ratio") < 0.1, "high").otherwise("medium").alias("severity")))


def dedup_late(upd: DataFrame, keys: Sequence[str] = ("event_id",), delay: str = WATERMARK) -> DataFrame:
    """Drop repeated deliveries of the same event within the watermark."""
    return upd.withWatermark("ts", delay).dropDuplicatesWithinWatermark(list(keys))


class _LateRows(StreamingQueryListener):
    """Rows that the watermark dropped, added up over every batch of each run (a query itself keeps its last 100 only)."""

    def __init__(self):
        self.dropped: Counter = Counter()
        self.ended: dict[str, threading.Event] = defaultdict(threading.Event)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.dropped[str(event.progress.runId)] += sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)

    def onQueryTerminated(self, event) -> None:
        self.ended[str(event.runId)].set()


def batch_sink(out: str):
    """A ``foreachBatch`` function that commits each batch once: a batch owns the folder of its id, and a batch
    that is repeated after a failure replaces what it wrote before."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(os.path.join(out, f"_batch={batch_id}"))

    return sink


def run_to_table(df: DataFrame, keys: Sequence[str], mode: str = "update", name: str | None = None, base: str | None = None) -> DataFrame:
    """Run a streaming DataFrame to completion (availableNow) and return the final state per key.

    Each micro-batch writes its changed rows to a folder of its own in the shared checkpoint folder; the last
    version of every key wins.  Without ``keys`` the rows are returned as they were emitted.  With ``base`` (a folder) a run goes on
    where an earlier one ended or failed.  Fails if the watermark dropped rows."""
    spark = df.sparkSession
    base = base or os.path.join(checkpoint_dir(spark), "streams", f"{name or 'q'}-{uuid.uuid4().hex}")
    out, ck = os.path.join(base, "out"), os.path.join(base, "checkpoint")
    listener = _LateRows()
    spark.streams.addListener(listener)
    try:
        q = (df.writeStream.outputMode(mode).option("checkpointLocation", ck).foreachBatch(batch_sink(out))
             .trigger(availableNow=True).start())
        q.awaitTermination()
        # events come in order and a little later: all progress is known when the end is
        if not listener.ended[str(q.runId)].wait(120):
            raise RuntimeError("the end of the stream was not reported, so late rows may not be counted")
    finally:
        spark.streams.removeListener(listener)
    late = listener.dropped[str(q.runId)]
    if late:
        raise RuntimeError(f"{late} rows were later than the watermark allows; give a longer delay")
    if not path_exists(spark, out):
        return spark.createDataFrame([], df.schema)
    res = spark.read.parquet(out)
    if not keys:
        return res.drop("_batch")
    cols = [c for c in res.columns if c not in keys and c != "_batch"]
    last = res.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.col("_batch")).alias("_v"))
    return last.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in cols])
