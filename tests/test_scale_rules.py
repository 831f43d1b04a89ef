"""What must hold beyond one small file: ranks, streams over many files, sums, caps, shared folders."""

from __future__ import annotations

import os
import tempfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from provisio import session
from provisio.functions.columns import exact_sum, mean_r4
from provisio.functions.ranking import global_row_number
from provisio.operators import cycle as cy
from provisio.streaming import streams as st

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("parts", ["16", "200"])
def test_ranks_are_exact_with_extra_columns(spark, parts):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        df = spark.range(1_000_000).select("id", (F.xxhash64("id") % 5000).alias("score"), F.md5(F.col("id").cast("string")).alias("extra"))
        got = global_row_number(df, [("score", True), ("id", False)], "rank")
        r = got.agg(F.count("rank"), F.count_distinct("rank"), F.min("rank"), F.max("rank")).first()
        assert tuple(r) == (1_000_000, 1_000_000, 1, 1_000_000)
        top = got.orderBy("rank").limit(3).select("id").collect()
        want = df.orderBy(F.desc("score"), "id").limit(3).select("id").collect()
        assert top == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_streams_over_many_files_out_of_order_lose_nothing(spark):
    folder = tempfile.mkdtemp(prefix="provisio-lake-", dir=session.checkpoint_dir(spark))
    events = spark.read.parquet(f"{SF}/events.parquet")
    events.repartition(40, F.xxhash64("event_id")).write.parquet(os.path.join(folder, "events.parquet"))
    delay = st.event_span(spark, folder)
    batch = st.updates(events)
    upd = st.updates(st.read_events(spark, folder))
    w = st.run_to_table(st.windowed_counts(upd, "6 hours", delay=delay), ["window_start", "window_end"])
    assert w.select(F.sum("updates")).first()[0] == st.valid(batch).count()
    twice = st.updates(st.read_events(spark, folder).unionAll(st.read_events(spark, folder)))
    once = st.run_to_table(st.dedup_late(twice, delay=delay), [], "append")
    assert once.count() == events.count() == once.select("event_id").distinct().count()
    rej = st.run_to_table(st.rejected(st.updates(st.read_events(spark, folder))).select("event_id", "ts"), [], "append")
    assert rej.count() == st.rejected(batch).count() > 0


def test_rows_later_than_the_watermark_are_an_error(spark):
    folder = tempfile.mkdtemp(prefix="provisio-late-", dir=session.checkpoint_dir(spark))
    events = spark.read.parquet(f"{SF}/events.parquet")
    events.repartition(40, F.xxhash64("event_id")).write.parquet(os.path.join(folder, "events.parquet"))
    with pytest.raises(RuntimeError, match="later than the watermark"):
        st.run_to_table(st.windowed_counts(st.updates(st.read_events(spark, folder)), "6 hours"), ["window_start", "window_end"])


def test_sums_round_the_total_not_the_rows(spark):
    df = spark.createDataFrame([(1.005,), (1.004,), (-0.0001,), (None,)], "x double")
    r = df.agg(exact_sum("x").alias("s"), mean_r4("x").alias("m")).first()
    assert r["s"] == 2.0089 and r["m"] == 0.6696
    assert df.where("x is null").agg(mean_r4("x").alias("m")).first()["m"] is None


def test_every_urgent_item_is_decided(spark):
    n = 25
    products = spark.createDataFrame([(k, f"p{k}", "c", 10, 50, Decimal("2.0000"), 3, 0, [1]) for k in range(n)],
                                     "product_id long, name string, category string, min_stock_level int, max_stock_level int, "
                                     "unit_cost decimal(18,4), lead_time int, current_stock long, supplier_ids array<long>")
    scored = spark.createDataFrame([(k, 1.0, 0.1, 90.0 - k) for k in range(n)],
                                   "product_id long, demand_pred double, risk_pred double, priority_pred double")
    ranked = spark.createDataFrame([(1, "s", 1, 0.9)], "supplier_id long, name string, rank long, overall_score double")
    assert cy.procurement_decisions(products, scored, ranked).count() == n
    assert cy.procurement_decisions(products, scored, ranked, k=10).count() == 10


def test_no_scratch_folder_beside_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError, match="share"):
        session.checkpoint_dir(Session())
