"""X4-X8, IO8-IO10: batches and keyed rows are stored once, and late rows are counted over every batch."""

import pytest
from pyspark.sql import functions as F

from provisio.sources import sinks
from provisio.streaming import streams


def write_events(spark, folder, rows):
    spark.createDataFrame(rows, "id long, at long, v long").select("id", F.timestamp_seconds("at").alias("ts"), "v").coalesce(1).write.mode("append").parquet(folder)


def read(spark, folder):
    return spark.readStream.schema("id long, ts timestamp, v long").option("maxFilesPerTrigger", 1).parquet(folder)


def test_a_repeated_batch_writes_nothing_twice(spark, tmp_path):
    sink = streams.batch_sink(str(tmp_path / "out"))
    rows = spark.createDataFrame([(1, 2), (3, 4)], "a long, b long")
    sink(rows, 0)
    sink(rows.limit(1), 1)
    sink(rows, 0)
    assert spark.read.parquet(str(tmp_path / "out")).groupBy("_batch").count().collect() and spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_a_batch_that_dies_after_its_write_is_repeated_once(spark, tmp_path, monkeypatch):
    src, base = str(tmp_path / "in"), str(tmp_path / "base")
    for k in range(3):
        write_events(spark, src, [(10 * k + j, 1000 + k, j) for j in range(4)])
    real, died = streams.batch_sink, []

    def dying(out):
        sink = real(out)

        def run(batch, batch_id):
            sink(batch, batch_id)
            if batch_id == 1 and not died:
                died.append(batch_id)
                raise RuntimeError("lost after the write")

        return run

    monkeypatch.setattr(streams, "batch_sink", dying)
    with pytest.raises(Exception, match="lost after the write"):
        streams.run_to_table(read(spark, src), [], "append", base=base)
    got = streams.run_to_table(read(spark, src), [], "append", base=base)
    assert died == [1] and sorted(r.id for r in got.collect()) == [10 * k + j for k in range(3) for j in range(4)]


def test_late_rows_are_counted_over_more_batches_than_a_query_remembers(spark, tmp_path):
    """The late row is dropped in one of the first batches; more follow than the query keeps progress of (3 here, 100 by default)."""
    src = str(tmp_path / "in")
    write_events(spark, src, [(1, 100_000, 1)])
    write_events(spark, src, [(2, 200_000, 1)])
    write_events(spark, src, [(3, 10, 1)])           # far below the watermark by then
    for k in range(9):
        write_events(spark, src, [(10 + k, 200_001 + k, 1)])
    with spark_conf(spark, "spark.sql.shuffle.partitions", "1"), spark_conf(spark, "spark.sql.streaming.numRecentProgressUpdates", "3"):
        counted = read(spark, src).withWatermark("ts", "10 seconds").groupBy(F.window("ts", "1 hour")).agg(F.count(F.lit(1)).alias("n")).select("window.start", "n")
        with pytest.raises(RuntimeError, match="later than the watermark"):
            streams.run_to_table(counted, ["start"])


class spark_conf:
    def __init__(self, spark, key, value):
        self.spark, self.key, self.value = spark, key, value

    def __enter__(self):
        self.old = self.spark.conf.get(self.key)
        self.spark.conf.set(self.key, self.value)

    def __exit__(self, *a):
        self.spark.conf.set(self.key, self.old)


def test_keyed_append_reads_only_the_folders_it_touches(spark, tmp_path):
    path, day = str(tmp_path / "t"), F.regexp_extract("id", r"_(\d{8})_", 1)
    make = lambda rows: spark.createDataFrame(rows, "id string, v long")
    sinks.append_with_key(spark, make([("PO_20240101_1", 1), ("PO_20240101_1", 0), ("PO_20240102_1", 2)]), path, "id", day)
    again = make([("PO_20240102_1", 9), ("PO_20240102_2", 3)])
    plan = sinks.stored_keys(spark, path, "id", again.withColumn("_part", day))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "20240102" in plan and "20240101" not in plan
    sinks.append_with_key(spark, again, path, "id", day)
    assert sorted((r.id, r.v) for r in spark.read.parquet(path).collect()) == [("PO_20240101_1", 0), ("PO_20240102_1", 2), ("PO_20240102_2", 3)]
