"""Sinks: feature tables, operational tables with primary keys, formats (IO5-IO10, IO15-IO16).

Operational tables (orders, alerts, negotiations) are append-only parquet
folders, one folder per cycle date; a primary key is enforced by anti-joining the incoming rows against
the keys already stored in the folders that they belong to, so re-running a cycle never duplicates rows.  One writer at a time
is assumed, as one cycle runs at a time: the check and the append are two steps.
"""

from __future__ import annotations

import os
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                compression: str | None = None, partition_by: Sequence[str] = ()) -> None:
    """IO5, IO6, IO15: write a table as parquet/csv/json, optionally compressed and partitioned."""
    w = df.write.mode(mode).format(fmt)
    if compression:
        w = w.option("compression", compression)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema=None) -> DataFrame:
    r = spark.read.format(fmt)
    if fmt == "csv":
        r = r.option("header", True)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


MAX_PARTITIONS_NAMED = 1000


def append_with_key(spark: SparkSession, df: DataFrame, path: str, key: str, partition: Column | None = None) -> None:
    """IO8-IO10: append rows whose key is not stored yet (PRIMARY KEY semantics).

    The incoming batch is de-duplicated on the key first.  ``partition`` (an expression of the key alone, such as the cycle
    date in it) is the folder that a row is stored in, as column ``_part``: equal keys share it, so only the folders that the batch
    touches are read for the anti-join (``PartitionFilters``).  Without it, all stored keys are read as one column."""
    # rows that share a key: the least one by its other columns, so that the choice does not depend on the order
    rest = [c for c in df.columns if c != key]
    incoming = df.groupBy(key).agg(F.min(F.struct(*rest)).alias("_r")).select(key, "_r.*").select(df.columns)
    if partition is not None:
        incoming = incoming.withColumn("_part", partition)
    if path_exists(spark, path):
        incoming = incoming.join(stored_keys(spark, path, key, incoming), key, "left_anti")
    w = incoming.write.mode("append")
    (w.partitionBy("_part") if partition is not None else w).parquet(path)


def stored_keys(spark: SparkSession, path: str, key: str, incoming: DataFrame) -> DataFrame:
    """The stored keys that rows of ``incoming`` can equal: those of its folders, if the table has folders."""
    if "_part" not in incoming.columns:
        return spark.read.parquet(path).select(key)
    stored = spark.read.schema(incoming.select(key, "_part").schema).parquet(path)
    parts = [r[0] for r in incoming.select("_part").distinct().limit(MAX_PARTITIONS_NAMED + 1).collect()]
    return (stored.where(F.col("_part").isin(parts)) if len(parts) <= MAX_PARTITIONS_NAMED else stored).select(key)


def dev_sample(df: DataFrame, n: int, key: str) -> DataFrame:
    """IO16 (declared): the first n rows by key (development sample)."""
    return df.orderBy(key).limit(n)
