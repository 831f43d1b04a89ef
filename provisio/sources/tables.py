"""Parquet scans of the driver's tables.

Only the needed columns are selected right after the scan so the parquet
reader prunes the rest (``ReadSchema`` in the plan) and filters written later
reach it as ``PushedFilters``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

#: order lines of one task where lines are joined, sorted or made distinct by key: about 650 bytes of its memory each
TASK_ROWS = 400_000


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def scan(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def task_count(rows: int) -> int:
    """Tasks that hold ``rows`` with at most ``TASK_ROWS`` each, if keys are spread evenly."""
    return max(1, -(-rows // TASK_ROWS))


def by_key(df: DataFrame, key: str, tasks: int = 1) -> DataFrame:
    """Rows sent to their key: in ``tasks`` tasks, so that a task's memory does not grow with the table, where these fill the cores.

    Spark's own number is fixed, and it joins small partitions by their compressed bytes, of which narrow rows take a dozen times in memory;
    both make a large table's tasks spill."""
    if tasks <= df.sparkSession.sparkContext.defaultParallelism:
        return df.repartition(key)
    return df.repartition(tasks, key)

