"""Session construction and the shared checkpoint folder.

On a cluster the session is created by the platform; ``get_spark`` only fills
in settings that are unset.  The checkpoint folder is always read from
``spark.checkpoint.dir``; a local scratch folder is only chosen when the
setting is missing (tests, local runs).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "8g",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "provisio") -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may do without the setting and gets a scratch folder; on any other master a folder
    of one machine would be unreadable for the others, so that is an error."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="provisio-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", path)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return path


def materialize(df, name: str = "table"):
    """Write ``df`` once as parquet into the shared checkpoint folder and read it back.

    This cuts the lineage like ``checkpoint()`` but computes the plan only
    once (an eager RDD checkpoint runs it twice), and the result is a
    columnar table with size statistics that the planner can use."""
    import uuid as _uuid
    spark = df.sparkSession
    path = os.path.join(checkpoint_dir(spark), "tables", f"{name}-{_uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
