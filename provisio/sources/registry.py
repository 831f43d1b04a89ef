"""A registry of fitted pipelines in the shared folder (IO12, S1).

A version is a folder of its own under a fresh name; it is published by appending ONE row to the metadata table after the
pipeline is complete.  Spark commits that file in one rename, so a reader sees a version whole or not at all, and a
failed training leaves an unlisted folder.  Versions are never overwritten: the latest row of a task wins.
"""

from __future__ import annotations

import os
import uuid
from typing import Sequence

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = ("task string, version string, model string, target string, metric string, columns array<string>, selected array<string>, "
          "scaler_mean array<double>, scaler_std array<double>, rmse double, mae double, r2 double, params map<string,string>, "
          "published_at timestamp, path string")


def versions(spark: SparkSession, root: str) -> DataFrame:
    """All published versions; none if nothing was published below ``root``."""
    try:
        return spark.read.schema(SCHEMA).parquet(os.path.join(root, "metadata"))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e.getCondition()):
            raise
        return spark.createDataFrame([], SCHEMA)


def publish(spark: SparkSession, root: str, fitted: PipelineModel, /, **metadata) -> str:
    """Save ``fitted`` as a new version of ``metadata['task']`` and list it; returns the version."""
    version = uuid.uuid4().hex
    path = os.path.join(root, "models", metadata["task"], version)
    fitted.save(path)
    scaler = next((s for s in fitted.stages if hasattr(s, "mean") and hasattr(s, "std")), None)
    row = spark.range(1).select(F.current_timestamp().alias("published_at"))
    known = dict(version=version, path=path, scaler_mean=[float(x) for x in scaler.mean] if scaler else None,
                 scaler_std=[float(x) for x in scaler.std] if scaler else None, **metadata)
    names = [c.split()[0] for c in SCHEMA.replace("map<string,string>", "map").split(", ")]
    given = spark.createDataFrame([tuple(known.get(c) for c in names if c != "published_at")],
                                  ", ".join(c for c in SCHEMA.split(", ") if not c.startswith("published_at")))
    given.crossJoin(row).select(names).coalesce(1).write.mode("append").parquet(os.path.join(root, "metadata"))
    return version


def latest(spark: SparkSession, root: str, tasks: Sequence[str] | None = None) -> DataFrame:
    """One row per task: its last published version."""
    found = versions(spark, root)
    if tasks is not None:
        found = found.where(F.col("task").isin(list(tasks)))
    whole = F.struct(*[F.col(c) for c in found.columns])
    return found.groupBy("task").agg(F.max_by(whole, F.struct("published_at", "version")).alias("v")).select("v.*")


def load(spark: SparkSession, root: str, task: str) -> tuple[PipelineModel, dict]:
    """The last published pipeline of a task and its metadata; a KeyError if there is none."""
    row = latest(spark, root, [task]).first()
    if row is None:
        raise KeyError(f"no published model of {task} in {root}")
    return PipelineModel.load(row.path), row.asDict()


def score(spark: SparkSession, root: str, features: DataFrame, task: str, id_col: str = "product_id") -> DataFrame:
    """(id, task, model, version, prediction): the loaded model on a features table; columns that it lacks and missing values are 0."""
    model, known = load(spark, root, task)
    have = [F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)).alias(c) if c in features.columns else F.lit(0.0).alias(c)
            for c in known["columns"]]
    return model.transform(features.select(id_col, *have)).select(
        id_col, F.lit(task).alias("task"), F.lit(known["model"]).alias("model"), F.lit(known["version"]).alias("version"), "prediction")
