"""IO12, S1: models are published whole, the last version wins, and another session scores with it without fitting."""

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from provisio.operators import models as mo
from provisio.params import TASKS
from provisio.sources import registry


@pytest.fixture(scope="module")
def ml(spark):
    names = ["a", "b", *{t for t, _ in TASKS.values()}]
    df = spark.range(200).select(F.col("id").alias("product_id"), *[F.rand(k).alias(c) for k, c in enumerate(sorted(set(mo.ML_COLUMNS) | set(names)))])
    return mo.materialize(df, "ml")


def test_nothing_published(spark, tmp_path):
    assert registry.versions(spark, str(tmp_path)).count() == 0
    with pytest.raises(KeyError):
        registry.load(spark, str(tmp_path), "demand_forecast")


def test_best_models_are_published_and_scored_in_another_session(spark, ml, tmp_path, monkeypatch):
    root = str(tmp_path)
    fitted = {}
    board = mo.model_leaderboard(spark, ml, candidates=mo.CANDIDATES[:2], parallelism=4, fitted=fitted)
    mo.publish_best(spark, ml, board, root, fitted)
    best = {r.task: r.model for r in mo.best_model(board).collect()}
    found = {r.task: r for r in registry.latest(spark, root).collect()}
    assert {t: r.model for t, r in found.items()} == best and set(best) == set(TASKS)
    for t, r in found.items():
        assert TASKS[t][0] not in r.columns and len(r.scaler_mean) == len(r.scaler_std) == len(r.columns) and set(r.selected) <= set(r.columns)
        assert r.rmse is not None and r.published_at is not None
        # the fit of the leaderboard is what is published: it gives the metrics that it was selected by
        _, test, *_ = mo._task_data(ml, t)
        assert abs(mo.regression_metrics(fitted[t, r.model].transform(test)).first().rmse - r.rmse) < 1e-9
    # another session, in which nothing may be fitted
    monkeypatch.setattr(Pipeline, "fit", lambda *a, **k: pytest.fail("scoring fits"))
    other = spark.newSession()
    task = "stockout_risk"
    again = other.read.parquet(ml.inputFiles()[0].rsplit("/", 1)[0])
    one = {r.product_id: r.prediction for r in registry.score(other, root, again, task).collect()}
    two = {r.product_id: r.prediction for r in registry.score(spark, root, ml, task).collect()}
    assert one == two and len(one) == 200
    # a column that is gone and values that are missing count as 0
    column = found[task].selected[0]
    gone = registry.score(spark, root, ml.drop(column), task).orderBy("product_id").collect()
    null = registry.score(spark, root, ml.withColumn(column, F.lit(None).cast("double")), task).orderBy("product_id").collect()
    assert [r.prediction for r in gone] == [r.prediction for r in null]


def test_last_version_wins_and_an_unfinished_one_is_not_seen(spark, tmp_path, monkeypatch):
    from pyspark.ml.feature import VectorAssembler

    root = str(tmp_path)
    df = spark.createDataFrame([(float(k), 2.0 * k) for k in range(20)], "x double, label double")
    fitted = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features"), LinearRegression()]).fit(df)
    first = registry.publish(spark, root, fitted, task="t", model="one", columns=["x"], selected=["x"], params={})
    second = registry.publish(spark, root, fitted, task="t", model="two", columns=["x"], selected=["x"], params={})
    assert first != second and registry.load(spark, root, "t")[1]["version"] == second
    monkeypatch.setattr(type(fitted), "save", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        registry.publish(spark, root, fitted, task="t", model="three", columns=["x"], selected=["x"], params={})
    assert registry.load(spark, root, "t")[1]["model"] == "two" and registry.versions(spark, root).count() == 2
