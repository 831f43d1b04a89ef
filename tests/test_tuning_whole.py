"""Tuning selects features, covers every grid and task, and a boosted point's error is that of a fit of its own."""

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from provisio.operators import models as mo
from provisio.params import TASKS


@pytest.fixture(scope="module")
def ml(spark):
    df = spark.range(300).select(F.col("id").alias("product_id"), *[F.rand(k).alias(c) for k, c in enumerate(mo.ML_COLUMNS)])
    return mo.materialize(df, "ml")


def test_selected_features_and_a_best_point_of_every_model(ml, monkeypatch):
    seen = []

    def tuned(train, *rest):
        seen.append({len(r.features) for r in train.select("features").collect()})
        best = GBTRegressor(featuresCol="features", labelCol="label", maxIter=1, maxDepth=1).fit(train)
        return [({"maxIter": 2}, 2.0), ({"maxIter": 1}, 1.0)], best

    monkeypatch.setattr(mo, "_tuned_forest", tuned)
    monkeypatch.setattr(mo, "_tuned_boosting", tuned)
    rows = mo.tuned_models(ml, "demand_forecast").collect()
    assert len(mo.ML_COLUMNS) > 16 and seen == [{15}] * 3
    assert sorted((r.model, r.is_best, r.test_rmse is not None) for r in rows) == sorted(
        (m, b, b) for m in ("random_forest", "xgboost", "gradient_boosting") for b in (True, False))


def test_every_task_is_tuned(spark, ml, monkeypatch):
    from provisio.plans import q_models

    class I:
        ml_table = ml

    monkeypatch.setattr(mo, "tuned_models", lambda ml, task, **k: spark.createDataFrame([(task,)], "task string"))
    assert sorted(r.task for r in q_models.tuned_models(I()).collect()) == sorted(TASKS)


def test_boosted_grids_have_all_points():
    assert {m: len(sizes) * len(points) for m, (sizes, points) in mo.BOOSTED_GRIDS.items()} == {"xgboost": 36, "gradient_boosting": 36}


def test_errors_of_every_size_are_those_of_single_fits(ml):
    train = VectorAssembler(inputCols=["eoq", "priority_score"], outputCol="features").transform(ml).select(
        (F.col("qty_mean") + F.col("eoq")).alias("label"), "features", (F.col("product_id") % 2).cast("int").alias("fold"))
    train = train.coalesce(1)
    point = dict(maxDepth=2, stepSize=0.2, subsamplingRate=0.8)
    scored, best = mo._tuned_boosting(train, ([2, 4], [point]), 2, 2)
    mse = RegressionEvaluator(metricName="mse")
    for params, found in scored:
        alone = [mse.evaluate(GBTRegressor(featuresCol="features", labelCol="label", seed=mo.SEED, **params).fit(train.where(F.col("fold") != k))
                              .transform(train.where(F.col("fold") == k))) for k in range(2)]
        assert abs(found - sum(alone) / 2) < 1e-9
    assert [p["maxIter"] for p, _ in scored] == [2, 4] and best.getNumTrees == min(scored, key=lambda x: x[1])[0]["maxIter"]
