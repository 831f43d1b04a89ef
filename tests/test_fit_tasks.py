"""Fits get partitions by their rows, the longest are submitted first, folds of all tasks run together, and no result changes with it."""

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from provisio.operators import models as mo
from provisio.params import TASKS


@pytest.fixture(scope="module")
def ml(spark):
    df = spark.range(300).select(F.col("id").alias("product_id"), *[F.rand(k).alias(c) for k, c in enumerate(mo.ML_COLUMNS)])
    return mo.materialize(df, "ml")


def test_vectors_are_stored_in_parts_of_bounded_rows(spark, ml, monkeypatch):
    monkeypatch.setattr(mo, "TASK_ROWS", 50)
    data = mo._task_data(ml, "demand_forecast")
    _, train, test = mo._prepared(data, 15)
    assert mo._fit_parts(data[4]) == -(-data[4] // 50) > 1
    assert len(train.inputFiles()) == mo._fit_parts(data[4]) and train.count() == data[4] and train.count() + test.count() == 300


def test_fits_at_one_time_follow_the_rows():
    assert [mo._at_once(n, 16) for n in (0, 1000, 1_000_000, 4_000_000, 10**9)] == [16, 16, 16, 4, 2]


def test_boosted_models_are_submitted_first(spark, ml, monkeypatch):
    seen = []
    monkeypatch.setattr(mo, "_prepared", lambda data, k: None)
    monkeypatch.setattr(mo, "_fit_one", lambda task, data, prepared, cand, fitted: seen.append(cand.name) or dict(task=task, model=cand.name, status="ok"))
    board = mo.model_leaderboard(spark, ml, parallelism=2)
    assert {"lightgbm", "xgboost"} >= set(seen[:6]) and len(seen) == 40
    assert board.select("task", "model").distinct().count() == 40


def test_cached_node_ids_give_the_same_trees(ml):
    train = VectorAssembler(inputCols=["eoq", "priority_score"], outputCol="features").transform(ml).select(
        F.col("qty_mean").alias("label"), "features").coalesce(1)
    for cand in mo.CANDIDATES:
        if cand.name in ("random_forest", "extra_trees"):
            est = cand.build(1.0).setNumTrees(5)
            assert est.getCacheNodeIds()
            trees = [[t.toDebugString.split("\n", 1)[1] for t in e.fit(train).trees] for e in (est, est.copy({est.cacheNodeIds: False}))]
            assert trees[0] == trees[1]


def test_folds_of_several_tasks_are_those_of_each(ml):
    tasks = ("demand_forecast", "stockout_risk")
    together = {r.task: r for r in mo.cv_r2(ml, tasks, "linear_regression").collect()}
    for t in tasks:
        alone = mo.cv_r2(ml, t, "linear_regression").first()
        df, cols = mo.task_frame(ml, TASKS[t][0])
        r2 = []
        for k in range(5):      # 300 rows by key: 60 in a fold
            held = (F.col("product_id") >= 60 * k) & (F.col("product_id") < 60 * (k + 1))
            fit = mo.fit_candidate(df.where(~held), cols, mo.CANDIDATES[0], 1.0, 240, None)
            r2.append(mo.regression_metrics(fit.transform(df.where(held))).first().r2)
        assert together[t].folds == alone.folds == 5
        assert abs(together[t].cv_r2_mean - sum(r2) / 5) < 1e-9 and abs(alone.cv_r2_mean - sum(r2) / 5) < 1e-9


def test_run_metrics_fits_eight_at_a_time(spark, ml, monkeypatch):
    from provisio.plans import q_models

    class Seen(Exception):
        pass

    class Given:
        ml_table, sf_dir = ml, "x"

    Given.spark = spark
    given = {}

    def board(*args, **named):
        given.update(named)
        raise Seen

    monkeypatch.setattr(mo, "model_leaderboard", board)
    with pytest.raises(Seen):
        q_models.run_metrics(Given)
    assert given["parallelism"] == 8 and given["schema"] == mo.RUN_SCHEMA
