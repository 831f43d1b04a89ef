"""Assessment branches, the metrics of a constant target, the split of any key, encoders and ingestion helpers."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from provisio.functions.quantiles import grouped_quantiles
from provisio.operators import assess, models, prep
from provisio.sources import sinks
from provisio.session import checkpoint_dir


def metrics(spark, rows):
    return spark.createDataFrame(rows, "task string, model string, r2 double, rmse double, mae double")


def test_every_deployment_branch(spark):
    m = metrics(spark, [("a", "m", 0.8, 0.5, 0.1), ("b", "m", 0.65, 2.0, 0.1), ("c", "m", 0.6, 0.5, 0.1), ("d", "m", 0.4, 0.5, 0.1),
                        ("e", "m", 0.9, 0.5, 0.1), ("f", "m", None, None, None)])
    own = {r.task: (r.decision, r.priority, r.plan) for r in assess.model_selection(m).collect()}
    assert own["a"] == ("Deploy", "High", "immediate_deployment")
    assert own["b"] == ("Deploy", "Medium", "pilot_deployment")          # over 0.6 and only ready for a pilot
    assert own["c"] == ("Pilot", "Medium", "pilot_deployment")           # 0.6 itself is not enough
    assert own["d"] == own["f"] == ("Improve", "Low", "future_development")
    evaluated = spark.createDataFrame([("a", "Not Ready", "High"), ("b", "Ready", "Low")], "task string, readiness_level string, risk_level string")
    got = {r.task: (r.decision, r.priority, r.readiness_level) for r in assess.model_selection(m, evaluated).collect()}
    assert got["a"] == ("Pilot", "Medium", "Not Ready") and got["b"] == ("Deploy", "High", "Ready")
    assert got["e"] == ("Pilot", "Medium", "Not Ready")                  # no evaluation: not ready


def test_gate_has_a_minimum_of_each_task(spark):
    m = metrics(spark, [("demand_forecast", "m", 0.75, 1.0, 1.0), ("delivery_performance", "m", 0.61, 1.0, 1.0), ("other", "m", 0.41, 1.0, 1.0)])
    got = {r.task: (r.minimum_r2, r.task_passed, r.gate_passed) for r in assess.quality_gate(m).collect()}
    assert got == {"demand_forecast": (0.8, False, True), "delivery_performance": (0.6, True, True), "other": (0.4, True, True)}


@pytest.mark.parametrize("pairs, want", [([(2.0, 2.0), (2.0, 2.0)], 1.0), ([(2.0, 1.0), (2.0, 2.0)], 0.0), ([(1.0, 1.0), (3.0, 2.0)], 0.5)])
def test_r2_of_a_constant_target(spark, pairs, want):
    df = spark.createDataFrame(pairs, "label double, prediction double")
    assert models.regression_metrics(df).first().r2 == want


def test_split_takes_any_key(spark):
    ids = spark.range(0, 100_000_000_000, 100).select(F.col("id").alias("product_id")).limit(20_000)
    share = prep.train_test_split(ids).agg(F.avg(F.col("is_test").cast("double"))).first()[0]
    assert 0.18 < share < 0.22
    text = spark.createDataFrame([("sku-1",), ("sku-2",), (None,)], "product_id string")
    assert prep.train_test_split(text).count() == 3


def test_quantiles_with_one_hot_value_and_null_groups(spark):
    df = spark.range(40_000).select(F.when(F.col("id") % 3 > 0, F.lit("g")).alias("g"),
                                    F.when(F.col("id") % 2 == 0, 0.0).otherwise(F.col("id").cast("double")).alias("x"))
    got = {(r.g, r.q): r.x for r in grouped_quantiles(df, ["g"], "x", [0.0, 0.25, 0.5, 0.9]).collect()}
    want = df.groupBy("g").agg(*[F.expr(f"percentile(x, {q})").alias(str(q)) for q in (0.0, 0.25, 0.5, 0.9)]).collect()
    assert got == {(r.g, q): pytest.approx(r[str(q)]) for r in want for q in (0.0, 0.25, 0.5, 0.9)}


def test_one_hot_refuses_an_unbounded_column(spark):
    df = spark.createDataFrame([(k, f"v{k}") for k in range(5)], "id long, c string")
    assert "c_v3" in prep.one_hot(df, "c").columns
    with pytest.raises(ValueError):
        prep.one_hot(df, "c", max_values=4)


def test_equal_keys_of_a_batch_are_resolved_by_value(spark):
    path = f"{checkpoint_dir(spark)}/test-ties-{spark.sparkContext.applicationId}"
    for rows in ([("a", 2), ("a", 1)], [("a", 1), ("a", 2)]):
        df = spark.createDataFrame(rows, "order_id string, v int")
        sinks.append_with_key(spark, df, f"{path}-{rows[0][1]}", "order_id")
        assert [tuple(r) for r in spark.read.parquet(f"{path}-{rows[0][1]}").collect()] == [("a", 1)]


def test_ingestion_helpers(spark):
    from provisio.operators import explore, ingest

    df = spark.createDataFrame([(1, "a", 2.5, True)], "` id ` long, `name\t` string, price double, flag boolean")
    assert ingest.clean_columns(df).columns == ["id", "name", "price", "flag"]
    assert ingest.require_columns(df, ["price"]) is df
    with pytest.raises(ingest.MissingColumnsError, match="other"):
        ingest.require_columns(df, ["price", "other"], "orders")
    assert ingest.missing_columns(df, ["price", "x", "y"]) == ["x", "y"]
    assert explore.numeric_columns(df) == [" id ", "price"]
