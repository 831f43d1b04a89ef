"""Queries: feature preparation (SQL-checked), model assessment rules on metrics computed
from stand-in predictions (SQL-checked), and Spark ML training/scoring (rows-only)."""

from __future__ import annotations

import hashlib
import os
import uuid

from pyspark.sql import functions as F

from provisio.operators import assess as asx
from provisio.operators import models as mo
from provisio.operators import prep as pr
from provisio.operators.cycle import delivery_insights as _delivery_insights
from provisio.params import TASKS
from provisio.plans.catalog import query
from provisio.plans.oracle_base import with_ctes
from provisio.session import checkpoint_dir, materialize
from provisio.sources import registry


def _enc_sql(c):
    return (f"(SELECT v, CAST(dense_rank() OVER (ORDER BY v) - 1 AS INTEGER) AS code FROM "
            f"(SELECT DISTINCT CAST({c} AS VARCHAR) AS v FROM policy))")


ENC_CTE = """, enc AS (
  SELECT p.*, a.code AS abc_category_encoded, s.code AS stock_status_encoded, r.code AS recommended_action_encoded
  FROM policy p JOIN {a} a ON p.abc_category = a.v JOIN {s} s ON p.stock_status = s.v
  JOIN {r} r ON p.recommended_action = r.v),
mlraw AS (SELECT product_id, {cols} FROM enc),
tmet AS (
  {tm})
""".format(a=_enc_sql("abc_category"), s=_enc_sql("stock_status"), r=_enc_sql("recommended_action"),
           cols=", ".join(f"(CASE WHEN {c} IS NULL OR isnan(CAST({c} AS DOUBLE)) OR abs(CAST({c} AS DOUBLE)) = "
                          f"CAST('inf' AS DOUBLE) THEN 0.0 ELSE CAST({c} AS DOUBLE) END) AS {c}"
                          for c in pr.ML_COLUMNS),
           tm=" UNION ALL ".join(
               f"SELECT sqrt(avg(pow({t} - (0.9 * {t} + 0.05), 2))) AS rmse, "
               f"avg(abs({t} - (0.9 * {t} + 0.05))) AS mae, "
               f"1.0 - sum(pow({t} - (0.9 * {t} + 0.05), 2)) / (count({t}) * var_pop({t})) AS r2, "
               f"count({t}) AS rows, '{task}' AS task, 'stand_in' AS model FROM policy"
               for task, (t, _) in TASKS.items()))


def _wm(select: str) -> str:
    return with_ctes("").rstrip() + ENC_CTE + select


def _r9(c):
    return F.bround(F.col(c), 9).alias(c)


# ---------------------------------------------------------------- preparation (S)

@query("label_encode", _wm("SELECT product_id, abc_category_encoded, stock_status_encoded, "
                           "recommended_action_encoded FROM enc"))
def label_encode(i):
    """alphabetical codes of the three categoricals."""
    return pr.label_encode(i.policy_table).select("product_id", *pr.ENCODED)


@query("ml_features_raw", _wm("SELECT * FROM mlraw"))
def ml_features_raw(i):
    """Cleaned ML feature table (inf/NaN -> 0)."""
    return i.ml_table


@query("ml_features", _wm("SELECT product_id, " + ", ".join(
    f"round_even(CASE WHEN stddev_pop({c}) OVER () = 0 THEN 0.0 ELSE ({c} - avg({c}) OVER ()) / "
    f"stddev_pop({c}) OVER () END, 9) AS {c}" for c in pr.ML_COLUMNS) + " FROM mlraw"))
def ml_features(i):
    """standardized with the population std (constant -> 0); rounded to 9 decimals for the check."""
    return pr.ml_features(i.policy_table, digits=9)


@query("train_test_split", _wm("SELECT product_id, CAST('0x' || substr(md5(CAST(product_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 20 AS is_test "
                               "FROM policy"))
def train_test_split(i):
    """deterministic 80/20 split by key hash."""
    return pr.train_test_split(i.policy_table.select("product_id"))


@query("training_rows", _wm("SELECT product_id, CAST(qty_mean AS DOUBLE) AS label FROM mlraw "
                            "WHERE qty_mean IS NOT NULL AND NOT isnan(qty_mean)"))
def training_rows(i):
    """Rows with a target, demand task."""
    df, _ = mo.task_frame(i.ml_table, "qty_mean")
    return df.select("product_id", "label")


@query("reliability_class", _wm(
    "SELECT product_id, delivery_reliability, CASE WHEN delivery_reliability > 0 AND delivery_reliability <= 0.7 "
    "THEN 'Poor' WHEN delivery_reliability > 0.7 AND delivery_reliability <= 0.9 THEN 'Average' "
    "WHEN delivery_reliability > 0.9 AND delivery_reliability <= 1.0 THEN 'Good' END AS reliability_class "
    "FROM policy"))
def reliability_class(i):
    """F8."""
    return pr.reliability_class(i.policy_table.select("product_id", "delivery_reliability"))


@query("supplier_dataset", _wm(
    "SELECT product_id, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in [*pr.SUPPLIER_FEATURES, "delivery_reliability"]) + ", "
    "CASE WHEN delivery_reliability > 0 AND delivery_reliability <= 0.7 THEN 'Poor' "
    "WHEN delivery_reliability > 0.7 AND delivery_reliability <= 0.9 THEN 'Average' "
    "WHEN delivery_reliability > 0.9 AND delivery_reliability <= 1.0 THEN 'Good' END AS reliability_class FROM policy WHERE "
    + " AND ".join(f"{c} IS NOT NULL AND NOT isnan(CAST({c} AS DOUBLE))" for c in [*pr.SUPPLIER_FEATURES, "delivery_reliability"])))
def supplier_dataset(i):
    """The supplier models' product table of eight features, rows with missing values dropped."""
    return pr.supplier_dataset(i.policy_table)


@query("scaling_variants", _wm("SELECT product_id, " + ", ".join(
    f"round_even(CASE WHEN max({c}) OVER () = min({c}) OVER () THEN 0.0 ELSE ({c} - min({c}) OVER ()) / "
    f"(max({c}) OVER () - min({c}) OVER ()) END, 9) AS {c}_minmax" for c in ["qty_mean", "eoq", "priority_score"])
    + ", " + ", ".join(
    f"round_even(CASE WHEN q.{c}_q3 - q.{c}_q1 = 0 THEN {c} - q.{c}_med ELSE ({c} - q.{c}_med) / "
    f"(q.{c}_q3 - q.{c}_q1) END, 9) AS {c}_robust" for c in ["qty_mean", "eoq", "priority_score"])
    + " FROM mlraw, (SELECT " + ", ".join(
    f"quantile_cont({c}, 0.25) AS {c}_q1, quantile_cont({c}, 0.5) AS {c}_med, quantile_cont({c}, 0.75) AS {c}_q3"
    for c in ["qty_mean", "eoq", "priority_score"]) + " FROM mlraw) q"))
def scaling_variants(i):
    """F9 (declared): min-max and robust scaling."""
    cols = ["qty_mean", "eoq", "priority_score"]
    raw = i.ml_table.select("product_id", *cols)
    out = pr.robust_scale(pr.minmax_scale(raw, cols), cols)
    return out.select("product_id", *[_r9(f"{c}_minmax") for c in cols], *[_r9(f"{c}_robust") for c in cols])


@query("encoding_variants", _wm(
    "SELECT product_id, stock_status, " + ", ".join(
        f"CAST(stock_status = '{v}' AS INTEGER) AS stock_status_{v}"
        for v in ["Normal", "Overstock", "Reorder_Required", "Stockout"]) +
    ", round_even(avg(priority_score) OVER (PARTITION BY abc_category), 9) AS abc_category_target_mean FROM policy"))
def encoding_variants(i):
    """F10 (declared): one-hot stock status, target (priority) mean per ABC class."""
    p = i.policy_table.select("product_id", "stock_status", "abc_category", "priority_score")
    oh = pr.one_hot(p, "stock_status")
    for v in ["Normal", "Overstock", "Reorder_Required", "Stockout"]:
        if f"stock_status_{v}" not in oh.columns:
            oh = oh.withColumn(f"stock_status_{v}", F.lit(0))
    te = pr.target_encode(oh, "abc_category", "priority_score")
    return te.select("product_id", "stock_status", *[f"stock_status_{v}" for v in
                                                     ["Normal", "Overstock", "Reorder_Required", "Stockout"]],
                     _r9("abc_category_target_mean"))


# ---------------------------------------------------------------- assessment on stand-in metrics (S)

def _tm(i):
    m = asx.task_metrics_from_pred(i.policy_table)
    return m.select("task", "model", _r9("rmse"), _r9("mae"), _r9("r2"), "rows")


TMET = "SELECT task, model, round_even(rmse, 9) AS rmse, round_even(mae, 9) AS mae, round_even(r2, 9) AS r2, rows FROM tmet"


@query("regression_metrics", _wm(TMET))
def regression_metrics(i):
    """Rmse, mae, r2 over (y, y_hat) per task; y_hat = 0.9 y + 0.05 stands in for a model."""
    return _tm(i)


@query("evaluation_metrics", _wm(
    "SELECT round_even(sqrt(avg(pow(y - p, 2))), 9) AS rmse, round_even(avg(abs(y - p)), 9) AS mae, "
    "round_even(1.0 - sum(pow(y - p, 2)) / (count(y) * var_pop(y)), 9) AS r2, count(y) AS rows, "
    "round_even(avg(y), 9) AS mean_target, round_even(stddev_pop(y), 9) AS std_target, "
    "round_even(avg(p), 9) AS mean_prediction, round_even(stddev_pop(p), 9) AS std_prediction, "
    "min(y) AS min_target, max(y) AS max_target, min(p) AS min_prediction, max(p) AS max_prediction "
    "FROM (SELECT stockout_frequency AS y, 0.9 * stockout_frequency + 0.05 AS p FROM policy)"))
def evaluation_metrics(i):
    """Full-data (in-sample) metrics with target and prediction statistics."""
    p = i.policy_table.select(F.col("stockout_frequency").alias("label"),
                              (F.lit(0.9) * F.col("stockout_frequency") + F.lit(0.05)).alias("prediction"))
    e = mo.evaluation_metrics(p)
    return e.select(*[_r9(c) if c in ("rmse", "mae", "r2", "mean_target", "std_target", "mean_prediction",
                                      "std_prediction") else F.col(c) for c in e.columns])


def _assess_sql(body: str) -> str:
    return _wm(f"SELECT {body} FROM ({TMET})")


@query("model_quality", _assess_sql(
    "task, model, r2, CASE WHEN r2 >= 0.8 THEN 'Excellent' WHEN r2 >= 0.6 THEN 'Good' WHEN r2 >= 0.4 THEN 'Fair' "
    "ELSE 'Poor' END AS quality_level, CASE WHEN r2 >= 0.8 THEN 'Ready for production deployment' "
    "WHEN r2 >= 0.6 THEN 'Suitable for pilot implementation' WHEN r2 >= 0.4 THEN "
    "'Requires monitoring and improvement' ELSE 'Needs significant improvement' END AS description, "
    "CASE WHEN r2 >= 0.8 THEN 'High' WHEN r2 >= 0.6 THEN 'Medium-High' WHEN r2 >= 0.4 THEN 'Medium' ELSE 'Low' END "
    "AS confidence"))
def model_quality(i):
    """L17."""
    return asx.model_quality(_tm(i))


_RL = "CASE WHEN r2 > 0.7 AND rmse < 1.0 THEN 'Ready' WHEN r2 > 0.5 THEN 'Pilot Ready' ELSE 'Not Ready' END"


@query("model_readiness", _assess_sql(
    f"task, model, r2, rmse, {_RL} AS readiness_level, "
    f"CASE {_RL} WHEN 'Ready' THEN 'Proceed with production deployment' WHEN 'Pilot Ready' THEN "
    f"'Start with pilot implementation' ELSE 'Improve model before deployment' END AS deployment_recommendation, "
    f"CASE {_RL} WHEN 'Ready' THEN 'Standard monitoring' WHEN 'Pilot Ready' THEN "
    f"'Enhanced monitoring and validation' ELSE 'Extensive monitoring if deployed' END AS monitoring_requirements, "
    f"CASE {_RL} WHEN 'Ready' THEN 'Low' WHEN 'Pilot Ready' THEN 'Medium' ELSE 'High' END AS risk_level"))
def model_readiness(i):
    """L18."""
    return asx.model_readiness(_tm(i))


@query("expected_improvements", _assess_sql(
    "task, model, r2, CASE task WHEN 'demand_forecast' THEN (CASE WHEN r2 > 0.7 THEN 0.20 WHEN r2 > 0.5 THEN 0.10 "
    "ELSE 0.05 END) WHEN 'stockout_risk' THEN (CASE WHEN r2 > 0.6 THEN 0.80 WHEN r2 > 0.4 THEN 0.60 ELSE 0.40 END) "
    "WHEN 'delivery_performance' THEN (CASE WHEN r2 > 0.5 THEN 0.15 ELSE 0.08 END) "
    "WHEN 'procurement_priority' THEN (CASE WHEN r2 > 0.6 THEN 0.25 ELSE 0.15 END) END * 100.0 AS improvement_percent, "
    "CASE task WHEN 'demand_forecast' THEN (CASE WHEN r2 > 0.7 THEN '85' WHEN r2 > 0.5 THEN '70' ELSE '55' END) "
    "WHEN 'stockout_risk' THEN (CASE WHEN r2 > 0.6 THEN 'High' ELSE 'Medium' END) "
    "WHEN 'delivery_performance' THEN (CASE WHEN r2 > 0.5 THEN 'Significant' ELSE 'Moderate' END) "
    "WHEN 'procurement_priority' THEN (CASE WHEN r2 > 0.6 THEN 'High' ELSE 'Medium' END) END AS improvement_label, "
    "CASE WHEN task = 'demand_forecast' THEN (SELECT CAST(sum(CAST(sales_sum AS DECIMAL(22,2))) AS DOUBLE) "
    "FROM policy) * 0.02 * (CASE WHEN r2 > 0.7 THEN 0.20 WHEN r2 > 0.5 THEN 0.10 ELSE 0.05 END) END "
    "AS estimated_annual_savings"))
def expected_improvements(i):
    """L19."""
    return asx.expected_improvements(_tm(i), i.policy_table)


@query("executive_summary", _assess_sql(
    "round_even(avg(COALESCE(r2, 0.0)), 9) AS average_r2_score, count(*) FILTER (WHERE r2 > 0.7 AND rmse < 1.0) "
    "AS production_ready_models, count(*) AS total_models_evaluated, "
    "count(*) FILTER (WHERE r2 > 0.7 AND rmse < 1.0) / count(*) * 100.0 AS deployment_readiness_percentage, "
    "CASE WHEN avg(r2) >= 0.8 THEN 'Excellent' WHEN avg(r2) >= 0.6 THEN 'Good' WHEN avg(r2) >= 0.4 THEN 'Fair' "
    "ELSE 'Poor' END AS overall_model_quality, CASE WHEN avg(r2) > 0.6 THEN 'High' WHEN avg(r2) > 0.4 THEN 'Medium' "
    "ELSE 'Low' END AS automation_feasibility, CASE WHEN avg(r2) > 0.5 THEN 'Good' WHEN avg(r2) > 0.3 THEN 'Fair' "
    "ELSE 'Poor' END AS overall_performance"))
def executive_summary(i):
    """L20, S13."""
    return asx.executive_summary(_tm(i)).withColumn("average_r2_score", F.bround("average_r2_score", 9))


@query("model_recommendations", _assess_sql(
    f"task, model, {_RL} AS readiness_level, CASE {_RL} WHEN 'Ready' THEN 'Deploy ' || task || ' model to production' "
    f"WHEN 'Pilot Ready' THEN 'Run a pilot for the ' || task || ' model' ELSE 'Improve the ' || task || "
    f"' model before use' END AS recommendation"))
def model_recommendations(i):
    """L21."""
    return asx.model_recommendations(_tm(i))


@query("model_selection", _wm(
    "SELECT *, CASE WHEN priority = 'High' THEN 'immediate_deployment' WHEN priority = 'Medium' THEN 'pilot_deployment' "
    "ELSE 'future_development' END AS plan FROM (SELECT *, CASE WHEN r2 > 0.6 AND readiness_level IN ('Ready', 'Pilot Ready') "
    "THEN 'Deploy' WHEN r2 > 0.4 THEN 'Pilot' ELSE 'Improve' END AS decision, "
    "CASE WHEN r2 > 0.6 AND readiness_level = 'Ready' THEN 'High' WHEN r2 > 0.4 THEN 'Medium' ELSE 'Low' END AS priority FROM ("
    f"SELECT task, model, r2, {_RL} AS readiness_level, CASE {_RL} WHEN 'Ready' THEN 'Low' WHEN 'Pilot Ready' THEN 'Medium' "
    f"ELSE 'High' END AS risk_level FROM ({TMET})))"))
def model_selection(i):
    """J10, L22."""
    return asx.model_selection(_tm(i))


@query("business_readiness", _assess_sql(
    "count(*) FILTER (WHERE r2 >= 0.6) AS deploy_ready, count(*) FILTER (WHERE r2 >= 0.4 AND r2 < 0.6) "
    "AS pilot_ready, round_even(avg(r2), 9) AS mean_r2, CASE WHEN avg(r2) >= 0.8 THEN 'High' WHEN avg(r2) >= 0.6 "
    "THEN 'Medium-High' WHEN avg(r2) >= 0.4 THEN 'Medium' ELSE 'Low' END AS roi_band"))
def business_readiness(i):
    """L23."""
    return asx.business_readiness(_tm(i)).withColumn("mean_r2", F.bround("mean_r2", 9))


@query("quality_gate", _wm(
    "SELECT task, best_r2, minimum_r2, best_r2 >= minimum_r2 AS task_passed, "
    "(SELECT max(CAST(r2 >= 0.4 AS INTEGER)) FROM (" + TMET + ")) = 1 AS gate_passed FROM (SELECT task, max(r2) AS best_r2, "
    "CAST(CASE task WHEN 'demand_forecast' THEN 0.8 WHEN 'stockout_risk' THEN 0.7 WHEN 'delivery_performance' THEN 0.6 "
    "ELSE 0.8 END AS DOUBLE) AS minimum_r2 FROM (" + TMET + ") GROUP BY task)"))
def quality_gate(i):
    """L24."""
    return asx.quality_gate(_tm(i))


@query("prediction_band", _wm(
    "SELECT product_id, round_even(prediction, 9) AS prediction, "
    "round_even(prediction - CASE WHEN count(*) OVER () > 1 THEN stddev_pop(prediction) OVER () * 1.96 ELSE 0.1 END, 6) "
    "AS lower, round_even(prediction + CASE WHEN count(*) OVER () > 1 THEN stddev_pop(prediction) OVER () * 1.96 "
    "ELSE 0.1 END, 6) AS upper FROM (SELECT product_id, 0.9 * stockout_frequency + 0.05 AS prediction FROM policy)"))
def prediction_band(i):
    """S3: y_hat +- 1.96 population std."""
    p = i.policy_table.select("product_id", (F.lit(0.9) * F.col("stockout_frequency") + F.lit(0.05)).alias("prediction"))
    b = asx.prediction_band(p)
    return b.select("product_id", _r9("prediction"), F.bround("lower", 6).alias("lower"),
                    F.bround("upper", 6).alias("upper"))


@query("delivery_insights", _wm(
    "SELECT round_even(avg(x), 9) AS average_performance, count(*) FILTER (WHERE x > 0.9) AS excellent, "
    "count(*) FILTER (WHERE x >= 0.7 AND x <= 0.9) AS good, count(*) FILTER (WHERE x >= 0.5 AND x < 0.7) AS average, "
    "count(*) FILTER (WHERE x < 0.5) AS poor, CASE WHEN avg(x) > 0.85 THEN 'excellent' WHEN avg(x) > 0.70 THEN 'good' "
    "WHEN avg(x) > 0.50 THEN 'average' ELSE 'poor' END AS band "
    "FROM (SELECT 0.9 * delivery_reliability + 0.05 AS x FROM policy)"))
def delivery_insights(i):
    """On stand-in reliability predictions."""
    s = i.policy_table.select((F.lit(0.9) * F.col("delivery_reliability") + F.lit(0.05)).alias("reliability_pred"))
    return _delivery_insights(s).withColumn("average_performance", F.bround("average_performance", 9))


# ---------------------------------------------------------------- training and scoring (rows-only)

def _leaderboard(i):
    """The trained leaderboard (one row per task and model), written once for this query."""
    return materialize(mo.model_leaderboard(i.spark, i.ml_table), "leaderboard")


@query("model_leaderboard")
def model_leaderboard(i):
    """Ten regressors x four tasks, 80/20 split, 15 selected features."""
    return _leaderboard(i)


@query("best_model")
def best_model(i):
    """Best candidate per task by the task's metric."""
    return mo.best_model(_leaderboard(i))


@query("select_k_best")
def select_k_best(i):
    """the 15 features an F-test keeps for the demand task."""
    ml = i.ml_table
    df, cols = mo.task_frame(ml, "qty_mean")
    sigma, n = mo._sigma_n(df)
    m = mo.fit_candidate(df, cols, mo.CANDIDATES[0], sigma, n, 15)
    sel = [st for st in m.stages if hasattr(st, "selectedFeatures")][0]
    return i.spark.createDataFrame([(cols[k],) for k in sel.selectedFeatures], "feature string")


@query("tuned_models")
def tuned_models(i):
    """Grids of forest (24 points), xgboost's stand-in and boosting (36 each) with 5-fold cross-validation, every task."""
    ml = i.ml_table
    out = None
    for t in TASKS:
        r = mo.tuned_models(ml, t, parallelism=8)
        out = r if out is None else out.unionByName(r)
    return out


@query("cv_r2")
def cv_r2(i):
    """Contiguous 5-fold r2 of the forest per task."""
    return mo.cv_r2(i.ml_table, tuple(TASKS))


@query("feature_importance")
def feature_importance(i):
    """Top 10 importances of the forest per task."""
    ml = i.ml_table
    rows = []
    for t, (target, _) in TASKS.items():
        df, cols = mo.task_frame(ml, target)
        sigma, n = mo._sigma_n(df)
        m = mo.fit_candidate(df, cols, mo.CANDIDATES[5], sigma, n, 15)
        rows += [(t, f, v) for f, v in mo.feature_importance(m, cols)]
    return i.spark.createDataFrame(rows, "task string, feature string, importance double")


def _fit_forest(i, task):
    ml = i.ml_table
    target, _ = TASKS[task]
    df, cols = mo.task_frame(ml, target)
    sigma, n = mo._sigma_n(df)
    return mo.fit_candidate(df, cols, mo.CANDIDATES[5], sigma, n, None), df


def _registry(i) -> str:
    """The registry of this data folder.  Models are trained, selected and published if it has none yet."""
    root = os.path.join(checkpoint_dir(i.spark), "registry", hashlib.sha256(i.sf_dir.encode()).hexdigest()[:16])
    known = {r.task for r in registry.latest(i.spark, root).select("task").collect()}
    if known != set(TASKS):
        fitted = {}
        board = mo.model_leaderboard(i.spark, i.ml_table, fitted=fitted)
        mo.publish_best(i.spark, i.ml_table, board, root, fitted)
    return root


@query("score_products")
def score_products(i):
    """The selected model of each task, loaded from the registry, scores every product; nothing is fitted if models are published."""
    root = _registry(i)
    out = None
    for t in TASKS:
        s = registry.score(i.spark, root, i.ml_table, t)
        out = s if out is None else out.unionByName(s)
    return out


@query("model_registry")
def model_registry(i):
    """IO12: the published version of each task: model, columns, scaler, metrics and parameters, as read back."""
    return registry.latest(i.spark, _registry(i), tuple(TASKS)).drop("path")


@query("prediction_confidence")
def prediction_confidence(i):
    """The overall confidence of the stockout forest, from the mean variance across its trees."""
    m, df = _fit_forest(i, "stockout_risk")
    return mo.forest_confidence(mo.per_tree_interval(m, df))


@query("prediction_intervals")
def prediction_intervals(i):
    """95% interval and confidence from the forest's per-tree predictions."""
    m, df = _fit_forest(i, "stockout_risk")
    return mo.per_tree_interval(m, df).drop("tree_variance")


@query("comprehensive_analysis")
def comprehensive_analysis(i):
    """Three task models score the products; high-demand, high-risk, urgent flags joined."""
    preds = {}
    for t, name in [("demand_forecast", "demand_pred"), ("stockout_risk", "risk_pred"),
                    ("procurement_priority", "priority_pred")]:
        m, df = _fit_forest(i, t)
        preds[name] = m.transform(df).select("product_id", F.col("prediction").alias(name))
    scored = preds["demand_pred"].join(preds["risk_pred"], "product_id").join(preds["priority_pred"], "product_id")
    from provisio.operators import cycle as cy
    crit = cy.critical_items(scored).select("product_id", F.lit(True).alias("critical"))
    return (scored.join(crit, "product_id", "left").withColumn("critical", F.coalesce("critical", F.lit(False)))
            .withColumn("risk_band", cy.risk_band("risk_pred"))
            .withColumn("priority_level", cy.priority_level("priority_pred")))


@query("supplier_regression")
def supplier_regression(i):
    """Forest, boosting, linear and ridge on the supplier table; best by r2."""
    data = materialize(pr.supplier_dataset(i.policy_table), "supplier_dataset")
    feats = pr.SUPPLIER_FEATURES
    df = data.select("product_id", F.col("delivery_reliability").alias("label"), *feats).withColumn(
        "is_test", pr.split_flag())
    tr, te = df.filter(~F.col("is_test")), df.filter(F.col("is_test"))
    sigma, n = mo._sigma_n(tr)
    cands = [x for x in mo.CANDIDATES if x.name in ("random_forest", "gradient_boosting", "linear_regression",
                                                    "ridge", "xgboost")]
    res = mo.train_on("supplier", (tr, te, feats, sigma, n), cands, None, parallelism=5)
    rows = [(r["model"], r.get("rmse"), r.get("mae"), r.get("r2")) for r in res]
    out = i.spark.createDataFrame(rows, "model string, rmse double, mae double, r2 double")
    best = out.select(F.max_by("model", F.struct("r2", F.col("model"))).alias("best")).scalar()
    return out.withColumn("is_best", F.col("model") == best)


@query("supplier_classifier")
def supplier_classifier(i):
    """Forest and logistic regression on the reliability class."""
    data = materialize(pr.supplier_dataset(i.policy_table), "supplier_dataset")
    return mo.supplier_classifier(data, pr.SUPPLIER_FEATURES)


@query("model_roundtrip")
def model_roundtrip(i):
    """IO12: each task's published pipeline loaded twice gives the same predictions, product by product."""
    root = _registry(i)
    out = None
    for t in TASKS:
        a = registry.score(i.spark, root, i.ml_table, t).select("product_id", "task", "model", F.col("prediction").alias("p1"))
        b = registry.score(i.spark, root, i.ml_table, t).select("product_id", F.col("prediction").alias("p2"))
        both = a.join(b, "product_id").withColumn("same", F.col("p1") == F.col("p2"))
        out = both if out is None else out.unionByName(both)
    return out


@query("run_metrics")
def run_metrics(i):
    """IO11: one row per trained model (all tasks, all candidates) with its parameters and seven metrics,
    appended to a run-metrics table, read back."""
    run = uuid.uuid4().hex
    lb = mo.model_leaderboard(i.spark, i.ml_table, schema=mo.RUN_SCHEMA, parallelism=8)
    path = os.path.join(checkpoint_dir(i.spark), "run_metrics", hashlib.sha256(i.sf_dir.encode()).hexdigest()[:16])
    lb.withColumn("run_id", F.expr("uuid()")).withColumn("run", F.lit(run)).write.mode("append").partitionBy("run").parquet(path)
    # all runs are in the table; this query returns its own
    return i.spark.read.parquet(path).where(F.col("run") == run).drop("run")


@query("eval_summary")
def eval_summary(i):
    """IO13: evaluation summary of the published models (task, r2, rmse, mae, readiness) written as CSV and read back."""
    held = registry.latest(i.spark, _registry(i), tuple(TASKS))
    r = held.select("task", "r2", "rmse", "mae", asx._readiness(F.col("r2"), F.col("rmse")).alias("readiness_level"))
    path = os.path.join(checkpoint_dir(i.spark), "eval_summary", uuid.uuid4().hex)
    r.write.mode("overwrite").option("header", True).csv(path)
    return i.spark.read.option("header", True).schema(r.schema).csv(path)


@query("validate_outputs", _wm(
    "SELECT 'procurement_features' AS \"table\", count(*) AS rows, " + str(len(__import__('provisio.plans.q_features', fromlist=['POLICY_ALL']).POLICY_ALL)) +
    " AS columns, 0 AS missing_values, count(DISTINCT product_id) AS products, count(*) > 0 AS non_empty FROM policy "
    "UNION ALL SELECT 'ml_features', count(*), " + str(1 + len(pr.ML_COLUMNS)) +
    ", 0, count(DISTINCT product_id), count(*) > 0 FROM mlraw"))
def validate_outputs(i):
    """Q8: shapes, missing totals, distinct products and non-empty flags of the two feature tables."""
    from provisio.operators import quality as dq
    from provisio.plans.q_features import POLICY_ALL
    return dq.validate_outputs(i.policy_table.select(*POLICY_ALL), i.ml_table)


@query("select_all")
def select_all(i):
    """every feature column kept (the ML table as the model input)."""
    df, cols = mo.task_frame(i.ml_table, "qty_mean")
    return df


@query("lasso_select")
def lasso_select(i):
    """F11 (declared): non-zero lasso coefficients, demand task."""
    rows = mo.lasso_select(i.ml_table, "qty_mean")
    return i.spark.createDataFrame(rows, "feature string, coefficient double")


@query("rfe_select")
def rfe_select(i):
    """recursive feature elimination down to 15 with a 50-tree forest, demand task."""
    kept = mo.rfe_select(i.ml_table, "qty_mean")
    return i.spark.createDataFrame([(c,) for c in kept], "feature string")


@query("train_matrix")
def train_matrix(i):
    """scaler fitted on the training rows only, applied to train and test."""
    return mo.train_matrix(i.ml_table, "stockout_frequency")
