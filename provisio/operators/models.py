"""Model training, tuning and evaluation as Spark ML jobs (L1-L16, L25-L26, F3-F6, S1-S4, IO11-IO13).

Every fit is a distributed Spark ML job over the product feature table; the
driver only holds model parameters and one metrics row per model.  Metrics
are SQL aggregates over (y, y_hat), so they scale with the scored table.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Callable, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import ElementwiseProduct, StandardScaler, UnivariateFeatureSelector, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor, LinearRegression,
                                   RandomForestRegressor)
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provisio.operators.prep import ML_COLUMNS, split_flag
from provisio.params import TASKS
from provisio.session import materialize

SEED = 42
#: training rows of one task while tuning: each task of a fit holds and sends the statistics of all nodes, whatever its rows
TUNING_ROWS = 50_000
#: training rows of one task of a fit beside tuning, and of all fits at one time: a forest holds a count and a node id a tree and row while it is fitted
TASK_ROWS = 100_000
ROWS_AT_ONCE = 16_000_000
ALPHA = 1.0
L1_RATIO = 0.5


@dataclass
class Candidate:
    name: str
    build: Callable[[float], object]   # sigma_y (population std of the target) -> estimator


def _linear(reg: float, en: float):
    return LinearRegression(featuresCol="features", labelCol="label", regParam=reg, elasticNetParam=en,
                            standardization=False, maxIter=200, tol=1e-9)


# The reference's model line-up and hyper-parameters.
CANDIDATES = [
    Candidate("linear_regression", lambda s: _linear(0.0, 0.0)),
    # sklearn Ridge(alpha) on n rows == Spark L2 with regParam = alpha * sigma_y / n (n set at fit time)
    Candidate("ridge", lambda s: _linear(ALPHA, 0.0)),
    Candidate("lasso", lambda s: _linear(ALPHA, 1.0)),
    Candidate("elastic_net", lambda s: _linear(ALPHA * (L1_RATIO + s * (1 - L1_RATIO)),
                                               (ALPHA * L1_RATIO) / (ALPHA * (L1_RATIO + s * (1 - L1_RATIO)))
                                               if s > 0 else 1.0)),
    Candidate("decision_tree", lambda s: DecisionTreeRegressor(maxDepth=10, seed=SEED)),
    # cached node ids: rows are not sent down every tree again at each level; the trees are the same
    Candidate("random_forest", lambda s: RandomForestRegressor(numTrees=100, cacheNodeIds=True, seed=SEED)),
    # nearest Spark form of extra trees: no bootstrap (random split thresholds are not available)
    Candidate("extra_trees", lambda s: RandomForestRegressor(numTrees=100, bootstrap=False, cacheNodeIds=True,
                                                             featureSubsetStrategy="sqrt", seed=SEED)),
    Candidate("gradient_boosting", lambda s: GBTRegressor(maxIter=100, stepSize=0.1, maxDepth=3, seed=SEED)),
    # xgboost / lightgbm are not installed: re-aimed as boosted-tree configurations
    Candidate("xgboost", lambda s: GBTRegressor(maxIter=100, stepSize=0.1, maxDepth=6, seed=SEED)),
    Candidate("lightgbm", lambda s: GBTRegressor(maxIter=100, stepSize=0.1, maxDepth=5, subsamplingRate=0.8,
                                                 seed=SEED)),
]


def task_frame(ml: DataFrame, target: str, include_target: bool = False,
               features: Sequence[str] = ML_COLUMNS) -> tuple[DataFrame, list[str]]:
    """Label + feature columns for one task (D12: the target is left out of its own features)."""
    cols = [c for c in features if c in ml.columns and (include_target or c != target)]
    df = ml.select("product_id", F.col(target).cast("double").alias("label"), *cols)
    return df.filter(F.col("label").isNotNull() & ~F.isnan("label")), cols


def _regression_columns(y: str, y_hat: str) -> list:
    e = F.col(y) - F.col(y_hat)
    residual, total = F.sum(e * e), F.count(y) * F.var_pop(y)
    # a constant target: 1 for a perfect prediction, else 0
    r2 = F.when(total == 0, F.when(residual == 0, 1.0).otherwise(0.0)).otherwise(F.lit(1.0) - F.try_divide(residual, total))
    return [F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"), r2.alias("r2"), F.count(y).alias("rows")]


def regression_metrics(pred: DataFrame, y: str = "label", y_hat: str = "prediction") -> DataFrame:
    """Rmse, mae, r2 as ONE aggregate over (y, y_hat)."""
    return pred.agg(*_regression_columns(y, y_hat))


def run_metric_values(pred: DataFrame, y: str = "label", y_hat: str = "prediction") -> DataFrame:
    """IO11: the seven metrics of a run (L10's three, mean and population std of y and y_hat) as ONE aggregate."""
    return pred.agg(*_regression_columns(y, y_hat), F.avg(y).alias("mean_target"), F.stddev_pop(y).alias("std_target"),
                    F.avg(y_hat).alias("mean_prediction"), F.stddev_pop(y_hat).alias("std_prediction"))


def evaluation_metrics(pred: DataFrame, y: str = "label", y_hat: str = "prediction") -> DataFrame:
    """Metrics plus mean/std (population) and ranges of y and y_hat, as ONE aggregate."""
    return pred.agg(*_regression_columns(y, y_hat), F.avg(y).alias("mean_target"), F.stddev_pop(y).alias("std_target"),
                    F.avg(y_hat).alias("mean_prediction"), F.stddev_pop(y_hat).alias("std_prediction"),
                    F.min(y).alias("min_target"), F.max(y).alias("max_target"),
                    F.min(y_hat).alias("min_prediction"), F.max(y_hat).alias("max_prediction"))


def _scaling(cols: list[str], n: int) -> list:
    """Assemble and standardise with the population standard deviation of ``n`` training rows: Spark's scaler
    divides by the sample's, so its output is multiplied by the ratio of the two."""
    factor = (n / (n - 1)) ** 0.5 if n > 1 else 1.0
    return [VectorAssembler(inputCols=cols, outputCol="raw", handleInvalid="keep"),
            StandardScaler(inputCol="raw", outputCol="sample_scaled", withMean=True, withStd=True),
            ElementwiseProduct(scalingVec=Vectors.dense([factor] * len(cols)), inputCol="sample_scaled", outputCol="scaled")]


def _preparation(cols: list[str], select_k: int | None, n: int) -> Pipeline:
    stages = _scaling(cols, n)
    if select_k:
        stages.append(UnivariateFeatureSelector(featuresCol="scaled", outputCol="features", labelCol="label",
                                                selectionMode="numTopFeatures")
                      .setFeatureType("continuous").setLabelType("continuous").setSelectionThreshold(select_k))
    else:
        stages[-1].setOutputCol("features")
    return Pipeline(stages=stages)


def _pipeline(cols: list[str], estimator, select_k: int | None, n: int) -> Pipeline:
    return Pipeline(stages=_preparation(cols, select_k, n).getStages() + [estimator.setFeaturesCol("features").setLabelCol("label")])


def _sigma_n(train: DataFrame) -> tuple[float, int]:
    row = train.agg(F.stddev_pop("label"), F.count(F.lit(1))).first()
    return float(row[0] or 0.0), int(row[1])


def _estimator(cand: Candidate, sigma: float, n: int):
    est = cand.build(sigma)
    if cand.name == "ridge":
        est.setRegParam(ALPHA * sigma / max(n, 1))
    return est.setFeaturesCol("features").setLabelCol("label")


def fit_candidate(train: DataFrame, cols: list[str], cand: Candidate, sigma: float, n: int,
                  select_k: int | None = 15) -> PipelineModel:
    return _pipeline(cols, _estimator(cand, sigma, n), select_k if select_k and select_k < len(cols) else None, n).fit(train)


def _task_data(ml: DataFrame, task: str):
    target, _ = TASKS[task]
    df, cols = task_frame(ml, target)
    df = df.withColumn("is_test", split_flag())
    train, test = df.filter(~F.col("is_test")), df.filter(F.col("is_test"))
    sigma, n = _sigma_n(train)
    return train, test, cols, sigma, n


def _fit_parts(n: int) -> int:
    """Partitions of ``n`` training rows: whatever the files of a table, so that a fit of many rows has the cores and one of few rows one task."""
    return max(1, -(-n // TASK_ROWS))


def _at_once(n: int, most: int) -> int:
    """Fits of ``n`` training rows at one time, so that what they keep of the rows stays in memory."""
    return max(2, min(most, ROWS_AT_ONCE // max(n, 1)))


def _prepared(data, select_k: int | None) -> tuple[list, DataFrame, DataFrame]:
    """The fitted scaling and selection of a task, and its training and test vectors, stored: they are the same for every candidate."""
    train, test, cols, _, n = data
    fitted = _preparation(cols, select_k if select_k and select_k < len(cols) else None, n).fit(train)
    keep = ["product_id", "label", "features"]
    return fitted.stages, *[materialize(fitted.transform(part).select(keep).repartition(_fit_parts(n)), "vectors") for part in (train, test)]


def _fit_one(task: str, data, prepared, cand: Candidate, fitted: dict | None = None) -> dict:
    _, _, cols, sigma, n = data
    stages, train, test = prepared
    try:
        last = _estimator(cand, sigma, n).fit(train)
        m = run_metric_values(last.transform(test)).first()
    except Exception as e:  # noqa: BLE001 - a failing model is skipped, and its row says so
        return dict(task=task, model=cand.name, status=f"failed: {type(e).__name__}")
    if fitted is not None:
        fitted[task, cand.name] = PipelineModel(stages=[*stages, last])
    chosen = [[cols[k] for k in st.selectedFeatures] for st in stages if hasattr(st, "selectedFeatures")]
    used = chosen[0] if chosen else list(cols)
    return dict(task=task, model=cand.name, status="ok", rmse=float(m.rmse) if m.rmse is not None else None,
                mae=float(m.mae) if m.mae is not None else None,
                r2=float(m.r2) if m.r2 is not None else None, test_rows=int(m.rows),
                train_rows=n, num_features=len(used),
                mean_target=m.mean_target, std_target=m.std_target, mean_prediction=m.mean_prediction,
                std_prediction=m.std_prediction, target_column=TASKS[task][0] if task in TASKS else None,
                feature_selection_method="selectkbest" if chosen else "none", selected_features=used,
                params={p.name: str(v) for p, v in last.extractParamMap().items()})


def train_task(ml: DataFrame, task: str, candidates: Sequence[Candidate] = CANDIDATES,
               select_k: int | None = 15) -> list[dict]:
    """Split 80/20, select 15 features, scale, fit every candidate; a failing model is skipped."""
    return train_on(task, _task_data(ml, task), candidates, select_k)


def train_on(task: str, data, candidates: Sequence[Candidate], select_k: int | None, parallelism: int = 1) -> list[dict]:
    """One row of metrics per candidate on ``data``: (train, test, feature columns, std of the target, training rows)."""
    prepared = _prepared(data, select_k)
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        return list(pool.map(lambda c: _fit_one(task, data, prepared, c), candidates))


LEADERBOARD_SCHEMA = ("task string, model string, status string, rmse double, mae double, r2 double, "
                      "test_rows long, train_rows long, num_features long")


RUN_SCHEMA = (LEADERBOARD_SCHEMA + ", mean_target double, std_target double, mean_prediction double, std_prediction double, "
              "target_column string, feature_selection_method string, selected_features array<string>, params map<string,string>")


def model_leaderboard(spark: SparkSession, ml: DataFrame, tasks: Sequence[str] = tuple(TASKS),
                      candidates: Sequence[Candidate] = CANDIDATES, parallelism: int = 16,
                      select_k: int | None = 15, schema: str = LEADERBOARD_SCHEMA, fitted: dict | None = None) -> DataFrame:
    """Every candidate for every task; the fits are submitted concurrently
    (each fit is a set of distributed Spark jobs) on vectors that are prepared and stored once per task, the last candidates first:
    boosted models take longest, and one that starts last would leave cores idle.
    ``RUN_SCHEMA`` adds IO11's parameters and metrics; ``fitted`` receives the pipelines by (task, model)."""
    data = {t: _task_data(ml, t) for t in tasks}
    jobs = [(t, c) for c in reversed(candidates) for t in tasks]
    with ThreadPoolExecutor(max_workers=_at_once(max(n for *_, n in data.values()), parallelism)) as pool:
        prepared = dict(zip(data, pool.map(lambda t: _prepared(data[t], select_k), data)))
        rows = list(pool.map(lambda tc: _fit_one(tc[0], data[tc[0]], prepared[tc[0]], tc[1], fitted), jobs))
    cols = [c.split()[0] for c in schema.split(", ")]
    return spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows], schema)


def best_model(leaderboard: DataFrame) -> DataFrame:
    """Per task, the best candidate by the task's metric (max r2, else min rmse / mae)."""
    metric = F.create_map(*[x for t, (_, m) in TASKS.items() for x in (F.lit(t), F.lit(m))])[F.col("task")]
    key = (F.when(metric == "r2", F.col("r2")).when(metric == "rmse", -F.col("rmse")).otherwise(-F.col("mae")))
    ok = leaderboard.filter(F.col("status") == "ok").withColumn("_k", key)
    best = F.max_by(F.struct("model", "rmse", "mae", "r2"), F.struct("_k", F.col("model")))
    return (ok.groupBy("task").agg(best.alias("b"), F.first(metric).alias("metric"))
            .select("task", "metric", "b.model", "b.rmse", "b.mae", "b.r2"))


def publish_best(spark: SparkSession, ml: DataFrame, leaderboard: DataFrame, root: str, fitted: dict) -> None:
    """IO12: publish each task's selected candidate (L13) as it was fitted for the leaderboard, with its metadata."""
    from provisio.sources import registry

    for row in best_model(leaderboard).collect():       # one row per task
        _, cols = task_frame(ml, TASKS[row.task][0])
        model = fitted[row.task, row.model]
        chosen = [[cols[k] for k in st.selectedFeatures] for st in model.stages if hasattr(st, "selectedFeatures")]
        registry.publish(spark, root, model, task=row.task, model=row.model, target=TASKS[row.task][0], metric=row.metric, columns=list(cols),
                         selected=chosen[0] if chosen else list(cols), rmse=row.rmse, mae=row.mae, r2=row.r2,
                         params={p.name: str(v) for p, v in model.stages[-1].extractParamMap().items()})


def _tuning_parts(n: int) -> int:
    """Partitions of ``n`` training rows while tuning."""
    return max(1, -(-n // TUNING_ROWS))


def _boosted_grid(depths: Sequence[int]) -> tuple[list[int], list[dict]]:
    """Sizes of a boosted model and the other parameters of its grid: 36 points in all."""
    return [100, 200], [dict(maxDepth=d, stepSize=r, subsamplingRate=s) for d in depths for r in (0.01, 0.1, 0.2) for s in (0.8, 1.0)]


# The reference's grids of the two boosted models (xgboost re-aimed as above).
BOOSTED_GRIDS = {"xgboost": _boosted_grid([3, 6, 10]), "gradient_boosting": _boosted_grid([3, 5, 7])}


def _tuned_forest(train: DataFrame, folds: int, parallelism: int) -> tuple[list[tuple[dict, float]], object]:
    """(parameters, mean MSE over the folds) of the forest's 24 points, and the best one fitted on all rows."""
    rf = RandomForestRegressor(featuresCol="features", labelCol="label", seed=SEED)
    grid = (ParamGridBuilder().addGrid(rf.numTrees, [50, 100, 200]).addGrid(rf.maxDepth, [5, 10])
            .addGrid(rf.minInstancesPerNode, [1, 2]).addGrid(rf.subsamplingRate, [0.8, 1.0]).build())
    cv = CrossValidator(estimator=rf, estimatorParamMaps=grid, evaluator=RegressionEvaluator(metricName="mse"),
                        numFolds=folds, parallelism=parallelism, seed=SEED)
    model = cv.fit(train)
    return [({p.name: v for p, v in pm.items()}, float(m)) for pm, m in zip(grid, model.avgMetrics)], model.bestModel


def _tuned_boosting(train: DataFrame, grid: tuple[list[int], list[dict]], folds: int, parallelism: int) -> tuple[list[tuple[dict, float]], object]:
    """The same of a boosted grid.  A boosted model's first k trees are the model of k iterations, so a point and fold is
    fitted once, to the largest size, and ``evaluateEachIteration`` gives the MSE of every size."""
    sizes, points = grid
    parts = [(train.where(F.col("fold") != k), train.where(F.col("fold") == k)) for k in range(folds)]

    def errors(job):
        point, (fit_on, rest) = job
        each = GBTRegressor(featuresCol="features", labelCol="label", seed=SEED, maxIter=max(sizes), **point).fit(fit_on).evaluateEachIteration(rest, "squared")
        return [float(each[n - 1]) for n in sizes]

    jobs = [(point, part) for point in points for part in parts]
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        found = list(pool.map(errors, jobs))
    scored = [(dict(maxIter=n, **point), sum(f[k] for f in found[p * folds:(p + 1) * folds]) / folds)
              for k, n in enumerate(sizes) for p, point in enumerate(points)]
    best = min(scored, key=lambda x: x[1])[0]
    return scored, GBTRegressor(featuresCol="features", labelCol="label", seed=SEED, **best).fit(train)


def tuned_models(ml: DataFrame, task: str, folds: int = 5, parallelism: int = 8, select_k: int | None = 15) -> DataFrame:
    """The 15 selected features, scaled; grid search with k-fold cross-validation (MSE) for the forest (24 points) and the two
    boosted models (36 points each); each model's best point, fitted on all training rows, is scored on the held-out rows.

    Selection and scaling are fitted on the training rows once, as in the reference, and the vectors are stored with their fold.
    A fit on a small table is one task, and several fits fill the cores."""
    target, _ = TASKS[task]
    df, cols = task_frame(ml, target)
    is_test = split_flag()
    train = df.filter(~is_test)
    n = train.count()
    prepare = _preparation(cols, select_k if select_k and select_k < len(cols) else None, n).fit(train)
    fold = F.pmod(F.xxhash64("product_id"), F.lit(folds)).cast("int").alias("fold")
    ready = materialize(prepare.transform(df).select("product_id", "label", "features", fold), "tuning")
    ready = ready.coalesce(_tuning_parts(n))
    train, test = ready.filter(~is_test), ready.filter(is_test)
    rows = []
    for name, tune in [("random_forest", lambda: _tuned_forest(train, folds, parallelism)),
                       *[(name, lambda g=grid: _tuned_boosting(train, g, folds, parallelism)) for name, grid in BOOSTED_GRIDS.items()]]:
        scored, best = tune()
        held_out = regression_metrics(best.transform(test)).first()
        first = min(range(len(scored)), key=lambda k: scored[k][1])
        rows += [(task, name, str(point), mse, k == first, *((held_out.rmse, held_out.mae, held_out.r2) if k == first else (None,) * 3))
                 for k, (point, mse) in enumerate(scored)]
    return ml.sparkSession.createDataFrame(rows, "task string, model string, params string, cv_mse double, is_best boolean, "
                                                 "test_rmse double, test_mae double, test_r2 double")


def cv_r2(ml: DataFrame, task: str | Sequence[str], model_name: str = "random_forest", folds: int = 5, parallelism: int = 4) -> DataFrame:
    """Contiguous (unshuffled) folds by product key; fit per fold, r2 per fold, mean and std.

    The rows of a task are stored once with their fold; the fits of all folds and tasks are submitted concurrently."""
    # contiguous folds: fold = position * folds / n over the product key (distributed row numbers)
    from provisio.functions.ranking import global_row_number
    cand = next(c for c in CANDIDATES if c.name == model_name)
    rows, data = ml.count(), {}
    for t in [task] if isinstance(task, str) else task:
        df, cols = task_frame(ml, TASKS[t][0])
        n = df.select(F.count(F.lit(1))).scalar()
        df = global_row_number(df, [("product_id", False)], "_rn").withColumn(
            "fold", F.floor((F.col("_rn") - 1) * folds / n).cast("int"))
        data[t] = materialize(df.repartition(_fit_parts(rows)), "folds"), cols

    def fold_r2(job):
        t, k = job
        df, cols = data[t]
        tr, te = df.filter(F.col("fold") != k), df.filter(F.col("fold") == k)
        sigma, nn = _sigma_n(tr)
        m = fit_candidate(tr, cols, cand, sigma, nn, None)
        return t, k, float(regression_metrics(m.transform(te)).first().r2)

    with ThreadPoolExecutor(max_workers=_at_once(rows, parallelism)) as pool:
        r2s = list(pool.map(fold_r2, [(t, k) for t in data for k in range(folds)]))
    out = ml.sparkSession.createDataFrame(r2s, "task string, fold int, r2 double")
    return out.groupBy("task").agg(F.avg("r2").alias("cv_r2_mean"), F.stddev_pop("r2").alias("cv_r2_std"),
                                   F.count(F.lit(1)).alias("folds"))


def feature_importance(model: PipelineModel, cols: list[str], top: int = 10) -> list[tuple[str, float]]:
    """Tree importances or |coefficients| of the fitted model, top 10."""
    est = model.stages[-1]
    names = cols
    for st in model.stages:
        if hasattr(st, "selectedFeatures"):
            names = [cols[i] for i in st.selectedFeatures]
    if hasattr(est, "featureImportances"):
        vals = est.featureImportances.toArray()
    else:
        vals = [abs(x) for x in est.coefficients.toArray()]
    return sorted(zip(names, map(float, vals)), key=lambda x: (-x[1], x[0]))[:top]


def per_tree_interval(model: PipelineModel, df: DataFrame, lo: float = 0.025, hi: float = 0.975) -> DataFrame:
    """Interval and confidence from per-tree predictions, as array columns
    (sorted array + linear interpolation; no explode of trees x rows)."""
    forest = model.stages[-1]
    prep = PipelineModel(stages=model.stages[:-1]).transform(df)
    trees = forest.trees
    k = len(trees)
    preds = prep.select("product_id", "features")
    cols = []
    for i, t in enumerate(trees):
        t.setFeaturesCol("features").setPredictionCol(f"_t{i}")
        preds = t.transform(preds)
        cols.append(f"_t{i}")
    arr = F.array_sort(F.array(*[F.col(c) for c in cols]))

    def q(p):
        pos = (k - 1) * p
        lo_i, frac = int(pos), pos - int(pos)
        a = F.element_at(arr, lo_i + 1)
        b = F.element_at(arr, min(lo_i + 2, k))
        return a + (b - a) * F.lit(frac)
    mean = sum((F.col(c) for c in cols), F.lit(0.0)) / k
    var = sum(((F.col(c) - mean) ** 2 for c in cols), F.lit(0.0)) / k
    return preds.select("product_id", mean.alias("prediction"), q(lo).alias("lower"), q(hi).alias("upper"),
                        F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.lit(1.0) - var)).alias("confidence"), var.alias("tree_variance"))


def forest_confidence(intervals: DataFrame) -> DataFrame:
    """ONE number for the scored table: 1 less the mean over rows of the variance across trees, between 0 and 1."""
    clipped = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.lit(1.0) - F.avg("tree_variance")))
    return intervals.agg(clipped.alias("confidence"), F.avg("tree_variance").alias("mean_tree_variance"), F.count(F.lit(1)).alias("rows"))


def supplier_classifier(data: DataFrame, features: Sequence[str]) -> DataFrame:
    """Random forest and logistic regression on the reliability class; accuracy on a 20% split."""
    from pyspark.ml.feature import StringIndexer
    df = data.filter(F.col("reliability_class").isNotNull()).withColumn("is_test", split_flag("product_id"))
    idx = StringIndexer(inputCol="reliability_class", outputCol="label", stringOrderType="alphabetAsc")
    rows = []
    for name, est in [("random_forest", RandomForestClassifier(numTrees=100, seed=SEED)),
                      ("logistic_regression", LogisticRegression(maxIter=200))]:
        pipe = Pipeline(stages=[idx, VectorAssembler(inputCols=list(features), outputCol="raw"),
                                StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True),
                                est.setFeaturesCol("features").setLabelCol("label")])
        tr, te = df.filter(~F.col("is_test")), df.filter(F.col("is_test"))
        m = pipe.fit(tr)
        acc = MulticlassClassificationEvaluator(metricName="accuracy").evaluate(m.transform(te))
        rows.append((name, float(acc)))
    return data.sparkSession.createDataFrame(rows, "model string, accuracy double")


def lasso_select(ml: DataFrame, target: str, alpha: float = ALPHA, max_features: int = 50) -> list[tuple[str, float]]:
    """F11 (declared): features with a non-zero lasso coefficient (at most 50), largest first."""
    df, cols = task_frame(ml, target)
    model = _pipeline(cols, _linear(alpha, 1.0), None, df.count()).fit(df)
    coefs = model.stages[-1].coefficients.toArray()
    kept = [(c, float(v)) for c, v in zip(cols, coefs) if v != 0.0]
    return sorted(kept, key=lambda x: (-abs(x[1]), x[0]))[:max_features]


def rfe_select(ml: DataFrame, target: str, keep: int = 15, trees: int = 50) -> list[str]:
    """recursive elimination: fit a 50-tree forest, drop the least important feature, repeat."""
    df, cols = task_frame(ml, target)
    cols, n = list(cols), df.count()
    while len(cols) > keep:
        model = _pipeline(cols, RandomForestRegressor(numTrees=trees, seed=SEED), None, n).fit(df)
        imp = model.stages[-1].featureImportances.toArray()
        worst = min(range(len(cols)), key=lambda k: (imp[k], cols[k]))
        cols.pop(worst)
    return cols


def train_matrix(ml: DataFrame, target: str) -> DataFrame:
    """the second standardisation, fitted on the training split only and applied to both splits."""
    from pyspark.ml.functions import vector_to_array
    df, cols = task_frame(ml, target)
    df = df.withColumn("is_test", split_flag())
    train = df.filter(~F.col("is_test"))
    out = Pipeline(stages=_scaling(cols, train.count())).fit(train).transform(df)
    return out.select("product_id", "is_test", "label", vector_to_array("scaled").alias("features"))
