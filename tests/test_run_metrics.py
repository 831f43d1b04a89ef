"""IO11: every trained model has its row, with parameters and seven metrics."""

SF_SMALL = "/root/testdata/sf0.001"

METRICS = ("rmse", "mae", "r2", "mean_target", "std_target", "mean_prediction", "std_prediction")


def test_one_row_per_task_and_candidate(spark):
    from provisio.operators import models as mo
    from provisio.params import TASKS
    from __spark_entry__ import queries

    rows = queries()["run_metrics"](spark, SF_SMALL).collect()
    assert sorted((r.task, r.model) for r in rows) == sorted((t, c.name) for t in TASKS for c in mo.CANDIDATES)
    assert len({r.run_id for r in rows}) == len(rows) == 40
    for r in rows:
        assert r.status == "ok" and all(r[m] is not None for m in METRICS) and r.target_column == TASKS[r.task][0]
        assert len(r.selected_features) == r.num_features and r.target_column not in r.selected_features
        assert ("maxDepth" in r.params) == (r.model not in ("linear_regression", "ridge", "lasso", "elastic_net"))
    assert len({r.mean_target for r in rows}) == len(TASKS)
