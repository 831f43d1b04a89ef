"""Driver contract: entry() runs, every query builds, plans stay JVM-side."""

from __future__ import annotations

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def test_entry_flagship(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert "priority_score" in df.columns and "stock_status" in df.columns


def test_oracle_keys_are_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship_plan_has_no_python_and_prunes_columns(spark):
    df = entry.queries()["procurement_policy"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "CartesianProduct" not in plan
    # lineitem scan reads only the needed columns
    assert "l_comment" not in plan
