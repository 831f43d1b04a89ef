"""Order lines are sent to their keys in as many tasks as their number asks for, so that a task's memory does not grow with the table."""

from pyspark.sql import functions as F

from provisio.plans.inputs import Inputs
from provisio.sources import tables

SF = "/root/testdata/sf0.001"


def _sizes(df):
    return [r.n for r in df.groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("n")).collect()]


def test_no_task_holds_more_lines_when_the_table_grows(spark, monkeypatch):
    before = Inputs(spark, SF)
    want = before.decisions.orderBy("product_id").collect(), before.scheduled.orderBy("product_id").collect()
    monkeypatch.setattr(tables, "TASK_ROWS", 100)
    i = Inputs(spark, SF)
    lines = i.product_lines
    tasks = i.line_tasks
    assert tasks == -(-tables.scan(spark, SF, "lineitem").count() // 100)
    for df in (lines, i.inventory, i.supplier_pairs, i.lines):
        assert df.count() > 0
        assert max(_sizes(df)) < 400                 # 8 tasks, the session's own number, would hold 700 lines each
    per_product = lines.groupBy("product_id", F.spark_partition_id().alias("task")).count()
    assert per_product.count() == per_product.select("product_id").distinct().count()
    plan = i.features._jdf.queryExecution().executedPlan().toString()
    assert plan.count(f", {tasks}), REPARTITION_BY_NUM") == 4          # lines and orders by order, lines by product, stock by product
    assert (i.decisions.orderBy("product_id").collect(), i.scheduled.orderBy("product_id").collect()) == want


def test_a_small_table_keeps_sparks_own_number(spark):
    i = Inputs(spark, SF)
    assert i.line_tasks == 1
    assert "REPARTITION_BY_NUM" not in i.features._jdf.queryExecution().executedPlan().toString()
