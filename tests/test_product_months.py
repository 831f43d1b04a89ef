"""The product features rolled up from months equal one aggregate over the lines, and the lines are read once."""

import pytest
from pyspark.sql import functions as F

from provisio.operators import features as fe
from provisio.operators import quality as dq


def lines_of(spark, rows):
    df = spark.createDataFrame(rows, "product_id long, day string, qty double, sales double, order_id long, actual_days int")
    d = F.to_date("day")
    return df.select("product_id", "qty", "sales", (F.col("sales") / 4).alias("profit"), "order_id", "actual_days", F.year(d).alias("year"), F.month(d).alias("month"),
                     F.quarter(d).alias("quarter"), (F.month(d) > 10).cast("int").alias("is_holiday"), F.lit(0).alias("is_weekend"),
                     (F.col("actual_days") - 3).alias("delay"), F.lit(1).alias("on_time"), F.lit(0).alias("early"), F.lit(0).alias("late"))


ROWS = [(1, "2024-01-05", 1.0, 10.0, 1, 2), (1, "2024-01-09", 3.0, 30.5, 1, 4), (1, "2024-02-01", 8.0, 11.25, 2, None), (1, "2024-11-30", 2.0, 7.0, 3, 9),
        (2, "2024-03-01", 5.0, 77777.77, 4, 1), (2, "2024-04-01", 5.0, 77777.77, 5, 1), (2, "2024-05-01", 5.0, 77777.77, 6, 1),
        (3, "2024-06-01", 4.0, 1.0, 7, 3), (4, None, None, None, 8, None), (4, None, 2.0, 3.0, 9, None), (5, "2024-07-01", 1e6, 1e9, 10, 2), (5, "2024-08-01", 1e6 + 1, 1e9 + 1, 10, 2)]


def test_moments_of_months_add_up(spark):
    lines = lines_of(spark, ROWS)
    got = {r.product_id: r for r in fe.demand_supplier_features(lines, spark.createDataFrame([], "product_id long, fulfillment_days double")).collect()}
    want = lines.groupBy("product_id").agg(
        F.bround(F.sum("qty"), 4).alias("qty_sum"), F.bround(F.stddev_samp("qty"), 4).alias("qty_std"), F.min("qty").alias("qty_min"), F.max("qty").alias("qty_max"),
        F.count("qty").alias("qty_count"), F.bround(F.stddev_samp("sales"), 4).alias("sales_std"), F.bround(F.avg("sales"), 4).alias("sales_mean"),
        F.bround(F.stddev_samp("actual_days"), 4).alias("ship_days_std"), F.bround(F.avg("actual_days"), 4).alias("ship_days_mean"),
        F.bround(F.stddev_samp("delay"), 4).alias("delay_std"), F.bround(F.avg("is_holiday"), 4).alias("holiday_mean")).collect()
    assert set(got) == {1, 2, 3, 4, 5}
    for r in want:
        for c, v in r.asDict().items():
            assert got[r.product_id][c] == (pytest.approx(v, abs=1.1e-4) if v is not None else None), (r.product_id, c)
    assert got[2].qty_std == 0 and got[2].sales_std == 0            # equal values leave no rounding noise
    assert (got[1].order_nunique, got[1].quarter_mode, got[2].quarter_mode, got[4].quarter_mode) == (3, 1, 2, None)


def test_lines_are_read_once_and_nothing_sorts_to_aggregate_them(spark):
    from provisio.plans.inputs import Inputs

    i = Inputs(spark, "/root/testdata/sf0.001")
    plan = fe.demand_features(i.lines)._jdf.queryExecution().executedPlan().toString()
    one = i.lines._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") == one.count("lineitem.parquet") and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_a_table_is_scanned_once_for_its_profile(spark, tmp_path):
    spark.createDataFrame([(1, float("nan")), (1, float("nan")), (2, None), (2, 3.0)], "a int, b double").write.parquet(str(tmp_path / "t"))
    found = dq.lineage({"t": spark.read.parquet(str(tmp_path / "t"))})
    assert found._jdf.queryExecution().executedPlan().toString().count("Location") == 1
    r = found.first()
    assert (r.rows, r.columns, r.duplicates, r.missing_values, r.total_records) == (4, 2, 1, 3, 4)
    assert dq.lineage_rows(dq.lineage_document(found)).first().asDict() == r.asDict()
    empty = dq.lineage({"t": spark.read.parquet(str(tmp_path / "t")).where("a > 9")}).first()
    assert (empty.rows, empty.duplicates, empty.missing_values) == (0, 0, 0)
