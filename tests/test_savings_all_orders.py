"""The savings potential is that of all orders of a cycle, immediate and scheduled."""

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_scheduled_orders_are_counted(spark):
    from __spark_entry__ import queries
    from provisio.plans.inputs import Inputs

    i = Inputs(spark, SF)
    values = [float(df.agg(F.sum("total_amount")).first()[0]) for df in (i.decisions, i.scheduled)]
    got = queries()["savings_potential"](spark, SF).first()
    assert i.scheduled.count() > 0 and got.orders == i.decisions.count() + i.scheduled.count()
    assert abs(got.total_value - sum(values)) < 1e-6 * sum(values)
    assert abs(got.savings_potential - 0.05 * sum(values)) < 1e-6 * sum(values)
