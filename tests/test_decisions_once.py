"""The decisions of a cycle are made once, however often a query reads them."""

from provisio.plans.inputs import Inputs

SF = "/root/testdata/sf0.001"


def test_what_follows_decisions_reads_no_order_lines(spark):
    i = Inputs(spark, SF)
    for df in (i.orders_out, i.negotiations, i.alerts, i.scheduled, i.decisions.unionByName(i.scheduled)):
        files = df.inputFiles()
        assert files and not [f for f in files if "lineitem" in f or "orders.parquet" in f]
    assert i.decisions.count() == i.decisions.select("product_id").distinct().count() == i.orders_out.count() > 0
