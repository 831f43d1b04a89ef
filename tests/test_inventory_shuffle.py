"""Lines are sent to their product once for its stock, and what follows by product adds no shuffle."""

import re

from pyspark.sql import functions as F

from provisio.operators import cycle as cy
from provisio.operators import features as fe
from provisio.sources import adapter

SF = "/root/testdata/sf0.001"


def exchanges(df):
    return re.findall(r"\bExchange (\w+)", df._jdf.queryExecution().executedPlan().toString())


def test_stock_of_a_product_is_one_shuffle_of_lines(spark):
    inv = adapter.raw_inventory(spark, SF)
    assert exchanges(fe.inventory_features(inv)) == exchanges(inv) == ["hashpartitioning"]
    got = {tuple(r) for r in inv.select("product_id", "year_month", "inventory", F.round("unit_cost", 6)).collect()}
    li, pt = spark.read.parquet(f"{SF}/lineitem.parquet"), spark.read.parquet(f"{SF}/part.parquet")
    want = (li.groupBy("l_partkey", (F.year("l_shipdate") * 100 + F.month("l_shipdate")).alias("ym"))
            .agg(F.sum(F.expr("if(l_returnflag = 'R', l_quantity, 0.0)")).alias("i"), F.max("l_tax").alias("t"))
            .join(pt, F.col("l_partkey") == F.col("p_partkey")).select("l_partkey", "ym", "i", F.round(F.expr("p_retailprice * (1 + t)"), 6)))
    assert got == {tuple(r) for r in want.collect()} and inv.count() == len(got)


def test_best_supplier_of_a_product_is_one_shuffle_of_pairs(spark):
    pairs = adapter.product_suppliers(spark, SF)
    ranked = spark.range(100).select(F.col("id").alias("supplier_id"), F.lit("s").alias("name"), F.col("id").alias("rank"), F.lit(1.0).alias("overall_score"))
    assert exchanges(cy.best_supplier(None, F.broadcast(ranked), pairs)).count("hashpartitioning") == exchanges(pairs).count("hashpartitioning") == 1
    assert pairs.count() == pairs.distinct().count() == spark.read.parquet(f"{SF}/lineitem.parquet").select("l_partkey", "l_suppkey").distinct().count()
