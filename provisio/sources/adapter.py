"""Stand-in inputs built from the driver's TPC-H-like tables.

The reference reads three CSV files (orders and shipments, monthly inventory,
fulfilment days) plus a product master and a supplier master.  These
functions only shape rows of those schemas out of ``lineitem``, ``orders``,
``part``, ``supplier`` and ``events``; every analytic step runs later, in the
operators, on whatever rows they are given.

The formulas are fixed (FIXTURES.md section 3) and the SQL oracle spells the
same ones in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from provisio.functions.columns import ratio
from provisio.sources.tables import by_key, scan

# Pricing tier by s_nationkey % 4.
TIERS = ["Economy", "Standard", "Premium", "Basic"]


def raw_orders(spark: SparkSession, sf_dir: str, tasks: int = 1, by_product: bool = False) -> DataFrame:
    """Order lines in the reference's raw layout: dates as year/month/day ints,
    discount as text.

    ``tasks``: how many hold the lines within a task's memory; ``by_product``: the lines are sent to their product, in as many."""
    li = scan(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_quantity",
              "l_extendedprice", "l_discount", "l_shipdate")
    od = scan(spark, sf_dir, "orders", "o_orderkey", "o_orderdate", "o_orderpriority")
    pt = scan(spark, sf_dir, "part", "p_partkey", "p_type", "p_retailprice")
    if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")):
        li, od = by_key(li, "l_orderkey", tasks), by_key(od, "o_orderkey", tasks)
    j = li.join(od, F.col("l_orderkey") == F.col("o_orderkey"))
    if by_product:
        j = by_key(j, "l_partkey", tasks)
    j = j.join(pt, F.col("l_partkey") == F.col("p_partkey"))
    order_date = F.to_date("o_orderdate")
    day_diff = F.datediff(F.to_date("l_shipdate"), order_date)
    actual = F.pmod(day_diff, F.lit(8))
    ship_date = F.date_add(order_date, actual)
    sales = F.col("l_extendedprice").cast("decimal(12,2)")
    profit = (sales * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))
              - F.col("l_quantity").cast("decimal(12,0)") * F.col("p_retailprice").cast("decimal(12,2)"))
    return j.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("p_type").alias("department"),
        F.year(order_date).alias("order_year"),
        F.month(order_date).alias("order_month"),
        F.dayofmonth(order_date).alias("order_day"),
        F.year(ship_date).alias("shipment_year"),
        F.month(ship_date).alias("shipment_month"),
        F.dayofmonth(ship_date).alias("shipment_day"),
        (F.substring("o_orderpriority", 1, 1).cast("int") * 2).alias("scheduled_days"),
        F.col("l_quantity").alias("qty"),
        sales.alias("sales"),
        profit.cast("decimal(18,4)").alias("profit"),
        F.col("l_discount").cast("string").alias("discount_text"),
    )


def raw_inventory(spark: SparkSession, sf_dir: str, tasks: int = 1) -> DataFrame:
    """Monthly stock per product: returned quantity per ship month as stock; ``tasks`` as in ``raw_orders``."""
    li = scan(spark, sf_dir, "lineitem", "l_partkey", "l_quantity", "l_tax", "l_returnflag", "l_shipdate")
    pt = scan(spark, sf_dir, "part", "p_partkey", "p_retailprice")
    ym = (F.year("l_shipdate") * 100 + F.month("l_shipdate")).cast("int")
    # A product has few lines a month: its lines are sent to it as they are and sorted there (the sort spills), so there is no table of
    # all months in memory, and the joins and aggregates by product that follow stay in the same partitioning and order.
    rows = by_key(li.select(F.col("l_partkey").alias("product_id"), ym.alias("year_month"), "l_tax",
                            F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0.0).alias("returned")), "product_id", tasks)
    month = Window.partitionBy("product_id", "year_month")
    per_month = (rows.withColumn("inventory", F.sum("returned").over(month)).withColumn("_tax", F.max("l_tax").over(month))
                 .withColumn("_n", F.row_number().over(month.orderBy("year_month"))).filter("_n = 1"))
    return (per_month.join(pt, per_month.product_id == pt.p_partkey)
            .select("product_id", "year_month", "inventory",
                    (F.col("p_retailprice") * (F.lit(1.0) + F.col("_tax"))).alias("unit_cost")))


def fulfillment(spark: SparkSession, sf_dir: str) -> DataFrame:
    pt = scan(spark, sf_dir, "part", "p_partkey", "p_size")
    return pt.select(F.col("p_partkey").alias("product_id"),
                     (F.col("p_size") / F.lit(5.0)).alias("fulfillment_days"))


def products(spark: SparkSession, sf_dir: str, inventory: DataFrame | None = None) -> DataFrame:
    """Product master: stock levels from part, current stock = latest month's inventory.

    Which suppliers deliver a product is a table of pairs (``product_suppliers``)."""
    pt = scan(spark, sf_dir, "part", "p_partkey", "p_name", "p_type", "p_size", "p_retailprice")
    inv = inventory if inventory is not None else raw_inventory(spark, sf_dir)
    latest = inv.groupBy("product_id").agg(
        F.max_by(F.col("inventory"), F.struct(F.col("year_month"), -F.col("inventory"))).alias("current_stock"))
    return (pt.select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name"),
                      F.col("p_type").alias("category"),
                      F.col("p_size").alias("min_stock_level"),
                      (F.col("p_size") * 5).alias("max_stock_level"),
                      (F.col("p_retailprice") / 20.0).alias("unit_cost"),
                      F.col("p_size").alias("lead_time"))
            .join(latest, "product_id", "left")
            .withColumn("current_stock", F.coalesce(F.col("current_stock"), F.lit(0.0)).cast("long")))


def product_suppliers(spark: SparkSession, sf_dir: str, tasks: int = 1) -> DataFrame:
    """(product_id, supplier_id): the distinct pairs seen on order lines, one row each; ``tasks`` as in ``raw_orders``."""
    li = scan(spark, sf_dir, "lineitem", "l_partkey", "l_suppkey")
    pairs = li.where("l_partkey is not null and l_suppkey is not null").select(
        F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("supplier_id"))
    # by product alone, so that what is chosen among a product's suppliers needs no shuffle of its own
    return by_key(pairs, "product_id", tasks).distinct()


def suppliers(spark: SparkSession, sf_dir: str, orders: DataFrame) -> DataFrame:
    """Supplier master: reliability = 1 - share of its lines delivered late.

    ``orders`` are standardized order lines with a ``late`` flag."""
    sp = scan(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey")
    rel = orders.groupBy("supplier_id").agg((F.lit(1.0) - F.avg(F.col("late").cast("double")))
                                            .alias("reliability_score"))
    tiers = F.element_at(F.array(*[F.lit(t) for t in TIERS]), (F.col("s_nationkey") % 4 + 1).cast("int"))
    return (sp.select(F.col("s_suppkey").alias("supplier_id"), F.col("s_name").alias("name"),
                      (F.col("s_suppkey") % 30 + 1).cast("int").alias("lead_time_days"),
                      tiers.alias("pricing_tier"))
            .join(rel, "supplier_id", "left")
            .withColumn("reliability_score", F.coalesce("reliability_score", F.lit(0.0))))


def stock_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inventory-update messages: product = user_id, stock = floor(value),
    order id from ``props``; ``error`` events carry no product id (invalid)."""
    ev = scan(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value", "props")
    return ev.select(
        "event_id", "ts",
        F.when(F.col("event_type") != "error", F.col("user_id")).alias("product_id"),
        F.floor("value").cast("double").alias("stock"),
        F.get_json_object("props", "$.k").cast("long").alias("order_id"),
        "event_type")


def model_scores(policy: DataFrame) -> DataFrame:
    """Stand-in model scores per product (FIXTURES v_pred): demand = mean line quantity,
    stockout risk = 0.9 * stockout frequency + 0.05, priority = priority score."""
    return policy.select("product_id", F.col("qty_mean").alias("demand_pred"),
                         (F.lit(0.9) * F.col("stockout_frequency") + F.lit(0.05)).alias("risk_pred"),
                         F.col("priority_score").alias("priority_pred"))


def supplier_offers(candidates: DataFrame) -> DataFrame:
    """Stand-in supplier counter-offers (FIXTURES v_offers): price * (1 - (product_id % 8) / 100)."""
    from decimal import Decimal
    return candidates.select(
        "order_id",
        (F.col("original_price") * (F.lit(1) - (F.col("product_id") % 8) * F.lit(Decimal("0.01"))))
        .cast("decimal(18,4)").alias("offer_price"))


def status_decisions(table: DataFrame, key: str) -> DataFrame:
    """Stand-in approve/cancel decisions (FIXTURES v_decisions): product_id % 3 = 0 approve,
    1 cancel, 2 no decision."""
    m = F.col("product_id") % 3
    return (table.select(key, F.when(m == 0, "approved").when(m == 1, "cancelled").alias("new_status"))
            .filter(F.col("new_status").isNotNull()))


def supplier_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes per (product, supplier): the mean unit price that supplier charged on its order lines."""
    li = scan(spark, sf_dir, "lineitem", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")
    return (li.groupBy(F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("supplier_id"))
            .agg(ratio(F.sum(F.col("l_extendedprice").cast("decimal(12,2)")).cast("double"), F.sum("l_quantity"))
                 .alias("quote_price")))
