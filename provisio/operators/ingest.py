"""Ingestion: column clean-up, typing, required-column checks (IO2, IO3, P1-P3, Q13)."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Required columns per source (declared in the reference's configuration).
REQUIRED_COLUMNS = {
    "orders": ["order_id", "product_id", "department", "order_year", "order_month", "order_day",
               "shipment_year", "shipment_month", "shipment_day", "scheduled_days", "qty",
               "sales", "profit", "discount_text"],
    "inventory": ["product_id", "year_month", "inventory", "unit_cost"],
    "fulfillment": ["product_id", "fulfillment_days"],
}


class MissingColumnsError(ValueError):
    pass


def clean_columns(df: DataFrame) -> DataFrame:
    """Strip surrounding whitespace from every column name (IO2)."""
    return df.toDF(*[c.strip() for c in df.columns])


def require_columns(df: DataFrame, required: Iterable[str], source: str = "input") -> DataFrame:
    """Fail fast when a required column is absent (IO3, Q13). Schema-only: no job runs."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise MissingColumnsError(f"{source}: missing required columns {missing}")
    return df


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def _date_from_parts(y, m, d):
    # NULL for an impossible date (e.g. 30 February) instead of failing the whole table
    return F.to_date(F.try_make_timestamp_ntz(y, m, d, F.lit(0), F.lit(0), F.lit(0)))


def standardize_orders(raw: DataFrame) -> DataFrame:
    """Dates from year/month/day ints (P1) and discount text -> double.

    Deviation from the reference (which drops the whole date column when one
    row is bad): a bad row gets a NULL date; ``date_rejects`` counts them.
    """
    raw = require_columns(clean_columns(raw), REQUIRED_COLUMNS["orders"], "orders")
    return (raw
            .withColumn("order_date", _date_from_parts(F.col("order_year"), F.col("order_month"),
                                                       F.col("order_day")))
            .withColumn("shipment_date", _date_from_parts(F.col("shipment_year"), F.col("shipment_month"),
                                                          F.col("shipment_day")))
            .withColumn("discount", F.expr("try_cast(trim(discount_text) as double)"))
            .drop("order_year", "order_month", "order_day", "shipment_year", "shipment_month",
                  "shipment_day", "discount_text"))


def standardize_inventory(raw: DataFrame) -> DataFrame:
    """yyyymm int -> first day of that month (P3); unparseable -> NULL."""
    raw = require_columns(clean_columns(raw), REQUIRED_COLUMNS["inventory"], "inventory")
    return raw.withColumn(
        "month_date",
        F.to_date(F.try_to_timestamp(F.col("year_month").cast("string"), F.lit("yyyyMM"))))


def date_rejects(orders: DataFrame) -> DataFrame:
    """Rows whose order or shipment date could not be built, and bad discounts."""
    return orders.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("order_date").isNull()).alias("bad_order_dates"),
        F.count_if(F.col("shipment_date").isNull()).alias("bad_shipment_dates"),
        F.count_if(F.col("discount").isNull()).alias("bad_discounts"))
