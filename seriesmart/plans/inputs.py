"""Derived inputs over the driver tables, shared by the registered queries.

Each helper reads the parquet tables (column pruning and filters reach the
scan) and returns a lazy DataFrame; the SQL twin of each is kept next to it so
the oracle text stays in step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# The base price series `px` (date d, series k, price p), one row per (d, k).
PX_SQL = ("px as (select cast(o_orderdate as date) as d, o_orderpriority as k, "
          "cast(max(o_totalprice) as decimal(18,6)) as p from orders group by 1, 2)")


def px(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return (o.groupBy(F.col("o_orderdate").cast("date").alias("d"),
                      F.col("o_orderpriority").alias("k"))
            .agg(F.max("o_totalprice").cast("decimal(18,6)").alias("p")))


# Series codes used as the two anchors (the reference's USD and EUR roles).
ANCHORS = {"1-URGENT": "usd", "2-HIGH": "eur"}
PIVOT_NAMES = {"1-URGENT": "p_urgent", "2-HIGH": "p_high", "3-MEDIUM": "p_medium",
               "4-NOT SPECIFIED": "p_not_specified", "5-LOW": "p_low"}

MONTHLY_SQL = ("monthly as (select cast(date_trunc('month', l_shipdate) as date) as period_date, "
               "cast(sum(cast(l_extendedprice as decimal(18,2))) as decimal(18,2)) as monthly_revenue "
               "from lineitem group by 1)")


def monthly_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly feed: shipped revenue per month (exact decimal sums)."""
    li = table(spark, sf_dir, "lineitem")
    return (li.groupBy(F.trunc(F.col("l_shipdate").cast("date"), "month").alias("period_date"))
            .agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)"))
                 .cast("decimal(18,2)").alias("monthly_revenue")))


ANNUAL_SQL = ("annual as (select cast(date_trunc('year', o_orderdate) as date) as year_date, "
              "cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(18,2)) as annual_order_value "
              "from orders group by 1)")


def annual_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annual feed: order value per year."""
    o = table(spark, sf_dir, "orders")
    return (o.groupBy(F.trunc(F.col("o_orderdate").cast("date"), "year").alias("year_date"))
            .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)"))
                 .cast("decimal(18,2)").alias("annual_order_value")))


def sk_sql(*cols: str) -> str:
    """SQL text of the surrogate-key expression (F6) for the oracle."""
    from ..functions.keys import SURROGATE_NULL, SURROGATE_SEPARATOR
    parts = ", ".join(f"coalesce(cast({c} as varchar), '{SURROGATE_NULL}')" for c in cols)
    return f"md5(concat_ws('{SURROGATE_SEPARATOR}', {parts}))"


def dk_sql(col: str) -> str:
    """SQL text of the integer date key."""
    return f"cast(strftime({col}, '%Y%m%d') as integer)"
