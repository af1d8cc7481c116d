"""Registered queries: reporting measures over the star."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.calendar import dim_date
from ..functions.keys import date_key
from ..operators.bucketed import write_bucketed
from ..operators.measures import share_levels, share_of_total, shifted, star_rollup, year_to_date
from ..session import scratch_path
from .inputs import MONTHLY_SQL, dk_sql, monthly_revenue, table
from .reconcile import CAL_SQL, calendar_years
from .registry import query

STAR_SQL = f"""with {CAL_SQL},
dim as (select {dk_sql('date_day')} as date_key, cast(year(date_day) as integer) as year,
  cast(month(date_day) as integer) as month, left(monthname(date_day), 3) as month_name from cal),
f as (select {dk_sql('l_shipdate')} as date_key, cast(l_extendedprice as decimal(18,2)) as amount
  from lineitem)
select year, month, month_name, cast(sum(amount) as decimal(18,2)) as revenue,
  count(*) as n_lines
from f join dim using (date_key) group by 1, 2, 3"""


@query("star_rollup", STAR_SQL, "K6 B5 F3")
def q_star_rollup(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    fact = li.select(date_key("l_shipdate").alias("date_key"),
                     F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"))
    dim = dim_date(calendar_years(spark, sf_dir))
    return star_rollup(fact, dim, "date_key", ["year", "month", "month_name"],
                       {"revenue": F.sum("amount").cast("decimal(18,2)"),
                        "n_lines": F.count(F.lit(1))})


FACT_JOIN_SQL = """select o_orderpriority as priority, cast(year(l_shipdate) as integer) as year, count(*) as n_lines,
  cast(sum(cast(l_extendedprice as decimal(18,2))) as decimal(18,2)) as revenue
from lineitem join orders on o_orderkey = l_orderkey group by 1, 2"""

FACT_BUCKET_ROWS = 50_000  # rows of the larger table in a bucket, about


@query("bucketed_join", FACT_JOIN_SQL, "K1 K6")
def q_bucketed_join(spark, sf_dir):
    """Line items and orders published bucketed by the order key: joined bucket by
    bucket, without an exchange on either side."""
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("bigint").alias("orderkey"), F.year("l_shipdate").alias("year"),
                                                 F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"))
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("bigint").alias("orderkey"),
                                              F.col("o_orderpriority").alias("priority"))
    buckets = max(4, -(-table(spark, sf_dir, "lineitem").count() // FACT_BUCKET_ROWS))
    fact, dim = (write_bucketed(d, scratch_path(spark, n), ["orderkey"], buckets) for d, n in ((li, "fact"), (o, "orders")))
    return fact.join(dim, "orderkey").groupBy("priority", "year").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("amount").cast("decimal(18,2)").alias("revenue"))


SHARE_SQL = """with rev as (
  select r_name as region, n_name as nation,
    cast(sum(cast(l_extendedprice as decimal(18,2))) as decimal(18,2)) as revenue
  from lineitem join orders on o_orderkey = l_orderkey join customer on c_custkey = o_custkey
  join nation on n_nationkey = c_nationkey join region on r_regionkey = n_regionkey
  group by 1, 2)
select region, nation, revenue,
  cast(round(revenue / sum(revenue) over (), 6) as decimal(18,6)) as share_of_total,
  cast(round(revenue / sum(revenue) over (partition by region), 6) as decimal(18,6)) as share_of_region
from rev"""


@query("share_of_total", SHARE_SQL, "B6 K6")
def q_share_of_total(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_extendedprice")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    # Pre-aggregate before every join: lineitem per order (partial aggregate,
    # its shuffle on the order key also serves the join with orders), then per
    # customer, then per nation; the dimension joins only see small frames.
    per_order = li.groupBy("l_orderkey").agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("rev"))
    per_cust = (per_order.join(o, per_order.l_orderkey == o.o_orderkey)
                .groupBy("o_custkey").agg(F.sum("rev").alias("rev")))
    per_nation = (per_cust.join(c, per_cust.o_custkey == c.c_custkey)
                  .groupBy("c_nationkey").agg(F.sum("rev").alias("rev")))
    geo = n.join(r, n.n_regionkey == r.r_regionkey).select(
        "n_nationkey", F.col("r_name").alias("region"), F.col("n_name").alias("nation"))
    rev = (per_nation.join(geo, per_nation.c_nationkey == geo.n_nationkey)
           .select("region", "nation", F.col("rev").cast("decimal(18,2)").alias("revenue")))
    # One row per nation: both totals come from windows over this small frame.
    out = share_of_total(rev, "revenue", "share_of_total", small=True)
    out = share_of_total(out, "revenue", "share_of_region", within=["region"], small=True)
    return out.select("region", "nation", "revenue",
                      F.col("share_of_total").cast("decimal(18,6)").alias("share_of_total"),
                      F.col("share_of_region").cast("decimal(18,6)").alias("share_of_region"))


SHARE_LEVELS_SQL = """with r as (
  select r_name as region, n_name as nation, nullif(c_mktsegment, 'MACHINERY') as segment, o_orderstatus = 'F' as picked,
    cast(o_totalprice as decimal(18,2)) as v
  from orders join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey
  join region on r_regionkey = n_regionkey),
g as (select region, nation, segment, sum(v) filter (picked) as revenue, sum(v) as total from r group by 1, 2, 3),
s as (select *,
    revenue / sum(total) over () as a0, revenue / sum(revenue) over () as b0,
    revenue / sum(total) over (partition by region) as a1, revenue / sum(revenue) over (partition by region) as b1,
    revenue / sum(total) over (partition by region, nation) as a2,
    revenue / sum(revenue) over (partition by region, nation) as b2,
    revenue / sum(total) over (partition by segment) as a3, revenue / sum(revenue) over (partition by segment) as b3
  from g)
select region, nation, segment, cast(revenue as decimal(18,2)) as revenue,
""" + ",\n".join(f"  cast(round({c}, 6) as decimal(18,6)) as {n}" for c, n in (
    ("a0", "share_all"), ("b0", "selected_all"), ("a1", "share_region"), ("b1", "selected_region"),
    ("a2", "share_nation"), ("b2", "selected_nation"), ("a3", "share_segment"), ("b3", "selected_segment"),
)) + "\nfrom s where revenue is not null"


@query("share_levels", SHARE_LEVELS_SQL, "B6 K6")
def q_share_levels(spark, sf_dir):
    """Finished orders per region, nation and market segment (one of them unknown):
    shares of the total, region, nation and segment, of all orders and of the
    finished ones, in one pass over the orders."""
    o = table(spark, sf_dir, "orders").groupBy("o_custkey", (F.col("o_orderstatus") == "F").alias("picked")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("revenue"))
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", F.nullif(
        F.col("c_mktsegment"), F.lit("MACHINERY")).alias("segment"))
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    geo = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", F.col("r_name").alias("region"), F.col("n_name").alias("nation"))
    rows = o.join(c, o.o_custkey == c.c_custkey).join(geo, F.col("c_nationkey") == F.col("n_nationkey"))
    out = share_levels(rows, ["region", "nation", "segment"], "revenue",
                       {"all": [], "region": ["region"], "nation": ["region", "nation"], "segment": ["segment"]}, F.col("picked"))
    shares = [x for x in out.columns if x.startswith(("share_", "selected_"))]
    return out.withColumns({"revenue": F.col("revenue").cast("decimal(18,2)"),
                            **{x: F.col(x).cast("decimal(18,6)") for x in shares}})


TIME_INTEL_SQL = f"""with {MONTHLY_SQL},
m as (select period_date, cast(year(period_date) as integer) as year,
  cast(month(period_date) as integer) as month, monthly_revenue from monthly)
select a.period_date, a.monthly_revenue,
  cast(sum(a.monthly_revenue) over (partition by a.year order by a.month
    rows between unbounded preceding and current row) as decimal(18,2)) as ytd_revenue,
  b.monthly_revenue as prior_year_revenue,
  cast(round((a.monthly_revenue / nullif(b.monthly_revenue, 0) - 1) * 100, 4) as decimal(18,4)) as yoy_pct
from m a left join m b on b.year = a.year - 1 and b.month = a.month"""


@query("time_intelligence", TIME_INTEL_SQL, "B7")
def q_time_intelligence(spark, sf_dir):
    m = monthly_revenue(spark, sf_dir).select(
        "period_date", F.year("period_date").alias("year"), F.month("period_date").alias("month"),
        "monthly_revenue")
    y = year_to_date(m, "year", "month", "monthly_revenue", "ytd_revenue")
    p = shifted(y, ["month"], "year", 1, "monthly_revenue", "prior_year_revenue")
    return p.select(
        "period_date", "monthly_revenue", F.col("ytd_revenue").cast("decimal(18,2)").alias("ytd_revenue"),
        "prior_year_revenue",
        F.round((F.col("monthly_revenue") / F.nullif(F.col("prior_year_revenue"), F.lit(0)) - 1) * 100, 4)
        .cast("decimal(18,4)").alias("yoy_pct"))


GROWTH_YEARS = 5  # the data spans 1995-2001, so a 5-year horizon (20 in the reference)

LONG_GROWTH_SQL = f"""with a as (select o_orderpriority as priority, cast(year(o_orderdate) as integer) as year,
  cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(18,2)) as order_value
  from orders group by 1, 2)
select a.priority, a.year, a.order_value, b.order_value as order_value_base,
  cast(round(a.order_value / nullif(b.order_value, 0) - 1, 6) as decimal(18,6)) as growth
from a left join a b on b.priority = a.priority and b.year = a.year - {GROWTH_YEARS}"""


@query("long_growth", LONG_GROWTH_SQL, "B4")
def q_long_growth(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    a = o.groupBy(F.col("o_orderpriority").alias("priority"),
                  F.year("o_orderdate").alias("year")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(18,2)").alias("order_value"))
    g = shifted(a, ["priority"], "year", GROWTH_YEARS, "order_value", "order_value_base")
    return g.select("priority", "year", "order_value", "order_value_base",
                    F.round(F.col("order_value") / F.nullif(F.col("order_value_base"), F.lit(0)) - 1, 6)
                    .cast("decimal(18,6)").alias("growth"))
