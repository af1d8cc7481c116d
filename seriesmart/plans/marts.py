"""Registered queries: calendar, dimensions, keys, conformed tall fact."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.calendar import dim_date
from ..functions.keys import date_key, pipe_key, surrogate_key
from ..functions.scalar import degree_days
from ..operators.conform import conform_tall
from ..operators.dedupe import latest_wins
from .inputs import MONTHLY_SQL, dk_sql, monthly_revenue, sk_sql, table
from .reconcile import CAL_SQL, calendar_years
from .registry import query

# Fixed values that must equal the reference's behaviour, re-aimed at the test
# data: codes flagged as major in the code dimension (the reference flags the
# eight major currencies), and the tall fact's tag values.
MAJOR_CODES = ("1-URGENT", "2-HIGH")

DATE_SPINE_SQL = f"""with {CAL_SQL}
select date_day from cal"""


@query("date_spine", DATE_SPINE_SQL, "D1")
def q_date_spine(spark, sf_dir):
    return calendar_years(spark, sf_dir)


DATE_ATTRIBUTES_SQL = f"""with {CAL_SQL}
select {dk_sql('date_day')} as date_key, date_day as full_date,
  cast(year(date_day) as integer) as year, cast(quarter(date_day) as integer) as quarter,
  cast(month(date_day) as integer) as month, left(monthname(date_day), 3) as month_name,
  cast(day(date_day) as integer) as day_of_month, left(dayname(date_day), 3) as day_name,
  left(dayname(date_day), 3) not in ('Sat', 'Sun') as is_weekday
from cal"""


@query("date_attributes", DATE_ATTRIBUTES_SQL, "D2 F3 F10 F11 P4 M8")
def q_date_attributes(spark, sf_dir):
    return dim_date(calendar_years(spark, sf_dir))


_majors = ", ".join(f"'{c}'" for c in MAJOR_CODES)
DIM_CURRENCY_SQL = f"""select o_custkey as currency_code, o_orderpriority as currency_name,
  o_orderpriority in ({_majors}) as is_major
from orders
qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1"""


@query("dim_currency", DIM_CURRENCY_SQL, "D4 A5 P4 M9")
def q_dim_currency(spark, sf_dir):
    """One row per code, the latest name (T19: a renamed code stays one row)."""
    o = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("currency_code"), F.col("o_orderpriority").alias("currency_name"),
        "o_orderdate", "o_orderkey")
    d = latest_wins(o, ["currency_code"], ["o_orderdate", "o_orderkey"])
    return d.select("currency_code", "currency_name",
                    F.col("currency_name").isin(*MAJOR_CODES).alias("is_major"))


FULFILLED_SQL = ("fulfilled as (select cast(date_trunc('year', o_orderdate) as date) as period_date, "
                 "cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(18,2)) as value "
                 "from orders where o_orderstatus = 'F' group by 1)")

TALL_UNION_SQL = f"""with {MONTHLY_SQL}, {FULFILLED_SQL},
combined as (
  select period_date, 'lineitem' as source_name, 'ALL' as geo, 'shipped_revenue' as indicator,
    'monthly' as frequency, monthly_revenue as value, 'usd' as unit from monthly
  union all
  select period_date, 'orders', 'ALL', 'fulfilled_order_value', 'annual', value, 'usd' from fulfilled)
select {sk_sql('period_date', 'source_name', 'indicator')} as activity_key,
  {dk_sql('period_date')} as date_key, period_date, source_name, geo, indicator, frequency,
  value, unit
from combined"""


def construction_activity(spark, sf_dir):
    m = monthly_revenue(spark, sf_dir).withColumnRenamed("monthly_revenue", "value")
    o = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")
    a = (o.groupBy(F.trunc(F.col("o_orderdate").cast("date"), "year").alias("period_date"))
         .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(18,2)").alias("value")))
    tall = conform_tall([
        (m, {"source_name": "lineitem", "geo": "ALL", "indicator": "shipped_revenue",
             "frequency": "monthly", "unit": "usd"}),
        (a, {"source_name": "orders", "geo": "ALL", "indicator": "fulfilled_order_value",
             "frequency": "annual", "unit": "usd"}),
    ])
    return tall.select(
        surrogate_key("period_date", "source_name", "indicator").alias("activity_key"),
        date_key("period_date").alias("date_key"), "period_date", "source_name", "geo",
        "indicator", "frequency", "value", "unit")


@query("tall_union", TALL_UNION_SQL, "U1 P2 P3 F6 M15")
def q_tall_union(spark, sf_dir):
    return construction_activity(spark, sf_dir)


TOP_K_SQL = f"""with {MONTHLY_SQL}
select period_date, monthly_revenue from monthly order by period_date desc limit 3"""


@query("top_k_latest", TOP_K_SQL, "L1")
def q_top_k_latest(spark, sf_dir):
    return monthly_revenue(spark, sf_dir).orderBy(F.col("period_date").desc()).limit(3)


SURROGATE_SQL = f"""with o as (select o_orderkey, cast(o_orderdate as date) as d,
  case when o_orderstatus = 'P' then null else o_orderpriority end as prio from orders)
select o_orderkey, md5(cast(d as varchar) || '|' || prio) as natural_key,
  {sk_sql('d', 'prio')} as order_sk, {dk_sql('d')} as date_key
from o"""


@query("surrogate_keys", SURROGATE_SQL, "F3 F4 F5 F6")
def q_surrogate_keys(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("d"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("prio"))
    return o.select("o_orderkey", pipe_key("d", "prio").alias("natural_key"),
                    surrogate_key("d", "prio").alias("order_sk"), date_key("d").alias("date_key"))


DEGREE_DAYS_SQL = """with w as (select c_custkey,
  case when c_mktsegment = 'HOUSEHOLD' then null
       else cast(c_acctbal as decimal(12,2)) * 0.01 end as temp_avg_c,
  case when c_mktsegment = 'AUTOMOBILE' then null
       else cast(c_acctbal as decimal(12,2)) * 0.001 end as precip_mm
  from customer)
select c_custkey, cast(temp_avg_c as decimal(12,4)) as temp_avg_c,
  cast(case when temp_avg_c is null then null else greatest(0, 18 - temp_avg_c) end as decimal(12,4))
    as heating_degree_days,
  precip_mm > 0 as is_rainy
from w"""


@query("degree_days", DEGREE_DAYS_SQL, "F9 P8 T1 M14")
def q_degree_days(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    bal = F.col("c_acctbal").cast("decimal(12,2)")
    w = c.select("c_custkey",
                 F.when(F.col("c_mktsegment") != "HOUSEHOLD", bal * F.lit(0.01).cast("decimal(3,2)"))
                 .alias("temp_avg_c"),
                 F.when(F.col("c_mktsegment") != "AUTOMOBILE", bal * F.lit(0.001).cast("decimal(4,3)"))
                 .alias("precip_mm"))
    return w.select("c_custkey", F.col("temp_avg_c").cast("decimal(12,4)").alias("temp_avg_c"),
                    degree_days("temp_avg_c", base=18).cast("decimal(12,4)").alias("heating_degree_days"),
                    (F.col("precip_mm") > 0).alias("is_rainy"))
