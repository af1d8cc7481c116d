"""Registered queries: as-of reconciliation onto a daily spine."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.calendar import bounded_spine, date_bounds, dim_date, spine_between
from ..functions.keys import date_key
from ..operators.asof import asof_join, multi_asof
from ..operators.pivot import pivot_series
from .inputs import (ANCHORS, ANNUAL_SQL, MONTHLY_SQL, PX_SQL, annual_orders, dk_sql,
                     monthly_revenue, px, table)
from .registry import query

_URGENT, _HIGH = list(ANCHORS)

# Calendar bounds: 1 January of the first order year up to, excluding,
# 1 January after the last ship year (the reference hard-codes 2000-2026, T12).
CAL_SQL = ("cal as (select cast(unnest(generate_series(b.s, b.e - interval 1 day, interval 1 day)) "
           "as date) as date_day from (select (select cast(date_trunc('year', min(o_orderdate)) as date) "
           "from orders) as s, (select cast(date_trunc('year', max(l_shipdate)) as date) + interval 1 year "
           "from lineitem) as e) b)")


def calendar_years(spark, sf_dir):
    """D1 with data-derived bounds: whole years covering orders and shipments.

    Both bounds come from one aggregate over a union of the two date columns
    (partial aggregates on each side, no join)."""
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").cast("date").alias("d"), F.lit(True).alias("is_order"))
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("d"), F.lit(False).alias("is_order"))
    b = o.unionByName(li).agg(
        F.trunc(F.min(F.when(F.col("is_order"), F.col("d"))), "year").alias("s"),
        F.add_months(F.trunc(F.max(F.when(~F.col("is_order"), F.col("d"))), "year"), 12).alias("e"))
    return b.select(F.explode(F.when(F.col("e") > F.col("s"), F.sequence(
        "s", F.date_sub("e", 1), F.expr("interval 1 day")))).alias("date_day"))


SPINE_SQL = ("spine as (select cast(unnest(generate_series(b.s, b.e, interval 1 day)) as date) "
             "as market_date from (select min(d) as s, max(d) as e from px) b)")


def market_spine(spark, sf_dir):
    """D3: every day between the first and last date of the daily feed."""
    p = px(spark, sf_dir)
    return spine_between(date_bounds(p, "d"), "start_date", "end_date", "market_date")


ASOF_SINGLE_SQL = f"""with {PX_SQL}, {SPINE_SQL},
feed as (select d as rate_date, p as usd_pln from px where k = '{_URGENT}')
select {dk_sql('market_date')} as date_key, market_date, rate_date, usd_pln
from spine asof left join feed on spine.market_date >= feed.rate_date"""


@query("asof_single", ASOF_SINGLE_SQL, "K3 K2 D3")
def q_asof_single(spark, sf_dir):
    feed = (px(spark, sf_dir).filter(F.col("k") == _URGENT)
            .select(F.col("d").alias("rate_date"), F.col("p").alias("usd_pln")))
    spine = market_spine(spark, sf_dir)
    out = asof_join(spine, feed, "market_date", "rate_date", left_unique=True)
    return out.select(date_key("market_date").alias("date_key"), "market_date",
                      "rate_date", "usd_pln")


# A (user, day) group above this many rows is cut into time slices.
KEYED_SLICE_ROWS = 200_000

ASOF_KEYED_SQL = """with p as (select event_id, user_id, ts, value from events where event_type = 'purchase'),
c as (select user_id, event_id as click_event_id, ts as click_ts, value as click_value
      from events where event_type = 'click')
select p.event_id, p.user_id, p.ts, p.value, c.click_event_id, c.click_ts, c.click_value
from p asof left join c on p.user_id = c.user_id and p.ts >= c.click_ts"""


@query("asof_keyed", ASOF_KEYED_SQL, "K3")
def q_asof_keyed(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    p = ev.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "ts", "value")
    c = ev.filter(F.col("event_type") == "click").select(
        "user_id", F.col("event_id").alias("click_event_id"), F.col("ts").alias("click_ts"),
        F.col("value").alias("click_value"))
    # Monthly buckets: any (user, month) above KEYED_SLICE_ROWS is sliced.
    return asof_join(p, c, "ts", "click_ts", by=["user_id"], bucket="month",
                     tie_break=["click_event_id"], slice_rows=KEYED_SLICE_ROWS)


def daily_anchors(spark, sf_dir):
    p = px(spark, sf_dir)
    return pivot_series(p, "d", "k", "p", {_URGENT: "usd_pln", _HIGH: "eur_pln"}).withColumnRenamed(
        "d", "rate_date")


ASOF_MULTI_SQL = f"""with {PX_SQL}, {SPINE_SQL}, {MONTHLY_SQL}, {ANNUAL_SQL},
fx as (select d as rate_date,
  max(case when k = '{_URGENT}' then p end) as usd_pln,
  max(case when k = '{_HIGH}' then p end) as eur_pln from px group by d)
select {dk_sql('spine.market_date')} as date_key, spine.market_date, fx.usd_pln, fx.eur_pln,
  monthly.monthly_revenue, annual.annual_order_value
from spine
asof left join fx on spine.market_date >= fx.rate_date
asof left join monthly on spine.market_date >= monthly.period_date
asof left join annual on spine.market_date >= annual.year_date"""


def market_signals(spark, sf_dir):
    """The wide daily mart; daily, monthly and annual feeds as of each day."""
    spine = market_spine(spark, sf_dir)
    feeds = {
        "fx": (daily_anchors(spark, sf_dir), "rate_date", ["usd_pln", "eur_pln"]),
        "monthly": (monthly_revenue(spark, sf_dir), "period_date", ["monthly_revenue"]),
        "annual": (annual_orders(spark, sf_dir), "year_date", ["annual_order_value"]),
    }
    out = multi_asof(spine, "market_date", feeds, bucket="month")
    return out.select(date_key("market_date").alias("date_key"), "market_date",
                      "usd_pln", "eur_pln", "monthly_revenue", "annual_order_value")


@query("asof_multi", ASOF_MULTI_SQL, "K3 K2 D3 A1 M16")
def q_asof_multi(spark, sf_dir):
    return market_signals(spark, sf_dir)


PRICE_SPREAD_SQL = f"""with {PX_SQL}, {SPINE_SQL},
fx as (select d as rate_date,
  max(case when k = '{_URGENT}' then p end) as usd_pln,
  max(case when k = '{_HIGH}' then p end) as eur_pln from px group by d)
select spine.market_date, fx.usd_pln - fx.eur_pln as spread
from spine asof left join fx on spine.market_date >= fx.rate_date"""


@query("price_spread", PRICE_SPREAD_SQL, "B1")
def q_price_spread(spark, sf_dir):
    spine = market_spine(spark, sf_dir)
    out = multi_asof(spine, "market_date",
                     {"fx": (daily_anchors(spark, sf_dir), "rate_date", ["usd_pln", "eur_pln"])})
    return out.select("market_date", (F.col("usd_pln") - F.col("eur_pln")).alias("spread"))


DATE_SPINE_BOUNDS_SQL = f"""with {PX_SQL}, {SPINE_SQL}
select {dk_sql('market_date')} as date_key, market_date from spine"""


@query("date_spine_bounds", DATE_SPINE_BOUNDS_SQL, "D3 K2 A2 P5")
def q_date_spine_bounds(spark, sf_dir):
    # Calendar over whole years of the orders, cut to the daily feed's range.
    cal = dim_date(calendar_years(spark, sf_dir))
    out = bounded_spine(cal, px(spark, sf_dir), "d")
    return out.select("date_key", F.col("full_date").alias("market_date"))


@query("asof_chained", ASOF_MULTI_SQL, "K3")
def q_asof_chained(spark, sf_dir):
    """The wide mart as three chained as-of joins (one sweep per feed), the
    plan ``multi_asof`` replaces; kept to compare the two."""
    spine = market_spine(spark, sf_dir)
    out = asof_join(spine, daily_anchors(spark, sf_dir), "market_date", "rate_date",
                    left_unique=True).drop("rate_date")
    out = asof_join(out, monthly_revenue(spark, sf_dir), "market_date", "period_date",
                    left_unique=True).drop("period_date")
    out = asof_join(out, annual_orders(spark, sf_dir), "market_date", "year_date",
                    left_unique=True).drop("year_date")
    return out.select(date_key("market_date").alias("date_key"), "market_date",
                      "usd_pln", "eur_pln", "monthly_revenue", "annual_order_value")


# Most rows of a time range of a hot as-of group (see operators.asof._sliced).
HOT_SLICE_ROWS = 500

ASOF_HOT_SQL = """with p as (select event_id, ts, value from events where event_type = 'purchase'),
c as (select event_id as click_event_id, ts as click_ts, value as click_value
      from events where event_type = 'click')
select p.event_id, p.ts, p.value, c.click_event_id, c.click_ts, c.click_value
from p asof left join c on p.ts >= c.click_ts"""


@query("asof_hot_bucket", ASOF_HOT_SQL, "K3")
def q_asof_hot_bucket(spark, sf_dir):
    """Keyless as-of of every purchase on the last click before it. All
    events fall into one monthly bucket, the hot-group case: the bucket is
    cut into ranges of at most HOT_SLICE_ROWS rows."""
    ev = table(spark, sf_dir, "events")
    p = ev.filter(F.col("event_type") == "purchase").select("event_id", "ts", "value")
    c = ev.filter(F.col("event_type") == "click").select(
        F.col("event_id").alias("click_event_id"), F.col("ts").alias("click_ts"),
        F.col("value").alias("click_value"))
    return asof_join(p, c, "ts", "click_ts", bucket="month", tie_break=["click_event_id"],
                     slice_rows=HOT_SLICE_ROWS)
