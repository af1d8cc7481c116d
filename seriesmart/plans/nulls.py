"""Registered queries over inputs with NULL keys, NULL times and ties.

The tables have none, so each query derives them by a stated rule on the row's
id. They pin that results do not depend on NULLs, on the layout or on row order.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.calendar import date_bounds, spine_between
from ..operators.asof import asof_join, multi_asof
from ..operators.measures import share_of_total
from ..operators.merge import read_table
from ..operators.quality import freshness
from ..operators.series import rebased, returns_and_rolling
from ..session import scratch_path
from ..streaming.cdc import start_cdc
from .history import decode_stream, land_batches
from .inputs import table
from .registry import query

_EV_SQL = """ev as (select event_id, case when event_id % 11 <> 0 then user_id end as user_id,
  case when event_id % 7 <> 0 then ts end as ts, event_type, value from events)"""


def _holed_events(spark, sf_dir):
    """Events of which every seventh lacks its time, every eleventh its user."""
    e = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        "event_id", F.when(e % 11 != 0, F.col("user_id")).alias("user_id"),
        F.when(e % 7 != 0, F.col("ts")).alias("ts"), "event_type", "value")


ASOF_NULL_SQL = f"""with {_EV_SQL},
p as (select event_id, user_id, ts, value from ev where event_type = 'purchase'),
c as (select user_id, event_id as click_event_id, ts as click_ts, value as click_value
      from ev where event_type = 'click' and user_id is not null and ts is not null)
select p.event_id, p.user_id, p.ts, p.value, c.click_event_id, c.click_ts, c.click_value
from p asof left join c on p.user_id = c.user_id and p.ts >= c.click_ts"""


@query("asof_null_times", ASOF_NULL_SQL, "K3")
def q_asof_null_times(spark, sf_dir):
    """NULL matches nothing, on either side, with the left row carried through."""
    ev = _holed_events(spark, sf_dir)
    p = ev.filter("event_type = 'purchase'").select("event_id", "user_id", "ts", "value")
    c = ev.filter("event_type = 'click'").select(
        "user_id", F.col("event_id").alias("click_event_id"), F.col("ts").alias("click_ts"),
        F.col("value").alias("click_value"))
    return asof_join(p, c, "ts", "click_ts", by=["user_id"], tie_break=["click_event_id"], left_unique=True)


ASOF_TIES_SQL = f"""with {_EV_SQL},
spine as (select cast(unnest(generate_series(b.s, b.e, interval 1 day)) as date) as market_date
  from (select min(cast(ts as date)) as s, max(cast(ts as date)) as e from ev) b),
clicks as (select cast(ts as date) as d, arg_max(value, event_id) as last_click
  from ev where event_type = 'click' and user_id = 7 and ts is not null group by 1),
buys as (select cast(ts as date) as d, max(value) as top_purchase
  from ev where event_type = 'purchase' and ts is not null group by 1)
select market_date, last_click, top_purchase from spine
asof left join clicks on spine.market_date >= clicks.d
asof left join buys on spine.market_date >= buys.d"""


@query("asof_multi_ties", ASOF_TIES_SQL, "K3 M16")
def q_asof_multi_ties(spark, sf_dir):
    """Feeds with many rows a day and rows without a date: one by its tie-break,
    one by its own values."""
    ev = _holed_events(spark, sf_dir).withColumn("d", F.col("ts").cast("date"))
    spine = spine_between(date_bounds(ev, "d"), "start_date", "end_date", "market_date")
    feeds = {
        "clicks": (ev.filter("event_type = 'click' and user_id = 7").withColumnRenamed("value", "last_click"),
                   "d", ["last_click"]),
        "buys": (ev.filter("event_type = 'purchase'").withColumnRenamed("value", "top_purchase"),
                 "d", ["top_purchase"]),
    }
    return multi_asof(spine, "market_date", feeds, tie_break={"clicks": ["event_id"]})


_HOLED_PX_SQL = """px as (select case when o_orderkey % 9 <> 0 then cast(o_orderdate as date) end as d,
  case when o_orderpriority <> '5-LOW' then o_orderpriority end as k,
  cast(max(o_totalprice) as decimal(18,6)) as p from orders group by 1, 2)"""


def _holed_px(spark, sf_dir):
    """The price series with the dates of every ninth order and one series key missing."""
    return (table(spark, sf_dir, "orders")
            .groupBy(F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderdate").cast("date")).alias("d"),
                     F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("k"))
            .agg(F.max("o_totalprice").cast("decimal(18,6)").alias("p")))


ROLLING_NULL_SQL = f"""with {_HOLED_PX_SQL}
select d as rate_date, k as currency_code, p as mid_rate,
  lag(p) over (partition by k order by d nulls first) as prev_mid_rate,
  cast(round(avg(p) over (partition by k order by d nulls first
    rows between 6 preceding and current row), 6) as decimal(18,6)) as ma_7d
from px"""


@query("rolling_null_keys", ROLLING_NULL_SQL, "W2 W3")
def q_rolling_null_keys(spark, sf_dir):
    """Chunked layout over a NULL series and NULL dates: the rows of the plain layout."""
    r = returns_and_rolling(_holed_px(spark, sf_dir), ["k"], "d", "p", halo_chunk=64)
    return r.select(F.col("d").alias("rate_date"), F.col("k").alias("currency_code"), F.col("p").alias("mid_rate"),
                    F.col("prev_value").alias("prev_mid_rate"),
                    F.round("ma_short", 6).cast("decimal(18,6)").alias("ma_7d"))


REBASED_NULL_SQL = f"""with {_HOLED_PX_SQL},
b as (select k, arg_min(p, d) as base from px group by k)
select px.d as rate_date, px.k as currency_code,
  cast(round(px.p / nullif(b.base, 0) * 100, 4) as decimal(18,4)) as rebased_index
from px join b on px.k is not distinct from b.k"""


@query("rebased_null_keys", REBASED_NULL_SQL, "W6 B2")
def q_rebased_null_keys(spark, sf_dir):
    r = rebased(_holed_px(spark, sf_dir), ["k"], "d", "p", "r")
    return r.select(F.col("d").alias("rate_date"), F.col("k").alias("currency_code"),
                    F.round("r", 4).cast("decimal(18,4)").alias("rebased_index"))


SHARE_NULL_SQL = """with g as (
  select case when r_name <> 'ASIA' then r_name end as region, n_name as nation,
    cast(sum(cast(c_acctbal as decimal(18,2))) as decimal(18,2)) as balance
  from customer join nation on n_nationkey = c_nationkey join region on r_regionkey = n_regionkey group by 1, 2)
select region, nation, balance, cast(round(balance / sum(balance) over (partition by region), 6) as decimal(18,6))
  as share_of_region from g"""


@query("share_null_parent", SHARE_NULL_SQL, "B6")
def q_share_null_parent(spark, sf_dir):
    """Nations without a region share their own total."""
    c, n, r = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    per_nation = c.groupBy("c_nationkey").agg(F.sum(F.col("c_acctbal").cast("decimal(18,2)")).alias("balance"))
    g = (per_nation.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
         .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
         .select(F.when(F.col("r_name") != "ASIA", F.col("r_name")).alias("region"),
                 F.col("n_name").alias("nation"), F.col("balance").cast("decimal(18,2)").alias("balance")))
    out = share_of_total(g, "balance", "share_of_region", within=["region"])
    return out.withColumn("share_of_region", F.col("share_of_region").cast("decimal(18,6)"))


CDC_NULL_SQL = """with ev as (select event_id, ts, case when event_id % 9 <> 0 then user_id end as user_id,
  event_type, value, props from events)
select * from ev
qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1"""


@query("cdc_null_keys", CDC_NULL_SQL, "C3 K4")
def q_cdc_null_keys(spark, sf_dir):
    """The upsert stream with documents that lack a user: they share the NULL
    partition, and every other partition stays readable."""
    land, target, ckpt = (scratch_path(spark, n) for n in ("cdc-null-landing", "cdc-null-target", "cdc-null-ckpt"))
    ev = table(spark, sf_dir, "events")
    ev = ev.withColumn("user_id", F.when(F.col("event_id") % 9 != 0, F.col("user_id")))
    land_batches(ev, land)
    q = start_cdc(spark, land, target, ckpt, decode_stream, ["user_id", "event_type"], ["ts", "event_id"],
                  "bucket", max_files_per_trigger=5)
    q.awaitTermination()
    return read_table(spark, target).select("event_id", "ts", "user_id", "event_type", "value", "props")


FRESH_RUN_TS = "2024-01-31 12:00:00"  # the check's own clock: 12 hours after the events end

FRESHNESS_SQL = f"""with g as (select c_custkey, max(ts) as max_loaded_at
  from customer left join events on user_id = c_custkey group by 1)
select c_custkey, cast(max_loaded_at as timestamp) as max_loaded_at,
  case when max_loaded_at is null then 'error'
    when max_loaded_at < timestamp '{FRESH_RUN_TS}' - interval 50 hour then 'error'
    when max_loaded_at < timestamp '{FRESH_RUN_TS}' - interval 26 hour then 'warn' else 'pass' end as status
from g"""


@query("freshness_all_customers", FRESHNESS_SQL, "Q6")
def q_freshness_all_customers(spark, sf_dir):
    """Freshness per customer over all customers: one that never had an event is an error."""
    c = table(spark, sf_dir, "customer").select("c_custkey")
    ev = table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp_ntz").alias("ts"))
    loads = c.join(ev, F.col("user_id") == F.col("c_custkey"), "left")
    return freshness(loads, "ts", FRESH_RUN_TS, by=["c_custkey"]).select("c_custkey", "max_loaded_at", "status")
