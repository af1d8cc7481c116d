"""Registered queries: CDC upsert (C1-C3, K4, M17) and SCD2 history."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import functions as F

from ..operators.merge import read_table
from ..operators.nested import parse_documents
from ..operators.scd2 import publish_history, scd2_replay
from ..session import scratch_path
from ..streaming.cdc import start_cdc
from .inputs import table
from .landing import _events_json, decode_events
from .registry import query

# --- CDC -------------------------------------------------------------------

CDC_BATCHES = 10
CDC_BUCKET_ROWS = 20_000  # target rows per hash bucket: a batch rewrites only the buckets that it touches

CDC_SQL = """select event_id, ts, user_id, event_type, value, props from events
qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1"""


def cdc_buckets(events, keys=("user_id", "event_type")) -> int:
    """Hash buckets for a table with one row for each key of these events, about counted."""
    rows = events.agg(F.approx_count_distinct(F.struct(*keys))).first()[0]
    return max(8, -(-rows // CDC_BUCKET_ROWS))


def land_batches(events, land: str) -> None:
    """The events as ten batches of files. The rebalance sizes files by bytes: a
    batch has as many as its bytes need, not one from every task that read the table."""
    (events.select((F.col("event_id") % CDC_BATCHES).alias("batch"), _events_json().alias("value"))
     .hint("rebalance", "batch").write.partitionBy("batch").text(land))


def decode_stream(raw, buckets: int = 8):
    d = decode_events(parse_documents(raw))
    return d.withColumn("bucket", F.pmod(F.col("user_id"), F.lit(buckets)))


@query("cdc_upsert", CDC_SQL, "C1 C2 C3 K4 S13 M17")
def q_cdc_upsert(spark, sf_dir):
    """Land the events as ten batches of files, stream them into a versioned
    table keyed by (user_id, event_type), then run the stream again: nothing
    new, no batch. The table must equal the latest event per key."""
    land, target, ckpt = (scratch_path(spark, n) for n in ("cdc-landing", "cdc-target", "cdc-ckpt"))
    ev = table(spark, sf_dir, "events")
    decode = partial(decode_stream, buckets=cdc_buckets(ev))
    land_batches(ev, land)
    for _ in range(2):
        q = start_cdc(spark, land, target, ckpt, decode, ["user_id", "event_type"],
                      ["ts", "event_id"], "bucket", max_files_per_trigger=3)
        q.awaitTermination()
        if q.exception():
            raise q.exception()
    return read_table(spark, target).select("event_id", "ts", "user_id", "event_type", "value",
                                            "props")


# --- SCD2 ------------------------------------------------------------------

RUNS = {1: "2026-01-01 06:00:00", 2: "2026-01-02 06:00:00",
        3: "2026-01-03 06:00:00", 4: "2026-01-04 06:00:00"}


def snapshot(spark, sf_dir, r: int):
    """State of the orders as published by run ``r``: run 2 revises urgent
    orders, run 4 revises urgent and high ones; run 3 withdraws low-priority
    orders (they return in run 4), run 4 withdraws pending ones."""
    o = table(spark, sf_dir, "orders")
    status = F.col("o_orderstatus")
    if r >= 2:
        status = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("X")).otherwise(status)
    if r >= 4:
        status = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.lit("Y")).otherwise(status)
    if r == 3:
        o = o.filter(F.col("o_orderpriority") != "5-LOW")
    if r == 4:
        o = o.filter(F.col("o_orderstatus") != "P")
    return o.select("o_orderkey", status.alias("status"),
                    F.col("o_totalprice").cast("decimal(18,2)").alias("amount"))


def _islands_sql(last_run: int) -> str:
    runs = ", ".join(f"({r}, timestamp '{ts}')" for r, ts in RUNS.items())
    return f"""with runs(r, run_ts) as (values {runs}),
snaps as (select o_orderkey,
    case when r >= 4 and o_orderpriority in ('1-URGENT', '2-HIGH') then 'Y'
         when r >= 2 and o_orderpriority = '1-URGENT' then 'X' else o_orderstatus end as status,
    cast(o_totalprice as decimal(18,2)) as amount, r
  from orders, runs
  where r <= {last_run} and not (r = 3 and o_orderpriority = '5-LOW')
    and not (r = 4 and o_orderstatus = 'P')),
x as (select *, lag(r) over (partition by o_orderkey order by r) as pr,
         lag(status) over (partition by o_orderkey order by r) as ps from snaps),
y as (select *, sum(case when pr is null or pr <> r - 1 or ps is distinct from status then 1 else 0 end)
         over (partition by o_orderkey order by r rows between unbounded preceding and current row) as isl
      from x),
g as (select o_orderkey, isl, min(r) as f, max(r) as l, arg_min(status, r) as status,
         arg_min(amount, r) as amount from y group by 1, 2)
select g.o_orderkey, g.status, g.amount, rf.run_ts as valid_from, rt.run_ts as valid_to
from g join runs rf on rf.r = g.f left join runs rt on rt.r = g.l + 1 and rt.r <= {last_run}"""


def _chain(spark, sf_dir, last_run: int):
    """The stored history after each run: open rows rewritten, closed ones added."""
    root, history = scratch_path(spark, "order-history"), None
    for r in range(1, last_run + 1):
        _, history = publish_history(spark, root, snapshot(spark, sf_dir, r), ["o_orderkey"], ["status"], RUNS[r],
                                     keep=["amount"])
    return history


@query("scd2_single", _islands_sql(2), "C4")
def q_scd2_single(spark, sf_dir):
    return _chain(spark, sf_dir, 2)


@query("scd2_deletes", _islands_sql(3), "C4 C5")
def q_scd2_deletes(spark, sf_dir):
    return _chain(spark, sf_dir, 3)


@query("scd2_replay", _islands_sql(4), "C6 C4 C5 M18")
def q_scd2_replay(spark, sf_dir):
    snaps = [snapshot(spark, sf_dir, r).withColumn("run_ts", F.lit(ts).cast("timestamp_ntz"))
             for r, ts in RUNS.items()]
    runs = spark.createDataFrame([(ts,) for ts in RUNS.values()], "run_ts string").select(
        F.col("run_ts").cast("timestamp_ntz").alias("run_ts"))
    return scd2_replay(reduce(lambda a, b: a.unionByName(b), snaps), ["o_orderkey"], ["status"],
                       runs=runs)
