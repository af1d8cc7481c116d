"""Registered queries: the streamed FX table (C3, M17), stored index history (M18),
the returns model (M7), measures on the marts (B1, B5), distinct codes (A5), the
control table (S1-S3) and lineage (S8, F12)."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from ..operators.merge import read_table, table_state
from ..operators.nested import flatten, parse_documents, path
from ..operators.scd2 import publish_history
from ..session import scratch_path
from ..sources.control import enabled_sources, landing_plan, read_control
from ..sources.landing import incremental_load, read_documents, write_landing
from ..streaming.bronze_feed import start_bronze_feed
from ..streaming.cdc import start_cdc
from . import feeds
from .daily_marts import (CIVIL_STG_SQL, FX_STG_SQL, MARKET_SIGNALS_SQL, WEATHER_STG_SQL, _series_sql,
                          _window_sql, fx_bronze, fx_docs, market_signals_from_feeds, weather_bronze)
from .inputs import table
from .landing import EVENTS_DOCS, RUN_TS, _events_json
from .registry import query


def fx_rows(docs, load):
    """Table documents flattened on two levels, tables, then rates; ``load`` orders the loads."""
    tables = flatten(docs, "raw", "$", "t", keep=[load, "_src_file"])
    tables = tables.select(path("t", "$.effectiveDate", "date").alias("effective_date"), "t", load, "_src_file")
    rates = flatten(tables, "t", "$.rates", "r", keep=["effective_date", load, "_src_file"])
    return rates.select("effective_date", path("r", "$.code", "string").alias("currency_code"),
                        path("r", "$.currency", "string").alias("currency_name"),
                        path("r", "$.mid", "decimal(18,6)", strict=True).alias("mid_rate"), load, "_src_file",
                        F.date_format("effective_date", "yyyy-MM").alias("month"))


def decode_fx(raw):
    """The rates of a text stream of table documents."""
    return fx_rows(parse_documents(raw.withColumn(
        "load", F.regexp_extract("_src_file", r"/load=(\d+)/", 1).cast("int"))), "load")


def stream_fx(spark, land, target, ckpt):
    q = start_cdc(spark, land, target, ckpt, decode_fx, ["effective_date", "currency_code"], ["load", "_src_file"],
                  "month", max_files_per_trigger=20)
    q.awaitTermination()
    if q.exception():
        raise q.exception()


@query("cdc_fx_rates", f"with {FX_STG_SQL} select effective_date, currency_code, currency_name, mid_rate from stg_fx",
       "M17 C1 C2 C3 J4")
def q_cdc_fx_rates(spark, sf_dir):
    """Two loads of FX documents streamed into a table keyed by day and currency;
    the second load's batches rewrite the months that they touch."""
    land, target, ckpt = (scratch_path(spark, n) for n in ("cdc-fx-landing", "cdc-fx-target", "cdc-fx-ckpt"))
    for load, docs in enumerate(fx_docs(spark, sf_dir), 1):
        write_landing(docs.withColumn("load", F.lit(load)), land, partition_cols=("load", "ingest_date"))
        stream_fx(spark, land, target, ckpt)
    return read_table(spark, target).select("effective_date", "currency_code", "currency_name", "mid_rate")


FX_LOADS = ("2026-04-20 05:30:00", "2026-04-21 05:30:00", "2026-04-22 05:30:00")


def feed_fx(spark, bronze, target, ckpt):
    """The incremental FX table, merged from what the bronze table gained."""
    q = start_bronze_feed(spark, bronze, target, ckpt, partial(fx_rows, load="_loaded_at"),
                          ["effective_date", "currency_code"], ["_loaded_at", "_src_file"], "month")
    q.awaitTermination()
    if q.exception():
        raise q.exception()


@query("bronze_change_feed", f"with {FX_STG_SQL} select effective_date, currency_code, currency_name, mid_rate from stg_fx",
       "S13 C1 C2 C3 M17 S9")
def q_bronze_change_feed(spark, sf_dir):
    """Three bronze loads of FX documents (two halves of the first state, then the
    revisions), each followed by a merge of the bronze table's changes; a fourth
    load and merge find nothing new."""
    land, bronze, target, ckpt = (scratch_path(spark, n) for n in ("feed-landing", "feed-bronze", "feed-target", "feed-ckpt"))
    first, revised = fx_docs(spark, sf_dir)
    half = F.col("ingest_date") < "1998-01-01"
    for load, (docs, run_ts) in enumerate(zip((first.where(half), first.where(~half), revised), FX_LOADS), 1):
        write_landing(docs.withColumn("load", F.lit(load)), land, partition_cols=("load", "ingest_date"))
        incremental_load(spark, land, bronze, run_ts)
        feed_fx(spark, bronze, target, ckpt)
    version = table_state(spark, target).version
    if incremental_load(spark, land, bronze, FX_LOADS[-1]):
        raise RuntimeError("a file was loaded twice")
    feed_fx(spark, bronze, target, ckpt)
    if table_state(spark, target).version != version:
        raise RuntimeError("changes were merged twice")
    return read_table(spark, target).select("effective_date", "currency_code", "currency_name", "mid_rate")


@query("mart_fx_returns", f"""with {FX_STG_SQL},
{_series_sql('steps', 'stg_fx', 'currency_code', 'effective_date', 'mid_rate')},
moves as (select *, mid_rate / nullif(before, 0) - 1 as move from steps)
select effective_date as rate_date, currency_code, currency_name, mid_rate, before as prev_mid_rate,
  cast(round(move, 8) as decimal(18,8)) as daily_return,
  {_window_sql('stddev_samp', 'move', 30, 'currency_code', 'effective_date', 8)} as volatility_30d
from moves""", "M7 W2 W4")
def q_mart_fx_returns(spark, sf_dir):
    r = feeds.fx_returns(feeds.stg_fx_rates(fx_bronze(spark, sf_dir, scratch_path(spark, "fx"))))
    return r.withColumns({c: F.round(c, 8).cast("decimal(18,8)") for c in ("daily_return", "volatility_30d")})


@query("mart_oil_spread", f"select date_key, market_date, brent_usd_bbl - wti_usd_bbl as brent_wti_spread "
       f"from ({MARKET_SIGNALS_SQL})", "B1 M16")
def q_mart_oil_spread(spark, sf_dir):
    return feeds.oil_spread(market_signals_from_feeds(spark, sf_dir))


@query("mart_degree_days", f"""with {WEATHER_STG_SQL}
select cast(date_trunc('month', weather_date) as date) as month,
  cast(round(sum(greatest(18 - temp_avg_c, 0)) filter (temp_avg_c is not null), 6) as decimal(18,6))
    as heating_degree_days,
  count(*) filter (precip_mm > 0) as rainy_days, count(*) as days
from stg_weather group by 1""", "B5 M14")
def q_mart_degree_days(spark, sf_dir):
    w = feeds.fct_weather_daily(feeds.stg_weather(weather_bronze(spark, sf_dir, scratch_path(spark, "w"))))
    return feeds.degree_days_by_month(w).withColumn(
        "heating_degree_days", F.round("heating_degree_days", 6).cast("decimal(18,6)"))


@query("distinct_codes", f"with {FX_STG_SQL} select distinct currency_code, currency_name from stg_fx", "A5")
def q_distinct_codes(spark, sf_dir):
    return feeds.stg_fx_rates(fx_bronze(spark, sf_dir, scratch_path(spark, "fx"))).select(
        "currency_code", "currency_name").distinct()


HISTORY_RUNS = ("2026-04-01 06:00:00", "2026-05-01 06:00:00", "2026-06-01 06:00:00")
HISTORY_SQL = f"""with {CIVIL_STG_SQL},
rows as (
  select period_date, index_value, 0 as opened, case when month(period_date) in (3, 5, 6, 9, 10, 12) then 1 end as closed
  from stg_civil
  union all select period_date, index_value + 1, 1, null from stg_civil where month(period_date) in (3, 6, 9, 12)
  union all select period_date, index_value, 2, null from stg_civil where month(period_date) in (5, 10))
select period_date, cast(index_value as decimal(18,4)) as index_value,
  list_extract({list(HISTORY_RUNS)}, opened + 1)::timestamp as valid_from,
  list_extract({list(HISTORY_RUNS)}, closed + 1)::timestamp as valid_to from rows"""


@query("index_revision_history", HISTORY_SQL, "M18 C4 C5")
def q_index_revision_history(spark, sf_dir):
    """Three loads of the monthly index, each applied to the stored history: the
    second revises every quarter's last month and withdraws May and October, which
    the third brings back."""
    root = scratch_path(spark, "index-history")
    month = F.month("period_date")
    base = (table(spark, sf_dir, "lineitem")
            .groupBy(F.trunc(F.col("l_shipdate").cast("date"), "month").alias("period_date"))
            .agg((F.count(F.lit(1)) * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(18,4)").alias("index_value"))
            .where(month != 2))
    revised = base.withColumn("index_value", (F.col("index_value") + F.when(month % 3 == 0, 1).otherwise(0))
                              .cast("decimal(18,4)"))
    history = None
    for run_ts, snapshot in zip(HISTORY_RUNS, (base, revised.where(month % 5 != 0), revised)):
        _, history = publish_history(spark, root, snapshot, ["period_date"], ["index_value"], run_ts)
    return history


CONTROL_BLOCK = 500  # source records of one control document


def _control_file(spark, sf_dir):
    """Control documents with one source record per supplier, a block of suppliers each."""
    k = F.col("s_suppkey")
    source = F.struct(
        F.concat(F.lit("src_"), k.cast("string")).alias("source_id"), (k % 3 != 0).alias("enabled"),
        F.col("s_name").alias("description"), F.lit("https://data.example/{ingest_date}").alias("base_url"),
        F.when(k % 2 == 0, "none").otherwise("api_key").alias("auth_type"), F.lit("json").alias("response_format"),
        F.lit("daily").alias("frequency"), F.lit("raw").alias("landing_container"),
        F.concat(F.lit("source=s"), k.cast("string"), F.lit("/ingest_date={ingest_date}")).alias("landing_path_template"),
        F.when(k % 5 == 0, "backfill.json").otherwise("day_{ingest_date}.json").alias("file_name_template"))
    block = F.floor(k / CONTROL_BLOCK).alias("block")
    doc = table(spark, sf_dir, "supplier").groupBy(block).agg(F.collect_list(source).alias("sources")).select(
        "block", F.to_json(F.struct(F.lit("1.0").alias("schema_version"), "sources")).alias("value"))
    root = scratch_path(spark, "control")
    doc.write.partitionBy("block").text(root)  # a file holds one document
    return read_control(spark, root)


@query("control_enabled", """select 'src_' || s_suppkey as source_id, s_name as description, 'api_key' as auth_type
from supplier where s_suppkey % 3 <> 0 and s_suppkey % 2 <> 0""", "S1 S2")
def q_control_enabled(spark, sf_dir):
    return enabled_sources(_control_file(spark, sf_dir), "api_key").select("source_id", "description", "auth_type")


@query("landing_plan", """select 'src_' || s_suppkey as source_id,
  case when s_suppkey % 2 = 0 then 'none' else 'api_key' end as auth_type,
  'https://data.example/2026-04-21' as url, 'source=s' || s_suppkey || '/ingest_date=2026-04-21' as dir,
  case when s_suppkey % 5 = 0 then 'backfill.json' else 'day_2026-04-21.json' end as file,
  'raw/source=s' || s_suppkey || '/ingest_date=2026-04-21/' ||
    case when s_suppkey % 5 = 0 then 'backfill.json' else 'day_2026-04-21.json' end as path
from supplier where s_suppkey % 3 <> 0""", "S3 F14")
def q_landing_plan(spark, sf_dir):
    return landing_plan(enabled_sources(_control_file(spark, sf_dir)), "2026-04-21")


@query("landing_lineage", f"""select event_id, 'events' as source, cast(cast(ts as date) as varchar) as ingest_date,
  timestamp '{RUN_TS}' as loaded_at from events""", "S8 F12")
def q_landing_lineage(spark, sf_dir):
    """The lineage columns by value: which landed file a row came from, and when it was loaded."""
    root = scratch_path(spark, "landing")
    ev = table(spark, sf_dir, "events")
    write_landing(ev.select(F.lit("events").alias("source"), F.lit("stream").alias("dataset"),
                            F.date_format("ts", "yyyy-MM-dd").alias("ingest_date"), _events_json().alias("value")), root)
    b = read_documents(spark, root, RUN_TS, pattern=EVENTS_DOCS)
    part = lambda name: F.regexp_extract("_src_file", f"/{name}=([^/]+)/", 1).alias(name)
    return b.select(path("raw", "$.event_id", "bigint").alias("event_id"), part("source"), part("ingest_date"),
                    F.col("_loaded_at").alias("loaded_at"))
