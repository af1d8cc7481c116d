"""Registered queries: returns, rolling stats, ranks, dedup, pivots."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.keys import date_key, surrogate_key
from ..operators.dedupe import latest_wins
from ..operators.pivot import cross_rates, pivot_series
from ..operators.series import rank_within, rebased, returns_and_rolling, rolling_days
from .inputs import ANCHORS, PIVOT_NAMES, PX_SQL, dk_sql, px, sk_sql, table
from .registry import query

# Rows per chunk for the halo layout of long series (see operators.series).
HALO_CHUNK = 1024


def fx_fact(spark, sf_dir, halo_chunk=None):
    """M7 + M10 over the price series: one row per (rate_date, currency_code)."""
    r = returns_and_rolling(px(spark, sf_dir), ["k"], "d", "p", halo_chunk=halo_chunk)
    return r.select(
        surrogate_key("d", "k").alias("fx_rate_key"),
        date_key("d").alias("date_key"),
        F.col("k").alias("currency_code"),
        F.col("d").alias("rate_date"),
        F.col("p").alias("mid_rate"),
        F.col("prev_value").alias("prev_mid_rate"),
        F.col("change_abs"),
        F.round(F.col("daily_return") * 100, 4).cast("decimal(18,4)").alias("daily_change_pct"),
        F.round("ma_short", 6).cast("decimal(18,6)").alias("ma_7d"),
        F.round("ma_long", 6).cast("decimal(18,6)").alias("ma_30d"),
        F.round("volatility_long", 8).cast("decimal(18,8)").alias("volatility_30d"),
    )


_RET_SQL = f"""with {PX_SQL},
r as (select d, k, p, lag(p) over (partition by k order by d) as prev from px),
x as (select *, p - prev as change_abs, p / nullif(prev, 0) - 1 as ret from r),
y as (select *,
  avg(p) over (partition by k order by d rows between 6 preceding and current row) as ma7,
  avg(p) over (partition by k order by d rows between 29 preceding and current row) as ma30,
  stddev_samp(ret) over (partition by k order by d rows between 29 preceding and current row) as vol
  from x)"""

FX_RETURNS_SQL = f"""{_RET_SQL}
select {sk_sql('d', 'k')} as fx_rate_key, {dk_sql('d')} as date_key, k as currency_code,
  d as rate_date, p as mid_rate, prev as prev_mid_rate, change_abs,
  cast(round(ret * 100, 4) as decimal(18,4)) as daily_change_pct
from y"""


@query("fx_returns", FX_RETURNS_SQL, "W2 F7 F3 F6 P1 M7 M10")
def q_fx_returns(spark, sf_dir):
    return fx_fact(spark, sf_dir).drop("ma_7d", "ma_30d", "volatility_30d")


ROLLING_MEAN_SQL = f"""{_RET_SQL}
select d as rate_date, k as currency_code, p as mid_rate,
  cast(round(ma7, 6) as decimal(18,6)) as ma_7d, cast(round(ma30, 6) as decimal(18,6)) as ma_30d
from y"""


@query("rolling_mean", ROLLING_MEAN_SQL, "W3 F8")
def q_rolling_mean(spark, sf_dir):
    return fx_fact(spark, sf_dir, halo_chunk=HALO_CHUNK).select(
        "rate_date", "currency_code", "mid_rate", "ma_7d", "ma_30d")


ROLLING_VOL_SQL = f"""{_RET_SQL}
select d as rate_date, k as currency_code,
  cast(round(vol, 8) as decimal(18,8)) as volatility_30d
from y"""


@query("rolling_volatility", ROLLING_VOL_SQL, "W4 F8")
def q_rolling_volatility(spark, sf_dir):
    return fx_fact(spark, sf_dir, halo_chunk=HALO_CHUNK).select(
        "rate_date", "currency_code", "volatility_30d")


VOL_RANK_SQL = f"""{_RET_SQL},
v as (select d, k, cast(round(vol, 8) as decimal(18,8)) as volatility_30d from y)
select d as rate_date, k as currency_code, volatility_30d,
  rank() over (partition by d order by volatility_30d desc nulls last) as vol_rank
from v"""


@query("volatility_rank", VOL_RANK_SQL, "W5 B3")
def q_volatility_rank(spark, sf_dir):
    f = fx_fact(spark, sf_dir).select("rate_date", "currency_code", "volatility_30d")
    return rank_within(f, ["rate_date"], "volatility_30d", "vol_rank").withColumn(
        "vol_rank", F.col("vol_rank").cast("long"))


REBASED_SQL = f"""with {PX_SQL},
b as (select k, arg_min(p, d) as base from px group by k)
select px.d as rate_date, px.k as currency_code, px.p as mid_rate,
  cast(round(px.p / nullif(b.base, 0) * 100, 4) as decimal(18,4)) as rebased_index
from px join b using (k)"""


@query("rebased_index", REBASED_SQL, "W6 B2")
def q_rebased_index(spark, sf_dir):
    r = rebased(px(spark, sf_dir), ["k"], "d", "p", "rebased_raw")
    return r.select(F.col("d").alias("rate_date"), F.col("k").alias("currency_code"),
                    F.col("p").alias("mid_rate"),
                    F.round("rebased_raw", 4).cast("decimal(18,4)").alias("rebased_index"))


LATEST_WINS_SQL = """select event_id, ts, user_id, event_type, value, props from events
qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1"""


@query("latest_wins", LATEST_WINS_SQL, "W1 C7 P6")
def q_latest_wins(spark, sf_dir):
    """Window form (row_number = 1 with a partial WindowGroupLimit)."""
    ev = table(spark, sf_dir, "events").filter(F.col("ts").isNotNull())
    return latest_wins(ev, ["user_id", "event_type"], ["ts", "event_id"], method="window")


LATEST_WINS_MAXBY_SQL = LATEST_WINS_SQL


@query("latest_wins_max_by", LATEST_WINS_MAXBY_SQL, "W1")
def q_latest_wins_max_by(spark, sf_dir):
    """Aggregate form: max_by over a struct of the row."""
    ev = table(spark, sf_dir, "events").filter(F.col("ts").isNotNull())
    return latest_wins(ev, ["user_id", "event_type"], ["ts", "event_id"], method="max_by")


SERIES_PROFILE_SQL = f"""with {PX_SQL}
select k as series, count(*) as n_rows, min(d) as first_date, max(d) as last_date,
  arg_max(p, d) as latest_value, max(p) as max_value, min(p) as min_value
from px group by k"""


@query("series_profile", SERIES_PROFILE_SQL, "A3 A4 A6 Q8")
def q_series_profile(spark, sf_dir):
    return px(spark, sf_dir).groupBy(F.col("k").alias("series")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("d").alias("first_date"),
        F.max("d").alias("last_date"), F.max_by("p", "d").alias("latest_value"),
        F.max("p").alias("max_value"), F.min("p").alias("min_value"))


_piv_cols = ",\n  ".join(f"max(case when k = '{c}' then p end) as {n}" for c, n in PIVOT_NAMES.items())
PIVOT_SQL = f"""with {PX_SQL}
select d as rate_date,
  {_piv_cols}
from px group by d"""


@query("pivot_series", PIVOT_SQL, "A1 P7")
def q_pivot_series(spark, sf_dir):
    return pivot_series(px(spark, sf_dir), "d", "k", "p", PIVOT_NAMES).withColumnRenamed(
        "d", "rate_date")


_a = list(ANCHORS.items())
CROSS_RATES_SQL = f"""with {PX_SQL},
anchors as (select d,
  max(case when k = '{_a[0][0]}' then p end) as a1,
  max(case when k = '{_a[1][0]}' then p end) as a2
  from px group by d)
select {dk_sql('r.d')} as date_key, r.k as currency_code, r.d as rate_date, r.p as pln_per_unit,
  cast(round(r.p / nullif(a.a1, 0), 6) as decimal(18,6)) as {_a[0][1]}_per_unit,
  cast(round(r.p / nullif(a.a2, 0), 6) as decimal(18,6)) as {_a[1][1]}_per_unit
from px r join anchors a using (d)"""


@query("cross_rates", CROSS_RATES_SQL, "K1 A1 F7 F8 M11")
def q_cross_rates(spark, sf_dir):
    c = cross_rates(px(spark, sf_dir), "d", "k", "p", ANCHORS)
    return c.select(date_key("d").alias("date_key"), F.col("k").alias("currency_code"),
                    F.col("d").alias("rate_date"), F.col("p").alias("pln_per_unit"),
                    *[F.col(f"{p}_per_unit") for p in ANCHORS.values()])


ROLLING_DAYS_SQL = f"""with {PX_SQL}
select d as rate_date, k as currency_code, p as mid_rate,
  cast(round(avg(p) over (partition by k order by d
    range between interval 6 days preceding and current row), 6) as decimal(18,6)) as ma_7cd,
  cast(round(avg(p) over (partition by k order by d
    range between interval 29 days preceding and current row), 6) as decimal(18,6)) as ma_30cd
from px"""


@query("rolling_calendar", ROLLING_DAYS_SQL, "W3 T3")
def q_rolling_calendar(spark, sf_dir):
    """Calendar-day frames (7 and 30 days), the variant beside the row frames;
    time-chunked so a long series is spread over many tasks."""
    r = rolling_days(px(spark, sf_dir), ["k"], "d", "p", 7, "avg", "ma7", chunk_days=365)
    r = rolling_days(r, ["k"], "d", "p", 30, "avg", "ma30", chunk_days=365)
    return r.select(F.col("d").alias("rate_date"), F.col("k").alias("currency_code"),
                    F.col("p").alias("mid_rate"),
                    F.round("ma7", 6).cast("decimal(18,6)").alias("ma_7cd"),
                    F.round("ma30", 6).cast("decimal(18,6)").alias("ma_30cd"))
