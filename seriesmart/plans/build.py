"""The daily build: bronze -> staging -> marts, each published behind its data tests.

``build_marts`` runs what the reference's scheduled build runs after the
bronze load: a freshness gate on every bronze table (warn 26 h, error 50 h on
``_loaded_at``), the staging models, the dimensions, the facts and the wide
daily mart. Every model is published as a new version only when its declared
data tests pass (one aggregate pass per table for the row-level tests); the
published staging tables and dimensions are read back for the models built
on them, which cuts lineage and gives the relationship tests their parents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.merge import publish_table
from ..operators.quality import (QualityGateError, accepted_range, accepted_values, freshness,
                                 not_null, relationships, unique)
from ..operators.scd2 import publish_history
from ..sources.landing import read_bronze, read_commits
from . import feeds

# Fixed values that must equal the reference's: freshness limits (hours) and
# the ranges / accepted values its data tests declare.
WARN_AFTER_HOURS, ERROR_AFTER_HOURS = 26, 50
TEMP_RANGE_C = (-50, 60)
RATE_RANGE_PCT = (-5, 25)
OIL_UNITS = ("$/BBL",)
FREQUENCIES = ("monthly", "annual", "quarterly")

HALO_CHUNK = 4096  # rows per chunk of a series, so that few long series still run in many tasks

BRONZE = {"fx": "nbp_fx_rates_raw", "oil": "eia_petroleum_spot_raw",
          "weather": "openmeteo_weather_raw", "rates": "ecb_estr_raw",
          "civil": "eurostat_civil_eng_raw", "roads": "gus_roads_raw"}


def _keyed(key, *not_nulls):
    return [unique(key), not_null(key), *[not_null(c) for c in not_nulls]]


def model_checks(dim_date: DataFrame | None = None, dim_currency: DataFrame | None = None):
    """The declared data tests per model (relationships need the parents)."""
    rel_date = [relationships("date_key", dim_date, "date_key")] if dim_date is not None else []
    rel_ccy = ([relationships("currency_code", dim_currency, "currency_code")]
               if dim_currency is not None else [])
    return {
        "stg_fx_rates": _keyed("fx_rate_key", "effective_date", "currency_code", "mid_rate",
                               "_src_file", "_loaded_at"),
        "stg_petroleum_spot": _keyed("price_key", "price_date", "series", "price"),
        "stg_weather": _keyed("weather_key", "weather_date", "temp_max_c"),
        "stg_civil_eng": _keyed("construction_key", "period_date", "geo", "index_value"),
        "stg_expressways": _keyed("road_key", "period_date", "area", "road_km"),
        "stg_estr": _keyed("rate_key", "rate_date", "series_key", "rate_pct"),
        "dim_date": _keyed("date_key", "full_date", "is_weekday"),
        "dim_currency": _keyed("currency_code", "is_major"),
        "int_fx_returns": [not_null("rate_date"), not_null("currency_code"), not_null("mid_rate")],
        "civil_eng_index_history": [not_null("period_date"), not_null("valid_from")],
        "fct_fx_rates": _keyed("fx_rate_key", "date_key", "currency_code", "rate_date", "mid_rate")
        + rel_date + rel_ccy + [accepted_range("mid_rate", 0, inclusive=False),
                                accepted_range("volatility_30d", 0)],
        "fct_fx_cross_rates": [not_null("date_key"), not_null("currency_code"), not_null("rate_date"),
                               accepted_range("pln_per_unit", 0, inclusive=False)]
        + rel_date + rel_ccy,
        "fct_commodity_prices": _keyed("price_key", "date_key", "price_date", "series", "price")
        + rel_date + [accepted_range("price", 0, inclusive=False),
                      accepted_values("units", OIL_UNITS)],
        "fct_interest_rates": _keyed("rate_key", "date_key", "rate_date", "series_key", "rate_pct")
        + rel_date + [accepted_range("rate_pct", *RATE_RANGE_PCT)],
        "fct_weather_daily": _keyed("weather_key", "date_key", "weather_date", "temp_max_c")
        + rel_date + [accepted_range("temp_avg_c", *TEMP_RANGE_C), accepted_range("precip_mm", 0),
                      accepted_range("heating_degree_days", 0)],
        "fct_construction_activity": _keyed("activity_key", "date_key", "period_date", "source_name",
                                            "indicator", "value")
        + rel_date + [accepted_values("frequency", FREQUENCIES)],
        "fct_daily_market_signals": [not_null("date_key"), unique("market_date"),
                                     not_null("market_date")] + rel_date,
    }


REPORT = T.StructType([T.StructField("model", T.StringType()),
                       T.StructField("version", T.IntegerType())])


def freshness_gate(spark: SparkSession, bronze_tables: dict, run_ts, loaded_at: str = "_loaded_at") -> DataFrame:
    """Q6: one status row per bronze table; raises when any is ``error``. A table's
    commit log (``loaded_at``) says the same as the table, at a row for each load."""
    rows = None
    for name, df in bronze_tables.items():
        f = df.select(F.lit(name).alias("table"), F.col(loaded_at).alias("loaded_at"))
        rows = f if rows is None else rows.unionByName(f)
    every = spark.createDataFrame([(n,) for n in bronze_tables], "table string")
    rows = every.join(rows, "table", "left")  # a table that was never loaded is stale
    rows = freshness(rows, "loaded_at", run_ts, WARN_AFTER_HOURS, ERROR_AFTER_HOURS, by=["table"])
    # One row per bronze table: metadata-sized.
    bad = [r.table for r in rows.filter(F.col("status") == "error").collect()]
    if bad:
        raise QualityGateError(f"stale sources (older than {ERROR_AFTER_HOURS} h): {bad}")
    return rows


def _in_parallel(tasks: dict, threads: int) -> dict:
    """Run independent model builds concurrently (a session accepts jobs from
    several threads); results by name, the first failure re-raised."""
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        futures = {name: pool.submit(fn) for name, fn in tasks.items()}
        return {name: f.result() for name, f in futures.items()}


def build_marts(spark: SparkSession, bronze_root: str, out_root: str, run_ts,
                calendar: DataFrame | None = None, check_freshness: bool = True,
                threads: int = 4) -> DataFrame:
    """Build and publish every model; returns ``DF[model, version]``.

    ``calendar`` is the date dimension's day spine (default: the reference's
    fixed 2000-2026 calendar, trap T12). Models of one layer do not depend on
    each other and are built by ``threads`` concurrent jobs (the reference's
    build runs four threads).
    """
    if check_freshness:
        logs = {k: read_commits(spark, f"{bronze_root}/{t}") for k, t in BRONZE.items()}
        missing = sorted(k for k, log in logs.items() if log is None)
        if missing:
            raise QualityGateError(f"sources that were never loaded: {missing}")
        freshness_gate(spark, logs, run_ts, "loaded_at")
    bronze = {k: read_bronze(spark, f"{bronze_root}/{t}") for k, t in BRONZE.items()}
    versions = {}

    def pub(name, df, checks):
        version, path = publish_table(spark, df, f"{out_root}/{name}", checks)
        versions[name] = version
        # Read back what was written: later models start from the table.
        return spark.read.schema(df.schema).parquet(path)

    base = model_checks()
    stg_models = {
        "fx": ("stg_fx_rates", feeds.stg_fx_rates),
        "oil": ("stg_petroleum_spot", feeds.stg_petroleum_spot),
        "weather": ("stg_weather", feeds.stg_weather),
        "civil": ("stg_civil_eng", feeds.stg_civil_eng),
        "roads": ("stg_expressways", feeds.stg_expressways),
        "rates": ("stg_estr", feeds.stg_estr),
    }
    stg = _in_parallel({k: (lambda n=n, f=f, k=k: pub(n, f(bronze[k]), base[n]))
                        for k, (n, f) in stg_models.items()}, threads)
    dd = feeds.dim_date(spark) if calendar is None else feeds._dim_date(calendar)
    dims = _in_parallel({
        "date": lambda: pub("dim_date", dd, base["dim_date"]),
        "currency": lambda: pub("dim_currency", feeds.dim_currency(stg["fx"]), base["dim_currency"]),
    }, threads)
    checks = model_checks(dims["date"], dims["currency"])
    facts = {
        "int_fx_returns": lambda: feeds.fx_returns(stg["fx"], HALO_CHUNK),
        "fct_fx_rates": lambda: feeds.fct_fx_rates(stg["fx"], HALO_CHUNK),
        "fct_fx_cross_rates": lambda: feeds.fct_fx_cross_rates(stg["fx"]),
        "fct_commodity_prices": lambda: feeds.fct_commodity_prices(stg["oil"], HALO_CHUNK),
        "fct_interest_rates": lambda: feeds.fct_interest_rates(stg["rates"], HALO_CHUNK),
        "fct_weather_daily": lambda: feeds.fct_weather_daily(stg["weather"]),
        "fct_construction_activity": lambda: feeds.fct_construction_activity(stg["civil"],
                                                                              stg["roads"]),
    }
    f = _in_parallel({n: (lambda n=n, mk=mk: pub(n, mk(), checks[n])) for n, mk in facts.items()},
                     threads)
    signals = feeds.fct_daily_market_signals(
        spark, f["fct_fx_rates"], f["fct_commodity_prices"], f["fct_interest_rates"],
        f["fct_weather_daily"], f["fct_construction_activity"], calendar=dims["date"])
    pub("fct_daily_market_signals", signals, checks["fct_daily_market_signals"])
    versions["civil_eng_index_history"], _ = publish_history(
        spark, f"{out_root}/civil_eng_index_history", stg["civil"], ["period_date"], ["index_value"], run_ts,
        base["civil_eng_index_history"])
    order = [n for n, _ in stg_models.values()] + ["dim_date", "dim_currency", *facts,
                                                   "fct_daily_market_signals", "civil_eng_index_history"]
    return spark.createDataFrame([(n, versions[n]) for n in order], REPORT)
