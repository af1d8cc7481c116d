"""The reference's models as DataFrame functions over bronze feeds.

Staging: bronze ``DF[raw VARIANT, _src_file, _loaded_at]`` (or the projected
CSV for the rate feed) -> typed, deduplicated rows. Marts: staging -> facts
and dimensions. Everything stays lazy until a mart is written.

Latest-wins dedup orders by ``_loaded_at`` then ``_src_file`` (trap T5: all
files of one load share one load time).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import bounded_spine, date_spine, dim_date as _dim_date
from ..functions.keys import date_key, pipe_key, surrogate_key
from ..functions.scalar import degree_days, mean_of_two, month_start, year_start
from ..operators.asof import multi_asof
from ..operators.conform import conform_tall
from ..operators.dedupe import latest_wins
from ..operators.nested import decode_jsonstat, drop_null_observations, flatten, path, zip_arrays
from ..operators.pivot import cross_rates, pivot_series
from ..operators.series import returns_and_rolling, with_change

# Fixed values that must equal the reference's for the same results.
MAJOR_CURRENCIES = ("USD", "EUR", "GBP", "CHF", "JPY", "CAD", "AUD", "CNY")
FX_ANCHORS = {"USD": "usd", "EUR": "eur"}
OIL_SERIES = {"RWTC": "wti_usd_bbl", "RBRTE": "brent_usd_bbl"}
CALENDAR_START, CALENDAR_END_EXCLUSIVE = "2000-01-01", "2027-01-01"
HDD_BASE_C = 18
ROAD_AREA = "POLSKA"
EUROSTAT_TAGS = {"source_name": "eurostat", "geo": "PL",
                 "indicator": "civil_engineering_production_index",
                 "frequency": "monthly", "unit": "index_2021_100"}
GUS_TAGS = {"source_name": "gus", "geo": "PL", "indicator": "expressway_motorway_length",
            "frequency": "annual", "unit": "km"}
# Latest-wins order: load time, then file, then a content hash (trap T5), so
# two different values for one grain in one file and load resolve the same
# way on every run.
LATEST = ["_loaded_at", "_src_file", "__h"]


def _with_hash(df):
    """``__h``: a hash of the typed values (every non-lineage column)."""
    return df.withColumn("__h", F.xxhash64(*[c for c in df.columns if not c.startswith("_")]))


# --- staging ---------------------------------------------------------------

def stg_fx_rates(bronze: DataFrame) -> DataFrame:
    """M1: array of table documents -> rates; grain (effective_date, currency_code)."""
    docs = flatten(bronze, "raw", "$", "d", keep=["_src_file", "_loaded_at"])
    docs = docs.select(path("d", "$.no", "string").alias("table_no"),
                       path("d", "$.effectiveDate", "date").alias("effective_date"),
                       "d", "_src_file", "_loaded_at")
    r = flatten(docs, "d", "$.rates", "r", keep=["effective_date", "table_no", "_src_file",
                                                  "_loaded_at"])
    r = r.select("effective_date", "table_no",
                 path("r", "$.code", "string").alias("currency_code"),
                 path("r", "$.currency", "string").alias("currency_name"),
                 path("r", "$.mid", "decimal(18,6)", strict=True).alias("mid_rate"), "_src_file", "_loaded_at")
    r = latest_wins(_with_hash(r), ["effective_date", "currency_code"], LATEST)
    return r.select(pipe_key("effective_date", "currency_code").alias("fx_rate_key"),
                    "effective_date", "currency_code", "currency_name", "mid_rate", "table_no",
                    "_src_file", "_loaded_at")


def stg_petroleum_spot(bronze: DataFrame) -> DataFrame:
    """M2: ``response.data[]``; JSON nulls dropped after the cast (T2). Here and
    below a value that is present but does not parse stops the build."""
    d = flatten(bronze, "raw", "$.response.data", "d", keep=["_src_file", "_loaded_at"])
    d = d.select(path("d", "$.period", "date").alias("price_date"),
                 path("d", "$.series", "string").alias("series"),
                 path("d", '$["product-name"]', "string").alias("product_name"),
                 path("d", "$.value", "decimal(18,6)", strict=True).alias("price"),
                 path("d", "$.units", "string").alias("units"), "_src_file", "_loaded_at")
    d = latest_wins(_with_hash(drop_null_observations(d, "price")), ["price_date", "series"], LATEST)
    return d.select(pipe_key("price_date", "series").alias("price_key"), "price_date", "series",
                    "product_name", "price", "units", "_src_file", "_loaded_at")


def stg_weather(bronze: DataFrame) -> DataFrame:
    """M3: parallel arrays under ``daily`` zipped by position."""
    b = bronze.select("raw", "_src_file", "_loaded_at",
                      path("raw", "$.latitude", "decimal(9,4)").alias("latitude"),
                      path("raw", "$.longitude", "decimal(9,4)").alias("longitude"))
    z = zip_arrays(b, "raw", "$.daily", "time",
                   {"temp_max_c": ("temperature_2m_max", "double"),
                    "temp_min_c": ("temperature_2m_min", "double"),
                    "precip_mm": ("precipitation_sum", "double")},
                   index_type="date", keep=["latitude", "longitude", "_src_file", "_loaded_at"],
                   index_name="weather_date", strict=True)
    z = _with_hash(drop_null_observations(z, "temp_max_c"))
    z = latest_wins(z, ["weather_date", "latitude", "longitude"], LATEST)
    return z.select(pipe_key("weather_date", "latitude", "longitude").alias("weather_key"),
                    "weather_date", "latitude", "longitude", "temp_max_c", "temp_min_c",
                    mean_of_two("temp_max_c", "temp_min_c", 2).alias("temp_avg_c"),
                    "precip_mm", "_src_file", "_loaded_at")


def stg_civil_eng(bronze: DataFrame) -> DataFrame:
    """M4: JSON-stat time index x sparse value map; monthly."""
    s = decode_jsonstat(bronze, "raw", "decimal(18,4)", keep=["_src_file", "_loaded_at"],
                        period="period", value="index_value", strict=True)
    s = drop_null_observations(s, "index_value").select(
        month_start("period").alias("period_date"), "index_value", "_src_file", "_loaded_at")
    s = latest_wins(_with_hash(s), ["period_date"], LATEST)
    key = F.md5(F.concat(F.col("period_date").cast("string"), F.lit("|PL|civil_eng")))
    return s.select(key.alias("construction_key"), "period_date", F.lit("PL").alias("geo"),
                    "index_value", "_src_file", "_loaded_at")


def stg_expressways(bronze: DataFrame) -> DataFrame:
    """M5: ``results[]`` x ``values[]``; annual."""
    r = flatten(bronze, "raw", "$.results", "r", keep=["_src_file", "_loaded_at"])
    r = r.select(path("r", "$.name", "string").alias("area"), "r", "_src_file", "_loaded_at")
    v = flatten(r, "r", "$.values", "v", keep=["area", "_src_file", "_loaded_at"])
    v = v.select(year_start(path("v", "$.year", "string")).alias("period_date"), "area",
                 path("v", "$.val", "decimal(18,2)", strict=True).alias("road_km"), "_src_file", "_loaded_at")
    v = latest_wins(_with_hash(drop_null_observations(v, "road_km")), ["period_date", "area"], LATEST)
    return v.select(pipe_key("period_date", "area").alias("road_key"), "period_date", "area",
                    "road_km", "_src_file", "_loaded_at")


def stg_estr(bronze_csv: DataFrame) -> DataFrame:
    """M6: projected CSV rows -> renamed, non-null, deduplicated."""
    s = bronze_csv.filter(F.col("obs_value").isNotNull()).select(
        "series_key", F.col("obs_date").alias("rate_date"), F.col("obs_value").alias("rate_pct"),
        F.col("title").alias("series_name"), "_src_file", "_loaded_at")
    s = latest_wins(_with_hash(s), ["rate_date", "series_key"], LATEST)
    return s.select(pipe_key("rate_date", "series_key").alias("rate_key"), "rate_date",
                    "series_key", "series_name", "rate_pct", "_src_file", "_loaded_at")


# --- marts -----------------------------------------------------------------

def dim_date(spark: SparkSession, start=CALENDAR_START, end_exclusive=CALENDAR_END_EXCLUSIVE):
    """M8: calendar dimension, 9,862 rows for the default bounds."""
    return _dim_date(date_spine(spark, start, end_exclusive))


def dim_currency(stg: DataFrame) -> DataFrame:
    """M9: one row per code with its latest name (T19) and the major flag."""
    d = latest_wins(stg.select("currency_code", "currency_name", "effective_date", "_loaded_at"),
                    ["currency_code"], ["effective_date", "_loaded_at"])
    return d.select("currency_code", "currency_name",
                    F.col("currency_code").isin(*MAJOR_CURRENCIES).alias("is_major"))


def fct_fx_rates(stg: DataFrame, halo_chunk: int | None = None) -> DataFrame:
    """M7 + M10: returns, moving averages and volatility per currency."""
    r = stg.select(F.col("effective_date").alias("rate_date"), "currency_code", "mid_rate")
    e = returns_and_rolling(r, ["currency_code"], "rate_date", "mid_rate", halo_chunk=halo_chunk)
    return e.select(
        surrogate_key("rate_date", "currency_code").alias("fx_rate_key"),
        date_key("rate_date").alias("date_key"), "currency_code", "rate_date", "mid_rate",
        F.col("prev_value").alias("prev_mid_rate"), "change_abs",
        F.round(F.col("daily_return") * 100, 4).alias("daily_change_pct"),
        F.round("ma_short", 6).alias("ma_7d"), F.round("ma_long", 6).alias("ma_30d"),
        F.round("volatility_long", 8).alias("volatility_30d"))


def fct_fx_cross_rates(stg: DataFrame) -> DataFrame:
    """USD and EUR crosses of every currency, per date."""
    r = stg.select(F.col("effective_date").alias("rate_date"), "currency_code", "mid_rate")
    c = cross_rates(r, "rate_date", "currency_code", "mid_rate", FX_ANCHORS)
    return c.select(date_key("rate_date").alias("date_key"), "currency_code", "rate_date",
                    F.col("mid_rate").alias("pln_per_unit"), "usd_per_unit", "eur_per_unit")


def fx_returns(stg: DataFrame, halo_chunk: int | None = None) -> DataFrame:
    """M7 as a model of its own: staged rates with their name, previous rate and daily return."""
    r = stg.select(F.col("effective_date").alias("rate_date"), "currency_code", "currency_name", "mid_rate")
    e = returns_and_rolling(r, ["currency_code"], "rate_date", "mid_rate", halo_chunk=halo_chunk)
    return e.select("rate_date", "currency_code", "currency_name", "mid_rate",
                    F.col("prev_value").alias("prev_mid_rate"), "daily_return",
                    F.col("volatility_long").alias("volatility_30d"))


def oil_spread(signals: DataFrame) -> DataFrame:
    """B1 over M16: Brent minus WTI per market day."""
    return signals.select("date_key", "market_date",
                          (F.col("brent_usd_bbl") - F.col("wti_usd_bbl")).alias("brent_wti_spread"))


def degree_days_by_month(weather: DataFrame) -> DataFrame:
    """B5 over M14: heating degree days and rainy days per month."""
    return (weather.groupBy(F.trunc("weather_date", "month").alias("month"))
            .agg(F.sum("heating_degree_days").alias("heating_degree_days"),
                 F.count_if("is_rainy").alias("rainy_days"), F.count(F.lit(1)).alias("days")))


def fct_commodity_prices(stg: DataFrame, halo_chunk: int | None = None) -> DataFrame:
    """Day-over-day movement per series."""
    c = with_change(stg, ["series"], "price_date", "price", prev="prev_price",
                    change="change_abs", ret="__ret", halo_chunk=halo_chunk)
    return c.select(surrogate_key("price_date", "series").alias("price_key"),
                    date_key("price_date").alias("date_key"), "price_date", "series",
                    "product_name", "price", "units", "prev_price", "change_abs",
                    F.round(F.col("__ret") * 100, 4).alias("change_pct"))


def fct_interest_rates(stg: DataFrame, halo_chunk: int | None = None) -> DataFrame:
    """Change in percentage points, under its customary name too (trap T17)."""
    c = with_change(stg, ["series_key"], "rate_date", "rate_pct", prev="prev_rate_pct",
                    change=None, ret=None, halo_chunk=halo_chunk)
    change = F.round(F.col("rate_pct") - F.col("prev_rate_pct"), 6)
    return c.select("rate_key", date_key("rate_date").alias("date_key"), "rate_date", "series_key",
                    "series_name", "rate_pct", "prev_rate_pct", change.alias("change_pct_pt"),
                    change.alias("change_bps_pt"))


def fct_weather_daily(stg: DataFrame) -> DataFrame:
    """Heating degree days (NULL-safe, T1) and the rain flag."""
    return stg.select("weather_key", date_key("weather_date").alias("date_key"), "weather_date",
                      "latitude", "longitude", "temp_max_c", "temp_min_c", "temp_avg_c",
                      "precip_mm", degree_days("temp_avg_c", HDD_BASE_C).alias("heating_degree_days"),
                      (F.col("precip_mm") > 0).alias("is_rainy"))


def fct_construction_activity(stg_civil: DataFrame, stg_roads: DataFrame) -> DataFrame:
    """Monthly index and annual road length in one tall shape."""
    e = stg_civil.select("period_date", F.col("index_value").alias("value"))
    g = stg_roads.filter(F.col("area") == ROAD_AREA).select(
        "period_date", F.col("road_km").alias("value"))
    tall = conform_tall([(e, EUROSTAT_TAGS), (g, GUS_TAGS)])
    return tall.select(surrogate_key("period_date", "source_name", "indicator").alias("activity_key"),
                       date_key("period_date").alias("date_key"), "period_date", "source_name",
                       "geo", "indicator", "frequency", "value", "unit")


def fct_daily_market_signals(spark: SparkSession, fx: DataFrame, commodity: DataFrame,
                             rates: DataFrame, weather: DataFrame, activity: DataFrame,
                             calendar: DataFrame | None = None) -> DataFrame:
    """One row per day of the FX range; every feed as of that day."""
    cal = calendar if calendar is not None else dim_date(spark)
    spine = bounded_spine(cal, fx, "rate_date").select(F.col("full_date").alias("market_date"))
    fxp = pivot_series(fx, "rate_date", "currency_code", "mid_rate",
                       {"USD": "usd_pln", "EUR": "eur_pln"})
    oil = pivot_series(commodity, "price_date", "series", "price", OIL_SERIES)
    feeds = {
        "fx": (fxp, "rate_date", ["usd_pln", "eur_pln"]),
        "oil": (oil, "price_date", list(OIL_SERIES.values())),
        "estr": (rates.select("rate_date", F.col("rate_pct").alias("estr_pct")), "rate_date",
                 ["estr_pct"]),
        "weather": (weather.select("weather_date", "temp_avg_c", "heating_degree_days"),
                    "weather_date", ["temp_avg_c", "heating_degree_days"]),
        "eurostat": (activity.filter(F.col("source_name") == "eurostat")
                     .select("period_date", F.col("value").alias("civil_eng_index")),
                     "period_date", ["civil_eng_index"]),
        "gus": (activity.filter(F.col("source_name") == "gus")
                .select(F.col("period_date").alias("gus_date"), F.col("value").alias("motorway_km")),
                "gus_date", ["motorway_km"]),
    }
    out = multi_asof(spine, "market_date", feeds, bucket="month")
    return out.select(date_key("market_date").alias("date_key"), "market_date", "usd_pln",
                      "eur_pln", "wti_usd_bbl", "brent_usd_bbl", "estr_pct", "temp_avg_c",
                      "heating_degree_days", "civil_eng_index", "motorway_km")
