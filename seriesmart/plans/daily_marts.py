"""Registered queries: the reference's models end to end on feeds derived from the tables.

Six feeds are derived from ``orders``/``lineitem`` in the shapes the models
decode, landed as files, loaded to bronze and run through the staging models
and marts of :mod:`seriesmart.plans.feeds`:

* FX table documents (one per day, one rate per order priority, mapped to a
  currency code), landed twice: a stale first load and a later load that
  revises every day after the 10th (latest wins per grain);
* oil spot documents per (return flag, year) with string, number and JSON
  null values;
* weather documents per year with parallel arrays, one array a day short;
* JSON-stat documents per year with a sparse value object;
* road-length documents per area with nested ``values``;
* a wide rate CSV with empty values on the 1st of a month.

Every document is bounded (a day, or a year of one series); nothing is
collected beyond that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import dim_date
from ..operators.merge import read_table
from ..session import scratch_path
from ..sources.bronze import ECB_COLUMNS, ECB_POSITIONS
from ..sources.landing import read_documents, read_positional_csv, write_landing
from . import feeds
from .inputs import dk_sql, px, sk_sql, table
from .reconcile import CAL_SQL, calendar_years
from .registry import query

LOAD_1, LOAD_2 = "2026-04-20 05:30:00", "2026-04-21 05:30:00"

# Re-aiming of the test data (fixed for these queries): order priority ->
# (currency code, name); return flag -> (oil series, product name).
CURRENCIES = {"1-URGENT": ("USD", "us dollar"), "2-HIGH": ("EUR", "euro"),
              "3-MEDIUM": ("GBP", "pound sterling"), "4-NOT SPECIFIED": ("CHF", "swiss franc"),
              "5-LOW": ("JPY", "yen")}
OIL = {"A": ("RWTC", "WTI Crude Oil"), "N": ("RBRTE", "Brent Crude Oil"), "R": ("OTHER", "Other Crude")}
LATITUDE, LONGITUDE = 52.23, 21.01
RATE_SERIES = "EST.B.EU000A2X2A25.WT"
RATE_TITLE = "Euro short-term rate, volume-weighted trimmed mean"
ROAD_AREAS = {"POLSKA": 0.25, "MAZOWIECKIE": 0.05}


def _map(col, mapping, idx):
    e = None
    for k, v in mapping.items():
        e = (F.when(F.col(col) == k, F.lit(v[idx])) if e is None
             else e.when(F.col(col) == k, F.lit(v[idx])))
    return e


def _sql_case(col, mapping, idx):
    return "case " + " ".join(f"when {col} = '{k}' then '{v[idx]}'" for k, v in mapping.items()) + " end"


# --- derived landed feeds -----------------------------------------------------

def _split(dataset):
    src, ds = dataset.split("/")
    return src, ds


def _landed(docs: DataFrame, dataset: str) -> DataFrame:
    src, ds = _split(dataset)
    return docs.select(F.lit(src).alias("source"), F.lit(ds).alias("dataset"), "ingest_date", "value")


def _read_landed(spark, root, dataset, run_ts):
    # Point the reader at the feed's own partition folder: the listing is
    # pruned to that feed; the regex still selects files by name.
    src, ds = _split(dataset)
    return read_documents(spark, f"{root}/source={src}/dataset={ds}", run_ts,
                          pattern=f".*/source={src}/dataset={ds}/.*")


def _land_docs(spark, root, dataset, docs: DataFrame, run_ts):
    write_landing(_landed(docs, dataset), root)
    return _read_landed(spark, root, dataset, run_ts)


FX = "nbp/fx_rates_table_a"


def fx_docs(spark, sf_dir):
    """FX table documents of the two loads: (stale first load, later revision)."""
    p = px(spark, sf_dir).select("d", _map("k", CURRENCIES, 0).alias("code"),
                                 _map("k", CURRENCIES, 1).alias("name"), "p")

    def docs(df, bump):
        mid = (F.col("p") + F.lit(1)) if bump else F.col("p")
        g = df.groupBy("d").agg(F.sort_array(F.collect_list(F.struct(
            F.col("code"), F.col("name").alias("currency"), mid.alias("mid")))).alias("rates"))
        doc = F.array(F.struct(F.lit("A").alias("table"),
                               F.concat(F.date_format("d", "D"), F.lit("/A/"), F.year("d").cast("string"))
                               .alias("no"),
                               F.date_format("d", "yyyy-MM-dd").alias("effectiveDate"),
                               F.col("rates")))
        return g.select(F.date_format(F.trunc("d", "month"), "yyyy-MM-dd").alias("ingest_date"),
                        F.to_json(doc).alias("value"))

    return docs(p, True), docs(p.filter(F.dayofmonth("d") > 10), False)


def fx_bronze(spark, sf_dir, root):
    """Two loads of FX table documents; the later one revises days after the 10th."""
    d1, d2 = fx_docs(spark, sf_dir)
    b1 = _land_docs(spark, root + "/l1", FX, d1, LOAD_1)
    b2 = _land_docs(spark, root + "/l2", FX, d2, LOAD_2)
    return b1.unionByName(b2)


FX_STG_SQL = f"""px as (select cast(o_orderdate as date) as d, o_orderpriority as k,
    cast(max(o_totalprice) as decimal(18,6)) as p from orders group by 1, 2),
stg_fx as (select d as effective_date, {_sql_case('k', CURRENCIES, 0)} as currency_code,
    {_sql_case('k', CURRENCIES, 1)} as currency_name,
    cast(case when day(d) <= 10 then p + 1 else p end as decimal(18,6)) as mid_rate from px)"""


OIL_DS = "eia/spot"


def oil_docs(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    a = li.groupBy(F.col("l_shipdate").cast("date").alias("d"), F.col("l_returnflag").alias("f")).agg(
        (F.min(F.col("l_extendedprice").cast("decimal(18,2)")) * F.lit(0.01).cast("decimal(3,2)"))
        .alias("v"))
    val = (F.when(F.dayofmonth("d") == 1, F.lit("null"))
           .when(F.col("f") == "N", F.concat(F.lit('"'), F.col("v").cast("string"), F.lit('"')))
           .otherwise(F.col("v").cast("string")))
    rows = a.select("d", "f", F.to_json(F.struct(
        F.date_format("d", "yyyy-MM-dd").alias("period"), _map("f", OIL, 0).alias("series"),
        _map("f", OIL, 1).alias("product-name"), F.parse_json(val).alias("value"),
        F.lit("$/BBL").alias("units"))).alias("j"))
    g = rows.groupBy("f", F.year("d").alias("y")).agg(
        F.sort_array(F.collect_list(F.struct("d", "j"))).alias("a"))
    text = F.concat(F.lit('{"response":{"data":['), F.array_join(F.transform("a", lambda x: x["j"]), ","),
                    F.lit("]}}"))
    docs = g.select(F.concat(F.col("y").cast("string"), F.lit("-01-01")).alias("ingest_date"),
                    text.alias("value"))
    return docs


def oil_bronze(spark, sf_dir, root):
    return _land_docs(spark, root, OIL_DS, oil_docs(spark, sf_dir), LOAD_1)


OIL_STG_SQL = f"""oil_src as (select cast(l_shipdate as date) as d, l_returnflag as f,
    min(cast(l_extendedprice as decimal(18,2))) * cast(0.01 as decimal(3,2)) as v
    from lineitem group by 1, 2),
stg_oil as (select d as price_date, {_sql_case('f', OIL, 0)} as series,
    {_sql_case('f', OIL, 1)} as product_name, cast(v as decimal(18,6)) as price, '$/BBL' as units
    from oil_src where day(d) <> 1)"""


WEATHER_DS = "openmeteo/warsaw_daily"


def weather_docs(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    a = li.groupBy(F.col("l_shipdate").cast("date").alias("d")).agg(
        (F.max("l_quantity") - 20).alias("tmax"), (F.min("l_quantity") - 20).alias("tmin"),
        (F.min("l_discount") * 100).alias("pr"))
    g = a.groupBy(F.year("d").alias("y")).agg(F.sort_array(F.collect_list(
        F.struct("d", "tmax", "tmin", "pr"))).alias("a"))
    day = lambda x: F.dayofmonth(x["d"])
    daily = F.struct(
        F.transform("a", lambda x: F.date_format(x["d"], "yyyy-MM-dd")).alias("time"),
        F.transform("a", lambda x: F.when(day(x) != 1, x["tmax"])).alias("temperature_2m_max"),
        F.transform("a", lambda x: F.when(day(x) != 2, x["tmin"])).alias("temperature_2m_min"),
        F.slice(F.transform("a", lambda x: F.when(day(x) != 3, x["pr"])), 1, F.size("a") - 1)
        .alias("precipitation_sum"))
    docs = g.select(F.concat(F.col("y").cast("string"), F.lit("-01-01")).alias("ingest_date"),
                    F.to_json(F.struct(F.lit(LATITUDE).alias("latitude"),
                                       F.lit(LONGITUDE).alias("longitude"),
                                       daily.alias("daily"))).alias("value"))
    return docs


def weather_bronze(spark, sf_dir, root):
    return _land_docs(spark, root, WEATHER_DS, weather_docs(spark, sf_dir), LOAD_1)


WEATHER_STG_SQL = f"""w_src as (select cast(l_shipdate as date) as d, max(l_quantity) - 20 as tmax,
    min(l_quantity) - 20 as tmin, min(l_discount) * 100 as pr from lineitem group by 1),
w_last as (select *, row_number() over (partition by year(d) order by d desc) as rd from w_src),
stg_weather as (select d as weather_date, cast({LATITUDE} as decimal(9,4)) as latitude,
    cast({LONGITUDE} as decimal(9,4)) as longitude, tmax as temp_max_c,
    case when day(d) <> 2 then tmin end as temp_min_c,
    round((tmax + case when day(d) <> 2 then tmin end) / 2, 2) as temp_avg_c,
    case when day(d) <> 3 and rd <> 1 then pr end as precip_mm
    from w_last where day(d) <> 1)"""


CIVIL_DS = "eurostat/civil_eng"


def civil_docs(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    m = li.groupBy(F.trunc(F.col("l_shipdate").cast("date"), "month").alias("m")).agg(
        F.count(F.lit(1)).alias("n"))
    idx = F.month("m") - 1
    g = m.groupBy(F.year("m").alias("y")).agg(
        F.map_from_entries(F.collect_list(F.struct(F.date_format("m", "yyyy-MM"), idx))).alias("index"),
        F.map_from_entries(F.collect_list(F.when(F.month("m") != 2, F.struct(
            idx.cast("string"), (F.col("n") * F.lit(0.01).cast("decimal(3,2)")))))).alias("value"))
    doc = F.struct(F.struct(F.struct(F.struct(F.col("index").alias("index")).alias("category"))
                            .alias("time")).alias("dimension"), F.col("value"))
    docs = g.select(F.concat(F.col("y").cast("string"), F.lit("-01-01")).alias("ingest_date"),
                    F.to_json(doc).alias("value"))
    return docs


def civil_bronze(spark, sf_dir, root):
    return _land_docs(spark, root, CIVIL_DS, civil_docs(spark, sf_dir), LOAD_1)


CIVIL_STG_SQL = """stg_civil as (select cast(date_trunc('month', l_shipdate) as date) as period_date,
    cast(count(*) * cast(0.01 as decimal(3,2)) as decimal(18,4)) as index_value
    from lineitem group by 1 having month(period_date) <> 2)"""


ROADS_DS = "gus/expressways"


def roads_docs(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    y = o.groupBy(F.year("o_orderdate").alias("y")).agg(F.count(F.lit(1)).alias("n"))
    areas = None
    for area, f in ROAD_AREAS.items():
        vals = y.select(F.lit(area).alias("area"), F.struct(
            F.col("y").cast("string").alias("year"),
            (F.col("n") * F.lit(f).cast("decimal(3,2)")).alias("val")).alias("v"))
        areas = vals if areas is None else areas.unionByName(vals)
    g = areas.groupBy("area").agg(F.sort_array(F.collect_list("v")).alias("values"))
    docs = g.select(F.lit("2026-01-01").alias("ingest_date"), F.to_json(F.struct(F.array(F.struct(
        F.col("area").alias("name"), F.col("values"))).alias("results"))).alias("value"))
    return docs


def roads_bronze(spark, sf_dir, root):
    return _land_docs(spark, root, ROADS_DS, roads_docs(spark, sf_dir), LOAD_1)


ROADS_STG_SQL = f"""stg_roads as (select cast(cast(year(o_orderdate) as varchar) || '-01-01' as date) as period_date,
    'POLSKA' as area, cast(count(*) * cast({ROAD_AREAS['POLSKA']} as decimal(3,2)) as decimal(18,2)) as road_km
    from orders group by 1)"""


def rates_csv(spark, sf_dir):
    """The wide rate CSV rows (29 columns, header names C1..C29)."""
    o = table(spark, sf_dir, "orders")
    # A daily rate in [0, 25) percent, inside the declared test range at any
    # scale: the smallest order total of the day modulo 2,500, in hundredths.
    a = o.groupBy(F.col("o_orderdate").cast("date").alias("d")).agg(
        ((F.min(F.col("o_totalprice").cast("decimal(18,2)")) % F.lit(2500))
         * F.lit(0.01).cast("decimal(3,2)")).alias("r"))
    cols = {i: F.lit(f"x{i}") for i in range(1, ECB_COLUMNS + 1)}
    cols[1] = F.lit(RATE_SERIES)
    cols[5] = F.date_format("d", "yyyy-MM-dd")
    cols[6] = F.when(F.dayofmonth("d") != 1, F.col("r").cast("string"))
    cols[25] = F.lit(RATE_TITLE)
    cols[28] = F.lit("PCT")
    return a.select(*[cols[i].alias(f"C{i}") for i in range(1, ECB_COLUMNS + 1)])


def rates_bronze(spark, sf_dir, root):
    path = root + "/ecb"
    rates_csv(spark, sf_dir).write.option("header", True).csv(path)
    return read_positional_csv(spark, path, ECB_COLUMNS, ECB_POSITIONS, LOAD_1, pattern=r".*\.csv$")


RATES_STG_SQL = f"""stg_rates as (select cast(o_orderdate as date) as rate_date, '{RATE_SERIES}' as series_key,
    cast((min(cast(o_totalprice as decimal(18,2))) % 2500) * cast(0.01 as decimal(3,2)) as decimal(18,6)) as rate_pct
    from orders group by 1 having day(rate_date) <> 1)"""


# --- registered marts ------------------------------------------------------------

def _series_sql(name, source, key, order, value):
    """A CTE that puts each observation beside the one before it in its series."""
    return f"""{name} as (select cur.*, old.{value} as before from
  (select *, row_number() over (partition by {key} order by {order}) as nth from {source}) cur
  left join (select {key}, {value}, row_number() over (partition by {key} order by {order}) + 1 as nth
             from {source}) old using ({key}, nth))"""


def _growth_sql(value, places=4, width=18):
    """Percentage growth over the observation before, rounded."""
    return f"cast(round(({value} / nullif(before, 0) - 1) * 100, {places}) as decimal({width},{places}))"


def _window_sql(fn, value, rows, key, order, places):
    """A trailing row window of one series, rounded."""
    return (f"cast(round({fn}({value}) over (partition by {key} order by {order} "
            f"rows {rows - 1} preceding), {places}) as decimal(18,{places}))")


def _pivot_sql(source, on, key, value, names):
    """One row per ``on``, one column per code of ``names``."""
    cells = ", ".join(f"max({value}) filter ({key} = '{code}') as {name}" for code, name in names.items())
    return f"(select {on}, {cells} from {source} group by {on})"


def _tags_sql(tags):
    return ", ".join(f"'{v}' as {k}" for k, v in tags.items())

@query("mart_fx_rates", f"""with {FX_STG_SQL},
{_series_sql('steps', 'stg_fx', 'currency_code', 'effective_date', 'mid_rate')},
moves as (select *, mid_rate / nullif(before, 0) - 1 as move from steps)
select {sk_sql('effective_date', 'currency_code')} as fx_rate_key, {dk_sql('effective_date')} as date_key,
  currency_code, effective_date as rate_date, mid_rate, before as prev_mid_rate, mid_rate - before as change_abs,
  {_growth_sql('mid_rate')} as daily_change_pct,
  {_window_sql('avg', 'mid_rate', 7, 'currency_code', 'effective_date', 6)} as ma_7d,
  {_window_sql('avg', 'mid_rate', 30, 'currency_code', 'effective_date', 6)} as ma_30d,
  {_window_sql('stddev_samp', 'move', 30, 'currency_code', 'effective_date', 8)} as volatility_30d
from moves""", "M1 M7 M10 C7 J3 J4 W1")
def q_mart_fx_rates(spark, sf_dir):
    f = feeds.fct_fx_rates(feeds.stg_fx_rates(fx_bronze(spark, sf_dir, scratch_path(spark, "fx"))))
    return f.select("fx_rate_key", "date_key", "currency_code", "rate_date", "mid_rate",
                    "prev_mid_rate", "change_abs",
                    F.col("daily_change_pct").cast("decimal(18,4)").alias("daily_change_pct"),
                    F.col("ma_7d").cast("decimal(18,6)").alias("ma_7d"),
                    F.col("ma_30d").cast("decimal(18,6)").alias("ma_30d"),
                    F.col("volatility_30d").cast("decimal(18,8)").alias("volatility_30d"))


_CROSS_SQL = ", ".join(f"cast(round(mid_rate / nullif({n}, 0), 6) as decimal(18,6)) as {n}_per_unit"
                       for n in feeds.FX_ANCHORS.values())


@query("mart_fx_cross_rates", f"""with {FX_STG_SQL}
select {dk_sql('effective_date')} as date_key, currency_code, effective_date as rate_date,
  mid_rate as pln_per_unit, {_CROSS_SQL}
from {_pivot_sql('stg_fx', 'effective_date', 'currency_code', 'mid_rate', feeds.FX_ANCHORS)} anchors
join stg_fx using (effective_date)""", "M1 M11 K1")
def q_mart_fx_cross_rates(spark, sf_dir):
    return feeds.fct_fx_cross_rates(feeds.stg_fx_rates(fx_bronze(spark, sf_dir, scratch_path(spark, "fx"))))


@query("mart_dim_currency", f"""with {FX_STG_SQL}
select currency_code, arg_max(currency_name, effective_date) as currency_name,
  list_contains({list(feeds.MAJOR_CURRENCIES)}, currency_code) as is_major
from stg_fx group by currency_code""",
       "M9 D4")
def q_mart_dim_currency(spark, sf_dir):
    return feeds.dim_currency(feeds.stg_fx_rates(fx_bronze(spark, sf_dir, scratch_path(spark, "fx"))))


@query("mart_commodity_prices", f"""with {OIL_STG_SQL},
{_series_sql('steps', 'stg_oil', 'series', 'price_date', 'price')}
select {sk_sql('price_date', 'series')} as price_key, {dk_sql('price_date')} as date_key, price_date,
  series, product_name, price, units, before as prev_price, price - before as change_abs,
  {_growth_sql('price')} as change_pct
from steps""", "M2 M12 J1 J2 J9 W2 F6")
def q_mart_commodity_prices(spark, sf_dir):
    f = feeds.fct_commodity_prices(feeds.stg_petroleum_spot(
        oil_bronze(spark, sf_dir, scratch_path(spark, "oil"))))
    return f.withColumn("change_pct", F.col("change_pct").cast("decimal(18,4)"))


@query("mart_interest_rates", f"""with {RATES_STG_SQL},
{_series_sql('steps', 'stg_rates', 'series_key', 'rate_date', 'rate_pct')}
select md5(concat_ws('|', rate_date, series_key)) as rate_key, {dk_sql('rate_date')} as date_key,
  rate_date, series_key, '{RATE_TITLE}' as series_name, rate_pct, before as prev_rate_pct,
  cast(round(rate_pct - before, 6) as decimal(18,6)) as change_pct_pt,
  cast(round(rate_pct - before, 6) as decimal(18,6)) as change_bps_pt
from steps""", "M6 M13 S6 W2")
def q_mart_interest_rates(spark, sf_dir):
    f = feeds.fct_interest_rates(feeds.stg_estr(rates_bronze(spark, sf_dir, scratch_path(spark, "ecb"))))
    return f.withColumns({c: F.col(c).cast("decimal(18,6)") for c in ("change_pct_pt", "change_bps_pt")})


@query("mart_weather_daily", f"""with {WEATHER_STG_SQL}
select md5(cast(weather_date as varchar) || '|' || cast(latitude as varchar) || '|' ||
    cast(longitude as varchar)) as weather_key, {dk_sql('weather_date')} as date_key, weather_date,
  latitude, longitude, temp_max_c, temp_min_c, temp_avg_c, precip_mm,
  case when temp_avg_c is null then null else greatest(0, 18 - temp_avg_c) end as heating_degree_days,
  precip_mm > 0 as is_rainy
from stg_weather""", "M3 M14 J5 J9 F9 F13 P8 T1 T10")
def q_mart_weather_daily(spark, sf_dir):
    f = feeds.fct_weather_daily(feeds.stg_weather(weather_bronze(spark, sf_dir, scratch_path(spark, "w"))))
    return f.withColumn("heating_degree_days", F.col("heating_degree_days").cast("double"))


@query("mart_construction_activity", f"""with {CIVIL_STG_SQL}, {ROADS_STG_SQL},
tall as (
  select period_date, cast(index_value as decimal(20,4)) as value, {_tags_sql(feeds.EUROSTAT_TAGS)} from stg_civil
  union all by name
  select {_tags_sql(feeds.GUS_TAGS)}, cast(road_km as decimal(20,4)) as value, period_date from stg_roads)
select {sk_sql('period_date', 'source_name', 'indicator')} as activity_key, {dk_sql('period_date')} as date_key, *
from tall""", "M4 M5 M15 J4 J6 J7 U1")
def q_mart_construction_activity(spark, sf_dir):
    root = scratch_path(spark, "act")
    civ = feeds.stg_civil_eng(civil_bronze(spark, sf_dir, root + "/civ"))
    roads = feeds.stg_expressways(roads_bronze(spark, sf_dir, root + "/gus"))
    f = feeds.fct_construction_activity(civ, roads)
    return f.withColumn("value", F.col("value").cast("decimal(20,4)"))


def market_signals_from_feeds(spark, sf_dir):
    """M16 over the derived feeds: all six models feed the wide daily mart.

    The documents of one load are landed by one write job (one union of all
    feeds); each bronze reader then lists only its feed's folder.
    """
    root = scratch_path(spark, "m16")
    fx1, fx2 = fx_docs(spark, sf_dir)
    first = [(FX, fx1), (OIL_DS, oil_docs(spark, sf_dir)), (WEATHER_DS, weather_docs(spark, sf_dir)),
             (CIVIL_DS, civil_docs(spark, sf_dir)), (ROADS_DS, roads_docs(spark, sf_dir))]
    union = None
    for ds, docs in first:
        union = _landed(docs, ds) if union is None else union.unionByName(_landed(docs, ds))
    write_landing(union, root + "/l1")
    write_landing(_landed(fx2, FX), root + "/l2")
    b = {ds: _read_landed(spark, root + "/l1", ds, LOAD_1) for ds, _ in first}
    fx_b = b[FX].unionByName(_read_landed(spark, root + "/l2", FX, LOAD_2))
    fx = feeds.fct_fx_rates(feeds.stg_fx_rates(fx_b))
    oil = feeds.fct_commodity_prices(feeds.stg_petroleum_spot(b[OIL_DS]))
    rates = feeds.fct_interest_rates(feeds.stg_estr(rates_bronze(spark, sf_dir, root + "/ecb")))
    weather = feeds.fct_weather_daily(feeds.stg_weather(b[WEATHER_DS]))
    act = feeds.fct_construction_activity(feeds.stg_civil_eng(b[CIVIL_DS]),
                                          feeds.stg_expressways(b[ROADS_DS]))
    cal = dim_date(calendar_years(spark, sf_dir))
    return feeds.fct_daily_market_signals(spark, fx, oil, rates, weather, act, calendar=cal)


# The daily mart: per feed, (rows, date column, output columns) as of each market day.
_DAILY_FEEDS = (
    (_pivot_sql("stg_fx", "effective_date", "currency_code", "mid_rate",
                {c: f"{n}_pln" for c, n in feeds.FX_ANCHORS.items()}), "effective_date",
     [f"{n}_pln" for n in feeds.FX_ANCHORS.values()]),
    (_pivot_sql("stg_oil", "price_date", "series", "price", feeds.OIL_SERIES), "price_date",
     list(feeds.OIL_SERIES.values())),
    ("(select rate_date, rate_pct as estr_pct from stg_rates)", "rate_date", ["estr_pct"]),
    (f"(select weather_date, temp_avg_c, if(temp_avg_c is null, null, greatest({feeds.HDD_BASE_C} - temp_avg_c, 0)) "
     "as heating_degree_days from stg_weather)", "weather_date", ["temp_avg_c", "heating_degree_days"]),
    ("(select period_date, cast(index_value as decimal(20,4)) as civil_eng_index from stg_civil)", "period_date",
     ["civil_eng_index"]),
    ("(select period_date, cast(road_km as decimal(20,4)) as motorway_km from stg_roads)", "period_date",
     ["motorway_km"]),
)
MARKET_SIGNALS_SQL = (
    f"with {FX_STG_SQL}, {OIL_STG_SQL}, {RATES_STG_SQL}, {WEATHER_STG_SQL}, {CIVIL_STG_SQL}, {ROADS_STG_SQL}, {CAL_SQL}, "
    "days as (select date_day as market_date from cal, (select min(effective_date) as a, max(effective_date) as b "
    f"from stg_fx) where date_day between a and b) select {dk_sql('market_date')} as date_key, market_date, "
    + ", ".join(f"f{i}.{c}" for i, (_, _, cols) in enumerate(_DAILY_FEEDS) for c in cols) + " from days "
    + " ".join(f"asof left join {rows} f{i} on market_date >= f{i}.{day}"
               for i, (rows, day, _) in enumerate(_DAILY_FEEDS)))


@query("mart_daily_market_signals", MARKET_SIGNALS_SQL, "M16 K3 K2 D3 A1 M1-M6")
def q_mart_daily_market_signals(spark, sf_dir):
    m = market_signals_from_feeds(spark, sf_dir)
    return m.withColumn("heating_degree_days", F.col("heating_degree_days").cast("double")) \
        .withColumn("civil_eng_index", F.col("civil_eng_index").cast("decimal(20,4)")) \
        .withColumn("motorway_km", F.col("motorway_km").cast("decimal(20,4)"))


# --- the daily build end to end -------------------------------------------------

BUILD_TS = "2026-04-21 06:00:00"


def derived_feed_list():
    """The six bronze feeds for files landed by this module: selected by
    their landing folder, one document per line."""
    from ..sources.bronze import FEEDS, Feed
    folders = {"nbp_fx_rates_raw": FX, "eia_petroleum_spot_raw": OIL_DS,
               "openmeteo_weather_raw": WEATHER_DS, "eurostat_civil_eng_raw": CIVIL_DS,
               "gus_roads_raw": ROADS_DS, "ecb_estr_raw": "ecb/estr"}
    out = []
    for f in FEEDS:
        src, ds = _split(folders[f.table])
        pat = f".*/source={src}/dataset={ds}/.*" + (r"[.]csv$" if f.fmt == "csv" else "")
        out.append(Feed(f.table, pat, f.fmt, f.on_error, whole_file=False))
    return tuple(out)


@query("marts_published", MARKET_SIGNALS_SQL, "M19 S9 S10 S12 Q6 Q9 M1-M16")
def q_marts_published(spark, sf_dir):
    """Land the six derived feeds, load them to bronze (two loads: the FX
    revision lands later), build every model behind its data tests and the
    freshness gate, and return the published daily mart."""
    from ..sources.bronze import load_feeds
    from .build import build_marts
    root = scratch_path(spark, "build")
    land, bronze, out = root + "/landing", root + "/bronze", root + "/marts"
    fx1, fx2 = fx_docs(spark, sf_dir)
    first = [(FX, fx1), (OIL_DS, oil_docs(spark, sf_dir)), (WEATHER_DS, weather_docs(spark, sf_dir)),
             (CIVIL_DS, civil_docs(spark, sf_dir)), (ROADS_DS, roads_docs(spark, sf_dir))]
    union = None
    for ds, docs in first:
        union = _landed(docs, ds) if union is None else union.unionByName(_landed(docs, ds))
    write_landing(union, land)
    (rates_csv(spark, sf_dir).write.option("header", True)
     .csv(f"{land}/source=ecb/dataset=estr/ingest_date=2026-04-20"))
    feed_list = derived_feed_list()
    load_feeds(spark, land, bronze, LOAD_1, feed_list)
    write_landing(_landed(fx2.withColumn("ingest_date", F.lit("2026-04-21")), FX), land)
    load_feeds(spark, land, bronze, LOAD_2, feed_list)
    build_marts(spark, bronze, out, BUILD_TS, calendar=calendar_years(spark, sf_dir))
    m = read_table(spark, out + "/fct_daily_market_signals")
    return (m.withColumn("heating_degree_days", F.col("heating_degree_days").cast("double"))
            .withColumn("civil_eng_index", F.col("civil_eng_index").cast("decimal(20,4)"))
            .withColumn("motorway_km", F.col("motorway_km").cast("decimal(20,4)")))
