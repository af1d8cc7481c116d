"""Sources and the feed models on small hand-made documents (FIXTURES.md sections 2-4)."""

import datetime as dt
import json
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from seriesmart.plans import feeds
from seriesmart.sources.control import enabled_sources, landing_plan, read_control
from seriesmart.sources.landing import (incremental_load, list_files, pending_files, read_bronze,
                                        read_documents, read_positional_csv)

RUN1 = "2026-04-21 05:30:00"
RUN2 = "2026-04-22 05:30:00"


def D(s):
    return dt.date.fromisoformat(s)


def _write(root, rel, text):
    p = os.path.join(root, rel)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "w") as f:
        f.write(text)
    return p


def _local(tmp_root):
    return tmp_root.replace("file:", "")


CONTROL = {"schema_version": "1.0", "sources": [
    {"source_id": "fx", "enabled": True, "auth_type": "none", "base_url": "http://x/{ingest_date}",
     "landing_container": "raw", "landing_path_template": "source=fx/dataset=a/ingest_date={ingest_date}",
     "file_name_template": "fx_{ingest_date}.json", "date_window_days": 93, "frequency": "daily"},
    {"source_id": "old", "enabled": False, "auth_type": "none", "base_url": "u",
     "landing_container": "raw", "landing_path_template": "p", "file_name_template": "f.json",
     "frequency": "once"},
    {"source_id": "oil", "enabled": True, "auth_type": "api_key", "base_url": "u",
     "landing_container": "raw", "landing_path_template": "source=oil/ingest_date={ingest_date}",
     "file_name_template": "backfill.json", "date_window_days": None, "frequency": "annual"},
]}


def test_control_table(spark, tmp_root):
    root = _local(tmp_root)
    p = _write(root, "control/sources.json", json.dumps(CONTROL, indent=2))
    c = read_control(spark, p)
    assert c.count() == 3
    assert [r.source_id for r in enabled_sources(c, "none").collect()] == ["fx"]
    plan = {r.source_id: r for r in landing_plan(enabled_sources(c), "2026-04-21").collect()}
    assert plan["fx"].path == "raw/source=fx/dataset=a/ingest_date=2026-04-21/fx_2026-04-21.json"
    assert plan["fx"].url == "http://x/2026-04-21"
    assert plan["oil"].file == "backfill.json"  # no placeholder: unchanged
    bad = dict(CONTROL, sources=CONTROL["sources"] + [dict(CONTROL["sources"][0], source_id="h",
                                                           auth_type="oauth")])
    p2 = _write(root, "control2/sources.json", json.dumps(bad))
    with pytest.raises(Exception, match="unknown auth_type"):
        enabled_sources(read_control(spark, p2)).collect()


FX1 = [{"table": "A", "no": "075/A/2026", "effectiveDate": "2026-04-20",
        "rates": [{"currency": "dolar", "code": "USD", "mid": 3.6512},
                  {"currency": "euro", "code": "EUR", "mid": 4.2501}]},
       {"table": "A", "no": "076/A/2026", "effectiveDate": "2026-04-21", "rates": []}]
FX2 = [{"table": "A", "no": "075/A/2026", "effectiveDate": "2026-04-20",
        "rates": [{"currency": "dolar amerykanski", "code": "USD", "mid": 3.7}]}]


def test_documents_whole_file_and_fx_staging(spark, tmp_root):
    root = _local(tmp_root)
    _write(root, "source=nbp/ingest_date=2026-04-20/nbp_table_a_2026-04-20.json", json.dumps(FX1, indent=2))
    _write(root, "source=nbp/ingest_date=2026-04-21/nbp_table_a_2026-04-21.json", json.dumps(FX2, indent=2))
    _write(root, "source=nbp/ingest_date=2026-04-21/other.json", "{}")
    b1 = read_documents(spark, root + "/source=nbp/ingest_date=2026-04-20", RUN1, whole_file=True,
                        pattern=r".*nbp_table_a_.*[.]json")
    b2 = read_documents(spark, root + "/source=nbp/ingest_date=2026-04-21", RUN2, whole_file=True,
                        pattern=r".*nbp_table_a_.*[.]json")
    assert b1.count() == 1  # a top-level array stays one row (T15)
    stg = feeds.stg_fx_rates(b1.unionByName(b2, allowMissingColumns=True))
    rows = {r.currency_code: r for r in stg.collect()}
    assert set(rows) == {"USD", "EUR"}
    assert rows["USD"].mid_rate == Decimal("3.700000")  # later load wins
    dim = {r.currency_code: r for r in feeds.dim_currency(stg).collect()}
    assert dim["USD"].currency_name == "dolar amerykanski" and dim["USD"].is_major


def test_load_policies(spark, tmp_root):
    root = _local(tmp_root)
    _write(root, "docs/good.json", '{"a": 1}\n{"a": 2}\n')
    _write(root, "docs/bad.json", '{"a": 3}\n{"a": \n')
    with pytest.raises(Exception):
        read_documents(spark, root + "/docs", RUN1).collect()
    assert read_documents(spark, root + "/docs", RUN1, on_error="continue").count() == 3
    assert read_documents(spark, root + "/docs", RUN1, on_error="skip_file").count() == 2


def _csv_row(key, date, value, title):
    cells = [f"c{i}" for i in range(1, 30)]
    cells[0], cells[4], cells[5], cells[24], cells[27] = key, date, value, title, "pct"
    return ",".join(cells)


def test_positional_csv_and_estr(spark, tmp_root):
    root = _local(tmp_root)
    header = ",".join(f"H{i}" for i in range(1, 30))
    body = [_csv_row("EST.B", "2026-04-20", "1.912", '"Euro short-term rate, volume-weighted"'),
            _csv_row("EST.B", "2026-04-21", "", '"Euro short-term rate, volume-weighted"')]
    _write(root, "ecb/ecb_estr_1.csv", "\n".join([header] + body) + "\n")
    _write(root, "ecb/ecb_estr_2.csv", "\n".join([header, _csv_row("EST.B", "20-04-2026", "1.9", "t")]) + "\n")
    proj = {1: ("series_key", "string"), 5: ("obs_date", "date"), 6: ("obs_value", "decimal(18,6)"),
            25: ("title", "string"), 28: ("unit", "string")}
    with pytest.raises(Exception):
        read_positional_csv(spark, root + "/ecb", 29, proj, RUN1).collect()
    ok = read_positional_csv(spark, root + "/ecb", 29, proj, RUN1, on_error="skip_file")
    rows = ok.orderBy("obs_date").collect()
    assert [r.obs_value for r in rows] == [Decimal("1.912000"), None]
    assert rows[0].title == "Euro short-term rate, volume-weighted"
    stg = feeds.stg_estr(ok)
    assert stg.count() == 1
    fct = feeds.fct_interest_rates(stg).first()
    assert fct.prev_rate_pct is None and fct.change_pct_pt is None


def test_incremental_ledger(spark, tmp_root):
    root = _local(tmp_root)
    land, bronze = root + "/land", root + "/bronze"
    _write(land, "d=1/a.json", '{"v": 1}\n')
    assert incremental_load(spark, land, bronze, RUN1) == 1
    assert incremental_load(spark, land, bronze, RUN1) == 0
    _write(land, "d=2/b.json", '{"v": 2}\n')
    assert incremental_load(spark, land, bronze, RUN2) == 1
    # A rewritten file (new length) is pending again.
    _write(land, "d=1/a.json", '{"v": 1}\n{"v": 11}\n')
    assert pending_files(list_files(spark, land), spark.read.parquet(bronze + "/ledger")).count() == 1
    assert read_bronze(spark, bronze).count() == 2


OIL = {"response": {"data": [
    {"period": "2026-04-20", "series": "RWTC", "product-name": "WTI Crude Oil", "value": "71.23", "units": "$/BBL"},
    {"period": "2026-04-21", "series": "RWTC", "product-name": "WTI Crude Oil", "value": None, "units": "$/BBL"},
    {"period": "2026-04-22", "series": "RWTC", "product-name": "WTI Crude Oil", "value": 72.5, "units": "$/BBL"},
    {"period": "2026-04-20", "series": "RBRTE", "product-name": "Brent", "value": 75, "units": "$/BBL"}]}}
WEATHER = {"latitude": 52.23, "longitude": 21.01, "daily": {
    "time": ["2026-04-20", "2026-04-21", "2026-04-22", "2026-04-23"],
    "temperature_2m_max": [14.2, None, 22.0, 10.0], "temperature_2m_min": [5.1, 4.0, 20.0],
    "precipitation_sum": [0.0, None, 1.5, None]}}
STAT = {"dimension": {"time": {"category": {"index": {"2024-01": 0, "2024-02": 1, "2024-03": 2}}}},
        "value": {"0": 101.5, "2": 99.8}}
ROADS = {"results": [{"name": "POLSKA", "values": [{"year": "2023", "val": 5100.4}, {"year": "2024", "val": None}]},
                     {"name": "MAZOWIECKIE", "values": []}]}


def _bronze(spark, root, name, doc, run=RUN1):
    p = _write(root, f"{name}/{name}.json", json.dumps(doc))
    return read_documents(spark, p, run)


def test_feed_models_end_to_end(spark, tmp_root):
    root = _local(tmp_root)
    oil = feeds.stg_petroleum_spot(_bronze(spark, root, "eia_wti_spot", OIL))
    assert sorted((str(r.price_date), r.series, str(r.price)) for r in oil.collect()) == [
        ("2026-04-20", "RBRTE", "75.000000"), ("2026-04-20", "RWTC", "71.230000"),
        ("2026-04-22", "RWTC", "72.500000")]
    com = {(r.series, str(r.price_date)): r for r in feeds.fct_commodity_prices(oil).collect()}
    assert com[("RWTC", "2026-04-22")].prev_price == Decimal("71.23")

    w = feeds.stg_weather(_bronze(spark, root, "openmeteo", WEATHER))
    wr = {str(r.weather_date): r for r in feeds.fct_weather_daily(w).collect()}
    assert set(wr) == {"2026-04-20", "2026-04-22", "2026-04-23"}
    assert wr["2026-04-20"].temp_avg_c == pytest.approx(9.65)
    assert wr["2026-04-22"].heating_degree_days == 0.0
    assert wr["2026-04-23"].temp_min_c is None and wr["2026-04-23"].heating_degree_days is None
    assert wr["2026-04-23"].is_rainy is None

    civ = feeds.stg_civil_eng(_bronze(spark, root, "eurostat", STAT))
    assert sorted((str(r.period_date), str(r.index_value)) for r in civ.collect()) == [
        ("2024-01-01", "101.5000"), ("2024-03-01", "99.8000")]
    roads = feeds.stg_expressways(_bronze(spark, root, "gus", ROADS))
    assert [(str(r.period_date), r.area) for r in roads.collect()] == [("2023-01-01", "POLSKA")]
    act = feeds.fct_construction_activity(civ, roads)
    assert act.count() == 3

    fx_docs = [{"table": "A", "no": str(i), "effectiveDate": str(D("2026-04-20") + dt.timedelta(days=i)),
                "rates": [{"code": "USD", "currency": "d", "mid": 3.6 + i / 100},
                          {"code": "EUR", "currency": "e", "mid": 4.2}]} for i in range(4)]
    fx = feeds.stg_fx_rates(_bronze(spark, root, "nbp", fx_docs))
    fct = feeds.fct_fx_rates(fx)
    cross = feeds.fct_fx_cross_rates(fx)
    assert cross.filter(F.col("currency_code") == "USD").first().usd_per_unit == Decimal("1.000000")
    est = spark.createDataFrame([("K", D("2026-04-21"), Decimal("1.9"), "t", "s", dt.datetime(2026, 4, 21))],
                                "series_key string, obs_date date, obs_value decimal(18,6), title string, "
                                "_src_file string, _loaded_at timestamp_ntz")
    rates = feeds.fct_interest_rates(feeds.stg_estr(est))
    sig = feeds.fct_daily_market_signals(spark, fct, feeds.fct_commodity_prices(oil), rates,
                                         feeds.fct_weather_daily(w), act)
    out = {str(r.market_date): r for r in sig.collect()}
    assert sorted(out) == ["2026-04-20", "2026-04-21", "2026-04-22", "2026-04-23"]
    assert out["2026-04-20"].estr_pct is None and out["2026-04-21"].estr_pct == Decimal("1.9")
    assert out["2026-04-21"].wti_usd_bbl == Decimal("71.23")  # carried forward
    assert out["2026-04-23"].civil_eng_index == Decimal("99.8")
    assert out["2026-04-23"].motorway_km == Decimal("5100.4")


def test_load_feeds_policies_and_report(spark, tmp_root):
    from seriesmart.sources.bronze import FEEDS, Feed, LoadError, load_feeds
    root = _local(tmp_root)
    land, bronze = root + "/land", root + "/bronze"
    _write(land, "source=nbp/ingest_date=2026-04-20/nbp_table_a_2026-04-20.json", json.dumps(FX1, indent=2))
    _write(land, "source=eia/ingest_date=2026-04-20/eia_wti_spot_2026-04-20.json", json.dumps(OIL))
    _write(land, "source=gus/ingest_date=2026-04-20/gus_expressways_motorways_2026.json", "{broken")
    with pytest.raises(LoadError, match="gus_roads_raw"):
        load_feeds(spark, land, bronze, RUN1)
    # The other feeds loaded although a later one failed.
    assert spark.read.parquet(bronze + "/nbp_fx_rates_raw/data").count() == 1
    lenient = tuple(Feed(f.table, f.pattern, f.fmt, "skip_file") if f.table == "gus_roads_raw" else f
                    for f in FEEDS)
    def report():
        return {r.table: (r.files_loaded, r.files_skipped, r.records_rejected, r.status)
                for r in load_feeds(spark, land, bronze, RUN2, lenient).collect()}

    rep = report()
    assert rep["nbp_fx_rates_raw"] == (0, 0, 0, "nothing new")
    assert rep["gus_roads_raw"] == (0, 1, 1, "skipped")
    # Still pending: mended, it loads.
    _write(land, "source=gus/ingest_date=2026-04-20/gus_expressways_motorways_2026.json", json.dumps(ROADS))
    assert report()["gus_roads_raw"] == (1, 0, 0, "loaded")


def test_unparsable_value_stops_the_build(spark, tmp_root):
    root = _local(tmp_root)
    bad = {"response": {"data": [{"period": "2026-04-20", "series": "RWTC", "value": "7x"}]}}
    with pytest.raises(Exception, match="(?i)cast"):
        feeds.stg_petroleum_spot(_bronze(spark, root, "eia_bad", bad)).collect()
    w = dict(WEATHER, daily=dict(WEATHER["daily"], temperature_2m_max=["warm", None, 22.0, 10.0]))
    with pytest.raises(Exception, match="(?i)cast"):
        feeds.stg_weather(_bronze(spark, root, "openmeteo_bad", w)).collect()


def test_rejects_and_glob_names(spark, tmp_root):
    from seriesmart.sources.landing import load_pending, read_rejects
    root = _local(tmp_root)
    land, bronze = root + "/land", root + "/bronze"
    _write(land, "d=1/a[1].json", '{"v": 1}\n{"v": \n')
    got = load_pending(spark, land, bronze, RUN1, on_error="continue")
    assert (got.loaded, got.skipped, got.rejected) == (1, 0, 1)
    assert read_bronze(spark, bronze).count() == 1
    assert [r.record for r in read_rejects(spark, bronze).collect()] == ['{"v": ']


def test_touched_file_counts_once(spark, tmp_root):
    import os
    root = _local(tmp_root)
    land, bronze = root + "/land", root + "/bronze"
    p = _write(land, "d=1/a.json", '{"v": 1}\n')
    assert incremental_load(spark, land, bronze, RUN1) == 1
    os.utime(p, (2_000_000_000, 2_000_000_000))
    assert incremental_load(spark, land, bronze, RUN2) == 1
    assert read_bronze(spark, bronze).count() == 1


def test_publish_behind_gate(spark, tmp_root):
    from seriesmart.operators.merge import publish, read_table
    from seriesmart.operators.quality import QualityGateError, not_null
    good = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    bad = spark.createDataFrame([(1, None)], "k int, v string")
    assert publish(spark, good, tmp_root, [not_null("v")]) == 1
    with pytest.raises(QualityGateError):
        publish(spark, bad, tmp_root, [not_null("v")])
    assert read_table(spark, tmp_root).count() == 2  # previous version still current


def test_feeds_from_control(spark, tmp_root):
    from seriesmart.sources.bronze import feeds_from_control
    root = _local(tmp_root)
    c = read_control(spark, _write(root, "control/sources.json", json.dumps(CONTROL)))
    fs = {f.table: f for f in feeds_from_control(c)}
    assert set(fs) == {"fx_raw", "oil_raw"}
    import re
    assert re.match(fs["fx_raw"].pattern, "/x/ingest_date=2026-04-21/fx_2026-04-21.json")
    assert not re.match(fs["fx_raw"].pattern, "/x/other.json")


def test_validate_control(spark, tmp_root):
    from seriesmart.operators.quality import gate
    from seriesmart.sources.control import validate_control
    root = _local(tmp_root)
    c = read_control(spark, _write(root, "control/sources.json", json.dumps(CONTROL)))
    rep = {r.check_name: (r.severity, r.failures) for r in validate_control(c).collect()}
    assert rep["accepted_values_frequency"] == ("warn", 2)  # "once" and "annual" (T13b)
    assert rep["accepted_values_auth_type"] == ("error", 0)
    warned = gate(validate_control(c))  # warnings do not block
    assert [w["check_name"] for w in warned] == ["accepted_values_frequency"]


def test_tie_break_by_content_is_deterministic(spark, tmp_root):
    from seriesmart.operators.nested import distinct_documents
    root = _local(tmp_root)
    doc = [{"table": "A", "no": "1", "effectiveDate": "2026-04-20",
            "rates": [{"code": "USD", "currency": "d", "mid": 3.1}, {"code": "USD", "currency": "d", "mid": 3.2}]}]
    p = _write(root, "tie/nbp_table_a_1.json", json.dumps(doc))
    picks = {feeds.stg_fx_rates(read_documents(spark, p, RUN1, whole_file=True)).first().mid_rate
             for _ in range(3)}
    assert len(picks) == 1
    twice = read_documents(spark, p, RUN1, whole_file=True).unionByName(
        read_documents(spark, p, RUN2, whole_file=True))
    assert distinct_documents(twice).count() == 1


def test_daily_run_with_reference_file_names(spark, tmp_root):
    """Files under the reference's names and shapes, the production feed list
    (whole-file documents), the daily run end to end."""
    from seriesmart.daily import run_daily
    from seriesmart.operators.merge import read_table
    root = _local(tmp_root)
    land = root + "/raw"
    day = "ingest_date=2026-04-21"
    _write(land, f"source=nbp/dataset=a/{day}/nbp_table_a_2026-04-21.json", json.dumps(FX1, indent=2))
    _write(land, f"source=eia/dataset=wti/{day}/eia_wti_spot_2026-04-21.json", json.dumps(OIL))
    _write(land, f"source=om/dataset=w/{day}/openmeteo_warsaw_2026-04-21.json", json.dumps(WEATHER))
    _write(land, f"source=es/dataset=c/{day}/eurostat_civil_eng_2026-04-21.json", json.dumps(STAT))
    _write(land, f"source=gus/dataset=r/{day}/gus_expressways_motorways_2026-04-21.json", json.dumps(ROADS))
    header = ",".join(f"H{i}" for i in range(1, 30))
    _write(land, f"source=ecb/dataset=estr/{day}/ecb_estr_2026-04-21.csv",
           "\n".join([header, _csv_row("EST.B", "2026-04-20", "1.912", '"Euro short-term rate, vw"')]) + "\n")
    names = {"fx": "nbp_table_a_{ingest_date}.json", "wti": "eia_wti_spot_{ingest_date}.json",
             "brent": "eia_brent_spot_{ingest_date}.json", "weather": "openmeteo_warsaw_{ingest_date}.json",
             "civil": "eurostat_civil_eng_{ingest_date}.json", "estr": "ecb_estr_{ingest_date}.csv",
             "roads": "gus_expressways_motorways_{ingest_date}.json", "off": "off_{ingest_date}.json"}
    records = [dict(CONTROL["sources"][0], source_id=k, file_name_template=n, enabled=k != "off",
                    response_format=n.rsplit(".", 1)[1]) for k, n in names.items()]
    control = _write(root, "control/sources.json", json.dumps({"schema_version": "1.0", "sources": records}))
    report, versions = run_daily(spark, land, root + "/bronze", root + "/marts",
                                 "2026-04-21 06:00:00", control=control)
    assert {r.table: r.files_loaded for r in report.collect()} == {
        "nbp_fx_rates_raw": 1, "eia_petroleum_spot_raw": 1, "openmeteo_weather_raw": 1,
        "ecb_estr_raw": 1, "eurostat_civil_eng_raw": 1, "gus_roads_raw": 1}
    assert versions.count() == 17
    sig = {str(r.market_date): r for r in read_table(spark, root + "/marts/fct_daily_market_signals").collect()}
    assert sorted(sig) == ["2026-04-20"]
    assert sig["2026-04-20"].usd_pln == Decimal("3.651200")
    assert sig["2026-04-20"].estr_pct == Decimal("1.912000")
