"""Unit tests on hand-made inputs (FIXTURES.md section 5) and invariants."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from seriesmart.functions.calendar import bounded_spine, date_spine, dim_date
from seriesmart.functions.keys import pipe_key, surrogate_key
from seriesmart.functions.scalar import degree_days
from seriesmart.operators.asof import asof_join, multi_asof
from seriesmart.operators.dedupe import latest_wins
from seriesmart.operators.merge import merge_upsert, read_table
from seriesmart.operators.pivot import cross_rates, pivot_series
from seriesmart.operators.quality import (QualityGateError, accepted_range, accepted_values,
                                          freshness, gate, not_null, reconcile, run_checks,
                                          unique)
from seriesmart.operators.scd2 import scd2_apply, scd2_replay
from seriesmart.operators.series import returns_and_rolling, with_change


def D(s):
    return dt.date.fromisoformat(s)


def test_returns_guarded_division(spark):
    df = spark.createDataFrame(
        [("s", D("2024-01-0%d" % i), Decimal(p)) for i, p in enumerate(["10", "11", "0", "5"], 1)],
        "k string, d date, p decimal(18,6)")
    out = with_change(df, ["k"], "d", "p").orderBy("d").collect()
    assert [r.daily_return for r in out] == [None, Decimal("0.1"), Decimal("-1"), None]


def test_rolling_frames_and_volatility_start(spark):
    rows = [("s", D("2024-01-01") + dt.timedelta(days=i), Decimal(i + 1)) for i in range(31)]
    df = spark.createDataFrame(rows, "k string, d date, p decimal(18,6)")
    out = returns_and_rolling(df, ["k"], "d", "p").orderBy("d").collect()
    assert out[0].ma_long == Decimal(1)
    assert out[30].ma_long == sum(Decimal(i) for i in range(2, 32)) / 30  # row 1 left the frame
    assert out[0].volatility_long is None and out[1].volatility_long is None
    assert out[2].volatility_long is not None


def test_halo_chunks_equal_plain_windows(spark):
    rows = [(k, D("1990-01-01") + dt.timedelta(days=i), Decimal((i * 37 + len(k)) % 101 + 1))
            for k in ("a", "b", "c") for i in range(0, 3000, 1 + len(k))]
    df = spark.createDataFrame(rows, "k string, d date, p decimal(18,6)")
    plain = returns_and_rolling(df, ["k"], "d", "p")
    halo = returns_and_rolling(df, ["k"], "d", "p", halo_chunk=64)
    assert plain.count() == halo.count() == len(rows)
    assert plain.exceptAll(halo).count() == 0 and halo.exceptAll(plain).count() == 0


def test_cross_rates_missing_anchor_keeps_row(spark):
    df = spark.createDataFrame([(D("2024-01-01"), "USD", Decimal("4")), (D("2024-01-01"), "GBP", Decimal("5")),
                                (D("2024-01-02"), "GBP", Decimal("6"))],
                               "d date, c string, r decimal(18,6)")
    out = {(r.d, r.c): r for r in cross_rates(df, "d", "c", "r", {"USD": "usd"}).collect()}
    assert out[(D("2024-01-01"), "GBP")].usd_per_unit == Decimal("1.25")
    assert out[(D("2024-01-02"), "GBP")].usd_per_unit is None


def test_pivot_listed_codes_only(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (2, "a", 3.0), (2, "z", 9.0)],
                               "i int, s string, v double")
    out = {r.i: r for r in pivot_series(df, "i", "s", "v", {"a": "va", "b": "vb"}).collect()}
    assert (out[1].va, out[1].vb, out[2].va, out[2].vb) == (1.0, 2.0, 3.0, None)


def _spine(spark, n=5):
    return spark.createDataFrame([(D("2024-01-0%d" % i),) for i in range(1, n + 1)], "day date")


def test_asof_keeps_nulls_inside_matched_row(spark):
    feed = spark.createDataFrame([(D("2024-01-02"), 2.0, "x"), (D("2024-01-04"), None, "y")],
                                 "fd date, v double, w string")
    out = asof_join(_spine(spark), feed, "day", "fd", left_unique=True).orderBy("day").collect()
    assert [r.v for r in out] == [None, 2.0, 2.0, None, None]
    assert [r.w for r in out] == [None, "x", "x", "y", "y"]


def test_asof_directions_exactness_tolerance(spark):
    feed = spark.createDataFrame([(D("2024-01-02"), 2), (D("2024-01-04"), 4)], "fd date, v int")
    sp = _spine(spark)

    def vals(**kw):
        return [r.v for r in asof_join(sp, feed, "day", "fd", **kw).orderBy("day").collect()]

    assert vals(allow_exact=False) == [None, None, 2, 2, 4]
    assert vals(direction="forward") == [2, 2, 4, 4, None]
    assert vals(tolerance=0) == [None, 2, None, 4, None]


def test_asof_crosses_buckets_and_keys(spark):
    # Right rows in earlier months must carry into later months; keys separate.
    feed = spark.createDataFrame([(1, D("2023-11-30"), 1), (2, D("2024-01-01"), 2), (1, D("2024-03-01"), 3)],
                                 "u int, fd date, v int")
    left = spark.createDataFrame([(1, D("2024-02-15")), (2, D("2024-02-15")), (1, D("2024-03-01")),
                                  (3, D("2024-03-01")), (1, D("2024-02-15"))], "u int, day date")
    out = sorted((r.u, r.day, r.v) for r in asof_join(left, feed, "day", "fd", by=["u"]).collect())
    assert out == [(1, D("2024-02-15"), 1), (1, D("2024-02-15"), 1), (1, D("2024-03-01"), 3),
                   (2, D("2024-02-15"), 2), (3, D("2024-03-01"), None)]


def test_multi_asof_equals_chained_joins(spark):
    sp = spark.createDataFrame([(D("2023-12-25") + dt.timedelta(days=i),) for i in range(90)], "day date")
    daily = spark.createDataFrame([(D("2024-01-01") + dt.timedelta(days=i), i) for i in range(0, 60, 3)],
                                  "d1 date, a int")
    monthly = spark.createDataFrame([(D("2023-11-01"), 10), (D("2024-02-01"), None)], "d2 date, b int")
    m = multi_asof(sp, "day", {"x": (daily, "d1", ["a"]), "y": (monthly, "d2", ["b"])})
    c = asof_join(asof_join(sp, daily, "day", "d1"), monthly, "day", "d2").select("day", "a", "b")
    assert m.exceptAll(c).count() == 0 and c.exceptAll(m).count() == 0 and m.count() == 90


def test_calendar(spark):
    s = date_spine(spark, "2000-01-01", "2027-01-01")
    assert s.count() == 9862
    assert s.agg(F.max("date_day")).first()[0] == D("2026-12-31")
    d = {r.full_date: r for r in dim_date(date_spine(spark, "2024-04-01", "2024-04-08")).collect()}
    r = d[D("2024-04-01")]
    assert (r.date_key, r.month_name, r.day_name, r.is_weekday, r.quarter) == (20240401, "Apr", "Mon", True, 2)
    assert d[D("2024-04-06")].is_weekday is False
    fact = spark.createDataFrame([(D("2024-04-02"),), (D("2024-04-04"),)], "x date")
    assert bounded_spine(dim_date(date_spine(spark, "2024-04-01", "2024-04-08")), fact, "x").count() == 3


def test_keys(spark):
    r = spark.createDataFrame([("a", None)], "x string, y string").select(
        pipe_key("x", "y").alias("p"), surrogate_key("x", "y").alias("s"),
        surrogate_key("x").alias("s1")).first()
    import hashlib
    assert r.p is None
    assert r.s == hashlib.md5(b"a-_dbt_utils_surrogate_key_null_").hexdigest()
    assert r.s1 == hashlib.md5(b"a").hexdigest()


def test_degree_days_null_safe(spark):
    df = spark.createDataFrame([(None,), (10.0,), (25.0,)], "t double")
    assert [r.h for r in df.select(degree_days("t").alias("h")).collect()] == [None, 8.0, 0.0]


def test_latest_wins_methods_and_null_order(spark):
    df = spark.createDataFrame([(1, None, "n"), (1, 5, "a"), (1, 7, "b"), (2, 1, "c"), (2, 1, "d")],
                               "k int, o int, v string")
    for m in ("max_by", "window"):
        out = {r.k: r.v for r in latest_wins(df, ["k"], ["o", "v"], method=m).collect()}
        assert out == {1: "b", 2: "d"}


def test_dimension_latest_name(spark):
    df = spark.createDataFrame([("USD", "dolar", 1), ("USD", "dolar amerykanski", 2)],
                               "code string, name string, seq int")
    out = latest_wins(df, ["code"], ["seq"]).collect()
    assert [(r.code, r.name) for r in out] == [("USD", "dolar amerykanski")]


SCD_RUNS = [({"a": 1, "b": 1}, "2024-01-01 00:00:00"), ({"a": 2, "b": 1}, "2024-01-02 00:00:00"),
            ({"a": 2}, "2024-01-03 00:00:00"), ({"a": 2, "b": 1}, "2024-01-04 00:00:00")]


def _snap(spark, d):
    return spark.createDataFrame(list(d.items()), "k string, v int")


def test_scd2_apply_and_replay(spark):
    h = None
    for snap, ts in SCD_RUNS:
        h = scd2_apply(h, _snap(spark, snap), ["k"], ["v"], ts)
    rows = sorted((r.k, r.v, str(r.valid_from), str(r.valid_to)) for r in h.collect())
    assert rows == [
        ("a", 1, "2024-01-01 00:00:00", "2024-01-02 00:00:00"),
        ("a", 2, "2024-01-02 00:00:00", "None"),
        ("b", 1, "2024-01-01 00:00:00", "2024-01-03 00:00:00"),
        ("b", 1, "2024-01-04 00:00:00", "None"),
    ]
    snaps = None
    for snap, ts in SCD_RUNS:
        s = _snap(spark, snap).withColumn("run_ts", F.lit(ts).cast("timestamp_ntz"))
        snaps = s if snaps is None else snaps.unionByName(s)
    rep = scd2_replay(snaps, ["k"], ["v"])
    assert rep.exceptAll(h).count() == 0 and h.exceptAll(rep).count() == 0


def test_merge_upsert_idempotent(spark, tmp_root):
    schema = "k int, v string, seq int, part string"
    b1 = spark.createDataFrame([(1, "a", 1, "p1"), (2, "x", 1, "p2")], schema)
    b2 = spark.createDataFrame([(1, "b", 2, "p1"), (1, "c", 3, "p1")], schema)
    assert merge_upsert(spark, tmp_root, b1, ["k"], ["seq"], "part", batch_id=0)
    assert merge_upsert(spark, tmp_root, b2, ["k"], ["seq"], "part", batch_id=1)
    assert not merge_upsert(spark, tmp_root, b2, ["k"], ["seq"], "part", batch_id=1)
    out = sorted((r.k, r.v) for r in read_table(spark, tmp_root).collect())
    assert out == [(1, "c"), (2, "x")]
    # An older row arriving late does not win under on_conflict="latest".
    late = spark.createDataFrame([(1, "old", 0, "p1")], schema)
    merge_upsert(spark, tmp_root, late, ["k"], ["seq"], "part", batch_id=2)
    assert sorted((r.k, r.v) for r in read_table(spark, tmp_root).collect()) == [(1, "c"), (2, "x")]


def test_quality_checks_and_gate(spark):
    df = spark.createDataFrame([(1, "a", 5.0), (1, None, -1.0), (2, "z", None)],
                               "id int, c string, x double")
    rep = run_checks(df, [not_null("c"), unique("id"), accepted_range("x", 0, inclusive=False),
                          accepted_values("c", ["a", "b"])])
    got = {r.check_name: r.failures for r in rep.collect()}
    assert got == {"not_null_c": 1, "unique_id": 2, "accepted_range_x": 1, "accepted_values_c": 1}
    with pytest.raises(QualityGateError):
        gate(rep)


def test_freshness_levels(spark):
    run = "2024-01-10 12:00:00"
    base = dt.datetime(2024, 1, 10, 12)
    df = spark.createDataFrame([(s, base - dt.timedelta(hours=h)) for s, h in (("a", 25), ("b", 30), ("c", 51))],
                               "src string, ts timestamp_ntz")
    out = {r.src: r.status for r in freshness(df, "ts", run, by=["src"]).collect()}
    assert out == {"a": "pass", "b": "warn", "c": "error"}


def test_reconcile(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "Y"), (4, "w")], "k int, v string")
    got = {r.metric: r.value for r in reconcile(a, b, ["k"]).collect()}
    assert got == {"rows_a": 3, "rows_b": 3, "only_in_a": 1, "only_in_b": 1, "changed": 1, "matched": 1}


def test_asof_slicing_hot_group_equals_unsliced(spark):
    # One key and one month hold everything: the group is cut into slices.
    base = dt.datetime(2024, 1, 1)
    left = spark.createDataFrame([(1, base + dt.timedelta(minutes=7 * i)) for i in range(3000)],
                                 "u int, t timestamp_ntz")
    right = spark.createDataFrame([(1, base + dt.timedelta(minutes=11 * i + 3), i) for i in range(2000)],
                                  "u int, rt timestamp_ntz, v int")
    plain = asof_join(left, right, "t", "rt", by=["u"])
    sliced = asof_join(left, right, "t", "rt", by=["u"], slice_rows=200)
    assert sliced.count() == 3000
    assert plain.exceptAll(sliced).count() == 0 and sliced.exceptAll(plain).count() == 0
    keyless = asof_join(left.drop("u"), right.drop("u"), "t", "rt", slice_rows=150, left_unique=True)
    assert keyless.exceptAll(plain.drop("u")).count() == 0


def test_asof_slicing_session_timestamps(spark):
    base = dt.datetime(2024, 3, 30)
    left = spark.createDataFrame([(base + dt.timedelta(minutes=13 * i),) for i in range(800)], "t timestamp")
    right = spark.createDataFrame([(base + dt.timedelta(minutes=17 * i + 5), i) for i in range(600)],
                                  "rt timestamp, v int")
    plain = asof_join(left, right, "t", "rt", bucket="month")
    sliced = asof_join(left, right, "t", "rt", bucket="month", slice_rows=100)
    assert plain.exceptAll(sliced).count() == 0 and sliced.exceptAll(plain).count() == 0


def test_rolling_and_change_halo_equal_plain(spark):
    from seriesmart.operators.series import rolling
    rows = [(k, D("2000-01-01") + dt.timedelta(days=i), float((i * 31 + len(k)) % 97))
            for k in ("x", "yy") for i in range(0, 1500, len(k))]
    df = spark.createDataFrame(rows, "k string, d date, v double")
    for a, b in [(rolling(df, ["k"], "d", "v", 30, "stddev_samp"),
                  rolling(df, ["k"], "d", "v", 30, "stddev_samp", halo_chunk=50)),
                 (with_change(df, ["k"], "d", "v"), with_change(df, ["k"], "d", "v", halo_chunk=40))]:
        assert a.count() == b.count() == len(rows)
        assert a.exceptAll(b).count() == 0


def test_asof_tie_break_in_sweep(spark):
    feed = spark.createDataFrame([(D("2024-01-02"), 1, "a"), (D("2024-01-02"), 3, "c"),
                                  (D("2024-01-02"), 2, "b"), (D("2024-01-04"), 0, "z")],
                                 "fd date, seq int, v string")
    out = asof_join(_spine(spark), feed, "day", "fd", tie_break=["seq"], left_unique=True)
    assert [r.v for r in out.orderBy("day").collect()] == [None, "c", "c", "z", "z"]
    fwd = asof_join(_spine(spark), feed, "day", "fd", tie_break=["seq"], direction="forward")
    assert [r.v for r in fwd.orderBy("day").collect()] == ["c", "c", "z", "z", None]


def test_checked_broadcast_falls_back(spark):
    from seriesmart.operators.sizing import checked_broadcast, fits
    small = spark.range(10)
    assert fits(small, 10) and not fits(small, 9)
    # Too large for the bound: no hint, the planner picks the join; same rows.
    assert spark.range(100).join(checked_broadcast(small, 5), "id").count() == 10
    assert spark.range(100).join(checked_broadcast(small, 50), "id").count() == 10


def test_upsert_survives_interrupted_commit(spark, tmp_root):
    import os
    schema = "k int, v int, part string"
    merge_upsert(spark, tmp_root, spark.createDataFrame([(1, 1, "p1"), (2, 1, "p2")], schema), ["k"], ["v"],
                 "part", batch_id=0)
    # A commit that died before its file was written leaves only temporary data.
    os.makedirs(tmp_root.replace("file:", "") + "/_manifest/v=2/_temporary/0")
    assert sorted((r.k, r.v) for r in read_table(spark, tmp_root).collect()) == [(1, 1), (2, 1)]
    assert merge_upsert(spark, tmp_root, spark.createDataFrame([(1, 2, "p1")], schema), ["k"], ["v"], "part",
                        batch_id=1)
    assert sorted((r.k, r.v) for r in read_table(spark, tmp_root).collect()) == [(1, 2), (2, 1)]


def test_upsert_first_commit_interrupted(spark, tmp_root):
    import os
    os.makedirs(tmp_root.replace("file:", "") + "/_manifest/v=1/_temporary/0")
    delta = spark.createDataFrame([(1, 1, "p1")], "k int, v int, part string")
    assert merge_upsert(spark, tmp_root, delta, ["k"], ["v"], "part", batch_id=0)
    assert read_table(spark, tmp_root).count() == 1


def test_upsert_null_partition(spark, tmp_root):
    schema = "k int, v int, part string"
    merge_upsert(spark, tmp_root, spark.createDataFrame([(1, 1, "p1"), (2, 1, None)], schema), ["k"], ["v"], "part")
    merge_upsert(spark, tmp_root, spark.createDataFrame([(2, 2, None), (3, 1, None)], schema), ["k"], ["v"], "part")
    rows = {(r.k, r.v, r.part) for r in read_table(spark, tmp_root).collect()}
    assert rows == {(1, 1, "p1"), (2, 2, None), (3, 1, None)}


def test_asof_null_right_rows_match_nothing(spark):
    left = spark.createDataFrame([("a", 1), ("a", 5), (None, 5), ("a", None)], "k string, t int").select(
        "k", F.to_timestamp(F.lit("2024-01-01")).alias("b"), "t").withColumn("t", F.expr("b + make_interval(0,0,0,t)"))
    left = left.select("k", "t")
    right = spark.createDataFrame([("a", None, 99), ("a", 3, 7), (None, 1, 98)], "k string, d int, x int").select(
        "k", F.expr("to_timestamp('2024-01-01') + make_interval(0,0,0,d)").alias("rt"), "x")
    for unique in (False, True):
        for direction in ("backward", "forward"):
            got = {(r.k, r.t.day if r.t else None): r.x for r in asof_join(
                left, right, "t", "rt", by=["k"], direction=direction, left_unique=unique).collect()}
            want = {("a", 2): 7 if direction == "forward" else None, ("a", 6): None if direction == "forward" else 7,
                    (None, 6): None, ("a", None): None}
            assert got == want, (unique, direction)


def test_chunked_layout_keeps_null_keys_and_dates(spark):
    from seriesmart.operators.series import returns_and_rolling
    rows = [(k, f"2024-01-{d:02d}" if d else None, float(v)) for k in ("a", None)
            for d, v in [(None, 3), (1, 5), (2, 7), (3, 11), (4, 13)]]
    df = spark.createDataFrame(rows, "k string, d string, v double").withColumn("d", F.col("d").cast("date"))
    plain = returns_and_rolling(df, ["k"], "d", "v", short=2, long=3)
    chunked = returns_and_rolling(df, ["k"], "d", "v", short=2, long=3, halo_chunk=4)
    key = lambda r: str(tuple(r))
    assert sorted(chunked.select(plain.columns).collect(), key=key) == sorted(plain.collect(), key=key)


def test_empty_table_is_not_fresh(spark):
    from seriesmart.operators.quality import freshness
    empty = spark.createDataFrame([], "_loaded_at timestamp_ntz")
    assert freshness(empty, "_loaded_at", "2026-01-01 00:00:00").first().status == "error"


def test_jsonstat_size_guard(spark):
    from seriesmart.operators.nested import decode_jsonstat, parse_documents
    ok = '{"size":[1,3],"dimension":{"time":{"category":{"index":{"2024-01":0,"2024-02":1,"2024-03":2}}}},' \
         '"value":{"0":1.5,"2":2.5}}'
    bad = '{"size":[2,3],"dimension":{"time":{"category":{"index":{"2024-01":0,"2024-02":1,"2024-03":2}}}},' \
          '"value":{"0":1.5}}'
    df = parse_documents(spark.createDataFrame([(ok,)], "value string"))
    got = sorted((r.period, r.value) for r in decode_jsonstat(df, "raw", "decimal(18,4)", keep=[]).collect())
    assert got == [("2024-01", Decimal("1.5000")), ("2024-02", None), ("2024-03", Decimal("2.5000"))]
    with pytest.raises(Exception, match="only the time dimension"):
        decode_jsonstat(parse_documents(spark.createDataFrame([(bad,)], "value string")), "raw",
                        keep=[]).collect()


def test_asof_slicing_forward_and_exclusive(spark):
    base = dt.datetime(2024, 5, 1)
    left = spark.createDataFrame([(i % 2, base + dt.timedelta(minutes=5 * i)) for i in range(1200)],
                                 "u int, t timestamp_ntz")
    right = spark.createDataFrame([(i % 2, base + dt.timedelta(minutes=7 * i), i) for i in range(900)],
                                  "u int, rt timestamp_ntz, v int")
    for kw in ({"direction": "forward"}, {"allow_exact": False}, {"direction": "forward", "allow_exact": False}):
        plain = asof_join(left, right, "t", "rt", by=["u"], **kw)
        sliced = asof_join(left, right, "t", "rt", by=["u"], slice_rows=60, **kw)
        assert plain.exceptAll(sliced).count() == 0 and sliced.exceptAll(plain).count() == 0, kw


def test_asof_timestamp_tolerance(spark):
    base = dt.datetime(2024, 1, 1, 12)
    left = spark.createDataFrame([(base + dt.timedelta(hours=h),) for h in (0, 1, 3, 6)], "t timestamp_ntz")
    right = spark.createDataFrame([(base, 1), (base + dt.timedelta(hours=2), 2)], "rt timestamp_ntz, v int")
    out = asof_join(left, right, "t", "rt", tolerance="2 hours", left_unique=True, bucket="day")
    assert [r.v for r in out.orderBy("t").collect()] == [1, 1, 2, None]


def test_rolling_days_brute_force(spark):
    from seriesmart.operators.series import rolling_days
    rows = [("a", D("2024-01-01") + dt.timedelta(days=i), float(i % 13)) for i in range(0, 400, 3)] + \
           [("b", D("2024-01-01") + dt.timedelta(days=i), float(i % 7)) for i in range(0, 400, 5)]
    df = spark.createDataFrame(rows, "k string, d date, v double")
    got = {(r.k, r.d): r.s for r in rolling_days(df, ["k"], "d", "v", 10, "sum", "s").collect()}
    halo = {(r.k, r.d): r.s for r in rolling_days(df, ["k"], "d", "v", 10, "sum", "s", chunk_days=30).collect()}
    for k, d, _ in rows:
        want = sum(v for k2, d2, v in rows if k2 == k and dt.timedelta(0) <= d - d2 <= dt.timedelta(days=9))
        assert got[(k, d)] == want and halo[(k, d)] == want


def test_cdc_restart_picks_up_only_new_files(spark, tmp_root):
    from seriesmart.operators.nested import parse_documents
    from seriesmart.streaming.cdc import start_cdc
    land, target, ckpt = tmp_root + "/land", tmp_root + "/target", tmp_root + "/ckpt"

    def decode(raw):
        d = parse_documents(raw)
        return d.select(F.try_variant_get("raw", "$.k", "int").alias("k"),
                        F.try_variant_get("raw", "$.v", "int").alias("v"),
                        F.try_variant_get("raw", "$.p", "string").alias("p"))

    def land_batch(name, rows):
        spark.createDataFrame([(f'{{"k": {k}, "v": {v}, "p": "x"}}',) for k, v in rows], "value string") \
            .coalesce(1).write.text(f"{land}/{name}")

    def run():
        q = start_cdc(spark, land + "/*", target, ckpt, decode, ["k"], ["v"], "p")
        q.awaitTermination()
        assert q.exception() is None

    land_batch("b1", [(1, 1), (2, 1)])
    run()
    run()  # restart, nothing new: no batch, same table
    land_batch("b2", [(1, 5), (3, 1)])
    run()
    assert sorted((r.k, r.v) for r in read_table(spark, target).collect()) == [(1, 5), (2, 1), (3, 1)]


def test_flatten_object_and_outer_flatten(spark):
    from seriesmart.operators.nested import flatten, flatten_object, parse_documents
    df = parse_documents(spark.createDataFrame([('{"m": {"a": 1, "b": 2}, "xs": []}',)], "value string"))
    kv = sorted((r.key, r.value) for r in flatten_object(df, "raw", "$.m", "int", keep=[]).collect())
    assert kv == [("a", 1), ("b", 2)]
    assert flatten(df, "raw", "$.xs", "x", keep=[]).count() == 0          # inner: empty array drops
    assert flatten(df, "raw", "$.xs", "x", keep=[], outer=True).count() == 1
    pos = flatten(parse_documents(spark.createDataFrame([('[10, 20]',)], "value string")), "raw", "$", "x",
                  keep=[], with_pos=True)
    assert sorted((r.x_pos, str(r.x)) for r in pos.collect()) == [(0, "10"), (1, "20")]


def test_typed_flatten_reads_what_paths_read(spark):
    """Typed elements hold what paths into VARIANT elements give, broken values too,
    and an element that is no object is a row of NULLs."""
    from seriesmart.operators.nested import fields, flatten, parse_documents, path
    texts = ['[{"a-b": 1, "d": "2024-02-30", "p": "12.345", "q": {"x": 1}}, {"d": "2024-02-29", "p": null}]',
             '[{"a-b": "7", "p": "n/a", "q": [1]}, {"a-b": 1.0, "p": 99999999999999999.5}, 5, null, [1]]',
             '{"a-b": 1}', '[]', '"x"', 'null']
    df = parse_documents(spark.createDataFrame([(t,) for t in texts], "value string"))
    types = {"a-b": "bigint", "d": "date", "p": "decimal(18,2)", "q": "string"}
    typed = flatten(df, "raw", "$", "o", keep=["value"], with_pos=True, type_=fields(types))
    plain = flatten(df, "raw", "$", "o", keep=["value"], with_pos=True).select(
        "value", "o_pos", *[path("o", f'$["{k}"]', t).alias(k) for k, t in types.items()])
    got, want = typed.select("value", "o_pos", "o.*").collect(), plain.collect()
    assert len(want) == 7 and sorted(map(repr, got)) == sorted(map(repr, want))
    inner = flatten(df.limit(1), "raw", "$", "o", keep=[], type_=fields({"xs": "array<int>"}))
    assert flatten(inner, "o.xs", None, "x", keep=[]).count() == 0
    assert flatten(inner, "o.xs", None, "x", keep=[], outer=True).count() == 2


def test_nested_flatten_builds_no_variant_elements(spark):
    from seriesmart.plans.documents import q_flatten_nested
    plan = q_flatten_nested(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "ArrayType(VariantType" not in plan and plan.count("parseJson(") == 1
    # An aggregate evaluates its input expression by expression: the structs are projected before.
    assert "collect_list(struct" not in plan and "collect_list(named_struct" not in plan


def test_fx_stream_rewrites_only_touched_months(spark, tmp_root):
    import os
    from seriesmart.plans.models import stream_fx
    land = tmp_root.replace("file:", "") + "/land"

    def put(load, name, day, mid):
        os.makedirs(f"{land}/load={load}", exist_ok=True)
        with open(f"{land}/load={load}/{name}.json", "w") as f:
            f.write('[{"table":"A","effectiveDate":"%s","rates":[{"code":"USD","currency":"d","mid":%s}]}]\n' % (day, mid))

    args = (land, tmp_root + "/target", tmp_root + "/ckpt")
    put(1, "a", "2026-03-02", 3.5)
    put(1, "b", "2026-04-02", 3.6)
    stream_fx(spark, *args)
    march = {p for p in spark.read.parquet(tmp_root + "/target/_manifest").where("partition = '2026-03'")
             .select("path").distinct().toPandas().path}
    put(2, "c", "2026-04-02", 3.7)
    stream_fx(spark, *args)
    now = spark.read.parquet(tmp_root + "/target/_manifest")
    assert {p for p in now.where("partition = '2026-03'").select("path").distinct().toPandas().path} == march
    assert now.where("partition = '2026-04'").select("path").distinct().count() == 2
    assert sorted(str(r.mid_rate) for r in read_table(spark, tmp_root + "/target").collect()) == ["3.500000", "3.700000"]


def test_history_survives_runs_and_reappearance(spark, tmp_root):
    from seriesmart.plans.build import publish_history
    rows = [[(1, 10), (2, 20)], [(1, 11)], [(1, 11), (2, 20)]]
    for i, r in enumerate(rows, 1):
        snap = spark.createDataFrame(r, "k int, v int")
        _, h = publish_history(spark, tmp_root, snap, ["k"], ["v"], f"2026-01-0{i} 00:00:00")
    got = sorted((r.k, r.v, r.valid_from.day, r.valid_to.day if r.valid_to else None) for r in h.collect())
    assert got == [(1, 10, 1, 2), (1, 11, 2, None), (2, 20, 1, 2), (2, 20, 3, None)]


def test_multi_asof_reduces_ties(spark):
    spine = spark.createDataFrame([("2026-01-01",), ("2026-01-02",)], "d string").select(F.col("d").cast("date"))
    rows = [("2026-01-01", 1, 5), ("2026-01-01", 2, 3), (None, 9, 99)]
    for r in (rows, rows[::-1]):
        feed = spark.createDataFrame(r, "f string, seq int, v int").withColumn("f", F.col("f").cast("date"))
        by_seq = multi_asof(spine, "d", {"x": (feed, "f", ["v"])}, tie_break={"x": ["seq"]})
        assert {x.v for x in by_seq.collect()} == {3}
        assert {x.v for x in multi_asof(spine, "d", {"x": (feed, "f", ["v"])}).collect()} == {5}
