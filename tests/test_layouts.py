"""Stored layouts and skew: open/closed history, exact time ranges of the as-of join, digests of a reconciliation."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from seriesmart.operators import asof
from seriesmart.operators.asof import asof_join
from seriesmart.operators.merge import publish_table, read_table, table_state
from seriesmart.operators.quality import QualityGateError, not_null, reconcile, unique
from seriesmart.operators.scd2 import publish_history

RUN = "2026-01-0{} 00:00:00"


def _rows(df):
    return sorted(((r.k, r.v, r.valid_from.day, r.valid_to.day if r.valid_to else None) for r in df.collect()),
                  key=lambda r: (r[0] is None, r))


def _snap(spark, rows):
    return spark.createDataFrame(rows, "k int, v int")


def _folders(spark, root):
    return {(r.partition, r.path) for r in table_state(spark, root).manifest.collect()}


# --- open and closed history -------------------------------------------------

def test_closed_rows_are_only_added(spark, tmp_root):
    publish_history(spark, tmp_root, _snap(spark, [(1, 10), (2, 20)]), ["k"], ["v"], RUN.format(1))
    assert {p for p, _ in _folders(spark, tmp_root)} == {"open"}
    publish_history(spark, tmp_root, _snap(spark, [(1, 11), (2, 20)]), ["k"], ["v"], RUN.format(2))
    second = _folders(spark, tmp_root)
    publish_history(spark, tmp_root, _snap(spark, [(1, 11)]), ["k"], ["v"], RUN.format(3))
    third = _folders(spark, tmp_root)
    closed = {f for f in second if f[0].startswith("closed")}
    assert len(closed) == 1 and closed < third  # the same folder, not a copy
    assert sorted(p for p, _ in third) == [f"closed:{RUN.format(2)}", f"closed:{RUN.format(3)}", "open"]
    _, h = publish_history(spark, tmp_root, _snap(spark, [(1, 11)]), ["k"], ["v"], RUN.format(4))
    assert sorted(p for p, _ in _folders(spark, tmp_root)) == sorted(p for p, _ in third)  # nothing changed, nothing closed
    assert _rows(h) == _rows(read_table(spark, tmp_root)) == [(1, 10, 1, 2), (1, 11, 2, None), (2, 20, 1, 3)]


def test_bytes_written_follow_the_open_rows(spark, tmp_root):
    """A long closed history costs later runs nothing."""
    def size(paths):
        return sum(os.path.getsize(os.path.join(p.removeprefix("file:"), f)) for p in paths
                   for f in os.listdir(p.removeprefix("file:")))
    wide = spark.range(20_000).select(F.col("id").cast("int").alias("k"), F.hash("id").alias("v"))
    publish_history(spark, tmp_root, wide, ["k"], ["v"], RUN.format(1))
    publish_history(spark, tmp_root, wide.where("k < 10"), ["k"], ["v"], RUN.format(2))
    before = {p for _, p in _folders(spark, tmp_root)}
    publish_history(spark, tmp_root, wide.where("k < 11"), ["k"], ["v"], RUN.format(3))
    new = {p for _, p in _folders(spark, tmp_root)} - before
    assert size(new) < size(before) / 20


def test_all_rows_withdrawn_and_back(spark, tmp_root):
    version, h = publish_history(spark, tmp_root, _snap(spark, []), ["k"], ["v"], RUN.format(1))
    assert version == 0 and h.count() == 0
    publish_history(spark, tmp_root, _snap(spark, [(1, 10), (None, 5)]), ["k"], ["v"], RUN.format(2))
    _, h = publish_history(spark, tmp_root, _snap(spark, []), ["k"], ["v"], RUN.format(3))
    assert _rows(h) == [(1, 10, 2, 3), (None, 5, 2, 3)] and {p for p, _ in _folders(spark, tmp_root)} == {f"closed:{RUN.format(3)}"}
    _, h = publish_history(spark, tmp_root, _snap(spark, [(1, 10)]), ["k"], ["v"], RUN.format(4))
    assert _rows(h) == [(1, 10, 2, 3), (1, 10, 4, None), (None, 5, 2, 3)]


def test_history_of_one_part_is_split(spark, tmp_root):
    """A history published whole, as before this layout, goes on."""
    old = spark.createDataFrame([(1, 10, dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 2)), (1, 11, dt.datetime(2026, 1, 2), None)],
                                "k int, v int, valid_from timestamp_ntz, valid_to timestamp_ntz")
    publish_table(spark, old, tmp_root)
    _, h = publish_history(spark, tmp_root, _snap(spark, [(1, 12)]), ["k"], ["v"], RUN.format(3))
    assert _rows(h) == [(1, 10, 1, 2), (1, 11, 2, 3), (1, 12, 3, None)]
    assert sorted(p for p, _ in _folders(spark, tmp_root)) == [f"closed:{RUN.format(3)}", "open"]


def test_failed_checks_keep_the_history(spark, tmp_root):
    publish_history(spark, tmp_root, _snap(spark, [(1, 10)]), ["k"], ["v"], RUN.format(1))
    for checks in ([not_null("v")], [unique("k")]):  # counted on what is written; on the whole history
        with pytest.raises(QualityGateError):
            publish_history(spark, tmp_root, _snap(spark, [(1, None)]), ["k"], ["v"], RUN.format(2), checks)
    assert _rows(read_table(spark, tmp_root)) == [(1, 10, 1, None)]


# --- exact time ranges -------------------------------------------------------

def _events(spark, n, kind="timestamp_ntz"):
    """Times a few microseconds apart, the last ones all equal."""
    t = F.expr(f"cast(timestamp_ntz'2024-01-15 12:00:00' + make_dt_interval(0, 0, 0, least(id, {n} - 50) * 0.000003) as {kind})")
    return spark.range(n).select(t.alias("rt"), F.col("id").alias("v"))


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_a_hot_group_is_cut_without_a_bound(spark, kind):
    """More ranges than any fixed number of quantiles gives, each light or of one time."""
    right = _events(spark, 6000, kind)
    left = right.where("v % 3 = 0").select(F.col("rt").alias("t"), F.col("v").alias("i"))
    plain = asof_join(left, right, "t", "rt", tie_break=["v"])
    sliced = asof_join(left, right, "t", "rt", tie_break=["v"], slice_rows=3)
    assert plain.exceptAll(sliced).isEmpty() and sliced.exceptAll(plain).isEmpty()
    u = asof._sliced(right.select(F.col("rt").alias("__t")), [], "month", 3)
    sizes = u.groupBy("__bucket").agg(F.count("*").alias("n"), F.countDistinct("__t").alias("times"))
    assert sizes.where("n > 3 and times > 1").isEmpty() and sizes.count() > 1500


def test_ranges_of_dates_and_null_keys(spark):
    days = spark.range(400).select(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 40).cast("int")).alias("rd"),
                                   F.when(F.col("id") % 5 > 0, F.col("id") % 2).alias("u"), F.col("id").alias("v"))
    left = days.select(F.col("rd").alias("d"), "u", F.col("v").alias("i"))
    for direction in ("backward", "forward"):
        args = dict(by=["u"], tie_break=["v"], direction=direction)
        plain, sliced = asof_join(left, days, "d", "rd", **args), asof_join(left, days, "d", "rd", slice_rows=5, **args)
        assert plain.count() == 400
        assert plain.exceptAll(sliced).isEmpty() and sliced.exceptAll(plain).isEmpty()


def test_nothing_is_sliced_when_nothing_is_heavy(spark):
    u = asof._sliced(_events(spark, 20).select(F.col("rt").alias("__t")), [], "month", 1000)
    assert u.select("__bucket").distinct().count() == 1 and "Join" not in u._jdf.queryExecution().optimizedPlan().toString()


# --- reconciliation ----------------------------------------------------------

def _metrics(a, b, **kw):
    return {r.metric: r.value for r in reconcile(a, b, ["k"], **kw).collect()}


@pytest.mark.parametrize("buckets", [1, 7, 4096])
def test_reconcile_counts(spark, buckets):
    a = spark.range(3000).select(F.col("id").alias("k"), F.when(F.col("id") % 7 > 0, F.col("id") % 11).alias("v"))
    b = (a.where("k % 10 <> 0").withColumn("v", F.when(F.col("k") % 13 == 0, F.lit(99)).otherwise(F.col("v")))
         .unionByName(spark.range(5000, 5020).select(F.col("id").alias("k"), F.lit(1).cast("long").alias("v"))))
    changed = sum(1 for k in range(3000) if k % 10 and k % 13 == 0)
    assert _metrics(a, b, buckets=buckets) == {"rows_a": 3000, "rows_b": 2720, "only_in_a": 300, "only_in_b": 20,
                                               "changed": changed, "matched": 2700 - changed}
    assert _metrics(a, a, buckets=buckets) == {"rows_a": 3000, "rows_b": 3000, "only_in_a": 0, "only_in_b": 0, "changed": 0,
                                               "matched": 3000}


def test_reconcile_edges(spark):
    schema = "k int, v int, w int"
    a = spark.createDataFrame([(1, None, 5), (None, 1, 1)], schema)
    b = spark.createDataFrame([(1, 5, None), (None, 1, 1)], schema)
    assert _metrics(a, b) == {"rows_a": 2, "rows_b": 2, "only_in_a": 0, "only_in_b": 0, "changed": 1, "matched": 1}
    assert set(_metrics(a.limit(0), b.limit(0)).values()) == {0}
    assert _metrics(a, b.limit(0)) == {"rows_a": 2, "rows_b": 0, "only_in_a": 2, "only_in_b": 0, "changed": 0, "matched": 0}


def test_equal_tables_are_not_joined_row_by_row(spark):
    a = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") * 3).alias("v"))

    def row_joins(b):
        df = reconcile(a, b, ["k"])
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        return sum("SortMergeJoin" in line and "__k_k" in line for line in final.splitlines())
    assert row_joins(a.withColumn("v", F.col("v") + (F.col("k") == 5).cast("int"))) == 1
    assert row_joins(a) == 0


# --- uniqueness from suspects ------------------------------------------------

VALUES = {"int": [5, 5, 6, None, None, -1, -1, -1, 63, 64, 127, 128], "bigint": [2**62, 2**62, -2**62, 0, 64, 64, None],
          "date": ["2024-01-01", "2024-01-01", "1969-12-31", None], "string": ["a", "b", "a", "", "", None],
          "double": [0.5, 0.5, 1.5, None], "decimal(10,2)": ["1.00", "1.00", "2.00"], "tinyint": [1, 2, 3]}


@pytest.mark.parametrize("kind", sorted(VALUES))
def test_repeated_values(spark, kind):
    from collections import Counter

    from seriesmart.operators.quality import repeated_rows
    df = spark.createDataFrame([(None if v is None else str(v),) for v in VALUES[kind]], "v string").select(F.col("v").cast(kind))
    want = {v: n for v, n in Counter(r.v for r in df.collect() if r.v is not None).items() if n > 1}
    assert {r.v: r.n for r in repeated_rows(df, "v").collect()} == want


def test_unique_keys_are_read_once(spark):
    """Without suspects nothing is counted by value; neighbouring keys ship a row for 64 of them."""
    from seriesmart.operators.quality import repeated_rows
    df = repeated_rows(spark.range(0, 64_000, numPartitions=4), "id")
    assert df.count() == 0
    plan = df._jdf.queryExecution()
    df.collect()
    final = plan.executedPlan().toString().split("== Initial Plan ==")[0]
    assert "EmptyRelation" in final or "LocalTableScan <empty>" in final


# --- bucketed tables ---------------------------------------------------------

def test_bucketed_tables_join_and_group_without_an_exchange(spark, tmp_root):
    from seriesmart.operators.bucketed import read_bucketed, write_bucketed
    fact = spark.range(5000).select((F.col("id") % 700).alias("k"), F.col("id").alias("v"))
    dim = spark.range(0, 900, 2).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"))
    a, b = write_bucketed(fact, f"{tmp_root}/fact", ["k"], 4), write_bucketed(dim, f"{tmp_root}/dim", ["k"], 4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = a.join(b, "k").groupBy("k").agg(F.sum("v").alias("v"), F.first("name").alias("name"))
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
        want = fact.join(dim, "k").groupBy("k").agg(F.sum("v").alias("v"), F.first("name").alias("name"))
        assert sorted(out.collect()) == sorted(want.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    again = write_bucketed(fact.where("k < 5"), f"{tmp_root}/fact", ["k"], 4)  # a new state replaces the old one
    assert again.count() == read_bucketed(spark, f"{tmp_root}/fact", fact.schema, ["k"], 4).count() == fact.where("k < 5").count()
