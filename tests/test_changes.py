"""Load plans, commits and the change feed of bronze tables; data tests observed by the write."""

import json
import os

import pytest
from pyspark.sql import functions as F

from seriesmart.operators import merge, quality
from seriesmart.operators.merge import merge_upsert, publish_table, read_table, table_state
from seriesmart.operators.nested import path
from seriesmart.operators.quality import (accepted_range, accepted_values, expression, not_null, observe_checks,
                                          relationships, run_checks, unique)
from seriesmart.sources import landing
from seriesmart.sources.landing import (incremental_load, list_files, load_pending, pending_files, plan_load, read_bronze,
                                        read_commits, read_ledger, read_runs)
from seriesmart.streaming.bronze_feed import start_bronze_feed

RUNS = [f"2026-04-2{i} 05:30:00" for i in range(9)]


def _root(tmp_root):
    return tmp_root.removeprefix("file:")


def _write(folder, name, *rows):
    p = os.path.join(folder, name)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "w") as f:
        f.writelines(json.dumps(r) + "\n" for r in rows)
    return p


def _values(df):
    return sorted(r.v for r in df.select(path("raw", "$.v", "int").alias("v")).collect())


# --- load plans --------------------------------------------------------------

def test_plan_names_folders_not_files(spark, tmp_root):
    root = _root(tmp_root)
    for d in range(3):
        for i in range(4):
            _write(f"{root}/land/d={d}", f"f{i}.json", {"v": 10 * d + i})
    plan = plan_load(spark, list_files(spark, f"{root}/land"), f"{root}/plan", f"{root}/land")
    assert plan.count == 12 and plan.files.count() == 12
    assert [f.rsplit("/", 1)[1] for f in plan.folders] == ["d=0", "d=1", "d=2"]
    assert plan_load(spark, list_files(spark, f"{root}/land", "nothing"), f"{root}/none", f"{root}/land") is None
    assert not os.path.exists(f"{root}/none")


def test_only_planned_files_are_loaded(spark, tmp_root):
    """A new file beside loaded ones, one in a sub-folder of a folder with pending
    files, one that lands between the plan and the read."""
    root = _root(tmp_root)
    land, bronze = f"{root}/land", f"{root}/bronze"
    _write(f"{land}/d=1", "a.json", {"v": 1})
    assert incremental_load(spark, land, bronze, RUNS[0]) == 1
    _write(f"{land}/d=1", "b.json", {"v": 2})
    _write(f"{land}/d=1/late", "c.json", {"v": 3})
    _write(f"{land}/d=2", "d.json", {"v": 4})

    def late(s, plan, ts):
        _write(f"{land}/d=2", "e.json", {"v": 5})
        return landing.scan_documents(s, plan, ts)

    assert load_pending(spark, land, bronze, RUNS[1], scan=late).loaded == 3
    assert _values(read_bronze(spark, bronze)) == [1, 2, 3, 4]
    assert incremental_load(spark, land, bronze, RUNS[2]) == 1
    assert _values(read_bronze(spark, bronze)) == [1, 2, 3, 4, 5]


def test_many_folders_read_below_the_root(spark, tmp_root, monkeypatch):
    monkeypatch.setattr(landing, "MAX_FOLDERS", 2)
    root = _root(tmp_root)
    for d in range(5):
        _write(f"{root}/land/d={d}", "f.json", {"v": d})
    assert incremental_load(spark, f"{root}/land", f"{root}/bronze", RUNS[0]) == 5
    assert _values(read_bronze(spark, f"{root}/bronze")) == [0, 1, 2, 3, 4]


def test_old_files_are_left_out_of_the_scan(spark, tmp_root):
    """Files older than any planned one never reach the scan's tasks."""
    root = _root(tmp_root)
    for i in range(20):
        os.utime(_write(f"{root}/land", f"old{i}.json", {"v": i}), (1_000_000_000 + i,) * 2)
    assert incremental_load(spark, f"{root}/land", f"{root}/bronze", RUNS[0]) == 20
    _write(f"{root}/land", "new.json", {"v": 99})
    plan = plan_load(spark, pending_files(list_files(spark, f"{root}/land"), read_ledger(spark, f"{root}/bronze")),
                     f"{root}/plan", f"{root}/land")
    assert plan.count == 1
    df = landing.scan_documents(spark, plan, RUNS[1])
    text = df._jdf.queryExecution().executedPlan()
    df.collect()
    scans = [m for m in str(text.toString()).splitlines() if "FileScan text" in m]
    assert scans and "file_modification_time" in scans[0]
    assert [r.v for r in df.select(path("raw", "$.v", "int").alias("v")).collect()] == [99]


@pytest.mark.parametrize("on_error,expected", [("continue", (2, 0, 1)), ("skip_file", (1, 1, 1))])
def test_policies_on_a_plan(spark, tmp_root, on_error, expected):
    root = _root(tmp_root)
    _write(f"{root}/land/d=1", "good.json", {"v": 1})
    with open(_write(f"{root}/land/d=1", "bad.json", {"v": 2}), "a") as f:
        f.write('{"v":\n')
    got = load_pending(spark, f"{root}/land", f"{root}/bronze", RUNS[0], on_error=on_error)
    assert (got.loaded, got.skipped, got.rejected) == expected
    assert _values(read_bronze(spark, f"{root}/bronze")) == ([1, 2] if on_error == "continue" else [1])


# --- commits -----------------------------------------------------------------

def test_a_run_counts_once_its_commit_is_there(spark, tmp_root):
    root = _root(tmp_root)
    land, bronze = f"{root}/land", f"{root}/bronze"
    _write(f"{land}/d=1", "a.json", {"v": 1})
    assert incremental_load(spark, land, bronze, RUNS[0]) == 1
    _write(f"{land}/d=2", "b.json", {"v": 2})
    assert incremental_load(spark, land, bronze, RUNS[1]) == 1
    runs = {r.loaded_at.day: r.run for r in read_commits(spark, bronze).collect()}
    os.rename(f"{bronze}/commits/{runs[21]}", f"{root}/lost")  # the second load died just before its commit
    assert _values(read_bronze(spark, bronze)) == [1]
    assert incremental_load(spark, land, bronze, RUNS[2]) == 1
    assert _values(read_bronze(spark, bronze)) == [1, 2]
    log = read_commits(spark, bronze).orderBy("loaded_at").collect()
    assert [(r.files, r.rejected) for r in log] == [(1, 0), (1, 0)]
    assert _values(read_runs(spark, bronze, [r.run for r in log])) == [1, 2]


def test_rewritten_files_lose_their_rows_in_their_run_only(spark, tmp_root):
    root = _root(tmp_root)
    land, bronze = f"{root}/land", f"{root}/bronze"
    _write(f"{land}/d=1", "a.json", {"v": 1})
    _write(f"{land}/d=1", "b.json", {"v": 2})
    incremental_load(spark, land, bronze, RUNS[0])
    _write(f"{land}/d=2", "c.json", {"v": 3})
    incremental_load(spark, land, bronze, RUNS[1])
    assert "Join" not in read_bronze(spark, bronze)._jdf.queryExecution().optimizedPlan().toString()
    _write(f"{land}/d=1", "a.json", {"v": 10}, {"v": 11})
    incremental_load(spark, land, bronze, RUNS[2])
    assert _values(read_bronze(spark, bronze)) == [2, 3, 10, 11]
    _write(f"{land}/d=1", "a.json", {"v": 12})
    incremental_load(spark, land, bronze, RUNS[3])
    assert _values(read_bronze(spark, bronze)) == [2, 3, 12]
    with pytest.raises(FileNotFoundError):
        read_bronze(spark, f"{root}/none")


def test_paths_reach_the_scan_of_a_bronze_table(spark, tmp_root):
    """Shredded documents: the scan's schema has the typed paths, not the document."""
    root = _root(tmp_root)
    _write(f"{root}/land/d=1", "a.json", *[{"v": i, "body": {"k": str(i), "rest": "x" * 50}, "more": [1, 2, 3]} for i in range(50)])
    incremental_load(spark, f"{root}/land", f"{root}/bronze", RUNS[0])
    df = read_bronze(spark, f"{root}/bronze").select(path("raw", "$.v", "int").alias("v"), path("raw", "$.body.k", "string").alias("k"))
    scan = next(x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan parquet" in x)
    assert "ReadSchema: struct<raw:struct<0:int,1:string>>" in scan
    assert sorted((r.v, r.k) for r in df.collect()) == [(i, str(i)) for i in range(50)]


# --- the change feed ---------------------------------------------------------

def _decode(rows):
    return rows.select(path("raw", "$.k", "int").alias("k"), path("raw", "$.v", "int").alias("v"), "_loaded_at",
                       F.lit("p").alias("part"))


def _feed(spark, root, **kw):
    q = start_bronze_feed(spark, f"{root}/bronze", f"{root}/target", f"{root}/ckpt", _decode, ["k"], ["_loaded_at"], "part", **kw)
    q.awaitTermination()
    assert q.exception() is None
    return q


def test_feed_merges_each_run_once(spark, tmp_root):
    root = _root(tmp_root)
    land, bronze = f"{root}/land", f"{root}/bronze"
    _feed(spark, root)  # nothing was ever loaded
    assert table_state(spark, f"{root}/target").version == 0
    _write(f"{land}/d=1", "a.json", {"k": 1, "v": 1}, {"k": 2, "v": 1})
    incremental_load(spark, land, bronze, RUNS[0])
    _feed(spark, root)
    _write(f"{land}/d=2", "b.json", {"k": 2, "v": 2})
    incremental_load(spark, land, bronze, RUNS[1])
    _write(f"{land}/d=3", "c.json", {"k": 2, "v": 3}, {"k": 3, "v": 3})
    incremental_load(spark, land, bronze, RUNS[2])
    _feed(spark, root)  # two runs, one merge
    state = table_state(spark, f"{root}/target")
    assert state.version == 2
    assert sorted((r.k, r.v) for r in read_table(spark, f"{root}/target").collect()) == [(1, 1), (2, 3), (3, 3)]
    _feed(spark, root)
    assert table_state(spark, f"{root}/target").version == 2


def test_feed_replays_a_batch_without_merging_it_again(spark, tmp_root):
    root = _root(tmp_root)
    _write(f"{root}/land/d=1", "a.json", {"k": 1, "v": 1})
    incremental_load(spark, f"{root}/land", f"{root}/bronze", RUNS[0])
    _feed(spark, root)
    for name in ("0", ".0.crc"):  # the process died after the merge, before the batch was noted as done
        os.rename(f"{root}/ckpt/commits/{name}", f"{root}/{name}")
    _feed(spark, root)
    assert table_state(spark, f"{root}/target").version == 1


def test_feed_one_run_per_batch(spark, tmp_root):
    root = _root(tmp_root)
    for i in range(3):
        _write(f"{root}/land/d={i}", "a.json", {"k": 1, "v": i})
        incremental_load(spark, f"{root}/land", f"{root}/bronze", RUNS[i])
    _feed(spark, root, max_runs_per_trigger=1)
    assert table_state(spark, f"{root}/target").version == 3
    assert [r.v for r in read_table(spark, f"{root}/target").collect()] == [2]


# --- data tests observed by the write ----------------------------------------

def _table(spark):
    return spark.createDataFrame([(1, "a", 5.0), (2, None, -1.0), (2, "c", None), (None, "z", 70.0)], "k int, s string, x double")


def _checks():
    return [not_null("k"), not_null("s"), accepted_range("x", 0, 60), accepted_values("s", ["a", "c"], severity="warn"),
            expression("big", F.col("x") > 60)]


def test_observed_counts_equal_the_checks(spark, tmp_root):
    df, checks = _table(spark), _checks()
    o = observe_checks(df, [*checks, unique("k")])
    assert [c.kind for c in o.rest] == ["unique"]
    o.df.write.parquet(tmp_root)
    expected = [r.asDict() for r in run_checks(df, checks).collect()]
    assert o.report() == expected and sum(r["failures"] for r in expected) == 6


def test_observed_counts_of_an_empty_table(spark, tmp_root):
    o = observe_checks(_table(spark).where("k > 100"), _checks())
    o.df.write.parquet(tmp_root)
    assert {r["failures"] for r in o.report()} == {0}


def test_row_checks_do_not_read_the_table_again(spark, tmp_root, monkeypatch):
    monkeypatch.setattr(quality, "run_checks", lambda *a: pytest.fail("read again"))
    version, _ = publish_table(spark, _table(spark).where("k = 1"), tmp_root, [not_null("k"), accepted_range("x", 0)])
    assert version == 1
    with pytest.raises(quality.QualityGateError, match="not_null_s=1"):
        publish_table(spark, _table(spark), tmp_root, [not_null("s")])
    assert read_table(spark, tmp_root).count() == 1


def test_publish_checks_the_written_table(spark, tmp_root):
    parents = spark.createDataFrame([(1,)], "id int")
    with pytest.raises(quality.QualityGateError, match="unique_k=2.*relationships_k=2"):
        publish_table(spark, _table(spark), tmp_root, [unique("k"), relationships("k", parents, "id")])
    assert table_state(spark, tmp_root).version == 0


def test_a_version_is_committed_once(spark, tmp_root, monkeypatch):
    delta = spark.createDataFrame([(1, 1, "p")], "k int, ts int, part string")
    stale = table_state(spark, tmp_root)
    merge_upsert(spark, tmp_root, delta, ["k"], ["ts"], "part")
    monkeypatch.setattr(merge, "table_state", lambda *a: stale)  # a second writer that started from the same state
    with pytest.raises(merge.ConcurrentCommit):
        merge_upsert(spark, tmp_root, delta.withColumn("ts", F.lit(2)), ["k"], ["ts"], "part")


def test_change_stream_is_sized_by_bytes_and_keys(spark, tmp_root, monkeypatch):
    from seriesmart.plans import history
    ev = spark.range(4000, numPartitions=8).select(
        F.col("id").alias("event_id"), F.lit("2024-01-01").cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 50).alias("user_id"), F.lit("click").alias("event_type"),
        F.lit(1.0).alias("value"), F.lit("{}").alias("props"))
    # Files by bytes: not one for each batch from each of the eight tasks.
    history.land_batches(ev, tmp_root)
    assert list_files(spark, tmp_root).count() == history.CDC_BATCHES
    assert spark.read.text(tmp_root).count() == 4000
    # Buckets by the rows that the table will hold (50 keys), not by its events.
    monkeypatch.setattr(history, "CDC_BUCKET_ROWS", 5)
    assert 8 <= history.cdc_buckets(ev) <= 13
    null = ev.withColumn("user_id", F.lit(None).cast("long"))
    assert history.cdc_buckets(null) == 8 and history.cdc_buckets(ev.limit(0)) == 8


def test_bronze_flatten_scans_typed_fields(spark):
    """The scan reads the typed fields of the orders, not whole documents."""
    from seriesmart.plans.landing import q_bronze_flatten
    plan = q_bronze_flatten(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan()
    scans = plan.collectLeaves().mkString("|")
    types = [f.dataType().simpleString() for f in [plan.collectLeaves().head().requiredSchema().apply("raw")]]
    assert types == ["struct<0:array<struct<orderkey:bigint,orderdate:date,lines:array<struct<linenumber:int,"
                     "quantity:decimal(18,2),extendedprice:decimal(18,2),shipdate:date>>>>>"], scans
