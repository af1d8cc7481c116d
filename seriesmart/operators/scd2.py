"""Slowly changing history (type 2) with hard-delete invalidation.

History rows carry ``valid_from`` / ``valid_to`` (``NULL`` = current).

* :func:`scd2_apply` is one snapshot run (``check`` strategy): a full outer
  join of the *current* rows with the snapshot on the key. Closed rows pass
  through without a shuffle.
* :func:`publish_history` keeps a stored history in two parts: the open rows,
  rewritten by each run, and the closed ones, which a run only adds to. What a run
  reads and writes follows the open rows, however long the history is.
* :func:`scd2_replay` rebuilds the whole history from many snapshots in one
  distributed pass (gaps and islands per key): an island is a run of
  consecutive snapshots with the key present and unchanged check columns;
  ``valid_to`` is the run after the island (a change or a deletion), NULL if
  the island reaches the last run. It handles change, deletion and
  reappearance, and equals chaining :func:`scd2_apply` over the runs.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.landing import run_stamp
from .merge import MANIFEST_SCHEMA, commit, table_state
from .quality import Check, gate_rows, observe_checks, run_checks
from .sizing import fits

MAX_BROADCAST_RUNS = 100_000


def _same(cols: Sequence[str], a: str, b: str):
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return cond


def scd2_apply(history: DataFrame | None, snapshot: DataFrame, key: Sequence[str],
               check_cols: Sequence[str], run_ts, close_deletes: bool = True) -> DataFrame:
    """Apply one snapshot (one row per key) to the history at time ``run_ts``."""
    key = list(key)
    vals = [c for c in snapshot.columns if c not in key]
    ts = run_stamp(run_ts)
    snap = snapshot.withColumn("__s", F.lit(True))
    if history is None:
        return snapshot.select(*key, *vals, ts.alias("valid_from"),
                               F.lit(None).cast("timestamp_ntz").alias("valid_to"))
    closed = history.filter(F.col("valid_to").isNotNull())
    cur = history.filter(F.col("valid_to").isNull()).withColumn("__h", F.lit(True))
    j = cur.alias("h").join(snap.alias("s"), key, "full_outer")
    h_in, s_in = F.col("h.__h").isNotNull(), F.col("s.__s").isNotNull()
    same = _same(check_cols, "h", "s")
    hrow = F.struct(*[F.col(k) for k in key], *[F.col(f"h.{c}").alias(c) for c in vals],
                    F.col("h.valid_from").alias("valid_from"), F.col("h.valid_to").alias("valid_to"))
    hclose = F.struct(*[F.col(k) for k in key], *[F.col(f"h.{c}").alias(c) for c in vals],
                      F.col("h.valid_from").alias("valid_from"), ts.alias("valid_to"))
    snew = F.struct(*[F.col(k) for k in key], *[F.col(f"s.{c}").alias(c) for c in vals],
                    ts.alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_to"))
    deleted = hclose if close_deletes else hrow
    rows = (F.when(h_in & s_in & same, F.array(hrow))
            .when(h_in & s_in, F.array(hclose, snew))
            .when(h_in, F.array(deleted))
            .otherwise(F.array(snew)))
    out = j.select(F.explode(rows).alias("r")).select("r.*")
    return closed.select(*out.columns).unionByName(out)


OPEN, CLOSED = "open", "closed"  # partitions of a stored history; closed ones are named by their closing run


def publish_history(spark: SparkSession, root: str, snapshot: DataFrame, key: Sequence[str], check_cols: Sequence[str],
                    run_ts, checks: Sequence[Check] | None = None, close_deletes: bool = True,
                    keep: Sequence[str] = ()) -> tuple[int, DataFrame]:
    """Apply one snapshot run to the history stored under ``root`` and publish
    the result behind its checks; returns (version, history). ``keep`` names further
    columns that are stored, but whose changes open no new row.

    The run reads the open rows only, writes them anew and adds the rows that it
    closes in a folder of their own (``valid_to`` is this run's time there). Row-level
    checks are counted on what is written, the others run on the whole history. A
    failed check leaves the version before current; a run that repeats the last
    snapshot closes nothing.
    """
    state = table_state(spark, root)
    old = [] if state.manifest is None else [(r.partition, r.path) for r in state.manifest.collect()]  # a row for each run
    open_paths = [p for part, p in old if part == OPEN]
    kept = [(part, p) for part, p in old if part.startswith(CLOSED)]
    stored = spark.read.parquet(*open_paths) if open_paths else None
    if len(kept) + len(open_paths) < len(old):  # a history of one part, as stored before: split by this run
        stored, kept = spark.read.parquet(*[p for _, p in old]), []
    step = scd2_apply(stored, snapshot.select(*key, *check_cols, *keep), key, check_cols, run_ts, close_deletes)
    part = F.when(F.col("valid_to").isNull(), F.lit(OPEN)).otherwise(F.lit(CLOSED))
    sizes = Observation(f"history-{uuid.uuid4().hex}")
    observed = observe_checks(step, checks or [])
    ddir = f"{root}/data/history-{uuid.uuid4().hex[:12]}"
    (observed.df.withColumn("__p", part).observe(sizes, *[F.count_if(F.col("__p") == x).alias(x) for x in (OPEN, CLOSED)])
     .write.partitionBy("__p").parquet(ddir))
    written = sizes.get
    names = {OPEN: OPEN, CLOSED: f"{CLOSED}:{run_ts}"}
    rows = kept + [(names[x], f"{ddir}/__p={x}") for x in (OPEN, CLOSED) if written[x]]
    history = (spark.read.schema(step.schema).parquet(*[p for _, p in rows]) if rows
               else spark.createDataFrame([], step.schema))
    failures = observed.report()
    if observed.rest:
        failures += [r.asDict() for r in run_checks(history, observed.rest).collect()]
    gate_rows(failures)
    if not rows:  # neither history nor snapshot
        return state.version, history
    last = -1 if state.last_batch is None else state.last_batch
    commit(spark.createDataFrame([(part, p, last) for part, p in rows], MANIFEST_SCHEMA), root, state.version + 1)
    return state.version + 1, history


def scd2_replay(snapshots: DataFrame, key: Sequence[str], check_cols: Sequence[str],
                run_col: str = "run_ts", runs: DataFrame | None = None) -> DataFrame:
    """History of all runs in ``snapshots`` (one row per key and run).

    ``runs`` (one ``run_col`` row per run, e.g. from the snapshot table's
    partition listing) spares a distinct pass over the snapshots. A run in
    ``runs`` with no snapshot row at all closes every key.
    """
    key = list(key)
    vals = [c for c in snapshots.columns if c not in key and c != run_col]
    # One row per run: a handful of rows, numbered with a global window.
    runs = (snapshots.select(run_col).distinct() if runs is None
            else runs.select(run_col).distinct())
    rw = Window.orderBy(run_col)
    runs = runs.select(run_col, F.row_number().over(rw).alias("__seq"))
    # One row per run: broadcast behind a size check, so the history is not dealt out by a few run times.
    runs_fit = fits(runs, MAX_BROADCAST_RUNS)
    runs = F.broadcast(runs) if runs_fit else runs
    s = snapshots.join(runs, run_col)
    w = Window.partitionBy(*key).orderBy("__seq")
    chk = F.struct(*[F.col(c) for c in check_cols])
    s = s.withColumn("__chk", chk)
    prev_seq = F.lag("__seq").over(w)
    prev_chk = F.lag("__chk").over(w)
    brk = (prev_seq.isNull() | (prev_seq != F.col("__seq") - 1)
           | ~prev_chk.eqNullSafe(F.col("__chk")))
    s = s.withColumn("__new", brk.cast("int"))
    s = s.withColumn("__isl", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    g = s.groupBy(*key, "__isl").agg(
        F.min("__seq").alias("__f"), F.max("__seq").alias("__l"),
        F.min_by(F.struct(*[F.col(c) for c in vals]), F.col("__seq")).alias("__v"))
    rf = runs.select(F.col("__seq").alias("__f"), F.col(run_col).alias("valid_from"))
    rt = runs.select((F.col("__seq") - 1).alias("__l"), F.col(run_col).alias("valid_to"))
    if runs_fit:
        rf, rt = F.broadcast(rf), F.broadcast(rt)
    out = g.join(rf, "__f").join(rt, "__l", "left")
    return out.select(*key, *[F.col("__v")[c].alias(c) for c in vals],
                      F.col("valid_from").cast("timestamp_ntz").alias("valid_from"),
                      F.col("valid_to").cast("timestamp_ntz").alias("valid_to"))
