"""Landed files and the bronze layer.

* S4  hive layout ``source=/dataset=/ingest_date=``; a re-run overwrites only
  its day (dynamic partition overwrite), readers prune partitions.
* S5  JSON documents, one VARIANT row per document, with lineage (S8).
* S6  wide CSV read by position, only the projected columns are parsed.
* S7  file selection by regex on the full path (and/or a glob on the name).
* S9  idempotent incremental load: listing anti-joined with a ledger; the files
  to load are planned as a table, read by folder and semi-joined to that plan.
* S10 load policies: ``abort`` / ``continue`` / ``skip_file``.
* S11 file listing through the ``binaryFile`` source without content.

Paths are strings understood by Hadoop file systems; nothing is read or
written through the driver's local disk.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import drop_path, path_exists

LINEAGE = ("_src_file", "_loaded_at")
POLICIES = ("abort", "continue", "skip_file")


def run_stamp(run_ts) -> F.Column:
    """one load time per run, as ``timestamp_ntz`` (explicit, not now())."""
    if isinstance(run_ts, (dt.datetime, dt.date)):
        run_ts = run_ts.isoformat(sep=" ") if isinstance(run_ts, dt.datetime) else run_ts.isoformat()
    return F.lit(str(run_ts)).cast("timestamp_ntz")


def write_landing(df: DataFrame, root: str, fmt: str = "text",
                  partition_cols=("source", "dataset", "ingest_date")) -> None:
    """Write under the hive layout; a re-run replaces only its partitions.

    The ``rebalance`` hint lets AQE size the write tasks by bytes: small
    partition values end up in few files, and a hot one (a day holding a
    third of the data) is split across several tasks instead of one.
    """
    (df.hint("rebalance", *partition_cols).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols).format(fmt).save(root))


@dataclass(frozen=True)
class LoadPlan:
    """The files that a load sets out to read: a written table (``path,
    modificationTime, length, file``), the folders that hold them and the range of
    their modification times (microseconds). Readers take a plan like a path."""

    files: DataFrame
    count: int
    folders: tuple[str, ...]
    first: int
    last: int


def _opened(path, read) -> DataFrame:
    """The records of a path or of a plan's files, with ``_src_file``. ``read(path,
    recursive)`` opens folders. Whole folders are read; files outside the plan's
    range of modification times are left out of the scan itself (a filter on file
    metadata prunes the listing), the others by a semi join."""
    planned = isinstance(path, LoadPlan)
    df = read([_literal(f) for f in path.folders] if planned else path, planned)
    time = F.col("_metadata.file_modification_time")
    if planned:
        df = df.filter(time.between(F.timestamp_micros(F.lit(path.first)), F.timestamp_micros(F.lit(path.last))))
    df = df.withColumn("_src_file", F.col("_metadata.file_path"))
    if planned:
        df = df.join(path.files.select(F.col("file").alias("_src_file")), "_src_file", "left_semi")
    return df


def _select_files(df: DataFrame, pattern: str | None) -> DataFrame:
    if pattern:
        df = df.filter(F.col("_src_file").rlike(pattern))
    return df


def _check_policy(on_error: str) -> None:
    if on_error not in POLICIES:
        raise ValueError(f"on_error must be one of {POLICIES}")


def apply_policy(df: DataFrame, on_error: str) -> DataFrame:
    """Rows of a scan (``_src_file``, ``_reject``) that a policy keeps: ``abort``
    raises on the first rejected record, ``continue`` drops rejected records,
    ``skip_file`` drops every file that holds one. What is dropped stays
    available through :func:`rejected`."""
    _check_policy(on_error)
    bad = F.col("_reject").isNotNull()
    if on_error == "abort":
        return df.withColumn("_src_file", F.when(bad, F.raise_error(F.concat(
            F.col("_reject"), F.lit(" in "), F.col("_src_file")))).otherwise(F.col("_src_file"))).drop("_reject", "_record")
    if on_error == "continue":
        return df.filter(~bad).drop("_reject", "_record")
    bad_files = df.filter(bad).select("_src_file").distinct()
    return df.join(bad_files, "_src_file", "left_anti").drop("_reject", "_record")


def rejected(df: DataFrame) -> DataFrame:
    """``DF[_src_file, record, reason, _loaded_at]``: the rejected records of a scan."""
    return df.filter(F.col("_reject").isNotNull()).select(
        "_src_file", F.col("_record").alias("record"), F.col("_reject").alias("reason"), "_loaded_at")


def scan_documents(spark: SparkSession, path, run_ts, pattern: str | None = None,
                   name_glob: str | None = None, whole_file: bool = False, strict: bool = False) -> DataFrame:
    """Documents with ``_record`` (their text) and ``_reject`` (why a broken one
    cannot be loaded, else NULL). ``strict`` raises the parser's own error."""
    r = spark.read
    if name_glob:
        r = r.option("pathGlobFilter", name_glob)
    # text() sets its own defaults, so pass the options there.
    df = _opened(path, lambda p, deep: r.text(p, wholetext=whole_file, recursiveFileLookup=deep or None))
    df = _select_files(df, pattern)
    text = F.col("value")
    if not whole_file:
        df = df.filter(F.trim(text) != "")
    df = df.withColumn("raw", (F.parse_json if strict else F.try_parse_json)(text))
    parts = [c for c in df.columns if c not in ("value", "raw", "_src_file")]
    why = F.when(F.col("raw").isNull(), F.lit("broken document"))
    return df.select("raw", "_src_file", run_stamp(run_ts).alias("_loaded_at"), *parts,
                     text.alias("_record"), why.alias("_reject"))


def read_documents(spark: SparkSession, path, run_ts, pattern: str | None = None,
                   name_glob: str | None = None, whole_file: bool = False,
                   on_error: str = "abort") -> DataFrame:
    """S5 + S7 + S8: ``DF[raw VARIANT, _src_file, _loaded_at, <partition cols>]``.

    Newline-delimited documents give one row per line; ``whole_file=True``
    reads each file as one document (pretty-printed JSON, a top-level array
    stays one row, trap T15). ``on_error``: see :func:`apply_policy`.
    """
    _check_policy(on_error)
    df = scan_documents(spark, path, run_ts, pattern, name_glob, whole_file, strict=on_error == "abort")
    return apply_policy(df, on_error)


CORRUPT = "_corrupt_record"


def scan_positional_csv(spark: SparkSession, path, n_cols: int, project: Mapping[int, tuple[str, str]],
                        run_ts, pattern: str | None = None, header: bool = True) -> DataFrame:
    """The projected columns with ``_record`` (the projected texts) and ``_reject``:
    a row with too few or too many fields, or a value that does not parse."""
    schema = T.StructType([*[T.StructField(f"c{i}", T.StringType()) for i in range(1, n_cols + 1)],
                           T.StructField(CORRUPT, T.StringType())])
    r = (spark.read.schema(schema).option("header", header).option("enforceSchema", True)
         .option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE")
         .option("columnNameOfCorruptRecord", CORRUPT)
         .option("columnPruning", False))  # the fields of a row are only counted when all are parsed
    df = _select_files(_opened(path, lambda p, deep: r.csv(p, recursiveFileLookup=deep or None)), pattern)
    why, typed = F.when(F.col(CORRUPT).isNotNull(), F.lit("wrong number of fields")), []
    for pos, (name, type_) in sorted(project.items()):
        raw = F.col(f"c{pos}")
        t = raw.try_cast(type_) if type_ != "string" else raw
        typed.append(t.alias(name))
        why = F.coalesce(why, F.when(raw.isNotNull() & t.isNull(), F.concat(F.lit(f"bad value for {name}: "), raw)))
    record = F.coalesce(F.col(CORRUPT), F.concat_ws(",", *[F.coalesce(F.col(f"c{p}"), F.lit("")) for p in sorted(project)]))
    return df.select(*typed, "_src_file", run_stamp(run_ts).alias("_loaded_at"), record.alias("_record"),
                     why.alias("_reject"))


def read_positional_csv(spark: SparkSession, path, n_cols: int,
                        project: Mapping[int, tuple[str, str]], run_ts,
                        pattern: str | None = None, on_error: str = "abort",
                        header: bool = True) -> DataFrame:
    """``SELECT $1, $5::date, ...`` over a wide CSV; quoted, empty = NULL.

    Every column is declared as string (no inference). ``on_error``: see
    :func:`apply_policy`.
    """
    _check_policy(on_error)
    return apply_policy(scan_positional_csv(spark, path, n_cols, project, run_ts, pattern, header), on_error)


def list_files(spark: SparkSession, path: str, pattern: str | None = None,
               name_glob: str | None = None) -> DataFrame:
    """``DF[path, modificationTime, length, file]``; file contents are not read.
    ``file`` is the path as the lineage columns have it."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if name_glob:
        r = r.option("pathGlobFilter", name_glob)
    df = r.load(path).select("path", "modificationTime", "length", F.col("_metadata.file_path").alias("file"))
    if pattern:
        df = df.filter(F.col("path").rlike(pattern))
    return df


def pending_files(listing: DataFrame, ledger: DataFrame | None) -> DataFrame:
    """Files not loaded yet. A rewritten file (new mtime/length) is pending
    again (trap T14)."""
    if ledger is None:
        return listing
    keys = ["path", "modificationTime", "length"]
    return listing.join(ledger.select(*keys), keys, "left_anti")


@dataclass(frozen=True)
class LoadResult:
    """Files loaded, files skipped (they stay pending), records rejected."""

    loaded: int
    skipped: int = 0
    rejected: int = 0


def _literal(path: str) -> str:
    """A path that readers take as it is, not as a glob."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


MAX_FOLDERS = 1000  # folders that a load names to the reader; beyond, it reads below the landing root
FILE_COLUMNS = ("path", "modificationTime", "length", "file")


def plan_load(spark: SparkSession, pending: DataFrame, plan_path: str, landing: str) -> LoadPlan | None:
    """Write the pending files down and say how to read them; None (and nothing
    written) when there are none. Only folder names and counts come to the driver."""
    pending.select(*FILE_COLUMNS).write.parquet(plan_path)
    files = spark.read.schema(pending.select(*FILE_COLUMNS).schema).parquet(plan_path)
    time = F.unix_micros("modificationTime")
    parts = (files.groupBy(F.regexp_replace("path", "/[^/]*$", "").alias("folder"))
             .agg(F.count("*").alias("n"), F.min(time).alias("first"), F.max(time).alias("last"))
             .limit(MAX_FOLDERS + 1).collect())
    if not parts:
        drop_path(spark, plan_path)
        return None
    if len(parts) > MAX_FOLDERS:
        total = files.agg(F.count("*").alias("n"), F.min(time).alias("first"), F.max(time).alias("last")).first()
        return LoadPlan(files, total.n, (landing,), total.first, total["last"])
    # A folder below another one is read with it.
    folders, names = [], {r.folder for r in parts}
    for f in sorted(names):
        above = f.split("/")
        if not any("/".join(above[:i]) in names for i in range(1, len(above))):
            folders.append(f)
    return LoadPlan(files, sum(r.n for r in parts), tuple(folders), min(r["first"] for r in parts),
                    max(r["last"] for r in parts))


COMMIT_SCHEMA = T.StructType([T.StructField("run", T.StringType()), T.StructField("loaded_at", T.TimestampNTZType()),
                              T.StructField("files", T.LongType()), T.StructField("rejected", T.LongType())])


LEDGER_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()), T.StructField("file", T.StringType()), T.StructField("run", T.StringType()),
    T.StructField("_loaded_at", T.TimestampNTZType())])


def commits_path(bronze: str) -> str:
    return f"{bronze}/commits"


def read_commits(spark: SparkSession, bronze: str) -> DataFrame | None:
    """One row per committed load run: ``run, loaded_at, files, rejected``."""
    path = commits_path(bronze)
    if not path_exists(spark, path):
        return None
    return spark.read.schema(COMMIT_SCHEMA).option("recursiveFileLookup", True).parquet(path)


def read_ledger(spark: SparkSession, bronze: str) -> DataFrame | None:
    """The files of committed runs: ``path, modificationTime, length, file, run, _loaded_at``."""
    commits = read_commits(spark, bronze)
    if commits is None or not path_exists(spark, f"{bronze}/ledger"):
        return None
    ledger = spark.read.schema(LEDGER_SCHEMA).option("recursiveFileLookup", True).parquet(f"{bronze}/ledger")
    return ledger.join(commits.select("run"), "run", "left_semi")


def load_pending(spark: SparkSession, landing: str, bronze: str, run_ts, pattern: str | None = None,
                 scan=None, on_error: str = "abort", listing: DataFrame | None = None) -> LoadResult:
    """S9 + S10: load the files that are not in the ledger.

    ``bronze`` holds for each run ``plan/run=<id>/`` (the files that it set out to
    load), ``data/run=<id>/``, ``rejects/run=<id>/`` (every record that a policy
    dropped, with its reason), ``ledger/run=<id>/`` (the files that it loaded) and,
    written last, one row in ``commits/<id>/``. Readers only see runs with a commit
    (:func:`read_bronze`), so a crash leaves an invisible orphan and the retry loads
    the files again once. Files that ``skip_file`` leaves out get no entry and are
    tried again by the next load. ``scan(spark, plan, run_ts)`` decodes the pending
    files (default: :func:`scan_documents`); a plan goes where a path does.
    ``listing`` reuses a listing of the landing root shared by several feeds.

    The list of files stays a table: it is written, counted and joined by the
    cluster, whatever its length.
    """
    _check_policy(on_error)
    if listing is None:
        listing = list_files(spark, landing, pattern)
    elif pattern:
        listing = listing.filter(F.col("path").rlike(pattern))
    run_id = "r" + uuid.uuid4().hex[:12]  # a letter first: never read as a number
    plan = plan_load(spark, pending_files(listing, read_ledger(spark, bronze)), f"{bronze}/plan/run={run_id}", landing)
    if plan is None:
        return LoadResult(0)
    scanned, files = (scan or scan_documents)(spark, plan, run_ts), plan.files
    n_rejected, loaded = 0, plan.count
    if on_error != "abort":
        rejected(scanned).write.parquet(f"{bronze}/rejects/run={run_id}")
        rejects = spark.read.parquet(f"{bronze}/rejects/run={run_id}")
        n_rejected = rejects.count()
        if on_error == "skip_file" and n_rejected:
            bad = rejects.select(F.col("_src_file").alias("file")).distinct()
            scanned = scanned.join(bad.withColumnRenamed("file", "_src_file"), "_src_file", "left_anti")
            files = files.join(bad, "file", "left_anti")
            loaded = files.count()
    apply_policy(scanned, on_error).write.parquet(f"{bronze}/data/run={run_id}")
    if loaded:
        (files.withColumn("run", F.lit(run_id)).withColumn("_loaded_at", run_stamp(run_ts))
         .write.parquet(f"{bronze}/ledger/run={run_id}"))
        commit = spark.range(1).select(F.lit(run_id).alias("run"), run_stamp(run_ts).alias("loaded_at"),
                                       F.lit(loaded).cast("long").alias("files"),
                                       F.lit(n_rejected).cast("long").alias("rejected"))
        commit.coalesce(1).write.parquet(f"{commits_path(bronze)}/{run_id}")  # one file: there whole or not at all
    return LoadResult(loaded, plan.count - loaded, n_rejected)


def incremental_load(spark: SparkSession, landing: str, bronze: str, run_ts, pattern: str | None = None,
                     scan=None, on_error: str = "abort", listing: DataFrame | None = None) -> int:
    """The number of files that :func:`load_pending` loaded."""
    return load_pending(spark, landing, bronze, run_ts, pattern, scan, on_error, listing).loaded


def read_bronze(spark: SparkSession, bronze: str) -> DataFrame:
    """Bronze rows of committed runs only. A file that was loaded again, rewritten
    or merely touched, counts with its last load.

    Runs none of whose files were loaded again, nearly all, are read as they are:
    typed paths into their documents reach the scan, which then reads the shredded
    fields alone. Only the other runs' rows are joined to the files that they lost.
    """
    commits, ledger = read_commits(spark, bronze), read_ledger(spark, bronze)
    if commits is None or ledger is None:
        raise FileNotFoundError(f"no committed load under {bronze}")
    last = Window.partitionBy("file").orderBy(F.desc("_loaded_at"), F.desc("modificationTime"), F.desc("run"))
    lost = (ledger.withColumn("__n", F.row_number().over(last)).where("__n > 1")
            .select(F.col("file").alias("_src_file"), F.col("run").alias("__run")))
    # Run ids are metadata: a few for each load.
    dirty = {r.run for r in lost.select(F.col("__run").alias("run")).distinct().collect()}
    clean = sorted({r.run for r in commits.select("run").collect()} - dirty)
    parts = [read_runs(spark, bronze, clean)] if clean else []
    if dirty:
        again = spark.read.option("basePath", f"{bronze}/data").parquet(*[f"{bronze}/data/run={r}" for r in sorted(dirty)])
        again = again.withColumnRenamed("run", "__run").withColumn("__run", F.col("__run").cast("string"))
        parts.append(again.join(lost, ["_src_file", "__run"], "left_anti").drop("__run"))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def read_runs(spark: SparkSession, bronze: str, runs: Sequence[str]) -> DataFrame:
    """What the given runs appended, row by row: the changes of the bronze table."""
    return spark.read.parquet(*[f"{bronze}/data/run={r}" for r in runs])


def read_rejects(spark: SparkSession, bronze: str) -> DataFrame:
    """Every record that a load rejected: ``_src_file, record, reason, _loaded_at, run``."""
    return spark.read.option("basePath", f"{bronze}/rejects").parquet(f"{bronze}/rejects")
