"""K4 / C3 upsert into a versioned Parquet table, and its publish protocol (§4.3).

Plain Parquet has no MERGE. A table here is a folder of immutable data
folders plus a manifest:

    <root>/data/b=<batch>-<id>/__p=<partition>/part-*.parquet
    <root>/_manifest/v=<n>/part-*.parquet     (partition, path, batch_id)

An upsert reads only the partitions its delta touches, keeps one row per key
(delta deduplicated first, trap T6), writes just those partitions to a new
data folder and then commits a new manifest version that points untouched
partitions at their old folders. Readers use the highest manifest version, so
a job that dies before its manifest is written leaves only an invisible
orphan. The manifest records the batch id: replaying a batch is a no-op.

The partition must be a function of the key (e.g. the month of a date key or
a hash bucket), otherwise one key could live in two partitions. Its grain
decides the rewrite cost: a batch rewrites every partition it touches, so
time-series grains should partition by the period of their date key (a
batch of recent days touches recent months only), and keys without time
locality by hash buckets fine enough that a batch touches a small share.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .dedupe import latest_wins

NULL_PARTITION = "__null__"  # stands for NULL in folder names and manifests
_SAFE = re.compile(r"^[A-Za-z0-9_.\-]+$")
MANIFEST_SCHEMA = T.StructType([
    T.StructField("partition", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("batch_id", T.LongType()),
])
_VERSIONED = T.StructType([*MANIFEST_SCHEMA.fields, T.StructField("v", T.IntegerType())])


def _exists(spark: SparkSession, path: str) -> bool:
    from ..session import path_exists
    return path_exists(spark, path)


class ConcurrentCommit(RuntimeError):
    """Another writer committed the version that this one was about to write."""


@dataclass
class TableState:
    version: int
    last_batch: int | None
    manifest: DataFrame | None


def table_state(spark: SparkSession, root: str) -> TableState:
    """Current manifest version (one small aggregate over the manifest)."""
    mpath = f"{root}/_manifest"
    if not _exists(spark, mpath):
        return TableState(0, None, None)
    try:
        m = spark.read.schema(_VERSIONED).parquet(mpath)
    except AnalysisException:
        return TableState(0, None, None)  # nothing but an interrupted first commit
    # One small job: the newest version and the batch id it recorded.
    row = m.agg(F.max("v").alias("v"), F.max_by("batch_id", "v").alias("b")).first()
    if row["v"] is None:
        return TableState(0, None, None)
    cur = m.filter(F.col("v") == row["v"]).drop("v")
    last = None if row["b"] is None or row["b"] < 0 else int(row["b"])
    return TableState(int(row["v"]), last, cur)


def read_table(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame:
    """The current version of a versioned table (empty frame if none)."""
    st = table_state(spark, root)
    paths = [] if st.manifest is None else [r.path for r in st.manifest.select("path").collect()]
    if not paths:
        if schema is None:
            raise FileNotFoundError(f"no committed version under {root}")
        return spark.createDataFrame([], schema)
    return spark.read.parquet(*paths)


def merge_upsert(spark: SparkSession, root: str, delta: DataFrame, keys: Sequence[str],
                 order_by: Sequence[str], partition: str, batch_id: int | None = None,
                 on_conflict: str = "latest") -> bool:
    """Upsert ``delta`` into the table at ``root``; returns False for a replay.

    ``on_conflict="latest"``: across target and delta the greatest
    ``order_by`` wins (out-of-order files are safe); ``"delta"``: a matched
    delta row always replaces the target row (plain MERGE ... UPDATE).
    Within the delta the greatest ``order_by`` wins either way. Rows without a
    partition value live in a partition of their own.
    """
    keys, order_by = list(keys), list(order_by)
    if on_conflict not in ("latest", "delta"):
        raise ValueError("on_conflict must be 'latest' or 'delta'")
    st = table_state(spark, root)
    if batch_id is not None and st.last_batch is not None and batch_id <= st.last_batch:
        return False
    # The delta is used twice (touched partitions, then the merge): keep it.
    d = latest_wins(delta, keys, order_by).persist()
    value = F.coalesce(F.col(partition).cast("string"), F.lit(NULL_PARTITION))
    # Partition values touched by this delta: metadata-sized (e.g. months).
    touched = sorted(r[0] for r in d.select(value).distinct().collect())
    if not touched:
        d.unpersist()
        return False
    bad = [p for p in touched if not _SAFE.match(p)]
    if bad:
        raise ValueError(f"unsafe partition values {bad[:3]}")
    old_paths = []
    if st.manifest is not None:
        old_paths = [r.path for r in st.manifest.filter(F.col("partition").isin(touched))
                     .select("path").collect()]
    u = d.withColumn("__src", F.lit(1))
    if old_paths:
        old = spark.read.parquet(*old_paths).select(*d.columns).withColumn("__src", F.lit(0))
        u = old.unionByName(u)
    order = [*order_by, "__src"] if on_conflict == "latest" else ["__src", *order_by]
    merged = latest_wins(u, keys, order).drop("__src")
    bid = -1 if batch_id is None else int(batch_id)
    ddir = f"{root}/data/b={bid}-{uuid.uuid4().hex[:8]}"
    # Rebalance (not repartition) by partition value: AQE coalesces small
    # partitions into few files and splits a hot one across several tasks.
    (merged.withColumn("__p", value).hint("rebalance", "__p")
     .write.partitionBy("__p").parquet(ddir))
    new_rows = spark.createDataFrame(
        [(p, f"{ddir}/__p={p}", bid) for p in touched], MANIFEST_SCHEMA)
    kept = (st.manifest.filter(~F.col("partition").isin(touched)).select(*MANIFEST_SCHEMA.names)
            if st.manifest is not None else None)
    man = new_rows if kept is None else kept.unionByName(new_rows)
    # batch_id column keeps the newest batch id visible on every version.
    man = man.withColumn("batch_id", F.lit(max(bid, st.last_batch or -1)).cast("long"))
    commit(man, root, st.version + 1)
    d.unpersist()
    return True


def commit(manifest: DataFrame, root: str, version: int) -> None:
    """Write a version's manifest. A version counts once its (single) file is
    there; what an interrupted attempt left of it is replaced, a version that
    another writer has committed meanwhile is not."""
    spark, path = manifest.sparkSession, f"{root}/_manifest/v={version}"
    if _exists(spark, path) and not spark.read.schema(MANIFEST_SCHEMA).parquet(path).isEmpty():
        raise ConcurrentCommit(f"version {version} of {root} was committed by another writer")
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{root}/_manifest/v={version}")


def publish(spark: SparkSession, df: DataFrame, root: str, checks=None,
            fail_on: str = "error") -> int:
    """Publish behind the gate; returns the new version (see :func:`publish_table`)."""
    return publish_table(spark, df, root, checks, fail_on)[0]


def publish_table(spark: SparkSession, df: DataFrame, root: str, checks=None,
                  fail_on: str = "error") -> tuple[int, str]:
    """§4.3 + Q9: publish a full new version of a mart behind its quality gate.

    The data is written first to a fresh folder, and the row-level checks are
    counted by that write itself; only ``unique`` and ``relationships`` read the
    written table again (their column alone). A new manifest version is committed
    only when the gate passes; a failed gate raises and leaves the previous version
    current. Returns the new version number and the folder written, so a caller can
    read it back without the manifest.
    """
    from .quality import gate_rows, observe_checks, run_checks
    st = table_state(spark, root)
    ddir = f"{root}/data/full-{uuid.uuid4().hex[:12]}"
    observed = observe_checks(df, checks or [])
    observed.df.write.parquet(ddir)
    failures = observed.report()
    if observed.rest:
        written = spark.read.schema(df.schema).parquet(ddir)
        failures += [r.asDict() for r in run_checks(written, observed.rest).collect()]
    gate_rows(failures, fail_on)
    last = -1 if st.last_batch is None else st.last_batch
    man = spark.createDataFrame([("*", ddir, last)], MANIFEST_SCHEMA)
    commit(man, root, st.version + 1)
    return st.version + 1, ddir
