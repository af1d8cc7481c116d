"""The change feed of a bronze table.

A bronze table only grows, run by run, and every committed load run leaves one
row in its commit log. The feed streams that log: its checkpoint holds the runs
already seen, a micro-batch is the runs committed since (C2: without one, no
batch), and the batch's rows are what these runs appended. Documents are decoded
from the bronze table, so they are parsed once, by the load.

Exactly once: a run is one file of the log, so it lies in one micro-batch only;
a batch replayed after a failure has the same id, which the target's manifest
already records (:func:`merge_upsert`). Orphans of crashed loads never appear.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.merge import merge_upsert
from ..session import make_path
from ..sources.landing import COMMIT_SCHEMA, commits_path, read_runs


def bronze_changes(spark: SparkSession, bronze: str, max_runs_per_trigger: int | None = None) -> DataFrame:
    """The commit log of a bronze table as a stream of ``run, loaded_at, files, rejected``."""
    make_path(spark, commits_path(bronze))  # a table that was never loaded has no changes
    r = spark.readStream.schema(COMMIT_SCHEMA).option("recursiveFileLookup", True)
    if max_runs_per_trigger:
        r = r.option("maxFilesPerTrigger", max_runs_per_trigger)  # a run is one file
    return r.parquet(commits_path(bronze))


def start_bronze_feed(spark: SparkSession, bronze: str, target: str, checkpoint: str,
                      decode: Callable[[DataFrame], DataFrame], keys: Sequence[str], order_by: Sequence[str],
                      partition: str, max_runs_per_trigger: int | None = None, available_now: bool = True,
                      interval: str = "60 minutes", on_conflict: str = "latest") -> StreamingQuery:
    """Merge every change of the bronze table into the versioned table ``target``.

    ``decode(rows) -> DataFrame`` turns appended bronze rows (``raw``, ``_src_file``,
    ``_loaded_at`` for documents) into typed rows with the merge's columns. Each
    micro-batch is one merge, however many runs it holds.
    """
    def merge(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        runs = sorted(r.run for r in batch.select("run").collect())  # run ids: a few for each load
        if runs:
            merge_upsert(session, target, decode(read_runs(session, bronze, runs)), keys, order_by, partition,
                         batch_id=batch_id, on_conflict=on_conflict)

    w = (bronze_changes(spark, bronze, max_runs_per_trigger).writeStream.foreachBatch(merge)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()
