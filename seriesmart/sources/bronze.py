"""The bronze load of every feed in one job, with per-feed policies.

Each feed is an incremental load (ledger, S9) of the landed files matching
its pattern into its own bronze table. Feeds are independent: a failing feed
is recorded and the others still load (trap T16); afterwards the job raises if
any feed with the ``abort`` policy failed, so the run is marked failed. The
report has one row per feed.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .landing import list_files, load_pending, scan_documents, scan_positional_csv


@dataclass(frozen=True)
class Feed:
    table: str
    pattern: str
    fmt: str = "json"  # "json" documents or "csv" (positional)
    on_error: str = "abort"
    whole_file: bool = True  # one document per file (False: one per line)


# Fixed values that must equal the reference's: bronze table per feed and the
# file-name pattern its load selects; the CSV positions of the rate feed.
FEEDS = (
    Feed("nbp_fx_rates_raw", r".*nbp_table_a_.*[.]json"),
    Feed("eia_petroleum_spot_raw", r".*eia_.*_spot_.*[.]json"),
    Feed("openmeteo_weather_raw", r".*openmeteo_.*[.]json"),
    Feed("ecb_estr_raw", r".*ecb_estr_.*[.]csv", fmt="csv"),
    Feed("eurostat_civil_eng_raw", r".*eurostat_civil_eng_.*[.]json"),
    Feed("gus_roads_raw", r".*gus_expressways_motorways_.*[.]json"),
)
ECB_COLUMNS = 29
ECB_POSITIONS = {1: ("series_key", "string"), 5: ("obs_date", "date"),
                 6: ("obs_value", "decimal(18,6)"), 25: ("title", "string"),
                 28: ("unit", "string")}

REPORT = T.StructType([
    T.StructField("table", T.StringType()),
    T.StructField("files_loaded", T.LongType()),
    T.StructField("files_skipped", T.LongType()),
    T.StructField("records_rejected", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("error", T.StringType()),
])


class LoadError(RuntimeError):
    pass


def feeds_from_control(control: DataFrame, on_error: str = "abort") -> tuple[Feed, ...]:
    """Feeds of the enabled control records. A record whose file name a feed of
    ``FEEDS`` selects loads that feed's bronze table (several records may share
    one); any other loads ``<source_id>_raw``. The file-name template becomes the
    selection pattern (``{ingest_date}`` matches anything). The control table is a
    handful of records, collected as metadata."""
    from .control import PLACEHOLDER, enabled_sources
    patterns: dict[tuple, list[str]] = {}
    for r in enabled_sources(control).select("source_id", "file_name_template",
                                             "response_format").collect():
        pat = ".*" + re.escape(r.file_name_template).replace(re.escape(PLACEHOLDER), ".*")
        sample = "/" + r.file_name_template.replace(PLACEHOLDER, "2000-01-01")
        known = next((f for f in FEEDS if re.fullmatch(f.pattern, sample)), None)
        fmt = known.fmt if known else "csv" if (r.response_format or "").lower() == "csv" else "json"
        table = known.table if known else f"{r.source_id}_raw"
        patterns.setdefault((table, fmt), []).append(pat)
    return tuple(Feed(table, "(" + "|".join(sorted(p)) + ")$", fmt, on_error)
                 for (table, fmt), p in patterns.items())


def _scan(feed: Feed):
    if feed.fmt == "csv":
        return lambda s, paths, ts: scan_positional_csv(s, paths, ECB_COLUMNS, ECB_POSITIONS, ts)
    return lambda s, paths, ts: scan_documents(s, paths, ts, whole_file=feed.whole_file,
                                               strict=feed.on_error == "abort")


def load_feeds(spark: SparkSession, landing: str, bronze: str, run_ts,
               feeds=FEEDS, threads: int = 4) -> DataFrame:
    """Load every feed's new files; returns the per-feed report.

    Feeds are independent: ``threads`` of them load concurrently.
    """
    from concurrent.futures import ThreadPoolExecutor
    # One listing of the landing root per run, shared by all feeds (on an
    # object store the listing is the expensive part of a load).
    listing = list_files(spark, landing).persist()

    def one(f: Feed):
        try:
            n = load_pending(spark, landing, f"{bronze}/{f.table}", run_ts, pattern=f.pattern,
                             scan=_scan(f), on_error=f.on_error, listing=listing)
            status = ("loaded" if n.loaded else "skipped" if n.skipped else "nothing new")
            return (f.table, n.loaded, n.skipped, n.rejected, status, None)
        except Exception as e:  # noqa: BLE001 - recorded, re-raised below
            return (f.table, 0, 0, 0, "failed", str(e))

    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        rows = list(pool.map(one, feeds))
    listing.unpersist()
    failed = [r[0] for r, f in zip(rows, feeds) if r[4] == "failed" and f.on_error == "abort"]
    report = spark.createDataFrame(rows, REPORT)
    if failed:
        raise LoadError(f"bronze load failed for {failed}: " +
                        "; ".join((r[5] or "").split("\n")[0] for r in rows if r[0] in failed))
    return report
