"""The daily run as a job: validate control -> load bronze -> build and publish marts.

    spark-submit --py-files seriesmart.zip seriesmart/daily.py \\
        --landing abfss://raw@acct/ --bronze abfss://lake@acct/bronze \\
        --marts abfss://lake@acct/marts --run-ts "2026-04-21 06:00:00" \\
        [--control abfss://config@acct/control/sources.json]

The session comes from ``spark-submit`` (cluster settings, ``spark.checkpoint.dir``).
Fetching the feeds from their APIs happens before this job (files land under
``--landing``); this job never talks to the network.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

# Absolute imports: spark-submit runs this file as a script, with the package
# shipped in --py-files.
from seriesmart.operators.quality import gate
from seriesmart.plans.build import build_marts
from seriesmart.sources.bronze import FEEDS, feeds_from_control, load_feeds
from seriesmart.sources.control import read_control, validate_control


def run_daily(spark: SparkSession, landing: str, bronze: str, marts: str, run_ts,
              control: str | None = None, feeds=FEEDS, calendar: DataFrame | None = None):
    """Returns ``(load report, published versions)``; raises on a failed gate. With
    a control table, its enabled sources decide what is loaded."""
    if control:
        records = read_control(spark, control)
        gate(validate_control(records))
        feeds = feeds_from_control(records)
    report = load_feeds(spark, landing, bronze, run_ts, feeds)
    versions = build_marts(spark, bronze, marts, run_ts, calendar=calendar)
    return report, versions


def main(argv=None):
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--landing", required=True)
    ap.add_argument("--bronze", required=True)
    ap.add_argument("--marts", required=True)
    ap.add_argument("--run-ts", required=True)
    ap.add_argument("--control")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("seriesmart-daily").getOrCreate()
    report, versions = run_daily(spark, a.landing, a.bronze, a.marts, a.run_ts, a.control)
    report.show(truncate=False)
    versions.show(truncate=False)


if __name__ == "__main__":
    main()
