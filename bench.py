"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is run once to warm up, then ``BENCH_RUNS`` (default 3) times;
the median wall time is reported. Results go to the ``noop`` sink so every
column is computed; the row count comes from ``observe`` in the same pass.
Prints ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [--all] [name ...]
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))

from pyspark.sql import Observation  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from seriesmart.plans.registry import load_all  # noqa: E402
from seriesmart.session import local_session  # noqa: E402

HEADLINE = [
    "fx_returns", "rolling_mean", "rolling_volatility", "latest_wins", "latest_wins_max_by",
    "asof_keyed", "asof_single", "asof_multi", "asof_chained", "flatten_nested",
    "cdc_upsert", "scd2_replay", "quality_report", "share_of_total", "star_rollup",
    "asof_hot_bucket", "mart_daily_market_signals", "marts_published",
]


def run_once(spark, fn, sf_dir):
    t0 = time.perf_counter()
    df = fn(spark, sf_dir)
    obs = Observation()
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.format("noop").mode("overwrite").save()
    rows = obs.get["rows"]
    return time.perf_counter() - t0, rows


def per_check_jobs(spark, sf_dir):
    """The quality report as one job per check, for comparison."""
    from seriesmart.operators.quality import run_checks
    from seriesmart.plans.quality import _checks, defective_orders
    t0 = time.perf_counter()
    df = defective_orders(spark, sf_dir)
    for group in _checks(spark, sf_dir).values():
        for c in group:
            run_checks(df, [c]).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main():
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cores=cpus, shuffle_partitions=max(8, 2 * cpus), app="seriesmart-bench")
    qs = load_all()
    names = args or (sorted(qs) if "--all" in sys.argv else HEADLINE)
    medians, rows = {}, {}
    for name in names:
        fn = qs[name].fn
        run_once(spark, fn, sf_dir)  # warm-up
        times = []
        for _ in range(runs):
            t, n = run_once(spark, fn, sf_dir)
            times.append(t)
        medians[name] = round(statistics.median(times), 3)
        rows[name] = n
    extra = {}
    if not args:
        per_check_jobs(spark, sf_dir)
        extra["quality_per_check_jobs"] = round(statistics.median(
            per_check_jobs(spark, sf_dir) for _ in range(runs)), 3)
    spark.stop()
    sf = Path(sf_dir).name.replace("sf", "")
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(medians.values()), 3),
                      "unit": "sec", "queries": medians, "rows": rows, "compare": extra,
                      "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": cpus, "runs": runs}))


if __name__ == "__main__":
    main()
