"""Hot-key experiment for the as-of sweep: largest window group with and without slicing.

A third of all events are given one user id (by expression), so one (user,
month) group holds a third of the rows. The tool reports the largest
(by, bucket) group the sweep's window would process, and checks both variants
return the same rows.

Usage: python tools/skew_check.py [sf_dir] [slice_rows]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from seriesmart.operators import asof  # noqa: E402
from seriesmart.plans.inputs import table  # noqa: E402
from seriesmart.session import local_session  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    slice_rows = int(sys.argv[2]) if len(sys.argv) > 2 else 2000
    spark = local_session(cores=4, shuffle_partitions=8)
    ev = table(spark, sf_dir, "events").withColumn(
        "user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
    p = ev.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    c = ev.filter(F.col("event_type") == "click").select(
        "user_id", F.col("event_id").alias("click_event_id"), F.col("ts").alias("click_ts"))
    # The union the sweep windows over, bucketed as the sweep does.
    probes = p.select("user_id", F.col("ts").alias(asof._T)).distinct()
    builds = c.select("user_id", F.col("click_ts").alias(asof._T), F.lit(0).alias(asof._SIDE))
    u = builds.unionByName(probes.withColumn(asof._SIDE, F.lit(1)))
    plain = u.withColumn(asof._B, asof._bucket("month"))
    sliced = asof._sliced(u, ["user_id"], "month", slice_rows)
    for name, df in (("plain", plain), ("sliced", sliced)):
        g = df.groupBy("user_id", asof._B).count()
        r = g.agg(F.max("count").alias("mx"), F.sum("count").alias("n"), F.count("*").alias("groups")).first()
        print(f"{name}: rows={r.n} groups={r.groups} largest_group={r.mx}")
    t0 = time.perf_counter()
    a = asof.asof_join(p, c, "ts", "click_ts", by=["user_id"], tie_break=["click_event_id"])
    b = asof.asof_join(p, c, "ts", "click_ts", by=["user_id"], tie_break=["click_event_id"],
                       slice_rows=slice_rows)
    same = a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    print(f"same rows: {same} ({a.count()} rows, {time.perf_counter() - t0:.1f}s)")

    # Few, long series: one tick per line item, three series (return flags).
    from seriesmart.operators.series import layout, returns_and_rolling
    li = table(spark, sf_dir, "lineitem")
    ticks = li.select(F.col("l_returnflag").alias("k"),
                      F.timestamp_seconds(F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("t"),
                      F.col("l_extendedprice").cast("decimal(18,2)").alias("p"))
    plain_sizes = ticks.groupBy("k").count().agg(F.max("count")).first()[0]
    lay = layout(ticks, ["k"], "t", halo=30, halo_chunk=10000, bucket="day")
    halo_sizes = lay.df.groupBy(*lay.partition).count().agg(F.max("count"), F.count("*")).first()
    print(f"long series: plain largest window partition={plain_sizes}; "
          f"halo largest={halo_sizes[0]} over {halo_sizes[1]} chunks")
    x = returns_and_rolling(ticks, ["k"], "t", "p")
    y = returns_and_rolling(ticks, ["k"], "t", "p", halo_chunk=10000, bucket="day")
    print(f"long series same rows: {x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0}")
    spark.stop()


if __name__ == "__main__":
    main()
