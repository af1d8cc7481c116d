"""Per-series window analytics (W2-W6) and the halo layout for long series.

A plain ``Window.partitionBy(series)`` runs each series in one task: with few
but long series that is the bottleneck. ``halo_chunk=C`` instead gives every
row a dense per-series row number, cuts each series into chunks of ``C`` rows
and copies the last ``H`` rows of a chunk into the next one (``H`` = the
deepest look-back). Windows then run per (series, chunk), all tasks get
``C + H`` rows, and the copies are dropped afterwards. Results are identical
to the plain form.

Row numbers come from a per-(series, time bucket) count table (small: one row
per series and bucket) turned into offsets, plus ``row_number`` inside each
bucket. The grain (series, date) is unique after dedup, so a daily series has
at most 31 rows per monthly bucket: no bucket can be hot.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import pct_change
from .joins import null_safe_join


@dataclass
class SeriesLayout:
    """How to window a frame: the partition and order columns to use."""

    df: DataFrame
    partition: list[str]
    order: list[str]
    chunked: bool

    def window(self, lo=None, hi=None) -> Window:
        w = Window.partitionBy(*self.partition).orderBy(*self.order)
        if lo is not None or hi is not None:
            w = w.rowsBetween(Window.unboundedPreceding if lo is None else lo,
                              Window.currentRow if hi is None else hi)
        return w

    def finish(self, drop: Sequence[str] = ()) -> DataFrame:
        out = self.df
        if self.chunked:
            out = out.filter(~F.col("__halo")).drop("__halo", "__chunk", "__rn", "__b")
        return out.drop(*drop)


def layout(df: DataFrame, series: Sequence[str], order: str, halo: int,
           halo_chunk: int | None = None, bucket: str = "month") -> SeriesLayout:
    """Plain per-series layout, or chunks of ``halo_chunk`` rows plus a halo."""
    series = list(series)
    if not halo_chunk:
        return SeriesLayout(df, series, [order], False)
    if halo_chunk < halo:
        raise ValueError("halo_chunk must be at least the look-back depth")
    # Keys in structs, which are never NULL themselves: NULL keys and dates are a series and a
    # bucket like any other, and count, join and row numbers share one partitioning.
    d = df.withColumn("__s", F.struct(*series)).withColumn(
        "__b", F.struct(F.date_trunc(bucket, F.col(order)).alias("b")))
    counts = d.groupBy("__s", "__b").agg(F.count(F.lit(1)).alias("__n"))
    wb = Window.partitionBy("__s").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__s", "__b", F.coalesce(F.sum("__n").over(wb), F.lit(0)).alias("__off"))
    wr = Window.partitionBy("__s", "__b").orderBy(order)
    d = (d.join(offsets, ["__s", "__b"])
         .withColumn("__rn", F.col("__off") + F.row_number().over(wr) - 1)
         .drop("__off", "__s"))
    c = F.lit(halo_chunk)
    own = F.floor(F.col("__rn") / c)
    # Each row lives in its own chunk; the last `halo` rows of a chunk are
    # also copied, flagged as halo, into the next chunk.
    copies = F.when((F.lit(halo) > 0) & (F.col("__rn") % c >= c - F.lit(halo)),
                    F.array(F.struct(own.alias("k"), F.lit(False).alias("h")),
                            F.struct((own + 1).alias("k"), F.lit(True).alias("h")))
                    ).otherwise(F.array(F.struct(own.alias("k"), F.lit(False).alias("h"))))
    d = (d.withColumn("__c", F.explode(copies))
         .withColumn("__chunk", F.col("__c.k")).withColumn("__halo", F.col("__c.h"))
         .drop("__c"))
    return SeriesLayout(d, [*series, "__chunk"], ["__rn"], True)


def with_change(df: DataFrame, series: Sequence[str], order: str, value: str,
                prev: str = "prev_value", change: str | None = "change_abs",
                ret: str | None = "daily_return", halo_chunk: int | None = None,
                bucket: str = "month") -> DataFrame:
    """W2 + F7: previous value, absolute change, ``v / nullif(prev, 0) - 1``."""
    lay = layout(df, series, order, halo=1, halo_chunk=halo_chunk, bucket=bucket)
    out = lay.df.withColumn(prev, F.lag(value).over(lay.window()))
    if change:
        out = out.withColumn(change, F.col(value) - F.col(prev))
    if ret:
        out = out.withColumn(ret, pct_change(F.col(value), F.col(prev)))
    lay.df = out
    return lay.finish()


_ROLL = {
    "avg": F.avg,
    "sum": F.sum,
    "min": F.min,
    "max": F.max,
    "count": F.count,
    "stddev_samp": F.stddev_samp,
}


def rolling(df: DataFrame, series: Sequence[str], order: str, value: str, rows: int,
            fn: str = "avg", name: str | None = None, halo_chunk: int | None = None,
            bucket: str = "month") -> DataFrame:
    """``fn(value)`` over the current row and ``rows - 1`` before it.

    Frames are rows, not calendar days (trap T3): early rows use partial frames.
    """
    lay = layout(df, series, order, halo=rows - 1, halo_chunk=halo_chunk, bucket=bucket)
    lay.df = lay.df.withColumn(name or f"{fn}_{rows}",
                               _ROLL[fn](value).over(lay.window(-(rows - 1), 0)))
    return lay.finish()


def rolling_days(df: DataFrame, series: Sequence[str], date: str, value: str, days: int,
                 fn: str = "avg", name: str | None = None,
                 chunk_days: int | None = None) -> DataFrame:
    """Calendar variant of W3/W4 (trap T3): ``fn(value)`` over the rows whose
    date lies in ``[date - (days - 1), date]``, however many rows that is.

    ``chunk_days`` partitions each series into time chunks of that many days
    and copies the rows of the last ``days - 1`` days of a chunk into the next
    one (a time halo), so long series run in many tasks; copies are dropped
    after the window. Results equal the plain range window.
    """
    name = name or f"{fn}_{days}d"
    dn = F.datediff(F.col(date).cast("date"), F.lit("1970-01-01").cast("date"))
    d = df.withColumn("__dn", dn)
    part = list(series)
    if chunk_days:
        if chunk_days < days - 1:
            raise ValueError("chunk_days must cover the look-back")
        own = F.floor(F.col("__dn") / F.lit(chunk_days))
        nxt = (own + 1) * F.lit(chunk_days)
        copies = F.when(F.col("__dn") >= nxt - F.lit(days - 1),
                        F.array(F.struct(own.alias("k"), F.lit(False).alias("h")),
                                F.struct((own + 1).alias("k"), F.lit(True).alias("h")))
                        ).otherwise(F.array(F.struct(own.alias("k"), F.lit(False).alias("h"))))
        d = (d.withColumn("__c", F.explode(copies)).withColumn("__chunk", F.col("__c.k"))
             .withColumn("__halo", F.col("__c.h")).drop("__c"))
        part = [*part, "__chunk"]
    w = Window.partitionBy(*part).orderBy("__dn").rangeBetween(-(days - 1), 0)
    d = d.withColumn(name, _ROLL[fn](value).over(w))
    if chunk_days:
        d = d.filter(~F.col("__halo")).drop("__chunk", "__halo")
    return d.drop("__dn")


def returns_and_rolling(df: DataFrame, series: Sequence[str], order: str, value: str,
                        short: int = 7, long: int = 30,
                        halo_chunk: int | None = None, bucket: str = "month") -> DataFrame:
    """M7: lag, change, return, moving averages and rolling volatility.

    All windows share one (partition, order) spec, so Catalyst sorts once.
    The volatility window looks back ``long - 1`` returns, each needing one
    more row, hence a halo of ``long`` rows.
    """
    lay = layout(df, series, order, halo=long, halo_chunk=halo_chunk, bucket=bucket)
    d = lay.df
    d = d.withColumn("prev_value", F.lag(value).over(lay.window()))
    d = (d.withColumn("change_abs", F.col(value) - F.col("prev_value"))
         .withColumn("daily_return", pct_change(F.col(value), F.col("prev_value"))))
    d = (d.withColumn("ma_short", F.avg(value).over(lay.window(-(short - 1), 0)))
         .withColumn("ma_long", F.avg(value).over(lay.window(-(long - 1), 0)))
         .withColumn("volatility_long",
                     F.stddev_samp("daily_return").over(lay.window(-(long - 1), 0))))
    lay.df = d
    return lay.finish()


def rank_within(df: DataFrame, partition: Sequence[str], value: str, name: str = "rank",
                descending: bool = True) -> DataFrame:
    """``rank()`` of ``value`` within each partition (e.g. per date)."""
    o = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_last()
    return df.withColumn(name, F.rank().over(Window.partitionBy(*partition).orderBy(o)))


def rebased(df: DataFrame, series: Sequence[str], order: str, value: str,
            name: str = "rebased_index", base: float = 100.0) -> DataFrame:
    """``value / first value of the series * base``.

    The first value is a ``min_by`` aggregate per series (map-side combined)
    joined back, instead of an unbounded window that sorts a whole series.
    """
    firsts = df.groupBy(*series).agg(F.min_by(value, order).alias("__base"))
    return (null_safe_join(df, firsts, list(series))
            .withColumn(name, F.col(value) / F.nullif(F.col("__base"), F.lit(0)) * F.lit(base))
            .drop("__base"))
