"""Calendar builders.

A calendar has one row per day, so its size is bounded by the date range, not
by the data volume: 100 years are 36,525 rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .keys import date_key

# Fixed values that must equal the reference's: weekend days by short name.
WEEKEND_DAYS = ("Sat", "Sun")


def _d(x) -> Column:
    if isinstance(x, Column):
        return x.cast("date")
    return F.lit(str(x)).cast("date")


def date_spine(spark: SparkSession, start, end_exclusive, name: str = "date_day") -> DataFrame:
    """One row per day in ``[start, end_exclusive)``.

    ``start`` / ``end_exclusive`` are dates, ISO strings or 1-row column
    expressions; an empty range gives no rows.
    """
    s, e = _d(start), _d(end_exclusive)
    seq = F.when(e > s, F.sequence(s, F.date_sub(e, 1), F.expr("interval 1 day")))
    return spark.range(1).select(F.explode(seq).alias(name))


def spine_between(bounds: DataFrame, start_col: str, end_col: str,
                  name: str = "date_day") -> DataFrame:
    """Spine over ``[start, end]`` (inclusive) of a one-row bounds frame."""
    seq = F.when(F.col(end_col) >= F.col(start_col),
                 F.sequence(F.col(start_col).cast("date"), F.col(end_col).cast("date"),
                            F.expr("interval 1 day")))
    return bounds.select(F.explode(seq).alias(name))


def dim_date(spine: DataFrame, day: str = "date_day") -> DataFrame:
    """Calendar attributes, names in three letters (trap T7)."""
    d = F.col(day)
    return spine.select(
        date_key(d).alias("date_key"),
        d.cast("date").alias("full_date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMM").alias("month_name"),
        F.dayofmonth(d).alias("day_of_month"),
        F.date_format(d, "EEE").alias("day_name"),
        (~F.date_format(d, "EEE").isin(*WEEKEND_DAYS)).alias("is_weekday"),
    )


def date_bounds(fact: DataFrame, date_col: str) -> DataFrame:
    """A2: one-row ``(start_date, end_date)``; partial + final aggregate."""
    return fact.agg(F.min(F.col(date_col).cast("date")).alias("start_date"),
                    F.max(F.col(date_col).cast("date")).alias("end_date"))


def bounded_spine(calendar: DataFrame, fact: DataFrame, fact_date: str,
                  cal_date: str = "full_date") -> DataFrame:
    """D3 / K2: calendar rows inside the fact's ``[min, max]`` date range.

    The bounds are one global aggregate (partial + final) used as a scalar
    subquery: computed once, no join with the calendar at all.
    """
    d = F.col(fact_date).cast("date")
    b = fact.agg(F.struct(F.min(d).alias("lo"), F.max(d).alias("hi"))).scalar()
    return calendar.filter(F.col(cal_date).between(b["lo"], b["hi"]))
