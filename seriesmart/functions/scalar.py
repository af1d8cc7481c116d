"""Scalar helpers (F1, F7, F9, F13) with the reference's NULL behaviour."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_start(period) -> Column:
    """``'2024-03'`` -> 2024-03-01."""
    return F.to_date(F.concat(_c(period).cast("string"), F.lit("-01")))


def year_start(year) -> Column:
    """``'2024'`` -> 2024-01-01."""
    return F.to_date(F.concat(_c(year).cast("string"), F.lit("-01-01")))


def safe_div(num, den) -> Column:
    """``num / nullif(den, 0)``; ANSI division by zero would raise."""
    return _c(num) / F.nullif(_c(den), F.lit(0))


def pct_change(value, prev) -> Column:
    """``value / nullif(prev, 0) - 1``."""
    return safe_div(value, prev) - F.lit(1)


def degree_days(temp, base=18) -> Column:
    """``greatest(0, base - t)``, NULL when ``t`` is NULL (trap T1).

    Spark's ``greatest`` skips NULL arguments and would return 0.
    """
    t = _c(temp)
    return F.when(t.isNotNull(), F.greatest(F.lit(0), F.lit(base) - t))


def mean_of_two(a, b, digits: int = 2) -> Column:
    """``round((a + b) / 2, digits)``."""
    return F.round((_c(a) + _c(b)) / F.lit(2), digits)
