"""A1 pivot by conditional aggregate, and M11 cross rates (K1 + F7 + F8)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_AGG = {"max": F.max, "min": F.min, "sum": F.sum, "first": F.first}


def pivot_series(df: DataFrame, index: Sequence[str] | str, series: str, value: str,
                 names: Mapping[str, str], agg: str = "max") -> DataFrame:
    """One column per listed series code: ``agg(case when s = code then v end)``.

    The codes are given, so no extra job scans for distinct values, and the
    aggregate is partial + final (map-side combine). Codes not listed are
    ignored; a missing code on an index value gives NULL (trap T4).
    """
    index = [index] if isinstance(index, str) else list(index)
    f = _AGG[agg]
    return df.groupBy(*index).agg(
        *[f(F.when(F.col(series) == F.lit(code), F.col(value))).alias(col)
          for code, col in names.items()])


def cross_rates(rates: DataFrame, date: str, code: str, rate: str,
                anchors: Mapping[str, str], digits: int = 6,
                out_type: str = "decimal(18,6)") -> DataFrame:
    """Every rate divided by each anchor rate of the same date.

    ``anchors`` maps an anchor code to an output prefix: ``{"USD": "usd"}``
    yields ``usd_per_unit = round(rate / nullif(usd_anchor, 0), digits)``.
    The anchors are pre-aggregated per date (pivot) before the inner join.
    """
    piv = pivot_series(rates, date, code, rate, {c: f"__a_{p}" for c, p in anchors.items()})
    out = rates.join(piv, date)
    for c, p in anchors.items():
        out = out.withColumn(
            f"{p}_per_unit",
            F.round(F.col(rate) / F.nullif(F.col(f"__a_{p}"), F.lit(0)), digits).cast(out_type))
    return out.drop(*[f"__a_{p}" for p in anchors.values()])
