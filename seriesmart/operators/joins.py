"""Equi-joins in which NULL equals NULL, as in grouping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` with ``<=>`` (hashed like any equi-join); the left keys stay."""
    renamed = {k: f"__right_{k}" for k in keys}
    r = right.withColumnsRenamed(renamed)
    on = None
    for k, rk in renamed.items():
        c = F.col(k).eqNullSafe(F.col(rk))
        on = c if on is None else on & c
    return left.join(r, on, how).drop(*renamed.values())
