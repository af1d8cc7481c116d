"""Broadcast behind a measured size check, with a shuffle join beyond it.

``checked_broadcast`` counts at most ``max_rows + 1`` rows of the small side
(``limit`` stops early on a large frame), broadcasts it when it fits, and
otherwise returns it unchanged so the planner uses a shuffle join (with AQE
skew handling). The count is one small job on the small side only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fits(df: DataFrame, max_rows: int) -> bool:
    return df.limit(max_rows + 1).count() <= max_rows


def checked_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    return F.broadcast(df) if fits(df, max_rows) else df
