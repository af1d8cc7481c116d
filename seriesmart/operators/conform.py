"""P2 + U1: conform heterogeneous feeds into one tall shape.

Each feed is tagged with literal columns (source, indicator, frequency,
unit, ...) and the feeds are unioned by name: a narrow plan, no shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def conform_tall(feeds: Sequence[tuple[DataFrame, Mapping[str, str]]]) -> DataFrame:
    """``(df, tags)`` pairs -> one frame ``(period_date, <tags>..., value)``.

    Each df has ``period_date`` and ``value``; ``tags`` maps column -> literal.
    Values of different decimal scales widen to a common type.
    """
    out = None
    for df, tags in feeds:
        t = df.select("period_date", *[F.lit(v).alias(k) for k, v in tags.items()], "value")
        out = t if out is None else out.unionByName(t)
    return out
