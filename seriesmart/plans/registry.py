"""Registry of the queries exposed to the driver: name -> (Spark fn, oracle SQL).

A query function takes ``(spark, sf_dir)`` and returns a DataFrame over the
whole driver tables. ``sql`` is the DuckDB text over the same tables with the
same column names, or ``None`` when the operator is not SQL-expressible.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    fn: QueryFn
    sql: str | None
    ops: str  # SURVEY operator ids covered


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None, ops: str):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = Query(name, fn, sql, ops)
        return fn
    return deco


def load_all() -> dict[str, Query]:
    # Importing the modules registers their queries.
    from . import (daily_marts, documents, history, landing, marts,  # noqa: F401
                   measures, models, nulls, quality, reconcile, timeseries)
    return QUERIES
