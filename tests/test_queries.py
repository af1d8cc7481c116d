"""Every registered query against its DuckDB oracle on the smallest tables."""

import datetime as dt
import decimal
from collections import Counter

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from seriesmart.plans.registry import load_all

from .conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    missing = set(load_all()) - set(oracle_sql())
    assert not missing, f"queries without oracle SQL: {sorted(missing)}"


@pytest.mark.parametrize("name", sorted(load_all()))
def test_query_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF_SMALL)
    scols, srows = _rows(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(oracle_sql()[name])
    dcols, drows = _rows([d[0] for d in res.description], res.fetchall())
    assert scols == dcols
    assert sum(srows.values()) == sum(drows.values())
    assert srows == drows
    # The executed plan stays in the JVM: no Python evaluation, no Cartesian product.
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                 "CartesianProduct"):
        assert node not in plan, f"{name}: {node} in plan"


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["date_key", "market_date"]
