"""Reporting measures (B1-B7): star roll-up, shares, time intelligence, growth.

The reference names these only as dashboard measures; the definitions here are
ours. All are aggregates or joins on small, already aggregated frames:

* shares divide by a one-row total (global aggregate) or a per-parent total,
  joined back, instead of an unpartitioned window; shares of several parents
  take all totals from one grouping-sets aggregate;
* prior-period and long-horizon growth are equi-joins on a shifted period
  key, not ordered windows over a whole series.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import null_safe_join


def star_rollup(fact: DataFrame, dim: DataFrame, key: str, by: Sequence[str],
                measures: dict, broadcast_max_rows: int | None = None) -> DataFrame:
    """K6 + B5: fact joined to a dimension on ``key``, aggregated by ``by``.

    With ``broadcast_max_rows`` the dimension is counted (stopping early) and
    broadcast when it has at most that many rows, so the fact side is never
    shuffled for the join; beyond it, or without the argument, the planner
    and AQE choose the join from measured sizes.
    """
    from .sizing import checked_broadcast
    d = dim.select(key, *[c for c in by if c in dim.columns])
    if broadcast_max_rows is not None:
        d = checked_broadcast(d, broadcast_max_rows)
    return fact.join(d, key).groupBy(*by).agg(*[e.alias(n) for n, e in measures.items()])


def share_of_total(grouped: DataFrame, value: str, name: str = "share_of_total",
                   within: Sequence[str] = (), digits: int = 6, small: bool = False) -> DataFrame:
    """``value / sum(value)`` over all rows (``ALL``) or within ``within``
    (``ALLSELECTED``-style parent). The grand total is a scalar subquery (one
    global aggregate, no join); parent totals are an aggregate per parent
    joined back on the parent key. ``small`` frames (a report, bounded by its
    dimensions) take their totals from one window instead, so that what lies below
    them is computed once."""
    within = list(within)
    if small:
        out = grouped.withColumn("__tot", F.sum(value).over(Window.partitionBy(*within)))
    elif within:
        tot = grouped.groupBy(*within).agg(F.sum(value).alias("__tot"))
        out = null_safe_join(grouped, tot, within)
    else:
        out = grouped.withColumn("__tot", grouped.agg(F.sum(value)).scalar())
    return out.withColumn(name, F.round(F.col(value) / F.nullif(F.col("__tot"), F.lit(0)),
                                        digits)).drop("__tot")


def share_levels(df: DataFrame, by: Sequence[str], value: str, parents: Mapping[str, Sequence[str]],
                 selected: Column | None = None, digits: int = 6) -> DataFrame:
    """B6 on several levels: the ``value`` of each group of ``by`` and its share of
    every parent total, in one pass over ``df``.

    ``parents`` names each parent by a part of ``by`` (none: the grand total). With
    ``selected`` (the report's filter) the groups are those of the selected rows;
    ``share_<name>`` divides by the parent's total of all rows (``ALL``) and
    ``selected_<name>`` by that of the selected ones (``ALLSELECTED``).

    One grouping-sets aggregate gives the groups and all parent totals (an expand
    before the map-side combine, one shuffle); a group finds its parents' rows by
    windows over that small frame, whose partitions hold one parent's rows. NULL in
    a dimension is a value like any other: ``grouping_id`` tells it from a total.
    """
    by = list(by)
    total = F.sum(value)
    chosen = total if selected is None else F.sum(F.when(selected, F.col(value)))
    sets = [by, *[list(p) for p in parents.values() if set(p) != set(by)]]
    g = df.groupingSets(sets, *by).agg(F.grouping_id(*by).alias("__g"), chosen.alias(value), total.alias("__all"))
    # grouping_id has a bit for each column that a set leaves out, the first one's the highest.
    level = lambda p: sum(1 << (len(by) - 1 - i) for i, c in enumerate(by) if c not in p)
    names = {}
    for name, p in parents.items():
        # Rows of the parent's set and of the groups; other sets' rows must not share its partition.
        w = Window.partitionBy(*p, F.col("__g").isin(0, level(p)))
        of = lambda c, p=p, w=w: F.max(F.when(F.col("__g") == level(p), F.col(c))).over(w)
        total_of = of("__all") if set(p) != set(by) else F.col("__all")
        chosen_of = of(value) if set(p) != set(by) else F.col(value)
        names[f"share_{name}"] = F.round(F.col(value) / F.nullif(total_of, F.lit(0)), digits)
        if selected is not None:
            names[f"selected_{name}"] = F.round(F.col(value) / F.nullif(chosen_of, F.lit(0)), digits)
    out = g.select(*by, value, "__g", *[c.alias(n) for n, c in names.items()])
    return out.where((F.col("__g") == 0) & F.col(value).isNotNull()).drop("__g")


def year_to_date(df: DataFrame, year: str, period: str, value: str,
                 name: str = "ytd", series: Sequence[str] = ()) -> DataFrame:
    """Running sum within each year (a partition holds one year of
    periods, e.g. 12 months)."""
    w = (Window.partitionBy(*series, year).orderBy(period)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumn(name, F.sum(value).over(w))


def shifted(df: DataFrame, keys: Sequence[str], shift_col: str, shift: int, value: str,
            name: str) -> DataFrame:
    """The value of the period ``shift`` units earlier, by equi-join on
    ``shift_col + shift`` (e.g. year + 1 for prior year)."""
    prev = df.select(*keys, (F.col(shift_col) + F.lit(shift)).alias(shift_col),
                     F.col(value).alias(name))
    return df.join(prev, [*keys, shift_col], "left")
