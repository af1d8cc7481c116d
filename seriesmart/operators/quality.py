"""Data-quality operators (Q1-Q9) and table reconciliation.

``run_checks`` evaluates every row-level check of one table (not_null,
accepted_range, accepted_values, expression) in **one** aggregate pass:
one conditional count per check, partial + final aggregation, a single
one-row result unpivoted into the report. ``unique`` counts suspects only
(:func:`repeated_rows`); ``relationships`` is an anti join per parent.
``observe_checks`` counts the row-level ones while a table is written, at no
pass at all (an ``Observation`` on the write).

The report is ``DF[check_name, kind, column_name, severity, failures]`` with
``failures`` = failing rows (for ``unique``: rows whose value occurs more
than once, NULLs excluded). :func:`gate` raises before publication when an
``error`` check fails (Q9).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROW_KINDS = ("not_null", "accepted_range", "accepted_values", "expression")


@dataclass(frozen=True)
class Check:
    kind: str
    column: str
    args: dict = field(default_factory=dict)
    severity: str = "error"
    name: str | None = None

    @property
    def check_name(self) -> str:
        return self.name or f"{self.kind}_{self.column}"


def not_null(c, **kw):
    return Check("not_null", c, **kw)


def unique(c, **kw):
    return Check("unique", c, **kw)


def accepted_range(c, min_value=None, max_value=None, inclusive=True, **kw):
    return Check("accepted_range", c, {"min": min_value, "max": max_value,
                                       "inclusive": inclusive}, **kw)


def accepted_values(c, values: Sequence, **kw):
    return Check("accepted_values", c, {"values": list(values)}, **kw)


def relationships(c, to: DataFrame, field_: str, **kw):
    return Check("relationships", c, {"to": to, "field": field_}, **kw)


def expression(name: str, fail_when: Column, **kw):
    return Check("expression", name, {"fail": fail_when}, name=name, **kw)


def _fail_condition(ch: Check) -> Column:
    c = F.col(ch.column) if ch.kind != "expression" else None
    if ch.kind == "not_null":
        return c.isNull()
    if ch.kind == "accepted_range":
        lo, hi, inc = ch.args["min"], ch.args["max"], ch.args["inclusive"]
        ok = F.lit(True)
        if lo is not None:
            ok = ok & ((c >= F.lit(lo)) if inc else (c > F.lit(lo)))
        if hi is not None:
            ok = ok & ((c <= F.lit(hi)) if inc else (c < F.lit(hi)))
        return c.isNotNull() & ~ok  # NULL passes
    if ch.kind == "accepted_values":
        return c.isNotNull() & ~c.isin(*ch.args["values"])
    if ch.kind == "expression":
        return F.coalesce(ch.args["fail"], F.lit(False))
    raise ValueError(ch.kind)


def _row(ch: Check, failures: Column) -> Column:
    return F.struct(F.lit(ch.check_name).alias("check_name"), F.lit(ch.kind).alias("kind"),
                    F.lit(ch.column).alias("column_name"), F.lit(ch.severity).alias("severity"),
                    failures.cast("long").alias("failures"))


def repeated_rows(df: DataFrame, column: str) -> DataFrame:
    """Q2/Q7: ``DF[column, n]``, the values that occur more than once (NULL aside).

    Membership first. Whole numbers and dates set bits in words of 64 neighbouring
    values: a word whose rows outnumber its bits holds a repeated value, for sure,
    and a task whose values lie close together (keys mostly come in order) ships one
    row for 64 of them. Other types are met by their 64-bit hash. Only rows of
    suspect words or hashes are counted by value; without any, the table is not read
    again (adaptive execution drops the join)."""
    rows = df.select(F.col(column)).where(F.col(column).isNotNull())
    kind = df.schema[column].dataType
    if isinstance(kind, (T.IntegralType, T.DateType)):
        number = (F.datediff(F.col(column), F.lit("1970-01-01").cast("date")) if isinstance(kind, T.DateType)
                  else F.col(column)).cast("long")
        rows = rows.withColumn("__w", F.shiftright(number, 6))
        bit = F.expr("shiftleft(1L, cast(__v & 63 as int))")
        met = rows.withColumn("__v", number).groupBy("__w").agg(
            F.bit_count(F.bit_or(bit)).alias("__bits"), F.count(F.lit(1)).alias("__n"))
        suspects = met.where("__n > __bits").select("__w")
    else:
        rows = rows.withColumn("__w", F.xxhash64(column))
        suspects = rows.groupBy("__w").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select("__w")
    return (rows.join(suspects, "__w", "left_semi").groupBy(column).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


class ObservedChecks:
    """Row-level checks counted while ``df`` is written (or otherwise run through once).

    ``df`` is the frame to write; :meth:`report` gives the failing rows of each
    check after the write, as the rows of :func:`run_checks`' report."""

    def __init__(self, df: DataFrame, checks: Sequence[Check]):
        self.checks = [c for c in checks if c.kind in ROW_KINDS]
        self.rest = [c for c in checks if c.kind not in ROW_KINDS]
        self.df, self._counts = df, None
        if self.checks:
            # A name of its own: several tables are written at once.
            self._counts = Observation(f"checks-{uuid.uuid4().hex}")
            self.df = df.observe(self._counts, F.count(F.lit(1)).alias("rows"),
                                 *[F.count_if(_fail_condition(c)).alias(f"f{i}") for i, c in enumerate(self.checks)])

    def report(self) -> list[dict]:
        if self._counts is None:
            return []
        got = self._counts.get  # of the action that has run
        return [{"check_name": c.check_name, "kind": c.kind, "column_name": c.column, "severity": c.severity,
                 "failures": int(got[f"f{i}"])} for i, c in enumerate(self.checks)]


def observe_checks(df: DataFrame, checks: Sequence[Check]) -> ObservedChecks:
    """Q1-Q5, Q9: the row-level checks of a table, to be counted by its write; ``rest``
    holds the checks that need the written table."""
    return ObservedChecks(df, checks)


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """The quality report of one table; single pass for the row-level checks."""
    parts = []
    row_checks = [c for c in checks if c.kind in ROW_KINDS]
    if row_checks:
        agg = df.agg(*[F.count_if(_fail_condition(c)).alias(f"f{i}")
                       for i, c in enumerate(row_checks)])
        parts.append(agg.select(F.explode(F.array(
            *[_row(c, F.col(f"f{i}")) for i, c in enumerate(row_checks)])).alias("r"))
            .select("r.*"))
    for c in checks:
        if c.kind == "unique":
            parts.append(repeated_rows(df, c.column).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("x"))
                         .select(_row(c, F.col("x")).alias("r")).select("r.*"))
        elif c.kind == "relationships":
            parent = c.args["to"].select(F.col(c.args["field"]).alias("__pk"))
            orphans = (df.filter(F.col(c.column).isNotNull())
                       .join(parent, F.col(c.column) == F.col("__pk"), "left_anti"))
            parts.append(orphans.agg(F.count(F.lit(1)).alias("x"))
                         .select(_row(c, F.col("x")).alias("r")).select("r.*"))
        elif c.kind not in ROW_KINDS:
            raise ValueError(f"unknown check kind {c.kind!r}")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


class QualityGateError(RuntimeError):
    pass


def gate(report: DataFrame, fail_on: str = "error") -> list:
    """Q9: raise when a check of severity ``fail_on`` has failures; returns the
    failing checks (the report is one row per check, so collecting it is
    metadata-sized)."""
    return gate_rows([r.asDict() for r in report.filter(F.col("failures") > 0).collect()], fail_on)


def gate_rows(rows: Sequence[dict], fail_on: str = "error") -> list:
    """:func:`gate` on the rows of a report."""
    bad = [r for r in rows if r["failures"]]
    blocking = [r for r in bad if r["severity"] == fail_on]
    if blocking:
        names = ", ".join(f"{r['check_name']}={r['failures']}" for r in blocking)
        raise QualityGateError(f"quality gate failed: {names}")
    return bad


def freshness(df: DataFrame, loaded_at: str, run_ts, warn_after_hours: int = 26,
              error_after_hours: int = 50, by: Sequence[str] = ()) -> DataFrame:
    """Q6: ``max(loaded_at)`` per group against ``run_ts``: pass / warn / error.
    A group (or table) that was never loaded has no maximum and is an error."""
    from ..sources.landing import run_stamp
    ts = run_stamp(run_ts)
    g = df.groupBy(*by).agg(F.max(loaded_at).alias("max_loaded_at"))
    status = (F.when(F.col("max_loaded_at").isNull(), F.lit("error"))
              .when(F.col("max_loaded_at") < ts - F.expr(f"interval {error_after_hours} hours"),
                     F.lit("error"))
              .when(F.col("max_loaded_at") < ts - F.expr(f"interval {warn_after_hours} hours"),
                    F.lit("warn"))
              .otherwise(F.lit("pass")))
    return g.select(*by, "max_loaded_at",
                    F.expr("timestampdiff(SECOND, max_loaded_at, {})".format(
                        f"timestamp_ntz'{run_ts}'")).alias("age_seconds"),
                    status.alias("status"))


RECONCILE_BUCKETS = 4096  # key buckets whose digests are compared


def _digests(df: DataFrame, keys: list[str], vals: list[str], buckets: int) -> DataFrame:
    """Rows of a table with their key bucket and a 64-bit hash of the row."""
    # A hash passes over NULLs, so each column says first whether it is one.
    whole = [x for c in [*keys, *vals] for x in (F.col(c).isNull(), F.col(c))]
    return df.select(*keys, *vals, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("__b"),
                     F.xxhash64(*whole).alias("__h"))


def reconcile(a: DataFrame, b: DataFrame, keys: Sequence[str], buckets: int = RECONCILE_BUCKETS) -> DataFrame:
    """Compare two versions of a table, by digests first.

    Returns ``DF[metric, value]``: rows_a, rows_b, only_in_a, only_in_b,
    changed (same key, any other column different, NULL-safe), matched.
    ``keys`` identify a row; a NULL in a key equals a NULL.

    Each side is reduced to one digest per bucket of keys (count, xor and sum of
    row hashes: a map-side combined aggregate, so no row is moved). Rows are joined
    only in buckets whose digests differ; equal tables are never joined row by row.
    Digests are 64-bit hashes taken twice over: equal ones for different rows are
    not expected to occur.
    """
    keys = list(keys)
    vals = [c for c in a.columns if c not in keys]
    ra, rb = (_digests(d.select(*a.columns), keys, vals, buckets) for d in (a, b))
    digest = lambda r, n: r.groupBy("__b").agg(
        F.count(F.lit(1)).alias(f"n{n}"), F.bit_xor("__h").alias(f"x{n}"),
        F.sum(F.xxhash64("__h").cast("decimal(20,0)")).alias(f"s{n}"))
    both = digest(ra, "a").join(digest(rb, "b"), "__b", "full_outer")  # at most `buckets` rows
    same = (F.col("na").eqNullSafe(F.col("nb")) & F.col("xa").eqNullSafe(F.col("xb")) & F.col("sa").eqNullSafe(F.col("sb")))
    both = both.select("__b", "na", "nb", same.alias("same"))
    zero = F.lit(0).cast("long")
    equal = both.where("same").agg(F.coalesce(F.sum("na"), zero).alias("n")).select(
        F.col("n").alias("rows_a"), F.col("n").alias("rows_b"), zero.alias("only_in_a"), zero.alias("only_in_b"),
        zero.alias("changed"), F.col("n").alias("matched"))
    differing = F.broadcast(both.where("not same").select("__b"))
    sa = ra.join(differing, "__b", "left_semi").select(*keys, F.struct(*vals).alias("__va"), F.lit(True).alias("__a"))
    sb = rb.join(differing, "__b", "left_semi").select(
        *[F.col(k).alias(f"__k_{k}") for k in keys], F.struct(*vals).alias("__vb"), F.lit(True).alias("__b_in"))
    on = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"__k_{k}"))
        on = c if on is None else on & c
    j = sa.join(sb, on, "full_outer")
    ina, inb = F.col("__a").isNotNull(), F.col("__b_in").isNotNull()
    alike = F.col("__va").eqNullSafe(F.col("__vb"))
    agg = j.agg(F.count_if(ina).alias("rows_a"), F.count_if(inb).alias("rows_b"),
                F.count_if(ina & ~inb).alias("only_in_a"), F.count_if(inb & ~ina).alias("only_in_b"),
                F.count_if(ina & inb & ~alike).alias("changed"),
                F.count_if(ina & inb & alike).alias("matched"))
    metrics = ["rows_a", "rows_b", "only_in_a", "only_in_b", "changed", "matched"]
    # One row each: the joined buckets and the equal ones.
    total = agg.unionByName(equal).agg(*[F.sum(m).alias(m) for m in metrics])
    return total.unpivot([], metrics, "metric", "value")
