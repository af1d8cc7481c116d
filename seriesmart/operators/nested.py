"""Nested documents (J1-J9): typed paths, flattens, parallel arrays, JSON-stat.

Documents are ``VARIANT`` values (``parse_json`` of landed text). All decoding
is built-in expressions inside whole-stage codegen; there is no Python.

* Typed extraction uses ``try_variant_get`` by default: an unparsable value
  becomes NULL (``strict=True`` raises instead, like a plain cast).
* JSON ``null`` inside a document is not SQL NULL (trap T2): filter *after*
  the typed cast, as :func:`drop_null_observations` does.
* Out-of-range positions use ``get`` (NULL), never ``arr[i]`` (trap T10).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_documents(df: DataFrame, text_col: str = "value", out: str = "raw",
                    strict: bool = True) -> DataFrame:
    """Text -> VARIANT. ``strict`` raises on broken JSON; else NULL."""
    f = F.parse_json if strict else F.try_parse_json
    return df.withColumn(out, f(F.col(text_col)))


def path(v, p: str, type_: str = "variant", strict: bool = False) -> Column:
    """``v:path::type``. Quoted keys use ``$["product-name"]``."""
    f = F.variant_get if strict else F.try_variant_get
    return f(_c(v), p, type_)


def fields(types: Mapping[str, str]) -> str:
    """The type of an object of which these keys are read (quoted keys need no
    escape). A key that is missing or does not parse is NULL, as with :func:`path`."""
    quoted = (f"`{k.replace('`', '``')}`: {t}" for k, t in types.items())
    return f"struct<{', '.join(quoted)}>"


def flatten(df: DataFrame, v, p: str | None = "$", as_: str = "value",
            keep: Sequence[str] | None = None, outer: bool = False,
            with_pos: bool = False, type_: str = "variant") -> DataFrame:
    """One row per element of the array at ``p`` (``LATERAL FLATTEN``).

    Inner by default: a missing or empty array drops the row; ``outer=True``
    keeps it with a NULL element. ``with_pos`` adds the element index
    ``<as_>_pos``. ``keep`` lists the columns carried along (default all).

    A VARIANT element is a document of its own, built anew with its own key
    dictionary. ``type_`` (see :func:`fields`) reads the typed paths of all
    elements in one go instead, with the results of :func:`path`; shredded
    documents are then read by these fields alone. ``p=None`` flattens a
    column that is such a typed array already.
    """
    arr = _c(v) if p is None else path(v, p, f"array<{type_}>")
    keep = [c for c in (df.columns if keep is None else keep)]
    # The array is a column of its own, which a scan of shredded documents can take over.
    # Exploded by position: a filter on its size would run its path a second time.
    pos = f"{as_}_pos"
    rows = df.select(*keep, arr.alias("__array")).select(*keep, F.posexplode_outer("__array").alias(pos, as_))
    if not outer:
        rows = rows.filter(F.col(pos).isNotNull())
    return rows if with_pos else rows.select(*keep, as_)


def flatten_object(df: DataFrame, v, p: str, value_type: str = "variant",
                   keep: Sequence[str] | None = None, key: str = "key",
                   value: str = "value") -> DataFrame:
    """One row per key of the object at ``p`` (``pos``-free key/value)."""
    m = F.try_variant_get(_c(v), p, f"map<string,{value_type}>")
    keep = list(df.columns if keep is None else keep)
    return df.select(*keep, F.explode(m).alias(key, value))


def zip_arrays(df: DataFrame, v, base: str, index: str = "time",
               arrays: Mapping[str, tuple[str, str]] | None = None,
               index_type: str = "string", keep: Sequence[str] | None = None,
               index_name: str | None = None, strict: bool = False) -> DataFrame:
    """Positional zip of parallel arrays ``base.index[i]``, ``base.x[i]``.
    ``strict`` raises on a value that is present but does not parse.

    ``arrays`` maps an output column to ``(json key under base, type)``. An
    array shorter than the index array yields NULL at missing positions.
    """
    keep = list(df.columns if keep is None else keep)
    idx = F.try_variant_get(_c(v), f"{base}.{index}", f"array<{index_type}>")
    cols = {}
    for out, (k, t) in (arrays or {}).items():
        cols[out] = path(v, f"{base}.{k}", f"array<{t}>", strict)
    exploded = df.select(*keep, *[c.alias(f"__arr_{o}") for o, c in cols.items()],
                         F.posexplode(idx).alias("__pos", index_name or index))
    return exploded.select(*keep, index_name or index,
                           *[F.get(F.col(f"__arr_{o}"), F.col("__pos")).alias(o) for o in cols])


def decode_jsonstat(df: DataFrame, v, value_type: str = "decimal(18,4)",
                    time_dim: str = "time", keep: Sequence[str] | None = None,
                    period: str = "period", value: str = "value", strict: bool = False) -> DataFrame:
    """J6 + J7: JSON-stat ``dimension.<time>.category.index`` x ``value`` map.

    Flattens the period -> position object and looks each position up in the
    sparse ``value`` object (absent position -> NULL). The flat position
    equals the time position only while every other dimension has size 1
    (trap T20); documents with a ``size`` array violating that raise.
    """
    keep = list(df.columns if keep is None else keep)
    vv = _c(v)
    sizes = F.try_variant_get(vv, "$.size", "array<int>")
    n_time = F.size(F.try_variant_get(vv, f"$.dimension.{time_dim}.category.index",
                                      "map<string,int>"))
    prod = F.aggregate(F.coalesce(sizes, F.array(n_time)), F.lit(1), lambda a, x: a * x)
    checked = F.when(prod == n_time, vv).otherwise(
        F.raise_error(F.lit("JSON-stat: only the time dimension may have size > 1")))
    idx = F.try_variant_get(checked, f"$.dimension.{time_dim}.category.index", "map<string,int>")
    vals = path(vv, "$.value", f"map<string,{value_type}>", strict)
    ex = df.select(*keep, vals.alias("__vals"), F.explode(idx).alias(period, "__pos"))
    return ex.select(*keep, period,
                     F.try_element_at(F.col("__vals"), F.col("__pos").cast("string")).alias(value))


def drop_null_observations(df: DataFrame, *cols: str) -> DataFrame:
    """Drop rows whose typed observation is NULL (after the cast, T2)."""
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return df.filter(cond)


def content_hash(*cols) -> Column:
    """A 64-bit hash of the JSON text of variant / struct columns.

    ``VARIANT`` cannot be grouped or compared, so documents are identified by
    the hash of their JSON form: a deterministic last tie-break for
    latest-wins (trap T5) and the key of document-level dedup.
    """
    return F.xxhash64(*[F.to_json(_c(c)) for c in cols])


def distinct_documents(bronze: DataFrame, raw: str = "raw",
                       order_by: Sequence[str] = ("_loaded_at", "_src_file")) -> DataFrame:
    """One row per distinct document content (the latest load of it)."""
    from .dedupe import latest_wins
    d = bronze.withColumn("__doc", content_hash(raw))
    return latest_wins(d, ["__doc"], list(order_by)).drop("__doc")
