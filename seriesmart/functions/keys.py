"""Key expressions.

Two different hashes share the column name ``*_key`` in the marts (trap T8):
staging joins the natural key with ``|`` (NULL-propagating), the marts use the
surrogate-key macro form (NULL-safe, ``-`` separated). Both are kept.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for identical keys:
# the separator and NULL token of the surrogate-key macro [public doc].
SURROGATE_SEPARATOR = "-"
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(d) -> Column:
    """integer ``YYYYMMDD`` key of a date or timestamp."""
    return F.date_format(_c(d), "yyyyMMdd").cast("int")


def pipe_key(*cols) -> Column:
    """``md5(c1 || '|' || c2 ...)``; NULL if any part is NULL."""
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit("|"))
        parts.append(_c(c).cast("string"))
    return F.md5(F.concat(*parts))


def surrogate_key(*cols) -> Column:
    """md5 over the '-'-joined string forms, NULLs replaced by a token."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit(SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws(SURROGATE_SEPARATOR, *parts))
