"""K1 / K6: facts and dimensions published bucketed and sorted by their join key.

Tables written with the same keys and the same number of buckets are joined,
and grouped by these keys, bucket by bucket: the shuffle is paid once by the
publication instead of by every query. The table is plain Parquet at its path; the
bucketing is part of its definition, which a session states when it reads the
table (nothing is kept in a catalog between sessions).

A bucket holds all rows of its keys, so a key that holds a great share of the rows
should stay unbucketed and be left to adaptive execution, which splits such keys.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _name(path: str, keys: Sequence[str], buckets: int) -> str:
    return "bucketed_" + hashlib.sha256("|".join([path, *keys, str(buckets)]).encode()).hexdigest()[:24]


def _quoted(names: Sequence[str]) -> str:
    return ", ".join(f"`{n}`" for n in names)


def read_bucketed(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], buckets: int) -> DataFrame:
    """A table written by :func:`write_bucketed`, with the same keys and number of buckets."""
    name = _name(path, keys, buckets)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"create table if not exists {name} ({columns}) using parquet clustered by ({_quoted(keys)}) "
              f"sorted by ({_quoted(keys)}) into {int(buckets)} buckets location '{path}'")
    return spark.table(name)


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Write ``df`` to ``path`` as ``buckets`` files, each sorted by ``keys``; returns the
    table. One shuffle by the keys, which deals rows as the buckets do."""
    keys = list(keys)
    empty = read_bucketed(df.sparkSession, path, df.schema, keys, buckets)
    (df.select(*[df[c].cast(t) for c, t in empty.dtypes]).repartition(buckets, *keys)
     .write.insertInto(_name(path, keys, buckets), overwrite=True))
    return read_bucketed(df.sparkSession, path, df.schema, keys, buckets)
