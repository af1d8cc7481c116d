"""Helpers shared by the operators: inputs, shared-folder tables, rolling hashes."""

from __future__ import annotations

import os
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

# Constants of the rolling hashes (any fixed odd multipliers would do).
_BYTE_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xD1B54A32D192ED03
_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)
_M64 = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str, group_rows: int | None = None) -> DataFrame:
    """Write a frame to the session's shared folder and read it back: cuts the
    lineage, and a lost executor costs a re-read instead of a recomputation.
    ``group_rows`` bounds the rows of a row group, which is what a reader holds at
    once when rows are large."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    options = {"parquet.block.row.count.limit": group_rows} if group_rows else {}
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, when the
    session was started without it on their path (an installed package comes first)."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH", ""), root]))


def pick(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Only the named input columns under the operator's own names, so that
    extra columns with clashing names cannot get in the way."""
    importable(df.sparkSession)
    return df.select(*[F.col(f"`{src}`").alias(dst) for dst, src in columns.items()])


def text_slices(column: pa.Array | pa.ChunkedArray):
    """(bytes buffer as uint8, int64 offsets) of an Arrow string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_binary())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offs


def slices(batch: pa.RecordBatch, rows: int = 256):
    """Smaller batches, so that what a Python worker holds does not depend on the batch size."""
    for i in range(0, batch.num_rows, rows):
        yield batch.slice(i, rows)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective avalanche mixing of 64-bit values (wrap-around arithmetic)."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_1
    x = (x ^ (x >> np.uint64(27))) * _MIX_2
    return x ^ (x >> np.uint64(31))


class Powers:
    """base**i and base**-i modulo 2**64 for i below a length that grows on demand."""

    def __init__(self, base: int):
        self.base, self.inv = base, pow(base, -1, 1 << 64)
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def upto(self, n: int):
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(self.base, k, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(self.inv, k, 1 << 64))])
        return self.up[:n], self.down[:n]


BYTE_POWERS, WORD_POWERS = Powers(_BYTE_BASE), Powers(_WORD_BASE)
BYTE_CODE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BYTE_BASE))


def prefix_hash(values: np.ndarray, powers: Powers) -> np.ndarray:
    """Prefix sums of value[i] * base**i, one longer than the input."""
    up, _ = powers.upto(len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:len(values)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray, powers: Powers) -> np.ndarray:
    """64-bit hash of value[start:end]; equal content gives equal hashes at any place."""
    _, down = powers.upto(len(prefix))
    return mix64((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_bounds(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (byte offsets) of the words ``[^\\x20\\x09-\\x0D]+``."""
    word = np.zeros(len(buf) + 2, np.int8)
    word[1:-1] = ~_SPACE[buf]
    step = np.diff(word)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hash(prefix_hash(BYTE_CODE[buf], BYTE_POWERS), starts, ends, BYTE_POWERS)


def window_hashes(words: np.ndarray, length: int, at: np.ndarray | None = None) -> np.ndarray:
    """Hash of ``length`` consecutive word hashes, at every start or at the given ones."""
    if at is None:
        at = np.arange(max(0, len(words) - length + 1))
    return span_hash(prefix_hash(words, WORD_POWERS), at, at + length, WORD_POWERS)
