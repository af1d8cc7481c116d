"""A membership filter of bounded size, built by the cluster and broadcast.

It takes 16 bits for each value up to ``MAX_BITS``; when the data outgrow that, it
only lets more through. Users must be right for any false positives."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_BITS, MAX_BITS = 16, 28  # at most 2**28 bits: 32 MB


def build(df: DataFrame, column: str, values: int) -> np.ndarray:
    """The filter of a column of well-mixed 64-bit values, about ``values`` of them."""
    bits = min(MAX_BITS, max(MIN_BITS, (16 * values).bit_length()))
    slot = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    words = (df.select(slot.alias("s")).select(F.shiftright("s", 6).alias("w"),
                                               F.expr("shiftleft(1L, cast(s & 63 as int))").alias("b"))
             .groupBy("w").agg(F.bit_or("b").alias("b")).toArrow())  # at most 2**bits / 64 rows
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[words.column("w").to_numpy()] = words.column("b").to_numpy().view(np.uint64)
    return out


def contains(words: np.ndarray, values: np.ndarray) -> np.ndarray:
    slot = values.view(np.uint64) & np.uint64((len(words) << 6) - 1)
    return (words[slot >> np.uint64(6)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)
