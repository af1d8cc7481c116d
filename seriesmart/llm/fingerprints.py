"""Operator 13: threshold-scaled document fingerprints.

A fingerprint keeps every shingle hash below a fixed fraction of the hash range
(``1 / SCALE``), so its size follows the text's and the part that two texts share
is sampled alike in both, however unequal they are. Texts too short for the
fraction keep their ``LEAST`` smallest hashes (all, if they have fewer).

* Mergeable: the fingerprint of several texts together follows from theirs alone.
* Containment: two fingerprints are compared below the smaller of their limits,
  where both are complete. ``containment`` is the share of a text's shingles that
  the other one has as well.

The edited texts need every document's successor in descending id order. Ids are
cut into ranges; a task sorts one range, and each range gets a copy of the row
that precedes its first one, so no task needs another's rows.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, mix64, pick, slices, window_hashes, word_bounds, word_hashes

WORDS = 5      # words of a shingle; a text of fewer words is one shingle
SCALE = 16     # a hash is kept when it is below 2**64 / SCALE
LEAST = 64     # hashes that a text keeps in any case, if it has them
RANGE_ROWS = 10_000  # documents of a range, about


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """Distinct 64-bit hashes, ascending, of the word shingles ``[^\\x20\\x09-\\x0D]+``.
    A text without words has the hash of its bytes, an empty one none."""
    buf = np.frombuffer(text, np.uint8)
    if not len(buf):
        return np.zeros(0, np.uint64)
    starts, ends = word_bounds(buf)
    if not len(starts):
        starts, ends = np.array([0]), np.array([len(buf)])
    # Mixed once more: a kept hash says nothing about the fraction by itself.
    return np.unique(mix64(window_hashes(word_hashes(buf, starts, ends), min(words, len(starts)))))


class Sketch:
    """The kept hashes of a text, ascending, and whether these are all that it has."""

    def __init__(self, hashes: np.ndarray, whole: bool, scale: int = SCALE, least: int = LEAST):
        self.hashes, self.whole, self.scale, self.least = hashes, whole, scale, least

    @classmethod
    def of(cls, text: bytes, words: int = WORDS, scale: int = SCALE, least: int = LEAST) -> Sketch:
        h = shingles(text, words)
        n = max(int(np.searchsorted(h, np.uint64((1 << 64) // scale))), min(least, len(h)))
        return cls(h[:n], n == len(h), scale, least)

    def limit(self) -> int:
        """Every shingle hash of the text up to this value is kept."""
        if self.whole:
            return (1 << 64) - 1
        return max((1 << 64) // self.scale - 1, int(self.hashes[-1]))

    def merge(self, other: Sketch) -> Sketch:
        """The sketch of both texts' shingles."""
        known = min(self.limit(), other.limit())
        h = np.union1d(self.hashes, other.hashes)
        h = h[:np.searchsorted(h, np.uint64(known), "right")]
        n = max(int(np.searchsorted(h, np.uint64((1 << 64) // self.scale))), min(self.least, len(h)))
        return Sketch(h[:n], self.whole and other.whole and n == len(h), self.scale, self.least)

    def shared(self, other: Sketch) -> tuple[int, int, int]:
        """(own hashes, the other's, common ones) below the smaller limit."""
        upto = np.uint64(min(self.limit(), other.limit()))
        a = self.hashes[:np.searchsorted(self.hashes, upto, "right")]
        b = other.hashes[:np.searchsorted(other.hashes, upto, "right")]
        return len(a), len(b), len(np.intersect1d(a, b, assume_unique=True))

    def containment(self, other: Sketch) -> float:
        """Estimated share of the own shingles that the other text has; 1 for a text
        without any against another such text, else 0."""
        a, b, both = self.shared(other)
        return both / a if a else float(not len(self.hashes) and not len(other.hashes))

    def jaccard(self, other: Sketch) -> float:
        """Estimated Jaccard similarity of the two sets of shingles."""
        a, b, both = self.shared(other)
        return both / (a + b - both) if a + b else float(not len(self.hashes) and not len(other.hashes))

    def likeness(self, other: Sketch, equal: bool) -> tuple[float, float]:
        """Containment and Jaccard similarity; 1 for equal texts."""
        return (1.0, 1.0) if equal else (self.containment(other), self.jaccard(other))

    def hex(self) -> str:
        """``a`` (all) or ``p`` (part), then the kept hashes as 16 hexadecimal digits each."""
        return ("a" if self.whole else "p") + self.hashes.astype(">u8").tobytes().hex()

    @classmethod
    def from_hex(cls, s: str, scale: int = SCALE, least: int = LEAST) -> Sketch:
        return cls(np.frombuffer(bytes.fromhex(s[1:]), ">u8").astype(np.uint64), s[0] == "a", scale, least)


def edited(text: str, following: str) -> str:
    """The last third of a text replaced by as many characters of the following one (or all)."""
    n = len(text) // 3
    return text[:len(text) - n] + following[:n]


class Ranges:
    """Ranges of ids, each of about the same number of rows, and the id before each.

    Ranges 0, 1, .. hold ascending ids. An id of more than ``rows`` rows, and the
    null ids, are dealt over ranges of their own, by the row's number."""

    def __init__(self, ids: DataFrame, rows: int):
        counts = ids.groupBy("id").agg(F.count("*").alias("n"))
        n = max(1, -(-ids.count() // rows))
        # Written once: the ranges are those of one run.
        counts = materialize(counts.repartitionByRange(n, "id").withColumn("range", F.spark_partition_id()), "id-ranges")
        # At most a row for each range, and one for each id of more rows than a range.
        ends = counts.where("id is not null").groupBy("range").agg(
            F.min("id").alias("low"), F.max("id").alias("high")).orderBy("low").collect()
        before = F.lag("id").over(Window.partitionBy("range").orderBy("id"))
        hot = counts.withColumn("before", before).where((F.col("n") > rows) | F.col("id").isNull()).collect()
        self.highs = [r.high for r in ends]
        self.split: dict = {}        # id: its first range and their number
        self.heads: list[tuple] = []  # (range, id whose row precedes the range's first)
        self.inside: list[tuple] = []  # (range, id whose row is needed among the range's)
        null = any(r.id is None for r in hot)
        # Below the smallest id come the nulls, then the largest id again.
        lowest = None if null else self.highs[-1] if ends else None
        first = {r.low: lowest if i == 0 else self.highs[i - 1] for i, r in enumerate(ends)}
        self.heads += [(i, first[r.low]) for i, r in enumerate(ends)]
        self.count = len(ends)
        for r in hot:
            parts = -(-r.n // rows)
            if r.id is None:
                head = self.highs[-1] if ends else None
            else:
                head = first[r.id] if r.id in first else r.before
                self.inside.append((bisect_left(self.highs, r.id), r.id))
            self.split[r.id] = self.count, parts
            self.heads += [(self.count + i, head) for i in range(parts)]
            self.count += parts

    def of(self, spark: SparkSession) -> Column:
        """The range of a row's id."""
        plain = {k: v for k, v in self.split.items() if k is not None}
        shared = spark.sparkContext.broadcast((np.array(self.highs, np.int64), np.array(sorted(plain), np.int64),
                                               np.array([plain[k] for k in sorted(plain)], np.int64).reshape(-1, 2)))

        @F.pandas_udf("int")
        def number(key: pd.Series, row: pd.Series) -> pd.Series:
            highs, hot, parts = shared.value
            key, row = key.to_numpy(), row.to_numpy()
            out = np.searchsorted(highs, key)
            if len(hot):
                at = np.minimum(np.searchsorted(hot, key), len(hot) - 1)
                out = np.where(hot[at] == key, parts[at, 0] + row % parts[at, 1], out)
            return pd.Series(out.astype(np.int32))

        key, row = F.coalesce(F.col("id").cast("long"), F.lit(0).cast("long")), F.monotonically_increasing_id()
        if None not in self.split:
            return number(key, row)
        start, parts = self.split[None]
        return F.when(F.col("id").isNull(), (F.lit(start) + row % parts).cast("int")).otherwise(number(key, row))

    def copies(self, src: DataFrame) -> DataFrame:
        """The rows that ranges need of other ranges: (range, own, id, text)."""
        spark = src.sparkSession
        asked = spark.createDataFrame([(r, 0, i) for r, i in self.heads] + [(r, 1, i) for r, i in self.inside],
                                      "range int, own int, id long")  # a row or two for each range
        ids = F.broadcast(asked.select("id").distinct())
        same = src["id"].cast("long").eqNullSafe(ids["id"])
        texts = src.join(ids, same, "left_semi").groupBy(F.col("id").cast("long").alias("id")).agg(F.min("text").alias("text"))
        return (texts.join(F.broadcast(asked), texts["id"].eqNullSafe(asked["id"]))
                .select("range", "own", texts["id"].alias("id"), "text"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                 scale: int = SCALE, least: int = LEAST, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Fingerprints of every whole text (null: empty) and of its edited text.

    The next document is the one with the next smaller id, after the last the one
    with the largest; in the edited text, the last third of the characters is
    replaced by the first as many of the next document. Returns id, ``n_chars``,
    ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``,
    ``near_next``: the estimated share of the text's shingles that the edited text
    and the next document hold; ``jaccard_edited`` and ``jaccard_next`` beside them.

    Ids are whole numbers. Null ids come after all others. Rows that repeat an id
    have the same next document; as a next document, an id stands for its smallest
    text. One row out per row in; a table of one id has itself as next document; an
    empty table gives an empty result; other columns are not read. Equal texts have
    equal fingerprints.
    """
    src = pick(docs, {"id": id_col, "text": text_col}).select("id", F.coalesce("text", F.lit("")).alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    ranges = Ranges(src.select("id"), range_rows)
    own = src.select(ranges.of(src.sparkSession).alias("range"), F.lit(2).alias("own"), F.col("id").cast("long").alias("id"), "text")
    dealt = (own.unionByName(ranges.copies(src)).repartitionById(max(1, ranges.count), F.col("range"))
             .withColumn("place", F.when(F.col("own") == 0, F.lit(0)).otherwise(F.lit(1)))
             .sortWithinPartitions("range", "place", F.asc_nulls_first("id"), "own", "text")
             .select("range", "own", "id", "text"))

    def run(batches):
        of = lambda t: (t, Sketch.of(t.encode(), words, scale, least))
        here = key = following = current = None
        for batch in (part for whole in batches for part in slices(whole)):
            out = []
            for rng, own, i, text in zip(*(c.to_pylist() for c in batch.columns)):
                if rng != here:
                    here, key, following, current = rng, None, None, None
                me = of(text)
                # The first row of an id is its smallest text; a head has a key of its own.
                if key != (own > 0, i):
                    following, current, key = current, me, (own > 0, i)
                if own < 2:
                    continue
                new = edited(text, following[0])
                changed = me[1] if new == text else Sketch.of(new.encode(), words, scale, least)
                out.append((i, len(text), hashlib.sha256(new.encode()).hexdigest(), me[1].hex(), changed.hex(),
                            *me[1].likeness(changed, new == text), *me[1].likeness(following[1], text == following[0])))
            columns = zip(*out) if out else [[]] * 9
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "jaccard_edited",
             "near_next", "jaccard_next"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), *[pa.float64()] * 4]
    out = dealt.mapInArrow(run, "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                                "near_edited double, jaccard_edited double, near_next double, jaccard_next double")
    return out.select(F.col("id").cast(kind).alias(id_col), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                      "near_edited", "near_next", "jaccard_edited", "jaccard_next")
