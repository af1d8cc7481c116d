"""Operator 9: remove word windows that an earlier document already holds.

Difference-cover anchors: a set D of residues modulo V such that every
difference modulo V occurs between two members. Any two places of equal text
then have, within the next V words, an offset at which both positions are in
D. Hashing short anchors only at cover positions therefore finds every match of
``window`` words, with |D|/V of the rows that all positions would take; windows
that hold an anchor shared between documents are then extended to their full
length and compared as whole windows.

Exact copies of a text hold the same windows: anchors are shared between different
texts, and only the row with a text's smallest id has its windows compared. Every
other copy loses all words that a window covers, so all of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bloom
from .common import materialize, pick, slices, text_slices, window_hashes, word_bounds, word_hashes

# Difference covers, by period.
COVERS = {
    3: (0, 1),
    7: (0, 1, 3),
    13: (0, 1, 3, 9),
    21: (0, 1, 4, 14, 16),
    31: (0, 1, 3, 8, 12, 18),
    57: (0, 1, 3, 13, 32, 36, 43, 52),
}


def cover_for(window: int) -> tuple[int, tuple[int, ...], int]:
    """(period, cover, anchor words): the largest period that leaves anchors a
    third of the window, so that a shared anchor says much about the window."""
    fitting = [v for v in COVERS if window - v + 1 >= max(1, window // 3)]
    period = max(fitting, default=1)
    return period, COVERS.get(period, (0,)), window - period + 1


def cover_positions(n: int, period: int, cover: tuple[int, ...]) -> np.ndarray:
    """Ascending positions below n whose residue is in the cover."""
    if n <= 0:
        return np.zeros(0, np.int64)
    at = (np.arange(0, n, period)[:, None] + np.array(cover)[None, :]).ravel()
    return at[at < n]


def _flat(ids: pa.Array, hashes: list[np.ndarray]) -> pa.RecordBatch:
    sizes = [len(h) for h in hashes]
    where = np.repeat(np.arange(len(hashes)), sizes)
    flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    return pa.RecordBatch.from_arrays([pa.array(flat.view(np.int64)), ids.take(pa.array(where))], ["h", "id"])


def dedup_substrings(docs: DataFrame, window: int = 50, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """Remove every word covered by a ``window``-word sequence that also starts
    in a document with a smaller id.

    Returns id, ``n_words``, ``n_removed``, ``removed`` (runs ``{start, length}``
    in words) and ``kept`` (remaining words joined by one blank), one row per
    input row. Null and empty texts have no words. Rows that repeat an id never
    count as each other's earlier document; rows with a null id lose nothing and
    make nobody lose. Other columns are not read. Windows are compared by 64-bit
    hashes of their words, whole texts by 64-bit hashes of their characters.
    """
    spark = docs.sparkSession
    src = pick(docs, {"id": id_col, "text": text_col})
    period, cover, length = cover_for(window)
    id_type = src.schema["id"].dataType.simpleString()

    def anchors_of(batches, held=None):
        for batch in (part for whole in batches for part in slices(whole)):
            buf, offs = text_slices(batch.column(1))
            found = []
            for i in range(len(offs) - 1):
                starts, ends = word_bounds(buf[offs[i]:offs[i + 1]])
                if len(starts) < window:
                    found.append(np.zeros(0, np.uint64))
                    continue
                words = word_hashes(buf[offs[i]:offs[i + 1]], starts, ends)
                h = np.unique(window_hashes(words, length, cover_positions(len(words) - length + 1, period, cover)))
                found.append(h if held is None else h[bloom.contains(held.value, h)])
            yield _flat(batch.column(0), found)

    def windows_of(batches):
        for batch in (part for whole in batches for part in slices(whole)):
            buf, offs = text_slices(batch.column(1))
            marks = batch.column(2)
            found = []
            for i in range(len(offs) - 1):
                words = word_hashes(buf[offs[i]:offs[i + 1]], *word_bounds(buf[offs[i]:offs[i + 1]]))
                at = cover_positions(len(words) - length + 1, period, cover)
                shared = marks[i].values.to_numpy(zero_copy_only=False).view(np.uint64)
                met = np.zeros(len(words) + 1, np.int64)
                met[at + 1] = np.isin(window_hashes(words, length, at), shared)
                met = np.cumsum(met)  # shared anchors that begin before each position
                starts = np.arange(len(words) - window + 1)
                starts = starts[met[starts + period] > met[starts]]
                found.append(np.unique(window_hashes(words, window, starts)))
            yield _flat(batch.column(0), found)

    def keep(batches):
        for batch in (part for whole in batches for part in slices(whole)):
            buf, offs = text_slices(batch.column(1))
            marks, copy = batch.column(2), batch.column(3).to_numpy(zero_copy_only=False)
            n_words, n_removed, runs, kept = [], [], [], []
            for i in range(len(offs) - 1):
                text = buf[offs[i]:offs[i + 1]]
                words = text.tobytes().split()
                gone = np.zeros(len(words) + 1, np.int64)
                if copy[i]:
                    gone[0] = len(words) >= window  # covered by its windows from end to end
                elif marks[i].is_valid:
                    hashes = window_hashes(word_hashes(text, *word_bounds(text)), window)
                    hit = np.flatnonzero(np.isin(hashes, marks[i].values.to_numpy(zero_copy_only=False).view(np.uint64)))
                    np.add.at(gone, hit, 1)
                    np.add.at(gone, hit + window, -1)
                out = np.cumsum(gone)[:-1] > 0
                edge = np.flatnonzero(np.diff(np.concatenate([[0], out.astype(np.int8), [0]])))
                n_words.append(len(words))
                n_removed.append(int(out.sum()))
                runs.append([{"start": int(a), "length": int(b - a)} for a, b in zip(edge[::2], edge[1::2])])
                kept.append(b" ".join(w for w, g in zip(words, out) if not g) if out.any() else b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))),
                 pa.array(kept, pa.binary()).cast(pa.string())],
                ["id", "n_words", "n_removed", "removed", "kept"])

    def may_be_among(rows, n):
        """A filter on ``id`` that lets the ids of some rows through, and few others."""
        held = spark.sparkContext.broadcast(bloom.build(rows.select(F.xxhash64("id").alias("v")), "v", n))

        @F.arrow_udf("boolean")
        def test(v: pa.Array) -> pa.Array:
            return pa.array(bloom.contains(held.value, v.to_numpy(zero_copy_only=False)))
        return test(F.xxhash64("id"))

    pair = f"h long, id {id_type}"
    known = src.where("id is not null")
    content = F.xxhash64("text")
    # Written tables between the steps: each step's shuffle files go when it ends.
    classes = materialize(known.where("text is not null").groupBy(content.alias("k")).agg(
        F.min("id").alias("id"), F.max("id").alias("last")), "substring-classes")
    hashed = known.select(content.alias("k"), "text")
    shared = materialize(hashed.mapInArrow(anchors_of, "h long, id long").groupBy("h")
                         .agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a < b").select("h"), "substring-shared")
    held = spark.sparkContext.broadcast(bloom.build(shared, "h", shared.count()))
    anchors = hashed.mapInArrow(lambda batches: anchors_of(batches, held), "h long, k long")
    hits = materialize(anchors.join(shared, "h").groupBy("k").agg(F.collect_set("h").alias("hs"))
                       .join(classes, "k").select("id", "k", "hs"), "substring-anchors")
    # Texts are shuffled only where a row may have a partner.
    met = known.where(may_be_among(hits, hits.count())).select("id", content.alias("k"), "text")
    windows = met.join(hits, ["id", "k"]).select("id", "text", "hs").mapInArrow(windows_of, pair)
    first = windows.groupBy("h").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a < b").select("h", "a")
    later = windows.join(first, "h").where("id > a").select("id", "h", F.lit(None).cast("long").alias("k"))
    copies = (known.select("id", content.alias("k"))
              .join(classes.where("id < last").select("k", F.col("id").alias("a")), "k").where("id > a")
              .select("id", F.lit(None).cast("long").alias("h"), "k"))
    later = materialize(later.unionByName(copies).groupBy("id").agg(
        F.collect_set("h").alias("hs"), F.collect_set("k").alias("ks")), "substring-windows")
    loses = F.coalesce(may_be_among(later, later.count()), F.lit(False))
    marked = src.where(loses).join(later, "id", "left").select(
        "id", "text", "hs", F.coalesce(F.array_contains("ks", content), F.lit(False)).alias("copy"))
    whole = src.where(~loses).select("id", "text", F.lit(None).cast("array<long>").alias("hs"), F.lit(False).alias("copy"))
    result = (f"id {id_type}, n_words long, n_removed long, "
              "removed array<struct<start: long, length: long>>, kept string")
    return (marked.mapInArrow(keep, result).unionByName(whole.mapInArrow(keep, result))
            .withColumnRenamed("id", id_col))
