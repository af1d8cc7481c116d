"""Operator 1: remove bytes of long strings that occur again, by merging suffix orders.

A suffix order of the whole corpus is never sorted. Suffixes are sharded by
content: the leftmost smallest hash of a short byte gram in a window anchors it,
at the same offset wherever the window occurs, so equal windows share a shard
(anchor, offset range and the bytes all windows of the range have in common).

1. Runs of windows with one anchor and offset range are *pieces*. Pieces are
   counted per shard with map-side combining. A shard with one piece repeats
   nothing; a shard whose pieces are all equal repeats in full. Only shards of
   differing pieces go on, one representative per distinct piece, with nothing
   but the bytes on either side of the shared core.
2. Per shard the orders of the pieces' suffixes are merged by interleave
   refinement: the interleave starts as one block and each further byte splits
   its blocks stably, which yields the common prefix lengths. The suffixes one
   byte longer to the left follow from a stable partition by the preceding byte
   (the Burrows-Wheeler step), so no suffix is sorted again.
3. At every offset, intervals whose common prefix covers the window are repeats.

Shards with more than ``max_pieces`` distinct pieces are not merged in a task but
resolved window by window in an aggregation of the cluster, with equal results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (BYTE_CODE, BYTE_POWERS, materialize, mix64, pick, prefix_hash, slices, span_hash,
                     text_slices)

GRAM = 16              # bytes of an anchor gram (shortened for short windows)
SPLIT = 4              # offset ranges per anchor
SEGMENT = 1 << 19      # window starts handled at once within a long text
MAX_PIECES = 100_000   # distinct pieces of a shard merged in one task (some 200 bytes each)
_LOW = np.uint64((1 << 20) - 1)


class Pieces:
    """The pieces of one text: window starts [at, at + n) share an anchor and an offset range."""

    def __init__(self, buf: np.ndarray, length: int):
        self.length = length
        gram = min(GRAM, max(1, length // 4))
        span = length - gram + 1                      # grams per window
        self.step = step = -(-span // SPLIT)          # offsets per range
        n = len(buf) - length + 1
        if n <= 0:
            empty = np.zeros(0, np.int64)
            self.at = self.n = self.low = self.high = self.anchor = empty
            self.shard = self.content = np.zeros(0, np.uint64)
            return
        prefix = prefix_hash(BYTE_CODE[buf], BYTE_POWERS)
        at, size, anchor, rank, grams = [], [], [], [], []
        for s in range(0, n, SEGMENT):
            m = min(SEGMENT, n - s)
            g = np.arange(s, s + m + span - 1)
            gh = span_hash(prefix, g, g + gram, BYTE_POWERS)
            # Hash above, position below: ties go to the leftmost gram.
            least = (_window_min((gh & ~_LOW) | np.arange(len(gh), dtype=np.uint64), span)[:m] & _LOW).astype(np.int64)
            part = (least - np.arange(m)) // step
            first = np.flatnonzero(np.concatenate([[True], (np.diff(least) != 0) | (np.diff(part) != 0)]))
            at.append(first + s)
            size.append(np.diff(np.append(first, m)))
            anchor.append(least[first] + s)
            rank.append(part[first])
            grams.append(gh[least[first]])
        self.at, self.n, self.anchor = map(np.concatenate, (at, size, anchor))
        rank = np.concatenate(rank)
        self.low = rank * step                         # offsets of the range
        self.high = self.low + step - 1
        core = span_hash(prefix, self.anchor - self.low, self.anchor - self.high + length, BYTE_POWERS)
        self.shard = mix64(core ^ mix64(np.concatenate(grams) + rank.astype(np.uint64)))
        whole = span_hash(prefix, self.at, self.at + self.n - 1 + length, BYTE_POWERS)
        self.content = mix64(whole + mix64((self.anchor - self.at).astype(np.uint64)))


def _window_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, from block-wise running minima."""
    n = len(values)
    blocks = np.full(-(-n // width) * width, ~np.uint64(0))
    blocks[:n] = values
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def _split_blocks(order: np.ndarray, block: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stable refinement: members of a block are dealt by their symbol and keep
    their order otherwise. ``block`` is ascending along ``order``; returns the
    new order and the blocks along it."""
    key = block * 257 + symbol[order]
    place = np.argsort(key, kind="stable")
    order, key = order[place], key[place]
    return order, np.cumsum(np.concatenate([[0], np.diff(key) != 0]))


def merge_shards(shard: np.ndarray, left: np.ndarray, right: np.ndarray, reach: np.ndarray,
                 count: np.ndarray, width: int) -> list[tuple[int, int, int]]:
    """Repeated windows of the pieces of some shards.

    ``left[i, d]`` is the byte d + 1 before piece i's core, ``right[i, d]`` the byte
    d after it (256 beyond the piece); a window that begins d bytes before the
    core needs the d bytes left and ``width - 1 - d`` right of it. Piece i has the
    windows of d = reach[i], reach[i] - 1, ... (count[i] of them). Returns
    (piece, first, last) runs of window numbers within a piece.
    """
    n = len(shard)
    order = np.argsort(shard, kind="stable")
    block = np.cumsum(np.concatenate([[0], np.diff(shard[order].view(np.int64)) != 0]))
    # Interleave refinement to the right: common[i] is the common prefix with the one before in the order.
    common = np.zeros(n, np.int64)
    common[1:][np.diff(block) != 0] = -1
    for c in range(width - 1):
        if block[-1] == n - 1:
            break  # every block is a single suffix
        before = block
        order, block = _split_blocks(order, block, right[:, c])
        fresh = np.concatenate([[False], (np.diff(block) != 0) & (np.diff(before) == 0)])
        common[fresh] = c
        common[np.concatenate([[False], np.diff(block) == 0])] = c + 1
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    # Steps to the left: the same order, dealt by the preceding byte.
    block = np.cumsum(np.concatenate([[0], np.diff(shard[order].view(np.int64)) != 0]))
    flagged: list[np.ndarray] = []
    for d in range(width):
        if d:
            order, block = _split_blocks(order, block, left[:, d - 1])
        runs = np.cumsum(common < width - 1 - d)       # right contexts that agree as far as needed
        agree = runs[rank[order]]
        group = np.cumsum(np.concatenate([[0], (np.diff(block) != 0) | (np.diff(agree) != 0)]))
        live = (d <= reach[order]) & (d > reach[order] - count[order])
        size = np.bincount(group[live], minlength=group[-1] + 1)
        hit = order[live & (size[group] > 1)]
        if len(hit):
            flagged.append(np.stack([hit, reach[hit] - d], axis=1))
    if not flagged:
        return []
    hits = np.concatenate(flagged)
    hits = hits[np.lexsort((hits[:, 1], hits[:, 0]))]
    first = np.concatenate([[True], (np.diff(hits[:, 0]) != 0) | (np.diff(hits[:, 1]) != 1)])
    last = np.append(first[1:], True)
    return list(zip(hits[first, 0].tolist(), hits[first, 1].tolist(), hits[last, 1].tolist()))


def _contexts(buf: np.ndarray, p: Pieces, i: int) -> tuple[bytes, bytes]:
    """Bytes before the core, nearest first, and after it, as far as the piece goes."""
    a, core, core_end = int(p.at[i]), int(p.anchor[i] - p.low[i]), int(p.anchor[i] - p.high[i]) + p.length
    return buf[a:core][::-1].tobytes(), buf[core_end:a + int(p.n[i]) - 1 + p.length].tobytes()


def _matrix(rows: list[bytes], width: int) -> np.ndarray:
    out = np.full((len(rows), max(1, width - 1)), 256, np.int16)
    for i, r in enumerate(rows):
        out[i, :len(r)] = np.frombuffer(r, np.uint8)[:width - 1]
    return out


def remove_repeats(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text",
                   max_pieces: int = MAX_PIECES, tasks: int | None = None) -> DataFrame:
    """Remove each byte covered by a ``length``-byte string that also starts
    anywhere else in the table, the same text included.

    Returns id, ``n_bytes``, ``n_removed``, ``n_spans``, ``spans`` (removed runs
    ``{start, length}`` in bytes) and ``kept`` (remaining bytes), one row per input
    row. Null and empty texts have no bytes. Rows that repeat an id or a text are
    separate documents, a null id too. Other columns are not read. Shards and
    equal pieces are told by 64-bit hashes.
    """
    spark = docs.sparkSession
    src = pick(docs, {"id": id_col, "text": text_col})
    kind = src.schema["id"].dataType.simpleString()
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    step = -(-(length - min(GRAM, max(1, length // 4)) + 1) // SPLIT)

    def pieces_of(batches):
        for batch in (part for whole in batches for part in slices(whole)):
            buf, offs = text_slices(batch.column(1))
            found = [(p.shard, p.content) for i in range(len(offs) - 1)
                     for p in [Pieces(buf[offs[i]:offs[i + 1]], length)]]
            at = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
            shard, content = (np.concatenate([f[k] for f in found]).view(np.int64) for k in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard), pa.array(content), batch.column(0).take(pa.array(at))], ["shard", "piece", "id"])

    pieces = src.mapInArrow(pieces_of, f"shard long, piece long, id {kind}")
    counts = pieces.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.min("piece").alias("a"), F.max("piece").alias("b"))
    repeated = counts.where("n > 1").select("shard", (F.col("a") == F.col("b")).alias("same"))
    hits = materialize(pieces.join(repeated, "shard"), "repeat-pieces")

    # Distinct pieces of shards in which they differ, each with one document that holds it.
    distinct = (hits.where("not same").groupBy("shard", "piece").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("id")))
    distinct = materialize(distinct, "repeat-distinct")
    sizes = distinct.groupBy("shard").agg(F.count(F.lit(1)).alias("k"))
    crowded = sizes.where(F.col("k") > max_pieces).select("shard")
    whole = hits.where("same").select("id", "piece").unionByName(
        hits.where("not same").join(distinct.where("n > 1").select("shard", "piece"), ["shard", "piece"], "left_semi")
        .select("id", "piece")).distinct()

    def contexts_of(batches):
        for batch in (part for whole in batches for part in slices(whole)):
            buf, offs = text_slices(batch.column(1))
            out = {"shard": [], "piece": [], "reach": [], "n": [], "left": [], "right": []}
            for i in range(len(offs) - 1):
                text = buf[offs[i]:offs[i + 1]]
                wanted = batch.column(2)[i].values.to_numpy(zero_copy_only=False).view(np.uint64)
                p = Pieces(text, length)
                seen = set()
                for j in np.flatnonzero(np.isin(p.content, wanted)):
                    if (int(p.shard[j]), int(p.content[j])) in seen:
                        continue
                    seen.add((int(p.shard[j]), int(p.content[j])))
                    left, right = _contexts(text, p, j)
                    for name, v in (("shard", int(p.shard[j:j + 1].view(np.int64)[0])),
                                    ("piece", int(p.content[j:j + 1].view(np.int64)[0])),
                                    ("reach", len(left)), ("n", int(p.n[j])), ("left", left), ("right", right)):
                        out[name].append(v)
            kinds = {"shard": pa.int64(), "piece": pa.int64(), "reach": pa.int32(), "n": pa.int32(), "left": pa.binary(), "right": pa.binary()}
            yield pa.RecordBatch.from_arrays([pa.array(v, kinds[k]) for k, v in out.items()], list(out))

    needed = distinct.groupBy("id").agg(F.collect_set("piece").alias("ps"))
    # A null id needs a null-safe join; ids are otherwise plain keys.
    contexts = (src.join(needed.withColumnRenamed("id", "rid"), F.col("id").eqNullSafe(F.col("rid")))
                .select("id", "text", "ps")
                .mapInArrow(contexts_of, "shard long, piece long, reach int, n int, left binary, right binary"))

    def merged(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < 20_000:
                continue
            t = pa.Table.from_batches(held)
            shard = t.column("shard").to_numpy()
            cut = int(np.searchsorted(shard, shard[-1]))  # the last shard may go on in the next batch
            if cut:
                yield from _merge_table(t.slice(0, cut), step)
                held = t.slice(cut).to_batches()
        if held:
            yield from _merge_table(pa.Table.from_batches(held), step)

    def windows_of(batches):
        for batch in batches:
            rows = {"h": [], "piece": [], "nth": []}
            for s, q, reach, n, left, right in zip(*[batch.column(c).to_pylist() for c in range(6)]):
                both = np.frombuffer(left[::-1] + right, np.uint8)
                prefix = prefix_hash(BYTE_CODE[both], BYTE_POWERS)
                k = np.arange(n)
                # A window without its core: what it takes on both sides, which the shard's core joins.
                ends = reach + np.maximum(0, step - 1 - (reach - k))
                h = span_hash(prefix, k, np.minimum(ends, len(both)), BYTE_POWERS)
                rows["h"] += mix64(h ^ mix64(np.uint64(s & (1 << 64) - 1) + (reach - k).astype(np.uint64))).view(np.int64).tolist()
                rows["piece"] += [q] * n
                rows["nth"] += k.tolist()
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in rows.values()], list(rows))

    full = not crowded.isEmpty()
    calm = contexts.join(crowded, "shard", "left_anti") if full else contexts
    runs = (calm.repartition(tasks, "shard").sortWithinPartitions("shard", "piece")
            .mapInArrow(merged, "piece long, first long, last long"))
    if full:
        windows = (contexts.join(crowded, "shard", "left_semi").dropDuplicates(["shard", "piece"])
                   .mapInArrow(windows_of, "h long, piece long, nth long"))
        again = windows.groupBy("h").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("h")
        runs = runs.unionByName(windows.join(again, "h").select(
            "piece", F.col("nth").alias("first"), F.col("nth").alias("last")))
    some = distinct.where("n = 1").select("id", "piece").join(runs, "piece")

    flags = whole.select("id", "piece", F.lit(0).cast("long").alias("first"), F.lit(-1).cast("long").alias("last")
                         ).unionByName(some)
    flags = flags.groupBy(F.col("id").alias("rid")).agg(F.collect_set(F.struct("piece", "first", "last")).alias("marks"))

    def cut(batches):
        for batch in (part for whole in batches for part in slices(whole)):
            buf, offs = text_slices(batch.column(1))
            n_bytes, n_removed, spans, kept = [], [], [], []
            for i in range(len(offs) - 1):
                text = buf[offs[i]:offs[i + 1]]
                gone = np.zeros(len(text) + 1, np.int64)
                if batch.column(2)[i].is_valid and len(text) >= length:
                    marks = batch.column(2)[i].values
                    keys = marks.field("piece").to_numpy(zero_copy_only=False).view(np.uint64)
                    first = marks.field("first").to_numpy(zero_copy_only=False)
                    last = marks.field("last").to_numpy(zero_copy_only=False)
                    p = Pieces(text, length)
                    by = np.argsort(keys, kind="stable")
                    keys, first, last = keys[by], first[by], last[by]
                    lo, hi = np.searchsorted(keys, p.content, "left"), np.searchsorted(keys, p.content, "right")
                    for j in np.flatnonzero(lo < hi):
                        for m in range(lo[j], hi[j]):
                            a = p.at[j] + first[m]
                            b = p.at[j] + (last[m] if last[m] >= 0 else p.n[j] - 1)
                            gone[a] += 1
                            gone[b + length] -= 1
                out = np.cumsum(gone)[:-1] > 0
                edge = np.flatnonzero(np.diff(np.concatenate([[0], out.astype(np.int8), [0]])))
                n_bytes.append(len(text))
                n_removed.append(int(out.sum()))
                spans.append([{"start": int(a), "length": int(b - a)} for a, b in zip(edge[::2], edge[1::2])])
                kept.append(text[~out].tobytes() if len(edge) else text.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array([len(s) for s in spans], pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))),
                 pa.array(kept, pa.binary())],
                ["id", "n_bytes", "n_removed", "n_spans", "spans", "kept"])

    marked = src.join(flags, F.col("id").eqNullSafe(F.col("rid")), "left").select("id", "text", "marks")
    return marked.mapInArrow(cut, f"id {kind}, n_bytes long, n_removed long, n_spans long, "
                             "spans array<struct<start: long, length: long>>, kept binary").withColumnRenamed("id", id_col)


def _merge_table(t: pa.Table, width: int):
    shard, piece = (t.column(c).to_numpy() for c in ("shard", "piece"))
    # Sorted by both: a piece that rows with one id hold several times counts once.
    once = np.concatenate([[True], (np.diff(shard) != 0) | (np.diff(piece) != 0)])
    t, shard, piece = t.filter(pa.array(once)), shard[once], piece[once]
    found = merge_shards(shard.view(np.uint64), _matrix(t.column("left").to_pylist(), width),
                         _matrix(t.column("right").to_pylist(), width), t.column("reach").to_numpy().astype(np.int64),
                         t.column("n").to_numpy().astype(np.int64), width)
    which = np.array([f[0] for f in found], np.int64)
    yield pa.RecordBatch.from_arrays(
        [pa.array(piece[which]), pa.array([f[1] for f in found], pa.int64()),
         pa.array([f[2] for f in found], pa.int64())], ["piece", "first", "last"])
