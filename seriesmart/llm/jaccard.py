"""Operator 8: word n-gram Jaccard join, by a size-aware heavy-light scheme.

Two documents link when the Jaccard similarity of their shingle sets reaches
num/den. Equal sets collapse to one node first. A linked set repeats more than half
of its elements with the smallest hashes (twice a prefix of them, see
``Measure.repeated``); sets that do not are out. Of the others:

* Light sets (size up to a boundary): a pair of sizes (a, b) needs an overlap of
  at least o(a, b), so both sets enumerate their subsets of exactly that size;
  linked sets share one.
* Heavy sets: inverted lists over each set's prefix in one global element order;
  linked sets share a prefix element. The order goes by how many sets hold an
  element, rare ones first, in levels that filters of bounded size tell; as that
  makes it a plain function of the element, their false positives change costs
  only. Elements of a single set are in no list. Prefixes are as long as the sizes
  of both sides require: lists are kept per pair of size classes.
* The boundary is the size up to which enumerating costs less than scanning,
  from the counted sizes and list lengths.

Lists are not turned into all pairs. Each node first meets the leader that it
shares most lists with (a list's leader is the member with the fewest elements of
its own); ``rounds`` more leaders may follow. Verified links merge into components,
and only members of different components meet again: exhaustively, in blocks of a
list against each other, of which only links come out. Every candidate is verified
on whole sets.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bloom
from .common import LOWER, materialize, mix64, pick, slices, text_slices, window_hashes, word_bounds, word_hashes
from .components import components

LEVELS = (2, 4, 8, 16, 32, 64, 128, 256)  # counts that set elements further back in the order
BLOCK = 512       # members of a list that are compared with as many others in one task
MAX_LIGHT = 24    # largest size considered for subset enumeration
_EMPTY = np.zeros(0, np.uint64)


def shingles(text: np.ndarray, words: int) -> np.ndarray:
    """Sorted distinct hashes of ``words``-word shingles (A-Z lower-cased); of the
    whole sequence when there are fewer words; empty without words."""
    low = LOWER[text]
    hashes = word_hashes(low, *word_bounds(low))
    if not len(hashes):
        return _EMPTY
    return np.unique(window_hashes(hashes, min(words, len(hashes))))


def set_hash(s: np.ndarray) -> int:
    """Order-free 64-bit hash of a set, signed."""
    with np.errstate(over="ignore"):
        h = mix64(np.array([np.add.reduce(mix64(s)) ^ np.uint64(len(s))], np.uint64))
    return int(h.view(np.int64)[0])


class Measure:
    """Exact integer arithmetic of the threshold num/den."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den

    def overlap(self, a: int, b: int) -> int:
        """Least intersection of linked sets of sizes a and b."""
        return -(-self.num * (a + b) // (self.num + self.den))

    def largest(self, a: int) -> int:
        """Largest size that can link with size a."""
        return a * self.den // self.num

    def smallest(self, a: int) -> int:
        return -(-a * self.num // self.den)

    def prefix(self, a: int, b: int | None = None) -> int:
        """Elements of a set of size a of which a linked set of size b or more (b at
        least the smallest that links) holds one."""
        return a - self.overlap(a, max(b or 0, self.smallest(a))) + 1

    def counted(self, a: int) -> int:
        """Smallest elements of a set over which repetition is counted."""
        return min(a, 2 * self.prefix(a))

    def repeated(self, a: int) -> int:
        """Least number of those that a linked set of any size has among its own:
        either side lacks at most prefix - 1 elements of the other."""
        low = self.smallest(a)
        sizes = range(low, a + 1) if a < 64 else (low, a)
        return min(self.counted(b) - self.prefix(b) + 1 for b in sizes)

    @staticmethod
    def common(s: np.ndarray, t: np.ndarray) -> int:
        """Elements in both of two sorted distinct arrays, neither empty."""
        return int(np.count_nonzero(t.take(np.searchsorted(t, s), mode="clip") == s))

    def links(self, s: np.ndarray, t: np.ndarray) -> bool:
        """Of two sorted distinct arrays."""
        if not len(s) or not len(t):
            return False
        both = self.common(s, t)
        return self.den * both >= self.num * (len(s) + len(t) - both)

    def size_pairs(self, a: int, top: int) -> list[tuple[int, int]]:
        """(smaller, larger) size pairs within ``top`` that a set of size a can be part of."""
        return ([(b, a) for b in range(self.smallest(a), a)]
                + [(a, b) for b in range(a, min(self.largest(a), top) + 1)])

    def subsets(self, a: int, top: int) -> int:
        return sum(comb(a, self.overlap(*p)) for p in self.size_pairs(a, top))


def subset_keys(s: np.ndarray, lone: int, measure: Measure, top: int) -> np.ndarray:
    """Keys of all subsets that a light set can share with a light set it links
    with. Its first ``lone`` elements are no other document's, so are in no subset."""
    keys, mixed, n = [], [int(x) for x in mix64(s[lone:])], len(s)
    total, low = sum(mixed), (1 << 64) - 1
    for a, b in measure.size_pairs(n, top):
        left_out = n - measure.overlap(a, b) - lone
        if left_out >= 0:
            seed = (a << 32 | b) * 0x9E3779B97F4A7C15
            keys += [(total - sum(out) + seed) & low for out in combinations(mixed, left_out)]
    return np.unique(mix64(np.array(keys, np.uint64))) if keys else _EMPTY


def size_classes(limit: int) -> list[int]:
    """Least sizes of the size classes: single sizes first, then steps of 4 %."""
    out = [1]
    while out[-1] <= limit:
        out.append(max(out[-1] + 1, out[-1] * 26 // 25))
    return out


def prefix_keys(s: np.ndarray, lone: int, measure: Measure, classes: list[int]) -> np.ndarray:
    """Keys of the prefix elements, per size class of the other side. ``s`` is in
    the global order; its first ``lone`` elements are no other document's."""
    n, keys = len(s), []
    own = bisect_right(classes, n) - 1
    for other in range(bisect_right(classes, measure.smallest(n)) - 1, bisect_right(classes, measure.largest(n))):
        part = s[lone:measure.prefix(n, classes[other])]
        if len(part):
            keys.append(mix64(part + np.uint64(min(own, other) << 32 | max(own, other))))
    return np.concatenate(keys) if keys else _EMPTY


def levels_of(s: np.ndarray, filters: list[np.ndarray]) -> np.ndarray:
    """How many of the levels' filters hold each element."""
    level = np.zeros(len(s), np.int64)
    at = np.arange(len(s))
    for f in filters:
        at = at[bloom.contains(f, s[at])]
        level[at] += 1
    return level


def _sets(batch: pa.RecordBatch, column: int, words: int):
    buf, offs = text_slices(batch.column(column))
    for i in range(len(offs) - 1):
        yield shingles(buf[offs[i]:offs[i + 1]], words)


def _rows(keys: list[np.ndarray], nodes: list[int], lone: list[int]) -> pa.RecordBatch:
    flat = np.concatenate(keys) if keys else _EMPTY
    sizes = [len(k) for k in keys]
    return pa.RecordBatch.from_arrays(
        [pa.array(flat.view(np.int64)), pa.array(np.repeat(np.array(nodes, np.int64), sizes)),
         pa.array(np.repeat(np.array(lone, np.int32), sizes))], ["h", "node", "lone"])


def light_boundary(sizes: list[tuple[int, int]], list_length: float, measure: Measure) -> int:
    """The size up to which subset enumeration is the cheaper way. ``sizes`` holds
    (size, sets); an element of a scanned prefix costs its mean list length."""
    best, best_cost = 0, 0.0
    for top in range(1, MAX_LIGHT + 1):
        cost = sum(n * (measure.subsets(a, top) - measure.prefix(a) * (1 + list_length))
                   for a, n in sizes if a <= top)
        if cost <= best_cost:
            best, best_cost = top, cost
    return best


def jaccard_join(docs: DataFrame, words: int = 4, num: int = 85, den: int = 100, rounds: int = 0,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row: id, ``n_shingles`` and ``component_id``, the smallest id
    reachable by links, itself included.

    Null and empty texts and texts without words have an empty set and link with
    nothing: their component is their own id. Rows with a null id take part, but a
    component is named by its smallest id that is not null. Rows that repeat an id
    are separate documents. Other columns are not read. Sets are of 64-bit hashes.
    """
    spark = docs.sparkSession
    measure = Measure(num, den)
    src = pick(docs, {"id": id_col, "text": text_col})
    kind = src.schema["id"].dataType.simpleString()

    def rows_of(batches):
        for batch in batches:
            for part in slices(batch):
                sets = list(_sets(part, 1, words))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([set_hash(s) if len(s) else None for s in sets], pa.int64()),
                     pa.array([s[:measure.counted(len(s))].view(np.int64) if len(s) else [] for s in sets],
                              pa.list_(pa.int64()))], ["id", "n", "node", "least"])

    rows = materialize(src.mapInArrow(rows_of, f"id {kind}, n long, node long, least array<long>"), "jaccard-rows")
    least = materialize(rows.select(F.explode("least").alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("n"))
                        .where("n > 1").select("h"), "jaccard-least")
    met = spark.sparkContext.broadcast(bloom.build(least, "h", least.count()))

    def texts_of(batches):
        for batch in batches:
            for part in slices(batch):
                keep, nodes, sizes = [], [], []
                for i, s in enumerate(_sets(part, 0, words)):
                    if len(s) and bloom.contains(met.value, s[:measure.counted(len(s))]).sum() >= measure.repeated(len(s)):
                        keep.append(i)
                        nodes.append(set_hash(s))
                        sizes.append(len(s))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()),
                     part.column(0).take(pa.array(keep, pa.int64()))], ["node", "n", "text"])

    # One text per node that may link with another.
    texts = materialize(src.select("text").mapInArrow(texts_of, "node long, n long, text string").groupBy("node").agg(
        F.min("n").alias("n"), F.min("text").alias("text")), "jaccard-texts")

    def elements_of(batches):
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([_EMPTY, *_sets(part, 0, words)]).view(np.int64))], ["h"])

    lists = materialize(texts.select("text").mapInArrow(elements_of, "h long").groupBy("h").agg(
        F.count(F.lit(1)).alias("n")).where("n > 1"), "jaccard-lists")
    stats = lists.agg(F.sum(F.col("n") * F.col("n")) / F.sum("n"), *[
        F.count(F.when(F.col("n") >= k, 1)) for k in LEVELS]).first()
    filters = spark.sparkContext.broadcast([
        bloom.build(lists.where(F.col("n") >= k), "h", m) for k, m in zip(LEVELS, stats[1:]) if m])
    sizes = [(r.n, r.sets) for r in texts.where(F.col("n") <= MAX_LIGHT).groupBy("n").agg(
        F.count(F.lit(1)).alias("sets")).collect()]  # at most MAX_LIGHT rows
    top = light_boundary(sizes, float(stats[0] or 1.0), measure)
    classes = size_classes(2 * int(texts.agg(F.max("n")).first()[0] or 1))

    def keys_of(batches):
        for batch in batches:
            for part in slices(batch):
                keys, nodes, lones = [], [], []
                for node, s in zip(part.column(0).to_pylist(), _sets(part, 1, words)):
                    level = levels_of(s, filters.value)
                    lone = int((level == 0).sum())
                    if lone > measure.prefix(len(s)) - 1:
                        continue  # too many elements of its own to link with anything
                    ordered = s[np.argsort(level, kind="stable")]
                    found = [subset_keys(ordered, lone, measure, top)] if len(s) <= top else []
                    if measure.largest(len(s)) > top:
                        found.append(prefix_keys(ordered, lone, measure, classes))
                    keys += found
                    nodes += [node] * len(found)
                    lones += [lone] * len(found)
                yield _rows(keys, nodes, lones)

    keys = materialize(texts.select("node", "text").mapInArrow(keys_of, "h long, node long, lone int"), "jaccard-own-keys")
    met.unpersist()
    filters.unpersist()
    central = F.struct("lone", "node")
    leaders = keys.groupBy("h").agg(F.min(central)["node"].alias("leader"), F.min("node").alias("a"),
                                    F.max("node").alias("b")).where("a < b")
    shared = materialize(_widest(materialize(keys.join(leaders.select("h", "leader"), "h"), "jaccard-all-keys")),
                         "jaccard-keys")

    def linked(batches):
        for batch in batches:
            left, right = _sets(batch, 2, words), _sets(batch, 3, words)
            ok = [measure.links(s, t) for s, t in zip(left, right)]
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    def verify(pairs: DataFrame) -> DataFrame:
        a = texts.select(F.col("node").alias("u"), F.col("n").alias("n1"), F.col("text").alias("s"))
        b = texts.select(F.col("node").alias("v"), F.col("n").alias("n2"), F.col("text").alias("t"))
        near = (F.col("n1") * num <= F.col("n2") * den) & (F.col("n2") * num <= F.col("n1") * den)
        return (pairs.join(a, "u").join(b, "v").where(near).select("u", "v", "s", "t")
                .mapInArrow(linked, "u long, v long"))

    # First round: every node meets the leader that it shares most keys with.
    votes = shared.where("node <> leader").groupBy("node", "leader").agg(F.count(F.lit(1)).alias("k"))
    pairs = votes.groupBy(F.col("node").alias("u")).agg(
        F.max_by("leader", F.struct("k", "leader")).alias("v"))
    links = materialize(verify(pairs), "jaccard-links")
    found = components(links)
    for turn in range(rounds):
        apart = _apart(shared, found)
        # The next leader: the most central member, later others, against the members of other components.
        first = F.struct("lone", "node") if turn == 0 else F.struct(
            F.xxhash64("component", F.lit(turn)), F.xxhash64("node", F.lit(turn)))
        lead = apart.groupBy("h").agg(F.min_by(F.struct("node", "component"), first).alias("lead"))
        pairs = (apart.join(lead, "h").where(F.col("component") != F.col("lead.component"))
                 .select(F.greatest("node", "lead.node").alias("u"), F.least("node", "lead.node").alias("v")).distinct())
        new = materialize(verify(pairs), "jaccard-links")
        if not new.isEmpty():
            links = links.unionByName(new)
            found = components(links)
    # What is still apart: the members of a list in different components, block by
    # block. A pair that shares several lists is compared in the first of them only.
    apart = materialize(_apart(shared, found), "jaccard-apart")
    lists = apart.groupBy("h").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    own_lists = apart.groupBy("node").agg(F.sort_array(F.collect_list("h")).alias("hs"))  # bounded by its prefix
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = (apart.join(lists, "h").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
             .join(texts.select("node", "text").join(own_lists, "node"), "node")
             .select("h", "own", "node", "component", "hs", "text", other.alias("other"))
             .withColumns({"b1": F.least("own", "other"), "b2": F.greatest("own", "other")}))

    def links_of(t: pa.Table) -> pa.Table:
        h, b1, b2 = (t.column(c)[0].as_py() for c in ("h", "b1", "b2"))
        own, node, part, lists = (t.column(c).to_pylist() for c in ("own", "node", "component", "hs"))
        earlier = [frozenset(x for x in hs if x < h) for hs in lists]
        size: list[int | None] = [None] * len(own)
        sets: list = [None] * len(own)
        texts = t.select(["text"]).combine_chunks().to_batches()[0]

        def load(i):
            sets[i] = next(_sets(texts.slice(i, 1), 0, words))
            size[i] = len(sets[i])

        left = [i for i in range(len(own)) if own[i] == b1]
        right = [i for i in range(len(own)) if own[i] == b2]
        found, root = [], {c: c for c in part}

        def top_of(c):
            while root[c] != c:
                c = root[c]
            return c

        for i in left:
            for j in right:
                if (b1 < b2 or i < j) and top_of(part[i]) != top_of(part[j]) and earlier[i].isdisjoint(earlier[j]):
                    for k in (i, j):
                        if sets[k] is None:
                            load(k)
                    if (measure.smallest(max(size[i], size[j])) <= min(size[i], size[j])
                            and measure.common(sets[i], sets[j]) >= measure.overlap(size[i], size[j])):
                        found.append((node[i], node[j]))
                        root[top_of(part[i])] = top_of(part[j])
        return pa.table({"u": pa.array([f[0] for f in found], pa.int64()), "v": pa.array([f[1] for f in found], pa.int64())})

    new = materialize(dealt.groupBy("h", "b1", "b2").applyInArrow(links_of, "u long, v long"), "jaccard-links")
    if not new.isEmpty():
        found = components(links.unionByName(new))

    placed = rows.join(found, "node", "left").withColumn(
        "class", F.coalesce("component", "node"))
    names = placed.where("class is not null").groupBy("class").agg(F.min("id").alias("name"))
    return placed.join(names, "class", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.coalesce("name", "id").alias("component_id"))


def _widest(shared: DataFrame) -> DataFrame:
    """Without lists whose members all stand together in one larger list: there
    every member's largest list is that one."""
    sizes = shared.groupBy("h").agg(F.count(F.lit(1)).alias("m"))
    sized = shared.join(sizes, "h")
    widest = sized.groupBy("node").agg(F.max(F.struct("m", "h"))["h"].alias("widest"))
    needed = (sized.join(widest, "node").groupBy("h").agg(F.min("widest").alias("a"), F.max("widest").alias("b"))
              .where("a <> b or a = h").select("h"))
    return shared.join(needed, "h")


def _apart(shared: DataFrame, found: DataFrame) -> DataFrame:
    """Members of the lists that hold more than one component, with their component."""
    members = shared.join(found, "node", "left").select(
        "h", "node", "lone", F.coalesce("component", "node").alias("component"))
    mixed = members.groupBy("h").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a < b")
    return members.join(mixed.select("h"), "h")
