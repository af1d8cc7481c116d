"""Operator 3: approximate nearest neighbours on robust-pruned directed graphs.

Rows are dealt to shards by a hash of their id. Each shard builds one graph: a
greedy beam search from the medoid proposes neighbours of a new node, and robust
pruning keeps a candidate only if no kept one is closer to it by the factor
``alpha``, which leaves long, diverse edges. The index (vectors and neighbour
lists) is a table in the shared folder. Queries go to every shard in blocks,
search it with a beam, and the best of all shards are merged. Equal vectors of a
shard are one node with a list of distinct ids, so a vector that a third of the
rows repeat neither floods the beam nor hides its copies. A query whose beam
holds fewer than ``k`` other ids, as when one id has many near vectors, is
searched again with a beam twice as wide.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, pick

SHARD_ROWS = 8192    # rows per graph, about
BLOCK_QUERIES = 4096  # queries that one task holds at a time
DEGREE = 32          # edges kept per node by pruning
SLACK = 48           # edges a node may gather before it is pruned again
BUILD_BEAM = 64
SEARCH_BEAM = 128
ALPHA = 1.2


def usable(v: Column) -> Column:
    """Vectors that take part: not null, not empty, all components finite, not all zero."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce((F.size(v) > 0) & ~F.exists(v, bad) & F.exists(v, lambda x: x != 0), F.lit(False))


def beam_search(x: np.ndarray, graph: np.ndarray, entry: int, queries: np.ndarray, width: int
                ) -> tuple[np.ndarray, np.ndarray]:
    """Beams (nodes, squared distances), nearest first, of several queries at
    once; empty places hold node -1 at infinite distance."""
    n, q = len(x), np.arange(len(queries))
    seen = np.zeros((len(queries), n + 1), bool)
    seen[:, [entry, n]] = True
    nodes = np.full((len(queries), width), -1, np.int64)
    dist = np.full((len(queries), width), np.inf, np.float32)
    nodes[:, 0], dist[:, 0] = entry, ((queries - x[entry]) ** 2).sum(axis=1)
    done = nodes < 0
    while True:
        open_dist = np.where(done, np.inf, dist)
        at = open_dist.argmin(axis=1)
        live = np.flatnonzero(np.isfinite(open_dist[q, at]))
        if not len(live):
            return nodes, dist
        done[live, at[live]] = True
        near = graph[nodes[live, at[live]]]
        near = np.where(seen[live[:, None], near], n, near)
        seen[live[:, None], near] = True
        rows, places = np.nonzero(near < n)
        found = near[rows, places]
        d = np.full(near.shape, np.inf, np.float32)
        delta = x[found] - queries[live[rows]]
        d[rows, places] = np.einsum("ij,ij->i", delta, delta)
        all_d = np.concatenate([dist[live], d], axis=1)
        keep = np.argsort(all_d, axis=1, kind="stable")[:, :width]
        take = lambda a, b: np.take_along_axis(np.concatenate([a, b], axis=1), keep, axis=1)
        nodes[live] = take(nodes[live], np.where(near < n, near, -1))
        done[live] = take(done[live], near >= n)
        dist[live] = np.take_along_axis(all_d, keep, axis=1)


def robust_prune(x: np.ndarray, node: int, candidates: np.ndarray, alpha: float, degree: int) -> np.ndarray:
    """Diverse neighbours, nearest first."""
    c = np.unique(candidates[(candidates >= 0) & (candidates != node) & (candidates < len(x))])
    if not len(c):
        return c
    d = ((x[c] - x[node]) ** 2).sum(axis=1)
    by = np.argsort(d, kind="stable")
    c, d = c[by], d[by]
    v = x[c]
    sq = (v ** 2).sum(axis=1)
    between = sq[:, None] + sq[None, :] - 2 * (v @ v.T)
    alive, kept = np.ones(len(c), bool), []
    for i in range(len(c)):
        if alive[i]:
            kept.append(i)
            if len(kept) == degree:
                break
            alive &= alpha * alpha * between[i] > d
    return c[kept]


def build_graph(x: np.ndarray, alpha: float = ALPHA, degree: int = DEGREE, slack: int = SLACK,
                beam: int = BUILD_BEAM) -> tuple[np.ndarray, int]:
    """(neighbour matrix padded with n, entry node) of distinct vectors."""
    n = len(x)
    graph = np.full((n + 1, slack), n, np.int64)
    size = np.zeros(n + 1, np.int64)
    entry = int(((x - x.mean(axis=0)) ** 2).sum(axis=1).argmin())
    order = np.random.default_rng(7).permutation(n)
    order = np.concatenate([[entry], order[order != entry]])
    at, batch = 1, 1
    while at < n:
        new = order[at:at + batch]
        found, _ = beam_search(x, graph, entry, x[new], beam)
        back: dict[int, list[int]] = {}
        for node, near in zip(new, found):
            kept = robust_prune(x, node, np.concatenate([near, new if batch > 1 else near]), alpha, degree)
            graph[node] = n
            graph[node, :len(kept)] = kept
            size[node] = len(kept)
            for k in kept:
                back.setdefault(int(k), []).append(int(node))
        for node, more in back.items():
            fresh = np.setdiff1d(np.array(more), graph[node, :size[node]])
            joined = np.concatenate([graph[node, :size[node]], fresh])
            if len(joined) > slack:
                joined = robust_prune(x, node, joined, alpha, degree)
            graph[node] = n
            graph[node, :len(joined)] = joined
            size[node] = len(joined)
        at += len(new)
        batch = min(2 * batch, 128)
    return graph, entry


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def build_index(rows: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Index table of (id long, v array): one row per node with ``dim``, ``shard``, ``node``,
    ``ids`` (ascending), ``v``, ``near`` (neighbour nodes) and ``entry``. Every row is indexed."""
    # Repeats of a row go before the shuffle, so that they neither fill a shard nor a node.
    rows = rows.dropDuplicates(["id", "v"])
    n = rows.count()
    shards = max(1, -(-n // shard_rows))

    def graph_of(t: pa.Table) -> pa.Table:
        raw, ids = _matrix(t.column("v")), t.column("id").to_numpy()
        order = np.lexsort((ids, ))
        raw, ids = np.ascontiguousarray(raw[order]), ids[order]
        # One node per distinct vector.
        plain = raw + 0.0  # -0.0 becomes 0.0
        keys = plain.view(np.dtype((np.void, plain.dtype.itemsize * plain.shape[1]))).ravel()
        _, first, of = np.unique(keys, return_index=True, return_inverse=True)
        x = plain[first].astype(np.float32)
        graph, entry = build_graph(x)
        held = np.argsort(of, kind="stable")
        groups = np.split(ids[held], np.cumsum(np.bincount(of))[:-1])
        k = len(x)
        return pa.table({
            "dim": pa.array([raw.shape[1]] * k, pa.int32()), "shard": pa.array([t.column("shard")[0].as_py()] * k, pa.int32()),
            "node": pa.array(range(k), pa.int32()), "ids": pa.array([np.unique(g).tolist() for g in groups], pa.list_(pa.int64())),
            "v": pa.array(list(plain[first].astype(np.float64)), pa.list_(pa.float64())),
            "near": pa.array([g[g < k].tolist() for g in graph[:k]], pa.list_(pa.int32())),
            "entry": pa.array([i == entry for i in range(k)], pa.bool_())})

    dealt = rows.select("id", "v", F.size("v").alias("dim"),
                        F.pmod(F.xxhash64("id", F.xxhash64("v")), F.lit(shards)).cast("int").alias("shard"))
    return dealt.groupBy("dim", "shard").applyInArrow(
        graph_of, "dim int, shard int, node int, ids array<long>, v array<double>, near array<int>, entry boolean")


def nearest(rows: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id",
            vector_col: str = "embedding", shard_rows: int = SHARD_ROWS, beam: int = SEARCH_BEAM) -> DataFrame:
    """Each query's ``k`` nearest rows found: ``query_id``, ``rank`` (from 1), the
    row's id, ``score`` (Euclidean distance in double precision).

    A query never finds rows with its own id; an id that several rows repeat
    appears once, with its nearest row. Vectors that are null, empty, zero or hold
    null or non-finite components take no part, nor do rows with a null id; only
    vectors of a query's own length are compared with it. Ties go to the smaller
    id. An empty table gives an empty result. Other columns are not read.
    """
    src = pick(rows, {"id": id_col, "v": vector_col}).where(F.col("id").isNotNull() & usable(F.col("v")))
    ask = pick(queries, {"id": id_col, "v": vector_col}).where(F.col("id").isNotNull() & usable(F.col("v")))
    index = materialize(build_index(src, shard_rows), "vector-index")
    blocks = max(1, -(-ask.count() // BLOCK_QUERIES))
    shards = index.groupBy(F.col("dim").alias("q_dim"), F.col("shard").alias("q_shard")).agg(F.max("node"))
    asked = (ask.dropDuplicates(["id", "v"])
             .select(F.size("v").alias("q_dim"), F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("q_block"),
                     "id", F.transform("v", lambda e: e.cast("double")).alias("q"))
             .join(shards, "q_dim"))
    spread = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    wanted = k

    def search(graph_rows: pa.Table, query_rows: pa.Table) -> pa.Table:
        out = {"query_id": [], "found": [], "score": []}
        if graph_rows.num_rows and query_rows.num_rows:
            graph_rows = graph_rows.sort_by("node")
            exact = _matrix(graph_rows.column("v"))
            x = exact.astype(np.float32)
            n = len(x)
            near = graph_rows.column("near").to_pylist()
            graph = np.full((n + 1, max(1, max(map(len, near)))), n, np.int64)
            for i, e in enumerate(near):
                graph[i, :len(e)] = e
            entry = graph_rows.column("entry").to_pylist().index(True)
            ids = graph_rows.column("ids").to_pylist()
            q, qid = _matrix(query_rows.column("q")), query_rows.column("id").to_pylist()
            open_queries, width = np.arange(len(q)), max(beam, wanted + 1)
            while len(open_queries):
                short = []
                for a in range(0, len(open_queries), 256):
                    part = open_queries[a:a + 256]
                    found, _ = beam_search(x, graph, entry, q[part].astype(np.float32), width)
                    for at, nodes in zip(part.tolist(), found):
                        own, nodes = qid[at], nodes[nodes >= 0]
                        score = np.sqrt(((exact[nodes] - q[at]) ** 2).sum(axis=1))
                        best: dict[int, float] = {}
                        for s, node in zip(score.tolist(), nodes.tolist()):
                            for i in ids[node][:wanted + 1]:
                                if i != own and s < best.get(i, np.inf):
                                    best[i] = s
                        # A full beam that holds too few ids may hide others.
                        if len(best) < wanted and len(nodes) == width < n:
                            short.append(at)
                            continue
                        for i, s in sorted(best.items(), key=lambda hit: (hit[1], hit[0]))[:wanted]:
                            out["query_id"].append(own)
                            out["found"].append(i)
                            out["score"].append(s)
                open_queries, width = np.array(short, np.int64), 2 * width
        return pa.table({"query_id": pa.array(out["query_id"], pa.int64()), "found": pa.array(out["found"], pa.int64()),
                         "score": pa.array(out["score"], pa.float64())})

    near_rows = (spread.groupBy("dim", "shard", "block").cogroup(asked.groupBy("q_dim", "q_shard", "q_block"))
                 .applyInArrow(search, "query_id long, found long, score double"))
    best = near_rows.groupBy("query_id", "found").agg(F.min("score").alias("score"))
    place = Window.partitionBy("query_id").orderBy("score", "found")
    return (best.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
            .select("query_id", "rank", F.col("found").alias(id_col), "score"))
