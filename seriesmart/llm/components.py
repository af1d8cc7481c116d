"""Connected components of an edge table by alternating large-star and small-star
steps: every round is two aggregations and two joins, nothing is collected, and a
node of any degree is only ever reduced to the minimum of its neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(near, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, move to the least of them.
    Edges point from the larger to the smaller node."""
    near = edges.groupBy("u").agg(F.min("v").alias("m"))
    out = (edges.join(near, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
           .unionByName(near.select("u", F.col("m").alias("v"))))
    return out.where("u <> v").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(u, v) links, either way round, repeats and self-links allowed, to
    (node, component): the smallest node reachable. Only linked nodes appear.
    Nulls link nothing."""
    e = materialize(edges.where("u is not null and v is not null and u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        e = materialize(_small_star(_large_star(e)), "edges")
        sign = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if sign == before:
            break
        before = sign
    else:
        raise RuntimeError("components did not settle")
    roots = e.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
