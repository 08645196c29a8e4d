"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import materialise, release


def contract(edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """``edges``: ``u, v`` of one orderable type. Returns edges ``u > v`` with
    the same components: a star around each component's smallest node, or
    what ``rounds`` rounds make of it.

    Each round lets every node point its larger neighbours at its smallest
    neighbour (large star), then its smaller ones and itself (small star).
    All steps are pre-aggregated minima and equi-joins, so a hub's edges are
    spread over tasks; each round is written to the checkpoint folder."""
    e = (edges.where(F.col("u") != F.col("v"))
         .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    e = materialise(e, "components")
    mark, done = None, 0
    while done != rounds:
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == mark or not now[0]:
            break
        mark, done = now, done + 1
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where(F.col("u") != F.col("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = (small.select("u", F.col("m").alias("v"))
                 .unionByName(small.select(F.col("v").alias("u"), F.col("m").alias("v")))
                 .where(F.col("u") != F.col("v")).distinct())
        before, e = e, materialise(small, "components")
        release(before)
    return e


def labels(contracted: DataFrame) -> DataFrame:
    """``node, root`` of every node of contracted edges: the smallest node it
    points at, or itself."""
    children = contracted.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    tops = contracted.select(F.col("v").alias("node")).distinct().join(children, "node", "left_anti")
    return children.unionByName(tops.select("node", F.col("node").alias("root")))


def connected_components(edges: DataFrame) -> DataFrame:
    """Returns ``node, root`` for every node with an edge to another one;
    ``root`` is the smallest node of the component."""
    e = contract(edges)
    children = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return children.unionByName(children.select(F.col("root").alias("node"), "root").distinct())
