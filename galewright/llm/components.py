"""Connected components of an edge table, for the operators that link near-duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galewright.llm.frames import drop_written, materialize


def _checked(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """Write the edges; their number and an order-free digest."""
    saved = materialize(edges, "edges")
    seen = saved.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return saved, tuple(seen)


def _to_least(edges: DataFrame, larger_only: bool) -> DataFrame:
    """One star step: neighbours of a node go to the least of its neighbours and itself.

    ``larger_only``: the large star joins each larger neighbour to that least node; otherwise the
    small star joins a node and its smaller neighbours to the least of them. The least nodes are
    written first: both sides of the join are then plain shuffles, whose hot partitions adaptive
    execution splits.
    """
    if larger_only:
        edges = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = materialize(edges.groupBy("a").agg(F.min("b").alias("least")), "least")
    joined = edges.join(least, "a").withColumn("least", F.least("a", "least"))
    if larger_only:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        out = joined.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            least.select("a", F.col("least").alias("b"))
        )
    return out.where("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of every node with an edge; component is the smallest node reachable.

    ``edges`` has two bigint columns ``a`` and ``b``. Alternating large-star and small-star steps
    (Kiveris and others, 2014) until the edges no longer change; every step is one join written to
    the shared folder, so lineage stays short. NULL ends and loops are no edges.
    """
    ends = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now, seen = _checked(ends.where("a > b").distinct())
    while seen[0]:
        large = materialize(_to_least(now, larger_only=True), "edges")
        after, then = _checked(_to_least(large, larger_only=False))
        drop_written(now, large)
        now, before, seen = after, seen, then
        if before == seen:
            break
    leaves = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return leaves.unionByName(roots)
