"""Connected components by alternating large-star and small-star steps.

Every step is a group-by minimum and one equi-join, so no neighbourhood is ever
gathered in a task: a hub's edges are many rows of a join that adaptive
execution can split. Rounds grow with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from loomery.llm.store import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Map each node of ``edges`` to the smallest node it can reach.

    ``a`` and ``b`` are bigint columns; nulls and self-loops are ignored, order
    and repeats don't matter. Returns (node, root), nodes without edges absent.
    An empty edge table gives an empty result.
    """
    pairs = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    # u > v holds from here on
    now = written(pairs.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    before = None
    while True:
        now = written(_small_star(_large_star(now)), "star")
        # a star forest is a fixed point; a sum of hashes tells two edge sets apart
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            break
        before = tuple(state)
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
