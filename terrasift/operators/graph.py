"""Connected components of an edge table by alternating stars, all in shuffles with partial aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))"), F.expr("bit_xor(xxhash64(b, a, 1))")).first())


def components(edges: DataFrame, partitions: int | None = None, sized: bool = True) -> DataFrame:
    """(node, component) of every node of the edges (a, b); a component is named by its smallest node.

    Each step hangs neighbours on the smallest node around (large star), then flattens (small star), until the edges stay the same.
    The number of steps is logarithmic in the size of a component; a node of any degree is split by the engine's skewed join.
    ``partitions`` bounds the pieces of the edge table between steps, where its size is known to be small; ``sized`` is that of ``checkpointed``.
    """
    few = (lambda df: df.coalesce(partitions)) if partitions else (lambda df: df)
    now = checkpointed(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), partitions, sized)
    mark = _mark(now)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = few(both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionByName(least.select("a", F.col("m").alias("b")))
        now = checkpointed(small.distinct(), partitions, sized)
        new = _mark(now)
        if new == mark:
            break
        mark = new
    return few(now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct())
