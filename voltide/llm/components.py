"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltide.session import discard, materialize


def _least(pairs: DataFrame) -> DataFrame:
    """The least of each node and its neighbours; written, so that a join with
    it gets shuffles of its own, whose hot keys Spark can split."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return materialize(least, "least-neighbours")


def connected_components(edges: DataFrame, left: str = "u", right: str = "v") -> DataFrame:
    """``node`` and ``component`` (the least node it reaches) for every node of
    an edge table; nulls and loops are no edges.

    Each round writes its edges to the shared folder, so no lineage grows. Sums
    run before the shuffle and the joins are plain sort-merge joins whose hot
    keys Spark splits: a node with very many neighbours is no single task."""
    e = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).where("u <> v")
    e = materialize(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = None
    while True:
        both = e.union(e.select("v", "u"))
        near = _least(both)
        large = both.join(near, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.where("u <> v").distinct(), "large-star")
        least = _least(large)
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(least.select("u", F.col("m").alias("v"))).where("u <> v")
        before, e = e, materialize(small.distinct(), "small-star")
        discard(before, near, large, least)
        now = tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first())
        if now == state:
            break
        state = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
