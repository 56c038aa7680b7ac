"""Connected components of a link table, by alternating large-star and small-star steps.

Each step only ever groups by node and joins back, so links, components and
labels stay distributed; a node that holds many links is a skewed join key,
which adaptive execution splits. Each round is checkpointed into the shared
folder, so a lost executor costs one round at most. The number of rounds
grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concord.llm.store import cut


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``; component = its smallest node.

    Null ends and self links are ignored, repeated links count once; no links
    give no rows.
    """
    edges = (
        links.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    edges = cut(edges)
    state = _state(edges)
    while state[0]:
        # large star: every larger neighbour of u moves to u's smallest neighbour
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        low = low.select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # small star: u and its smaller neighbours move to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut(moved.union(least.select("u", F.col("m").alias("v"))).distinct())
        if (now := _state(edges)) == state:
            break
        state = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
