"""Connected components of a link table, without holding links in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retourlens.session import settle

MAX_ROUNDS = 60


def connected_components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of ``links`` (a, b), the root being the smallest node it reaches.

    Alternates two steps until nothing changes, which takes about as many rounds
    as the logarithm of the longest chain: each node passes its smallest
    neighbour to its larger neighbours, then to its smaller ones. Minima are
    combined before the shuffle, and joined back, so that a node with a third of
    all links stays splittable. Self links count as none.
    """
    edges = settle(links.select("a", "b").where("a <> b").distinct(), f"{name}-links")
    before = None
    for number in range(MAX_ROUNDS):
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = settle(large.where("a <> b"), f"{name}-large{number}")
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        edges = settle(small.union(least.select("a", F.col("m").alias("b"))).distinct(), f"{name}-small{number}")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % (1 << 40))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
