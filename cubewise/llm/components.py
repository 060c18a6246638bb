"""Connected components of a graph given by its links, as Spark joins.

Large-star and small-star rounds (Kiveris et al., 2014) alternate until no link
changes; each round's links are written to the shared folder, so lineage stays
short and lost executors cost one round at most. Hubs are harmless: a node's
smallest neighbour is a grouped minimum, reduced before the shuffle, and it
comes back by a join that Spark can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubewise.llm.common import stored


def components(links: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, component) for every node of links (a, b), component the smallest
    node reachable. Self-links and repeated links do no harm; no links, no rows."""
    edges = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .where("a <> b").distinct(), "links")
    before = None
    for _ in range(max_rounds):
        edges = stored(small_star(large_star(edges)), "links")
        # Order-free digest of the links: unchanged when a round changed nothing.
        now = edges.agg(F.count("*").alias("n"),
                        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("digest")).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots).distinct()


def large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (both.join(smallest, "a").where("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())


def small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    smallest = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = smallest.select("a", F.col("m").alias("b"))
    return moved.union(own).where("a <> b").distinct()
