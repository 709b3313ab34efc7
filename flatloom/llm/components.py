"""Connected components of a graph of any size, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flatloom.scratch import written

_MAX_ROUNDS = 100


# The smallest neighbours are written before they are joined back: both sides of the join then
# come straight from a shuffle, and the rows of a node with very many links can be split.
def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = written(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")), "least")
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = written(down.groupBy("a").agg(F.min("b").alias("m")), "least")
    moved = down.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b), two columns of one ordered type.

    ``root`` is the smallest node that can be reached. Links go either way; repeated links and
    loops change nothing, and a link with a null end is no link. Each round is two aggregations
    with partial steps and two joins against one row per node, written so that lost executors
    cost one step; the number of rounds grows with the logarithm of the number of nodes.
    """
    edges = edges.select("a", "b").filter("a is not null and b is not null")
    loops = edges.filter("a = b").select(F.col("a").alias("node"), F.col("a").alias("root"))
    now = written(edges.filter("a != b").distinct(), "links")
    before = None
    for _ in range(_MAX_ROUNDS):
        state = now.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("x")).first()
        if state["n"] == 0 or state == before:
            break
        before = state
        now = written(_large_star(now).distinct(), "links")
        now = written(_small_star(now).distinct(), "links")
    else:
        raise RuntimeError(f"the components have not settled after {_MAX_ROUNDS} rounds")
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root"))
    found = stars.unionByName(roots).unionByName(loops)
    return found.groupBy("node").agg(F.min("root").alias("root"))
