"""Connected components of a link table, by contraction."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverline.llm.common import cut


def components(links: DataFrame, keep: Callable[[DataFrame], DataFrame] = cut) -> DataFrame:
    """(node, root) for every node of the links (a, b); the root is the smallest node of its component.

    Each round points every node at its smallest neighbour, jumps pointers to the roots of the trees
    that this gives, and replaces nodes by roots. A tree has two nodes at least, so rounds are at most
    the logarithm of the nodes. A hub is one row of an aggregate with partial sums, and the many-sided
    part of each join, which Spark can split. `keep` stores what a round made.
    """
    edges = keep(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    found = None
    while not edges.isEmpty():
        ends = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
            edges.select(F.col("b").alias("node"), F.col("a").alias("other"))
        )
        parents = keep(ends.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("parent")))
        while True:
            # Two jumps a pass: trees of depth four are flat after the first.
            above = parents.select(F.col("node").alias("parent"), F.col("parent").alias("over"))
            twice = above.join(above.select(F.col("parent").alias("over"), F.col("over").alias("top")), "over").select("parent", "over", "top")
            jumped = keep(parents.join(twice, "parent").select("node", F.col("top").alias("parent"), (F.col("top") != F.col("over")).alias("moved")))
            parents = jumped.select("node", "parent")
            if jumped.filter("moved").isEmpty():
                break
        if found is None:
            found = parents
        else:
            onward = parents.select(F.col("node").alias("parent"), F.col("parent").alias("next"))
            found = keep(found.join(onward, "parent", "left").select("node", F.coalesce("next", "parent").alias("parent")))
        left = parents.select(F.col("node").alias("a"), F.col("parent").alias("ra"))
        right = parents.select(F.col("node").alias("b"), F.col("parent").alias("rb"))
        joined = edges.join(left, "a").join(right, "b").filter("ra <> rb")
        edges = keep(joined.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct())
    if found is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return found.select("node", F.col("parent").alias("root"))
