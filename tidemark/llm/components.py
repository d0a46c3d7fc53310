"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges(a, b)``; the root is the smallest node reachable.

    Each round every node points to its smallest neighbour, pointers are
    followed twice, and edges are contracted to what they point to, so paths
    shorten by a constant factor a round and stars vanish at once. Nothing is
    gathered: a round is a few aggregations with partial sums and joins, and
    its tables are written to the shared folder. Loops and repeated edges do
    no harm; without edges there are no rows. Nodes of any ordered type.
    """
    left = materialise(edges.select("a", "b").where("a <> b").distinct(), "edges")
    labels = None
    while not left.isEmpty():
        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        point = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("to"))
        point = materialise(point.select("node", F.least("node", "to").alias("to")), "hooks")
        for _ in range(2):
            onward = point.select(F.col("node").alias("to"), F.col("to").alias("next"))
            point = point.join(onward, "to", "left").select("node", F.coalesce("next", "to").alias("to"))
        point = materialise(point, "pointers")
        if labels is None:
            labels = point.select("node", F.col("to").alias("root"))
        else:
            onward = point.select(F.col("node").alias("root"), "to")
            labels = labels.join(onward, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
        labels = materialise(labels, "labels")
        a, b = (point.select(F.col("node").alias(x), F.col("to").alias(f"{x}_to")) for x in "ab")
        moved = left.join(a, "a").join(b, "b").where("a_to <> b_to")
        moved = moved.select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b"))
        left = materialise(moved.distinct(), "edges")
    if labels is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels
