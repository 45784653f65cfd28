"""Connected components of an edge table.

Each round gives every node the smallest node among itself and its neighbours,
follows these pointers as many times more as rounds have passed, and keeps only the
edges between different results.  Stars end in two rounds and a path of n nodes in
about sqrt(2 log n).  Every step is an aggregation with partial sums or a join, and
every round is a table in the shared folder, so a lost executor costs one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passbook.llm.tables import Temporary, stored


def _ordered(a: str, b: str) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, its smallest reachable node, from edges ``a``, ``b``.

    Nodes without an edge to another node are not in the result.
    """
    with Temporary() as temp:
        left = temp(edges.where("a <> b").select(*_ordered("a", "b")).distinct(), "edges")
        labels, jumps = None, 0
        while labels is None or not left.isEmpty():
            both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
            near = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("to"))
            near = temp(near, "pointers")
            for _ in range(jumps):
                far = near.select(F.col("node").alias("to"), F.col("to").alias("next"))
                near = near.join(far, "to").select("node", F.col("next").alias("to"))
            near = temp(near, "pointers") if jumps else near
            from_a = near.select(F.col("node").alias("a"), F.col("to").alias("pa"))
            from_b = near.select(F.col("node").alias("b"), F.col("to").alias("pb"))
            moved = left.join(from_a, "a").join(from_b, "b").where("pa <> pb")
            left = temp(moved.select(*_ordered("pa", "pb")).distinct(), "edges")
            if labels is None:
                labels = near.select("node", F.col("to").alias("component"))
            else:
                step = near.select(F.col("node").alias("component"), "to")
                labels = labels.join(step, "component", "left").select(
                    "node", F.coalesce("to", "component").alias("component")
                )
            jumps += 1
        return stored(labels, "components")
