"""Connected components of a distributed edge list by union-find contraction.

Each round points every node at its smallest neighbour (parents), flattens the
resulting trees by pointer jumping (path compression), and replaces the edges
by those between different roots. Edges and labels stay in Spark; every round
is written to the shared folder, so that a lost executor costs one round. A
hub with many edges is only ever the subject of partial minima and of plain
equi-joins, which AQE splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.llm.common import save


def _flatten(parents: DataFrame) -> DataFrame:
    """Parents -> roots: replace each parent by its own parent until nothing changes."""
    while True:
        up = parents.select(F.col("node").alias("root"), F.col("root").alias("top"))
        parents = save(
            parents.join(up, "root").select("node", F.col("top").alias("root"), (F.col("top") != F.col("root")).alias("moved")),
            "cc-jump",
        )
        if parents.filter("moved").isEmpty():
            return parents.select("node", "root")
        parents = parents.select("node", "root")


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has an edge.

    Self loops and repeated edges are allowed; an empty edge list gives an empty result.
    """
    a, b = F.col(src), F.col(dst)
    live = save(
        edges.filter(a != b).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct(), "cc-edges")
    labels = None
    while True:
        both = live.select(F.col("hi").alias("node"), F.col("lo").alias("other")).unionByName(
            live.select(F.col("lo").alias("node"), F.col("hi").alias("other")))
        parents = save(both.groupBy("node").agg(F.least("node", F.min("other")).alias("root")), "cc-parents")
        roots = _flatten(parents)
        if labels is None:
            labels = roots.withColumnRenamed("root", "component")
        else:
            moved = roots.select(F.col("node").alias("component"), F.col("root"))
            labels = save(
                labels.join(moved, "component", "left").select(
                    "node", F.coalesce("root", "component").alias("component")),
                "cc-labels",
            )
        hi = roots.select(F.col("node").alias("hi"), F.col("root").alias("rh"))
        lo = roots.select(F.col("node").alias("lo"), F.col("root").alias("rl"))
        live = save(
            live.join(hi, "hi").join(lo, "lo").filter("rh != rl")
            .select(F.greatest("rh", "rl").alias("hi"), F.least("rh", "rl").alias("lo")).distinct(),
            "cc-edges",
        )
        if live.isEmpty():
            return labels
