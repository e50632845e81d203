"""Connected components of an undirected graph given as rows, in a logarithmic number of joins in practice."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.llm.steps import Scratch


def components(scratch: Scratch, name: str, links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component``, the smallest node it reaches, for every node that has a link.

    Each round takes the least label among a node's neighbours and then the label of that
    label, so distances halve. A node's neighbours are reduced by a combining minimum, never
    collected; the joins are on single keys and Spark splits those of a hub. ``links`` should be
    a stored table: it is read again in every round.
    """
    links = links.select(F.col(a).alias("node"), F.col(b).alias("next"))
    both = links.unionByName(links.select(F.col("next").alias("node"), F.col("node").alias("next")))
    labels = both.groupBy("node").agg(F.min("next").alias("near"))
    labels = scratch.freeze(labels.select("node", F.least("node", "near").alias("component")), f"{name}-0")
    turn = 0
    while True:
        turn += 1
        reached = both.join(labels.select(F.col("node").alias("next"), "component"), "next")
        reached = reached.groupBy("node").agg(F.min("component").alias("least"))
        nearer = labels.join(reached, "node").select(
            "node", F.least("component", "least").alias("component"), F.col("component").alias("was")
        )
        jump = nearer.select(F.col("node").alias("component"), F.col("component").alias("further"))
        jumped = nearer.join(jump, "component").select("node", F.col("further").alias("component"), "was")
        jumped = scratch.freeze(jumped, f"{name}-{turn}")
        scratch.drop(f"{name}-{turn - 1}")
        labels = jumped.select("node", "component")
        if jumped.where("component <> was").isEmpty():
            return labels
