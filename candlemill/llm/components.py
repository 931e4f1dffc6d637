"""Connected components of an edge table, by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill.llm.common import settled


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of ``edges`` (a, b): the smallest node it can reach.

    Each round takes the least label among the neighbours, then the label's own label, so
    the number of rounds grows with the logarithm of the longest path. Only integers are
    shuffled, and a node with very many neighbours is reduced before the exchange.
    """
    both = edges.filter("a <> b").select("a", "b").distinct()
    both = settled(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "cc-edges")
    labels = settled(both.groupBy("a").agg(F.min("b").alias("b")).select(
        F.col("a").alias("node"), F.least("a", "b").alias("label")), "cc-labels")
    while True:
        seen = (
            both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        least = labels.join(seen, "node").select("node", "label", F.least("label", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("far"))
        moved = settled(
            least.join(jump, "next", "left").select(
                "node", F.least("next", "far").alias("label"), (F.least("next", "far") < F.col("label")).alias("moved")
            ),
            "cc-labels",
        )
        labels = moved.select("node", "label")
        if not moved.filter("moved").limit(1).count():
            return labels
