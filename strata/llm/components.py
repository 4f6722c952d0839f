"""Connected components of a graph given as links, by label passing with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``links`` (``a, b``, long); the label is the smallest node.

    Every round takes the smallest label among a node's neighbours, then the label of its
    label, so that chains shorten by half. All steps are joins and grouped minima over
    narrow rows; a node with very many links is combined in the map tasks.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = cut_lineage(both.distinct(), "edges")
    labels = cut_lineage(
        edges.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("label"))
        .select(F.col("a").alias("node"), "label"), "labels")
    while True:
        near = edges.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("seen"))
        hooked = cut_lineage(
            labels.join(near, F.col("node") == F.col("a")).select(
                "node", F.col("label").alias("old"), F.least("label", "seen").alias("label")), "hooked")
        above = hooked.select(F.col("node").alias("parent"), F.col("label").alias("top"))
        moved = cut_lineage(
            hooked.join(above, F.col("label") == F.col("parent")).select(
                "node", "old", F.least("label", "top").alias("label")), "labels")
        if moved.filter("label <> old").isEmpty():
            return moved.select("node", "label")
        labels = moved.select("node", "label")
