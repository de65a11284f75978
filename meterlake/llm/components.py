"""Connected components by Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import stage


def components(edges: DataFrame) -> DataFrame:
    """node and root for every node of ``edges`` (a, b); the root is a component's least node.

    Each round every node takes the least label around it, and then the label of its label,
    so labels travel twice as far each round. Labels are stored between rounds.
    """
    turned = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    both = stage(edges.select("a", "b").unionByName(turned).distinct(), "component_edges")
    labels = stage(
        both.groupBy(F.col("a").alias("node")).agg(
            F.least(F.col("node"), F.min("b")).alias("root")
        ),
        "component_labels",
    )
    while True:
        around = (
            both.join(labels.withColumnsRenamed({"node": "b", "root": "near"}), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("near").alias("near"))
        )
        near = labels.join(around, "node").select(
            "node", "root", F.least("root", "near").alias("new")
        )
        jump = labels.select(F.col("node").alias("new"), F.col("root").alias("far"))
        following = stage(
            near.join(jump, "new").select(
                "node",
                F.least("new", "far").alias("root"),
                (F.least("new", "far") != F.col("root")).alias("changed"),
            ),
            "component_labels",
        )
        labels = following.select("node", "root")
        if following.filter("changed").isEmpty():
            return labels
