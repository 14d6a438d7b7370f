"""Connected components of links, by minimum labels and pointer jumping over DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.operators.lineage import cut_lineage


def component_labels(links: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of ``links`` (``a``, ``b``): the least node of its component.

    Each round lowers labels to the least label among the neighbours and then follows the label's
    own label. Minima are combined before their shuffle, so that a hub costs one row per task.
    """
    both = cut_lineage(
        links.select(F.col("a").alias("u"), F.col("b").alias("v"))
        .union(links.select(F.col("b"), F.col("a")))
        .distinct()
    )
    labels = cut_lineage(
        both.groupBy(F.col("u").alias("node")).agg(F.least(F.col("u"), F.min("v")).alias("label"))
    )
    while True:
        near = (
            both.join(labels, both["v"] == labels["node"])
            .groupBy("u")
            .agg(F.min("label").alias("near"))
        )
        lowered = labels.join(near, labels["node"] == near["u"]).select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        lowered = cut_lineage(lowered)
        parents = lowered.select(F.col("node").alias("parent"), F.col("label").alias("higher"))
        following = cut_lineage(
            lowered.join(parents, lowered["label"] == parents["parent"], "left").select(
                "node", "old", F.least("label", F.coalesce("higher", "label")).alias("label")
            )
        )
        labels = following.select("node", "label")
        if following.filter(F.col("old") != F.col("label")).isEmpty():
            return labels
