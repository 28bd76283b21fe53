"""Connected components by label propagation with shortcuts, all in joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.llm.shared import stored


def merge_labels(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """``labels`` (``node``, ``label``, where a label is the least node of its class so far) after the ``edges`` (``a``,
    ``b``) are added. Every round works on the classes that still have edges between them: each takes the least label
    around it, then the label of that label. A class with a third of all edges is one label, so it is grouped, with
    partial sums, and never gathered."""
    ends = edges.join(labels.select(F.col("node").alias("a"), F.col("label").alias("x")), "a").join(
        labels.select(F.col("node").alias("b"), F.col("label").alias("y")), "b"
    )
    links = stored(ends.filter("x != y").select("x", "y").distinct(), "links")
    if links.isEmpty():
        return labels
    # The map from labels to labels is found over the labels alone, then applied to the nodes once.
    both = stored(links.unionByName(links.select(F.col("y").alias("x"), F.col("x").alias("y"))), "both-ways")
    lead = both.groupBy("x").agg(F.min(F.least("x", "y")).alias("to"))
    while True:
        around = (
            both.join(lead.select(F.col("x").alias("y"), F.col("to").alias("seen")), "y")
            .groupBy("x")
            .agg(F.min("seen").alias("seen"))
        )
        near = lead.join(around, "x").select("x", F.least("to", "seen").alias("next"), "to")
        jump = near.select(F.col("x").alias("next"), F.col("next").alias("further"))
        moved = near.join(jump, "next", "left").select(
            "x", F.least("next", F.coalesce("further", "next")).alias("to"), F.col("to").alias("before")
        )
        moved = stored(moved, "moved-labels")
        lead = moved.select("x", "to")
        if moved.filter("to != before").isEmpty():
            break
    out = labels.join(lead.withColumnRenamed("x", "label"), "label", "left")
    return stored(out.select("node", F.coalesce("to", "label").alias("label")), "labels")
