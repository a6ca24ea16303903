"""Connected components of a link table, by least labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of `links` (a, b): the least node it can reach.

    Each round gives a node the least label among its neighbours' and then the label
    of that label, so paths shorten by half.  Rounds are written to the shared folder;
    the driver sees one count a round.
    """
    both = stored(
        links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), "links"
    )
    labels = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        seen = both.join(labels.withColumnsRenamed({"node": "b"}), "b").groupBy("a").agg(F.min("label").alias("near"))
        lower = labels.join(seen.withColumnRenamed("a", "node"), "node").select(
            "node", "label", F.least("label", "near").alias("next")
        )
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("far"))
        moved = lower.join(jump, "next").select("node", F.least("next", "far").alias("new"), "label")
        moved = stored(moved, "labels")
        changed = moved.where("new <> label").limit(1).count()
        labels = moved.select("node", F.col("new").alias("label"))
        if not changed:
            return labels
