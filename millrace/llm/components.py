"""Connected components of a graph of links, as smallest labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """node, label (smallest node it reaches) of links (a, b); nodes without a link are not in it.

    Each round takes the smallest label of a node's neighbours, aggregated before the shuffle, then
    follows labels once, so chains shorten by halves. Rounds end when no label changes.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = written(both.where("a != b").distinct(), "links")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("label").alias("near")
        )
        lower = labels.join(near, "node").select(
            "node", F.least("label", "near").alias("label"), F.col("label").alias("old")
        )
        hop = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        after = written(lower.join(hop, "label", "left").select(
            "node", F.least("label", F.coalesce("further", "label")).alias("label"), "old"
        ), "labels")
        labels = after.select("node", "label")
        if after.where("label != old").isEmpty():
            return labels
