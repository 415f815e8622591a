"""Connected components of a graph whose edges are stored as a frame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitledger.llm.frames import stored


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node it is connected with, for all nodes of the
    frame of edges ``a``, ``b``.

    Every round, each node takes the smallest label among its neighbours', and then the
    label of its label, so that the distance to the smallest node halves at least. A node of
    many neighbours is the key of a partial aggregate and of joins that adaptive execution
    can split.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.filter("a != b").distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label")), "labels")
    while True:
        known = labels.select(F.col("node").alias("b"), F.col("label").alias("theirs"))
        nearest = both.join(known, "b").groupBy(F.col("a").alias("node")).agg(F.min("theirs").alias("near"))
        lower = labels.join(nearest, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        lower = stored(lower, "lower")
        above = lower.select(F.col("node").alias("label"), F.col("label").alias("up"))
        jumped = lower.join(above, "label", "left").select(
            "node", "old", F.least("label", F.coalesce("up", "label")).alias("label")
        )
        jumped = stored(jumped, "jumped")
        moved = jumped.filter(F.col("old") != F.col("label")).limit(1).count()
        labels = jumped.select("node", "label")
        if not moved:
            return labels
