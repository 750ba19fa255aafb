"""Connected components of an edge table, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from tidemark.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``(id, label)``: the smallest id that each end of the edges ``(a, b)`` reaches.

    A round takes the smallest label among neighbours, then the label of the label, so rounds
    grow with the logarithm of a component's width. Both joins are on unique labels.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("id")).alias("label")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("id")).groupBy("a").agg(F.min("label").alias("_near"))
        lower = labels.join(near, F.col("id") == F.col("a"), "left").select(
            "id", F.col("label").alias("_old"), F.least("label", F.coalesce("_near", "label")).alias("_mid")
        )
        over = labels.select(F.col("id").alias("_i"), F.col("label").alias("_over"))
        jumped = lower.join(over, F.col("_mid") == F.col("_i"), "left").select(
            "id", "_old", F.least("_mid", F.coalesce("_over", "_mid")).alias("label")
        )
        seen = Observation()
        new = stored(jumped.observe(seen, F.count_if(F.col("label") < F.col("_old")).alias("fell")), "labels")
        labels = new.select("id", "label")
        if not seen.get["fell"]:
            return labels
