"""Connected components of a link table, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaxmart.llm.common import cut


def components(links: DataFrame) -> DataFrame:
    """(id, label) for every id that has a link; the label is the smallest id reachable.

    Each round takes the smallest label among the neighbours and then the label's own label, so chains halve; a round
    is written and read back.  An id with very many links meets them combined (min) or in a join that can be split.
    """
    both = cut(links.select("a", "b").union(links.select("b", "a")).distinct().toDF("id", "other"), "edges")
    labels = cut(both.groupBy("id").agg(F.least("id", F.min("other")).alias("label")), "labels")
    while True:
        near = both.join(labels.toDF("other", "label"), "other").select("id", "label")
        nearest = near.union(labels).groupBy("id").agg(F.min("label").alias("label"))
        jump = labels.toDF("label", "further")
        nearest = nearest.join(jump, "label", "left").select("id", F.least("label", "further").alias("label"))
        moved = cut(nearest.join(labels.toDF("id", "was"), "id").select("id", "label", "was"), "labels")
        labels = moved.select("id", "label")
        if moved.where(F.col("label") < F.col("was")).isEmpty():
            return labels
