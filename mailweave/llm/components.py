"""Connected components of a table of links, by labels that only ever fall."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailweave.llm.common import removed, written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): the label of a node is the least node of its component.

    Each round gives a node the least label among its own and its neighbours', then the
    label of that label. Both tables of every join are written first, so a label that most
    nodes share is an ordinary skewed join. Nodes without links are not in the result.
    """
    both = links.select(F.col(a).alias("node"), F.col(b).alias("other")).where("node <> other")
    both = written(both.union(both.select("other", "node")).distinct(), "links")
    labels = written(
        both.groupBy("node").agg(F.min("other").alias("least")).select(
            "node", F.least("node", "least").alias("label")
        ),
        "labels",
    )
    while True:
        near = both.join(labels.select(F.col("node").alias("other"), "label"), "other")
        lowest = near.groupBy("node").agg(F.min("label").alias("least"))
        stepped = written(
            labels.join(lowest, "node").select(
                "node", F.col("label").alias("old"), F.least("label", "least").alias("label")
            ),
            "labels",
        )
        up = stepped.select(F.col("node").alias("label"), F.col("label").alias("upper"))
        jumped = written(
            stepped.join(up, "label").select("node", "old", F.col("upper").alias("label")), "labels"
        )
        changed = jumped.where("old <> label").limit(1).count()
        removed(labels, stepped)
        labels = jumped
        if not changed:
            removed(both)
            return labels.select("node", "label")
