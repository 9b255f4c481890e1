"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmill.operators.materialize import computed_once


def connected_components(edges: DataFrame) -> DataFrame:
    """node, label: the smallest node of its component, for all nodes of (a, b).

    Each round every node takes the smallest label of its neighbours, then the label of
    its label, until nothing changes. A round is one aggregate and two joins, written to
    the shared folder, so no lineage grows and nothing is gathered anywhere.
    """
    links = computed_once(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a != b").distinct()
    )
    labels = computed_once(links.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")))
    while True:
        seen = links.join(labels, F.col("b") == F.col("node")).groupBy(F.col("a").alias("_node")).agg(F.min("label").alias("_best"))
        better = labels.join(seen, F.col("node") == F.col("_node")).select(
            "node", F.least("label", "_best").alias("label"), F.col("label").alias("before")
        )
        better = computed_once(better)
        jump = better.select(F.col("node").alias("_at"), F.col("label").alias("_next"))
        jumped = better.join(jump, F.col("label") == F.col("_at")).select("node", F.col("_next").alias("label"), "before")
        moved = computed_once(jumped)
        labels = moved.select("node", "label")
        if moved.where("label != before").isEmpty():
            return labels
