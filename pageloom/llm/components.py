"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pageloom.llm.base import written


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for all nodes of `edges` (a, b): the label is the least node of the component.

    Every round a node takes the least label among its neighbours', then the label of its label; each round is written
    to the shared folder. Rounds grow with the logarithm of the longest path, rows with the edges.
    """
    both = written(edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = written(both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("node"), F.least("a", "m").alias("label"), F.lit(True).alias("changed")), "labels")
    while not labels.filter("changed").isEmpty():
        old = labels.select("node", F.col("label").alias("old"))
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        step = old.join(near, F.col("node") == F.col("a")).select("node", "old", F.least("old", "near").alias("label"))
        step = written(step, "labels")
        jump = step.select(F.col("node").alias("label"), F.col("label").alias("further"))
        labels = written(step.join(jump, "label", "left").select(
            "node", F.coalesce("further", "label").alias("label"), (F.coalesce("further", "label") != F.col("old")).alias("changed")), "labels")
    return labels.select("node", "label")
