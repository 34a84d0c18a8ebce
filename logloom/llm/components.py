"""Connected components of an edge table, by repeated minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.common import saved


def components(edges: DataFrame) -> DataFrame:
    """``id, label`` for every node of ``edges`` (a, b): the smallest id it is linked to.

    Each round takes the smaller label along every edge, then follows labels once. Rounds grow with the logarithm
    of the longest path. Every round is a written table, so nothing is lost with an executor. Minima combine in the
    tasks; both sides of each join are plain tables, so a hub's rows can be split.
    """
    edges = saved(edges.select("a", "b").distinct(), "edges")
    nodes = edges.select(F.col("a").alias("id")).union(edges.select("b")).distinct()
    labels, before = saved(nodes.withColumn("label", F.col("id")), "labels"), None
    while True:
        total = labels.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]
        if total == before:
            return labels
        before = total
        near = edges.join(labels.select(F.col("id").alias("a"), F.col("label").alias("la")), "a")
        near = near.join(labels.select(F.col("id").alias("b"), F.col("label").alias("lb")), "b")
        near = near.select("a", "b", F.least("la", "lb").alias("label"))
        both = near.select(F.col("a").alias("id"), "label").union(near.select("b", "label"))
        step = saved(both.groupBy("id").agg(F.min("label").alias("label")), "labels")
        jump = step.select(F.col("id").alias("label"), F.col("label").alias("next"))
        labels = saved(step.join(jump, "label").select("id", F.col("next").alias("label")), "labels")
