"""Connected components of a table of links, by hooking and pointer jumping. Nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.llm.tasks import written


def components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node that can be reached) for every node of `links` (a, b).

    Each round hooks every node to its smallest neighbour, follows the hooks to their roots and contracts the links to
    links between roots. Rounds and jumps grow with the logarithm of the longest path. Smallest neighbours are combined
    before the shuffle, and tables are written between steps, so a node with very many links is split by skew joins.
    """
    links = written(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), "links")
    labels = links.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("component", F.col("node"))
    while not links.isEmpty():
        hooks = roots(written(
            links.select(F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("node", "next"))
            .groupBy("node").agg(F.min("next").alias("next")).select("node", F.least("node", "next").alias("next")), "hooks"))
        ends = hooks.select(F.col("node").alias("component"), F.col("next").alias("root"))
        labels = written(labels.join(ends, "component", "left").select("node", F.coalesce("root", "component").alias("component")), "labels")
        left, right = (hooks.select(F.col("node").alias(n), F.col("next").alias(f"{n}_root")) for n in "ab")
        links = written(
            links.join(left, "a").join(right, "b").filter("a_root <> b_root")
            .select(F.least("a_root", "b_root").alias("a"), F.greatest("a_root", "b_root").alias("b")).distinct(), "links")
    return labels


def roots(hooks: DataFrame) -> DataFrame:
    """node, next with every hook followed to its end; doubles the reach of each hook per step."""
    while True:
        further = hooks.select(F.col("node").alias("next"), F.col("next").alias("after"))
        hooks = written(hooks.join(further, "next").select(
            "node", F.col("after").alias("next"), (F.col("after") != F.col("next")).alias("moved")), "roots")
        if hooks.filter("moved").isEmpty():
            return hooks.select("node", "next")
