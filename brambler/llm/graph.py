"""Connected components by joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


#: Rounds of tie() at most, and the share of its edges that a graph must lose for another one.
TIES, LESS = 4, 0.2


def tie(edges: DataFrame) -> DataFrame:
    """The same components with fewer edges: all smaller neighbours b of a, and a itself, are tied to the smallest one."""
    least = edges.join(edges.groupBy("a").agg(F.min("b").alias("least")), "a")  # no window: a node may have most of the edges
    return least.select("a", F.col("least").alias("b")).union(least.select(F.col("b").alias("a"), F.col("least").alias("b"))).filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for each end of the edges (a, b); component is the smallest node that can be reached.

    Each round a node takes the smallest label among its neighbours' and then that label's own label, so paths halve.
    Every round is written to the shared folder; nothing but a count comes to the driver.
    """
    edges = saved(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    count = edges.count()
    for _ in range(TIES):
        edges, old = saved(tie(edges), "edges"), count
        count = edges.count()
        if count > (1 - LESS) * old:
            break
    links = edges.union(edges.select("b", "a"))
    labels = saved(links.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("label")), "labels")
    while True:
        near = links.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        hooked = saved(labels.join(near.withColumnRenamed("a", "node"), "node").select("node", "label", F.least("label", "near").alias("hook")), "hooks")
        onward = hooked.select(F.col("node").alias("hook"), F.col("hook").alias("onward"))
        labels = saved(hooked.join(onward, "hook").select("node", F.col("onward").alias("label"), (F.col("onward") < F.col("label")).alias("moved")), "labels")
        if labels.filter("moved").limit(1).count() == 0:
            return labels.select("node", F.col("label").alias("component"))
        labels = labels.drop("moved")
