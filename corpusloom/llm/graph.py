"""Connected components of a link table, as joins and sums over settled tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links (a, b)``; ``root`` is the smallest node reachable.

    Each round every node hooks to its smallest neighbour, hooks are followed to
    their ends by pointer jumping, and the links are drawn anew between the ends;
    nodes at least halve.  A node with very many links only meets partial minima
    and joins against one row, which Spark can split; nothing is gathered.  Only
    row counts reach the driver.  An empty table gives no rows.
    """
    links = settle(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct(), "links")
    labels = None
    while not links.isEmpty():
        hooks = settle(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
                       .groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
                       .select("node", F.least("node", "near").alias("root")), "hooks")
        while True:
            ahead = hooks.select(F.col("node").alias("root"), F.col("root").alias("next"))
            jumped = settle(hooks.join(ahead, "root", "left").select(
                "node", F.coalesce("next", "root").alias("root"), (F.col("next") < F.col("root")).alias("moved")), "hooks")
            hooks = jumped.select("node", "root")
            if jumped.filter("moved").isEmpty():
                break
        ends = hooks.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        other = hooks.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        links = settle(links.join(ends, "a").join(other, "b")
                       .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).filter("a <> b").distinct(), "links")
        if labels is None:
            labels = hooks
        else:
            step = hooks.select(F.col("node").alias("root"), F.col("root").alias("end"))
            labels = settle(labels.join(step, "root", "left").select("node", F.coalesce("end", "root").alias("root")), "labels")
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels
