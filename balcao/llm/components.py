"""Connected components of an undirected graph, label by label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from balcao.sources.scratch import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edges (a, b); the component is its smallest node.

    Each round gives a node the smallest label among its own and its neighbours',
    then the label of that label, so long chains halve. Labels are written after each
    round; the loop ends when none changed. No edges give no rows.
    """
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("beside"))
    both = stage(both.unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("beside"))), "arestas")
    labels = stage(both.groupBy("node").agg(F.least(F.col("node"), F.min("beside")).alias("component")), "rotulos")
    while True:
        near = labels.select(F.col("node").alias("beside"), F.col("component").alias("offered"))
        offers = both.join(near, "beside").groupBy("node").agg(F.min("offered").alias("offered"))
        hooked = labels.join(offers, "node").select(
            "node", F.col("component").alias("was"), F.least("component", "offered").alias("up")
        )
        above = labels.select(F.col("node").alias("up"), F.col("component").alias("further"))
        moved = stage(
            hooked.join(above, "up").select("node", F.least("up", "further").alias("component"), "was"), "rotulos"
        )
        labels = moved.drop("was")
        if moved.filter(F.col("component") != F.col("was")).isEmpty():
            return labels
