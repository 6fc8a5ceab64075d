"""Connected components of a link table, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.storage import stored_scratch


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links`` (``a, b``); component is its smallest node.

    A round maps every node to the smallest of itself and its neighbours and keeps the links
    between different images. Images of linked nodes stay connected, and the smallest node of a
    component is always its own image, so the rounds end with one image per component; their
    number grows with the logarithm of a component's diameter. Minima are combined before each
    shuffle, so a node with very many links is no bottleneck. Nothing but the question whether
    links are left comes to the driver. No links give no rows.
    """
    links = links.select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    ).filter("a < b")
    rounds: list[DataFrame] = []
    while True:
        there = F.struct(F.col("a").alias("x"), F.col("b").alias("y"))
        back = F.struct(F.col("b").alias("x"), F.col("a").alias("y"))
        parents = (
            links.select(F.explode(F.array(there, back)).alias("e"))
            .groupBy(F.col("e.x").alias("node"))
            .agg(F.min("e.y").alias("least"))
            .select("node", F.least("node", "least").alias("parent"))
        )
        parents = stored_scratch(parents, "parents")
        rounds.append(parents)
        a = parents.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        b = parents.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        links = stored_scratch(
            links.join(a, "a")
            .join(b, "b")
            .filter("pa <> pb")
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
            .distinct(),
            "links",
        )
        if links.isEmpty():
            break
    labels = rounds.pop().withColumnRenamed("parent", "component")
    while rounds:
        later = labels.select(F.col("node").alias("parent"), "component")
        labels = (
            rounds.pop()
            .join(later, "parent", "left")
            .select("node", F.coalesce("component", "parent").alias("component"))
        )
    return labels
