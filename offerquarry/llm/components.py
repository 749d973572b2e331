"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerquarry.sources.shared import drop_stored, write_and_read


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for all ends of ``links`` (``a``, ``b``, whole numbers).

    A component is named by its smallest node.  Each round hooks every node onto its
    smallest neighbour, jumps two steps up, and goes on with the links between what
    is left; a star of any size takes one round.  Each round is stored, and only the
    number of remaining links comes to the driver.
    """
    spark = links.sparkSession
    links = write_and_read(links.where("a <> b").select("a", "b").distinct(), "links")
    both = links.select("a").union(links.select("b"))
    labels = both.distinct().select(F.col("a").alias("node"), F.col("a").alias("component"))
    labels = write_and_read(labels, "labels")
    while not links.isEmpty():
        ends = links.union(links.select("b", "a"))
        hooks = ends.groupBy("a").agg(F.min("b").alias("least"))
        hooks = hooks.select(F.col("a").alias("old"), F.least("a", "least").alias("up"))
        hooks = write_and_read(hooks, "hooks")
        above = hooks.select(F.col("old").alias("up"), F.col("up").alias("new"))
        jumps = write_and_read(hooks.join(above, "up").select("old", "new"), "jumps")

        def renamed(name: str) -> DataFrame:
            return jumps.select(F.col("old").alias(name), F.col("new").alias(f"new_{name}"))

        rest = links.join(renamed("a"), "a").join(renamed("b"), "b")
        rest = rest.where("new_a <> new_b").select(
            F.least("new_a", "new_b").alias("a"), F.greatest("new_a", "new_b").alias("b")
        )
        rest = write_and_read(rest.distinct(), "links")
        named = labels.join(renamed("component"), "component", "left").select(
            "node", F.coalesce("new_component", "component").alias("component")
        )
        named = write_and_read(named, "labels")
        drop_stored(spark, links, labels, hooks, jumps)
        links, labels = rest, named
    drop_stored(spark, links)
    return labels
