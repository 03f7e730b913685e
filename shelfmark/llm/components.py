"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import first_of_group, materialize


def _is_star(links: DataFrame) -> bool:
    """Whether every node hangs directly below the smallest of its component: one link up each, and none from a root."""
    if not links.groupBy("a").count().where("count > 1").isEmpty():
        return False
    return links.join(links.select(F.col("a").alias("b")), "b", "left_semi").isEmpty()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every linked node but the smallest of its component, which is ``component``.

    ``links`` holds columns a, b (long); loops, repeats and null ends are ignored. Each round hangs every neighbour below the
    smallest one, first over all neighbours, then over the smaller ones, until only stars are left; rounds grow with the
    logarithm of the longest chain. A hub's neighbours are never in one task, every round is a written table, and nothing but
    the answer to that question reaches the driver. To add links to known components, pass both together.
    """
    links = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while not _is_star(links):
        both = links.union(links.select("b", "a"))
        large = first_of_group(both, "a", "b").where("b > a").select(F.col("b").alias("a"), F.least("a", "first").alias("b"))
        large = materialize(large.where("a <> b").distinct(), "links")
        small = first_of_group(large, "a", "b").select(
            F.when(F.col("b") == F.col("first"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("first").alias("b")
        )
        links = materialize(small.where("a <> b").distinct(), "links")
    return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
