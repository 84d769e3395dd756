"""Connected components of a table of links, by alternating stars (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._tables import Written


def _with_least(edges: DataFrame, least: DataFrame) -> DataFrame:
    return edges.join(least, "u")


def components(links: DataFrame, tables: Written) -> DataFrame:
    """(a, b) links between numbers -> (node, root): each linked node and the least it reaches.

    Every round sends each node's neighbours to the least of them, first over all links,
    then over those to smaller nodes.  The number of rounds grows with the logarithm of the
    longest path.  A node's links are never gathered: the least comes from a partial
    aggregate and goes back by a join, which Spark splits where a node is hot.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges, rounds = tables(edges, "links0"), 0
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = tables(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), f"large{rounds}")
        # the larger neighbours of u go to m
        large = _with_least(both.where("v > u"), least).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = tables(large.where("u <> v").distinct(), f"star{rounds}")
        low = tables(large.groupBy("u").agg(F.min("v").alias("m")), f"small{rounds}")
        joined = _with_least(large, low)
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
            low.select("u", F.col("m").alias("v"))
        )
        after = tables(small.distinct(), f"links{rounds + 1}")
        tables.drop(f"large{rounds}", f"star{rounds}", f"small{rounds}")
        # stars: no node is both a root and below one
        roots = after.select(F.col("v").alias("u")).distinct()
        done = after.join(roots, "u", "left_semi").isEmpty() and after.groupBy("u").count().where("count > 1").isEmpty()
        tables.drop(f"links{rounds}")
        rounds += 1
        edges = after
        if done:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
