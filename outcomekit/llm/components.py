"""Connected components of a table of links, by repeated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outcomekit.llm.common import written


def _are_stars(edges: DataFrame) -> bool:
    """Does every id ``u`` have one link, to an id ``v`` that is no other's ``u``?"""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("out")).union(edges.select("v", F.lit(0)))
    ends = ends.groupBy("id").agg(F.sum("out").alias("outs"), F.min("out").alias("leaf"))
    return ends.where("outs > 1 or (outs = 1 and leaf = 0)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` -> ``(id, root)``: the smallest id reachable from each id
    that has a link.

    Large-star and small-star steps in turn: each id hangs its larger (then its
    smaller) neighbours under the smallest one, until all links lead to a root.  Minima
    are pre-aggregated, and a hub's neighbours meet its minimum in a join that
    Spark can split, so no id's neighbours are gathered in one task.
    """
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .where("u <> v").distinct(), "links")
    while not _are_stars(edges):
        # large star: neighbours above an id go under the smallest of it and its neighbours
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # small star: an id and its smaller neighbours go under the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges = written(moved.union(least.select("u", F.col("m").alias("v"))).distinct(), "links")
    roots = edges.select(F.col("u").alias("id"), F.col("v").alias("root"))
    return roots.union(edges.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct())
