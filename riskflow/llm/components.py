"""Connected components of a graph given as a table of links, by alternating large and small stars.

Every step is a grouped minimum (combined before the shuffle) and a join, so a vertex with many links is no special case.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.frames import stored


def _smallest(both: DataFrame) -> DataFrame:
    """u, v and the smallest of u and its neighbours."""
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return both.join(least, "u").withColumn("m", F.least("u", "m"))


def _is_stars(edges: DataFrame) -> bool:
    """Whether every vertex has one edge to a smaller one, or edges to larger ones only: then groups are told by their edges."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("down"), F.lit(0).alias("up"))
    ends = ends.unionByName(edges.select(F.col("v").alias("id"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    each = ends.groupBy("id").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return each.agg(F.count_if((F.col("down") + F.col("up") > 1) & (F.col("down") > 0))).first()[0] == 0


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every vertex of ``links`` (a, b: longs, not null); component is the smallest id reachable.

    Direction, repetition and self-links do not matter; no links give an empty result.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    selves = edges.filter("u = v")
    edges = edges.filter("u > v")
    while not _is_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _smallest(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _smallest(large)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            small.select("u", F.col("m").alias("v"))
        )
        edges = stored(small.filter("u > v").distinct(), "stars")
    members = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("id")).unionByName(selves.select(F.col("u").alias("id"))).distinct()
    roots = roots.join(members, "id", "left_anti")
    return members.unionByName(roots.select("id", F.col("id").alias("component")))
