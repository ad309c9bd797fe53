"""Connected components of a table of links, by alternating large and small stars.

Every round hangs each vertex on the smallest vertex it knows, and is written to the shared folder, so that a lost
executor costs a re-read and lineage stays short. Rounds end when the links are stars already. Minima are pre-aggregated, and the join on a vertex with very many
links has a single row on its other side, so AQE can split it.

Links with a null end, and links of a vertex to itself, are left out; no links give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.sources.shared import cut


def _downward(links: DataFrame) -> DataFrame:
    """Each link once, from its larger to its smaller end."""
    return (
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )


def _stars(links: DataFrame) -> bool:
    """Whether every larger end has one smaller end, which is no larger end itself."""
    ends = links.select(F.col("a").alias("v"), F.lit(1).alias("up")).unionByName(links.select(F.col("b").alias("v"), F.lit(0).alias("up")))
    seen = ends.groupBy("v").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
    return seen.where((F.col("ups") > 1) | ((F.col("ups") > 0) & (F.col("least") == 0))).isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every vertex of ``links`` (columns a, b of one type); component is the smallest vertex reachable."""
    now = cut(_downward(links), "links")
    while not _stars(now):
        # Large star: what is above a vertex hangs on the smallest vertex around it.
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
        above = both.where("b > a").join(least, F.col("a") == F.col("v")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        above = above.distinct()
        # Small star: what is below a vertex, and itself, hangs on the smallest vertex below it.
        least = above.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("m"))
        below = above.join(least, F.col("a") == F.col("v")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = cut(_downward(below.unionByName(least.select(F.col("v").alias("a"), F.col("m").alias("b")))), "links")
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
