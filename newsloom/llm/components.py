"""Connected components of links by alternating large and small stars, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.scratch import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, root): for every node of ``links`` (u, v) the smallest node it is connected with.

    Each round hangs all neighbours of a node on the smallest of them, first the
    larger ones, then the smaller ones, until nothing moves; rounds grow with the
    logarithm of the largest component. Minima are combined before the shuffle, and
    stored, so that a node of very many links is split over tasks when it meets its
    own. The driver sees one checksum a round.
    """
    stars = materialize(links.select("u", "v").filter("u <> v").distinct(), "links")
    before = None
    while True:
        stars = materialize(small_star(materialize(large_star(stars), "large-star")), "small-star")
        mark = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if before == tuple(mark):
            break
        before = tuple(mark)
    inner = stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return inner.unionByName(stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node on the smallest of the node and its neighbours."""
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = materialize(both.groupBy("u").agg(F.min("v").alias("m")), "least")
    joined = both.filter("v > u").join(least, "u")
    return joined.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, on the smallest of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = materialize(down.groupBy("u").agg(F.min("v").alias("m")), "least")
    joined = down.join(least, "u")
    moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return moved.filter("u <> v").distinct()
