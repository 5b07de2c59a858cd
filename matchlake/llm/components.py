"""Connected components of a link table by alternating star contraction.

Each round replaces links by links to the smallest neighbour (large star, then
small star), so that long chains shrink by a constant factor and every
component ends as one star around its smallest node.  Every round is two
grouped minima and joins on a narrow table that is written to the shared
folder (and the one before it deleted); only two numbers (link count and checksum) reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm.common import release, stored


def _checksum(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` -> (node, component): every node that has a link to
    another, with the smallest node it reaches.  Self-links and repeats are ignored."""
    edges = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .filter("a > b").distinct(), "links")
    state = _checksum(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = both.groupBy(F.col("a").alias("n")).agg(F.least(F.min("b"), F.col("n")).alias("m"))
        # large star: every larger neighbour of n points to n's smallest
        large = (both.join(smallest, F.col("a") == F.col("n")).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .filter("a > b").distinct())
        large = stored(large, "large-star")
        release(edges)
        # small star: n and its smaller neighbours point to the smallest of them
        low = large.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
        small = (large.join(low, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select(F.col("n").alias("a"), F.col("m").alias("b")))
                 .filter("a > b").distinct())
        edges = stored(small, "small-star")
        release(large)
        now = _checksum(edges)
        if now == state:
            break
        state = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
