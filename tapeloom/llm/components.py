"""Connected components of a table of links, by alternating large-star and small-star rounds (Kiveris et al. 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.common import discard, written


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a vertex is linked to the least vertex around it."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """A vertex and its smaller neighbours are linked to the least of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.withColumnRenamed("m", "b"))


def components(links: DataFrame) -> DataFrame:
    """Map every vertex of links to the least vertex that it can reach.

    links has columns a and b (long), in any direction; loops, repeated links and an empty table are
    allowed, rows with a null are left out. Returns vertex and root for all vertices that are not
    themselves roots. Each round is written to the shared folder; the number of rounds grows with
    the logarithm of the longest chain. Only sums of hashes, never links, reach the driver.
    """
    now = written(links.filter("a <> b").select("a", "b").distinct(), "links")
    mark = None
    while True:
        before, now = now, written(_small_star(_large_star(now)).filter("a <> b").distinct(), "links")
        discard(before)
        seen = now.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
        if seen == mark:
            return now.select(F.col("a").alias("vertex"), F.col("b").alias("root"))
        mark = seen
