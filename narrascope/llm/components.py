"""Connected components by alternating stars, for links of any number.

Each round a vertex hands its larger neighbours, then its smaller ones, to the smallest
vertex it knows. Only minima are aggregated, so a vertex with very many links is summed
before the shuffle, and its join can be split. The rounds grow with the logarithm of the
longest path. Every round is written to the shared folder, so nothing is computed again, and
the round before is deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from narrascope.functions.bounds import pinned_next


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Links (a, b) have b < a."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(vertex, root) for every vertex of ``links`` (a, b), any order; the root is the smallest."""
    links = links.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    links, path = pinned_next(links.distinct(), "links")
    state = None
    while True:
        digest = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        now = tuple(links.agg(F.count("*"), digest).head())
        if now == state or not now[0]:
            break
        state = now
        links, path = pinned_next(_small_star(_large_star(links)), "links", path)
    roots = links.select(F.col("a").alias("vertex"), F.col("b").alias("root"))
    return roots.unionByName(links.select(F.col("b").alias("vertex"), F.col("b").alias("root")).distinct())
