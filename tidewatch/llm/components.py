"""Connected components of a graph given as links, by alternating large-star and small-star steps.

Every round is a grouped minimum and a join, the links are checkpointed between rounds, and the rounds needed grow with the logarithm of
the graph. A vertex may hold any share of the links: minima are combined before the shuffle, and joins go through ``attach``.
Nothing about single links or components reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import attach


def _settled(links: DataFrame) -> DataFrame:
    return links.filter("a != b").distinct().checkpoint()


def _mark(links: DataFrame) -> tuple:
    """Equal for equal sets of links."""
    r = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(r)


def _large_star(links: DataFrame) -> DataFrame:
    """Each vertex links its larger neighbours to the smallest of itself and its neighbours."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct().checkpoint()
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")).checkpoint()
    return _settled(attach(both.filter("b > a"), least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(links: DataFrame) -> DataFrame:
    """Each vertex links itself and its smaller neighbours to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().checkpoint()
    least = down.groupBy("a").agg(F.min("b").alias("m")).checkpoint()
    own = least.select("a", F.col("m").alias("b"))
    moved = attach(down, least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _settled(own.unionByName(moved))


def components(links: DataFrame) -> DataFrame:
    """``vertex, root`` for every vertex with a link; ``root`` is the smallest vertex that can be reached.

    ``links`` has two columns of one orderable type, in any direction, repeats and self-links allowed.
    """
    links = _settled(links.toDF("a", "b"))
    before = None
    while (now := _mark(links)) != before:
        before = now
        links = _small_star(_large_star(links))
    roots = links.select(F.col("b").alias("vertex"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("vertex"), F.col("b").alias("root")).unionByName(roots)
