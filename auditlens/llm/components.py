"""Connected components of a graph given as links, by stars over joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlens.session import settle


def _least_neighbours(links: DataFrame) -> DataFrame:
    """Rows (a, m): the least of a node and its neighbours, settled.

    Values are combined before the shuffle, so a node with very many links is no burden. The join
    with the links then reads two plain shuffles, of which Spark can split the large parts.
    """
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    return settle(least.select("a", F.least("a", "m").alias("m")), "least")


def _are_stars(links: DataFrame) -> bool:
    """Whether each node hangs under one other, which itself hangs under none."""
    chained = links.join(links.select(F.col("b").alias("a")).distinct(), "a", "left_semi").select("a")
    twice = links.groupBy("a").agg(F.count("*").alias("n")).filter("n > 1").select("a")
    return chained.unionAll(twice).isEmpty()


def components(links: DataFrame) -> DataFrame:
    """Rows (node, root) for all nodes with links: root is the least node that can be reached.

    `links` has columns a, b of one integer type, without NULL; links of a node to itself count as
    none, repeated ones as one. Large stars hang the greater neighbours of each node under its
    least one, small stars the others; the number of rounds grows with the logarithm of the longest
    path. Each round is written to the shared folder, so a lost executor costs a re-read.
    """
    ordered = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = settle(ordered.distinct(), "links")
    while not _are_stars(links):
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        greater = both.join(_least_neighbours(both), "a").filter("b > a")
        large = greater.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        large = settle(large.distinct(), "large-stars")
        least = _least_neighbours(large)
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionAll(least.select("a", F.col("m").alias("b"))).filter("a <> b")
        links = settle(small.distinct(), "small-stars")
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return roots.unionAll(links.select(F.col("a").alias("node"), F.col("b").alias("root")))
