"""Connected components of a link table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) for links (a, b); root is the smallest node of the component.

    Each round hangs every node's neighbours on the smallest one; the number of
    rounds grows with the logarithm of the component size. Smallest neighbours
    are partial sums before the shuffle, so a hub costs a row per task, and a
    round's result is a written table.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, before = stored(edges, "links"), None
    while (state := _state(edges)) != before:
        before = state
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Large star: neighbours greater than a node hang on its smallest neighbour.
        low = stored(both.groupBy("a").agg(F.min("b").alias("b")).select("a", F.least("a", "b").alias("m")), "links-low")
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.distinct(), "links-large")
        # Small star: the smaller neighbours of a node, and the node, hang on the smallest of them.
        low = stored(large.groupBy("a").agg(F.min("b").alias("m")), "links-low")
        hung = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        edges = stored(hung.union(low.select("a", F.col("m").alias("b"))).distinct(), "links")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


def _state(edges: DataFrame) -> tuple:
    """Equal for equal sets of links."""
    h = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(h), F.sum(h.cast("decimal(38,0)"))).first())
