"""Connected components of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the smallest node it knows."""
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    return (
        both.filter("v > u").join(least, F.col("u") == F.col("w")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links its smaller neighbours, and itself, to the smallest of them. ``edges`` have a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("w"), "m")
    moved = edges.join(least, F.col("a") == F.col("w")).filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("w", "m"))


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node that has a link, from links (a, b) of bigint nodes.

    ``component`` is the smallest node reachable. Every round is written to the shared folder, so
    neither links nor labels pass through the driver, which reads only two numbers per round. The
    number of rounds grows with the logarithm of the longest path. No links give no rows.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
    edges, before = staged(edges, "links"), None
    while True:
        n, check = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if (n, check) == before or not n:
            break
        before = (n, check)
        large = _large_star(edges).distinct()
        edges = staged(_small_star(large).distinct(), "links")
    own = edges.select(F.col("b").alias("a"), "b").distinct()
    return edges.union(own).toDF("node", "component")
