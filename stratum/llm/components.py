"""Connected components of a large set of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import staged


def _towards_min(links: DataFrame) -> DataFrame:
    """Each ``(u, v)`` with the smallest neighbour ``m`` of ``u`` (or ``u``)."""
    least = links.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return links.join(least, "u")


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links(a, b)``; the root is the
    component's smallest node.

    Alternating large-star and small-star rounds: each hangs neighbours on the
    smallest one known, so the links shrink to one star per component in a
    number of rounds that grows with the logarithm of the diameter. The stars'
    smallest neighbours come from partial aggregates, so a node with very many
    links sends one row per task. Every round is a written table."""
    now = staged(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                 .distinct(), "links")
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _towards_min(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        small = _towards_min(large)
        small = (small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(small.select("u", F.col("m").alias("v")))
                 .where("u <> v").distinct())
        now = staged(small, "stars")
        sums = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if sums == seen:  # a round changed nothing: only stars are left
            break
        seen = sums
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
