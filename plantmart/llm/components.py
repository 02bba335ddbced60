"""Connected components of a graph given as links, by alternating star contraction.

Every round joins each node to the smallest node it is linked to, first among its larger neighbours, then
among its smaller ones, until only stars are left. Rounds grow with the logarithm of the graph. Links
are kept in the shared folder after each round, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantmart.llm.storing import Steps


def _fingerprint(links: DataFrame) -> tuple:
    row = links.agg(
        F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").cast("decimal(20,0)"))
    ).first()
    return tuple(row)


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    moved = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.where("u != v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Expects u > v in every link."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(u, v): every node that is not the smallest of its component, with the smallest one.

    `links` has two columns u and v of one orderable type. Links to oneself, in either direction and
    repeated ones do no harm; without links the result is empty.
    """
    low, high = F.least("u", "v"), F.greatest("u", "v")
    steps = Steps(links.sparkSession)
    links = steps.store(links.where("u != v").select(high.alias("u"), low.alias("v")).distinct(), "links")
    before = None
    while (now := _fingerprint(links)) != before:
        before = now
        last, links = links, steps.store(_small_star(_large_star(links)), "links")
        steps.drop(last)
    return links
