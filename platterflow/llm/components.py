"""Connected components of a stored table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platterflow.session import keep


def components(links: DataFrame) -> DataFrame:
    """From links (a, b) of bigints: (member, root) for each linked value, the root the smallest.

    Alternates two steps until nothing moves: every value hands its larger neighbours to its
    smallest one, then its smaller neighbours likewise. A value's smallest neighbour is found by an
    aggregate that combines before the shuffle and comes back by a join of stored tables, so a
    value with very many links is dealt over tasks. The rounds grow with the logarithm of the links.
    """
    def smallest(edges: DataFrame) -> DataFrame:
        least = keep(edges.groupBy("u").agg(F.min("v").alias("m")))
        return edges.join(least, "u")

    def digest(edges: DataFrame):
        return edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()

    edges = keep(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct())
    before = digest(edges)
    while before[0]:
        both = keep(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))))
        large = smallest(both).filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        large = keep(large.distinct())
        small = smallest(large)
        small = small.filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            small.select("u", F.col("m").alias("v")))
        edges = keep(small.distinct())
        after = digest(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("member"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("member"), F.col("v").alias("root")).distinct())
