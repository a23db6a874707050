"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _stars(pairs: DataFrame) -> DataFrame:
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return pairs.join(least, "u")


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(a, b) links -> (node, label): each linked node with the least node of its component.

    Works on any ordered type. Null ends and self-links count for nothing;
    nodes without links are not in the result. Every round (Kiveris et al.,
    2014) is two aggregates and two joins on a written table, so a hub is
    split by partial aggregation and skew joins; the number of rounds grows
    with the logarithm of the longest path.
    """
    start = links.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    now = staged(start.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{name}-0")
    seen, k = None, 0
    while True:
        sign = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if sign == seen or not sign[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("label")).union(now.select(F.col("v"), F.col("v"))).distinct()
        seen, k = sign, k + 1
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _stars(both).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        small = _stars(large.distinct())
        now = staged(small.select("u", F.col("m").alias("v")).union(small.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct(), f"{name}-{k}")
