"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.sources.workdir import store


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, root)`` for every node that a link names; root is the least node reachable.

    Alternates two steps: every node links its larger neighbours to the least node it
    knows, then its smaller ones. A component becomes a star after a number of rounds
    that grows with the logarithm of its width. Each round is one stored table; what
    reaches the driver is a count and a checksum. Links with a NULL end and links of a
    node to itself are left out.
    """
    pairs = links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v")
    pairs = store(
        pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "links",
    )
    seen = _sum(pairs)
    while seen[0]:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        wide = (
            both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()
        least = wide.groupBy("u").agg(F.min("v").alias("m"))
        near = wide.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), "m")
        pairs = store(
            near.unionByName(least).select("u", F.col("m").alias("v")).filter("u <> v").distinct(),
            "links",
        )
        now = _sum(pairs)
        if now == seen:
            break
        seen = now
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _sum(pairs: DataFrame) -> tuple:
    mark = F.xxhash64("u", "v").cast("decimal(20,0)")
    return tuple(pairs.agg(F.count(F.lit(1)), F.sum(mark)).first())
