"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentio.llm.common import stage


def _fingerprint(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first())


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of every node that has an edge; root is the smallest node of its
    component.  Each round is two joins over the edges (never more rows than
    edges), stored under the shared checkpoint folder; the number of rounds
    grows with the logarithm of the longest chain."""
    now = stage(edges.filter(F.col(a) != F.col(b))
                .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    mark = _fingerprint(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large star: larger neighbours are hung on the smallest of the neighbourhood
        large = (both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .distinct())
        # small star: a node and its smaller neighbours are hung on the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        now = stage(small, "edges")
        new = _fingerprint(now)
        if new == mark:
            break
        mark = new
    return (now.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct())
