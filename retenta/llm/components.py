"""Connected components of a graph of links, in Spark rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from retenta.session import discard, materialize


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): root is the least node reachable. Nodes are those with a link to another node.

    Large-star and small-star rounds in turn: every node's larger neighbours are hung on its
    least neighbour, then the smaller ones too, until the links stand still. A round is two
    sums and two joins by node; a much-linked node's rows are split by Spark's skew join.
    Each round is a written table, so a lost executor repeats one round at most; the round before goes.
    """
    lo, hi = F.least(a, b), F.greatest(a, b)
    now = materialize(links.where(F.col(a) != F.col(b)).select(hi.alias("u"), lo.alias("v")).distinct(), "links")
    before = None
    while True:
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == before or not seen[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                now.select("v", "v")).distinct()
        before = seen
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        last, now = now, materialize(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        discard(last)
