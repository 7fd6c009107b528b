"""Connected components of an edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gneiss.session import checkpoint


def connected_components(edges: DataFrame, max_iterations: int = 64) -> DataFrame:
    """(node, component): component is the smallest node that can be reached. edges: (a, b), of one orderable type.

    Alternates large-star and small-star, which needs a logarithmic number of rounds on
    long chains too. A hub's neighbours are reduced to their minimum by partial aggregation; the join back to the minimum has one
    row on that side and all of the hub's edges on the other, which adaptive execution splits (skew join). Loops (a = b) keep isolated nodes.
    Not converging within max_iterations is an error.
    """
    loops = edges.where("a = b").select(F.col("a").alias("node"))
    rows = checkpoint(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    nodes = checkpoint(rows.select(F.explode(F.array("u", "v")).alias("node")).unionByName(loops).distinct())
    before = None
    for _ in range(max_iterations):
        both = rows.unionByName(rows.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        rows = checkpoint(small.where("u <> v").distinct())
        # the sets of two rounds are told apart by their size and 192 bits of order-independent hashes
        now = rows.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.sum(F.xxhash64("v", "u").cast("decimal(20,0)"))).first()
        if now == before:
            return nodes.join(rows.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")), "node", "left").select(
                "node", F.coalesce("component", "node").alias("component")
            )
        before = now
    raise RuntimeError(f"connected components did not converge in {max_iterations} rounds")
