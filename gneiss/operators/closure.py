"""Fixpoints over edges: closures, redirects, classification."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gneiss.session import checkpoint


def closure(seeds: DataFrame, edges: DataFrame, max_hops: int = 32) -> DataFrame:
    """(label, node, hops): nodes reached from each label's seeds along (source, target) edges, with the least hops.

    Semi-naive: only new pairs are followed; cycles end because known pairs are dropped."""
    known = checkpoint(seeds.select("label", "node").distinct().withColumn("hops", F.lit(0)))
    delta = known
    for hop in range(1, max_hops + 1):
        step = delta.join(edges, delta["node"] == edges["source"]).select("label", F.col("target").alias("node")).distinct()
        delta = checkpoint(step.join(known, ["label", "node"], "left_anti").withColumn("hops", F.lit(hop)))
        if delta.isEmpty():
            return known
        known = checkpoint(known.unionByName(delta))
    raise RuntimeError(f"closure has more than {max_hops} hops")


def classify(reached: DataFrame, nodes: DataFrame, priority: dict[str, int], default: str) -> DataFrame:
    """(node, label): the label of the least priority of those that reach a node, or the default."""
    pairs = [x for label, p in sorted(priority.items()) for x in (F.lit(label), F.lit(p))]
    ranked = reached.withColumn("_p", F.create_map(*pairs)[F.col("label")]).groupBy("node").agg(F.min(F.struct("_p", "label")).alias("_best"))
    return nodes.join(ranked, "node", "left").select("node", F.coalesce("_best.label", F.lit(default)).alias("label"))


def chase(redirects: DataFrame, max_hops: int = 16) -> DataFrame:
    """(source, target, hops): each source's last target. Several targets of one source and cycles are errors.

    Pointer jumping: hops double every round."""
    if not redirects.groupBy("source").agg(F.count_distinct("target").alias("n")).where("n > 1").isEmpty():
        raise ValueError("a source has several redirect targets")
    now = checkpoint(redirects.select("source", "target").distinct().withColumn("hops", F.lit(1)))
    for _ in range(max(1, max_hops.bit_length())):
        onward = now.select(F.col("source").alias("target"), F.col("target").alias("_next"), F.col("hops").alias("_more"))
        joined = now.join(onward, "target", "left")
        now = checkpoint(joined.select("source", F.coalesce("_next", "target").alias("target"), (F.col("hops") + F.coalesce("_more", F.lit(0))).alias("hops")))
        if not now.where("source = target").isEmpty():
            raise ValueError("redirects have a cycle")
        if now.join(now.select(F.col("source").alias("target")), "target", "left_semi").isEmpty():
            return now
    raise ValueError(f"redirect chain of more than {max_hops} hops or a cycle")


def follow(df: DataFrame, key: str, chased: DataFrame) -> DataFrame:
    """df with key replaced by its last redirect target."""
    ends = chased.select(F.col("source").alias(key), F.col("target").alias("_end"))
    return df.join(ends, key, "left").withColumn(key, F.coalesce("_end", key)).drop("_end")
