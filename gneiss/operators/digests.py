"""Order-independent digests, paging and shard arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LIMB = 15  # hex digits that fit a long


def row_key(columns: list[str]) -> Column:
    """SHA-256 of a row as canonical JSON: keys sorted, nulls kept."""
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in sorted(columns)]), {"ignoreNullFields": "false"}), 256)


def multiset_digest(df: DataFrame, key: Column) -> DataFrame:
    """(n, xor_0.., sum_0..): the same for any order of rows, different if a row is repeated."""
    limbs = [F.conv(F.substring(key, 1 + LIMB * i, LIMB), 16, 10).cast("long") for i in range(4)]
    return df.select(*[x.alias(f"_{i}") for i, x in enumerate(limbs)]).agg(
        F.count("*").alias("n"),
        *[F.expr(f"bit_xor(_{i})").alias(f"xor_{i}") for i in range(4)],
        *[(F.sum(F.col(f"_{i}").cast("decimal(38,0)")) % F.lit(1 << 60).cast("decimal(38,0)")).cast("long").alias(f"sum_{i}") for i in range(4)],
    )


def bucketed_digest(df: DataFrame, key: str) -> DataFrame:
    """(bucket, n, digest): 256 buckets by hash prefix, each the hash of its sorted keys; bounded in the number of rows out.

    Keys are reduced to distinct hashes first; a bucket holds 1/256 of them."""
    hashed = df.select(F.sha2(F.col(key).cast("string"), 256).alias("h")).distinct()
    return hashed.groupBy(F.substring("h", 1, 2).alias("bucket")).agg(F.count("*").alias("n"), F.sha2(F.array_join(F.sort_array(F.collect_list("h")), "\n"), 256).alias("digest"))


def pages(df: DataFrame, key: str, shards: int, page_size: int) -> DataFrame:
    """(key, shard, page, position): pages of ordered keys within hash shards."""
    shard = F.conv(F.substring(F.sha2(F.col(key).cast("string"), 256), 1, 8), 16, 10).cast("long") % shards
    rows = df.select(key, shard.cast("int").alias("shard"))
    position = F.row_number().over(Window.partitionBy("shard").orderBy(key)) - 1
    return rows.withColumn("position", position).withColumn("page", F.floor(F.col("position") / page_size).cast("int"))


def windows(df: DataFrame, key: str, max_items: int) -> DataFrame:
    """(window, first, last, n): distinct ordered keys cut into windows of at most max_items; nothing is dropped.

    The global order is found by range-partitioned counts: each range knows how many keys stand before it."""
    rows = df.select(key).distinct().repartitionByRange(key).sortWithinPartitions(key).withColumn("_p", F.spark_partition_id()).withColumn("_o", F.monotonically_increasing_id())
    rows = rows.withColumn("_i", F.col("_o") - F.shiftleft(F.col("_p").cast("long"), 33))
    sizes = rows.groupBy("_p").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    placed = rows.join(F.broadcast(before), "_p").withColumn("window", F.floor((F.col("_before") + F.col("_i")) / max_items).cast("int"))
    return placed.groupBy("window").agg(F.min(key).alias("first"), F.max(key).alias("last"), F.count("*").alias("n"))


def shard_arithmetic(df: DataFrame, number: str, shards: int, partitions: int) -> DataFrame:
    """Epoch, shard and partition of numbered entities."""
    return df.withColumns({"shard": F.pmod(F.col(number), F.lit(shards)), "partition": F.pmod(F.floor(F.col(number) / shards), F.lit(partitions)), "epoch": F.floor(F.col(number) / (shards * partitions))})


def sizing(df: DataFrame, n: str, size: str, max_docs: int, max_bytes: int, overhead: float = 1.3) -> DataFrame:
    """Primary shards from document counts and bytes."""
    by_bytes = F.ceil(F.col(size) * F.lit(overhead) / F.lit(max_bytes))
    return df.withColumn("primary_shards", F.greatest(F.lit(1), F.ceil(F.col(n) / F.lit(max_docs)), by_bytes).cast("long"))
