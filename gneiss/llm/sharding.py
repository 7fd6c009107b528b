"""Extendible hashing: shards that fit a byte limit, split bit by bit.

A row's address is a string of bits: 60 bits of MD5 of its key, then 60 bits of MD5 of its
key, its text and its place in the input. The directory starts as one bucket; a bucket over the
byte limit is split on its next address bit, every other bucket stays. The result is the
unique shallowest set of prefixes in which each bucket fits.

Splitting is planned on byte totals, not on rows: one pre-aggregated total for each prefix of
a planning depth, from which the totals of all shorter prefixes follow. Only cells that are
still too large at that depth are looked at more deeply. A hot key (many rows with one
key) runs out of key bits and goes on with the tie bits, so it is split as well. What cannot be split, a
single row above the limit, forms a shard of its own with oversize = true.

Defined results: a null key is the key ''; null or empty text has 0 bytes and is still placed;
repeated rows and equal keys are all kept, told apart by their place; a very long text is a shard of its own; an empty table gives no rows;
shard() gives key, bytes and placement of each row and reads no further columns; write_shards() writes whole rows, further columns too, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gneiss.llm.columns import private
from gneiss.session import materialize, table

LIMIT_BYTES = 1 << 20
KEY_BITS = 60
ADDRESS_BITS = 2 * KEY_BITS
SLACK_BITS = 6  # planning depth beyond log2(total / limit)


def _bits(text: Column) -> Column:
    """60 bits of the MD5 of a string as a string of 0 and 1."""
    return F.lpad(F.bin(F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")), KEY_BITS, "0")


def addresses(df: DataFrame, key: str, payload: str) -> DataFrame:
    """Adds _bits and _bytes. The tie bits are made only where key bits may run out: they cost a hash of the text."""
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    place = F.concat_ws("|", name, F.xxhash64(F.col(payload)).cast("string"), F.monotonically_increasing_id().cast("string"))
    return df.withColumns(
        {
            "_bits": F.concat(_bits(name), _bits(place)),
            "_bytes": F.coalesce(F.octet_length(F.col(payload)), F.lit(0)).cast("long"),
        }
    )


def _plan(cells: DataFrame, low: int, high: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """Buckets among the prefixes of length low..high, and the cells of length high that still do not fit.

    cells: (cell, bytes, docs), with prefixes of length high whose prefix of length low does not fit
    (or low is 0).
    """
    totals = (
        cells.select("bytes", "docs", "cell", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth"))
        .groupBy("depth", F.expr("substring(cell, 1, depth)").alias("prefix"))
        .agg(F.sum("bytes").alias("bytes"), F.sum("docs").alias("docs"))
        .withColumn("fits", (F.col("bytes") <= limit) | (F.col("docs") == 1))
    )
    parents = totals.where(~F.col("fits")).select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
    children = totals.withColumn("parent", F.expr("substring(prefix, 1, depth - 1)"))
    split = children.join(parents, ["depth", "parent"], "left_semi")
    if low == 0:
        split = split.unionByName(children.where("depth = 0"))
    last = (F.col("depth") == high) & ~F.col("fits")
    buckets = split.where(F.col("fits") | last).select("prefix", "depth", "bytes", "docs", "fits")
    return buckets.where("fits").drop("fits"), buckets.where("not fits").drop("fits")


def directory(placed: DataFrame, limit: int = LIMIT_BYTES) -> DataFrame:
    """The buckets: prefix, depth, bytes, docs. placed has _bits and _bytes."""
    total = placed.agg(F.coalesce(F.sum("_bytes"), F.lit(0))).first()[0]
    depth, low = min(ADDRESS_BITS, max(0, math.ceil(math.log2(max(1, total / limit)))) + SLACK_BITS), 0
    rows, found = placed, None
    while True:
        cells = rows.groupBy(F.substring("_bits", 1, depth).alias("cell")).agg(F.sum("_bytes").alias("bytes"), F.count("*").alias("docs"))
        buckets, large = _plan(cells, low, depth, limit)
        buckets = materialize(buckets.unionByName(large.withColumn("depth", F.lit(-1))), "directory")
        large, buckets = buckets.where("depth = -1"), buckets.where("depth >= 0")
        found = buckets if found is None else found.unionByName(buckets)
        if large.isEmpty():
            return found
        if depth == ADDRESS_BITS:  # 120 equal bits: kept together and reported as oversize
            return found.unionByName(large.withColumn("depth", F.lit(depth)))
        rows = rows.withColumn("prefix", F.substring("_bits", 1, depth)).join(large.select("prefix"), "prefix", "left_semi").drop("prefix")
        low, depth = depth, min(ADDRESS_BITS, depth + 12)


def shard(df: DataFrame, key: str = "doc_id", payload: str = "text", limit: int = LIMIT_BYTES) -> DataFrame:
    """df with shard (prefix; '' if all fits in one), shard_depth, shard_bytes, shard_docs and oversize."""
    placed = materialize(addresses(df.select(key, payload), key, payload).select("_bits", "_bytes", F.col(key).alias("_key")), "addresses")
    found = directory(placed, limit)
    return _assign(placed, found).withColumn("oversize", F.col("shard_bytes") > limit)


def _assign(placed: DataFrame, found: DataFrame) -> DataFrame:
    """Each row meets its bucket by equality of prefix and depth; the depths in use are few (one job finds them)."""
    depths = sorted(r[0] for r in found.select("depth").distinct().collect())
    candidates = F.array(*[F.struct(F.lit(d).alias("depth"), F.substring("_bits", 1, d).alias("prefix")) for d in depths]) if depths else None
    if candidates is None:
        return placed.select("_key", "_bytes", F.lit("").alias("shard"), F.lit(0).alias("shard_depth"), F.lit(0).cast("long").alias("shard_bytes"), F.lit(0).cast("long").alias("shard_docs"))
    rows = placed.select("_key", "_bytes", F.explode(candidates).alias("c")).select("_key", "_bytes", "c.depth", "c.prefix")
    return rows.join(found, ["depth", "prefix"]).select(
        "_key", "_bytes", F.col("prefix").alias("shard"), F.col("depth").alias("shard_depth"), F.col("bytes").alias("shard_bytes"), F.col("docs").alias("shard_docs")
    )


def write_shards(df: DataFrame, path: str, key: str = "doc_id", payload: str = "text", limit: int = LIMIT_BYTES) -> None:
    """Write whole rows, one folder for each shard."""
    bits, size, cell, depth, name, whole = private(df, "bits", "bytes", "cell", "depth", "shard", "whole")
    placed = addresses(df.select(F.struct("*").alias(whole), F.col(key).alias("_k"), F.col(payload).alias("_p")), "_k", "_p")
    rows = materialize(placed.select(F.col("_bits").alias(bits), F.col("_bytes").alias(size), f"{whole}.*"), "rows")
    found = directory(rows.select(F.col(bits).alias("_bits"), F.col(size).alias("_bytes")), limit)
    depths = sorted(r[0] for r in found.select("depth").distinct().collect())
    if not depths:
        df.withColumn(name, F.lit("")).write.parquet(path)
        return
    rows = rows.withColumn(cell, F.explode(F.array(*[F.struct(F.lit(d).alias("depth"), F.substring(bits, 1, d).alias("prefix")) for d in depths])))
    held = found.select(F.col("depth").alias(depth), F.col("prefix").alias(name))
    placed = rows.join(held, (F.col(cell)["depth"] == F.col(depth)) & (F.col(cell)["prefix"] == F.col(name))).drop(cell, depth, bits, size)
    # a shard is at most `limit` bytes, or one row, so it may meet in one task
    placed.withColumn(name, F.concat(F.lit("s"), name)).repartition(name).write.partitionBy(name).parquet(path)


def op3_extendible_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents dealt to shards of at most 1 MiB of text."""
    return shard(table(spark, sf_dir, "documents")).select(
        F.col("_key").alias("doc_id"), F.col("_bytes").alias("n_bytes"), "shard", "shard_depth", "shard_bytes", "shard_docs", "oversize"
    )


ORACLE_SQL = f"""
WITH a AS (
  SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS n_bytes,
         lpad(bin(('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT), {KEY_BITS}, '0') AS bits
  FROM documents),
t AS (
  SELECT d.depth, substr(bits, 1, d.depth) AS prefix, sum(n_bytes)::BIGINT AS bytes, count(*) AS docs
  FROM a, (SELECT unnest(range(0, {KEY_BITS}))::INTEGER AS depth) d GROUP BY ALL),
b AS (
  SELECT c.* FROM t c
  LEFT JOIN t p ON p.depth = c.depth - 1 AND p.prefix = substr(c.prefix, 1, c.depth - 1)
  WHERE (c.bytes <= {LIMIT_BYTES} OR c.docs = 1)
    AND (c.depth = 0 OR NOT (p.bytes <= {LIMIT_BYTES} OR p.docs = 1)))
SELECT doc_id, n_bytes, b.prefix AS shard, b.depth AS shard_depth, b.bytes AS shard_bytes, b.docs AS shard_docs,
       b.bytes > {LIMIT_BYTES} AS oversize
FROM a JOIN b ON substr(a.bits, 1, b.depth) = b.prefix
"""
