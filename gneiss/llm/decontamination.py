"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

Words are runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased; shingles are five
consecutive words (a test item with fewer words is one shingle as a whole). An item is in a document
if at least 80 % of its distinct shingles are among the document's.

A short item in a long document has almost no Jaccard similarity, so the search estimates
containment: an item is represented by its smallest shingle hashes, and a document is probed
with all of its shingles. Items are partitioned by size (powers of two). Each partition has its own
sketch size (SKETCHES: whole up to 16 shingles, then 16, 32 and 64 hashes, so that the many shingles of a long item bring no chance candidates) and its
own number of hits, set so that a truly contained item is missed with a
probability below one in a million (an item sketched whole is never missed). A document's shingles are read once and probe all partitions;
hits are counted and tested by partition. The pairs
found are verified by counting common shingles as text. Everything is DataFrame functions: one
pass over the documents' words inside generated code, joined to the sketch; only hits are shuffled.

The sketch is broadcast only if it is counted to be at most BROADCAST_ROWS rows of 16 bytes, the keys of the candidates' documents only if
they are at most BROADCAST_KEYS of 16 bytes; beyond that they are joined by a shuffle. Documents and items are known by their id and a hash of
their text, so rows with equal ids do not mix and null ids are ids like others.

Defined results: null or empty text, of documents or items, matches nothing; repeated documents give repeated
flags but one result row for each distinct (id, text, item); repeated items are one; very long texts are probed whole; an item at the
threshold counts; an empty table gives no rows; decontaminate() keeps further columns whatever their names.
"""

from __future__ import annotations

from math import ceil, comb

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gneiss.llm.columns import private
from gneiss.llm.licenses import LOWER, SEPARATORS, UPPER
from gneiss.session import checkpoint, table

WORDS = 5
CONTAINMENT = 0.8
#: Largest part (floor of the binary logarithm of an item's shingles) and the size of its sketches; items of up to the first are whole.
SKETCHES = ((5, 16), (7, 32), (62, 64))
MISS = 1e-6
BROADCAST_ROWS = 200_000
BROADCAST_KEYS = 2_000_000


def _words(text: Column) -> Column:
    norm = F.trim(F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), SEPARATORS, " "))
    return F.when(norm == "", F.array().cast("array<string>")).otherwise(F.split(norm, " "))


def needed_hits(sketch: int, containment: float, miss: float) -> int:
    """The most hits that can be asked of a sketch so that an item at the threshold is missed with less than `miss`."""
    below, h = 0.0, 0
    while h < sketch and below + (p := comb(sketch, h) * containment**h * (1 - containment) ** (sketch - h)) < miss:
        below, h = below + p, h + 1
    return max(1, h)


def _shingles(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    """(keys, the n words from each place). Rows of words are only read, never copied, by the generated code."""
    at = F.posexplode("_words").alias("_at", "_word")
    rows = df.select(*keys, "_words", at).where(F.col("_at") <= F.size("_words") - n)
    return rows.withColumn("_parts", F.struct(F.col("_word"), *[F.expr(f"_words[_at + {i}]").alias(f"w{i}") for i in range(1, n)]))


def _hash(n: int) -> Column:
    return F.xxhash64(*[F.col("_parts")[name] for name in ["_word", *[f"w{i}" for i in range(1, n)]]])


def _text(n: int) -> Column:
    return F.concat_ws(" ", *[F.col("_parts")[name] for name in ["_word", *[f"w{i}" for i in range(1, n)]]])


def items(benchmark: DataFrame, id_col: str = "item_id", text: str = "text") -> DataFrame:
    """(item, item_id, n, shingle, hash, n_item): the distinct shingles of each item; n is the words in a shingle, item names id and text."""
    words = benchmark.select(F.xxhash64(id_col, text).alias("item"), F.col(id_col).alias("item_id"), _words(F.col(text)).alias("_words")).where(F.size("_words") > 0)
    found = None
    for n in range(1, WORDS + 1):
        own = words.where(F.size("_words") == n) if n < WORDS else words.where(F.size("_words") >= n)
        rows = _shingles(own, ["item", "item_id"], n).select("item", "item_id", F.lit(n).alias("n"), _text(n).alias("shingle"), _hash(n).alias("hash"))
        found = rows if found is None else found.unionByName(rows)
    found = found.distinct()
    sizes = found.groupBy("item").agg(F.count("*").alias("n_item"))
    return checkpoint(found.join(sizes, "item"))


def sketches(shingles: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """(item, n, hash, part, need): the smallest hashes of each item, as many and with as many hits asked as its size partition says."""
    from pyspark.sql import Window

    order = Window.partitionBy("item").orderBy(F.xxhash64("hash"), "hash")  # one test item a window: short by definition
    ranked = shingles.withColumn("part", F.floor(F.log2("n_item")).cast("int")).withColumn("_r", F.row_number().over(order))
    size, need = F.lit(None).cast("int"), F.lit(None).cast("int")
    for largest, k in reversed(SKETCHES):
        size = F.when(F.col("part") <= largest, k).otherwise(size)
        need = F.when(F.col("part") <= largest, needed_hits(k, containment, MISS)).otherwise(need)
    need = F.when(F.col("n_item") <= size, F.ceil(F.col("n_item") * F.lit(containment) - F.lit(1e-9))).otherwise(need)
    return ranked.where(F.col("_r") <= size).select("item", "n", "hash", "part", need.cast("int").alias("need"))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", containment: float = CONTAINMENT, rows: int = BROADCAST_ROWS, keys: int = BROADCAST_KEYS) -> DataFrame:
    """(_id, _key, item_id, n_common, n_item, containment): the verified pairs. rows and keys bound what is broadcast."""
    shingles = items(benchmark)
    sketch = checkpoint(sketches(shingles, containment))
    lengths = [r["n"] for r in sketch.select("n").distinct().collect()]  # at most five values
    small = sketch.count() <= rows
    base = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_key"), F.col(text).alias("_t"))
    worded = base.select("_id", "_key", _words(F.col("_t")).alias("_words"))
    pairs = None
    for n in lengths:
        side = sketch.where(F.col("n") == n).select("hash", "item", "part", "need")
        probes = _shingles(worded, ["_id", "_key"], n).select("_id", "_key", _hash(n).alias("hash"))
        hits = probes.join(F.broadcast(side) if small else side, "hash").groupBy("_id", "_key", "part", "item").agg(F.count_distinct("hash").alias("hits"), F.min("need").alias("need"))
        own = hits.where("hits >= need").select("_id", "_key", "item", F.lit(n).alias("n"))
        pairs = own if pairs is None else pairs.unionByName(own)
    if pairs is None:
        pairs = base.select("_id", "_key", F.lit(None).cast("long").alias("item"), F.lit(1).alias("n")).where(F.lit(False))
    pairs = checkpoint(pairs)
    # candidates only: their whole shingle sets, counted as text
    found = checkpoint(pairs.select("_id", "_key").distinct())
    few = F.broadcast(found) if found.count() <= keys else found
    held = base.alias("b").join(few.alias("k"), F.col("b._id").eqNullSafe(F.col("k._id")) & (F.col("b._key") == F.col("k._key")), "left_semi")
    held = held.dropDuplicates(["_id", "_key"]).select("_id", "_key", _words(F.col("_t")).alias("_words"))
    verified = None
    wanted = shingles.select("item", "item_id", "n", "shingle", "n_item")
    for n in lengths or [WORDS]:
        mine = pairs.where(F.col("n") == n).select("_id", "_key", F.col("item").alias("_item"))
        known = wanted.where(F.col("n") == n).select("shingle", "item", "item_id", "n_item")
        have = _shingles(held, ["_id", "_key"], n).select("_id", "_key", _text(n).alias("shingle")).distinct()
        common = have.join(F.broadcast(known) if small and known.count() <= rows else known, "shingle")
        counted = common.groupBy("_id", "_key", "item", "item_id").agg(F.count("*").alias("n_common"), F.min("n_item").alias("n_item"))
        kept = counted.alias("c").join(mine.alias("m"), F.col("c._id").eqNullSafe(F.col("m._id")) & (F.col("c._key") == F.col("m._key")) & (F.col("c.item") == F.col("m._item")), "left_semi")
        verified = kept if verified is None else verified.unionByName(kept)
    verified = verified.drop("item").withColumn("containment", F.col("n_common") / F.col("n_item"))
    return verified.where(F.col("n_common") >= F.ceil(F.col("n_item") * F.lit(containment) - F.lit(1e-9)))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", containment: float = CONTAINMENT) -> DataFrame:
    """docs without the rows that contain a test item."""
    own_id, own_key = private(docs, "bad_id", "bad_key")
    bad = checkpoint(contaminated(docs, benchmark, id_col, text, containment).select(F.col("_id").alias(own_id), F.col("_key").alias(own_key)).distinct())
    few = F.broadcast(bad) if bad.count() <= BROADCAST_KEYS else bad
    return docs.join(few, docs[id_col].eqNullSafe(F.col(own_id)) & (F.xxhash64(docs[text]) == F.col(own_key)), "left_anti")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, test item) pair of at least 0.8 containment."""
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("_id").alias("doc_id"), "item_id", "n_common", F.col("n_item").cast("long").alias("n_item"), "containment")


def _oracle() -> str:
    sep = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
    ws = f"list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{sep}'), lambda x: x <> '')"
    return f"""
WITH b AS (SELECT item_id, {ws} AS ws FROM benchmark),
i AS (SELECT DISTINCT item_id, least(len(ws), {WORDS}) AS n, array_to_string(ws[k : k + least(len(ws), {WORDS}) - 1], ' ') AS shingle
      FROM (SELECT item_id, ws, unnest(range(1, len(ws) - least(len(ws), {WORDS}) + 2)) AS k FROM b WHERE len(ws) > 0)),
s AS (SELECT item_id, count(*) AS n_item FROM i GROUP BY item_id),
d AS (SELECT doc_id, {ws} AS ws FROM documents),
h AS (SELECT DISTINCT doc_id, n, array_to_string(ws[k : k + n - 1], ' ') AS shingle
      FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM i))),
c AS (SELECT doc_id, item_id, count(*) AS n_common FROM h JOIN i USING (n, shingle) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_common, n_item, n_common / n_item AS containment
FROM c JOIN s USING (item_id) WHERE n_common * 100 >= n_item * {int(CONTAINMENT * 100)}
"""


ORACLE_SQL = _oracle()
