"""Versioned Parquet tables: commit-last transactions, insert-only merges, time travel, compaction."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gneiss.session import materialize


COMPACTED = "~compacted"


class VersionedTable:
    """Parts in run=<id> folders; a run exists once its commit file does. A snapshot is the list of the runs it saw."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), self.spark._jvm.org.apache.hadoop.fs.Path

    def commits(self) -> list[dict]:
        """Commits in order of their sequence number."""
        fs, path = self._fs()
        at = path(f"{self.path}/_commits")
        if not fs.exists(at):
            return []
        found = self.spark.read.text(f"{self.path}/_commits").collect()  # one short line a commit
        return sorted((json.loads(r[0]) for r in found), key=lambda c: c["sequence"])

    def commit(self, run_id: str, rows: DataFrame) -> dict:
        """Stage rows, check their count, publish the commit last. A repeated run returns its first commit."""
        for c in self.commits():
            if c["run_id"] == run_id:
                return c
        if COMPACTED in run_id:
            raise ValueError(f"{COMPACTED} is not allowed in a run's name")
        return self._publish(run_id, run_id, rows)

    def _publish(self, run_id: str, folder: str, rows: DataFrame) -> dict:
        target = f"{self.path}/run={folder}"
        rows.write.mode("overwrite").parquet(target)  # an uncommitted earlier try is overwritten
        n = self.spark.read.parquet(target).count()
        entry = {"sequence": len(self.commits()) + 1, "run_id": run_id, "folder": folder, "rows": n}
        fs, path = self._fs()
        fs.mkdirs(path(f"{self.path}/_commits"))
        name = path(f"{self.path}/_commits/{entry['sequence']:09d}.json")
        out = fs.create(name, False)  # fails if another writer took the number
        out.write(bytearray(json.dumps(entry, sort_keys=True).encode()))
        out.close()
        return entry

    def read(self, sequence: int | None = None) -> DataFrame | None:
        """All rows of a snapshot with run_id; None if the table has none yet."""
        seen = [c for c in self.commits() if sequence is None or c["sequence"] <= sequence]
        if not seen:
            return None
        # of each run the folder that was written last; one scan over the list, whatever its length
        folders = {c["run_id"]: c.get("folder", c["run_id"]) for c in seen}
        rows = self.spark.read.option("basePath", self.path).option("mergeSchema", "true").parquet(*[f"{self.path}/run={f}" for f in folders.values()])
        return rows.withColumn("run_id", F.regexp_replace(F.col("run").cast("string"), f"{COMPACTED}[0-9]+$", "")).drop("run")

    def merge(self, run_id: str, rows: DataFrame, keys: list[str], required: list[str] = ()) -> dict:
        """Insert rows whose key is new; nulls in required columns are errors."""
        bad = rows.where(F.greatest(*[F.col(c).isNull().cast("int") for c in [*keys, *required]], F.lit(0)) > 0)
        if not bad.isEmpty():
            raise ValueError("null in a required column")
        rest = [c for c in rows.columns if c not in keys]  # of rows with one key the smallest stays, whatever the order
        fresh = rows.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row")).select(*keys, "_row.*") if rest else rows.distinct()
        held = self.read()
        if held is not None:
            fresh = fresh.join(held.select(*keys), keys, "left_anti")
        return self.commit(run_id, materialize(fresh, "merge"))

    def compact(self, run_id: str, files: int) -> dict:
        """The rows of a run in fewer files: a new folder and a new commit. Earlier snapshots still read the old folder, until expire()."""
        held = [c for c in self.commits() if c["run_id"] == run_id]
        rows = self.spark.read.parquet(f"{self.path}/run={held[-1].get('folder', run_id)}")
        entry = self._publish(run_id, f"{run_id}{COMPACTED}{len(held)}", rows.repartition(files))
        if entry["rows"] != held[-1]["rows"]:
            raise ValueError("compaction changed the number of rows")
        return entry

    def expire(self) -> list[str]:
        """Delete folders that a later compaction has replaced, and folders without a commit; returns their names. Snapshots before the compaction can then not be read."""
        fs, path = self._fs()
        last = {c["run_id"]: c.get("folder", c["run_id"]) for c in self.commits()}
        found = [f.getPath().getName() for f in fs.listStatus(path(self.path))]
        gone = sorted(n for n in found if n.startswith("run=") and n[4:] not in last.values())
        for name in gone:
            fs.delete(path(f"{self.path}/{name}"), True)
        return gone

    def rollback(self, sequence: int) -> None:
        """Withdraw the commits after a snapshot, the last one first."""
        fs, path = self._fs()
        for c in sorted(self.commits(), key=lambda c: -c["sequence"]):
            if c["sequence"] > sequence:
                fs.delete(path(f"{self.path}/_commits/{c['sequence']:09d}.json"), False)


def write_sorted(df: DataFrame, path: str, key: str) -> None:
    """Range-partitioned, sorted Parquet."""
    df.repartitionByRange(key).sortWithinPartitions(key).write.parquet(path)


def write_shards(df: DataFrame, path: str, shard: str, order: str, payload: str, shards: int) -> None:
    """One folder of text for each shard, in order."""
    df.repartition(shards, shard).sortWithinPartitions(shard, order).select(shard, F.col(payload).alias("value")).write.partitionBy(shard).text(path)


def write_documents(df: DataFrame, path: str, key: str, parts: int) -> DataFrame:
    """Bulk sink: JSON documents, and a receipt (part, documents, digest) of each part."""
    placed = df.withColumn("_part", F.pmod(F.xxhash64(key), F.lit(parts)).cast("int"))
    body = placed.select("_part", F.to_json(F.struct(*df.columns)).alias("value"))
    body.repartition(parts, "_part").write.partitionBy("_part").text(path)
    return body.groupBy(F.col("_part").alias("part")).agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(value))").alias("digest"))


def write_in_groups(df: DataFrame, path: str, group: str, done: set) -> list:
    """Resumable checkpoint: groups without a receipt are written; returns all groups with one.

    A group's folder is replaced, not added to, so a run after a crash doubles no rows."""
    todo = df.where(~F.col(group).isin(list(done))) if done else df
    groups = [r[0] for r in todo.select(group).distinct().collect()]  # groups are the run's shards: a list that the caller made
    todo.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(group).parquet(path)
    return sorted({*done, *groups})


def write_summary(df: DataFrame, path: str, shard: str, measure: str) -> DataFrame:
    """(shard, n, total): written and read again, so that what follows sees what was stored."""
    df.groupBy(shard).agg(F.count("*").alias("n"), F.sum(measure).alias("total")).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_pages(df: DataFrame, path: str, key: str, size: int) -> None:
    """An ordered manifest: JSON lines in folders page=0, 1, ... of `size` rows each, by key. Counts of ranges give each row its place, so no task sees all rows."""
    rows = materialize(df.repartitionByRange(key).sortWithinPartitions(key).withColumn("_p", F.spark_partition_id()).withColumn("_o", F.monotonically_increasing_id()), "pages")
    sizes = rows.groupBy("_p").agg(F.count("*").alias("_n"), F.min("_o").alias("_least"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))  # a row a range
    placed = rows.join(before, "_p").withColumn("position", F.col("_before") + F.col("_o") - F.col("_least")).withColumn("page", F.floor(F.col("position") / size))
    out = placed.select("page", "position", F.to_json(F.struct(*df.columns)).alias("value")).repartition("page").sortWithinPartitions("page", "position")
    out.select("page", "value").write.partitionBy("page").text(path)
