"""Source-record lifecycle: which version of a record is current, and which records are gone."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def effective(valid_from: str, valid_to: str, at: Column) -> Column:
    """Half-open interval [from, to); an open end never ends."""
    return (F.col(valid_from) <= at) & (F.col(valid_to).isNull() | (F.col(valid_to) > at))


def is_active(at: Column) -> Column:
    """An upsert within its validity that has not expired."""
    started = F.col("valid_from").isNull() | (F.col("valid_from") <= at)
    open_ = F.col("valid_to").isNull() | (F.col("valid_to") > at)
    return (F.col("operation") == "UPSERT") & started & open_ & (F.col("expires_at").isNull() | (F.col("expires_at") > at))


def is_inactive(at: Column) -> Column:
    """Not the negation of is_active: an upsert that has not started yet is neither."""
    ended = F.coalesce(F.col("valid_to") <= at, F.lit(False)) | F.coalesce(F.col("expires_at") <= at, F.lit(False))
    return (F.coalesce(F.col("operation"), F.lit("")) != "UPSERT") | ended


def latest(events: DataFrame, keys: list[str], times: list[str], ties: list[str]) -> DataFrame:
    """The latest event of each record: by times, then non-upserts before upserts, then ties, all descending, nulls last.

    max_by over a struct of the ordering: aggregated before the shuffle, so a hot record is no long window."""
    order = F.struct(
        *[F.struct(F.col(t).isNotNull().alias("known"), F.col(t).alias("value")) for t in times],
        (F.col("operation") != "UPSERT").alias("final"),
        *[F.struct(F.col(t).isNotNull().alias("known"), F.col(t).alias("value")) for t in ties],
    )
    row = F.max_by(F.struct(*[c for c in events.columns if c not in keys]), order)
    return events.groupBy(*keys).agg(row.alias("_row")).select(*keys, "_row.*")


def effective_memberships(memberships: DataFrame, at: Column) -> DataFrame:
    """One version of each membership as of a time: closed before open, earliest close, largest key."""
    order = Window.partitionBy("node_id", "entity_key").orderBy(F.col("valid_to").isNull(), F.col("valid_to"), F.col("membership_key").desc())
    started = memberships.where(F.col("valid_from") <= at)
    best = started.withColumn("_r", F.row_number().over(order)).where("_r = 1").drop("_r")
    return best.where(F.col("valid_to").isNull() | (F.col("valid_to") > at))


def closure_conflicts(memberships: DataFrame) -> DataFrame:
    """Memberships closed at more than one time."""
    closed = memberships.where("valid_to is not null").groupBy("node_id", "entity_key", "valid_from")
    return closed.agg(F.count_distinct("valid_to").alias("n_closures")).where("n_closures > 1")


def snapshot_absences(records: DataFrame, batches: DataFrame, domain: list[str]) -> DataFrame:
    """Records that the snapshot before had and this one has not.

    batches: domain, run_id, acquired; records: domain, record_id, run_id. The previous run comes from a lag over each
    domain's batches (few rows), records meet it by equality, and the difference is an anti-join."""
    order = Window.partitionBy(*domain).orderBy("acquired", "run_id")
    steps = batches.withColumn("previous_run", F.lag("run_id").over(order)).where("previous_run is not null").drop("acquired")
    had = records.withColumnRenamed("run_id", "previous_run").join(steps, [*domain, "previous_run"])
    now = records.select(*domain, "run_id", "record_id")
    return had.join(now, [*domain, "run_id", "record_id"], "left_anti").select(*domain, "run_id", "previous_run", "record_id").distinct()


def interval_changes(events: DataFrame, batches: DataFrame, domain: list[str], bucket_seconds: int = 86_400) -> DataFrame:
    """Events of each batch's interval [previous acquired, acquired).

    Equality on the domain and a bucket of time, then the range: a domain's intervals tile its time, so an event meets the one or two
    intervals that touch its bucket, and a hot domain is spread over its buckets."""
    order = Window.partitionBy(*domain).orderBy("acquired", "run_id")
    bucket = lambda c: F.floor(F.unix_timestamp(F.col(c).cast("timestamp")) / bucket_seconds)
    spans = batches.withColumn("since", F.lag("acquired").over(order)).where("since is not null")
    spans = spans.withColumn("_bucket", F.explode(F.sequence(bucket("since"), bucket("acquired"))))
    met = events.withColumn("_bucket", bucket("at")).join(spans, [*domain, "_bucket"])
    return met.where((F.col("at") >= F.col("since")) & (F.col("at") < F.col("acquired"))).drop("_bucket")


def revocations(inactive: DataFrame, nodes: DataFrame, memberships: DataFrame) -> DataFrame:
    """Inactive records by the number of nodes they map to, with the open membership of a single one."""
    mapped = inactive.select("record_id").distinct().join(nodes, "record_id", "left").groupBy("record_id").agg(F.sort_array(F.collect_set("node_id")).alias("node_ids"))
    kinds = mapped.withColumn("status", F.when(F.size("node_ids") == 0, "UNMAPPED").when(F.size("node_ids") > 1, "AMBIGUOUS").otherwise("REVOKABLE"))
    single = kinds.withColumn("node_id", F.when(F.col("status") == "REVOKABLE", F.get("node_ids", F.lit(0))))
    return single.join(memberships.where("valid_to is null").select("node_id", "entity_key"), "node_id", "left").select("record_id", "status", "node_id", "entity_key")


def check_all(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Counts of violated conditions in one pass: one row."""
    return df.agg(*[F.count_if(c).alias(name) for name, c in checks.items()])


def require_none(df: DataFrame, checks: dict[str, Column]) -> None:
    """Fail closed: an error that names every violated condition."""
    found = {k: v for k, v in check_all(df, checks).first().asDict().items() if v}
    if found:
        raise ValueError(f"violations: {found}")


def current_assertions(assertions: DataFrame, envelopes: DataFrame, at: Column, keys: list[str]) -> DataFrame:
    """Active assertions whose envelope is current."""
    live = assertions.where((F.col("status") == "ACTIVE") & (F.col("valid_to").isNull() | (F.col("valid_to") > at)))
    return live.join(envelopes.select(*keys).distinct(), keys, "left_semi")


def bind_records(records: DataFrame, runs: DataFrame, committed: DataFrame) -> DataFrame:
    """Records of committed runs with their run's metadata; unknown runs, double runs and wrong counts are errors."""
    known = runs.join(committed, "run_id", "left_semi")
    per_run = records.groupBy("run_id").agg(F.count("*").alias("found"))
    both = known.groupBy("run_id").agg(F.count("*").alias("rows"), F.max("record_count").alias("declared")).join(per_run, "run_id", "full")
    require_none(
        both,
        {
            "orphan_records": F.col("rows").isNull(),
            "double_runs": F.coalesce(F.col("rows") > 1, F.lit(False)),
            "wrong_counts": F.coalesce(F.col("declared") != F.coalesce("found", F.lit(0)), F.lit(False)),
        },
    )
    return records.join(known, "run_id")


def pending_runs(runs: DataFrame, used: DataFrame) -> DataFrame:
    """Runs that no earlier build has in its JSON list of inputs."""
    seen = used.select(F.explode(F.from_json("input_runs_json", "array<string>")).alias("run_id")).distinct()
    return runs.join(seen, "run_id", "left_anti")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
