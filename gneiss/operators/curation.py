"""Curation decisions over pinned identity state, and music match rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gneiss.operators.lifecycle import require_none


def apply_decisions(memberships: DataFrame, entities: DataFrame, decisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(memberships, redirects) after ACCEPT, REJECT, MERGE, SPLIT and REDIRECT.

    memberships(node_id, entity_key); entities(entity_key, created_at, level, kind);
    decisions(decision_id, action, node_id, entity_key, target_key). ACCEPT and SPLIT move a node, REJECT takes it out,
    MERGE keeps the older entity, REDIRECT points a key elsewhere. Unknown entities, two moves of one node and merges
    across levels or kinds are errors. Decisions may be as many as entities: joins are sort-merge ones, since Spark's estimate of rows that
    came from arrays is far too low and it would broadcast all of them through the driver."""
    keyed = decisions.where("action IN ('MERGE', 'REDIRECT')")
    ends = keyed.select("decision_id", F.explode(F.array("entity_key", "target_key")).alias("entity_key"))
    known = ends.join(entities.hint("merge"), "entity_key", "left")
    merged = known.join(keyed.where("action = 'MERGE'").select("decision_id").hint("merge"), "decision_id", "left_semi").groupBy("decision_id").agg(F.count_distinct("level", "kind").alias("kinds"))
    moves = decisions.where("action IN ('ACCEPT', 'SPLIT', 'REJECT')").groupBy("node_id").agg(F.count("*").alias("moves"))
    require_none(known, {"unknown_entities": F.col("created_at").isNull()})
    require_none(merged, {"mixed_merges": F.col("kinds") > 1})
    require_none(moves, {"double_moves": F.col("moves") > 1})
    age = entities.select("entity_key", F.struct("created_at", "entity_key").alias("age"))
    target = age.select(F.col("entity_key").alias("target_key"), F.col("age").alias("target_age"))
    pair = keyed.join(age.hint("merge"), "entity_key").join(target.hint("merge"), "target_key")
    older = (F.col("action") == "MERGE") & (F.col("age") < F.col("target_age"))
    redirects = pair.select(F.when(older, F.col("target_key")).otherwise(F.col("entity_key")).alias("source"), F.when(older, F.col("entity_key")).otherwise(F.col("target_key")).alias("target"))
    moved = decisions.where("action IN ('ACCEPT', 'SPLIT', 'REJECT')").select("node_id", "action", F.col("target_key").alias("_to"))
    rows = memberships.join(moved, "node_id", "full").where("action IS NULL OR action <> 'REJECT'")
    return rows.select("node_id", F.coalesce("_to", "entity_key").alias("entity_key")), redirects


def music_exactness(df: DataFrame) -> DataFrame:
    """Exact: a recording with a recording identifier, no conflicts and at most one variant signal."""
    return df.withColumn("exact", (F.col("kind") == "recording") & F.col("recording_id").isNotNull() & (F.col("n_conflicts") == 0) & (F.col("n_variants") <= 1))


def affected_keys(changed: DataFrame, relations: DataFrame, key: str = "entity_key") -> DataFrame:
    """Entities to project again: the changed ones and those related to them on either side."""
    near = relations.select(F.col("a").alias(key), F.col("b").alias("other")).unionByName(relations.select(F.col("b").alias(key), F.col("a").alias("other")))
    reached = near.join(changed.select(F.col(key).alias("other")), "other", "left_semi").select(key)
    return changed.select(key).unionByName(reached).distinct()
