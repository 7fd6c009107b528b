"""Identity: normalised identifiers, blocking components, resolution modes, parent constraints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gneiss.operators.components import connected_components

#: Limits of a component that is resolved automatically.
MAX_NODES = MAX_CANDIDATES = MAX_EDGES = 256


def normalise_identifiers(assertions: DataFrame, schemes: DataFrame) -> DataFrame:
    """Registered identifiers only: scheme by its trimmed lower-cased name, value by the scheme's pattern.

    The pattern is a column; schemes is a small registry. Values are upper-cased unless the scheme is case-sensitive."""
    rows = assertions.withColumn("_scheme", F.lower(F.trim("scheme"))).drop("scheme")
    joined = rows.join(schemes, F.col("_scheme") == schemes["scheme"])
    valid = joined.where(F.expr("trim(value) RLIKE pattern"))
    value = F.when(F.col("case_sensitive"), F.trim("value")).otherwise(F.upper(F.trim("value")))
    return valid.withColumn("normal", value).withColumn("blocking_key", F.concat_ws(":", "scheme", "normal")).drop("_scheme", "pattern", "case_sensitive")


def blocking_components(edges: DataFrame) -> DataFrame:
    """(node_id, component_id) of a bipartite graph (node_id, blocking_key): the smallest node of what shares keys.

    Every key is replaced by its smallest node, so a key with many nodes gives as many edges as it has nodes."""
    least = edges.groupBy("blocking_key").agg(F.min("node_id").alias("a"))
    pairs = edges.join(least, "blocking_key").select("a", F.col("node_id").alias("b")).distinct()
    return connected_components(pairs).select(F.col("node").alias("node_id"), F.col("component").alias("component_id"))


def component_stats(components: DataFrame, candidates: DataFrame, limit: int = MAX_CANDIDATES) -> DataFrame:
    """Node and candidate counts of each component; the candidates themselves only if they are few."""
    sizes = components.groupBy("component_id").agg(F.count_distinct("node_id").alias("n_nodes"))
    found = components.join(candidates, "node_id").select("component_id", "entity_key").distinct()
    counts = found.groupBy("component_id").agg(F.count("*").alias("n_candidates"))
    few = found.join(counts.where(F.col("n_candidates") <= limit), "component_id", "left_semi")
    lists = few.groupBy("component_id").agg(F.sort_array(F.collect_list("entity_key")).alias("candidate_keys"))
    joined = sizes.join(counts, "component_id", "left").join(lists, "component_id", "left")
    return joined.withColumn("n_candidates", F.coalesce("n_candidates", F.lit(0)))


def resolution_mode(stats: DataFrame, max_nodes: int = MAX_NODES, max_candidates: int = MAX_CANDIDATES) -> DataFrame:
    mode = (
        F.when((F.col("n_nodes") > max_nodes) | (F.col("n_candidates") > max_candidates), "OVERSIZED")
        .when(F.col("n_candidates") > 1, "MULTI")
        .when(F.col("n_candidates") == 1, "ACCEPT")
        .otherwise("BOOTSTRAP")
    )
    return stats.withColumn("mode", mode)


def bootstrap(components: DataFrame, stats: DataFrame) -> DataFrame:
    """(node_id, entity_key): members of a component without candidates share the key of its anchor."""
    new = components.join(stats.where("mode = 'BOOTSTRAP'"), "component_id", "left_semi")
    return new.select("node_id", F.concat(F.lit("sha256:"), F.sha2(F.col("component_id").cast("string"), 256)).alias("entity_key"))


def recheck(assigned: DataFrame, candidates: DataFrame) -> DataFrame:
    """Assigned nodes that an exact identifier sends elsewhere: (node_id, others)."""
    own = assigned.groupBy("node_id").agg(F.collect_set("entity_key").alias("_own"))
    found = candidates.groupBy("node_id").agg(F.collect_set("entity_key").alias("_found"))
    others = F.array_sort(F.array_except("_found", "_own"))
    return found.join(own, "node_id").select("node_id", others.alias("others")).where(F.size("others") > 0)


def unique_or_null(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """The value of a group that has only one, else null."""
    return df.groupBy(*keys).agg(F.when(F.count_distinct(value) == 1, F.min(value)).alias(name), F.count_distinct(value).alias(f"n_{name}"))


def parent_constrained(children: DataFrame, relations: DataFrame, ordinals: DataFrame, parents: DataFrame, scoped: Column | None = None) -> DataFrame:
    """Place children under parents: one relation, an ordinal on which field and qualifier agree, one parent entity.

    children(child, child_type); relations(child, parent, ordinal); ordinals(child, ordinal); parents(parent, parent_type, entity_key).
    scoped, over child, child_type and parent, says where one source's own ids may stand for an ordinal: a child without any ordinal and
    with exactly one relation row is then SCOPED, and its component is named by its own id under the parent entity."""
    link = relations.groupBy("child").agg(
        F.count("*").alias("n_relations"),
        F.count_distinct("parent").alias("n_parents"),
        F.min("parent").alias("parent"),
        F.count_distinct("ordinal").alias("n_said"),
        F.min("ordinal").alias("said"),
    )
    field = ordinals.groupBy("child").agg(F.count_distinct("ordinal").alias("n_field"), F.min("ordinal").alias("field"))
    owner = parents.groupBy("parent").agg(F.count_distinct("entity_key").alias("n_entities"), F.min("entity_key").alias("parent_entity"), F.min("parent_type").alias("parent_type"))
    rows = children.join(link, "child", "left").join(field, "child", "left").join(owner, "parent", "left")
    rows = rows.withColumn("ordinal", F.coalesce("field", "said"))
    mode = (
        F.when(F.coalesce(F.col("n_parents"), F.lit(0)) == 0, "NO_PARENT")
        .when(F.col("n_parents") > 1, "AMBIGUOUS_PARENT")
        .when(F.coalesce(F.col("parent_type"), F.lit("")) != F.col("child_type"), "PARENT_TYPE")
        .when(F.coalesce(F.col("n_entities"), F.lit(0)) != 1, "PARENT_UNRESOLVED")
        .when((F.coalesce("n_field", F.lit(0)) > 1) | (F.coalesce("n_said", F.lit(0)) > 1), "AMBIGUOUS_ORDINAL")
        .when(F.col("field") != F.col("said"), "ORDINAL_CONFLICT")
        .when(F.col("ordinal").isNull() & (F.col("n_relations") == 1) & F.coalesce(F.lit(False) if scoped is None else scoped, F.lit(False)), "SCOPED")
        .when(F.col("ordinal").isNull(), "NO_ORDINAL")
        .otherwise("PLACED")
    )
    component = F.sha2(F.concat_ws("|", "parent_entity", "child_type", F.col("ordinal").cast("string")), 256)
    own = F.sha2(F.concat_ws("|", "parent_entity", "child_type", F.lit("child"), F.col("child").cast("string")), 256)
    named = F.when(F.col("mode") == "PLACED", component).when(F.col("mode") == "SCOPED", own)
    return rows.withColumn("mode", mode).select("child", "mode", "parent_entity", "ordinal", named.alias("component"))


def merge_survivor(members: DataFrame) -> DataFrame:
    """(merge_id, survivor): the oldest entity of a merge, then the smallest key; mixed levels or kinds are left out."""
    return (
        members.groupBy("merge_id")
        .agg(F.min(F.struct("created_at", "entity_key")).alias("_s"), F.count_distinct("level", "kind").alias("_n"))
        .where("_n = 1")
        .select("merge_id", F.col("_s.entity_key").alias("survivor"))
    )


def strip_owned(incoming: DataFrame, pinned: DataFrame, keys: list[str]) -> DataFrame:
    """Incoming rows whose key no pinned row owns."""
    return incoming.join(pinned.select(*keys).distinct(), keys, "left_anti")


def foreign_collisions(incoming: DataFrame, pinned: DataFrame, keys: list[str]) -> DataFrame:
    """Incoming rows whose key a pinned row of another lineage owns."""
    others = pinned.select(*keys, F.col("lineage").alias("_lineage"))
    return incoming.join(others, keys).where("lineage <> _lineage").drop("_lineage")


def symmetric_difference(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that only one side has, and which; nulls are equal."""
    left, right = (x.select(*keys).distinct() for x in (a, b))
    return left.exceptAll(right).withColumn("side", F.lit("left")).unionByName(right.exceptAll(left).withColumn("side", F.lit("right")))


def close_memberships(worklist: DataFrame, memberships: DataFrame, at: Column, reason: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(closed, decisions, evidence) of inactive records that map to one node.

    worklist(record_id, status, node_id, entity_key) as lifecycle.revocations() gives it; memberships(membership_key, node_id, entity_key,
    valid_from, valid_to), one open row of a node at most. REVOKABLE rows close the open membership of their node and entity at `at`, once
    however many records ask for it; AMBIGUOUS ones leave evidence alone. A membership that begins after `at` is an error."""
    asked = worklist.where("status = 'REVOKABLE' AND entity_key IS NOT NULL").select("node_id", "entity_key").distinct()
    late = F.when(F.col("valid_from") > at, F.raise_error("a revocation precedes its membership"))
    closed = memberships.where("valid_to IS NULL").join(asked, ["node_id", "entity_key"], "left_semi").withColumn("valid_to", F.coalesce(late, at))
    decision = F.sha2(F.concat_ws("|", F.lit("REVOKE"), F.col("node_id").cast("string"), F.col("entity_key").cast("string"), F.col("valid_to").cast("string")), 256)
    decisions = closed.select(decision.alias("decision_key"), F.lit("REVOKE").alias("action"), "node_id", "entity_key", "membership_key", F.lit(reason).alias("reason"))
    kinds = F.when(F.col("status") == "AMBIGUOUS", "INACTIVE_MAPPING_CONFLICT").otherwise("INACTIVE_RECORD")
    evidence = worklist.where("status <> 'UNMAPPED' AND (status = 'AMBIGUOUS' OR entity_key IS NOT NULL)").select("record_id", kinds.alias("kind"), "node_id", "entity_key").distinct()
    return closed, decisions, evidence


def fan_out(results: DataFrame, tables: dict[str, tuple[str, list[str]]]) -> dict[str, DataFrame]:
    """Rows of each table from one frame of results, each key once.

    results has an array of structs for each table; tables maps a name to that array's column and the key columns. Of rows that share a
    key the smallest stays, in the order of the struct's fields, so repeated runs write the same rows. Null arrays give no rows."""
    out = {}
    for name, (column, keys) in tables.items():
        rows = results.select(F.explode(column).alias("_r"))
        once = rows.groupBy(*[F.col(f"_r.{k}").alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.min("_r").alias("_r"))
        out[name] = once.select("_r.*")
    return out
