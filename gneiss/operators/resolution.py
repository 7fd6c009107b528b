"""Gold resolution: rights, rules, priority-ranked values that keep their conflicts, quality and freshness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Highest shares that pass the quality gate.
MAX_CONFLICT_SHARE = MAX_UNRESOLVED_SHARE = 0.05
#: Counts that must be 0, in the order in which the gate names them.
GATE_COUNTS = (
    "ORPHAN_EPISODE_COUNT",
    "ORPHAN_SEASON_COUNT",
    "DUPLICATE_EXTERNAL_ID_COUNT",
    "BROKEN_PARENT_COUNT",
    "EXACT_ID_CONFLICT_COUNT",
    "MISSING_RAW_CITATION_COUNT",
    "MISSING_OBSERVATION_KEY_COUNT",
)


def eligible(assertions: DataFrame, rights: DataFrame, fences: DataFrame, at: Column) -> DataFrame:
    """Assertions with a column `outcome`: FENCED, NO_RIGHTS, EXPIRED_LEASE, NOT_VALID or ELIGIBLE, the first that holds.

    rights (policy_id, allowed, max_age_days) and fences (source) are small tables of the release; Catalyst broadcasts
    them by their size."""
    rows = assertions.join(rights, "policy_id", "left").join(fences.select("source", F.lit(True).alias("_fenced")).distinct(), "source", "left")
    lease = F.col("max_age_days").isNotNull() & (F.col("observed_at") + F.make_dt_interval(F.col("max_age_days")) <= at)
    valid = (F.col("valid_from").isNull() | (F.col("valid_from") <= at)) & (F.col("valid_to").isNull() | (F.col("valid_to") > at))
    outcome = (
        F.when(F.col("_fenced"), "FENCED")
        .when(~F.coalesce("allowed", F.lit(False)), "NO_RIGHTS")
        .when(lease, "EXPIRED_LEASE")
        .when(~valid, "NOT_VALID")
        .otherwise("ELIGIBLE")
    )
    return rows.withColumn("outcome", outcome).drop("_fenced", "allowed", "max_age_days")


def with_rule(assertions: DataFrame, rules: DataFrame, default: str = "NEVER_RESOLVE") -> DataFrame:
    """The rule of each predicate; predicates without one are never resolved."""
    return assertions.join(rules, "predicate", "left").withColumn("operator", F.coalesce("operator", F.lit(default)))


def _supported(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """One row for each key and value: its best rank and all supporting assertions."""
    return df.groupBy(*keys, value).agg(F.min("source_rank").alias("rank"), F.min_by("assertion_id", F.struct("source_rank", "assertion_id")).alias("winner"), F.sort_array(F.collect_set("assertion_id")).alias("support"))


def resolve_single(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The value of the best-ranked source; several values at that rank are a conflict.

    Two levels: values first (partial aggregation), then keys, so a hot key holds its distinct values only."""
    values = _supported(df, keys, value)
    best = values.groupBy(*keys).agg(F.min("rank").alias("_best"))
    top = values.join(best, keys).where("rank = _best")
    done = top.groupBy(*keys).agg(F.count("*").alias("n_values"), F.min_by(value, "winner").alias("value"), F.min("winner").alias("winner"), F.array_sort(F.flatten(F.collect_list("support"))).alias("support"))
    return done.withColumn("status", F.when(F.col("n_values") == 1, "SELECTED").otherwise("CONFLICTED"))


def resolve_set(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Every distinct value with all its support (both for unions and for keeping all)."""
    return _supported(df, keys, value).withColumn("status", F.lit("SET"))


def resolve_relations(df: DataFrame, keys: list[str], value: str) -> tuple[DataFrame, DataFrame]:
    """(relations, conflicts) of single-valued relations: several objects at the best rank give a conflict and no relation."""
    done = resolve_single(df, keys, value)
    return done.where("status = 'SELECTED'"), done.where("status = 'CONFLICTED'")


def identifier_collisions(identifiers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, collisions): keys of more than one entity withhold all their rows."""
    shared = identifiers.groupBy("blocking_key").agg(F.sort_array(F.collect_set("entity_key")).alias("entities")).where(F.size("entities") > 1)
    return identifiers.join(shared, "blocking_key", "left_anti"), shared.withColumn("reason", F.lit("DUPLICATE_EXTERNAL_IDENTIFIER"))


def single_slot(projected: DataFrame) -> DataFrame:
    """Identifier assertions that fit exactly one slot."""
    slots = projected.groupBy("assertion_id").agg(F.count_distinct("slot").alias("_n")).where("_n = 1")
    return projected.join(slots, "assertion_id").drop("_n").dropDuplicates(["assertion_id"])


def observations(history: DataFrame, winners: DataFrame) -> DataFrame:
    """All historical assertions once, with whether they won."""
    won = winners.select("assertion_id", F.lit(True).alias("_won")).distinct()
    return history.dropDuplicates(["assertion_id"]).join(won, "assertion_id", "left").withColumn("is_winning", F.coalesce("_won", F.lit(False))).drop("_won")


def supersede(df: DataFrame) -> DataFrame:
    """Within an observation key: what another assertion supersedes goes, then only the latest stay."""
    gone = df.where("supersedes is not null").select("observation_key", F.col("supersedes").alias("assertion_id")).distinct()
    left = df.join(gone, ["observation_key", "assertion_id"], "left_anti")
    newest = left.groupBy("observation_key").agg(F.max("observed_at").alias("_at"))
    return left.join(newest, "observation_key").where("observed_at = _at").drop("_at")


def entity_summary(memberships: DataFrame, classes: DataFrame) -> DataFrame:
    """Nodes and class of each entity; more than one class is inconsistent and gives none."""
    rows = memberships.join(classes, "node_id", "left").groupBy("entity_key")
    return rows.agg(
        F.count_distinct("node_id").alias("n_nodes"),
        F.when(F.count_distinct("class") == 1, F.min("class")).alias("class"),
        (F.count_distinct("class") > 1).alias("inconsistent"),
    )


def orphans(children: DataFrame, relations: DataFrame) -> DataFrame:
    """Children without any parent relation, by type."""
    return children.join(relations.select("child").distinct(), "child", "left_anti").groupBy("child_type").agg(F.count("*").alias("n_orphans"))


def quality_report(metrics: DataFrame, violations: list[str]) -> DataFrame:
    """One row: shares, whether they pass, and the names of violated counts. metrics is one row of counts."""
    conflict = F.col("n_conflicts") / F.greatest(F.col("n_resolutions"), F.lit(1))
    unresolved = F.col("n_unresolved") / F.greatest(F.col("n_lookups"), F.lit(1))
    named = F.array_compact(F.array(*[F.when(F.col(v) > 0, F.lit(v)) for v in violations]))
    report = metrics.select(conflict.alias("conflict_share"), unresolved.alias("unresolved_share"), F.array_join(named, ",").alias("violations"))
    passed = (F.col("conflict_share") <= MAX_CONFLICT_SHARE) & (F.col("unresolved_share") <= MAX_UNRESOLVED_SHARE) & (F.col("violations") == "")
    return report.withColumn("passed", passed)


def release_gate(counts: DataFrame, attribution_differs: DataFrame, stale: DataFrame) -> DataFrame:
    """One row: conflict_share, unresolved_share, violations (array) and passed.

    counts is one row: n_conflicts, n_resolutions, n_fields, n_identifiers, n_relations, n_unresolved and GATE_COUNTS in lower case; null
    counts as 0. Lookups are the resolved ends (fields, identifiers, both ends of relations) and the unresolved ones; without any, a share
    is 0. attribution_differs: rows of attribution_mismatch(). stale(source): sources whose age blocks a release; each is named, sorted.
    Negative counts and more conflicts than resolutions are errors."""
    known = ["n_conflicts", "n_resolutions", "n_fields", "n_identifiers", "n_relations", "n_unresolved", *[g.lower() for g in GATE_COUNTS]]
    # three frames of one row: a union of them needs no cross join
    differs = attribution_differs.agg(F.count("*").alias("_differs"))
    names = stale.agg(F.sort_array(F.collect_set("source")).alias("_stale"))
    parts = counts.select(*known).unionByName(differs, True).unionByName(names, True)
    one = parts.agg(*[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in [*known, "_differs"]], F.max("_stale").alias("_stale"))
    wrong = F.when(F.least(*known) < 0, F.raise_error("negative counts")).when(F.col("n_conflicts") > F.col("n_resolutions"), F.raise_error("more conflicts than resolutions"))
    lookups = F.col("n_fields") + F.col("n_identifiers") + 2 * F.col("n_relations") + F.col("n_unresolved")
    share = lambda n, of: F.when(of > 0, n / of).otherwise(0.0)
    rows = one.select("*", share(F.col("n_conflicts"), F.col("n_resolutions")).alias("conflict_share"), share(F.col("n_unresolved"), lookups).alias("unresolved_share"), wrong.alias("_wrong"))
    named = F.array_compact(
        F.array(
            F.when(F.col("conflict_share") > MAX_CONFLICT_SHARE, "FIELD_CONFLICT_RATIO"),
            F.when(F.col("unresolved_share") > MAX_UNRESOLVED_SHARE, "UNRESOLVED_IDENTITY_RATIO"),
            *[F.when(F.col(g.lower()) > 0, F.concat(F.lit(f"{g}:"), F.col(g.lower()).cast("string"))) for g in GATE_COUNTS],
            F.when(F.col("_differs") > 0, "ATTRIBUTION_COUNTS_MISMATCH"),
        )
    )
    violations = F.concat(named, F.transform("_stale", lambda x: F.concat(F.lit("SOURCE_FRESHNESS:"), x)))
    return rows.select("conflict_share", "unresolved_share", violations.alias("violations"), (F.col("_wrong").isNull() & (F.size(violations) == 0)).alias("passed"))


def freshness(runs: DataFrame, policy: DataFrame, at: Column) -> DataFrame:
    """Each source's latest run of each completeness, its age in hours against the policy."""
    last = runs.groupBy("source").agg(
        F.max(F.when(F.col("completeness") == "COMPLETE", F.col("acquired"))).alias("complete_at"),
        F.max(F.when(F.col("completeness") == "DELTA", F.col("acquired"))).alias("delta_at"),
        F.max(F.when(F.col("completeness") == "PARTIAL", F.col("acquired"))).alias("partial_at"),
        F.max_by("run_id", F.struct("acquired", "run_id")).alias("latest_run"),
    )
    rows = policy.join(last, "source", "left")
    usable = F.greatest("complete_at", "delta_at")
    age = F.floor((F.unix_timestamp(at) - F.unix_timestamp(usable)) / 3600)
    return rows.withColumn("age_hours", age).withColumn("status", F.when(usable.isNull(), "MISSING").when(F.col("age_hours") > F.col("max_age_hours"), "STALE").otherwise("FRESH")).drop("max_age_hours")


def attribution(frames: list[DataFrame]) -> DataFrame:
    """Assertions used by any product, once each, counted by product and policy."""
    rows = frames[0].select("assertion_id", "product", "policy_id")
    for f in frames[1:]:
        rows = rows.unionByName(f.select("assertion_id", "product", "policy_id"))
    once = rows.groupBy("assertion_id").agg(F.min(F.struct("product", "policy_id")).alias("_u"))
    return once.groupBy(F.col("_u.product").alias("product"), F.col("_u.policy_id").alias("policy_id")).agg(F.count("*").alias("n_assertions"))


def attribution_mismatch(said: DataFrame, counted: DataFrame) -> DataFrame:
    a, b = said.withColumnRenamed("n_assertions", "said"), counted.withColumnRenamed("n_assertions", "counted")
    return a.join(b, ["product", "policy_id"], "full").where(~F.col("said").eqNullSafe(F.col("counted")))


def remove_source(df: DataFrame, sources: DataFrame) -> DataFrame:
    return df.join(sources.select("source").distinct(), "source", "left_anti")


def match_decision(coordinates: DataFrame, margin: float) -> DataFrame:
    """EXACT, REVIEW_REQUIRED or ABSTAIN for each asset from its scored candidates (asset, candidate, score, exact)."""
    order = Window.partitionBy("asset").orderBy(F.col("exact").desc(), F.col("score").desc(), "candidate")
    rows = coordinates.withColumn("_r", F.row_number().over(order)).withColumn("_next", F.lead("score").over(order)).withColumn("_next_exact", F.lead("exact").over(order))
    top = rows.where("_r = 1")
    decision = (
        F.when(F.col("exact") & ~F.coalesce("_next_exact", F.lit(False)), "EXACT")
        .when(F.col("exact") | (F.col("score") - F.coalesce("_next", F.lit(0.0)) >= margin), "REVIEW_REQUIRED")
        .otherwise("ABSTAIN")
    )
    return top.select("asset", decision.alias("decision"), F.when(decision != "ABSTAIN", F.col("candidate")).alias("candidate"))


def calibrate(value: Column, points: list[tuple[float, float]]) -> Column:
    """Piecewise linear score through calibration points, flat outside."""
    out = F.when(value <= points[0][0], F.lit(points[0][1]))
    for (x0, y0), (x1, y1) in zip(points, points[1:]):
        out = out.when(value <= x1, F.lit(y0) + (value - x0) * F.lit((y1 - y0) / (x1 - x0)))
    return out.otherwise(F.lit(points[-1][1]))
