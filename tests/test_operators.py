"""Edge cases of the catalog operators on small frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gneiss.operators import closure, composites, curation, digests, identity, lifecycle, projection, resolution
from gneiss.operators.components import connected_components


def test_components_chain_hub_loop_and_empty(spark):
    chain = [(i, i + 1) for i in range(1, 13)]
    hub = [(100, 100 + i) for i in range(1, 50)]
    found = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(chain + hub + [(7, 7), (500, 500)], "a long, b long")).collect()}
    assert {found[i] for i in range(1, 14)} == {1}
    assert {found[100 + i] for i in range(50)} == {100}
    assert found[500] == 500
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_closure_cycles_and_redirect_errors(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (5, 6)], "source long, target long")
    reached = closure.closure(spark.createDataFrame([("x", 1)], "label string, node long"), edges)
    assert {(r["node"], r["hops"]) for r in reached.collect()} == {(1, 0), (2, 1), (3, 2)}
    with pytest.raises(ValueError, match="cycle"):
        closure.chase(edges)
    with pytest.raises(ValueError, match="several"):
        closure.chase(spark.createDataFrame([(1, 2), (1, 3)], "source long, target long"))


def test_latest_prefers_delete_on_ties_and_knows_nulls(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [("a", "UPSERT", t, 2), ("a", "DELETE", t, 1), ("b", "UPSERT", None, 1), ("b", "UPSERT", t, 0)]
    got = {r["k"]: (r["operation"], r["n"]) for r in lifecycle.latest(spark.createDataFrame(rows, "k string, operation string, at timestamp, n int"), ["k"], ["at"], ["n"]).collect()}
    assert got == {"a": ("DELETE", 1), "b": ("UPSERT", 0)}


def test_active_and_inactive_are_not_complements(spark):
    t = dt.datetime(2024, 1, 1)
    later = t + dt.timedelta(days=9)
    rows = [("now", "UPSERT", t, None, None), ("future", "UPSERT", later, None, None), ("ended", "UPSERT", t, t, None), ("gone", "DELETE", t, None, None), ("unknown", None, t, None, None)]
    df = spark.createDataFrame(rows, "k string, operation string, valid_from timestamp, valid_to timestamp, expires_at timestamp")
    at = F.lit(t)
    assert {r["k"] for r in df.where(lifecycle.is_active(at)).collect()} == {"now"}
    assert {r["k"] for r in df.where(lifecycle.is_inactive(at)).collect()} == {"ended", "gone", "unknown"}


def test_bind_records_fails_closed(spark):
    records = spark.createDataFrame([("r1", 1), ("r1", 2)], "run_id string, x int")
    runs = spark.createDataFrame([("r1", 3)], "run_id string, record_count long")
    with pytest.raises(ValueError, match="wrong_counts"):
        lifecycle.bind_records(records, runs, runs.select("run_id"))
    with pytest.raises(ValueError, match="orphan_records"):
        lifecycle.bind_records(records, runs, runs.select("run_id").limit(0))


def test_single_keeps_conflicts_and_support(spark):
    rows = [("e", "p", "Alpha", 0, "a1"), ("e", "p", "Alpha", 1, "a2"), ("e", "p", "Beta", 1, "b1"), ("f", "p", "X", 0, "x"), ("f", "p", "Y", 0, "y")]
    df = spark.createDataFrame(rows, "entity string, predicate string, value string, source_rank int, assertion_id string")
    got = {r["entity"]: r for r in resolution.resolve_single(df, ["entity", "predicate"], "value").collect()}
    assert (got["e"]["status"], got["e"]["value"], got["e"]["support"]) == ("SELECTED", "Alpha", ["a1", "a2"])
    assert (got["f"]["status"], got["f"]["n_values"]) == ("CONFLICTED", 2)
    good, bad = resolution.resolve_relations(df, ["entity", "predicate"], "value")
    assert [r["entity"] for r in good.collect()] == ["e"] and [r["entity"] for r in bad.collect()] == ["f"]


def test_digest_ignores_order_but_not_repeats(spark):
    rows = [(1, "a"), (2, None), (3, "c")]
    one = lambda r: digests.multiset_digest(spark.createDataFrame(r, "k int, v string"), digests.row_key(["k", "v"])).first()
    assert one(rows) == one(rows[::-1])
    assert one(rows) != one(rows + rows[:1])
    assert one([(2, None)]) != one([(2, "null")])


def test_bounded_lists_count_what_they_cut(spark):
    df = spark.createDataFrame([("e", i % 5) for i in range(20)], "entity_key string, x int")
    row = projection.bounded(df, "entity_key", "xs", F.col("x"), 3).first()
    assert (row["xs"], row["xs_overflow"]) == ([0, 1, 2], 2)


def test_symmetric_difference_treats_nulls_as_equal(spark):
    a, b = (spark.createDataFrame(x, "k int") for x in ([(1,), (None,)], [(None,), (2,)]))
    assert {(r["k"], r["side"]) for r in identity.symmetric_difference(a, b, ["k"]).collect()} == {(1, "left"), (2, "right")}


def test_windows_drop_nothing(spark):
    got = digests.windows(spark.range(101), "id", 10).collect()
    assert sorted((r["window"], r["first"], r["last"], r["n"]) for r in got)[-1] == (10, 100, 100, 1)
    assert sum(r["n"] for r in got) == 101


def test_policy_has_the_fixed_rules(spark):
    from gneiss.operators import policy

    held = {(r["kind"], r["predicate"]): r for r in policy.rules(spark).collect()}
    assert len(policy.NAMESPACES.split()) == 38
    assert (held["FIELD", "title"]["operator"], held["FIELD", "title"]["scope"], held["FIELD", "title"]["sources"][0]) == ("SINGLE", ["language", "region", "titleRole"], "imdb-non-commercial-datasets")
    assert held["FIELD", "runtime_minutes"]["sources"][0] == "musicbrainz-core-dump" and held["RELATIONSHIP", "part_of_series"]["operator"] == "SINGLE"
    rows = [
        ("e", "FIELD", "title", "A", "a1", "elsewhere", '{"language":"en"}'),
        ("e", "FIELD", "title", "B", "b1", "europeana-oai-edm", '{"language":"en"}'),
        ("e", "FIELD", "rating_average", "7", "r1", "imdb-non-commercial-datasets", "{}"),
        ("e", "RELATIONSHIP", "part_of", "x", "x1", "tmdb-research", "{}"),
        ("e", "RELATIONSHIP", "part_of", "y", "y1", "tmdb-research", "{}"),
        ("e", "RELATIONSHIP", "title", "x", "t1", "tmdb-research", "{}"),
    ]
    df = spark.createDataFrame(rows, "entity string, kind string, predicate string, value string, assertion_id string, source string, qualifiers_json string")
    got = {(r["kind"], r["predicate"]): (r["value"], r["status"]) for r in policy.resolve(df).collect()}
    assert got == {("FIELD", "title"): ("B", "SELECTED"), ("RELATIONSHIP", "part_of"): (None, "CONFLICTED")}


def test_composites_fail_closed(spark):
    from gneiss.operators import composites

    day = dt.date(2024, 1, 1)
    at = F.lit(dt.date(2024, 2, 1))
    member = "node_id string, entity_key string, membership_key int, valid_from date, valid_to date"
    ledger = spark.createDataFrame([("e", "WORK", "k", "ACTIVE"), ("t", "WORK", "k", "TOMBSTONED")], "entity_key string, level string, kind string, status string")
    none = spark.createDataFrame([], "source string, target string, effective_at date")
    for rows, error in (([("n", "e", 1, day, None), ("n", "f", 2, day, None)], "several_entities"), ([("n", "x", 1, day, None)], "missing"), ([("n", "t", 1, day, None)], "tombstoned")):
        with pytest.raises(ValueError, match=error):
            composites.resolved_memberships(spark.createDataFrame(rows, member), none, ledger, at)
    batches = spark.createDataFrame([("d", "r1", day, "DELTA"), ("d", "r2", day + dt.timedelta(days=2), "SNAPSHOT")], "domain string, run_id string, acquired date, kind string")
    with pytest.raises(ValueError, match="baseline"):
        composites.snapshot_events(spark.createDataFrame([("d", "a", "UPSERT", "r1")], "domain string, record_id string, operation string, run_id string"), batches, ["domain"])
    assert len(composites.fetch_bounded(spark.range(3), 3)) == 3
    with pytest.raises(ValueError):
        composites.fetch_bounded(spark.range(4), 3)


def _gate(spark, attribution=(), stale=(), **counts):
    names = ["n_conflicts", "n_resolutions", "n_fields", "n_identifiers", "n_relations", "n_unresolved", *[g.lower() for g in resolution.GATE_COUNTS]]
    row = spark.createDataFrame([tuple(counts.get(n) for n in names)], ", ".join(f"{n} long" for n in names))
    differs = spark.createDataFrame(list(attribution), "product string, policy_id string, said long, counted long")
    return resolution.release_gate(row, differs, spark.createDataFrame(list(stale), "source string")).first()


def test_release_gate_names_every_violation(spark):
    empty = _gate(spark)
    assert empty["passed"] and empty["violations"] == [] and empty["conflict_share"] == 0.0 and empty["unresolved_share"] == 0.0
    edge = _gate(spark, n_conflicts=5, n_resolutions=100, n_fields=45, n_identifiers=10, n_relations=20, n_unresolved=5)
    assert edge["passed"] and edge["unresolved_share"] == 0.05
    counts = {g.lower(): i + 1 for i, g in enumerate(resolution.GATE_COUNTS)}
    bad = _gate(spark, [("p", "x", 1, 2)], [("b",), ("a",), ("a",)], n_conflicts=6, n_resolutions=100, n_fields=1, n_unresolved=1, **counts)
    named = [f"{g}:{i + 1}" for i, g in enumerate(resolution.GATE_COUNTS)]
    assert bad["violations"] == ["FIELD_CONFLICT_RATIO", "UNRESOLVED_IDENTITY_RATIO", *named, "ATTRIBUTION_COUNTS_MISMATCH", "SOURCE_FRESHNESS:a", "SOURCE_FRESHNESS:b"]
    assert not bad["passed"]
    with pytest.raises(Exception, match="negative counts"):
        _gate(spark, n_conflicts=-1)
    with pytest.raises(Exception, match="more conflicts"):
        _gate(spark, n_conflicts=2, n_resolutions=1)


def test_scoped_children_need_one_relation_and_no_ordinal(spark):
    children = spark.createDataFrame([(c, "E") for c in ("tt1", "tt2", "tt3", "x4", "tt5")], "child string, child_type string")
    relations = spark.createDataFrame([("tt1", "p", None), ("tt2", "p", None), ("tt2", "p", None), ("tt3", "p", 4), ("x4", "p", None), ("tt5", "q", None)], "child string, parent string, ordinal int")
    parents = spark.createDataFrame([("p", "E", "K"), ("q", "E", None)], "parent string, parent_type string, entity_key string")
    none = spark.createDataFrame([], "child string, ordinal int")
    got = {r["child"]: (r["mode"], r["component"]) for r in identity.parent_constrained(children, relations, none, parents, F.col("child").rlike("^tt[0-9]+$")).collect()}
    assert {c: m for c, (m, _) in got.items()} == {"tt1": "SCOPED", "tt2": "NO_ORDINAL", "tt3": "PLACED", "x4": "NO_ORDINAL", "tt5": "PARENT_UNRESOLVED"}
    assert got["tt1"][1] and got["tt2"][1] is None
    plain = {r["child"]: r["mode"] for r in identity.parent_constrained(children, relations, none, parents).collect()}
    assert plain["tt1"] == "NO_ORDINAL"


def test_closing_once_and_fan_out_keeps_one_row_of_a_key(spark):
    t = dt.datetime(2024, 1, 1)
    work = spark.createDataFrame([("r1", "REVOKABLE", 1, "e"), ("r2", "REVOKABLE", 1, "e"), ("r3", "AMBIGUOUS", None, None), ("r4", "UNMAPPED", None, None), ("r5", "REVOKABLE", 9, None)], "record_id string, status string, node_id long, entity_key string")
    members = spark.createDataFrame([("m1", 1, "e", t, None), ("m0", 1, "e", t, t), ("m2", 2, "e", t, None)], "membership_key string, node_id long, entity_key string, valid_from timestamp, valid_to timestamp")
    closed, decisions, evidence = identity.close_memberships(work, members, F.lit(t), "gone")
    assert [(r["membership_key"], r["valid_to"]) for r in closed.collect()] == [("m1", t)]
    assert [(r["action"], r["node_id"], r["reason"]) for r in decisions.collect()] == [("REVOKE", 1, "gone")]
    assert sorted((r["record_id"], r["kind"]) for r in evidence.collect()) == [("r1", "INACTIVE_RECORD"), ("r2", "INACTIVE_RECORD"), ("r3", "INACTIVE_MAPPING_CONFLICT")]
    with pytest.raises(Exception, match="precedes"):
        identity.close_memberships(work, members, F.lit(t - dt.timedelta(days=1)), "gone")[0].collect()
    results = spark.createDataFrame([([("a", 2), ("b", 1)],), ([("a", 1)],), (None,)], "rows array<struct<k:string,v:int>>")
    assert sorted(tuple(r) for r in identity.fan_out(results, {"t": ("rows", ["k"])})["t"].collect()) == [("a", 1), ("b", 1)]


def test_many_decisions_never_pass_through_the_driver(spark):
    """Entities that came from arrays look tiny to the planner; broadcast, they filled the driver's memory."""
    n = 60_000
    keys = spark.range(1).select(F.explode(F.sequence(F.lit(0), F.lit(2 * n - 1))).alias("entity_key"))
    entities = keys.select("entity_key", F.col("entity_key").alias("created_at"), F.lit("l").alias("level"), F.lit("k").alias("kind"))
    decisions = keys.where("entity_key % 2 = 0").select(F.col("entity_key").alias("decision_id"), F.when(F.col("entity_key") % 4 == 0, "MERGE").otherwise("REDIRECT").alias("action"), F.lit(None).cast("int").alias("node_id"), "entity_key", (F.col("entity_key") + 1).alias("target_key"))
    spark.conf.set("spark.sql.maxBroadcastTableSize", "1m")
    try:
        members, redirects = curation.apply_decisions(entities.select(F.col("entity_key").alias("node_id"), "entity_key").where("false"), entities, decisions)
        found = redirects.agg(F.count("*").alias("n"), F.count_if((F.col("target") % 4 == 0) & (F.col("source") == F.col("target") + 1)).alias("merged"), F.count_if((F.col("source") % 4 == 2) & (F.col("target") == F.col("source") + 1)).alias("moved")).first()
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")
    assert (found["n"], found["merged"], found["moved"]) == (n, n // 2, n // 2)
    assert members.count() == 0


def _shuffled(plan) -> int:
    """Rows written by the exchanges of an executed plan."""
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        return _shuffled(plan.executedPlan())
    if plan.getClass().getSimpleName().endswith("QueryStageExec"):
        return _shuffled(plan.plan())
    own = plan.metrics().get("shuffleRecordsWritten")
    children = plan.children()
    return (own.get().value() if own.isDefined() else 0) + sum(_shuffled(children.apply(i)) for i in range(children.size()))


def test_candidate_pairs_are_unrolled_without_a_shuffle(spark):
    """400 nodes and 300 entities on one key are 120,000 pairs; grouping them all filled the disk on larger tables."""
    odd = [(1, "p"), (1, "q"), (1, "q"), (2, None), (None, "p"), (None, "p"), (3, "r")]
    identifiers = spark.createDataFrame(odd, "node_id long, blocking_key string").unionByName(spark.range(100, 500).select(F.col("id").alias("node_id"), F.lit("hot").alias("blocking_key")))
    stored = [("p", 7), ("q", 7), ("q", 7), ("p", 8), ("q", 8), ("p", None), ("q", 9), (None, 9), (None, None), ("hot", 9)]
    known = spark.createDataFrame(stored, "blocking_key string, entity_key long").unionByName(spark.range(1000, 1300).select(F.lit("hot").alias("blocking_key"), F.col("id").alias("entity_key")))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        links = composites.candidate_links(identifiers, known)
        rows = [tuple(r) for r in links.collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    few = {(1, 7, 2), (1, 8, 2), (1, None, 1), (1, 9, 1), (None, 7, 1), (None, 8, 1), (None, None, 1)}
    hot = {(n, e, 1) for n in range(100, 500) for e in (9, *range(1000, 1300))}
    assert len(rows) == len(few) + len(hot) and set(rows) == few | hot
    assert _shuffled(links._jdf.queryExecution().executedPlan()) < 10_000


def test_candidate_pairs_of_one_key_are_made_in_several_tasks(spark):
    """200 nodes and 2,501 entities, one of them null, on one key are 500,200 pairs; one task made them all, however many there were."""
    identifiers = spark.range(200).select(F.col("id").alias("node_id"), F.lit("hot").alias("blocking_key"))
    known = spark.range(2501).select(F.lit("hot").alias("blocking_key"), F.when(F.col("id") > 0, F.col("id")).alias("entity_key"))
    changed = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    usual = {name: spark.conf.get(name) for name in changed}
    for name, value in changed.items():
        spark.conf.set(name, value)
    try:
        links = composites.candidate_links(identifiers, known)
        tasks = links.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n"), F.sum("n_keys").alias("keys")).collect()
        nodes = links.groupBy("node_id").agg(F.count("*").alias("n"), F.count_distinct("entity_key").alias("entities"), F.count_if(F.col("entity_key").isNull()).alias("nulls")).collect()
    finally:
        for name, value in usual.items():
            spark.conf.set(name, value)
    assert sum(t["n"] for t in tasks) == sum(t["keys"] for t in tasks) == 200 * 2501
    assert max(t["n"] for t in tasks) < 200 * 2501 / 2
    assert len(nodes) == 200 and {(r["n"], r["entities"], r["nulls"]) for r in nodes} == {(2501, 2500, 1)}
