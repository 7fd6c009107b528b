"""Queries of the catalog operators over the test tables, each with SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gneiss.operators import closure, composites, digests, identity, lifecycle, policy, projection, resolution
from gneiss.session import table

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str):
    def register(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql
        return f

    return register


# --- source records -----------------------------------------------------------------------------------------------

#: Events as source records: a user and event type is a record, errors delete it, purchases expire.
RECORDS_SQL = """records AS (
  SELECT user_id || ':' || event_type AS record_id, user_id, event_type, event_id, ts AS observed_at,
         CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN 'DELETE' ELSE 'UPSERT' END AS operation,
         ts AS valid_from, CASE WHEN event_id % 7 = 0 THEN ts + INTERVAL 2 DAY END AS valid_to,
         CASE WHEN event_type = 'purchase' AND event_id % 3 = 0 THEN ts + INTERVAL 5 DAY END AS expires_at, value
  FROM events)"""
AT = "TIMESTAMP '2024-01-25 00:00:00'"
LATEST_SQL = f"""WITH {RECORDS_SQL},
latest AS (SELECT * FROM records WHERE observed_at <= {AT}
  QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY observed_at DESC, (operation <> 'UPSERT') DESC, event_id DESC) = 1)"""


def _records(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return e.select(
        F.concat_ws(":", F.col("user_id").cast("string"), "event_type").alias("record_id"),
        "user_id",
        "event_type",
        "event_id",
        F.col("ts").alias("observed_at"),
        F.when((F.col("event_type") == "error") & (F.col("event_id") % 2 == 0), "DELETE").otherwise("UPSERT").alias("operation"),
        F.col("ts").alias("valid_from"),
        F.when(F.col("event_id") % 7 == 0, F.col("ts") + F.expr("INTERVAL 2 DAY")).alias("valid_to"),
        F.when((F.col("event_type") == "purchase") & (F.col("event_id") % 3 == 0), F.col("ts") + F.expr("INTERVAL 5 DAY")).alias("expires_at"),
        "value",
    )


def _at():
    return F.expr("TIMESTAMP_NTZ '2024-01-25 00:00:00'")


def _latest(spark, d):
    return lifecycle.latest(_records(spark, d).where(F.col("observed_at") <= _at()), ["record_id"], ["observed_at"], ["event_id"])


@query(LATEST_SQL + " SELECT record_id, event_id, operation, observed_at, value FROM latest")
def latest_record_states(spark, d):
    return _latest(spark, d).select("record_id", "event_id", "operation", "observed_at", "value")


@query(LATEST_SQL + f""" SELECT record_id, event_id FROM latest WHERE operation = 'UPSERT' AND valid_from <= {AT}
  AND (valid_to IS NULL OR valid_to > {AT}) AND (expires_at IS NULL OR expires_at > {AT})""")
def current_upserts(spark, d):
    return _latest(spark, d).where(lifecycle.is_active(_at())).select("record_id", "event_id")


@query(LATEST_SQL + f""" SELECT record_id, event_id, operation FROM latest
  WHERE operation <> 'UPSERT' OR coalesce(valid_to <= {AT}, false) OR coalesce(expires_at <= {AT}, false)""")
def inactive_records(spark, d):
    return _latest(spark, d).where(lifecycle.is_inactive(_at())).select("record_id", "event_id", "operation")


@query("""WITH b AS (SELECT DISTINCT event_type, date_trunc('week', ts) AS run FROM events),
p AS (SELECT event_type, run, lag(run) OVER (PARTITION BY event_type ORDER BY run) AS prev FROM b),
r AS (SELECT DISTINCT event_type, date_trunc('week', ts) AS run, user_id FROM events)
SELECT p.event_type AS domain, epoch(p.run)::BIGINT AS run_id, epoch(p.prev)::BIGINT AS previous_run, h.user_id AS record_id
FROM p JOIN r h ON h.event_type = p.event_type AND h.run = p.prev
WHERE NOT EXISTS (SELECT 1 FROM r n WHERE n.event_type = p.event_type AND n.run = p.run AND n.user_id = h.user_id)""")
def inferred_absences(spark, d):
    e = table(spark, d, "events")
    run = F.unix_timestamp(F.date_trunc("week", F.col("ts").cast("timestamp")))
    rows = e.select(F.col("event_type").alias("domain"), run.alias("run_id"), F.col("user_id").alias("record_id")).distinct()
    batches = rows.select("domain", "run_id", F.col("run_id").alias("acquired")).distinct()
    return lifecycle.snapshot_absences(rows, batches, ["domain"]).select("domain", "run_id", "previous_run", "record_id")


@query("""WITH b AS (SELECT event_type AS domain, max(ts) AS acquired, 'run-' || CAST(date_trunc('day', ts) AS DATE) AS run_id FROM events GROUP BY event_type, date_trunc('day', ts)),
s AS (SELECT *, lag(acquired) OVER (PARTITION BY domain ORDER BY acquired, run_id) AS since FROM b)
SELECT s.domain, s.run_id, count(*) AS n_events, sum(e.event_id)::BIGINT AS ids FROM s JOIN events e ON e.event_type = s.domain AND e.ts >= s.since AND e.ts < s.acquired
GROUP BY s.domain, s.run_id""")
def interval_events(spark, d):
    e = table(spark, d, "events").select(F.col("event_type").alias("domain"), F.col("ts").alias("at"), "event_id")
    b = e.groupBy("domain", F.to_date("at").alias("_day")).agg(F.max("at").alias("acquired")).select("domain", "acquired", F.concat(F.lit("run-"), F.col("_day").cast("string")).alias("run_id"))
    return lifecycle.interval_changes(e, b, ["domain"]).groupBy("domain", "run_id").agg(F.count("*").alias("n_events"), F.sum("event_id").alias("ids"))


MEMBERS_SQL = """m AS (SELECT o_custkey AS node_id, o_orderkey % 50 AS entity_key, o_orderkey AS membership_key, o_orderdate AS valid_from,
  CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + to_days((o_orderkey % 900)::INTEGER) END AS valid_to FROM orders)"""
MEMBERS_AT = "1996-06-01 00:00:00"


def _memberships(spark, d):
    o = table(spark, d, "orders")
    end = F.col("o_orderdate") + F.make_dt_interval((F.col("o_orderkey") % 900).cast("int"))
    return o.select(
        F.col("o_custkey").alias("node_id"), (F.col("o_orderkey") % 50).alias("entity_key"), F.col("o_orderkey").alias("membership_key"), F.col("o_orderdate").alias("valid_from"), F.when(F.col("o_orderstatus") != "O", end).alias("valid_to")
    )


@query(f"""WITH {MEMBERS_SQL},
v AS (SELECT * FROM m WHERE valid_from <= TIMESTAMP '{MEMBERS_AT}'
  QUALIFY row_number() OVER (PARTITION BY node_id, entity_key ORDER BY valid_to IS NULL, valid_to, membership_key DESC) = 1)
SELECT node_id, entity_key, membership_key FROM v WHERE valid_to IS NULL OR valid_to > TIMESTAMP '{MEMBERS_AT}'""")
def effective_memberships(spark, d):
    at = F.expr(f"TIMESTAMP_NTZ '{MEMBERS_AT}'")
    return lifecycle.effective_memberships(_memberships(spark, d), at).select("node_id", "entity_key", "membership_key")


@query("""WITH m AS (SELECT l_suppkey AS node_id, l_linenumber AS entity_key, l_quantity AS valid_from, l_shipdate AS valid_to FROM lineitem)
SELECT node_id, entity_key, valid_from, count(DISTINCT valid_to) AS n_closures FROM m GROUP BY ALL HAVING count(DISTINCT valid_to) > 1""")
def closure_conflicts(spark, d):
    rows = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("node_id"), F.col("l_linenumber").alias("entity_key"), F.col("l_quantity").alias("valid_from"), F.col("l_shipdate").alias("valid_to"))
    return lifecycle.closure_conflicts(rows)


@query(LATEST_SQL + f""", gone AS (SELECT record_id, user_id FROM latest WHERE operation <> 'UPSERT' OR coalesce(valid_to <= {AT}, false) OR coalesce(expires_at <= {AT}, false)),
nodes AS (SELECT g.record_id, c_custkey AS node_id FROM gone g JOIN customer ON c_custkey IN (g.user_id, g.user_id + CASE WHEN g.user_id % 3 = 0 THEN 1 ELSE 0 END) WHERE g.user_id % 5 <> 0),
k AS (SELECT g.record_id, list_sort(list(DISTINCT node_id) FILTER (node_id IS NOT NULL)) AS ids FROM (SELECT DISTINCT record_id FROM gone) g LEFT JOIN nodes USING (record_id) GROUP BY g.record_id),
s AS (SELECT record_id, CASE coalesce(len(ids), 0) WHEN 0 THEN 'UNMAPPED' WHEN 1 THEN 'REVOKABLE' ELSE 'AMBIGUOUS' END AS status, CASE WHEN len(ids) = 1 THEN ids[1] END AS node_id FROM k)
SELECT record_id, status, s.node_id, c_nationkey AS entity_key FROM s LEFT JOIN customer ON c_custkey = s.node_id""")
def revocation_worklist(spark, d):
    gone = _latest(spark, d).where(lifecycle.is_inactive(_at())).select("record_id", "user_id")
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("node_id"), F.col("c_nationkey").alias("entity_key"))
    also = F.when(F.col("user_id") % 3 == 0, F.col("user_id") + 1)
    named = gone.where("user_id % 5 <> 0").select("record_id", F.explode(F.array_compact(F.array("user_id", also))).alias("node_id"))
    nodes = named.join(c.select("node_id"), "node_id", "left_semi")
    return lifecycle.revocations(gone, nodes, c.withColumn("valid_to", F.lit(None).cast("timestamp")))


@query("""SELECT count(*) FILTER (l_quantity > 45) AS large, count(*) FILTER (l_discount > 0.09) AS discounted, count(*) FILTER (l_shipdate IS NULL) AS undated FROM lineitem""")
def fail_closed_checks(spark, d):
    return lifecycle.check_all(table(spark, d, "lineitem"), {"large": F.col("l_quantity") > 45, "discounted": F.col("l_discount") > 0.09, "undated": F.col("l_shipdate").isNull()})


@query("""SELECT l_orderkey, l_linenumber FROM lineitem JOIN (SELECT DISTINCT o_orderkey FROM orders WHERE o_orderstatus = 'F') o ON o_orderkey = l_orderkey
WHERE l_returnflag = 'R' AND (l_shipdate IS NULL OR l_shipdate > TIMESTAMP '1994-01-01')""")
def current_assertions(spark, d):
    li = table(spark, d, "lineitem")
    a = li.select("l_orderkey", "l_linenumber", F.when(F.col("l_returnflag") == "R", "ACTIVE").alias("status"), F.col("l_shipdate").alias("valid_to"))
    env = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return lifecycle.current_assertions(a, env, F.expr("TIMESTAMP_NTZ '1994-01-01 00:00:00'"), ["l_orderkey"]).select("l_orderkey", "l_linenumber")


@query("""SELECT o_orderstatus AS run_id, count(*) AS n_records, sum(l_linenumber)::BIGINT AS lines FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1""")
def bound_records(spark, d):
    li = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("o_orderkey") == F.col("l_orderkey")).select(F.col("o_orderstatus").alias("run_id"), "l_linenumber")
    runs = li.groupBy("run_id").agg(F.count("*").alias("record_count"))
    bound = lifecycle.bind_records(li, runs, runs.select("run_id"))
    return bound.groupBy("run_id").agg(F.count("*").alias("n_records"), F.sum("l_linenumber").alias("lines"))


@query("""SELECT DISTINCT 'run-' || c_nationkey AS run_id FROM customer WHERE c_nationkey % 4 <> 1""")
def pending_runs(spark, d):
    runs = table(spark, d, "customer").select(F.concat(F.lit("run-"), F.col("c_nationkey").cast("string")).alias("run_id")).distinct()
    used = table(spark, d, "nation").where("n_nationkey % 4 = 1").select(F.to_json(F.array(F.concat(F.lit("run-"), F.col("n_nationkey").cast("string")))).alias("input_runs_json"))
    return lifecycle.pending_runs(runs, used)


# --- identity -----------------------------------------------------------------------------------------------------

EDGES_SQL = """edges AS (
  SELECT c_custkey AS node_id, 'a:' || c_nationkey || ':' || CAST(floor(c_acctbal / 40) AS BIGINT) AS blocking_key FROM customer
  UNION SELECT c_custkey, 'b:' || c_mktsegment || ':' || CAST(floor(c_acctbal / 15) AS BIGINT) FROM customer)"""
COMPONENTS_SQL = f"""WITH RECURSIVE {EDGES_SQL},
pairs AS (SELECT DISTINCT x.node_id AS a, y.node_id AS b FROM edges x JOIN edges y USING (blocking_key)),
reach AS (SELECT node_id AS a, node_id AS b FROM edges UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON p.a = r.b),
comps AS (SELECT a AS node_id, min(b) AS component_id FROM reach GROUP BY a)"""


def _edges(spark, d):
    c = table(spark, d, "customer")
    at = lambda n: F.floor(F.col("c_acctbal") / n).cast("string")
    a = c.select(F.col("c_custkey").alias("node_id"), F.concat_ws(":", F.lit("a"), F.col("c_nationkey").cast("string"), at(40)).alias("blocking_key"))
    b = c.select(F.col("c_custkey").alias("node_id"), F.concat_ws(":", F.lit("b"), "c_mktsegment", at(15)).alias("blocking_key"))
    return a.unionByName(b).distinct()


@query(COMPONENTS_SQL + " SELECT * FROM comps")
def blocking_components(spark, d):
    return identity.blocking_components(_edges(spark, d))


@query(COMPONENTS_SQL + """, cand AS (SELECT s_suppkey * 3 AS node_id, 'E' || s_nationkey AS entity_key FROM supplier),
sizes AS (SELECT component_id, count(*) AS n_nodes FROM comps GROUP BY 1),
found AS (SELECT component_id, list_sort(list(DISTINCT entity_key)) AS keys FROM comps JOIN cand USING (node_id) GROUP BY 1)
SELECT component_id, n_nodes, coalesce(len(keys), 0)::BIGINT AS n_candidates, array_to_string(CASE WHEN len(keys) <= 256 THEN keys END, ',') AS candidate_keys,
  CASE WHEN n_nodes > 256 OR len(keys) > 256 THEN 'OVERSIZED' WHEN len(keys) > 1 THEN 'MULTI' WHEN len(keys) = 1 THEN 'ACCEPT' ELSE 'BOOTSTRAP' END AS mode
FROM sizes LEFT JOIN found USING (component_id)""")
def component_modes(spark, d):
    comps = identity.blocking_components(_edges(spark, d))
    cand = table(spark, d, "supplier").select((F.col("s_suppkey") * 3).alias("node_id"), F.concat(F.lit("E"), F.col("s_nationkey").cast("string")).alias("entity_key"))
    stats = identity.resolution_mode(identity.component_stats(comps, cand))
    return stats.withColumn("candidate_keys", F.array_join("candidate_keys", ","))


@query(COMPONENTS_SQL + """, cand AS (SELECT DISTINCT component_id FROM comps JOIN supplier ON node_id = s_suppkey * 3)
SELECT node_id, 'sha256:' || sha256(component_id::VARCHAR) AS entity_key FROM comps WHERE component_id NOT IN (SELECT component_id FROM cand)
  AND component_id IN (SELECT component_id FROM comps GROUP BY 1 HAVING count(*) <= 256)""")
def bootstrap_entities(spark, d):
    comps = identity.blocking_components(_edges(spark, d))
    cand = table(spark, d, "supplier").select((F.col("s_suppkey") * 3).alias("node_id"), F.concat(F.lit("E"), F.col("s_nationkey").cast("string")).alias("entity_key"))
    return identity.bootstrap(comps, identity.resolution_mode(identity.component_stats(comps, cand)))


@query("""WITH s(scheme, pattern, cs) AS (VALUES ('brand', '^Brand#[1-3][0-9]*$', false), ('size', '^[0-9]+$', true)),
a AS (SELECT p_partkey, ' Brand' AS scheme, p_brand AS value FROM part UNION ALL SELECT p_partkey, 'SIZE ', CAST(p_size AS VARCHAR) || CASE WHEN p_size % 4 = 0 THEN 'x' ELSE '' END FROM part UNION ALL SELECT p_partkey, 'other', 'x' FROM part)
SELECT p_partkey, s.scheme || ':' || CASE WHEN cs THEN trim(value) ELSE upper(trim(value)) END AS blocking_key FROM a JOIN s ON lower(trim(a.scheme)) = s.scheme AND regexp_matches(trim(value), pattern)""")
def normalised_identifiers(spark, d):
    p = table(spark, d, "part")
    a = p.select("p_partkey", F.lit(" Brand").alias("scheme"), F.col("p_brand").alias("value")).unionByName(p.select("p_partkey", F.lit("SIZE ").alias("scheme"), F.concat(F.col("p_size").cast("string"), F.when(F.col("p_size") % 4 == 0, "x").otherwise("")).alias("value")))
    a = a.unionByName(p.select("p_partkey", F.lit("other").alias("scheme"), F.lit("x").alias("value")))
    schemes = spark.createDataFrame([("brand", "^Brand#[1-3][0-9]*$", False), ("size", "^[0-9]+$", True)], "scheme string, pattern string, case_sensitive boolean")
    return identity.normalise_identifiers(a, schemes).select("p_partkey", "blocking_key")


@query("""WITH own AS (SELECT o_custkey AS node_id, list(DISTINCT o_orderstatus) AS own FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1),
f AS (SELECT o_custkey AS node_id, list(DISTINCT o_orderstatus) AS found FROM orders WHERE o_orderkey % 2 = 1 GROUP BY 1),
x AS (SELECT node_id, list_sort(list_filter(found, lambda v: NOT list_contains(own, v))) AS others FROM f JOIN own USING (node_id))
SELECT node_id, array_to_string(others, ',') AS others FROM x WHERE len(others) > 0""")
def assigned_recheck(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("node_id"), F.col("o_orderstatus").alias("entity_key"), "o_orderkey")
    found = identity.recheck(o.where("o_orderkey % 2 = 0"), o.where("o_orderkey % 2 = 1"))
    return found.select("node_id", F.array_join("others", ",").alias("others"))


@query("""SELECT l_suppkey, l_linenumber, CASE WHEN count(DISTINCT l_linestatus) = 1 THEN min(l_linestatus) END AS status, count(DISTINCT l_linestatus) AS n_status FROM lineitem GROUP BY ALL""")
def unique_or_null(spark, d):
    return identity.unique_or_null(table(spark, d, "lineitem"), ["l_suppkey", "l_linenumber"], "l_linestatus", "status")


@query("""WITH r AS (SELECT l_orderkey AS child, min(l_suppkey) AS a, max(l_suppkey) AS b, count(DISTINCT l_suppkey) AS np, count(DISTINCT l_linenumber) AS ns, min(l_linenumber) AS said FROM lineitem GROUP BY 1),
f AS (SELECT o_orderkey AS child, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey % 3 + 1 END::INTEGER AS field FROM orders),
p AS (SELECT s_suppkey AS parent, CASE WHEN s_suppkey % 9 <> 0 THEN 'E' || s_nationkey END AS e, CASE WHEN s_nationkey < 20 THEN 'SEASON' ELSE 'SERIES' END AS t FROM supplier),
j AS (SELECT o_orderkey AS child, CASE WHEN o_orderstatus = 'P' THEN 'SERIES' ELSE 'SEASON' END AS ct, r.a AS parent, np, ns, said, field, e, t, coalesce(field, said) AS ordinal
  FROM orders LEFT JOIN r ON r.child = o_orderkey LEFT JOIN f ON f.child = o_orderkey LEFT JOIN p ON p.parent = r.a),
m AS (SELECT *, CASE WHEN coalesce(np, 0) = 0 THEN 'NO_PARENT' WHEN np > 1 THEN 'AMBIGUOUS_PARENT' WHEN coalesce(t, '') <> ct THEN 'PARENT_TYPE' WHEN e IS NULL THEN 'PARENT_UNRESOLVED'
  WHEN ns > 1 THEN 'AMBIGUOUS_ORDINAL' WHEN field <> said THEN 'ORDINAL_CONFLICT' WHEN ordinal IS NULL THEN 'NO_ORDINAL' ELSE 'PLACED' END AS mode FROM j)
SELECT child, mode, e AS parent_entity, ordinal, CASE WHEN mode = 'PLACED' THEN sha256(e || '|' || ct || '|' || ordinal) END AS component FROM m""")
def parent_placement(spark, d):
    o = table(spark, d, "orders")
    children = o.select(F.col("o_orderkey").alias("child"), F.when(F.col("o_orderstatus") == "P", "SERIES").otherwise("SEASON").alias("child_type"))
    li = table(spark, d, "lineitem")
    relations = li.select(F.col("l_orderkey").alias("child"), F.col("l_suppkey").alias("parent"), F.col("l_linenumber").alias("ordinal"))
    ordinals = o.select(F.col("o_orderkey").alias("child"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey") % 3 + 1).cast("int").alias("ordinal"))
    s = table(spark, d, "supplier")
    parents = s.select(F.col("s_suppkey").alias("parent"), F.when(F.col("s_nationkey") < 20, "SEASON").otherwise("SERIES").alias("parent_type"), F.when(F.col("s_suppkey") % 9 != 0, F.concat(F.lit("E"), F.col("s_nationkey").cast("string"))).alias("entity_key"))
    return identity.parent_constrained(children, relations, ordinals, parents)


@query("""WITH r AS (SELECT l_orderkey AS child, min(l_suppkey) AS parent, count(DISTINCT l_suppkey) AS np, count(*) AS n FROM lineitem GROUP BY 1),
j AS (SELECT o_orderkey AS child, n, np, CASE WHEN o_orderkey % 2 = 0 THEN (o_orderkey % 3)::INTEGER END AS ordinal, 'S' || s_suppkey AS e, o_orderpriority <> '5-LOW' AS scoped FROM orders LEFT JOIN r ON child = o_orderkey LEFT JOIN supplier ON s_suppkey = parent),
m AS (SELECT *, CASE WHEN np IS NULL THEN 'NO_PARENT' WHEN np > 1 THEN 'AMBIGUOUS_PARENT' WHEN ordinal IS NOT NULL THEN 'PLACED' WHEN n = 1 AND scoped THEN 'SCOPED' ELSE 'NO_ORDINAL' END AS mode FROM j)
SELECT child, mode, e AS parent_entity, ordinal, CASE mode WHEN 'PLACED' THEN sha256(e || '|EPISODE|' || ordinal) WHEN 'SCOPED' THEN sha256(e || '|EPISODE|child|' || child) END AS component FROM m""")
def scoped_episodes(spark, d):
    o, s = table(spark, d, "orders"), table(spark, d, "supplier")
    children = o.select(F.col("o_orderkey").alias("child"), F.lit("EPISODE").alias("child_type"), (F.col("o_orderpriority") != "5-LOW").alias("own_ids"))
    relations = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("child"), F.col("l_suppkey").alias("parent"), F.lit(None).cast("int").alias("ordinal"))
    ordinals = o.select(F.col("o_orderkey").alias("child"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey") % 3).cast("int").alias("ordinal"))
    parents = s.select(F.col("s_suppkey").alias("parent"), F.lit("EPISODE").alias("parent_type"), F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("entity_key"))
    return identity.parent_constrained(children, relations, ordinals, parents, F.col("own_ids"))


CLOSING_SQL = """w AS (SELECT o_orderkey AS record_id, o_custkey AS node_id, CASE WHEN o_orderstatus = 'P' THEN 'AMBIGUOUS' WHEN o_orderstatus = 'F' THEN 'REVOKABLE' ELSE 'UNMAPPED' END AS status FROM orders),
closed AS (SELECT c_custkey AS node_id, c_nationkey AS entity_key, c_custkey AS membership_key, TIMESTAMP '1999-01-01' AS valid_to FROM customer WHERE c_custkey IN (SELECT node_id FROM w WHERE status = 'REVOKABLE') AND c_mktsegment <> 'BUILDING')"""


def _closing(spark, d):
    c = table(spark, d, "customer")
    at = F.expr("TIMESTAMP_NTZ '1999-01-01 00:00:00'")
    ended = F.when(F.col("c_mktsegment") == "BUILDING", F.expr("TIMESTAMP_NTZ '1995-01-01 00:00:00'"))
    members = c.select(F.col("c_custkey").alias("membership_key"), F.col("c_custkey").alias("node_id"), F.col("c_nationkey").alias("entity_key"), F.expr("TIMESTAMP_NTZ '1990-01-01 00:00:00'").alias("valid_from"), ended.alias("valid_to"))
    status = F.when(F.col("o_orderstatus") == "P", "AMBIGUOUS").when(F.col("o_orderstatus") == "F", "REVOKABLE").otherwise("UNMAPPED")
    gone = table(spark, d, "orders").select(F.col("o_orderkey").alias("record_id"), status.alias("status"), F.col("o_custkey").alias("node_id"))
    work = gone.join(members.where("valid_to IS NULL").select("node_id", "entity_key"), "node_id", "left")
    work = work.withColumn("entity_key", F.when(F.col("status") == "REVOKABLE", F.col("entity_key")))
    return identity.close_memberships(work, members, at, "source record inactive")


@query(f"""WITH {CLOSING_SQL} SELECT node_id, entity_key, membership_key, valid_to FROM closed""")
def closed_memberships(spark, d):
    return _closing(spark, d)[0].select("node_id", "entity_key", "membership_key", "valid_to")


@query(f"""WITH {CLOSING_SQL} SELECT 'decision' AS kind, count(*) AS n FROM closed
UNION ALL SELECT 'INACTIVE_MAPPING_CONFLICT', count(*) FROM w WHERE status = 'AMBIGUOUS'
UNION ALL SELECT 'INACTIVE_RECORD', count(*) FROM w JOIN closed USING (node_id) WHERE status = 'REVOKABLE'""")
def closing_evidence(spark, d):
    _, decisions, evidence = _closing(spark, d)
    rows = decisions.select("decision_key").distinct().select(F.lit("decision").alias("kind")).unionByName(evidence.select("kind"))
    return rows.groupBy("kind").agg(F.count("*").alias("n"))


@query("""SELECT 'parts' AS name, l_partkey AS key, min(l_quantity) AS value FROM lineitem GROUP BY 2 UNION ALL SELECT 'suppliers', l_suppkey, min(l_quantity) FROM lineitem GROUP BY 2""")
def fanned_out_rows(spark, d):
    side = lambda c: F.array(F.struct(F.col(c).alias("key"), F.col("l_quantity").alias("value")))
    results = table(spark, d, "lineitem").select(side("l_partkey").alias("parts"), side("l_suppkey").alias("suppliers"))
    found = identity.fan_out(results, {"parts": ("parts", ["key"]), "suppliers": ("suppliers", ["key"])})
    named = [rows.select(F.lit(name).alias("name"), "key", "value") for name, rows in found.items()]
    return named[0].unionByName(named[1])


@query("""WITH x AS (SELECT c_nationkey AS merge_id, c_custkey AS entity_key, floor(c_acctbal) AS created_at, CASE WHEN c_nationkey % 6 = 5 THEN c_mktsegment ELSE 'k' END AS kind FROM customer),
g AS (SELECT merge_id FROM x GROUP BY 1 HAVING count(DISTINCT kind) = 1)
SELECT merge_id, entity_key AS survivor FROM x WHERE merge_id IN (SELECT merge_id FROM g) QUALIFY row_number() OVER (PARTITION BY merge_id ORDER BY created_at, entity_key) = 1""")
def merge_survivors(spark, d):
    c = table(spark, d, "customer")
    kind = F.when(F.col("c_nationkey") % 6 == 5, F.col("c_mktsegment")).otherwise("k")
    return identity.merge_survivor(c.select(F.col("c_nationkey").alias("merge_id"), F.col("c_custkey").alias("entity_key"), F.floor("c_acctbal").alias("created_at"), F.lit("l").alias("level"), kind.alias("kind")))


@query("""SELECT c_custkey * 3 AS key, 'left' AS side FROM customer WHERE c_custkey * 3 NOT IN (SELECT s_suppkey * 2 FROM supplier)
UNION ALL SELECT s_suppkey * 2, 'right' FROM supplier WHERE s_suppkey * 2 NOT IN (SELECT c_custkey * 3 FROM customer)""")
def set_equality(spark, d):
    a = table(spark, d, "customer").select((F.col("c_custkey") * 3).alias("key"))
    b = table(spark, d, "supplier").select((F.col("s_suppkey") * 2).alias("key"))
    return identity.symmetric_difference(a, b, ["key"])


@query("""SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 12)""")
def stripped_keys(spark, d):
    pinned = table(spark, d, "customer").where("c_nationkey < 12").select(F.col("c_custkey").alias("o_custkey"))
    return identity.strip_owned(table(spark, d, "orders").select("o_orderkey", "o_custkey"), pinned, ["o_custkey"])


# --- closures -----------------------------------------------------------------------------------------------------


@query("""WITH RECURSIVE e AS (SELECT p_partkey // 3 AS source, p_partkey AS target FROM part UNION ALL SELECT p_partkey, p_partkey // 7 FROM part WHERE p_partkey % 7 = 0),
seeds AS (SELECT p_partkey AS node, 'T' || (p_partkey % 3) AS label FROM part WHERE p_partkey BETWEEN 20 AND 29),
r AS (SELECT label, node FROM seeds UNION SELECT r.label, e.target FROM r JOIN e ON e.source = r.node),
b AS (SELECT node, min(label) AS label FROM r GROUP BY 1)
SELECT p_partkey AS node, coalesce(b.label, 'UNKNOWN') AS label FROM part LEFT JOIN b ON b.node = p_partkey""")
def classified_entities(spark, d):
    p = table(spark, d, "part").select("p_partkey")
    edges = p.select(F.floor(F.col("p_partkey") / 3).alias("source"), F.col("p_partkey").alias("target")).unionByName(p.where("p_partkey % 7 = 0").select(F.col("p_partkey").alias("source"), F.floor(F.col("p_partkey") / 7).alias("target")))
    seeds = p.where("p_partkey BETWEEN 20 AND 29").select(F.concat(F.lit("T"), (F.col("p_partkey") % 3).cast("string")).alias("label"), F.col("p_partkey").alias("node"))
    return closure.classify(closure.closure(seeds, edges), p.select(F.col("p_partkey").alias("node")), {"T0": 0, "T1": 1, "T2": 2}, "UNKNOWN")


@query("""WITH RECURSIVE r AS (SELECT c_custkey AS source, c_custkey // 2 AS target FROM customer WHERE c_custkey % 4 <> 1 AND c_custkey > 1),
w AS (SELECT source, target, 1 AS hops FROM r UNION ALL SELECT w.source, r.target, w.hops + 1 FROM w JOIN r ON r.source = w.target)
SELECT source, target, hops FROM w QUALIFY row_number() OVER (PARTITION BY source ORDER BY hops DESC) = 1""")
def redirect_chase(spark, d):
    c = table(spark, d, "customer").where("c_custkey % 4 <> 1 AND c_custkey > 1")
    return closure.chase(c.select(F.col("c_custkey").alias("source"), F.floor(F.col("c_custkey") / 2).alias("target")))


# --- resolution ---------------------------------------------------------------------------------------------------

ASSERT_SQL = """a AS (SELECT l_suppkey AS entity, l_linenumber AS predicate, l_orderkey * 10 + l_linenumber AS assertion_id, l_returnflag AS value,
  (CASE l_linestatus WHEN 'F' THEN 0 ELSE 1 END + CASE WHEN l_quantity > 10 THEN 1 ELSE 0 END)::INTEGER AS source_rank FROM lineitem)"""


def _assertions(spark, d):
    li = table(spark, d, "lineitem")
    rank = F.when(F.col("l_linestatus") == "F", 0).otherwise(1) + F.when(F.col("l_quantity") > 10, 1).otherwise(0)
    return li.select(F.col("l_suppkey").alias("entity"), F.col("l_linenumber").alias("predicate"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("assertion_id"), F.col("l_returnflag").alias("value"), rank.alias("source_rank"))


@query(f"""WITH {ASSERT_SQL}, v AS (SELECT entity, predicate, value, min(source_rank) AS rank, count(DISTINCT assertion_id) AS n FROM a GROUP BY ALL),
w AS (SELECT entity, predicate, value, assertion_id AS winner FROM a QUALIFY row_number() OVER (PARTITION BY entity, predicate, value ORDER BY source_rank, assertion_id) = 1),
t AS (SELECT v.*, w.winner FROM v JOIN w USING (entity, predicate, value) QUALIFY rank = min(rank) OVER (PARTITION BY entity, predicate))
SELECT entity, predicate, count(*) AS n_values, min(winner) AS winner, arg_min(value, winner) AS value, sum(n)::BIGINT AS n_support, CASE WHEN count(*) = 1 THEN 'SELECTED' ELSE 'CONFLICTED' END AS status FROM t GROUP BY ALL""")
def single_resolution(spark, d):
    done = resolution.resolve_single(_assertions(spark, d), ["entity", "predicate"], "value")
    return done.select("entity", "predicate", "n_values", "winner", "value", F.size("support").cast("long").alias("n_support"), "status")


@query(f"""WITH {ASSERT_SQL} SELECT entity, predicate, value, min(source_rank) AS rank, count(DISTINCT assertion_id) AS n_support, 'SET' AS status FROM a GROUP BY ALL""")
def set_resolution(spark, d):
    return resolution.resolve_set(_assertions(spark, d), ["entity", "predicate"], "value").select("entity", "predicate", "value", "rank", F.size("support").cast("long").alias("n_support"), "status")


@query(f"""WITH {ASSERT_SQL}, b AS (SELECT entity, predicate, value FROM a QUALIFY source_rank = min(source_rank) OVER (PARTITION BY entity, predicate)),
k AS (SELECT entity, predicate, count(DISTINCT value) AS n, min(value) AS value FROM b GROUP BY ALL)
SELECT entity, predicate, CASE WHEN n = 1 THEN 'RELATION' ELSE 'CONFLICT' END AS kind, CASE WHEN n = 1 THEN value END AS value FROM k""")
def relation_resolution(spark, d):
    good, bad = resolution.resolve_relations(_assertions(spark, d), ["entity", "predicate"], "value")
    return good.select("entity", "predicate", F.lit("RELATION").alias("kind"), "value").unionByName(bad.select("entity", "predicate", F.lit("CONFLICT").alias("kind"), F.lit(None).cast("string").alias("value")))


@query("""SELECT p_brand AS blocking_key, string_agg(DISTINCT p_type || p_size, ',' ORDER BY p_type || p_size) AS entities, 'DUPLICATE_EXTERNAL_IDENTIFIER' AS reason FROM part GROUP BY 1 HAVING count(DISTINCT p_type || p_size) > 1""")
def identifier_collisions(spark, d):
    p = table(spark, d, "part").select(F.col("p_brand").alias("blocking_key"), F.concat(F.col("p_type"), F.col("p_size").cast("string")).alias("entity_key"))
    return resolution.identifier_collisions(p)[1].withColumn("entities", F.array_join("entities", ","))


@query("""WITH p AS (SELECT l_orderkey AS assertion_id, l_returnflag AS slot FROM lineitem) SELECT assertion_id, min(slot) AS slot FROM p GROUP BY 1 HAVING count(DISTINCT slot) = 1""")
def identifier_slots(spark, d):
    return resolution.single_slot(table(spark, d, "lineitem").select(F.col("l_orderkey").alias("assertion_id"), F.col("l_returnflag").alias("slot")))


@query("""SELECT o_orderkey AS assertion_id, o_custkey AS observation_key, o_orderkey IN (SELECT max(o_orderkey) FROM orders GROUP BY o_custkey) AS is_winning FROM orders""")
def observation_history(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("assertion_id"), F.col("o_custkey").alias("observation_key"))
    won = o.groupBy("observation_key").agg(F.max("assertion_id").alias("assertion_id"))
    return resolution.observations(o.unionByName(o), won)


@query("""WITH x AS (SELECT o_custkey AS observation_key, o_orderkey AS assertion_id, o_orderdate AS observed_at, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS prev FROM orders),
s AS (SELECT *, CASE WHEN assertion_id % 2 = 0 THEN prev END AS supersedes FROM x),
l AS (SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM s g WHERE g.observation_key = s.observation_key AND g.supersedes = s.assertion_id))
SELECT observation_key, assertion_id FROM l QUALIFY observed_at = max(observed_at) OVER (PARTITION BY observation_key)""")
def superseded_observations(spark, d):
    o = table(spark, d, "orders")
    prev = F.lag("o_orderkey").over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    rows = o.select(F.col("o_custkey").alias("observation_key"), F.col("o_orderkey").alias("assertion_id"), F.col("o_orderdate").alias("observed_at"), F.when(F.col("o_orderkey") % 2 == 0, prev).alias("supersedes"))
    return resolution.supersede(rows).select("observation_key", "assertion_id")


@query("""WITH m AS (SELECT c_nationkey AS entity_key, c_custkey AS node_id, CASE WHEN c_nationkey % 3 = 0 THEN c_mktsegment ELSE 'ONE' END AS class FROM customer)
SELECT entity_key, count(DISTINCT node_id) AS n_nodes, CASE WHEN count(DISTINCT class) = 1 THEN min(class) END AS class, count(DISTINCT class) > 1 AS inconsistent FROM m GROUP BY 1""")
def entity_summary(spark, d):
    c = table(spark, d, "customer")
    classes = c.select(F.col("c_custkey").alias("node_id"), F.when(F.col("c_nationkey") % 3 == 0, F.col("c_mktsegment")).otherwise("ONE").alias("class"))
    return resolution.entity_summary(c.select(F.col("c_nationkey").alias("entity_key"), F.col("c_custkey").alias("node_id")), classes)


@query("""SELECT c_mktsegment AS child_type, count(*) AS n_orphans FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 5 = 0) GROUP BY 1""")
def orphan_counts(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("child"), F.col("c_mktsegment").alias("child_type"))
    return resolution.orphans(c, table(spark, d, "orders").where("o_orderkey % 5 = 0").select(F.col("o_custkey").alias("child")))


@query("""WITH x AS (SELECT l_orderkey * 10 + l_linenumber AS assertion_id, CASE WHEN l_linenumber % 3 = 0 THEN NULL WHEN l_linenumber % 3 = 1 THEN 'open' ELSE 'lease' END AS policy_id, l_returnflag AS source, l_shipdate AS observed_at,
  CASE WHEN l_quantity > 48 THEN l_shipdate + INTERVAL 100 DAY END AS valid_to FROM lineitem)
SELECT outcome, count(*) AS n FROM (SELECT CASE WHEN source = 'R' THEN 'FENCED' WHEN policy_id IS NULL THEN 'NO_RIGHTS' WHEN policy_id = 'lease' AND observed_at + INTERVAL 365 DAY <= TIMESTAMP '1996-01-01' THEN 'EXPIRED_LEASE'
  WHEN observed_at > TIMESTAMP '1996-01-01' OR valid_to <= TIMESTAMP '1996-01-01' THEN 'NOT_VALID' ELSE 'ELIGIBLE' END AS outcome FROM x) GROUP BY 1""")
def rights_eligibility(spark, d):
    li = table(spark, d, "lineitem")
    policy = F.when(F.col("l_linenumber") % 3 == 1, "open").when(F.col("l_linenumber") % 3 == 2, "lease")
    rows = li.select(policy.alias("policy_id"), F.col("l_returnflag").alias("source"), F.col("l_shipdate").alias("observed_at"), F.col("l_shipdate").alias("valid_from"), F.when(F.col("l_quantity") > 48, F.col("l_shipdate") + F.expr("INTERVAL 100 DAY")).alias("valid_to"))
    rights = spark.createDataFrame([("open", True, None), ("lease", True, 365)], "policy_id string, allowed boolean, max_age_days int")
    fences = spark.createDataFrame([("R",)], "source string")
    return resolution.eligible(rows, rights, fences, F.expr("TIMESTAMP_NTZ '1996-01-01 00:00:00'")).groupBy("outcome").agg(F.count("*").alias("n"))


@query("""SELECT coalesce(CASE l_returnflag WHEN 'A' THEN 'SINGLE' WHEN 'N' THEN 'SET_UNION' END, 'NEVER_RESOLVE') AS operator, count(*) AS n FROM lineitem GROUP BY 1""")
def resolution_rules(spark, d):
    rules = spark.createDataFrame([("A", "SINGLE"), ("N", "SET_UNION")], "predicate string, operator string")
    return resolution.with_rule(table(spark, d, "lineitem").select(F.col("l_returnflag").alias("predicate")), rules).groupBy("operator").agg(F.count("*").alias("n"))


@query("""WITH m AS (SELECT count(*) FILTER (l_discount > 0.09) AS n_conflicts, count(*) AS n_resolutions, count(*) FILTER (l_quantity > 48) AS n_unresolved, count(*) AS n_lookups, count(*) FILTER (l_tax > 0.07) AS high_tax, count(*) FILTER (l_shipdate IS NULL) AS undated FROM lineitem)
SELECT n_conflicts / n_resolutions AS conflict_share, n_unresolved / n_lookups AS unresolved_share, CASE WHEN high_tax > 0 THEN 'high_tax' ELSE '' END || CASE WHEN undated > 0 THEN ',undated' ELSE '' END AS violations,
  n_conflicts / n_resolutions <= 0.05 AND n_unresolved / n_lookups <= 0.05 AND high_tax + undated = 0 AS passed FROM m""")
def quality_gate(spark, d):
    li = table(spark, d, "lineitem")
    m = li.agg(F.count_if(F.col("l_discount") > 0.09).alias("n_conflicts"), F.count("*").alias("n_resolutions"), F.count_if(F.col("l_quantity") > 48).alias("n_unresolved"), F.count("*").alias("n_lookups"), F.count_if(F.col("l_tax") > 0.07).alias("high_tax"), F.count_if(F.col("l_shipdate").isNull()).alias("undated"))
    return resolution.quality_report(m, ["high_tax", "undated"])


@query("""WITH m AS (SELECT count(*) FILTER (l_discount > 0.09) AS c, count(*) AS n, count(*) FILTER (l_quantity > 45) AS u, count(*) FILTER (l_tax > 0.07) AS e, count(*) FILTER (l_shipdate IS NULL) AS s,
  count(*) FILTER (l_quantity > 49) AS d FROM lineitem),
o AS (SELECT string_agg('SOURCE_FRESHNESS:' || o_orderpriority, ',' ORDER BY o_orderpriority) AS stale FROM (SELECT o_orderpriority FROM orders GROUP BY 1 HAVING max(o_orderdate) < TIMESTAMP '2100-01-01')),
v AS (SELECT c / n AS conflict_share, u / (3 * n + u) AS unresolved_share, e, s, d FROM m)
SELECT conflict_share, unresolved_share, concat_ws(',', CASE WHEN conflict_share > 0.05 THEN 'FIELD_CONFLICT_RATIO' END, CASE WHEN unresolved_share > 0.05 THEN 'UNRESOLVED_IDENTITY_RATIO' END,
  CASE WHEN e > 0 THEN 'ORPHAN_EPISODE_COUNT:' || e END, CASE WHEN s > 0 THEN 'ORPHAN_SEASON_COUNT:' || s END, CASE WHEN d > 0 THEN 'DUPLICATE_EXTERNAL_ID_COUNT:' || d END, 'ATTRIBUTION_COUNTS_MISMATCH', stale) AS violations, false AS passed FROM v, o""")
def release_gate(spark, d):
    li, o = table(spark, d, "lineitem"), table(spark, d, "orders")
    said = {"n_conflicts": F.col("l_discount") > 0.09, "n_unresolved": F.col("l_quantity") > 45, "orphan_episode_count": F.col("l_tax") > 0.07, "orphan_season_count": F.col("l_shipdate").isNull(), "duplicate_external_id_count": F.col("l_quantity") > 49}
    absent = [g.lower() for g in resolution.GATE_COUNTS if g.lower() not in said]
    whole = [F.count("*").alias(n) for n in ("n_resolutions", "n_fields", "n_relations")]
    counts = li.agg(*[F.count_if(x).alias(n) for n, x in said.items()], *whole).select("*", F.lit(0).alias("n_identifiers"), *[F.lit(None).cast("long").alias(n) for n in absent])
    counted = li.groupBy(F.col("l_returnflag").alias("product"), F.col("l_linestatus").alias("policy_id")).agg(F.count("*").alias("n_assertions"))
    differs = resolution.attribution_mismatch(counted.withColumn("n_assertions", F.col("n_assertions") + 1), counted)
    stale = o.groupBy(F.col("o_orderpriority").alias("source")).agg(F.max("o_orderdate").alias("last")).where(F.col("last") < F.expr("TIMESTAMP_NTZ '2100-01-01 00:00:00'"))
    return resolution.release_gate(counts, differs, stale).withColumn("violations", F.array_join("violations", ","))


@query("""WITH r AS (SELECT event_type AS source, event_id AS run_id, ts AS acquired, CASE event_id % 3 WHEN 0 THEN 'COMPLETE' WHEN 1 THEN 'DELTA' ELSE 'PARTIAL' END AS completeness FROM events),
p(source, max_age_hours) AS (VALUES ('click', 1), ('view', 10000), ('error', 5), ('absent', 5)),
l AS (SELECT source, max(acquired) FILTER (completeness = 'COMPLETE') AS complete_at, max(acquired) FILTER (completeness = 'DELTA') AS delta_at, max(acquired) FILTER (completeness = 'PARTIAL') AS partial_at, arg_max(run_id, (acquired, run_id)) AS latest_run FROM r GROUP BY 1),
j AS (SELECT p.source, complete_at, delta_at, partial_at, latest_run, max_age_hours, greatest(complete_at, delta_at) AS u FROM p LEFT JOIN l USING (source))
SELECT source, complete_at, delta_at, partial_at, latest_run, (epoch(TIMESTAMP '2024-02-10') - epoch(date_trunc('second', u)))::BIGINT // 3600 AS age_hours,
  CASE WHEN u IS NULL THEN 'MISSING' WHEN (epoch(TIMESTAMP '2024-02-10') - epoch(date_trunc('second', u)))::BIGINT // 3600 > max_age_hours THEN 'STALE' ELSE 'FRESH' END AS status FROM j""")
def freshness_matrix(spark, d):
    e = table(spark, d, "events")
    kind = F.when(F.col("event_id") % 3 == 0, "COMPLETE").when(F.col("event_id") % 3 == 1, "DELTA").otherwise("PARTIAL")
    runs = e.select(F.col("event_type").alias("source"), F.col("event_id").alias("run_id"), F.col("ts").alias("acquired"), kind.alias("completeness"))
    policy = spark.createDataFrame([("click", 1), ("view", 10000), ("error", 5), ("absent", 5)], "source string, max_age_hours int")
    return resolution.freshness(runs, policy, F.expr("TIMESTAMP_NTZ '2024-02-10 00:00:00'"))


@query("""SELECT u.product, u.policy_id, count(*) AS n_assertions FROM (SELECT l_orderkey * 10 + l_linenumber AS a, min({'product': l_returnflag, 'policy_id': l_linestatus}) AS u FROM lineitem GROUP BY 1) GROUP BY ALL""")
def attribution_counts(spark, d):
    li = table(spark, d, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("assertion_id"), F.col("l_returnflag").alias("product"), F.col("l_linestatus").alias("policy_id"))
    return resolution.attribution([li.where("product <> 'A'"), li, li.where("product = 'A'")])


@query("""SELECT * FROM (SELECT l_orderkey AS asset, l_partkey AS candidate, l_quantity AS score, l_discount = 0.05 AS exact, row_number() OVER w AS r, lead(l_quantity) OVER w AS nx, lead(l_discount = 0.05) OVER w AS ne FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_discount = 0.05 DESC, l_quantity DESC, l_partkey)) s
SELECT asset, CASE WHEN exact AND NOT coalesce(ne, false) THEN 'EXACT' WHEN exact OR score - coalesce(nx, 0) >= 5 THEN 'REVIEW_REQUIRED' ELSE 'ABSTAIN' END AS decision, CASE WHEN exact OR score - coalesce(nx, 0) >= 5 THEN candidate END AS candidate FROM s WHERE r = 1""".replace("SELECT * FROM (", "WITH s AS (", 1).replace(") s\n", ")\n", 1))
def match_decisions(spark, d):
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("asset"), F.col("l_partkey").alias("candidate"), F.col("l_quantity").alias("score"), (F.col("l_discount") == 0.05).alias("exact"))
    return resolution.match_decision(li, 5.0)


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity <= 5 THEN 0.0 WHEN l_quantity <= 20 THEN 0.0 + (l_quantity - 5) * 0.04 WHEN l_quantity <= 40 THEN 0.6 + (l_quantity - 20) * 0.02 ELSE 1.0 END AS score FROM lineitem""")
def calibrated_scores(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.round(resolution.calibrate(F.col("l_quantity"), [(5.0, 0.0), (20.0, 0.6), (40.0, 1.0)]), 6).alias("score"))


# --- projection ---------------------------------------------------------------------------------------------------


@query("""WITH t AS (SELECT DISTINCT o_custkey AS entity_key, CASE o_orderstatus WHEN 'F' THEN 'en' WHEN 'O' THEN 'zh-hant' ELSE 'fr' END AS language, CASE o_orderpriority WHEN '1-URGENT' THEN 'PRIMARY' WHEN '2-HIGH' THEN 'ORIGINAL' ELSE 'ALIAS' END AS role, o_orderpriority AS title FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY entity_key ORDER BY CASE language WHEN 'zh-hans' THEN 0 WHEN 'zh-hant' THEN 1 WHEN 'zh' THEN 2 WHEN 'en' THEN 3 WHEN 'und' THEN 4 ELSE 5 END, language, CASE role WHEN 'PRIMARY' THEN 0 WHEN 'TITLE' THEN 1 WHEN 'ALIAS' THEN 10 ELSE 5 END, lower(title), title, role) AS n FROM t)
SELECT entity_key, string_agg(language || '/' || role || '/' || title, ';' ORDER BY n) FILTER (n <= 3) AS titles, greatest(count(*) - 3, 0)::INTEGER AS titles_overflow FROM r GROUP BY 1""")
def bounded_titles(spark, d):
    o = table(spark, d, "orders")
    language = F.when(F.col("o_orderstatus") == "F", "EN").when(F.col("o_orderstatus") == "O", "zh_Hant").otherwise("fr")
    role = F.when(F.col("o_orderpriority") == "1-URGENT", "PRIMARY").when(F.col("o_orderpriority") == "2-HIGH", "ORIGINAL").otherwise("ALIAS")
    rows = o.select(F.col("o_custkey").alias("entity_key"), language.alias("language"), role.alias("role"), F.col("o_orderpriority").alias("title"))
    out = projection.titles(rows, 3)
    return out.withColumn("titles", F.array_join(F.transform("titles", lambda x: F.concat_ws("/", x["language"], x["role"], x["title"])), ";"))


HIERARCHY_SQL = """r AS (SELECT DISTINCT l_orderkey AS child, CASE WHEN l_linenumber = 1 THEN -l_suppkey ELSE l_partkey END AS parent, CASE WHEN l_linenumber = 1 THEN 'SEASON' ELSE 'SERIES' END AS level FROM lineitem
  UNION SELECT -s_suppkey, CASE WHEN s_suppkey % 4 <> 0 THEN s_nationkey::BIGINT END, 'SERIES' FROM supplier),
g AS (SELECT child, CASE WHEN count(DISTINCT parent) FILTER (level = 'SEASON') = 1 THEN min(parent) FILTER (level = 'SEASON') END AS season, count(DISTINCT parent) FILTER (level = 'SERIES') AS n, min(parent) FILTER (level = 'SERIES') AS one, greatest(count(DISTINCT parent) - 16, 0) AS overflow FROM r GROUP BY 1)"""


@query(f"""WITH {HIERARCHY_SQL} SELECT g.child, CASE WHEN g.overflow = 0 THEN g.season END AS season, CASE WHEN g.overflow > 0 THEN NULL WHEN g.n = 1 THEN g.one WHEN g.n = 0 THEN CASE WHEN u.n = 1 THEN u.one END END AS series, g.overflow FROM g LEFT JOIN g u ON u.child = g.season""")
def hierarchy_projection(spark, d):
    li = table(spark, d, "lineitem")
    season = F.col("l_linenumber") == 1
    lines = li.select(F.col("l_orderkey").alias("child"), F.when(season, -F.col("l_suppkey")).otherwise(F.col("l_partkey")).alias("parent"), F.when(season, "SEASON").otherwise("SERIES").alias("level"))
    upper = table(spark, d, "supplier").select((-F.col("s_suppkey")).alias("child"), F.when(F.col("s_suppkey") % 4 != 0, F.col("s_nationkey").cast("long")).alias("parent"), F.lit("SERIES").alias("level"))
    return projection.hierarchy(lines.unionByName(upper))


@query("""WITH o AS (SELECT o_custkey AS entity_key, o_orderkey AS k FROM orders), r AS (SELECT *, row_number() OVER (PARTITION BY entity_key ORDER BY k) AS n FROM o),
ids AS (SELECT entity_key, string_agg(k::VARCHAR, ',' ORDER BY k) FILTER (n <= 4) AS ids, greatest(count(*) - 4, 0)::INTEGER AS ids_overflow FROM r GROUP BY 1)
SELECT c_custkey AS entity_key, ids, ids_overflow, CASE WHEN c_nationkey = 0 THEN c_nationkey WHEN c_nationkey % 2 = 0 THEN c_nationkey END AS year,
  concat_ws(',', CASE WHEN c_acctbal > 5000 THEN 'rich' END, CASE WHEN c_acctbal < 0 THEN 'debt' END, CASE WHEN c_mktsegment = 'BUILDING' THEN 'building' END) AS facets
FROM customer LEFT JOIN ids ON entity_key = c_custkey""")
def search_documents(spark, d):
    c = table(spark, d, "customer")
    n = F.col("c_nationkey")
    entities = c.select(
        F.col("c_custkey").alias("entity_key"),
        projection.release_year(n, F.when(n % 2 == 0, n).otherwise(n + 1)).alias("year"),
        F.array_join(projection.facets({"rich": F.col("c_acctbal") > 5000, "debt": F.col("c_acctbal") < 0, "building": F.col("c_mktsegment") == "BUILDING"}), ",").alias("facets"),
    )
    ids = projection.bounded(table(spark, d, "orders").withColumnRenamed("o_custkey", "entity_key"), "entity_key", "ids", F.col("o_orderkey"), 4)
    ids = ids.withColumn("ids", F.array_join(F.col("ids").cast("array<string>"), ","))
    return projection.documents(entities, [ids])


@query("""SELECT c_custkey AS key, CASE WHEN c_custkey % 5 = 0 THEN 'new' ELSE 'old' END AS version FROM customer WHERE c_custkey % 7 <> 0""")
def incremental_index(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("key"))
    return projection.overlay(c.withColumn("version", F.lit("old")), c.where("key % 5 = 0").withColumn("version", F.lit("new")), c.where("key % 7 = 0"), "key")


@query("""WITH e AS (SELECT c_custkey AS k FROM customer), p AS (SELECT k FROM e WHERE k % 11 <> 0), i AS (SELECT k FROM p WHERE k % 13 <> 0)
SELECT (SELECT count(*) FROM e) AS n_entities, (SELECT count(*) FROM p) AS n_projected, (SELECT count(*) FROM i) AS n_indexed, (SELECT count(*) FROM e WHERE k % 11 = 0) AS n_unprojected, (SELECT count(*) FROM p WHERE k % 13 = 0) AS n_unindexed, false AS reconciled""")
def count_reconciliation(spark, d):
    e = table(spark, d, "customer").select(F.col("c_custkey").alias("k"))
    return projection.reconcile(e, e.where("k % 11 <> 0"), e.where("k % 11 <> 0 AND k % 13 <> 0"), "k")


# --- digests, paging, arithmetic ----------------------------------------------------------------------------------

_H = "sha256('{\"o_orderkey\":' || o_orderkey || ',\"o_orderstatus\":\"' || o_orderstatus || '\"}')"
_L = [f"('0x' || substr({_H}, {1 + 15 * i}, 15))::BIGINT" for i in range(4)]


@query("SELECT count(*) AS n, " + ", ".join(f"bit_xor({x}) AS xor_{i}, (sum({x}::HUGEINT) % {1 << 60})::BIGINT AS sum_{i}" for i, x in enumerate(_L)) + " FROM orders")
def multiset_digest(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return digests.multiset_digest(o, digests.row_key(["o_orderkey", "o_orderstatus"]))


@query("""SELECT substr(h, 1, 2) AS bucket, count(*) AS n, sha256(string_agg(h, chr(10) ORDER BY h)) AS digest FROM (SELECT DISTINCT sha256(o_orderkey::VARCHAR) AS h FROM orders) GROUP BY 1""")
def run_set_digest(spark, d):
    return digests.bucketed_digest(table(spark, d, "orders"), "o_orderkey")


@query("""SELECT p_partkey, s AS shard, (row_number() OVER (PARTITION BY s ORDER BY p_partkey) - 1)::INTEGER AS position, ((row_number() OVER (PARTITION BY s ORDER BY p_partkey) - 1) // 25)::INTEGER AS page
FROM (SELECT p_partkey, (('0x' || substr(sha256(p_partkey::VARCHAR), 1, 8))::BIGINT % 8)::INTEGER AS s FROM part)""")
def discovery_pages(spark, d):
    return digests.pages(table(spark, d, "part"), "p_partkey", 8, 25)


@query("""SELECT ((r - 1) // 100)::INTEGER AS "window", min(k) AS first, max(k) AS last, count(*) AS n FROM (SELECT k, row_number() OVER (ORDER BY k) AS r FROM (SELECT DISTINCT o_custkey AS k FROM orders)) GROUP BY 1""")
def capture_windows(spark, d):
    return digests.windows(table(spark, d, "orders"), "o_custkey", 100)


@query("""SELECT epoch, shard, count(*) AS n, min(partition) AS low, max(partition) AS high FROM (SELECT o_orderkey % 256 AS shard, (o_orderkey // 256) % 64 AS partition, o_orderkey // (256 * 64) AS epoch FROM orders) GROUP BY ALL""")
def shard_arithmetic(spark, d):
    return digests.shard_arithmetic(table(spark, d, "orders"), "o_orderkey", 256, 64).groupBy("epoch", "shard").agg(F.count("*").alias("n"), F.min("partition").alias("low"), F.max("partition").alias("high"))


@query("""SELECT lang, count(*) AS n, sum(n_chars)::BIGINT AS size, greatest(1, ceil(count(*) / 100), ceil(sum(n_chars) * 1.3::DOUBLE / 100000))::BIGINT AS primary_shards FROM documents GROUP BY 1""")
def index_sizing(spark, d):
    return digests.sizing(table(spark, d, "documents").groupBy("lang").agg(F.count("*").alias("n"), F.sum("n_chars").alias("size")), "n", "size", 100, 100_000)


@query("""SELECT event_type, count(*) AS n, sum(CAST(json_extract_string(props, '$.k') AS BIGINT))::BIGINT AS k, count(*) FILTER (CAST(json_extract_string(props, '$.k') AS BIGINT) > 50) AS large FROM events GROUP BY 1""")
def json_projection(spark, d):
    k = F.from_json("props", "k bigint").k
    return table(spark, d, "events").select("event_type", k.alias("k")).groupBy("event_type").agg(F.count("*").alias("n"), F.sum("k").alias("k"), F.count_if(F.col("k") > 50).alias("large"))


@query("""SELECT l_suppkey, count(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_partkey END) AS returned, count(DISTINCT CASE WHEN l_quantity > 25 THEN l_orderkey END) AS bulk, arg_min(l_partkey, (l_shipdate, l_partkey, l_orderkey)) AS first_part FROM lineitem GROUP BY 1""")
def conditional_distincts(spark, d):
    li = table(spark, d, "lineitem")
    return li.groupBy("l_suppkey").agg(F.count_distinct(F.when(F.col("l_returnflag") == "R", F.col("l_partkey"))).alias("returned"), F.count_distinct(F.when(F.col("l_quantity") > 25, F.col("l_orderkey"))).alias("bulk"), F.min_by("l_partkey", F.struct("l_shipdate", "l_partkey", "l_orderkey")).alias("first_part"))


@query("""SELECT k, string_agg(p || '=' || n, ',' ORDER BY p) AS counts FROM (SELECT o_custkey AS k, o_orderstatus AS p, count(*) AS n FROM orders GROUP BY ALL) GROUP BY k""")
def two_level_counts(spark, d):
    o = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("k"), F.col("o_orderstatus").alias("p")).agg(F.count("*").alias("n"))
    sets = o.groupBy("k").agg(F.sort_array(F.collect_set(F.struct("p", "n"))).alias("s"))
    return sets.select("k", F.array_join(F.transform("s", lambda x: F.concat(x["p"], F.lit("="), x["n"].cast("string"))), ",").alias("counts"))


# --- curation -----------------------------------------------------------------------------------------------------


@query("""WITH d AS (SELECT c_custkey AS node_id, CASE c_custkey % 4 WHEN 0 THEN 'ACCEPT' WHEN 1 THEN 'REJECT' WHEN 2 THEN 'SPLIT' END AS action FROM customer)
SELECT c_custkey AS node_id, CASE action WHEN 'ACCEPT' THEN 99 WHEN 'SPLIT' THEN 100 ELSE c_nationkey END AS entity_key FROM customer JOIN d ON d.node_id = c_custkey WHERE coalesce(action, '') <> 'REJECT'""")
def curated_memberships(spark, d):
    from gneiss.operators import curation

    c, k = table(spark, d, "customer"), F.col("c_custkey") % 4
    members = c.select(F.col("c_custkey").alias("node_id"), F.col("c_nationkey").alias("entity_key"))
    entities = table(spark, d, "nation").select(F.col("n_nationkey").alias("entity_key"), F.col("n_nationkey").alias("created_at"), F.lit("l").alias("level"), F.lit("k").alias("kind"))
    action = F.when(k == 0, "ACCEPT").when(k == 1, "REJECT").when(k == 2, "SPLIT")
    target = F.when(k == 0, 99).when(k == 2, 100)
    decisions = c.select(F.col("c_custkey").alias("decision_id"), action.alias("action"), F.col("c_custkey").alias("node_id"), F.lit(None).cast("int").alias("entity_key"), target.alias("target_key"))
    return curation.apply_decisions(members, entities, decisions)[0]


@query("""SELECT k AS target, k + CASE WHEN k % 2 = 0 THEN 1 ELSE 3 END AS source
FROM (SELECT p_partkey * 8 + e AS k FROM part, (VALUES (0), (3)) v(e))""")
def curated_redirects(spark, d):
    from gneiss.operators import curation

    # a part is four entities; the first two merge, the younger into the older, and the last is redirected to the third
    p = table(spark, d, "part").select((F.col("p_partkey") * 8).alias("k"))
    entities = p.select(F.explode(F.array(*[F.col("k") + i for i in (0, 1, 3, 6)])).alias("entity_key"))
    entities = entities.select("entity_key", F.col("entity_key").alias("created_at"), F.lit("l").alias("level"), F.lit("k").alias("kind"))
    merges = p.select(F.col("k").alias("decision_id"), F.lit("MERGE").alias("action"), F.col("k").alias("entity_key"), (F.col("k") + 1).alias("target_key"))
    moved = p.select((F.col("k") + 3).alias("decision_id"), F.lit("REDIRECT").alias("action"), (F.col("k") + 6).alias("entity_key"), (F.col("k") + 3).alias("target_key"))
    decisions = merges.unionByName(moved).withColumn("node_id", F.lit(None).cast("long"))
    none = entities.select(F.col("entity_key").alias("node_id"), "entity_key").where("false")
    return curation.apply_decisions(none, entities, decisions)[1]


@query("""WITH c AS (SELECT c_custkey AS entity_key FROM customer WHERE c_acctbal < -900), r AS (SELECT DISTINCT l_suppkey AS a, o_custkey AS b FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
SELECT entity_key FROM c UNION SELECT a FROM r WHERE b IN (SELECT entity_key FROM c) UNION SELECT b FROM r WHERE a IN (SELECT entity_key FROM c)""")
def affected_entities(spark, d):
    from gneiss.operators import curation

    changed = table(spark, d, "customer").where("c_acctbal < -900").select(F.col("c_custkey").alias("entity_key"))
    li = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("o_orderkey") == F.col("l_orderkey"))
    return curation.affected_keys(changed, li.select(F.col("l_suppkey").alias("a"), F.col("o_custkey").alias("b")).distinct())


@query("""SELECT p_partkey, p_brand LIKE '%1' AND p_size % 2 = 0 AND p_size <= 20 AS exact FROM part""")
def music_exactness(spark, d):
    from gneiss.operators import curation

    p = table(spark, d, "part")
    rows = p.select("p_partkey", F.when(F.col("p_brand").endswith("1"), "recording").otherwise("work").alias("kind"), F.when(F.col("p_size") % 2 == 0, F.col("p_size")).alias("recording_id"), F.lit(0).alias("n_conflicts"), F.when(F.col("p_size") <= 20, 1).otherwise(2).alias("n_variants"))
    return curation.music_exactness(rows).select("p_partkey", "exact")


# --- composites ---------------------------------------------------------------------------------------------------


@query("""WITH r(source, target, effective_at) AS (SELECT c_custkey, CASE WHEN c_custkey % 20 = 0 THEN c_custkey - 10 ELSE c_custkey - 1 END, CASE WHEN c_custkey % 30 = 0 THEN DATE '2030-01-01' ELSE DATE '1990-01-01' END FROM customer WHERE c_custkey % 10 = 0 AND c_custkey > 10),
live AS (SELECT * FROM r WHERE effective_at <= DATE '2000-01-01'),
m AS (SELECT o_orderkey AS node_id, o_custkey AS entity_key FROM orders)
SELECT m.node_id, coalesce(b.target, a.target, m.entity_key) AS entity_key, c_nationkey AS level, c_mktsegment AS kind, 'ACTIVE' AS status
FROM m LEFT JOIN live a ON a.source = m.entity_key LEFT JOIN live b ON b.source = a.target JOIN customer ON c_custkey = coalesce(b.target, a.target, m.entity_key)""")
def resolved_memberships(spark, d):
    c = table(spark, d, "customer")
    m = table(spark, d, "orders").select(F.col("o_orderkey").alias("node_id"), F.col("o_custkey").alias("entity_key"), F.lit(1).alias("membership_key"), F.to_date(F.lit("1990-01-01")).alias("valid_from"), F.lit(None).cast("date").alias("valid_to"))
    key = F.col("c_custkey")
    r = c.where((key % 10 == 0) & (key > 10)).select(
        key.alias("source"), F.when(key % 20 == 0, key - 10).otherwise(key - 1).alias("target"), F.when(key % 30 == 0, F.to_date(F.lit("2030-01-01"))).otherwise(F.to_date(F.lit("1990-01-01"))).alias("effective_at")
    )
    ledger = c.select(key.alias("entity_key"), F.col("c_nationkey").alias("level"), F.col("c_mktsegment").alias("kind"), F.lit("ACTIVE").alias("status"))
    return composites.resolved_memberships(m, r, ledger, F.to_date(F.lit("2000-01-01")))


@query("""WITH a AS (SELECT l.*, o_orderdate, l_returnflag AS policy, l_shipdate + to_days(l_quantity::INTEGER * 20) AS until FROM lineitem l JOIN orders ON o_orderkey = l_orderkey),
s AS (SELECT CASE WHEN l_returnflag = 'R' AND l_linenumber % 2 = 0 THEN 'FENCED' WHEN l_returnflag = 'R' THEN 'NO_RIGHTS'
  WHEN l_shipdate > TIMESTAMP '1996-01-01' OR l_linestatus = 'F' AND until <= TIMESTAMP '1996-01-01' THEN 'NOT_VALID'
  WHEN l_returnflag = 'N' AND o_orderdate + INTERVAL 365 DAY <= TIMESTAMP '1996-01-01' THEN 'EXPIRED_LEASE'
  WHEN l_orderkey % 7 = 0 THEN 'NOT_CURRENT' END AS reason, l_partkey FROM a)
SELECT CASE WHEN reason IS NOT NULL THEN 'WITHHELD' WHEN l_partkey % 3 = 0 THEN 'UNRESOLVED' ELSE 'RESOLVED' END AS outcome, coalesce(reason, '') AS reason,
  count(*) AS n, coalesce(sum(CASE WHEN reason IS NULL AND l_partkey % 3 <> 0 THEN l_partkey * 2 END), 0)::BIGINT AS entities FROM s GROUP BY 1, 2""")
def eligible_assertions(spark, d):
    at = F.expr("TIMESTAMP_NTZ '1996-01-01 00:00:00'")
    li = table(spark, d, "lineitem").join(table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey")
    until = F.col("l_shipdate") + F.make_dt_interval((F.col("l_quantity").cast("int") * 20))
    policy_id, digest = F.col("l_returnflag"), F.lower("l_returnflag")
    envelope = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_shipdate")
    rows = li.select(
        envelope.alias("assertion_id"),
        F.lit("ACTIVE").alias("status"),
        envelope.alias("envelope_key"),
        F.col("l_linestatus").alias("run_id"),
        policy_id.alias("policy_id"),
        digest.alias("policy_digest"),
        F.col("o_orderdate").alias("observed_at"),
        F.col("l_shipdate").alias("valid_from"),
        F.when(F.col("l_linestatus") == "F", until).alias("valid_to"),
        F.col("l_partkey").alias("node_id"),
        "l_orderkey",
        (F.col("l_linenumber") % 2).alias("half"),
    )
    product = F.concat_ws("/", "policy_id", F.col("half").cast("string"))
    records = rows.select("envelope_key", "run_id", product.alias("product_id"), "policy_id", "policy_digest").distinct()
    products = rows.select(product.alias("product_id"), "policy_id").distinct()
    rights = spark.createDataFrame([("A", "a", True, None), ("N", "n", True, 365), ("R", "r", False, None)], "policy_id string, policy_digest string, allowed boolean, max_age_days int")
    fences = spark.createDataFrame([("R/0", "R", "DISPLAY"), ("A/0", "A", "TRAIN")], "product_id string, policy_id string, action string").withColumn("effective_at", F.expr("TIMESTAMP_NTZ '1995-01-01 00:00:00'"))
    current = rows.where("l_orderkey % 7 <> 0").select("envelope_key", "run_id")
    members = table(spark, d, "part").where("p_partkey % 3 <> 0").select(F.col("p_partkey").alias("node_id"), (F.col("p_partkey") * 2).alias("entity_key"))
    done = composites.eligible_assertions(rows.drop("half", "l_orderkey"), records, products, rights, fences, current, members, at, ["DISPLAY", "SEARCH"])
    return done.groupBy("outcome", F.coalesce("reason", F.lit("")).alias("reason")).agg(F.count("*").alias("n"), F.coalesce(F.sum("entity_key"), F.lit(0)).alias("entities"))


@query("""WITH e AS (SELECT event_type AS domain, user_id AS record_id, date_trunc('day', ts) AS day, CASE WHEN event_id % 11 = 0 THEN 'DELETE' ELSE 'UPSERT' END AS operation FROM events),
b AS (SELECT DISTINCT domain, day, CASE WHEN day = min(day) OVER (PARTITION BY domain) OR dayofmonth(day) % 4 = 0 THEN 'SNAPSHOT' ELSE 'DELTA' END AS kind FROM e),
s AS (SELECT domain, day, lag(day) OVER (PARTITION BY domain ORDER BY day) AS prev FROM b WHERE kind = 'SNAPSHOT')
SELECT DISTINCT s.domain, epoch(s.day)::BIGINT AS run_id, epoch(s.prev)::BIGINT AS previous_run, h.record_id FROM s JOIN e h ON h.domain = s.domain AND h.day >= s.prev AND h.day < s.day AND h.operation = 'UPSERT'
WHERE NOT EXISTS (SELECT 1 FROM e n WHERE n.domain = s.domain AND n.day = s.day AND n.record_id = h.record_id AND n.operation = 'UPSERT')""")
def snapshot_diff_absence(spark, d):
    day = F.date_trunc("day", F.col("ts").cast("timestamp"))
    e = table(spark, d, "events").select(F.col("event_type").alias("domain"), F.col("user_id").alias("record_id"), day.alias("acquired"), F.when(F.col("event_id") % 11 == 0, "DELETE").otherwise("UPSERT").alias("operation"))
    e = e.withColumn("run_id", F.unix_timestamp("acquired"))
    first = F.min("acquired").over(Window.partitionBy("domain"))
    b = e.select("domain", "run_id", "acquired").distinct().withColumn("kind", F.when((F.col("acquired") == first) | (F.dayofmonth("acquired") % 4 == 0), "SNAPSHOT").otherwise("DELTA"))
    return composites.snapshot_events(e.drop("acquired"), b, ["domain"])


@query("""WITH e(node, label) AS (SELECT 'o' || o_orderkey, 'MOVIE' FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT 'o' || o_orderkey, 'OTHER' FROM orders WHERE o_orderstatus <> 'F' UNION ALL SELECT 'c' || c_custkey, 'TV_SERIES_GROUP' FROM customer UNION ALL SELECT 'n' || n_nationkey, 'UNKNOWN' FROM nation UNION ALL SELECT 's' || s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'UNKNOWN' ELSE 'PERSON' END FROM supplier),
chosen AS (SELECT DISTINCT 'o' || o_orderkey AS node, 'MEDIA' AS role FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT DISTINCT 'c' || o_custkey, 'PARENT' FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT DISTINCT 'n' || c_nationkey, 'PARENT' FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus = 'F'),
credit AS (SELECT 's' || l_suppkey AS node, max(CASE WHEN l_linenumber = 1 THEN 'PERSON' ELSE 'ORGANIZATION' END) AS hint FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT node, label, role FROM chosen JOIN e USING (node) UNION ALL SELECT node, CASE WHEN label = 'UNKNOWN' THEN hint ELSE label END, 'CREDIT' FROM credit JOIN e USING (node)""")
def media_selection(spark, d):
    o, c, li = table(spark, d, "orders"), table(spark, d, "customer"), table(spark, d, "lineitem")
    name = lambda letter, column: F.concat(F.lit(letter), F.col(column).cast("string"))
    entities = o.select(name("o", "o_orderkey").alias("node"), F.when(F.col("o_orderstatus") == "F", "MOVIE").otherwise("OTHER").alias("label"))
    entities = entities.unionByName(c.select(name("c", "c_custkey").alias("node"), F.lit("TV_SERIES_GROUP").alias("label")))
    entities = entities.unionByName(table(spark, d, "nation").select(name("n", "n_nationkey").alias("node"), F.lit("UNKNOWN").alias("label")))
    entities = entities.unionByName(table(spark, d, "supplier").select(name("s", "s_suppkey").alias("node"), F.when(F.col("s_suppkey") % 2 == 0, "UNKNOWN").otherwise("PERSON").alias("label")))
    edges = o.select(name("o", "o_orderkey").alias("source"), F.lit("P179").alias("property"), name("c", "o_custkey").alias("target"))
    edges = edges.unionByName(c.select(name("c", "c_custkey").alias("source"), F.lit("P361").alias("property"), name("n", "c_nationkey").alias("target")))
    edges = edges.unionByName(li.select(name("o", "l_orderkey").alias("source"), F.when(F.col("l_linenumber") == 1, "P57").otherwise("P272").alias("property"), name("s", "l_suppkey").alias("target")))
    return composites.media_selection(entities, edges, ["MOVIE"], ["P179", "P361"], {"P57": "PERSON", "P272": "ORGANIZATION"})


@query("""WITH k AS (SELECT p_brand || p_size AS blocking_key, p_partkey AS entity_key FROM part UNION SELECT 'alias:' || p_brand || p_size, p_partkey FROM part WHERE p_size % 2 = 0 UNION SELECT p_brand || p_size, -p_partkey FROM part WHERE p_size > 45),
i AS (SELECT l_orderkey AS node_id, CASE WHEN l_linenumber % 2 = 0 THEN 'alias:' ELSE '' END || p_brand || p_size AS blocking_key FROM lineitem JOIN part ON p_partkey = l_partkey)
SELECT node_id, entity_key, count(DISTINCT blocking_key) AS n_keys FROM i JOIN k USING (blocking_key) GROUP BY ALL""")
def candidate_links(spark, d):
    p = table(spark, d, "part")
    own = F.concat(F.col("p_brand"), F.col("p_size").cast("string"))
    stored = p.select(own.alias("blocking_key"), F.col("p_partkey").alias("entity_key"))
    aliases = p.where("p_size % 2 = 0").select(own.alias("alias_key"), F.concat(F.lit("alias:"), own).alias("blocking_key")).distinct()
    assigned = p.where("p_size > 45").select(own.alias("blocking_key"), (-F.col("p_partkey")).alias("entity_key"))
    li = table(spark, d, "lineitem").join(p.select(F.col("p_partkey").alias("l_partkey"), own.alias("k")), "l_partkey")
    nodes = li.select(F.col("l_orderkey").alias("node_id"), F.concat(F.when(F.col("l_linenumber") % 2 == 0, "alias:").otherwise(""), "k").alias("blocking_key"))
    return composites.candidate_links(nodes, composites.known_identifiers(stored, aliases, assigned))


@query("""SELECT l_suppkey AS subject_entity, 'shipped' AS predicate, o_custkey AS object_entity, l_orderkey * 10 + l_linenumber AS assertion_id FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_custkey % 4 <> 0""")
def relation_objects(spark, d):
    li = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("subject_entity"), F.lit("shipped").alias("predicate"), F.col("l_orderkey").alias("object_node"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("assertion_id"))
    return composites.relation_objects(li, table(spark, d, "orders").where("o_custkey % 4 <> 0").select(F.col("o_orderkey").alias("node_id"), F.col("o_custkey").alias("entity_key")))


@query("""WITH a AS (SELECT l_suppkey AS entity, CASE l_linenumber WHEN 1 THEN 'title' WHEN 2 THEN 'genre' WHEN 3 THEN 'score' WHEN 4 THEN 'release_year' ELSE 'rating_average' END AS predicate, l_returnflag AS value, l_orderkey * 10 + l_linenumber AS id,
  CASE l_linestatus WHEN 'F' THEN 'tmdb-research' ELSE 'imdb-non-commercial-datasets' END AS source, CASE WHEN l_quantity > 25 THEN 'en' END AS language FROM lineitem),
r AS (SELECT *, CASE WHEN predicate = 'title' THEN '{"language":' || CASE WHEN language IS NULL THEN 'null' ELSE '"' || language || '"' END || ',"region":null,"titleRole":"PRIMARY"}' WHEN predicate = 'genre' THEN '{"vocabulary":null}' ELSE '{}' END AS scope_json,
  CASE source WHEN 'tmdb-research' THEN 1 ELSE 0 END AS rank FROM a),
one AS (SELECT entity, predicate, scope_json, value, id FROM r WHERE predicate IN ('title', 'release_year') QUALIFY rank = min(rank) OVER (PARTITION BY entity, predicate, scope_json))
SELECT entity, predicate, scope_json, arg_min(value, id) AS value, min(id) AS winner, CASE WHEN count(DISTINCT value) = 1 THEN 'SELECTED' ELSE 'CONFLICTED' END AS status FROM one GROUP BY 1, 2, 3
UNION ALL SELECT entity, predicate, scope_json, value, arg_min(id, (rank, id)), 'SET' FROM r WHERE predicate IN ('genre', 'score') GROUP BY 1, 2, 3, 4""")
def policy_resolution(spark, d):
    li, n = table(spark, d, "lineitem"), F.col("l_linenumber")
    rows = li.select(
        F.col("l_suppkey").alias("entity"),
        F.lit("FIELD").alias("kind"),
        F.when(n == 1, "title").when(n == 2, "genre").when(n == 3, "score").when(n == 4, "release_year").otherwise("rating_average").alias("predicate"),
        F.col("l_returnflag").alias("value"),
        (F.col("l_orderkey") * 10 + n).alias("assertion_id"),
        F.when(F.col("l_linestatus") == "F", "tmdb-research").otherwise("imdb-non-commercial-datasets").alias("source"),
        F.to_json(F.struct(F.when(F.col("l_quantity") > 25, "en").alias("language"), F.lit("PRIMARY").alias("titleRole"), F.lit("x").alias("other"))).alias("qualifiers_json"),
    )
    return policy.resolve(rows).drop("kind")


@query("""WITH n AS (SELECT unnest(range(0, (SELECT count(*) FROM orders))) AS id), c AS (SELECT id, id // 8 AS c FROM n)
SELECT id AS node_id, 'c' || lpad(c::VARCHAR, 12, '0') AS blocking_key FROM c UNION ALL SELECT id, 'c' || lpad((c + 1)::VARCHAR, 12, '0') FROM c WHERE c % 20 = 0 AND id % 8 = 0 AND id + 8 < (SELECT count(*) FROM orders)""")
def synthetic_identities(spark, d):
    return composites.synthetic_identities(spark, table(spark, d, "orders").count())


@query("""SELECT l_returnflag AS policy_id, l_linestatus AS product_id, count(*) AS n FROM lineitem WHERE l_returnflag <> CASE l_linestatus WHEN 'F' THEN 'A' ELSE 'N' END GROUP BY ALL""")
def policy_owners(spark, d):
    products = spark.createDataFrame([("F", "A"), ("O", "N")], "product_id string, policy_id string")
    return composites.policy_owners(table(spark, d, "lineitem").select(F.col("l_returnflag").alias("policy_id"), F.col("l_linestatus").alias("product_id")), products)
