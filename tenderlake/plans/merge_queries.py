"""Keyed merges, history and maintenance on the driver's tables, with their SQL."""

from pyspark.sql import functions as F

from tenderlake.functions import scalars as S
from tenderlake.operators import merge as E
from tenderlake.plans.stat_queries import LIST_SQL, worklist
from tenderlake.plans.tables import AS_OF, Tables, with_views

QUERIES, SQL = {}, {}


def query(name: str, sql: str, views: bool = False):
    def add(f):
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        SQL[name] = with_views(sql) if views else sql
        return f

    return add


def registry(t, new: bool):
    rows = t.orders.where("o_orderkey % 4 <> 0" if new else "o_orderkey % 3 <> 0")
    number = F.when(F.col("o_orderkey") % 5 != 0, F.concat(F.lit("new-" if new else "old-"), "o_custkey"))
    day = F.col("o_orderdate") + F.make_dt_interval(days=F.lit(100)) if new else F.col("o_orderdate")
    return rows.select(
        F.col("o_orderkey").alias("key"),
        number.alias("business_number"),
        F.concat(F.lit("/b/" if new else "/a/"), "o_orderkey").alias("canonical_url"),
        F.when(F.col("o_orderkey") % 7 != 0, F.concat(F.lit('{"s":"'), "o_orderstatus", F.lit('"}'))).otherwise(F.lit("{}")).alias("summary_payload"),
        F.date_format(day, "yyyy-MM-dd").alias("first_seen_at"),
        F.date_format(day, "yyyy-MM-dd").alias("last_seen_at"),
    )


def registry_sql(new: bool) -> str:
    p, u, w = ("new-", "/b/", "o_orderkey % 4 <> 0") if new else ("old-", "/a/", "o_orderkey % 3 <> 0")
    d = "o_orderdate + INTERVAL 100 DAY" if new else "o_orderdate"
    return f"""(SELECT o_orderkey AS key, CASE WHEN o_orderkey % 5 <> 0 THEN concat('{p}', o_custkey) END AS bn, concat('{u}', o_orderkey) AS url, CASE WHEN o_orderkey % 7 <> 0 THEN concat('{{"s":"', o_orderstatus, '"}}') ELSE '{{}}' END AS sp,
    strftime({d}, '%Y-%m-%d') AS d FROM orders WHERE {w})"""


@query(
    "e1_upsert_registry",
    f"""SELECT coalesce(n.key, o.key) AS key, coalesce(n.bn, o.bn) AS business_number, coalesce(n.url, o.url) AS canonical_url, coalesce(nullif(n.sp, '{{}}'), o.sp) AS summary_payload,
    coalesce(least(o.d, n.d), o.d, n.d) AS first_seen_at, coalesce(greatest(o.d, n.d), o.d, n.d) AS last_seen_at FROM {registry_sql(False)} o FULL JOIN {registry_sql(True)} n ON n.key = o.key""",
)
def upsert_registry(t):
    return E.upsert_registry(registry(t, False), registry(t, True), ["key"])


def customers(t, new: bool):
    rows = t.customer.where("c_custkey % 5 <> 0" if new else "c_custkey % 4 <> 0")
    segment = F.when(F.col("c_custkey") % 3 == 0, F.lit("CHANGED")).otherwise(F.col("c_mktsegment")) if new else F.col("c_mktsegment")
    rows = rows.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), segment.alias("segment"))
    when = F.lit("2024-02-02" if new else "2024-01-01")
    return E.hashed(rows, ["name", "segment"]).withColumn("last_success_at", when).withColumn("updated_at", when)


CUST = """o AS (SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment FROM customer WHERE c_custkey % 4 <> 0),
n AS (SELECT c_custkey AS key, c_name AS name, CASE WHEN c_custkey % 3 = 0 THEN 'CHANGED' ELSE c_mktsegment END AS segment FROM customer WHERE c_custkey % 5 <> 0)"""


@query(
    "e2_upsert_by_hash",
    f"""WITH {CUST}, j AS (SELECT coalesce(n.key, o.key) AS key, coalesce(n.name, o.name) AS name, coalesce(n.segment, o.segment) AS segment,
    CASE WHEN o.key IS NULL THEN 'new' WHEN n.key IS NULL THEN 'kept' WHEN o.segment = n.segment THEN 'unchanged' ELSE 'changed' END AS change FROM o FULL JOIN n ON n.key = o.key)
    SELECT key, name, segment, CASE change WHEN 'kept' THEN '2024-01-01' ELSE '2024-02-02' END AS last_success_at, CASE WHEN change IN ('new', 'changed') THEN '2024-02-02' ELSE '2024-01-01' END AS updated_at, change,
    sha256(concat_ws(chr(31), '=' || name, '=' || segment)) AS content_hash FROM j""",
)
def upsert_by_hash(t):
    return E.upsert_by_hash(customers(t, False), customers(t, True), ["key"])


@query("e3_revisions", f"""WITH {CUST} SELECT o.key, sha256(concat_ws(chr(31), '=' || o.name, '=' || o.segment)) AS content_hash, concat('{{"name":"', o.name, '","segment":"', o.segment, '"}}') AS payload FROM o JOIN n USING (key) WHERE o.segment <> n.segment""")
def revisions(t):
    return E.revisions(customers(t, False), customers(t, True), ["key"], ["name", "segment"])


@query(
    "e4_replace_children",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'old' AS version FROM lineitem WHERE l_orderkey % 5 <> 0 UNION ALL
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'new' FROM lineitem WHERE l_orderkey % 5 = 0 AND l_linenumber % 2 = 0 AND l_orderkey IN (SELECT o_orderkey FROM orders)""",
)
def replace_children(t):
    children = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    owners = t.orders.where("o_orderkey % 5 = 0").select(F.col("o_orderkey").alias("l_orderkey"))
    fresh = children.where("l_linenumber % 2 = 0").withColumn("version", F.lit("new"))
    return E.replace_children(children.withColumn("version", F.lit("old")), fresh, owners, ["l_orderkey"])


def seen(t, new: bool):
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    rows = t.lineitem.where("l_linenumber % 3 <> 0" if new else "l_linenumber % 2 = 1")
    return rows.groupBy("l_orderkey", "l_partkey").agg(F.min(day).alias("first_seen_at"), F.max(day).alias("last_seen_at"))


@query("e5_upsert_relations", "SELECT l_orderkey, l_partkey, strftime(min(l_shipdate), '%Y-%m-%d') AS first_seen_at, strftime(max(l_shipdate), '%Y-%m-%d') AS last_seen_at FROM lineitem WHERE l_linenumber % 3 <> 0 OR l_linenumber % 2 = 1 GROUP BY 1, 2")
def upsert_relations(t):
    return E.upsert_relations(seen(t, False), seen(t, True), ["l_orderkey", "l_partkey"])


@query("e6_vanished_relations", "SELECT parent_id, child_id FROM v_edge WHERE relation_type = 'notice_to_lot' AND parent_id IN (SELECT source_entity_id FROM v_notice WHERE status = 'F') AND child_id NOT IN (SELECT source_entity_id FROM v_lot WHERE l_linenumber < 4)", views=True)
def vanished_relations(t):
    edges = t.edges().where("relation_type = 'notice_to_lot'").select("parent_id", "child_id")
    desired = t.lot().where("l_linenumber < 4").select(F.col("l_orderkey").cast("string").alias("parent_id"), F.col("source_entity_id").alias("child_id"))
    parents = t.notice().where("status = 'F'").select(F.col("source_entity_id").alias("parent_id"))
    return E.vanished_relations(edges, desired, parents, "parent_id", ["parent_id", "child_id"])


@query("e7_batch_identities", "SELECT 'notice' AS entity_type, CAST(o_orderkey AS VARCHAR) AS source_entity_id FROM orders UNION SELECT 'plan_item', parent_id FROM v_edge WHERE relation_type = 'plan_to_lot' UNION SELECT 'lot', child_id FROM v_edge WHERE relation_type = 'plan_to_lot'", views=True)
def batch_identities(t):
    edges = t.edges().where("relation_type = 'plan_to_lot'")
    return E.batch_identities(t.notice().select("entity_type", "source_entity_id"), edges.select(F.lit("plan_item").alias("entity_type"), F.col("parent_id").alias("source_entity_id")), edges.select(F.lit("lot").alias("entity_type"), F.col("child_id").alias("source_entity_id")))


@query(
    "e8_replay",
    """WITH s AS (SELECT *, sha256(concat_ws(chr(31), '=' || l_partkey, '=' || l_suppkey)) AS h FROM lineitem), l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, h DESC) AS rn FROM s) WHERE rn = 1)
    SELECT l_orderkey, l_linenumber, l_partkey, h AS content_hash, CASE WHEN l_linenumber = 1 AND l_orderkey % 2 = 0 THEN 'unchanged' ELSE 'new' END AS change FROM l""",
)
def replay(t):
    rows = E.hashed(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("fetched_at")), ["l_partkey", "l_suppkey"])
    keys = ["l_orderkey", "l_linenumber"]
    old = E.latest_per_key(rows, keys, [F.desc("fetched_at"), F.desc("content_hash")]).where("l_linenumber = 1 and l_orderkey % 2 = 0")
    old = old.select(*keys, "l_partkey", "content_hash", "fetched_at", F.lit("1990").alias("last_success_at"), F.lit("1990").alias("updated_at"))
    return E.replay(old, rows, keys, ["l_partkey"]).select(*keys, "l_partkey", "content_hash", "change")


@query(
    "e9_enqueue",
    """SELECT user_id, max(priority) AS priority, min(seen) AS available_at, max(attempt) AS attempt, arg_max(payload, (seen, payload)) AS payload FROM (
    SELECT user_id, CAST(event_id % 5 AS INTEGER) AS priority, strftime(ts, '%Y-%m-%d %H:%M:%S') AS seen, 2 AS attempt, props AS payload FROM events WHERE event_type = 'click' UNION ALL
    SELECT user_id, CAST(event_id % 9 AS INTEGER), strftime(ts, '%Y-%m-%d %H:%M:%S'), 0, props FROM events WHERE event_type = 'view' AND (event_id % 2 = 0 OR user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND user_id % 2 = 0))) GROUP BY 1""",
)
def enqueue(t):
    item = lambda kind, m: t.events.where(F.col("event_type") == kind).select("user_id", (F.col("event_id") % m).cast("int").alias("priority"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("available_at"), F.col("props").alias("payload"), (F.col("event_id") % 2 == 0).alias("refresh_existing"))
    known = item("click", 5).drop("refresh_existing").withColumn("attempt", F.lit(2))
    return E.enqueue(known, item("view", 9), t.events.where("event_type = 'purchase' and user_id % 2 = 0").select("user_id"), ["user_id"])


@query("e10_checkpoints", "SELECT user_id, event_type, max(ts)::VARCHAR IS NOT NULL AS has_at, arg_max(event_id, (ts, event_id)) AS next_page FROM events GROUP BY 1, 2")
def checkpoints(t):
    out = E.last_write(t.events.withColumn("next_page", F.col("event_id")), ["user_id", "event_type"], ["next_page"], ["ts"])
    return out.select("user_id", "event_type", F.col("ts").isNotNull().alias("has_at"), "next_page")


@query("e11_prune", f"SELECT event_id FROM events WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 10 DAY")
def prune(t):
    return E.prune(t.events, "ts", AS_OF, 10)[0].select("event_id")


@query("e11_pruned_rows", f"SELECT count(*) AS deleted FROM events WHERE ts < TIMESTAMP '{AS_OF}' - INTERVAL 10 DAY")
def pruned_rows(t):
    return E.prune(t.events, "ts", AS_OF, 10)[1]


@query("e12_backfill", "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN -1 ELSE CAST(props ->> '$.k' AS INTEGER) END AS k, CAST(NULL AS VARCHAR) AS other FROM events")
def backfill(t):
    rows = t.events.select("event_id", "props", F.when(F.col("event_id") % 2 == 0, -1).alias("k"), F.lit(None).cast("string").alias("other"))
    return E.backfill(rows, "props", {"k": ("$.k", "int"), "other": ("$.x.y", "string")}).select("event_id", "k", "other")


REPAIR_SQL = """ow AS (SELECT CAST(o_orderkey AS VARCHAR) AS parent_id, CASE WHEN o_orderkey % 2 = 0 THEN c_mktsegment ELSE n_name END AS customer_name, c_mktsegment AS organizer_name FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey),
og AS (SELECT CAST(c_custkey AS VARCHAR) AS child_id, c_mktsegment AS name FROM customer), k AS (SELECT * FROM v_edge JOIN og USING (child_id) JOIN ow USING (parent_id) WHERE relation_type = 'customer')"""


def repair(t):
    owners = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"))
    owners = owners.select(F.col("o_orderkey").cast("string").alias("parent_id"), F.when(F.col("o_orderkey") % 2 == 0, F.col("c_mktsegment")).otherwise(F.col("n_name")).alias("customer_name"), F.col("c_mktsegment").alias("organizer_name"))
    organizations = t.customer.select(F.col("c_custkey").cast("string").alias("child_id"), F.col("c_mktsegment").alias("name"))
    return E.relabel_relations(t.edges(), owners, organizations)


@query("e14_relabelled_edges", f"{REPAIR_SQL} SELECT DISTINCT 'organizer' AS relation_type, parent_id, child_id FROM k WHERE name = organizer_name AND (parent_id, child_id) NOT IN (SELECT (parent_id, child_id) FROM v_edge WHERE relation_type = 'organizer')", views=True)
def relabelled_edges(t):
    return repair(t)[0]


@query("e15_edges_without_wrong", f"{REPAIR_SQL} SELECT relation_type, parent_id, child_id FROM v_edge e WHERE NOT (relation_type = 'customer' AND EXISTS (SELECT 1 FROM k WHERE k.parent_id = e.parent_id AND k.child_id = e.child_id AND name IS DISTINCT FROM customer_name))", views=True)
def edges_without_wrong(t):
    return E.delete_edges(t.edges(), repair(t)[1], ["relation_type", "parent_id", "child_id"])


@query("e16_delete_by_parent", "SELECT relation_type, parent_id, child_id FROM v_edge WHERE NOT (relation_type = 'customer' AND child_id IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal < 0))", views=True)
def delete_by_parent(t):
    doomed = t.customer.where("c_acctbal < 0").select(F.lit("customer").alias("relation_type"), F.col("c_custkey").cast("string").alias("child_id"))
    return E.delete_edges(t.edges(), doomed, ["relation_type", "child_id"])


@query("e17_evolve", "SELECT CAST(c_custkey AS BIGINT) AS key, c_name AS name, CAST(CAST(c_acctbal AS DECIMAL(24,6)) AS VARCHAR) AS balance FROM customer UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier")
def evolve(t):
    out = E.evolve(t.customer.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")), {"balance": "decimal(24,6)"}, t.supplier.select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")))
    return out.withColumn("balance", F.col("balance").cast("string"))


OUTCOMES_SQL = "oc AS (SELECT event_id AS key, CAST(user_id % 6 AS INTEGER) AS attempt, CASE WHEN event_type = 'error' THEN 'retry' WHEN event_type = 'view' THEN 'failed' ELSE 'success' END AS outcome, repeat(props, 3) AS error FROM events)"


def outcomes(t):
    kind = F.when(F.col("event_type") == "error", "retry").when(F.col("event_type") == "view", "failed").otherwise("success")
    return t.events.select(F.col("event_id").alias("key"), (F.col("user_id") % 6).cast("int").alias("attempt"), kind.alias("outcome"), F.col("ts").alias("retry_at"), F.repeat("props", F.lit(3)).alias("error"), F.col("ts").alias("at"))


@query(
    "e18_worklist_after_outcomes",
    f"""WITH {LIST_SQL}, {OUTCOMES_SQL}, m AS (SELECT oc.* FROM oc JOIN wl USING (key, attempt)) SELECT key, priority, CASE WHEN outcome = 'retry' THEN wl.attempt + 1 ELSE wl.attempt END AS attempt,
    CASE WHEN outcome = 'retry' THEN left(error, 20) ELSE last_error END AS last_error FROM wl LEFT JOIN (SELECT key, outcome, error FROM m) USING (key) WHERE outcome IS NULL OR outcome = 'retry'""",
)
def worklist_after_outcomes(t):
    return E.apply_outcomes(worklist(t), outcomes(t), ["key"], 20)[0].select("key", "priority", "attempt", "last_error")


@query("e18_history_after_outcomes", f"WITH {LIST_SQL}, {OUTCOMES_SQL} SELECT key, attempt, outcome, left(error, 20) AS error FROM oc JOIN wl USING (key, attempt) WHERE outcome <> 'retry'")
def history_after_outcomes(t):
    return E.apply_outcomes(worklist(t), outcomes(t), ["key"], 20)[1].select("key", "attempt", "outcome", "error")


@query("e19_lane_states", "SELECT user_id, arg_max(event_type, (ts, event_type)) AS state FROM events GROUP BY 1")
def lane_states(t):
    return E.last_write(t.events.withColumnRenamed("event_type", "state"), ["user_id"], ["state"], ["ts"]).select("user_id", "state")
