"""Operational aggregates, work-list selection, data quality and forecasts on the driver's tables, with their SQL."""

from pyspark.sql import functions as F

from tenderlake.functions import scalars as S
from tenderlake.operators import forecast as J
from tenderlake.operators import quality as I
from tenderlake.operators import stats as G
from tenderlake.operators import worklist as H
from tenderlake.plans.tables import AS_OF, Tables, source_of, with_views

QUERIES, SQL = {}, {}


def query(name: str, sql: str, views: bool = False):
    def add(f):
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        SQL[name] = with_views(sql) if views else sql
        return f

    return add


def as_of():
    return F.lit(AS_OF).cast("timestamp_ntz")


#: A work list made of orders: available at the order date, leased for a day where the key ends in 7.
LIST_SQL = f"""wl AS (SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'portal_a' ELSE 'portal_b' END AS source, o_orderstatus AS entity_type, o_orderkey AS key, CAST(3 - CAST(left(o_orderpriority, 1) AS INTEGER) AS INTEGER) AS priority,
  o_orderdate + (TIMESTAMP '{AS_OF}' - TIMESTAMP '1998-01-01') AS available_at, CASE WHEN o_orderkey % 10 = 7 THEN TIMESTAMP '{AS_OF}' + INTERVAL 1 HOUR * CAST(o_custkey % 9 - 4 AS INTEGER) END AS leased_until,
  CASE WHEN o_orderkey % 10 = 7 THEN 'w' || o_custkey % 3 END AS lease_owner, CAST(o_custkey % 6 AS INTEGER) AS attempt, CASE WHEN o_custkey % 6 > 3 THEN 'boom' END AS last_error FROM orders)"""
NOW = f"TIMESTAMP '{AS_OF}'"


def worklist(t):
    leased = F.col("o_orderkey") % 10 == 7
    shift = F.make_dt_interval(days=F.datediff(F.lit(AS_OF).cast("timestamp_ntz"), F.lit("1998-01-01").cast("timestamp_ntz")))
    return t.orders.select(
        source_of("o_orderkey").alias("source"),
        F.col("o_orderstatus").alias("entity_type"),
        F.col("o_orderkey").alias("key"),
        (3 - F.left("o_orderpriority", F.lit(1)).cast("int")).alias("priority"),
        (F.col("o_orderdate") + shift).alias("available_at"),
        F.when(leased, as_of() + F.make_dt_interval(hours=(F.col("o_custkey") % 9 - 4).cast("int"))).alias("leased_until"),
        F.when(leased, F.concat(F.lit("w"), F.col("o_custkey") % 3)).alias("lease_owner"),
        (F.col("o_custkey") % 6).cast("int").alias("attempt"),
        F.when(F.col("o_custkey") % 6 > 3, "boom").alias("last_error"),
    )


@query("g1_queue_depth", f"WITH {LIST_SQL} SELECT source, count(*) AS depth FROM wl GROUP BY 1")
def queue_depth(t):
    return G.queue_depth(worklist(t), ["source"])


@query(
    "g2_activity",
    f"""WITH {LIST_SQL} SELECT source, count(*) FILTER (WHERE available_at <= {NOW} AND (leased_until IS NULL OR leased_until < {NOW})) AS ready, count(*) FILTER (WHERE available_at > {NOW}) AS delayed,
    count(*) FILTER (WHERE leased_until >= {NOW}) AS leased, count(*) FILTER (WHERE leased_until < {NOW} AND lease_owner IS NOT NULL) AS stale_leases FROM wl GROUP BY 1""",
)
def activity(t):
    return G.activity(worklist(t), as_of(), ["source"])


@query(
    "g3_queue_by_type",
    f"""WITH {LIST_SQL} SELECT source, entity_type, count(*) AS depth, count(*) FILTER (WHERE attempt > 0) AS attempted, count(*) FILTER (WHERE available_at > {NOW}) AS delayed, count(last_error) AS with_error,
    coalesce(max(attempt), 0) AS max_attempt FROM wl GROUP BY 1, 2""",
)
def queue_by_type(t):
    return G.queue_by_type(worklist(t), as_of(), ["source", "entity_type"])


EVENT_SOURCE = "CASE WHEN event_id % 2 = 0 THEN 'portal_a' ELSE 'portal_b' END AS source"


def log(t):
    return t.events.withColumn("source", source_of("event_id"))


@query("g4_task_history", f"SELECT source, outcome, count(*) AS n FROM (SELECT {EVENT_SOURCE}, event_type AS outcome FROM events) GROUP BY 1, 2")
def task_history(t):
    return G.outcome_counts(log(t).withColumnRenamed("event_type", "outcome"), ["source", "outcome"])


@query(
    "g5_failure_events",
    f"""SELECT coalesce(r.source, 'unknown') AS source, count(*) AS n, count(*) FILTER (WHERE e.ts >= {NOW} - INTERVAL 24 HOUR) AS last_24h, count(*) FILTER (WHERE e.props ILIKE '%"K": 7%') AS matching,
    count(CASE WHEN e.value < 50 THEN 1 END) AS http_events FROM events e LEFT JOIN (SELECT c_custkey AS user_id, c_mktsegment AS source FROM customer WHERE c_custkey % 2 = 0) r USING (user_id) WHERE e.event_type = 'error' GROUP BY 1""",
)
def failure_events(t):
    failures = t.events.where("event_type = 'error'").select("user_id", F.col("ts").alias("at"), F.col("props").alias("error"), F.when(F.col("value") < 50, 500).alias("http_status"))
    registry = t.customer.where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("source"))
    return G.failure_events(failures, registry, "user_id", as_of(), '%"K": 7%')


@query("g6_lane_states", "SELECT o_orderkey, state, CAST(o_orderstatus = state AS INTEGER) AS active FROM orders, (VALUES ('F'), ('O'), ('P')) s(state)")
def lane_states(t):
    return G.one_hot(t.orders.select("o_orderkey", F.col("o_orderstatus").alias("state")), "state", ["F", "O", "P"])


@query("g7_spend_since", f"SELECT user_id, CAST(sum(CAST(value AS DECIMAL(12,6))) AS DECIMAL(22,6)) AS cost FROM events WHERE event_type = 'purchase' AND ts >= {NOW} - INTERVAL 1 HOUR * 240 GROUP BY 1")
def spend_since(t):
    spends = t.events.select("user_id", F.col("ts").alias("at"), F.when(F.col("event_type") == "purchase", "success").alias("status"), F.col("value").cast("decimal(12,6)").alias("cost"))
    return G.spend_since(spends, as_of() - F.make_dt_interval(hours=F.lit(240)), ["user_id"])


@query("g8_last_success", "SELECT user_id, CAST(floor(epoch(max(ts))) AS BIGINT) AS succeeded_at FROM events WHERE event_type <> 'error' GROUP BY 1")
def last_success(t):
    return G.last_success(t.events.where("event_type <> 'error'"), ["user_id"], "ts")


@query("g9_failure_rates", "SELECT user_id, count(*) AS n, count(*) FILTER (WHERE event_type = 'error') AS failed, round(count(*) FILTER (WHERE event_type = 'error') / greatest(count(*), 1), 4) AS failure_rate, round(count(*) FILTER (WHERE event_type <> 'error') / greatest(count(*), 1), 4) AS success_rate FROM events GROUP BY 1")
def failure_rates(t):
    return G.rates(t.events, ["user_id"], F.col("event_type") == "error")


@query("g10_counters", f"SELECT source, event_type, user_id, count(*) AS n FROM (SELECT *, {EVENT_SOURCE} FROM events) GROUP BY ALL")
def counters(t):
    return G.outcome_counts(log(t), ["source", "event_type", "user_id"])


@query("g11_histogram", "SELECT event_type, count(*) FILTER (WHERE value <= 1) AS le_1, count(*) FILTER (WHERE value <= 5) AS le_5, count(*) FILTER (WHERE value <= 25) AS le_25, count(*) FILTER (WHERE value <= 100) AS le_100, count(value) AS n, CAST(sum(CAST(value AS DECIMAL(24,6))) AS DECIMAL(24,6)) AS total FROM events GROUP BY 1")
def histogram(t):
    return G.histogram(t.events, "value", [1, 5, 25, 100], ["event_type"])


@query("g12_stats_map", f"SELECT string_agg(concat(k, '=', n), ',' ORDER BY k) AS counts FROM (SELECT concat(source, ':', event_type) AS k, count(*) AS n FROM (SELECT *, {EVENT_SOURCE} FROM events) GROUP BY 1)")
def stats_map(t):
    m = G.as_map(G.outcome_counts(log(t), ["source", "event_type"]), ["source", "event_type"], "n")
    return m.select(F.array_join(F.transform(F.map_entries("counts"), lambda e: F.concat_ws("=", e["key"], e["value"])), ",").alias("counts"))


READY = f"available_at <= {NOW} AND (leased_until IS NULL OR leased_until < {NOW})"


@query("h1_claimable", f"WITH {LIST_SQL} SELECT source, key, priority FROM wl WHERE {READY} ORDER BY priority DESC, available_at, key LIMIT 200")
def claimable(t):
    return H.claimable(worklist(t), as_of(), 200).select("source", "key", "priority")


@query("h1_claimable_per_source", f"WITH {LIST_SQL} SELECT source, key, priority FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY priority DESC, available_at, key) AS rn FROM wl WHERE {READY} AND priority <= 0) WHERE rn <= 100")
def claimable_per_source(t):
    return H.claimable(worklist(t), as_of(), 100, per=["source"], low_priority_only=True).select("source", "key", "priority")


@query(
    "h2_with_backfill",
    f"""WITH {LIST_SQL}, r AS (SELECT *, priority <= 0 AS low, row_number() OVER (PARTITION BY priority <= 0 ORDER BY priority DESC, available_at, key) AS rn FROM wl WHERE {READY})
    SELECT source, key, priority FROM r ORDER BY CASE WHEN low THEN rn > 60 ELSE rn > 140 END, priority DESC, available_at, key LIMIT 200""",
)
def with_backfill(t):
    return H.with_backfill(worklist(t), as_of(), 200, 30).select("source", "key", "priority")


def refresh(t, policy: str):
    registry = t.orders.select(F.col("o_orderkey").alias("key"), F.col("o_orderdate").alias("last_success_at"))
    lots = t.lineitem.groupBy(F.col("l_orderkey").alias("key")).agg(F.max(F.when(F.col("l_returnflag") == "R", F.lit("Закрыта"))).alias("status"))
    notices = t.orders.select(F.col("o_orderkey").alias("key"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"))
    out = H.refresh_candidates(registry, [lots, notices], policy, "1998-08-02 00:00:00", 86400 * 30, 86400 * 900, 500, "key")
    return out.select("key", "status", F.date_format("last_success_at", "yyyy-MM-dd").alias("day"))


def refresh_sql(where: str) -> str:
    return f"""SELECT key, status, strftime(seen, '%Y-%m-%d') AS day FROM (SELECT o_orderkey AS key, o_orderdate AS seen, coalesce(l.status, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END, '') AS status FROM orders
    LEFT JOIN (SELECT l_orderkey, max(CASE WHEN l_returnflag = 'R' THEN 'Закрыта' END) AS status FROM lineitem GROUP BY 1) l ON l_orderkey = o_orderkey) WHERE {where} ORDER BY seen, key LIMIT 500"""


OLD, RECENT = "seen < TIMESTAMP '1998-08-02' - INTERVAL 30 DAY", "seen >= TIMESTAMP '1998-08-02' - INTERVAL 900 DAY"
for _policy, _where in {"active": f"status <> 'Закрыта' AND {OLD}", "recently_closed": f"status = 'Закрыта' AND {OLD} AND {RECENT}", "old": OLD, "all": "true"}.items():
    query(f"h3_refresh_{_policy}", refresh_sql(_where))(lambda t, policy=_policy: refresh(t, policy))


@query(
    "h4_route_outcomes",
    """SELECT event_id, outcome, CASE outcome WHEN 'blocked_retry' THEN 600 WHEN 'retry' THEN CAST(least(300, 5 * power(2, greatest(0, attempt - 1))) AS BIGINT) END AS retry_delay FROM (
    SELECT event_id, event_id % 7 AS attempt, CASE WHEN event_type NOT IN ('error', 'view') THEN 'success' WHEN event_type = 'view' AND user_id % 3 = 0 THEN 'blocked_retry' WHEN user_id % 5 = 0 THEN 'lease_lost'
    WHEN event_id % 11 = 0 OR event_id % 7 >= 5 THEN 'failed' ELSE 'retry' END AS outcome FROM events)""",
)
def route_outcomes(t):
    kind = F.col("event_type")
    tasks = t.events.select(
        "event_id",
        (~kind.isin("error", "view")).alias("succeeded"),
        ((kind == "view") & (F.col("user_id") % 3 == 0)).alias("blocked"),
        (F.col("user_id") % 5 == 0).alias("lease_lost"),
        F.when(F.col("event_id") % 11 == 0, 404).alias("http_status"),
        F.lit(None).cast("int").alias("retry_after"),
        (F.col("event_id") % 7).alias("attempt"),
    )
    return H.route_outcomes(tasks).select("event_id", "outcome", "retry_delay")


@query("h5_release_expired", f"WITH {LIST_SQL} SELECT key, CASE WHEN leased_until < {NOW} THEN NULL ELSE lease_owner END AS lease_owner, strftime(CASE WHEN leased_until < {NOW} THEN NULL ELSE leased_until END, '%Y-%m-%d %H:%M:%S') AS leased_until FROM wl")
def release_expired(t):
    return H.release_expired(worklist(t), as_of())[0].select("key", "lease_owner", F.date_format("leased_until", "yyyy-MM-dd HH:mm:ss").alias("leased_until"))


@query(
    "i1_contract_violations",
    """SELECT l_orderkey AS task, count(*) FILTER (WHERE l_linenumber = 1) AS primaries, count(*) AS n, count(DISTINCT l_linenumber) AS keys,
    CASE WHEN count(*) FILTER (WHERE l_linenumber = 1) <> 1 THEN 'primary' WHEN count(DISTINCT l_linenumber) < count(*) THEN 'duplicate' WHEN count(DISTINCT l_returnflag) > 1 THEN 'source'
    WHEN bool_or(l_linenumber = 1 AND l_suppkey % 4 = 0) THEN 'payload' END AS reason FROM lineitem GROUP BY 1""",
)
def contract_violations(t):
    items = t.lineitem.select(
        F.col("l_orderkey").alias("task"),
        F.col("l_linenumber").alias("key"),
        F.when(F.col("l_linenumber") == 1, "primary").otherwise("other").alias("role"),
        F.col("l_returnflag").alias("source"),
        F.when(F.col("l_suppkey") % 4 != 0, "x").alias("payload"),
    )
    return I.contract_violations(items, ["task"])


@query("i3_duplicate_rows", "SELECT count(*) AS rows, count(*) - count(DISTINCT concat(l_orderkey, '-', l_linenumber)) AS duplicate_identity_rows, 0 AS empty_identity_rows FROM lineitem")
def duplicate_rows(t):
    return I.duplicate_rows(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("i2_identity_report", "SELECT count(*) AS rows, coalesce(sum(CASE WHEN lang <> '' THEN n - 1 END), 0) AS duplicate_identity_rows, coalesce(sum(CASE WHEN lang = '' THEN n END), 0) AS empty_identity_rows FROM (SELECT source, CASE WHEN lang = 'fr' THEN '' ELSE lang END AS lang, count(*) AS n FROM documents GROUP BY 1, 2)".replace("count(*) AS rows, coalesce", "sum(n) AS rows, coalesce", 1))
def identity_report(t):
    return I.duplicate_rows(t.documents.select("source", F.when(F.col("lang") == "fr", "  ").otherwise(F.col("lang")).alias("lang")), ["source", "lang"])


@query("i4_split_mismatches", "SELECT 'orders' AS dataset, count(*) AS combined, count(*) FILTER (WHERE o_orderstatus <> 'P') AS split FROM orders HAVING count(*) <> count(*) FILTER (WHERE o_orderstatus <> 'P')")
def split_mismatches(t):
    both = [(t.orders, "orders"), (t.part, "part")]
    counts = None
    for rows, name in both:
        column = "o_orderstatus" if name == "orders" else "p_brand"
        split = rows.where(F.col(column) != "P").groupBy(F.col(column).alias("part")).agg(F.count("*").alias("rows")).select(F.lit(name).alias("dataset"), "part", "rows")
        whole = rows.agg(F.count("*").alias("rows")).select(F.lit(name).alias("dataset"), F.lit("combined").alias("part"), "rows")
        counts = split.union(whole) if counts is None else counts.union(split).union(whole)
    return I.split_mismatches(counts)


@query(
    "i6_acceptance",
    """SELECT *, false AS accepted FROM (SELECT count(*) - count(DISTINCT o_orderkey) AS duplicates FROM orders), (SELECT count(*) AS orphans FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)),
    (SELECT count(*) FILTER (WHERE o_orderstatus = 'P') AS missing_payload FROM orders), (SELECT round(count(*) FILTER (WHERE event_type = 'error') / greatest(count(*), 1), 4) AS failure_rate FROM events)""",
)
def acceptance(t):
    entities = t.orders.withColumn("payload", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")))
    return I.acceptance(entities, ["o_orderkey"], t.lineitem, "l_orderkey", "o_orderkey", t.events, F.col("event_type") == "error", "payload")


@query(
    "i7_length_limits",
    """SELECT 'lang' AS "column", 1 AS allowed, count(*) FILTER (WHERE length(lang) > 1) AS over, CAST(max(length(lang)) AS INTEGER) AS longest FROM documents UNION ALL SELECT 'text', 5000, count(*) FILTER (WHERE length(text) > 5000), CAST(max(length(text)) AS INTEGER) FROM documents""",
)
def length_limits(t):
    return I.length_violations(t.documents, {"lang": 1, "text": 5000})


PAGES_SQL = "p AS (SELECT user_id, event_id // 50 AS window_id, event_id AS page, CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'empty' ELSE 'items' END AS status, event_id % 10 AS n_items FROM events)"


@query(
    "j1_classify_windows",
    f"""WITH {PAGES_SQL}, s AS (SELECT *, min(CASE WHEN status <> 'items' THEN page END) OVER (PARTITION BY user_id, window_id) AS stop FROM p),
    a AS (SELECT user_id, window_id, min(stop) AS stop, max(CASE WHEN page = stop THEN status END) AS how, max(page) AS last_page, count(*) AS requested, count(*) FILTER (WHERE stop IS NULL OR page < stop) AS useful,
      coalesce(sum(n_items) FILTER (WHERE stop IS NULL OR page < stop), 0) AS items, count(*) FILTER (WHERE page > stop AND status = 'empty') AS se, count(*) FILTER (WHERE page > stop AND status = 'failed') AS ig FROM s GROUP BY 1, 2),
    b AS (SELECT *, coalesce(how = 'failed', false) AS rejected, coalesce(how = 'empty', false) AS completed FROM a)
    SELECT user_id, window_id, rejected, completed, CASE WHEN completed THEN stop END AS terminal_page, CASE WHEN NOT rejected THEN coalesce(stop, last_page + 1) END AS next_page, CAST(CASE WHEN rejected THEN 0 ELSE items END AS BIGINT) AS items,
    CASE WHEN NOT rejected THEN useful + CAST(completed AS INTEGER) END AS meaningful, CASE WHEN NOT rejected THEN requested - useful - CAST(completed AS INTEGER) END AS speculative,
    CASE WHEN completed THEN se ELSE 0 END AS speculative_empty, CASE WHEN completed THEN ig ELSE 0 END AS ignored_failures FROM b""",
)
def classify_windows(t):
    status = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "signup", "empty").otherwise("items")
    pages = t.events.select("user_id", F.expr("event_id div 50").alias("window_id"), F.col("event_id").alias("page"), status.alias("status"), (F.col("event_id") % 10).alias("n_items"))
    return J.classify_windows(pages, ["user_id", "window_id"])


@query(
    "j2_probe_totals",
    """SELECT event_type, requests, returned, total, round(wall, 4) AS wall_seconds, round(returned / nullif(wall, 0), 4) AS rate, round(total / nullif(returned / nullif(wall, 0), 0), 4) AS estimated_seconds FROM (
    SELECT event_type, count(*) AS requests, CAST(sum(event_id % 50) AS BIGINT) AS returned, max(event_id) AS total, CAST(sum(CAST(value AS DECIMAL(18,6))) AS DOUBLE) / 4 AS wall FROM events GROUP BY 1)""",
)
def probe_totals(t):
    samples = t.events.select("event_type", (F.col("event_id") % 50).alias("returned"), F.col("value").cast("decimal(18,6)").alias("elapsed"), F.col("event_id").alias("total"))
    return J.probe_totals(samples, ["event_type"], 4)


@query("j3_detail_probe", "SELECT user_id, count(*) AS requested, count(*) FILTER (WHERE event_type <> 'error') AS succeeded, count(*) FILTER (WHERE event_type = 'error') AS failed, round(count(*) FILTER (WHERE event_type <> 'error') / greatest(count(*), 1), 4) AS rate FROM events GROUP BY 1")
def detail_probe(t):
    return J.detail_probe(t.events, ["user_id"], F.col("event_type") == "error")


RESULTS_SQL = """res AS (SELECT CASE WHEN l_suppkey % 3 = 0 THEN 'portal_a' ELSE 'portal_b' END AS source, l_returnflag AS runtime, 'net' || l_suppkey % 40 AS network, CAST(l_linenumber AS VARCHAR) AS entity_type,
  CASE WHEN l_partkey % 97 <> 0 THEN CAST(l_quantity AS DECIMAL(18,2)) END AS discovery_seconds, CASE WHEN l_partkey % 89 <> 0 THEN CAST(l_extendedprice AS DECIMAL(18,2)) END AS detail_seconds, l_partkey AS total FROM lineitem),
fr AS (SELECT source, runtime, network, count(*) AS expected, count(*) FILTER (WHERE discovery_seconds IS NOT NULL AND detail_seconds IS NOT NULL) AS measured,
  sum(discovery_seconds) FILTER (WHERE discovery_seconds IS NOT NULL AND detail_seconds IS NOT NULL) AS discovery, sum(detail_seconds) FILTER (WHERE discovery_seconds IS NOT NULL AND detail_seconds IS NOT NULL) AS detail FROM res GROUP BY 1, 2, 3),
ff AS (SELECT source, runtime, network, expected, measured, CAST(discovery AS VARCHAR) AS discovery, CAST(detail AS VARCHAR) AS detail, discovery + detail AS full_cycle, expected = measured AS complete FROM fr)"""


def results(t):
    return t.lineitem.select(
        F.when(F.col("l_suppkey") % 3 == 0, "portal_a").otherwise("portal_b").alias("source"),
        F.col("l_returnflag").alias("runtime"),
        F.concat(F.lit("net"), F.col("l_suppkey") % 40).alias("network"),
        F.col("l_linenumber").cast("string").alias("entity_type"),
        F.when(F.col("l_partkey") % 97 != 0, F.col("l_quantity").cast("decimal(18,2)")).alias("discovery_seconds"),
        F.when(F.col("l_partkey") % 89 != 0, F.col("l_extendedprice").cast("decimal(18,2)")).alias("detail_seconds"),
        F.col("l_partkey").alias("total"),
    )


PROFILE = ["source", "runtime", "network"]


def text(df, *cols):
    return df.withColumns({c: F.col(c).cast("string") for c in cols})


@query("j4_full_run", f"WITH {RESULTS_SQL} SELECT source, runtime, network, expected, measured, discovery, detail, CAST(full_cycle AS VARCHAR) AS full_cycle, complete FROM ff")
def full_run(t):
    return text(J.full_run(results(t), PROFILE), "discovery", "detail", "full_cycle")


@query(
    "j5_combined",
    f"""WITH {RESULTS_SQL} SELECT runtime, network, count(*) AS sources_expected, count(*) FILTER (WHERE complete) AS sources_measured, CAST(max(full_cycle) FILTER (WHERE complete) AS VARCHAR) AS parallel,
    CAST(sum(full_cycle) FILTER (WHERE complete) AS VARCHAR) AS sequential, count(*) = count(*) FILTER (WHERE complete) AS complete FROM ff GROUP BY 1, 2""",
)
def combined(t):
    return text(J.combined(J.full_run(results(t), PROFILE), ["runtime", "network"]), "parallel", "sequential")


@query(
    "j6_summary",
    f"""WITH {RESULTS_SQL}, c AS (SELECT source, concat(runtime, '/', network) AS profile, full_cycle FROM ff WHERE complete),
    d AS (SELECT source, arg_min(profile, (full_cycle, profile)) AS fastest, min(full_cycle) AS fs, arg_max(profile, (full_cycle, profile)) AS slowest, max(full_cycle) AS ss FROM c GROUP BY 1),
    m AS (SELECT source, CAST(sum(total) AS BIGINT) AS total FROM (SELECT source, entity_type, max(total) AS total FROM res GROUP BY 1, 2) GROUP BY 1)
    SELECT source, fastest, CAST(fs AS VARCHAR) AS fastest_seconds, slowest, CAST(ss AS VARCHAR) AS slowest_seconds, total FROM m LEFT JOIN d USING (source)""",
)
def summary(t):
    return text(J.summary(J.full_run(results(t), PROFILE), results(t), ["runtime", "network"]), "fastest_seconds", "slowest_seconds")
