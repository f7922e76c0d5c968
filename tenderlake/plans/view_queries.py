"""Export views and analytic queries on the driver's tables, with their SQL."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlake.operators import views as V
from tenderlake.plans.tables import Tables, source_of, with_views

QUERIES, SQL = {}, {}


def query(name: str, sql: str, views: bool = True):
    def add(f):
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        SQL[name] = with_views(sql) if views else sql
        return f

    return add


def stamp(c: str):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def day(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


LOCAL = "AT TIME ZONE 'UTC' AT TIME ZONE 'Asia/Almaty'"


@query(
    "f1_export_lots",
    f"""SELECT l.source, l.source_entity_id, l.status, n.priority, CAST(l.quantity AS VARCHAR) AS quantity, CAST(l.total_amount AS VARCHAR) AS total_amount, {day('n.published_at')} AS published_at,
    {day(f'n.published_at {LOCAL}')} AS published_at_local, {day(f'l.closes_at {LOCAL}')} AS closes_at_local, 'Asia/Almaty' AS source_timezone FROM v_lot l JOIN v_notice n ON n.o_orderkey = l.l_orderkey""",
)
def export_lots(t):
    registry = t.notice().select(F.col("o_orderkey").alias("l_orderkey"), "priority", "published_at")
    lots = t.lot().join(registry, "l_orderkey")
    view = V.procurement_view(lots, t.lot_keys().select(*V.KEY), ("published_at", "closes_at"))
    return view.select("source", "source_entity_id", "status", "priority", F.col("quantity").cast("string").alias("quantity"), F.col("total_amount").cast("string").alias("total_amount"), stamp("published_at").alias("published_at"), stamp("published_at_local").alias("published_at_local"), stamp("closes_at_local").alias("closes_at_local"), "source_timezone")


@query(
    "f2_export_procurement_notices",
    f"SELECT n.source, n.source_entity_id, n.status, n.priority, CAST(n.total_amount AS VARCHAR) AS total_amount, c.c_name AS customer, {day(f'n.published_at {LOCAL}')} AS published_at_local FROM v_notice n JOIN customer c ON c.c_custkey = n.o_custkey",
)
def export_notices(t):
    registry = t.notice().join(t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("customer")), "o_custkey").select(*V.KEY, "customer")
    view = V.procurement_view(t.notice(), registry, ("published_at",))
    return view.select("source", "source_entity_id", "status", "priority", F.col("total_amount").cast("string").alias("total_amount"), "customer", stamp("published_at_local").alias("published_at_local"))


@query("f3_export_plan_items", "SELECT p.source, p.source_entity_id, p.title, p.status, d.p_brand AS business_number, CAST(CAST(d.p_retailprice AS DECIMAL(24,6)) AS VARCHAR) AS unit_price FROM v_plan p JOIN part d USING (p_partkey)")
def export_plan_items(t):
    registry = t.part.select(source_of("p_partkey").alias("source"), F.lit("plan_item").alias("entity_type"), F.col("p_partkey").cast("string").alias("source_entity_id"), F.col("p_brand").alias("business_number"), F.col("p_retailprice").cast("decimal(24,6)").cast("string").alias("unit_price"))
    return V.procurement_view(t.plan_item(), registry, ()).select("source", "source_entity_id", "title", "status", "business_number", "unit_price")


def _organizations(t):
    return t.customer.select(source_of("c_custkey").alias("source"), F.lit("organization").alias("entity_type"), F.col("c_custkey").cast("string").alias("source_entity_id"), F.col("c_name").alias("name"), "c_nationkey")


@query("f4_export_organizations", "SELECT CASE WHEN c_custkey % 2 = 0 THEN 'portal_a' ELSE 'portal_b' END AS source, CAST(c_custkey AS VARCHAR) AS source_entity_id, c_name AS name, n_name AS address FROM customer JOIN nation ON n_nationkey = c_nationkey", views=False)
def export_organizations(t):
    registry = _organizations(t).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(*V.KEY, F.col("n_name").alias("address"))
    return V.owned_view(_organizations(t).drop("c_nationkey"), registry).select("source", "source_entity_id", "name", "address")


#: entity types of the parent and the child by relation
ENDS = {"notice_to_lot": ("notice", "lot"), "plan_to_lot": ("plan_item", "lot"), "plan_to_notice": ("plan_item", "notice"), "organizer": ("lot", "organization"), "customer": ("notice", "organization")}


@query(
    "f5_export_entity_relations",
    """r AS (SELECT source, entity_type, source_entity_id FROM v_notice UNION ALL SELECT source, entity_type, source_entity_id FROM v_lot UNION ALL SELECT source, entity_type, source_entity_id FROM v_plan
      UNION (SELECT CASE WHEN c_custkey % 2 = 0 THEN 'portal_a' ELSE 'portal_b' END, 'organization', CAST(c_custkey AS VARCHAR) FROM customer UNION SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'portal_a' ELSE 'portal_b' END, 'organization', CAST(s_suppkey AS VARCHAR) FROM supplier)),
    ends AS (SELECT * FROM (VALUES ('notice_to_lot', 'notice', 'lot'), ('plan_to_lot', 'plan_item', 'lot'), ('plan_to_notice', 'plan_item', 'notice'), ('organizer', 'lot', 'organization'), ('customer', 'notice', 'organization')) AS x(relation_type, parent_type, child_type))
    SELECT e.relation_type, p.source AS parent_source, parent_type, e.parent_id, c.source AS child_source, child_type, e.child_id
    FROM v_edge e JOIN ends USING (relation_type) JOIN r p ON p.entity_type = parent_type AND p.source_entity_id = e.parent_id JOIN r c ON c.entity_type = child_type AND c.source_entity_id = e.child_id""",
)
def export_relations(t):
    organization = lambda key: (F.col(key).alias("organization"), source_of(key).alias("source"), F.lit("organization").alias("entity_type"), F.col(key).cast("string").alias("source_entity_id"))
    lot, lot_key = t.lot(), ["l_orderkey", "l_linenumber"]
    customers = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("organization")).distinct()
    registry = {
        "notice": (t.notice().withColumnRenamed("o_orderkey", "l_orderkey"), ["l_orderkey"]),
        "lot": (t.lot_keys(), lot_key),
        "plan_item": (t.plan_item().withColumnRenamed("p_partkey", "l_partkey"), ["l_partkey"]),
        "organization": (t.customer.select(*organization("c_custkey")).union(t.supplier.select(*organization("s_suppkey"))).distinct(), ["organization"]),
    }
    edges = {  # each pair once, as in Tables.edges
        "notice_to_lot": t.lot_keys(),
        "plan_to_lot": lot,
        "plan_to_notice": lot.select("l_partkey", "l_orderkey").distinct(),
        "organizer": lot.withColumnRenamed("l_suppkey", "organization"),
        "customer": customers,
    }
    views = []
    for kind, (parent, child) in ENDS.items():
        (parents, parent_key), (children, child_key) = registry[parent], registry[child]
        views.append(V.keyed_relation_view(edges[kind], kind, parents, children, parent_key, child_key))
    return reduce(DataFrame.union, views)


@query("f6_export_delivery_places", "SELECT 'lot' AS entity_type, l.source, l.source_entity_id, CAST(s.s_suppkey AS VARCHAR) AS source_row_id, n.n_name AS country, s.s_name AS address, CAST(l.quantity AS VARCHAR) AS quantity FROM v_lot l JOIN supplier s ON s.s_suppkey = l.l_suppkey JOIN nation n ON n.n_nationkey = s.s_nationkey")
def export_delivery_places(t):
    places = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_suppkey").cast("string").alias("source_row_id"), F.col("n_name").alias("country"), F.col("s_name").alias("address"))
    children = t.lot().join(places, "l_suppkey").select(*V.KEY, "source_row_id", "country", "address", F.col("quantity").cast("string").alias("quantity"))
    return V.owned_view(children, t.lot_keys().select(*V.KEY))


@query("f7_export_payment_terms", "SELECT source, entity_type, source_entity_id, CAST(CAST(l_discount * 100 AS DECIMAL(8,3)) AS VARCHAR) AS prepayment_percent, CAST(CAST(l_tax * 100 AS DECIMAL(8,3)) AS VARCHAR) AS final_percent FROM v_lot JOIN (SELECT l_orderkey, l_linenumber, min(l_discount) AS l_discount, max(l_tax) AS l_tax FROM lineitem GROUP BY ALL) USING (l_orderkey, l_linenumber)")
def export_payment_terms(t):
    percent = lambda c: (c * 100).cast("decimal(8,3)").cast("string")
    terms = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(percent(F.min("l_discount")).alias("prepayment_percent"), percent(F.max("l_tax")).alias("final_percent"))
    children = terms.select(source_of("l_orderkey").alias("source"), F.lit("lot").alias("entity_type"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("source_entity_id"), "prepayment_percent", "final_percent")
    return V.owned_view(children, t.lot_keys().select(*V.KEY))


@query("f8_export_documents", "SELECT d.source, 'document' AS entity_type, CAST(d.doc_id AS VARCHAR) AS source_entity_id, d.lang AS category, d.n_chars AS size_bytes, sha256(d.text) AS document_hash, l.quality FROM documents d JOIN labels l USING (doc_id)", views=False)
def export_documents(t):
    key = lambda r: r.withColumn("entity_type", F.lit("document")).withColumn("source_entity_id", F.col("doc_id").cast("string"))
    children = key(t.documents).select(*V.KEY, F.col("lang").alias("category"), F.col("n_chars").alias("size_bytes"), F.sha2("text", 256).alias("document_hash"))
    registry = key(t.labels.join(t.documents.select("doc_id", "source"), "doc_id")).select(*V.KEY, "quality")
    return V.owned_view(children, registry)


@query(
    "f9_persisted_counts",
    """SELECT source, entity_type, count(*) AS n FROM (SELECT source, entity_type, CASE WHEN status <> 'P' THEN 1 END AS ok FROM v_notice UNION ALL SELECT source, entity_type, 1 FROM v_plan UNION ALL
    SELECT CASE WHEN c_custkey % 2 = 0 THEN 'portal_a' ELSE 'portal_b' END, 'organization', 1 FROM customer) WHERE ok IS NOT NULL GROUP BY ALL""",
)
def persisted_counts(t):
    notices = t.notice().select("source", "entity_type", F.when(F.col("status") != "P", F.col("published_at").cast("string")).alias("last_success_at"))
    others = t.plan_item().select("source", "entity_type", "status").union(_organizations(t).select("source", "entity_type", "name"))
    return V.persisted_counts(notices.union(others))


@query(
    "f10_shortest_periods",
    f"""SELECT source, source_entity_id, {day('published_at')} AS start_at, {day('ends')} AS end_at, CAST(epoch(ends) - epoch(published_at) AS BIGINT) AS duration_seconds FROM v_notice
    JOIN (SELECT l_orderkey, max(closes_at) AS ends FROM v_lot GROUP BY 1) ON l_orderkey = o_orderkey WHERE ends > published_at ORDER BY duration_seconds, source_entity_id LIMIT 50""",
)
def shortest_periods(t):
    ends = t.lot().groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("closes_at").alias("ends"))
    out = V.shortest_periods(t.notice().join(ends, "o_orderkey"), "published_at", "ends", ["source_entity_id"])
    return out.select("source", "source_entity_id", stamp("published_at").alias("start_at"), stamp("ends").alias("end_at"), "duration_seconds")


@query("f11_lots_of_notices", "SELECT n.source, n.source_entity_id AS notice_id, n.status AS notice_status, l.source_entity_id AS lot_id, CAST(l.total_amount AS VARCHAR) AS total_amount FROM v_notice n JOIN v_edge e ON e.relation_type = 'notice_to_lot' AND e.parent_id = n.source_entity_id JOIN v_lot l ON l.source_entity_id = e.child_id WHERE n.priority = '1-URGENT'")
def lots_of_notices(t):
    notices = t.notice().where("priority = '1-URGENT'").select("source", F.col("source_entity_id").alias("notice_id"), F.col("status").alias("notice_status"))
    lots = t.lot().select(F.col("source_entity_id").alias("lot_id"), F.col("total_amount").cast("string").alias("total_amount"))
    return V.follow(notices, t.edges(), lots, "notice_to_lot", "notice_id", "lot_id")


def chains(t):
    """Complete plan -> notice -> lot chains."""
    lot = t.lot()
    plans = t.plan_item().select(F.col("p_partkey").alias("l_partkey"), F.col("source_entity_id").alias("plan_id"), F.col("title").alias("plan_title"))
    notices = t.notice().select(F.col("o_orderkey").alias("l_orderkey"), F.col("source_entity_id").alias("notice_id"), F.col("status").alias("notice_status"))
    lots = lot.select("l_orderkey", "l_linenumber", F.col("source_entity_id").alias("lot_id"), F.col("status").alias("lot_status"))
    planned = V.keyed_follow(plans, lot.select("l_partkey", "l_orderkey").distinct(), notices, ["l_partkey"], ["l_orderkey"])
    found = V.keyed_follow(planned, t.lot_keys(), lots, ["l_orderkey"], ["l_orderkey", "l_linenumber"], children_first=True)
    return found.select("lot_id", "notice_id", "plan_id", "plan_title", "notice_status", "lot_status")


CHAINS = """SELECT p.source_entity_id AS plan_id, p.title AS plan_title, n.source_entity_id AS notice_id, n.status AS notice_status, l.source_entity_id AS lot_id, l.status AS lot_status FROM v_plan p
    JOIN v_edge pn ON pn.relation_type = 'plan_to_notice' AND pn.parent_id = p.source_entity_id JOIN v_notice n ON n.source_entity_id = pn.child_id
    JOIN v_edge nl ON nl.relation_type = 'notice_to_lot' AND nl.parent_id = n.source_entity_id JOIN v_lot l ON l.source_entity_id = nl.child_id"""

query("f12_chains", CHAINS)(chains)


@query("f12_first_chains", CHAINS + " ORDER BY CAST(plan_id AS BIGINT), notice_id, lot_id LIMIT 100")
def first_chains(t):
    return chains(t).orderBy(F.col("plan_id").try_cast("bigint"), "notice_id", "lot_id").limit(100)


@query("f13_notice_without_lot", "SELECT source, source_entity_id AS notice_id, status FROM v_notice n WHERE NOT EXISTS (SELECT 1 FROM v_edge e WHERE e.relation_type = 'notice_to_lot' AND e.parent_id = n.source_entity_id)")
def notice_without_lot(t):
    return V.without_children(t.notice().select("source", F.col("source_entity_id").alias("notice_id"), "status"), t.edges(), "notice_to_lot", "notice_id")


@query("f14_documents_of_source", "SELECT doc_id, lang AS category, n_chars AS size_bytes FROM documents WHERE source = 'src3'", views=False)
def documents_of_source(t):
    return t.documents.where("source = 'src3'").select("doc_id", F.col("lang").alias("category"), F.col("n_chars").alias("size_bytes"))


@query("f15_payload_inspection", "SELECT event_id, props ->> '$.k' AS raw_k, concat('{\n  \"k\" : ', props ->> '$.k', '\n}') AS pretty FROM events WHERE event_type = 'error'", views=False)
def payload_inspection(t):
    parsed = F.from_json("props", "k long")
    return t.events.where("event_type = 'error'").select("event_id", F.get_json_object("props", "$.k").alias("raw_k"), F.to_json(parsed, {"pretty": "true"}).alias("pretty"))


@query("f16_discovered_not_persisted", "SELECT DISTINCT parent_id AS source_entity_id FROM v_edge WHERE relation_type = 'notice_to_lot' AND parent_id NOT IN (SELECT source_entity_id FROM v_notice WHERE status = 'F')")
def discovered_not_persisted(t):
    from tenderlake.operators.merge import split_persisted

    return split_persisted(t.edges().where("relation_type = 'notice_to_lot'"), t.notice().where("status = 'F'"), "parent_id")[1]


@query(
    "f17_entity_union",
    """SELECT 'notice' AS entity_type, CAST(o_orderkey AS VARCHAR) AS source_entity_id, concat('{"status":"', o_orderstatus, '"}') AS payload FROM orders UNION ALL
    SELECT 'plan_item', CAST(p_partkey AS VARCHAR), concat('{"name":"', p_name, '"}') FROM part UNION ALL SELECT 'organization', CAST(c_custkey AS VARCHAR), concat('{"name":"', c_name, '"}') FROM customer""",
    views=False,
)
def entity_union(t):
    name = lambda c, k: F.to_json(F.struct(F.col(c).alias(k)))
    return V.stack((t.orders, "notice", F.col("o_orderkey"), name("o_orderstatus", "status")), (t.part, "plan_item", F.col("p_partkey"), name("p_name", "name")), (t.customer, "organization", F.col("c_custkey"), name("c_name", "name")))
