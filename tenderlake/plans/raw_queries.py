"""Sources, page and JSON parsing, and batch twins of the streams on the driver's tables, with their SQL where it can follow."""

import html
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlake.functions import scalars as S
from tenderlake.operators import html_pages as B
from tenderlake.operators import json_docs as C
from tenderlake.operators import quality as Q
from tenderlake.plans.tables import Tables
from tenderlake.sources import landing
from tenderlake.streaming import ingest as K

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            SQL[name] = sql
        return f

    return add


@query("a2_json_objects", "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN concat('{\"data\":[', props, ']}') ELSE props END AS body FROM events")
def json_objects(t):
    rows = t.events.select("event_id", F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("["), "props", F.lit("]"))).otherwise(F.col("props")).alias("body"))
    return landing.json_objects(rows)


@query("a12_catalogue_filter", "SELECT o_orderkey, '{\"o_orderpriority\": [\"1-URGENT\"], \"o_orderstatus\": [\"F\", \"O\"]}' AS scope FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority = '1-URGENT'")
def catalogue_filter(t):
    rows, scope = landing.catalogue_filter(t.orders, {"o_orderstatus": ["F", "O"], "o_orderpriority": ["1-URGENT"]})
    return rows.select("o_orderkey", F.lit(scope).alias("scope"))


@query("a7_rows_per_source", "SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'portal_a' ELSE 'portal_b' END AS source, count(*) AS rows FROM orders GROUP BY 1")
def rows_per_source(t):
    from tenderlake.sources.csv_export import projected

    rows = t.notice().select("source", "source_entity_id", "status", "priority", "total_amount")
    return projected(rows, "notices").withColumnRenamed("﻿source", "source").groupBy("source").agg(F.count("*").alias("rows"))


@query(
    "a7_layouts",
    """WITH n AS (SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'portal_a' ELSE 'portal_b' END AS source, CAST(o_orderkey AS VARCHAR) AS id FROM orders),
    files AS (SELECT 'combined' AS part, 'notices' AS file, * FROM n UNION ALL SELECT source, 'notices_' || source, * FROM n)
    SELECT layout, part, file, source, id FROM files JOIN (VALUES ('combined'), ('split'), ('both')) AS l(layout) ON layout = 'both' OR (layout = 'combined') = (part = 'combined')""",
)
def layouts(t):
    """Every row of every file that the three layouts write."""
    from tenderlake.sources import csv_export as X

    rows = t.notice().select("source", "source_entity_id", "status", "priority", "total_amount")
    files = [(layout, *file) for layout in X.LAYOUTS for file in X.laid_out(rows, "notices", layout, ("portal_a", "portal_b"))]
    cells = [X.projected(own, "notices").select(F.lit(layout).alias("layout"), F.lit(part).alias("part"), F.lit(name).alias("file"), F.col("\ufeffsource").alias("source"), F.col("source_entity_id").alias("id")) for layout, part, name, own in files]
    return reduce(DataFrame.union, cells)


@query("a5_export_notices", "SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'portal_a' ELSE 'portal_b' END AS source, CAST(o_orderkey AS VARCHAR) AS source_entity_id, o_orderstatus AS status, CAST(CAST(o_totalprice AS DECIMAL(24,6)) AS VARCHAR) AS total_amount, CAST(NULL AS VARCHAR) AS title_ru FROM orders")
def export_notices(t):
    from tenderlake.sources.csv_export import projected

    out = projected(t.notice(), "notices").withColumnRenamed("﻿source", "source")
    return out.select("source", "source_entity_id", "status", "total_amount", "title_ru")


def _unescaped(rows: str) -> str:
    """SQL: key and text of ``rows`` (key, x) with all character references as HTML 5 reads them: numbers, names, and old names without their semicolon before any text."""
    from html import entities

    text = lambda x: "'" + x.replace("'", "''") + "'" if x.isprintable() else "concat(" + ", ".join(f"chr({ord(c)})" for c in x) + ")"
    names = ", ".join(f"({text(k)}, {text(v)})" for k, v in entities.html5.items())
    odd = " ".join(f"WHEN {k} THEN {text(v) if v else repr(v)}" for k, v in html._invalid_charrefs.items())
    gone = ", ".join(map(str, sorted(html._invalid_codepoints)))
    return f"""names AS (SELECT name, said FROM (VALUES {names}) AS v(name, said)), rows AS ({rows}),
    parts AS (SELECT key, unnest(string_split(x, '&')) AS p, generate_subscripts(string_split(x, '&'), 1) AS i FROM rows),
    cut AS (SELECT *, regexp_extract(p, '^(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\\t\\n\\f <&#;]{{1,32}};?)', 1) AS r FROM parts WHERE i > 1),
    named AS (SELECT key, i, max_by(said, len) AS said, max(len) AS len FROM (SELECT key, i, said, length(name) AS len FROM (SELECT key, i, r, unnest(generate_series(2, length(r))) AS n FROM cut WHERE r NOT LIKE '#%') JOIN names ON name = left(r, n)) GROUP BY key, i),
    digits AS (SELECT key, i, length(r) AS len, ltrim(regexp_replace(r, '[#xX;]', '', 'g'), '0') AS d, r[2] IN ('x', 'X') AS hex FROM cut WHERE r LIKE '#%'),
    coded AS (SELECT key, i, len, CASE WHEN length(d) > CASE WHEN hex THEN 6 ELSE 7 END THEN 1114112 WHEN d = '' THEN 0 WHEN hex THEN CAST('0x' || d AS INTEGER) ELSE CAST(d AS INTEGER) END AS code FROM digits),
    numbered AS (SELECT key, i, len, CASE code {odd} ELSE CASE WHEN code BETWEEN 55296 AND 57343 OR code > 1114111 THEN chr(65533) WHEN code IN ({gone}) THEN '' ELSE chr(code) END END AS said FROM coded),
    found AS (SELECT * FROM (SELECT key, i, said, len FROM named) UNION ALL SELECT key, i, said, len FROM numbered),
    unescaped AS (SELECT key, string_agg(CASE WHEN i = 1 THEN p WHEN said IS NULL THEN '&' || p ELSE said || substr(p, len + 1) END, '' ORDER BY i) AS x FROM parts LEFT JOIN found USING (key, i) GROUP BY key)"""


@query(
    "b1_visible_text",
    f"""WITH {_unescaped("SELECT page_id AS key, regexp_replace(regexp_replace(html, '(?s)<!--.*?-->|<head[ >].*?</head>|<script.*?</script>|<style.*?</style>', ' ', 'g'), '<[^>]*>', ' ', 'g') AS x FROM pages")},
    whole AS (SELECT key AS page_id, nullif(trim(regexp_replace(replace(x, chr(160), ' '), '\\s+', ' ', 'g')), '') AS text FROM unescaped)
    SELECT page_id, CAST(length(text) AS INTEGER) AS n_chars, sha256(text) AS text_sha256 FROM whole""",
)
def visible_text(t):
    return B.parse_pages(t.pages).select("page_id", F.length("text").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))


@query(
    "b3_page_heads",
    f"""WITH {_unescaped("SELECT page_id AS key, regexp_extract(html, '<title>([^<]*)</title>', 1) AS x FROM pages")}
    SELECT key AS page_id, nullif(trim(regexp_replace(replace(x, chr(160), ' '), '\\s+', ' ', 'g')), '') AS title FROM unescaped""",
)
def page_heads(t):
    return B.parse_pages(t.pages).select("page_id", "title")


@query("b4_page_links", """SELECT page_id, count(*) AS n_links FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1)) AS href FROM pages) GROUP BY 1""")
def page_links(t):
    return B.parse_pages(t.pages).where(F.size("links") > 0).select("page_id", F.size("links").cast("long").alias("n_links"))


@query("b5_url_identity", "SELECT page_id, regexp_extract(url, '^([a-z]+)://', 1) AS scheme, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host, regexp_extract(url, '^[a-z]+://[^/]+/([a-z]+)/', 1) AS kind, regexp_extract(url, '^[a-z]+://[^/]+/[a-z]+/([^/?#]+)', 1) AS id FROM pages")
def url_identity(t):
    whole = B.absolute(F.col("url"), "https://portal.example")
    part = lambda p: F.regexp_extract(whole, p, 1)
    return t.pages.select("page_id", part("^([a-z]+)://").alias("scheme"), part("^[a-z]+://([^/?#]+)").alias("host"), part("^[a-z]+://[^/]+/([a-z]+)/").alias("kind"), part("^[a-z]+://[^/]+/[a-z]+/([^/?#]+)").alias("id"))


@query("b6_link_edges", """SELECT DISTINCT page_id, href FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1)) AS href FROM pages) WHERE href LIKE '/%'""")
def link_edges(t):
    links = B.parse_pages(t.pages).select("page_id", F.explode("links.href").alias("href"))
    return links.where("href like '/%'").distinct()


@query(
    "b7_cost_fields",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DECIMAL(24,6)) AS VARCHAR) AS unit_price, CAST(CAST(CAST(l_quantity AS DECIMAL(18,2)) AS DECIMAL(24,6)) AS VARCHAR) AS quantity,
    'Комплект' AS unit, CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_quantity AS INTEGER) AS DECIMAL(24,6)) AS VARCHAR) AS total_amount, 'KZT' AS currency FROM lineitem""",
)
def cost_fields(t):
    price, quantity = F.col("l_extendedprice").cast("decimal(18,2)"), F.col("l_quantity").cast("decimal(18,2)")
    spell = lambda c: F.translate(F.format_number(c, 2), ",.", " ,")
    line = F.concat(spell(price), F.lit(" KZT x "), spell(quantity), F.lit(" Комплект = "), spell((price * F.col("l_quantity").cast("int")).cast("decimal(24,2)")), F.lit(" KZT"))
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", B.cost_fields(line).alias("c"))
    text = lambda c: F.col(f"c.{c}").cast("string").alias(c)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", text("unit_price"), text("quantity"), "c.unit", text("total_amount"), "c.currency")


@query("b8_prepayment", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(CAST(CAST(round(l_discount * 100) AS INTEGER) AS DECIMAL(8,3)) AS VARCHAR) AS prepayment_percent FROM lineitem")
def prepayment(t):
    line = F.concat(F.lit("1 000,00 KZT x "), F.round(F.col("l_discount") * 100).cast("int"), F.lit("% = 10"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", B.prepayment_percent(line).cast("string").alias("prepayment_percent"))


@query("b12_catalogue_total", "SELECT o_orderkey, o_orderkey * 1000 + 7 AS total FROM orders")
def catalogue_total(t):
    text = F.concat(F.lit("Показано 1-50 из "), F.translate(F.format_number(F.col("o_orderkey") * 1000 + 7, 0), ",", " "), F.lit(" записей"))
    return t.orders.select("o_orderkey", B.catalogue_total(text).alias("total"))


@query("c1_pick", "SELECT event_id, coalesce(props ->> '$.k', 'none') AS value FROM events")
def pick(t):
    body = F.concat(F.lit('{"a":"","b":[],"c":null,"k":'), F.get_json_object("props", "$.k"), F.lit("}"))
    return t.events.select("event_id", F.coalesce(C.pick(body, "a", "b", "c", "x", "k"), F.lit("none")).alias("value"))


@query("c2_local_text", "SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN o_orderstatus WHEN 1 THEN o_orderpriority ELSE 'code' END AS label FROM orders")
def local_text(t):
    kind = F.col("o_orderkey") % 3
    body = F.when(kind == 0, F.to_json(F.struct(F.col("o_orderstatus").alias("nameRu"), F.lit("x").alias("code")))).when(kind == 1, F.col("o_orderpriority")).otherwise(F.lit('{"nameKk":"y","code":"code"}'))
    return t.orders.select("o_orderkey", C.local_text(body).alias("label"))


@query("c3_lenient_decimal", "SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 0 THEN CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(24,6)) AS VARCHAR) END AS amount FROM orders")
def lenient_decimal(t):
    text = F.when(F.col("o_orderkey") % 4 != 0, F.translate(F.format_number(F.col("o_totalprice").cast("decimal(18,2)"), 2), ",.", " ,")).otherwise(F.lit("n/a"))
    return t.orders.select("o_orderkey", S.lenient_decimal(text).cast("string").alias("amount"))


@query("c4_iso_time", "SELECT o_orderkey, strftime(CASE o_orderkey % 3 WHEN 0 THEN o_orderdate WHEN 1 THEN o_orderdate - INTERVAL 2 HOUR ELSE o_orderdate AT TIME ZONE 'Asia/Almaty' AT TIME ZONE 'UTC' END, '%Y-%m-%d %H:%M:%S') AS instant FROM orders")
def iso_time(t):
    kind = F.col("o_orderkey") % 3
    text = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.when(kind == 0, "Z").when(kind == 1, "+02:00").otherwise(""))
    return t.orders.select("o_orderkey", F.date_format(S.parse_iso_time(text), "yyyy-MM-dd HH:mm:ss").alias("instant"))


@query("c5_published_at", "SELECT o_orderkey, strftime(CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate ELSE o_orderdate + INTERVAL 1 DAY END, '%Y-%m-%d') AS published FROM orders")
def published_at(t):
    day = lambda c: F.concat(F.date_format(c, "yyyy-MM-dd"), F.lit("T00:00:00Z"))
    later = day(F.col("o_orderdate") + F.make_dt_interval(days=F.lit(1)))
    entry = lambda status, date: F.struct(F.lit(status).alias("status"), date.alias("eventDate"))
    history = F.to_json(F.struct(F.array(entry("DRAFT", day(F.col("o_orderdate"))), entry("PUBLISHED", F.lit("soon")), entry("republished", later)).alias("timeHistory")))
    body = F.when(F.col("o_orderkey") % 2 == 0, F.to_json(F.struct(day(F.col("o_orderdate")).alias("publishedDate")))).otherwise(history)
    return t.orders.select("o_orderkey", F.date_format(C.published_at(body), "yyyy-MM-dd").alias("published"))


def lists(t):
    """A list document per order: its lines under nested keys, for even orders four keys deep and with totals of two names."""
    item = F.to_json(F.struct(F.col("l_linenumber").alias("id"), F.col("l_partkey").cast("string").alias("lotNumber")))
    rows = t.dealt(t.lineitem, "l_orderkey").groupBy("l_orderkey").agg(F.array_join(F.array_sort(F.collect_list(item)), ",").alias("j"), F.count("*").alias("n"))
    flat = F.concat(F.lit('{"data":{"content":['), "j", F.lit(',{"x":1}],"totalElements":"'), "n", F.lit('"}}'))
    deep = F.concat(F.lit('{"total":"many","data":{"results":{"result":{"items":{"content":['), "j", F.lit(',{"x":1}]},"total":-1,"totalCount":'), "n", F.lit("}}}}"))
    return rows.select(F.col("l_orderkey").cast("string").alias("notice"), F.when(F.col("l_orderkey") % 2 == 0, deep).otherwise(flat).alias("body"))


@query("c8_discovered_items", "SELECT CAST(l_orderkey AS VARCHAR) AS notice, CAST(l_linenumber AS VARCHAR) AS source_entity_id, CAST(l_partkey AS VARCHAR) AS business_number, 3 AS priority FROM lineitem")
def discovered_items(t):
    return C.discovered_items(lists(t), "body", "lot", "https://portal.example", 3).select("notice", "source_entity_id", "business_number", "priority")


@query("c10_documents_first_wins", "SELECT sha256(text) AS identity_key, min(doc_id) AS doc_id FROM documents GROUP BY 1")
def documents_first_wins(t):
    """Documents listed twenty to a body, each file named by the hash of its text."""
    entry = F.struct(F.lpad("doc_id", 12, "0").alias("fileName"), F.col("n_chars").alias("fileSize"), F.sha2("text", 256).alias("hash"))
    docs = t.documents.groupBy(F.expr("doc_id div 20").alias("key")).agg(F.to_json(F.array_sort(F.collect_list(entry))).alias("body"))
    found = C.documents(docs, "key", "body", "https://portal.example")
    return found.groupBy("identity_key").agg(F.min(F.col("filename").cast("long")).alias("doc_id"))


@query("c12_organizations", "SELECT CAST(c_custkey AS VARCHAR) AS source_entity_id, c_name AS name_ru, concat(r_name, ', ', n_name) AS address FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey")
def organizations(t):
    rows = t.spread(t.customer, "c_custkey").join(t.nation, F.col("n_nationkey") == F.col("c_nationkey")).join(t.region, F.col("r_regionkey") == F.col("n_regionkey"))
    legal = F.struct(F.col("r_name").alias("countryRu"), F.lit(" ").alias("katoNameRu"), F.col("n_name").alias("street"))
    body = F.to_json(F.struct(F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("nameRu"), legal.alias("legalAddress")).alias("customer")))
    return rows.select(C.organization(body, "https://portal.example", "customer").alias("o")).select("o.source_entity_id", "o.name_ru", "o.address")


@query("c13_goods_description", "SELECT l_orderkey, string_agg(concat(l_returnflag, ': ', l_linenumber, '-', l_partkey), '; ' ORDER BY l_linenumber, l_partkey, l_returnflag) AS description FROM lineitem GROUP BY 1")
def goods_description(t):
    entry = F.struct("l_linenumber", "l_partkey", "l_returnflag")
    rows = t.lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(entry)).alias("e"))
    listed = F.transform("e", lambda x: F.struct(F.concat_ws("-", x["l_linenumber"], x["l_partkey"]).alias("nameRu"), F.struct(x["l_returnflag"].alias("ru")).alias("attribute")))
    return rows.select("l_orderkey", C.goods_description(F.to_json(F.struct(listed.alias("goodsAttributeList"))), "ru").alias("description"))


@query("c14_payment_terms", "SELECT event_id, CASE WHEN event_type = 'click' THEN CAST(CAST(props ->> '$.k' AS DECIMAL(8,3)) AS VARCHAR) ELSE '5.000' END AS prepayment_percent, CASE WHEN event_type = 'view' THEN NULL ELSE '70.000' END AS final_percent FROM events")
def payment_terms(t):
    kind = F.when(F.col("event_type") == "click", F.lit("PREPAY")).when(F.col("event_type") == "view", F.lit("FINAL_PAYMENT")).otherwise(F.lit("OTHER"))
    value = F.when(F.col("event_type") == "click", F.get_json_object("props", "$.k"))
    conditions = F.array(F.struct(F.lit("PREPAY").alias("paymentType"), F.lit("5").alias("value")), F.struct(kind.alias("paymentType"), value.alias("value")))
    body = F.to_json(F.struct(F.lit(70).alias("finalPaymentPercent"), conditions.alias("paymentConditionList")), {"ignoreNullFields": "false"})
    return t.spread(t.events, "event_id").select("event_id", C.payment_terms(body).alias("p")).select("event_id", F.col("p.prepayment_percent").cast("string").alias("prepayment_percent"), F.col("p.final_percent").cast("string").alias("final_percent"))


@query("c15_delivery_schedule", "SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN concat('С даты подписания договора в течение ', p_size, ' рабочих дней') WHEN 1 THEN concat('С ', p_size, ' по ', p_size + 1) ELSE concat('С даты подписания договора по (включительно) ', p_size) END AS terms FROM part")
def delivery_schedule(t):
    size, kind = F.col("p_size"), F.col("p_size") % 3
    schedule = F.when(kind == 0, F.to_json(F.struct(size.alias("count"), F.struct(F.lit("working").alias("code")).alias("dayType")))).when(kind == 1, F.to_json(F.struct(size.alias("monthFrom"), (size + 1).alias("monthTo")))).otherwise(F.to_json(F.struct(size.alias("monthTo"))))
    return t.part.select("p_partkey", C.delivery_schedule(F.concat(F.lit('{"schedule":'), schedule, F.lit("}")), "ru").alias("terms"))


@query("c17_attach_lots", "SELECT 'notice_to_lot' AS relation_type, CAST(l_orderkey AS VARCHAR) AS parent_id, CAST(l_linenumber AS VARCHAR) AS child_id FROM lineitem")
def attach_lots(t):
    return C.attach_lots(lists(t), "notice", "body", "https://portal.example").select("relation_type", "parent_id", "child_id")


@query("c18_lot_completeness", "SELECT l_orderkey, count(DISTINCT l_linenumber) AS n_lots, max(l_linenumber) AS total, CASE WHEN count(DISTINCT l_linenumber) < max(l_linenumber) THEN 'short' ELSE 'ok' END AS status FROM lineitem GROUP BY 1")
def lot_completeness(t):
    pages = t.lineitem.select("l_orderkey", F.col("l_linenumber").alias("lot"), F.lit(1).alias("page"), F.max("l_linenumber").over(_by_order()).alias("total"))
    return C.lot_completeness(pages, "l_orderkey", "lot", "page", "total")


def _by_order():
    from pyspark.sql import Window

    return Window.partitionBy("l_orderkey")


@query("c19_list_total", "SELECT CAST(l_orderkey AS VARCHAR) AS notice, count(*) AS total FROM lineitem GROUP BY 1")
def list_total(t):
    return lists(t).select("notice", C.list_total(F.col("body")).alias("total"))


def lanes(t):
    return t.events.select(F.col("user_id").cast("string").alias("lane_id"), F.col("ts").cast("timestamp").alias("ts"), "event_id", (F.col("event_type") == "error").alias("blocked"))


@query(
    "k6_lane_history",
    """WITH RECURSIVE e AS MATERIALIZED (SELECT CAST(user_id AS VARCHAR) AS lane_id, epoch_us(ts) AS us, event_id, coalesce(event_type = 'error', false) AS blocked,
      row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL),
    s AS (SELECT DISTINCT lane_id, CAST(0 AS BIGINT) AS n, CAST(NULL AS BIGINT) AS event_id, 'closed' AS kept, 'closed' AS state, CAST(0 AS INTEGER) AS blocks, CAST(0 AS BIGINT) AS opened FROM e
      UNION ALL SELECT lane_id, n, event_id, CASE WHEN was = 'open' THEN 'open' WHEN NOT blocked THEN 'closed' WHEN opens THEN 'open' ELSE was END,
        CASE WHEN was = 'open' THEN 'refused' WHEN NOT blocked THEN 'closed' WHEN opens THEN 'open' ELSE was END,
        CASE WHEN was = 'open' THEN blocks WHEN NOT blocked THEN 0 ELSE blocks + 1 END, CASE WHEN was <> 'open' AND blocked AND opens THEN us ELSE opened END
      FROM (SELECT *, was = 'half_open' OR blocks + 1 >= 2 AS opens FROM
        (SELECT e.*, s.blocks, s.opened, CASE WHEN s.kept = 'open' AND e.us - s.opened >= 7200000000 THEN 'half_open' ELSE s.kept END AS was FROM s JOIN e ON e.lane_id = s.lane_id AND e.n = s.n + 1)))
    SELECT lane_id, event_id, state, blocks FROM s WHERE n > 0""",
)
def lane_history(t):
    return K.lane_history(lanes(t), threshold=2, cooldown=7200.0).select("lane_id", "event_id", "state", "blocks")


@query("k7_rolling_spend", "SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS starts_at, CAST(CAST(sum(CAST(value AS DECIMAL(24,6))) AS DECIMAL(24,6)) AS VARCHAR) AS spent, sum(CAST(value AS DECIMAL(24,6))) >= 40 AS over FROM (SELECT value, unnest(generate_series(time_bucket(INTERVAL 5 MINUTE, ts) - INTERVAL 55 MINUTE, time_bucket(INTERVAL 5 MINUTE, ts), INTERVAL 5 MINUTE)) AS w FROM events WHERE event_type = 'purchase') GROUP BY w")
def rolling_spend(t):
    log = t.events.where("event_type = 'purchase'").withColumn("ts", F.col("ts").cast("timestamp"))
    out = K.rolling_spend(log, "ts", "value", F.lit(40))
    return out.select(F.date_format("starts_at", "yyyy-MM-dd HH:mm:ss").alias("starts_at"), F.col("spent").cast("string").alias("spent"), "over")


@query("k8_failure_windows", "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS starts_at, event_type, count(*) AS n FROM events GROUP BY date_trunc('hour', ts), event_type")
def failure_windows(t):
    out = K.failure_windows(t.events.withColumn("ts", F.col("ts").cast("timestamp")), "ts", ["event_type"])
    return out.select(F.date_format("starts_at", "yyyy-MM-dd HH:mm:ss").alias("starts_at"), "event_type", "n")


@query("c7_json_identity", "SELECT CAST(o_orderkey AS VARCHAR) AS source_entity_id, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS business_number, concat('https://portal.example/#/ext(popup:item/', o_orderkey, '/advert)?tabs=advert&tabstatus=active&page=1') AS canonical_url FROM orders")
def json_identity(t):
    number = F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority"))
    body = F.to_json(F.struct(F.lit("").alias("id"), F.col("o_orderkey").alias("advertId"), number.alias("advertNumber")))
    return t.orders.select(C.identity(body, "notice", "https://portal.example").alias("i")).select("i.source_entity_id", "i.business_number", "i.canonical_url")


@query(
    "c16_detail_entities",
    """SELECT concat(l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey) AS source_entity_id, l_returnflag AS status, CAST(CAST(CAST(l_quantity AS DECIMAL(18,2)) AS DECIMAL(24,6)) AS VARCHAR) AS quantity,
    CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DECIMAL(24,6)) AS VARCHAR) AS total_amount, 'KZT' AS currency, CAST(l_suppkey AS VARCHAR) AS customer_id, CAST(CAST(l_linenumber AS DECIMAL(8,3)) AS VARCHAR) AS prepayment_percent,
    strftime(l_shipdate, '%Y-%m-%d') AS ends FROM lineitem""",
)
def detail_entities(t):
    c = F.col
    body = F.to_json(
        F.struct(
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("lotId"),
            c("l_returnflag").alias("lotStatus"),
            c("l_quantity").cast("decimal(18,2)").cast("string").alias("count"),
            F.translate(F.format_number(c("l_extendedprice").cast("decimal(18,2)"), 2), ",.", " ,").alias("totalSum"),
            F.struct(c("l_suppkey").alias("companyId")).alias("customerInfo"),
            c("l_linenumber").alias("prepaymentPercent"),
            F.concat(F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit("T00:00:00Z")).alias("endDateTime"),
        )
    )
    rows = C.detail_entities(t.spread(t.lineitem, "l_orderkey").select(body.alias("body")), "body", "lot", "https://portal.example")
    text = lambda x: F.col(x).cast("string").alias(x.split(".")[-1])
    return rows.select("source_entity_id", "status", text("quantity"), text("total_amount"), "currency", F.col("customer.source_entity_id").alias("customer_id"), text("payment_terms.prepayment_percent"), F.date_format("application_end_at", "yyyy-MM-dd").alias("ends"))


@query("e13_delivery_terms", "SELECT p_partkey, concat('С даты подписания договора в течение ', p_size, ' календарных дней') AS delivery_terms_ru FROM part WHERE p_partkey % 2 = 0 UNION ALL SELECT p_partkey, 'by hand' FROM part WHERE p_partkey % 2 = 1")
def delivery_terms(t):
    """Stored terms of one source rebuilt from the payload; the other source keeps its own."""
    from tenderlake.plans.tables import source_of

    payload = F.to_json(F.struct(F.struct(F.col("p_size").alias("daysForDelivery"), F.struct(F.lit("CALENDAR").alias("code")).alias("dayType")).alias("schedule")))
    stored = t.part.select("p_partkey", payload.alias("source_payload"), F.lit("by hand").alias("delivery_terms_ru"))
    registry = t.part.select("p_partkey", source_of("p_partkey").alias("source"))
    rebuilt = F.when(F.col("source") == "portal_a", F.coalesce(C.delivery_schedule(F.col("source_payload"), "ru"), F.col("delivery_terms_ru"))).otherwise(F.col("delivery_terms_ru"))
    return stored.join(registry, "p_partkey").select("p_partkey", rebuilt.alias("delivery_terms_ru"))


PORTAL = "https://portal.example"


def list_pages(t):
    """A list page per order, as the portal writes it: a grid of its lots."""
    row = F.concat(F.lit('<tr><td><a href="/ru/publics/lot/'), "l_orderkey", F.lit("-"), "l_linenumber", F.lit('?tab=1">L-'), "l_linenumber", F.lit("</a></td><td>"), F.col("l_quantity").cast("int"), F.lit("</td></tr>"))
    rows = t.dealt(t.lineitem, "l_orderkey").groupBy("l_orderkey").agg(F.array_join(F.array_sort(F.collect_list(row)), "").alias("rows"))
    html = F.concat(F.lit('<div class="grid-view"><table><thead><tr><th>№ лота</th><th>Количество</th></tr></thead><tbody>'), "rows", F.lit("</tbody></table></div>"))
    return B.parse_pages(rows.select(F.col("l_orderkey").alias("page_id"), html.alias("html")))


@query("b2_table_rows", "SELECT l_orderkey AS page_id, '№ лота|Количество' AS headers, count(*) AS n_rows, CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS quantity FROM lineitem GROUP BY 1")
def table_rows(t):
    rows = list_pages(t).select("page_id", F.explode("tables").alias("t")).select("page_id", F.array_join("t.headers", "|").alias("headers"), F.explode("t.rows.cells").alias("cells"))
    return rows.groupBy("page_id", "headers").agg(F.count("*").alias("n_rows"), F.sum(F.element_at("cells", 2).cast("long")).alias("quantity"))


@query("b4_discovered_items", "SELECT DISTINCT l_orderkey AS page_id, 'lot' AS entity_type, concat(l_orderkey, '-', l_linenumber) AS source_entity_id, concat('L-', l_linenumber) AS business_number, 5 AS priority FROM lineitem")
def listed_items(t):
    return B.discovered_items(list_pages(t), "lot", PORTAL, "portal_a", 5).select("page_id", "entity_type", "source_entity_id", "business_number", "priority")


@query("b5_identities", f"""SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'lot' WHEN 1 THEN 'notice' WHEN 2 THEN 'plan_item' WHEN 3 THEN 'organization' END AS entity_type,
    CASE WHEN o_orderkey % 5 < 4 THEN CAST(o_orderkey AS VARCHAR) END AS source_entity_id, CASE o_orderkey % 5 WHEN 0 THEN '{PORTAL}/ru/publics/lot/' WHEN 1 THEN '{PORTAL}/ru/publics/buy/' WHEN 2 THEN '{PORTAL}/ru/publics/point/' WHEN 3 THEN '{PORTAL}/ru/publics/subject/' END || o_orderkey || '?x=1' AS canonical_url FROM orders""")
def identities(t):
    word = F.element_at(F.array(*map(F.lit, ["lot", "buy", "point", "subject", "news"])), (F.col("o_orderkey") % 5 + 1).cast("int"))
    found = B.identity_of(F.concat(F.lit("/ru/publics/"), word, F.lit("/"), "o_orderkey", F.lit("?x=1")), PORTAL, "portal_a")
    return t.orders.select("o_orderkey", found.alias("i")).select("o_orderkey", "i.entity_type", "i.source_entity_id", "i.canonical_url")


def detail_pages(t):
    """A detail page per order, as the portal writes it: fields, a place, a document and links."""
    key, money = F.col("o_orderkey"), lambda c: F.translate(c.cast("decimal(18,2)").cast("string"), ".", ",")
    field = lambda label, *value: F.concat(F.lit(f"<tr><th>{label}</th><td>"), *value, F.lit("</td></tr>"))
    html = F.concat(
        F.lit('<html><head><title>t</title><script>var x = "<td>no</td>";</script></head><body><h1 class="page-title">Объявление '), key, F.lit('</h1><table class="detail-view">'),
        field(B.FIELDS["status"], F.col("o_orderstatus")), field(B.FIELDS["status"], F.lit("second")),
        field(B.COST, money(F.col("o_totalprice")), F.lit(" KZT x 2 Комплект = "), money(F.col("o_totalprice") * 2), F.lit(" KZT")),
        field(B.CUSTOMER, F.lit('<a href="/ru/publics/subject/'), "o_custkey", F.lit('">x</a>')),
        F.lit(f'</table><h3>{B.PLACES}</h3><div class="grid-view"><table><thead><tr><th>{B.COUNTRY}</th><th>{B.PLACE}</th><th>{B.QUANTITY}</th></tr></thead><tbody><tr data-key="p'), key, F.lit('"><td>KZ</td><td>DDP г. '), key, F.lit("</td><td>"), key % 90, F.lit(",5</td></tr></tbody></table></div>"),
        F.lit(f'<h3>{B.DOCUMENTS}</h3><div class="grid-view"><table><thead><tr><th>{B.FILE}</th><th>{B.SIZE}</th><th></th></tr></thead><tbody><tr data-key="d'), key, F.lit('"><td>План '), key, F.lit(".PDF</td><td>"), key % 7 + 1, F.lit(f' КБ</td><td><a title="{B.DOWNLOAD}" href="/f/'), key, F.lit('">x</a></td></tr></tbody></table></div>'),
        F.lit('<a href="/ru/publics/lot/'), key, F.lit('-1">lot</a><a href="/ru/publics/buy/'), key, F.lit('">self</a><a href="/ru/publics/point/'), key % 97, F.lit('">plan</a></body></html>'),
    )
    return B.parse_pages(t.spread(t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_custkey"), "o_orderkey").select(key.alias("page_id"), html.alias("html")))


def page_identities(t):
    return t.orders.select(F.col("o_orderkey").alias("page_id"), F.lit("notice").alias("entity_type"), F.col("o_orderkey").cast("string").alias("source_entity_id"), F.col("o_orderkey").cast("string").alias("business_number"))


@query("b3_detail_fields", "SELECT o_orderkey AS page_id, o_orderstatus AS status, '/ru/publics/subject/' || o_custkey AS customer_link, 3 AS n_fields FROM orders")
def detail_fields(t):
    return detail_pages(t).select("page_id", F.col("fields")[B.FIELDS["status"]].alias("status"), F.col("field_links")[B.CUSTOMER].alias("customer_link"), F.size("fields").alias("n_fields"))


@query("b6_page_edges", """SELECT o_orderkey AS page_id, 'lot' AS child_type, o_orderkey || '-1' AS child_id, 'notice_to_lot' AS relation_type FROM orders UNION ALL SELECT o_orderkey, 'plan_item', CAST(o_orderkey % 97 AS VARCHAR), NULL FROM orders
    UNION ALL SELECT o_orderkey, 'organization', CAST(o_custkey AS VARCHAR), NULL FROM orders""")
def page_edges(t):
    return B.page_links(detail_pages(t), page_identities(t).drop("business_number"), PORTAL, "portal_a").select("page_id", "child_type", "child_id", "relation_type")


@query("b9_delivery_places", "SELECT o_orderkey AS page_id, 'p' || o_orderkey AS source_row_id, 'KZ' AS country, 'DDP г. ' || o_orderkey AS address, CAST(CAST(o_orderkey % 90 + 0.5 AS DECIMAL(24,6)) AS VARCHAR) AS quantity, 'DDP' AS incoterms FROM orders")
def page_places(t):
    return B.delivery_places(detail_pages(t)).withColumn("quantity", F.col("quantity").cast("string")).drop("source_payload")


@query("b10_page_documents", f"SELECT o_orderkey AS page_id, 'd' || o_orderkey AS source_document_id, 'План ' || o_orderkey || '.PDF' AS filename, 'pdf' AS extension, '{PORTAL}/f/' || o_orderkey AS url, CAST((o_orderkey % 7 + 1) * 1024 AS BIGINT) AS size_bytes, 'application/pdf' AS inferred_content_type FROM orders")
def page_documents(t):
    return B.page_documents(detail_pages(t), PORTAL).select("page_id", "source_document_id", "filename", "extension", "url", F.col("size_bytes").cast("long").alias("size_bytes"), "inferred_content_type")


@query("b11_detail_entities", """SELECT o_orderkey AS page_id, 'notice' AS entity_type, CAST(o_orderkey AS VARCHAR) AS source_entity_id, o_orderstatus AS status, 'Объявление ' || o_orderkey AS title_ru, CAST(o_custkey AS VARCHAR) AS customer_id,
    CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(24,6)) AS VARCHAR) AS unit_price, CAST(CAST(CAST(o_totalprice * 2 AS DECIMAL(18,2)) AS DECIMAL(24,6)) AS VARCHAR) AS total_amount, 'KZT' AS currency FROM orders""")
def page_entities(t):
    out = B.detail_entities(detail_pages(t), page_identities(t), PORTAL, "portal_a")
    return out.select("page_id", "entity_type", "source_entity_id", "status", "title_ru", "customer_id", F.col("unit_price").cast("string").alias("unit_price"), F.col("total_amount").cast("string").alias("total_amount"), "currency")


@query("i2_csv_report", """SELECT count(*) AS rows, count(*) FILTER (WHERE o_orderkey % 11 = 0) AS malformed_rows, CAST(sum(CASE WHEN o_orderkey % 7 = 0 THEN 2 ELSE 0 END) AS BIGINT) AS replacement_characters, count(*) FILTER (WHERE o_orderkey % 5 = 0) AS formula_like_cells,
    (SELECT count(*) FROM orders WHERE o_custkey % 13 <> 0) - (SELECT count(DISTINCT o_custkey) FROM orders WHERE o_custkey % 13 <> 0) AS duplicate_identity_rows, count(*) FILTER (WHERE o_custkey % 13 = 0) AS empty_identity_rows FROM orders""")
def csv_report(t):
    key = F.col("o_orderkey")
    title = F.concat(F.when(key % 5 == 0, "=1+").otherwise("a"), "o_orderstatus", F.when(key % 7 == 0, "��").otherwise(""))
    cells = t.orders.select(F.lit("portal_a").alias("source"), F.when(F.col("o_custkey") % 13 != 0, F.concat(F.lit(" "), "o_custkey")).otherwise("  ").alias("source_entity_id"), title.alias("title"), (key % 11 == 0).alias("broken"))
    return Q.csv_report(cells, ["source", "source_entity_id", "title"], ["source", "source_entity_id"], F.col("broken"))


@query("c6_item_lists", "SELECT CAST(l_orderkey AS VARCHAR) AS notice, count(*) + 1 AS n_items FROM lineitem GROUP BY 1")
def item_lists(t):
    return lists(t).select("notice", C.items(F.col("body")).alias("items")).select("notice", F.size("items").cast("long").alias("n_items"))


@query("c9_walk", "SELECT CAST(l_orderkey AS VARCHAR) AS key, count(*) + CASE WHEN l_orderkey % 2 = 0 THEN 6 ELSE 3 END AS n_objects, count(*) AS with_id FROM lineitem GROUP BY l_orderkey")
def walk(t):
    return C.walk(lists(t), "notice", "body").groupBy("key").agg(F.count("*").alias("n_objects"), F.count(F.get_json_object("object", "$.id")).alias("with_id"))


@query("c11_delivery_places", "SELECT o_orderkey, '1' AS source_row_id, 'KZ' AS country, 'Склад ' || o_orderkey AS address, CAST(CAST(o_orderkey % 50 AS DECIMAL(24,6)) AS VARCHAR) AS quantity FROM orders WHERE o_orderkey % 3 <> 0")
def json_places(t):
    place = F.to_json(F.struct(F.lit(1).alias("id"), F.lit("KZ").alias("country"), F.concat(F.lit("Склад "), "o_orderkey").alias("address"), (F.col("o_orderkey") % 50).alias("quantity")))
    body = F.when(F.col("o_orderkey") % 3 != 0, F.concat(F.lit('{"deliveryPlaces":['), place, F.lit("]}"))).otherwise(F.lit("{}"))
    rows = t.orders.select("o_orderkey", F.explode(C.delivery_places(body)).alias("p"))
    return rows.select("o_orderkey", "p.source_row_id", "p.country", "p.address", F.col("p.quantity").cast("string").alias("quantity"))
