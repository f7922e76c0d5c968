"""Scalar functions on the driver's tables, with their SQL."""

from pyspark.sql import functions as F

from tenderlake.functions import scalars as S
from tenderlake.plans.tables import Tables

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            SQL[name] = sql
        return f

    return add


@query(
    "d1_parse_decimal",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_extendedprice AS DECIMAL(18,2)) AS price, CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DECIMAL(24,6)) AS VARCHAR) AS parsed,
       CAST(CAST(CAST(l_quantity AS DECIMAL(18,2)) AS DECIMAL(24,6)) AS VARCHAR) AS european FROM lineitem""",
)
def parse_decimal(t):
    price, quantity = F.col("l_extendedprice").cast("decimal(18,2)"), F.col("l_quantity").cast("decimal(18,2)")
    spelled = F.concat(F.translate(F.format_number(price, 2), ",.", " ,"), F.lit(" KZT"))
    european = F.concat(F.translate(F.format_number(quantity, 2), ",.", ".,"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", price.alias("price"), S.parse_decimal(spelled).cast("string").alias("parsed"), S.parse_decimal(european).cast("string").alias("european"))


@query("d2_parse_time", "SELECT event_id, strftime(date_trunc('second', ts) AT TIME ZONE 'Asia/Almaty' AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS instant FROM events")
def parse_time(t):
    text = F.concat(F.lit("at "), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit(" local"))
    return t.events.select("event_id", F.date_format(S.parse_portal_time(text), "yyyy-MM-dd HH:mm:ss").alias("instant"))


@query("d3_parse_size", "SELECT doc_id, CAST(floor(CAST(n_chars AS DECIMAL(24,6)) / 1000 * 1024) AS BIGINT) AS size_bytes FROM documents")
def parse_size(t):
    text = F.concat(F.translate(F.format_string("%.3f", F.col("n_chars") / 1000), ".", ","), F.lit(" КБ"))
    return t.documents.select("doc_id", S.parse_size(text).alias("size_bytes"))


@query("d4_stable_key", "SELECT concat_ws(':', source, 'document', CAST(doc_id AS VARCHAR)) AS stable_key FROM documents")
def stable_key(t):
    return t.documents.select(S.stable_key(F.col("source"), F.lit("document"), F.col("doc_id").cast("string")).alias("stable_key"))


@query("d5_content_hash", "SELECT c_custkey, sha256(concat_ws(chr(31), coalesce('=' || c_name, '!'), coalesce('=' || c_nationkey, '!'), coalesce('=' || c_mktsegment, '!'))) AS content_hash FROM customer")
def content_hash(t):
    return t.customer.select("c_custkey", S.content_hash(F.col("c_name"), F.col("c_nationkey"), F.col("c_mktsegment")).alias("content_hash"))


@query("d6_document_key", "SELECT doc_id, left(CASE WHEN doc_id % 3 = 0 THEN CAST(doc_id AS VARCHAR) WHEN doc_id % 3 = 1 THEN sha256(text) ELSE sha256(concat(doc_id, text)) END, 512) AS identity_key FROM documents")
def document_key(t):
    d, kind = F.col("doc_id"), F.col("doc_id") % 3
    blank = F.lit("  ")
    return t.documents.select("doc_id", S.document_key(F.when(kind == 0, d.cast("string")), F.when(kind == 1, F.sha2("text", 256)).otherwise(blank), blank, F.lit(None).cast("string"), F.concat(d, F.col("text"))).alias("identity_key"))


URL_PATH = "regexp_replace(regexp_replace(url, '[?#].*$', ''), '^[a-z]+://[^/]*', '')"


@query("d7_file_extension", f"SELECT page_id, nullif(lower(regexp_extract({URL_PATH} || '/f' || CASE page_id % 4 WHEN 0 THEN '.PDF' WHEN 1 THEN '.tar.gz' WHEN 2 THEN '' ELSE '.Xlsx' END, '\\.([^./]+)$', 1)), '') AS extension FROM pages")
def file_extension(t):
    return t.pages.select("page_id", S.file_extension(_file_name()).alias("extension"))


def _file_name():
    path = F.regexp_replace(F.regexp_replace("url", r"[?#].*$", ""), r"^[a-z]+://[^/]*", "")
    suffix = F.element_at(F.array(F.lit(".PDF"), F.lit(".tar.gz"), F.lit(""), F.lit(".Xlsx")), (F.col("page_id") % 4).cast("int") + 1)
    return F.concat(path, F.lit("/f"), suffix)


@query("d8_mime_type", "SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'application/pdf' WHEN 3 THEN 'application/vnd.openxmlformats-officedocument.spreadsheetml.sheet' END AS mime FROM pages")
def mime_type(t):
    return t.pages.select("page_id", S.mime_type(_file_name()).alias("mime"))


@query(
    "d9_spreadsheet_escape",
    """SELECT c_custkey, cell, CASE WHEN f THEN concat('''', cell) ELSE cell END AS escaped, f AS formula FROM (
       SELECT *, regexp_matches(ltrim(cell), '^[=+@]') OR (ltrim(cell) LIKE '-%' AND NOT regexp_matches(ltrim(cell), '^-[0-9]+([.,][0-9]+)?$')) AS f FROM (
       SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) WHEN 1 THEN concat(' -', c_mktsegment) ELSE concat('=', c_name) END AS cell FROM customer))""",
)
def spreadsheet_escape(t):
    kind = F.col("c_custkey") % 3
    cell = F.when(kind == 0, F.col("c_acctbal").cast("decimal(12,2)").cast("string")).when(kind == 1, F.concat(F.lit(" -"), "c_mktsegment")).otherwise(F.concat(F.lit("="), "c_name"))
    return t.customer.select("c_custkey", cell.alias("cell"), S.escape_formula(cell).alias("escaped"), S.is_formula(cell).alias("formula"))


@query("d10_local_time", "SELECT event_id, strftime(ts AT TIME ZONE 'UTC' AT TIME ZONE 'Asia/Almaty', '%Y-%m-%d %H:%M:%S') AS ts_local, 'Asia/Almaty' AS source_timezone FROM events")
def local_time(t):
    return t.events.select("event_id", F.date_format(S.local_time(F.col("ts")), "yyyy-MM-dd HH:mm:ss").alias("ts_local"), F.lit(S.PORTAL_ZONE).alias("source_timezone"))


@query("d11_json_paths", "SELECT event_id, props ->> '$.k' AS k, props ->> '$.missing' AS missing, coalesce((props ->> '$.k') = '7', false) AS holds_seven FROM events")
def json_paths(t):
    p = F.col("props")
    return t.events.select("event_id", S.json_text(p, "$.k").alias("k"), S.json_text(p, "$.missing").alias("missing"), S.json_contains(p, {"$.k": "7"}).alias("holds_seven"))


@query("d12_patterns", "SELECT p_partkey, regexp_extract(p_type, '^([A-Z]+)', 1) AS first_word, regexp_matches(p_type, 'STEEL$') AS steel, regexp_matches(p_type, '(?i)brushed') AS brushed, p_type ILIKE '%tin%' AS tin FROM part")
def patterns(t):
    c = F.col("p_type")
    return t.part.select("p_partkey", F.regexp_extract(c, "^([A-Z]+)", 1).alias("first_word"), c.rlike("STEEL$").alias("steel"), c.rlike("(?i)brushed").alias("brushed"), c.ilike("%tin%").alias("tin"))


@query(
    "d13_conditionals",
    """SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'O'), 'open') AS status, greatest(o_orderkey, o_custkey) AS high, least(o_orderkey, o_custkey) AS low, lower(o_orderpriority) AS priority,
       CAST(floor(epoch(o_orderdate)) AS BIGINT) AS epoch, o_orderstatus IS DISTINCT FROM 'F' AS not_final, TRY_CAST(left(o_orderpriority, 1) AS INTEGER) AS rank, strftime(o_orderdate + INTERVAL 90 SECOND, '%Y-%m-%d %H:%M:%S') AS later FROM orders""",
)
def conditionals(t):
    c = F.col
    return t.orders.select(
        "o_orderkey",
        F.coalesce(F.nullif("o_orderstatus", F.lit("O")), F.lit("open")).alias("status"),
        F.greatest("o_orderkey", "o_custkey").alias("high"),
        F.least("o_orderkey", "o_custkey").alias("low"),
        F.lower("o_orderpriority").alias("priority"),
        F.unix_timestamp(c("o_orderdate").cast("timestamp")).alias("epoch"),
        (~c("o_orderstatus").eqNullSafe("F")).alias("not_final"),
        F.left("o_orderpriority", F.lit(1)).try_cast("int").alias("rank"),
        F.date_format(c("o_orderdate") + F.make_dt_interval(secs=F.lit(90)), "yyyy-MM-dd HH:mm:ss").alias("later"),
    )


@query("d14_merge_json", """SELECT event_id, concat('{"at":{"id":', event_id, ',"ok":true},"k":', CASE WHEN event_id % 2 = 0 THEN '"new"' ELSE CAST(props -> '$.k' AS VARCHAR) END, ',"user":', user_id, '}') AS merged FROM events""")
def merge_json(t):
    at = F.struct(F.col("event_id").alias("id"), F.lit(True).alias("ok")).alias("at")
    new = F.when(F.col("event_id") % 2 == 0, F.to_json(F.struct(F.lit("new").alias("k"), F.col("user_id").alias("user"), at))).otherwise(F.to_json(F.struct(F.col("user_id").alias("user"), at)))
    return t.events.select("event_id", S.merge_json(F.col("props"), new).alias("merged"))


@query("d15_redact", """SELECT event_id, concat('{"Cookie":"[REDACTED]","list":[{"x":{"Authorization":"[REDACTED]"}},{"n":', event_id, '}],"x":{"proxy_password":"[REDACTED]"},"user":', user_id, '}') AS line FROM events""")
def redact(t):
    listed = F.concat(F.lit('"list":[{"x":{"Authorization":{"a":[{"b":"secret ]}"}]}}},{"n":'), F.col("event_id"), F.lit("}]"))
    line = F.concat(F.lit('{"Cookie":"s\\"e; cret",'), listed, F.lit(',"x":{"proxy_password":'), F.get_json_object("props", "$.k"), F.lit('},"user":'), F.col("user_id"), F.lit("}"))
    return t.events.select("event_id", S.redact(line).alias("line"))


@query("d16_duration_parts", "SELECT user_id, round(CAST(n AS DOUBLE), 2) AS seconds, round(n / 3600.0, 2) AS hours, round(n / 86400.0, 2) AS days FROM (SELECT user_id, epoch(date_trunc('second', max(ts))) - epoch(date_trunc('second', min(ts))) AS n FROM events GROUP BY 1)")
def duration_parts(t):
    ts = F.col("ts").cast("timestamp")
    spans = t.events.groupBy("user_id").agg((F.unix_timestamp(F.max(ts)) - F.unix_timestamp(F.min(ts))).cast("double").alias("n"))
    return spans.select("user_id", S.duration_parts(F.col("n")).alias("d")).select("user_id", "d.*")


@query("d17_retry_delay", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(least(300, 5 * power(2, greatest(0, l_linenumber - 1))) AS BIGINT) AS delay FROM lineitem")
def retry_delay(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", S.retry_delay(F.col("l_linenumber")).alias("delay"))
