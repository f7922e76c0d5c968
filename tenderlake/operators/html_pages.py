"""HTML pages to rows: one parse job over raw pages, then column and join work.

The job (``parse_pages``) turns each page into its title, detail fields, tables,
links and visible text inside ``mapInArrow``; everything after it is DataFrame code.
Plain markup is split at its tags, each distinct tag read once; a page that has anything
else goes to the standard library's parser, which calls the same handlers. Tag closing follows what browsers do for
rows and cells: a new row or cell ends the open one, and rows may stand directly
under a table.
"""

import html as references
import re
from functools import lru_cache
from html import parser
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tenderlake.functions import scalars

AT_ONCE = 256  #: pages whose results are in memory together
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}

# Path words of the portal's entity pages.
PATH_TYPES = {"lot": "lot", "buy": "notice", "point": "plan_item", "subject": "organization"}

# Labels of edges by the types of both ends.
EDGE_TYPES = {"plan_item>notice": "plan_to_notice", "plan_item>lot": "plan_to_lot", "notice>lot": "notice_to_lot"}

# Labels of the detail page's fields.
FIELDS = {
    "title_ru": "Наименование на русском языке",
    "title_kk": "Наименование на государственном языке",
    "description_ru": "Описание на русском языке",
    "description_kk": "Описание на государственном языке",
    "additional_characteristics_ru": "Дополнительная характеристика на русском языке",
    "additional_characteristics_kk": "Дополнительная характеристика на государственном языке",
    "status": "Статус",
    "procurement_method": "Способ закупки",
    "tru_code": "Код КТРУ",
    "procurement_month": "Месяц",
    "plan_item_type": "Тип пункта плана",
    "delivery_terms_ru": "Срок поставки на русском языке",
    "delivery_terms_kk": "Срок поставки на государственном языке",
    "bin": "БИН",
    "address": "Адрес",
    "phone": "Телефон",
    "email": "Электронная почта",
}
YEAR, COST, ADVANCE, STARTS, ENDS, CUSTOMER, ORGANIZER = "Год", "Расчет полной стоимости", "Расчет авансового платежа", "Дата начала приема заявок", "Дата окончания приема заявок", "Заказчик", "Организатор"
PLACES, PLACE, COUNTRY, QUANTITY = "Места поставки", "Место поставки", "Страна", "Количество"
DOCUMENTS, FILE, CATEGORY, SIZE, UPLOADED, FILE_HASH, DOWNLOAD = "Документы", "Наименование документа", "Категория документа", "Размер", "Дата загрузки", "Уникальный хэш", "Скачать"

LINK = "struct<href:string,text:string,title:string>"
ROW = f"struct<row_id:string,cells:array<string>,links:array<struct<cell:int,href:string,text:string,title:string>>>"
SCHEMA = f"page_id long, title string, heading string, stats string, text string, fields map<string,string>, field_links map<string,string>, tables array<struct<heading:string,headers:array<string>,in_grid:boolean,rows:array<{ROW}>>>, links array<{LINK}>"


# what every version of the standard parser reads alike, between < and >: tags with quoted attributes, comments, document types
TAG = re.compile(r"""(/?)([a-zA-Z][a-zA-Z0-9]*)((?:[ \t\n]+[a-zA-Z][a-zA-Z0-9_:-]*=(?:"[^"]*"|'[^']*'))*)[ \t\n]*(/?)""")
UNSEEN = re.compile(r"!--(?!-?$)(?>[^-]+|-(?!-))*+--|!(?i:doctype)[ \t\n][^\[]*")
ATTRIBUTE = re.compile(r"""([a-zA-Z][a-zA-Z0-9_:-]*)=(?:"([^"]*)"|'([^']*)')""")
RAW = {"script", "style"}
VALUE = getattr(parser, "_unescape_attrvalue", None) or references.unescape
CELLS, ROWS, BODIES, TABLE, ROW_END = {"td", "th"}, {"tr"}, {"tbody", "thead", "tr"}, {"table"}, {"tr", "table"}
COLLECTED = {"td", "th", "h1", "h2", "h3", "h4", "title", "a"}


@lru_cache(1 << 12)
def _tag(inside: str) -> tuple[str, str, dict] | None:
    """What stands between < and >: / for an end tag, > for a tag that ends itself, ! for nothing to see; its name and attributes."""
    found = TAG.fullmatch(inside)
    if not found:
        return ("!", "", {}) if UNSEEN.fullmatch(inside) else None
    end, tag, attributes, own_end = found.groups()
    if end:
        return None if attributes or own_end else ("/", tag.lower(), {})
    pairs = ((k.lower(), v or w) for k, v, w in ATTRIBUTE.findall(attributes))
    return ">" if own_end else "", tag.lower(), {k: VALUE(v) if "&" in v else v for k, v in pairs}


class _Page(HTMLParser):
    """Collects what ``parse_pages`` returns; text inside script and style is not visible."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open, self.hidden, self.headers, self.heading_now = [], 0, 0, None
        self.sinks: list[list[str]] = []  # open text collectors
        self.text, self.links, self.tables, self.out = [], [], [], {"title": None, "heading": None, "stats": None}
        self.fields, self.field_links = {}, {}

    def sink(self):
        self.sinks.append([])
        return self.sinks[-1]

    def updatepos(self, i, j):  # nobody asks for line numbers
        return j

    @staticmethod
    def clean(parts):
        return " ".join(" ".join(parts).replace("\xa0", " ").split()) or None

    def plain(self, text: str) -> bool:
        """Reads a page of plain markup; of another one nothing is to be kept."""
        parts, raw, unescape = text.split("<"), None, references.unescape
        start, finish, rest, data = self.start, self.finish, self.open, self.handle_data
        if parts[0]:
            data(unescape(parts[0]))
        for i in range(1, len(parts)):
            inside, closed, words = parts[i].partition(">")
            if raw:  # up to its end tag; what lies between is not visible
                if inside[:1] not in ("/", "!"):
                    continue
                kind = _tag(inside)
                if not closed or not kind or not kind[0]:
                    return False
                if inside.rstrip(" \t\n") != "/" + raw:
                    if kind[1] in RAW:
                        return False
                    continue
                raw = None
            else:
                kind = _tag(inside) if closed else None
                if not kind:
                    return False
            mark, tag, a = kind
            if mark == "/":
                if rest and rest[-1][0] == tag:
                    finish(*rest.pop())
                else:
                    self.handle_endtag(tag)
            elif mark != "!":
                start(tag, a)
                if mark == ">":
                    self.handle_endtag(tag)
                elif tag in RAW:
                    raw = tag
                    continue
            if words:
                data(unescape(words) if "&" in words else words)
        return not raw

    def handle_starttag(self, tag, attributes):
        self.start(tag, {k: v or "" for k, v in attributes})

    def start(self, tag, a):
        if tag in RAW:
            self.hidden += 1
            self.open.append((tag, None, a))
            return
        if tag in CELLS:
            self.close_to(CELLS, ROW_END)
        elif tag == "tr":
            self.close_to(ROWS, TABLE)
        elif tag in ("tbody", "thead"):
            self.close_to(BODIES, TABLE)
        node = None
        if tag == "table":
            grid = any("grid-view" in x[2].get("class", "").split() for x in self.open)
            node = {"heading": self.heading_now, "headers": [], "in_grid": grid, "rows": [], "detail": "detail-view" in a.get("class", "").split()}
            self.tables.append(node)
        elif tag == "tr" and self.table():
            node = {"row_id": a.get("data-key"), "cells": [], "links": [], "heads": [], "head": any(x[0] == "thead" for x in self.open)}
        elif tag in COLLECTED or a and "stats" in a.get("class", "").split():
            node = {"sink": self.sink(), "links": []}
        if tag not in VOID:
            self.headers += tag in ("title", "head")
            self.open.append((tag, node, a))

    def handle_endtag(self, tag):
        self.close_to((tag,), ())

    def close_to(self, tags, barrier):
        """Close the innermost open element of the tags, and what is inside it, unless a barrier comes first."""
        rest = self.open
        for i in range(len(rest) - 1, -1, -1):
            tag = rest[i][0]
            if tag in tags:
                while len(rest) > i:
                    self.finish(*rest.pop())
                return
            if tag in barrier:
                return

    def table(self):
        for x in reversed(self.open):
            if x[0] == "table":
                return x[1]
        return None

    def inner(self, tag):
        for x in reversed(self.open):
            if x[0] == tag and x[1]:
                return x[1]
        return None

    def finish(self, tag, node, a):
        if tag in RAW:
            self.hidden -= 1
            return
        self.headers -= tag in ("title", "head")
        if not node:
            return
        if "sink" in node:
            value = self.clean(node["sink"])
            if self.sinks[-1] is node["sink"]:
                self.sinks.pop()
            else:
                self.sinks = [s for s in self.sinks if s is not node["sink"]]
            row = self.inner("tr")
            if tag == "a" and "href" in a:
                self.links.append({"href": a["href"], "text": value, "title": a.get("title")})
                cell = self.inner("td")
                if row is not None and cell is not None:
                    row["links"].append({"cell": len(row["cells"]), "href": a["href"], "text": value, "title": a.get("title")})
            elif tag == "td" and row is not None:
                row["cells"].append(value)
            elif tag == "th" and row is not None:
                row["heads"].append(value or "")
            elif tag in ("h2", "h3", "h4"):
                self.heading_now = value
            elif tag == "h1" and self.out["heading"] is None:
                self.out["heading"] = value
            elif tag == "title":
                self.out["title"] = self.out["title"] or value
            if a and self.out["stats"] is None and "stats" in a.get("class", "").split():
                self.out["stats"] = value
        elif tag == "tr":
            table = self.table()
            if table["detail"]:
                key, value = (node["heads"] or [None])[0], (node["cells"] or [None])[0]
                if key and value and key not in self.fields:
                    self.fields[key] = value
                    link = next((x["href"] for x in node["links"] if x["cell"] == 0), None)
                    if link:
                        self.field_links[key] = link
            elif node["head"]:
                table["headers"] += node["heads"]
            elif node["cells"]:
                table["rows"].append({k: node[k] for k in ("row_id", "cells", "links")})

    def handle_data(self, data):
        if not self.hidden:
            if not self.headers:
                self.text.append(data)
            for s in self.sinks:
                s.append(data)

    def result(self):
        while self.open:
            self.finish(*self.open.pop())
        tables = [{k: t[k] for k in ("heading", "headers", "in_grid", "rows")} for t in self.tables if not t["detail"] and (t["rows"] or t["headers"])]
        return self.out | {"text": self.clean(self.text), "fields": list(self.fields.items()), "field_links": list(self.field_links.items()), "tables": tables, "links": self.links}


def parse_html(html: str | None) -> dict:
    page = _Page()
    if not page.plain(html or ""):
        page = _Page()
        page.feed(html)
        page.close()
    return page.result()


def parse_pages(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """One row per page; a null page gives empty results."""

    schema = StructType.fromDDL(SCHEMA)
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for at in range(0, len(batch), AT_ONCE):
                part = batch.slice(at, AT_ONCE)
                yield pa.RecordBatch.from_pylist([{"page_id": i} | parse_html(h) for i, h in zip(part.column("page_id").to_pylist(), part.column("html").to_pylist())], arrow)

    return pages.select(F.col(key).cast("long").alias("page_id"), F.col(html).alias("html")).mapInArrow(run, schema)


def visible_text(html: Column) -> Column:
    """The same text by expressions alone, for pages without character references."""
    bare = F.regexp_replace(html, r"(?is)<head.*?</head>|<script.*?</script>|<style.*?</style>", " ")
    return scalars.clean_text(F.regexp_replace(bare, r"<[^>]*>", " "))


def absolute(url: Column, base: str) -> Column:
    return F.when(url.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), url).when(url.startswith("/"), F.concat(F.lit(base), url)).otherwise(F.concat(F.lit(base + "/"), url))


def identity_of(url: Column, base: str, source: str) -> Column:
    """struct<source, entity_type, source_entity_id, canonical_url>, null where the address names no entity."""
    whole = absolute(url, base)
    kind, key = (F.regexp_extract(whole, r"/ru/publics/(lot|buy|point|subject)/([^/?#]+)", i) for i in (1, 2))
    types = F.create_map(*[F.lit(x) for pair in PATH_TYPES.items() for x in pair])
    return F.when(key != "", F.struct(F.lit(source).alias("source"), F.try_element_at(types, kind).alias("entity_type"), key.alias("source_entity_id"), whole.alias("canonical_url")))


def discovered_items(parsed: DataFrame, entity_type: str, base: str, source: str, priority: int = 0, compat: bool = False) -> DataFrame:
    """Entities listed on list pages, each once per page, with a summary by header.

    The link's text is a business number only in a column whose header names an
    id; ``compat`` accepts headers that merely contain the letters.
    """
    word = next(k for k, v in PATH_TYPES.items() if v == entity_type)
    marker = "(?iu)номер|№|ид|id" if compat else r"(?iuU)номер|№|(^|\W)(ид|id)(\W|$)"
    rows = parsed.select("page_id", F.posexplode("tables").alias("t", "table")).where("table.in_grid").select("page_id", "t", "table.headers", F.posexplode("table.rows").alias("r", "row"))
    link = F.try_element_at(F.filter("row.links", lambda x: F.contains(x["href"], F.lit(f"/ru/publics/{word}/"))), F.lit(1))
    rows = rows.withColumn("link", link).where("link is not null").withColumn("identity", identity_of(F.col("link.href"), base, source)).where("identity is not null")
    header = F.coalesce(F.try_element_at("headers", F.col("link.cell") + 1), F.lit(""))
    # a header that is blank or used before gives way to the position
    names = F.transform("row.cells", lambda _, i: F.coalesce(F.nullif(F.get("headers", i), F.lit("")), i.cast("string")))
    unique = F.transform(names, lambda n, i: F.when(F.array_position(names, n) == i + 1, n).otherwise(i.cast("string")))
    first = Window.partitionBy("page_id", "identity.entity_type", "identity.source_entity_id").orderBy("t", "r")
    rows = rows.withColumn("at", F.row_number().over(first)).where("at = 1")
    return rows.select("page_id", "identity.*", F.when(header.rlike(marker), F.col("link.text")).alias("business_number"), F.lit(priority).alias("priority"), F.lit(True).alias("refresh_existing"), F.map_from_arrays(unique, "row.cells").alias("summary"))


def page_links(parsed: DataFrame, self_identity: DataFrame, base: str, source: str) -> DataFrame:
    """Entities linked from detail pages, each once, the page's own excluded, with the edge's label where there is one.

    self_identity: page_id, entity_type, source_entity_id.
    """
    links = parsed.select("page_id", F.posexplode("links").alias("at", "link")).withColumn("child", identity_of(F.col("link.href"), base, source)).where("child is not null")
    # dealt by the page once, for the grouping and the join
    links = links.repartition("page_id").groupBy("page_id", F.col("child.entity_type").alias("child_type"), F.col("child.source_entity_id").alias("child_id")).agg(F.min_by("link.text", "at").alias("business_number"), F.min_by("child.canonical_url", "at").alias("canonical_url"))
    # Spark takes parsed pages for as small as their rows without the lists in them and would send all links through the driver
    own = self_identity.withColumnsRenamed({"entity_type": "parent_type", "source_entity_id": "parent_id"}).hint("merge")
    out = links.join(own, "page_id").where("child_type <> parent_type or child_id <> parent_id")
    labels = F.create_map(*[F.lit(x) for pair in EDGE_TYPES.items() for x in pair])
    return out.withColumn("relation_type", F.try_element_at(labels, F.concat_ws(">", "parent_type", "child_type"))).withColumn("priority", F.lit(10))


def cost_fields(line: Column) -> Column:
    """'price CUR x quantity unit = total CUR' as struct<unit_price, quantity, unit, total_amount, currency>."""
    pattern = r"(?U)([\d\s,.]+)\s*([A-Z]{3})\s*x\s*([\d\s,.]+)\s+(.+?)\s*=\s*([\d\s,.]+)\s*([A-Z]{3})"
    # the groups of the first match at once; the unit is last, as only it can hold the separator
    groups = F.split(F.regexp_replace(line, rf"\A[\s\S]*?{pattern}[\s\S]*\z", "$1\x1f$2\x1f$3\x1f$5\x1f$4"), "\x1f", 5)

    def read(g: Column) -> Column:
        return F.struct(scalars.parse_decimal(g[0]).alias("unit_price"), scalars.parse_decimal(g[2]).alias("quantity"), F.nullif(F.trim(g[4]), F.lit("")).alias("unit"), scalars.parse_decimal(g[3]).alias("total_amount"), g[1].alias("currency"))

    return F.when(line.rlike(pattern), scalars.bound(groups, read))


def prepayment_percent(line: Column) -> Column:
    return scalars.parse_decimal(F.regexp_extract(line, r"(?U)x\s*([\d,.]+)%", 1), "decimal(8,3)")


def incoterms(address: Column) -> Column:
    return F.nullif(F.regexp_extract(address, r"^([A-Z]{3})\s+", 1), F.lit(""))


def _section(parsed: DataFrame, heading: str) -> DataFrame:
    """page_id, row_id, by (header -> cell), links of the tables under a heading."""
    tables = parsed.select("page_id", F.explode("tables").alias("t")).where(F.col("t.heading") == heading)
    rows = tables.select("page_id", "t.headers", F.explode("t.rows").alias("row"))
    cells = F.filter(F.arrays_zip(F.col("headers").alias("k"), F.col("row.cells").alias("v")), lambda x: F.coalesce(x["k"], F.lit("")) != "")
    pairs = F.map_from_entries(F.filter(cells, lambda x, i: F.array_position(F.transform(cells, lambda y: y["k"]), x["k"]) == i + 1))
    return rows.select("page_id", F.col("row.row_id").alias("row_id"), pairs.alias("by"), F.col("row.links").alias("links"))


def delivery_places(parsed: DataFrame) -> DataFrame:
    get = lambda k: F.try_element_at("by", F.lit(k))
    return _section(parsed, PLACES).select("page_id", F.col("row_id").alias("source_row_id"), get(COUNTRY).alias("country"), get(PLACE).alias("address"), scalars.parse_decimal(get(QUANTITY)).alias("quantity"), incoterms(get(PLACE)).alias("incoterms"), F.to_json("by").alias("source_payload"))


def page_documents(parsed: DataFrame, base: str) -> DataFrame:
    get = lambda k: F.try_element_at("by", F.lit(k))
    link = F.try_element_at(F.filter("links", lambda x: x["title"] == DOWNLOAD), F.lit(1))["href"]
    return _section(parsed, DOCUMENTS).select(
        "page_id",
        F.col("row_id").alias("source_document_id"),
        get(CATEGORY).alias("category"),
        get(FILE).alias("filename"),
        scalars.file_extension(get(FILE)).alias("extension"),
        absolute(link, base).alias("url"),
        scalars.parse_size(get(SIZE)).alias("size_bytes"),
        scalars.parse_portal_time(get(UPLOADED)).alias("uploaded_at"),
        get(FILE_HASH).alias("document_hash"),
        scalars.mime_type(get(FILE)).alias("inferred_content_type"),
        F.to_json("by").alias("source_payload"),
    )


def detail_entities(parsed: DataFrame, identities: DataFrame, base: str, source: str) -> DataFrame:
    """One row per detail page: identity, all scalar fields, customer and organizer ids, content hash without the view count."""
    p = parsed.join(identities, "page_id")
    get = lambda k: F.try_element_at("fields", F.lit(k))
    related = lambda k: identity_of(F.try_element_at("field_links", F.lit(k)), base, source)["source_entity_id"]
    number = F.when(~F.coalesce(F.endswith("heading", F.concat(F.lit(": "), "business_number")), F.lit(False)), F.col("business_number"))
    cost = cost_fields(get(COST))
    columns = {k: get(v) for k, v in FIELDS.items()} | {
        "business_number": number,
        "title_ru": F.coalesce(get(FIELDS["title_ru"]), F.col("heading")),
        "procurement_year": F.when(get(YEAR).rlike(r"^\d+$"), get(YEAR)).try_cast("int"),
        "unit_price": cost["unit_price"],
        "quantity": cost["quantity"],
        "unit": cost["unit"],
        "total_amount": cost["total_amount"],
        "currency": cost["currency"],
        "application_start_at": scalars.parse_portal_time(get(STARTS)),
        "application_end_at": scalars.parse_portal_time(get(ENDS)),
        "prepayment_percent": prepayment_percent(get(ADVANCE)),
        "payment_raw_text": get(ADVANCE),
        "customer_id": related(CUSTOMER),
        "organizer_id": related(ORGANIZER),
        "views": F.regexp_extract("stats", r"(\d+)", 1).try_cast("int"),
        "source_payload": scalars.canonical_json(F.col("fields")),
    }
    out = p.select("page_id", "entity_type", "source_entity_id", *[v.alias(k) for k, v in columns.items()])
    volatile = {"page_id", "views"}
    return out.withColumn("content_hash", scalars.content_hash(*[F.col(c) for c in sorted(out.columns) if c not in volatile]))


def catalogue_total(text: Column) -> Column:
    """Total of '... из N' or '... of N' with grouped digits."""
    digits = F.regexp_extract(text, r"(?iuU)(?:из|of)\s+(\d[\d\s ]*)", 1)
    return F.regexp_replace(digits, r"(?U)\D", "").try_cast("long")
