import datetime as dt
import hashlib
import json
import random
from decimal import Decimal

from pyspark.sql import functions as F

from tenderlake.operators import html_pages as B
from tenderlake.operators import json_docs as C

BASE = "https://portal.example"

LIST = """<div class="grid-view"><table><thead><tr><th>№ лота</th><th>Наименование</th><th>Вид</th></tr></thead><tbody>
<tr><td><a href="/ru/publics/lot/11?x=1">L-11</a></td><td>Бумага&nbsp;А4</td><td>товар</td></tr>
<tr><td><a href="/ru/publics/lot/11">L-11</a></td><td>повтор</td><td>x</td></tr>
<tr><td>нет ссылки</td><td>y</td><td>z</td></tr>
<tr><td><a href="/ru/publics/lot/12">L-12</a></td><td>Стол</td><td></td></tr></tbody></table><p>Показано 1-3 из 1 234 записей</p></div>"""

BY_KIND = """<div class="grid-view"><table><thead><tr><th>Номер</th><th>Вид</th></tr></thead><tbody><tr><td>5</td><td><a href="/ru/publics/buy/7">Тендер</a></td></tr></tbody></table></div>"""

DETAIL = """<html><head><title>t</title><script>var x = "<td>no</td>";</script></head><body><h1 class="page-title">Лот: 777</h1><div class="stats">Просмотров: 42</div>
<table class="detail-view"><tr><th>Статус</th><td>Опубликован<script>bad()</script></td></tr><tr><th>Статус</th><td>второй</td></tr><tr><th>Пусто</th><td> </td></tr>
<tr><th>Год</th><td>2026</td><tr><th>Расчет полной стоимости</th><td>1&nbsp;250,40 KZT x 12 Комплект = 15 004,80 KZT</td></tr>
<tr><th>Расчет авансового платежа</th><td>15 004,80 x 12,5% = 1 KZT</td></tr><tr><th>Дата начала приема заявок</th><td>2026-03-04 18:30:00</td></tr>
<tr><th>Заказчик</th><td><a href="/ru/publics/subject/5">ТОО</a></td></tr></table>
<h3>Места поставки</h3><div class="grid-view"><table><thead><tr><th>Страна</th><th>Место поставки</th><th>Количество</th></tr></thead><tbody><tr data-key="1"><td>KZ</td><td>DDP г. Город</td><td>12</td></tr></tbody></table></div>
<h3>Документы</h3><div class="grid-view"><table><thead><tr><th>Наименование документа</th><th>Размер</th><th>Дата загрузки</th><th></th></tr></thead><tbody>
<tr data-key="d1"><td>План.PDF</td><td>20,5 КБ</td><td>4 мар. 2026 г., 08:05:06</td><td><a title="Скачать" href="/f/1">x</a></td></tr></tbody></table></div>
<a href="/ru/publics/buy/9">notice</a><a href="/ru/publics/lot/77">self</a><a href="/ru/publics/point/3">plan</a></body></html>"""


def pages(spark, *html):
    return B.parse_pages(spark.createDataFrame(list(enumerate(html)), "page_id long, html string"))


def test_list_page(spark):
    rows = B.discovered_items(pages(spark, LIST, BY_KIND, None), "lot", BASE, "portal_a", 5).orderBy("source_entity_id").collect()
    assert [(r.source_entity_id, r.business_number, r.priority, r.canonical_url) for r in rows] == [("11", "L-11", 5, f"{BASE}/ru/publics/lot/11?x=1"), ("12", "L-12", 5, f"{BASE}/ru/publics/lot/12")]
    assert rows[0].summary == {"№ лота": "L-11", "Наименование": "Бумага А4", "Вид": "товар"}
    parsed = pages(spark, BY_KIND)
    strict, compat = (B.discovered_items(parsed, "notice", BASE, "portal_a", compat=c).first() for c in (False, True))
    assert (strict.business_number, compat.business_number) == (None, "Тендер")
    assert pages(spark, LIST).select(B.catalogue_total(F.col("text"))).first()[0] == 1234


def test_detail_page(spark):
    parsed = pages(spark, DETAIL).cache()
    known = spark.createDataFrame([(0, "lot", "77", "777")], "page_id long, entity_type string, source_entity_id string, business_number string")
    r = B.detail_entities(parsed, known, BASE, "portal_a").first()
    assert (r.status, r.procurement_year, r.unit_price, r.quantity, r.unit, r.total_amount, r.currency) == ("Опубликован", 2026, Decimal("1250.40"), 12, "Комплект", Decimal("15004.80"), "KZT")
    assert (r.prepayment_percent, r.customer_id, r.organizer_id, r.views, r.title_ru, r.business_number) == (Decimal("12.5"), "5", None, 42, "Лот: 777", None)
    assert r.application_start_at == dt.datetime(2026, 3, 4, 13, 30)
    place = B.delivery_places(parsed).first()
    assert (place.source_row_id, place.country, place.address, place.quantity, place.incoterms) == ("1", "KZ", "DDP г. Город", 12, "DDP")
    doc = B.page_documents(parsed, BASE).first()
    assert (doc.filename, doc.extension, doc.size_bytes, doc.url, doc.uploaded_at, doc.inferred_content_type) == ("План.PDF", "pdf", 20992, f"{BASE}/f/1", dt.datetime(2026, 3, 4, 3, 5, 6), "application/pdf")
    links = {(x.child_type, x.child_id, x.relation_type) for x in B.page_links(parsed, known.drop("business_number"), BASE, "portal_a").collect()}
    assert links == {("organization", "5", None), ("notice", "9", None), ("plan_item", "3", None)}
    plan = known.withColumn("entity_type", F.lit("plan_item")).drop("business_number")
    assert {x.relation_type for x in B.page_links(parsed, plan, BASE, "portal_a").collect()} == {"plan_to_notice", "plan_to_lot", None}


def test_view_count_is_not_hashed(spark):
    known = spark.createDataFrame([(0, "lot", "77", "777"), (1, "lot", "77", "777"), (2, "lot", "77", "777")], "page_id long, entity_type string, source_entity_id string, business_number string")
    rows = B.detail_entities(pages(spark, DETAIL, DETAIL.replace("42", "43"), DETAIL.replace("2026", "2025")), known, BASE, "portal_a").collect()
    hashes = [r.content_hash for r in sorted(rows, key=lambda r: (r.procurement_year, r.views), reverse=True)]
    assert hashes[0] == hashes[1] != hashes[2]


LOT = {
    "id": 44, "advertId": 12, "lotNumber": "44-L", "nameRu": "Кабель", "status": "PUBLISHED", "beginDate": "2026-06-10T10:00:00", "endDate": "2026-06-20T10:50:00Z",
    "quantity": 0, "measureNameRu": {"nameRu": "метр"}, "unitPrice": "1 200,5", "totalSum": None, "sum": "", "extensionNumber": 105,
    "prepaymentPercent": 10, "paymentConditionList": [{"paymentType": "PREPAY", "value": 30}, {"paymentType": "FINAL_PAYMENT", "value": None}], "finalPaymentPercent": 70,
    "customer": {"id": 5, "bin": "123", "nameRu": "Заказчик", "legalAddress": {"countryRu": "KZ", "katoNameRu": " ", "street": "Абая"}}, "organizer": {"companyId": 5, "name": "Тот же"},
    "goodsAttributeList": [{"nameRu": "3x2.5", "attribute": {"ru": "Сечение"}}, {"name": "медь"}, {"nameRu": ""}],
    "schedule": {"count": 15, "dayType": {"nameRu": "Рабочие", "nameKk": "Жұмыс", "code": "WORKING"}},
    "timeHistory": [{"status": "DRAFT", "date": "2026-01-01T00:00:00Z"}, {"status": "PUBLISHED", "date": "bad"}, {"event": "Republished", "eventDate": "2026-06-09T08:00:00"}],
    "deliveryPlaces": [{"id": 1, "country": "KZ", "address": "Склад", "quantity": 3}],
    "nested": {"deep": [{"files": [{"uid": "u1", "fileName": "a.docx", "fileSize": 10}, {"uid": "u1", "fileName": "b.docx", "fileSize": 11}, {"fileName": "no proof"}]}]},
}


def test_json_detail(spark):
    docs = spark.createDataFrame([("k", json.dumps(LOT, ensure_ascii=False))], "key string, body string")
    r = C.detail_entities(docs, "body", "lot", BASE).first()
    assert (r.source_entity_id, r.business_number, r.title_ru, r.quantity, r.unit, r.unit_price, r.total_amount, r.currency) == ("44", "44-L", "Кабель", 0, "метр", Decimal("1200.5"), None, "KZT")
    assert (r.description_ru, r.contact_extension) == ("Сечение: 3x2.5; медь", "105")
    assert (r.application_start_at, r.application_end_at, r.published_at) == (dt.datetime(2026, 6, 10, 5), dt.datetime(2026, 6, 20, 10, 50), dt.datetime(2026, 6, 9, 3))
    assert (r.payment_terms.prepayment_percent, r.payment_terms.interim_percent, r.payment_terms.final_percent) == (30, None, None)
    assert r.delivery_terms_ru == "С даты подписания договора в течение 15 рабочих дней"
    assert r.delivery_terms_kk == "Шартқа қол қойылған күннен бастап 15 жұмыс күн ішінде"
    assert (r.customer.address, r.customer.bin, r.organizer.business_number) == ("KZ, Абая", "123", "5")
    assert [(p.source_row_id, p.address, p.quantity) for p in r.delivery_places] == [("1", "Склад", 3)]
    assert [o.name_ru for o in C.embedded_organizations(C.detail_entities(docs, "body", "lot", BASE)).collect()] == ["Заказчик"]
    edges = {tuple(x) for x in C.detail_relations(docs, "body", "lot", BASE).collect()}
    assert edges == {("customer", "44", "5"), ("organizer", "44", "5"), ("notice_to_lot", "12", "44")}
    files = C.documents(docs, "key", "body", BASE).collect()
    assert [(f.filename, f.size_bytes, f.url) for f in files] == [("a.docx", 10, f"{BASE}/eprocfilestorage/open-api/files/download/u1")]


def test_json_lists(spark):
    bodies = ['{"data":{"content":[{"id":1},{"x":2}],"totalElements":"7"}}', '[{"id":3}, 5]', '{"items":[]}', "not json", None, '{"results":{"items":{"data":[{"lotId":9}]}}}']
    docs = spark.createDataFrame(list(enumerate(bodies)), "page int, body string")
    rows = C.discovered_items(docs, "body", "lot", BASE).collect()
    assert sorted((r.page, r.source_entity_id) for r in rows) == [(0, "1"), (1, "3"), (5, "9")]
    assert docs.select(C.list_total(F.col("body"))).first()[0] == 7
    deep = ['{"data":{"results":{"result":{"items":{"content":[{"id":8}]}}}}}', '{"content":{"items":[]},"data":[{"id":2}]}', '{"total":5,"totalCount":7}', '{"x":{"y":{"z":{"total":"12"}}},"list":[{"total":1}]}', '{"totalElements":"many","total":3}']
    more = spark.createDataFrame(list(enumerate(deep)), "page int, body string")
    assert sorted((r.page, r.source_entity_id) for r in C.discovered_items(more, "body", "lot", BASE).collect()) == [(0, "8"), (1, "2")]
    assert [r[0] for r in more.orderBy("page").select(C.list_total(F.col("body"))).collect()] == [None, None, 7, 12, 3]
    assert docs.where("page = 1").select(C.wrap(F.col("body"))).first()[0] == '{"data":[{"id":3}, 5]}'


def test_schedule_forms(spark):
    forms = [{"schedule": {"monthFrom": "май", "monthTo": "июнь"}}, {"schedule": {"monthTo": "июнь"}}, {"deliveryTermsRu": "сразу", "schedule": {"count": 1}}, {"schedule": {"count": 0}}, {"schedule": 5}, {}]
    docs = spark.createDataFrame([(json.dumps(f, ensure_ascii=False),) for f in forms], "body string")
    got = [r[0] for r in docs.select(C.delivery_schedule(F.col("body"), "ru")).collect()]
    assert got == ["С май по июнь", "С даты подписания договора по (включительно) июнь", "сразу", "С даты подписания договора в течение 0 дней", None, None]


def test_flat_delivery_place(spark):
    docs = spark.createDataFrame([('{"deliveryLocationRu":"Город","count":"2,5"}',), ("{}",)], "body string")
    got = [r[0] for r in docs.select(C.delivery_places(F.col("body"))).collect()]
    assert [(p.address, p.quantity) for p in got[0]] == [("Город", Decimal("2.5"))] and got[1] == []


def test_lot_list_completeness(spark):
    rows = [("a", 1, "x", 2), ("a", 2, "y", 2), ("b", 1, "x", 4), ("b", 2, "x", 4), ("c", 1, "x", 3), ("d", 1, None, None)]
    pages_ = spark.createDataFrame(rows, "notice string, page int, lot string, total int")
    got = {r.notice: r.status for r in C.lot_completeness(pages_, "notice", "lot", "page", "total").collect()}
    assert got == {"a": "ok", "b": "repeated_page", "c": "short", "d": "unknown"}


def test_plain_markup_is_read_as_the_standard_parser_reads_it():
    """Without the standard parser for the pages of the portal, and with the same results on odd ones."""

    def standard(page):
        p = B._Page()
        p.feed(page)
        p.close()
        return p.result()

    for page in (LIST, BY_KIND, DETAIL):
        assert B._Page().plain(page) and B.parse_html(page) == standard(page)
    bits = ["<td>", "</td>", "<tr>", "</TR>", '<table class="detail-view">', "</table>", "<th>", "<a href='/x?a=1&amp;b=2&copy=3'>", "</a>", "<script>", "</script>", "</p>", "<style>", "</style >", "a & b &amp", "<!-- c -->", "<!--->", "<!-- a--b -->"]
    bits += ["<!DOCTYPE html>", "<br/>", "<p class=stats>", '<p class="stats x">', "<h3>", "</h3>", "<", "</", "<a/>", '<script src="x"/>', 'x = "</p>";', "</ p>", "<?pi?>", "<title>", "</title>", '<a title="t>u">', "\xa0"]
    rng = random.Random(3)
    for _ in range(5000):
        page = "".join(rng.choice(bits) for _ in range(rng.randrange(25)))
        assert B.parse_html(page) == standard(page), page


def test_sql_of_pages_reads_character_references_alike():
    """Names with and without a semicolon, longest names, numbers of any size, and what is none."""
    import duckdb

    from tenderlake.plans.raw_queries import SQL

    refs = ["a &amp", "&ampx", "&amp;lt;", "&notin; &notit; &not", "&quot;q&quot;", "&#65;&#x41 &#X1F600;", "&#0;&#128;&#xD800;&#1114112;&#99999999999;&#1;", "&", "&&", "& x", "&;", "&unknown;", "&copy2", "x&nbsp;&nbsp", "&#;&#x;", "&ltimes;", "&#000065;", "it's", ""]
    pages = [(i, f"<html><head><title>{r}</title></head><body><p>b {r}</p></body></html>") for i, r in enumerate(refs)] + [(len(refs), "<p>no title</p>")]
    db = duckdb.connect()
    db.execute("CREATE TABLE pages (page_id BIGINT, html VARCHAR)")
    db.executemany("INSERT INTO pages VALUES (?, ?)", pages)
    own = {i: B.parse_html(page) for i, page in pages}
    assert dict(db.execute(SQL["b3_page_heads"]).fetchall()) == {i: p["title"] for i, p in own.items()}
    hashes = {i: (len(p["text"]), hashlib.sha256(p["text"].encode()).hexdigest()) for i, p in own.items()}
    assert {i: (n, h) for i, n, h in db.execute(SQL["b1_visible_text"]).fetchall()} == hashes


def test_cost_lines_are_matched_once_for_all_groups(spark):
    lines = ["x 5 KZT x 2.5 a\x1fb = 3,0 USD = 1 EUR z", "a\n1.234,5 KZT x 1,234.56 шт. = 2 KZT tail 3 KZT x 4 u = 5 KZT", "$1 5KZTx 1 $2 \\ = 2KZT", "5 KZT x 1 a\nb = 2 KZT", None]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, line string").select("i", B.cost_fields(F.col("line")).alias("c"))
    got = {r.i: r.c and (*map(float, (r.c.unit_price, r.c.quantity, r.c.total_amount)), r.c.unit, r.c.currency) for r in rows.collect()}
    assert got == {0: (5.0, 2.5, 3.0, "a\x1fb", "KZT"), 1: (1234.5, 1.23456, 2.0, "шт.", "KZT"), 2: (15.0, 1.0, 2.0, "$2 \\", "KZT"), 3: None, 4: None}
    plan = rows.select("i", "c.*")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("[A-Z]{3}") <= 4  # twice in a pattern: whether it matches, and its groups
