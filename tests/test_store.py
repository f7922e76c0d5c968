"""The store and the ingest of tasks: atomic batches, other writers, rejects, buckets, logs, schemas, replays, exports."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tenderlake.operators import extraction as X
from tenderlake.sources import csv_export, landing
from tenderlake.sources.versions import Conflict, Store, Transaction
from tenderlake.streaming import ingest as K
from tenderlake.streaming import tasks as T

BASE = "https://portal.example"
HTML, JSON = "portal_a", "portal_b"


def at(day, hour=0):
    return dt.datetime(2026, 1, day, hour)


def raw(spark, rows):
    """(source, type, id, day, body) as raw records."""
    return spark.createDataFrame([(s, t, i, f"{BASE}/{t}/{i}", at(d), 200, b) for s, t, i, d, b in rows], landing.RAW)


def page(name, status="Опубликован", places=1, links="", files="план.pdf"):
    rows = "".join(f'<tr data-key="{k}"><td>KZ</td><td>DDP Город {k}</td><td>{k}</td></tr>' for k in range(1, places + 1))
    return f"""<h1 class="page-title">{name}</h1><table class="detail-view"><tr><th>Статус</th><td>{status}</td></tr>
<tr><th>Расчет полной стоимости</th><td>10,50 KZT x 2 шт = 21,00 KZT</td></tr><tr><th>Расчет авансового платежа</th><td>21 x 30% = 6 KZT</td></tr>
<tr><th>Заказчик</th><td><a href="/ru/publics/subject/5">ТОО</a></td></tr></table>
<h3>Места поставки</h3><div class="grid-view"><table><thead><tr><th>Страна</th><th>Место поставки</th><th>Количество</th></tr></thead><tbody>{rows}</tbody></table></div>
<h3>Документы</h3><div class="grid-view"><table><thead><tr><th>Наименование документа</th><th>Размер</th></tr></thead><tbody><tr data-key="d1"><td>{files}</td><td>20 КБ</td></tr></tbody></table></div>{links}"""


SUBJECT = '<h1 class="page-title">ТОО Ромашка</h1><table class="detail-view"><tr><th>БИН</th><td>123</td></tr></table>'


def document(key, **more):
    return json.dumps({"id": key, "nameRu": f"Лот {key}", "status": "PUBLISHED", "advertId": 900, "sum": "12345678901234567.891234", "customer": {"id": 7, "bin": "77", "nameRu": "Заказчик"}, "deliveryPlaces": [{"id": 1, "address": "Склад"}], "prepaymentPercent": 10, "files": [{"uid": "u1", "fileName": "a.docx", "fileSize": 10}]} | more, ensure_ascii=False)


def parse(records):
    return X.html_batch(records, BASE, HTML).union(X.json_batch(records, BASE, JSON))


def keys(rows):
    return sorted((r.source, r.entity_type, r.source_entity_id) for r in rows.collect())


@pytest.fixture
def store(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    T.define_tables(store, 8)
    return store


def test_raw_records_to_eight_exports(spark, store, tmp_path):
    lot = '<a href="/ru/publics/lot/11">Л-11</a>'
    first = raw(spark, [(HTML, "notice", "9", 1, page("Закупка 9", links=lot)), (HTML, "lot", "11", 1, page("Лот 11", places=2)), (HTML, "plan_item", "3", 1, page("План", links=lot + '<a href="/ru/publics/buy/9">x</a>')), (HTML, "organization", "5", 1, SUBJECT), (JSON, "lot", "44", 1, document(44)), (JSON, "notice", "900", 1, document(900, advertId=None, customer=None))])
    T.merge_tasks(store, parse(first), "s", 0)
    again = raw(spark, [(HTML, "lot", "11", 2, page("Лот 11", "Завершен")), (JSON, "lot", "44", 2, document(44))])
    for _ in range(2):  # a batch that comes again changes nothing
        T.merge_tasks(store, parse(again), "s", 1)
    got = {n: rows.collect() for n, rows in T.datasets(store).items()}
    assert {r.source_entity_id: (r.status, r.total_amount, r.updated_at) for r in got["lots"]} == {"11": ("Завершен", Decimal("21.00"), at(2)), "44": ("PUBLISHED", Decimal("12345678901234567.891234"), at(1))}
    assert sorted(r.source_entity_id for r in got["notices"]) == ["9", "900"] and [r.source_entity_id for r in got["plan_items"]] == ["3"]
    assert sorted((r.source, r.source_entity_id, r.name_ru, r.bin) for r in got["organizations"]) == [(HTML, "5", "ТОО Ромашка", "123"), (JSON, "7", "Заказчик", "77")]
    edges = {(r.relation_type, r.parent_type, r.parent_id, r.child_type, r.child_id) for r in got["relations"]}
    assert edges == {("notice_to_lot", "notice", "9", "lot", "11"), ("plan_to_lot", "plan_item", "3", "lot", "11"), ("plan_to_notice", "plan_item", "3", "notice", "9"), ("notice_to_lot", "notice", "900", "lot", "44"), ("customer", "lot", "44", "organization", "7"), *[("customer", t, i, "organization", "5") for t, i in [("notice", "9"), ("lot", "11"), ("plan_item", "3")]]}
    # the second page of lot 11 has one place: its children were replaced, all others' kept
    assert sorted((r.source_entity_id, r.source_row_id) for r in got["delivery_places"]) == [("11", "1"), ("3", "1"), ("44", "1"), ("9", "1"), ("900", "1")]
    assert {(r.source_entity_id, r.prepayment_percent) for r in got["payment_terms"]} == {("11", 30), ("3", 30), ("9", 30), ("44", 10), ("900", 10)}
    assert {(r.source_entity_id, r.filename) for r in got["documents"]} == {("11", "план.pdf"), ("3", "план.pdf"), ("9", "план.pdf"), ("44", "a.docx"), ("900", "a.docx")}
    assert [(r.source_entity_id, json.loads(r.payload)["status"], r.at) for r in store.read("revisions").collect()] == [("11", "Опубликован", at(2))]
    registry = {(r.entity_type, r.source_entity_id): r for r in store.read("registry").collect()}
    assert registry["lot", "11"].business_number == "Л-11" and (registry["lot", "11"].first_seen_at, registry["lot", "11"].last_success_at) == (at(1), at(2)) and registry["lot", "44"].last_success_at == at(2)
    assert keys(store.read("worklist")) == [] and store.read("history").count() == 8  # all that was discovered is there
    manifest = csv_export.export(T.datasets(store), str(tmp_path / "out"), at="now")
    assert {m["file"]: m["rows"] for m in manifest} == {"lots.csv": 2, "notices.csv": 2, "plan_items.csv": 1, "organizations.csv": 2, "relations.csv": 8, "delivery_places.csv": 5, "payment_terms.csv": 5, "documents.csv": 5}


def test_one_bad_task_of_three(spark, store):
    rows = [(HTML, "lot", "1", 1, page("a", links='<a href="/ru/publics/buy/9">x</a>')), (HTML, "lot", "2", 1, "<p>nothing</p>"), (JSON, "lot", "3", 1, document(4)), (JSON, "lot", "5", 1, document(5))]
    T.merge_tasks(store, parse(raw(spark, rows)), "s", 0)
    assert [r.source_entity_id for r in store.read("procurements").orderBy("source_entity_id").collect()] == ["1", "5"]
    assert {(r.source_entity_id, r.reason, r.batch_id) for r in store.read("rejects").collect()} == {("2", "payload", 0), ("3", "primary", 0)}
    assert {(r.source_entity_id, r.outcome) for r in store.read("history").collect()} == {("1", "success"), ("5", "success"), ("2", "retry"), ("3", "retry")}
    waiting = {(r.source, r.entity_type, r.source_entity_id): (r.attempt, r.available_at > at(1)) for r in store.read("worklist").collect()}
    assert waiting == {(HTML, "lot", "2"): (1, True), (JSON, "lot", "3"): (1, True), (HTML, "notice", "9"): (0, False), (HTML, "organization", "5"): (0, False), (JSON, "notice", "900"): (0, False)}
    T.merge_tasks(store, parse(raw(spark, [(HTML, "lot", "2", 2, page("b")), (JSON, "lot", "3", 2, document(4))])), "s", 1)
    waiting = {r.source_entity_id: r.attempt for r in store.read("worklist").collect()}
    assert waiting == {"3": 2, "9": 0, "5": 0, "900": 0} and store.read("rejects").count() == 3


def test_reasons(spark):
    own, other, foreign = ("a", "lot", "1"), ("a", "lot", "2"), ("b", "lot", "1")
    cases = [([own], [], [], "p", None), ([other], [], [], "p", "primary"), ([own, own], [], [], "p", "primary"), ([own, other, other], [], [], "p", "duplicate"), ([own, foreign], [], [], "p", "source"), ([own], [(own, foreign)], [], "p", "source"), ([own], [], [foreign], "p", "source"), ([own], [], [], " {} ", "payload"), ([own], [], [], None, "payload"), ([own], [(own, ("a", " ", "3"))], [], "p", "key"), ([], [], [], "p", "primary")]
    frames = {
        "tasks": spark.createDataFrame([(i, *own, at(1)) for i in range(len(cases))], f"task bigint, {X.FRAMES['tasks']}"),
        "procurements": spark.createDataFrame([(i, *k, p) for i, (e, _, _, p, _) in enumerate(cases) for k in e], f"task bigint, {X.KEYS}, source_payload string"),
        "relations": spark.createDataFrame([(i, "organizer", *p, *c, "{}", at(1)) for i, (_, r, _, _, _) in enumerate(cases) for p, c in r], f"task bigint, {X.FRAMES['relations']}"),
        "discovered": spark.createDataFrame([(i, *k) for i, (_, _, d, _, _) in enumerate(cases) for k in d], f"task bigint, {X.KEYS}"),
    }
    assert {r.task: r.reason for r in T.judged(X.Batch(frames)).collect()} == {i: c[-1] for i, c in enumerate(cases)}


def meanwhile(monkeypatch, act):
    """Run ``act`` once, just before the next transaction is published."""
    publish, done = Transaction.publish, []

    def late(self, *a, **b):
        if not done:
            done.append(1)
            act()
        return publish(self, *a, **b)

    monkeypatch.setattr(Transaction, "publish", late)


def lots(spark, *rows, edges=()):
    """Good tasks for lots, as (id, day, status)."""
    frames = {
        "tasks": spark.createDataFrame([(int(k) * 100 + d, JSON, "lot", k, at(d)) for k, d, _ in rows], f"task bigint, {X.FRAMES['tasks']}"),
        "procurements": spark.createDataFrame([(int(k) * 100 + d, JSON, "lot", k, s, "p", s, at(d)) for k, d, s in rows], f"task bigint, {X.KEYS}, status string, source_payload string, content_hash string, fetched_at timestamp"),
        "discovered": spark.createDataFrame([(int(k) * 100 + d, JSON, "notice", n, 1, at(d), False, "{}") for k, d, n in edges], f"task bigint, {X.KEYS}, priority int, available_at timestamp, refresh_existing boolean, payload string"),
    }
    return X.Batch(frames)


def test_interleaved_streams_lose_nothing(spark, store, tmp_path, monkeypatch):
    T.merge_tasks(store, lots(spark, ("1", 1, "x"), ("3", 1, "x")), "s", 0)
    meanwhile(monkeypatch, lambda: T.merge_tasks(Store(spark, store.folder), lots(spark, ("2", 2, "x"), ("3", 3, "later")), "other", 0))
    T.merge_tasks(store, lots(spark, ("3", 2, "before")), "s", 1)  # both write the same bucket: computed again
    assert {r.source_entity_id for r in store.read("procurements").collect()} == {"1", "2", "3"}
    assert store.read("history").count() == 5 and store.pointer()["batches"] == {"s": 1, "other": 0}
    assert sorted(json.loads(r.payload)["status"] for r in store.read("revisions").collect()) == ["later", "x"]
    # the strict form of one table as well
    old = Store(spark, str(tmp_path / "whole"))
    rows = lambda key: spark.createDataFrame([("a", "lot", key, "p", "h", at(1))], "source string, entity_type string, source_entity_id string, payload string, content_hash string, fetched_at timestamp")
    none = spark.createDataFrame([], f"{X.EDGE}, at timestamp")
    K.merge_batch(old, rows("1"), none, "s", 0)
    meanwhile(monkeypatch, lambda: K.merge_batch(Store(spark, old.folder), rows("2"), none, "other", 0))
    K.merge_batch(old, rows("3"), none, "s", 1)
    assert sorted(r.source_entity_id for r in old.read("entities", K.ENTITIES).collect()) == ["1", "2", "3"]
    pinned = old.pointer()
    K.merge_batch(old, rows("4"), none, "s", 2)
    with pytest.raises(Conflict):
        old.commit({"entities": old.read("entities", K.ENTITIES, pinned)}, pinned=pinned)


def test_a_refresh_keeps_work_queued_meanwhile(spark, store, monkeypatch):
    T.merge_tasks(store, lots(spark, ("1", 1, "x")), "s", 0)
    found = lots(spark, ("2", 2, "x"), edges=[("2", 2, "900")])
    meanwhile(monkeypatch, lambda: T.merge_tasks(Store(spark, store.folder), found, "other", 0))
    K.refresh(store, {"all": {"older_seconds": 0, "newer_seconds": 0, "limit": 10, "priority": 3}}, "2026-02-01 00:00:00", "refresh", 0, "procurements")
    assert {r.source_entity_id for r in store.read("worklist").collect()} >= {"1", "900"}


def test_a_batch_rewrites_the_buckets_of_its_keys(spark, store):
    T.merge_tasks(store, lots(spark, *[(str(i), 1, "x") for i in range(60)]), "s", 0)
    before = store.pointer()["tables"]
    assert len(before["procurements"]["folders"]) == 8
    T.merge_tasks(store, lots(spark, ("7", 2, "new")), "s", 1)
    after = store.pointer()["tables"]
    for name in T.TABLES:
        old, new = ({f["bucket"]: f["path"] for f in t[name]["folders"]} for t in (before, after))
        assert sum(old.get(b) != new.get(b) for b in old.keys() | new.keys()) <= 1, name
    changed = [f for f in after["procurements"]["folders"] if f not in before["procurements"]["folders"]]
    assert len(changed) == 1 and store.read("procurements").count() == 60
    assert {r.status for r in store.read("procurements", buckets=[changed[0]["bucket"]]).where("source_entity_id = '7'").collect()} == {"new"}


def test_a_replay_twice_makes_one_version(spark, store, tmp_path):
    lines = [{"source": JSON, "source_entity_id": str(i % 5), "title_ru": f"t{i}", "status": "s", "source_payload": {"n": i}, "content_hash": f"h{i}", "fetched_at": f"2026-01-{1 + i:02d}T00:00:00Z"} for i in range(10)]
    (tmp_path / "r.jsonl").write_text("\n".join(map(json.dumps, lines)))
    for version in range(2):
        assert T.replay_into(store, landing.replay_records(spark, str(tmp_path / "r.jsonl"))) == 10
        assert store.pointer()["version"] == len(T.TABLES) + 1
    assert {(r.source_entity_id, r.title_ru, r.updated_at.day) for r in store.read("procurements").collect()} == {(str(i), f"t{i + 5}", 6 + i) for i in range(5)}
    lines[9] |= {"content_hash": "h9b", "fetched_at": "2026-01-20T00:00:00Z", "title_ru": "new"}
    lines[3] |= {"content_hash": "h3b", "fetched_at": "2026-01-02T00:00:00Z"}  # older than what is there
    (tmp_path / "r.jsonl").write_text("\n".join(map(json.dumps, [lines[9], lines[3]])))
    before = {f["bucket"]: f["path"] for f in store.pointer()["tables"]["procurements"]["folders"]}
    assert T.replay_into(store, landing.replay_records(spark, str(tmp_path / "r.jsonl"))) == 2
    after = {f["bucket"]: f["path"] for f in store.pointer()["tables"]["procurements"]["folders"]}
    assert sum(before[b] != after[b] for b in before) == 1
    assert {r.source_entity_id: r.title_ru for r in store.read("procurements").collect()} == {"0": "t5", "1": "t6", "2": "t7", "3": "t8", "4": "new"}
    assert [r.content_hash for r in store.read("revisions").collect()] == ["h9"]


def test_logs_are_compacted_and_pruned_by_day(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    for day in (1, 2, 1, None):
        store.commit({}, appended={"log": spark.createDataFrame([(day or 0, at(day) if day else None), (9, at(3))], "n int, at timestamp")})
    rows = sorted(map(tuple, store.read("log").collect()), key=str)
    assert store.compact("log", "at") == 4
    folders = store.pointer()["tables"]["log"]["folders"]
    assert sorted((f["day"], f["rows"]) for f in folders) == [("", 1), ("2026-01-01", 2), ("2026-01-02", 1), ("2026-01-03", 4)]
    assert sorted(map(tuple, store.read("log").collect()), key=str) == rows
    store.commit({}, appended={"log": spark.createDataFrame([(5, at(5))], "n int, at timestamp")})
    assert store.compact("log", "at", least=2) == 0 and store.compact("log", "at", least=1) == 1  # days that are whole already are not written again
    assert store.prune("log", "2026-01-03") == 3 and store.prune("log", "2026-01-03") == 0
    assert sorted(r.n for r in store.read("log").collect()) == [0, 5, 9, 9, 9, 9]
    assert store.vacuum(1) > 0 and store.read("log").count() == 6


def test_vacuum_spares_running_writers(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "s"))
    store.commit({"t": spark.range(3)})
    store.commit({"t": spark.range(4)})
    gone = []
    meanwhile(monkeypatch, lambda: gone.append(Store(spark, store.folder).vacuum(1)))
    store.commit({"t": spark.range(5)})
    assert gone == [1] and store.read("t").count() == 5
    assert not [f for f in (tmp_path / "s").iterdir() if f.name.startswith(".writing")]
    assert store.vacuum(1) == 1


def test_schemas_widen_without_a_rewrite(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    store.define("t", "k string, n int, d decimal(8,2)", ["k"], 4)

    def put(key, **values):
        def build(tx):
            rows = spark.createDataFrame([(key, *values.values())], "k string, " + ", ".join(f"{c} {kinds[c]}" for c in values))
            buckets = tx.buckets("t", rows.select("k"))
            tx.write("t", tx.read("t", buckets).unionByName(rows, allowMissingColumns=True), buckets)

        store.transact(build)

    kinds = {"n": "int", "d": "decimal(8,2)"}
    put("a", n=1, d=Decimal("1.25"))
    folders = store.pointer()["tables"]["t"]["folders"]
    store.evolve("t", {"n": "bigint", "d": "decimal(20,4)", "note": "string"})
    assert store.pointer()["tables"]["t"]["folders"] == folders
    kinds = {"n": "bigint", "note": "string"}
    for key in "bcdef":
        put(key, n=1 << 40, note="x")
    assert dict(store.read("t").dtypes) == {"k": "string", "n": "bigint", "d": "decimal(20,4)", "note": "string"}
    rows = {r.k: (r.n, r.d, r.note) for r in store.read("t").collect()}
    assert rows["a"] == (1, Decimal("1.25"), None) and rows["f"] == (1 << 40, None, "x") and len(rows) == 6
    with pytest.raises(ValueError):
        store.evolve("t", {"n": "int"})
    with pytest.raises(ValueError):
        store.transact(lambda tx: tx.write("t", spark.createDataFrame([("zz", 1)], "k string, n bigint"), [(tx.buckets("t", spark.createDataFrame([("zz",)], "k string"))[0] + 1) % 4]))


def test_the_stream_takes_raw_records(spark, store, tmp_path):
    land = str(tmp_path / "land")
    raw(spark, [(HTML, "lot", "11", 1, page("Лот 11")), (HTML, "lot", "12", 1, "")]).write.parquet(land)
    for _ in range(2):
        K.ingest(landing.raw_records(spark, land, stream=True), parse, store, str(tmp_path / "check")).awaitTermination()
    assert keys(store.read("procurements")) == [(HTML, "lot", "11")] and store.read("rejects").count() == 1
    raw(spark, [(HTML, "lot", "12", 2, page("Лот 12"))]).write.mode("append").parquet(land)
    K.ingest(landing.raw_records(spark, land, stream=True), parse, store, str(tmp_path / "check")).awaitTermination()
    assert keys(store.read("procurements")) == [(HTML, "lot", "11"), (HTML, "lot", "12")] and store.read("worklist").where("entity_type = 'lot'").count() == 0


def test_rows_without_a_hash(spark):
    old = spark.createDataFrame([("a", "x", None, at(1), at(1)), ("b", "x", "h", at(1), at(1))], "k string, v string, content_hash string, last_success_at timestamp, updated_at timestamp")
    new = spark.createDataFrame([("a", "y", None, at(2), at(2)), ("b", "y", None, at(2), at(2)), ("c", "y", None, at(2), at(2))], old.schema)
    from tenderlake.operators import merge

    got = {r.k: (r.v, r.change) for r in merge.upsert_by_hash(old, new, ["k"]).collect()}
    assert got == {"a": ("x", "unchanged"), "b": ("y", "changed"), "c": ("y", "new")}
    assert [r.k for r in merge.revisions(old, new, ["k"], ["v"]).collect()] == ["b"]
    log = spark.createDataFrame([(1, None), (2, at(1)), (3, at(20))], "n int, at timestamp_ntz")
    kept, gone = merge.prune(log, "at", "2026-01-20 00:00:00", 5)
    assert sorted(r.n for r in kept.collect()) == [1, 3] and gone.first()[0] == 1
