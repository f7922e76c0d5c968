"""Exports, versioned merges and streams."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tenderlake.operators import forecast, merge
from tenderlake.sources import csv_export as X
from tenderlake.sources import landing
from tenderlake.sources.versions import Store
from tenderlake.streaming import ingest as K


def lots(spark, rows):
    rows = [(a, b, c, None if q is None else Decimal(q), d) for a, b, c, q, d in rows]
    return spark.createDataFrame(rows, "source string, source_entity_id string, title_ru string, quantity decimal(24,6), title_kk string")


def test_export_round_trip(spark, tmp_path):
    rows = lots(spark, [("portal_a", "1", "=SUM(A1)", None, "a\nb"), ("portal_b", "2", 'q"uote; x', 3, "-12.5"), ("portal_b", "3", "-1e3", 4, "")])
    out = X.export({"lots": rows, "relations": spark.createDataFrame([("portal_a", "notice", "9", "notice_to_lot", "portal_a", "lot", "1")], "parent_source string, parent_type string, parent_id string, relation_type string, child_source string, child_type string, child_id string")}, str(tmp_path), "both", ("portal_a", "portal_b"), ";")
    assert [(m["file"], m["rows"]) for m in out] == [("lots.csv", 3), ("lots_portal_a.csv", 1), ("lots_portal_b.csv", 2), ("relations.csv", 1), ("relations_portal_a.csv", 1), ("relations_portal_b.csv", 0)]
    assert (tmp_path / "lots.csv").read_bytes()[:3] == b"\xef\xbb\xbf"
    text = (tmp_path / "lots.csv").read_text("utf-8-sig")
    assert "'=SUM(A1)" in text and "'-1e3" in text and ";-12.5" in text and ";'-12.5" not in text
    assert text.splitlines()[0].split(";")[:3] == ["source", "source_entity_id", "business_number"]
    report = X.validate_export(spark, str(tmp_path))
    assert report["valid"], report
    assert report["files"][0]["rows"] == 3 and report["files"][0]["columns"] == 45


BROKEN = {
    "﻿source,source_entity_id\na,1\na,1\n": ["repeated_identity"],
    "source,source_entity_id\na,1\n": ["no_bom"],
    "﻿source,source_entity_id\na, \n": ["blank_identity"],
    "﻿source,source_entity_id\na,1,2\n": ["ragged_rows"],
    "﻿source,source_entity_id,t\na,1,�x\n": ["lost_characters"],
    "﻿source;source_entity_id;t\na;1;=1+1\n": ["formula_cells"],
    '﻿source,source_entity_id,t\na,1,"x\ny"\n': [],
}


@pytest.mark.parametrize("text", list(BROKEN))
def test_validation(spark, tmp_path, text):
    (tmp_path / "lots.csv").write_text(text, "utf-8")
    assert X.validate_file(spark, str(tmp_path / "lots.csv"), "lots")["errors"] == BROKEN[text]


def test_replay_source(spark, tmp_path):
    (tmp_path / "r.jsonl").write_text('{"source":"a","source_entity_id":"1","source_payload":{"x":1},"content_hash":"h","fetched_at":"2026-01-01T00:00:00Z"}\n{"source":"a","source_entity_id":"2","fetched_at":"soon"}\n')
    rows = landing.replay_records(spark, str(tmp_path / "r.jsonl")).collect()
    assert [(r.source_entity_id, r.source_payload, r.fetched_at) for r in rows] == [("1", '{"x":1}', dt.datetime(2026, 1, 1))]


def page_windows(spark, *pages):
    kinds = {"d": ("items", 1), "o": ("empty", 0), "x": ("failed", 0)}
    rows = [(w, p + i, *kinds[c]) for w, (p, s) in enumerate(pages) for i, c in enumerate(s)]
    return spark.createDataFrame(rows, "w int, page int, status string, n_items int")


def test_window_classifier(spark):
    rows = forecast.classify_windows(page_windows(spark, (41, "ddoxd"), (1, "oodo"), (5, "dxd"), (7, "dd")), ["w"]).orderBy("w").collect()
    assert [(r.rejected, r.completed, r.terminal_page, r.next_page, r.meaningful, r.speculative_empty, r.ignored_failures) for r in rows] == [
        (False, True, 43, 43, 3, 0, 1),
        (False, True, 1, 1, 1, 2, 0),
        (True, False, None, None, None, 0, 0),
        (False, False, None, 9, 2, 0, 0),
    ]


def test_forecasts(spark):
    rows = [("a", "r", "n", 150, 600), ("b", "r", "n", 50, 200), ("b", "r", "n", 25, 25), ("c", "r", "n", 1, None)]
    full = forecast.full_run(spark.createDataFrame(rows, "source string, runtime string, network string, discovery_seconds long, detail_seconds long"), ["source", "runtime", "network"])
    assert {r.source: (r.full_cycle, r.complete) for r in full.collect()} == {"a": (750, True), "b": (300, True), "c": (None, False)}
    r = forecast.combined(full, ["runtime", "network"]).first()
    assert (r.parallel, r.sequential, r.complete, r.sources_measured) == (750, 1050, False, 2)


def records(spark, rows):
    return spark.createDataFrame(rows, "source string, entity_type string, source_entity_id string, payload string, content_hash string, fetched_at timestamp")


def edges(spark, rows):
    ends = [(r, "a", "notice", p, "a", "lot", c, t) if isinstance(p, str) else (r, *p, *c, t) for r, p, c, t in rows]
    return spark.createDataFrame(ends, "relation_type string, parent_source string, parent_type string, parent_id string, child_source string, child_type string, child_id string, at timestamp")


def at(day):
    return dt.datetime(2026, 1, day)


def test_merge_batches(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    first = records(spark, [("a", "notice", "1", "p1", "h1", at(1)), ("a", "notice", "2", "p2", "h2", at(1))])
    K.merge_batch(store, first, edges(spark, [("notice_to_lot", "1", "x", at(1)), ("notice_to_lot", "1", "y", at(1)), ("notice_to_lot", "9", "z", at(1))]), "s", 0)
    second = records(spark, [("a", "notice", "1", "p1b", "h1b", at(2)), ("a", "notice", "2", "p2", "h2", at(3))])
    for _ in range(2):  # a batch that comes again changes nothing
        K.merge_batch(store, second, edges(spark, [("notice_to_lot", "1", "y", at(2))]), "s", 1)
    rows = {r.source_entity_id: r for r in store.read("entities", K.ENTITIES).collect()}
    assert (rows["1"].payload, rows["1"].updated_at, rows["2"].updated_at, rows["2"].last_success_at) == ("p1b", at(2), at(1), at(3))
    assert [(r.source_entity_id, r.content_hash) for r in store.read("revisions", K.REVISIONS).collect()] == [("1", "h1")]
    kept = {(r.parent_id, r.child_id, r.first_seen_at, r.last_seen_at) for r in store.read("relations", K.RELATIONS).collect()}
    assert kept == {("1", "y", at(1), at(2)), ("9", "z", at(1), at(1))}


def test_equal_ids_of_other_types_and_sources_keep_their_edges(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    lot, other = ("a", "lot", "5"), ("b", "lot", "5")
    K.merge_batch(store, records(spark, [(*lot, "p", "h", at(1)), (*other, "p", "h", at(1))]), edges(spark, [("organizer", lot, ("a", "organization", "7"), at(1)), ("organizer", other, ("b", "organization", "7"), at(1))]), "s", 0)
    K.merge_batch(store, records(spark, [("a", "organization", "5", "p", "h", at(2))]), edges(spark, []), "s", 1)
    assert store.read("relations", K.RELATIONS).count() == 2
    K.merge_batch(store, records(spark, [(*lot, "q", "i", at(3))]), edges(spark, []), "s", 2)
    assert [r.parent_source for r in store.read("relations", K.RELATIONS).collect()] == ["b"]
    assert store.vacuum(1) > 0 and store.read("entities", K.ENTITIES).count() == 3 and store.read("revisions", K.REVISIONS).count() == 1


def test_a_batch_that_breaks_the_contract_is_rejected(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    good = records(spark, [("a", "lot", "1", "p", "h", at(1))])
    K.merge_batch(store, good, edges(spark, []), "s", 0)
    foreign = edges(spark, [("organizer", ("b", "lot", "1"), ("b", "organization", "2"), at(2))])
    crossing = edges(spark, [("organizer", ("a", "lot", "1"), ("b", "organization", "2"), at(2))])
    for rows, ends in [(records(spark, [("a", "lot", " ", "p", "h", at(2))]), edges(spark, [])), (records(spark, [("a", "lot", "2", "{}", "h", at(2))]), edges(spark, [])), (good, foreign), (good, crossing)]:
        with pytest.raises(K.ContractViolation):
            K.merge_batch(store, rows, ends, "s", 1)
    assert store.pointer()["version"] == 1 and not store.seen("s", 1)


def test_a_crash_before_the_pointer_is_published(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path))
    K.merge_batch(store, records(spark, [("a", "lot", "1", "p", "h", at(1))]), edges(spark, []), "s", 0)
    (tmp_path / ".next-left-behind").write_text("{")
    again = Store(spark, str(tmp_path))
    assert again.seen("s", 0) and again.read("entities", K.ENTITIES).count() == 1
    stale = again.pointer()
    K.merge_batch(store, records(spark, [("a", "lot", "2", "p", "h", at(2))]), edges(spark, []), "s", 1)
    monkeypatch.setattr(again, "pointer", lambda: stale)
    with pytest.raises(RuntimeError):
        again.commit({}, "s", 1)
    assert store.read("entities", K.ENTITIES).count() == 2


def test_an_outcome_logged_twice_counts_once(spark):
    work = spark.createDataFrame([("k", 1, 0, at(1), None)], "key string, priority int, attempt int, available_at timestamp, last_error string")
    log = spark.createDataFrame([("k", 0, "retry", at(3), "e", at(2))] * 2, "key string, attempt int, outcome string, retry_at timestamp, error string, at timestamp")
    left, history, failures = merge.apply_outcomes(work, log, ["key"])
    assert (left.count(), history.count(), failures.count()) == (1, 0, 1)


def test_periodic_refresh(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    rows = [("a", "lot", "1", '{"status":"open"}', "h", at(1)), ("a", "lot", "2", '{"status":"closed"}', "h", at(1)), ("a", "lot", "3", '{"x":1}', "h", at(9))]
    K.merge_batch(store, records(spark, rows), edges(spark, []), "ingest", 0)
    day = 86400
    policies = {"active": {"older_seconds": 2 * day, "newer_seconds": 0, "limit": 10, "priority": 5}, "recently_closed": {"older_seconds": 3 * day, "newer_seconds": 30 * day, "limit": 10, "priority": 1}}
    ticks = str(tmp_path / "ticks")
    for n in range(2):  # a tick a run; the second finds nothing more to enqueue
        spark.createDataFrame([(n,)], "n int").write.mode("append").parquet(ticks)
        K.periodic(spark.readStream.schema("n int").parquet(ticks), lambda batch: K.refresh(store, policies, "2026-01-10 00:00:00", "refresh", batch), str(tmp_path / "check")).awaitTermination()
    got = sorted((r.source_entity_id, r.priority, r.attempt) for r in store.read("worklist", K.WORKLIST).collect())
    assert got == [("1", 5, 0), ("2", 1, 0)] and store.seen("refresh", 1) and store.read("entities", K.ENTITIES).count() == 3


def test_export_of_one_snapshot(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "store"))
    K.merge_batch(store, records(spark, [("a", "lot", "1", "p", "h", at(1))]), edges(spark, []), "s", 0)
    only = lambda rows: rows.where("entity_type = 'lot'").select("source", "source_entity_id")
    read = store.read

    def late(name, schema, pointer=None):  # a batch arrives while the export begins
        if not store.seen("s", 1):
            monkeypatch.setattr(store, "read", read)
            K.merge_batch(store, records(spark, [("a", "lot", "2", "p", "h", at(1))]), edges(spark, []), "s", 1)
        return read(name, schema, pointer)

    monkeypatch.setattr(store, "read", late)
    out = X.export_snapshot(store, {"lots": ("entities", K.ENTITIES, only)}, str(tmp_path / "out"))
    assert [(m["rows"], m["version"]) for m in out] == [(1, 1)] and read("entities", K.ENTITIES).count() == 2
    for rows in (1, 2):  # a file is replaced, never missing
        X.publish(X.projected(only(read("entities", K.ENTITIES)).limit(rows), "lots"), str(tmp_path / "out"), "lots")
    assert len((tmp_path / "out" / "lots.csv").read_text("utf-8-sig").splitlines()) == 3
    parts = X.export({"lots": read("entities", K.ENTITIES).repartition(2)}, str(tmp_path / "parts"), parts=True)
    assert parts[0]["rows"] == 2 and len(list((tmp_path / "parts" / parts[0]["file"]).glob("part-*"))) == 2


def test_landed_pages_and_logs(spark, tmp_path):
    (tmp_path / "pages").mkdir()
    (tmp_path / "pages" / "a.html").write_text("<p>one\ntwo</p>")
    assert [r.body for r in landing.raw_pages(spark, str(tmp_path / "pages")).collect()] == ["<p>one\ntwo</p>"]
    (tmp_path / "log.jsonl").write_text('{"provider":"x","status":"ok"}\nno json\n')
    rows = landing.log_events(spark, str(tmp_path / "log.jsonl"), "provider string, status string").collect()
    assert sorted((r.provider, r._broken) for r in rows if r.provider) == [("x", None)] and [r._broken for r in rows if not r.provider] == ["no json"]
    for day in (1, 2):
        landing.append_log(spark.createDataFrame([("x", at(day))], "status string, at timestamp"), str(tmp_path / "log"), "at")
    assert sorted(str(r.day) for r in spark.read.parquet(str(tmp_path / "log")).collect()) == ["2026-01-01", "2026-01-02"]


def test_ingest_stream_drains_and_resumes(spark, tmp_path):
    land, store = str(tmp_path / "land"), Store(spark, str(tmp_path / "store"))
    schema = "source string, entity_type string, source_entity_id string, payload string, content_hash string, fetched_at timestamp"
    none = lambda: edges(spark, [])

    def drain():
        K.ingest(spark.readStream.schema(schema).parquet(land), lambda batch: (batch, none()), store, str(tmp_path / "check")).awaitTermination()

    records(spark, [("a", "lot", "1", "p", "h", at(1)), ("a", "lot", "1", "q", "i", at(2))]).write.parquet(land)
    drain()
    records(spark, [("a", "lot", "2", "p", "h", at(1))]).write.mode("append").parquet(land)
    drain()
    drain()
    assert sorted((r.source_entity_id, r.payload) for r in store.read("entities", K.ENTITIES).collect()) == [("1", "q"), ("2", "p")]


def test_relation_repair(spark):
    e = spark.createDataFrame([("customer", "1", "a"), ("customer", "1", "b"), ("organizer", "2", "a"), ("customer", "2", "a")], "relation_type string, parent_id string, child_id string")
    owners = spark.createDataFrame([("1", "A", "B"), ("2", "A", "A")], "parent_id string, customer_name string, organizer_name string")
    orgs = spark.createDataFrame([("a", "A"), ("b", "B")], "child_id string, name string")
    insert, delete = merge.relabel_relations(e, owners, orgs)
    assert [tuple(r) for r in insert.collect()] == [("organizer", "1", "b")]
    assert [tuple(r) for r in delete.collect()] == [("customer", "1", "b")]


def test_lane_states():
    lane = K.Lane(threshold=2, cooldown=10)
    assert [lane.take(t, b) for t, b in [(0, True), (1, False), (2, True), (3, True), (5, False), (13, True), (14, False), (23, False), (24, True)]] == ["closed", "closed", "closed", "open", "refused", "open", "refused", "closed", "closed"]


LANES = "lane_id string, ts timestamp, event_id long, blocked boolean"


def lane_events(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select(F.col("user_id").cast("string").alias("lane_id"), F.col("ts").cast("timestamp").alias("ts"), "event_id", (F.col("event_type") == "error").alias("blocked"))


def run_lanes(spark, folder, name, late):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    arriving = spark.readStream.schema(LANES).option("maxFilesPerTrigger", 1).parquet(str(folder / "in/*"))
    q = K.lane_stream(arriving, 2, 7200.0, late, ends=True).writeStream.format("memory").queryName(name).option("checkpointLocation", str(folder / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.table(name)


def test_shuffled_lane_stream_equals_batch(spark, sf_dir, tmp_path):
    """Rows of all times in every micro-batch; an event far ahead lets the watermark pass them."""
    events = lane_events(spark, sf_dir)
    for i in range(3):
        events.where(F.pmod(F.xxhash64("event_id"), F.lit(3)) == i).repartition(1).write.parquet(str(tmp_path / f"in/{i}"))
    spark.createDataFrame([("ahead", dt.datetime(2099, 1, 1), 0, False)], LANES).repartition(1).write.parquet(str(tmp_path / "in/9"))
    stream = run_lanes(spark, tmp_path, "lanes", "400 days").where("lane_id <> 'ahead'")
    batch = K.lane_history(events, 2, 7200.0, ends=True)
    assert batch.where("event_id is null").count() > 0
    assert sorted(map(repr, stream.collect())) == sorted(map(repr, batch.collect()))


def test_lane_cools_without_an_event(spark, tmp_path):
    at = lambda h, m=0: dt.datetime(2024, 1, 1, h, m)
    files = [[("a", at(1), 1, True), ("a", at(0, 50), 2, True)], [("b", at(2), 3, False), ("a", None, 4, True), (None, at(1), 5, True)], [("b", at(5), 6, None)], [("a", at(1), 7, False), ("b", at(6), 8, True)]]
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, LANES).repartition(1).write.parquet(str(tmp_path / f"in/{i}"))
    got = run_lanes(spark, tmp_path, "cooled", "30 minutes").where("lane_id = 'a'").orderBy("ts").collect()
    # the lane opens with its second block at 1:00; the watermark passes 3:00 without an event of the lane, and 7 comes too late
    assert [(r.event_id, r.ts, r.state, r.blocks) for r in got] == [(2, at(0, 50), "closed", 1), (1, at(1), "open", 2), (None, at(3), "half_open", 2)]
    assert K.lane_history(spark.createDataFrame([], LANES)).count() == 0


def test_duplicates_in_a_stream(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    events.union(events).repartition(2).write.parquet(str(tmp_path / "in"))
    rows = K.first_arrivals(spark.readStream.schema(events.schema).parquet(str(tmp_path / "in")), "ts", ["event_id"], "60 days")
    q = rows.writeStream.format("memory").queryName("once").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("once").count() == events.count()
