"""The queries do their whole jobs: compared with plain versions that leave nothing out."""

from collections import defaultdict

from tenderlake.plans import registry
from tenderlake.plans.tables import Tables


def plain_windows(events):
    windows = defaultdict(list)
    for user, event, kind in events:
        windows[user, event // 50].append((event, {"error": "failed", "signup": "empty"}.get(kind, "items")))
    for key, pages in windows.items():
        stop = min((p for p in pages if p[1] != "items"), default=(None, None))
        useful = [e for e, _ in pages if stop[0] is None or e < stop[0]]
        yield (*key, stop[1] == "failed", stop[1] == "empty", 0 if stop[1] == "failed" else sum(e % 10 for e in useful))


def test_windows_of_all_users_are_classified(spark, sf_dir):
    events = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", "event_id", "event_type").collect()]
    got = registry.queries()["j1_classify_windows"](spark, sf_dir).select("user_id", "window_id", "rejected", "completed", "items").collect()
    assert sorted(map(tuple, got)) == sorted(plain_windows(events))


def test_relations_of_all_types_are_exported(spark, sf_dir):
    def rows(table, *columns):
        return [tuple(map(str, r)) for r in spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns).collect()]

    lots = [tuple(map(str, r)) for r in Tables(spark, sf_dir).lot().select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").collect()]
    orders = rows("orders", "o_orderkey", "o_custkey")
    known = {"notice": {o for o, _ in orders}, "lot": {f"{o}-{n}" for o, n, *_ in lots}, "plan_item": {p for (p,) in rows("part", "p_partkey")}}
    known["organization"] = {c for (c,) in rows("customer", "c_custkey") + rows("supplier", "s_suppkey")}
    edges = {("customer", "notice", o, "organization", c) for o, c in orders}
    for o, n, part, supplier in lots:
        edges |= {("notice_to_lot", "notice", o, "lot", f"{o}-{n}"), ("plan_to_lot", "plan_item", part, "lot", f"{o}-{n}"), ("plan_to_notice", "plan_item", part, "notice", o), ("organizer", "lot", f"{o}-{n}", "organization", supplier)}
    source = lambda key: ("portal_a", "portal_b")[int(key.split("-")[0]) % 2]
    want = [(kind, source(p), pt, p, source(c), ct, c) for kind, pt, p, ct, c in edges if p in known[pt] and c in known[ct]]
    got = [tuple(r) for r in registry.queries()["f5_export_entity_relations"](spark, sf_dir).select("relation_type", "parent_source", "parent_type", "parent_id", "child_source", "child_type", "child_id").collect()]
    assert sorted(got) == sorted(want) and len({r[0] for r in got}) == 5
