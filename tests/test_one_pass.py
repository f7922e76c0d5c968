"""JSON documents are read once, whatever is asked of them, and what a task holds is bounded."""

import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tenderlake.operators import json_docs as C
from tenderlake.plans import registry

BASE = "https://portal.example"


def plan(rows) -> str:
    return rows._jdf.queryExecution().optimizedPlan().toString()


def test_detail_documents_are_parsed_once(spark, sf_dir):
    """A filter on the id does not parse the document a second time before a shuffle."""
    rows = registry.queries()["c16_detail_entities"](spark, sf_dir)
    assert plan(rows).count("StructField(lotId") + plan(rows).count("from_json(StructField(nameRu") >= 1
    assert not [line for line in plan(rows).splitlines() if "Filter" in line and "from_json" in line]


@pytest.mark.parametrize("name, most", [("c12_organizations", 4), ("c13_goods_description", 1), ("c14_payment_terms", 1), ("c17_attach_lots", 0), ("c8_discovered_items", 0)])
def test_texts_are_not_searched_key_by_key(spark, sf_dir, name, most):
    assert plan(registry.queries()[name](spark, sf_dir)).count("get_json_object(") <= most


@pytest.mark.parametrize("name", ["c12_organizations", "c14_payment_terms"])
def test_small_files_are_read_by_all_cores(spark, sf_dir, name):
    assert "Repartition" in plan(registry.queries()[name](spark, sf_dir))


def test_of_equal_keys_the_last_counts(spark):
    docs = ['{"customer":{"id":1,"id":2,"nameRu":"a","nameRu":"b"},"paymentConditionList":[{"paymentType":"PREPAY","value":1,"value":"2,5"}],"goodsAttributeList":[{"nameRu":"x","nameRu":"y"}]}']
    b = F.col("body")
    r = spark.createDataFrame([(d,) for d in docs], "body string").coalesce(1).select(C.organization(b, BASE, "customer").alias("o"), C.payment_terms(b).alias("p"), C.goods_description(b, "ru").alias("g")).first()
    assert (r.o.source_entity_id, r.o.name_ru, str(r.p.prepayment_percent), r.g) == ("2", "b", "2.500", "y")


def test_lists_with_other_values_keep_their_objects(spark):
    docs = [
        '{"paymentConditionList":[3,null,"x",{"paymentType":"PREPAY","value":7},[1]],"goodsAttributeList":[5,{"name":"n","attribute":{"ru":"l"}},"s",{"nameRu":2.50,"attribute":"plain"}]}',
        '{"paymentConditionList":[{"paymentType":"PREPAY","value":7},{"paymentType":"PREPAY","value":null}],"prepayment":9,"finalPaymentPercent":"70","goodsAttributeList":{"nameRu":"no list"}}',
        '{"prepayment":"9,5","paymentConditionList":"PREPAY"}',
    ]
    b = F.col("body")
    rows = spark.createDataFrame([(d,) for d in docs], "body string").coalesce(1).select(C.payment_terms(b).alias("p"), C.goods_description(b, "ru").alias("g")).collect()
    assert [str(r.p.prepayment_percent) for r in rows] == ["7.000", "None", "9.500"] and str(rows[1].p.final_percent) == "70.000"
    assert [r.g for r in rows] == ["l: n; 2.5", None, None]


def test_a_walk_hands_on_bounded_slices():
    bodies = [json.dumps([{"id": i, "in": {"x": i}} for i in range(3000)]), None, "{", json.dumps([{"text": "y" * 1_500_000} for _ in range(9)]), "{}"]
    given = pa.RecordBatch.from_arrays([pa.array(list("abcde")), pa.array(bodies)], names=["key", "payload"])
    out = list(C._walked([given]))
    assert all(b.num_rows <= C.SLICE_ROWS and b.nbytes <= C.SLICE_CHARS + 2_000_000 for b in out) and len(out) > 4
    rows = [tuple(r.values())[:2] for b in out for r in b.to_pylist()]
    assert rows == [("a", i) for i in range(6000)] + [("d", i) for i in range(9)] + [("e", 0)]


def test_children_stream_past_the_keys_of_their_owners(spark):
    """Children of replaced owners are not sorted, so a task's memory does not follow them; rows without a key stay."""
    from tenderlake.operators import merge as E

    old = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k long, v string")
    fresh = spark.createDataFrame([(1, "x"), (3, "y"), (None, "z")], "k long, v string")
    owners = spark.createDataFrame([(1,), (1,), (None,), (4,)], "k long")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = E.replace_children(old, fresh, owners, ["k"])
        shape = rows._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, rows.collect())) == sorted(["Row(k=1, v='x')", "Row(k=2, v='c')", "Row(k=None, v='d')"])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert shape.count("ShuffledHashJoin") == 2 and "SortMergeJoin" not in shape


@pytest.mark.parametrize("name", ["f5_export_entity_relations", "f12_chains"])
def test_relations_join_by_typed_keys(spark, sf_dir, name):
    """No join computes or sorts texts of keys."""
    joins = [line for line in plan(registry.queries()[name](spark, sf_dir)).splitlines() if "Join Inner" in line]
    assert joins and not [line for line in joins if any(c in line.split("Join Inner")[1] for c in ("_id#", "parent#", "child#"))]


def test_chains_are_whole(spark, sf_dir):
    read = lambda table, *columns: [tuple(r) for r in spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns).collect()]
    from tenderlake.plans.tables import Tables

    lots = [tuple(r) for r in Tables(spark, sf_dir).lot().select("l_partkey", "l_orderkey", "source_entity_id", "status").collect()]
    titles, states, of_order = dict(read("part", "p_partkey", "p_name")), dict(read("orders", "o_orderkey", "o_orderstatus")), {}
    for _, order, lot, status in lots:
        of_order.setdefault(order, []).append((lot, status))
    want = [(str(p), titles[p], str(o), states[o], *x) for p, o in {x[:2] for x in lots} if p in titles and o in states for x in of_order[o]]
    rows = registry.queries()["f12_chains"](spark, sf_dir)
    assert rows.columns == ["lot_id", "notice_id", "plan_id", "plan_title", "notice_status", "lot_status"]
    assert sorted(tuple(r) for r in rows.select("plan_id", "plan_title", "notice_id", "notice_status", "lot_id", "lot_status").collect()) == sorted(want)
