"""Merged and redacted JSON: types and digits stay, secrets go at any depth."""

import json

import pytest
from pyspark.sql import functions as F

from tenderlake.functions import scalars as S


def test_merged_values_keep_their_types(spark):
    rows = [('{"a":1,"n":true,"z":12345678901234567.891234}', '{"b":{"c":2},"a":"x","q":null}'), (None, '{"k":1}'), ("no json", '{"k":1}'), ('{"k":[1,"2"]}', None)]
    got = [r[0] for r in spark.createDataFrame(rows, "a string, b string").coalesce(1).select(S.merge_json(F.col("a"), F.col("b"))).collect()]
    assert got[0] == '{"a":"x","b":{"c":2},"n":true,"q":null,"z":12345678901234567.891234}' and got[1] == '{"k":1}' and got[3] == '{"k":[1,"2"]}'


KEYS = frozenset(S.SECRET_KEYS)


@pytest.mark.parametrize(
    "line, want",
    [
        ('{"cookies": {"a": {"b": "SECRET"}}, "x": 1}', '{"cookies": "[REDACTED]", "x": 1}'),
        ('{"a":[{"b":{"COOKIE":["x",{"y":"}"}]}},2.50]}', '{"a":[{"b":{"COOKIE":"[REDACTED]"}},2.50]}'),
        ('{"cookie":"a\\"b","authorization" : null , "z":"cookie"}', '{"cookie":"[REDACTED]","authorization" : "[REDACTED]" , "z":"cookie"}'),
        ('{"\\u0063ookie":1,"x-api-key":-1e5}', '{"\\u0063ookie":"[REDACTED]","x-api-key":"[REDACTED]"}'),
        ('{"cookie":[[["', '{"cookie":"[REDACTED]"'),
        ("no json", "no json"),
        ("", ""),
    ],
)
def test_secrets_go_at_any_depth(line, want):
    assert S.redact_text(line, KEYS) == want


def test_deep_lines_are_redacted(spark):
    deep = '{"a":' * 3000 + '{"cookie":' + "[" * 3000 + "]" * 3000 + "}" + "}" * 3000
    got = [r[0] for r in spark.createDataFrame([(deep,), (None,), ('{"cookie":{"a":1}}',)], "line string").coalesce(1).select(S.redact(F.col("line"))).collect()]
    assert got[0] == '{"a":' * 3000 + '{"cookie":"[REDACTED]"}' + "}" * 3000 and got[1] is None and json.loads(got[2]) == {"cookie": "[REDACTED]"}


def test_deep_documents_are_walked_and_searched(spark):
    from tenderlake.operators import json_docs as C

    deep = '{"x":0,"data":' * 1200 + '[{"id":1}]' + "}" * 1200
    twice = '{"content":{"items":[]},"result":' * 1100 + '[{"id":2}]' + "}" * 1100
    beyond = "[" * 200_000 + "]" * 200_000
    docs = spark.createDataFrame([("a", deep), ("b", twice), ("c", beyond), ("d", None)], "key string, body string").coalesce(1)
    assert {r.key: r.n for r in C.walk(docs, "key", "body").groupBy("key").count().withColumnRenamed("count", "n").collect()} == {"a": 1201, "b": 2201}
    assert {r.key: r.source_entity_id for r in C.discovered_items(docs, "body", "lot", "https://portal.example").collect()} == {"a": "1", "b": "2"}


def test_numbers_keep_their_digits_from_list_to_entity(spark):
    """Through the list, the item's text, the entity's columns and its places."""
    from tenderlake.operators import json_docs as C

    lot = '{"id":5,"totalSum":12345678901234567.891234,"price":"1 234,50","quantity":2.50,"deliveryPlaces":[{"id":1,"quantity":98765432109876543.210987}],"count":null}'
    lists = spark.createDataFrame([("n", f'{{"data":{{"content":[{lot}]}}}}'), ("broken", '{"content":[{"id":1}'), ("twice", '{"content":[{"id":1,"id":6,"sum":7}]}')], "notice string, body string").coalesce(1)
    found = C.attach_lots(lists, "notice", "body", "https://portal.example")
    rows = {r.source_entity_id: r for r in C.detail_entities(found.select("source_payload"), "source_payload", "lot", "https://portal.example").collect()}
    assert set(rows) == {"5", "6"}
    assert [str(x) for x in (rows["5"].total_amount, rows["5"].unit_price, rows["5"].quantity, rows["5"].delivery_places[0].quantity)] == ["12345678901234567.891234", "1234.500000", "2.500000", "98765432109876543.210987"]
    assert "12345678901234567.891234" in rows["5"].source_payload and str(rows["6"].total_amount) == "7.000000"
    walked = [r.object for r in C.walk(lists, "notice", "body").where("key = 'n' and pos = 2").collect()]
    assert "12345678901234567.891234" in walked[0] and json.loads(walked[0])["id"] == 5
    odd = spark.createDataFrame([(None,), ("",), ("[1]",), ("{}",), ('{"id":',)], "body string").coalesce(1)
    assert C.detail_entities(odd, "body", "lot", "https://portal.example").count() == 0
