"""Joins of parsed pages, whose sizes Spark cannot know."""

import duckdb

import __spark_entry__
from tenderlake.operators import html_pages as B

PORTAL = "https://portal.example"


def test_links_of_pages_do_not_pass_through_the_driver(spark, sf_dir):
    plan = __spark_entry__.queries()["b6_page_edges"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan
    orders = f"{sf_dir}/orders.parquet"
    got = sorted(map(str, map(tuple, __spark_entry__.queries()["b6_page_edges"](spark, sf_dir).collect())))
    assert got == sorted(map(str, duckdb.sql(__spark_entry__.oracle_sql()["b6_page_edges"].replace("FROM orders", f"FROM '{orders}'")).fetchall()))


def test_links_of_odd_pages(spark):
    """Each link of a page once, the page's own not; rows of one page together; pages that nobody knows and pages without a number not at all."""
    link = lambda word, key: f'<a href="/ru/publics/{word}/{key}">{key}</a>'
    pages = [(1, link("lot", 5) + link("lot", 5) + link("buy", 1)), (1, link("point", 7) + link("lot", 5)), (2, None), (3, link("news", 1)), (4, link("lot", 9)), (None, link("lot", 8))]
    parsed = B.parse_pages(spark.createDataFrame(pages, "page_id long, html string"))
    own = spark.createDataFrame([(1, "notice", "1"), (2, "notice", "2"), (3, "lot", "3"), (None, "notice", "0")], "page_id long, entity_type string, source_entity_id string")
    got = B.page_links(parsed, own, PORTAL, "portal_a")
    assert sorted((r.page_id, r.child_type, r.child_id, r.business_number, r.relation_type) for r in got.collect()) == [(1, "lot", "5", "5", "notice_to_lot"), (1, "plan_item", "7", "7", None)]
    assert B.page_links(parsed.limit(0), own, PORTAL, "portal_a").count() == 0
