"""All registered queries of the tender-data operators, and their DuckDB SQL."""

from tenderlake.plans import merge_queries, raw_queries, scalar_queries, stat_queries, view_queries

MODULES = (view_queries, scalar_queries, merge_queries, stat_queries, raw_queries)


def queries() -> dict:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in MODULES for k, s in m.SQL.items()}
