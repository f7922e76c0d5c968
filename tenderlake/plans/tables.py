"""The driver's tables as procurement entities, in Spark and in DuckDB SQL.

Notices are orders, lots are lineitems reduced to one row per (order, line), plan
items are parts, organizations are customers and suppliers, logs are events. The
source follows the parity of the key. Both forms name and type columns alike.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.operators.merge import latest_per_key

AS_OF = "2024-01-20 00:00:00"


def source_of(key: str) -> Column:
    return F.when(F.col(key) % 2 == 0, "portal_a").otherwise("portal_b")


class Tables:
    """Tables of one folder, and the entities made of them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def dealt(self, rows: DataFrame, key: str) -> DataFrame:
        """Rows of a key in one of the session's shuffle partitions, which small rows before costly work do not fill by their bytes."""
        return rows.repartition(int(self.spark.conf.get("spark.sql.shuffle.partitions")), key)

    def spread(self, rows: DataFrame, key: str) -> DataFrame:
        """A scan of fewer splits than cores over all of them; a larger one as it is, without a shuffle."""
        return rows if rows.rdd.getNumPartitions() >= self.spark.sparkContext.defaultParallelism else self.dealt(rows, key)

    def notice(self) -> DataFrame:
        return self.orders.select(
            source_of("o_orderkey").alias("source"),
            F.lit("notice").alias("entity_type"),
            F.col("o_orderkey").cast("string").alias("source_entity_id"),
            "o_orderkey",
            "o_custkey",
            F.col("o_orderstatus").alias("status"),
            F.col("o_orderpriority").alias("priority"),
            F.col("o_orderdate").alias("published_at"),
            F.col("o_totalprice").cast("decimal(24,6)").alias("total_amount"),
        )

    def lot(self) -> DataFrame:
        rows = latest_per_key(self.lineitem, ["l_orderkey", "l_linenumber"], [F.desc("l_shipdate"), "l_partkey", "l_suppkey", "l_extendedprice"])
        return rows.select(
            source_of("l_orderkey").alias("source"),
            F.lit("lot").alias("entity_type"),
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("source_entity_id"),
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            "l_suppkey",
            F.col("l_returnflag").alias("status"),
            F.col("l_shipdate").alias("closes_at"),
            F.col("l_quantity").cast("decimal(24,6)").alias("quantity"),
            F.col("l_extendedprice").cast("decimal(24,6)").alias("total_amount"),
        )

    def lot_keys(self) -> DataFrame:
        """Registry of the lots: each key once, without the window that finds its latest row."""
        once = self.lineitem.select("l_orderkey", "l_linenumber").distinct()
        return once.select(source_of("l_orderkey").alias("source"), F.lit("lot").alias("entity_type"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("source_entity_id"), "l_orderkey", "l_linenumber")

    def plan_item(self) -> DataFrame:
        return self.part.select(
            source_of("p_partkey").alias("source"),
            F.lit("plan_item").alias("entity_type"),
            F.col("p_partkey").cast("string").alias("source_entity_id"),
            "p_partkey",
            F.col("p_name").alias("title"),
            F.col("p_type").alias("status"),
        )

    def edges(self) -> DataFrame:
        """parent and child ids by relation; each once."""
        lot, text = self.lot(), lambda c: F.col(c).cast("string")
        pair = lambda rows, kind, parent, child: rows.select(F.lit(kind).alias("relation_type"), text(parent).alias("parent_id"), text(child).alias("child_id"))
        plans = lot.select("l_partkey", "l_orderkey").distinct()  # the other relations have each pair once as they are
        return reduce(
            DataFrame.union,
            [
                pair(self.lot_keys(), "notice_to_lot", "l_orderkey", "source_entity_id"),
                pair(lot, "plan_to_lot", "l_partkey", "source_entity_id"),
                pair(plans, "plan_to_notice", "l_partkey", "l_orderkey"),
                pair(lot, "organizer", "source_entity_id", "l_suppkey"),
                pair(self.orders, "customer", "o_orderkey", "o_custkey").distinct(),
            ],
        )


SQL = f"""
v_notice AS MATERIALIZED (SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'portal_a' ELSE 'portal_b' END AS source, 'notice' AS entity_type, CAST(o_orderkey AS VARCHAR) AS source_entity_id,
  o_orderkey, o_custkey, o_orderstatus AS status, o_orderpriority AS priority, o_orderdate AS published_at, CAST(o_totalprice AS DECIMAL(24,6)) AS total_amount FROM orders),
v_lot AS MATERIALIZED (SELECT CASE WHEN l_orderkey % 2 = 0 THEN 'portal_a' ELSE 'portal_b' END AS source, 'lot' AS entity_type, concat(l_orderkey, '-', l_linenumber) AS source_entity_id,
  l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag AS status, l_shipdate AS closes_at, CAST(l_quantity AS DECIMAL(24,6)) AS quantity, CAST(l_extendedprice AS DECIMAL(24,6)) AS total_amount
  FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1),
v_plan AS (SELECT CASE WHEN p_partkey % 2 = 0 THEN 'portal_a' ELSE 'portal_b' END AS source, 'plan_item' AS entity_type, CAST(p_partkey AS VARCHAR) AS source_entity_id, p_partkey, p_name AS title, p_type AS status FROM part),
v_edge AS (SELECT 'notice_to_lot' AS relation_type, CAST(l_orderkey AS VARCHAR) AS parent_id, source_entity_id AS child_id FROM v_lot
  UNION ALL SELECT 'plan_to_lot', CAST(l_partkey AS VARCHAR), source_entity_id FROM v_lot
  UNION ALL SELECT 'plan_to_notice', CAST(l_partkey AS VARCHAR), CAST(l_orderkey AS VARCHAR) FROM (SELECT DISTINCT l_partkey, l_orderkey FROM v_lot)
  UNION ALL SELECT 'organizer', source_entity_id, CAST(l_suppkey AS VARCHAR) FROM v_lot
  UNION ALL SELECT DISTINCT 'customer', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR) FROM orders)
"""


def with_views(sql: str) -> str:
    return f"WITH {SQL}{', ' if not sql.lstrip().upper().startswith('SELECT') else ''}{sql}"
