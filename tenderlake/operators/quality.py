"""Data-quality reports: extraction contract, identity and length checks, CSV files, acceptance."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderlake.functions import scalars


def contract_violations(items: DataFrame, task: list[str]) -> DataFrame:
    """Reasons for which a task's extraction is rejected; items: task, key, role (primary or other), source, payload."""
    checked = items.groupBy(*task).agg(
        F.count_if(F.col("role") == "primary").alias("primaries"),
        F.count("*").alias("n"),
        F.count_distinct("key").alias("keys"),
        F.count_distinct("source").alias("sources"),
        F.max(F.coalesce((F.col("role") == "primary") & (F.coalesce(F.col("payload"), F.lit("{}")) == "{}"), F.lit(False))).alias("empty"),
    )
    reason = F.when(F.col("primaries") != 1, "primary").when(F.col("keys") < F.col("n"), "duplicate").when(F.col("sources") > 1, "source").when(F.col("empty"), "payload")
    return checked.select(*task, "primaries", "n", "keys", reason.alias("reason"))


def duplicate_rows(rows: DataFrame, key: list[str]) -> DataFrame:
    """Rows beyond the first of each complete key, and rows whose key is incomplete."""
    blank = reduce(lambda a, b: a | b, [F.coalesce(F.trim(F.col(k).cast("string")), F.lit("")) == "" for k in key])
    counts = rows.withColumn("_blank", blank).groupBy("_blank", *key).agg(F.count("*").alias("n"))
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(~F.col("_blank"), F.col("n") - 1)), F.lit(0)).alias("duplicate_identity_rows"),
        F.coalesce(F.sum(F.when(F.col("_blank"), F.col("n"))), F.lit(0)).alias("empty_identity_rows"),
    )


def split_mismatches(counts: DataFrame) -> DataFrame:
    """Datasets whose split files don't add up; counts: dataset, part (combined or a source), rows."""
    sums = counts.groupBy("dataset").agg(F.sum(F.when(F.col("part") == "combined", F.col("rows"))).alias("combined"), F.sum(F.when(F.col("part") != "combined", F.col("rows"))).alias("split"))
    return sums.where("combined <> split")


def acceptance(entities: DataFrame, key: list[str], edges: DataFrame, edge_end: str, entity_key: str, log: DataFrame, failed: Column, payload: str) -> DataFrame:
    """One row: duplicates, orphan edge ends, missing payloads, failure rate, and whether all pass."""
    duplicates = duplicate_rows(entities, key).select(F.col("duplicate_identity_rows").alias("duplicates"))
    orphans = edges.select(F.col(edge_end).alias(entity_key)).join(entities.select(entity_key), entity_key, "left_anti").agg(F.count("*").alias("orphans"))
    missing = entities.agg(F.count_if(F.col(payload).isNull()).alias("missing_payload"))
    rate = log.agg(scalars.ratio(F.count_if(failed), F.count("*")).alias("failure_rate"))
    row = duplicates.crossJoin(orphans).crossJoin(missing).crossJoin(rate)  # of one row each
    return row.withColumn("accepted", (F.col("duplicates") == 0) & (F.col("orphans") == 0) & (F.col("missing_payload") == 0) & (F.col("failure_rate") <= 0.01))


def length_violations(rows: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Values longer than allowed, by column, and the longest."""
    stats = rows.agg(*[F.count_if(F.length(c) > n).alias(f"{c}_over") for c, n in limits.items()], *[F.max(F.length(c)).alias(f"{c}_max") for c in limits])
    return stats.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.lit(n).alias("allowed"), F.col(f"{c}_over").alias("over"), F.col(f"{c}_max").alias("longest")) for c, n in limits.items()])))


def csv_report(cells: DataFrame, columns: list[str], identity: list[str], broken: Column) -> DataFrame:
    """rows, malformed_rows, replacement_characters, formula_like_cells and identity counts of a file's rows."""
    text = [F.coalesce(F.col(c), F.lit("")) for c in columns]
    marks = reduce(lambda a, b: a + b, [F.length(c) - F.length(F.replace(c, F.lit("�"), F.lit(""))) for c in text])
    formulas = reduce(lambda a, b: a + b, [scalars.is_formula(c).cast("int") for c in text])
    sums = cells.agg(F.count("*").alias("rows"), F.count_if(broken).alias("malformed_rows"), F.coalesce(F.sum(marks), F.lit(0)).alias("replacement_characters"), F.coalesce(F.sum(formulas), F.lit(0)).alias("formula_like_cells"))
    if not identity:
        return sums.withColumn("duplicate_identity_rows", F.lit(0)).withColumn("empty_identity_rows", F.lit(0))
    trimmed = cells.select(*[F.trim(c).alias(c) for c in identity])
    return sums.crossJoin(duplicate_rows(trimmed, identity).drop("rows"))  # of one row each


def csv_reports(cells: DataFrame) -> DataFrame:
    """``csv_report`` of many files in one job, a row per file that has rows.

    cells: file, broken, cells (array), identity (array of the cells that identify a row; null if
    the dataset has none). Copies of a key are counted before they meet.
    """
    text = F.array_join("cells", "\n", "")
    trimmed = F.transform("identity", lambda c: F.coalesce(F.trim(c), F.lit("")))
    measured = cells.select(
        "file",
        F.when(~F.exists(trimmed, lambda c: c == ""), trimmed).alias("key"),
        F.col("identity").isNotNull().alias("_identified"),
        F.col("broken").cast("long").alias("broken"),
        (F.length(text) - F.length(F.replace(text, F.lit("\ufffd"), F.lit("")))).alias("lost"),
        F.size(F.filter("cells", lambda c: F.coalesce(scalars.is_formula(c), F.lit(False)))).alias("formulas"),
    )
    sums = [F.sum(c).alias(c) for c in ("broken", "lost", "formulas")]
    per_key = measured.groupBy("file", "key", "_identified").agg(F.count("*").alias("n"), *sums)
    return per_key.groupBy("file").agg(
        F.sum("n").alias("rows"),
        F.sum("broken").alias("malformed_rows"),
        F.sum("lost").alias("replacement_characters"),
        F.sum("formulas").alias("formula_like_cells"),
        F.coalesce(F.sum(F.when(F.col("key").isNotNull(), F.col("n") - 1)), F.lit(0)).alias("duplicate_identity_rows"),
        F.coalesce(F.sum(F.when(F.col("_identified") & F.col("key").isNull(), F.col("n"))), F.lit(0)).alias("empty_identity_rows"),
    )
