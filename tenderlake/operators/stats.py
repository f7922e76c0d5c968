"""Operational aggregates over work lists and logs; each is one scan with conditional counts."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderlake.functions import scalars


def queue_depth(worklist: DataFrame, by: list[str]) -> DataFrame:
    return worklist.groupBy(*by).agg(F.count("*").alias("depth"))


def activity(worklist: DataFrame, as_of: Column, by: list[str]) -> DataFrame:
    """ready, delayed, leased and stale_leases at a moment; worklist: available_at, leased_until, lease_owner."""
    available, leased = F.col("available_at"), F.col("leased_until")
    return worklist.groupBy(*by).agg(
        F.count_if((available <= as_of) & (leased.isNull() | (leased < as_of))).alias("ready"),
        F.count_if(available > as_of).alias("delayed"),
        F.count_if(leased >= as_of).alias("leased"),
        F.count_if((leased < as_of) & F.col("lease_owner").isNotNull()).alias("stale_leases"),
    )


def queue_by_type(worklist: DataFrame, as_of: Column, by: list[str]) -> DataFrame:
    return worklist.groupBy(*by).agg(
        F.count("*").alias("depth"),
        F.count_if(F.col("attempt") > 0).alias("attempted"),
        F.count_if(F.col("available_at") > as_of).alias("delayed"),
        F.count("last_error").alias("with_error"),
        F.coalesce(F.max("attempt"), F.lit(0)).alias("max_attempt"),
    )


def outcome_counts(log: DataFrame, by: list[str]) -> DataFrame:
    return log.groupBy(*by).agg(F.count("*").alias("n"))


def failure_events(log: DataFrame, registry: DataFrame, key: str, as_of: Column, pattern: str) -> DataFrame:
    """Failures by source; rows of unregistered entities count as ``unknown``. log: key, at, error, http_status."""
    day = F.make_dt_interval(days=F.lit(1))
    return (
        log.join(registry.select(key, "source"), key, "left")
        .groupBy(F.coalesce("source", F.lit("unknown")).alias("source"))
        .agg(F.count("*").alias("n"), F.count_if(F.col("at") >= as_of - day).alias("last_24h"), F.count_if(F.col("error").ilike(pattern)).alias("matching"), F.count("http_status").alias("http_events"))
    )


def one_hot(rows: DataFrame, state: str, states: list[str]) -> DataFrame:
    """A row for each row and state with 1 where it is the row's state."""
    return rows.withColumn("_s", F.explode(F.array(*[F.lit(s) for s in states]))).select(*[c for c in rows.columns if c != state], F.col("_s").alias(state), (F.col("_s") == F.col(state)).cast("int").alias("active"))


def spend_since(log: DataFrame, since: Column, by: list[str]) -> DataFrame:
    return log.where((F.col("status") == "success") & (F.col("at") >= since)).groupBy(*by).agg(F.sum("cost").alias("cost"))


def last_success(log: DataFrame, by: list[str], at: str) -> DataFrame:
    return log.groupBy(*by).agg(F.unix_timestamp(F.max(F.col(at).cast("timestamp"))).alias("succeeded_at"))


def rates(log: DataFrame, by: list[str], failed: Column) -> DataFrame:
    counts = log.groupBy(*by).agg(F.count("*").alias("n"), F.count_if(failed).alias("failed"))
    return counts.select(*by, "n", "failed", scalars.ratio(F.col("failed"), F.col("n")).alias("failure_rate"), scalars.ratio(F.col("n") - F.col("failed"), F.col("n")).alias("success_rate"))


def histogram(rows: DataFrame, value: str, edges: list[float], by: list[str]) -> DataFrame:
    """Cumulative bucket counts (values up to each edge), total and sum, by labels."""
    counts = [F.count_if(F.col(value) <= e).alias(f"le_{str(e).replace('.', '_')}") for e in edges]
    return rows.groupBy(*by).agg(*counts, F.count(value).alias("n"), F.sum(F.col(value).cast("decimal(24,6)")).cast("decimal(24,6)").alias("total"))


def as_map(counts: DataFrame, keys: list[str], value: str) -> DataFrame:
    """One row with a map 'key:key' -> value, keys in order; for aggregates of few groups."""
    entries = F.array_sort(F.collect_list(F.struct(F.concat_ws(":", *keys).alias("key"), F.col(value).alias("value"))))
    return counts.agg(F.map_from_entries(entries).alias("counts"))
