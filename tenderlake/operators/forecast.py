"""Catalogue measurement and forecasts."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenderlake.functions import scalars


def classify_windows(pages: DataFrame, window: list[str]) -> DataFrame:
    """Outcome of page windows; pages: window, page, status (items, empty, failed), n_items.

    Pages are read in order until the first empty or failed one. If that failed,
    the window is rejected; if it was empty, the catalogue ends there, and later
    pages were speculative.
    """
    stop = F.min(F.when(F.col("status") != "items", F.col("page"))).over(Window.partitionBy(*window))
    p = pages.withColumn("stop", stop)
    before = F.col("stop").isNull() | (F.col("page") < F.col("stop"))
    out = p.groupBy(*window).agg(
        F.first("stop").alias("stop"),
        F.max(F.when(F.col("page") == F.col("stop"), F.col("status"))).alias("stop_status"),
        F.max("page").alias("last_page"),
        F.count("*").alias("requested"),
        F.count_if(before).alias("useful"),
        F.coalesce(F.sum(F.when(before, F.col("n_items"))), F.lit(0)).alias("items"),
        F.count_if((F.col("page") > F.col("stop")) & (F.col("status") == "empty")).alias("speculative_empty"),
        F.count_if((F.col("page") > F.col("stop")) & (F.col("status") == "failed")).alias("ignored_failures"),
    )
    rejected, ended = F.coalesce(F.col("stop_status") == "failed", F.lit(False)), F.coalesce(F.col("stop_status") == "empty", F.lit(False))
    meaningful = F.col("useful") + ended.cast("int")
    return out.select(
        *window,
        rejected.alias("rejected"),
        ended.alias("completed"),
        F.when(ended, F.col("stop")).alias("terminal_page"),
        F.when(~rejected, F.coalesce("stop", F.col("last_page") + 1)).alias("next_page"),
        F.when(~rejected, F.col("items")).otherwise(0).alias("items"),
        F.when(~rejected, meaningful).alias("meaningful"),
        F.when(~rejected, F.col("requested") - meaningful).alias("speculative"),
        F.when(ended, F.col("speculative_empty")).otherwise(0).alias("speculative_empty"),
        F.when(ended, F.col("ignored_failures")).otherwise(0).alias("ignored_failures"),
    )


def probe_totals(samples: DataFrame, by: list[str], concurrency: int) -> DataFrame:
    """samples: returned, elapsed (decimal seconds), total. Rates and estimates of a full run."""
    s = samples.groupBy(*by).agg(F.count("*").alias("requests"), F.sum("returned").alias("returned"), F.sum("elapsed").alias("sequential_seconds"), F.max("total").alias("total"))
    wall = F.col("sequential_seconds").cast("double") / concurrency
    rate = F.try_divide(F.col("returned").cast("double"), wall)
    return s.select(*by, "requests", "returned", "total", F.round(wall, 4).alias("wall_seconds"), F.round(rate, 4).alias("rate"), F.round(F.try_divide(F.col("total").cast("double"), rate), 4).alias("estimated_seconds"))


def detail_probe(log: DataFrame, by: list[str], failed) -> DataFrame:
    c = log.groupBy(*by).agg(F.count("*").alias("requested"), F.count_if(~failed).alias("succeeded"), F.count_if(failed).alias("failed"))
    return c.withColumn("rate", scalars.ratio(F.col("succeeded"), F.col("requested")))


def full_run(results: DataFrame, by: list[str]) -> DataFrame:
    """Forecast per source and profile; a catalogue is usable if both estimates are there."""
    d, w = F.col("discovery_seconds"), F.col("detail_seconds")
    usable = d.isNotNull() & w.isNotNull()
    r = results.groupBy(*by).agg(F.count("*").alias("expected"), F.count_if(usable).alias("measured"), F.sum(F.when(usable, d)).alias("discovery"), F.sum(F.when(usable, w)).alias("detail"))
    return r.select(*by, "expected", "measured", "discovery", "detail", (F.col("discovery") + F.col("detail")).alias("full_cycle"), (F.col("expected") == F.col("measured")).alias("complete"))


def combined(forecasts: DataFrame, by: list[str]) -> DataFrame:
    """Sources side by side (the longest) and one after the other (the sum); complete forecasts only."""
    ok = F.col("complete")
    c = forecasts.groupBy(*by).agg(F.count("*").alias("sources_expected"), F.count_if(ok).alias("sources_measured"), F.max(F.when(ok, F.col("full_cycle"))).alias("parallel"), F.sum(F.when(ok, F.col("full_cycle"))).alias("sequential"))
    return c.withColumn("complete", F.col("sources_expected") == F.col("sources_measured"))


def summary(forecasts: DataFrame, totals: DataFrame, profile: list[str]) -> DataFrame:
    """Per source: fastest and slowest complete profile, and the sum over types of the largest total seen."""
    name = F.concat_ws("/", *profile)
    done = forecasts.where("complete").groupBy("source").agg(
        F.min(F.struct("full_cycle", name.alias("profile"))).alias("fast"),
        F.max(F.struct("full_cycle", name.alias("profile"))).alias("slow"),
    )
    largest = totals.groupBy("source", "entity_type").agg(F.max("total").alias("total")).groupBy("source").agg(F.sum("total").alias("total"))
    return done.join(largest, "source", "full_outer").select("source", F.col("fast.profile").alias("fastest"), F.col("fast.full_cycle").alias("fastest_seconds"), F.col("slow.profile").alias("slowest"), F.col("slow.full_cycle").alias("slowest_seconds"), "total")
