"""Work-list selection as snapshot queries."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenderlake.functions import scalars

# Fixed value: statuses that count as closed, in the portals' languages.
CLOSED = "closed|cancel|completed|finished|заверш|закры|отмен|не состоя|итог|аяқтал|жабыл|болма"


def _order(priority: str, available: str, key: str) -> list[Column]:
    return [F.desc(priority), F.asc(available), F.asc(key)]


def ready(worklist: DataFrame, as_of: Column) -> DataFrame:
    return worklist.where((F.col("available_at") <= as_of) & (F.col("leased_until").isNull() | (F.col("leased_until") < as_of)))


def claimable(worklist: DataFrame, as_of: Column, limit: int, per: list[str] | None = None, low_priority_only: bool = False) -> DataFrame:
    """The first ready items by priority, availability and key; per source if asked."""
    items = ready(worklist, as_of)
    if low_priority_only:
        items = items.where("priority <= 0")
    order = _order("priority", "available_at", "key")
    if not per:
        return items.orderBy(*order).limit(limit)
    return items.withColumn("place", F.row_number().over(Window.partitionBy(*per).orderBy(*order))).where(F.col("place") <= limit).drop("place")


def with_backfill(worklist: DataFrame, as_of: Column, slots: int, percent: int) -> DataFrame:
    """Slots with a share reserved for priority 0 and below; either side takes what the other leaves."""
    reserved = -(-slots * percent // 100)
    items = ready(worklist, as_of).withColumn("low", F.col("priority") <= 0)
    first = items.where("low").orderBy(*_order("priority", "available_at", "key")).limit(slots)
    rest = items.where("not low").orderBy(*_order("priority", "available_at", "key")).limit(slots)
    # of each kind at most ``slots`` rows are left: their ranks are taken in one small group
    both = first.unionByName(rest).withColumn("place", F.row_number().over(Window.partitionBy("low").orderBy(*_order("priority", "available_at", "key"))))
    favoured = both.withColumn("spare", F.when(F.col("low"), F.col("place") > reserved).otherwise(F.col("place") > slots - reserved))
    return favoured.orderBy("spare", *_order("priority", "available_at", "key")).limit(slots).drop("low", "place", "spare")


def refresh_candidates(registry: DataFrame, statuses: list[DataFrame], policy: str, now: str, older_seconds: int, newer_seconds: int, limit: int, tie: str) -> DataFrame:
    """Entities due for a refresh, oldest success first.

    statuses: tables of (key, status); an entity's status is the first not null.
    policy: active (not closed), recently_closed, old (any status), all (no age bound).
    """
    rows = registry
    names = []
    for i, s in enumerate(statuses):
        names.append(f"_status{i}")
        rows = rows.join(s.select("key", F.col("status").alias(names[-1])), "key", "left")
    rows = rows.withColumn("status", F.coalesce(*names, F.lit(""))).drop(*names)
    closed = F.col("status").rlike(f"(?iu){CLOSED}")
    at = F.col("last_success_at")
    before = F.expr(f"timestamp_ntz '{now}' - interval {older_seconds} seconds")
    after = F.expr(f"timestamp_ntz '{now}' - interval {max(older_seconds, newer_seconds)} seconds")
    due = {"active": ~closed & (at < before), "recently_closed": closed & (at < before) & (at >= after), "old": at < before, "all": F.lit(True)}[policy]
    return rows.where(at.isNotNull() & due).orderBy(F.asc("last_success_at"), F.asc(tie)).limit(limit)


def route_outcomes(tasks: DataFrame, most_attempts: int = 5) -> DataFrame:
    """outcome and retry_delay of finished tasks: succeeded, blocked, lease_lost, http_status, retry_after, attempt.

    A source that blocks is retried after its own delay without an attempt limit; a lost lease
    writes nothing; other errors fail for good on 404 and 410 or when attempts are used up.
    """
    gone = F.col("http_status").isin(404, 410) | (F.col("attempt") >= most_attempts)
    outcome = F.when(F.col("succeeded"), "success").when(F.col("blocked"), "blocked_retry").when(F.col("lease_lost"), "lease_lost").when(F.coalesce(gone, F.col("attempt") >= most_attempts), "failed").otherwise("retry")
    delay = F.when(outcome == "blocked_retry", F.coalesce(F.col("retry_after"), F.lit(600)).cast("long")).when(outcome == "retry", scalars.retry_delay(F.col("attempt")))
    return tasks.withColumn("outcome", outcome).withColumn("retry_delay", delay)


def release_expired(worklist: DataFrame, as_of: Column) -> tuple[DataFrame, DataFrame]:
    """Work list without expired leases, and the count of them."""
    expired = (F.col("leased_until") < as_of) & F.col("lease_owner").isNotNull()
    clear = lambda c: F.when(F.coalesce(expired, F.lit(False)), None).otherwise(F.col(c)).alias(c)
    kept = [c for c in worklist.columns if c not in ("leased_until", "lease_owner")]
    return worklist.select(*kept, clear("leased_until"), clear("lease_owner")), worklist.agg(F.count_if(expired).alias("released"))
