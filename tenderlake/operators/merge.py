"""Keyed merges, history and maintenance as set-based rewrites: each takes old and new tables and returns the next version."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenderlake.functions import scalars


def latest_per_key(rows: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row per key, the first in the order, which must be unique inside a key."""
    at = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_at", F.row_number().over(at)).where("_at = 1").drop("_at")


def same_key(old: DataFrame, new: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [old[k].eqNullSafe(new[k]) for k in keys])


def upsert_registry(old: DataFrame, new: DataFrame, keys: list[str], latest: tuple[str, ...] = ()) -> DataFrame:
    """business_number, canonical_url, summary_payload, first_seen_at, last_seen_at and the columns ``latest`` by key.

    A new number, address or summary replaces the old one only if there is one
    (an empty summary object counts as none), so do the columns ``latest``; the first sighting is kept.
    """
    o, n = old.alias("o"), new.alias("n")
    on = reduce(lambda a, b: a & b, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys])
    either = lambda c: F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")).alias(c)
    return o.join(n, on, "full_outer").select(
        *[F.coalesce(F.col(f"n.{k}"), F.col(f"o.{k}")).alias(k) for k in keys],
        either("business_number"),
        either("canonical_url"),
        F.coalesce(F.nullif(F.col("n.summary_payload"), F.lit("{}")), F.col("o.summary_payload")).alias("summary_payload"),
        F.least("o.first_seen_at", "n.first_seen_at").alias("first_seen_at"),
        F.greatest("o.last_seen_at", "n.last_seen_at").alias("last_seen_at"),
        *[either(c) for c in latest],
    )


def upsert_by_hash(old: DataFrame, new: DataFrame, keys: list[str], hash_col: str = "content_hash", touch: str = "last_success_at", changed_at: str = "updated_at") -> DataFrame:
    """Next version with a ``change`` column: new, changed (the new row), unchanged (the old row, touched) or kept (not in the batch).

    Rows without a hash are equal to others without one and differ from all with one.
    """
    values = [c for c in old.columns if c not in (*keys, touch, changed_at)]
    o, n = old.withColumn("_there", F.lit(True)).alias("o"), new.withColumn("_came", F.lit(True)).alias("n")
    on = reduce(lambda a, b: a & b, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys])
    change = F.when(F.col("_there").isNull(), "new").when(F.col("_came").isNull(), "kept").when(F.col(f"o.{hash_col}").eqNullSafe(F.col(f"n.{hash_col}")), "unchanged").otherwise("changed")
    fresh = change.isin("new", "changed")
    return o.join(n, on, "full_outer").select(
        *[F.coalesce(F.col(f"n.{k}"), F.col(f"o.{k}")).alias(k) for k in keys],
        *[F.when(fresh, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in values],
        F.coalesce(F.col(f"n.{touch}"), F.col(f"o.{touch}")).alias(touch),
        F.when(fresh, F.col(f"n.{changed_at}")).otherwise(F.col(f"o.{changed_at}")).alias(changed_at),
        change.alias("change"),
    )


def revisions(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str], hash_col: str = "content_hash") -> DataFrame:
    """The replaced rows as JSON: key, content_hash, payload."""
    changed = old.alias("o").join(new.select(*keys, F.col(hash_col).alias("_new")).alias("n"), keys).where(~F.col(f"o.{hash_col}").eqNullSafe(F.col("_new")))
    return changed.select(*keys, F.col(f"o.{hash_col}").alias(hash_col), F.to_json(F.struct(*[F.col(f"o.{c}").alias(c) for c in columns])).alias("payload"))


def replace_children(children: DataFrame, fresh: DataFrame, owners: DataFrame, keys: list[str]) -> DataFrame:
    """All children of the given owners give way to the fresh ones."""
    # a task holds the keys of its owners, once each; children stream past them, where a merge join would sort them all
    owned = owners.select(*keys).distinct().hint("shuffle_hash")
    return children.join(owned, keys, "left_anti").unionByName(fresh.join(owned, keys, "left_semi"))


def upsert_relations(old: DataFrame, new: DataFrame, keys: list[str], at: str = "last_seen_at") -> DataFrame:
    """Edges of both; first and last sighting over both."""
    seen = old.select(*keys, "first_seen_at", at).unionByName(new.select(*keys, "first_seen_at", at))
    return seen.groupBy(*keys).agg(F.min("first_seen_at").alias("first_seen_at"), F.max(at).alias(at))


def vanished_relations(existing: DataFrame, desired: DataFrame, parents: DataFrame, parent_key: str | list[str], keys: list[str]) -> DataFrame:
    """Edges of parents in the batch that the batch no longer has. Other parents' edges are safe."""
    parent_key = [parent_key] if isinstance(parent_key, str) else parent_key
    scope = parents.select(*parent_key).distinct()
    return existing.join(scope, parent_key, "left_semi").join(desired.select(*keys), keys, "left_anti")


def batch_identities(*parts: DataFrame) -> DataFrame:
    """Union of identities (entities and both ends of edges), each once."""
    return reduce(DataFrame.unionByName, parts).distinct()


def replay(old: DataFrame, rows: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Staged rows reduced to the latest per key (ties by hash), merged where the hash differs; with ``change``."""
    latest = latest_per_key(rows, keys, [F.desc("fetched_at"), F.desc("content_hash")])
    cols = [*keys, *values, "content_hash", "fetched_at"]
    new = latest.select(*cols, F.col("fetched_at").alias("last_success_at"), F.col("fetched_at").alias("updated_at"))
    return upsert_by_hash(old, new, keys)


def enqueue(worklist: DataFrame, items: DataFrame, succeeded: DataFrame, keys: list[str]) -> DataFrame:
    """Work list after an enqueue. Items of succeeded keys come in only if they ask for a refresh.

    Equal keys merge: highest priority, earliest availability, latest payload by
    (available_at, payload); the attempt count of a known item stays.
    """
    wanted = items.where("refresh_existing").unionByName(items.where("not refresh_existing").join(succeeded.select(*keys).distinct(), keys, "left_anti")).drop("refresh_existing")
    both = worklist.unionByName(wanted.withColumn("attempt", F.lit(0)))
    return both.groupBy(*keys).agg(F.max("priority").alias("priority"), F.min("available_at").alias("available_at"), F.max("attempt").alias("attempt"), F.max_by("payload", F.struct("available_at", "payload")).alias("payload"))


def last_write(rows: DataFrame, keys: list[str], values: list[str], order: list[str]) -> DataFrame:
    """Latest value per key by map-side aggregation (checkpoints, lane states)."""
    return rows.groupBy(*keys).agg(F.max(F.struct(*order, *values)).alias("_m")).select(*keys, *[F.col(f"_m.{c}").alias(c) for c in (*order, *values)])


def prune(log: DataFrame, at: str, as_of: str, days: int = 90) -> tuple[DataFrame, DataFrame]:
    """Rows within the retention time, and a one-row count of those dropped. Rows without a time stay."""
    old = F.coalesce(F.col(at) < F.expr(f"timestamp_ntz '{as_of}' - interval {days} days"), F.lit(False))
    return log.where(~old), log.agg(F.count_if(old).alias("deleted"))


def backfill(rows: DataFrame, payload: str, paths: dict[str, tuple[str, str]]) -> DataFrame:
    """Typed columns filled from the payload where they are null: column -> (JSON path, type)."""
    return rows.withColumns({c: F.coalesce(F.col(c), F.get_json_object(payload, p).try_cast(kind)) for c, (p, kind) in paths.items()})


def relabel_relations(edges: DataFrame, owners: DataFrame, organizations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Repair of customer edges whose organization is the owner's organizer.

    owners: parent_id, customer_name, organizer_name; organizations: child_id,
    name. Returns edges to insert (organizer, not yet there) and edges to delete
    (customer edges whose organization is not the owner's customer).
    """
    known = edges.where("relation_type = 'customer'").join(organizations, "child_id").join(owners, "parent_id")
    insert = known.where("name = organizer_name").select(F.lit("organizer").alias("relation_type"), "parent_id", "child_id").distinct()
    insert = insert.join(edges, ["relation_type", "parent_id", "child_id"], "left_anti")
    delete = known.where(~F.col("name").eqNullSafe(F.col("customer_name"))).select("relation_type", "parent_id", "child_id")
    return insert, delete


def delete_edges(edges: DataFrame, doomed: DataFrame, keys: list[str]) -> DataFrame:
    return edges.join(doomed.select(*keys).distinct(), keys, "left_anti")


def evolve(table: DataFrame, schema: dict[str, str], *more: DataFrame) -> DataFrame:
    """Tables of older and newer schemas as one, columns widened to the given types."""
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), more, table)
    return whole.select(*[F.col(c).cast(schema[c]).alias(c) if c in schema else F.col(c) for c in whole.columns])


def apply_outcomes(worklist: DataFrame, outcomes: DataFrame, keys: list[str], error_chars: int = 4000) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Next work list, history rows and failure rows of an outcome log.

    outcomes: keys, attempt, outcome (success, failed, retry), retry_at, error, at.
    Only outcomes of an item's current attempt count, and of those of one attempt
    (a log read twice) the latest.
    """
    outcomes = latest_per_key(outcomes, [*keys, "attempt"], [F.desc("at"), "outcome", "retry_at", "error"])
    told = outcomes.select(*keys, F.col("attempt"), "outcome", "retry_at", F.left("error", F.lit(error_chars)).alias("error"), "at")
    met = worklist.join(told, [*keys, "attempt"])
    history = met.where("outcome <> 'retry'").select(*keys, "attempt", "outcome", "error", "at")
    failures = met.where("outcome = 'retry'").select(*keys, "attempt", "error", "at")
    w = worklist.join(met.select(*keys, "outcome", "retry_at", "error"), keys, "left")
    again = F.col("outcome") == "retry"
    left = w.where(F.col("outcome").isNull() | again).select(
        *keys,
        "priority",
        F.when(again, F.col("retry_at")).otherwise(F.col("available_at")).alias("available_at"),
        F.when(again, F.col("attempt") + 1).otherwise(F.col("attempt")).alias("attempt"),
        F.when(again, F.col("error")).otherwise(F.col("last_error")).alias("last_error"),
    )
    return left, history, failures


def split_persisted(edges: DataFrame, entities: DataFrame, end: str) -> tuple[DataFrame, DataFrame]:
    """Distinct edge ends that are persisted, and those only discovered."""
    ends = edges.select(F.col(end).alias("source_entity_id")).distinct()
    have = entities.select("source_entity_id").distinct()
    return ends.join(have, "source_entity_id", "left_semi"), ends.join(have, "source_entity_id", "left_anti")


def hashed(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.withColumn("content_hash", scalars.content_hash(*[F.col(c) for c in columns]))
