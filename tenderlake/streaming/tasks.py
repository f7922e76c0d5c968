"""Batches of tasks into the store: judged one by one, merged together, all tables in one version.

A task that breaks the contract goes to the log of rejects and back to the work
list; the others of its batch are merged. From one parsed batch follow the registry
(entities, both ends of edges, discovered items), the entities with their revisions,
the children of changed owners, the relations, the work list and the task history.
Tables are bucketed by the identity that they are merged on (relations by the
parent), so a batch reads and writes the buckets of its own keys only.
"""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlake.functions import scalars
from tenderlake.operators import extraction as X
from tenderlake.operators import merge
from tenderlake.sources.versions import Store, Transaction

KEY, NAMED = X.KEY, ["business_number", "canonical_url"]
PARENT, CHILD = ["parent_source", "parent_type", "parent_id"], ["child_source", "child_type", "child_id"]
EDGE = ["relation_type", *PARENT, *CHILD]
ENTITY = {"procurements": X.FIELDS, "organizations": X.PERSON}

#: bucketed tables: columns and key
TABLES = {
    "registry": (f"{X.KEYS}, {X.NAMED}, summary_payload string, first_seen_at timestamp, last_seen_at timestamp, last_success_at timestamp, current_content_hash string", KEY),
    "procurements": (f"{X.KEYS}, {X.FIELDS}, {X.STATE}, last_success_at timestamp, updated_at timestamp", KEY),
    "organizations": (f"{X.KEYS}, {X.PERSON}, {X.STATE}, last_success_at timestamp, updated_at timestamp", KEY),
    "delivery_places": (X.FRAMES["delivery_places"], KEY),
    "payment_terms": (X.FRAMES["payment_terms"], KEY),
    "documents": (X.FRAMES["documents"], KEY),
    "relations": (f"{X.EDGE}, source_payload string, first_seen_at timestamp, last_seen_at timestamp", PARENT),
    "worklist": (f"{X.KEYS}, priority int, available_at timestamp, attempt int, payload string", KEY),
}
REJECTS = f"{X.KEYS}, task bigint, reason string, stream string, batch_id bigint, at timestamp"
HISTORY = f"{X.KEYS}, task bigint, outcome string, error string, content_hash string, finished_at timestamp"
REVISIONS = f"{X.KEYS}, content_hash string, payload string, at timestamp"


def define_tables(store: Store, buckets: int = 64) -> None:
    """Make the tables that are not there yet; a bucket should hold some 100 MB at most."""
    there = store.pointer()["tables"]
    for name, (schema, key) in TABLES.items():
        if name not in there:
            store.define(name, schema, key, buckets)


def judged(batch: X.Batch) -> DataFrame:
    """Every task with the reason for which it is rejected (null for a good one).

    In order: not exactly one entity with the task's identity (``primary``), an identity
    twice (``duplicate``), an entity, edge end or discovered item of another source
    (``source``), a primary without payload (``payload``), an incomplete identity (``key``).
    """
    f, blank = batch.frames, lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    key = lambda names: F.struct(*[F.col(c).alias(k) for c, k in zip(names, KEY)]).alias("key")
    entities = [f[n].select("task", F.lit("entity").alias("role"), key(KEY), F.col("source_payload").alias("payload")) for n in ENTITY]
    ends = [f["relations"].select("task", F.lit("end").alias("role"), key(end), F.lit(None).cast("string").alias("payload")) for end in (PARENT, CHILD)]
    found = f["discovered"].select("task", F.lit("item").alias("role"), key(KEY), F.lit(None).cast("string").alias("payload"))
    said = reduce(DataFrame.unionByName, [*entities, *ends, found])
    tasks = f["tasks"].withColumn("own", key(KEY))
    met = tasks.select("task", "own").join(said, "task")
    entity, primary = F.col("role") == "entity", (F.col("role") == "entity") & (F.col("key") == F.col("own"))
    counts = met.groupBy("task").agg(
        F.count_if(primary).alias("primaries"),
        F.count_if(entity).alias("n"),
        F.count_distinct(F.when(entity, F.col("key"))).alias("keys"),
        F.count_if(~F.col("key.source").eqNullSafe(F.col("own.source"))).alias("foreign"),
        F.count_if(primary & (blank(F.col("payload")) | (F.trim("payload") == "{}"))).alias("empty"),
        F.count_if(reduce(lambda a, b: a | b, [blank(F.col(f"key.{k}")) for k in KEY])).alias("incomplete"),
    )
    reason = F.when(F.coalesce("primaries", F.lit(0)) != 1, "primary").when(F.col("keys") < F.col("n"), "duplicate").when(F.col("foreign") > 0, "source").when(F.col("empty") > 0, "payload").when(F.col("incomplete") > 0, "key")
    return tasks.join(counts, "task", "left").select("task", *KEY, "fetched_at", reason.alias("reason"))


def identities(f: dict[str, DataFrame]) -> DataFrame:
    """What a batch knows of every identity: entities, both ends of edges, discovered items."""
    null = F.lit(None).cast("string")
    parts = [f[n].select(*KEY, *NAMED, F.lit("{}").alias("summary_payload"), F.col("fetched_at").alias("at"), F.col("fetched_at").alias("success"), "content_hash", F.lit(1).alias("rank")) for n in ENTITY]
    for end in (PARENT, CHILD):
        parts.append(f["relations"].select(*[F.col(c).alias(k) for c, k in zip(end, KEY)], null.alias("business_number"), null.alias("canonical_url"), F.lit("{}").alias("summary_payload"), "at", F.lit(None).cast("timestamp").alias("success"), null.alias("content_hash"), F.lit(0).alias("rank")))
    parts.append(f["discovered"].select(*KEY, *NAMED, F.col("payload").alias("summary_payload"), F.col("available_at").alias("at"), F.lit(None).cast("timestamp").alias("success"), null.alias("content_hash"), F.lit(0).alias("rank")))
    # what a fetched entity says of itself comes before what others say, then the latest; ties by value
    last = lambda c, *more: F.max_by(c, F.when(F.col(c).isNotNull(), F.struct("rank", "at", c))).alias(c)
    return reduce(DataFrame.unionByName, parts).groupBy(*KEY).agg(
        last("business_number"),
        last("canonical_url"),
        F.max_by("summary_payload", F.when(F.col("summary_payload") != "{}", F.struct("at", "summary_payload"))).alias("summary_payload"),
        F.min("at").alias("first_seen_at"),
        F.max("at").alias("last_seen_at"),
        F.max("success").alias("last_success_at"),
        F.max_by("content_hash", F.when(F.col("content_hash").isNotNull(), F.struct("at", "content_hash"))).alias("current_content_hash"),
    )


def merge_tasks(store: Store, batch: X.Batch, stream: str, batch_id: int, retry_seconds: int = 300) -> None:
    """One micro-batch into all tables; a batch that was committed before is skipped.

    Of an identity in several tasks the latest counts. Children follow their owner: they are
    replaced where its hash changed, and come from the same task. Rejected tasks are logged and due
    again after ``retry_delay``.
    """
    if store.seen(stream, batch_id):
        return
    define_tables(store)
    folders = batch.folders

    def hold(rows: DataFrame) -> DataFrame:
        """Computed once; what follows has a short plan."""
        return X.stored(rows, folders)

    try:
        frames = {n: hold(rows) for n, rows in batch.frames.items()}
        verdicts = hold(judged(X.Batch(frames)))
        bad = verdicts.where("reason is not null")
        some = verdicts.agg(F.count_if(F.col("reason").isNotNull()).alias("bad"), F.count_if(F.col("reason").isNull()).alias("good")).first()
        good = {n: rows.join(bad.select("task"), "task", "left_anti") for n, rows in frames.items()} if some["bad"] else frames
        latest = {n: merge.latest_per_key(good[n], KEY, [F.desc("fetched_at"), F.desc("content_hash"), "task"]) for n in ENTITY}
        known = hold(identities(good)) if some["good"] else None
        edges = good["relations"].groupBy(*EDGE).agg(F.max_by("source_payload", F.struct("at", "source_payload")).alias("source_payload"), F.min("at").alias("first_seen_at"), F.max("at").alias("last_seen_at"))

        def build(tx: Transaction) -> None:
            if some["good"]:
                upsert(tx)
                reconcile(tx)
            queue(tx)
            if some["bad"]:
                tx.append("rejects", store.spark.createDataFrame([], REJECTS).unionByName(bad.select(*KEY, "task", "reason", F.lit(stream).alias("stream"), F.lit(batch_id).cast("bigint").alias("batch_id"), F.col("fetched_at").alias("at"))))
            if some["bad"] or some["good"]:
                hashes = good["procurements"].select("task", *KEY, "content_hash").unionByName(good["organizations"].select("task", *KEY, "content_hash"))
                finished = verdicts.join(hashes, ["task", *KEY], "left").select(*KEY, "task", F.when(F.col("reason").isNull(), "success").otherwise("retry").alias("outcome"), F.col("reason").alias("error"), "content_hash", F.col("fetched_at").alias("finished_at"))
                tx.append("history", store.spark.createDataFrame([], HISTORY).unionByName(finished))

        def upsert(tx: Transaction) -> None:
            """Registry, entities, revisions and children."""
            buckets = tx.buckets("registry", known.select(*KEY))
            tx.write("registry", merge.upsert_registry(tx.read("registry", buckets), known, KEY, ("last_success_at", "current_content_hash")), buckets)
            for name, fields in ENTITY.items():
                new = latest[name].drop("task", *NAMED).withColumns({"last_success_at": F.col("fetched_at"), "updated_at": F.col("fetched_at")})
                buckets = tx.buckets(name, new.select(*KEY))
                if not buckets:
                    continue
                old = tx.read(name, buckets)
                fresh = hold(merge.upsert_by_hash(old, new, KEY))
                tx.write(name, fresh.drop("change"), buckets)
                changed = fresh.where("change in ('new', 'changed')").select(*KEY, "change", "updated_at")
                replaced = changed.where("change = 'changed'")
                if replaced.limit(1).count():
                    was = merge.revisions(old, new, KEY, X.names(f"{fields}, {X.STATE}"))
                    tx.append("revisions", was.join(replaced.select(*KEY, F.col("updated_at").alias("at")), KEY))
                if name != "procurements":
                    continue
                winners = latest[name].select("task", *KEY).join(changed.select(*KEY), KEY)
                buckets = tx.buckets("documents", changed.select(*KEY))  # children of all kinds are dealt alike
                for child in X.CHILDREN if buckets else ():
                    rows = good[child].join(winners, ["task", *KEY], "left_semi").drop("task")
                    tx.write(child, merge.replace_children(tx.read(child, buckets), rows, changed, KEY), buckets)

        def reconcile(tx: Transaction) -> None:
            """Edges of the batch; those that its entities no longer have vanish."""
            parents = reduce(DataFrame.unionByName, [latest[n].select(*[F.col(k).alias(p) for k, p in zip(KEY, PARENT)]) for n in ENTITY])
            buckets = tx.buckets("relations", parents.unionByName(edges.select(*PARENT)))
            old = tx.read("relations", buckets)
            gone = merge.vanished_relations(old, edges, parents, PARENT, EDGE)
            seen = merge.delete_edges(old, gone, EDGE).unionByName(edges)
            tx.write("relations", seen.groupBy(*EDGE).agg(F.max_by("source_payload", F.struct("last_seen_at", "source_payload")).alias("source_payload"), F.min("first_seen_at").alias("first_seen_at"), F.max("last_seen_at").alias("last_seen_at")), buckets)

        def queue(tx: Transaction) -> None:
            """Discovered items come in, finished tasks leave, rejected ones wait for their next attempt."""
            told = verdicts.groupBy(*KEY).agg(F.max_by("reason", F.struct("fetched_at", "task")).alias("reason"), F.max("fetched_at").alias("told_at"))
            buckets = tx.buckets("worklist", good["discovered"].select(*KEY).unionByName(verdicts.select(*KEY)))
            if not buckets:
                return
            work = tx.read("worklist", buckets)
            if some["good"]:
                items = good["discovered"].select(*KEY, "priority", "available_at", "payload", "refresh_existing")
                work = merge.enqueue(work, items, tx.written("registry").where("last_success_at is not null"), KEY)
            waiting = told.where("reason is not null").select(*KEY, F.lit(0).alias("priority"), F.col("told_at").alias("available_at"), F.lit(0).alias("attempt"), F.lit("{}").alias("payload"))
            rows = work.unionByName(waiting.join(work.select(*KEY), KEY, "left_anti")).join(told, KEY, "left").where("told_at is null or reason is not null")
            again, attempt = F.col("told_at").isNotNull(), F.col("attempt") + 1
            later = F.col("told_at") + F.make_dt_interval(secs=scalars.retry_delay(attempt, retry_seconds))
            tx.write("worklist", rows.select(*KEY, "priority", F.when(again, later).otherwise(F.col("available_at")).alias("available_at"), F.when(again, attempt).otherwise(F.col("attempt")).alias("attempt"), "payload"), buckets)

        store.transact(build, stream, batch_id)
    finally:
        batch.discard()


def replay_into(store: Store, rows: DataFrame, stream: str = "", batch_id: int = -1) -> int:
    """Replay records (``landing.replay_records``) of lots into registry and entities; returns how many were staged.

    Of a lot the latest record counts (ties by hash), and only where it is newer than what the store has.
    Rows whose hash differs replace the stored one, which becomes a revision; the buckets of lots that a file
    does not change are neither written nor, if there are none, is a version published.
    """
    define_tables(store)
    folders: list[str] = []
    staged = X.stored(rows.withColumn("entity_type", F.lit("lot")), folders)  # the file is read once
    try:
        total = staged.count()
        latest = merge.latest_per_key(staged, KEY, [F.desc("fetched_at"), F.desc("content_hash")])

        def build(tx: Transaction) -> None:
            buckets = tx.buckets("registry", latest.select(*KEY))
            known = tx.read("registry", buckets)
            seen = known.select(*KEY, "last_success_at", F.col("current_content_hash").alias("_hash"))
            fresh = latest.join(seen, KEY, "left").where("last_success_at is null or fetched_at > last_success_at or (fetched_at = last_success_at and not content_hash <=> _hash)").drop("last_success_at", "_hash")
            fresh = X.stored(fresh, folders)
            buckets = tx.buckets("registry", fresh.select(*KEY))
            if not buckets:
                return
            ids = fresh.select(*KEY, *NAMED, F.lit("{}").alias("summary_payload"), F.col("fetched_at").alias("first_seen_at"), F.col("fetched_at").alias("last_seen_at"), F.col("fetched_at").alias("last_success_at"), F.col("content_hash").alias("current_content_hash"))
            tx.write("registry", merge.upsert_registry(tx.read("registry", buckets), ids, KEY, ("last_success_at", "current_content_hash")), buckets)
            old, new = tx.read("procurements", buckets), fresh.select(*KEY, "title_ru", "title_kk", "status", "source_payload", "content_hash", "fetched_at", F.col("fetched_at").alias("last_success_at"), F.col("fetched_at").alias("updated_at"))
            stored = new.join(old.drop(*[c for c in new.columns if c not in KEY]), KEY, "left").select(*old.columns)  # fields that a replay does not have stay
            tx.write("procurements", merge.upsert_by_hash(old, stored, KEY).drop("change"), buckets)
            was = merge.revisions(old, new, KEY, X.names(f"{X.FIELDS}, {X.STATE}"))
            if was.limit(1).count():
                tx.append("revisions", was.join(fresh.select(*KEY, F.col("fetched_at").alias("at")), KEY))

        if total:
            store.transact(build, stream, batch_id)
        return total
    finally:
        X.discard(store.spark, folders)


def datasets(store: Store, pinned: dict | None = None, zone: str = scalars.PORTAL_ZONE) -> dict[str, DataFrame]:
    """The eight export datasets of one version of the store."""
    pinned = pinned or store.pointer()
    table = lambda name: store.read(name, TABLES[name][0], pinned)
    registry = table("registry")
    named = registry.select(*KEY, *NAMED)
    times = ("published_at", "application_start_at", "application_end_at")
    local = {f"{c}_local": scalars.local_time(F.col(c), zone) for c in times} | {"source_timezone": F.lit(zone)}
    procurements = table("procurements").join(named, KEY).withColumns(local)
    kind = lambda name: procurements.where(F.col("entity_type") == name)
    known = registry.select(*KEY)
    ends = table("relations").join(known.toDF(*PARENT), PARENT, "left_semi").join(known.toDF(*CHILD), CHILD, "left_semi")
    children = {n: table(n).join(known, KEY, "left_semi") for n in X.CHILDREN}
    return {"lots": kind("lot"), "notices": kind("notice"), "plan_items": kind("plan_item"), "organizations": table("organizations").join(named, KEY), "relations": ends, **children}
