"""Streams: incremental ingest, duplicate suppression, lane health, spending and failure windows."""

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tenderlake.operators import merge, worklist
from tenderlake.operators.extraction import Batch
from tenderlake.sources.versions import Store, Transaction
from tenderlake.streaming.tasks import merge_tasks

KEY = ["source", "entity_type", "source_entity_id"]
ENTITIES = "source string, entity_type string, source_entity_id string, payload string, content_hash string, last_success_at timestamp, updated_at timestamp"
RELATIONS = "relation_type string, parent_source string, parent_type string, parent_id string, child_source string, child_type string, child_id string, first_seen_at timestamp, last_seen_at timestamp"
REVISIONS = "source string, entity_type string, source_entity_id string, content_hash string, payload string"
PARENT = ["parent_source", "parent_type", "parent_id"]
EDGE = ["relation_type", *PARENT, "child_source", "child_type", "child_id"]


class ContractViolation(ValueError):
    """A batch that must not be merged."""


def check_batch(entities: DataFrame, edges: DataFrame) -> None:
    """Reject a batch with incomplete keys, empty payloads, or edges that leave the sources of its entities."""
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    keys = reduce(lambda a, b: a | b, [blank(F.col(k)) for k in KEY])
    bad = entities.agg(F.count_if(keys).alias("incomplete key"), F.count_if(F.coalesce("payload", F.lit("{}")).isin("", "{}")).alias("empty payload")).first().asDict()
    ends = reduce(lambda a, b: a | b, [blank(F.col(k)) for k in EDGE])
    bad |= edges.agg(F.count_if(ends).alias("incomplete edge"), F.count_if(~F.col("parent_source").eqNullSafe(F.col("child_source"))).alias("edge between sources")).first().asDict()
    foreign = edges.join(entities.select(F.col("source").alias("parent_source")).distinct(), "parent_source", "left_anti")
    bad["edge of a foreign source"] = foreign.count()
    if any(bad.values()):
        raise ContractViolation(", ".join(f"{n} x {what}" for what, n in bad.items() if n))


def merge_batch(store: Store, entities: DataFrame, edges: DataFrame, stream: str, batch_id: int) -> None:
    """One micro-batch into the versioned tables; a batch that was committed before is skipped.

    entities: KEY, payload, content_hash, fetched_at; edges: EDGE, at. Of equal keys the latest counts.
    A batch that breaks the contract is rejected before anything is written.
    """
    if store.seen(stream, batch_id):
        return
    entities, edges = entities.persist(), edges.persist()  # parsed once for the checks and all tables
    try:
        check_batch(entities, edges)
        _merge(store, entities, edges, stream, batch_id)
    finally:
        entities.unpersist()
        edges.unpersist()


def _merge(store: Store, entities: DataFrame, edges: DataFrame, stream: str, batch_id: int) -> None:
    latest = merge.latest_per_key(entities, KEY, [F.desc("fetched_at"), F.desc("content_hash")])
    new = latest.select(*KEY, "payload", "content_hash", F.col("fetched_at").alias("last_success_at"), F.col("fetched_at").alias("updated_at"))
    fresh = edges.groupBy(*EDGE).agg(F.min("at").alias("first_seen_at"), F.max("at").alias("last_seen_at"))
    parents = latest.select(*[F.col(k).alias(p) for k, p in zip(KEY, PARENT)])

    def build(tx: Transaction) -> None:
        """From the pinned version alone, and again if another stream published meanwhile."""
        for name in ("entities", "relations"):
            tx.whole.add(name)
        old, known = store.read("entities", ENTITIES, tx.pinned), store.read("relations", RELATIONS, tx.pinned)
        gone = merge.vanished_relations(known, fresh, parents, PARENT, EDGE)
        tx.replace("entities", merge.upsert_by_hash(old, new, KEY).drop("change"))
        tx.replace("relations", merge.upsert_relations(merge.delete_edges(known, gone, EDGE), fresh, EDGE))
        tx.append("revisions", merge.revisions(old, new, KEY, ["payload"]))

    store.transact(build, stream, batch_id)


def ingest(records: DataFrame, parse, store: Store, checkpoint: str, stream: str = "ingest", every: str | None = None):
    """Start the ingest stream; ``parse`` turns a batch of records into (entities, edges) or an ``extraction.Batch``.

    A ``Batch`` is judged task by task and goes into all tables (``tasks.merge_tasks``).
    Without ``every`` the stream drains what is there and stops.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        parsed = parse(batch)
        if isinstance(parsed, Batch):
            merge_tasks(store, parsed, stream, batch_id)
        else:
            merge_batch(store, *parsed, stream, batch_id)

    writer = records.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


WORKLIST = "source string, entity_type string, source_entity_id string, priority int, available_at timestamp, attempt int, payload string"


def refresh(store: Store, policies: dict[str, dict], now: str, stream: str, batch_id: int, table: str = "entities") -> None:
    """Enqueue the entities that the policies call due; a batch that was committed before is skipped.

    policies: name (as in ``refresh_candidates``) to older_seconds, newer_seconds, limit and
    priority. The status is the table's, or that of the payload. An entity due twice gets the
    higher priority. Work that another writer queues meanwhile is kept.
    """

    def build(tx: Transaction) -> None:
        entities = store.read(table, None if table in tx.pinned["tables"] else ENTITIES, tx.pinned).withColumn("key", F.concat_ws(":", *KEY))
        own = F.col("status") if "status" in entities.columns else F.get_json_object("payload", "$.status")
        status = entities.select("key", own.alias("status"))
        due = [worklist.refresh_candidates(entities.drop("status"), [status], name, now, p["older_seconds"], p["newer_seconds"], p["limit"], "key").select(*KEY, F.lit(p["priority"]).alias("priority")) for name, p in policies.items()]
        items = reduce(DataFrame.unionByName, due).select("*", F.lit(now).cast("timestamp").alias("available_at"), F.lit("{}").alias("payload"), F.lit(True).alias("refresh_existing"))
        if tx.pinned["tables"].get("worklist", {}).get("kind") == "buckets":
            items = items.persist()  # at most the limits of the policies
            buckets = tx.buckets("worklist", items.select(*KEY))
            if buckets:
                tx.write("worklist", merge.enqueue(tx.read("worklist", buckets), items, entities, KEY), buckets)
            items.unpersist()
        else:
            tx.whole.add("worklist")
            tx.replace("worklist", merge.enqueue(store.read("worklist", WORKLIST, tx.pinned), items, entities, KEY))

    store.transact(build, stream, batch_id)


def periodic(ticks: DataFrame, job, checkpoint: str, every: str | None = None):
    """Run ``job(batch_id)`` for each micro-batch of a stream of ticks (the ``rate`` source, say)."""
    writer = ticks.writeStream.foreachBatch(lambda _, batch_id: job(batch_id)).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def first_arrivals(rows: DataFrame, at: str, keys: list[str], late: str = "10 minutes") -> DataFrame:
    """Rows whose keys (identity and hash) did not arrive within the watermark's reach."""
    return rows.withWatermark(at, late).dropDuplicatesWithinWatermark(keys)


def rolling_spend(log: DataFrame, at: str, cost: str, limit: Column, width: str = "1 hour", slide: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Spend per sliding window and whether it reaches the limit."""
    rows = log.withWatermark(at, late) if log.isStreaming else log
    sums = rows.groupBy(F.window(at, width, slide)).agg(F.sum(F.col(cost).cast("decimal(24,6)")).cast("decimal(24,6)").alias("spent"))
    return sums.select(F.col("window.start").alias("starts_at"), F.col("window.end").alias("ends_at"), "spent", (F.col("spent") >= limit).alias("over"))


def failure_windows(log: DataFrame, at: str, by: list[str], width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Rows per tumbling window and labels."""
    rows = log.withWatermark(at, late) if log.isStreaming else log
    return rows.groupBy(F.window(at, width), *by).agg(F.count("*").alias("n")).select(F.col("window.start").alias("starts_at"), *by, "n")


LANE_STATES = "lane_id string, event_id long, at long, state string, blocks int"  # at: microseconds of the epoch
SECOND = 1_000_000


class Lane:
    """closed -> open after ``threshold`` blocks in a row -> half-open after the cooldown -> closed or open again.

    Times and the cooldown have one unit.
    """

    def __init__(self, threshold: int = 3, cooldown: float = 600, state: str = "closed", blocks: int = 0, opened: float = 0):
        self.threshold, self.cooldown, self.state, self.blocks, self.opened = threshold, cooldown, state, blocks, opened

    def cools(self, until: float | None = None) -> bool:
        """Whether the cooldown of an open lane ends by then (some day, without ``until``); if so the lane is half-open."""
        if self.state != "open" or (until is not None and until - self.opened < self.cooldown):
            return False
        self.state = "half_open"
        return True

    def take(self, at: float, blocked: bool) -> str:
        self.cools(at)
        if self.state == "open":
            return "refused"
        if not blocked:
            self.state, self.blocks = "closed", 0
        else:
            self.blocks += 1
            if self.state == "half_open" or self.blocks >= self.threshold:
                self.state, self.opened = "open", at
        return self.state


class LaneRows:
    """Output rows of one lane after another, by column."""

    def __init__(self, ends: bool):
        self.ends, self.rows = ends, []

    def cool(self, key: str, lane: Lane, until: int | None = None) -> None:
        if lane.cools(until) and self.ends:
            self.rows.append((key, None, lane.opened + lane.cooldown, "half_open", lane.blocks))

    def take(self, key: str, lane: Lane, at: int, event_id: int, blocked: bool) -> None:
        self.cool(key, lane, at)
        self.rows.append((key, event_id, at, lane.take(at, blocked), lane.blocks))

    def frame(self) -> pd.DataFrame:
        out, self.rows = self.rows, []
        columns = list(zip(*out)) if out else [()] * 5
        kinds = {"lane_id": object, "event_id": "Int64", "at": "int64", "state": object, "blocks": "int32"}
        return pd.DataFrame({c: pd.Series(x, dtype=k) for (c, k), x in zip(kinds.items(), columns)})


def _lane_input(events: DataFrame, *more: str) -> DataFrame:
    blocked = F.coalesce("blocked", F.lit(False)).alias("blocked")
    return events.where("lane_id is not null and ts is not null").select("lane_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"), "event_id", blocked, *more)


def _lane_output(rows: DataFrame) -> DataFrame:
    return rows.select("lane_id", "event_id", F.timestamp_micros("at").alias("ts"), "state", "blocks")


def lane_history(events: DataFrame, threshold: int = 3, cooldown: float = 600.0, ends: bool = False) -> DataFrame:
    """State after every event of each lane (batch): lane_id, event_id, ts, state, blocks.

    events: lane_id, ts, event_id, blocked. Events arriving while a lane is open are refused;
    events of one time count in the order of their ids. Rows without a lane or a time take no
    part, a null ``blocked`` is false. With ``ends`` every end of a cooldown is a row of its own,
    without an event_id. An empty table has no rows.
    """
    wait = round(cooldown * SECOND)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, lane, out = None, Lane(threshold, wait), LaneRows(ends)
        for frame in frames:
            for e in frame.itertuples():
                if e.lane_id != key:
                    out.cool(key, lane)
                    key, lane = e.lane_id, Lane(threshold, wait)
                out.take(key, lane, e.at, None if pd.isna(e.event_id) else e.event_id, e.blocked)
            yield out.frame()
        out.cool(key, lane)
        yield out.frame()

    # lanes pass by in order, a batch of rows at a time; only the state of the current lane is kept
    rows = _lane_input(events)
    return _lane_output(rows.repartition("lane_id").sortWithinPartitions("lane_id", "at", "event_id", "blocked").mapInPandas(run, LANE_STATES))


class LaneProcessor(StatefulProcessor):
    """Holds the events of a lane until the watermark has passed them, then takes them in order.

    A timer is set for the earliest event held and, while the lane is open, for the end of
    its cooldown, so that the lane turns half-open without waiting for an event.
    """

    def __init__(self, threshold: int, wait: int, ends: bool):
        self.threshold, self.wait, self.ends = threshold, wait, ends

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("lane", "state string, blocks int, opened long")
        self.held = handle.getListState("held", "at long, event_id long, blocked boolean")

    def wake(self, at: int) -> None:
        self.handle.registerTimer(-(-at // 1000))  # the first millisecond that is not before it

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            ids = [None if pd.isna(x) else int(x) for x in frame["event_id"]]
            self.held.appendList([(int(at), i, bool(b)) for at, i, b in zip(frame["at"], ids, frame["blocked"])])
            self.wake(int(frame["at"].min()))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        held = list(self.held.get())
        ready = sorted((x for x in held if x[0] <= passed), key=lambda x: (x[0], x[1] is not None, x[1] or 0, x[2]))
        later = [x for x in held if x[0] > passed]
        lane = Lane(self.threshold, self.wait, *(self.kept.get() if self.kept.exists() else ("closed", 0, 0)))
        was, out = lane.state, LaneRows(self.ends)
        for at, event_id, blocked in ready:
            out.take(key[0], lane, at, event_id, blocked)
        out.cool(key[0], lane, passed)
        if ready:
            if later:
                self.held.put(later)
                self.wake(min(later)[0])
            else:
                self.held.clear()
        if ready or lane.state != was:
            self.kept.update((lane.state, int(lane.blocks), int(lane.opened)))
            if lane.state == "open":
                self.wake(lane.opened + self.wait)
        yield out.frame()

    def close(self) -> None:
        pass


def lane_stream(events: DataFrame, threshold: int = 3, cooldown: float = 600.0, late: str = "10 minutes", ends: bool = False) -> DataFrame:
    """``lane_history`` over a stream, in event time; needs the RocksDB state store.

    An event leaves once the watermark (``late`` behind the latest event of any lane) has passed
    it, so rows may arrive in any order within ``late``; later ones are dropped.
    """
    rows = _lane_input(events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late), "ts")
    processor = LaneProcessor(threshold, round(cooldown * SECOND), ends)
    return _lane_output(rows.groupBy("lane_id").transformWithStateInPandas(processor, LANE_STATES, "Append", "EventTime"))
