"""Raw records of both portals to batches: what each fetched page or document says, in the tables of the store.

A record is a task: the fetch of one entity. Every frame of a ``Batch`` carries the
task's number, so that a task can be judged, kept or rejected as a whole.
"""

import tempfile
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.functions import scalars
from tenderlake.operators import html_pages as html
from tenderlake.operators import json_docs as docs

KEY = ["source", "entity_type", "source_entity_id"]
KEYS = "source string, entity_type string, source_entity_id string"
NAMED = "business_number string, canonical_url string"
FIELDS = """title_ru string, title_kk string, description_ru string, description_kk string, additional_characteristics_ru string, additional_characteristics_kk string,
status string, procurement_method string, tru_code string, oktru_code string, oktru_category_ru string, oktru_category_kk string, plan_row_number string, priority string,
procurement_year int, procurement_month string, plan_item_type string, quantity decimal(24,6), unit string, unit_price decimal(24,6), total_amount decimal(24,6), currency string,
published_at timestamp, application_start_at timestamp, application_end_at timestamp, delivery_terms_ru string, delivery_terms_kk string, delivery_conditions_ru string,
delivery_conditions_kk string, venue_ru string, venue_kk string, contact_email string, contact_phone string, contact_extension string""".replace("\n", " ")
PERSON = "name_ru string, name_kk string, bin string, address string, phone string, email string"
STATE = "source_payload string, content_hash string, fetched_at timestamp"
EDGE = "relation_type string, parent_source string, parent_type string, parent_id string, child_source string, child_type string, child_id string"

#: columns of a batch's frames; each has the task's number besides
FRAMES = {
    "tasks": f"{KEYS}, fetched_at timestamp",
    "procurements": f"{KEYS}, {NAMED}, {FIELDS}, {STATE}",
    "organizations": f"{KEYS}, {NAMED}, {PERSON}, {STATE}",
    "delivery_places": f"{KEYS}, source_row_id string, country string, address string, quantity decimal(24,6), incoterms string, source_payload string",
    "payment_terms": f"{KEYS}, prepayment_percent decimal(8,3), interim_percent decimal(8,3), final_percent decimal(8,3), raw_text string",
    "documents": f"{KEYS}, source_document_id string, category string, filename string, extension string, url string, size_bytes bigint, uploaded_at timestamp, document_hash string, declared_content_type string, inferred_content_type string, response_content_type string, source_payload string",
    "relations": f"{EDGE}, source_payload string, at timestamp",
    "discovered": f"{KEYS}, {NAMED}, priority int, available_at timestamp, refresh_existing boolean, payload string",
}
CHILDREN = ("delivery_places", "payment_terms", "documents")


def names(schema: str) -> list[str]:
    """Column names of a schema text."""
    flat = schema.replace("(24,6)", "").replace("(8,3)", "")
    return [c.split()[0] for c in flat.split(",")]


def shaped(rows: DataFrame, name: str) -> DataFrame:
    """The columns of a batch's frame; missing ones are null."""
    kinds = dict(c.split() for c in FRAMES[name].replace("(24,6)", "(24;6)").replace("(8,3)", "(8;3)").split(","))
    kinds = {"task": "bigint"} | {c: k.replace(";", ",") for c, k in kinds.items()}
    return rows.select(*[(F.col(c) if c in rows.columns else F.lit(None)).cast(k).alias(c) for c, k in kinds.items()])


_own: list[str] = []


def scratch_folder(spark: SparkSession) -> str:
    """A new folder below that of ``spark.checkpoint.dir``; only where Spark is this process alone may it be this machine's."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if not _own:
            _own.append("file://" + tempfile.mkdtemp(prefix="tenderlake-"))
        folder = _own[0]
    return f"{folder.rstrip('/')}/batch-{uuid.uuid4().hex}"


@dataclass
class Batch:
    """Frames named as in ``FRAMES``; ``folders`` hold what was parsed, until ``discard``."""

    frames: dict[str, DataFrame]
    folders: list[str] = field(default_factory=list)

    def __post_init__(self):
        spark = self.frames["tasks"].sparkSession
        self.frames = {n: shaped(self.frames.get(n, spark.createDataFrame([], "task bigint")), n) for n in FRAMES}

    def union(self, other: "Batch") -> "Batch":
        return Batch({n: self.frames[n].unionByName(other.frames[n]) for n in FRAMES}, [*self.folders, *other.folders])

    def discard(self) -> None:
        discard(self.frames["tasks"].sparkSession, self.folders)


def discard(spark: SparkSession, folders: list[str]) -> None:
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(rows: DataFrame, folders: list[str]) -> DataFrame:
    """Rows parsed once, for all frames of a batch: written and read back, so that these have short plans."""
    folders.append(scratch_folder(rows.sparkSession))
    rows.write.parquet(folders[-1])
    return rows.sparkSession.read.schema(rows.schema).parquet(folders[-1])


def as_tasks(records: DataFrame) -> DataFrame:
    """Records with their number, a hash of identity, time and body; equal records are one."""
    numbered = records.withColumn("task", F.xxhash64(*KEY, F.col("fetched_at").cast("string"), "body"))
    return numbered.dropDuplicates(["task"])


def html_batch(records: DataFrame, base: str, source: str) -> Batch:
    """Detail pages of the HTML portal."""
    made: list[str] = []
    own = stored(as_tasks(records.where(F.col("source") == source)), made)
    parsed = stored(html.parse_pages(own.select("task", "body"), "task", "body"), made)
    at = own.select(F.col("task").alias("page_id"), "entity_type", "source_entity_id", F.lit(None).cast("string").alias("business_number"))
    tasks = own.select("task", *KEY, "fetched_at", "url")
    detail = stored(html.detail_entities(parsed, at, base, source), made).withColumn("source", F.lit(source)).withColumnRenamed("page_id", "task")
    # what stands in the page's tables (places, documents) is part of its state
    tables = parsed.select(F.col("page_id").alias("task"), F.to_json("tables").alias("_tables"))
    detail = detail.join(tasks.select("task", "fetched_at", F.col("url").alias("canonical_url")), "task").join(tables, "task")
    detail = detail.withColumn("content_hash", scalars.content_hash(F.col("content_hash"), F.col("_tables")))
    person = detail.where("entity_type = 'organization'").withColumnsRenamed({"title_ru": "name_ru", "title_kk": "name_kk"})
    owner = detail.select("task", *KEY)
    owned = lambda rows: rows.withColumnRenamed("page_id", "task").join(owner, "task")
    links = html.page_links(parsed, at.drop("business_number"), base, source).withColumnRenamed("page_id", "task").join(tasks.select("task", "fetched_at"), "task")
    ends = lambda kind, parent, child: [F.lit(source).alias("parent_source"), F.col("entity_type").alias("parent_type"), F.col("source_entity_id").alias("parent_id"), F.lit(kind).alias("relation_type"), F.lit(source).alias("child_source"), F.lit("organization").alias("child_type"), F.col(child).alias("child_id")]
    edges = links.where("relation_type is not null").select("task", "relation_type", F.lit(source).alias("parent_source"), "parent_type", "parent_id", F.lit(source).alias("child_source"), "child_type", "child_id", F.col("fetched_at").alias("at"))
    for kind in ("customer", "organizer"):
        edges = edges.unionByName(detail.where(f"entity_type <> 'organization' and {kind}_id is not null").select("task", *ends(kind, None, f"{kind}_id"), F.col("fetched_at").alias("at")))
    return Batch(
        {
            "tasks": tasks,
            "procurements": detail.where("entity_type <> 'organization'"),
            "organizations": person,
            "delivery_places": owned(html.delivery_places(parsed)),
            "documents": owned(html.page_documents(parsed, base)),
            "payment_terms": detail.where("payment_raw_text is not null and entity_type <> 'organization'").withColumn("raw_text", F.col("payment_raw_text")),
            "relations": edges.withColumn("source_payload", F.lit("{}")),
            "discovered": links.select("task", F.lit(source).alias("source"), F.col("child_type").alias("entity_type"), F.col("child_id").alias("source_entity_id"), "business_number", "canonical_url", "priority", F.col("fetched_at").alias("available_at"), F.lit(False).alias("refresh_existing"), F.lit("{}").alias("payload")),
        },
        made,
    )


def json_batch(records: DataFrame, base: str, source: str, types: tuple[str, ...] = ("lot", "notice", "plan_item")) -> Batch:
    """Detail documents of the JSON portal."""
    made: list[str] = []
    own = stored(as_tasks(records.where(F.col("source") == source).withColumn("body", docs.wrap(F.col("body")))), made)
    tasks, keep = own.select("task", *KEY, "fetched_at"), ("task", "source", "fetched_at")
    there = {r[0] for r in own.select("entity_type").where(F.col("entity_type").isin(*types)).distinct().collect()}
    # records of no known type are tasks without an entity
    parts = [Batch({"tasks": tasks.where(~F.coalesce(F.col("entity_type").isin(*types), F.lit(False)))}, made)]
    for kind in [k for k in types if k in there]:
        one = own.where(F.col("entity_type") == kind).withColumn("given", F.col("source_entity_id"))
        detail = docs.detail_entities(one, "body", kind, base, "given", keep)
        detail = stored(detail, made)
        people = detail.select("task", "source", "fetched_at", F.explode(F.array_compact(F.array("customer", "organizer"))).alias("o")).groupBy("task", "source", "fetched_at", F.col("o.source_entity_id").alias("id")).agg(F.first("o").alias("o"))
        people = people.select("task", "source", "fetched_at", F.lit("organization").alias("entity_type"), "o.*")
        hashed = [F.col(c) for c in ("name_ru", "name_kk", "bin", "address", "phone", "email", "business_number")]
        edges = docs.detail_relations(one, "body", kind, base, ("task", "source", "fetched_at"))
        parent, child = (F.when(F.col("relation_type") == "notice_to_lot", x).otherwise(y) for x, y in (("notice", kind), ("lot", "organization")))
        edges = edges.select("task", "relation_type", F.col("source").alias("parent_source"), parent.alias("parent_type"), "parent_id", F.col("source").alias("child_source"), child.alias("child_type"), "child_id", F.lit("{}").alias("source_payload"), F.col("fetched_at").alias("at"))
        notices = edges.where("relation_type = 'notice_to_lot'").select("task", F.col("parent_source").alias("source"), F.lit("notice").alias("entity_type"), F.col("parent_id").alias("source_entity_id"), docs.canonical_url("notice", F.col("parent_id"), base).alias("canonical_url"), F.lit(10).alias("priority"), F.col("at").alias("available_at"), F.lit(False).alias("refresh_existing"), F.lit("{}").alias("payload"))
        places = detail.select("task", *KEY, F.inline("delivery_places")).withColumn("source_payload", F.lit("{}"))
        terms = detail.select("task", *KEY, "payment_terms.*").where("coalesce(prepayment_percent, interim_percent, final_percent) is not null or raw_text is not null")
        files = stored(docs.documents(one, "task", "body", base), made).withColumn("task", F.col("key").cast("bigint")).join(detail.select("task", *KEY), "task")
        listed = files.groupBy("task").agg(F.to_json(F.array_sort(F.collect_list(F.struct("identity_key", "filename", "size_bytes", "document_hash", "url")))).alias("_files"))  # of one body
        detail = detail.join(listed, "task", "left").withColumn("content_hash", scalars.content_hash(F.col("content_hash"), F.col("_files")))
        parts.append(
            Batch(
                {
                    "tasks": tasks.where(F.col("entity_type") == kind),
                    "procurements": detail,
                    "organizations": people.withColumn("content_hash", scalars.content_hash(*hashed)),
                    "delivery_places": places,
                    "payment_terms": terms,
                    "documents": files,
                    "relations": edges,
                    "discovered": notices,
                },
            )
        )
    return reduce(Batch.union, parts)
