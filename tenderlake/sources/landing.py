"""Sources: raw pages, raw JSON, replay records, operational logs, CSV files; batch readers and their stream twins."""

import csv
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.operators.json_docs import wrap

RAW = "source string, entity_type string, source_entity_id string, url string, fetched_at timestamp, http_status int, body string"
REPLAY = "source string, source_entity_id string, business_number string, canonical_url string, title_ru string, title_kk string, status string, source_payload string, content_hash string, fetched_at string"
TASK_HISTORY = "source string, entity_type string, source_entity_id string, task_type string, outcome string, error string, content_hash string, finished_at timestamp"
FETCH_FAILURES = "source string, entity_type string, source_entity_id string, strategy string, http_status int, error string, created_at timestamp"
CHALLENGES = "provider string, status string, cost decimal(12,6), latency_ms int, created_at timestamp"


def raw_pages(spark: SparkSession, folder: str, stream: bool = False, at_once: int = 1000, archive: str | None = None) -> DataFrame:
    """Whole files of a landing folder as (path, body).

    As a stream, ``at_once`` files make a batch; with ``archive`` files that were read move there.
    """
    reader = spark.readStream.option("maxFilesPerTrigger", at_once) if stream else spark.read
    if stream and archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.text(folder, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("body"))


def raw_records(spark: SparkSession, folder: str, stream: bool = False) -> DataFrame:
    """Raw records landed as Parquet."""
    reader = spark.readStream if stream else spark.read
    return reader.schema(RAW).parquet(folder)


def json_objects(records: DataFrame, body: str = "body") -> DataFrame:
    """Records whose body is an object; other JSON is wrapped under ``data``."""
    return records.withColumn(body, wrap(F.col(body)))


def replay_records(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines with an ISO time (text or timestamp) and a payload as object or text; rows without a readable time are dropped."""
    rows = spark.read.schema(REPLAY).json(path)
    return rows.withColumn("fetched_at", F.col("fetched_at").try_cast("timestamp")).where("fetched_at is not null")


def log_events(spark: SparkSession, path: str, schema: str, stream: bool = False) -> DataFrame:
    """Operational log in JSON lines; lines that are no JSON keep their text in ``_broken``."""
    reader = spark.readStream if stream else spark.read
    return reader.schema(f"{schema}, _broken string").option("columnNameOfCorruptRecord", "_broken").json(path)


def append_log(rows: DataFrame, folder: str, at: str) -> None:
    """Append rows to a log table partitioned by day."""
    rows.withColumn("day", F.to_date(at)).write.mode("append").partitionBy("day").parquet(folder)


def csv_delimiter(spark: SparkSession, path: str) -> str:
    """';' if the header line has more of them than commas."""
    header = (spark.read.text(path).first() or [""])[0]
    return ";" if header.count(";") > header.count(",") else ","


def csv_rows(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """Cells of a CSV file with quoted line feeds, and its header; ``_broken`` holds rows of a different width."""
    sep = csv_delimiter(spark, path)
    reader = spark.read.option("header", True).option("sep", sep).option("multiLine", True).option("quote", '"').option("escape", '"')
    names = reader.csv(path).columns
    names = [n.lstrip("﻿") for n in names]
    schema = ", ".join(f"`{n}` string" for n in names) + ", _broken string"
    return reader.schema(schema).option("enforceSchema", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_broken").csv(path), names


HEAD_BYTES = 1 << 20  #: within which a header line must end


@dataclass(frozen=True)
class CsvHead:
    """What the first line of a CSV file tells: the mark before it, its delimiter and the columns (none in an empty file)."""

    path: str
    uri: str  #: the path with its signs escaped
    bom: bool
    delimiter: str
    names: tuple[str, ...]


def csv_heads(spark: SparkSession, path: str) -> list[CsvHead]:
    """Heads of a file, or of every part of a folder; only the first line is read."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    parts = [place] if fs.getFileStatus(place).isFile() else sorted((f.getPath() for f in fs.listStatus(place) if f.getPath().getName().startswith("part-")), key=str)
    return [_csv_head(fs, part) for part in parts]


def _csv_head(fs, place) -> CsvHead:
    stream, data, size = fs.open(place), b"", 1 << 14
    try:
        while size <= HEAD_BYTES and b"\n" not in data:
            more = bytes(stream.readNBytes(size))
            data, size = data + more, size * 4
            if not more:
                break
    finally:
        stream.close()
    line = data.split(b"\n")[0].decode("utf-8", "replace").rstrip("\r")
    delimiter = ";" if line.count(";") > line.count(",") else ","
    names = next(csv.reader([line.lstrip("\ufeff")], delimiter=delimiter), [])
    return CsvHead(str(place), fs.makeQualified(place).toUri().toString(), data[:3] == b"\xef\xbb\xbf", delimiter, tuple(names))


SCHEME = "^[a-zA-Z0-9+.-]+:/*"


def place_of(uri: str) -> str:
    """An address without its scheme, whose slashes readers write differently."""
    return re.sub(SCHEME, "/", uri)


def csv_cells(spark: SparkSession, files: list[str], delimiter: str, names: tuple[str, ...]) -> DataFrame:
    """Cells of CSV files of one header as an array, with ``place`` (see ``place_of``) and ``broken`` (rows of a different width)."""
    columns = [f"c{i}" for i in range(len(names))]  # headers may repeat a name
    schema = ", ".join(f"{c} string" for c in columns) + ", _broken string"
    reader = spark.read.option("header", True).option("sep", delimiter).option("multiLine", True).option("quote", '"').option("escape", '"')
    rows = reader.option("enforceSchema", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_broken").schema(schema).csv(files)
    return rows.select(F.regexp_replace("_metadata.file_path", SCHEME, "/").alias("place"), F.col("_broken").isNotNull().alias("broken"), F.array(*columns).alias("cells"))


def catalogue_filter(rows: DataFrame, filters: dict[str, list[str]]) -> tuple[DataFrame, str]:
    """Rows whose columns have one of the given values, and the scope key of the filter (sorted JSON)."""
    import json

    for column, values in sorted(filters.items()):
        rows = rows.where(F.col(column).isin(*values))
    return rows, json.dumps(filters, sort_keys=True, ensure_ascii=False)
