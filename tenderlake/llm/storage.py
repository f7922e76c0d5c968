"""Shared storage for intermediate results.

Lineage is cut with Parquet tables in the folder that the session names in
``spark.checkpoint.dir``. Only where that is unset and all of Spark is this process
(as in tests) is a folder of this machine used instead; on a cluster that is an error.
"""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_own: list[str] = []


def checkpoint_dir(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _own:
        _own.append("file://" + tempfile.mkdtemp(prefix="tenderlake-"))
    return _own[0]


def write(df: DataFrame, path: str, **how) -> DataFrame:
    """Write ``df`` and read it back. The shuffle files of that write go as soon as it ends,

    so that a job of many steps needs disk for its largest step and not for all
    of them together.
    """
    spark = df.sparkSession
    was = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.options(**{k: v for k, v in how.items() if k != "partitionBy"}).parquet(path, partitionBy=how.get("partitionBy"))
    finally:
        if was is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, was)
    return spark.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """A table that stays until ``discard``, or as long as the shared folder."""
    path = f"{checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    out = write(df, path)
    out.stored_at = path
    return out


def checkpointed(df: DataFrame) -> DataFrame:
    """Lineage cut in the shared folder; Spark's cleaner removes the files once no frame reads them."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(checkpoint_dir(df.sparkSession))
    return df.checkpoint()


def discard(df: DataFrame) -> None:
    """Delete a table that ``materialize`` made; nothing may read it any more."""
    if "stored_at" in vars(df):
        _delete(df.sparkSession, df.stored_at)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class Scratch:
    """Tables of one job, deleted when its block ends: what leaves the block must not read them."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder = spark, f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"

    def __enter__(self):
        return self

    def table(self, df: DataFrame, name: str) -> DataFrame:
        return write(df, f"{self.folder}/{name}-{uuid.uuid4().hex[:8]}")

    def location(self, df: DataFrame, name: str, **how) -> str:
        """Write a table that tasks read themselves; returns where it is."""
        path = f"{self.folder}/{name}-{uuid.uuid4().hex[:8]}"
        write(df, path, **how)
        return path

    def __exit__(self, *_):
        _delete(self.spark, self.folder)
