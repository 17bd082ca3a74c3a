"""Cutting lineage with tables that survive the loss of an executor."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Tells Spark to delete what an execution shuffled as soon as it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bytes of the distinct values of a column in a file's row group, by the table's name; with more, Parquet would spell a text's key in each posting.
DICTIONARIES = {"postings": 1 << 24}
_writing, _writers, _before = threading.Lock(), 0, "false"


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one only for a local session without it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="namesieve-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Executions that begin here drop their shuffle files at their end; tables are written from several threads at a time."""
    global _writers, _before
    with _writing:
        if not _writers:
            _before = spark.conf.get(CLEANUP, "false")
            spark.conf.set(CLEANUP, "true")
        _writers += 1
    try:
        yield
    finally:
        with _writing:
            _writers -= 1
            if not _writers:
                spark.conf.set(CLEANUP, _before)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Unlike a checkpoint the result is a columnar scan, so later steps still prune columns
    and push filters, and its size is known to the planner. Texts and lists take about half the disk of the default
    compression. What was shuffled on the way is dropped at once, or else it would stay until the driver collects its garbage.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/namesieve/{name}-{uuid.uuid4().hex}"
    options = {"parquet.dictionary.page.size": DICTIONARIES[name]} if name in DICTIONARIES else {}
    with shuffles_dropped(spark):
        df.write.mode("errorifexists").options(compression="zstd", **options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
