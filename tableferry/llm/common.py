"""Helpers that several operators share: column expressions, sizes and the shared folder."""

from __future__ import annotations

import ctypes
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.session import shared_folder

SPACE = "[ \\t-\\r]+"
#: A side with at most so many rows (of a few numbers each) may be sent to all executors.
SMALL_ROWS = 1_000_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_of(column: str | Column) -> Column:
    """A text without nulls."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def words_of(text: Column) -> Column:
    """The words between white space (the six ASCII characters), in order."""
    return F.filter(F.split(text, SPACE), lambda word: word != "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also where the body uses it in a lambda."""
    return F.transform(F.array(value), body)[0]


def if_small(side: DataFrame, limit: int = SMALL_ROWS) -> DataFrame:
    """``side`` marked for broadcast if it is counted to be small; else Spark shuffles it."""
    return F.broadcast(side) if side.limit(limit + 1).count() <= limit else side


def kept(frame: DataFrame, label: str) -> DataFrame:
    """``frame`` written as Parquet to the shared folder and read again: it outlives executors."""
    path = f"{shared_folder(frame.sparkSession)}/{label}-{uuid.uuid4().hex[:12]}"
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def discard(frame: DataFrame) -> None:
    """Deletes the files of a frame that ``kept`` wrote, or that is made of one; nothing may read them any more."""
    spark, folder = frame.sparkSession, shared_folder(frame.sparkSession)
    for path in {file.rsplit("/", 1)[0] for file in frame.inputFiles()}:
        # Only what lies directly in the shared folder was written there by ``kept``.
        if path.rsplit("/", 1)[0].split(":", 1)[-1].lstrip("/") == folder.split(":", 1)[-1].strip("/"):
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def tidy(run):
    """A function over Arrow batches that gives its memory back to the system when it is done.

    A Python worker waits for its next task beside the executor; it should not hold much then.
    """
    def wrapped(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)

    return wrapped
