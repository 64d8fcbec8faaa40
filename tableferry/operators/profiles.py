"""Text widths of a stored table, kept per file, so that planning again reads new files only.

The profile is a hidden folder of the table: one row per file with its name, length, time of change and
the widest value of every text column. A file counts as known only if all three still fit, so files that
were written anew are read again and files that are gone drop out. Each update is written whole under a
name of its own and shows by one rename; a profile that lacks files is never wrong, it only makes them be read.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.columns import LoadPlan, quote
from ..plans.options import LoadOptions
from .folder import Folder, table_folder
from .ingest import plan_from_widths
from .sizing import text_columns

_FOLDER, _KEPT, _STAGED = "_tableferry_widths", "profile-", "staged-"
_FILE = "file string, length bigint, changed timestamp, widths map<string, bigint>"
_KEYS = ["file", "length", "changed"]


@dataclass(frozen=True)
class StoredProfile:
    """Widest value, in bytes, per text column (0 without values), and how many files were read for it."""

    widths: dict[str, int]
    files_read: int


def profile_stored(spark: SparkSession, table: str) -> StoredProfile:
    """What ``profile_text`` says of a plain Parquet table, from the files that have no profile yet and the kept rest.

    An empty table has widths of 0; nulls count as nothing. The driver sees the new files' names and one row of maxima.
    """
    folder = table_folder(spark, table)
    spark.catalog.refreshTable(table)
    stored = spark.table(table)
    texts = text_columns(stored)
    kept = _kept(spark, folder)
    # Only names, lengths and times are asked for, so no content is read here.
    listed = spark.read.format("binaryFile").load(folder.path).select(
        F.regexp_extract("path", "[^/]*$", 0).alias("file"), F.col("length"), F.col("modificationTime").alias("changed"))
    if kept is not None and kept.where(~_holds(texts)).isEmpty():
        new = listed.join(kept, _KEYS, "left_anti")
        known = kept.join(listed, _KEYS, "left_semi")
    else:  # no profile, or one from before a column was added
        new, known = listed, None
    names = [r.file for r in new.select("file").collect()]
    if names:
        rows = spark.read.schema(stored.schema).parquet(*[f"{folder.path}/{name}" for name in names])
        found = rows.select(*[F.octet_length(quote(c)).cast("bigint").alias(f"w{i}") for i, c in enumerate(texts)],
                            F.col("_metadata.file_name").alias("file")).groupBy("file").agg(
            F.count(F.lit(1)).alias("n"), *[F.max(f"w{i}").alias(f"w{i}") for i in range(len(texts))])
        widths = F.map_from_arrays(F.array(*map(F.lit, texts)).cast("array<string>"),
                                   F.array(*[F.coalesce(f"w{i}", F.lit(0)) for i in range(len(texts))]).cast("array<bigint>"))
        fresh = new.join(found, "file", "left").select(*_KEYS, widths.alias("widths"))
        _keep(folder, fresh if known is None else known.unionByName(fresh))
        kept = _kept(spark, folder)
    total = kept.join(listed, _KEYS, "left_semi") if kept is not None else None
    if total is None or not texts:
        return StoredProfile({name: 0 for name in texts}, len(names))
    row = total.agg(*[F.coalesce(F.max(F.col("widths")[name]), F.lit(0)).alias(f"w{i}") for i, name in enumerate(texts)]).first()
    return StoredProfile({name: row[i] for i, name in enumerate(texts)}, len(names))


def plan_stored(spark: SparkSession, table: str, options: LoadOptions | dict | None = None) -> LoadPlan:
    """The load plan of a stored table's rows as they are now, by its kept profile."""
    return plan_from_widths(spark.table(table), profile_stored(spark, table).widths, LoadOptions.parse(options))


def _holds(texts: list[str]):
    """Whether a file's row has the widths of all columns."""
    return F.size(F.array_except(F.array(*map(F.lit, texts)).cast("array<string>"), F.map_keys("widths"))) == 0


def _kept(spark: SparkSession, folder: Folder) -> DataFrame | None:
    if _FOLDER not in folder.files():
        return None
    found = sorted(name for name in folder.files(_FOLDER) if name.startswith(_KEPT))
    return spark.read.schema(_FILE).parquet(f"{folder.path}/{_FOLDER}/{found[-1]}") if found else None


def _keep(folder: Folder, profile: DataFrame) -> None:
    there = sorted(name for name in folder.files(_FOLDER) if name.startswith(_KEPT)) if _FOLDER in folder.files() else []
    number = int(there[-1][len(_KEPT):].split("-")[0]) + 1 if there else 0
    mark = f"{number:08d}-{uuid.uuid4().hex[:12]}"
    profile.write.parquet(f"{folder.path}/{_FOLDER}/{_STAGED}{mark}")
    folder.move(folder.at(_FOLDER, _STAGED + mark), folder.at(_FOLDER, _KEPT + mark))
    # The one before stays for who is reading it.
    for name in there[:-1]:
        folder.delete(_FOLDER, name)
