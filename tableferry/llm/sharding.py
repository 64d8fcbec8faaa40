"""Shards by jump consistent hashing, in DataFrame functions only.

A row's key seeds a sequence of 64-bit pseudo-random numbers (a linear congruential generator).
Each number tells at which shard count the row jumps next, and to which shard: it jumps when
that shard is added and stays put otherwise. So no table of shards is needed, and when one is
added to n, about one row in n + 1 moves, all of them into the new shard.

The multiplication wraps around at 64 bits, which Spark refuses under ANSI rules; it is done on
two halves of 32 bits. The walk takes ln(n) + 1 steps on average; it is begun with a few, and
only rows that have not arrived take more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tableferry.llm.common import if_small, kept, text_of

SHARDS = 16
# Fixed value: the multiplier of the generator in the published definition; its increment is 1.
MULTIPLIER = 2862933555777941757
_HIGH, _LOW, _MASK = MULTIPLIER >> 32, MULTIPLIER & 0xFFFFFFFF, 0xFFFFFFFF
FIRST_STEPS = 12
_STATE = "struct<high:bigint,low:bigint,at:bigint,next:bigint>"
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _times_low(half: Column) -> tuple[Column, Column]:
    """The product of a 32-bit number and the multiplier's lower half, as its upper and lower 32 bits."""
    upper = F.shiftright(half, 16) * F.lit(_LOW)
    lower = half.bitwiseAND(F.lit(0xFFFF)) * F.lit(_LOW) + F.shiftleft(upper.bitwiseAND(F.lit(0xFFFF)), 16)
    return F.shiftright(upper, 16) + F.shiftright(lower, 32), lower.bitwiseAND(F.lit(_MASK))


def _step(state: Column, shards: int) -> Column:
    """One jump: ``at`` is the shard that the last jump led to, ``next`` where the coming one does."""
    carried, low = _times_low(state["low"])
    _, high = _times_low(state["high"])
    by_high = (F.shiftright(state["low"], 16) * F.lit(_HIGH)).bitwiseAND(F.lit(0xFFFF))
    by_high = F.shiftleft(by_high, 16) + state["low"].bitwiseAND(F.lit(0xFFFF)) * F.lit(_HIGH)
    one = low + F.lit(1)
    high = (carried + high + by_high.bitwiseAND(F.lit(_MASK)) + F.shiftright(one, 32)).bitwiseAND(F.lit(_MASK))
    # The upper 31 bits of the number, plus one, out of 2**31.
    drawn = (F.shiftright(high, 1) + F.lit(1)).cast("double")
    jumped = F.struct(
        high.alias("high"), one.bitwiseAND(F.lit(_MASK)).alias("low"), state["next"].alias("at"),
        F.floor((state["next"] + F.lit(1)).cast("double") * (F.lit(float(1 << 31)) / drawn)).cast("bigint").alias("next"))
    return F.when(state["next"] >= F.lit(shards), state).otherwise(jumped)


def jump_shard(key: Column, shards: int) -> Column:
    """The shard (0 to ``shards`` - 1) of a whole-number key, which is read as 64 bits without sign; null is like 0."""
    if shards < 1:
        raise ValueError(f"there must be a shard, got {shards}")
    key = F.coalesce(key.cast("bigint"), F.lit(0).cast("bigint"))
    zero = F.lit(0).cast("bigint")
    start = F.struct(F.shiftrightunsigned(key, 32).alias("high"), key.bitwiseAND(F.lit(_MASK)).alias("low"),
                     (zero - 1).alias("at"), zero.alias("next")).cast(_STATE)

    def walk(state: Column, steps: int) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), state, lambda s, _: _step(s, shards).cast(_STATE))

    done = walk(start, min(shards, FIRST_STEPS))
    if shards > FIRST_STEPS:
        # A jump leads to a higher shard, so there are at most as many as shards.
        done = F.transform(F.array(done), lambda s: F.when(s["next"] >= F.lit(shards), s).otherwise(walk(s, shards - FIRST_STEPS)))[0]
    return done["at"].cast("int")


def key_of(documents: DataFrame, column: str) -> Column:
    """Whole numbers as they are; any other type by a 64-bit hash of the value, null as null."""
    value = F.col(f"`{column}`")
    if isinstance(documents.schema[column].dataType, _WHOLE):
        return value.cast("bigint")
    return F.when(value.isNotNull(), F.xxhash64(value))


def assign_shards(documents: DataFrame, shards: int = SHARDS, *, id_column: str = "doc_id", into: str = "shard",
                  grown_into: str | None = None) -> DataFrame:
    """The documents with their shard in column ``into``, row by row, without a shuffle.

    The key and the number of shards alone decide, so repeated rows and rows with one id share a
    shard, a null id has the shard of 0, and other columns and texts of any length do not matter.
    ``grown_into`` names a column for the shard with one more. A column that has such a name is replaced.
    """
    key = key_of(documents, id_column)
    added = {into: jump_shard(key, shards)} | ({grown_into: jump_shard(key, shards + 1)} if grown_into else {})
    return documents.select(*[F.col(f"`{c}`") for c in documents.columns if c not in added], *[value.alias(name) for name, value in added.items()])


def shard_slots(documents: DataFrame, shards: int = SHARDS, *, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its id, size, text_crc32, shard, slot and grown_shard.

    ``size`` is the text's UTF-8 bytes plus 1, ``text_crc32`` unsigned; a null text is like an empty
    one. ``slot`` numbers a shard's rows from 0 without gaps by id (null first), then size and crc;
    rows that agree in these have neighbouring slots in any order. An empty table has no rows. Other columns are ignored.

    Rows are sorted by range over all partitions. A shard, an id or a group of equal texts spans
    as many of them as its rows need, because the row's number is the last part of the order. Texts are not moved.
    """
    body = F.encode(text_of(f"`{text}`"), "UTF-8")
    measured = documents.select(
        F.col(f"`{id_column}`").alias("id"), (F.octet_length(body) + F.lit(1)).cast("bigint").alias("size"),
        F.crc32(body).alias("text_crc32"), key_of(documents, id_column).alias("key"))
    rows = measured.select("id", "size", "text_crc32", jump_shard(F.col("key"), shards).alias("shard"),
                           jump_shard(F.col("key"), shards + 1).alias("grown_shard"), F.monotonically_increasing_id().alias("row"))
    order = [F.asc_nulls_first(c) for c in ("shard", "id", "size", "text_crc32", "row")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("row")
    # The place in the partition is the lower part of the number; written once, places stay as they are.
    ordered = kept(ordered.select("*", F.spark_partition_id().alias("part"),
                                  F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("place")), "sharded")
    # A row per partition and shard in it: as many as partitions and shards together.
    runs = ordered.groupBy("shard", "part").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = runs.select("shard", "part", (before - F.col("first")).alias("shift"))
    placed = ordered.join(if_small(kept(offsets, "offsets")), ["shard", "part"])
    return placed.select(F.col("id").alias(id_column), "size", "text_crc32", "shard", (F.col("place") + F.col("shift")).alias("slot"), "grown_shard")


def write_shards(documents: DataFrame, path: str, shards: int = SHARDS, *, id_column: str = "doc_id", format: str = "parquet") -> None:
    """The documents in one folder per shard (``shard=0`` and so on) under ``path``, which must not exist.

    Every task writes its own files: no shuffle, and a shard that is hot has many files. Adding a shard
    rewrites what moves only: rows whose ``grown_into`` of ``assign_shards`` differs from the shard they are in.
    """
    assign_shards(documents, shards, id_column=id_column).write.partitionBy("shard").format(format).save(path)
