"""Chat formatting: logged snapshots collapsed to maximal conversations, then rendered.

Native: DataFrame functions only. A log holds a conversation again and again as it grows. The
hash of a prefix is the sum of hashes of (position, role, text), so it rolls from turn to turn
and can be summed by blocks of turns: a conversation with very many turns is spread over tasks.
Anti-joins on (length, hash) then leave the conversations that no longer one continues.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableferry.llm.common import kept, text_of

#: Turn numbers per block, and turns per rendered part.
BLOCK = 256
PART = 4096
#: Two sums of 40-bit hashes; 2**23 turns cannot overflow them.
BITS = 40


def numbered_turns(turns: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                   text: str = "text", block: int = BLOCK) -> DataFrame:
    """Rows (conv_id, position, role, text) with the prefix hash ``h1``, ``h2`` and ``is_last``.

    Turns are ordered by number (null first), then role and text; a turn that is logged twice
    with equal role and text counts once; repeated logs are made one before they meet in a block.
    Positions start at 1.
    """
    clean = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).alias("conv_id"), F.col(turn).cast("bigint").alias("turn"),
        F.coalesce(F.col(role), F.lit("unknown")).alias("role"), text_of(text).alias("text"),
    ).distinct().withColumn("block", F.coalesce(F.floor(F.col("turn") / block).cast("bigint"), F.lit(-(1 << 62))))
    in_block = Window.partitionBy("conv_id", "block").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    single = clean.withColumn("__place", F.row_number().over(in_block).cast("bigint"))
    starts = single.groupBy("conv_id", "block").agg(F.count("*").alias("__n")).select(
        "conv_id", "block", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"),
        F.sum("__n").over(Window.partitionBy("conv_id")).alias("n_turns"))
    placed = single.join(starts, ["conv_id", "block"]).withColumn("position", F.col("__start") + F.col("__place"))
    value = lambda seed: F.shiftrightunsigned(F.xxhash64(F.lit(seed), "position", "role", "text"), 64 - BITS)
    hashed = placed.withColumns({"v1": value(1), "v2": value(2)})
    totals = hashed.groupBy("conv_id", "block").agg(F.sum("v1").alias("__t1"), F.sum("v2").alias("__t2")).select(
        "conv_id", "block", *(F.coalesce(F.sum(f"__t{k}").over(before), F.lit(0)).alias(f"__b{k}") for k in (1, 2)))
    upto = Window.partitionBy("conv_id", "block").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    return hashed.join(totals, ["conv_id", "block"]).select(
        "conv_id", "position", "role", "text",
        *((F.col(f"__b{k}") + F.sum(f"v{k}").over(upto)).alias(f"h{k}") for k in (1, 2)),
        (F.col("position") == F.col("n_turns")).alias("is_last"))


def maximal_conversations(numbered: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_copies) of the conversations that are no proper prefix of another.

    Of equal conversations the one with the smallest id stays; ``n_copies`` counts them all.
    """
    whole = numbered.where("is_last").groupBy("position", "h1", "h2").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    inner = numbered.where("NOT is_last").select("position", "h1", "h2").distinct()
    return whole.join(inner, ["position", "h1", "h2"], "left_anti").select(
        "conv_id", F.col("position").alias("n_turns"), "n_copies")


def turn_text(role: Column, text: Column) -> Column:
    """One turn between its markers; markers inside a text are broken by a backslash."""
    safe = F.replace(F.replace(text, F.lit("<|im_start|>"), F.lit("<\\|im_start|>")), F.lit("<|im_end|>"), F.lit("<\\|im_end|>"))
    return F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), safe, F.lit("<|im_end|>\n"))


def collapse_and_render(turns: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                        text: str = "text", block: int = BLOCK, part: int = PART) -> DataFrame:
    """One row per maximal conversation: conv_id, part, n_turns, n_copies, text.

    A conversation of over ``part`` turns has several rows, numbered from 0 in ``part``, whose
    texts follow each other. Rows without a conversation id belong to none and are left out; a
    null role is ``unknown``, a null text is empty. Other columns of ``turns`` are ignored. An
    empty table gives an empty table.
    """
    # Three steps read it, so it is written once.
    numbered = kept(numbered_turns(turns, conv=conv, turn=turn, role=role, text=text, block=block), "turns")
    whole = maximal_conversations(numbered)
    rows = numbered.select("conv_id", "position", turn_text(F.col("role"), F.col("text")).alias("piece"))
    return (
        rows.join(whole, "conv_id")
        .groupBy("conv_id", F.floor((F.col("position") - 1) / part).cast("int").alias("part"), "n_turns", "n_copies")
        .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("position", "piece"))), lambda x: x["piece"]), "").alias("text"))
    )
