"""What filters take from a corpus alone, together and in every order, from tables of failing ids.

Each filter has one stored table of the rows that fail it. A filter's step after a set of others
removes those of its failing rows that are in none of the others' tables (a left-anti join), and
finds redundant those that are in one (a left-semi join). What a step does depends on the set of
filters before it, not on their order, so n filters have n * 2**(n-1) steps, and all orders are
put together from their counts. The steps are one side's rows: two joins by row id give them all.

Texts are read once, to judge them. A row is known by a number it is given then, so rows with one
id, or without, are told apart, and no group of equal ids, parts or texts meets in one task.
"""

from __future__ import annotations

import itertools
import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tableferry.llm.common import if_small, kept, text_of, words_of

#: The orders of more filters are too many to list.
MOST_FILTERS = 7
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def repeats_of(rows: DataFrame, key: str = "digest", id_column: str = "doc_id") -> DataFrame:
    """(row) of the rows whose ``key`` a row with a smaller id has too; a null id is neither smaller nor larger.

    Only keys that several ids have are joined, and of those one row each, so that a group of a third
    of all rows is a broadcast side's one row, or is split by adaptive execution.
    """
    several = rows.groupBy(key).agg(F.min(id_column).alias("__first"), F.max(id_column).alias("__last")).where("__first < __last")
    found = rows.join(if_small(kept(several.select(key, "__first"), "repeats")), key)
    return found.where(F.col(id_column) > F.col("__first")).select("row")


class FailingIds:
    """One stored table of failing rows (row, id, part) per filter, and the rows of each part."""

    def __init__(self, tables: dict[str, DataFrame], parts: DataFrame):
        self.tables, self.parts = tables, parts


def failing_ids(documents: DataFrame, filters: dict[str, Column], repeats: str | None = None, *, id_column: str = "doc_id",
                text: str = "text", part: str = "source") -> FailingIds:
    """Judges every row by ``filters`` (name -> the condition to fail; unknown is a pass) and stores the failing ids.

    ``repeats`` names one more filter: a row fails it whose text a row with a smaller id has too, in
    the whole table. A null text is an empty one for it; a null part is the empty text.
    """
    names = [*filters, *([repeats] if repeats else [])]
    if not names or len(names) > MOST_FILTERS:
        raise ValueError(f"1 to {MOST_FILTERS} filters can be audited, got {len(names)}")
    failed = F.array_compact(F.array(*[F.when(condition, F.lit(name)) for name, condition in filters.items()])) if filters else F.array().cast("array<string>")
    judged = kept(documents.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{id_column}`").alias("doc_id"),
        F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        failed.alias("failed"), F.unhex(F.md5(F.encode(text_of(f"`{text}`"), "UTF-8"))).alias("digest")), "judged")
    ids = {name: judged.where(F.array_contains("failed", name)).select("row", "doc_id", "part") for name in filters}
    if repeats:
        again = judged.join(if_small(kept(repeats_of(judged), "again")), "row", "left_semi")
        ids[repeats] = again.select("row", "doc_id", "part")
    tables = {name: kept(table, f"failing-{n}") for n, (name, table) in enumerate(ids.items())}
    return FailingIds(tables, kept(judged.groupBy("part").agg(F.count("*").alias("documents")), "parts"))


def step_counts(failing: FailingIds, labels: dict[str, DataFrame]) -> DataFrame:
    """(part, filter, before, removed, redundant, and <label>_lost per label) of each filter after each set of others.

    ``before`` is the set as bits, in the order of the tables. ``labels``: name -> ids, each once.
    Steps that find nothing have no row.
    """
    names = list(failing.tables)
    every = reduce(DataFrame.unionByName, [t.withColumn("filter", F.lit(n)) for n, t in enumerate(failing.tables.values())])
    own = every
    for label, ids in labels.items():
        marks = ids.select(F.col("doc_id").alias("__id"), F.lit(1).alias(f"__{label}"))
        own = own.join(if_small(marks), F.col("doc_id") == F.col("__id"), "left").drop("__id")
    own = own.drop("doc_id").repartition("row")
    bit = F.call_function("shiftleft", F.lit(1), F.col("filter"))
    others = every.select(F.col("row").alias("__row"), bit.alias("__bit"))
    # The sets without the filter's own bit: a fixed number of small integers a row.
    before = F.filter(F.sequence(F.lit(0), F.lit((1 << len(names)) - 1)), lambda s: s.bitwiseAND(bit) == 0)
    steps = own.withColumn("before", F.explode(before))
    meets = (F.col("row") == F.col("__row")) & (F.col("before").bitwiseAND(F.col("__bit")) != 0)
    removed = steps.join(others, meets, "left_anti").groupBy("part", "filter", "before").agg(
        F.count("*").alias("removed"), *[F.coalesce(F.sum(f"__{x}"), F.lit(0)).alias(f"{x}_lost") for x in labels])
    redundant = steps.join(others, meets, "left_semi").groupBy("part", "filter", "before").agg(F.count("*").alias("redundant"))
    return kept(removed.join(redundant, ["part", "filter", "before"], "full").fillna(0), "steps")


def orders_of(names: list[str]) -> list[tuple[str, int, int, int, int]]:
    """(filter_order, step, filter, filters before it as bits, place of the step) of every step of every order."""
    found = []
    for order in itertools.permutations(range(len(names))):
        before = 0
        for step, n in enumerate(order, start=1):
            found.append(("".join(names[k] for k in order), step, n, before, len(found)))
            before |= 1 << n
    return found


def filter_audit(failing: FailingIds, labels: dict[str, DataFrame] | None = None) -> DataFrame:
    """One row per part, order of all filters and step, zeros included: what the step keeps, removes and loses.

    Columns: part, filter_order, step, kept, removed, redundant (failing this filter, removed
    earlier), unique_fails (failing this one only), <label>_lost per label, shapley (the
    filter's removed rows, summed over all orders). ``labels``: name -> table with doc_id; ids
    that occur twice there, or not in the documents, do no harm. Without documents, no rows.
    """
    names, spark = list(failing.tables), failing.parts.sparkSession
    labels = {x: ids.select("doc_id").where("doc_id IS NOT NULL").distinct() for x, ids in (labels or {}).items()}
    counts, n = step_counts(failing, labels), len(names)
    lost = [f"{x}_lost" for x in labels]
    # How many orders have exactly this set before the filter.
    weight = F.element_at(F.array(*[F.lit(math.factorial(k) * math.factorial(n - 1 - k)) for k in range(n)]), F.bit_count("before") + 1)
    alone = (1 << n) - 1 - F.call_function("shiftleft", F.lit(1), F.col("filter"))
    sums = counts.groupBy("part", "filter").agg(
        F.sum(F.col("removed") * weight).alias("shapley"), F.sum(F.when(F.col("before") == alone, F.col("removed")).otherwise(0)).alias("unique_fails"))
    # The steps of all orders are a fixed list; each part meets them by their place in it.
    steps = spark.createDataFrame(orders_of(names), "filter_order string, step int, filter int, before int, place int")
    grid = failing.parts.withColumn("place", F.explode(F.sequence(F.lit(0), F.lit(math.factorial(n) * n - 1)))).join(F.broadcast(steps), "place")
    found = grid.join(counts, ["part", "filter", "before"], "left").join(sums, ["part", "filter"], "left").fillna(
        0, ["removed", "redundant", *lost, "shapley", "unique_fails"])
    so_far = F.sum("removed").over(Window.partitionBy("part", "filter_order").orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return found.select("part", "filter_order", "step", (F.col("documents") - so_far).alias("kept"), "removed", "redundant", "unique_fails", *lost, "shapley")


def text_filters(text: str = "text") -> dict[str, Column]:
    """Failure conditions on a text: few words (A), repeated words (B), many capitals (C), symbols (D)."""
    body = text_of(f"`{text}`")
    words = words_of(body)
    capitals = F.char_length(body) - F.char_length(F.translate(body, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {
        "A": F.size(words) < 50,
        "B": 100 * F.size(F.array_distinct(words)) < 65 * F.size(words),
        "C": 100 * capitals.cast("bigint") > 5 * F.char_length(body).cast("bigint"),
        "D": body.rlike("[#$%&*|]"),
    }
