"""Split planning: conditions that cut a table into reads of about equal weight.

Quantiles of the split column give cells, and one aggregation adds up what lies in each. Cells that weigh too much
are cut at quantiles of their own, all in one pass, until they are light or hold one key. Neighbouring
cells are then put together so that the heaviest split is as light as it can be. The driver sees one row per cell
and never more than a fixed number of cells a split.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import InvalidArgument
from ..operators.sizing import record_bytes
from ..plans.columns import quote

#: Cells a split at first, and the share of a split above which a cell is cut again.
CELLS_A_SPLIT = 16
HEAVY = 8
MOST_SPLITS = 4096
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_BINARY = (T.FloatType, T.DoubleType)
_DATED = {T.DateType: "DATE", T.TimestampType: "TIMESTAMP", T.TimestampNTZType: "TIMESTAMP"}


@dataclass(frozen=True)
class Split:
    """Rows that meet ``condition``: how many they were, and their weight, when the split was planned."""

    condition: str
    rows: int
    weight: int


def plan_splits(
    df: DataFrame, column: str, parts: int, weight: str | Column = "bytes", name: str | None = None,
) -> list[Split]:
    """Conditions on ``column`` that every row meets exactly one of: ``parts`` of them, and one for nulls.

    No split is more than half heavier than a ``parts``-th of all, unless one key is; such a key is alone. Heavy keys
    can make it a few more splits, few keys fewer. ``weight`` is ``bytes`` (what a row
    holds), ``rows`` (only the column is read) or an expression of whole numbers. The column is a number, date or timestamp. ``name`` is the
    column as the conditions spell it, where they are for another system. The first and last splits are open,
    so rows that come later are in a split too; so are nulls where there were none. NaN is above all numbers, as in Spark. An
    empty table has one split.
    """
    kind = df.schema[column].dataType if column in df.columns else None
    if not isinstance(kind, (*_WHOLE, *_BINARY, T.DecimalType, *_DATED)):
        raise InvalidArgument(f"{column} is no column of numbers, dates or timestamps to split by")
    if not 1 <= parts <= MOST_SPLITS:
        raise InvalidArgument(f"parts must be from 1 to {MOST_SPLITS}, got {parts}")
    sizes = {"bytes": record_bytes(df.schema), "rows": F.lit(1)}
    load = sizes.get(weight) if isinstance(weight, str) else weight
    if load is None:
        raise InvalidArgument(f"weight must be bytes, rows or an expression, got {weight!r}")
    keyed = df.select(F.col(quote(column)).alias("k"), F.coalesce(load, F.lit(0)).cast("bigint").alias("w"))
    cells, nulls = _cells(keyed, kind, parts)
    name, splits = name or quote(column), []
    low = None
    for run in _runs(cells, parts):
        high = run[-1].cut
        ends = [f"{name} > {_literal(low, kind)}"] if low is not None else []
        ends += [f"{name} <= {_literal(high, kind)}"] if high is not None else []
        condition = " AND ".join(ends) or f"{name} IS NOT NULL"
        if low is None and not nulls.rows:
            condition = f"({condition} OR {name} IS NULL)"
        splits.append(Split(condition, sum(c.rows for c in run), sum(c.weight for c in run)))
        low = high
    if nulls.rows:
        splits.append(Split(f"{name} IS NULL", nulls.rows, nulls.weight))
    return splits or [Split(f"({name} IS NOT NULL OR {name} IS NULL)", 0, 0)]


def split_number(splits: list[Split]) -> Column:
    """The number of the split a row lies in."""
    found = F.lit(None).cast("int")
    for number, split in reversed(list(enumerate(splits))):
        found = F.when(F.expr(split.condition), F.lit(number)).otherwise(found)
    return found


@dataclass(frozen=True)
class _Cell:
    """Keys above the cell before it, up to and with ``cut``, as text; the last cell has none."""

    cut: str | None
    rows: int
    weight: int
    low: str | None = None
    high: str | None = None


def _cells(keyed: DataFrame, kind: T.DataType, parts: int) -> tuple[list[_Cell], _Cell]:
    """All cells in order, light ones or ones of a single key, and what the nulls come to."""
    # NaN and the infinities are no places to cut at; they are in the first or last cell.
    usable = (F.abs("k") < float("inf")) & ~F.isnan("k") if isinstance(kind, _BINARY) else F.col("k").isNotNull()
    cuts = _quantiles(keyed.where(usable), kind, CELLS_A_SPLIT * parts, ()).get(0, [])
    while True:
        found = {
            r.cell: r for r in keyed.groupBy(_cell_of(cuts, kind).alias("cell")).agg(
                F.count("*").alias("n"), F.sum("w").alias("weight"),
                *[end(F.when(usable, F.col("k"))).cast("string").alias(which) for end, which in ((F.min, "low"), (F.max, "high"))],
            ).collect()
        }
        nulls = found.pop(None, None)
        cells = {i: _Cell(cuts[i] if i < len(cuts) else None, r.n, r.weight, r.low, r.high) for i, r in found.items()}
        bar = sum(c.weight for c in cells.values()) / (parts * HEAVY)
        heavy = {i: c for i, c in cells.items() if c.weight > bar and c.low != c.high}
        finer = _quantiles(keyed.where(usable).select("*", _cell_of(cuts, kind).alias("cell")), kind, CELLS_A_SPLIT, heavy) if heavy else {}
        if not any(finer.values()):
            return [cells[i] for i in sorted(cells)], _Cell(None, nulls.n if nulls else 0, nulls.weight if nulls else 0)
        cuts = [cut for i in range(len(cuts) + 1) for cut in [*finer.get(i, []), *cuts[i: i + 1]]]


def _quantiles(keyed: DataFrame, kind: T.DataType, number: int, heavy) -> dict[int, list[str]]:
    """New cuts: of all keys, or of each heavy cell, whose greatest key is left out so that it can stand alone."""
    shares = [n / number for n in range(1, number + 1)]
    if heavy:
        ends = F.create_map(*[F.lit(x) for i, c in heavy.items() for x in (i, c.high)])
        keyed = keyed.where(F.col("cell").isin(list(heavy)) & (F.col("k") < ends[F.col("cell")].cast(kind)))
    else:
        keyed = keyed.withColumn("cell", F.lit(0))
    # The summary works with doubles, which are coarse for the largest whole numbers: a cell that they do not cut is halved.
    found = keyed.groupBy("cell").agg(F.percentile_approx("k", shares, 10_000).alias("q"), F.min("k").alias("low"), F.max("k").alias("high"))
    inside = F.array_distinct(F.filter("q", lambda v: (v >= F.col("low")) & (v <= F.col("high"))))
    result = {r.cell: r.cuts for r in found.select("cell", inside.cast("array<string>").alias("cuts")).collect()}
    for i, cell in heavy.items() if heavy and isinstance(kind, _WHOLE) else ():
        if not result.get(i) and cell.low is not None:
            result[i] = [str((int(cell.low) + int(cell.high)) // 2)]
    return result


def _cell_of(cuts: list[str], kind: T.DataType) -> Column:
    """How many cuts lie below the key, by halving; null for null."""
    steps = F.array(*[F.lit(1 << n) for n in reversed(range(max(1, len(cuts).bit_length())))])
    bounds = F.split(F.lit(",".join(cuts)), ",").cast(T.ArrayType(kind)) if cuts else F.array().cast(T.ArrayType(kind))
    found = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(bounds, at + step - 1) < F.col("k"), at + step).otherwise(at))
    return F.when(F.col("k").isNotNull(), found)


def _runs(cells: list[_Cell], parts: int) -> list[list[_Cell]]:
    """Neighbouring cells put together: the smallest capacity that needs no more than ``parts`` runs.

    A cell heavier than the mean is alone, and the others share the parts that are left. Where cells are so few and heavy
    that a run would be half heavier than the mean, more runs are made instead.
    """
    mean = sum(c.weight for c in cells) / parts
    alone = sum(c.weight > mean for c in cells)

    def fill(capacity: float) -> list[list[_Cell]]:
        runs: list[list[_Cell]] = []
        room = -1.0
        for cell in cells:
            if cell.weight > mean or cell.weight > room:
                runs.append([cell])
                room = -1.0 if cell.weight > mean else capacity - cell.weight
            else:
                runs[-1].append(cell)
                room -= cell.weight
        return runs

    least, most = 0, max(1, sum(c.weight for c in cells))
    allowed = max(parts, len(fill(most)), alone)
    while least < most:
        middle = (least + most) // 2
        if len(fill(middle)) <= allowed:
            most = middle
        else:
            least = middle + 1
    return fill(min(most, max([1.5 * mean, *[c.weight for c in cells if c.weight <= mean]])))


def _literal(text: str, kind: T.DataType) -> str:
    if type(kind) in _DATED:
        return f"{_DATED[type(kind)]} '{text}'"
    return f"{text}E0" if isinstance(kind, _BINARY) and "E" not in text else text
