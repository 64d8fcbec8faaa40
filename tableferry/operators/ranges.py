"""Statements with a range condition for a whole table of parameters: an interval join by cells.

The line of values is cut into cells at quantiles of the ranges' ends, which one aggregation finds. A row lies
in one cell; a range covers the cells between its two ends whole and two more in part. So both
sides meet on equal cells (and on the statement's equal keys), never row against row. Where these cells
would hold more ranges' ends the more ranges there are, updates and deletions cut them again, at every
so many different ends.

A select by a range alone gives a row per match, so its result can be far larger than both tables. There the
target's rows of a cell are put together in order of their values, so many to a block. A range meets
a block as a whole, and the result comes block by block and in it range by range: the same few rows over and
over, which files store in a few bits a row, where rows in any other order take whole words.

For updates and deletions the ranges are folded before they meet the rows. Whole cells are put together
from O(log cells) dyadic nodes a range, folded node by node and only then spread over the cells. In part,
ranges that end at the same value of a cell are one piece. A cell is then one row with its few pieces, and
the join with the target gives every row at most one partner, however many ranges hold its value.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import InvalidArgument
from ..plans.columns import quote
from ..session import cut_lineage

#: Ranges for which a further cell is made, the most cells that quantiles make, and the most that one of these is cut into.
RANGES_A_CELL = 16
MOST_CELLS = 1024
MOST_PARTS = 4096
#: Rows of a block, rows of a cell for which it is dealt to a further share, and rows of the target for which there is a further task.
ROWS_A_BLOCK = 64
ROWS_A_SHARE = 1 << 16
ROWS_A_TASK = 1 << 14
_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
_TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def position(value: Column, kind: T.DataType) -> Column:
    """A value's place on the line; of two values the larger never has the smaller place."""
    if isinstance(kind, _NUMBERS):
        return value.cast("double")
    if isinstance(kind, _TIMES):
        return F.unix_micros(value.cast("timestamp")).cast("double")
    raise InvalidArgument(f"a range needs numbers, dates or timestamps, not {kind.simpleString()}")


def _halved(bounds: Column, most: int, place: Column) -> Column:
    """How many of at most ``most`` sorted bounds are not above the place."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(most.bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(bounds, at + step - 1) <= place, at + step).otherwise(at))


@dataclass(frozen=True)
class Cells:
    """Cell n holds the places from bound n - 1 up to, but not at, bound n.

    With ``inner`` (``__coarse``, ``__inner``) a cell is cut again at bounds of its own, and ``starts`` has the number
    of its first part.
    """

    bounds: tuple[float, ...]
    inner: DataFrame | None = None
    starts: tuple[int, ...] = ()
    last: int = 0
    most: int = 0

    @property
    def end(self) -> int:
        """The number of the last cell, or of its last part."""
        return self.last if self.inner is not None else len(self.bounds)

    def of(self, place: Column) -> Column:
        """How many bounds are not above the place, by halving; null for null."""
        if not self.bounds:
            return F.when(place.isNotNull(), F.lit(0))
        bounds = F.split(F.lit(",".join(map(repr, self.bounds))), ",").cast("array<double>")
        return F.when(place.isNotNull(), _halved(bounds, len(self.bounds), place))

    def numbered(self, frame: DataFrame, place: Column, name: str) -> DataFrame:
        """``frame`` with the number of the place's cell, or of its part; null for null."""
        if self.inner is None:
            return frame.withColumn(name, self.of(place))
        placed = frame.withColumn("__coarse", self.of(place)).join(F.broadcast(self.inner), "__coarse", "left")
        starts = F.split(F.lit(",".join(map(str, self.starts))), ",").cast("array<int>")
        part = F.coalesce(_halved(F.col("__inner"), self.most, place), F.lit(0))
        return placed.withColumn(name, F.get(starts, F.col("__coarse")) + part).drop("__coarse", "__inner")


@dataclass(frozen=True)
class Ranges:
    """The ranges of a parameter table: equal keys, ends (an end that the statement does not have is open) and what else is kept."""

    frame: DataFrame  # __key*, __low, __high, and other columns
    keys: list[str]
    cells: Cells
    column: str
    kind: T.DataType
    open_low: bool
    open_high: bool

    def holds(self, value: Column, low: Column, high: Column) -> Column:
        """Ends that are null here are open."""
        return (low.isNull() | (value >= low)) & (high.isNull() | (value <= high))


def ranges_of(target: DataFrame, params: DataFrame, keys: dict[str, str], between: dict[str, tuple], others: list[Column], fine: bool = True) -> Ranges:
    """The ranges with their cells' numbers (``__first``, ``__last``); ranges that hold nothing are left out.

    Where each range is to be written once a cell, not ``fine``, there are no more cells than quantiles make.
    """
    if len(between) != 1:
        raise InvalidArgument("one column can have a range")
    (column, ends), = between.items()
    if len(ends) != 2 or ends[0] is None and ends[1] is None:
        raise InvalidArgument("a range needs a lower end, an upper end or both")
    kind = target.schema[column].dataType
    low, high = (None if e is None else F.col(quote(e)) for e in ends)
    places = [None if e is None else position(F.col(quote(e)), params.schema[e].dataType) for e in ends]
    families = {isinstance(k, _NUMBERS) for k in (kind, *[params.schema[e].dataType for e in ends if e is not None])}
    position(F.col(quote(column)), kind)
    if len(families) > 1:
        raise InvalidArgument("a range and its column must both be numbers, or both dates and times")
    # A condition with a null is not true, so its range is left out here.
    real = params.where(low <= high if low is not None and high is not None else (high if low is None else low).isNotNull())
    frame = real.select(*[F.col(quote(p)).alias(f"__key{i}") for i, p in enumerate(keys.values())],
                        (F.lit(None).cast(kind) if low is None else low).alias("__low"), (F.lit(None).cast(kind) if high is None else high).alias("__high"),
                        *[(F.lit(None).cast("double") if p is None else p).alias(name) for p, name in zip(places, ("__from", "__to"), strict=True)], *others)
    cells = _cells(frame, list(keys), fine)
    numbered = frame.withColumn("__first", F.lit(0)) if low is None else cells.numbered(frame, F.col("__from"), "__first")
    numbered = numbered.withColumn("__last", F.lit(cells.end)) if high is None else cells.numbered(numbered, F.col("__to"), "__last")
    return Ranges(numbered.drop("__from", "__to"), [f"__key{i}" for i in range(len(keys))], cells, column, kind, low is None, high is None)


def _cells(frame: DataFrame, keys: list, fine: bool) -> Cells:
    """Cells at quantiles of the ends; with equal keys as many as the ranges of a key need on average."""
    groups = F.approx_count_distinct(F.struct(*[f"__key{i}" for i in range(len(keys))])) if keys else F.lit(1)
    ends = frame.select("*", F.explode(F.array("__from", "__to")).alias("__end")).where("NOT isnan(__end) OR __end IS NULL")
    shares = [n / MOST_CELLS for n in range(MOST_CELLS + 1)]
    found = ends.agg(F.count("*").alias("n"), groups.alias("groups"), F.percentile_approx("__end", shares, 10_000).alias("ends")).first()
    a_cell = 2 * RANGES_A_CELL * max(1, found.groups)
    wanted = found.n // a_cell
    values = sorted({x for x in found.ends or () if x == x and abs(x) != float("inf")})
    step = max(1, -(-len(values) // max(1, wanted)))
    cells = Cells(tuple(values[::step]) if wanted else ())
    return _cut_again(cells, ends, a_cell) if fine and wanted > MOST_CELLS else cells


def _cut_again(cells: Cells, ends: DataFrame, a_cell: int) -> Cells:
    """Every cell is cut at each ``a_cell``-th of the different ends in it. The driver gets the number of parts of each cell."""
    different = ends.where("abs(__end) < double('infinity')").select("__end").distinct().withColumn("__coarse", cells.of(F.col("__end")))
    inside = Window.partitionBy("__coarse")
    ranked = different.withColumn("__rank", F.row_number().over(inside.orderBy("__end")) - 1).withColumn("__n", F.count("*").over(inside))
    step = F.greatest(F.lit(a_cell), F.ceil(F.col("__n") / MOST_PARTS)).cast("bigint")
    cuts = ranked.where((F.col("__rank") > 0) & (F.col("__rank") % step == 0))
    inner = cut_lineage(cuts.groupBy("__coarse").agg(F.sort_array(F.collect_list("__end")).alias("__inner")))
    parts = dict(inner.select("__coarse", F.size("__inner")).collect())
    if not parts:
        return cells
    starts = [0]
    for cell in range(len(cells.bounds) + 1):
        starts.append(starts[-1] + 1 + parts.get(cell, 0))
    return Cells(cells.bounds, inner, tuple(starts[:-1]), starts[-1] - 1, max(parts.values()))


def covered(ranges: Ranges, entry: Column) -> DataFrame:
    """(keys, __cell, __pieces): what applies in each cell, by pieces (low, high, entry, n).

    ``n`` ranges hold the values between low and high (null: the cell's end); ``entry`` is their greatest.
    """
    frame, keys = ranges.frame.withColumn("__entry", entry), [F.col(k) for k in ranges.keys]
    low, high, first, last = (F.col(c) for c in ("__low", "__high", "__first", "__last"))
    kinds = {c: frame.schema[c].dataType for c in ("__low", "__high")}
    nothing = [F.lit(None).cast(kinds[c]).alias(c) for c in ("__low", "__high")]
    # An open end covers its last cell whole.
    begin = F.lit(0) if ranges.open_low else first + 1
    end = F.lit(ranges.cells.end + 1) if ranges.open_high else last
    edges = []
    if ranges.open_low or ranges.open_high:
        edges.append(frame.select(*keys, (last if ranges.open_low else first).alias("__cell"), "__low", "__high", "__entry"))
    else:
        edges.append(frame.where(first == last).select(*keys, first.alias("__cell"), "__low", "__high", "__entry"))
        edges.append(frame.where(first < last).select(*keys, first.alias("__cell"), low.alias("__low"), nothing[1], "__entry"))
        edges.append(frame.where(first < last).select(*keys, last.alias("__cell"), nothing[0], high.alias("__high"), "__entry"))
    edge = edges[0]
    for more in edges[1:]:
        edge = edge.unionByName(more)
    pieces = edge.groupBy(*ranges.keys, "__cell", "__low", "__high").agg(F.max("__entry").alias("__entry"), F.count("*").alias("__n"))
    levels = ranges.cells.end.bit_length()
    if levels:
        def node(k: int, b: Column, e: Column) -> list[Column]:
            left, right = F.floor((b + ((1 << k) - 1)) / (1 << k)).cast("int"), F.floor(e / (1 << k)).cast("int")
            made = lambda at: F.struct(F.lit(k).alias("level"), at.alias("at"))
            return [F.when((left < right) & (left % 2 == 1), made(left)), F.when((F.when(left % 2 == 1, left + 1).otherwise(left) < right) & (right % 2 == 1), made(right - 1))]

        nodes = F.array_compact(F.array(*[x for k in range(levels + 1) for x in node(k, begin, end)]))
        whole = frame.where(begin < end).select(*keys, F.explode(nodes).alias("__node"), "__entry")
        whole = whole.groupBy(*ranges.keys, "__node").agg(F.max("__entry").alias("__entry"), F.count("*").alias("__n"))
        size = F.call_function("shiftleft", F.lit(1), F.col("__node.level"))
        leaves = F.sequence(F.col("__node.at") * size, F.least((F.col("__node.at") + 1) * size - 1, F.lit(ranges.cells.end)))
        whole = whole.select(*keys, F.explode(leaves).alias("__cell"), "__entry", "__n").groupBy(*ranges.keys, "__cell").agg(
            F.max("__entry").alias("__entry"), F.sum("__n").alias("__n"))
        pieces = pieces.unionByName(whole.select(*keys, "__cell", *nothing, "__entry", "__n"))
    return pieces.groupBy(*ranges.keys, "__cell").agg(F.collect_list(F.struct(
        F.col("__low").alias("low"), F.col("__high").alias("high"), F.col("__entry").alias("entry"), F.col("__n").alias("n"))).alias("__pieces"))


def with_partners(target: DataFrame, keys: dict[str, str], ranges: Ranges, entry: Column, own) -> DataFrame:
    """The target's rows (columns named by ``own``) with ``__best``, the greatest entry of the ranges that hold them, and ``__times``, their number."""
    value = F.col(own(ranges.column))
    rows = ranges.cells.numbered(target, position(value, ranges.kind), "__place")
    table = covered(ranges, entry)
    match = F.col("__place") == F.col("__cell")
    for i, column in enumerate(keys):
        match = match & (F.col(own(column)) == F.col(f"__key{i}"))
    mine = F.filter("__pieces", lambda p: ranges.holds(value, p["low"], p["high"]))
    joined = rows.join(table, match, "left").drop("__place", "__cell", *ranges.keys)
    held = joined.withColumn("__mine", mine)
    return held.withColumn("__best", F.array_max(F.transform("__mine", lambda p: p["entry"]))).withColumn(
        "__times", F.coalesce(F.aggregate("__mine", F.lit(0).cast("bigint"), lambda n, p: n + p["n"]), F.lit(0))).drop("__mine", "__pieces")


def meeting(target: DataFrame, keys: dict[str, str], ranges: Ranges, where: str | None) -> tuple[DataFrame, DataFrame, Column]:
    """Both sides and the condition of a join of all rows with all ranges that hold them, on equal cells."""
    value = F.col(quote(ranges.column))
    rows = target.withColumn("__place", ranges.cells.of(position(value, ranges.kind)))
    spread = ranges.frame.withColumn("__cell", F.explode(F.sequence("__first", "__last"))).drop("__first", "__last")
    match = (F.col("__place") == F.col("__cell")) & ranges.holds(value, F.col("__low"), F.col("__high"))
    for i, column in enumerate(keys):
        match = match & (F.col(quote(column)) == F.col(f"__key{i}"))
    return rows, spread, match & F.expr(where) if where else match


def meeting_in_blocks(target: DataFrame, ranges: Ranges, extra: list[str], where: str | None) -> DataFrame:
    """All rows with all ranges that hold them, on equal cells and block by block: the ranges' columns ``extra`` and the target's.

    A cell of many rows (of one value, too) is dealt to shares by the rows' hash, and its ranges go to each of them.
    The driver counts the rows of each cell for it.
    """
    value = F.col(quote(ranges.column))
    rows = target.where(value.isNotNull()).withColumn("__place", ranges.cells.of(position(value, ranges.kind)))
    counts = dict(rows.groupBy("__place").count().collect())
    shares = [max(1, -(-counts.get(cell, 0) // ROWS_A_SHARE)) for cell in range(len(ranges.cells.bounds) + 1)]
    starts = [0, *accumulate(shares)]
    number = lambda numbers, at: F.get(F.split(F.lit(",".join(map(str, numbers))), ",").cast("array<int>"), at)
    share = F.lit(0)
    if max(shares) > 1:
        hashed = F.xxhash64(*[quote(f.name) for f in target.schema if "map<" not in (kind := f.dataType.simpleString()) and "variant" not in kind])
        share = F.pmod(hashed, number(shares, F.col("__place"))).cast("int")
    # A task makes far more than it reads, which adaptive execution does not see, so the number of tasks is given here.
    tasks = max(1, -(-sum(counts.values()) // ROWS_A_TASK))
    rows = rows.withColumn("__share", number(starts, F.col("__place")) + share).drop("__place").repartition(tasks, "__share")
    spread = ranges.frame.withColumn("__part", F.explode(F.sequence(number(starts, F.col("__first")), number(starts, F.col("__last") + 1) - 1))).drop("__first", "__last")
    # Columns that are not asked for later are not collected: each has a list, of structs, as a list leaves out nulls.
    # Those without nulls are in one list with the value, which keeps them so.
    fields = {f.name: f"c{i}" for i, f in enumerate(target.schema)}
    apart = [f.name for f in target.schema if f.nullable and f.name != ranges.column]
    together = F.struct(*[F.col(quote(c)).alias(name) for c, name in fields.items() if c not in apart])
    inside = Window.partitionBy("__share").orderBy(value)
    blocks = rows.withColumn("__block", F.floor((F.row_number().over(inside) - 1) / ROWS_A_BLOCK)).groupBy("__share", "__block").agg(
        F.min(value).alias("__least"), F.max(value).alias("__most"), F.collect_list(together).alias("__rows"),
        *[F.collect_list(F.struct(F.col(quote(c)).alias("v"))).alias(f"__{fields[c]}") for c in apart])
    low, high = F.col("__low"), F.col("__high")
    near = (low.isNull() | (F.col("__most") >= low)) & (high.isNull() | (F.col("__least") <= high))
    # By a merge join, as one that broadcasts the blocks would give the result range by range.
    met = blocks.hint("merge").join(spread, (F.col("__share") == F.col("__part")) & near, "inner")
    each = met.select("__low", "__high", *map(quote, extra), *[f"__{fields[c]}" for c in apart], F.posexplode("__rows").alias("__at", "__row"))
    own = {c: F.get(f"__{fields[c]}", F.col("__at"))["v"] if c in apart else F.col("__row")[fields[c]] for c in fields}
    held = each.where(ranges.holds(own[ranges.column], low, high)).select(
        *map(quote, extra), *[own[f.name].alias(f.name, metadata=f.metadata) for f in target.schema])
    return held.where(F.expr(where)) if where else held
