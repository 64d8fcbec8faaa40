"""SQL texts with bound values, and one statement for a whole table of parameters."""

from __future__ import annotations

import datetime as dt
import decimal
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import InvalidArgument, InvalidState
from ..plans.columns import quote
from .changes import Affine, applied, folded_changes
from .conform import conform
from .ranges import meeting, meeting_in_blocks, ranges_of, with_partners

# Places where ":1" is not a parameter come first and are left as they are.
_PLACEHOLDER = re.compile(
    r"'(?:[^'\\]|\\.|'')*'|\"[^\"]*\"|`[^`]*`|--[^\n]*|/\*.*?\*/|::|:(\d+)\b", re.DOTALL
)
# Everything of an INSERT before its query: texts and bracketed lists are skipped as a whole.
_INSERT = re.compile(
    r"^\s*INSERT\s+(?:INTO|OVERWRITE)\s+(?:'(?:[^'\\]|\\.)*'|\((?:[^()']|'(?:[^'\\]|\\.)*')*\)|`[^`]+`|(?!\b(?:SELECT|WITH|VALUES|FROM|TABLE\s+\S+\s*;?\s*$)\b)[^('`])+?"
    r"(?=\b(?:SELECT|WITH|VALUES|FROM)\b)", re.IGNORECASE | re.DOTALL
)
ROWS_UNKNOWN = -1
MAX_LONG = 2**63 - 1


def numbered_to_named(sql: str) -> str:
    """``:1`` to ``:p1``, outside of texts, quoted names and comments."""
    return _PLACEHOLDER.sub(lambda m: f":p{m.group(1)}" if m.group(1) else m.group(0), sql)


def bind_value(value) -> Column:
    """A Python value as the literal it is bound as."""
    if value is None:
        return F.lit(None)
    if isinstance(value, bool):
        return F.lit(value)
    if isinstance(value, int):
        # Beyond 64 bits signed the digits travel as text.
        return F.expr(f"{value}L") if -MAX_LONG - 1 <= value <= MAX_LONG else F.lit(str(value))
    if isinstance(value, (float, str)):
        return F.lit(value)
    if isinstance(value, decimal.Decimal):
        return F.lit(format(value, "f"))
    if isinstance(value, (bytes, bytearray)):
        return F.lit(bytes(value))
    if isinstance(value, dt.datetime):
        if value.tzinfo is None:
            return F.expr(f"TIMESTAMP_NTZ '{value.isoformat(sep=' ')}'")
        return F.expr(f"TIMESTAMP_LTZ '{value.astimezone(dt.timezone.utc).isoformat(sep=' ')}'")
    if isinstance(value, dt.date):
        return F.expr(f"TIMESTAMP_NTZ '{value.isoformat()} 00:00:00'")
    return F.lit(str(value))


def bind_form(params: DataFrame) -> DataFrame:
    """A parameter table with every column in the type it is bound as."""
    def bound(field: T.StructField) -> Column:
        value, kind = F.col(quote(field.name)), field.dataType
        if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            return value.cast("bigint")
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            return value.cast("double")
        if isinstance(kind, T.DateType):
            return value.cast("timestamp_ntz")
        if isinstance(kind, (T.StringType, T.BinaryType, T.BooleanType, T.TimestampType, T.TimestampNTZType)):
            return value
        if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            return F.to_json(value)
        return value.cast("string")

    return params.select(*[bound(f).alias(f.name) for f in params.schema])


def _arguments(params) -> dict[str, Column]:
    if isinstance(params, DataFrame):
        rows = bind_form(params).take(2)
        if len(rows) > 1:
            raise InvalidState("a query takes one row of parameters; use run_many for a table of them")
        params = list(rows[0]) if rows else []
    if isinstance(params, dict):
        return {name: bind_value(value) for name, value in params.items()}
    return {f"p{i}": bind_value(value) for i, value in enumerate(params or [], start=1)}


def run_query(
    spark: SparkSession, sql: str, params=None, schema: T.StructType | None = None
) -> DataFrame:
    """The result of a query, conformed to ``schema`` if one is given.

    ``params`` is a list for ``:1, :2, …``, a mapping for ``:name``, or a table of one row.
    """
    if not sql or not sql.strip():
        raise InvalidState("no query set")
    args = _arguments(params)
    result = spark.sql(numbered_to_named(sql), args=args) if args else spark.sql(sql)
    return conform(result, schema) if schema is not None else result


def run_update(spark: SparkSession, sql: str, params=None) -> int:
    """Runs a statement and returns the rows affected.

    The rows of an INSERT are counted while it writes them, whatever it writes to (a table, one
    partition, a folder) and whoever else writes there. Statements about tables as a whole
    return 0. What Spark does not tell is -1.
    """
    if not sql or not sql.strip():
        raise InvalidState("no query set")
    args, text = _arguments(params), numbered_to_named(sql)
    insert = _INSERT.match(text)
    if insert is None:
        spark.sql(text, args=args) if args else spark.sql(text)
        return 0 if re.match(r"^\s*(CREATE|DROP|ALTER|TRUNCATE)\b", text, re.IGNORECASE) else ROWS_UNKNOWN
    source = text[insert.end():]
    rows = spark.sql(source, args=args) if args else spark.sql(source)
    counted, view = Observation(), f"insert_{uuid.uuid4().hex}"
    rows.observe(counted, F.count(F.lit(1)).alias("rows")).createTempView(view)
    try:
        spark.sql(f"{insert.group(0)} SELECT * FROM {view}")
    finally:
        spark.catalog.dropTempView(view)
    return counted.get["rows"]


@dataclass(frozen=True)
class ManyResult:
    """``frame``: the rows selected, or the target after the statement; ``affected``: one row ``n``."""

    frame: DataFrame
    affected: DataFrame


def run_many(
    target: DataFrame,
    params: DataFrame,
    on: dict[str, str] | list[str],
    action: str = "select",
    assign: dict[str, str | Affine] | None = None,
    order_by: str | None = None,
    where: str | None = None,
    between: dict[str, tuple[str | None, str | None]] | None = None,
) -> ManyResult:
    """One statement per parameter row, run as one join on equal keys, on a range, or on both.

    ``on`` maps target columns to parameter columns; ``where`` adds a condition over both
    (select and delete). ``assign`` maps target to parameter columns for update and
    insert. Where several parameter rows update one target row, the last by ``order_by``
    wins, as it would if they ran one after the other: a null comes before all others, and of
    equal ones the row with the largest new values is the last, nulls being the smallest. New values take
    the target's types. Parameters may come from the target itself.

    ``between`` maps one target column to the parameter columns of a range's lower and upper end,
    both inside the range; None for an end means that the statement has none, and a null in an end fits no row.
    ``on`` may then be empty. Such a join is on cells of values (``ranges.py``); an update or
    deletion meets each row once, whatever ranges overlap, and a select gives a row per match.

    An assigned value can also be ``Affine``: the row's own value times one parameter plus another.
    Then the changes build up in the order of ``order_by`` (``changes.py``).

    Neither side is forced into memory: Spark broadcasts a side only below its own size
    threshold, and splits a hot key at run time otherwise.
    """
    action = action.lower()
    if action not in ("select", "update", "delete", "insert"):
        raise InvalidArgument(f"unknown action: {action!r}")
    if action == "insert":
        rows = params.select(*[F.col(p).alias(t) for t, p in (assign or {c: c for c in params.columns}).items()])
        return ManyResult(target.unionByName(rows, allowMissingColumns=True), params.agg(F.count("*").alias("n")))

    keys = dict(on) if isinstance(on, dict) else {name: name for name in on}
    if any(isinstance(p, Affine) for p in (assign or {}).values()):
        if action != "update" or between or where or order_by is None or not keys:
            raise InvalidArgument("changes that build up belong to an update on equal columns with order_by")
        return _run_changes(target, params, keys, assign, order_by)
    if between:
        return _run_ranges(target, params, keys, between, action, assign, order_by, where)
    if not keys:
        raise InvalidArgument("run_many needs at least one pair of equal columns")
    if where and action == "update":
        raise InvalidArgument("an update matches on equal columns only")
    renamed = {p: f"__key{i}" for i, p in enumerate(keys.values())}

    if action == "update":
        assign = assign or {}
        if not assign:
            raise InvalidArgument("an update needs assignments")
        unknown = [p for p in assign.values() if p not in params.columns]
        if unknown:
            raise InvalidArgument(
                f"assignments must be parameter columns, got {unknown}: a value computed from the "
                "row being updated would build up from one parameter row to the next"
            )
        if order_by is None:
            raise InvalidArgument("an update needs order_by to tell which parameter row is last")
        # One row per key, combined before the shuffle, so the join never multiplies rows.
        values = F.struct(*[
            F.col(quote(p)).cast(target.schema[t].dataType).alias(f"v{i}") for i, (t, p) in enumerate(assign.items())])
        order = F.col(quote(order_by))
        chosen = params.select(*[F.col(quote(p)).alias(k) for p, k in renamed.items()],
                               F.struct(order.isNotNull(), order, values.alias("new")).alias("__row"))
        last = chosen.groupBy(*renamed.values()).agg(F.max("__row").alias("__last"), F.count("*").alias("__times"))
        joined = _plain(target).join(last, _all_equal(target, keys, renamed), "left")
        place = {t: f"v{i}" for i, t in enumerate(assign)}
        frame = joined.select(*[
            F.when(F.col("__times").isNotNull(), F.col("__last.new")[place[c]]).otherwise(F.col(_own(c))).alias(c)
            if c in assign else F.col(_own(c)).alias(c)
            for c in target.columns
        ])
        # The count leaves out the new values, and reads the keys of the target only.
        times = params.groupBy(*[F.col(quote(p)).alias(k) for p, k in renamed.items()]).agg(F.count("*").alias("__times"))
        counted = _plain(target.select(*map(quote, keys))).join(times, _all_equal(target, keys, renamed), "inner")
        return ManyResult(frame, counted.agg(F.coalesce(F.sum("__times"), F.lit(0)).alias("n")))

    clash = set(target.columns) & set(params.columns) - set(renamed)
    if where and clash:
        raise InvalidArgument(f"columns on both sides: {sorted(clash)}")
    # A fresh projection gives the parameters columns of their own, also if they come from the target.
    given = [F.col(quote(p)).alias(k) for p, k in renamed.items()]
    extra = [c for c in params.columns if c not in target.columns]
    if action == "select" or where:
        wanted = params.select(*given, *[F.col(quote(c)).alias(c) for c in extra])
    else:
        wanted = params.select(*given).distinct()
    rows = target.select(*[F.col(quote(c)).alias(c) for c in target.columns])
    match = _all_equal(target, keys, renamed, own=lambda c: c)
    if where:
        match = match & F.expr(where)
    if action == "select":
        frame = rows.join(wanted, match, "inner").select(*map(quote, extra), *map(quote, target.columns))
        return ManyResult(frame, frame.agg(F.count("*").alias("n")))
    gone = rows.join(wanted, match, "left_semi")
    return ManyResult(rows.join(wanted, match, "left_anti"), gone.agg(F.count("*").alias("n")))


def _run_changes(target: DataFrame, params: DataFrame, keys: dict[str, str], assign: dict, order_by: str) -> ManyResult:
    """An update whose values build up; one row per key meets the target."""
    folded = folded_changes(params, list(keys.values()), assign, order_by, target.schema)
    renamed = {p: f"__key{i}" for i, p in enumerate(keys.values())}
    joined = _plain(target).join(folded, _all_equal(target, keys, renamed), "left")
    frame = joined.select(*[
        F.when(F.col("__times").isNotNull(), applied(F.col(_own(c)), f"__fold{list(assign).index(c)}", target.schema[c].dataType)).otherwise(F.col(_own(c))).alias(c)
        if c in assign else F.col(_own(c)).alias(c) for c in target.columns])
    times = params.groupBy(*[F.col(quote(p)).alias(k) for p, k in renamed.items()]).agg(F.count("*").alias("__times"))
    counted = _plain(target.select(*map(quote, keys))).join(times, _all_equal(target, keys, renamed), "inner")
    return ManyResult(frame, counted.agg(F.coalesce(F.sum("__times"), F.lit(0)).alias("n")))


def _run_ranges(target: DataFrame, params: DataFrame, keys: dict[str, str], between: dict, action: str,
                assign: dict[str, str] | None, order_by: str | None, where: str | None) -> ManyResult:
    """``run_many`` with a range condition."""
    if action == "update":
        if not assign or order_by is None or where:
            raise InvalidArgument("an update by ranges needs assignments and order_by, and no further condition")
        new = F.struct(*[F.col(quote(p)).cast(target.schema[t].dataType).alias(f"v{i}") for i, (t, p) in enumerate(assign.items())])
        order = F.col(quote(order_by))
        ranges = ranges_of(target, params, keys, between, [F.struct(order.isNotNull(), order, new.alias("new")).alias("__row")])
        rows = with_partners(_plain(target), keys, ranges, F.col("__row"), _own)
        place = {t: f"v{i}" for i, t in enumerate(assign)}
        frame = rows.select(*[
            F.when(F.col("__times") > 0, F.col("__best.new")[place[c]]).otherwise(F.col(_own(c))).alias(c) if c in assign else F.col(_own(c)).alias(c)
            for c in target.columns])
    elif where or action == "select":
        extra = [c for c in params.columns if c not in target.columns]
        if where and (clash := set(target.columns) & set(params.columns) - {*keys.values(), *between[next(iter(between))]}):
            raise InvalidArgument(f"columns on both sides: {sorted(clash)}")
        ranges = ranges_of(target, params, keys, between, [F.col(quote(c)) for c in extra], fine=False)
        rows, spread, match = meeting(target.select(*[F.col(quote(c)).alias(c) for c in target.columns]), keys, ranges, where)
        if action == "select":
            matches = rows.join(spread, match, "inner")
            frame = matches if keys or target.isStreaming else meeting_in_blocks(target, ranges, extra, where)
            return ManyResult(frame.select(*map(quote, extra), *map(quote, target.columns)), matches.agg(F.count("*").alias("n")))
        return ManyResult(rows.join(spread, match, "left_anti").select(*map(quote, target.columns)),
                          rows.join(spread, match, "left_semi").agg(F.count("*").alias("n")))
    else:
        ranges = ranges_of(target, params, keys, between, [])
        rows = with_partners(_plain(target), keys, ranges, F.lit(True), _own)
        frame = rows.where("__times = 0").select(*[F.col(_own(c)).alias(c) for c in target.columns])
    # The count reads the columns of the condition only.
    bare = with_partners(_plain(target.select(*[F.col(quote(c)) for c in {*keys, *between}])), keys, ranges, F.lit(True), _own)
    matched = F.sum("__times") if action == "update" else F.sum((F.col("__times") > 0).cast("bigint"))
    return ManyResult(frame, bare.agg(F.coalesce(matched, F.lit(0)).alias("n")))


def _own(name: str) -> str:
    return quote(f"__target_{name}")


def _plain(target: DataFrame) -> DataFrame:
    """The target under names that no parameter has."""
    return target.select(*[F.col(quote(c)).alias(f"__target_{c}") for c in target.columns])


def _all_equal(target: DataFrame, keys: dict[str, str], renamed: dict[str, str], own=None) -> Column:
    condition = F.lit(True)
    for column, param in keys.items():
        condition = condition & (F.col(quote(own(column)) if own else _own(column)) == F.col(renamed[param]))
    return condition
