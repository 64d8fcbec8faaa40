"""Loose values to typed columns. Whatever does not fit becomes NULL, never an exception.

The rules are SQL texts over a column's name: a table of hundreds of columns is then built
with one call per column.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The texts that mean true, and the accepted number and time layouts.
TRUE_TEXTS = ("1", "true", "TRUE", "Y")
SPECIAL_TEXT = "(?i)^([+-]?inf(inity)?|nan)$"
ZONED_TIME_TEXT = (
    "^[0-9]{4}-[0-9]{2}-[0-9]{2}"
    "(T[0-9]{1,2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,9})?| [0-9]{1,2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,9})? )"
    "(Z|[+-]([01][0-9]|2[0-4]):[0-5][0-9])$"
)
PLAIN_TIME_TEXT = "^[0-9]{4}-[0-9]{2}-[0-9]{2}( [0-9]{1,2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,9})?)?$"
ZONE_SUFFIX = " ?(Z|[+-][0-9]{2}:[0-9]{2})$"
SPACED_ZONE = " (Z|[+-][0-9]{2}:[0-9]{2})$"
SAFE_DIGITS = 300
LONG_BOUND = "9.223372036854775808E18D"

INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
NUMBERS = (*INTEGERS, T.FloatType, T.DoubleType, T.DecimalType)


def coerce(value: str, source: T.DataType, target: T.DataType, zone: str = "UTC") -> str:
    """``value`` (SQL) of type ``source`` as ``target``; NULL where there is no conversion."""
    if isinstance(target, T.LongType):
        found = to_int64(value, source)
    elif isinstance(target, T.DoubleType):
        found = to_float64(value, source)
    elif isinstance(target, T.StringType):
        found = to_text(value, source)
    elif isinstance(target, T.TimestampNTZType):
        found = to_wall_clock(value, source, zone)
    elif isinstance(target, T.TimestampType):
        found = to_instant(value, source)
    elif isinstance(target, T.BooleanType):
        found = to_flag(value, source)
    elif isinstance(target, T.BinaryType) and isinstance(source, T.BinaryType):
        found = value
    else:
        found = None
    return nothing(target) if found is None else found


def nothing(target: T.DataType) -> str:
    return f"CAST(NULL AS {target.simpleString()})"


def to_int64(value: str, source: T.DataType) -> str | None:
    """Integers widen, other numbers lose their fraction, text is read as either."""
    if isinstance(source, INTEGERS):
        return f"CAST({value} AS BIGINT)"
    if isinstance(source, T.DecimalType):
        return f"try_cast({value} AS BIGINT)"
    if isinstance(source, NUMBERS):
        return _truncated(f"CAST({value} AS DOUBLE)")
    if isinstance(source, T.StringType):
        number = _truncated(f"try_cast({value} AS DOUBLE)")
        return f"CASE WHEN {_bare(value)} THEN coalesce(try_cast({value} AS BIGINT), {number}) END"
    return None


def _truncated(number: str) -> str:
    # The cast alone would let 2^63 itself through, as the largest value below it.
    return f"CASE WHEN {number} < {LONG_BOUND} THEN try_cast({number} AS BIGINT) END"


def to_float64(value: str, source: T.DataType) -> str | None:
    """Numbers widen; text is read if it is a number and does not overflow."""
    if isinstance(source, NUMBERS):
        return f"CAST({value} AS DOUBLE)"
    if not isinstance(source, T.StringType):
        return None
    # Kept short on purpose: one wide row of these must stay small enough to be compiled.
    number = f"try_cast({value} AS DOUBLE)"
    long = " OR ".join([f"length({value}) > {SAFE_DIGITS}"] + [f"contains({value}, '{c}')" for c in "eEpP"])
    overflows = f"(({long}) AND abs({number}) = double('Infinity'))"
    return f"CASE WHEN ({_bare(value)} AND NOT {overflows}) OR {value} RLIKE '{SPECIAL_TEXT}' THEN {number} END"


def _bare(text: str) -> str:
    """True where a text begins and ends as a number does.

    A cast ignores blanks around a number and takes suffixes like ``d``; the accepted texts
    have neither. What lies in between, the cast checks itself. ``+`` to ``9`` are the
    characters a number can begin with, and comparing is much cheaper than a pattern.
    """
    end = f"right({text}, 1)"
    return f"({text} >= '+' AND {text} < ':' AND ({end} BETWEEN '0' AND '9' OR {end} = '.'))"


def to_text(value: str, source: T.DataType) -> str:
    if isinstance(source, T.StringType):
        return value
    if isinstance(source, (T.DoubleType, T.FloatType)):
        return printed_float(value)
    if isinstance(source, T.TimestampNTZType):
        return f"concat(CAST({value} AS STRING), ' +0000 UTC')"
    if isinstance(source, T.TimestampType):
        wall = f"convert_timezone('UTC', CAST({value} AS TIMESTAMP_NTZ))"
        return f"concat(CAST({wall} AS STRING), ' +0000 UTC')"
    if isinstance(source, (T.ArrayType, T.MapType, T.StructType)):
        return f"to_json({value})"
    # Bytes too are taken over as they are; invalid UTF-8 must not stop the job.
    return f"CAST({value} AS STRING)"


def printed_float(value: str) -> str:
    """Shortest text: no trailing ``.0``, exponent only below 1e-4 and from 1e21 on."""
    text = f"CAST({value} AS STRING)"
    sign = f"CASE WHEN {text} LIKE '-%' THEN '-' ELSE '' END"
    mantissa = f"regexp_replace(regexp_extract({text}, '^-?([0-9.]+)E', 1), '[.]0$', '')"
    digits = f"replace({mantissa}, '.', '')"
    exponent = f"try_cast(regexp_extract({text}, 'E(-?[0-9]+)$', 1) AS INT)"
    power = (
        f"concat(CASE WHEN {exponent} < 0 THEN 'e-' ELSE 'e+' END,"
        f" CASE WHEN abs({exponent}) < 10 THEN '0' ELSE '' END, CAST(abs({exponent}) AS STRING))"
    )
    return (
        f"CASE WHEN {text} = 'Infinity' THEN '+Inf' WHEN {text} = '-Infinity' THEN '-Inf'"
        f" WHEN NOT contains({text}, 'E') THEN regexp_replace({text}, '[.]0$', '')"
        f" WHEN {exponent} < -4 OR {exponent} >= 21 THEN concat({sign}, {mantissa}, {power})"
        f" WHEN {exponent} < 0 THEN concat({sign}, '0.', repeat('0', -{exponent} - 1), {digits})"
        f" WHEN length({digits}) <= {exponent} + 1 THEN concat({sign}, rpad({digits}, {exponent} + 1, '0'))"
        f" ELSE concat({sign}, left({digits}, {exponent} + 1), '.', substr({digits}, {exponent} + 2)) END"
    )


def to_wall_clock(value: str, source: T.DataType, zone: str = "UTC") -> str | None:
    """Zone-free timestamp: the clock reading is kept, the zone dropped."""
    if isinstance(source, (T.TimestampNTZType, T.DateType)):
        return f"CAST({value} AS TIMESTAMP_NTZ)"
    if isinstance(source, T.TimestampType):
        return f"convert_timezone('{zone}', CAST({value} AS TIMESTAMP_NTZ))"
    if isinstance(source, T.StringType):
        # The layout test comes first, so each value is parsed at most once.
        return (
            f"CASE WHEN {value} RLIKE '{PLAIN_TIME_TEXT}' THEN try_cast({value} AS TIMESTAMP_NTZ)"
            f" WHEN {value} RLIKE '{ZONED_TIME_TEXT}'"
            f" THEN try_cast(regexp_replace({value}, '{ZONE_SUFFIX}', '') AS TIMESTAMP_NTZ) END"
        )
    return None


def to_instant(value: str, source: T.DataType) -> str | None:
    """Timestamp in UTC: the instant is kept; a reading without zone counts as UTC."""
    if isinstance(source, T.TimestampType):
        return value
    if isinstance(source, (T.TimestampNTZType, T.DateType)):
        return _utc_reading(f"CAST({value} AS TIMESTAMP_NTZ)")
    if isinstance(source, T.StringType):
        return (
            f"CASE WHEN {value} RLIKE '{PLAIN_TIME_TEXT}' THEN {_utc_reading(f'try_cast({value} AS TIMESTAMP_NTZ)')}"
            f" WHEN {value} RLIKE '{ZONED_TIME_TEXT}'"
            f" THEN try_cast(regexp_replace({value}, '{SPACED_ZONE}', '$1') AS TIMESTAMP) END"
        )
    return None


def _utc_reading(wall: str) -> str:
    """The instant at which a UTC clock shows ``wall``, whatever the session's zone."""
    return f"CAST(convert_timezone('UTC', current_timezone(), {wall}) AS TIMESTAMP)"


def to_flag(value: str, source: T.DataType) -> str | None:
    """Numbers: not zero. Text: one of the true texts; any other text is false, not NULL."""
    if isinstance(source, T.BooleanType):
        return value
    if isinstance(source, NUMBERS):
        return f"{value} != 0"
    if isinstance(source, T.StringType):
        return f"{value} IN ({', '.join(repr(t) for t in TRUE_TEXTS)})"
    return None
