"""Values in the form a load sends them: few physical types, nothing lossy."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .typemaps import is_text


def plain_decimal(text: Column) -> Column:
    """A decimal's text without an exponent, which Spark writes for small ones unless ANSI is on."""
    digits = F.regexp_replace(F.substring_index(text, "E", 1), "[-.]", "")
    zeros = F.substring_index(text, "E-", -1).try_cast("int") - 1
    small = F.concat(F.when(text.startswith("-"), "-").otherwise(""), F.lit("0."), F.repeat(F.lit("0"), zeros), digits)
    return F.when(F.contains(text, F.lit("E")), small).otherwise(text)


def load_form(value: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)):
        # A flag is sent as 0 or 1, never as the words.
        return value.cast("bigint")
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return value.cast("double")
    if isinstance(data_type, T.DecimalType):
        # Text keeps every digit and the scale; unsigned 64-bit arrives as decimal(20,0).
        return plain_decimal(value.cast("string"))
    if is_text(data_type) or isinstance(data_type, (T.BinaryType, T.TimestampNTZType, T.TimestampType)):
        return value
    if isinstance(data_type, T.DateType):
        return value.cast(T.TimestampNTZType())
    if isinstance(data_type, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(value)
    return value.cast("string")
