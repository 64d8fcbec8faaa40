"""Type maps in both directions, as CASE expressions over column inventories and schemas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Database type names. "wire" names occur only in query results,
# never in a column catalog.
FLOAT_NAMES = ("FLOAT", "BINARY_FLOAT", "BINARY_DOUBLE")
FLOAT_WIRE_NAMES = ("IBFLOAT", "IBDOUBLE", "BFLOAT", "BDOUBLE")
TEXT_NAMES = ("VARCHAR2", "VARCHAR", "NVARCHAR2", "CHAR", "NCHAR", "CLOB", "NCLOB", "LONG", "ROWID")
TEXT_WIRE_NAMES = ("LONGVARCHAR", "UROWID", "OCICLOBLOCATOR")
BYTES_NAMES = ("RAW", "LONG RAW", "BLOB")
BYTES_WIRE_NAMES = ("LONGRAW", "OCIBLOBLOCATOR", "OCIFILELOCATOR")
GEOMETRY_NAMES = ("SDO_GEOMETRY", "MDSYS.SDO_GEOMETRY")
GEOMETRY_DDL = "MDSYS.SDO_GEOMETRY"
FALLBACK_DDL = "VARCHAR2(4000)"
MAX_EXACT_DIGITS = 18

VARIANTS = ("query", "catalog")


def source_type(
    data_type: Column,
    precision: Column,
    scale: Column,
    variant: str = "query",
    strict_reference: bool = False,
    number_mode: str = "text",
) -> Column:
    """Spark type name for a database column type.

    A fractional-seconds digit, as in ``TIMESTAMP(6)``, does not change the class of a
    type, so it is removed first; ``strict_reference`` leaves it in, which makes such
    columns zone-aware.
    """
    wire = variant == "query"
    name = F.upper(data_type)
    if not strict_reference:
        name = F.regexp_replace(name, r"^(TIMESTAMP) *\([0-9]+\)", "$1")
    whole = (name == "NUMBER") & (scale == 0)
    long_whole = F.lit("string")
    if number_mode == "decimal":
        long_whole = F.concat(F.lit("decimal("), F.least(precision, F.lit(38)), F.lit(",0)"))
    floats = FLOAT_NAMES + (FLOAT_WIRE_NAMES if wire else ())
    texts = TEXT_NAMES + (TEXT_WIRE_NAMES if wire else ())
    blobs = BYTES_NAMES + (BYTES_WIRE_NAMES if wire else ())
    zone_free = ("DATE", "TIMESTAMP") + (("TIMESTAMPDTY",) if wire else ())
    geometry = GEOMETRY_NAMES if wire else GEOMETRY_NAMES[:1]
    return (
        F.when(whole & precision.between(1, MAX_EXACT_DIGITS), "bigint")
        .when(whole & (precision > MAX_EXACT_DIGITS), long_whole)
        .when((name == "NUMBER") | name.isin(*floats), "double")
        .when(name.isin(*texts), "string")
        .when(name.isin(*zone_free), "timestamp_ntz")
        .when(name.startswith("TIMESTAMP"), "timestamp")
        .when(name.startswith("INTERVAL"), "string")
        .when(name.isin(*blobs, *geometry), "binary")
        .when(name == "BOOLEAN", "boolean")
        .otherwise("string")
    )


def is_text(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.StringType, T.VarcharType, T.CharType))


def target_type(data_type: T.DataType) -> str:
    """Database column type for a Spark type; text is sized elsewhere (see ``plans``)."""
    if isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "NUMBER(19)"
    if isinstance(data_type, T.FloatType):
        return "BINARY_FLOAT"
    if isinstance(data_type, T.DoubleType):
        return "BINARY_DOUBLE"
    if isinstance(data_type, T.DecimalType):
        fits = 1 <= data_type.precision <= 38 and 0 <= data_type.scale <= data_type.precision
        return f"NUMBER({data_type.precision},{data_type.scale})" if fits else "NUMBER"
    if isinstance(data_type, T.BinaryType):
        return "BLOB"
    if isinstance(data_type, T.BooleanType):
        return "NUMBER(1)"
    if isinstance(data_type, T.TimestampNTZType):
        return "TIMESTAMP(6)"
    if isinstance(data_type, T.TimestampType):
        return "TIMESTAMP(6) WITH TIME ZONE"
    if isinstance(data_type, T.DateType):
        return "DATE"
    return FALLBACK_DDL
