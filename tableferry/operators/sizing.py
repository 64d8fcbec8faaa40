"""Text widths, load plans and width checks.

Every operator here is one pass with map-side combining: what is shuffled per task is one
row of maxima, or one row per batch. A third of all rows under one batch costs no more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.loadform import load_form
from ..functions.typemaps import is_text
from ..plans.columns import LoadPlan, plan_rows, quote, scanned_columns
from ..plans.options import LoadOptions
from ..session import cut_lineage

DEFAULT_SCAN_LIMIT = 64 << 20
HINT = (
    "value is wider than the column chosen from the scanned rows: name the column in "
    "clob_columns, or set string_type=clob"
)


def width_of(field: T.StructField) -> Column:
    """Bytes of a value in the form it is loaded in."""
    return F.octet_length(load_form(F.col(quote(field.name)), field.dataType))


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if is_text(f.dataType)]


def _width(name: str) -> Column:
    return F.coalesce(F.max(F.octet_length(quote(name))), F.lit(0)).cast("bigint").alias(name)


def width_row(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row with the widest value, in bytes, of every text column, or of the named ones."""
    columns = text_columns(df) if columns is None else columns
    return df.agg(*[
        F.coalesce(F.max(width_of(df.schema[name])), F.lit(0)).cast("bigint").alias(name) for name in columns
    ])


def profile_text(df: DataFrame) -> DataFrame:
    """(column, max_bytes) per text column; a column without values has width 0."""
    columns = text_columns(df)
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, max_bytes bigint")
    cells = [F.struct(F.lit(c).alias("column"), F.col(quote(c)).alias("max_bytes")) for c in columns]
    return width_row(df, columns).select(F.inline(F.array(*cells)))


def record_bytes(schema: T.StructType) -> Column:
    """Estimated bytes of a row: values, not headers; nested children included."""
    total = F.lit(0).cast("bigint")
    for field in schema:
        total = total + _value_bytes(F.col(quote(field.name)), field.dataType)
    return total


def _value_bytes(value: Column, data_type: T.DataType) -> Column:
    fixed = _fixed_bytes(data_type)
    if fixed is not None:
        size = F.lit(fixed)
    elif isinstance(data_type, T.ArrayType):
        item = _fixed_bytes(data_type.elementType)
        size = (
            F.size(value) * item
            if item is not None
            else F.aggregate(value, F.lit(0).cast("bigint"),
                             lambda n, v: n + _value_bytes(v, data_type.elementType))
        )
    elif isinstance(data_type, T.MapType):
        size = _value_bytes(F.map_keys(value), T.ArrayType(data_type.keyType)) + _value_bytes(
            F.map_values(value), T.ArrayType(data_type.valueType)
        )
    elif isinstance(data_type, T.StructType):
        size = F.lit(0)
        for field in data_type:
            size = size + _value_bytes(value[field.name], field.dataType)
    else:
        size = F.octet_length(value.cast("string") if not isinstance(data_type, T.BinaryType) else value)
    return F.when(value.isNull(), F.lit(0)).otherwise(size).cast("bigint")


def _fixed_bytes(data_type: T.DataType) -> int | None:
    # Bytes per value of the fixed-width types.
    widths = {
        T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8,
        T.FloatType: 4, T.DoubleType: 8, T.DateType: 4, T.TimestampType: 8, T.TimestampNTZType: 8,
        T.DecimalType: 16,
    }
    return widths.get(type(data_type))


def scan_window(df: DataFrame, batch: str, limit: int = DEFAULT_SCAN_LIMIT) -> DataFrame:
    """Per batch: rows, bytes, text widths, bytes before it, and whether it is scanned.

    Batches are read in order until ``limit`` bytes have been seen; the last one counts in
    full. A report only: plans are made from all rows. The table is read once, when this is
    called. The totals per batch are range-partitioned by batch number, whatever the numbers
    are, and running totals are formed inside each partition; the driver gets one sum per
    partition, for the bytes before it.
    """
    columns = [c for c in text_columns(df) if c != batch]
    totals = df.groupBy(F.col(quote(batch)).cast("bigint").alias("batch")).agg(
        F.count("*").alias("n_rows"),
        F.sum(record_bytes(df.drop(batch).schema)).alias("bytes"),
        *[_width(name) for name in columns],
    )
    # Rows without a batch number form a batch of their own, before all others.
    ranged = cut_lineage(totals.repartitionByRange(F.col("batch").asc_nulls_first())).withColumn("__part", F.spark_partition_id())
    sums = dict(ranged.groupBy("__part").agg(F.sum("bytes")).collect())
    offset, before = 0, {}
    for part in sorted(sums):
        before[part] = offset
        offset += sums[part]
    offsets = F.create_map(*[F.lit(x) for pair in before.items() for x in pair]) if before else F.create_map().cast("map<int,int>")
    inside = F.coalesce(
        F.sum("bytes").over(Window.partitionBy("__part").orderBy(F.col("batch").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0),
    )
    seen = (offsets[F.col("__part")] + inside).cast("bigint")
    return ranged.select(
        "batch", "n_rows", "bytes", *[quote(c) for c in columns], seen.alias("bytes_before"), (seen < limit).alias("scanned"),
    )


def plan_frame(df: DataFrame, options: LoadOptions | dict | None = None) -> DataFrame:
    """The plan as a table: position, name, source_type, width, declared, nullable.

    All rows are looked at, and only if some column's type depends on them. (A load takes no
    such pass: its write finds the widths.)
    """
    options = LoadOptions.parse(options)
    columns = scanned_columns(df.schema, options)
    if not columns or options.type_scan_limit_bytes == 0:
        widths = df.sparkSession.range(1).select()
    else:
        widths = width_row(df, columns)
    return plan_rows(widths, df.schema, options)


def plan_columns(df: DataFrame, options: LoadOptions | dict | None = None) -> LoadPlan:
    """The plan on the driver: one row per column of the schema."""
    options = LoadOptions.parse(options)
    return LoadPlan.of(plan_frame(df, options), options)


def batch_bind_kind(df: DataFrame, batch: str, limit: int) -> DataFrame:
    """Per batch and text column: whether its values travel as text or as large objects."""
    columns = [c for c in text_columns(df) if c != batch]
    if not columns:
        return df.select(F.col(batch).alias("batch"), F.lit("").alias("column"), F.lit(0).cast("bigint").alias("max_bytes"),
                         F.lit("text").alias("kind")).where("false")
    cells = [
        F.struct(
            F.lit(c).alias("column"), F.col(quote(c)).alias("max_bytes"),
            F.when(F.col(quote(c)) > limit, "lob").otherwise("text").alias("kind"),
        )
        for c in columns
    ]
    widths = df.groupBy(F.col(batch).alias("batch")).agg(*[_width(c) for c in columns])
    return widths.select("batch", F.inline(F.array(*cells)))


def violations(df: DataFrame, plan: LoadPlan, keys: list[str]) -> DataFrame:
    """Values that do not fit their planned column: keys, column, width, declared, hint."""
    limits = plan.limits()
    cells = [
        F.struct(
            F.lit(f.name.upper()).alias("column"),
            width_of(f).cast("bigint").alias("width"),
            F.lit(limits[f.name.upper()]).cast("bigint").alias("declared_bytes"),
        )
        for f in df.schema
        if f.name.upper() in limits
    ]
    if not cells:
        cells = [F.struct(F.lit("").alias("column"), F.lit(0).cast("bigint").alias("width"),
                          F.lit(0).cast("bigint").alias("declared_bytes"))]
    too_wide = F.filter(F.array(*cells), lambda c: c["width"] > c["declared_bytes"])
    return df.select(*keys, F.inline(too_wide)).withColumn("hint", F.lit(HINT))


def guarded(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """The same rows; the job fails as soon as a value exceeds its column."""
    columns = {}
    for name, limit in limits.items():
        if name in df.columns:
            value = F.col(quote(name))
            message = F.concat(
                F.lit(f"column {name} declared with {limit} bytes, value has "),
                F.octet_length(value).cast("string"), F.lit(f" ({HINT})"),
            )
            columns[name] = F.when(F.octet_length(value) > limit, F.raise_error(message).cast("string")).otherwise(value)
    return df.withColumns(columns) if columns else df
