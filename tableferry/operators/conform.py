"""Whole tables to a declared schema, to the form a load sends, and back again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import InvalidArgument
from ..functions.coerce import coerce, nothing
from ..functions.loadform import load_form
from ..functions.typemaps import source_type
from ..plans.columns import quote, sql_text, upper_names


def conform(df: DataFrame, schema: T.StructType, on_error: str = "null", zone: str = "UTC") -> DataFrame:
    """``df`` with exactly the columns of ``schema``, matched by name in any case.

    A value without a conversion becomes NULL; with ``on_error="fail"`` it stops the job.
    ``zone`` is the zone whose clock is read when an instant loses its zone.
    """
    if on_error not in ("null", "fail"):
        raise InvalidArgument(f"on_error must be null or fail, got {on_error!r}")
    sources = {}
    for field in df.schema:
        if sources.setdefault(field.name.lower(), field) is not field:
            raise InvalidArgument(f"source columns {sources[field.name.lower()].name} and {field.name} differ in case only")
    columns = []
    for target in schema:
        source = sources.get(target.name.lower())
        if source is None:
            value = nothing(target.dataType)
        else:
            raw = quote(source.name)
            value = coerce(raw, source.dataType, target.dataType, zone)
            if on_error == "fail":
                kind = target.dataType.simpleString()
                message = f"concat({sql_text(f'column {target.name}: no {kind} in ')}, CAST({raw} AS STRING))"
                value = (f"CASE WHEN {raw} IS NOT NULL AND {value} IS NULL"
                         f" THEN CAST(raise_error({message}) AS {kind}) ELSE {value} END")
        columns.append(F.expr(value).alias(target.name, metadata=target.metadata or {}))
    return df.select(*columns)


def to_load_form(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every column in the form a load sends; columns in ``keep`` are passed on untouched."""
    return df.select(
        *[
            (F.col(quote(f.name)) if f.name in keep else load_form(F.col(quote(f.name)), f.dataType)).alias(
                f.name, metadata=f.metadata or {}
            )
            for f in df.schema
        ]
    )


def normalise_names(df: DataFrame) -> DataFrame:
    return df.select(
        *[F.col(quote(old)).alias(new) for old, new in zip(df.columns, upper_names(df.columns))]
    )


def map_source_types(
    columns: DataFrame, variant: str = "query", strict_reference: bool = False, number_mode: str = "text"
) -> DataFrame:
    """Adds ``spark_type`` to rows of (data_type, precision, scale)."""
    if variant not in ("query", "catalog"):
        raise InvalidArgument(f"variant must be query or catalog, got {variant!r}")
    return columns.withColumn(
        "spark_type",
        source_type(F.col("data_type"), F.col("precision"), F.col("scale"),
                    variant, strict_reference, number_mode),
    )


def stored_types(plan: DataFrame) -> DataFrame:
    """Spark type each planned column is read back with: declared type through the read map."""
    parts = F.regexp_extract(F.col("declared"), r"\((\d+)(?:,(\d+))?\)", 1).try_cast("int")
    scale = F.coalesce(
        F.regexp_extract(F.col("declared"), r"\((\d+),(\d+)\)", 2).try_cast("int"), F.lit(0)
    )
    is_number = F.col("declared").startswith("NUMBER")
    base = F.when(is_number, F.lit("NUMBER")).otherwise(
        F.regexp_replace(F.col("declared"), r"^(VARCHAR2)\(\d+\)", "$1")
    )
    return plan.withColumn(
        "read_type",
        source_type(base, F.when(is_number, parts), F.when(is_number & parts.isNotNull(), scale), "query"),
    )


def read_back(df: DataFrame, plan_columns_types: dict[str, str]) -> DataFrame:
    """What a reader sees after the load: empty text is NULL, types follow the read map."""
    schema = T.StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in plan_columns_types.items()))
    stored = to_load_form(df)
    blanked = stored.select(
        *[
            (F.nullif(F.col(quote(f.name)), F.lit("")) if isinstance(f.dataType, T.StringType)
             else F.col(quote(f.name))).alias(f.name)
            for f in stored.schema
        ]
    )
    return conform(blanked, schema)
