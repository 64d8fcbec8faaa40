"""Catalogs from a column inventory: lists, filters, schemas and the nested tree.

An inventory is a table with one row per column of every table:
(catalog, schema, table, table_type, column, position, data_type, nullable, default,
precision, scale).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import InvalidArgument, NotFound
from ..functions.likes import like
from ..functions.typemaps import source_type
from ..plans.columns import quote, target_types
from .ingest import name_parts, stored_plan

# Table kinds that are always listed, and the texts for nullability.
TABLE_TYPES = ("TABLE", "VIEW", "MATERIALIZED VIEW", "SYNONYM")
LISTED_TYPES = ("TABLE", "VIEW")
NULLABLE, NO_NULLS, UNKNOWN = "nullable", "no nulls", "unknown"
DEPTHS = ("catalogs", "schemas", "tables", "columns")
#: Tables that are described at a time.
DESCRIBERS = 8

INVENTORY = T.StructType.fromJson(
    {
        "type": "struct",
        "fields": [
            {"name": name, "type": kind, "nullable": True, "metadata": {}}
            for name, kind in (
                ("catalog", "string"), ("schema", "string"), ("table", "string"),
                ("table_type", "string"), ("column", "string"), ("position", "integer"),
                ("data_type", "string"), ("nullable", "string"), ("default", "string"),
                ("precision", "integer"), ("scale", "integer"),
            )
        ],
    }
)


def inventory_of(spark: SparkSession, tables: dict[str, T.StructType], catalog: str, schema: str) -> DataFrame:
    """Inventory rows for Spark schemas, with the database types a load would declare."""
    rows = [row for table, fields in tables.items()
            for row in _described(catalog, schema, table.upper(), "TABLE", fields, target_types(fields))]
    return spark.createDataFrame(rows, INVENTORY)


def _described(catalog: str, schema: str, table: str, kind: str, fields: T.StructType, declared: list[tuple[str, str]]) -> list[tuple]:
    rows = []
    for position, (field, (name, target)) in enumerate(zip(fields, declared), start=1):
        base, _, digits = target.partition("(")
        numeric = [int(d) for d in digits.rstrip(")").split(",")] if base == "NUMBER" and digits else []
        precision = numeric[0] if numeric else None
        scale = (numeric + [0])[1] if numeric else None
        rows.append((catalog, schema, table, kind, name, position, base if base in ("NUMBER", "VARCHAR2") else target,
                     "Y" if field.nullable else "N", None, precision, scale))
    return rows


def catalog_inventory(
    spark: SparkSession, catalog: str | None = None, schema: str | None = None, table: str | None = None,
    kinds: list[str] | None = None,
) -> DataFrame:
    """The inventory of the session's own catalogs: tables and views as they are now, in upper case.

    Patterns (see ``like``) and kinds choose names before any table is described. Types are those of
    the plan a table was loaded with, else what a load would declare. A view that can no longer be read
    is listed with one row without a column. Temporary views belong to no schema and are left out. Names and columns come
    through the driver, where Spark keeps its catalogs; what the filters leave should fit there.
    """
    chosen = []
    for (place,) in _matching(spark.sql("SHOW CATALOGS"), "catalog", catalog):
        for (space,) in _matching(spark.sql(f"SHOW NAMESPACES IN {quote(place)}"), "namespace", schema):
            inside = f"{quote(place)}.{'.'.join(map(quote, name_parts(space)))}"
            # Only the session's own catalog has views of Spark.
            views = {r.viewName for r in spark.sql(f"SHOW VIEWS IN {inside}").collect()} if place == "spark_catalog" else set()
            listed = spark.sql(f"SHOW TABLES IN {inside}").where("NOT isTemporary").select("tableName")
            for (name,) in _matching(listed, "tableName", table):
                kind = "VIEW" if name in views else "TABLE"
                if not kinds or kind in kinds:
                    chosen.append((place, space, name, kind, f"{inside}.{quote(name)}"))

    def describe(entry: tuple) -> list[tuple]:
        place, space, name, kind, full = entry
        labels = (place.upper(), space.upper(), name.upper())
        try:
            fields = spark.table(full).schema
        except AnalysisException:
            return [(*labels, kind, None, None, None, None, None, None, None)]
        plan = stored_plan(spark, full) if kind == "TABLE" else None
        known = plan.declared if plan else {}
        return _described(*labels, kind, fields, [(n, known.get(n, target)) for n, target in target_types(fields)])

    with ThreadPoolExecutor(DESCRIBERS) as pool:
        rows = [row for described in pool.map(describe, chosen) for row in described]
    return spark.createDataFrame(rows, INVENTORY)


def _matching(names: DataFrame, column: str, pattern: str | None) -> list:
    return (names if pattern is None else names.where(like(F.col(column), pattern))).collect()


def _filtered(inventory: DataFrame, **patterns: str | None) -> DataFrame:
    for column, pattern in patterns.items():
        if pattern is not None:
            inventory = inventory.where(like(F.col(f"`{column}`"), pattern))
    return inventory


def list_catalogs(inventory: DataFrame, catalog: str | None = None) -> DataFrame:
    return _filtered(inventory.select("catalog"), catalog=catalog).distinct()


def list_schemas(inventory: DataFrame, catalog: str | None = None, schema: str | None = None) -> DataFrame:
    found = _filtered(inventory.select("catalog", "schema"), catalog=catalog, schema=schema)
    return found.distinct().orderBy("catalog", "schema")


def list_tables(
    inventory: DataFrame, catalog: str | None = None, schema: str | None = None, table: str | None = None
) -> DataFrame:
    """Tables and views, by name."""
    kinds = inventory.select("catalog", "schema", "table", "table_type").where(
        F.col("table_type").isin(*LISTED_TYPES)
    )
    found = _filtered(kinds, catalog=catalog, schema=schema, table=table)
    return found.distinct().orderBy("catalog", "schema", "table", "table_type")


def nullability(flag: Column) -> Column:
    return F.when(flag == "Y", NULLABLE).when(flag == "N", NO_NULLS).otherwise(UNKNOWN)


def list_columns(
    inventory: DataFrame, catalog: str | None = None, schema: str | None = None,
    table: str | None = None, column: str | None = None,
) -> DataFrame:
    """Columns in their tables' order, with size, digits, default and nullability."""
    found = _filtered(inventory, catalog=catalog, schema=schema, table=table, column=column)
    return found.select(
        "catalog", "schema", "table", "column", "position", F.col("data_type").alias("type_name"),
        nullability(F.col("nullable")).alias("nullability"), F.col("precision").alias("column_size"),
        F.col("scale").alias("decimal_digits"), F.col("default").alias("column_default"),
    ).orderBy("catalog", "schema", "table", "position")


def table_types(inventory: DataFrame) -> DataFrame:
    """How many objects there are of each kind; the standard kinds are always listed."""
    objects = inventory.select("catalog", "schema", "table", "table_type").distinct()
    counted = objects.groupBy("table_type").agg(F.count("*").alias("n"))
    kinds = F.explode(F.array(*[F.lit(kind) for kind in TABLE_TYPES])).alias("table_type")
    zero = inventory.sparkSession.range(1).select(kinds, F.lit(0).cast("bigint").alias("n"))
    return counted.unionByName(zero).groupBy("table_type").agg(F.sum("n").alias("n"))


def table_fields(inventory: DataFrame, schema: str, table: str, strict_reference: bool = False) -> DataFrame:
    """(position, name, spark_type, nullable) of one table."""
    one = inventory.where((F.col("schema") == schema.upper()) & (F.col("table") == table.upper()))
    spark_type = source_type(
        F.col("data_type"), F.col("precision"), F.col("scale"), "catalog", strict_reference
    )
    return one.select(
        "position", F.col("column").alias("name"), spark_type.alias("spark_type"),
        (F.col("nullable") == "Y").alias("nullable"),
    )


def table_schema(inventory: DataFrame, schema: str, table: str, strict_reference: bool = False) -> T.StructType:
    """The schema a table is read with; as many rows reach the driver as it has columns."""
    rows = table_fields(inventory, schema, table, strict_reference).orderBy("position").collect()
    if not rows:
        raise NotFound(f"table {schema.upper()}.{table.upper()} not found")
    types = T.StructType.fromDDL(", ".join(f"c{i} {row.spark_type}" for i, row in enumerate(rows)))
    return T.StructType(
        [T.StructField(row.name, field.dataType, bool(row.nullable)) for row, field in zip(rows, types)]
    )


def object_tree(
    inventory: DataFrame, depth: str = "columns", catalog: str | None = None, schema: str | None = None,
    table: str | None = None, column: str | None = None, kinds: list[str] | None = None,
) -> DataFrame:
    """One row per node at ``depth``, with the nodes above it: catalog, schema, table, table_type.

    At depth ``columns`` a table's row holds the list of its columns, in order. The shape is
    the same at every size, and no row holds more than one table. A pattern on columns thins
    the lists; a table without a match keeps its place, with an empty list. One shuffle.
    """
    if depth not in DEPTHS:
        raise InvalidArgument(f"depth must be one of {', '.join(DEPTHS)}, got {depth!r}")
    level = DEPTHS.index(depth)
    rows = _filtered(inventory, catalog=catalog)
    if level >= 1:
        rows = _filtered(rows, schema=schema)
    if level >= 2:
        rows = _filtered(rows, table=table)
        if kinds:
            rows = rows.where(F.col("table_type").isin(*kinds))
    keys = (["catalog"], ["catalog", "schema"])[level] if level < 2 else ["catalog", "schema", "table", "table_type"]
    if level < 3:
        return rows.select(*keys).distinct()
    described = F.struct(
        "position", "column", F.col("data_type").alias("type_name"),
        nullability(F.col("nullable")).alias("nullability"), F.col("precision").alias("column_size"),
        F.col("scale").alias("decimal_digits"), F.col("default").alias("column_default"),
    )
    wanted = F.col("column").isNotNull()
    if column is not None:
        wanted = wanted & like(F.col("column"), column)
    # Collecting skips nulls, so tables without a match are kept in the same pass.
    return rows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.when(wanted, described))).alias("columns"))
