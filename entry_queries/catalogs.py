"""M rows: lists, filters, schemas and the nested tree of an inventory."""

from pyspark.sql import functions as F

from tableferry import (
    NotFound, catalog_inventory, ingest, like, list_catalogs, list_columns, list_schemas, list_tables, object_tree, table_types,
)
from tableferry.operators.inventory import table_fields, table_schema

from .common import new_schema, read
from .stock import PART_INVENTORY_SQL, part_inventory

QUERIES = {}
_WITH = f"WITH i AS ({PART_INVENTORY_SQL}) "


def over_inventory(name, build, sql):
    QUERIES[name] = (lambda spark, sf_dir: build(part_inventory(spark, sf_dir)), _WITH + sql)


over_inventory("m1_catalogs", lambda i: list_catalogs(i, "%a%"),
               "SELECT DISTINCT catalog FROM i WHERE catalog ILIKE '%a%'")
over_inventory("m2_schemas", lambda i: list_schemas(i, "main", "BRAND_1%"),
               "SELECT DISTINCT catalog, schema FROM i WHERE catalog = 'MAIN' AND schema LIKE 'BRAND\\_1%' ESCAPE '\\'")
over_inventory("m3_tables", lambda i: list_tables(i, table="%_1%"),
               "SELECT DISTINCT catalog, schema, \"table\", table_type FROM i WHERE table_type IN ('TABLE', 'VIEW')"
               " AND \"table\" LIKE '%\\_1%' ESCAPE '\\'")
over_inventory("m4_columns", lambda i: list_columns(i, schema="%2%", column="big_%"),
               """SELECT catalog, schema, "table", "column", position, data_type AS type_name,
                  CASE nullable WHEN 'Y' THEN 'nullable' WHEN 'N' THEN 'no nulls' ELSE 'unknown' END AS nullability,
                  precision AS column_size, scale AS decimal_digits, "default" AS column_default
                  FROM i WHERE schema LIKE '%2%' AND "column" LIKE 'BIG\\_%' ESCAPE '\\'""")
over_inventory("m5_table_types", table_types,
               """SELECT t AS table_type, count(DISTINCT (catalog, schema, "table")) FILTER (table_type IS NOT NULL) AS n
                  FROM (SELECT unnest(['TABLE', 'VIEW', 'MATERIALIZED VIEW', 'SYNONYM']) AS t) k
                  LEFT JOIN i ON table_type = t GROUP BY t""")
def schema_rows(inventory):
    """The schema a table is read with as rows, beside the places its columns have in the inventory."""
    try:
        schema = table_schema(inventory, "brand_2", "economy_0")
    except NotFound:  # a small inventory has no such table
        schema = []
    fields = inventory.sparkSession.createDataFrame(
        [(f.name, f.dataType.simpleString(), f.nullable) for f in schema], "name string, spark_type string, nullable boolean")
    places = table_fields(inventory, "brand_2", "economy_0").select("position", "name")
    return places.join(fields, "name").select("position", "name", "spark_type", "nullable")


over_inventory("m6_table_schema", schema_rows,
               """SELECT position, "column" AS name,
                  CASE WHEN upper(data_type) = 'NUMBER' AND scale = 0 AND precision <= 18 THEN 'bigint'
                       WHEN upper(data_type) = 'NUMBER' AND scale = 0 THEN 'string'
                       WHEN upper(data_type) IN ('NUMBER', 'FLOAT', 'BINARY_FLOAT', 'BINARY_DOUBLE') THEN 'double'
                       WHEN data_type IN ('DATE', 'TIMESTAMP', 'TIMESTAMP(6)') THEN 'timestamp_ntz'
                       WHEN data_type LIKE 'TIMESTAMP%' THEN 'timestamp'
                       WHEN data_type IN ('RAW', 'BLOB', 'SDO_GEOMETRY') THEN 'binary'
                       WHEN data_type = 'BOOLEAN' THEN 'boolean' ELSE 'string' END AS spark_type,
                  nullable = 'Y' AS nullable
                  FROM i WHERE schema = 'BRAND_2' AND "table" = 'ECONOMY_0'""")

PATTERNS = ("%", "nation_1", "NATION_1%", "%_2", "%ION%1%", "nationX1", "%TION", "")


def name_filters(spark, sf_dir):
    """Every name against literal patterns, and against a pattern made from the next key."""
    names = read(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("Nation_"), "c_nationkey").alias("name"))
    literal = [like(F.col("name"), p).alias(f"p{i}") for i, p in enumerate(PATTERNS)]
    own = like(F.col("name"), F.concat(F.lit("%_"), (F.col("c_custkey") % 25).cast("string")))
    return names.select("c_custkey", *literal, own.alias("own"))


def _like_sql(pattern):
    escaped = pattern.replace("_", "\\_")
    return f"name ILIKE '{escaped}' ESCAPE '\\'"


QUERIES["m7_like"] = (
    name_filters,
    "SELECT c_custkey, " + ", ".join(f"{_like_sql(p)} AS p{i}" for i, p in enumerate(PATTERNS))
    + ", name ILIKE ('%\\_' || CAST(c_custkey % 25 AS VARCHAR)) ESCAPE '\\' AS own"
    " FROM (SELECT c_custkey, 'Nation_' || CAST(c_nationkey AS VARCHAR) AS name FROM customer) n",
)


def tree(inventory):
    """The tree opened up again, so that every leaf can be compared."""
    nested = object_tree(inventory, "columns", schema="BRAND%", column="%1%")
    return nested.select("catalog", "schema", "table", "table_type", F.explode_outer("columns").alias("c")).select(
        "catalog", "schema", "table", "table_type", F.col("c.position").alias("position"),
        F.col("c.column").alias("column"), F.col("c.nullability").alias("nullability"),
    )


def shallow(inventory):
    views = object_tree(inventory, "tables", kinds=["VIEW"])
    return views.groupBy("catalog", "schema").agg(F.count("*").cast("int").alias("n_tables"), F.min("table").alias("first_table"))


over_inventory("m8_object_tree", tree, """
    SELECT catalog, schema, "table", table_type, position, "column",
           CASE nullable WHEN 'Y' THEN 'nullable' WHEN 'N' THEN 'no nulls' ELSE 'unknown' END AS nullability
    FROM i WHERE "column" LIKE '%1%'
    UNION ALL
    SELECT DISTINCT catalog, schema, "table", table_type, CAST(NULL AS INT), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR)
    FROM (SELECT *, max(CASE WHEN "column" LIKE '%1%' THEN 1 ELSE 0 END) OVER (PARTITION BY catalog, schema, "table") AS has FROM i) j
    WHERE has = 0""")
over_inventory("m8_table_level", shallow, """
    SELECT catalog, schema, CAST(count(DISTINCT "table") AS INT) AS n_tables, min("table") AS first_table
    FROM i WHERE table_type = 'VIEW' GROUP BY catalog, schema""")


def live_catalog(spark, sf_dir):
    """Tables that are loaded now and a view, as the session's catalog lists them, each with its number of rows."""
    schema = new_schema(spark, "m9")
    for name in ("customer", "orders"):
        ingest(read(spark, sf_dir, name), f"{schema}.{name}_copy")
    spark.sql(f"CREATE VIEW {schema}.orders_seen AS SELECT * FROM {schema}.orders_copy WHERE O_TOTALPRICE > 1000")
    spark.sql(f"CREATE VIEW {schema}.other AS SELECT 1 AS x")
    listed = list_columns(catalog_inventory(spark, schema=schema, table="%ers%").unionByName(
        catalog_inventory(spark, schema=schema, table="CUSTOMER_%")))
    sizes = None
    for name in ("CUSTOMER_COPY", "ORDERS_COPY", "ORDERS_SEEN"):
        one = spark.table(f"{schema}.{name}").agg(F.count("*").alias("n")).select(F.lit(name).alias("table"), "n")
        sizes = one if sizes is None else sizes.unionByName(one)
    kinds = list_tables(catalog_inventory(spark, schema=schema)).select("table", "table_type")
    return listed.join(sizes, "table").join(kinds, "table").select(
        "table", "table_type", "column", "position", "type_name", "nullability", "column_size", "decimal_digits", "n")


_LISTED = "SELECT 'CUSTOMER_COPY', 'TABLE', 'customer', (SELECT count(*) FROM customer)" \
    " UNION ALL SELECT 'ORDERS_COPY', 'TABLE', 'orders', (SELECT count(*) FROM orders)" \
    " UNION ALL SELECT 'ORDERS_SEEN', 'VIEW', 'orders', (SELECT count(*) FROM orders WHERE o_totalprice > 1000)"
QUERIES["m9_live_catalog"] = (
    live_catalog,
    f"""SELECT l.name AS "table", kind AS table_type, upper(column_name) AS "column", CAST(ordinal_position AS INT) AS position,
        CASE data_type WHEN 'VARCHAR' THEN 'VARCHAR2' WHEN 'DOUBLE' THEN 'BINARY_DOUBLE' WHEN 'TIMESTAMP' THEN 'TIMESTAMP(6)' ELSE 'NUMBER' END AS type_name,
        'nullable' AS nullability, CASE WHEN data_type IN ('BIGINT', 'INTEGER') THEN 19 END AS column_size,
        CASE WHEN data_type IN ('BIGINT', 'INTEGER') THEN 0 END AS decimal_digits, n
        FROM ({_LISTED}) l(name, kind, source, n) JOIN information_schema.columns c ON c.table_name = l.source""",
)
