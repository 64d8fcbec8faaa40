"""Type map of database columns, name patterns, lists and the nested tree."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry import (
    InvalidArgument, NotFound, catalog_inventory, ingest, inventory_of, like, list_catalogs, list_columns, list_schemas, list_tables,
    map_source_types, object_tree, table_schema, table_types,
)
from tableferry.operators.inventory import INVENTORY

QUERY_TYPES = [
    ("NUMBER", 9, 0, "bigint"), ("number", 18, 0, "bigint"), ("NUMBER", 19, 0, "string"), ("NUMBER", 12, 2, "double"),
    ("NUMBER", None, None, "double"), ("NUMBER", None, 0, "double"), ("NUMBER", 0, 0, "double"), ("FLOAT", 126, None, "double"),
    ("BINARY_DOUBLE", None, None, "double"), ("IBFLOAT", None, None, "double"), ("NVARCHAR2", None, None, "string"),
    ("UROWID", None, None, "string"), ("LONGVARCHAR", None, None, "string"), ("OCICLOBLOCATOR", None, None, "string"),
    ("DATE", None, None, "timestamp_ntz"), ("TIMESTAMP", None, None, "timestamp_ntz"), ("TIMESTAMPDTY", None, None, "timestamp_ntz"),
    ("TIMESTAMP(6)", None, 6, "timestamp_ntz"), ("TIMESTAMPTZ_DTY", None, None, "timestamp"),
    ("TIMESTAMP(6) WITH TIME ZONE", None, 6, "timestamp"), ("TIMESTAMP WITH LOCAL TIME ZONE", None, None, "timestamp"),
    ("INTERVAL YEAR TO MONTH", None, None, "string"), ("RAW", None, None, "binary"), ("LONG RAW", None, None, "binary"),
    ("OCIFILELOCATOR", None, None, "binary"), ("BOOLEAN", None, None, "boolean"), ("SDO_GEOMETRY", None, None, "binary"),
    ("MDSYS.SDO_GEOMETRY", None, None, "binary"), ("XMLTYPE", None, None, "string"), ("VECTOR", None, None, "string"), (None, None, None, "string"),
]


def test_source_types(spark):
    df = spark.createDataFrame([c[:3] for c in QUERY_TYPES], "data_type string, precision int, scale int")
    assert [r.spark_type for r in map_source_types(df).collect()] == [c[3] for c in QUERY_TYPES]
    catalog = {r.data_type: r.spark_type for r in map_source_types(df, "catalog").collect()}
    # Wire names mean nothing in a catalog.
    assert (catalog["IBFLOAT"], catalog["OCIFILELOCATOR"], catalog["TIMESTAMPDTY"]) == ("string", "string", "timestamp")
    strict = {r.data_type: r.spark_type for r in map_source_types(df, "catalog", strict_reference=True).collect()}
    assert strict["TIMESTAMP(6)"] == "timestamp" and strict["TIMESTAMP"] == "timestamp_ntz"
    exact = {(r.data_type, r.precision): r.spark_type for r in map_source_types(df, number_mode="decimal").collect()}
    assert exact[("NUMBER", 19)] == "decimal(19,0)"
    with pytest.raises(InvalidArgument):
        map_source_types(df, "wire")


MATCHES = [
    ("ADMIN", "%", True), ("ADMIN", "ADMIN", True), ("ADMIN", "admin", True), ("ADMIN", "ADM%", True), ("ADMIN", "%MIN", True),
    ("ADMIN", "%DM%", True), ("ADMIN", "NOPE", False), ("ADMIN", "ADM", False), ("ADMIN", "%XYZ%", False),
    ("FIRES_WORLDWIDE", "FIRES%", True), ("FIRES_WORLDWIDE", "%WORLD%", True), ("ABAB", "%AB", True), ("A_B", "AxB", False),
    ("AXB", "A_B", False), ("A_B", "a_b", True), ("A\\B", "a\\b", True), ("", "%", True), ("A%B", "a%b", True),
]


@pytest.mark.parametrize("as_column", [False, True])
def test_name_patterns(spark, as_column):
    df = spark.createDataFrame(MATCHES, "v string, p string, want boolean")
    for row in df.collect() if not as_column else [None]:
        if as_column:
            assert df.where(like(F.col("v"), F.col("p")) != F.col("want")).count() == 0
        else:
            assert df.where((F.col("p") == row.p) & (F.col("v") == row.v)).select(like(F.col("v"), row.p)).first()[0] is row.want


@pytest.fixture(scope="module")
def inventory(spark):
    def column(table, kind, name, position, data_type="NUMBER", nullable="Y", precision=9, scale=0, schema="SALES", catalog="MAIN"):
        return (catalog, schema, table, kind, name, position, data_type, nullable, None, precision, scale)

    rows = [
        column("ORDERS", "TABLE", "ID", 1, nullable="N"), column("ORDERS", "TABLE", "PLACED", 2, "TIMESTAMP(6)", "Y", None, 6),
        column("ORDERS", "TABLE", "NOTE", 3, "CLOB", None, None, None), column("BIG_ORDERS", "VIEW", "ID", 1),
        column("OLD", "SYNONYM", "ID", 1, schema="STORE"), column("ITEMS", "TABLE", "ID", 1, schema="STORE"),
    ]
    return spark.createDataFrame(rows, INVENTORY)


def plain(df):
    return [tuple(r) for r in df.collect()]


def test_lists(inventory):
    assert plain(list_catalogs(inventory)) == [("MAIN",)] and plain(list_catalogs(inventory, "x%")) == []
    assert plain(list_schemas(inventory)) == [("MAIN", "SALES"), ("MAIN", "STORE")]
    assert plain(list_tables(inventory)) == [
        ("MAIN", "SALES", "BIG_ORDERS", "VIEW"), ("MAIN", "SALES", "ORDERS", "TABLE"), ("MAIN", "STORE", "ITEMS", "TABLE")]
    assert [r.table for r in list_tables(inventory, schema="sales", table="%_orders").collect()] == ["BIG_ORDERS"]
    columns = list_columns(inventory, table="orders").collect()
    assert [(r.column, r.nullability, r.column_size, r.decimal_digits) for r in columns] == [
        ("ID", "no nulls", 9, 0), ("PLACED", "nullable", None, 6), ("NOTE", "unknown", None, None)]
    assert dict(table_types(inventory).collect()) == {"TABLE": 2, "VIEW": 1, "SYNONYM": 1, "MATERIALIZED VIEW": 0}


def test_table_schema(inventory):
    assert table_schema(inventory, "sales", "orders") == T.StructType([
        T.StructField("ID", T.LongType(), False), T.StructField("PLACED", T.TimestampNTZType(), True), T.StructField("NOTE", T.StringType(), False)])
    assert table_schema(inventory, "sales", "orders", strict_reference=True)["PLACED"].dataType == T.TimestampType()
    with pytest.raises(NotFound):
        table_schema(inventory, "sales", "missing")


def test_tree(inventory):
    def sales(**options):
        rows = object_tree(inventory, **options).where("schema = 'SALES'").orderBy("table").collect()
        return [(r.catalog, r.table, r.table_type, [c.column for c in r["columns"]]) for r in rows]

    assert sales() == [("MAIN", "BIG_ORDERS", "VIEW", ["ID"]), ("MAIN", "ORDERS", "TABLE", ["ID", "PLACED", "NOTE"])]
    assert [r[3] for r in sales(column="pl%")] == [[], ["PLACED"]]
    assert sorted(map(tuple, object_tree(inventory, "schemas").collect())) == [("MAIN", "SALES"), ("MAIN", "STORE")]
    assert [tuple(r) for r in object_tree(inventory, "tables", kinds=["VIEW"]).collect()] == [("MAIN", "SALES", "BIG_ORDERS", "VIEW")]
    assert [tuple(r) for r in object_tree(inventory, "catalogs").collect()] == [("MAIN",)]
    with pytest.raises(InvalidArgument):
        object_tree(inventory, "rows")


def test_the_tree_has_one_shape_at_every_size_and_is_read_once(spark):
    # One schema holds nearly everything, and one table in it a third of all columns.
    df = spark.range(30000).selectExpr(
        "'MAIN' AS catalog", "if(id % 50 = 0, 'B', 'A') AS schema",
        "if(id < 10000, 'HOT', concat('T', id div 10)) AS `table`", "'TABLE' AS table_type", "concat('C', id) AS `column`",
        "int(if(id < 10000, id, id % 10)) AS position", "'NUMBER' AS data_type", "'Y' AS nullable", "CAST(NULL AS STRING) AS `default`",
        "9 AS precision", "0 AS scale")
    tree = object_tree(df, column="C%")
    assert tree.select("catalog", "schema", "table").distinct().count() == tree.count()
    leaves = tree.select(F.explode("columns").alias("c"))
    assert leaves.select("c.column").distinct().count() == leaves.count() == 30000
    assert tree.columns == object_tree(df.limit(20)).columns
    plan = tree._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1 and plan.count("Exchange") == 1


def test_inventory_of_spark_schemas(spark):
    schema = T.StructType().add("id", T.LongType(), False).add("price", T.DecimalType(12, 2)).add("name", T.StringType())
    inventory = inventory_of(spark, {"orders": schema}, "MAIN", "SALES")
    rows = [(r.column, r.position, r.data_type, r.nullable, r.precision, r.scale) for r in inventory.orderBy("position").collect()]
    assert rows == [("ID", 1, "NUMBER", "N", 19, 0), ("PRICE", 2, "NUMBER", "Y", 12, 2), ("NAME", 3, "VARCHAR2", "Y", None, None)]
    assert [f.dataType.simpleString() for f in table_schema(inventory, "sales", "orders")] == ["string", "double", "string"]


@pytest.fixture
def shop(spark):
    spark.sql("CREATE SCHEMA shop_1")
    ingest(spark.createDataFrame([(1, "a" * 5000, Decimal("1.50"))], "id bigint, note string, price decimal(10,2)"), "shop_1.sales")
    spark.sql("CREATE TABLE shop_1.plain (k INT, t STRING) USING parquet")
    spark.sql("CREATE VIEW shop_1.sold AS SELECT id, price FROM shop_1.sales")
    spark.sql("CREATE VIEW shop_1.lost AS SELECT k FROM shop_1.plain")
    spark.range(1).createOrReplaceTempView("passing")
    yield "shop_1"
    spark.catalog.dropTempView("passing")
    spark.sql("DROP SCHEMA shop_1 CASCADE")


def test_the_catalog_as_it_is(spark, shop):
    rows = catalog_inventory(spark, schema="SHOP_1").orderBy("table", "position").collect()
    assert [(r.table, r.table_type, r.column, r.data_type, r.precision, r.scale) for r in rows] == [
        ("LOST", "VIEW", "K", "NUMBER", 19, 0), ("PLAIN", "TABLE", "K", "NUMBER", 19, 0), ("PLAIN", "TABLE", "T", "VARCHAR2", None, None),
        ("SALES", "TABLE", "ID", "NUMBER", 19, 0), ("SALES", "TABLE", "NOTE", "CLOB", None, None), ("SALES", "TABLE", "PRICE", "NUMBER", 10, 2),
        ("SOLD", "VIEW", "ID", "NUMBER", 19, 0), ("SOLD", "VIEW", "PRICE", "NUMBER", 10, 2),
    ]
    assert {r.catalog for r in rows} == {"SPARK_CATALOG"} and {r.schema for r in rows} == {"SHOP_1"}
    # A table that is gone leaves its view listed, without columns.
    spark.sql("DROP TABLE shop_1.plain")
    inventory = catalog_inventory(spark, schema="shop_1", kinds=["VIEW"])
    assert [tuple(r)[2:] for r in list_tables(inventory).collect()] == [("LOST", "VIEW"), ("SOLD", "VIEW")]
    assert {r.table: len(r.columns) for r in object_tree(inventory).collect()} == {"LOST": 0, "SOLD": 2}


def test_filters_come_before_descriptions(spark, shop, monkeypatch):
    described = []
    real = type(spark).table
    monkeypatch.setattr(type(spark), "table", lambda self, name: described.append(name) or real(self, name))
    found = catalog_inventory(spark, "spark_%", "shop_%", "s%")
    assert sorted(described) == ["`spark_catalog`.`shop_1`.`sales`", "`spark_catalog`.`shop_1`.`sold`"]
    assert found.select("table").distinct().count() == 2
    # _ is no wildcard, and no match is an empty inventory.
    for patterns in (("%", "shopX1"), ("nowhere",), ("%", "shop_1", "passing")):
        assert catalog_inventory(spark, *patterns).count() == 0
