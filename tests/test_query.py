"""SQL texts, bound values, parameter tables, scans."""

import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry import (
    InvalidArgument, InvalidState, measure_scan, preview, run_many, run_query, run_update, scan_geometry,
)
from tableferry.functions.geometry import GEOMETRY_TYPE
from tableferry.operators.query import numbered_to_named


def test_empty_query(spark):
    for run in (run_query, run_update):
        with pytest.raises(InvalidState):
            run(spark, "  ")


def test_placeholders_are_left_alone_inside_texts():
    sql = "SELECT :1, ':2', \":3\", `:4`, x::int /* :5 */ -- :6\n, :12"
    assert numbered_to_named(sql) == "SELECT :p1, ':2', \":3\", `:4`, x::int /* :5 */ -- :6\n, :p12"


def test_bound_values(spark):
    values = [42, 2**63, 1.5, decimal.Decimal("1.50"), b"x", True, None, "it's",
              dt.datetime(2024, 1, 2, 3, 4, 5, 6), dt.date(2024, 1, 2), -(2**63)]
    names = ", ".join(f":{i} AS c{i}" for i in range(1, len(values) + 1))
    frame = run_query(spark, f"SELECT {names}", values)
    assert tuple(frame.first()) == (42, str(2**63), 1.5, "1.50", bytearray(b"x"), True, None, "it's",
                                    dt.datetime(2024, 1, 2, 3, 4, 5, 6), dt.datetime(2024, 1, 2), -(2**63))
    assert frame.schema["c1"].dataType == T.LongType()
    assert frame.schema["c9"].dataType == T.TimestampNTZType()


def test_a_query_takes_one_row_of_parameters(spark):
    one = spark.createDataFrame([(42,)], "p int")
    assert run_query(spark, "SELECT :1 AS val", one).first().val == 42
    with pytest.raises(InvalidState):
        run_query(spark, "SELECT :1 AS val", one.union(one))


def test_named_parameters_and_schema(spark):
    frame = run_query(spark, "SELECT :low AS low, '7' AS n", {"low": 1}, T.StructType().add("n", T.LongType()))
    assert frame.collect() == [(7,)]


def test_update_statements(spark, table):
    assert run_update(spark, f"CREATE TABLE {table} (a INT) USING parquet") == 0
    assert run_update(spark, f"INSERT INTO {table} VALUES (1), (2)") == 2
    assert run_update(spark, f"INSERT INTO {table} SELECT a + :1 FROM {table}", [10]) == 2
    assert run_update(spark, f"INSERT OVERWRITE {table} VALUES (9)") == 1
    assert run_update(spark, f"DROP TABLE {table}") == 0


@pytest.fixture
def stock(spark):
    return spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, v string")


def params(spark, *rows):
    return spark.createDataFrame(rows, "p int, w string, seq int")


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_many_update_last_row_wins(spark, stock):
    result = run_many(stock, params(spark, (1, "x", 1), (1, None, 2), (3, "z", 3), (None, "n", 4)), {"k": "p"},
                      "update", {"v": "w"}, "seq")
    assert rows(result.frame) == rows(spark.createDataFrame([(1, None), (1, None), (2, "c"), (None, "d")], stock.schema))
    # Two executions hit two rows each; the key 3 and the missing key hit none.
    assert result.affected.first().n == 4


def test_many_delete_insert_select(spark, stock):
    given = params(spark, (1, "x", 1), (1, "y", 2), (9, "z", 3))
    deleted = run_many(stock, given, {"k": "p"}, "delete")
    assert (rows(deleted.frame), deleted.affected.first().n) == ([(2, "c"), (None, "d")], 2)
    assert rows(run_many(stock, given, {"k": "p"}, "delete", where="w = 'y' AND v = 'b'").frame) == [
        (1, "a"), (2, "c"), (None, "d")]
    inserted = run_many(stock, given, [], "insert", {"k": "p", "v": "w"})
    assert (inserted.frame.count(), inserted.affected.first().n) == (7, 3)
    picked = run_many(stock, given, {"k": "p"}, "select", where="v < w")
    assert rows(picked.frame) == sorted([(1, "x", 1, 1, "a"), (1, "x", 1, 1, "b"), (1, "y", 2, 1, "a"), (1, "y", 2, 1, "b")], key=str)


def test_many_with_one_key_holding_a_third_of_both_sides(spark):
    """The hot key meets itself once per row, never as all pairs."""
    target = spark.range(30000).selectExpr("if(id < 10000, 0, id) AS k", "id AS v")
    given = spark.range(30000).selectExpr("if(id < 10000, 0, id) AS p", "-id AS w", "id AS seq")
    updated = run_many(target, given, {"k": "p"}, "update", {"v": "w"}, "seq")
    assert updated.frame.groupBy().sum("v").first()[0] == 10000 * -9999 - sum(range(10000, 30000))
    assert updated.affected.first().n == 10000 * 10000 + 20000
    deleted = run_many(target, given.where("p < 15000"), {"k": "p"}, "delete")
    assert (deleted.frame.count(), deleted.affected.first().n) == (15000, 15000)


def test_many_update_orders_nulls_first_and_keeps_types(spark, stock):
    given = spark.createDataFrame([(1, "5", None), (2, "6", 1), (2, "7", None), (3, "9", 2)], "p int, w string, seq int")
    target = stock.withColumn("v", F.lit(0))
    result = run_many(target, given, {"k": "p"}, "update", {"v": "w"}, "seq")
    assert rows(result.frame) == rows(spark.createDataFrame([(1, 5), (1, 5), (2, 6), (None, 0)], "k int, v int"))
    assert result.frame.dtypes == target.dtypes
    tied = params(spark, (1, "b", 7), (1, "c", 7), (1, None, 7))
    assert {r.v for r in run_many(stock, tied, {"k": "p"}, "update", {"v": "w"}, "seq").frame.where("k = 1").collect()} == {"c"}


def test_many_with_parameters_from_the_target(spark, stock):
    found = stock.where("v = 'a'")
    deleted = run_many(stock, found, ["k"], "delete")
    assert (rows(deleted.frame), deleted.affected.first().n) == ([(2, "c"), (None, "d")], 2)
    assert run_many(stock, found, ["k"], "select").frame.count() == 2
    changed = run_many(stock, found.withColumn("seq", F.lit(1)), ["k"], "update", {"v": "v"}, "seq")
    assert rows(changed.frame) == [(1, "a"), (1, "a"), (2, "c"), (None, "d")]


def test_insert_counts_what_it_writes(spark, table, tmp_path):
    run_update(spark, f"CREATE TABLE {table} (a INT, p INT) USING parquet PARTITIONED BY (p)")
    assert run_update(spark, f"INSERT INTO {table} VALUES (1, 1), (2, 1), (3, 2), (4, 2), (5, 3)") == 5
    assert run_update(spark, f"INSERT OVERWRITE TABLE {table} PARTITION (p = 1) SELECT :1", [9]) == 1
    assert rows(spark.table(table)) == [(3, 2), (4, 2), (5, 3), (9, 1)]
    assert run_update(spark, f"insert into {table} (p, a) with t as (select 7 x, 8 y) select x, y from t") == 1
    assert run_update(spark, f"INSERT OVERWRITE DIRECTORY '{tmp_path}/select from' USING parquet SELECT a FROM {table}") == 5
    assert spark.read.parquet(f"{tmp_path}/select from").count() == 5


def test_many_without_rows_changes_nothing(spark, stock):
    nothing = params(spark, (1, "x", 1)).limit(0)
    for action, extra in (("update", {"assign": {"v": "w"}, "order_by": "seq"}), ("delete", {})):
        result = run_many(stock, nothing, {"k": "p"}, action, **extra)
        assert (result.frame.count(), result.affected.first().n) == (4, 0)


def test_many_refuses_what_it_cannot_do_as_a_join(spark, stock):
    given = params(spark, (1, "x", 1))
    for bad in (
        {"on": {}, "action": "delete"}, {"on": {"k": "p"}, "action": "merge"},
        {"on": {"k": "p"}, "action": "update", "assign": {"v": "v"}, "order_by": "seq"},
        {"on": {"k": "p"}, "action": "update", "assign": {"v": "w"}},
    ):
        with pytest.raises(InvalidArgument):
            run_many(stock, given, **bad)


def test_preview_and_count(spark):
    df = spark.range(30).selectExpr("id", "if(id = 1, NULL, id / 2) AS half").orderBy("id")
    shown = preview(df).collect()
    assert len(shown) == 20 and [tuple(r) for r in shown[:3]] == [("0", "0"), ("1", "NULL"), ("2", "1")]
    assert measure_scan(df).rows == 30
    assert measure_scan(df.where("id < 0")).rows == 0


def test_scan_geometry_tags_columns_of_one_system(spark):
    schema = T.StructType().add("id", T.IntegerType()).add("g", GEOMETRY_TYPE)
    point = lambda srid: (2001, srid, (1.0, 2.0, None), [], [])
    df = spark.createDataFrame([(1, None), (2, point(0)), (3, point(3857)), (4, point(4326))], schema).coalesce(1)
    assert scan_geometry(df).schema["g"].metadata["ARROW:extension:metadata"] == "{}"
    scanned = scan_geometry(df.where("id < 4"))
    assert scanned.schema["g"].metadata == {
        "ARROW:extension:name": "geoarrow.wkb", "ARROW:extension:metadata": '{"crs":"EPSG:3857"}'}
    assert [r.g is None for r in scanned.orderBy("id").collect()] == [True, False, False]
    with pytest.raises(InvalidState, match="mixes"):
        scan_geometry(df, on_mixed="fail")
    assert scan_geometry(df.where("id < 3")).schema["g"].metadata["ARROW:extension:metadata"] == "{}"
