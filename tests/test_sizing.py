"""Widths, column types, plans, options."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry import (
    InvalidArgument, LoadOptions, LoadPlan, batch_bind_kind, ddl_frame, plan_columns, plan_frame,
    profile_text, record_bytes, render_ddl, scan_window, target_types, violations,
)
from tableferry.plans.columns import ColumnPlan, declared_width, plan_rows, scanned_columns

SIZED = (
    T.StructType().add("id", T.LongType(), False).add("narrow", T.StringType()).add("wide", T.StringType())
    .add("big", T.StringType(), True, {"large_text": True})
)


@pytest.mark.parametrize("width,limit,expected", [
    (120, 4000, 256), (4000, 4000, 4000), (10, 4000, 64), (0, 4000, 64), (1990, 4000, 4000),
    (5000, 32767, 10048), (32767, 32767, 32767),
])
def test_declared_width(spark, width, limit, expected):
    assert spark.range(1).select(declared_width(str(width), limit)).first()[0] == expected


@pytest.mark.parametrize("widths,options,expected", [
    ((120, 28198, 5000), {}, ["VARCHAR2(256)", "CLOB", "CLOB"]),
    ((4000, 4001, 10), {}, ["VARCHAR2(4000)", "CLOB", "VARCHAR2(64)"]),
    (None, {}, ["VARCHAR2(4000)", "VARCHAR2(4000)", "CLOB"]),
    (None, {"string_type": "clob"}, ["CLOB"] * 3),
    (None, {"string_type": "varchar2"}, ["VARCHAR2(4000)"] * 3),
    ((10, 10, 10), {"clob_columns": "narrow"}, ["CLOB", "VARCHAR2(64)", "VARCHAR2(64)"]),
    ((5000, 5000, 5000), {"max_string_size": "extended"}, ["VARCHAR2(10048)"] * 3),
    ((5000, 5000, 5000), {}, ["CLOB"] * 3),
])
def test_column_types(spark, widths, options, expected):
    names = ("narrow", "wide", "big")
    row = spark.range(1).select(*[F.lit(w).alias(n) for n, w in zip(names, widths or ())])
    plan = LoadPlan.of(plan_rows(row, SIZED, LoadOptions.parse(options)), LoadOptions.parse(options))
    assert [c.declared for c in plan.columns] == ["NUMBER(19)"] + expected


def test_width_scan_counts_bytes_and_skips_nulls(spark):
    df = spark.createDataFrame([("ab", 1, "x"), ("é" * 3000, 2, None), (None, 3, "tiny")], "s string, n bigint, t string")
    assert dict(profile_text(df).collect()) == {"s": 6000, "t": 4}
    assert dict(profile_text(df.limit(0)).collect()) == {"s": 0, "t": 0}


def test_tables_without_text(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert profile_text(df).count() == 0 and batch_bind_kind(df, "b", 4000).count() == 0
    assert plan_columns(df).declared == {"A": "NUMBER(19)", "B": "NUMBER(19)"}
    assert violations(df, plan_columns(df), ["a"]).count() == 0


def test_no_scan_without_need(spark):
    """A plan that does not depend on the data must not read it."""
    exploding = spark.range(5).select(F.raise_error(F.lit("read")).cast("string").alias("s"))
    for options in ({"string_type": "clob"}, {"string_type": "varchar2"}, {"clob_columns": "S"}, {"type_scan_limit_bytes": 0}):
        assert plan_columns(exploding, options).columns[0].declared in ("CLOB", "VARCHAR2(4000)")
    assert scanned_columns(exploding.schema, LoadOptions()) == ["s"]
    with pytest.raises(Exception, match="read"):
        plan_columns(exploding)


def test_scan_window_stops_after_the_limit_and_counts_the_last_batch_in_full(spark):
    rows = [(i // 100, i, f"row-{i}" if i != 150 else "w" * 9000) for i in range(400)]
    df = spark.createDataFrame(rows, "batch int, id bigint, payload string")
    seen = {r.batch: (r.n_rows, r.scanned) for r in scan_window(df, "batch", 5000).collect()}
    # Batch 0 holds about 1,400 bytes, batch 1 crosses the limit.
    assert seen == {0: (100, True), 1: (100, True), 2: (100, False), 3: (100, False)}
    # A plan from other rows does not know of the wide value.
    plan = plan_columns(df.where("batch = 0"))
    assert plan.declared["PAYLOAD"] == "VARCHAR2(64)"
    # A plan of a table is made from all its rows, so a limit is refused.
    with pytest.raises(InvalidArgument, match="all rows"):
        plan_columns(df, {"type_scan_limit_bytes": 1})
    broken = violations(df, plan, ["id"]).collect()
    assert [(r.id, r.column, r.width, r.declared_bytes) for r in broken] == [(150, "PAYLOAD", 9000, 64)]
    assert "clob_columns" in broken[0].hint


def test_scan_window_over_many_blocks_equals_a_running_sum(spark):
    df = spark.range(0, 30000).select((F.col("id") * 7).alias("batch"), F.expr("repeat('x', int(id % 13))").alias("s"))
    rows = sorted(scan_window(df, "batch", 100_000).collect(), key=lambda r: r.batch)
    running = 0
    for row in rows:
        assert row.bytes_before == running and row.scanned == (running < 100_000)
        running += row.bytes
    # Sparse numbers: no task gets all batches.
    plan = scan_window(df.withColumn("batch", F.col("batch") * 1_000_003), "batch")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_scan_window_keeps_rows_without_a_batch(spark):
    df = spark.createDataFrame([(None, "abc"), (2, "d"), (2, "e"), (-1, "fg")], "batch bigint, s string")
    rows = [tuple(r) for r in scan_window(df, "batch", 4).orderBy("bytes_before").collect()]
    assert rows == [(None, 1, 3, 3, 0, True), (-1, 1, 2, 2, 3, True), (2, 2, 2, 1, 5, False)]


def test_record_bytes(spark):
    df = spark.sql("""SELECT 1L a, 'é' b, array('xx', NULL) c, map('k', 1) d, named_struct('x', 1D, 'y', 'abc') e,
                      X'0102' f, CAST(NULL AS STRING) g, array(1, 2, 3) h""")
    assert df.select(record_bytes(df.schema)).first()[0] == 8 + 2 + 2 + (1 + 4) + (8 + 3) + 2 + 0 + 12


def test_batch_kinds_at_the_limit(spark):
    df = spark.createDataFrame([(0, "x" * 4000), (0, None), (1, "x" * 4001), (2, None)], "b int, s string")
    kinds = {r.batch: (r.max_bytes, r.kind) for r in batch_bind_kind(df, "b", 4000).collect()}
    assert kinds == {0: (4000, "text"), 1: (4001, "lob"), 2: (0, "text")}


def test_ddl(spark):
    schema = T.StructType().add("id", T.LongType(), False).add("data", T.StringType(), False)
    empty = spark.createDataFrame([], schema)
    expected = 'CREATE TABLE MY_TABLE ("ID" NUMBER(19) NOT NULL, "DATA" CLOB) NOLOGGING'
    plan = plan_columns(empty, {"string_type": "clob"})
    assert render_ddl(plan, "my_table") == expected
    assert ddl_frame(plan_frame(empty, {"string_type": "clob"}), "my_table").first().ddl == expected
    assert '"VARCHAR2(4000)' not in render_ddl(plan_columns(empty, {"type_scan_limit_bytes": 0}), "t")
    odd = LoadPlan((ColumnPlan(1, 'A"B', "bigint", None, "NUMBER(19)", True),), 4000)
    assert render_ddl(odd, "odd name") == 'CREATE TABLE "ODD NAME" ("A""B" NUMBER(19)) NOLOGGING'
    assert LoadPlan.from_json(plan.to_json()) == plan


def test_target_types(spark):
    fields = {
        "i8": T.ByteType(), "i64": T.LongType(), "u64": T.DecimalType(20, 0), "f32": T.FloatType(), "f64": T.DoubleType(),
        "dec": T.DecimalType(12, 3), "wide": T.DecimalType(38, 4), "txt": T.StringType(), "raw": T.BinaryType(),
        "flag": T.BooleanType(), "wall": T.TimestampNTZType(), "zoned": T.TimestampType(), "day": T.DateType(),
        "span": T.DayTimeIntervalType(), "list": T.ArrayType(T.LongType()), "geom": T.BinaryType(),
    }
    schema = T.StructType([T.StructField(n, t) for n, t in fields.items()])
    assert dict(target_types(schema)) == {
        "I8": "NUMBER(19)", "I64": "NUMBER(19)", "U64": "NUMBER(20,0)", "F32": "BINARY_FLOAT", "F64": "BINARY_DOUBLE",
        "DEC": "NUMBER(12,3)", "WIDE": "NUMBER(38,4)", "TXT": "VARCHAR2(4000)", "RAW": "BLOB", "FLAG": "NUMBER(1)",
        "WALL": "TIMESTAMP(6)", "ZONED": "TIMESTAMP(6) WITH TIME ZONE", "DAY": "DATE", "SPAN": "VARCHAR2(4000)",
        "LIST": "VARCHAR2(4000)", "GEOM": "MDSYS.SDO_GEOMETRY",
    }


def test_options():
    assert LoadOptions().string_type == "auto"
    options = LoadOptions.parse({"any.ingest.string_type": "CLOB", "ingest.clob_columns": " b, a ,,"})
    assert (options.string_type, options.clob_columns) == ("clob", ("A", "B"))
    assert LoadOptions(max_string_size=None).inline_limit == 4000
    for bad in ({"string_type": "text"}, {"type_scan_limit_bytes": "-1"}, {"type_scan_limit_bytes": "many"},
                {"unknown": 1}, {"max_string_size": "huge"}):
        with pytest.raises(InvalidArgument):
            LoadOptions.parse(bad)
