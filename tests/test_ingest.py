"""Loads in every mode, and what is left when one fails."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry import (
    InvalidArgument, InvalidState, LoadOptions, LoadPlan, NotFound, TableExists, crs_metadata,
    encode_geometry, ingest, load_parquet, violations,
)
from tableferry.functions.geometry import GEOMETRY_TYPE
from tableferry.operators.conform import normalise_names
from tableferry.operators.fanout import balanced, held_by_part
from tableferry.operators.ingest import DDL_PROPERTY, get_property, identifier, prepare, sized, stored_plan, write_new
from tableferry.plans.columns import ColumnPlan
from tableferry.sources.jdbc import check_jdbc_load, jdbc_read_options, jdbc_write_options


def rows(spark, table):
    return sorted((tuple(r) for r in spark.table(table).collect()), key=str)


def names(spark):
    return {t.name for t in spark.catalog.listTables()}


@pytest.fixture
def three(spark):
    return spark.createDataFrame([(1, "alpha", 1.1), (2, "beta", 2.2), (3, "gamma", 3.3)], "id bigint, name string, value double")


def test_create_reports_rows_and_plan(spark, three, table):
    result = ingest(three, table)
    assert (result.rows, result.rejected) == (3, {})
    assert result.ddl == f'CREATE TABLE {table.upper()} ("ID" NUMBER(19), "NAME" VARCHAR2(64), "VALUE" BINARY_DOUBLE) NOLOGGING'
    assert spark.table(table).columns == ["ID", "NAME", "VALUE"]
    assert get_property(spark, table, DDL_PROPERTY) == result.ddl and stored_plan(spark, table) == result.plan
    with pytest.raises(TableExists):
        ingest(three, table)
    assert rows(spark, table) == [(1, "alpha", 1.1), (2, "beta", 2.2), (3, "gamma", 3.3)]


def test_append_matches_names_and_needs_the_table(spark, three, table):
    with pytest.raises(NotFound):
        ingest(three, table, "append")
    assert table not in names(spark)
    ingest(three, table)
    assert ingest(three.select("value", "Id"), table, "append").rows == 3
    assert rows(spark, table)[:2] == [(1, "alpha", 1.1), (1, None, 1.1)]
    with pytest.raises(InvalidArgument, match="EXTRA"):
        ingest(three.withColumn("extra", F.lit(1)), table, "append")


def test_append_refuses_a_value_wider_than_its_column(spark, three, table):
    ingest(three, table)
    wide = spark.createDataFrame([(4, "w" * 65, 0.0), (5, "ok", 0.0)], three.schema)
    for mode in ("append", "create_append"):
        with pytest.raises(Exception, match="clob_columns"):
            ingest(wide, table, mode)
    assert spark.table(table).count() == 3


def test_replace_and_create_append(spark, three, table):
    assert ingest(three.select("id"), table, "replace").rows == 3
    assert ingest(three, table, "replace").rows == 3
    assert spark.table(table).columns == ["ID", "NAME", "VALUE"]
    assert ingest(three, table, "create_append").rows == 3
    assert spark.table(table).count() == 6
    assert not [n for n in names(spark) if n.startswith(table + "__")]


def test_failed_loads_leave_the_target_as_it_was(spark, three, table):
    broken = three.withColumn("value", F.when(F.col("id") == 2, F.raise_error(F.lit("broken row")).cast("double")).otherwise(1.0))
    with pytest.raises(Exception, match="broken row"):
        ingest(broken, table)
    assert table not in names(spark)
    assert ingest(three, table).rows == 3
    with pytest.raises(Exception, match="broken row"):
        ingest(broken, table, "replace")
    assert spark.table(table).count() == 3
    assert not [n for n in names(spark) if n.startswith(table + "__")]


def test_qualified_names(spark, three):
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    for mode in ("create", "replace", "any.mode.create_append"):
        assert ingest(three, "shop.Goods", mode).rows == 3
    assert spark.table("shop.goods").count() == 6
    assert [t.name for t in spark.catalog.listTables("shop") if not t.isTemporary] == ["goods"]
    assert ingest(three, "`shop`.`more`").ddl.startswith("CREATE TABLE ")


def test_a_table_can_be_replaced_from_itself(spark, three, table):
    ingest(three, table)
    assert ingest(spark.table(table).where("ID > 1"), table, "replace").rows == 2
    assert [r[0] for r in rows(spark, table)] == [2, 3]


def test_bad_arguments(spark, three, table):
    with pytest.raises(InvalidArgument):
        ingest(three, table, "upsert")
    with pytest.raises(InvalidState):
        ingest(None, table)
    with pytest.raises(InvalidArgument, match="collide"):
        ingest(three.withColumn("NAME ", F.lit(1)).toDF("id", "name", "value", "Name"), table)


def test_empty_input(spark, three, table):
    assert ingest(three.limit(0), table).rows == 0
    assert ingest(three.where("false"), table, "append").rows == 0
    assert spark.table(table).count() == 0


@pytest.mark.parametrize("workers", [1, 4])
def test_fan_out_does_not_change_the_result(spark, table, workers):
    df = spark.range(5000).selectExpr("id", "concat('v', id) AS v")
    assert ingest(df, table, options={"ingest_workers": workers}).rows == 5000
    assert spark.table(table).agg(F.countDistinct("ID"), F.sum("ID")).first() == (5000, 12497500)


def test_all_rows_decide_the_types(spark, table):
    df = spark.createDataFrame([(1, 0, "tiny"), (2, 1, "z" * 12000)], "id bigint, batch int, payload string")
    with pytest.raises(InvalidArgument, match="all rows"):
        ingest(df, table, options={"type_scan_limit_bytes": 1})
    assert table not in names(spark)
    assert ingest(df, table).plan.declared["PAYLOAD"] == "CLOB"


@pytest.mark.parametrize("options", [{"clob_columns": "payload"}, {"string_type": "clob"}, {"string_type": "varchar2"}])
def test_options_widen_a_column_of_the_stored_plan(spark, table, options):
    short, long = (spark.createDataFrame([(i, "z" * n)], "id bigint, payload string") for i, n in ((1, 10), (2, 3000)))
    assert ingest(short, table).plan.declared["PAYLOAD"] == "VARCHAR2(64)"
    for mode in ("append", "create_append"):
        with pytest.raises(Exception, match="clob_columns"):
            ingest(long, table, mode)
    wider = ingest(long, table, "append", options).plan
    assert wider.declared["PAYLOAD"] in ("CLOB", "VARCHAR2(4000)") and stored_plan(spark, table) == wider
    # What was widened stays so.
    assert ingest(long, table, "append").plan == wider and spark.table(table).count() == 3


def test_decimals_are_stored_as_decimals(spark, table):
    df = spark.sql("SELECT CAST(9.5 AS DECIMAL(18,2)) a, CAST(0.0000001 AS DECIMAL(12,7)) b UNION ALL SELECT 10.25, NULL")
    assert ingest(df, table).plan.declared == {"A": "NUMBER(18,2)", "B": "NUMBER(12,7)"}
    assert dict(spark.table(table).dtypes) == {"A": "decimal(18,2)", "B": "decimal(12,7)"}
    assert str(spark.table(table).agg(F.max("A")).first()[0]) == "10.25"


@pytest.mark.parametrize("mode", ["create", "append", "replace", "create_append"])
def test_a_table_made_during_the_write_is_not_destroyed(spark, three, table, mode):
    """Another job makes the table between the check for it and the end of the write."""
    if mode == "append":
        with pytest.raises(NotFound):
            ingest(three, table, mode)
        return
    prepared = prepare(normalise_names(three), LoadOptions(), None)
    ingest(three.limit(1).withColumn("id", F.lit(99).cast("bigint")), table)
    if mode == "create":
        with pytest.raises(TableExists):
            write_new(prepared, table, mode)
        assert [r.ID for r in spark.table(table).collect()] == [99]
    else:
        write_new(prepared, table, mode)
        ids = sorted(r.ID for r in spark.table(table).collect())
        assert len(ids) == (4 if mode == "create_append" else 3) and (99 in ids) == (mode == "create_append")
    assert not [n for n in names(spark) if n.startswith(table + "__")]


def test_names_with_marks(spark, table):
    df = spark.createDataFrame([(1, "x")], "id bigint, `a``b.c` string")
    assert ingest(df, table).plan.declared["A`B.C"] == "VARCHAR2(64)"
    assert spark.table(table).columns == ["ID", "A`B.C"]
    assert identifier("`a.b`.c") == "`a.b`.`c`" and identifier("s.`x``y`") == "`s`.`x``y`"


def test_temporal_values(spark, table):
    df = spark.sql("""SELECT 1L id, timestamp_ntz '2024-03-15 10:30:45.123456' ts, timestamp '2024-06-01 16:00:00.5+00:00' tstz,
        date '2024-12-31' d, true flag, float(2.5) ratio UNION ALL SELECT 2, NULL, NULL, NULL, false, NULL""")
    ingest(df, table)
    first = spark.table(table).where("ID = 1").selectExpr("*", "unix_micros(TSTZ) us").first()
    assert first.TS == dt.datetime(2024, 3, 15, 10, 30, 45, 123456) and first.D == dt.datetime(2024, 12, 31)
    assert (first.FLAG, first.RATIO, first.us) == (1, 2.5, 1717257600500000)
    assert tuple(spark.table(table).where("ID = 2").first()) == (2, None, None, None, 0, None)


def test_geometry_columns_are_decoded_and_bad_values_counted(spark, table):
    wkb = bytes.fromhex("0101000000000000000000F03F0000000000000040")
    df = spark.createDataFrame([(1, bytearray(wkb)), (2, bytearray(b"\x01\x02")), (3, None)], "id bigint, shape binary")
    tagged = df.withMetadata("shape", crs_metadata(3857))
    result = ingest(tagged, table)
    assert (result.rows, result.rejected, result.plan.declared["SHAPE"]) == (3, {"SHAPE": 1}, "MDSYS.SDO_GEOMETRY")
    stored = {r.ID: r.SHAPE for r in spark.table(table).collect()}
    assert stored[2] is None and stored[3] is None
    assert (stored[1].gtype, stored[1].srid, tuple(stored[1].point)) == (2001, 3857, (1.0, 2.0, None))
    # Found by its name alone, and written back unchanged.
    named = ingest(df.withColumnRenamed("shape", "geom").where("id = 1"), table + "_n")
    assert named.plan.declared["GEOM"] == "MDSYS.SDO_GEOMETRY"
    assert encode_geometry(spark.table(table + "_n"), "GEOM").first().GEOM == bytearray(wkb)


def test_objects_stay_objects_and_other_types_are_text(spark, table):
    df = spark.createDataFrame([(1, (2001, 4326, (1.0, 2.0, None), [], []), [1, 2])],
                               T.StructType().add("id", T.LongType()).add("place", GEOMETRY_TYPE).add("list", T.ArrayType(T.LongType())))
    result = ingest(df, table)
    assert result.plan.declared == {"ID": "NUMBER(19)", "PLACE": "MDSYS.SDO_GEOMETRY", "LIST": "VARCHAR2(64)"}
    row = spark.table(table).first()
    assert (row.PLACE.gtype, row.LIST) == (2001, "[1,2]")
    long = df.select("id", F.sequence(F.lit(1000), F.lit(2000)).alias("list"))
    assert [(r.column, r.width) for r in violations(long, result.plan, ["id"]).collect()] == [("LIST", 5006)]
    with pytest.raises(Exception, match="LIST declared with 64 bytes"):
        ingest(long, table, "append")
    assert ingest(long, table, "append", {"clob_columns": "list"}).rows == 1
    assert ingest(long, table, "replace").plan.declared["LIST"] == "CLOB"


def test_parquet_file_to_table(spark, tiny, table):
    parts = load_parquet(spark, f"{tiny}/part.parquet", where="p_size > 25", columns=["p_partkey", "p_name"])
    result = ingest(parts, table, "replace")
    assert result.rows == parts.count() == spark.table(table).count()


def test_jdbc_options():
    plan = LoadPlan((ColumnPlan(1, "ID", "bigint", None, "NUMBER(19)", False), ColumnPlan(2, "S", "string", 10, "VARCHAR2(64)", True),
                     ColumnPlan(3, "T", "string", 9000, "CLOB", True)), 4000)
    for mode, error in (("create", InvalidArgument), ("any.create_append", InvalidArgument), ("upsert", InvalidArgument)):
        with pytest.raises(error):
            check_jdbc_load(plan, mode)
    assert check_jdbc_load(plan, "bulk.append") == "append"
    sized = LoadPlan((ColumnPlan(1, "D", "decimal(12,2)", None, "NUMBER(12,2)", True),), 4000)
    assert check_jdbc_load(sized, "create") == "create"
    assert jdbc_write_options(sized, "jdbc:x:y", "t")["createTableColumnTypes"] == "`D` DECIMAL(12,2)"
    options = jdbc_write_options(plan, "jdbc:x:y", "my_table", workers=8)
    assert options["createTableColumnTypes"] == "`ID` DECIMAL(19,0), `S` VARCHAR(64)"
    assert (options["dbtable"], options["numPartitions"]) == ("MY_TABLE", "8")
    assert jdbc_read_options("jdbc:x:y", "SELECT 1")["query"] == "SELECT 1"
    split = jdbc_read_options("jdbc:x:y", "SELECT 1", "id", "0", "100", 4)
    assert "query" not in split and split["dbtable"] == "(SELECT 1) q" and split["numPartitions"] == "4"
    with pytest.raises(InvalidArgument):
        jdbc_read_options("jdbc:x:y", "SELECT 1", "id")


def exchanges(frame):
    return frame._jdf.queryExecution().executedPlan().toString().count("Exchange")


def test_bytes_choose_the_number_of_files(spark, tiny, table):
    rows = load_parquet(spark, f"{tiny}/lineitem.parquet").select("l_orderkey", "l_quantity")
    total = 16 * rows.count()
    many = rows.repartition(40)
    less = balanced(many, total // 5 + 1)
    # Reducing moves nothing: the plan has the exchange of its input and no other.
    assert exchanges(less) == exchanges(many) and less.rdd.getNumPartitions() == 5
    assert balanced(many, total // 5 + 1, most=2).rdd.getNumPartitions() == 2
    # Fitting partitions and empty input stay as they are.
    assert exchanges(balanced(many, total // 40)) == exchanges(many)
    assert balanced(rows.where("false"), 10).count() == 0
    # One partition that holds everything is dealt out; a null holds nothing.
    heavy = many.coalesce(1).select("*", F.lit(None).cast("string").alias("gap"))
    sizes = [len(part) for part in balanced(heavy, total // 4 + 1).rdd.glom().collect()]
    assert len(sizes) == 4 and max(sizes) < 1.2 * min(sizes)
    result = ingest(many, table, options={"bulk.ingest_file_bytes": total // 3 + 1})
    assert result.rows == rows.count() and spark.table(table).select(F.input_file_name()).distinct().count() == 3
    with pytest.raises(InvalidArgument):
        LoadOptions(ingest_file_bytes=-1)


@pytest.mark.parametrize("deal", [
    lambda d: d.repartition(1), lambda d: d.coalesce(1), lambda d: d.repartition(8, F.col("id") % 1),
    lambda d: d.repartition(1).where("id >= 0"),
], ids=["one", "joined", "heavy", "filtered"])
def test_no_task_gets_all_rows_of_dealt_input(spark, table, deal):
    spark.range(0, 4000, 1, 4).selectExpr("id", "CASE WHEN id % 9 > 0 THEN concat('v', id % 7) END AS v").write.saveAsTable(f"{table}_in")
    rows = deal(spark.table(f"{table}_in"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        held = [r["bytes"] for r in held_by_part(rows, lambda d: d).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(held) < sum(held) / 2
    options = LoadOptions(ingest_file_bytes=sum(held) // 3 + 1)
    written = prepare(normalise_names(sized(rows, options)), options, None).rows
    # Names and load form stand after the load's own deal, and the input's is gone.
    assert exchanges(written) == 1 and "Coalesce" not in written._jdf.queryExecution().executedPlan().toString()
    assert ingest(rows, table, options=options).rows == 4000
    stored = spark.table(table).groupBy(F.input_file_name()).agg(F.count("*").alias("n"), F.sum("ID").alias("ids")).collect()
    assert len(stored) == 3 and max(r.n for r in stored) < 1.2 * min(r.n for r in stored)
    assert (sum(r.n for r in stored), sum(r.ids for r in stored)) == (4000, 7998000)


def test_workers_read_stored_rows_themselves(spark, table):
    """Twelve small files are four splits here: two or four tasks share them evenly, three or eight do not."""
    spark.range(0, 12000, 1, 12).selectExpr("id", "CASE WHEN id % 9 > 0 THEN concat('v', id % 7) END AS v").write.saveAsTable(f"{table}_in")
    stored = spark.table(f"{table}_in")

    def moved(rows, workers):
        options = LoadOptions(ingest_workers=workers)
        return exchanges(prepare(normalise_names(rows), options, None).rows)

    assert [moved(stored, n) for n in (1, 2, 4)] == [0, 0, 0]
    assert [moved(stored, n) for n in (3, 8)] == [1, 1]
    # A subset of the columns is stored as well; what is filtered, worked out, nested or dealt is not.
    assert moved(stored.select("v"), 2) == 0
    for rows in (stored.where("id < 3000"), stored.selectExpr("id + 1 AS id"), stored.selectExpr("array(id) AS ids"), stored.limit(50)):
        assert "RoundRobin" in prepare(normalise_names(rows), LoadOptions(ingest_workers=2), None).rows._jdf.queryExecution().executedPlan().toString()
    for workers in (1, 2, 3, 4, 8):
        assert ingest(stored, f"{table}_{workers}", options={"ingest_workers": workers}).rows == 12000
        files = spark.table(f"{table}_{workers}").groupBy(F.input_file_name()).agg(F.count("*").alias("n"), F.sum("ID").alias("ids"), F.count("V").alias("v")).collect()
        assert len(files) == workers and max(f.n for f in files) < 1.2 * min(f.n for f in files)
        assert (sum(f.n for f in files), sum(f.ids for f in files), sum(f.v for f in files)) == (12000, 71994000, 10666)
    empty = f"{table}_none"
    spark.table(f"{table}_in").limit(0).write.saveAsTable(f"{empty}_in")
    assert ingest(spark.table(f"{empty}_in"), empty, options={"ingest_workers": 3}).rows == 0 and spark.table(empty).count() == 0
