"""Every entry query against its DuckDB statement, and the shape of the plans."""

import duckdb
import pytest

import __spark_entry__ as entries
from entry_queries.common import TABLES
from tools.check_queries import bag

ORACLE = entries.oracle_sql()
# The optional package has its own tests.
QUERIES = {name: query for name, query in entries.queries().items() if name not in entries._LLM}


@pytest.fixture(scope="module")
def duck(tiny):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{tiny}/{table}.parquet')")
    return con


def test_flagship(spark):
    frame = entries.entry(spark)
    assert frame.columns == ["n_name", "o_orderpriority", "n_orders", "total", "largest"] and frame.count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_statement(spark, duck, tiny, name):
    frame = QUERIES[name](spark, tiny)
    ours = bag(frame.columns, frame.collect())
    cursor = duck.execute(ORACLE[name])
    assert ours == bag([d[0] for d in cursor.description], cursor.fetchall())


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if n[:2] not in ("d1", "d2", "d3", "d4", "d6", "d7", "d8")])
def test_no_plan_multiplies_tables(spark, tiny, name):
    plan = plan_of(QUERIES[name](spark, tiny))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", [n for n in QUERIES if n[0] in "bc" and n != "c_round_trip" or n[:3] in ("e5a", "e8a", "e8c", "e6_", "e9_", "e10")])
def test_row_by_row_operators_do_not_shuffle(spark, tiny, name):
    assert "Exchange" not in plan_of(QUERIES[name](spark, tiny))


def test_columns_and_filters_reach_the_files(spark, tiny):
    plan = plan_of(QUERIES["a7_parquet_scan"](spark, tiny))
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,45.0)]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>" in plan
    assert "ReadSchema: struct<text:string,lang:string,source:string>" in plan_of(
        QUERIES["s10_ddl"](spark, tiny))
