"""Split planning: every row in exactly one split, and no split much heavier than the others."""

import pytest
from pyspark.sql import functions as F

from tableferry import InvalidArgument, load_parquet, plan_splits, split_number
from tableferry.sources.jdbc import jdbc_read_options, split_reads

KEYS = {
    "unique": "l_orderkey * 8 + l_linenumber",
    "repeated": "l_orderkey",
    "a third of one key": "CASE WHEN l_linenumber % 3 = 0 THEN 77 ELSE l_orderkey END",
    "nulls": "nullif(l_linenumber, 2) * l_orderkey",
    "beyond doubles": "9223372036854775807 - l_orderkey",
    "few": "l_linenumber",
    "one": "1",
    "numbers": "CASE l_linenumber WHEN 1 THEN double('NaN') WHEN 2 THEN double('-Infinity') ELSE l_extendedprice END",
    "decimals": "CAST(l_extendedprice AS DECIMAL(20,2))",
    "dates": "CAST(l_shipdate AS DATE)",
    "times": "l_shipdate",
    "zoned": "CAST(l_shipdate AS TIMESTAMP)",
}


@pytest.mark.parametrize("name", KEYS)
@pytest.mark.parametrize("weight", ["bytes", "rows"])
def test_splits_are_disjoint_complete_and_even(spark, tiny, name, weight):
    rows = load_parquet(spark, f"{tiny}/lineitem.parquet").withColumn("key", F.expr(KEYS[name]))
    parts = 6
    splits = plan_splits(rows, "key", parts, weight)
    hits = sum((F.coalesce(F.expr(s.condition), F.lit(False)).cast("int") for s in splits), F.lit(0))
    assert [tuple(r) for r in rows.groupBy(hits.alias("hits")).count().collect()] == [(1, rows.count())]
    found = {r[0]: r[1] for r in rows.groupBy(split_number(splits)).count().collect()}
    assert found == {n: s.rows for n, s in enumerate(splits)}
    valued = [s for s in splits if " >" in s.condition or "<=" in s.condition or "NOT NULL" in s.condition]
    heaviest_key = rows.where("key IS NOT NULL").groupBy("key").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    per_row = sum(s.weight for s in valued) / sum(s.rows for s in valued)
    assert max(s.weight for s in valued) <= max(1.5 * sum(s.weight for s in valued) / parts, 1.1 * heaviest_key * per_row)
    if heaviest_key * per_row < 0.5 * sum(s.weight for s in valued) / parts:
        assert len(valued) == parts


def test_weight_counts_not_rows(spark):
    """A few rows hold nearly all bytes."""
    rows = spark.range(2000).select("id", F.when(F.col("id") < 20, F.repeat(F.lit("x"), 10_000)).otherwise("x").alias("text"))
    splits = plan_splits(rows, "id", 5)
    assert len(splits) == 5 and splits[0].rows == 5 and max(s.weight for s in splits) < 60_000
    by_rows = plan_splits(rows, "id", 5, "rows")
    assert all(390 <= s.rows <= 410 for s in by_rows)
    assert plan_splits(rows, "id", 5, F.octet_length("text"))[0].rows == 4


def test_nulls_empty_tables_and_names(spark):
    empty = spark.createDataFrame([], "k int, v string")
    assert [s.condition for s in plan_splits(empty, "k", 3)] == ["(`k` IS NOT NULL OR `k` IS NULL)"]
    nothing = spark.createDataFrame([(None,), (None,)], "k int")
    assert [(s.condition, s.rows) for s in plan_splits(nothing, "k", 3)] == [("`k` IS NULL", 2)]
    odd = spark.createDataFrame([(1, None), (2, 5), (2, 6), (-3, 6)], "`a b` int, w int")
    splits = plan_splits(odd, "a b", 2, name='"A B"')
    assert splits[0].condition.startswith('("A B" <= ') and sum(s.rows for s in splits) == 4


def test_refusals(spark):
    rows = spark.createDataFrame([(1, "x")], "k int, v string")
    for arguments in (("v", 2), ("none", 2), ("k", 0), ("k", 2, "heavy")):
        with pytest.raises(InvalidArgument):
            plan_splits(rows, *arguments)


def test_conditions_reach_the_files_and_the_connector(spark, tiny):
    rows = load_parquet(spark, f"{tiny}/lineitem.parquet")
    splits = plan_splits(rows, "l_orderkey", 4, "rows")
    plan = rows.where(splits[1].condition)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_orderkey), GreaterThan(l_orderkey," in plan
    reads = split_reads(jdbc_read_options("jdbc:x:y", "SELECT 1"), splits)
    assert reads["predicates"] == [s.condition for s in splits] and reads["table"] == "(SELECT 1) q"
    assert "query" not in reads["properties"] and reads["properties"]["fetchsize"]
    with pytest.raises(InvalidArgument):
        split_reads(jdbc_read_options("jdbc:x:y", "SELECT 1", "id", "0", "9", 2), splits)
