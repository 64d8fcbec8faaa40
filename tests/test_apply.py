"""Changes of stored tables: what is rewritten, what is not, and commits that are broken off."""

import hashlib
import os
import re

import pytest
from pyspark.sql import functions as F

from tableferry import InvalidArgument, InvalidState, NotFound, apply_many, finish_change
from tableferry.operators import apply


@pytest.fixture
def orders(spark, tiny, table):
    read = spark.read.parquet(f"{tiny}/orders.parquet")
    read.repartitionByRange(10, "o_orderkey").write.saveAsTable(table)
    yield table
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def folder_of(spark, table):
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return re.sub("^file:", "", rows[0].data_type)


def contents(folder):
    return {name: hashlib.sha256(open(f"{folder}/{name}", "rb").read()).hexdigest() for name in os.listdir(folder) if name.startswith("part-") or name.endswith(".parquet") and name[0] not in "._"}


def test_an_update_leaves_other_files_alone(spark, orders):
    before, rows = contents(folder_of(spark, orders)), {r.o_orderkey: r for r in spark.table(orders).collect()}
    few = sorted(rows)[: len(rows) // 100]
    changes = spark.createDataFrame([(k, "new", n) for n, k in enumerate(few)] + [(-5, "none", 0)], "key bigint, value string, seq int")
    assert apply_many(spark, orders, changes, {"o_orderkey": "key"}, "update", assign={"o_orderpriority": "value"}, order_by="seq") == len(few)
    after = contents(folder_of(spark, orders))
    assert len(set(before.items()) - set(after.items())) == 1
    assert len(set(before.items()) & set(after.items())) == len(before) - 1
    found = {r.o_orderkey: r for r in spark.table(orders).collect()}
    assert spark.table(orders).count() == len(rows)
    assert all(found[k].o_orderpriority == ("new" if k in set(few) else rows[k].o_orderpriority) and found[k].o_totalprice == rows[k].o_totalprice for k in rows)
    assert not [name for name in os.listdir(folder_of(spark, orders)) if name.startswith("_tableferry")]


def test_deletions_insertions_and_ranges(spark, orders):
    rows = [r.o_orderkey for r in spark.table(orders).collect()]
    low, high = sorted(rows)[10], sorted(rows)[40]
    bands = spark.createDataFrame([(low, high), (None, 5)], "a bigint, b bigint")
    assert apply_many(spark, orders, bands, {}, "delete", between={"o_orderkey": ("a", "b")}) == 31
    assert spark.table(orders).count() == len(rows) - 31
    again = contents(folder_of(spark, orders))
    assert apply_many(spark, orders, bands, {}, "delete", between={"o_orderkey": ("a", "b")}) == 0
    assert contents(folder_of(spark, orders)) == again
    more = spark.createDataFrame([(low, 1.5)], "key bigint, price double")
    assert apply_many(spark, orders, more, [], "insert", assign={"o_orderkey": "key", "o_totalprice": "price"}) == 1
    assert spark.table(orders).where(F.col("o_orderkey") == low).first().o_totalprice == 1.5
    # Every row of a table may go.
    every = spark.table(orders).select("o_orderkey").distinct()
    assert apply_many(spark, orders, every, ["o_orderkey"], "delete") == len(rows) - 30
    assert spark.table(orders).count() == 0


def test_a_broken_commit_is_ended_by_the_next_change(spark, orders, monkeypatch):
    n = spark.table(orders).count()
    keys = spark.table(orders).select(F.min("o_orderkey").alias("key"), F.lit("x").alias("v"))
    key = keys.first().key
    keys = spark.createDataFrame([(key, "x")], "key bigint, v string")
    how = {"assign": {"o_orderpriority": "v"}, "order_by": "v"}

    class Lost(Exception):
        pass

    def lost(self, *names):
        raise Lost

    with monkeypatch.context() as patch:
        # Before the commit the table is as it was.
        patch.setattr(apply._Folder, "write", lost)
        before = contents(folder_of(spark, orders))
        with pytest.raises(Lost):
            apply_many(spark, orders, keys, {"o_orderkey": "key"}, **how)
        assert contents(folder_of(spark, orders)) == before
    with monkeypatch.context() as patch:
        # After it, new files are in and old ones not yet out.
        patch.setattr(apply._Folder, "delete", lost)
        with pytest.raises(Lost):
            apply_many(spark, orders, keys, {"o_orderkey": "key"}, **how)
    assert finish_change(spark, orders) == 1 and finish_change(spark, orders) == 0
    assert spark.table(orders).count() == n
    assert spark.table(orders).where(F.col("o_orderkey") == key).first().o_orderpriority == "x"


def test_changes_of_one_file_do_not_mix(spark, orders, monkeypatch):
    key = spark.table(orders).agg(F.min("o_orderkey")).first()[0]
    keys = spark.createDataFrame([(key,)], "key bigint")
    real = apply._Folder.write

    def meanwhile(self, text, *names):
        monkeypatch.setattr(apply._Folder, "write", real)
        apply_many(spark, orders, keys, {"o_orderkey": "key"}, "delete")
        real(self, text, *names)

    monkeypatch.setattr(apply._Folder, "write", meanwhile)
    with pytest.raises(InvalidState):
        apply_many(spark, orders, spark.createDataFrame([(key, "y")], "key bigint, v string"), {"o_orderkey": "key"}, assign={"o_orderstatus": "v"}, order_by="v")
    assert spark.table(orders).where(F.col("o_orderkey") == key).count() == 0


def test_refused_tables(spark, table):
    params = spark.createDataFrame([(1,)], "k int")
    with pytest.raises(NotFound):
        apply_many(spark, table, params, ["k"], "delete")
    spark.createDataFrame([(1, 2)], "k int, p int").write.partitionBy("p").saveAsTable(table)
    try:
        for action in ("delete", "select"):
            with pytest.raises(InvalidArgument):
                apply_many(spark, table, params, ["k"], action)
    finally:
        spark.sql(f"DROP TABLE {table}")
