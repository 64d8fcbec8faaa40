"""Loads in commit groups: what is committed stays, what is not is loaded again, every row once."""

import pytest
from pyspark.sql import functions as F

from tableferry import (
    InvalidArgument, InvalidState, LoadStopped, NotFound, Split, TableExists, ingest, ingest_groups, load_parquet, plan_splits,
)
from tableferry.operators import groups
from tableferry.operators.ingest import stored_plan


@pytest.fixture
def orders(spark, tiny):
    return load_parquet(spark, f"{tiny}/orders.parquet")


@pytest.fixture
def splits(orders):
    return plan_splits(orders, "o_orderkey", 5)


def failing(orders, split):
    price = F.when(F.expr(split.condition), F.raise_error(F.lit("lost")).cast("double")).otherwise(F.col("o_totalprice"))
    return orders.withColumn("o_totalprice", price)


def same(spark, table, frame):
    stored, given = spark.table(table), frame.toDF(*[c.upper() for c in frame.columns])
    return stored.select(*given.columns).exceptAll(given).isEmpty() and stored.count() == given.count()


def tables(spark):
    return {t.name for t in spark.catalog.listTables()}


@pytest.mark.parametrize("mode", ["create", "replace", "append", "create_append"])
def test_a_stopped_load_goes_on(spark, orders, splits, table, mode):
    before = orders.limit(0)
    if mode in ("replace", "append"):
        before = orders.where("o_orderkey < 50")
        ingest(before, table)
    with pytest.raises(LoadStopped, match="lost") as stop:
        ingest_groups(failing(orders, splits[2]), table, "nightly", splits, mode)
    assert (stop.value.rows, stop.value.group) == (splits[0].rows + splits[1].rows, 2)
    # Nothing is in the target before the end.
    assert same(spark, table, before) if before.count() else table not in tables(spark)
    written = []
    real = groups._load_group

    def noting(spark, rows, number, *rest):
        written.append(number)
        return real(spark, rows, number, *rest)

    groups._load_group = noting
    try:
        done = ingest_groups(orders, table, "nightly", splits[:1], mode)  # the stored splits count
    finally:
        groups._load_group = real
    assert written == [2, 3, 4] and done.rows == orders.count()
    assert same(spark, table, orders if mode == "replace" else before.unionByName(orders))
    # Repeated after its end, it changes nothing.
    assert ingest_groups(orders, table, "nightly", splits, mode).rows == done.rows
    assert same(spark, table, orders if mode == "replace" else before.unionByName(orders))
    assert not [name for name in tables(spark) if name.startswith(f"{table}__")]


def test_a_group_without_a_note_is_written_again(spark, orders, splits, table, monkeypatch):
    """Stopped after the files of a group have moved in, before they are noted."""
    real, calls = groups.set_property, []

    def lost(spark, name, **values):
        calls.append(values)
        if any(key.endswith("done.1") for key in values):
            raise RuntimeError("driver gone")
        real(spark, name, **values)

    monkeypatch.setattr(groups, "set_property", lost)
    with pytest.raises(LoadStopped):
        ingest_groups(orders, table, "x", splits)
    monkeypatch.setattr(groups, "set_property", real)
    assert ingest_groups(orders, table, "x", splits).rows == orders.count()
    assert same(spark, table, orders)


def test_stopped_while_files_move_in(spark, orders, splits, table, monkeypatch):
    ingest(orders, table)
    real, moved = groups.Folder.move, []

    def lost(self, old, new):
        if "/x-g" in new.toString():
            moved.append(new)
            if len(moved) == 3:
                raise RuntimeError("driver gone")
        real(self, old, new)

    monkeypatch.setattr(groups.Folder, "move", lost)
    with pytest.raises(RuntimeError):
        ingest_groups(orders, table, "x", splits, "append")
    monkeypatch.setattr(groups.Folder, "move", real)
    ingest_groups(orders, table, "x", splits, "append")
    spark.catalog.refreshTable(table)
    assert same(spark, table, orders.unionAll(orders))


def test_widths_of_all_groups_make_the_plan(spark, table):
    rows = spark.createDataFrame([(n, "w" * n * 30) for n in range(1, 40)] + [(None, None)], "id bigint, text string")
    result = ingest_groups(rows, table, "a", plan_splits(rows, "id", 4))
    whole = ingest(rows, f"{table}_whole")
    assert result.plan == whole.plan == stored_plan(spark, table) and result.rows == 40
    wide = spark.createDataFrame([(50, "w" * 3999)], rows.schema)
    with pytest.raises(LoadStopped, match="clob_columns"):
        ingest_groups(wide, table, "b", [Split("true", 1, 1)], "append")
    assert ingest_groups(wide.select("text", "id"), table, "b", [Split("true", 1, 1)], "append", {"clob_columns": "text"}).rows == 1
    assert spark.table(table).count() == 41


def test_refusals(spark, orders, splits, table):
    for arguments in (("no name", splits), ("", splits), ("x", [])):
        with pytest.raises(InvalidArgument):
            ingest_groups(orders, table, *arguments)
    with pytest.raises(NotFound):
        ingest_groups(orders, table, "x", splits, "append")
    with pytest.raises(LoadStopped):
        ingest_groups(failing(orders, splits[1]), table, "x", splits)
    with pytest.raises(InvalidState):
        ingest_groups(orders, table, "x", splits, "replace")
    with pytest.raises(InvalidState):
        ingest_groups(orders.withColumn("more", F.lit(1)), table, "x", splits)
    ingest(orders, table)
    with pytest.raises(TableExists):
        ingest_groups(orders, table, "y", splits)
    with pytest.raises(InvalidArgument, match="MORE"):
        ingest_groups(orders.withColumn("more", F.lit(1)), table, "y", splits, "append")


def test_empty_input(spark, table):
    nothing = spark.createDataFrame([], "id bigint, text string")
    assert ingest_groups(nothing, table, "a", plan_splits(nothing, "id", 3)).rows == 0
    assert spark.table(table).count() == 0 and spark.table(table).columns == ["ID", "TEXT"]
