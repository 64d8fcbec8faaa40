"""Loads in commit groups: a load that stops goes on after the last group it committed.

The input is cut by conditions (see ``plan_splits``). Every group is written to a hidden folder of the staging table, its files move in
under names of that group, and then the group's rows and widths are noted in the table's properties, one
property a group. A group without a note is not committed: what it left behind is removed
before it is written again. When all groups are noted, the staging table takes the target's name, or its
files move into the table that is added to; the load's name is noted there, so a load that is
repeated after its end changes nothing.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import InvalidArgument, InvalidState, LoadStopped, NotFound, TableExists
from ..plans.columns import LoadPlan, quote, render_ddl
from ..plans.options import LoadOptions, check_mode
from ..sources.splits import Split
from .conform import normalise_names
from .folder import Folder, table_folder
from .ingest import (
    DDL_PROPERTY, PLAN_PROPERTY, IngestResult, _check_names, get_property, identifier, name_parts, plan_before,
    plan_from_widths, prepare, publish, set_property, sized, stored_plan, widened_plan,
)

_MODE, _GROUP, _DONE, _LOADED = "tableferry.load.mode", "tableferry.load.group.", "tableferry.load.done.", "tableferry.loaded."


def ingest_groups(
    df: DataFrame, table: str, load: str, splits: list[Split], mode: str = "create", options: LoadOptions | dict | None = None,
) -> IngestResult:
    """Load ``df`` into ``table`` split by split; call it again with the same ``load`` name to go on after a stop.

    Every row must meet the condition of exactly one split, as it does with ``plan_splits``. The splits of the first call
    count: they are stored, and those of a later call are ignored, so a resumed load has the same groups. If a group fails,
    ``LoadStopped`` tells how many rows are committed; no row is in the target before the last group is. A value too wide for a table
    that is added to stops its group; the resumed load may have other ``options``. The input must be the same each time. Two jobs must not run one load at once.
    A table that is added to must be a plain Parquet table. Nulls, repeated rows and empty groups are loaded as they are.
    """
    if not re.fullmatch("[A-Za-z0-9_]+", load or ""):
        raise InvalidArgument(f"a load's name has letters, digits and _ only, got {load!r}")
    if not splits:
        raise InvalidArgument("a load in groups needs splits")
    mode, options, spark = check_mode(mode), LoadOptions.parse(options), df.sparkSession
    *schema, name = name_parts(table)
    stage = ".".join(map(quote, [*schema, f"{name}__load_{load}".lower()]))
    there = spark.catalog.tableExists(table)
    if there and (finished := get_property(spark, table, _LOADED + load)):
        _drop(spark, stage)
        return _result(spark, table, json.loads(finished))
    if there and mode == "create":
        raise TableExists(f"table {table.upper()} already exists")
    if not there and mode == "append":
        raise NotFound(f"table {table.upper()} does not exist")
    adding = there and mode in ("append", "create_append")
    if adding:
        table_folder(spark, table)
    known = widened_plan(spark, table, options) if adding else plan_before(normalise_names(df), options)
    if adding:
        _check_names(spark, table, normalise_names(df))
    groups, done = _ledger(spark, stage, df, table, splits, mode, adding, options, known)
    folder = table_folder(spark, stage)
    for number, condition in enumerate(groups):
        if number not in done:
            try:
                done[number] = _load_group(spark, df.where(condition), number, stage, folder, options, known)
            except Exception as error:
                rows = sum(group["rows"] for group in done.values())
                raise LoadStopped(f"group {number + 1} of {len(groups)} failed, {rows} rows are committed: {error}", rows, number) from error
    total = _total(done.values())
    if adding:
        _move_in(spark, folder, table, load, total)
        _drop(spark, stage)
    else:
        plan = known or plan_from_widths(normalise_names(df), total["widths"], options)
        set_property(spark, stage, **{PLAN_PROPERTY: plan.to_json(), DDL_PROPERTY: render_ddl(plan, table), _LOADED + load: json.dumps(total)})
        spark.sql(f"REFRESH TABLE {identifier(stage)}")
        if not publish(spark, stage, table, mode):
            raise InvalidState(f"table {table.upper()} was created by another job during the load; call again to add the rows to it")
    return _result(spark, table, total)


def _ledger(spark, stage, df, table, splits, mode, adding, options, known) -> tuple[list[str], dict[int, dict]]:
    """Conditions of all groups, and what is noted of the committed ones; a new load makes its staging table here."""
    named = normalise_names(df)
    schema = spark.table(table).schema if adding else prepare(named, options, known).rows.schema
    if not spark.catalog.tableExists(stage):
        spark.createDataFrame([], schema).write.format("parquet").saveAsTable(stage)
    noted = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {identifier(stage)}").collect()}
    if _MODE not in noted:
        # All conditions are noted at once with the mode, so a ledger is whole or not begun.
        set_property(spark, stage, **{_MODE: mode, **{f"{_GROUP}{i}": split.condition for i, split in enumerate(splits)}})
        return [split.condition for split in splits], {}
    kind = lambda fields: [(f.name.upper(), f.dataType.simpleString()) for f in fields]
    if noted[_MODE] != mode or kind(schema) != kind(spark.table(stage).schema):
        raise InvalidState(f"a load of this name was begun with mode {noted[_MODE]} or other columns: {stage}")
    numbers = sorted(int(key[len(_GROUP):]) for key in noted if key.startswith(_GROUP))
    done = {int(key[len(_DONE):]): json.loads(value) for key, value in noted.items() if key.startswith(_DONE)}
    return [noted[f"{_GROUP}{i}"] for i in numbers], done


def _load_group(spark: SparkSession, rows: DataFrame, number: int, stage: str, folder: Folder, options: LoadOptions, known: LoadPlan | None) -> dict:
    hidden, mark = f"_group_{number}", f"g{number:05d}-"
    for name in folder.files():
        if name == hidden or name.startswith(mark):
            folder.delete(name)
    prepared = prepare(normalise_names(sized(rows, options)), options, known)
    given = {name.upper(): name for name in prepared.rows.columns}
    columns = [(F.col(quote(given[f.name.upper()])) if f.name.upper() in given else F.lit(None)).cast(f.dataType).alias(f.name, metadata=f.metadata)
               for f in spark.table(stage).schema]
    prepared.rows.select(*columns).write.parquet(f"{folder.path}/{hidden}")
    for name in folder.files(hidden):
        if name[0] not in "_.":
            folder.move(folder.at(hidden, name), folder.at(mark + name))
    seen = prepared.observed.get
    note = {"rows": seen["rows"], "widths": {n: seen[key] or 0 for n, key in prepared.width_keys.items()}, "rejected": prepared.rejected()}
    set_property(spark, stage, **{f"{_DONE}{number}": json.dumps(note)})
    folder.delete(hidden)
    return note


def _total(notes) -> dict:
    """What all groups come to: rows and refused geometries add up, the widest value counts."""
    total: dict = {"rows": 0, "widths": {}, "rejected": {}}
    for note in notes:
        total["rows"] += note["rows"]
        for name, width in note["widths"].items():
            total["widths"][name] = max(width, total["widths"].get(name, 0))
        for name, count in note["rejected"].items():
            total["rejected"][name] = total["rejected"].get(name, 0) + count
    return total


def _move_in(spark: SparkSession, folder: Folder, table: str, load: str, total: dict) -> None:
    """The groups' files go into the table; a file that is there already has been moved before a stop."""
    target = table_folder(spark, table)
    for name in sorted(folder.files()):
        if re.match(r"g\d{5,}-", name):
            folder.move(folder.at(name), target.at(f"{load.lower()}-{name}"))
    set_property(spark, table, **{_LOADED + load: json.dumps(total)})
    spark.sql(f"REFRESH TABLE {identifier(table)}")


def _drop(spark: SparkSession, stage: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {identifier(stage)}")


def _result(spark: SparkSession, table: str, total: dict) -> IngestResult:
    plan = stored_plan(spark, table) or plan_from_widths(spark.table(table), total["widths"], LoadOptions())
    return IngestResult(table.upper(), total["rows"], plan, total["rejected"])
