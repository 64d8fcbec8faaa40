"""Databases reached over JDBC, through Spark's own connector and its options."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..errors import InvalidArgument, NotFound
from ..operators.conform import conform
from ..operators.sizing import guarded
from ..plans.columns import LoadPlan, quote
from ..plans.options import check_mode
from .splits import Split

FETCH_ROWS = 10_000
BATCH_ROWS = 10_000
# How the planned types are spelled in Spark's own type language, the only one the connector
# takes. Types it has no word for need a table that was made with the plan's own DDL.
_SPARK_SPELLING = {
    "NUMBER(19)": "DECIMAL(19,0)", "NUMBER(20)": "DECIMAL(20,0)", "NUMBER(1)": "DECIMAL(1,0)",
    "BINARY_DOUBLE": "DOUBLE", "BINARY_FLOAT": "FLOAT",
}


def jdbc_read_options(
    url: str, query: str, partition_column: str | None = None, lower: str | None = None,
    upper: str | None = None, partitions: int | None = None, **extra: str,
) -> dict[str, str]:
    """Options of a scan; with a partition column it runs as that many parallel reads."""
    options = {"url": url, "fetchsize": str(FETCH_ROWS), "preferTimestampNTZ": "true", **extra}
    if partition_column is None:
        return {**options, "query": query}
    if None in (lower, upper, partitions):
        raise InvalidArgument("a partitioned scan needs lower, upper and partitions")
    return {
        **options, "dbtable": f"({query}) q", "partitionColumn": partition_column,
        "lowerBound": str(lower), "upperBound": str(upper), "numPartitions": str(partitions),
    }


def split_reads(options: dict[str, str], splits: list[Split]) -> dict:
    """Arguments of the connector's reader for one read a split."""
    if "query" not in options:
        raise InvalidArgument("a scan is cut by splits or by a partition column, not by both")
    rest = {key: value for key, value in options.items() if key not in ("url", "query")}
    return {"url": options["url"], "table": f"({options['query']}) q", "predicates": [s.condition for s in splits], "properties": rest}


def custom_schema(schema: T.StructType) -> str:
    """The read types of a table (see ``table_schema``) as the connector takes them."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in schema)


def load_jdbc(
    spark: SparkSession, url: str, query: str, schema: T.StructType | None = None,
    splits: list[Split] | None = None, **options
) -> DataFrame:
    """The result of a remote query, conformed to ``schema`` if one is given.

    With ``splits`` (see ``plan_splits``, whose ``name`` is the column as the database spells it) every split is one of
    the parallel reads.
    """
    given = jdbc_read_options(url, query, **options)
    if splits is None:
        df = spark.read.format("jdbc").options(**given).load()
    else:
        df = spark.read.jdbc(**split_reads(given, splits))
    return conform(df, schema) if schema is not None else df


def jdbc_write_options(plan: LoadPlan, url: str, table: str, workers: int | None = None, **extra: str) -> dict[str, str]:
    """Options of a load: declared widths from the plan, one transaction per partition."""
    types = []
    for column in plan.columns:
        number = re.fullmatch(r"NUMBER\((\d+),(\d+)\)", column.declared)
        if column.declared_bytes is not None:
            types.append(f"{quote(column.name)} VARCHAR({column.declared_bytes})")
        elif number:
            types.append(f"{quote(column.name)} DECIMAL({number[1]},{number[2]})")
        elif column.declared in _SPARK_SPELLING:
            types.append(f"{quote(column.name)} {_SPARK_SPELLING[column.declared]}")
    options = {"url": url, "dbtable": table.upper(), "batchsize": str(BATCH_ROWS), **extra}
    if types:
        options["createTableColumnTypes"] = ", ".join(types)
    if workers:
        options["numPartitions"] = str(workers)
    return options


# Declared types that only the database's own DDL can name.
ONLY_BY_DDL = ("CLOB", "MDSYS.SDO_GEOMETRY")


def check_jdbc_load(plan: LoadPlan, mode: str) -> str:
    """The mode's plain name; a load that would have to create types it cannot name is refused."""
    mode = check_mode(mode)
    unnamed = [f"{c.name} {c.declared}" for c in plan.columns if c.declared in ONLY_BY_DDL]
    if unnamed and mode != "append":
        raise InvalidArgument(
            f"the connector cannot create {', '.join(unnamed)}: make the table with render_ddl(plan, table) and append to it")
    return mode


def write_jdbc(df: DataFrame, plan: LoadPlan, url: str, table: str, mode: str = "create",
               workers: int | None = None, **extra: str) -> None:
    """Load a table that is already in load form into a database.

    ``append`` needs a table that exists. A value wider than its planned column stops the load.
    """
    save_mode = {"create": "errorifexists", "append": "append", "replace": "overwrite", "create_append": "append"}
    mode = check_jdbc_load(plan, mode)
    options = jdbc_write_options(plan, url, table, workers, **extra)
    if mode == "append":
        try:
            df.sparkSession.read.format("jdbc").options(**{k: v for k, v in options.items() if k != "createTableColumnTypes"}).load()
        except Exception as error:
            raise NotFound(f"table {table.upper()} cannot be read, so nothing is appended") from error
    guarded(df, plan.limits()).write.format("jdbc").options(**options).mode(save_mode[mode]).save()
