"""How many tasks write a load: chosen from the bytes that its partitions hold, or given."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .sizing import record_bytes

#: Last steps of an input that Spark leaves out when its rows are dealt again at once.
_DEALS = ("Repartition", "RepartitionByExpression")
#: How much more than an even share a task may get if that spares the rows a shuffle.
UNEVEN = 1.25


def balanced(df: DataFrame, file_bytes: int, most: int | None = None, form: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """``df`` in partitions of about ``file_bytes`` (see ``record_bytes``), at most ``most`` of them; ``form`` gives the rows whose bytes count.

    One aggregation finds what each partition holds; the input is read once more for it. Light partitions are put together where they are,
    without a shuffle, if even the heaviest of them side by side stay below twice the size. Only where a partition holds too
    much, or would, do the rows move: dealt evenly, whatever their keys. Fitting or empty input is left as it is. A row is
    never cut, so one that is larger than a file makes its file larger.

    Input whose last step deals it (``repartition``, ``coalesce``) is counted and dealt evenly in place of that step, so no task
    gets the whole of it, or of a heavy key, even if the caller put it there.
    """
    found = held_by_part(df, form).agg(F.count("*").alias("n"), F.sum("bytes").alias("total"), F.max("bytes").alias("heaviest")).first()
    if not found.n:
        return df
    wanted = max(1, -(-found.total // file_bytes))
    wanted = min(wanted, most) if most else wanted
    if is_dealt(df):
        return df.repartition(wanted)
    aim = max(file_bytes, -(-found.total // wanted))
    if wanted < found.n and found.heaviest * -(-found.n // wanted) <= 2 * aim:
        return df.coalesce(wanted)
    if found.heaviest > 2 * aim or wanted < found.n:
        return df.repartition(wanted)
    return df


def is_dealt(df: DataFrame) -> bool:
    """Whether the last step of ``df`` deals its rows to partitions."""
    return df._jdf.queryExecution().optimizedPlan().nodeName() in _DEALS


def held_by_part(df: DataFrame, form: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(part, bytes) of the partitions that hold rows; those of dealt input are Spark's own choice."""
    rows = form(df.hint("rebalance") if is_dealt(df) else df)
    size = F.coalesce(record_bytes(rows.schema), F.lit(0))
    return rows.select(F.spark_partition_id().alias("part"), size.alias("bytes")).groupBy("part").agg(F.sum("bytes").alias("bytes"))


def dealt(rows: DataFrame, tasks: int, source: DataFrame) -> DataFrame:
    """``rows``, made value by value from ``source``, in ``tasks`` partitions that hold about as many rows each.

    Rows of files as they are stored stay where they are: a task reads its share of the files itself, if the files' splits
    put together leave no task without rows and give none more than ``UNEVEN`` shares. One aggregation that needs no column of
    the files finds that. All other rows are dealt by a shuffle, so what comes before, a join or a parse, keeps its own tasks.
    """
    if not is_stored(source):
        return rows.repartition(tasks)
    if tasks > 1:
        parts = source.coalesce(tasks).groupBy(F.spark_partition_id().alias("part")).agg(F.count("*").alias("n"))
        found = parts.agg(F.count("*").alias("parts"), F.sum("n").alias("total"), F.max("n").alias("most")).first()
        if found.parts < tasks or found.most * tasks > UNEVEN * found.total:
            return rows.repartition(tasks)
    return rows.coalesce(tasks)


def is_stored(df: DataFrame) -> bool:
    """Whether ``df`` is all rows of files, with columns as they are stored, some left out or renamed, and none nested (those are loaded as text)."""
    if any(isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) for f in df.schema):
        return False
    plan = df._jdf.queryExecution().optimizedPlan()
    if plan.nodeName() == "Project":
        columns, plan = plan.projectList(), plan.child()
        made = (columns.apply(i).children() for i in range(columns.size()))
        if any(not of.isEmpty() and not of.head().children().isEmpty() for of in made):
            return False
    return plan.nodeName() == "LogicalRelation" and plan.relation().getClass().getSimpleName() == "HadoopFsRelation"
