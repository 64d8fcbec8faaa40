"""Loading arriving data: each micro-batch exactly once, column types fixed by the first.

Rows are stored under (LOAD_QUERY, LOAD_BATCH) partitions. A batch that is run again after
a failure overwrites its own partition, so no row is lost or doubled. The plan is stored
with the table, together with the checkpoint it belongs to, and so outlives the driver.

Compaction folds finished batches into one partition, numbered below zero after the last batch
it holds. The rows are written first, then the mark (that last batch) is stored with the table, and the
folded partitions are dropped last; ``loaded_rows`` reads by the mark, so each row is there once at any
moment. A batch up to the mark that is run again is left out, as its rows are there.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..errors import InvalidArgument, InvalidState, NotFound, TableExists
from ..operators.conform import normalise_names
from ..operators.ingest import (
    get_property, identifier, plan_before, prepare, set_property, sized, widened_plan, write_new,
)
from ..plans.columns import quote
from ..plans.options import LoadOptions, check_mode

QUERY_COLUMN, BATCH_COLUMN = "LOAD_QUERY", "LOAD_BATCH"
LOADER_PROPERTY = "tableferry.checkpoint"
REJECTED_PROPERTY = "tableferry.rejected"
COMPACTED_PROPERTY = "tableferry.compacted"
# All rows of a write go to one partition, so a task need not sort, and hold, its rows by partition first.
_UNSORTED = ("spark.sql.maxConcurrentOutputFileWriters", "1")


def ingest_stream(
    stream: DataFrame, table: str, checkpoint: str, mode: str = "create",
    options: LoadOptions | dict | None = None, continuous: bool = False, compact_every: int | None = None,
) -> StreamingQuery:
    """Start loading ``stream``; by default everything available now, then the query ends.

    The first micro-batch decides the column types. A wider value later on stops the query
    with a hint; what was committed before stays. Starting it again with ``clob_columns`` or
    ``string_type`` makes the columns wider, and the batch that failed is loaded then.
    Unreadable geometries are counted, see ``rejected_rows``. After every ``compact_every`` batches all
    but the newest are folded into one partition, see ``compact_stream``.
    """
    if not stream.isStreaming:
        raise InvalidState("ingest_stream needs a stream; use ingest for a table")
    mode, options = check_mode(mode), LoadOptions.parse(options)
    if compact_every is not None and compact_every < 1:
        raise InvalidArgument(f"compact_every must be a positive number, got {compact_every}")
    normalise_names(stream)  # refuses colliding names before anything is started
    spark = stream.sparkSession
    exists = spark.catalog.tableExists(table)
    resumed = exists and get_property(spark, table, LOADER_PROPERTY) == checkpoint
    if not resumed and mode == "create" and exists:
        raise TableExists(f"table {table.upper()} already exists")
    if mode == "append" and not exists:
        raise NotFound(f"table {table.upper()} does not exist")
    if not resumed and exists and mode in ("append", "create_append"):
        if BATCH_COLUMN not in spark.table(table).columns:
            raise InvalidState(f"table {table.upper()} was not made by a stream load")
    # An unset limit is fine: a micro-batch is bounded and is scanned in full.

    def write(rows: DataFrame, batch_id: int) -> None:
        session = rows.sparkSession
        # Both are settings of this batch's own session.
        session.conf.set(*_UNSORTED)
        query = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        ours = session.catalog.tableExists(table) and (
            mode in ("append", "create_append")
            or get_property(session, table, LOADER_PROPERTY) == checkpoint
        )
        if ours and batch_id <= _marks(session, table).get(query, -1):
            return
        named = normalise_names(sized(rows, options))
        # A first batch that failed is planned again from the same rows.
        known = widened_plan(session, table, options) if ours else plan_before(named, options)
        prepared = prepare(named, options, known)
        marks = {QUERY_COLUMN: F.lit(query), BATCH_COLUMN: F.lit(batch_id).cast("bigint")}
        if ours:
            # Only the batch's partition is replaced.
            session.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
            target = session.table(table)
            prepared.rows.withColumns(marks).select(
                *[F.col(quote(f.name)).cast(f.dataType).alias(f.name) for f in target.schema]
            ).write.mode("overwrite").insertInto(table)
        else:
            write_new(prepared, table, mode, marks, {LOADER_PROPERTY: checkpoint})
            _move_partition(session, table, query, batch_id)
        if prepared.reject_keys:
            _count_rejected(session, table, query, batch_id, prepared.rejected())
        if compact_every and (batch_id + 1) % compact_every == 0:
            _fold(session, table, query)

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer if continuous else writer.trigger(availableNow=True)).start()


def _move_partition(spark: SparkSession, table: str, query: str, batch_id: int) -> None:
    """Some catalogs keep a partition's old folder when its table is renamed."""
    about = spark.sql(f"DESCRIBE TABLE EXTENDED {identifier(table)}")
    folder = about.where("col_name = 'Location'").collect()[0].data_type
    partition = f"{QUERY_COLUMN} = '{query}', {BATCH_COLUMN} = {batch_id}"
    place = f"{folder}/{QUERY_COLUMN}={query}/{BATCH_COLUMN}={batch_id}"
    if spark.sql(f"SHOW PARTITIONS {identifier(table)}").count():
        spark.sql(f"ALTER TABLE {identifier(table)} PARTITION ({partition}) SET LOCATION '{place}'")


def _count_rejected(spark: SparkSession, table: str, query: str, batch_id: int, counts: dict[str, int]) -> None:
    """Totals per query, with the last batch they hold: a batch that is run again counts once."""
    totals = json.loads(get_property(spark, table, REJECTED_PROPERTY) or "{}")
    last, before = totals.get(query, (-1, {}))
    if batch_id > last:
        totals[query] = (batch_id, {name: before.get(name, 0) + n for name, n in counts.items()})
        set_property(spark, table, **{REJECTED_PROPERTY: json.dumps(totals)})


def rejected_rows(spark: SparkSession, table: str) -> dict[str, int]:
    """Unreadable geometries per column that stream loads have stored as NULL so far."""
    found: dict[str, int] = {}
    for _, counts in json.loads(get_property(spark, table, REJECTED_PROPERTY) or "{}").values():
        for name, n in counts.items():
            found[name] = found.get(name, 0) + n
    return found


def compact_stream(spark: SparkSession, table: str) -> int:
    """Folds all batches but the newest of every query into one partition each; the number of batches folded.

    ``loaded_rows`` is right at any moment, also if this stops half way; it can then be run again. Who reads the table itself
    may see folded rows twice until their old partitions are dropped. To be run by one job at a time.
    """
    if not spark.catalog.tableExists(table):
        raise NotFound(f"table {table.upper()} does not exist")
    if BATCH_COLUMN not in spark.table(table).columns:
        raise InvalidState(f"table {table.upper()} was not made by a stream load")
    return sum(_fold(spark, table, query) for query in sorted(_partitions(spark, table)))


def _fold(spark: SparkSession, table: str, query: str) -> int:
    spark.catalog.refreshTable(table)
    there, mark = _partitions(spark, table).get(query, []), _marks(spark, table).get(query, -1)
    fresh = sorted(b for b in there if b > mark)[:-1]
    if fresh and len(fresh) + (mark >= 0) > 1:
        last = fresh[-1]
        rows = spark.table(table).where(F.col(QUERY_COLUMN) == query).where(F.col(BATCH_COLUMN).isin([*fresh, *([-mark - 1] if mark >= 0 else [])]))
        folded = rows.withColumn(BATCH_COLUMN, F.lit(-last - 1).cast("bigint")).select(*rows.columns)
        settings = dict([("spark.sql.sources.partitionOverwriteMode", "dynamic"), _UNSORTED])
        before = {name: spark.conf.get(name) for name in settings}
        for name, value in settings.items():
            spark.conf.set(name, value)
        try:
            folded.write.mode("overwrite").insertInto(table)
        finally:
            for name, value in before.items():
                spark.conf.set(name, value)
        mark = last
        set_property(spark, table, **{COMPACTED_PROPERTY: json.dumps({**_marks(spark, table), query: last})})
    else:
        fresh = []
    # Also what an earlier fold that stopped has left: batches up to the mark, and folds without one.
    for batch in there:
        if mark >= batch >= 0 or batch < 0 and batch != -mark - 1:
            spark.sql(f"ALTER TABLE {identifier(table)} DROP IF EXISTS PARTITION ({QUERY_COLUMN} = '{query}', {BATCH_COLUMN} = {batch})")
    return len(fresh)


def _marks(spark: SparkSession, table: str) -> dict[str, int]:
    """Query -> last batch that has been folded."""
    return json.loads(get_property(spark, table, COMPACTED_PROPERTY) or "{}")


def _partitions(spark: SparkSession, table: str) -> dict[str, list[int]]:
    """Query -> numbers of its partitions; a folded one is below zero."""
    found: dict[str, list[int]] = {}
    for row in spark.sql(f"SHOW PARTITIONS {identifier(table)}").collect():
        query, batch = re.fullmatch(f"{QUERY_COLUMN}=(.*)/{BATCH_COLUMN}=(-?\\d+)", row[0], re.IGNORECASE).groups()
        found.setdefault(query, []).append(int(batch))
    return found


def loaded_rows(spark: SparkSession, table: str) -> DataFrame:
    """The loaded table without the columns that tell the batches apart.

    Batches are written by the query's own session, so this one forgets first what it may
    remember of the table's files.
    """
    spark.catalog.refreshTable(table)
    batch, whole = F.col(BATCH_COLUMN), F.col(BATCH_COLUMN) >= 0
    for query, mark in _marks(spark, table).items():
        whole = F.when(F.col(QUERY_COLUMN) == query, (batch > mark) | (batch == -mark - 1)).otherwise(whole)
    return spark.table(table).where(whole).drop(QUERY_COLUMN, BATCH_COLUMN)
