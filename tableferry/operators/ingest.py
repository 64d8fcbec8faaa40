"""Loading a DataFrame into a table: four modes, one write, nothing half done.

A new or replacing load goes to a staging table first and is then renamed, so a failed
job leaves the target as it was. Only a replacing load ever moves a table that is there: if
another job makes the table during the write, ``create`` fails and ``create_append`` adds its
rows to it. Row counts, text widths and rejected geometries are observed during the write
itself; the data is not read a second time for them.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from ..errors import InvalidArgument, InvalidState, NotFound, TableExists
from ..functions.geometry import is_geometry_object
from ..plans.columns import LoadPlan, plan_rows, quote, render_ddl, scanned_columns, sql_text
from ..plans.options import LoadOptions, check_mode
from .conform import normalise_names, to_load_form
from .fanout import balanced, dealt
from .geometry import decode_geometry, geometry_columns
from .sizing import guarded, plan_columns

PLAN_PROPERTY = "tableferry.plan"
DDL_PROPERTY = "tableferry.ddl"


@dataclass(frozen=True)
class IngestResult:
    """``rows`` are committed rows; ``rejected`` counts unreadable geometries per column."""

    table: str
    rows: int
    plan: LoadPlan
    rejected: dict[str, int] = field(default_factory=dict)

    @property
    def ddl(self) -> str:
        return render_ddl(self.plan, self.table)


def ingest(
    df: DataFrame, table: str, mode: str = "create", options: LoadOptions | dict | None = None,
) -> IngestResult:
    """Load ``df`` into ``table``.

    Columns stored as text are sized by all rows. When rows are added to a table that has a
    plan, a value wider than its column stops the load; ``clob_columns`` and ``string_type``
    then make the stored plan's columns wider, before the rows are written.
    """
    if df is None:
        raise InvalidState("no data bound for ingest")
    mode, options = check_mode(mode), LoadOptions.parse(options)
    spark = df.sparkSession
    exists = spark.catalog.tableExists(table)
    if mode == "create" and exists:
        raise TableExists(f"table {table.upper()} already exists")
    if mode == "append" and not exists:
        raise NotFound(f"table {table.upper()} does not exist")

    named = normalise_names(sized(df, options))
    adding = exists and mode in ("append", "create_append")
    known = widened_plan(spark, table, options) if adding else plan_before(named, options)
    prepared = prepare(named, options, known)
    if adding:
        _check_names(spark, table, prepared.rows)
        add_rows(prepared.rows, table)
        plan = known or plan_from_widths(named, {}, options)
    else:
        plan = write_new(prepared, table, mode)
    return IngestResult(table.upper(), prepared.observed.get["rows"], plan, prepared.rejected())


@dataclass(frozen=True)
class Prepared:
    """Rows ready to be written; what the write observes is read afterwards."""

    named: DataFrame
    rows: DataFrame
    options: LoadOptions
    known: LoadPlan | None
    observed: Observation
    width_keys: dict[str, str]
    reject_keys: dict[str, str]

    def plan(self) -> LoadPlan:
        if self.known is not None:
            return self.known
        seen = self.observed.get
        widths = {name: seen[key] or 0 for name, key in self.width_keys.items()}
        return plan_from_widths(self.named, widths, self.options)

    def rejected(self) -> dict[str, int]:
        seen = self.observed.get
        return {name: seen[key] for name, key in self.reject_keys.items()}


def plan_before(named: DataFrame, options: LoadOptions) -> LoadPlan | None:
    """The plan if it does not depend on the rows, else None: the write finds the widths."""
    depends = scanned_columns(named.schema, options) and options.type_scan_limit_bytes != 0
    return None if depends else plan_columns(named, options)


def widened_plan(spark: SparkSession, table: str, options: LoadOptions) -> LoadPlan | None:
    """The table's stored plan, made wider where ``options`` ask for it, and stored again."""
    known = stored_plan(spark, table)
    if known is None:
        return None
    wider = known.widened(options)
    if wider != known:
        set_property(spark, table, **{PLAN_PROPERTY: wider.to_json(), DDL_PROPERTY: render_ddl(wider, table)})
    return wider


def sized(df: DataFrame, options: LoadOptions) -> DataFrame:
    """``df``, in the partitions that ``ingest_file_bytes`` asks for.

    To be called on the input as it was given: a step in between, like new names, can make Spark carry out the input's own deal first.
    """
    if not options.ingest_file_bytes:
        return df
    return balanced(df, options.ingest_file_bytes, options.ingest_workers, form=lambda rows: _written_form(normalise_names(rows)))


def _written_form(named: DataFrame) -> DataFrame:
    """The load form, but for what a Spark table keeps as it is."""
    geometry = geometry_columns(named.schema)
    objects = [f.name for f in named.schema if is_geometry_object(f.dataType)]
    # A Spark table keeps a decimal as the type it is declared with; only a target that takes
    # it as text needs the load form.
    decimals = [f.name for f in named.schema if isinstance(f.dataType, T.DecimalType)]
    return to_load_form(named, keep=(*geometry, *objects, *decimals))


def prepare(named: DataFrame, options: LoadOptions, known: LoadPlan | None) -> Prepared:
    """Rows as they are written, with an observation of counts and widths attached. ``named`` is ``sized`` already."""
    geometry, rows = geometry_columns(named.schema), _written_form(named)
    if options.ingest_workers and not options.ingest_file_bytes:
        rows = dealt(rows, options.ingest_workers, named)
    rows = guarded(rows, known.limits() if known is not None else {})
    reasons = {name: f"__reason{i}" for i, name in enumerate(geometry)}
    for name, reason in reasons.items():
        rows = decode_geometry(rows, name, reason=reason)
    texts = [] if known is not None else scanned_columns(named.schema, options)
    width_keys = {name: f"width{i}" for i, name in enumerate(texts)}
    reject_keys = {name: f"rejected{i}" for i, name in enumerate(geometry)}
    observed = Observation()
    # Last step before the write, so it runs in the job's result stage, where a task that
    # is repeated is counted once.
    rows = rows.observe(
        observed,
        F.count(F.lit(1)).alias("rows"),
        *[F.max(F.octet_length(quote(n))).alias(k) for n, k in width_keys.items()],
        *[F.count_if(F.col(reasons[n]).isNotNull()).alias(k) for n, k in reject_keys.items()],
    )
    return Prepared(named, rows.drop(*reasons.values()), options, known, observed, width_keys, reject_keys)


def write_new(
    prepared: Prepared, table: str, mode: str, partitions: dict[str, Column] | None = None,
    properties: dict[str, str] | None = None,
) -> LoadPlan:
    """Write to a staging table, note the plan there, and give it the target's name.

    If the table has come to exist meanwhile, ``create`` fails, ``create_append`` adds the
    staged rows to it, and ``replace`` takes its place.
    """
    spark, stage = prepared.rows.sparkSession, stage_name(table)
    partitions = partitions or {}
    try:
        writer = prepared.rows.withColumns(partitions).write.format("parquet").mode("errorifexists")
        (writer.partitionBy(*partitions) if partitions else writer).saveAsTable(stage)
        plan = prepared.plan()
        noted = {PLAN_PROPERTY: plan.to_json(), DDL_PROPERTY: render_ddl(plan, table), **(properties or {})}
        set_property(spark, stage, **noted)
        if not publish(spark, stage, table, mode):
            plan = _add_staged(spark, stage, table, plan)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {identifier(stage)}")
        raise
    return plan


def _add_staged(spark: SparkSession, stage: str, table: str, plan: LoadPlan) -> LoadPlan:
    """The staged rows go into the table that was made meanwhile, under that table's plan."""
    known, rows = stored_plan(spark, table), spark.table(stage)
    _check_names(spark, table, rows)
    add_rows(guarded(rows, known.limits()) if known else rows, table)
    spark.sql(f"DROP TABLE {identifier(stage)}")
    return known or plan


def plan_from_widths(named: DataFrame, widths: dict[str, int], options: LoadOptions) -> LoadPlan:
    one = named.sparkSession.range(1).select(
        *[F.lit(width).cast("bigint").alias(name) for name, width in widths.items()]
    )
    return LoadPlan.of(plan_rows(one, named.schema, options), options)


# --- catalog steps -------------------------------------------------------------------


def name_parts(table: str) -> list[str]:
    """The parts of a table name; a quoted part may hold dots."""
    return [p.replace("``", "`") if p else q for p, q in re.findall(r"`((?:[^`]|``)+)`|([^.`]+)", table)]


def identifier(table: str) -> str:
    return ".".join(map(quote, name_parts(table)))


def stage_name(table: str, use: str = "stage") -> str:
    """A name of this load's own in the table's schema, quoted."""
    *schema, name = name_parts(table)
    return ".".join(map(quote, [*schema, f"{name}__{use}_{uuid.uuid4().hex[:12]}"]))


def publish(spark: SparkSession, stage: str, table: str, mode: str) -> bool:
    """The staged table takes the target's name; False if ``create_append`` finds it taken.

    The catalog refuses a name that is taken, also when another job took it a moment ago. Only
    ``replace`` moves the table away first, and drops it last.
    """
    old = None
    if mode == "replace" and spark.catalog.tableExists(table):
        old = stage_name(table, "old")
        spark.sql(f"ALTER TABLE {identifier(table)} RENAME TO {identifier(old)}")
    try:
        spark.sql(f"ALTER TABLE {identifier(stage)} RENAME TO {identifier(table)}")
    except Exception as error:
        if old:
            spark.sql(f"ALTER TABLE {identifier(old)} RENAME TO {identifier(table)}")
        if mode != "replace" and isinstance(error, AnalysisException) and spark.catalog.tableExists(table):
            if mode == "create_append":
                return False
            raise TableExists(f"table {table.upper()} was created by another job during the load") from error
        raise
    if old:
        spark.sql(f"DROP TABLE {identifier(old)}")
    return True


def _check_names(spark: SparkSession, table: str, rows: DataFrame) -> None:
    present = {name.upper() for name in spark.table(table).columns}
    unknown = [name for name in rows.columns if name.upper() not in present]
    if unknown:
        raise InvalidArgument(f"table {table.upper()} has no column {', '.join(unknown)}")


def add_rows(rows: DataFrame, table: str) -> None:
    """Insert by name; columns the rows do not have stay NULL."""
    given = {name.upper(): name for name in rows.columns}
    columns = [
        (F.col(quote(given[f.name.upper()])) if f.name.upper() in given else F.lit(None))
        .cast(f.dataType).alias(f.name)
        for f in rows.sparkSession.table(table).schema
    ]
    rows.select(*columns).write.insertInto(table)


def set_property(spark: SparkSession, table: str, **values: str) -> None:
    texts = ", ".join(f"'{key}' = {sql_text(value)}" for key, value in values.items())
    spark.sql(f"ALTER TABLE {identifier(table)} SET TBLPROPERTIES ({texts})")


def get_property(spark: SparkSession, table: str, name: str) -> str | None:
    rows = spark.sql(f"SHOW TBLPROPERTIES {identifier(table)}").where(F.col("key") == name).collect()
    return rows[0]["value"] if rows else None


def stored_plan(spark: SparkSession, table: str) -> LoadPlan | None:
    text = get_property(spark, table, PLAN_PROPERTY)
    return LoadPlan.from_json(text) if text else None
