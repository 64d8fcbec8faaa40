"""Column plans: which database type each column of a load gets."""

from __future__ import annotations

import json
import re
from dataclasses import asdict, dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import InvalidArgument
from ..functions.crs import is_geometry_field
from ..functions.geometry import is_geometry_object
from ..functions.typemaps import FALLBACK_DDL, GEOMETRY_DDL, is_text, target_type
from .options import STANDARD_LIMIT, LoadOptions

# A text column whose producer announces large values, by its column metadata.
LARGE_TEXT_KEY = "large_text"
# Fixed values of the width rule: headroom factor and surplus, bucket size.
HEADROOM, SURPLUS, BUCKET = 2, 16, 64
PLAIN_NAME = re.compile(r"^[A-Z][A-Z0-9_$#]*(\.[A-Z][A-Z0-9_$#]*)*$")


@dataclass(frozen=True)
class ColumnPlan:
    position: int
    name: str
    source_type: str
    width: int | None
    declared: str
    nullable: bool

    @property
    def declared_bytes(self) -> int | None:
        found = re.fullmatch(r"VARCHAR2\((\d+)\)", self.declared)
        return int(found.group(1)) if found else None


@dataclass(frozen=True)
class LoadPlan:
    columns: tuple[ColumnPlan, ...]
    inline_limit: int

    @property
    def declared(self) -> dict[str, str]:
        return {column.name: column.declared for column in self.columns}

    @classmethod
    def of(cls, rows: DataFrame, options: LoadOptions) -> "LoadPlan":
        """From plan rows: as many reach the driver as the table has columns."""
        columns = (ColumnPlan(**row.asDict()) for row in rows.collect())
        return cls(tuple(sorted(columns, key=lambda c: c.position)), options.inline_limit)

    def limits(self) -> dict[str, int]:
        """Declared byte widths of the columns that are stored as sized text, by name."""
        return {c.name: c.declared_bytes for c in self.columns if c.declared_bytes is not None}

    def widened(self, options: LoadOptions) -> "LoadPlan":
        """The plan with the columns that ``options`` name made wider; none becomes narrower.

        ``clob_columns`` and ``string_type=clob`` turn sized text into CLOB, and
        ``string_type=varchar2`` gives it the whole inline limit.
        """
        limit = max(self.inline_limit, options.inline_limit)

        def wider(column: ColumnPlan) -> ColumnPlan:
            if column.declared_bytes is None:
                return column
            if options.string_type == "clob" or column.name in options.clob_columns:
                return replace(column, declared="CLOB")
            if options.string_type == "varchar2" and column.declared_bytes < limit:
                return replace(column, declared=f"VARCHAR2({limit})")
            return column

        return LoadPlan(tuple(map(wider, self.columns)), limit)

    def to_json(self) -> str:
        return json.dumps({"inline_limit": self.inline_limit, "columns": [asdict(c) for c in self.columns]})

    @classmethod
    def from_json(cls, text: str) -> "LoadPlan":
        data = json.loads(text)
        return cls(tuple(ColumnPlan(**c) for c in data["columns"]), data["inline_limit"])


def quote(name: str) -> str:
    """A column name as Spark SQL takes it, whatever it holds."""
    return "`" + name.replace("`", "``") + "`"


def upper_names(names: list[str]) -> list[str]:
    """Names as the target stores them; two names that become one are refused."""
    upper = [name.upper() for name in names]
    twice = sorted({name for name in upper if upper.count(name) > 1})
    if twice:
        raise InvalidArgument(f"column names collide in upper case: {', '.join(twice)}")
    return upper


def sql_text(value: str) -> str:
    """A SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def declared_width_sql(width: str, limit: int) -> str:
    """Declared bytes for an observed maximum: headroom, rounded up, kept inline if it fits."""
    bucket = f"((greatest({width}, 1) * {HEADROOM} + {SURPLUS + BUCKET - 1}) div {BUCKET} * {BUCKET})"
    inline = f"CASE WHEN {width} <= {STANDARD_LIMIT} THEN least({bucket}, {STANDARD_LIMIT}) ELSE {bucket} END"
    return f"CAST(least(greatest({inline}, {BUCKET}), {limit}) AS BIGINT)"


def declared_width(width: str, limit: int) -> Column:
    return F.expr(declared_width_sql(width, limit))


def column_type_sql(field: T.StructField, width: str | None, options: LoadOptions) -> str:
    """Declared type of one column as SQL; without a ``width`` nothing was scanned."""
    limit = options.inline_limit
    if is_geometry_field(field) or is_geometry_object(field.dataType):
        return sql_text(GEOMETRY_DDL)
    if not is_sized(field):
        return sql_text(target_type(field.dataType))
    if field.name.upper() in options.clob_columns or options.string_type == "clob":
        return "'CLOB'"
    large = (field.metadata or {}).get(LARGE_TEXT_KEY) and options.string_type != "varchar2"
    unscanned = "'CLOB'" if large else f"'VARCHAR2({limit})'"
    if options.string_type == "varchar2" or width is None:
        return unscanned
    sized = f"concat('VARCHAR2(', {declared_width_sql(width, limit)}, ')')"
    return f"CASE WHEN {width} IS NULL THEN {unscanned} WHEN {width} > {limit} THEN 'CLOB' ELSE {sized} END"


def is_sized(field: T.StructField) -> bool:
    """Whether the column is stored as text: text itself, and values loaded in their text form."""
    if is_geometry_field(field) or is_geometry_object(field.dataType):
        return False
    return is_text(field.dataType) or target_type(field.dataType) == FALLBACK_DDL


def scanned_columns(schema: T.StructType, options: LoadOptions) -> list[str]:
    """Columns stored as text whose type depends on the data; empty means no scan is needed."""
    if options.string_type != "auto":
        return []
    return [f.name for f in schema if is_sized(f) and f.name.upper() not in options.clob_columns]


def plan_rows(widths: DataFrame, schema: T.StructType, options: LoadOptions) -> DataFrame:
    """One row per column from one row of widths (columns named as in ``schema``)."""
    names = upper_names(schema.fieldNames())
    present = set(widths.columns)
    cells = []
    for position, (field, name) in enumerate(zip(schema, names), start=1):
        width = quote(field.name) if field.name in present else None
        # '' is stored as NULL by the target, so text is never declared NOT NULL.
        cells.append(
            f"named_struct('position', {position}, 'name', {sql_text(name)},"
            f" 'source_type', {sql_text(field.dataType.simpleString())},"
            f" 'width', CAST({width or 'NULL'} AS BIGINT),"
            f" 'declared', {column_type_sql(field, width, options)},"
            f" 'nullable', {str(field.nullable or is_sized(field)).lower()})"
        )
    return widths.selectExpr(f"inline(array({', '.join(cells)}))")


def target_types(schema: T.StructType, options: LoadOptions | dict | None = None) -> list[tuple[str, str]]:
    """(name, database type) per column, without looking at any data."""
    options = LoadOptions.parse(options)
    limit = f"VARCHAR2({options.inline_limit})"
    result = []
    for field, name in zip(schema, upper_names(schema.fieldNames())):
        if is_geometry_field(field) or is_geometry_object(field.dataType):
            declared = GEOMETRY_DDL
        elif is_text(field.dataType):
            declared = limit
        else:
            declared = target_type(field.dataType)
        result.append((name, declared))
    return result


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def table_name(name: str) -> str:
    """Upper case; quoted only where the plain form would not be a name."""
    upper = name.upper()
    return upper if PLAIN_NAME.match(upper) else quoted(upper)


def render_ddl(plan: LoadPlan, table: str) -> str:
    columns = ", ".join(
        f"{quoted(c.name)} {c.declared}{'' if c.nullable else ' NOT NULL'}" for c in plan.columns
    )
    return f"CREATE TABLE {table_name(table)} ({columns}) NOLOGGING"


def ddl_frame(plan: DataFrame, table: str) -> DataFrame:
    """The same statement as a one-row table, from the rows of a plan."""
    cell = F.concat(
        F.lit('"'), F.replace(F.col("name"), F.lit('"'), F.lit('""')), F.lit('" '), F.col("declared"),
        F.when(F.col("nullable"), "").otherwise(" NOT NULL"),
    )
    listed = F.sort_array(F.collect_list(F.struct("position", cell.alias("cell"))))
    body = F.array_join(F.transform(listed, lambda c: c["cell"]), ", ")
    return plan.agg(
        F.concat(F.lit(f"CREATE TABLE {table_name(table)} ("), body, F.lit(") NOLOGGING")).alias("ddl")
    )
