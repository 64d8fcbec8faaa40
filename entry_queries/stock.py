"""A column inventory derived from ``part``: one inventory row per part."""

from pyspark.sql import functions as F

from tableferry.operators.inventory import INVENTORY

from .common import read

# Database column types, in the order parts are given them: (name, precision, scale).
COLUMN_TYPES = (
    ("NUMBER", 9, 0), ("NUMBER", 18, 0), ("NUMBER", 19, 0), ("NUMBER", 12, 2), ("NUMBER", None, None),
    ("number", 5, 0), ("FLOAT", 126, None), ("BINARY_FLOAT", None, None), ("BINARY_DOUBLE", None, None),
    ("IBDOUBLE", None, None), ("VARCHAR2", None, None), ("CLOB", None, None), ("NCHAR", None, None),
    ("ROWID", None, None), ("DATE", None, None), ("TIMESTAMP", None, 6), ("TIMESTAMP(6)", None, 6),
    ("TIMESTAMP(6) WITH TIME ZONE", None, 6), ("TIMESTAMP(9) WITH LOCAL TIME ZONE", None, 9),
    ("TIMESTAMPDTY", None, None), ("INTERVAL DAY(2) TO SECOND(6)", 2, 6), ("RAW", None, None),
    ("BLOB", None, None), ("OCIBLOBLOCATOR", None, None), ("BOOLEAN", None, None), ("SDO_GEOMETRY", None, None),
    ("MDSYS.SDO_GEOMETRY", None, None), ("XMLTYPE", None, None), ("JSON", None, None),
)
_cell = lambda value: "NULL" if value is None else (f"'{value}'" if isinstance(value, str) else str(value))


def _pick(i, key="p_partkey % {}".format(len(COLUMN_TYPES))):
    return f"CASE {key} " + " ".join(f"WHEN {n} THEN {_cell(t[i])}" for n, t in enumerate(COLUMN_TYPES)) + " END"


# SQL that both engines understand; one table holds every twentieth part of a brand and kind.
FIELDS = {
    "catalog": "CASE WHEN p_brand < 'Brand#2' THEN 'MAIN' ELSE 'ARCHIVE' END",
    "schema": "replace(upper(p_brand), '#', '_')",
    "table": "concat(p_type, '_', CAST(p_partkey % 20 AS {text}))",
    "table_type": "CASE WHEN p_partkey % 20 < 12 THEN 'TABLE' WHEN p_partkey % 20 < 18 THEN 'VIEW' ELSE 'MATERIALIZED VIEW' END",
    "column": "concat(CASE WHEN p_size > 25 THEN 'BIG_' ELSE 'SMALL' END, CAST(p_partkey AS {text}))",
    "position": "CAST(p_partkey AS INT)",
    "data_type": _pick(0),
    "nullable": "CASE p_partkey % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' ELSE '?' END",
    "default": "CASE WHEN p_partkey % 5 = 0 THEN p_name END",
    "precision": f"CAST({_pick(1)} AS INT)",
    "scale": f"CAST({_pick(2)} AS INT)",
}


def part_inventory(spark, sf_dir):
    parts = read(spark, sf_dir, "part")
    return parts.select(
        *[F.expr(FIELDS[f.name].format(text="STRING")).cast(f.dataType).alias(f.name) for f in INVENTORY]
    )


PART_INVENTORY_SQL = "SELECT " + ", ".join(
    f'{text.format(text="VARCHAR")} AS "{name}"' for name, text in FIELDS.items()
) + " FROM part"
