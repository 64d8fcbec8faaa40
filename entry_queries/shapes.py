"""Geometry inputs derived from the given tables, as columns and as DuckDB expressions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableferry.functions.geometry import GEOMETRY_TYPE

from .common import read

POINT_X_SQL = "CAST((event_id * 37 % 36000) AS DOUBLE) / 100 - 180"
POINT_Y_SQL = "CAST((event_id * 53 % 18000) AS DOUBLE) / 100 - 90"
POINT_Z_SQL = "CAST((event_id % 500) AS DOUBLE) / 4"


def geometry(gtype, srid, point="NULL", info="array()", ordinates="array()"):
    """A geometry object from SQL fragments."""
    return F.expr(
        f"named_struct('gtype', {gtype}, 'srid', {srid}, 'point', {point},"
        f" 'elem_info', {info}, 'ordinates', {ordinates})"
    ).cast(GEOMETRY_TYPE)


def event_points(spark, sf_dir) -> DataFrame:
    """Points in the plane, and every third one with a height."""
    events = read(spark, sf_dir, "events").select("event_id")
    flat = f"named_struct('x', {POINT_X_SQL}, 'y', {POINT_Y_SQL}, 'z', CAST(NULL AS DOUBLE))"
    high = f"named_struct('x', {POINT_X_SQL}, 'y', {POINT_Y_SQL}, 'z', {POINT_Z_SQL})"
    return events.withColumn("geom", geometry("2001", "4326", flat)).withColumn(
        "geom3", geometry("3001", "4326", high)
    )


NUMBERS = "transform(embedding, v -> double(v))"


def _embeddings(spark, sf_dir) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return vectors.select("vec_id", F.expr(NUMBERS).alias("n"))


def _add(name, kind, info, ordinates):
    def build(spark, sf_dir):
        return _embeddings(spark, sf_dir).select(
            "vec_id", geometry(kind, "3857", info=info, ordinates=ordinates).alias("geom")
        )

    SHAPES[name] = build


# 64 numbers are 32 vertices; parts are slices of 16 numbers, 8 vertices.
SHAPES = {}
_PARTS = range(0, 64, 16)
_closed = lambda start: f"slice(n, {start + 1}, 16), slice(n, {start + 1}, 2)"
_ends = ", ".join(str(1 + 18 * i) + ", {}, 1" for i in range(4))
_add("line", 2002, "array(1, 2, 1)", "n")
_add("line3", 3002, "array(1, 2, 1)", "concat(n, slice(n, 1, 2))")
_add("polygon", 2003, "array(1, 1003, 1)", "concat(n, slice(n, 1, 2))")
_add("holed", 2003, "array(1, 1003, 1, 19, 2003, 1, 37, 2003, 1, 55, 2003, 1)",
     f"concat({', '.join(_closed(s) for s in _PARTS)})")
_add("points", 2005, "array(1, 1, 32)", "n")
_add("lines", 2006, "array(1, 2, 1, 17, 2, 1, 33, 2, 1, 49, 2, 1)", "n")
# Two polygons: the first has one hole, the second has one as well.
_add("polygons", 2007, "array(1, 1003, 1, 19, 2003, 1, 37, 1003, 1, 55, 2003, 1)",
     f"concat({', '.join(_closed(s) for s in _PARTS)})")


def vertex_text(numbers: str, step: int = 2) -> str:
    """DuckDB: 'x y, x y' of a list of numbers."""
    coordinates = " || ' ' || ".join(f"{numbers}[i + {axis}]" for axis in range(step))
    return (
        f"list_aggregate(list_transform(range(1, len({numbers}) + 1, {step}), lambda i: {coordinates}),"
        " 'string_agg', ', ')"
    )


_N = "list_transform(embedding, lambda v: CAST(v AS DOUBLE))"
_part = lambda start: f"list_slice(n, {start + 1}, {start + 16})"
_ring = lambda start: f"(list_slice(n, {start + 1}, {start + 16}) || list_slice(n, {start + 1}, {start + 2}))"
_text = lambda numbers: f"'(' || {vertex_text(numbers)} || ')'"
_rings = lambda *starts: "'(' || " + " || ',' || ".join(_text(_ring(s)) for s in starts) + " || ')'"

WKT = {
    "line": f"'LINESTRING' || {_text('n')}",
    "line3": f"'LINESTRING Z (' || {vertex_text('(n || list_slice(n, 1, 2))', 3)} || ')'",
    "polygon": f"'POLYGON(' || {_text('(n || list_slice(n, 1, 2))')} || ')'",
    "holed": f"'POLYGON' || {_rings(0, 16, 32, 48)}",
    "points": f"'MULTIPOINT' || {_text('n')}",
    "lines": f"'MULTILINESTRING(' || {' || chr(44) || '.join(_text(_part(s)) for s in _PARTS)} || ')'",
    "polygons": f"'MULTIPOLYGON(' || {_rings(0, 16)} || ',' || {_rings(32, 48)} || ')'",
}
VECTORS = f"(SELECT vec_id, {_N} AS n FROM embeddings) e"


def wkb_oracle(shape: str) -> str:
    return f"SELECT vec_id, hex(ST_AsWKB(CAST({WKT[shape]} AS GEOMETRY))) AS wkb FROM {VECTORS}"
