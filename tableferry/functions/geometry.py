"""Geometry objects as columns: rings, winding, rectangles and arcs in Catalyst expressions.

An object is ``struct<gtype, srid, point, elem_info, ordinates>``. All expressions are
linear in the number of ordinates: an array is bound once by ``let`` before its elements
are looked up, so it is never rebuilt per element.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINT_TYPE = (
    T.StructType().add("x", T.DoubleType()).add("y", T.DoubleType()).add("z", T.DoubleType())
)
GEOMETRY_TYPE = (
    T.StructType()
    .add("gtype", T.IntegerType())
    .add("srid", T.IntegerType())
    .add("point", POINT_TYPE)
    .add("elem_info", T.ArrayType(T.IntegerType()))
    .add("ordinates", T.ArrayType(T.DoubleType()))
)

# Segments per arc, below which determinant three points count as straight.
ARC_SEGMENTS = 32
STRAIGHT_LIMIT = 1e-10


def is_geometry_object(data_type: T.DataType) -> bool:
    return isinstance(data_type, T.StructType) and [f.name for f in data_type] == [
        f.name for f in GEOMETRY_TYPE
    ]


def let(value: str, name: str, body: str) -> str:
    """SQL text in which ``name`` stands for ``value``, evaluated once per row."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


# --- object fields -----------------------------------------------------------------


def dims(geom: Column) -> Column:
    return F.floor(geom["gtype"] / 1000).cast("int")


def lrs_dimension(geom: Column) -> Column:
    return (F.floor(geom["gtype"] / 100) % 10).cast("int")


def shape(geom: Column) -> Column:
    return geom["gtype"] % 100


def is_point(geom: Column) -> Column:
    """A point held in the point fields, both arrays empty."""
    empty = (filled(geom["elem_info"]) == 0) & (filled(geom["ordinates"]) == 0)
    return (shape(geom) == 1) & empty


def filled(array: Column) -> Column:
    """Number of elements; a missing array has none."""
    return F.when(array.isNull(), 0).otherwise(F.size(array))


def vertex_count(geom: Column) -> Column:
    return F.when(is_point(geom), F.lit(1)).otherwise(
        F.floor(filled(geom["ordinates"]) / dims(geom)).cast("int")
    )


# --- rings as SQL texts, so that they nest inside other lambdas ----------------------


def ring_area_sql(ring: str, dims: str) -> str:
    """Twice the signed area, closing edge included (it adds nothing to a closed ring)."""
    edge = lambda i, j: f"get({ring}, {i}) * get({ring}, {j} + 1) - get({ring}, {j}) * get({ring}, {i} + 1)"
    last = f"(size({ring}) - {dims})"
    return (
        f"aggregate(sequence(0, {last} - {dims}, {dims}), {edge(last, '0')},"
        f" (area, v) -> area + {edge('v', f'(v + {dims})')})"
    )


def oriented_sql(ring: str, dims: str, outer: str) -> str:
    """Outer rings counter-clockwise, holes clockwise; whole points change places.

    ``ring`` must be a name (column or lambda variable), not a computed array, and
    ``dims`` an int.
    """
    turned = (
        f"transform({ring}, (value, i) -> get({ring}, size({ring}) - {dims} - i + 2 * (i % {dims})))"
    )
    wrong = let(ring_area_sql(ring, dims), "area2", f"area2 != 0 AND (area2 > 0) != ({outer})")
    return f"CASE WHEN size({ring}) < 3 * {dims} THEN {ring} WHEN {wrong} THEN {turned} ELSE {ring} END"


def rectangle_sql(corners: str, dims: str) -> str:
    """Two corners to a closed five-point ring; further axes come from the first corner."""
    x1, y1 = f"get({corners}, 0)", f"get({corners}, 1)"
    x2, y2 = f"get({corners}, int({dims}))", f"get({corners}, int({dims} + 1))"
    path = ((x1, y1), (x2, y1), (x2, y2), (x1, y2), (x1, y1))
    flat = ", ".join(f"{x}, {y}" for x, y in path)
    deep = ", ".join(f"{x}, {y}, get({corners}, 2)" for x, y in path)
    return f"CASE WHEN {dims} = 3 THEN array({deep}) ELSE array({flat}) END"


def linearised_sql(arcs: str, dims: str) -> str:
    """Three-point arcs sharing their ends to straight segments.

    The sweep runs through the middle point. ``arcs`` must be a name. The steps follow
    each other instead of nesting, which keeps the plan small.
    """
    at = lambda step, axis: f"get({arcs}, int((2 * k + {step}) * {dims} + {axis}))"
    count = f"int((size({arcs}) - 2) div (2 * {dims}))"
    corners = (
        f"transform(sequence(0, {count} - 1), k -> named_struct('first', int(k > 0), 'wide', CASE WHEN {dims} = 3 THEN 3 ELSE 2 END,"
        f" 'ax', {at(0, 0)}, 'ay', {at(0, 1)}, 'bx', {at(1, 0)}, 'by', {at(1, 1)},"
        f" 'cx', {at(2, 0)}, 'cy', {at(2, 1)},"
        f" 'z', CASE WHEN {dims} = 3 THEN array({at(0, 2)}) ELSE array() END))"
    )
    # The circle's centre, as seen from the arc's first point: projected coordinates in the
    # millions lose no digits to their squares.
    relative = (
        f"transform({corners}, p -> named_struct('p', p, 'ux', p.bx - p.ax, 'uy', p.by - p.ay,"
        " 'vx', p.cx - p.ax, 'vy', p.cy - p.ay))"
    )
    determined = (
        f"transform({relative}, w -> named_struct('w', w, 'det', 2 * (w.ux * w.vy - w.uy * w.vx),"
        " 'uu', w.ux * w.ux + w.uy * w.uy, 'vv', w.vx * w.vx + w.vy * w.vy))"
    )
    centred = (
        f"transform({determined}, q -> named_struct('p', q.w.p, 'det', q.det,"
        " 'ox', q.w.p.ax + (q.uu * q.w.vy - q.vv * q.w.uy) / nullif(q.det, 0D),"
        " 'oy', q.w.p.ay + (q.vv * q.w.ux - q.uu * q.w.vx) / nullif(q.det, 0D)))"
    )
    angled = (
        f"transform({centred}, q -> named_struct('p', q.p, 'det', q.det, 'ox', q.ox, 'oy', q.oy,"
        " 'r', sqrt((q.p.ax - q.ox) * (q.p.ax - q.ox) + (q.p.ay - q.oy) * (q.p.ay - q.oy)),"
        " 'a', atan2(q.p.ay - q.oy, q.p.ax - q.ox), 'b', atan2(q.p.by - q.oy, q.p.bx - q.ox),"
        " 'c', atan2(q.p.cy - q.oy, q.p.cx - q.ox)))"
    )
    swept = (
        f"transform({angled}, q -> named_struct('p', q.p, 'det', q.det, 'ox', q.ox, 'oy', q.oy, 'r', q.r, 'a', q.a,"
        " 'sweep', pmod(q.c - q.a, 2 * pi()) - CASE WHEN pmod(q.b - q.a, 2 * pi()) <= pmod(q.c - q.a, 2 * pi())"
        " THEN 0D ELSE 2 * pi() END))"
    )
    straight = "slice(array({}), q.p.first + 1, 3)".format(
        ", ".join(f"concat(array(q.p.{c}x, q.p.{c}y), q.p.z)" for c in "abc")
    )
    # One number at a time: an array per point would take most of the time.
    angle = f"q.a + (i div q.p.wide) * q.sweep / {ARC_SEGMENTS}"
    curved = (
        f"transform(sequence(q.p.first * q.p.wide, {ARC_SEGMENTS + 1} * q.p.wide - 1), i -> CASE i % q.p.wide"
        f" WHEN 0 THEN q.ox + q.r * cos({angle}) WHEN 1 THEN q.oy + q.r * sin({angle}) ELSE get(q.p.z, 0) END)"
    )
    return (
        f"CASE WHEN size({arcs}) div {dims} < 3 THEN {arcs} ELSE"
        f" flatten(transform({swept}, q -> CASE WHEN abs(q.det) < {STRAIGHT_LIMIT}D THEN flatten({straight})"
        f" ELSE {curved} END)) END"
    )


def elements_sql(geom: str) -> str:
    """Element triplets as structs; each part ends where the next one starts."""
    info, ordinates = f"{geom}.elem_info", f"{geom}.ordinates"
    count = f"(size({info}) div 3)"
    return (
        f"CASE WHEN {info} IS NULL OR size({info}) < 3 THEN array() ELSE"
        f" transform(sequence(0, int({count}) - 1), e -> named_struct("
        f"'start', get({info}, e * 3), 'etype', get({info}, e * 3 + 1), 'interp', get({info}, e * 3 + 2),"
        f" 'stop', coalesce(get({info}, e * 3 + 3), coalesce(size({ordinates}), 0) + 1))) END"
    )


def part_sql(geom: str, element: str) -> str:
    """Ordinates of one element; both bounds have been checked."""
    return f"slice({geom}.ordinates, {element}.start, {element}.stop - {element}.start)"


def straight_part_sql(geom: str, element: str, dims: str) -> str:
    """Ordinates of one ring with rectangles and arcs written out as straight segments."""
    return let(
        part_sql(geom, element), "part",
        f"CASE {element}.interp WHEN 3 THEN {rectangle_sql('part', dims)}"
        f" WHEN 2 THEN {linearised_sql('part', dims)} ELSE part END",
    )


# --- the same for columns ------------------------------------------------------------


def _quoted(column: str) -> str:
    return ".".join(f"`{part}`" for part in column.replace("`", "").split("."))


def oriented(ring: str, dims: int | str, outer: str) -> Column:
    """Ring column with the winding its role asks for (``outer``: SQL condition)."""
    return F.expr(oriented_sql(_quoted(ring), str(dims), outer))


def rectangle(corners: str, dims: int | str = 2) -> Column:
    """NULL unless there are exactly two corners."""
    name = _quoted(corners)
    return F.expr(f"CASE WHEN size({name}) = 2 * {dims} THEN {rectangle_sql(name, str(dims))} END")


def linearised(arcs: str, dims: int | str = 2) -> Column:
    return F.expr(linearised_sql(_quoted(arcs), str(dims)))
