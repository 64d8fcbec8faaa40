"""Geometry table jobs: WKB to objects and back, rings, vertices and checks.

No job here shuffles. The Arrow kernels receive only the geometry column; the other
columns stay in the JVM. A filter written before ``decode_geometry`` reaches the files; one
written after it does not (see ``functions/wkb.py`` for why), so filter first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import InvalidArgument, NotFound
from ..functions import crs
from ..functions import geometry as G
from ..functions.wkb import pack_wkb, unpack_wkb

# WKB kind to object shape, and back.
SHAPE_OF_KIND = {1: 1, 2: 2, 3: 3, 4: 5, 5: 6, 6: 7}
_RAW = "__unpacked"
_ELEMENTS = "__elements"
_FACTS = "__facts"


def geometry_columns(schema: T.StructType) -> list[str]:
    return [field.name for field in schema if crs.is_geometry_field(field)]


def tag_crs(df: DataFrame, column: str, srid: int | None) -> DataFrame:
    """Mark a binary column as WKB with its reference system; touches no row."""
    return df.withMetadata(column, {**_field(df, column).metadata, **crs.crs_metadata(srid)})


def _field(df: DataFrame, column: str) -> T.StructField:
    for field in df.schema:
        if field.name.lower() == column.lower():
            return field
    raise NotFound(f"no column {column!r} among {df.columns}")


def _case(values: dict[int, int], key: str) -> str:
    return f"CASE {key} " + " ".join(f"WHEN {k} THEN {v}" for k, v in values.items()) + " END"


def decode_geometry(
    df: DataFrame, column: str, srid: int | None = None, out: str | None = None,
    reason: str | None = None,
) -> DataFrame:
    """WKB column to geometry objects, rings wound the way objects require.

    A value that cannot be read becomes NULL; ``reason`` names a column that says why.
    Without ``srid`` the number comes from the column's tag.
    """
    field = _field(df, column)
    out = out or column
    if not isinstance(field.dataType, T.BinaryType):
        # Only bytes can hold WKB; anything else is NULL rather than an error.
        empty = df.withColumn(out, F.lit(None).cast(G.GEOMETRY_TYPE))
        return empty.withColumn(reason, F.lit(None).cast("string")) if reason else empty
    srid = crs.field_srid(field) if srid is None else srid
    known = df.withColumn(_RAW, unpack_wkb(F.col(column)))
    dims = f"{_RAW}.dims"
    wound = G.let(
        f"slice({_RAW}.ordinates, e.start, e.stop - e.start)", "ring",
        f"CASE WHEN e.etype IN (1003, 2003) THEN {G.oriented_sql('ring', dims, 'e.etype = 1003')}"
        " ELSE ring END",
    )
    alone = G.let(f"{_RAW}.ordinates", "ring", G.oriented_sql("ring", dims, "true"))
    ordinates = (
        f"CASE WHEN {_RAW}.kind < 3 THEN {_RAW}.ordinates"
        f" WHEN {_RAW}.elem_info = array(1, 1003, 1) THEN {alone}"
        f" ELSE flatten(transform({G.elements_sql(_RAW)}, e -> {wound})) END"
    )
    point = (
        f"CASE WHEN {_RAW}.kind = 1 THEN"
        f" named_struct('x', {_RAW}.x, 'y', {_RAW}.y, 'z', {_RAW}.z) END"
    )
    geom = F.expr(
        f"CASE WHEN {_RAW}.kind IS NOT NULL THEN named_struct("
        f"'gtype', {_RAW}.dims * 1000 + {_case(SHAPE_OF_KIND, f'{_RAW}.kind')},"
        f" 'srid', {int(srid)}, 'point', {point},"
        f" 'elem_info', {_RAW}.elem_info, 'ordinates', {ordinates}) END"
    )
    columns = {out: geom}
    if reason:
        columns[reason] = F.when(F.col(column).isNotNull(), F.col(f"{_RAW}.reason"))
    return known.withColumns(columns).drop(_RAW)


def geometry_errors(df: DataFrame, column: str) -> DataFrame:
    """How many values of a WKB column are refused, per reason."""
    read = decode_geometry(df.select(column), column, srid=0, out="__geom", reason="reason")
    return read.where(F.col("reason").isNotNull()).groupBy("reason").agg(F.count("*").alias("n"))


def geometry_facts(df: DataFrame, column: str) -> DataFrame:
    geom = F.col(column)
    return df.withColumns(
        {
            "dims": G.dims(geom),
            "lrs": G.lrs_dimension(geom),
            "shape": G.shape(geom),
            "is_point": G.is_point(geom),
        }
    )


def _with_elements(df: DataFrame, column: str) -> DataFrame:
    """Adds the facts that decide how an object is read, and its element triplets.

    Triplets are made for polygons and multi lines and polygons only, and not for those
    of one straight part, which needs no looking through (``single``).
    """
    geom = G._quoted(column)
    count = f"coalesce(size({geom}.ordinates), 0)"
    shape = f"({geom}.gtype % 100)"
    facts = (
        f"named_struct('dims', int({geom}.gtype div 1000), 'shape', {shape}, 'count', {count},"
        f" 'single', coalesce({geom}.elem_info ="
        f" CASE WHEN {shape} = 6 THEN array(1, 2, 1) WHEN {shape} IN (3, 7) THEN array(1, 1003, 1) END, false))"
    )
    elements = (
        f"CASE WHEN {_FACTS}.shape IN (3, 6, 7) AND NOT {_FACTS}.single THEN {G.elements_sql(geom)}"
        " ELSE array() END"
    )
    return df.withColumn(_FACTS, F.expr(facts)).withColumn(_ELEMENTS, F.expr(elements))


def _bounds(elements: str, count: str) -> str:
    return f"forall({elements}, x -> x.start >= 1 AND x.stop >= x.start AND x.stop <= {count} + 1)"


def _ring_problem(d: str, rings: str) -> str:
    """First reason why an array of ring elements cannot be used, as SQL."""
    return (
        f"WHEN exists({rings}, x -> x.interp NOT IN (1, 2, 3)) THEN 'unsupported_interpretation'"
        f" WHEN exists({rings}, x -> x.interp = 3 AND x.stop - x.start != 2 * {d}) THEN 'bad_rectangle'"
        f" WHEN exists({rings}, x -> (x.stop - x.start) % {d} != 0) THEN 'ordinates_not_divisible'"
    )


def explode_rings(df: DataFrame, column: str, keep: list[str] | None = None) -> DataFrame:
    """One row per polygon ring: number, role, interpretation, ordinates as stored.

    A polygon without usable rings gives one row with a ``reason`` and no ring.
    """
    geom = G._quoted(column)
    keep = [c for c in df.columns if c != column] if keep is None else keep
    dims = f"{_FACTS}.dims"
    whole = (
        f"array(named_struct('start', 1, 'etype', 1003, 'interp', 1, 'stop', {_FACTS}.count + 1))"
    )
    rings = f"CASE WHEN {_FACTS}.single THEN {whole} ELSE filter({_ELEMENTS}, x -> x.etype IN (1003, 2003)) END"
    problem = (
        f"CASE WHEN {_FACTS}.single THEN NULL WHEN coalesce(size({geom}.elem_info), 0) < 3 THEN 'bad_elem_info'"
        f" WHEN NOT {_bounds(_ELEMENTS, f'{_FACTS}.count')} THEN 'element_offsets'"
        f" WHEN size(__rings) = 0 THEN 'no_rings' {_ring_problem(dims, '__rings')} END"
    )
    checked = (
        _with_elements(df.select(*keep, column).where(F.col(column).isNotNull()), column)
        .withColumn("__rings", F.expr(rings))
        .withColumn("reason", F.expr(problem))
    )
    exploded = checked.select(
        *keep, column, _FACTS, "reason",
        F.expr("posexplode_outer(CASE WHEN reason IS NULL THEN __rings END) AS (__no, __ring)"),
    )
    return exploded.select(
        *keep,
        (F.col("__no") + 1).alias("ring_no"),
        (F.col("__ring.etype") == 1003).alias("outer"),
        F.col("__ring.interp").alias("interp"),
        F.col(f"{_FACTS}.dims").alias("dims"),
        F.expr(f"CASE WHEN __ring IS NOT NULL THEN {G.part_sql(geom, '__ring')} END").alias("ordinates"),
        "reason",
    )


def orient_rings(
    rings: DataFrame, ring: str = "ordinates", dims: str | int = "dims", outer: str = "outer"
) -> DataFrame:
    """Rows of rings with the winding their role asks for."""
    return rings.withColumn(ring, G.oriented(ring, dims, outer))


def expand_rectangles(
    rings: DataFrame, ring: str = "ordinates", dims: str | int = "dims", interp: str = "interp"
) -> DataFrame:
    """Rows of rings with two-corner rectangles written out; a wrong corner count gives NULL."""
    return rings.withColumn(
        ring, F.when(F.col(interp) == 3, G.rectangle(ring, dims)).otherwise(F.col(ring))
    )


def linearise(
    rings: DataFrame, ring: str = "ordinates", dims: str | int = "dims", interp: str = "interp"
) -> DataFrame:
    """Rows of rings or lines with their arcs replaced by straight segments."""
    return rings.withColumn(
        ring, F.when(F.col(interp) == 2, G.linearised(ring, dims)).otherwise(F.col(ring))
    )


def encode_geometry(
    df: DataFrame, column: str, out: str | None = None, reason: str | None = None
) -> DataFrame:
    """Geometry objects to little-endian WKB; what has no WKB form becomes NULL.

    Checks, rectangles and arcs are expressions; the kernel only lays out bytes.
    """
    if not G.is_geometry_object(_field(df, column).dataType):
        raise InvalidArgument(f"column {column!r} does not hold geometry objects")
    out = out or column
    geom = G._quoted(column)
    d, s, e, single = f"{_FACTS}.dims", f"{_FACTS}.shape", _ELEMENTS, f"{_FACTS}.single"
    wanted = f"x -> CASE WHEN {s} = 6 THEN x.etype = 2 ELSE x.etype IN (1003, 2003) END"
    parts = (
        _with_elements(df, column)
        .withColumn("__all", F.col(e))
        .withColumn(e, F.expr(f"CASE WHEN size({e}) > 0 THEN filter({e}, {wanted}) ELSE {e} END"))
    )
    in_point = f"({s} = 1 AND coalesce(size({geom}.elem_info), 0) = 0 AND {_FACTS}.count = 0)"
    problem = (
        f"CASE WHEN {geom} IS NULL THEN NULL"
        f" WHEN {geom}.gtype IS NULL OR {d} NOT IN (2, 3) THEN 'unsupported_dimensions'"
        f" WHEN {s} = 4 THEN 'collection_unsupported'"
        f" WHEN {s} NOT BETWEEN 1 AND 7 THEN 'unsupported_type'"
        f" WHEN {s} = 1 AND NOT ({in_point} AND {geom}.point.x IS NOT NULL AND {geom}.point.y IS NOT NULL)"
        f" AND {_FACTS}.count < {d} THEN 'too_few_ordinates'"
        f" WHEN ({s} = 2 OR {single}) AND {_FACTS}.count % {d} != 0 THEN 'ordinates_not_divisible'"
        f" WHEN {s} IN (1, 2, 5) OR {single} THEN NULL"
        f" WHEN coalesce(size({geom}.elem_info), 0) < 3 THEN 'bad_elem_info'"
        f" WHEN NOT {_bounds('__all', f'{_FACTS}.count')} THEN 'element_offsets'"
        f" WHEN {s} = 3 AND size({e}) = 0 THEN 'no_rings'"
        f" WHEN {s} = 6 AND exists({e}, x -> (x.stop - x.start) % {d} != 0) THEN 'ordinates_not_divisible'"
        f" WHEN {s} = 7 AND size({e}) > 0 AND get({e}, 0).etype != 1003 THEN 'orphan_hole'"
        f" WHEN {s} = 6 THEN NULL {_ring_problem(d, e)} END"
    )
    curved_line = f"{s} = 2 AND coalesce(get({geom}.elem_info, 2), 1) = 2"
    # Parts that already lie in the array one after the other are passed on untouched.
    untouched = (
        f"(size({e}) = size(__all) AND get({e}, 0).start = 1"
        f" AND ({s} = 6 OR NOT exists({e}, x -> x.interp != 1)))"
    )
    rebuilt = f"transform({e}, x -> {G.straight_part_sql(geom, 'x', d)})"
    plain = f"transform({e}, x -> {G.part_sql(geom, 'x')})"
    point = (
        f"CASE WHEN {in_point} THEN CASE WHEN {d} = 3 THEN"
        f" array({geom}.point.x, {geom}.point.y, coalesce({geom}.point.z, 0D))"
        f" ELSE array({geom}.point.x, {geom}.point.y) END"
        f" ELSE slice({geom}.ordinates, 1, {d}) END"
    )
    used = parts.withColumn("__problem", F.expr(problem)).withColumn(
        "__parts",
        F.expr(
            f"CASE WHEN __problem IS NOT NULL OR {single} OR {s} = 5 THEN NULL"
            f" WHEN {s} = 1 THEN array({point})"
            f" WHEN {curved_line} THEN array({G.linearised_sql(f'{geom}.ordinates', d)})"
            f" WHEN {s} = 2 OR {untouched} THEN NULL"
            f" WHEN {s} = 6 THEN {plain}"
            f" WHEN size({e}) > 0 THEN {rebuilt} END"
        ),
    )
    sizes = (
        "CASE WHEN __problem IS NOT NULL THEN NULL"
        " WHEN __parts IS NOT NULL THEN transform(__parts, p -> size(p))"
        f" WHEN {s} = 2 OR {single} THEN array({_FACTS}.count)"
        f" WHEN {s} = 5 THEN array_repeat({d}, int({_FACTS}.count div {d}))"
        f" ELSE transform({e}, x -> x.stop - x.start) END"
    )
    flat = (
        "CASE WHEN __problem IS NOT NULL THEN NULL"
        " WHEN __parts IS NOT NULL THEN flatten(__parts)"
        f" WHEN {s} = 5 THEN slice({geom}.ordinates, 1, int({_FACTS}.count div {d} * {d}))"
        f" ELSE {geom}.ordinates END"
    )
    opens = (
        f"CASE WHEN __problem IS NOT NULL OR {s} != 7 THEN cast(array() AS array<boolean>)"
        f" WHEN {single} THEN array(true) ELSE transform({e}, x -> x.etype = 1003) END"
    )
    kind = f"CASE WHEN {geom} IS NOT NULL AND __problem IS NULL THEN " + _case(
        {shape: kind for kind, shape in SHAPE_OF_KIND.items()}, s
    ) + " END"
    packed = pack_wkb(
        F.expr(kind).cast("int"), F.expr(d),
        F.expr(sizes).cast("array<int>"), F.expr(opens), F.expr(flat),
    )
    columns = {out: packed}
    if reason:
        columns[reason] = F.col("__problem")
    return used.withColumns(columns).drop(e, _FACTS, "__all", "__problem", "__parts")


def explode_vertices(df: DataFrame, column: str, keep: list[str] | None = None) -> DataFrame:
    """One row per vertex: number, x, y and z of every geometry."""
    geom = G._quoted(column)
    keep = [c for c in df.columns if c != column] if keep is None else keep
    d = f"({geom}.gtype div 1000)"
    at = lambda axis: f"get({geom}.ordinates, int(v * {d} + {axis}))"
    point = f"array(named_struct('x', {geom}.point.x, 'y', {geom}.point.y, 'z', {geom}.point.z))"
    count = f"int(coalesce(size({geom}.ordinates), 0) div {d})"
    listed = (
        f"CASE WHEN {count} = 0 THEN NULL ELSE transform(sequence(0, {count} - 1), v -> named_struct("
        f"'x', {at(0)}, 'y', {at(1)}, 'z', CASE WHEN {d} >= 3 THEN {at(2)} END)) END"
    )
    vertices = df.select(
        *keep,
        F.posexplode(F.when(G.is_point(F.col(column)), F.expr(point)).otherwise(F.expr(listed))).alias(
            "__no", "__v"
        ),
    )
    return vertices.select(
        *keep, (F.col("__no") + 1).alias("vertex_no"),
        F.col("__v.x").alias("x"), F.col("__v.y").alias("y"), F.col("__v.z").alias("z"),
    )


def vertex_count(df: DataFrame, column: str, out: str = "vertices") -> DataFrame:
    return df.withColumn(out, G.vertex_count(F.col(column)))


def geometry_report(df: DataFrame, column: str) -> DataFrame:
    """Counts per rule this package enforces; a clean table gives zero for each rule."""
    prepared = df.select(F.col(column).alias("__geom")).where(F.col("__geom").isNotNull())
    encoded = encode_geometry(prepared, "__geom", out="__wkb", reason="__reason")
    e = "__rings"
    checked = encoded.withColumn(
        e,
        F.expr(
            "CASE WHEN __reason IS NULL AND __geom.gtype % 100 IN (3, 7) THEN "
            f"filter({G.elements_sql('__geom')}, x -> x.etype IN (1003, 2003) AND x.interp = 1) END"
        ),
    )
    area = G.let(G.part_sql("__geom", "x"), "ring", G.ring_area_sql("ring", "int(__geom.gtype div 1000)"))
    winding = G.let(area, "area2", "area2 != 0 AND (area2 > 0) != (x.etype = 1003)")
    rule = F.expr(
        "CASE WHEN __reason IS NOT NULL THEN concat('not_encodable:', __reason)"
        f" WHEN exists({e}, x -> x.stop > x.start AND {winding}) THEN 'winding' ELSE 'valid' END"
    )
    return checked.groupBy(rule.alias("rule")).agg(F.count("*").alias("n"))
