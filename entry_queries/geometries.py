"""E rows: geometry columns, coded, wound, expanded and checked."""

from pyspark.sql import functions as F

from tableferry import (
    decode_geometry, encode_geometry, expand_rectangles, explode_rings, explode_vertices,
    geometry_errors, geometry_facts, geometry_report, linearise, orient_rings, run_query,
    srid_of, vertex_count,
)

from .common import read
from .shapes import (
    POINT_X_SQL, POINT_Y_SQL, POINT_Z_SQL, SHAPES, VECTORS, event_points, geometry, wkb_oracle,
)

QUERIES = {}

# --- reference systems and facts -------------------------------------------------------

CRS_FORMS = (
    '{{"crs":"EPSG:{n}"}}', '{{"crs":"epsg:{n}"}}', '{{"crs":{{"id":{{"authority":"EPSG","code":{n}}}}}}}',
    '{{"crs":{{"id":{{"authority":"epsg","code":{n}}}}}}}', '{{"crs":{{"id":{{"authority":"ESRI","code":{n}}}}}}}',
    '{{"crs":"OGC:CRS84"}}', '{{"crs":null}}', '{{}}', '', 'not json {n}', '{{"crs":"EPSG:0"}}',
    '{{"columns":{{"geom":{{"crs":"EPSG:{n}"}}}}}}',
)


def _crs_text(text):
    picked = " ".join(
        f"WHEN {i} THEN '{form.format(n='#')}'" for i, form in enumerate(CRS_FORMS)
    )
    return f"replace(CASE c_custkey % {len(CRS_FORMS) + 1} {picked} END, '#', CAST(2000 + c_custkey AS {text}))"


QUERIES["e3_srid"] = (
    lambda spark, sf_dir: read(spark, sf_dir, "customer").select(
        "c_custkey", srid_of(F.expr(_crs_text("STRING"))).alias("srid")
    ),
    f"""SELECT c_custkey, CASE WHEN c_custkey % {len(CRS_FORMS) + 1} < 4 THEN 2000 + c_custkey ELSE 4326 END AS srid
        FROM customer""",
)


def facts(spark, sf_dir):
    gtype = "int(1000 * (2 + event_id % 3) + 100 * (event_id % 4) + 1 + event_id % 7)"
    some = "if(event_id % 2 = 0, array(), array(1, 2, 1))"
    numbers = "if(event_id % 5 = 0, NULL, if(event_id % 2 = 0, array(), array(value, value)))"
    objects = read(spark, sf_dir, "events").select(
        "event_id", geometry(gtype, "0", info=some, ordinates=numbers).alias("geom")
    )
    return geometry_facts(objects, "geom").drop("geom")


QUERIES["e4_facts"] = (
    facts,
    """SELECT event_id, CAST(2 + event_id % 3 AS INT) AS dims, CAST(event_id % 4 AS INT) AS lrs, CAST(1 + event_id % 7 AS INT) AS shape,
       event_id % 7 = 0 AND event_id % 2 = 0 AS is_point FROM events""",
)

# --- bytes to objects and back ----------------------------------------------------------


def decoded(spark, sf_dir, shape):
    """Objects of a shape, through their bytes."""
    encoded = encode_geometry(SHAPES[shape](spark, sf_dir), "geom")
    return decode_geometry(encoded, "geom", srid=3857)


def decoded_points(spark, sf_dir):
    points = event_points(spark, sf_dir)
    for name in ("geom", "geom3"):
        points = decode_geometry(encode_geometry(points, name), name, srid=4326)
    return points.select(
        "event_id", F.col("geom.gtype").alias("gtype"), F.col("geom.srid").alias("srid"),
        F.col("geom.point.x").alias("x"), F.col("geom.point.y").alias("y"),
        F.col("geom3.gtype").alias("gtype3"), F.col("geom3.point.z").alias("z"),
        F.size("geom.ordinates").alias("n_ordinates"),
    )


QUERIES["e5a_decode_points"] = (
    decoded_points,
    f"""SELECT event_id, 2001 AS gtype, 4326 AS srid, {POINT_X_SQL} AS x, {POINT_Y_SQL} AS y, 3001 AS gtype3,
        {POINT_Z_SQL} AS z, 0 AS n_ordinates FROM events""",
)


def encoded_points(spark, sf_dir):
    points = event_points(spark, sf_dir)
    for name in ("geom", "geom3"):
        points = encode_geometry(points, name)
    return points.select("event_id", F.hex("geom").alias("flat"), F.hex("geom3").alias("high"))


def _point_text(z):
    third = f" || ' ' || {POINT_Z_SQL}" if z else ""
    return f"'POINT {'Z ' if z else ''}(' || {POINT_X_SQL} || ' ' || {POINT_Y_SQL}{third} || ')'"


QUERIES["e8a_encode_points"] = (
    encoded_points,
    f"""SELECT event_id, hex(ST_AsWKB(CAST({_point_text(False)} AS GEOMETRY))) AS flat,
        hex(ST_AsWKB(CAST({_point_text(True)} AS GEOMETRY))) AS high FROM events""",
)

# DuckDB: a flat ring, its doubled area, and the ring wound as its role asks.
_slice = lambda start: f"(list_slice(n, {start + 1}, {start + 16}) || list_slice(n, {start + 1}, {start + 2}))"
_whole = "(n || list_slice(n, 1, 2))"
_area = lambda r: f"list_sum(list_transform(range(1, len({r}) - 2, 2), lambda i: {r}[i] * {r}[i + 3] - {r}[i + 2] * {r}[i + 1]))"
_turn = lambda r: f"flatten(list_transform(range(len({r}) // 2 - 1, -1, -1), lambda k: [{r}[2 * k + 1], {r}[2 * k + 2]]))"
_wound = lambda r, sign: f"CASE WHEN {_area(r)} {sign} 0 THEN {_turn(r)} ELSE {r} END"
_outer = lambda r: _wound(r, "<")
_hole = lambda r: _wound(r, ">")


def vertex_sql(flat, step=2, z="CAST(NULL AS DOUBLE)"):
    return f"""SELECT vec_id, CAST((i - 1) // {step} + 1 AS INT) AS vertex_no, o[i] AS x, o[i + 1] AS y, {z} AS z
        FROM (SELECT vec_id, o, unnest(range(1, len(o) + 1, {step})) AS i FROM (SELECT vec_id, {flat} AS o FROM {VECTORS}) q) r"""


for _name, _key, _sql in (
    ("line", "e5b_decode_lines", vertex_sql("n")),
    ("line3", "e5b_decode_lines_3d", vertex_sql("(n || list_slice(n, 1, 2))", 3, "o[i + 2]")),
    ("polygon", "e5c_decode_polygons", vertex_sql(_outer(_whole))),
    ("holed", "e5c_decode_holes", vertex_sql(" || ".join([f"({_outer(_slice(0))})"] + [f"({_hole(_slice(s))})" for s in (16, 32, 48)]))),
    ("points", "e5d_decode_multi_points", vertex_sql("n")),
    ("lines", "e5d_decode_multi_lines", vertex_sql("n")),
    ("polygons", "e5d_decode_multi_polygons",
     vertex_sql(" || ".join(f"({turned(_slice(s))})" for s, turned in ((0, _outer), (16, _hole), (32, _outer), (48, _hole))))),
):
    QUERIES[_key] = (
        lambda spark, sf_dir, shape=_name: explode_vertices(decoded(spark, sf_dir, shape), "geom", ["vec_id"]), _sql
    )

for _name, _key in (
    ("line", "e8b_encode_lines"), ("line3", "e8b_encode_lines_3d"), ("polygon", "e8c_encode_polygons"),
    ("holed", "e8c_encode_holes"), ("points", "e8d_encode_multi_points"), ("lines", "e8e_encode_multi_lines"),
    ("polygons", "e8f_encode_multi_polygons"),
):
    QUERIES[_key] = (
        lambda spark, sf_dir, shape=_name: encode_geometry(SHAPES[shape](spark, sf_dir), "geom").select(
            "vec_id", F.hex("geom").alias("wkb")
        ),
        wkb_oracle(_name),
    )

# --- values that are refused ------------------------------------------------------------

# By vec_id: how the bytes of a multi line are spoilt, and the reason that must follow.
SPOILT = (
    ("substring(geom, 1, 4)", "too_short"), ("concat(unhex('07'), substring(geom, 2))", "bad_byte_order"),
    ("concat(unhex('0163000000'), substring(geom, 6))", "unsupported_type"),
    ("substring(geom, 1, length(geom) - 8)", "count_exceeds_bytes"), ("substring(geom, 1, 9)", "truncated"),
    ("concat(unhex('0101000020'), substring(geom, 6))", "unsupported_type"), ("geom", None), ("NULL", None),
)


def spoilt(spark, sf_dir):
    encoded = encode_geometry(SHAPES["lines"](spark, sf_dir), "geom")
    chosen = " ".join(f"WHEN {i} THEN {text}" for i, (text, _) in enumerate(SPOILT))
    return encoded.withColumn("geom", F.expr(f"CASE vec_id % {len(SPOILT)} {chosen} END"))


_REASON_SQL = "CASE vec_id % 8 " + " ".join(f"WHEN {i} THEN '{r}'" for i, (_, r) in enumerate(SPOILT) if r) + " END"
QUERIES["e7_errors"] = (
    lambda spark, sf_dir: geometry_errors(spoilt(spark, sf_dir), "geom"),
    f"SELECT {_REASON_SQL} AS reason, count(*) AS n FROM embeddings WHERE vec_id % 8 < 6 GROUP BY reason",
)

# By vec_id: objects without a WKB form (SQL of gtype, triplets, ordinates), and the reason.
WITHOUT_WKB = (
    ("4002", "array(1, 2, 1)", "n", "unsupported_dimensions"), ("2004", "array(1, 2, 1)", "n", "collection_unsupported"),
    ("2008", "array(1, 2, 1)", "n", "unsupported_type"), ("2001", "array(1, 1, 1)", "array(1D)", "too_few_ordinates"),
    ("2002", "array(1, 2, 1)", "slice(n, 1, 7)", "ordinates_not_divisible"), ("2003", "array()", "n", "bad_elem_info"),
    ("2003", "array(99, 1003, 1)", "n", "element_offsets"), ("2003", "array(1, 1005, 2)", "n", "no_rings"),
    ("2003", "array(1, 1003, 4)", "n", "unsupported_interpretation"), ("2003", "array(1, 1003, 3)", "n", "bad_rectangle"),
    ("2007", "array(1, 2003, 1)", "n", "orphan_hole"), ("2002", "array(1, 2, 1)", "n", None),
)


def without_wkb(spark, sf_dir):
    numbers = read(spark, sf_dir, "embeddings").selectExpr("vec_id", "transform(embedding, v -> double(v)) AS n")
    pick = lambda i: f"CASE vec_id % {len(WITHOUT_WKB)} " + " ".join(
        f"WHEN {k} THEN {case[i]}" for k, case in enumerate(WITHOUT_WKB)) + " END"
    objects = numbers.select("vec_id", geometry(pick(0), "0", info=pick(1), ordinates=pick(2)).alias("geom"))
    encoded = encode_geometry(objects, "geom", out="wkb", reason="reason")
    return encoded.select("vec_id", F.col("wkb").isNull().alias("missing"), "reason")


_WITHOUT_SQL = f"CASE vec_id % {len(WITHOUT_WKB)} " + " ".join(
    f"WHEN {i} THEN '{case[3]}'" for i, case in enumerate(WITHOUT_WKB) if case[3]) + " END"
QUERIES["e8g_without_wkb"] = (
    without_wkb,
    f"SELECT vec_id, vec_id % {len(WITHOUT_WKB)} <> {len(WITHOUT_WKB) - 1} AS missing, {_WITHOUT_SQL} AS reason FROM embeddings",
)


def null_on_failure(spark, sf_dir):
    read_in = decode_geometry(spoilt(spark, sf_dir), "geom", out="object", reason="reason")
    return read_in.select("vec_id", F.col("object").isNull().alias("missing"), "reason")


QUERIES["e12_null_on_failure"] = (
    null_on_failure,
    f"SELECT vec_id, vec_id % 8 <> 6 AS missing, {_REASON_SQL} AS reason FROM embeddings",
)

# --- rings ------------------------------------------------------------------------------


def ring_rows(spark, sf_dir):
    return explode_rings(SHAPES["polygons"](spark, sf_dir), "geom", ["vec_id"])


QUERIES["e9_rings"] = (
    lambda spark, sf_dir: ring_rows(spark, sf_dir).select(
        "vec_id", "ring_no", "outer", "interp", "dims", "reason", F.posexplode("ordinates").alias("i", "v"),
    ),
    f"""SELECT vec_id, CAST(k + 1 AS INT) AS ring_no, k % 2 = 0 AS "outer", 1 AS interp, 2 AS dims, CAST(NULL AS VARCHAR) AS reason,
        CAST(j AS INT) AS i, n[16 * k + j % 16 + 1] AS v
        FROM (SELECT vec_id, n, k, unnest(range(18)) AS j FROM (SELECT vec_id, n, unnest(range(4)) AS k FROM {VECTORS}) r) q""",
)
QUERIES["e6_orient_rings"] = (
    lambda spark, sf_dir: orient_rings(ring_rows(spark, sf_dir)).select(
        "vec_id", "ring_no", F.posexplode("ordinates").alias("i", "v")
    ),
    f"""SELECT vec_id, ring_no, CAST(j - 1 AS INT) AS i, o[j] AS v
        FROM (SELECT vec_id, ring_no, o, unnest(range(1, 19)) AS j FROM (
            SELECT vec_id, CAST(k + 1 AS INT) AS ring_no,
                   CASE WHEN k % 2 = 0 THEN {_outer('ring')} ELSE {_hole('ring')} END AS o
            FROM (SELECT vec_id, k, list_slice(n, 16 * k + 1, 16 * k + 16) || list_slice(n, 16 * k + 1, 16 * k + 2) AS ring
                  FROM (SELECT vec_id, n, unnest(range(4)) AS k FROM {VECTORS}) a) b) c) d""",
)


def rectangles(spark, sf_dir):
    corners = "array(double(l_linenumber), l_quantity, double(l_linenumber + 1), l_quantity + l_discount + 1)"
    return read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", geometry("2003", "0", info="array(1, 1003, 3)", ordinates=corners).alias("geom")
    )


_CORNERS = ("CAST(l_linenumber AS DOUBLE)", "l_quantity", "CAST(l_linenumber + 1 AS DOUBLE)", "l_quantity + l_discount + 1")
_PATH = (0, 1, 2, 1, 2, 3, 0, 3, 0, 1)
QUERIES["e10_rectangles"] = (
    lambda spark, sf_dir: expand_rectangles(
        explode_rings(rectangles(spark, sf_dir), "geom", ["l_orderkey", "l_linenumber"])
    ).select("l_orderkey", "l_linenumber", *[F.get("ordinates", F.lit(i)).alias(f"o{i}") for i in range(10)]),
    "SELECT l_orderkey, l_linenumber, " + ", ".join(f"{_CORNERS[c]} AS o{i}" for i, c in enumerate(_PATH)) + " FROM lineitem",
)
_RECTANGLE_TEXT = "'POLYGON((' || " + " || ', ' || ".join(
    f"({_CORNERS[_PATH[i]]}) || ' ' || ({_CORNERS[_PATH[i + 1]]})" for i in range(0, 10, 2)) + " || '))'"
QUERIES["e10_encode_rectangles"] = (
    lambda spark, sf_dir: encode_geometry(rectangles(spark, sf_dir), "geom").select(
        "l_orderkey", "l_linenumber", F.hex("geom").alias("wkb")
    ),
    f"SELECT l_orderkey, l_linenumber, hex(ST_AsWKB(CAST({_RECTANGLE_TEXT} AS GEOMETRY))) AS wkb FROM lineitem",
)


def arc_rows(spark, sf_dir):
    """A quarter and a three-quarter circle per part, as three-point arcs."""
    quarter = "array(r, 0D, r * sqrt(0.5D), r * sqrt(0.5D), 0D, r)"
    wide = "array(r, 0D, -r * sqrt(0.5D), r * sqrt(0.5D), 0D, -r)"
    # A small file is one task's, but its arcs are many times larger.
    parts = read(spark, sf_dir, "part").select("p_partkey", "p_size").repartition(4 * spark.sparkContext.defaultParallelism)
    return parts.selectExpr("p_partkey", "double(p_size) AS r").selectExpr(
        "p_partkey", f"stack(2, 'quarter', {quarter}, 'wide', {wide}) AS (arc, ordinates)"
    ).selectExpr("p_partkey", "arc", "ordinates", "2 AS interp", "2 AS dims")


def arcs(spark, sf_dir):
    # An inner explode is planned with a filter that works out the arcs a second time.
    points = linearise(arc_rows(spark, sf_dir)).select("p_partkey", "arc", F.posexplode_outer("ordinates").alias("i", "v"))
    return points.where("i IS NOT NULL").select("p_partkey", "arc", "i", (F.round("v", 6) + F.lit(0.0)).alias("v"))


QUERIES["e11_arcs"] = (
    arcs,
    """SELECT p_partkey, arc, CAST(2 * t + axis AS INT) AS i,
       round(p_size * CASE axis WHEN 0 THEN cos(t * sweep / 32) ELSE sin(t * sweep / 32) END, 6) + 0.0 AS v
       FROM part, (VALUES ('quarter', pi() / 2), ('wide', 3 * pi() / 2)) a(arc, sweep),
            (SELECT unnest(range(33)) AS t) s, (VALUES (0), (1)) x(axis)""",
)


def arc_lines(spark, sf_dir):
    """Arcs inside an object, written out while encoding."""
    objects = arc_rows(spark, sf_dir).select(
        "p_partkey", "arc", geometry("2002", "0", info="array(1, 2, 2)", ordinates="ordinates").alias("geom")
    )
    coded = decode_geometry(encode_geometry(objects, "geom"), "geom", srid=0)
    vertices = explode_vertices(coded, "geom", ["p_partkey", "arc"])
    return vertices.select("p_partkey", "arc", "vertex_no", *[(F.round(c, 6) + F.lit(0.0)).alias(c) for c in ("x", "y")])


QUERIES["e11_encode_arcs"] = (
    arc_lines,
    """SELECT p_partkey, arc, CAST(t + 1 AS INT) AS vertex_no, round(p_size * cos(t * sweep / 32), 6) + 0.0 AS x,
       round(p_size * sin(t * sweep / 32), 6) + 0.0 AS y
       FROM part, (VALUES ('quarter', pi() / 2), ('wide', 3 * pi() / 2)) a(arc, sweep),
            (SELECT unnest(range(33)) AS t) s""",
)

# --- looking into objects ---------------------------------------------------------------

QUERIES["e13_vertices"] = (
    lambda spark, sf_dir: vertex_count(SHAPES["line3"](spark, sf_dir), "geom").select("vec_id", "vertices"),
    "SELECT vec_id, 22 AS vertices FROM embeddings",
)


def field_access(spark, sf_dir):
    SHAPES["holed"](spark, sf_dir).createOrReplaceTempView("holed")
    return run_query(
        spark,
        "SELECT g.vec_id, g.geom.gtype AS gtype, g.geom.srid AS srid, size(g.geom.elem_info) AS n_info,"
        " (SELECT count(*) FROM LATERAL explode(g.geom.ordinates) AS t(v)) AS n_ordinates FROM holed g WHERE g.geom.srid = :1",
        [3857],
    )


QUERIES["e14_field_access"] = (
    field_access, "SELECT vec_id, 2003 AS gtype, 3857 AS srid, 12 AS n_info, CAST(72 AS BIGINT) AS n_ordinates FROM embeddings"
)
QUERIES["e15_report"] = (
    lambda spark, sf_dir: geometry_report(SHAPES["polygons"](spark, sf_dir), "geom"),
    f"""SELECT CASE WHEN {_area(_slice(0))} < 0 OR {_area(_slice(16))} > 0 OR {_area(_slice(32))} < 0 OR {_area(_slice(48))} > 0
        THEN 'winding' ELSE 'valid' END AS rule, count(*) AS n FROM {VECTORS} GROUP BY rule""",
)
