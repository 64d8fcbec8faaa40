"""Geometry columns: bytes, rings, rectangles, arcs, checks."""

import math
import random
import struct

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entry_queries import geometries
from tableferry import (
    crs_metadata, decode_geometry, encode_geometry, expand_rectangles, explode_rings, explode_vertices,
    geometry_columns, geometry_errors, geometry_facts, geometry_report, linearise, orient_rings, srid_of,
    tag_crs, vertex_count,
)
from tableferry.functions.crs import field_srid
from tableferry.functions.geometry import GEOMETRY_TYPE
from tableferry.functions.wkb import pack_batch, unpack_batch

OBJECTS = T.StructType().add("id", T.LongType()).add("g", GEOMETRY_TYPE)
SQUARE = [0.0, 0.0, 1.0, 0.0, 1.0, 1.0, 0.0, 1.0, 0.0, 0.0]
CLOCKWISE = [0.0, 0.0, 0.0, 1.0, 1.0, 1.0, 1.0, 0.0, 0.0, 0.0]


# --- a plain reader and writer, one value at a time, to compare with ---------------------


def write(kind, parts, z=False, order="<"):
    """WKB of nested lists of points: point, line, polygon or a multi of these."""
    code = kind + 1000 * z
    head = struct.pack(order + "BI", order == "<", code)
    points = lambda ps: b"".join(struct.pack(order + "d" * len(p), *p) for p in ps)
    if kind == 1:
        return head + points([parts])
    count = struct.pack(order + "I", len(parts))
    if kind == 2:
        return head + count + points(parts)
    if kind == 3:
        return head + count + b"".join(struct.pack(order + "I", len(r)) + points(r) for r in parts)
    return head + count + b"".join(write(kind - 3, part, z, order) for part in parts)


def rings_of(kind, parts):
    return {2: lambda: [parts], 3: lambda: parts, 4: lambda: [[p] for p in parts], 5: lambda: parts,
            6: lambda: [ring for polygon in parts for ring in polygon]}[kind]()


def random_shape(rng):
    kind, z = rng.randint(1, 6), rng.random() < 0.3
    point = lambda: [rng.uniform(-180, 180) for _ in range(3 if z else 2)]
    line = lambda: [point() for _ in range(rng.randint(0, 6))]
    some = lambda make: [make() for _ in range(rng.randint(1, 4))]
    parts = {1: point, 2: line, 3: lambda: some(line), 4: line, 5: lambda: some(line),
             6: lambda: some(lambda: some(line))}[kind]()
    return kind, z, parts


@pytest.mark.parametrize("order", ["<", ">"])
def test_kernel_reads_what_a_plain_writer_wrote(order):
    rng = random.Random(7)
    shapes = [random_shape(rng) for _ in range(500)]
    batch = pa.array([write(k, p, z, order) for k, z, p in shapes] + [None], pa.binary())
    for (kind, z, parts), row in zip(shapes, unpack_batch(batch).to_pylist()):
        assert (row["reason"], row["kind"], row["dims"]) == (None, kind, 3 if z else 2)
        if kind == 1:
            assert [row["x"], row["y"]] + ([row["z"]] if z else []) == parts and row["ordinates"] == []
            continue
        rings = rings_of(kind, parts)
        assert row["ordinates"] == [v for ring in rings for p in ring for v in p]
        starts, at = [], 1
        for ring in rings:
            starts.append(at)
            at += sum(len(p) for p in ring)
        assert row["elem_info"][::3] == starts


def test_kernel_reads_a_value_alone_as_it_does_among_many():
    rng = random.Random(9)
    shapes = [write(k, p, z, rng.choice("<>")) for k, z, p in (random_shape(rng) for _ in range(300))]
    spoilt = [s[:rng.randint(0, len(s))] for s in shapes] + [
        s[:i] + bytes([rng.randint(0, 255)]) + s[i + 1:] for s in shapes for i in [rng.randrange(len(s))]]
    values = shapes + spoilt
    together = unpack_batch(pa.array(values, pa.binary())).to_pylist()
    alone = [unpack_batch(pa.array([v], pa.binary())).to_pylist()[0] for v in values]
    # repr, because a spoilt byte can make a coordinate that is not equal to itself.
    assert [repr(v) for v in together] == [repr(v) for v in alone]
    assert {v["reason"] for v in alone} >= {None, "truncated", "too_short", "count_exceeds_bytes", "unsupported_type"}


def test_kernel_writes_what_a_plain_writer_writes():
    rng = random.Random(8)
    shapes = [random_shape(rng) for _ in range(500)]
    sizes, opens, flat = [], [], []
    for kind, z, parts in shapes:
        rings = [[parts]] if kind == 1 else rings_of(kind, parts)
        sizes.append([sum(len(p) for p in ring) for ring in rings])
        opens.append([i == 0 for polygon in parts for i in range(len(polygon))] if kind == 6 else [])
        flat.append([v for ring in rings for p in ring for v in p])
    column = lambda values, kind: pa.array(values, kind)
    packed = pack_batch(
        column([k for k, _, _ in shapes] + [None], pa.int32()), column([3 if z else 2 for _, z, _ in shapes] + [None], pa.int32()),
        column(sizes + [None], pa.list_(pa.int32())), column(opens + [[]], pa.list_(pa.bool_())), column(flat + [None], pa.list_(pa.float64())),
    )
    assert packed.to_pylist() == [write(k, p, z) for k, z, p in shapes] + [None]


def test_every_cut_is_refused_and_never_read_past_the_end():
    whole = write(6, [[[[0.0, 0.0]] * 4, [[1.0, 1.0]] * 4], [[[2.0, 2.0]] * 4]])
    cuts = pa.array([whole[:n] for n in range(len(whole))], pa.binary())
    assert all(row["reason"] for row in unpack_batch(cuts).to_pylist())
    assert unpack_batch(pa.array([whole + b"more"], pa.binary())).to_pylist()[0]["reason"] is None


CORRUPT = {
    "line claims a million points": (struct.pack("<BII", 1, 2, 1_048_576) + bytes(8), "count_exceeds_bytes"),
    "ring claims four billion points": (struct.pack("<BIII", 1, 3, 1, 4_294_967_295), "count_exceeds_bytes"),
    "four billion rings": (struct.pack("<BII", 1, 3, 4_294_967_295), "truncated"),
    "part claims points it lacks": (struct.pack("<BII", 1, 5, 1) + struct.pack("<BII", 1, 2, 100), "count_exceeds_bytes"),
    "collection": (struct.pack("<BII", 1, 7, 0), "unsupported_type"),
    "measured point": (struct.pack("<BI3d", 1, 2001, 1, 2, 3), "unsupported_type"),
    "flagged point": (struct.pack("<BI3d", 1, 0x80000001, 1, 2, 3), "unsupported_type"),
    "part of unknown type": (struct.pack("<BII", 1, 4, 1) + struct.pack("<BI", 1, 4), "unsupported_type"),
    "byte order": (b"\x02" + bytes(20), "bad_byte_order"), "empty": (b"", "too_short"),
    "short point": (struct.pack("<BId", 1, 1, 1.0), "truncated"),
}


@pytest.mark.parametrize("name", CORRUPT)
def test_corrupt_values(name):
    value, reason = CORRUPT[name]
    assert unpack_batch(pa.array([value], pa.binary())).to_pylist()[0]["reason"] == reason


def objects(spark, *geometries):
    return spark.createDataFrame(list(enumerate(geometries)), OBJECTS)


def shape(gtype, info=(), ordinates=(), point=None, srid=4326):
    return (gtype, srid, point, list(info), [float(v) for v in ordinates])


def coded(spark, *geometries):
    rows = encode_geometry(objects(spark, *geometries), "g", out="w", reason="why").orderBy("id").collect()
    return [(None if r.w is None else bytes(r.w), r.why) for r in rows]


def test_encoding(spark):
    two = SQUARE + [5.0, 5.0, 6.0, 5.0, 6.0, 6.0, 5.0, 6.0, 5.0, 5.0]
    pairs = lambda flat, d=2: [flat[i:i + d] for i in range(0, len(flat), d)]
    cases = [
        (shape(2001, point=(-73.935242, 40.73061, None)), write(1, [-73.935242, 40.73061])),
        (shape(3001, point=(1.0, 2.0, 3.0)), write(1, [1.0, 2.0, 3.0], True)),
        (shape(3001, point=(1.0, 2.0, None)), write(1, [1.0, 2.0, 0.0], True)),
        (shape(2001, [1, 1, 1], [7, 8, 9]), write(1, [7.0, 8.0])),
        (shape(2002, [1, 2, 1], [0, 0, 1, 1, 2, 0]), write(2, [[0.0, 0.0], [1.0, 1.0], [2.0, 0.0]])),
        (shape(2003, [1, 1003, 1], SQUARE), write(3, [pairs(SQUARE)])),
        (shape(2003, [1, 1003, 3], [0, 0, 10, 20]), write(3, [[[0.0, 0.0], [10.0, 0.0], [10.0, 20.0], [0.0, 20.0], [0.0, 0.0]]])),
        (shape(3003, [1, 1003, 3], [0, 0, 5, 1, 1, 9]), write(3, [[[0.0, 0.0, 5.0], [1.0, 0.0, 5.0], [1.0, 1.0, 5.0], [0.0, 1.0, 5.0], [0.0, 0.0, 5.0]]], True)),
        (shape(2007, [1, 1003, 1, 11, 1003, 1], two), write(6, [[pairs(SQUARE)], [pairs(two[10:])]])),
        (shape(2007, [1, 1003, 1], SQUARE), write(6, [[pairs(SQUARE)]])),
        (shape(2007, [1, 1003, 3, 5, 2003, 1], [0, 0, 9, 9] + CLOCKWISE),
         write(6, [[[[0.0, 0.0], [9.0, 0.0], [9.0, 9.0], [0.0, 9.0], [0.0, 0.0]], pairs(CLOCKWISE)]])),
        (shape(2003, [1, 1003, 1, 11, 1005, 2, 15, 2003, 1], SQUARE + [9, 9, 9, 9] + CLOCKWISE), write(3, [pairs(SQUARE), pairs(CLOCKWISE)])),
        (shape(2005, [1, 1, 2], [1, 1, 2, 2, 3]), write(4, [[1.0, 1.0], [2.0, 2.0]])),
        (shape(2006, [1, 2, 1, 5, 2, 2], [0, 0, 1, 1, 5, 5, 6, 6]), write(5, [[[0.0, 0.0], [1.0, 1.0]], [[5.0, 5.0], [6.0, 6.0]]])),
        (shape(2006, [1, 2, 1], [0, 0, 1, 1]), write(5, [[[0.0, 0.0], [1.0, 1.0]]])),
        (shape(2002, [1, 2, 1], []), write(2, [])),
        (None, None),
    ]
    assert coded(spark, *[g for g, _ in cases]) == [(w, None) for _, w in cases]


REFUSED = [
    (shape(4002, [1, 2, 1], [1, 2, 3, 4]), "unsupported_dimensions"), (shape(1, [1, 2, 1], [1]), "unsupported_dimensions"),
    (shape(2004, [1, 2, 1], [1, 2]), "collection_unsupported"), (shape(2008), "unsupported_type"),
    (shape(2001, [1, 1, 1], [1]), "too_few_ordinates"), (shape(2001), "too_few_ordinates"),
    (shape(2002, [1, 2, 1], [1, 2, 3]), "ordinates_not_divisible"), (shape(2003, [1, 1003, 1], [1, 2, 3]), "ordinates_not_divisible"),
    (shape(2003, [], SQUARE), "bad_elem_info"), (shape(2003, [99, 1003, 1], SQUARE), "element_offsets"),
    (shape(2003, [0, 1003, 1], SQUARE), "element_offsets"), (shape(2003, [7, 1003, 1, 3, 2003, 1], SQUARE), "element_offsets"),
    (shape(2003, [1, 1005, 1], SQUARE), "no_rings"), (shape(2003, [1, 1003, 4], SQUARE), "unsupported_interpretation"),
    (shape(2003, [1, 1003, 3], SQUARE), "bad_rectangle"), (shape(2007, [1, 2003, 1], SQUARE), "orphan_hole"),
]


def test_what_has_no_wkb_form_is_null_with_a_reason(spark):
    assert coded(spark, *[g for g, _ in REFUSED]) == [(None, reason) for _, reason in REFUSED]


def test_decoding_winds_rings(spark):
    pairs = lambda flat: [flat[i:i + 2] for i in range(0, len(flat), 2)]
    values = [write(3, [pairs(CLOCKWISE)]), write(3, [pairs(SQUARE), pairs(SQUARE)]), write(6, [[pairs(CLOCKWISE), pairs(SQUARE)], [pairs(SQUARE)]]),
              write(3, [pairs(CLOCKWISE)], order=">"), write(3, [[[0.0, 0.0], [1.0, 1.0]]]), write(3, [[[0.0, 0.0], [1.0, 1.0], [2.0, 2.0]]]), b"\x01", None]
    df = spark.createDataFrame([(i, v and bytearray(v)) for i, v in enumerate(values)], "id int, w binary")
    rows = decode_geometry(df, "w", srid=3857, out="g", reason="why").orderBy("id").collect()
    turned = [0.0, 0.0, 1.0, 0.0, 1.0, 1.0, 0.0, 1.0, 0.0, 0.0]
    assert rows[0].g.ordinates == turned and rows[0].g.srid == 3857 and rows[0].g.gtype == 2003
    assert rows[1].g.ordinates == SQUARE + CLOCKWISE and rows[1].g.elem_info == [1, 1003, 1, 11, 2003, 1]
    assert rows[2].g.ordinates == SQUARE + CLOCKWISE + SQUARE and rows[2].g.gtype == 2007
    assert rows[3].g == rows[0].g
    assert rows[4].g.ordinates == [0.0, 0.0, 1.0, 1.0] and rows[5].g.ordinates == [0.0, 0.0, 1.0, 1.0, 2.0, 2.0]
    assert [(rows[i].g, rows[i].why) for i in (6, 7)] == [(None, "too_short"), (None, None)]
    assert dict(geometry_errors(df, "w").collect()) == {"too_short": 1}


def test_decoding_anything_but_bytes_is_null(spark):
    df = spark.createDataFrame([("x",)], "geom string")
    assert decode_geometry(df, "geom").first().geom is None


def test_unclosed_rings_are_judged_with_their_closing_edge(spark):
    # Without the edge back to the start this clockwise ring would seem counter-clockwise.
    ring = [10.0, 10.0, 10.0, 11.0, 11.0, 11.0, 11.0, 10.0]
    df = spark.createDataFrame([(ring, True, 2), (ring, False, 2)], "ordinates array<double>, outer boolean, dims int")
    done = [r.ordinates for r in orient_rings(df).collect()]
    assert done == [[11.0, 10.0, 11.0, 11.0, 10.0, 11.0, 10.0, 10.0], ring]


def test_turning_keeps_whole_points_in_three_dimensions(spark):
    ring = [0.0, 0.0, 1.0, 0.0, 1.0, 2.0, 1.0, 1.0, 3.0, 1.0, 0.0, 4.0, 0.0, 0.0, 1.0]
    df = spark.createDataFrame([(ring, True, 3)], "ordinates array<double>, outer boolean, dims int")
    assert orient_rings(df).first().ordinates == [0.0, 0.0, 1.0, 1.0, 0.0, 4.0, 1.0, 1.0, 3.0, 0.0, 1.0, 2.0, 0.0, 0.0, 1.0]


def test_rings_of_objects(spark):
    df = objects(spark, shape(2003, [1, 1003, 1, 11, 2003, 3], SQUARE + [0, 0, 1, 1]), shape(2003, [1, 1005, 1], SQUARE), None)
    rows = explode_rings(df, "g").orderBy("id", "ring_no").collect()
    assert [(r.id, r.ring_no, r.outer, r.interp, r.ordinates, r.reason) for r in rows] == [
        (0, 1, True, 1, SQUARE, None), (0, 2, False, 3, [0.0, 0.0, 1.0, 1.0], None), (1, None, None, None, None, "no_rings")]
    others = objects(spark, shape(2002, [1, 2, 1], [0, 0, 1, 1]), shape(2001, point=(1.0, 2.0, None)), shape(2003, [1, 1003, 1], SQUARE))
    assert [r.reason for r in explode_rings(others, "g").orderBy("id").collect()] == ["no_rings", "bad_elem_info", None]
    expanded = expand_rectangles(explode_rings(df, "g")).where("interp = 3").first()
    assert expanded.ordinates == [0.0, 0.0, 1.0, 0.0, 1.0, 1.0, 0.0, 1.0, 0.0, 0.0]


def arc(spark, ordinates, dims=2):
    df = spark.createDataFrame([([float(v) for v in ordinates], dims, 2)], "ordinates array<double>, dims int, interp int")
    flat = linearise(df).first().ordinates
    return [flat[i:i + dims] for i in range(0, len(flat), dims)]


def close(points, expected):
    assert len(points) == len(expected)
    for a, b in zip(points, expected):
        assert a == pytest.approx(b, abs=1e-9)


HALF = math.sqrt(0.5)
circle = lambda start, sweep, steps=range(33): [[math.cos(start + t * sweep / 32), math.sin(start + t * sweep / 32)] for t in steps]


def test_arcs(spark):
    close(arc(spark, [1, 0, HALF, HALF, 0, 1]), circle(0, math.pi / 2))
    close(arc(spark, [0, 1, HALF, HALF, 1, 0]), circle(math.pi / 2, -math.pi / 2))
    # More than half a turn, in both directions: the sweep passes the middle point.
    close(arc(spark, [1, 0, -HALF, HALF, 0, -1]), circle(0, 3 * math.pi / 2))
    close(arc(spark, [0, -1, -HALF, HALF, 1, 0]), circle(-math.pi / 2, -3 * math.pi / 2))
    # Two joined arcs share their end, which appears once.
    close(arc(spark, [1, 0, 0, 1, -1, 0, 0, -1, 1, 0]), circle(0, math.pi) + circle(math.pi, math.pi, range(1, 33)))
    # Straight, too short, closed on itself.
    close(arc(spark, [0, 0, 1, 1, 2, 2]), [[0, 0], [1, 1], [2, 2]])
    close(arc(spark, [0, 0, 1, 1]), [[0, 0], [1, 1]])
    close(arc(spark, [0, 0, 1, 1, 0, 0]), [[0, 0], [1, 1], [0, 0]])
    # The height of an arc is that of its start.
    high = arc(spark, [1, 0, 7, HALF, HALF, 8, 0, 1, 9], 3)
    assert {p[2] for p in high} == {7.0} and len(high) == 33


def test_arcs_of_a_small_file_are_worked_out_once_and_by_many_tasks(spark, tiny):
    for query in (geometries.arcs, geometries.arc_lines):
        frame = query(spark, tiny)
        assert frame.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    plan = geometries.arcs(spark, tiny)._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "Filter" in line and "CASE WHEN" in line]
    # Nothing and empty rings still give no rows.
    rings = spark.createDataFrame([([], 2, 2), (None, 2, 2), ([0.0, 0.0, 1.0, 1.0, 2.0, None], 2, 1)], "ordinates array<double>, dims int, interp int")
    assert [r.ordinates for r in linearise(rings).collect()] == [[], None, [0.0, 0.0, 1.0, 1.0, 2.0, None]]


def test_arcs_in_objects_are_written_out(spark):
    (line, _), (ring, _), (multi, _) = coded(
        spark, shape(2002, [1, 2, 2], [1, 0, HALF, HALF, 0, 1]), shape(2003, [1, 1003, 2], [1, 0, 0, 1, -1, 0, 0, -1, 1, 0]),
        shape(2006, [1, 2, 2], [1, 0, HALF, HALF, 0, 1]))
    assert struct.unpack("<BII", line[:9]) == (1, 2, 33)
    assert struct.unpack("<BIII", ring[:13]) == (1, 3, 1, 65)
    # Parts of a multi line keep their three points.
    assert struct.unpack("<BII", multi[9:18]) == (1, 2, 3)


def test_facts_counts_and_vertices(spark):
    df = objects(spark, shape(2001, point=(1.0, 2.0, None)), shape(3302, [1, 2, 1], [1, 2, 3, 4, 5, 6]), shape(2001, [1, 1, 1], [1, 2]), shape(2002))
    facts = geometry_facts(df, "g").orderBy("id").collect()
    assert [(r.dims, r.lrs, r["shape"], r.is_point) for r in facts] == [(2, 0, 1, True), (3, 3, 2, False), (2, 0, 1, False), (2, 0, 2, False)]
    assert [r.vertices for r in vertex_count(df, "g").orderBy("id").collect()] == [1, 2, 1, 0]
    points = [(r.id, r.vertex_no, r.x, r.y, r.z) for r in explode_vertices(df, "g").orderBy("id", "vertex_no").collect()]
    assert points == [(0, 1, 1.0, 2.0, None), (1, 1, 1.0, 2.0, 3.0), (1, 2, 4.0, 5.0, 6.0), (2, 1, 1.0, 2.0, None)]


def test_report(spark):
    df = objects(spark, shape(2003, [1, 1003, 1], SQUARE), shape(2003, [1, 1003, 1], CLOCKWISE),
                 shape(2003, [1, 1003, 1, 11, 2003, 1], SQUARE + SQUARE), shape(2004), shape(2001, point=(1.0, 2.0, None)), None)
    assert dict(geometry_report(df, "g").collect()) == {"valid": 2, "winding": 2, "not_encodable:collection_unsupported": 1}


@pytest.mark.parametrize("vertices", [4, 12, 14, 30, 100])
def test_rings_of_any_size_survive_a_round_trip(spark, vertices):
    ring = [[10 + math.cos(2 * math.pi * i / vertices), 10 + math.sin(2 * math.pi * i / vertices)] for i in range(vertices)]
    hole = [[10 + 0.1 * math.cos(-2 * math.pi * i / 8), 10 + 0.1 * math.sin(-2 * math.pi * i / 8)] for i in range(8)]
    value = write(3, [ring + ring[:1], hole + hole[:1]])
    df = spark.createDataFrame([(bytearray(value),)], "geom binary")
    decoded = decode_geometry(df, "geom")
    assert vertex_count(decoded, "geom").first().vertices == vertices + 1 + 9
    assert bytes(encode_geometry(decoded, "geom").first().geom) == value


CRS = [
    ('{"crs":"EPSG:3857"}', 3857), ('{"crs":"epsg:27700"}', 27700), ('{"crs":{"id":{"authority":"EPSG","code":3857}}}', 3857),
    ('{"crs":{"id":{"authority":"epsg","code":3857}}}', 3857), ('{"crs":{"id":{"authority":"ESRI","code":3857}}}', 4326),
    ('{"crs":"EPSG:0"}', 4326), ('{"crs":"OGC:CRS84"}', 4326), ('{"crs":"EPSG:x"}', 4326), ('{"crs":null}', 4326), ("{}", 4326),
    ("", 4326), ("junk", 4326), (None, 4326), ('{"columns":{"geom":{"crs":"EPSG:3857"}}}', 4326), ('{"crs":{"id":{"authority":"EPSG"}}}', 4326),
]


def test_srid_of_texts_and_of_fields(spark):
    df = spark.createDataFrame([(text,) for text, _ in CRS], "t string")
    assert [r.s for r in df.select(srid_of(F.col("t")).alias("s")).collect()] == [srid for _, srid in CRS]
    for text, srid in CRS:
        metadata = {} if text is None else {"ARROW:extension:metadata": text}
        assert field_srid(T.StructField("g", T.BinaryType(), True, metadata)) == srid


def test_detection_and_tags(spark):
    schema = (
        T.StructType().add("Geom", T.BinaryType()).add("geometry", T.StringType()).add("WKB_GEOMETRY", T.BinaryType())
        .add("raw", T.BinaryType()).add("tagged", T.BinaryType(), True, crs_metadata(0))
    )
    assert geometry_columns(schema) == ["Geom", "WKB_GEOMETRY", "tagged"]
    assert crs_metadata(4326)["ARROW:extension:metadata"] == '{"crs":"EPSG:4326"}' and crs_metadata(None)["ARROW:extension:metadata"] == "{}"
    tagged = tag_crs(spark.createDataFrame([], schema), "raw", 3857)
    assert geometry_columns(tagged.schema) == ["Geom", "WKB_GEOMETRY", "raw", "tagged"]
    assert field_srid(tagged.schema["raw"]) == 3857
