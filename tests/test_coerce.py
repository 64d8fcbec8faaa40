"""Loose values to typed columns."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry import conform, plan_frame, to_load_form
from tableferry.operators.conform import read_back, stored_types

LONG, DOUBLE, TEXT, BOOL = T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType()
WALL, INSTANT, BYTES = T.TimestampNTZType(), T.TimestampType(), T.BinaryType()


def one(spark, values, source, target, **options):
    df = spark.createDataFrame([(v,) for v in values], T.StructType().add("v", source))
    return [row.v for row in conform(df, T.StructType().add("v", target), **options).collect()]


def test_integers_truncate_and_parse(spark):
    assert one(spark, [42, None], T.IntegerType(), LONG) == [42, None]
    assert one(spark, [99.0, -12.7, float("nan"), 1e30, 2.0**63, -(2.0**63)], DOUBLE, LONG) == [
        99, -12, None, None, None, -(2**63)]
    texts = ["123", "+5", "12.7", "-0.9", "1e3", " 12", "12 ", "12d", "", "x", "99999999999999999999", "0x1p4", None]
    assert one(spark, texts, TEXT, LONG) == [123, 5, 12, 0, 1000, None, None, None, None, None, None, 16, None]
    assert one(spark, [True], BOOL, LONG) == [None]


def test_floats_parse(spark):
    assert one(spark, ["2.718", "1e400", ".5", "5.", "1f", " 1", "-Inf", "abc"], TEXT, DOUBLE) == [
        2.718, None, 0.5, 5.0, None, None, -math.inf, None]
    assert math.isnan(one(spark, ["NaN"], TEXT, DOUBLE)[0])
    assert one(spark, [42], LONG, DOUBLE) == [42.0]


@pytest.mark.parametrize("value,text", [
    (42.0, "42"), (3.14, "3.14"), (-2.5e10, "-25000000000"), (1e20, "100000000000000000000"), (1e21, "1e+21"),
    (1.234e-5, "1.234e-05"), (0.00012, "0.00012"), (123456789.25, "123456789.25"), (math.inf, "+Inf"),
])
def test_printed_floats(spark, value, text):
    assert one(spark, [value], DOUBLE, TEXT) == [text]


def test_text(spark):
    assert one(spark, [bytearray(b"bytes")], BYTES, TEXT) == ["bytes"]
    assert one(spark, [42, None], LONG, TEXT) == ["42", None]
    assert one(spark, [True], BOOL, TEXT) == ["true"]
    assert one(spark, [dt.datetime(2024, 3, 15, 10, 30, 45, 120000)], WALL, TEXT) == ["2024-03-15 10:30:45.12 +0000 UTC"]


LAYOUTS = {
    "2024-01-02T03:04:05+02:00": ("2024-01-02 03:04:05", "2024-01-02 01:04:05"),
    "2024-01-02T03:04:05.123456789Z": ("2024-01-02 03:04:05.123456", "2024-01-02 03:04:05.123456"),
    "2024-01-02 03:04:05.5 -05:30": ("2024-01-02 03:04:05.5", "2024-01-02 08:34:05.5"),
    "2024-01-02 03:04:05": ("2024-01-02 03:04:05", "2024-01-02 03:04:05"),
    "2024-01-02": ("2024-01-02 00:00:00", "2024-01-02 00:00:00"),
    "2024-01-02T03:04:05": (None, None), "2024-02-30": (None, None), "2024-1-2": (None, None),
    "2024-01-02 03:04:05Z": (None, None), "2024-01-02 25:00:00": (None, None), "soon": (None, None),
}


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo"])
def test_time_layouts_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    df = spark.createDataFrame([(t, t) for t in LAYOUTS], "wall string, instant string")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        typed = conform(df, T.StructType().add("wall", WALL).add("instant", INSTANT))
        rows = typed.select(F.col("wall").cast("string"), F.unix_micros("instant").alias("us")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    for row, (wall, instant) in zip(rows, LAYOUTS.values()):
        assert row.wall == wall
        expected = instant and dt.datetime.fromisoformat(instant).replace(tzinfo=dt.timezone.utc)
        assert row.us == (expected and round(expected.timestamp() * 1_000_000))


def test_wall_clock_of_an_instant_is_read_in_the_given_zone(spark):
    df = spark.sql("SELECT timestamp '2024-06-01 16:00:00+00:00' AS v")
    typed = conform(df, T.StructType().add("v", WALL), zone="America/New_York")
    assert typed.first().v == dt.datetime(2024, 6, 1, 12, 0)


def test_flags(spark):
    texts = ["1", "true", "TRUE", "Y", "True", "y", "yes", "0", "", None]
    assert one(spark, texts, TEXT, BOOL) == [True] * 4 + [False] * 5 + [None]
    assert one(spark, [0.0, 0.5, None], DOUBLE, BOOL) == [False, True, None]
    assert one(spark, [dt.date(2024, 1, 1)], T.DateType(), BOOL) == [None]


def test_bytes_only_from_bytes(spark):
    assert one(spark, [bytearray(b"x")], BYTES, BYTES) == [bytearray(b"x")]
    assert one(spark, ["x"], TEXT, BYTES) == [None]


def test_missing_and_unsupported_columns_are_null_and_order_follows_the_schema(spark):
    df = spark.createDataFrame([(1, "a")], "A bigint, b string")
    wanted = T.StructType().add("b", T.ShortType()).add("c", DOUBLE).add("a", LONG)
    assert [tuple(r) for r in conform(df, wanted).collect()] == [(None, None, 1)]


def test_on_error_fail_stops_the_job(spark):
    with pytest.raises(Exception, match="no bigint in abc"):
        one(spark, ["abc"], TEXT, LONG, on_error="fail")
    assert one(spark, ["7", None], TEXT, LONG, on_error="fail") == [7, None]


def test_load_form(spark):
    df = spark.sql("""SELECT tinyint(1) a, smallint(2) b, 3 c, 4L d, cast(18446744073709551615 AS decimal(20,0)) u,
        float(0.5) f, true g, cast(1.50 AS decimal(5,2)) p, date '2024-12-31' day, array(1, 2) l,
        named_struct('x', 1) s, timestamp_ntz '2024-03-15 10:30:45.123456' ts, X'00ff' raw, '' e""")
    row = to_load_form(df).first()
    assert (row.a, row.b, row.c, row.d, row.u) == (1, 2, 3, 4, "18446744073709551615")
    assert (row.f, row.g, row.p, row.day) == (0.5, 1, "1.50", dt.datetime(2024, 12, 31))
    assert (row.l, row.s, row.ts) == ("[1,2]", '{"x":1}', dt.datetime(2024, 3, 15, 10, 30, 45, 123456))
    assert (row.raw, row.e) == (bytearray(b"\x00\xff"), "")


def test_round_trip_types(spark):
    """Written type -> type read back: integers come back as text, scaled decimals as floats."""
    df = spark.sql("""SELECT 1 i, true g, cast(1.25 AS decimal(6,2)) p, cast(7 AS decimal(10,0)) n, cast(7 AS decimal(25,0)) w,
        float(0.5) f, date '2024-01-02' d, '' e, array(1) l, timestamp '2024-01-02 00:00:00' z, X'01' b""")
    types = {r["name"]: r["read_type"] for r in stored_types(plan_frame(df)).collect()}
    assert types == {"I": "string", "G": "bigint", "P": "double", "N": "bigint", "W": "string", "F": "double",
                     "D": "timestamp_ntz", "E": "string", "L": "string", "Z": "timestamp", "B": "binary"}
    row = read_back(df, types).first()
    assert (row.I, row.G, row.P, row.N, row.W, row.F, row.E, row.L) == ("1", 1, 1.25, 7, "7", 0.5, None, "[1]")
    assert row.D == dt.datetime(2024, 1, 2)
