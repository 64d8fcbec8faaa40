"""The two byte-level steps Spark has no built-in for: WKB bytes to numbers and back.

Each works on a whole Arrow batch at once with NumPy: in every round all values of the
batch advance by one header or ring together. Only when few values are left, those with
the most parts, is each walked to its end by itself. Nothing geometric happens here;
winding, rectangles, arcs and element rules are Catalyst expressions.
"""

from __future__ import annotations

import struct
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

# Executors then need only NumPy and PyArrow, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# WKB kinds, element types, and the reasons a value is refused.
POINT, LINE, POLYGON, MULTI_POINT, MULTI_LINE, MULTI_POLYGON = 1, 2, 3, 4, 5, 6
ELEMENT_POINT, ELEMENT_LINE, OUTER_RING, INNER_RING = 1, 2, 1003, 2003
TOO_SHORT, BAD_ORDER, BAD_TYPE, TRUNCATED, TOO_MANY = 1, 2, 3, 4, 5
DECODE_REASONS = (
    None, "too_short", "bad_byte_order", "unsupported_type", "truncated", "count_exceeds_bytes",
)

# With fewer values than this, a round over all costs more than walking them one by one.
FEW = 32

UNPACKED = (
    T.StructType()
    .add("kind", T.IntegerType())
    .add("dims", T.IntegerType())
    .add("x", T.DoubleType())
    .add("y", T.DoubleType())
    .add("z", T.DoubleType())
    .add("elem_info", T.ArrayType(T.IntegerType()))
    .add("ordinates", T.ArrayType(T.DoubleType()))
    .add("reason", T.StringType())
)


def _starts(lengths):
    return np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))


def _runs(first, lengths, step):
    """first[i], first[i]+step, … lengths[i] times, for all i after each other."""
    ends = _starts(lengths)
    return np.repeat(first - step * ends[:-1], lengths) + step * np.arange(ends[-1])


def _u32(data, at, big):
    raw = data[at[:, None] + np.arange(4)]
    little = raw.copy().view("<u4")[:, 0].astype(np.int64)
    return np.where(big, raw.copy().view(">u4")[:, 0].astype(np.int64), little)


def _gather_doubles(data, at):
    """Little-endian doubles at arbitrary byte positions, one pass per byte alignment."""
    out = np.empty(len(at), dtype="<f8")
    shifts = at % 8
    for shift in np.unique(shifts):
        usable = (len(data) - shift) // 8 * 8
        hit = shifts == shift
        out[hit] = data[shift:shift + usable].view("<f8")[(at[hit] - shift) // 8]
    return out


def _scatter_doubles(data, at, values):
    shifts = at % 8
    for shift in np.unique(shifts):
        usable = (len(data) - shift) // 8 * 8
        hit = shifts == shift
        data[shift:shift + usable].view("<f8")[(at[hit] - shift) // 8] = values[hit]


def _walk(data, at, end, point_bytes, big, parts, rings, opening):
    """The rest of one value: (reason, spans of byte position, points, element, swapped)."""
    read = {False: struct.Struct("<I").unpack_from, True: struct.Struct(">I").unpack_from}
    found = []
    while parts or rings:
        if rings:
            shape, element = POLYGON, OUTER_RING if opening else INNER_RING
            rings, opening = rings - 1, False
        else:
            if at + 5 > end:
                return TRUNCATED, None
            big = bool(data[at] == 0)
            shape = read[big](data, at + 1)[0]
            shape -= 1000 * (shape >= 1000)
            if not POINT <= shape <= POLYGON:
                return BAD_TYPE, None
            element = {POINT: ELEMENT_POINT, LINE: ELEMENT_LINE, POLYGON: None}[shape]
            at, parts = at + 5, parts - 1
        points = 1
        if shape != POINT:
            if at + 4 > end:
                return TRUNCATED, None
            points, at = read[big](data, at)[0], at + 4
        if element is None:
            rings, opening = points, True
            continue
        if points > (end - at) // point_bytes:
            return (TRUNCATED if shape == POINT else TOO_MANY), None
        found.append((at, points, element, big))
        at += points * point_bytes
    return 0, found


def unpack_batch(values: pa.Array) -> pa.Array:
    """WKB column to (kind, dims, point, element triplets, ordinates, reason)."""
    values = pc.fill_null(values.cast(pa.large_binary()), b"")
    n = len(values)
    _, offset_buffer, data_buffer = values.buffers()
    bounds = np.frombuffer(offset_buffer, dtype=np.int64)[values.offset:values.offset + n + 1]
    data = np.frombuffer(data_buffer or b"", dtype=np.uint8)
    cursor, end = bounds[:-1].copy(), bounds[1:]
    reason = np.zeros(n, dtype=np.int8)
    reason[end - cursor < 5] = TOO_SHORT

    big = np.zeros(n, dtype=bool)
    code = np.zeros(n, dtype=np.int64)
    rows = np.flatnonzero(reason == 0)
    order = data[cursor[rows]]
    reason[rows[order > 1]] = BAD_ORDER
    rows = rows[order <= 1]
    big[rows] = data[cursor[rows]] == 0
    code[rows] = _u32(data, cursor[rows] + 1, big[rows])
    with_z = (code >= 1000) & (code < 2000)
    kind = code - 1000 * with_z
    dims = np.where(with_z, 3, 2)
    reason[rows[(kind[rows] < POINT) | (kind[rows] > MULTI_POLYGON)]] = BAD_TYPE
    cursor += 5

    parts = np.zeros(n, dtype=np.int64)  # headed parts still to come
    rings = np.zeros(n, dtype=np.int64)  # rings of the open polygon still to come
    opening = np.zeros(n, dtype=bool)  # the next ring is an outer one
    spans = []  # (row, byte position, points, element type, big-endian), in reading order

    def fits(rows, size):
        ok = cursor[rows] + size <= end[rows]
        reason[rows[~ok]] = TRUNCATED
        return rows[ok]

    def read_count(rows):
        rows = fits(rows, 4)
        count = _u32(data, cursor[rows], big[rows])
        cursor[rows] += 4
        return rows, count

    def take(rows, points, element):
        ok = points <= (end[rows] - cursor[rows]) // (dims[rows] * 8)
        reason[rows[~ok]] = TOO_MANY
        rows, points = rows[ok], points[ok]
        element = np.broadcast_to(element, ok.shape)[ok]
        spans.append((rows, cursor[rows].copy(), points, element, big[rows].copy()))
        cursor[rows] += points * dims[rows] * 8

    def read_body(rows, shape):
        """Body of a point, line or polygon whose header has just been read."""
        points = fits(rows[shape == POINT], dims[rows[shape == POINT]] * 8)
        take(points, np.ones(len(points), dtype=np.int64), ELEMENT_POINT)
        lines, count = read_count(rows[shape == LINE])
        take(lines, count, ELEMENT_LINE)
        areas, count = read_count(rows[shape == POLYGON])
        rings[areas], opening[areas] = count, True

    rows = np.flatnonzero(reason == 0)
    read_body(rows[kind[rows] <= POLYGON], kind[rows[kind[rows] <= POLYGON]])
    multi, count = read_count(rows[kind[rows] >= MULTI_POINT])
    parts[multi] = count

    live = np.flatnonzero((reason == 0) & (parts + rings > 0))
    while len(live) >= FEW:
        in_ring = rings[live] > 0
        areas, count = read_count(live[in_ring])
        rings[areas] -= 1
        element = np.where(opening[areas], OUTER_RING, INNER_RING)
        opening[areas] = False
        take(areas, count, element)

        headed = fits(live[~in_ring], 5)
        parts[headed] -= 1
        big[headed] = data[cursor[headed]] == 0
        shape = _u32(data, cursor[headed] + 1, big[headed])
        shape = np.where(shape >= 1000, shape - 1000, shape)
        cursor[headed] += 5
        known = (shape >= POINT) & (shape <= POLYGON)
        reason[headed[~known]] = BAD_TYPE
        read_body(headed[known], shape[known])
        live = live[(reason[live] == 0) & (parts[live] + rings[live] > 0)]

    for row in live:
        why, found = _walk(
            data, int(cursor[row]), int(end[row]), int(dims[row]) * 8, bool(big[row]),
            int(parts[row]), int(rings[row]), bool(opening[row]),
        )
        reason[row] = why
        if not why and found:
            at, points, element, swapped = (np.array(values, dtype=np.int64) for values in zip(*found))
            spans.append((np.full(len(at), row), at, points, element, swapped))

    row, at, points, element, swapped = (
        np.concatenate([span[i] for span in spans]) if spans else np.zeros(0, dtype=np.int64)
        for i in range(5)
    )
    keep = np.flatnonzero(reason[row] == 0)
    keep = keep[np.argsort(row[keep], kind="stable")]
    row, at, points, element, swapped = row[keep], at[keep], points[keep], element[keep], swapped[keep]
    sizes = points * dims[row]
    numbers = _gather_doubles(data, _runs(at, sizes, 8))
    swapped = np.repeat(swapped.astype(bool), sizes)
    numbers[swapped] = numbers[swapped].byteswap()

    # A simple point keeps its coordinates in the point fields and has no arrays.
    is_point = kind == POINT
    span_start = _starts(sizes)[:-1]
    lone = is_point[row]
    xyz = np.full((n, 3), np.nan)
    for axis in range(3):
        has = lone & (dims[row] > axis)
        xyz[row[has], axis] = numbers[span_start[has] + axis]
    read = reason == 0

    def coordinate(axis, present):
        return pa.array(xyz[:, axis], mask=~(read & is_point & present))

    listed = ~lone
    per_row = np.bincount(row[listed], weights=sizes[listed], minlength=n).astype(np.int64)
    row_start = _starts(per_row)
    in_row = _starts(sizes[listed])[:-1] - row_start[row[listed]] + 1
    triplets = np.stack([in_row, element[listed], np.ones_like(in_row)], axis=1).ravel()
    info_start = _starts(3 * np.bincount(row[listed], minlength=n))
    numbers = numbers[np.repeat(listed, sizes)]
    everywhere = np.ones(n, dtype=bool)
    return pa.StructArray.from_arrays(
        [
            pa.array(kind.astype(np.int32), mask=~read),
            pa.array(dims.astype(np.int32), mask=~read),
            coordinate(0, everywhere), coordinate(1, everywhere), coordinate(2, with_z),
            pa.ListArray.from_arrays(pa.array(info_start.astype(np.int32)), pa.array(triplets.astype(np.int32))),
            pa.ListArray.from_arrays(pa.array(row_start.astype(np.int32)), pa.array(numbers)),
            pa.array(DECODE_REASONS).take(pa.array(reason)).cast(pa.string()),
        ],
        ["kind", "dims", "x", "y", "z", "elem_info", "ordinates", "reason"],
    )


def pack_batch(kind: pa.Array, dims: pa.Array, sizes: pa.Array, opens: pa.Array, ordinates: pa.Array) -> pa.Array:
    """Parts of known size to little-endian WKB; NULL kind gives NULL.

    ``sizes`` holds the ordinate count of every part, ``opens``, filled for multi
    polygons only, whether a part starts a polygon, ``ordinates`` all parts after each other.
    """
    n = len(kind)
    missing = kind.is_null().to_numpy(zero_copy_only=False)
    kind = pc.fill_null(kind, 0).to_numpy()
    dims = pc.fill_null(dims, 2).to_numpy()
    count = pc.fill_null(pc.list_value_length(sizes), 0).to_numpy().astype(np.int64)
    size = sizes.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    numbers = ordinates.flatten().to_numpy(zero_copy_only=False)

    row = np.repeat(np.arange(n), count)
    shape = kind[row]
    is_open = np.zeros(len(row), dtype=bool)
    is_open[shape == MULTI_POLYGON] = opens.flatten().to_numpy(zero_copy_only=False)
    points = size // dims[row]
    prefix = np.zeros(len(row), dtype=np.int64)
    prefix[(shape == LINE) | (shape == POLYGON)] = 4
    prefix[shape == MULTI_POINT] = 5
    prefix[shape == MULTI_LINE] = 9
    prefix[shape == MULTI_POLYGON] = np.where(is_open[shape == MULTI_POLYGON], 13, 4)
    head = np.where(kind >= POLYGON, 9, np.where(kind > 0, 5, 0)).astype(np.int64)
    part_bytes = prefix + 8 * size
    body = np.bincount(row, weights=part_bytes, minlength=n).astype(np.int64)
    bounds = _starts(head + body)
    before = _starts(part_bytes)[:-1]
    first = _starts(count)[:-1]
    row_before = np.concatenate((before, [0]))[np.minimum(first, len(before))]
    at = bounds[row] + head[row] + before - row_before[row]

    data = np.zeros(bounds[-1] + 8, dtype=np.uint8)

    def put(position, value):
        raw = np.ascontiguousarray(value, dtype="<u4").view(np.uint8).reshape(-1, 4)
        data[position[:, None] + np.arange(4)] = raw

    def header(position, base, z):
        data[position] = 1
        put(position + 1, base + 1000 * z)

    filled = np.flatnonzero(kind > 0)
    z = (dims >= 3).astype(np.int64)
    header(bounds[filled], kind[filled], z[filled])
    children = count.copy()
    opened = np.flatnonzero((shape == MULTI_POLYGON) & is_open)
    areas = np.flatnonzero(kind == MULTI_POLYGON)
    children[areas] = np.bincount(row[opened], minlength=n)[areas]
    counted = np.flatnonzero(kind >= POLYGON)
    put(bounds[counted] + 5, children[counted])

    for base, offset in ((LINE, 0), (POLYGON, 0), (MULTI_LINE, 5)):
        parts = np.flatnonzero(shape == base)
        put(at[parts] + offset, points[parts])
    for base, inner in ((MULTI_POINT, POINT), (MULTI_LINE, LINE)):
        parts = np.flatnonzero(shape == base)
        header(at[parts], np.full(len(parts), inner), z[row[parts]])
    in_multi = np.flatnonzero(shape == MULTI_POLYGON)
    put(at[in_multi] + prefix[in_multi] - 4, points[in_multi])
    header(at[opened], np.full(len(opened), POLYGON), z[row[opened]])
    rank = np.searchsorted(in_multi, opened)
    put(at[opened] + 5, np.diff(np.append(rank, len(in_multi))))

    _scatter_doubles(data, _runs(at + prefix, size, 8), numbers)
    offsets = pa.py_buffer(bounds.astype(np.int64))
    valid = pa.array(~missing).buffers()[1]
    packed = pa.Array.from_buffers(pa.large_binary(), n, [valid, offsets, pa.py_buffer(data)])
    return packed.cast(pa.binary())


def _unpack_wkb(values: pa.Array) -> pa.Array:
    return unpack_batch(values)


# Declared non-deterministic although it is not: otherwise, when another Python function
# follows in the same plan, the optimizer copies every expression in between into that
# function's arguments once per use. The price is that a filter written after the decoding
# is not moved in front of it, so filter first.
unpack_wkb = arrow_udf(_unpack_wkb, UNPACKED).asNondeterministic()


@arrow_udf(T.BinaryType())
def pack_wkb(kind: pa.Array, dims: pa.Array, sizes: pa.Array, opens: pa.Array, ordinates: pa.Array) -> pa.Array:
    return pack_batch(kind, dims, sizes, opens, ordinates)
