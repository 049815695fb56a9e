"""WKB batch helpers: round trips, bounds, damaged values and exact intersection."""

import struct

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from geoloom.functions import wkb as W

number = st.integers(-50, 50).map(float)
point = st.tuples(number, number)
SQUARE = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]
HOLE = [(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 2.0), (1.0, 1.0)]


def enc_point(p, order="<"):
    return struct.pack(order + "BIdd", order == "<", 1, *p)


def enc_line(pts):
    return struct.pack("<BII", 1, 2, len(pts)) + b"".join(struct.pack("<dd", *p) for p in pts)


def enc_polygon(rings):
    body = b"".join(struct.pack("<I", len(r)) + b"".join(struct.pack("<dd", *p) for p in r) for r in rings)
    return struct.pack("<BII", 1, 3, len(rings)) + body


def enc_multi(code, parts):
    return struct.pack("<BII", 1, code, len(parts)) + b"".join(parts)


def read(values):
    return W.read_wkb(pa.array(values, pa.binary()))


line = st.lists(point, min_size=2, max_size=6)
ring = st.lists(point, min_size=3, max_size=6).map(lambda r: [*r, r[0]])
polygon = st.lists(ring, min_size=1, max_size=3)
geometry = st.one_of(
    st.none(),
    point.map(enc_point),
    line.map(enc_line),
    polygon.map(enc_polygon),
    st.lists(point, min_size=1, max_size=4).map(lambda ps: enc_multi(4, [enc_point(p) for p in ps])),
    st.lists(line, min_size=1, max_size=3).map(lambda ls: enc_multi(5, [enc_line(x) for x in ls])),
    st.lists(polygon, min_size=1, max_size=3).map(lambda ps: enc_multi(6, [enc_polygon(p) for p in ps])),
)


@settings(max_examples=200, deadline=None)
@given(st.lists(geometry, max_size=8))
def test_round_trip(values):
    c = read(values)
    assert not c.bad.any()
    assert W.write_wkb(c.kind, W.nested_parts(c)).to_pylist() == values


@settings(max_examples=100, deadline=None)
@given(st.lists(geometry, max_size=8))
def test_bounds_hold_all_vertices(values):
    c = read(values)
    rows, box = W.bounds(c)
    for r, (x0, y0, x1, y1) in zip(rows, box):
        mine = c.point_row == r
        assert (c.x[mine].min(), c.y[mine].min(), c.x[mine].max(), c.y[mine].max()) == (x0, y0, x1, y1)
    assert set(rows) == {i for i, v in enumerate(values) if v is not None}


def test_sliced_batches_and_big_endian():
    a = pa.array([enc_point((9, 9)), enc_point((1, 2), ">"), None, enc_line([(0, 0), (5, 6)])], pa.binary())[1:]
    c = W.read_wkb(a)
    assert c.kind.tolist() == [1, 0, 2] and c.x.tolist() == [1, 0, 5] and c.y.tolist() == [2, 0, 6]


def test_dimensions_and_srid_flags_are_read():
    z = struct.pack("<BIddd", 1, 1001, 5, 6, 7)
    ewkb_z = struct.pack("<BIIddd", 1, 0x80000000 | 0x20000000 | 1, 25830, 7, 8, 9)
    c = read([z, ewkb_z])
    assert not c.bad.any() and c.x.tolist() == [5, 7] and c.y.tolist() == [6, 8]


def test_damaged_values_are_flagged_alone():
    good = enc_polygon([SQUARE])
    values = [good, b"", b"\x01\x03", good + b"x", good[:-1], b"\x07" + good[1:], enc_multi(6, [good, b"\x01\x03\x00\x00\x00\xff\xff\xff\xff"]), good]
    c = read(values)
    assert c.bad.tolist() == [False, True, True, True, True, True, True, False]
    assert W.bounds(c)[0].tolist() == [0, 7]


def test_empty_geometries_have_no_bounds():
    c = read([enc_polygon([]), enc_line([]), enc_point((float("nan"), float("nan"))), enc_multi(6, [])])
    assert not c.bad.any() and len(W.bounds(c)[0]) == 0


def _orient(a, b, c):
    return (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])


def _on(a, b, p):
    return _orient(a, b, p) == 0 and min(a[0], b[0]) <= p[0] <= max(a[0], b[0]) and min(a[1], b[1]) <= p[1] <= max(a[1], b[1])


def _cross(a, b, c, d):
    if any((_on(a, b, c), _on(a, b, d), _on(c, d, a), _on(c, d, b))):
        return True
    return _orient(a, b, c) * _orient(a, b, d) < 0 and _orient(c, d, a) * _orient(c, d, b) < 0


def _inside(p, rings):
    odd = False
    for r in rings:
        for a, b in zip(r, r[1:]):
            if _on(a, b, p):
                return True
            if (a[1] > p[1]) != (b[1] > p[1]) and p[0] < a[0] + (p[1] - a[1]) * (b[0] - a[0]) / (b[1] - a[1]):
                odd = not odd
    return odd


def _brute(kind, rings, query):
    edges = [(a, b) for r in rings for a, b in zip(r, r[1:])]
    q_edges = [(a, b) for r in query for a, b in zip(r, r[1:])]
    if any(_inside(p, query) for r in rings for p in r):
        return True
    if any(_cross(*e, *f) for e in edges for f in q_edges):
        return True
    return kind == 3 and _inside(query[0][0], rings)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(line.map(lambda v: (2, [v])), ring.map(lambda v: (3, [v])), point.map(lambda v: (1, [[v]]))), min_size=1, max_size=6), ring)
def test_intersects_equals_brute_force(shapes, query):
    enc = {1: lambda r: enc_point(r[0][0]), 2: lambda r: enc_line(r[0]), 3: enc_polygon}
    got = W.QueryPolygon([[query]]).intersects(read([enc[k](r) for k, r in shapes]), block=8)
    assert got.tolist() == [_brute(k, r, [query]) for k, r in shapes]


def test_holes_and_touching():
    shapes = read([enc_polygon([SQUARE, HOLE]), enc_point((4, 4)), enc_point((1.5, 1.3)), None])
    in_hole = W.QueryPolygon([[[(1.2, 1.2), (1.8, 1.2), (1.8, 1.8)]]])
    assert in_hole.intersects(shapes).tolist() == [False, False, True, False]
    with_hole = W.QueryPolygon([[SQUARE, HOLE]])
    assert with_hole.intersects(shapes).tolist() == [True, True, False, False]
    within = W.QueryPolygon([[[(2.5, 2.5), (3.5, 2.5), (3.5, 3.5)]]])
    assert within.intersects(shapes).tolist() == [True, False, False, False]


def test_collections():
    mixed = enc_multi(7, [enc_point((9, 9)), enc_line([(-1, 5), (6, 5)]), enc_polygon([SQUARE])])
    lines = enc_multi(7, [enc_line([(0, 0), (4, 0), (4, 4)]), enc_line([(0, 4), (0, 0)])])
    c = read([mixed, lines])
    assert c.kind.tolist() == [7, 7] and W.bounds(c)[1].tolist() == [[-1, 0, 9, 9], [0, 0, 4, 4]]
    inside = W.QueryPolygon([[[(1.0, 1.0), (2.0, 1.0), (2.0, 2.0)]]])
    assert inside.intersects(c).tolist() == [True, False]


def test_coordinates_are_replaced_in_place():
    z = struct.pack("<BIddd", 1, 1001, 5, 6, 7)
    values = [enc_point((1, 2), ">"), None, enc_multi(7, [enc_line([(0, 0), (5, 6)]), enc_polygon([SQUARE])]), z, b"x", enc_polygon([])]
    a = pa.array([b"skipped", *values], pa.binary())[1:]
    c = W.read_wkb(a)
    c.x, c.y = c.x + 1, c.y * 2
    got = W.replace_coordinates(a, c).to_pylist()
    moved = [(x + 1, y * 2) for x, y in SQUARE]
    assert got == [
        enc_point((2, 4), ">"),
        None,
        enc_multi(7, [enc_line([(1, 0), (6, 12)]), enc_polygon([moved])]),
        struct.pack("<BIddd", 1, 1001, 6, 12, 7),
        None,
        enc_polygon([]),
    ]
