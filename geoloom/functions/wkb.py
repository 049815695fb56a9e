"""Well-known binary over whole Arrow batches with numpy.

A geometry is handled in one canonical nested form, ``parts -> rings -> points``: a Point is one part with
one ring of one point, a LineString one part with one ring, a Polygon one part, a Multi* several parts.
The helpers below turn a batch of WKB values into flat coordinate arrays and back without a loop over rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

POINT, LINE, POLYGON, MULTI_POINT, MULTI_LINE, MULTI_POLYGON, COLLECTION = range(1, 8)
_Z_FLAG, _M_FLAG, _SRID_FLAG = 0x80000000, 0x40000000, 0x20000000


@dataclass
class Coordinates:
    """Flat view of a batch: one entry per ring, plus the coordinates of all rings end to end."""

    kind: np.ndarray  # per row, base type code, 0 when null or unreadable
    bad: np.ndarray  # per row, the bytes could not be read
    row: np.ndarray  # per ring
    part: np.ndarray  # per ring
    count: np.ndarray  # per ring
    area: np.ndarray  # per ring, it bounds a surface
    x: np.ndarray
    y: np.ndarray
    at: np.ndarray  # per point, where its x lies in the bytes
    big: np.ndarray  # per point, big-endian

    @property
    def point_row(self) -> np.ndarray:
        return np.repeat(self.row, self.count)


class _Scan:
    """Walks all geometries of a batch side by side; every step is one numpy expression."""

    def __init__(self, buf: np.ndarray, end: np.ndarray, n: int):
        pad = np.concatenate([buf, np.zeros(8, np.uint8)])  # overlapping views need 7 spare bytes
        self.bytes = pad
        size = len(pad)
        self.u32 = [np.ndarray((size - 3,), t, pad, strides=(1,)) for t in ("<u4", ">u4")]
        self.f64 = [np.ndarray((size - 7,), t, pad, strides=(1,)) for t in ("<f8", ">f8")]
        self.end, self.bad, self.kind = end, np.zeros(n, bool), np.zeros(n, np.int32)
        self.next_part = np.zeros(n, np.int64)
        self.rings: list[tuple[np.ndarray, ...]] = []

    def _int(self, pos, big):
        return np.where(big, self.u32[1][pos], self.u32[0][pos]).astype(np.int64)

    def _keep(self, ok, rows, *arrays):
        self.bad[rows[~ok]] = True
        return (rows[ok], *[a[ok] for a in arrays])

    def _ring(self, rows, part, pos, count, stride, big, area=False):
        """Registers ``count`` points from ``pos``; returns the position after them."""
        self.rings.append((rows, part, pos, count, stride, big, np.full(len(rows), area)))
        return pos + count * stride

    def walk(self, rows, pos, top=True, depth=0):
        """Reads one geometry per row; returns rows still readable and the position after each."""
        if depth > 32:
            self.bad[rows] = True
            return rows[:0], pos[:0]
        ok = pos + 5 <= self.end[rows]
        rows, pos = self._keep(ok, rows, pos)
        order = self.bytes[pos]
        rows, pos, order = self._keep(order <= 1, rows, pos, order)
        big = order == 0
        code = self._int(pos + 1, big)
        low = code & 0x0FFFFFFF
        dims = 2 + ((code & _Z_FLAG) > 0).astype(np.int64) + ((code & _M_FLAG) > 0)
        dims = dims + np.take(np.array([0, 1, 1, 2]), np.clip(low // 1000, 0, 3))
        base = low % 1000
        ok = (base >= POINT) & (base <= COLLECTION) & (low < 4000)
        pos = pos + 5 + np.where((code & _SRID_FLAG) > 0, 4, 0)
        rows, pos, big, base, stride = self._keep(ok, rows, pos, big, base, dims * 8)
        if top:
            self.kind[rows] = base
        done_rows, done_pos = [], []

        def finish(r, p):
            done_rows.append(r)
            done_pos.append(p)

        sel = base == POINT
        if sel.any():
            r, p, s, b = rows[sel], pos[sel], stride[sel], big[sel]
            r, p, s, b = self._keep(p + s <= self.end[r], r, p, s, b)
            part = self.next_part[r]
            self.next_part[r] += 1
            finish(r, self._ring(r, part, p, np.ones(len(r), np.int64), s, b))
        for code_, reader in ((LINE, self._line), (POLYGON, self._polygon)):
            sel = base == code_
            if sel.any():
                finish(*reader(*self._counted(sel, rows, pos, stride, big)))
        sel = base >= MULTI_POINT
        if sel.any():
            r, p, n, _, _ = self._counted(sel, rows, pos, stride, big, smallest=9)
            left = np.arange(len(r))
            for k in range(int(n.max(initial=0))):
                left = left[n[left] > k]
                got, after = self.walk(r[left], p[left], top=False, depth=depth + 1)
                at = np.searchsorted(r[left], got)  # r is ascending, so rows keep their order
                left = left[at]
                p[left] = after
            fine = ~self.bad[r]
            finish(r[fine], p[fine])
        if not done_rows:
            return rows[:0], pos[:0]
        all_rows, all_pos = np.concatenate(done_rows), np.concatenate(done_pos)
        by_row = np.argsort(all_rows, kind="stable")
        return all_rows[by_row], all_pos[by_row]

    def _counted(self, sel, rows, pos, stride, big, smallest=4):
        """Reads the element count that follows the header and checks that it can fit."""
        r, p, s, b = rows[sel], pos[sel].copy(), stride[sel], big[sel]
        r, p, s, b = self._keep(p + 4 <= self.end[r], r, p, s, b)
        n = self._int(p, b)
        p = p + 4
        return self._keep(n * smallest <= self.end[r] - p, r, p, n, s, b)

    def _line(self, r, p, n, s, b):
        r, p, n, s, b = self._keep(n * s <= self.end[r] - p, r, p, n, s, b)
        part = self.next_part[r]
        self.next_part[r] += 1
        return r, self._ring(r, part, p, n, s, b)

    def _polygon(self, r, p, n, s, b):
        part = self.next_part[r].copy()
        self.next_part[r] += 1
        left = np.arange(len(r))
        for k in range(int(n.max(initial=0))):
            left = left[n[left] > k]
            rr, pp, ss, bb = r[left], p[left], s[left], b[left]
            fits = pp + 4 <= self.end[rr]
            count = np.where(fits, self._int(np.where(fits, pp, 0), bb), 0)
            fits &= count * ss <= self.end[rr] - pp - 4
            self.bad[rr[~fits]] = True
            left, rr, pp, ss, bb, count = left[fits], rr[fits], pp[fits], ss[fits], bb[fits], count[fits]
            p[left] = self._ring(rr, part[left], pp + 4, count, ss, bb, area=True)
        fine = ~self.bad[r]
        return r[fine], p[fine]


def read_wkb(values: pa.Array) -> Coordinates:
    """Flat coordinates of a batch. Points with NaN coordinates count as empty."""
    values = values.cast(pa.binary())
    n = len(values)
    offsets = np.frombuffer(values.buffers()[1], np.int32, n + 1, values.offset * 4).astype(np.int64)
    data = values.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    valid = np.asarray(values.is_valid())
    scan = _Scan(buf, offsets[1:], n)
    rows = np.flatnonzero(valid)
    got, after = scan.walk(rows, offsets[:-1][rows])
    scan.bad[got[after != offsets[1:][got]]] = True  # left-over bytes
    scan.kind[scan.bad] = 0
    empty = np.zeros(0, np.int64)
    if not scan.rings:
        none = np.zeros(0, bool)
        return Coordinates(scan.kind, scan.bad, empty, empty, empty, none, np.zeros(0), np.zeros(0), empty, none)
    row, part, pos, count, stride, big, area = (np.concatenate(c) for c in zip(*scan.rings))
    seq = np.arange(len(row))
    keep = ~scan.bad[row]
    order = np.lexsort((seq, part, row))
    order = order[keep[order]]
    row, part, pos, count, stride, big, area = (a[order] for a in (row, part, pos, count, stride, big, area))
    within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    at = np.repeat(pos, count) + within * np.repeat(stride, count)
    x, y = scan.f64[0][at], scan.f64[0][at + 8]
    swap = np.repeat(big, count)
    if swap.any():
        x[swap], y[swap] = scan.f64[1][at[swap]], scan.f64[1][at[swap] + 8]
    hole = np.isnan(x) & np.isnan(y)
    if hole.any():
        ring_of = np.repeat(np.arange(len(count)), count)
        count = np.bincount(ring_of[~hole], minlength=len(count))
        x, y, at, swap = x[~hole], y[~hole], at[~hole], swap[~hole]
    return Coordinates(scan.kind, scan.bad, row, part, count, area, x, y, at, swap)


def replace_coordinates(values: pa.Array, c: Coordinates) -> pa.Array:
    """The same geometries with the x and y of ``c``; everything else in the bytes stays. Unreadable: null."""
    values = values.cast(pa.binary())
    n = len(values)
    data = values.buffers()[2]
    out = np.concatenate([np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), np.zeros(8, np.uint8)])
    for order, mine in (("<f8", ~c.big), (">f8", c.big)):
        view = np.ndarray((len(out) - 7,), order, out, strides=(1,))
        view[c.at[mine]], view[c.at[mine] + 8] = c.x[mine], c.y[mine]
    offsets = np.frombuffer(values.buffers()[1], np.int32, n + 1, values.offset * 4)
    return pa.Array.from_buffers(
        pa.binary(), n, [pa.array(c.kind > 0).buffers()[1], pa.py_buffer(offsets.tobytes()), pa.py_buffer(out.tobytes())]
    )


def _grouped(ufunc, values, starts):
    return ufunc.reduceat(values, starts) if len(starts) else np.zeros(0)


def bounds(c: Coordinates) -> tuple[np.ndarray, np.ndarray]:
    """(rows that have vertices, array of xmin,ymin,xmax,ymax per such row)."""
    point_row = c.point_row
    rows, starts = np.unique(point_row, return_index=True)
    out = np.stack(
        [
            _grouped(np.minimum, c.x, starts),
            _grouped(np.minimum, c.y, starts),
            _grouped(np.maximum, c.x, starts),
            _grouped(np.maximum, c.y, starts),
        ],
        axis=1,
    ) if len(rows) else np.zeros((0, 4))
    return rows, out


def nested_parts(c: Coordinates) -> pa.Array:
    """Canonical ``parts -> rings -> points`` lists; null for null or unreadable rows."""
    n = len(c.kind)
    points = pa.StructArray.from_arrays([pa.array(c.x, pa.float64()), pa.array(c.y, pa.float64())], ["x", "y"])
    live = c.count > 0
    row, part, count = c.row[live], c.part[live], c.count[live]
    ring_offsets = np.concatenate([[0], np.cumsum(count)])
    rings = pa.ListArray.from_arrays(pa.array(ring_offsets, pa.int32()), points)
    first_of_part = np.ones(len(row), bool)
    first_of_part[1:] = (row[1:] != row[:-1]) | (part[1:] != part[:-1])
    part_starts = np.flatnonzero(first_of_part)
    parts = pa.ListArray.from_arrays(pa.array(np.append(part_starts, len(row)), pa.int32()), rings)
    per_row = np.bincount(row[part_starts], minlength=n)
    row_offsets = np.concatenate([[0], np.cumsum(per_row)])
    return pa.ListArray.from_arrays(pa.array(row_offsets, pa.int32()), parts, mask=pa.array(c.kind == 0))


def _list_offsets(a: pa.ListArray) -> np.ndarray:
    return np.asarray(a.offsets).astype(np.int64)


def write_wkb(kinds: np.ndarray, parts: pa.ListArray) -> pa.Array:
    """Little-endian WKB of canonical nested lists. Null parts give null."""
    n = len(parts)
    valid = np.asarray(parts.is_valid()) & (kinds >= POINT) & (kinds <= MULTI_POLYGON)
    o1 = _list_offsets(parts)
    lvl2 = parts.values
    o2 = _list_offsets(lvl2)
    lvl3 = lvl2.values
    o3 = _list_offsets(lvl3)
    points = lvl3.values
    xs = np.asarray(points.field("x").fill_null(np.nan)) if len(points) else np.zeros(0)
    ys = np.asarray(points.field("y").fill_null(np.nan)) if len(points) else np.zeros(0)

    n_parts = np.where(valid, np.diff(o1), 0)
    part_ids = _expand(o1[:-1], n_parts)
    part_row = np.repeat(np.arange(n), n_parts)
    n_rings = np.diff(o2)[part_ids]
    ring_ids = _expand(o2[:-1][part_ids], n_rings)
    ring_part = np.repeat(np.arange(len(part_ids)), n_rings)
    n_points = np.diff(o3)[ring_ids]
    ring_kind = kinds[part_row[ring_part]]
    part_kind = kinds[part_row]

    ring_head = np.where(np.isin(ring_kind, (POLYGON, MULTI_POLYGON)), 4, 0)
    ring_size = ring_head + 16 * n_points
    part_head = np.select(
        [part_kind == MULTI_POINT, np.isin(part_kind, (MULTI_LINE, MULTI_POLYGON))], [5, 9], 0
    )
    part_size = part_head + np.bincount(ring_part, ring_size, minlength=len(part_ids)).astype(np.int64)
    row_head = np.where(kinds == POINT, 5, 9)
    body = np.bincount(part_row, part_size, minlength=n).astype(np.int64)
    hollow = valid & (kinds == POINT) & (body == 0)  # POINT EMPTY is written with NaN coordinates
    row_size = np.where(valid, row_head + body + np.where(hollow, 16, 0), 0)
    row_start = np.concatenate([[0], np.cumsum(row_size)])

    out = np.zeros(int(row_start[-1]) + 8, np.uint8)
    u32 = np.ndarray((len(out) - 3,), "<u4", out, strides=(1,))
    f64 = np.ndarray((len(out) - 7,), "<f8", out, strides=(1,))
    rows = np.flatnonzero(valid)
    at = row_start[:-1][rows]
    out[at] = 1
    u32[at + 1] = kinds[rows]
    points_in_row = np.bincount(part_row[ring_part], n_points, minlength=n).astype(np.int64)
    rings_in_row = np.bincount(part_row, n_rings, minlength=n).astype(np.int64)
    totals = np.select([kinds == LINE, kinds == POLYGON], [points_in_row, rings_in_row], n_parts)
    counted = rows[kinds[rows] != POINT]
    u32[row_start[:-1][counted] + 5] = totals[counted]
    empty_at = row_start[:-1][hollow] + 5
    f64[empty_at] = np.nan
    f64[empty_at + 8] = np.nan

    part_cum = np.concatenate([[0], np.cumsum(part_size)])
    first_part = np.concatenate([[0], np.cumsum(n_parts)])[:-1]
    part_start = row_start[:-1][part_row] + row_head[part_row] + part_cum[:-1] - part_cum[first_part[part_row]]
    sub = np.flatnonzero(part_head > 0)
    out[part_start[sub]] = 1
    u32[part_start[sub] + 1] = part_kind[sub] - 3
    points_in_part = np.bincount(ring_part, n_points, minlength=len(part_ids)).astype(np.int64)
    lines, polys = sub[part_kind[sub] == MULTI_LINE], sub[part_kind[sub] == MULTI_POLYGON]
    u32[part_start[lines] + 5] = points_in_part[lines]
    u32[part_start[polys] + 5] = n_rings[polys]

    ring_cum = np.concatenate([[0], np.cumsum(ring_size)])
    first_ring = np.concatenate([[0], np.cumsum(n_rings)])[:-1]
    ring_start = part_start[ring_part] + part_head[ring_part] + ring_cum[:-1] - ring_cum[first_ring[ring_part]]
    headed = np.flatnonzero(ring_head > 0)
    u32[ring_start[headed]] = n_points[headed]
    point_ids = _expand(o3[:-1][ring_ids], n_points)
    within = np.arange(n_points.sum()) - np.repeat(np.cumsum(n_points) - n_points, n_points)
    to = np.repeat(ring_start + ring_head, n_points) + 16 * within
    f64[to], f64[to + 8] = xs[point_ids], ys[point_ids]

    return pa.Array.from_buffers(
        pa.binary(),
        n,
        [
            pa.array(valid).buffers()[1],
            pa.py_buffer(row_start.astype(np.int32).tobytes()),
            pa.py_buffer(out[:-8].tobytes()),
        ],
    )


def _expand(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenation of ``start .. start + count`` ranges."""
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())


# --- exact intersection with one query polygon -------------------------------------------------------


def _cross(ax, ay, bx, by, cx, cy):
    return (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)


def _within(ax, ay, bx, by, px, py):
    """p lies in the box of a-b; with a zero cross product that means on the segment."""
    return (
        (np.minimum(ax, bx) <= px) & (px <= np.maximum(ax, bx)) & (np.minimum(ay, by) <= py) & (py <= np.maximum(ay, by))
    )


def _segments_touch(s, q):
    """Closed segments meet; ``s`` and ``q`` are (x1, y1, x2, y2) that broadcast together."""
    d1 = _cross(q[0], q[1], q[2], q[3], s[0], s[1])
    d2 = _cross(q[0], q[1], q[2], q[3], s[2], s[3])
    d3 = _cross(s[0], s[1], s[2], s[3], q[0], q[1])
    d4 = _cross(s[0], s[1], s[2], s[3], q[2], q[3])
    proper = (np.sign(d1) * np.sign(d2) < 0) & (np.sign(d3) * np.sign(d4) < 0)
    return (
        proper
        | ((d1 == 0) & _within(q[0], q[1], q[2], q[3], s[0], s[1]))
        | ((d2 == 0) & _within(q[0], q[1], q[2], q[3], s[2], s[3]))
        | ((d3 == 0) & _within(s[0], s[1], s[2], s[3], q[0], q[1]))
        | ((d4 == 0) & _within(s[0], s[1], s[2], s[3], q[2], q[3]))
    )


def _ray_hits(px, py, seg):
    """The edge crosses the ray from p to the right (half-open in y, so shared vertices count once)."""
    x1, y1, x2, y2 = seg
    straddles = (y1 > py) != (y2 > py)
    with np.errstate(divide="ignore", invalid="ignore"):
        at = x1 + (py - y1) * (x2 - x1) / (y2 - y1)
    return straddles & (px < at)


class QueryPolygon:
    """A (multi)polygon given as rings of (x, y); even-odd, so inner rings are holes."""

    def __init__(self, polygons: list[list[list[tuple[float, float]]]]):
        edges, corners = [], []
        for rings in polygons:
            corners.append(rings[0][0])
            for ring in rings:
                closed = list(ring) if tuple(ring[0]) == tuple(ring[-1]) else [*ring, ring[0]]
                edges += [(*a, *b) for a, b in zip(closed, closed[1:])]
        self.edges = np.array(edges, float)
        self.corners = np.array(corners, float)
        self.box = (
            float(self.edges[:, [0, 2]].min()),
            float(self.edges[:, [1, 3]].min()),
            float(self.edges[:, [0, 2]].max()),
            float(self.edges[:, [1, 3]].max()),
        )

    def intersects(self, c: Coordinates, block: int = 1 << 21) -> np.ndarray:
        """Per row: some point is shared, boundaries included."""
        hit = np.zeros(len(c.kind), bool)
        point_row = c.point_row
        step = max(1, block // len(self.edges))
        q = tuple(self.edges[:, i][None, :] for i in range(4))
        for lo in range(0, len(c.x), step):  # a vertex inside or on the edge
            px, py = c.x[lo : lo + step, None], c.y[lo : lo + step, None]
            on = (_cross(q[0], q[1], q[2], q[3], px, py) == 0) & _within(q[0], q[1], q[2], q[3], px, py)
            inside = on.any(1) | (_ray_hits(px, py, q).sum(1) % 2 == 1)
            hit[point_row[lo : lo + step][inside]] = True
        seg, seg_row, seg_area = _segments(c)
        todo = np.flatnonzero(~hit[seg_row])
        for lo in range(0, len(todo), step):  # edges that cross
            ids = todo[lo : lo + step]
            meets = _segments_touch(tuple(a[ids, None] for a in seg), q).any(1)
            hit[seg_row[ids[meets]]] = True
        todo = np.flatnonzero(~hit[seg_row] & seg_area)
        for cx, cy in self.corners:  # the query lies inside the geometry
            crossings = np.zeros(len(hit), np.int64)
            some = tuple(a[todo] for a in seg)
            np.add.at(crossings, seg_row[todo], _ray_hits(cx, cy, some))
            hit |= crossings % 2 == 1
        return hit


def _segments(c: Coordinates):
    """All edges of all rings, the row of each, and whether it belongs to a surface."""
    last = np.zeros(len(c.x), bool)
    ends = np.cumsum(c.count)[c.count > 0] - 1
    last[ends] = True
    a = np.flatnonzero(~last)
    return (c.x[a], c.y[a], c.x[a + 1], c.y[a + 1]), c.point_row[a], np.repeat(c.area, c.count)[a]
