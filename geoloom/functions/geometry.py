"""Arrow functions over WKB columns, and the native expressions around them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoloom.functions import wkb as W
from geoloom.functions.crs import arrays_to_wgs84

BBOX_NAMES = ("xmin", "ymin", "xmax", "ymax")
BBOX_TYPE = T.StructType([T.StructField(n, T.DoubleType()) for n in BBOX_NAMES])
_POINT_TYPE = T.StructType([T.StructField(n, T.DoubleType()) for n in "xy"])
PARTS_TYPE = T.ArrayType(T.ArrayType(T.ArrayType(_POINT_TYPE)))

# GeoJSON type names and their WKB codes.
TYPE_CODES = {
    "Point": 1,
    "LineString": 2,
    "Polygon": 3,
    "MultiPoint": 4,
    "MultiLineString": 5,
    "MultiPolygon": 6,
}


def _bbox_array(c: W.Coordinates) -> pa.Array:
    rows, box = W.bounds(c)
    n = len(c.kind)
    full = np.zeros((n, 4))
    full[rows] = box
    missing = np.ones(n, bool)
    missing[rows] = False
    return pa.StructArray.from_arrays(
        [pa.array(full[:, i]) for i in range(4)], list(BBOX_NAMES), mask=pa.array(missing)
    )


@F.arrow_udf(BBOX_TYPE)
def wkb_bbox(geom: pa.Array) -> pa.Array:
    """Bounds of every geometry; null for null, empty or unreadable values."""
    return _bbox_array(W.read_wkb(geom))


CHECKED_BOX_TYPE = T.StructType([*BBOX_TYPE, T.StructField("unreadable", T.BooleanType())])


@F.arrow_udf(CHECKED_BOX_TYPE)
def checked_bbox(geom: pa.Array) -> pa.Array:
    """Bounds, null where a geometry has none, and whether its bytes could not be read; never null as a whole."""
    c = W.read_wkb(geom)
    box = _bbox_array(c)
    return pa.StructArray.from_arrays([*box.flatten(), pa.array(c.bad)], [*BBOX_NAMES, "unreadable"])


def wgs84_bbox(epsg: int):
    """Arrow function ``geom -> bounds`` of the geometry after every vertex is re-projected."""

    @F.arrow_udf(BBOX_TYPE)
    def bounds(geom: pa.Array) -> pa.Array:
        c = W.read_wkb(geom)
        c.x, c.y = arrays_to_wgs84(c.x, c.y, epsg)
        return _bbox_array(c)

    return bounds


def reproject_wkb(epsg: int):
    """Arrow function ``geom -> geom`` from a supported code to longitude/latitude, vertex by vertex."""

    @F.arrow_udf(T.BinaryType())
    def project(geom: pa.Array) -> pa.Array:
        c = W.read_wkb(geom)
        c.x, c.y = arrays_to_wgs84(c.x, c.y, epsg)
        return W.replace_coordinates(geom, c)

    return project


@F.arrow_udf(PARTS_TYPE)
def wkb_parts(geom: pa.Array) -> pa.Array:
    """Nested coordinates of every geometry; null for null or unreadable values."""
    return W.nested_parts(W.read_wkb(geom))


@F.arrow_udf(T.BinaryType())
def parts_to_wkb(code: pa.Array, parts: pa.Array) -> pa.Array:
    """WKB of nested coordinates and a type code."""
    kinds = np.asarray(code.fill_null(0)).astype(np.int32)
    return W.write_wkb(kinds, parts)


def intersects_polygon(polygons: list[list[list[tuple[float, float]]]]):
    """Arrow function ``geom -> boolean``: exact test against one query (multi)polygon."""
    query = W.QueryPolygon(polygons)

    @F.arrow_udf(T.BooleanType())
    def test(geom: pa.Array) -> pa.Array:
        return pa.array(query.intersects(W.read_wkb(geom)))

    return test, query.box


def wkb_type_code(geom: Column) -> Column:
    """Base type code from the header, native: byte order aware, Z/M and EWKB flags removed."""
    little = F.substring(geom, 1, 1) == F.lit(bytes([1]))

    def number(*at: int) -> Column:
        return F.conv(F.concat(*[F.hex(F.substring(geom, i, 1)) for i in at]), 16, 10).cast("int")

    return F.when(F.length(geom) >= 5, F.when(little, number(3, 2)).otherwise(number(4, 5)) % 1000)


def geometry_family(geom: Column) -> Column:
    """``Point``, ``LineString`` or ``Polygon``; multi geometries count as their base type."""
    code = wkb_type_code(geom)
    return (
        F.when(code.isin(1, 4), "Point").when(code.isin(2, 5), "LineString").when(code.isin(3, 6), "Polygon")
    )


def point_struct(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def point_wkb(x: Column, y: Column) -> Column:
    return parts_to_wkb(F.lit(1), F.array(F.array(F.array(point_struct(x, y)))))


def line_wkb(points: Column) -> Column:
    """LineString from an array of x,y structs."""
    return parts_to_wkb(F.lit(2), F.array(F.array(points)))


def box_ring(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Closed ring of five corners, starting at the lower left and going along x first."""
    corners = ((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))
    return F.array(*[point_struct(x, y) for x, y in corners])


def bbox_polygon_wkb(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return parts_to_wkb(F.lit(3), F.array(F.array(box_ring(x0, y0, x1, y1))))


def vertices(geom: Column) -> Column:
    """Flat array of x,y structs of all vertices."""
    return F.flatten(F.flatten(wkb_parts(geom)))


def _points(array_of_pairs: Column) -> Column:
    return F.transform(array_of_pairs, lambda p: point_struct(F.get(p, 0), F.get(p, 1)))


GEOJSON_HEAD = "type string, coordinates string"


def geojson_code(kind: Column) -> Column:
    out = F.lit(None).cast("int")
    for name, code in TYPE_CODES.items():
        out = F.when(kind == name, F.lit(code)).otherwise(out)
    return out


def geojson_parts(kind: Column, coords: Column) -> Column:
    """Nested coordinates from GeoJSON type and coordinate text; the JVM reads the text once, at its depth."""
    depth1 = F.from_json(coords, "array<double>")
    depth2 = F.from_json(coords, "array<array<double>>")
    depth3 = F.from_json(coords, "array<array<array<double>>>")
    depth4 = F.from_json(coords, "array<array<array<array<double>>>>")

    def alone(p: Column) -> Column:
        return F.array(F.array(p))

    filled = F.filter(F.array(depth1), lambda p: p.isNull() | (F.size(p) > 0))
    return (
        F.when(kind == "Point", F.transform(_points(filled), alone))
        .when(kind == "LineString", F.array(F.array(_points(depth2))))
        .when(kind == "MultiPoint", F.transform(_points(depth2), alone))
        .when(kind == "Polygon", F.array(F.transform(depth3, _points)))
        .when(kind == "MultiLineString", F.transform(depth3, lambda line: F.array(_points(line))))
        .when(kind == "MultiPolygon", F.transform(depth4, lambda poly: F.transform(poly, _points)))
    )


def valid_parts(parts: Column) -> Column:
    """All coordinates present (a text that is no number reads as null)."""
    flat = F.flatten(F.flatten(parts))
    return parts.isNotNull() & F.coalesce(F.forall(flat, lambda p: p.x.isNotNull() & p.y.isNotNull()), F.lit(False))


def _json_array(points: Column) -> Column:
    return F.transform(points, lambda p: F.array(p.x, p.y))


def geojson_text(code: Column, parts: Column) -> Column:
    """GeoJSON geometry text, native, from nested coordinates."""
    first = F.get(parts, 0)
    pairs = F.transform(parts, lambda part: F.transform(part, _json_array))
    line = _json_array(F.get(first, 0))
    body = (
        F.when(code == 1, F.to_json(F.coalesce(F.get(line, 0), F.array().cast("array<double>"))))
        .when(code == 2, F.to_json(F.coalesce(line, F.array().cast("array<array<double>>"))))
        .when(code == 3, F.to_json(F.coalesce(F.get(pairs, 0), F.array().cast("array<array<array<double>>>"))))
        .when(code == 4, F.to_json(F.transform(pairs, lambda part: F.get(F.get(part, 0), 0))))
        .when(code == 5, F.to_json(F.transform(pairs, lambda part: F.get(part, 0))))
        .when(code == 6, F.to_json(pairs))
    )
    name = F.lit(None).cast("string")
    for text, number in TYPE_CODES.items():
        name = F.when(code == number, F.lit(text)).otherwise(name)
    return F.concat(F.lit('{"type":"'), name, F.lit('","coordinates":'), body, F.lit("}"))
