"""Operators over the geometry column of a vector table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.functions import geometry as G
from geoloom.functions.geometry import BBOX_NAMES
from geoloom.functions.names import exact
from geoloom.operators.schema import canonical_order, srid_of, with_srid


def refuse_unreadable(df: DataFrame, geom: str = "geom", flag: str = "unreadable") -> DataFrame:
    """``df`` without the flag column; a damaged geometry is an error, never a row that goes missing."""
    wrong = F.raise_error(F.concat(F.lit("geometry cannot be read: "), F.hex(F.substring(geom, 1, 16)))).cast("boolean")
    return df.filter(F.when(F.col(flag), wrong).otherwise(F.lit(True))).drop(flag)


def add_bbox(df: DataFrame, geom: str = "geom", flag: str | None = None) -> DataFrame:
    """Per-row ``xmin, ymin, xmax, ymax`` in native units, one pass over the geometry.

    ``flag`` names a further column that tells whether the bytes could not be read.

    The four columns come out of one generator. A later filter on them therefore stays above it and does
    not make the Arrow function run a second time, while filters on other columns still reach the scan.
    """
    others = [exact(c) for c in df.columns if c not in BBOX_NAMES]
    if flag:
        return df.select(*others, F.inline_outer(F.array(G.checked_bbox(F.col(geom)))).alias(*BBOX_NAMES, flag))
    return df.select(*others, F.inline_outer(F.array(G.wkb_bbox(F.col(geom)))).alias(*BBOX_NAMES))


def drop_null_or_empty_geometry(df: DataFrame, geom: str = "geom") -> DataFrame:
    """Rows with at least one vertex. A table that has its bbox columns is filtered natively."""
    if set(BBOX_NAMES) <= set(df.columns):
        return df.filter(F.col(geom).isNotNull() & F.col("xmin").isNotNull())
    return df.filter(F.col(geom).isNotNull() & G.wkb_bbox(F.col(geom)).isNotNull())


def bbox_corner_filter(df: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    """Rows whose lower corner lies in the box (x0, y0, x1, y1), edges included; pushed to row groups."""
    x0, y0, x1, y1 = box
    return df.filter(F.col("xmin").between(x0, x1) & F.col("ymin").between(y0, y1))


def bbox_overlap_filter(df: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    """Rows whose bbox shares a point with the box; pushed to row groups."""
    x0, y0, x1, y1 = box
    return df.filter(
        (F.col("xmin") <= x1) & (F.col("xmax") >= x0) & (F.col("ymin") <= y1) & (F.col("ymax") >= y0)
    )


def assert_srid(df: DataFrame, epsg: int, geom: str = "geom", srid: str | None = None) -> DataFrame:
    """The query's SRID must be that of the data: schema metadata, or a column checked per row."""
    if srid is None:
        have = srid_of(df, geom)
        if have != epsg:
            raise ValueError(f"Incompatible SRID: data {have}, query {epsg}")
        return df
    wrong = F.raise_error(F.concat(F.lit("Incompatible SRID: data "), F.col(srid).cast("string"), F.lit(f", query {epsg}")))
    same = F.col(srid).eqNullSafe(F.lit(epsg))
    return df.filter(F.when(same, F.lit(True)).otherwise(wrong.cast("boolean")))


def matching_srid(df: DataFrame, epsg: int, srid: str = "srid") -> DataFrame:
    """Only the rows a query in ``epsg`` may be compared with."""
    return df.filter(F.col(srid) == epsg)


def intersects(
    df: DataFrame, polygons: list[list[list[tuple[float, float]]]], epsg: int | None = None, geom: str = "geom"
) -> DataFrame:
    """Rows whose geometry meets the query (multi)polygon.

    Bounds overlap goes to the Parquet scan; only rows that survive it reach the exact Arrow test.
    """
    if epsg is not None:
        assert_srid(df, epsg, geom)
    test, box = G.intersects_polygon(polygons)
    return bbox_overlap_filter(df, box).filter(test(F.col(geom)))


def by_geometry_type(df: DataFrame, family: str, geom: str = "geom") -> DataFrame:
    if family not in ("Point", "LineString", "Polygon"):
        raise ValueError(f"unknown geometry family {family!r}")
    return df.filter(G.geometry_family(F.col(geom)) == family)


def encode_geometry(df: DataFrame, geometry: str = "geometry") -> tuple[DataFrame, DataFrame]:
    """GeoJSON geometry text to WKB ``geom``; rows that cannot be read come back as the second frame.

    A null geometry is no error: the row is kept with a null ``geom``.
    """
    others = [exact(c) for c in df.columns if c != geometry]
    head = df.select("*", F.from_json(geometry, G.GEOJSON_HEAD).alias("_g"))
    kind = F.col("_g.type")
    read = head.select(
        *[exact(c) for c in df.columns],
        G.geojson_code(kind).alias("_code"),
        G.geojson_parts(kind, F.col("_g.coordinates")).alias("_parts"),
    )
    readable = F.col(geometry).isNull() | G.valid_parts(F.col("_parts"))
    # a generator drops unreadable rows without the coordinates being parsed again for a filter
    kept = F.inline(F.when(readable, F.array(F.struct(F.col("_code").alias("_type"), F.col("_parts").alias("_rings")))))
    accepted = read.select(*others, kept.alias("_type", "_rings")).select(
        *others, G.parts_to_wkb(F.col("_type"), F.col("_rings")).alias("geom")
    )
    return accepted, read.filter(~readable).drop("_code", "_parts")


def export_features(df: DataFrame, geom: str = "geom") -> DataFrame:
    """One GeoJSON Feature text per row in column ``value``, ready for ``write.text``.

    A geometry that cannot be written (a collection, damaged bytes) is an error, never a silent null.
    """
    attributes = [c for c in df.columns if c not in (geom, *BBOX_NAMES, "bbox")]
    properties = F.to_json(F.struct(*[exact(c) for c in attributes]), {"ignoreNullFields": "false"})
    decoded = df.withColumn("_parts", G.wkb_parts(F.col(geom)))
    geometry = G.geojson_text(G.wkb_type_code(F.col(geom)), F.col("_parts"))
    refused = F.raise_error(F.lit("geometry cannot be written as GeoJSON")).cast("string")
    geometry = F.when(F.col(geom).isNotNull(), F.coalesce(geometry, refused))
    return decoded.select(
        F.concat(
            F.lit('{"type":"Feature","geometry":'),
            F.coalesce(geometry, F.lit("null")),
            F.lit(',"properties":'),
            properties if attributes else F.lit("{}"),
            F.lit("}"),
        ).alias("value")
    )


def dataset_footprints(bounds: DataFrame, columns: tuple[str, str, str, str] = BBOX_NAMES) -> DataFrame:
    """Adds ``footprint``: the closed rectangle polygon of each row's bounds as WKB."""
    return bounds.withColumn("footprint", G.bbox_polygon_wkb(*[F.col(c) for c in columns]))


def reproject(df: DataFrame, epsg: int, geom: str = "geom") -> DataFrame:
    """Geometry and bbox in longitude/latitude."""
    if epsg in (4326,):
        return with_srid(df, 4326, geom)
    moved = df.withColumn(geom, G.reproject_wkb(epsg)(F.col(geom)))
    return with_srid(canonical_order(add_bbox(moved, geom), geom), 4326, geom)


def union_zones(zones: list[tuple[DataFrame, int]], geom: str = "geom") -> DataFrame:
    """Tables of several UTM zones in one longitude/latitude table."""
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), [reproject(df, epsg, geom) for df, epsg in zones]
    )


def box_geometry(state: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Rectangle polygon by state: ``null`` gives no geometry, ``empty`` an empty polygon."""
    rings = F.when(state == "empty", F.array().cast(G.PARTS_TYPE)).otherwise(F.array(F.array(G.box_ring(x0, y0, x1, y1))))
    return G.parts_to_wkb(F.lit(3), F.when(state != "null", rings))
