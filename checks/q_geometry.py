"""Geometry, projection, spatial filters and layout."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import common as C
from checks.registry import fixture, query
from geoloom.functions import crs
from geoloom.functions import geometry as G
from geoloom.operators import geometry as OG
from geoloom.operators import layout as L
from geoloom.operators import schema as S

TRIANGLE = [[[(410000.0, 4440000.0), (470000.0, 4450000.0), (430000.0, 4510000.0)]]]
CORNER_BOX = (410000.0, 4440000.0, 450000.0, 4480000.0)


def _feature_text(f):
    ring = F.concat(
        *[
            F.concat(F.lit(p), F.format_string("%s", x.cast("string")), F.lit(","), y.cast("string"), F.lit("]"))
            for p, x, y in (
                ("[", F.col("x0"), F.col("y0")),
                (",[", F.col("x0") + F.col("w"), F.col("y0")),
                (",[", F.col("x0") + F.col("w"), F.col("y0") + F.col("h")),
                (",[", F.col("x0"), F.col("y0") + F.col("h")),
                (",[", F.col("x0"), F.col("y0")),
            )
        ]
    )
    polygon = F.concat(F.lit('{"type":"Polygon","coordinates":[['), ring, F.lit("]]}"))
    return (
        F.when(F.col("geom_state") == "null", F.lit(None).cast("string"))
        .when(F.col("geom_state") == "empty", F.lit('{"type":"Polygon","coordinates":[]}'))
        .when(F.col("id") % 29 == 0, F.lit('{"type":"Polygon","coordinates":[[["oops",1]]]}'))
        .when(F.col("id") % 31 == 0, F.lit('{"type":"Circle","coordinates":[1,2]}'))
        .otherwise(polygon)
    )


@query(
    "p12_encode_geometry",
    "select id, case when geom_state = 'null' then 'ok' when geom_state = 'empty' then 'ok'"
    " when id % 29 = 0 or id % 31 = 0 then 'rejected' else 'ok' end as status,"
    " case when geom_state = 'null' then null when geom_state = 'empty' then 9"
    " when id % 29 = 0 or id % 31 = 0 then null else 93 end as bytes from $F2",
)
def p12(spark, sf):
    f = fixture(spark, sf, "F2")
    good, bad = OG.encode_geometry(f.select("id", _feature_text(f).alias("geometry")))
    return good.select("id", F.lit("ok").alias("status"), F.octet_length("geom").alias("bytes")).unionByName(
        bad.select("id", F.lit("rejected").alias("status"), F.lit(None).cast("int").alias("bytes"))
    )


@query(
    "p13_export_features",
    "select id, attr, case when geom_state <> 'null' then 'Polygon' end as kind,"
    " case when geom_state = 'polygon' then x0 + w end as x, case when geom_state = 'polygon' then y0 + h end as y from $F2",
)
def p13(spark, sf):
    features = OG.export_features(C.boxes(spark, sf).select("id", "attr", "geom"))
    v = F.col("value")
    return features.select(
        F.get_json_object(v, "$.properties.id").cast("bigint").alias("id"),
        F.get_json_object(v, "$.properties.attr").cast("double").alias("attr"),
        F.get_json_object(v, "$.geometry.type").alias("kind"),
        F.get_json_object(v, "$.geometry.coordinates[0][2][0]").cast("double").alias("x"),
        F.get_json_object(v, "$.geometry.coordinates[0][2][1]").cast("double").alias("y"),
    )


@query(
    "p14_dataset_footprints",
    "select part_key, c.i as i, case when c.i in (0, 3, 4) then xmin else xmax end as x,"
    " case when c.i in (0, 1, 4) then ymin else ymax end as y from"
    f" (select part_key, min(xmin) xmin, min(ymin) ymin, max(xmax) xmax, max(ymax) ymax from {C.LIVE_BOXES} group by 1)"
    " cross join (values (0), (1), (2), (3), (4)) c(i)",
)
def p14(spark, sf):
    from geoloom.operators.stats import geometry_bounds

    bounds = geometry_bounds(C.boxes_with_bbox(spark, sf), ("part_key",))
    ring = F.posexplode(G.vertices(F.col("footprint"))).alias("i", "p")
    return OG.dataset_footprints(bounds).select("part_key", ring).select("part_key", "i", "p.x", "p.y")


@query("p15_utm_to_wgs84", f"select id, round(lon, 7) as lon, round(lat, 7) as lat from {C.wgs84_sql('$F1')}")
def p15(spark, sf):
    lon, lat = crs.utm_to_wgs84(F.col("x"), F.col("y"), 30)
    return fixture(spark, sf, "F1").select("id", F.round(lon, 7).alias("lon"), F.round(lat, 7).alias("lat"))


@query(
    "p16_union_zones",
    f"select id, 4326 as srid, round(lon, 7) as lon, round(lat, 7) as lat from {C.wgs84_sql('$F1', '29 + id % 3')}",
)
def p16(spark, sf):
    df = C.points(spark, sf)
    zones = [(df.filter(F.col("id") % 3 == k), 25829 + k) for k in range(3)]
    out = OG.union_zones(zones)
    return out.select(
        "id", F.lit(S.srid_of(out)).alias("srid"), F.round("xmin", 7).alias("lon"), F.round("ymax", 7).alias("lat")
    )


@query(
    "p17_planar_distance",
    "select id, round(sqrt((x - 440000.0) * (x - 440000.0) + (y - 4474000.0) * (y - 4474000.0)), 4) as metres from $F1",
)
def p17(spark, sf):
    d = crs.planar_distance(F.col("x"), F.col("y"), F.lit(440000.0), F.lit(4474000.0))
    return fixture(spark, sf, "F1").select("id", F.round(d, 4).alias("metres"))


@query("f01_drop_null_or_empty", f"select id from {C.LIVE_BOXES}")
def f01(spark, sf):
    return OG.drop_null_or_empty_geometry(C.boxes(spark, sf)).select("id")


@query(
    "f02_bbox_corner_filter",
    f"select id, xmin, ymin from {C.LIVE_BOXES} where xmin between 410000 and 450000 and ymin between 4440000 and 4480000",
)
def f02(spark, sf):
    return OG.bbox_corner_filter(C.boxes_with_bbox(spark, sf), CORNER_BOX).select("id", "xmin", "ymin")


def _triangle_sql() -> str:
    """Closed box-triangle overlap by separating axes: two box axes and the three edge normals."""
    pts = TRIANGLE[0][0]
    tests = [
        f"xmin <= {max(p[0] for p in pts)} and xmax >= {min(p[0] for p in pts)}",
        f"ymin <= {max(p[1] for p in pts)} and ymax >= {min(p[1] for p in pts)}",
    ]
    for (ax, ay), (bx, by) in zip(pts, pts[1:] + pts[:1]):
        nx, ny = by - ay, ax - bx
        mine = [nx * x + ny * y for x, y in pts]
        corners = ", ".join(f"({nx}) * {x} + ({ny}) * {y}" for x in ("xmin", "xmax") for y in ("ymin", "ymax"))
        tests.append(f"least({corners}) <= {max(mine)} and greatest({corners}) >= {min(mine)}")
    return " and ".join(tests)


@query("f03_intersects", f"select id, part_key, attr from {C.LIVE_BOXES} where {_triangle_sql()}")
def f03(spark, sf):
    return OG.intersects(C.boxes_with_bbox(spark, sf), TRIANGLE, C.EPSG).select("id", "part_key", "attr")


@query(
    "f03_intersects_points",
    "select id from (select id, x as xmin, x as xmax, y as ymin, y as ymax from $F1) where " + _triangle_sql(),
)
def f03_points(spark, sf):
    return OG.intersects(OG.add_bbox(C.points(spark, sf)), TRIANGLE, C.EPSG).select("id")


@query("f04_assert_srid", "select count(*) as n, cast(sum(id) as bigint) as ids from $F2 where id % 3 = 0")
def f04(spark, sf):
    srid = F.when(F.col("id") % 3 == 0, F.lit(25830)).otherwise(F.lit(4326))
    df = C.boxes(spark, sf).withColumn("srid", srid)
    same = OG.matching_srid(df, 25830)
    checked = OG.assert_srid(OG.assert_srid(same, 25830), 25830, srid="srid")
    return checked.agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("ids"))


@query(
    "f12_by_geometry_type",
    "select 'Polygon' as family, count(*) as n from $F2 where geom_state <> 'null' union all"
    " select 'Point', count(*) from $F1 union all select 'LineString', count(distinct line_id) from $F3",
)
def f12(spark, sf):
    every = C.boxes(spark, sf).select("geom").unionByName(C.points(spark, sf).select("geom")).unionByName(
        C.lines(spark, sf).select("geom")
    )
    parts = [
        OG.by_geometry_type(every, family).agg(F.count(F.lit(1)).alias("n")).select(F.lit(family).alias("family"), "n")
        for family in ("Point", "LineString", "Polygon")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "o01_preview",
    "select id, part_key, attr from $F2 order by id limit 100",
)
def o01(spark, sf):
    return L.preview(C.boxes_with_bbox(spark, sf), ["id"])


@query(
    "o02_sample_geometries",
    "select id, round(min(lon), 7) as min_lon, round(max(lat), 7) as max_lat from "
    + C.wgs84_sql(
        "(select b.id, case when c.i in (0, 3) then x0 else x0 + w end as x, case when c.i in (0, 1) then y0 else y0 + h end as y"
        " from (select * from $F2 where geom_state = 'polygon' order by id limit 2000) b"
        " cross join (values (0), (1), (2), (3)) c(i))"
    )
    + " group by id",
)
def o02(spark, sf):
    df = OG.drop_null_or_empty_geometry(C.boxes_with_bbox(spark, sf))
    out = L.sample_geometries(df, C.EPSG, ["id"])
    return out.select("id", F.round("xmin", 7).alias("min_lon"), F.round("ymax", 7).alias("max_lat"))


@query("o04_hilbert_sort", f"select id, xmin, ymin from {C.LIVE_BOXES}")
def o04(spark, sf):
    df = OG.drop_null_or_empty_geometry(C.boxes_with_bbox(spark, sf))
    return L.hilbert_sort(df, (400000.0, 4430000.0, 500000.0, 4530000.0)).select("id", "xmin", "ymin")
