"""Frames and SQL pieces that several check modules share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import fixture
from geoloom.functions import crs
from geoloom.functions import geometry as G
from geoloom.operators import geometry as OG
from geoloom.operators.schema import with_srid

EPSG = 25830


def boxes(spark: SparkSession, sf: str) -> DataFrame:
    """Box fixture as a vector table: id, part_key, attr, geom."""
    f = fixture(spark, sf, "F2")
    c = F.col
    geom = OG.box_geometry(c("geom_state"), c("x0"), c("y0"), c("x0") + c("w"), c("y0") + c("h"))
    return with_srid(f.select("id", "part_key", "attr", geom.alias("geom")), EPSG)


def boxes_with_bbox(spark: SparkSession, sf: str) -> DataFrame:
    return OG.add_bbox(boxes(spark, sf))


def boxes_with_struct(spark: SparkSession, sf: str) -> DataFrame:
    df = boxes(spark, sf)
    return df.withColumn("bbox", G.wkb_bbox(F.col("geom")))


def points(spark: SparkSession, sf: str) -> DataFrame:
    f = fixture(spark, sf, "F1")
    return with_srid(f.select("id", "attr", G.point_wkb(F.col("x"), F.col("y")).alias("geom")), EPSG)


def lines(spark: SparkSession, sf: str) -> DataFrame:
    """Line fixture: at most one thousand vertices per line, in sequence order."""
    f = fixture(spark, sf, "F3")
    ordered = F.sort_array(F.collect_list(F.struct("seq", "x", "y")))
    pts = F.transform(ordered, lambda p: G.point_struct(p.x, p.y))
    return f.groupBy("line_id").agg(G.line_wkb(pts).alias("geom"))


# Shapes of the box fixture that have a geometry, with their bounds.
LIVE_BOXES = (
    "(select id, part_key, attr, x0 as xmin, y0 as ymin, x0 + w as xmax, y0 + h as ymax"
    " from $F2 where geom_state = 'polygon')"
)


def wgs84_sql(source: str, zone: str = "30") -> str:
    """Sub-query that adds ``lon`` and ``lat`` to a source with easting ``x`` and northing ``y``."""
    beta, delta = crs.inverse_series()
    k = repr(crs.SCALE_FACTOR * crs.rectifying_radius())
    xi_s = "xi" + "".join(f" - ({b!r}) * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, b in enumerate(beta, 1))
    eta_s = "eta" + "".join(f" - ({b!r}) * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, b in enumerate(beta, 1))
    lat = "chi" + "".join(f" + ({d!r}) * sin({2 * j} * chi)" for j, d in enumerate(delta, 1))
    return (
        f"(select *, degrees({lat}) as lat, degrees(atan2(sinh(es), cos(xs))) + 6.0 * ({zone}) - 183.0 as lon from"
        f" (select *, asin(sin(xs) / cosh(es)) as chi from"
        f" (select *, {xi_s} as xs, {eta_s} as es from"
        f" (select *, y / {k} as xi, (x - 500000.0) / {k} as eta from {source}))))"
    )
