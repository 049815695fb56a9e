"""Guards against values that would spoil statistics or map extents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Default extent of a row without a footprint (lon min, lat min, lon max, lat max), and the
# largest latitude and longitude span that is still believable.
REGION_WGS84 = (-4.58, 39.88, -3.05, 41.17)
MAX_LAT_SPAN = 25
MAX_LON_SPAN = 40


def is_finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))


def all_finite(*names: str) -> Column:
    """Whether every one of these columns holds a finite number."""
    known = F.lit(True)
    for name in names:
        known = known & F.coalesce(is_finite(F.col(name)), F.lit(False))
    return known


def finite_guard(value: Column) -> Column:
    """NaN and the infinities become null."""
    return F.when(is_finite(value), value)


def plausible_extent(min_lon: Column, min_lat: Column, max_lon: Column, max_lat: Column) -> Column:
    """True when a box is finite, not empty, not absurdly big and not the all-zero default."""
    d_lon, d_lat = max_lon - min_lon, max_lat - min_lat
    spans = (d_lat > 0) & (d_lat < MAX_LAT_SPAN) & (d_lon > 0) & (d_lon < MAX_LON_SPAN)
    at_zero = (min_lon == 0) & (max_lon == 0)
    finite = is_finite(min_lon) & is_finite(min_lat) & is_finite(max_lon) & is_finite(max_lat)
    return F.coalesce(finite & spans & ~at_zero, F.lit(False))


def region_default(bbox: Column) -> Column:
    """A missing ``xmin,ymin,xmax,ymax`` struct becomes the region box."""
    names = ("xmin", "ymin", "xmax", "ymax")
    region = F.struct(*[F.lit(v).alias(n) for n, v in zip(names, REGION_WGS84)])
    return F.coalesce(bbox, region)


def json_property(document: Column, path: str) -> Column:
    """Text of one JSON path, null when absent."""
    return F.get_json_object(document, path)
