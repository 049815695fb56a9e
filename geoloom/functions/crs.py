"""Universal Transverse Mercator to longitude/latitude as native Column arithmetic.

The inverse is the closed Krueger series in the third flattening (Karney, "Transverse Mercator with an
accuracy of a few nanometers", 2011), so no iteration and no Python worker is involved.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# GRS80 ellipsoid and the UTM projection.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257222101
SCALE_FACTOR = 0.9996
FALSE_EASTING = 500000.0
FALSE_NORTHING_SOUTH = 10000000.0

# Codes already in degrees (ETRS89 is taken as equal to WGS84).
GEOGRAPHIC_EPSG = (4326, 4258)

# EPSG ranges whose last two digits are the zone: ETRS89 north, WGS84 north, WGS84 south.
_UTM_EPSG = ((25800, False), (32600, False), (32700, True))


def third_flattening() -> float:
    return FLATTENING / (2 - FLATTENING)


def rectifying_radius() -> float:
    n = third_flattening()
    return SEMI_MAJOR / (1 + n) * (1 + n**2 / 4 + n**4 / 64)


def inverse_series() -> tuple[tuple[float, ...], tuple[float, ...]]:
    """(beta, delta): plane to sphere, and conformal to geodetic latitude, to fourth order."""
    n = third_flattening()
    beta = (
        n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360,
        n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440,
        17 * n**3 / 480 - 37 * n**4 / 840,
        4397 * n**4 / 161280,
    )
    delta = (
        2 * n - 2 * n**2 / 3 - 2 * n**3 + 116 * n**4 / 45,
        7 * n**2 / 3 - 8 * n**3 / 5 - 227 * n**4 / 45,
        56 * n**3 / 15 - 136 * n**4 / 35,
        4279 * n**4 / 630,
    )
    return beta, delta


def utm_zone(epsg: int) -> tuple[int, bool]:
    """(zone, southern) of a UTM EPSG code."""
    for base, south in _UTM_EPSG:
        if 1 <= epsg - base <= 60:
            return epsg - base, south
    raise ValueError(f"EPSG:{epsg} is not a UTM code this library can project")


def central_meridian(zone: int) -> float:
    return 6.0 * zone - 183.0


def _inverse(x, y, zone: int, south: bool, m):
    """(longitude, latitude) in degrees; ``m`` supplies the functions: Spark's for Columns, numpy for arrays."""
    beta, delta = inverse_series()
    k = SCALE_FACTOR * rectifying_radius()
    xi = (y - (FALSE_NORTHING_SOUTH if south else 0.0)) / k
    eta = (x - FALSE_EASTING) / k
    xi_s, eta_s = xi, eta
    for j, b in enumerate(beta, 1):
        xi_s = xi_s - m.sin(xi * (2.0 * j)) * m.cosh(eta * (2.0 * j)) * b
        eta_s = eta_s - m.cos(xi * (2.0 * j)) * m.sinh(eta * (2.0 * j)) * b
    chi = m.asin(m.sin(xi_s) / m.cosh(eta_s))
    lat = chi
    for j, d in enumerate(delta, 1):
        lat = lat + m.sin(chi * (2.0 * j)) * d
    lon = m.degrees(m.atan2(m.sinh(eta_s), m.cos(xi_s))) + central_meridian(zone)
    return lon, m.degrees(lat)


def utm_to_wgs84(x: Column, y: Column, zone: int = 30, south: bool = False) -> tuple[Column, Column]:
    """(longitude, latitude) in degrees of one easting/northing pair, native."""
    return _inverse(x, y, zone, south, F)


def arrays_to_wgs84(x: np.ndarray, y: np.ndarray, epsg: int) -> tuple[np.ndarray, np.ndarray]:
    """The same series over coordinate arrays, for geometry that is already in a Python worker."""
    if epsg in GEOGRAPHIC_EPSG:
        return x, y
    zone, south = utm_zone(epsg)
    return _inverse(x, y, zone, south, np)


def to_wgs84(x: Column, y: Column, epsg: int) -> tuple[Column, Column]:
    """Longitude/latitude from any supported code; geographic codes pass through."""
    if epsg in GEOGRAPHIC_EPSG:
        return x, y
    zone, south = utm_zone(epsg)
    return utm_to_wgs84(x, y, zone, south)


def planar_distance(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Distance in the units of the native CRS."""
    return F.hypot(ax - bx, ay - by)


def domain(epsg: int) -> tuple[float, float, float, float]:
    """Box that holds every coordinate of a code. A curve over it is the same for every dataset and batch."""
    if epsg in GEOGRAPHIC_EPSG:
        return -180.0, -90.0, 180.0, 90.0
    utm_zone(epsg)
    return 0.0, 0.0, 1_000_000.0, FALSE_NORTHING_SOUTH
