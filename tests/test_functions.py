"""Projection, bounds, curve and text functions."""

import math
import struct

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from geoloom.functions import bounds as B
from geoloom.functions import crs
from geoloom.functions import guards as GU
from geoloom.functions import text as TX
from geoloom.functions.hilbert import hilbert_index
from geoloom.operators import schema as S


def forward(lon, lat, zone):
    """Independent forward projection (Krueger series with the alpha coefficients)."""
    n = crs.third_flattening()
    alpha = (
        n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180,
        13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440,
        61 * n**3 / 240 - 103 * n**4 / 140,
        49561 * n**4 / 161280,
    )
    e = math.sqrt(crs.FLATTENING * (2 - crs.FLATTENING))
    phi, lam = math.radians(lat), math.radians(lon - crs.central_meridian(zone))
    t = math.sinh(math.atanh(math.sin(phi)) - e * math.atanh(e * math.sin(phi)))
    xi, eta = math.atan2(t, math.cos(lam)), math.asinh(math.sin(lam) / math.hypot(t, math.cos(lam)))
    x, y = eta, xi
    for j, a in enumerate(alpha, 1):
        x += a * math.cos(2 * j * xi) * math.sinh(2 * j * eta)
        y += a * math.sin(2 * j * xi) * math.cosh(2 * j * eta)
    k = crs.SCALE_FACTOR * crs.rectifying_radius()
    return crs.FALSE_EASTING + k * x, k * y


@settings(max_examples=200, deadline=None)
@given(st.floats(-6.5, 0.5), st.floats(0.0, 80.0))
def test_projection_round_trip(lon, lat):
    x, y = forward(lon, lat, 30)
    back = crs.arrays_to_wgs84(np.array([x]), np.array([y]), 25830)
    assert abs(back[0][0] - lon) < 1e-9 and abs(back[1][0] - lat) < 1e-9


def test_known_values():
    # on the central meridian at the equator, and the scaled meridian quadrant of GRS80 (10001965.729 m)
    lon, lat = crs.arrays_to_wgs84(np.array([500000.0, 500000.0]), np.array([0.0, 10001965.729 * 0.9996]), 25830)
    assert abs(lon[0] + 3) < 1e-12 and abs(lat[0]) < 1e-12 and abs(lat[1] - 90) < 1e-7


def test_southern_zone_and_unknown_code():
    lon, lat = crs.arrays_to_wgs84(np.array([500000.0]), np.array([10000000.0]), 32733)
    assert abs(lat[0]) < 1e-12 and lon[0] == 15.0
    with pytest.raises(ValueError):
        crs.utm_zone(3857)


def test_columns_and_arrays_agree(spark):
    xs, ys = [440290.5, 499999.0, 400000.0], [4474250.25, 4430000.0, 4529999.0]
    lon, lat = crs.utm_to_wgs84(F.col("x"), F.col("y"))
    rows = spark.createDataFrame(list(zip(xs, ys)), "x double, y double").select(lon, lat).collect()
    want = crs.arrays_to_wgs84(np.array(xs), np.array(ys), 25830)
    assert np.allclose([r[0] for r in rows], want[0], atol=1e-12) and np.allclose([r[1] for r in rows], want[1], atol=1e-12)


# --- bounds -------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "kind, text, upper, want",
    [
        ("int", "-2", False, struct.pack("<i", -2)),
        ("long", "5000000000", True, struct.pack("<q", 5000000000)),
        ("float", "1.5", False, struct.pack("<f", 1.5)),
        ("double", "-0.25", True, struct.pack("<d", -0.25)),
        ("boolean", "true", True, b"\x01"),
        ("string", "ñandú", False, "ñandú".encode()),
        ("geometry", "1.0 2.5", False, struct.pack("<dd", 1.0, 2.5)),
        ("double", "NaN", False, None),
        ("double", "Infinity", True, None),
        ("geometry", "NaN 2.0", True, None),
        ("int", None, True, None),
        ("int", "9999999999", True, None),
    ],
)
def test_encoded_bound(kind, text, upper, want):
    assert B.encode(kind, text, upper)[0] == want


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_cut_texts_still_bound_the_value(text):
    lower, _ = B.encode("string", text, False)
    upper, _ = B.encode("string", text, True)
    assert lower <= text.encode() and (upper is None or upper >= text.encode())
    assert len(lower.decode()) <= 32


def test_largest_prefix_has_no_bound():
    assert B.encode("string", "\U0010ffff" * 40, True) == (None, False)
    assert B.next_prefix("a\U0010ffff") == "b" and B.next_prefix("퟿") == ""


def test_placeholders():
    assert B.placeholder("string") == (b"", b"~")
    assert B.placeholder("boolean") == (b"\x00", b"\x00")
    assert [len(B.placeholder(k)[0]) for k in ("int", "long", "float", "double", "geometry")] == [4, 8, 4, 8, 16]


# --- curve --------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("bits", [1, 2, 5, 8])
def test_curve_visits_every_cell_through_neighbours(bits):
    n = 1 << bits
    x, y = (a.ravel() for a in np.meshgrid(np.arange(n), np.arange(n)))
    d = hilbert_index(x, y, bits)
    assert sorted(d.tolist()) == list(range(n * n))
    order = np.argsort(d)
    assert (np.abs(np.diff(x[order])) + np.abs(np.diff(y[order])) == 1).all()


# --- text ---------------------------------------------------------------------------------------------------


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "text, want",
    [
        ("red_de_agua", "Red De Agua"),
        ("poblacion__tab", "Poblacion (Tabla)"),
        ("a__b__tab__tab", "A  B  Tab (Tabla)"),
        ("baño", "BañO"),
        ("x (y) 3d", "X (Y) 3d"),
        ("", ""),
    ],
)
def test_humanise(spark, text, want):
    assert one(spark, TX.humanise, text) == want


def test_slug_cuts_after_stripping(spark):
    text = "--" + "a" * 79 + " b"
    assert one(spark, lambda c: TX.slug(c, "package"), text) == "a" * 79 + "_"
    assert one(spark, lambda c: TX.slug(c, "layer"), "WS:Ríos y Lagos ") == "r_os_y_lagos"
    again = lambda c: TX.slug(TX.slug(c, "coverage"), "coverage")
    assert one(spark, again, "A__b!") == one(spark, lambda c: TX.slug(c, "coverage"), "A__b!")


def test_coverage_theme_of_leading_separator(spark):
    assert one(spark, TX.coverage_theme, "__x") == ""
    assert one(spark, TX.coverage_theme, "Zonas__a__b") == "Zonas"


def test_s3_uri_only_first(spark):
    p = TX.HTTP_STORE_PREFIX
    assert one(spark, TX.s3_uri, f"{p}a?u={p}b") == f"s3://a?u={p}b"
    assert one(spark, TX.s3_uri, "ftp://x") == "ftp://x"


def test_raster_before_remote(spark):
    assert one(spark, TX.classify_by_href, "s3://b/data/raster/x.parquet") == "raster"
    assert one(spark, TX.classify_by_href, "s3://b/x.parquet") == "remote"


@pytest.mark.parametrize(
    "value, want",
    [(1e-5, "1e-05"), (1.5e-4, "0.00015"), (1e7, "10000000.0"), (1.25e8, "125000000.0"), (1e16, "1e+16"), (-1.5e-7, "-1.5e-07"), (0.0, "0.0"), (123456789.123, "123456789.123"), (float("inf"), "inf")],
)
def test_number_text(spark, value, want):
    assert one(spark, S.number_text, value, "double") == want


def test_lowercase_collisions():
    assert S.lowercase(["a", "A"]) == ["a", "a_1"]
    assert S.lowercase(["a", "a_2", "A"]) == ["a", "a_2", "a_2_2"]
    assert S.lowercase(["X", "y", "x", "Y"]) == ["x", "y", "x_2", "y_3"]


def test_region_and_extent_guards(spark):
    df = spark.createDataFrame([(-3.7, 40.0, -3.6, float("nan")), (0.0, 0.0, 0.0, 1.0), (-3.7, 40.0, -3.6, 40.1)], "a double, b double, c double, d double")
    assert [r[0] for r in df.select(GU.plausible_extent(*[F.col(c) for c in "abcd"])).collect()] == [False, False, True]
