"""Position along the Hilbert curve for whole Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T


def hilbert_index(x: np.ndarray, y: np.ndarray, bits: int) -> np.ndarray:
    """Curve position of integer cells in a ``2^bits`` square, all rows at once."""
    x, y = x.astype(np.int64), y.astype(np.int64)
    d = np.zeros(len(x), np.int64)
    for level in range(bits - 1, -1, -1):
        s = np.int64(1) << level
        rx, ry = (x & s) > 0, (y & s) > 0
        d += s * s * ((3 * rx.astype(np.int64)) ^ ry)
        # turn the quadrant so that the next level is entered at the right corner
        x, y = x & (s - 1), y & (s - 1)
        flip = ~ry & rx
        x, y = np.where(flip, s - 1 - x, x), np.where(flip, s - 1 - y, y)
        x, y = np.where(ry, x, y), np.where(ry, y, x)
    return d


def hilbert_key(extent: tuple[float, float, float, float], bits: int = 16):
    """Arrow function (x, y) -> curve position within ``extent``; null where a coordinate is missing."""
    if not 1 <= bits <= 31:
        raise ValueError("bits must be 1..31")
    x0, y0, x1, y1 = extent
    cells = (1 << bits) - 1

    def scale(v: pa.Array, lo: float, hi: float) -> np.ndarray:
        a = np.asarray(v.cast(pa.float64()).fill_null(np.nan), float)
        span = (hi - lo) or 1.0
        return np.clip(np.nan_to_num((a - lo) / span * cells), 0, cells)

    @F.arrow_udf(T.LongType())
    def key(x: pa.Array, y: pa.Array) -> pa.Array:
        known = np.asarray(x.is_valid()) & np.asarray(y.is_valid())
        return pa.array(hilbert_index(scale(x, x0, x1), scale(y, y0, y1), bits), mask=~known)

    return key
