"""Binary column bounds: the bytes a table manifest carries for each column."""

from __future__ import annotations

import math
import struct

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

STRING_BOUND_CHARS = 32
ENCODED_TYPE = T.StructType(
    [T.StructField("bytes", T.BinaryType()), T.StructField("ok", T.BooleanType()), T.StructField("exact", T.BooleanType())]
)

# Byte layout per published type, little-endian.
_LAYOUT = {"int": "<i", "long": "<q", "float": "<f", "double": "<d", "boolean": "<?"}


def next_prefix(prefix: str) -> str | None:
    """Smallest text above every text that starts with ``prefix``; null when there is none."""
    for at in range(len(prefix) - 1, -1, -1):
        code = ord(prefix[at]) + 1
        if code == 0xD800:
            code = 0xE000
        if code <= 0x10FFFF:
            return prefix[:at] + chr(code)
    return None


def encode(kind: str, text: str | None, upper: bool) -> tuple[bytes | None, bool]:
    """(bytes, exact) of one bound given as text; no bytes where the value cannot be a bound."""
    if text is None:
        return None, True
    if kind == "string":
        if len(text) <= STRING_BOUND_CHARS:
            return text.encode(), True
        cut = text[:STRING_BOUND_CHARS]
        cut = next_prefix(cut) if upper else cut
        return (None if cut is None else cut.encode()), False
    try:
        if kind == "geometry":
            pair = [float(v) for v in text.split(" ")]
            return (struct.pack("<dd", *pair) if all(map(math.isfinite, pair)) else None), True
        if kind == "boolean":
            return struct.pack("<?", text == "true"), True
        value = float(text) if kind in ("float", "double") else int(text)
        if not math.isfinite(value):
            return None, True
        return struct.pack(_LAYOUT[kind], value), True
    except (ValueError, OverflowError, KeyError, struct.error):
        return None, True


def placeholder(kind: str) -> tuple[bytes, bytes]:
    """Lower and upper bytes for a column without usable bounds."""
    if kind == "string":
        return b"", b"~"
    if kind == "geometry":
        zero = struct.pack("<dd", 0.0, 0.0)
    else:
        zero = struct.pack(_LAYOUT.get(kind, "<d"), 0)
    return zero, zero


def _encoder(upper: bool):
    @F.arrow_udf(ENCODED_TYPE)
    def encode_bound(kind: pa.Array, text: pa.Array) -> pa.Array:
        # Statistics rows only: one per file and column, never one per data row.
        out = [encode(k, t, upper) for k, t in zip(kind.to_pylist(), text.to_pylist())]
        return pa.array([{"bytes": b, "ok": b is not None, "exact": e} for b, e in out], pa.struct(
            [("bytes", pa.binary()), ("ok", pa.bool_()), ("exact", pa.bool_())]))

    return encode_bound


encode_lower = _encoder(False)
encode_upper = _encoder(True)


def placeholder_column(kind, upper: bool):
    """The placeholder pair as a native expression."""
    out = F.lit(bytearray(placeholder("double")[upper]))
    for name in ("string", "geometry", "int", "long", "float", "double", "boolean"):
        out = F.when(kind == name, F.lit(bytearray(placeholder(name)[upper]))).otherwise(out)
    return out
