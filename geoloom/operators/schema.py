"""Names, types, column order, field ids and descriptions."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoloom.functions.geometry import BBOX_NAMES
from geoloom.functions.names import exact

FIELD_ID = "parquet.field.id"
DOC_BYTES = 300
DEFAULT_EPSG = 4326

# Spark type -> published type name. Everything else is published as text.
TYPE_NAMES = {
    T.StringType: "string",
    T.IntegerType: "int",
    T.LongType: "long",
    T.DoubleType: "double",
    T.FloatType: "float",
    T.BooleanType: "boolean",
}
_SMALL_INTS = (T.ByteType, T.ShortType)
_STAMPS = (T.TimestampType, T.TimestampNTZType)
_TEMPORAL = (T.DateType, *_STAMPS, T.TimeType, T.DayTimeIntervalType, T.YearMonthIntervalType)


def _positional(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """The frame with unambiguous names, so that ``a`` and ``A`` can both be addressed."""
    names = [f"_c{i}" for i in range(len(df.columns))]
    return df.toDF(*names), names


def _rebuild(df: DataFrame, columns: list[tuple[str, Column | None]]) -> DataFrame:
    """One select by position; ``None`` keeps the column as it is."""
    flat, names = _positional(df)
    picked = [F.col(n) if c is None else c for n, (_, c) in zip(names, columns, strict=True)]
    return flat.select(*[c.alias(n) for c, n in zip(picked, names)]).toDF(*[n for n, _ in columns])


def blob_text(value: Column) -> Column:
    """Binary as text: printable ASCII as is, every other byte as ``\\xHH``."""

    def show(i: Column) -> Column:
        byte = F.substr(value, i, F.lit(1))
        hexed = F.hex(byte)
        code = F.conv(hexed, 16, 10).cast("int")
        plain = code.between(32, 126) & ~code.isin(34, 39, 92)
        return F.when(plain, byte.cast("string")).otherwise(F.concat(F.lit("\\x"), hexed))

    body = F.array_join(F.transform(F.sequence(F.lit(1), F.length(value)), show), "")
    return F.when(F.length(value) > 0, body).when(value.isNotNull(), F.lit(""))


def number_text(value: Column) -> Column:
    """Floating-point text with plain digits from 1e-4 up to 1e16 and a two-digit exponent beyond."""
    text = value.cast("string")
    form = "^(-?)(\\d)\\.(\\d+)E(-?\\d+)$"
    sign, head, tail = (F.regexp_extract(text, form, i) for i in (1, 2, 3))
    tail = F.when(tail == "0", "").otherwise(tail)
    power = F.try_to_number(F.regexp_extract(text, form, 4), F.lit("S999")).cast("int")
    digits = F.concat(head, tail)
    zeros = F.lit("0")
    small = F.concat(sign, F.lit("0."), F.repeat(zeros, -power - 1), digits)
    whole = F.concat(sign, F.rpad(digits, power + 1, "0"), F.lit(".0"))
    mixed = F.concat(sign, F.substr(digits, F.lit(1), power + 1), F.lit("."), F.substr(digits, power + 2))
    exponent = F.concat(F.when(power < 0, "-").otherwise("+"), F.lpad(F.abs(power).cast("string"), 2, "0"))
    far = F.concat(sign, head, F.when(tail == "", "").otherwise(F.concat(F.lit("."), tail)), F.lit("e"), exponent)
    return (
        F.when(text == "Infinity", "inf")
        .when(text == "-Infinity", "-inf")
        .when(text == "NaN", "nan")
        .when(~text.contains("E"), text)
        .when(power.between(-4, -1), small)
        .when(power.between(0, 15), F.when(F.length(digits) <= power + 1, whole).otherwise(mixed))
        .otherwise(far)
    )


def value_text(value: Column, kind: T.DataType) -> Column:
    """Text of any value: lists as ``[a, b]``, structs as ``{'name': value}``, maps as ``{key=value}``."""

    def inner(v: Column, t: T.DataType) -> Column:
        return F.coalesce(value_text(v, t), F.lit("NULL"))

    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return number_text(value)
    if isinstance(kind, T.BinaryType):
        return blob_text(value)
    if isinstance(kind, T.ArrayType):
        return F.concat(F.lit("["), F.array_join(F.transform(value, lambda v: inner(v, kind.elementType)), ", "), F.lit("]"))
    if isinstance(kind, T.StructType):
        pairs = [F.concat(F.lit(f"'{f.name}': "), inner(value[f.name], f.dataType)) for f in kind.fields]
        return F.when(value.isNotNull(), F.concat(F.lit("{"), F.concat_ws(", ", *pairs), F.lit("}")))
    if isinstance(kind, T.MapType):
        pairs = F.transform(
            F.map_entries(value),
            lambda e: F.concat(inner(e.key, kind.keyType), F.lit("="), inner(e.value, kind.valueType)),
        )
        return F.concat(F.lit("{"), F.array_join(pairs, ", "), F.lit("}"))
    return value.cast("string")


def coerce_types(df: DataFrame, profile: str = "strict", keep: tuple[str, ...] = ("geom",)) -> DataFrame:
    """Bring every column to a published type.

    ``strict`` keeps boolean, int, long, float, double and string; all others are cast to text, small
    integers and binary included. ``broad`` also keeps binary and widens small integers to int.
    Columns named in ``keep`` and the bbox struct stay as they are.
    """
    if profile not in ("strict", "broad"):
        raise ValueError(f"unknown profile {profile!r}")
    out: list[tuple[str, Column | None]] = []
    for i, field in enumerate(df.schema.fields):
        source, kind = F.col(f"_c{i}"), type(field.dataType)
        if kind in TYPE_NAMES or field.name in keep or field.name == "bbox":
            out.append((field.name, None))
        elif profile == "broad" and kind in _SMALL_INTS:
            out.append((field.name, source.cast("int")))
        elif kind is T.BinaryType and profile == "broad":
            out.append((field.name, None))
        else:
            out.append((field.name, value_text(source, field.dataType)))
    return _rebuild(df, out)


def temporals_to_string(df: DataFrame, style: str = "short") -> DataFrame:
    """Every temporal column as text, in place. ``micro`` always writes six fraction digits."""
    out: list[tuple[str, Column | None]] = []
    for i, field in enumerate(df.schema.fields):
        source, kind = F.col(f"_c{i}"), type(field.dataType)
        if kind not in _TEMPORAL:
            out.append((field.name, None))
        elif style == "micro" and kind in _STAMPS:
            out.append((field.name, F.date_format(source, "yyyy-MM-dd HH:mm:ss.SSSSSS")))
        else:
            out.append((field.name, source.cast("string")))
    return _rebuild(df, out)


def lowercase(names: list[str]) -> list[str]:
    """Lower-case names; a clash gets the count of names so far as suffix, again until it is unused."""
    seen: set[str] = set()
    out = []
    for name in names:
        candidate = name.lower()
        while candidate in seen:
            candidate = f"{candidate}_{len(seen)}"
        seen.add(candidate)
        out.append(candidate)
    return out


def free_names(names: list[str], taken: tuple[str, ...]) -> list[str]:
    """Lower-case names none of which is ``taken``; a clash gets the count of names so far, or the next free number."""
    used, out = {*taken}, []
    for name in names:
        candidate, n = name.lower(), len(out)
        while candidate in used:
            candidate, n = f"{name.lower()}_{n}", n + 1
        used.add(candidate)
        out.append(candidate)
    return out


def lowercase_names(df: DataFrame) -> DataFrame:
    return df.toDF(*lowercase(df.columns))


def drop_columns(df: DataFrame, names: list[str] = ("OGC_FID",)) -> DataFrame:
    """Drop columns by exact name (``DataFrame.drop`` ignores case)."""
    gone = set(names)
    if not gone & set(df.columns):
        return df
    flat, positions = _positional(df)
    left = [(p, n) for p, n in zip(positions, df.columns) if n not in gone]
    return flat.select(*[p for p, _ in left]).toDF(*[n for _, n in left])


def flatten_bbox(df: DataFrame, geom: str = "geom", bbox: str = "bbox") -> DataFrame:
    """Attributes, ``geom_wkb`` and the four ``fp_*`` footprint columns instead of geometry and struct."""
    attributes = [exact(c) for c in df.columns if c not in (geom, bbox)]
    return df.select(
        *attributes,
        F.col(geom).alias("geom_wkb"),
        *[F.col(f"{bbox}.{n}").alias(f"fp_{n}") for n in BBOX_NAMES],
    )


def canonical_order(df: DataFrame, geom: str = "geom") -> DataFrame:
    """Attributes, then geometry, then the bbox columns."""
    tail = [geom, *BBOX_NAMES]
    attributes = [c for c in df.columns if c not in tail]
    return df.select(*[exact(c) for c in [*attributes, *tail]])


def hide_bbox(df: DataFrame) -> DataFrame:
    """The logical table: bbox columns stay in the files but are not part of it."""
    return df.drop(*BBOX_NAMES)


def published_type(field: T.StructField, geom: str = "geom") -> str:
    if field.name == geom and isinstance(field.dataType, T.BinaryType):
        return f"geometry(srid:{field.metadata.get('srid', DEFAULT_EPSG)})"
    if isinstance(field.dataType, T.BinaryType):
        return "binary"
    return TYPE_NAMES.get(type(field.dataType), "int" if isinstance(field.dataType, _SMALL_INTS) else "string")


def logical_schema(df: DataFrame, geom: str = "geom") -> list[dict]:
    """Fields of the logical table with the ids they have in the files."""
    out = []
    for position, field in enumerate(df.schema.fields, 1):
        if field.name in BBOX_NAMES:
            continue
        out.append(
            {
                "id": field.metadata.get(FIELD_ID, position),
                "name": field.name,
                "required": False,
                "type": published_type(field, geom),
                "doc": field.metadata.get("comment", field.name),
            }
        )
    return out


def geometry_doc(epsg: int, extra: str = "") -> str:
    # Fixed value: description of every geometry column.
    return f"Geometría (EPSG:{epsg}, tipo Geometry nativo). {extra}".strip()


def with_field_ids(
    df: DataFrame,
    docs: dict[str, str] | None = None,
    geom: str = "geom",
    epsg: int | None = None,
    partition_by: tuple[str, ...] = (),
) -> DataFrame:
    """Contiguous field ids from 1 and a description per column, as schema metadata.

    Partition columns are not stored in the files and get no id.
    """
    docs = docs or {}
    picked, number = [], 0
    for field in df.schema.fields:
        meta = dict(field.metadata)
        if field.name in partition_by:
            picked.append(exact(field.name))
            continue
        number += 1
        doc = docs.get(field.name, field.name)
        if field.name == geom and isinstance(field.dataType, T.BinaryType):
            meta["srid"] = epsg or meta.get("srid", DEFAULT_EPSG)
            doc = geometry_doc(meta["srid"], docs.get(geom, ""))
        meta[FIELD_ID] = number
        meta["comment"] = doc.encode()[:DOC_BYTES].decode("utf-8", "ignore")
        picked.append(exact(field.name).alias(field.name, metadata=meta))
    return df.select(*picked)


def with_srid(df: DataFrame, epsg: int, geom: str = "geom") -> DataFrame:
    """Records the SRID of the geometry column."""
    meta = {**df.schema[geom].metadata, "srid": int(epsg)}
    return df.withColumn(geom, F.col(geom).alias(geom, metadata=meta))


def srid_of(df: DataFrame, geom: str = "geom") -> int | None:
    return df.schema[geom].metadata.get("srid")


def describe_dataset(df: DataFrame, geom: str = "geom") -> DataFrame:
    """One row (id, name, type, doc) per logical column."""
    rows = [(f["id"], f["name"], f["type"], f["doc"]) for f in logical_schema(df, geom)]
    return df.sparkSession.createDataFrame(rows, "id int, name string, type string, doc string")


def detect_geometry(columns: DataFrame) -> DataFrame:
    """First geometry column and its EPSG code for each dataset of a (dataset, ordinal, column, type) table.

    A type without a code means 4326, flagged in ``crs_assumed``; no geometry leaves ``geom_column`` null.
    """
    is_geometry = F.upper("type").contains("GEOMETRY")
    first = F.min(F.when(is_geometry, F.struct("ordinal", "column", "type")))
    code = F.regexp_extract("first.type", r"EPSG:(\d+)", 1)
    return (
        columns.groupBy("dataset")
        .agg(first.alias("first"))
        .select(
            "dataset",
            F.col("first.column").alias("geom_column"),
            F.when(F.col("first").isNotNull(), F.coalesce(F.nullif(code, F.lit("")).cast("int"), F.lit(DEFAULT_EPSG)))
            .alias("epsg"),
            F.coalesce(code == "", F.lit(False)).alias("crs_assumed"),
        )
    )


def require_geometry(detected: DataFrame) -> DataFrame:
    """``detect_geometry`` result in which a dataset without geometry is an error."""
    message = F.concat(F.col("dataset"), F.lit(": no geometry column"))
    failed = F.raise_error(message).cast("string")
    return detected.withColumn(
        "geom_column", F.when(F.col("geom_column").isNull(), failed).otherwise(F.col("geom_column"))
    )


def is_lower(name: str) -> bool:
    return re.fullmatch(r"[^A-Z]*", name) is not None
