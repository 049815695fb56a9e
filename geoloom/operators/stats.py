"""Column statistics, bounds, extents and file statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoloom.functions import bounds as B
from geoloom.functions.geometry import BBOX_NAMES, wgs84_bbox
from geoloom.functions.guards import all_finite
from geoloom.functions.names import exact
from geoloom.operators.schema import published_type

_NO_BOUNDS = (T.BinaryType, T.ArrayType, T.MapType, T.StructType, T.VariantType)


def _orderable(field: T.StructField, source: Column) -> Column:
    """The value that takes part in min and max: NaN is left out."""
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return F.nanvl(source, F.lit(None).cast(field.dataType))
    return source


def column_stats(df: DataFrame, by: tuple[str, ...] = (), geom: str = "geom") -> DataFrame:
    """(column, kind, value_count, null_count, lower, upper) of every column, from one scan.

    All columns are aggregated side by side with map-side partial results and turned to rows afterwards, so
    the data is shuffled once, as one row per group and task. Bounds are texts of the typed min and max.
    """
    return _statistics(df, by, geom, fold_bbox=False)


def _statistics(df: DataFrame, by: tuple[str, ...], geom: str, fold_bbox: bool) -> DataFrame:
    """``column_stats``; with ``fold_bbox`` the corners bound the geometry instead of being rows themselves."""
    fields = [f for f in df.schema.fields if f.name not in by]
    measures, entries = [F.count(F.lit(1)).alias("_n")], []
    corners: dict[str, int] = {}
    for i, field in enumerate(fields):
        source = exact(field.name)
        measures.append(F.count(source).alias(f"_given{i}"))
        if not isinstance(field.dataType, _NO_BOUNDS):
            value = _orderable(field, source)
            # NaN sorts last, so the minimum needs no guard per row: it is NaN only where nothing else is
            measures += [_orderable(field, F.min(source)).alias(f"_lo{i}"), F.max(value).alias(f"_hi{i}")]
        if field.name in BBOX_NAMES:
            corners[field.name] = i
    for i, field in enumerate(fields):
        if fold_bbox and field.name in BBOX_NAMES:
            continue
        if fold_bbox and field.name == geom:
            lower = F.concat_ws(" ", *[F.coalesce(F.col(f"_lo{corners[c]}").cast("string"), F.lit("NaN")) for c in ("xmin", "ymin")])
            upper = F.concat_ws(" ", *[F.coalesce(F.col(f"_hi{corners[c]}").cast("string"), F.lit("NaN")) for c in ("xmax", "ymax")])
        elif isinstance(field.dataType, _NO_BOUNDS):
            lower = upper = F.lit(None).cast("string")
        else:
            lower, upper = F.col(f"_lo{i}").cast("string"), F.col(f"_hi{i}").cast("string")
        entries.append(
            F.struct(
                F.lit(field.name).alias("column"),
                F.lit(published_type(field, geom).split("(")[0]).alias("kind"),
                F.col("_n").alias("value_count"),
                (F.col("_n") - F.col(f"_given{i}")).alias("null_count"),
                lower.alias("lower"),
                upper.alias("upper"),
            )
        )
    wide = df.groupBy(*by).agg(*measures)
    return wide.select(*by, F.inline(F.array(*entries)))


def geometry_bounds(df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Lower and upper corner over all rows; zeros and ``has_bound = false`` where no row has a bbox, or one of the
    four numbers is not finite."""
    lows = [F.min(c).alias(c) for c in ("xmin", "ymin")]
    highs = [F.max(c).alias(c) for c in ("xmax", "ymax")]
    known = all_finite(*BBOX_NAMES)
    return (
        df.groupBy(*by)
        .agg(*lows, *highs)
        .select(
            *by,
            *[F.when(known, F.col(c)).otherwise(F.lit(0.0)).alias(c) for c in BBOX_NAMES],
            known.alias("has_bound"),
        )
    )


def encoded_bounds(df: DataFrame, by: tuple[str, ...] = (), geom: str = "geom") -> DataFrame:
    """Binary lower and upper bound of every logical column, per group (dataset, file, ...).

    ``has_bound`` is false for a placeholder pair; ``exact`` is false where a text was cut.
    """
    fold = geom in df.columns and set(BBOX_NAMES) <= set(df.columns)
    stats = _statistics(df, by, geom, fold)
    text = F.col("kind") == "string"
    sides = {
        s: F.when(text, F.substring(s, 1, B.STRING_BOUND_CHARS + 1)).otherwise(F.col(s)) for s in ("lower", "upper")
    }
    raw = stats.withColumn("_lo", B.encode_lower(F.col("kind"), sides["lower"])).withColumn(
        "_hi", B.encode_upper(F.col("kind"), sides["upper"])
    )
    ok = F.col("_lo.ok") & F.col("_hi.ok")
    return raw.select(
        *by,
        "column",
        "kind",
        "value_count",
        "null_count",
        F.when(ok, F.col("_lo.bytes")).otherwise(B.placeholder_column(F.col("kind"), False)).alias("lower"),
        F.when(ok, F.col("_hi.bytes")).otherwise(B.placeholder_column(F.col("kind"), True)).alias("upper"),
        ok.alias("has_bound"),
        (ok & F.col("_lo.exact") & F.col("_hi.exact")).alias("exact"),
    )


def wgs84_extent(df: DataFrame, epsg: int, by: tuple[str, ...] = (), geom: str = "geom") -> DataFrame:
    """Extent over every re-projected vertex. Corners of a native box would not give the same result."""
    box = df.select(*by, wgs84_bbox(epsg)(F.col(geom)).alias("_box"))
    return box.groupBy(*by).agg(
        F.min("_box.xmin").alias("min_lon"),
        F.min("_box.ymin").alias("min_lat"),
        F.max("_box.xmax").alias("max_lon"),
        F.max("_box.ymax").alias("max_lat"),
    )


def file_stats(spark: SparkSession, path: str) -> DataFrame:
    """Size, rows and bounds of every data file of a vector dataset (bbox columns only are read)."""
    df = spark.read.parquet(path)
    named = df.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"), *BBOX_NAMES
    )
    rows = F.count(F.lit(1)).alias("rows")
    sides = [F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"), F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax")]
    out = named.groupBy("file", "bytes").agg(rows, *sides)
    return out.withColumn("has_bound", all_finite(*BBOX_NAMES))
