"""Parquet datasets: vector and tabular tables, regions of them, and the dataset index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoloom.functions.crs import domain
from geoloom.functions.geometry import BBOX_NAMES
from geoloom.functions.names import exact
from geoloom.operators.layout import hilbert_sort
from geoloom.operators.schema import FIELD_ID, canonical_order, with_field_ids


def read_dataset(spark: SparkSession, path: str, where: str | Column | None = None) -> DataFrame:
    """A dataset with its ``key=value`` folders as columns; a predicate on them prunes folders."""
    df = spark.read.parquet(path)
    return df if where is None else df.filter(where)


def in_region(df: DataFrame, x0: float, x1: float, y0: float, y1: float) -> DataFrame:
    """Rows whose nested bbox has its lower corner in the region."""
    return df.filter(F.col("bbox.xmin").between(x0, x1) & F.col("bbox.ymin").between(y0, y1))


def read_region(
    spark: SparkSession, path: str, x0: float, x1: float, y0: float, y1: float, where: str | Column | None = None
) -> DataFrame:
    """Rows of a source with a nested bbox whose lower corner is in the region, flattened.

    The nested comparison is pushed down to Parquet row groups.
    """
    df = read_dataset(spark, path, where)
    inside = in_region(df, x0, x1, y0, y1)
    attributes = [exact(c) for c in df.columns if c not in ("geom", "geometry", "bbox")]
    geom = "geometry" if "geometry" in df.columns else "geom"
    return inside.select(
        *attributes, F.col(geom).alias("geom"), *[F.col(f"bbox.{n}").alias(n) for n in BBOX_NAMES]
    )


def write_vector_dataset(
    df: DataFrame,
    path: str,
    partition_by: tuple[str, ...] = (),
    docs: dict[str, str] | None = None,
    epsg: int | None = None,
    bits: int = 24,
    extent: tuple[float, float, float, float] | None = None,
    max_records_per_file: int = 5_000_000,
    mode: str = "errorifexists",
    dynamic: bool = False,
) -> None:
    """Attributes, geometry, bbox; zstd; field ids and descriptions; rows in Hilbert order.

    The rows are range-partitioned by (partition columns, curve position): a small partition value ends up in
    one file, a value that has a large share of the rows in several, each a stretch of the curve. With a
    known SRID the curve covers the whole domain of the CRS, so no pass over the data has to find its extent.
    With ``dynamic``, an overwrite replaces the folders of the partition values at hand and no others.
    """
    if extent is None and epsg is not None:
        extent = domain(epsg)
    ordered = canonical_order(df)
    described = with_field_ids(ordered, docs, epsg=epsg, partition_by=partition_by)
    placed = hilbert_sort(described, extent, bits, leading=partition_by)
    writer = placed.write.mode(mode).option("compression", "zstd").option("maxRecordsPerFile", max_records_per_file)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_tabular_dataset(df: DataFrame, path: str, docs: dict[str, str] | None = None, mode: str = "errorifexists") -> None:
    """A table without geometry: field ids, descriptions, zstd, no shuffle."""
    with_field_ids(df, docs).write.mode(mode).option("compression", "zstd").parquet(path)


def _index_type() -> T.StructType:
    """The fixed index schema with its field ids (bbox members have ids of their own)."""

    def made(name: str, kind: T.DataType, number: int) -> T.StructField:
        return T.StructField(name, kind, True, {FIELD_ID: number})

    corners = T.StructType([made(n, T.DoubleType(), 10 + i) for i, n in enumerate(BBOX_NAMES)])
    text = T.StringType()
    kinds = [
        ("id", text),
        ("collection", text),
        ("geometry", T.BinaryType()),
        ("bbox", corners),
        ("datetime", T.TimestampType()),
        ("properties", text),
        ("assets", text),
        ("stac_version", text),
        ("type", text),
    ]
    return T.StructType([made(n, k, i) for i, (n, k) in enumerate(kinds, 1)])


INDEX_TYPE = _index_type()


def write_index(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    columns = [F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in INDEX_TYPE.fields]
    df.select(*columns).write.mode(mode).option("compression", "zstd").parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INDEX_TYPE).parquet(path)
