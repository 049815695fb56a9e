"""Whole jobs: source to published dataset, and manifests to the dataset index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoloom.functions import text as TX
from geoloom.functions.geometry import BBOX_NAMES
from geoloom.operators import catalog as K
from geoloom.operators import geometry as OG
from geoloom.operators import quality as Q
from geoloom.operators import schema as S
from geoloom.operators import setops as U
from geoloom.operators import stats as ST
from geoloom.session import scratch_path
from geoloom.sources import datasets as D
from geoloom.sources import text_tables as TT


def _is_box(kind: T.DataType) -> bool:
    return isinstance(kind, T.StructType) and [f.name for f in kind] == list(BBOX_NAMES)


def _set_aside(df: DataFrame, boxes: list[str]) -> DataFrame:
    """Renames attributes that only after lower-casing are called like a box column; ``boxes`` are real ones."""
    names, taken = [], {*df.columns}
    for name in df.columns:
        if name in BBOX_NAMES and name not in boxes:
            n = len(names)
            while f"{name}_{n}" in taken:
                n += 1
            name = f"{name}_{n}"
            taken.add(name)
        names.append(name)
    return df.toDF(*names)


def normalise_vector(df: DataFrame, epsg: int, profile: str = "strict") -> DataFrame:
    """Row-level part of the vector job: names, types, bbox, empty geometries out, column order.

    Narrow: no shuffle, and the geometry is read by Python once. A box struct of the source goes, an attribute that
    happens to be called ``bbox`` stays, and one called like a box column gets the suffix of a repeated name. A
    geometry that cannot be read fails the job.
    """
    boxes = [f.name for f in df.schema if f.name == "bbox" and _is_box(f.dataType)]
    plain = S.lowercase_names(S.drop_columns(df.drop(*boxes) if boxes else df))
    own = [f.name for f in df.schema if f.name in BBOX_NAMES]
    aside = _set_aside(plain, own)
    boxed = OG.refuse_unreadable(OG.add_bbox(S.coerce_types(aside, profile), flag="_unreadable"), flag="_unreadable")
    return S.with_srid(S.canonical_order(OG.drop_null_or_empty_geometry(boxed)), epsg)


def publish_vector(
    df: DataFrame,
    path: str,
    epsg: int,
    partition_by: tuple[str, ...] = (),
    docs: dict[str, str] | None = None,
    bits: int = 24,
    stage: bool = False,
) -> dict[str, DataFrame]:
    """Write a vector table and return its statistics, taken from the written files.

    A range shuffle looks at its input twice, once for the range bounds. Where the input is costly to make
    (JSON features), ``stage`` writes the normalised rows to the shared folder first and sorts from there.

    ``files``: size, rows and bounds per file; ``columns``: encoded bounds per file and column;
    ``extent``: the WGS84 box.
    """
    spark = df.sparkSession
    rows = normalise_vector(df, epsg)
    if stage:
        staged = scratch_path(spark, "staged")
        rows.write.option("compression", "zstd").parquet(staged)
        rows = S.with_srid(spark.read.schema(rows.schema).parquet(staged), epsg)
    D.write_vector_dataset(rows, path, partition_by, docs, epsg, bits)
    written = S.with_srid(spark.read.parquet(path), epsg)
    named = written.drop(*partition_by).withColumn("file", F.col("_metadata.file_path"))
    return {
        "files": ST.file_stats(spark, path),
        "columns": ST.encoded_bounds(named, ("file",)),
        "extent": ST.wgs84_extent(written, epsg),
    }


def publish_tabular(df: DataFrame, path: str, docs: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """Write a table without geometry and return its column bounds."""
    spark = df.sparkSession
    clean = S.coerce_types(S.lowercase_names(S.drop_columns(df)), "strict")
    D.write_tabular_dataset(clean, path, docs)
    written = spark.read.parquet(path).withColumn("file", F.col("_metadata.file_path"))
    return {"columns": ST.encoded_bounds(written, ("file",))}


def build_catalog(
    spark: SparkSession,
    vector: DataFrame,
    tabular: DataFrame,
    raster: DataFrame,
    path: str,
    collection: str,
    base: str,
    crs: str,
    provider: str,
    license: str,
) -> DataFrame:
    """Manifests (id, title, theme, rows, bbox) of the three kinds to the written dataset index."""
    entries = U.build_index(vector, tabular, raster)
    D.write_index(K.index_rows(entries, collection, base, crs, provider, license), path)
    return D.read_index(spark, path)


def vector_report(df: DataFrame) -> DataFrame:
    """Geometry audit of a source before it is published."""
    return Q.audit_geometries(df)


def publish_text_tables(
    spark: SparkSession, paths: list[str], path: str, dataset: Column | None = None, prefer: str = TT.LATIN1
) -> DataFrame:
    """Delimited files to tabular datasets; returns (dataset, rows, status) of every file's dataset.

    Files of one dialect and header are one job that writes ``path/<n>/dataset=<id>``. Without ``dataset`` (an
    expression over ``_file``) the id is the slug of the file name. Files that cannot be read are listed
    with the reason.
    """
    return placed_text_tables(spark, paths, path, dataset, prefer).drop("folder")


def placed_text_tables(
    spark: SparkSession, paths: list[str], path: str, dataset: Column | None = None, prefer: str = TT.LATIN1
) -> DataFrame:
    """The same with ``folder``, the number below ``path`` that holds the dataset."""
    name = F.regexp_extract("_file", r"([^/]+?)(?:\.[^./]*)?$", 1)
    ident = TX.slug(name, "package") if dataset is None else dataset
    tables, rejected = TT.read_text_tables(spark, paths, prefer)
    done = spark.createDataFrame([], "dataset string, rows bigint, status string, folder int")
    for number, table in enumerate(tables):
        keyed = S.drop_columns(S.coerce_types(table.df).select("*", ident.alias("dataset")))
        *names, _, _ = S.lowercase(keyed.columns)
        keyed = keyed.toDF(*names, "_file", "dataset").drop("_file")
        out = f"{path}/{number}"
        described = S.with_field_ids(keyed, partition_by=("dataset",))
        described.write.option("compression", "zstd").partitionBy("dataset").parquet(out)
        written = spark.read.schema(described.schema).parquet(out)
        counts = written.groupBy("dataset").agg(F.count(F.lit(1)).alias("rows"))
        status = F.concat(F.lit("OK("), F.col("rows").cast("string"), F.lit(")"))
        done = done.unionByName(counts.withColumn("status", status).withColumn("folder", F.lit(number)))
    failed = spark.createDataFrame(rejected, "_file string, why string")
    reason = F.when(F.col("why") == "no rows", "empty").otherwise(F.lit("FAIL-convert"))
    nothing = F.lit(None).cast("bigint").alias("rows")
    return done.unionByName(failed.select(ident.alias("dataset"), nothing, reason.alias("status"), F.lit(None).cast("int").alias("folder")))
