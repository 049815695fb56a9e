"""Acceptance of a published dataset: the checks that a run has to pass before its output counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.functions.geometry import BBOX_NAMES
from geoloom.operators import geometry as OG
from geoloom.operators import quality as Q
from geoloom.operators import schema as S
from geoloom.operators import stats as ST

# What a reader reports when a layout rule is broken, why, and what to do about it.
CAUSES = {
    "geometry_with_srid": ("Failed to cast variant value to REAL, or Incompatible SRID", "the geometry type has no SRID", "write the geometry column with its SRID"),
    "geometry_id_before_bbox": ("300010 internal error", "the box columns come before the geometry", "order attributes, geometry, box"),
    "ids_contiguous": ("300010 internal error", "a gap in the field ids", "number the file columns from 1 without gaps"),
    "bbox_in_file_hidden": ("300010 internal error", "box columns are missing, or part of the schema", "keep them in the files, leave them out of the schema"),
    "stats_complete": ("300010 internal error, or Failed to cast variant value to REAL", "a column without bounds", "write bounds for every column, a placeholder where all is null"),
    "names_lower_case": ("300010 internal error", "upper-case column names", "lower-case all names"),
    "described": ("no data dictionary", "a column without description or id", "write a description and an id for every column"),
    "names_unique": ("ambiguous column", "two columns of one name", "add a suffix to the repeated name"),
}


def published_columns(written: DataFrame, bounds: DataFrame, dataset: str, geom: str = "geom") -> DataFrame:
    """The column table that the layout audit reads, of a dataset as it lies in its files.

    ``bounds``: the encoded bounds of its columns (any number of files); a column has statistics if every file has.
    """
    spark = written.sparkSession
    rows = [
        (dataset, f.name, S.published_type(f, geom), f.metadata.get(S.FIELD_ID), f.name not in BBOX_NAMES, f.metadata.get("comment"))
        for f in written.schema.fields
    ]
    named = spark.createDataFrame(rows, "dataset string, column string, type string, field_id int, in_schema boolean, doc string")
    complete = F.bool_and(F.col("lower").isNotNull() & F.col("upper").isNotNull())
    told = bounds.groupBy("column").agg(complete.alias("has_stats"))
    return named.join(told, "column", "left").withColumn("has_stats", F.coalesce("has_stats", F.lit(False)))


def diagnose(audit: DataFrame) -> DataFrame:
    """(dataset, rule, symptom, cause, remedy) of every broken rule of a layout audit."""

    def told(k: int) -> Column:
        return reduce(lambda c, rule: c.when(F.col("rule") == rule, CAUSES[rule][k]), CAUSES, F.when(F.lit(False), F.lit(None).cast("string")))

    return audit.filter(~F.col("ok")).select("dataset", "rule", *[told(k).alias(name) for k, name in enumerate(("symptom", "cause", "remedy"))])


def accept(
    spark: SparkSession,
    path: str,
    epsg: int,
    box: tuple[float, float, float, float],
    polygons: list[list[list[tuple[float, float]]]],
    want: int | None = None,
) -> DataFrame:
    """(check, value, ok) of a vector dataset.

    ``rows`` (as many as wanted), ``null_geometries`` and ``unbounded_rows`` (none), ``in_box`` (lower corner in the
    box), ``intersecting`` (meets the polygon, refined after the bounds), ``srid``, ``files`` and ``files_in_box``
    (files whose bounds the box meets; fewer than all, if there are several and the box is not the whole extent).
    """
    data = S.with_srid(spark.read.parquet(path), epsg)
    x0, y0, x1, y1 = box
    corner = F.col("xmin").between(x0, x1) & F.col("ymin").between(y0, y1)
    unbounded = reduce(Column.__or__, [F.col(c).isNull() | F.isnan(c) for c in BBOX_NAMES])
    plain = data.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("geom").isNull()).alias("null_geometries"),
        F.count_if(unbounded).alias("unbounded_rows"),
        F.count_if(corner).alias("in_box"),
    )
    hits = OG.intersects(data, polygons, epsg).agg(F.count(F.lit(1)))
    meets = (F.col("xmin") <= x1) & (F.col("xmax") >= x0) & (F.col("ymin") <= y1) & (F.col("ymax") >= y0)
    inside = F.least(F.col("xmin") - x0, F.col("ymin") - y0, x1 - F.col("xmax"), y1 - F.col("ymax")) >= 0
    files = ST.file_stats(spark, path).agg(
        F.struct(
            F.count(F.lit(1)).alias("all"),
            F.count_if(~F.col("has_bound") | meets).alias("met"),
            F.bool_and(F.coalesce(inside, F.lit(False))).alias("covered"),
        )
    )
    one = plain.withColumns({"intersecting": hits.scalar(), "_files": files.scalar(), "srid": F.lit(S.srid_of(data))})
    one = one.withColumns({"files": F.col("_files.all"), "files_in_box": F.col("_files.met")})
    good = {
        "rows": F.col("rows") == want if want is not None else F.col("rows") > 0,
        "null_geometries": F.col("null_geometries") == 0,
        "unbounded_rows": F.col("unbounded_rows") == 0,
        "in_box": F.col("in_box") <= F.col("rows"),
        "intersecting": F.col("intersecting") <= F.col("rows"),
        "srid": F.col("srid") == epsg,
        "files": F.col("files") > 0,
        "files_in_box": (F.col("files_in_box") < F.col("files")) | (F.col("files") == 1) | F.col("_files.covered"),
    }
    pairs = F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).cast("bigint").alias("value"), F.coalesce(ok, F.lit(False)).alias("ok")) for n, ok in good.items()])
    return one.select(F.inline(pairs))


def audit_published(spark: SparkSession, path: str, epsg: int, dataset: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """(dataset, rule, ok) of the layout of a vector dataset, read from what was written."""
    written = S.with_srid(spark.read.parquet(path), epsg).drop(*partition_by)
    bounds = ST.encoded_bounds(written.withColumn("file", F.col("_metadata.file_path")), ("file",))
    return Q.audit_layout(published_columns(written, bounds, dataset))
