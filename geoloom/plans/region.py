"""A region of a large public dataset as a dataset of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.functions.geometry import BBOX_NAMES
from geoloom.functions.guards import all_finite
from geoloom.functions.names import exact
from geoloom.operators import schema as S
from geoloom.operators import stats as ST
from geoloom.sources import datasets as D


def publish_region(
    spark: SparkSession,
    source: str,
    path: str,
    region: tuple[float, float, float, float],
    epsg: int = 4326,
    where: str | None = None,
    partition_by: tuple[str, ...] = (),
    docs: dict[str, str] | None = None,
    bits: int = 24,
) -> dict[str, DataFrame]:
    """Rows of a source with a nested box whose lower corner is in ``region`` (x0, y0, x1, y1), published.

    The box of the source is taken as it is, so no geometry is read: the region is pushed to the row groups, nested
    columns become text, rows without a geometry or a finite box are left out. ``where`` prunes the source's folders.
    Returns ``files`` and ``columns``, the statistics of what was written.
    """
    x0, y0, x1, y1 = region
    found = D.in_region(D.read_dataset(spark, source, where), x0, x1, y0, y1)
    geom = "geometry" if "geometry" in found.columns else "geom"
    corners = [f"bbox.{c}" for c in BBOX_NAMES]
    found = found.filter(F.col(geom).isNotNull() & all_finite(*corners))
    names = [c for c in found.columns if c not in (geom, "bbox")]
    rows = found.select(*[exact(c) for c in names], geom, *corners)
    rows = rows.toDF(*S.free_names(names, ("geom", "bbox", *BBOX_NAMES)), "geom", *BBOX_NAMES)
    plain = S.coerce_types(rows, "strict")
    D.write_vector_dataset(plain, path, partition_by, docs, epsg, bits)
    written = S.with_srid(spark.read.parquet(path), epsg).drop(*partition_by).withColumn("file", F.col("_metadata.file_path"))
    return {"files": ST.file_stats(spark, path), "columns": ST.encoded_bounds(written, ("file",))}
