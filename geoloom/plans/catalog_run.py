"""From the manifests of all kinds to everything a catalog publishes: the index and all documents, in one run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.functions.geometry import BBOX_NAMES
from geoloom.operators import catalog as K
from geoloom.operators import documents as DOCS
from geoloom.operators import joins as J
from geoloom.operators import setops as U
from geoloom.session import scratch_path
from geoloom.sources import datasets as D


def publish_catalog(
    spark: SparkSession,
    vector: DataFrame,
    tabular: DataFrame,
    raster: DataFrame,
    files: DataFrame,
    columns: DataFrame,
    path: str,
    *,
    collection: str,
    base: str,
    crs: str,
    provider: str,
    license: str,
    prefix: str,
    page_size: int = 1000,
) -> DataFrame:
    """(part, n): datasets of each kind, index rows, tables and documents that were written.

    Manifests: id, title, theme, rows, bbox struct, src. ``files``: (src, file, bytes, rows), the data files there are; an
    entry without any is left out. ``columns``: (src, id, name, type, doc), the logical columns of tables. A tabular id that
    a spatial dataset has gets the table suffix. Writes ``index`` and ``documents`` (key, body) below ``path``; where a
    server needs a file for each document, ``write_documents`` makes them of that table.
    """
    present = files.select(F.col("src").alias("file")).distinct()
    spatial = vector.select("id").unionByName(raster.select("id"))
    renamed = J.resolve_kind_collisions(tabular, spatial)
    kinds = [
        J.materialised(df, present).select("id", "title", "theme", F.col("rows").cast("long").alias("rows"), "bbox", "src")
        for df in (vector, renamed.withColumn("id", F.col("out_id")).drop("out_id"), raster)
    ]
    # The entries are read five times over; the joins that made them run once.
    place = scratch_path(spark, "entries")
    U.build_index(*kinds).write.parquet(place)
    entries = spark.read.parquet(place)
    D.write_index(K.index_rows(entries, collection, base, crs, provider, license), f"{path}/index")

    kind = F.col("kind")
    space = F.when(kind == "vector", "v3").otherwise("tab")
    tables = entries.filter(kind != "raster").select(
        space.alias("namespace"),
        F.col("id").alias("name"),
        F.concat(space, F.lit("/"), "id").alias("key"),
        F.concat(F.lit(f"{base}/data/"), space, F.lit("/"), "id").alias("location"),
        F.when(kind == "vector", 3).otherwise(2).alias("format_version"),
        K.table_properties(F.col("title"), F.col("theme"), kind, crs, provider, license).alias("properties"),
        "src",
    )
    keyed = tables.select("key", "src")
    described = DOCS.table_documents(tables, columns.join(keyed, "src"), files.join(keyed, "src"))
    held = scratch_path(spark, "table-documents")
    described.write.parquet(held)
    bodies = spark.read.parquet(held)
    surface = DOCS.surface_documents(tables.select("namespace", "name", "key").join(bodies, "key"), base, prefix, page_size)
    surface.write.parquet(f"{path}/documents")

    def told(part: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(part).alias("part"), "n")

    counts = K.index_facets(entries).filter("kind <> 'all'").select(F.col("kind").alias("part"), "n")
    written = spark.read.parquet(f"{path}/documents")
    return counts.unionByName(told("index", D.read_index(spark, f"{path}/index"))).unionByName(told("tables", tables)).unionByName(told("documents", written))


def entry_box(wgs: str = "wgs"):
    """The bbox struct of a manifest's list of four numbers; null where it is not one."""
    corners = F.struct(*[F.get(F.col(wgs), k).alias(c) for k, c in enumerate(BBOX_NAMES)])
    return F.when(F.size(wgs) == len(BBOX_NAMES), corners)
