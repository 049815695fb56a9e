"""Many grids in one resumable run: delivered cells and their inventory to tile pyramids and a ledger."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.functions import text as TX
from geoloom.operators import joins as J
from geoloom.operators import raster as R
from geoloom.operators import setops as U

LEDGER = (
    "id string, coverage string, title string, theme string, src string, wgs array<double>, type string,"
    " tiles bigint, levels int, status string, run bigint"
)
DATASET = "dataset"
_NOTHING_THERE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The last entry of every grid of all runs."""
    try:
        entries = spark.read.schema(LEDGER).parquet(f"{path}/ledger")
        entries.isEmpty()
    except AnalysisException as e:
        if e.getCondition() not in _NOTHING_THERE:
            raise
        entries = spark.createDataFrame([], LEDGER)
    return U.latest_per_id(entries, "id", ("run",)).select(*entries.columns)


def pyramid(cells: DataFrame, size: int = 512) -> DataFrame:
    """(layer, level, tx, ty, cells): the tiles of each grid and of its overviews, level 0 the grid itself.

    One shuffle: overviews are made of the base cells without one, and the tiles of all levels are gathered together.
    """
    base = cells.select("layer", F.lit(0).alias("level"), F.col("col").cast("long").alias("col"), F.col("row").cast("long").alias("row"), "value")
    above = R.overviews(cells, size=size).select("layer", "level", F.col("col").cast("long").alias("col"), F.col("row").cast("long").alias("row"), "value")
    both = base.unionByName(above).withColumn("layer", F.struct("layer", "level")).drop("level")
    tiles = R.to_tiles(both, size)
    return tiles.select(F.col("layer.layer").alias("layer"), F.col("layer.level").alias("level"), "tx", "ty", "cells")


def publish_rasters(spark: SparkSession, cells: DataFrame, inventory: DataFrame, path: str, epsg: int, run: int, size: int = 512) -> DataFrame:
    """Ledger entries of one run.

    ``cells``: (layer, col, row, value), integers. ``inventory``: (id, title, origin_x, origin_y, pixel_x, pixel_y), ``id``
    being the layer's name. A grid that the ledger has is skipped, one without cells is a failure. Tiles lie in
    ``data/dataset=<id>``, in order of level and place; a run that was lost may be given again.
    """
    asked = inventory.select(F.col("id").alias("coverage"), "title", "origin_x", "origin_y", "pixel_x", "pixel_y").withColumn("id", TX.slug(F.col("coverage"), "coverage"))
    ledger = read_ledger(spark, path).filter((F.col("run") < run) & F.col("src").isNotNull())
    todo = J.pending(asked, ledger)
    mine = cells.join(todo.select(F.col("coverage").alias("layer"), F.col("id").alias(DATASET)), "layer")
    tiles = pyramid(mine.select(F.col(DATASET).alias("layer"), "col", "row", "value"), size).withColumnRenamed("layer", DATASET)
    placed = tiles.repartitionByRange(DATASET, "level", "ty", "tx").sortWithinPartitions(DATASET, "level", "ty", "tx")
    writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
    writer.partitionBy(DATASET).parquet(f"{path}/data")

    shape = mine.groupBy(DATASET).agg((F.max("col") + 1).alias("width"), (F.max("row") + 1).alias("height"))
    written = spark.read.schema(f"level int, {DATASET} string").parquet(f"{path}/data").join(shape.select(DATASET), DATASET, "left_semi")
    counts = written.groupBy(DATASET).agg(F.count(F.lit(1)).alias("tiles"), (F.max("level") + 1).alias("levels"))
    made = counts.join(shape, DATASET).withColumnRenamed(DATASET, "id")
    extent = R.raster_extent(asked.join(made, "id", "left"), epsg)
    before = ledger.select("id", *[F.col(c).alias(f"_{c}") for c in ("src", "wgs", "tiles", "levels")])
    told = extent.join(before, "id", "left")
    done, old = F.col("tiles").isNotNull(), F.col("_src").isNotNull()
    corners = F.array("min_lon", "min_lat", "max_lon", "max_lat")
    entries = told.select(
        "id",
        "coverage",
        F.coalesce("title", "coverage").alias("title"),
        TX.coverage_theme(F.col("coverage")).alias("theme"),
        F.when(done, F.concat(F.lit(f"data/{DATASET}="), "id")).otherwise(F.col("_src")).alias("src"),
        F.when(done, corners).otherwise(F.col("_wgs")).alias("wgs"),
        F.lit("raster").alias("type"),
        F.coalesce("tiles", "_tiles").alias("tiles"),
        F.coalesce("levels", "_levels").cast("int").alias("levels"),
        F.when(done, F.lit("OK")).when(old, F.lit("skip")).otherwise(F.lit("FAIL")).alias("status"),
        F.lit(run).cast("long").alias("run"),
    )
    entries.write.mode("overwrite").parquet(f"{path}/ledger/part={run}")
    return spark.read.schema(LEDGER).parquet(f"{path}/ledger/part={run}")
