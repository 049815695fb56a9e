"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Each query runs to the end (every column computed, rows thrown away) once untimed and once timed. Inputs that an operator reads in practice as a published dataset are written once, untimed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from checks import common as C  # noqa: E402
from checks.q_geometry import CORNER_BOX, TRIANGLE  # noqa: E402
from checks.q_stats import cells  # noqa: E402
from checks.registry import fixture, table  # noqa: E402
from geoloom.functions import crs  # noqa: E402
from geoloom.operators import geometry as OG  # noqa: E402
from geoloom.operators import joins as J  # noqa: E402
from geoloom.operators import layout as L  # noqa: E402
from geoloom.operators import raster as R  # noqa: E402
from geoloom.operators import schema as S  # noqa: E402
from geoloom.operators import setops as U  # noqa: E402
from geoloom.operators import stats as ST  # noqa: E402
from geoloom.operators import windows as W  # noqa: E402
from geoloom.session import build_session, scratch_path  # noqa: E402
from geoloom.sources import datasets as D  # noqa: E402

EXTENT = (400000.0, 4430000.0, 500000.0, 4530000.0)


def run(df):
    df.write.format("noop").mode("overwrite").save()


def files_per_box(spark, path, around):
    """Mean number of files that a 2 km box cannot rule out, and the number of files."""
    stats = scratch_path(spark, "bench-files")
    ST.file_stats(spark, path).write.parquet(stats)
    pruned = J.prune_files(spark.read.parquet(stats), around)
    return pruned.agg(F.round(F.avg("scanned"), 2), F.max("total")).first()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")

    source = scratch_path(spark, "bench-source")
    OG.drop_null_or_empty_geometry(C.boxes_with_bbox(spark, sf_dir)).repartition(int(cpus)).write.parquet(source)
    vector = S.with_srid(spark.read.parquet(source), C.EPSG)
    bare = vector.drop("xmin", "ymin", "xmax", "ymax")
    clustered = scratch_path(spark, "bench-clustered")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    L.hilbert_sort(vector, EXTENT, partitions=52).write.parquet(clustered)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sorted_vector = S.with_srid(spark.read.parquet(clustered), C.EPSG)
    lines = table(spark, sf_dir, "lineitem")
    points = fixture(spark, sf_dir, "F1")
    ledger = fixture(spark, sf_dir, "F8").select(
        (F.col("id") % 5).cast("string").alias("publisher"), F.col("id").alias("seq"), F.lit("OK").alias("status")
    )

    # file statistics as they lie in a catalog: one row per 2 km square of the data
    cell = F.concat_ws("_", *[F.floor(F.col(c) / 2000).cast("string") for c in ("xmin", "ymin")])
    stats = scratch_path(spark, "bench-stats")
    ST.geometry_bounds(vector.withColumn("file", cell), ("file",)).write.parquet(stats)
    x, y = F.col("x"), F.col("y")
    around = points.select("id", (x - 1000).alias("xmin"), (y - 1000).alias("ymin"), (x + 1000).alias("xmax"), (y + 1000).alias("ymax"))

    lon, lat = crs.utm_to_wgs84(F.col("l_partkey") + F.lit(400000.0), F.col("l_orderkey") + F.lit(4430000.0))
    queries = {
        "a01_column_stats": lambda: run(ST.column_stats(lines)),
        "a03_encoded_bounds": lambda: run(ST.encoded_bounds(vector, ("part_key",))),
        "a04_wgs84_extent": lambda: run(ST.wgs84_extent(bare, C.EPSG)),
        "f02_bbox_corner_filter": lambda: run(OG.bbox_corner_filter(sorted_vector, CORNER_BOX)),
        "f03_intersects": lambda: run(OG.intersects(sorted_vector, TRIANGLE, C.EPSG)),
        "j05_prune_files": lambda: run(J.prune_files(spark.read.parquet(stats), around)),
        "o04_hilbert_sort": lambda: run(L.hilbert_sort(vector, EXTENT)),
        "p01_coerce_types": lambda: run(S.coerce_types(lines)),
        "p06_add_bbox": lambda: run(OG.add_bbox(bare)),
        "p15_utm_to_wgs84": lambda: run(lines.select(lon.alias("lon"), lat.alias("lat"))),
        "r01_to_tiles": lambda: run(R.to_tiles(cells(spark, sf_dir), 64)),
        "r02_overviews": lambda: run(R.overviews(cells(spark, sf_dir), size=64)),
        "s06_write_vector_dataset": lambda: D.write_vector_dataset(
            vector, scratch_path(spark, "bench-out"), ("part_key",), epsg=C.EPSG
        ),
        "w02_latest_per_id": lambda: run(U.latest_per_id(lines.select(F.col("l_partkey").alias("id"), F.col("l_orderkey").alias("seq"), "l_shipdate"))),
        "w03_progress": lambda: run(W.progress(ledger, "publisher")),
    }
    seconds = {}
    for name, query in queries.items():
        query()  # untimed: starts Python workers and compiles the generated code
        start = time.perf_counter()
        query()
        seconds[name] = round(time.perf_counter() - start, 3)
    scanned, total = files_per_box(spark, clustered, around)
    unsorted = scratch_path(spark, "bench-unsorted")  # as many files, rows in no spatial order
    vector.repartition(52).write.parquet(unsorted)
    before, of = files_per_box(spark, unsorted, around)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "mean_files_per_2km_box": {"hilbert": f"{scanned}/{total}", "unsorted": f"{before}/{of}"},
            }
        )
    )


if __name__ == "__main__":
    main()
