"""Physical plans: what is pushed down, scanned, shuffled and sent to Python."""

import re

import pytest
from pyspark.sql import functions as F

from checks import common as C
from checks.q_geometry import CORNER_BOX, TRIANGLE
from geoloom.operators import geometry as OG
from geoloom.operators import joins as J
from geoloom.operators import layout as L
from geoloom.operators import raster as R
from geoloom.operators import stats as ST
from geoloom.operators import windows as W
from geoloom.operators.schema import with_srid
from geoloom.plans import publish as PB
from geoloom.sources import datasets as D


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(text):
    return len(re.findall(r"Exchange (?:hash|range|Single|RoundRobin)", text, re.I))


@pytest.fixture(scope="module")
def dataset(spark, small, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "v")
    D.write_vector_dataset(OG.drop_null_or_empty_geometry(C.boxes_with_bbox(spark, small)), path, ("part_key",), epsg=C.EPSG)
    return path


def test_corner_filter_reaches_the_scan(spark, dataset):
    text = plan(OG.bbox_corner_filter(spark.read.parquet(dataset), CORNER_BOX).select("id"))
    assert "GreaterThanOrEqual(xmin,410000.0)" in text and "LessThanOrEqual(ymin,4480000.0)" in text
    assert "geom" not in re.search(r"ReadSchema: (\S+)", text)[1]


def test_nested_region_reaches_the_scan(spark, small, tmp_path):
    C.boxes_with_struct(spark, small).write.parquet(str(tmp_path / "n"))
    text = plan(D.read_region(spark, str(tmp_path / "n"), 1.0, 2.0, 3.0, 4.0).select("id"))
    assert "GreaterThanOrEqual(bbox.xmin,1.0)" in text and "LessThanOrEqual(bbox.ymin,4.0)" in text


def test_partition_predicate_prunes_folders(spark, dataset):
    text = plan(D.read_dataset(spark, dataset, "part_key = '2-HIGH'"))
    assert re.search(r"PartitionFilters: \[[^\]]*part_key", text)


def test_exact_test_runs_after_the_bounds_test(spark, dataset):
    text = plan(OG.intersects(with_srid(spark.read.parquet(dataset), C.EPSG), TRIANGLE, C.EPSG).select("id"))
    assert "GreaterThanOrEqual(xmax,410000.0)" in text
    lines = text.splitlines()
    python = next(i for i, x in enumerate(lines) if "ArrowEvalPython" in x)
    assert any("Filter" in x and "xmax" in x for x in lines[python + 1 :])
    assert text.count("ArrowEvalPython") == 1


def test_bbox_reads_the_geometry_once(spark, dataset):
    bare = spark.read.parquet(dataset).drop("xmin", "ymin", "xmax", "ymax")
    text = plan(OG.add_bbox(bare))
    assert text.count("ArrowEvalPython") == 1 and text.count("wkb_bbox(") == 1


def test_normalising_is_narrow_and_reads_the_geometry_once(spark, dataset):
    bare = spark.read.parquet(dataset).drop("xmin", "ymin", "xmax", "ymax")
    text = plan(PB.normalise_vector(bare, C.EPSG))
    assert text.count("ArrowEvalPython") == 1 and text.count("checked_bbox(") == 1 and shuffles(text) == 0


def test_statistics_scan_once(spark, dataset):
    df = spark.read.parquet(dataset)
    for stats in (ST.column_stats(df), ST.encoded_bounds(df), ST.encoded_bounds(df, ("part_key",))):
        text = plan(stats)
        assert text.count("FileScan parquet") == 1 and shuffles(text) == 1


def test_known_bbox_is_filtered_natively(spark, dataset):
    assert "Python" not in plan(OG.drop_null_or_empty_geometry(spark.read.parquet(dataset)))


def test_hilbert_sort_shuffles_once(spark, dataset):
    text = plan(L.hilbert_sort(spark.read.parquet(dataset), (0.0, 0.0, 1.0, 1.0)))
    assert shuffles(text) == 1 and "rangepartitioning" in text


def test_pyramid_does_not_shuffle(spark):
    cells = spark.range(1000).select(F.lit("a").alias("layer"), F.col("id").alias("col"), F.col("id").alias("row"), F.lit(1).alias("value"))
    text = plan(R.overviews(cells, 3))
    assert shuffles(text) == 0 and "Python" not in text


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_no_join_compares_all_pairs(spark, threshold):
    box = spark.range(100).select("id", *[F.col("id").cast("double").alias(c) for c in ("xmin", "ymin", "xmax", "ymax")])
    files = box.withColumnRenamed("id", "file").withColumn("has_bound", F.lit(True))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        text = plan(J.prune_files(files, box))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_running_totals_never_partition_by_the_group_alone(spark):
    df = spark.range(100).select(F.lit("g").alias("g"), F.col("id").alias("seq"), F.lit("OK").alias("status"))
    text = plan(W.progress(df, "g", block_rows=10))
    row_windows = [x for x in text.splitlines() if "row_number()" in x]
    assert row_windows and all("_block" in x for x in row_windows)
