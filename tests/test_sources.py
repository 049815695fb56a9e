"""Readers and writers on real files."""

import json
import os
import struct
import subprocess
import sys

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from geoloom.operators import geometry as OG
from geoloom.operators.schema import with_srid
from geoloom.plans import publish as PB
from geoloom.sources import datasets as D
from geoloom.sources import documents as DOC
from geoloom.sources import geojson as GJ
from geoloom.sources import text_tables as TT
from geoloom.streaming import ingest as IN


def put(folder, name, data):
    path = os.path.join(str(folder), name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data if isinstance(data, bytes) else data.encode())
    return path


# file name -> (content, expected names or rejection reason, expected rows)
TEXTS = {
    "latin.csv": ("nombre;valor\nMadrid;1\nÁvila;2\n".encode("latin-1"), ["nombre", "valor"], [("Madrid", "1"), ("Ávila", "2")]),
    "utf8.csv": ("nombre,valor\nÁvila,1\nMadrid,2\n".encode(), ["nombre", "valor"], [("Madrid", "2"), ("Ávila", "1")]),
    "mojibake.csv": ("nombre,valor\nLeón,1\n".encode(), ["nombre", "valor"], [("León", "1")]),
    "ragged.csv": (b"a,b\nx,1\ny,2,3\nz\n", ["a,b"], [("x,1",), ("y,2,3",), ("z",)]),
    "empty.csv": (b"", None, "absent"),
    "numbers.csv": (b"1;2;3\n4;5;6\n", ["column0", "column1", "column2"], [("1", "2", "3"), ("4", "5", "6")]),
    "words.csv": (b"x;y\nu;v\n", ["x", "y"], [("u", "v")]),
    "single.csv": (b"only\none\ntwo\n", ["only"], [("one",), ("two",)]),
    "quoted.csv": (b'a;b\n"x;1";"y\nz"\n;""\n', ["a", "b"], [(None, None), ("x;1", "y\nz")]),
    "holes.csv": (b"a;a;\n1;2;3\n", ["a", "a_1", "column2"], [("1", "2", "3")]),
    "c1.csv": (b"x;y\n\x9f\x80;2\n", ["x", "y"], [("Ÿ€", "2")]),
    "nbsp.csv": (b"x;y\n\xa0;2\n", ["x", "y"], [("\xa0", "2")]),
    "header_only.csv": (b"x;y\n", None, "no rows"),
    "blank_lines.csv": (b"x;y\n1;2\n\n3;4\n", ["x", "y"], [("1", "2"), ("3", "4")]),
    "windows.csv": (b"x;y\r\n1;2\r\n", ["x", "y"], [("1", "2")]),
    "tabs.tsv": (b"x\ty\n1\t2\n", ["x", "y"], [("1", "2")]),
    "pipes.csv": (b"x|y\n1|2\n", ["x", "y"], [("1", "2")]),
    "year_header.csv": (b"2019;2020;name\n1;2;a\n", ["column0", "column1", "column2"], [("1", "2", "a"), ("2019", "2020", "name")]),
    "escaped.csv": (b'a;b\n"he said ""x""";2\n', ["a", "b"], [('he said "x"', "2")]),
    "open_quote.csv": (b'x;y\n"abc;2\n3;4\n', ["x", "y"], [('"abc', "2"), ("3", "4")]),
    "spaces.csv": (b" a ; b\n 1 ; 2\n", ["a", "b"], [(" 1 ", " 2")]),
    "one_row.csv": (b"1;2;3\n", ["column0", "column1", "column2"], [("1", "2", "3")]),
    "one_mixed.csv": (b"1;2;a\n", ["column0", "column1", "column2"], [("1", "2", "a")]),
    "copies.csv": (b"1;2\n1;2\n1;2\n", ["column0", "column1"], [("1", "2")] * 3),
    "word_copies.csv": (b"a;b\na;b\n", ["a", "b"], [("a", "b")]),
    "year_column.csv": (b"x;2019\na;1\nb;2\n", ["column0", "column1"], [("a", "1"), ("b", "2"), ("x", "2019")]),
    "year_and_total.csv": ("n;2019;año\nÁvila;5;6\nM;7;8\n".encode("latin-1"), ["n", "2019", "año"], [("Ávila", "5", "6"), ("M", "7", "8")]),
    "blank_column.csv": (b"x;2019\na;\n", ["x", "2019"], [("a", None)]),
    "dates.csv": (b"fecha;n\n2024-01-01;x\n2024-01-02;y\n", ["fecha", "n"], [("2024-01-01", "x"), ("2024-01-02", "y")]),
}


@pytest.fixture(scope="module")
def texts(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("texts")
    for name, (data, _, _) in TEXTS.items():
        put(folder, name, data)
    tables, rejected = TT.read_text_tables(spark, [str(folder)])
    rows = {}
    for t in tables:
        for r in t.df.collect():
            rows.setdefault(r["_file"].rsplit("/", 1)[1], (t.names, []))[1].append(tuple(r)[:-1])
    return rows, {p.rsplit("/", 1)[1]: why for p, why in rejected}, tables


@pytest.mark.parametrize("name", sorted(TEXTS))
def test_text_file(texts, name):
    rows, rejected, _ = texts
    _, names, want = TEXTS[name]
    if names is None:
        assert rejected.get(name, "absent") == want and name not in rows
    else:
        assert rows[name][0] == names
        assert sorted(rows[name][1], key=repr) == sorted(want, key=repr)


def test_files_of_one_dialect_share_a_reader(texts):
    _, _, tables = texts
    shared = [t for t in tables if t.names == ["x", "y"] and t.delimiter == ";" and t.header and not t.multiline]
    assert sorted(len(t.files) for t in shared)[-1] >= 4


def test_utf8_can_be_preferred(spark, tmp_path):
    put(tmp_path, "a.csv", "nombre,valor\nLeón,1\n".encode())
    assert TT.read_text_table(spark, [str(tmp_path)], prefer=TT.UTF8).first().nombre == "León"


def test_no_readable_file(spark, tmp_path):
    put(tmp_path, "a.csv", b"x;y\n")
    with pytest.raises(ValueError, match="no readable file"):
        TT.read_text_table(spark, [str(tmp_path)])


# --- documents ---------------------------------------------------------------------------------------------------


def test_manifests(spark, tmp_path):
    put(tmp_path, "m/a.json", json.dumps({"x": {"id": "x", "title": "T", "rows": 3}, "y": {"title": "U"}}, indent=1))
    put(tmp_path, "m/b.json", "{broken")
    got = DOC.read_manifest(spark, str(tmp_path / "m")).select("id", "title", "rows").collect()
    assert sorted(map(tuple, got)) == [("x", "T", 3), ("y", "U", None)]
    assert DOC.read_manifest(spark, str(tmp_path / "none")).count() == 0


def test_table_metadata_picks_current_schema_and_last_snapshot(spark, tmp_path):
    field = {"id": 1, "name": "a", "type": "long", "doc": "d"}
    put(
        tmp_path,
        "t/a.json",
        json.dumps(
            {
                "current-schema-id": 7,
                "schemas": [{"schema-id": 3, "fields": []}, {"schema-id": 7, "fields": [field]}],
                "snapshots": [{"summary": {"total-records": "1"}}, {"summary": {"total-records": "5"}}],
            }
        ),
    )
    put(tmp_path, "t/b.json", json.dumps({"schema": {"fields": [field]}}))
    fields, totals = DOC.read_table_metadata(spark, str(tmp_path / "t"))
    assert [(r.file[-6:], r.name) for r in fields.orderBy("file").collect()] == [("a.json", "a"), ("b.json", "a")]
    assert [r.total_records for r in totals.orderBy("file").collect()] == ["5", None]


def test_inventories(spark, tmp_path):
    put(tmp_path, "c.json", '[\n {"id": "A__b", "title": "t"},\n {"id": "B"}\n]')
    assert [tuple(r) for r in DOC.read_inventory(spark, str(tmp_path), DOC.COVERAGE_INVENTORY).collect()] == [("A__b", "t"), ("B", None)]
    put(tmp_path, "p/p.json", json.dumps([{"name": "n", "groups": ["g"], "resources": [{"format": "CSV", "url": "u", "other": 1}]}]))
    row = DOC.read_inventory(spark, str(tmp_path / "p"), DOC.PACKAGE_INVENTORY).first()
    assert row.groups == ["g"] and row.resources[0].url == "u" and row.license is None


# --- features ----------------------------------------------------------------------------------------------------


def feature(i, geometry='{"type":"Point","coordinates":[1,2]}'):
    return '{"type":"Feature","id":"l.%d","geometry":%s,"properties":{"id":%d,"n":"x","k":{"a":1}}}' % (i, geometry, i)


def test_properties_without_schema_stay_a_map(spark, tmp_path):
    doc = '{"type":"FeatureCollection","features":[%s,%s]}' % (feature(1), feature(2, "null"))
    put(tmp_path, "a.geojson", doc)
    good, bad = GJ.read_geojson_features(spark, str(tmp_path), "collection")
    rows = sorted(good.collect(), key=lambda r: r.properties["id"])
    assert [r.properties for r in rows] == [{"id": "1", "n": "x", "k": '{"a":1}'}, {"id": "2", "n": "x", "k": '{"a":1}'}]
    assert rows[0].bbox.asDict() == {"xmin": 1, "ymin": 2, "xmax": 1, "ymax": 2} and rows[1].bbox is None
    assert bad.count() == 0 and good.schema["geom"].metadata["srid"] == 25830


def test_incremental_ingest_adds_each_feature_once(spark, tmp_path):
    landing, target = str(tmp_path / "in"), str(tmp_path / "out")
    put(landing, "a.json", "\n".join([feature(1), feature(2), feature(2), feature(3, '{"type":"Point","coordinates":["x"]}')]))
    IN.ingest_features(spark, landing, target, "id bigint, n string").awaitTermination()
    put(landing, "b.json", "\n".join([feature(1), feature(4)]))
    IN.ingest_features(spark, landing, target, "id bigint, n string").awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(f"{target}/data").collect()) == [1, 2, 4]
    assert [r.id for r in spark.read.parquet(f"{target}/rejects").collect()] == [3]


def test_repeated_batch_is_harmless(spark, tmp_path):
    texts = spark.createDataFrame([(feature(1),), (feature(2),)], "value string")
    for _ in range(2):
        IN.ingest_batch(texts, 0, "id bigint, n string", "id", 25830, str(tmp_path))
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_path}/data").collect()) == [1, 2]


# --- datasets ----------------------------------------------------------------------------------------------------


def points(spark, n, hot=False):
    df = spark.range(n, numPartitions=8).select(
        "id",
        F.when(F.lit(hot) & (F.col("id") % 3 < 2), "hot").otherwise(F.concat(F.lit("p"), (F.col("id") % 4).cast("string"))).alias("p"),
        (F.lit(400000.0) + F.col("id") * 7919 % 100000).alias("x"),
        (F.lit(4430000.0) + F.col("id") * 10007 % 100000).alias("y"),
    )
    from geoloom.functions.geometry import point_wkb

    return with_srid(df.select("id", "p", point_wkb(F.col("x"), F.col("y")).alias("geom")), 25830)


def test_written_files(spark, tmp_path):
    path = str(tmp_path / "v")
    D.write_vector_dataset(OG.add_bbox(points(spark, 4000)), path, ("p",), {"id": "Clave"}, 25830)
    files = sorted(os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet"))
    assert {os.path.basename(os.path.dirname(f)) for f in files} == {"p=p0", "p=p1", "p=p2", "p=p3"}
    for f in files:
        parquet = pq.ParquetFile(f)
        assert parquet.schema_arrow.names == ["id", "geom", "xmin", "ymin", "xmax", "ymax"]
        ids = [int(parquet.schema_arrow.field(i).metadata[b"PARQUET:field_id"]) for i in range(6)]
        assert ids == [1, 2, 3, 4, 5, 6]
        assert parquet.metadata.row_group(0).column(0).compression == "ZSTD"


def test_rows_of_a_file_follow_the_curve(spark, tmp_path):
    import numpy as np

    from geoloom.functions.crs import domain
    from geoloom.functions.hilbert import hilbert_index

    path = str(tmp_path / "v")
    D.write_vector_dataset(OG.add_bbox(points(spark, 4000)), path, ("p",), epsg=25830, bits=24)
    x0, y0, x1, y1 = domain(25830)
    n = (1 << 24) - 1
    for d, _, fs in os.walk(path):
        for f in fs:
            if f.endswith(".parquet"):
                t = pq.read_table(os.path.join(d, f)).to_pandas()
                key = hilbert_index(((t.xmin - x0) / (x1 - x0) * n).to_numpy(), ((t.ymin - y0) / (y1 - y0) * n).to_numpy(), 24)
                assert (np.diff(key) >= 0).all()


def test_a_hot_partition_value_is_written_by_several_tasks(spark, tmp_path):
    path = str(tmp_path / "v")
    D.write_vector_dataset(OG.add_bbox(points(spark, 12000, hot=True)), path, ("p",), epsg=25830)
    back = spark.read.parquet(path)
    assert back.count() == 12000
    hot = [f for f in os.listdir(f"{path}/p=hot") if f.endswith(".parquet")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        D.write_vector_dataset(OG.add_bbox(points(spark, 12000, hot=True)), path + "2", ("p",), epsg=25830)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spread = [f for f in os.listdir(f"{path}2/p=hot") if f.endswith(".parquet")]
    assert len(spread) >= 4 and len(hot) >= 1


def test_index_schema(spark, tmp_path):
    import geoloom.operators.catalog as K

    entries = spark.createDataFrame([("a", "vector", "T", "th", 3)], "id string, kind string, title string, theme string, rows bigint")
    entries = entries.withColumn("bbox", F.lit(None).cast("struct<xmin:double,ymin:double,xmax:double,ymax:double>"))
    path = str(tmp_path / "i")
    D.write_index(K.index_rows(entries, "c", "https://b", "EPSG:25830", "P", "L"), path)
    file = next(f for f in os.listdir(path) if f.endswith(".parquet"))
    schema = pq.ParquetFile(f"{path}/{file}").schema_arrow
    assert [int(f.metadata[b"PARQUET:field_id"]) for f in schema] == list(range(1, 10))
    assert [int(f.metadata[b"PARQUET:field_id"]) for f in schema.field("bbox").type] == [10, 11, 12, 13]
    row = D.read_index(spark, path).first()
    assert row.bbox.xmin == -4.58 and bytes(row.geometry)[:9] == struct.pack("<BII", 1, 3, 1)


@pytest.mark.parametrize("stage", [False, True])
def test_published_bounds_come_from_the_files(spark, tmp_path, stage):
    out = PB.publish_vector(points(spark, 2000), str(tmp_path / "v"), 25830, ("p",), stage=stage)
    files, columns = out["files"].collect(), out["columns"].collect()
    assert sum(r.rows for r in files) == 2000 and all(r.has_bound for r in files)
    assert {r.column for r in columns} == {"id", "geom"} and all(r.has_bound for r in columns)
    e = out["extent"].first()
    assert -4.3 < e.min_lon < e.max_lon < -2.9 and 39.9 < e.min_lat < e.max_lat < 41.0


def test_functions_reach_workers_without_the_package(tmp_path):
    """The Arrow functions are shipped by value: a driver with a changed path and another folder still works."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        f"import sys; sys.path.insert(0, {root!r})\n"
        "import __spark_entry__ as e\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "print('rows', e.entry(s).count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=str(tmp_path), env=env, capture_output=True, text=True, timeout=200)
    assert "rows " in done.stdout, done.stderr[-2000:]


@pytest.mark.parametrize("columns", [61, 62, 63, 124, 200])
def test_header_test_looks_at_every_column(spark, tmp_path, columns):
    rows = ["".join(f"t{r}x{c};" for c in range(columns - 1)) + str(r) for r in range(3)]
    named = ";".join(f"n{c}" for c in range(columns))
    put(tmp_path, "bare.csv", "\n".join(rows) + "\n")
    put(tmp_path, "named.csv", "\n".join([named, *rows]) + "\n")
    tables, rejected = TT.read_text_tables(spark, [str(tmp_path)])
    found = {os.path.basename(t.files[0]): t for t in tables}
    assert not rejected and {k: t.header for k, t in found.items()} == {"bare.csv": False, "named.csv": True}
    assert all(len(t.names) == columns and t.df.count() == 3 for t in tables)
