"""Runs over many layers, documents, acceptance and regions on small hand-made inputs."""

import json

import pytest
from pyspark.sql import functions as F

from geoloom.functions import geometry as G
from geoloom.operators import attributes as A
from geoloom.operators import documents as DOCS
from geoloom.operators.schema import free_names
from geoloom.plans import acceptance as AC
from geoloom.plans import catalog_run as CR
from geoloom.plans import layers as LY
from geoloom.plans import packages as PK
from geoloom.plans import rasters as RS
from geoloom.plans import region as RG
from geoloom.session import scratch_path
from geoloom.sources import documents as DOC

EPSG = 25830


def _feature(x, y, properties):
    return json.dumps({"type": "Feature", "geometry": {"type": "Point", "coordinates": [x, y]}, "properties": properties})


def _lines(spark, rows):
    return spark.createDataFrame(rows, "layer string, value string").repartition(3)


def _inventory(spark, rows):
    return spark.createDataFrame(rows, "name string, ws string, title string, count long")


def _status(df):
    return {r.id: (r.status, r.rows) for r in df.collect()}


# --- layers -------------------------------------------------------------------------------------------------


def test_run_is_resumed_and_repeated(spark):
    path = scratch_path(spark, "runs")
    a = [("w:A", _feature(400000.0 + k, 4450000.0, {"k": k})) for k in range(20)]
    b = [("w:B", _feature(400000.0 + k, 4450000.0, {"k": k, "t": "x"})) for k in range(10)]
    asked = _inventory(spark, [("w:A", "w", "a", 20), ("w:B", "w", "b", 10), ("v:C", "v", "c", 3), ("w:Big", "w", "d", 10**7)])
    first, _ = LY.publish_layers(spark, _lines(spark, a + b[:4] + [("w:Unknown", a[0][1])]), asked, path, EPSG, 1, sizes=(0, 1000))
    want = {"a": ("OK", 20), "b": ("OK-partial(4/10)", 4), "c": ("FAIL", None)}
    assert _status(first) == want
    again, _ = LY.publish_layers(spark, _lines(spark, a + b[:4]), asked, path, EPSG, 1, sizes=(0, 1000))
    assert _status(again) == want  # as if the first one had been lost
    second, _ = LY.publish_layers(spark, _lines(spark, b), asked, path, EPSG, 2, sizes=(0, 1000))
    assert _status(second) == {"a": ("skip", 20), "b": ("OK", 10), "c": ("FAIL", None)}
    assert _status(LY.read_ledger(spark, path)) == _status(second)
    assert LY.read_layer(spark, path, "a").count() == 20 and LY.read_layer(spark, path, "b").count() == 10
    with pytest.raises(ValueError, match="no dataset"):
        LY.read_layer(spark, path, "c")


def test_changed_attributes_and_name_clashes(spark):
    path = scratch_path(spark, "runs")
    asked = _inventory(spark, [("w:A", "w", "a", 2), ("v:a", "v", "a", 2)])
    odd = {"Geom": "g", "xmin": 1, "A b": True, "a B": None, "dataset": 1.5, "q\"'`": "z", "N": {"m": [1, None]}}
    rows = [("w:A", _feature(1.0, 2.0, odd)), ("w:A", _feature(3.0, 4.0, {**odd, "xmin": 2.5})), ("v:a", _feature(5.0, 6.0, {})), ("v:a", _feature(7.0, 8.0, None))]
    results, rejects = LY.publish_layers(spark, _lines(spark, rows), asked, path, EPSG, 1)
    assert _status(results) == {"w_a": ("OK", 2), "v_a": ("OK", 2)} and rejects.count() == 0
    df = LY.read_layer(spark, path, "w_a")
    row = df.orderBy("xmin").first()
    assert df.columns == ["geom_0", "xmin_1", "a b", "a b_3", "dataset_4", "q\"'`", "n", "geom", "xmin", "ymin", "xmax", "ymax"]
    assert [row[c] for c in df.columns[:7]] == ["g", 1.0, True, None, 1.5, "z", '{"m":[1,null]}']
    assert LY.read_layer(spark, path, "v_a").columns == ["geom", "xmin", "ymin", "xmax", "ymax"]


def test_rejected_lines_and_nothing_delivered(spark):
    asked = LY.named_layers(_inventory(spark, [("w:A", "w", "a", 2)]))
    rows = [("w:A", "{"), ("w:A", '{"type":"Thing"}'), ("w:A", '{"type":"Feature","geometry":{"type":"Point","coordinates":["x",1]}}'), ("w:A", "  "), ("w:B", "{"), ("w:A", _feature(1.0, 1.0, {}))]
    good, bad = LY.read_layer_features(_lines(spark, rows), asked)
    assert good.count() == 1 and sorted(r.why for r in bad.collect()) == ["geometry", "no JSON", "no feature"]
    path = scratch_path(spark, "runs")
    results, _ = LY.publish_layers(spark, _lines(spark, []), _inventory(spark, [("w:A", "w", "a", 2)]), path, EPSG, 1)
    assert _status(results) == {"a": ("FAIL", None)}
    empty, _ = LY.publish_layers(spark, _lines(spark, []), _inventory(spark, []), path, EPSG, 2)
    assert empty.collect() == []


def test_attribute_types_of_odd_documents(spark):
    rows = [("d", '{"a":1,"b":true,"c":null}'), ("d", '{"b":false,"a":9223372036854775807}'), ("d", "no json"), ("d", None), ("d", "[1]"), ("e", '{"a":1e3}'), ("e", '{"a":2}'), ("f", '{"a":1}'), ("f", '{"a":"1"}')]
    got = A.attribute_types(spark.createDataFrame(rows, "dataset string, properties string"))
    assert {(r.dataset, r.attribute): (r.type, r.given) for r in got.collect()} == {
        ("d", "a"): ("long", 2), ("d", "b"): ("boolean", 2), ("d", "c"): ("string", 0), ("e", "a"): ("double", 2), ("f", "a"): ("string", 2),
    }
    same = A.signatures(A.attribute_types(spark.createDataFrame([("x", '{"a":1}'), ("y", '{"a":7}'), ("z", '{"a":"7"}')], "dataset string, properties string")))
    told = {r.dataset: r.signature for r in same.collect()}
    assert told["x"] == told["y"] != told["z"]


def test_free_names():
    assert free_names(["A", "a", "Geom", "geom_2"], ("geom",)) == ["a", "a_1", "geom_2", "geom_2_3"]


# --- documents ------------------------------------------------------------------------------------------------


def _some_tables(spark, n):
    tables = spark.createDataFrame(
        [("v3", f"t{k}", f"v3/t{k}", f"https://b/data/v3/t{k}", 3, '{"a":"b"}' if k else None) for k in range(n)],
        "namespace string, name string, key string, location string, format_version int, properties string",
    )
    columns = spark.createDataFrame([(f"v3/t{k}", i, f"c{i}", "long", None) for k in range(n) for i in (2, 1)], "key string, id int, name string, type string, doc string")
    files = spark.createDataFrame([(f"v3/t{k}", f"f{i}", 10, 5) for k in range(1, n) for i in range(k)], "key string, file string, bytes long, rows long")
    return tables, columns, files


def test_table_documents_are_files_that_can_be_read(spark):
    tables, columns, files = _some_tables(spark, 3)
    docs = DOCS.table_documents(tables, columns, files)
    path = scratch_path(spark, "documents")
    DOCS.write_documents(docs, path)
    fields, totals = DOC.read_table_metadata(spark, path)
    assert sorted(r.total_records or "" for r in totals.collect()) == ["", "10", "5"]
    assert fields.count() == 6 and {r.name: r.id for r in fields.collect()} == {"c1": 1, "c2": 2}
    bodies = {r.key: json.loads(r.body) for r in docs.collect()}
    assert bodies["v3/t0"]["snapshots"] == [] and bodies["v3/t0"]["current-snapshot-id"] == -1
    last = bodies["v3/t2"]
    assert last["current-snapshot-id"] == last["snapshots"][0]["snapshot-id"] > 0 and last["properties"]["a"] == "b"
    assert json.loads(last["properties"][DOCS.NAME_MAPPING]) == [{"field-id": 1, "names": ["c1"]}, {"field-id": 2, "names": ["c2"]}]
    assert bodies == {r.key: json.loads(r.body) for r in DOCS.table_documents(tables.repartition(2), columns, files.repartition(3)).collect()}


def test_pages_name_each_other(spark):
    tables, columns, files = _some_tables(spark, 7)
    bodies = DOCS.table_documents(tables, columns, files)
    pages = DOCS.surface_documents(tables.select("namespace", "name", "key").join(bodies, "key"), "https://b", "p", 3)
    docs = {r.key: json.loads(r.body) for r in pages.collect()}
    found, key = [], "v1/p/namespaces/v3/tables"
    while True:
        found += [t["name"] for t in docs[key]["identifiers"]]
        token = docs[key].get("next-page-token")
        if token is None:
            break
        key = f"v1/p/namespaces/v3/tables.{token}"
    assert found == [f"t{k}" for k in range(7)]
    one = docs["v1/p/namespaces/v3/tables/t3"]
    assert one["metadata-location"] == "https://b/data/v3/t3/metadata/v1.metadata.json" and one["config"] == {} and one["metadata"]["location"].endswith("/t3")
    assert docs["v1/config"] == {"defaults": {}, "overrides": {"prefix": "p"}} and docs["v1/p/namespaces/v3"] == {"namespace": ["v3"], "properties": {}}
    none = DOCS.surface_documents(tables.filter("1 = 0").select("namespace", "name", "key", F.lit("{}").alias("body")), "https://b", "p")
    assert [r.key for r in none.collect()] == ["v1/config"]


def test_collection_documents_by_kind(spark):
    rows = [("a", 'A "quoted"', None, None, "vector", (0.0, 1.0, 2.0, 3.0), "a", 7, None, "https://s"), ("r", "R", "d", "MIT", "raster", None, None, None, "https://x/r.parquet", None)]
    schema = "id string, title string, description string, license string, kind string, bbox struct<xmin:double,ymin:double,xmax:double,ymax:double>, table string, snapshot long, href string, source string"
    docs = {r.key: json.loads(r.body) for r in DOCS.collection_documents(spark.createDataFrame(rows, schema), "https://b", "https://r", "https://e").collect()}
    a, r = docs["a/collection.json"], docs["r/collection.json"]
    assert a["title"] == 'A "quoted"' and a["extent"]["spatial"]["bbox"] == [[0.0, 1.0, 2.0, 3.0]] and a["iceberg:current_snapshot_id"] == 7
    assert a["assets"]["iceberg"]["href"] == "https://b/data/v3/a" and a["assets"]["data"]["href"] == "https://b/a/a.parquet" and len(a["links"]) == 3
    assert set(r["assets"]) == {"data"} and r["assets"]["data"]["title"].startswith("Raquet") and "extent" not in r and "iceberg:table_id" not in r


# --- acceptance and regions -----------------------------------------------------------------------------------


def test_accept_tells_what_is_wrong(spark):
    path = scratch_path(spark, "points")
    rows = spark.range(100).select("id", G.point_wkb(F.col("id").cast("double"), F.lit(0.0)).alias("geom"), *[F.col("id").cast("double").alias(c) for c in ("xmin",)], F.lit(0.0).alias("ymin"), F.col("id").cast("double").alias("xmax"), F.when(F.col("id") != 5, 0.0).alias("ymax"))
    rows.coalesce(1).write.parquet(path)
    ring = [[[(-1.0, -1.0), (9.5, -1.0), (9.5, 1.0), (-1.0, 1.0)]]]
    told = {r.check: (r.value, r.ok) for r in AC.accept(spark, path, EPSG, (-1.0, -1.0, 9.5, 1.0), ring, want=101).collect()}
    assert told["rows"] == (100, False) and told["unbounded_rows"] == (1, False) and told["null_geometries"] == (0, True)
    assert told["in_box"] == (10, True) and told["srid"] == (EPSG, True) and told["files"] == (1, True) and told["files_in_box"] == (1, True)


def test_every_layout_rule_has_a_cause():
    from geoloom.operators.quality import LAYOUT_RULES

    assert set(AC.CAUSES) == set(LAYOUT_RULES)


def test_region_leaves_out_rows_without_geometry_or_box(spark):
    source, path = scratch_path(spark, "source"), scratch_path(spark, "region")
    box = "named_struct('xmin', {0}, 'ymin', {0}, 'xmax', {0} + 1, 'ymax', {0} + 1)"
    x = "cast(id as double)"
    df = spark.range(20).select("id", G.point_wkb(F.expr(x), F.expr(x)).alias("geometry"), F.expr(box.format(x)).alias("bbox"), F.lit("p").alias("BBOX_"), F.lit(1).alias("Geom"))
    df = df.withColumn("geometry", F.when(F.col("id") != 3, F.col("geometry")))
    df = df.withColumn("bbox", F.when(F.col("id") == 4, F.expr(box.format("double('NaN')"))).when(F.col("id") == 6, F.expr("named_struct('xmin', 6D, 'ymin', 6D, 'xmax', double('Infinity'), 'ymax', 7D)")).otherwise(F.col("bbox")))
    df.write.parquet(source)
    out = RG.publish_region(spark, source, path, (2.0, 2.0, 8.0, 8.0), 4326)
    found = spark.read.parquet(path)
    assert sorted(r.id for r in found.collect()) == [2, 5, 7, 8] and found.columns == ["id", "bbox_", "geom_2", "geom", "xmin", "ymin", "xmax", "ymax"]
    assert out["files"].agg(F.sum("rows")).first()[0] == 4


# --- grids and the whole catalog ------------------------------------------------------------------------------


def _grid_inventory(spark, ids):
    rows = [(i, f"title of {i}" if i else None, 440000.0, 4480000.0, 5.0, -5.0) for i in ids]
    return spark.createDataFrame(rows, "id string, title string, origin_x double, origin_y double, pixel_x double, pixel_y double")


def test_grid_run_is_resumed(spark):
    path = scratch_path(spark, "grids")
    cells = [("T__a", c, r, c * r % 5) for c in range(9) for r in range(5)] + [("b", 0, 0, 7), ("b", 0, 0, 3), ("other", 1, 1, 1)]
    df = spark.createDataFrame(cells, "layer string, col long, row long, value int").repartition(3)
    first = RS.publish_rasters(spark, df.filter("layer = 'T__a'"), _grid_inventory(spark, ["T__a", "b", "none"]), path, EPSG, 1, 4)
    assert {r.id: (r.status, r.tiles, r.levels) for r in first.collect()} == {"t_a": ("OK", 3 * 2 + 2 + 1, 3), "b": ("FAIL", None, None), "none": ("FAIL", None, None)}
    again = RS.publish_rasters(spark, df, _grid_inventory(spark, ["T__a", "b", "none"]), path, EPSG, 2, 4)
    assert {r.id: (r.status, r.tiles) for r in again.collect()} == {"t_a": ("skip", 9), "b": ("OK", 1), "none": ("FAIL", None)}
    told = {r.id: r for r in RS.read_ledger(spark, path).collect()}
    assert told["t_a"].theme == "T" and told["t_a"].src == "data/dataset=t_a" and len(told["t_a"].wgs) == 4 and told["none"].wgs is None
    tiles = spark.read.parquet(f"{path}/data")
    one = tiles.filter("dataset = 'b'").first()
    assert one["cells"] == [7] + [None] * 15  # of two values of a place the greatest
    top = tiles.filter("dataset = 't_a' and level = 2").first()
    assert top["cells"][:3] == [0, 0, 0] and top["cells"][4:6] == [0, 16 % 5]


def test_catalog_of_nothing_and_of_clashing_ids(spark):
    manifest = "id string, title string, theme string, rows long, bbox struct<xmin:double,ymin:double,xmax:double,ymax:double>, src string"
    files_of, columns_of = "src string, file string, bytes long, rows long", "src string, id int, name string, type string, doc string"
    settings = dict(collection="c", base="https://b", crs="EPSG:25830", provider="p", license="l", prefix="x")

    def run(vector, tabular, files, columns):
        path = scratch_path(spark, "catalog")
        frames = [spark.createDataFrame(r, s) for r, s in ((vector, manifest), (tabular, manifest), ([], manifest), (files, files_of), (columns, columns_of))]
        return path, {r.part: r.n for r in CR.publish_catalog(spark, *frames, path, **settings).collect()}

    _, none = run([], [], [], [])
    assert none == {"index": 0, "tables": 0, "documents": 1}
    path, told = run(
        [("a", "A", "t", 5, (0.0, 0.0, 1.0, 1.0), "v/a"), ("gone", "G", "t", 5, None, "v/gone")], [("a", "A as a table", "t", 5, None, "t/a")],
        [("v/a", "v/a/1", 10, 5), ("t/a", "t/a/1", 10, 5)], [("v/a", 1, "c", "long", None), ("t/a", 1, "c", "long", "d")],
    )
    assert told == {"vector": 1, "tabular": 1, "index": 2, "tables": 2, "documents": 1 + 1 + 2 + 2 + 2}
    assert sorted(r.id for r in spark.read.parquet(f"{path}/index").collect()) == ["a", "a__tab"]
    bodies = {r.key: json.loads(r.body) for r in spark.read.parquet(f"{path}/documents").collect()}
    assert bodies["v1/x/namespaces/tab/tables"]["identifiers"] == [{"namespace": ["tab"], "name": "a__tab"}]
    assert bodies["v1/x/namespaces/v3/tables/a"]["metadata"]["properties"]["crs"] == "EPSG:25830"


def test_package_run(spark, tmp_path):
    landing, path = tmp_path / "landing", scratch_path(spark, "packages")
    landing.mkdir()
    res = lambda *r: [{"format": f, "url": u} for f, u in r]
    rows = [
        ("A one", "A", "MIT", ["g"], res(("PDF", "p"), ("CSV", "u"))), ("b", "B", None, [], res(("CSV", ""), ("CSV", "u"))), ("c", "C", None, None, res(("CSV", None))),
        ("d", "D", None, [], res(("CSV", "u"))), ("e", "E", None, [], res(("CSV", "u"))), ("f", "F", None, [], res(("SHP", "u"))), ("g", "G", None, [], res(("CSV", "u"))),
    ]
    packages = spark.createDataFrame(rows, "name string, title string, license string, groups array<string>, resources array<struct<format:string,url:string>>")
    none = PK.publish_packages(spark, packages, str(landing), path, 1)
    assert _status(none) == {"a_one": ("FAIL-download", None), "b": ("FAIL-download", None), "c": ("no-csv", None), "d": ("FAIL-download", None), "e": ("FAIL-download", None), "g": ("FAIL-download", None)}
    (landing / "a_one.csv").write_bytes("x;ñ\n1;a\n2;b\n".encode("latin-1"))
    (landing / "b.csv").write_text("X,y\n1,2\n")
    (landing / "d.csv").write_text("\n\n")
    (landing / "e.csv").write_text("x;y\n")
    (landing / "unknown.csv").write_text("x;y\n1;2\n")
    out = PK.publish_packages(spark, packages, str(landing), path, 2)
    assert _status(out) == {"a_one": ("OK(2)", 2), "b": ("OK(1)", 1), "c": ("no-csv", None), "d": ("empty", None), "e": ("empty", None), "g": ("FAIL-download", None)}
    one = out.filter("id = 'a_one'").first()
    assert (one.theme, one.license) == ("g", "MIT") and sorted(map(tuple, spark.read.parquet(f"{path}/{one.src}").collect())) == [("1", "a"), ("2", "b")]
    assert PK.publish_packages(spark, packages, str(landing), path, 3).filter("status = 'skip'").count() >= 2
