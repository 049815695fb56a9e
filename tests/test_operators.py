"""Operators on small frames: hot keys against brute force, errors, goldens and settled defects."""

import random
import struct
from collections import Counter, defaultdict

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from geoloom.functions import geometry as G
from geoloom.operators import catalog as K
from geoloom.operators import geometry as OG
from geoloom.operators import joins as J
from geoloom.operators import layout as L
from geoloom.operators import quality as Q
from geoloom.operators import raster as R
from geoloom.operators import schema as S
from geoloom.operators import setops as U
from geoloom.operators import stats as ST
from geoloom.operators import windows as W

rng = random.Random(7)


# --- hot keys: one key has a third of the rows -----------------------------------------------------------------


def hot(n, keys=40):
    return ["hot" if i % 3 == 0 else f"k{rng.randrange(keys)}" for i in range(n)]


def test_latest_with_a_hot_id(spark):
    rows = [(k, i, f"v{i}") for i, k in enumerate(hot(3000))]
    rng.shuffle(rows)
    want = {}
    for k, i, v in sorted(rows, key=lambda r: r[1]):
        want[k] = (i, v)
    got = U.latest_per_id(spark.createDataFrame(rows, "id string, seq int, v string").repartition(8))
    assert {r.id: (r.seq, r.v) for r in got.collect()} == want


def test_progress_with_a_hot_group(spark):
    rows = [(k, i, rng.choice(["OK", "OK-partial(1/2)", "skip", "FAIL:x"])) for i, k in enumerate(hot(2000, 5))]
    want, seen = {}, defaultdict(lambda: [0, 0])
    totals = Counter(k for k, _, _ in rows)
    for k, i, s in rows:
        seen[k][0] += 1
        seen[k][1] += s[0] == "F"
        want[i] = (seen[k][0], seen[k][0] - seen[k][1], seen[k][1], totals[k])
    df = spark.createDataFrame(rows, "g string, seq int, status string").repartition(8)
    for block in (1, 7, 500, 10**6):
        got = W.progress(df, "g", block_rows=block).collect()
        assert {r.seq: (r.i, r.ok, r.fail, r.total) for r in got} == want


def test_progress_window_is_bounded_by_the_block(spark):
    df = spark.createDataFrame([("hot", i, "OK") for i in range(100)], "g string, seq int, status string")
    plan = W.progress(df, "g", block_rows=10)._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(g#" in plan and "_block#" in plan


def test_disambiguate_with_a_hot_slug(spark):
    rows = [(i, f"WS{i % 3}", k) for i, k in enumerate(hot(900, 400))]
    many = {s for s, n in Counter(r[2] for r in rows).items() if n > 1}
    df = spark.createDataFrame(rows, "i int, ws string, s string")
    got = {r.i: r.id for r in W.disambiguate_ids(df, F.col("s"), F.col("ws")).collect()}
    assert got == {i: f"{w.lower()}_{s}" if s in many else s for i, w, s in rows}


def test_namespace_with_most_tables_is_paged(spark):
    names = [("hot", f"t{i:05}") for i in range(1000)] + [("b", f"t{i}") for i in range(15)] + [("b", "t1")]
    got = K.namespace_listing(spark.createDataFrame(names, "namespace string, name string").repartition(8), 100).collect()
    sizes = sorted((r.namespace, r.page, r.tables) for r in got)
    assert sizes == [("b", 0, 15), *[("hot", p, 100) for p in range(10)]]
    first = next(r for r in got if (r.namespace, r.page) == ("hot", 3))
    assert first.identifiers.startswith('[{"namespace":["hot"],"name":"t00300"}')


def test_tiles_merge_copies_of_a_cell(spark):
    cells = [("a", c, r, c * 100 + r) for c in range(5) for r in range(5)] + [("a", 1, 1, 101)] * 500
    df = spark.createDataFrame(cells, "layer string, col bigint, row bigint, value int").repartition(8)
    tiles = {(t.tx, t.ty): t.cells for t in R.to_tiles(df, 4).collect()}
    assert tiles.keys() == {(0, 0), (0, 1), (1, 0), (1, 1)}
    assert tiles[0, 0] == [c * 100 + r for r in range(4) for c in range(4)]
    assert tiles[1, 1] == [404] + [None] * 15


def test_hot_cell_is_cut_over_partitions_in_order(spark):
    pts = [(1.0, 1.0)] * 3000 + [(float(rng.randrange(100)), float(rng.randrange(100))) for _ in range(3000)]
    df = spark.createDataFrame([(i, x, y, x, y) for i, (x, y) in enumerate(pts)], "id int, xmin double, ymin double, xmax double, ymax double").repartition(16)
    out = L.hilbert_sort(df, (0, 0, 100, 100), 8, partitions=8, keep_key=True).withColumn("p", F.spark_partition_id())
    rows = out.collect()
    assert sorted(r.id for r in rows) == list(range(6000))
    keys = [r.hilbert for r in rows]
    assert keys == sorted(keys)
    sizes = Counter(r.p for r in rows)
    assert len({r.p for r in rows if r.xmin == r.ymin == 1.0}) > 1 and max(sizes.values()) < 3000


def test_global_position(spark):
    names = [rng.choice(["x", f"n{rng.randrange(10**6)}"]) for _ in range(2000)]
    df = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "n string, i int").repartition(8)
    got = {r.i: r.position for r in L.with_global_position(df, ["n", "i"]).collect()}
    assert got == {i: p for p, (_, i) in enumerate(sorted((n, i) for i, n in enumerate(names)))}


# --- joins -----------------------------------------------------------------------------------------------------


def boxes(n, big):
    out = []
    for i in range(n):
        w, h = (rng.choice([0, 1, 30, 900, big]) * rng.random() for _ in range(2))
        x, y = rng.uniform(-5000, 5000), rng.uniform(-5000, 5000)
        out.append((i, x, y, x + w, y + h))
    return out


BOX = "id int, xmin double, ymin double, xmax double, ymax double"


@pytest.mark.parametrize("base, step", [(100.0, 2), (1000.0, 4), (1e6, 4)])
def test_overlap_pairs_equal_brute_force(spark, base, step):
    a, b = boxes(120, 6000), boxes(150, 20000)
    a += [(900, 0.0, 0.0, 100.0, 100.0), (901, -100.0, -100.0, 0.0, 0.0)]
    b += [(900, 100.0, 100.0, 200.0, 200.0), (901, 0.0, 0.0, 0.0, 0.0)]
    want = sorted((p[0], q[0]) for p in a for q in b if p[1] <= q[3] and p[3] >= q[1] and p[2] <= q[4] and p[4] >= q[2])
    pairs = J.overlap_pairs(spark.createDataFrame(a, BOX), spark.createDataFrame(b, BOX), base, step).collect()
    assert sorted((r.l_id, r.r_id) for r in pairs) == want


def test_pruning_keeps_every_file_with_a_match(spark):
    files = spark.createDataFrame(
        [("a", 0.0, 0.0, 10.0, 10.0, True), ("b", 20.0, 20.0, 30.0, 30.0, True), ("c", 0.0, 0.0, 0.0, 0.0, False)],
        "file string, xmin double, ymin double, xmax double, ymax double, has_bound boolean",
    )
    query = spark.createDataFrame([(1, 10.0, 10.0, 12.0, 12.0), (2, 50.0, 50.0, 51.0, 51.0), (3, 0.0, 0.0, 99.0, 99.0)], BOX)
    got = {r.box: (r.scanned, r.total) for r in J.prune_files(files, query).collect()}
    assert got == {1: (2, 3), 2: (1, 3), 3: (3, 3)}


def test_unreadable_output_is_a_failure(spark):
    expected = spark.createDataFrame([(1, 5), (2, 5), (3, 5), (4, 5), (5, 0)], "id int, want int")
    existing = spark.createDataFrame([(1, 5), (2, 4)], "id int, rows int")
    converted = spark.createDataFrame([(2, 4), (3, -1), (5, 0)], "id int, rows int")
    got = {r.id: r.status for r in J.reconcile(expected, existing, converted).collect()}
    assert got == {1: "skip", 2: "OK-partial(4/5)", 3: "FAIL", 4: "FAIL", 5: "OK"}


# --- geometry --------------------------------------------------------------------------------------------------


def test_footprint_bytes(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0, 4.0)], "xmin double, ymin double, xmax double, ymax double")
    want = struct.pack("<BIII", 1, 3, 1, 5) + struct.pack("<10d", 1, 2, 3, 2, 3, 4, 1, 4, 1, 2)
    assert bytes(OG.dataset_footprints(df).first().footprint) == want


def test_wrong_srid_is_an_error(spark):
    df = S.with_srid(spark.createDataFrame([(bytearray(b"x"), 4326)], "geom binary, srid int"), 25830)
    with pytest.raises(ValueError, match="Incompatible SRID"):
        OG.assert_srid(df, 4326)
    with pytest.raises(ValueError, match="Incompatible SRID"):
        OG.intersects(df, [[[(0, 0), (1, 0), (1, 1)]]], 4326)
    with pytest.raises(PySparkException, match="Incompatible SRID"):
        OG.assert_srid(df, 25830, srid="srid").collect()


def test_unknown_srid_is_an_error(spark):
    df = spark.createDataFrame([(bytearray(b"x"),)], "geom binary")
    with pytest.raises(ValueError, match="data None"):
        OG.assert_srid(df, 25830)


GEOJSON = [
    '{"type":"Point","coordinates":[1.5,2.5]}',
    '{"type":"LineString","coordinates":[[0.0,0.0],[1.0,1.0]]}',
    '{"type":"Polygon","coordinates":[[[0.0,0.0],[4.0,0.0],[4.0,4.0],[0.0,0.0]],[[1.0,0.5],[2.0,0.5],[2.0,1.0],[1.0,0.5]]]}',
    '{"type":"MultiPoint","coordinates":[[1.0,1.0],[2.0,2.0]]}',
    '{"type":"MultiLineString","coordinates":[[[0.0,0.0],[1.0,1.0]],[[2.0,2.0],[3.0,3.0],[4.0,4.0]]]}',
    '{"type":"MultiPolygon","coordinates":[[[[0.0,0.0],[1.0,0.0],[1.0,1.0],[0.0,0.0]]],[[[5.0,5.0],[6.0,5.0],[6.0,6.0],[5.0,5.0]]]]}',
    '{"type":"Polygon","coordinates":[]}',
]


def test_geojson_round_trip_and_families(spark):
    df = spark.createDataFrame([(i, g) for i, g in enumerate(GEOJSON)], "id int, geometry string")
    good, bad = OG.encode_geometry(df)
    assert bad.count() == 0
    back = good.select("id", G.geojson_text(G.wkb_type_code(F.col("geom")), G.wkb_parts(F.col("geom"))).alias("t"), G.geometry_family(F.col("geom")).alias("f"))
    rows = {r.id: (r.t, r.f) for r in back.collect()}
    assert [rows[i][0] for i in range(len(GEOJSON))] == GEOJSON
    assert [rows[i][1] for i in range(len(GEOJSON))] == ["Point", "LineString", "Polygon", "Point", "LineString", "Polygon", "Polygon"]


def test_unreadable_geometries_are_set_aside(spark):
    texts = ["{", '{"type":"Point"}', '{"type":"Point","coordinates":[1]}', '{"type":"Point","coordinates":"x"}', None]
    good, bad = OG.encode_geometry(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, geometry string"))
    assert {r.id for r in bad.collect()} == {0, 1, 2, 3}
    assert [(r.id, r.geom) for r in good.collect()] == [(4, None)]


def test_type_code_reads_the_header_natively(spark):
    values = [struct.pack(">BIdd", 0, 1, 1, 2), struct.pack("<BIddd", 1, 3003, 1, 2, 3), struct.pack("<BI", 1, 0x20000006), b"\x01"]
    df = spark.createDataFrame([(i, bytearray(v)) for i, v in enumerate(values)], "i int, g binary")
    got = [r[0] for r in df.orderBy("i").select(G.wkb_type_code(F.col("g"))).collect()]
    assert got == [1, 3, 6, None]


def test_features_without_geometry_or_attributes(spark):
    df = spark.createDataFrame([(None, None)], "geom binary, name string")
    assert OG.export_features(df).first().value == '{"type":"Feature","geometry":null,"properties":{"name":null}}'
    assert OG.export_features(df.select("geom")).first().value == '{"type":"Feature","geometry":null,"properties":{}}'


def test_export_never_loses_a_geometry(spark):
    collection = struct.pack("<BII", 1, 7, 1) + struct.pack("<BIdd", 1, 1, 1, 2)
    for value in (collection, b"x"):
        with pytest.raises(PySparkException, match="cannot be written"):
            OG.export_features(spark.createDataFrame([(bytearray(value),)], "geom binary")).collect()


def test_reprojection_keeps_collections(spark):
    collection = struct.pack("<BII", 1, 7, 1) + struct.pack("<BIdd", 1, 1, 500000, 0)
    df = OG.add_bbox(spark.createDataFrame([(1, bytearray(collection))], "id int, geom binary"))
    row = OG.reproject(df, 25830).first()
    assert bytes(row.geom)[:14] == collection[:14] and abs(row.xmin + 3) < 1e-9 and abs(row.ymax) < 1e-9


def test_all_nan_column_has_no_bounds(spark):
    df = spark.createDataFrame([(float("nan"), 1.0), (float("nan"), float("nan"))], "a double, b double")
    got = {r.column: (r.lower, r.upper, r.null_count) for r in ST.column_stats(df).collect()}
    assert got == {"a": (None, None, 0), "b": ("1.0", "1.0", 0)}


def test_non_finite_geometries_are_counted(spark):
    inf = struct.pack("<BIdd", 1, 1, float("inf"), 2)
    df = spark.createDataFrame([(bytearray(inf),), (None,), (bytearray(struct.pack("<BII", 1, 3, 0)),)], "geom binary")
    assert Q.audit_geometries(df).first().asDict() == {"rows": 3, "null_geometries": 1, "empty_geometries": 1, "unreadable_geometries": 0, "non_finite_bbox": 1}


# --- statistics and settled defects ------------------------------------------------------------------------------


def test_infinite_maximum_makes_both_bounds_placeholders(spark):
    df = spark.createDataFrame([(1.0,), (float("inf"),)], "v double")
    row = ST.encoded_bounds(df).first()
    assert not row.has_bound and bytes(row.lower) == bytes(row.upper) == struct.pack("<d", 0.0)


def test_geometry_bound_and_null_count(spark):
    df = spark.createDataFrame([(bytearray(b"x"), 1.0, 2.0, 3.0, 4.0), (None, None, None, None, None)], "geom binary, xmin double, ymin double, xmax double, ymax double")
    rows = ST.encoded_bounds(df).collect()
    assert [r.column for r in rows] == ["geom"]
    r = rows[0]
    assert (r.kind, r.value_count, r.null_count, r.has_bound) == ("geometry", 2, 1, True)
    assert bytes(r.lower) == struct.pack("<dd", 1, 2) and bytes(r.upper) == struct.pack("<dd", 3, 4)
    empty = ST.encoded_bounds(df.filter("xmin is null")).first()
    assert not empty.has_bound and bytes(empty.upper) == struct.pack("<dd", 0, 0)


def test_statistics_of_an_empty_table(spark):
    df = spark.createDataFrame([], "a int, b string, c double")
    assert [(r.column, r.value_count, r.null_count, r.lower) for r in ST.column_stats(df).collect()] == [("a", 0, 0, None), ("b", 0, 0, None), ("c", 0, 0, None)]


def test_geometry_is_required(spark):
    columns = spark.createDataFrame([("d", 1, "a", "VARCHAR")], "dataset string, ordinal int, column string, type string")
    with pytest.raises(PySparkException, match="d: no geometry column"):
        S.require_geometry(S.detect_geometry(columns)).collect()


def test_exact_names_only(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int").toDF("OGC_FID", "ogc_fid")
    assert S.drop_columns(df).columns == ["ogc_fid"]
    assert S.lowercase_names(df).columns == ["ogc_fid", "ogc_fid_1"]


def test_description_is_cut_in_bytes(spark):
    df = S.with_field_ids(spark.createDataFrame([(1,)], "a int"), {"a": "ñ" * 200})
    assert df.schema["a"].metadata["comment"] == "ñ" * 150


def test_partition_columns_get_no_id(spark):
    df = S.with_field_ids(spark.createDataFrame([(1, 2, 3)], "a int, p int, b int"), partition_by=("p",))
    assert [f.metadata.get(S.FIELD_ID) for f in df.schema] == [1, None, 2]


def test_blob_text(spark):
    df = spark.createDataFrame([(bytearray(b"a'\x00\xffz"),), (bytearray(b""),), (None,)], "b binary")
    assert [r.b for r in S.coerce_types(df).collect()] == ["a\\x27\\x00\\xFFz", "", None]


def test_nested_values_as_text(spark):
    df = spark.sql("select array(1.5D, null) as l, struct(1 as a, 'x' as b) as s, map('k', 2) as m, cast(1.50 as decimal(5,2)) as d")
    assert S.coerce_types(df).first().asDict() == {"l": "[1.5, NULL]", "s": "{'a': 1, 'b': x}", "m": "{k=2}", "d": "1.50"}


def test_records(spark):
    rows = [
        ("https://x.org/c", "a.b", "attach", "https://git.org/r", '{"source":"s","processing":"p","extra":1}'),
        ("no uri", "a.b.c", "ftp", "x", "[1]"),
        (None, None, None, None, None),
        (None, None, None, None, '{"source":1,"processing":"p"}'),
        (None, "a.b\n", None, None, "{"),
    ]
    df = spark.createDataFrame(rows, "iceberg_endpoint string, iceberg_table string, access string, source_repo string, provenance string")
    got = [sorted(r.violations) for r in Q.validate_records(df).collect()]
    assert got == [
        [],
        ["access", "iceberg_endpoint", "iceberg_table", "provenance", "source_repo"],
        [],
        ["provenance.source.type"],
        ["iceberg_table", "provenance"],
    ]


def test_record_documents(spark):
    docs = [
        '{"x:iceberg_table":"a.b","x:access":"attach","other":1,"x:provenance":{"source":"s","processing":"p"}}',
        '{"x:iceberg_table":5,"x:access":null,"x:provenance":{"source":"s"}}',
        '{"iceberg_table":"bad"}',
    ]
    df = Q.records_from_json(spark.createDataFrame([(d,) for d in docs], "doc string"), "doc", "x:")
    got = [sorted(r.violations) for r in Q.validate_records(df).collect()]
    assert got == [[], ["access", "iceberg_table", "provenance.processing"], []]


def test_nothing_existing_is_deleted(spark):
    old = spark.createDataFrame([("a", 1), ("b", 1)], "id string, v int")
    new = spark.createDataFrame([("b", 2), ("c", 2)], "id string, v int")
    assert sorted(map(tuple, U.add_only(old, new).collect())) == [("a", 1), ("b", 2), ("c", 2)]


def test_difference_counts_copies(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "v int")
    b = spark.createDataFrame([(1,), (3,)], "v int")
    assert sorted(map(tuple, U.missing_or_extra(a, b).collect())) == [(1, "missing"), (2, "missing"), (3, "extra")]


def test_pyramid_of_one_tile_is_empty(spark):
    df = spark.createDataFrame([("a", 3, 2, 9)], "layer string, col bigint, row bigint, value int")
    assert R.overviews(df, size=16).count() == 0


def test_records_of_other_publishers(spark):
    urls = ["https://Datos.Example.org/a", "http://ok.org/?u=https://datos.example.org", None, "not a url"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    assert [r.url for r in K.exclude_sources(df, ["datos.example.org"]).collect()] == urls[1:]
