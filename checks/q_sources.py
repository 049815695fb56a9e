"""Readers and writers: files are written from the driver tables and read back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from checks import common as C
from checks.q_catalog import BASE, index
from checks.q_geometry import _feature_text
from checks.registry import fixture, query, table
from geoloom.functions import text as TX
from geoloom.operators import geometry as OG
from geoloom.operators import setops as U
from geoloom.operators import stats as ST
from geoloom.plans import explore as EX
from geoloom.plans import publish as PB
from geoloom.session import scratch_path
from geoloom.sources import datasets as D
from geoloom.sources import documents as DOC
from geoloom.sources import geojson as GJ
from geoloom.sources import text_tables as TT
from geoloom.streaming import ingest as IN

LATIN1_TEXT = "^[\\x00-\\x7F\\xA0-\\xFF]*$"
WIDE_FILE_ROWS = 100_000


@query("s01_read_text_table", "select cast(doc_id as varchar) as doc_id, lang, source, md5(text) as digest, cast(n_chars as varchar) as n_chars from documents")
def s01(spark, sf):
    """All documents as three dialects: Latin-1 with semicolons, UTF-8 with commas, UTF-8 with tabs."""
    df = table(spark, sf, "documents").select("doc_id", "lang", "source", "text", "n_chars")
    third = F.col("doc_id") % 3
    latin = (third == 0) & F.col("text").rlike(LATIN1_TEXT)
    dialects = [
        (df.filter(latin), "ISO-8859-1", ";"),
        (df.filter(~latin & (third < 2)), "UTF-8", ","),
        (df.filter(third == 2), "UTF-8", "\t"),
    ]
    path = scratch_path(spark, "text")
    for i, (part, encoding, mark) in enumerate(dialects):
        writer = part.write.option("header", True).option("sep", mark).option("encoding", encoding)
        writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        writer.option("escape", '"').option("quoteAll", True).csv(f"{path}/d{i}")
    out = TT.read_text_table(spark, [f"{path}/d{i}" for i in range(3)], prefer=TT.UTF8)
    digest = F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("digest")
    return out.select("doc_id", "lang", "source", digest, "n_chars")


@query("s01_read_ledger_csv", "select cast(o_orderkey as varchar) as \"key\", o_orderstatus as estado, cast(round(o_totalprice, 2) as varchar) as importe from orders")
def s01_orders(spark, sf):
    """A plain statistics file without quotes, in Latin-1 with semicolons and accents in the header."""
    path = scratch_path(spark, "ledger")
    df = table(spark, sf, "orders")
    rows = df.select(
        F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("situación"), F.round("o_totalprice", 2).cast("string").alias("importe")
    )
    rows.write.option("header", True).option("sep", ";").option("encoding", "ISO-8859-1").csv(path)
    return TT.read_text_table(spark, [path]).select("key", F.col("situación").alias("estado"), "importe")


def _wide(columns):
    """Columns of a wide file: texts, and a number in the last three."""
    texts = [F.concat(F.lit(f"t{i}-"), F.col("o_orderkey").cast("string")).alias(f"c{i}") for i in range(columns - 3)]
    return [*texts, F.col("o_orderkey").alias("k"), F.round("o_totalprice", 2).cast("string").alias("price"), (F.col("o_orderkey") % 7).alias("digit")]


@query(
    "s01_wide_files",
    "select files, header, cast(o_orderkey as varchar) as \"key\", cast(o_orderkey % 7 as varchar) as digit from orders,"
    " (values ('plain', false), ('named', true)) f(files, header)",
)
def s01_wide(spark, sf):
    """Seventy-three columns of which only the last three are typed, with and without a header line."""
    path = scratch_path(spark, "wide")
    df = table(spark, sf, "orders").select(*_wide(73))
    for name, header in (("plain", False), ("named", True)):
        # a compressed file is read by one task, so its rows are bounded; at the fastest level these lines shrink to a fifth
        writer = df.write.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", WIDE_FILE_ROWS)
        writer.option("header", header).option("sep", ";").csv(f"{path}/{name}")
    tables, _ = TT.read_text_tables(spark, [path])
    parts = []
    for t in tables:
        key, digit = (F.col(f"`{t.df.columns[i]}`") for i in (70, 72))
        parts.append(t.df.select(F.regexp_extract("_file", "wide[^/]*/([a-z]+)/", 1).alias("files"), F.lit(t.header).alias("header"), key.alias("key"), digit.alias("digit")))
    return reduce(lambda a, b: a.unionAll(b), parts)


def _features(spark, sf):
    f = fixture(spark, sf, "F2")
    geometry = F.coalesce(_feature_text(f), F.lit("null"))
    properties = F.to_json(F.struct("id", "part_key", "attr"))
    feature = F.concat(F.lit('{"type":"Feature","geometry":'), geometry, F.lit(',"properties":'), properties, F.lit("}"))
    return f.select("id", feature.alias("value"))


_GOOD = "geom_state in ('null', 'empty') or (id % 29 <> 0 and id % 31 <> 0)"
_GEOJSON = (
    "select id, part_key, attr, case when geom_state = 'polygon' then x0 end as xmin, case when geom_state = 'polygon' then y0 + h end as ymax,"
    f" 'ok' as status from $F2 where {_GOOD} union all"
    f" select id, part_key, attr, null, null, 'rejected' from $F2 where not ({_GOOD})"
)
ATTRIBUTES = "id bigint, part_key string, attr double"


def _both(good, bad):
    names = ["id", "part_key", "attr"]
    return good.select(*names, F.col("bbox.xmin").alias("xmin"), F.col("bbox.ymax").alias("ymax"), F.lit("ok").alias("status")).unionByName(
        bad.select(*names, F.lit(None).cast("double").alias("xmin"), F.lit(None).cast("double").alias("ymax"), F.lit("rejected").alias("status"))
    )


@query("s02_read_geojson_features", _GEOJSON)
def s02(spark, sf):
    path = scratch_path(spark, "features")
    _features(spark, sf).select("value").write.text(path)
    return _both(*GJ.read_geojson_features(spark, path, "lines", ATTRIBUTES, C.EPSG))


_BROKEN = "case id % 4 when 0 then 'no JSON' when 1 then 'no JSON' when 2 then 'attribute of another type' else 'no feature' end"


@query(
    "s02_broken_lines",
    f"select case when id % 3 = 0 then null else id end as id, case when id % 3 = 0 then {_BROKEN} when {_GOOD} then 'ok' else 'geometry' end as status from $F2",
)
def s02_broken(spark, sf):
    """Every third line is no feature: cut in half, plain text, a wrong attribute type, another object."""
    text = F.col("value")
    kinds = [
        F.substr(text, F.lit(1), (F.length(text) / 2).cast("int")),
        F.concat(F.lit("garbage "), F.col("id").cast("string")),
        F.regexp_replace(text, '"id":[0-9]+', '"id":"x"'),
        F.regexp_replace(text, '"type":"Feature"', '"type":"Thing"'),
    ]
    broken = F.element_at(F.array(*kinds), (F.col("id") % 4 + 1).cast("int"))
    lines = _features(spark, sf).select(F.when(F.col("id") % 3 == 0, broken).otherwise(text).alias("value"))
    path = scratch_path(spark, "broken")
    lines.write.text(path)
    good, bad = GJ.read_geojson_features(spark, path, "lines", ATTRIBUTES, C.EPSG)
    return good.select("id", F.lit("ok").alias("status")).unionByName(bad.select("id", F.col("why").alias("status")))


@query("s02_read_feature_collections", _GEOJSON)
def s02_collections(spark, sf):
    """Whole collection documents of at most one thousand features each."""
    path = scratch_path(spark, "collections")
    docs = (
        _features(spark, sf)
        .groupBy(F.floor(F.col("id") / 1000).alias("doc"))
        .agg(F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join(F.collect_list("value"), ","), F.lit("]}")).alias("value"))
    )
    # one file per document: the line separator never occurs inside one
    docs.repartition("doc").select("doc", "value").write.partitionBy("doc").text(path)
    return _both(*GJ.read_geojson_features(spark, path, "collection", ATTRIBUTES, C.EPSG))


def _published(spark, sf, name):
    path = scratch_path(spark, name)
    df = OG.drop_null_or_empty_geometry(C.boxes_with_bbox(spark, sf))
    D.write_vector_dataset(df, path, ("part_key",), {"attr": "Precio"}, C.EPSG)
    return path


@query("s03_read_dataset", f"select id, part_key, attr, xmin, ymin from {C.LIVE_BOXES} where part_key = '2-HIGH'")
def s03(spark, sf):
    path = _published(spark, sf, "dataset")
    return D.read_dataset(spark, path, "part_key = '2-HIGH'").select("id", "part_key", "attr", "xmin", "ymin")


@query(
    "s04_read_region",
    f"select id, part_key, attr, 93 as bytes, xmin, ymin, xmax, ymax from {C.LIVE_BOXES} where xmin between 420000 and 460000 and ymin between 4450000 and 4500000",
)
def s04(spark, sf):
    path = scratch_path(spark, "nested")
    C.boxes_with_struct(spark, sf).write.parquet(path)
    region = D.read_region(spark, path, 420000.0, 460000.0, 4450000.0, 4500000.0)
    return region.withColumn("bytes", F.octet_length("geom")).drop("geom")


def _documents(spark, df, key, size, value, name):
    """Bounded JSON documents: ``size`` consecutive keys each, one per file."""
    path = scratch_path(spark, name)
    docs = df.groupBy(F.floor(F.col(key) / size).alias("doc")).agg(value.alias("value"))
    docs.repartition("doc").write.partitionBy("doc").text(path)
    return path


@query(
    "s05_read_manifest",
    "select concat('d', cast(seq as varchar(20))) as id, title, theme, cast(n_rows as bigint) as rows, kind as type from $F4",
)
def s05(spark, sf):
    df = index(spark, sf)
    entry = F.struct("id", "title", "theme", "rows", F.col("kind").alias("type"))
    value = F.to_json(F.map_from_entries(F.collect_list(F.struct("id", entry))))
    path = _documents(spark, df, "seq", 200, value, "manifest")
    good = DOC.read_manifest(spark, path)
    absent = DOC.read_manifest(spark, path + "-absent")
    return good.unionByName(absent).select("id", "title", "theme", "rows", "type")


@query("s06_write_vector_dataset", f"select id, part_key, attr, 93 as bytes, xmin, ymin, xmax, ymax from {C.LIVE_BOXES}")
def s06(spark, sf):
    back = spark.read.parquet(_published(spark, sf, "written"))
    return back.withColumn("bytes", F.octet_length("geom")).drop("geom")


@query(
    "s07_write_tabular_dataset",
    "select l_orderkey, l_partkey, l_linenumber, l_quantity, l_returnflag, cast(l_shipdate as varchar) as l_shipdate from lineitem",
)
def s07(spark, sf):
    path = scratch_path(spark, "tabular")
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate")
    PB.publish_tabular(df.withColumnRenamed("l_partkey", "L_PARTKEY"), path)
    return spark.read.parquet(path)


@query(
    "s08_write_index",
    "select concat('d', cast(seq as varchar(20))) as id, 'region' as collection, 93 as bytes,"
    " case when kind = 'vector' then cast(seq as double) else -4.58 end as xmin, title, kind, '1.1.0' as stac_version, 'Feature' as type,"
    " true as no_date from $F4",
)
def s08(spark, sf):
    df = index(spark, sf)
    s = F.col("seq").cast("double")
    box = F.struct(s.alias("xmin"), (s + 1).alias("ymin"), (s + 2).alias("xmax"), (s + 3).alias("ymax"))
    named = df.select("id", "title", "theme", "rows", "kind", F.when(F.col("kind") == "vector", box).alias("bbox"))
    kinds = [named.filter(F.col("kind") == k).drop("kind") for k in U.KIND_ORDER]
    path = scratch_path(spark, "index")
    out = PB.build_catalog(spark, *kinds, path, "region", BASE, "EPSG:25830", "Provider", "CC-BY-4.0")
    return out.select(
        "id",
        "collection",
        F.octet_length("geometry").alias("bytes"),
        F.col("bbox.xmin").alias("xmin"),
        F.get_json_object("properties", "$.title").alias("title"),
        F.get_json_object("properties", "$.kind").alias("kind"),
        "stac_version",
        "type",
        F.col("datetime").isNull().alias("no_date"),
    )


def _metadata_documents(spark, sf):
    """One table-metadata document per hundred manifest entries, named after its first entry."""
    df = fixture(spark, sf, "F4").withColumn("doc", F.floor(F.col("seq") / 100))
    fields = F.transform(
        F.sort_array(F.collect_list(F.struct("seq", "title"))),
        lambda r: F.struct(r.seq.alias("id"), F.concat(F.lit("c"), r.seq.cast("string")).alias("name"), F.lit("long").alias("type"), r.title.alias("doc")),
    )
    packed = df.groupBy("doc").agg(fields.alias("fields"), F.count(F.lit(1)).alias("n"))
    old = F.struct(F.lit(0).alias("schema-id"), F.slice("fields", 1, 1).alias("fields"))
    new = F.struct(F.lit(1).alias("schema-id"), F.col("fields"))

    def snapshot(n):
        return F.struct(F.create_map(F.lit("total-records"), n.cast("string")).alias("summary"))

    many = F.to_json(
        F.struct(F.lit(1).alias("current-schema-id"), F.array(old, new).alias("schemas"), F.array(snapshot(F.lit(0)), snapshot(F.col("n"))).alias("snapshots"))
    )
    single = F.to_json(F.struct(new.alias("schema")))
    path = scratch_path(spark, "metadata")
    packed.select("doc", F.when(F.col("doc") % 3 == 0, single).otherwise(many).alias("value")).repartition("doc").write.partitionBy("doc").text(path)
    return path


@query("s09_read_table_metadata", "select cast(seq // 100 as bigint) as dataset, seq as id, 'c' || seq as name, 'long' as type, title as doc from $F4")
def s09(spark, sf):
    fields, _ = DOC.read_table_metadata(spark, _metadata_documents(spark, sf))
    number = F.regexp_extract("file", "doc=([0-9]+)/", 1).cast("bigint")
    return fields.select(number.alias("dataset"), F.col("id").cast("bigint").alias("id"), "name", "type", "doc")


@query(
    "s09_snapshot_totals",
    "select cast(seq // 100 as bigint) as dataset, case when (seq // 100) % 3 = 0 then null else cast(count(*) as varchar) end as total_records from $F4 group by seq // 100",
)
def s09_totals(spark, sf):
    _, totals = DOC.read_table_metadata(spark, _metadata_documents(spark, sf))
    return totals.select(F.regexp_extract("file", "doc=([0-9]+)/", 1).cast("bigint").alias("dataset"), "total_records")


@query("s10_read_inventory", "select name, split_part(name, ':', 1) as ws, title, cast(coalesce(n_rows, 0) as bigint) as count from $F4")
def s10(spark, sf):
    df = fixture(spark, sf, "F4")
    record = F.struct("name", F.substring_index("name", ":", 1).alias("ws"), "title", F.coalesce("n_rows", F.lit(0)).alias("count"))
    path = _documents(spark, df, "seq", 200, F.to_json(F.collect_list(record)), "inventory")
    return DOC.read_inventory(spark, path)


# --- whole jobs -----------------------------------------------------------------------------------------------


@query(
    "l01_publish_vector",
    "select part_key, count(*) as rows, min(xmin) as xmin, max(ymax) as ymax, 4 as bounded_columns from"
    f" {C.LIVE_BOXES} group by part_key",
)
def publish_vector(spark, sf):
    """Source to published files, then per-file statistics and bounds from the files."""
    path = scratch_path(spark, "publish")
    source = C.boxes_with_struct(spark, sf).withColumnRenamed("attr", "ATTR").withColumn("OGC_FID", F.col("id"))
    out = PB.publish_vector(source.withColumn("day", F.current_date()), path, C.EPSG, ("part_key",))
    key = F.url_decode(F.url_decode(F.regexp_extract("file", "part_key=([^/]+)/", 1))).alias("part_key")
    bounded = out["columns"].filter("has_bound").groupBy(key).agg(F.countDistinct("column").cast("int").alias("bounded_columns"))
    files = out["files"].groupBy(key).agg(F.sum("rows").alias("rows"), F.min("xmin").alias("xmin"), F.max("ymax").alias("ymax"))
    return files.join(bounded, "part_key")


@query(
    "l02_incremental_ingest",
    f"select id, part_key, attr, x0 as xmin, y0 + h as ymax from $F2 where geom_state = 'polygon' and ({_GOOD})",
)
def incremental(spark, sf):
    """Two deliveries into a landing folder, the second with everything the first had."""
    base = scratch_path(spark, "ingest")
    landing, target = f"{base}/landing", f"{base}/target"
    features = _features(spark, sf)
    features.filter("id % 2 = 0").select("value").write.text(landing)
    IN.ingest_features(spark, landing, target, ATTRIBUTES).awaitTermination()
    features.select("value").write.mode("append").text(landing)
    IN.ingest_features(spark, landing, target, ATTRIBUTES).awaitTermination()
    return spark.read.parquet(f"{target}/data").select("id", "part_key", "attr", "xmin", "ymax")


@query(
    "l02_ingest_without_ids",
    f"select case when id % 2 = 0 then id end as id, part_key, attr, x0 as xmin from $F2 where geom_state = 'polygon' and ({_GOOD})",
)
def incremental_without_ids(spark, sf):
    """Half of the features have no id: none of them is merged away."""
    base = scratch_path(spark, "ingest")
    value = F.when(F.col("id") % 2 == 0, F.col("value")).otherwise(F.regexp_replace("value", '"id":[0-9]+,', ""))
    _features(spark, sf).select(value.alias("value")).write.text(f"{base}/landing")
    IN.ingest_features(spark, f"{base}/landing", f"{base}/target", ATTRIBUTES).awaitTermination()
    return spark.read.parquet(f"{base}/target/data").select("id", "part_key", "attr", "xmin")


@query(
    "l01_publish_attribute_clash",
    "select id, 'b' || id as bbox, id % 7 as xmin_1, x0 as xmin from $F2 where geom_state = 'polygon'",
)
def publish_clash(spark, sf):
    """Attributes called like the box: a text ``bbox`` and a number ``Xmin`` are kept beside the real box."""
    source = C.boxes(spark, sf).select("id", (F.col("id") % 7).alias("Xmin"), F.concat(F.lit("b"), F.col("id").cast("string")).alias("bbox"), "geom")
    path = scratch_path(spark, "clash")
    PB.publish_vector(C.with_srid(source, C.EPSG), path, C.EPSG)
    return spark.read.parquet(path).select("id", "bbox", "xmin_1", "xmin")


@query(
    "l03_catalog_page",
    "select id, kind, greatest(n - 500, 0) as remaining, 'D' || substr(id, 2) as label from"
    " (select concat('d', cast(seq as varchar(20))) as id, kind, count(*) over () as n from $F4 where concat('d', cast(seq as varchar(20))) like '%1%')"
    " order by id limit 500",
)
def catalog_page(spark, sf):
    return EX.catalog_page(index(spark, sf), "all", " 1")


@query(
    "l03_dataset_pages",
    "select id, 'D' || substr(id, 2) as label, case when seq % 4 = 0 then 'table' else kind end as type,"
    " case when seq % 4 = 0 then 'EPSG:4326' else 'EPSG:25830' end as crs,"
    " 'https://storage.googleapis.com/b/v3/' || id || '/data/' || id || '.parquet' as parquet_url,"
    " 'https://storage.googleapis.com/b/v3/' || id || '/metadata/v1.metadata.json' as metadata_url,"
    " 's3://b/v3/' || id || '/data/' || id || '.parquet' as s3_uri, id as table_name"
    " from (select concat('d', cast(seq as varchar(20))) as id, * from $F4)",
)
def dataset_pages(spark, sf):
    df = index(spark, sf)
    known = df.filter("seq % 4 <> 0").select(
        "id", F.col("kind").alias("type"), F.lit(25830).alias("crs"), F.lit(None).cast("string").alias("parquet"), F.lit(None).cast("string").alias("meta")
    )
    return EX.dataset_pages(df.select("id"), known, "https://storage.googleapis.com/b")


@query(
    "l04_publish_text_tables",
    "select event_type as dataset, count(*) as rows, 'OK(' || count(*) || ')' as status from events group by event_type union all"
    " select 'orders_' || lower(o_orderstatus), count(*), 'OK(' || count(*) || ')' from orders group by o_orderstatus",
)
def publish_text(spark, sf):
    """Two families of files in two dialects, a folder per dataset, published with one job each."""
    base = scratch_path(spark, "texts")
    events = table(spark, sf, "events").select("event_type", "event_id", "user_id", F.col("props").alias("Detalle"))
    events.write.partitionBy("event_type").option("header", True).option("sep", ";").option("escape", '"').csv(f"{base}/in/events")
    orders = table(spark, sf, "orders").select("o_orderstatus", "o_orderkey", F.col("o_orderpriority").alias("Prioridad"))
    orders.write.partitionBy("o_orderstatus").option("header", True).option("sep", ",").csv(f"{base}/in/orders")
    family = F.when(F.col("_file").contains("/orders/"), "orders_").otherwise("")
    dataset = TX.slug(F.concat(family, F.regexp_extract("_file", "=([^/]+)/", 1)), "package")
    return PB.publish_text_tables(spark, [f"{base}/in/events", f"{base}/in/orders"], f"{base}/out", dataset)
