"""Whole runs over many layers, the documents of a catalog, acceptance of what was published, regions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import common as C
from checks.q_catalog import BASE, index
from checks.q_geometry import CORNER_BOX, _feature_text
from checks.registry import fixture, query, table
from geoloom.functions import text as TX
from geoloom.operators import attributes as A
from geoloom.operators import documents as DOCS
from geoloom.operators import geometry as OG
from geoloom.operators import quality as Q
from geoloom.plans import acceptance as AC
from geoloom.plans import catalog_run as CR
from geoloom.plans import layers as LY
from geoloom.plans import packages as PK
from geoloom.plans import rasters as RS
from geoloom.plans import region as RG
from geoloom.session import scratch_path
from geoloom.sources import datasets as D
from geoloom.sources import documents as DOC

REPO = "https://git.example.org/publisher/catalog"
EXTENSION = "https://ext.example.org/v1/schema.json"

# --- many layers ------------------------------------------------------------------------------------------


def _deliveries(spark, sf):
    """(layer, id, value): the box fixture as features of five layers that differ in their attributes."""
    f = fixture(spark, sf, "F2")
    whole = F.col("id").cast("string")
    kinds = {
        "1-URGENT": F.to_json(F.struct("id", "attr")),
        "2-HIGH": F.to_json(F.struct("id", F.concat(F.lit("n"), whole).alias("Name"), F.lit("x").alias("geom"), F.lit(None).cast("string").alias("note")), {"ignoreNullFields": "false"}),
        "3-MEDIUM": F.when(F.col("id") % 2 == 0, F.to_json(F.struct(F.col("id").alias("code")))).otherwise(F.to_json(F.struct(F.concat(F.lit("c"), whole).alias("code")))),
        "4-NOT SPECIFIED": F.lit("{}"),
        "5-LOW": F.to_json(
            F.struct((F.col("id") % 3 == 0).alias("flag"), F.when(F.col("id") % 4 != 0, F.col("w") / 8).alias("size"), F.struct(F.array(F.col("id")).alias("a")).alias("deep"))
        ),
    }
    properties = reduce(lambda c, k: c.when(F.col("part_key") == k, kinds[k]), kinds, F.when(F.lit(False), F.lit(""))).otherwise("null")
    geometry = F.coalesce(_feature_text(f), F.lit("null"))
    value = F.concat(F.lit('{"type":"Feature","geometry":'), geometry, F.lit(',"properties":'), properties, F.lit("}"))
    return f.select(F.concat(F.lit("ws1:"), "part_key").alias("layer"), "id", "geom_state", value.alias("value"))


_READABLE = "geom_state = 'polygon' and id % 29 <> 0 and id % 31 <> 0"


def _inventory(deliveries):
    """What the publisher says there is: three more features than there are in one layer."""
    live = F.count_if(F.expr(_READABLE)) + F.when(F.first("layer") == "ws1:3-MEDIUM", 3).otherwise(0)
    rows = deliveries.groupBy(F.col("layer").alias("name")).agg(live.alias("count"))
    return rows.select("name", F.lit("ws1").alias("ws"), F.upper("name").alias("title"), "count")


_LAYER_ID = "trim(regexp_replace(lower(part_key), '[^a-z0-9]+', '_', 'g'), '_')"


def _layer_rows(status, extra=""):
    return (
        f"select {_LAYER_ID} as id, 'ws1:' || part_key as typename, cast(count(*) as bigint) as rows,"
        f" cast(count(*) + case when part_key = '3-MEDIUM' then 3 else 0 end as bigint) as want, {status} as status{extra}"
        f" from $F2 where {_READABLE} group by part_key"
    )


_STATUS = "case when part_key = '3-MEDIUM' then 'OK-partial(' || count(*) || '/' || (count(*) + 3) || ')' else 'OK' end"


@query("l05_publish_layers", _layer_rows(_STATUS))
def publish_layers(spark, sf):
    """Five layers of five sets of attributes in one run."""
    lines = _deliveries(spark, sf)
    results, _ = LY.publish_layers(spark, lines.select("layer", "value"), _inventory(lines), scratch_path(spark, "layers"), C.EPSG, 1)
    return results.select("id", "typename", "rows", "want", "status")


@query(
    "l05_layers_resumed",
    _layer_rows(f"case when part_key in ('1-URGENT', '4-NOT SPECIFIED') then 'skip' else {_STATUS} end", ", cast(2 as bigint) as run"),
)
def layers_resumed(spark, sf):
    """Two layers come whole with the first delivery, the others half; the second delivery has everything."""
    path, lines = scratch_path(spark, "layers"), _deliveries(spark, sf)
    named = _inventory(lines)
    early = lines.filter("layer in ('ws1:1-URGENT', 'ws1:4-NOT SPECIFIED') or id % 2 = 0")
    LY.publish_layers(spark, early.select("layer", "value"), named, path, C.EPSG, 1)
    LY.publish_layers(spark, lines.select("layer", "value"), named, path, C.EPSG, 2)
    return LY.read_ledger(spark, path).select("id", "typename", "rows", "want", "status", "run")


@query(
    "l05_layer_attributes",
    "select '2_high' as dataset, id, 'n' || id as text, cast(null as double) as size, cast(null as boolean) as flag, x0 as xmin"
    f" from $F2 where part_key = '2-HIGH' and {_READABLE} union all"
    " select '3_medium', null, case when id % 2 = 0 then cast(id as varchar) else 'c' || id end, null, null, x0"
    f" from $F2 where part_key = '3-MEDIUM' and {_READABLE} union all"
    " select '5_low', null, '{\"a\":[' || id || ']}', case when id % 4 <> 0 then w / 8 end, id % 3 = 0, x0"
    f" from $F2 where part_key = '5-LOW' and {_READABLE}",
)
def layer_attributes(spark, sf):
    """Typed attributes of three of the layers, read back from their folders."""
    path, lines = scratch_path(spark, "layers"), _deliveries(spark, sf)
    LY.publish_layers(spark, lines.select("layer", "value"), _inventory(lines), path, C.EPSG, 1)
    none = {"id": F.lit(None).cast("bigint"), "text": F.lit(None).cast("string"), "size": F.lit(None).cast("double"), "flag": F.lit(None).cast("boolean")}
    parts = []
    for dataset, own in (("2_high", {"id": "id", "text": "name"}), ("3_medium", {"text": "code"}), ("5_low", {"text": "deep", "size": "size", "flag": "flag"})):
        df = LY.read_layer(spark, path, dataset)
        parts.append(df.select(F.lit(dataset).alias("dataset"), *[(F.col(own[n]) if n in own else v).alias(n) for n, v in none.items()], "xmin"))
    return reduce(DataFrame.unionByName, parts)


@query(
    "l05_rejected_lines",
    f"select {_LAYER_ID} as dataset, case when id % 7 = 3 then 'no JSON' else 'geometry' end as why, count(*) as n"
    " from $F2 where id % 7 = 3 or (geom_state not in ('null', 'empty') and (id % 29 = 0 or id % 31 = 0)) group by all",
)
def rejected_lines(spark, sf):
    """A seventh of the lines is cut in half; what cannot be read is told with its layer, line by line."""
    lines = _deliveries(spark, sf)
    cut = F.when(F.col("id") % 7 == 3, F.substr("value", F.lit(1), (F.length("value") / 2).cast("int"))).otherwise(F.col("value"))
    _, rejects = LY.read_layer_features(lines.select("layer", cut.alias("value")), LY.named_layers(_inventory(lines)))
    return rejects.groupBy("dataset", "why").agg(F.count(F.lit(1)).alias("n"))


_F2_KEYS = "from $F2 where part_key ="


@query(
    "p18_attribute_types",
    "select * from (select '1-URGENT' as dataset, 'id' as attribute, 0 as position, 'long' as type, count(*) as given"
    f" {_F2_KEYS} '1-URGENT' union all select '1-URGENT', 'attr', 1, 'double', count(attr) {_F2_KEYS} '1-URGENT' union all"
    f" select '2-HIGH', 'id', 0, 'long', count(*) {_F2_KEYS} '2-HIGH' union all select '2-HIGH', 'Name', 1, 'string', count(*) {_F2_KEYS} '2-HIGH' union all"
    f" select '2-HIGH', 'geom', 2, 'string', count(*) {_F2_KEYS} '2-HIGH' union all select '2-HIGH', 'note', 3, 'string', count(case when false then 1 end) {_F2_KEYS} '2-HIGH' union all"
    f" select '3-MEDIUM', 'code', 0, 'string', count(*) {_F2_KEYS} '3-MEDIUM' union all"
    f" select '5-LOW', 'flag', 0, 'boolean', count(*) {_F2_KEYS} '5-LOW' union all select '5-LOW', 'size', 1, 'double', count_if(id % 4 <> 0) {_F2_KEYS} '5-LOW' union all"
    f" select '5-LOW', 'deep', min(case when id % 4 <> 0 then 2 else 1 end), 'string', count(*) {_F2_KEYS} '5-LOW') where position is not null",
)
def attribute_types(spark, sf):
    lines = _deliveries(spark, sf)
    properties = F.from_json("value", "properties string").properties
    return A.attribute_types(lines.select(F.substring("layer", 5, 99).alias("dataset"), properties.alias("properties")))


# --- documents --------------------------------------------------------------------------------------------


def _tables(spark, sf):
    """Published tables of the manifest fixture with their columns and files: two or three columns, one or two files."""
    df = index(spark, sf).filter("kind <> 'raster'")
    space = F.when(F.col("kind") == "vector", "v3").otherwise("tab")
    properties = F.to_json(F.struct("title", "theme"))
    tables = df.select(
        space.alias("namespace"), F.col("id").alias("name"), F.concat(space, F.lit("/"), "id").alias("key"),
        F.concat(F.lit(f"{BASE}/data/"), space, F.lit("/"), "id").alias("location"), F.when(F.col("kind") == "vector", 3).otherwise(2).alias("format_version"),
        properties.alias("properties"), "rows", "seq", "title",
    )
    geom = F.when(F.col("namespace") == "v3", F.array(F.struct(F.lit(3).alias("id"), F.lit("geom").alias("name"), F.lit("geometry(srid:25830)").alias("type"), F.lit(None).cast("string").alias("doc"))))
    named = F.array(
        F.struct(F.lit(1).alias("id"), F.lit("code").alias("name"), F.lit("long").alias("type"), F.col("title").alias("doc")),
        F.struct(F.lit(2).alias("id"), F.lit("label").alias("name"), F.lit("string").alias("type"), F.lit(None).cast("string").alias("doc")),
    )
    columns = tables.select("key", F.inline(F.concat(named, F.coalesce(geom, F.array().cast("array<struct<id:int,name:string,type:string,doc:string>>")))))
    files = tables.filter("seq % 6 <> 1").select("key", "rows", F.explode(F.sequence(F.lit(1), (F.col("seq") % 2 + 1).cast("int"))).alias("n"))
    files = files.select("key", F.concat("key", F.lit("/data/"), F.col("n").cast("string"), F.lit(".parquet")).alias("file"), (F.col("n") * 100).cast("bigint").alias("bytes"), "rows")
    return tables, columns, files


_TABLES = (
    "(select *, case kind when 'vector' then 'v3' else 'tab' end as ns, concat('d', cast(seq as varchar(20))) as id from $F4 where kind <> 'raster')"
)


@query(
    "l06_table_documents",
    "select ns || '/' || t.id as key, case ns when 'v3' then 3 else 2 end as version, c.id, c.name, c.type, case c.id when 1 then title else c.name end as doc,"
    " title, theme, case when seq % 6 = 1 then null else cast(cast(n_rows as bigint) * (seq % 2 + 1) as varchar) end as total_records,"
    " case when seq % 6 = 1 then null else cast(case seq % 2 when 0 then 100 else 300 end as varchar) end as total_bytes,"
    " case ns when 'v3' then 3 else 2 end as last_column"
    f" from {_TABLES} t join (values (1, 'code', 'long'), (2, 'label', 'string'), (3, 'geom', 'geometry(srid:25830)')) c(id, name, type) on c.id < 3 or ns = 'v3'",
)
def table_documents(spark, sf):
    """Documents read back with the reader of table metadata."""
    docs = DOCS.table_documents(*_tables(spark, sf)).select(F.col("key").alias("file"), F.col("body").alias("value"))
    fields, totals = DOC.parse_table_metadata(docs)
    at = lambda path: F.get_json_object("value", path)
    raw = docs.select(
        "file",
        at("$.format-version").cast("int").alias("version"),
        at("$.properties.title").alias("title"),
        at("$.properties.theme").alias("theme"),
        at("$.snapshots[0].summary.total-files-size").alias("total_bytes"),
        at("$.last-column-id").cast("int").alias("last_column"),
    )
    both = fields.join(totals, "file").join(raw, "file")
    return both.select(F.col("file").alias("key"), "version", "id", "name", "type", "doc", "title", "theme", "total_records", "total_bytes", "last_column")


_PAGE = 50


@query(
    "l06_surface_documents",
    f"with t as (select ns, id, row_number() over (partition by ns order by id) - 1 as p from {_TABLES}),"
    f" pages as (select ns, p // {_PAGE} as page, count(*) as n, min(id) as first_name, max(p // {_PAGE}) over (partition by ns) as last from t group by ns, p // {_PAGE})"
    " select 'v1/config' as key, '{\"prefix\":\"sdi\"}' as what, cast(null as varchar) as next, cast(null as bigint) as n union all"
    " select 'v1/sdi/namespaces', '[' || string_agg('[\"' || ns || '\"]', ',' order by ns) || ']', null, null from (select distinct ns from t) union all"
    " select distinct 'v1/sdi/namespaces/' || ns, '[\"' || ns || '\"]', null, null from t union all"
    " select 'v1/sdi/namespaces/' || ns || '/tables' || case page when 0 then '' else '.page-' || page end, first_name,"
    " case when page < last then 'page-' || (page + 1) end, n from pages union all"
    f" select 'v1/sdi/namespaces/' || ns || '/tables/' || id, '{BASE}/data/' || ns || '/' || id || '/metadata/v1.metadata.json', null,"
    " case ns when 'v3' then 3 else 2 end from t",
)
def surface_documents(spark, sf):
    """Every page a client asks for; of a table, where its document is and how many columns the one inside has."""
    tables, columns, files = _tables(spark, sf)
    bodies = DOCS.table_documents(tables, columns, files)
    pages = DOCS.surface_documents(tables.select("namespace", "name", "key").join(bodies, "key"), BASE, "sdi", _PAGE)
    at = lambda path: F.get_json_object("body", path)
    what = F.coalesce(at("$.overrides"), at("$.namespaces"), at("$.namespace"), at("$.metadata-location"), at("$.identifiers[0].name"))
    count = F.json_array_length(F.coalesce(at("$.identifiers"), at("$.metadata.schemas[0].fields"))).cast("bigint")
    return pages.select("key", what.alias("what"), at("$.next-page-token").alias("next"), count.alias("n"))


_KIND = "case when kind = 'raster' then case when seq % 20 = 0 then 'remote' else 'raster' end when kind = 'tabular' then 'non-geo' else kind end"


@query(
    "l09_collection_documents",
    "select id || '/collection.json' as key, title, 'Collection' as type, case when k in ('vector', 'non-geo') then ns || '.' || id end as table_id,"
    " case k when 'non-geo' then 'false' end as geospatial, case k when 'remote' then 'false' end as managed,"
    f" case when k in ('vector', 'non-geo') then '{BASE}/' || id || '/' || id || '.parquet' else 'https://x.example.org/' || id end as data_href,"
    f" case when k in ('vector', 'non-geo') then '{BASE}/data/' || ns || '/' || id end as table_href, cast(case seq % 3 when 0 then 2 else 3 end as bigint) as links,"
    f" '{REPO}/edit/main/' || id || '/collection.json' as edit_url, cast(seq as double) as xmin from"
    f" (select *, {_KIND} as k, case kind when 'vector' then 'v3' else 'tab' end as ns, concat('d', cast(seq as varchar(20))) as id from $F4)",
)
def collection_documents(spark, sf):
    df = index(spark, sf).withColumn("kind", F.expr(_KIND))
    s = F.col("seq").cast("double")
    named = df.select(
        "id", "title", F.lit(None).cast("string").alias("description"), F.lit(None).cast("string").alias("license"), "kind",
        F.struct(s.alias("xmin"), s.alias("ymin"), (s + 1).alias("xmax"), (s + 1).alias("ymax")).alias("bbox"), F.col("id").alias("table"), F.col("seq").alias("snapshot"),
        F.concat(F.lit("https://x.example.org/"), "id").alias("href"), F.when(F.col("seq") % 3 != 0, F.lit("https://src.example.org/")).alias("source"),
    )
    docs = DOCS.collection_documents(named, BASE, REPO, EXTENSION, "own:")
    at = lambda path: F.get_json_object("body", path)
    return docs.select(
        "key", at("$.title").alias("title"), at("$.type").alias("type"), at("$['iceberg:table_id']").alias("table_id"), at("$['own:geospatial']").alias("geospatial"),
        at("$.assets.data['own:managed']").alias("managed"), at("$.assets.data.href").alias("data_href"), at("$.assets.iceberg.href").alias("table_href"),
        F.json_array_length(at("$.links")).cast("bigint").alias("links"), at("$['git:edit_url']").alias("edit_url"), at("$.extent.spatial.bbox[0][0]").cast("double").alias("xmin"),
    )


@query(
    "l09_catalog_documents",
    f"with t as (select id, title, row_number() over (order by id) - 1 as p from (select concat('d', cast(seq as varchar(20))) as id, title from $F4))"
    f" select 'catalog.json' as key, max(p) // {_PAGE} + 1 + 3 as links, '{BASE}/catalog-0.json' as first_href, '{REPO}' as repository from t union all"
    f" select 'catalog-' || (p // {_PAGE}) || '.json', count(*), '{BASE}/' || min(id) || '/collection.json', null from t group by p // {_PAGE}",
)
def catalog_documents(spark, sf):
    docs = DOCS.catalog_documents(index(spark, sf), "Catalog", "All datasets", BASE, REPO, EXTENSION, _PAGE)
    at = lambda path: F.get_json_object("body", path)
    return docs.select("key", F.json_array_length(at("$.links")).cast("bigint").alias("links"), at("$.links[0].href").alias("first_href"), at("$['git:repository']").alias("repository"))


# --- acceptance -------------------------------------------------------------------------------------------

_X0, _Y0, _X1, _Y1 = CORNER_BOX
_CORNER = f"xmin between {_X0} and {_X1} and ymin between {_Y0} and {_Y1}"
_MEETS = f"xmin <= {_X1} and xmax >= {_X0} and ymin <= {_Y1} and ymax >= {_Y0}"


def _published(spark, sf, partition_by):
    path = scratch_path(spark, "accepted")
    df = OG.drop_null_or_empty_geometry(C.boxes_with_bbox(spark, sf))
    D.write_vector_dataset(df, path, partition_by, {"attr": "Precio"}, C.EPSG)
    return path


@query(
    "l07_accept",
    f"select 'rows' as \"check\", count(*) as value, true as ok from {C.LIVE_BOXES} union all select 'null_geometries', 0, true union all select 'unbounded_rows', 0, true union all"
    f" select 'in_box', count(*), true from {C.LIVE_BOXES} where {_CORNER} union all select 'intersecting', count(*), true from {C.LIVE_BOXES} where {_MEETS} union all"
    f" select 'srid', {C.EPSG}, true union all select 'files', null, true union all select 'files_in_box', null, true",
)
def accept(spark, sf):
    """How many files there are is the writer's choice; that the box rules out some, if there are several, is not."""
    ring = [(_X0, _Y0), (_X1, _Y0), (_X1, _Y1), (_X0, _Y1)]
    told = AC.accept(spark, _published(spark, sf, ()), C.EPSG, CORNER_BOX, [[ring]])
    return told.withColumn("value", F.when(~F.col("check").startswith("files"), F.col("value")))


@query(
    "l07_audit_published",
    "select 'boxes' as dataset, rule, true as ok from (values ('geometry_with_srid'), ('geometry_id_before_bbox'), ('ids_contiguous'), ('bbox_in_file_hidden'),"
    " ('stats_complete'), ('names_lower_case'), ('described'), ('names_unique')) r(rule) where (select count(*) from orders) > 0",
)
def audit_published(spark, sf):
    """The layout rules hold for a dataset as it lies in its files."""
    return AC.audit_published(spark, _published(spark, sf, ("part_key",)), C.EPSG, "boxes", ("part_key",))


@query(
    "l07_diagnose",
    "select 'd' || s_suppkey as dataset, rule from supplier, (values ('names_lower_case', 0), ('described', 1), ('stats_complete', 2)) r(rule, k) where s_suppkey % 4 = k",
)
def diagnose(spark, sf):
    """One rule is broken in three datasets of four."""
    f = spark.read.parquet(f"{sf}/supplier.parquet").select(F.concat(F.lit("d"), F.col("s_suppkey").cast("string")).alias("dataset"), (F.col("s_suppkey") % 4).alias("k"))
    first = F.struct(
        F.when(F.col("k") == 0, "Code").otherwise("code").alias("column"), F.lit("long").alias("type"), F.lit(1).alias("field_id"), F.lit(True).alias("in_schema"),
        (F.col("k") != 2).alias("has_stats"), F.when(F.col("k") != 1, "what it is").alias("doc"),
    )
    rest = [("geom", "geometry(srid:25830)", 2, True), ("xmin", "double", 3, False), ("ymin", "double", 4, False), ("xmax", "double", 5, False), ("ymax", "double", 6, False)]
    others = [
        F.struct(F.lit(n).alias("column"), F.lit(t).alias("type"), F.lit(i).alias("field_id"), F.lit(s).alias("in_schema"), F.lit(True).alias("has_stats"), F.lit(n).alias("doc"))
        for n, t, i, s in rest
    ]
    told = AC.diagnose(Q.audit_layout(f.select("dataset", F.inline(F.array(first, *others)))))
    return told.filter("symptom is not null and cause is not null and remedy is not null").select("dataset", "rule")


# --- regions ----------------------------------------------------------------------------------------------


@query(
    "l08_publish_region",
    f"select id, part_key, attr as xmin_1, 93 as bytes, '[' || id || ', 7]' as tags, xmin, ymax from {C.LIVE_BOXES} where {_CORNER}",
)
def publish_region(spark, sf):
    """A source with a nested box, a list and an attribute called like a box column; some rows without a geometry."""
    source, path = scratch_path(spark, "source"), scratch_path(spark, "region")
    df = C.boxes_with_struct(spark, sf).withColumnRenamed("attr", "XMIN").withColumn("Tags", F.array("id", F.lit(7).cast("bigint")))
    df.write.partitionBy("part_key").parquet(source)
    out = RG.publish_region(spark, source, path, CORNER_BOX, C.EPSG)
    assert set(out) == {"files", "columns"}
    found = spark.read.parquet(path)
    return found.select("id", "part_key", "xmin_1", F.octet_length("geom").alias("bytes"), "tags", "xmin", "ymax")


# --- grids and the whole catalog --------------------------------------------------------------------------

_GRID = (
    "(select case when col < 16 and cell_row < 16 then 'Riesgo__small' when col < 48 and cell_row < 40 then 'middle' else 'Riesgo__Wide Grid' end"
    " as layer, col, cell_row, value from $F7)"
)


def _grids(spark, sf):
    cells = fixture(spark, sf, "F7").select("col", F.col("cell_row").alias("row"), "value")
    small, middle = (F.col("col") < 16) & (F.col("row") < 16), (F.col("col") < 48) & (F.col("row") < 40)
    named = cells.withColumn("layer", F.when(small, "Riesgo__small").when(middle, "middle").otherwise("Riesgo__Wide Grid"))
    rows = [("Riesgo__small", "Small"), ("middle", None), ("Riesgo__Wide Grid", "Wide"), ("Other__absent", "Absent")]
    place = [F.lit(v).alias(n) for n, v in (("origin_x", 440000.0), ("origin_y", 4480000.0), ("pixel_x", 5.0), ("pixel_y", -5.0))]
    return named, spark.createDataFrame(rows, "id string, title string").select("*", *place)


@query(
    "l10_publish_rasters",
    f"with recursive d as (select layer, greatest(ceil(log2(greatest(max(col) + 1, max(cell_row) + 1) / 16.0)), 0) as depth from {_GRID} group by layer),"
    f" p(layer, level, col, cell_row) as (select layer, 0, col, cell_row from {_GRID} union all"
    " select p.layer, level + 1, col // 2, cell_row // 2 from p join d using (layer) where col % 2 = 0 and cell_row % 2 = 0 and level < depth),"
    " t as (select layer, count(distinct (level, cast(col // 16 as bigint), cast(cell_row // 16 as bigint))) as tiles, max(level) + 1 as levels from p group by layer)"
    " select case layer when 'Riesgo__small' then 'riesgo_small' when 'middle' then 'middle' else 'riesgo_wide_grid' end as id, layer as coverage,"
    " case layer when 'middle' then 'raster' else 'Riesgo' end as theme, tiles, cast(levels as int) as levels,"
    " case layer when 'middle' then 'skip' else 'OK' end as status, cast(true as boolean) as plausible from t union all"
    " select 'other_absent', 'Other__absent', 'Other', null, null, 'FAIL', null from (select 1 from t limit 1)",
)
def publish_rasters(spark, sf):
    """Two deliveries: one grid comes with the first, two with the second, one never."""
    path = scratch_path(spark, "grids")
    cells, inventory = _grids(spark, sf)
    RS.publish_rasters(spark, cells.filter("layer = 'middle'"), inventory, path, C.EPSG, 1, 16)
    out = RS.publish_rasters(spark, cells, inventory, path, C.EPSG, 2, 16)
    west, south, east, north = (F.get("wgs", k) for k in range(4))
    plausible = (west < east) & (south < north) & west.between(-4, -3) & north.between(40, 41)
    return out.select("id", "coverage", "theme", "tiles", "levels", "status", plausible.alias("plausible"))


@query(
    "l10_raster_tiles",
    "select 'middle' as dataset, 0 as level, tx, ty, i as at, value from (select distinct cast(col // 16 as bigint) tx, cast(cell_row // 16 as bigint) ty, cast(k.n as int) as i"
    " from $F7, range(256) k(n) where col < 48 and cell_row < 40 and not (col < 16 and cell_row < 16)) t"
    " left join (select * from $F7 where col < 48 and cell_row < 40 and not (col < 16 and cell_row < 16)) f on f.col = t.tx * 16 + t.i % 16 and f.cell_row = t.ty * 16 + t.i // 16",
)
def raster_tiles(spark, sf):
    """The base tiles of one grid, read back from its folder."""
    path = scratch_path(spark, "grids")
    RS.publish_rasters(spark, *_grids(spark, sf), path, C.EPSG, 1, 16)
    tiles = spark.read.parquet(f"{path}/data").filter("dataset = 'middle' and level = 0")
    return tiles.select("dataset", "level", "tx", "ty", F.posexplode("cells").alias("at", "value"))


_ENTRIES = (
    "(select *, case when kind = 'tabular' and seq % 9 = 1 then concat('d', cast(seq + 2 as varchar(20))) else concat('d', cast(seq as varchar(20))) end as id,"
    " seq % 6 <> 1 as there from $F4)"
)
_OUT = (
    f"(select case when e.kind = 'tabular' and s.id is not null then e.id || '__tab' else e.id end as id, kind from {_ENTRIES} e"
    f" left join (select distinct id from {_ENTRIES} where kind <> 'tabular') s using (id) where there)"
)


def _manifests(spark, sf):
    """Entries of the three kinds; some tabular ids are those of a spatial dataset, a sixth has no files."""
    df = index(spark, sf)
    clash = (F.col("kind") == "tabular") & (F.col("seq") % 9 == 1)
    s = F.col("seq").cast("double")
    named = df.withColumn("id", F.when(clash, F.concat(F.lit("d"), (F.col("seq") + 2).cast("string"))).otherwise(F.col("id")))
    named = named.withColumn("wgs", F.when(F.col("kind") != "tabular", F.array(s, s, s + 1, s + 1))).withColumn("bbox", CR.entry_box())
    named = named.withColumn("src", F.concat("kind", F.lit("/"), F.col("seq").cast("string")))
    there = named.filter("seq % 6 <> 1")
    files = there.select("src", F.concat("src", F.lit("/part-0.parquet")).alias("file"), F.lit(100).cast("bigint").alias("bytes"), "rows")
    columns = there.filter("kind <> 'raster'").select("src", F.lit(1).alias("id"), F.lit("code").alias("name"), F.lit("long").alias("type"), F.lit(None).cast("string").alias("doc"))
    kinds = [named.filter(F.col("kind") == k).select("id", "title", "theme", "rows", "bbox", "src") for k in ("vector", "tabular", "raster")]
    return kinds, files, columns


@query(
    "l11_publish_catalog",
    f"with o as {_OUT}, t as (select case kind when 'vector' then 'v3' else 'tab' end as ns, * from o where kind <> 'raster'),"
    " pages as (select sum(ceil(n / 400.0)) as n from (select ns, count(*) as n from t group by ns))"
    " select kind as part, count(*) as n from o group by kind union all select 'index', count(*) from o union all select 'tables', count(*) from t union all"
    " select 'documents', cast(1 + 1 + (select count(distinct ns) from t) + (select n from pages) + count(*) as bigint) from t",
)
def publish_catalog(spark, sf):
    (vector, tabular, raster), files, columns = _manifests(spark, sf)
    return CR.publish_catalog(
        spark, vector, tabular, raster, files, columns, scratch_path(spark, "catalog"),
        collection="region", base=BASE, crs="EPSG:25830", provider="Provider", license="CC-BY-4.0", prefix="sdi", page_size=400,
    )


# --- packages ---------------------------------------------------------------------------------------------

_PACKAGE = "'prices_' || trim(regexp_replace(lower(p_brand), '[^a-z0-9]+', '_', 'g'), '_')"


def _packages(spark, sf):
    """A package for each brand of the parts: those of a brand that ends in 1 have no address, those in 2 no file."""
    parts = table(spark, sf, "part")
    last = F.substring("p_brand", -1, 1)
    url = F.when(last != "1", F.concat(F.lit("https://x.example.org/"), "p_brand"))
    resources = F.array(F.struct(F.lit("PDF").alias("format"), F.lit("https://x.example.org/a.pdf").alias("url")), F.struct(F.lit("CSV").alias("format"), url.alias("url")))
    brands = parts.select("p_brand").distinct()
    named = brands.select(
        F.concat(F.lit("Prices: "), "p_brand").alias("name"), F.col("p_brand").alias("title"), F.lit(None).cast("string").alias("license"),
        F.when(last == "3", F.array().cast("array<string>")).otherwise(F.array(F.lit("economy"))).alias("groups"), resources.alias("resources"),
    )
    rows = parts.select("p_brand", "p_partkey", F.col("p_type").alias("Tipo"), F.col("p_size").alias("TAMAÑO"))
    ident = F.concat(F.lit("prices_"), TX.slug(F.col("p_brand"), "coverage"))
    return named, rows.withColumn("package", ident).drop("p_brand")


def _deliver(rows, landing):
    rows.write.mode("append").partitionBy("package").option("header", True).option("sep", ";").option("encoding", "ISO-8859-1").csv(landing)


@query(
    "l12_publish_packages",
    f"select {_PACKAGE} as id, p_brand as title, case when p_brand like '%3' then 'OpenData' else 'economy' end as theme,"
    " case when p_brand like '%1' or p_brand like '%2' then null else count(*) end as rows, 'cc-by' as license,"
    " case when p_brand like '%1' then 'no-csv' when p_brand like '%2' then 'FAIL-download' when p_brand like '%4' then 'skip' else 'OK(' || count(*) || ')' end as status"
    " from part group by p_brand",
)
def publish_packages(spark, sf):
    """Two deliveries; the first brings the packages of a brand that ends in 4, which the second run skips."""
    base = scratch_path(spark, "packages")
    named, rows = _packages(spark, sf)
    of = F.regexp_extract("_file", "package=([^/]+)/", 1)
    _deliver(rows.filter("package like '%4'"), f"{base}/landing")
    PK.publish_packages(spark, named, f"{base}/landing", f"{base}/out", 1, dataset=of)
    _deliver(rows.filter("package not like '%4' and package not like '%2'"), f"{base}/landing")
    out = PK.publish_packages(spark, named, f"{base}/landing", f"{base}/out", 2, dataset=of)
    return out.select("id", "title", "theme", "rows", "license", "status")
