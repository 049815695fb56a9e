"""Index, manifests, packages, inventories, ledgers, set operations and quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import common as C
from checks.registry import fixture, query, table
from geoloom.functions import text as TX
from geoloom.operators import catalog as K
from geoloom.operators import geometry as OG
from geoloom.operators import joins as J
from geoloom.operators import layout as L
from geoloom.operators import quality as Q
from geoloom.operators import setops as U
from geoloom.operators import windows as W

BASE = "https://data.example.org/cat"
_ID = "concat('d', cast(seq as varchar(20)))"


def index(spark, sf):
    """Manifest fixture with one id per entry."""
    f = fixture(spark, sf, "F4")
    return f.withColumn("id", F.expr(_ID)).withColumn("rows", F.col("n_rows").cast("bigint"))


def packages(spark, sf):
    """Resource fixture as packages: three resources each, the second possibly without url."""
    f = fixture(spark, sf, "F5")
    res = F.array(
        F.struct(F.lit("PDF").alias("format"), F.lit("https://x.example.org/readme.pdf").alias("url")),
        F.struct(F.col("format"), F.col("url")),
        F.struct(F.col("format"), F.concat(F.lit("https://y.example.org/"), F.col("pkg_id").cast("string")).alias("url")),
    )
    groups = F.when(F.col("pkg_id") % 4 == 0, F.array().cast("array<string>")).otherwise(F.array("grp"))
    return f.select(F.col("pkg_id").alias("id"), "publisher", groups.alias("groups"), res.alias("resources"))


# --- search, selection, lists ---------------------------------------------------------------------------


@query("f05_search_catalog", f"select {_ID} as id, kind from $F4 where kind = 'tabular' and {_ID} like '%d1%'")
def f05(spark, sf):
    return K.search_catalog(index(spark, sf), "table", "  D1 ").select("id", "kind")


@query("f06_select_packages", "select pkg_id as id from $F5 where format = 'SHP'")
def f06(spark, sf):
    return K.select_packages(packages(spark, sf), "SHP").select("id")


@query(
    "f07_first_resource",
    "select pkg_id as id, case when format <> 'CSV' then null when url is null"
    " then 'https://y.example.org/' || pkg_id else url end as url from $F5",
)
def f07(spark, sf):
    return K.first_resource(packages(spark, sf), "CSV").select("id", "url")


@query("f08_size_tier", "select layer_id, n_features from $F9 where n_features between 1000 and 100000")
def f08(spark, sf):
    return K.size_tier(fixture(spark, sf, "F9"), 1000, 100000, "n_features").select("layer_id", "n_features")


@query(
    "f09_exclude_sources",
    "select page_id from pages where lower(split_part(split_part(split_part(split_part(url, '://', 2), '/', 1), '?', 1), ':', 1))"
    " not in ('m.ththth.example.net', 'ththre.example.com')",
)
def f09(spark, sf):
    hosts = ["m.ththth.example.net", "ththre.example.com"]
    return K.exclude_sources(table(spark, sf, "pages"), hosts).select("page_id")


@query(
    "o03_capped_list",
    f"select {_ID} as id, greatest((select count(*) from $F4) - 500, 0) as remaining from $F4 order by {_ID} limit 500",
)
def o03(spark, sf):
    return L.capped_list(index(spark, sf).select("id"), ["id"])


@query("o05_giants", "select layer_id, n_features from $F9 where n_features > 1000000")
def o05(spark, sf):
    return L.giants(L.smallest_first(fixture(spark, sf, "F9"), "n_features", "layer_id"), "n_features").select("layer_id", "n_features")


# --- joins ------------------------------------------------------------------------------------------------


@query("j01_pending", "select id from $F8 where got is null or got < 0")
def j01(spark, sf):
    f = fixture(spark, sf, "F8")
    return J.pending(f.select("id"), f.filter("got >= 0").select("id"))


_STATUS = (
    "case when id % 3 = 0 and got = want then 'skip' when got is null or got < 0 then 'FAIL' when got = want then 'OK'"
    " else 'OK-partial(' || cast(got as varchar(20)) || '/' || cast(want as varchar(20)) || ')' end"
)


@query("j02_reconcile", f"select id, want, case when id % 3 = 0 and got = want then null else got end as got, {_STATUS} as status from $F8")
def j02(spark, sf):
    f = fixture(spark, sf, "F8")
    done = (F.col("id") % 3 == 0) & (F.col("got") == F.col("want"))
    existing = f.filter(done).select("id", F.col("got").alias("rows"))
    converted = f.filter(F.col("got").isNotNull() & ~done).select("id", F.col("got").alias("rows"))
    return J.reconcile(f.select("id", "want"), existing, converted)


@query("j03_materialised", f"select {_ID} as id, kind from $F4 where seq % 7 <> 0")
def j03(spark, sf):
    df = index(spark, sf).withColumn("src", F.concat("id", F.lit(".parquet")))
    files = df.filter("seq % 7 <> 0").select(F.col("src").alias("file"))
    return J.materialised(df, files).select("id", "kind")


@query(
    "j04_lookup_dataset",
    f"select {_ID} as id, case when seq % 4 = 0 then 'table' else kind end as type,"
    " case when seq % 4 = 0 or seq % 3 = 0 then '4326' else '25830' end as crs,"
    f" case when seq % 4 <> 0 and seq % 5 = 0 then 'given.parquet' else 'v3/' || {_ID} || '/data/' || {_ID} || '.parquet' end as parquet,"
    f" 'v3/' || {_ID} || '/metadata/v1.metadata.json' as meta from $F4",
)
def j04(spark, sf):
    df = index(spark, sf)
    known = df.filter("seq % 4 <> 0").select(
        "id",
        F.col("kind").alias("type"),
        F.when(F.col("seq") % 3 != 0, 25830).alias("crs"),
        F.when(F.col("seq") % 5 == 0, "given.parquet").alias("parquet"),
        F.lit(None).cast("string").alias("meta"),
    )
    return J.lookup_dataset(df.select("id"), known)


_TITLE_SLUG = "trim(regexp_replace(lower(title), '[^a-z0-9]+', '_', 'g'), '_')"


@query(
    "j07_resolve_kind_collisions",
    f"select seq, t.slug || case when v.slug is not null then '__tab' else '' end as out_id"
    f" from (select seq, {_TITLE_SLUG} as slug from $F4 where kind = 'tabular') t"
    f" left join (select distinct {_TITLE_SLUG} as slug from $F4 where kind = 'vector' and seq % 2 = 0) v using (slug)",
)
def j07(spark, sf):
    df = index(spark, sf).withColumn("id", TX.slug(F.col("title"), "coverage"))
    out = J.resolve_kind_collisions(df.filter("kind = 'tabular'"), df.filter("kind = 'vector' and seq % 2 = 0"))
    return out.select("seq", "out_id")


# --- aggregates ---------------------------------------------------------------------------------------------


@query(
    "a05_row_count",
    f"select {_ID} as id, cast(case when seq % 2 = 0 and seq % 5 <> 0 then seq * 10 else coalesce(n_rows, 0) end as bigint) as n from $F4",
)
def a05(spark, sf):
    df = index(spark, sf)
    totals = df.select(
        "id",
        F.when(F.col("seq") % 5 == 0, F.lit("")).otherwise((F.col("seq") * 10).cast("string")).alias("total_records"),
    )
    counted = df.select("id", F.coalesce("rows", F.lit(0)).alias("n"))
    return J.row_count(df.select("id", (F.col("seq") % 2 == 0).alias("partitioned")), totals, counted)


@query("a06_index_facets", "select kind, count(*) as n from $F4 group by kind union all select 'all', count(*) from $F4")
def a06(spark, sf):
    aliased = index(spark, sf).withColumn("kind", F.when(F.col("kind") == "tabular", "table").otherwise(F.col("kind")))
    return K.index_facets(aliased)


@query(
    "a07_format_facets",
    "select 'format' as facet, format as value, count(distinct pkg_id) as datasets from $F5 group by 2 union all"
    " select 'format', 'PDF', count(*) from $F5 union all"
    " select 'publisher', publisher, count(*) from $F5 group by 2 union all"
    " select 'group', grp, count(*) from $F5 where pkg_id % 4 <> 0 group by 2",
)
def a07(spark, sf):
    return K.format_facets(packages(spark, sf))


@query(
    "a08_workspace_profile",
    "select ws, count(*) as layers, cast(sum(n_features) as bigint) as features from $F9 group by ws"
    " union all select null, count(*), cast(sum(n_features) as bigint) from $F9",
)
def a08(spark, sf):
    return K.workspace_profile(fixture(spark, sf, "F9"), "n_features")


@query(
    "a09_count_histogram",
    "select case when n_features <= 1000 then '<=1k' when n_features <= 10000 then '1k-10k' when n_features <= 100000"
    " then '10k-100k' when n_features <= 1000000 then '100k-1M' else '>1M' end as bucket, count(*) as layers from $F9 group by 1",
)
def a09(spark, sf):
    return K.count_histogram(fixture(spark, sf, "F9"), "n_features")


def results(spark, sf):
    f = fixture(spark, sf, "F8")
    return f.select("id", F.expr(_STATUS).alias("status"))


@query(
    "a10_status_tally",
    "select cast(count_if(s like 'OK%') as bigint) as ok, cast(count_if(s = 'skip') as bigint) as skip, cast(count_if(s = 'FAIL') as bigint) as fail, count(*) as total,"
    f" round(count_if(s <> 'FAIL') / count(*), 6) as success_rate from (select {_STATUS} as s from $F8)",
)
def a10(spark, sf):
    return K.status_tally(results(spark, sf)).withColumn("success_rate", F.round("success_rate", 6))


@query("a10_first_failures", f"select id, {_STATUS} as status from $F8 where got is null or got < 0 order by id limit 30")
def a10_failures(spark, sf):
    return K.first_failures(results(spark, sf), "id")


@query(
    "a11_namespace_listing",
    "select ns as namespace, cast((rn - 1) // 50 as bigint) as page, cast(count(*) as integer) as tables, min(id) as first_name, max(id) as last_name from"
    f" (select case kind when 'vector' then 'v3' when 'tabular' then 'tab' else 'cog' end as ns, {_ID} as id,"
    f" row_number() over (partition by kind order by {_ID}) as rn from $F4) group by 1, 2",
)
def a11(spark, sf):
    ns = F.when(F.col("kind") == "vector", "v3").when(F.col("kind") == "tabular", "tab").otherwise("cog")
    pages = K.namespace_listing(index(spark, sf).select(ns.alias("namespace"), F.col("id").alias("name")), 50)
    names = F.from_json("identifiers", "array<struct<namespace:array<string>,name:string>>")
    return pages.select(
        "namespace",
        "page",
        "tables",
        F.get(names, 0)["name"].alias("first_name"),
        F.element_at(names, -1)["name"].alias("last_name"),
    )


_LATEST = "row_number() over (partition by title order by seq desc) = 1"


@query("a12_upsert_manifest", f"select title as id, seq, kind from $F4 qualify {_LATEST.replace('seq desc', 'seq % 2 desc, seq desc')}")
def a12(spark, sf):
    df = fixture(spark, sf, "F4").select(F.col("title").alias("id"), "seq", "kind")
    return U.upsert_manifest(df.filter("seq % 2 = 0"), df.filter("seq % 2 = 1"))


@query("w02_latest_per_id", f"select title, seq, kind, theme from $F4 qualify {_LATEST}")
def w02(spark, sf):
    return U.latest_per_id(fixture(spark, sf, "F4").select("title", "seq", "kind", "theme"), "title")


_LAYER_SLUG = "trim(regexp_replace(lower(split_part(name, ':', 2)), '[^a-z0-9]+', '_', 'g'), '_')"


@query(
    "w01_disambiguate_ids",
    "select seq, case when count(*) over (partition by slug) > 1 then lower(split_part(name, ':', 1)) || '_' || slug else slug end as id"
    f" from (select seq, name, {_LAYER_SLUG} || case when seq % 9 = 0 then cast(seq as varchar) else '' end as slug from $F4)",
)
def w01(spark, sf):
    f = fixture(spark, sf, "F4")
    unique = F.when(F.col("seq") % 9 == 0, F.col("seq").cast("string")).otherwise(F.lit(""))
    slug = F.concat(TX.slug(F.col("name"), "layer"), unique)
    return W.disambiguate_ids(f, slug, F.substring_index("name", ":", 1)).select("seq", "id")


@query(
    "w01_disambiguate_packages",
    "select seq, case when count(*) over (partition by slug) > 1 then slug || '_' || substr(sha256(cast(seq as varchar)), 1, 8)"
    f" else slug end as id from (select seq, {_TITLE_SLUG} || case when seq % 2 = 0 then cast(seq as varchar) else '' end as slug from $F4)",
)
def w01_packages(spark, sf):
    f = fixture(spark, sf, "F4")
    unique = F.when(F.col("seq") % 2 == 0, F.col("seq").cast("string")).otherwise(F.lit(""))
    slug = TX.slug(F.concat("title", unique), "package")
    return W.disambiguate_packages(f, slug, F.col("seq")).select("seq", "id")


@query(
    "w03_progress",
    "select id, status, publisher, row_number() over w as i, cast(sum(case when fail then 0 else 1 end) over w as bigint) as ok,"
    " cast(sum(case when fail then 1 else 0 end) over w as bigint) as fail, count(*) over (partition by publisher) as total"
    f" from (select id, {_STATUS} as status, 'p' || id % 5 as publisher, got is null or got < 0 as fail from $F8)"
    " window w as (partition by publisher order by id rows between unbounded preceding and current row)",
)
def w03(spark, sf):
    runs = results(spark, sf).withColumn("publisher", F.concat(F.lit("p"), (F.col("id") % 5).cast("string")))
    return W.progress(runs, "publisher", "id", block_rows=1000)


@query(
    "w03_progress_null_keys",
    "select id, ref, status, publisher, row_number() over w as i, count(*) over (partition by publisher) as total"
    f" from (select case when id % 11 = 0 and id % 7 = 0 then null else id end as id, id as ref, {_STATUS} as status,"
    " case when id % 7 = 0 then null else 'p' || id % 5 end as publisher from $F8)"
    " window w as (partition by publisher order by id nulls first, ref rows between unbounded preceding and current row)",
)
def w03_null_keys(spark, sf):
    """A seventh of the runs has no publisher, some of them no sequence number; those are in order of another column."""
    runs = results(spark, sf).withColumn("ref", F.col("id"))
    publisher = F.when(F.col("id") % 7 != 0, F.concat(F.lit("p"), (F.col("id") % 5).cast("string")))
    runs = runs.withColumn("publisher", publisher).withColumn("id", F.expr("case when id % 77 <> 0 then id end"))
    return W.progress(runs, "publisher", "id", block_rows=1000, tie="ref").select("id", "ref", "status", "publisher", "i", "total")


# --- set operations -----------------------------------------------------------------------------------------


@query(
    "u01_build_index",
    f"select {_ID} as id, kind, cast(n_rows as bigint) as rows, row_number() over (order by case kind when 'vector' then 1 when 'tabular' then 2 else 3 end, {_ID}) - 1"
    " as position from $F4",
)
def u01(spark, sf):
    df = index(spark, sf).select("id", "kind", "rows")
    vector, tabular = (df.filter(F.col("kind") == k).drop("kind") for k in ("vector", "tabular"))
    raster = df.filter("kind = 'raster'").select("id")
    built = U.build_index(vector, tabular, raster)
    ranked = built.withColumn("_rank", U.kind_rank(F.col("kind")))
    return L.with_global_position(ranked, ["_rank", "id"]).drop("_rank")


@query(
    "u02_add_only",
    f"select {_ID} as id, case when seq % 3 = 0 then 'new' else 'old' end as version from $F4 where seq % 2 = 0 or seq % 3 = 0",
)
def u02(spark, sf):
    df = index(spark, sf)
    old = df.filter("seq % 2 = 0").select("id", F.lit("old").alias("version"))
    return U.add_only(old, df.filter("seq % 3 = 0").select("id", F.lit("new").alias("version")))


@query(
    "u03_missing_or_extra",
    "select id, rows, side from (select id, want as rows, 'missing' as side from $F8 where got is null or got <> want"
    " union all select id, got, 'extra' from $F8 where got <> want)",
)
def u03(spark, sf):
    f = fixture(spark, sf, "F8")
    return U.missing_or_extra(
        f.select("id", F.col("want").alias("rows")), f.filter("got is not null").select("id", F.col("got").alias("rows"))
    )


# --- index documents ---------------------------------------------------------------------------------------


@query(
    "x05_index_properties",
    "select seq, title, title as describes, theme, 'EPSG:25830' as crs, 'true' as materialized, cast(n_rows as bigint) as rows, kind,"
    " 'Open Semantic Interchange' as spec, case when kind = 'tabular' then 'false' end as geospatial,"
    " true as has_rows_key, title as table_label, case when kind = 'tabular' then null else 'EPSG:25830' end as table_crs from $F4",
)
def x05(spark, sf):
    df = index(spark, sf)
    doc = K.index_properties(F.col("title"), F.col("theme"), F.col("rows"), F.col("kind"), "EPSG:25830", "Provider", "CC-BY-4.0")
    own = K.table_properties(F.col("title"), F.col("theme"), F.col("kind"), "EPSG:25830", "Provider", "CC-BY-4.0")
    at = lambda path: F.get_json_object("doc", path)
    return df.withColumn("doc", doc).withColumn("own", own).select(
        "seq",
        at("$.title").alias("title"),
        at("$.semantics.describes").alias("describes"),
        at("$.theme").alias("theme"),
        at("$.crs").alias("crs"),
        at("$.materialized").alias("materialized"),
        at("$.rows").cast("bigint").alias("rows"),
        at("$.kind").alias("kind"),
        at("$.semantics.spec").alias("spec"),
        at("$.geospatial").alias("geospatial"),
        F.col("doc").contains('"rows":').alias("has_rows_key"),
        F.get_json_object(F.get_json_object("own", "$.semantics"), "$.label").alias("table_label"),
        F.get_json_object("own", "$.crs").alias("table_crs"),
    )


@query(
    "x06_index_assets",
    f"select seq, case kind when 'vector' then 'v3.' || {_ID} when 'tabular' then 'tab.' || {_ID} else '{BASE}/data/cog/' || {_ID} || '.tif' end as href,"
    " case kind when 'raster' then 'image/tiff; application=geotiff; profile=cloud-optimized' else 'application/x-iceberg' end as media,"
    " 'data' as role,"
    f" case kind when 'vector' then '{BASE}/data/parquet/' || {_ID} || '.parquet' when 'tabular' then '{BASE}/data/parquet_tab/' || {_ID} || '.parquet' end as parquet from $F4",
)
def x06(spark, sf):
    df = index(spark, sf).withColumn("doc", K.index_assets(F.col("kind"), F.col("id"), BASE, "EPSG:25830"))
    at = lambda path: F.get_json_object("doc", path)
    return df.select(
        "seq",
        at("$.data.href").alias("href"),
        at("$.data.type").alias("media"),
        at("$.data.roles[0]").alias("role"),
        at("$.data_parquet.href").alias("parquet"),
    )


@query(
    "x10_collection_extensions",
    f"select seq, case seq % 4 when 0 then 'v3.' || {_ID} when 1 then 'tab.' || {_ID} end as table_id,"
    f" case seq % 4 when 0 then '{BASE}/data/v3/' || {_ID} when 1 then '{BASE}/data/tab/' || {_ID} end as iceberg_href,"
    " case when seq % 4 < 2 then cast(seq as varchar) end as snapshot,"
    " case when seq % 4 = 1 then 'false' end as geospatial,"
    " case seq % 4 when 2 then 'https://r.example.org/a' when 3 then 'https://r.example.org/a' end as data_href,"
    " case seq % 4 when 2 then 'application/x-raquet' when 3 then 'application/vnd.apache.parquet' end as media,"
    " case when seq % 4 = 3 then 'external' end as second_role,"
    f" 'https://git.example.org/r/edit/main/' || {_ID} || '/collection.json' as edit_url, 'via' as rel,"
    " 'https://src.example.org/' || seq as via from $F4",
)
def x10(spark, sf):
    kind = F.element_at(F.array(*[F.lit(k) for k in ("vector", "non-geo", "raster", "remote")]), (F.col("seq") % 4 + 1).cast("int"))
    doc = K.collection_extensions(
        kind,
        F.col("id"),
        F.col("id"),
        F.col("seq"),
        F.lit("https://r.example.org/a"),
        F.concat(F.lit("https://src.example.org/"), F.col("seq").cast("string")),
        BASE,
        "https://git.example.org/r",
    )
    at = lambda path: F.get_json_object("doc", path)
    return index(spark, sf).withColumn("doc", doc).select(
        "seq",
        at("$['iceberg:table_id']").alias("table_id"),
        at("$.assets.iceberg.href").alias("iceberg_href"),
        at("$['iceberg:current_snapshot_id']").alias("snapshot"),
        at("$.geospatial").alias("geospatial"),
        at("$.assets.data.href").alias("data_href"),
        at("$.assets.data.type").alias("media"),
        at("$.assets.data.roles[1]").alias("second_role"),
        at("$['git:edit_url']").alias("edit_url"),
        at("$.links[0].rel").alias("rel"),
        at("$.links[0].href").alias("via"),
    )


# --- quality ------------------------------------------------------------------------------------------------


@query(
    "q01_validate_records",
    "select id, array_to_string(list_filter([case when iceberg_table = 'bad-table' then 'iceberg_table' end,"
    " case when access = 'ftp' then 'access' end,"
    " case when provenance = '{\"source\":\"s\"}' then 'provenance.processing' end], lambda v: v is not null), ',') as violations from $F6",
)
def q01(spark, sf):
    out = Q.validate_records(fixture(spark, sf, "F6"))
    return out.select("id", F.array_join("violations", ",").alias("violations"))


_RULES = {
    "geometry_with_srid": "seq % 9 <> 1",
    "geometry_id_before_bbox": "seq % 9 <> 2",
    "ids_contiguous": "seq % 9 <> 3",
    "bbox_in_file_hidden": "seq % 9 <> 4",
    "stats_complete": "seq % 9 <> 5",
    "names_lower_case": "seq % 9 <> 6",
    "described": "seq % 9 <> 7",
    "names_unique": "seq % 9 <> 8",
}


@query(
    "q02_audit_layout",
    " union all ".join(f"select seq as dataset, '{rule}' as rule, {ok} as ok from $F4" for rule, ok in _RULES.items()),
)
def q02(spark, sf):
    """Each dataset breaks at most one rule, chosen by its key."""
    m = F.col("seq") % 9
    swap = m == 2
    geom_id, first_box = F.when(swap, 4).otherwise(3), F.when(swap, 3).otherwise(4)
    plain = [
        (F.lit("id"), F.lit("long"), F.lit(1), F.lit(True)),
        (F.when(m == 6, "Name").when(m == 8, "id").otherwise("name"), F.lit("string"), F.lit(2), F.lit(True)),
        (F.lit("geom"), F.when(m == 1, "geometry").otherwise("geometry(srid:25830)"), geom_id, F.lit(True)),
        (F.lit("xmin"), F.lit("double"), first_box, m == 4),
        (F.lit("ymin"), F.lit("double"), F.lit(5), F.lit(False)),
        (F.lit("xmax"), F.lit("double"), F.lit(6), F.lit(False)),
        (F.lit("ymax"), F.lit("double"), F.when(m == 3, 9).otherwise(7), F.lit(False)),
    ]
    rows = F.array(
        *[
            F.struct(
                name.alias("column"),
                kind.alias("type"),
                fid.alias("field_id"),
                logical.alias("in_schema"),
                F.when((m == 5) & (fid == 1), False).otherwise(True).alias("has_stats"),
                F.when((m == 7) & (fid == 1), F.lit("")).otherwise(name).alias("doc"),
            )
            for name, kind, fid, logical in plain
        ]
    )
    columns = fixture(spark, sf, "F4").select(F.col("seq").alias("dataset"), F.inline(rows))
    return Q.audit_layout(columns)


@query(
    "q03_audit_geometries",
    "select 'before' as stage, count(*) as rows, cast(count_if(geom_state = 'null') as bigint) as null_geometries,"
    " cast(count_if(geom_state = 'empty') as bigint) as empty_geometries, cast(0 as bigint) as unreadable_geometries,"
    " cast(0 as bigint) as non_finite_bbox from $F2 union all"
    " select 'after', cast(count_if(geom_state = 'polygon') as bigint), 0, 0, 0, 0 from $F2",
)
def q03(spark, sf):
    df = C.boxes(spark, sf)
    before = Q.audit_geometries(df).withColumn("stage", F.lit("before"))
    return before.unionByName(Q.audit_geometries(OG.drop_null_or_empty_geometry(df)).withColumn("stage", F.lit("after")))


@query(
    "q03_unreadable",
    "select part_key, count(*) as rows, cast(count_if(geom_state = 'null') as bigint) as null_geometries,"
    " cast(count_if(geom_state = 'empty' and id % 5 <> 0) as bigint) as empty_geometries,"
    " cast(count_if(geom_state <> 'null' and id % 5 = 0) as bigint) as unreadable_geometries, cast(0 as bigint) as non_finite_bbox"
    " from $F2 group by part_key",
)
def q03_unreadable(spark, sf):
    """Every fifth geometry is cut short by three bytes."""
    cut = F.expr("case when id % 5 = 0 then substring(geom, 1, length(geom) - 3) else geom end")
    return Q.audit_geometries(C.boxes(spark, sf).withColumn("geom", cut), by=("part_key",))


@query(
    "q04_verify_migration",
    "select id, c as counts_equal, a as href_absolute, i as identified, r as remote_href, c and a and i and r as ok from"
    " (select id, case when id % 4 < 2 then coalesce(got = want, false) else true end as c, coalesce(got, 0) <> 0 and id % 10 <> 0 as a,"
    " case id % 4 when 0 then coalesce(got, 0) <> 0 and id % 7 <> 0 when 1 then coalesce(got, 0) <> 0 else true end as i,"
    " case when id % 4 = 3 then coalesce(got, 0) <> 0 else true end as r from $F8)",
)
def q04(spark, sf):
    f = fixture(spark, sf, "F8")
    kinds = F.array(*[F.lit(k) for k in ("vector", "non-geo", "raster", "remote")])
    kind = F.element_at(kinds, (F.col("id") % 4 + 1).cast("int"))
    source = f.select("id", kind.alias("kind"), F.col("want").alias("rows"))
    made = f.filter("coalesce(got, 0) <> 0")
    href = F.when(F.col("id") % 10 == 0, F.lit("data/x.parquet")).otherwise(F.lit("https://x.example.org/x.parquet"))
    output = made.select(
        "id",
        F.col("got").alias("rows"),
        href.alias("href"),
        F.when((F.col("id") % 4 == 0) & (F.col("id") % 7 != 0), F.lit("v3.x")).alias("table_id"),
        F.when(F.col("id") % 4 == 1, F.lit(False)).alias("geospatial"),
    )
    return Q.verify_migration(source, output)


@query(
    "q06_usable_output",
    "select id, case id % 3 when 0 then case when id % 1000 < 5 then 'empty' else 'ok' end"
    " when 1 then case when id % 1000 >= 200 and coalesce(got, -1) >= 1 then 'ok' else 'unusable' end"
    " else case when (id % 1000) * 2 >= 1000 and id % 11 <> 0 then 'ok' else 'unusable' end end as verdict from $F8",
)
def q06(spark, sf):
    f = fixture(spark, sf, "F8")
    m = F.col("id") % 3
    files = f.select(
        "id",
        F.when(m == 0, "source").when(m == 1, "parquet").otherwise("raster").alias("kind"),
        F.when(m == 2, F.col("id") % 1000 * 2).otherwise(F.col("id") % 1000).alias("bytes"),
        F.col("got").alias("rows"),
        F.when(F.col("id") % 11 == 0, "<").otherwise("I").alias("first_byte"),
    )
    return Q.usable_output(files).select("id", "verdict")
