"""Names, types, order, ids, text functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.common import boxes_with_bbox, boxes_with_struct
from checks.registry import fixture, query, table
from geoloom.functions import guards as GU
from geoloom.functions import text as TX
from geoloom.operators import geometry as OG
from geoloom.operators import joins as J
from geoloom.operators import schema as S
from geoloom.operators import stats as ST


@query(
    "p01_coerce_types",
    "select l_orderkey, l_quantity, l_returnflag, cast(l_shipdate as varchar) as l_shipdate,"
    " cast(l_linenumber as varchar) as line_small, l_linenumber,"
    " cast(cast(l_tax as decimal(10,4)) as varchar) as tax_dec, l_returnflag as flag_bytes from lineitem",
)
def p01(spark, sf):
    df = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_quantity",
        "l_returnflag",
        "l_shipdate",
        F.col("l_linenumber").cast("smallint").alias("line_small"),
        "l_linenumber",
        F.col("l_tax").cast("decimal(10,4)").alias("tax_dec"),
        F.col("l_returnflag").cast("binary").alias("flag_bytes"),
    )
    return S.coerce_types(df, "strict")


@query(
    "p01_coerce_types_broad",
    "select l_orderkey, cast(l_shipdate as varchar) as l_shipdate, l_linenumber as line_small,"
    " cast(length(l_returnflag) as integer) as flag_bytes from lineitem",
)
def p01_broad(spark, sf):
    df = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_shipdate",
        F.col("l_linenumber").cast("smallint").alias("line_small"),
        F.col("l_returnflag").cast("binary").alias("flag_bytes"),
    )
    return S.coerce_types(df, "broad").withColumn("flag_bytes", F.octet_length("flag_bytes"))


@query("p01_coerce_list", "select vec_id, label, cast(embedding as varchar) as embedding from embeddings")
def p01_list(spark, sf):
    return S.coerce_types(table(spark, sf, "embeddings"), "strict")


@query(
    "p02_temporals_to_string",
    "select event_id, cast(ts as varchar) as ts, cast(cast(ts as date) as varchar) as day,"
    " strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as ts_micro from events",
)
def p02(spark, sf):
    df = table(spark, sf, "events").select("event_id", "ts", F.col("ts").cast("date").alias("day"))
    micro = S.temporals_to_string(df.select("event_id", F.col("ts").alias("ts_micro")), "micro")
    return S.temporals_to_string(df).join(micro, "event_id")


@query(
    "p03_lowercase_names",
    "select o_orderkey as a, o_custkey as a_2, o_orderstatus as a_2_2, o_totalprice as status,"
    " o_orderpriority as status_4 from orders",
)
def p03(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    # names a, a_2, A, Status, STATUS: the first clash would take a_2, which is used already
    mixed = df.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority").toDF(
        "a", "A_2", "A", "Status", "STATUS"
    )
    return S.lowercase_names(mixed)


@query("p04_drop_columns", "select o_custkey as ogc_fid, o_totalprice as price from orders")
def p04(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice").toDF("OGC_FID", "ogc_fid", "price")
    return S.drop_columns(df)


@query(
    "p05_flatten_bbox",
    "select id, part_key, attr, case geom_state when 'polygon' then 93 when 'empty' then 9 end as geom_bytes,"
    " case when geom_state = 'polygon' then x0 end as fp_xmin, case when geom_state = 'polygon' then y0 end as fp_ymin,"
    " case when geom_state = 'polygon' then x0 + w end as fp_xmax,"
    " case when geom_state = 'polygon' then y0 + h end as fp_ymax from $F2",
)
def p05(spark, sf):
    flat = S.flatten_bbox(boxes_with_struct(spark, sf))
    return flat.withColumn("geom_bytes", F.octet_length("geom_wkb")).drop("geom_wkb")


def _positions(df, names):
    """Column statistics of a frame with the place of each column in it."""
    place = F.create_map(*[x for i, n in enumerate(names, 1) for x in (F.lit(n), F.lit(i))])
    return ST.column_stats(df).select(
        F.element_at(place, F.col("column")).alias("ordinal"), "column", "value_count", "null_count"
    )


_EMPTY = "sum(case when geom_state = 'polygon' then 0 else 1 end)"
_NULLS = "sum(case when geom_state = 'null' then 1 else 0 end)"


def _column_rows(entries: list[tuple[str, str]]) -> str:
    return " union all ".join(
        f"select {i} as ordinal, '{name}' as \"column\", count(*) as value_count,"
        f" cast({nulls} as bigint) as null_count from $F2"
        for i, (name, nulls) in enumerate(entries, 1)
    )


@query(
    "p07_canonical_order",
    _column_rows(
        [("id", "0"), ("part_key", "0"), ("attr", "0"), ("geom", _NULLS)] + [(c, _EMPTY) for c in ("xmin", "ymin", "xmax", "ymax")]
    ),
)
def p07(spark, sf):
    shuffled = boxes_with_bbox(spark, sf).select("ymax", "geom", "id", "xmin", "part_key", "ymin", "attr", "xmax")
    ordered = S.canonical_order(shuffled)
    return _positions(ordered, ordered.columns)


@query("p08_logical_schema", _column_rows([("id", "0"), ("part_key", "0"), ("attr", "0"), ("geom", _NULLS)]))
def p08(spark, sf):
    df = S.with_field_ids(S.canonical_order(boxes_with_bbox(spark, sf)))
    logical = S.hide_bbox(df)
    ids = {f["name"]: f["id"] for f in S.logical_schema(df)}
    return _positions(logical, sorted(ids, key=ids.get))


@query(
    "p09_with_field_ids",
    "select 1 as id, 'id' as name, 'long' as type, 'id' as doc, count(*) as value_count from orders union all"
    " select 2, 'part_key', 'string', repeat('d', 300), count(*) from orders union all"
    " select 3, 'attr', 'double', 'Precio total', count(*) from orders union all"
    " select 4, 'geom', 'geometry(srid:25830)', 'Geometría (EPSG:25830, tipo Geometry nativo). Planta', count(*) from orders",
)
def p09(spark, sf):
    docs = {"attr": "Precio total", "part_key": "d" * 400, "geom": "Planta"}
    df = S.with_field_ids(S.canonical_order(boxes_with_bbox(spark, sf)), docs, epsg=25830)
    return _described(df)


def _described(df):
    counts = ST.column_stats(S.hide_bbox(df)).select(F.col("column").alias("name"), "value_count")
    return S.describe_dataset(df).join(counts, "name")


@query(
    "p10_describe_dataset",
    "select 1 as id, 'o_orderkey' as name, 'long' as type, 'o_orderkey' as doc, count(*) as value_count from orders"
    " union all select 2, 'o_custkey', 'long', 'o_custkey', count(*) from orders"
    " union all select 3, 'o_orderstatus', 'string', 'o_orderstatus', count(*) from orders"
    " union all select 4, 'o_totalprice', 'double', 'Importe', count(*) from orders"
    " union all select 5, 'o_orderdate', 'string', 'o_orderdate', count(*) from orders"
    " union all select 6, 'o_orderpriority', 'string', 'o_orderpriority', count(*) from orders",
)
def p10(spark, sf):
    df = S.with_field_ids(S.coerce_types(table(spark, sf, "orders")), {"o_totalprice": "Importe"})
    return _described(df)


_GEOM_TYPE = (
    "case when kind <> 'vector' then 'BLOB' when seq % 2 = 0 then 'GEOMETRY(''EPSG:25830'')' else 'GEOMETRY' end"
)


@query(
    "p11_detect_geometry",
    "select seq as dataset, case when kind = 'vector' then 'shape' when seq % 4 = 0 then 'extra' end as geom_column,"
    " case when kind = 'vector' and seq % 2 = 0 then 25830 when kind = 'vector' then 4326"
    " when seq % 4 = 0 then 4258 end as epsg,"
    " (kind = 'vector' and seq % 2 <> 0) as crs_assumed from $F4",
)
def p11(spark, sf):
    f = fixture(spark, sf, "F4")
    extra = F.when(F.col("seq") % 4 == 0, F.lit("GEOMETRY('EPSG:4258')")).otherwise(F.lit("VARCHAR"))
    named = [("id", F.lit("BIGINT")), ("shape", F.expr(_GEOM_TYPE.replace("''", "\\'"))), ("extra", extra)]
    rows = F.array(
        *[F.struct(F.lit(i).alias("ordinal"), F.lit(n).alias("column"), t.alias("type")) for i, (n, t) in enumerate(named)]
    )
    return S.detect_geometry(f.select(F.col("seq").alias("dataset"), F.inline(rows)))


# --- text functions -----------------------------------------------------------------------------------

_SLUG = "trim(regexp_replace(lower({}), '[^a-z0-9]+', '_', 'g'), '_')"


@query(
    "x01_slug",
    "select seq, " + _SLUG.format("split_part(name, ':', 2)") + " as layer,"
    " substr(" + _SLUG.format("concat(name, ' -- ', repeat(title || ' Ñ ', 12))") + ", 1, 80) as package,"
    " " + _SLUG.format("concat(theme, '__', title)") + " as coverage from $F4",
)
def x01(spark, sf):
    f = fixture(spark, sf, "F4")
    long_name = F.concat("name", F.lit(" -- "), F.repeat(F.concat("title", F.lit(" Ñ ")), 12))
    return f.select(
        "seq",
        TX.slug(F.col("name"), "layer").alias("layer"),
        TX.slug(long_name, "package").alias("package"),
        TX.slug(F.concat("theme", F.lit("__"), "title"), "coverage").alias("coverage"),
    )


@query(
    "x02_theme",
    "select pkg_id, case when pkg_id % 3 = 0 then 'OpenData' else grp end as package,"
    " case when pkg_id % 2 = 0 then publisher else 'raster' end as coverage, publisher as layer from $F5",
)
def x02(spark, sf):
    f = fixture(spark, sf, "F5")
    groups = F.when(F.col("pkg_id") % 3 == 0, F.array().cast("array<string>")).otherwise(F.array("grp", "publisher"))
    cid = F.when(F.col("pkg_id") % 2 == 0, F.concat("publisher", F.lit("__"), "grp")).otherwise(F.col("publisher"))
    return f.select(
        "pkg_id",
        TX.package_theme(groups).alias("package"),
        TX.coverage_theme(cid).alias("coverage"),
        TX.layer_theme(F.col("publisher")).alias("layer"),
    )


@query(
    "x03_humanise",
    "select seq, array_to_string(list_transform(string_split(replace(title, '_', ' '), ' '),"
    " lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), ' ')"
    " || case when seq % 3 = 0 then ' (Tabla)' else '' end as label from $F4",
)
def x03(spark, sf):
    ident = F.concat(
        F.translate("title", " ", "_"), F.when(F.col("seq") % 3 == 0, F.lit("__tab")).otherwise(F.lit(""))
    )
    return fixture(spark, sf, "F4").select("seq", TX.humanise(ident).alias("label"))


@query("x04_safe_table_name", "select seq, regexp_replace(name || '-' || theme, '[^A-Za-z0-9_]', '_', 'g') as tname from $F4")
def x04(spark, sf):
    full = F.concat("name", F.lit("-"), "theme")
    return fixture(spark, sf, "F4").select("seq", TX.safe_table_name(full).alias("tname"))


@query(
    "x07_s3_uri",
    "select pkg_id, case when pkg_id % 11 = 0 then null else 's3://b/' || cast(pkg_id as varchar)"
    " || '.csv?from=https://storage.googleapis.com/x' end as uri from $F5",
)
def x07(spark, sf):
    url = F.concat("url", F.lit("?from=https://storage.googleapis.com/x"))
    return fixture(spark, sf, "F5").select("pkg_id", TX.s3_uri(url).alias("uri"))


@query(
    "x08_dataset_path",
    "select seq, 'https://data.example.org/cat/' || case when seq % 2 = 0 then 'given/' || seq || '.parquet'"
    " else 'v3/d' || seq || '/data/d' || seq || '.parquet' end as url,"
    " 'v3/d' || seq || '/metadata/v1.metadata.json' as meta from $F4",
)
def x08(spark, sf):
    ident = F.concat(F.lit("d"), F.col("seq").cast("string"))
    given = F.when(F.col("seq") % 2 == 0, F.concat(F.lit("given/"), F.col("seq").cast("string"), F.lit(".parquet")))
    return fixture(spark, sf, "F4").select(
        "seq",
        TX.dataset_path("https://data.example.org/cat", TX.data_path(ident, given)).alias("url"),
        TX.metadata_path(ident).alias("meta"),
    )


_HREF = (
    "case seq % 6 when 0 then concat('v3.d', cast(seq as varchar(20))) when 1 then concat('tab.d', cast(seq as varchar(20)))"
    " when 2 then concat('https://x.example.org/data/raster/', cast(seq as varchar(20)), '.parquet')"
    " when 3 then concat('s3://release/', cast(seq as varchar(20)), '.parquet')"
    " when 4 then concat('v2.d', cast(seq as varchar(20))) else 'https://x.example.org/other' end"
)


@query(
    "x09_classify_by_href",
    "select seq, case seq % 6 when 0 then 'vector' when 1 then 'non-geo' when 2 then 'raster' when 3 then 'remote'"
    " when 4 then 'vector' end as kind from $F4",
)
def x09(spark, sf):
    return fixture(spark, sf, "F4").select("seq", TX.classify_by_href(F.expr(_HREF)).alias("kind"))


@query(
    "x11_region_default",
    "select seq, cast(case when kind = 'vector' then -3.5 else -4.58 end as double) as xmin,"
    " cast(case when kind = 'vector' then 41.0 else 41.17 end as double) as ymax from $F4",
)
def x11(spark, sf):
    own = F.struct(
        F.lit(-3.5).alias("xmin"), F.lit(40.5).alias("ymin"), F.lit(-3.4).alias("xmax"), F.lit(41.0).alias("ymax")
    )
    box = GU.region_default(F.when(F.col("kind") == "vector", own))
    return fixture(spark, sf, "F4").select("seq", box.xmin.alias("xmin"), box.ymax.alias("ymax"))


@query(
    "x12_dataset_id_from_path",
    "select seq, case when seq % 9 = 0 then null else 'd_' || seq end as dataset from $F4",
)
def x12(spark, sf):
    ending = F.when(F.col("seq") % 9 == 0, F.lit(".csv")).otherwise(F.lit(".parquet"))
    path = F.concat(F.lit("gs://b/x.parquet/y/d_"), F.col("seq").cast("string"), ending)
    return fixture(spark, sf, "F4").select("seq", TX.dataset_id_from_path(path).alias("dataset"))


@query(
    "q05_finite_guard",
    "select count(*) as n, count(case when l_orderkey % 7 <= 2 then null else l_discount end) as finite_rows,"
    " max(case when l_orderkey % 7 <= 2 then null else l_discount end) as top from lineitem",
)
def q05(spark, sf):
    spoiled = (
        F.when(F.col("l_orderkey") % 7 == 0, float("nan"))
        .when(F.col("l_orderkey") % 7 == 1, float("inf"))
        .when(F.col("l_orderkey") % 7 == 2, float("-inf"))
        .otherwise(F.col("l_discount"))
    )
    df = table(spark, sf, "lineitem").select(GU.finite_guard(spoiled).alias("v"))
    return df.agg(F.count(F.lit(1)).alias("n"), F.count("v").alias("finite_rows"), F.max("v").alias("top"))


@query(
    "f10_plausible_extent",
    "select id, (w < 25 and w > 0 and h > 0 and h < 40 and not (x0 = 0 and x1 = 0)) as ok from"
    " (select id, cast(id % 30 as double) as w, cast(id % 45 as double) as h,"
    " case when id % 5 = 0 then 0.0 else -4.0 end as x0,"
    " case when id % 5 = 0 then 0.0 else -4.0 + id % 45 end as x1 from $F1)"
    .replace("w < 25 and w > 0 and h > 0 and h < 40", "w < 25 and w > 0 and x1 - x0 > 0 and x1 - x0 < 40"),
)
def f10(spark, sf):
    zero = F.col("id") % 5 == 0
    x0 = F.when(zero, 0.0).otherwise(-4.0)
    x1 = F.when(zero, 0.0).otherwise(F.lit(-4.0) + F.col("id") % 45)
    y1 = F.lit(40.0) + F.col("id") % 30
    return fixture(spark, sf, "F1").select("id", GU.plausible_extent(x0, F.lit(40.0), x1, y1).alias("ok"))


@query(
    "f11_json_property",
    "select id, json_extract_string(provenance, '$.processing') as processing,"
    " json_extract_string(provenance, '$.source') as source from $F6",
)
def f11(spark, sf):
    f = fixture(spark, sf, "F6")
    return f.select(
        "id",
        GU.json_property(F.col("provenance"), "$.processing").alias("processing"),
        GU.json_property(F.col("provenance"), "$.source").alias("source"),
    )


@query(
    "j06_with_descriptions",
    "select 'd' || o_orderkey % 97 as dataset, c.name as \"column\","
    " case when c.name = 'price' and o_orderkey % 97 % 2 = 0 then 'Importe ' || o_orderkey % 97 else c.name end as doc,"
    " count(*) as n from orders cross join (values ('id'), ('price')) c(name) group by all",
)
def j06(spark, sf):
    d = F.concat(F.lit("d"), (F.col("o_orderkey") % 97).cast("string"))
    base = table(spark, sf, "orders").select(d.alias("dataset"), (F.col("o_orderkey") % 97).alias("k"))
    columns = base.select("dataset", F.explode(F.array(F.lit("id"), F.lit("price"))).alias("column"))
    docs = base.filter("k % 2 = 0").distinct().select(
        "dataset", F.lit("price").alias("column"), F.concat(F.lit("Importe "), F.col("k").cast("string")).alias("doc")
    )
    out = J.with_descriptions(columns, docs, ("dataset", "column"))
    return out.groupBy("dataset", "column", "doc").agg(F.count(F.lit(1)).alias("n"))


@query(
    "p06_add_bbox",
    "select id, case when geom_state = 'polygon' then x0 end as xmin, case when geom_state = 'polygon' then y0 end as ymin,"
    " case when geom_state = 'polygon' then x0 + w end as xmax, case when geom_state = 'polygon' then y0 + h end as ymax"
    " from $F2",
)
def p06(spark, sf):
    return boxes_with_bbox(spark, sf).select("id", "xmin", "ymin", "xmax", "ymax")


@query(
    "p06_add_bbox_lines",
    "select line_id, min(x) as xmin, min(y) as ymin, max(x) as xmax, max(y) as ymax from $F3 group by line_id",
)
def p06_lines(spark, sf):
    from checks.common import lines

    return OG.add_bbox(lines(spark, sf)).drop("geom")
