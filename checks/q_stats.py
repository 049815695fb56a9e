"""Statistics, bounds, extents, pruning and raster."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import common as C
from checks.registry import fixture, query, table
from geoloom.operators import geometry as OG
from geoloom.operators import joins as J
from geoloom.operators import raster as R
from geoloom.operators import stats as ST
from geoloom.session import scratch_path
from geoloom.sources import datasets as D

_A01_COLUMNS = {
    "l_orderkey": "l_orderkey",
    "l_quantity": "l_quantity",
    "l_returnflag": "l_returnflag",
    "spoiled": "case when l_orderkey % 7 = 0 then null else l_discount end",
    "holes": "case when l_orderkey % 5 = 0 then null else l_partkey end",
    "nothing": "cast(null as integer)",
}
_A01_NULLS = {"spoiled": "cast(null as integer) is not null", "holes": "l_orderkey % 5 = 0", "nothing": "true"}


def _a01_sql() -> str:
    rows = []
    for name, expr in _A01_COLUMNS.items():
        text = name == "l_returnflag"
        pick = "{}" if not text else "null"
        pick_text = "{}" if text else "cast(null as varchar)"
        rows.append(
            f"select '{name}' as \"column\", count(*) as value_count,"
            f" cast(count_if({_A01_NULLS.get(name, 'false')}) as bigint) as null_count,"
            f" cast({pick.format(f'min({expr})')} as double) as lower_number, cast({pick.format(f'max({expr})')} as double) as upper_number,"
            f" {pick_text.format(f'min({expr})')} as lower_text, {pick_text.format(f'max({expr})')} as upper_text from lineitem"
        )
    return " union all ".join(rows)


@query("a01_column_stats", _a01_sql())
def a01(spark, sf):
    df = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_quantity",
        "l_returnflag",
        F.when(F.col("l_orderkey") % 7 == 0, float("nan")).otherwise(F.col("l_discount")).alias("spoiled"),
        F.when(F.col("l_orderkey") % 5 != 0, F.col("l_partkey")).alias("holes"),
        F.lit(None).cast("int").alias("nothing"),
    )
    text = F.col("kind") == "string"
    return ST.column_stats(df).select(
        "column",
        "value_count",
        "null_count",
        F.when(~text, F.col("lower")).cast("double").alias("lower_number"),
        F.when(~text, F.col("upper")).cast("double").alias("upper_number"),
        F.when(text, F.col("lower")).alias("lower_text"),
        F.when(text, F.col("upper")).alias("upper_text"),
    )


@query(
    "a02_geometry_bounds",
    "select part_key, coalesce(min(xmin), 0) as xmin, coalesce(min(ymin), 0) as ymin, coalesce(max(xmax), 0) as xmax,"
    " coalesce(max(ymax), 0) as ymax, count(xmin) > 0 as has_bound from"
    " (select case when geom_state = 'polygon' then part_key else 'none' end as part_key,"
    " case when geom_state = 'polygon' then x0 end as xmin, case when geom_state = 'polygon' then y0 end as ymin,"
    " case when geom_state = 'polygon' then x0 + w end as xmax, case when geom_state = 'polygon' then y0 + h end as ymax"
    " from $F2) group by part_key",
)
def a02(spark, sf):
    df = C.boxes_with_bbox(spark, sf)
    keyed = df.withColumn("part_key", F.when(F.col("xmin").isNull(), "none").otherwise(F.col("part_key")))
    return ST.geometry_bounds(keyed, ("part_key",))


def _le_hex(number: str, size: int) -> str:
    """Little-endian hex text of a non-negative integer."""
    h = f"lpad(hex({number}), {2 * size}, '0')"
    return " || ".join(f"substr({h}, {i}, 2)" for i in range(2 * size - 1, 0, -2))


def _a03_sql() -> str:
    long_text = "repeat(o_orderpriority, 8)"
    rows = [
        ("o_custkey", "long", _le_hex("min(o_custkey)", 8), _le_hex("max(o_custkey)", 8), "true", "true"),
        ("small", "int", _le_hex("min(o_custkey % 100)", 4), _le_hex("max(o_custkey % 100)", 4), "true", "true"),
        ("o_orderpriority", "string", "hex(min(o_orderpriority))", "hex(max(o_orderpriority))", "true", "true"),
        (
            "long_text",
            "string",
            f"hex(substr(min({long_text}), 1, 32))",
            f"hex(substr(max({long_text}), 1, 31) || chr(ascii(substr(max({long_text}), 32, 1)) + 1))",
            "true",
            "false",
        ),
        ("big", "boolean", "'00'", "'01'", "true", "true"),
        ("nothing", "string", "''", "'7E'", "false", "false"),
        ("infinite", "double", "'0000000000000000'", "'0000000000000000'", "false", "false"),
    ]
    return " union all ".join(
        f"select o_orderstatus as dataset, '{n}' as \"column\", '{k}' as kind, count(*) as value_count,"
        f" {lo} as lower_hex, {hi} as upper_hex, {ok} as has_bound, {ex} as exact from orders group by o_orderstatus"
        for n, k, lo, hi, ok, ex in rows
    )


@query("a03_encoded_bounds", _a03_sql())
def a03(spark, sf):
    df = table(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("dataset"),
        "o_custkey",
        (F.col("o_custkey") % 100).cast("int").alias("small"),
        "o_orderpriority",
        F.repeat("o_orderpriority", 8).alias("long_text"),
        (F.col("o_custkey") > 100).alias("big"),
        F.lit(None).cast("string").alias("nothing"),
        F.when(F.col("o_custkey") > 100, float("inf")).otherwise(F.col("o_totalprice")).alias("infinite"),
    )
    out = ST.encoded_bounds(df, ("dataset",))
    return out.select(
        "dataset",
        "column",
        "kind",
        "value_count",
        F.hex("lower").alias("lower_hex"),
        F.hex("upper").alias("upper_hex"),
        "has_bound",
        "exact",
    )


def _double_hex(number: str) -> str:
    """Little-endian hex text of the bits of a positive double."""
    power = f"floor(log2({number}))"
    bits = f"((cast({power} as bigint) + 1023) * 4503599627370496 + cast(({number} / pow(2, {power}) - 1) * 4503599627370496 as bigint))"
    return _le_hex(bits, 8)


def _a03_geometry_sql() -> str:
    live = "case when geom_state = 'polygon' then {} end"
    x0, y0, x1, y1 = (live.format(c) for c in ("x0", "y0", "x0 + w", "y0 + h"))
    return (
        "select part_key, 'attr' as \"column\", 'double' as kind, count(*) as value_count, cast(0 as bigint) as null_count,"
        f" {_double_hex('min(attr)')} as lower, {_double_hex('max(attr)')} as upper, true as has_bound, true as exact"
        " from $F2 group by part_key union all"
        " select part_key, 'geom', 'geometry', count(*), cast(count_if(geom_state = 'null') as bigint),"
        f" {_double_hex(f'min({x0})')} || {_double_hex(f'min({y0})')}, {_double_hex(f'max({x1})')} || {_double_hex(f'max({y1})')}, true, true"
        " from $F2 group by part_key"
    )


@query("a03_encoded_geometry_bounds", _a03_geometry_sql())
def a03_geometry(spark, sf):
    out = ST.encoded_bounds(C.boxes_with_bbox(spark, sf).select("part_key", "attr", "geom", "xmin", "ymin", "xmax", "ymax"), ("part_key",))
    return out.withColumn("lower", F.hex("lower")).withColumn("upper", F.hex("upper"))


_CORNERS = (
    f"(select b.part_key, case when c.i in (0, 3) then xmin else xmax end as x, case when c.i in (0, 1) then ymin else ymax end as y"
    f" from {C.LIVE_BOXES} b cross join (values (0), (1), (2), (3)) c(i))"
)
_EXTENT = (
    "round(min(lon), 7) as min_lon, round(min(lat), 7) as min_lat, round(max(lon), 7) as max_lon, round(max(lat), 7) as max_lat"
)


def _rounded(df):
    sides = ("min_lon", "min_lat", "max_lon", "max_lat")
    return df.select(*[c for c in df.columns if c not in sides], *[F.round(c, 7).alias(c) for c in sides])


@query("a04_wgs84_extent", f"select part_key, {_EXTENT} from {C.wgs84_sql(_CORNERS)} group by part_key")
def a04(spark, sf):
    return _rounded(ST.wgs84_extent(C.boxes(spark, sf), C.EPSG, ("part_key",)))


@query("a04_wgs84_extent_lines", f"select {_EXTENT} from {C.wgs84_sql('$F3')}")
def a04_lines(spark, sf):
    return _rounded(ST.wgs84_extent(C.lines(spark, sf), C.EPSG))


_SQUARES = (
    f"(select cast(cast(floor(xmin / 10000) as bigint) as varchar(20)) || '_' || cast(cast(floor(ymin / 10000) as bigint) as varchar(20)) as file,"
    f" cast(floor(xmin / 10000) + floor(ymin / 10000) as bigint) % 13 <> 0 as has_bound,"
    f" min(xmin) as xmin, min(ymin) as ymin, max(xmax) as xmax, max(ymax) as ymax from {C.LIVE_BOXES} group by 1, 2)"
)


@query(
    "j05_prune_files",
    "select p.id as box, cast(count_if(not f.has_bound or (f.xmin <= p.x + 1500 and f.xmax >= p.x - 1500 and f.ymin <= p.y + 1500"
    f" and f.ymax >= p.y - 1500)) as bigint) as scanned, count(*) as total from $F1 p cross join {_SQUARES} f group by p.id",
)
def j05(spark, sf):
    df = OG.drop_null_or_empty_geometry(C.boxes_with_bbox(spark, sf))
    fx, fy = (F.floor(F.col(c) / 10000).cast("bigint") for c in ("xmin", "ymin"))
    name = F.concat(fx.cast("string"), F.lit("_"), fy.cast("string"))
    files = ST.geometry_bounds(df.select(name.alias("file"), ((fx + fy) % 13).alias("m"), "xmin", "ymin", "xmax", "ymax"), ("file", "m"))
    path = scratch_path(spark, "bounds")
    files.withColumn("has_bound", F.col("m") != 0).write.parquet(path)
    files = spark.read.parquet(path)
    x, y = F.col("x"), F.col("y")
    around = fixture(spark, sf, "F1").select(
        "id", (x - 1500).alias("xmin"), (y - 1500).alias("ymin"), (x + 1500).alias("xmax"), (y + 1500).alias("ymax")
    )
    return J.prune_files(files, around)


@query(
    "j05_prune_non_finite",
    "select p.id as box, cast(count_if(f.m % 5 = 1 or (f.xmin <= p.x + 1500 and f.xmax >= p.x - 1500 and f.ymin <= p.y + 1500"
    " and f.ymax >= p.y - 1500)) as bigint) as scanned, count(*) as total from $F1 p cross join"
    " (select floor(xmin / 10000) as fx, floor(ymin / 10000) as fy, cast(floor(xmin / 10000) + floor(ymin / 10000) as bigint) as m,"
    f" min(xmin) as xmin, min(ymin) as ymin, max(xmax) as xmax, max(ymax) as ymax from {C.LIVE_BOXES} group by all) f group by p.id",
)
def j05_non_finite(spark, sf):
    """A fifth of the files has a bound that is NaN or infinite: no box can rule them out."""
    df = OG.drop_null_or_empty_geometry(C.boxes_with_bbox(spark, sf))
    fx, fy = (F.floor(F.col(c) / 10000).cast("bigint") for c in ("xmin", "ymin"))
    df = df.withColumn("file", F.concat(fx.cast("string"), F.lit("_"), fy.cast("string"))).withColumn("m", fx + fy)
    odd = F.when(F.col("id") % 2 == 0, F.lit(float("nan"))).otherwise(F.lit(float("inf")))
    df = df.withColumn("xmax", F.when(F.col("m") % 5 == 1, odd).otherwise(F.col("xmax")))
    x, y = F.col("x"), F.col("y")
    around = fixture(spark, sf, "F1").select(
        "id", (x - 1500).alias("xmin"), (y - 1500).alias("ymin"), (x + 1500).alias("xmax"), (y + 1500).alias("ymax")
    )
    return J.prune_files(ST.geometry_bounds(df, ("file",)), around)


@query(
    "a13_file_stats",
    "select part_key, count(*) as rows, min(xmin) as xmin, min(ymin) as ymin, max(xmax) as xmax, max(ymax) as ymax,"
    f" true as has_bound, true as sized from {C.LIVE_BOXES} group by part_key",
)
def a13(spark, sf):
    path = scratch_path(spark, "file-stats")
    df = OG.drop_null_or_empty_geometry(C.boxes_with_bbox(spark, sf))
    D.write_vector_dataset(df, path, ("part_key",), epsg=C.EPSG)
    stats = ST.file_stats(spark, path)
    key = F.url_decode(F.url_decode(F.regexp_extract("file", "part_key=([^/]+)/", 1)))
    return stats.groupBy(key.alias("part_key")).agg(
        F.sum("rows").alias("rows"),
        F.min("xmin").alias("xmin"),
        F.min("ymin").alias("ymin"),
        F.max("xmax").alias("xmax"),
        F.max("ymax").alias("ymax"),
        F.bool_and("has_bound").alias("has_bound"),
        F.bool_and(F.col("bytes") > 0).alias("sized"),
    )


def cells(spark, sf):
    return fixture(spark, sf, "F7").select(F.lit("grid").alias("layer"), "col", F.col("cell_row").alias("row"), "value")


@query(
    "r01_to_tiles",
    "select t.tx, t.ty, cast(t.n as integer) as at, f.value as value from (select distinct cast(col // 16 as bigint) tx, cast(cell_row // 16 as bigint) ty, k.n"
    " from $F7, range(256) k(n)) t left join $F7 f on f.col = t.tx * 16 + t.n % 16 and f.cell_row = t.ty * 16 + t.n // 16",
)
def r01(spark, sf):
    tiles = R.to_tiles(cells(spark, sf), 16)
    return tiles.select("tx", "ty", F.posexplode("cells").alias("at", "value"))


@query(
    "r02_overviews",
    "with recursive p(level, col, cell_row, value) as (select 0, col, cell_row, value from $F7 union all"
    " select level + 1, col // 2, cell_row // 2, value from p where col % 2 = 0 and cell_row % 2 = 0"
    " and level < (select ceil(log2(greatest(max(col) + 1, max(cell_row) + 1) / 16.0)) from $F7))"
    " select level, cast(col as bigint) as col, cast(cell_row as bigint) as \"row\", value from p where level > 0",
)
def r02(spark, sf):
    return R.overviews(cells(spark, sf), size=16).drop("layer")


@query(
    "r02_overviews_layers",
    "with recursive l as (select case when col < 16 and cell_row < 16 then 'small' when col < 48 and cell_row < 40 then 'middle' else 'wide' end"
    " as layer, col, cell_row, value from $F7),"
    " d as (select layer, greatest(ceil(log2(greatest(max(col) + 1, max(cell_row) + 1) / 16.0)), 0) as depth from l group by layer),"
    " p(layer, level, col, cell_row, value) as (select layer, 0, col, cell_row, value from l union all"
    " select p.layer, level + 1, col // 2, cell_row // 2, value from p join d using (layer)"
    " where col % 2 = 0 and cell_row % 2 = 0 and level < depth)"
    " select layer, level, cast(col as bigint) as col, cast(cell_row as bigint) as \"row\", value from p where level > 0",
)
def r02_layers(spark, sf):
    """Three layers of different size; each has its own depth."""
    small, middle = (F.col("col") < 16) & (F.col("row") < 16), (F.col("col") < 48) & (F.col("row") < 40)
    layer = F.when(small, "small").when(middle, "middle").otherwise("wide")
    return R.overviews(cells(spark, sf).withColumn("layer", layer), size=16)


@query(
    "r03_raster_extent",
    "select id, round(min(coalesce(lon, -4.58)), 7) as min_lon, round(min(coalesce(lat, 39.88)), 7) as min_lat,"
    " round(max(coalesce(lon, -3.05)), 7) as max_lon, round(max(coalesce(lat, 41.17)), 7) as max_lat from"
    " (select id, case when id % 11 = 0 then null else lon end as lon, case when id % 11 = 0 then null else lat end as lat from "
    + C.wgs84_sql(
        "(select id, case when c.i in (0, 3) then x else x + 5.0 * (100 + id % 50) end as x,"
        " case when c.i in (0, 1) then y else y - 5.0 * (80 + id % 40) end as y from $F1 cross join (values (0), (1), (2), (3)) c(i))"
    )
    + ") group by id",
)
def r03(spark, sf):
    broken = F.col("id") % 11 == 0
    rasters = fixture(spark, sf, "F1").select(
        "id",
        F.when(~broken, F.col("x")).alias("origin_x"),
        F.col("y").alias("origin_y"),
        F.lit(5.0).alias("pixel_x"),
        F.lit(-5.0).alias("pixel_y"),
        (F.lit(100) + F.col("id") % 50).alias("width"),
        (F.lit(80) + F.col("id") % 40).alias("height"),
    )
    return _rounded(R.raster_extent(rasters, C.EPSG)).select("id", "min_lon", "min_lat", "max_lon", "max_lat")
