"""Dataset index, packages, inventories and their facets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.functions.guards import region_default
from geoloom.functions.geometry import bbox_polygon_wkb
from geoloom.operators.layout import with_global_position
from geoloom.operators.windows import outcome

# Fixed values of the published index rows.
INDEX_FIELDS = (
    "id string, collection string, geometry binary,"
    " bbox struct<xmin:double,ymin:double,xmax:double,ymax:double>, datetime timestamp,"
    " properties string, assets string, stac_version string, type string"
)
STAC_VERSION = "1.1.0"
SEMANTICS_SPEC = "Open Semantic Interchange"
ICEBERG_MEDIA = "application/x-iceberg"
PARQUET_MEDIA = "application/vnd.apache.parquet"
RAQUET_MEDIA = "application/x-raquet"
COG_MEDIA = "image/tiff; application=geotiff; profile=cloud-optimized"
# The explorer calls a tabular dataset a table.
KIND_ALIASES = {"table": "tabular"}


def _kind(kind: str) -> str:
    return KIND_ALIASES.get(kind, kind)


# --- search and selection ----------------------------------------------------------------------------


def search_catalog(index: DataFrame, kind: str = "all", term: str = "") -> DataFrame:
    """Rows of a kind whose id contains the term; the term is trimmed and case does not count."""
    term = term.lower().strip()
    out = index if kind == "all" else index.filter(F.col("kind") == _kind(kind))
    return out.filter(F.lower("id").contains(term)) if term else out


def select_packages(packages: DataFrame, fmt: str) -> DataFrame:
    """Packages with any resource of the format."""
    return packages.filter(F.coalesce(F.exists("resources", lambda r: r.format == fmt), F.lit(False)))


def first_resource(packages: DataFrame, fmt: str) -> DataFrame:
    """Adds ``url``: the first resource of the format that has one, else null."""
    usable = F.filter("resources", lambda r: (r.format == fmt) & (r.url != ""))
    return packages.withColumn("url", F.get(usable, 0).url)


def size_tier(inventory: DataFrame, lo: int, hi: int, size: str = "count") -> DataFrame:
    """Layers with ``lo <= count <= hi``, smallest first."""
    return inventory.filter(F.col(size).between(lo, hi)).orderBy(size)


def exclude_sources(records: DataFrame, hosts: list[str], url: str = "url") -> DataFrame:
    """Records that do not point at another publisher's host; a record without a host stays."""
    host = F.lower(F.try_parse_url(F.col(url), F.lit("HOST")))
    return records.filter(~F.coalesce(host.isin([h.lower() for h in hosts]), F.lit(False)))


# --- facets and tallies -------------------------------------------------------------------------------


def index_facets(index: DataFrame) -> DataFrame:
    """Datasets per kind, and the total as kind ``all``."""
    known = index.withColumn("kind", F.when(F.col("kind") == "table", "tabular").otherwise(F.col("kind")))
    counts = known.rollup("kind").agg(F.count(F.lit(1)).alias("n"), F.grouping("kind").alias("_all"))
    return counts.select(F.when(F.col("_all") == 1, "all").otherwise(F.col("kind")).alias("kind"), "n")


def format_facets(packages: DataFrame) -> DataFrame:
    """(facet, value, datasets) per resource format, publisher and group, in one pass."""

    def entry(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("facet"), value.alias("value"))

    formats = F.transform(F.array_distinct(F.transform("resources", lambda r: r.format)), lambda v: entry("format", v))
    groups = F.transform(F.array_distinct("groups"), lambda v: entry("group", v))
    empty = F.array().cast("array<struct<facet:string,value:string>>")
    entries = F.concat(F.coalesce(formats, empty), F.array(entry("publisher", F.col("publisher"))), F.coalesce(groups, empty))
    return (
        packages.select("id", F.inline(entries))
        .filter(F.col("value").isNotNull())
        .groupBy("facet", "value")
        .agg(F.countDistinct("id").alias("datasets"))
    )


def workspace_profile(inventory: DataFrame, size: str = "count") -> DataFrame:
    """Layers and features per workspace, and the grand total as workspace null."""
    return inventory.rollup("ws").agg(F.count(F.lit(1)).alias("layers"), F.sum(size).alias("features"))


# Upper ends of the size buckets and their labels.
SIZE_BUCKETS = ((1_000, "<=1k"), (10_000, "1k-10k"), (100_000, "10k-100k"), (1_000_000, "100k-1M"))
LAST_BUCKET = ">1M"


def size_bucket(size: Column) -> Column:
    out = F.lit(LAST_BUCKET)
    for limit, label in reversed(SIZE_BUCKETS):
        out = F.when(size <= limit, F.lit(label)).otherwise(out)
    return out


def count_histogram(inventory: DataFrame, size: str = "count") -> DataFrame:
    return inventory.groupBy(size_bucket(F.col(size)).alias("bucket")).agg(F.count(F.lit(1)).alias("layers"))


def status_tally(results: DataFrame) -> DataFrame:
    """ok, skip, fail and the success rate (skipped outputs are good ones) of a run."""
    kind = outcome(F.col("status"))
    tally = results.agg(
        F.count_if(kind == "ok").alias("ok"),
        F.count_if(kind == "skip").alias("skip"),
        F.count_if(kind == "fail").alias("fail"),
        F.count(F.lit(1)).alias("total"),
    )
    good = (F.col("ok") + F.col("skip")).cast("double")
    return tally.withColumn("success_rate", F.when(F.col("total") > 0, good / F.nullif(F.col("total"), F.lit(0))))


def first_failures(results: DataFrame, order: str, n: int = 30) -> DataFrame:
    """The report's list of the first failures."""
    return results.filter(outcome(F.col("status")) == "fail").orderBy(order).limit(n)


def namespace_listing(tables: DataFrame, page_size: int = 1000) -> DataFrame:
    """(namespace, page, tables, identifiers): table names as JSON identifier lists in name order.

    The listing is paged, as catalog servers page it, so a namespace that has most of the tables is not
    collected into one row.
    """
    placed = with_global_position(tables.select("namespace", "name").distinct(), ["namespace", "name"])
    starts = placed.groupBy("namespace").agg(F.min("position").alias("_start"))
    page = F.floor((F.col("position") - F.col("_start")) / page_size).alias("page")
    entry = F.struct(F.array("namespace").alias("namespace"), F.col("name"))
    return (
        placed.join(starts, "namespace")
        .groupBy("namespace", page)
        .agg(F.sort_array(F.collect_list(F.struct("name", entry.alias("entry")))).alias("_rows"))
        .select(
            "namespace",
            "page",
            F.size("_rows").alias("tables"),
            F.to_json(F.transform("_rows", lambda r: r.entry)).alias("identifiers"),
        )
    )


# --- index rows ---------------------------------------------------------------------------------------


def index_properties(
    title: Column, theme: Column, rows: Column, kind: Column, crs: str, provider: str, license: str
) -> Column:
    """JSON properties of an index row. ``rows`` is written as null for a raster."""
    semantics = F.struct(
        F.lit(SEMANTICS_SPEC).alias("spec"),
        title.alias("label"),
        title.alias("describes"),
        title.alias("answers"),
        F.lit("").alias("unit"),
    )
    common = [
        title.alias("title"),
        title.alias("description"),
        theme.alias("theme"),
        F.lit(crs).alias("crs"),
        F.lit(True).alias("materialized"),
        F.lit(provider).alias("provider"),
        F.lit(license).alias("license"),
        F.when(kind != "raster", rows).alias("rows"),
        kind.alias("kind"),
        semantics.alias("semantics"),
    ]
    keep = {"ignoreNullFields": "false"}
    spatial = F.to_json(F.struct(*common), keep)
    plain = F.to_json(F.struct(*common, F.lit(False).alias("geospatial")), keep)
    return F.when(kind == "tabular", plain).otherwise(spatial)


def table_properties(title: Column, theme: Column, kind: Column, crs: str, provider: str, license: str) -> Column:
    """JSON properties of one published table; its semantics are a JSON text inside the JSON."""
    semantics = F.to_json(F.struct(title.alias("label"), title.alias("describes"), title.alias("answers"), F.lit("").alias("unit")))
    common = [
        theme.alias("theme"),
        title.alias("title"),
        semantics.alias("semantics"),
        F.lit(provider).alias("provider"),
        F.lit(license).alias("license"),
    ]
    spatial = F.to_json(F.struct(*common, F.lit(crs).alias("crs")))
    plain = F.to_json(F.struct(*common, F.lit("false").alias("geospatial")))
    return F.when(kind == "tabular", plain).otherwise(spatial)


def _asset(href: Column, media: str, title: str) -> Column:
    return F.struct(
        href.alias("href"), F.lit(media).alias("type"), F.array(F.lit("data")).alias("roles"), F.lit(title).alias("title")
    )


def index_assets(kind: Column, identifier: Column, base: str, crs: str) -> Column:
    """JSON assets by kind: table and remote file for vector and tabular, one image for a raster."""

    def at(folder: str, ending: str) -> Column:
        return F.concat(F.lit(f"{base}/{folder}/"), identifier, F.lit(ending))

    def pair(prefix: str, folder: str, table_title: str, file_title: str) -> Column:
        return F.to_json(
            F.struct(
                _asset(F.concat(F.lit(prefix), identifier), ICEBERG_MEDIA, table_title).alias("data"),
                _asset(at(folder, ".parquet"), PARQUET_MEDIA, file_title).alias("data_parquet"),
            )
        )

    # Asset titles.
    vector = pair(
        "v3.",
        "data/parquet",
        f"Iceberg v3 (native geometry, {crs}) — iceberg_scan / ATTACH",
        f"Remote GeoParquet ({crs}) — read_parquet in place",
    )
    tabular = pair(
        "tab.",
        "data/parquet_tab",
        "Iceberg table (tabular, no geometry) — ATTACH",
        "Remote Parquet — read_parquet in place",
    )
    raster_title = f"Cloud-Optimized GeoTIFF ({crs}) — /vsicurl/ , rasterio, GDAL"
    raster = F.to_json(F.struct(_asset(at("data/cog", ".tif"), COG_MEDIA, raster_title).alias("data")))
    return F.when(kind == "vector", vector).when(kind == "tabular", tabular).otherwise(raster)


def index_rows(
    entries: DataFrame, collection: str, base: str, crs: str, provider: str, license: str
) -> DataFrame:
    """Manifest entries (id, kind, title, theme, rows, bbox) as rows of the dataset index."""
    box = region_default(F.col("bbox"))
    kind = F.col("kind")
    return entries.withColumn("bbox", box).select(
        "id",
        F.lit(collection).alias("collection"),
        bbox_polygon_wkb(*[F.col(f"bbox.{c}") for c in ("xmin", "ymin", "xmax", "ymax")]).alias("geometry"),
        "bbox",
        F.lit(None).cast("timestamp").alias("datetime"),
        index_properties(F.col("title"), F.col("theme"), F.col("rows"), kind, crs, provider, license).alias("properties"),
        index_assets(kind, F.col("id"), base, crs).alias("assets"),
        F.lit(STAC_VERSION).alias("stac_version"),
        F.lit("Feature").alias("type"),
    )


def collection_extensions(
    kind: Column,
    identifier: Column,
    table: Column,
    snapshot: Column,
    href: Column,
    source: Column,
    base: str,
    repo: str,
    prefix: str = "",
) -> Column:
    """JSON that a collection document gains, by kind. All hrefs are absolute.

    ``prefix`` is the namespace of the two keys that are the catalog's own, ``geospatial`` and ``managed``.
    """
    link = F.array(F.struct(F.lit("via").alias("rel"), source.alias("href"), F.lit("text/html").alias("type")))
    common = [
        F.concat(F.lit(f"{repo}/edit/main/"), identifier, F.lit("/collection.json")).alias("git:edit_url"),
        link.alias("links"),
    ]

    def data_role(*roles: str) -> Column:
        return F.array(*[F.lit(r) for r in roles]).alias("roles")

    def table_fields(prefix: str, *extra: Column) -> Column:
        asset = F.struct(
            F.concat(F.lit(f"{base}/data/{prefix}/"), table).alias("href"),
            F.lit(ICEBERG_MEDIA).alias("type"),
            data_role("data"),
        )
        return F.to_json(
            F.struct(
                F.lit("rest").alias("iceberg:catalog_type"),
                F.lit(base).alias("iceberg:catalog_uri"),
                F.concat(F.lit(f"{prefix}."), table).alias("iceberg:table_id"),
                snapshot.alias("iceberg:current_snapshot_id"),
                F.struct(asset.alias("iceberg")).alias("assets"),
                *extra,
                *common,
            )
        )

    raster = F.struct(
        href.alias("href"),
        F.lit(RAQUET_MEDIA).alias("type"),
        data_role("data"),
        F.lit("Raquet raster — read_raquet()").alias("title"),
    )
    remote = F.struct(
        href.alias("href"), F.lit(PARQUET_MEDIA).alias("type"), data_role("data", "external"), F.lit(False).alias(f"{prefix}managed")
    )
    return (
        F.when(kind == "vector", table_fields("v3"))
        .when(kind == "non-geo", table_fields("tab", F.lit(False).alias(f"{prefix}geospatial")))
        .when(kind == "raster", F.to_json(F.struct(F.struct(raster.alias("data")).alias("assets"), *common)))
        .when(kind == "remote", F.to_json(F.struct(F.struct(remote.alias("data")).alias("assets"), *common)))
    )
