"""Documents of a published catalog, one row (key, body) each.

Three families: the description of a table as its readers expect it, the pages that a catalog client walks from the
configuration to a table, and the documents of a static catalog of collections. All are made by grouped aggregation
over the columns, files and datasets of the whole catalog at once; ``write_documents`` puts each into a file of its own.

Whatever lists members is paged: a listing of any length is never one row. The first page has the plain key, page k
the key with ``.page-<k>`` behind it, and a page names the next one if there is one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.operators.catalog import ICEBERG_MEDIA, PARQUET_MEDIA, RAQUET_MEDIA, STAC_VERSION, namespace_listing
from geoloom.operators.layout import with_global_position

# Fixed value: property that holds the name mapping.
NAME_MAPPING = "schema.name-mapping.default"


def _json(*members: Column) -> Column:
    """A JSON object; members that are null are left out."""
    return F.to_json(F.struct(*members))


def _with_member(body: Column, name: str, document: Column) -> Column:
    """``body``, a JSON object that is not empty, with one more member whose value is JSON text already."""
    return F.concat(F.substr(body, F.lit(1), F.length(body) - 1), F.lit(f',"{name}":'), document, F.lit("}"))


# --- tables ---------------------------------------------------------------------------------------------


def table_documents(tables: DataFrame, columns: DataFrame, files: DataFrame) -> DataFrame:
    """(key, body): the description of every table.

    ``tables``: key, location, format_version, properties (JSON object of texts or null). ``columns``: key, id, name,
    type, doc, of the logical columns. ``files``: key, file, bytes, rows. A table without files has no snapshot. The
    number of a snapshot follows from what it holds, so that the same table gives the same document again.
    """
    field = F.struct("id", "name", F.lit(False).alias("required"), "type", F.coalesce("doc", F.col("name")).alias("doc"))
    fields = columns.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("id", field.alias("f")))).alias("_f"), F.max("id").alias("_last"))
    totals = files.groupBy("key").agg(
        F.count(F.lit(1)).alias("_files"), F.sum("bytes").alias("_bytes"), F.sum("rows").alias("_rows"), F.bit_xor(F.xxhash64("file", "bytes", "rows")).alias("_held")
    )
    every = tables.join(fields, "key", "left").join(totals, "key", "left")
    listed = F.transform(F.coalesce("_f", F.array().cast(fields.schema["_f"].dataType)), lambda c: c.f)
    mapping = F.to_json(F.transform(listed, lambda f: F.struct(f["id"].alias("field-id"), F.array(f["name"]).alias("names"))))
    properties = F.map_concat(
        F.coalesce(F.from_json("properties", "map<string,string>"), F.create_map().cast("map<string,string>")), F.create_map(F.lit(NAME_MAPPING), mapping)
    )
    number = F.xxhash64("key", "_held").bitwiseAND((1 << 63) - 1)
    summary = F.create_map(
        F.lit("operation"), F.lit("append"),
        F.lit("total-records"), F.col("_rows").cast("string"),
        F.lit("total-data-files"), F.col("_files").cast("string"),
        F.lit("total-files-size"), F.col("_bytes").cast("string"),
    )
    snapshot = F.struct(number.alias("snapshot-id"), F.lit(0).alias("schema-id"), summary.alias("summary"))
    snapshots = F.when(F.col("_files").isNotNull(), F.array(snapshot)).otherwise(F.array().cast("array<struct<`snapshot-id`:bigint,`schema-id`:int,summary:map<string,string>>>"))
    body = _json(
        F.col("format_version").alias("format-version"),
        F.col("location"),
        F.coalesce("_last", F.lit(0)).alias("last-column-id"),
        F.lit(0).alias("current-schema-id"),
        F.array(F.struct(F.lit("struct").alias("type"), F.lit(0).alias("schema-id"), listed.alias("fields"))).alias("schemas"),
        properties.alias("properties"),
        F.when(F.col("_files").isNotNull(), number).otherwise(F.lit(-1)).alias("current-snapshot-id"),
        snapshots.alias("snapshots"),
    )
    return every.select("key", body.alias("body"))


# --- what a catalog client walks ------------------------------------------------------------------------


def _page_key(plain: Column, page: Column) -> Column:
    return F.when(page == 0, plain).otherwise(F.concat(plain, F.lit(".page-"), page.cast("string")))


def _next(page: Column, last: Column) -> Column:
    return F.when(page < last, F.concat(F.lit("page-"), (page + 1).cast("string"))).alias("next-page-token")


def surface_documents(tables: DataFrame, base: str, prefix: str, page_size: int = 1000) -> DataFrame:
    """(key, body) of every request a client makes: configuration, namespaces, their tables, each table.

    ``tables``: namespace, name, key, body; a name is in its namespace once.
    """
    root = f"v1/{prefix}/namespaces"
    of = F.concat(F.lit(f"{root}/"), "namespace")
    settings = F.concat(F.lit('{"defaults":{},"overrides":'), _json(F.lit(prefix).alias("prefix")), F.lit("}"))
    config = tables.sparkSession.range(1).select(F.lit("v1/config").alias("key"), settings.alias("body"))

    names = tables.select("namespace").distinct()
    placed = with_global_position(names, ["namespace"]).withColumn("page", F.floor(F.col("position") / page_size))
    grouped = placed.groupBy("page").agg(F.transform(F.sort_array(F.collect_list("namespace")), lambda n: F.array(n)).alias("namespaces"))
    last = F.floor((F.lit(names.count()) - 1) / page_size)
    spaces = grouped.select(_page_key(F.lit(root), F.col("page")).alias("key"), _json("namespaces", _next(F.col("page"), last)).alias("body"))
    each = names.select(of.alias("key"), F.concat(F.lit('{"namespace":'), F.to_json(F.array("namespace")), F.lit(',"properties":{}}')).alias("body"))

    listing = namespace_listing(tables, page_size)
    ends = listing.groupBy("namespace").agg(F.max("page").alias("_last"))
    head = _json(F.from_json("identifiers", "array<struct<namespace:array<string>,name:string>>").alias("identifiers"), _next(F.col("page"), F.col("_last")))
    lists = listing.join(ends, "namespace").select(_page_key(F.concat(of, F.lit("/tables")), F.col("page")).alias("key"), head.alias("body"))

    place = F.concat(F.lit(f"{base}/data/"), F.col("key"), F.lit("/metadata/v1.metadata.json"))
    loaded = _with_member(_with_member(_json(place.alias("metadata-location")), "metadata", F.col("body")), "config", F.lit("{}"))
    found = tables.select(F.concat(of, F.lit("/tables/"), "name").alias("key"), loaded.alias("body"))
    return config.unionByName(spaces).unionByName(each).unionByName(lists).unionByName(found)


# --- collections ----------------------------------------------------------------------------------------


def collection_documents(datasets: DataFrame, base: str, repo: str, extension: str, prefix: str = "") -> DataFrame:
    """(key, body): the collection document of every dataset, complete with links, extent and assets.

    ``datasets``: id, title, description, license, kind (vector, non-geo, raster, remote), bbox struct, table,
    snapshot, href, source. ``extension`` is the address of the table extension; ``prefix`` the namespace of the two
    keys that are the catalog's own. Members that do not belong to a kind, or have no value, are left out.
    """
    kind, table = F.col("kind"), F.col("kind").isin("vector", "non-geo")
    space = F.when(kind == "vector", "v3").otherwise("tab")

    def asset(when: Column, href: Column, media: str, title: str | None = None, extra: tuple[Column, ...] = (), roles: tuple[str, ...] = ("data",)) -> Column:
        own = [href.alias("href"), F.lit(media).alias("type"), F.array(*map(F.lit, roles)).alias("roles"), F.lit(title).cast("string").alias("title"), *extra]
        return F.when(when, F.struct(*own))

    file = F.concat(F.lit(f"{base}/"), "id", F.lit("/"), "id", F.lit(".parquet"))
    assets = F.struct(
        asset(table, F.concat(F.lit(f"{base}/data/"), space, F.lit("/"), "table"), ICEBERG_MEDIA).alias("iceberg"),
        F.when(kind == "remote", F.to_json(asset(kind == "remote", F.col("href"), PARQUET_MEDIA, extra=(F.lit(False).alias(f"{prefix}managed"),), roles=("data", "external"))))
        .when(kind == "raster", F.to_json(asset(kind == "raster", F.col("href"), RAQUET_MEDIA, "Raquet raster — read_raquet()")))
        .otherwise(F.to_json(asset(table, file, PARQUET_MEDIA)))
        .alias("data"),
    )
    links = F.filter(
        F.array(
            F.struct(F.lit("root").alias("rel"), F.lit(f"{base}/catalog.json").alias("href"), F.lit("application/json").alias("type")),
            F.struct(F.lit("self").alias("rel"), F.concat(F.lit(f"{base}/"), "id", F.lit("/collection.json")).alias("href"), F.lit("application/json").alias("type")),
            F.struct(F.lit("via").alias("rel"), F.col("source").alias("href"), F.lit("text/html").alias("type")),
        ),
        lambda x: x.href.isNotNull(),
    )
    corners = F.array(*[F.col(f"bbox.{c}") for c in ("xmin", "ymin", "xmax", "ymax")])
    extent = F.struct(
        F.struct(F.array(corners).alias("bbox")).alias("spatial"),
        F.struct(F.array(F.array(F.lit(None).cast("string"), F.lit(None).cast("string"))).alias("interval")).alias("temporal"),
    )
    body = _json(
        F.lit("Collection").alias("type"),
        F.lit(STAC_VERSION).alias("stac_version"),
        F.when(table, F.array(F.lit(extension))).alias("stac_extensions"),
        "id",
        "title",
        F.coalesce("description", "title").alias("description"),
        F.coalesce("license", F.lit("other")).alias("license"),
        F.when(F.col("bbox").isNotNull(), extent).alias("extent"),
        F.when(table, "rest").alias("iceberg:catalog_type"),
        F.when(table, base).alias("iceberg:catalog_uri"),
        F.when(table, F.concat(space, F.lit("."), "table")).alias("iceberg:table_id"),
        F.when(table, F.col("snapshot")).alias("iceberg:current_snapshot_id"),
        F.when(kind == "non-geo", F.lit(False)).alias(f"{prefix}geospatial"),
        F.concat(F.lit(f"{repo}/edit/main/"), "id", F.lit("/collection.json")).alias("git:edit_url"),
        links.alias("links"),
    )
    parts = datasets.withColumns({"_body": body, "_assets": assets})
    tables = F.to_json(F.struct(F.col("_assets.iceberg").alias("iceberg")))
    both = F.when(F.col("_assets.iceberg").isNotNull(), _with_member(tables, "data", F.col("_assets.data"))).otherwise(
        F.concat(F.lit('{"data":'), F.col("_assets.data"), F.lit("}"))
    )
    return parts.select(F.concat("id", F.lit("/collection.json")).alias("key"), _with_member(F.col("_body"), "assets", both).alias("body"))


def catalog_documents(datasets: DataFrame, title: str, description: str, base: str, repo: str, extension: str, page_size: int = 1000) -> DataFrame:
    """(key, body): the root document and the catalog pages that list all datasets (id, title) in order of their ids.

    The root names the pages, each page at most ``page_size`` datasets. ``extension``: address of the extension that
    the repository members belong to.
    """
    placed = with_global_position(datasets.select("id", "title"), ["id"]).withColumn("page", F.floor(F.col("position") / page_size))
    link = lambda rel, href, name: F.struct(F.lit(rel).alias("rel"), href.alias("href"), F.lit("application/json").alias("type"), name.alias("title"))
    child = link("child", F.concat(F.lit(f"{base}/"), "id", F.lit("/collection.json")), F.col("title"))
    grouped = placed.groupBy("page").agg(F.transform(F.sort_array(F.collect_list(F.struct("id", child.alias("l")))), lambda x: x.l).alias("links"))
    own = F.concat(F.lit("catalog-"), F.col("page").cast("string"))
    pages = grouped.select(
        F.concat(own, F.lit(".json")).alias("key"),
        _json(F.lit("Catalog").alias("type"), F.lit(STAC_VERSION).alias("stac_version"), own.alias("id"), F.lit(description).alias("description"), "links").alias("body"),
    )
    page = link("child", F.concat(F.lit(f"{base}/"), F.col("key")), F.lit(None).cast("string"))
    listed = pages.agg(F.transform(F.sort_array(F.collect_list(F.struct(F.length("key").alias("n"), "key", page.alias("l")))), lambda x: x.l).alias("_children"))
    more = F.array(
        *[
            F.struct(F.lit(rel).alias("rel"), F.lit(href).alias("href"), F.lit(kind).alias("type"), F.lit(None).cast("string").alias("title"))
            for rel, href, kind in (("vcs", repo, "text/html"), ("issues", f"{repo}/issues", "text/html"), ("monitor", f"{repo}/commits/main.atom", "application/atom+xml"))
        ]
    )
    root = listed.select(
        F.lit("catalog.json").alias("key"),
        _json(
            F.lit("Catalog").alias("type"),
            F.lit(STAC_VERSION).alias("stac_version"),
            F.array(F.lit(extension)).alias("stac_extensions"),
            F.lit("catalog").alias("id"),
            F.lit(title).alias("title"),
            F.lit(description).alias("description"),
            F.lit(repo).alias("git:repository"),
            F.lit("main").alias("git:ref"),
            F.lit("github").alias("git:provider"),
            F.concat("_children", more).alias("links"),
        ).alias("body"),
    )
    return root.unionByName(pages)


def write_documents(documents: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Every document in a text file of its own, below a folder that has its key as ``key=<key>``."""
    documents.select("key", F.col("body").alias("value")).write.mode(mode).partitionBy("key").text(path)
