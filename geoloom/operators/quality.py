"""Checks on records, layouts, geometries, migrations and outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.functions.geometry import checked_bbox
from geoloom.functions.guards import is_finite

# Fixed values of the record extension.
TABLE_PATTERN = "^[A-Za-z0-9_]+\\.[A-Za-z0-9_]+\\z"
ACCESS_METHODS = ("iceberg_scan", "attach", "read_parquet", "read_raquet", "download")
URI_PATTERN = "^[A-Za-z][A-Za-z0-9+.-]*:[^\\s<>\"{}|\\\\^`]+\\z"
PROVENANCE_TEXTS = ("source", "source_provider", "source_license", "processing", "processed_by", "processed")
PROVENANCE_REQUIRED = ("source", "processing")

# Smallest believable sizes in bytes.
MIN_SOURCE_BYTES = 5
MIN_PARQUET_BYTES = 200
MIN_RASTER_BYTES = 1000


def validate_records(df: DataFrame) -> DataFrame:
    """Adds ``violations``, the rules each record breaks. Every field is optional, unknown keys are allowed.

    Columns: ``iceberg_endpoint, iceberg_table, access, source_repo`` texts and ``provenance`` JSON text;
    columns that are absent count as not given.
    """
    have = set(df.columns)

    def field(name: str) -> Column:
        return F.col(name) if name in have else F.lit(None).cast("string")

    def rule(broken: Column, name: str) -> Column:
        return F.when(F.coalesce(broken, F.lit(False)), F.lit(name))

    # the document is parsed once per row: a column of its own that the rules share
    parsed = df.withColumn("_provenance", F.try_parse_json(field("provenance")))
    given, as_object = field("provenance").isNotNull(), F.col("_provenance")
    is_object = F.coalesce(F.schema_of_variant(as_object).startswith("OBJECT"), F.lit(False))
    rules = [
        rule(~field("iceberg_endpoint").rlike(URI_PATTERN), "iceberg_endpoint"),
        rule(~field("source_repo").rlike(URI_PATTERN), "source_repo"),
        rule(~field("iceberg_table").rlike(TABLE_PATTERN), "iceberg_table"),
        rule(~field("access").isin(*ACCESS_METHODS), "access"),
        rule(given & ~is_object, "provenance"),
    ]
    for name in PROVENANCE_TEXTS:
        kind = F.schema_of_variant(F.try_variant_get(as_object, f"$.{name}", "variant"))
        if name in PROVENANCE_REQUIRED:
            rules.append(rule(given & is_object & kind.isNull(), f"provenance.{name}"))
        rules.append(rule(given & is_object & (kind != "STRING"), f"provenance.{name}.type"))
    return parsed.withColumn("violations", F.array_compact(F.array(*rules))).drop("_provenance")


RECORD_TEXTS = ("iceberg_endpoint", "iceberg_table", "access", "source_repo")


def records_from_json(df: DataFrame, document: str, prefix: str = "") -> DataFrame:
    """The columns ``validate_records`` looks at, out of whole record documents.

    ``prefix`` is the namespace of the keys in the document. A value that is no text becomes its JSON text,
    or an empty text for null, so that it breaks the rule of its field; an absent key is a null.
    """
    parsed = F.col("_document")

    def member(name: str) -> Column:
        return F.try_variant_get(parsed, f'$["{prefix}{name}"]', "variant")

    def text(name: str) -> Column:
        value = member(name)
        kind = F.schema_of_variant(value)
        plain = F.when(kind == "STRING", F.try_variant_get(value, "$", "string")).otherwise(F.to_json(value))
        return F.when(kind == "VOID", "").otherwise(plain).alias(name)

    fields = [text(n) for n in RECORD_TEXTS]
    once = df.withColumn("_document", F.try_parse_json(F.col(document)))
    return once.select("*", *fields, F.to_json(member("provenance")).alias("provenance")).drop("_document")


LAYOUT_RULES = (
    "geometry_with_srid",
    "geometry_id_before_bbox",
    "ids_contiguous",
    "bbox_in_file_hidden",
    "stats_complete",
    "names_lower_case",
    "described",
    "names_unique",
)
BBOX = ("xmin", "ymin", "xmax", "ymax")


def audit_layout(columns: DataFrame) -> DataFrame:
    """(dataset, rule, ok) for every dataset and layout rule of a column table.

    ``columns`` has dataset, column, type, field_id, in_schema, has_stats, doc. One grouped pass; a dataset
    never has to be held together, everything is a mergeable count, min or max.
    """
    is_geom = F.upper("type").startswith("GEOMETRY")
    is_box = F.col("column").isin(*BBOX)
    logical = F.col("in_schema")
    n = F.count(F.lit(1))
    checks = {
        "geometry_with_srid": F.count_if(is_geom & F.col("type").rlike("(?i)srid:\\d+")) == 1,
        "geometry_id_before_bbox": F.coalesce(
            F.max(F.when(is_geom, F.col("field_id"))) < F.min(F.when(is_box, F.col("field_id"))), F.lit(False)
        ),
        "ids_contiguous": F.coalesce(
            (F.min("field_id") == 1) & (F.max("field_id") == n) & (F.countDistinct("field_id") == n), F.lit(False)
        ),
        "bbox_in_file_hidden": (F.count_if(is_box) == len(BBOX)) & (F.count_if(is_box & logical) == 0),
        "stats_complete": F.count_if(logical & ~F.coalesce("has_stats", F.lit(False))) == 0,
        "names_lower_case": F.count_if(F.col("column") != F.lower("column")) == 0,
        "described": F.count_if((F.coalesce("doc", F.lit("")) == "") | F.col("field_id").isNull()) == 0,
        "names_unique": F.countDistinct("column") == n,
    }
    wide = columns.groupBy("dataset").agg(*[checks[r].alias(r) for r in LAYOUT_RULES])
    pairs = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("ok")) for r in LAYOUT_RULES])
    return wide.select("dataset", F.inline(pairs))


def audit_geometries(df: DataFrame, geom: str = "geom", by: tuple[str, ...] = ()) -> DataFrame:
    """Counts of null, empty, damaged and non-finite geometries; all must be zero after the empty-geometry filter."""
    box = df.select(*by, F.col(geom).isNull().alias("_null"), checked_bbox(F.col(geom)).alias("_b"))
    infinite = F.lit(False)
    for c in BBOX:
        infinite = infinite | ~is_finite(F.col(f"_b.{c}"))
    return box.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if("_null").alias("null_geometries"),
        F.count_if(~F.col("_null") & F.col("_b.xmin").isNull() & ~F.col("_b.unreadable")).alias("empty_geometries"),
        F.count_if("_b.unreadable").alias("unreadable_geometries"),
        F.count_if(F.col("_b.xmin").isNotNull() & infinite).alias("non_finite_bbox"),
    )


def verify_migration(source: DataFrame, output: DataFrame, key: str = "id") -> DataFrame:
    """Checks of a migrated catalog, one row per source dataset.

    ``source``: id, kind, rows. ``output``: id, rows, href, table_id, geospatial.
    """
    out = output.select(key, F.col("rows").alias("_rows"), "href", "table_id", "geospatial")
    joined = source.join(out, key, "left")
    kind = F.col("kind")
    table = kind.isin("vector", "non-geo")
    counts = F.when(table, F.col("rows").eqNullSafe(F.col("_rows"))).otherwise(F.lit(True))
    absolute = F.coalesce(F.col("href").rlike("^[a-z][a-z0-9+.-]*://"), F.lit(False))
    identified = F.when(kind == "vector", F.col("table_id").isNotNull()).when(
        kind == "non-geo", F.col("table_id").isNotNull() | F.coalesce(~F.col("geospatial"), F.lit(False))
    ).otherwise(F.lit(True))
    remote = F.when(kind == "remote", F.col("href").isNotNull()).otherwise(F.lit(True))
    return joined.select(
        key,
        counts.alias("counts_equal"),
        absolute.alias("href_absolute"),
        identified.alias("identified"),
        remote.alias("remote_href"),
        (counts & absolute & identified & remote).alias("ok"),
    )


def usable_output(files: DataFrame) -> DataFrame:
    """Adds ``verdict`` to (kind, bytes, rows, first_byte): ``ok``, ``empty`` or ``unusable``.

    A source under 5 bytes is empty. A Parquet output needs 200 bytes and at least one readable row, a
    raster 1000 bytes and no XML error text in place of the image.
    """
    kind, size = F.col("kind"), F.coalesce(F.col("bytes"), F.lit(0))
    table_ok = (size >= MIN_PARQUET_BYTES) & (F.coalesce(F.col("rows"), F.lit(-1)) >= 1)
    raster_ok = (size >= MIN_RASTER_BYTES) & F.coalesce(F.col("first_byte") != "<", F.lit(False))
    verdict = (
        F.when((kind == "source") & (size < MIN_SOURCE_BYTES), "empty")
        .when(kind == "source", "ok")
        .when((kind == "parquet") & table_ok, "ok")
        .when((kind == "raster") & raster_ok, "ok")
        .otherwise("unusable")
    )
    return files.withColumn("verdict", verdict)
