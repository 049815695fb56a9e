"""GeoJSON features to attributes, WKB geometry and bbox."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.functions import geometry as G
from geoloom.operators.geometry import encode_geometry
from geoloom.operators.schema import with_srid


def parse_features(texts: DataFrame, attributes: str | None = None) -> DataFrame:
    """Feature texts in column ``value`` to the attributes and the geometry text.

    ``attributes`` is the DDL of the properties; without it they stay one string map.
    """
    parsed = _parsed(texts, attributes).filter("_why is null")
    picked = F.col("f.properties.*") if attributes else F.col("f.properties").alias("properties")
    return parsed.select(picked, F.col("f.geometry").alias("geometry"))


def _parsed(texts: DataFrame, attributes: str | None) -> DataFrame:
    """``value``, the parsed feature ``f``, and ``_why`` where it is none; blank lines are left out."""
    kind = f"struct<{attributes}>" if attributes else "map<string,string>"
    shape = f"type string, geometry string, properties {kind}, _corrupt string"
    lines = texts.filter(F.trim("value") != "")
    read = lines.select("value", F.from_json("value", shape, {"columnNameOfCorruptRecord": "_corrupt"}).alias("f"))
    # a text that parses, but whose attributes do not fit their types, is corrupt as well
    whole = F.try_parse_json("value").isNotNull()
    why = F.when(~whole, "no JSON").when(F.col("f._corrupt").isNotNull(), "attribute of another type")
    why = why.when(~F.col("f.type").eqNullSafe("Feature"), "no feature")
    return read.withColumn("_why", why)


def broken_features(texts: DataFrame, attributes: str | None = None) -> DataFrame:
    """(value, why) of the lines that are no feature: broken text, another type, attributes that do not fit."""
    return _parsed(texts, attributes).filter("_why is not null").select("value", F.col("_why").alias("why"))


def all_rejects(unreadable: DataFrame, texts: DataFrame, attributes: str | None) -> DataFrame:
    """Features without a readable geometry, and what is no feature, in one table."""
    named = unreadable.withColumn("why", F.lit("geometry"))
    return named.unionByName(broken_features(texts, attributes), allowMissingColumns=True)


def split_collections(documents: DataFrame) -> DataFrame:
    """Whole FeatureCollection texts to one feature text per row.

    One document is read by one task; layers too big for that should be delivered as one feature per line.
    """
    inside = F.from_json("value", "features array<string>")
    return documents.select(F.explode(inside.features).alias("value"))


def read_geojson_features(
    spark: SparkSession, paths, layout: str = "lines", attributes: str | None = None, epsg: int = 25830
) -> tuple[DataFrame, DataFrame]:
    """(features, rejects). ``lines`` has one feature per line and can be split; ``collection`` whole files.

    Rejects are features whose geometry cannot be read, with their attributes, and texts that are no feature, with
    the raw text in ``value``; ``why`` names the reason. Features and rejects together are all lines.
    """
    if layout == "lines":
        texts = spark.read.text(paths, recursiveFileLookup=True)
    elif layout == "collection":
        texts = split_collections(spark.read.text(paths, wholetext=True, recursiveFileLookup=True))
    else:
        raise ValueError(f"unknown layout {layout!r}")
    accepted, rejects = encode_geometry(parse_features(texts, attributes))
    rejects = all_rejects(rejects, texts, attributes)
    boxed = accepted.withColumn("bbox", G.wkb_bbox(F.col("geom")))
    return with_srid(boxed, epsg), rejects
