"""Small JSON documents: manifests, table metadata and inventories. Each file is one task."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Record shapes.
VECTOR_ENTRY = "id string, typename string, title string, theme string, crs string, rows bigint, want bigint, type string, src string"
TABULAR_ENTRY = "id string, title string, theme string, src string, rows bigint, type string, license string"
RASTER_ENTRY = "id string, coverage string, title string, theme string, src string, wgs array<double>, type string"
LAYER_INVENTORY = "name string, ws string, title string, count bigint"
COVERAGE_INVENTORY = "id string, title string"
PACKAGE_INVENTORY = (
    "name string, title string, license string, groups array<string>, resources array<struct<format:string,url:string>>"
)
_SCHEMA = "struct<`schema-id`:int,fields:array<struct<id:int,name:string,type:string,doc:string>>>"
TABLE_METADATA = (
    f"`current-schema-id` int, schemas array<{_SCHEMA}>, schema {_SCHEMA},"
    " snapshots array<struct<summary:map<string,string>>>"
)


def read_manifest(spark: SparkSession, path: str, entry: str = VECTOR_ENTRY) -> DataFrame:
    """Entries of ``{id: record}`` documents. A missing or unreadable document gives no rows."""
    empty = spark.createDataFrame([], entry)
    try:
        texts = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty
    records = F.from_json("value", f"map<string,struct<{entry}>>")
    exploded = texts.select(F.explode(records).alias("_key", "_entry"))
    return exploded.select(
        F.coalesce("_entry.id", "_key").alias("id"), *[F.col(f"_entry.{c}") for c in empty.columns if c != "id"]
    )


def read_table_metadata(spark: SparkSession, paths) -> tuple[DataFrame, DataFrame]:
    """(fields, totals): current schema fields (file, id, name, type, doc) and (file, total_records)."""
    texts = spark.read.text(paths, wholetext=True, recursiveFileLookup=True)
    return parse_table_metadata(texts.select(F.col("_metadata.file_path").alias("file"), "value"))


def parse_table_metadata(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same of documents (file, value) that are at hand."""
    documents = texts.select("file", F.from_json("value", TABLE_METADATA).alias("m"))
    current = F.get(F.filter("m.schemas", lambda s: s["schema-id"] == F.col("m.current-schema-id")), 0)
    schema = F.when(F.col("m.schemas").isNotNull(), current).otherwise(F.col("m.schema"))
    fields = documents.select("file", schema.alias("s")).select("file", F.inline("s.fields"))
    last = F.try_element_at("m.snapshots", F.lit(-1))
    totals = documents.select("file", last.summary["total-records"].alias("total_records"))
    return fields, totals


def read_inventory(spark: SparkSession, paths, schema: str = LAYER_INVENTORY) -> DataFrame:
    """Records of JSON array documents, with a given schema instead of an inferring pass."""
    names = spark.createDataFrame([], schema).columns
    return spark.read.schema(schema).json(paths, multiLine=True, recursiveFileLookup=True).select(*names)
