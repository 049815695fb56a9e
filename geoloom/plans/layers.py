"""Many feature layers in one resumable run: inventory and delivered features to published datasets and a ledger.

A run converts the layers of an inventory that the ledger does not have complete. Layers of equal attributes are one
write job, whatever their number, into ``data/<signature>/dataset=<id>``; a dataset that is converted again replaces
its own folder and no other. The ledger is a table that only grows, one folder a run; the last entry of an id counts.
Between the two a run can be lost at any place: the next one converts what the ledger does not say is complete.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.functions import text as TX
from geoloom.functions.geometry import BBOX_NAMES
from geoloom.operators import attributes as A
from geoloom.operators import catalog as K
from geoloom.operators import geometry as OG
from geoloom.operators import joins as J
from geoloom.operators import schema as S
from geoloom.operators import setops as U
from geoloom.operators import windows as W
from geoloom.plans.publish import normalise_vector
from geoloom.session import scratch_path
from geoloom.sources import datasets as D

LEDGER = (
    "id string, typename string, title string, theme string, crs string, rows bigint, want bigint, type string, src string,"
    " status string, run bigint"
)
#: The dataset column of a written table, and the names that an attribute cannot have.
DATASET = "dataset"
TAKEN = ("geom", "bbox", *BBOX_NAMES, DATASET)
_NOTHING_THERE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The last entry of every dataset of all runs."""
    try:
        entries = spark.read.schema(LEDGER).parquet(f"{path}/ledger")
        entries.isEmpty()
    except AnalysisException as e:
        if e.getCondition() not in _NOTHING_THERE:
            raise
        entries = spark.createDataFrame([], LEDGER)
    return U.latest_per_id(entries, "id", ("run",)).select(*entries.columns)


def named_layers(inventory: DataFrame) -> DataFrame:
    """Inventory (name, ws, title, count) with the dataset id of every layer."""
    return W.disambiguate_ids(inventory, TX.slug(F.col("name")), F.col("ws"))


def read_layer_features(texts: DataFrame, layers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(features, rejects) of the delivered lines (layer, value) of the given layers (name, id).

    Features have ``dataset``, ``properties`` as JSON text and the geometry as WKB; rejects the raw line and a reason.
    Lines of other layers are neither.
    """
    ids = layers.select(F.col("name").alias("layer"), F.col("id").alias(DATASET))
    lines = texts.filter(F.trim("value") != "").join(ids, "layer")
    read = lines.withColumn("_f", F.from_json("value", "type string, geometry string, properties string"))
    why = F.when(F.try_parse_json("value").isNull(), "no JSON").when(~F.col("_f.type").eqNullSafe("Feature"), "no feature")
    told = read.withColumn("_why", why)
    parsed = told.filter("_why is null").select(DATASET, "value", F.coalesce("_f.properties", F.lit("{}")).alias("properties"), F.col("_f.geometry").alias("geometry"))
    accepted, unreadable = OG.encode_geometry(parsed)
    rejects = told.filter("_why is not null").select(DATASET, "value", F.col("_why").alias("why"))
    return accepted.drop("value"), rejects.unionByName(unreadable.select(DATASET, "value", F.lit("geometry").alias("why")))


def typed_features(features: DataFrame, attributes: list[tuple[str, str]]) -> DataFrame:
    """Features of one signature with their attributes as typed columns, the dataset column last.

    Names are lower-cased; one that is taken, also by the geometry, its box or the dataset, gets a number as suffix.
    Values are looked up by the exact name, so that names that differ by case only stay apart.
    """
    parsed = features.withColumn("_values", F.from_json("properties", "map<string,variant>"))
    columns = []
    for (name, kind), out in zip(attributes, S.free_names([n for n, _ in attributes], TAKEN), strict=True):
        value = F.try_element_at("_values", F.lit(name))
        if kind == "string":
            told = F.schema_of_variant(value)
            text = F.when(told == "STRING", F.try_variant_get(value, "$", "string")).otherwise(F.to_json(value))
            columns.append(F.when(told != "VOID", text).alias(out))
        else:
            columns.append(F.try_variant_get(value, "$", kind).alias(out))
    return parsed.select(*columns, "geom", DATASET)


def publish_layers(
    spark: SparkSession,
    texts: DataFrame,
    inventory: DataFrame,
    path: str,
    epsg: int,
    run: int,
    sizes: tuple[int, int] | None = None,
    bits: int = 24,
) -> tuple[DataFrame, DataFrame]:
    """(results, rejects) of one run: the ledger entries of every asked layer, and the lines that are no feature.

    ``texts``: (layer, value), one feature a line. ``inventory``: (name, ws, title, count). ``sizes`` asks for the
    layers of that many features only. ``run`` must grow from run to run; a run that was lost may be given again.
    A layer of which nothing was delivered, or nothing that has a geometry, is a failure.
    """
    asked = named_layers(inventory)
    if sizes is not None:
        asked = K.size_tier(asked, *sizes)
    asked = asked.withColumn("want", F.col("count").cast("long"))
    ledger = read_ledger(spark, path).filter(F.col("run") < run)
    complete = asked.join(ledger.select("id", "rows"), "id").filter("rows = want").select("id", "rows")
    todo = J.pending(asked, complete)

    features, rejects = read_layer_features(texts, todo.select("name", "id"))
    staged = scratch_path(spark, "staged-layers")
    features.write.option("compression", "zstd").parquet(staged)
    features = spark.read.schema(features.schema).parquet(staged)
    listed = features.select(DATASET).distinct()
    signed = listed.join(A.signatures(A.attribute_types(features)), DATASET, "left").withColumn("signature", F.coalesce("signature", F.lit("none")))
    signed_at, parted = scratch_path(spark, "signatures"), scratch_path(spark, "signed-layers")
    signed.write.parquet(signed_at)
    signed = spark.read.schema(signed.schema).parquet(signed_at)
    # A folder a signature: each write job reads its own features and no others.
    features.join(signed.select(DATASET, "signature"), DATASET).write.partitionBy("signature").option("compression", "zstd").parquet(parted)

    made = []
    for found in signed.groupBy("signature").agg(F.first("attributes").alias("attributes")).orderBy("signature").collect():
        own = spark.read.schema(features.schema).parquet(f"{parted}/signature={found.signature}")
        typed = typed_features(own, [(a.attribute, a.type) for a in found.attributes or []])
        folder = f"{path}/data/{found.signature}"
        D.write_vector_dataset(normalise_vector(typed, epsg), folder, (DATASET,), epsg=epsg, bits=bits, mode="overwrite", dynamic=True)
        written = spark.read.schema(f"{DATASET} string").parquet(folder)
        counts = written.join(listed, DATASET, "left_semi").groupBy(DATASET).agg(F.count(F.lit(1)).alias("rows"))
        made.append(counts.select(F.col(DATASET).alias("id"), "rows", F.lit(f"data/{found.signature}").alias("_folder")))

    nothing = spark.createDataFrame([], "id string, rows bigint, _folder string")
    converted = reduce(DataFrame.unionByName, made, nothing)
    told = J.reconcile(asked, complete, converted).join(converted.select("id", "_folder"), "id", "left")
    before = ledger.select("id", F.col("src").alias("_src"))
    entries = told.join(before, "id", "left").select(
        "id",
        F.col("name").alias("typename"),
        "title",
        F.col("ws").alias("theme"),
        F.lit(f"EPSG:{epsg}").alias("crs"),
        F.when(F.col("status") == "skip", F.col("want")).otherwise(F.col("got")).cast("long").alias("rows"),
        "want",
        F.lit("vector").alias("type"),
        F.coalesce(F.concat("_folder", F.lit(f"/{DATASET}="), F.col("id")), F.col("_src")).alias("src"),
        "status",
        F.lit(run).cast("long").alias("run"),
    )
    entries.write.mode("overwrite").parquet(f"{path}/ledger/part={run}")
    return spark.read.schema(LEDGER).parquet(f"{path}/ledger/part={run}"), rejects


def read_layer(spark: SparkSession, path: str, dataset: str) -> DataFrame:
    """One published dataset, by the folder that its ledger entry names."""
    entry = read_ledger(spark, path).filter((F.col("id") == dataset) & F.col("src").isNotNull()).first()
    if entry is None:
        raise ValueError(f"no dataset {dataset!r}")
    return spark.read.parquet(f"{path}/{entry.src}")
