"""Incremental ingest: feature files that arrive in a landing folder are published once each.

Structured Streaming keeps the list of files that were read, which is what the resumable batch run does
with its ledger; the ledger of feature ids is still checked, so a file delivered twice adds nothing.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.operators.joins import pending
from geoloom.operators.schema import with_field_ids
from geoloom.plans.publish import normalise_vector
from geoloom.operators.geometry import encode_geometry
from geoloom.sources.geojson import all_rejects, parse_features


# Error conditions of a folder that is missing or has no files yet.
NOTHING_THERE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def _ledger(spark: SparkSession, path: str, schema) -> DataFrame:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in NOTHING_THERE:
            raise
        return spark.createDataFrame([], schema)


def ingest_batch(batch: DataFrame, batch_id: int, attributes: str, key: str, epsg: int, target: str) -> None:
    """One micro-batch. Each has its own folder, written with overwrite, so a repeated batch is harmless."""
    spark = batch.sparkSession
    accepted, rejects = encode_geometry(parse_features(batch, attributes))
    rejects = all_rejects(rejects, batch, attributes)
    ids_type = accepted.select(key).schema
    own = f"batch={batch_id}"
    done = _ledger(spark, f"{target}/data", ids_type)
    if "batch" in done.columns:
        done = done.filter(F.col("batch") != batch_id)
    # one feature per id: the features of a batch are merged before the ledger is asked; those without one all stay
    named = accepted.filter(F.col(key).isNotNull())
    single = named.groupBy(key).agg(F.max_by(F.struct(*accepted.columns), F.xxhash64("*")).alias("_f")).select("_f.*")
    single = single.unionByName(accepted.filter(F.col(key).isNull()))
    fresh = normalise_vector(pending(single, done.select(key), key).select(*accepted.columns), epsg)
    described = with_field_ids(fresh, epsg=epsg)
    described.write.mode("overwrite").option("compression", "zstd").parquet(f"{target}/data/{own}")
    rejects.write.mode("overwrite").parquet(f"{target}/rejects/{own}")


def ingest_features(
    spark: SparkSession, landing: str, target: str, attributes: str, key: str = "id", epsg: int = 25830
):
    """Started query over newline-delimited feature files; it ends when all present files are read."""
    texts = spark.readStream.format("text").load(landing)
    return (
        texts.writeStream.foreachBatch(lambda df, n: ingest_batch(df, n, attributes, key, epsg, target))
        .option("checkpointLocation", f"{target}/_checkpoint")
        .trigger(availableNow=True)
        .start()
    )
