"""Statistical packages in one resumable run: an inventory of packages and delivered text files to tables and a ledger."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.functions import text as TX
from geoloom.operators import catalog as K
from geoloom.operators import joins as J
from geoloom.operators import setops as U
from geoloom.operators import windows as W
from geoloom.operators.quality import MIN_SOURCE_BYTES
from geoloom.plans.publish import placed_text_tables
from geoloom.sources import text_tables as TT

LEDGER = "id string, title string, theme string, src string, rows bigint, type string, license string, status string, run bigint"
#: License of a package that names none.
DEFAULT_LICENSE = "cc-by"
_NOTHING_THERE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The last entry of every package of all runs."""
    try:
        entries = spark.read.schema(LEDGER).parquet(f"{path}/ledger")
        entries.isEmpty()
    except AnalysisException as e:
        if e.getCondition() not in _NOTHING_THERE:
            raise
        entries = spark.createDataFrame([], LEDGER)
    return U.latest_per_id(entries, "id", ("run",)).select(*entries.columns)


def named_packages(packages: DataFrame) -> DataFrame:
    """Packages with the dataset id of each; a cut slug that several share gets a hash of the name."""
    return W.disambiguate_packages(packages, TX.slug(F.col("name"), "package"), F.col("name"))


def delivered_files(spark: SparkSession, landing: str, dataset: Column | None = None) -> DataFrame:
    """(id, file, bytes) of the files of a landing folder; contents are not read.

    ``dataset`` is an expression over ``_file``; without it the id is the file's name without the ending.
    """
    ident = F.regexp_extract("_file", r"([^/]+?)(?:\.[^./]*)?$", 1) if dataset is None else dataset
    try:
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(landing).select(F.col("path").alias("_file"), "length")
    except AnalysisException as e:
        if e.getCondition() not in _NOTHING_THERE:
            raise
        listed = spark.createDataFrame([], "_file string, length bigint")
    return listed.select(ident.alias("id"), F.col("_file").alias("file"), F.col("length").alias("bytes"))


def publish_packages(
    spark: SparkSession,
    packages: DataFrame,
    landing: str,
    path: str,
    run: int,
    fmt: str = "CSV",
    dataset: Column | None = None,
    prefer: str = TT.LATIN1,
) -> DataFrame:
    """Ledger entries of one run over the packages (name, title, license, groups, resources) that have the format.

    A package that the ledger has with rows is skipped; one whose resource has no address is ``no-<format>``, one of
    which no file was delivered ``FAIL-download``, one whose files are shorter than a header ``empty``. The others are
    read together, a job for each dialect and header; one that cannot be read is ``FAIL-convert``. A run that was lost may
    be given again: it writes to folders of its own, and only the ledger says which count.
    """
    asked = named_packages(K.first_resource(K.select_packages(packages, fmt), fmt))
    ledger = read_ledger(spark, path).filter((F.col("run") < run) & (F.col("rows") >= 1))
    todo = J.pending(asked.filter("url is not null"), ledger).select("id")
    files = delivered_files(spark, landing, dataset).join(todo, "id")
    # One path a file comes to the driver, as the reader of text tables needs it.
    paths = [r.file for r in files.filter(F.col("bytes") >= MIN_SOURCE_BYTES).select("file").toLocalIterator()]
    own = f"data/run={run}-{uuid.uuid4().hex[:8]}"
    ident = F.regexp_extract("_file", r"([^/]+?)(?:\.[^./]*)?$", 1) if dataset is None else dataset
    made = spark.createDataFrame([], "dataset string, rows bigint, status string, folder int")
    if paths:
        made = placed_text_tables(spark, paths, f"{path}/{own}", ident, prefer)
    # Several files of a package are one table if they have one header; otherwise the one with the most rows counts.
    best = F.max_by(F.struct("rows", "status", "folder"), F.struct(F.coalesce("rows", F.lit(-1)), -F.coalesce("folder", F.lit(-1)))).alias("_m")
    made = made.groupBy(F.col("dataset").alias("id")).agg(best).select("id", "_m.*")
    sizes = files.groupBy("id").agg(F.max("bytes").alias("_bytes"))
    before = ledger.select("id", F.col("rows").alias("_rows"), F.col("src").alias("_src"))
    told = asked.join(before, "id", "left").join(sizes, "id", "left").join(made, "id", "left")
    status = (
        F.when(F.col("_rows").isNotNull(), F.lit("skip"))
        .when(F.col("url").isNull(), F.lit(f"no-{fmt.lower()}"))
        .when(F.col("_bytes").isNull(), F.lit("FAIL-download"))
        .when(F.col("_bytes") < MIN_SOURCE_BYTES, F.lit("empty"))
        .otherwise(F.coalesce("status", F.lit("FAIL-convert")))
    )
    place = F.concat(F.lit(f"{own}/"), F.col("folder").cast("string"), F.lit("/dataset="), F.col("id"))
    entries = told.select(
        "id",
        "title",
        TX.package_theme(F.col("groups")).alias("theme"),
        F.coalesce("_src", F.when(F.col("rows") >= 1, place)).alias("src"),
        F.coalesce("_rows", F.col("rows")).alias("rows"),
        F.lit("tabular").alias("type"),
        F.coalesce("license", F.lit(DEFAULT_LICENSE)).alias("license"),
        status.alias("status"),
        F.lit(run).cast("long").alias("run"),
    )
    entries.write.mode("overwrite").parquet(f"{path}/ledger/part={run}")
    return spark.read.schema(LEDGER).parquet(f"{path}/ledger/part={run}")
