"""Unions, upserts and differences of manifests and catalogs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.functions.names import quoted

# Order of the kinds in the index.
KIND_ORDER = {"vector": 1, "tabular": 2, "raster": 3}


def latest_per_id(df: DataFrame, key: str = "id", order: tuple[str, ...] = ("seq",)) -> DataFrame:
    """The last record of every id.

    An aggregate, not a ranking window: every map task sends on one record per id it holds, so an id that
    has most of the records does not end up in one task.
    """
    rest = [c for c in df.columns if c != key]
    last = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(key).agg(last.alias("_last")).select(key, *[F.col(f"_last.{quoted(c)}").alias(c) for c in rest])


def upsert_manifest(old: DataFrame, new: DataFrame, key: str = "id", seq: str = "seq") -> DataFrame:
    """Old and new entries together; a new entry replaces an old one, the last of several new ones counts."""
    tagged = old.withColumn("_gen", F.lit(0)).unionByName(new.withColumn("_gen", F.lit(1)), allowMissingColumns=True)
    return latest_per_id(tagged, key, ("_gen", seq)).drop("_gen")


def build_index(vector: DataFrame, tabular: DataFrame, raster: DataFrame) -> DataFrame:
    """One frame of all kinds: vector, tabular, raster, each sorted by id."""
    parts = [df.withColumn("kind", F.lit(kind)) for df, kind in zip((vector, tabular, raster), KIND_ORDER)]
    union = parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)
    return union.orderBy(kind_rank(F.col("kind")), "id")


def kind_rank(kind):
    out = F.lit(len(KIND_ORDER) + 1)
    for name, rank in KIND_ORDER.items():
        out = F.when(kind == name, F.lit(rank)).otherwise(out)
    return out


def add_only(existing: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """Existing entries stay, entries with a new version are overwritten, nothing is deleted."""
    kept = existing.join(new.select(key), key, "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def missing_or_extra(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that only one side has (with multiplicity), labelled ``missing`` (not in b) or ``extra``."""
    missing = a.exceptAll(b).withColumn("side", F.lit("missing"))
    return missing.unionByName(b.exceptAll(a).withColumn("side", F.lit("extra")))
