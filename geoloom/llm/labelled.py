"""A bounded, repeatable sample of labelled documents for fitting a classifier on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_fold(doc_id: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the id's text leaves the remainder ``fold``; false without an id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds == fold, F.lit(False))


def sample(
    documents: DataFrame, labels: DataFrame, label: str, usable: Column, per_class: int, most_bytes: int,
    doc_id: str = "doc_id", text: str = "text",
) -> tuple[list[str], list[int]]:
    """``usable``: condition on the column _id of the labels.

    Texts and labels (0 or 1): of each class the ``per_class`` labels with the smallest hash of their id, less those
    whose text is missing or longer than ``most_bytes``. At most 2 * per_class * most_bytes reach the driver.

    Of several labels of one document the smallest counts, of several texts the one with the smallest hash; labels without an id or value are not used.
    """
    own = labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_y")).dropna()
    own = own.filter(usable).groupBy("_id").agg(F.min("_y").alias("_y"))
    order = F.xxhash64("_id"), F.col("_id")
    ids = [own.filter(F.col("_y") == y).orderBy(*order).limit(per_class) for y in (0, 1)]
    chosen = ids[0].unionAll(ids[1])
    texts = documents.filter(F.col(text).isNotNull() & (F.octet_length(text) <= most_bytes)).select(F.col(doc_id).alias("_doc"), F.col(text).alias("_t"))
    # The chosen ids are at most 2 * per_class rows.
    found = texts.join(F.broadcast(chosen), F.col("_doc") == F.col("_id")).groupBy("_id", "_y")
    rows = found.agg(F.min_by("_t", F.xxhash64("_t")).alias("_t")).orderBy("_id", "_t").collect()
    return [r["_t"] for r in rows], [r["_y"] for r in rows]

