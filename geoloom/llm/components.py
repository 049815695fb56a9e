"""Connected components of a graph given by its links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm.common import written


def _stars(links: DataFrame) -> DataFrame:
    """One large-star and one small-star step over links (a, b) with a > b."""
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    low = large.groupBy("a").agg(F.min("b").alias("m"))
    moved = large.join(low, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(low.select("a", F.col("m").alias("b"))).distinct()


def roots(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node of the component, for every node but the roots. ``links``: longs a, b.

    Each turn is written to the shared folder and compared with the one before by count and checksum.
    """
    links = links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    before = None
    while True:
        links = written(links, "stars")
        check = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        now = links.agg(F.count("*"), check).first()
        if now == before or not now[0]:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before, links = now, _stars(links)


def one_of_each(documents: DataFrame, prints: DataFrame, found: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The row of the smallest key of each group. ``prints``: _id, _hash, _print of the rows; ``found``: node, root."""
    rows = prints.groupBy("_print", "_id", "_hash").agg(F.count("*").alias("_n"))
    first = F.min(F.struct(F.col("_id").isNull().alias("_last"), "_id", "_hash", "_n")).alias("_first")
    firsts = rows.groupBy("_print").agg(first).join(found.withColumnRenamed("node", "_print"), "_print", "left")
    kept = firsts.groupBy(F.coalesce("root", "_print").alias("_group")).agg(F.min("_first").alias("_first"))
    kept = written(kept.select(F.col("_first._id").alias("_kid"), F.col("_first._hash").alias("_khash"), F.col("_first._n").alias("_n")), "kept-rows")
    own = documents.withColumns({"_row_id": F.col(doc_id).cast("long"), "_row_hash": F.xxhash64(text)})

    def rows_of(keys: DataFrame) -> DataFrame:
        return own.join(keys, F.col("_row_id").eqNullSafe(F.col("_kid")) & (F.col("_row_hash") == F.col("_khash")), "left_semi")

    stay, repeated = rows_of(kept.filter("_n = 1")), kept.filter("_n > 1")
    if not repeated.isEmpty():
        stay = stay.unionAll(rows_of(repeated).dropDuplicates(["_row_id", "_row_hash"]))
    return stay.select(*documents.columns)
