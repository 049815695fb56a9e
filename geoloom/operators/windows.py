"""Identifier disambiguation and running progress."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def disambiguate_ids(inventory: DataFrame, slug: Column, prefix: Column) -> DataFrame:
    """Adds ``id``: the slug, or ``<prefix>_<slug>`` for every row of a slug that occurs more than once.

    Repeated slugs are counted with a partial aggregate and joined back, so a slug that has a third of all
    rows is neither sorted nor held in one task; the adaptive planner splits it in the join.
    """
    named = inventory.withColumn("_slug", slug)
    repeated = named.groupBy("_slug").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_slug", F.lit(True).alias("_many"))
    joined = named.join(repeated, "_slug", "left")
    own = F.when(F.col("_many"), F.concat(F.lower(prefix), F.lit("_"), F.col("_slug"))).otherwise(F.col("_slug"))
    return joined.withColumn("id", own).drop("_slug", "_many")


def disambiguate_packages(packages: DataFrame, slug: Column, key: Column) -> DataFrame:
    """Same for packages: a cut slug that several packages share gets a hash of the package id."""
    named = packages.withColumn("_slug", slug)
    repeated = named.groupBy("_slug").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_slug", F.lit(True).alias("_many"))
    suffix = F.substring(F.sha2(key.cast("string"), 256), 1, 8)
    own = F.when(F.col("_many"), F.concat(F.col("_slug"), F.lit("_"), suffix)).otherwise(F.col("_slug"))
    return named.join(repeated, "_slug", "left").withColumn("id", own).drop("_slug", "_many")


def outcome(status: Column) -> Column:
    """``ok`` (prefix OK), ``skip`` or ``fail``."""
    return F.when(status.startswith("OK"), "ok").when(status == "skip", "skip").otherwise("fail")


def progress(
    results: DataFrame, by: str, seq: str = "seq", status: str = "status", block_rows: int = 1_000_000, tie: str | None = None
) -> DataFrame:
    """Running ``i``, ``ok``, ``fail`` and the final ``total`` per group, in order of an integer sequence.

    A null group is a group; rows without a sequence number come first in theirs, in order of the integer ``tie``,
    which also decides between equal numbers. Without a tie their order is not defined.
    The sequence (few rows to a number) is cut into blocks of ``block_rows``, rows without a number into blocks of the
    tie. Rows are numbered inside their block; the sums of the blocks before are added, so no task has to sort a whole
    group, nor all rows without a number.
    """
    kind = outcome(F.col(status))
    order = [seq] if tie is None else [seq, tie]
    unnumbered = F.lit(0) if tie is None else F.when(F.col(seq).isNull(), F.floor(F.col(tie) / block_rows)).otherwise(0)
    rows = results.withColumns({"_block": F.floor(F.col(seq) / block_rows), "_sub": unnumbered, "_ok": (kind != "fail").cast("bigint")})
    inside = Window.partitionBy(by, "_block", "_sub").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumn("_i", F.row_number().over(inside)).withColumn("_okrun", F.sum("_ok").over(inside))
    sums = rows.groupBy(by, "_block", "_sub").agg(F.count(F.lit(1)).alias("_n"), F.sum("_ok").alias("_oks"))
    group = Window.partitionBy(by)
    before = group.orderBy("_block", "_sub").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        F.col(by).alias("_by"),
        F.col("_block").alias("_at"),
        F.col("_sub").alias("_sub_at"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_i0"),
        F.coalesce(F.sum("_oks").over(before), F.lit(0)).alias("_ok0"),
        F.sum("_n").over(group).alias("total"),
    )
    same = F.col(by).eqNullSafe(F.col("_by")) & F.col("_block").eqNullSafe(F.col("_at")) & F.col("_sub").eqNullSafe(F.col("_sub_at"))
    joined = local.join(offsets, same)
    i, ok = F.col("_i") + F.col("_i0"), F.col("_okrun") + F.col("_ok0")
    return joined.select(
        *results.columns, i.alias("i"), ok.alias("ok"), (i - ok).alias("fail"), "total"
    )
