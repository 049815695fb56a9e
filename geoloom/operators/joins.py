"""Ledger, manifest and file-pruning joins. Strategy and skew handling are left to the adaptive planner."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.functions.guards import all_finite


def pending(everything: DataFrame, ledger: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose id is not in the ledger yet (exact, case-sensitive match)."""
    return everything.join(ledger.select(key), key, "left_anti")


def reconcile(expected: DataFrame, existing: DataFrame, converted: DataFrame, key: str = "id") -> DataFrame:
    """Status per expected id.

    ``existing`` and ``converted`` hold (id, rows). An existing output with the wanted rows is skipped;
    otherwise the converted rows decide; a missing or unreadable (negative) count is a failure.
    """
    have = existing.select(key, F.col("rows").alias("_have"))
    made = converted.select(key, F.col("rows").alias("got"))
    want, got = F.col("want"), F.col("got")
    partial = F.concat(F.lit("OK-partial("), got.cast("string"), F.lit("/"), want.cast("string"), F.lit(")"))
    status = (
        F.when(F.col("_have") == want, F.lit("skip"))
        .when(got.isNull() | (got < 0), F.lit("FAIL"))
        .when(got == want, F.lit("OK"))
        .otherwise(partial)
    )
    return (
        expected.join(have, key, "left").join(made, key, "left").withColumn("status", status).drop("_have")
    )


def materialised(manifest: DataFrame, files: DataFrame, src: str = "src") -> DataFrame:
    """Manifest entries whose file exists."""
    return manifest.join(files.select(F.col("file").alias(src)), src, "left_semi")


def lookup_dataset(requested: DataFrame, index: DataFrame) -> DataFrame:
    """Index entry of each requested id; an unknown id gets the defaults of a plain table."""
    from geoloom.functions.text import data_path, metadata_path

    found = requested.join(index, "id", "left")
    return found.select(
        "id",
        F.coalesce("type", F.lit("table")).alias("type"),
        F.coalesce(F.col("crs").cast("string"), F.lit("4326")).alias("crs"),
        data_path(F.col("id"), F.col("parquet")).alias("parquet"),
        metadata_path(F.col("id"), F.col("meta")).alias("meta"),
    )


def with_descriptions(columns: DataFrame, docs: DataFrame, keys: tuple[str, ...] = ("column",)) -> DataFrame:
    """Adds ``doc``: the supplied description, else the column's own name."""
    joined = columns.join(docs.select(*keys, F.col("doc").alias("_doc")), list(keys), "left")
    return joined.withColumn("doc", F.coalesce("_doc", "column")).drop("_doc")


def resolve_kind_collisions(tabular: DataFrame, spatial: DataFrame) -> DataFrame:
    """A tabular id that a spatial dataset already has gets the table suffix in ``out_id``."""
    from geoloom.functions.text import TABLE_SUFFIX

    taken = spatial.select("id").distinct().withColumn("_taken", F.lit(True))
    out = F.when(F.col("_taken"), F.concat("id", F.lit(TABLE_SUFFIX))).otherwise(F.col("id"))
    return tabular.join(taken, "id", "left").withColumn("out_id", out).drop("_taken")


def _cells(df: DataFrame, base: float, step: int, top: int, lifted: bool, above_own: bool) -> DataFrame:
    """One row per grid cell a rectangle touches, at its own level or at all coarser ones.

    The own level is the first whose cell is at least as big as the rectangle, so at that level and above
    it touches at most four cells.
    """
    side = "greatest(xmax - xmin, ymax - ymin)"
    own = f"least({top}, if({side} <= {base}, 0, cast(ceil(log({step}, {side} / {base})) as int)))"
    first = f"{own} + 1" if above_own else own
    levels = f"array({own})"
    if lifted:
        levels = f"if({first} <= {top}, sequence({first}, {top}), cast(array() as array<int>))"
    cell = f"({base} * pow({step}D, _level))"

    def touched(a: str) -> str:
        return f"explode(sequence(cast(floor({a}min / {cell}) as bigint), cast(floor({a}max / {cell}) as bigint))) as _c{a}"

    levelled = df.selectExpr("*", f"explode({levels}) as _level")
    return levelled.selectExpr("*", touched("x")).selectExpr("*", touched("y"))


def overlap_pairs(left: DataFrame, right: DataFrame, base: float = 1000.0, step: int = 4) -> DataFrame:
    """All (left id, right id) whose boxes share a point, each pair once; boxes that are not finite are in no pair.

    ``left`` and ``right`` have ``id, xmin, ymin, xmax, ymax``. Instead of comparing every pair, boxes meet on
    a grid whose level fits the bigger of the two: big boxes at their own level against everything lifted
    to it, then the reverse. It is an equi-join on (level, cell), so neither side has to fit in memory.
    """
    named = []
    for df, p in ((left, "l"), (right, "r")):
        known = all_finite("xmin", "ymin", "xmax", "ymax")
        sides = [F.col(c).cast("double").alias(c) for c in ("xmin", "ymin", "xmax", "ymax")]
        named.append((df.filter(known).select("id", *sides), p))
    longest = F.max(F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin")))
    biggest, top = named[0][0].drop("id").unionByName(named[1][0].drop("id")).agg(longest).first()[0] or 0.0, 0
    while base * step**top < biggest:
        top += 1

    def side(i: int, lifted: bool, above_own: bool = False) -> DataFrame:
        df, p = named[i]
        names = {c: f"{p}_{c}" for c in ("id", "xmin", "ymin", "xmax", "ymax")}
        return _cells(df, base, step, top, lifted, above_own).withColumnsRenamed(names)

    cell = f"({base} * pow({step}D, _level))"
    overlap = "l_xmin <= r_xmax and l_xmax >= r_xmin and l_ymin <= r_ymax and l_ymax >= r_ymin"
    # boxes that share several cells are paired in the cell of the overlap's lower corner only
    once = " and ".join(f"floor(greatest(l_{a}min, r_{a}min) / {cell}) = _c{a}" for a in "xy")

    def meet(a: DataFrame, b: DataFrame) -> DataFrame:
        return a.join(b, ["_level", "_cx", "_cy"]).filter(f"{overlap} and {once}").select("l_id", "r_id")

    return meet(side(0, lifted=False), side(1, lifted=True)).unionByName(
        meet(side(0, lifted=True, above_own=True), side(1, lifted=False))
    )


def prune_files(files: DataFrame, boxes: DataFrame, base: float = 1000.0) -> DataFrame:
    """(box, scanned, total) per query box: how many files their bounds cannot rule out.

    A file with a placeholder bound (``has_bound = false``) can never be ruled out.
    """
    known = files.filter("has_bound").select(F.col("file").alias("id"), "xmin", "ymin", "xmax", "ymax")
    pairs = overlap_pairs(boxes, known, base)
    hits = pairs.groupBy(F.col("l_id").alias("id")).agg(F.count(F.lit(1)).alias("_hits"))
    counts = files.agg(
        F.struct(F.count(F.lit(1)).alias("total"), F.count_if(~F.col("has_bound")).alias("always"))
    ).scalar()
    return (
        boxes.select("id")
        .join(hits, "id", "left")
        .select(
            F.col("id").alias("box"),
            (F.coalesce("_hits", F.lit(0)) + counts.always).alias("scanned"),
            counts.total.alias("total"),
        )
    )


def row_count(datasets: DataFrame, totals: DataFrame, counted: DataFrame) -> DataFrame:
    """Rows per dataset: the metadata total of a partitioned set where it is given, else the counted rows."""
    stated = F.nullif(F.trim("total_records"), F.lit(""))
    return (
        datasets.join(totals.select("id", "total_records"), "id", "left")
        .join(counted.select("id", F.col("n").alias("_counted")), "id", "left")
        .select("id", F.coalesce(F.when(F.col("partitioned"), stated.try_cast("bigint")), F.col("_counted")).alias("n"))
    )
