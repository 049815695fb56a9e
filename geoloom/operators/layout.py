"""Row order and placement in files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoloom.functions.hilbert import hilbert_key
from geoloom.session import reliable_checkpoint


def bbox_extent(df: DataFrame) -> tuple[float, float, float, float]:
    """Extent of all bbox columns; one aggregated row comes to the driver."""
    row = df.agg(F.min("xmin"), F.min("ymin"), F.max("xmax"), F.max("ymax")).first()
    return tuple(float(v) if v is not None else 0.0 for v in row)


def with_hilbert(
    df: DataFrame, extent: tuple[float, float, float, float] | None = None, bits: int = 16, name: str = "hilbert"
) -> DataFrame:
    """Adds the curve position of the bbox centre."""
    extent = extent or bbox_extent(df)
    key = hilbert_key(extent, bits)
    centre = [(F.col(f"{a}min") + F.col(f"{a}max")) / 2 for a in "xy"]
    return df.withColumn(name, key(*centre))


def spread_equal_keys() -> Column:
    """Tie-breaker that lets a range partitioner split rows with one and the same key.

    It is the number of the map task, so a retried task gives its rows the same value.
    """
    return F.spark_partition_id()


def hilbert_sort(
    df: DataFrame,
    extent: tuple[float, float, float, float] | None = None,
    bits: int = 16,
    leading: tuple[str, ...] = (),
    partitions: int | None = None,
    keep_key: bool = False,
) -> DataFrame:
    """Rows in Hilbert order over the whole table: one range shuffle, then a sort inside each partition.

    A hot cell (or a hot value of ``leading``) is cut over several partitions by the tie-breaker.
    """
    keyed = with_hilbert(df, extent, bits, "_hilbert").withColumn("_spread", spread_equal_keys())
    keys = [*leading, "_hilbert", "_spread"]
    ranged = keyed.repartitionByRange(partitions, *keys) if partitions else keyed.repartitionByRange(*keys)
    placed = ranged.sortWithinPartitions(*keys).drop("_spread")
    return placed.withColumnRenamed("_hilbert", "hilbert") if keep_key else placed.drop("_hilbert")


def with_global_position(df: DataFrame, order: list[str], name: str = "position") -> DataFrame:
    """0-based position of every row in a total order, without a window over the whole table.

    The rows are range-sorted and written to the shared checkpoint folder with their place inside the
    partition; the offsets of the partitions (one number each) are then added.
    """
    sorted_rows = df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id())
    fixed = reliable_checkpoint(sorted_rows)
    part, inside = F.shiftright("_place", 33), F.col("_place").bitwiseAND((1 << 33) - 1)
    fixed = fixed.withColumn("_part", part).withColumn("_inside", inside)
    # At most one row per shuffle partition reaches this window, and is broadcast after it.
    sizes = fixed.groupBy("_part").agg((F.max("_inside") + 1).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    return (
        fixed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_inside"))
        .drop("_part", "_inside", "_offset", "_place")
    )


def sample_geometries(
    df: DataFrame, epsg: int, order: list[str] | None = None, n: int = 2000, geom: str = "geom"
) -> DataFrame:
    """First ``n`` rows that have a geometry, in longitude/latitude. Only those ``n`` are re-projected.

    Without an order the scan ends after the first files that hold as many.
    """
    from geoloom.operators.geometry import reproject

    some = df.filter(F.col(geom).isNotNull())
    top = (some.orderBy(*order) if order else some).limit(n)
    return reproject(top, epsg, geom)


def preview(df: DataFrame, order: list[str] | None = None, n: int = 100, geom: str = "geom") -> DataFrame:
    """First rows of the logical table without its geometry; the scan reads only the shown columns.

    Without an order, as a browser shows a table, it ends after the first files.
    """
    from geoloom.operators.schema import hide_bbox

    shown = hide_bbox(df)
    rows = shown.drop(geom)
    return (rows.orderBy(*order) if order else rows).limit(n)


def capped_list(df: DataFrame, order: list[str], n: int = 500) -> DataFrame:
    """First ``n`` rows, and ``remaining``: how many more there are (equal on every row)."""
    total = df.agg(F.count(F.lit(1))).scalar()
    more = F.greatest(total - n, F.lit(0))
    return df.orderBy(*order).limit(n).withColumn("remaining", more)


def smallest_first(df: DataFrame, size: str, tie: str) -> DataFrame:
    return df.orderBy(size, tie)


def giants(df: DataFrame, size: str, above: int = 1_000_000) -> DataFrame:
    """Rows above a size, biggest first."""
    return df.filter(F.col(size) > above).orderBy(F.desc(size))
