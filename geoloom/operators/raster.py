"""Categorical grids as cell tables ``(layer, col, row, value)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.functions.crs import to_wgs84
from geoloom.functions.guards import REGION_WGS84, is_finite


_INTEGERS = ("tinyint", "smallint", "int")


def to_tiles(cells: DataFrame, size: int = 512) -> DataFrame:
    """(layer, tx, ty, cells): a row-major array of ``size * size`` values per tile, null where no cell is.

    A cell travels as one number, its place in the tile above its value, and tiles are collected as sets.
    Copies of a cell are thus merged before the shuffle already: a tile holds each pair of place and value
    once, however often it occurs. Where values of one place differ, the greatest stays.
    """
    if dict(cells.dtypes)["value"] not in _INTEGERS:
        raise ValueError("grid values must be integers of at most 32 bits")
    low = 33  # bits below the place: 32 of the value and one that marks a gap
    tiled = cells.selectExpr(
        "layer",
        f"col div {size} as tx",
        f"row div {size} as ty",
        f"(pmod(row, {size}) * {size} + pmod(col, {size})) * {1 << low} + (cast(value as bigint) + {1 << 31}) as _cell",
    )
    packed = tiled.groupBy("layer", "tx", "ty").agg(F.sort_array(F.collect_set("_cell")).alias("_s"))
    last = f"i = size(_s) - 1 or shiftright(_s[i], {low}) <> shiftright(_s[i + 1], {low})"
    single = packed.selectExpr("layer", "tx", "ty", f"filter(_s, (c, i) -> {last}) as _k")
    unknown = f"array_except(sequence(0L, {size * size - 1}L), transform(_k, c -> shiftright(c, {low})))"
    gaps = f"transform({unknown}, i -> i * {1 << low} + {1 << 32})"
    dense = f"if(size(_k) = {size * size}, _k, sort_array(concat(_k, {gaps})))"
    value = f"if((c & {1 << 32}) <> 0, null, cast((c & {(1 << 32) - 1}) - {1 << 31} as int))"
    return single.selectExpr("layer", "tx", "ty", f"{dense} as _d").selectExpr(
        "layer", "tx", "ty", f"transform(_d, c -> {value}) as cells"
    )


def overview_levels(width: Column, height: Column, size: int) -> Column:
    """Halvings until the whole grid fits in one tile."""
    longest = F.greatest(width, height).cast("double")
    return F.greatest(F.ceil(F.log2(longest / size)), F.lit(0)).cast("int")


def overviews(cells: DataFrame, levels: int | None = None, size: int = 512) -> DataFrame:
    """(layer, level, col, row, value): nearest-neighbour pyramid, factor two per level from level 1.

    The grids are categorical, so a coarse cell takes the value of the upper-left cell below it. That cell
    has column and row divisible by ``2^level``; each base cell therefore knows on its own in which levels
    it appears, and the pyramid needs neither shuffle nor more than one pass.
    """
    depth = F.lit(levels)
    if levels is None:
        # one row per layer; a layer's depth follows its own size
        shape = cells.groupBy("layer").agg((F.max("col") + 1).alias("_w"), (F.max("row") + 1).alias("_h"))
        depths = shape.select(F.col("layer").alias("_layer"), overview_levels(F.col("_w"), F.col("_h"), size).alias("_depth"))
        cells = cells.join(depths, F.col("layer").eqNullSafe(F.col("_layer"))).drop("_layer")
        depth = F.col("_depth")
    both = F.col("col").bitwiseOR(F.col("row"))
    trailing_zeros = F.bit_count(both.bitwiseAND(-both) - 1)
    on_grid = cells.filter((F.pmod(both, F.lit(2)) == 0) & (depth > 0))
    coarse = on_grid.withColumn("level", F.explode(F.sequence(F.lit(1), F.least(depth, trailing_zeros))))

    def halved(name: str) -> Column:
        return F.call_function("shiftright", F.col(name), F.col("level")).alias(name)

    return coarse.select("layer", "level", halved("col"), halved("row"), "value")


def raster_extent(rasters: DataFrame, epsg: int) -> DataFrame:
    """Adds ``min_lon..max_lat`` of the four re-projected corners; the region box where that fails.

    ``rasters`` has origin_x, origin_y, pixel_x, pixel_y (negative: north up), width, height.
    """
    x0, y0 = F.col("origin_x"), F.col("origin_y")
    x1, y1 = x0 + F.col("width") * F.col("pixel_x"), y0 + F.col("height") * F.col("pixel_y")
    lons, lats = zip(*[to_wgs84(x, y, epsg) for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1))])
    corners = rasters.withColumn("_lons", F.array(*lons)).withColumn("_lats", F.array(*lats))
    sides = (F.array_min("_lons"), F.array_min("_lats"), F.array_max("_lons"), F.array_max("_lats"))
    fine = F.forall("_lons", is_finite) & F.forall("_lats", is_finite)
    fine = F.coalesce(fine, F.lit(False))
    out = corners
    for name, value, region in zip(("min_lon", "min_lat", "max_lon", "max_lat"), sides, REGION_WGS84):
        out = out.withColumn(name, F.when(fine, value).otherwise(F.lit(region)))
    return out.drop("_lons", "_lats")
