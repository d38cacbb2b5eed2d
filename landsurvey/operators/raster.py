"""Raster algebra on cell rows: row (0 is north), col, e, n, z (null: no data).

Neighbours come from lag and lead inside rows and columns, or, for whole-raster
work at scale, from windows partitioned by one axis, so no task holds a raster.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalar import col
from ..shipping import ship


def nodata_to_null(z: Column | str, sentinel: float | None) -> Column:
    """Null for NaN, infinities, the sentinel within 1e-6, and values under -1e30."""
    z = col(z)
    bad = F.isnan(z) | (F.abs(z) == float("inf")) | (z < -1e30)
    if sentinel is not None:
        bad = bad | (F.abs(z - sentinel) <= 1e-6)
    return F.when(~bad, z)


def mosaic(tiles: DataFrame) -> DataFrame:
    """Cells of all tiles (with tile_name); of a shared edge the last non-null name counts."""
    best = F.max(F.when(F.col("z").isNotNull(), F.struct("tile_name", "z")))["z"]
    return tiles.groupBy("row", "col").agg(F.first("e").alias("e"), F.first("n").alias("n"), best.alias("z"))


def height_above_ground(dtm: DataFrame, dsm: DataFrame) -> DataFrame:
    """dtm cells with ndsm = dsm - dtm, null where either is."""
    return dtm.join(dsm.select("row", "col", F.col("z").alias("dsm")), ["row", "col"], "left").withColumn("ndsm", F.col("dsm") - F.col("z"))


def gradient(z: Column | str, part: list[str], along: str) -> Column:
    """Central differences, one-sided at the ends of each part."""
    w = Window.partitionBy(*part).orderBy(along)
    before, after, z = F.lag(col(z)).over(w), F.lead(col(z)).over(w), col(z)
    first, last = F.lag(F.lit(1)).over(w).isNull(), F.lead(F.lit(1)).over(w).isNull()
    return F.when(first & last, 0.0).when(first, after - z).when(last, z - before).otherwise((after - before) / 2)


def slope_degrees(cells: DataFrame, px: tuple[float, float], part: list[str] = [], z: str = "z", calm: str | None = None) -> DataFrame:  # noqa: B006
    """cells with slope; part limits neighbours to a tile (T31), none is site-wide. With
    calm, also dz: the calmest step of that column."""
    gx, gy = gradient(z, [*part, "row"], "col"), gradient(z, [*part, "col"], "row")
    # one projection: windows of one direction share a shuffle and a sort
    out = cells.withColumns({"gx": gx / px[0], "gy": gy / px[1], **({"dz": calmest_step(calm)} if calm else {})})
    return out.withColumn("slope", F.degrees(F.atan(F.sqrt(F.col("gx") * F.col("gx") + F.col("gy") * F.col("gy"))))).drop("gx", "gy")


def rock_ramp(slope: Column | str, low: float, high: float) -> Column:
    return F.least(F.greatest((col(slope) - low) / (high - low), F.lit(0.0)), F.lit(1.0))


def calmest_step(z: str = "z") -> Column:
    """Least height difference to the four neighbours that have one; null if none has."""
    row, column = Window.partitionBy("row").orderBy("col"), Window.partitionBy("col").orderBy("row")
    return F.least(*[F.abs(F.col(z) - f(F.col(z)).over(w)) for w in (row, column) for f in (F.lag, F.lead)])


def ground_flags(cells: DataFrame, px: tuple[float, float], level: float, tolerance: float, flat: float, foreshore: float, beach: Column) -> DataFrame:
    """cells with water and sand (T32, T33): below the level by 0.1 m, or near it and
    flat, is water; beaches and what lies under the foreshore height are sand."""
    out = cells if "dz" in cells.columns else cells.withColumn("dz", calmest_step())
    near = (F.abs(F.col("z") - level) < tolerance) & (F.col("dz") < flat * min(px))
    out = out.withColumn("water", F.coalesce((F.col("z") < level - 0.1) | near, F.lit(False)))
    return out.withColumn("sand", (F.coalesce(F.col("z") < foreshore, F.lit(False)) | beach) & ~F.col("water"))


def ordered_mean(z: Column | str, *order: str) -> Column:
    """Mean of the values of a small group that are not null, added one by one in this
    order: a sum of doubles depends on it, and so may not follow how rows are dealt."""
    own = F.array_sort(F.collect_list(F.when(col(z).isNotNull(), F.struct(*order, col(z).alias("_z")))))
    return F.aggregate(own, F.lit(0.0), lambda total, x: total + x["_z"]) / F.nullif(F.size(own), F.lit(0))


def class_bands(cells: DataFrame, keys: list[str], fx: int, fy: int) -> DataFrame:
    """Block means of sand, water and rock, made into four bands of 0 to 255, cut
    towards zero (T30). r and c count inside keys."""
    mean = lambda c: F.avg(F.col(c).cast("double"))
    blocks = cells.groupBy(*keys, F.floor(F.col("r") / fy).alias("br"), F.floor(F.col("c") / fx).alias("bc")).agg(
        mean("sand").alias("s"), mean("water").alias("w"), mean("rock").alias("k0")
    )
    clip = lambda x: F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0))
    shaped = blocks.withColumn("k", clip(F.col("k0") * (1.0 - F.col("s") - F.col("w"))))
    shaped = shaped.withColumn("g", clip(1.0 - F.col("s") - F.col("k") - F.col("w")))
    byte = lambda x: F.floor(F.col(x) * 255).cast("int")
    return shaped.select(*keys, "br", "bc", byte("g").alias("grass"), byte("s").alias("sand"), byte("k").alias("rock"), byte("w").alias("water"))


def bilinear(points: DataFrame, key: list[str], cells: DataFrame, shape: DataFrame) -> DataFrame:
    """points (fx, fy in cell units, and columns that name a point) with z: null outside
    the raster and where a neighbour is null (T17). shape: one row of w and h. Every point
    asks for its four cells by an equi-join, and one aggregation per point weighs them; its
    other columns come along as part of its name, so nothing is joined back."""
    rest = [c for c in points.columns if c not in ("fx", "fy")]
    inside = F.coalesce(F.expr("fx BETWEEN 0 AND w - 1 AND fy BETWEEN 0 AND h - 1"), F.lit(False))
    placed = points.join(F.broadcast(shape)).withColumn("x0", F.least(F.floor("fx"), F.col("w") - 2)).withColumn("y0", F.least(F.floor("fy"), F.col("h") - 2))
    corner = lambda i, j: F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), (F.col("x0") + i).alias("col"), (F.col("y0") + j).alias("row"))
    # points outside ask for a cell that is nowhere, spread over many such rows
    nowhere = F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).cast("bigint").alias("col"), (-1 - F.pmod(F.xxhash64(*key), F.lit(1 << 20))).alias("row"))
    asked = placed.select(
        *rest, (F.col("fx") - F.col("x0")).alias("tx"), (F.col("fy") - F.col("y0")).alias("ty"),
        F.explode(F.when(inside, F.array(*[corner(i, j) for j in (0, 1) for i in (0, 1)])).otherwise(F.array(nowhere))).alias("o"),
    ).select(*rest, "tx", "ty", "o.*")
    got = asked.join(cells.filter("z IS NOT NULL").select("row", "col", F.col("z").alias("height")), ["row", "col"], "left")
    at = lambda i, j: F.max(F.when((F.col("i") == i) & (F.col("j") == j), F.col("height")))
    tx, ty = F.col("tx"), F.col("ty")
    value = (at(0, 0) * (1 - tx) + at(1, 0) * tx) * (1 - ty) + (at(0, 1) * (1 - tx) + at(1, 1) * tx) * ty
    return got.groupBy(*rest, "tx", "ty").agg(F.when(F.count("height") == 4, value).alias("z")).drop("tx", "ty")


def nearest_fill(values: np.ndarray, bad: np.ndarray) -> str:
    """Fill bad cells in place from the nearest good one (Euclid, in cells; of equals
    the least row, then column). Exact: per column the nearest good rows, then per row
    the lower envelope over columns by direct comparison in blocks."""
    # fixed values: the names of the ways to fill
    if not bad.any():
        return "none"
    if bad.all():
        values[bad] = 0.0
        return "all-nodata -> 0"
    h, w = values.shape
    rows = np.arange(h)[:, None]
    far = 10 * (h + w)
    up = np.maximum.accumulate(np.where(bad, -far, rows), axis=0)  # nearest good row at or above
    down = np.minimum.accumulate(np.where(bad, far + h, rows)[::-1], axis=0)[::-1]
    take_up = rows - up <= down - rows
    near = np.where(take_up, up, down)
    gap = np.minimum(rows - up, down - rows).astype(np.int64)
    columns = np.arange(w)
    source = values.copy()
    for r in np.flatnonzero(bad.any(axis=1)):
        at = np.flatnonzero(bad[r])
        cost = gap[r][None] ** 2 + (columns[None] - at[:, None]) ** 2
        order = cost * (h + 1) * 2 + near[r][None]  # of equal distances the least row
        best = order.argmin(axis=1)
        values[r, at] = source[near[r][best], best]
    return "nearest"


def fill_tiles(spark: SparkSession, cells: DataFrame, method: str = "nearest") -> DataFrame:
    """tile_x, tile_y, r, c, z, fill, nodata: every tile filled from its own cells (T35,
    T36). A tile is at most 513 x 513 cells, which bounds what one task holds."""
    if method == "median":
        by = Window.partitionBy("tile_x", "tile_y")
        mid = F.coalesce(F.expr("median(z)").over(by), F.lit(0.0))
        whole, some = F.count("z").over(by) == 0, F.count("z").over(by) < F.count(F.lit(1)).over(by)
        name = F.when(whole, "all-nodata -> 0").when(some, "median (degraded)").otherwise("none")
        return cells.select("tile_x", "tile_y", "r", "c", F.coalesce("z", mid).alias("z"), name.alias("fill"), F.col("z").isNull().alias("nodata"))

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        r, c = pdf["r"].to_numpy() - pdf["r"].min(), pdf["c"].to_numpy() - pdf["c"].min()
        grid = np.full((r.max() + 1, c.max() + 1), np.nan)
        grid[r, c] = pdf["z"].to_numpy(dtype=float, na_value=np.nan)
        name = nearest_fill(grid, np.isnan(grid))
        return pdf[["tile_x", "tile_y", "r", "c"]].assign(z=grid[r, c], fill=name, nodata=pdf["z"].isna())

    ship(spark)
    return cells.select("tile_x", "tile_y", "r", "c", "z").groupBy("tile_x", "tile_y").applyInPandas(fill, "tile_x int, tile_y int, r int, c int, z double, fill string, nodata boolean")


def encode_heights(z: Column | str, base: float | Column, size: float | Column) -> Column:
    """0..65535 over the window, half to even; see ``encoding_window`` for refusals."""
    return F.rint(F.least(F.greatest((col(z) - base) / size, F.lit(0.0)), F.lit(1.0)) * 65535.0).cast("int")


def encoding_window(low: float, high: float, margin: float = 5.0, base: float | None = None, size: float | None = None) -> tuple[float, float]:
    """The given window, or one that holds the range with a margin; heights that do not
    fit are refused rather than flattened."""
    if base is None or size is None:
        base = float(np.floor(low - margin))
        size = float(np.ceil(high + margin)) - base
    if low < base or high > base + size:
        raise ValueError(f"heights {low}..{high} do not fit the window {base}..{base + size}")
    return base, size


def splat_bands(bands: DataFrame) -> DataFrame:
    """Three ground bands that use up 255 by adding the rest to grass, water apart."""
    rest = F.least(F.greatest(255 - (F.col("grass") + F.col("sand") + F.col("rock")), F.lit(0)), F.lit(255))
    return bands.withColumn("grass", F.least(F.col("grass") + rest, F.lit(255)))


def flip_rows(row: Column | str, height: int | Column) -> Column:
    return height - 1 - col(row)
