"""Adapters: from a site's neutral products to a consumer's conventions.

An adapter is anything with ``apply(products) -> products``; a new consumer is a
new class beside this one, and nothing before it changes.
"""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Site
from ..operators import local_axes, raster


class Adapter(Protocol):
    def apply(self, products: dict[str, DataFrame]) -> dict[str, DataFrame]: ...


class LocalAxes:
    """Local origin, y up, south-first rows, 16-bit heights over one window for the site."""

    def __init__(self, site: Site, margin: float = 5.0, window: tuple[float, float] | None = None):
        self.site, self.margin, self.given = site, margin, window

    def window(self, cells: DataFrame) -> tuple[float, float]:
        """Base and size of the height window; ground outside it is refused."""
        low, high = cells.agg(F.min("z"), F.max("z")).first()
        return raster.encoding_window(low, high, self.margin, *(self.given or (None, None)))

    def heights(self, cells: DataFrame, rows: int) -> DataFrame:
        base, size = self.window(cells)
        return cells.select("tile_x", "tile_y", raster.flip_rows("r", rows).alias("r"), "c", raster.encode_heights("z", base, size).alias("code"))

    def ground(self, bands: DataFrame, rows: int) -> DataFrame:
        return raster.splat_bands(bands).withColumn("br", raster.flip_rows("br", rows))

    def roads(self, networks: DataFrame) -> DataFrame:
        lines = local_axes.roads(networks.filter("cls <> '_junction'"), self.site.origin)
        discs = networks.filter("cls = '_junction'")
        moved = local_axes.local_points(F.col("pts"), self.site.origin, F.lit(local_axes.JUNCTION_LIFT))
        return lines.unionByName(discs.select("tile_x", "tile_y", "cls", "r", moved.alias("pts")), allowMissingColumns=True)

    def apply(self, products: dict[str, DataFrame]) -> dict[str, DataFrame]:
        out = {}
        if "networks" in products:
            out["networks"] = self.roads(products["networks"])
        if "massing" in products:
            out["massing"] = local_axes.buildings(products["massing"], self.site.origin)
        if "furniture" in products:
            out["furniture"] = local_axes.furniture(products["furniture"], self.site.origin)
        if "ground" in products:
            out["ground"] = self.ground(products["ground"], products["ground"].agg(F.max("br")).first()[0] + 1)
        return out


def flat_tiles(tiles: DataFrame) -> DataFrame:
    """One row: x, y, x, y, ... of the tiles in order, as engines read lists. Tiles are
    as many as the grid has."""
    pairs = F.array_sort(F.collect_list(F.struct("tile_x", "tile_y")))
    return tiles.agg(F.flatten(F.transform(pairs, lambda p: F.array(p["tile_x"], p["tile_y"]))).alias("tiles"))
