"""A whole site: from rasters and vector layers to records, bands and manifests.

``build`` only declares; jobs start at a sink. ``STEPS`` names the products in
order of their dependencies for runs of a part.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Site, Tuning, tile_pixels
from ..functions import geometry, scalar
from ..operators import furniture, massing, polygons, raster, roads, tiles
from ..sources import files, records, tiff
from . import manifests

STEPS = ("terrain", "networks", "massing", "ground", "furniture")
MANIFESTS = {
    "terrain": "terrain_manifest.json", "networks": "networks_manifest.json", "massing": "massing_manifest.json", "ground": "coast_manifest.json",
    "furniture": "furniture_manifest.json",
}


@dataclass
class Inputs:
    """dtm, dsm: row (0 north), col, e, n, z. lines: osm_id, highway, name, other_tags,
    pts. areas: idx, osm_id, building, name, levels_tag, natural, other_tags, polys.
    points: id, name, other_tags, e, n (amenity if there is one)."""

    dtm: DataFrame
    dsm: DataFrame
    lines: DataFrame
    areas: DataFrame
    points: DataFrame
    px: float


class Build:
    def __init__(self, spark: SparkSession, site: Site, tuning: Tuning, inputs: Inputs):
        self.spark, self.site, self.tuning, self.inputs = spark, site, tuning, inputs
        self.grid = (site.origin, site.tile, site.nx, site.ny)
        self.held: list[DataFrame] = []  # persisted until ``release``
        self.side = round(site.tile / inputs.px)
        e0, n0 = site.origin
        up = F.round((F.col("n") - n0) / inputs.px).cast("int")
        across = F.round((F.col("e") - e0) / inputs.px).cast("int")
        # a tile holds the cells from its west and south edge on
        self.cells = inputs.dtm.select(
            "*", F.floor(across / self.side).cast("int").alias("tile_x"), F.floor(up / self.side).cast("int").alias("tile_y"),
            (self.side - 1 - F.pmod(up, F.lit(self.side))).alias("r"), F.pmod(across, F.lit(self.side)).alias("c"),
        )
        self.shape = inputs.dtm.agg((F.max("col") + 1).alias("w"), (F.max("row") + 1).alias("h"))
        self.inside = F.col("tile_x").between(0, site.nx - 1) & F.col("tile_y").between(0, site.ny - 1)

    def ground_at(self, points: DataFrame, key: list[str]) -> DataFrame:
        """points (key, e, n) with z."""
        e0 = self.inputs.dtm.agg(F.min("e").alias("west"), F.max("n").alias("north"))
        across, down = (F.col("e") - F.col("west")) / self.inputs.px, (F.col("north") - F.col("n")) / self.inputs.px
        at = points.join(F.broadcast(e0)).select(*points.columns, across.alias("fx"), down.alias("fy"))
        return raster.bilinear(at, key, self.inputs.dtm, self.shape)

    def terrain(self) -> DataFrame:
        filled = raster.fill_tiles(self.spark, self.cells.filter(self.inside))
        cells = filled.withColumnRenamed("r", "row").withColumnRenamed("c", "col")
        return tiles.terrain_stats(raster.slope_degrees(cells, (self.inputs.px,) * 2, ["tile_x", "tile_y"]))

    def ways(self) -> DataFrame:
        return roads.select_ways(self.inputs.lines, self.tuning.width_rows(self.spark), self.tuning)

    def networks(self) -> DataFrame:
        """Road segments and junction discs, told apart by cls."""
        ways = self.ways()
        points = roads.vertices(roads.smooth(ways, self.tuning), *self.grid)
        draped = roads.fill_gaps(self.ground_at(points, ["id", "q"]))
        segments = roads.road_records(ways, roads.split_by_tile(draped))
        discs = roads.junctions(ways, self.tuning).withColumn("tile", scalar.tile_of("e", "n", *self.grid)).filter("tile IS NOT NULL")
        discs = self.ground_at(discs, ["e", "n"]).select(
            "tile.tile_x", "tile.tile_y", F.lit("_junction").alias("cls"), "r", F.array(F.array("e", "n", F.coalesce("z", F.lit(0.0)))).alias("pts")
        )
        return segments.unionByName(discs, allowMissingColumns=True)

    def numbered(self, cells: DataFrame) -> DataFrame:
        """cells with cx, cy: their place from the site's origin."""
        e0, n0 = self.site.origin
        place = lambda c, o: F.round((F.col(c) - o) / self.inputs.px).cast("bigint")
        return cells.withColumns({"cx": place("e", e0), "cy": place("n", n0)})

    def footprints(self) -> DataFrame:
        return self.inputs.areas.filter("building IS NOT NULL AND building <> 'no'")

    def heights(self) -> DataFrame:
        feet = self.footprints()
        shapes = feet.select("idx", F.flatten("polys").alias("rings"))
        cells = polygons.rasterise_all(shapes, self.site.origin, self.inputs.px, self.inputs.px / 2)
        # cells of footprints first, which are few, and then their heights
        ground = self.numbered(self.inputs.dtm).select("cx", "cy", F.col("z").cast("double").alias("dtm"))
        top = self.numbered(self.inputs.dsm).select("cx", "cy", F.col("z").cast("double").alias("dsm"))
        pixels = cells.join(ground, ["cx", "cy"]).join(top, ["cx", "cy"], "left").select("idx", (F.col("dsm") - F.col("dtm")).alias("ndsm"), "dtm")
        # one row a footprint, read by the fit, its second pass and the ladder
        self.held.append(massing.zonal(pixels).persist())
        rows = massing.evidence(feet, self.held[-1])
        line = massing.calibrate(rows, self.tuning, self.site.calibration)
        marks = self.site.landmark_rows(self.spark)
        return massing.ladder(rows, line, self.tuning.prior_rows(self.spark), marks, self.tuning, self.site.calibration.dispute)

    def massing(self) -> DataFrame:
        rows = self.heights()
        box = geometry.envelope(F.flatten(F.flatten("polys")))
        placed = rows.withColumn("b", box).withColumn("tile", scalar.tile_of((F.col("b.e0") + F.col("b.e1")) / 2, (F.col("b.n0") + F.col("b.n1")) / 2, *self.grid))
        out = placed.filter("tile IS NOT NULL")
        shape = out.select(F.col("osm_id").alias("id"), "tile.tile_x", "tile.tile_y", geometry.rings(F.col("polys")).alias("rings"))
        return massing.records(out, self.tuning).join(shape, "id")

    def ground(self) -> DataFrame:
        site, px = self.site, self.inputs.px
        zero = raster.slope_degrees(self.cells.withColumn("zz", F.coalesce("z", F.lit(0.0))), (px, px), z="zz", calm="z")
        cells = self.numbered(zero.withColumn("rock", raster.rock_ramp("slope", *site.rock_slope)))
        beach = self.inputs.areas.filter(F.col("natural").isin("beach", "sand", "shingle")).select("idx", F.flatten("polys").alias("rings"))
        sandy = polygons.judged(beach, site.origin, px).filter("inside").select("cx", "cy").distinct().withColumn("beach", F.lit(True))
        cells = cells.join(sandy, ["cx", "cy"], "left").withColumn("beach", F.coalesce("beach", F.lit(False)))
        flags = raster.ground_flags(cells, (px, px), site.water_level, site.water_tolerance, site.water_flat_dz_per_m, site.foreshore_max, F.col("beach"))
        block = self.side // self.tuning.class_res
        covered = tiles.covered(self.cells.filter(self.inside)).select("tile_x", "tile_y")
        return raster.class_bands(flags.filter(self.inside).join(covered, ["tile_x", "tile_y"], "left_semi"), ["tile_x", "tile_y"], block, block)

    def furniture(self, networks: DataFrame | None = None) -> DataFrame:
        """Placements against the segments of networks, each a line of its own."""
        net = (networks if networks is not None else self.networks()).filter("cls <> '_junction'")
        rows = net.withColumn("line", F.concat_ws("/", F.lpad(F.col("tile_x").cast("string"), 4, "0"), F.lpad(F.col("tile_y").cast("string"), 4, "0"), "id", F.md5(F.to_json("pts"))))
        at = lambda k: F.element_at("p", k)
        points = rows.select("line", F.posexplode("pts").alias("q", "p")).select("line", "q", at(1).alias("e"), at(2).alias("n"), at(3).alias("z"))
        nodes = furniture.select_nodes(self.inputs.points, self.tuning.prop_rows(self.spark))
        here = nodes.withColumn("tile", scalar.tile_of("e", "n", *self.grid)).filter("tile IS NOT NULL")
        found = furniture.nearest(here.select("id", "e", "n"), furniture.segments(points), self.site.origin, self.site.tile, self.tuning.snap, self.tuning.densify_step)
        placed = furniture.place(found, rows.select("line", "w", "pav", "cls"), self.tuning)
        return placed.join(here.select("id", "prop", "name", "tile.tile_x", "tile.tile_y"), "id")

    def products(self, only: str | None = None) -> dict[str, DataFrame]:
        return {s: getattr(self, s)() for s in self.steps(only)}

    @staticmethod
    def steps(only: str | None = None, start: str | None = None) -> list[str]:
        """The names of the steps to run, in order: one, or all from start on."""
        for name in (only, start):
            if name is not None and name not in STEPS:
                raise ValueError(f"no step {name!r}; there are {', '.join(STEPS)}")
        return [only] if only else list(STEPS[STEPS.index(start) if start else 0 :])

    def preflight(self) -> list[str]:
        """What is missing or would make every product empty, before any work."""
        found = []
        for name, needed in {"lines": "osm_id highway pts", "areas": "idx osm_id building polys", "points": "id e n", "dtm": "row col e n z", "dsm": "row col e n z"}.items():
            df = getattr(self.inputs, name)
            found += [f"{name} has no column {c}" for c in needed.split() if c not in df.columns]
            found += [f"{name} is empty"] if df.isEmpty() else []
        tile_pixels(self.site, (0.0, self.inputs.px, 0.0, 0.0, 0.0, -self.inputs.px), self.tuning.class_res)
        return found

    def write(self, path: str, only: str | None = None, start: str | None = None) -> dict[str, dict]:
        """Products by tile, their rasters, manifests and a log of times and warnings, old
        ones replaced. Returns the log by step."""
        order = {"terrain": ["min_m"], "networks": ["cls"], "massing": ["id"], "ground": ["br", "bc"], "furniture": ["id"]}
        log: dict[str, dict] = {}
        networks = None
        for name in self.steps(only, start):
            began = time.perf_counter()
            df = self.furniture(networks) if name == "furniture" else getattr(self, name)()
            records.write_tiles(df, f"{path}/{name}", order[name], 2)
            back = self.spark.read.schema(df.schema).json(f"{path}/{name}")
            networks = back if name == "networks" else networks  # furniture reads what was written
            facts = {"rows": F.count(F.lit(1)), "tiles": F.count_distinct("tile_x", "tile_y"), "site": F.lit(self.site.name), "crs": F.lit(self.site.crs), "tile_m": F.lit(self.site.tile)}
            back.agg(records.manifest(**facts)).coalesce(1).write.mode("overwrite").text(f"{path}/{name}_manifest")
            said = getattr(self, f"_finish_{name}")(path, back)
            files.put(self.spark, f"{path}/{MANIFESTS[name]}", manifests.written(said))
            self.release()
            log[name] = {"seconds": round(time.perf_counter() - began, 2), "warnings": manifests.warnings(name, said, len(self.site.landmarks))}
        files.put(self.spark, f"{path}/run_log.json", manifests.written(log))
        return log

    def release(self) -> None:
        """Let go what products keep for their several readings."""
        while self.held:
            self.held.pop().unpersist()

    def _finish_terrain(self, path: str, back: DataFrame) -> dict:
        cells = raster.fill_tiles(self.spark, self.cells.filter(self.inside))
        e0, n0 = self.site.origin
        t, px = self.site.tile, self.inputs.px
        corner = lambda x, y: (e0 + x * t - px / 2, px, 0.0, n0 + (y + 1) * t - px / 2, 0.0, -px)
        images = tiff.tile_images(self.spark, cells, ["z"], "float32", corner)
        files.put_all(self.spark, _named(images, "dtm_x%d_y%d.tif"), f"{path}/terrain_tif")
        fills = cells.groupBy("tile_x", "tile_y").agg(F.max("fill").alias("fill"))
        missing = tiles.missing(tiles.grid(self.spark, self.site.nx, self.site.ny), back)
        return manifests.terrain(self.site, back.join(fills, ["tile_x", "tile_y"]), missing, self.side, self.side)

    def _finish_networks(self, path: str, back: DataFrame) -> dict:
        ways = self.ways()
        points = self.ground_at(roads.vertices(roads.smooth(ways, self.tuning), *self.grid), ["id", "q"])
        return manifests.networks(self.site, self.tuning, back, points, ways.agg(F.sum(geometry.length(F.col("pts")))))

    def _finish_massing(self, path: str, back: DataFrame) -> dict:
        rows = self.heights()
        box = geometry.envelope(F.flatten(F.flatten("polys")))
        rows = rows.withColumn("b", box).withColumn("tile", scalar.tile_of((F.col("b.e0") + F.col("b.e1")) / 2, (F.col("b.n0") + F.col("b.n1")) / 2, *self.grid))
        odd = records.rounded(self.spark, massing.outliers(rows.filter("tile IS NOT NULL"), self.tuning))
        odd.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/qa_height_outliers")
        flagged = self.spark.read.schema(odd.schema).json(f"{path}/qa_height_outliers").count()
        line = massing.calibrate(rows, self.tuning, self.site.calibration)
        return manifests.massing(self.site, rows, line, flagged)

    def _finish_ground(self, path: str, back: DataFrame) -> dict:
        e0, n0 = self.site.origin
        t, cell = self.site.tile, self.site.tile / self.tuning.class_res
        shaped = back.select("tile_x", "tile_y", F.col("br").cast("int").alias("r"), F.col("bc").cast("int").alias("c"), "grass", "sand", "rock", "water")
        images = tiff.tile_images(self.spark, shaped, ["grass", "sand", "rock", "water"], "uint8", lambda x, y: (e0 + x * t, cell, 0.0, n0 + (y + 1) * t, 0.0, -cell))
        files.put_all(self.spark, _named(images, "ground_x%d_y%d.tif"), f"{path}/ground_tif")
        every, inside = tiles.grid(self.spark, self.site.nx, self.site.ny), self.cells.filter(self.inside)
        water = tiles.water_tiles(inside, every, self.site.water_level, self.site.water_margin, self.site.missing_tiles_are_water)
        coast = self.inputs.lines.filter(scalar.tag("other_tags", "natural") == "coastline").select(F.col("osm_id").alias("line"), F.posexplode("pts").alias("q", "p"))
        pieces = furniture.segments(coast.select("line", "q", "p.e", "p.n", F.lit(0.0).alias("z")))
        inside_m = geometry.clipped_length(*[F.col(c) for c in ("ae", "an", "be", "bn")], e0, n0, e0 + self.site.nx * t, n0 + self.site.ny * t)
        metres = pieces.agg(F.sum(inside_m)).first()[0] or 0.0
        return manifests.ground(self.site, self.tuning, water, tiles.missing(every, tiles.covered(inside)), metres)

    def _finish_furniture(self, path: str, back: DataFrame) -> dict:
        points = self.inputs.points
        kind = scalar.first_true("amenity", scalar.tag("other_tags", "amenity")) if "amenity" in points.columns else scalar.tag("other_tags", "amenity")
        kinds = manifests.counts(points.select(kind.alias("amenity")).filter("amenity IS NOT NULL"), "amenity", 12)
        nodes = furniture.select_nodes(points, self.tuning.prop_rows(self.spark)).withColumn("tile", scalar.tile_of("e", "n", *self.grid))
        return manifests.furniture(self.site, self.tuning, back, nodes, kinds)


def _named(images: DataFrame, pattern: str) -> DataFrame:
    return images.select(F.format_string(pattern, "tile_x", "tile_y").alias("name"), F.col("image").alias("content"))
