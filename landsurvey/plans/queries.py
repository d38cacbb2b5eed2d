"""One query per operator over the demo views; plans/oracle.py has the SQL twins.

Doubles leave as millionths (whole numbers), the form in which engines agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry, scalar
from ..functions.scalar import micro, tag
from ..operators import furniture, local_axes, massing, polygons, raster, roads, solids, tiles
from . import views as v
from .views import E0, N0, NX, NY, PX, SITE, TILE, TUNING

GRID = ((E0, N0), TILE, NX, NY)
QUERIES: dict = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def micros(df: DataFrame, keep: list[str], *values: str) -> DataFrame:
    return df.select(*keep, *[micro(c).alias(c) for c in values])


# -- filters, tags, projections


@query
def building_filter(spark: SparkSession, sf: str) -> DataFrame:
    return v.footprints(spark, sf).filter("building IS NOT NULL AND building <> 'no'").select("osm_id", "building")


@query
def highway_filter(spark: SparkSession, sf: str) -> DataFrame:
    return roads.select_ways(v.lines(spark, sf), TUNING.width_rows(spark), TUNING).select("id", "cls")


@query
def beach_filter(spark: SparkSession, sf: str) -> DataFrame:
    kinds = v.pick(("beach", "sand", "shingle", "wood", "scrub"), F.col("p_partkey"))
    return v.table(spark, sf, "part").select("p_partkey", kinds.alias("kind")).filter(F.col("kind").isin("beach", "sand", "shingle"))


@query
def coastline_filter(spark: SparkSession, sf: str) -> DataFrame:
    return v.lines(spark, sf).filter(F.col("other_tags").contains('"natural"=>"coastline"')).select("osm_id")


@query
def provenance_counts(spark: SparkSession, sf: str) -> DataFrame:
    b = v.footprints(spark, sf).agg(F.count_if(F.expr("building IS NOT NULL AND building <> 'no'")).alias("buildings"))
    return b.crossJoin(v.lines(spark, sf).agg(F.count("highway").alias("highways")))


@query
def tag_lookup(spark: SparkSession, sf: str) -> DataFrame:
    t = scalar.tag_map("other_tags")
    return v.footprints(spark, sf).select("osm_id", tag("other_tags", "height").alias("height"), tag("other_tags", "roof:shape").alias("roof"), F.try_element_at(t, F.lit("source")).alias("source"))


@query
def osm_id_choice(spark: SparkSession, sf: str) -> DataFrame:
    return v.footprints(spark, sf).select("idx", scalar.first_true("osm_way_id", "rel_id").alias("osm_id"))


@query
def levels_parse(spark: SparkSession, sf: str) -> DataFrame:
    text = F.concat_ws("", v.pick(("", " ", "-", "x", "+"), F.col("p_partkey")), F.col("p_size").cast("string"), v.pick(("", ".9", ";3", "f", " m", "e1"), F.col("p_size")))
    return v.table(spark, sf, "part").select("p_partkey", text.alias("text")).select("p_partkey", scalar.levels("text").alias("levels"), micro(scalar.height_tag("text")).alias("height"))


@query
def amenity_props(spark: SparkSession, sf: str) -> DataFrame:
    return furniture.select_nodes(v.nodes(spark, sf), TUNING.prop_rows(spark)).select("id", "amenity", "prop")


@query
def tile_assign(spark: SparkSession, sf: str) -> DataFrame:
    return v.event_points(spark, sf).select("event_id", scalar.tile_of("e", "n", *GRID).alias("t")).select("event_id", "t.tile_x", "t.tile_y")


@query
def building_tiles(spark: SparkSession, sf: str) -> DataFrame:
    box = v.footprints(spark, sf).select("osm_id", geometry.envelope(F.flatten(F.flatten("polys"))).alias("b"))
    return box.select("osm_id", scalar.tile_of((F.col("b.e0") + F.col("b.e1")) / 2, (F.col("b.n0") + F.col("b.n1")) / 2, *GRID).alias("t")).select("osm_id", "t.tile_x", "t.tile_y")


@query
def carriageway_width(spark: SparkSession, sf: str) -> DataFrame:
    return micros(roads.select_ways(v.lines(spark, sf), TUNING.width_rows(spark), TUNING), ["id", "bridge", "tunnel"], "w", "pav")


@query
def feature_seed(spark: SparkSession, sf: str) -> DataFrame:
    return v.footprints(spark, sf).select("osm_id", scalar.seed("osm_id").alias("seed"))


@query
def footprint_rings(spark: SparkSession, sf: str) -> DataFrame:
    ring = v.footprints(spark, sf).select("osm_id", F.explode(geometry.rings(F.col("polys"))).alias("r"))
    return micros(ring.select("osm_id", "r.hole", F.posexplode("r.pts").alias("q", "p")).select("osm_id", "hole", "q", "p.e", "p.n"), ["osm_id", "hole", "q"], "e", "n")


# -- rasters


@query
def ndsm(spark: SparkSession, sf: str) -> DataFrame:
    cells = v.cells(spark, sf)
    dtm, dsm = cells.select("row", "col", "z"), cells.select("row", "col", F.col("dsm").alias("z")).filter("z IS NOT NULL")
    return micros(raster.height_above_ground(dtm, dsm), ["row", "col"], "ndsm")


@query
def nodata_mask(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col("p_partkey") % 7
    raw = F.when(c == 0, -9999.0000005).when(c == 1, float("nan")).when(c == 2, -1e31).when(c == 3, float("inf")).otherwise(F.col("p_retailprice"))
    return v.table(spark, sf, "part").select("p_partkey", micro(raster.nodata_to_null(raw, -9999.0)).alias("z"))


@query
def slope_site(spark: SparkSession, sf: str) -> DataFrame:
    cells = v.cells(spark, sf).withColumn("z", F.coalesce("z", F.lit(0.0)))
    return micros(raster.slope_degrees(cells, (PX, PX)), ["row", "col"], "slope")


@query
def slope_tile(spark: SparkSession, sf: str) -> DataFrame:
    cells = v.cells(spark, sf).withColumn("z", F.coalesce("z", F.lit(5.0)))
    return micros(raster.slope_degrees(cells, (PX, PX), ["tile_x", "tile_y"]), ["row", "col"], "slope")


@query
def rock_ramp(spark: SparkSession, sf: str) -> DataFrame:
    cells = v.cells(spark, sf).withColumn("z", F.coalesce("z", F.lit(0.0)))
    return raster.slope_degrees(cells, (PX, PX)).select("row", "col", micro(raster.rock_ramp("slope", *SITE.rock_slope)).alias("rock"))


@query
def calmest_neighbour(spark: SparkSession, sf: str) -> DataFrame:
    return micros(v.cells(spark, sf).withColumn("dz", raster.calmest_step()), ["row", "col"], "dz")


def _classed(spark: SparkSession, sf: str) -> DataFrame:
    cells = raster.slope_degrees(v.cells(spark, sf).withColumn("zz", F.coalesce("z", F.lit(0.0))), (PX, PX), z="zz", calm="z")
    cells = cells.withColumn("rock", raster.rock_ramp("slope", *SITE.rock_slope))
    beach = (F.col("row") + F.col("col")) % 11 == 0
    return raster.ground_flags(cells, (PX, PX), SITE.water_level, SITE.water_tolerance, SITE.water_flat_dz_per_m, SITE.foreshore_max, beach)


@query
def water_class(spark: SparkSession, sf: str) -> DataFrame:
    return _classed(spark, sf).select("row", "col", "water", "sand")


@query
def area_accounting(spark: SparkSession, sf: str) -> DataFrame:
    return _classed(spark, sf).agg(micro(tiles.hectares("water", PX * PX)).alias("water_ha"), micro(tiles.hectares("sand", PX * PX)).alias("sand_ha"))


@query
def block_downsample(spark: SparkSession, sf: str) -> DataFrame:
    mean = v.cells(spark, sf).groupBy("tile_x", "tile_y", F.floor(F.col("r") / 2).alias("br"), F.floor(F.col("c") / 2).alias("bc")).agg(raster.ordered_mean("z", "row", "col").alias("z"))
    return micros(mean, ["tile_x", "tile_y", "br", "bc"], "z")


def _bands(spark: SparkSession, sf: str) -> DataFrame:
    return raster.class_bands(_classed(spark, sf), ["tile_x", "tile_y"], 2, 2)


@query
def class_compose(spark: SparkSession, sf: str) -> DataFrame:
    return _bands(spark, sf)


@query
def alphamap(spark: SparkSession, sf: str) -> DataFrame:
    return raster.splat_bands(_bands(spark, sf)).withColumn("br", raster.flip_rows("br", TUNING.class_res))


@query
def water_tiles(spark: SparkSession, sf: str) -> DataFrame:
    return tiles.water_tiles(v.cells(spark, sf), v.every_tile(spark, sf), SITE.water_level, SITE.water_margin, True)


@query
def missing_tiles_anti(spark: SparkSession, sf: str) -> DataFrame:
    return tiles.missing(tiles.grid(spark, NX, NY + 3), tiles.covered(v.cells(spark, sf)))


@query
def fill_median(spark: SparkSession, sf: str) -> DataFrame:
    return micros(raster.fill_tiles(spark, v.cells(spark, sf), "median"), ["tile_x", "tile_y", "r", "c", "fill"], "z")


@query
def fill_nearest(spark: SparkSession, sf: str) -> DataFrame:
    return micros(raster.fill_tiles(spark, v.cells(spark, sf)), ["tile_x", "tile_y", "r", "c", "fill"], "z")


@query
def tile_stats(spark: SparkSession, sf: str) -> DataFrame:
    cells = v.cells(spark, sf).withColumn("nodata", F.col("z").isNull()).withColumn("z", F.coalesce("z", F.lit(5.0)))
    stats = tiles.terrain_stats(raster.slope_degrees(cells, (PX, PX), ["tile_x", "tile_y"]))
    return micros(stats, ["tile_x", "tile_y", "nodata_cells", "over_45"], "min_m", "max_m", "slope_max", "slope_p99")


@query
def height_encode(spark: SparkSession, sf: str) -> DataFrame:
    cells = v.cells(spark, sf).filter("z IS NOT NULL")
    window = cells.agg(F.floor(F.min("z") - 5.0).cast("double").alias("base"), F.ceil(F.max("z") + 5.0).cast("double").alias("top"))
    code = raster.encode_heights("z", F.col("base"), F.col("top") - F.col("base"))
    return cells.join(F.broadcast(window)).select(raster.flip_rows("r", 32).alias("r"), "c", "tile_x", "tile_y", code.alias("code"))


@query
def mosaic_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    cells = v.cells(spark, sf)
    west = cells.withColumn("tile_name", F.concat(F.lit("x"), F.col("tile_x").cast("string")))
    east = west.filter("c = 0 AND tile_x > 0").withColumn("tile_name", F.concat(F.lit("x"), (F.col("tile_x") - 1).cast("string"))).withColumn("z", F.col("dsm"))
    return micros(raster.mosaic(west.select("tile_name", "row", "col", "e", "n", "z").unionByName(east.select("tile_name", "row", "col", "e", "n", "z"))), ["row", "col"], "z")


def _polygons(spark: SparkSession, sf: str) -> DataFrame:
    return v.footprints(spark, sf).select("idx", F.flatten(F.transform("polys", lambda p: F.transform(p, lambda r: r))).alias("rings"))


@query
def polygon_raster(spark: SparkSession, sf: str) -> DataFrame:
    return polygons.rasterise_all(_polygons(spark, sf), (E0, N0), 4.0, 2.0)


@query
def mask_burn(spark: SparkSession, sf: str) -> DataFrame:
    cells = v.cells(spark, sf).select(F.col("col").cast("bigint").alias("cx"), F.floor((F.col("n") - N0) / PX).alias("cy"), "row", "col")
    return polygons.burn(cells, _polygons(spark, sf), (E0, N0), PX).select("row", "col")


# -- buildings


@query
def zonal_stats(spark: SparkSession, sf: str) -> DataFrame:
    return micros(massing.zonal(v.pixels(spark, sf)), ["idx", "npx"], "p25", "p50", "p90", "d15", "dmin")


def _evidence(spark: SparkSession, sf: str) -> DataFrame:
    return massing.evidence(v.footprints(spark, sf).filter("building IS NOT NULL AND building <> 'no'"), massing.zonal(v.pixels(spark, sf)))


def _ladder(spark: SparkSession, sf: str) -> DataFrame:
    rows = _evidence(spark, sf)
    line = massing.calibrate(rows, TUNING, SITE.calibration)
    return massing.ladder(rows, line, TUNING.prior_rows(spark), SITE.landmark_rows(spark), TUNING, SITE.calibration.dispute)


@query
def gap_classes(spark: SparkSession, sf: str) -> DataFrame:
    return _evidence(spark, sf).select("osm_id", "gap", "levels")


@query
def height_calibration(spark: SparkSession, sf: str) -> DataFrame:
    return micros(massing.calibrate(_evidence(spark, sf), TUNING, SITE.calibration), ["source", "n", "rejected"], "intercept", "m_per_level", "rmse")


@query
def height_ladder(spark: SparkSession, sf: str) -> DataFrame:
    return micros(_ladder(spark, sf), ["osm_id", "src", "roof"], "h")


@query
def building_records(spark: SparkSession, sf: str) -> DataFrame:
    keep = ["id", "name", "type", "lidar_px", "levels", "roof", "src", "seed"]
    return micros(massing.records(_ladder(spark, sf), TUNING), keep, "h", "ridge", "eaves", "base_z", "skirt")


@query
def height_source_hist(spark: SparkSession, sf: str) -> DataFrame:
    return massing.source_shares(_ladder(spark, sf)).select("src", "buildings", "warn", micro("share").alias("share"))


@query
def qa_outliers(spark: SparkSession, sf: str) -> DataFrame:
    return micros(massing.outliers(_evidence(spark, sf), TUNING), ["osm_id", "name", "px"], "p50", "p90")


@query
def massing_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return _ladder(spark, sf).agg(
        F.count(F.lit(1)).alias("buildings"), F.count_if(F.expr("gap = 'no_lidar'")).alias("without_lidar"), F.count_if(F.expr("gap = 'no_dsm'")).alias("without_dsm"),
        F.count_if(F.expr("src = 'landmark_override'")).alias("landmark_overrides"),
    )


# -- roads


def _ways(spark: SparkSession, sf: str) -> DataFrame:
    return roads.select_ways(v.lines(spark, sf), TUNING.width_rows(spark), TUNING)


def _points(ways: DataFrame) -> DataFrame:
    return ways.select("id", F.posexplode("pts").alias("q", "p")).select("id", "q", micro("p.e").alias("e"), micro("p.n").alias("n"))


@query
def densify(spark: SparkSession, sf: str) -> DataFrame:
    return _points(_ways(spark, sf).withColumn("pts", geometry.densify(F.col("pts"), TUNING.densify_step)))


@query
def chaikin(spark: SparkSession, sf: str) -> DataFrame:
    return _points(_ways(spark, sf).withColumn("pts", geometry.chaikin(F.col("pts"), 2)))


@query
def polyline_length(spark: SparkSession, sf: str) -> DataFrame:
    return _ways(spark, sf).select("id", micro(geometry.length(F.col("pts"))).alias("metres"))


@query
def endpoint_degree(spark: SparkSession, sf: str) -> DataFrame:
    return micros(roads.degrees(_ways(spark, sf)), ["ke", "kn", "ways"], "w")


@query
def junctions(spark: SparkSession, sf: str) -> DataFrame:
    snapped = _ways(spark, sf).withColumn("pts", F.transform("pts", lambda p: geometry.point(F.floor(p["e"] / 200) * 200.0, F.floor(p["n"] / 200) * 200.0)))
    return micros(roads.junctions(snapped, TUNING), [], "e", "n", "r")


def _draped(spark: SparkSession, sf: str) -> DataFrame:
    """id, q, e, n, tile and z of densified ways."""
    ways = _ways(spark, sf).withColumn("pts", geometry.densify(F.col("pts"), TUNING.densify_step))
    points = roads.vertices(ways, *GRID)
    shape = v.shape(spark, sf)
    across = F.when(F.col("tile").isNotNull(), (F.col("e") - E0) / PX)
    top = points.join(F.broadcast(shape.select("h"))).withColumn("fx", across).withColumn("fy", F.col("h") - 1 - (F.col("n") - N0) / PX).drop("h")
    return raster.bilinear(top, ["id", "q"], v.cells(spark, sf), shape)


@query
def bilinear_drape(spark: SparkSession, sf: str) -> DataFrame:
    return micros(_draped(spark, sf), ["id", "q"], "z")


@query
def gap_fill(spark: SparkSession, sf: str) -> DataFrame:
    return micros(roads.fill_gaps(_draped(spark, sf)), ["id", "q"], "zf")


@query
def tile_split(spark: SparkSession, sf: str) -> DataFrame:
    runs = roads.split_by_tile(roads.fill_gaps(_draped(spark, sf)))
    rows = runs.select("id", "rid", "tile.tile_x", "tile.tile_y", "z_gap", F.posexplode("vertices").alias("k", "p")).select("*", "p.e", "p.n", "p.z")
    return micros(rows, ["id", "rid", "tile_x", "tile_y", "z_gap", "k"], "e", "n", "z")


@query
def segment_junction_union(spark: SparkSession, sf: str) -> DataFrame:
    ways = _ways(spark, sf).select("cls", "id", micro("w").alias("w"))
    discs = roads.degrees(_ways(spark, sf)).select(F.lit("_junction").alias("cls"), micro(F.col("w") / 2 + TUNING.junction_margin).alias("r"))
    return ways.unionByName(discs, allowMissingColumns=True)


@query
def coastline_clip(spark: SparkSession, sf: str) -> DataFrame:
    coast = v.lines(spark, sf).filter(F.col("other_tags").contains('"natural"=>"coastline"')).select(F.col("osm_id").alias("line"), F.posexplode("pts").alias("q", "p"))
    pieces = furniture.segments(coast.select("line", "q", "p.e", "p.n", F.lit(0.0).alias("z")))
    inside = geometry.clipped_length(*[F.col(c) for c in ("ae", "an", "be", "bn")], E0, N0, E0 + NX * TILE, N0 + NY * TILE)
    whole = F.sqrt((F.col("be") - F.col("ae")) * (F.col("be") - F.col("ae")) + (F.col("bn") - F.col("an")) * (F.col("bn") - F.col("an")))
    return micros(pieces.groupBy("line").agg(F.sum(whole).alias("raw_m"), F.sum(inside).alias("clipped_m")), ["line"], "raw_m", "clipped_m")


# -- furniture


def _found(spark: SparkSession, sf: str) -> DataFrame:
    ways = _ways(spark, sf).withColumn("pts", geometry.densify(F.col("pts"), TUNING.densify_step))
    level = roads.vertices(ways, *GRID).select(F.col("id").alias("line"), "q", "e", "n", ((F.col("e") - E0) * 0.02 + 5).alias("z"))
    nodes = furniture.select_nodes(v.nodes(spark, sf), TUNING.prop_rows(spark)).select(F.col("id").cast("string").alias("id"), "e", "n")
    return furniture.nearest(nodes, furniture.segments(level), (E0, N0), TILE, TUNING.snap, TUNING.densify_step)


@query
def nearest_road(spark: SparkSession, sf: str) -> DataFrame:
    return _found(spark, sf).select("id", F.col("road.line").alias("line"), F.col("road.q").alias("q"), micro("road.d").alias("d"))


def _placed(spark: SparkSession, sf: str) -> DataFrame:
    return furniture.place(_found(spark, sf), _ways(spark, sf).select(F.col("id").alias("line"), "w", "pav", "cls"), TUNING)


@query
def furniture_place(spark: SparkSession, sf: str) -> DataFrame:
    return micros(_placed(spark, sf), ["id", "src", "cls", "nudged"], "e", "n", "z", "bearing", "d")


@query
def local_furniture(spark: SparkSession, sf: str) -> DataFrame:
    return micros(local_axes.furniture(_placed(spark, sf), (E0, N0)), ["id"], "x", "y", "z", "yaw")


# -- local axes, tiles, counts


@query
def local_yup_roads(spark: SparkSession, sf: str) -> DataFrame:
    flat = F.transform("pts", lambda p: F.array(p["e"], p["n"], (p["e"] - E0) * 0.02))
    moved = local_axes.roads(_ways(spark, sf).withColumn("pts", flat).withColumn("z_gap", F.lit(False)), (E0, N0))
    at = lambda k: micro(F.element_at("p", k))
    return moved.select("id", F.posexplode("pts").alias("q", "p")).select("id", "q", at(1).alias("x"), at(2).alias("y"), at(3).alias("z"))


@query
def local_rings(spark: SparkSession, sf: str) -> DataFrame:
    rows = v.footprints(spark, sf).withColumn("rings", geometry.rings(F.col("polys"))).withColumn("base_z", F.lit(0.0))
    moved = local_axes.buildings(rows, (E0, N0)).select("osm_id", F.explode("rings").alias("r"))
    return moved.select("osm_id", "r.hole", F.posexplode("r.pts").alias("q", "p")).select("osm_id", "hole", "q", micro(F.element_at("p", 1)).alias("x"), micro(F.element_at("p", 2)).alias("z"))


@query
def fetch_jobs(spark: SparkSession, sf: str) -> DataFrame:
    return tiles.fetch_jobs(spark, ["dtm", "dsm"], NX, NY)


@query
def status_hist(spark: SparkSession, sf: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "ok").when(F.col("o_orderstatus") == "O", "EMPTY").otherwise("BAD")
    return tiles.status_counts(v.table(spark, sf, "orders").select(status.alias("status")))


@query
def topk_kinds(spark: SparkSession, sf: str) -> DataFrame:
    return tiles.most_common(v.footprints(spark, sf).filter("building IS NOT NULL"), "building", 4)


@query
def ring_outline(spark: SparkSession, sf: str) -> DataFrame:
    return micros(solids.arc_length(solids.superellipse(spark, 0.25, 3.0, 0.9, 48)), ["k"], "x", "y", "u")


__all__ = ["QUERIES"]
