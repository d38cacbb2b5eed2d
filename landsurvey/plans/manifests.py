"""Manifests of a site's products: what was made, from what, and what to distrust.

Each function returns one row of named facts. Only counts and lists of tiles, which
the grid bounds, come together; warnings are derived from the facts.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Site, Tuning
from ..sources.records import listed


def _head(site: Site) -> dict:
    return {"site": site.name, "crs": site.crs, "origin": list(site.origin), "tile_m": site.tile}


def facts(df: DataFrame) -> dict:
    """The one row of df as plain values."""
    return json.loads(df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).first()[0])


def counts(df: DataFrame, key: str, most: int | None = None) -> dict:
    """Rows by value of a column of few values, most common first."""
    found = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), key)
    return {r[key]: r["n"] for r in (found.limit(most) if most else found).collect()}


def tile_pairs(df: DataFrame) -> list[list[int]]:
    return sorted([r.tile_x, r.tile_y] for r in df.select("tile_x", "tile_y").distinct().collect())


def terrain(site: Site, stats: DataFrame, missing: DataFrame, res: int, side: int) -> dict:
    """stats: one row a tile; res: cells along its edge; side: the same without what it shares."""
    tile = stats.select(
        F.col("tile_x").alias("x"), F.col("tile_y").alias("y"), F.format_string("dtm_x%d_y%d.tif", "tile_x", "tile_y").alias("file"),
        F.round("min_m", 2).alias("min_m"), F.round("max_m", 2).alias("max_m"), "nodata_cells", "fill",
        F.round("slope_max", 1).alias("slope_max_deg"), F.round("slope_p99", 1).alias("slope_p99_deg"), F.col("over_45").alias("cells_over_45deg"),
    )
    names = tile.columns
    found = facts(tile.agg(F.min("min_m").alias("low"), F.max("max_m").alias("high"), F.max("slope_max_deg").alias("steepest"), F.sum("cells_over_45deg").alias("over"), listed(names, ["x", "y"]).alias("tiles")))
    cells = max(1, len(found["tiles"]) * side * side)
    return _head(site) | {
        "res": res, "elevation_units": "metres", "range_m": [found["low"], found["high"]],
        "slope_qa": {"max_deg": found["steepest"], "pct_cells_over_45deg": round(100.0 * (found["over"] or 0) / cells, 3)},
        "tiles": found["tiles"], "tiles_missing": tile_pairs(missing),
    }


def networks(site: Site, tuning: Tuning, records: DataFrame, vertices: DataFrame, length: DataFrame) -> dict:
    """records as written; vertices: every smoothed vertex with tile and z; length: one row, metres."""
    disc = F.col("cls") == "_junction"
    made = facts(records.agg(F.count(F.lit(1)).alias("segments"), F.count_distinct("tile_x", "tile_y").alias("tiles"), F.count_if(disc).alias("junctions")))
    lost = facts(vertices.agg(F.count_if(F.col("tile").isNotNull() & F.col("z").isNull()).alias("vertices_without_dtm"), F.count_if(F.col("tile").isNull()).alias("vertices_outside_grid")))
    metres = length.first()[0] or 0.0
    return _head(site) | {
        "coordinates": "[easting, northing, elevation] in CRS metres", **made, "length_km": round(metres / 1000, 2),
        "smoothing": {"densify_step_m": tuning.densify_step, "chaikin_iters": tuning.chaikin_iters},
        "widths_m": {k: list(v) for k, v in tuning.widths.items()}, **lost,
    }


def massing(site: Site, heights: DataFrame, line: DataFrame, flagged: int) -> dict:
    """heights: every footprint with src, gap and tile (null off the grid)."""
    inside = heights.filter("tile IS NOT NULL")
    fit = facts(line)
    found = facts(inside.agg(
        F.count(F.lit(1)).alias("buildings"), F.count_distinct("tile").alias("tiles"), F.count_if(F.col("src") == "landmark_override").alias("landmark_overrides"),
        F.count_if(F.col("gap") == "no_lidar").alias("buildings_without_lidar"), F.count_if(F.col("gap") == "no_dsm").alias("buildings_without_dsm"),
    ))
    return _head(site) | {
        "coordinates": "CRS eastings/northings, metres", "height_calib": {"intercept": fit["intercept"], "m_per_level": fit["m_per_level"], "source": fit["source"]},
        "height_calib_fit": {k: fit[k] for k in ("n", "rejected", "rmse")}, **found, "outside_grid": heights.filter("tile IS NULL").count(),
        "by_height_source": counts(inside, "src"), "qa_flagged": flagged,
    }


def ground(site: Site, tuning: Tuning, water: DataFrame, missing: DataFrame, coast_metres: float) -> dict:
    return _head(site) | {
        "water_level": site.water_level, "water_tolerance_m": site.water_tolerance, "class_res": tuning.class_res,
        "row_order": "north-first (GeoTIFF convention)", "bands": ["grass", "sand", "rock", "water"],
        "thresholds": {"foreshore_max_odn": site.foreshore_max, "rock_slope_deg": list(site.rock_slope)},
        "water_tiles": tile_pairs(water), "tiles_without_dtm": tile_pairs(missing), "missing_tiles_are_water": site.missing_tiles_are_water,
        "coastline_km_in_area": round(coast_metres / 1000, 2),
    }


def furniture(site: Site, tuning: Tuning, placed: DataFrame, nodes: DataFrame, kinds: dict) -> dict:
    """placed: records as written; nodes: those with a prop, with tile (null off the grid)."""
    made = facts(placed.agg(F.count(F.lit(1)).alias("placed"), F.count_distinct("tile_x", "tile_y").alias("tiles"), F.count_if("nudged").alias("nudged_out_of_carriageway")))
    return _head(site) | {
        "coordinates": "CRS eastings/northings, metres; bearing is degrees clockwise from grid north", **made,
        "outside_grid": nodes.filter("tile IS NULL").count(), "by_height_source": counts(placed, "src"), "amenity_kinds_seen": kinds,
        "props": tuning.props, "kerb_m": tuning.kerb, "snap_m": tuning.snap,
    }


def warnings(name: str, manifest: dict, landmarks: int = 0) -> list[str]:
    """What a reader of a product should know before trusting it."""
    out = []
    if name == "networks" and manifest["vertices_without_dtm"]:
        out.append(f"{manifest['vertices_without_dtm']} vertices had no ground under them; they took a neighbour's height, and their segments have z_gap")
    if name == "massing":
        n, guessed = manifest["buildings"], manifest["by_height_source"].get("type_prior", 0)
        if n and guessed / n > 0.05:
            out.append(f"{100 * guessed / n:.1f} % of buildings have a height guessed by type")
        if manifest["landmark_overrides"] < landmarks:
            out.append(f"{landmarks - manifest['landmark_overrides']} landmarks match no building's name")
    if name == "furniture" and not manifest["amenity_kinds_seen"]:
        out.append("the points layer has no amenity; was it converted?")
    return out


def written(manifest: dict) -> bytes:
    return json.dumps(manifest, indent=1).encode()


def read_manifest(spark: SparkSession, path: str) -> dict:
    from ..sources import files

    return json.loads(files.get(spark, path))
