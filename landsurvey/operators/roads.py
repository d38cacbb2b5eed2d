"""Road centrelines: ways, junctions, draping, gap filling, splitting by tile."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import Tuning
from ..functions.geometry import chaikin, densify
from ..functions.scalar import carriageway, flag, tag, tile_of

GRID = ("origin", "tile", "nx", "ny")


def select_ways(lines: DataFrame, widths: DataFrame, tuning: Tuning) -> DataFrame:
    """Ways of known classes with width, pavement, bridge and tunnel flags.

    lines: osm_id, highway, name, other_tags, pts; widths is configuration."""
    known = lines.filter(F.col("highway").isNotNull() & ~F.col("highway").isin(*tuning.skip) & (F.size("pts") >= 2))
    width = carriageway("spec_w", tag("other_tags", "lanes"), tuning.lane_width, tuning.lane_margin, tuning.width_quantum)
    return known.join(F.broadcast(widths.withColumnRenamed("cls", "highway")), "highway").select(
        F.col("osm_id").alias("id"), F.col("highway").alias("cls"), width.alias("w"), "pav", "name",
        flag(tag("other_tags", "bridge")).alias("bridge"), flag(tag("other_tags", "tunnel")).alias("tunnel"), "pts",
    )


def endpoints(ways: DataFrame) -> DataFrame:
    """Both ends of every way, in decimetres (T19): ke, kn, w."""
    ends = F.explode(F.array(F.element_at("pts", 1), F.element_at("pts", -1)))
    key = lambda c: F.floor(F.col(c) * 10 + 0.5).cast("bigint")
    return ways.select(ends.alias("p"), "w").select(key("p.e").alias("ke"), key("p.n").alias("kn"), "w")


def degrees(ways: DataFrame) -> DataFrame:
    return endpoints(ways).groupBy("ke", "kn").agg(F.count(F.lit(1)).alias("ways"), F.max("w").alias("w"))


def junctions(ways: DataFrame, tuning: Tuning) -> DataFrame:
    """Discs where enough ends meet: e, n, r by the widest way."""
    meet = degrees(ways).filter(F.col("ways") >= tuning.junction_min_ways)
    return meet.select((F.col("ke") / 10).alias("e"), (F.col("kn") / 10).alias("n"), (F.col("w") / 2 + tuning.junction_margin).alias("r"))


def smooth(ways: DataFrame, tuning: Tuning) -> DataFrame:
    return ways.withColumn("pts", chaikin(densify(F.col("pts"), tuning.densify_step), tuning.chaikin_iters))


def vertices(ways: DataFrame, origin: tuple[float, float], tile: float, nx: int, ny: int) -> DataFrame:
    """id, q (place in the way), e, n, tile (null off the grid)."""
    return ways.select("id", F.posexplode("pts").alias("q", "p")).select(
        "id", "q", F.col("p.e").alias("e"), F.col("p.n").alias("n"), tile_of("p.e", "p.n", origin, tile, nx, ny).alias("tile")
    )


def fill_gaps(points: DataFrame) -> DataFrame:
    """points (id, q, z, tile) with zf: in the grid, the last height before, else the
    first after (T16); z only where measured in the grid."""
    w = Window.partitionBy("id").orderBy("q")
    back, on = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    filled = F.coalesce("z", F.last("z", ignorenulls=True).over(back), F.first("z", ignorenulls=True).over(on))
    return points.withColumn("zf", F.when(F.col("tile").isNotNull(), filled))


def split_by_tile(points: DataFrame) -> DataFrame:
    """Runs of each way inside one tile: id, rid, tile, z_gap, vertices (q, part) in order.

    The first vertex of a new tile also ends the run before and stands twice at the
    head of its own (T14, T15); leaving the grid ends a run. Runs of one vertex go."""
    w = Window.partitionBy("id").orderBy("q")
    before = F.lag("tile").over(w)
    marked = (
        points.withColumn("before", before)
        .withColumn("brk", (F.col("tile").isNull() | F.col("before").isNull() | (F.col("tile") != F.col("before"))).cast("int"))
        .withColumn("rid", F.sum("brk").over(w))
        .filter("tile IS NOT NULL")
        .withColumn("seam", F.col("before").isNotNull() & (F.col("tile") != F.col("before")))
        .withColumn("filled", F.col("z").isNull())
    )
    own = F.struct(F.col("rid"), F.lit(1).alias("part"))
    seams = F.array(own, F.struct(F.col("rid"), F.lit(0).alias("part")), F.struct((F.col("rid") - 1).alias("rid"), F.lit(2).alias("part")))
    rows = marked.select("id", "q", "e", "n", F.coalesce("zf", F.lit(0.0)).alias("z"), "filled", "tile", F.explode(F.when(F.col("seam"), seams).otherwise(F.array(own))).alias("r"))
    vertex = F.struct("q", F.col("r.part").alias("part"), "e", "n", "z")
    return (
        rows.groupBy("id", F.col("r.rid").alias("rid"))
        .agg(
            F.max(F.when(F.col("r.part") < 2, F.col("tile"))).alias("tile"), F.bool_or("filled").alias("z_gap"),
            F.array_sort(F.collect_list(vertex)).alias("vertices"),
        )
        .filter((F.size("vertices") >= 2) & F.col("tile").isNotNull())
    )


def road_records(ways: DataFrame, runs: DataFrame) -> DataFrame:
    pts = F.transform("vertices", lambda v: F.array(v["e"], v["n"], v["z"]))
    return runs.join(ways.drop("pts"), "id").select("tile.tile_x", "tile.tile_y", "id", "cls", "w", "pav", "name", "bridge", "tunnel", "z_gap", pts.alias("pts"))
