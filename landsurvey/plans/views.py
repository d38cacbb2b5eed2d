"""Geodata-shaped views over generic tables, for trying operators without geodata.

Every view is an expression of its table: orders are raster cells, lineitem is
zone samples, part is footprints, events are ways and nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Calibration, Site, Tuning

E0, N0, TILE, NX, NY, PX, WIDTH = 500000.0, 150000.0, 512.0, 3, 2, 16.0, 125
SITE = Site("demo", "EPSG:27700", (E0, N0), TILE, NX, NY, 33, water_level=0.0, foreshore_max=2.0, calibration=Calibration(min_buildings=3), landmarks=(("Tower", 57.0, "flat"), ("Mill", None, "hipped")))
TUNING = Tuning(class_res=16)
CLASSES = ("residential", "primary", "footway", "service", "construction", "track")
KINDS = ("house", "retail", "garage", "terrace", "apartments", "yes", "no", "school")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def pick(values: tuple, key) -> F:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (key % len(values) + 1).cast("int"))


def shape(spark: SparkSession, sf: str) -> DataFrame:
    """One row: w, h of the raster."""
    return table(spark, sf, "orders").agg(F.lit(WIDTH).alias("w"), (F.expr(f"max(o_orderkey) div {WIDTH}") + 1).alias("h"))


def cells(spark: SparkSession, sf: str) -> DataFrame:
    """row, col, e, n, z (null about a third), dsm, tile_x, tile_y (any), r, c in the tile."""
    k = F.col("o_orderkey")
    rows = table(spark, sf, "orders").join(F.broadcast(shape(spark, sf)))
    rows = rows.withColumn("row", F.expr(f"o_orderkey div {WIDTH}").cast("int")).withColumn("col", (k % WIDTH).cast("int"))
    z = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice") / 10000 - 3)
    up = F.col("h") - 1 - F.col("row")  # cells above the south edge
    side = int(TILE / PX)
    return rows.select(
        "row", "col", (E0 + PX * F.col("col")).alias("e"), (N0 + PX * up).alias("n"), z.alias("z"),
        F.when(F.col("o_custkey") % 7 != 0, z + (F.col("o_custkey") % 17) / 2).alias("dsm"),
        F.floor(F.col("col") / side).cast("int").alias("tile_x"), F.floor(up / side).cast("int").alias("tile_y"),
        (side - 1 - up % side).cast("int").alias("r"), (F.col("col") % side).alias("c"),
    )


def every_tile(spark: SparkSession, sf: str) -> DataFrame:
    """All tiles of the grid that the raster spans: tile_x, tile_y."""
    far = cells(spark, sf).agg(F.max("tile_x").alias("x"), F.max("tile_y").alias("y"))
    upto = lambda c: F.explode(F.sequence(F.lit(0), F.col(c)))
    return far.select("y", upto("x").alias("tile_x")).select("tile_x", upto("y").alias("tile_y"))


def pixels(spark: SparkSession, sf: str) -> DataFrame:
    """idx, ndsm, dtm; one zone in 17 was never surveyed."""
    flown = F.col("l_partkey") % 17 != 0
    return table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("idx"), F.when(flown & (F.col("l_returnflag") != "N"), F.col("l_quantity") / 4).alias("ndsm"),
        F.when(flown, F.col("l_tax") * 100 + F.col("l_discount") * 10).alias("dtm"),
    )


def footprints(spark: SparkSession, sf: str) -> DataFrame:
    k, size = F.col("p_partkey"), F.col("p_size")
    storeys = F.nullif(size % 8, F.lit(0)).cast("string")
    tags = F.concat(
        F.when((k % 3 == 0) & storeys.isNotNull(), F.concat(F.lit('"building:levels"=>"'), storeys, F.lit('",'))).otherwise(""),
        F.when(k % 50 == 0, '"height"=>"8.5 m",').when(k % 53 == 0, '"height"=>"8.5m",').otherwise(""),
        F.when(k % 11 == 0, '"roof:shape"=>"hipped",').otherwise(""), F.lit('"source"=>"survey"'),
    )
    x0, y0 = E0 + (k * 37) % 2000, N0 + (k * 53) % 1500
    x1, y1 = x0 + 6 + size % 10, y0 + 5 + size % 7
    at = lambda e, n: F.struct(e.cast("double").alias("e"), n.cast("double").alias("n"))
    ring = F.array(at(x0, y0), at(x1, y0), at(x1, y1), at(x0, y1), at(x0, y0))
    return table(spark, sf, "part").select(
        k.alias("idx"), F.when(k % 2 == 0, F.concat(F.lit("w"), k)).otherwise("").alias("osm_way_id"), F.concat(F.lit("r"), k).alias("rel_id"),
        F.when(k % 9 != 0, pick(KINDS, k)).alias("building"), F.when(k % 97 == 3, "Tower").when(k % 101 == 5, "Mill").otherwise(F.col("p_name")).alias("name"),
        F.when(k % 3 != 0, storeys).alias("levels_tag"), tags.alias("other_tags"), F.array(F.array(ring)).alias("polys"),
    ).withColumn("osm_id", F.coalesce(F.nullif("osm_way_id", F.lit("")), "rel_id"))


def event_points(spark: SparkSession, sf: str) -> DataFrame:
    u, k = F.col("user_id"), F.col("event_id")
    return table(spark, sf, "events").select(
        "user_id", "event_id", "ts", "event_type", "value",
        (E0 - 100 + (u * 97) % 1200 + F.col("value") / 2).alias("e"), (N0 - 100.0 + (u * 53) % 700 + (k * 61) % 240).alias("n"),
    )


def lines(spark: SparkSession, sf: str) -> DataFrame:
    """osm_id, highway, name, other_tags, pts: a way per user, in order of time."""
    u = F.col("user_id")
    pts = F.transform(F.array_sort(F.collect_list(F.struct("ts", "event_id", "e", "n"))), lambda p: F.struct(p["e"].alias("e"), p["n"].alias("n")))
    tags = F.concat(
        F.when(u % 7 == 0, '"lanes"=>"2",').when(u % 11 == 0, '"lanes"=>"4;5",').otherwise(""), F.when(u % 4 == 0, '"bridge"=>"yes",').otherwise(""),
        F.when(u % 6 == 0, '"natural"=>"coastline",').otherwise(""), F.when(u % 10 == 0, '"tunnel"=>"no"').otherwise('"tunnel"=>""'),
    )
    return event_points(spark, sf).groupBy("user_id").agg(pts.alias("pts")).select(
        u.cast("string").alias("osm_id"), F.when(u % 13 != 0, pick(CLASSES, u)).alias("highway"), F.concat(F.lit("way "), u).alias("name"), tags.alias("other_tags"), "pts"
    )


def nodes(spark: SparkSession, sf: str) -> DataFrame:
    """osm_id, name, amenity, other_tags, e, n: a node per event."""
    kind, k = F.when(F.col("event_type") == "view", "waste_basket").otherwise("bench"), F.col("event_id")
    return event_points(spark, sf).select(
        k.alias("id"), F.when(k % 2 == 0, kind).otherwise("").alias("amenity"), F.concat(F.lit('"amenity"=>"'), kind, F.lit('"')).alias("other_tags"),
        (F.col("e") + k % 7).alias("e"), (F.col("n") + k % 7).alias("n"),
    )
