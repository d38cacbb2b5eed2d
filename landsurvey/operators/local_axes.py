"""For engines with a local origin and the second axis up: x east, y up, z north."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Draw-order lifts over the draped line by class, and offsets, in metres.
CLASS_LIFT = {
    "motorway": 0.24, "motorway_link": 0.24, "trunk": 0.24, "trunk_link": 0.24, "primary": 0.22, "primary_link": 0.22,
    "secondary": 0.20, "secondary_link": 0.20, "tertiary": 0.18, "tertiary_link": 0.18, "residential": 0.16,
    "unclassified": 0.16, "living_street": 0.16, "service": 0.14, "pedestrian": 0.14, "track": 0.12, "bridleway": 0.12,
    "cycleway": 0.12, "footway": 0.10, "path": 0.10, "steps": 0.10,
}
DEFAULT_LIFT, JUNCTION_LIFT, BRIDGE_OFFSET, TUNNEL_OFFSET = 0.12, 0.085, 3.0, -4.0


def local_points(pts: Column, origin: tuple[float, float], lift: Column) -> Column:
    """[e, n, z] points as [x, y, z]."""
    return F.transform(pts, lambda p: F.array(F.element_at(p, 1) - origin[0], F.element_at(p, 3) + lift, F.element_at(p, 2) - origin[1]))


def roads(segments: DataFrame, origin: tuple[float, float], lifts: dict[str, float] | None = None) -> DataFrame:
    table = F.create_map(*[F.lit(x) for k, v in sorted((lifts or CLASS_LIFT).items()) for x in (k, v)])
    lift = F.coalesce(F.try_element_at(table, F.col("cls")), F.lit(DEFAULT_LIFT))
    lift = lift + F.when(F.col("bridge"), BRIDGE_OFFSET).otherwise(0.0) + F.when(F.col("tunnel"), TUNNEL_OFFSET).otherwise(0.0)
    return segments.withColumn("pts", local_points(F.col("pts"), origin, lift)).drop("bridge", "tunnel", "z_gap")


def junctions(discs: DataFrame, origin: tuple[float, float]) -> DataFrame:
    return discs.select((F.col("e") - origin[0]).alias("x"), (F.col("z") + JUNCTION_LIFT).alias("y"), (F.col("n") - origin[1]).alias("z"), "r")


def buildings(records: DataFrame, origin: tuple[float, float]) -> DataFrame:
    moved = lambda p: F.array(p["e"] - origin[0], p["n"] - origin[1])
    rings = F.transform("rings", lambda r: F.struct(r["hole"].alias("hole"), F.transform(r["pts"], moved).alias("pts")))
    return records.withColumn("rings", rings).withColumnRenamed("base_z", "base_y")


def furniture(placements: DataFrame, origin: tuple[float, float]) -> DataFrame:
    keep = [c for c in placements.columns if c not in ("e", "n", "z", "bearing")]
    return placements.select(*keep, (F.col("e") - origin[0]).alias("x"), F.col("z").alias("y"), (F.col("n") - origin[1]).alias("z"), F.col("bearing").alias("yaw"))
