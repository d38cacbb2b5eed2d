"""Polygons to cells: the centre rule, half-pixel erosion, and a second try by touch.

Rings are exploded to edges. Candidate cells come from a polygon's envelope, and
one aggregation over its edges decides each: an even-odd crossing count
(half-open in n, so a centre on an edge counts for one side only) and the least
distance to any edge. Joins are equi-joins on the polygon.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import envelope


def edges(polygons: DataFrame) -> DataFrame:
    """idx, ae, an, be, bn of every ring edge; polygons: idx, rings array<array<point>>."""
    ring = polygons.select("idx", F.explode("rings").alias("ring"))
    pairs = F.transform(F.filter(F.sequence(F.lit(1), F.size("ring") - 1), lambda i: i >= 1), lambda i: F.struct(F.element_at("ring", i).alias("a"), F.element_at("ring", i + 1).alias("b")))
    return ring.filter(F.size("ring") >= 4).select("idx", F.explode(pairs).alias("s")).select("idx", F.col("s.a.e").alias("ae"), F.col("s.a.n").alias("an"), F.col("s.b.e").alias("be"), F.col("s.b.n").alias("bn"))


def candidates(polygons: DataFrame, origin: tuple[float, float], px: float, reach: float = 0.0) -> DataFrame:
    """idx, cx, cy: cells whose square lies in the envelope; centre of cell (0, 0) at origin."""
    box = envelope(F.flatten("rings"))
    span = lambda low, high, o: F.sequence(F.ceil((low - reach - o) / px), F.greatest(F.floor((high + reach - o) / px), F.ceil((low - reach - o) / px)))
    wide = polygons.select("idx", box.alias("b")).select("idx", F.explode(span(F.col("b.e0"), F.col("b.e1"), origin[0])).alias("cx"), "b")
    return wide.select("idx", "cx", F.explode(span(F.col("b.n0"), F.col("b.n1"), origin[1])).alias("cy"))


def judged(polygons: DataFrame, origin: tuple[float, float], px: float, reach: float = 0.0) -> DataFrame:
    """idx, cx, cy, inside, away (least distance of the centre to an edge), touched."""
    e, n = F.col("cx") * px + origin[0], F.col("cy") * px + origin[1]
    # the size of exploded rings is estimated from their file, so edges may seem small
    # enough to broadcast when they are not; a merge join takes any number
    sides = candidates(polygons, origin, px, reach).join(edges(polygons).hint("merge"), "idx").withColumn("e", e).withColumn("n", n)
    de, dn = F.col("be") - F.col("ae"), F.col("bn") - F.col("an")
    crosses = ((F.col("an") <= F.col("n")) != (F.col("bn") <= F.col("n"))) & (F.col("e") < F.col("ae") + (F.col("n") - F.col("an")) * de / F.nullif(dn, F.lit(0.0)))
    along = F.least(F.greatest(((F.col("e") - F.col("ae")) * de + (F.col("n") - F.col("an")) * dn) / F.nullif(de * de + dn * dn, F.lit(0.0)), F.lit(0.0)), F.lit(1.0))
    along = F.coalesce(along, F.lit(0.0))
    pe, pn = F.col("ae") + along * de - F.col("e"), F.col("an") + along * dn - F.col("n")
    # an edge meets the cell's square if its part inside the square is not empty
    half = px / 2
    enter, leave, misses = [F.lit(0.0)], [F.lit(1.0)], F.lit(False)
    for d, a, c in ((de, F.col("ae"), F.col("e")), (dn, F.col("an"), F.col("n"))):
        first, second = (c - half - a) / F.nullif(d, F.lit(0.0)), (c + half - a) / F.nullif(d, F.lit(0.0))
        enter.append(F.least(first, second))
        leave.append(F.greatest(first, second))
        misses = misses | ((d == 0) & (F.abs(a - c) > half))
    meets = ~misses & (F.greatest(*enter) <= F.least(*leave))
    return sides.groupBy("idx", "cx", "cy").agg(
        (F.count_if(F.coalesce(crosses, F.lit(False))) % 2 == 1).alias("inside"), F.min(F.sqrt(pe * pe + pn * pn)).alias("away"), F.bool_or(meets).alias("touched")
    )


def rasterise(polygons: DataFrame, origin: tuple[float, float], px: float, erode: float = 0.0) -> DataFrame:
    """cx, cy, idx: each cell to the last polygon whose (eroded) inside has its centre.
    A polygon that erosion empties is taken uneroded."""
    cells = judged(polygons, origin, px).filter("inside")
    if erode:
        deep = F.max("away").over(Window.partitionBy("idx"))
        cells = cells.withColumn("deep", deep).filter((F.col("away") >= erode) | (F.col("deep") < erode))
    return cells.groupBy("cx", "cy").agg(F.max("idx").alias("idx"))


def rasterise_all(polygons: DataFrame, origin: tuple[float, float], px: float, erode: float = 0.0) -> DataFrame:
    """rasterise, then polygons without a cell take free cells that they touch."""
    first = rasterise(polygons, origin, px, erode)
    missing = polygons.join(first.select("idx").distinct(), "idx", "left_anti")
    again = judged(missing, origin, px, px / 2).filter("inside OR touched").join(first, ["cx", "cy"], "left_anti")
    return first.unionByName(again.groupBy("cx", "cy").agg(F.max("idx").alias("idx")))


def burn(cells: DataFrame, polygons: DataFrame, origin: tuple[float, float], px: float) -> DataFrame:
    """cells (cx, cy, ...) that lie in any polygon."""
    return cells.join(judged(polygons, origin, px).filter("inside").select("cx", "cy").distinct(), ["cx", "cy"], "left_semi")
