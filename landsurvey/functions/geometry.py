"""Polylines and rings as array expressions over struct(e, n) points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalar import let


def point(e: Column, n: Column) -> Column:
    return F.struct(e.alias("e"), n.alias("n"))


def distance(a: Column, b: Column) -> Column:
    de, dn = b["e"] - a["e"], b["n"] - a["n"]
    return F.sqrt(de * de + dn * dn)


def _blend(a: Column, b: Column, t: Column | float) -> Column:
    return point(a["e"] + (b["e"] - a["e"]) * t, a["n"] + (b["n"] - a["n"]) * t)


def _pairs(pts: Column, per_pair) -> Column:
    """flatten(per_pair(a, b)) over neighbours; empty for fewer than two points."""
    step = lambda p, i: per_pair(F.element_at(pts, i), p)
    return F.flatten(F.transform(F.slice(pts, 2, F.greatest(F.size(pts) - 1, F.lit(0))), lambda p, i: step(p, i + 1)))


def densify(pts: Column, step: float) -> Column:
    """Points every step metres from each vertex on, and all vertices."""

    def cut(a: Column, b: Column) -> Column:
        def inner(d: Column) -> Column:
            n = F.greatest(F.floor(d / step).cast("int"), F.lit(1))
            at = F.filter(F.sequence(F.lit(1), n), lambda k: (d > step) & (k * step / d < 1.0))
            return F.transform(at, lambda k: _blend(a, b, k * step / d))

        return F.concat(let(distance(a, b), inner), F.array(b))

    return let(pts, lambda p: F.concat(F.slice(p, 1, 1), _pairs(p, cut)))


def chaikin(pts: Column, iterations: int = 2) -> Column:
    """Corner cutting with both ends kept; fewer than three points stay as they are."""

    def corners(a: Column, b: Column) -> Column:
        return F.array(
            point(a["e"] * 0.75 + b["e"] * 0.25, a["n"] * 0.75 + b["n"] * 0.25),
            point(a["e"] * 0.25 + b["e"] * 0.75, a["n"] * 0.25 + b["n"] * 0.75),
        )

    for _ in range(iterations):
        pts = let(pts, lambda p: F.when(F.size(p) < 3, p).otherwise(F.concat(F.slice(p, 1, 1), _pairs(p, corners), F.slice(p, -1, 1))))
    return pts


def length(pts: Column) -> Column:
    return F.aggregate(_pairs(pts, lambda a, b: F.array(distance(a, b))), F.lit(0.0), lambda total, d: total + d)


def envelope(pts: Column) -> Column:
    """struct(e0, e1, n0, n1)."""
    es, ns = F.transform(pts, lambda p: p["e"]), F.transform(pts, lambda p: p["n"])
    return F.struct(F.array_min(es).alias("e0"), F.array_max(es).alias("e1"), F.array_min(ns).alias("n0"), F.array_max(ns).alias("n1"))


def rings(polygons: Column, least: int = 4) -> Column:
    """All rings of polygon > ring > point as struct(hole, pts), short ones left out."""
    of_one = lambda rs: F.transform(rs, lambda r, i: F.struct((i > 0).alias("hole"), r.alias("pts")))
    return F.filter(F.flatten(F.transform(polygons, of_one)), lambda r: F.size(r["pts"]) >= least)


def clipped_length(ae: Column, an: Column, be: Column, bn: Column, e0: float, n0: float, e1: float, n1: float) -> Column:
    """Length of a segment inside a rectangle: the parameters at which the line enters
    and leaves each side (Liang and Barsky)."""
    de, dn = be - ae, bn - an
    enter, leave, misses = [F.lit(0.0)], [F.lit(1.0)], F.lit(False)
    for d, a, low, high in ((de, ae, e0, e1), (dn, an, n0, n1)):
        first, second = (low - a) / F.nullif(d, F.lit(0.0)), (high - a) / F.nullif(d, F.lit(0.0))
        enter.append(F.least(first, second))
        leave.append(F.greatest(first, second))
        misses = misses | ((d == 0) & ((a < low) | (a > high)))
    inside = F.greatest(F.least(*leave) - F.greatest(*enter), F.lit(0.0))
    return F.when(misses, 0.0).otherwise(inside * F.sqrt(de * de + dn * dn))
