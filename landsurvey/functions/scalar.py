"""Scalar expressions. Trap numbers (T..) are those of the survey notes."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship

#: Texts that Python and Spark read as the same number (T4).
PLAIN_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, use) -> Column:
    """use(value) with value computed once, however often use mentions it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def tag(tags: Column | str, key: str) -> Column:
    """Value of a key in a ``"k"=>"v"`` text; null where missing or empty."""
    return F.nullif(F.regexp_extract(col(tags), f'"{key}"=>"([^"]*)"', 1), F.lit(""))


def tag_map(tags: Column | str) -> Column:
    """The whole tag text as a map; the first of equal keys counts."""
    pairs = F.regexp_extract_all(col(tags), F.lit(r'"([^"]*)"=>"([^"]*)"'), F.lit(0))
    key = lambda p: F.regexp_extract(p, r'"([^"]*)"=>', 1)
    entries = F.transform(pairs, lambda p: F.struct(key(p).alias("key"), F.regexp_extract(p, r'=>"([^"]*)"', 1).alias("value")))
    first = F.filter(entries, lambda e, i: F.array_position(F.transform(entries, lambda x: x["key"]), e["key"]) == i + 1)
    return F.map_from_entries(first)


def first_true(*values: Column | str) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*[F.nullif(col(v), F.lit("")) for v in values])


def number(text: Column | str) -> Column:
    """A finite number, or null where the text is none (T4)."""
    return let(col(text), lambda t: F.when(t.rlike(PLAIN_NUMBER), t.try_cast("double")))


def levels(text: Column | str) -> Column:
    """Storeys, cut towards zero (T5)."""
    return let(number(text), lambda x: F.when(F.abs(x) < 2**31, x).cast("int"))


def height_tag(text: Column | str) -> Column:
    """The first word of a height as metres: ``8.5 m`` counts, ``8.5m`` does not."""
    return number(F.element_at(F.split(F.trim(col(text)), r"\s+"), 1))


def flag(value: Column | str) -> Column:
    """A tag that is there and not empty, ``no`` included."""
    return F.coalesce(col(value) != "", F.lit(False))


def seed(text: Column | str) -> Column:
    """First 8 hex digits of the md5, as a number."""
    return F.conv(F.substring(F.md5(col(text).cast("string").cast("binary")), 1, 8), 16, 10).cast("bigint")


def carriageway(spec: Column | str, lanes: Column | str, lane: float = 3.0, margin: float = 1.0, quantum: float = 0.5) -> Column:
    """Width of the class or of the lanes, the larger, in steps of quantum."""
    wide = number(lanes) * lane + margin  # greatest leaves out a null
    return F.rint(F.greatest(col(spec), wide) / quantum) * quantum


def tile_index(value: Column, origin: float, tile: float) -> Column:
    return F.floor((value - origin) / tile).cast("int")


def tile_of(e: Column | str, n: Column | str, origin: tuple[float, float], tile: float, nx: int, ny: int) -> Column:
    """struct(tile_x, tile_y), or null off the grid (half-open)."""
    i, j = tile_index(col(e), origin[0], tile), tile_index(col(n), origin[1], tile)
    inside = (i >= 0) & (i < nx) & (j >= 0) & (j < ny)
    return F.when(inside, F.struct(i.alias("tile_x"), j.alias("tile_y")))


def micro(value: Column | str) -> Column:
    """Millionths as a whole number: the form in which engines agree on doubles."""
    return F.floor(col(value) * 1000000 + 0.5).cast("bigint")


def bearing(de: Column, dn: Column) -> Column:
    """Degrees clockwise from grid north, 0 to 360."""
    return F.pmod(F.degrees(F.atan2(de, dn)), F.lit(360.0))


def python_round(spark: SparkSession, digits: int = 2):
    """Rounding of the binary value, half to even (T1), in Arrow batches; for sinks."""
    ship(spark)

    @F.pandas_udf("double")
    def rounded(values: pd.Series) -> pd.Series:
        return values.map(lambda v: None if pd.isna(v) else round(v, digits))

    return rounded
