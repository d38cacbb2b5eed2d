"""What must hold before inputs are used: cached files, extents, layers, windows."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Site


class StaleInputError(ValueError):
    """Inputs were made for another place or grid."""


def request_window(site: Site, i: int, j: int, px: float) -> tuple[float, float, float, float]:
    """west, south, east, north of the raster to ask for, so that cell centres fall on
    the tile's edges: half a cell more on each side (T37)."""
    w, s = site.origin[0] + i * site.tile, site.origin[1] + j * site.tile
    return w - px / 2, s - px / 2, w + site.tile + px / 2, s + site.tile + px / 2


def grid_stamp(site: Site) -> dict:
    return {"crs": site.crs, "origin": list(site.origin), "tile_m": site.tile, "res": site.grid_res}


def check_stamp(path: str, site: Site) -> bool:
    """True if tiles of this grid are there, False if none are; others are refused."""
    file = Path(path)
    if not file.exists():
        return False
    if json.loads(file.read_text()) != grid_stamp(site):
        raise StaleInputError(f"{path} is of another grid; remove its tiles first")
    return True


def extract_is_current(path: str, bounds: list[float], provenance: dict) -> bool:
    """An extract may be used again if it is XML and was made for the same bounds."""
    file = Path(path)
    if not file.exists():
        return False
    with file.open("rb") as f:
        return f.read(64).lstrip().startswith((b"<?xml", b"<osm")) and provenance.get("bbox") == bounds


def answer_problem(head: str) -> str | None:
    """Why a map server's answer is no extract, or None."""
    if not head.lstrip().startswith(("<?xml", "<osm")):
        return "not XML"
    if "runtime error" in head:
        return "the server reports a runtime error"
    return None if "<node" in head else "no nodes"


def check_extent(layer: DataFrame, bounds: tuple[float, float, float, float], pad: float) -> None:
    """All points (e, n) of a layer lie in the bounds, give or take pad; else it is in
    another coordinate system."""
    box = layer.agg(F.min("e"), F.min("n"), F.max("e"), F.max("n")).first()
    if box[0] is None:
        raise StaleInputError("the layer is empty")
    w, s, e, n = bounds
    if box[0] < w - pad or box[1] < s - pad or box[2] > e + pad or box[3] > n + pad:
        raise StaleInputError(f"the layer reaches {tuple(box)}, outside {bounds}")


def require_layers(have: list[str], wanted: tuple[str, ...] = ("points", "lines", "multipolygons")) -> None:
    if lost := [w for w in wanted if w not in have]:
        raise StaleInputError(f"missing layers: {', '.join(lost)}")
