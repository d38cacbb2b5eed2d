"""Site and tuning configuration: what is measured at a place, and what is opinion."""

from __future__ import annotations

import json
import os
import re
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Carriageway and pavement width in metres by highway class.
ROAD_WIDTHS = {
    "motorway": (14.0, 0.0), "motorway_link": (7.0, 0.0), "trunk": (12.0, 2.0), "trunk_link": (7.0, 1.5),
    "primary": (10.0, 2.0), "primary_link": (6.5, 1.5), "secondary": (8.5, 2.0), "secondary_link": (6.0, 1.5),
    "tertiary": (7.0, 1.8), "tertiary_link": (5.5, 1.5), "residential": (6.0, 1.5), "unclassified": (5.5, 1.5),
    "living_street": (5.0, 1.2), "service": (3.5, 0.0), "pedestrian": (6.0, 0.0), "track": (3.0, 0.0),
    "bridleway": (3.0, 0.0), "cycleway": (2.5, 0.0), "footway": (2.0, 0.0), "path": (1.8, 0.0), "steps": (2.0, 0.0),
}
# Highway values that are no road on the ground.
ROAD_SKIP = ("construction", "proposed", "no", "corridor", "elevator", "platform", "raceway")
# Building types with flat roofs, and heights in metres by type where nothing else is known.
FLAT_TYPES = ("garage", "garages", "shed", "roof", "industrial", "retail", "commercial", "supermarket", "static_caravan")
TYPE_PRIORS = {
    "house": 6.97, "residential": 7.30, "yes": 6.64, "semidetached_house": 6.98, "retail": 8.99, "terrace": 8.13,
    "apartments": 9.42, "garage": 2.43, "detached": 6.35, "shed": 2.37, "garages": 2.43, "commercial": 7.02,
    "school": 4.29, "industrial": 5.75, "hospital": 4.19, "bungalow": 4.24, "roof": 3.81, "static_caravan": 3.0,
}


class AmbiguousSiteError(ValueError):
    """No site was named and there is not exactly one."""


class GridError(ValueError):
    """Tile size, pixel size and class resolution do not fit together."""


@dataclass(frozen=True)
class Tuning:
    widths: dict = field(default_factory=lambda: dict(ROAD_WIDTHS))
    skip: tuple = ROAD_SKIP
    lane_width: float = 3.0
    lane_margin: float = 1.0
    width_quantum: float = 0.5
    densify_step: float = 8.0
    chaikin_iters: int = 2
    junction_min_ways: int = 3
    junction_margin: float = 0.4
    min_pixels: int = 6
    ridge_spread: float = 8.0
    skirt_below: float = 0.5
    default_roof: str = "gabled"
    flat_types: tuple = FLAT_TYPES
    type_priors: dict = field(default_factory=lambda: dict(TYPE_PRIORS))
    type_prior_default: float = 6.6
    class_res: int = 256
    props: dict = field(default_factory=lambda: {"waste_basket": "LitterBin"})
    snap: float = 25.0
    kerb: float = 0.12
    verge_margin: float = 1.0
    nudge: float = 0.6

    def width_rows(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(k, *v) for k, v in sorted(self.widths.items())], "cls string, spec_w double, pav double")

    def prior_rows(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(sorted(self.type_priors.items()), "type string, prior_h double")

    def prop_rows(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(sorted(self.props.items()), "amenity string, prop string")


@dataclass(frozen=True)
class Calibration:
    """Height by storeys: mode auto fits, fixed uses the numbers; both fall back."""

    mode: str | None = None
    intercept: float | None = None
    m_per_level: float | None = None
    fallback: tuple[float, float] = (2.5, 3.0)
    min_buildings: int = 30
    dispute: float = 4.0

    @property
    def effective_mode(self) -> str:
        return self.mode or ("auto" if self.intercept is None else "fixed")


@dataclass(frozen=True)
class Site:
    name: str
    crs: str
    origin: tuple[float, float]
    tile: float = 512.0
    nx: int = 1
    ny: int = 1
    grid_res: int = 513
    water_level: float = 0.0
    water_tolerance: float = 0.3
    water_flat_dz_per_m: float = 0.08
    water_margin: float = 0.75
    foreshore_max: float = 0.0
    rock_slope: tuple[float, float] = (22.0, 40.0)
    missing_tiles_are_water: bool = False
    calibration: Calibration = Calibration()
    landmarks: tuple = ()  # (name, body height or None, roof or None)

    @property
    def epsg(self) -> int:
        found = re.fullmatch(r"(?i)epsg:(\d+)", self.crs.strip())
        if not found:
            raise ValueError(f"crs must look like EPSG:27700, not {self.crs!r}")
        return int(found[1])

    def landmark_rows(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.landmarks), "name string, lm_h double, lm_roof string")


def pixel_size(transform: tuple) -> tuple[float, float]:
    return abs(transform[1]), abs(transform[5])


def tile_pixels(site: Site, transform: tuple, class_res: int | None = None) -> tuple[int, int]:
    """Whole pixels of a tile; they must also divide into the class raster."""
    out = []
    for size in pixel_size(transform):
        n = round(site.tile / size)
        if abs(n * size - site.tile) > 1e-6 or (class_res and n % class_res):
            raise GridError(f"a tile of {site.tile} m is no whole number of {size} m pixels or of {class_res} classes")
        out.append(n)
    return out[0], out[1]


def load_site(folder: str, name: str | None = None) -> Site:
    """The site named (or in the SITE variable), or the only one in the folder."""
    name = name or os.environ.get("SITE")
    known = sorted(p.stem for p in Path(folder).glob("*.json"))
    if not name:
        if len(known) != 1:
            raise AmbiguousSiteError(f"name one of the sites {known}")
        name = known[0]
    raw = {k: v for k, v in json.loads((Path(folder) / f"{name}.json").read_text()).items() if not k.startswith("_")}
    calibration = Calibration(**{k: v for k, v in raw.pop("calibration", {}).items() if not k.startswith("_")})
    marks = tuple((k, v.get("h"), v.get("roof")) for k, v in raw.pop("landmarks", {}).items() if not k.startswith("_"))
    return Site(name=name, calibration=calibration, landmarks=marks, **{k: tuple(v) if isinstance(v, list) else v for k, v in raw.items()})
