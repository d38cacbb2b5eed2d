"""Map vectors: OSM XML through Spark's reader, GeoPackage layers through sqlite."""

from __future__ import annotations

import math
import sqlite3
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import col
from ..shipping import ship

POINTS = "array<struct<e:double,n:double>>"


def osm_nodes(spark: SparkSession, path: str) -> DataFrame:
    """osm_id, lat, lon and tags of all nodes."""
    schema = "_id bigint, _lat double, _lon double, tag array<struct<_k:string,_v:string>>"
    return spark.read.format("xml").option("rowTag", "node").schema(schema).load(path).select(F.col("_id").alias("osm_id"), F.col("_lat").alias("lat"), F.col("_lon").alias("lon"), _tags().alias("tags"))


def osm_ways(spark: SparkSession, path: str) -> DataFrame:
    """osm_id, refs in order, and tags of all ways."""
    schema = "_id bigint, nd array<struct<_ref:bigint>>, tag array<struct<_k:string,_v:string>>"
    ways = spark.read.format("xml").option("rowTag", "way").schema(schema).load(path)
    return ways.select(F.col("_id").alias("osm_id"), F.transform("nd", lambda x: x["_ref"]).alias("refs"), _tags().alias("tags"))


def _tags():
    return F.map_from_entries(F.transform(F.coalesce("tag", F.array().cast("array<struct<_k:string,_v:string>>")), lambda t: F.struct(t["_k"].alias("key"), t["_v"].alias("value"))))


def way_lines(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """ways with pts from nodes (osm_id, e, n), by one equi-join on the node."""
    asked = ways.select("osm_id", F.posexplode("refs").alias("q", "ref"))
    met = asked.join(nodes.select(F.col("osm_id").alias("ref"), "e", "n"), "ref")
    lines = met.groupBy("osm_id").agg(F.array_sort(F.collect_list(F.struct("q", "e", "n"))).alias("v"))
    pts = F.transform("v", lambda v: F.struct(v["e"].alias("e"), v["n"].alias("n")))
    return ways.drop("refs").join(lines, "osm_id").withColumn("pts", pts).drop("v")


def transverse_mercator(lat, lon, a: float, b: float, scale: float, lat0: float, lon0: float, e0: float, n0: float):
    """Easting and northing of latitude and longitude in degrees, as expressions: the
    published series of the national grids, good to millimetres on its own datum."""
    phi, lam = F.radians(col(lat)), F.radians(col(lon))
    phi0, lam0 = F.radians(F.lit(lat0)), F.radians(F.lit(lon0))
    e2, m = (a * a - b * b) / (a * a), (a - b) / (a + b)
    s, c, t = F.sin(phi), F.cos(phi), F.tan(phi)
    nu = a * scale / F.sqrt(1 - e2 * s * s)
    rho = a * scale * (1 - e2) / F.pow(1 - e2 * s * s, F.lit(1.5))
    eta2 = nu / rho - 1
    d, p = phi - phi0, phi + phi0
    arc = b * scale * (
        (1 + m + 1.25 * m**2 + 1.25 * m**3) * d - (3 * m + 3 * m**2 + 2.625 * m**3) * F.sin(d) * F.cos(p)
        + (1.875 * m**2 + 1.875 * m**3) * F.sin(2 * d) * F.cos(2 * p) - 35 / 24 * m**3 * F.sin(3 * d) * F.cos(3 * p)
    )
    x = lam - lam0
    north = (
        arc + n0 + nu / 2 * s * c * x * x + nu / 24 * s * c**3 * (5 - t * t + 9 * eta2) * x**4
        + nu / 720 * s * c**5 * (61 - 58 * t * t + t**4) * x**6
    )
    east = (
        e0 + nu * c * x + nu / 6 * c**3 * (nu / rho - t * t) * x**3
        + nu / 120 * c**5 * (5 - 18 * t * t + t**4 + 14 * eta2 - 58 * t * t * eta2) * x**5
    )
    return east, north


#: Ellipsoid and projection of the British national grid.
BRITISH_GRID = {"a": 6377563.396, "b": 6356256.909, "scale": 0.9996012717, "lat0": 49.0, "lon0": -2.0, "e0": 400000.0, "n0": -100000.0}


#: Ellipsoids, and the published shift from WGS84 to the grid's datum
#: (metres, seconds of arc, parts per million).
WGS84, AIRY = (6378137.0, 6356752.314245), (6377563.396, 6356256.909)
SHIFT = {"x": -446.448, "y": 125.157, "z": -542.060, "rx": -0.1502, "ry": -0.2470, "rz": -0.8421, "ppm": 20.4894}


def shift_datum(lat, lon, height: float = 0.0, source=WGS84, target=AIRY, shift=SHIFT):  # noqa: B006
    """Latitude and longitude on another datum by seven parameters, good to metres."""
    a, b = source
    e2 = 1 - b * b / (a * a)
    phi, lam = F.radians(col(lat)), F.radians(col(lon))
    nu = a / F.sqrt(1 - e2 * F.sin(phi) * F.sin(phi))
    x, y = (nu + height) * F.cos(phi) * F.cos(lam), (nu + height) * F.cos(phi) * F.sin(lam)
    z = ((1 - e2) * nu + height) * F.sin(phi)
    rx, ry, rz = (math.radians(shift[k] / 3600) for k in ("rx", "ry", "rz"))
    s = 1 + shift["ppm"] * 1e-6
    x2, y2, z2 = shift["x"] + s * x - rz * y + ry * z, shift["y"] + rz * x + s * y - rx * z, shift["z"] - ry * x + rx * y + s * z
    a, b = target
    e2 = 1 - b * b / (a * a)
    # the closed form with the parametric latitude is exact to micrometres near the ground
    p = F.sqrt(x2 * x2 + y2 * y2)
    t = F.atan2(z2 * a, p * b)
    out = F.atan2(z2 + e2 / (1 - e2) * b * F.pow(F.sin(t), 3), p - e2 * a * F.pow(F.cos(t), 3))
    return F.degrees(out), F.degrees(F.atan2(y2, x2))


def wkb_parts(data: bytes) -> list[list[list[tuple[float, float]]]]:
    """Polygons > rings > points of a WKB geometry; points and lines are one ring."""

    def take(at: int):
        order = "<" if data[at] == 1 else ">"
        (kind,) = struct.unpack_from(order + "I", data, at + 1)
        kind, at = kind % 1000, at + 5

        def points(at: int, n: int):
            flat = struct.unpack_from(f"{order}{2 * n}d", data, at)
            return list(zip(flat[::2], flat[1::2], strict=True)), at + 16 * n

        if kind == 1:
            pts, at = points(at, 1)
            return [[pts]], at
        (n,) = struct.unpack_from(order + "I", data, at)
        at += 4
        if kind == 2:
            pts, at = points(at, n)
            return [[pts]], at
        if kind == 3:
            rings = []
            for _ in range(n):
                (k,) = struct.unpack_from(order + "I", data, at)
                pts, at = points(at + 4, k)
                rings.append(pts)
            return [rings], at
        out = []
        for _ in range(n):
            part, at = take(at)
            out += part
        return out, at

    return take(0)[0]


def package_blob(blob: bytes) -> bytes:
    """WKB inside a GeoPackage geometry."""
    if blob[:2] != b"GP":
        raise ValueError("no GeoPackage geometry")
    return blob[8 + {0: 0, 1: 32, 2: 48, 3: 48, 4: 64}[blob[3] >> 1 & 7] :]


def read_package(spark: SparkSession, path: str, layer: str, columns: list[str], part_rows: int = 50_000) -> DataFrame:
    """columns (strings) and polys of a layer, in parts by row id; the file must be in
    a place that all executors mount. Columns the layer lacks are null."""
    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as db:
        have = [r[1] for r in db.execute(f'PRAGMA table_info("{layer}")')]
        (shape,) = db.execute("SELECT column_name FROM gpkg_geometry_columns WHERE table_name = ?", (layer,)).fetchone() or (None,)
        if shape is None:
            raise ValueError(f"{path} has no layer {layer}")
        low, high = db.execute(f'SELECT min(rowid), max(rowid) FROM "{layer}"').fetchone()
    wanted = [f'CAST("{c}" AS TEXT)' if c in have else "NULL" for c in columns]
    kind = pa.list_(pa.list_(pa.list_(pa.struct([("e", pa.float64()), ("n", pa.float64())]))))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in batch.column("id").to_pylist():
                with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as db:
                    rows = db.execute(f'SELECT {", ".join([*wanted, chr(34) + shape + chr(34)])} FROM "{layer}" WHERE rowid >= ? AND rowid < ? ORDER BY rowid', (start, start + part_rows)).fetchall()
                polys = [[[[{"e": e, "n": n} for e, n in ring] for ring in part] for part in wkb_parts(package_blob(r[-1]))] if r[-1] else None for r in rows]
                yield pa.RecordBatch.from_arrays([*[pa.array([r[k] for r in rows], pa.string()) for k in range(len(columns))], pa.array(polys, kind)], names=[*columns, "polys"])

    ship(spark)
    starts = spark.range(low or 0, (high or 0) + 1, part_rows)
    return starts.mapInArrow(scan, ", ".join([f"`{c}` string" for c in columns] + [f"polys array<array<{POINTS}>>"]))


#: Keys whose closed ways are areas, and the columns that layers have of their own.
AREA_KEYS = ("building", "natural", "landuse", "leisure", "amenity", "place", "aeroway", "military", "historic", "tourism", "shop", "office", "man_made")
OWN_COLUMNS = {"points": ("name",), "lines": ("name", "highway"), "multipolygons": ("name", "building", "natural")}


def osm_relations(spark: SparkSession, path: str) -> DataFrame:
    """osm_id, members (type, ref, role) in order, and tags of all relations."""
    schema = "_id bigint, member array<struct<_type:string,_ref:bigint,_role:string>>, tag array<struct<_k:string,_v:string>>"
    rows = spark.read.format("xml").option("rowTag", "relation").schema(schema).load(path)
    members = F.transform("member", lambda m: F.struct(m["_type"].alias("type"), m["_ref"].alias("ref"), m["_role"].alias("role")))
    return rows.select(F.col("_id").alias("osm_id"), members.alias("members"), _tags().alias("tags"))


def closed_rings(chains: list[list[tuple]]) -> list[list[tuple]]:
    """Rings of chains of points, joined where their ends are the same point, either way
    round; what does not close is left out."""
    out, open_ = [], []
    for c in chains:
        (out if len(c) > 3 and c[0] == c[-1] else open_).append(list(c))
    while open_:
        ring = open_.pop(0)
        while ring[0] != ring[-1]:
            k = next((k for k, c in enumerate(open_) if ring[-1] in (c[0], c[-1])), None)
            if k is None:
                break
            more = open_.pop(k)
            ring += (more if more[0] == ring[-1] else more[::-1])[1:]
        if len(ring) > 3 and ring[0] == ring[-1]:
            out.append(ring)
    return out


def _inside(point: tuple, ring: list[tuple]) -> bool:
    x, y = point
    return sum((a[1] <= y) != (b[1] <= y) and x < a[0] + (y - a[1]) * (b[0] - a[0]) / (b[1] - a[1]) for a, b in zip(ring, ring[1:])) % 2 == 1


def _area(ring: list[tuple]) -> float:
    return abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:]))) / 2


def polygons_of(outer: list[list[tuple]], inner: list[list[tuple]]) -> list[list[list[tuple]]]:
    """Polygons, an outer ring and its holes each; a hole goes to the least ring around it."""
    rings = closed_rings(outer)
    out = [[r] for r in rings]
    for hole in closed_rings(inner):
        around = [k for k, r in enumerate(rings) if _inside(hole[0], r)]
        if around:
            out[min(around, key=lambda k: _area(rings[k]))].append(hole)
    return out


def multipolygons(spark: SparkSession, relations: DataFrame, lines: DataFrame) -> DataFrame:
    """osm_id, tags and polys of the relations that are areas, from their ways (osm_id, pts).

    One relation is put together in one task; members that are not there are left out."""
    areas = relations.filter(F.col("tags")["type"].isin("multipolygon", "boundary"))
    parts = areas.select("osm_id", F.posexplode("members").alias("q", "m")).filter("m.type = 'way'").select("osm_id", "q", F.col("m.ref").alias("way"), F.coalesce("m.role", F.lit("")).alias("role"))
    met = parts.join(lines.select(F.col("osm_id").alias("way"), "pts"), "way")
    held = met.groupBy("osm_id").agg(F.array_sort(F.collect_list(F.struct("q", "role", "pts"))).alias("parts"))
    kind = pa.list_(pa.list_(pa.list_(pa.struct([("e", pa.float64()), ("n", pa.float64())]))))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            polys = []
            for parts in batch.column("parts").to_pylist():
                chains: tuple[list, list] = ([], [])
                for p in parts:
                    chains[p["role"] == "inner"].append([(x["e"], x["n"]) for x in p["pts"]])
                polys.append([[[{"e": e, "n": n} for e, n in ring] for ring in poly] for poly in polygons_of(*chains)])
            yield pa.RecordBatch.from_arrays([batch.column("osm_id"), pa.array(polys, kind)], names=["osm_id", "polys"])

    ship(spark)
    shaped = held.mapInArrow(build, f"osm_id bigint, polys array<array<{POINTS}>>").filter(F.size("polys") > 0)
    return areas.select("osm_id", "tags").join(shaped, "osm_id")


def hstore(tags, without: tuple[str, ...] = ()):
    """Tags as text, by key: "k"=>"v","k"=>"v"; null if there are none."""
    quote = lambda x: F.concat(F.lit('"'), F.regexp_replace(F.regexp_replace(x, r"\\", r"\\\\"), '"', r'\\"'), F.lit('"'))
    rest = F.array_sort(F.map_entries(F.map_filter(col(tags), lambda k, v: ~k.isin(*without) if without else F.lit(True))))
    return F.nullif(F.array_join(F.transform(rest, lambda t: F.concat(quote(t["key"]), F.lit("=>"), quote(t["value"]))), ","), F.lit(""))


def osm_layers(spark: SparkSession, path: str, project) -> dict[str, DataFrame]:
    """points, lines and areas of an OSM XML extract as a site's inputs need them.

    project(lat, lon) gives easting and northing. Nodes with tags are points. Closed ways
    with an area's key, and relations, are areas; all other ways with tags are lines."""
    e, n = project(F.col("lat"), F.col("lon"))
    nodes = osm_nodes(spark, path).withColumn("e", e).withColumn("n", n)
    ways = osm_ways(spark, path)
    lines = way_lines(ways, nodes)
    closed = (F.size("pts") > 3) & (F.element_at("pts", 1) == F.element_at("pts", -1))
    keyed = F.arrays_overlap(F.map_keys("tags"), F.array(*[F.lit(k) for k in AREA_KEYS])) & (F.coalesce(F.col("tags")["natural"], F.lit("")) != "coastline")
    is_area = closed & keyed
    own = lambda layer: [F.col("tags")[c].alias(c) for c in OWN_COLUMNS[layer]]
    text = lambda layer, *more: hstore("tags", (*OWN_COLUMNS[layer], *more)).alias("other_tags")
    points = nodes.filter(F.size("tags") > 0).select(F.col("osm_id").cast("string").alias("id"), *own("points"), text("points"), "e", "n")
    drawn = lines.filter(~is_area & (F.size("tags") > 0)).select(F.col("osm_id").cast("string").alias("osm_id"), *own("lines"), text("lines"), "pts")
    flat = lines.filter(is_area).select(F.concat(F.lit("w"), "osm_id").alias("osm_id"), "tags", F.array(F.array("pts")).alias("polys"))
    joined = multipolygons(spark, osm_relations(spark, path), lines).select(F.concat(F.lit("r"), "osm_id").alias("osm_id"), "tags", "polys")
    areas = flat.unionByName(joined).select(
        F.pmod(F.xxhash64("osm_id"), F.lit(1 << 62)).alias("idx"), "osm_id", *own("multipolygons"), F.col("tags")["building:levels"].alias("levels_tag"),
        text("multipolygons", "type"), "polys",
    )
    return {"points": points, "lines": drawn, "areas": areas}
