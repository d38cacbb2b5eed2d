import hashlib
import json
import sqlite3
import struct

import numpy as np
import pytest
from landsurvey.sources import records, tiff, vector
from pyspark.sql import functions as F


@pytest.mark.parametrize("dtype", ["float32", "uint8", "int16"])
def test_tiff_round_trip(dtype):
    z = (np.arange(35).reshape(5, 7) * 3).astype(dtype)
    data = tiff.write(z, (100.0, 2.0, 0.0, 50.0, 0.0, -2.0), -9999.0 if dtype != "uint8" else None)
    got, gt, nodata = tiff.read(data)
    assert (got[:, :, 0] == z).all() and gt == (100.0, 2.0, 0.0, 50.0, 0.0, -2.0)
    kind = {"float32": "float32", "uint8": "uint8", "int16": "int16"}[dtype]
    assert tiff.info(data) == {"width": 7, "height": 5, "dtype": kind, "nodata": None if dtype == "uint8" else -9999.0}
    assert tiff.info(b"<html>no tile</html>") is None and tiff.info(data[:20]) is None and tiff.info(b"II+\0" + data[4:]) is None


def test_big_endian_header():
    tags = [(256, 3, 1, struct.pack(">HH", 9, 0)), (257, 3, 1, struct.pack(">HH", 8, 0)), (258, 3, 1, struct.pack(">HH", 32, 0)), (339, 3, 1, struct.pack(">HH", 3, 0))]
    data = b"MM" + struct.pack(">HIH", 42, 8, 4) + b"".join(struct.pack(">HHI", *t[:3]) + t[3] for t in tags) + b"\0\0\0\0"
    assert tiff.info(data) == {"width": 9, "height": 8, "dtype": "float32", "nodata": None}


def test_tiles_on_disk(spark, tmp_path):
    z = np.arange(9.0, dtype=np.float32).reshape(3, 3)
    z[0, 0] = -9999
    (tmp_path / "dtm_x0_y0.tif").write_bytes(tiff.write(z, (-0.5, 1.0, 0.0, 2.5, 0.0, -1.0), -9999.0))
    (tmp_path / "dtm_x1_y0.tif").write_bytes(tiff.write(z[:2], (-0.5, 1.0, 0.0, 2.5, 0.0, -1.0)))
    (tmp_path / "dtm_x2_y0.tif").write_bytes(b"<html>")
    status = {r.path.rsplit("/", 1)[1]: r.status for r in tiff.tile_status(spark, str(tmp_path / "*.tif"), (3, 3)).collect()}
    assert status == {"dtm_x0_y0.tif": "ok", "dtm_x1_y0.tif": "BAD", "dtm_x2_y0.tif": "EMPTY"}
    cells = {(r.row, r.col): r for r in tiff.read_cells(spark, str(tmp_path / "dtm_x0_y0.tif")).collect()}
    assert cells[0, 0].z is None and (cells[2, 1].e, cells[2, 1].n, cells[2, 1].z) == (1.0, 0.0, 7.0)
    bands = spark.createDataFrame([(0, 0, r, c, r * 10 + c, 255 - r) for r in range(2) for c in range(2)], "tile_x int, tile_y int, r int, c int, grass int, sand int")
    (row,) = tiff.tile_images(spark, bands, ["grass", "sand"], "uint8", lambda x, y: (0.0, 2.0, 0.0, 4.0, 0.0, -2.0)).collect()
    assert tiff.read(row.image)[0].tolist() == [[[0, 255], [1, 255]], [[10, 254], [11, 254]]]


OSM = """<osm><node id="1" lat="52.6575703056" lon="1.7179215833"><tag k="amenity" v="bench"/></node><node id="2" lat="52.66" lon="1.72"/>
<way id="7"><nd ref="2"/><nd ref="1"/><tag k="highway" v="path"/></way><way id="8"><nd ref="1"/></way></osm>"""


def test_osm_xml_and_projection(spark, tmp_path):
    (tmp_path / "x.osm").write_text(OSM)
    nodes = vector.osm_nodes(spark, str(tmp_path / "x.osm"))
    assert {r.osm_id: r.tags for r in nodes.collect()} == {1: {"amenity": "bench"}, 2: {}}
    e, n = vector.transverse_mercator("lat", "lon", **vector.BRITISH_GRID)
    placed = nodes.select("osm_id", e.alias("e"), n.alias("n"))
    one = placed.filter("osm_id = 1").first()
    # the worked example that the grid's publisher gives
    assert abs(one.e - 651409.903) < 0.01 and abs(one.n - 313177.270) < 0.01
    ways = {r.osm_id: r for r in vector.way_lines(vector.osm_ways(spark, str(tmp_path / "x.osm")), placed).collect()}
    assert len(ways[7].pts) == 2 and abs(ways[7].pts[1].e - one.e) < 1e-9 and ways[7].tags == {"highway": "path"} and len(ways[8].pts) == 1


def test_datum_shift(spark):
    df = spark.createDataFrame([(52.65798, 1.71605)], "lat double, lon double")
    lat, lon = vector.shift_datum("lat", "lon", 24.7)
    e, n = vector.transverse_mercator(lat, lon, **vector.BRITISH_GRID)
    row = df.select(e.alias("e"), n.alias("n")).first()
    assert abs(row.e - 651409.9) < 8 and abs(row.n - 313177.3) < 8  # metres, by seven parameters


def test_geopackage(spark, tmp_path):
    path = str(tmp_path / "x.gpkg")
    ring = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]
    flat = b"".join(struct.pack("<2d", *p) for p in ring)
    polygon = struct.pack("<BII", 1, 3, 1) + struct.pack("<I", 4) + flat
    multi = struct.pack("<BII", 1, 6, 2) + polygon * 2
    head = b"GP\0" + bytes([1 | 1 << 1]) + struct.pack("<i4d", 27700, 0, 1, 0, 1)
    with sqlite3.connect(path) as db:
        db.execute("CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT)")
        db.execute("INSERT INTO gpkg_geometry_columns VALUES ('multipolygons', 'geom')")
        db.execute("CREATE TABLE multipolygons (fid INTEGER PRIMARY KEY, geom BLOB, osm_id TEXT, building TEXT)")
        db.executemany("INSERT INTO multipolygons (geom, osm_id, building) VALUES (?, ?, ?)", [(head + multi, "5", "house"), (None, "6", None)])
    rows = vector.read_package(spark, path, "multipolygons", ["osm_id", "building", "amenity"], part_rows=1).orderBy("osm_id").collect()
    assert [(r.osm_id, r.building, r.amenity) for r in rows] == [("5", "house", None), ("6", None, None)]
    assert [[tuple(p) for p in r] for r in rows[0].polys[1]] == [ring] and rows[1].polys is None
    with pytest.raises(ValueError, match="no layer"):
        vector.read_package(spark, path, "lines", [])


def test_records_and_manifest(spark, tmp_path):
    df = spark.createDataFrame([(0, 1, "b", None), (0, 1, "a", 2.0), (1, 1, "c", 3.0)], "tile_x int, tile_y int, id string, z double")
    out = str(tmp_path / "out")
    records.write_tiles(df, out, ["id"])
    records.write_tiles(df.filter("tile_x = 0"), out, ["id"])  # no stale tile stays
    back = records.read_tiles(spark, out, "tile_x int, tile_y int, id string, z double").collect()
    assert sorted((r.tile_x, r.id, r.z) for r in back) == [(0, "a", 2.0), (0, "b", None)]
    (file,) = (tmp_path / "out" / "tile_x=0" / "tile_y=1").glob("*.json")
    assert file.read_text().splitlines() == ['{"id":"a","z":2.0}', '{"id":"b","z":null}']
    text = df.agg(records.manifest(rows=F.count(F.lit(1)), nothing=F.max(F.lit(None).cast("int")))).first().manifest
    assert json.loads(text) == {"rows": 3, "nothing": None}
    (row,) = records.provenance(spark, str(file)).collect()
    assert row.sha256 == hashlib.sha256(file.read_bytes()).hexdigest() and row.bytes == file.stat().st_size


EXTRACT = """<osm>
<node id="1" lat="0" lon="0"/><node id="2" lat="0" lon="10"/><node id="3" lat="10" lon="10"/><node id="4" lat="10" lon="0"/>
<node id="5" lat="3" lon="3"/><node id="6" lat="3" lon="5"/><node id="7" lat="5" lon="5"/><node id="8" lat="50" lon="50"><tag k="amenity" v="bench"/><tag k="note" v="a &quot;b&quot; \\ c"/></node>
<way id="10"><nd ref="1"/><nd ref="2"/><nd ref="3"/></way>
<way id="11"><nd ref="1"/><nd ref="4"/><nd ref="3"/></way>
<way id="12"><nd ref="5"/><nd ref="6"/><nd ref="7"/><nd ref="5"/></way>
<way id="13"><nd ref="5"/><nd ref="6"/><nd ref="7"/><nd ref="5"/><tag k="building" v="shed"/><tag k="building:levels" v="2"/></way>
<way id="14"><nd ref="1"/><nd ref="7"/><tag k="highway" v="path"/><tag k="name" v="Way"/><tag k="lanes" v="2"/></way>
<way id="15"><nd ref="5"/><nd ref="6"/><nd ref="7"/><nd ref="5"/><tag k="highway" v="service"/></way>
<relation id="20"><member type="way" ref="10" role="outer"/><member type="node" ref="8" role="label"/><member type="way" ref="12" role="inner"/><member type="way" ref="11" role="outer"/>
<member type="way" ref="99" role="outer"/><tag k="type" v="multipolygon"/><tag k="building" v="house"/></relation>
<relation id="21"><member type="way" ref="10" role="outer"/><tag k="type" v="multipolygon"/><tag k="building" v="open"/></relation>
</osm>"""


def test_osm_layers(spark, tmp_path):
    (tmp_path / "x.osm").write_text(EXTRACT)
    layers = vector.osm_layers(spark, str(tmp_path / "x.osm"), lambda lat, lon: (lon * 1.0, lat * 1.0))
    areas = {r.osm_id: r for r in layers["areas"].collect()}
    assert set(areas) == {"w13", "r20"}  # a ring that does not close is no area
    outer, hole = areas["r20"].polys[0]
    assert len(areas["r20"].polys) == 1 and {tuple(p) for p in outer} == {(0, 0), (10, 0), (10, 10), (0, 10)} and outer[0] == outer[-1] and len(outer) == 5
    assert {tuple(p) for p in hole} == {(3, 3), (5, 3), (5, 5)}
    assert (areas["w13"].building, areas["w13"].levels_tag, areas["w13"].other_tags) == ("shed", "2", '"building:levels"=>"2"') and areas["r20"].other_tags is None
    assert areas["w13"].idx != areas["r20"].idx
    lines = {r.osm_id: r for r in layers["lines"].collect()}
    assert set(lines) == {"14", "15"} and (lines["14"].highway, lines["14"].name, lines["14"].other_tags) == ("path", "Way", '"lanes"=>"2"')
    (node,) = layers["points"].collect()
    assert (node.id, node.e, node.n) == ("8", 50.0, 50.0) and node.other_tags == '"amenity"=>"bench","note"=>"a \\"b\\" \\\\ c"'


def test_holes_go_to_the_least_ring_around_them():
    box = lambda x, y, w: [(x, y), (x + w, y), (x + w, y + w), (x, y + w), (x, y)]
    polys = vector.polygons_of([box(0, 0, 100), box(20, 20, 10)], [box(22, 22, 2), box(60, 60, 5), box(500, 0, 1)])
    assert [len(p) for p in polys] == [2, 2] and polys[1][1] == box(22, 22, 2) and polys[0][1] == box(60, 60, 5)
