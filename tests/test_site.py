import json

import numpy as np
import pytest
from landsurvey.config import Calibration, Site, Tuning
from landsurvey.plans.site import STEPS, Build, Inputs
from landsurvey.sources import images, records, tiff

E0, N0, T, PX = 500000.0, 150000.0, 512.0, 8.0


@pytest.fixture(scope="module")
def build(spark):
    """A coast of two tiles in 8 m cells: a plane with a cliff, a beach, the sea and a hole."""
    w, h = 129, 65
    dtm, dsm = [], []
    for row in range(h):
        for col in range(w):
            e, n = E0 + col * PX, N0 + (h - 1 - row) * PX
            z = -1.0 if n < N0 + 60 else 5 + 0.02 * (e - E0) + (20.0 if n >= N0 + 306 else 0.0)
            hole = 700 <= e - E0 < 740 and 400 <= n - N0 < 440
            dtm.append((row, col, e, n, None if hole else z))
            dsm.append((row, col, e, n, None if hole else z + 7.0))
    cell = "row int, col int, e double, n double, z double"
    pts = lambda *ps: [(E0 + x, N0 + y) for x, y in ps]
    ways = [
        ("w1a", "residential", '"lanes"=>"2"', pts((100, 200), (600, 200))), ("w1b", "residential", None, pts((600, 200), (900, 250))),
        ("w2", "footway", None, pts((600, 200), (600, 100))), ("w4", "primary", '"bridge"=>"yes"', pts((720, 380), (720, 460))),
        ("w6", "construction", None, pts((0, 0), (9, 9))), ("w8", "residential", None, pts((-200, 100), (-100, 100))), ("w9", "footway", None, pts((-50, 150), (50, 150))),
    ]
    lines = spark.createDataFrame([(i, c, "x", t, p) for i, c, t, p in ways], "osm_id string, highway string, name string, other_tags string, pts array<struct<e:double,n:double>>")
    box = lambda x, y, a, b: [[[(E0 + x + i * a, N0 + y + j * b) for i, j in ((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))]]]
    areas = [(0, "b1", "house", None, box(150, 220, 60, 60)), (1, "b2", "shed", None, box(300, 230, 9, 9)), (2, "b3", "yes", None, box(-300, 100, 40, 40)), (3, "s", None, "beach", box(0, 60, 400, 60))]
    areas = spark.createDataFrame(
        [(i, o, b, "n", None, nat, "", p) for i, o, b, nat, p in areas],
        "idx int, osm_id string, building string, name string, levels_tag string, natural string, other_tags string, polys array<array<array<struct<e:double,n:double>>>>",
    )
    nodes = [("n1", E0 + 300, N0 + 201, "waste_basket"), ("n3", E0 + 300, N0 + 240, "waste_basket"), ("n4", E0 - 50, N0 + 100, "waste_basket"), ("n5", E0 + 310, N0 + 205, "bench")]
    points = spark.createDataFrame([(i, "bin", f'"amenity"=>"{a}"', e, n) for i, e, n, a in nodes], "id string, name string, other_tags string, e double, n double")
    site = Site("a", "EPSG:27700", (E0, N0), T, 2, 1, 65, water_level=-1.0, foreshore_max=1.2, calibration=Calibration(min_buildings=3), landmarks=(("Nowhere", 9.0, None),))
    return Build(spark, site, Tuning(class_res=16), Inputs(spark.createDataFrame(dtm, cell), spark.createDataFrame(dsm, cell), lines, areas, points, PX))


def test_networks(build):
    rows = build.networks().collect()
    segs = {}
    for r in rows:
        segs.setdefault(r.id if r.cls != "_junction" else "_junction", []).append(r)
    assert set(segs) == {"w1a", "w1b", "w2", "w4", "w9", "_junction"}
    west, east = sorted(segs["w1a"], key=lambda r: r.tile_x)
    assert west.pts[-1] == east.pts[0] and west.w == 7.0 and not west.z_gap
    (bridge,) = segs["w4"]
    assert bridge.z_gap and bridge.bridge
    assert all(p[0] >= E0 for p in segs["w9"][0].pts)
    (disc,) = segs["_junction"]
    assert abs(disc.r - 3.9) < 1e-9 and disc.pts[0][:2] == [E0 + 600, N0 + 200] and abs(disc.pts[0][2] - 17.0) < 1e-6
    assert all(abs(p[2] - (5 + 0.02 * (p[0] - E0))) < 1e-6 for p in west.pts)


def test_massing(build):
    got = {r.id: r for r in build.massing().collect()}
    assert set(got) == {"b1", "b2"}
    assert got["b1"].src == "lidar_p50" and abs(got["b1"].h - 7.0) < 1e-6 and got["b1"].lidar_px == 42
    assert len(got["b1"].rings[0].pts) == 5 and not got["b1"].rings[0].hole
    assert got["b2"].src == "lidar_lowconf" and got["b2"].roof == "flat" and got["b2"].lidar_px >= 1


def test_ground_and_terrain(build):
    bands = build.ground().collect()
    assert len(bands) == 2 * 16 * 16
    assert all(252 <= r.grass + r.sand + r.rock + r.water <= 255 for r in bands)
    assert all(r.water == 255 for r in bands if r.br == 15)  # the south is sea
    assert any(r.sand == 255 for r in bands if r.tile_x == 0 and r.br == 13) and max(r.rock for r in bands) > 100
    stats = {r.tile_x: r for r in build.terrain().collect()}
    assert stats[0].nodata_cells == 0 and stats[1].nodata_cells == 25
    assert stats[0].slope_max > 45 and stats[1].min_m == -1.0


def test_furniture(build):
    got = {r.id: r for r in build.furniture().collect()}
    assert set(got) == {"n1", "n3"}
    assert got["n1"].nudged and got["n1"].n == N0 + 204.25 and got["n1"].src == "kerb" and got["n1"].bearing == 90.0
    assert (got["n3"].src, got["n3"].z, got["n3"].prop) == ("terrain", None, "LitterBin")


def test_write(build, tmp_path):
    build.write(str(tmp_path))
    (file,) = (tmp_path / "massing_manifest").glob("*.txt")
    assert json.loads(file.read_text()) == {"rows": 2, "tiles": 1, "site": "a", "crs": "EPSG:27700", "tile_m": 512.0}
    with pytest.raises(ValueError, match="no step"):
        build.products("roof")


def test_images(spark):
    df = spark.createDataFrame([(0, 0, r, c, 1000 * r + c) for r in range(2) for c in range(3)], "tile_x int, tile_y int, r int, c int, v int")
    (row,) = images.tile_blobs(spark, df, ["v"], "raw").collect()
    assert np.frombuffer(row.image, "<u2").tolist() == [0, 1, 2, 1000, 1001, 1002]
    assert images.png(np.zeros((2, 3, 3)))[:8] == b"\x89PNG\r\n\x1a\n" and len(images.png(np.arange(6).reshape(2, 3))) > 50


def test_files_and_manifests(build, spark, tmp_path):
    log = build.write(str(tmp_path))
    read = lambda name: json.loads((tmp_path / name).read_text())
    terrain = read("terrain_manifest.json")
    assert [(t["x"], t["y"], t["nodata_cells"], t["fill"]) for t in terrain["tiles"]] == [(0, 0, 0, "none"), (1, 0, 25, "nearest")]
    assert terrain["tiles_missing"] == [] and terrain["range_m"][0] == -1.0 and terrain["slope_qa"]["max_deg"] > 45
    values, transform, _ = tiff.read((tmp_path / "terrain_tif/dtm_x1_y0.tif").read_bytes())
    assert values.shape == (64, 64, 1) and values.dtype == np.float32 and transform[0] == E0 + T - PX / 2 and transform[1] == PX
    assert values[-1, 0, 0] == -1.0 and abs(values[40, 8, 0] - (5 + 0.02 * (T + 8 * PX))) < 1e-4
    bands, transform, _ = tiff.read((tmp_path / "ground_tif/ground_x0_y0.tif").read_bytes())
    assert bands.shape == (16, 16, 4) and bands.dtype == np.uint8 and (bands[-1, :, 3] == 255).all() and transform[:2] == (E0, T / 16)
    networks = read("networks_manifest.json")
    assert networks["junctions"] == 1 and networks["segments"] == 7 and networks["vertices_without_dtm"] > 0 and networks["vertices_outside_grid"] > 0
    assert networks["length_km"] == 1.18 and networks["widths_m"]["residential"] == [6.0, 1.5]
    massing = read("massing_manifest.json")
    assert massing["buildings"] == 2 and massing["outside_grid"] == 1 and massing["by_height_source"] == {"lidar_lowconf": 1, "lidar_p50": 1} and massing["qa_flagged"] == 1
    assert [json.loads(x)["osm_id"] for f in (tmp_path / "qa_height_outliers").glob("*.json") for x in f.read_text().splitlines()] == ["b2"]
    coast = read("coast_manifest.json")
    assert coast["water_tiles"] == [[0, 0], [1, 0]] and coast["tiles_without_dtm"] == [] and coast["bands"] == ["grass", "sand", "rock", "water"]
    furniture = read("furniture_manifest.json")
    assert furniture["placed"] == 2 and furniture["outside_grid"] == 1 and furniture["amenity_kinds_seen"] == {"waste_basket": 3, "bench": 1} and furniture["nudged_out_of_carriageway"] == 1
    assert "1 landmarks match no building" in log["massing"]["warnings"][0] and "no ground" in log["networks"]["warnings"][0]
    assert read("run_log.json").keys() == log.keys()
    # records have two decimals
    lines = [json.loads(x) for f in (tmp_path / "networks").rglob("*.json") for x in f.read_text().splitlines()]
    assert all(v == round(v, 2) for r in lines for p in r["pts"] for v in p)


def test_runner(build):
    assert build.steps() == list(STEPS) and build.steps(start="ground") == ["ground", "furniture"] and build.steps("massing") == ["massing"]
    assert build.preflight() == []
    with pytest.raises(ValueError, match="no step"):
        build.steps(start="roof")


def test_rounding_is_pythons(spark):
    rows = [(2.675, [[1.005, None], None], (0.125, "a")), (None, None, None), (-0.0, [], (1e9 + 0.005, None))]
    df = spark.createDataFrame(rows, "x double, y array<array<double>>, z struct<a:double,b:string>")
    got = [tuple(r) for r in records.rounded(spark, df).collect()]
    assert [r[0] for r in got] == [round(2.675, 2), None, 0.0]
    assert got[0][1] == [[round(1.005, 2), None], None] and got[1][1] is None and got[2][1] == []
    assert [r[2] and tuple(r[2]) for r in got] == [(round(0.125, 2), "a"), None, (round(1e9 + 0.005, 2), None)]
