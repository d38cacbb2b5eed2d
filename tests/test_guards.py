import json

import pytest
from landsurvey.config import Site
from landsurvey.plans.adapters import LocalAxes, flat_tiles
from landsurvey.sources import guards

SITE = Site("a", "EPSG:27700", (100.0, 200.0), 512.0, 2, 1, 257)


def test_windows_and_stamps(tmp_path):
    assert guards.request_window(SITE, 1, 0, 2.0) == (611.0, 199.0, 1125.0, 713.0)
    stamp = tmp_path / "grid.json"
    assert not guards.check_stamp(str(stamp), SITE)
    stamp.write_text(json.dumps(guards.grid_stamp(SITE)))
    assert guards.check_stamp(str(stamp), SITE)
    with pytest.raises(guards.StaleInputError):
        guards.check_stamp(str(stamp), Site("b", "EPSG:27700", (0.0, 0.0), 512.0, 2, 1, 257))


def test_extracts(tmp_path):
    path = tmp_path / "x.osm"
    assert not guards.extract_is_current(str(path), [1, 2], {"bbox": [1, 2]})
    path.write_text("<?xml version='1.0'?><osm/>")
    assert guards.extract_is_current(str(path), [1, 2], {"bbox": [1, 2]})
    assert not guards.extract_is_current(str(path), [1, 3], {"bbox": [1, 2]})
    path.write_text("busy")
    assert not guards.extract_is_current(str(path), [1, 2], {"bbox": [1, 2]})
    assert guards.answer_problem("<html>") == "not XML"
    assert guards.answer_problem("<?xml?><osm><remark> runtime error") and guards.answer_problem("<osm></osm>") == "no nodes"
    assert guards.answer_problem("<osm><node/></osm>") is None


def test_extent_and_layers(spark):
    df = spark.createDataFrame([(1.0, 2.0), (5.0, 6.0)], "e double, n double")
    guards.check_extent(df, (0, 0, 10, 10), 0)
    guards.check_extent(df, (2, 2, 5, 6), 1)
    with pytest.raises(guards.StaleInputError):
        guards.check_extent(df, (2, 2, 5, 6), 0.5)
    with pytest.raises(guards.StaleInputError):
        guards.check_extent(df.limit(0), (0, 0, 1, 1), 0)
    guards.require_layers(["points", "lines", "multipolygons"])
    with pytest.raises(guards.StaleInputError, match="lines"):
        guards.require_layers(["points", "multipolygons"])


def test_adapter(spark):
    net = spark.createDataFrame(
        [(0, 0, "w", "path", True, False, False, None, [[101.0, 202.0, 5.0]]), (0, 0, None, "_junction", None, None, None, 3.9, [[100.0, 200.0, 1.0]])],
        "tile_x int, tile_y int, id string, cls string, bridge boolean, tunnel boolean, z_gap boolean, r double, pts array<array<double>>",
    )
    bands = spark.createDataFrame([(0, 0, 0, 0, 100, 50, 50, 55), (0, 0, 1, 0, 255, 0, 0, 0)], "tile_x int, tile_y int, br int, bc int, grass int, sand int, rock int, water int")
    out = LocalAxes(SITE).apply({"networks": net, "ground": bands})
    assert set(out) == {"networks", "ground"}
    pts = {r.cls: r.pts for r in out["networks"].collect()}
    assert pts["path"] == [[1.0, 8.1, 2.0]] and pts["_junction"] == [[0.0, 1.085, 0.0]]
    got = {r.br: (r.grass, r.sand, r.rock) for r in out["ground"].collect()}
    assert got == {1: (155, 50, 50), 0: (255, 0, 0)}
    cells = spark.createDataFrame([(0, 0, 0, 0, -0.5), (0, 0, 1, 0, 56.5)], "tile_x int, tile_y int, r int, c int, z double")
    axes = LocalAxes(SITE)
    assert axes.window(cells) == (-6.0, 68.0)
    assert {r.r: r.code for r in axes.heights(cells, 2).collect()} == {1: round(5.5 / 68 * 65535), 0: round(62.5 / 68 * 65535)}
    with pytest.raises(ValueError, match="do not fit"):
        LocalAxes(SITE, window=(0.0, 10.0)).window(cells)
    assert flat_tiles(spark.createDataFrame([(1, 0), (0, 1)], "tile_x int, tile_y int")).first().tiles == [0, 1, 1, 0]
