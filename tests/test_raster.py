import numpy as np
import pytest
from landsurvey.config import GridError, Site, tile_pixels
from landsurvey.operators import polygons, raster
from pyspark.sql import functions as F


def grid(spark, z):
    h, w = z.shape
    rows = [(r, c, float(c), float(h - 1 - r), None if np.isnan(z[r, c]) else float(z[r, c])) for r in range(h) for c in range(w)]
    return spark.createDataFrame(rows, "row int, col int, e double, n double, z double")


def array(rows, value, shape):
    out = np.full(shape, np.nan)
    for r in rows:
        if r[value] is not None:
            out[r["row"], r["col"]] = r[value]
    return out


def test_slope_is_the_gradient(spark):
    z = np.random.default_rng(0).normal(0, 5, (7, 9))
    got = array(raster.slope_degrees(grid(spark, z), (2.0, 3.0)).collect(), "slope", z.shape)
    gy, gx = np.gradient(z)
    assert np.allclose(got, np.degrees(np.arctan(np.hypot(gx / 2, gy / 3))), atol=1e-9)
    one = raster.slope_degrees(grid(spark, z[:1, :1]), (1.0, 1.0)).collect()
    assert one[0].slope == 0.0


def test_calmest_neighbour_leaves_out_holes(spark):
    z = np.array([[0.0, np.nan, 5.0], [0.5, 9.0, np.nan]])
    got = array(grid(spark, z).withColumn("dz", raster.calmest_step()).collect(), "dz", z.shape)
    assert got[0, 0] == 0.5 and got[1, 1] == 8.5
    assert np.isnan(got[0, 2])  # no neighbour has a height


@pytest.mark.parametrize("seed", range(4))
def test_nearest_fill_is_euclidean(seed):
    rng = np.random.default_rng(seed)
    z = rng.normal(0, 1, (12, 17))
    bad = rng.random(z.shape) < (0.3, 0.7, 0.95, 0.02)[seed]
    filled = np.where(bad, np.nan, z)
    assert raster.nearest_fill(filled, bad) == "nearest"
    good = np.argwhere(~bad)
    for r, c in np.argwhere(bad):
        d = ((good - [r, c]) ** 2).sum(axis=1)
        first = good[np.flatnonzero(d == d.min())][0]  # least row, then column
        assert filled[r, c] == z[tuple(first)] or (d == d.min()).sum() > 1
        assert filled[r, c] in {z[tuple(g)] for g in good[d == d.min()]}
    again = filled.copy()
    assert raster.nearest_fill(again, np.zeros_like(bad)) == "none" and (again == filled).all()


def test_all_holes_fill_with_zero():
    z = np.full((3, 3), np.nan)
    assert raster.nearest_fill(z, np.isnan(z)) == "all-nodata -> 0"
    assert (z == 0).all()


def test_bilinear_rules(spark):
    z = np.arange(12.0).reshape(3, 4)
    z[0, 0] = np.nan
    shape = spark.createDataFrame([(4, 3)], "w int, h int")
    asked = [(0, 1.5, 1.5), (1, 3.0, 2.0), (2, 0.0, 0.5), (3, 3.1, 1.0), (4, 2.0, -0.1), (5, 1.0, 0.0), (6, 2.25, 1.0)]
    points = spark.createDataFrame(asked, "id int, fx double, fy double")
    got = {r.id: r.z for r in raster.bilinear(points, ["id"], grid(spark, z), shape).collect()}
    assert got[0] == 7.5 and got[1] == 11.0 and got[6] == 6.25
    assert got.get(2) is None  # a hole among the four
    assert 3 not in got and 4 not in got  # outside: no clamping
    assert got[5] == 1.0


def test_mosaic_takes_the_last_height(spark):
    rows = [("a", 0, 1, 1.0, 0.0, 5.0), ("b", 0, 1, 1.0, 0.0, None), ("a", 0, 2, 2.0, 0.0, 1.0), ("b", 0, 2, 2.0, 0.0, 2.0)]
    df = spark.createDataFrame(rows, "tile_name string, row int, col int, e double, n double, z double")
    assert {r.col: r.z for r in raster.mosaic(df).collect()} == {1: 5.0, 2: 2.0}


def test_bands_use_up_nearly_all(spark):
    rng = np.random.default_rng(1)
    rows = [(r, c, bool(rng.random() < 0.3), bool(rng.random() < 0.2), float(rng.random())) for r in range(8) for c in range(8)]
    df = spark.createDataFrame([(*x[:2], x[2] and not x[3], *x[3:]) for x in rows], "r int, c int, sand boolean, water boolean, rock double")
    out = raster.class_bands(df.withColumn("t", F.lit(0)), ["t"], 2, 2).collect()
    assert len(out) == 16 and all(252 <= r.grass + r.sand + r.rock + r.water <= 255 for r in out)


def test_encoding_refuses_what_does_not_fit():
    assert raster.encoding_window(-0.5, 56.5) == (-6.0, 68.0)
    with pytest.raises(ValueError, match="do not fit"):
        raster.encoding_window(0, 10, base=1.0, size=100.0)


def test_tiles_must_be_whole_pixels():
    site = Site("x", "EPSG:27700", (0, 0), 512)
    assert tile_pixels(site, (0, 2, 0, 0, 0, -2), 256) == (256, 256)
    with pytest.raises(GridError):
        tile_pixels(site, (0, 3, 0, 0, 0, -3))
    with pytest.raises(GridError):
        tile_pixels(site, (0, 2, 0, 0, 0, -2), 100)


def shapes(spark, rings):
    rows = [(i, [[(float(e), float(n)) for e, n in r] for r in rs]) for i, rs in enumerate(rings)]
    return spark.createDataFrame(rows, "idx int, rings array<array<struct<e:double,n:double>>>")


def box(x, y, w, h):
    return [(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]


def cells(df):
    return {(r.cx, r.cy): r.idx for r in df.collect()}


def test_centres_holes_and_overlaps(spark):
    ell = [(0.2, 0.2), (5.2, 0.2), (5.2, 2.2), (2.2, 2.2), (2.2, 5.2), (0.2, 5.2), (0.2, 0.2)]
    got = cells(polygons.rasterise(shapes(spark, [[ell], [box(10.2, 0.2, 5, 5), box(11.2, 1.2, 3, 3)], [box(3.2, 0.2, 3, 1)]]), (0.0, 0.0), 1.0))
    first = {k for k, v in got.items() if v == 0}
    assert first == {(x, y) for x in range(1, 6) for y in range(1, 6) if x <= 2 or y <= 2} - {k for k, v in got.items() if v == 2}
    assert {k for k, v in got.items() if v == 1} == {(x, y) for x in range(11, 16) for y in range(1, 6)} - {(x, y) for x in (12, 13, 14) for y in (2, 3, 4)}
    assert {k for k, v in got.items() if v == 2} == {(4, 1), (5, 1), (6, 1)}  # the later one wins
    edge = cells(polygons.rasterise(shapes(spark, [[box(1, 1, 2, 2)]]), (0.0, 0.0), 1.0))
    assert set(edge) == {(1, 1), (2, 1), (1, 2), (2, 2)}  # a centre on an edge counts for one side


def test_erosion_and_second_try(spark):
    wide, thin = box(0.4, 0.4, 6.2, 6.2), box(20.2, 0.2, 0.5, 4)
    plain = cells(polygons.rasterise(shapes(spark, [[wide]]), (0.0, 0.0), 1.0))
    eroded = cells(polygons.rasterise(shapes(spark, [[wide]]), (0.0, 0.0), 1.0, 1.0))
    assert set(plain) == {(x, y) for x in range(1, 7) for y in range(1, 7)}
    assert set(eroded) == {(x, y) for x in range(2, 6) for y in range(2, 6)}
    both = cells(polygons.rasterise_all(shapes(spark, [[wide], [thin]]), (0.0, 0.0), 1.0, 0.5))
    assert {k for k, v in both.items() if v == 1} == {(x, y) for x in (20, 21) for y in range(0, 5)}


def test_edges_are_not_broadcast(spark, tmp_path):
    # their size is estimated from the file, before rings are exploded
    ring = [(0.0, 0.0), (9.0, 0.0), (9.0, 9.0), (0.0, 9.0), (0.0, 0.0)]
    rows = spark.createDataFrame([(1, [[dict(zip("en", p)) for p in ring]])], "idx int, rings array<array<struct<e: double, n: double>>>")
    rows.write.parquet(str(tmp_path / "rings"))
    plan = polygons.judged(spark.read.parquet(str(tmp_path / "rings")), (0.0, 0.0), 4.0)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [idx" in plan and "BroadcastHashJoin" not in plan
