import math
import random

import pytest
from landsurvey.config import AmbiguousSiteError, Calibration, Site, Tuning, load_site
from landsurvey.functions import geometry, scalar
from landsurvey.operators import furniture, local_axes, massing, roads
from pyspark.sql import functions as F

PTS = "array<struct<e:double,n:double>>"


def line(spark, *ways):
    return spark.createDataFrame([(str(i), [(float(e), float(n)) for e, n in w]) for i, w in enumerate(ways)], f"id string, pts {PTS}")


def points(df, expr):
    return [[(p.e, p.n) for p in r.p] for r in df.select("id", expr.alias("p")).orderBy("id").collect()]


def test_densify_and_chaikin(spark):
    rng = random.Random(1)
    ways = [[(rng.uniform(0, 90), rng.uniform(0, 90)) for _ in range(n)] for n in (1, 2, 3, 7)] + [[(0, 0), (16, 0)], [(0, 0), (0, 0), (8, 0)]]
    df = line(spark, *ways)
    for got, way in zip(points(df, geometry.densify(F.col("pts"), 8.0)), ways, strict=True):
        at = [i for i, p in enumerate(got) if p in {(float(e), float(n)) for e, n in way}]
        assert [got[i] for i in at] == [(float(e), float(n)) for e, n in way]  # every vertex stays, in order
        for (i, j), a, b in zip(zip(at, at[1:]), way, way[1:]):
            # what is added lies on the piece, step by step from its start, and the rest is shorter
            steps = [math.dist(a, p) for p in got[i : j + 1]]
            assert j - i == max(1, math.ceil(math.dist(a, b) / 8.0 - 1e-9))
            assert all(abs(d - 8.0 * k) < 1e-9 for k, d in enumerate(steps[:-1]))
            assert all(abs(math.dist(a, p) + math.dist(p, b) - math.dist(a, b)) < 1e-9 for p in got[i : j + 1])
    for times in (1, 2):
        for got, way in zip(points(df, geometry.chaikin(F.col("pts"), times)), ways, strict=True):
            assert len(got) == (len(way) * 2**times if len(way) > 2 else len(way))
            assert got[0] == way[0] and got[-1] == way[-1]


def test_clip(spark):
    rows = [(-5.0, 5.0, 15.0, 5.0, 10.0), (2.0, 2.0, 5.0, 6.0, 5.0), (11.0, 0.0, 11.0, 10.0, 0.0), (-1.0, -1.0, -5.0, 3.0, 0.0), (0.0, 0.0, 0.0, 10.0, 10.0)]
    df = spark.createDataFrame(rows, "ae double, an double, be double, bn double, want double")
    got = geometry.clipped_length(*[F.col(c) for c in ("ae", "an", "be", "bn")], 0.0, 0.0, 10.0, 10.0)
    assert all(abs(r.got - r.want) < 1e-9 for r in df.withColumn("got", got).collect())


TAGS = [
    ('"a"=>"1","height"=>"8.5 m"', "8.5 m"), ('"xheight"=>"9"', None), ('"height"=>""', None), (None, None), ('"height"=>"a=>b"', "a=>b"),
]


def test_tags(spark):
    df = spark.createDataFrame([(t,) for t, _ in TAGS], "t string")
    assert [r.v for r in df.select(scalar.tag("t", "height").alias("v")).collect()] == [w for _, w in TAGS]
    got = spark.createDataFrame([('"a"=>"1","b"=>"2","a"=>"3"',)], "t string").select(scalar.tag_map("t").alias("m")).first().m
    assert got == {"a": "1", "b": "2"}


@pytest.mark.parametrize(
    ("text", "levels", "height"),
    [("2", 2, 2.0), ("2.9", 2, 2.9), ("0", 0, 0.0), ("-1", -1, -1.0), ("inf", None, None), ("nan", None, None), ("2;3", None, None), ("8.5m", None, None),
     ("8.5 m", None, 8.5), ("8.5f", None, None), ("", None, None), (None, None, None), ("1e2", 100, 100.0), ("1_0", None, None), ("-2.9", -2, -2.9)],
)
def test_numbers(spark, text, levels, height):
    row = spark.createDataFrame([(text,)], "t string").select(scalar.levels("t").alias("l"), scalar.height_tag("t").alias("h")).first()
    assert (row.l, row.h) == (levels, height)


def test_python_rounding(spark):
    values = [2.675, 1.005, 0.125, -0.5, None, 1e9 + 0.005]
    df = spark.createDataFrame([(x,) for x in values], "x double")
    got = [r.y for r in df.select(scalar.python_round(spark)("x").alias("y")).collect()]
    assert got == [None if x is None else round(x, 2) for x in values]


def test_runs_cover_their_tiles(spark):
    rng = random.Random(5)
    ways = [[rng.choice([None, (0, 0), (0, 0), (1, 0)]) for _ in range(rng.randrange(1, 12))] for _ in range(60)]
    rows = [(str(i), q, float(q), 0.0, t, 1.0 if rng.random() < 0.7 else None) for i, w in enumerate(ways) for q, t in enumerate(w)]
    df = spark.createDataFrame(rows, "id string, q int, e double, n double, tile struct<tile_x:int,tile_y:int>, z double")
    got = {str(i): [] for i in range(len(ways))}
    for r in roads.split_by_tile(roads.fill_gaps(df)).orderBy("id", "rid").collect():
        got[r.id].append((tuple(r.tile), [v.q for v in r.vertices]))
    for i, way in enumerate(ways):
        # places where a way goes on from one tile into another, or into and out of the grid
        seams = {q for q in range(1, len(way)) if way[q] and way[q - 1] and way[q] != way[q - 1]}
        starts = [q for q in range(len(way)) if way[q] and (q == 0 or way[q] != way[q - 1])]
        stops = [next((k for k in range(q, len(way)) if way[k] != way[q]), len(way)) for q in starts]
        want = []
        for a, b in zip(starts, stops, strict=True):
            # a run holds its tile's places, its first twice where it began at a seam, and
            # the place at which the next tile begins
            run = [a] * (a in seams) + list(range(a, b)) + [b] * (b in seams)
            want += [(way[a], run)] if len(run) >= 2 else []
        assert got[str(i)] == want


def test_gap_fill(spark):
    z, inside = [None, 2.0, None, None, 5.0, None], [1, 1, 1, 0, 1, 1]
    df = spark.createDataFrame([("a", q, v, (0, 0) if i else None) for q, (v, i) in enumerate(zip(z, inside, strict=True))], "id string, q int, z double, tile struct<x:int,y:int>")
    assert [r.zf for r in roads.fill_gaps(df).orderBy("q").collect()] == [2.0, 2.0, 2.0, None, 5.0, 5.0]


def test_ways_and_junctions(spark):
    rows = [
        ("a", "residential", '"lanes"=>"2"', [(0, 0), (50, 0)]), ("b", "residential", None, [(50.02, 0), (90, 0)]), ("c", "footway", '"bridge"=>"no"', [(50, 0.04), (50, 9)]),
        ("d", "construction", None, [(0, 0), (1, 1)]), ("e", "bus_guideway", None, [(0, 0), (1, 1)]), ("f", None, None, [(0, 0), (1, 1)]), ("g", "steps", None, [(7, 7)]),
    ]
    df = spark.createDataFrame([(i, h, "x", t, [(float(e), float(n)) for e, n in p]) for i, h, t, p in rows], f"osm_id string, highway string, name string, other_tags string, pts {PTS}")
    tuning = Tuning()
    ways = roads.select_ways(df, tuning.width_rows(spark), tuning)
    assert {r.id: (r.w, r.bridge) for r in ways.collect()} == {"a": (7.0, False), "b": (6.0, False), "c": (2.0, True)}
    (disc,) = roads.junctions(ways, tuning).collect()
    assert (disc.e, disc.n, disc.r) == (50.0, 0.0, 3.9)


def test_ladder_rungs(spark):
    rows = [  # id, type, tags, levels, name, p25, p50, p90, npx, d15, dmin
        ("b1", "house", "", "2", "A", 5.0, 6.8, 9.5, 60, 9.4, 9.2), ("b2", "apartments", "", "10", "Test Tower", 20.0, 21.0, 23.0, 300, 26.0, 25.5),
        ("b3", "retail", "", "3", None, 3.0, 3.2, 4.0, 100, 12.0, 11.8), ("b4", "shed", "", None, None, 2.0, 2.4, 2.6, 3, 6.5, 6.4),
        ("b5", "house", '"height"=>"8.5 m"', None, None, 1.0, 2.0, 3.0, 20, 11.0, 10.9), ("b6", "terrace", "", "3", None, None, None, None, None, None, None),
        ("b7", "garage", "", None, None, None, None, None, None, None, None), ("b8", "yes", '"roof:shape"=>"hipped"', None, None, 4.0, 5.0, 7.0, 40, 13.0, 12.9),
        ("b14", "house", "", "2", None, None, None, None, 0, 11.0, 10.9), *[(f"c{k}", "house", "", str(k), None, 4.0, 3.0 + 2 * k, 12.0, 50, 11.0, 10.9) for k in range(1, 5)],
    ]
    feet = spark.createDataFrame([(i, *r[:5]) for i, r in enumerate(rows)], "idx int, osm_id string, building string, other_tags string, levels_tag string, name string")
    stats = spark.createDataFrame([(i, *r[5:]) for i, r in enumerate(rows) if r[8] is not None], "idx int, p25 double, p50 double, p90 double, npx int, d15 double, dmin double")
    tuning, site = Tuning(), Site("t", "EPSG:1", (0, 0), landmarks=(("Test Tower", 57.0, "flat"), ("Nowhere", 9.0, None)))
    rows = massing.evidence(feet, stats)
    fit = massing.calibrate(rows, tuning, Calibration(mode="auto", min_buildings=3, fallback=(9.9, 9.9)))
    line = fit.first()
    assert line.source == "fitted" and (line.n, line.rejected) == (6, 1)
    assert 1.6 < line.m_per_level < 2.0 and 2.5 < line.intercept < 4.5
    out = massing.records(massing.ladder(rows, fit, tuning.prior_rows(spark), site.landmark_rows(spark), tuning, 4.0), tuning)
    got = {r.id: r for r in out.collect()}
    assert {k: got[k].src for k in ("b1", "b2", "b3", "b4", "b5", "b6", "b7", "b14")} == {
        "b1": "lidar_p50", "b2": "landmark_override", "b3": "lidar_p50_disputed", "b4": "lidar_lowconf",
        "b5": "osm_height", "b6": "osm_levels", "b7": "type_prior", "b14": "osm_levels",
    }
    assert (got["b1"].h, got["b1"].ridge, got["b1"].eaves, got["b1"].roof) == (6.8, 9.5, 5.0, "gabled") and abs(got["b1"].skirt - 8.7) < 1e-9
    assert (got["b2"].h, got["b2"].ridge, got["b2"].roof) == (57.0, 57.0, "flat")
    assert got["b5"].h == 8.5 and got["b7"].h == 2.43 and got["b8"].roof == "hipped" and got["b4"].roof == "flat"
    assert got["b6"].base_z is None and got["b6"].lidar_px == 0
    assert (got["b14"].base_z, got["b14"].eaves) == (11.0, None)
    assert {r.osm_id for r in massing.outliers(rows, tuning).collect()} == {"b4", "b6", "b7", "b14"}


def test_calibration_modes(spark):
    empty = massing.evidence(
        spark.createDataFrame([], "idx int, osm_id string, building string, other_tags string, levels_tag string, name string"),
        spark.createDataFrame([], "idx int, p25 double, p50 double, p90 double, npx int, d15 double, dmin double"),
    )
    get = lambda c: massing.calibrate(empty, Tuning(), c).first()
    assert (get(Calibration()).source, get(Calibration()).intercept) == ("fallback", 2.5)
    assert (get(Calibration(intercept=1.0, m_per_level=2.0)).source, get(Calibration(mode="auto", intercept=1.0, m_per_level=2.0)).m_per_level) == ("config", 2.0)


def test_furniture(spark):
    segs = spark.createDataFrame([("r", 0, 0.0, 200.0, 10.0), ("r", 1, 20.0, 200.0, 12.0), ("r", 2, 20.0, 200.0, 12.0), ("r", 3, 40.0, 200.0, 14.0)], "line string, q int, e double, n double, z double")
    pieces = furniture.segments(segs)
    assert pieces.count() == 2
    nodes = spark.createDataFrame([("n1", 10.0, 201.0), ("n2", 10.0, 205.0), ("n3", 10.0, 240.0), ("n4", 10.0, 200.0), ("n5", 20.0, 225.0)], "id string, e double, n double")
    with pytest.raises(ValueError, match="bucket"):
        furniture.nearest(nodes, pieces, (0.0, 0.0), 512.0, 25.0, 100.0, bucket=64.0)
    found = furniture.nearest(nodes, pieces, (0.0, 0.0), 512.0, 25.0, 20.0)
    ways = spark.createDataFrame([("r", 7.0, 1.5, "residential")], "line string, w double, pav double, cls string")
    got = {r.id: r for r in furniture.place(found, ways, Tuning()).collect()}
    assert got["n1"].nudged and got["n1"].n == 204.25 and abs(got["n1"].z - 11.12) < 1e-9 and got["n1"].src == "kerb"
    assert not got["n2"].nudged and got["n2"].src == "kerb" and got["n2"].bearing == 90.0
    assert (got["n3"].src, got["n3"].z, got["n3"].cls) == ("terrain", None, None) and got["n3"].bearing == int(__import__("hashlib").md5(b"n3").hexdigest()[:8], 16) % 360
    assert got["n4"].n == 195.75  # on the line counts as right of it
    assert got["n5"].d == 25.0 and got["n5"].src == "terrain"


def test_nearest_among_many(spark):
    rng = random.Random(5)
    spot = lambda far: (rng.uniform(-far, 96 + far), rng.uniform(-far, 96 + far))
    lines = []
    for k in range(6000):  # two thirds of them in one bucket
        e, n = spot(0) if k % 3 == 0 else (rng.uniform(33, 63), rng.uniform(33, 63))
        lines.append((str(k), 0, e, n, 0.0, e + rng.uniform(-5, 5), n + rng.uniform(-5, 5), 1.0))
    points = [(str(k), *spot(40)) for k in range(300)] + [(str(k), rng.uniform(33, 63), rng.uniform(33, 63)) for k in range(300, 600)]
    points += [("600", lines[1][2], lines[1][3]), ("601", 64.0, 64.0), ("602", 3000.0, 3000.0)]
    pieces = spark.createDataFrame(lines, "line string, q int, ae double, an double, az double, be double, bn double, bz double")
    found = furniture.nearest(spark.createDataFrame(points, "id string, e double, n double"), pieces, (0.0, 0.0), 512.0, 25.0, 8.0)

    def away(e, n, p):
        de, dn = p[5] - p[2], p[6] - p[3]
        t = min(max(((e - p[2]) * de + (n - p[3]) * dn) / (de * de + dn * dn), 0.0), 1.0)
        oe, on = e - (p[2] + de * t), n - (p[3] + dn * t)
        return math.sqrt(oe * oe + on * on)

    got = {r.id: r.road for r in found.collect()}
    assert len(got) == len(points) and got["602"] is None
    for k, e, n in points:
        d, line = min((away(e, n, p), p[0]) for p in lines)
        assert (got[k] and (got[k].d, got[k].line)) == ((d, line) if d <= 25 else None), k
    # a row for each pair of a bucket would grow with the square of its density
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join [bi" not in plan


def test_local_axes(spark):
    df = spark.createDataFrame([("w4", "primary", True, False, False, [[720.0, 380.0, 10.0]])], "id string, cls string, bridge boolean, tunnel boolean, z_gap boolean, pts array<array<double>>")
    assert local_axes.roads(df, (0.0, 0.0)).first().pts == [[720.0, 13.22, 380.0]]


def test_sites(tmp_path, monkeypatch):
    monkeypatch.delenv("SITE", raising=False)
    with pytest.raises(AmbiguousSiteError):
        load_site(str(tmp_path))
    (tmp_path / "a.json").write_text('{"_note": "x", "crs": "EPSG:27700", "origin": [1, 2], "landmarks": {"_n": 1, "T": {"h": 3}}, "calibration": {"mode": "fixed", "intercept": 1, "m_per_level": 2}}')
    site = load_site(str(tmp_path))
    assert (site.epsg, site.landmarks, site.calibration.effective_mode) == (27700, (("T", 3, None),), "fixed")
    (tmp_path / "b.json").write_text('{"crs": "nonsense", "origin": [1, 2]}')
    with pytest.raises(AmbiguousSiteError):
        load_site(str(tmp_path))
    with pytest.raises(ValueError, match="EPSG"):
        load_site(str(tmp_path), "b").epsg  # noqa: B018
