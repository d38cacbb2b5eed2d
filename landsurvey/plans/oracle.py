"""DuckDB SQL twins of the queries, over the same views."""

from __future__ import annotations

from .views import CLASSES, KINDS
from ..config import FLAT_TYPES, ROAD_WIDTHS, TYPE_PRIORS
from ..operators.local_axes import BRIDGE_OFFSET, CLASS_LIFT, DEFAULT_LIFT, TUNNEL_OFFSET


def q6(x: str) -> str:
    return f"floor(({x}) * 1000000 + 0.5)::BIGINT"


def pick(values: tuple, key: str) -> str:
    return f"([{', '.join(repr(x) for x in values)}])[({key} % {len(values)}) + 1]"


def table(rows, *names: str) -> str:
    literal = lambda x: repr(x) if isinstance(x, str) else f"{x}::DOUBLE"
    return f"(SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(literal, r)) + ')' for r in rows)}) v({', '.join(names)}))"


E, N = "500000.0::DOUBLE", "150000.0::DOUBLE"
PLAIN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def tag(key: str, text: str = "other_tags") -> str:
    return f"""nullif(regexp_extract({text}, '"{key}"=>"([^"]*)"', 1), '')"""


def number(x: str) -> str:
    return f"CASE WHEN regexp_matches({x}, '{PLAIN}') THEN try_cast(trim({x}) AS DOUBLE) END"


def levels(x: str) -> str:
    return f"trunc({number(x)})::INT"


def height_tag(x: str) -> str:
    return number(f"regexp_extract(trim({x}), '^\\S*')")


CELLS = f"""cells AS (
  SELECT (o_orderkey // 125)::INT AS row, (o_orderkey % 125)::INT AS col, {E} + 16 * (o_orderkey % 125) AS e, {N} + 16 * (h - 1 - o_orderkey // 125) AS n,
         CASE WHEN o_orderstatus <> 'P' THEN o_totalprice / 10000 - 3 END AS z,
         CASE WHEN o_custkey % 7 <> 0 AND o_orderstatus <> 'P' THEN o_totalprice / 10000 - 3 + (o_custkey % 17) / 2 END AS dsm,
         ((o_orderkey % 125) // 32)::INT AS tile_x, ((h - 1 - o_orderkey // 125) // 32)::INT AS tile_y,
         (31 - (h - 1 - o_orderkey // 125) % 32)::INT AS r, ((o_orderkey % 125) % 32)::INT AS c, h
  FROM orders, (SELECT max(o_orderkey) // 125 + 1 AS h FROM orders))"""
STOREYS = "nullif(p_size % 8, 0)::VARCHAR"
FOOT = f"""foot AS (
  SELECT p_partkey AS idx, CASE WHEN p_partkey % 2 = 0 THEN 'w' || p_partkey ELSE '' END AS osm_way_id, 'r' || p_partkey AS rel_id,
         CASE WHEN p_partkey % 2 = 0 THEN 'w' || p_partkey ELSE 'r' || p_partkey END AS osm_id,
         CASE WHEN p_partkey % 9 <> 0 THEN {pick(KINDS, 'p_partkey')} END AS building,
         CASE WHEN p_partkey % 97 = 3 THEN 'Tower' WHEN p_partkey % 101 = 5 THEN 'Mill' ELSE p_name END AS name,
         CASE WHEN p_partkey % 3 <> 0 THEN {STOREYS} END AS levels_tag,
         (CASE WHEN p_partkey % 3 = 0 AND p_size % 8 <> 0 THEN '"building:levels"=>"' || {STOREYS} || '",' ELSE '' END) ||
         (CASE WHEN p_partkey % 50 = 0 THEN '"height"=>"8.5 m",' WHEN p_partkey % 53 = 0 THEN '"height"=>"8.5m",' ELSE '' END) ||
         (CASE WHEN p_partkey % 11 = 0 THEN '"roof:shape"=>"hipped",' ELSE '' END) || '"source"=>"survey"' AS other_tags,
         {E} + (p_partkey * 37) % 2000 AS x0, {N} + (p_partkey * 53) % 1500 AS y0,
         {E} + (p_partkey * 37) % 2000 + 6 + p_size % 10 AS x1, {N} + (p_partkey * 53) % 1500 + 5 + p_size % 7 AS y1
  FROM part)"""
RINGS = """ring AS (
  SELECT osm_id, false AS hole, u.q::INT AS q, u.e, u.n FROM foot,
  LATERAL (VALUES (0, x0, y0), (1, x1, y0), (2, x1, y1), (3, x0, y1), (4, x0, y0)) u(q, e, n))"""
POINTS = f"""pt AS (
  SELECT user_id, event_id, ts, event_type, {E} - 100 + (user_id * 97) % 1200 + value / 2 AS e, {N} - 100 + (user_id * 53) % 700 + (event_id * 61) % 240 AS n
  FROM events)"""
LINES = f"""{POINTS}, ln AS (
  SELECT DISTINCT user_id, user_id::VARCHAR AS osm_id, CASE WHEN user_id % 13 <> 0 THEN {pick(CLASSES, 'user_id')} END AS highway,
         (CASE WHEN user_id % 7 = 0 THEN '"lanes"=>"2",' WHEN user_id % 11 = 0 THEN '"lanes"=>"4;5",' ELSE '' END) ||
         (CASE WHEN user_id % 4 = 0 THEN '"bridge"=>"yes",' ELSE '' END) || (CASE WHEN user_id % 6 = 0 THEN '"natural"=>"coastline",' ELSE '' END) ||
         (CASE WHEN user_id % 10 = 0 THEN '"tunnel"=>"no"' ELSE '"tunnel"=>""' END) AS other_tags
  FROM events),
lp AS (SELECT user_id::VARCHAR AS id, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1)::INT AS q, e, n FROM pt)"""
WAYS = f"""{LINES}, way AS (
  SELECT osm_id AS id, highway AS cls, s.pav, round_even(greatest(spec_w, coalesce(({number(tag('lanes'))}) * 3 + 1, spec_w)) / 0.5::DOUBLE, 0) * 0.5::DOUBLE AS w,
         {tag('bridge')} IS NOT NULL AS bridge, {tag('tunnel')} IS NOT NULL AS tunnel
  FROM ln JOIN {table([(k, *x) for k, x in ROAD_WIDTHS.items()], 'cls', 'spec_w', 'pav')} s ON s.cls = highway
  WHERE (SELECT count(*) FROM lp WHERE lp.id = osm_id) >= 2),
wp AS (SELECT lp.* FROM lp JOIN way USING (id))"""
STEP = "sqrt((be - ae) * (be - ae) + (bn - an) * (bn - an))"
DENSE = f"""{WAYS}, sg AS (
  SELECT id, q, e AS be, n AS bn, lag(e) OVER w AS ae, lag(n) OVER w AS an FROM wp WINDOW w AS (PARTITION BY id ORDER BY q)),
sd AS (SELECT *, {STEP} AS d FROM sg),
cut AS (SELECT *, unnest(range(1, floor(d / 8)::BIGINT + 1)) AS k FROM sd WHERE d > 8),
dn AS (
  SELECT id, (row_number() OVER (PARTITION BY id ORDER BY q, k) - 1)::INT AS q, e, n FROM (
    SELECT id, q, 1000000000 AS k, be AS e, bn AS n FROM sd
    UNION ALL SELECT id, q, k, ae + (be - ae) * (k * 8.0::DOUBLE / d), an + (bn - an) * (k * 8.0::DOUBLE / d) FROM cut WHERE k * 8.0::DOUBLE / d < 1))"""
TILE_OF = f"""CASE WHEN floor((e - {E}) / 512) BETWEEN 0 AND 2 AND floor((n - {N}) / 512) BETWEEN 0 AND 1
  THEN {{{{'x': floor((e - {E}) / 512)::INT, 'y': floor((n - {N}) / 512)::INT}}}} END""".replace("{{", "{").replace("}}", "}")
DRAPED = f"""{CELLS}, {DENSE}, hh AS MATERIALIZED (SELECT max(o_orderkey) // 125 + 1 AS h FROM orders),
vt AS (SELECT dn.*, {TILE_OF} AS tile, (e - {E}) / 16 AS fx, h - 1 - (n - {N}) / 16 AS fy, h FROM dn, hh),
va AS (
  SELECT *, least(floor(fx), 123)::INT AS x0, least(floor(fy), h - 2)::INT AS y0, fx - least(floor(fx), 123) AS tx, fy - least(floor(fy), h - 2) AS ty
  FROM vt WHERE tile IS NOT NULL AND fx BETWEEN 0 AND 124 AND fy BETWEEN 0 AND h - 1),
vq AS (SELECT id, q, tx, ty, k, x0 + k % 2 AS col, y0 + k // 2 AS row FROM va, (SELECT unnest([0, 1, 2, 3]) AS k)),
vk AS (
  SELECT id, q, tx, ty, max(z) FILTER (k = 0) AS a, max(z) FILTER (k = 1) AS b, max(z) FILTER (k = 2) AS c, max(z) FILTER (k = 3) AS d
  FROM vq JOIN cells USING (row, col) GROUP BY ALL HAVING count(z) = 4),
vz AS (SELECT id, q, (a * (1 - tx) + b * tx) * (1 - ty) + (c * (1 - tx) + d * tx) * ty AS z FROM vk),
dr AS (SELECT vt.id, vt.q, vt.e, vt.n, vt.tile, vz.z FROM vt LEFT JOIN vz USING (id, q)),
gf AS (
  SELECT *, CASE WHEN tile IS NOT NULL THEN coalesce(z, last_value(z IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         first_value(z IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) END AS zf FROM dr WINDOW w AS (PARTITION BY id ORDER BY q))"""


def gradient(z: str, part: str, along: str) -> str:
    w = f"OVER (PARTITION BY {part} ORDER BY {along})"
    a, b = f"lag({z}) {w}", f"lead({z}) {w}"
    return f"CASE WHEN {a} IS NULL AND {b} IS NULL THEN 0 WHEN {a} IS NULL THEN {b} - {z} WHEN {b} IS NULL THEN {z} - {a} ELSE ({b} - {a}) / 2 END"


def slope(z: str, part: str = "") -> str:
    gx, gy = gradient(z, part + "row", "col"), gradient(z, part + "col", "row")
    return f"degrees(atan(sqrt((({gx}) / 16) * (({gx}) / 16) + (({gy}) / 16) * (({gy}) / 16))))"


RAMP = "least(greatest((slope - 22) / 18, 0), 1)"
CALM = "least(" + ", ".join(f"abs(z - {f}(z) OVER (PARTITION BY {p} ORDER BY {o}))" for p, o in (("row", "col"), ("col", "row")) for f in ("lag", "lead")) + ")"
CLASSED = f"""{CELLS}, sl AS (SELECT *, {slope('zz')} AS slope, {CALM} AS dz FROM (SELECT *, coalesce(z, 0) AS zz FROM cells)),
cl0 AS (SELECT *, {RAMP} AS rock, coalesce((z < -0.1::DOUBLE) OR (abs(z) < 0.3::DOUBLE AND dz < 0.08::DOUBLE * 16), false) AS water FROM sl),
cl AS (SELECT *, (coalesce(z < 2, false) OR (row + col) % 11 = 0) AND NOT water AS sand FROM cl0)"""
BANDS = f"""{CLASSED}, bl AS (
  SELECT tile_x, tile_y, (r // 2)::BIGINT AS br, (c // 2)::BIGINT AS bc, avg(sand::INT) AS s, avg(water::INT) AS w, avg(rock) AS k0
  FROM cl GROUP BY ALL),
bk AS (SELECT *, least(greatest(k0 * (1 - s - w), 0), 1) AS k FROM bl),
bg AS (SELECT *, least(greatest(1 - s - k - w, 0), 1) AS g FROM bk),
bands AS (SELECT tile_x, tile_y, br, bc, floor(g * 255)::INT AS grass, floor(s * 255)::INT AS sand, floor(k * 255)::INT AS rock, floor(w * 255)::INT AS water FROM bg)"""
ZONAL = """px AS (SELECT l_partkey AS idx, CASE WHEN l_partkey % 17 <> 0 AND l_returnflag <> 'N' THEN l_quantity / 4 END AS ndsm, CASE WHEN l_partkey % 17 <> 0 THEN l_tax * 100 + l_discount * 10 END AS dtm FROM lineitem),
zn AS (
  SELECT idx, quantile_cont(ndsm, 0.25) AS p25, quantile_cont(ndsm, 0.5) AS p50, quantile_cont(ndsm, 0.9) AS p90, count(ndsm)::INT AS npx,
         quantile_cont(dtm, 0.15) AS d15, min(dtm) AS dmin FROM px GROUP BY idx HAVING count(dtm) > 0)"""
EVIDENCE = f"""{FOOT}, {ZONAL}, ev AS (
  SELECT foot.*, p25, p50, p90, coalesce(npx, 0) AS npx, d15, dmin, {levels(f"coalesce(levels_tag, {tag('building:levels')})")} AS levels, {tag('height')} AS height_tag,
         CASE WHEN dmin IS NULL THEN 'no_lidar' WHEN coalesce(npx, 0) = 0 THEN 'no_dsm' ELSE 'none' END AS gap
  FROM foot LEFT JOIN zn USING (idx) WHERE building IS NOT NULL AND building <> 'no')"""
FIT = f"""{EVIDENCE}, pr AS (SELECT levels::DOUBLE AS l, p50 AS h FROM ev WHERE levels BETWEEN 1 AND 30 AND npx >= 6 AND height_tag IS NULL AND p50 IS NOT NULL),
f1 AS (SELECT regr_slope(h, l) AS b, regr_intercept(h, l) AS a, count(*) AS n FROM pr),
sp AS (SELECT stddev_pop(h - (a + b * l)) AS sd FROM pr, f1),
kp AS (SELECT l, h FROM pr, f1, sp WHERE abs(h - (a + b * l)) <= greatest(2 * sd, 2)),
f2 AS (SELECT regr_slope(h, l) AS b2, regr_intercept(h, l) AS a2, count(*) AS n2 FROM kp),
li AS (SELECT CASE WHEN n2 >= 3 THEN a2 ELSE a END AS a, CASE WHEN n2 >= 3 THEN b2 ELSE b END AS b, n, n2 FROM f1, f2),
fit AS (
  SELECT CASE WHEN n >= 3 THEN floor(a * 1000 + 0.5) / 1000 ELSE 2.5 END AS intercept, CASE WHEN n >= 3 THEN floor(b * 1000 + 0.5) / 1000 ELSE 3.0 END AS m_per_level,
         CASE WHEN n >= 3 THEN 'fitted' ELSE 'fallback' END AS source, n2 AS n, n - n2 AS rejected, (SELECT sqrt(avg((h - (a + b * l)) ** 2)) FROM kp) AS rmse FROM li)"""
ROOF = f"coalesce({tag('roof:shape')}, CASE WHEN building IN {FLAT_TYPES!r} THEN 'flat' ELSE 'gabled' END)"
LADDER = f"""{FIT}, l0 AS (
  SELECT ev.*, coalesce(nullif(building, ''), 'yes') AS type, CASE WHEN levels <> 0 THEN intercept + m_per_level * levels END AS storeys, {height_tag('height_tag')} AS tagged, prior_h, {ROOF} AS roof0
  FROM ev CROSS JOIN fit LEFT JOIN {table(TYPE_PRIORS.items(), 'kind', 'prior_h')} p ON p.kind = building),
l1 AS (
  SELECT *, CASE WHEN tagged IS NOT NULL THEN tagged WHEN npx >= 1 AND p50 IS NOT NULL THEN p50 WHEN storeys IS NOT NULL THEN storeys ELSE coalesce(prior_h, 6.6::DOUBLE) END AS h0,
         CASE WHEN tagged IS NOT NULL THEN 'osm_height' WHEN npx >= 6 AND p50 IS NOT NULL THEN CASE WHEN coalesce(abs(p50 - storeys) > 4, false) THEN 'lidar_p50_disputed' ELSE 'lidar_p50' END
              WHEN npx >= 1 AND p50 IS NOT NULL THEN 'lidar_lowconf' WHEN storeys IS NOT NULL THEN 'osm_levels' ELSE 'type_prior' END AS src0 FROM l0),
lad AS (
  SELECT *, CASE WHEN name = 'Tower' THEN 57 ELSE h0 END AS h, CASE WHEN name IN ('Tower', 'Mill') THEN 'landmark_override' ELSE src0 END AS src,
         CASE name WHEN 'Tower' THEN 'flat' WHEN 'Mill' THEN 'hipped' ELSE roof0 END AS roof FROM l1)"""
SEED = "('0x' || substr(md5(osm_id), 1, 8))::BIGINT"
NODES = f"""{POINTS}, nd AS (SELECT event_id::VARCHAR AS id, 'waste_basket' AS amenity, e + event_id % 7 AS e, n + event_id % 7 AS n FROM pt WHERE event_type = 'view')"""
FOUND = f"""{DENSE}, nd AS (SELECT event_id::VARCHAR AS id, e + event_id % 7 AS e, n + event_id % 7 AS n FROM pt WHERE event_type = 'view'),
pc AS (
  SELECT * FROM (SELECT id AS line, q, e AS ae, n AS an, lead(e) OVER w AS be, lead(n) OVER w AS bn FROM dn WINDOW w AS (PARTITION BY id ORDER BY q))
  WHERE be IS NOT NULL AND (ae <> be OR an <> bn)),
pf AS (
  SELECT *, (ae - {E}) * 0.02::DOUBLE + 5 AS az, (be - {E}) * 0.02::DOUBLE + 5 AS bz, floor(((ae + be) / 2 - {E}) / 64)::BIGINT AS bi, floor(((an + bn) / 2 - {N}) / 64)::BIGINT AS bj,
         floor(((ae + be) / 2 - {E}) / 512)::BIGINT AS ti, floor(((an + bn) / 2 - {N}) / 512)::BIGINT AS tj FROM pc),
aq AS (
  SELECT nd.*, floor((e - {E}) / 64)::BIGINT + i AS bi, floor((n - {N}) / 64)::BIGINT + j AS bj
  FROM nd, (SELECT unnest([-1, 0, 1]) AS i), (SELECT unnest([-1, 0, 1]) AS j)),
mt AS (
  SELECT aq.id, aq.e, aq.n, pf.*, least(greatest(((e - ae) * (be - ae) + (n - an) * (bn - an)) / ((be - ae) * (be - ae) + (bn - an) * (bn - an)), 0), 1) AS t
  FROM aq JOIN pf USING (bi, bj)),
mu AS (SELECT *, ae + (be - ae) * t AS pe, an + (bn - an) * t AS pn FROM mt),
mv AS (
  SELECT *, sqrt((e - pe) * (e - pe) + (n - pn) * (n - pn)) AS d,
         CASE WHEN (e - pe) * -(bn - an) + (n - pn) * (be - ae) > 0 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS side FROM mu),
bs AS (
  SELECT * FROM mv WHERE d <= 25
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY d, ti - floor((e - {E}) / 512), tj - floor((n - {N}) / 512), line, q) = 1),
fd AS (SELECT nd.id, nd.e, nd.n, line, q, d, side, be - ae AS de, bn - an AS dn_, pe, pn, az + (bz - az) * t AS zl FROM nd LEFT JOIN bs USING (id))"""
PLACED = f"""{FOUND}, p0 AS (
  SELECT fd.*, w, pav, cls, w / 2 AS half, d IS NOT NULL AND d < w / 2 AS nudged, w / 2 + CASE WHEN pav > 0 THEN pav / 2 ELSE 0.6::DOUBLE END AS target FROM fd LEFT JOIN way ON way.id = line),
p1 AS (SELECT *, CASE WHEN nudged THEN target ELSE d END AS d2, side * target / sqrt(de * de + dn_ * dn_) AS step FROM p0),
pl AS (
  SELECT id, cls, nudged, d2 AS d, CASE WHEN nudged THEN pe - dn_ * step ELSE e END AS e, CASE WHEN nudged THEN pn + de * step ELSE n END AS n,
         CASE WHEN d2 <= half + pav + 1 THEN zl + CASE WHEN pav > 0 THEN 0.12::DOUBLE ELSE 0 END END AS z,
         CASE WHEN d IS NOT NULL THEN CASE WHEN degrees(atan2(de, dn_)) < 0 THEN degrees(atan2(de, dn_)) + 360 ELSE degrees(atan2(de, dn_)) END ELSE (('0x' || substr(md5(id), 1, 8))::BIGINT % 360)::DOUBLE END AS bearing,
         CASE WHEN d2 <= half + pav + 1 THEN CASE WHEN pav > 0 THEN 'kerb' ELSE 'road' END ELSE 'terrain' END AS src FROM p1)"""


def micro_rows(source: str, keep: str, *values: str) -> str:
    return f"SELECT {', '.join([*([keep] if keep else []), *[f'{q6(x)} AS {x}' for x in values]])} FROM {source}"


CHAIKIN = WAYS
for _k in (1, 2):
    _s = "wp" if _k == 1 else "c1"
    CHAIKIN += f""", x{_k} AS (SELECT *, lead(e) OVER w AS ne, lead(n) OVER w AS nn, count(*) OVER (PARTITION BY id) AS size FROM {_s} WINDOW w AS (PARTITION BY id ORDER BY q)),
c{_k} AS (
  SELECT id, (row_number() OVER (PARTITION BY id ORDER BY o) - 1)::INT AS q, e, n FROM (
    SELECT id, q AS o, e, n FROM x{_k} WHERE size < 3 OR q = 0
    UNION ALL SELECT id, 2 * q + 1, e * 0.75::DOUBLE + ne * 0.25::DOUBLE, n * 0.75::DOUBLE + nn * 0.25::DOUBLE FROM x{_k} WHERE size >= 3 AND ne IS NOT NULL
    UNION ALL SELECT id, 2 * q + 2, e * 0.25::DOUBLE + ne * 0.75::DOUBLE, n * 0.25::DOUBLE + nn * 0.75::DOUBLE FROM x{_k} WHERE size >= 3 AND ne IS NOT NULL
    UNION ALL SELECT id, 1000000000, e, n FROM x{_k} WHERE size >= 3 AND ne IS NULL))"""
ENDS = f"""{WAYS}, en AS (
  SELECT floor(e * 10 + 0.5)::BIGINT AS ke, floor(n * 10 + 0.5)::BIGINT AS kn, w FROM (SELECT *, max(q) OVER (PARTITION BY id) AS last FROM wp) JOIN way USING (id),
  LATERAL (SELECT unnest(CASE WHEN last = 0 THEN [1, 1] WHEN q IN (0, last) THEN [1] ELSE [] END))),
dg AS (SELECT ke, kn, count(*) AS ways, max(w) AS w FROM en GROUP BY ALL)"""
LIFT = f"(coalesce(lift, {DEFAULT_LIFT}::DOUBLE) + CASE WHEN bridge THEN {BRIDGE_OFFSET}::DOUBLE ELSE 0 END + CASE WHEN tunnel THEN {TUNNEL_OFFSET}::DOUBLE ELSE 0 END)"
LEVELS_TEXT = f"({pick(('', ' ', '-', 'x', '+'), 'p_partkey')} || p_size || {pick(('', '.9', ';3', 'f', ' m', 'e1'), 'p_size')})"
CLIP_ENTER = f"greatest(0, least(({E} - ae) / nullif(be - ae, 0), ({E} + 1536 - ae) / nullif(be - ae, 0)), least(({N} - an) / nullif(bn - an, 0), ({N} + 1024 - an) / nullif(bn - an, 0)))"
CLIP_LEAVE = f"least(1, greatest(({E} - ae) / nullif(be - ae, 0), ({E} + 1536 - ae) / nullif(be - ae, 0)), greatest(({N} - an) / nullif(bn - an, 0), ({N} + 1024 - an) / nullif(bn - an, 0)))"
CLIP_MISS = f"(be = ae AND (ae < {E} OR ae > {E} + 1536)) OR (bn = an AND (an < {N} OR an > {N} + 1024))"
#: Footprints are upright rectangles, so centres and touches are comparisons.
RASTER = f"""{FOOT}, cd AS (
  SELECT idx, x0, y0, x1, y1, cx, unnest(range(ceil((y0 - 2 - {N}) / 4)::BIGINT, floor((y1 + 2 - {N}) / 4)::BIGINT + 1)) AS cy
  FROM (SELECT *, unnest(range(ceil((x0 - 2 - {E}) / 4)::BIGINT, floor((x1 + 2 - {E}) / 4)::BIGINT + 1)) AS cx FROM foot)),
ce AS (SELECT *, {E} + cx * 4 AS e, {N} + cy * 4 AS n FROM cd),
ci AS (SELECT *, e >= x0 AND e < x1 AND n >= y0 AND n < y1 AS inside, least(e - x0, x1 - e, n - y0, y1 - n) AS away FROM ce),
cf AS (SELECT * FROM (SELECT *, max(away) OVER (PARTITION BY idx) AS deep FROM ci WHERE inside) WHERE away >= 2 OR deep < 2),
r1 AS (SELECT cx, cy, max(idx) AS idx FROM cf GROUP BY ALL),
r2 AS (
  SELECT cx, cy, max(idx) AS idx FROM ci WHERE idx NOT IN (SELECT idx FROM r1) AND (cx, cy) NOT IN (SELECT (cx, cy) FROM r1) GROUP BY ALL)"""

_BODY: dict[str, tuple[str, str]] = {
    "building_filter": (FOOT, "SELECT osm_id, building FROM foot WHERE building IS NOT NULL AND building <> 'no'"),
    "highway_filter": (WAYS, "SELECT id, cls FROM way"),
    "beach_filter": ("", f"SELECT * FROM (SELECT p_partkey, {pick(('beach', 'sand', 'shingle', 'wood', 'scrub'), 'p_partkey')} AS kind FROM part) WHERE kind IN ('beach', 'sand', 'shingle')"),
    "coastline_filter": (LINES, """SELECT osm_id FROM ln WHERE other_tags LIKE '%"natural"=>"coastline"%'"""),
    "provenance_counts": (f"{FOOT}, {LINES}", "SELECT (SELECT count(*) FROM foot WHERE building IS NOT NULL AND building <> 'no') AS buildings, (SELECT count(*) FROM ln WHERE highway IS NOT NULL) AS highways"),
    "tag_lookup": (FOOT, f"SELECT osm_id, {tag('height')} AS height, {tag('roof:shape')} AS roof, {tag('source')} AS source FROM foot"),
    "osm_id_choice": (FOOT, "SELECT idx, coalesce(nullif(osm_way_id, ''), rel_id) AS osm_id FROM foot"),
    "levels_parse": ("", f"SELECT p_partkey, {levels('t')} AS levels, {q6(height_tag('t'))} AS height FROM (SELECT p_partkey, {LEVELS_TEXT} AS t FROM part)"),
    "amenity_props": (NODES, "SELECT id::BIGINT AS id, amenity, 'LitterBin' AS prop FROM nd"),
    "tile_assign": (POINTS, f"SELECT event_id, t.x AS tile_x, t.y AS tile_y FROM (SELECT event_id, {TILE_OF} AS t FROM pt)"),
    "building_tiles": (FOOT, f"SELECT osm_id, t.x AS tile_x, t.y AS tile_y FROM (SELECT osm_id, {TILE_OF} AS t FROM (SELECT osm_id, (x0 + x1) / 2 AS e, (y0 + y1) / 2 AS n FROM foot))"),
    "carriageway_width": (WAYS, micro_rows("way", "id, bridge, tunnel", "w", "pav")),
    "feature_seed": (FOOT, f"SELECT osm_id, {SEED} AS seed FROM foot"),
    "footprint_rings": (f"{FOOT}, {RINGS}", micro_rows("ring", "osm_id, hole, q", "e", "n")),
    "ndsm": (CELLS, f"SELECT row, col, {q6('dsm - z')} AS ndsm FROM cells"),
    "nodata_mask": ("", f"SELECT p_partkey, CASE WHEN p_partkey % 7 > 3 THEN {q6('p_retailprice')} END AS z FROM part"),
    "slope_site": (CELLS, f"SELECT row, col, {q6('slope')} AS slope FROM (SELECT row, col, {slope('z')} AS slope FROM (SELECT row, col, coalesce(z, 0) AS z FROM cells))"),
    "slope_tile": (CELLS, f"SELECT row, col, {q6('slope')} AS slope FROM (SELECT row, col, {slope('z', 'tile_x, tile_y, ')} AS slope FROM (SELECT row, col, tile_x, tile_y, coalesce(z, 5) AS z FROM cells))"),
    "rock_ramp": (CLASSED, micro_rows("cl", "row, col", "rock")),
    "calmest_neighbour": (CLASSED, micro_rows("cl", "row, col", "dz")),
    "water_class": (CLASSED, "SELECT row, col, water, sand FROM cl"),
    "area_accounting": (CLASSED, f"SELECT {q6('count(*) FILTER (WHERE water) * 0.0256::DOUBLE')} AS water_ha, {q6('count(*) FILTER (WHERE sand) * 0.0256::DOUBLE')} AS sand_ha FROM cl"),
    "block_downsample": (CELLS, f"SELECT tile_x, tile_y, (r // 2)::BIGINT AS br, (c // 2)::BIGINT AS bc, {q6('avg(z)')} AS z FROM cells GROUP BY ALL"),
    "class_compose": (BANDS, "SELECT * FROM bands"),
    "alphamap": (BANDS, "SELECT tile_x, tile_y, 15 - br AS br, bc, least(grass + least(greatest(255 - (grass + sand + rock), 0), 255), 255) AS grass, sand, rock, water FROM bands"),
    "water_tiles": (CELLS, "SELECT x::INT AS tile_x, y::INT AS tile_y FROM (SELECT unnest(range(max(tile_x) + 1)) AS x FROM cells), (SELECT unnest(range(max(tile_y) + 1)) AS y FROM cells) LEFT JOIN (SELECT tile_x, tile_y, min(z) AS low, avg((z IS NOT NULL)::INT) AS share FROM cells GROUP BY ALL) t ON tile_x = x AND tile_y = y WHERE share IS NULL OR share < 0.01 OR low < 0.75"),
    "missing_tiles_anti": (CELLS, "SELECT x AS tile_x, y AS tile_y FROM (SELECT unnest([0, 1, 2]) AS x), (SELECT unnest([0, 1, 2, 3, 4]) AS y) WHERE (x, y) NOT IN (SELECT (tile_x, tile_y) FROM cells GROUP BY tile_x, tile_y HAVING avg((z IS NOT NULL)::INT) >= 0.01)"),
    "fill_median": (CELLS, f"SELECT tile_x, tile_y, r, c, {q6('coalesce(z, m, 0)')} AS z, CASE WHEN have = 0 THEN 'all-nodata -> 0' WHEN have < total THEN 'median (degraded)' ELSE 'none' END AS fill FROM (SELECT *, median(z) OVER p AS m, count(z) OVER p AS have, count(*) OVER p AS total FROM cells WINDOW p AS (PARTITION BY tile_x, tile_y))"),
    "fill_nearest": (
        f"""{CELLS}, nf AS (
  SELECT b.tile_x, b.tile_y, b.r, b.c, arg_min(g.z, ((g.r - b.r) * (g.r - b.r) + (g.c - b.c) * (g.c - b.c)) * 4096 + g.r * 64 + g.c) AS near
  FROM cells b JOIN cells g USING (tile_x, tile_y) WHERE b.z IS NULL AND g.z IS NOT NULL GROUP BY ALL)""",
        f"SELECT tile_x, tile_y, r, c, {q6('coalesce(z, near, 0)')} AS z, CASE WHEN have = 0 THEN 'all-nodata -> 0' WHEN have < total THEN 'nearest' ELSE 'none' END AS fill FROM (SELECT *, count(z) OVER p AS have, count(*) OVER p AS total FROM cells WINDOW p AS (PARTITION BY tile_x, tile_y)) LEFT JOIN nf USING (tile_x, tile_y, r, c)",
    ),
    "tile_stats": (CELLS, f"SELECT tile_x, tile_y, count(*) FILTER (WHERE z IS NULL) AS nodata_cells, count(*) FILTER (WHERE slope > 45) AS over_45, {q6('min(zz)')} AS min_m, {q6('max(zz)')} AS max_m, {q6('max(slope)')} AS slope_max, {q6('quantile_cont(slope, 0.99)')} AS slope_p99 FROM (SELECT *, {slope('zz', 'tile_x, tile_y, ')} AS slope FROM (SELECT *, coalesce(z, 5) AS zz FROM cells)) GROUP BY ALL"),
    "height_encode": (CELLS, "SELECT 31 - r AS r, c, tile_x, tile_y, round_even(least(greatest((z - base) / (top - base), 0), 1) * 65535, 0)::INT AS code FROM cells, (SELECT floor(min(z) - 5) AS base, ceil(max(z) + 5) AS top FROM cells) WHERE z IS NOT NULL"),
    "mosaic_dedupe": (CELLS, f"SELECT row, col, {q6('coalesce(z, CASE WHEN c = 0 AND tile_x > 0 THEN dsm END)')} AS z FROM cells"),
    "polygon_raster": (RASTER, "SELECT cx, cy, idx FROM r1 UNION ALL SELECT cx, cy, idx FROM r2"),
    "mask_burn": (f"{CELLS}, {FOOT}", "SELECT row, col FROM cells WHERE EXISTS (SELECT 1 FROM foot WHERE e >= x0 AND e < x1 AND n >= y0 AND n < y1)"),
    "zonal_stats": (ZONAL, micro_rows("zn", "idx, npx", "p25", "p50", "p90", "d15", "dmin")),
    "gap_classes": (EVIDENCE, "SELECT osm_id, gap, levels FROM ev"),
    "height_calibration": (FIT, micro_rows("fit", "source, n, rejected", "intercept", "m_per_level", "rmse")),
    "height_ladder": (LADDER, micro_rows("lad", "osm_id, src, roof", "h")),
    "building_records": (LADDER, f"SELECT osm_id AS id, name, type, npx AS lidar_px, levels, roof, src, {SEED} AS seed, {q6('h')} AS h, {q6('greatest(p90, h)')} AS ridge, {q6('p25')} AS eaves, {q6('d15')} AS base_z, {q6('dmin - 0.5::DOUBLE')} AS skirt FROM lad"),
    "height_source_hist": (LADDER, f"SELECT src, count(*) AS buildings, src = 'type_prior' AND count(*) / sum(count(*)) OVER () > 0.05 AS warn, {q6('count(*) / sum(count(*)) OVER ()')} AS share FROM lad GROUP BY src"),
    "qa_outliers": (EVIDENCE, micro_rows("ev", "osm_id, name, npx AS px", "p50", "p90") + " WHERE npx < 6 OR p90 - p50 > 8"),
    "massing_manifest": (LADDER, "SELECT count(*) AS buildings, count(*) FILTER (WHERE gap = 'no_lidar') AS without_lidar, count(*) FILTER (WHERE gap = 'no_dsm') AS without_dsm, count(*) FILTER (WHERE src = 'landmark_override') AS landmark_overrides FROM lad"),
    "densify": (DENSE, micro_rows("dn", "id, q", "e", "n")),
    "chaikin": (CHAIKIN, micro_rows("c2", "id, q", "e", "n")),
    "polyline_length": (WAYS, f"SELECT id, {q6('sum(sqrt((e - pe) * (e - pe) + (n - pn) * (n - pn)) ORDER BY q)')} AS metres FROM (SELECT *, lag(e) OVER w AS pe, lag(n) OVER w AS pn FROM wp WINDOW w AS (PARTITION BY id ORDER BY q)) GROUP BY id"),
    "endpoint_degree": (ENDS, micro_rows("dg", "ke, kn, ways", "w")),
    "junctions": (WAYS, f"SELECT {q6('e')} AS e, {q6('n')} AS n, {q6('max(w) / 2 + 0.4::DOUBLE')} AS r FROM (SELECT floor(e / 200) * 200 AS e, floor(n / 200) * 200 AS n, w FROM (SELECT *, max(q) OVER (PARTITION BY id) AS last FROM wp) JOIN way USING (id) WHERE q IN (0, last)) GROUP BY e, n HAVING count(*) >= 3"),
    "bilinear_drape": (DRAPED, micro_rows("dr", "id, q", "z")),
    "gap_fill": (DRAPED, micro_rows("gf", "id, q", "zf")),
    "tile_split": (
        f"""{DRAPED}, s0 AS (SELECT *, lag(tile) OVER (PARTITION BY id ORDER BY q) AS before FROM gf),
s1 AS (SELECT *, sum((tile IS NULL OR before IS NULL OR tile <> before)::INT) OVER (PARTITION BY id ORDER BY q) AS rid FROM s0),
s2 AS (SELECT id, q, e, n, coalesce(zf, 0) AS z, z IS NULL AS filled, tile, rid, before IS NOT NULL AND tile <> before AS seam FROM s1 WHERE tile IS NOT NULL),
s3 AS (SELECT *, 1 AS part FROM s2 UNION ALL SELECT *, 0 FROM s2 WHERE seam UNION ALL SELECT * REPLACE (rid - 1 AS rid), 2 FROM s2 WHERE seam),
s4 AS (SELECT *, count(*) OVER r AS size, max(CASE WHEN part < 2 THEN tile END) OVER r AS own, bool_or(filled) OVER r AS z_gap, row_number() OVER (PARTITION BY id, rid ORDER BY q, part) - 1 AS k FROM s3 WINDOW r AS (PARTITION BY id, rid))""",
        f"SELECT id, rid::BIGINT AS rid, own.x AS tile_x, own.y AS tile_y, z_gap, k::INT AS k, {q6('e')} AS e, {q6('n')} AS n, {q6('z')} AS z FROM s4 WHERE size >= 2 AND own IS NOT NULL",
    ),
    "segment_junction_union": (ENDS, f"SELECT cls, id, {q6('w')} AS w, NULL::BIGINT AS r FROM way UNION ALL SELECT '_junction', NULL, NULL, {q6('w / 2 + 0.4::DOUBLE')} FROM dg"),
    "coastline_clip": (
        f"""{LINES}, cs AS (SELECT lp.id AS line, e AS ae, n AS an, lead(e) OVER w AS be, lead(n) OVER w AS bn FROM lp JOIN ln ON osm_id = lp.id WHERE other_tags LIKE '%"natural"=>"coastline"%' WINDOW w AS (PARTITION BY lp.id ORDER BY q)),
cc AS (SELECT *, {STEP} AS d, CASE WHEN {CLIP_MISS} THEN 0 ELSE greatest({CLIP_LEAVE} - {CLIP_ENTER}, 0) * {STEP} END AS c FROM cs WHERE be IS NOT NULL AND (ae <> be OR an <> bn))""",
        f"SELECT line, {q6('sum(d)')} AS raw_m, {q6('sum(c)')} AS clipped_m FROM cc GROUP BY line",
    ),
    "nearest_road": (FOUND, f"SELECT id, line, q, {q6('d')} AS d FROM fd"),
    "furniture_place": (PLACED, micro_rows("pl", "id, src, cls, nudged", "e", "n", "z", "bearing", "d")),
    "local_furniture": (PLACED, f"SELECT id, {q6(f'e - {E}')} AS x, {q6('z')} AS y, {q6(f'n - {N}')} AS z, {q6('bearing')} AS yaw FROM pl"),
    "local_yup_roads": (WAYS, f"SELECT id, q, {q6(f'e - {E}')} AS x, {q6(f'(e - {E}) * 0.02::DOUBLE + {LIFT}')} AS y, {q6(f'n - {N}')} AS z FROM wp JOIN way USING (id) LEFT JOIN {table(CLASS_LIFT.items(), 'lcls', 'lift')} ON lcls = cls"),
    "local_rings": (f"{FOOT}, {RINGS}", f"SELECT osm_id, hole, q, {q6(f'e - {E}')} AS x, {q6(f'n - {N}')} AS z FROM ring"),
    "fetch_jobs": ("", "SELECT kind, x::INT AS tile_x, y::INT AS tile_y FROM (SELECT unnest(['dtm', 'dsm']) AS kind), (SELECT unnest([0, 1, 2]) AS x), (SELECT unnest([0, 1]) AS y)"),
    "status_hist": ("", "SELECT status, count(*) AS files, status = 'BAD' AS fatal FROM (SELECT CASE o_orderstatus WHEN 'F' THEN 'ok' WHEN 'O' THEN 'EMPTY' ELSE 'BAD' END AS status FROM orders) GROUP BY status"),
    "topk_kinds": (FOOT, "SELECT building, count(*) AS rows FROM foot WHERE building IS NOT NULL GROUP BY building ORDER BY rows DESC, building LIMIT 4"),
    "ring_outline": (
        """an AS (SELECT range::INT AS k, range * (2 * pi() / 48) AS a FROM range(48)),
xy AS (SELECT k, sign(cos(a)) * pow(abs(cos(a)), 2.0::DOUBLE / 3) * 0.25::DOUBLE AS x, sign(sin(a)) * pow(abs(sin(a)), 2.0::DOUBLE / 3) * 0.25::DOUBLE AS y FROM an),
st AS (SELECT *, coalesce(sqrt((x - lag(x) OVER (ORDER BY k)) ** 2 + (y - lag(y) OVER (ORDER BY k)) ** 2), 0) AS step FROM xy)""",
        f"SELECT k, {q6('x')} AS x, {q6('y')} AS y, {q6('sum(step) OVER (ORDER BY k) / sum(step) OVER ()')} AS u FROM st",
    ),
}
SQL = {k: (f"WITH {views}\n{body}" if views else body) for k, (views, body) in _BODY.items()}
