"""Clipped roads and anchor scans over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import anchors, network, repair, zones
from ..sources import views as v
from .registry import query, rounded

RNZ = ("v_roads", "v_nodes", "v_zone_edges")
# A straight line for each road, from where its start node is to where its end node is or
# would be; nodes whose id is divisible by 7 count as missing.
AT = "((({id}) - 1) % 40) * 25e0"
ATY = "floor((({id}) - 1) / 40) * 25e0"


def _lines(spark, d):
    x = lambda c: f"(({c} - 1) % 40) * 25e0D"
    y = lambda c: f"floor(({c} - 1) / 40) * 25e0D"
    return v.roads(spark, d).selectExpr("road_id", "snode", "enode", f"{x('snode')} AS x1", f"{y('snode')} AS y1", f"{x('enode')} AS x2", f"{y('enode')} AS y2")


LINES = f"""ln AS (SELECT road_id, snode, enode, {AT.format(id='snode')} AS x1, {ATY.format(id='snode')} AS y1, {AT.format(id='enode')} AS x2, {ATY.format(id='enode')} AS y2 FROM v_roads),
nd AS (SELECT * FROM v_nodes WHERE node_id % 7 <> 0), rr AS (SELECT ln.*, a.x AS sx, a.y AS sy, b.x AS dx, b.y AS dy FROM ln LEFT JOIN nd a ON a.node_id = snode LEFT JOIN nd b ON b.node_id = enode),
ms AS (SELECT *, sqrt((x2 - x1) ** 2 + (y2 - y1) ** 2) AS len FROM rr WHERE sx IS NULL OR dx IS NULL),
bx AS (SELECT poly_id, min(x1) AS bx1, max(x1) AS bx2, min(y1) AS by1, max(y1) AS by2 FROM v_zone_edges GROUP BY 1),
cl AS (SELECT ms.*, poly_id, greatest(0e0, CASE WHEN x2 <> x1 THEN least((bx1 - x1) / (x2 - x1), (bx2 - x1) / (x2 - x1)) ELSE 0 END, CASE WHEN y2 <> y1 THEN least((by1 - y1) / (y2 - y1), (by2 - y1) / (y2 - y1)) ELSE 0 END) AS ta,
  least(1e0, CASE WHEN x2 <> x1 THEN greatest((bx1 - x1) / (x2 - x1), (bx2 - x1) / (x2 - x1)) ELSE 1 END, CASE WHEN y2 <> y1 THEN greatest((by1 - y1) / (y2 - y1), (by2 - y1) / (y2 - y1)) ELSE 1 END) AS tb
  FROM ms, bx WHERE len > 0 AND (y1 <> y2 OR (y1 >= by1 AND y1 < by2)) AND (x1 <> x2 OR (x1 >= bx1 AND x1 < bx2))),
pc AS (SELECT road_id, sx, sy, dx, dy, ta * len AS start_s, tb * len AS end_s, x1 + ta * (x2 - x1) AS px1, y1 + ta * (y2 - y1) AS py1, x1 + tb * (x2 - x1) AS px2, y1 + tb * (y2 - y1) AS py2 FROM cl WHERE tb > ta),
sc AS (SELECT *, coalesce(CAST(least(sqrt((sx - px1) ** 2 + (sy - py1) ** 2), sqrt((sx - px2) ** 2 + (sy - py2) ** 2)) <= 2 AS INTEGER), 0) + coalesce(CAST(least(sqrt((dx - px1) ** 2 + (dy - py1) ** 2), sqrt((dx - px2) ** 2 + (dy - py2) ** 2)) <= 2 AS INTEGER), 0) AS n_hits,
  coalesce(least(sqrt((sx - px1) ** 2 + (sy - py1) ** 2), sqrt((sx - px2) ** 2 + (sy - py2) ** 2)), least(sqrt((dx - px1) ** 2 + (dy - py1) ** 2), sqrt((dx - px2) ** 2 + (dy - py2) ** 2)), 0) AS score FROM pc),
bs AS (SELECT * FROM sc QUALIFY row_number() OVER (PARTITION BY road_id ORDER BY n_hits DESC, round(end_s - start_s, 6) DESC, round(score, 6), start_s) = 1)"""


@query(
    f"{LINES} SELECT ms.road_id, round(px1, 4) + 0e0 AS x1, round(py1, 4) + 0e0 AS y1, round(px2, 4) + 0e0 AS x2, round(py2, 4) + 0e0 AS y2, px1 IS NOT NULL AND (ms.sx IS NULL OR sqrt((ms.x1 - px1) ** 2 + (ms.y1 - py1) ** 2) > 2) AS new_src, "
    "px1 IS NOT NULL AND (ms.dx IS NULL OR sqrt((ms.x2 - px2) ** 2 + (ms.y2 - py2) ** 2) > 2) AS new_dst, CASE WHEN px1 IS NULL THEN 'clipped_empty' WHEN ms.sx IS NULL AND ms.dx IS NULL THEN 'fallback_longest_no_existing_endpoint' WHEN n_hits = 0 THEN 'fallback_longest_no_endpoint_match' END AS reason FROM ms LEFT JOIN bs USING (road_id)",
    RNZ,
)
def endpoint_repair(spark, d):
    got = repair.endpoint_repair(_lines(spark, d), v.nodes(spark, d).where("node_id % 7 <> 0"), v.zone_edges(spark, d))
    return rounded(got.select("road_id", "x1", "y1", "x2", "y2", F.col("new_snode").isNotNull().alias("new_src"), F.col("new_enode").isNotNull().alias("new_dst"), "reason"), 4)


# The same roads with a bend in the middle, clipped to the zones grown by 3 m: in SQL a grown rectangle is
# two rectangles and four discs.
def _slab(x1: str, y1: str, x2: str, y2: str) -> str:
    one = lambda p, lo, hi, f, inn, out: f"CASE WHEN d{p} <> 0 THEN {f}(({lo} - {p}1) / d{p}, ({hi} - {p}1) / d{p}) WHEN {p}1 BETWEEN {lo} AND {hi} THEN {inn} ELSE {out} END"
    low = f"greatest(0e0, {one('x', x1, x2, 'least', 0, 2)}, {one('y', y1, y2, 'least', 0, 2)})"
    return f"SELECT road_id, s1, m, {low} AS t0, least(1e0, {one('x', x1, x2, 'greatest', 1, -1)}, {one('y', y1, y2, 'greatest', 1, -1)}) AS t1 FROM bs2, bx"


BENT = LINES.split("cl AS", 1)[0] + f"""mm AS (SELECT *, (x1 + x2) / 2 AS xm, (y1 + y2) / 2 + road_id % 5 * 4 AS ym FROM ms),
b2 AS (SELECT road_id, 0 AS i, x1, y1, xm AS x2, ym AS y2 FROM mm UNION ALL SELECT road_id, 1, xm, ym, x2, y2 FROM mm),
b3 AS (SELECT *, x2 - x1 AS dx, y2 - y1 AS dy, sqrt((x2 - x1) ** 2 + (y2 - y1) ** 2) AS m FROM b2), bs2 AS (SELECT *, coalesce(lag(m) OVER (PARTITION BY road_id ORDER BY i), 0) AS s1 FROM b3 QUALIFY m > 0),
co AS (SELECT unnest([bx1, bx1, bx2, bx2]) AS px, unnest([by1, by2, by1, by2]) AS py FROM bx), di AS (SELECT *, (x1 - px) * dx + (y1 - py) * dy AS h, ((x1 - px) * dx + (y1 - py) * dy) ** 2 - m * m * ((x1 - px) ** 2 + (y1 - py) ** 2 - 9) AS r FROM bs2, co),
iv AS ({_slab("bx1 - 3", "by1", "bx2 + 3", "by2")} UNION ALL {_slab("bx1", "by1 - 3", "bx2", "by2 + 3")} UNION ALL SELECT road_id, s1, m, greatest(0e0, (-h - sqrt(r)) / (m * m)), least(1e0, (-h + sqrt(r)) / (m * m)) FROM di WHERE r > 0),
ab AS (SELECT road_id, s1 + t0 * m AS a, s1 + t1 * m AS b FROM iv WHERE t1 > t0 AND (t1 - t0) * m > 1e-9), mk AS (SELECT *, CAST(coalesce(a > max(b) OVER (PARTITION BY road_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1e-6, true) AS INTEGER) AS n FROM ab),
rn AS (SELECT *, sum(n) OVER (PARTITION BY road_id ORDER BY a, b) AS piece FROM mk), gp AS (SELECT road_id, CAST(piece AS INTEGER) AS piece, min(a) AS start_s, max(b) AS end_s FROM rn GROUP BY ALL)"""


def _bent(spark, d):
    from ..operators.zones import segments

    mid = F.struct(F.lit(1).alias("seq"), ((F.col("x1") + F.col("x2")) / 2).alias("x"), ((F.col("y1") + F.col("y2")) / 2 + F.col("road_id") % 5 * 4).alias("y"))
    ends = [F.struct(F.lit(2 * i).alias("seq"), F.col(f"x{i + 1}").alias("x"), F.col(f"y{i + 1}").alias("y")) for i in (0, 1)]
    return segments(_lines(spark, d).select("road_id", F.inline(F.array(ends[0], mid, ends[1]))), ["road_id"])


@query(f"{BENT} SELECT road_id, piece, round(start_s, 5) AS start_s, round(end_s, 5) AS end_s FROM gp", RNZ)
def grown_zone_pieces(spark, d):
    lines = _bent(spark, d).join(_open_roads(spark, d), "road_id", "left_semi")
    return rounded(zones.grown_zone_pieces(lines, v.zone_edges(spark, d), ["road_id"], 3.0), 5)


def _open_roads(spark, d):
    has = v.nodes(spark, d).where("node_id % 7 <> 0").select("node_id")
    roads = v.roads(spark, d).select("road_id", "snode", "enode")
    both = roads.join(has.withColumnsRenamed({"node_id": "snode"}), "snode", "left_semi").join(has.withColumnsRenamed({"node_id": "enode"}), "enode", "left_semi")
    return roads.join(both, "road_id", "left_anti")


def _spot(s: str, p: str) -> str:
    """Coordinate of a bent road at the station s."""
    return f"CASE WHEN {s} <= m1 THEN coalesce({p}1 + ({p}m - {p}1) * {s} / nullif(m1, 0), {p}1) ELSE {p}m + ({p}2 - {p}m) * ({s} - m1) / m2 END"


_away = lambda a, b: f"sqrt(({a}x - {b}x) ** 2 + ({a}y - {b}y) ** 2)"
REPAIR = f"""{BENT}, ml AS (SELECT *, sqrt((xm - x1) ** 2 + (ym - y1) ** 2) AS m1, sqrt((x2 - xm) ** 2 + (y2 - ym) ** 2) AS m2 FROM mm),
pc AS (SELECT ml.*, piece, start_s, end_s, {_spot("start_s", "x")} AS px, {_spot("start_s", "y")} AS py, {_spot("end_s", "x")} AS qx, {_spot("end_s", "y")} AS qy FROM gp JOIN ml USING (road_id)),
sc AS (SELECT *, least({_away("s", "p")}, {_away("s", "q")}) AS to_s, least({_away("d", "p")}, {_away("d", "q")}) AS to_d FROM pc),
bs AS (SELECT *, coalesce(CAST(to_s <= 2 AS INTEGER), 0) + coalesce(CAST(to_d <= 2 AS INTEGER), 0) AS n_hits FROM sc QUALIFY row_number() OVER (PARTITION BY road_id ORDER BY coalesce(CAST(to_s <= 2 AS INTEGER), 0) + coalesce(CAST(to_d <= 2 AS INTEGER), 0) DESC, round(end_s - start_s, 6) DESC, round(coalesce(to_s, to_d, 0), 6), start_s) = 1),
og AS (SELECT ml.road_id, ml.snode, ml.enode, ml.sx, ml.dx, coalesce(CASE WHEN ml.sx IS NOT NULL THEN sqrt((ml.sx - x1) ** 2 + (ml.sy - y1) ** 2) > sqrt((ml.sx - x2) ** 2 + (ml.sy - y2) ** 2) WHEN ml.dx IS NOT NULL THEN sqrt((ml.dx - x2) ** 2 + (ml.dy - y2) ** 2) > sqrt((ml.dx - x1) ** 2 + (ml.dy - y1) ** 2) END, false) AS fl, x1, y1, x2, y2, ml.sy, ml.dy FROM ml),
rf AS (SELECT og.road_id, og.snode, og.enode, og.sx IS NULL AS ns, og.dx IS NULL AS nd, CASE WHEN fl THEN og.x2 ELSE og.x1 END AS ox, CASE WHEN fl THEN og.y2 ELSE og.y1 END AS oy, CASE WHEN fl THEN og.x1 ELSE og.x2 END AS ex, CASE WHEN fl THEN og.y1 ELSE og.y2 END AS ey,
  coalesce(og.sx, CASE WHEN fl THEN og.x2 ELSE og.x1 END) AS ax, coalesce(og.sy, CASE WHEN fl THEN og.y2 ELSE og.y1 END) AS ay, coalesce(og.dx, CASE WHEN fl THEN og.x1 ELSE og.x2 END) AS gx, coalesce(og.dy, CASE WHEN fl THEN og.y1 ELSE og.y2 END) AS gy, start_s, end_s, px, py, qx, qy, n_hits FROM og LEFT JOIN bs USING (road_id)),
fi AS (SELECT *, {_away("a", "p")} + {_away("g", "q")} > {_away("a", "q")} + {_away("g", "p")} AS f2 FROM rf),
pt AS (SELECT *, CASE WHEN f2 THEN qx ELSE px END AS ux, CASE WHEN f2 THEN qy ELSE py END AS uy, CASE WHEN f2 THEN px ELSE qx END AS wx, CASE WHEN f2 THEN py ELSE qy END AS wy FROM fi),
nw AS (SELECT *, start_s IS NOT NULL AND (ns OR {_away("o", "u")} > 2) AS new_src, start_s IS NOT NULL AND (nd OR {_away("e", "w")} > 2) AS new_dst FROM pt)
SELECT road_id, CASE WHEN NOT new_src THEN snode END AS old_snode, CASE WHEN NOT new_dst THEN enode END AS old_enode, new_src, new_dst, round(start_s, 4) AS start_s, round(end_s, 4) AS end_s, round(ux, 4) + 0e0 AS sx, round(uy, 4) + 0e0 AS sy, round(wx, 4) + 0e0 AS dx, round(wy, 4) + 0e0 AS dy,
  CASE WHEN start_s IS NULL THEN 'clipped_empty' WHEN ns AND nd THEN 'fallback_longest_no_existing_endpoint' WHEN n_hits = 0 THEN 'fallback_longest_no_endpoint_match' END AS reason FROM nw"""


@query(REPAIR, RNZ)
def endpoint_repair_lines(spark, d):
    got = repair.endpoint_repair_lines(v.roads(spark, d), _bent(spark, d), v.nodes(spark, d).where("node_id % 7 <> 0"), v.zone_edges(spark, d), 3.0)
    got = got.withColumns({"old_snode": F.when(~F.col("new_src"), F.col("snode")), "old_enode": F.when(~F.col("new_dst"), F.col("enode"))})
    return rounded(got.drop("snode", "enode", "outside_ratio"), 4)


@query("SELECT road_id, CASE WHEN snode % 7 <> 0 AND enode % 7 <> 0 THEN sqrt((ax - x1) ** 2 + (ay - y1) ** 2) + sqrt((bx - x2) ** 2 + (b_y - y2) ** 2) > sqrt((ax - x2) ** 2 + (ay - y2) ** 2) + sqrt((bx - x1) ** 2 + (b_y - y1) ** 2) WHEN snode % 7 <> 0 THEN sqrt((ax - x1) ** 2 + (ay - y1) ** 2) > sqrt((ax - x2) ** 2 + (ay - y2) ** 2) WHEN enode % 7 <> 0 THEN sqrt((bx - x2) ** 2 + (b_y - y2) ** 2) > sqrt((bx - x1) ** 2 + (b_y - y1) ** 2) ELSE false END AS flip FROM (SELECT road_id, snode, enode, snode % 11 * 1e0 AS x1, snode % 5 * 1e0 AS y1, enode % 11 * 1e0 AS x2, enode % 5 * 1e0 AS y2, snode % 3 * 4e0 AS ax, 1e0 AS ay, enode % 4 * 3e0 AS bx, 2e0 AS b_y FROM v_roads)", ("v_roads",))
def endpoint_assign(spark, d):
    rows = v.roads(spark, d).selectExpr(
        "road_id", "snode % 11 * 1e0D AS x1", "snode % 5 * 1e0D AS y1", "enode % 11 * 1e0D AS x2", "enode % 5 * 1e0D AS y2",
        "CASE WHEN snode % 7 <> 0 THEN snode % 3 * 4e0D END AS sx", "CASE WHEN snode % 7 <> 0 THEN 1e0D END AS sy", "CASE WHEN enode % 7 <> 0 THEN enode % 4 * 3e0D END AS dx", "CASE WHEN enode % 7 <> 0 THEN 2e0D END AS dy",
    )
    return repair.endpoint_assign(rows).select("road_id", "flip")


@query(
    """n AS (SELECT node_id AS row_id, CASE WHEN node_id % 3 = 0 THEN node_id + 1 END AS mainid, CASE WHEN node_id % 5 = 0 THEN node_id + 2 END AS mainnodeid, node_id AS id FROM v_nodes),
    e AS (SELECT snode AS value FROM v_roads UNION SELECT enode FROM v_roads), f AS (SELECT row_id, unnest([0, 1, 2]) AS place, unnest([mainid, mainnodeid, id]) AS value FROM n),
    g AS (SELECT f.*, e.value IS NULL AS unused FROM f LEFT JOIN e USING (value) WHERE f.value IS NOT NULL), c AS (SELECT row_id, value AS node_id FROM g QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY unused, place) = 1)
    SELECT row_id, node_id, row_number() OVER (PARTITION BY node_id ORDER BY row_id) = 1 AS kept FROM c""",
    ("v_roads", "v_nodes"),
)
def node_alias_resolve(spark, d):
    fields = F.create_map(F.lit("mainid"), F.when(F.col("node_id") % 3 == 0, F.col("node_id") + 1), F.lit("mainnodeid"), F.when(F.col("node_id") % 5 == 0, F.col("node_id") + 2), F.lit("id"), F.col("node_id"))
    rows = v.nodes(spark, d).select(F.col("node_id").alias("row_id"), fields.alias("id_fields"))
    return repair.node_alias_resolve(rows, v.roads(spark, d))


STEPS = """dg AS (SELECT node_id, count(DISTINCT road_id) AS g FROM (SELECT snode AS node_id, road_id FROM v_roads UNION ALL SELECT enode, road_id FROM v_roads) GROUP BY 1),
goal AS (SELECT node_id FROM dg JOIN v_nodes USING (node_id) WHERE g >= 3 AND kind & 28 <> 0),
st0 AS (SELECT snode AS a, enode AS b, road_id, length_m FROM v_roads UNION ALL SELECT enode, snode, road_id, length_m FROM v_roads),
st AS (SELECT a, b, road_id, length_m, (q.x - p.x) / sqrt((q.x - p.x) ** 2 + (q.y - p.y) ** 2) AS ux, (q.y - p.y) / sqrt((q.x - p.x) ** 2 + (q.y - p.y) ** 2) AS uy FROM st0 JOIN v_nodes p ON p.node_id = a JOIN v_nodes q ON q.node_id = b WHERE a <> b),
nx AS (SELECT * FROM (SELECT u.a AS f, u.b AS v, u.road_id AS r1, w.road_id AS r2, w.b AS t, w.length_m AS m, w.ux AS ux, w.uy AS uy, round(u.ux * w.ux + u.uy * w.uy, 9) AS al FROM st u JOIN st w ON w.a = u.b AND w.road_id <> u.road_id AND w.b <> u.a) QUALIFY row_number() OVER (PARTITION BY f, v, r1 ORDER BY al DESC, m DESC, r2) = 1),
wk AS (SELECT a AS node_id, road_id, a AS prev, b AS cur, road_id AS via, length_m AS dist_m, 0 AS h FROM st
  UNION ALL SELECT wk.node_id, wk.road_id, wk.cur, nx.t, nx.r2, wk.dist_m + nx.m, h + 1 FROM wk JOIN nx ON nx.f = wk.prev AND nx.v = wk.cur AND nx.r1 = wk.via AND al >= -0.25e0 WHERE h < 63 AND (wk.cur = wk.node_id OR wk.cur NOT IN (SELECT node_id FROM goal)))
SELECT st.a AS node_id, st.road_id, dist_m, cur AS dst FROM st LEFT JOIN (SELECT * FROM wk WHERE cur <> node_id AND cur IN (SELECT node_id FROM goal)) z ON z.node_id = st.a AND z.road_id = st.road_id"""


@query(STEPS, ("v_roads", "v_nodes"))
def next_intersection_distance(spark, d):
    kinds = scalars.CROSS | scalars.MERGE | scalars.DIVERGE
    return repair.next_intersection_distance(v.roads(spark, d), v.nodes(spark, d), v.nodes(spark, d).select("node_id"), kinds)


# --- scans -----------------------------------------------------------------------

# Scans go along x from nodes near the zones, with vertical crosslines of 40 m.
SCAN = "nk AS (SELECT node_id, x, y, CASE WHEN node_id % 3 = 0 THEN 20e0 ELSE 30e0 END AS stop_m FROM v_nodes), sn AS (SELECT node_id, CAST(k AS INTEGER) AS k, k * 2e0 AS s, x + k * 2e0 AS cx, y AS cy FROM nk, LATERAL (SELECT unnest(range(CAST(floor(stop_m / 2) AS BIGINT) + 1)) AS k))"
NZ = ("v_nodes", "v_zone_edges")


def _scan(spark, d):
    stop, _ = anchors.scan_stop(30.0, F.when(F.col("node_id") % 3 == 0, 20.0))
    nodes = v.nodes(spark, d).withColumns({"ux": F.lit(1.0), "uy": F.lit(0.0), "stop_m": stop})
    return anchors.crossline_scan(nodes, 2.0, 20.0)


@query(f"{SCAN} SELECT node_id, k, s, cx AS x1, cy + 20 AS y1, cx AS x2, cy - 20 AS y2 FROM sn", NZ)
def crossline_scan(spark, d):
    return _scan(spark, d)


@query("SELECT node_id, CASE WHEN node_id % 3 = 0 THEN 20e0 ELSE 30e0 END AS stop_m, CASE WHEN node_id % 3 = 0 THEN 'next_intersection' ELSE 'max_distance' END AS reason FROM v_nodes", ("v_nodes",))
def scan_stop(spark, d):
    stop, why = anchors.scan_stop(30.0, F.when(F.col("node_id") % 3 == 0, 20.0))
    return v.nodes(spark, d).select("node_id", stop.alias("stop_m"), why.alias("reason"))


# Two stripes across every zone stand for a divided road.
STRIPES = """sp AS (SELECT DISTINCT poly_id FROM v_zone_edges), bd AS (SELECT poly_id * 2 + i AS pid, poly_id * 70e0 AS bx1, poly_id * 70e0 + 60e0 AS bx2, i * 18e0 AS by1, i * 18e0 + 12e0 AS by2 FROM sp, range(2) r(i)),
hit AS (SELECT node_id, k, s, greatest(by1, cy - 20) AS lo, least(by2, cy + 20) AS hi, cy FROM sn JOIN bd ON cx >= bx1 AND cx < bx2),
pc AS (SELECT node_id, k, s, cy + 20 - hi AS start_s, cy + 20 - lo AS end_s FROM hit WHERE hi - lo >= 1)"""


def _stripes(spark, d):
    base = v.zone_edges(spark, d).select("poly_id", F.explode(F.array(F.lit(0), F.lit(1))).alias("id")).distinct()
    low, high = "poly_id * 70e0D", "poly_id * 70e0D + 60e0D"
    y1, y2 = "id * 18e0D", "id * 18e0D + 12e0D"
    points = [(low, y1), (high, y1), (high, y2), (low, y2)]
    edges = ", ".join(f"named_struct('edge_ix', {i}, 'x1', {a[0]}, 'y1', {a[1]}, 'x2', {b[0]}, 'y2', {b[1]})" for i, (a, b) in enumerate(zip(points, points[1:] + points[:1])))
    return base.selectExpr("poly_id * 2 + id AS poly_id", f"inline(array({edges}))")


@query(f"{SCAN}, {STRIPES}, n AS (SELECT node_id, k, s, count(*) AS n FROM pc GROUP BY ALL) SELECT sn.node_id, min(CASE WHEN n >= 2 THEN sn.s END) AS split_s, coalesce(max(n), 0) AS most_pieces, min(CASE WHEN n >= 2 THEN sn.s END) + 5 AS extended_s FROM sn LEFT JOIN n USING (node_id, k) GROUP BY sn.node_id", NZ)
def first_split(spark, d):
    scan = _scan(spark, d)
    return anchors.first_split(scan, anchors.scan_pieces(scan, _stripes(spark, d)))


@query(f"{SCAN}, {STRIPES}, g AS (SELECT node_id, k, count(*) AS n_pieces, max(CASE WHEN end_s <= 20 THEN end_s END) AS left_end, min(CASE WHEN start_s >= 20 THEN start_s END) AS right_start FROM pc GROUP BY ALL) SELECT node_id, k, n_pieces, round(left_end, 6) AS left_end, round(right_start, 6) AS right_start, round((left_end + right_start) / 2, 6) AS gap_mid FROM g", NZ)
def pieces_pick(spark, d):
    pieces = anchors.scan_pieces(_scan(spark, d), _stripes(spark, d))
    return rounded(anchors.pieces_pick(pieces, ["node_id", "k"], 20.0))


# Branches leave a node along x, one to the left for 25 m, one to the right: the crosslines end on them.
BRANCHES = f"""{SCAN}, bb AS (SELECT node_id, k, s, cx, s <= 25 AS a_hit, true AS b_hit, cx - greatest(0e0, s - 25) AS ax, cy + 0.4e0 * least(s, 25e0) AS ay, cy - 0.3e0 * s AS b_y FROM sn),
{STRIPES.split("hit AS")[0].rstrip().rstrip(",")}, bp AS (SELECT node_id, bb.k, bb.s, greatest(by1, b_y) AS lo, least(by2, ay) AS hi, ay FROM bb JOIN bd ON s <= 25 AND cx >= bx1 AND cx < bx2), pc AS (SELECT node_id, k, s, hi - lo AS m FROM bp WHERE hi - lo >= 1)"""


def _branch_lines(spark, d):
    stop, _ = anchors.scan_stop(30.0, F.when(F.col("node_id") % 3 == 0, 20.0))
    nodes = v.nodes(spark, d).withColumns({"ux": F.lit(1.0), "uy": F.lit(0.0), "stop_m": stop})
    parts = "array(named_struct('branch', 'a', 'seq', 1, 'd1', 0e0D, 'e1', 0e0D, 'd2', 10e0D, 'e2', 4e0D), named_struct('branch', 'a', 'seq', 2, 'd1', 10e0D, 'e1', 4e0D, 'd2', 25e0D, 'e2', 10e0D), named_struct('branch', 'b', 'seq', 1, 'd1', 0e0D, 'e1', 0e0D, 'd2', 40e0D, 'e2', -12e0D))"
    rows = nodes.selectExpr("node_id", "x", "y", f"inline({parts})")
    return nodes, rows.selectExpr("node_id", "branch", "seq", "x + d1 AS x1", "y + e1 AS y1", "x + d2 AS x2", "y + e2 AS y2")


@query(f"{BRANCHES} SELECT node_id, k, s, round(ax, 6) AS x1, round(ay, 6) AS y1, round(cx, 6) AS x2, round(b_y, 6) AS y2, a_hit, b_hit, round(sqrt((ax - cx) ** 2 + (ay - b_y) ** 2), 6) AS seg_m FROM bb", NZ)
def between_branches(spark, d):
    return rounded(anchors.between_branches(*_branch_lines(spark, d), step=2.0))


@query(f"{BRANCHES}, n AS (SELECT node_id, k, s, count(*) AS n FROM pc GROUP BY ALL) SELECT bb.node_id, min(CASE WHEN n >= 2 THEN bb.s END) AS split_s, coalesce(max(n), 0) AS most_pieces FROM bb LEFT JOIN n USING (node_id, k) WHERE bb.s <= 25 GROUP BY bb.node_id", NZ)
def branch_split(spark, d):
    """The first split between branches: pieces are counted on crosslines as wide as the road."""
    scan = network.cut(anchors.between_branches(*_branch_lines(spark, d), step=2.0).where("s <= 25"))
    return anchors.first_split(scan, anchors.scan_pieces(scan, _stripes(spark, d))).select("node_id", "split_s", "most_pieces")


TIPS = "tp AS (SELECT DISTINCT poly_id * 70e0 + 30e0 + poly_id * 1.5e0 AS px, 27e0 AS py FROM v_zone_edges), ht AS (SELECT node_id, s, round(sqrt((px - cx) ** 2 + greatest(0e0, abs(py - cy) - 20) ** 2), 6) AS d FROM sn JOIN tp ON px BETWEEN cx - 60 AND cx + 60), fh AS (SELECT node_id, min(CASE WHEN d <= 1 THEN s END) AS first_s, min(d) AS closest_m FROM ht GROUP BY node_id)"


def _tips(spark, d):
    return v.zone_edges(spark, d).selectExpr("poly_id * 70e0D + 30e0D + poly_id * 1.5e0D AS x", "27e0D AS y").distinct()


@query(f"{SCAN}, {TIPS} SELECT node_id, first_s FROM fh WHERE first_s IS NOT NULL", NZ)
def divstrip_first_hit(spark, d):
    return anchors.divstrip_first_hit(_scan(spark, d), _tips(spark, d)).where("first_s IS NOT NULL").select("node_id", "first_s")


CHOICE = f"""{SCAN}, {TIPS}, {STRIPES}, n AS (SELECT node_id, k, s, count(*) AS n FROM pc GROUP BY ALL), sl AS (SELECT sn.node_id, min(CASE WHEN n >= 2 THEN sn.s END) AS split_s FROM sn LEFT JOIN n USING (node_id, k) GROUP BY sn.node_id),
ch AS (SELECT node_id, CASE WHEN first_s IS NOT NULL AND (abs(first_s - split_s) <= 10 OR split_s IS NULL) THEN 'divider_hit' WHEN split_s IS NOT NULL THEN 'zone_split' ELSE 'none' END AS source, CASE WHEN first_s IS NOT NULL AND (abs(first_s - split_s) <= 10 OR split_s IS NULL) THEN first_s ELSE split_s END AS s FROM sl LEFT JOIN (SELECT * FROM fh WHERE first_s IS NOT NULL) USING (node_id))"""


def _anchors(spark, d):
    scan = _scan(spark, d)
    split = anchors.first_split(scan, anchors.scan_pieces(scan, _stripes(spark, d)))
    hit = anchors.divstrip_first_hit(scan, _tips(spark, d)).where("first_s IS NOT NULL").select("node_id", "first_s")
    rows = split.join(hit, "node_id", "left").withColumn("tip_s", F.lit(None).cast("double"))
    return rows.select("node_id", anchors.reference_choice().alias("c")).select("node_id", "c.source", "c.s")


@query(f"{CHOICE} SELECT node_id, source, s FROM ch", NZ)
def reference_choice(spark, d):
    return _anchors(spark, d)


@query(f"{CHOICE} SELECT source, count(*) AS n, quantile_cont(s, 0.5e0) AS p50, quantile_cont(s, 0.9e0) AS p90 FROM ch GROUP BY source", NZ)
def anchor_metrics(spark, d):
    return anchors.anchor_metrics(_anchors(spark, d))


@query(f"{CHOICE}, b AS (SELECT DISTINCT node_id, unnest(list_append(list_transform(range(CAST(floor((s + 20) / 5) AS BIGINT) + 1), lambda i: s - i * 5), 0)) AS at_s FROM ch WHERE s IS NOT NULL) SELECT node_id, count(*) AS n, min(at_s) AS low, max(at_s) AS high FROM b GROUP BY node_id", NZ)
def backtrack_probe(spark, d):
    rows = _anchors(spark, d).where("s IS NOT NULL").select("node_id", F.explode(anchors.backtrack_probe(F.col("s"))).alias("at_s"))
    return rows.groupBy("node_id").agg(F.count("*").alias("n"), F.min("at_s").alias("low"), F.max("at_s").alias("high"))
