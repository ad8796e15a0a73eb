"""Hits, anchors, witnesses, barriers, spans and fused lines over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import evidence as E
from ..operators import network, zones
from ..sources import views as v
from .anchor_queries import AT, ATY, STRIPES, _lines, _stripes
from .network_queries import CHAIN, LINE, OFFSET, PAIRS, RN, SEG, TX, TZ, _events
from .registry import query, rounded


@query(f"{PAIRS}, q AS (SELECT src, dst FROM pr UNION SELECT dst, src FROM pr) SELECT src, dst, a.traj_id, a.seq_at < b.seq_at AS terminal FROM q JOIN ev a ON a.node_id = src JOIN ev b ON b.node_id = dst AND b.traj_id = a.traj_id", TX)
def terminal_hit(spark, d):
    events = _events(spark, d)
    pairs = zones.traj_pair_candidates(events, LINE).select("src", "dst")
    return E.terminal_hit(events.select("traj_id", "node_id", F.col("seq_at").alias("pos")), pairs.union(pairs.select("dst", "src")))


PX, PY = "(snode % 40 * 25e0 + ({k}) * 10e0)", "((road_id + ({k}) * ({k})) % 3 * 4e0)"
_p = lambda k: (PX.format(k=k), PY.format(k=k))


def _unit(a: str, b: str, name: str) -> str:
    (x0, y0), (x1, y1) = _p(a), _p(b)
    m = f"sqrt(({x1} - {x0}) ** 2 + ({y1} - {y0}) ** 2)"
    return f"round(({x1} - {x0}) / {m}, 6) + 0e0 AS {name}x, round(({y1} - {y0}) / {m}, 6) + 0e0 AS {name}y"


@query(
    f"""l AS (SELECT *, 2 + road_id % 4 AS n FROM v_roads)
    SELECT road_id, snode AS node_id, false AS at_end, {_unit('0', '1', 'a')}, {_unit('0', 'least(n - 1, greatest(1, n // 2))', 't')} FROM l
    UNION ALL SELECT road_id, enode, true, {_unit('n - 1', 'n - 2', 'a')}, {_unit('n - 1', 'greatest(0, least(n - 2, n // 2 - 1))', 't')} FROM l""",
    ("v_roads",),
)
def away_and_trend_vector(spark, d):
    k = F.sequence(F.lit(0), F.col("road_id") % 4 + 1)
    line = F.transform(k, lambda i: F.struct((F.col("snode") % 40 * 25.0 + i * 10.0).alias("x"), ((F.col("road_id") + i * i) % 3 * 4.0).alias("y")))
    return rounded(E.away_and_trend_vector(v.roads(spark, d).withColumn("line", line)))


LN = f"ln AS (SELECT road_id, {AT.format(id='snode')} AS x1, {ATY.format(id='snode')} AS y1, {AT.format(id='enode')} AS x2, {ATY.format(id='enode')} AS y2 FROM v_roads)"
_t = lambda p: f"greatest(0e0, least(1e0, (({p}x - c.x1) * (c.x2 - c.x1) + ({p}y - c.y1) * (c.y2 - c.y1)) / ((c.x2 - c.x1) ** 2 + (c.y2 - c.y1) ** 2)))"
_d = lambda p: f"sqrt(({p}x - c.x1 - {_t(p)} * (c.x2 - c.x1)) ** 2 + ({p}y - c.y1 - {_t(p)} * (c.y2 - c.y1)) ** 2)"


@query(
    f"""{LN}, st AS (SELECT road_id, node_id AS src, {_d('p.')} AS d1 FROM (SELECT road_id, x1 AS x, y1 AS y FROM ln) p, v_xsecs c), en AS (SELECT road_id, node_id AS dst, {_d('p.')} AS d2 FROM (SELECT road_id, x2 AS x, y2 AS y FROM ln) p, v_xsecs c),
    j AS (SELECT road_id, src, dst, round(d1 + d2, 9) AS cost_m FROM (SELECT * FROM st WHERE d1 <= 40) JOIN (SELECT * FROM en WHERE d2 <= 40) USING (road_id) WHERE src <> dst)
    SELECT road_id, src, dst, round(cost_m, 6) AS cost_m FROM j WHERE cost_m <= 40 QUALIFY row_number() OVER (PARTITION BY road_id ORDER BY cost_m, src, dst) = 1""",
    ("v_roads", "v_xsecs"),
)
def prior_anchor_pair(spark, d):
    return rounded(E.prior_anchor_pair(_lines(spark, d), v.xsecs(spark, d)))


@query(
    f"""{SEG}, tl AS (SELECT patch_id, traj_id, sum(seg_m) AS length_m FROM s GROUP BY ALL), wn AS (SELECT *, length_m * place AS spot FROM tl, (VALUES (0, 0.35e0), (1, 0.5e0), (2, 0.65e0)) q(k, place) WHERE length_m >= 12),
    pb AS (SELECT s.patch_id, s.traj_id, k, x1 + (spot - s1) / seg_m * (x2 - x1) AS px, y1 + (spot - s1) / seg_m * (y2 - y1) AS py, (x2 - x1) / seg_m AS tx, (y2 - y1) / seg_m AS ty FROM s JOIN wn ON wn.traj_id = s.traj_id AND seg_m > 0 AND spot >= s1 AND spot < s1 + seg_m AND spot > 1 AND spot < length_m - 1),
    cr AS (SELECT *, px + 30 * ty AS a1, py - 30 * tx AS b1, px - 30 * ty AS a2, py + 30 * tx AS b2 FROM pb), bx AS (SELECT poly_id, min(x1) AS bx1, max(x1) AS bx2, min(y1) AS by1, max(y1) AS by2 FROM v_zone_edges GROUP BY 1),
    cl AS (SELECT patch_id, traj_id, k, 60 * greatest(0e0, CASE WHEN a2 <> a1 THEN least((bx1 - a1) / (a2 - a1), (bx2 - a1) / (a2 - a1)) ELSE 0 END, least((by1 - b1) / (b2 - b1), (by2 - b1) / (b2 - b1))) AS lo,
      60 * least(1e0, CASE WHEN a2 <> a1 THEN greatest((bx1 - a1) / (a2 - a1), (bx2 - a1) / (a2 - a1)) ELSE 1 END, greatest((by1 - b1) / (b2 - b1), (by2 - b1) / (b2 - b1))) AS hi FROM cr, bx WHERE a1 <> a2 OR (a1 >= bx1 AND a1 < bx2)),
    iv AS (SELECT *, row_number() OVER w AS rank, lo - lag(hi) OVER w AS g1, lead(lo) OVER w - hi AS g2, count(*) OVER (PARTITION BY traj_id, k) AS n FROM cl WHERE hi - lo >= 1 WINDOW w AS (PARTITION BY traj_id, k ORDER BY lo, hi)),
    ch AS (SELECT *, (lo + hi) / 2 AS c FROM iv QUALIFY row_number() OVER (PARTITION BY traj_id, k ORDER BY NOT (lo <= 30 AND hi >= 30), CASE WHEN lo <= 30 AND hi >= 30 THEN 0 ELSE round(abs((lo + hi) / 2 - 30), 9) END, rank) = 1),
    np AS (SELECT patch_id, traj_id, count(*) AS np FROM pb GROUP BY ALL),
    sc AS (SELECT ch.*, round(0.7e0 * (SELECT count(*) FROM ch o WHERE o.traj_id = ch.traj_id AND o.k <> ch.k AND o.rank = ch.rank AND abs(o.c - ch.c) <= 3) / greatest(1, np - 1) + CASE WHEN n = 1 OR least(coalesce(g1, 1e9), coalesce(g2, 1e9)) >= 1 THEN 0.3e0 ELSE 0e0 END, 9) AS score FROM ch JOIN np USING (patch_id, traj_id)),
    b AS (SELECT * FROM sc QUALIFY row_number() OVER (PARTITION BY traj_id ORDER BY score DESC, k) = 1)
    SELECT np.patch_id, np.traj_id, k, rank, round(lo, 5) AS start_s, round(hi, 5) AS end_s, round(score, 5) AS score, coalesce(score >= 0.55e0, false) AS witness FROM np LEFT JOIN b USING (patch_id, traj_id)""",
    TZ,
)
def corridor_witness(spark, d):
    return rounded(E.corridor_witness(zones.segments(v.traj(spark, d), LINE), v.zone_edges(spark, d), LINE), 5)


AXES = """ax AS (SELECT a.node_id % 8 AS patch_id, a.node_id AS src, b.node_id AS dst, (a.x1 + a.x2) / 2 AS sx, (a.y1 + a.y2) / 2 AS sy, (b.x1 + b.x2) / 2 - (a.x1 + a.x2) / 2 AS dx, (b.y1 + b.y2) / 2 - (a.y1 + a.y2) / 2 AS dy FROM v_xsecs a JOIN v_xsecs b ON b.node_id = a.node_id + 3),
ay AS (SELECT *, sqrt(dx * dx + dy * dy) AS m FROM ax), pt AS (SELECT ay.*, (x - sx) * dx / m + (y - sy) * dy / m AS along, (y - sy) * dx / m - (x - sx) * dy / m AS across FROM ay JOIN v_points p ON p.patch_id = ay.patch_id AND cls = 2),
kp AS (SELECT * FROM pt WHERE along >= -10 AND along <= m + 10 AND abs(across) <= 30), st0 AS (SELECT ay.*, unnest(range(CAST(floor(m / 10 + 0.5e0) AS BIGINT) + 1)) AS k, false AS tail FROM ay), st AS (SELECT src, dst, k, least(k * 10e0, m) AS s FROM st0 UNION ALL SELECT src, dst, CAST(floor(m / 10 + 0.5e0) AS BIGINT) + 1, m FROM ay WHERE floor(m / 10 + 0.5e0) * 10 < m - 1e-6),
md AS (SELECT patch_id, kp.src, kp.dst, k, sx + dx / m * s - dy / m * median(across) AS x, sy + dy / m * s + dx / m * median(across) AS y FROM kp JOIN st ON st.src = kp.src AND abs(along - s) <= 7.5e0 GROUP BY patch_id, kp.src, kp.dst, k, sx, sy, dx, dy, m, s HAVING count(*) >= 8),
en AS (SELECT src FROM kp GROUP BY src HAVING count(*) >= 24)"""


@query(f"{AXES} SELECT patch_id, src, dst, k, round(x, 5) AS x, round(y, 5) AS y FROM md WHERE src IN (SELECT src FROM en) QUALIFY count(*) OVER (PARTITION BY src) >= 3", ("v_xsecs", "v_points"))
def surface_centerline(spark, d):
    own = v.xsecs(spark, d).selectExpr("node_id", "(x1 + x2) / 2 AS x", "(y1 + y2) / 2 AS y")
    pairs = own.selectExpr("node_id % 8 AS patch_id", "node_id AS src", "node_id + 3 AS dst", "x AS x1", "y AS y1").join(own.selectExpr("node_id AS dst", "x AS x2", "y AS y2"), "dst")
    return rounded(E.surface_centerline(pairs, v.points(spark, d).where("cls = 2")).withColumn("k", F.col("k").cast("long")), 5)


SAMPLES = """sm AS (SELECT node_id, node_id % 8 AS patch_id, x1, y1, x2, y2, sqrt((x2 - x1) ** 2 + (y2 - y1) ** 2) AS len, CAST(greatest(1, ceil(round(sqrt((x2 - x1) ** 2 + (y2 - y1) ** 2), 9))) AS BIGINT) AS parts FROM v_xsecs),
sq AS (SELECT node_id, patch_id, len, i, i / parts * len AS s, x1 + i / parts * (x2 - x1) AS x, y1 + i / parts * (y2 - y1) AS y FROM sm, unnest(range(parts + 1)) t(i))"""
BARRIERS = f"""{SAMPLES}, nr AS (SELECT sq.patch_id, sq.node_id, i, s FROM sq JOIN v_points p ON p.patch_id = sq.patch_id AND cls <> 2 AND (p.x - sq.x) * (p.x - sq.x) + (p.y - sq.y) * (p.y - sq.y) <= 9 GROUP BY ALL HAVING count(*) >= 2),
rr AS (SELECT *, i - row_number() OVER (PARTITION BY node_id ORDER BY i) AS r FROM nr), g AS (SELECT patch_id, node_id, r, min(s) AS start_s, max(s) AS end_s, min(i) AS lo, max(i) AS hi FROM rr GROUP BY ALL HAVING count(*) >= 4),
br AS (SELECT patch_id, node_id, row_number() OVER (PARTITION BY node_id ORDER BY start_s) AS run, start_s, end_s, hi - lo + 1 AS n_samples, (lo + hi) // 2 AS mid FROM g),
oc AS (SELECT br.node_id, run, count(DISTINCT least(floor((along + 60) / 2), 59)) / 60 AS occupancy FROM br JOIN sq ON sq.node_id = br.node_id AND i = mid JOIN sm ON sm.node_id = br.node_id JOIN v_traj t ON t.patch_id = br.patch_id,
  LATERAL (SELECT round((t.x - sq.x) * (sm.y2 - sm.y1) / sm.len - (t.y - sq.y) * (sm.x2 - sm.x1) / sm.len, 9) AS along, round(abs((t.x - sq.x) * (sm.x2 - sm.x1) / sm.len + (t.y - sq.y) * (sm.y2 - sm.y1) / sm.len), 9) AS off) WHERE abs(along) <= 60 AND off <= 1.25e0 GROUP BY ALL),
ba AS (SELECT br.*, coalesce(occupancy, 0) AS occupancy, coalesce(occupancy, 0) >= 0.25e0 AS final FROM br LEFT JOIN oc USING (node_id, run))"""


def _barriers(spark, d):
    xsecs = v.xsecs(spark, d).withColumn("patch_id", F.col("node_id") % 8)
    return xsecs, E.barrier_runs(xsecs, v.points(spark, d).where("cls <> 2"), v.traj(spark, d), radius=3.0, least_share=0.25)


@query(f"{BARRIERS} SELECT patch_id, node_id, run, round(start_s, 6) AS start_s, round(end_s, 6) AS end_s, n_samples, round(occupancy, 9) AS occupancy, final FROM ba", ("v_xsecs", "v_points", "v_traj"))
def barrier_runs(spark, d):
    runs = _barriers(spark, d)[1].withColumns({"run": F.col("run").cast("long"), "n_samples": F.col("n_samples").cast("long"), "occupancy": F.round("occupancy", 9)})
    return runs.withColumns({c: F.round(c, 6) for c in ("start_s", "end_s")})


@query(
    f"""{BARRIERS}, b AS (SELECT patch_id, node_id, 0e0 AS a, 0e0 AS b FROM sm UNION ALL SELECT patch_id, node_id, start_s - 3, end_s + 3 FROM ba WHERE final UNION ALL SELECT patch_id, node_id, len, len FROM sm),
    w AS (SELECT *, max(b) OVER (PARTITION BY node_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS f FROM b), p AS (SELECT w.patch_id, w.node_id, greatest(0e0, f) AS start_s, least(a, len) AS end_s FROM w JOIN sm USING (node_id) WHERE least(a, len) > greatest(0e0, f) + 1e-9)
    SELECT patch_id, node_id, row_number() OVER (PARTITION BY node_id ORDER BY start_s) AS part, round(start_s, 6) AS start_s, round(end_s, 6) AS end_s FROM p""",
    ("v_xsecs", "v_points", "v_traj"),
)
def barrier_parts(spark, d):
    return rounded(E.barrier_parts(*_barriers(spark, d), radius=3.0).withColumn("part", F.col("part").cast("long")))


@query(
    f"""{SAMPLES}, {STRIPES.split('hit AS')[0].rstrip().rstrip(',')}, bx AS (SELECT poly_id, min(x1) AS bx1, max(x1) AS bx2, min(y1) AS by1, max(y1) AS by2 FROM v_zone_edges GROUP BY 1),
    fr AS (SELECT * FROM sq WHERE EXISTS (SELECT 1 FROM bx WHERE x >= bx1 AND x < bx2 AND y >= by1 AND y < by2) AND NOT EXISTS (SELECT 1 FROM bd WHERE x >= bd.bx1 AND x < bd.bx2 AND y >= bd.by1 AND y < bd.by2)),
    rr AS (SELECT *, i - row_number() OVER (PARTITION BY node_id ORDER BY i) AS r FROM fr), g AS (SELECT node_id, len / 2 AS a, min(s) AS start_s, max(s) AS end_s FROM rr GROUP BY node_id, len, r)
    SELECT node_id, round(start_s, 6) AS start_s, round(end_s, 6) AS end_s, round(a - start_s, 6) AS left_m, round(end_s - a, 6) AS right_m FROM g QUALIFY row_number() OVER (PARTITION BY node_id ORDER BY round(greatest(0e0, start_s - a, a - end_s), 9), start_s) = 1""",
    ("v_xsecs", "v_zone_edges"),
)
def xsec_passable_span(spark, d):
    return rounded(E.xsec_passable_span(v.xsecs(spark, d), v.zone_edges(spark, d), _stripes(spark, d)))


@query(
    """WITH p AS (SELECT CAST(floor(l_orderkey / 20) AS BIGINT) AS arc_id, l_orderkey * 8 + l_linenumber AS piece_id, greatest(0e0, l_suppkey % 90 * 1e0) AS a, least(95e0, l_suppkey % 90 + l_quantity / 8e0) AS b FROM lineitem WHERE l_partkey % 3 > 0),
    c AS (SELECT *, coalesce(max(b) OVER (PARTITION BY arc_id ORDER BY a, piece_id, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cur FROM p WHERE b > a + 1e-6), ar AS (SELECT DISTINCT CAST(floor(l_orderkey / 20) AS BIGINT) AS arc_id FROM lineitem), e AS (SELECT arc_id, max(b) AS b FROM c GROUP BY 1),
    u AS (SELECT arc_id, 'support' AS source, piece_id, greatest(a, cur) AS from_s, b AS to_s FROM c WHERE b > cur + 1e-6 UNION ALL SELECT arc_id, 'arc', NULL, cur, a FROM c WHERE a > cur + 1e-6 UNION ALL SELECT arc_id, 'arc', NULL, coalesce(b, 0), 95e0 FROM ar LEFT JOIN e USING (arc_id) WHERE coalesce(b, 0) < 95 - 1e-6)
    SELECT *, row_number() OVER (PARTITION BY arc_id ORDER BY from_s, to_s) AS ord FROM u"""
)
def support_fuse_line(spark, d):
    lines = spark.read.parquet(f"{d}/lineitem.parquet")
    arcs = lines.selectExpr("floor(l_orderkey / 20) AS arc_id", "95e0D AS length_m").distinct()
    start, end = "l_suppkey % 90 * 1e0D", "l_suppkey % 90 + l_quantity / 8e0D"
    turned = lambda a, b: f"CASE WHEN l_partkey % 2 = 0 THEN {a} ELSE {b} END"
    pieces = lines.where("l_partkey % 3 > 0").selectExpr("floor(l_orderkey / 20) AS arc_id", "l_orderkey * 8 + l_linenumber AS piece_id", f"{turned(start, end)} AS start_s", f"{turned(end, start)} AS end_s")
    return E.support_fuse_line(pieces, arcs)


@query(
    f"""{SEG}, ar AS (SELECT traj_id AS arc_id, max(s1 + seg_m) AS m FROM s GROUP BY 1), sp AS (SELECT arc_id, i, 20e0 * i + 5 AS a, least(20e0 * i + 15, m) AS b FROM ar, range(3) r(i) WHERE 20 * i + 5 < m - 1e-6),
    ga AS (SELECT arc_id, 2 * i AS o, CASE WHEN i = 0 THEN 0e0 ELSE 20e0 * i - 5 END AS f, a AS t FROM sp UNION ALL SELECT arc_id, 99, max(b), any_value(m) FROM sp JOIN ar USING (arc_id) GROUP BY arc_id HAVING max(b) < any_value(m) - 1e-6 UNION ALL SELECT arc_id, 99, 0e0, m FROM ar WHERE arc_id NOT IN (SELECT arc_id FROM sp)),
    gv AS (SELECT arc_id, o, unnest([2 * seq, 2 * seq + 1]) AS i, unnest([x1 + (greatest(f, s1) - s1) / seg_m * (x2 - x1), x1 + (least(t, s1 + seg_m) - s1) / seg_m * (x2 - x1)]) AS x, unnest([y1 + (greatest(f, s1) - s1) / seg_m * (y2 - y1), y1 + (least(t, s1 + seg_m) - s1) / seg_m * (y2 - y1)]) AS y FROM ga JOIN s ON traj_id = arc_id AND seg_m > 0 AND s1 < t AND s1 + seg_m > f),
    sv AS (SELECT arc_id, 2 * i + 1 AS o, unnest([0, 1, 2]) AS i, unnest([a, a + 4, a + 9]) AS x, unnest([-1e0 - i, -2e0 - i, -1e0 - i]) AS y FROM sp), al AS (SELECT * FROM gv UNION ALL SELECT * FROM sv),
    dd AS (SELECT *, coalesce(abs(x - lag(x) OVER w) <= 1e-9 AND abs(y - lag(y) OVER w) <= 1e-9, false) AS same FROM al WINDOW w AS (PARTITION BY arc_id ORDER BY o, i))
    SELECT arc_id, row_number() OVER (PARTITION BY arc_id ORDER BY o, i) AS k, round(x, 6) AS x, round(y, 6) AS y, CASE WHEN arc_id IN (SELECT arc_id FROM sp) THEN 'support_and_arc' ELSE 'arc' END AS how FROM dd WHERE NOT same""",
    ("v_traj",),
)
def fused_line(spark, d):
    """Trajectories as arcs, each with up to three support lines beside it, of which every other one comes backwards."""
    arc_lines = zones.segments(v.traj(spark, d), ["traj_id"]).withColumnRenamed("traj_id", "arc_id")
    arcs = network.cut(arc_lines.groupBy("arc_id").agg(F.max(F.col("s1") + F.col("seg_m")).alias("length_m")))
    spans = arcs.withColumn("i", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))).withColumns({"a": 20.0 * F.col("i") + 5, "b": F.least(20.0 * F.col("i") + 15, F.col("length_m"))}).where("a < length_m - 1e-6")
    odd = F.col("i") % 2 == 1
    pieces = spans.select("arc_id", F.col("i").cast("long").alias("piece_id"), F.when(odd, F.col("b")).otherwise(F.col("a")).alias("start_s"), F.when(odd, F.col("a")).otherwise(F.col("b")).alias("end_s"))
    spot = lambda k, dx, dy: F.struct(F.when(odd, 2 - k).otherwise(k).alias("seq"), (F.col("a") + dx).alias("x"), (-F.col("i") + dy).alias("y"))
    drawn = spans.select("arc_id", F.col("i").cast("long").alias("piece_id"), F.inline(F.array(spot(0, 0.0, -1.0), spot(1, 4.0, -2.0), spot(2, 9.0, -1.0))))
    lines = zones.segments(drawn, ["arc_id", "piece_id"])
    return rounded(E.fused_line(pieces, lines, arcs, arc_lines).withColumn("k", F.col("k").cast("long")))


# Anchors of every eleventh node have failed, those of every seventh have no position. The SQL goes through the
# qualifying edges one by one, with the used nodes in a list.
def _apart(p: str, q: str, i: int) -> str:
    t = f"greatest(0e0, least(1e0, (({p}.x{i} - {q}.x1) * ({q}.x2 - {q}.x1) + ({p}.y{i} - {q}.y1) * ({q}.y2 - {q}.y1)) / (({q}.x2 - {q}.x1) ** 2 + ({q}.y2 - {q}.y1) ** 2)))"
    return f"sqrt(({p}.x{i} - {q}.x1 - {t} * ({q}.x2 - {q}.x1)) ** 2 + ({p}.y{i} - {q}.y1 - {t} * ({q}.y2 - {q}.y1)) ** 2)"


def _parted(p: str, q: str) -> str:
    """Whether the ends of line p lie on different sides of line q."""
    side = lambda i: f"(({q}.x2 - {q}.x1) * ({p}.y{i} - {q}.y1) - ({q}.y2 - {q}.y1) * ({p}.x{i} - {q}.x1))"
    return f"{side(1)} * {side(2)} <= 0 AND {side(1)} <> {side(2)}"


MERGE = f"""{CHAIN}, ed AS (SELECT src, dst, min(length_m) AS dist_m FROM ce WHERE src <> dst GROUP BY ALL), {OFFSET},
h0 AS (SELECT n.*, offset_m, node_id % 3 * 8e0 + 10 AS half FROM v_nodes n JOIN mo USING (node_id)),
li AS (SELECT node_id, (kind & 16) <> 0 AS diverge, (kind & 8) <> 0 AS merge, node_id % 11 = 0 AS failed, offset_m, CASE WHEN node_id % 7 <> 0 THEN offset_m + node_id % 5 END AS at_s,
  x - half AS x1, y - half / 4 * (1 - 2 * (node_id % 2)) AS y1, x + half AS x2, y + half / 4 * (1 - 2 * (node_id % 2)) AS y2, round(sqrt((2 * half) ** 2 + (half / 2) ** 2), 9) AS size FROM h0),
fr AS (SELECT dst, src FROM ed QUALIFY row_number() OVER (PARTITION BY dst ORDER BY dist_m, src) = 1),
qu AS (SELECT component, s.node_id AS src, d.node_id AS dst, dist_m, CASE WHEN s.size >= d.size THEN s.node_id ELSE d.node_id END AS keeper, (s.at_s + d.at_s) / 2 AS merged_s, abs(s.at_s - d.at_s) AS apart_m,
  CASE WHEN {_parted("s", "d")} AND {_parted("d", "s")} THEN 0e0 ELSE round(least({_apart("s", "d", 1)}, {_apart("s", "d", 2)}, {_apart("d", "s", 1)}, {_apart("d", "s", 2)}), 9) END AS gap_m
  FROM ed JOIN fr USING (src, dst) JOIN li s ON s.node_id = src JOIN li d ON d.node_id = dst JOIN lab ON lab.node_id = src WHERE s.diverge AND d.merge AND NOT s.failed AND NOT d.failed AND s.offset_m < d.offset_m - 1e-6),
o AS (SELECT *, row_number() OVER (ORDER BY dist_m, src, dst) AS i FROM qu WHERE gap_m <= 1),
pk AS (SELECT CAST(0 AS BIGINT) AS i, CAST([] AS BIGINT[]) AS used, false AS taken
  UNION ALL SELECT o.i, CASE WHEN list_has_any(used, [src, dst]) THEN used ELSE list_concat(used, [src, dst]) END, NOT list_has_any(used, [src, dst]) FROM pk JOIN o ON o.i = pk.i + 1)
SELECT component, src, dst, keeper, CASE WHEN gap_m = 0 THEN 'geom_intersects' ELSE 'geom_near_tol' END AS how, round(gap_m, 6) AS gap_m, round(merged_s, 6) AS merged_s, round(apart_m, 6) AS apart_m FROM o JOIN pk USING (i) WHERE taken"""


@query(MERGE, RN)
def chain_line_merge(spark, d):
    roads, nodes = v.roads(spark, d), v.nodes(spark, d)
    edges = network.cut(scalars.chain_edges_of(roads).groupBy("src", "dst").agg(F.min("length_m").alias("dist_m")).where("src <> dst"))
    offsets = network.cut(network.chain_offsets(edges))
    half = F.col("node_id") % 3 * 8 + 10
    lean = half / 4 * (1 - 2 * (F.col("node_id") % 2))
    lines = nodes.join(offsets, "node_id").select(
        "node_id", scalars.has_kind(F.col("kind"), scalars.DIVERGE).alias("diverge"), scalars.has_kind(F.col("kind"), scalars.MERGE).alias("merge"), "offset_m",
        (F.col("node_id") % 11 == 0).alias("failed"), F.when(F.col("node_id") % 7 != 0, F.col("offset_m") + F.col("node_id") % 5).alias("at_s"),
        (F.col("x") - half).alias("x1"), (F.col("y") - lean).alias("y1"), (F.col("x") + half).alias("x2"), (F.col("y") + lean).alias("y2"),
    )
    # An edge from a cycle that no source reaches has no offset, but its source may be the nearest predecessor.
    return rounded(E.chain_line_merge(edges.join(offsets.select(F.col("node_id").alias("src"), "component"), "src", "left"), lines))
