"""Choices over intervals, supports, stations and chains, on the driver's tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import assembly as S
from ..operators import network, series, zones
from ..sources import views as v
from .cell_queries import PT, SEG_FREE, T
from .network_queries import CROSS, LINE, PAIRS, TX, _events
from .registry import query, rounded

R = ("v_roads",)
IV = "iv AS (SELECT l_orderkey % 500 AS line_id, CASE WHEN l_orderkey % 2 = 0 THEN 1 ELSE -1 END AS sign, l_suppkey * 1e0 + l_linenumber * 1e-3 + l_partkey * 1e-6 AS start_s, l_suppkey + l_quantity + l_partkey * 1e-6 AS end_s FROM lineitem)"


def _intervals(spark, d):
    rows = spark.read.parquet(f"{d}/lineitem.parquet")
    return rows.selectExpr("l_orderkey % 500 AS line_id", "CASE WHEN l_orderkey % 2 = 0 THEN 1 ELSE -1 END AS sign", "l_suppkey * 1e0D + l_linenumber * 1e-3D + l_partkey * 1e-6D AS start_s", "l_suppkey + l_quantity + l_partkey * 1e-6D AS end_s")


RANKED = f"{IV}, rk AS (SELECT *, row_number() OVER (PARTITION BY line_id ORDER BY CASE WHEN sign < 0 THEN -end_s ELSE start_s END, start_s, end_s) AS rank FROM iv)"


@query(f"WITH {RANKED} SELECT line_id, start_s, end_s, rank FROM rk")
def interval_rank_on_line(spark, d):
    return S.interval_rank_on_line(_intervals(spark, d), ["line_id"], "sign").select("line_id", "start_s", "end_s", "rank")


@query(f"WITH {RANKED}, w AS (SELECT DISTINCT line_id, CAST(line_id % 6 AS INTEGER) AS wr, line_id % 90 * 1e0 AS place FROM iv), t AS (SELECT rk.*, place, CASE WHEN rank = wr THEN 0 WHEN start_s <= place AND place <= end_s THEN 1 ELSE 2 END AS tier FROM w JOIN rk USING (line_id)) SELECT line_id, place AS target, rank, tier FROM t QUALIFY row_number() OVER (PARTITION BY line_id ORDER BY tier, CASE WHEN tier = 2 THEN abs((start_s + end_s) / 2 - place) ELSE 0 END, rank) = 1")
def interval_choose(spark, d):
    ranked = S.interval_rank_on_line(_intervals(spark, d), ["line_id"], "sign")
    wanted = ranked.selectExpr("line_id", "cast(line_id % 6 AS int) AS rank", "line_id % 90 * 1e0D AS at").distinct()
    return S.interval_choose(ranked, wanted, ["line_id"]).select("line_id", F.col("at").alias("target"), "rank", "tier")


@query(f"{PAIRS}, o AS (SELECT pr.traj_id, src, dst, list_sort(list(DISTINCT node_id)) AS l FROM pr JOIN ev USING (traj_id) WHERE node_id <> src AND node_id <> dst GROUP BY ALL) SELECT traj_id, src, dst, array_to_string(l, ',') AS others FROM o", TX)
def other_xsec_hits(spark, d):
    events = _events(spark, d)
    got = S.other_xsec_hits(events, zones.traj_pair_candidates(events, LINE).select("traj_id", "src", "dst"))
    return got.select("traj_id", "src", "dst", F.array_join(F.transform("others", lambda x: x.cast("string")), ",").alias("others"))


BR = "br AS (SELECT snode AS node_id, road_id AS branch, road_id * 37 % 360 * 1e0 AS angle, length_m FROM v_roads UNION ALL SELECT enode, road_id, road_id * 53 % 360 * 1e0, length_m FROM v_roads)"


@query(f"{BR}, p AS (SELECT x.node_id, x.branch AS a, y.branch AS b, x.length_m + y.length_m AS m, abs((y.angle - x.angle + 540) % 360 - 180) AS turn FROM br x JOIN br y ON x.node_id = y.node_id AND x.branch < y.branch) SELECT node_id, a, b, turn FROM p QUALIFY row_number() OVER (PARTITION BY node_id ORDER BY turn DESC, m DESC, a, b) = 1", R)
def branch_pair_max_angle(spark, d):
    rows = v.roads(spark, d)
    out = rows.selectExpr("snode AS node_id", "road_id AS branch", "road_id * 37 % 360 * 1e0D AS angle", "length_m")
    return S.branch_pair_max_angle(out.union(rows.selectExpr("enode", "road_id", "road_id * 53 % 360 * 1e0D", "length_m")))


@query("g AS (SELECT patch_id, avg(z) < 10.71e0 AS a, max(z) < 12 AS b, count(*) > 1240 AS c FROM v_traj GROUP BY patch_id) SELECT patch_id, a AS traj_ok, b AS ground_ok, c AS xsec_ok, a AND b AND c AS overall_pass FROM g", T)
def quality_gate_compose(spark, d):
    traj = v.traj(spark, d).groupBy("patch_id")
    gate = lambda e: traj.agg(e.alias("passed"))
    return S.quality_gate_compose(traj=gate(F.avg("z") < 10.71), ground=gate(F.max("z") < 12), xsec=gate(F.count("*") > 1240))


@query("SELECT patch_id, count(DISTINCT floor(x / 7e0)) / 58e0 AS occupancy FROM v_traj WHERE x >= 0 AND x < 400 GROUP BY patch_id", T)
def along_occupancy(spark, d):
    return S.along_occupancy(v.traj(spark, d), ["patch_id"], "x", 400.0, 7.0)


@query(f"{PAIRS}, q AS (SELECT DISTINCT snode % 20 + 1 AS src, enode % 20 + 1 AS dst FROM v_roads), c AS (SELECT src, dst, count(*) AS n FROM pr GROUP BY ALL), l AS (SELECT src, dst, count(*) AS n FROM pr WHERE seq_to - seq_from < 3 GROUP BY ALL) SELECT src, dst, coalesce(c.n, 0) AS n_candidate, coalesce(l.n, 0) AS n_short, CASE WHEN coalesce(c.n, 0) = 0 THEN 'candidate' WHEN coalesce(l.n, 0) = 0 THEN 'short' END AS lost_at FROM q LEFT JOIN c USING (src, dst) LEFT JOIN l USING (src, dst)", ("v_traj", "v_xsecs", "v_roads"))
def pair_trace(spark, d):
    pairs = v.roads(spark, d).selectExpr("snode % 20 + 1 AS src", "enode % 20 + 1 AS dst").distinct()
    got = zones.traj_pair_candidates(_events(spark, d), LINE)
    return S.pair_trace(pairs, candidate=got, short=got.where("seq_to - seq_from < 3"))


@query("o AS (SELECT DISTINCT road_id AS key, 'p' || road_id % 4 AS profile FROM v_roads WHERE road_id % 3 = 0 UNION ALL SELECT road_id, 'p1' FROM v_roads WHERE road_id % 21 = 0), k AS (SELECT road_id AS key FROM v_roads WHERE road_id % 2 = 0), n AS (SELECT *, count(*) OVER (PARTITION BY key) AS n, key IN (SELECT key FROM k) AS known FROM o), r AS (SELECT key, profile, CASE WHEN NOT known THEN 'unknown_key' WHEN profile NOT IN ('p0', 'p1') THEN 'unknown_profile' WHEN n > 1 THEN 'repeated_key' END AS reason FROM n) SELECT * FROM r WHERE reason IS NOT NULL", R)
def override_validate(spark, d):
    roads = v.roads(spark, d)
    overrides = roads.where("road_id % 3 = 0").selectExpr("road_id AS key", "concat('p', road_id % 4) AS profile").distinct().union(roads.where("road_id % 21 = 0").selectExpr("road_id", "'p1'"))
    return S.override_validate(overrides, roads.where("road_id % 2 = 0").selectExpr("road_id AS key"), ["p0", "p1"])


@query("e AS (SELECT snode AS node_id, road_id, length_m FROM v_roads UNION ALL SELECT enode, road_id, length_m FROM v_roads), b AS (SELECT * FROM e WHERE node_id NOT IN (SELECT node_id FROM v_xsecs)) SELECT node_id, CAST(NULL AS BIGINT) AS road_id, 'input' AS source FROM v_xsecs UNION ALL SELECT node_id, road_id, 'pseudo' FROM b QUALIFY row_number() OVER (PARTITION BY node_id ORDER BY length_m DESC, road_id) = 1", ("v_roads", "v_xsecs"))
def pseudo_xsec_augment(spark, d):
    return S.pseudo_xsec_augment(v.xsecs(spark, d), v.roads(spark, d))


@query("p AS (SELECT snode AS node_id, enode % 50 AS xsec_id, (road_id % 40) / 10e0 AS dist FROM v_roads) SELECT node_id, min(xsec_id) AS xsec_id FROM p WHERE dist <= 1.5e0 GROUP BY node_id HAVING count(DISTINCT xsec_id) = 1", R)
def xsec_alias_map(spark, d):
    return S.xsec_alias_map(v.roads(spark, d).selectExpr("snode AS node_id", "enode % 50 AS xsec_id", "(road_id % 40) / 10e0D AS dist"))


@query("c AS (SELECT snode % 100 AS xsec_id, enode AS node_id, road_id % 11 = 0 AS explicit, road_id % 3 = 0 AS in_prior, road_id % 4 = 0 AS has_kind, road_id % 5 = 0 AS own, road_id % 6 AS place FROM v_roads), s AS (SELECT *, CASE WHEN in_prior THEN 4 ELSE 0 END + CASE WHEN has_kind THEN 3 ELSE 0 END + CASE WHEN own THEN 2 ELSE 0 END + CASE WHEN place = 0 THEN 1 ELSE 0 END AS score FROM c) SELECT xsec_id, node_id, score FROM s QUALIFY row_number() OVER (PARTITION BY xsec_id ORDER BY NOT explicit, -score, place, node_id) = 1", R)
def xsec_id_canonicalize(spark, d):
    rows = v.roads(spark, d).selectExpr("snode % 100 AS xsec_id", "enode AS node_id", "road_id % 11 = 0 AS explicit", "road_id % 3 = 0 AS in_prior", "road_id % 4 = 0 AS has_kind", "road_id % 5 = 0 AS own", "road_id % 6 AS place")
    return S.xsec_id_canonicalize(rows)


# Each trajectory is a candidate for the lines of the next two of its patch.
FITS = """sg AS (SELECT traj_id AS id, seq, x AS x1, y AS y1, lead(x) OVER w AS x2, lead(y) OVER w AS y2 FROM v_traj WINDOW w AS (PARTITION BY traj_id ORDER BY seq)),
sl AS (SELECT *, sqrt((x2 - x1) ** 2 + (y2 - y1) ** 2) AS m, coalesce(sum(sqrt((x2 - x1) ** 2 + (y2 - y1) ** 2)) OVER (PARTITION BY id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s1 FROM sg WHERE x2 IS NOT NULL),
vx AS (SELECT traj_id AS id, seq, x, y FROM v_traj WHERE traj_id IN (SELECT id FROM sl)), pr AS (SELECT a.id AS cand_id, b.id AS arc_id FROM (SELECT DISTINCT id FROM sl) a JOIN (SELECT DISTINCT id FROM sl) b ON b.id IN (a.id + 8, a.id + 16)),
far AS (SELECT p, q, max(d) AS d FROM (SELECT k.p, k.q, v.seq, min(sqrt((v.x - sl.x1 - greatest(0e0, least(1e0, ((v.x - sl.x1) * (sl.x2 - sl.x1) + (v.y - sl.y1) * (sl.y2 - sl.y1)) / (m * m))) * (sl.x2 - sl.x1)) ** 2
    + (v.y - sl.y1 - greatest(0e0, least(1e0, ((v.x - sl.x1) * (sl.x2 - sl.x1) + (v.y - sl.y1) * (sl.y2 - sl.y1)) / (m * m))) * (sl.y2 - sl.y1)) ** 2)) AS d
  FROM (SELECT cand_id AS p, arc_id AS q FROM pr UNION ALL SELECT arc_id, cand_id FROM pr) k JOIN vx v ON v.id = k.p JOIN sl ON sl.id = k.q GROUP BY ALL) GROUP BY ALL),
tl AS (SELECT id, sum(m) AS m FROM sl GROUP BY id), sh AS (SELECT tl.id, tl.m, min_by(x1, seq) AS ax, min_by(y1, seq) AS ay, max_by(x2, seq) AS bx, max_by(y2, seq) AS b_y,
    min(CASE WHEN tl.m / 2 >= s1 AND tl.m / 2 < s1 + sl.m THEN x1 + (tl.m / 2 - s1) / sl.m * (x2 - x1) END) AS cx, min(CASE WHEN tl.m / 2 >= s1 AND tl.m / 2 < s1 + sl.m THEN y1 + (tl.m / 2 - s1) / sl.m * (y2 - y1) END) AS cy FROM tl JOIN sl USING (id) GROUP BY ALL),
ft AS (SELECT cand_id, arc_id, greatest(f.d, g.d) AS line_m, sqrt((a.ax - b.ax) ** 2 + (a.ay - b.ay) ** 2) + sqrt((a.bx - b.bx) ** 2 + (a.b_y - b.b_y) ** 2) AS anchor_m, sqrt((a.cx - b.cx) ** 2 + (a.cy - b.cy) ** 2) AS middle_m, abs(a.m - b.m) AS length_gap_m
  FROM pr JOIN far f ON f.p = cand_id AND f.q = arc_id JOIN far g ON g.p = arc_id AND g.q = cand_id JOIN sh a ON a.id = cand_id JOIN sh b ON b.id = arc_id)"""


def _fits(spark, d):
    from ..operators.zones import segments

    lines = segments(v.traj(spark, d), ["traj_id"])
    ids = lines.select("traj_id").distinct()
    pairs = ids.select(F.col("traj_id").alias("cand_id"), F.explode(F.array(F.col("traj_id") + 8, F.col("traj_id") + 16)).alias("arc_id")).join(ids.withColumnRenamed("traj_id", "arc_id"), "arc_id", "left_semi")
    return S.arc_fit(lines.withColumnRenamed("traj_id", "cand_id"), lines.withColumnRenamed("traj_id", "arc_id"), pairs)


@query(f"{FITS} SELECT cand_id, arc_id, round(line_m, 5) AS line_m, round(anchor_m, 5) AS anchor_m, round(middle_m, 5) AS middle_m, round(length_gap_m, 5) AS length_gap_m FROM ft", T)
def arc_fit(spark, d):
    return rounded(_fits(spark, d), 5)


@query(
    f"""{FITS}, ro AS (SELECT cand_id, arc_id, round(line_m, 9) AS line_m, round(anchor_m, 9) AS anchor_m, round(middle_m, 9) AS middle_m, round(length_gap_m, 9) AS g FROM ft),
    rk AS (SELECT *, row_number() OVER w AS r, count(*) OVER (PARTITION BY cand_id) AS n_arcs, lead(line_m + anchor_m + middle_m) OVER w - (line_m + anchor_m + middle_m) AS gap_m FROM ro WINDOW w AS (PARTITION BY cand_id ORDER BY line_m, anchor_m, middle_m, g, arc_id))
    SELECT cand_id, arc_id, n_arcs, CASE WHEN n_arcs = 1 THEN 'unique_direct_arc' ELSE 'same_pair_fit' END AS mode, CASE WHEN n_arcs = 1 THEN 0e0 ELSE round(line_m, 5) END AS line_m, CASE WHEN n_arcs = 1 THEN 0e0 ELSE round(anchor_m, 5) END AS anchor_m,
      CASE WHEN n_arcs = 1 THEN 0e0 ELSE round(middle_m, 5) END AS middle_m, round(gap_m, 5) AS gap_m FROM rk WHERE r = 1""",
    T,
)
def arc_assign(spark, d):
    return rounded(S.arc_assign(_fits(spark, d)), 5)


@query("SELECT road_id AS arc_id, CASE WHEN road_id % 3 > 0 THEN 's' || road_id % 3 END AS support_status, CASE WHEN road_id % 5 = 0 THEN 'built' END AS build_status FROM v_roads", R)
def arc_registry(spark, d):
    arcs = v.roads(spark, d).selectExpr("road_id AS arc_id")
    return S.arc_registry(arcs, support=arcs.where("arc_id % 3 > 0").selectExpr("arc_id", "concat('s', arc_id % 3) AS status"), build=arcs.where("arc_id % 5 = 0").selectExpr("arc_id", "'built' AS status"))


# Anchors along chains of nodes with rising ids, so that a pass in the order of ids settles them.
ORDER = """ed AS (SELECT c_custkey AS src, c_custkey + 1 AS dst FROM customer WHERE c_custkey % 9 <> 8), po AS (SELECT c_custkey AS node_id, c_custkey * 7919 % 23 AS s, c_custkey % 2 = 0 AS may_equal FROM customer),
wk AS (SELECT node_id, s, false AS failed FROM po WHERE node_id % 9 = 0 UNION ALL SELECT po.node_id, po.s, NOT wk.failed AND (po.s < wk.s OR (po.s = wk.s AND NOT may_equal)) FROM wk JOIN ed ON src = wk.node_id JOIN po ON po.node_id = dst)
SELECT node_id, failed FROM wk"""


@query(f"WITH RECURSIVE {ORDER}")
def chain_order_check(spark, d):
    nodes = spark.read.parquet(f"{d}/customer.parquet").select(F.col("c_custkey").alias("node_id"))
    positions = nodes.selectExpr("node_id", "node_id * 7919 % 23 AS s", "node_id % 2 = 0 AS may_equal")
    edges = nodes.where("node_id % 9 <> 8").selectExpr("node_id AS src", "node_id + 1 AS dst")
    return S.chain_order_check(edges, positions).select("node_id", "failed")


ST = "st AS (SELECT patch_id, CAST(floor(x / 10e0) AS BIGINT) AS station, y, 1 + (seq % 3) * 1e0 AS w FROM v_traj)"


@query(
    f"""{ST}, m0 AS (SELECT patch_id, station, sum(w * y) / sum(w) AS c FROM st GROUP BY ALL),
    d1 AS (SELECT st.*, c, round(abs(y - c), 9) AS d FROM st JOIN m0 USING (patch_id, station)), q1 AS (SELECT patch_id, station, greatest(median(d), 1e-3) AS m FROM d1 GROUP BY ALL), m1 AS (SELECT patch_id, station, sum(w / (1 + (d / m) * (d / m)) * y) / sum(w / (1 + (d / m) * (d / m))) AS c FROM d1 JOIN q1 USING (patch_id, station) GROUP BY ALL),
    d2 AS (SELECT st.*, c, round(abs(y - c), 9) AS d FROM st JOIN m1 USING (patch_id, station)), q2 AS (SELECT patch_id, station, greatest(median(d), 1e-3) AS m FROM d2 GROUP BY ALL)
    SELECT patch_id, station, round(sum(w / (1 + (d / m) * (d / m)) * y) / sum(w / (1 + (d / m) * (d / m))), 5) AS centre, round(max(m), 5) AS dispersion, count(*) AS n FROM d2 JOIN q2 USING (patch_id, station) GROUP BY ALL""",
    T,
)
def station_robust_center(spark, d):
    rows = v.traj(spark, d).selectExpr("patch_id", "cast(floor(x / 10e0D) AS bigint) AS station", "y", "1 + (seq % 3) * 1e0D AS w")
    return rounded(S.station_robust_center(rows, ["patch_id", "station"], "y", "w"), 5)


@query("s AS (SELECT patch_id, CAST(floor(x / 10e0) AS BIGINT) AS station, quantile_cont(y, 0.05e0) AS lo, quantile_cont(y, 0.95e0) AS hi, count(*) AS n FROM v_points WHERE cls = 2 GROUP BY ALL) SELECT patch_id, station, round((lo + hi) / 2, 6) AS centre, round(hi - lo, 6) AS width, n FROM s WHERE n >= 8", PT)
def surface_center_offset(spark, d):
    rows = v.points(spark, d).where("cls = 2").selectExpr("patch_id", "cast(floor(x / 10e0D) AS bigint) AS station", "y")
    return rounded(S.surface_center_offset(rows, ["patch_id", "station"], "y"))


@query("b AS (SELECT patch_id, CAST(floor(x / 10e0) AS BIGINT) AS station, y - 30e0 AS o, point_id % 17 AS q FROM v_points), l AS (SELECT patch_id, station, o AS l FROM b WHERE o > 0 QUALIFY row_number() OVER (PARTITION BY patch_id, station ORDER BY q DESC, abs(o), o) = 1), r AS (SELECT patch_id, station, o AS r FROM b WHERE o < 0 QUALIFY row_number() OVER (PARTITION BY patch_id, station ORDER BY q DESC, abs(o), o) = 1) SELECT patch_id, station, round(l - r, 6) AS apart, round((l + r) / 2, 6) AS centre FROM l JOIN r USING (patch_id, station) WHERE l - r BETWEEN 1.5 AND 18", PT)
def lane_center_hint(spark, d):
    rows = v.points(spark, d).selectExpr("patch_id", "cast(floor(x / 10e0D) AS bigint) AS station", "y - 30e0D AS offset", "point_id % 17 AS quality")
    return rounded(S.lane_center_hint(rows, ["patch_id", "station"]).select("patch_id", "station", "apart", "centre"))


@query(
    """s AS (SELECT traj_id, x AS s, 8 + (z - 10) AS width, seq % 13 = 0 AS gore FROM v_traj), b AS (SELECT traj_id, median(CASE WHEN s >= 50 THEN width END) AS base FROM s GROUP BY 1),
    w AS (SELECT *, max(width) OVER q - min(width) OVER q AS sp, bool_or(gore) OVER q AS g, count(*) OVER q AS n FROM s WINDOW q AS (PARTITION BY traj_id ORDER BY s RANGE BETWEEN CURRENT ROW AND 10e0 FOLLOWING)),
    r AS (SELECT traj_id, min(CASE WHEN n >= 3 AND NOT g AND sp <= greatest(1e0, 0.1e0 * coalesce(base, 0)) THEN s END) AS f, min_by(s, (abs(s - 50), s)) AS m FROM w JOIN b USING (traj_id) GROUP BY 1) SELECT traj_id, coalesce(f, m) AS s, f IS NOT NULL AS stable FROM r""",
    T,
)
def stable_section(spark, d):
    rows = v.traj(spark, d).selectExpr("traj_id", "x AS s", "8 + (z - 10) AS width", "seq % 13 = 0 AS gore")
    return S.stable_section(rows, ["traj_id"])


ROUND = "{n} AS (SELECT traj_id, station, coalesce(0.5e0 * y + 0.5e0 * (lag(y) OVER w + lead(y) OVER w) / 2, y) AS y FROM {p} WINDOW w AS (PARTITION BY traj_id ORDER BY station))"


@query("r0 AS (SELECT traj_id, seq AS station, y FROM v_traj), " + ", ".join(ROUND.format(n=f"r{i + 1}", p=f"r{i}") for i in range(3)) + " SELECT traj_id, station, round(y, 9) AS y FROM r3", T)
def spine_smooth(spark, d):
    return rounded(S.spine_smooth(v.traj(spark, d).selectExpr("traj_id", "seq AS station", "y"), ["traj_id"], "y"), 9)


@query("SELECT snode AS arc_id, road_id AS support, n FROM (SELECT snode, road_id, count(*) OVER (PARTITION BY snode) AS n, row_number() OVER (PARTITION BY snode ORDER BY direction, -length_m, road_id) AS r FROM v_roads) WHERE r = 1", R)
def support_select(spark, d):
    rows = v.roads(spark, d).withColumnsRenamed({"snode": "arc_id", "road_id": "support"})
    return S.support_select(rows, ["arc_id"], [F.col("direction"), -F.col("length_m"), F.col("support")], ["support"])


@query()
def support_deconflict(spark, d):
    rows = v.roads(spark, d).selectExpr("floor(snode / 20) AS src", "enode % 3 AS dst", "road_id % 4 AS arc_id", "road_id % 7 AS support", "road_id % 5 AS rank", "length_m AS dist", "length_m % 7 / 7 AS coverage")
    return S.support_deconflict(rows, 3)


@query()
def segment_cluster(spark, d):
    at = lambda c: F.struct((F.pmod(F.col(c), F.lit(40)) * 25.0).alias("x"), (F.floor(F.col(c) / 40) * 25.0).alias("y"))
    rows = v.roads(spark, d).select(
        F.floor(F.col("snode") / 20).alias("src"), (F.col("enode") % 3).alias("dst"), F.col("road_id").alias("segment_id"), ((F.col("road_id") * 37 % 400) / 10.0).alias("offset"),
        F.when(F.col("road_id") % 4 == 0, "prior").otherwise("traj").alias("source"), F.sequence(F.col("road_id") % 3, F.col("road_id") % 5 + 2).alias("supports"), F.array(at("snode"), at("enode")).alias("line"),
    )
    return S.segment_cluster(rows, ["src", "dst"])


STITCH = f"""{SEG_FREE}, la AS (SELECT traj_id, max(seq) AS last FROM v_traj GROUP BY 1), tl AS (SELECT h.* FROM h JOIN la ON h.traj_id = la.traj_id AND h.seq = la.last WHERE hx IS NOT NULL),
cd AS (SELECT tl.patch_id, tl.traj_id, h.traj_id AS p_traj_id, h.seq AS p_seq, (h.x - tl.x) * (h.x - tl.x) + (h.y - tl.y) * (h.y - tl.y) AS d2, (h.x - tl.x) * tl.hx + (h.y - tl.y) * tl.hy AS ahead, tl.hx * h.hx + tl.hy * h.hy AS co FROM tl JOIN h ON h.patch_id = tl.patch_id AND h.traj_id <> tl.traj_id AND h.x BETWEEN tl.x - 10 AND tl.x + 10 AND h.y BETWEEN tl.y - 10 AND tl.y + 10),
lv AS (SELECT *, CASE WHEN d2 <= 4 THEN 0 WHEN d2 <= 25 THEN 1 ELSE 2 END AS level FROM cd WHERE d2 <= 100 AND ahead > 0 AND co >= cos(radians(35e0))), ml AS (SELECT *, min(level) OVER (PARTITION BY traj_id) AS m FROM lv)
SELECT patch_id, traj_id, p_traj_id, p_seq, level, rank FROM (SELECT *, row_number() OVER (PARTITION BY traj_id ORDER BY d2, p_traj_id, p_seq) AS rank FROM ml WHERE level = m) WHERE rank <= 3"""


@query(STITCH, T)
def traj_stitch_candidates(spark, d):
    rows = series.heading(v.traj(spark, d)).where("hx IS NOT NULL")
    last = v.traj(spark, d).groupBy("traj_id").agg(F.max("seq").alias("seq"))
    return S.traj_stitch_candidates(rows.join(last, ["traj_id", "seq"]), rows)


TAILS = f"""{SEG_FREE}, w0 AS (SELECT traj_id, seq, coalesce(sqrt((lead(x) OVER w - x) ** 2 + (lead(y) OVER w - y) ** 2), 0) AS m FROM v_traj WINDOW w AS (PARTITION BY traj_id ORDER BY seq)), lf AS (SELECT traj_id, seq, sum(m) OVER (PARTITION BY traj_id ORDER BY seq ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS left_m FROM w0),
hh AS (SELECT h.*, left_m FROM h JOIN lf USING (traj_id, seq) WHERE hx IS NOT NULL),
cd AS (SELECT a.patch_id, a.traj_id, a.seq, b.traj_id AS p_traj_id, b.seq AS p_seq, round(sqrt((b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y)), 9) AS d, (b.x - a.x) * a.hx + (b.y - a.y) * a.hy AS ahead, round(degrees(atan2(abs(a.hx * b.hy - a.hy * b.hx), a.hx * b.hx + a.hy * b.hy)), 6) AS turn
  FROM hh a JOIN hh b ON b.patch_id = a.patch_id AND b.traj_id <> a.traj_id AND b.x BETWEEN a.x - 10 AND a.x + 10 AND b.y BETWEEN a.y - 10 AND a.y + 10 WHERE a.left_m <= 30 + 1e-6 AND b.left_m >= 5),
lv AS (SELECT *, CASE WHEN d <= 2 THEN 0 WHEN d <= 5 THEN 1 ELSE 2 END AS level FROM cd WHERE d <= 10 AND ahead > 0 AND turn <= 35), ml AS (SELECT *, min(level) OVER (PARTITION BY traj_id, seq) AS m FROM lv)
SELECT patch_id, traj_id, seq, p_traj_id, p_seq, level, rank, d, turn FROM (SELECT *, row_number() OVER (PARTITION BY traj_id, seq ORDER BY d, turn, p_traj_id, p_seq) AS rank FROM ml WHERE level = m) WHERE rank <= 3"""


@query(TAILS, T)
def tail_stitches(spark, d):
    traj = v.traj(spark, d)
    w = Window.partitionBy("traj_id").orderBy("seq")
    step = F.coalesce(F.sqrt((F.lead("x").over(w) - F.col("x")) ** 2 + (F.lead("y").over(w) - F.col("y")) ** 2), F.lit(0.0))
    rows = series.heading(traj.withColumn("m", step)).withColumn("left_m", F.sum("m").over(w.rowsBetween(0, Window.unboundedFollowing)))
    return S.tail_stitches(rows)


# Arcs are the lines of every seventh trajectory, four groups of them share a source; the others are support pieces.
MARGIN = FITS.replace("pr AS (SELECT a.id AS cand_id, b.id AS arc_id FROM (SELECT DISTINCT id FROM sl) a JOIN (SELECT DISTINCT id FROM sl) b ON b.id IN (a.id + 8, a.id + 16))",
    "own AS (SELECT DISTINCT id AS piece_id, id // 7 % 6 * 7 AS own_arc FROM sl WHERE id % 7 <> 0), pr AS (SELECT piece_id AS cand_id, b.id AS arc_id FROM own JOIN (SELECT DISTINCT id FROM sl WHERE id % 7 = 0) b ON b.id % 4 = own_arc % 4 WHERE own_arc IN (SELECT id FROM sl))")


@query(
    f"""{MARGIN}, g AS (SELECT piece_id, own_arc % 4 AS src, own_arc, min(CASE WHEN arc_id = own_arc THEN round(line_m, 9) END) AS own_m, min(CASE WHEN arc_id <> own_arc THEN round(line_m, 9) END) AS rival_m FROM ft JOIN own ON piece_id = cand_id GROUP BY ALL)
    SELECT piece_id, src, own_arc, round(own_m, 5) AS own_m, round(rival_m, 5) AS rival_m, round(rival_m - own_m, 5) AS margin, coalesce(rival_m - own_m >= 1.5, true) AS preferred FROM g""",
    T,
)
def arc_margins(spark, d):
    lines = network.cut(zones.segments(v.traj(spark, d), ["traj_id"]))
    arc_lines = lines.where("traj_id % 7 = 0").withColumnRenamed("traj_id", "arc_id")
    piece_lines = lines.where("traj_id % 7 <> 0").withColumn("piece_id", F.col("traj_id")).withColumnRenamed("traj_id", "cand_id")
    pieces = piece_lines.select("piece_id").distinct().withColumn("arc_id", F.floor(F.col("piece_id") / 7) % 6 * 7)
    arcs = arc_lines.select("arc_id").distinct().withColumn("src", F.col("arc_id") % 4)
    return rounded(S.arc_margins(pieces, piece_lines, arcs, arc_lines), 5)


@query("d AS (SELECT snode AS piece_id, snode % 5 AS src, snode % 4 AS own_arc, enode % 4 AS arc_id, length_m AS dist FROM v_roads), g AS (SELECT piece_id, src, own_arc, min(CASE WHEN arc_id = own_arc THEN dist END) AS own_m, min(CASE WHEN arc_id <> own_arc THEN dist END) AS rival_m FROM d GROUP BY ALL) SELECT *, rival_m - own_m AS margin, coalesce(rival_m - own_m >= 1.5, true) AS preferred FROM g", R)
def competing_arc_margin(spark, d):
    return S.competing_arc_margin(v.roads(spark, d).selectExpr("snode AS piece_id", "snode % 5 AS src", "snode % 4 AS own_arc", "enode % 4 AS arc_id", "length_m AS dist"))


@query("m AS (SELECT patch_id, 'traj_' || traj_id AS name, max(z) AS value FROM v_traj GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY patch_id ORDER BY value DESC, name) AS r FROM m) SELECT patch_id, string_agg(name || '=' || printf('%.3f', value), chr(10) ORDER BY r) AS text FROM r WHERE r <= 10 GROUP BY patch_id", T)
def summary_bundle(spark, d):
    metrics = v.traj(spark, d).groupBy("patch_id", F.concat(F.lit("traj_"), F.col("traj_id").cast("string")).alias("name")).agg(F.max("z").alias("value"))
    return S.summary_bundle(metrics, ["patch_id"])


@query(f"{CROSS}, b AS (SELECT node_id, count(*) AS n_events, count(DISTINCT traj_id) AS n_traj FROM ev GROUP BY 1) SELECT * FROM b", TX)
def road_metrics(spark, d):
    return _events(spark, d).groupBy("node_id").agg(F.count("*").alias("n_events"), F.count_distinct("traj_id").alias("n_traj"))


GC = """ae AS (SELECT CASE WHEN direction = 3 THEN enode ELSE snode END AS src, CASE WHEN direction = 3 THEN snode ELSE enode END AS dst, road_id AS edge_id, length_m FROM v_roads),
fx AS (SELECT node_id FROM v_nodes WHERE kind = 4), al AS (SELECT src AS node_id FROM ae UNION SELECT dst FROM ae), o AS (SELECT src, count(DISTINCT dst) AS n FROM ae GROUP BY 1), i AS (SELECT dst, count(DISTINCT src) AS n FROM ae GROUP BY 1),
sy AS (SELECT node_id FROM al LEFT JOIN o ON o.src = node_id LEFT JOIN i ON i.dst = node_id WHERE node_id IN (SELECT node_id FROM fx) OR coalesce(o.n, 0) <> 1 OR coalesce(i.n, 0) <> 1),
wk AS (SELECT node_id AS src, node_id AS cur, [node_id] AS nodes, 0e0 AS length_m, false AS stop FROM sy UNION ALL SELECT wk.src, ae.dst, list_append(nodes, ae.dst), wk.length_m + ae.length_m, ae.dst IN (SELECT node_id FROM sy) FROM wk JOIN ae ON ae.src = wk.cur WHERE NOT stop AND (ae.dst IN (SELECT node_id FROM sy) OR NOT list_contains(nodes, ae.dst)))
SELECT src, cur AS dst, len(nodes) AS n_nodes, length_m FROM wk WHERE stop"""


@query(GC, ("v_roads", "v_nodes"))
def graph_compress(spark, d):
    from ..functions.scalars import arc_edges_of

    got = network.graph_compress(arc_edges_of(v.roads(spark, d)), v.nodes(spark, d).where("kind = 4"), by_neighbours=True)
    return got.where("NOT closed").select("src", "dst", F.size("nodes").cast("long").alias("n_nodes"), "length_m")


# Lists by trajectory: the average of five with the edges repeated, twice, then steps of 0.1 at most.
_AVERAGE = "list_transform(range(1, len({0}) + 1), lambda i: ({0}[greatest(1, i - 2)] + {0}[greatest(1, i - 1)] + {0}[i] + {0}[least(len({0}), i + 1)] + {0}[least(len({0}), i + 2)]) / 5)"


@query(
    f"""l AS (SELECT traj_id, list(seq ORDER BY seq) AS q, list(z ORDER BY seq) AS a FROM v_traj GROUP BY traj_id), m AS (SELECT traj_id, q, {_AVERAGE.format('a')} AS b FROM l), n AS (SELECT traj_id, q, {_AVERAGE.format('b')} AS c FROM m),
    o AS (SELECT traj_id, q, list_reduce(list_transform(c, lambda x: [x]), lambda s, x: list_append(s, greatest(s[len(s)] - 0.1e0, least(s[len(s)] + 0.1e0, x[1])))) AS r FROM n)
    SELECT traj_id, unnest(q) AS seq, round(unnest(r), 6) AS z FROM o""",
    T,
)
def offset_smooth(spark, d):
    return rounded(series.offset_smooth(v.traj(spark, d).select("traj_id", "seq", "z"), ["traj_id"], "seq", "z", most_step=0.1))
