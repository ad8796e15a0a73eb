"""Road graphs, crossings, zones and turn movements over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import arcs, movements, network, series, zones
from ..sources import views as v
from .registry import query, rounded

R, N, RN, T, TX = ("v_roads",), ("v_nodes",), ("v_roads", "v_nodes"), ("v_traj",), ("v_traj", "v_xsecs")
ENDS = "e AS (SELECT snode AS node_id, road_id, false AS at_end FROM v_roads UNION ALL SELECT enode, road_id, true FROM v_roads)"


@query(f"{ENDS} SELECT node_id, count(DISTINCT road_id) AS degree FROM e GROUP BY node_id", R)
def node_degree(spark, d):
    return network.node_degree(v.roads(spark, d))


@query("SELECT * FROM (SELECT road_id, NOT EXISTS (SELECT 1 FROM v_nodes WHERE node_id = snode) AS missing_start, NOT EXISTS (SELECT 1 FROM v_nodes WHERE node_id = enode) AS missing_end FROM v_roads) WHERE missing_start OR missing_end", RN)
def missing_endpoint_refs(spark, d):
    return network.missing_endpoint_refs(v.roads(spark, d), v.nodes(spark, d))


@query("SELECT kind, count(*) AS n, count(*) FILTER (kind & 24 <> 0) AS n_match, count(*) - count(DISTINCT node_id) AS n_repeated FROM v_nodes GROUP BY kind", N)
def node_discovery(spark, d):
    return network.node_discovery(v.nodes(spark, d), scalars.MERGE | scalars.DIVERGE)


@query("SELECT node_id, CASE WHEN kind & 8 <> 0 AND kind & 16 <> 0 THEN 'merge_diverge' WHEN kind & 8 <> 0 THEN 'merge' WHEN kind & 16 <> 0 THEN 'diverge' WHEN kind & 4 <> 0 THEN 'cross' ELSE 'unknown' END AS node_type, kind & 65536 <> 0 AS k16 FROM v_nodes", N)
def kind_decode(spark, d):
    return v.nodes(spark, d).select("node_id", scalars.node_type(F.col("kind")).alias("node_type"), scalars.has_kind(F.col("kind"), scalars.K16).alias("k16"))


CHAIN = "ce AS (SELECT CASE WHEN direction = 3 THEN enode ELSE snode END AS src, CASE WHEN direction = 3 THEN snode ELSE enode END AS dst, road_id AS edge_id, length_m FROM v_roads WHERE direction IN (2, 3))"
ARC = "ae AS (SELECT CASE WHEN direction = 3 THEN enode ELSE snode END AS src, CASE WHEN direction = 3 THEN snode ELSE enode END AS dst, road_id AS edge_id, length_m FROM v_roads)"


@query(f"{CHAIN}, {ARC} SELECT 'chain' AS rule, * FROM ce UNION ALL SELECT 'arc', * FROM ae", R)
def directed_edges(spark, d):
    roads = v.roads(spark, d)
    chain = scalars.chain_edges_of(roads).select(F.lit("chain").alias("rule"), "src", "dst", "edge_id", "length_m")
    return chain.union(scalars.arc_edges_of(roads).select(F.lit("arc"), "src", "dst", "edge_id", "length_m"))


@query(f"{ENDS}, j AS (SELECT e.*, direction FROM e JOIN v_roads USING (road_id)) SELECT node_id, road_id, at_end, unnest(CASE WHEN direction IN (0, 1) THEN ['entry', 'exit'] WHEN (direction = 2) = at_end THEN ['entry'] ELSE ['exit'] END) AS side FROM j", R)
def movement_sides(spark, d):
    return scalars.movement_sides(network.ends(v.roads(spark, d))).select("node_id", "road_id", "at_end", "side")


@query(f"{ARC}, o AS (SELECT src AS node_id, count(*) AS n_out FROM ae GROUP BY 1), i AS (SELECT dst AS node_id, count(*) AS n_in FROM ae GROUP BY 1) SELECT node_id, coalesce(n_out, 0) AS n_out, coalesce(n_in, 0) AS n_in, CASE WHEN kind & 16 <> 0 THEN 'diverge' WHEN kind & 8 <> 0 THEN 'merge' WHEN coalesce(n_out, 0) > coalesce(n_in, 0) THEN 'diverge' WHEN coalesce(n_in, 0) > coalesce(n_out, 0) THEN 'merge' ELSE 'unknown' END AS node_type FROM v_nodes LEFT JOIN o USING (node_id) LEFT JOIN i USING (node_id)", RN)
def node_type_infer(spark, d):
    return network.node_type_infer(v.nodes(spark, d), v.roads(spark, d)).select("node_id", "n_out", "n_in", "node_type")


@query("f AS (SELECT DISTINCT o_custkey * 2 AS node_id FROM orders) SELECT node_id, node_id IN (SELECT node_id FROM v_nodes) AS known FROM f", N)
def seed_pick(spark, d):
    focus = spark.read.parquet(f"{d}/orders.parquet").selectExpr("o_custkey * 2 AS node_id").distinct()
    seeds, lost = network.seed_pick(v.nodes(spark, d), focus)
    return seeds.select("node_id", F.lit(True).alias("known")).union(lost.select("node_id", F.lit(False)))


FOLLOW = f"""{CHAIN}, du AS (SELECT snode AS n, road_id FROM v_roads WHERE direction IN (2, 3) UNION ALL SELECT enode, road_id FROM v_roads WHERE direction IN (2, 3)),
deg AS (SELECT n, count(DISTINCT road_id) AS g FROM du GROUP BY n),
w AS (SELECT ce.src AS seed, ce.edge_id AS first_edge, ce.src AS prev, ce.dst AS node, ce.length_m AS dist_m, 0 AS steps FROM ce JOIN v_nodes ON node_id = ce.src AND kind & 24 <> 0
  UNION ALL
  SELECT w.seed, w.first_edge, w.node, ce.dst, w.dist_m + ce.length_m, w.steps + 1 FROM w JOIN deg ON deg.n = w.node AND g = 2 JOIN ce ON ce.src = w.node AND ce.dst <> w.prev
  WHERE w.dist_m <= 75 + 1e-9 AND (SELECT count(*) FROM ce c2 WHERE c2.src = w.node AND c2.dst <> w.prev) = 1 AND w.steps < 255),
z AS (SELECT w.*, g, (SELECT count(*) FROM ce c2 WHERE c2.src = w.node AND c2.dst <> w.prev) AS nxt FROM w LEFT JOIN deg ON deg.n = w.node),
fol AS (SELECT seed, first_edge, node, dist_m, steps, CASE WHEN dist_m > 75 + 1e-9 THEN 'distance_exceed' WHEN g >= 3 THEN 'reached' WHEN coalesce(g, 0) <> 2 THEN 'dead_end_or_isolated' WHEN nxt <> 1 THEN 'deg2_out_not_unique' END AS reason FROM z)"""


@query(f"{FOLLOW} SELECT * FROM fol WHERE reason IS NOT NULL", RN)
def chain_follow(spark, d):
    seeds, _ = network.seed_pick(v.nodes(spark, d))
    return network.chain_follow(v.roads(spark, d), seeds, 75.0)


EDGES = f"""{FOLLOW}, cedge AS (SELECT seed AS src, node AS dst, min(dist_m) AS dist_m FROM fol JOIN v_nodes a ON a.node_id = seed JOIN v_nodes b ON b.node_id = node
  WHERE reason = 'reached' AND b.kind & 24 <> 0 AND dist_m < CASE WHEN a.kind & 16 <> 0 AND b.kind & 8 <> 0 THEN 75 ELSE 50 END GROUP BY ALL)"""


@query(f"{EDGES} SELECT * FROM cedge", RN)
def chain_edges(spark, d):
    return network.chain_edges(v.roads(spark, d), v.nodes(spark, d))


@query(f"{CHAIN}, b AS (SELECT src AS a, dst AS b FROM ce UNION SELECT dst, src FROM ce), r AS (SELECT a AS node_id, a AS c FROM b UNION SELECT b.b, r.c FROM r JOIN b ON b.a = r.node_id) SELECT node_id, min(c) AS component FROM r GROUP BY node_id", R)
def connected_components(spark, d):
    return network.components(scalars.chain_edges_of(v.roads(spark, d)))


OFFSET = """b AS (SELECT src AS a, dst AS b FROM ed UNION SELECT dst, src FROM ed),
r AS (SELECT a AS node_id, a AS c FROM b UNION SELECT b.b, r.c FROM r JOIN b ON b.a = r.node_id), lab AS (SELECT node_id, min(c) AS component FROM r GROUP BY node_id),
s AS (SELECT * FROM lab WHERE node_id NOT IN (SELECT dst FROM ed)), h AS (SELECT component, min(node_id) AS node_id FROM lab WHERE component NOT IN (SELECT component FROM s) GROUP BY component),
st AS (SELECT node_id FROM s UNION ALL SELECT node_id FROM h),
wk AS (SELECT node_id, 0e0 AS o, [node_id] AS p FROM st UNION ALL SELECT dst, o + dist_m, list_append(p, dst) FROM wk JOIN ed ON ed.src = wk.node_id WHERE NOT list_contains(p, dst)),
mo AS (SELECT node_id, min(o) AS offset_m FROM wk GROUP BY node_id),
cy AS (SELECT src AS root, dst AS place FROM ed UNION SELECT cy.root, ed.dst FROM cy JOIN ed ON ed.src = cy.place)"""
OFFSETS = f"""{CHAIN}, ed AS (SELECT src, dst, length_m AS dist_m FROM ce), {OFFSET}
SELECT lab.node_id, component, offset_m, component NOT IN (SELECT lab.component FROM cy JOIN lab ON lab.node_id = cy.root WHERE cy.root = cy.place) AS is_dag FROM lab JOIN mo USING (node_id)"""


@query(OFFSETS, R)
def chain_offsets(spark, d):
    edges = scalars.chain_edges_of(v.roads(spark, d)).selectExpr("src", "dst", "length_m AS dist_m")
    return network.chain_offsets(edges)


# Cross-sections for graph queries: nodes of a merge or diverge kind. The walk has no depth
# limit: simple paths end by themselves, and the operators' budget is far beyond them here.
# An arc's inner nodes are plain, with one edge in and one out.
FIXED = f"{ARC}, fx AS (SELECT node_id FROM v_nodes WHERE kind & 24 <> 0)"
WAYS = """plain AS (SELECT node_id FROM dg WHERE n_out = 1 AND n_in = 1 AND node_id NOT IN (SELECT node_id FROM fx)),
wk AS (SELECT node_id AS src, node_id AS place, [node_id] AS nodes, CAST([] AS BIGINT[]) AS edge_ids, 0e0 AS length_m, false AS stop, true AS direct FROM fx
  UNION ALL SELECT wk.src, ae.dst, list_append(nodes, ae.dst), list_append(edge_ids, ae.edge_id), wk.length_m + ae.length_m, ae.dst IN (SELECT node_id FROM fx), direct AND (len(nodes) = 1 OR wk.place IN (SELECT node_id FROM plain))
  FROM wk JOIN ae ON ae.src = wk.place WHERE NOT stop AND (ae.dst IN (SELECT node_id FROM fx) OR NOT list_contains(nodes, ae.dst))),
paths AS (SELECT src, place AS dst, nodes, edge_ids, length_m, direct FROM wk WHERE stop)"""
DEGREE = "dg AS (SELECT node_id, count(*) FILTER (o) AS n_out, count(*) FILTER (NOT o) AS n_in FROM (SELECT src AS node_id, true AS o FROM ae UNION ALL SELECT dst, false FROM ae) GROUP BY 1)"
WALK = f"{FIXED},\n{DEGREE},\n{WAYS}"
ARCS = f"{WALK}, da AS (SELECT * FROM paths WHERE direct AND src <> dst)"


def _fixed(spark, d) -> DataFrame:
    return v.nodes(spark, d).where(scalars.has_kind(F.col("kind"), scalars.MERGE | scalars.DIVERGE)).select("node_id")


def _compressed(spark, d) -> tuple[DataFrame, DataFrame]:
    fixed = _fixed(spark, d)
    return network.cut(network.graph_compress(scalars.arc_edges_of(v.roads(spark, d)), fixed)), fixed


def _traced(paths: DataFrame, fixed: DataFrame) -> DataFrame:
    return network.walks(paths, fixed, fixed)


TEXT = "array_to_string(nodes, ',') AS nodes, array_to_string(edge_ids, ',') AS edges"


def _listed(df: DataFrame, *more: str) -> DataFrame:
    join = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    return df.select("src", "dst", join("nodes").alias("nodes"), join("edge_ids").alias("edges"), "length_m", *more)


@query(f"{WALK} SELECT src, edge_ids[1] AS anchor, dst, {TEXT}, length_m, false AS overflow FROM paths", RN)
def reachable_paths(spark, d):
    return _listed(_traced(*_compressed(spark, d)), "anchor", "overflow")


# All ways between two cross-sections, those of compressed edges alone (direct: the legal arcs of the
# reference) numbered first. Their inner nodes have one neighbour in and one out, by however many edges.
NEIGHBOURS = "dg AS (SELECT node_id, count(DISTINCT beside) FILTER (o) AS n_out, count(DISTINCT beside) FILTER (NOT o) AS n_in FROM (SELECT src AS node_id, dst AS beside, true AS o FROM ae UNION ALL SELECT dst, src, false FROM ae) GROUP BY 1)"


@query(f"{FIXED}, {NEIGHBOURS}, {WAYS} SELECT src, dst, {TEXT}, length_m, direct, row_number() OVER (PARTITION BY src, dst ORDER BY direct DESC, length_m, edge_ids) AS arc_no FROM paths WHERE src <> dst", RN)
def legal_arcs(spark, d):
    fixed = _fixed(spark, d)
    paths = network.cut(network.graph_compress(scalars.arc_edges_of(v.roads(spark, d)), fixed, by_neighbours=True))
    return _listed(network.numbered_ways(paths, fixed), "direct", "arc_no")


# Backwards from each terminal, one search for each compressed edge into it.
OWNER = f"""{ARCS}, tm AS (SELECT DISTINCT dst AS node_id FROM da WHERE dst NOT IN (SELECT src FROM da)),
bk AS (SELECT tm.node_id AS dst, ae.edge_id AS anchor, ae.src AS place, [tm.node_id, ae.src] AS nodes, ae.src IN (SELECT node_id FROM fx) AS stop FROM tm JOIN ae ON ae.dst = tm.node_id WHERE ae.src <> tm.node_id OR ae.src IN (SELECT node_id FROM fx)
  UNION ALL SELECT bk.dst, bk.anchor, ae.src, list_append(nodes, ae.src), ae.src IN (SELECT node_id FROM fx) FROM bk JOIN ae ON ae.dst = bk.place WHERE NOT stop AND (ae.src IN (SELECT node_id FROM fx) OR NOT list_contains(nodes, ae.src))),
an AS (SELECT tm.node_id AS dst, ae.edge_id AS anchor FROM tm JOIN ae ON ae.dst = tm.node_id),
fo AS (SELECT dst, anchor, count(DISTINCT place) AS n_src, count(*) AS n_ways, min(place) AS src FROM bk WHERE stop AND place <> dst GROUP BY ALL),
st AS (SELECT an.dst, CASE WHEN n_src >= 2 THEN 'multi_src' WHEN n_src = 1 AND n_ways >= 2 THEN 'multi_chain' WHEN n_src = 1 THEN 'accepted' ELSE 'no_owner' END AS state, src FROM an LEFT JOIN fo USING (dst, anchor)),
ow AS (SELECT dst, count(*) AS n_anchors, count(*) FILTER (state = 'accepted') AS n_accepted, count(*) FILTER (state = 'multi_src') AS n_multi_src, count(*) FILTER (state = 'multi_chain') AS n_multi_chain, count(*) FILTER (state = 'no_owner') AS n_no_owner,
  0 AS n_overflow, count(DISTINCT src) FILTER (state = 'accepted') AS n_owners, min(src) FILTER (state = 'accepted') AS one FROM st GROUP BY dst),
own AS (SELECT dst, CASE WHEN n_owners = 1 AND n_accepted = n_anchors THEN 'unique_owner' WHEN n_multi_src > 0 OR n_owners >= 2 THEN 'multi_owner' WHEN n_multi_chain > 0 THEN 'ambiguous_owner' ELSE 'no_owner' END AS owner_status,
  CASE WHEN n_owners = 1 AND n_accepted = n_anchors THEN one END AS owner, n_anchors, n_accepted, n_multi_src, n_multi_chain, n_no_owner, n_overflow FROM ow)"""


@query(f"{OWNER} SELECT * FROM own", RN)
def terminal_ownership(spark, d):
    return network.terminal_ownership(*_compressed(spark, d))


@query(f"{ARCS} SELECT src, dst FROM paths WHERE src <> dst EXCEPT SELECT src, dst FROM da", RN)
def trace_only_pairs(spark, d):
    paths, fixed = _compressed(spark, d)
    return network.trace_only_pairs(_traced(paths, fixed).where("src <> dst"), network.legal_arcs(paths, fixed))


@query(
    f"""{OWNER}, tr AS (SELECT DISTINCT src, dst FROM paths WHERE src <> dst), pr AS (SELECT src, dst FROM tr UNION SELECT dst, src FROM tr), n AS (SELECT src, dst, count(*) AS n_direct FROM da GROUP BY ALL)
    SELECT src, dst, CASE WHEN owner_status = 'unique_owner' AND owner <> src THEN 'owner_mismatch' WHEN n_direct = 1 THEN 'direct_unique' WHEN n_direct > 1 THEN 'direct_ambiguous'
      WHEN (src, dst) IN (SELECT (src, dst) FROM tr) THEN 'trace_only' WHEN (dst, src) IN (SELECT (src, dst) FROM da) THEN 'reverse_only' ELSE 'not_reachable' END AS reason
    FROM pr LEFT JOIN n USING (src, dst) LEFT JOIN own USING (dst)""",
    RN,
)
def pair_gate(spark, d):
    paths, fixed = _compressed(spark, d)
    direct, traced = network.cut(network.legal_arcs(paths, fixed)), network.cut(_traced(paths, fixed).where("src <> dst"))
    pairs = traced.select("src", "dst").union(traced.select("dst", "src")).distinct()
    return network.pair_gate(pairs, direct, traced, network.terminal_ownership(paths, fixed).select("dst", "owner_status", "owner")).select("src", "dst", "reason")


# Asked for: cross-sections whose ids are up to 12 apart, in either order.
@query(
    f"""{ARCS}, dp AS (SELECT DISTINCT src, dst FROM da), k AS (SELECT node_id AS src, node_id + o AS dst FROM fx, unnest(range(-12, 13)) t(o) WHERE o <> 0 AND node_id + o IN (SELECT node_id FROM fx) AND (node_id, node_id + o) NOT IN (SELECT (src, dst) FROM dp)),
    b AS (SELECT src, dst AS place, [src, dst] AS nodes FROM dp UNION ALL SELECT b.src, dp.dst, list_append(nodes, dp.dst) FROM b JOIN dp ON dp.src = b.place WHERE len(nodes) <= 4 AND NOT list_contains(nodes, dp.dst)),
    f AS (SELECT src, place AS dst, count(*) AS n, count(DISTINCT CASE WHEN len(nodes) = 3 THEN nodes[2] END) AS m FROM b GROUP BY ALL)
    SELECT src, dst, least(coalesce(n, 0), 32) AS n_paths, coalesce(m, 0) AS n_middle, false AS overflow,
      CASE WHEN m = 1 THEN 'unique' WHEN m >= 2 THEN 'ambiguous' WHEN n > 0 OR (src, dst) IN (SELECT (src, dst) FROM paths) THEN 'gap' ELSE 'reject' END AS bridge
    FROM k LEFT JOIN f USING (src, dst)""",
    RN,
)
def bridge_paths(spark, d):
    paths, fixed = _compressed(spark, d)
    near = fixed.select(F.col("node_id").alias("src"), F.explode(F.sequence(F.col("node_id") - 12, F.col("node_id") + 12)).alias("dst")).where("src <> dst")
    asked = near.join(fixed.withColumnsRenamed({"node_id": "dst"}), "dst", "left_semi")
    return network.bridge_paths(asked, network.legal_arcs(paths, fixed), _traced(paths, fixed))


# Arcs are the ways to the next cross-section, known by their edges; peers are alone in their pair, and their
# ends lie beside the destination by their last edge.
@query(
    f"""{WALK}, a AS (SELECT array_to_string(edge_ids, ',') AS arc_id, src, dst, nodes[2:len(nodes) - 1] AS mid, edge_ids, edge_ids[len(edge_ids)] % 9 * 4e0 AS end_x, count(*) OVER (PARTITION BY src, dst) = 1 AS is_peer FROM paths WHERE src <> dst),
    p AS (SELECT a.arc_id, list_intersect(a.mid, b.mid) AS n, list_intersect(a.edge_ids, b.edge_ids) AS e, abs(a.end_x - b.end_x) <= 5 AS near FROM a JOIN a b ON b.dst = a.dst AND b.src <> a.src AND b.is_peer),
    g AS (SELECT arc_id, list_sort(list_distinct(flatten(list(n)))) AS n, list_sort(list_distinct(flatten(list(e)))) AS e, bool_or(near) AS near FROM p GROUP BY arc_id)
    SELECT a.arc_id, coalesce(array_to_string(n, ','), '') AS shared_nodes, coalesce(array_to_string(e, ','), '') AS shared_edges, CASE WHEN len(n) > 0 OR len(e) > 0 OR near THEN 'merge_multi_upstream' ELSE 'single' END AS structure,
      array_to_string(list_filter([CASE WHEN len(n) > 0 OR len(e) > 0 OR near THEN 'same_downstream_destination' END, CASE WHEN len(n) > 0 THEN 'shared_intermediate_xsec_signal' END, CASE WHEN len(e) > 0 THEN 'shared_topology_edge_signal' END, CASE WHEN near THEN 'shared_terminal_geometry_signal' END], lambda x: x IS NOT NULL), ',') AS signals
    FROM a LEFT JOIN g USING (arc_id)""",
    RN,
)
def shared_downstream(spark, d):
    ways = network.cut(_traced(*_compressed(spark, d)).where("src <> dst"))
    text = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    last = F.element_at("edge_ids", -1) % 9 * F.lit(4.0)
    alone = F.count("*").over(Window.partitionBy("src", "dst")) == 1
    found = arcs.shared_downstream(ways.select(text("edge_ids").alias("arc_id"), "src", "dst", "nodes", "edge_ids", last.alias("end_x"), F.lit(0.0).alias("end_y"), alone.alias("is_peer")))
    return found.select("arc_id", text("shared_nodes").alias("shared_nodes"), text("shared_edges").alias("shared_edges"), "structure", F.array_join("signals", ",").alias("signals"))


# --- crossings and zones ---------------------------------------------------------

SEG = """sg AS (SELECT patch_id, traj_id, seq, x AS x1, y AS y1, lead(x) OVER w AS x2, lead(y) OVER w AS y2 FROM v_traj WINDOW w AS (PARTITION BY traj_id ORDER BY seq)),
s2 AS (SELECT *, sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) AS seg_m FROM sg WHERE x2 IS NOT NULL),
s AS (SELECT *, coalesce(sum(seg_m) OVER (PARTITION BY traj_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s1 FROM s2)"""
# Cross-sections lean by up to 4 m, so lines are met in a window of x and cut by the slanted segment.
CROSS = f"""{SEG}, h AS (SELECT s.*, node_id, c.x1 AS cx1, c.y1 AS cy1, c.x2 - c.x1 AS ex, c.y2 - c.y1 AS ey, (s.x2 - s.x1) * (c.y2 - c.y1) - (s.y2 - s.y1) * (c.x2 - c.x1) AS den FROM s JOIN v_xsecs c ON s.x1 BETWEEN c.x1 - 12 AND c.x1 + 12),
k AS (SELECT *, ((cx1 - x1) * ey - (cy1 - y1) * ex) / den AS f, ((cx1 - x1) * (y2 - y1) - (cy1 - y1) * (x2 - x1)) / den AS g FROM h WHERE den <> 0),
m AS (SELECT *, x1 + f * (x2 - x1) AS x, y1 + f * (y2 - y1) AS y, seq + f AS seq_at, s1 + f * seg_m AS station, abs(g - 0.5e0) * sqrt(ex * ex + ey * ey) AS off FROM k WHERE f >= 0 AND f < 1 AND g BETWEEN 0 AND 1),
ev AS (SELECT patch_id, traj_id, node_id, x, y, seq_at, station, off FROM m QUALIFY row_number() OVER (PARTITION BY traj_id, node_id ORDER BY round(off, 9), station, seq_at) = 1)"""
LINE = ["patch_id", "traj_id"]


def _events(spark, d):
    return zones.crossing_events(zones.segments(v.traj(spark, d), LINE), v.xsecs(spark, d), LINE)


@query(f"{CROSS} SELECT patch_id, traj_id, node_id, round(x, 6) AS x, round(y, 6) AS y, round(seq_at, 6) AS seq_at, round(station, 6) AS station, round(off, 6) AS off FROM ev", TX)
def crossing_events(spark, d):
    return rounded(_events(spark, d))


@query(f"{CROSS} SELECT patch_id, traj_id, node_id, row_number() OVER w AS ord, lag(node_id) OVER w AS prev_node, lead(node_id) OVER w AS next_node FROM ev WINDOW w AS (PARTITION BY traj_id ORDER BY seq_at, node_id)", TX)
def event_sequence(spark, d):
    return zones.event_sequence(_events(spark, d), LINE).select(*LINE, "node_id", "ord", "prev_node", "next_node")


PAIRS = f"{CROSS}, n AS (SELECT *, lead(node_id) OVER w AS dst, lead(seq_at) OVER w AS seq_to FROM ev WINDOW w AS (PARTITION BY traj_id ORDER BY seq_at, node_id)), pr AS (SELECT patch_id, traj_id, node_id AS src, dst, seq_at AS seq_from, seq_to FROM n WHERE dst IS NOT NULL AND dst <> node_id)"


@query(f"{PAIRS} SELECT patch_id, traj_id, src, dst, round(seq_from, 6) AS seq_from, round(seq_to, 6) AS seq_to FROM pr", TX)
def traj_pair_candidates(spark, d):
    return rounded(zones.traj_pair_candidates(_events(spark, d), LINE))


@query(f"""{CROSS}, n AS (SELECT *, row_number() OVER (PARTITION BY traj_id ORDER BY seq_at, node_id) AS i FROM ev), p AS (SELECT a.patch_id, a.traj_id, a.node_id AS src, b.node_id AS dst, a.seq_at AS seq_from, b.seq_at AS seq_to, a.i AS i, b.i AS j FROM n a JOIN n b ON a.traj_id = b.traj_id AND a.i < b.i AND a.node_id <> b.node_id),
q AS (SELECT p.traj_id, p.i, p.j, list_sort(list(DISTINCT n.node_id)) AS l FROM p JOIN n ON n.traj_id = p.traj_id AND n.i > p.i AND n.i < p.j AND n.node_id <> src AND n.node_id <> dst GROUP BY ALL)
SELECT patch_id, p.traj_id, src, dst, round(seq_from, 6) AS seq_from, round(seq_to, 6) AS seq_to, CAST(p.j - p.i AS INTEGER) AS index_gap, CASE WHEN p.j - p.i = 1 THEN 'adjacent' ELSE 'skip_pair' END AS mode, coalesce(array_to_string(l, ','), '') AS inner_nodes FROM p LEFT JOIN q ON q.traj_id = p.traj_id AND q.i = p.i AND q.j = p.j""", TX)
def traj_pair_all(spark, d):
    got = rounded(zones.traj_pair_all(_events(spark, d), LINE))
    return got.withColumn("inner_nodes", F.array_join(F.transform("inner", lambda x: x.cast("string")), ",")).drop("inner")


@query(f"{PAIRS} SELECT src, dst, count(DISTINCT traj_id) AS n_traj, count(*) AS n_events, min(traj_id) AS first_traj, round(avg(seq_to - seq_from), 6) AS mean_gap FROM pr GROUP BY ALL", TX)
def pair_support(spark, d):
    return rounded(zones.pair_support(zones.traj_pair_candidates(_events(spark, d), LINE)))


@query(
    """l AS (SELECT *, lag(x) OVER w AS px, lag(y) OVER w AS py FROM v_traj WINDOW w AS (PARTITION BY traj_id ORDER BY seq)), k AS (SELECT * FROM l WHERE px IS NULL OR px <> x OR py <> y)
    SELECT patch_id, traj_id, count(*) AS n, round(coalesce(sum(sqrt((x - px) * (x - px) + (y - py) * (y - py))), 0), 6) AS length_m, round(min_by(x, seq), 6) AS x_start, round(min_by(y, seq), 6) AS y_start, round(max_by(x, seq), 6) AS x_end, round(max_by(y, seq), 6) AS y_end FROM k GROUP BY ALL""",
    T,
)
def polyline_measure(spark, d):
    return rounded(zones.polyline_measure(v.traj(spark, d), LINE))


INSIDE = "(e.y1 <= p.y AND p.y < e.y2 OR e.y2 <= p.y AND p.y < e.y1) AND p.x < e.x1 + (p.y - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1)"


@query(f"SELECT patch_id, poly_id, count(*) AS n FROM (SELECT DISTINCT patch_id, x, y FROM v_points) p, (SELECT DISTINCT poly_id FROM v_zone_edges) z WHERE (SELECT count(*) FROM v_zone_edges e WHERE e.poly_id = z.poly_id AND {INSIDE}) % 2 = 1 GROUP BY ALL", ("v_points", "v_zone_edges"))
def point_in_zone(spark, d):
    inside = zones.point_in_zone(v.points(spark, d).select("patch_id", "x", "y"), v.zone_edges(spark, d), ["patch_id"])
    return inside.groupBy("patch_id", "poly_id").agg(F.count("*").alias("n"))


# The zones are rectangles, so the oracle clips each segment to the box in closed form.
CLIP = """cl AS (SELECT s.*, poly_id, greatest(0e0, least((bx1 - x1) / (x2 - x1), (bx2 - x1) / (x2 - x1)), CASE WHEN y2 <> y1 THEN least((by1 - y1) / (y2 - y1), (by2 - y1) / (y2 - y1)) ELSE 0 END) AS ta,
  least(1e0, greatest((bx1 - x1) / (x2 - x1), (bx2 - x1) / (x2 - x1)), CASE WHEN y2 <> y1 THEN greatest((by1 - y1) / (y2 - y1), (by2 - y1) / (y2 - y1)) ELSE 1 END) AS tb FROM s, bx WHERE (y1 <> y2 OR (y1 >= by1 AND y1 < by2))),
ins AS (SELECT patch_id, traj_id, poly_id, s1 + ta * seg_m AS a, s1 + tb * seg_m AS b FROM cl WHERE tb > ta)"""
PIECES = f"""{SEG}, bx AS (SELECT poly_id, min(x1) AS bx1, max(x1) AS bx2, min(y1) AS by1, max(y1) AS by2 FROM v_zone_edges GROUP BY 1),
{CLIP},
nw AS (SELECT *, CAST(coalesce(a > lag(b) OVER w + 1e-6, true) AS INTEGER) AS n FROM ins WINDOW w AS (PARTITION BY traj_id, poly_id ORDER BY a, b)),
rn AS (SELECT *, sum(n) OVER (PARTITION BY traj_id, poly_id ORDER BY a, b) AS run FROM nw),
pc AS (SELECT patch_id, traj_id, poly_id, run AS piece, min(a) AS start_s, max(b) AS end_s FROM rn GROUP BY ALL)"""
TZ = ("v_traj", "v_zone_edges")


@query(f"{PIECES} SELECT patch_id, traj_id, poly_id, CAST(piece AS BIGINT) AS piece, round(start_s, 4) AS start_s, round(end_s, 4) AS end_s FROM pc", TZ)
def line_zone_pieces(spark, d):
    pieces = zones.line_zone_pieces(zones.segments(v.traj(spark, d), LINE), v.zone_edges(spark, d), LINE)
    return rounded(pieces.withColumn("piece", F.col("piece").cast("long")), 4).select(*LINE, "poly_id", "piece", "start_s", "end_s")


# Three zones in place of each: the first two touch, the third overlaps both.
UNION = f"""{SEG}, bx AS (SELECT DISTINCT poly_id * 3 + i AS poly_id, poly_id * 70e0 + CASE i WHEN 0 THEN 0 WHEN 1 THEN 30 ELSE 20 END AS bx1, poly_id * 70e0 + CASE i WHEN 0 THEN 30 WHEN 1 THEN 60 ELSE 40 END AS bx2, CASE i WHEN 2 THEN 10e0 ELSE 0e0 END AS by1, CASE i WHEN 2 THEN 58e0 ELSE 55e0 END AS by2 FROM v_zone_edges, range(3) r(i)),
{CLIP},
nw AS (SELECT *, CAST(coalesce(a > max(b) OVER (PARTITION BY traj_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1e-6, true) AS INTEGER) AS n FROM ins),
rn AS (SELECT *, sum(n) OVER (PARTITION BY traj_id ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS run FROM nw), pc AS (SELECT patch_id, traj_id, run AS piece, min(a) AS start_s, max(b) AS end_s FROM rn GROUP BY ALL)"""


def _touching(spark, d):
    base = v.zone_edges(spark, d).select("poly_id", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("i")).distinct()
    low, high = "poly_id * 70e0D + CASE i WHEN 0 THEN 0e0D WHEN 1 THEN 30e0D ELSE 20e0D END", "poly_id * 70e0D + CASE i WHEN 0 THEN 30e0D WHEN 1 THEN 60e0D ELSE 40e0D END"
    y1, y2 = "CASE i WHEN 2 THEN 10e0D ELSE 0e0D END", "CASE i WHEN 2 THEN 58e0D ELSE 55e0D END"
    corners = [(low, y1), (high, y1), (high, y2), (low, y2)]
    edges = ", ".join(f"named_struct('edge_ix', {k}, 'x1', {a[0]}, 'y1', {a[1]}, 'x2', {b[0]}, 'y2', {b[1]})" for k, (a, b) in enumerate(zip(corners, corners[1:] + corners[:1])))
    return base.selectExpr("poly_id * 3 + i AS poly_id", f"inline(array({edges}))")


@query(f"{UNION} SELECT patch_id, traj_id, CAST(piece AS BIGINT) AS piece, round(start_s, 4) AS start_s, round(end_s, 4) AS end_s FROM pc", TZ)
def line_zone_union(spark, d):
    """Pieces of lines in the union of zones that touch and overlap."""
    pieces = zones.line_zone_pieces(zones.segments(v.traj(spark, d), LINE), _touching(spark, d), LINE, union=True)
    return rounded(pieces.withColumn("piece", F.col("piece").cast("long")), 4).select(*LINE, "piece", "start_s", "end_s")


RATIO = f"{PIECES}, tl AS (SELECT patch_id, traj_id, sum(seg_m) AS length_m FROM s GROUP BY ALL), rt AS (SELECT patch_id, traj_id, poly_id, sum(end_s - start_s) AS inside_m, max(length_m) AS length_m, sum(end_s - start_s) / max(length_m) AS ratio FROM pc JOIN tl USING (patch_id, traj_id) GROUP BY ALL)"


@query(f"{RATIO} SELECT patch_id, traj_id, poly_id, round(inside_m, 4) AS inside_m, round(length_m, 4) AS length_m, round(ratio, 4) AS ratio FROM rt", TZ)
def line_zone_ratio(spark, d):
    got = zones.line_zone_ratio(zones.segments(v.traj(spark, d), LINE), v.zone_edges(spark, d), LINE)
    return rounded(got, 4).select(*LINE, "poly_id", "inside_m", "length_m", "ratio")


@query(f"{RATIO} SELECT patch_id, traj_id, poly_id, CASE WHEN ratio >= 1 - 1e-6 THEN 'inside' WHEN ratio <= 1e-6 THEN 'outside' ELSE 'boundary_intersection' END AS relation FROM rt", TZ)
def zone_relation(spark, d):
    got = zones.line_zone_ratio(zones.segments(v.traj(spark, d), LINE), v.zone_edges(spark, d), LINE)
    return got.select(*LINE, "poly_id", zones.zone_relation(F.col("ratio")).alias("relation"))


PROJECT = f"""{SEG}, pt AS (SELECT DISTINCT patch_id, traj_id AS p_id, seq AS p_seq, x AS px, y AS py FROM v_traj),
pj AS (SELECT pt.patch_id, p_id, p_seq, s.traj_id, s1, seg_m, x1, y1, x2, y2, px, py, CASE WHEN seg_m > 0 THEN greatest(0e0, least(1e0, ((px - x1) * (x2 - x1) + (py - y1) * (y2 - y1)) / (seg_m * seg_m))) ELSE 0 END AS t FROM pt JOIN s ON s.patch_id = pt.patch_id AND s.x1 BETWEEN px - 15 AND px + 15),
ds AS (SELECT *, sqrt((px - x1 - t * (x2 - x1)) ** 2 + (py - y1 - t * (y2 - y1)) ** 2) AS dist FROM pj)"""


@query(f"{PROJECT} SELECT patch_id, p_id, p_seq, traj_id, round(min(dist), 5) AS dist FROM ds WHERE dist <= 4 GROUP BY ALL", T)
def line_project(spark, d):
    traj = v.traj(spark, d)
    points = traj.selectExpr("patch_id", "traj_id AS p_id", "seq AS p_seq", "x", "y")
    got = zones.line_project(points, zones.segments(traj, LINE), ["traj_id"], ["p_id", "p_seq"], 4.0)
    return rounded(got.select("patch_id", "p_id", "p_seq", "traj_id", "dist"), 5)


SPANS = "g AS (SELECT *, CAST(coalesce(seq - lag(seq) OVER w > 2 OR abs(x - lag(x) OVER w) > 25, false) AS INTEGER) AS cut FROM (SELECT * FROM v_traj WHERE z < 10.7e0) WINDOW w AS (PARTITION BY traj_id ORDER BY seq)), sp0 AS (SELECT *, sum(cut) OVER (PARTITION BY traj_id ORDER BY seq) AS span FROM g), sp AS (SELECT patch_id, traj_id, span, min(x) AS start_s, max(x) AS end_s, count(*) AS n FROM sp0 GROUP BY ALL)"


def _spans(spark, d):
    return series.span_group(v.traj(spark, d).where("z < 10.7D"), LINE, "x", seq_gap=2)


@query(f"{SPANS} SELECT patch_id, traj_id, CAST(span AS BIGINT) AS span, start_s, end_s, n FROM sp", T)
def span_group(spark, d):
    return _spans(spark, d)


@query(
    f"""{SPANS}, ln AS (SELECT patch_id, traj_id, max(x) AS length_m FROM v_traj GROUP BY ALL), q AS (SELECT *, max(end_s) OVER (PARTITION BY traj_id ORDER BY start_s, end_s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM sp),
    i AS (SELECT *, sum(CAST(coalesce(start_s > reach + 15, true) AS INTEGER)) OVER (PARTITION BY traj_id ORDER BY start_s, end_s) AS isl FROM q), u AS (SELECT patch_id, traj_id, max(end_s) - min(start_s) AS m FROM i GROUP BY patch_id, traj_id, isl)
    SELECT patch_id, traj_id, round(sum(m), 6) AS covered, max(length_m) AS length_m, round(least(1, sum(m) / max(length_m)), 6) AS coverage FROM u JOIN ln USING (patch_id, traj_id) GROUP BY ALL""",
    T,
)
def span_union_coverage(spark, d):
    length = v.traj(spark, d).groupBy(*LINE).agg(F.max("x").alias("line_m"))
    return rounded(series.span_union_coverage(_spans(spark, d).join(length, LINE), LINE, "line_m", 15.0))


@query(
    f"""{CROSS}, rk AS (SELECT *, row_number() OVER (PARTITION BY node_id ORDER BY y, traj_id) AS rank FROM ev),
    mv AS (SELECT *, max(y - rank * 0.5e0) OVER (PARTITION BY node_id ORDER BY rank) + rank * 0.5e0 AS moved FROM rk)
    SELECT node_id, traj_id, rank, round(moved - greatest(0e0, max(moved) OVER (PARTITION BY node_id) - 65e0), 6) + 0e0 AS moved FROM mv""",
    TX,
)
def interval_allocate(spark, d):
    order = Window.partitionBy("node_id").orderBy("y", "traj_id")
    ranked = _events(spark, d).withColumns({"rank": F.row_number().over(order), "length": F.lit(65.0)})
    return rounded(series.interval_allocate(ranked, ["node_id"], "y", "length", 0.5).select("node_id", "traj_id", "rank", "moved"))


# Every crossing of a cross-section wants room to either side of it.
APART = f"""{CROSS}, iv AS (SELECT node_id, traj_id AS arc_id, y - 0.5e0 - traj_id % 3 AS a, y + 0.5e0 + traj_id % 4 AS b FROM ev), rk AS (SELECT *, (a + b) / 2 AS c, row_number() OVER (PARTITION BY node_id ORDER BY round((a + b) / 2, 9), arc_id) AS rank FROM iv),
mv AS (SELECT *, max(c - rank * 0.1e0) OVER (PARTITION BY node_id ORDER BY rank) + rank * 0.1e0 AS m0 FROM rk), mw AS (SELECT *, CASE WHEN max(m0) OVER (PARTITION BY node_id) > 58 THEN greatest(0e0, m0 - (max(m0) OVER (PARTITION BY node_id) - 58e0)) ELSE m0 END AS m FROM mv),
nb AS (SELECT *, least(greatest(m, a), b) AS t, lag(m) OVER w AS p, lead(m) OVER w AS q FROM mw WINDOW w AS (PARTITION BY node_id ORDER BY rank)),
e1 AS (SELECT *, coalesce(greatest(a, (p + t) / 2 + 0.05e0), a) AS lo, coalesce(least(b, (t + q) / 2 - 0.05e0), b) AS hi FROM nb),
e2 AS (SELECT *, greatest(a, CASE WHEN hi < lo THEN t ELSE lo END) AS l2, least(b, CASE WHEN hi < lo THEN t ELSE hi END) AS h2, least(0.25e0, greatest(0.01e0, (b - a) / 4)) AS half FROM e1),
e3 AS (SELECT *, CASE WHEN h2 <= l2 + 1e-6 THEN greatest(a, t - half) ELSE l2 END AS l3, CASE WHEN h2 <= l2 + 1e-6 THEN least(b, t + half) ELSE h2 END AS h3 FROM e2)
SELECT node_id, arc_id, rank, round(a, 6) AS raw_s, round(b, 6) AS raw_e, round(l3, 6) AS start_s, round(h3, 6) AS end_s, coalesce(l3 >= lag(h3) OVER (PARTITION BY node_id ORDER BY rank) - 1e-6, true) AS ordered FROM e3"""


@query(APART, TX)
def interval_keep_apart(spark, d):
    rows = _events(spark, d).select("node_id", F.col("traj_id").alias("arc_id"), (F.col("y") - 0.5 - F.col("traj_id") % 3).alias("start_s"), (F.col("y") + 0.5 + F.col("traj_id") % 4).alias("end_s"), F.lit(58.0).alias("length"))
    return rounded(series.interval_keep_apart(rows, ["node_id"]))


@query(
    """o AS (SELECT patch_id, traj_id, seq, CASE WHEN seq % 3 = 0 OR seq < 4 THEN NULL ELSE z END AS z FROM v_traj),
    k AS (SELECT *, last_value(z IGNORE NULLS) OVER b AS v0, last_value(CASE WHEN z IS NOT NULL THEN seq END IGNORE NULLS) OVER b AS s0, first_value(z IGNORE NULLS) OVER a AS v1, first_value(CASE WHEN z IS NOT NULL THEN seq END IGNORE NULLS) OVER a AS s1 FROM o
      WINDOW b AS (PARTITION BY traj_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), a AS (PARTITION BY traj_id ORDER BY seq ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
    SELECT patch_id, traj_id, seq, round(coalesce(z, v0 + (v1 - v0) * (seq - s0) / (s1 - s0), v0, v1), 6) AS filled FROM k""",
    T,
)
def offset_interpolate(spark, d):
    rows = v.traj(spark, d).withColumn("z", F.when((F.col("seq") % 3 != 0) & (F.col("seq") >= 4), F.col("z")))
    return rounded(series.offset_interpolate(rows, LINE, "seq", "z").select(*LINE, "seq", "filled"))


# --- movements -------------------------------------------------------------------

# Approaches: roads at nodes of degree 3 and more; angle and place follow from the ids.
APPROACH = f"""{ENDS}, dg AS (SELECT node_id FROM e GROUP BY node_id HAVING count(DISTINCT road_id) >= 3), j AS (SELECT e.*, direction FROM e JOIN v_roads USING (road_id) SEMI JOIN dg USING (node_id)),
sd AS (SELECT node_id AS intersection_id, road_id, unnest(CASE WHEN direction IN (0, 1) THEN ['entry', 'exit'] WHEN (direction = 2) = at_end THEN ['entry'] ELSE ['exit'] END) AS side FROM j),
ap0 AS (SELECT intersection_id, road_id, side, road_id * 2 + CAST(side = 'exit' AS INTEGER) AS approach_id, road_id * 37 % 360 AS angle, road_id % 4 AS arm, (road_id % 4) * 90e0 AS arm_deg,
  (CASE WHEN side = 'exit' THEN road_id * 37 % 360 ELSE road_id * 37 % 360 + 180 END) % 360 * 1e0 AS travel_deg, road_id % 7 * 1e0 AS x, road_id % 11 * 1e0 AS y,
  CASE WHEN road_id % 9 = 0 THEN 'left_uturn_service' WHEN road_id % 10 = 0 THEN 'paired_mainline_no_left_uturn' END AS profile FROM sd),
ap AS (SELECT *, row_number() OVER (PARTITION BY intersection_id, arm, side ORDER BY round(-x * sin(radians(travel_deg)) + y * cos(radians(travel_deg)), 6) DESC, approach_id) - 1 AS lateral_rank, count(*) OVER (PARTITION BY intersection_id, arm, side) AS n FROM ap0),
mp AS (SELECT s.intersection_id, s.approach_id AS s_id, t.approach_id AS t_id, s.lateral_rank = 0 AS s_core, coalesce(s.profile, '') AS s_profile, CASE WHEN t.n = 1 THEN 'core_standard_exit' ELSE 'unknown' END AS t_role, least(2, abs(s.lateral_rank - t.lateral_rank)) AS crossed,
  CASE WHEN s.arm = t.arm THEN 'same' WHEN abs(s.arm_deg - t.arm_deg) = 180 THEN 'opposite' ELSE 'adjacent' END AS relation, (t.travel_deg - s.travel_deg + 540) % 360 - 180 AS delta FROM ap s JOIN ap t USING (intersection_id) WHERE s.side = 'entry' AND t.side = 'exit'),
mv AS (SELECT *, CASE WHEN relation = 'same' THEN 'uturn' WHEN relation = 'opposite' OR abs(delta) < 15 THEN 'through' WHEN delta > 0 THEN 'left' ELSE 'right' END AS turn, t_role = 'unknown' AS u FROM mp),
dc AS (SELECT *, CASE WHEN crossed >= 2 THEN 'MULTI_PARALLEL_CROSS_FORBIDDEN'
  WHEN s_profile = 'left_uturn_service' AND turn IN ('left', 'uturn') THEN CASE WHEN u THEN 'UNKNOWN_TARGET_STANDARD_EXIT' ELSE 'PROFILE_LEFT_UTURN_SERVICE_ALLOWED' END
  WHEN s_profile = 'left_uturn_service' THEN CASE turn WHEN 'through' THEN 'PROFILE_LEFT_UTURN_SERVICE_FORBID_THROUGH' ELSE 'PROFILE_LEFT_UTURN_SERVICE_FORBID_RIGHT' END
  WHEN s_profile LIKE 'paired%' AND turn = 'left' THEN 'PROFILE_PAIRED_MAINLINE_FORBID_LEFT' WHEN s_profile LIKE 'paired%' AND turn = 'uturn' THEN 'PROFILE_PAIRED_MAINLINE_FORBID_UTURN'
  WHEN crossed = 1 THEN 'SINGLE_PARALLEL_CROSS_DEFAULT_UNKNOWN' WHEN turn = 'right' THEN 'DEFAULT_RIGHT_ALLOWED' WHEN turn = 'through' THEN 'DEFAULT_THROUGH_ALLOWED'
  WHEN u THEN 'UNKNOWN_TARGET_STANDARD_EXIT' WHEN turn = 'left' AND s_core THEN 'DEFAULT_CORE_LEFT_ALLOWED' WHEN turn = 'left' THEN 'DEFAULT_NONCORE_LEFT_UNKNOWN' ELSE 'DEFAULT_UTURN_UNKNOWN' END AS reason FROM mv),
fin AS (SELECT *, CASE WHEN reason LIKE '%ALLOWED' THEN 'allowed' WHEN reason LIKE '%FORBID%' THEN 'forbidden' ELSE 'unknown' END AS status FROM dc)"""


def _approaches(spark, d):
    ends = network.ends(v.roads(spark, d))
    big = network.node_degree(v.roads(spark, d)).where("degree >= 3").select("node_id")
    sides = scalars.movement_sides(ends.join(big, "node_id", "left_semi"))
    rows = sides.selectExpr(
        "node_id AS intersection_id", "road_id", "side", "road_id * 2 + cast(side = 'exit' AS int) AS approach_id", "road_id * 37 % 360 AS angle", "road_id % 4 AS arm", "(road_id % 4) * 90e0D AS arm_deg",
        "(CASE WHEN side = 'exit' THEN road_id * 37 % 360 ELSE road_id * 37 % 360 + 180 END) % 360 * 1e0D AS travel_deg", "road_id % 7 * 1e0D AS x", "road_id % 11 * 1e0D AS y",
        "CASE WHEN road_id % 9 = 0 THEN 'left_uturn_service' WHEN road_id % 10 = 0 THEN 'paired_mainline_no_left_uturn' END AS profile",
    )
    return movements.approach_defaults(movements.lateral_rank(rows))


def _decided(spark, d):
    rule = movements.movement_rules()
    rows = movements.movement_pairs(_approaches(spark, d)).withColumn("decision", rule)
    return rows.withColumns({"status": F.col("decision.status"), "confidence": F.col("decision.confidence"), "reason": F.col("decision.reasons")[0]})


@query(f"{APPROACH} SELECT intersection_id, approach_id, arm, side, lateral_rank FROM ap", R)
def lateral_rank(spark, d):
    return _approaches(spark, d).select("intersection_id", "approach_id", "arm", "side", F.col("lateral_rank").cast("long").alias("lateral_rank"))


@query(f"{APPROACH} SELECT intersection_id, approach_id, CASE WHEN side = 'entry' THEN lateral_rank = 0 END AS is_core, CASE WHEN side = 'exit' THEN CASE WHEN n = 1 THEN 'core_standard_exit' ELSE 'unknown' END END AS exit_role FROM ap", R)
def approach_defaults(spark, d):
    return _approaches(spark, d).select("intersection_id", "approach_id", "is_core", "exit_role")


@query(f"{APPROACH} SELECT intersection_id, s_id, t_id, relation, turn, CAST(crossed AS BIGINT) AS crossed FROM mv", R)
def movement_pairs(spark, d):
    rows = movements.movement_pairs(_approaches(spark, d))
    return rows.select("intersection_id", F.col("s_approach_id").alias("s_id"), F.col("t_approach_id").alias("t_id"), "relation", "turn", F.col("crossed").cast("long").alias("crossed"))


@query(f"{APPROACH} SELECT intersection_id, s_id, t_id, status, reason FROM fin", R)
def movement_rules(spark, d):
    return _decided(spark, d).select("intersection_id", F.col("s_approach_id").alias("s_id"), F.col("t_approach_id").alias("t_id"), "status", "reason")


@query(f"{APPROACH} SELECT intersection_id, turn, count(*) FILTER (status = 'allowed') AS allowed, count(*) FILTER (status = 'forbidden') AS forbidden, count(*) FILTER (status = 'unknown') AS unknown FROM fin GROUP BY ALL", R)
def movement_matrix(spark, d):
    return movements.movement_matrix(_decided(spark, d), ["intersection_id"])


@query(f"{APPROACH} SELECT intersection_id, s_id, string_agg(t_id || '=' || status, ',' ORDER BY t_id, status) AS cells, count(*) AS n FROM fin GROUP BY ALL", R)
def movement_cells(spark, d):
    return movements.movement_cells(_decided(spark, d), ["intersection_id"], "s_approach_id", "t_approach_id").withColumnRenamed("s_approach_id", "s_id")


@query(f"{APPROACH} SELECT intersection_id, count(*) AS n, count(*) FILTER (status = 'unknown') AS n_unknown FROM fin GROUP BY ROLLUP (intersection_id)", R)
def batch_run_summary(spark, d):
    return _decided(spark, d).rollup("intersection_id").agg(F.count("*").alias("n"), F.count_if(F.col("status") == "unknown").alias("n_unknown"))


@query(f"{APPROACH}, k AS (SELECT s_id, t_id, unnest(list_filter([CASE WHEN status = 'unknown' THEN 'unknown_status' END, CASE WHEN u THEN 'target_role_unknown' END, CASE WHEN s_profile = '' AND turn IN ('left', 'uturn') THEN 'profile_gap' END], lambda x: x IS NOT NULL)) AS review_kind FROM fin) SELECT review_kind, count(*) AS n FROM k GROUP BY ALL", R)
def review_lists(spark, d):
    return movements.review_lists(_decided(spark, d)).groupBy("review_kind").agg(F.count("*").alias("n"))


@query(
    f"""{APPROACH}, a AS (SELECT s_id, t_id, status FROM fin WHERE s_id % 3 <> 0), b AS (SELECT s_id, t_id, CASE WHEN t_id % 5 = 0 THEN 'unknown' ELSE status END AS status FROM fin WHERE s_id % 4 <> 0)
    SELECT s_id, t_id, CASE WHEN b.s_id IS NULL THEN 'removed' WHEN a.s_id IS NULL THEN 'added' ELSE 'changed' END AS change FROM a FULL JOIN b USING (s_id, t_id) WHERE a.status IS DISTINCT FROM b.status""",
    R,
)
def run_diff(spark, d):
    rows = _decided(spark, d).select(F.col("s_approach_id").alias("s_id"), F.col("t_approach_id").alias("t_id"), "status")
    after = rows.where("s_id % 4 <> 0").withColumn("status", F.when(F.col("t_id") % 5 == 0, "unknown").otherwise(F.col("status")))
    return movements.run_diff(rows.where("s_id % 3 <> 0"), after, ["s_id", "t_id"], ["status"])


@query(
    f"""{APPROACH}, o AS (SELECT DISTINCT CASE o_orderkey % 3 WHEN 0 THEN CAST(o_orderkey * 2 AS VARCHAR) WHEN 1 THEN o_orderkey || ':entry' ELSE CAST(o_orderkey AS VARCHAR) END AS key, 'p' || o_orderkey % 2 AS profile FROM orders WHERE o_orderkey % 39 = 0 OR o_orderkey % 26 = 0),
    x AS (SELECT approach_id, coalesce((SELECT profile FROM o WHERE key = CAST(approach_id AS VARCHAR)), (SELECT profile FROM o WHERE key = road_id || ':' || side), (SELECT profile FROM o WHERE key = CAST(road_id AS VARCHAR))) AS profile FROM ap)
    SELECT coalesce(profile, 'none') AS profile, count(*) AS n FROM x GROUP BY ALL""",
    R,
)
def manual_override_join(spark, d):
    orders = spark.read.parquet(f"{d}/orders.parquet").where("o_orderkey % 39 = 0 OR o_orderkey % 26 = 0")
    overrides = orders.selectExpr("CASE o_orderkey % 3 WHEN 0 THEN string(o_orderkey * 2) WHEN 1 THEN concat(o_orderkey, ':entry') ELSE string(o_orderkey) END AS key", "concat('p', o_orderkey % 2) AS profile").distinct()
    got, _ = movements.manual_override_join(_approaches(spark, d).drop("profile"), overrides)
    return got.groupBy(F.coalesce("profile", F.lit("none")).alias("profile")).agg(F.count("*").alias("n"))


@query()
def arm_cluster(spark, d):
    return movements.arm_cluster(_approaches(spark, d).drop("arm")).select("intersection_id", "approach_id", "arm")
