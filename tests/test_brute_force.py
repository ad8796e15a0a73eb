"""Operators that SQL can't follow, or not at length, against plain Python."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from roadloom.operators import arcs, assembly, evidence, movements, network, series, zones
from roadloom.plans import QUERIES


def test_scans_reach_every_node(spark, data):
    nodes = spark.read.parquet(f"{data}/orders.parquet").count()
    assert QUERIES["crossline_scan"](spark, data).select("node_id").distinct().count() == nodes


def test_chain_order_check_of_all_customers(spark, tmp_path):
    n = 1000
    spark.range(n).selectExpr("id AS c_custkey").write.parquet(f"{tmp_path}/customer.parquet")
    failed = {}
    for i in range(n):
        s, s0 = i * 7919 % 23, (i - 1) * 7919 % 23
        failed[i] = i % 9 > 0 and not failed[i - 1] and (s < s0 or (s == s0 and i % 2 == 1))
    got = QUERIES["chain_order_check"](spark, str(tmp_path)).collect()
    assert {r["node_id"]: r["failed"] for r in got} == failed


def test_chain_order_check_in_a_ring(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1)], "src long, dst long")
    positions = spark.createDataFrame([(1, 5.0, False), (2, 5.0, False), (3, 5.0, False)], "node_id long, s double, may_equal boolean")
    got = {r["node_id"]: r["failed"] for r in assembly.chain_order_check(edges, positions).collect()}
    assert got[1] and sum(got.values()) == 2


def test_radius_median_z_needs_three_points(spark):
    traj = spark.createDataFrame([(0, 1, i, 100.0 * i, 0.0) for i in range(5)], "patch_id long, traj_id long, seq long, x double, y double")
    at = {0: [(1.0, 5.0)], 1: [(1.0, 5.0), (4.0, 6.0)], 2: [(1.0, 5.0), (4.0, 6.0), (5.0, 9.0)], 3: [(0.5, 1.0), (1.0, 2.0), (1.5, 4.0), (5.0, 90.0)], 4: [(3.0 + k / 10, float(k)) for k in range(12)]}
    points = spark.createDataFrame([(0, 100.0 * i + dx, 0.0, z) for i, found in at.items() for dx, z in found], "patch_id long, x double, y double, z double")
    got = {r["seq"]: r["cloud_z"] for r in series.radius_median_z(traj, points).collect()}
    assert got == {0: None, 1: None, 2: 6.0, 3: 2.0, 4: 3.5}  # of twelve far ones the nearest eight


@pytest.mark.parametrize("n", [30, 300, 3000])
def test_graph_compress_of_long_chains(spark, n):
    edges = spark.range(n).selectExpr("id AS src", "id + 1 AS dst", "id * 10 AS edge_id", "1.5D AS length_m")
    (got,) = network.graph_compress(edges, spark.createDataFrame([(0,)], "node_id long")).collect()
    assert (got["src"], got["dst"], got["length_m"], got["closed"]) == (0, n, 1.5 * n, False)
    assert got["nodes"] == list(range(n + 1)) and got["edge_ids"] == [10 * i for i in range(n)]


def test_graph_compress_of_loops_and_parallel_edges(spark):
    rows = [(1, 2, 10), (2, 3, 11), (2, 3, 12), (3, 4, 13), (7, 8, 20), (8, 9, 21), (9, 7, 22), (4, 4, 30)]
    edges = spark.createDataFrame([(*r, 1.0) for r in rows], "src long, dst long, edge_id long, length_m double")
    got = {(r["src"], r["dst"], tuple(r["nodes"]), tuple(r["edge_ids"]), r["closed"]) for r in network.graph_compress(edges, spark.createDataFrame([(1,)], "node_id long")).collect()}
    assert got == {(1, 2, (1, 2), (10,), False), (2, 3, (2, 3), (11,), False), (2, 3, (2, 3), (12,), False), (3, 4, (3, 4), (13,), False), (4, 4, (4, 4), (30,), False), (7, 7, (7, 8, 9, 7), (20, 21, 22), True)}


EDGE = "src long, dst long, edge_id long, length_m double"


def _views(monkeypatch, spark, roads, nodes):
    """The views' roads (src, dst, road_id, length_m) and nodes (node_id, kind), whatever the tables."""
    from roadloom.sources import views

    rows = spark.createDataFrame([(i, a, b, 2, m) for a, b, i, m in roads], "road_id long, snode long, enode long, direction int, length_m double")
    monkeypatch.setattr(views, "roads", lambda *_: rows)
    monkeypatch.setattr(views, "nodes", lambda *_: spark.createDataFrame(nodes, "node_id long, kind int"))


DOUBLED = [(1, 2, 10, 1.0), (2, 3, 11, 2.0), (2, 3, 12, 4.0), (3, 4, 13, 8.0), (3, 4, 14, 16.0), (3, 4, 15, 32.0), (4, 5, 16, 64.0)]
CHOICES = [(11, 2.0, 13, 8.0), (12, 4.0, 13, 8.0), (11, 2.0, 14, 16.0), (12, 4.0, 14, 16.0), (11, 2.0, 15, 32.0), (12, 4.0, 15, 32.0)]  # by length


def test_graph_compress_by_neighbours_takes_every_choice(spark):
    edges = spark.createDataFrame([*DOUBLED, (6, 7, 17, 1.0), (6, 7, 18, 2.0), (7, 6, 19, 4.0)], EDGE)
    got = network.graph_compress(edges, spark.createDataFrame([(1,), (6,)], "node_id long"), by_neighbours=True).collect()
    ways = {(1, 5, (1, 2, 3, 4, 5), (10, a, b, 16), 65.0 + m + n, False) for a, m, b, n in CHOICES}
    loops = {(6, 6, (6, 7, 6), (a, 19), m, False) for a, m in ((17, 5.0), (18, 6.0))}
    assert {(r["src"], r["dst"], tuple(r["nodes"]), tuple(r["edge_ids"]), r["length_m"], r["closed"]) for r in got} == ways | loops and len(got) == 8


def test_graph_compress_deals_out_a_large_product(spark):
    edges = spark.createDataFrame([(i, i + 1, 2 * i + k, float(k << i)) for i in range(15) for k in (0, 1)], EDGE)
    got = network.graph_compress(edges, spark.createDataFrame([(0,)], "node_id long"), by_neighbours=True)
    assert sorted(r["length_m"] for r in got.collect()) == list(range(1 << 15))  # each way has a length of its own


def test_graph_compress_query_contracts_beside_parallel_roads(spark, monkeypatch):
    from roadloom.plans import QUERIES

    _views(monkeypatch, spark, DOUBLED, [(1, 4)])
    got = QUERIES["graph_compress"](spark, "").collect()
    assert sorted((r["src"], r["dst"], r["n_nodes"], r["length_m"]) for r in got) == [(1, 5, 5, 65.0 + m + n) for _, m, _, n in CHOICES]


def test_forty_doubled_edges_in_a_row_end_at_once(spark):
    edges = spark.createDataFrame([(i, i + 1, 2 * i + k, 1.0 + k) for i in range(40) for k in (0, 1)], EDGE)
    fixed = spark.createDataFrame([(0,), (40,)], "node_id long")
    paths = network.graph_compress(edges, fixed)
    assert paths.count() == 80
    rows = network.walks(paths, fixed, fixed, 50).collect()
    # Both searches from node 0 run out of budget, and both say so.
    assert sorted((r["src"], r["anchor"], r["dst"], r["overflow"]) for r in rows) == [(0, 0, None, True), (0, 1, None, True)]


def test_legal_arcs_query_lists_arcs_over_parallel_roads_and_all_other_ways(spark, monkeypatch):
    from roadloom.plans import QUERIES

    branch = [(1, 9, 20, 1.0), (9, 8, 21, 1.0), (9, 5, 22, 0.5)]  # a way through a node with two ways out
    long = [(100 + i, 101 + i, 100 + i, 1.0) for i in range(30)] + [(100 + i, 500, 200 + i, 1.0) for i in range(1, 30)]  # 29 such nodes in a row
    _views(monkeypatch, spark, DOUBLED + branch + long, [(i, 8) for i in (1, 5, 100, 130)])
    got = {(r["src"], r["dst"], r["edges"], r["length_m"], r["direct"], r["arc_no"]) for r in QUERIES["legal_arcs"](spark, "").collect()}
    arcs = {(1, 5, f"10,{a},{b},16", 65.0 + m + n, True, k) for k, (a, m, b, n) in enumerate(CHOICES, 1)}
    assert got == arcs | {(1, 5, "20,22", 1.5, False, 7), (100, 130, ",".join(str(100 + i) for i in range(30)), 30.0, False, 1)}


def test_ways_between_cross_sections_have_no_budget(spark):
    edges = spark.createDataFrame([(layer * 10 + i, (layer + 1) * 10 + j, layer * 100 + i * 10 + j, 1.0) for layer in range(6) for i in range(1 if layer == 0 else 6) for j in range(1 if layer == 5 else 6)], EDGE)
    fixed = spark.createDataFrame([(0,), (60,)], "node_id long")
    got = network.numbered_ways(network.graph_compress(edges, fixed, by_neighbours=True), fixed).collect()
    assert sorted(r["arc_no"] for r in got) == list(range(1, 6**5 + 1)) and len({tuple(r["edge_ids"]) for r in got}) == 6**5


def test_walks_lose_no_source(spark):
    chain = [(i, i + 1, i, 1.0) for i in range(11)]
    fan = [(100, 101 + k, 200 + k, 1.0) for k in range(3)] + [(101 + k, 110, 210 + k, 1.0) for k in range(3)] + [(110, 100, 220, 1.0)]
    edges = spark.createDataFrame(chain + fan, EDGE)
    fixed = spark.createDataFrame([(0,), (11,), (100,), (110,)], "node_id long")
    got = {(r["src"], r["dst"], tuple(r["edge_ids"] or ()), r["overflow"]) for r in network.walks(network.as_paths(edges), fixed, fixed, 5).collect()}
    ways = {(100, 110, (200 + k, 210 + k), False) for k in range(3)} | {(110, 100, (220,), False)}
    assert got == ways | {(0, None, (), True)}
    got = {(r["src"], r["dst"], tuple(r["edge_ids"]), r["overflow"]) for r in network.walks(network.as_paths(edges), fixed, fixed, 11).collect()}
    assert got == ways | {(0, 11, tuple(range(11)), False)}


def test_legal_arcs_of_any_length(spark):
    edges = spark.range(3000).selectExpr("id AS src", "id + 1 AS dst", "id AS edge_id", "1D AS length_m")
    fixed = spark.createDataFrame([(0,), (3000,)], "node_id long")
    (arc,) = network.legal_arcs(network.graph_compress(edges, fixed), fixed).collect()
    assert (arc["src"], arc["dst"], arc["length_m"], arc["arc_no"]) == (0, 3000, 3000.0, 1)


def test_each_class_of_terminal_ownership(spark):
    rows = [
        (1, 10, 1), (1, 10, 2),  # two accepted anchors of one source
        (2, 20, 3), (3, 20, 4),  # two sources
        (4, 90, 5), (4, 91, 6), (90, 92, 7), (91, 92, 8), (92, 30, 9), (4, 30, 10),  # two ways of one source
        (5, 40, 11), (95, 40, 12),  # an anchor that nothing leads to
    ]
    edges = spark.createDataFrame([(*r, 1.0) for r in rows], EDGE)
    fixed = spark.createDataFrame([(i,) for i in (1, 2, 3, 4, 5, 10, 20, 30, 40)], "node_id long")
    paths = network.graph_compress(edges, fixed)
    got = {r["dst"]: (r["owner_status"], r["owner"], r["n_anchors"], r["n_accepted"]) for r in network.terminal_ownership(paths, fixed).collect()}
    assert got == {10: ("unique_owner", 1, 2, 2), 20: ("multi_owner", None, 2, 2), 30: ("ambiguous_owner", None, 2, 1), 40: ("no_owner", None, 2, 1)}
    cut = {r["dst"]: (r["owner_status"], r["n_overflow"]) for r in network.terminal_ownership(paths, fixed, 1).collect()}
    assert cut[30] == ("ambiguous_owner", 1) and cut[20] == ("multi_owner", 0)


def test_each_class_of_bridges_and_a_dense_graph(spark):
    direct = [(1, 2), (2, 3), (4, 5), (5, 6), (4, 7), (7, 6), (10, 11), (11, 12), (12, 13), (20, 21)]
    dense = [(100 + i, 100 + j) for i in range(9) for j in range(9) if i != j and (i, j) != (0, 8)]
    direct = spark.createDataFrame(direct + dense, "src long, dst long")
    asked = spark.createDataFrame([(1, 3), (4, 6), (10, 13), (20, 30), (20, 31), (1, 2), (100, 108), (3, 1)], "src long, dst long")
    traced = spark.createDataFrame([(20, 31), (20, None)], "src long, dst long")
    run = lambda **more: {(r["src"], r["dst"]): (r["bridge"], r["n_paths"], r["n_middle"], r["overflow"]) for r in network.bridge_paths(asked, direct, traced, **more).collect()}
    small = {(1, 3): ("unique", 1, 1, False), (4, 6): ("ambiguous", 2, 2, False), (10, 13): ("gap", 1, 0, False), (20, 30): ("reject", 0, 0, False), (20, 31): ("gap", 0, 0, False), (3, 1): ("reject", 0, 0, False)}
    assert run() == {**small, (100, 108): ("ambiguous", 32, 7, False)}
    # 7 partial paths of one hop, then 13 of 49 with two, of which one has arrived; middles need no budget.
    assert run(budget=20) == {**small, (100, 108): ("ambiguous", 1, 7, True)}


def test_each_signal_of_shared_downstream_explains_a_row(spark):
    rows = [
        ("node", 1, 10, [1, 50, 10], [1, 2], 0.0, True), ("node2", 2, 10, [2, 50, 10], [3, 4], 100.0, True),
        ("edge", 3, 20, [3, 60, 20], [5, 6], 0.0, True), ("edge2", 4, 20, [4, 61, 20], [7, 6], 100.0, True),
        ("end", 5, 30, [5, 30], [8], 0.0, True), ("end2", 6, 30, [6, 30], [9], 5.0, True), ("far", 7, 30, [7, 30], [10], 11.0, True),
        ("same source", 8, 40, [8, 70, 40], [11, 12], 0.0, True), ("same source 2", 8, 40, [8, 70, 40], [13, 12], 0.0, True),
        ("no peer", 9, 80, [9, 71, 80], [14, 15], 0.0, True), ("not a peer", 11, 80, [11, 71, 80], [16, 15], 0.0, False), ("direct", 12, 90, [12, 90], [17], None, True),
    ]
    df = spark.createDataFrame([(*r[:6], 0.0, r[6]) for r in rows], "arc_id string, src long, dst long, nodes array<long>, edge_ids array<long>, end_x double, end_y double, is_peer boolean")
    got = {r["arc_id"]: (r["shared_nodes"], r["shared_edges"], [x.split("_")[1] for x in r["signals"][1:]], r["structure"]) for r in arcs.shared_downstream(df).collect()}
    merge, single = "merge_multi_upstream", ([], [], [], "single")
    assert got == {
        "node": ([50], [], ["intermediate"], merge), "node2": ([50], [], ["intermediate"], merge), "edge": ([], [6], ["topology"], merge), "edge2": ([], [6], ["topology"], merge),
        "end": ([], [], ["terminal"], merge), "end2": ([], [], ["terminal"], merge), "far": single, "same source": single, "same source 2": single, "no peer": single,
        "not a peer": ([71], [15], ["intermediate", "topology", "terminal"], merge), "direct": single,
    }


def test_components_and_offsets_of_a_long_path(spark):
    rows = [(i, i + 1, 0.5) for i in range(60)] + [(200, 201, 1.0), (201, 202, 1.0), (202, 201, 1.0), (202, 203, 1.0), (300, 301, 1.0), (301, 300, 2.0), (400, 401, 1.0), (400, 402, 5.0), (401, 402, 1.0)]
    got = {r["node_id"]: (r["component"], r["offset_m"], r["is_dag"]) for r in network.chain_offsets(spark.createDataFrame(rows, "src long, dst long, dist_m double")).collect()}
    want = {i: (0, 0.5 * i, True) for i in range(61)} | {200 + i: (200, float(i), False) for i in range(4)}
    assert got == want | {300: (300, 0.0, False), 301: (300, 1.0, False), 400: (400, 0.0, True), 401: (400, 1.0, True), 402: (400, 2.0, True)}


def test_arm_cluster_against_plain_loops(spark):
    rnd = random.Random(5)
    rows = [(i, 100 * i + k, float(rnd.choice([rnd.randrange(360), 30 * rnd.randrange(12)]))) for i in range(40) for k in range(rnd.randrange(1, 9))]
    rows += [(90, 1, 0.0), (90, 2, 40.0), (90, 3, 80.0), (91, 1, 10.0), (91, 2, 350.0)]
    want = {}
    for i in {r[0] for r in rows}:
        arms = []
        for angle, k in sorted((a, k) for j, k, a in rows if j == i):
            best = None
            for n, members in enumerate(arms):
                sx, sy = sum(math.cos(math.radians(m)) for m in members), sum(math.sin(math.radians(m)) for m in members)
                mean = members[0] if max(abs(sx), abs(sy)) <= 1e-9 else math.degrees(math.atan2(sy, sx))
                gap = round(abs((angle - mean + 180) % 360 - 180), 7)
                if gap <= 40 and (best is None or gap < best[0]):
                    best = gap, n
            if best is None:
                arms.append([])
                best = 0, len(arms) - 1
            arms[best[1]].append(angle)
            want[(i, k)] = best[1]
    got = movements.arm_cluster(spark.createDataFrame(rows, "intersection_id long, approach_id long, angle double")).collect()
    assert {(r["intersection_id"], r["approach_id"]): r["arm"] for r in got} == want


def test_support_deconflict_against_all_assignments(spark):
    rnd = random.Random(6)
    rows = [(p, 0, a, s, rnd.randrange(4), float(rnd.randrange(5)), rnd.randrange(3) / 2) for p in range(40) for a in range(rnd.randrange(1, 5)) for s in rnd.sample(range(5), rnd.randrange(1, 4))]
    got = assembly.support_deconflict(spark.createDataFrame(rows, "src long, dst long, arc_id long, support long, rank int, dist double, coverage double")).collect()
    for p in range(40):
        own = [r for r in rows if r[0] == p]
        arcs = sorted({r[2] for r in own})
        worth = {(a, s): (1, -r, -d, c) for _, _, a, s, r, d, c in own}

        def score(picks, worth=worth, arcs=arcs):
            return tuple(map(sum, zip((0, 0, 0, 0), *[worth[x] for x in zip(arcs, picks) if x[1] is not None])))

        options = [[None, *[r[3] for r in own if r[2] == a]] for a in arcs]
        best = max(score(picks) for picks in itertools.product(*options) if len({x for x in picks if x is not None}) == sum(x is not None for x in picks))
        mine = {r["arc_id"]: r["support"] for r in got if r["src"] == p}
        assert sorted(mine) == arcs
        picks = [mine[a] for a in arcs]
        assert len({x for x in picks if x is not None}) == sum(x is not None for x in picks)
        assert score(picks) == pytest.approx(best)


def test_segment_cluster_against_plain_loops(spark):
    rnd = random.Random(7)
    rows = []
    for g in range(12):
        for k in range(rnd.randrange(1, 10)):
            y = rnd.randrange(30)
            rows.append((g, 100 * g + k, float(rnd.randrange(25)), rnd.choice(["traj", "prior"]), rnd.sample(range(9), rnd.randrange(4)), [(0.0, float(y)), (float(rnd.randrange(5, 30)), float(y + rnd.randrange(3)))]))
    rows += [(50, 1, 0.0, "traj", [1], [(0.0, 0.0), (10.0, 10.0)]), (50, 2, 1.0, "traj", [2, 3], [(0.0, 10.0), (10.0, 0.0)]), (51, 1, 0.0, "prior", [], [(0.0, 0.0), (9.0, 0.0)]), (51, 2, 6.5, "prior", [], [(0.0, 0.0), (9.0, 0.0)])]

    def gap(a, b):
        """By sampling one line closely against the other."""
        spots = lambda line: [(line[0][0] + t / 400 * (line[1][0] - line[0][0]), line[0][1] + t / 400 * (line[1][1] - line[0][1])) for t in range(401)]
        return min(math.dist(p, q) for p in spots(a)[::4] for q in spots(b)[::4])

    want = {}
    for g in {r[0] for r in rows}:
        groups = []
        for row in sorted((r for r in rows if r[0] == g), key=lambda r: (r[2], r[1])):
            home = next((x for x in groups if abs(row[2] - x[0][2]) <= 6 and gap(row[5], x[0][5]) <= 5.05), None)
            if home is None:
                groups.append([row])
            else:
                home.append(row)
        for rank, members in enumerate(sorted(groups, key=lambda x: sum(r[2] for r in x) / len(x)), 1):
            best = min(members, key=lambda r: (r[3] != "traj", -len(r[4]), -round(math.dist(*r[5]), 9), (r[2], r[1])))
            kinds = {r[3] for r in members}
            reason = "mixed_support" if len(kinds) > 1 else {"prior": "prior_only_cluster", "traj": "traj_supported_cluster"}[kinds.pop()]
            for r in members:
                want[g, r[1]] = rank, len(members), r is best, len({t for m in members for t in m[4]}), reason
    df = spark.createDataFrame(rows, "src long, segment_id long, offset double, source string, supports array<long>, line array<struct<x:double,y:double>>")
    got = {(r["src"], r["segment_id"]): (r["cluster"], r["size"], r["representative"], r["n_support"], r["reason"]) for r in assembly.segment_cluster(df, ["src"]).collect()}
    assert {k: v for k, v in got.items() if k[0] < 50} == {k: v for k, v in want.items() if k[0] < 50}
    assert [got[50, k][:3] for k in (1, 2)] == [(1, 2, False), (1, 2, True)]
    assert [got[51, k][0] for k in (1, 2)] == [1, 2]


def test_zones_keep_patches_apart(spark):
    """One square in each of two patches, and no nested loop in the plan."""
    corners = [(0.0, 0.0), (120.0, 0.0), (120.0, 60.0), (0.0, 60.0)]
    edges = [(p, 7, *(c + p * 1000.0 * (i == 0) for i, c in enumerate(a)), *(c + p * 1000.0 * (i == 0) for i, c in enumerate(b))) for p in (0, 1) for a, b in zip(corners, corners[1:] + corners[:1])]
    zone = spark.createDataFrame(edges, "patch_id long, poly_id long, x1 double, y1 double, x2 double, y2 double")
    points = spark.createDataFrame([(p, 50.0 + 1000 * q, 30.0) for p in (0, 1) for q in (0, 1)], "patch_id long, x double, y double")
    assert {(r["patch_id"], r["x"]) for r in zones.point_in_zone(points, zone, ["patch_id"]).collect()} == {(0, 50.0), (1, 1050.0)}
    traj = spark.createDataFrame([(p, 1, k, -50.0 + 110 * k, 20.0 + 10 * k) for p in (0, 1) for k in range(4)], "patch_id long, traj_id long, seq long, x double, y double")
    pieces = zones.line_zone_pieces(zones.segments(traj, ["patch_id", "traj_id"]), zone, ["patch_id", "traj_id"])
    got = pieces.collect()
    assert [(r["patch_id"], r["piece"]) for r in got] == [(0, 1)]
    scale = math.hypot(110, 10) / 110
    assert (got[0]["start_s"], got[0]["end_s"]) == (pytest.approx(50 * scale), pytest.approx(170 * scale))
    plan = pieces._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_crossings_of_slanted_cross_sections(spark):
    rnd = random.Random(8)
    xsecs = [(n, rnd.uniform(0, 300), rnd.uniform(0, 50), rnd.uniform(0, 300), rnd.uniform(0, 50)) for n in range(15)]
    vertices = [(0, t, k, 20.0 * k, rnd.uniform(0, 50)) for t in range(6) for k in range(15)]
    want = set()
    for t in range(6):
        line = [v[3:] for v in vertices if v[1] == t]
        for n, ax, ay, bx, by in xsecs:
            for (x1, y1), (x2, y2) in zip(line, line[1:]):
                side = lambda px, py: (bx - ax) * (py - ay) - (by - ay) * (px - ax)  # noqa: E731, B023
                over = lambda px, py: (x2 - x1) * (py - y1) - (y2 - y1) * (px - x1)  # noqa: E731, B023
                if side(x1, y1) * side(x2, y2) < 0 and over(ax, ay) * over(bx, by) < 0:
                    want.add((t, n))
    lines = zones.segments(spark.createDataFrame(vertices, "patch_id long, traj_id long, seq long, x double, y double"), ["traj_id"])
    got = zones.crossing_events(lines, spark.createDataFrame(xsecs, "node_id long, x1 double, y1 double, x2 double, y2 double"), ["traj_id"])
    assert {(r["traj_id"], r["node_id"]) for r in got.collect()} == want
    assert got.where(F.col("seq_at") < 0).count() == 0


def test_chain_line_merge_against_plain_loops(spark):
    rnd = random.Random(9)
    nodes = {n: (rnd.random() < 0.7, rnd.random() < 0.7, rnd.random() < 0.1, float(rnd.randrange(40)), rnd.choice([None, float(n)]), *(float(rnd.randrange(9)) for _ in range(4))) for n in range(60)}
    edges = sorted({(n // 10, n, 10 * (n // 10) + rnd.randrange(10)): float(rnd.randrange(1, 9)) for n in range(60) for _ in range(3)}.items())
    edges = [(*k, m) for k, m in edges if k[1] != k[2]]

    def gap(a, b):
        spots = lambda x1, y1, x2, y2: [(x1 + t / 200 * (x2 - x1), y1 + t / 200 * (y2 - y1)) for t in range(201)]
        side = lambda p, q, r: (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
        p, q, r, s = a[:2], a[2:], b[:2], b[2:]
        if side(p, q, r) * side(p, q, s) < 0 and side(r, s, p) * side(r, s, q) < 0:
            return 0.0
        return min(math.dist(x, y) for x in spots(*a) for y in spots(*b))

    want = set()
    for c in range(6):
        used = set()
        for _, a, b, m in sorted((e for e in edges if e[0] == c), key=lambda e: (e[3], e[1], e[2])):
            nearest = min((e[3], e[1]) for e in edges if e[2] == b)[1]
            s, t = nodes[a], nodes[b]
            if a in used or b in used or not s[0] or not t[1] or s[2] or t[2] or s[3] >= t[3] or nearest != a or gap(s[5:], t[5:]) > 1.001:
                continue
            used |= {a, b}
            merged = None if s[4] is None or t[4] is None else ((s[4] + t[4]) / 2, abs(s[4] - t[4]))
            want.add((c, a, b, a if round(math.dist(s[5:7], s[7:]), 9) >= round(math.dist(t[5:7], t[7:]), 9) else b, merged))
    df = spark.createDataFrame([(n, *v) for n, v in nodes.items()], "node_id long, diverge boolean, merge boolean, failed boolean, offset_m double, at_s double, x1 double, y1 double, x2 double, y2 double")
    got = evidence.chain_line_merge(spark.createDataFrame(edges, "component long, src long, dst long, dist_m double"), df).collect()
    assert {(r["component"], r["src"], r["dst"], r["keeper"], None if r["merged_s"] is None else (r["merged_s"], r["apart_m"])) for r in got} == want and want
    assert len(got) == len(want)


def test_chain_line_merge_along_one_chain(spark):
    """Every node diverges and merges, so each choice hangs on the one before it."""
    chain = [(1, n, n + 1, float(n)) for n in range(1, 8)]
    nodes = [(n, True, True, False, float(n), None, 0.0, 0.0, 1.0, 0.0) for n in range(1, 9)]
    df = spark.createDataFrame(nodes, "node_id long, diverge boolean, merge boolean, failed boolean, offset_m double, at_s double, x1 double, y1 double, x2 double, y2 double")
    got = evidence.chain_line_merge(spark.createDataFrame(chain, "component long, src long, dst long, dist_m double"), df).collect()
    assert {(r["src"], r["dst"], r["merged_s"]) for r in got} == {(1, 2, None), (3, 4, None), (5, 6, None), (7, 8, None)}
    assert {r["how"] for r in got} == {"geom_intersects"}
