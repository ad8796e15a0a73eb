import heapq
import math
import random

from pyspark.sql import functions as F

from roadloom.operators import assembly, evidence, lane_graph, zones
from roadloom.operators.nearest import k_nearest
from roadloom.plans.stitching_queries import lane_pairs

SEG = "patch_id long, lane_id long, seq long, x1 double, y1 double, x2 double, y2 double"
PAIR = "patch_id long, src long, dst long, " + ", ".join(f"{p}{c} double" for p in "sd" for c in ("x1", "y1", "x2", "y2"))
EDGE = "poly_id long, edge_ix int, x1 double, y1 double, x2 double, y2 double"


def distance(px, py, x1, y1, x2, y2):
    n = (x2 - x1) ** 2 + (y2 - y1) ** 2
    t = max(0.0, min(1.0, ((px - x1) * (x2 - x1) + (py - y1) * (y2 - y1)) / n)) if n else 0.0
    return math.hypot(px - x1 - t * (x2 - x1), py - y1 - t * (y2 - y1))


def dijkstra(segments, pairs, snap, k, cost=lambda s: math.hypot(s[5] - s[3], s[6] - s[4])):
    """The least cost of each pair over all nodes, one pair after the other."""
    spots, ways = {}, {}
    for s in segments:
        if math.hypot(s[5] - s[3], s[6] - s[4]) <= 1e-6 or cost(s) is None:
            continue
        u, v = ((s[0], math.floor(x / snap), math.floor(y / snap)) for x, y in (s[3:5], s[5:7]))
        if u == v:
            continue
        for node, p in ((u, tuple(s[3:5])), (v, tuple(s[5:7]))):
            spots[node] = min(spots.get(node, p), p)
        ways.setdefault(u, []).append((v, cost(s)))
        ways.setdefault(v, []).append((u, cost(s)))
    out = {}
    for p in pairs:
        own = [n for n in spots if n[0] == p[0]]
        rank = lambda box: sorted(own, key=lambda n: (round(distance(*spots[n], *box), 9), n))[:k]
        s, d = rank(p[3:7]), rank(p[7:11])
        rest = [n for n in d if n not in s]
        if rest:
            d = rest
        elif set(s) == set(d):
            other = d[0] if d[0] != s[0] or len(d) == 1 else d[1]
            s, d = s[:1], [other]
        best, heap, done = None, [(0.0, n, 0) for n in s], {}
        while heap:
            c, n, steps = heapq.heappop(heap)
            if n in d and steps:
                best = c
                break
            if n in done:
                continue
            done[n] = c
            for m, w in ways.get(n, []):
                heapq.heappush(heap, (c + w, m, steps + 1))
        if best is not None:
            out[tuple(p[:3])] = round(best, 6)
    return out


def segs(spark, rows):
    return spark.createDataFrame(rows, SEG).withColumns({"seg_m": F.sqrt((F.col("x2") - F.col("x1")) ** 2 + (F.col("y2") - F.col("y1")) ** 2), "s1": F.lit(0.0)})


def box(i, x1, y1, x2, y2):
    corners = [(x1, y1), (x2, y1), (x2, y2), (x1, y2)]
    return [(i, k, *map(float, a), *map(float, b)) for k, (a, b) in enumerate(zip(corners, corners[1:] + corners[:1]))]


def test_costs_match_dijkstra(spark):
    rnd = random.Random(4)
    rows, pairs = [], []
    for patch in range(2):
        for lane in range(15):
            x, y = rnd.randrange(12) * 10.0, rnd.randrange(12) * 10.0
            for seq in range(rnd.randrange(1, 12)):
                dx, dy = rnd.choice([(10.0, 0.0), (0.0, 10.0), (10.0, 10.0), (-10.0, 0.0)])
                rows.append((patch, lane, seq, x, y, x + dx, y + dy))
                x, y = x + dx, y + dy
        for i in range(6):
            pairs.append((patch, i, i + 10, *[rnd.randrange(120) + 0.5 for _ in range(8)]))
    got = lane_graph.lane_graph_path(segs(spark, rows), spark.createDataFrame(pairs, PAIR), k=2).collect()
    assert {(r.patch_id, r.src, r.dst): round(r.cost, 6) for r in got} == dijkstra(rows, pairs, 1.0, 2)
    for r in got:  # the line is as long as it says
        assert abs(sum(math.dist(a, b) for a, b in zip(r.line, r.line[1:])) - r.length_m) < 1e-6


def test_the_view_against_dijkstra(spark, data):
    boundaries, pairs = lane_pairs(spark, data)
    rows = [(r.patch_id, r.lane_id, r.seq, r.x1, r.y1, r.x2, r.y2) for r in boundaries.collect()]
    asked = [(r.patch_id, r.src, r.dst, r.sx1, r.sy1, r.sx2, r.sy2, r.dx1, r.dy1, r.dx2, r.dy2) for r in pairs.collect()]
    got = {(r.patch_id, r.src, r.dst): round(r.cost, 6) for r in lane_graph.lane_graph_path(boundaries, pairs).collect()}
    want = dijkstra(rows, asked, 1.0, 3)
    assert got.keys() == want.keys() and got
    assert all(abs(got[k] - want[k]) < 1e-5 for k in got)


def test_dividers_drop_edges_and_the_outside_costs(spark):
    # A straight lane from x = 0 to 40 and a way round it at y = 20.
    rows = [(0, 1, i, 10.0 * i, 0.0, 10.0 * i + 10, 0.0) for i in range(4)]
    rows += [(0, 2, 0, 0.0, 0.0, 0.0, 20.0), (0, 2, 1, 0.0, 20.0, 40.0, 20.0), (0, 2, 2, 40.0, 20.0, 40.0, 0.0)]
    pairs = spark.createDataFrame([(0, 7, 8, -1.0, -1.0, -1.0, 1.0, 41.0, -1.0, 41.0, 1.0)], PAIR)
    run = lambda **more: [(round(r.cost, 6), round(r.length_m, 6), r.n_edges) for r in lane_graph.lane_graph_path(segs(spark, rows), pairs, k=1, **more).collect()]
    zone = lambda *boxes: spark.createDataFrame([e for i, b in enumerate(boxes) for e in box(i, *b)], EDGE)
    assert run(dividers=zone((18, -2, 19, 2))) == [(80.0, 80.0, 3)]
    # Two touching zones are one: nothing of the way round lies outside.
    around = ((-5, 5, 20, 25), (20, 5, 45, 25))
    assert run(surface=zone(*around), outside_cost=3.0) == [(110.0, 80.0, 3)]  # 80 + 3 * 10 outside, the straight one 160
    assert run(surface=zone(*around), most_outside=0.0) == [(40.0, 40.0, 1)]  # its ends are the nearest nodes that are left


def test_k_nearest_at_any_distance(spark):
    rnd = random.Random(9)
    points = [(p, i, rnd.uniform(0, 3000), rnd.uniform(0, 20)) for p in range(3) for i in range(60)]
    lines = [(p, j, *[rnd.uniform(-2000, 6000) for _ in range(4)]) for p in range(4) for j in range(8)]
    targets = spark.createDataFrame([(p, i, x, y, x, y) for p, i, x, y in points], "patch_id long, i long, x1 double, y1 double, x2 double, y2 double")
    asked = spark.createDataFrame(lines, "patch_id long, j long, x1 double, y1 double, x2 double, y2 double")
    got = {}
    for r in k_nearest(asked, targets, ["patch_id"], ["j"], ["i"], 4).collect():
        got.setdefault((r.patch_id, r.j), {})[r.place] = r.i
    want = {}
    for p, j, *seg in lines:
        near = sorted((round(distance(x, y, *seg), 9), i) for q, i, x, y in points if q == p)[:4]
        if near:
            want[(p, j)] = {n + 1: i for n, (_, i) in enumerate(near)}
    assert got == want


def test_arc_fit_against_plain_loops(spark):
    rnd = random.Random(12)
    line = lambda n: [(rnd.uniform(0, 400), rnd.uniform(0, 400)) for _ in range(n)]
    cands, arcs = {i: line(rnd.randrange(2, 6)) for i in range(6)}, {i: line(rnd.randrange(2, 6)) for i in range(10, 16)}

    def table(lines, by):
        rows = [(i, k, *p) for i, pts in lines.items() for k, p in enumerate(pts)]
        return zones.segments(spark.createDataFrame(rows, f"{by} long, seq long, x double, y double"), [by])

    pairs = [(i, j) for i in cands for j in arcs if (i + j) % 3]
    got = {(r.cand_id, r.arc_id): r for r in assembly.arc_fit(table(cands, "cand_id"), table(arcs, "arc_id"), spark.createDataFrame(pairs, "cand_id long, arc_id long")).collect()}
    assert set(got) == set(pairs)
    for i, j in pairs:
        a, b = cands[i], arcs[j]
        one = lambda p, q: max(min(distance(*v, *s, *e) for s, e in zip(q, q[1:])) for v in p)
        length = lambda p: sum(math.dist(x, y) for x, y in zip(p, p[1:]))
        assert abs(got[i, j].line_m - max(one(a, b), one(b, a))) < 1e-6
        assert abs(got[i, j].anchor_m - math.dist(a[0], b[0]) - math.dist(a[-1], b[-1])) < 1e-6
        assert abs(got[i, j].length_gap_m - abs(length(a) - length(b))) < 1e-6


def test_one_zone_of_touching_and_overlapping_polygons(spark):
    from roadloom.operators import anchors

    scan = spark.createDataFrame([(1, 0, 0.0, 0.0, -20.0, 0.0, 20.0), (1, 1, 1.0, 50.0, -20.0, 50.0, 20.0), (1, 2, 2.0, 90.0, -20.0, 90.0, 20.0)], "node_id long, k int, s double, x1 double, y1 double, x2 double, y2 double")
    touching, overlapping, apart = (box(1, -5, -10, 5, 0) + box(2, -5, 0, 5, 10)), (box(3, 45, -10, 55, 3) + box(4, 45, -2, 55, 10)), (box(5, 85, -10, 95, -2) + box(6, 85, 2, 95, 10))
    pieces = anchors.scan_pieces(scan, spark.createDataFrame(touching + overlapping + apart, EDGE))
    assert sorted((r.k, r.piece, round(r.start_s, 6), round(r.end_s, 6)) for r in pieces.collect()) == [(0, 1, 10.0, 30.0), (1, 1, 10.0, 30.0), (2, 1, 10.0, 18.0), (2, 2, 22.0, 30.0)]
    (split,) = anchors.first_split(scan, pieces).collect()
    assert (split.split_s, split.most_pieces) == (2.0, 2)


def test_samples_have_both_ends(spark):
    rows = spark.createDataFrame([(1, 0.0, 0.0, 4.5, 0.0), (2, 0.0, 0.0, 0.0, 0.3), (3, 1.0, 1.0, 1.0, 1.0), (4, 0.0, 0.0, 3.0, 0.0)], "node_id long, x1 double, y1 double, x2 double, y2 double")
    got = {}
    for r in evidence.samples(rows).orderBy("i").collect():
        got.setdefault(r.node_id, []).append(round(r.s, 6))
    assert got == {1: [0.0, 0.9, 1.8, 2.7, 3.6, 4.5], 2: [0.0, 0.3], 4: [0.0, 1.0, 2.0, 3.0]}


def test_barriers_that_vehicles_pass_are_cut_out(spark):
    xsec = spark.createDataFrame([(0, 1, 0.0, 0.0, 0.0, 30.0), (0, 2, 100.0, 0.0, 100.0, 3.0)], "patch_id long, node_id long, x1 double, y1 double, x2 double, y2 double")
    wall = [(0, 0.0, y + 0.1 * k) for y in (5, 6, 7, 8, 20, 21, 22, 23, 27, 28, 29) for k in range(2)] + [(0, 100.0, y) for y in (0.0, 1.0, 2.0, 3.0) for _ in range(2)]
    points = spark.createDataFrame(wall, "patch_id long, x double, y double")
    traj = spark.createDataFrame([(0, -60.0 + 2 * i + 0.5, 6.2) for i in range(60)] + [(0, 1.0, 21.0)], "patch_id long, x double, y double")
    runs = evidence.barrier_runs(xsec, points, traj, radius=0.5)
    got = {(r.node_id, r.run): (r.start_s, r.end_s, r.n_samples, r.final) for r in runs.collect()}
    # Four samples make four metres; three don't. Only the first wall is driven along.
    assert got == {(1, 1): (5.0, 8.0, 4, True), (1, 2): (20.0, 23.0, 4, False), (2, 1): (0.0, 3.0, 4, False)}
    parts = sorted((r.node_id, r.part, r.start_s, r.end_s) for r in evidence.barrier_parts(xsec, runs, radius=0.5).collect())
    assert parts == [(1, 1, 0.0, 4.5), (1, 2, 8.5, 30.0), (2, 1, 0.0, 3.0)]
    assert not [r for r in evidence.barrier_runs(xsec, points, radius=0.5).collect() if r.final]
