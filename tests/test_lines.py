import math
import random

import pytest

from roadloom.operators import anchors, assembly, evidence, profiles, series, zones
from roadloom.operators import arcs as arcs_


def test_crosslines_end_on_the_branches_of_a_fork(spark):
    nodes = spark.createDataFrame([(1, 0.0, 0.0, 1.0, 0.0, 6.0), (2, 0.0, 0.0, 1.0, 0.0, 2.0)], "node_id long, x double, y double, ux double, uy double, stop_m double")
    # Branch a bends at x = 2 and ends at x = 4; b goes straight. Node 2 has one branch.
    rows = [(1, "a", 0, 0.0, 0.0, 2.0, 1.0), (1, "a", 1, 2.0, 1.0, 4.0, 5.0), (1, "b", 0, 0.0, 0.0, 10.0, -10.0), (2, "a", 0, 0.0, 0.0, 9.0, 9.0)]
    branches = spark.createDataFrame(rows, "node_id long, branch string, seq int, x1 double, y1 double, x2 double, y2 double")
    got = {(r.node_id, r.k): tuple(round(x, 6) for x in (r.x1, r.y1, r.x2, r.y2, r.seg_m)) + (r.a_hit, r.b_hit) for r in anchors.between_branches(nodes, branches, step=1.0).collect()}
    ahead = [(0.0, 0.0), (1.0, 0.5), (2.0, 1.0), (3.0, 3.0), (4.0, 5.0)]
    want = {(1, k): (x, y, float(k), -float(k), round(y + k, 6), True, True) for k, (x, y) in enumerate(ahead)}
    for k in (5, 6):  # beyond branch a its end is nearest
        want[(1, k)] = (4.0, 5.0, float(k), -float(k), round(math.hypot(k - 4, k + 5), 6), False, True)
    assert got == want


def test_a_split_between_widening_branches(spark):
    nodes = spark.createDataFrame([(1, 0.0, 0.0, 1.0, 0.0, 8.0)], "node_id long, x double, y double, ux double, uy double, stop_m double")
    branches = spark.createDataFrame([(1, "a", 0, 0.0, 0.0, 10.0, 10.0), (1, "b", 0, 0.0, 0.0, 10.0, -10.0)], "node_id long, branch string, seq int, x1 double, y1 double, x2 double, y2 double")
    scan = anchors.between_branches(nodes, branches)
    # The zone is all but a wedge-free gap of |y| < 1 from x = 4 on, and reaches far beyond the branches.
    box = lambda i, x1, y1, x2, y2: [(i, k, *a, *b) for k, (a, b) in enumerate(zip([(x1, y1), (x2, y1), (x2, y2), (x1, y2)], [(x2, y1), (x2, y2), (x1, y2), (x1, y1)]))]
    zone = box(1, -1.0, -99.0, 3.5, 99.0) + box(2, 3.5, 1.0, 20.0, 99.0) + box(3, 3.5, -99.0, 20.0, -1.0)
    pieces = anchors.scan_pieces(scan, spark.createDataFrame(zone, "poly_id long, edge_ix int, x1 double, y1 double, x2 double, y2 double"))
    got = sorted((r.k, r.piece, round(r.end_s - r.start_s, 6)) for r in pieces.collect())
    assert got == [(1, 1, 2.0), (2, 1, 4.0), (3, 1, 6.0)] + [(k, p, k - 1.0) for k in range(4, 9) for p in (1, 2)]
    (split,) = anchors.first_split(scan, pieces).collect()
    assert split.split_s == 4.0


def test_slew_limit_and_edges_against_plain_loops(spark):
    rnd = random.Random(8)
    rows = [(t, i, rnd.uniform(-3, 3)) for t in range(6) for i in range(rnd.choice([1, 2, 3, 9, 20]))]
    got = {(r.t, r.i): r.v for r in series.offset_smooth(spark.createDataFrame(rows, "t long, i long, v double"), ["t"], "i", "v", most_step=0.2).collect()}
    for t in range(6):
        x = [v for u, _, v in rows if u == t]
        for _ in range(2):
            x = [sum(x[min(max(i + j, 0), len(x) - 1)] for j in range(-2, 3)) / 5 for i in range(len(x))]
        for i in range(1, len(x)):
            x[i] = min(max(x[i], x[i - 1] - 0.2), x[i - 1] + 0.2)
        assert [got[t, i] for i in range(len(x))] == pytest.approx(x)


def test_slew_limit_passes_over_nulls(spark):
    rows = spark.createDataFrame([(1, 0, None), (1, 1, 0.0), (1, 2, None), (1, 3, 5.0), (1, 4, 5.0), (2, 0, 9.0)], "t long, i long, v double")
    assert [(r.t, r.i, r.v) for r in series.slew_limit(rows, ["t"], "i", "v", 1.0).orderBy("t", "i").collect()] == [(1, 0, None), (1, 1, 0.0), (1, 2, None), (1, 3, 1.0), (1, 4, 2.0), (2, 0, 9.0)]


def test_channel_labels_against_plain_loops(spark):
    rnd = random.Random(6)
    rows = []
    for g in range(12):
        n = rnd.choice([1, 3, 4, 10, 60])
        rows += [(g, i, rnd.gauss(0, 1) + 30 * rnd.choice([0, 0, 0, g % 3]), rnd.gauss(0, 1)) for i in range(n)]
    got = {}
    for r in profiles.channel_labels(spark.createDataFrame(rows, "g long, i long, x double, y double"), ["g"], "i", 8.0, top=20).collect():
        got.setdefault(r.g, {})[r.i] = (r.label, r.kept, r.n_clusters, r.main_label, r.multi)
    for g in range(12):
        items = [(x, y) for h, _, x, y in rows if h == g]
        first = items[:20]
        ref = min(range(len(first)), key=lambda k: (round(sum(math.dist(first[k], p) for p in first), 6), k))
        away = [round(math.dist(p, first[ref]), 9) for p in items]
        centres, size = [], 0
        for v in sorted(away[:20]):
            if centres and v - centres[-1] <= 3.6:
                size += 1
                centres[-1] += (v - centres[-1]) / size
            else:
                centres.append(v)
                size = 1
        labels = [min(range(len(centres)), key=lambda c: (round(abs(v - centres[c]), 9), c)) for v in away]
        if len(items) < 4 or len(centres) < 2:
            assert got[g] == {i: (0, True, 1, 0, False) for i in range(len(items))}
            continue
        main = min(set(labels), key=lambda c: (-labels.count(c), c))
        multi = centres[-1] - centres[0] > 8
        assert got[g] == {i: (c, not multi or c == main, len(centres), main, multi) for i, c in enumerate(labels)}


def test_a_fused_line_is_as_long_as_its_arc(spark):
    points = [(0.0, 0.0), (30.0, 0.0), (30.0, 40.0), (70.0, 40.0)]
    arc_rows = [(a, i, *p) for a in (1, 2) for i, p in enumerate(points)]
    arc_lines = zones.segments(spark.createDataFrame(arc_rows, "arc_id long, seq long, x double, y double"), ["arc_id"])
    arcs = spark.createDataFrame([(1, 110.0), (2, 110.0)], "arc_id long, length_m double")
    # Supports lie on the arc: one forwards over the first bend, one backwards along the last stretch.
    pieces = spark.createDataFrame([(1, 5, 20.0, 50.0), (1, 6, 100.0, 80.0)], "arc_id long, piece_id long, start_s double, end_s double")
    drawn = [(1, 5, 0, 20.0, 0.0), (1, 5, 1, 30.0, 0.0), (1, 5, 2, 30.0, 20.0), (1, 6, 0, 60.0, 40.0), (1, 6, 1, 40.0, 40.0)]
    lines = zones.segments(spark.createDataFrame(drawn, "arc_id long, piece_id long, seq long, x double, y double"), ["arc_id", "piece_id"])
    got = {}
    for r in evidence.fused_line(pieces, lines, arcs, arc_lines).orderBy("k").collect():
        got.setdefault((r.arc_id, r.how), []).append((r.x, r.y))
    assert got[(2, "arc")] == points
    line = got[(1, "support_and_arc")]
    assert line == [(0.0, 0.0), (20.0, 0.0), (30.0, 0.0), (30.0, 20.0), (30.0, 40.0), (40.0, 40.0), (60.0, 40.0), (70.0, 40.0)]
    assert sum(math.dist(a, b) for a, b in zip(line, line[1:])) == 110.0


def test_intervals_are_kept_apart(spark):
    raw = [(1, 1, 0.0, 4.0, 20.0), (1, 2, 2.0, 6.0, 20.0), (1, 3, 3.95, 4.05, 20.0), (2, 1, 8.0, 10.0, 9.0), (2, 2, 8.0, 10.0, 9.0)]
    df = spark.createDataFrame(raw, "node_id long, arc_id long, start_s double, end_s double, length double")
    got = {(r["node_id"], r["arc_id"]): r for r in series.interval_keep_apart(df, ["node_id"]).collect()}
    # Centres 2, 4 and 4: the third moves to 4.1, which its own interval holds back at 4.05.
    assert [round(got[1, a][c], 6) for a in (1, 2, 3) for c in ("start_s", "end_s")] == [0.0, 2.95, 3.05, 4.0, 4.025, 4.05]
    assert all(r["ordered"] for r in got.values())
    # Both want the end of a line of 9: the centres 9 and 9.1 go back to 8.9 and 9.
    assert (round(got[2, 1]["start_s"], 6), round(got[2, 1]["end_s"], 6), round(got[2, 2]["start_s"], 6)) == (8.0, 8.9, 9.0)
    assert got[2, 2]["end_s"] == 10.0


def test_all_pairs_of_crossings(spark):
    events = spark.createDataFrame([(1, 10, 0.5), (1, 20, 1.5), (1, 10, 2.5), (1, 30, 3.5), (2, 10, 0.0)], "traj_id long, node_id long, seq_at double")
    got = {(r["seq_from"], r["seq_to"]): (r["src"], r["dst"], r["index_gap"], r["mode"], r["inner"]) for r in zones.traj_pair_all(events, ["traj_id"]).collect()}
    assert got == {
        (0.5, 1.5): (10, 20, 1, "adjacent", []), (1.5, 2.5): (20, 10, 1, "adjacent", []), (2.5, 3.5): (10, 30, 1, "adjacent", []),
        (0.5, 3.5): (10, 30, 3, "skip_pair", [20]), (1.5, 3.5): (20, 30, 2, "skip_pair", [10]),
    }


def test_tails_stitch_to_what_lies_ahead(spark):
    cols = "patch_id long, traj_id long, seq long, x double, y double, hx double, hy double, left_m double"
    rows = [(0, 1, 1, 0.0, 0.0, 1.0, 0.0, 40.0), (0, 1, 2, 30.0, 0.0, 1.0, 0.0, 0.0)]
    rows += [(0, 2, 1, 29.0, 0.0, 1.0, 0.0, 50.0), (0, 2, 2, 33.0, 0.5, 1.0, 0.0, 46.0), (0, 2, 3, 36.0, 0.0, 1.0, 0.0, 42.0)]  # behind, in 5 m, in 10 m
    rows += [(0, 3, 1, 31.0, 0.0, 0.0, 1.0, 50.0), (0, 4, 1, 31.0, 0.0, 1.0, 0.0, 3.0), (1, 5, 1, 31.0, 0.0, 1.0, 0.0, 50.0)]  # turned, ending, another patch
    got = assembly.tail_stitches(spark.createDataFrame(rows, cols)).where("traj_id = 1").collect()
    assert [(r["seq"], r["p_traj_id"], r["p_seq"], r["level"], r["rank"]) for r in got] == [(2, 2, 2, 1, 1)]


def test_owners_by_tier(spark):
    seg = "arc_id long, seq long, x1 double, y1 double, x2 double, y2 double, seg_m double"
    lines = spark.createDataFrame([(1, 1, 0.0, 0.0, 100.0, 0.0, 100.0), (2, 1, 0.0, 10.0, 100.0, 10.0, 100.0), (3, 1, 0.0, 20.0, 100.0, 20.0, 100.0)], seg)
    corridors, working = lines.where("arc_id = 1"), lines.where("arc_id <> 3")
    arcs = spark.createDataFrame([(7, 1, 0), (7, 2, 1), (7, 3, 2), (8, 2, 0), (8, 3, 0)], "node_id long, arc_id long, place long")
    at = [(7, 1, 50.0, 3.9), (7, 2, 50.0, 6.5), (7, 3, 50.0, 5.0), (7, 4, 50.0, 900.0), (7, 5, 50.0, 15.0), (8, 1, 50.0, 0.0), (9, 1, 50.0, 0.0)]
    got = arcs_.crossing_owners(spark.createDataFrame(at, "node_id long, crossing_id long, x double, y double"), arcs, corridors, working, lines)
    assert {(r["node_id"], r["crossing_id"]): (r["arc_id"], r["tier"], r["dist"]) for r in got.collect()} == {
        (7, 1): (1, 0, 3.9), (7, 2): (2, 1, 3.5), (7, 3): (1, 2, 5.0), (7, 4): (3, 2, 880.0), (7, 5): (2, 2, 5.0), (8, 1): (2, 2, 10.0),
    }


def test_margin_to_rival_lines(spark):
    line = lambda k, y, n=1: (k, 1, 0.0, y, 50.0, y, 50.0, 0.0)
    seg = "{} long, seq long, x1 double, y1 double, x2 double, y2 double, seg_m double, s1 double"
    arc_lines = spark.createDataFrame([line(1, 0.0), line(2, 8.0), line(3, 100.0)], seg.format("arc_id"))
    arcs = spark.createDataFrame([(1, 5), (2, 5), (3, 6)], "arc_id long, src long")
    lines = spark.createDataFrame([line(10, 1.0), line(11, 3.5), line(12, 90.0)], seg.format("cand_id")).selectExpr("*", "cand_id AS piece_id")
    pieces = spark.createDataFrame([(10, 1), (11, 1), (12, 3)], "piece_id long, arc_id long")
    got = {r["piece_id"]: (r["own_m"], r["rival_m"], r["preferred"]) for r in assembly.arc_margins(pieces, lines, arcs, arc_lines).collect()}
    assert got == {10: (1.0, 7.0, True), 11: (3.5, 4.5, False), 12: (10.0, None, True)}
