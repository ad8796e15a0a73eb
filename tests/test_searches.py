"""Searches and intervals on inputs with results worked out by hand."""

import pytest
from pyspark.sql import functions as F

from roadloom.operators import anchors, evidence, zones

EDGES = "poly_id int, x1 double, y1 double, x2 double, y2 double"


def polygon(i, *corners):
    return [(i, *map(float, a), *map(float, b)) for a, b in zip(corners, [*corners[1:], corners[0]])]


def test_reverse_tip_looks_behind(spark):
    stripes = spark.createDataFrame(polygon(0, (0, 0), (10, 0), (10, 12), (0, 12)) + polygon(1, (0, 18), (10, 18), (10, 30), (0, 30)), EDGES)
    nodes = spark.createDataFrame([(1, 15.0, 15.0, 1.0, 0.0), (2, 15.0, 15.0, 1.0, 0.0), (3, 5.0, 15.0, 1.0, 0.0), (4, 100.0, 100.0, 1.0, 0.0), (5, 100.0, 100.0, 1.0, 0.0)], "node_id long, x double, y double, ux double, uy double")
    forward = spark.createDataFrame(
        [(1, None, None, None, False, False, None), (2, None, None, None, False, True, None), (3, 0.0, None, None, True, False, None), (4, 2.0, None, None, False, False, None), (5, None, None, None, False, False, -7.0)],
        "node_id long, first_s double, tip_s double, split_s double, at_node boolean, multi boolean, back_tip_s double",
    )
    tips = spark.createDataFrame([(500.0, 500.0)], "x double, y double")
    got = [tuple(r) for r in anchors.reverse_tip(nodes, forward, tips, stripes).orderBy("node_id").collect()]
    assert got == [
        (1, "missing_ref", "reverse_zone_split", -6.0, True), (2, None, "none", None, False), (3, "untrusted_divstrip_at_node", "reverse_zone_split", -1.0, True),
        (4, "first_hit_no_split", "divider_hit", 2.0, False), (5, "missing_ref", "reverse_divider_tip", -7.0, True),
    ]


def test_k16_goes_on_to_the_longest_line(spark):
    zone = spark.createDataFrame(polygon(0, (4, -2), (30, -8), (30, 8), (4, 2)), EDGES)
    nodes = spark.createDataFrame([(n, 0.0, 0.0) for n in (1, 2, 3, 4, 5)], "node_id long, x double, y double")
    roads = spark.createDataFrame([(1, 1, 11, 2), (2, 2, 12, 3), (3, 3, 13, 2), (4, 3, 14, 2), (5, 4, 15, 0)], "road_id long, snode long, enode long, direction int")
    line = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(0.0).alias("y")) for x in (0.0, 50.0)])
    got = anchors.k16_search(nodes, roads, evidence.away_and_trend_vector(roads.withColumn("line", line)), zone)
    assert [tuple(r) for r in got.select("node_id", "s", "first_s", "reason").orderBy("node_id").collect()] == [
        (1, 9.0, 4.0, "ok_refined"), (2, -9.0, -4.0, "ok_refined"), (3, None, None, "K16_ROAD_NOT_UNIQUE"), (4, None, None, "K16_ROAD_DIR_UNSUPPORTED"), (5, None, None, "K16_ROAD_NOT_UNIQUE"),
    ]


def test_raw_intervals_by_tier(spark):
    arcs = spark.createDataFrame([(n, "src", a, 0, 30.0, p) for n, a, p in ((1, 1, None), (2, 2, None), (2, 3, None), (3, 4, None), (4, 5, None), (5, 6, None), (6, 7, 4.0))], "node_id long, role string, arc_id long, ord int, length_m double, projection_s double")
    crossings = spark.createDataFrame([(3, "src", 4, 7, 1.0, False), (3, "src", 4, 7, 5.0, True), (4, "src", 5, 1, 3.0, False), (4, "src", 5, 2, 7.0, False)], "node_id long, role string, arc_id long, traj_id long, s double, clean boolean")
    surfaces = spark.createDataFrame([(1, 2.0, 8.0), (1, 10.0, 12.0), (2, 0.0, 9.0), (4, 0.0, 5.0), (4, 6.0, 20.0), (6, 10.0, 12.0)], "node_id long, start_s double, end_s double")
    got = evidence.endpoint_interval_raw(arcs, crossings, surfaces).orderBy("arc_id").select("arc_id", "start_s", "end_s", "width_m", "mode", "n_used")
    assert [tuple(r) for r in got.collect()] == [
        (1, 2.0, 8.0, 6.0, "surface_legal_interval", 0), (2, 2.5, 3.5, 1.0, "fallback_projection", 0), (3, 5.5, 6.5, 1.0, "fallback_projection", 0),
        (4, 4.5, 5.5, 1.0, "clean_traj_crossing", 1), (5, 3.0, 5.0, 4.0, "ambiguous_traj_crossing", 2), (6, 0.0, 1.0, 1.0, "xsec_fallback_interval", 0),
        (7, 10.0, 12.0, 2.0, "fallback_projection", 0),
    ]


def test_middle_between_two_boundaries(spark):
    def lines(name, places):
        rows = [(0, i, seq, x, y) for i, y in places for seq, x in enumerate((0.0, 15.0, 40.0))]
        return zones.segments(spark.createDataFrame(rows, f"patch_id long, {name} long, seq int, x double, y double"), ["patch_id", name])

    zone = spark.createDataFrame(polygon(0, (-1, -10), (41, -10), (41, 10), (-1, 10)), EDGES)
    got = evidence.lane_boundary_centerline(lines("road_id", [(1, 0.0), (2, 300.0)]), lines("lane_id", [(1, 3.0), (2, -3.0), (3, 20.0)]), zone).collect()
    assert [(r["road_id"], r["lane_a"], r["lane_b"], r["length_m"]) for r in got] == [(1, 1, 2, 40.0)]
    assert got[0]["quality"] == pytest.approx(1.0) and [p["x"] for p in got[0]["line"]] == [0.0, 8.0, 16.0, 24.0, 32.0, 40.0] and all(p["y"] == 0 for p in got[0]["line"])
