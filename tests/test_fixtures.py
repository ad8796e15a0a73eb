"""Small hand-made inputs with results worked out by hand, sources, sinks and streams."""

import json

import pytest
from pyspark.sql import functions as F

from roadloom.functions import scalars
from roadloom.operators import anchors, arcs, cells, movements, network, profiles, repair, series, zones
from roadloom.sources import features
from roadloom.streaming import sessions


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_fusion_finds_the_raised_middle(spark):
    residual = [0.1] * 4 + [1.0] * 4 + [0.1] * 4
    traj = spark.createDataFrame([(0, 1, i, float(i), float(i), 0.0, 10.0) for i in range(12)], "patch_id long, traj_id long, seq long, t double, x double, y double, z double")
    points = spark.createDataFrame([(0, float(i), j * 0.01, 10.0 - r) for i, r in enumerate(residual) for j in range(3)], "patch_id long, x double, y double, z double")
    cloud = series.radius_median_z(traj, points, radius=0.4, search=0.5)
    qc = series.fusion_qc(cloud, q=0.5, by=series.TRAJ)
    assert qc.collect()[0]["status"] == "OK"
    bins = series.sliding_bin_score(cloud, qc, width=2, stride=1)
    got = series.abnormal_runs(bins, width=2, stride=1).collect()
    assert [(r["start_idx"], r["end_idx"]) for r in got] == [(3, 9)] and got[0]["score"] == pytest.approx(1.0)


def test_chain_limits(spark):
    kinds = [(1, 16), (2, 8), (3, 16), (4, 8)]
    roads, at = [], 100
    for a, b, m in ((1, 2, 60.0), (3, 4, 80.0), (2, 3, 60.0)):
        roads.append((at, a, b, 2, m))
        at += 1
    for n in (1, 2, 3, 4):  # spurs, so that degrees are 3 or more
        for k in range(2):
            roads.append((at, n * 10 + k, n, 2, 500.0))
            at += 1
    df = spark.createDataFrame(roads, "road_id long, snode long, enode long, direction int, length_m double")
    nodes = spark.createDataFrame(kinds, "node_id long, kind int")
    # 60 m: allowed from diverge to merge alone; 80 m: never
    assert rows(network.chain_edges(df, nodes), "src") == [(1, 2, 60.0)]


def test_split_jumps_repeat_events(spark):
    steps = spark.createDataFrame([(1, i, n) for i, n in enumerate([1, 1, 3, 3, 2, 4])], "node_id long, s int, n int")
    got = rows(profiles.split_events(steps, ["node_id"], "s", "n", 10).select("s", "event"), "event")
    assert got == [(2, 1), (2, 2), (5, 3), (5, 4)]


def test_two_cross_sections_give_one_segment(spark):
    traj = spark.createDataFrame([(0, t, s, s * 10.0 - 5, t * 0.5) for t in (1, 2) for s in range(13)], "patch_id long, traj_id long, seq long, x double, y double")
    xsecs = spark.createDataFrame([(1, 0.0, -5.0, 5.0), (2, 100.0, -5.0, 5.0)], "node_id long, x double, y1 double, y2 double")
    events = zones.crossing_events(zones.segments(traj, ["patch_id", "traj_id"]), xsecs, ["patch_id", "traj_id"])
    pairs = zones.pair_support(zones.traj_pair_candidates(events, ["patch_id", "traj_id"]))
    assert [(r["src"], r["dst"], r["n_traj"]) for r in pairs.collect()] == [(1, 2, 2)]


def test_four_arms_decisions(spark):
    angles = {"s": 270.0, "n": 90.0, "w": 180.0, "e": 0.0}
    data = []
    for i, (_, a) in enumerate(angles.items()):
        data.append((1, i * 2, i, "entry", (a + 180) % 360, a, 0.0, 0.0, None))
        data.append((1, i * 2 + 1, i, "exit", a, a, 0.0, 0.0, None))
    df = spark.createDataFrame(data, "intersection_id long, approach_id long, arm int, side string, travel_deg double, arm_deg double, x double, y double, profile string")
    ready = movements.approach_defaults(movements.lateral_rank(df))
    decided = movements.movement_pairs(ready).withColumn("d", movements.movement_rules()).select("turn", "d.status")
    got = {(r["turn"], r["status"]): r["n"] for r in decided.groupBy("turn", "status").agg(F.count("*").alias("n")).collect()}
    assert got == {("through", "allowed"): 4, ("right", "allowed"): 4, ("left", "allowed"): 4, ("uturn", "unknown"): 4}


def test_repair_cases(spark):
    zone = spark.createDataFrame([(0, 0.0, 0.0, 10.0, 0.0), (0, 10.0, 0.0, 10.0, 10.0), (0, 10.0, 10.0, 0.0, 10.0), (0, 0.0, 10.0, 0.0, 0.0)], "poly_id int, x1 double, y1 double, x2 double, y2 double")
    roads = spark.createDataFrame([(1, 1, 9, 5.0, 5.0, 25.0, 5.0), (2, 8, 9, -5.0, 5.0, 15.0, 5.0), (3, 8, 9, 20.0, 20.0, 30.0, 20.0), (4, 1, 2, 0.0, 0.0, 1.0, 1.0)], "road_id long, snode long, enode long, x1 double, y1 double, x2 double, y2 double")
    nodes = spark.createDataFrame([(1, 5.0, 5.0), (2, 1.0, 1.0)], "node_id long, x double, y double")
    got = {r["road_id"]: r for r in repair.endpoint_repair(roads, nodes, zone).collect()}
    assert set(got) == {1, 2, 3}
    assert (got[1]["x1"], got[1]["x2"], got[1]["new_snode"], got[1]["reason"]) == (5.0, 10.0, None, None) and got[1]["new_enode"] is not None
    assert got[2]["reason"] == "fallback_longest_no_existing_endpoint" and (got[2]["x1"], got[2]["x2"]) == (0.0, 10.0)
    assert got[3]["reason"] == "clipped_empty" and got[3]["new_snode"] is None


def test_repair_of_polylines(spark):
    box = [(0, 0.0, 0.0, 10.0, 0.0), (0, 10.0, 0.0, 10.0, 10.0), (0, 10.0, 10.0, 0.0, 10.0), (0, 0.0, 10.0, 0.0, 0.0)]
    zone = spark.createDataFrame(box, "poly_id int, x1 double, y1 double, x2 double, y2 double")
    roads = spark.createDataFrame([(1, 1, 9), (2, 9, 1), (3, 8, 9), (4, 1, 2), (5, 8, 1)], "road_id long, snode long, enode long")
    spots = {1: [(5, 5), (5, 8), (25, 8)], 2: [(5, 5), (5, 8), (25, 8)], 3: [(40, 40), (50, 40)], 4: [(5, 5), (1, 1)], 5: [(13, 14), (13, 30), (5, 30), (5, 5)]}
    vertices = [(r, i, float(x), float(y)) for r, at in spots.items() for i, (x, y) in enumerate(at)]
    lines = zones.segments(spark.createDataFrame(vertices, "road_id long, seq long, x double, y double"), ["road_id"])
    nodes = spark.createDataFrame([(1, 5.0, 5.0), (2, 1.0, 1.0)], "node_id long, x double, y double")
    got = {r["road_id"]: r for r in repair.endpoint_repair_lines(roads, lines, nodes, zone).collect()}
    assert set(got) == {1, 2, 3, 5}
    at = lambda r: tuple(round(r[c], 6) for c in ("sx", "sy", "dx", "dy"))
    assert at(got[1]) == (5.0, 5.0, 15.0, 8.0) and got[1]["snode"] == 1 and got[1]["new_dst"] and not got[1]["new_src"] and got[1]["reason"] is None
    assert abs(got[1]["outside_ratio"] - 5 / 13) < 1e-9
    # Drawn against its direction: the line begins at the destination's node.
    assert at(got[2]) == (15.0, 8.0, 5.0, 5.0) and got[2]["enode"] == 1 and got[2]["new_src"]
    assert got[3]["reason"] == "clipped_empty" and (got[3]["snode"], got[3]["enode"], got[3]["new_src"]) == (8, 9, False)
    # The piece at the node is kept, not the one within 5 m of the corner (3 and 4 m away: on the rim).
    assert at(got[5]) == (5.0, 15.0, 5.0, 5.0) and got[5]["new_src"] and not got[5]["new_dst"]


def test_layer_path_stays_on_the_continuous_layer(spark):
    z = [(10.0, 15.0), (10.1, 15.1), (15.0, 10.2), (10.3, None)]
    df = spark.createDataFrame([(0, 1, i, a, b) for i, (a, b) in enumerate(z)], "patch_id long, traj_id long, seq long, peak0 double, peak1 double")
    got = rows(profiles.road_z_layer_path(df).select("seq", "layer_z"), "seq")
    assert [g[1] for g in got] == [10.0, 10.1, 10.2, 10.3]


def test_road_height_by_votes(spark):
    z = [(10.0, 15.0), (10.1, 15.1), (15.0, 10.2), (10.3, None)]
    visits = [(0, t, i, i, 0, a, b) for t in (1, 2) for i, (a, b) in enumerate(z)] + [(0, 3, 0, 1, 0, 10.1, 15.1), (0, 4, 0, 2, 0, 15.0, 10.2)]
    df = spark.createDataFrame(visits, "patch_id long, traj_id long, seq long, ix long, iy long, peak0 double, peak1 double")
    peaks = spark.createDataFrame([(0, i, 0, a) for i, (a, _) in enumerate(z)] + [(0, 9, 0, 7.0)], "patch_id long, ix long, iy long, peak0 double")
    path = profiles.road_z_layer_path(df, carry=("ix", "iy"))
    got = {r["ix"]: (r["n_votes"], r["road_z"]) for r in profiles.road_z_by_votes(peaks, path).collect()}
    # A trajectory of one cell takes the first peak: in cell 2 that is 15.0, against two votes for 10.2.
    assert got == {0: (2, 10.0), 1: (3, 10.1), 2: (3, 10.2), 3: (2, 10.3), 9: (0, 7.0)}
    stats = {r["traj_id"]: r for r in profiles.layer_path_stats(path).collect()}
    assert (stats[1]["n_cells"], round(stats[1]["dz_max"], 9), stats[1]["upper_share"]) == (4, 0.1, 0.25)
    assert (stats[3]["n_cells"], stats[3]["dz_p90"], stats[3]["upper_share"]) == (1, 0.0, 0.0)


def test_plane_with_a_raised_strip(spark):
    ground = [(0, x * 1.0, y * 0.5, 3.0 if 40 <= x <= 55 else 0.0) for x in range(101) for y in range(-12, 13)]
    points = spark.createDataFrame(ground, "patch_id long, x double, y double, z double")
    traj = spark.createDataFrame([(0, 1, i, float(i), 0.0, 1.8) for i in range(101)], "patch_id long, traj_id long, seq long, x double, y double, z double")
    rows_ = series.residuals(cells.dem_lookup_fallback(traj, points, size=2.0, least=4))
    bins = series.equal_bins(rows_.withColumn("t", F.lit(None).cast("double")), bins=20)
    got = series.interval_merge_topk(bins).collect()
    assert len(got) == 1 and got[0]["start_idx"] in range(35, 45) and got[0]["end_idx"] in range(52, 62)


@pytest.mark.parametrize("parts", [1, 7])
def test_order_and_partitions_do_not_matter(spark, data, parts):
    from roadloom.sources import views as v

    traj = v.traj(spark, data)
    one = series.traj_gap_split(traj, seconds=40000.0).select("traj_id", "seq", "piece")
    two = series.traj_gap_split(traj.orderBy(F.xxhash64("seq")).repartition(parts), seconds=40000.0).select("traj_id", "seq", "piece")
    assert one.exceptAll(two).count() == 0 == two.exceptAll(one).count()


def test_empty_inputs(spark):
    points = spark.createDataFrame([], "patch_id long, point_id long, x double, y double, z double, cls int")
    traj = spark.createDataFrame([], "patch_id long, traj_id long, seq long, t double, x double, y double, z double")
    assert cells.dem_quantile(points).count() == 0
    assert cells.cell_components(cells.cell(points, 5.0)).count() == 0
    assert series.radius_median_z(traj, points).count() == 0
    assert series.traj_gap_split(traj).count() == 0
    roads = spark.createDataFrame([], "road_id long, snode long, enode long, direction int, length_m double")
    assert network.components(scalars.chain_edges_of(roads)).count() == 0


def test_nan_and_null_coordinates_are_dropped(spark):
    df = spark.createDataFrame([(0, 1.0, 1.0, float("nan")), (0, None, 1.0, 1.0), (0, 1.0, 1.0, 2.0)], "patch_id long, x double, y double, z double")
    assert [r["z"] for r in cells.finite_filter(df).collect()] == [2.0]


def test_packed_cells_round_trip(spark):
    df = spark.createDataFrame([(-5, 7), (3, -9), (0, 0)], "ix long, iy long").withColumn("key", cells.packed_cell())
    ix, iy = cells.unpacked_cell(F.col("key"))
    assert df.where((ix != F.col("ix")) | (iy != F.col("iy"))).count() == 0


def test_backtrack_and_reference(spark):
    df = spark.createDataFrame([(3.0, None, 5.0), (None, 2.0, None), (None, None, 4.0), (3.0, None, 40.0)], "first_s double, tip_s double, split_s double")
    got = [tuple(r) for r in df.select(anchors.reference_choice().alias("c")).select("c.source", "c.s").collect()]
    assert got == [("divider_hit", 3.0), ("divider_tip", 2.0), ("zone_split", 4.0), ("zone_split", 40.0)]


def test_final_gate_order(spark):
    df = spark.createDataFrame([(False, True, False, True, False, "x"), (True, False, True, False, False, None)], "direct_legal boolean, is_unique boolean, multi_allowed boolean, blocked boolean, entry_allowed boolean, hard_block string")
    assert [r[0] for r in df.select(arcs.final_gate()).collect()] == ["final_gate_not_direct_legal", None]


# --- sources, sinks and streams --------------------------------------------------


def collection(feats):
    return json.dumps({"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "EPSG:3857"}}, "features": feats})


def test_scan_features_and_trajectories(spark, tmp_path):
    for patch in ("p1", "p2"):
        (tmp_path / patch).mkdir()
        pts = [{"type": "Feature", "properties": {"Seq": s}, "geometry": {"type": "Point", "coordinates": [float(s), 1.0] + ([2.0] if s else [])}} for s in (2, 0, 1)]
        (tmp_path / patch / "traj.geojson").write_text(collection(pts))
        (tmp_path / patch / "roads.geojson").write_text(collection([{"type": "Feature", "properties": {"id": "7"}, "geometry": {"type": "LineString", "coordinates": [[0, 0], [3, 4]]}}]))
    got = features.scan_geojson(spark, f"{tmp_path}/*/*.geojson")
    assert got.count() == 8 and got.where("crs = 'EPSG:3857'").count() == 8
    line = got.where("layer = 'roads'").select("patch_id", features.polyline(F.col("coords")).alias("p")).orderBy("patch_id").first()
    assert line["patch_id"] == "p1" and [tuple(q) for q in line["p"]] == [(0.0, 0.0), (3.0, 4.0)]
    traj = rows(features.scan_traj(got.where("layer = 'traj' AND patch_id = 'p1'")), "seq")
    assert [(t[2], t[3], t[5]) for t in traj] == [(0, 0.0, 0.0), (1, 1.0, 2.0), (2, 2.0, 2.0)]
    inventory = rows(features.patch_inventory(spark, str(tmp_path), ["roads", "traj", "zones"]), "patch_id")
    assert inventory == [("p1", 1, 1, 0), ("p2", 1, 1, 0)]


def test_sink_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, 0.5, 1.5), ("b", 2, 2.5, 3.5)], "patch_id string, id int, x double, y double")
    geometry = F.struct(F.lit("Point").alias("type"), F.array("x", "y").alias("coordinates"))
    features.sink_features(df, f"{tmp_path}/out", geometry, ["id"])
    back = spark.read.text(f"{tmp_path}/out").orderBy("patch_id").collect()
    assert json.loads(back[1]["value"])["geometry"]["coordinates"] == [2.5, 3.5] and back[1]["patch_id"] == "b"
    features.sink_cell_csv(df, f"{tmp_path}/csv")
    assert spark.read.option("header", True).csv(f"{tmp_path}/csv").count() == 2


def test_windows_aliases_and_export(spark):
    points = spark.createDataFrame([("a", 1, 1.0, 1.0, 2), ("a", 2, 9.0, 9.0, 2), ("b", 3, 1.0, 1.0, 1)], "patch_id string, point_id long, x double, y double, cls int")
    boxes = spark.createDataFrame([("a", 0.0, 0.0, 5.0, 5.0), ("b", 0.0, 0.0, 5.0, 5.0)], "patch_id string, x1 double, y1 double, x2 double, y2 double")
    assert [r["point_id"] for r in features.point_window(points, boxes, [2]).orderBy("point_id").collect()] == [1, 3]
    files = spark.createDataFrame([("a", "Road", "r"), ("a", "RCSDRoad", "q"), ("b", "RCSDRoad", "s")], "patch_id string, layer string, path string")
    got = rows(features.layer_alias_resolve(files, {"RCSDRoad": "Road"}), "patch_id")
    assert got == [("a", "Road", "r", None), ("b", "Road", "s", "legacy_name:RCSDRoad")]
    assert [r["ok"] for r in features.export_verify(points, points.where("point_id <> 2")).orderBy("patch_id").collect()] == [False, True]
    assert features.thin_points(points, 100).count() == 3


def test_streamed_gap_sessions(spark, data, tmp_path):
    events = spark.read.parquet(f"{data}/events.parquet").selectExpr("user_id AS traj_id", "cast(ts AS timestamp) AS ts", "value AS z")
    events.repartition(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(events.schema).parquet(f"{tmp_path}/in")
    query = sessions.gap_sessions(stream, "6 hours", "1 hour").writeStream.outputMode("complete").format("memory").queryName("sessions").start()
    query.processAllAvailable()
    query.stop()
    got = spark.table("sessions")
    want = sessions.gap_sessions(events, "6 hours", "1 hour")
    assert got.count() > 0 and got.exceptAll(want).count() == 0 == want.exceptAll(got).count()


def test_first_departure_from_a_snapshot(spark):
    cols = "file string, ord long, path string, kind string, value string"
    want = [(f, i, p, k, v) for f in "abcde" for i, (p, k, v) in enumerate([("$", "object", "x,y"), ("$.x", "list", "1"), ("$.x[0]", "number", "5"), ("$.y", "null", None)])]
    edits = {("a", "$.x[0]"): ("number", "6"), ("b", "$.x[0]"): ("string", "5"), ("c", "$"): ("object", "y,x"), ("c", "$.x"): ("list", "2"), ("d", "$.x"): ("list", "2")}
    have = [(f, 9 - i, p, *edits.get((f, p), (k, v))) for f, i, p, k, v in want if f != "e"] + [("z", 0, "$", "object", "")]
    got = profiles.snapshot_first_mismatch(spark.createDataFrame(have, cols), spark.createDataFrame(want, cols)).collect()
    assert {tuple(r) for r in got} == {
        ("a", "$.x[0]", "value_mismatch", "5", "6"), ("b", "$.x[0]", "type_mismatch", "number", "string"), ("c", "$", "key_mismatch", "x,y", "y,x"), ("d", "$.x", "list_length_mismatch", "1", "2"), ("e", "$", "missing", "x,y", None),
    }
