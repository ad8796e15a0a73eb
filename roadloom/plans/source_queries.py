"""What scans and sinks select and check, over the driver's tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..sources import features
from ..sources import views as v
from .anchor_queries import AT, ATY, _lines
from .registry import query, rounded

BOXES = "bo AS (SELECT patch_id, min(x) AS p1, min(y) AS q1, max(x) AS p2, max(y) AS q2 FROM v_traj GROUP BY patch_id)"


def _boxes(spark, d):
    """Each patch's box of trajectories."""
    return v.traj(spark, d).groupBy("patch_id").agg(F.min("x").alias("x1"), F.min("y").alias("y1"), F.max("x").alias("x2"), F.max("y").alias("y2"))


@query(
    f"{BOXES}, ln AS (SELECT road_id, road_id % 8 AS patch_id, {AT.format(id='snode')} AS a, {ATY.format(id='snode')} AS b, {AT.format(id='enode')} AS c, {ATY.format(id='enode')} AS e FROM v_roads) "
    "SELECT road_id, patch_id FROM ln JOIN bo USING (patch_id) WHERE least(a, c) <= p2 + 50 AND greatest(a, c) >= p1 - 50 AND least(b, e) <= q2 + 50 AND greatest(b, e) >= q1 - 50",
    ("v_traj", "v_roads"),
)
def aoi_prefilter(spark, d):
    box = [F.least("x1", "x2").alias("x1"), F.least("y1", "y2").alias("y1"), F.greatest("x1", "x2").alias("x2"), F.greatest("y1", "y2").alias("y2")]
    rows = _lines(spark, d).select("road_id", (F.col("road_id") % 8).alias("patch_id"), *box)
    return features.aoi_prefilter(rows, _boxes(spark, d), 50.0).select("road_id", "patch_id")


# Even patches have no point of class 7, so all of theirs stay.
@query(
    f"{BOXES}, pt AS (SELECT patch_id, point_id, x, y, CASE WHEN cls = 2 AND patch_id % 2 = 1 THEN 7 ELSE cls END AS cls FROM v_points), w AS (SELECT pt.*, count(*) FILTER (WHERE cls = 7) OVER (PARTITION BY patch_id) AS n FROM pt JOIN bo USING (patch_id) WHERE x BETWEEN p1 AND p2 AND y BETWEEN q1 AND q2) "
    "SELECT patch_id, point_id, x, y, cls FROM w WHERE n = 0 OR cls = 7",
    ("v_traj", "v_points"),
)
def point_window(spark, d):
    cls = F.when((F.col("cls") == 2) & (F.col("patch_id") % 2 == 1), 7).otherwise(F.col("cls"))
    points = v.points(spark, d).select("patch_id", "point_id", "x", "y", cls.alias("cls"))
    return rounded(features.point_window(points, _boxes(spark, d), [7]))


@query(
    """WITH f AS (SELECT o_custkey AS patch_id, ['RCSDRoad', 'Road', 'RCSDNode', 'DriveZone'][o_orderkey % 4 + 1] AS layer, 'p' || o_orderkey AS path FROM orders),
    r AS (SELECT *, CASE layer WHEN 'RCSDRoad' THEN 'Road' WHEN 'RCSDNode' THEN 'Node' ELSE layer END AS main FROM f)
    SELECT patch_id, main AS layer, path, CASE WHEN layer <> main THEN 'legacy_name:' || layer END AS note FROM r QUALIFY row_number() OVER (PARTITION BY patch_id, main ORDER BY layer <> main, path) = 1"""
)
def layer_alias_resolve(spark, d):
    names = F.array(*[F.lit(n) for n in ("RCSDRoad", "Road", "RCSDNode", "DriveZone")])
    layer = F.element_at(names, (F.col("o_orderkey") % 4 + 1).cast("int")).alias("layer")
    files = spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_custkey").alias("patch_id"), layer, F.concat(F.lit("p"), F.col("o_orderkey").cast("string")).alias("path"))
    return features.layer_alias_resolve(files, {"RCSDRoad": "Road", "RCSDNode": "Node"})


# Patch 3 was written without its points of class 12, patch 5 not at all.
COUNTS = "SELECT patch_id, count(*) AS n, count(*) FILTER (WHERE cls = 2) AS g, min(x) AS x1, max(x) AS x2 FROM v_points {} GROUP BY patch_id"


@query(
    f"e AS ({COUNTS.format('')}), w AS ({COUNTS.format('WHERE patch_id <> 5 AND (patch_id <> 3 OR cls <> 12)')}) SELECT patch_id, w.n AS w_n, w.g AS w_ground, w.x1 AS w_x1, w.x2 AS w_x2, e.n AS e_n, e.g AS e_ground, e.x1 AS e_x1, e.x2 AS e_x2, coalesce(w.n = e.n AND w.g = e.g AND w.x1 = e.x1 AND w.x2 = e.x2, false) AS ok FROM w FULL JOIN e USING (patch_id)",
    ("v_points",),
)
def export_verify(spark, d):
    points = v.points(spark, d)
    return rounded(features.export_verify(points.where("patch_id <> 5 AND (patch_id <> 3 OR cls <> 12)"), points))


# --- round trips: what a sink wrote, read back -----------------------------------------


def _point_features(spark, d):
    """Trajectories as files of point features, without seq in every fifth."""
    rows = v.traj(spark, d).withColumn("layer", F.concat(F.lit("traj_"), F.col("traj_id").cast("string"))).withColumn("place", F.col("seq") - 1)
    rows = rows.withColumns({"seq": F.when(F.col("seq") % 5 != 0, F.col("seq")), "Frame_ID": F.when(F.col("seq") % 5 == 0, F.col("seq")), "idx": -F.col("seq")})
    path = features.shared_path(spark, "features")
    geometry = F.struct(F.lit("Point").alias("type"), F.array("x", "y", "z").alias("coordinates"))
    features.sink_collections(rows, path, "place", geometry, ["seq", "Frame_ID", "idx"])
    return path


@query("SELECT CAST(patch_id AS VARCHAR) AS patch_id, 'traj_' || traj_id AS layer, CAST(seq - 1 AS INTEGER) AS feature_ix, 'Point' AS geometry_type, x, y, z, CASE WHEN seq % 5 <> 0 THEN CAST(seq AS VARCHAR) END AS seq FROM v_traj", ("v_traj",))
def scan_geojson(spark, d):
    got = features.scan_geojson(spark, _point_features(spark, d) + "/*/*")
    spot = features.point(F.col("coords"))
    return got.select("patch_id", "layer", "feature_ix", "geometry_type", *[c.alias(n) for n, c in spot.items()], F.try_element_at("props", F.lit("seq")).alias("seq"))


# By file: no field but idx is in all features, and it counts backwards. By row: seq, else frame_id.
@query("SELECT 'file' AS rule, CAST(patch_id AS VARCHAR) AS patch_id, 'traj_' || traj_id AS traj_id, CAST(max(seq) OVER (PARTITION BY traj_id) - seq AS INTEGER) AS seq, x, y, z FROM v_traj UNION ALL SELECT 'row', CAST(patch_id AS VARCHAR), 'traj_' || traj_id, CAST(seq - 1 AS INTEGER), x, y, z FROM v_traj", ("v_traj",))
def scan_traj(spark, d):
    got = features.scan_geojson(spark, _point_features(spark, d) + "/*/*")
    rule = lambda name, per_row: features.scan_traj(got, per_row=per_row).select(F.lit(name).alias("rule"), "patch_id", "traj_id", "seq", "x", "y", "z")
    return rule("file", False).union(rule("row", True))


@query("SELECT CAST(patch_id AS VARCHAR) AS patch_id, x, y, z, cls FROM v_points", ("v_points",))
def scan_points(spark, d):
    path = features.shared_path(spark, "points")
    v.points(spark, d).selectExpr("patch_id", "x AS X", "y AS Northing", "0e0D AS label", "z AS Z", "cls AS Classification").write.partitionBy("patch_id").parquet(path)
    return features.scan_points(spark, path)


@query("p AS (SELECT patch_id, traj_id FROM v_traj GROUP BY ALL) SELECT CAST(patch_id AS VARCHAR) AS patch_id, count(*) FILTER (traj_id % 3 = 0) AS zero, count(*) FILTER (traj_id % 3 = 1) AS one, 0 AS zones FROM p WHERE traj_id % 3 < 2 GROUP BY patch_id", ("v_traj",))
def patch_inventory(spark, d):
    """Files of one feature each, so that a layer of a patch has several."""
    rows = v.traj(spark, d).where("traj_id % 3 < 2").groupBy("patch_id", "traj_id").agg(F.max("x").alias("x"), F.max("y").alias("y"))
    order = Window.partitionBy("patch_id", "layer").orderBy("traj_id")
    rows = rows.withColumn("layer", F.when(F.col("traj_id") % 3 == 0, "zero").otherwise("one")).withColumn("place", F.row_number().over(order) - 1)
    path = features.shared_path(spark, "inventory")
    features.sink_collections(rows, path, "place", F.struct(F.lit("Point").alias("type"), F.array("x", "y").alias("coordinates")), ["traj_id"], most=1)
    return features.patch_inventory(spark, path, ["zero", "one", "zones"])


@query("SELECT CAST(node_id % 8 AS INTEGER) AS patch_id, node_id, kind, x, y FROM v_nodes", ("v_nodes",))
def sink_features(spark, d):
    path = features.shared_path(spark, "nodes")
    rows = v.nodes(spark, d).withColumn("patch_id", F.col("node_id") % 8)
    features.sink_features(rows, path, F.struct(F.lit("Point").alias("type"), F.array("x", "y").alias("coordinates")), ["node_id", "kind"])
    shape = "struct<type:string,properties:struct<node_id:bigint,kind:int>,geometry:struct<type:string,coordinates:array<double>>>"
    got = spark.read.text(path).select("patch_id", F.from_json("value", shape).alias("f"))
    return got.select("patch_id", "f.properties.node_id", "f.properties.kind", F.col("f.geometry.coordinates")[0].alias("x"), F.col("f.geometry.coordinates")[1].alias("y"))


@query("SELECT patch_id, CAST(floor(x / 5) AS BIGINT) AS cx, CAST(floor(y / 5) AS BIGINT) AS cy, count(*) AS n, min(z) AS low, max(z) AS high FROM v_points GROUP BY ALL", ("v_points",))
def sink_cell_csv(spark, d):
    path = features.shared_path(spark, "cells")
    size = lambda c: F.floor(F.col(c) / 5).cast("long")
    cells = v.points(spark, d).groupBy("patch_id", size("x").alias("cx"), size("y").alias("cy")).agg(F.count("*").alias("n"), F.min("z").alias("low"), F.max("z").alias("high"))
    features.sink_cell_csv(cells, path)
    return spark.read.schema(cells.schema).option("header", True).csv(path)
