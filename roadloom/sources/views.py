"""Domain views over the star-schema tables: patches of points, trajectories, roads, nodes,
cross-sections and zones, derived with plain arithmetic.

Each view is declared once as an expression list and once as SQL for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").selectExpr(
        "l_suppkey % 8 AS patch_id",
        "l_orderkey * 8 + l_linenumber AS point_id",
        "(l_orderkey % 700) * 5e-1D + l_linenumber * 5e-2D AS x",
        "(l_partkey % 60) * 1e0D + l_quantity * 1e-2D AS y",
        "10e0D + l_discount + l_tax + CASE WHEN l_returnflag = 'R' THEN 5e0D ELSE 0e0D END AS z",
        "CASE l_returnflag WHEN 'N' THEN 2 WHEN 'A' THEN 1 ELSE 12 END AS cls",
    )


def traj(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return (
        _table(spark, sf_dir, "events")
        .withColumn("seq", F.row_number().over(order).cast("long"))
        .selectExpr(
            "user_id % 8 AS patch_id",
            "user_id AS traj_id",
            "seq",
            "unix_micros(cast(ts AS timestamp)) / 1e6D AS t",
            "seq * 5e0D AS x",
            "(user_id % 10) * 6e0D + (event_id * 7919 % 100) * 1e-2D AS y",
            "10e0D + (event_id * 104729 % 1000) * 1e-3D + CASE WHEN event_type = 'error' THEN 1e0D ELSE 0e0D END AS z",
        )
    )


def roads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A road for each order, between nodes near the order's key: a node has one road out
    and one in on average, so chains, fans and gaps all occur."""
    return _table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS road_id",
        "o_orderkey + 1 + o_custkey % 7 AS snode",
        "o_orderkey + 2 + o_orderkey % 3 + o_custkey % 11 AS enode",
        "cast(o_orderkey % 4 AS int) AS direction",
        "5e0D + o_orderkey % 40 AS length_m",
    )


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey + 1 AS node_id",
        "CASE o_orderkey % 5 WHEN 0 THEN 16 WHEN 1 THEN 8 WHEN 2 THEN 4 WHEN 3 THEN 65536 ELSE 0 END AS kind",
        "(o_orderkey % 40) * 25e0D AS x",
        "floor(o_orderkey / 40) * 25e0D AS y",
    )


def xsecs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "nation").selectExpr(
        "cast(n_nationkey + 1 AS bigint) AS node_id", "n_nationkey * 14e0D AS x1", "-5e0D AS y1", "n_nationkey * 14e0D + (n_nationkey % 3 - 1) * 4e0D AS x2", "65e0D AS y2"
    )


def zone_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four edges for the rectangle of each zone."""
    low, high = "r_regionkey * 70e0D", "r_regionkey * 70e0D + 60e0D"
    corners = [(low, "0e0D"), (high, "0e0D"), (high, "55e0D"), (low, "55e0D")]
    edges = ", ".join(
        f"named_struct('edge_ix', {i}, 'x1', {a[0]}, 'y1', {a[1]}, 'x2', {b[0]}, 'y2', {b[1]})"
        for i, (a, b) in enumerate(zip(corners, corners[1:] + corners[:1]))
    )
    return _table(spark, sf_dir, "region").selectExpr("r_regionkey AS poly_id", f"inline(array({edges}))")


SQL = {
    "v_points": """SELECT l_suppkey % 8 AS patch_id, l_orderkey * 8 + l_linenumber AS point_id,
        (l_orderkey % 700) * 5e-1 + l_linenumber * 5e-2 AS x, (l_partkey % 60) * 1e0 + l_quantity * 1e-2 AS y,
        10e0 + l_discount + l_tax + CASE WHEN l_returnflag = 'R' THEN 5e0 ELSE 0e0 END AS z,
        CASE l_returnflag WHEN 'N' THEN 2 WHEN 'A' THEN 1 ELSE 12 END AS cls FROM lineitem""",
    "v_traj": """SELECT user_id % 8 AS patch_id, user_id AS traj_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq,
        epoch_us(ts) / 1e6 AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) * 5e0 AS x,
        (user_id % 10) * 6e0 + (event_id * 7919 % 100) * 1e-2 AS y,
        10e0 + (event_id * 104729 % 1000) * 1e-3 + CASE WHEN event_type = 'error' THEN 1e0 ELSE 0e0 END AS z FROM events""",
    "v_roads": """SELECT o_orderkey AS road_id, o_orderkey + 1 + o_custkey % 7 AS snode, o_orderkey + 2 + o_orderkey % 3 + o_custkey % 11 AS enode,
        CAST(o_orderkey % 4 AS INTEGER) AS direction, 5e0 + o_orderkey % 40 AS length_m FROM orders""",
    "v_nodes": """SELECT o_orderkey + 1 AS node_id, CASE o_orderkey % 5 WHEN 0 THEN 16 WHEN 1 THEN 8 WHEN 2 THEN 4 WHEN 3 THEN 65536 ELSE 0 END AS kind,
        (o_orderkey % 40) * 25e0 AS x, floor(o_orderkey / 40) * 25e0 AS y FROM orders""",
    "v_xsecs": """SELECT CAST(n_nationkey + 1 AS BIGINT) AS node_id, n_nationkey * 14e0 AS x1, -5e0 AS y1, n_nationkey * 14e0 + (n_nationkey % 3 - 1) * 4e0 AS x2, 65e0 AS y2 FROM nation""",
    "v_zone_edges": """SELECT r_regionkey AS poly_id, e.* FROM region, (VALUES (0), (1), (2), (3)) AS k(edge_ix),
        LATERAL (SELECT edge_ix, CASE edge_ix WHEN 1 THEN r_regionkey * 70e0 + 60e0 WHEN 2 THEN r_regionkey * 70e0 + 60e0 ELSE r_regionkey * 70e0 END AS x1,
          CASE WHEN edge_ix < 2 THEN 0e0 ELSE 55e0 END AS y1,
          CASE WHEN edge_ix < 2 THEN r_regionkey * 70e0 + 60e0 ELSE r_regionkey * 70e0 END AS x2,
          CASE WHEN edge_ix IN (1, 2) THEN 55e0 ELSE 0e0 END AS y2) AS e""",
}


def with_views(sql: str, *names: str) -> str:
    """`sql`, which may begin with further CTEs ("name AS (...), ... SELECT"), after the
    named views."""
    views = ", ".join(f"{n} AS ({SQL[n]})" for n in names)
    return f"WITH RECURSIVE {views}, {sql}" if not sql.lstrip().upper().startswith("SELECT") else f"WITH {views} {sql}"
