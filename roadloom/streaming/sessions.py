"""Streaming forms of the gap split and of the clearance check (extensions of ours)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def gap_sessions(vertices: DataFrame, gap: str, late: str) -> DataFrame:
    """Pieces of trajectories from a stream of vertices (traj_id, ts, z): a session ends
    after `gap` without one; vertices later than `late` are left out."""
    piece = F.session_window("ts", gap)
    rows = vertices.withWatermark("ts", late).groupBy("traj_id", piece).agg(F.count("*").alias("n"), F.min("z").alias("z_min"), F.max("z").alias("z_max"))
    return rows.select("traj_id", F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n", "z_min", "z_max")


def residual_windows(vertices: DataFrame, width: str, late: str, threshold: float) -> DataFrame:
    """Share of vertices over a clearance threshold in each window of time."""
    rows = vertices.withWatermark("ts", late).groupBy(F.window("ts", width), "patch_id")
    got = rows.agg(F.count("*").alias("n"), F.avg((F.abs("residual") > threshold).cast("double")).alias("outlier_ratio"))
    return got.select("patch_id", F.col("window.start").alias("start"), "n", "outlier_ratio")
