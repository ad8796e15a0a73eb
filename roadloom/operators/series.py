"""Quality along trajectories: residuals, bins, runs, intervals and splits.

All order-dependent steps are windows over (patch_id, traj_id) ordered by seq, so a
trajectory is sorted once and never gathered.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import tiles
from .cells import cell, finite, finite_filter, neighbours
from .network import cut

TRAJ = ("patch_id", "traj_id")


def along():
    """A trajectory's vertices in order."""
    return Window.partitionBy(*TRAJ).orderBy("seq")


def points_near(queries: DataFrame, points: DataFrame, radius: float, key: list[str]) -> DataFrame:
    """Pairs of a query row and a point of its patch at most `radius` away: `key` and
    every column of the point as p_..., with squared distance d2. A grid of cells as
    wide as the radius makes it an equi-join over 3 x 3 cells."""
    around = neighbours(cell(finite_filter(queries, "x", "y"), radius).select("patch_id", *key, "x", "y", "ix", "iy"))
    own = cell(finite_filter(points, "x", "y"), radius)
    own = own.select("patch_id", "ix", "iy", *[F.col(c).alias(f"p_{c}") for c in points.columns if c != "patch_id"])
    d2 = (F.col("p_x") - F.col("x")) ** 2 + (F.col("p_y") - F.col("y")) ** 2
    return around.join(own, ["patch_id", "ix", "iy"]).withColumn("d2", d2).where(F.col("d2") <= radius * radius)


def radius_median_z(traj: DataFrame, points: DataFrame, radius: float = 2.0, least: int = 3, k: int = 8, search: float = 6.0) -> DataFrame:
    """`traj` with cloud_z: the median height of points within `radius` if there are
    `least`, else of the k nearest within `search` (ties by height), if there are `least` of
    those. Each place is looked up once, in tiles, and the wide search is made for those without enough near points alone."""
    place = ["patch_id", "x", "y"]
    heights = points.select(*place, F.coalesce("z", F.lit(0.0)).alias("z"), F.col("z").isNotNull().alias("known"))
    found = lambda spots, reach, n: tiles.by_tiles(spots, heights, reach, tiles.median_within(reach, n), "patch_id long, x double, y double, n long, z double").where(F.col("n") >= least)
    spots = cut(finite_filter(traj.select(*place).distinct(), "x", "y"))
    near = cut(found(spots, radius, None).withColumnsRenamed({"n": "n_near", "z": "near_z"}))
    far = found(spots.join(near, place, "left_anti"), search, k).select(*place, F.lit(None).cast("long").alias("n_near"), F.col("z").alias("near_z"))
    return traj.join(cut(near.union(far)).withColumnRenamed("near_z", "cloud_z"), place, "left").select(*traj.columns, "n_near", "cloud_z")


def near_traj_mask(points: DataFrame, traj: DataFrame, radius: float = 1.0) -> DataFrame:
    """Points with near_traj: whether a trajectory vertex is within `radius`."""
    hits = points_near(traj.select("patch_id", "x", "y"), points, radius, [])
    near = hits.select("patch_id", F.col("p_point_id").alias("point_id"), F.col("p_x").alias("x"), F.col("p_y").alias("y")).distinct().withColumn("near_traj", F.lit(True))
    return points.join(near, ["patch_id", "point_id", "x", "y"], "left").withColumn("near_traj", F.coalesce("near_traj", F.lit(False)))


def radius_count(queries: DataFrame, points: DataFrame, radius: float, key: list[str], distinct: str | None = None) -> DataFrame:
    """`queries` with n_near: points (or distinct values of a column) within `radius`."""
    if not distinct:  # each place is counted once, in tiles
        place = ["patch_id", "x", "y"]
        got = tiles.by_tiles(cut(queries.select(*place).distinct()), points.select(*place), radius, tiles.count_within(radius), "patch_id long, x double, y double, n long")
        out = queries.join(got.withColumnRenamed("n", "n_near"), place, "left")
        return out.select(*queries.columns, F.coalesce("n_near", F.lit(0)).alias("n_near"))
    got = points_near(queries, points, radius, key).groupBy("patch_id", *key).agg(F.count_distinct(f"p_{distinct}").alias("n_near"))
    return queries.join(got, ["patch_id", *key], "left").withColumn("n_near", F.coalesce("n_near", F.lit(0)))


def fusion_qc(rows: DataFrame, least_threshold: float = 0.2, q: float = 0.99, coverage_gate: float = 0.6, by: tuple[str, ...] = ("patch_id",)) -> DataFrame:
    """Quantiles of |z - cloud_z|, the threshold (at least `least_threshold`), coverage
    and status."""
    residual = F.abs(F.col("z") - F.col("cloud_z"))
    got = rows.groupBy(*by).agg(
        F.count("*").alias("n_traj"), F.count(residual).alias("n_valid"),
        *[F.percentile(residual, F.lit(p)).alias(f"p{round(100 * p)}") for p in (0.5, 0.9, 0.99)], F.percentile(residual, F.lit(q)).alias("_q"),
    )
    coverage = F.col("n_valid") / F.col("n_traj")
    status = F.when(F.col("n_valid") == 0, "NO_VALID").when(coverage < coverage_gate, "LOW_COVERAGE").otherwise("OK")
    return got.withColumns({"threshold": F.greatest(F.lit(least_threshold), F.col("_q")), "coverage": coverage, "status": status}).drop("_q")


def sliding_bin_score(rows: DataFrame, thresholds: DataFrame, width: int = 64, stride: int = 16, coverage_gate: float = 0.6) -> DataFrame:
    """Median |z - cloud_z| of windows of `width` vertices at every `stride`-th one.
    Windows run to the end of the data, where they are shorter. A vertex is in at
    most width / stride windows, so it is copied to those and aggregated."""
    ix = F.row_number().over(along()) - 1
    rows = rows.withColumns({"i": ix, "residual": F.abs(F.col("z") - F.col("cloud_z"))})
    first = F.greatest(F.lit(0), F.floor((F.col("i") - width) / stride) + 1).cast("int")
    bins = rows.withColumn("bin", F.explode(F.sequence(first, F.floor(F.col("i") / stride).cast("int"))))
    got = bins.groupBy(*TRAJ, "bin").agg(F.count("*").alias("span"), F.count("residual").alias("n_valid"), F.percentile("residual", F.lit(0.5)).alias("score"))
    got = got.join(thresholds.select(*TRAJ, "threshold"), list(TRAJ))
    enough = F.col("n_valid") / F.col("span") >= coverage_gate
    return got.withColumn("abnormal", enough & F.coalesce(F.col("score") > F.col("threshold"), F.lit(False)))


def runs(rows: DataFrame, by: list[str], order: str, flag: Column) -> DataFrame:
    """Rows where `flag` holds, with `run`: equal for consecutive values of `order`."""
    own = rows.where(flag)
    return own.withColumn("run", F.col(order) - F.row_number().over(Window.partitionBy(*by).orderBy(order)))


def abnormal_runs(bins: DataFrame, least: int = 2, top: int = 5, width: int = 64, stride: int = 16) -> DataFrame:
    """Runs of at least `least` abnormal windows, the `top` with the highest score."""
    by = list(TRAJ)
    got = runs(bins, by, "bin", F.col("abnormal")).groupBy(*by, "run").agg(F.min("bin").alias("start_bin"), (F.max("bin") + 1).alias("end_bin"), F.max("score").alias("score"))
    got = got.where(F.col("end_bin") - F.col("start_bin") >= least)
    got = got.withColumns({"start_idx": F.col("start_bin") * stride, "end_idx": (F.col("end_bin") - 1) * stride + width})
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), "start_bin"))
    return got.withColumn("rank", rank).where(F.col("rank") <= top).drop("run")


def clearance_qc(rows: DataFrame, threshold: float = 0.5, coverage_gate: float = 0.8, outlier_gate: float = 0.05, p99_gate: float = 2.0, by: tuple[str, ...] = ("patch_id",), mean: bool = False) -> DataFrame:
    """Clearance z - ground_z against its own baseline (median or mean): quantiles,
    bias, share of outliers, coverage and gates. Two aggregations: the baseline first."""
    d = F.col("z") - F.col("ground_z")
    base = rows.groupBy(*by).agg((F.avg(d) if mean else F.percentile(d, F.lit(0.5))).alias("baseline"))
    r = d - F.col("baseline")
    got = rows.join(base, list(by)).groupBy(*by, "baseline").agg(
        F.count("*").alias("n_total"), F.count(r).alias("n_valid"),
        *[F.percentile(F.abs(r), F.lit(p)).alias(f"p{round(100 * p)}") for p in (0.5, 0.9, 0.99)],
        F.coalesce(F.avg(F.when(r.isNotNull(), (F.abs(r) > threshold).cast("double"))), F.lit(0.0)).alias("outlier_ratio"), F.avg(r).alias("bias"),
    )
    got = got.withColumn("coverage", F.col("n_valid") / F.col("n_total"))
    gates = {"coverage_ok": F.col("coverage") >= coverage_gate, "outlier_ok": F.col("outlier_ratio") <= outlier_gate, "p99_ok": F.coalesce(F.col("p99") <= p99_gate, F.lit(False))}
    return got.withColumns(gates).withColumn("overall_pass", F.col("coverage_ok") & F.col("outlier_ok") & F.col("p99_ok"))


def residuals(rows: DataFrame, by: tuple[str, ...] = ("patch_id",)) -> DataFrame:
    """Rows with residual: z - ground_z less the group's median."""
    d = F.col("z") - F.col("ground_z")
    base = rows.groupBy(*by).agg(F.percentile(d, F.lit(0.5)).alias("_b"))
    return rows.join(base, list(by)).withColumn("residual", d - F.col("_b")).drop("_b")


def equal_bins(rows: DataFrame, bins: int = 20, threshold: float = 0.5, outlier_gate: float = 0.2) -> DataFrame:
    """Index ranges of a trajectory's vertices in `bins` parts (edges truncated): mean
    |residual|, share of outliers and whether it is an anomaly."""
    n = F.count("*").over(Window.partitionBy(*TRAJ))
    rows = rows.withColumns({"i": F.row_number().over(along()) - 1, "n": n, "a": F.abs("residual")})
    k = F.least(F.lit(bins), F.col("n"))
    # The bin b with floor(b n / k) <= i < floor((b + 1) n / k).
    guess = F.floor(F.col("i") * k / F.col("n"))
    b = F.when(F.floor((guess + 1) * F.col("n") / k) <= F.col("i"), guess + 1).otherwise(guess)
    rows = rows.withColumn("bin", b.cast("int"))
    got = rows.groupBy(*TRAJ, "bin").agg(
        F.min("i").alias("start_idx"), F.max("i").alias("end_idx"), F.avg("a").alias("mean_abs"),
        F.coalesce(F.avg(F.when(F.col("a").isNotNull(), (F.col("a") > threshold).cast("double"))), F.lit(0.0)).alias("outlier_ratio"),
    )
    return got.withColumn("anomaly", F.coalesce(F.col("mean_abs") > threshold, F.lit(False)) | (F.col("outlier_ratio") > outlier_gate))


def interval_merge_topk(bins: DataFrame, least: int = 1, top: int = 5) -> DataFrame:
    """Runs of anomalous bins by score: greatest mean times (1 + greatest share)."""
    by = list(TRAJ)
    got = runs(bins, by, "bin", F.col("anomaly")).groupBy(*by, "run").agg(
        F.min("bin").alias("start_bin"), F.max("bin").alias("end_bin"), F.min("start_idx").alias("start_idx"), F.max("end_idx").alias("end_idx"),
        F.max("mean_abs").alias("m"), F.max("outlier_ratio").alias("o"),
    )
    got = got.where(F.col("end_bin") - F.col("start_bin") + 1 >= least).withColumn("score", F.coalesce(F.col("m") * (1 + F.col("o")), F.col("o")))
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), "start_bin"))
    return got.withColumn("rank", rank).where(F.col("rank") <= top).drop("run", "m", "o")


def heading(traj: DataFrame) -> DataFrame:
    """Adds hx, hy: the unit direction at a vertex from its neighbours, one-sided at the
    ends, NULL where nothing moves."""
    step = lambda c: F.coalesce(F.lead(c).over(along()), F.col(c)) - F.coalesce(F.lag(c).over(along()), F.col(c))
    rows = traj.withColumns({"_dx": step("x"), "_dy": step("y")})
    n = F.sqrt(F.col("_dx") ** 2 + F.col("_dy") ** 2)
    return rows.withColumns({"hx": F.when(n > 0, F.col("_dx") / n), "hy": F.when(n > 0, F.col("_dy") / n)}).drop("_dx", "_dy")


def traj_gap_split(traj: DataFrame, distance: float = 10.0, seconds: float = 1.0, seq_gap: int = 1, untimed_factor: float = 2.5) -> DataFrame:
    """Adds `piece`: a new one after a jump in distance, time or seq. Pieces of one
    vertex are dropped, unless the trajectory has no others."""
    dx, dy, dt, ds = (F.col(c) - F.lag(c).over(along()) for c in ("x", "y", "t", "seq"))
    far = F.when(dt.isNull() & (ds <= seq_gap), distance * untimed_factor).otherwise(distance)
    cut = (F.sqrt(dx**2 + dy**2) > far) | F.coalesce(dt > seconds, F.lit(False)) | F.coalesce(ds > seq_gap, F.lit(False))
    rows = traj.withColumn("_cut", F.coalesce(cut, F.lit(False)).cast("int"))
    rows = rows.withColumn("piece", F.sum("_cut").over(along()))
    rows = rows.withColumn("_n", F.count("*").over(Window.partitionBy(*TRAJ, "piece")))
    rows = rows.withColumn("_best", F.max("_n").over(Window.partitionBy(*TRAJ)))
    rows = rows.withColumn("piece", F.when(F.col("_best") >= 2, F.col("piece")).otherwise(0))
    return rows.where((F.col("_n") >= 2) | (F.col("_best") < 2)).drop("_cut", "_n", "_best")


def traj_split_stats(traj: DataFrame, distance: float = 10.0, seconds: float = 1.0) -> DataFrame:
    """Per patch: breaks by reason (distance first, then time) and gap quantiles."""
    dx, dy, dt = (F.col(c) - F.lag(c).over(along()) for c in ("x", "y", "t"))
    rows = traj.select("patch_id", F.sqrt(dx**2 + dy**2).alias("d"), dt.alias("dt"))
    reason = F.when(F.col("d") > distance, "distance").when(F.col("dt") > seconds, "time")
    return rows.groupBy("patch_id").agg(
        F.count_if(reason == "distance").alias("by_distance"), F.count_if(reason == "time").alias("by_time"),
        F.percentile("d", F.lit(0.5)).alias("d_p50"), F.percentile("d", F.lit(0.9)).alias("d_p90"), F.max("d").alias("d_max"), F.max("dt").alias("t_max"),
    )


def consecutive_cell_dedup(traj: DataFrame, size: float = 5.0) -> DataFrame:
    """The first vertex of every stay in a cell."""
    rows = cell(finite_filter(traj, "x", "y"), size)
    stay = F.coalesce((F.lag("ix").over(along()) == F.col("ix")) & (F.lag("iy").over(along()) == F.col("iy")), F.lit(False))
    return rows.withColumn("_s", stay).where("NOT _s").drop("_s")


def road_z_variation(traj: DataFrame, road_z: DataFrame, size: float = 5.0) -> DataFrame:
    """|change| of the road's height along each trajectory's sequence of cells, and
    over all of a patch (traj_id NULL)."""
    rows = consecutive_cell_dedup(traj, size).join(road_z.select("patch_id", "ix", "iy", "road_z"), ["patch_id", "ix", "iy"])
    rows = rows.withColumn("dz", F.abs(F.col("road_z") - F.lag("road_z").over(along())))
    stats = [F.percentile("dz", F.lit(p)).alias(f"p{round(100 * p)}") for p in (0.5, 0.9, 0.99)]
    return rows.where("dz IS NOT NULL").groupingSets([["patch_id", "traj_id"], ["patch_id"]], "patch_id", "traj_id").agg(F.count("*").alias("n"), *stats, F.max("dz").alias("max_dz"))


def series_stats(rows: DataFrame, value: Column, by: list[str]) -> DataFrame:
    value = F.when(~F.isnan(value), value)
    stats = [F.percentile(value, F.lit(p)).alias(f"p{round(100 * p)}") for p in (0.5, 0.9, 0.99)]
    return rows.groupBy(*by).agg(F.count(value).alias("n"), F.min(value).alias("min"), *stats, F.max(value).alias("max"), F.avg(value).alias("mean"))


def traj_z_degraded(traj: DataFrame, nonzero_gate: float = 0.01, std_gate: float = 0.05) -> DataFrame:
    """Whether a patch's trajectory heights carry nothing: nearly all zero and flat."""
    z = F.when(finite("z"), F.col("z")).otherwise(0.0)
    got = traj.groupBy("patch_id").agg(F.count("*").alias("n"), F.avg((F.abs(z) > 1e-9).cast("double")).alias("nonzero_ratio"), F.stddev_pop(z).alias("z_std"))
    return got.withColumn("degraded", (F.col("nonzero_ratio") < nonzero_gate) & (F.col("z_std") < std_gate))


def max_turn_and_segment(traj: DataFrame) -> DataFrame:
    """Per trajectory: the greatest turn, scaled to 10 m (a vertex's turn over the mean
    of its edges), and the longest edge."""
    dx, dy = F.col("x") - F.lag("x").over(along()), F.col("y") - F.lag("y").over(along())
    rows = traj.withColumns({"dx": dx, "dy": dy}).withColumn("d", F.sqrt(F.col("dx") ** 2 + F.col("dy") ** 2))
    nx, ny, nd = (F.lead(c).over(along()) for c in ("dx", "dy", "d"))
    cos = (F.col("dx") * nx + F.col("dy") * ny) / (F.col("d") * nd)
    turn = F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cos)))) * 10 / ((F.col("d") + nd) / 2)
    rows = rows.withColumn("turn", F.when((F.col("d") > 0) & (nd > 0), turn))
    return rows.groupBy(*TRAJ).agg(F.max("turn").alias("max_turn_10m"), F.max("d").alias("max_segment"))


def span_group(rows: DataFrame, by: list[str], position: str, seq_gap: int = 12, station_gap: float = 25.0) -> DataFrame:
    """Spans of projected vertices: a new one where seq or station jumps."""
    order = Window.partitionBy(*by).orderBy("seq")
    cut = (F.col("seq") - F.lag("seq").over(order) > seq_gap) | (F.abs(F.col(position) - F.lag(position).over(order)) > station_gap)
    rows = rows.withColumn("_cut", F.coalesce(cut, F.lit(False)).cast("int")).withColumn("span", F.sum("_cut").over(order))
    return rows.groupBy(*by, "span").agg(F.min(position).alias("start_s"), F.max(position).alias("end_s"), F.count("*").alias("n"))


def span_union(spans: DataFrame, by: list[str], gap: float = 0.0) -> DataFrame:
    """Union of spans [start_s, end_s], bridging gaps up to `gap`."""
    order = Window.partitionBy(*by).orderBy("start_s", "end_s")
    reach = F.max("end_s").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.coalesce(F.col("start_s") > reach + gap, F.lit(True)).cast("int")
    rows = spans.withColumn("_new", new).withColumn("island", F.sum("_new").over(order))
    return rows.groupBy(*by, "island").agg(F.min("start_s").alias("start_s"), F.max("end_s").alias("end_s"))


def span_union_coverage(spans: DataFrame, by: list[str], length: str, gap: float = 0.0) -> DataFrame:
    """Share of a line's length that the union of its spans covers."""
    lengths = spans.groupBy(*by).agg(F.max(length).alias("length_m"))
    covered = span_union(spans, by, gap).groupBy(*by).agg(F.sum(F.col("end_s") - F.col("start_s")).alias("covered"))
    return covered.join(lengths, by).withColumn("coverage", F.least(F.lit(1.0), F.col("covered") / F.col("length_m")))


def interval_allocate(rows: DataFrame, by: list[str], centre: str, length: str, gap: float = 0.1) -> DataFrame:
    """Centres of ordered intervals on a line moved to lie at least `gap` apart: each to
    the greatest of (earlier centre + gaps between), then all back together if the last
    one overran the line."""
    order = Window.partitionBy(*by).orderBy("rank")
    run = F.max(F.col(centre) - F.col("rank") * gap).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) + F.col("rank") * gap
    over = F.greatest(F.lit(0.0), F.max("moved").over(Window.partitionBy(*by)) - F.col(length))
    return rows.withColumn("moved", run).withColumn("moved", F.col("moved") - over)


def interval_keep_apart(rows: DataFrame, by: list[str], gap: float = 0.1) -> DataFrame:
    """Intervals of one line (by..., arc_id, start_s, end_s, length: of the line) without overlaps:
    (by..., arc_id, rank, raw_s, raw_e, start_s, end_s, ordered). By centre, then arc, centres move apart
    (interval_allocate). A centre stays within its own interval, and ends lie half a gap from the middle between
    neighbouring centres. An interval with nothing left is a quarter of its width, 0.01 to 0.25 m, to
    either side of its centre. `ordered` is whether it begins no earlier than the one before it ends."""
    order = Window.partitionBy(*by).orderBy("rank")
    ranked = rows.withColumn("centre", (F.col("start_s") + F.col("end_s")) / 2).withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(F.round("centre", 9), "arc_id")))
    moved = interval_allocate(ranked, by, "centre", "length", gap).withColumn("moved", F.when(F.max("moved").over(Window.partitionBy(*by)) + 1e-12 >= F.col("length"), F.greatest(F.lit(0.0), F.col("moved"))).otherwise(F.col("moved")))
    at = F.least(F.greatest("moved", "start_s"), F.col("end_s"))
    rest = moved.withColumns({"at": at, "before": F.lag("moved").over(order), "after": F.lead("moved").over(order)})
    low = F.greatest(F.col("start_s"), (F.col("before") + F.col("at")) / 2 + gap / 2)  # nulls are passed over
    high = F.least(F.col("end_s"), (F.col("at") + F.col("after")) / 2 - gap / 2)
    rest = rest.withColumns({"lo": low, "hi": high})
    empty = F.col("hi") < F.col("lo")
    rest = rest.withColumns({"lo": F.greatest("start_s", F.when(empty, F.col("at")).otherwise(F.col("lo"))), "hi": F.least("end_s", F.when(empty, F.col("at")).otherwise(F.col("hi")))})
    half = F.least(F.lit(0.25), F.greatest(F.lit(0.01), (F.col("end_s") - F.col("start_s")) / 4))
    thin = F.col("hi") <= F.col("lo") + 1e-6
    rest = rest.withColumns({"lo": F.when(thin, F.greatest("start_s", F.col("at") - half)).otherwise(F.col("lo")), "hi": F.when(thin, F.least("end_s", F.col("at") + half)).otherwise(F.col("hi"))})
    ordered = F.coalesce(F.col("lo") >= F.lag("hi").over(order) - 1e-6, F.lit(True))
    return rest.withColumn("ordered", ordered).select(*by, "arc_id", "rank", F.col("start_s").alias("raw_s"), F.col("end_s").alias("raw_e"), F.col("lo").alias("start_s"), F.col("hi").alias("end_s"), "ordered")


def offset_interpolate(rows: DataFrame, by: list[str], order: str, value: str) -> DataFrame:
    """Fills missing values linearly between their neighbours, and with the nearest
    value at the ends."""
    back = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(*by).orderBy(order).rowsBetween(0, Window.unboundedFollowing)
    at = F.when(F.col(value).isNotNull(), F.col(order))
    v0, s0 = F.last(value, ignorenulls=True).over(back), F.last(at, ignorenulls=True).over(back)
    v1, s1 = F.first(value, ignorenulls=True).over(ahead), F.first(at, ignorenulls=True).over(ahead)
    mid = v0 + (v1 - v0) * (F.col(order) - s0) / (s1 - s0)
    return rows.withColumn("filled", F.coalesce(F.col(value), mid, v0, v1))


def offset_smooth(rows: DataFrame, by: list[str], order: str, value: str, half: int = 2, most_step: float = 0.0) -> DataFrame:
    """Two passes of a centred moving average, with the edge values repeated, then, where `most_step` is
    above 0, a slew limit."""
    w = Window.partitionBy(*by).orderBy(order)
    whole = Window.partitionBy(*by)
    for _ in range(2):
        rows = rows.withColumns({"_i": F.row_number().over(w), "_n": F.count("*").over(whole)})
        first, last = F.first(value).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)), F.last(value).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        # A value beyond an edge is the edge's own: in a short line both may be repeated.
        low, high = F.greatest(F.lit(0), half + 1 - F.col("_i")), F.greatest(F.lit(0), F.col("_i") + half - F.col("_n"))
        total = F.sum(value).over(w.rowsBetween(-half, half)) + first * low + last * high
        rows = rows.withColumn(value, total / (2 * half + 1)).drop("_i", "_n")
    return slew_limit(rows, by, order, value, most_step) if most_step > 0 else rows


def slew_limit(rows: DataFrame, by: list[str], order: str, value: str, most_step: float) -> DataFrame:
    """Each value moved towards the one before it (as already moved) until it is at most
    `most_step` away; nulls stay and are passed over. The rule goes along a line, so a task streams through sorted
    lines and holds one value."""
    names = rows.columns
    dealt = rows.repartition(*by).sortWithinPartitions(*by, order)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, held = None, None
        for pdf in frames:
            out = []
            for own, x in zip(zip(*[pdf[c] for c in by]), pdf[value].tolist()):
                if own != key:
                    key, held = own, None
                if x is not None and x == x:
                    held = x if held is None else min(max(x, held - most_step), held + most_step)
                    x = held
                out.append(x)
            yield pdf.assign(**{value: out})[names]

    return dealt.mapInPandas(run, dealt.schema)
