"""Cross-section profiles, layers along trajectories, parameter sweeps and reports."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import tiles
from .groups import fold_groups
from .network import cut
from .series import TRAJ, along, heading, runs


def xsec_profile_fit(traj: DataFrame, ground: DataFrame, radius: float = 8.0, half_width: float = 5.0, along: float = 3.0, bins: int = 21, least_bins: int = 5, p90_gate: float = 0.5) -> DataFrame:
    """Per vertex: the ground across its heading. Points within `along` of it and
    `half_width` beside it fall into bins; a straight line through the bins' medians
    gives p90 of the absolute residuals. The last bin is without its right edge. Vertices of one place and heading are worked out once, in tiles."""
    ground = ground.select("patch_id", "x", "y", F.coalesce("z", F.lit(0.0)).alias("z"), F.col("z").isNotNull().alias("known"))
    place = ["patch_id", "x", "y", "hx", "hy"]
    own = heading(traj).select("patch_id", "traj_id", "seq", *place[1:])
    schema = "patch_id long, x double, y double, hx double, hy double, support long, n_bins long, slope double, level double, p90 double"
    got = tiles.by_tiles(cut(own.where("hx IS NOT NULL").select(*place).distinct()), ground, min(radius, math.hypot(half_width, along)), tiles.profile_across(radius, half_width, along, bins), schema)
    out = own.join(cut(got), place, "left").select("patch_id", "traj_id", "seq", "support", "n_bins", "slope", "level", "p90")
    out = out.withColumns({"support": F.coalesce("support", F.lit(0)), "coverage": F.coalesce("n_bins", F.lit(0)) / bins})
    return out.withColumn("anomaly", F.coalesce((F.col("n_bins") < least_bins) | (F.col("p90") > p90_gate) | F.col("p90").isNull(), F.lit(True)))


def xsec_metrics(profiles: DataFrame) -> DataFrame:
    """Per patch: shares of valid and anomalous vertices, quantiles and gates."""
    got = profiles.groupBy("patch_id").agg(
        F.count("*").alias("n"), F.avg(F.col("p90").isNotNull().cast("double")).alias("valid_ratio"), F.avg(F.col("anomaly").cast("double")).alias("anomaly_ratio"),
        F.percentile("p90", F.lit(0.5)).alias("p50"), F.percentile("p90", F.lit(0.9)).alias("p90_of_p90"), F.percentile("support", F.lit(0.5)).alias("support_p50"),
    )
    return got.withColumns({"valid_ok": F.col("valid_ratio") >= 0.8, "anomaly_ok": F.col("anomaly_ratio") <= 0.2, "p90_ok": F.coalesce(F.col("p90_of_p90") <= 0.5, F.lit(False))})


def xsec_intervals(profiles: DataFrame, least: int = 3) -> DataFrame:
    """Runs of at least `least` anomalous vertices, with least support and greatest p90."""
    rows = profiles.withColumn("i", F.row_number().over(along()))
    got = runs(rows, list(TRAJ), "i", F.col("anomaly")).groupBy(*TRAJ, "run").agg(F.min("i").alias("start_i"), F.max("i").alias("end_i"), F.min("support").alias("min_support"), F.max("p90").alias("max_p90"))
    return got.where(F.col("end_i") - F.col("start_i") + 1 >= least).drop("run")


def param_sweep(rows: DataFrame, trials: DataFrame, value: Column, gate: float) -> DataFrame:
    """The setting for each patch: of `trials` (trial_id, band, margin) the first that
    passes, else the one with the least penalty. All trials are measured in one
    aggregation; the list of trials is a bounded parameter and is sent to all tasks."""
    d = F.abs(value - F.col("margin"))
    many = rows.join(F.broadcast(trials), how="cross")
    got = many.groupBy("patch_id", "trial_id").agg(F.round(F.avg((d > F.col("band")).cast("double")), 9).alias("outliers"), F.round(F.percentile(d, F.lit(0.9)), 9).alias("p90"))
    got = got.withColumns({"passed": F.col("outliers") <= gate, "penalty": F.round(F.col("outliers") + F.col("p90"), 9)})
    order = F.struct(~F.col("passed"), F.when(F.col("passed"), F.col("trial_id").cast("double")).otherwise(F.col("penalty")), "trial_id")
    return got.groupBy("patch_id").agg(F.min_by(F.struct("trial_id", "outliers", "p90", "passed"), order).alias("best"), F.count("*").alias("n_trials")).select("patch_id", "best.*", "n_trials")


def road_z_layer_path(visits: DataFrame, switch_cost: float = 0.5, carry: tuple[str, ...] = ()) -> DataFrame:
    """Layer of each visited cell along a trajectory: of its two height peaks (peak0,
    peak1, the latter perhaps NULL) the choice with the least sum of height changes
    plus `switch_cost` for each change of layer. visits: patch_id, traj_id, seq, peak0, peak1 and
    the columns of whole numbers to `carry`.

    A two-state dynamic program, one trajectory at a time; trajectories stay spread
    over the cluster. Of equal ways the one over the first peak is taken."""

    def solve(rows: list) -> list[tuple]:
        inf, back, cost, last = float("inf"), [], (0.0, 0.0), None
        for r in rows:
            z = (float(r.peak0), inf if r.peak1 is None or r.peak1 != r.peak1 else float(r.peak1))
            if last is None:
                came, cost = (0, 0), (0.0, 0.0 if z[1] < inf else inf)
            else:
                way = lambda p, s: inf if inf in (cost[p], z[s], last[p]) else cost[p] + abs(z[s] - last[p]) + (0 if p == s else switch_cost)  # noqa: E731, B023
                ways = [(way(0, s), way(1, s)) for s in (0, 1)]
                came, cost = tuple(0 if x <= y else 1 for x, y in ways), tuple(min(w) for w in ways)
            back.append((came, z))
            last = z
        layer, out = 0 if cost[0] <= cost[1] else 1, []
        for r, (came, z) in zip(reversed(rows), reversed(back)):
            out.append((r.patch_id, r.traj_id, r.seq, *[getattr(r, c) for c in carry], layer, z[layer]))
            layer = came[layer]
        return out

    schema = ", ".join(f"{c} long" for c in (*TRAJ, "seq", *carry)) + ", layer int, layer_z double"
    return fold_groups(visits.select(*TRAJ, "seq", *carry, "peak0", "peak1"), list(TRAJ), ["seq"], solve, schema)


def road_z_by_votes(peaks: DataFrame, path: DataFrame) -> DataFrame:
    """Road height of each cell (patch_id, ix, iy, n_votes, road_z): the median of what trajectories chose there
    (road_z_layer_path with ix, iy), else the cell's first peak."""
    cell = ["patch_id", "ix", "iy"]
    votes = path.groupBy(*cell).agg(F.count("*").alias("n_votes"), F.percentile("layer_z", F.lit(0.5)).alias("mid"))
    rows = peaks.select(*cell, "peak0").join(votes, cell, "left")
    return rows.select(*cell, F.coalesce("n_votes", F.lit(0)).alias("n_votes"), F.coalesce("mid", "peak0").alias("road_z"))


def layer_path_stats(path: DataFrame) -> DataFrame:
    """Per trajectory of road_z_layer_path: (n_cells, dz_p50, dz_p90, dz_max, upper_share): quantiles of the steps in height
    (0 where there is none) and the share of cells on the second peak."""
    step = F.abs(F.col("layer_z") - F.lag("layer_z").over(Window.partitionBy(*TRAJ).orderBy("seq")))
    rows = path.withColumn("dz", step)
    q = lambda p: F.coalesce(F.percentile("dz", F.lit(p)), F.lit(0.0))
    return rows.groupBy(*TRAJ).agg(
        F.count("*").alias("n_cells"), q(0.5).alias("dz_p50"), q(0.9).alias("dz_p90"), F.coalesce(F.max("dz"), F.lit(0.0)).alias("dz_max"), F.avg((F.col("layer") == 1).cast("double")).alias("upper_share")
    )


def distance_downsample(traj: DataFrame, step: float) -> DataFrame:
    """Vertices at least `step` from the last kept one, and both ends: a fold over the
    ordered vertices of one trajectory."""

    def fold(rows: list) -> list[tuple]:
        out, last = [], None
        for i, r in enumerate(rows):
            far = last is None or math.hypot(r.x - last.x, r.y - last.y) >= step
            if far or i == len(rows) - 1:
                out.append((r.patch_id, r.traj_id, r.seq, r.x, r.y))
            last = r if far else last
        return out

    return fold_groups(traj.select(*TRAJ, "seq", "x", "y"), list(TRAJ), ["seq"], fold, "patch_id long, traj_id long, seq long, x double, y double")


def cluster_1d(rows: DataFrame, by: list[str], key: str, value: str, tolerance: float) -> DataFrame:
    """Adds `cluster`: values in order, a new cluster where the step to the one before
    is over `tolerance` (single linkage), numbered by value."""
    w = Window.partitionBy(*by).orderBy(value, key)
    new = F.coalesce(F.col(value) - F.lag(value).over(w) > tolerance, F.lit(False)).cast("int")
    return rows.withColumn("_n", new).withColumn("cluster", F.sum("_n").over(w)).drop("_n")


def channel_split(rows: DataFrame, by: list[str], key: str, value: str, sep: float, least: int = 4) -> DataFrame:
    """Per group: its clusters of offsets (steps up to 0.45 * sep), the share of the
    largest, and whether centres lie more than `sep` apart."""
    marked = cluster_1d(rows, by, key, value, 0.45 * sep)
    got = marked.groupBy(*by, "cluster").agg(F.count("*").alias("n"), F.avg(value).alias("centre"))
    out = got.groupBy(*by).agg(F.sum("n").alias("n"), F.count("*").alias("n_clusters"), F.max("n").alias("main_n"), (F.max("centre") - F.min("centre")).alias("spread"))
    return out.withColumns({"main_share": F.col("main_n") / F.col("n"), "multi": (F.col("n") >= least) & (F.col("spread") > sep)})


def channel_labels(rows: DataFrame, by: list[str], key: str, sep: float, top: int = 40, least: int = 4) -> DataFrame:
    """The channel of each item (by..., key, x, y: its middle) of a group: (by..., key, label, kept, n, n_clusters, spread,
    main_label, main_share, multi).

    The medoid is the one of the group's first `top` items (by key) with the least sum of distances to the others
    of them. Their distances from it, in order, join the last cluster while they are within
    max(1, 0.45 * sep) of its running mean, and else begin one. Every item of the group then has the cluster with the
    nearest centre (the first of equally near ones). Groups whose centres span more than `sep` are
    `multi`, and only their largest cluster (the first of equal ones) is kept. Groups of fewer than `least` items or with one cluster stay whole."""
    ranked = rows.select(*by, key, "x", "y").withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(key)))
    first = ranked.where(F.col("_r") <= max(3, top))
    other = first.select(*by, F.col("x").alias("x2"), F.col("y").alias("y2"))
    away = F.sqrt((F.col("x") - F.col("x2")) ** 2 + (F.col("y") - F.col("y2")) ** 2)
    total = first.join(other, by).groupBy(*by, "_r").agg(F.round(F.sum(away), 6).alias("total"), F.first("x").alias("mx"), F.first("y").alias("my"))
    medoid = total.groupBy(*by).agg(F.min_by(F.struct("mx", "my"), F.struct("total", "_r")).alias("m"))
    radial = F.round(F.sqrt((F.col("x") - F.col("m.mx")) ** 2 + (F.col("y") - F.col("m.my")) ** 2), 9)
    spread = ranked.join(medoid, by).withColumn("radial", radial).drop("m")
    # The fold's state: centres, the last one open, and how many it has taken in.
    zero = F.struct(F.array().cast("array<double>").alias("c"), F.lit(0.0).alias("n"))

    def take(a, v):
        last = F.try_element_at(a.c, F.size(a.c))
        joined = F.struct(F.concat(F.slice(a.c, 1, F.size(a.c) - 1), F.array(last + (v - last) / (a.n + 1))).alias("c"), (a.n + 1).alias("n"))
        begun = F.struct(F.concat(a.c, F.array(v)).alias("c"), F.lit(1.0).alias("n"))
        return F.when((F.size(a.c) > 0) & (F.round(v - last, 9) <= max(1.0, 0.45 * sep)), joined).otherwise(begun)

    centres = spread.where(F.col("_r") <= max(3, top)).groupBy(*by).agg(F.array_sort(F.collect_list("radial")).alias("v"))
    centres = centres.select(*by, F.aggregate("v", zero, take).c.alias("centres"))
    gaps = F.transform("centres", lambda c: F.round(F.abs(F.col("radial") - c), 9))
    marked = spread.join(centres, by).withColumn("label", (F.array_position(gaps, F.array_min(gaps)) - 1).cast("int"))
    sizes = marked.groupBy(*by, "label", "centres").agg(F.count("*").alias("size"))
    wide = F.element_at("centres", -1) - F.element_at("centres", 1)
    group = sizes.groupBy(*by).agg(F.sum("size").alias("n"), F.max(F.size("centres")).alias("n_clusters"), F.max(wide).alias("spread"), F.max(F.struct("size", (-F.col("label")).alias("l"))).alias("main"))
    split = (F.col("n") >= least) & (F.col("n_clusters") > 1)
    group = group.select(
        *by, "n", F.when(split, F.col("n_clusters")).otherwise(1).alias("n_clusters"), F.when(split, F.col("spread")).alias("spread"), F.when(split, -F.col("main.l")).otherwise(0).alias("main_label"),
        F.when(split, F.col("main.size") / F.col("n")).otherwise(1.0).alias("main_share"), (split & (F.col("spread") > sep)).alias("multi"),
    )
    out = marked.select(*by, key, "label").join(group, by).withColumn("label", F.when(F.col("n_clusters") > 1, F.col("label")).otherwise(0))
    return out.withColumn("kept", ~F.col("multi") | (F.col("label") == F.col("main_label")))


def segment_select(rows: DataFrame, by: list[str], keys: list[Column], top: int = 2) -> DataFrame:
    """Rank within each pair by several keys; the first `top` stay, the rest say why."""
    w = Window.partitionBy(*by).orderBy(*keys)
    return rows.withColumn("rank", F.row_number().over(w)).withColumn("drop_reason", F.when(F.col("rank") > top, "beyond_top_k"))


def segment_filter() -> Column:
    """First reason against a segment, NULL if there is none."""
    return (
        F.when(F.col("length_m") < 5, "too_short").when(F.coalesce(F.col("ratio"), F.lit(0.0)) < 0.85, "outside_zone")
        .when(F.coalesce(F.col("crosses_divider"), F.lit(False)), "crosses_divider").when(F.coalesce(F.col("n_other"), F.lit(0)) > 1, "other_cross_sections")
    )


# --- reports ---------------------------------------------------------------------


def breakpoint_summary(rows: DataFrame) -> DataFrame:
    return rows.groupBy("code").agg(F.count("*").alias("n"))


def breakpoint_topk(rows: DataFrame, severity: dict[str, int], k: int, by: list[str]) -> DataFrame:
    """The k gravest breakpoints of each group: by severity, code and node."""
    rank = F.lit(len(severity))
    for name, place in severity.items():
        rank = F.when(F.col("severity") == name, place).otherwise(rank)
    w = Window.partitionBy(*by).orderBy(rank, "code", "node_id")
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def text_budget(lines: DataFrame, by: list[str], order: str, max_lines: int = 120, max_bytes: int = 8192) -> DataFrame:
    """Lines of each report up to a number of lines and of UTF-8 bytes (with their line
    ends); `truncated` marks reports that lost some. Only the first `max_lines` of a report are
    put in order."""
    w = Window.partitionBy(*by).orderBy(order)
    rows = lines.withColumn("_i", F.row_number().over(w)).withColumn("_total", F.count("*").over(Window.partitionBy(*by)))
    rows = rows.where(F.col("_i") <= max_lines).withColumn("_size", F.sum(F.octet_length("line") + 1).over(w)).where(F.col("_size") <= max_bytes)
    kept = F.count("*").over(Window.partitionBy(*by))
    return rows.withColumn("truncated", kept < F.col("_total")).drop("_i", "_size", "_total")


def field_probe(rows: DataFrame, props: str) -> DataFrame:
    """Per key of a map column, lower-cased: rows, spellings, whole numbers, distinct values."""
    pairs = rows.select(F.explode(props).alias("raw", "value")).withColumn("key", F.lower("raw"))
    return pairs.groupBy("key").agg(
        F.count("*").alias("n"), F.count_distinct("raw").alias("n_spellings"), F.count_if(F.col("value").rlike(r"^-?[0-9]+$")).alias("n_integer"), F.count_distinct("value").alias("n_values")
    )


def snapshot_compare(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of (path, kind, value) in one snapshot but not in the other."""
    cols = ["path", "kind", "value"]
    return a.select(*cols).exceptAll(b.select(*cols)).withColumn("side", F.lit("a")).union(b.select(*cols).exceptAll(a.select(*cols)).withColumn("side", F.lit("b")))


def snapshot_first_mismatch(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """(file, path, code, expected, actual): where each file first departs from its snapshot, in the snapshot's order. Both hold one row
    for each node of a document: file, ord, path, kind, value; an object's value is the list of its keys, in order, a list's value its
    length. Codes: missing, type_mismatch, key_mismatch, list_length_mismatch, value_mismatch. Files that agree have no row."""
    other = actual.select("file", "path", F.col("kind").alias("a_kind"), F.col("value").alias("a_value"))
    rows = expected.select("file", "ord", "path", "kind", "value").join(other, ["file", "path"], "left")
    code = F.when(F.col("a_kind").isNull(), "missing").when(F.col("kind") != F.col("a_kind"), "type_mismatch").when(~F.col("value").eqNullSafe(F.col("a_value")), F.when(F.col("kind") == "object", "key_mismatch").when(F.col("kind") == "list", "list_length_mismatch").otherwise("value_mismatch"))
    of = lambda p: F.when(F.col("code") == "type_mismatch", F.col(f"{p}kind")).otherwise(F.col(f"{p}value"))
    rows = rows.withColumn("code", code).where("code IS NOT NULL").select("file", "ord", "path", "code", of("").alias("expected"), of("a_").alias("actual"))
    return rows.groupBy("file").agg(F.min_by(F.struct("path", "code", "expected", "actual"), "ord").alias("m")).select("file", "m.*")


def batch_manifest(done: DataFrame, patches: DataFrame) -> DataFrame:
    """A row for each patch: its state and reason, `missing` without a result."""
    return patches.join(done, "patch_id", "left").withColumn("state", F.coalesce("state", F.lit("missing")))


def done_patch_skip(patches: DataFrame, manifest: DataFrame) -> DataFrame:
    return patches.join(manifest.where("state = 'done'").select("patch_id"), "patch_id", "left_anti")


def best_file_per_patch(files: DataFrame, order: list[str]) -> DataFrame:
    """One file of each patch and layer: by format preference, larger first, path."""
    rank = F.lit(len(order))
    for i, ext in enumerate(order):
        rank = F.when(F.lower(F.regexp_extract("path", r"\.([^.]+)$", 1)) == ext, i).otherwise(rank)
    w = Window.partitionBy("patch_id", "layer").orderBy(rank, F.desc("size"), "path")
    return files.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def first_wins(frames: list[DataFrame], key: list[str], order: list[str]) -> DataFrame:
    """Union of tables; of rows with one key the first table's stays."""
    out = None
    for i, f in enumerate(frames):
        f = f.withColumn("_src", F.lit(i))
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    w = Window.partitionBy(*key).orderBy("_src", *order)
    return out.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r", "_src")


def split_events(steps: DataFrame, by: list[str], order: str, pieces: str, expected: int) -> DataFrame:
    """An event for each unit by which the number of pieces grows, in order, up to
    `expected`."""
    w = Window.partitionBy(*by).orderBy(order)
    grown = F.col(pieces) - F.coalesce(F.lag(pieces).over(w), F.lit(1))
    rows = steps.withColumn("_g", grown).where("_g > 0").withColumn("_k", F.explode(F.sequence(F.lit(1), F.col("_g").cast("int"))))
    return rows.withColumn("event", F.row_number().over(Window.partitionBy(*by).orderBy(order, "_k"))).where(F.col("event") <= expected).drop("_g", "_k")
