"""Anchor scans: crosslines along a node's axis, one row for each step.

A scan is `nodes` (node_id, x, y, ux, uy: the axis as a unit vector, stop_m) exploded over
steps; its crossline has half-width `half`. All choices are then aggregates over steps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .zones import line_zone_pieces


def scan_stop(limit: float, next_m: Column) -> tuple[Column, Column]:
    """How far to scan (the next intersection if it is nearer) and why."""
    near = next_m < limit
    return F.least(F.lit(limit), F.coalesce(next_m, F.lit(limit))), F.when(near, "next_intersection").otherwise("max_distance")


def crossline_scan(nodes: DataFrame, step: float = 1.0, half: float = 20.0) -> DataFrame:
    """(node_id, k, s, x1, y1, x2, y2): crosslines at every `step` up to stop_m."""
    k = F.explode(F.sequence(F.lit(0), F.floor(F.col("stop_m") / step).cast("int"))).alias("k")
    rows = nodes.select("node_id", "x", "y", "ux", "uy", k).withColumn("s", F.col("k") * step)
    cx, cy = F.col("x") + F.col("s") * F.col("ux"), F.col("y") + F.col("s") * F.col("uy")
    return rows.select(
        "node_id", "k", "s", (cx - half * F.col("uy")).alias("x1"), (cy + half * F.col("ux")).alias("y1"), (cx + half * F.col("uy")).alias("x2"), (cy - half * F.col("ux")).alias("y2")
    )


def between_branches(nodes: DataFrame, branches: DataFrame, step: float = 1.0, half: float = 120.0) -> DataFrame:
    """Crosslines that end on a node's two branches: (node_id, k, s, x1, y1, x2, y2, seg_m, a_hit, b_hit), from
    branch 'a' to branch 'b'. nodes as in crossline_scan(); branches: node_id, branch ('a' or 'b'), seq, x1, y1, x2, y2.

    Each branch gives the point where it meets the long crossline (`half` to either side, at
    least 120 m), of several the one nearest to the axis; a branch that doesn't meet it gives its point
    nearest to the crossline, and `a_hit` or `b_hit` says so. So the width follows the road. Nodes without both
    branches have no row."""
    long = crossline_scan(nodes, step, max(half, 120.0))
    e = branches.where("branch IN ('a', 'b')").select("node_id", "branch", "seq", *[F.col(c).alias(f"e{c}") for c in ("x1", "y1", "x2", "y2")])
    rows = long.join(e, "node_id")
    c = {n: F.col(n) for n in ("x1", "y1", "x2", "y2", "ex1", "ey1", "ex2", "ey2")}
    dx, dy, ex, ey = c["x2"] - c["x1"], c["y2"] - c["y1"], c["ex2"] - c["ex1"], c["ey2"] - c["ey1"]
    den = F.nullif(dx * ey - dy * ex, F.lit(0.0))
    t = ((c["ex1"] - c["x1"]) * ey - (c["ey1"] - c["y1"]) * ex) / den  # along the crossline
    u = ((c["ex1"] - c["x1"]) * dy - (c["ey1"] - c["y1"]) * dx) / den  # along the branch
    meets = F.coalesce(t.between(0, 1) & u.between(0, 1), F.lit(False))
    mx, my = (c["x1"] + c["x2"]) / 2, (c["y1"] + c["y2"]) / 2

    def foot(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> tuple[Column, Column]:
        n = F.nullif((bx - ax) ** 2 + (by - ay) ** 2, F.lit(0.0))
        f = F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - ax) * (bx - ax) + (py - ay) * (by - ay)) / n)), F.lit(0.0))
        return ax + f * (bx - ax), ay + f * (by - ay)

    # Where they don't meet, the nearest point is an end of the segment, or faces an end of the crossline.
    near = []
    for i in ("1", "2"):
        fx, fy = foot(c[f"ex{i}"], c[f"ey{i}"], c["x1"], c["y1"], c["x2"], c["y2"])
        near.append((c[f"ex{i}"], c[f"ey{i}"], (c[f"ex{i}"] - fx) ** 2 + (c[f"ey{i}"] - fy) ** 2))
        gx, gy = foot(c[f"x{i}"], c[f"y{i}"], c["ex1"], c["ey1"], c["ex2"], c["ey2"])
        near.append((gx, gy, (c[f"x{i}"] - gx) ** 2 + (c[f"y{i}"] - gy) ** 2))
    found = [F.struct((~meets).alias("off"), F.when(meets, F.round((c["ex1"] + u * ex - mx) ** 2 + (c["ey1"] + u * ey - my) ** 2, 9)).otherwise(F.round(d, 9)).alias("d"), F.col("seq"), F.when(meets, c["ex1"] + u * ex).otherwise(x).alias("x"), F.when(meets, c["ey1"] + u * ey).otherwise(y).alias("y")) for x, y, d in near]
    best = rows.groupBy("node_id", "k", "s", "branch").agg(F.min(F.least(*found)).alias("p"))
    side = lambda b: best.where(F.col("branch") == b).select("node_id", "k", "s", F.col("p.x").alias(f"x{b}"), F.col("p.y").alias(f"y{b}"), (~F.col("p.off")).alias(f"{b}_hit"))
    both = side("a").join(side("b"), ["node_id", "k", "s"])
    both = both.select("node_id", "k", "s", F.col("xa").alias("x1"), F.col("ya").alias("y1"), F.col("xb").alias("x2"), F.col("yb").alias("y2"), "a_hit", "b_hit")
    return both.withColumn("seg_m", F.sqrt((F.col("x2") - F.col("x1")) ** 2 + (F.col("y2") - F.col("y1")) ** 2))


def scan_pieces(scan: DataFrame, zone_edges: DataFrame, least_m: float = 1.0) -> DataFrame:
    """Inside pieces of each crossline in the union of all zones: (node_id, k, s, piece, start_s, end_s)."""
    lines = scan.withColumns({"seq": F.lit(1), "s1": F.lit(0.0), "seg_m": F.sqrt((F.col("x2") - F.col("x1")) ** 2 + (F.col("y2") - F.col("y1")) ** 2)})
    return line_zone_pieces(lines, zone_edges, ["node_id", "k", "s"], least_m, union=True)


def first_split(scan: DataFrame, pieces: DataFrame, extend: float = 5.0) -> DataFrame:
    """Per node: the first step whose crossline has two or more pieces and the step
    after which it has been so for `extend` metres."""
    n = pieces.groupBy("node_id", "k", "s").agg(F.count("*").alias("n_pieces"))
    rows = scan.select("node_id", "k", "s").join(n, ["node_id", "k", "s"], "left").fillna(0, ["n_pieces"])
    first = rows.groupBy("node_id").agg(F.min(F.when(F.col("n_pieces") >= 2, F.col("s"))).alias("split_s"), F.max("n_pieces").alias("most_pieces"))
    return first.withColumn("extended_s", F.col("split_s") + extend)


def divstrip_first_hit(scan: DataFrame, tips: DataFrame, reach: float = 1.0) -> DataFrame:
    """Per node: the first step whose crossline passes within `reach` of a divider's point
    (x, y), and the step that passes closest. Steps and points meet in 50 m cells."""
    cell = lambda c: F.floor(c / 50).cast("int")
    cells = lambda a, b: F.sequence(cell(F.least(a, b) - reach), cell(F.greatest(a, b) + reach))
    rows = scan.withColumn("cx", F.explode(cells("x1", "x2"))).withColumn("cy", F.explode(cells("y1", "y2")))
    hit = rows.join(tips.select(F.col("x").alias("px"), F.col("y").alias("py"), cell(F.col("x")).alias("cx"), cell(F.col("y")).alias("cy")), ["cx", "cy"])
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((F.col("px") - F.col("x1")) * dx + (F.col("py") - F.col("y1")) * dy) / (dx * dx + dy * dy)))
    hit = hit.withColumn("d", F.round(F.sqrt((F.col("px") - F.col("x1") - t * dx) ** 2 + (F.col("py") - F.col("y1") - t * dy) ** 2), 6))
    near = F.min(F.when(F.col("d") <= reach, F.col("s"))).alias("first_s")
    return hit.groupBy("node_id").agg(near, F.min_by("s", F.struct("d", "s")).alias("closest_s"), F.min("d").alias("closest_m"))


def reference_choice(max_offset: float = 10.0) -> Column:
    """Where the anchor goes: the divider's first hit if the zone splits within
    `max_offset` of it, else its tip, else the split. Columns: first_s, tip_s, split_s."""
    close = F.abs(F.col("first_s") - F.col("split_s")) <= max_offset
    where = lambda name, c: F.struct(F.lit(name).alias("source"), F.col(c).alias("s"))
    return (
        F.when(F.col("first_s").isNotNull() & (close | F.col("split_s").isNull()), where("divider_hit", "first_s"))
        .when(F.col("tip_s").isNotNull() & F.col("split_s").isNull(), where("divider_tip", "tip_s"))
        .when(F.col("split_s").isNotNull(), where("zone_split", "split_s"))
        .otherwise(F.struct(F.lit("none").alias("source"), F.lit(None).cast("double").alias("s")))
    )


def backtrack_probe(s: Column, step: float = 5.0, past: float = 20.0) -> Column:
    """Positions from s back to the node and `past` metres beyond it."""
    n = F.floor((s + past) / step).cast("int")
    return F.array_distinct(F.concat(F.transform(F.sequence(F.lit(0), n), lambda i: s - i * step), F.array(F.lit(0.0))))


def pieces_pick(pieces: DataFrame, by: list[str], centre: float) -> DataFrame:
    """Per crossline: the nearest piece on each side of the centre and the middle of the
    gap between them."""
    left = F.max(F.when(F.col("end_s") <= centre, F.struct("end_s", "start_s")))
    right = F.min(F.when(F.col("start_s") >= centre, F.struct("start_s", "end_s")))
    got = pieces.groupBy(*by).agg(F.count("*").alias("n_pieces"), left.alias("l"), right.alias("r"))
    return got.select(*by, "n_pieces", F.col("l.end_s").alias("left_end"), F.col("r.start_s").alias("right_start"), ((F.col("l.end_s") + F.col("r.start_s")) / 2).alias("gap_mid"))


def anchor_metrics(anchors: DataFrame) -> DataFrame:
    """Counts by source and quantiles of the positions."""
    return anchors.groupBy("source").agg(F.count("*").alias("n"), F.percentile("s", F.lit(0.5)).alias("p50"), F.percentile("s", F.lit(0.9)).alias("p90"))


def divstrip_tip(nodes: DataFrame, vertices: DataFrame, reach: float) -> DataFrame:
    """Per node the nearest divider part ahead and its first point along the axis (the
    mean of equally early ones). vertices: part, x, y; nodes: node_id, x, y, ux, uy. Nodes
    and vertices meet in cells as wide as the reach."""
    cell = lambda c: F.floor(c / reach).cast("int")
    around = F.explode(F.sequence(F.lit(-1), F.lit(1)))
    own = nodes.select("node_id", F.col("x").alias("nx"), F.col("y").alias("ny"), "ux", "uy").withColumn("i", around).withColumn("j", around)
    own = own.withColumns({"cx": cell(F.col("nx")) + F.col("i"), "cy": cell(F.col("ny")) + F.col("j")}).drop("i", "j")
    rows = own.join(vertices.withColumns({"cx": cell(F.col("x")), "cy": cell(F.col("y"))}), ["cx", "cy"])
    dx, dy = F.col("x") - F.col("nx"), F.col("y") - F.col("ny")
    rows = rows.withColumns({"ahead": F.round(dx * F.col("ux") + dy * F.col("uy"), 6), "d2": F.round(dx**2 + dy**2, 6)}).where((F.col("ahead") > 0) & (F.col("d2") <= reach * reach))
    part = rows.groupBy("node_id").agg(F.min_by("part", F.struct("d2", "part")).alias("part"))
    chosen = rows.join(part, ["node_id", "part"])
    first = chosen.withColumn("_m", F.min("ahead").over(Window.partitionBy("node_id"))).where("ahead = _m")
    return first.groupBy("node_id", "part").agg(F.avg("x").alias("tip_x"), F.avg("y").alias("tip_y"), F.first("ahead").alias("tip_s"))


def fan_gap(nodes: DataFrame, zone_edges: DataFrame, length: float = 10.0, half_angle: float = 30.0, rays: int = 7, steps: int = 10) -> DataFrame:
    """Share of a fan ahead of each node that no zone covers, by a grid of rays and steps
    (an approximation of its area). nodes: node_id, x, y, ux, uy."""
    from .zones import in_cells, point_in_zone

    sides = lambda f, end: [f(end(f"{c}1", f"{c}2")) for c in "xy"]
    key = ["patch_id", "poly_id"] if "patch_id" in zone_edges.columns else ["poly_id"]
    lows, highs = sides(F.min, F.least), sides(F.max, F.greatest)
    boxes = zone_edges.groupBy(*key).agg(lows[0].alias("lx"), lows[1].alias("ly"), highs[0].alias("hx"), highs[1].alias("hy"))
    held = in_cells(boxes, "lx", "ly", "hx", "hy", "b").select("cx", "cy").distinct()
    # No other nodes' fans can reach a zone's cells: their places need not be made.
    rim, size = length * 1.001 + 1e-6, F.sqrt(F.col("ux") ** 2 + F.col("uy") ** 2)
    reached = in_cells(nodes.withColumn("_r", rim * F.greatest(size, F.lit(1.0))).withColumns({"_a": F.col("x") - F.col("_r"), "_b": F.col("y") - F.col("_r"), "_c": F.col("x") + F.col("_r"), "_d": F.col("y") + F.col("_r")}), "_a", "_b", "_c", "_d", "n")
    near = reached.join(held, ["cx", "cy"], "left_semi").select("node_id").distinct()
    ray, k = F.explode(F.sequence(F.lit(0), F.lit(rays - 1))), F.explode(F.sequence(F.lit(1), F.lit(steps)))
    rows = nodes.join(near, "node_id", "left_semi").withColumn("ray", ray).withColumn("k", k)
    a = F.radians((F.col("ray") / (rays - 1) * 2 - 1) * half_angle)
    r = F.col("k") * (length / steps)
    dx, dy = F.col("ux") * F.cos(a) - F.col("uy") * F.sin(a), F.col("ux") * F.sin(a) + F.col("uy") * F.cos(a)
    rows = rows.select("node_id", "ray", "k", (F.col("x") + r * dx).alias("x"), (F.col("y") + r * dy).alias("y"))
    inside = point_in_zone(rows, zone_edges, ["node_id", "ray", "k"]).select("node_id", "ray", "k").distinct()
    got = inside.groupBy("node_id").agg(F.count("*").alias("_in"))
    return nodes.select("node_id").distinct().join(got, "node_id", "left").select("node_id", ((rays * steps - F.coalesce("_in", F.lit(0))) / (rays * steps)).alias("gap"))


def multi_branch_events(steps: DataFrame, expected: int) -> DataFrame:
    """Split events of scans (node_id, dir 'f' or 'r', s, n_pieces), forward and reverse:
    the main one is the farthest reverse event if there is any, else the first forward one;
    nodes with both are two-sided."""
    from .profiles import split_events

    got = split_events(steps, ["node_id", "dir"], "s", "n_pieces", expected)
    back, fore = F.col("dir") == "r", F.col("dir") == "f"
    main = F.coalesce(F.max(F.when(back, F.col("s"))), F.min(F.when(fore, F.col("s"))))
    return got.groupBy("node_id").agg(F.count_if(fore).alias("n_forward"), F.count_if(back).alias("n_reverse"), main.alias("main_s"), (F.bool_or(back) & F.bool_or(fore)).alias("two_sided"))


def crossline_clip(pieces: DataFrame, by: list[str], centre: float) -> DataFrame:
    """The piece of each crossline that holds its centre, else the nearest one."""
    far = F.greatest(F.lit(0.0), F.col("start_s") - centre, centre - F.col("end_s"))
    got = pieces.groupBy(*by).agg(F.min_by(F.struct("start_s", "end_s"), F.struct(F.round(far, 6), "start_s")).alias("p"))
    return got.select(*by, "p.start_s", "p.end_s")


def reverse_tip(nodes: DataFrame, forward: DataFrame, tips: DataFrame, zone_edges: DataFrame, step: float = 1.0, half: float = 20.0, reach: float = 10.0, near: float = 1.0, max_offset: float = 10.0) -> DataFrame:
    """Looks for an anchor behind nodes (node_id, x, y, ux, uy), where the way ahead gives
    none that can be trusted: (node_id, trigger, source, s, used). forward: node_id, first_s,
    tip_s, split_s, at_node (a divider lies at the node itself), multi (more than one branch,
    not searched) and back_tip_s (the divider's tip projected, negative behind the node).
    Steps go back to `reach`, from one step on where a divider lies at the node. What is
    found behind replaces the choice ahead, which stays otherwise."""
    ahead = forward.withColumn("c", reference_choice(max_offset))
    none = F.col("first_s").isNull() & F.col("tip_s").isNull() & F.col("split_s").isNull()
    why = F.when(none, "missing_ref").when(F.col("at_node"), "untrusted_divstrip_at_node").when(F.col("first_s").isNotNull() & F.col("split_s").isNull(), "first_hit_no_split")
    ahead = ahead.withColumn("trigger", F.when(~F.col("multi"), why))
    behind = nodes.join(ahead.where("trigger IS NOT NULL").select("node_id", "at_node"), "node_id")
    behind = behind.withColumns({"ux": -F.col("ux"), "uy": -F.col("uy"), "stop_m": F.lit(float(reach))})
    at = behind.select("node_id", F.when(F.col("at_node"), step).otherwise(0.0).alias("from_s"))
    scan = crossline_scan(behind, step, half).join(at, "node_id").where("s >= from_s").drop("from_s")
    split = first_split(scan, scan_pieces(scan, zone_edges)).select("node_id", (-F.col("split_s")).alias("split_s"))
    hit = divstrip_first_hit(scan, tips, near).select("node_id", (-F.col("first_s")).alias("first_s"))
    tip = F.when((F.col("back_tip_s") >= -reach) & (F.col("back_tip_s") <= 0) & (~F.col("at_node") | (F.col("back_tip_s") < 0)), F.col("back_tip_s"))
    back = ahead.where("trigger IS NOT NULL").select("node_id", tip.alias("tip_s")).join(split, "node_id", "left").join(hit, "node_id", "left")
    back = back.select("node_id", reference_choice(max_offset).alias("b"))
    rows = ahead.join(back, "node_id", "left").withColumn("used", F.coalesce(F.col("b.source") != "none", F.lit(False)))
    return rows.select("node_id", "trigger", F.when(F.col("used"), F.concat(F.lit("reverse_"), "b.source")).otherwise(F.col("c.source")).alias("source"), F.when(F.col("used"), F.col("b.s")).otherwise(F.col("c.s")).alias("s"), "used")


def k16_search(nodes: DataFrame, roads: DataFrame, away: DataFrame, zone_edges: DataFrame, step: float = 0.5, half: float = 10.0, reach: float = 10.0, ahead: float = 5.0, least_m: float = 0.01) -> DataFrame:
    """Anchors of nodes (node_id, x, y) with one road: (node_id, s, first_s, start_s, end_s,
    n_pieces, reason). Crosslines go along the road, away from the node; s is negative where the
    road's direction leads to the node. The first one within `reach` that meets a zone counts, or
    one up to `ahead` farther on, if its piece (the one that holds the centre, else the
    nearest) is longer, or as long in fewer pieces. Other nodes get the reason why not.
    away: road_id, node_id, at_end, ax, ay, as of evidence.away_and_trend_vector."""
    starts = ((F.col("direction") == 2) & ~F.col("at_end")) | ((F.col("direction") == 3) & F.col("at_end"))
    at = away.join(roads.select("road_id", "direction"), "road_id").withColumn("back", ~F.coalesce(starts, F.lit(False)))
    own = at.groupBy("node_id").agg(F.count_distinct("road_id").alias("n_roads"), F.min(F.struct("back", "road_id", "direction", "ax", "ay")).alias("r"))
    rows = nodes.select("node_id", "x", "y").join(own, "node_id", "left")
    single = rows.where("n_roads = 1 AND r.direction IN (2, 3)")
    scan = crossline_scan(single.select("node_id", "x", "y", F.col("r.ax").alias("ux"), F.col("r.ay").alias("uy"), F.lit(float(reach + ahead)).alias("stop_m")), step, half)
    pieces = scan_pieces(scan, zone_edges, least_m)
    key = ["node_id", "k", "s"]
    clip = crossline_clip(pieces, key, half).join(pieces.groupBy(*key).agg(F.count("*").alias("n_pieces")), key)
    first = pieces.where(F.col("s") <= reach).groupBy("node_id").agg(F.min("s").alias("first_s"))
    tried = clip.join(first, "node_id").where((F.col("s") >= F.col("first_s")) & (F.col("s") <= F.col("first_s") + ahead))
    rank = F.struct((-F.round(F.col("end_s") - F.col("start_s"), 4)).alias("l"), F.col("n_pieces"), F.col("s"))
    best = tried.groupBy("node_id").agg(F.min_by(F.struct("s", "first_s", "start_s", "end_s", "n_pieces"), rank).alias("b"))
    why = (
        F.when(F.coalesce("n_roads", F.lit(0)) != 1, "K16_ROAD_NOT_UNIQUE").when(~F.coalesce(F.col("r.direction").isin(2, 3), F.lit(False)), "K16_ROAD_DIR_UNSUPPORTED")
        .when(F.col("b").isNull(), "K16_DRIVEZONE_NOT_REACHED").when(F.col("b.s") > F.col("b.first_s"), "ok_refined").otherwise("ok")
    )
    sign = F.when(F.col("r.back"), -1.0).otherwise(1.0)
    return rows.join(best, "node_id", "left").select("node_id", (sign * F.col("b.s")).alias("s"), (sign * F.col("b.first_s")).alias("first_s"), "b.start_s", "b.end_s", "b.n_pieces", why.alias("reason"))
