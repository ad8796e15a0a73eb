"""What speaks for a road between two cross-sections: hits, anchors, witnesses, barriers,
passable spans, the surface's middle, and lines put together from supports.

Cross-sections are (node_id, x1, y1, x2, y2), lines are tables of segments (zones.segments).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .network import cut
from .series import points_near
from .zones import CELL, _shared, in_cells, line_zone_pieces, point_in_zone


def segment_distance(px: Column, py: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Distance of a point from a segment."""
    dx, dy = x2 - x1, y2 - y1
    n = dx * dx + dy * dy
    t = F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - x1) * dx + (py - y1) * dy) / F.nullif(n, F.lit(0.0)))), F.lit(0.0))
    return F.sqrt((px - x1 - t * dx) ** 2 + (py - y1 - t * dy) ** 2)


def terminal_hit(hits: DataFrame, pairs: DataFrame) -> DataFrame:
    """(src, dst, traj_id, terminal) for the trajectories that hit (traj_id, node_id, pos)
    both ends of a pair: whether some hit of the source is strictly before one of the
    destination."""
    ends = hits.groupBy("traj_id", "node_id").agg(F.min("pos").alias("first"), F.max("pos").alias("last"))
    a = ends.select("traj_id", F.col("node_id").alias("src"), F.col("first").alias("src_first"))
    b = ends.select("traj_id", F.col("node_id").alias("dst"), F.col("last").alias("dst_last"))
    rows = pairs.select("src", "dst").distinct().join(a, "src").join(b, ["dst", "traj_id"])
    return rows.select("src", "dst", "traj_id", (F.col("src_first") < F.col("dst_last")).alias("terminal"))


def away_and_trend_vector(roads: DataFrame) -> DataFrame:
    """Per end of a road (road_id, snode, enode, line: array of (x, y)): unit vectors from
    the end to its next vertex (ax, ay) and to the line's middle one (tx, ty). A line of
    fewer than two points, or of equal ones, points along x."""
    n = F.size("line")
    at = lambda i: F.element_at("line", i + 1)
    last = n - 1
    mid_s = F.least(last, F.greatest(F.lit(1), F.floor(n / 2).cast("int")))
    mid_e = F.greatest(F.lit(0), F.least(n - 2, F.floor(n / 2).cast("int") - 1))

    def unit(frm: Column, to: Column) -> Column:
        dx, dy = to.x - frm.x, to.y - frm.y
        m = F.sqrt(dx * dx + dy * dy)
        ok = (n >= 2) & (m > 0)
        return F.struct(F.when(ok, dx / m).otherwise(1.0).alias("x"), F.when(ok, dy / m).otherwise(0.0).alias("y"))

    safe = F.when(n >= 2, F.col("line")).otherwise(F.array(F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y")), F.struct(F.lit(1.0).alias("x"), F.lit(0.0).alias("y"))))
    roads = roads.withColumn("line", safe)
    ends = F.array(
        F.struct(F.col("snode").alias("node_id"), F.lit(False).alias("at_end"), unit(at(F.lit(0)), at(F.lit(1))).alias("a"), unit(at(F.lit(0)), at(mid_s)).alias("t")),
        F.struct(F.col("enode").alias("node_id"), F.lit(True).alias("at_end"), unit(at(last), at(last - 1)).alias("a"), unit(at(last), at(mid_e)).alias("t")),
    )
    rows = roads.select("road_id", F.explode(ends).alias("e"))
    return rows.select("road_id", "e.node_id", "e.at_end", F.col("e.a.x").alias("ax"), F.col("e.a.y").alias("ay"), F.col("e.t.x").alias("tx"), F.col("e.t.y").alias("ty"))


def prior_anchor_pair(roads: DataFrame, xsecs: DataFrame, reach: float = 20.0) -> DataFrame:
    """(road_id, src, dst, cost_m): the ordered pair of different cross-sections nearest to a
    road's two ends (x1, y1, x2, y2), if the sum of the distances is at most 2 * reach. Ends
    and cross-sections meet in cells, as no end may be farther away than that sum."""
    far = 2 * reach
    own = xsecs.select("node_id", *[F.col(c).alias(f"c{c}") for c in ("x1", "y1", "x2", "y2")])
    own = own.withColumns({"_a": F.least("cx1", "cx2") - far, "_b": F.least("cy1", "cy2") - far, "_c": F.greatest("cx1", "cx2") + far, "_d": F.greatest("cy1", "cy2") + far})
    cells = in_cells(own, "_a", "_b", "_c", "_d", "c")

    def near(x: str, y: str, node: str, d: str) -> DataFrame:
        spots = roads.select("road_id", F.col(x).alias("px"), F.col(y).alias("py")).withColumns({"cx": F.floor(F.col("px") / CELL).cast("long"), "cy": F.floor(F.col("py") / CELL).cast("long")})
        gap = segment_distance(*[F.col(c) for c in ("px", "py", "cx1", "cy1", "cx2", "cy2")])
        return spots.join(cells, ["cx", "cy"]).select("road_id", F.col("node_id").alias(node), gap.alias(d)).where(F.col(d) <= far)

    rows = near("x1", "y1", "src", "d1").join(near("x2", "y2", "dst", "d2"), "road_id").where("src <> dst").withColumn("cost_m", F.round(F.col("d1") + F.col("d2"), 9))
    best = rows.where(F.col("cost_m") <= far).groupBy("road_id").agg(F.min(F.struct("cost_m", "src", "dst")).alias("b"))
    return best.select("road_id", "b.src", "b.dst", "b.cost_m")


def probes(lines: DataFrame, by: list[str], places: tuple[float, ...], half: float, shortest: float = 12.0) -> DataFrame:
    """Crosslines of half-width `half` at shares of each line's length: (by..., k, place, x1, y1, x2, y2).
    Places within 1 m of an end are left out, as are lines below `shortest`."""
    total = lines.groupBy(*by).agg(F.sum("seg_m").alias("length_m"))
    wanted = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(p).alias("place")) for k, p in enumerate(places)])).alias("w")
    at = total.select(*by, "length_m", wanted).select(*by, "length_m", "w.k", "w.place").withColumn("s", F.col("length_m") * F.col("place"))
    at = at.where((F.col("length_m") >= shortest) & (F.col("s") > 1) & (F.col("s") < F.col("length_m") - 1))
    rows = lines.where("seg_m > 0").join(at, by).where("s >= s1 AND s < s1 + seg_m")
    f = (F.col("s") - F.col("s1")) / F.col("seg_m")
    tx, ty = (F.col("x2") - F.col("x1")) / F.col("seg_m"), (F.col("y2") - F.col("y1")) / F.col("seg_m")
    px, py = F.col("x1") + f * (F.col("x2") - F.col("x1")), F.col("y1") + f * (F.col("y2") - F.col("y1"))
    return rows.select(*by, "k", "place", (px + half * ty).alias("x1"), (py - half * tx).alias("y1"), (px - half * ty).alias("x2"), (py + half * tx).alias("y2"))


def corridor_witness(
    lines: DataFrame, zones: DataFrame, by: list[str], places: tuple[float, ...] = (0.35, 0.5, 0.65), half: float = 30.0, least_m: float = 1.0, near_m: float = 3.0, gap_m: float = 1.0, least_score: float = 0.55
) -> DataFrame:
    """Whether probes across a line agree on where its corridor lies. Each probe takes the
    interval of the zone that holds the line, else the nearest one. Its score is 0.7 times the share of
    the other probes that took one of equal rank with a centre within `near_m`, and 0.3 if
    it has no second interval within `gap_m`. The best probe (of equal ones the first)
    stands for the line: (by..., k, rank, start_s, end_s, score, witness)."""
    cross = cut(probes(lines, by, places, half))
    key = [*by, "k"]
    flat = cross.withColumns({"seq": F.lit(1), "s1": F.lit(0.0), "seg_m": F.lit(2.0 * half)})
    found = line_zone_pieces(flat, zones, key, least_m, union=True)
    order = Window.partitionBy(*key).orderBy("start_s", "end_s")
    ranked = found.withColumns({"rank": F.row_number().over(order), "gap": F.col("start_s") - F.lag("end_s").over(order), "gap2": F.lead("start_s").over(order) - F.col("end_s")})
    holds = (F.col("start_s") <= half) & (F.col("end_s") >= half)
    off = F.when(holds, 0.0).otherwise(F.round(F.abs((F.col("start_s") + F.col("end_s")) / 2 - half), 9))
    pick = F.min_by(F.struct("rank", "start_s", "end_s", "gap", "gap2"), F.struct((~holds).alias("o"), off.alias("d"), F.col("rank"))).alias("p")
    own = cut(ranked.groupBy(*key).agg(pick, F.count("*").alias("n")).select(*key, "p.*", "n").withColumn("centre", (F.col("start_s") + F.col("end_s")) / 2))
    other = own.select(*by, F.col("k").alias("k2"), F.col("rank").alias("rank2"), F.col("centre").alias("centre2"))
    agrees = F.count_if((F.col("k2") != F.col("k")) & (F.col("rank2") == F.col("rank")) & (F.abs(F.col("centre2") - F.col("centre")) <= near_m)).alias("n_agree")
    met = own.join(other, by).groupBy(*key).agg(agrees)
    n_probes = cross.groupBy(*by).agg(F.count("*").alias("n_probes"))
    rows = own.join(met, key).join(n_probes, by)
    alone = (F.col("n") == 1) | (F.least(F.coalesce("gap", F.lit(math.inf)), F.coalesce("gap2", F.lit(math.inf))) >= gap_m)
    score = F.round(0.7 * F.col("n_agree") / F.greatest(F.lit(1), F.col("n_probes") - 1) + F.when(alone, 0.3).otherwise(0.0), 9)
    best = rows.withColumn("score", score).groupBy(*by).agg(F.min_by(F.struct("k", "rank", "start_s", "end_s", "score"), F.struct(-F.col("score"), F.col("k"))).alias("b"))
    return n_probes.select(*by).join(best.select(*by, "b.*"), by, "left").withColumn("witness", F.coalesce(F.col("score") >= least_score, F.lit(False)))


def surface_centerline(pairs: DataFrame, points: DataFrame, step: float = 10.0, half: float = 20.0, least: int = 8, least_points: int = 24) -> DataFrame:
    """(patch_id, src, dst, k, x, y): the middle of the ground points between two cross-sections,
    given as pairs (patch_id, src, dst, x1, y1, x2, y2: their middles). At every `step` along the
    axis (and at its end), the median of the cross offsets of the points within 0.75 steps, where
    there are `least`; of pairs with `least_points` points and three stations or more."""
    step, wide = max(3.0, step), max(10.0, 1.5 * half)
    axis = F.sqrt((F.col("x2") - F.col("x1")) ** 2 + (F.col("y2") - F.col("y1")) ** 2)
    own = pairs.withColumn("axis_m", axis).where("axis_m > 1")
    reach = wide + 10
    own = own.withColumns({"ux": (F.col("x2") - F.col("x1")) / F.col("axis_m"), "uy": (F.col("y2") - F.col("y1")) / F.col("axis_m"), "_a": F.least("x1", "x2") - reach, "_b": F.least("y1", "y2") - reach, "_c": F.greatest("x1", "x2") + reach, "_d": F.greatest("y1", "y2") + reach})
    cells = in_cells(own, "_a", "_b", "_c", "_d", "c").drop("_a", "_b", "_c", "_d")
    pts = points.select("patch_id", F.col("x").alias("px"), F.col("y").alias("py")).withColumns({"cx": F.floor(F.col("px") / CELL).cast("long"), "cy": F.floor(F.col("py") / CELL).cast("long")})
    rx, ry = F.col("px") - F.col("x1"), F.col("py") - F.col("y1")
    rows = cells.join(pts, ["patch_id", "cx", "cy"]).withColumns({"along": rx * F.col("ux") + ry * F.col("uy"), "across": ry * F.col("ux") - rx * F.col("uy")})
    rows = rows.where((F.col("along") >= -10) & (F.col("along") <= F.col("axis_m") + 10) & (F.abs("across") <= wide))
    win = max(2.0, 0.75 * step)
    last = F.floor(F.col("axis_m") / step + 0.5).cast("int")  # the last regular station may be beyond the end and stands there
    ks = F.sequence(F.greatest(F.lit(0), F.floor((F.col("along") - win) / step).cast("int") - 1), F.greatest(F.lit(0), F.floor((F.col("along") + win) / step).cast("int") + 1))
    spread = rows.withColumn("last", last).withColumn("k", F.explode(F.array_distinct(F.concat(ks, F.array("last", F.col("last") + 1)))))
    at = F.when(F.col("k") <= F.col("last"), F.least(F.col("k") * step, F.col("axis_m"))).otherwise(F.col("axis_m"))
    spread = spread.where(F.col("k") <= F.col("last") + F.when(F.col("last") * step < F.col("axis_m") - 1e-6, 1).otherwise(0)).withColumn("s", at)
    key = ["patch_id", "src", "dst"]
    stations = spread.where(F.abs(F.col("along") - F.col("s")) <= win).groupBy(*key, "k", "s", "x1", "y1", "ux", "uy").agg(F.count("*").alias("n"), F.percentile("across", F.lit(0.5)).alias("mid")).where(F.col("n") >= least)
    enough = rows.groupBy(*key).agg(F.count("*").alias("n_points")).where(F.col("n_points") >= least_points).select(*key)
    stations = stations.join(enough, key, "left_semi").withColumn("_n", F.count("*").over(Window.partitionBy(*key))).where("_n >= 3")
    return stations.select(*key, "k", (F.col("x1") + F.col("ux") * F.col("s") - F.col("uy") * F.col("mid")).alias("x"), (F.col("y1") + F.col("uy") * F.col("s") + F.col("ux") * F.col("mid")).alias("y"))


def samples(xsecs: DataFrame, step: float = 1.0) -> DataFrame:
    """Points along cross-sections, both ends included: (node_id, i, s, x, y) and patch_id, if there is one.
    A cross-section is cut into the fewest equal parts of at most `step`."""
    more = ["patch_id"] if "patch_id" in xsecs.columns else []
    length = F.sqrt((F.col("x2") - F.col("x1")) ** 2 + (F.col("y2") - F.col("y1")) ** 2)
    parts = F.greatest(F.lit(1), F.ceil(F.round(F.col("len") / step, 9))).cast("int")
    rows = xsecs.withColumn("len", length).where("len > 1e-6").withColumn("parts", parts).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("parts"))))
    f = F.col("i") / F.col("parts")
    return rows.select(*more, "node_id", "i", (f * F.col("len")).alias("s"), (F.col("x1") + f * (F.col("x2") - F.col("x1"))).alias("x"), (F.col("y1") + f * (F.col("y2") - F.col("y1"))).alias("y"))


def barrier_runs(
    xsecs: DataFrame, points: DataFrame, traj: DataFrame | None = None, step: float = 1.0, radius: float = 1.0, least: int = 2, least_m: float = 4.0,
    ahead_m: float = 60.0, width_m: float = 2.5, bin_m: float = 2.0, least_share: float = 0.65,
) -> DataFrame:
    """(patch_id, node_id, run, start_s, end_s, n_samples, occupancy, final): runs of samples of a cross-section
    that each have `least` of the given (non-ground) points of its patch within `radius`, as many
    as make up `least_m` at `step` each. A run is final if vehicles went past it: of the bins along
    the road (at right angles to the cross-section) within `ahead_m` of the run's middle sample, and `width_m` wide in all,
    at least a share `least_share` holds a vertex of the patch's trajectories. Without
    trajectories none is."""
    spots = cut(samples(xsecs, max(0.5, step)))
    step = max(0.5, step)
    near = points_near(spots, points.select("patch_id", "x", "y"), radius, ["node_id", "i", "s"]).groupBy("patch_id", "node_id", "i", "s").agg(F.count("*").alias("n")).where(F.col("n") >= max(1, least))
    key = ["patch_id", "node_id"]
    runs = near.withColumn("_r", F.col("i") - F.row_number().over(Window.partitionBy(*key).orderBy("i"))).groupBy(*key, "_r").agg(F.min("s").alias("start_s"), F.max("s").alias("end_s"), F.min("i").alias("_lo"), F.max("i").alias("_hi"))
    runs = runs.withColumn("n_samples", F.col("_hi") - F.col("_lo") + 1).where(F.col("n_samples") * step >= max(step, least_m))
    runs = runs.withColumn("run", F.row_number().over(Window.partitionBy(*key).orderBy("start_s"))).withColumn("i", F.floor((F.col("_lo") + F.col("_hi")) / 2).cast("int"))
    runs = cut(runs.join(spots.select(*key, "i", "x", "y"), [*key, "i"]).select(*key, "run", "start_s", "end_s", "n_samples", "x", "y"))
    if traj is None:
        return runs.drop("x", "y").withColumns({"occupancy": F.lit(0.0), "final": F.lit(False)})
    half, side = max(1.0, ahead_m), max(0.2, width_m / 2)
    bins = max(1, math.ceil(2 * half / max(0.5, bin_m)))
    length = F.sqrt((F.col("x2") - F.col("x1")) ** 2 + (F.col("y2") - F.col("y1")) ** 2)
    across = xsecs.select(*key, ((F.col("x2") - F.col("x1")) / length).alias("vx"), ((F.col("y2") - F.col("y1")) / length).alias("vy"))
    lit = runs.join(across, key)
    lit = lit.withColumns({"ux": F.col("vy"), "uy": -F.col("vx")})
    # Cells that the strip's axis passes, widened by its half width.
    strip = lit.withColumn("at", F.explode(F.sequence(F.lit(-math.ceil(half / 10)), F.lit(math.ceil(half / 10))))).withColumn("at", F.col("at") * 10.0)
    low, high = (lambda c, u: F.floor((F.col(c) + F.col("at") * F.col(u) - 5 - side) / 10).cast("long")), (lambda c, u: F.floor((F.col(c) + F.col("at") * F.col(u) + 5 + side) / 10).cast("long"))
    strip = strip.withColumn("cx", F.explode(F.sequence(low("x", "ux"), high("x", "ux")))).withColumn("cy", F.explode(F.sequence(low("y", "uy"), high("y", "uy"))))
    strip = strip.select(*key, "run", "x", "y", "ux", "uy", "vx", "vy", "cx", "cy").distinct()
    seen = traj.select("patch_id", F.col("x").alias("px"), F.col("y").alias("py"), F.floor(F.col("x") / 10).cast("long").alias("cx"), F.floor(F.col("y") / 10).cast("long").alias("cy"))
    dx, dy = F.col("px") - F.col("x"), F.col("py") - F.col("y")
    hit = strip.join(seen, ["patch_id", "cx", "cy"]).withColumns({"along": F.round(dx * F.col("ux") + dy * F.col("uy"), 9), "off": F.round(F.abs(dx * F.col("vx") + dy * F.col("vy")), 9)})
    hit = hit.where((F.abs("along") <= half) & (F.col("off") <= side)).withColumn("bin", F.least(F.floor((F.col("along") + half) / max(0.5, bin_m)), F.lit(bins - 1)))
    share = hit.groupBy(*key, "run").agg((F.count_distinct("bin") / bins).alias("occupancy"))
    out = runs.drop("x", "y").join(share, [*key, "run"], "left").withColumn("occupancy", F.coalesce("occupancy", F.lit(0.0)))
    return out.withColumn("final", F.col("occupancy") >= least_share)


def barrier_parts(xsecs: DataFrame, runs: DataFrame, step: float = 1.0, radius: float = 1.0) -> DataFrame:
    """(patch_id, node_id, part, start_s, end_s): what remains of each cross-section without the discs of
    `radius` (0.5 at least) around the samples of its final runs."""
    key, r, step = ["patch_id", "node_id"], max(0.5, radius), max(0.5, step)
    own = xsecs.select(*key, F.sqrt((F.col("x2") - F.col("x1")) ** 2 + (F.col("y2") - F.col("y1")) ** 2).alias("len")).where("len > 1e-6")
    final = runs.where("final")
    if 2 * r < step:  # the discs of neighbouring samples don't meet
        inner = samples(xsecs, step).join(final.select(*key, "start_s", "end_s"), key).where("s >= start_s - 1e-9 AND s <= end_s + 1e-9").select(*key, (F.col("s") - r).alias("a"), (F.col("s") + r).alias("b"))
    else:
        inner = final.select(*key, (F.col("start_s") - r).alias("a"), (F.col("end_s") + r).alias("b"))
    bars = own.select(*key, F.lit(0.0).alias("a"), F.lit(0.0).alias("b")).union(inner).union(own.select(*key, "len", "len"))
    w = Window.partitionBy(*key).orderBy("a", "b")
    gaps = bars.withColumn("from_s", F.max("b").over(w.rowsBetween(Window.unboundedPreceding, -1))).where("from_s IS NOT NULL").join(own, key)
    parts = gaps.select(*key, F.greatest("from_s", F.lit(0.0)).alias("start_s"), F.least("a", "len").alias("end_s")).where("end_s > start_s + 1e-9")
    return parts.withColumn("part", F.row_number().over(Window.partitionBy(*key).orderBy("start_s")))


def xsec_passable_span(xsecs: DataFrame, zones: DataFrame, dividers: DataFrame, step: float = 1.0, anchor: float = 0.5) -> DataFrame:
    """(node_id, start_s, end_s, left_m, right_m): the stretch of samples in a zone and in no
    divider that holds the anchor (a share of the cross-section's length), else the nearest
    one, and how far it reaches to either side of the anchor (negative if it lies beyond)."""
    more = _shared(xsecs, xsecs)
    spots, key = samples(xsecs, step), [*more, "node_id"]
    inside = point_in_zone(spots, zones, [*key, "i", "s"]).select(*key, "i", "s").distinct()
    barred = point_in_zone(spots, dividers, [*key, "i", "s"]).select(*key, "i", "s").distinct()
    free = inside.join(barred, [*key, "i", "s"], "left_anti")
    runs = free.withColumn("_r", F.col("i") - F.row_number().over(Window.partitionBy(*key).orderBy("i"))).groupBy(*key, "_r").agg(F.min("s").alias("start_s"), F.max("s").alias("end_s"))
    mid = xsecs.select(*key, (anchor * F.sqrt((F.col("x2") - F.col("x1")) ** 2 + (F.col("y2") - F.col("y1")) ** 2)).alias("a"))
    rows = runs.join(mid, key)
    off = F.round(F.greatest(F.lit(0.0), F.col("start_s") - F.col("a"), F.col("a") - F.col("end_s")), 9)
    best = rows.groupBy(*key).agg(F.min_by(F.struct("start_s", "end_s", "a"), F.struct(off.alias("o"), F.col("start_s"))).alias("b"))
    return best.select(*key, "b.start_s", "b.end_s", (F.col("b.a") - F.col("b.start_s")).alias("left_m"), (F.col("b.end_s") - F.col("b.a")).alias("right_m"))


def support_fuse_line(pieces: DataFrame, arcs: DataFrame, by: str = "arc_id") -> DataFrame:
    """The stretches of an arc (arc_id, length_m) in order: (arc_id, ord, source, piece_id, from_s, to_s), each
    from a support piece (arc_id, piece_id, start_s, end_s) where one lies and from the arc
    itself in between. Pieces come by start, then id, then end; what an earlier one has covered is not
    taken again. Pieces given backwards are turned."""
    rows = pieces.join(arcs.select(by, "length_m"), by)
    rows = rows.withColumns({"a": F.greatest(F.lit(0.0), F.least("start_s", "end_s")), "b": F.least("length_m", F.greatest("start_s", "end_s"))}).where("b > a + 1e-6")
    order = Window.partitionBy(by).orderBy("a", "piece_id", "b")
    cursor = F.coalesce(F.max("b").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rows = rows.withColumn("cursor", cursor)
    taken = rows.where("b > cursor + 1e-6").select(by, F.lit("support").alias("source"), "piece_id", F.greatest("a", "cursor").alias("from_s"), F.col("b").alias("to_s"))
    none = F.lit(None).cast("long").alias("piece_id")
    gaps = rows.where("a > cursor + 1e-6").select(by, F.lit("arc").alias("source"), none, F.col("cursor").alias("from_s"), F.col("a").alias("to_s"))
    end = rows.groupBy(by).agg(F.max("b").alias("b"))
    tail = arcs.join(end, by, "left").where("length_m > coalesce(b, 0) + 1e-6").select(by, F.lit("arc").alias("source"), none, F.coalesce("b", F.lit(0.0)).alias("from_s"), F.col("length_m").alias("to_s"))
    out = taken.union(gaps).union(tail)
    return out.withColumn("ord", F.row_number().over(Window.partitionBy(by).orderBy("from_s", "to_s")))


def cut_lines(lines: DataFrame, spans: DataFrame, by: list[str], ord: str = "ord") -> DataFrame:
    """(by..., ord, i, x, y): the vertices of lines (zones.segments) between two stations, with cut ends. spans: by..., ord, from_s,
    to_s, within the line. Each segment that a span meets gives its two (cut) ends, so inner vertices come twice."""
    rows = lines.where("seg_m > 0").join(spans.select(*by, ord, "from_s", "to_s"), by).where("s1 < to_s AND s1 + seg_m > from_s")
    at = lambda s: (s - F.col("s1")) / F.col("seg_m")
    low, high = at(F.greatest("from_s", "s1")), at(F.least(F.col("to_s"), F.col("s1") + F.col("seg_m")))
    spot = lambda f, k: F.struct((2 * F.col("seq") + k).alias("i"), (F.col("x1") + f * (F.col("x2") - F.col("x1"))).alias("x"), (F.col("y1") + f * (F.col("y2") - F.col("y1"))).alias("y"))
    return rows.select(*by, ord, F.inline(F.array(spot(low, 0), spot(high, 1))))


def fused_line(pieces: DataFrame, piece_lines: DataFrame, arcs: DataFrame, arc_lines: DataFrame) -> DataFrame:
    """One line for each arc, as vertices: (arc_id, k, x, y, how). The stretches of support_fuse_line() in order; a support piece gives
    all vertices of its own line (segments by arc_id, piece_id), turned if it was given backwards, and a gap
    the arc's vertices between its stations. Equal neighbours are one. how: 'arc' without support, 'support' if support covers
    the arc, 'support_and_arc' for both."""
    from .zones import polyline_vertices

    spans = cut(support_fuse_line(pieces, arcs))
    gaps = cut_lines(arc_lines, spans.where("source = 'arc'"), ["arc_id"])
    turned = pieces.groupBy("arc_id", "piece_id").agg(F.bool_or(F.col("start_s") > F.col("end_s")).alias("back"))
    own = polyline_vertices(piece_lines, ["arc_id", "piece_id"]).join(turned, ["arc_id", "piece_id"])
    support = spans.where("source = 'support'").select("arc_id", "piece_id", "ord").join(own, ["arc_id", "piece_id"])
    support = support.select("arc_id", "ord", F.when(F.col("back"), -F.col("i")).otherwise(F.col("i")).alias("i"), "x", "y")
    w = Window.partitionBy("arc_id").orderBy("ord", "i")
    rows = gaps.select("arc_id", "ord", "i", "x", "y").union(support)
    same = (F.abs(F.col("x") - F.lag("x").over(w)) <= 1e-9) & (F.abs(F.col("y") - F.lag("y").over(w)) <= 1e-9)
    rows = rows.withColumn("_same", F.coalesce(same, F.lit(False))).where("NOT _same").withColumn("k", F.row_number().over(w))
    kinds = spans.groupBy("arc_id").agg(F.bool_or(F.col("source") == "arc").alias("a"), F.bool_or(F.col("source") == "support").alias("s"))
    how = F.when(F.col("a") & F.col("s"), "support_and_arc").when(F.col("s"), "support").otherwise("arc")
    return rows.join(kinds, "arc_id").select("arc_id", "k", "x", "y", how.alias("how"))


def chain_line_merge(edges: DataFrame, nodes: DataFrame, reach: float = 1.0) -> DataFrame:
    """(component, src, dst, keeper, how, gap_m, merged_s, apart_m): chain edges (component, src, dst, dist_m) whose two anchors
    become one. nodes: node_id, diverge, merge, failed, offset_m, at_s (the anchor's position, or null), x1, y1, x2, y2 (its line).
    An edge qualifies from a diverge to a merge node that lies farther along, if neither anchor has failed, the
    source is the destination's nearest predecessor and the lines meet or come within `reach`. By
    ascending distance, then ids, each node is used once; the longer line stays (of equally
    long ones the source's). merged_s is the middle of both positions, apart_m their difference, null where one is missing.

    The choice is made in rounds: an edge that comes first at both of its ends is taken, and the edges that
    share an end with it go, which is what one pass over all edges in order would choose. As a node has at most one
    qualifying edge in, only chains of nodes that diverge and merge at once take further rounds."""
    first = edges.groupBy("dst").agg(F.min(F.struct("dist_m", "src")).alias("p")).select("dst", F.col("p.src").alias("nearest"))
    cols = ["diverge", "merge", "failed", "offset_m", "at_s", "x1", "y1", "x2", "y2"]
    side = lambda p: nodes.select(F.col("node_id").alias({"s": "src", "d": "dst"}[p]), *[F.col(c).alias(f"{p}_{c}") for c in cols])
    rows = edges.join(first, "dst").where("src = nearest").join(side("s"), "src").join(side("d"), "dst")
    rows = rows.where("s_diverge AND d_merge AND NOT coalesce(s_failed, false) AND NOT coalesce(d_failed, false) AND s_offset_m < d_offset_m - 1e-6")
    c = {f"{p}{k}": F.col(f"{p}_{k}") for p in "sd" for k in ("x1", "y1", "x2", "y2")}
    sx, sy, dx, dy = c["sx2"] - c["sx1"], c["sy2"] - c["sy1"], c["dx2"] - c["dx1"], c["dy2"] - c["dy1"]
    den = sx * dy - sy * dx
    t = ((c["dx1"] - c["sx1"]) * dy - (c["dy1"] - c["sy1"]) * dx) / F.nullif(den, F.lit(0.0))
    u = ((c["dx1"] - c["sx1"]) * sy - (c["dy1"] - c["sy1"]) * sx) / F.nullif(den, F.lit(0.0))
    meet = F.coalesce(t.between(0, 1) & u.between(0, 1), F.lit(False))
    one = lambda p, q: [segment_distance(c[f"{p}x{i}"], c[f"{p}y{i}"], c[f"{q}x1"], c[f"{q}y1"], c[f"{q}x2"], c[f"{q}y2"]) for i in (1, 2)]
    gap = F.round(F.when(meet, 0.0).otherwise(F.least(*one("s", "d"), *one("d", "s"))), 9)
    size = lambda x, y: F.round(F.sqrt(x * x + y * y), 9)
    keeper = F.when(size(sx, sy) >= size(dx, dy), F.col("src")).otherwise(F.col("dst"))
    rows = rows.withColumn("gap_m", gap).where(F.col("gap_m") <= reach)
    left = cut(
        rows.select(
            "component", "src", "dst", "dist_m", keeper.alias("keeper"), F.when(F.col("gap_m") == 0, "geom_intersects").otherwise("geom_near_tol").alias("how"), "gap_m",
            ((F.col("s_at_s") + F.col("d_at_s")) / 2).alias("merged_s"), F.abs(F.col("s_at_s") - F.col("d_at_s")).alias("apart_m"),
        )
    )
    place, pair = F.struct("dist_m", "src", "dst"), F.explode(F.array("src", "dst")).alias("end")
    out = left.limit(0)
    while left.limit(1).count():
        least = left.select(pair, place.alias("place")).groupBy("end").agg(F.min("place").alias("place"))
        taken = least.groupBy("place").agg(F.count("*").alias("n")).where("n = 2").select("place.src", "place.dst")
        taken = cut(left.join(taken, ["src", "dst"], "left_semi"))
        out = out.unionByName(taken)
        used = taken.select(pair)
        for own in ("src", "dst"):
            left = left.join(used.withColumnRenamed("end", own), own, "left_anti")
        left = cut(left)
    return out.drop("dist_m")


def endpoint_interval_raw(arcs: DataFrame, crossings: DataFrame, surfaces: DataFrame, width: float = 1.0) -> DataFrame:
    """The interval of each arc at a cross-section (node_id, role, arc_id, start_s, end_s, width_m,
    mode, n_used). arcs: node_id, role, arc_id, ord, length_m (of the cross-section) and
    projection_s (or null); crossings: node_id, role, arc_id, traj_id, s, clean; surfaces: node_id,
    start_s, end_s. Clean crossings come first, then all, then the projection, then the
    arc's place by (ord, arc_id) in the longest surface interval (if it has company there), then that interval,
    then the first metre. One trajectory gives `width` around its (upper) median. All but the last two are
    clipped to the surface interval that holds their centre, else overlaps most, else is nearest."""
    key = ["node_id", "role", "arc_id"]
    cols = {"lo": F.min, "hi": F.max, "t0": F.min, "t1": F.max}
    source = {"lo": "s", "hi": "s", "t0": "traj_id", "t1": "traj_id"}
    aggs = [f(source[n]).alias(f"all_{n}") for n, f in cols.items()] + [f(F.when(F.col("clean"), F.col(source[n]))).alias(f"clean_{n}") for n, f in cols.items()]
    mids = [F.expr("-percentile_disc(0.5) WITHIN GROUP (ORDER BY -s)").alias("all_mid"), F.expr("-percentile_disc(0.5) WITHIN GROUP (ORDER BY -s) FILTER (WHERE clean)").alias("clean_mid")]
    met = crossings.groupBy(*key).agg(F.count("*").alias("n_all"), F.count_if("clean").alias("n_clean"), *aggs, *mids)
    pick = {n: F.when(F.col("n_clean") > 0, F.col(f"clean_{n}")).otherwise(F.col(f"all_{n}")) for n in [*cols, "mid"]}
    met = met.select(*key, F.col("n_clean") > 0, F.when(F.col("n_clean") > 0, F.col("n_clean")).otherwise(F.col("n_all")).alias("n_used"), *[c.alias(n) for n, c in pick.items()]).toDF(*key, "has_clean", "n_used", *pick)
    longest = surfaces.groupBy("node_id").agg(F.min(F.struct((-F.round(F.col("end_s") - F.col("start_s"), 9)).alias("l"), "start_s", "end_s")).alias("c"))
    group = Window.partitionBy("node_id", "role")
    rows = arcs.withColumns({"_rank": F.row_number().over(group.orderBy("ord", "arc_id")), "_n": F.count("*").over(group)})
    rows = rows.join(met, key, "left").join(longest, "node_id", "left")
    share = F.when(F.col("_n") > 1, F.col("c.start_s") + F.col("_rank") / (F.col("_n") + 1) * (F.col("c.end_s") - F.col("c.start_s")))
    spot = F.coalesce("projection_s", share)
    crossed, one = F.col("n_used").isNotNull(), F.coalesce(F.col("t0") == F.col("t1"), F.lit(True)) | (F.col("hi") - F.col("lo") < 1e-6)
    centre = F.when(crossed & F.coalesce(F.col("t0") == F.col("t1"), F.lit(True)), F.col("mid")).when(crossed, (F.col("lo") + F.col("hi")) / 2).otherwise(spot)
    rows = rows.withColumn("centre", centre).withColumns({"a": F.when(crossed & ~one, F.col("lo")).otherwise(F.col("centre") - width / 2), "b": F.when(crossed & ~one, F.col("hi")).otherwise(F.col("centre") + width / 2)})
    rows = rows.withColumns({"raw_m": F.greatest(F.col("b") - F.col("a"), F.lit(width)), "a": F.greatest(F.lit(0.0), "a")}).withColumn("b", F.greatest("a", "b"))
    mode = F.when(crossed & F.col("has_clean"), "clean_traj_crossing").when(crossed, "ambiguous_traj_crossing").when(spot.isNotNull(), "fallback_projection").when(F.col("c").isNotNull(), "surface_legal_interval").otherwise("xsec_fallback_interval")
    rows = rows.withColumn("mode", mode)

    part = rows.where("centre IS NOT NULL").select(*key, "a", "b", "centre").join(surfaces.select("node_id", F.col("start_s").alias("p"), F.col("end_s").alias("q")), "node_id")
    over = F.greatest(F.lit(0.0), F.least("q", "b") - F.greatest("p", "a"))
    holds = F.col("centre").between(F.col("p") - 1e-6, F.col("q") + 1e-6)
    rank = F.struct((~holds).alias("h"), (-F.round(over, 9)).alias("o"), F.round(F.abs((F.col("p") + F.col("q")) / 2 - F.col("centre")), 9).alias("d"), F.col("p"))
    cut_to = F.struct(F.when(over > 1e-6, F.greatest("p", "a")).otherwise(F.col("p")).alias("p"), F.when(over > 1e-6, F.least("q", "b")).otherwise(F.col("q")).alias("q"))
    clip = part.groupBy(*key).agg(F.min_by(cut_to, rank).alias("k"))
    rows = rows.join(clip, key, "left")
    plain = F.col("mode") == "xsec_fallback_interval"
    start = F.when(plain, 0.0).when(F.col("mode") == "surface_legal_interval", F.col("c.start_s")).otherwise(F.coalesce("k.p", "a"))
    end = F.when(plain, F.least("length_m", F.lit(1.0))).when(F.col("mode") == "surface_legal_interval", F.col("c.end_s")).otherwise(F.coalesce("k.q", "b"))
    wide = F.when(F.col("centre").isNull(), F.col("end_s") - F.col("start_s")).otherwise(F.greatest("raw_m", F.col("end_s") - F.col("start_s")))
    rows = rows.withColumns({"start_s": start, "end_s": end})
    return rows.select(*key, "start_s", "end_s", wide.alias("width_m"), "mode", F.coalesce("n_used", F.lit(0)).alias("n_used"))


def lane_boundary_centerline(
    roads: DataFrame, boundaries: DataFrame, zones: DataFrame, reach: float = 12.0, step: float = 8.0, low: float = 1.5, high: float = 18.0, target: float = 6.0, inside: float = 0.75
) -> DataFrame:
    """The middle between two lane boundaries for each road: (patch_id, road_id, lane_a, lane_b,
    quality, offset_m, length_m, line: array of (k, x, y)). roads and boundaries are segments (zones.segments) by
    (patch_id, road_id) and (patch_id, lane_id). Boundaries within `reach` of the road's middle are tried in pairs:
    at samples every `step` and at the end, the nearest places on both must be `low` to `high`
    apart, three samples or more, and `inside` of their middle line in a zone. Quality falls with
    the offset from the road, the spread of the width and its distance from `target`; the best
    pair stays, of equal ones that with the smaller offset, then the longer line. Roads without
    such a pair have no row. Without any zones the middle line may lie anywhere."""
    from .zones import line_project, polyline_densify, segments

    key = ["patch_id", "road_id"]
    sizes = roads.groupBy(*key).agg(F.sum("seg_m").alias("road_m")).where("road_m > 1e-6")
    own = roads.where("seg_m > 0").join(sizes, key)

    def place(s: Column) -> list[Column]:
        f = (s - F.col("s1")) / F.col("seg_m")
        return [(F.col("x1") + f * (F.col("x2") - F.col("x1"))).alias("x"), (F.col("y1") + f * (F.col("y2") - F.col("y1"))).alias("y")]

    middle = own.where("road_m / 2 >= s1 AND road_m / 2 < s1 + seg_m").select(*key, *place(F.col("road_m") / 2))
    tried = line_project(middle, boundaries, ["lane_id"], ["road_id"], reach).select(*key, "lane_id")
    last = own.groupBy(*key).agg(F.max_by(F.struct("x2", "y2", "s1", "seg_m"), "seq").alias("e"))
    end = last.select(*key, F.ceil((F.col("e.s1") + F.col("e.seg_m")) / step).cast("int").alias("k"), F.col("e.x2").alias("x"), F.col("e.y2").alias("y"))
    spots = polyline_densify(own, key, step).select(*key, "k", "x", "y").union(end)
    n = spots.groupBy(*key).agg(F.count("*").alias("n_spots"))

    b = boundaries.select("patch_id", "lane_id", F.col("seq").alias("bseq"), *[F.col(c).alias(f"b{c}") for c in ("x1", "y1", "x2", "y2")])
    rows = spots.join(tried, key).join(b, ["patch_id", "lane_id"])
    dx, dy = F.col("bx2") - F.col("bx1"), F.col("by2") - F.col("by1")
    t = F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((F.col("x") - F.col("bx1")) * dx + (F.col("y") - F.col("by1")) * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0)))), F.lit(0.0))
    rows = rows.withColumns({"px": F.col("bx1") + t * dx, "py": F.col("by1") + t * dy})
    off = F.round(F.sqrt((F.col("px") - F.col("x")) ** 2 + (F.col("py") - F.col("y")) ** 2), 9)
    near = rows.groupBy(*key, "k", "x", "y", "lane_id").agg(F.min_by(F.struct("px", "py"), F.struct(off.alias("d"), F.col("bseq"))).alias("p"))

    one = near.select(*key, "k", "x", "y", F.col("lane_id").alias("lane_a"), F.col("p").alias("pa"))
    two = near.select(*key, "k", F.col("lane_id").alias("lane_b"), F.col("p").alias("pb"))
    both = one.join(two, [*key, "k"]).where("lane_a < lane_b")
    both = both.withColumns({"cx": (F.col("pa.px") + F.col("pb.px")) / 2, "cy": (F.col("pa.py") + F.col("pb.py")) / 2, "sep": F.sqrt((F.col("pa.px") - F.col("pb.px")) ** 2 + (F.col("pa.py") - F.col("pb.py")) ** 2)})
    both = both.withColumn("off", F.sqrt((F.col("cx") - F.col("x")) ** 2 + (F.col("cy") - F.col("y")) ** 2))
    pair = [*key, "lane_a", "lane_b"]
    line = F.sort_array(F.collect_list(F.struct("k", F.col("cx").alias("x"), F.col("cy").alias("y")))).alias("line")
    stats = both.groupBy(*pair).agg(F.count("*").alias("n"), F.min("sep").alias("sep1"), F.max("sep").alias("sep2"), F.avg("sep").alias("sep"), F.avg("off").alias("offset_m"), line)
    fit = cut(stats.join(n, key).where((F.col("n") >= 3) & (F.col("n") == F.col("n_spots")) & (F.col("sep1") >= low) & (F.col("sep2") <= high)))
    drawn = segments(fit.select(*pair, F.inline("line")), pair, "k")
    lengths = drawn.groupBy(*pair).agg(F.sum("seg_m").alias("length_m")).where("length_m > 1e-6")
    covered = line_zone_pieces(drawn, zones, pair, union=True).groupBy(*pair).agg(F.sum(F.col("end_s") - F.col("start_s")).alias("in_m"))
    kept = fit.join(lengths, pair)
    if zones.limit(1).count():
        kept = kept.join(covered, pair).where(F.round(F.col("in_m") / F.col("length_m"), 9) >= inside)
    loss = F.col("offset_m") / max(reach, 1.0) + F.least(F.lit(0.45), (F.col("sep2") - F.col("sep1")) / max(high, 1.0)) + F.least(F.lit(0.25), F.abs(F.col("sep") - target) / max(high, 1.0))
    kept = kept.withColumn("quality", F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - loss)), 9))
    rank = F.struct(-F.col("quality"), F.round("offset_m", 9), -F.round("length_m", 9), F.col("lane_a"), F.col("lane_b"))
    best = kept.groupBy(*key).agg(F.min_by(F.struct("lane_a", "lane_b", "quality", "offset_m", "length_m", "line"), rank).alias("b"))
    return best.select(*key, "b.*")
