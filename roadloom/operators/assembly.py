"""Choosing and joining what stages have found: intervals, supports, stations and lines."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import tiles
from .groups import fold_groups
from .network import cut


def interval_rank_on_line(intervals: DataFrame, by: list[str], sign: str) -> DataFrame:
    """Rank of intervals along a line's direction: ascending where `sign` is not
    negative, else descending; of intervals with one start, the shorter one first."""
    along = F.when(F.col(sign) < 0, -F.col("end_s")).otherwise(F.col("start_s"))
    return intervals.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(along, "start_s", "end_s")))


def interval_choose(intervals: DataFrame, wanted: DataFrame, by: list[str]) -> DataFrame:
    """For each request (rank, at) the interval with that rank, else the one that holds
    `at`, else the one with the nearest centre."""
    rows = wanted.withColumnsRenamed({"rank": "want_rank"}).join(intervals, by)
    holds = (F.col("start_s") <= F.col("at")) & (F.col("at") <= F.col("end_s"))
    tier = F.when(F.col("rank") == F.col("want_rank"), 0).when(holds, 1).otherwise(2)
    far = F.abs((F.col("start_s") + F.col("end_s")) / 2 - F.col("at"))
    order = F.struct(tier.alias("tier"), F.when(tier == 2, far).otherwise(0.0).alias("d"), "rank")
    got = rows.groupBy(*by, "at").agg(F.min_by(F.struct("rank", "start_s", "end_s", tier.alias("tier")), order).alias("b"))
    return got.select(*by, "at", "b.rank", "b.start_s", "b.end_s", "b.tier")


def other_xsec_hits(crossings: DataFrame, pairs: DataFrame) -> DataFrame:
    """Cross-sections other than its own ends that each pair's trajectory meets."""
    rows = pairs.join(crossings.select("traj_id", "node_id"), "traj_id").where("node_id <> src AND node_id <> dst")
    return rows.groupBy("traj_id", "src", "dst").agg(F.array_sort(F.collect_set("node_id")).alias("others"))


def branch_pair_max_angle(branches: DataFrame) -> DataFrame:
    """Widest pair of branches (node_id, branch, angle, length_m) at each node; ties go
    to the longer pair, then to the smaller numbers."""
    a = branches.select("node_id", F.col("branch").alias("a"), F.col("angle").alias("a_deg"), F.col("length_m").alias("a_m"))
    b = branches.select("node_id", F.col("branch").alias("b"), F.col("angle").alias("b_deg"), F.col("length_m").alias("b_m"))
    turn = F.abs(F.pmod(F.col("b_deg") - F.col("a_deg") + 180, F.lit(360.0)) - 180)
    rows = a.join(b, "node_id").where("a < b").withColumn("turn", F.round(turn, 6))
    best = F.min_by(F.struct("a", "b", "turn"), F.struct(-F.col("turn"), -(F.col("a_m") + F.col("b_m")), F.col("a"), F.col("b"))).alias("p")
    return rows.groupBy("node_id").agg(best).select("node_id", "p.a", "p.b", "p.turn")


def quality_gate_compose(**tables: DataFrame) -> DataFrame:
    """One row per patch from tables (patch_id, passed): each gate and whether all hold; a
    patch that a table lacks fails there."""
    out = None
    for name, df in tables.items():
        own = df.groupBy("patch_id").agg(F.bool_and("passed").alias(f"{name}_ok"))
        out = own if out is None else out.join(own, "patch_id", "full_outer")
    gates = [f"{name}_ok" for name in tables]
    out = out.na.fill(False, gates)
    every = F.lit(True)
    for g in gates:
        every = every & F.col(g)
    return out.withColumn("overall_pass", every)


def along_occupancy(rows: DataFrame, by: list[str], along: str, length: float, bin_m: float) -> DataFrame:
    """Share of the bins along a line that hold a point."""
    n = -(-length // bin_m)
    inside = rows.where((F.col(along) >= 0) & (F.col(along) < length))
    return inside.groupBy(*by).agg((F.count_distinct(F.floor(F.col(along) / bin_m)) / n).alias("occupancy"))


def pair_trace(pairs: DataFrame, **stages: DataFrame) -> DataFrame:
    """For given pairs: how many rows each stage has for them and the first that has none."""
    out, missing = pairs, F.lit(None).cast("string")
    for name, df in reversed(list(stages.items())):
        missing = F.when(F.col(f"n_{name}") == 0, name).otherwise(missing)
    for name, df in stages.items():
        out = out.join(df.groupBy("src", "dst").agg(F.count("*").alias(f"n_{name}")), ["src", "dst"], "left").na.fill(0, [f"n_{name}"])
    return out.withColumn("lost_at", missing)


def override_validate(overrides: DataFrame, catalogue: DataFrame, allowed: list[str]) -> DataFrame:
    """Overrides (key, profile) that can't be used, and why."""
    keys = catalogue.select("key", F.lit(True).alias("known")).distinct()
    n = F.count("*").over(Window.partitionBy("key"))
    rows = overrides.join(keys, "key", "left").withColumn("_n", n)
    why = F.when(F.col("known").isNull(), "unknown_key").when(~F.col("profile").isin(allowed), "unknown_profile").when(F.col("_n") > 1, "repeated_key")
    return rows.withColumn("reason", why).where("reason IS NOT NULL").select("key", "profile", "reason")


def pseudo_xsec_augment(xsecs: DataFrame, roads: DataFrame) -> DataFrame:
    """Cross-sections for road ends without one, on the longest road that ends there:
    (node_id, road_id, source). roads: road_id, snode, enode, length_m."""
    ends = roads.select("road_id", "length_m", F.explode(F.array("snode", "enode")).alias("node_id"))
    bare = ends.join(xsecs.select("node_id").distinct(), "node_id", "left_anti")
    longest = bare.groupBy("node_id").agg(F.min_by("road_id", F.struct(-F.col("length_m"), F.col("road_id"))).alias("road_id"))
    own = xsecs.select("node_id", F.lit(None).cast("long").alias("road_id"), F.lit("input").alias("source"))
    return own.union(longest.select("node_id", "road_id", F.lit("pseudo")))


def xsec_alias_map(pairs: DataFrame, reach: float = 1.5) -> DataFrame:
    """Nodes near exactly one cross-section: node_id -> xsec_id. pairs: node_id, xsec_id, dist."""
    near = pairs.where(F.col("dist") <= reach).groupBy("node_id").agg(F.min("xsec_id").alias("xsec_id"), F.count_distinct("xsec_id").alias("n"))
    return near.where("n = 1").drop("n")


def xsec_id_canonicalize(candidates: DataFrame) -> DataFrame:
    """Node of each cross-section: an explicit one, else the best score of candidates
    (xsec_id, node_id, explicit, in_prior, has_kind, own, place): 4 for a prior road's
    node, 3 for a known kind, 2 for the own id, 1 for the first place."""
    flag = lambda c, w: F.when(F.col(c), w).otherwise(0)
    score = flag("in_prior", 4) + flag("has_kind", 3) + flag("own", 2) + F.when(F.col("place") == 0, 1).otherwise(0)
    best = F.min_by(F.struct("node_id", score.alias("score")), F.struct(~F.col("explicit"), -score, F.col("place"), F.col("node_id"))).alias("b")
    return candidates.groupBy("xsec_id").agg(best).select("xsec_id", "b.node_id", "b.score")


def arc_fit(candidates: DataFrame, arcs: DataFrame, pairs: DataFrame) -> DataFrame:
    """How well arcs fit candidate lines: (cand_id, arc_id, line_m, anchor_m, middle_m, length_gap_m)
    for each pair of `pairs` (cand_id, arc_id). Lines are segments (zones.segments) by cand_id or arc_id. line_m is the
    Hausdorff distance at vertices: the farthest that a vertex of either line is from the
    other line. anchor_m adds the distances of the two starts and the two ends, middle_m is that of the
    middles by length, length_gap_m the difference of lengths.

    Vertices look for the nearest segment in cells (nearest.k_nearest), so long lines aren't multiplied out."""
    from .nearest import k_nearest

    pairs = cut(pairs.select("cand_id", "arc_id").distinct())
    lines = {"cand_id": cut(candidates.where("seg_m > 0")), "arc_id": cut(arcs.where("seg_m > 0"))}

    def vertices(by: str) -> DataFrame:
        rows = lines[by]
        last = rows.groupBy(by).agg(F.max_by(F.struct("x2", "y2", "seq"), "seq").alias("e")).select(by, (F.col("e.seq") + 1).alias("seq"), F.col("e.x2").alias("x1"), F.col("e.y2").alias("y1"))
        return rows.select(by, "seq", "x1", "y1").union(last).withColumns({"x2": F.col("x1"), "y2": F.col("y1")})

    def farthest(by: str, other: str) -> DataFrame:
        asks = pairs.join(vertices(by), by)
        has = pairs.join(lines[other].select(other, F.col("seq").alias("t_seq"), "x1", "y1", "x2", "y2"), other)
        near = k_nearest(asks, has, ["cand_id", "arc_id"], ["seq"], ["t_seq"], points="queries")
        return near.groupBy("cand_id", "arc_id").agg(F.max("d").alias(f"from_{by}"))

    def shape(by: str) -> DataFrame:
        rows = lines[by]
        size = rows.groupBy(by).agg(F.sum("seg_m").alias("m"), F.min_by(F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")), "seq").alias("a"), F.max_by(F.struct(F.col("x2").alias("x"), F.col("y2").alias("y")), "seq").alias("b"))
        f = (F.col("m") / 2 - F.col("s1")) / F.col("seg_m")
        mid = rows.join(size.select(by, "m"), by).where("m / 2 >= s1 AND m / 2 < s1 + seg_m").groupBy(by).agg(F.min(F.struct("seq", (F.col("x1") + f * (F.col("x2") - F.col("x1"))).alias("x"), (F.col("y1") + f * (F.col("y2") - F.col("y1"))).alias("y"))).alias("c"))
        return size.join(mid, by).select(by, *[F.col(c).alias(f"{by[0]}_{c}") for c in "mabc"])

    away = lambda k: F.sqrt((F.col(f"c_{k}.x") - F.col(f"a_{k}.x")) ** 2 + (F.col(f"c_{k}.y") - F.col(f"a_{k}.y")) ** 2)
    rows = pairs.join(farthest("cand_id", "arc_id"), ["cand_id", "arc_id"]).join(farthest("arc_id", "cand_id"), ["cand_id", "arc_id"]).join(shape("cand_id"), "cand_id").join(shape("arc_id"), "arc_id")
    return rows.select("cand_id", "arc_id", F.greatest("from_cand_id", "from_arc_id").alias("line_m"), (away("a") + away("b")).alias("anchor_m"), away("c").alias("middle_m"), F.abs(F.col("c_m") - F.col("a_m")).alias("length_gap_m"))


def arc_assign(fits: DataFrame) -> DataFrame:
    """The arc of each candidate from its fits (arc_fit): (cand_id, arc_id, n_arcs, mode, line_m, anchor_m,
    middle_m, gap_m). A single arc is taken as it is; of several the one that comes first
    by line, anchors, middle, length and id, and gap_m is by how much the second is worse, over the first three together."""
    measures = ["line_m", "anchor_m", "middle_m"]
    exact = fits.withColumns({c: F.round(c, 9) for c in [*measures, "length_gap_m"]})
    own = Window.partitionBy("cand_id")
    w = own.orderBy(*measures, "length_gap_m", "arc_id")
    total = sum((F.col(c) for c in measures), F.lit(0.0))
    rows = exact.withColumns({"_r": F.row_number().over(w), "n_arcs": F.count("*").over(own), "gap_m": F.lead(total).over(w) - total}).where("_r = 1")
    alone = F.col("n_arcs") == 1
    return rows.select("cand_id", "arc_id", "n_arcs", F.when(alone, "unique_direct_arc").otherwise("same_pair_fit").alias("mode"), *[F.when(alone, 0.0).otherwise(F.col(c)).alias(c) for c in measures], "gap_m")


def arc_registry(arcs: DataFrame, **stages: DataFrame) -> DataFrame:
    """All arcs with what each stage (arc_id, status) says of them."""
    out = arcs
    for name, df in stages.items():
        out = out.join(df.select("arc_id", F.col("status").alias(f"{name}_status")), "arc_id", "left")
    return out


def chain_order_check(edges: DataFrame, positions: DataFrame) -> DataFrame:
    """Anchors (node_id, s, may_equal) that don't lie behind the one before them on a
    chain edge (src, dst): those fail, and then no longer count for those after them;
    repeated until no new one fails. Where failing anchors follow each other in a ring,
    the one with the smallest id fails first."""
    from .network import cut

    own = cut(positions.select("node_id", "s", "may_equal", F.lit(False).alias("failed")))
    while True:
        before = edges.join(own.where("NOT failed").select(F.col("node_id").alias("src"), F.col("s").alias("s0")), "src")
        bad = before.join(own.where("NOT failed").select(F.col("node_id").alias("dst"), "s", "may_equal"), "dst").where("s < s0 OR (s = s0 AND NOT may_equal)")
        bad = cut(bad.select(F.col("dst").alias("node_id")).distinct())
        # Of failing anchors only those without a failing one before them are final.
        first = bad.join(edges.join(bad.withColumnsRenamed({"node_id": "src"}), "src").select(F.col("dst").alias("node_id")).distinct(), "node_id", "left_anti")
        first = cut(first.withColumn("_f", F.lit(True)))
        if not first.limit(1).count():
            if not bad.limit(1).count():
                return own
            first = bad.agg(F.min("node_id").alias("node_id")).withColumn("_f", F.lit(True))
        own = cut(own.join(first, "node_id", "left").withColumn("failed", F.col("failed") | F.coalesce("_f", F.lit(False))).drop("_f"))


def station_robust_center(rows: DataFrame, by: list[str], value: str, weight: str, passes: int = 2) -> DataFrame:
    """Weighted mean of each station's values, with weights lowered by the distance from
    the mean over the median distance, twice."""
    w = F.col(weight)
    mean = rows.groupBy(*by).agg((F.sum(w * F.col(value)) / F.sum(w)).alias("centre"))
    for _ in range(passes):
        near = rows.join(mean, by).withColumn("_d", F.round(F.abs(F.col(value) - F.col("centre")), 9))
        mid = near.groupBy(*by).agg(F.greatest(F.percentile("_d", F.lit(0.5)), F.lit(1e-3)).alias("_m"))
        near = near.join(mid, by).withColumn("_w", w / (1 + (F.col("_d") / F.col("_m")) ** 2))
        mean = near.groupBy(*by).agg((F.sum(F.col("_w") * F.col(value)) / F.sum("_w")).alias("centre"), F.first("_m").alias("dispersion"), F.count("*").alias("n"))
    return mean


def surface_center_offset(rows: DataFrame, by: list[str], value: str, low: float = 0.05, high: float = 0.95, least: int = 8) -> DataFrame:
    """Centre and width of the surface at each station, between low and high quantiles of
    the cross offsets of its points."""
    got = rows.groupBy(*by).agg(F.percentile(value, F.lit(low)).alias("lo"), F.percentile(value, F.lit(high)).alias("hi"), F.count("*").alias("n"))
    return got.where(F.col("n") >= least).select(*by, ((F.col("lo") + F.col("hi")) / 2).alias("centre"), (F.col("hi") - F.col("lo")).alias("width"), "n")


def lane_center_hint(bounds: DataFrame, by: list[str], low: float = 1.5, high: float = 18.0) -> DataFrame:
    """Per station the best boundary on either side (offset, quality) and the centre, if they
    are between `low` and `high` apart."""
    best = lambda side: F.min_by("offset", F.struct(-F.col("quality"), F.abs("offset"), F.col("offset"))).alias(side)
    left = bounds.where("offset > 0").groupBy(*by).agg(best("left"))
    right = bounds.where("offset < 0").groupBy(*by).agg(best("right"))
    rows = left.join(right, by).withColumn("apart", F.col("left") - F.col("right"))
    return rows.where(F.col("apart").between(low, high)).withColumn("centre", (F.col("left") + F.col("right")) / 2)


def stable_section(stations: DataFrame, by: list[str], window_m: float = 10.0, tolerance: float = 1.0, ratio: float = 0.1, least: int = 3, base_m: float = 50.0) -> DataFrame:
    """First station from which the width stays within max(tolerance, ratio * base) over
    the next `window_m`, without a gore; else the station nearest to `base_m`.
    stations: s (to the centimetre), width, gore. The base is the median width from base_m on."""
    base = stations.groupBy(*by).agg(F.percentile(F.when(F.col("s") >= base_m, F.col("width")), F.lit(0.5)).alias("base"))
    ahead = Window.partitionBy(*by).orderBy(F.round(F.col("s") * 100).cast("long")).rangeBetween(0, round(100 * window_m))
    rows = stations.withColumns({"_span": F.max("width").over(ahead) - F.min("width").over(ahead), "_gore": F.max("gore").over(ahead), "_n": F.count("*").over(ahead)}).join(base, by)
    ok = (F.col("_n") >= least) & ~F.col("_gore") & (F.col("_span") <= F.greatest(F.lit(tolerance), ratio * F.coalesce("base", F.lit(0.0))))
    got = rows.groupBy(*by).agg(F.min(F.when(ok, F.col("s"))).alias("first_s"), F.min_by("s", F.struct(F.abs(F.col("s") - base_m), F.col("s"))).alias("near_s"))
    return got.select(*by, F.coalesce("first_s", "near_s").alias("s"), F.col("first_s").isNotNull().alias("stable"))


def spine_smooth(stations: DataFrame, by: list[str], value: str, rounds: int = 3, pull: float = 0.5) -> DataFrame:
    """`rounds` of: each inner station moves to `pull` of its neighbours' mean and the rest of
    its own value. Every round reads the one before, so a window per round is exact."""
    w = Window.partitionBy(*by).orderBy("station")
    for _ in range(rounds):
        near = (F.lag(value).over(w) + F.lead(value).over(w)) / 2
        stations = stations.withColumn(value, F.coalesce((1 - pull) * F.col(value) + pull * near, F.col(value)))
    return stations


def support_select(supports: DataFrame, by: list[str], keys: list[Column], carry: list[str]) -> DataFrame:
    """The best support of each arc by several keys, smaller first."""
    got = supports.groupBy(*by).agg(F.min_by(F.struct(*carry), F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)])).alias("b"), F.count("*").alias("n"))
    return got.select(*by, "b.*", "n")


def support_deconflict(supports: DataFrame, top: int = 6) -> DataFrame:
    """Arcs of one pair take different supports: of all assignments from each arc's `top`
    supports (src, dst, arc_id, support, rank, dist, coverage) the one that serves most arcs,
    then has the least sum of ranks, then of distances, then the greatest coverage. Returns
    every arc of the pair; those left without a support have NULL.

    A pair's arcs are few and are solved together, by cheapest augmenting paths: each serves
    one more arc at the least extra cost, so the work is polynomial in the arcs."""

    def solve(rows: list) -> list[tuple]:
        options: dict = {}  # by arc, the costs of its supports
        for r in rows:  # the best row of an arc and a support comes first
            options.setdefault(r.arc_id, {}).setdefault(r.support, (int(r.rank), round(float(r.dist), 9), -round(float(r.coverage), 9)))
        arcs = sorted(options)
        given: dict = {}  # arc -> support
        for a in arcs:  # if all have one best support each and those differ, nothing else is as good
            low = min(options[a].values())
            first = [s for s, c in options[a].items() if c == low]
            if len(first) == 1:
                given[a] = first[0]
        if len(set(given.values())) < len(arcs):
            given = augment(arcs, options)
        return [(rows[0].src, rows[0].dst, a, given.get(a)) for a in arcs]

    def augment(arcs: list, options: dict) -> dict:
        owner: dict = {}  # support -> arc
        while True:
            # Least cost at which each support can be reached from an arc without one.
            served = set(owner.values())
            best = {a: ((0, 0.0, 0.0), None) for a in arcs if a not in served}
            reach: dict = {}
            for _ in range(2 * len(arcs) + 1):
                changed = False
                for a, ((c0, c1, c2), _via) in list(best.items()):
                    for s, (o0, o1, o2) in options[a].items():
                        if owner.get(s) == a:
                            continue
                        total = (c0 + o0, c1 + o1, c2 + o2)
                        if s not in reach or total < reach[s][0]:
                            reach[s] = (total, a)
                            changed = True
                            if s in owner:
                                o = options[owner[s]][s]
                                back = (total[0] - o[0], total[1] - o[1], total[2] - o[2])
                                if owner[s] not in best or back < best[owner[s]][0]:
                                    best[owner[s]] = (back, s)
                if not changed:
                    break
            free = min(((total, s) for s, (total, _) in reach.items() if s not in owner), default=None)
            if free is None:
                return {a: s for s, a in owner.items()}
            s = free[1]
            while s is not None:
                a = reach[s][1]
                before = best[a][1]
                owner[s] = a
                s = before

    order = ["rank", "dist", F.desc("coverage"), "support"]
    w = Window.partitionBy("src", "dst", "arc_id").orderBy(*order)
    few = supports.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= top).select("src", "dst", "arc_id", "support", "rank", "dist", "coverage")
    return fold_groups(few, ["src", "dst"], ["arc_id", *order], solve, "src long, dst long, arc_id long, support long").withColumn("support", F.col("support").cast("long"))


def _line_gap(a: np.ndarray, b: np.ndarray) -> float:
    """Distance of two polylines, given by their points."""

    def to_segments(p: np.ndarray, line: np.ndarray) -> float:
        d = line[1:] - line[:-1]
        t = ((p[:, None] - line[:-1]) * d).sum(-1) / np.maximum((d * d).sum(-1), 1e-300)
        near = line[:-1] + np.clip(t, 0, 1)[..., None] * d
        return float(np.sqrt(((p[:, None] - near) ** 2).sum(-1)).min())

    cross = lambda u, v: u[..., 0] * v[..., 1] - u[..., 1] * v[..., 0]
    p, r, q, s = a[:-1, None], (a[1:] - a[:-1])[:, None], b[None, :-1], (b[1:] - b[:-1])[None]
    den = cross(r, s)
    safe = np.where(den == 0, 1, den)
    t, u = cross(q - p, s) / safe, cross(q - p, r) / safe
    if ((den != 0) & (t >= 0) & (t <= 1) & (u >= 0) & (u <= 1)).any():
        return 0.0
    return min(to_segments(a, b), to_segments(b, a))


def segment_cluster(segments: DataFrame, by: list[str], offset_m: float = 6.0, line_m: float = 5.0) -> DataFrame:
    """Clusters of the segments (segment_id, offset, source, supports, line) of each arc.
    By ascending offset, a segment joins the first cluster whose first member is within
    `offset_m` in offset and `line_m` in distance of lines, else founds one. Clusters are
    ranked by their mean offset. Adds cluster (from 1), size, representative (a trajectory's
    segment before a prior one, then the best supported, then the longest), n_support and
    reason. line: array of (x, y) of two points or more; supports: ids of trajectories.
    The order matters, so each arc's segments are folded together."""

    def fold(rows: list) -> list[tuple]:
        lines = [np.array([[p["x"], p["y"]] for p in r.line], float) for r in rows]
        groups: list[list[int]] = []
        for i, r in enumerate(rows):
            home = next((g for g in groups if abs(r.offset - rows[g[0]].offset) <= offset_m and _line_gap(lines[i], lines[g[0]]) <= line_m), None)
            if home is None:
                groups.append([i])
            else:
                home.append(i)
        groups.sort(key=lambda g: sum(rows[i].offset for i in g) / len(g))
        length = [float(np.sqrt(((x[1:] - x[:-1]) ** 2).sum(-1)).sum()) for x in lines]
        out = []
        for rank, g in enumerate(groups, 1):
            best = min(g, key=lambda i: (rows[i].source != "traj", -len(rows[i].supports), -round(length[i], 9), i))
            kinds = {rows[i].source for i in g}
            reason = "prior_only_cluster" if kinds == {"prior"} else "traj_supported_cluster" if kinds == {"traj"} else "mixed_support"
            n = len({t for i in g for t in rows[i].supports})
            out += [(*[getattr(rows[i], c) for c in by], rows[i].segment_id, rank, len(g), i == best, n, reason) for i in g]
        return out

    schema = ", ".join(f"{c} long" for c in by) + ", segment_id long, cluster int, size int, representative boolean, n_support int, reason string"
    rows = segments.select(*by, "segment_id", F.col("offset").cast("double").alias("offset"), "source", "supports", "line")
    return fold_groups(rows, by, ["offset", "segment_id"], fold, schema)


def traj_stitch_candidates(tails: DataFrame, heads: DataFrame, radii: tuple[float, ...] = (2.0, 5.0, 10.0), max_turn: float = 35.0, least_ahead: float = 0.0, top: int = 3) -> DataFrame:
    """From the ends of trajectories (traj_id, x, y, hx, hy) to vertices of others ahead of
    them, in the smallest radius that has any, at most `max_turn` degrees off: the
    nearest `top`. Ids are whole numbers; see tail_stitches()."""
    spots = cut(tails.select("patch_id", "traj_id", F.lit(0).cast("long").alias("seq"), "x", "y", "hx", "hy"))
    schema = "patch_id long, traj_id long, seq long, p_traj_id long, p_seq long, level int, rank int, d double, turn double"
    work = tiles.stitches_ahead(tuple(sorted(radii)), max_turn, top, least_ahead, by_turn=False)
    got = tiles.by_tiles(spots, heads.select("patch_id", "traj_id", "seq", "x", "y", "hx", "hy"), max(radii), work, schema)
    return got.select("patch_id", "traj_id", "p_traj_id", "p_seq", "level", "rank")


def tail_stitches(vertices: DataFrame, radii: tuple[float, ...] = (2.0, 5.0, 10.0), tail_m: float = 30.0, max_turn: float = 35.0, advance_m: float = 5.0, top: int = 3) -> DataFrame:
    """(patch_id, traj_id, seq, p_traj_id, p_seq, level, rank, d, turn): from every vertex in the last `tail_m` of a trajectory the
    `top` vertices of other ones in the smallest radius that has any: those ahead of it, at most `max_turn` degrees off, with
    `advance_m` left to go. Nearer ones first, then by turn and ids. vertices: patch_id, traj_id, seq, x,
    y, hx, hy, left_m (to the trajectory's end); those without a heading are passed over. Ids are whole numbers. The
    vertices around one are looked at where it lies (tiles.by_tiles), so only the chosen ones leave a task."""
    spots = cut(vertices.where("hx IS NOT NULL").select("patch_id", "traj_id", "seq", "x", "y", "hx", "hy", "left_m"))
    tails, heads = spots.where(F.col("left_m") <= tail_m + 1e-6), spots.where(F.col("left_m") >= advance_m).drop("left_m")
    schema = "patch_id long, traj_id long, seq long, p_traj_id long, p_seq long, level int, rank int, d double, turn double"
    return tiles.by_tiles(tails.drop("left_m"), heads, max(radii), tiles.stitches_ahead(tuple(sorted(radii)), max_turn, top), schema)


def arc_margins(pieces: DataFrame, piece_lines: DataFrame, arcs: DataFrame, arc_lines: DataFrame) -> DataFrame:
    """competing_arc_margin() of lines: pieces (piece_id, arc_id: its own), arcs (arc_id, src) and their segments
    (by cand_id and arc_id, see zones.segments). Distances are the Hausdorff distances of arc_fit(); several lines of one
    piece are given by piece_lines with a cand_id each and the column piece_id."""
    own = pieces.select("piece_id", F.col("arc_id").alias("own_arc")).join(arcs.select(F.col("arc_id").alias("own_arc"), "src"), "own_arc")
    lines = piece_lines.select("piece_id", "cand_id").distinct()
    pairs = cut(own.join(arcs.select("src", "arc_id"), "src").join(lines, "piece_id"))
    fits = arc_fit(piece_lines, arc_lines, pairs).select("cand_id", "arc_id", F.round("line_m", 9).alias("dist"))
    return competing_arc_margin(pairs.join(fits, ["cand_id", "arc_id"]))


def competing_arc_margin(distances: DataFrame) -> DataFrame:
    """Per support piece (piece_id, src, arc_id): distance to its nearest rival (another
    arc of the same source) less that to its own arc. distances: piece_id, src, own_arc,
    arc_id, dist."""
    own, rival = F.col("arc_id") == F.col("own_arc"), F.col("arc_id") != F.col("own_arc")
    got = distances.groupBy("piece_id", "src", "own_arc").agg(F.min(F.when(own, F.col("dist"))).alias("own_m"), F.min(F.when(rival, F.col("dist"))).alias("rival_m"))
    return got.withColumn("margin", F.col("rival_m") - F.col("own_m")).withColumn("preferred", F.coalesce(F.col("margin") >= 1.5, F.lit(True)))


def summary_bundle(metrics: DataFrame, by: list[str], top: int = 10) -> DataFrame:
    """Text of the `top` metrics (name, value) of each group, greatest first."""
    w = Window.partitionBy(*by).orderBy(F.desc("value"), "name")
    rows = metrics.withColumn("r", F.row_number().over(w)).where(F.col("r") <= top)
    line = F.concat("name", F.lit("="), F.format_string("%.3f", "value"))
    lists = rows.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("r", line.alias("t")))).alias("l"))
    return lists.select(*by, F.array_join(F.transform("l", lambda x: x.t), "\n").alias("text"))


def pair_decision_audit(pairs: DataFrame, registry: DataFrame, segments: DataFrame, excluded: DataFrame, bridges: DataFrame, should_not: DataFrame, stages: list[str]) -> DataFrame:
    """Why each pair (src, dst) was kept or dropped: (src, dst, n_arcs, arc_id, segment_id, built,
    entered, selected, reject_stage, reject_reason, should_not_reason). Each table has src and dst:
    registry arc_id, built, entry_allowed, entered, hard_block, unbuilt_stage, unbuilt_reason;
    segments segment_id, direct_legal, is_unique, pair_rank, support; excluded candidate_id, stage,
    reason; bridges stage, reason; should_not reason. A pair's best row speaks for it: of the registry built, allowed and
    entered ones first; of the segments direct, unique, better ranked, better supported ones; of what was excluded the
    first of `stages`. Only pairs that are neither built, entered nor selected have a reason to be rejected."""
    key = ["src", "dst"]
    no = lambda c: (~F.coalesce(F.col(c), F.lit(False))).alias(f"_{c}")
    text = lambda c: F.nullif(F.col(c), F.lit(""))
    reg = registry.groupBy(*key).agg(F.count("*").alias("n_arcs"), F.min(F.struct(no("built"), no("entry_allowed"), no("entered"), "arc_id", "hard_block", "unbuilt_stage", "unbuilt_reason")).alias("r"))
    rank = [no("direct_legal"), no("is_unique"), F.coalesce("pair_rank", F.lit(999999)).alias("p"), (-F.coalesce("support", F.lit(0))).alias("s"), F.col("segment_id")]
    seg = segments.groupBy(*key).agg(F.min(F.struct(*rank)).alias("g"))
    place = F.coalesce(F.nullif(F.array_position(F.lit(stages), F.col("stage")), F.lit(0)), F.lit(len(stages) + 1))
    out = excluded.groupBy(*key).agg(F.min(F.struct(place.alias("p"), "reason", "candidate_id", "stage")).alias("x"))
    gap = bridges.groupBy(*key).agg(F.min(F.struct("stage", "reason")).alias("b"))
    bad = should_not.groupBy(*key).agg(F.min("reason").alias("should_not_reason"))
    rows = pairs.select(*key).distinct()
    for part in (reg, seg, out, gap, bad):
        rows = rows.join(part, key, "left")
    built, entered, chosen = F.coalesce(~F.col("r._built"), F.lit(False)), F.coalesce(~F.col("r._entered"), F.lit(False)), F.col("g").isNotNull()
    lost = ~built & ~entered & ~chosen
    stage = F.coalesce(text("x.stage"), text("r.unbuilt_stage"), text("b.stage"))
    reason = F.coalesce(text("x.reason"), text("r.hard_block"), text("r.unbuilt_reason"), text("b.reason"))
    return rows.select(
        *key, F.coalesce("n_arcs", F.lit(0)).alias("n_arcs"), F.col("r.arc_id").alias("arc_id"), F.col("g.segment_id").alias("segment_id"), built.alias("built"), entered.alias("entered"), chosen.alias("selected"),
        F.when(lost, stage).alias("reject_stage"), F.when(lost, reason).alias("reject_reason"), "should_not_reason",
    )
