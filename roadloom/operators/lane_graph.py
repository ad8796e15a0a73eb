"""Ways between cross-sections over a graph of lane boundaries.

Boundaries are segments (zones.segments) by (patch_id, lane_id). Their vertices are snapped
to cells; a cell is a node, at its smallest vertex.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .nearest import k_nearest
from .network import cut
from .zones import line_zone_pieces

SEGMENT = ["patch_id", "lane_id", "seq"]


def _node(x: Column, y: Column, snap: float) -> Column:
    """A cell's id: its column in the high, its row in the low 32 bits."""
    at = lambda c: F.floor(c / snap).cast("long")
    return F.shiftleft(at(x), 32).bitwiseOR(at(y).bitwiseAND((1 << 32) - 1))


def lane_edges(boundaries: DataFrame, snap: float, surface: DataFrame | None, dividers: DataFrame | None, outside_cost: float, most_outside: float) -> DataFrame:
    """(patch_id, lane_id, seq, u, v, x1, y1, x2, y2, seg_m, cost): boundary segments between two
    different nodes that meet no divider and lie outside the surface for at most a share
    `most_outside` of their length. A metre outside costs 1 + `outside_cost` metres."""
    rows = boundaries.where("seg_m > 1e-6").select(*SEGMENT, "x1", "y1", "x2", "y2", "seg_m")
    rows = rows.withColumns({"u": _node(F.col("x1"), F.col("y1"), snap), "v": _node(F.col("x2"), F.col("y2"), snap)}).where("u <> v")
    rows = cut(rows.withColumn("s1", F.lit(0.0)))
    out = rows.withColumn("outside", F.lit(0.0))
    if dividers is not None:
        hit = line_zone_pieces(rows, dividers, SEGMENT, union=True).select(*SEGMENT).distinct()
        out = out.join(hit, SEGMENT, "left_anti")
    if surface is not None:
        inside = line_zone_pieces(rows, surface, SEGMENT, union=True).groupBy(*SEGMENT).agg(F.sum(F.col("end_s") - F.col("start_s")).alias("in_m"))
        out = out.join(inside, SEGMENT, "left").withColumn("outside", F.greatest(F.lit(0.0), F.round(F.col("seg_m") - F.coalesce("in_m", F.lit(0.0)), 9))).drop("in_m")
        out = out.where(F.col("outside") <= most_outside * F.col("seg_m"))
    return out.withColumn("cost", F.col("seg_m") + outside_cost * F.col("outside")).drop("s1", "outside")


def _runs(edges: DataFrame, ends: DataFrame) -> DataFrame:
    """Runs of a lane's edges between junctions: (patch_id, run, a, b, length_m, cost, n_edges).
    Junctions are nodes that don't have exactly two neighbours, ends of lanes and the
    nodes of `ends` (patch_id, node), so a way that enters a run goes through it."""
    both = edges.select("patch_id", F.col("u").alias("node"), F.col("v").alias("other")).union(edges.select("patch_id", F.col("v"), F.col("u")))
    odd = both.groupBy("patch_id", "node").agg(F.count_distinct("other").alias("n")).where("n <> 2").select("patch_id", "node")
    lane = Window.partitionBy("patch_id", "lane_id").orderBy("seq")
    linked = edges.withColumn("_before", F.lag("v").over(lane))
    starts = linked.where("_before IS NULL OR _before <> u").select("patch_id", F.col("u").alias("node"))
    after = edges.withColumn("_after", F.lead("u").over(lane)).where("_after IS NULL OR _after <> v").select("patch_id", F.col("v").alias("node"))
    joints = cut(odd.union(starts).union(after).union(ends.select("patch_id", "node")).distinct().withColumn("joint", F.lit(True)))
    rows = edges.join(joints.withColumnsRenamed({"node": "u"}), ["patch_id", "u"], "left")
    rows = rows.withColumn("_run", F.sum(F.coalesce(F.col("joint"), F.lit(False)).cast("int")).over(lane.rowsBetween(Window.unboundedPreceding, 0)))
    run = F.xxhash64("lane_id", "_run")
    found = rows.groupBy("patch_id", "lane_id", "_run").agg(
        F.min_by("u", "seq").alias("a"), F.max_by("v", "seq").alias("b"), F.sum("seg_m").alias("length_m"), F.sum("cost").alias("cost"), F.count("*").alias("n_edges"),
        F.array_sort(F.collect_list(F.struct("seq", "x1", "y1", "x2", "y2"))).alias("steps"),
    )
    return found.withColumn("run", run).drop("lane_id", "_run")


def lane_graph_path(
    boundaries: DataFrame, pairs: DataFrame, surface: DataFrame | None = None, dividers: DataFrame | None = None, snap: float = 1.0, k: int = 3, outside_cost: float = 0.0, most_outside: float = 1.0
) -> DataFrame:
    """The cheapest way over lane boundaries for each pair of cross-sections: (patch_id, src, dst, cost, length_m, n_edges, line:
    array of (x, y)). pairs: patch_id, src, dst and the two sections as
    sx1, sy1, sx2, sy2 and dx1, dy1, dx2, dy2. surface and dividers: zones' edges, of the patch if they have one.

    A way leads from one of the `k` nodes nearest to the source to one of the `k` nearest to the
    destination; nodes of both sets count for the source, and where all do, each side has its nearest one (the destination
    another, if there is one). Boundaries may be driven either way. Pairs without a way have no row.

    Distances are lowered in rounds; a round goes on from the nodes that the last one
    lowered, each run of edges between junctions being one step, and leaves out what costs
    no less than the pair's best way so far."""
    pairs = cut(pairs)
    edges = cut(lane_edges(boundaries, snap, surface, dividers, outside_cost, most_outside))
    spots = edges.select("patch_id", F.col("u").alias("node"), F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")).alias("p")).union(edges.select("patch_id", "v", F.struct("x2", "y2")))
    nodes = cut(spots.groupBy("patch_id", "node").agg(F.min("p").alias("p")).select("patch_id", "node", F.col("p.x").alias("x1"), F.col("p.y").alias("y1"), F.col("p.x").alias("x2"), F.col("p.y").alias("y2")))
    pair = ["patch_id", "src", "dst"]

    def nearest(p: str) -> DataFrame:
        ask = pairs.select(*pair, *[F.col(f"{p}{c}").alias(c) for c in ("x1", "y1", "x2", "y2")])
        got = k_nearest(ask, nodes, ["patch_id"], ["src", "dst"], ["node"], k)
        return got.groupBy(*pair).agg(F.array_sort(F.collect_list(F.struct("place", "node"))).alias(p)).select(*pair, F.col(f"{p}.node").alias(p))

    both = nearest("s").join(nearest("d"), pair)
    rest = F.array_except("d", "s")
    all_shared = (F.size(rest) == 0) & (F.size(F.array_except("s", "d")) == 0)
    other = F.when(F.col("d")[0] != F.col("s")[0], F.col("d")[0]).otherwise(F.coalesce(F.try_element_at("d", F.lit(2)), F.col("d")[0]))
    both = both.select(*pair, F.when(all_shared, F.slice("s", 1, 1)).otherwise(F.col("s")).alias("s"), F.when(F.size(rest) > 0, rest).when(all_shared, F.array(other)).otherwise(F.col("d")).alias("d"))
    both = cut(both)
    goals = cut(both.select(*pair, F.explode("d").alias("node"), F.lit(True).alias("goal")))
    starts = both.select(*pair, F.explode("s").alias("node"))
    runs = cut(_runs(edges, starts.select("patch_id", "node").union(goals.select("patch_id", "node"))))
    step = lambda a, b, back: runs.select("patch_id", F.col(a).alias("node"), F.col(b).alias("to"), F.col("cost").alias("more"), F.struct("run", F.lit(back).alias("back")).alias("via"))
    steps = cut(step("a", "b", False).union(step("b", "a", True)))

    state = starts.select(*pair, "node", F.lit(0.0).alias("cost"), F.array().cast("array<struct<run:bigint,back:boolean>>").alias("way"), F.lit(True).alias("new"))
    state = cut(state.join(goals, [*pair, "node"], "left").withColumn("goal", F.coalesce("goal", F.lit(False))))
    # A start that is a goal too is no way; it may still be passed through.
    while state.where("new").limit(1).count():
        best = state.where("goal AND size(way) > 0").groupBy(*pair).agg(F.min("cost").alias("best"))
        going = state.where("new AND NOT (goal AND size(way) > 0)").join(best, pair, "left")
        found = going.join(steps, ["patch_id", "node"]).withColumn("cost", F.round(F.col("cost") + F.col("more"), 9)).where("best IS NULL OR cost < best")
        found = found.groupBy(*pair, F.col("to").alias("node")).agg(F.min(F.struct("cost", F.concat("way", F.array("via")).alias("way"))).alias("f"))
        known = state.withColumn("new", F.lit(False)).join(found, [*pair, "node"], "full_outer").join(goals.withColumnRenamed("goal", "is_goal"), [*pair, "node"], "left")
        lower = F.coalesce(F.col("f.cost") < F.col("cost"), F.col("f.cost").isNotNull() & F.col("cost").isNull(), F.lit(False))
        state = known.select(*pair, "node", F.when(lower, F.col("f.cost")).otherwise(F.col("cost")).alias("cost"), F.when(lower, F.col("f.way")).otherwise(F.col("way")).alias("way"), lower.alias("new"), F.coalesce("is_goal", F.lit(False)).alias("goal"))
        state = cut(state)
    best = state.where("goal AND size(way) > 0").groupBy(*pair).agg(F.min(F.struct("cost", "node", "way")).alias("b")).select(*pair, "b.cost", "b.way")
    parts = best.select(*pair, "cost", F.posexplode("way").alias("ord", "via")).select(*pair, "cost", "ord", F.col("via.run").alias("run"), F.col("via.back").alias("back"))
    parts = parts.join(runs.select("patch_id", "run", "length_m", "n_edges", "steps"), ["patch_id", "run"])
    ahead = F.transform("steps", lambda e: F.array(F.struct(e.x1.alias("x"), e.y1.alias("y")), F.struct(e.x2.alias("x"), e.y2.alias("y"))))
    back = F.transform(F.reverse("steps"), lambda e: F.array(F.struct(e.x2.alias("x"), e.y2.alias("y")), F.struct(e.x1.alias("x"), e.y1.alias("y"))))
    parts = parts.withColumn("xy", F.flatten(F.when(F.col("back"), back).otherwise(ahead)))
    drawn = parts.groupBy(*pair, "cost").agg(F.sum("length_m").alias("length_m"), F.sum("n_edges").alias("n_edges"), F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("ord", "xy"))), lambda e: e.xy)).alias("xy"))
    # Consecutive equal points are one.
    line = F.filter(F.transform("xy", lambda p, i: F.when((i == 0) | (p != F.element_at("xy", F.greatest(i, F.lit(1)))), p)), lambda p: p.isNotNull())
    return drawn.select(*pair, "cost", "length_m", "n_edges", line.alias("line"))
