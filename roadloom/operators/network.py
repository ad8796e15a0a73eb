"""Road graphs: degrees, chains, components, compression and bounded paths.

Graphs are edge tables (src, dst, edge_id, length_m). Walks are rounds of joins of a
frontier with the edges: each round is a distributed join, the number of rounds is
bounded, and they end when the frontier is empty. Between rounds the frontier is
checkpointed, so plans don't grow and a lost executor costs one round.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import DIVERGE, MERGE, arc_edges_of, chain_edges_of, has_kind


def cut(df: DataFrame) -> DataFrame:
    """`df` through a reliable checkpoint (in the session's folder for those)."""
    context = df.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        shared = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not shared and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="roadloom-"))
    return df.checkpoint()


def ends(roads: DataFrame) -> DataFrame:
    """(node_id, road_id, at_end) for both ends of each road."""
    side = F.explode(F.array(F.struct(F.col("snode").alias("node_id"), F.lit(False).alias("at_end")), F.struct(F.col("enode").alias("node_id"), F.lit(True).alias("at_end"))))
    return roads.withColumn("_e", side).withColumns({"node_id": F.col("_e.node_id"), "at_end": F.col("_e.at_end")}).drop("_e")


def node_degree(roads: DataFrame) -> DataFrame:
    return ends(roads).groupBy("node_id").agg(F.count_distinct("road_id").alias("degree"))


def missing_endpoint_refs(roads: DataFrame, nodes: DataFrame) -> DataFrame:
    """Roads of which an end has no node."""
    known = nodes.select("node_id", F.lit(True).alias("known")).distinct()
    has = ends(roads).join(known, "node_id", "left").groupBy("road_id")
    got = has.agg(F.bool_or(~F.col("at_end") & F.col("known").isNull()).alias("missing_start"), F.bool_or(F.col("at_end") & F.col("known").isNull()).alias("missing_end"))
    return got.where("missing_start OR missing_end")


def node_discovery(nodes: DataFrame, mask: int) -> DataFrame:
    """Per kind: nodes, those with a bit of the mask, and repeated ids."""
    return nodes.groupBy("kind").agg(
        F.count("*").alias("n"), F.count_if(has_kind(F.col("kind"), mask)).alias("n_match"), (F.count("*") - F.count_distinct("node_id")).alias("n_repeated")
    )


def node_type_infer(nodes: DataFrame, roads: DataFrame) -> DataFrame:
    """Type by kind if it says so, else by weighted degrees: more ways out than in
    diverge, more in than out merge."""
    edges = arc_edges_of(roads)
    out = edges.groupBy(F.col("src").alias("node_id")).agg(F.count("*").alias("n_out"))
    into = edges.groupBy(F.col("dst").alias("node_id")).agg(F.count("*").alias("n_in"))
    rows = nodes.join(out, "node_id", "left").join(into, "node_id", "left").fillna(0, ["n_out", "n_in"])
    by_degree = F.when(F.col("n_out") > F.col("n_in"), "diverge").when(F.col("n_in") > F.col("n_out"), "merge").otherwise("unknown")
    kind = F.when(has_kind(F.col("kind"), DIVERGE), "diverge").when(has_kind(F.col("kind"), MERGE), "merge").otherwise(by_degree)
    return rows.withColumn("node_type", kind)


def seed_pick(nodes: DataFrame, focus: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(seeds, breakpoints): the focus ids that exist, else all merge and diverge
    nodes; unknown focus ids are breakpoints."""
    if focus is None:
        return nodes.where(has_kind(F.col("kind"), MERGE | DIVERGE)).select("node_id"), nodes.select("node_id").limit(0)
    known = nodes.select("node_id").distinct()
    return focus.join(known, "node_id", "left_semi").select("node_id"), focus.join(known, "node_id", "left_anti").select("node_id")


def chain_follow(roads: DataFrame, seeds: DataFrame, max_m: float = 50.0, hops: int = 256) -> DataFrame:
    """From each edge out of a seed over nodes of degree 2 to the next of degree 3 or
    more: (seed, first_edge, node, dist_m, steps, reason). reason is 'reached',
    'distance_exceed', 'dead_end_or_isolated', 'deg2_out_not_unique' or 'max_hops_reached'."""
    edges = cut(chain_edges_of(roads))
    used = roads.where(F.col("direction").isin(2, 3))
    degree = cut(node_degree(used))
    walk = edges.join(seeds.select(F.col("node_id").alias("src")).distinct(), "src").select(
        F.col("src").alias("seed"), F.col("edge_id").alias("first_edge"), F.col("src").alias("prev"), F.col("dst").alias("node"), F.col("length_m").alias("dist_m"), F.lit(0).alias("steps")
    )
    done: list[DataFrame] = []
    keep = ["seed", "first_edge", "node", "dist_m", "steps"]
    for hop in range(hops):
        rows = walk.join(degree, walk["node"] == degree["node_id"], "left").drop("node_id")
        state = F.when(F.col("dist_m") > max_m + 1e-9, "distance_exceed").when(F.col("degree") >= 3, "reached").when(F.coalesce(F.col("degree"), F.lit(0)) != 2, "dead_end_or_isolated")
        rows = cut(rows.withColumn("reason", state))
        done.append(rows.where("reason IS NOT NULL").select(*keep, "reason"))
        going = rows.where("reason IS NULL")
        if hop == hops - 1 or not going.limit(1).count():
            done.append(going.select(*keep, F.lit("max_hops_reached").alias("reason")))
            break
        nxt = edges.withColumnsRenamed({"src": "node", "dst": "to", "edge_id": "via", "length_m": "more_m"})
        fan = going.join(nxt, "node", "left").where("to IS NULL OR to <> prev OR prev IS NULL")
        choice = fan.groupBy(*keep, "prev").agg(F.count("to").alias("n"), F.min("to").alias("to"), F.min("more_m").alias("more_m"))
        none = going.join(choice.select("seed", "first_edge"), ["seed", "first_edge"], "left_anti").select(*keep, F.lit("deg2_out_not_unique").alias("reason"))
        done.append(none)
        done.append(choice.where("n <> 1").select(*keep, F.lit("deg2_out_not_unique").alias("reason")))
        walk = choice.where("n = 1").select("seed", "first_edge", F.col("node").alias("prev"), F.col("to").alias("node"), (F.col("dist_m") + F.col("more_m")).alias("dist_m"), (F.col("steps") + 1).alias("steps"))
    out = done[0]
    for d in done[1:]:
        out = out.union(d)
    return out


def chain_edges(roads: DataFrame, nodes: DataFrame, limit: float = 50.0, limit_diverge_merge: float = 75.0) -> DataFrame:
    """Shortest chain edge of each ordered pair of seeds (merge or diverge nodes) below
    its limit, which is longer from a diverge to a merge node."""
    seeds, _ = seed_pick(nodes)
    got = chain_follow(roads, seeds, max(limit, limit_diverge_merge)).where("reason = 'reached'")
    kinds = nodes.select(F.col("node_id"), "kind").dropDuplicates(["node_id"])
    rows = got.join(kinds.withColumnsRenamed({"node_id": "seed", "kind": "src_kind"}), "seed").join(kinds.withColumnsRenamed({"node_id": "node", "kind": "dst_kind"}), "node")
    rows = rows.where(has_kind(F.col("dst_kind"), MERGE | DIVERGE))
    far = has_kind(F.col("src_kind"), DIVERGE) & has_kind(F.col("dst_kind"), MERGE)
    ok = F.col("dist_m") < F.when(far, limit_diverge_merge).otherwise(limit)
    return rows.where(ok).groupBy(F.col("seed").alias("src"), F.col("node").alias("dst")).agg(F.min("dist_m").alias("dist_m"))


def components(edges: DataFrame) -> DataFrame:
    """(node_id, component): the smallest node that each reaches, directions aside.
    Labels are lowered over edges and then once more over labels until none changes, so
    the rounds grow with the logarithm of the longest path."""
    both = cut(edges.select(F.col("src").alias("a"), F.col("dst").alias("b")).union(edges.select(F.col("dst").alias("a"), F.col("src").alias("b"))).distinct())
    own = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("c")).withColumnsRenamed({"a": "node_id"})
    while True:
        low = both.join(own, both["b"] == own["node_id"]).groupBy("a").agg(F.min("c").alias("m"))
        new = own.join(low, own["node_id"] == low["a"], "left").select("node_id", F.col("c").alias("was"), F.least("c", "m").alias("c"))
        hop = new.select(F.col("node_id").alias("c"), F.col("c").alias("next"))
        new = cut(new.join(hop, "c", "left").select("node_id", "was", F.coalesce("next", "c").alias("c")))
        own = new.select("node_id", "c")
        if not new.where("c <> was").limit(1).count():
            return own.withColumnsRenamed({"c": "component"})


def on_cycles(edges: DataFrame) -> DataFrame:
    """(node_id) of the nodes from which no order by edges remains: peeling nodes without an edge in,
    round by round, leaves those on cycles and behind them. A round peels all such nodes at
    once, so there are as many as edges on the longest peeled path; each is a
    count of edges in, kept up to date by what the round removed."""
    edges = cut(edges.select("src", "dst"))
    degree = edges.groupBy(F.col("dst").alias("node_id")).agg(F.count("*").alias("n_in"))
    nodes = edges.select(F.col("src").alias("node_id")).union(edges.select("dst")).distinct()
    left = cut(nodes.join(degree, "node_id", "left").fillna(0, ["n_in"]))
    while True:
        free = left.where("n_in = 0").select(F.col("node_id").alias("src"))
        if not free.limit(1).count():
            return left.select("node_id")
        gone = edges.join(free, "src").groupBy(F.col("dst").alias("node_id")).agg(F.count("*").alias("gone"))
        left = left.where("n_in > 0").join(gone, "node_id", "left")
        left = cut(left.select("node_id", (F.col("n_in") - F.coalesce("gone", F.lit(0))).alias("n_in")))


def chain_offsets(edges: DataFrame) -> DataFrame:
    """(node_id, component, offset_m, is_dag): least distance of each node from the sources of its chain (nodes without an edge
    in; on a cycle without any, its smallest node), and whether its chain has no cycle. edges: src, dst, dist_m, which is not
    negative. Rounds go on until no distance changes; a round sees the nodes that the one
    before it has changed."""
    edges = cut(edges.select("src", "dst", "dist_m"))
    if edges.where("dist_m < 0").limit(1).count():
        raise ValueError("distances must not be negative")
    label = components(edges)
    into = edges.select(F.col("dst").alias("node_id")).distinct()
    sources = label.join(into, "node_id", "left_anti")
    headless = label.join(sources.select("component").distinct(), "component", "left_anti").groupBy("component").agg(F.min("node_id").alias("node_id"))
    off = sources.select("node_id", F.lit(0.0).alias("offset_m")).union(headless.select("node_id", F.lit(0.0)))
    off = cut(off.withColumn("new", F.lit(True)))
    while off.where("new").limit(1).count():
        last = off.where("new")
        step = edges.join(last, edges["src"] == last["node_id"]).groupBy(F.col("dst").alias("node_id")).agg(F.min(F.col("offset_m") + F.col("dist_m")).alias("step_m"))
        lower = F.coalesce(F.col("step_m") < F.col("offset_m"), F.col("step_m").isNotNull())
        off = off.drop("new").join(step, "node_id", "full_outer")
        off = cut(off.select("node_id", F.least("offset_m", "step_m").alias("offset_m"), lower.alias("new")))
    cyclic = label.join(on_cycles(edges), "node_id", "left_semi").select("component").distinct().withColumn("is_dag", F.lit(False))
    return label.join(off.drop("new"), "node_id").join(cyclic, "component", "left").withColumn("is_dag", F.coalesce("is_dag", F.lit(True)))


def as_paths(edges: DataFrame) -> DataFrame:
    """Single edges in the form of graph_compress()."""
    return edges.select("src", "dst", F.array("src", "dst").alias("nodes"), F.array("edge_id").alias("edge_ids"), "length_m")


def walks(paths: DataFrame, starts: DataFrame, stops: DataFrame, budget: int = 2048) -> DataFrame:
    """Simple ways from `starts` (node_id) over `paths` (src, dst, nodes, edge_ids, length_m: what
    graph_compress() or as_paths() gives) through nodes that aren't in `stops` to the next one that is:
    (src, anchor, dst, nodes, edge_ids, length_m, overflow). A way may return to its start if that is a stop.

    Each first path of a start is a search of its own, known by its first edge (anchor). A search
    takes in at most `budget` partial ways: rounds go one path further, and the round that
    would exceed the budget keeps its first ones by nodes and edges and ends the search. No search
    is lost: one that was cut has a row of its own, without dst, nodes and edges, and `overflow`
    marks all its rows."""
    paths = cut(paths.select("src", "dst", "nodes", "edge_ids", "length_m"))
    stop = cut(stops.select("node_id", F.lit(True).alias("stop")).distinct())
    nxt = paths.select(F.col("src").alias("at"), F.col("dst").alias("to"), F.expr("slice(nodes, 2, size(nodes))").alias("more"), F.col("edge_ids").alias("via"), F.col("length_m").alias("m"))
    nxt = cut(nxt.join(stop.withColumnsRenamed({"node_id": "to"}), "to", "left"))
    first = starts.select(F.col("node_id").alias("at")).distinct().join(nxt, "at")
    rows = first.select(
        F.col("at").alias("src"), F.col("via")[0].alias("anchor"), "to", F.concat(F.array("at"), "more").alias("nodes"), F.col("via").alias("edge_ids"),
        F.col("m").alias("length_m"), F.coalesce("stop", F.lit(False)).alias("stop"), F.lit(1).cast("long").alias("used"),
    )
    rows = cut(rows.where(F.col("stop") | (F.col("src") != F.col("to"))))
    found, late = [rows.where("stop")], []
    while True:
        going = rows.where("NOT stop")
        if not going.limit(1).count():
            break
        rows = going.withColumnsRenamed({"to": "at"}).drop("stop").join(nxt, "at").where(F.coalesce("stop", F.lit(False)) | ~F.array_contains("nodes", F.col("to")))
        rows = rows.select(
            "src", "anchor", "to", F.concat("nodes", "more").alias("nodes"), F.concat("edge_ids", "via").alias("edge_ids"), (F.col("length_m") + F.col("m")).alias("length_m"),
            F.coalesce("stop", F.lit(False)).alias("stop"), "used",
        )
        search = Window.partitionBy("src", "anchor")
        rows = rows.withColumns({"n": F.count("*").over(search), "rank": F.row_number().over(search.orderBy("nodes", "edge_ids"))})
        rows = cut(rows.withColumns({"over": F.col("used") + F.col("n") > budget, "kept": F.col("used") + F.col("rank") <= budget}))
        late.append(rows.where("over").select("src", "anchor").distinct())
        rows = rows.where("kept").withColumn("used", F.col("used") + F.col("n")).drop("n", "rank", "kept")
        found.append(rows.where("stop").drop("over"))
        rows = rows.where("NOT over").drop("over")
    out = found[0]
    for f in found[1:]:
        out = out.union(f)
    out = out.select("src", "anchor", F.col("to").alias("dst"), "nodes", "edge_ids", "length_m")
    if not late:
        return out.withColumn("overflow", F.lit(False))
    cut_off = late[0]
    for x in late[1:]:
        cut_off = cut_off.union(x)
    cut_off = cut(cut_off.distinct())
    out = out.unionByName(cut_off, allowMissingColumns=True)
    return out.join(cut_off.withColumn("overflow", F.lit(True)), ["src", "anchor"], "left").withColumn("overflow", F.coalesce("overflow", F.lit(False)))


def graph_compress(edges: DataFrame, fixed: DataFrame, by_neighbours: bool = False) -> DataFrame:
    """Contracts nodes with one edge in and one out that aren't `fixed`: paths
    (src, dst, nodes, edge_ids, length_m, closed) between the nodes that stay. Parallel edges
    are paths of their own, so a node at either end of them stays, and there are never more paths than
    edges. A loop of contracted nodes alone is a path from its
    smallest node back to it, with `closed`.

    With `by_neighbours`, nodes with one neighbour in and one out are contracted, however many
    edges lead there, and each choice among parallel edges is a path: the rows of a
    chain are the product of its choices, all of them.

    Contracted nodes point at the node before them, and each round lets them point where
    that node points, so the rounds grow with the logarithm of the longest chain, of any
    length."""
    if not by_neighbours:
        return _contracted(edges, fixed).drop("lengths")
    choices = F.array_sort(F.collect_list(F.struct("edge_id", "length_m")))
    steps = cut(edges.groupBy("src", "dst").agg(choices.alias("choices")))
    first = steps.select("src", "dst", F.col("choices")[0]["edge_id"].alias("edge_id"), F.col("choices")[0]["length_m"].alias("length_m"))
    return _every_choice(_contracted(first, fixed), steps.where("size(choices) > 1"))


def _every_choice(paths: DataFrame, parallel: DataFrame, at_once: int = 10_000) -> DataFrame:
    """`paths` over single steps, once for each choice of edges where steps are `parallel` (src, dst,
    choices). Choices are counted through and dealt out by `at_once`, so that neither a row nor a task holds a path's product."""
    paths = cut(paths.withColumn("second", F.col("nodes")[1]))  # a step is in one path only
    step = F.transform(F.sequence(F.lit(1), F.size("edge_ids")), lambda i: F.struct(F.get("nodes", i - 1).alias("a"), F.get("nodes", i).alias("b")))
    spots = paths.select("src", "second", F.posexplode(step).alias("pos", "step")).select("src", "second", "pos", "step.*")
    spots = spots.join(parallel.select(F.col("src").alias("a"), F.col("dst").alias("b"), "choices"), ["a", "b"])
    spots = spots.groupBy("src", "second").agg(F.array_sort(F.collect_list(F.struct("pos", "choices"))).alias("spots"))
    n_ways = F.aggregate("spots", F.lit(1).cast("long"), lambda n, s: n * F.size(s["choices"]))
    many = paths.join(spots, ["src", "second"]).withColumn("n_ways", n_ways)
    many = many.withColumn("deal", F.explode(F.expr(f"sequence(0L, (n_ways - 1) div {at_once}L)"))).repartition("src", "second", "deal")
    many = many.withColumn("way", F.explode(F.expr(f"sequence(deal * {at_once}L, least(n_ways, (deal + 1) * {at_once}L) - 1)")))
    picked = """map_from_arrays(transform(spots, s -> s.pos), aggregate(spots,
        named_struct('left', way, 'picked', slice(spots[0].choices, 1, 0)),
        (acc, s) -> named_struct('left', acc.left div size(s.choices), 'picked', concat(acc.picked, array(s.choices[cast(acc.left % size(s.choices) AS int)]))),
        acc -> acc.picked))"""
    many = many.withColumn("picked", F.expr(picked))
    chosen = lambda own, field: F.expr(f"transform({own}, (e, i) -> coalesce(picked[i].{field}, e))")
    many = many.withColumns({"edge_ids": chosen("edge_ids", "edge_id"), "lengths": chosen("lengths", "length_m")}).withColumn("length_m", _total("lengths"))
    out = ["src", "dst", "nodes", "edge_ids", "length_m", "closed"]
    return paths.join(spots, ["src", "second"], "left_anti").select(*out).union(many.select(*out))


def _total(lengths: str) -> Column:
    return F.aggregate(lengths, F.lit(0.0), lambda acc, m: acc + m)


def _contracted(edges: DataFrame, fixed: DataFrame) -> DataFrame:
    """graph_compress() by edges, with the edges' `lengths`."""
    edges = cut(edges.select("src", "dst", "edge_id", "length_m"))
    out = edges.groupBy(F.col("src").alias("node_id")).agg(F.count("*").alias("n_out"))
    into = edges.groupBy(F.col("dst").alias("node_id")).agg(F.count("*").alias("n_in"), F.min("src").alias("up"))
    inner = out.join(into, "node_id").where("n_out = 1 AND n_in = 1").join(fixed.select("node_id").distinct(), "node_id", "left_anti")
    inner = cut(inner.select("node_id", "up"))

    def pointed(inner: DataFrame) -> tuple[DataFrame, int]:
        """For contracted nodes: the node that stays before them (up), the first one after
        it (low) and the steps from it (n); and how many are on loops."""
        own = inner.join(inner.select(F.col("node_id").alias("up"), F.lit(False).alias("done")), "up", "left")
        own = cut(own.select("node_id", "up", F.col("node_id").alias("low"), F.lit(1).cast("long").alias("n"), F.coalesce("done", F.lit(True)).alias("done")))
        left = own.where("NOT done").count()
        while left:
            far = own.select(F.col("node_id").alias("up"), F.col("up").alias("up2"), F.col("low").alias("low2"), F.col("n").alias("n2"), F.col("done").alias("done2"))
            moved = own.where("NOT done").join(far, "up").select("node_id", F.col("up2").alias("up"), F.col("low2").alias("low"), (F.col("n") + F.col("n2")).alias("n"), F.col("done2").alias("done"))
            own = cut(own.where("done").union(moved))
            still = own.where("NOT done").count()
            if still == left:  # a round settles some node of every chain that is left
                break
            left = still
        return own, left

    own, loops = pointed(inner)
    closed = inner.select("node_id").limit(0)
    if loops:
        round_ = own.where("NOT done").select("node_id")
        among = edges.join(round_.withColumnsRenamed({"node_id": "src"}), "src", "left_semi")
        closed = cut(components(among).groupBy("component").agg(F.min("node_id").alias("node_id")).select("node_id"))
        own, _ = pointed(cut(inner.join(closed, "node_id", "left_anti")))

    # The step from a contracted node belongs to the path that enters its chain; one from a
    # node that stays begins a path, known by the contracted node it leads to or, between two that stay, by itself.
    place = own.select(F.col("node_id").alias("src"), F.col("up").alias("head"), "low", "n")
    rows = edges.join(place, "src", "left").join(own.select(F.col("node_id").alias("dst"), F.lit(True).alias("enters")), "dst", "left")
    own_path = F.when(F.col("low").isNull() & F.col("enters").isNull(), F.col("edge_id"))
    rows = rows.select(F.coalesce("head", "src").alias("head"), F.coalesce("low", "dst").alias("low"), own_path.alias("single"), F.coalesce("n", F.lit(0)).alias("n"), "dst", "edge_id", "length_m")
    paths = rows.groupBy("head", "low", "single").agg(F.array_sort(F.collect_list(F.struct("n", "dst", "edge_id", "length_m"))).alias("steps"))
    nodes = F.concat(F.array("head"), F.transform("steps", lambda s: s.dst))
    paths = paths.select(F.col("head").alias("src"), nodes.alias("nodes"), F.transform("steps", lambda s: s.edge_id).alias("edge_ids"), F.transform("steps", lambda s: s.length_m).alias("lengths"))
    paths = paths.select("src", F.element_at("nodes", -1).alias("dst"), "nodes", "edge_ids", _total("lengths").alias("length_m"), "lengths")
    return paths.join(closed.select(F.col("node_id").alias("src"), F.lit(True).alias("closed")), "src", "left").withColumn("closed", F.coalesce("closed", F.lit(False)))


def legal_arcs(paths: DataFrame, xsecs: DataFrame) -> DataFrame:
    """Compressed edges between two different cross-sections, numbered per pair."""
    own = xsecs.select("node_id").distinct()
    rows = paths.join(own.withColumnsRenamed({"node_id": "src"}), "src", "left_semi").join(own.withColumnsRenamed({"node_id": "dst"}), "dst", "left_semi").where("src <> dst")
    return rows.withColumn("arc_no", F.row_number().over(Window.partitionBy("src", "dst").orderBy("length_m", "edge_ids")))


def numbered_ways(paths: DataFrame, xsecs: DataFrame) -> DataFrame:
    """All simple ways over compressed edges from one cross-section to another as (src, dst, nodes,
    edge_ids, length_m, direct, arc_no). Legal arcs are `direct` and have the numbers that legal_arcs() gives
    them; ways through nodes that stay follow. Searches have no budget here, so no way is left out."""
    own = cut(xsecs.select("node_id").distinct())
    columns = ["src", "dst", "nodes", "edge_ids", "length_m"]
    arcs = legal_arcs(paths, own).select(*columns, F.lit(True).alias("direct"))
    # An arc ends a search at once: the others begin with a path to a node that stays.
    at = lambda end: own.select(F.col("node_id").alias(end), F.lit(True).alias(f"{end}_own"))
    searched = paths.join(at("src"), "src", "left").join(at("dst"), "dst", "left").where("src_own IS NULL OR dst_own IS NULL")
    ways = walks(searched, own, own, budget=1 << 62).where("src <> dst").select(*columns, F.lit(False).alias("direct"))
    number = Window.partitionBy("src", "dst").orderBy(F.desc("direct"), "length_m", "edge_ids")
    return arcs.union(ways).withColumn("arc_no", F.row_number().over(number))


def pair_gate(pairs: DataFrame, direct: DataFrame, traced: DataFrame, terminals: DataFrame) -> DataFrame:
    """Reason for each (src, dst): direct arcs (one or several), owner of the terminal,
    trace only, reverse only, none."""
    one = direct.groupBy("src", "dst").agg(F.count("*").alias("n_direct"))
    trace = traced.select("src", "dst", F.lit(True).alias("trace")).distinct()
    back = direct.select(F.col("src").alias("dst"), F.col("dst").alias("src"), F.lit(True).alias("back")).distinct()
    rows = pairs.join(one, ["src", "dst"], "left").join(trace, ["src", "dst"], "left").join(back, ["src", "dst"], "left").join(terminals, "dst", "left")
    return rows.withColumn("reason", gate_reason())


def gate_reason() -> Column:
    mismatch = (F.col("owner_status") == "unique_owner") & (F.col("owner") != F.col("src"))
    return (
        F.when(mismatch, "owner_mismatch").when(F.col("n_direct") == 1, "direct_unique").when(F.col("n_direct") > 1, "direct_ambiguous")
        .when(F.col("trace"), "trace_only").when(F.col("back"), "reverse_only").otherwise("not_reachable")
    )


def terminal_ownership(paths: DataFrame, xsecs: DataFrame, budget: int = 2048) -> DataFrame:
    """(dst, owner_status, owner, n_anchors, n_accepted, n_multi_src, n_multi_chain, n_no_owner,
    n_overflow) of each terminal, a cross-section with legal arcs in and none out. Each compressed edge into it is an anchor, from which
    a search goes backwards to the cross-sections before it. One source by one way is accepted;
    several sources or several ways are not. A terminal whose anchors all accept the same source
    is owned by it (n_overflow tells whether a search that found it was cut); more sources make it 'multi_owner', several ways or a search out of
    budget 'ambiguous_owner', anything else 'no_owner'."""
    paths = cut(paths.select("src", "dst", "nodes", "edge_ids", "length_m"))
    arcs = legal_arcs(paths, xsecs)
    terminals = arcs.select(F.col("dst").alias("node_id")).distinct().join(arcs.select(F.col("src").alias("node_id")), "node_id", "left_anti")
    terminals = cut(terminals)
    back = paths.select(F.col("dst").alias("src"), F.col("src").alias("dst"), F.reverse("nodes").alias("nodes"), F.reverse("edge_ids").alias("edge_ids"), "length_m")
    ways = walks(back, terminals, xsecs, budget).where("dst IS NULL OR dst <> src")
    by_src = ways.groupBy("src", "anchor", "dst").agg(F.count_distinct("edge_ids").alias("n_ways"), F.bool_or("overflow").alias("overflow"))
    named = F.col("dst").isNotNull()
    found = by_src.groupBy("src", "anchor").agg(F.count_if(named).alias("n_src"), F.max(F.when(named, F.col("n_ways"))).alias("n_ways"), F.min("dst").alias("owner"), F.bool_or("overflow").alias("overflow"))
    anchors = back.join(terminals.withColumnsRenamed({"node_id": "src"}), "src").select("src", F.col("edge_ids")[0].alias("anchor")).distinct()
    state = F.when(F.col("n_src") >= 2, "multi_src").when(F.col("n_src") == 1, F.when(F.col("n_ways") >= 2, "multi_chain").otherwise("accepted")).otherwise("no_owner")
    rows = anchors.join(found, ["src", "anchor"], "left").withColumn("state", state)
    count = lambda name: F.count_if(F.col("state") == name)
    own = rows.groupBy(F.col("src").alias("dst")).agg(
        F.count("*").alias("n_anchors"), count("accepted").alias("n_accepted"), count("multi_src").alias("n_multi_src"), count("multi_chain").alias("n_multi_chain"), count("no_owner").alias("n_no_owner"),
        F.count_if(F.coalesce("overflow", F.lit(False))).alias("n_overflow"), F.count_distinct(F.when(F.col("state") == "accepted", F.col("owner"))).alias("n_owners"),
        F.min(F.when(F.col("state") == "accepted", F.col("owner"))).alias("first"),
    )
    unique = (F.col("n_owners") == 1) & (F.col("n_multi_src") + F.col("n_multi_chain") + F.col("n_no_owner") == 0)
    many = (F.col("n_multi_src") > 0) | (F.col("n_owners") >= 2)
    status = F.when(unique, "unique_owner").when(many, "multi_owner").when((F.col("n_multi_chain") > 0) | (F.col("n_overflow") > 0), "ambiguous_owner").otherwise("no_owner")
    out = own.withColumn("owner_status", status).withColumn("owner", F.when(unique, F.col("first")))
    return out.select("dst", "owner_status", "owner", "n_anchors", "n_accepted", "n_multi_src", "n_multi_chain", "n_no_owner", "n_overflow")


def trace_only_pairs(traced: DataFrame, direct: DataFrame) -> DataFrame:
    return traced.select("src", "dst").distinct().subtract(direct.select("src", "dst"))


def bridge_paths(asked: DataFrame, direct: DataFrame, traced: DataFrame, hops: int = 4, most: int = 32, budget: int = 2048) -> DataFrame:
    """(src, dst, n_paths, n_middle, bridge, overflow) of each asked pair (src, dst) without a
    direct arc, by the simple paths of at most `hops` direct pairs between its ends: one middle node of
    two-hop paths is 'unique', more are 'ambiguous'; longer paths, or a way in `traced`, leave a 'gap';
    a pair with nothing of this is a 'reject'.

    Partial paths stay on nodes from which the pair's end is still within reach, and a
    pair takes in at most `budget` of them, the first by their nodes in the round that
    would exceed it; `overflow` marks such a pair. n_paths counts up to `most` paths. Middle nodes come from a join of their own and need no budget."""
    steps = cut(direct.select("src", "dst").where("src <> dst").distinct())
    pairs = asked.select("src", "dst").distinct().where("src <> dst").join(steps, ["src", "dst"], "left_anti")
    pairs = cut(pairs)
    # Nodes from which an asked end is within 1, 2, ... hops.
    reach = [pairs.select("dst", F.col("dst").alias("at")).distinct()]
    for _ in range(hops - 1):
        further = reach[-1].join(steps.select(F.col("src").alias("from"), F.col("dst").alias("at")), "at").select("dst", F.col("from").alias("at"))
        reach.append(cut(reach[-1].union(further).distinct()))
    path = pairs.select("src", "dst", F.col("src").alias("at"), F.array("src").alias("nodes"), F.lit(0).cast("long").alias("used"))
    done, late = [], []
    for hop in range(hops):
        ahead = steps.select(F.col("src").alias("at"), F.col("dst").alias("to"))
        path = path.join(ahead, "at").where(~F.array_contains("nodes", F.col("to"))).drop("at").withColumnRenamed("to", "at").join(reach[hops - 1 - hop], ["dst", "at"], "left_semi")
        pair = Window.partitionBy("src", "dst")
        path = path.withColumn("nodes", F.concat("nodes", F.array("at"))).withColumns({"n": F.count("*").over(pair), "rank": F.row_number().over(pair.orderBy("nodes"))})
        path = cut(path.withColumns({"over": F.col("used") + F.col("n") > budget, "kept": F.col("used") + F.col("rank") <= budget}))
        late.append(path.where("over").select("src", "dst").distinct())
        path = path.where("kept").withColumn("used", F.col("used") + F.col("n")).drop("n", "rank", "kept")
        done.append(path.where("at = dst").groupBy("src", "dst").agg(F.count("*").alias("n")))
        path = path.where("NOT over AND at <> dst").drop("over")
    found, cut_off = done[0], late[0]
    for d, x in zip(done[1:], late[1:]):
        found, cut_off = found.union(d), cut_off.union(x)
    found = found.groupBy("src", "dst").agg(F.least(F.sum("n"), F.lit(most)).alias("n_paths"))
    to_middle = pairs.join(steps.select("src", F.col("dst").alias("middle")), "src")
    middle = to_middle.join(steps.select(F.col("src").alias("middle"), "dst"), ["middle", "dst"], "left_semi").groupBy("src", "dst").agg(F.count_distinct("middle").alias("n_middle"))
    trace = traced.where("dst IS NOT NULL").select("src", "dst", F.lit(True).alias("traced")).distinct()
    rows = pairs.join(found, ["src", "dst"], "left").join(middle, ["src", "dst"], "left").join(trace, ["src", "dst"], "left")
    rows = rows.join(cut_off.distinct().withColumn("overflow", F.lit(True)), ["src", "dst"], "left").fillna(0, ["n_paths", "n_middle"]).fillna(False, ["traced", "overflow"])
    kind = F.when(F.col("n_middle") == 1, "unique").when(F.col("n_middle") >= 2, "ambiguous").when((F.col("n_paths") > 0) | F.col("traced") | F.col("overflow"), "gap").otherwise("reject")
    return rows.select("src", "dst", "n_paths", "n_middle", kind.alias("bridge"), "overflow")
