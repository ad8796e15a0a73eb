"""Repair of clipped roads: which end is which, which piece stays, what nodes it needs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import stable_node_id
from .zones import line_zone_pieces


def distance(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    return F.sqrt((ax - bx) ** 2 + (ay - by) ** 2)


def endpoint_assign(rows: DataFrame) -> DataFrame:
    """Adds `flip`: whether a line's first end (x1, y1) is at its destination. With both
    references (sx, sy) and (dx, dy) the smaller sum of distances decides, with one the
    smaller distance, with none the line's own direction; ties keep the direction."""
    c = F.col
    s1, s2 = distance(c("sx"), c("sy"), c("x1"), c("y1")), distance(c("sx"), c("sy"), c("x2"), c("y2"))
    d1, d2 = distance(c("dx"), c("dy"), c("x1"), c("y1")), distance(c("dx"), c("dy"), c("x2"), c("y2"))
    flip = F.when(c("sx").isNotNull() & c("dx").isNotNull(), s1 + d2 > s2 + d1).when(c("sx").isNotNull(), s1 > s2).when(c("dx").isNotNull(), d2 > d1)
    return rows.withColumn("flip", F.coalesce(flip, F.lit(False)))


def choose_clipped_piece(pieces: DataFrame, by: list[str], snap: float = 2.0) -> DataFrame:
    """The piece of each road to keep: most ends at existing nodes, then longest, then
    nearest, then first. pieces: ends (x1, y1), (x2, y2), references, start_s, end_s."""
    c = F.col
    near = lambda px, py: F.least(distance(c(px), c(py), c("x1"), c("y1")), distance(c(px), c(py), c("x2"), c("y2")))
    rows = pieces.withColumns({"to_src": near("sx", "sy"), "to_dst": near("dx", "dy")})
    hits = F.coalesce((c("to_src") <= snap).cast("int"), F.lit(0)) + F.coalesce((c("to_dst") <= snap).cast("int"), F.lit(0))
    both = F.least(distance(c("sx"), c("sy"), c("x1"), c("y1")) + distance(c("dx"), c("dy"), c("x2"), c("y2")), distance(c("sx"), c("sy"), c("x2"), c("y2")) + distance(c("dx"), c("dy"), c("x1"), c("y1")))
    rows = rows.withColumns({"n_hits": hits, "score": F.coalesce(both, c("to_src"), c("to_dst"), F.lit(0.0))})
    order = [F.desc("n_hits"), F.desc(F.round(c("end_s") - c("start_s"), 6)), F.round("score", 6), c("start_s")]
    rows = rows.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where("_r = 1").drop("_r")
    known = c("sx").isNotNull() | c("dx").isNotNull()
    reason = F.when(~known, "fallback_longest_no_existing_endpoint").when(c("n_hits") == 0, "fallback_longest_no_endpoint_match")
    return rows.withColumn("reason", reason)


def endpoint_repair(roads: DataFrame, nodes: DataFrame, zone_edges: DataFrame, snap: float = 2.0) -> DataFrame:
    """Roads of which an end has no node, clipped to the zones: new ends, the nodes to
    create (stable ids from road, side and place) and why. roads: road_id, snode, enode
    and a straight line x1, y1, x2, y2. Roads with both nodes are left out; roads that
    no zone holds come back with reason 'clipped_empty'."""
    own = nodes.select("node_id", "x", "y").dropDuplicates(["node_id"])
    rows = roads.join(own.selectExpr("node_id AS snode", "x AS sx", "y AS sy"), "snode", "left").join(own.selectExpr("node_id AS enode", "x AS dx", "y AS dy"), "enode", "left")
    rows = rows.where("sx IS NULL OR dx IS NULL")
    lines = rows.select("road_id", F.lit(1).alias("seq"), "x1", "y1", "x2", "y2").withColumns({"seg_m": distance(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2")), "s1": F.lit(0.0)})
    cut = line_zone_pieces(lines, zone_edges, ["road_id"]).join(lines.select("road_id", "seg_m", "x1", "y1", "x2", "y2"), "road_id")
    at = lambda a, b, s: F.col(a) + (F.col(b) - F.col(a)) * F.col(s) / F.col("seg_m")
    cut = cut.select("road_id", "start_s", "end_s", at("x1", "x2", "start_s").alias("x1"), at("y1", "y2", "start_s").alias("y1"), at("x1", "x2", "end_s").alias("x2"), at("y1", "y2", "end_s").alias("y2"))
    cut = cut.join(rows.select("road_id", "sx", "sy", "dx", "dy"), "road_id")
    best = choose_clipped_piece(cut, ["road_id"], snap)
    whole = rows.select("road_id", F.col("x1").alias("ox1"), F.col("y1").alias("oy1"), F.col("x2").alias("ox2"), F.col("y2").alias("oy2"), F.col("sx").isNull().alias("no_src"), F.col("dx").isNull().alias("no_dst"))
    out = whole.join(best, "road_id", "left")
    new_src = F.col("no_src") | (distance(F.col("ox1"), F.col("oy1"), F.col("x1"), F.col("y1")) > snap)
    new_dst = F.col("no_dst") | (distance(F.col("ox2"), F.col("oy2"), F.col("x2"), F.col("y2")) > snap)
    src = F.when(F.col("x1").isNotNull() & new_src, stable_node_id(F.col("road_id"), F.lit("src"), F.col("x1"), F.col("y1"), F.lit(0)))
    dst = F.when(F.col("x1").isNotNull() & new_dst, stable_node_id(F.col("road_id"), F.lit("dst"), F.col("x2"), F.col("y2"), F.lit(0)))
    reason = F.when(F.col("x1").isNull(), "clipped_empty").otherwise(F.col("reason"))
    return out.select("road_id", "x1", "y1", "x2", "y2", src.alias("new_snode"), dst.alias("new_enode"), reason.alias("reason"))


def endpoint_repair_lines(roads: DataFrame, lines: DataFrame, nodes: DataFrame, zone_edges: DataFrame, grow: float = 5.0, snap: float = 2.0) -> DataFrame:
    """endpoint_repair() for polylines: roads (road_id, snode, enode) of which an end has no node, with the segments of
    their lines (zones.segments), clipped to the zones grown by `grow`. Gives (road_id, snode, enode, new_src, new_dst, start_s,
    end_s, sx, sy, dx, dy, reason, outside_ratio): the ids to write, which of them are new, the stretch of the line that stays
    (its vertices: evidence.cut_lines), where it starts and ends, seen from source to destination, and which share of it lies
    outside the zones themselves. A line's sides are told by its nodes (endpoint_assign); an end that
    has moved over `snap` gets a new node as well. Roads that no zone holds keep their ids and have the reason 'clipped_empty'."""
    from .evidence import cut_lines
    from .network import cut
    from .zones import grown_zone_pieces

    c, spot = F.col, lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    own = nodes.select("node_id", "x", "y").dropDuplicates(["node_id"])
    rows = roads.select("road_id", "snode", "enode").join(own.selectExpr("node_id AS snode", "x AS sx", "y AS sy"), "snode", "left").join(own.selectExpr("node_id AS enode", "x AS dx", "y AS dy"), "enode", "left")
    rows = cut(rows.where("sx IS NULL OR dx IS NULL"))
    own_lines = cut(lines.join(rows.select("road_id"), "road_id", "left_semi"))
    ends = own_lines.groupBy("road_id").agg(F.min_by(spot("x1", "y1"), "seq").alias("p"), F.max_by(spot("x2", "y2"), "seq").alias("q"))
    sides = endpoint_assign(rows.join(ends, "road_id").withColumns({"x1": c("p.x"), "y1": c("p.y"), "x2": c("q.x"), "y2": c("q.y")}))
    side = lambda a, b: F.when(c("flip"), c(b)).otherwise(c(a))
    sides = sides.select("road_id", *[side(a, b).alias(n) for a, b, n in (("x1", "x2", "osx"), ("y1", "y2", "osy"), ("x2", "x1", "odx"), ("y2", "y1", "ody"))])
    pieces = cut(grown_zone_pieces(own_lines, zone_edges, ["road_id"], grow))
    shape = cut_lines(own_lines, pieces.select("road_id", c("piece").alias("ord"), c("start_s").alias("from_s"), c("end_s").alias("to_s")), ["road_id"])
    shape = shape.groupBy("road_id", c("ord").alias("piece")).agg(F.min_by(spot("x", "y"), "i").alias("p"), F.max_by(spot("x", "y"), "i").alias("q"))
    cand = pieces.join(shape, ["road_id", "piece"]).join(rows, "road_id").withColumns({"x1": c("p.x"), "y1": c("p.y"), "x2": c("q.x"), "y2": c("q.y")})
    best = choose_clipped_piece(cand, ["road_id"], snap).select("road_id", "start_s", "end_s", "x1", "y1", "x2", "y2", "reason")
    inside = line_zone_pieces(own_lines, zone_edges, ["road_id"], union=True).select("road_id", c("start_s").alias("a"), c("end_s").alias("b"))
    held = best.join(inside, "road_id").groupBy("road_id").agg(F.sum(F.greatest(F.lit(0.0), F.least("end_s", "b") - F.greatest("start_s", "a"))).alias("held"))
    out = rows.join(sides, "road_id", "left").join(best, "road_id", "left").join(held, "road_id", "left")
    out = out.withColumns({"rsx": F.coalesce("sx", "osx"), "rsy": F.coalesce("sy", "osy"), "rdx": F.coalesce("dx", "odx"), "rdy": F.coalesce("dy", "ody")})
    d = lambda a, n: distance(c(f"{a}x"), c(f"{a}y"), c(f"x{n}"), c(f"y{n}"))
    out = out.withColumn("flip", d("rs", 1) + d("rd", 2) > d("rs", 2) + d("rd", 1))
    out = out.withColumns({"no_src": c("sx").isNull(), "no_dst": c("dx").isNull()}).withColumns({"sx": side("x1", "x2"), "sy": side("y1", "y2"), "dx": side("x2", "x1"), "dy": side("y2", "y1")})
    kept = c("start_s").isNotNull()
    new_src, new_dst = kept & (c("no_src") | (distance(c("osx"), c("osy"), c("sx"), c("sy")) > snap)), kept & (c("no_dst") | (distance(c("odx"), c("ody"), c("dx"), c("dy")) > snap))
    fresh = lambda s: stable_node_id(c("road_id"), F.lit(f"{s}"), c(f"{s[0]}x"), c(f"{s[0]}y"), F.lit(0))
    return out.select(
        "road_id", F.when(new_src, fresh("src")).otherwise(c("snode")).alias("snode"), F.when(new_dst, fresh("dst")).otherwise(c("enode")).alias("enode"), new_src.alias("new_src"), new_dst.alias("new_dst"), "start_s", "end_s",
        F.when(kept, c("sx")).alias("sx"), F.when(kept, c("sy")).alias("sy"), F.when(kept, c("dx")).alias("dx"), F.when(kept, c("dy")).alias("dy"), F.when(kept, c("reason")).otherwise("clipped_empty").alias("reason"),
        F.when(kept, 1 - F.coalesce("held", F.lit(0.0)) / (c("end_s") - c("start_s"))).alias("outside_ratio"),
    )


def node_alias_resolve(nodes: DataFrame, roads: DataFrame, order: tuple[str, ...] = ("mainid", "mainnodeid", "id", "nodeid")) -> DataFrame:
    """Canonical id of each node row (row_id, id_fields map): the first of its ids, in a
    fixed order, that a road ends at, else the first it has; and the first row of each
    canonical id."""
    ends = roads.select(F.col("snode").alias("value")).union(roads.select("enode")).distinct().withColumn("used", F.lit(True))
    ids = F.explode(F.array(*[F.struct(F.lit(i).alias("place"), F.try_element_at("id_fields", F.lit(n)).alias("value")) for i, n in enumerate(order)]))
    rows = nodes.select("row_id", ids.alias("f")).select("row_id", "f.place", "f.value").where("value IS NOT NULL").join(ends, "value", "left")
    best = F.min_by("value", F.struct(F.col("used").isNull(), F.col("place"))).alias("node_id")
    got = rows.groupBy("row_id").agg(best)
    return got.withColumn("kept", F.row_number().over(Window.partitionBy("node_id").orderBy("row_id")) == 1)


def next_intersection_distance(roads: DataFrame, nodes: DataFrame, starts: DataFrame, kinds: int, hops: int = 64) -> DataFrame:
    """From each first road of a start node along the best aligned next road (ties:
    longer, then smaller id) to a node of degree 3 or more with one of the kinds:
    (node_id, road_id, dist_m, dst), dst NULL where the walk ends elsewhere. roads have
    snode, enode, length_m; nodes x, y, kind. A walk ends where the best road turns by
    more than its cosine -0.25 allows."""
    from .network import cut, ends, node_degree

    place = nodes.select("node_id", "x", "y", "kind").dropDuplicates(["node_id"])
    far = F.when(F.col("at_end"), F.col("snode")).otherwise(F.col("enode"))
    step = ends(roads).select("node_id", "road_id", far.alias("to"), "length_m").where("node_id <> to")
    step = step.join(place.select("node_id", F.col("x").alias("ax"), F.col("y").alias("ay")), "node_id").join(place.select(F.col("node_id").alias("to"), F.col("x").alias("bx"), F.col("y").alias("by")), "to")
    size = distance(F.col("ax"), F.col("ay"), F.col("bx"), F.col("by"))
    step = cut(step.withColumn("n", size).where("n > 0").select("node_id", "road_id", "to", "length_m", ((F.col("bx") - F.col("ax")) / F.col("n")).alias("ux"), ((F.col("by") - F.col("ay")) / F.col("n")).alias("uy")))
    goal = node_degree(roads).where("degree >= 3").join(place.where(F.col("kind").bitwiseAND(F.lit(kinds)) != 0), "node_id", "left_semi").select(F.col("node_id").alias("at"), F.lit(True).alias("goal"))
    goal = cut(goal)
    walk = step.join(starts.select("node_id").distinct(), "node_id").select("node_id", "road_id", F.col("node_id").alias("prev"), F.col("to").alias("at"), F.col("road_id").alias("via"), F.col("length_m").alias("dist_m"), "ux", "uy")
    done = []
    for _ in range(hops):
        rows = cut(walk.join(goal, "at", "left"))
        back = F.col("at") == F.col("node_id")
        done.append(rows.where(F.col("goal") & ~back).select("node_id", "road_id", "dist_m", F.col("at").alias("dst")))
        going = rows.where(F.col("goal").isNull() | back)
        nxt = step.selectExpr("node_id AS at", "road_id AS r2", "to AS to2", "length_m AS m2", "ux AS ux2", "uy AS uy2")
        fan = going.join(nxt, "at").where("r2 <> via AND to2 <> prev").withColumn("align", F.round(F.col("ux") * F.col("ux2") + F.col("uy") * F.col("uy2"), 9))
        w = Window.partitionBy("node_id", "road_id").orderBy(F.desc("align"), F.desc("m2"), "r2")
        pick = fan.withColumn("_k", F.row_number().over(w)).where("_k = 1")
        ended = going.join(pick.where("align >= -0.25").select("node_id", "road_id"), ["node_id", "road_id"], "left_anti")
        done.append(ended.select("node_id", "road_id", F.lit(None).cast("double").alias("dist_m"), F.lit(None).cast("long").alias("dst")))
        walk = cut(pick.where("align >= -0.25").select("node_id", "road_id", F.col("at").alias("prev"), F.col("to2").alias("at"), F.col("r2").alias("via"), (F.col("dist_m") + F.col("m2")).alias("dist_m"), F.col("ux2").alias("ux"), F.col("uy2").alias("uy")))
        if not walk.limit(1).count():
            break
    else:
        done.append(walk.select("node_id", "road_id", F.lit(None).cast("double").alias("dist_m"), F.lit(None).cast("long").alias("dst")))
    out = done[0]
    for f in done[1:]:
        out = out.union(f)
    return out
