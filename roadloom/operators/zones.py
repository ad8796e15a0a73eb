"""Lines against zones and cross-sections, as joins over edge tables.

A zone is its edge rows (poly_id, x1, y1, x2, y2, and patch_id if there is one); a line is
its vertices in order. All meet in grid cells before boxes and exact tests. Shared corners count once: an edge holds its
lower end but not its upper one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def segments(vertices: DataFrame, by: list[str], order: str = "seq") -> DataFrame:
    """Edges of lines: x1, y1, x2, y2, station of the start (s1) and length."""
    w = Window.partitionBy(*by).orderBy(order)
    rows = vertices.select(*by, F.col(order).alias("seq"), F.col("x").alias("x1"), F.col("y").alias("y1"), F.lead("x").over(w).alias("x2"), F.lead("y").over(w).alias("y2"))
    rows = rows.where("x2 IS NOT NULL").withColumn("seg_m", F.sqrt((F.col("x2") - F.col("x1")) ** 2 + (F.col("y2") - F.col("y1")) ** 2))
    before = Window.partitionBy(*by).orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("s1", F.coalesce(F.sum("seg_m").over(before), F.lit(0.0)))


def polyline_measure(vertices: DataFrame, by: list[str], order: str = "seq") -> DataFrame:
    """Per line: number of distinct consecutive vertices, length, box and ends."""
    w = Window.partitionBy(*by).orderBy(order)
    same = (F.lag("x").over(w) == F.col("x")) & (F.lag("y").over(w) == F.col("y"))
    rows = vertices.withColumn("_same", F.coalesce(same, F.lit(False))).where("NOT _same")
    d = F.sqrt((F.col("x") - F.lag("x").over(w)) ** 2 + (F.col("y") - F.lag("y").over(w)) ** 2)
    ends = [F.min_by(c, order).alias(f"{c}_start") for c in "xy"] + [F.max_by(c, order).alias(f"{c}_end") for c in "xy"]
    return rows.withColumn("_d", d).groupBy(*by).agg(F.count("*").alias("n"), F.coalesce(F.sum("_d"), F.lit(0.0)).alias("length_m"), *ends)


def polyline_vertices(lines: DataFrame, by: list[str]) -> DataFrame:
    """(by..., i, x, y): the vertices of lines (from segments()) in order, i being the segment's seq or one more."""
    last = lines.groupBy(*by).agg(F.max_by(F.struct("seq", "x2", "y2"), "seq").alias("e"))
    ends = last.select(*by, (F.col("e.seq") + 1).alias("i"), F.col("e.x2").alias("x"), F.col("e.y2").alias("y"))
    return lines.select(*by, F.col("seq").alias("i"), F.col("x1").alias("x"), F.col("y1").alias("y")).union(ends)


#: Side of the cells in which lines, polygons and their edges meet.
CELL = 50.0


def _shared(a: DataFrame, b: DataFrame) -> list[str]:
    """patch_id, if both sides have it."""
    return ["patch_id"] if "patch_id" in a.columns and "patch_id" in b.columns else []


def in_cells(rows: DataFrame, x1: str, y1: str, x2: str, y2: str, tag: str, size: float = CELL) -> DataFrame:
    """One row for each cell (cx, cy) that a row's box overlaps, with the box's first cell
    as {tag}x, {tag}y: of the cells that two boxes share, the one at the greater of their
    first cells stands for the pair, so a join over cells gives each pair once."""
    at = lambda c: F.floor(c / size).cast("long")
    low_x, high_x, low_y, high_y = at(F.least(x1, x2)), at(F.greatest(x1, x2)), at(F.least(y1, y2)), at(F.greatest(y1, y2))
    rows = rows.withColumns({f"{tag}x": low_x, f"{tag}y": low_y, "_hx": high_x, "_hy": high_y})
    rows = rows.withColumn("cx", F.explode(F.sequence(f"{tag}x", "_hx"))).withColumn("cy", F.explode(F.sequence(f"{tag}y", "_hy")))
    return rows.drop("_hx", "_hy")


def _once(a: str, b: str) -> Column:
    return (F.col("cx") == F.greatest(f"{a}x", f"{b}x")) & (F.col("cy") == F.greatest(f"{a}y", f"{b}y"))


def _boxes(edges: DataFrame, key: list[str]) -> DataFrame:
    return edges.groupBy(*key, "poly_id").agg(F.min(F.least("x1", "x2")).alias("bx1"), F.max(F.greatest("x1", "x2")).alias("bx2"), F.min(F.least("y1", "y2")).alias("by1"), F.max(F.greatest("y1", "y2")).alias("by2"))


def point_in_zone(points: DataFrame, edges: DataFrame, key: list[str]) -> DataFrame:
    """(key..., x, y, poly_id) of each distinct point inside a polygon, by ray casting.
    Points meet polygons in the cells of their boxes (of their patch, if both have one), and
    then only the edges of those polygons in the 5 m strip at their height."""
    strip, patch = 5.0, _shared(points, edges)
    pts = points.select(*dict.fromkeys([*patch, *key]), "x", "y").distinct().withColumns({"cx": F.floor(F.col("x") / CELL).cast("long"), "cy": F.floor(F.col("y") / CELL).cast("long")})
    boxes = in_cells(_boxes(edges, patch), "bx1", "by1", "bx2", "by2", "b")
    near = pts.join(boxes, [*patch, "cx", "cy"]).where("x >= bx1 AND x <= bx2 AND y >= by1 AND y <= by2")
    near = near.select(*dict.fromkeys([*patch, *key]), "x", "y", "poly_id").withColumn("strip", F.floor(F.col("y") / strip))
    rows = edges.withColumns({"ylo": F.least("y1", "y2"), "yhi": F.greatest("y1", "y2")}).where("ylo < yhi")
    rows = rows.select(*patch, "poly_id", "x1", "y1", "x2", "y2", "ylo", "yhi", F.explode(F.sequence(F.floor(F.col("ylo") / strip), F.floor(F.col("yhi") / strip))).alias("strip"))
    hit = near.join(rows, [*patch, "poly_id", "strip"]).where("y >= ylo AND y < yhi")
    x_at = F.col("x1") + (F.col("y") - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))
    crossings = hit.groupBy(*key, "x", "y", "poly_id").agg(F.sum((F.col("x") < x_at).cast("int")).alias("n"))
    return crossings.where("n % 2 = 1").drop("n")


def line_zone_pieces(lines: DataFrame, edges: DataFrame, by: list[str], least_m: float = 0.0, union: bool = False) -> DataFrame:
    """Inside pieces of lines (from segments()): (by..., poly_id, piece, start_s, end_s), or
    with `union` those inside any polygon, without poly_id: polygons that touch or overlap are one zone then.
    Each segment is cut at its crossings with the polygon's edges; sub-intervals whose
    middle is inside are kept and touching ones are merged. Segments meet polygons, and then
    their edges, in cells (of their patch, if both have one)."""
    patch = _shared(lines, edges)
    own = [*dict.fromkeys([*patch, *by])]
    given = lines.where("seg_m > 0").select(*own, "seq", "x1", "y1", "x2", "y2", "s1", "seg_m")
    placed = in_cells(given, "x1", "y1", "x2", "y2", "l")
    boxes = in_cells(_boxes(edges, patch), "bx1", "by1", "bx2", "by2", "b")
    touch = (F.least("x1", "x2") <= F.col("bx2")) & (F.greatest("x1", "x2") >= F.col("bx1")) & (F.least("y1", "y2") <= F.col("by2")) & (F.greatest("y1", "y2") >= F.col("by1"))
    near = placed.join(boxes, [*patch, "cx", "cy"]).where(touch & _once("l", "b")).select(*own, "seq", "x1", "y1", "x2", "y2", "s1", "seg_m", "poly_id")
    e = edges.select(*patch, "poly_id", *[F.col(c).alias(f"e{c}") for c in ("x1", "y1", "x2", "y2")])
    dx, dy, ex, ey = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"), F.col("ex2") - F.col("ex1"), F.col("ey2") - F.col("ey1")
    cross = dx * ey - dy * ex
    t = ((F.col("ex1") - F.col("x1")) * ey - (F.col("ey1") - F.col("y1")) * ex) / cross
    u = ((F.col("ex1") - F.col("x1")) * dy - (F.col("ey1") - F.col("y1")) * dx) / cross
    key = [*own, "seq", "poly_id"]
    meet = in_cells(near, "x1", "y1", "x2", "y2", "l").join(in_cells(e, "ex1", "ey1", "ex2", "ey2", "e"), [*patch, "poly_id", "cx", "cy"]).where(_once("l", "e"))
    cuts = meet.where(F.abs(cross) > 1e-12).select(*key, t.alias("t"), u.alias("u")).where("t > 0 AND t < 1 AND u >= 0 AND u <= 1").select(*key, "t")
    cuts = cuts.union(near.select(*key, F.lit(0.0).alias("t"))).union(near.select(*key, F.lit(1.0).alias("t"))).distinct()
    w = Window.partitionBy(*key).orderBy("t")
    parts = cuts.withColumn("t2", F.lead("t").over(w)).where("t2 IS NOT NULL").join(near, key)
    mid, strip = (F.col("t") + F.col("t2")) / 2, 5.0
    parts = parts.withColumns({"mx": F.col("x1") + mid * dx, "my": F.col("y1") + mid * dy}).withColumn("strip", F.floor(F.col("my") / strip))
    spans = e.where("ey1 <> ey2").withColumns({"ylo": F.least("ey1", "ey2"), "yhi": F.greatest("ey1", "ey2")})
    spans = spans.withColumn("strip", F.explode(F.sequence(F.floor(F.col("ylo") / strip), F.floor(F.col("yhi") / strip))))
    x_at = F.col("ex1") + (F.col("my") - F.col("ey1")) * ex / ey
    inside = (
        parts.join(spans, [*patch, "poly_id", "strip"]).where("my >= ylo AND my < yhi").groupBy(*key, "t", "t2", "s1", "seg_m").agg(F.sum((F.col("mx") < x_at).cast("int")).alias("n")).where("n % 2 = 1")
        .select(*by, "poly_id", (F.col("s1") + F.col("t") * F.col("seg_m")).alias("a"), (F.col("s1") + F.col("t2") * F.col("seg_m")).alias("b"))
    )
    owner = by if union else [*by, "poly_id"]
    order = Window.partitionBy(*owner).orderBy("a", "b")
    reach = F.max("b").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.coalesce(F.col("a") > reach + 1e-9, F.lit(True)).cast("int")
    runs = inside.withColumn("_n", new).withColumn("run", F.sum("_n").over(order))
    pieces = runs.groupBy(*owner, "run").agg(F.min("a").alias("start_s"), F.max("b").alias("end_s")).where(F.col("end_s") - F.col("start_s") >= least_m)
    return pieces.withColumn("piece", F.row_number().over(Window.partitionBy(*owner).orderBy("start_s"))).drop("run")


def near_edge_spans(lines: DataFrame, edges: DataFrame, by: list[str], reach: float) -> DataFrame:
    """(by..., a, b): stretches of lines (from segments()) within `reach` of an edge, one for each segment and edge. What lies
    within `reach` of an edge is a rectangle with a disc at either end, which is convex, so a segment is in it for
    one stretch: from the first to the last of its stretches in the three. Segments and edges meet in cells (of their patch, if both have one)."""
    patch = _shared(lines, edges)
    own = [*dict.fromkeys([*patch, *by])]
    given = lines.where("seg_m > 0").select(*own, "seq", "x1", "y1", "x2", "y2", "s1", "seg_m")
    e = edges.select(*patch, *[F.col(c).alias(f"e{c}") for c in ("x1", "y1", "x2", "y2")])
    e = e.withColumns({"_a": F.least("ex1", "ex2") - reach, "_b": F.least("ey1", "ey2") - reach, "_c": F.greatest("ex1", "ex2") + reach, "_d": F.greatest("ey1", "ey2") + reach})
    rows = in_cells(given, "x1", "y1", "x2", "y2", "l").join(in_cells(e, "_a", "_b", "_c", "_d", "e"), [*patch, "cx", "cy"]).where(_once("l", "e"))
    size = F.sqrt((F.col("ex2") - F.col("ex1")) ** 2 + (F.col("ey2") - F.col("ey1")) ** 2)
    rows = rows.withColumn("el", size).withColumns({"ux": F.when(F.col("el") > 0, (F.col("ex2") - F.col("ex1")) / F.col("el")).otherwise(1.0), "uy": F.when(F.col("el") > 0, (F.col("ey2") - F.col("ey1")) / F.col("el")).otherwise(0.0)})
    # Along and across the edge, from its first end: place + t * step for t from 0 to 1.
    dx, dy, px, py = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"), F.col("x1") - F.col("ex1"), F.col("y1") - F.col("ey1")
    rows = rows.withColumns({"p0": px * F.col("ux") + py * F.col("uy"), "p1": dx * F.col("ux") + dy * F.col("uy"), "q0": py * F.col("ux") - px * F.col("uy"), "q1": dy * F.col("ux") - dx * F.col("uy")})

    def slab(k0, k1, low, high):
        u, w = (low - k0) / k1, (high - k0) / k1
        flat, out = F.abs(k1) < 1e-12, (k0 < low) | (k0 > high)
        return F.when(flat, F.when(out, 2.0).otherwise(0.0)).otherwise(F.least(u, w)), F.when(flat, F.when(out, -1.0).otherwise(1.0)).otherwise(F.greatest(u, w))

    (a0, a1), (c0, c1) = slab(F.col("p0"), F.col("p1"), F.lit(0.0), F.col("el")), slab(F.col("q0"), F.col("q1"), F.lit(-reach), F.lit(reach))
    found = [(F.greatest(a0, c0, F.lit(0.0)), F.least(a1, c1, F.lit(1.0)))]
    for at in (F.lit(0.0), F.col("el")):
        along, q = F.col("p0") - at, F.col("p1") ** 2 + F.col("q1") ** 2
        half = along * F.col("p1") + F.col("q0") * F.col("q1")
        root = half * half - q * (along * along + F.col("q0") ** 2 - reach * reach)
        root = F.when(root > 0, F.sqrt(root))
        found.append((F.greatest((-half - root) / q, F.lit(0.0)), F.least((-half + root) / q, F.lit(1.0)) + root * 0))
    met = F.filter(F.array(*[F.struct(lo.alias("lo"), hi.alias("hi")) for lo, hi in found]), lambda m: m.hi > m.lo)
    rows = rows.withColumn("met", met).where(F.size("met") > 0)
    rows = rows.withColumns({"t0": F.array_min(F.transform("met", lambda m: m.lo)), "t1": F.array_max(F.transform("met", lambda m: m.hi))})
    return rows.select(*by, (F.col("s1") + F.col("t0") * F.col("seg_m")).alias("a"), (F.col("s1") + F.col("t1") * F.col("seg_m")).alias("b"))


def grown_zone_pieces(lines: DataFrame, edges: DataFrame, by: list[str], grow: float) -> DataFrame:
    """(by..., piece, start_s, end_s): the stretches of lines in the zones grown by `grow`: inside any of them or within
    that distance of an edge."""
    inside = line_zone_pieces(lines, edges, by, union=True).select(*by, F.col("start_s").alias("a"), F.col("end_s").alias("b"))
    spans = inside.union(near_edge_spans(lines, edges, by, grow)).where("b > a + 1e-9")
    w = Window.partitionBy(*by).orderBy("a", "b")
    reach = F.max("b").over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = F.coalesce(F.col("a") > reach + 1e-6, F.lit(True)).cast("int")
    runs = spans.withColumn("_n", new).withColumn("_run", F.sum("_n").over(w))
    got = runs.groupBy(*by, "_run").agg(F.min("a").alias("start_s"), F.max("b").alias("end_s"))
    return got.select(*by, F.col("_run").cast("int").alias("piece"), "start_s", "end_s")


def line_zone_ratio(lines: DataFrame, edges: DataFrame, by: list[str]) -> DataFrame:
    """Share of each line's length inside each polygon that it touches."""
    total = lines.groupBy(*by).agg(F.sum("seg_m").alias("length_m"))
    inside = line_zone_pieces(lines, edges, by).groupBy(*by, "poly_id").agg(F.sum(F.col("end_s") - F.col("start_s")).alias("inside_m"))
    return inside.join(total, by).withColumn("ratio", F.when(F.col("length_m") > 0, F.col("inside_m") / F.col("length_m")).otherwise(0.0))


def zone_relation(ratio: Column, tolerance: float = 1e-6) -> Column:
    return F.when(ratio >= 1 - tolerance, "inside").when(F.coalesce(ratio, F.lit(0.0)) <= tolerance, "outside").otherwise("boundary_intersection")


def _slanted(xsecs: DataFrame) -> DataFrame:
    """Cross-sections as x1, y1, x2, y2; upright ones may come as x, y1, y2."""
    return xsecs if "x1" in xsecs.columns else xsecs.withColumns({"x1": F.col("x"), "x2": F.col("x")})


def crossing_events(lines: DataFrame, xsecs: DataFrame, by: list[str]) -> DataFrame:
    """Crossings of line segments with cross-sections (node_id, x1, y1, x2, y2, at any
    slant, or upright as node_id, x, y1, y2): one row per line and node, the best by distance to the cross-section's middle,
    station and seq. A segment holds its start but not its end; both meet in cells (of
    their patch, if both have one)."""
    patch = _shared(lines, xsecs)
    own = _slanted(xsecs).select(*patch, "node_id", *[F.col(c).alias(f"c{c}") for c in ("x1", "y1", "x2", "y2")])
    rows = in_cells(lines.where("seg_m > 0"), "x1", "y1", "x2", "y2", "l")
    hit = rows.join(in_cells(own, "cx1", "cy1", "cx2", "cy2", "c"), [*patch, "cx", "cy"]).where(_once("l", "c"))
    dx, dy, ex, ey = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"), F.col("cx2") - F.col("cx1"), F.col("cy2") - F.col("cy1")
    cross = dx * ey - dy * ex
    f = ((F.col("cx1") - F.col("x1")) * ey - (F.col("cy1") - F.col("y1")) * ex) / cross
    g = ((F.col("cx1") - F.col("x1")) * dy - (F.col("cy1") - F.col("y1")) * dx) / cross
    hit = hit.where(cross != 0).withColumns({"f": f, "g": g}).where("f >= 0 AND f < 1 AND g >= 0 AND g <= 1")
    place = {"x": F.col("x1") + F.col("f") * dx, "y": F.col("y1") + F.col("f") * dy, "seq_at": F.col("seq") + F.col("f"), "station": F.col("s1") + F.col("f") * F.col("seg_m")}
    hit = hit.withColumns(place).withColumn("off", F.abs(F.col("g") - 0.5) * F.sqrt(ex**2 + ey**2))
    best = F.row_number().over(Window.partitionBy(*by, "node_id").orderBy(F.round("off", 9), "station", "seq_at"))
    return hit.withColumn("r", best).where("r = 1").select(*by, "node_id", "x", "y", "seq_at", "station", "off")


def event_sequence(events: DataFrame, by: list[str]) -> DataFrame:
    """Crossings in order, with the nodes before and after."""
    w = Window.partitionBy(*by).orderBy("seq_at", "node_id")
    return events.withColumns({"ord": F.row_number().over(w), "prev_node": F.lag("node_id").over(w), "next_node": F.lead("node_id").over(w)})


def traj_pair_candidates(events: DataFrame, by: list[str]) -> DataFrame:
    """Adjacent crossings of different nodes as (src, dst) with their seq range."""
    w = Window.partitionBy(*by).orderBy("seq_at", "node_id")
    rows = events.withColumns({"dst": F.lead("node_id").over(w), "seq_to": F.lead("seq_at").over(w)})
    return rows.where("dst IS NOT NULL AND dst <> node_id").select(*by, F.col("node_id").alias("src"), "dst", F.col("seq_at").alias("seq_from"), "seq_to")


def traj_pair_all(events: DataFrame, by: list[str]) -> DataFrame:
    """All ordered pairs of a line's crossings (by..., src, dst, seq_from, seq_to, index_gap, mode, inner): how many crossings
    apart, 'adjacent' or 'skip_pair', and the distinct nodes between them other than both ends,
    ascending. Pairs of one node are left out. The pairs of a line with n crossings are n * (n - 1) / 2."""
    line = events.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("seq_at", "node_id"))).alias("e"))
    rows = line.select(*by, "e", F.posexplode("e").alias("i", "a")).select(*by, "e", "i", "a", F.explode(F.slice(F.transform("e", lambda x, j: F.struct(j.alias("j"), x.alias("b"))), F.col("i") + 2, F.size("e"))).alias("p"))
    rows = rows.withColumns({"src": F.col("a.node_id"), "dst": F.col("p.b.node_id"), "index_gap": F.col("p.j") - F.col("i")}).where("src <> dst")
    between = F.transform(F.slice("e", F.col("i") + 2, F.col("index_gap") - 1), lambda x: x.node_id)
    inner = F.array_sort(F.array_except(between, F.array("src", "dst")))
    mode = F.when(F.col("index_gap") == 1, "adjacent").otherwise("skip_pair")
    return rows.select(*by, "src", "dst", F.col("a.seq_at").alias("seq_from"), F.col("p.b.seq_at").alias("seq_to"), "index_gap", mode.alias("mode"), inner.alias("inner"))


def pair_support(pairs: DataFrame) -> DataFrame:
    """Per (src, dst): supporting trajectories, crossings and a representative."""
    return pairs.groupBy("src", "dst").agg(
        F.count_distinct("traj_id").alias("n_traj"), F.count("*").alias("n_events"), F.min("traj_id").alias("first_traj"), F.avg(F.col("seq_to") - F.col("seq_from")).alias("mean_gap")
    )


def line_project(points: DataFrame, lines: DataFrame, line_key: list[str], key: list[str], reach: float) -> DataFrame:
    """Nearest place of each point on each line at most `reach` away: station and
    distance. Segments are entered in every cell that they may be reached from."""
    size = max(reach, 5.0)
    cells = lambda lo, hi: F.sequence(F.floor((lo - reach) / size).cast("int"), F.floor((hi + reach) / size).cast("int"))
    seg = lines.withColumn("cx", F.explode(cells(F.least("x1", "x2"), F.greatest("x1", "x2")))).withColumn("cy", F.explode(cells(F.least("y1", "y2"), F.greatest("y1", "y2"))))
    pts = points.select("patch_id", *key, F.col("x").alias("px"), F.col("y").alias("py")).withColumns({"cx": F.floor(F.col("px") / size).cast("int"), "cy": F.floor(F.col("py") / size).cast("int")})
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((F.col("px") - F.col("x1")) * dx + (F.col("py") - F.col("y1")) * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0))))
    rows = pts.join(seg, ["patch_id", "cx", "cy"]).withColumn("t", F.coalesce(t, F.lit(0.0)))
    rows = rows.withColumn("dist", F.sqrt((F.col("px") - F.col("x1") - F.col("t") * dx) ** 2 + (F.col("py") - F.col("y1") - F.col("t") * dy) ** 2)).where(F.col("dist") <= reach)
    best = F.min(F.struct("dist", (F.col("s1") + F.col("t") * F.col("seg_m")).alias("station"))).alias("b")
    return rows.groupBy("patch_id", *key, *line_key).agg(best).select("patch_id", *key, *line_key, "b.dist", "b.station")


def polyline_densify(lines: DataFrame, by: list[str], step: float) -> DataFrame:
    """Lines (from segments()) at every `step` metres: station, place, unit tangent and
    normal. A segment gives the stations that it holds, so each is made where it lies."""
    first, last = F.ceil(F.col("s1") / step), F.ceil((F.col("s1") + F.col("seg_m")) / step) - 1
    rows = lines.where("seg_m > 0").withColumns({"_a": first.cast("int"), "_b": last.cast("int")}).where("_a <= _b")
    rows = rows.withColumn("k", F.explode(F.sequence("_a", "_b"))).withColumn("s", F.col("k") * step)
    f = (F.col("s") - F.col("s1")) / F.col("seg_m")
    tx, ty = (F.col("x2") - F.col("x1")) / F.col("seg_m"), (F.col("y2") - F.col("y1")) / F.col("seg_m")
    return rows.select(*by, "k", "s", (F.col("x1") + f * (F.col("x2") - F.col("x1"))).alias("x"), (F.col("y1") + f * (F.col("y2") - F.col("y1"))).alias("y"), tx.alias("tx"), ty.alias("ty"), (-ty).alias("nx"), tx.alias("ny"))


def crossing_events_by_vertex(vertices: DataFrame, xsecs: DataFrame, by: list[str], reach: float = 2.0, buffer: float = 0.0) -> DataFrame:
    """Crossings by the vertices within `reach` of a cross-section (node_id, x1, y1, x2, y2):
    the mean of their indices. A line without any such vertex at a cross-section is
    looked for within `buffer`, if that is wider. Crossings within two indices of the one
    before are dropped; in order, with the nodes before and after."""
    wide, patch = max(reach, buffer), _shared(vertices, xsecs)
    own = _slanted(xsecs).select(*patch, "node_id", *[F.col(c).alias(f"c{c}") for c in ("x1", "y1", "x2", "y2")])
    grown = own.withColumns({"_a": F.least("cx1", "cx2") - wide, "_b": F.least("cy1", "cy2") - wide, "_c": F.greatest("cx1", "cx2") + wide, "_d": F.greatest("cy1", "cy2") + wide})
    spots = vertices.withColumns({"cx": F.floor(F.col("x") / CELL).cast("long"), "cy": F.floor(F.col("y") / CELL).cast("long")})
    rows = spots.join(in_cells(grown, "_a", "_b", "_c", "_d", "c"), [*patch, "cx", "cy"])
    ex, ey = F.col("cx2") - F.col("cx1"), F.col("cy2") - F.col("cy1")
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((F.col("x") - F.col("cx1")) * ex + (F.col("y") - F.col("cy1")) * ey) / (ex**2 + ey**2)))
    d2 = F.round((F.col("x") - F.col("cx1") - t * ex) ** 2 + (F.col("y") - F.col("cy1") - t * ey) ** 2, 9)
    near = rows.withColumn("d2", d2).where(F.col("d2") <= wide * wide)
    close = F.col("d2") <= reach * reach
    hits = near.groupBy(*by, "node_id").agg(F.coalesce(F.avg(F.when(close, F.col("seq"))), F.avg("seq")).alias("ix"))
    w = Window.partitionBy(*by).orderBy("ix", "node_id")
    kept = hits.withColumn("_d", F.col("ix") - F.lag("ix").over(w)).where("_d IS NULL OR _d > 2").drop("_d")
    return kept.withColumns({"ord": F.row_number().over(w), "from_node": F.lag("node_id").over(w), "to_node": F.lead("node_id").over(w)})


def road_validity(ratios: DataFrame, relaxed: Column) -> DataFrame:
    """Why a road can't stay: it crosses a divider or leaves the zone; the floor of the
    inside ratio is lower where `relaxed` holds. ratios: ratio, crosses_divider."""
    floor = F.when(relaxed, 0.65).otherwise(0.85)
    reason = F.when(F.col("crosses_divider"), "road_crosses_divstrip").when(F.coalesce(F.col("ratio"), F.lit(0.0)) < floor, "road_outside_drivezone")
    return ratios.withColumn("reason", reason)


def arc_traj_prefilter(arcs: DataFrame, vertices: DataFrame, reach: float = 8.0) -> DataFrame:
    """(arc_id, traj_id) of trajectories with a vertex within `reach` of an arc, given by its
    segments (patch_id, arc_id, x1, y1, x2, y2, s1, seg_m)."""
    got = line_project(vertices, arcs, ["arc_id"], ["traj_id", "seq"], reach)
    return got.select("patch_id", "arc_id", "traj_id").distinct()
