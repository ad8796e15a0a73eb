"""Grid cells: ground models, road heights, layers and corridors.

`points` has patch_id, x, y, z (and cls); `traj` has patch_id, traj_id, seq, x, y, z.
Every operator works on all patches in one plan, keyed by patch_id and cell. Rows with
a NULL or NaN coordinate are dropped where coordinates are needed (finite_filter).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def finite(*cols: str) -> Column:
    out = F.lit(True)
    for c in cols:
        out = out & F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))
    return out


def finite_filter(rows: DataFrame, *cols: str) -> DataFrame:
    return rows.where(finite(*(cols or ("x", "y", "z"))))


def cell(rows: DataFrame, size: float, origin: tuple[float, float] = (0.0, 0.0)) -> DataFrame:
    """Adds ix, iy: the cell of a square grid that holds (x, y)."""
    return rows.withColumns(
        {
            "ix": F.floor((F.col("x") - origin[0]) / size).cast("long"),
            "iy": F.floor((F.col("y") - origin[1]) / size).cast("long"),
        }
    )


def packed_cell() -> Column:
    """ix in the upper and iy in the lower 32 bits of one integer."""
    return F.shiftleft("ix", 32).bitwiseOR(F.col("iy").bitwiseAND(F.lit(0xFFFFFFFF)))


def unpacked_cell(key: Column) -> tuple[Column, Column]:
    low = key.bitwiseAND(F.lit(0xFFFFFFFF))
    return F.shiftright(key, 32), F.when(low >= 1 << 31, low - (1 << 32)).otherwise(low)


def neighbours(rows: DataFrame, radius: int = 1, disk: bool = False) -> DataFrame:
    """One row for each cell at most `radius` cells away (in a disk or a square)."""
    steps = [(i, j) for i in range(-radius, radius + 1) for j in range(-radius, radius + 1) if not disk or i * i + j * j <= radius * radius]
    return (
        rows.withColumn("_n", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in steps])))
        .withColumns({"ix": F.col("ix") + F.col("_n.i"), "iy": F.col("iy") + F.col("_n.j")})
        .drop("_n")
    )


def _blend(low: Column, high: Column, f: Column) -> Column:
    """low (1 - f) + high f, rounded twice only: low (1 - f) is added to high f without being rounded itself (a fused
    multiplication and addition, as DuckDB's quantile_cont has it). The products of halves of 26 bits are exact."""

    def halves(x: Column) -> tuple[Column, Column]:
        top = x * 134217729.0 - (x * 134217729.0 - x)
        return top, x - top

    c, g = high * f, 1 - f
    p, (a1, a2), (g1, g2) = low * g, halves(low), halves(g)
    lost = ((a1 * g1 - p) + a1 * g2 + a2 * g1) + a2 * g2
    total = p + c
    back = total - p
    return total + (((p - (total - back)) + (c - back)) + lost)


def quantiles(rows: DataFrame, by: list[str], value: str, q: float, name: str) -> DataFrame:
    """(by..., name, n): the q-quantile of each group's values and their number. Equal values are counted first, so the counts
    and not the rows of a group are sorted."""
    w = Window.partitionBy(*by)
    counts = rows.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("_v")).agg(F.count("*").alias("_c"))
    counts = counts.withColumns({"_upto": F.sum("_c").over(w.orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)), "n": F.sum("_c").over(w)})
    at = (F.col("n") - 1) * F.lit(q)
    low, high = (F.min(F.when(F.col("_upto") > i, F.col("_v"))).alias(k) for k, i in (("_lo", F.floor(at)), ("_hi", F.ceil(at))))
    return counts.groupBy(*by, "n").agg(low, high).select(*by, _blend(F.col("_lo"), F.col("_hi"), at - F.floor(at)).alias(name), "n")


def dem_quantile(points: DataFrame, size: float = 5.0, q: float = 0.10, least: int = 8) -> DataFrame:
    """Ground height of a cell: the q-quantile of z where it has enough points."""
    return quantiles(cell(finite_filter(points), size), ["patch_id", "ix", "iy"], "z", q, "ground_z").where(F.col("n") >= least)


def dem_lookup_fallback(queries: DataFrame, points: DataFrame, size: float = 5.0, q: float = 0.10, least: int = 8, radius: int = 1) -> DataFrame:
    """`queries` with ground_z: of their own cell, else the quantile over all points of
    the cells around it, if there are enough."""
    dem = dem_quantile(points, size, q, least).drop("n")
    own = cell(queries, size).join(dem, ["patch_id", "ix", "iy"], "left")
    lost = own.where("ground_z IS NULL").select("patch_id", "ix", "iy").distinct()
    around = neighbours(lost.withColumns({"cx": F.col("ix"), "cy": F.col("iy")}), radius)
    pooled = (
        quantiles(around.join(cell(finite_filter(points), size).select("patch_id", "ix", "iy", "z"), ["patch_id", "ix", "iy"]), ["patch_id", "cx", "cy"], "z", q, "pooled_z")
        .where(F.col("n") >= least)
        .select("patch_id", F.col("cx").alias("ix"), F.col("cy").alias("iy"), "pooled_z")
    )
    out = own.join(pooled, ["patch_id", "ix", "iy"], "left")
    return out.withColumn("ground_z", F.coalesce("ground_z", "pooled_z")).drop("pooled_z", "ix", "iy")


def ground_classify_band(points: DataFrame, above: float = 0.08, below: float = 0.20, least_labelled: int = 1000, **dem) -> DataFrame:
    """Per patch: where the ground comes from and how many points are ground. Class 2
    counts if a patch has enough of it; else points in a band around the ground model (heights to the nanometre)."""
    points = finite_filter(points)
    labelled = points.groupBy("patch_id").agg((F.count_if(F.col("cls") == 2) >= least_labelled).alias("use_cls"))
    dz = dem_lookup_fallback(points, points, **dem).withColumn("dz", F.round(F.col("z") - F.col("ground_z"), 9))
    marked = dz.join(labelled, "patch_id")
    band = (F.col("dz") >= -below) & (F.col("dz") <= above)
    size = F.when(~F.col("use_cls"), F.abs("dz"))
    return marked.groupBy("patch_id").agg(
        F.when(F.bool_or("use_cls"), "las_classification").otherwise("dem_band").alias("ground_source"),
        F.count("*").alias("n_points"),
        F.count_if(F.when(F.col("use_cls"), F.col("cls") == 2).otherwise(band)).alias("ground_count"),
        *[F.percentile(size, F.lit(p)).alias(f"dz_p{round(100 * p)}") for p in (0.5, 0.9, 0.99)],
    )


def ground_label_cellmin(points: DataFrame, size: float = 1.0, above: float = 0.08) -> DataFrame:
    """Points with is_ground: not more than `above` over the lowest of their cell. The
    minima are aggregated first, so a crowded cell is never gathered."""
    rows = cell(finite_filter(points), size)
    low = rows.groupBy("patch_id", "ix", "iy").agg(F.min("z").alias("cell_min"))
    return rows.join(low, ["patch_id", "ix", "iy"]).withColumn("is_ground", F.col("z") <= F.col("cell_min") + above)


def ground_label_source(points: DataFrame, size: float = 1.0, above: float = 0.08, low: float = 0.005, high: float = 0.98) -> DataFrame:
    """Per patch: labels of class 2 if there are any, else the lowest of each cell; the
    ratio of ground points and whether it is plausible."""
    grid = ground_label_cellmin(points, size, above)
    own = grid.groupBy("patch_id").agg(F.count("*").alias("n"), F.count_if(F.col("cls") == 2).alias("labels"), F.count_if("is_ground").alias("grid"))
    ground = F.when(F.col("labels") > 0, F.col("labels")).otherwise(F.col("grid"))
    out = own.select("patch_id", F.when(F.col("labels") > 0, "existing").otherwise("grid").alias("label_source"), ground.alias("ground"), (ground / F.col("n")).alias("ratio"))
    reason = F.when(F.col("ground") == 0, "empty").when(F.col("ratio") < low, "ratio_low").when(F.col("ratio") > high, "ratio_high").otherwise("ok")
    return out.withColumn("reason", reason)


def corridor_cells(traj: DataFrame, size: float = 5.0, radius_m: float = 10.0) -> DataFrame:
    """Distinct cells within `radius_m` of a trajectory's cell, by cell distance."""
    own = cell(finite_filter(traj, "x", "y"), size).select("patch_id", "ix", "iy").distinct()
    return neighbours(own, int(-(-radius_m // size)), disk=True).distinct()


def corridor_semi_join(points: DataFrame, traj: DataFrame, size: float = 5.0, radius_m: float = 10.0) -> DataFrame:
    return cell(finite_filter(points), size).join(corridor_cells(traj, size, radius_m), ["patch_id", "ix", "iy"], "left_semi")


def cell_z_peaks(points: DataFrame, size: float = 5.0, bin_m: float = 0.2) -> DataFrame:
    """The two fullest height bins of each cell (of equally full ones the higher)."""
    rows = cell(finite_filter(points), size)
    low = rows.groupBy("patch_id", "ix", "iy").agg(F.min("z").alias("z0"))
    key = ["patch_id", "ix", "iy", "z0"]
    bins = rows.join(low, ["patch_id", "ix", "iy"]).groupBy(*key, F.floor((F.col("z") - F.col("z0")) / bin_m).alias("b")).agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy("patch_id", "ix", "iy").orderBy(F.desc("n"), F.desc("b")))
    top = bins.withColumn("r", rank)
    pick = lambda r, v: F.max(F.when(F.col("r") == r, v))
    middle = F.col("z0") + (F.col("b") + 0.5) * bin_m
    return top.groupBy("patch_id", "ix", "iy").agg(
        pick(1, middle).alias("peak0"), pick(2, middle).alias("peak1"), pick(1, F.col("n")).alias("support0"),
        F.coalesce(pick(2, F.col("n")), F.lit(0)).alias("support1"), F.sum("n").alias("total_points"),
    ).withColumn("peak_sep", F.coalesce(F.abs(F.col("peak1") - F.col("peak0")), F.lit(0.0)))


def road_z_median(traj: DataFrame, size: float = 5.0) -> DataFrame:
    """Median trajectory height of each cell and its robust spread: 1.4826 times the
    median deviation, else half the 10-90 % range, else the standard deviation."""
    rows = cell(finite_filter(traj), size)
    key = ["patch_id", "ix", "iy"]
    mid = rows.groupBy(*key).agg(
        F.percentile("z", F.lit(0.5)).alias("road_z"), F.percentile("z", F.lit(0.1)).alias("q10"), F.percentile("z", F.lit(0.9)).alias("q90"), F.stddev_pop("z").alias("sd")
    )
    mad = rows.join(mid, key).groupBy(*key).agg(F.percentile(F.abs(F.col("z") - F.col("road_z")), F.lit(0.5)).alias("mad"))
    positive = lambda c: F.when(c > 0, c)
    spread = F.coalesce(positive(1.4826 * F.col("mad")), positive(0.5 * (F.col("q90") - F.col("q10"))), positive(F.col("sd")), F.lit(0.0))
    return mid.join(mad, key).select(*key, "road_z", spread.alias("spread"))


def overlap_cells(peaks: DataFrame, road_z: DataFrame, sep_gate: float = 3.0, least_total: int = 40, least_support: int = 15, least_ratio: float = 0.08, density_reference: float = 200.0) -> DataFrame:
    """Cells where another layer lies at least `sep_gate` above or below the road. The
    count gates scale with the median number of points in a patch's cells."""
    density = peaks.where("total_points > 0").groupBy("patch_id").agg(F.percentile("total_points", F.lit(0.5)).alias("density"))
    scale = F.greatest(F.lit(0.2), F.least(F.lit(3.0), F.col("density") / max(1.0, density_reference)))
    adapted = lambda base, low: F.greatest(F.lit(low), F.rint(scale * base))
    rows = peaks.join(road_z.select("patch_id", "ix", "iy", "road_z"), ["patch_id", "ix", "iy"]).join(density, "patch_id")
    nearer0 = F.abs(F.col("peak0") - F.col("road_z")) <= F.abs(F.col("peak1") - F.col("road_z"))
    rows = rows.where("support1 > 0").withColumns({"layer_z": F.when(nearer0, F.col("peak1")).otherwise(F.col("peak0")), "support": F.when(nearer0, F.col("support1")).otherwise(F.col("support0"))})
    ok = (
        (F.col("total_points") >= adapted(least_total, 10)) & (F.abs(F.col("layer_z") - F.col("road_z")) >= sep_gate)
        & (F.col("support") >= adapted(least_support, 5)) & (F.col("support") / F.col("total_points") >= least_ratio)
    )
    side = F.when(F.col("layer_z") > F.col("road_z"), "high").otherwise("low")
    return rows.where(ok).select("patch_id", "ix", "iy", side.alias("side"), "layer_z", "road_z")


def point_clean_tag(points: DataFrame, road_z: DataFrame, overlap: DataFrame, size: float = 5.0, band: float = 0.3, layer_band: float = 0.5) -> DataFrame:
    """Points with tag: 2 on the road's height, 12 on an overlapping layer, else 1."""
    key = ["patch_id", "ix", "iy"]
    rows = cell(finite_filter(points), size).join(road_z.select(*key, "road_z"), key, "left").join(overlap.select(*key, "side", "layer_z"), key, "left")
    layer = F.when(F.col("side") == "high", F.col("z") >= F.col("layer_z") - layer_band).when(F.col("side") == "low", F.col("z") <= F.col("layer_z") + layer_band)
    tag = F.when(F.abs(F.col("z") - F.col("road_z")) <= band, 2).when(layer, 12).otherwise(1)
    return rows.withColumn("tag", tag)


def cell_components(cells: DataFrame) -> DataFrame:
    """8-neighbour components of (patch_id, ix, iy): adds `component`, the smallest
    packed cell. Labels spread along edges until none changes; each round is cut off
    from the ones before it by a checkpoint in the shared folder."""
    from .network import cut

    own = cut(cells.select("patch_id", "ix", "iy").distinct().withColumn("component", packed_cell()))
    while True:
        spread = neighbours(own, 1).groupBy("patch_id", "ix", "iy").agg(F.min("component").alias("component"))
        new = cut(own.select("patch_id", "ix", "iy", F.col("component").alias("was")).join(spread, ["patch_id", "ix", "iy"]))
        if not new.where("component <> was").limit(1).count():
            return own
        # A label is also a cell: following it once more halves the remaining way.
        jump = new.select("patch_id", packed_cell().alias("component"), F.col("component").alias("next"))
        own = cut(new.join(jump, ["patch_id", "component"], "left").select("patch_id", "ix", "iy", F.coalesce("next", "component").alias("component")))


def cell_topn(points: DataFrame, score: Column, size: float = 1.0, per_cell: int = 200, per_patch: int = 300_000) -> DataFrame:
    """At most `per_cell` points of each cell by (score, point_id), then the first
    `per_patch` of each patch by point_id."""
    rows = cell(finite_filter(points), size).withColumn("score", score)
    best = F.row_number().over(Window.partitionBy("patch_id", "ix", "iy").orderBy("score", "point_id", "z"))
    first = F.row_number().over(Window.partitionBy("patch_id").orderBy("point_id", "x", "y", "z"))
    return rows.withColumn("r", best).where(F.col("r") <= per_cell).withColumn("p", first).where(F.col("p") <= per_patch).drop("r", "p")
