"""Ground models, layers, corridors and trajectory quality over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cells, series
from ..sources import views as v
from .registry import query, rounded

P, T = ("v_points",), ("v_traj",)
PT = ("v_points", "v_traj")

CELL5 = "CAST(floor(x / 5e0) AS BIGINT) AS ix, CAST(floor(y / 5e0) AS BIGINT) AS iy"
DEM = f"c AS (SELECT *, {CELL5} FROM v_points), dem AS (SELECT patch_id, ix, iy, quantile_cont(z, 0.1e0) AS ground_z, count(*) AS n FROM c GROUP BY ALL HAVING count(*) >= 8)"
# Vertices with their unit heading.
SEG_FREE = """s0 AS (SELECT *, coalesce(lead(x) OVER w, x) - coalesce(lag(x) OVER w, x) AS ddx, coalesce(lead(y) OVER w, y) - coalesce(lag(y) OVER w, y) AS ddy FROM v_traj WINDOW w AS (PARTITION BY traj_id ORDER BY seq)),
h AS (SELECT *, CASE WHEN sqrt(ddx * ddx + ddy * ddy) > 0 THEN ddx / sqrt(ddx * ddx + ddy * ddy) END AS hx, CASE WHEN sqrt(ddx * ddx + ddy * ddy) > 0 THEN ddy / sqrt(ddx * ddx + ddy * ddy) END AS hy FROM s0)"""
OFFSETS = "o AS (SELECT a.i, b.i AS j FROM (VALUES (-1), (0), (1)) a(i), (VALUES (-1), (0), (1)) b(i))"
GROUND = f"""{DEM}, {OFFSETS}, q AS (SELECT *, {CELL5} FROM v_traj),
own AS (SELECT q.*, dem.ground_z AS g FROM q LEFT JOIN dem USING (patch_id, ix, iy)),
lost AS (SELECT DISTINCT patch_id, ix, iy FROM own WHERE g IS NULL),
pool AS (SELECT lost.patch_id, lost.ix, lost.iy, quantile_cont(c.z, 0.1e0) AS pz FROM lost, o, c
  WHERE c.patch_id = lost.patch_id AND c.ix = lost.ix + o.i AND c.iy = lost.iy + o.j GROUP BY ALL HAVING count(*) >= 8),
tg AS (SELECT own.*, coalesce(g, pz) AS ground_z FROM own LEFT JOIN pool USING (patch_id, ix, iy)),
res AS (SELECT *, z - ground_z - median(z - ground_z) OVER (PARTITION BY patch_id) AS residual FROM tg)"""


@query("SELECT patch_id, CAST(floor(x / 5e0) AS BIGINT) AS ix, CAST(floor(y / 5e0) AS BIGINT) AS iy, CAST(floor(x / 5e0) AS BIGINT) * 4294967296 + CAST(floor(y / 5e0) AS BIGINT) AS key, count(*) AS n FROM v_points GROUP BY ALL", P)
def grid_cell(spark, d):
    rows = cells.cell(v.points(spark, d), 5.0).withColumn("key", cells.packed_cell())
    return rows.groupBy("patch_id", "ix", "iy", "key").agg(F.count("*").alias("n"))


@query("SELECT patch_id, count(*) AS n FROM (SELECT patch_id, CASE WHEN value > 90 THEN NULL ELSE value END AS z FROM (SELECT user_id % 8 AS patch_id, value FROM events)) WHERE z IS NOT NULL GROUP BY patch_id")
def finite_filter(spark, d):
    events = spark.read.parquet(f"{d}/events.parquet").selectExpr("user_id % 8 AS patch_id", "CASE WHEN value > 90 THEN double('NaN') ELSE value END AS z")
    return cells.finite_filter(events, "z").groupBy("patch_id").agg(F.count("*").alias("n"))


@query(f"{DEM} SELECT patch_id, ix, iy, round(ground_z, 6) AS ground_z, n FROM dem", P)
def dem_quantile(spark, d):
    return rounded(cells.dem_quantile(v.points(spark, d)))


@query(f"{GROUND} SELECT patch_id, traj_id, seq, round(ground_z, 6) AS ground_z FROM tg", PT)
def dem_lookup_fallback(spark, d):
    return rounded(cells.dem_lookup_fallback(v.traj(spark, d), v.points(spark, d)).select("patch_id", "traj_id", "seq", "ground_z"))


@query(
    f"""{DEM}, {OFFSETS}, own AS (SELECT c.*, dem.ground_z AS g FROM c LEFT JOIN dem USING (patch_id, ix, iy)),
    lost AS (SELECT DISTINCT patch_id, ix, iy FROM own WHERE g IS NULL),
    pool AS (SELECT lost.patch_id, lost.ix, lost.iy, quantile_cont(c.z, 0.1e0) AS pz FROM lost, o, c
      WHERE c.patch_id = lost.patch_id AND c.ix = lost.ix + o.i AND c.iy = lost.iy + o.j GROUP BY ALL HAVING count(*) >= 8),
    r AS (SELECT own.*, round(z - coalesce(g, pz), 9) AS dz FROM own LEFT JOIN pool USING (patch_id, ix, iy)),
    u AS (SELECT patch_id, count(*) FILTER (cls = 2) >= 4000 AS use_cls FROM c GROUP BY patch_id)
    SELECT patch_id, CASE WHEN bool_or(use_cls) THEN 'las_classification' ELSE 'dem_band' END AS ground_source, count(*) AS n_points,
      count(*) FILTER (CASE WHEN use_cls THEN cls = 2 ELSE dz BETWEEN -0.2e0 AND 0.08e0 END) AS ground_count,
      round(quantile_cont(CASE WHEN NOT use_cls THEN abs(dz) END, 0.5e0), 6) AS dz_p50, round(quantile_cont(CASE WHEN NOT use_cls THEN abs(dz) END, 0.9e0), 6) AS dz_p90,
      round(quantile_cont(CASE WHEN NOT use_cls THEN abs(dz) END, 0.99e0), 6) AS dz_p99
    FROM r JOIN u USING (patch_id) GROUP BY patch_id""",
    P,
)
def ground_classify_band(spark, d):
    return rounded(cells.ground_classify_band(v.points(spark, d), least_labelled=4000))


@query("c AS (SELECT patch_id, z, min(z) OVER (PARTITION BY patch_id, floor(x), floor(y)) AS m FROM v_points) SELECT patch_id, count(*) AS n, count(*) FILTER (z <= m + 0.08e0) AS n_ground FROM c GROUP BY patch_id", P)
def ground_label_cellmin(spark, d):
    return cells.ground_label_cellmin(v.points(spark, d)).groupBy("patch_id").agg(F.count("*").alias("n"), F.count_if("is_ground").alias("n_ground"))


@query("SELECT patch_id, 'existing' AS label_source, count(*) FILTER (cls = 2) AS ground, round(count(*) FILTER (cls = 2) / count(*), 6) AS ratio, 'ok' AS reason FROM v_points GROUP BY patch_id", P)
def ground_label_source(spark, d):
    return rounded(cells.ground_label_source(v.points(spark, d)))


@query(f"{OFFSETS.replace('(-1), (0), (1)', '(-2), (-1), (0), (1), (2)')}, c AS (SELECT DISTINCT patch_id, {CELL5} FROM v_traj) SELECT DISTINCT patch_id, ix + i AS ix, iy + j AS iy FROM c, o WHERE i * i + j * j <= 4", T)
def corridor_cells(spark, d):
    return cells.corridor_cells(v.traj(spark, d))


@query(f"c AS (SELECT DISTINCT patch_id, {CELL5} FROM v_traj), p AS (SELECT *, {CELL5} FROM v_points) SELECT patch_id, count(*) AS n, round(sum(z), 3) AS z FROM p SEMI JOIN c USING (patch_id, ix, iy) GROUP BY patch_id", PT)
def corridor_semi_join(spark, d):
    kept = cells.corridor_semi_join(v.points(spark, d), v.traj(spark, d), radius_m=0.0)
    return kept.groupBy("patch_id").agg(F.count("*").alias("n"), F.round(F.sum("z"), 3).alias("z"))


PEAKS = f"""p AS (SELECT *, {CELL5} FROM v_points), lo AS (SELECT *, min(z) OVER (PARTITION BY patch_id, ix, iy) AS z0 FROM p),
b AS (SELECT patch_id, ix, iy, z0, floor((z - z0) / 0.2e0) AS b, count(*) AS n FROM lo GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY patch_id, ix, iy ORDER BY n DESC, b DESC) AS r FROM b),
peaks AS (SELECT patch_id, ix, iy, max(CASE WHEN r = 1 THEN z0 + (b + 0.5e0) * 0.2e0 END) AS peak0, max(CASE WHEN r = 2 THEN z0 + (b + 0.5e0) * 0.2e0 END) AS peak1,
  max(CASE WHEN r = 1 THEN n END) AS support0, coalesce(max(CASE WHEN r = 2 THEN n END), 0) AS support1, CAST(sum(n) AS BIGINT) AS total_points FROM r GROUP BY ALL)"""
ROAD = f"""t AS (SELECT *, {CELL5} FROM v_traj), m AS (SELECT *, median(z) OVER (PARTITION BY patch_id, ix, iy) AS road_z FROM t),
road AS (SELECT patch_id, ix, iy, road_z, median(abs(z - road_z)) AS mad, quantile_cont(z, 0.1e0) AS q10, quantile_cont(z, 0.9e0) AS q90, stddev_pop(z) AS sd FROM m GROUP BY ALL)"""
OVERLAP = """den AS (SELECT patch_id, median(total_points) AS density FROM peaks GROUP BY patch_id),
j AS (SELECT peaks.*, road_z, greatest(0.2e0, least(3e0, density / 20e0)) AS sc, abs(peak0 - road_z) <= abs(peak1 - road_z) AS near0
  FROM peaks JOIN road USING (patch_id, ix, iy) JOIN den USING (patch_id) WHERE support1 > 0),
k AS (SELECT *, CASE WHEN near0 THEN peak1 ELSE peak0 END AS layer_z, CASE WHEN near0 THEN support1 ELSE support0 END AS support FROM j),
ov AS (SELECT patch_id, ix, iy, CASE WHEN layer_z > road_z THEN 'high' ELSE 'low' END AS side, layer_z, road_z FROM k
  WHERE total_points >= greatest(10, round_even(sc * 10, 0)) AND abs(layer_z - road_z) >= 3 AND support >= greatest(2, round_even(sc * 2, 0)) AND support / total_points >= 0.08e0)"""


def _overlap(spark, d):
    peaks, road = cells.cell_z_peaks(v.points(spark, d)), cells.road_z_median(v.traj(spark, d))
    return road, cells.overlap_cells(peaks, road, least_total=10, least_support=5, density_reference=20.0)


OVERLAP = OVERLAP.replace("greatest(2, round_even(sc * 2, 0))", "greatest(5, round_even(sc * 5, 0))")


@query(f"{PEAKS} SELECT patch_id, ix, iy, round(peak0, 6) AS peak0, round(peak1, 6) AS peak1, support0, support1, total_points, round(coalesce(abs(peak1 - peak0), 0), 6) AS peak_sep FROM peaks", P)
def cell_z_peaks(spark, d):
    return rounded(cells.cell_z_peaks(v.points(spark, d)))


@query(f"{ROAD} SELECT patch_id, ix, iy, round(road_z, 6) AS road_z, round(coalesce(CASE WHEN mad > 0 THEN 1.4826e0 * mad END, CASE WHEN q90 - q10 > 0 THEN 0.5e0 * (q90 - q10) END, CASE WHEN sd > 0 THEN sd END, 0), 6) AS spread FROM road", T)
def road_z_median(spark, d):
    return rounded(cells.road_z_median(v.traj(spark, d)))


@query(f"{PEAKS}, {ROAD}, {OVERLAP} SELECT patch_id, ix, iy, side, round(layer_z, 6) AS layer_z, round(road_z, 6) AS road_z FROM ov", PT)
def overlap_cells(spark, d):
    return rounded(_overlap(spark, d)[1])


@query(f"{PEAKS}, {ROAD}, {OVERLAP} SELECT patch_id, side, count(*) AS n, round(avg(layer_z), 6) AS mean_z FROM ov GROUP BY ALL", PT)
def interference_layers(spark, d):
    return rounded(_overlap(spark, d)[1].groupBy("patch_id", "side").agg(F.count("*").alias("n"), F.avg("layer_z").alias("mean_z")))


@query(
    f"""{PEAKS}, {ROAD}, {OVERLAP}, tagged AS (SELECT p.patch_id, CASE WHEN abs(p.z - road.road_z) <= 0.3e0 THEN 2 WHEN side = 'high' AND p.z >= layer_z - 0.5e0 THEN 12
      WHEN side = 'low' AND p.z <= layer_z + 0.5e0 THEN 12 ELSE 1 END AS tag FROM p LEFT JOIN road USING (patch_id, ix, iy) LEFT JOIN ov USING (patch_id, ix, iy))
    SELECT patch_id, tag, count(*) AS n FROM tagged GROUP BY ALL""",
    PT,
)
def point_clean_tag(spark, d):
    road, overlap = _overlap(spark, d)
    return cells.point_clean_tag(v.points(spark, d), road, overlap).groupBy("patch_id", "tag").agg(F.count("*").alias("n"))


@query(f"{ROAD}, p AS (SELECT *, {CELL5} FROM v_points) SELECT patch_id, count(*) AS n, count(road_z) AS n_known, round(sum(z - road_z), 3) AS dz FROM p LEFT JOIN road USING (patch_id, ix, iy) GROUP BY patch_id", PT)
def cell_lookup(spark, d):
    road = cells.road_z_median(v.traj(spark, d)).select("patch_id", "ix", "iy", "road_z")
    rows = cells.cell(v.points(spark, d), 5.0).join(road, ["patch_id", "ix", "iy"], "left")
    return rows.groupBy("patch_id").agg(F.count("*").alias("n"), F.count("road_z").alias("n_known"), F.round(F.sum(F.col("z") - F.col("road_z")), 3).alias("dz"))


COMPONENTS = """e AS (SELECT DISTINCT patch_id, CAST(floor(x / 5e0) AS BIGINT) AS ix, CAST(floor(y / 5e0) AS BIGINT) AS iy, CAST(floor(x / 5e0) AS BIGINT) * 4294967296 + CAST(floor(y / 5e0) AS BIGINT) AS k FROM v_points WHERE cls = 1),
n AS (SELECT a.patch_id, a.k AS a, b.k AS b FROM e a JOIN e b ON a.patch_id = b.patch_id AND abs(a.ix - b.ix) <= 1 AND abs(a.iy - b.iy) <= 1),
w AS (SELECT patch_id, k, k AS c FROM e UNION SELECT n.patch_id, n.b, w.c FROM w JOIN n ON n.patch_id = w.patch_id AND n.a = w.k)
SELECT patch_id, ix, iy, min(c) AS component FROM w JOIN e USING (patch_id, k) GROUP BY ALL"""


@query(COMPONENTS, P)
def cell_components(spark, d):
    own = cells.cell(v.points(spark, d).where("cls = 1"), 5.0)
    return cells.cell_components(own)


@query(
    """r AS (SELECT *, row_number() OVER (PARTITION BY patch_id, floor(x), floor(y) ORDER BY z, point_id) AS r FROM v_points),
    q AS (SELECT *, row_number() OVER (PARTITION BY patch_id ORDER BY point_id, x, y, z) AS p FROM r WHERE r <= 2)
    SELECT patch_id, point_id, x, y, z FROM q WHERE p <= 500""",
    P,
)
def cell_topn_export(spark, d):
    top = cells.cell_topn(v.points(spark, d), F.col("z"), per_cell=2, per_patch=500)
    return top.select("patch_id", "point_id", "x", "y", "z")


@query("SELECT patch_id, sum(least(n, 3)) AS n FROM (SELECT patch_id, floor(x), floor(y), count(*) AS n FROM v_points GROUP BY ALL) GROUP BY patch_id", P)
def cell_cap_sample(spark, d):
    """A seeded sample of at most three points a cell, counted."""
    from pyspark.sql import Window

    rows = cells.cell(v.points(spark, d), 1.0)
    order = Window.partitionBy("patch_id", "ix", "iy").orderBy(F.xxhash64("point_id", "z"), "z")
    return rows.withColumn("r", F.row_number().over(order)).where("r <= 3").groupBy("patch_id").agg(F.count("*").alias("n"))


# --- trajectories ----------------------------------------------------------------


@query("SELECT patch_id, round(avg(CASE WHEN abs(z) > 1e-9 THEN 1e0 ELSE 0e0 END), 6) AS nonzero_ratio, count(*) AS n, round(stddev_pop(z), 6) AS z_std, avg(CASE WHEN abs(z) > 1e-9 THEN 1e0 ELSE 0e0 END) < 0.01 AND stddev_pop(z) < 0.05 AS degraded FROM v_traj GROUP BY patch_id", T)
def traj_z_degraded(spark, d):
    return rounded(series.traj_z_degraded(v.traj(spark, d)))


@query("SELECT patch_id, count(z) AS n, round(min(z), 6) AS min, round(quantile_cont(z, 0.5e0), 6) AS p50, round(quantile_cont(z, 0.9e0), 6) AS p90, round(quantile_cont(z, 0.99e0), 6) AS p99, round(max(z), 6) AS max, round(avg(z), 6) AS mean FROM v_traj GROUP BY patch_id", T)
def series_stats(spark, d):
    return rounded(series.series_stats(v.traj(spark, d), F.col("z"), ["patch_id"]))


NEAR = """nb AS (SELECT t.patch_id, t.traj_id, t.seq, p.z AS pz, (p.x - t.x) * (p.x - t.x) + (p.y - t.y) * (p.y - t.y) AS d2 FROM v_traj t JOIN v_points p
  ON p.patch_id = t.patch_id AND p.x BETWEEN t.x - 6 AND t.x + 6 AND p.y BETWEEN t.y - 6 AND t.y + 6),
nk AS (SELECT *, row_number() OVER (PARTITION BY patch_id, traj_id, seq ORDER BY d2, pz) AS r FROM nb WHERE d2 <= 36),
na AS (SELECT patch_id, traj_id, seq, count(*) FILTER (d2 <= 4) AS n_near, quantile_cont(CASE WHEN d2 <= 4 THEN pz END, 0.5e0) AS nz, CASE WHEN count(*) >= 3 THEN quantile_cont(CASE WHEN r <= 8 THEN pz END, 0.5e0) END AS kz FROM nk GROUP BY ALL),
cloud AS (SELECT t.*, n_near, CASE WHEN n_near >= 3 THEN nz ELSE kz END AS cloud_z FROM v_traj t LEFT JOIN na USING (patch_id, traj_id, seq))"""


def _cloud(spark, d):
    return series.radius_median_z(v.traj(spark, d), v.points(spark, d))


@query(f"{NEAR} SELECT patch_id, traj_id, seq, round(cloud_z, 6) AS cloud_z FROM cloud", PT)
def radius_median_z(spark, d):
    return rounded(_cloud(spark, d).select("patch_id", "traj_id", "seq", "cloud_z"))


FUSION = """SELECT {by}, count(*) AS n_traj, count(cloud_z) AS n_valid, round(quantile_cont(abs(z - cloud_z), 0.5e0), 6) AS p50, round(quantile_cont(abs(z - cloud_z), 0.9e0), 6) AS p90,
  round(quantile_cont(abs(z - cloud_z), 0.99e0), 6) AS p99, round(greatest(0.2e0, quantile_cont(abs(z - cloud_z), {q})), 6) AS threshold, round(count(cloud_z) / count(*), 6) AS coverage,
  CASE WHEN count(cloud_z) = 0 THEN 'NO_VALID' WHEN count(cloud_z) / count(*) < 0.6e0 THEN 'LOW_COVERAGE' ELSE 'OK' END AS status FROM cloud GROUP BY {by}"""


@query(f"{NEAR} " + FUSION.format(by="patch_id", q="0.99e0"), PT)
def fusion_qc(spark, d):
    return rounded(series.fusion_qc(_cloud(spark, d)))


BINS = f"""{NEAR}, th AS (SELECT traj_id, greatest(0.2e0, quantile_cont(abs(z - cloud_z), 0.5e0)) AS threshold FROM cloud GROUP BY traj_id),
ix AS (SELECT patch_id, traj_id, row_number() OVER (PARTITION BY traj_id ORDER BY seq) - 1 AS i, abs(z - cloud_z) AS a FROM cloud),
bn AS (SELECT patch_id, traj_id, unnest(range(CAST(greatest(0, floor((i - 16) / 4e0) + 1) AS BIGINT), CAST(floor(i / 4e0) AS BIGINT) + 1)) AS bin, a FROM ix),
bs AS (SELECT patch_id, traj_id, bin, count(*) AS span, count(a) AS n_valid, quantile_cont(a, 0.5e0) AS score FROM bn GROUP BY ALL),
ba AS (SELECT bs.*, threshold, n_valid / span >= 0.6e0 AND coalesce(score > threshold, false) AS abnormal FROM bs JOIN th USING (traj_id))"""


def _bins(spark, d):
    rows = _cloud(spark, d)
    limits = series.fusion_qc(rows, q=0.5, by=series.TRAJ)
    return series.sliding_bin_score(rows, limits, width=16, stride=4)


@query(f"{BINS} SELECT patch_id, traj_id, bin, span, n_valid, round(score, 6) AS score, round(threshold, 6) AS threshold, abnormal FROM ba", PT)
def sliding_bin_score(spark, d):
    return rounded(_bins(spark, d).withColumn("bin", F.col("bin").cast("long")))


RUNS = f"""{BINS}, ru AS (SELECT *, bin - row_number() OVER (PARTITION BY traj_id ORDER BY bin) AS run FROM ba WHERE abnormal),
ag AS (SELECT patch_id, traj_id, run, min(bin) AS start_bin, max(bin) + 1 AS end_bin, max(score) AS score FROM ru GROUP BY ALL HAVING count(*) >= 2),
rk AS (SELECT *, row_number() OVER (PARTITION BY traj_id ORDER BY score DESC, start_bin) AS rank FROM ag)
SELECT patch_id, traj_id, start_bin, end_bin, round(score, 6) AS score, start_bin * 4 AS start_idx, (end_bin - 1) * 4 + 16 AS end_idx, rank FROM rk WHERE rank <= 5"""


@query(RUNS, PT)
def abnormal_runs(spark, d):
    got = series.abnormal_runs(_bins(spark, d), width=16, stride=4)
    return rounded(got.select("patch_id", "traj_id", *[F.col(c).cast("long").alias(c) for c in ("start_bin", "end_bin")], "score", *[F.col(c).cast("long").alias(c) for c in ("start_idx", "end_idx", "rank")]))


def _ground(spark, d):
    return cells.dem_lookup_fallback(v.traj(spark, d), v.points(spark, d))


@query(
    f"""{GROUND}, b AS (SELECT patch_id, median(z - ground_z) AS baseline FROM tg GROUP BY patch_id),
    a AS (SELECT patch_id, max(b.baseline) AS baseline, count(*) AS n_total, count(residual) AS n_valid, quantile_cont(abs(residual), 0.5e0) AS p50, quantile_cont(abs(residual), 0.9e0) AS p90, quantile_cont(abs(residual), 0.99e0) AS p99,
      avg(CASE WHEN residual IS NOT NULL THEN CAST(abs(residual) > 0.5e0 AS INTEGER) END) AS outlier_ratio, avg(residual) AS bias FROM res JOIN b USING (patch_id) GROUP BY patch_id)
    SELECT patch_id, round(baseline, 6) AS baseline, n_total, n_valid, round(p50, 6) AS p50, round(p90, 6) AS p90, round(p99, 6) AS p99, round(outlier_ratio, 6) AS outlier_ratio, round(bias, 6) AS bias,
      round(n_valid / n_total, 6) AS coverage, n_valid / n_total >= 0.8e0 AS coverage_ok, outlier_ratio <= 0.05e0 AS outlier_ok, p99 <= 2 AS p99_ok, n_valid / n_total >= 0.8e0 AND outlier_ratio <= 0.05e0 AND p99 <= 2 AS overall_pass FROM a""",
    PT,
)
def clearance_qc(spark, d):
    return rounded(series.clearance_qc(_ground(spark, d)))


EQUAL = f"""{GROUND}, ix AS (SELECT patch_id, traj_id, row_number() OVER (PARTITION BY traj_id ORDER BY seq) - 1 AS i, count(*) OVER (PARTITION BY traj_id) AS n, abs(residual) AS a FROM res),
ed AS (SELECT DISTINCT patch_id, traj_id, n, unnest(range(least(10, n))) AS bin FROM ix),
eb AS (SELECT patch_id, traj_id, bin, (bin * n) // least(10, n) AS lo, ((bin + 1) * n) // least(10, n) AS hi FROM ed),
bi AS (SELECT eb.patch_id, eb.traj_id, bin, min(i) AS start_idx, max(i) AS end_idx, avg(a) AS mean_abs, coalesce(avg(CASE WHEN a IS NOT NULL THEN CAST(a > 0.5e0 AS INTEGER) END), 0) AS outlier_ratio
  FROM eb JOIN ix ON ix.traj_id = eb.traj_id AND i >= lo AND i < hi GROUP BY ALL),
an AS (SELECT *, coalesce(mean_abs > 0.5e0, false) OR outlier_ratio > 0.5e0 AS anomaly FROM bi)"""


def _equal(spark, d):
    return series.equal_bins(series.residuals(_ground(spark, d)), bins=10, outlier_gate=0.5)


@query(f"{EQUAL} SELECT patch_id, traj_id, bin, start_idx, end_idx, round(mean_abs, 6) AS mean_abs, round(outlier_ratio, 6) AS outlier_ratio, anomaly FROM an", PT)
def equal_bins(spark, d):
    return rounded(_equal(spark, d).withColumns({c: F.col(c).cast("long") for c in ("bin", "start_idx", "end_idx")}))


@query(
    f"""{EQUAL}, ru AS (SELECT *, bin - row_number() OVER (PARTITION BY traj_id ORDER BY bin) AS run FROM an WHERE anomaly),
    ag AS (SELECT patch_id, traj_id, run, min(bin) AS start_bin, max(bin) AS end_bin, min(start_idx) AS start_idx, max(end_idx) AS end_idx, coalesce(max(mean_abs) * (1 + max(outlier_ratio)), max(outlier_ratio)) AS score FROM ru GROUP BY ALL),
    rk AS (SELECT *, row_number() OVER (PARTITION BY traj_id ORDER BY score DESC, start_bin) AS rank FROM ag)
    SELECT patch_id, traj_id, start_bin, end_bin, start_idx, end_idx, round(score, 6) AS score, rank FROM rk WHERE rank <= 5""",
    PT,
)
def interval_merge_topk(spark, d):
    got = series.interval_merge_topk(_equal(spark, d))
    return rounded(got.withColumns({c: F.col(c).cast("long") for c in ("start_bin", "end_bin", "start_idx", "end_idx", "rank")}))


@query(
    """s AS (SELECT *, coalesce(lead(x) OVER w, x) - coalesce(lag(x) OVER w, x) AS dx, coalesce(lead(y) OVER w, y) - coalesce(lag(y) OVER w, y) AS dy FROM v_traj WINDOW w AS (PARTITION BY traj_id ORDER BY seq))
    SELECT patch_id, traj_id, seq, round(CASE WHEN sqrt(dx * dx + dy * dy) > 0 THEN dx / sqrt(dx * dx + dy * dy) END, 6) AS hx, round(CASE WHEN sqrt(dx * dx + dy * dy) > 0 THEN dy / sqrt(dx * dx + dy * dy) END, 6) AS hy FROM s""",
    T,
)
def heading(spark, d):
    return rounded(series.heading(v.traj(spark, d)).select("patch_id", "traj_id", "seq", "hx", "hy"))


SPLIT = """s AS (SELECT *, CAST(coalesce(sqrt((x - lag(x) OVER w) * (x - lag(x) OVER w) + (y - lag(y) OVER w) * (y - lag(y) OVER w)) > 10, false)
    OR coalesce(t - lag(t) OVER w > 40000, false) AS INTEGER) AS cut FROM v_traj WINDOW w AS (PARTITION BY traj_id ORDER BY seq)),
  p AS (SELECT *, sum(cut) OVER (PARTITION BY traj_id ORDER BY seq) AS piece FROM s),
  n AS (SELECT *, count(*) OVER (PARTITION BY traj_id, piece) AS n FROM p),
  b AS (SELECT *, max(n) OVER (PARTITION BY traj_id) AS best FROM n)
  SELECT patch_id, traj_id, seq, CAST(CASE WHEN best >= 2 THEN piece ELSE 0 END AS BIGINT) AS piece FROM b WHERE n >= 2 OR best < 2"""


@query(SPLIT, T)
def traj_gap_split(spark, d):
    return series.traj_gap_split(v.traj(spark, d), seconds=40000.0).select("patch_id", "traj_id", "seq", F.col("piece").cast("long").alias("piece"))


@query(
    """s AS (SELECT patch_id, sqrt((x - lag(x) OVER w) * (x - lag(x) OVER w) + (y - lag(y) OVER w) * (y - lag(y) OVER w)) AS d, t - lag(t) OVER w AS dt FROM v_traj WINDOW w AS (PARTITION BY traj_id ORDER BY seq))
    SELECT patch_id, count(*) FILTER (d > 5.05e0) AS by_distance, count(*) FILTER (dt > 40000 AND NOT d > 5.05e0) AS by_time, round(quantile_cont(d, 0.5e0), 6) AS d_p50, round(quantile_cont(d, 0.9e0), 6) AS d_p90, round(max(d), 6) AS d_max, round(max(dt), 3) AS t_max FROM s GROUP BY patch_id""",
    T,
)
def traj_split_stats(spark, d):
    return rounded(series.traj_split_stats(v.traj(spark, d), distance=5.05, seconds=40000.0)).withColumn("t_max", F.round("t_max", 3))


@query("s AS (SELECT *, floor(x / 20e0) AS ix, floor(y / 20e0) AS iy FROM v_traj), l AS (SELECT *, lag(ix) OVER w AS px, lag(iy) OVER w AS py FROM s WINDOW w AS (PARTITION BY traj_id ORDER BY seq)) SELECT patch_id, traj_id, seq FROM l WHERE px IS NULL OR px <> ix OR py <> iy", T)
def consecutive_cell_dedup(spark, d):
    return series.consecutive_cell_dedup(v.traj(spark, d), 20.0).select("patch_id", "traj_id", "seq")


@query(
    f"""{ROAD}, l AS (SELECT *, lag(ix) OVER w AS px, lag(iy) OVER w AS py FROM t WINDOW w AS (PARTITION BY traj_id ORDER BY seq)),
    k AS (SELECT l.patch_id, traj_id, seq, road_z FROM l JOIN road USING (patch_id, ix, iy) WHERE px IS NULL OR px <> ix OR py <> iy),
    g AS (SELECT patch_id, traj_id, abs(road_z - lag(road_z) OVER (PARTITION BY traj_id ORDER BY seq)) AS dz FROM k)
    SELECT patch_id, traj_id, count(*) AS n, round(quantile_cont(dz, 0.5e0), 6) AS p50, round(quantile_cont(dz, 0.9e0), 6) AS p90, round(quantile_cont(dz, 0.99e0), 6) AS p99, round(max(dz), 6) AS max_dz
    FROM g WHERE dz IS NOT NULL GROUP BY GROUPING SETS ((patch_id, traj_id), (patch_id))""",
    T,
)
def road_z_variation(spark, d):
    traj = v.traj(spark, d)
    return rounded(series.road_z_variation(traj, cells.road_z_median(traj)))


@query("SELECT p.patch_id, count(*) AS n, count(*) FILTER (EXISTS (SELECT 1 FROM v_traj t WHERE t.patch_id = p.patch_id AND (t.x - p.x) * (t.x - p.x) + (t.y - p.y) * (t.y - p.y) <= 1)) AS n_near FROM v_points p GROUP BY p.patch_id", PT)
def near_traj_mask(spark, d):
    got = series.near_traj_mask(v.points(spark, d), v.traj(spark, d))
    return got.groupBy("patch_id").agg(F.count("*").alias("n"), F.count_if("near_traj").alias("n_near"))


@query("SELECT p.patch_id, count(*) AS n FROM v_points p WHERE cls = 1 AND NOT EXISTS (SELECT 1 FROM v_traj t WHERE t.patch_id = p.patch_id AND (t.x - p.x) * (t.x - p.x) + (t.y - p.y) * (t.y - p.y) <= 1) GROUP BY p.patch_id", PT)
def non_ground_candidates(spark, d):
    got = series.near_traj_mask(v.points(spark, d).where("cls = 1"), v.traj(spark, d)).where("NOT near_traj")
    return got.groupBy("patch_id").agg(F.count("*").alias("n"))


@query("SELECT t.patch_id, t.traj_id, t.seq, count(p.z) AS n_near FROM v_traj t LEFT JOIN v_points p ON p.patch_id = t.patch_id AND (t.x - p.x) * (t.x - p.x) + (t.y - p.y) * (t.y - p.y) <= 4 GROUP BY ALL", PT)
def radius_count(spark, d):
    got = series.radius_count(v.traj(spark, d), v.points(spark, d), 2.0, ["traj_id", "seq"])
    return got.select("patch_id", "traj_id", "seq", "n_near")


@query(
    """s AS (SELECT *, x - lag(x) OVER w AS dx, y - lag(y) OVER w AS dy FROM v_traj WINDOW w AS (PARTITION BY traj_id ORDER BY seq)),
    m AS (SELECT *, sqrt(dx * dx + dy * dy) AS d, lead(dx) OVER w AS nx, lead(dy) OVER w AS ny FROM s WINDOW w AS (PARTITION BY traj_id ORDER BY seq)),
    n AS (SELECT *, sqrt(nx * nx + ny * ny) AS nd FROM m)
    SELECT patch_id, traj_id, round(max(CASE WHEN d > 0 AND nd > 0 THEN degrees(acos(greatest(-1e0, least(1e0, (dx * nx + dy * ny) / (d * nd))))) * 10 / ((d + nd) / 2) END), 6) AS max_turn_10m, round(max(d), 6) AS max_segment FROM n GROUP BY ALL""",
    T,
)
def max_turn_10m(spark, d):
    return rounded(series.max_turn_and_segment(v.traj(spark, d)))
