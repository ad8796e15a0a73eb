"""Profiles, layers, sweeps, scalar functions and reports over the driver's tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import cells, profiles, series, zones
from ..sources import views as v
from .cell_queries import GROUND, PEAKS, PT, SEG_FREE, T
from .network_queries import CROSS, LINE, PAIRS, RATIO, TX, TZ, _events
from .registry import query, rounded

XSEC = f"""{SEG_FREE}, nr AS (SELECT h.patch_id, h.traj_id, h.seq, h.hx, h.hy, p.x - h.x AS dx, p.y - h.y AS dy, p.z FROM h JOIN v_points p ON p.patch_id = h.patch_id AND p.cls = 2 AND p.x BETWEEN h.x - 8 AND h.x + 8 AND p.y BETWEEN h.y - 8 AND h.y + 8 WHERE h.hx IS NOT NULL),
sw AS (SELECT *, dy * hx - dx * hy AS side FROM nr WHERE dx * dx + dy * dy <= 64 AND abs(dx * hx + dy * hy) <= 3 AND abs(dy * hx - dx * hy) <= 5),
bn AS (SELECT *, CAST(floor(round((side + 5e0) / (10e0 / 21), 9)) AS INTEGER) AS bin FROM sw),
su AS (SELECT patch_id, traj_id, seq, count(*) AS support FROM bn GROUP BY ALL),
md AS (SELECT patch_id, traj_id, seq, (bin + 0.5e0) * (10e0 / 21) - 5e0 AS pos, median(z) AS mid FROM bn WHERE bin < 21 GROUP BY patch_id, traj_id, seq, bin),
ft AS (SELECT patch_id, traj_id, seq, count(*) AS n_bins, CASE WHEN count(*) = 1 THEN 0e0 ELSE regr_slope(mid, pos) END AS slope, CASE WHEN count(*) = 1 THEN min(mid) ELSE regr_intercept(mid, pos) END AS level FROM md GROUP BY ALL),
rs AS (SELECT patch_id, traj_id, seq, quantile_cont(abs(mid - slope * pos - level), 0.9e0) AS p90 FROM md JOIN ft USING (patch_id, traj_id, seq) GROUP BY ALL),
xp AS (SELECT t.patch_id, t.traj_id, t.seq, coalesce(support, 0) AS support, n_bins, p90, coalesce(n_bins, 0) / 21 AS coverage, coalesce(n_bins < 5 OR p90 > 0.5e0 OR p90 IS NULL, true) AS anomaly
  FROM v_traj t LEFT JOIN su USING (patch_id, traj_id, seq) LEFT JOIN ft USING (patch_id, traj_id, seq) LEFT JOIN rs USING (patch_id, traj_id, seq))"""


def _profiles(spark, d):
    return profiles.xsec_profile_fit(v.traj(spark, d), v.points(spark, d).where("cls = 2"))


@query(f"{XSEC} SELECT patch_id, traj_id, seq, support, round(coverage, 6) AS coverage, round(p90, 9) AS p90, anomaly FROM xp", PT)
def xsec_profile_fit(spark, d):
    got = _profiles(spark, d).select("patch_id", "traj_id", "seq", "support", F.round("coverage", 6).alias("coverage"), F.round("p90", 9).alias("p90"), "anomaly")
    return got


@query(f"{XSEC} SELECT patch_id, count(*) AS n, round(avg(CAST(p90 IS NOT NULL AS INTEGER)), 9) AS valid_ratio, round(avg(CAST(anomaly AS INTEGER)), 9) AS anomaly_ratio, round(median(p90), 9) AS p50, round(quantile_cont(p90, 0.9e0), 9) AS p90_of_p90, median(support) AS support_p50, avg(CAST(p90 IS NOT NULL AS INTEGER)) >= 0.8 AS valid_ok, avg(CAST(anomaly AS INTEGER)) <= 0.2 AS anomaly_ok, coalesce(quantile_cont(p90, 0.9e0) <= 0.5, false) AS p90_ok FROM xp GROUP BY patch_id", PT)
def xsec_metrics(spark, d):
    return rounded(profiles.xsec_metrics(_profiles(spark, d)).withColumns({"p50": F.round("p50", 9), "p90_of_p90": F.round("p90_of_p90", 9)}), 9)


@query(
    f"""{XSEC}, ix AS (SELECT *, row_number() OVER (PARTITION BY traj_id ORDER BY seq) AS i FROM xp), ru AS (SELECT *, i - row_number() OVER (PARTITION BY traj_id ORDER BY i) AS run FROM ix WHERE anomaly)
    SELECT patch_id, traj_id, min(i) AS start_i, max(i) AS end_i, min(support) AS min_support, round(max(p90), 9) AS max_p90 FROM ru GROUP BY patch_id, traj_id, run HAVING count(*) >= 3""",
    PT,
)
def xsec_intervals(spark, d):
    got = profiles.xsec_intervals(_profiles(spark, d))
    return got.select("patch_id", "traj_id", F.col("start_i").cast("long").alias("start_i"), F.col("end_i").cast("long").alias("end_i"), "min_support", F.round("max_p90", 9).alias("max_p90"))


SWEEP = """tr AS (SELECT CAST(i AS INTEGER) AS trial_id, 0.2e0 + (i % 4) * 0.2e0 AS band, (i // 4) * 0.1e0 AS margin FROM range(24) r(i)),
mt AS (SELECT patch_id, trial_id, round(avg(CAST(abs(residual - margin) > band AS INTEGER)), 9) AS outliers, round(quantile_cont(abs(residual - margin), 0.9e0), 9) AS p90 FROM (SELECT * FROM res WHERE residual IS NOT NULL) r, tr GROUP BY ALL),
pn AS (SELECT *, outliers <= 0.2e0 AS passed, round(outliers + p90, 9) AS penalty FROM mt)"""


@query(f"{GROUND}, {SWEEP} SELECT patch_id, trial_id, outliers, p90, passed, 24 AS n_trials FROM pn QUALIFY row_number() OVER (PARTITION BY patch_id ORDER BY NOT passed, CASE WHEN passed THEN trial_id ELSE penalty END, trial_id) = 1", PT)
def param_sweep(spark, d):
    rows = cells.dem_lookup_fallback(v.traj(spark, d), v.points(spark, d))
    rows = series.residuals(rows).where("residual IS NOT NULL").select("patch_id", "residual")
    trials = spark.range(24).selectExpr("cast(id AS int) AS trial_id", "0.2D + (id % 4) * 0.2D AS band", "floor(id / 4) * 0.1D AS margin")
    return profiles.param_sweep(rows, trials, F.col("residual"), 0.2).withColumn("n_trials", F.col("n_trials").cast("int"))


@query("SELECT (i - 4) * 10.0 AS band, count(*) AS n FROM (SELECT DISTINCT l_linenumber % 5 + 4 AS i FROM lineitem) GROUP BY ALL")
def config_dedup(spark, d):
    rows = spark.read.parquet(f"{d}/lineitem.parquet").selectExpr("l_linenumber % 5 * 10.0D AS band").distinct()
    return rows.groupBy("band").agg(F.count("*").alias("n"))


def _visits(spark, d):
    visits = series.consecutive_cell_dedup(v.traj(spark, d), 5.0)
    peaks = cells.cell_z_peaks(v.points(spark, d)).select("patch_id", "ix", "iy", "peak0", "peak1")
    return visits.join(peaks, ["patch_id", "ix", "iy"]).select("patch_id", "traj_id", "seq", "ix", "iy", "peak0", "peak1")


LAYERS = f"""{PEAKS}, t AS (SELECT *, CAST(floor(x / 5e0) AS BIGINT) AS ix, CAST(floor(y / 5e0) AS BIGINT) AS iy FROM v_traj),
l AS (SELECT *, lag(ix) OVER w AS px, lag(iy) OVER w AS py FROM t WINDOW w AS (PARTITION BY traj_id ORDER BY seq)),
vs AS (SELECT l.patch_id, traj_id, seq, ix, iy, peak0, peak1, row_number() OVER (PARTITION BY traj_id ORDER BY seq) AS i FROM l JOIN peaks USING (patch_id, ix, iy) WHERE px IS NULL OR px <> ix OR py <> iy),
dp AS (SELECT patch_id, traj_id, i, peak0, peak1, 0e0 AS c0, CASE WHEN peak1 IS NULL THEN CAST('inf' AS DOUBLE) ELSE 0e0 END AS c1 FROM vs WHERE i = 1
  UNION ALL SELECT vs.patch_id, vs.traj_id, vs.i, vs.peak0, vs.peak1, least(c0 + abs(vs.peak0 - dp.peak0), coalesce(c1 + abs(vs.peak0 - dp.peak1) + 0.5e0, CAST('inf' AS DOUBLE))),
    CASE WHEN vs.peak1 IS NULL THEN CAST('inf' AS DOUBLE) ELSE least(c0 + abs(vs.peak1 - dp.peak0) + 0.5e0, coalesce(c1 + abs(vs.peak1 - dp.peak1), CAST('inf' AS DOUBLE))) END
  FROM dp JOIN vs ON vs.traj_id = dp.traj_id AND vs.i = dp.i + 1)"""


@query(f"{LAYERS} SELECT patch_id, traj_id, count(*) AS n, round(min_by(least(c0, c1), -i), 5) AS cost FROM dp GROUP BY ALL", PT)
def road_z_layer_path(spark, d):
    """The path's cost, which unlike the path itself has no ties."""
    path = profiles.road_z_layer_path(_visits(spark, d))
    w = Window.partitionBy(*LINE).orderBy("seq")
    step = F.abs(F.col("layer_z") - F.lag("layer_z").over(w)) + F.when(F.col("layer") != F.lag("layer").over(w), 0.5).otherwise(0.0)
    return path.withColumn("c", step).groupBy(*LINE).agg(F.count("*").alias("n"), F.round(F.coalesce(F.sum("c"), F.lit(0.0)), 5).alias("cost"))


# The path itself: each step keeps where it came from, and the last cell's choice is followed back.
VOTED = f"""{LAYERS.rsplit("dp AS", 1)[0]}dp AS (SELECT patch_id, traj_id, i, seq, ix, iy, peak0, peak1, 0e0 AS c0, CASE WHEN peak1 IS NULL THEN CAST('inf' AS DOUBLE) ELSE 0e0 END AS c1, 0 AS b0, 0 AS b1 FROM vs WHERE i = 1
  UNION ALL SELECT patch_id, traj_id, i, seq, ix, iy, peak0, peak1, least(w00, w10), CASE WHEN peak1 IS NULL THEN CAST('inf' AS DOUBLE) ELSE least(w01, w11) END, CASE WHEN w00 <= w10 THEN 0 ELSE 1 END, CASE WHEN w01 <= w11 THEN 0 ELSE 1 END
  FROM (SELECT vs.*, c0 + abs(vs.peak0 - dp.peak0) AS w00, coalesce(c1 + abs(vs.peak0 - dp.peak1) + 0.5e0, CAST('inf' AS DOUBLE)) AS w10, c0 + abs(vs.peak1 - dp.peak0) + 0.5e0 AS w01, coalesce(c1 + abs(vs.peak1 - dp.peak1), CAST('inf' AS DOUBLE)) AS w11
    FROM dp JOIN vs ON vs.traj_id = dp.traj_id AND vs.i = dp.i + 1) s),
la AS (SELECT * FROM dp QUALIFY row_number() OVER (PARTITION BY traj_id ORDER BY i DESC) = 1),
ch AS (SELECT traj_id, i, CASE WHEN c0 <= c1 THEN 0 ELSE 1 END AS layer, CASE WHEN c0 <= c1 THEN b0 ELSE b1 END AS came FROM la
  UNION ALL SELECT dp.traj_id, dp.i, came, CASE came WHEN 0 THEN b0 ELSE b1 END FROM ch JOIN dp ON dp.traj_id = ch.traj_id AND dp.i = ch.i - 1),
pa AS (SELECT dp.*, layer, CASE layer WHEN 0 THEN peak0 ELSE peak1 END AS layer_z FROM ch JOIN dp USING (traj_id, i))"""


def _layer_path(spark, d):
    return profiles.road_z_layer_path(_visits(spark, d), carry=("ix", "iy"))


@query(f"{VOTED}, vt AS (SELECT patch_id, ix, iy, count(*) AS n_votes, median(layer_z) AS mid FROM pa GROUP BY ALL) SELECT patch_id, ix, iy, coalesce(n_votes, 0) AS n_votes, round(coalesce(mid, peak0), 6) AS road_z FROM peaks LEFT JOIN vt USING (patch_id, ix, iy)", PT)
def road_z_by_votes(spark, d):
    return rounded(profiles.road_z_by_votes(cells.cell_z_peaks(v.points(spark, d)), _layer_path(spark, d)))


@query(f"{VOTED}, st AS (SELECT *, abs(layer_z - lag(layer_z) OVER (PARTITION BY traj_id ORDER BY i)) AS dz FROM pa) SELECT patch_id, traj_id, count(*) AS n_cells, round(coalesce(median(dz), 0), 6) AS dz_p50, round(coalesce(quantile_cont(dz, 0.9e0), 0), 6) AS dz_p90, round(coalesce(max(dz), 0), 6) AS dz_max, round(avg(layer), 6) AS upper_share FROM st GROUP BY ALL", PT)
def layer_path_stats(spark, d):
    return rounded(profiles.layer_path_stats(_layer_path(spark, d)))


@query(
    """k AS (SELECT patch_id, traj_id, seq, x, y, x AS lx, y AS ly, true AS kept FROM v_traj WHERE seq = 1
      UNION ALL SELECT t.patch_id, t.traj_id, t.seq, t.x, t.y, CASE WHEN sqrt((t.x - lx) ** 2 + (t.y - ly) ** 2) >= 12 THEN t.x ELSE lx END, CASE WHEN sqrt((t.x - lx) ** 2 + (t.y - ly) ** 2) >= 12 THEN t.y ELSE ly END, sqrt((t.x - lx) ** 2 + (t.y - ly) ** 2) >= 12
      FROM k JOIN v_traj t ON t.traj_id = k.traj_id AND t.seq = k.seq + 1), m AS (SELECT traj_id, max(seq) AS last FROM v_traj GROUP BY 1)
    SELECT patch_id, traj_id, seq FROM k JOIN m USING (traj_id) WHERE kept OR seq = last""",
    T,
)
def distance_downsample(spark, d):
    return profiles.distance_downsample(v.traj(spark, d), 12.0).select("patch_id", "traj_id", "seq")


@query(
    f"""{CROSS}, st AS (SELECT *, y - lag(y) OVER w AS g FROM ev WINDOW w AS (PARTITION BY node_id ORDER BY y, traj_id)), cl AS (SELECT *, sum(CAST(coalesce(g > 0.45e0 * 8, false) AS INTEGER)) OVER (PARTITION BY node_id ORDER BY y, traj_id) AS c FROM st),
    ce AS (SELECT node_id, c, count(*) AS n, avg(y) AS centre FROM cl GROUP BY ALL)
    SELECT node_id, CAST(sum(n) AS BIGINT) AS n, count(*) AS n_clusters, max(n) AS main_n, round(max(centre) - min(centre), 6) AS spread, round(max(n) / sum(n), 6) AS main_share, sum(n) >= 4 AND max(centre) - min(centre) > 8 AS multi FROM ce GROUP BY node_id""",
    TX,
)
def channel_split(spark, d):
    return rounded(profiles.channel_split(_events(spark, d), ["node_id"], "traj_id", "y", 8.0))


@query(
    f"""{CROSS}, it AS (SELECT node_id, traj_id, x, y, row_number() OVER (PARTITION BY node_id ORDER BY traj_id) AS r FROM ev), tp AS (SELECT * FROM it WHERE r <= 40),
    su AS (SELECT a.node_id, a.r, a.x AS mx, a.y AS my, round(sum(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2)), 6) AS t FROM tp a JOIN tp b USING (node_id) GROUP BY ALL),
    md AS (SELECT * FROM su QUALIFY row_number() OVER (PARTITION BY node_id ORDER BY t, r) = 1), rd AS (SELECT it.*, round(sqrt((x - mx) ** 2 + (y - my) ** 2), 9) AS d FROM it JOIN md USING (node_id)),
    ce AS (SELECT node_id, list_reduce(list_transform(list(d ORDER BY d), lambda v: [1e0, v]), lambda a, b: CASE WHEN round(b[2] - a[len(a)], 9) <= 3.6e0 THEN list_concat([a[1] + 1], a[2:len(a) - 1], [a[len(a)] + (b[2] - a[len(a)]) / (a[1] + 1)]) ELSE list_concat([1e0], a[2:], [b[2]]) END)[2:] AS c FROM rd WHERE r <= 40 GROUP BY node_id),
    lb AS (SELECT rd.node_id, traj_id, c, list_position(list_transform(c, lambda v: round(abs(d - v), 9)), list_min(list_transform(c, lambda v: round(abs(d - v), 9)))) - 1 AS label FROM rd JOIN ce USING (node_id)),
    sz AS (SELECT node_id, label, count(*) AS size FROM lb GROUP BY ALL), mn AS (SELECT * FROM sz QUALIFY row_number() OVER (PARTITION BY node_id ORDER BY size DESC, label) = 1),
    gr AS (SELECT node_id, count(*) AS n, any_value(len(c)) AS k, any_value(c[len(c)] - c[1]) AS spread FROM lb GROUP BY node_id), g AS (SELECT gr.*, mn.label AS main, mn.size, n >= 4 AND k > 1 AS split FROM gr JOIN mn USING (node_id))
    SELECT node_id, traj_id, CASE WHEN split THEN lb.label ELSE 0 END AS label, n, CASE WHEN split THEN k ELSE 1 END AS n_clusters, CASE WHEN split THEN round(spread, 6) END AS spread, CASE WHEN split THEN main ELSE 0 END AS main_label,
      CASE WHEN split THEN round(size / n, 6) ELSE 1e0 END AS main_share, split AND spread > 8 AS multi, NOT (split AND spread > 8) OR lb.label = main AS kept FROM lb JOIN g USING (node_id)""",
    TX,
)
def channel_labels(spark, d):
    return rounded(profiles.channel_labels(_events(spark, d), ["node_id"], "traj_id", 8.0))


@query(f"{PAIRS}, r AS (SELECT *, row_number() OVER (PARTITION BY src, dst ORDER BY seq_to - seq_from, seq_from, traj_id) AS rank FROM pr) SELECT src, dst, traj_id, rank, CASE WHEN rank > 3 THEN 'beyond_top_k' END AS drop_reason FROM r", TX)
def segment_select(spark, d):
    pairs = zones.traj_pair_candidates(_events(spark, d), LINE)
    got = profiles.segment_select(pairs, ["src", "dst"], [F.col("seq_to") - F.col("seq_from"), F.col("seq_from"), F.col("traj_id")], 3)
    return got.select("src", "dst", "traj_id", "rank", "drop_reason")


@query(f"{RATIO} SELECT patch_id, traj_id, poly_id, CASE WHEN length_m < 5 THEN 'too_short' WHEN ratio < 0.85e0 THEN 'outside_zone' END AS reason FROM rt", TZ)
def segment_filter(spark, d):
    ratio = zones.line_zone_ratio(zones.segments(v.traj(spark, d), LINE), v.zone_edges(spark, d), LINE)
    rows = ratio.withColumns({"crosses_divider": F.lit(False), "n_other": F.lit(0)})
    return rows.select(*LINE, "poly_id", profiles.segment_filter().alias("reason"))


# --- scalar functions ------------------------------------------------------------


@query("SELECT c_custkey, round(radians(lon) * 6378137e0, 3) AS mx, round(ln(tan(radians(greatest(-85.05112878e0, least(85.05112878e0, lat))) / 2 + 0.7853981633974483e0)) * 6378137e0, 3) + 0e0 AS my FROM (SELECT c_custkey, c_custkey % 360 - 180e0 AS lon, c_custkey % 180 - 90e0 AS lat FROM customer)")
def to_mercator(spark, d):
    rows = spark.read.parquet(f"{d}/customer.parquet").selectExpr("c_custkey", "c_custkey % 360 - 180e0D AS lon", "c_custkey % 180 - 90e0D AS lat")
    x, y = scalars.to_mercator(F.col("lon"), F.col("lat"))
    return rounded(rows.select("c_custkey", x.alias("mx"), y.alias("my")), 3)


@query("SELECT c_custkey, round(degrees(x / 6378137e0), 9) AS lon, round(degrees(2 * atan(exp(y / 6378137e0)) - 1.5707963267948966e0), 9) + 0e0 AS lat FROM (SELECT c_custkey, c_custkey * 1000e0 AS x, c_custkey * -777e0 AS y FROM customer)")
def to_lonlat(spark, d):
    rows = spark.read.parquet(f"{d}/customer.parquet").selectExpr("c_custkey", "c_custkey * 1000e0D AS x", "c_custkey * -777e0D AS y")
    lon, lat = scalars.to_lonlat(F.col("x"), F.col("y"))
    return rounded(rows.select("c_custkey", lon.alias("lon"), lat.alias("lat")), 9)


@query("SELECT patch_id, min(x) AS x1, max(x) AS x2, min(y) AS y1, max(y) AS y2, min(x) >= -180 AND max(x) <= 180 AND min(y) >= -90 AND max(y) <= 90 AS geographic FROM v_traj GROUP BY patch_id", T)
def lonlat_detect(spark, d):
    return scalars.lonlat_detect(v.traj(spark, d), ["patch_id"])


@query("SELECT event_id, round(t, 3) AS t FROM (SELECT event_id, epoch_us(ts) / 1e6 AS t FROM events)")
def epoch_normalize(spark, d):
    rows = spark.read.parquet(f"{d}/events.parquet").selectExpr("event_id", "cast(unix_micros(cast(ts AS timestamp)) AS double) AS u")
    raw = F.when(F.col("event_id") % 3 == 0, F.col("u")).when(F.col("event_id") % 3 == 1, F.col("u") / 1e3).otherwise(F.col("u") / 1e6)
    return rounded(rows.select("event_id", scalars.epoch_normalize(raw).alias("t")), 3)


@query(
    """h AS (SELECT traj_id, x - lag(x) OVER w AS dx, y - lag(y) OVER w AS dy FROM v_traj WINDOW w AS (PARTITION BY traj_id ORDER BY seq)), a AS (SELECT traj_id, degrees(atan2(dy, dx)) AS a FROM h WHERE dx IS NOT NULL)
    SELECT traj_id, round((degrees(atan2(avg(sin(radians(a))), avg(cos(radians(a))))) + 720) % 360, 5) % 360 AS mean_deg, round(max(least(abs(a), 360 - abs(a))), 5) AS widest FROM a GROUP BY traj_id""",
    T,
)
def angle_math(spark, d):
    w = Window.partitionBy("traj_id").orderBy("seq")
    rows = v.traj(spark, d).select("traj_id", (F.col("x") - F.lag("x").over(w)).alias("dx"), (F.col("y") - F.lag("y").over(w)).alias("dy")).where("dx IS NOT NULL")
    rows = rows.withColumn("a", scalars.heading_degrees(F.col("dx"), F.col("dy")))
    got = rows.groupBy("traj_id").agg((F.round(scalars.circular_mean(F.col("a")), 5) % 360).alias("mean_deg"), F.round(F.max(scalars.circular_difference(F.col("a"), F.lit(0.0))), 5).alias("widest"))
    return got


STABLE = "sha256(concat_ws('|', road_id, 's', printf('%.3f', length_m), printf('%.3f', length_m / 2), '0'))"


@query(f"SELECT road_id, CAST('0x' || substr({STABLE}, 1, 8) AS BIGINT) % 2147483648 * 4294967296 + CAST('0x' || substr({STABLE}, 9, 8) AS BIGINT) AS node_id FROM v_roads", ("v_roads",))
def stable_node_id(spark, d):
    rows = v.roads(spark, d)
    key = scalars.stable_node_id(F.col("road_id"), F.lit("s"), F.col("length_m"), F.col("length_m") / 2, F.lit(0))
    return rows.select("road_id", key.alias("node_id"))


@query("SELECT o_orderstatus, o_orderpriority, sha1('{\"a\":\"' || o_orderstatus || '\",\"b\":\"' || o_orderpriority || '\"}') AS digest, count(*) AS n FROM orders GROUP BY ALL")
def params_digest(spark, d):
    params = F.create_map(F.lit("b"), F.col("o_orderpriority"), F.lit("a"), F.col("o_orderstatus"))
    rows = spark.read.parquet(f"{d}/orders.parquet")
    return rows.groupBy("o_orderstatus", "o_orderpriority", scalars.params_digest(params).alias("digest")).agg(F.count("*").alias("n"))


@query("SELECT road_id, round(greatest(0, least(1, 0.35e0 + CASE WHEN direction > 0 THEN 0.45e0 ELSE 0 END - CASE WHEN direction = 2 THEN 0.2e0 ELSE 0 END - CASE WHEN length_m > 30 THEN 0.3e0 ELSE 0 END)), 6) AS confidence FROM v_roads", ("v_roads",))
def anchor_confidence(spark, d):
    got = scalars.anchor_confidence(F.col("direction") > 0, F.col("direction") == 2, F.col("length_m") > 30)
    return rounded(v.roads(spark, d).select("road_id", got.alias("confidence")))


@query(f"{PAIRS}, su AS (SELECT src, dst, count(DISTINCT traj_id) AS n, avg(least(1, 1 / (seq_to - seq_from))) AS smooth FROM pr GROUP BY ALL) SELECT src, dst, round(greatest(0, least(1, 0.4e0 * (1 - exp(-n / 2)) + 0.4e0 * least(1, n / 100) + 0.2e0 * greatest(0, least(1, smooth)))), 6) AS confidence FROM su", TX)
def road_confidence(spark, d):
    pairs = zones.traj_pair_candidates(_events(spark, d), LINE)
    rows = pairs.groupBy("src", "dst").agg(F.count_distinct("traj_id").alias("n"), F.avg(F.least(F.lit(1.0), 1 / (F.col("seq_to") - F.col("seq_from")))).alias("smooth"))
    return rounded(rows.select("src", "dst", scalars.road_confidence(F.col("n"), F.col("n") / 100, F.col("smooth")).alias("confidence")))


@query("SELECT outcome, count(*) AS n FROM (SELECT CASE WHEN road_id % 7 = 0 THEN 'built' WHEN direction = 0 THEN 'arc_legality_rejected' WHEN direction = 1 AND road_id % 2 = 0 THEN 'bridge_aware_unresolved' WHEN length_m < 10 THEN 'unresolved_corridor' WHEN length_m > 40 THEN 'slot_mapping_failed' WHEN road_id % 5 = 0 THEN 'final_geometry_invalid' ELSE 'should_be_no_geometry_candidate' END AS outcome FROM v_roads) GROUP BY ALL", ("v_roads",))
def outcome_classify(spark, d):
    flags = {"built": "road_id % 7 = 0", "legal": "direction <> 0", "bridge": "direction = 1", "bridge_resolved": "road_id % 2 <> 0", "corridor": "length_m >= 10", "slot": "length_m <= 40", "valid": "road_id % 5 <> 0"}
    rows = v.roads(spark, d).select(*[F.expr(e).alias(n) for n, e in flags.items()])
    return rows.groupBy(scalars.outcome_classify().alias("outcome")).agg(F.count("*").alias("n"))


# --- reports ---------------------------------------------------------------------

BREAK = "SELECT event_id AS node_id, user_id % 8 AS patch_id, event_type AS code, CASE event_type WHEN 'error' THEN 'hard' WHEN 'purchase' THEN 'soft' ELSE 'info' END AS severity FROM events"


def _breaks(spark, d):
    return spark.read.parquet(f"{d}/events.parquet").selectExpr("event_id AS node_id", "user_id % 8 AS patch_id", "event_type AS code", "CASE event_type WHEN 'error' THEN 'hard' WHEN 'purchase' THEN 'soft' ELSE 'info' END AS severity")


@query(f"WITH b AS ({BREAK}) SELECT code, count(*) AS n FROM b GROUP BY code")
def breakpoint_summary(spark, d):
    return profiles.breakpoint_summary(_breaks(spark, d))


@query(f"WITH b AS ({BREAK}), r AS (SELECT *, row_number() OVER (PARTITION BY patch_id ORDER BY CASE severity WHEN 'hard' THEN 0 WHEN 'soft' THEN 1 ELSE 2 END, code, node_id) AS rank FROM b) SELECT patch_id, rank, code, node_id FROM r WHERE rank <= 20")
def breakpoint_topk(spark, d):
    return profiles.breakpoint_topk(_breaks(spark, d), {"hard": 0, "soft": 1}, 20, ["patch_id"]).select("patch_id", "rank", "code", "node_id")


@query(
    """WITH l AS (SELECT user_id, event_id, event_type || ' ' || value || ' ' || props AS line FROM events), i AS (SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY user_id) AS total FROM l WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
    s AS (SELECT *, sum(octet_length(encode(line)) + 1) OVER (PARTITION BY user_id ORDER BY event_id) AS size FROM i WHERE i <= 60) SELECT user_id, count(*) AS n, max(total) > count(*) AS truncated FROM s WHERE size <= 1024 GROUP BY user_id"""
)
def text_budget(spark, d):
    lines = spark.read.parquet(f"{d}/events.parquet").selectExpr("user_id", "event_id", "concat(event_type, ' ', value, ' ', props) AS line")
    kept = profiles.text_budget(lines, ["user_id"], "event_id", 60, 1024)
    return kept.groupBy("user_id").agg(F.count("*").alias("n"), F.bool_or("truncated").alias("truncated"))


@query("SELECT 'k' AS key, count(*) AS n, 1 AS n_spellings, count(*) AS n_integer, count(DISTINCT props) AS n_values FROM events")
def field_probe(spark, d):
    rows = spark.read.parquet(f"{d}/events.parquet").select(F.from_json("props", "map<string,string>").alias("props"))
    return profiles.field_probe(rows, "props")


@query("SELECT k, count(*) AS n FROM (SELECT CAST(props->>'$.k' AS BIGINT) AS k FROM events) GROUP BY k")
def json_prop_extract(spark, d):
    rows = spark.read.parquet(f"{d}/events.parquet").select(F.get_json_object("props", "$.k").cast("long").alias("k"))
    return rows.groupBy("k").agg(F.count("*").alias("n"))


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN CAST(props->>'$.k' AS BIGINT) ELSE event_id END AS node_id FROM events")
def field_alias_norm(spark, d):
    """First non-null of candidate names, case aside, as an integer."""
    rows = spark.read.parquet(f"{d}/events.parquet")
    props = F.when(F.col("event_id") % 2 == 0, F.create_map(F.lit("NodeID"), F.get_json_object("props", "$.k"))).otherwise(F.create_map(F.lit("MainId"), F.col("event_id").cast("string")))
    low = F.transform_keys(props, lambda k, _: F.lower(k))
    return rows.select("event_id", F.coalesce(*[F.try_element_at(low, F.lit(n)) for n in ("mainnodeid", "nodeid", "mainid")]).try_cast("bigint").alias("node_id"))


@query("SELECT patch_id, CASE WHEN patch_id % 3 = 0 THEN 'done' WHEN patch_id % 3 = 1 THEN 'failed' ELSE 'missing' END AS state FROM (SELECT DISTINCT l_suppkey % 8 AS patch_id FROM lineitem)")
def batch_manifest(spark, d):
    patches = v.points(spark, d).select("patch_id").distinct()
    done = patches.where("patch_id % 3 < 2").selectExpr("patch_id", "CASE WHEN patch_id % 3 = 0 THEN 'done' ELSE 'failed' END AS state")
    return profiles.batch_manifest(done, patches)


@query("SELECT DISTINCT l_suppkey % 8 AS patch_id FROM lineitem WHERE (l_suppkey % 8) % 3 <> 0")
def done_patch_skip(spark, d):
    patches = v.points(spark, d).select("patch_id").distinct()
    return profiles.done_patch_skip(patches, patches.where("patch_id % 3 < 2").selectExpr("patch_id", "CASE WHEN patch_id % 3 = 0 THEN 'done' ELSE 'failed' END AS state"))


@query("WITH f AS (SELECT o_custkey AS patch_id, o_orderstatus AS layer, o_orderkey AS size, o_orderkey || CASE o_orderkey % 3 WHEN 0 THEN '.las' WHEN 1 THEN '.gpkg' ELSE '.GeoJSON' END AS path, CASE o_orderkey % 3 WHEN 0 THEN 2 WHEN 1 THEN 0 ELSE 1 END AS r FROM orders) SELECT patch_id, layer, path FROM f QUALIFY row_number() OVER (PARTITION BY patch_id, layer ORDER BY r, size DESC, path) = 1")
def best_file_per_patch(spark, d):
    files = spark.read.parquet(f"{d}/orders.parquet").selectExpr("o_custkey AS patch_id", "o_orderstatus AS layer", "o_orderkey AS size", "concat(o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN '.las' WHEN 1 THEN '.gpkg' ELSE '.GeoJSON' END) AS path")
    return profiles.best_file_per_patch(files, ["gpkg", "geojson"]).select("patch_id", "layer", "path")


@query("SELECT node_id, src FROM (SELECT o_orderkey + 1 AS node_id, 0 AS src FROM orders UNION ALL SELECT o_orderkey + 2 + o_orderkey % 3 + o_custkey % 11, 1 FROM orders) QUALIFY row_number() OVER (PARTITION BY node_id ORDER BY src) = 1")
def node_union_first_wins(spark, d):
    own = v.nodes(spark, d).select("node_id", F.lit(0).alias("src"))
    virtual = v.roads(spark, d).select(F.col("enode").alias("node_id"), F.lit(1).alias("src")).distinct()
    return profiles.first_wins([own, virtual], ["node_id"], ["src"])


@query(
    """g AS (SELECT traj_id, seq, 1 + CAST(floor(z * 10) AS BIGINT) % 4 AS pieces FROM v_traj), d AS (SELECT *, pieces - coalesce(lag(pieces) OVER (PARTITION BY traj_id ORDER BY seq), 1) AS g FROM g),
    k AS (SELECT traj_id, seq, unnest(range(1, g + 1)) AS k FROM d WHERE g > 0) SELECT traj_id, seq, row_number() OVER (PARTITION BY traj_id ORDER BY seq, k) AS event FROM k QUALIFY row_number() OVER (PARTITION BY traj_id ORDER BY seq, k) <= 5""",
    T,
)
def split_events(spark, d):
    steps = v.traj(spark, d).selectExpr("traj_id", "seq", "1 + floor(z * 10) % 4 AS pieces")
    return profiles.split_events(steps, ["traj_id"], "seq", "pieces", 5).select("traj_id", "seq", "event")


@query(
    """WITH a AS (SELECT 'o' || o_orderkey AS path, 'string' AS kind, o_orderpriority AS value FROM orders), b AS (SELECT 'o' || o_orderkey AS path, 'string' AS kind, CASE WHEN o_orderkey % 97 = 0 THEN 'changed' ELSE o_orderpriority END AS value FROM orders WHERE o_orderkey % 101 <> 0)
    (SELECT *, 'a' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)) UNION ALL (SELECT *, 'b' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a))"""
)
def snapshot_compare(spark, d):
    a = spark.read.parquet(f"{d}/orders.parquet").selectExpr("o_orderkey AS k", "concat('o', o_orderkey) AS path", "'string' AS kind", "o_orderpriority AS value")
    b = a.where("k % 101 <> 0").withColumn("value", F.when(F.col("k") % 97 == 0, "changed").otherwise(F.col("value")))
    return profiles.snapshot_compare(a, b)


# A file for each customer: the list of its orders and their values. The actual ones have lost, changed or retyped some.
SNAP = """WITH k AS (SELECT o_custkey AS file, o_orderkey AS k, 'o' || o_orderkey AS path, 'string' AS kind, o_orderpriority AS value FROM orders),
x AS (SELECT file, k AS ord, path, kind, value FROM k UNION ALL SELECT file, -1, 'root', 'list', CAST(count(*) AS VARCHAR) FROM k GROUP BY file),
y0 AS (SELECT file, path, CASE WHEN k % 53 = 0 THEN 'number' ELSE kind END AS kind, CASE WHEN k % 37 = 0 THEN 'changed' ELSE value END AS value FROM k WHERE k % 101 <> 0),
y AS (SELECT * FROM y0 UNION ALL SELECT file, 'root', 'list', CAST(count(*) AS VARCHAR) FROM y0 GROUP BY file),
c AS (SELECT x.*, y.kind AS ak, y.value AS av, CASE WHEN y.kind IS NULL THEN 'missing' WHEN y.kind <> x.kind THEN 'type_mismatch' WHEN x.value IS DISTINCT FROM y.value THEN CASE x.kind WHEN 'list' THEN 'list_length_mismatch' ELSE 'value_mismatch' END END AS code FROM x LEFT JOIN y ON y.file = x.file AND y.path = x.path)
SELECT file, path, code, CASE code WHEN 'type_mismatch' THEN kind ELSE value END AS expected, CASE code WHEN 'type_mismatch' THEN ak ELSE av END AS actual FROM c WHERE code IS NOT NULL QUALIFY row_number() OVER (PARTITION BY file ORDER BY ord) = 1"""


@query(SNAP)
def snapshot_first_mismatch(spark, d):
    rows = spark.read.parquet(f"{d}/orders.parquet").selectExpr("o_custkey AS file", "o_orderkey AS ord", "concat('o', o_orderkey) AS path", "'string' AS kind", "o_orderpriority AS value")
    lost = rows.where("ord % 101 <> 0").withColumns({"kind": F.when(F.col("ord") % 53 == 0, "number").otherwise(F.col("kind")), "value": F.when(F.col("ord") % 37 == 0, "changed").otherwise(F.col("value"))})
    whole = lambda df: df.unionByName(df.groupBy("file").agg(F.count("*").cast("string").alias("value")).withColumns({"ord": F.lit(-1).cast("long"), "path": F.lit("root"), "kind": F.lit("list")}))
    return profiles.snapshot_first_mismatch(whole(lost), whole(rows))
