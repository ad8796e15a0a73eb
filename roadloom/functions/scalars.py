"""Column expressions: kinds, directions, angles, projections, times, ids and rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH = 6378137.0
MAX_LATITUDE = 85.05112878


# --- coordinates -----------------------------------------------------------------


def to_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    lat = F.greatest(F.lit(-MAX_LATITUDE), F.least(F.lit(MAX_LATITUDE), lat))
    return F.radians(lon) * EARTH, F.log(F.tan(F.radians(lat) / 2 + F.lit(0.7853981633974483))) * EARTH


def to_lonlat(x: Column, y: Column) -> tuple[Column, Column]:
    return F.degrees(x / EARTH), F.degrees(2 * F.atan(F.exp(y / EARTH)) - F.lit(1.5707963267948966))


def lonlat_detect(rows: DataFrame, by: list[str]) -> DataFrame:
    """Per layer: whether its box lies within ±180, ±90 degrees."""
    box = rows.groupBy(*by).agg(F.min("x").alias("x1"), F.max("x").alias("x2"), F.min("y").alias("y1"), F.max("y").alias("y2"))
    inside = (F.col("x1") >= -180) & (F.col("x2") <= 180) & (F.col("y1") >= -90) & (F.col("y2") <= 90)
    return box.withColumn("geographic", F.coalesce(inside, F.lit(False)))


# --- angles ----------------------------------------------------------------------


def heading_degrees(dx: Column, dy: Column) -> Column:
    return F.pmod(F.degrees(F.atan2(dy, dx)) + 360, F.lit(360.0))


def signed_delta(source: Column, target: Column) -> Column:
    """Turn from source to target in [-180, 180)."""
    return F.pmod(target - source + 180, F.lit(360.0)) - 180


def circular_difference(a: Column, b: Column) -> Column:
    return F.abs(signed_delta(a, b))


def circular_mean(angle: Column) -> Column:
    """Aggregate: mean direction in degrees."""
    return F.pmod(F.degrees(F.atan2(F.avg(F.sin(F.radians(angle))), F.avg(F.cos(F.radians(angle))))) + 360, F.lit(360.0))


# --- nodes and roads -------------------------------------------------------------

# Bits of a node's kind.
CROSS, MERGE, DIVERGE, K16 = 1 << 2, 1 << 3, 1 << 4, 1 << 16


def has_kind(kind: Column, bit: int) -> Column:
    return F.coalesce(kind.bitwiseAND(F.lit(bit)) != 0, F.lit(False))


def node_type(kind: Column) -> Column:
    merge, diverge = has_kind(kind, MERGE), has_kind(kind, DIVERGE)
    return F.when(merge & diverge, "merge_diverge").when(merge, "merge").when(diverge, "diverge").when(has_kind(kind, CROSS), "cross").otherwise("unknown")


def chain_edges_of(roads: DataFrame) -> DataFrame:
    """Directed edges of the chain graph: direction 2 as drawn, 3 reversed, no others."""
    back = F.col("direction") == 3
    return roads.where(F.col("direction").isin(2, 3)).select(
        F.when(back, F.col("enode")).otherwise(F.col("snode")).alias("src"),
        F.when(back, F.col("snode")).otherwise(F.col("enode")).alias("dst"),
        F.col("road_id").alias("edge_id"),
        F.greatest(F.lit(0.0), F.col("length_m")).alias("length_m"),
    )


def arc_edges_of(roads: DataFrame) -> DataFrame:
    """Directed edges of the arc graph: all as drawn but direction 3."""
    back = F.coalesce(F.col("direction") == 3, F.lit(False))
    return roads.select(
        F.when(back, F.col("enode")).otherwise(F.col("snode")).alias("src"),
        F.when(back, F.col("snode")).otherwise(F.col("enode")).alias("dst"),
        F.col("road_id").alias("edge_id"),
        "length_m",
    )


def movement_sides(roads: DataFrame, node: str = "node_id") -> DataFrame:
    """Entry and exit rows of roads at a node: both for two-way (0, 1 or none), else by
    which end the node is. `at_end`: whether the node is the road's end node."""
    forward = F.col("direction") == 2
    entry = (forward & F.col("at_end")) | ((F.col("direction") == 3) & ~F.col("at_end"))
    sides = F.when(F.col("direction").isNull() | F.col("direction").isin(0, 1), F.array(F.lit("entry"), F.lit("exit"))).when(entry, F.array(F.lit("entry"))).otherwise(F.array(F.lit("exit")))
    return roads.withColumn("side", F.explode(sides))


# --- values ----------------------------------------------------------------------


def epoch_normalize(value: Column) -> Column:
    """Seconds from seconds, milliseconds (above 1e11) or microseconds (above 1e14)."""
    size = F.abs(value)
    return F.when(size > 1e14, value / 1e6).when(size > 1e11, value / 1e3).otherwise(value.cast("double"))


def stable_node_id(road: Column, side: Column, x: Column, y: Column, salt: Column) -> Column:
    """First eight bytes of a SHA-256 over the parts joined by bars, without the sign."""
    text = F.concat_ws("|", road.cast("string"), side, F.format_string("%.3f", x), F.format_string("%.3f", y), salt.cast("string"))
    digest = F.sha2(text, 256)
    high = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long").bitwiseAND(F.lit(0x7FFFFFFF))
    return F.shiftleft(high, 32).bitwiseOR(F.conv(F.substring(digest, 9, 8), 16, 10).cast("long"))


def params_digest(params: Column) -> Column:
    """SHA-1 of a map's entries in key order, as JSON."""
    return F.sha1(F.to_json(F.map_from_entries(F.array_sort(F.map_entries(params)))))


def clamp(c: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def anchor_confidence(found: Column, ambiguous: Column, far: Column) -> Column:
    flag = lambda c, w: F.when(c, w).otherwise(0.0)
    return clamp(F.lit(0.35) + flag(found, 0.45) + flag(ambiguous, -0.20) + flag(far, -0.30))


def road_confidence(support: Column, coverage: Column, smooth: Column, weights: tuple[float, float, float] = (0.4, 0.4, 0.2)) -> Column:
    a, b, c = weights
    return clamp(a * (1 - F.exp(-support / 2)) + b * clamp(coverage) + c * clamp(smooth))


def outcome_classify() -> Column:
    """Where a road ended, from the stage flags of its arc, the first that applies."""
    return (
        F.when(F.col("built"), "built")
        .when(~F.col("legal"), "arc_legality_rejected")
        .when(F.col("bridge") & ~F.col("bridge_resolved"), "bridge_aware_unresolved")
        .when(~F.col("corridor"), "unresolved_corridor")
        .when(~F.col("slot"), "slot_mapping_failed")
        .when(~F.col("valid"), "final_geometry_invalid")
        .otherwise("should_be_no_geometry_candidate")
    )


# The WGS84 ellipsoid and the scale of a UTM zone.
WGS84_A, WGS84_F, UTM_SCALE = 6378137.0, 1 / 298.257223563, 0.9996


def utm_zone(lon: Column) -> Column:
    return F.floor((lon + 180) / 6).cast("int") + 1


def to_utm(lon: Column, lat: Column, zone: Column) -> tuple[Column, Column]:
    """Easting and northing in a UTM zone by the usual series in powers of the distance
    from the central meridian."""
    e2 = WGS84_F * (2 - WGS84_F)
    p, dl = F.radians(lat), F.radians(lon - (zone * 6 - 183))
    n = WGS84_A / F.sqrt(1 - e2 * F.sin(p) ** 2)
    t, c, a = F.tan(p) ** 2, e2 / (1 - e2) * F.cos(p) ** 2, dl * F.cos(p)
    k0 = 1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256
    k2 = 3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024
    k4, k6 = 15 * e2**2 / 256 + 45 * e2**3 / 1024, 35 * e2**3 / 3072
    m = WGS84_A * (k0 * p - k2 * F.sin(2 * p) + k4 * F.sin(4 * p) - k6 * F.sin(6 * p))
    q = e2 / (1 - e2)
    x = UTM_SCALE * n * (a + (1 - t + c) * a**3 / 6 + (5 - 18 * t + t**2 + 72 * c - 58 * q) * a**5 / 120) + 500_000
    y = UTM_SCALE * (m + n * F.tan(p) * (a**2 / 2 + (5 - t + 9 * c + 4 * c**2) * a**4 / 24 + (61 - 58 * t + t**2 + 600 * c - 330 * q) * a**6 / 720))
    return x, F.when(lat < 0, y + 10_000_000).otherwise(y)


def layer_crs_inherit(layers: DataFrame) -> DataFrame:
    """CRS of each layer (patch_id, layer, declared, max_abs) and how it is known: declared,
    by the size of its coordinates, or the patch's most common declared one."""
    by_size = F.when(F.col("max_abs") <= 180, "EPSG:4326").when(F.col("max_abs") > 1000, "EPSG:3857")
    counts = layers.where("declared IS NOT NULL").groupBy("patch_id", "declared").agg(F.count("*").alias("n"))
    patch = counts.groupBy("patch_id").agg(F.min_by("declared", F.struct(-F.col("n"), F.col("declared"))).alias("patch_crs"))
    rows = layers.join(patch, "patch_id", "left")
    how = F.when(F.col("declared").isNotNull(), "declared").when(by_size.isNotNull(), "coordinate_scale").when(F.col("patch_crs").isNotNull(), "patch").otherwise("unknown")
    return rows.select("patch_id", "layer", F.coalesce("declared", by_size, "patch_crs").alias("crs"), how.alias("method"))
