"""Reading and writing features, trajectories and points of many patches at once.

Paths follow <root>/<patch_id>/<layer>.<ext>, or <root>/patch_id=<patch_id>/layer=<layer>/<file> as Spark
writes them; the patch and layer come from the path,
so one scan reads any number of patches.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

FEATURES = (
    "struct<type:string,crs:struct<properties:struct<name:string>>,"
    "features:array<struct<properties:map<string,string>,geometry:struct<type:string,coordinates:string>>>>"
)


def _of_path(path: Column) -> dict[str, Column]:
    either = lambda key, plain: F.coalesce(F.nullif(F.regexp_extract(path, rf"/{key}=([^/]+)/", 1), F.lit("")), F.regexp_extract(path, plain, 1))
    return {"patch_id": either("patch_id", r"([^/]+)/[^/]+$"), "layer": either("layer", r"([^/]+)\.[^./]+$")}


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder's path below the one that driver and executors share (spark.checkpoint.dir)."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{shared or tempfile.gettempdir()}/{name}-{uuid.uuid4().hex}"


def scan_geojson(spark: SparkSession, path: str) -> DataFrame:
    """(patch_id, layer, feature_ix, props, geometry_type, coords as JSON, crs) of
    FeatureCollection files. A file that isn't one gives no rows."""
    files = spark.read.option("wholetext", True).text(path).select("value", F.col("_metadata.file_path").alias("path"))
    parsed = files.select("path", F.from_json("value", FEATURES).alias("f"))
    rows = parsed.select("path", F.col("f.crs.properties.name").alias("crs"), F.posexplode("f.features").alias("feature_ix", "feature"))
    names = _of_path(F.col("path"))
    return rows.select(*[c.alias(n) for n, c in names.items()], "feature_ix", F.col("feature.properties").alias("props"), F.col("feature.geometry.type").alias("geometry_type"), F.col("feature.geometry.coordinates").alias("coords"), "crs")


def polyline(coords: Column) -> Column:
    """Array of (x, y) of a LineString's coordinates."""
    return F.transform(F.from_json(coords, "array<array<double>>"), lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))


def point(coords: Column) -> dict[str, Column]:
    p = F.from_json(coords, "array<double>")
    return {"x": p[0], "y": p[1], "z": F.coalesce(F.try_element_at(p, F.lit(3)), F.lit(0.0))}


def scan_traj(features: DataFrame, fields: tuple[str, ...] = ("seq", "frame_id", "idx", "index"), per_row: bool = False) -> DataFrame:
    """Ordered vertices (patch_id, traj_id, seq, x, y, z) of point features: by the first
    of `fields` that is a number in all features of the file, else in file order. With `per_row` each feature goes by the first
    of `fields` that is a number in it, else by its timestamp in ms, else by its place in the file."""
    rows = features.where("geometry_type = 'Point'")
    low = F.transform_keys("props", lambda k, _: F.lower(k))
    values = {f"_k{i}": F.try_element_at(low, F.lit(f)).try_cast("double") for i, f in enumerate(fields)}
    rows = rows.withColumns(values)
    whole = Window.partitionBy("patch_id", "layer")
    pick = F.col("feature_ix").cast("double")
    if per_row:
        pick = F.coalesce(*[F.col(n) for n in values], F.try_element_at(low, F.lit("timestamp")).try_cast("double") * 1000, pick)
    else:
        for name in reversed(values):
            pick = F.when(F.min(F.col(name).isNotNull()).over(whole), F.col(name)).otherwise(pick)
    rows = rows.withColumns({"_key": pick} | point(F.col("coords")))
    order = Window.partitionBy("patch_id", "layer").orderBy("_key", "feature_ix")
    return rows.select("patch_id", F.col("layer").alias("traj_id"), (F.row_number().over(order) - 1).alias("seq"), "x", "y", "z")


def patch_inventory(spark: SparkSession, path: str, layers: list[str]) -> DataFrame:
    """One row for each patch: how many files each layer has, from the listing alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
    return files.select(*[c.alias(n) for n, c in _of_path(F.col("path")).items()]).groupBy("patch_id").pivot("layer", layers).count().na.fill(0)


def layer_alias_resolve(files: DataFrame, aliases: dict[str, str]) -> DataFrame:
    """A patch's file for each primary layer, else that of its legacy name, with a note."""
    names = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])
    primary = F.coalesce(F.try_element_at(names, F.col("layer")), F.col("layer"))
    rows = files.withColumn("primary", primary).withColumn("legacy", F.col("layer") != F.col("primary"))
    best = Window.partitionBy("patch_id", "primary").orderBy("legacy", "path")
    out = rows.withColumn("_r", F.row_number().over(best)).where("_r = 1")
    return out.select("patch_id", F.col("primary").alias("layer"), "path", F.when(F.col("legacy"), F.concat(F.lit("legacy_name:"), F.col("layer"))).alias("note"))


#: Column names of points, by priority, in any case.
POINT_NAMES = {"x": ("x", "easting", "lon"), "y": ("y", "northing", "lat"), "z": ("z", "height", "elevation"), "cls": ("classification", "class", "cls", "label")}


def scan_points(spark: SparkSession, path: str, file_format: str = "parquet", names: dict[str, tuple[str, ...]] = POINT_NAMES) -> DataFrame:
    """(patch_id, x, y, z, cls) of point tables, of which each coordinate is the first column that `names` lists for it; z and cls may be
    missing (0 and null). Rows without finite x and y are left out. The patch comes from the path."""
    found = spark.read.format(file_format).options(**({"header": True} if file_format == "csv" else {})).load(path)
    columns = {c.lower(): c for c in found.columns}
    pick = {key: next((columns[n] for n in own if n in columns), None) for key, own in names.items()}
    if not (pick["x"] and pick["y"]):
        raise ValueError(f"no columns for x and y among {found.columns}")
    value = lambda c: F.col(f"`{c}`").try_cast("double")
    patch = F.col(columns["patch_id"]).cast("string") if "patch_id" in columns else _of_path(F.col("_metadata.file_path"))["patch_id"]
    rows = found.select(
        patch.alias("patch_id"), value(pick["x"]).alias("x"), value(pick["y"]).alias("y"), (value(pick["z"]) if pick["z"] else F.lit(0.0)).alias("z"),
        (F.col(f"`{pick['cls']}`").try_cast("int") if pick["cls"] else F.lit(None).cast("int")).alias("cls"),
    )
    finite = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    return rows.where(finite("x") & finite("y"))


def thin_points(points: DataFrame, most: int) -> DataFrame:
    """Every k-th point of a patch, so that about `most` are left (a feature of the scan)."""
    n = points.groupBy("patch_id").agg(F.count("*").alias("_n"))
    k = F.greatest(F.lit(1), F.ceil(F.col("_n") / most))
    return points.join(n, "patch_id").where(F.pmod(F.xxhash64("point_id"), k) == 0).drop("_n")


def aoi_prefilter(features: DataFrame, boxes: DataFrame, margin: float) -> DataFrame:
    """Features whose box (x1, y1, x2, y2) meets their patch's box with a margin."""
    b = boxes.select("patch_id", *[F.col(c).alias(f"_{c}") for c in ("x1", "y1", "x2", "y2")])
    hit = "x1 <= _x2 + {m} AND x2 >= _x1 - {m} AND y1 <= _y2 + {m} AND y2 >= _y1 - {m}".format(m=margin)
    return features.join(b, "patch_id").where(hit).drop("_x1", "_y1", "_x2", "_y2")


def point_window(points: DataFrame, boxes: DataFrame, classes: list[int]) -> DataFrame:
    """Points in their patch's box of the given classes; of all classes, where there are none."""
    inside = aoi_prefilter(points.withColumns({"x1": F.col("x"), "x2": F.col("x"), "y1": F.col("y"), "y2": F.col("y")}), boxes, 0.0).drop("x1", "y1", "x2", "y2")
    own = inside.groupBy("patch_id").agg(F.count_if(F.col("cls").isin(classes)).alias("_n"))
    return inside.join(own, "patch_id").where((F.col("_n") == 0) | F.col("cls").isin(classes)).drop("_n")


def sink_features(rows: DataFrame, path: str, geometry: Column, props: list[str]) -> None:
    """Writes one GeoJSON feature a line, in a folder for each patch."""
    feature = F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(*props).alias("properties"), geometry.alias("geometry")))
    rows.select("patch_id", feature.alias("value")).write.partitionBy("patch_id").mode("overwrite").text(path)


def sink_collections(rows: DataFrame, path: str, order: str, geometry: Column, props: list[str], most: int = 100_000) -> None:
    """Writes FeatureCollections, one file for each patch_id and layer, or several of at most `most` features each, in
    the order of a column `order` that counts from 0."""
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(*props).alias("properties"), geometry.alias("geometry"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), feature.alias("f")))), lambda e: e.f)
    whole = rows.groupBy("patch_id", "layer", F.floor(F.col(order) / most).alias("_part")).agg(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), listed.alias("features"))).alias("value"))
    whole.drop("_part").repartition("patch_id", "layer").write.partitionBy("patch_id", "layer").mode("overwrite").option("maxRecordsPerFile", 1).text(path)


def sink_cell_csv(cells: DataFrame, path: str) -> None:
    cells.write.mode("overwrite").option("header", True).csv(path)


def export_verify(written: DataFrame, expected: DataFrame) -> DataFrame:
    """Per patch: rows and class-2 rows written against those expected, and the box."""
    count = lambda df, p: df.groupBy("patch_id").agg(F.count("*").alias(f"{p}_n"), F.count_if(F.col("cls") == 2).alias(f"{p}_ground"), F.min("x").alias(f"{p}_x1"), F.max("x").alias(f"{p}_x2"))
    rows = count(written, "w").join(count(expected, "e"), "patch_id", "full_outer")
    return rows.withColumn("ok", F.coalesce((F.col("w_n") == F.col("e_n")) & (F.col("w_ground") == F.col("e_ground")) & (F.col("w_x1") == F.col("e_x1")) & (F.col("w_x2") == F.col("e_x2")), F.lit(False)))
