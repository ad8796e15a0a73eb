"""Pieces shared by the corpus operators: table access, stage files, graph labels.

Stage files: `keep()` writes a DataFrame as Parquet below the shared folder named
by `spark.checkpoint.dir` and reads it back, which cuts the lineage and survives a
lost executor. Where that setting is absent, a local session (tests, a laptop) uses a
folder of its machine; on a cluster that is an error. `discard()` deletes what a session
has kept, once its results are written.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word: a run of anything but ASCII white space (Java and RE2 syntax alike).
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

# Largest number of rows that a side may have to be broadcast by hand.
BROADCAST_ROWS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z only, whatever the locale."""
    return F.translate(c, UPPER, LOWER)


def fold(col: str, remainder: int) -> Column:
    """crc32 of doc_id as text, modulo `remainder`."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % remainder


def shared_dir(spark: SparkSession) -> str:
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return tempfile.gettempdir() + "/roadloom-stages"


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of 4 MB, unless the session says otherwise: 10,000 texts, as many
    as a batch has by default, may be any size."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, str(2**31 - 1)) == str(2**31 - 1):
        spark.conf.set(key, 4 << 20)


_kept: list[str] = []


def keep(df: DataFrame, name: str) -> DataFrame:
    """`df` as a Parquet table in the shared folder."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _kept.append(path)
    return spark.read.schema(df.schema).parquet(path)


def release(*tables: DataFrame) -> None:
    """Deletes tables from keep() that nothing reads any more."""
    for table in tables:
        files = table.inputFiles()
        if files:
            path = files[0].rsplit("/", 1)[0]
            spark = table.sparkSession
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


def discard(spark: SparkSession) -> None:
    """Deletes the tables kept so far. Results that still read them can't be used after it."""
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    while _kept:
        path = jvm.org.apache.hadoop.fs.Path(_kept.pop())
        path.getFileSystem(conf).delete(path, True)


def small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """`df` with a broadcast hint if it is proven to have at most `most` rows."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def components(edges: DataFrame, name: str) -> DataFrame:
    """(id, label): the smallest id that each id of `edges` (a, b) reaches.

    Alternating large-star and small-star rounds: in each, an id's larger
    neighbours are tied to the smallest one it knows. Neighbour lists are only ever
    aggregated (min), never collected, and the number of rounds grows with the
    logarithm of the longest path.
    """
    edges = keep(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        name,
    )
    n, stars = _state(edges)
    while not stars:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # Broadcast where it must be small. Else kept apart from its own shuffle, so that
        # Spark can split an id with many neighbours.
        aside = F.broadcast if n <= BROADCAST_ROWS else lambda df: keep(df, name)
        large = both.join(aside(low), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small_star = (
            large.join(aside(least), "a")
            .select(F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("m").alias("y")), F.struct(F.col("b").alias("x"), F.col("m").alias("y")))).alias("e"))
            .where("e.x <> e.y")
            .select(F.greatest("e.x", "e.y").alias("a"), F.least("e.x", "e.y").alias("b"))
            .distinct()
        )
        new = keep(small_star, name)
        release(edges)
        edges = new
        n, stars = _state(edges)
    return edges.select(F.col("a").alias("id"), F.col("b").alias("label")).union(
        edges.select(F.col("b").alias("id"), F.col("b").alias("label")).distinct()
    )


def _state(edges: DataFrame) -> tuple[int, bool]:
    """How many edges (a, b) there are, and whether each leads from an id to a root: no b is
    itself an a, and no a has two. One job with one shuffle, so that a round leaves little with the driver."""
    ends = edges.select(F.col("a").alias("id"), F.lit(1).alias("out"), F.lit(0).alias("met")).union(edges.select("b", F.lit(0), F.lit(1)))
    ids = ends.groupBy("id").agg(F.sum("out").alias("out"), F.max("met").alias("met"))
    n, open_ = ids.agg(F.sum("out"), F.count_if(F.expr("out > 1 or (out = 1 and met = 1)"))).first()
    return n or 0, not open_
