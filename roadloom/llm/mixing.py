"""Operator 5: mixing sources to target weights by Efraimidis-Spirakis sampling, in
DataFrame operations alone.

A source's documents are put in the order of exponential keys, -ln(u) / weight with u
in (0, 1) from a hash of the document: the order of weighted sampling without
replacement. A source with target T and size S is taken floor(T / S) whole times (its
complete epochs); then documents are taken once more in order until the rest of T is
met. Where the running sum crosses the rest, the document that crosses it is taken if
that brings the sum nearer.

The running sum has two levels. 1 - exp(-key) is cut into BUCKETS equal ranges; sums
of these are small, and only documents in the range where a source's sum crosses its
rest are put in order one by one. So no task sorts a whole source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, keep, small

BUCKETS = 4096
SOURCE_WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """Between 0.25 and 1, by the share of characters other than ASCII digits and marks,
    and that of distinct ones among the lines that aren't empty."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    prose = F.length(F.regexp_replace(text, r"[\x21-\x40\x5B-\x60\x7B-\x7E]+", "")) / F.greatest(F.length(text), F.lit(1))
    lines = F.filter(F.split(text, "\n"), lambda x: x != "")
    distinct = F.size(F.array_distinct(lines)) / F.greatest(F.size(lines), F.lit(1))
    return 0.25 + 0.75 * prose * distinct


def targets(sources: DataFrame) -> DataFrame:
    """`sources` (source, source_size), one row for each, with weight and target.

    Sources in code point order, null last, weigh 5, 2, 1, repeating, and share the
    sum of all sizes by weight. A target stops at 3 times its source's size; the
    excess is shared among the others by weight until none is above. Sources are
    settled in ascending order of limit / weight: with those before it at their
    limits, a source stops at its own if an equal share by weight would exceed it.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(float(w)) for w in SOURCE_WEIGHTS])
    rows = sources.withColumn("rank", F.row_number().over(order))
    rows = rows.withColumn("weight", F.element_at(weights, (F.col("rank") - 1) % len(SOURCE_WEIGHTS) + 1))
    rows = rows.withColumn("limit", MOST_EPOCHS * F.col("source_size").cast("double"))
    fill = Window.orderBy(F.col("limit") / F.col("weight"), "rank")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("left", F.sum("source_size").over(whole) - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
    rows = rows.withColumn("level", F.col("left") / F.sum("weight").over(after))
    # The first source whose limit is not below its share fixes the level of the rest.
    open_level = F.when(F.col("limit") >= F.col("level") * F.col("weight"), F.col("level"))
    every = fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("final", F.first(open_level, ignorenulls=True).over(every))
    return rows.select("source", "source_size", "weight", F.least("limit", F.coalesce(F.col("final") * F.col("weight"), F.col("limit"))).alias("target"))


def exponential(doc: Column) -> Column:
    """-ln(u); u has 52 bits of an MD5 digest and is never 0 or 1."""
    digits = F.conv(F.substring(F.md5(doc.cast("binary")), 1, 13), 16, 10).cast("double")
    return -F.log((digits + 0.5) / float(16**13))


RESULT = ("size", "source_size", "target", "taken", "times")


def mix(docs: DataFrame, weight: Column | None = None) -> DataFrame:
    """`docs` (doc_id, text, source and any others) with size, source_size, target, taken
    and times, one row per row. Columns of docs with these names give way; others may
    have any name.

    size is the number of words (runs of characters other than ASCII white space); null
    text has none. `weight` is a positive quality weight of a document; null or not
    positive counts as 1, as does leaving it out. A null source is a source of its own,
    the last. Rows with equal ids are told apart by their texts; fully equal rows are
    taken alike. Null ids have keys like others. Rows without words are taken with the
    others at no cost (taken 0). An empty table gives an empty result, and sources without words have target 0.

    Sources are put in order in one task, a row each: any number that a mix would name.
    A range of keys holds BUCKETS-th of a source times the ratio of the weights at most.
    """
    own = [c for c in docs.columns if c.lower() not in RESULT]
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"))
    weight = F.lit(1.0) if weight is None else weight.cast("double")
    weight = F.when(weight > 0, weight).otherwise(1.0)
    # What docs has goes into one struct, so that its names meet none of those below.
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"), F.xxhash64("doc_id", "text").alias("rid"), F.col("source").alias("host"),
        word_count(F.col("text").cast("string")).alias("n"), exponential(name).alias("key"), weight.alias("weight"),
    ).withColumn("key", F.col("key") / F.col("weight"))
    # Kept with the rows, so that texts are measured and weighed once; columns that the
    # caller drops are not read again.
    rows = keep(rows, "sizes")
    sized = rows.drop("row")
    # In units of the smallest weight, no range has more than its share times the ratio of weights.
    least = sized.agg(F.min("weight")).first()[0] or 1.0
    bucket = F.floor((1 - F.exp(-F.col("key") * least)) * BUCKETS).cast("int")
    sized = sized.withColumn("bucket", bucket)

    sources = targets(sized.groupBy(F.col("host").alias("source")).agg(F.sum("n").alias("source_size")))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    sources = sources.withColumn("epochs", epochs).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    sources = keep(sources, "sources")

    same = F.col("host").eqNullSafe(F.col("source"))
    running = Window.partitionBy("host").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = sized.groupBy("host", "bucket").agg(F.sum("n").alias("words")).withColumn("before", F.coalesce(F.sum("words").over(running), F.lit(0)))
    crossing = (
        buckets.join(small(sources), same)
        .where((F.col("before") < F.col("rest")) & (F.col("before") + F.col("words") >= F.col("rest")))
        .groupBy(F.col("source").alias("crossed"))
        .agg(F.min("bucket").alias("at"), F.min_by("before", "bucket").alias("upto"))
    )
    plan = keep(sources.join(crossing, F.col("source").eqNullSafe(F.col("crossed")), "left").drop("crossed"), "mix")

    # Documents of the crossing ranges, one by one; equal keys by their size and hash.
    place = F.struct("key", "n", "rid")
    edge = sized.join(small(plan), same).where(F.col("bucket") == F.col("at"))
    inside = Window.partitionBy("host").orderBy("key", "n", "rid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = edge.withColumn("sum", F.col("upto") + F.sum("n").over(inside))
    more = (F.col("sum") <= F.col("rest")) | ((F.col("sum") - F.col("n") < F.col("rest")) & (2 * (F.col("rest") - F.col("sum") + F.col("n")) > F.col("n")))
    last = edge.where(more).groupBy(F.col("host").alias("crossed")).agg(F.max(place).alias("last"))
    plan = plan.join(last, F.col("source").eqNullSafe(F.col("crossed")), "left").select("source", "source_size", "target", "epochs", "rest", "at", "last")

    # A document is taken once more if it stands before its source's last one.
    once = F.when(F.col("rest") <= 0, 0).when(F.col("at").isNull(), 1).when(F.col("bucket") != F.col("at"), (F.col("bucket") < F.col("at")).cast("int"))
    once = once.otherwise(F.coalesce(place <= F.col("last"), F.lit(False)).cast("int"))
    out = rows.withColumn("bucket", bucket).join(small(plan), same).withColumn("times", F.col("epochs") + once)
    return out.select("row.*", F.col("n").alias("size"), "source_size", "target", (F.col("times") * F.col("n")).alias("taken"), "times")
