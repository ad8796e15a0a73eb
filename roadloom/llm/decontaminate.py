"""Operator 3: benchmark passages in documents, in DataFrame operations alone.

Words are runs of letters and digits, lower-cased; shingles are runs of five words
(of a shorter item, the whole item). A window is a run of an item's number of words.

1. A window and an item that share no shingle have similarity 0, so windows are
   placed only where a shingle of the document is one of the benchmark's: at the start
   that puts this shingle at its place in the item.
2. Each window gets a 64-bit SimHash of its weighted shingles, as has each item.
3. Multi-index Hamming blocks: both are cut into five blocks of 13 bits (the last has
   12). Within a radius of 19 some block differs in at most 3 bits, so a table of all
   such variants of the items' blocks (1,811 for each) finds every item within the
   radius of a window. The table grows with the benchmark, not with the documents; up to
   a million rows of it are broadcast.
4. Candidates are verified by their exact weighted Jaccard similarity: the sum of the
   smaller weights over that of the larger. A shingle's weight is its number of
   occurrences.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep, small

BLOCKS, BLOCK_BITS, RADIUS = 5, 13, 19


def words_of(text: Column) -> Column:
    """Array of the lower-cased runs of letters and digits."""
    return F.split(F.regexp_replace(F.lower(text), r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", ""), r"[^\p{L}\p{N}]+", -1)


def shingle_hashes(words: Column, k: int | Column) -> Column:
    """Hash of each run of k words; empty where there are fewer words."""
    last = F.size(words) - k + 1
    return F.when(last >= 1, F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice(words, i, k)))).otherwise(F.array().cast("array<bigint>"))


def simhash64(rows: DataFrame, key: list[str]) -> DataFrame:
    """`key` and fingerprint of rows (key..., h, weight)."""
    votes = [F.expr(f"sum(if(shiftright(h, {b}) & 1 = 1, weight, -weight)) AS v{b}") for b in range(64)]
    word = " | ".join(f"if(v{b} > 0, shiftleft(1L, {b}), 0L)" for b in range(64))
    return rows.groupBy(*key).agg(*votes).select(*key, F.expr(word).alias("fingerprint"))


def _block(i: int) -> Column:
    return F.shiftrightunsigned("fingerprint", i * BLOCK_BITS).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1))


def flips(i: int) -> list[int]:
    """Words of block i with as many bits as some block differs in at most."""
    bits = min(BLOCK_BITS, 64 - i * BLOCK_BITS)
    return [sum(1 << b for b in c) for r in range(RADIUS // BLOCKS + 1) for c in combinations(range(bits), r)]


def near_items(windows: DataFrame, items: DataFrame) -> DataFrame:
    """(key..., item_id) of windows and items whose fingerprints differ in at most
    RADIUS bits. `windows` has the columns rid, start, size, fingerprint."""
    cut = [F.struct(F.lit(i).alias("i"), _block(i).alias("v")) for i in range(BLOCKS)]
    blocks = F.explode(F.array(*cut)).alias("b")
    words = [f"array({', '.join(f'{f}L' for f in flips(i))})" for i in (0, BLOCKS - 1)]
    variants = items.select("item_id", F.col("fingerprint").alias("item_fingerprint"), blocks).select("item_id", "item_fingerprint", "b.i", F.col("b.v").alias("block"))
    flip = F.explode(F.expr(f"if(i < {BLOCKS - 1}, {words[0]}, {words[1]})")).alias("flip")
    variants = variants.select("item_id", "item_fingerprint", "i", "block", flip)
    variants = keep(variants.select("item_id", "item_fingerprint", "i", F.col("block").bitwiseXOR(F.col("flip")).alias("v")), "variants")
    keyed = windows.select("rid", "start", "size", "fingerprint", blocks).select("rid", "start", "size", "fingerprint", "b.i", "b.v")
    near = F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("item_fingerprint"))) <= RADIUS
    return keyed.join(small(variants, 1_000_000), ["i", "v"]).where(near).select("rid", "start", "size", "item_id").distinct()


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, item_id, similarity, start_word) of every document and item for which
    some window is similar enough: 100 * similarity >= percent. start_word (from 0) is
    the first word of the most similar window, the first of equal ones.

    Null, empty and wordless texts or items match nothing; null ids pass through as
    null. Repeated rows give one result; several texts under one id are searched each,
    and the best window of all is reported. Items with equal texts are reported each.
    Other columns are not read. Whole texts are searched.
    """
    bench = benchmark.select(F.col("item_id").cast("long").alias("item_id"), words_of(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("words"))
    bench = bench.where(F.element_at("words", 1) != "").select("item_id", "words", F.size("words").alias("size"), F.least(F.size("words"), F.lit(k)).alias("k")).distinct()
    # Several items under one id are told apart by their number.
    bench = bench.withColumn("item", F.xxhash64("item_id", "words"))
    bench = bench.withColumn("h", F.expr("transform(sequence(1, size - k + 1), i -> xxhash64(slice(words, i, k)))"))
    bench = keep(bench.select("item_id", "item", "size", "k", "h"), "items")
    widths = sorted(r["k"] for r in bench.select("k").distinct().collect())  # at most k values
    if not widths:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, similarity double, start_word int")

    placed = bench.select("item", "size", "k", F.posexplode("h").alias("at", "h"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("rid", F.xxhash64("doc_id", "text"))
    known = small(placed.select("k", "h").distinct())
    worded = rows.select("rid", words_of(F.col("text")).alias("words"))
    hits = None
    for w in widths:
        found = worded.select("rid", F.size("words").alias("n"), F.posexplode(shingle_hashes(F.col("words"), w)).alias("pos", "h"))
        found = found.join(known.where(F.col("k") == w).select("h"), "h")
        found = found.withColumn("k", F.lit(w))
        hits = found if hits is None else hits.union(found)
    starts = hits.join(placed, ["k", "h"]).select("rid", "size", "k", F.greatest(F.lit(0), F.least(F.col("pos") - F.col("at"), F.col("n") - F.col("size"))).alias("start"))
    starts = keep(starts.distinct(), "windows")

    # Shingles of the windows, from the texts of the documents that have any.
    own = rows.join(small(starts.select("rid").distinct(), 1_000_000), "rid", "left_semi").dropDuplicates(["rid"])
    own = own.select("rid", "doc_id", words_of(F.col("text")).alias("words"))
    spans = starts.join(own, "rid").select("rid", "doc_id", "size", "start", "k", F.slice("words", F.col("start") + 1, F.col("size")).alias("words"))
    spans = spans.where("size(words) >= k").select("rid", "doc_id", "size", "start", F.expr("transform(sequence(1, size(words) - k + 1), i -> xxhash64(slice(words, i, k)))").alias("h"))
    terms = keep(spans.select("rid", "doc_id", "size", "start", F.explode("h").alias("h")).groupBy("rid", "doc_id", "size", "start", "h").agg(F.count("*").alias("weight")), "terms")
    item_terms = bench.select("item", F.explode("h").alias("h")).groupBy("item", "h").agg(F.count("*").alias("weight"))

    fingerprints = simhash64(terms, ["rid", "start", "size"])
    items = simhash64(item_terms, ["item"]).withColumnsRenamed({"item": "item_id"})
    near = near_items(fingerprints, items).withColumnsRenamed({"item_id": "item"})

    both = (
        near.join(terms, ["rid", "start", "size"])
        .join(item_terms.withColumnsRenamed({"weight": "item_weight"}), ["item", "h"])
        .groupBy("item", "rid", "doc_id", "start", "size")
        .agg(F.sum(F.least("weight", "item_weight")).alias("common"))
    )
    total = terms.groupBy("rid", "start", "size").agg(F.sum("weight").alias("window_weight"))
    item_total = item_terms.groupBy("item").agg(F.sum("weight").alias("item_weight"))
    scored = both.join(total, ["rid", "start", "size"]).join(item_total, "item")
    union = F.col("window_weight") + F.col("item_weight") - F.col("common")
    good = scored.where(100 * F.col("common") >= percent * union).withColumn("similarity", F.col("common") / union)
    good = good.join(bench.select("item", "item_id"), "item")
    best = F.min_by(F.struct("similarity", "start"), F.struct(-F.col("similarity"), F.col("start"))).alias("best")
    return good.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.similarity", F.col("best.start").alias("start_word"))
