"""Operator 4: n-gram Jaccard join by signature trees.

1. Exact copies. Rows with the same text share one representative, the smallest id.
2. Routing. A set's tokens are dealt by hash into m parts and each part gives one
   key. Sets in one size band that meet the threshold differ in at most m - u
   tokens, so at least u parts are the same in both: they share a key unless all of
   those parts are empty. Sets with u or more empty parts add the keys of a prefix
   (a pair of such sets shares a token of its prefixes), which makes it exact.
   Bands are so wide that linked sets lie in one band or in two neighbours; a set
   gives keys for its own band and for the next. Passages that many documents share
   don't bring them together, since a whole part must agree.
3. Clusters. The sets of a key form a signature tree over small bitmaps; where the
   bounds allow a link, sets are tied, with as many ties as connect them. (A key with more
   than BUCKET sets ties each to its smallest id, row by row, so that no task gathers
   it.) The connected components of these ties can't cut a link. Most documents are in
   none and end here.
4. Signature trees (signature_tree.py) over each cluster find the links exactly. A
   large cluster is cut into blocks of bounded weight that are joined with
   themselves, then with their successors, then with all other blocks that the
   links found so far don't connect: no task holds more than two blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, components, keep, release, small
from .kernels import P, blocks, distinct, mix
from .signature_tree import bitmap, link, possible_ties

BLOCK_SHINGLES, BLOCK_DOCS = 1_000_000, 2_000
BUCKET, SIGNATURE_BITS = 1_024, 4_096


def bands(percent: int, top: int = 1 << 40) -> list[int]:
    """The largest size of each band."""
    out, low = [], 1
    while low < top:
        out.append(low * 100 // percent)
        low = out[-1] + 1
    return out


def parts(largest: int, percent: int) -> tuple[int, int]:
    """(number of parts m, parts u that agree at least) for sets of a band.

    Two sets of at most `largest` tokens that link differ in at most `differ` tokens.
    u is so large that even the smallest set which gives keys here (two bands' width
    below `largest`) seldom has u empty parts.
    """
    differ = 2 * largest * (100 - percent) // (100 + percent)
    agree, least = 1, largest * percent * percent / 10_000
    while agree <= differ:
        empty = (differ + agree) * math.exp(-least / (differ + agree))
        if agree > empty + 2 * math.sqrt(empty):
            break
        agree += 1
    return differ + agree, agree


@lru_cache(4096)
def _dealing(largest: int, percent: int) -> tuple[int, int, np.ndarray, np.ndarray]:
    """(parts, parts that agree, hashes at which all but the first begin, labels)."""
    m, agree = parts(largest, percent)
    at = ((np.arange(1, m, dtype=np.uint64) << np.uint64(32)) // np.uint64(m)) << np.uint64(32)
    return m, agree, at, mix(np.arange(m, dtype=np.uint64) + (np.uint64(largest) << np.uint64(20)))


def routing_keys(tokens: np.ndarray, percent: int, band: np.ndarray) -> np.ndarray:
    """The keys of one set of sorted distinct hashes."""
    n = len(tokens)
    if not n:
        return np.zeros(0, np.uint64)
    own = int(np.searchsorted(band, n))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(mix(tokens ^ np.uint64(P)), out=sums[1:])
    out, odd = [], False
    for b in (own, own + 1):
        m, agree, at, label = _dealing(int(band[b]), percent)
        edge = np.zeros(m + 1, np.int64)
        edge[1:m] = np.searchsorted(tokens, at)
        edge[m] = n
        full = edge[1:] > edge[:-1]
        total = sums[edge]
        out.append(((total[1:] - total[:-1]) ^ label)[full])
        odd |= m - np.count_nonzero(full) >= agree
    if odd:
        out.append(tokens[: n - -(-percent * n // 100) + 1] + np.uint64(7))
    return mix(np.concatenate(out))


def _signature(tokens: np.ndarray) -> bytes:
    """A bitmap with about as many bits as tokens, SIGNATURE_BITS at most."""
    return bitmap(tokens, max(64, min(SIGNATURE_BITS, 1 << max(0, len(tokens) - 1).bit_length()))).tobytes()


def shingle_sets(texts: list[str], k: int) -> Iterator[np.ndarray]:
    """Each text's distinct k-word shingles as sorted 64-bit hashes."""
    for _, block in blocks(texts):
        hashes, first = block.shingles(k)
        for i in range(len(block.starts)):
            yield distinct(hashes[first[i] : first[i + 1]])


def ngram_components(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every distinct doc_id of `docs`.

    Words are runs of characters other than ASCII white space, A-Z lower-cased. Two
    documents link when 100 * overlap >= percent * union of their sets of k-word
    shingles (with fewer words, the whole sequence is the only shingle).
    component_id is the smallest doc_id that links reach.

    Null, empty and blank texts have no shingles and link with nothing, not even
    each other. Rows with a null doc_id are left out, as they can't be named in a
    result. Of several texts under one id the one with the smallest MD5 digest
    counts; repeated rows count once. Other columns are not read. Whole texts are used,
    whatever their length, and an empty table gives an empty result.
    """
    bounded_batches(docs.sparkSession)
    n_parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    band = np.array(bands(percent), np.int64)
    rows = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    # 1. One row per id and text digest; `rep` is the smallest id with that text. Only
    # digests with copies are joined back: in a broadcast, or else in a join of two
    # shuffles, whose large partitions Spark can split.
    ids = rows.select("doc_id", F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest"))
    ids = keep(ids.groupBy("doc_id").agg(F.min("digest").alias("digest"), (F.min("digest") < F.max("digest")).alias("mixed")), "digests")
    firsts = keep(ids.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")).where("n > 1").select("digest", "rep"), "firsts")
    ids = keep(ids.join(small(firsts, 1_000_000), "digest", "left").select("doc_id", F.coalesce("rep", "doc_id").alias("rep"), "digest", "mixed"), "copies")
    # Rows that don't stand for themselves: copies, and further texts of an id.
    skip = ids.where("doc_id <> rep").select("doc_id", F.unhex(F.lit("")).alias("only"))
    skip = skip.union(ids.where("doc_id = rep and mixed").select("doc_id", F.col("digest").alias("only")))
    alone = rows.join(small(skip, 1_000_000), "doc_id", "left").where(F.col("only").isNull() | (F.col("only") == F.unhex(F.md5(F.col("text").cast("binary")))))
    alone = alone.select("doc_id", "text")

    # 2. Keys.
    def route(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            texts, keys = pdf["text"].tolist(), pdf["doc_id"].to_numpy()
            for at in range(0, len(texts), 1000):
                got = [(len(s), routing_keys(s, percent, band).view(np.int64), _signature(s)) for s in shingle_sets(texts[at : at + 1000], k)]
                yield pd.DataFrame({"doc_id": keys[at : at + 1000], "n": [g[0] for g in got], "keys": [g[1] for g in got], "signature": [g[2] for g in got]})

    routed = keep(alone.mapInPandas(route, "doc_id long, n long, keys array<long>, signature binary"), "routes")
    sizes = routed.select("doc_id", "n").dropDuplicates(["doc_id"])

    # 3. Clusters of documents that share keys and may be linked. A key of two documents
    # becomes one for each pair; only keys of three or more look for their documents.
    keys = routed.select("doc_id", F.explode("keys").alias("key"))
    shared = keys.groupBy("key").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n_docs")).where("low <> high")
    shared = keep(shared, "shared")
    pairs = shared.where("n_docs = 2").select("low", "high").distinct()
    pairs = pairs.select(F.xxhash64("low", "high", F.lit("pair")).alias("key"), F.explode(F.array("low", "high")).alias("doc_id"))
    several = small(shared.where("n_docs > 2").select("key", "low", "n_docs"), 1_000_000)
    several = keep(keys.join(several, "key").select("key", "doc_id", "low", "n_docs"), "several")
    stars = several.where((F.col("n_docs") > BUCKET) & (F.col("doc_id") != F.col("low"))).select(F.col("doc_id").alias("a"), F.col("low").alias("b")).distinct()
    met = pairs.union(several.where(F.col("n_docs") <= BUCKET).select("key", "doc_id").distinct())
    signatures = routed.select("doc_id", "n", "signature").dropDuplicates(["doc_id"])
    met = met.join(signatures, "doc_id").repartition(n_parts, "key").sortWithinPartitions("key", "doc_id")

    def tie(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[int, int, bytes]] = []  # BUCKET of them at most
        key = None

        def close() -> list[tuple[int, int]]:
            if len(held) < 2:
                return []
            return possible_ties([h[0] for h in held], [np.frombuffer(h[2], np.uint64) for h in held], [h[1] for h in held], percent)

        for pdf in frames:
            out = []
            for k_, doc, n, signature in zip(pdf["key"].tolist(), pdf["doc_id"].tolist(), pdf["n"].tolist(), pdf["signature"]):
                if k_ != key:
                    out += close()
                    key, held = k_, []
                held.append((doc, n, signature))
            yield pd.DataFrame(out, columns=["a", "b"]).astype("int64")
        yield pd.DataFrame(close(), columns=["a", "b"]).astype("int64")

    clusters = components(met.mapInPandas(tie, "a long, b long").union(stars), "ties")
    release(shared, several)

    # 4. Links within clusters.
    links = _links(alone, keep(clusters.join(sizes, clusters["id"] == sizes["doc_id"]).select("doc_id", F.col("label").alias("cluster"), "n"), "clusters"), k, percent, n_parts)
    labels = components(links, "links").withColumnsRenamed({"id": "rep"})
    done = ids.select("doc_id", "rep").join(sizes.select(F.col("doc_id").alias("rep"), "n"), "rep").join(labels, "rep", "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.coalesce("label", "rep"))
    return done.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def _links(docs: DataFrame, clusters: DataFrame, k: int, percent: int, n_parts: int) -> DataFrame:
    """(a, b): verified links that connect every linked pair of each cluster."""
    # Blocks by size, from the histogram of sizes of each cluster: no task sorts a
    # whole cluster. Sets of one size that fill several blocks are dealt by hash.
    counts = clusters.groupBy("cluster", "n").agg(F.count("*").alias("docs"))
    fill = F.col("docs") * F.greatest(F.col("n") / BLOCK_SHINGLES, F.lit(1 / BLOCK_DOCS))
    before = Window.partitionBy("cluster").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    first = F.floor(F.coalesce(F.sum(fill).over(before), F.lit(0.0)))
    counts = counts.select("cluster", "n", first.alias("first"), F.ceil(fill).alias("share"))
    most = F.max(F.col("first") + F.col("share")).over(Window.partitionBy("cluster"))
    counts = keep(counts.withColumn("blocks", most.cast("long")), "histogram")
    number = F.col("first") + F.pmod(F.xxhash64("doc_id"), F.col("share"))
    block = clusters.join(small(counts, 1_000_000), ["cluster", "n"])
    block = keep(block.select("doc_id", "cluster", "n", number.cast("long").alias("block"), "blocks"), "blocks")

    # A set is made once, where its text is, and goes to the blocks that need it.
    def tokens(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            texts = pdf["text"].tolist()
            out = pdf.drop(columns="text")
            for at in range(0, len(texts), 1000):
                part = out.iloc[at : at + 1000].copy()
                part["tokens"] = [s.tobytes() for s in shingle_sets(texts[at : at + 1000], k)]
                yield part

    with_text = docs.join(small(block, 1_000_000), "doc_id").select("doc_id", "cluster", "block", "blocks", "text")
    sets = keep(with_text.mapInPandas(tokens, "doc_id long, cluster long, block long, blocks long, tokens binary"), "sets")

    def joined(pdf: pd.DataFrame) -> pd.DataFrame:
        got = {}
        for side in (0, 1):
            own = pdf[pdf["side"] == side].drop_duplicates("doc_id").sort_values("doc_id")
            got[side] = own["doc_id"].tolist(), [np.frombuffer(t, np.uint64) for t in own["tokens"]]
        pairs = link(*got[0], percent, got[1] if got[1][0] else None)
        return pd.DataFrame(pairs, columns=["a", "b"]).astype("int64")

    def join_blocks(rows: DataFrame) -> DataFrame:
        return rows.groupBy("cluster", "i", "j").applyInPandas(joined, "a long, b long")

    own = sets.select("doc_id", "cluster", F.col("block").alias("i"), F.col("block").alias("j"), F.lit(0).alias("side"), "tokens")
    links = keep(join_blocks(own), "links")
    if not block.where("blocks > 1").limit(1).count():
        return links

    parted = sets.where("blocks > 1")
    step = F.explode(F.array(F.struct((F.col("block") - 1).alias("i"), F.lit(1).alias("side")), F.struct(F.col("block").alias("i"), F.lit(0).alias("side"))))
    near = parted.select("doc_id", "cluster", "blocks", "tokens", step.alias("p")).where("p.i >= 0 and p.i + 1 < blocks")
    near = near.select("doc_id", "cluster", F.col("p.i").alias("i"), (F.col("p.i") + 1).alias("j"), "p.side", "tokens")
    links = keep(links.union(join_blocks(near)), "links")

    # The other pairs of blocks, where sizes allow a link and links leave a gap.
    label = components(links, "labels")
    members = block.where("blocks > 1").join(label, F.col("doc_id") == F.col("id"), "left").withColumn("label", F.coalesce("label", "doc_id"))
    nodes = keep(members.groupBy("cluster", "block").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.min("label").alias("first"), F.max("label").alias("last")), "nodes")
    far = (
        nodes.alias("x")
        .join(nodes.alias("y"), (F.col("x.cluster") == F.col("y.cluster")) & (F.col("x.block") + 1 < F.col("y.block")))
        .where(f"100 * x.high >= {percent} * y.low")
        .where("not (x.first = x.last and y.first = y.last and x.first = y.first)")
        .select(F.col("x.cluster").alias("cluster"), F.col("x.block").alias("i"), F.col("y.block").alias("j"))
    )
    far = keep(far, "far")
    if not far.limit(1).count():
        return links
    sides = far.select("cluster", F.col("i").alias("block"), "i", "j", F.lit(0).alias("side")).union(far.select("cluster", F.col("j").alias("block"), "i", "j", F.lit(1).alias("side")))
    rest = parted.join(sides, ["cluster", "block"]).select("doc_id", "cluster", "i", "j", "side", "tokens")
    return keep(links.union(join_blocks(rest)), "links")
