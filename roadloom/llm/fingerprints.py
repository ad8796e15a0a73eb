"""Operator 6: SimHash fingerprints and Hamming search over permuted block tables.

Every word trigram of a text votes on each of 128 bits with the sign of that bit of
its hash, weighted by the number of its occurrences; a bit is set where the votes are
positive. For two texts the share of differing bits estimates the angle between
their weighted term vectors, so `likeness` is the cosine of that angle, 0 at least.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, keep, small
from .kernels import blocks, mix

BITS, TERM_WORDS = 128, 3


# For each byte value, +1 for a set bit and -1 for a clear one.
_SIGNS = 2.0 * np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little") - 1


def simhash(terms: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Fingerprints, one row of packed bits for each of n texts, of 64-bit term
    hashes with their texts' numbers; a term counts as often as it occurs. The votes
    of a byte's eight bits are summed over a histogram of that byte's values."""
    out = np.empty((n, BITS), bool)
    for lane in range(BITS // 64):
        for byte, values in enumerate(mix(terms + np.uint64(lane)).view(np.uint8).reshape(-1, 8).T):
            counts = np.bincount(owner * 256 + values, minlength=256 * n).reshape(n, 256)
            out[:, 64 * lane + 8 * byte : 64 * lane + 8 * byte + 8] = counts @ _SIGNS > 0
    return np.packbits(out, axis=1)


def simhashes(texts: list[str]) -> list[str]:
    """Fingerprints as hex digits; zeros for a text without words."""
    out = []
    for _, block in blocks(texts):
        terms, first = block.shingles(TERM_WORDS)
        n = len(block.starts)
        owner = np.repeat(np.arange(n), np.diff(first))
        out += [row.tobytes().hex() for row in simhash(terms, owner, n)]
    return out


def likeness(a: str, b: str) -> float:
    distance = (int(a, 16) ^ int(b, 16)).bit_count()
    return max(0.0, float(np.cos(np.pi * distance / BITS))) if distance else 1.0


QUERY_RADIUS = 3  # four blocks of 32 bits


def with_near_counts(marked: DataFrame, radius: int = QUERY_RADIUS) -> DataFrame:
    """`marked` (doc_id, fingerprint and others) with n_near: for doc_ids divisible by 50,
    how many other fingerprints lie within `radius` bits of its own, found through the
    block tables; null for all other rows."""
    marked = keep(marked, "marked")
    found = near_fingerprints(marked, radius).groupBy("fingerprint").agg(F.sum((F.col("distance") > 0).cast("long")).alias("n_near"))
    found = small(keep(found, "near"), 1_000_000)
    asks = F.when(F.col("doc_id") % 50 == 0, F.col("n_near"))
    return marked.join(found, "fingerprint", "left").select(*marked.columns, asks.alias("n_near"))


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text.

    The edited text has its last floor(n_chars / 4) code points replaced by the first
    as many (or all) of the next document's, in ascending doc_id; after the last
    document comes the first. Returns one row for each row: doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Null text is empty text, with a fingerprint of zeros. Null ids come first. Rows
    with equal ids follow each other in the order of their texts. A single row is its own next one. Other
    columns are not read; an empty table gives an empty result.

    Rows are dealt into ranges of doc_id, so each text is shuffled once; a range also
    gets the first row of the next one. No range needs rows of more than its own span
    of ids, and a task streams through its range.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("part", F.when(F.col("doc_id").isNull(), 0).otherwise(_range(_cuts(rows, n), 0)))
    # The first row of each range, for the range before it (of the first, for the last).
    heads = rows.groupBy("part").agg(F.min("doc_id").alias("doc_id"), F.max(F.col("doc_id").isNull()).alias("null_id"))
    heads = heads.select("part", F.when(~F.col("null_id"), F.col("doc_id")).alias("doc_id")).orderBy("part").collect()  # one row a range
    if not heads:
        return spark.createDataFrame([], "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    to = spark.createDataFrame([(h["part"], h["doc_id"], heads[i - 1]["part"]) for i, h in enumerate(heads)], "part int, head long, before int")
    first = (
        rows.join(F.broadcast(to), ["part"])
        .where(F.col("doc_id").eqNullSafe(F.col("head")))
        .groupBy("before")
        .agg(F.min_by(F.struct("doc_id", "text"), "text").alias("row"))
        .select(F.col("before").alias("part"), F.lit(1).alias("extra"), "row.doc_id", "row.text")
    )
    dealt = rows.select("part", F.lit(0).alias("extra"), "doc_id", "text").union(first)
    dealt = dealt.repartitionByRange(n, "part").sortWithinPartitions("part", "extra", F.col("doc_id").asc_nulls_first(), "text")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last: tuple | None = None  # the row that still waits for its next one
        for pdf in frames:
            seen = list(zip(pdf["part"], pdf["extra"], pdf["doc_id"].astype("Int64"), pdf["text"]))
            for at in range(0, len(seen), 256):
                part_rows = seen[at : at + 256]
                pairs = []
                for row in part_rows:
                    if last is not None:
                        if row[0] == last[0]:
                            pairs.append((last[2], last[3], row[3]))
                    last = None if row[1] else row
                if pairs:
                    yield _fingerprint(pairs)

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return dealt.mapInPandas(run, schema)


def _cuts(rows: DataFrame, n: int) -> list[int]:
    """Ids that cut the rows into about n ranges of equal numbers of rows."""
    if n < 2:
        return []
    found = rows.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], F.lit(100 * n)).alias("c")).first()["c"]
    return sorted(set(found or []))


def _range(cuts: list[int], first: int) -> Column:
    """Number of the cuts that doc_id reaches, plus `first`, by binary search."""
    if not cuts:
        return F.lit(first)
    mid = len(cuts) // 2
    return F.when(F.col("doc_id") >= cuts[mid], _range(cuts[mid + 1 :], first + mid + 1)).otherwise(_range(cuts[:mid], first))


def _fingerprint(pairs: list[tuple]) -> pd.DataFrame:
    edited = [own[: len(own) - len(own) // 4] + nxt[: len(own) // 4] for _, own, nxt in pairs]
    # A next document is the following pair's own one, but for the last.
    own = simhashes([p[1] for p in pairs] + [pairs[-1][2]])
    texts = [p[1] for p in pairs[1:]] + [pairs[-1][2]]
    following = [own[i + 1] if texts[i] is pairs[i][2] or texts[i] == pairs[i][2] else simhashes([pairs[i][2]])[0] for i in range(len(pairs))]
    changed = simhashes(edited)
    return pd.DataFrame(
        {
            "doc_id": pd.array([p[0] for p in pairs], "Int64"),
            "n_chars": [len(p[1]) for p in pairs],
            "edited_sha256": [hashlib.sha256(e.encode("utf-8", "replace")).hexdigest() for e in edited],
            "fingerprint": own[:-1],
            "edited_fingerprint": changed,
            "near_edited": [likeness(a, b) for a, b in zip(own, changed)],
            "near_next": [likeness(a, b) for a, b in zip(own, following)],
        }
    )


def hamming(a: str, b: str) -> Column:
    """Number of differing bits of two columns of hex fingerprints."""
    lanes = [F.conv(F.substring(c, 16 * i + 1, 16), 16, -10).cast("long") for i in range(BITS // 64) for c in (a, b)]
    return sum(F.bit_count(lanes[i].bitwiseXOR(lanes[i + 1])) for i in range(0, len(lanes), 2))


def near_fingerprints(marked: DataFrame, radius: int = 7, queries: Column | None = None) -> DataFrame:
    """Fingerprints within `radius` bits of a query's.

    `marked` has doc_id and fingerprint. Returns (fingerprint, other, distance) for
    each query's fingerprint and each different fingerprint in reach, with the
    smallest doc_id of either (doc_id, other_id), and one row at distance 0 for a
    query's fingerprint itself; equal fingerprints are one, so copies are not
    expanded into pairs. Queries are the rows where `queries` holds, by default
    doc_id divisible by 50. Rows with a null fingerprint are left out.

    The bits are cut into radius + 1 blocks. Two fingerprints in reach agree in at
    least one whole block (a block can't be missed by fewer differences than blocks),
    so a table for each block, keyed by it, finds all of them; that is the same as
    sorting by the fingerprint with this block moved to the front.
    """
    queries = F.col("doc_id") % 50 == 0 if queries is None else queries
    own = marked.where("fingerprint is not null").groupBy("fingerprint").agg(F.min("doc_id").alias("doc_id"), F.max(queries).alias("asks"))
    own = keep(own, "fingerprints")
    digits = BITS // 4
    width = digits // (radius + 1)
    if not width:
        raise ValueError(f"radius must be less than {digits}")
    cut = [i * width for i in range(radius + 1)] + [digits]
    blocks_of = F.explode(F.array(*[F.concat(F.lit(f"{i}:"), F.substring("fingerprint", cut[i] + 1, cut[i + 1] - cut[i])) for i in range(radius + 1)]))
    keyed = own.select("fingerprint", "doc_id", "asks", blocks_of.alias("block"))
    asked = keyed.where("asks").select("block", F.col("fingerprint").alias("q"), F.col("doc_id").alias("q_id"))
    pairs = (
        keyed.join(asked, "block")
        .select(F.col("q").alias("fingerprint"), F.col("q_id").alias("doc_id"), F.col("fingerprint").alias("other"), F.col("doc_id").alias("other_id"))
        .withColumn("distance", hamming("fingerprint", "other"))
    )
    return pairs.where(F.col("distance") <= radius).distinct()
