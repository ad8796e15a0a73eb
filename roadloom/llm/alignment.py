"""Operator 12: alignment of the tokens of two tokenizers.

Rows are shuffled by their full text, so that each distinct text is tokenised and aligned
once; how many rows have it is its weight in the counts of linked pairs. A text's
distinct pairs and their uses are kept with it; once the counts over all texts are known, they give its measures, which are joined to the
rows by the text's digest (rows with a text of their own need no join).

Inside a task, texts are laid end to end. Running sums of token lengths are the byte offsets
where tokens end, and offsets at which both tokenizers end a token cut groups; no Python object stands for a token.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, keep, small
from .kernels import blocks
from .pieces import PieceEncoder, SentencePieces, shared_vocabulary, task_encoder

MOST_PAIRS = 2_000_000  # pairs whose counts are sent to all tasks; more are joined
LOW = (1 << 32) - 1


class Entries:
    """Bytes and decimal digits of each id of a vocabulary, as arrays."""

    def __init__(self, entries: list[bytes]):
        self.length = np.array([len(e) for e in entries], np.int64)
        self.start = np.append(0, np.cumsum(self.length))[:-1]
        self.flat = np.frombuffer(b"".join(entries) or b"\0", np.uint8)
        width = len(str(len(entries)))
        self.digits = np.zeros((len(entries), width), np.uint8)
        for i in range(len(entries)):
            text = str(i).encode()
            self.digits[i, : len(text)] = np.frombuffer(text, np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        n = self.length[ids]
        before = np.cumsum(n) - n
        return self.flat[np.repeat(self.start[ids] - before, n) + np.arange(n.sum())]


def _total(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of runs of `counts` values."""
    upto = np.append(0, np.cumsum(values))
    edge = np.append(0, np.cumsum(counts))
    return upto[edge[1:]] - upto[edge[:-1]]


def _groups_text(ia: np.ndarray, ib: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray, a: Entries, b: Entries) -> tuple[bytes, np.ndarray]:
    """The groups of all texts as a1,a2|b1;a3|b2,b3; and so on, and how many bytes stand before each group."""
    last_a, last_b = np.append(0, np.flatnonzero(ends_a) + 1), np.append(0, np.flatnonzero(ends_b) + 1)
    at_a = np.arange(len(ia)) + last_b[np.cumsum(ends_a) - ends_a]
    at_b = np.arange(len(ib)) + last_a[np.cumsum(ends_b) - ends_b + 1]
    width = max(a.digits.shape[1], b.digits.shape[1])
    chars = np.zeros((len(ia) + len(ib), width + 1), np.uint8)
    chars[at_a, : a.digits.shape[1]] = a.digits[ia]
    chars[at_b, : b.digits.shape[1]] = b.digits[ib]
    chars[at_a, width] = np.where(ends_a, ord("|"), ord(","))
    chars[at_b, width] = np.where(ends_b, ord(";"), ord(","))
    size = np.append(0, np.cumsum((chars > 0).sum(1)))
    return chars[chars > 0].tobytes(), size[last_a + last_b]


def align(texts: list[str], enc_a: PieceEncoder, enc_b: PieceEncoder, a: Entries, b: Entries) -> Iterator[tuple]:
    """(n_a, n_b, n_groups, n_links, groups_sha256, pairs, uses) of each text. A pair is
    id A << 32 | id B; `uses` are its links in the text."""
    none = (0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int32))
    spaced = [f" {t}" if t else "" for t in texts]
    for first, block in blocks(spaced, lower=False):
        here = [t for t in spaced[first : first + len(block.starts)]]
        full = [i for i, t in enumerate(here) if t]
        found: list[tuple] = [none] * len(here)
        raw = [block.raw[block.starts[i] : block.ends[i]] for i in full]
        ids_a, ids_b = (e.ids([here[i] for i in full]) for e in (enc_a, enc_b))
        # A text whose tokens don't make up its bytes has none.
        for ids, entries in ((ids_a, a), (ids_b, b)):
            good = [k for k, (x, t) in enumerate(zip(ids, raw)) if entries.length[x].sum() == len(t)]
            if good:
                sizes = np.array([len(raw[k]) for k in good])
                same = entries.joined(np.concatenate([ids[k] for k in good])) == np.frombuffer(b"".join(raw[k] for k in good), np.uint8)
                good = [k for k, n in zip(good, _total(same, sizes) == sizes) if n]
            full, raw, ids_a, ids_b = ([x[k] for k in good] for x in (full, raw, ids_a, ids_b))
        if full:
            n_a, n_b = (np.array([len(x) for x in ids]) for ids in (ids_a, ids_b))
            ia, ib = np.concatenate(ids_a).astype(np.int64), np.concatenate(ids_b).astype(np.int64)
            stop_a, stop_b = np.cumsum(a.length[ia]), np.cumsum(b.length[ib])
            mark = np.zeros((2, stop_a[-1] + 1), bool)
            mark[0, stop_a], mark[1, stop_b] = True, True
            ends_a, ends_b = mark[1, stop_a], mark[0, stop_b]
            groups = _total(ends_a, n_a)
            text, before = _groups_text(ia, ib, ends_a, ends_b, a, b)
            edge = np.append(0, np.cumsum(groups))
            link = np.repeat(np.arange(len(full)), groups) << 32  # text and link, to count them in one sort
            pairs = (ia[ends_a] << 32) | ib[ends_b]
            known, number = np.unique(pairs, return_inverse=True)
            keys, uses = np.unique(link | number, return_counts=True)
            cut = np.searchsorted(keys, np.arange(len(full) + 1) << 32)
            for k, i in enumerate(full):
                digest = hashlib.sha256(text[before[edge[k]] : before[edge[k + 1]] - 1]).hexdigest()
                own = slice(cut[k], cut[k + 1])
                found[i] = (int(n_a[k]), int(n_b[k]), int(groups[k]), int(groups[k]), digest, known[keys[own] & LOW], uses[own].astype(np.int32))
        yield from found


def align_tokenizers(docs: DataFrame, byte_vocabulary: str, piece_model: str) -> DataFrame:
    """One row for each row of `docs` (doc_id, text): doc_id, n_a, n_b, n_groups, n_links,
    n_best, count_sum, groups_sha256. `byte_vocabulary` is a byte-level tokenizers file (A,
    encodes a space and the text), `piece_model` a sentencepiece BPE model (B, adds that space itself).

    Groups are cut where an A and a B token end at the same byte. As every entry has at least one
    byte, one A and one B token end there: the group's link. A pair's count is the number of links
    that hold it in all rows, repeated texts included; n_best counts the links whose
    pair has the highest count of its B id, and count_sum adds the counts over links.

    A text that is null or empty, or is not what A's or B's tokens spell (one with U+2581, which B
    reads as a space), has no tokens, zeros and an empty groups_sha256. Null and repeated doc_ids pass
    through, each row for itself. Other columns are not read. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shared_a, shared_b = shared_vocabulary(spark, byte_vocabulary), shared_vocabulary(spark, piece_model)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    digest = F.unhex(F.md5(F.col("text").cast("binary")))
    # The id travels as text: pandas would make a float of a column with nulls.
    texts = rows.groupBy("text").agg(F.min("doc_id").cast("string").alias("doc_id"), F.count("*").alias("n")).withColumn("digest", digest)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc_a, enc_b = task_encoder(shared_a), task_encoder(shared_b, SentencePieces)
        a, b = entries_of(enc_a), entries_of(enc_b)
        for pdf in frames:
            for at in range(0, len(pdf), 500):
                part = pdf.iloc[at : at + 500]
                got = pd.DataFrame(list(align(part["text"].tolist(), enc_a, enc_b, a, b)), columns=["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "uses"])
                for c in ("digest", "doc_id", "n"):
                    got.insert(0, c, part[c].array)
                yield got

    schema = "n long, doc_id string, digest binary, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, uses array<int>"
    aligned = keep(texts.mapInPandas(run, schema), "aligned")

    used = aligned.select("n", F.explode(F.arrays_zip("pairs", "uses")).alias("p")).select("p.pairs", (F.col("n") * F.col("p.uses")).alias("uses"))
    counts = used.groupBy("pairs").agg(F.sum("uses").alias("total"))
    counts = keep(counts.withColumnRenamed("pairs", "pair"), "pair-counts")
    most = counts.groupBy(F.col("pair").bitwiseAND(LOW).alias("b")).agg(F.max("total").alias("most"))
    counts = keep(counts.withColumn("b", F.col("pair").bitwiseAND(LOW)).join(most, "b").select("pair", "total", (F.col("total") == F.col("most")).alias("best")), "pair-counts")

    if counts.count() <= MOST_PAIRS:
        table = counts.toPandas().sort_values("pair")  # MOST_PAIRS rows at most
        sent = spark.sparkContext.broadcast(tuple(table[c].to_numpy() for c in ("pair", "total", "best")))

        def look_up(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            pair, total, best = sent.value
            for pdf in frames:
                n = pdf["pairs"].map(len).to_numpy()
                sums = np.zeros((2, len(pdf)), np.int64)
                if n.sum():
                    at = np.searchsorted(pair, np.concatenate(pdf["pairs"].to_numpy()))
                    uses = np.concatenate(pdf["uses"].to_numpy()).astype(np.int64)
                    sums[0], sums[1] = _total(uses * best[at], n), _total(uses * total[at], n)
                yield pdf.drop(columns=["pairs", "uses"]).assign(n_best=sums[0], count_sum=sums[1])

        plain = schema.removesuffix(", pairs array<long>, uses array<int>")
        measured = aligned.mapInPandas(look_up, plain + ", n_best long, count_sum long")
    else:
        # A pair of many texts is a skewed key, which Spark splits.
        each = aligned.select("digest", F.explode(F.arrays_zip("pairs", "uses")).alias("p")).select("digest", F.col("p.pairs").alias("pair"), "p.uses")
        sums = each.join(counts, "pair").groupBy("digest").agg(F.sum(F.when(F.col("best"), F.col("uses")).otherwise(0)).alias("n_best"), F.sum(F.col("uses") * F.col("total")).alias("count_sum"))
        measured = aligned.drop("pairs", "uses").join(sums, "digest", "left").fillna(0, ["n_best", "count_sum"])

    measured = keep(measured, "measures")
    columns = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    copies = rows.select("doc_id", digest.alias("digest")).join(small(measured.where("n > 1").select("digest", *columns)), "digest")
    return measured.where("n = 1").select(F.col("doc_id").cast("long").alias("doc_id"), *columns).union(copies.select("doc_id", *columns))


_entries: dict[int, Entries] = {}


def entries_of(encoder: PieceEncoder) -> Entries:
    """The arrays of an encoder's vocabulary, made once for each process."""
    if id(encoder) not in _entries:
        _entries[id(encoder)] = Entries(encoder.token_bytes())
    return _entries[id(encoder)]
