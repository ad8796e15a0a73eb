"""Operator 10: language-model scores from a subword lattice.

A word's lattice has an arc for every piece of an existing vocabulary that stands
between two of its characters. Its probability is the sum over all segmentations of
the product of their pieces' probabilities, by forward recursion in log space:

    alpha[j] = logsumexp over i < j of alpha[i] + score(word[i:j])

A word of the training texts is also an arc of its own, from end to end, with
probability (c - d) / N; what the discount d frees goes to the pieces. A text's score
is the sum over its words and one end token. Arcs for single characters that the
vocabulary lacks keep every text's probability above zero.

The vocabulary is taken as it is. The scores of its pieces start from their order and
are fitted by PASSES passes of expected counts (forward and backward) over the training
words. The pieces share the discounted mass, so a word weighs what it gives to that:
min(c, d).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, ascii_lower, bounded_batches, keep
from .kernels import Block, Codes, blocks

LN10 = float(np.log(10))
DISCOUNT = 0.5
PASSES = 3
UNKNOWN_CHARACTERS = 2**17  # an unknown character's probability is shared by as many
STRETCH = 1 << 18  # arcs that are looked up at a time
# A word is frequent when it makes up at least this share of all tokens: at most
# 1 / FREQUENT words are.
FREQUENT = 2e-6


def vocabulary_pieces(path: str) -> list[str]:
    """The pieces of a sentencepiece model in their order, lower-cased A-Z, without
    control pieces and byte pieces; a piece that starts a word keeps its mark."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    keep_it = lambda i: not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    pieces = [model.id_to_piece(i) for i in range(model.vocab_size()) if keep_it(i)]
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    return list(dict.fromkeys(p.translate(low) for p in pieces))


class Lattice:
    """Scores (natural logs) of pieces, and recursions over batches of words. Pieces are
    found by the hashes of byte ranges, so a batch takes a few array operations for each
    place in its words."""

    def __init__(self, pieces: list[str], scores: np.ndarray, unknown: float):
        self.pieces, self.unknown = pieces, unknown
        self.scores = scores
        self.wide = max(map(len, pieces), default=1)
        self.codes = Codes(max(1, len(pieces)))
        if pieces:
            block = Block([p.encode() for p in pieces], lower=False)
            self.codes.add(np.maximum(block.hashes(block.starts, block.ends), 1))

    @property
    def index(self) -> dict[str, int]:
        return {p: i for i, p in enumerate(self.pieces)}

    @classmethod
    def of_order(cls, pieces: list[str]) -> Lattice:
        """Zipf's law over the vocabulary's order as starting scores."""
        rank = np.arange(2, len(pieces) + 2)
        p = 0.999 / rank / (1 / rank).sum()
        return cls(pieces, np.log(p), float(np.log(0.001 / UNKNOWN_CHARACTERS)))

    def with_scores(self, scores: np.ndarray, unknown: float) -> Lattice:
        out = Lattice.__new__(Lattice)
        out.__dict__ |= self.__dict__ | {"scores": scores, "unknown": unknown}
        return out

    def arcs(self, block: Block, at: np.ndarray, low: int, high: int) -> np.ndarray:
        """[word, place - low, length - 1] -> number of the piece of that length that
        ends at a place in [low, high). -1: none, -2: an unknown character. `at` has the
        byte at which each character of each word begins, and its end."""
        end = np.arange(low, high)[:, None]
        begin = end - np.arange(1, min(at.shape[1] - 1, self.wide) + 1)
        there = begin >= 0
        first, last = at[:, begin[there]], at[:, np.broadcast_to(end, begin.shape)[there]]
        out = np.full((len(at), *begin.shape), -1, np.int32)
        out[:, there] = self.codes.find(block.hashes(first.reshape(-1), last.reshape(-1))).reshape(first.shape)
        single = out[:, :, 0]
        single[single < 0] = -2
        return out

    def _stretches(self, at: np.ndarray) -> list[tuple[int, int]]:
        """Ranges of places whose arcs are few enough to be held at once."""
        n, size = at.shape[0], at.shape[1] - 1
        step = max(1, STRETCH // (n * min(size, self.wide)))
        return [(low, min(size + 1, low + step)) for low in range(1, size + 1, step)]

    def _weights(self, arcs: np.ndarray) -> np.ndarray:
        return np.append(self.scores, [self.unknown, -np.inf])[arcs]  # -2, -1

    def forward(self, block: Block, at: np.ndarray) -> np.ndarray:
        alpha = np.full(at.shape, -np.inf)
        alpha[:, 0] = 0
        for low, high in self._stretches(at):
            weights = self._weights(self.arcs(block, at, low, high))
            for j in range(low, high):
                m = min(j, weights.shape[2])
                alpha[:, j] = _logsumexp(alpha[:, j - m : j][:, ::-1] + weights[:, j - low, :m])
        return alpha

    def log_probability(self, words: list[str]) -> np.ndarray:
        """Marginal log probability of each word over all of its segmentations."""
        out = np.empty(len(words))
        for where, block, at in _by_length(words):
            out[where] = self.forward(block, at)[:, -1]
        return out

    def expected(self, words: list[str], counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece (last entry: of unknown characters)."""
        out = np.zeros(len(self.pieces) + 2)  # the last but one: unknown characters; the last: no arc
        for where, block, at in _by_length(words):
            alpha = self.forward(block, at)
            beta = np.full(at.shape, -np.inf)
            beta[:, -1] = 0
            share = np.log(counts[where]) - alpha[:, -1]
            for low, high in reversed(self._stretches(at)):
                arcs = self.arcs(block, at, low, high)
                weights, uses = self._weights(arcs), np.zeros(arcs.shape)
                for j in range(high - 1, low - 1, -1):
                    m = min(j, weights.shape[2])
                    through = beta[:, j : j + 1] + weights[:, j - low, :m]
                    before = slice(j - m, j)
                    uses[:, j - low, :m] = np.exp(alpha[:, before][:, ::-1] + through + share[:, None])
                    beta[:, before] = np.logaddexp(beta[:, before], through[:, ::-1])
                out += np.bincount((arcs % len(out)).reshape(-1), uses.reshape(-1), len(out))
        return out[:-1]


def _logsumexp(x: np.ndarray) -> np.ndarray:
    most = x.max(axis=1)
    most[np.isneginf(most)] = 0
    with np.errstate(divide="ignore"):
        return np.log(np.exp(x - most[:, None]).sum(axis=1)) + most


def _by_length(words: list[str], most: int = 8192) -> Iterator[tuple[np.ndarray, Block, np.ndarray]]:
    """Batches of words with equal numbers of characters: their numbers, their bytes
    with the mark of a word's start, and where each character begins."""
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    for size in np.unique(sizes):
        where = np.flatnonzero(sizes == size)
        step = max(1, min(most, 400_000 // int(size)))
        for first in range(0, len(where), step):
            part = where[first : first + step]
            block = Block([("▁" + words[i]).encode("utf-8", "replace") for i in part], lower=False)
            lead = np.flatnonzero((block.data & 0xC0) != 0x80)
            yield part, block, lead.reshape(len(part), int(size) + 1)


def _known_scores(words: list[str], counts: np.ndarray, total: int, freed: float, lattice: Lattice) -> np.ndarray:
    """log10 probability of words: the whole-word arc (if trained) and all segmentations."""
    inner = lattice.log_probability(words) + np.log(freed)
    whole = np.where(counts > 0, np.log(np.maximum(counts - DISCOUNT, 1e-300)) - np.log(total), -np.inf)
    return np.logaddexp(inner, whole) / LN10


def _hashes(words: list[str]) -> np.ndarray:
    out = [b.hashes(b.starts, b.ends) for _, b in blocks(words)]
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def lm_scores(docs: DataFrame, vocabulary: str, training: Column) -> DataFrame:
    """Scores the rows of `docs` with models of the rows where `training` holds.

    Returns one row per row: doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score (both log10). Tokens are runs of characters other
    than ASCII white space, A-Z lower-cased, and one end token. base_score adds over
    tokens log10((c + 0.1) / (N + 0.1 (V + 1))); score is the lattice's (see above).

    Null text is empty text, the end token alone. A null `training` counts as
    training. Null ids pass through. Repeated rows train as often as they occur. Without any training token, N = V = 0 and score has the
    pieces alone. Whole texts are used. Other columns are not read.

    Corpus counts come from one aggregation over all texts. At most 1 / FREQUENT
    words are frequent; those are sent to all tasks. Every other word of a document
    goes through a shuffle join by its 64-bit hash, once for each document. (Two of
    10 million words share a hash with a probability of 3 in a million.)
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(training, F.lit(True)).alias("training"),
    )

    # Corpus counts of words (without the end token, of which each text has one).
    split = F.split(ascii_lower(F.col("text")), SPACE, -1)
    counted = rows.select("training", F.explode(split).alias("word")).groupBy("word").agg(F.sum(F.col("training").cast("long")).alias("c"), F.count("*").alias("uses"))
    # Dealt evenly, as words cost far more to score than to store.
    counted = keep(counted.where("word <> ''").repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))), "words")
    got = counted.agg(F.sum("c"), F.sum((F.col("c") > 0).cast("long")), F.sum(F.least(F.col("c").cast("double"), F.lit(DISCOUNT))), F.sum("uses")).first()
    ends = int(rows.agg(F.sum(F.col("training").cast("long"))).first()[0] or 0)
    n, v = int(got[0] or 0) + ends, int(got[1] or 0) + (ends > 0)
    share = max(float(got[2] or 0) / n, 1e-9) if n else 1.0
    down = n + 0.1 * (v + 1)

    model = spark.sparkContext.broadcast(_fitted(counted, Lattice.of_order(vocabulary_pieces(vocabulary))))

    def scored(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            words, c = pdf["word"].tolist(), pdf["c"].to_numpy(np.float64)
            yield pd.DataFrame(
                {
                    "hash": _hashes(words).view(np.int64),
                    "uses": pdf["uses"],
                    "known": (c > 0).astype("int64"),
                    "base": np.log10((c + 0.1) / down),
                    "lattice": _known_scores(words, c, max(n, 1), share, model.value),
                }
            )

    known = keep(counted.mapInPandas(scored, "hash long, uses long, known long, base double, lattice double"), "scored")
    often = F.col("uses") >= max(2.0, FREQUENT * int(got[3] or 0))
    top = known.where(often).select("hash", "known", "base", "lattice").toPandas()  # at most 1 / FREQUENT rows
    top = top.assign(hash=top["hash"].to_numpy(np.int64).view(np.uint64)).sort_values("hash")
    top = spark.sparkContext.broadcast([np.append(top[c].to_numpy(t), np.zeros(1, t)) for c, t in (("hash", "u8"), ("known", "i8"), ("base", "f8"), ("lattice", "f8"))])
    end_base = float(np.log10((ends + 0.1) / down))
    end_score = float(np.log10(ends / n)) if ends else end_base

    # One row for each document with the sums over its frequent words (uses = 0), and
    # one for each of its other words.
    def parts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, *sums = top.value
        for pdf in frames:
            texts, at = pdf["text"].tolist(), 0
            rid = pdf["rid"].to_numpy()
            for _, block in blocks(texts):
                start, end, first = block.words()
                size = len(block.starts)
                owner = np.repeat(np.arange(size), np.diff(first))
                hashes = block.hashes(start, end)
                place = np.searchsorted(table[:-1], hashes)
                common = (table[place] == hashes) & (place < len(table) - 1)
                add = [np.bincount(owner[common], x[place[common]], size) for x in sums]
                mine = slice(at, at + size)
                yield pd.DataFrame(
                    {
                        "rid": rid[mine], "hash": rid[mine], "uses": 0, "rows": 1,
                        "doc_id": pdf["doc_id"].iloc[mine].astype("Int64"), "training": pdf["training"].iloc[mine].to_numpy(),
                        "tokens": np.diff(first) + 1, "known": add[0].astype("int64") + (ends > 0),
                        "base": add[1] + end_base, "lattice": add[2] + end_score,
                    }
                )
                rest = ~common
                if rest.any():
                    order = np.lexsort((hashes[rest], owner[rest]))
                    h, o = hashes[rest][order], owner[rest][order]
                    new = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (o[1:] != o[:-1])))
                    times = np.diff(np.append(new, len(h)))
                    yield pd.DataFrame({"rid": rid[mine][o[new]], "hash": h[new].view(np.int64), "uses": times, "rows": 0, "doc_id": pd.array([None] * len(new), "Int64"), "training": None, "tokens": 0, "known": 0, "base": 0.0, "lattice": 0.0})
                at += size

    schema = "rid long, hash long, uses int, rows int, doc_id long, training boolean, tokens long, known long, base double, lattice double"
    dealt = rows.withColumn("rid", F.xxhash64("doc_id", "text")).mapInPandas(parts, schema)
    rare = known.where(~often).select("hash", F.col("known").alias("k"), F.col("base").alias("b"), F.col("lattice").alias("l"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    totals = (
        dealt.join(rare, "hash", "left")
        .groupBy("rid")
        .agg(
            F.max("doc_id").alias("doc_id"),
            (~F.first("training", ignorenulls=True)).alias("held_out"),
            F.sum("rows").alias("rows"),
            F.sum("tokens").alias("tokens"),
            F.sum(F.col("known") + F.col("uses") * zero("k")).alias("known"),
            F.sum(F.col("base") + F.col("uses") * zero("b")).alias("base"),
            F.sum(F.col("lattice") + F.col("uses") * zero("l")).alias("lattice"),
        )
    )
    whole = lambda c: (F.col(c) / F.col("rows")).cast("long")
    return totals.withColumn("again", F.explode(F.array_repeat(F.lit(0), F.col("rows").cast("int")))).select(
        "doc_id",
        F.col("held_out"),
        whole("tokens").alias("n_tokens"),
        whole("known").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") / F.col("rows")).alias("base_score"),
        (F.col("lattice") / F.col("rows")).alias("score"),
    )


def _fitted(counted: DataFrame, start: Lattice) -> Lattice:
    """Scores from passes of expected counts over all training words."""
    lattice, size = start, len(start.pieces) + 1
    trained = counted.where("c > 0").select("word", F.least(F.col("c").cast("double"), F.lit(DISCOUNT)).alias("c"))
    for _ in range(PASSES):
        shared = counted.sparkSession.sparkContext.broadcast(lattice)

        def expect(frames: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            total = np.zeros(size)
            for pdf in frames:
                total += shared.value.expected(pdf["word"].tolist(), pdf["c"].to_numpy(np.float64))
            used = np.flatnonzero(total)
            yield pd.DataFrame({"piece": used, "uses": total[used]})

        got = trained.mapInPandas(expect, "piece long, uses double").groupBy("piece").agg(F.sum("uses").alias("uses")).toPandas()  # a row for each piece
        uses = np.full(size, 0.01)
        uses[-1] = 1.0
        uses[got["piece"]] += got["uses"]
        log = np.log(uses / uses.sum())
        lattice = start.with_scores(log[:-1], float(log[-1] - np.log(UNKNOWN_CHARACTERS)))
    return lattice
