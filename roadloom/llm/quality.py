"""Operator 2: quality scores by histogram gradient-boosted trees.

Features are statistics of the text alone. Each is cut into at most 63 bins at
quantiles of the training rows; a tree is grown level by level from histograms of
gradients and Hessians; trees are stored as flat arrays (feature, bin, leaf value of
a complete binary tree), which scoring walks for all rows at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small
from .kernels import Block, blocks, distinct

# Rows that the trees are fitted to at most; they are those with the smallest hashes
# of their ids, so that a rerun takes the same ones.
TRAINING_ROWS = 20_000
TREES, DEPTH, RATE, BINS, LEAST_HESSIAN, RIDGE = 60, 4, 0.15, 63, 2.0, 1.0

_CLASS = np.zeros(256, np.int64)  # 0 other punctuation, by byte:
_CLASS[ord("a") : ord("z") + 1] = 1
_CLASS[ord("A") : ord("Z") + 1] = 2
_CLASS[ord("0") : ord("9") + 1] = 3
_CLASS[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = 4
_CLASS[0x0A] = 5
_CLASS[[ord(c) for c in ".,;:'\"-?()"]] = 6
_CLASS[128:192] = 7  # inner bytes of a longer character
_CLASS[192:] = 8
_CLASS[[ord(c) for c in "!$%&#*|<>{}[]\\/_=+~^@"]] = 9
NAMES = (
    "log_bytes", "log_words", "lower", "upper", "digits", "spaces", "lines", "plain_marks", "wide", "odd_marks", "other",
    "word_length", "long_words", "distinct_words", "distinct_pairs", "top_word", "distinct_lines", "words_a_line", "odd_words", "upper_words", "most_frequent_byte",
)


def features(block: Block) -> np.ndarray:
    """One row of statistics for each text of a block made without lower-casing."""
    n = len(block.starts)
    size = np.maximum(block.ends - block.starts, 1)
    owner = np.repeat(np.arange(n), np.diff(np.append(block.starts, len(block.data))))
    inside = np.ones(len(block.data), bool)
    inside[block.ends] = False  # the separators
    kind = _CLASS[block.data]
    share = np.bincount(owner[inside] * 10 + kind[inside], minlength=10 * n).reshape(n, 10) / size[:, None]
    start, end, first = block.words()
    count = np.diff(first)
    words = np.maximum(count, 1)
    who = np.repeat(np.arange(n), count)
    length = end - start
    hashes = block.hashes(start, end)
    odd = np.append(0, np.cumsum(kind == 9))
    up = np.append(0, np.cumsum(kind == 2))
    per = lambda x: np.bincount(who, x, n) / words
    pairs, pair_first = block.shingles(2)
    line_end = np.flatnonzero(block.data == 0x0A)
    line_start = np.append(0, line_end[:-1] + 1)
    lines = block.hashes(line_start, line_end)
    line_first = np.append(np.searchsorted(line_start, block.starts), len(lines))
    uniq = np.empty((n, 4))
    for i in range(n):
        own = np.sort(hashes[first[i] : first[i + 1]])
        cut = np.flatnonzero(np.append(True, own[1:] != own[:-1])) if len(own) else own
        uniq[i, 0] = len(cut) / words[i]
        uniq[i, 1] = len(distinct(pairs[pair_first[i] : pair_first[i + 1]])) / max(1, pair_first[i + 1] - pair_first[i])
        uniq[i, 2] = np.diff(np.append(cut, len(own))).max() / words[i] if len(own) else 0
        uniq[i, 3] = len(distinct(lines[line_first[i] : line_first[i + 1]])) / max(1, line_first[i + 1] - line_first[i])
    by_byte = np.bincount(owner[inside] * 256 + block.data[inside], minlength=256 * n).reshape(n, 256)
    by_byte[:, 0x20] = 0
    return np.column_stack(
        [
            np.log1p(size), np.log1p(count), share[:, 1], share[:, 2], share[:, 3], share[:, 4], share[:, 5], share[:, 6], share[:, 8], share[:, 9], share[:, 0],
            per(length), per(length > 15), uniq[:, 0], uniq[:, 1], uniq[:, 2], uniq[:, 3], count / np.maximum(1, np.diff(line_first)),
            per(odd[end] > odd[start]), per(up[end] - up[start] > 1), by_byte.max(1) / size,
        ]
    )


def text_features(texts: list[str]) -> np.ndarray:
    out = [features(b) for _, b in blocks(texts, lower=False)]
    return np.concatenate(out) if out else np.zeros((0, len(NAMES)))


@dataclass
class Trees:
    """edges: [feature][bin limits]; feature, cut: [tree, inner node]; leaf: [tree, leaf]."""

    edges: list[np.ndarray]
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    base: float

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.edges)])

    def score(self, x: np.ndarray) -> np.ndarray:
        b, row = self.bins(x), np.arange(len(x))
        total = np.full(len(x), self.base)
        for f, c, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (b[row, f[node]] > c[node])
            total += leaf[node - len(f)]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Log-loss boosting. Without rows, or with one label alone, a constant score."""
    n, width = x.shape
    inner = 2**DEPTH - 1
    rate = (y.sum() + 1) / (n + 2)
    model = Trees(
        [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) if n else np.zeros(0) for j in range(width)],
        np.zeros((0, inner), np.int64), np.zeros((0, inner), np.int64), np.zeros((0, inner + 1)), float(np.log(rate / (1 - rate))),
    )
    if not n or y.min() == y.max():
        return model
    b = model.bins(x)
    total = np.full(n, model.base)
    made = []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-total))
        g, h = p - y, p * (1 - p)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, BINS, np.int64)
        node = np.zeros(n, np.int64)
        for level in range(DEPTH):
            first, many = 2**level - 1, 2**level
            at = (node - first)[:, None] * width + np.arange(width)
            flat = (at * (BINS + 1) + b).reshape(-1)
            shape = many, width, BINS + 1
            gs = np.bincount(flat, np.repeat(g, width), many * width * (BINS + 1)).reshape(shape).cumsum(2)
            hs = np.bincount(flat, np.repeat(h, width), many * width * (BINS + 1)).reshape(shape).cumsum(2)
            gain = gs**2 / (hs + RIDGE) + (gs[:, :, -1:] - gs) ** 2 / (hs[:, :, -1:] - hs + RIDGE)
            gain[(hs < LEAST_HESSIAN) | (hs[:, :, -1:] - hs < LEAST_HESSIAN)] = -1
            gain = gain.reshape(many, -1)
            best = gain.argmax(1)
            ok = gain[np.arange(many), best] > 1e-9
            feature[first : first + many] = np.where(ok, best // (BINS + 1), 0)
            cut[first : first + many] = np.where(ok, best % (BINS + 1), BINS)
            node = 2 * node + 1 + (b[np.arange(n), feature[node]] > cut[node])
        node -= inner
        leaf = -RATE * np.bincount(node, g, inner + 1) / (np.bincount(node, h, inner + 1) + RIDGE)
        total += leaf[node]
        made.append((feature, cut, leaf))
    model.feature, model.cut, model.leaf = (np.array(a) for a in zip(*made))
    return model


def train(docs: DataFrame, labels: DataFrame, usable: Column, rows: int = TRAINING_ROWS) -> Trees:
    """Trees for `labels` (doc_id, quality), fitted to at most `rows` labelled rows for
    which `usable` (over doc_id) holds. Rows with a null id or label are not used; an
    id with several labels trains on the smallest."""
    chosen = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").alias("quality"))
        .where(usable)
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    marked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(small(chosen, rows), "doc_id")

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            yield pd.DataFrame({"x": list(text_features(pdf["text"].tolist())), "y": pdf["quality"], "doc_id": pdf["doc_id"]})

    got = marked.mapInPandas(count, "x array<double>, y int, doc_id long").toPandas().sort_values("doc_id", kind="stable")
    x = np.array(got["x"].tolist()).reshape(len(got), len(NAMES))
    order = np.lexsort((*x.T, got["doc_id"]))
    return fit(x[order], got["y"].to_numpy(np.float64)[order])


def quality_scores(docs: DataFrame, model: Trees, threshold: float = 0.7, keep_columns: bool = False) -> DataFrame:
    """`docs` with score (0 to 1) and predicted (1 if score >= threshold, else 0).

    Without `keep_columns` only doc_id, score and predicted are returned. Null text
    is scored like empty text; null ids, repeated rows and other columns pass
    through, except that columns of docs named score or predicted give way.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.drop("score", "predicted") if keep_columns else docs.select("doc_id", "text")

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in texts:
            own = series.tolist()
            yield pd.Series(shared.value.score(text_features(own)) if own else np.zeros(0))

    out = kept.withColumn("score", score(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    out = out.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))
    return out if keep_columns else out.select("doc_id", "score", "predicted")
