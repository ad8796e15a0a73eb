"""Operator 1: edit-aware token counts.

Each document keeps a segment tree whose leaves are its pieces (see pieces.py), with the tokens
and characters of each leaf and sums of both over subtrees. Places are found by descending by
characters. Edits replace the leaves
that they touch. Those leaves, with one leaf of context on either side, form a region
(regions that meet are one); each region is encoded anew once, its new pieces are dealt to its leaves, and only the sums on
the paths from them to the root change. So work is linear in the edits and in
what they touch, and the tree is ready for the next batch of edits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches
from .kernels import Block
from .pieces import PieceEncoder, shared_vocabulary, task_encoder


class CountTree:
    """Token counts of one document's leaves. `starts` has each leaf's first character,
    `counts` its tokens; `total` is the number of tokens of the text as edited so far, `chars` that of its characters.
    `split` gives both for a text: (starts of its pieces, their token counts)."""

    def __init__(self, text: str, starts: np.ndarray, counts: np.ndarray, split):
        self.split = split
        if not len(starts):
            starts, counts = np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.n = len(starts)
        self.given, self.bounds = text, np.append(starts, len(text)).astype(np.int64)
        self.changed: dict[int, str] = {}  # texts of leaves that edits have touched
        self.size = 1 << max(0, (self.n - 1).bit_length())
        self.sums = np.zeros((2 * self.size, 2), np.int64)  # tokens, characters
        self.sums[self.size : self.size + self.n, 0] = counts
        self.sums[self.size : self.size + self.n, 1] = np.diff(self.bounds)
        level = self.size
        while level > 1:
            self.sums[level // 2 : level] = self.sums[level : 2 * level : 2] + self.sums[level + 1 : 2 * level : 2]
            level //= 2
        self.encoded = 0  # characters encoded anew

    @property
    def total(self) -> int:
        return int(self.sums[1, 0])

    @property
    def chars(self) -> int:
        return int(self.sums[1, 1])

    def _leaf(self, i: int) -> str:
        return self.changed[i] if i in self.changed else self.given[self.bounds[i] : self.bounds[i + 1]]

    def text(self) -> str:
        return "".join(self._leaf(i) for i in range(self.n))

    def _find(self, place: int) -> tuple[int, int]:
        """(leaf that holds the character at `place`, its first character's place); at the end of
        the text the last leaf with text."""
        place = min(place, self.chars - 1)
        at, before = 1, 0
        while at < self.size:
            at *= 2
            left = int(self.sums[at, 1])
            if place - before >= left and before + left < self.chars:
                before += left
                at += 1
        return at - self.size, before

    def _set(self, leaves: np.ndarray, values: np.ndarray) -> None:
        """Puts new tokens and characters at leaves and renews the sums above them, level by level."""
        at = leaves + self.size
        self.sums[at] = values
        while at[0] > 1:
            at = np.unique(at >> 1)
            self.sums[at] = self.sums[2 * at] + self.sums[2 * at + 1]

    def apply(self, edits: list[tuple[int, int, str]]) -> None:
        """Replaces characters [start, end) of the present text by a text for each (start, end, text), which
        come in ascending order and don't overlap. May be called again and again."""
        # Regions: first leaf, its place, last leaf, place after it, and the edits within.
        regions: list[list] = []
        total = self.chars
        for edit in edits:
            if not total:
                low, first, high, end = 0, 0, self.n - 1, 0
            else:
                low, first = self._find(edit[0])
                if first:
                    low, first = self._find(first - 1)
                high, last = self._find(max(edit[0], edit[1] - 1))
                end = last + int(self.sums[self.size + high, 1])
                if end < total:
                    high, end = self._find(end)
                    end += int(self.sums[self.size + high, 1])
            if regions and low <= regions[-1][2]:
                regions[-1][2:4] = max(high, regions[-1][2]), max(end, regions[-1][3])
                regions[-1][4].append(edit)
            else:
                regions.append([low, first, high, end, [edit]])
        leaves, values = [], []
        for low, first, high, end, own in regions:
            old = "".join(self._leaf(i) for i in range(low, high + 1))
            parts, at = [], 0
            for x, y, by in own:
                parts += [old[at : x - first], by]
                at = y - first
            new = "".join(parts) + old[at:]
            starts, counts = self.split(new)
            self.encoded += len(new)
            # The region's leaves share its new pieces in runs.
            n = high - low + 1
            deal = np.arange(n + 1) * len(counts) // n
            cut = np.append(starts, len(new))[deal]
            cut[0] = 0
            upto = np.append(0, np.cumsum(counts))[deal]
            for i in range(n):
                self.changed[low + i] = new[cut[i] : cut[i + 1]]
            leaves.append(np.arange(low, high + 1))
            values.append(np.stack([np.diff(upto), np.diff(cut)], axis=1))
        if regions:
            self._set(np.concatenate(leaves), np.concatenate(values))


def leaves_of(block: Block, i: int, start: np.ndarray, first: np.ndarray) -> np.ndarray:
    """First characters of the pieces of text i of a block."""
    leaves = start[first[i] : first[i + 1]] - block.starts[i]
    lead = (block.data[block.starts[i] : block.ends[i]] & 0xC0) != 0x80
    return leaves if lead.all() else (np.cumsum(lead) - 1)[leaves]  # bytes to characters


def splitter(enc: PieceEncoder):
    """A text's pieces as (first characters, token counts); one piece where it can't be cut."""

    def split(text: str) -> tuple[np.ndarray, np.ndarray]:
        if not text:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        if enc.stays_whole(text):
            return np.zeros(1, np.int64), np.array([len(enc.encode_whole(text))])
        block = Block([text.encode("utf-8", "replace")], lower=False)
        codes, start, _, first = enc.codes(block)
        return leaves_of(block, 0, start, first), enc.lengths(codes)

    return split


def count_with_edits(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Token counts before and after the edits of each row of `docs`.

    `docs` has doc_id, text and `edits`, an array of structs (start, stop, by): the
    characters [start, stop) give way to `by`. Returns one row per row: doc_id,
    n_tokens, n_edits, edited_tokens, edited_chars, reencoded_chars.

    A null text is an empty one; null edits are none, and an edit with a null field is skipped. Positions beyond the text
    are moved to its end. Of overlapping edits the ones that start later win and the
    rest are skipped; n_edits has the number applied. Repeated rows and null ids
    pass through; other columns are not read. Texts with white space outside ASCII
    are encoded whole, before and after; so is a text without any place to cut (one word, say), as it is one leaf.
    """

    bounded_batches(docs.sparkSession)
    shared = shared_vocabulary(docs.sparkSession, vocabulary)

    def run(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = task_encoder(shared)
        split = splitter(enc)
        one = lambda t: (np.zeros(1, np.int64), np.array([len(enc.encode_whole(t))]))
        for pdf in rows:
            out = []
            texts = pdf["text"].tolist()
            for at in range(0, len(texts), 128):
                part = texts[at : at + 128]
                block = Block([t.encode("utf-8", "replace") for t in part], lower=False)
                codes, start, _, first = enc.codes(block)
                n = enc.lengths(codes)
                sums = np.append(0, np.cumsum(n))
                for i, (text, edits) in enumerate(zip(part, pdf["edits"].iloc[at : at + 128])):
                    wide = enc.stays_whole(text)
                    tokens = len(enc.encode_whole(text)) if wide else int(sums[first[i + 1]] - sums[first[i]])
                    todo = _plan(edits, len(text))
                    if not todo:
                        out.append((tokens, 0, tokens, len(text), 0))
                        continue
                    if wide:
                        leaves, counts = np.zeros(1, np.int64), np.array([tokens])
                    else:
                        leaves = leaves_of(block, i, start, first)
                        counts = n[first[i] : first[i + 1]]
                    tree = CountTree(text, leaves, counts, one if wide else split)
                    tree.apply(todo[::-1])
                    out.append((tokens, len(todo), tree.total, tree.chars, tree.encoded))
            cols = ["n_tokens", "n_edits", "edited_tokens", "edited_chars", "reencoded_chars"]
            made = pd.DataFrame(out, columns=cols).astype("int64")
            made.insert(0, "doc_id", pdf["doc_id"].array)
            yield made

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        "edits",
    )
    return rows.mapInPandas(run, "doc_id long, n_tokens long, n_edits long, edited_tokens long, edited_chars long, reencoded_chars long")


def _plan(edits, n: int) -> list[tuple[int, int, str]]:
    """Edits from right to left, within the text and without overlaps."""
    todo, limit = [], n
    if edits is None or len(edits) == 0:
        return todo
    found = [(e["start"], e["stop"], e["by"]) for e in edits if e is not None]
    found = [(min(max(0, int(a)), n), min(max(0, int(a), int(b)), n), by) for a, b, by in found if None not in (a, b, by)]
    for a, b, by in sorted(found, reverse=True):
        if b <= limit:
            todo.append((a, b, by))
            limit = a
    return todo


# E-mail addresses and long runs of digits: what the edits of redactions() hide.
PERSONAL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}|[0-9][0-9 ()./+-]{5,}[0-9]"


def _spans(gaps: pd.Series, hits: pd.Series) -> pd.Series:
    """Edits from the lengths of the matches and of what stands before each of them."""
    out = []
    for gap, hit in zip(gaps, hits):
        stop = np.cumsum(np.asarray(gap, np.int64)[: len(hit)] + hit)
        out.append([{"start": a, "stop": b, "by": "[redacted]"} for a, b in zip((stop - hit).tolist(), stop.tolist())])
    return pd.Series(out)


def redactions(docs: DataFrame) -> DataFrame:
    """(doc_id, text, edits) with the edits that hide personal data: each match of
    PERSONAL gives way to "[redacted]". The JVM finds the matches; their positions are
    running sums of lengths. Null text is empty text, and a text without a match has
    no edits."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    sizes = lambda c: F.transform(c, F.length)
    found = docs.select("doc_id", text.alias("text")).withColumn("hits", F.regexp_extract_all("text", F.lit(PERSONAL), 0))
    gaps = F.when(F.size("hits") > 0, F.split("text", PERSONAL, -1)).otherwise(F.array().cast("array<string>"))
    spans = F.pandas_udf(_spans, "array<struct<start:long,stop:long,by:string>>")
    return found.select("doc_id", "text", spans(sizes(gaps), sizes(F.col("hits"))).alias("edits"))
