"""Vectorised text primitives for use inside Spark tasks (numpy only).

A `Block` is a run of texts laid end to end as UTF-8 bytes. Prefix sums of
`value[byte] * P**position` (mod 2**64) give the hash of any byte range in O(1), so
words, shingles and word pieces are hashed without a Python object for each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

MASK = (1 << 64) - 1
P = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
P_INVERSE = pow(P, -1, 1 << 64)
BLOCK_BYTES = 1 << 18  # small enough that the arrays over it stay in a core's cache

_WS = np.zeros(256, bool)
_WS[[0x20, *range(0x09, 0x0E)]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose output bits all depend on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(P)) | np.uint64(1)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = max(n, BLOCK_BYTES + 1)
        made = []
        for base in (P, P_INVERSE):
            out = np.full(size, np.uint64(base), np.uint64)
            out[0] = 1
            made.append(np.multiply.accumulate(out))
        _powers = made[0], made[1]
    return _powers


class Block:
    """Texts as one byte array. `docs` has each text's (start, end)."""

    def __init__(self, texts: list[bytes], lower: bool = True):
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.raw = b"\n".join(texts) + b"\n"
        data = np.frombuffer(self.raw, np.uint8)
        self.data = _LOWER[data] if lower else data
        self.starts = np.zeros(len(texts), np.int64)
        np.cumsum(sizes[:-1] + 1, out=self.starts[1:])
        self.ends = self.starts + sizes
        self._sum: np.ndarray | None = None

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hashes of the byte ranges [start, end)."""
        power, inverse = _power_tables(len(self.data) + 1)
        if self._sum is None:
            self._sum = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum(_VALUE[self.data] * power[: len(self.data)], out=self._sum[1:])
        return mix((self._sum[end] - self._sum[start]) * inverse[start])

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of every word, and for each text the index of its first word
        (one entry more than texts)."""
        space = _WS[self.data]
        edge = np.flatnonzero(np.diff(space.view(np.int8), prepend=np.int8(1)))
        start, end = edge[0::2], edge[1::2]
        return start, end, np.append(np.searchsorted(start, self.starts), len(start))

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the runs of k words of every text (of a text with 1 to k-1 words,
        of the whole sequence), and for each text the index of its first one (one
        entry more than texts)."""
        start, end, first = self.words()
        words = self.hashes(start, end)
        n = np.diff(first)
        count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
        to = np.append(0, np.cumsum(count))
        out = np.empty(to[-1], np.uint64)
        if len(words) >= k:
            owner = np.repeat(np.arange(len(n)), n)
            inside = owner[: len(words) - k + 1] == owner[k - 1 :]
            out[np.repeat(n >= k, count)] = shingles(words, k)[inside]
        for i in np.flatnonzero((n > 0) & (n < k)):
            out[to[i]] = shingles(words[first[i] : first[i + 1]], k)[0]
        return out, to

    def pieces(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Like words(), but the pieces of a text make up the whole text. It is cut
        before a space between two bytes that are not white space (the space stays with
        what follows), after a line feed between two such bytes, and between an ASCII
        letter and an ASCII mark."""
        data = self.data
        space = _WS[data] | ((data >= 0x1C) & (data <= 0x1F))
        cut = data == 0x20
        cut[1:] &= ~space[:-1]
        cut[:-1] &= ~space[1:]
        cut[2:] |= (data[1:-1] == 0x0A) & ~space[:-2] & ~space[2:]
        cut[1:] |= _LETTER[data[:-1]] & _MARK[data[1:]]
        return self._between(cut)

    def cut_words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Like pieces(), cut before each space that follows another byte, and around each line feed."""
        feed = self.data == 0x0A
        cut = self.data == 0x20
        cut[1:] &= self.data[:-1] != 0x20
        cut |= feed
        cut[1:] |= feed[:-1]
        return self._between(cut)

    def _between(self, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        cut[self.ends[self.ends < len(cut)]] = False
        full = self.ends > self.starts
        cut[self.starts[~full]] = False
        cut[self.starts[full]] = True
        start = np.flatnonzero(cut)
        first = np.append(np.searchsorted(start, self.starts), len(start))
        end = np.append(start[1:], 0)
        last = first[1:][full] - 1
        end[last] = self.ends[full]
        return start, end, first


class Codes:
    """A hash table from 64-bit keys to the order in which they came, by linear probing
    over whole arrays at once. Key 0 stands for an empty slot and is moved to 1."""

    def __init__(self, most: int):
        self.size = 1 << (2 * most - 1).bit_length()
        self.keys = np.zeros(self.size, np.uint64)
        self.codes = np.zeros(self.size, np.int32)
        self.n = 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Codes of keys; -1 for unknown ones."""
        keys = np.maximum(keys, 1)
        at = (keys & np.uint64(self.size - 1)).astype(np.int64)
        here = self.keys[at]
        out = np.where(here == keys, self.codes[at], -1)
        left = np.flatnonzero((here != keys) & (here != 0))
        while len(left):
            at[left] = (at[left] + 1) & (self.size - 1)
            here = self.keys[at[left]]
            hit = here == keys[left]
            out[left[hit]] = self.codes[at[left[hit]]]
            left = left[~hit & (here != 0)]
        return out

    def add(self, keys: np.ndarray) -> None:
        """Enters distinct unknown keys, which get the next codes."""
        keys = np.maximum(keys, 1)
        code = np.arange(self.n, self.n + len(keys), dtype=np.int32)
        at = (keys & np.uint64(self.size - 1)).astype(np.int64)
        left = np.arange(len(keys))
        while len(left):
            slot = at[left]
            free = self.keys[slot] == 0
            self.keys[slot[free]] = keys[left[free]]
            own = free & (self.keys[slot] == keys[left])
            self.codes[slot[own]] = code[left[own]]
            left = left[~own]
            at[left] = (at[left] + 1) & (self.size - 1)
        self.n += len(keys)


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x


def blocks(texts: list[str], lower: bool = True, most: int = BLOCK_BYTES) -> Iterator[tuple[int, Block]]:
    """(index of the first text, block) for runs of about `most` bytes; a longer
    text is a block of its own."""
    run: list[bytes] = []
    size = first = 0
    for i, text in enumerate(texts):
        b = (text or "").encode("utf-8", "replace")
        if run and size + len(b) > most:
            yield first, Block(run, lower)
            run, size, first = [], 0, i
        run.append(b)
        size += len(b) + 1
    if run:
        yield first, Block(run, lower)


def shingles(word_hash: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k words; with 1 to k-1 words, of the whole sequence."""
    n = len(word_hash)
    if not n:
        return np.zeros(0, np.uint64)
    width = min(n, k)
    out = np.full(n - width + 1, np.uint64(width), np.uint64)
    for j in range(width):
        out = out * np.uint64(P) + mix(word_hash[j : n - width + 1 + j])
    return mix(out)
