"""Signature trees over token sets, for exact Jaccard joins inside one task.

A leaf is one set: a bitmap in which every token sets one bit, and its size. Inner
nodes hold the OR of their children's bitmaps and the range of their sizes. For
x below node A and y below node B, the tokens of x & y can only set bits that both
ORs have, so

    |x & y| <= bits(OR_A & OR_B) + min(most collisions below A, below B)

(a set's collisions: its size minus its bits). Node pairs whose bound or size ranges
can't reach the threshold are dropped with everything below them; leaf pairs that
are left are compared exactly. Pairs that are already linked through others are
skipped, so a group of n near copies costs about n comparisons, not n squared.
"""

from __future__ import annotations

import numpy as np

FANOUT = 8
STRETCH_WORDS = 1 << 16  # of bitmaps that are compared at a time


def needed(x, y, percent: int):
    """Least overlap of sets of sizes x and y with 100 * overlap >= percent * union."""
    return -(-percent * (x + y) // (100 + percent))


def bitmap(tokens: np.ndarray, bits: int) -> np.ndarray:
    """The signature of a set of uint64 tokens, as bits / 64 words."""
    out = np.zeros(bits // 64, np.uint64)
    at = tokens & np.uint64(bits - 1)
    np.bitwise_or.at(out, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
    return out


def folded(signature: np.ndarray, words: int) -> np.ndarray:
    """A signature of fewer bits: its parts OR-combined, as tokens are dealt by their
    lower bits."""
    return np.bitwise_or.reduce(signature.reshape(-1, words), axis=0)


class SignatureTree:
    def __init__(self, leaf: np.ndarray, sizes: np.ndarray):
        """`leaf`: bitmaps of sets in order of their sizes."""
        self.sizes = np.asarray(sizes, np.int64)
        clash = self.sizes - np.bitwise_count(leaf).sum(1, dtype=np.int64)
        self.levels = [(leaf, self.sizes, self.sizes, clash)]  # from leaves to root
        while len(self.levels[-1][0]) > 1:
            bits, low, high, most = self.levels[-1]
            cut = np.arange(0, len(bits), FANOUT)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(bits, cut),
                    np.minimum.reduceat(low, cut),
                    np.maximum.reduceat(high, cut),
                    np.maximum.reduceat(most, cut),
                )
            )

    @classmethod
    def of_sets(cls, sets: list[np.ndarray], bits: int) -> SignatureTree:
        return cls(np.array([bitmap(s, bits) for s in sets]), np.array([len(s) for s in sets]))


def signature_bits(largest: int) -> int:
    return min(1 << 15, max(256, 1 << (2 * largest - 1).bit_length()))


def _possible(a, b, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Of the node pairs (i of level a, j of level b), those that may hold a link."""
    low_a, high_a, low_b, high_b = a[1][i], a[2][i], b[1][j], b[2][j]
    keep = (100 * high_a >= percent * low_b) & (100 * high_b >= percent * low_a)
    keep = np.flatnonzero(keep)
    good, step = [], max(16, STRETCH_WORDS // a[0].shape[1])
    for part in (keep[at : at + step] for at in range(0, len(keep), step)):
        p, q = i[part], j[part]
        common = np.bitwise_count(a[0][p] & b[0][q]).sum(1, dtype=np.int64)
        bound = common + np.minimum(a[3][p], b[3][q])
        good.append(part[bound >= needed(np.maximum(a[1][p], 1), np.maximum(b[1][q], 1), percent)])
    return np.concatenate(good) if good else keep


def dual_traversal(a: SignatureTree, b: SignatureTree, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Leaf pairs (i, j) that no bound rules out; of a tree with itself, i < j."""
    same = a is b
    depth = max(len(a.levels), len(b.levels))
    level = lambda t, k: t.levels[min(k, len(t.levels) - 1)]
    i = j = np.zeros(1, np.int32)
    for k in range(depth - 1, -1, -1):
        if k < depth - 1:
            i, j = _children(i, j, k, a, b)
        if same:
            ok = i < j if k == 0 else i <= j
            i, j = i[ok], j[ok]
        ok = _possible(level(a, k), level(b, k), i, j, percent)
        i, j = i[ok], j[ok]
    return i, j


def _children(i, j, k, a, b):
    def below(x, tree):
        if k >= len(tree.levels) - 1:  # this tree's root, not yet opened
            return x[:, None]
        kids = x[:, None] * np.int32(FANOUT) + np.arange(FANOUT, dtype=np.int32)
        return np.where(kids < len(tree.levels[k][0]), kids, np.int32(-1))

    p, q = below(i, a), below(j, b)
    left = np.repeat(p, q.shape[1], axis=1).reshape(-1)
    right = np.tile(q, (1, p.shape[1])).reshape(-1)
    ok = (left >= 0) & (right >= 0)
    return left[ok], right[ok]


def overlap(x: np.ndarray, y: np.ndarray) -> int:
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum())


class Forest:
    """Disjoint sets of hashable things; the smallest stands for each."""

    def __init__(self, things):
        self.parent = {x: x for x in things}

    def find(self, x):
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, x, y) -> None:
        self.parent[max(x, y)] = min(x, y)


def possible_ties(ids: list[int], signatures: list[np.ndarray], sizes: list[int], percent: int) -> list[tuple[int, int]]:
    """Pairs that connect all sets between which the bounds allow a link; sets are given
    by their signatures and sizes alone."""
    if len(ids) == 2:
        a, b = signatures
        words = min(len(a), len(b))
        a, b = folded(a, words), folded(b, words)
        low, high = sorted(sizes)
        bits = [int(np.bitwise_count(x).sum()) for x in (a, b)]
        bound = int(np.bitwise_count(a & b).sum()) + min(sizes[0] - bits[0], sizes[1] - bits[1])
        return [(ids[0], ids[1])] if 100 * low >= percent * high and bound >= needed(low, high, percent) else []
    order = np.argsort(sizes, kind="stable")
    words = min(len(s) for s in signatures)
    tree = SignatureTree(np.array([folded(signatures[k], words) for k in order]), np.array(sizes)[order])
    i, j = dual_traversal(tree, tree, percent)
    forest, found = Forest(ids), []
    for p, q in zip(order[i].tolist(), order[j].tolist()):
        x, y = forest.find(ids[p]), forest.find(ids[q])
        if x != y:
            forest.join(x, y)
            found.append((ids[p], ids[q]))
    return found


def link(ids: list[int], sets: list[np.ndarray], percent: int, other: tuple[list[int], list[np.ndarray]] | None = None) -> list[tuple[int, int]]:
    """Links that connect all that the threshold connects: within the given sets, or
    between them and `other`. Every returned pair meets the threshold."""
    order = np.argsort([len(s) for s in sets], kind="stable")
    ids, sets = [ids[k] for k in order], [sets[k] for k in order]
    if other:
        turn = np.argsort([len(s) for s in other[1]], kind="stable")
        ids2, sets2 = [other[0][k] for k in turn], [other[1][k] for k in turn]
    else:
        ids2, sets2 = ids, sets
    if not ids or not ids2:
        return []
    bits = signature_bits(max(len(sets[-1]), len(sets2[-1])))
    a = SignatureTree.of_sets(sets, bits)
    b = SignatureTree.of_sets(sets2, bits) if other else a
    i, j = dual_traversal(a, b, percent)
    turn = np.argsort(np.abs(i - j), kind="stable")
    forest, found = Forest([*ids, *ids2]), []
    for p, q in zip(i[turn].tolist(), j[turn].tolist()):
        x, y = forest.find(ids[p]), forest.find(ids2[q])
        if x != y and overlap(sets[p], sets2[q]) >= needed(len(sets[p]), len(sets2[q]), percent):
            forest.join(x, y)
            found.append((ids[p], ids2[q]))
    return found
