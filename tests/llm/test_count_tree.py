import random

import numpy as np
import pytest

from roadloom.llm.pieces import default_vocabulary, encoder
from roadloom.llm.token_counts import CountTree, splitter

WORDS = ["alpha", "Beta,", "gamma!", "d'elta", "été", "日本", "12345", "\n", "  ", "e-mail", "x", "(y)", "\t", ""]


def tree_of(text):
    split = splitter(encoder(default_vocabulary()))
    return CountTree(text, *split(text), split)


def full(text):
    return len(encoder(default_vocabulary()).encode_whole(text))


@pytest.mark.parametrize("batches", [1, 2, 10])
@pytest.mark.parametrize("seed", range(6))
def test_batches_of_edits_against_full_encodings(batches, seed):
    rnd = random.Random(100 * batches + seed)
    words = [w for w in WORDS for _ in range(3)] + (["\xa0"] if seed % 2 else [])
    text = " ".join(rnd.choice(words) for _ in range(rnd.choice([0, 1, 30, 300])))
    tree = tree_of(text)
    for _ in range(batches):
        edits, at = [], 0
        while True:
            start = at + rnd.randrange(1 + max(1, len(text) // 4))
            if start > len(text):
                break
            end = min(len(text), start + rnd.choice([0, 0, 1, 3, 20, 60]))
            edits.append((start, end, rnd.choice(["", "z", " new words here", "-", "[redacted]", "\n\n", "日"])))
            at = end + rnd.randrange(1, 4)
        for start, end, by in reversed(edits):
            text = text[:start] + by + text[end:]
        tree.apply(edits)
        assert tree.text() == text
        assert (tree.total, tree.chars) == (full(text), len(text))


def test_a_text_that_grows_from_nothing_and_is_emptied():
    tree = tree_of("")
    tree.apply([(0, 0, "one two three")])
    tree.apply([(13, 13, " four"), ])
    assert (tree.text(), tree.total) == ("one two three four", full("one two three four"))
    tree.apply([(0, 18, "")])
    assert (tree.text(), tree.total, tree.chars) == ("", 0, 0)
    tree.apply([(0, 0, "again")])
    assert (tree.text(), tree.total) == ("again", full("again"))


def test_edits_encode_what_they_touch():
    text = "some words of a long text " * 4000
    tree = tree_of(text)
    for i in range(5):
        before = tree.encoded
        tree.apply([(1000 * k + i, 1000 * k + i + 2, "ab") for k in range(1, 4)])
        assert tree.encoded - before < 3 * 60
    assert tree.total == full(tree.text())
    assert np.array_equal(tree.sums[1], [tree.total, tree.chars])
