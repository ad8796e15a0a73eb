import random
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from roadloom.llm.kernels import Block, Codes, blocks
from roadloom.llm.pieces import default_vocabulary, encoder
from roadloom.llm.token_file import EliasFano, Shard, pack_shard

TEXTS = ["", " ", "a", "a b", "  a  b ", "x\xa0y z", "don't  'll \n\n b", "\t a\n b 's", "日本 語 a", "a \x1c b", "Été\n\nça va, «oui».", "a,b.c d-e (f)", "é" * 50, "<|endoftext|> x", "a  b", "1 22 333,4"]


def test_words_are_the_pattern():
    import re

    for text in TEXTS:
        block = Block([text.encode()])
        start, end, _ = block.words()
        assert [block.raw[a:b].decode() for a, b in zip(start, end)] == re.findall(r"[^\x20\x09-\x0D]+", text)


def test_hashes_depend_on_bytes_alone():
    block = Block([b"one two one", b"two one"])
    start, end, first = block.words()
    h = block.hashes(start, end)
    assert h[0] == h[2] == h[4] and h[1] == h[3] and h[0] != h[1]
    assert first.tolist() == [0, 3, 5]


def test_shingles_of_short_texts():
    block = Block([b"", b"a", b"a b c", b"a b c d e"])
    h, first = block.shingles(4)
    assert np.diff(first).tolist() == [0, 1, 1, 2]
    assert len(set(h.tolist())) == 4


@given(st.lists(st.text(alphabet=" \n\tabcéß,.'!1\xa0日", max_size=40), max_size=6))
@settings(max_examples=150, deadline=None)
def test_pieces_give_the_tokenizer_ids(texts):
    enc = encoder(default_vocabulary())
    assert [x.tolist() for x in enc.ids(texts)] == [enc.encode_whole(t) for t in texts]


def test_encoder_on_fixed_texts_and_nulls():
    enc = encoder(default_vocabulary())
    got = enc.ids([*TEXTS, None], 0)
    assert [x.tolist() for x in got] == [enc.encode_whole(t) + [0] for t in [*TEXTS, ""]]


def test_a_full_cache_starts_anew():
    from roadloom.llm.pieces import PieceEncoder

    enc = PieceEncoder(Path(default_vocabulary()).read_bytes(), most=50)
    texts = [" ".join(f"w{i * j}" for j in range(30)) for i in range(20)]
    assert [x.tolist() for x in enc.ids(texts)] == [enc.encode_whole(t) for t in texts]


def test_codes_table():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 63, 5000).astype(np.uint64))
    table = Codes(6000)
    table.add(keys[:3000])
    table.add(keys[3000:])
    assert (table.find(keys) == np.arange(len(keys))).all()
    assert (table.find(keys + np.uint64(1))[~np.isin(keys + np.uint64(1), keys)] == -1).all()


def test_blocks_keep_all_texts():
    texts = ["x" * n for n in (0, 10, 500, 3, 0)]
    got = [t for _, b in blocks(texts, most=100) for t in (b.raw[s:e].decode() for s, e in zip(b.starts, b.ends))]
    assert got == texts


def test_elias_fano_round_trip():
    rnd = random.Random(3)
    for values in ([], [0], [0, 0, 5], [7] * 300, sorted(rnd.randrange(10**6) for _ in range(1000)), list(range(5000)), [0] * 700 + [10**12]):
        top = max(values, default=0)
        ef = EliasFano.build(np.array(values, np.int64), top)
        assert ef.select(np.arange(len(values))).tolist() == values
        some = np.array(rnd.choices(range(len(values)), k=20) if values else [], np.int64)  # any order, repeated
        assert ef.select(some).tolist() == [values[i] for i in some]
        data = b"head" * 2 + ef.tobytes() + b"tail"
        again, at = EliasFano.read(data, 8, len(values), top)
        assert at == len(data) - 4 and again.select(np.arange(len(values))).tolist() == values
    # about 2 + log2(top / n) bits a value
    assert len(EliasFano.build(np.array(sorted(rnd.randrange(10**6) for _ in range(1000))), 10**6).tobytes()) * 8 < 1000 * 13


def test_shard_round_trip():
    ids = [np.array(x, np.uint32) for x in ([9], [1, 2, 0], [0], [], list(range(70)))]
    keys = [None, -7, 5, 5, 6]
    for width in (2, 4):
        shard = Shard(pack_shard(keys, ids, width))
        assert (shard.n, shard.m) == (5, 75)
        assert shard.doc_ids(np.arange(5)) == keys and shard.doc_ids(np.array([0, 3])) == [None, 5]
        assert shard.bounds(np.arange(6)).tolist() == [0, 1, 4, 5, 5, 75]
        assert all((shard.document(i) == ids[i]).all() for i in range(5))
    assert Shard(pack_shard([], [], 2)).n == 0


def test_shards_refuse_what_they_cannot_hold():
    one = np.zeros(1, np.uint32)
    for keys in ([5, 7, 6, 9], [1, None]):
        with pytest.raises(ValueError, match="ascending"):
            pack_shard(keys, [one] * len(keys), 2)
    with pytest.raises(ValueError, match="does not fit"):
        pack_shard([1], [np.array([1 << 16], np.uint32)], 2)
    with pytest.raises(ValueError, match="not a token shard"):
        Shard(b"XXXX" + bytes(60))
