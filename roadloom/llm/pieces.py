"""Token ids of whole texts by way of their distinct pieces.

A byte-level BPE vocabulary splits text by a pattern before it merges, and that
pattern always splits before a space that stands between two characters other than
white space, and between a letter and a mark. Each piece between such places is
encoded once per Python worker and then looked up by its hash, so a text costs a few array operations. Texts with
white space outside ASCII go to the tokenizer whole.
"""

from __future__ import annotations

import os
import re
from pathlib import Path

import numpy as np
from pyspark import Broadcast
from pyspark.sql import SparkSession

from .kernels import Block, Codes, blocks

# The characters outside ASCII that the split pattern counts as white space.
_WIDE_SPACE = re.compile("[\x85\xa0  -     　]")
# One letter run with its space: a single unit of the split pattern.
_LETTERS = re.compile("[ ]?[A-Za-zÀ-ÖØ-öø-ÿ]+")


def byte_letters() -> dict[int, str]:
    """The printable character by which a byte-level vocabulary writes each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


class PieceEncoder:
    """Ids of texts, with a cache of at most about `most` pieces that starts anew when
    full."""

    def __init__(self, vocabulary: bytes, most: int = 1_500_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary.decode())
        self.tokenizer.encode_special_tokens = True
        self.letters = byte_letters()
        self.most = most
        self._clear()

    def _clear(self) -> None:
        self.table = Codes(self.most)
        self.flat = np.zeros(1 << 16, np.uint32)
        self.offset = np.zeros(1 << 14, np.int64)
        self.used = 0

    def encode_whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def cut(self, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return block.pieces()

    def stays_whole(self, text: str) -> bool:
        """Whether pieces would not give the ids of the whole."""
        return bool(_WIDE_SPACE.search(text))

    def token_bytes(self) -> list[bytes]:
        """The bytes that each id stands for."""
        letter = {c: b for b, c in self.letters.items()}
        entries = self.tokenizer.get_vocab(with_added_tokens=True)
        added = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        out = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            out[i] = entry.encode() if entry in added else bytes(letter[c] for c in entry)
        return out

    def _encode(self, pieces: list[bytes]) -> tuple[list[int], list[int]]:
        """(ids of all pieces, how many there are up to each piece's end)"""
        merge = self.tokenizer.model.tokenize
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        plain, letters, blank = _LETTERS.fullmatch, self.letters, self.letters[0x20]
        ids: list[int] = []
        ends: list[int] = []
        for piece in pieces:
            text = piece.decode()
            if not plain(text):
                for unit, _ in split(text):
                    ids += [t.id for t in merge(unit)]
            elif len(text) == len(piece):  # ASCII
                ids += [t.id for t in merge(blank + text[1:] if text[0] == " " else text)]
            else:
                ids += [t.id for t in merge(piece.decode("latin-1").translate(letters))]
            ends.append(len(ids))
        return ids, ends

    def _add(self, keys: np.ndarray, pieces: list[bytes]) -> None:
        ids, ends = self._encode(pieces)
        if self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(len(self.flat), len(ids)), np.uint32)])
        self.flat[self.used : self.used + len(ids)] = ids
        n = self.table.n
        if n + len(ends) >= len(self.offset):
            self.offset = np.concatenate([self.offset, np.zeros(max(len(self.offset), len(ends)), np.int64)])
        self.offset[n + 1 : n + 1 + len(ends)] = self.used + np.array(ends, np.int64)
        self.used += len(ids)
        self.table.add(keys)

    def codes(self, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(piece codes, their starts, their ends, index of each text's first piece)."""
        start, end, first = self.cut(block)
        keys = np.maximum(block.hashes(start, end), 1)
        codes = self.table.find(keys)
        missing = np.flatnonzero(codes < 0)
        if len(missing):
            new, at = np.unique(keys[missing], return_index=True)
            if self.table.n + len(new) > self.most:
                self._clear()
                missing = np.arange(len(keys))
                new, at = np.unique(keys, return_index=True)
                if len(new) > self.most:
                    self.table = Codes(len(new))
            at = missing[at]
            raw = block.raw
            self._add(new, [raw[a:b] for a, b in zip(start[at].tolist(), end[at].tolist())])
            codes[missing] = self.table.find(keys[missing])
        return codes, start, end, first

    def lengths(self, codes: np.ndarray) -> np.ndarray:
        return self.offset[codes + 1] - self.offset[codes]

    def ids(self, texts: list[str | None], end_id: int | None = None) -> list[np.ndarray]:
        """The ids of every text, each with `end_id` appended if it is given."""
        tail = np.zeros(0, np.uint32) if end_id is None else np.array([end_id], np.uint32)
        out: list[np.ndarray] = []
        for first_text, block in blocks(texts, lower=False):
            codes, _, _, first = self.codes(block)
            n = self.lengths(codes)
            to = np.zeros(len(n) + 1, np.int64)
            np.cumsum(n, out=to[1:])
            flat = self.flat[np.repeat(self.offset[codes] - to[:-1], n) + np.arange(to[-1])]
            wide = self.stays_whole(block.raw.decode())
            for i in range(len(block.starts)):
                text = (texts[first_text + i] or "") if wide else ""
                if wide and self.stays_whole(text):
                    got = np.array(self.encode_whole(text), np.uint32)
                else:
                    got = flat[to[first[i]] : to[first[i + 1]]]
                out.append(np.concatenate([got, tail]))
        return out


class SentencePieces(PieceEncoder):
    """Ids of a sentencepiece BPE model for texts that bring their own leading space.

    No piece of the model has a space after another character, and none has a line
    feed, so merges can't cross the places before a space that follows another character and
    around a line feed. (A model with such pieces encodes texts whole.)"""

    def __init__(self, vocabulary: bytes, most: int = 1_500_000):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=vocabulary)
        self.entries = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        plain = [e for i, e in enumerate(self.entries) if not (self.model.is_control(i) or self.model.is_byte(i) or self.model.is_unknown(i))]
        self.whole = any("\u2581" in e.lstrip("\u2581") or "\n" in e for e in plain)
        self.most = most
        self._clear()

    def encode_whole(self, text: str) -> list[int]:
        if not text.startswith(" "):
            raise ValueError("a text brings the space that the model would add")
        return self.model.encode(text[1:], num_threads=1)

    def cut(self, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return block.cut_words()

    def stays_whole(self, text: str) -> bool:
        return self.whole

    def token_bytes(self) -> list[bytes]:
        """A byte piece stands for its byte, U+2581 for a space."""
        return [bytes([int(e[3:5], 16)]) if self.model.is_byte(i) else e.replace("\u2581", " ").encode() for i, e in enumerate(self.entries)]

    def _encode(self, pieces: list[bytes]) -> tuple[list[int], list[int]]:
        # The model adds a space: in place of the piece's own, or else before a line
        # feed that keeps it apart; those two ids go. (It adds none to an empty text.)
        spaced = [p[:1] == b" " and len(p) > 1 for p in pieces]
        got = self.model.encode([p[1:].decode() if own else "\n" + p.decode() for p, own in zip(pieces, spaced)], num_threads=1)
        ids: list[int] = []
        ends: list[int] = []
        for found, own in zip(got, spaced):
            ids += found if own else found[2:]
            ends.append(len(ids))
        return ids, ends


_encoders: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """An encoder for the vocabulary at `path`, one for each process."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(Path(path).read_bytes())
    return _encoders[path]


def shared_vocabulary(spark: SparkSession, path: str) -> Broadcast[bytes]:
    """The driver's vocabulary file for all tasks; executors needn't have it."""
    return spark.sparkContext.broadcast(Path(path).read_bytes())


def task_encoder(vocabulary: Broadcast[bytes], kind: type[PieceEncoder] = PieceEncoder) -> PieceEncoder:
    """This worker's encoder for a vocabulary that was shared."""
    key = f"{kind.__name__}:{hash(vocabulary.value)}:{len(vocabulary.value)}"
    if key not in _encoders:
        _encoders[key] = kind(vocabulary.value)
    return _encoders[key]


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
