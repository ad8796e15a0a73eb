"""Operator 7: token-ID output with Elias-Fano document boundaries.

Format of one shard (little-endian):

    magic "RLTI" | u8 version 2 | u8 id width (2 or 4 bytes) | u16 zero
    u64 documents n | u64 ids m | u64 documents without an id | i64 first doc_id
    u64 last doc_id - first doc_id
    doc_ids - first doc_id, as an Elias-Fano sequence | the n boundaries, likewise | the m ids

A boundary is the number of ids up to and including a document. An Elias-Fano sequence
of n values up to `top` has the l = floor(log2(top / n)) low bits of each, padded to 8
bytes, then a unary bit string with a set bit at place (value >> l) + i for value i,
padded to 8 bytes: about 2 + log2(top / n) bits a value instead of 64. `select` finds
set bits by the running count before every eighth of the string's 64-bit words and the
counts within those eight, so it adds one bit for each eight of the string.

A shard is a row of a Parquet table (shard, bytes). Spark writes and commits it, so
any file system will do and a lost executor's shards are simply written again.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, keep, small
from .pieces import shared_vocabulary, task_encoder

MAGIC, HEADER = b"RLTI", "<4sBBHQQQqQ"
SHARD_IDS = 1_000_000
RUN = 8  # words with one running count


class EliasFano:
    """A non-decreasing sequence of n integers in [0, top]."""

    def __init__(self, n: int, top: int, low: np.ndarray, high: np.ndarray):
        self.n, self.low_bits = n, self.width(n, top)
        self.low, self.high = low, high  # packed bytes
        full = np.frombuffer(high.tobytes() + bytes(-len(high) % (8 * RUN)), "<u8").reshape(-1, RUN)
        self._words = full
        self._before = np.append(0, np.cumsum(np.bitwise_count(full).sum(1, dtype=np.int64)))  # set bits before each run

    @staticmethod
    def width(n: int, top: int) -> int:
        return max(0, (top // n).bit_length() - 1) if n else 0

    @classmethod
    def build(cls, values: np.ndarray, top: int) -> EliasFano:
        n = len(values)
        l = cls.width(n, top)
        values = values.astype(np.uint64)
        low = ((values[:, None] >> np.arange(l, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        high = np.zeros((top >> l) + n + 1, np.uint8)
        high[(values >> np.uint64(l)).astype(np.int64) + np.arange(n)] = 1
        pack = lambda bits: np.frombuffer(_pad(np.packbits(bits, bitorder="little").tobytes()), np.uint8)
        return cls(n, top, pack(low.reshape(-1)), pack(high))

    @classmethod
    def read(cls, data: bytes, at: int, n: int, top: int) -> tuple[EliasFano, int]:
        """The sequence at byte `at`, and where it ends."""
        l = cls.width(n, top)
        low, high = (-(-bits // 64) * 8 for bits in (n * l, (top >> l) + n + 1))
        found = cls(n, top, np.frombuffer(data, np.uint8, low, at), np.frombuffer(data, np.uint8, high, at + low))
        return found, at + low + high

    def tobytes(self) -> bytes:
        return self.low.tobytes() + self.high.tobytes()

    def select(self, i: np.ndarray) -> np.ndarray:
        """The values of the given numbers, from one word of the unary string each."""
        i = np.asarray(i, np.int64)
        run = np.searchsorted(self._before, i, "right") - 1
        words = self._words[run]
        upto = np.cumsum(np.bitwise_count(words), axis=1, dtype=np.int64)
        left = i - self._before[run]
        word = (upto > left[:, None]).argmax(1)
        row = np.arange(len(i))
        left -= np.where(word > 0, upto[row, np.maximum(word - 1, 0)], 0)
        bits = np.unpackbits(words[row, word].reshape(-1, 1).view(np.uint8), axis=1, bitorder="little")
        place = 64 * (RUN * run + word) + (np.cumsum(bits, axis=1) == left[:, None] + 1).argmax(1)
        at = i[:, None] * self.low_bits + np.arange(self.low_bits)
        low = (self.low[at >> 3] >> (at & 7).astype(np.uint8)) & 1
        high = (place - i).astype(np.uint64) << np.uint64(self.low_bits)
        return high + low.astype(np.uint64) @ (np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64))


def _pad(b: bytes) -> bytes:
    return b + bytes(-len(b) % 8)


def pack_shard(doc_ids: list[int | None], ids: list[np.ndarray], width: int) -> bytes:
    """A shard of documents, which must come in ascending order of their ids, those without
    one first."""
    ends = np.cumsum([len(x) for x in ids], dtype=np.int64)
    m = int(ends[-1]) if len(ends) else 0
    flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
    if m and int(flat.max()) >> (8 * width):
        raise ValueError(f"id {flat.max()} does not fit into {width} bytes")
    named = [d for d in doc_ids if d is not None]
    if any(d is not None for d in doc_ids[: len(doc_ids) - len(named)]) or any(a > b for a, b in zip(named, named[1:])):
        raise ValueError("a shard's documents come in ascending order of their ids, those without one first")
    first, reach = (named[0], named[-1] - named[0]) if named else (0, 0)
    offsets = np.array([d - first for d in named], np.uint64)
    head = struct.pack(HEADER, MAGIC, 2, width, 0, len(doc_ids), m, len(doc_ids) - len(named), first, reach)
    return b"".join((head, EliasFano.build(offsets, reach).tobytes(), EliasFano.build(ends, m).tobytes(), flat.astype(f"<u{width}").tobytes()))


class Shard:
    """Reads a packed shard; `document(i)` touches only that document's ids."""

    def __init__(self, data: bytes):
        magic, version, width, _, self.n, self.m, self.unnamed, self.first, reach = struct.unpack_from(HEADER, data)
        if magic != MAGIC or version != 2:
            raise ValueError("not a token shard")
        self.names, at = EliasFano.read(data, struct.calcsize(HEADER), self.n - self.unnamed, reach)
        self.index, at = EliasFano.read(data, at, self.n, self.m)
        self.ids = np.frombuffer(data, f"<u{width}", self.m, at)

    def doc_ids(self, i: np.ndarray) -> list[int | None]:
        """Ids of the documents of the given ascending numbers."""
        named = self.names.select(i[i >= self.unnamed] - self.unnamed)
        return [None] * int((i < self.unnamed).sum()) + [self.first + int(x) for x in named]

    def bounds(self, i: np.ndarray) -> np.ndarray:
        """How many ids stand before the documents of the given numbers (n: before the end)."""
        return np.where(i > 0, self.index.select(np.maximum(i - 1, 0)).astype(np.int64), 0)

    def document(self, i: int) -> np.ndarray:
        start, end = self.bounds(np.array([i, i + 1]))
        return self.ids[start:end]


def write_shards(docs: DataFrame, path_or_name: str, vocabulary: str, end_id: int = 0, width: int = 2, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Encodes `docs` (doc_id, text), appends `end_id` to each document and writes the
    ids in ascending doc_id order; returns the table (part, shard, bytes) as read back.

    A null text is an empty one, a document of the end id alone. Rows with a null
    doc_id come first. Rows that repeat an id stay, equal ids in the order of their texts'
    hashes. Other columns are not read. An empty table gives no shard. A shard holds about
    `shard_ids` ids, a longer document being a shard of its own, so that a task
    holds one shard at a time. `width` is the bytes of an id: 2 suits vocabularies
    of up to 65,536 entries; an id that doesn't fit is an error.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = shared_vocabulary(spark, vocabulary)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = "part int, shard int, documents long, ids long, bytes binary"

    def encode(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, shard, held, doc_ids, ids = task_encoder(shared), 0, 0, [], []

        def close() -> pd.DataFrame:
            return pd.DataFrame({"part": [part], "shard": [shard], "documents": [len(doc_ids)], "ids": [held], "bytes": [pack_shard(doc_ids, ids, width)]})

        part = 0
        for pdf in rows:
            part = int(pdf["part"].iloc[0]) if len(pdf) else part
            texts, keys = pdf["text"].tolist(), pdf["doc_id"].astype("Int64").astype(object).where(pdf["doc_id"].notna(), None).tolist()
            for at in range(0, len(texts), 512):
                for key, got in zip(keys[at : at + 512], enc.ids(texts[at : at + 512], end_id)):
                    if ids and held + len(got) > shard_ids:
                        yield close()
                        shard, held, doc_ids, ids = shard + 1, 0, [], []
                    doc_ids.append(key)
                    ids.append(got)
                    held += len(got)
        if ids:
            yield close()

    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
        .withColumn("order", F.xxhash64("text"))
        .repartitionByRange(n, F.col("doc_id").asc_nulls_first(), "order")
        .withColumn("part", F.spark_partition_id())
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "order", "text")
        .select("part", "doc_id", "text")
    )
    return keep(ordered.mapInPandas(encode, schema), path_or_name)


def read_index(shards: DataFrame) -> DataFrame:
    """Per document of a shard table: doc_id, start (ids of all documents before it),
    n_tokens and ids_crc32 (of its ids as little-endian unsigned 32-bit integers)."""
    sizes = shards.select("part", "shard", "ids")
    parts = sizes.groupBy("part").agg(F.sum("ids").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        sizes.withColumn("within", F.coalesce(F.sum("ids").over(inside), F.lit(0)))
        .join(parts, "part")
        .select("part", "shard", (F.col("before") + F.col("within")).alias("base"))
    )
    placed = shards.join(small(bases), ["part", "shard"]).select("base", "bytes")

    def decode(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in rows:
            for base, data in zip(pdf["base"], pdf["bytes"]):
                shard = Shard(data)
                for at in range(0, shard.n, 4096):
                    i = np.arange(at, min(shard.n, at + 4096))
                    bounds = shard.bounds(np.append(i, i[-1] + 1))
                    ids = shard.ids[bounds[0] : bounds[-1]].astype("<u4")
                    cut = bounds - bounds[0]
                    yield pd.DataFrame(
                        {
                            "doc_id": pd.array(shard.doc_ids(i), "Int64"),
                            "start": bounds[:-1] + base,
                            "n_tokens": np.diff(bounds),
                            "ids_crc32": [zlib.crc32(ids[a:b]) for a, b in zip(cut[:-1], cut[1:])],
                        }
                    )

    return placed.mapInPandas(decode, "doc_id long, start long, n_tokens long, ids_crc32 long")
