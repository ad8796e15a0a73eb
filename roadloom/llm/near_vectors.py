"""Operator 11: near-duplicate embeddings by iterative quantisation and Hamming tables.

1. Exact copies. Rows with the same vector share one representative, the smallest id.
2. Codes. Iterative quantisation learns, on a bounded sample, a rotation of the principal
   components of unit vectors that is best for their signs: 64 balanced bits a vector.
   The sample only shapes the codes; every vector has one.
3. Tables. A code is cut into four blocks of 16 bits. Codes that differ in at most 11
   bits differ in at most two bits of some block, so they meet in that block's table
   if each is entered at its own block value and at the 16 values one bit away. No pair
   within the radius can be missed.
4. Crowds. A table value with more vectors than chance brings there (copies with noise)
   is compared in pairs of blocks on codes alone; what lies within the radius there
   is tied, and the components of the ties are crowds. All vectors of a crowd are compared with
   each other in pairs of blocks, which return counts and spanning edges in place of pairs.
5. Elsewhere, code pairs within the radius are few; they become candidates, and the original
   vectors decide, in double precision.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, keep, small

BITS, TABLES, BLOCK = 64, 4, 16
COSINE = 0.95
SAMPLE_ROWS, SAMPLE_VALUES = 20_000, 4_000_000
ROUNDS, KEPT = 50, 0.97  # of iterative quantisation; share of pairs at the threshold to find
PART = 1_024  # vectors of a block in step 4, twice as many in very large groups


def radius(tables: int = TABLES) -> int:
    """Differing bits up to which no pair of codes can be missed: with more, every block
    could differ in three bits. It is enough for a cosine of 0.95, where a bit differs
    with probability acos(0.95) / pi = 0.101, so 6.5 of 64 do on average."""
    return 3 * tables - 1


def usable(vector) -> bool:
    return vector is not None and len(vector) > 0 and all(x is not None for x in vector)


def unit_rows(vectors: list) -> tuple[np.ndarray, np.ndarray]:
    """(rows of unit vectors in double precision, which of `vectors`, all of one length,
    have a finite length above 0). Values are scaled first, so that none over- or underflows."""
    x = np.array(vectors, np.float64)
    most = np.abs(x).max(1, initial=0)
    good = np.isfinite(most) & (most > 0)
    x = x[good] / most[good, None]
    return x / np.linalg.norm(x, axis=1)[:, None], good


class Quantiser:
    """Maps unit vectors of `dims` values to 64-bit codes."""

    def __init__(self, mean: np.ndarray, directions: np.ndarray):
        self.mean, self.directions = mean, directions

    @classmethod
    def fit(cls, x: np.ndarray, cosine: float = COSINE, tables: int = TABLES, seed: int = 11) -> Quantiser:
        """Learns from unit rows. Subtracting their mean balances the bits, but it widens the
        angles between vectors that lie near it. So as much of the mean is subtracted as
        leaves KEPT of the pairs with the given cosine, tried at the rows, within the radius."""
        rng = np.random.default_rng(seed)
        a = x[rng.permutation(len(x))[:2_000]]
        z = rng.standard_normal(a.shape)
        z -= (z * a).sum(1)[:, None] * a
        size = np.linalg.norm(z, axis=1)[:, None]
        b = cosine * a + np.sqrt(1 - cosine**2) * np.divide(z, size, out=np.zeros_like(z), where=size > 0)
        for share in (1.0, 0.75, 0.5, 0.25, 0.0):
            made = cls._fit(x, share, seed)
            if not len(a) or (np.bitwise_count(made.codes(a) ^ made.codes(b)) <= radius(tables)).mean() >= KEPT:
                break
        return made

    @classmethod
    def _fit(cls, x: np.ndarray, share: float, seed: int) -> Quantiser:
        """Each bit is the sign of a rotated principal component; a vector of fewer than 64
        values gets several rotations."""
        rng = np.random.default_rng(seed)
        dims = x.shape[1]
        mean = share * x.mean(0) if len(x) else np.zeros(dims)
        centred = x - mean
        axes = np.linalg.svd(centred.T @ centred)[2][: min(BITS, dims)] if len(x) else np.eye(dims)[: min(BITS, dims)]
        v = centred @ axes.T
        made = []
        for _ in range(-(-BITS // len(axes))):
            r, _ = np.linalg.qr(rng.standard_normal((len(axes), len(axes))))
            for _ in range(ROUNDS if len(x) > 1 else 0):
                signs = np.where(v @ r >= 0, 1.0, -1.0)
                u, _, w = np.linalg.svd(v.T @ signs)
                r = u @ w
            made.append(axes.T @ r)
        return cls(mean, np.concatenate(made, axis=1)[:, :BITS])

    def codes(self, x: np.ndarray) -> np.ndarray:
        bits = (x - self.mean) @ self.directions >= 0
        return np.packbits(bits, axis=1, bitorder="little").view("<u8").reshape(-1)


def train(vectors: DataFrame, cosine: float = COSINE, tables: int = TABLES) -> dict[int, Quantiser]:
    """A quantiser for each length of vectors in the sample: the SAMPLE_ROWS rows with the
    smallest id hashes, or fewer long ones (SAMPLE_VALUES values in all)."""
    longest = vectors.agg(F.max(F.size("embedding"))).first()[0]
    if not longest or longest < 1:
        return {}
    rows = min(SAMPLE_ROWS, max(1, SAMPLE_VALUES // longest))
    found = vectors.where(F.size("embedding") > 0).select("embedding", F.xxhash64("vec_id").alias("h"), "vec_id").orderBy("h", "vec_id").limit(rows)
    by: dict[int, list] = {}
    for row in found.select("embedding").collect():  # bounded by the sample
        if usable(row[0]):
            by.setdefault(len(row[0]), []).append(row[0])
    return {n: Quantiser.fit(unit_rows(x)[0], cosine, tables) for n, x in by.items()}


def _keys(codes: np.ndarray, tables: int) -> np.ndarray:
    """Table values of each code: for each block its own and those one bit away."""
    block = BITS // tables
    flips = np.append(0, 1 << np.arange(block, dtype=np.uint64)).astype(np.uint64)
    out = []
    for t in range(tables):
        own = (codes >> np.uint64(block * t)) & np.uint64((1 << block) - 1)
        out.append((own[:, None] ^ flips) | np.uint64(t << block))
    return np.concatenate(out, axis=1).astype(np.int64)


def _table(codes_a: np.ndarray, codes_b: np.ndarray, tables: int) -> np.ndarray:
    """The first table in which two codes meet (`tables`: in none)."""
    block = BITS // tables
    out = np.full(len(codes_a), tables)
    differ = codes_a ^ codes_b
    for t in reversed(range(tables)):
        out[np.bitwise_count((differ >> np.uint64(block * t)) & np.uint64((1 << block) - 1)) <= 2] = t
    return out


def _spread(near: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect what the matrix `near` (rows a, columns b) connects. a and b hold
    ids; where they are the same rows, `near` is symmetric."""
    low_a, low_b = a.copy(), b.copy()
    top = np.iinfo(np.int64).max
    while True:
        now_a = np.minimum(low_a, np.where(near, low_b, top).min(1, initial=top))
        now_b = np.minimum(low_b, np.where(near, now_a[:, None], top).min(0, initial=top))
        if (now_a == low_a).all() and (now_b == low_b).all():
            break
        low_a, low_b = now_a, now_b
    found = {(int(x), int(y)) for x, y in zip([*a, *b], [*low_a, *low_b]) if x != y}
    return sorted(found)


def in_block_pairs(members: DataFrame, group: str, value: str, run, schema: str) -> DataFrame:
    """`run(a, b)` for each pair of blocks of each group of `members` (group, id, n, value and
    others). A group is cut by hash into blocks of about PART rows (2 * PART in groups of
    more than 64 * PART), and b is None where a block meets itself. No task holds more than two blocks."""
    sizes = keep(members.groupBy(group).agg(F.count("*").alias("rows")), "block-sizes")
    cut = F.when(F.col("rows") > 64 * PART, F.ceil(F.col("rows") / (2 * PART))).otherwise(F.ceil(F.col("rows") / PART)).cast("int")
    placed = members.join(small(sizes.select(group, cut.alias("blocks"))), group).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    # Block x meets y for x <= y: it is side 0 with those from x on, side 1 with those before.
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    sides = placed.select("*", other.alias("other")).select(
        group, F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), F.when(F.col("block") <= F.col("other"), 0).otherwise(1).alias("side"), "id", "n", value
    )

    def pair(pdf: pd.DataFrame) -> pd.DataFrame:
        same = pdf["i"].iloc[0] == pdf["j"].iloc[0]
        return run(pdf[pdf["side"] == 0], None if same else pdf[pdf["side"] == 1])

    return sides.groupBy(group, "i", "j").applyInPandas(pair, schema)


def near_vectors(vectors: DataFrame, cosine: float = COSINE, tables: int = TABLES) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every distinct vec_id of `vectors` (vec_id,
    embedding: an array of numbers).

    Two vectors link when the cosine of the original values, in double precision, is at least
    `cosine` and their codes differ in at most `radius()` bits or both are in one crowd.
    n_links counts the other ids linked directly, copies included; component_id is the smallest
    vec_id that links reach; kept marks the rows whose id it is.

    Vectors that are null, empty or all zeros, or hold a null, NaN or infinite value link with
    nothing, not even equal ones, and are kept. Vectors of different lengths don't
    link; each length has a quantiser of its own. Rows with a null vec_id are left out, as they can't be named.
    Of several vectors under one id the one with the smallest digest counts; repeated rows
    count once. Other columns are not read. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    most = radius(tables)
    rows = vectors.where("vec_id is not null").select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    models = spark.sparkContext.broadcast(train(rows, cosine, tables))

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = dict(models.value)
        for pdf in frames:
            for at in range(0, len(pdf), 2_000):
                part = pdf.iloc[at : at + 2_000]
                by: dict[int, list[int]] = {}
                for i, v in enumerate(part["embedding"]):
                    by.setdefault(len(v) if usable(v) else 0, []).append(i)
                code, digest, ok = np.zeros(len(part), np.int64), [b""] * len(part), np.zeros(len(part), bool)
                for dims, here in by.items():
                    if dims:
                        if dims not in known:  # too rare for the sample: a rotation by chance
                            known[dims] = Quantiser.fit(np.zeros((0, dims)), seed=dims)
                        got = np.stack(part["embedding"].iloc[here].to_numpy()).astype(np.float64)
                        unit, good = unit_rows(got)
                        here = np.array(here)
                        ok[here[good]] = True
                        code[here[good]] = known[dims].codes(unit).view(np.int64)
                        for i, v in zip(here, got + 0.0):  # no -0.0
                            digest[i] = hashlib.md5(v.tobytes()).digest()
                yield pd.DataFrame({"vec_id": part["vec_id"].array, "valid": ok, "digest": digest, "code": code, "embedding": part["embedding"].array})

    coded = keep(rows.mapInPandas(encode, "vec_id long, valid boolean, digest binary, code long, embedding array<double>"), "coded")

    # 1. One row per id; one representative per vector, with the number of ids that have it.
    own = F.min(F.struct((~F.col("valid")).alias("odd"), "digest", "code"))
    ids = keep(coded.groupBy("vec_id").agg(own.alias("o")).select("vec_id", (~F.col("o.odd")).alias("valid"), "o.digest", "o.code"), "ids")
    reps = ids.where("valid").groupBy("digest").agg(F.min("vec_id").alias("id"), F.count("*").alias("n"), F.min("code").alias("code"))
    reps = keep(reps, "reps")

    # 3. Tables.
    def enter(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for at in range(0, len(pdf), 1_000):
                part = pdf.iloc[at : at + 1_000]
                keys = _keys(part["code"].to_numpy().view(np.uint64), tables)
                times = keys.shape[1]
                yield pd.DataFrame({"key": keys.reshape(-1), "id": np.repeat(part["id"].to_numpy(), times), "code": np.repeat(part["code"].to_numpy(), times)})

    entered = keep(reps.select("id", "code").mapInPandas(enter, "key long, id long, code long"), "tables")
    total = reps.count()
    block = BITS // tables
    usual = (block + 1) * total / (1 << block)
    crowd = max(256, int(20 * usual))
    crowded = keep(entered.groupBy("key").agg(F.count("*").alias("rows")).where(F.col("rows") > crowd).select("key"), "crowded")
    crowded = small(crowded)

    # 4. Crowds: ties by codes alone, then all pairs of each crowd on vectors.
    def ties(a: pd.DataFrame, b: pd.DataFrame | None) -> pd.DataFrame:
        x, y = a, a if b is None else b
        cx, cy = (z["code"].to_numpy().view(np.uint64) for z in (x, y))
        near = np.bitwise_count(cx[:, None] ^ cy) <= most
        return pd.DataFrame(_spread(near, x["id"].to_numpy(), y["id"].to_numpy()), columns=["a", "b"]).astype("int64")

    tied = in_block_pairs(entered.join(crowded, "key", "left_semi").withColumn("n", F.lit(1)), "key", "code", ties, "a long, b long")
    crowds = components(tied, "crowds").withColumnRenamed("label", "crowd")
    crowds = keep(crowds, "crowds")
    # The vector of a representative is the one under its own id.
    kept_vector = coded.where("valid").groupBy("vec_id").agg(F.min(F.struct("digest", "embedding")).alias("v")).select(F.col("vec_id").alias("id"), "v.embedding")
    shapes = keep(reps.select("id", "n").join(kept_vector, "id"), "vectors")

    def linked(a: pd.DataFrame, b: pd.DataFrame | None) -> pd.DataFrame:
        count: dict[int, int] = {}
        edges = []
        for dims in sorted(set(a["embedding"].map(len))):
            x = a[a["embedding"].map(len) == dims]
            y = x if b is None else b[b["embedding"].map(len) == dims]
            if not len(y):
                continue
            ux, uy = (unit_rows(np.stack(z["embedding"].to_numpy()))[0] for z in (x, y))
            near = ux @ uy.T >= cosine
            if b is None:
                np.fill_diagonal(near, False)
            weights = [(x, near @ y["n"].to_numpy())] + ([] if b is None else [(y, near.T @ x["n"].to_numpy())])
            for z, w in weights:
                for i, k in zip(z["id"], w):
                    count[i] = count.get(i, 0) + int(k)
            edges += _spread(near, x["id"].to_numpy(), y["id"].to_numpy())
        found = [(i, None, k) for i, k in count.items() if k] + [(i, j, 0) for i, j in edges]
        return pd.DataFrame(found, columns=["a", "b", "links"]).astype({"a": "int64", "b": "Int64", "links": "int64"})

    inside = shapes.join(crowds, "id").select("crowd", "id", "n", "embedding")
    inside = keep(in_block_pairs(inside, "crowd", "embedding", linked, "a long, b long, links long"), "crowd-links")

    # 5. All other table values: neighbours at growing distance in the sorted rows.
    def meet(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        carried = pd.DataFrame({"key": [], "id": [], "code": []}).astype("int64")

        def pairs(pdf: pd.DataFrame) -> pd.DataFrame:
            key, id_, code = pdf["key"].to_numpy(), pdf["id"].to_numpy(), pdf["code"].to_numpy().view(np.uint64)
            found = []
            step, left = 1, np.arange(len(pdf) - 1)
            while len(left):
                left = left[left + step < len(key)]
                left = left[key[left] == key[left + step]]
                hit = left[np.bitwise_count(code[left] ^ code[left + step]) <= most]
                found.append((hit, hit + step))
                step += 1
            a, b = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in (0, 1))
            own = _table(code[a], code[b], tables) == key[a] >> block  # the table that reports a pair
            a, b = id_[a[own]], id_[b[own]]
            return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})

        for pdf in frames:
            pdf = pd.concat([carried, pdf], ignore_index=True)
            last = pdf["key"].iloc[-1] if len(pdf) else None
            carried = pdf[pdf["key"] == last]  # the value that the next batch may go on with
            yield pairs(pdf[pdf["key"] != last])
        yield pairs(carried)

    calm = entered.join(crowded, "key", "left_anti").repartition(n_parts, "key").sortWithinPartitions("key")
    pairs = calm.mapInPandas(meet, "a long, b long").distinct()
    pairs = pairs.join(small(crowds.select(F.col("id").alias("a"), F.col("crowd").alias("crowd_a"))), "a", "left")
    pairs = pairs.join(small(crowds.select(F.col("id").alias("b"), F.col("crowd").alias("crowd_b"))), "b", "left")
    pairs = pairs.where(F.col("crowd_a").isNull() | F.col("crowd_b").isNull() | (F.col("crowd_a") != F.col("crowd_b"))).select("a", "b")
    both = pairs.join(shapes.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("embedding").alias("v_a")), "a")
    both = both.join(shapes.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("embedding").alias("v_b")), "b")

    def verify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            ok = np.zeros(len(pdf), bool)
            sizes = pdf["v_a"].map(len).to_numpy()
            alike = sizes == pdf["v_b"].map(len).to_numpy()
            for dims in set(sizes[alike].tolist()):
                here = np.flatnonzero(alike & (sizes == dims))
                x, y = (unit_rows(np.stack(pdf[c].iloc[here].to_numpy()))[0] for c in ("v_a", "v_b"))
                ok[here] = np.einsum("ij,ij->i", x, y) >= cosine
            yield pdf.loc[ok, ["a", "b", "n_a", "n_b"]]

    apart = keep(both.mapInPandas(verify, "a long, b long, n_a long, n_b long"), "links")

    counts = inside.where("b is null").select(F.col("a").alias("id"), "links")
    counts = counts.union(apart.select("a", F.col("n_b"))).union(apart.select("b", F.col("n_a")))
    counts = counts.groupBy("id").agg(F.sum("links").alias("links"))
    labels = components(inside.where("b is not null").select("a", "b").union(apart.select("a", "b")), "labels")
    done = reps.join(counts, "id", "left").join(labels, "id", "left")
    done = done.select("digest", F.col("n"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("label", "id").alias("component_id"), "id")
    # Copies are joined to their vector; all others have their own row already.
    single = done.where("n = 1").select(F.col("id").alias("vec_id"), "n_links", "component_id")
    copies = ids.where("valid").join(small(done.where("n > 1").select("digest", "n_links", "component_id")), "digest").select("vec_id", "n_links", "component_id")
    odd = ids.where("not valid").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return single.union(copies).union(odd).withColumn("kept", F.col("vec_id") == F.col("component_id"))
