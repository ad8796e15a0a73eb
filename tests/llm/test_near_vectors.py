import math

import numpy as np
from pyspark.sql import functions as F

from roadloom.llm import near_vectors as nv
from roadloom.llm.near_vectors import Quantiser, near_vectors, radius

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, cosine=0.95):
    """n_links and component_id of every id by all pairs; rows: {id: vector}."""
    links = {i: set() for i in rows}
    good = {i: np.array(v, float) for i, v in rows.items() if nv.usable(v) and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float))}
    for i, a in good.items():
        for j, b in good.items():
            if i < j and len(a) == len(b):
                a1, b1 = a / np.abs(a).max(), b / np.abs(b).max()
                if a1 @ b1 / math.sqrt((a1 @ a1) * (b1 @ b1)) >= cosine:
                    links[i].add(j)
                    links[j].add(i)
    label = {}
    for i in sorted(rows):
        todo = [i] if i not in label else []
        while todo:
            x = todo.pop()
            if x not in label:
                label[x] = i
                todo += links[x]
    return {i: (len(links[i]), label[i], label[i] == i) for i in rows}


def result(df):
    rows = df.collect()
    assert len({r.vec_id for r in rows}) == len(rows)
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in rows}


def noisy(rng, base, angle_cos):
    z = rng.standard_normal(len(base))
    z -= (z @ base) * base
    return angle_cos * base + math.sqrt(1 - angle_cos**2) * z / np.linalg.norm(z)


def test_groups_copies_and_pairs_match_brute_force(spark):
    rng = np.random.default_rng(5)
    unit = lambda: (lambda v: v / np.linalg.norm(v))(rng.standard_normal(64))
    vectors = [unit() for _ in range(300)]
    base = unit()
    vectors += [noisy(rng, base, 0.99) for _ in range(400)]  # more than a usual table value holds
    vectors += [base * k for k in (1.0, 2.0, 0.5)]
    vectors += [vectors[0]] * 40 + [noisy(rng, vectors[1], c) for c in (0.951, 0.96, 0.97, 0.98, 0.949, 0.94)]
    order = rng.permutation(len(vectors))
    rows = {int(k): vectors[i].tolist() for k, i in enumerate(order)}
    got = result(near_vectors(spark.createDataFrame([(i, v, None) for i, v in rows.items()], SCHEMA)))
    want = brute(rows)
    assert got.keys() == want.keys()
    assert all(got[i][0] <= want[i][0] for i in want)  # nothing below the threshold
    assert sum(g[0] for g in got.values()) >= 0.999 * sum(w[0] for w in want.values())
    assert {i for i, w in want.items() if w[0] > 100} == {i for i, g in got.items() if g[0] > 100}


def test_recall_next_to_the_threshold():
    rng = np.random.default_rng(7)
    x = rng.standard_normal((8000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    q = Quantiser.fit(x[:3000])
    near = np.array([noisy(rng, v, 0.9501) for v in x[4000:6000]])
    away = np.bitwise_count(q.codes(x[4000:6000]) ^ q.codes(near))
    assert (away <= radius()).mean() > 0.96
    ones = np.unpackbits(q.codes(x[3000:]).view(np.uint8).reshape(-1, 8), axis=1).mean(0)
    assert (abs(ones - 0.5) < 0.08).all()  # balanced bits


def test_codes_within_the_radius_share_a_table_value():
    rng = np.random.default_rng(9)
    a = rng.integers(0, 1 << 63, 2000, dtype=np.uint64)
    b = a.copy()
    for i in range(2000):
        for bit in rng.choice(64, radius(), replace=False):
            b[i] ^= np.uint64(1 << int(bit))
    ka, kb = nv._keys(a, nv.TABLES), nv._keys(b, nv.TABLES)
    assert all(set(x) & set(y) for x, y in zip(ka.tolist(), kb.tolist()))
    assert (nv._table(a, b, nv.TABLES) < nv.TABLES).all()


def test_spread_connects_like_the_matrix():
    rng = np.random.default_rng(2)
    near = rng.random((60, 60)) < 0.02
    near |= near.T
    ids = rng.permutation(1000)[:60].astype(np.int64)
    rows = {int(i): None for i in ids}

    def label(edges):
        parent = {i: i for i in rows}

        def root(i):
            while parent[i] != i:
                i = parent[i]
            return i

        for i, j in edges:
            parent[max(root(i), root(j))] = min(root(i), root(j))
        return {i: root(i) for i in rows}

    edges = [(int(ids[i]), int(ids[j])) for i, j in np.argwhere(near)]
    assert label(nv._spread(near, ids, ids)) == label(edges)


def test_blocks_of_a_crowd_meet_each_other(spark, monkeypatch):
    monkeypatch.setattr(nv, "PART", 50)
    rng = np.random.default_rng(3)
    base = rng.standard_normal(32)
    base /= np.linalg.norm(base)
    rows = {i: noisy(rng, base, 0.97 if i % 2 else 0.995).tolist() for i in range(420)}
    got = result(near_vectors(spark.createDataFrame([(i, v, None) for i, v in rows.items()], SCHEMA)))
    want = brute(rows)
    assert sum(g[0] for g in got.values()) >= 0.98 * sum(w[0] for w in want.values())
    assert all(g[0] <= want[i][0] for i, g in got.items())


def test_odd_vectors_and_rows(spark):
    e = [1.0, 2.0, 3.0]
    rows = [
        (1, None, 0), (2, [], 0), (3, [0.0, 0.0, 0.0], 0), (4, [1.0, None, 3.0], 0), (5, [1.0, float("nan"), 3.0], 0), (6, [float("inf"), 0.0, 1.0], 0),
        (7, None, 0), (8, [0.0, 0.0, 0.0], 0), (10, e, 0), (11, e, 1), (11, e, 1), (None, e, 0), (12, [2.0, 4.0, 6.0], 0), (13, [1e300, 2e300, 3e300], 0),
        (14, [1e-300, 2e-300, 3e-300], 0), (15, [1.0, 2.0], 0), (16, [1.0, 2.0], 0), (17, [-1.0, -2.0, -3.0], 0), (18, [-0.0, 1.0], 0), (19, [0.0, 1.0], 0), (20, [5.0], 0),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("n", F.lit(1)).withColumn("id", F.lit("x")).withColumn("code", F.lit(None))
    got = result(near_vectors(df))
    assert got == brute({r[0]: r[1] for r in rows if r[0] is not None})
    assert got[14] == (4, 10, False) and got[7] == (0, 7, True) and got[16] == (1, 15, False)


def test_one_id_with_several_vectors_counts_once(spark):
    rows = [(1, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [1.0, 0.0], 0), (3, [0.0, 1.0], 0)]
    got = [result(near_vectors(spark.createDataFrame(x, SCHEMA))) for x in (rows, rows[::-1])]
    assert got[0] == got[1] and sorted(g[0] for g in got[0].values()) == [0, 1, 1]


def test_no_vectors(spark):
    for rows in ([], [(1, None, 0)]):
        got = near_vectors(spark.createDataFrame(rows, SCHEMA))
        assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
        assert [tuple(r) for r in got.collect()] == [(1, 0, 1, True)][: len(rows)]


def test_query_finds_the_links_of_the_table(spark, data):
    from roadloom.llm.queries import QUERIES

    got = result(QUERIES["op11_near_vectors"](spark, data))
    rows = {r[0]: r[1] for r in spark.read.parquet(f"{data}/embeddings.parquet").select("vec_id", "embedding").collect()}
    x = np.stack([np.array(rows[i], float) for i in sorted(rows)])
    x /= np.linalg.norm(x, axis=1)[:, None]
    n = (x @ x.T >= 0.95).sum(1) - 1
    assert len(got) == len(rows) and sum(g[0] for g in got.values()) >= 0.9 * n.sum()
