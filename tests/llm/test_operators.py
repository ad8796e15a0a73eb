"""Each operator against brute force or a held-out measure, and on awkward tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadloom.llm import chat, decontaminate, fingerprints, licenses, lm_score, mixing, ngram_join, quality, queries, token_counts, token_file
from roadloom.llm.common import components
from roadloom.llm.pieces import default_vocabulary, encoder
from roadloom.llm.signature_tree import link

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, label string"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def prose(rnd, n, size=400):
    return " ".join(f"w{rnd.randrange(size)}" for _ in range(n))


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls, empties, blanks, repeated rows and ids, one very long text, clashing columns."""
    rnd = random.Random(5)
    long = prose(rnd, 20_000, 5000)
    rows = [(1, None), (2, ""), (3, " \n\t"), (None, "no id here at all"), (4, "one"), (4, "one"), (5, "ONE"), (6, long), (7, long + " more"), (8, prose(rnd, 40)), (8, "another text of eight")]
    return spark.createDataFrame([(i, t, None, None if k % 2 else "a", None, "s", "l") for k, (i, t) in enumerate(rows)], DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# --- shared pieces ---------------------------------------------------------------


def test_components_ask_for_their_state_in_one_job(spark):
    """Finished edges need no round, and what a round asks takes one job: the driver keeps every job's tasks and plans."""
    ids = lambda: set(spark.sparkContext.statusTracker().getJobIdsForGroup("components"))
    edges = spark.createDataFrame([(1, 2), (3, 4), (5, 3), (6, 6), (4, 3)], "a long, b long")
    spark.sparkContext.setJobGroup("components", "components")
    try:
        done, before = components(edges, "test-stars"), ids()
        chain = components(spark.range(40).selectExpr("id AS a", "id + 1 AS b"), "test-chain")
        rounds = ids() - before
    finally:
        spark.sparkContext._jsc.sc().clearJobGroup()
    assert {tuple(r) for r in done.collect()} == {(1, 1), (2, 1), (3, 3), (4, 3), (5, 3)}
    assert {tuple(r) for r in chain.collect()} == {(i, 0) for i in range(41)}
    assert len(before) <= 8 and len(rounds) <= 72


def test_components(spark):
    rnd = random.Random(2)
    edges = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(110)] + [(i, i + 1) for i in range(300, 360)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r["id"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert got == {x: find(x) for x in parent if find(x) != x or x in got}
    assert components(spark.createDataFrame([], "a long, b long"), "t").count() == 0


# --- op1 -------------------------------------------------------------------------


def test_op1_edits_count_like_a_full_encoding(spark):
    rnd = random.Random(1)
    enc = encoder(default_vocabulary())
    rows, want = [], {}
    for i in range(120):
        text = "".join(rnd.choice(["word", " ", "  ", "\n", "é", "a,b", " don't", "7", " Ünï", "\xa0" if i % 40 == 0 else "x"]) for _ in range(rnd.randrange(60)))
        edits, at = [], 0
        while at < len(text) and len(edits) < 5:
            a = at + rnd.randrange(12)
            b = a + rnd.randrange(8)
            edits.append((a, b, rnd.choice(["", " ", "new", " two words", "é\n"])))
            at = b + 1
        edited = text
        for a, b, by in reversed(edits):
            a, b = min(a, len(text)), min(b, len(text))
            edited = edited[:a] + by + edited[b:]
        rows.append((i, text, edits))
        want[i] = (len(enc.encode_whole(text)), len(enc.encode_whole(edited)), len(edited))
    docs = spark.createDataFrame(rows, "doc_id long, text string, edits array<struct<start:long,stop:long,by:string>>")
    got = {r["doc_id"]: (r["n_tokens"], r["edited_tokens"], r["edited_chars"]) for r in token_counts.count_with_edits(docs, default_vocabulary()).collect()}
    assert got == want


def test_op1_redactions(spark, awkward, empty):
    docs = spark.createDataFrame([(1, "mail bob@example.org or 555 123 4567, ok"), (2, None)], "doc_id long, text string")
    edits = {r["doc_id"]: r["edits"] for r in token_counts.redactions(docs).collect()}
    text = "mail bob@example.org or 555 123 4567, ok"
    assert [text[e["start"] : e["stop"]] for e in edits[1]] == ["bob@example.org", "555 123 4567"]
    assert not edits[2]
    count = lambda d: token_counts.count_with_edits(token_counts.redactions(d), default_vocabulary())
    assert count(awkward).count() == awkward.count()
    assert count(empty).count() == 0


# --- op2 -------------------------------------------------------------------------


def test_op2_held_out_accuracy(spark, data):
    scored = queries.op2_quality(spark, data).join(spark.read.parquet(f"{data}/labels.parquet"), "doc_id").toPandas()
    held = scored[scored.held_out]
    assert ((held.predicted == held.quality).mean()) >= 0.9
    assert scored.score.between(0, 1).all()


def test_op2_awkward(spark, awkward, empty, data):
    labels = spark.createDataFrame([(1, 1), (2, 0), (6, 1), (None, 0), (4, None)], "doc_id long, quality int")
    model = quality.train(awkward, labels, F.lit(True))
    got = quality.quality_scores(awkward, model, keep_columns=True)
    assert got.count() == awkward.count() and "label" in got.columns
    assert got.where("score is null").count() == 0
    constant = quality.train(empty, labels.limit(0), F.lit(True))
    assert quality.quality_scores(empty, constant).count() == 0
    assert {r["score"] for r in quality.quality_scores(awkward, constant).collect()} == {0.5}


def test_op2_trees_fit_and_flatten():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, len(quality.NAMES)))
    y = ((x[:, 0] > 0.3) & (x[:, 3] < 0.5)).astype(float)
    model = quality.fit(x, y)
    assert ((model.score(x) > 0.5) == (y == 1)).mean() > 0.98
    assert model.feature.shape == (quality.TREES, 2**quality.DEPTH - 1)


# --- op3 -------------------------------------------------------------------------


def test_op3_against_brute_force(spark, awkward, empty):
    rnd = random.Random(9)
    items = [(i, prose(rnd, rnd.choice([3, 8, 20, 40]), 60)) for i in range(12)] + [(90, None), (91, ""), (92, "one two"), (92, "one two")]
    docs = []
    for d in range(60):
        text = prose(rnd, rnd.randrange(120), 60)
        if d % 3 == 0:
            item = items[d % 12][1].upper().split()
            if d % 2:
                item[len(item) // 2] = "changed"
            text += " " + ",  ".join(item) + ". " + prose(rnd, 30, 60)
        docs.append((d, text))
    split = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]

    def grams(w, k):
        return Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1))

    want = {}
    for i, item in items:
        w = split(item)
        if not w:
            continue
        k = min(5, len(w))
        own = grams(w, k)
        for d, text in docs:
            t = split(text)
            for s in range(max(1, len(t) - len(w) + 1)):
                win = grams(t[s : s + len(w)], k)
                common = sum((win & own).values())
                union = sum(win.values()) + sum(own.values()) - common
                if common and 100 * common >= 80 * union and common / union > want.get((d, i), (0,))[0]:
                    want[(d, i)] = (common / union, s)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.benchmark_matches(spark.createDataFrame(docs, "doc_id long, text string"), bench)
    assert {(r["doc_id"], r["item_id"]): (pytest.approx(r["similarity"]), r["start_word"]) for r in got.collect()} == want
    assert want
    assert decontaminate.benchmark_matches(empty, bench).count() == 0
    assert decontaminate.benchmark_matches(awkward, bench.limit(0)).count() == 0
    same = spark.createDataFrame([(1, "no ID here, at all")], "item_id long, text string")
    assert [(r["doc_id"], r["item_id"]) for r in decontaminate.benchmark_matches(awkward, same).collect()] == [(None, 1)]


def test_op2_against_a_plain_split_search_and_walk(monkeypatch):
    """Every split has the largest gain of all, every leaf its own step, and a walk over
    one row at a time gives the same score."""
    monkeypatch.setattr(quality, "TREES", 3)
    rng = np.random.default_rng(7)
    x = rng.integers(0, 6, (150, len(quality.NAMES))).astype(float)
    y = ((x[:, 1] > 2) ^ (x[:, 2] > 3)).astype(float)
    model = quality.fit(x, y)
    bins = [[sum(v >= e for e in model.edges[j]) for j, v in enumerate(row)] for row in x]
    total = [model.base] * len(x)
    for feature, cut, leaf in zip(model.feature, model.cut, model.leaf):
        p = [1 / (1 + math.exp(-t)) for t in total]
        g, h = [a - b for a, b in zip(p, y)], [a * (1 - a) for a in p]
        held = {0: list(range(len(x)))}

        def gain(rows, j, c):
            left, right = [r for r in rows if bins[r][j] <= c], [r for r in rows if bins[r][j] > c]
            if min(sum(h[r] for r in part) for part in (left, right)) < quality.LEAST_HESSIAN:
                return -1
            return sum(sum(g[r] for r in part) ** 2 / (sum(h[r] for r in part) + quality.RIDGE) for part in (left, right))

        for k in range(len(feature)):
            rows = held[k]
            best = max(gain(rows, j, c) for j in range(len(quality.NAMES)) for c in range(max(map(max, bins)))) if rows else -1
            if best > 1e-9:
                assert gain(rows, feature[k], cut[k]) == pytest.approx(best)
            held[2 * k + 1] = [r for r in rows if bins[r][feature[k]] <= cut[k]]
            held[2 * k + 2] = [r for r in rows if bins[r][feature[k]] > cut[k]]
        for k, step in enumerate(leaf):
            rows = held[len(feature) + k]
            assert step == pytest.approx(-quality.RATE * sum(g[r] for r in rows) / (sum(h[r] for r in rows) + quality.RIDGE))
            for r in rows:
                total[r] += step
    assert model.score(x) == pytest.approx([1 / (1 + math.exp(-t)) for t in total])


def test_op3_blocks_find_all_within_radius(spark):
    rnd = random.Random(4)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    items = [(i, rnd.getrandbits(64)) for i in range(5)]
    windows = []
    for w in range(200):
        base = items[w % 5][1]
        for b in rnd.sample(range(64), rnd.randrange(25)):
            base ^= 1 << b
        windows.append((w, 0, 5, base))
    want = {(w, i) for w, _, _, f in windows for i, g in items if (f ^ g).bit_count() <= decontaminate.RADIUS}
    got = decontaminate.near_items(
        spark.createDataFrame([(w, s, n, signed(f)) for w, s, n, f in windows], "rid long, start int, size int, fingerprint long"),
        spark.createDataFrame([(i, signed(f)) for i, f in items], "item_id long, fingerprint long"),
    )
    assert {(r["rid"], r["item_id"]) for r in got.collect()} == want


def test_op3_finds_edited_passages(spark):
    rnd = random.Random(8)
    items = [(i, prose(rnd, 104, 10**6)) for i in range(300)]
    docs = []
    for i, text in items:  # two other words: 90 of 100 shingles stay, similarity 90 / 110
        own = text.split()
        own[rnd.randrange(20, 40)], own[rnd.randrange(60, 80)] = "other", "another"
        docs.append((i, f"{prose(rnd, 20)} {' '.join(own)} {prose(rnd, 20)}"))
    got = decontaminate.benchmark_matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((r["doc_id"], r["item_id"], r["similarity"]) for r in got.collect()) == [(i, i, pytest.approx(90 / 110)) for i, _ in items]


# --- op4 -------------------------------------------------------------------------


def brute_components(docs, k, percent):
    sets = {}
    for d, text in docs:
        w = words(text)
        sets[d] = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    label = {d: d for d in sets}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                label[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}


@pytest.mark.parametrize(("k", "percent"), [(4, 85), (5, 80)])
def test_op4_against_brute_force(spark, monkeypatch, k, percent):
    monkeypatch.setattr(ngram_join, "BLOCK_DOCS", 7)  # clusters of several blocks
    rnd = random.Random(11)
    passage = prose(rnd, 60)
    docs = []
    for base in range(25):
        text = prose(rnd, rnd.choice([1, 3, 6, 12, 30, 80, 200])).split()
        for _ in range(rnd.choice([1, 2, 3, 12])):
            own = list(text)
            for _ in range(rnd.randrange(max(2, len(own) // 25))):
                own[rnd.randrange(len(own))] = f"e{rnd.randrange(1000)}"
            docs.append((len(docs), " ".join(own) + (" " + passage if base % 5 == 0 else "")))
    docs += [(len(docs), "Same TEXT here now"), (len(docs) + 1, "same text here now"), (len(docs) + 2, ""), (len(docs) + 3, "")]
    want = brute_components(docs, k, percent)
    got = ngram_join.ngram_components(spark.createDataFrame(docs, "doc_id long, text string"), k, percent)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect()} == want


def test_op4_awkward(spark, awkward, empty):
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.ngram_components(awkward, 4, 85).collect()}
    assert sorted(got) == [1, 2, 3, 4, 5, 6, 7, 8]
    assert (got[1], got[2], got[3]) == (1, 2, 3) and got[5] == 4 and got[7] == 6
    assert ngram_join.ngram_components(empty).count() == 0


def test_op4_routing_meets_every_link():
    rnd = np.random.default_rng(3)
    for percent in (80, 85):
        band = np.array(ngram_join.bands(percent), np.int64)
        for n in [*range(1, 40), 60, 150, 600]:
            for _ in range(30):
                x = np.unique(rnd.integers(0, 1 << 63, n).astype(np.uint64))
                lost = rnd.integers(0, max(1, len(x) // 5) + 1)
                y = np.unique(np.concatenate([x[lost:], rnd.integers(0, 1 << 63, rnd.integers(0, max(1, len(x) // 6) + 1)).astype(np.uint64)]))
                common = len(np.intersect1d(x, y))
                if len(y) and 100 * common >= percent * (len(x) + len(y) - common):
                    assert np.intersect1d(ngram_join.routing_keys(x, percent, band), ngram_join.routing_keys(y, percent, band)).size


def test_op4_trees_between_two_blocks():
    rnd = np.random.default_rng(8)
    sets = [np.unique(rnd.integers(0, 1 << 63, rnd.integers(1, 300)).astype(np.uint64)) for _ in range(60)]
    near = [np.unique(np.concatenate([s[len(s) // 30 :], rnd.integers(0, 1 << 63, len(s) // 40).astype(np.uint64)])) for s in sets]
    got = link(list(range(60)), sets, 85, (list(range(60, 120)), near))
    common = lambda a, b: len(np.intersect1d(a, b))
    want = {(i, 60 + j) for i in range(60) for j in range(60) if 100 * common(sets[i], near[j]) >= 85 * len(np.union1d(sets[i], near[j]))}
    assert set(got) == want


# --- op5 -------------------------------------------------------------------------


def test_op5_contract(spark, awkward, empty):
    rnd = random.Random(6)
    docs = [(i, prose(rnd, rnd.randrange(1, 60)), rnd.choice(["a", "b", "b", "c", "d", None, None, None, "z" if i < 40 else "b"])) for i in range(1500)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    got = mixing.mix(df).toPandas()
    again = mixing.mix(df.repartition(3)).toPandas()
    key = ["doc_id", "taken"]
    assert got[key].sort_values(key).values.tolist() == again[key].sort_values(key).values.tolist()
    sizes = Counter()
    for _, t, s in docs:
        sizes[s] += len(t.split())
    names = sorted([s for s in sizes if s is not None]) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, open_ = {}, set(names)
    while True:
        level = (sum(sizes.values()) - sum(target.values())) / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 3 * sizes[s]}
        if not over:
            break
        target |= {s: 3 * sizes[s] for s in over}
        open_ -= over
    target |= {s: level * weight[s] for s in open_}
    for s, rows in got.assign(source=got.source.where(got.source.notna(), None)).groupby("source", dropna=False):
        s = None if s is None or s != s else s
        assert rows.target.iloc[0] == pytest.approx(target[s]) and rows.source_size.iloc[0] == sizes[s]
        assert abs(rows.taken.sum() - target[s]) <= 60
    assert (got.taken <= 3 * got["size"]).all()
    assert mixing.mix(awkward).count() == awkward.count()
    assert mixing.mix(empty).count() == 0


def test_op5_weights_prefer_quality(spark):
    df = spark.range(4000).selectExpr("id AS doc_id", "'one two three' AS text", "CASE WHEN id % 2 = 0 THEN 'a' ELSE 'b' END AS source", "CASE WHEN id % 4 < 2 THEN 9.0D ELSE 1.0D END AS w")
    got = mixing.mix(df, F.col("w")).where("source = 'b'").groupBy("w").agg(F.avg("times").alias("t")).collect()
    rate = {r["w"]: r["t"] for r in got}
    assert rate[9.0] > 2 * rate[1.0]


# --- op6 -------------------------------------------------------------------------


def test_op6_contract(spark, data):
    docs = sorted((r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{data}/documents.parquet").collect())
    got = {r["doc_id"]: r for r in fingerprints.fingerprint_edits(spark.read.parquet(f"{data}/documents.parquet")).collect()}
    prints = {}
    for i, (d, text) in enumerate(docs):
        after = docs[(i + 1) % len(docs)][1]
        n = len(text) // 4
        edited = text[: len(text) - n] + after[:n]
        assert got[d]["n_chars"] == len(text)
        assert got[d]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert prints.setdefault(text, got[d]["fingerprint"]) == got[d]["fingerprint"]
        assert got[d]["edited_fingerprint"] == fingerprints.simhashes([edited])[0]
        assert got[d]["near_next"] == pytest.approx(fingerprints.likeness(got[d]["fingerprint"], fingerprints.simhashes([after])[0]))
    long = [r for r in got.values() if r["n_chars"] > 500]
    assert np.mean([r["near_edited"] for r in long]) > np.mean([r["near_next"] for r in long]) + 0.4


def test_op6_votes_one_by_one():
    from roadloom.llm.kernels import Block, mix

    rnd = random.Random(3)
    for text in ("", "one", "one two", prose(rnd, 50), prose(rnd, 300, 20)):
        hashes, _ = Block([text.encode()]).shingles(fingerprints.TERM_WORDS)
        bits = ""
        for lane in range(fingerprints.BITS // 64):
            signs = [int(h) for h in mix(hashes + np.uint64(lane))] if len(hashes) else []
            bits += "".join("1" if sum(1 if h >> b & 1 else -1 for h in signs) > 0 else "0" for b in range(64))
        want = bytes(int(bits[i : i + 8], 2) for i in range(0, fingerprints.BITS, 8)).hex()
        assert fingerprints.simhashes([text]) == [want]


def test_op6_near_counts(spark):
    rnd = random.Random(2)
    rows = [(i, f"{rnd.getrandbits(128):032x}") for i in range(0, 300, 50)]
    rows += [(i + k, f"{int(f, 16) ^ (((1 << k) - 1) << 9 * k):032x}") for i, f in rows for k in (1, 2, 4)] + [(450, rows[0][1]), (None, rows[1][1])]
    got = {(r["doc_id"], r["fingerprint"]): r["n_near"] for r in fingerprints.with_near_counts(spark.createDataFrame(rows, "doc_id long, fingerprint string")).collect()}
    bits = lambda a, b: (int(a, 16) ^ int(b, 16)).bit_count()
    prints = {f for _, f in rows}
    assert got == {(d, f): sum(0 < bits(f, g) <= fingerprints.QUERY_RADIUS for g in prints) if d is not None and d % 50 == 0 else None for d, f in rows}
    assert {n for n in got.values()} >= {2, None}


def test_op6_awkward(spark, awkward, empty):
    assert fingerprints.fingerprint_edits(awkward).count() == awkward.count()
    assert fingerprints.fingerprint_edits(empty).count() == 0
    one = fingerprints.fingerprint_edits(awkward.where("doc_id = 6")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0


@pytest.mark.parametrize("radius", [3, 7])
def test_op6_search_finds_all_within_radius(spark, radius):
    rnd = random.Random(radius)
    rows = []
    for i in range(400):
        f = rnd.getrandbits(128) if i % 4 == 0 else int(rows[-1][1], 16)
        for b in rnd.sample(range(128), rnd.randrange(5)):
            f ^= 1 << b
        rows.append((i, f"{f:032x}"))
    rows.append((1000, None))
    bits = lambda a, b: (int(a, 16) ^ int(b, 16)).bit_count()
    asks = {f for d, f in rows if f and d % 50 == 0}
    want = {(a, f, bits(a, f)) for a in asks for _, f in rows if f and bits(a, f) <= radius}
    got = fingerprints.near_fingerprints(spark.createDataFrame(rows, "doc_id long, fingerprint string"), radius)
    assert {(r["fingerprint"], r["other"], r["distance"]) for r in got.collect()} == want


# --- op7 -------------------------------------------------------------------------


def test_op7_contract(spark, data, awkward, empty):
    docs = sorted((r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{data}/documents.parquet").collect())
    enc, start, want = encoder(default_vocabulary()), 0, {}
    for d, text in docs:
        ids = np.array(enc.encode_whole(text) + [0], "<u4")
        want[d] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    for shard_ids in (2000, 1_000_000):
        shards = token_file.write_shards(spark.read.parquet(f"{data}/documents.parquet"), "t", default_vocabulary(), shard_ids=shard_ids)
        got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in token_file.read_index(shards).collect()}
        assert got == want
    assert token_file.read_index(token_file.write_shards(awkward, "t", default_vocabulary())).count() == awkward.count()
    assert token_file.read_index(token_file.write_shards(empty, "t", default_vocabulary())).count() == 0


# --- op8 -------------------------------------------------------------------------


def test_op8_held_out_roles(spark, data):
    turns = queries.op8_chat(spark, data).where("held_out").toPandas()
    assert (turns.role == turns.true_role).mean() > 0.95


def test_op8_segments_give_the_whole_path():
    rng = np.random.default_rng(5)
    start, move, emit = (np.log(rng.dirichlet(np.ones(n), size=m)) for n, m in ((6, 1), (6, 6), (chat.SYMBOLS, 6)))
    start = start[0]
    symbols = rng.integers(0, chat.SYMBOLS, 97)
    whole = chat.viterbi(symbols, start, None, move, emit)
    parts = np.array_split(symbols, 9)
    seams = chat.chain([chat.segment_matrix(p, move, emit) for p in parts], start, move)
    path = []
    for p, (first, last) in zip(parts, seams):
        enter = np.full(6, -np.inf)
        enter[first] = 0
        path += chat.viterbi(p, enter, last, move, emit).tolist()
    assert path == whole.tolist()


def test_op8_viterbi_against_all_paths():
    from itertools import product

    rng = np.random.default_rng(11)
    start, move, emit = np.log(rng.dirichlet(np.ones(6))), np.log(rng.dirichlet(np.ones(6), size=6)), np.log(rng.dirichlet(np.ones(chat.SYMBOLS), size=6))
    for n in (1, 2, 4, 5):
        symbols = rng.integers(0, chat.SYMBOLS, n)
        score = lambda p: start[p[0]] + emit[p[0], symbols[0]] + sum(move[a, b] + emit[b, s] for a, b, s in zip(p, p[1:], symbols[1:]))  # noqa: E731, B023
        best = max(product(range(6), repeat=n), key=score)
        assert chat.viterbi(symbols, start, None, move, emit).tolist() == list(best)


def test_op8_query_against_a_plain_rerun(spark, monkeypatch):
    """Lines, numbers, segments, paths and turns of a few transcripts by plain loops."""
    monkeypatch.setattr(chat, "SEGMENT_LINES", 4)
    rnd, names = random.Random(21), ("User: ", "AI: ", "", "System: ", "Q: ")
    rows = []
    for c in [*range(9), None]:
        for part in range(rnd.randrange(1, 9)):
            rows.append((c, part, "\n".join(rnd.choice(("", "  ", rnd.choice(names) + prose(rnd, rnd.choice((2, 12, 30))) + rnd.choice(("", "?")))) for _ in range(rnd.randrange(5)))))
    rng = np.random.default_rng(4)
    tables = np.log(rng.dirichlet(np.ones(6))), np.log(rng.dirichlet(np.ones(6), size=6)), np.log(rng.dirichlet(np.ones(chat.SYMBOLS), size=6))
    sign = lambda line: next((k + 1 for k, (_, n) in enumerate(chat.MARKERS) if re.match(rf"(?i)^\s*[\[<*#>]{{0,3}}\s*({n})\s*[\]>*]{{0,3}}\s*[:>\-]", line)), 0)
    want = {}
    for c in {r[0] for r in rows}:
        symbols, lines = [], []
        for _, part, text in sorted((r for r in rows if r[0] == c), key=lambda r: r[1]):
            split = text.split("\n")
            for i, line in enumerate(split):
                if line.strip(" "):
                    size, gap = len(line.strip(" ")), i > 0 and not split[i - 1].strip(" ")
                    symbols.append(((sign(line) * 2 + gap) * 3 + (0 if size < 20 else 1 if size < 120 else 2)) * 2 + line.rstrip(" ").endswith("?"))
                    lines.append((part, i))
        if symbols:
            path, turn = chat.viterbi(np.array(symbols), tables[0], None, *tables[1:]), -1
            for k, (state, place) in enumerate(zip(path, lines)):
                if k == 0 or state % 2 == 0:
                    turn += 1
                    want[(c, turn)] = (chat.ROLES[state // 2], *place)
    odd = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, part long, text string, line string, segment int").repartition(5)
    got = {(r["conv_id"], r["turn"]): (r["role"], r["first_part"], r["first_line"]) for r in chat.recover_turns(odd, tables).collect()}
    assert got == want


def test_op8_long_and_awkward(spark, monkeypatch, data):
    talks = spark.read.parquet(f"{data}/conversations.parquet")
    raw = chat.raw_transcripts(talks)
    role = F.array_position(F.array(*[F.lit(r) for r in chat.ROLES]), F.col("role")).cast("int") - 1
    lines = chat.lines_of(raw.distinct()).join(talks.select("conv_id", F.col("turn").alias("part"), "role"), ["conv_id", "part"])
    tables = chat.train(lines.withColumn("state", 2 * role + F.when(F.col("i") == F.min("i").over(chat.Window.partitionBy("conv_id", "part")), 0).otherwise(1)))
    one = chat.recover_turns(raw, tables).orderBy("conv_id", "turn").collect()
    monkeypatch.setattr(chat, "SEGMENT_LINES", 3)
    assert chat.recover_turns(raw, tables).orderBy("conv_id", "turn").collect() == one
    odd = spark.createDataFrame([(1, 0, None), (2, 0, ""), (None, 0, "User: hi\nAI: yes?"), (3, 0, "plain"), (3, 0, "plain")], "conv_id long, part long, text string")
    got = chat.render(chat.recover_turns(odd, tables)).collect()
    assert {r["conv_id"] for r in got} == {None, 3}
    assert [r["text"] for r in got if r["conv_id"] is None] == ["hi", "yes?"]
    assert chat.recover_turns(odd.limit(0), tables).count() == 0


# --- op9 -------------------------------------------------------------------------


def test_op9_against_brute_force(spark, awkward, empty):
    rnd = random.Random(12)
    docs = []
    for i in range(80):
        body = prose(rnd, rnd.randrange(100)).split()
        name, text = licenses.TEMPLATES[i % len(licenses.TEMPLATES)]
        own = text.upper().split() if i % 2 else text.split()
        if i % 5 == 0:
            own[-1] = "other"
        if i % 7:
            body[len(body) // 2 : len(body) // 2] = own
        docs.append((i, " ".join(body)))
    want = {}
    for name, text in licenses.TEMPLATES:
        w = licenses.plain_words(text)
        own, size, k = set(licenses.template_shingles(w)), licenses.size_class(len(w)), min(licenses.SHINGLE, len(w))
        for d, text in docs:
            t = licenses.plain_words(text)
            for s in range(0, max(1, len(t)), size):
                win = t[s : s + 2 * size]
                share = len(own & {tuple(win[j : j + k]) for j in range(len(win) - k + 1)}) / len(own)
                if 100 * share >= licenses.PERCENT - 1e-9 and share > want.get((d, name), (0,))[0]:
                    want[(d, name)] = (share, s)
    got = {(r["doc_id"], r["license"]): (pytest.approx(r["containment"]), r["start_word"]) for r in licenses.license_matches(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == want and len(want) > 40
    assert licenses.license_matches(awkward).count() == 0
    assert licenses.license_matches(empty).count() == 0


def test_op9_lines_of_the_given_documents(spark, data):
    """License lines as they stand in the documents, not as TEMPLATES has them."""
    lines = {
        "all-rights-reserved": "all rights reserved.", "mit": "released under the mit license.", "apache-2.0": "licensed under the apache license, version 2.0.",
        "gpl-3.0": "this work is licensed under the gnu general public license, version 3.", "cc-by-nc-4.0": "licensed under cc by-nc 4.0.",
    }
    docs = [(r["doc_id"], (r["text"] or "").lower()) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    want = {(d, name) for d, text in docs for name, line in lines.items() if line in text}
    got = {(r["doc_id"], r["license"]) for r in queries.op9_licenses(spark, data).where("containment = 1").collect()}
    assert {g for g in got if g[1] in lines} == want
    assert any(name == "all-rights-reserved" for _, name in want)


def test_op9_one_shingle_is_never_missed(spark):
    docs = [(i, f"{' '.join(f'w{i}x{j}' for j in range(13 + i % 8))} All rights reserved.") for i in range(400)]
    got = licenses.license_matches(spark.createDataFrame(docs, "doc_id long, text string"), (("short", "All rights reserved."),))
    assert sorted(r["doc_id"] for r in got.collect()) == list(range(400))


def test_op9_bounds():
    worded = [licenses.plain_words(t) for _, t in licenses.TEMPLATES]
    marks = set(licenses.mark_words(worded))
    for w in worded:
        own = licenses.template_shingles(w)
        assert 100 * sum(not marks & set(s) for s in own) < licenses.PERCENT * len(own)
        assert licenses.collision_bound(len(w)) > 0.98


# --- op10 ------------------------------------------------------------------------


def test_op10_contract(spark, data, awkward, empty):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    trained = Counter()
    for d, t in docs:
        if zlib.crc32(str(d).encode()) % 10:
            trained.update(words(t))
            trained[None] += 1
    n, v = sum(trained.values()), len(trained)
    got = {r["doc_id"]: r for r in queries.op10_lm_score(spark, data).collect()}
    assert len(got) == len(docs)
    for d, t in docs:
        own = [*words(t), None]
        base = sum(math.log10((trained[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        r = got[d]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (zlib.crc32(str(d).encode()) % 10 == 0, len(own), sum(trained[w] > 0 for w in own), n)
        assert r["base_score"] == pytest.approx(base) and r["score"] < 0
    some = lm_score.lm_scores(awkward, queries.vocabulary("piece_bpe_32k.model"), F.col("doc_id") % 2 == 0).collect()
    assert len(some) == awkward.count()
    assert lm_score.lm_scores(empty, queries.vocabulary("piece_bpe_32k.model"), F.lit(True)).count() == 0


def test_op10_recursions_against_all_segmentations():
    lattice = lm_score.Lattice(["▁a", "▁", "a", "b", "ab", "▁ab", "ba"], np.log(np.array([0.2, 0.1, 0.1, 0.2, 0.15, 0.05, 0.2])), math.log(1e-4))

    def total(word):
        if not word:
            return [(1.0, Counter())]
        out = []
        for j in range(1, len(word) + 1):
            piece = word[:j]
            p = math.exp(lattice.scores[lattice.index[piece]]) if piece in lattice.index else 1e-4 if j == 1 else 0
            if p:
                out += [(p * q, c + Counter([piece])) for q, c in total(word[j:])]
        return out

    for word in ("a", "ab", "abab", "bxa", "aabba"):
        ways = total("▁" + word)
        z = sum(p for p, _ in ways)
        assert lattice.log_probability([word])[0] == pytest.approx(math.log(z))
        uses = lattice.expected([word], np.ones(1))
        for piece, i in lattice.index.items():
            assert uses[i] == pytest.approx(sum(p * c[piece] for p, c in ways) / z, abs=1e-9)


def test_op10_scores_against_plain_loops(spark, monkeypatch):
    """Fitting and scoring with every segmentation written out."""
    pieces = ["▁", "a", "b", "▁a", "ab", "▁ab", "ba"]
    monkeypatch.setattr(lm_score, "vocabulary_pieces", lambda path: pieces)
    rnd = random.Random(13)
    docs = [(i, " ".join("".join(rnd.choice("abc") for _ in range(rnd.randrange(1, 6))) for _ in range(rnd.randrange(6)))) for i in range(40)] + [(40, None), (41, "a " + "ab" * 4)]
    trained = Counter(w for d, t in docs if d % 4 for w in words(t))
    ends = sum(d % 4 > 0 for d, _ in docs)
    n, share = sum(trained.values()) + ends, sum(min(c, 0.5) for c in trained.values())

    def ways(word, score, unknown):
        if not word:
            return [(1.0, Counter())]
        out = []
        for j in range(1, len(word) + 1):
            p = score.get(word[:j], unknown if j == 1 else 0)
            if p:
                out += [(p * q, c + Counter([word[:j] if word[:j] in score else None])) for q, c in ways(word[j:], score, unknown)]
        return out

    zipf = 1 / np.arange(2, len(pieces) + 2)
    score, unknown = dict(zip(pieces, 0.999 * zipf / zipf.sum())), 0.001 / 2**17
    for _ in range(lm_score.PASSES):
        uses = {p: 0.01 for p in pieces} | {None: 1.0}
        for w, c in trained.items():
            found = ways("▁" + w, score, unknown)
            z = sum(p for p, _ in found)
            for p, k in found:
                for piece, m in k.items():
                    uses[piece] += min(c, 0.5) * p * m / z
        total = sum(uses.values())
        score, unknown = {p: uses[p] / total for p in pieces}, uses[None] / total / 2**17
    want = {}
    for d, t in docs:
        own = [math.log10(share / n * sum(p for p, _ in ways("▁" + w, score, unknown)) + max(0, trained[w] - 0.5) / n) for w in words(t)]
        want[d] = sum(own) + math.log10(ends / n)
    got = lm_score.lm_scores(spark.createDataFrame(docs, "doc_id long, text string"), "", F.col("doc_id") % 4 > 0).collect()
    assert {r["doc_id"]: r["score"] for r in got} == pytest.approx(want)


def test_op10_long_words_in_stretches(monkeypatch):
    lattice = lm_score.Lattice(["▁a", "▁", "a", "b", "ab", "ba"], np.log(np.array([0.2, 0.1, 0.1, 0.2, 0.2, 0.2])), math.log(1e-4))
    some = ["ab" * 40, "ba", "é" * 7, "abc" * 30]
    one, uses = lattice.log_probability(some), lattice.expected(some, np.ones(4))
    monkeypatch.setattr(lm_score, "STRETCH", 8)
    assert lattice.log_probability(some) == pytest.approx(one)
    assert lattice.expected(some, np.ones(4)) == pytest.approx(uses)
