"""Each stage of the pipeline against brute force on its own input."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from roadloom.llm import quality
from roadloom.llm.common import fold
from roadloom.llm.pieces import default_vocabulary, encoder

from .test_operators import brute_components, prose, words


@pytest.fixture(scope="module")
def stages(spark, data):
    """(docs, result) of each stage, as lists of rows."""
    docs, out = spark.read.parquet(f"{data}/documents.parquet"), {}
    for name, f in corpus_pipeline.STAGES:
        got = corpus_pipeline.keep(f(spark, docs, data), f"test-{name}")
        out[name] = docs.collect(), got.collect(), got.columns
        docs = got
    return out


def test_shape(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "ngram_join", "decontamination", "mixing", "token_file"]
    for name, (_, _, columns) in list(stages.items())[:-1]:
        assert tuple(columns) == corpus_pipeline.COLUMNS, name


def test_quality(spark, data, stages):
    docs, kept, _ = stages["quality"]
    model = quality.train(spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/labels.parquet"), fold("doc_id", 4) != 2)
    good = model.score(quality.text_features([d["text"] for d in docs])) >= 0.7
    assert sorted(k["doc_id"] for k in kept) == sorted(d["doc_id"] for d, g in zip(docs, good) if g)


def test_ngram_join(stages):
    docs, kept, _ = stages["ngram_join"]
    groups = brute_components([(d["doc_id"], d["text"]) for d in docs], 5, 80)
    assert sorted(k["doc_id"] for k in kept) == sorted({c for _, c in groups.values()})


def test_decontamination(spark, data, stages):
    docs, kept, _ = stages["decontamination"]
    items = [r["text"] for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    leaks = {d["doc_id"] for d in docs if any(i in d["text"] for i in items)}
    left = {k["doc_id"] for k in kept}
    assert not leaks & left
    assert {d["doc_id"] for d in docs} - left == leaks


def test_mixing(stages):
    docs, kept, _ = stages["mixing"]
    size = {d["doc_id"]: len(words(d["text"])) for d in docs}
    total, times = sum(size.values()), Counter(k["doc_id"] for k in kept)
    assert max(times.values()) <= 3 and set(times) <= set(size)
    assert abs(sum(size[d] * n for d, n in times.items()) - total) < 0.2 * total
    assert {k["text"] for k in kept} <= {d["text"] for d in docs}


def test_token_file(stages):
    docs, got, _ = stages["token_file"]
    enc, start, want = encoder(default_vocabulary()), 0, []
    for d, text in sorted((d["doc_id"], d["text"]) for d in docs):
        ids = np.array(enc.encode_whole(text) + [0], "<u4")
        want.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got) == want


def test_empty_and_null_documents(spark, data):
    some = spark.read.parquet(f"{data}/documents.parquet").limit(0)
    odd = spark.createDataFrame([(1, None, None, None, None), (None, "words here", "en", None, 1), (2, "", "en", "a", 0), (2, "", "en", "a", 0)], some.schema)
    for docs in (some, odd):
        for name, f in corpus_pipeline.STAGES:
            docs = corpus_pipeline.keep(f(spark, docs, data), f"odd-{name}")
        assert docs.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_ngram_join_of_repeated_rows_and_ids(spark, data):
    rnd = random.Random(3)
    a, b, c, e = (prose(rnd, 60, 5000) for _ in range(4))
    rows = [(1, a), (1, a), (1, b), (3, b + " more"), (4, c), (None, c), (None, e), (None, e)]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], spark.read.parquet(f"{data}/documents.parquet").schema)
    kept = corpus_pipeline.join_ngrams(spark, docs, data).collect()
    assert Counter((r["doc_id"], r["text"]) for r in kept) == Counter([(1, a), (1, b), (4, c), (None, e)])


def test_decontamination_of_rows_without_an_id(spark, data):
    rnd = random.Random(4)
    item = next(r["text"] for r in spark.read.parquet(f"{data}/benchmark.parquet").collect() if len(words(r["text"])) > 9)
    clean, leaked = prose(rnd, 60), f"{prose(rnd, 20)} {item} {prose(rnd, 20)}"
    rows = [(None, leaked), (None, clean), (5, clean), (5, leaked), (6, leaked), (6, leaked)]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], spark.read.parquet(f"{data}/documents.parquet").schema)
    kept = corpus_pipeline.drop_benchmark(spark, docs, data).collect()
    assert Counter((r["doc_id"], r["text"]) for r in kept) == Counter([(None, clean), (5, clean)])


def test_mixing_takes_better_texts_first(spark, data):
    rnd = random.Random(6)
    good = lambda: " ".join(rnd.choice(("alpha", "beta", "gamma")) for _ in range(30))
    bad = lambda: "\n".join(["1234 #### 99"] * 10)
    rows = [(i, good() if i % 2 else bad(), "en", "a" if i < 400 else "b", 0) for i in range(800)]
    docs = spark.createDataFrame(rows, spark.read.parquet(f"{data}/documents.parquet").schema)
    taken = Counter(r["doc_id"] % 2 for r in corpus_pipeline.mix_sources(spark, docs, data).where("source = 'b'").collect())
    assert taken[1] > 1.5 * taken[0]
