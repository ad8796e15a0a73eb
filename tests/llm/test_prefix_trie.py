import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from roadloom.llm import prefix_trie
from roadloom.llm.prefix_trie import prefix_nodes

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    """The nodes by the definition, one prefix of one conversation after the other."""
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            convs.setdefault(conv, []).append((turn is not None, turn or 0, digest, (role, text)))
    own = {c: [x[3] for x in sorted(v)] for c, v in convs.items()}
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = own.get(c - c % 5, [])[:h] + own[c][h:]
    members = {}
    for c, seq in whole.items():
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(c)
    children, leaves, saved, out = {}, {}, {}, []
    for p in sorted(members, key=len, reverse=True):  # the deepest first
        mine = children.get(p, [])
        leaves[p] = sum(leaves[q] for q in mine) if mine else 1
        saved[p] = sum(saved[q] for q in mine) + ((len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0)
        if p:
            children.setdefault(p[:-1], []).append(p)
        ends = ",".join(map(str, sorted(c for c in members[p] if len(whole[c]) == len(p))))
        parent = min(members[p[:-1]]) if p else None
        out.append((min(members[p]), len(p), parent, len(members[p]), len(mine), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def result(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=str)


def talks(rnd, n, alphabet, most):
    rows = []
    for c in range(n):
        for t in range(rnd.randrange(1, most)):
            rows.append((c, t, rnd.choice(["user", "assistant"]), rnd.choice(alphabet)))
    return rows


@pytest.mark.parametrize("container,segment", [(2000, 1000), (3, 4)])
def test_nodes_match_brute_force(spark, monkeypatch, container, segment):
    monkeypatch.setattr(prefix_trie, "CONTAINER", container)
    monkeypatch.setattr(prefix_trie, "SEGMENT", segment)
    rnd = random.Random(container * 10 + segment)
    rows = talks(rnd, 60, ["a", "bé", "日本", ""], 8)
    same = [(t, "user", f"turn {t}") for t in range(7)]
    rows += [(c, *x) for c in range(100, 140) for x in same] + [(c, *x) for c in range(150, 160) for x in same[:4]]
    rnd.shuffle(rows)
    assert result(prefix_nodes(spark.createDataFrame(rows, SCHEMA).repartition(3))) == brute(rows)


def test_ends_of_one_node_come_from_many_ranges(spark, monkeypatch):
    rows = [(c, t, "user", "hello") for c in range(-30, 600) for t in range(2)]
    assert result(prefix_nodes(spark.createDataFrame(rows, SCHEMA).repartition(4))) == brute(rows)


def test_nulls_ties_repeats_and_long_texts(spark):
    rows = [
        (None, 0, "user", "nobody's"), (0, None, "user", "first"), (0, 1, None, None), (0, 1, "", ""), (0, 1, "user", "b"), (0, 1, "user", "b"), (0, 2, "system", "x" * 300_000),
        (1, 0, "user", "only"), (2, 0, None, ""), (2, 5, "user", "é\n\t"), (7, 0, "u", "ser"), (8, 0, "us", "er"), (9, 1, "user", "z"), (9, -1, "user", "y"), (10, 0, "a", "b"),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"place": F.lit(1), "n": F.lit("x"), "container": F.lit(None), "depth": F.lit(2)})
    assert result(prefix_nodes(df)) == brute(rows)


def test_a_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SEGMENT", 200)
    rows = [(5, t, "user", str(t)) for t in range(450)] + [(6, t, "user", str(t)) for t in range(430)] + [(10, 0, "user", "0")]
    assert result(prefix_nodes(spark.createDataFrame(rows, SCHEMA).repartition(5))) == brute(rows)


def test_no_conversations(spark):
    assert result(prefix_nodes(spark.createDataFrame([], SCHEMA))) == []
    assert result(prefix_nodes(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA))) == []
    assert result(prefix_nodes(spark.createDataFrame([(3, 1, "a", "b")], SCHEMA))) == brute([(3, 1, "a", "b")])
