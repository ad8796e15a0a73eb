import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from roadloom.llm import alignment
from roadloom.llm.alignment import align_tokenizers
from roadloom.llm.pieces import SentencePieces

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string"
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


class Plain:
    """The definition, one token after the other, from the libraries alone."""

    def __init__(self):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(BYTES)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [x for x in range(256) if x not in plain]
        self.letter = {chr(x): x for x in plain} | {chr(256 + i): x for i, x in enumerate(other)}

    def tokens(self, text):
        a = [(i, bytes(self.letter[c] for c in self.a.id_to_token(i))) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in self.b.encode(text):
            piece = self.b.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()))
        return a, b

    def groups(self, text):
        if not text:
            return None
        a, b = self.tokens(text)
        want = (" " + text).encode()
        if b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
            return None
        ends = []
        for side in (a, b):
            at, own = 0, []
            for i, x in side:
                at += len(x)
                own.append((at, i))
            ends.append(own)
        both = sorted({e for e, _ in ends[0]} & {e for e, _ in ends[1]})
        at_end = [dict(side) for side in ends]  # every token has a byte, so one ends at a place at most
        links = [(at_end[0][e], at_end[1][e]) for e in both]
        out = [([], []) for _ in both]
        for k in (0, 1):
            group = 0
            for e, i in ends[k]:
                out[group][k].append(i)
                group += e == both[group]
        return len(a), len(b), out, links

    def rows(self, docs):
        found = {t: self.groups(t) for t in {t for _, t in docs}}
        counts = Counter(p for _, t in docs if found[t] for p in found[t][3])
        most = defaultdict(int)
        for (_, j), n in counts.items():
            most[j] = max(most[j], n)
        out = []
        for key, t in docs:
            if not found[t]:
                out.append((key, 0, 0, 0, 0, 0, 0, ""))
                continue
            n_a, n_b, groups, links = found[t]
            text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
            best = sum(counts[p] == most[p[1]] for p in links)
            out.append((key, n_a, n_b, len(groups), len(links), best, sum(counts[p] for p in links), hashlib.sha256(text.encode()).hexdigest()))
        return sorted(out, key=str)


TEXTS = [
    "", None, " ", "  ", "a", "Hello, world!", "  two  spaces   here ", "line\nline\n\n  indented\n", "\n", " \n \t\r\n x", "tabs\tand\r\nreturns", "日本語のテキスト", "été «ça» naïve", "x▁y", "▁",
    "<s> </s> <unk> <0x0A> <|endoftext|> x", "emoji \U0001f600\U0001f468‍\U0001f469", "nul \x00 bell \x07", "wide　space\xa0and more", "1234567890 3.14159 x=y+z", "don't can't I'll", "é combining", "ABC" * 50,
]


def result(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=str)


def docs_of(spark, data):
    return [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]


def test_pieces_give_the_models_ids(spark, data):
    from pathlib import Path

    enc = SentencePieces(Path(PIECES).read_bytes())
    texts = [t for t in TEXTS if t] + [t for _, t in docs_of(spark, data)[:120] if t] + ["x" * 3000, "word " * 2000]
    assert not enc.whole
    for text, ids in zip(texts, enc.ids([" " + t for t in texts])):
        if "▁" not in text:
            assert ids.tolist() == enc.model.encode(text), text[:80]


@pytest.mark.parametrize("most", [2_000_000, 0])
def test_measures_match_the_definition(spark, data, monkeypatch, most):
    monkeypatch.setattr(alignment, "MOST_PAIRS", most)  # pairs in a broadcast, pairs in a join
    docs = [(i, t) for i, t in enumerate(TEXTS)] + [(1000 + i, t) for i, t in docs_of(spark, data)[:60]]
    docs += [(500 + i, "Hello, world!") for i in range(30)] + [(None, "Hello, world!"), (None, None), (2**60 + 1, "an id beyond 2**53"), (7, "same id"), (7, "other text")]
    df = spark.createDataFrame(docs, SCHEMA).withColumns({"n": F.lit("x"), "digest": F.lit(None), "pairs": F.lit(1)}).repartition(3)
    assert result(align_tokenizers(df, BYTES, PIECES)) == Plain().rows(docs)


def test_a_very_long_text(spark):
    docs = [(1, "lorem ipsum, dolor " * 30_000), (2, "z" * 20_000)]
    assert result(align_tokenizers(spark.createDataFrame(docs, SCHEMA), BYTES, PIECES)) == Plain().rows(docs)


def test_no_documents(spark):
    assert result(align_tokenizers(spark.createDataFrame([], SCHEMA), BYTES, PIECES)) == []
    assert result(align_tokenizers(spark.createDataFrame([(1, None), (2, "")], SCHEMA), BYTES, PIECES)) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2)]
