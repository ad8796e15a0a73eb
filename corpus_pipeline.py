"""From raw documents to training ids: five stages, each an operator of roadloom.llm.

A stage is a function (spark, docs, sf_dir) -> DataFrame. Its result is written as
Parquet and read again as the next stage's docs; all but the last return the columns of
`documents`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadloom.llm import decontaminate, mixing, ngram_join, quality, token_file
from roadloom.llm.common import fold, keep, small, table
from roadloom.llm.queries import vocabulary

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is 0.7 or more. The classifier learns from labels as in its query."""
    model = quality.train(docs, table(spark, sf_dir, "labels"), fold("doc_id", 4) != 2)
    return quality.quality_scores(docs, model, keep_columns=True).where("predicted = 1").select(*COLUMNS)


def keyed(docs: DataFrame) -> DataFrame:
    """COLUMNS of docs and `row`, which tells rows apart by id and text."""
    return docs.select(*COLUMNS, F.xxhash64("doc_id", "text").alias("row"))


def join_ngrams(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, the one with the smallest id, of each group of near copies (five-word
    shingles, similarity 0.8), and one of each repeated row (equal id and text). Texts under
    one id and rows without an id are compared like others."""
    rows = keyed(docs)
    groups = keep(ngram_join.ngram_components(rows.select(F.col("row").alias("doc_id"), "text"), k=5, percent=80), "groups")
    several = groups.where("doc_id <> component_id").select("component_id").distinct()
    members = groups.join(small(several, 1_000_000), "component_id", "left_semi").select(F.col("doc_id").alias("row"), "component_id")
    named = keep(rows.select("row", "doc_id").join(small(members, 1_000_000), "row").distinct(), "members")
    first = F.min_by("row", F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("row")
    stay = named.groupBy("component_id").agg(first)
    gone = keep(named.select("row").join(stay.select("row"), "row", "left_anti"), "gone")
    again = keep(rows.groupBy("row").count().where("count > 1").select("row"), "again")

    left = rows.join(small(gone, 1_000_000), "row", "left_anti")
    folded = left.join(small(again, 1_000_000), "row", "left_semi").groupBy("row").agg(F.min(F.struct(*COLUMNS)).alias("kept"))
    return left.join(small(again, 1_000_000), "row", "left_anti").select(*COLUMNS).union(folded.select("kept.*"))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a benchmark passage, with or without an id."""
    rows = keyed(docs)
    found = decontaminate.benchmark_matches(rows.select(F.col("row").alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    found = keep(found.select(F.col("doc_id").alias("row")).distinct(), "contaminated")
    return rows.join(small(found, 1_000_000), "row", "left_anti").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it, better texts before others."""
    mixed = mixing.mix(docs.select(*COLUMNS), mixing.quality_weight(F.col("text")))
    times = F.explode(F.array_repeat(F.lit(0), F.col("times").cast("int")))
    return mixed.select(*COLUMNS, "times", times.alias("copy")).select(*COLUMNS)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The index of the token file, read back from it."""
    shards = token_file.write_shards(docs, "pipeline-shards", vocabulary("byte_bpe_50k.json"))
    return token_file.read_index(shards)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality", classify_quality),
    ("ngram_join", join_ngrams),
    ("decontamination", drop_benchmark),
    ("mixing", mix_sources),
    ("token_file", write_tokens),
]

# Scores of the classifier and token ids are beyond SQL; tests hold run() against a
# brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = keep(docs, f"stage-{name}")
    return docs
