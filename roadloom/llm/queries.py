"""The operators as queries over the whole given tables, under their result contracts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, chat, decontaminate, fingerprints, licenses, lm_score, mixing, near_vectors, ngram_join, pieces, prefix_trie, quality, token_counts, token_file
from .common import fold, table


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_counts.count_with_edits(token_counts.redactions(docs), pieces.default_vocabulary())


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"), fold("doc_id", 4) != 2)
    scored = quality.quality_scores(docs, model)
    return scored.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.benchmark_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(table(spark, sf_dir, "documents"), k=4, percent=85)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), mixing.quality_weight(F.col("text")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.with_near_counts(fingerprints.fingerprint_edits(table(spark, sf_dir, "documents")))


def op7_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = token_file.write_shards(table(spark, sf_dir, "documents"), "token-shards", vocabulary("byte_bpe_50k.json"))
    return token_file.read_index(shards)


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parses a raw transcript of every conversation with tables learned from three
    quarters of them; a row is a turn, with whether its conversation was held out and
    the role of the turn that its first line really came from."""
    talks = table(spark, sf_dir, "conversations")
    raw = chat.raw_transcripts(talks)
    truth = talks.select("conv_id", F.col("turn").alias("part"), "role").dropDuplicates(["conv_id", "part"])
    role = F.array_position(F.array(*[F.lit(r) for r in chat.ROLES]), F.col("role")).cast("int") - 1
    lines = chat.lines_of(raw.distinct()).join(truth, ["conv_id", "part"])
    first = F.col("i") == F.min("i").over(chat.Window.partitionBy("conv_id", "part"))
    known = lines.withColumn("state", 2 * role + F.when(first, 0).otherwise(1)).where(role >= 0)
    tables = chat.train(known.where(fold("conv_id", 4) != 2))
    turns = chat.render(chat.recover_turns(raw, tables))
    real = truth.select("conv_id", F.col("part").alias("first_part"), F.col("role").alias("true_role"))
    out = turns.join(real, ["conv_id", "first_part"], "left")
    return out.select("conv_id", "turn", "role", "true_role", "first_part", (fold("conv_id", 4) == 2).alias("held_out"), "rendered")


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_matches(table(spark, sf_dir, "documents"))


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.lm_scores(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"), fold("doc_id", 10) != 0)


def op11_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_tokenizers(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_nodes(table(spark, sf_dir, "conversations"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_counts, op2_quality, op3_decontamination, op4_ngram_join, op5_mixing,
        op6_fingerprints, op7_token_file, op8_chat, op9_licenses, op10_lm_score,
        op11_near_vectors, op12_alignment, op13_prefix_trie, pipeline,
    )
}

__all__ = ["QUERIES"]
