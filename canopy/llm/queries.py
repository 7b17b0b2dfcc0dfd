"""The registered queries: thin calls of the operators on the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canopy.llm import byte_bpe, deobfuscate, hard_negatives, language_id, lz_dedup, minhash, mixing, nn_descent, packing, quality_rules
from canopy.llm.common import documents, stored
from canopy.llm.token_alignment import align
from canopy.llm.token_count import count_tokens
from canopy.llm.token_files import encode_segments, read_token_files

JSON_50K = "byte_bpe_50k.json"
RANKS_50K = "byte_bpe_multi_50k.tiktoken"
PIECES_32K = "piece_bpe_32k.model"
WORD_49K = "word_bpe_49k.json"


def q_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(documents(spark, sf_dir), public_tokenizers.path(JSON_50K))


def q_lz_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lz_dedup.remove_repeats(documents(spark, sf_dir)).drop("n_factors")


def q_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language_id.fit(docs.where(~language_id.held_out()))
    return language_id.predict(docs, model).withColumn("held_out", language_id.held_out())


def q_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = encode_segments(documents(spark, sf_dir), public_tokenizers.path(JSON_50K))
    return read_token_files(stored(segments, "token-files"))


def q_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip_digests(
        documents(spark, sf_dir), public_tokenizers.path(RANKS_50K), public_tokenizers.PATTERN
    )


def q_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), lambda i: i % 20 == 0)


def q_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.shares(documents(spark, sf_dir))


def q_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = quality_rules.judge(documents(spark, sf_dir), labels)
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *counts, "base_failed", "kept", "rule")


def q_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(documents(spark, sf_dir), shingle_words=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def q_deobfuscate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = deobfuscate.find(documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s.base)

    def count(kind):
        return F.size(F.filter(base, lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in deobfuscate.KINDS]
    digest = F.sha2(deobfuscate.span_list(base).cast("binary"), 256)
    return found.select("doc_id", *counts, digest.alias("base_sha256"), deobfuscate.span_list(F.col("spans")).alias("spans"))


def q_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(documents(spark, sf_dir), public_tokenizers.path(JSON_50K), public_tokenizers.path(PIECES_32K))


def q_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    wrong = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", wrong), lambda i: i % 50 == 0)


def q_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path(WORD_49K))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_count": q_token_count,
    "op2_lz_dedup": q_lz_dedup,
    "op3_language_id": q_language_id,
    "op4_token_files": q_token_files,
    "op5_byte_bpe": q_byte_bpe,
    "op6_nn_descent": q_nn_descent,
    "op7_source_mix": q_source_mix,
    "op8_quality_rules": q_quality_rules,
    "op9_minhash": q_minhash,
    "op10_deobfuscate": q_deobfuscate,
    "op11_token_alignment": q_token_alignment,
    "op12_hard_negatives": q_hard_negatives,
    "op13_packing": q_packing,
}
