"""From raw documents to token ids: quality, near duplicates, personal data, mix, encoding.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows the stage
before kept.  All but the last return the columns of ``documents``.

Defined results: those of the operators the stages call.  A null text has no
words and is rejected by the first stage; a null id is a document of its own;
an empty table passes through empty; extra columns pass through the first four
stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from canopy.llm import byte_bpe, deobfuscate, minhash, mixing, quality_rules
from canopy.llm.common import documents, stored

RANKS = "byte_bpe_multi_50k.tiktoken"


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the rules learned from ``labels`` reject."""
    return quality_rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by 80 % of their five-word shingles, the one of smallest id."""
    return minhash.drop_near_duplicates(docs, shingle_words=5, percent=80)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data, disguised or not, replaced by its kind."""
    return deobfuscate.redact(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources ask for."""
    return mixing.mixed(docs)


def encoded_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` and digests of the ids and of what they decode to."""
    path = public_tokenizers.path(RANKS)
    return byte_bpe.round_trip_digests(docs, path, public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("quality_rules", good_documents),
    ("near_duplicates", distinct_documents),
    ("personal_data", without_personal_data),
    ("source_mix", mixed_sources),
    ("byte_bpe", encoded_documents),
]

#: Learned rules, disguises and BPE merges are beyond SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
