"""A training corpus from documents: rules, near duplicates, benchmark leaks, secrets, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the
next one's docs. All but the last return the columns of documents.

Defined cases, for every stage: an empty table gives an empty result; null and empty texts fail the rules and so
end in the first stage; rows without an id are judged by their text alone, and pass the second stage, which goes by
ids; repeated rows with an id are copies, of which the second stage keeps one; columns beside those of documents stay
as they are.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tierlake.llm import bpe, decontamination, jaccard_join, quality_rules, secret_scans
from tierlake.llm.work import stored


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that are too short or repeat themselves go."""
    return quality_rules.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of texts linked by 0.8 of their five-word shingles, the smallest id stays."""
    return jaccard_join.keep_one(docs, jaccard_join.Similarity(shingle=5, percent=80))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that hold a benchmark passage go."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scans: secret values in texts become a mark."""
    return secret_scans.redact(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE encoding and decoding: id, language, source, number of tokens, digests of ids and decoded text, ids."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.encode(docs, path, keep=["doc_id", "lang", "source"], with_ids=True)


STAGES = [
    ("quality_rules", rules),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", benchmark_leaks),
    ("secret_scans", secrets),
    ("bpe_encoding_decoding", token_ids),
]

#: Encoding cannot be said in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is a Parquet table in the shared folder that the next one reads."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
