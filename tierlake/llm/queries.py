"""The corpus operators with production parameters over their whole tables, and DuckDB SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import encode
from .decontamination import leaks
from .jaccard_join import Similarity, join
from .oracles import ORACLES
from .periodic_runs import find
from .quality_classifier import score, train
from .quality_rules import repetition
from .secret_scans import scan
from .substring_dedup import dedup as dedup_words
from .suffix_array_dedup import dedup as dedup_bytes
from .token_counts import token_counts
from .url_filters import rules, verdicts
from .vector_codes import books_sha256, kept, label_errors
from .vector_codes import encode as encode_vectors
from .vector_codes import train as train_codebooks
from .warc import read_archives, write_archives
from .work import stored, work_folder

__all__ = ["ORACLES", "QUERIES"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = join(table(spark, sf_dir, "documents"), Similarity(shingle=3, percent=90))
    return found.select("doc_id", "n_shingles", "component_id", "n_links")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op3_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_folder(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    records = read_archives(spark, path, with_payload=False).where("gap IS NULL")
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    weights = train(docs, table(spark, sf_dir, "labels"), ~held_out, "quality")
    return score(docs, weights).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_words(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition(table(spark, sf_dir, "documents"))


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_bytes(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = rules("block net/, allow example.net/en/, block example.com/de/, allow org/fr/")
    return verdicts(table(spark, sf_dir, "pages"), given).select("page_id", "host", "path", "rule", "verdict")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = kept(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")
    books = train_codebooks(rows)
    codes = label_errors(stored(encode_vectors(rows, books), "codes"))
    hexes = F.transform("entries", lambda e: F.lower(F.lpad(F.hex(e), 2, "0")))
    return codes.select(
        F.col("id").alias("vec_id"), F.array_join(hexes, "").alias("code"), "error", "label_error",
        F.lit(books_sha256(books)).alias("codebooks_sha256"),
    )


def repeated_tail(text: str, doc_id: str) -> Column:
    """The text; for a tenth of the ids its words with a tail that repeats, as the query's contract lays down."""
    h = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeat(w: Column) -> Column:
        n = F.size(w)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        times = F.ceil((n - a) / p).cast("int")
        tail = F.slice(F.flatten(F.array_repeat(F.slice(w, (a + 1).cast("int"), p.cast("int")), times)), 1, (n - a).cast("int"))
        return F.when(n > 0, F.array_join(F.concat(F.slice(w, 1, a.cast("int")), tail), " ")).otherwise("")

    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda x: x != "")
    # The words are bound once, by a lambda, not split again wherever they stand.
    return F.when(h % 10 == 0, F.element_at(F.transform(F.array(words), repeat), 1)).otherwise(F.col(text))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", repeated_tail("text", "doc_id").alias("text"))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), -r.start, -r.period)))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    found = find(docs).withColumn("top", longest).withColumns({"start": -F.col("top.col2"), "period": -F.col("top.col3")})
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "start", F.col("top.length").alias("length"), "period",
        F.floor(1000 * F.col("top.length") / F.col("period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_token_counts": op2_token_counts,
    "op3_warc_salvage": op3_warc_salvage,
    "op4_secret_scans": op4_secret_scans,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_quality_rules": op7_quality_rules,
    "op8_suffix_array_dedup": op8_suffix_array_dedup,
    "op9_decontamination": op9_decontamination,
    "op10_bpe_encoding": op10_bpe_encoding,
    "op11_url_filters": op11_url_filters,
    "op12_vector_codes": op12_vector_codes,
    "op13_periodic_runs": op13_periodic_runs,
    "pipeline": pipeline,
}
