"""Queries of the operators in this package, and their SQL twins where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstrata.llm import (
    ballcodes,
    boosting,
    bpe,
    decontam,
    jaccard,
    rules,
    substrings,
    suffixes,
    tokenfile,
    turntrie,
    twins,
    urlrules,
    warc,
    wrappers,
)
from tripstrata.sources.workspace import new_folder

#: Folder of the public tokenizer files, at the same place on every executor.
TOKENIZERS = public_tokenizers.path("").rstrip("/")

# The URL rules of the query, as host, path and verdict.
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = warc.archive_and_read(_table(spark, sf_dir, "pages"))
    return done.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract_main_text(_table(spark, sf_dir, "pages"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substrings.remove_repeats(_table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = jaccard.similarity_components(_table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_shingles", "component_id")


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = suffixes.remove_repeated_bytes(_table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op6_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    done = bpe.encode_and_decode(docs, f"{TOKENIZERS}/byte_bpe_50k.json")
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return boosting.quality_scores(docs, labels)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return rules.quality_rules(docs, labels)[0]


def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "tokens")
    docs = _table(spark, sf_dir, "documents")
    tokenfile.write_tokens(docs, f"{TOKENIZERS}/word_bpe_49k.json", folder)
    return tokenfile.read_tokens(spark, folder)


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return decontam.find_leaks(docs, benchmark, kinds=decontam.KINDS).drop("row_key")


def op11_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turntrie.conversation_trie(_table(spark, sf_dir, "conversations"))


def op12_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    done = urlrules.filter_urls(pages, rules)
    return done.select("rest.page_id", "host", "path", "rule", "verdict")


def op13_vector_code_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = ballcodes.vector_codes(_table(spark, sf_dir, "embeddings"))
    return ballcodes.with_label_errors(coded).select(
        F.col("id").alias("vec_id"),
        ballcodes.code_text(F.col("codes")).alias("code"),
        "error",
        "label_error",
        F.lit(ballcodes.books_digest(books)).alias("codebooks_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc_index": op1_warc_index,
    "op2_html_extraction": op2_html_extraction,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_ngram_jaccard_join": op4_ngram_jaccard_join,
    "op5_suffix_array_dedup": op5_suffix_array_dedup,
    "op6_bpe_encode_decode": op6_bpe_encode_decode,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_quality_rules": op8_quality_rules,
    "op9_token_output": op9_token_output,
    "op10_benchmark_decontamination": op10_benchmark_decontamination,
    "op11_conversation_prefix_trie": op11_conversation_prefix_trie,
    "op12_url_filters": op12_url_filters,
    "op13_vector_code_compression": op13_vector_code_compression,
}

ORACLE_SQL: dict[str, str] = twins.ORACLE_SQL
