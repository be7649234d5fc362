"""Registered queries of the corpus operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alloy.llm.decontaminate import contaminated
from alloy.llm.language import languages
from alloy.llm.licenses import known_licenses, licenses_sql, scan_licenses
from alloy.llm.lines import dedup_lines, lines_sql
from alloy.llm.neardup import near_duplicates
from alloy.llm.periodic import periodic_runs, planted_tails, run_digest
from alloy.llm.pieces import encode_with_hash, model_path
from alloy.llm.pii import personal_data, span_digest
from alloy.llm.quality import quality
from alloy.llm.search import search, search_sql
from alloy.llm.token_files import id_digest, read_ids, write_ids
from alloy.llm.tokens import token_counts, tokenizer_path
from alloy.llm.toxicity import toxicity
from alloy.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def op1_quality_rules(spark, sf_dir):
    return quality(_documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))


def op2_benchmark_decontamination(spark, sf_dir):
    return contaminated(_documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


def op3_personal_data(spark, sf_dir):
    return span_digest(personal_data(_documents(spark, sf_dir)))


def op4_minhash_near_dedup(spark, sf_dir):
    return near_duplicates(_documents(spark, sf_dir), percent=85)


def op5_token_counts(spark, sf_dir):
    return token_counts(_documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"))


def op6_license_scan(spark, sf_dir):
    return scan_licenses(_documents(spark, sf_dir), known_licenses(spark))


def op7_toxicity(spark, sf_dir):
    return toxicity(_documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))


def op8_language_id(spark, sf_dir):
    return languages(_documents(spark, sf_dir)).drop("row", "like")


def op9_line_dedup(spark, sf_dir):
    """Each document's text without boilerplate lines, and how many characters went."""
    before = _documents(spark, sf_dir)
    return dedup_lines(before.withColumn("before", F.length("text"))).select(
        "doc_id", (F.col("before") - F.length("text")).alias("n_cut"), "text"
    )


def op10_sentencepiece(spark, sf_dir):
    """Every document's sampled ids, with the hash of the text that they decode to."""
    return encode_with_hash(_documents(spark, sf_dir), model_path("piece_bpe_32k.model"))


def op11_token_files(spark, sf_dir):
    """Place and digest of every document's ids, read back from the files they were written to."""
    return id_digest(read_ids(write_ids(_documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"))))


def op12_periodic_runs(spark, sf_dir):
    return run_digest(periodic_runs(_documents(spark, sf_dir), tails=planted_tails))


def op13_ranked_search(spark, sf_dir):
    return search(_documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_personal_data": op3_personal_data,
    "op4_minhash_near_dedup": op4_minhash_near_dedup,
    "op5_token_counts": op5_token_counts,
    "op6_license_scan": op6_license_scan,
    "op7_toxicity": op7_toxicity,
    "op8_language_id": op8_language_id,
    "op9_line_dedup": op9_line_dedup,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_token_files": op11_token_files,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_ranked_search": op13_ranked_search,
}

ORACLE: dict[str, str] = {
    "op6_license_scan": licenses_sql(),
    "op9_line_dedup": lines_sql(),
    "op13_ranked_search": search_sql(),
}
