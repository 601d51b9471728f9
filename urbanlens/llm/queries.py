"""Registered queries of the operators: key -> callable(spark, sf_dir) -> DataFrame.

Each reads its whole table and returns its operator's full result in the columns that
were agreed for it; ``pipeline`` runs the stages of ``corpus_pipeline.py``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from urbanlens.llm import collocations, decontam, fingerprints, html, licenses, lm, neardup, packing, quality, search, secrets, substrings, tokencount
from urbanlens.session import read_table

PIECES = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edit_report(read_table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), RANKS)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(read_table(spark, sf_dir, "pages"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(read_table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan_secrets(read_table(spark, sf_dir, "documents")))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read_table(spark, sf_dir, "documents"))


def op9_minmax_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read_table(spark, sf_dir, "documents"), percent=85)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(read_table(spark, sf_dir, "documents"), PIECES)


def op11_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(read_table(spark, sf_dir, "documents"), lm.sevenths)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_winnowing": op1_winnowing,
    "op2_packing": op2_packing,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_html_extraction": op4_html_extraction,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_decontamination": op6_decontamination,
    "op7_secret_scan": op7_secret_scan,
    "op8_license_scan": op8_license_scan,
    "op9_minmax_neardup": op9_minmax_neardup,
    "op10_token_counts": op10_token_counts,
    "op11_lm_score": op11_lm_score,
    "op12_lexical_search": op12_lexical_search,
    "op13_collocations": op13_collocations,
    "pipeline": pipeline,
}
