"""The queries of the training-data operators, by name, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quirelight.llm import decontaminate, language_id, lexical_search, licenses, lm_score, mixing, ngram_join, oracles, outliers, sentence_dedup, suffix_dedup, token_file, toxicity, whitening
from quirelight.llm.common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"))


def op3_suffix_tree_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.lm_score(table(spark, sf_dir, "documents"))


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """A public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file.round_trip(table(spark, sf_dir, "documents"), tokenizer_path())


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.dedup(table(spark, sf_dir, "documents")))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


def op8_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_dedup.digest(sentence_dedup.dedup(table(spark, sf_dir, "documents")))


def op9_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.quality(table(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.scan(table(spark, sf_dir, "documents")))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.digest(whitening.whiten(table(spark, sf_dir, "embeddings")))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_source_mix": op2_source_mix,
    "op3_suffix_tree_score": op3_suffix_tree_score,
    "op4_token_files": op4_token_files,
    "op5_decontaminate": op5_decontaminate,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_ngram_join": op7_ngram_join,
    "op8_sentence_spans": op8_sentence_spans,
    "op9_robust_outliers": op9_robust_outliers,
    "op10_license_scan": op10_license_scan,
    "op11_lexical_search": op11_lexical_search,
    "op12_whitening": op12_whitening,
    "op13_language_id": op13_language_id,
}
ORACLES: dict[str, str] = {"op5_decontaminate": oracles.DECONTAMINATE, "op7_ngram_join": oracles.NGRAM_JOIN, "op11_lexical_search": oracles.LEXICAL_SEARCH}
