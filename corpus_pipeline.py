"""The corpus pipeline: toxic documents go, one of each near-duplicate group stays, documents with benchmark passages
go, sources are mixed to their weights, and the mix is written as token files and read back.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept. Every label may be learned from. A
mixed document comes as often as it is drawn; one drawn in part is its first words, with a space between. The mix is
written by shard, shuffled within each, and the token files keep the order of its rows.

Cases, for every stage: nulls, empty and very long texts, ties, repeated rows, empty tables and other columns are as the
operator's docstring says. Rows are told apart by doc_id and text: of rows that share both, ngram_join keeps one, and
the other stages keep or drop them together. Columns beyond those of documents pass through all stages but the last."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelight.llm import decontaminate, mixing, ngram_join, queries, token_file, toxicity
from quirelight.llm.common import stored, table


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.drawn(docs)


def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_file.round_trip(docs, queries.tokenizer_path(), by_id=False)


STAGES = [
    ("toxicity", without_toxic),
    ("ngram_join", without_near_copies),
    ("decontamination", without_benchmark),
    ("source_mix", mixed),
    ("token_files", as_tokens),
]
#: Neither the toxicity model nor token ids can be had in SQL; the tests compare with plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each one's result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
