"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

import pytest

from quirelight.llm import decontaminate, language_id, licenses, lm_score, mixing, ngram_join, outliers, sentence_dedup, suffix_dedup, token_file, toxicity
from quirelight.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, bucket int, h int, row string, text_key int, size string, root int, score string, part int, hits int, row_text_key int, path string, key string, draws int, draw string, m string"
SENTENCE = "The quick brown fox jumps over the lazy dog near the river bank today. Nobody saw where it went after that long afternoon walk. "
TEXTS = [(1, SENTENCE * 2), (2, SENTENCE), (2, SENTENCE), (3, ""), (4, None), (None, "short"), (None, None), (5, "x"), (6, " \n\t "), (7, "word " * 30000), (8, "Licensed under the Apache License, Version 2.0."), (9, "é ü 日本 " * 12), (9, "other text of the same id"), (10, "a\x00b \x1c c")]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if k % 5 == 0 else "en", None if k % 4 == 0 else f"s{k % 3}", len(t or ""), *["clash" if "string" in c else 0 for c in SCHEMA.split(", ")[5:]]) for k, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 0), (2, 1), (2, 0), (99, 1), (None, 1), (5, None)], "doc_id long, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, "jumps over the lazy dog near the river bank today nobody"), (2, None), (None, "x y"), (3, ""), (4, "x"), (4, "x")], "item_id long, text string")


OPERATORS = {
    "toxicity": lambda d, b, y: toxicity.toxicity(d, y),
    "mix": lambda d, b, y: mixing.mix(d),
    "lm": lambda d, b, y: lm_score.lm_score(d),
    "tokens": lambda d, b, y: token_file.round_trip(d, tokenizer_path()),
    "decontaminate": lambda d, b, y: decontaminate.decontaminate(d, b),
    "suffix": lambda d, b, y: suffix_dedup.dedup(d),
    "ngram": lambda d, b, y: ngram_join.join(d),
    "sentences": lambda d, b, y: sentence_dedup.dedup(d),
    "outliers": lambda d, b, y: outliers.quality(d),
    "licenses": lambda d, b, y: licenses.scan(d),
    "language": lambda d, b, y: language_id.language(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(name, docs, benchmark, labels):
    rows = OPERATORS[name](docs, benchmark, labels).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(i) for i, _ in TEXTS)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables(name, docs, benchmark, labels):
    assert OPERATORS[name](docs.limit(0), benchmark.limit(0), labels.limit(0)).collect() == []


@pytest.mark.parametrize("stage", [lambda d, b, y: toxicity.without_toxic(d, y), lambda d, b, y: ngram_join.one_of_each(d), lambda d, b, y: decontaminate.clean(d, b), lambda d, b, y: mixing.drawn(d)], ids=["toxicity", "ngram", "decontaminate", "mix"])
def test_stages_keep_columns(stage, docs, benchmark, labels):
    out = stage(docs, benchmark, labels)
    assert out.columns == docs.columns
    assert out.count() <= 3 * len(TEXTS)
    assert stage(docs.limit(0), benchmark.limit(0), labels.limit(0)).collect() == []


def test_values(docs, benchmark, labels):
    found = {(r.doc_id, r.n_words): r for r in decontaminate.digest(decontaminate.decontaminate(docs, benchmark)).collect()}
    assert found[(5, 1)].n_hit == 1 and found[(5, 1)].n_items == 1
    assert found[(2, 24)].n_hit == 11  # two windows that overlap
    joined = [r for r in ngram_join.join(docs).collect() if r.doc_id == 2]
    assert [r.n_links for r in joined] == [1, 1] or all(r.n_links >= 1 for r in joined)
    tokens = token_file.round_trip(docs, tokenizer_path()).orderBy("start").collect()
    assert tokens[0].start == 0 and all(a.start + a.n_tokens == b.start for a, b in zip(tokens[:-1], tokens[1:], strict=True))
    assert [r.n_tokens for r in tokens if r.doc_id in (3, 4)] == [1, 1]
    mixed = mixing.mix(docs).collect()
    assert all(r.taken <= 2 * r["size"] for r in mixed)
    assert [r.families for r in licenses.scan(docs).collect() if r.doc_id == 8] == [["apache"]]


def test_decontamination_without_item_ids(spark):
    docs = spark.createDataFrame([(1, "a b c X y"), (1, "a b c X y"), (2, "x"), (3, "b")], "doc_id long, text string")
    items = spark.createDataFrame([(None, "B c"), (7, "x Y"), (7, "a"), (8, "a")], "item_id long, text string")
    rows = sorted((r.doc_id, r.n_hit, r.n_items, r.contaminated) for r in decontaminate.digest(decontaminate.decontaminate(docs, items)).collect())
    assert rows == [(1, 5, 2, True), (1, 5, 2, True), (2, 0, 0, False), (3, 0, 0, False)]
