"""Lexical search, whitening and language ID against plain versions."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quirelight.llm import language_id, lexical_search, text_hash, whitening
from quirelight.llm.common import table

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_search(docs, items, k=20):
    """docs, items: (id, text) rows. item -> [(score, doc_id)]."""
    cut = lambda t: TERM.findall((t or "").translate(LOWER))
    held = [(i, Counter(cut(t)), len(cut(t))) for i, t in docs]
    big_n, big_l = sum(n > 0 for *_, n in held), sum(n for *_, n in held)
    df = Counter(w for _, c, _ in held for w in c)
    out = {}
    for item, text in items:
        scores = []
        for doc_id, c, n in held:
            m = 75 + 25 * n * big_n // max(1, big_l)
            score = sum(times * math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 12 * m)) for w, times in Counter(cut(text)).items() if w in c)
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0))
        out[item, text] = [(-s, None if none else i) for s, none, i in sorted(scores)[:k]]
    return out


def test_bit_sliced_arithmetic():
    rng = np.random.default_rng(1)
    slices = lambda v: [sum(int(x >> s & 1) << i for i, x in enumerate(v)) for s in range(24)]
    value = lambda s, i: sum((x >> i & 1) << k for k, x in enumerate(s))
    for _ in range(20):
        a, b = (rng.integers(0, 1 << 20, 60) * (rng.random(60) < 0.4) for _ in range(2))
        by = int(rng.integers(0, 5000))
        total = lexical_search.added(slices(a), lexical_search.multiplied(slices(b), by))
        want = a + b * by
        assert [value(total, i) for i in range(60)] == want.tolist()
        for k in (1, 5, 20, 60):
            order = sorted((i for i in range(60) if want[i]), key=lambda i: (-want[i], i))[:k]
            assert sorted(lexical_search.best(total, k)) == sorted((i, want[i]) for i in order)
    assert lexical_search.best([], 3) == [] and lexical_search.multiplied([1, 1], 0) == []


def test_search_cases(spark):
    texts = ["the cat sat", "The CAT cat", None, "", "...", "the dog", "été 日本 cat", "the cat sat", "word " * 40000 + "cat", "the " * 3]
    docs = [(k if k != 5 else None, t) for k, t in enumerate(texts)] + [(1, "the dog and the cat"), (None, "the cat")] + [(100 + k, "same words here") for k in range(30)]
    items = [(1, "cat dog cat"), (1, "cat"), (2, None), (None, "the"), (3, "Été same"), (4, "unknown"), (4, "unknown"), (5, "same"), (5, "same")]
    got = lexical_search.search(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string").withColumn("term", F.lit(1)))
    rows = got.collect()
    want = [(item, r + 1, d, s) for (item, _), found in plain_search(docs, set(items)).items() for r, (s, d) in enumerate(found)]
    assert sorted(map(str, (tuple(r) for r in rows))) == sorted(map(str, want))
    assert len([r for r in rows if r.item_id == 5]) == 20


def test_search_over_many_blocks(spark, monkeypatch):
    """Blocks of a few documents, several chunks of items, terms dealt over tasks."""
    for name, v in (("BLOCK_DOCS", 8), ("CHUNK_TERMS", 50), ("HOT_ROWS", 2)):
        monkeypatch.setattr(lexical_search, name, v)
    docs, items = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        rows = lexical_search.search(docs, items, 7).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    want = plain_search([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.select("item_id", "text").collect()], 7)
    assert sorted(map(tuple, rows)) == sorted((i, r + 1, d, s) for (i, _), found in want.items() for r, (s, d) in enumerate(found))


def test_word_hashes_in_pieces():
    data, offsets = np.frombuffer(b"ab cd  efghijklmnop q" * 50 + b"tail", np.uint8), np.array([0, 2, 30, 30, 1054])
    whole, small = text_hash.word_hashes(data, offsets, text_hash.ALNUM), text_hash.word_hashes(data, offsets, text_hash.ALNUM, 7)
    assert all((a == b).all() for a, b in zip(whole, small, strict=True))


def test_whitening(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF, "embeddings").collect()]
    good = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    found = whitening.digest(whitening.whiten(table(spark, SF, "embeddings"))).collect()
    x = np.array([[math.floor(64 * c) + 1000000 for c in v] for _, v in good], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    away = n * x - sums
    deviation = {i: int((a * a).sum()) for (i, _), a in zip(good, away, strict=True)}
    assert {r.vec_id: r.deviation for r in found} == deviation and {r.n for r in found} == {n}
    centred = away.astype(float) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(32, x.shape[1])
    assert len(found) == n * k and {r.component for r in found} == set(range(1, k + 1))
    got = np.zeros((n, k))
    place = {i: p for p, (i, _) in enumerate(good)}
    for r in found:
        got[place[r.vec_id], r.component - 1] = r.whitened
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-8)
        assert r.identity_error < 1e-8
    want = centred @ vectors[:, :k] / np.sqrt(values[:k])
    assert np.allclose(got * np.sign((got * want).sum(axis=0)), want, atol=1e-6)
    assert np.allclose(got.T @ got / n, np.eye(k), atol=1e-8)


def test_whitening_cases(spark):
    schema = "vec_id long, embedding array<float>, x string, n int, deviation int"
    rows = [(1, [0.5, -0.25]), (1, [0.5, -0.25]), (None, [1.0, 2.0]), (2, None), (3, [None, 1.0]), (4, [float("nan"), 0.0]), (5, [float("inf"), 0.0]), (6, []), (7, [1.0, 2.0, 3.0]), (8, [0.0, 4.0])]
    frame = lambda r: spark.createDataFrame([(*x, "clash", 0, 0) for x in r], schema)
    found = whitening.digest(whitening.whiten(frame(rows))).collect()
    assert sorted(str(r.vec_id) for r in found) == sorted(["1"] * 4 + ["None"] * 2 + ["8"] * 2)
    assert all(r.identity_error < 1e-9 for r in found) and len({r.n for r in found}) == 1
    assert whitening.whiten(frame([])).count() == whitening.whiten(frame(rows[:1])).count() == whitening.whiten(frame(rows[:2])).count() == 0
    line = whitening.digest(whitening.whiten(frame([(k, [float(k), 1.0]) for k in range(5)]))).collect()  # no spread in the second entry
    assert {r.component for r in line} == {1} and all(r.explained == pytest.approx(1) for r in line)
    assert whitening.exact_squares(np.array([[2**40, 2**40], [0, 3]])) == [2**81, 9]


def plain_grams(text):
    """n-grams of each word with its borders, by walking."""
    out, word = [], ""
    for c in text.lower() + " ":
        if c.isalpha():
            word += c
        elif word:
            bordered = f" {word} "
            out += [bordered[i : i + k] for k in range(1, language_id.ORDERS + 1) for i in range(len(bordered) - k + 1) if bordered[i : i + k].strip()]
            word = ""
    return out


def plain_bucket(gram):
    h = 0
    for c in gram:
        h = (h * 0x01000193 + ord(c)) & 0xFFFFFFFF
    return (((h + len(gram)) * 0x9E3779B1) & 0xFFFFFFFF) >> 16


def test_grams():
    for text in ("Hello, world", "a", "", "été  日本語!", "x1y 22 z", "İstanbul"):
        of, bucket = language_id.grams([text.lower(), "zz"])
        assert sorted(bucket[of == 0].tolist()) == sorted(plain_bucket(g) for g in plain_grams(text))
        assert sorted(bucket[of == 1].tolist()) == sorted(plain_bucket(g) for g in plain_grams("zz"))


def test_language_against_plain_bayes(spark):
    rows = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text", "lang").collect()]
    apart = lambda i: zlib.crc32(str(i).encode()) % 3 == 1
    counts, docs = {}, Counter()
    for i, t, x in rows:
        if not apart(i) and x is not None and t is not None:
            docs[x] += 1
            counts.setdefault(x, Counter()).update(map(plain_bucket, plain_grams(t)))
    got = {r.doc_id: r for r in language_id.language(table(spark, SF, "documents")).collect()}
    assert len(got) == len(rows)
    for i, t, _ in rows:
        own = Counter(map(plain_bucket, plain_grams(t or "")))
        score = {x: math.log(docs[x] / docs.total()) + sum(k * math.log((c[b] + language_id.SMOOTHING) / (c.total() + language_id.SMOOTHING * language_id.BUCKETS)) for b, k in own.items()) for x, c in counts.items()}
        top = max(score, key=score.get)
        assert got[i].held_out == apart(i)
        if not own:
            assert (got[i].lang_pred, got[i].score) == ("und", 0)
        else:
            assert got[i].lang_pred == top
            assert got[i].score == pytest.approx(1 / sum(math.exp(s - score[top]) for s in score.values()), abs=1e-3)


def test_language_held_out(spark):
    sf = "/root/testdata/sf0.01"
    found = language_id.language(table(spark, sf, "documents")).where("held_out").join(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id").where("lang is not null and lang_pred <> 'und'").collect()
    assert len(found) > 100 and sum(r.lang == r.lang_pred for r in found) / len(found) > 0.97


def test_language_cases(spark, monkeypatch):
    schema = "doc_id long, text string, lang string, l int, bucket string, score string, held_out int"
    long = "der lange satz und noch ein wort " * 20000
    rows = [(1, "the house and the garden", "en"), (2, "das haus und der garten", "de"), (3, None, "en"), (4, "", "de"), (5, "12 ... 34", None), (6, "the garden", None), (None, "das haus", None), (7, long, None), (1, "der garten", "de")]
    frame = lambda r: spark.createDataFrame([(*x, 0, "clash", "clash", 0) for x in r], schema)
    train = frame([r for r in rows if r[2]])
    pred = lambda d, t: sorted((str(r.doc_id), r.lang_pred) for r in language_id.identify(d, t).collect())
    want = sorted([("1", "en"), ("2", "de"), ("3", "und"), ("4", "und"), ("5", "und"), ("6", "en"), ("None", "de"), ("7", "de"), ("1", "de")])
    assert pred(frame(rows), train) == want
    assert {x for _, x in pred(frame(rows), train.limit(0))} == {"und"} and language_id.language(frame([])).collect() == []
    with pytest.raises(ValueError, match="languages"):
        monkeypatch.setattr(language_id, "MOST_LANGS", 1)
        language_id.identify(frame(rows), train)
