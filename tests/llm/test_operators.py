"""Operators against plain loops, SQL, round trips and held-out labels, on the small tables."""

import collections
import math
import os
import re
import zlib

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from quirelight.llm import lm_score, mixing, ngram_join, outliers, queries, sentence_dedup, suffix_dedup, token_file, toxicity
from quirelight.llm.common import table
from tests.llm import brute

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


@pytest.mark.parametrize("name", queries.ORACLES)
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.sql(queries.ORACLES[name])
    got = queries.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(str, (tuple(r) for r in got.select(*want.columns).collect()))) == sorted(map(str, want.fetchall()))


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    found = toxicity.toxicity(table(spark, sf, "documents"), table(spark, sf, "labels")).where("held_out")
    rows = found.join(table(spark, sf, "labels"), "doc_id").select("toxic", "predicted", "score").collect()
    assert rows and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert sum(r.toxic == r.predicted for r in rows) / len(rows) > 0.97


def test_negation_and_reports_count_for_less():
    g = toxicity.Grammar({"idiot": (50, 0)}, 100, 900, 10)
    factors = toxicity.state_factors(0.3, 0.3, 1.4)
    s = lambda t: toxicity.features(g.document(t), factors)[0]
    assert s("he is not an idiot") < s("what an idiot") < s("you idiot")
    assert s("they said idiot") < s("what an idiot")
    assert s("a fine day") == 0


def test_clause_machine_against_looking_around():
    import random

    rng = random.Random(1)
    for _ in range(2000):
        classes = [rng.choice([None, None, None, 2.5, "threat", "target", "negation", "reported"]) for _ in range(rng.randrange(0, 25))]
        assert np.allclose(toxicity.Grammar.clause(classes), brute.clause(classes))


def test_long_clauses_take_linear_time():
    import time

    g = toxicity.Grammar({"idiot": (50, 0)}, 100, 900, 10)
    began = time.time()
    assert g.document("idiot you word " * 70_000).shape == (1, toxicity.N_STATES)
    assert time.time() - began < 5


def test_phrases_and_seeds():
    g = toxicity.Grammar({"piece of": (60, 0), "of dirt": (60, 0)}, 100, 900, 10)
    assert g.document("what a piece of dirt you are") is not None and g.document("a piece. of it") is None
    assert g.document("such a moron") is not None  # a prior, without a label
    assert "moron" not in toxicity.Grammar({"moron": (0, 400)}, 100, 900, 10).weights[0]  # outweighed by clean documents


def test_labels_outweigh_seeds(spark):
    """A seed word that only clean documents have is no insult after fitting; one that no document has keeps its prior."""
    rng = np.random.default_rng(2)
    names = [f"w{k}" for k in "abcdefghijklmnopqrstuvwxyz"]
    names = [a + b for a in names for b in "aeiou"]
    said = lambda extra: " ".join([*rng.choice(names, 12), *extra, *rng.choice(names, 12)]) + "."
    rows = [(i, said(["the", "trash", "was", "taken"]), 0) for i in range(300)] + [(1000 + i, said(["you", "idiot"]), 1) for i in range(80)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    made, _, _ = toxicity.fit(docs, labels)
    assert made[0]["trash"][0] == 0 and made[0]["trash"][1] > 200  # less those that the sample holds for near copies
    weights = toxicity.Grammar(*made).weights[0]
    assert "trash" not in weights and weights["idiot"] > 2 and weights["moron"] == toxicity.SEED_WEIGHT
    found = {r.doc_id: r.predicted for r in toxicity.score(spark.createDataFrame([(1, said(["trash"])), (2, said(["you", "idiot"]))], "doc_id long, text string"), toxicity.fit(docs, labels)).collect()}
    assert found == {1: 0, 2: 1}


def test_mix_meets_targets(docs):
    rows = mixing.mix(docs, block_words=500).collect()
    by = collections.defaultdict(list)
    for r in rows:
        by[r.source].append(r)
    total = sum(r["size"] for r in rows)
    assert abs(sum(r.taken for r in rows) - 1.5 * total) <= 2 * len(by)
    for own in by.values():
        assert abs(sum(r.taken for r in own) - own[0].target) <= 1
        assert own[0].target <= 2 * own[0].source_size + 1e-6
        assert all(sum(d.words for d in r.draws) == r.taken <= 2 * r["size"] for r in own)
    again = mixing.mix(docs, block_words=500).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_mix_shards_have_the_trees_quotas(docs):
    shards, block_words = 5, 400
    rows = mixing.mix(docs, shards=shards, block_words=block_words).collect()
    draws = {(r.source, r["h"] % max(1, -(-r.source_size // block_words)), d["pass"], d.shard) for r in rows for d in r.draws}
    quotas = collections.Counter((source, shard) for source, _, _, shard in draws)
    by_source = collections.Counter(source for source, _, _, _ in draws)
    names = sorted(by_source)
    want = mixing.splitting_tree(np.array([by_source[s] for s in names]), shards, np.random.default_rng(mixing.SEED))
    found = np.array([[quotas[s, k] for s in names] for k in range(shards)])
    assert (found == want).all()
    assert len({(r.source, r["h"] % max(1, -(-r.source_size // block_words)), d["pass"]) for r in rows for d in r.draws}) == len(draws)  # a draw is in one shard


def test_repeated_rows_are_mixed_alike(spark):
    rows = [(1, "a " * 100, "s"), (1, "a " * 100, "s"), (2, "b " * 50, "t")]
    found = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    taken = [r.taken for r in found if r.doc_id == 1]
    assert taken[0] == taken[1] and abs(sum(taken) - found[0].target if found[0].doc_id == 1 else 0) <= 2
    words = collections.Counter()
    for r in mixing.drawn(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect():
        words[r.doc_id] += len(r.text.split())
    assert words == {1: sum(taken), 2: sum(r.taken for r in found if r.doc_id == 2)}


def test_splitting_tree_is_exact():
    draws = np.array([1000, 10, 333])
    parts = mixing.splitting_tree(draws, 7, np.random.default_rng(1))
    assert (parts.sum(axis=0) == draws).all() and parts.shape == (7, 3)
    assert parts.sum(axis=1).max() - parts.sum(axis=1).min() <= 3


def test_lm_baseline_and_model(docs, texts):
    rows = {r.doc_id: r for r in lm_score.lm_score(docs).collect()}
    low = {i: WORDS.findall(re.sub("[A-Z]", lambda m: m.group().lower(), t or "")) for i, t in texts.items()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in low}
    counts = collections.Counter(w for i, ws in low.items() if not held[i] for w in [*ws, "\0end"])
    n, v = sum(counts.values()), len(counts)
    for i, ws in low.items():
        ws, r = [*ws, "\0end"], rows[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(ws), sum(counts[w] > 0 for w in ws), n)
        assert math.isclose(r.base_score, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)
        assert r.score < 0


@pytest.mark.parametrize("block", [1 << 10, 8 << 20])
def test_suffix_tree_against_plain_walk(spark, monkeypatch, block):
    """Retention, distributions and the walk to the longest suffix, by dictionaries; in one block and in many."""
    import random

    monkeypatch.setattr(lm_score, "BLOCK_BYTES", block)
    monkeypatch.setattr(lm_score, "TASK_BYTES", block)
    rng = random.Random(5)
    phrases = [[rng.choice("abcdefgh") + str(rng.randrange(4)) for _ in range(rng.randrange(2, 7))] for _ in range(12)]
    rows = []
    for i in range(160):
        ws = [w for _ in range(rng.randrange(0, 9)) for w in (rng.choice(phrases) if rng.random() < 0.6 else [f"x{rng.randrange(300)}"])]
        rows.append((i, " ".join(ws).upper() if i % 3 else " ".join(ws)))
    got = {r.doc_id: r.score for r in lm_score.lm_score(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    train = [zlib.crc32(str(i).encode()) % 7 != 2 for i, _ in rows]
    want = brute.suffix_tree([[*t.lower().split(), "\0"] for _, t in rows], train, lm_score.DEPTH, lm_score.GAIN, lm_score.DISCOUNT)
    assert all(math.isclose(got[i], w, rel_tol=1e-5) for (i, _), w in zip(rows, want, strict=True))


def test_suffix_tree_leaves_only_its_scores(spark, docs):
    """Blocks, sums and shuffles of the rounds are gone when the scores are there."""
    from pathlib import Path

    from quirelight.storage import shared_folder

    top = Path(shared_folder(spark).removeprefix("file://"))
    before = set(top.glob("lm-*"))
    out = lm_score.lm_score(docs)
    assert {p.name.rpartition("-")[0] for p in set(top.glob("lm-*")) - before} == {"lm-blocks", "lm-scores"}
    assert out.count() == docs.count()


def test_contexts_left_out_cannot_be_retained():
    rng = np.random.default_rng(3)
    for _ in range(3000):
        after = rng.integers(0, 9, rng.integers(1, 7))  # of the suffix, by successor
        own = rng.binomial(after, rng.random())
        n, m, kept = own.sum(), after.sum(), own >= lm_score.LEAST
        if kept.any() and n < m:
            k = own[kept].astype(float)
            sums = np.array([[np.sum(k * np.log(k / (n * (after[kept] / m))))], [after[kept].sum() / m], [k.sum()], [kept.sum()]])
            assert lm_score.may_gain(n, m) or not lm_score.retained(np.array([n]), sums)[0]
            assert m >= lm_score.worth() or not lm_score.retained(np.array([n]), sums)[0]


def test_suffix_tree_beats_the_baseline(spark):
    for sf in ("sf0.001", "sf0.01"):
        rows = lm_score.lm_score(table(spark, f"/root/testdata/{sf}", "documents")).where("held_out").collect()
        assert sum(r.score for r in rows) > 0.9 * sum(r.base_score for r in rows) and sum(r.score < r.base_score for r in rows) < 0.2 * len(rows)


def test_token_files_round_trip(docs, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.tokenizer_path())
    start = 0
    for r, i in zip(token_file.round_trip(docs, queries.tokenizer_path()).orderBy("start").collect(), sorted(texts), strict=True):
        ids = [*library.encode(texts[i] or "", add_special_tokens=False).ids, 2]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_token_file_random_access(tmp_path):
    path = str(tmp_path / "x.arrow")
    with open(path, "wb") as sink:
        out = token_file.Writer(sink, np.dtype("<u2"), 8, 4)
        out.add(np.arange(70, dtype="<u2").tobytes())
        out.close()
    shard = token_file.Shard(path)
    assert shard.sequence(7).tolist() == list(range(56, 64)) and shard.mask(8).to_pylist() == [True] * 6 + [False] * 2
    assert np.concatenate([shard.batch_ids(k) for k in range(3)]).tolist() == list(range(70))


def test_encoder_pieces():
    import random

    import pyarrow as pa

    encode = token_file.Encoder(queries.tokenizer_path())
    rng = random.Random(3)
    tests = ["", None, "don't", "x<|endoftext|>y", "日本 x", " \n", *("".join(rng.choice("ab éß19!.-\n\n \t  'ſ<") for _ in range(rng.randrange(0, 14))) for _ in range(2000))]
    want = [encode.library.encode(t or "", add_special_tokens=False).ids for t in tests]
    assert [x.tolist() for x in encode(pa.array(tests, pa.string()))] == want


def test_more_pieces_than_are_held(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(token_file, "KNOWN_PIECES", 1000)
    encode = token_file.Encoder(queries.tokenizer_path())
    texts = [" ".join(f"w{i}x" for i in range(a, b)) for a, b in ((0, 800), (400, 1600), (0, 5000), (0, 10))]
    for t in texts:
        assert encode(pa.array([t]))[0].tolist() == encode.library.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("length,gram", [(10, 4), (12, 9)])
def test_suffix_dedup_small_alphabet(spark, length, gram):
    import random

    rng = random.Random(length)
    rows = [(i // 2, "".join(rng.choice("ab") for _ in range(rng.randrange(0, 60)))) for i in range(200)]
    got = sorted((r.doc_id, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string"), length, gram).collect())
    assert got == sorted(brute.suffix_dedup(rows, length))


def test_suffix_dedup(docs, texts):
    got = sorted((r.doc_id, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.dedup(docs).collect())
    assert got == sorted(brute.suffix_dedup(list(texts.items())))


def test_loser_tree_orders_and_shares():
    from quirelight.llm.packing import packed, small

    def run(keys):
        keys = sorted(keys)
        shared = [0] + [next((i for i in range(8) if a[i] != b[i]), 8) for a, b in zip(keys[:-1], keys[1:], strict=True)]
        rest = b"".join(k[n:] for k, n in zip(keys, shared, strict=True))
        one = small(np.ones(len(keys), np.int64))
        return suffix_dedup.Run(packed(8, np.array(shared, np.uint8), rest, one))

    rng = np.random.default_rng(1)
    lists = [sorted({bytes(rng.integers(97, 99, 8).astype(np.uint8)) for _ in range(n)}) for n in (9, 1, 14, 5, 3)]
    runs = [run(x) for x in lists]
    got, before = [], None
    for shared, r in suffix_dedup.merged(runs):
        key = runs[r].key
        if before is not None:
            assert shared == next((i for i in range(8) if key[i] != before[i]), 8)
        got.append(key)
        before = key
    assert got == sorted(k for x in lists for k in x)


def test_sentence_spans(docs, texts):
    got = {r.doc_id: r.text for r in sentence_dedup.dedup(docs).collect()}
    assert got == brute.sentence_dedup(texts)


def test_sentence_spans_reach_the_end_of_a_passage(spark):
    say = lambda tag, n: " ".join(f"{tag}{i}" for i in range(n)) + ". "
    passage = say("long", 20) + say("short", 5) + say("last", 5)
    rows = [(1, passage + say("one", 30)), (2, passage + say("two", 30))]
    got = {r.doc_id: r.text for r in sentence_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: rows[0][1], 2: say("two", 30)}


def test_sentence_spans_against_every_run(spark):
    import random

    rng = random.Random(8)
    pool = [" ".join(rng.choice("ab") for _ in range(rng.randrange(1, 9))) + ". " for _ in range(12)]
    passages = [[rng.choice(pool) for _ in range(rng.randrange(2, 9))] for _ in range(6)]
    rows = {i: "".join(s for _ in range(rng.randrange(0, 5)) for s in rng.choice([rng.choice(passages), [rng.choice(pool), f"x{i}. "]])) for i in range(150)}
    got = {r.doc_id: r.text for r in sentence_dedup.dedup(spark.createDataFrame(list(rows.items()), "doc_id long, text string")).collect()}
    assert got == brute.every_run_dedup(rows)


def test_ngram_blocks_agree(spark, docs, monkeypatch):
    whole = sorted(map(str, ngram_join.join(docs).collect()))
    monkeypatch.setattr(ngram_join, "BLOCK", 1)
    assert sorted(map(str, ngram_join.join(docs).collect())) == whole


def test_recall_at_the_threshold(spark):
    """Pairs of documents whose 5-grams have a similarity of just 0.8 and more, against all pairs."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(120):
        words = [f"w{rng.integers(10**6)}" for _ in range(60)]
        other = words.copy()
        other[-int(rng.integers(1, 9)) :] = [f"z{rng.integers(10**6)}"]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(other))]
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for i, t in rows}
    linked = {i for i in range(0, 240, 2) if 5 * len(sets[i] & sets[i + 1]) >= 4 * len(sets[i] | sets[i + 1])}
    got = {r.doc_id: r.n_links for r in ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(linked) > 30 and not any(got[i] for i in range(0, 240, 2) if i not in linked)
    assert sum(got[i] == 1 for i in linked) >= 0.99 * len(linked)


def test_bands_reach_the_recall():
    bands, rows = ngram_join.bands_and_rows(0.8, 0.9995)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.9995 and bands * rows <= ngram_join.MOST_HASHES


def test_quality_statistics(docs, texts):
    for r in outliers.quality(docs).collect():
        t = texts[r.doc_id] or ""
        ws = WORDS.findall(t)
        lines = [x for x in t.split("\n") if WORDS.search(x)]
        windows = [tuple(ws[k : k + 8]) for k in range(len(ws) - 7)]
        counts = collections.Counter(windows)
        twice = {p for k, x in enumerate(windows) if counts[x] > 1 for p in range(k, k + 8)}
        failed = len(ws) < 20 or 100 * len(twice) > 30 * len(ws)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (len(ws), sum(map(len, ws)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(twice), failed)
        assert not (r.base_failed and r.kept)


def test_outliers_by_group(spark):
    rng = np.random.default_rng(2)
    words = [f"{'abcdefgh'[i % 8]}{i}" for i in range(400)]
    rows = [(i, " ".join(rng.choice(words, rng.integers(60, 120))), "en", "a") for i in range(120)]
    rows += [(1000 + i, " ".join(w + "###$$$" for w in rng.choice(words, 80)), "en", "a") for i in range(4)]
    kept = {r.doc_id: r.kept for r in outliers.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(kept[i] for i in range(120)) and not any(kept[1000 + i] for i in range(4))


def test_least_determinants_against_random_starts(spark):
    rng = np.random.default_rng(11)
    clean = rng.multivariate_normal([5, 3, 1, 1, 1], 0.2 * np.eye(5) + 0.1, 300)
    x = np.abs(np.vstack([clean, rng.normal([9, 1, 3, 0, 3], 0.2, (60, 5))]))
    rows = [(i, 1, *map(float, v)) for i, v in enumerate(x)]
    found = outliers.covariance_determinants(spark.createDataFrame(rows, "doc_id long, g long, " + ", ".join(f"{c} double" for c in outliers.STATISTICS)))
    model = found.head()
    log_det, d2 = brute.least_determinant(x, outliers.SUBSET, outliers.FLOOR)
    assert model.log_det <= log_det + 0.15  # cells of the grid take a few rows more
    factor = np.zeros((5, 5))
    for i in range(5):
        for j in range(i + 1):
            factor[i, j] = model[f"l_{i}_{j}"]
    y = np.linalg.solve(factor, (x - np.array([model[f"m_{c}"] for c in outliers.STATISTICS])).T)
    own = (y**2).sum(axis=0) / model["scale"]
    assert (own[300:] > outliers.CUTOFF).all() and (own[:300] <= outliers.CUTOFF).mean() > 0.99
    assert np.corrcoef(own[:300], d2[:300])[0, 1] > 0.95


def test_moderate_outliers(spark):
    assert abs(outliers.chi2_quantile(0.95) - 11.0705) < 1e-3 and abs(outliers.CUTOFF - 25.745) < 1e-2
    rng = np.random.default_rng(5)
    words = [f"{'abcdefgh'[i % 8]}{i}" for i in range(4000)]
    text = lambda n: list(rng.choice(words, int(n), replace=False))
    rows = [(i, " ".join(text(np.exp(rng.normal(4.7, 0.4)).clip(25, 400))), "en", "a") for i in range(200)]
    planted = [" ".join(w + "#" * (k % 6 == 0) for k, w in enumerate(text(90))), " ".join(text(3000)), " ".join(w * 2 for w in text(90))]
    rows += [(1000 + i, t, "en", "a") for i, t in enumerate(planted)]
    kept = {r.doc_id: r.kept for r in outliers.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(kept[i] for i in range(200)) and not any(kept[1000 + i] for i in range(3))


def test_small_groups_are_judged(spark):
    rng = np.random.default_rng(6)
    words = [f"{'abcdefgh'[i % 8]}{i}" for i in range(400)]
    text = lambda end="": " ".join(w + end for w in rng.choice(words, rng.integers(60, 120), replace=False))
    groups = [("en", f"s{i % 20}") for i in range(200)] + [(f"l{i % 15}", "one") for i in range(150)] + [(f"m{i}", f"t{i}") for i in range(30)] + [(None, None)] * 3
    rows = [(i, text(), *g) for i, g in enumerate(groups)]
    rows += [(1000 + i, text("###$$$"), *g) for i, g in enumerate([("en", "s0"), ("l0", "one"), ("m0", "t0"), (None, None)])]
    found = {r.doc_id: r for r in outliers.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(r.distance is not None for r in found.values())
    assert all(found[i].kept for i in range(len(groups))) and not any(found[1000 + i].kept for i in range(4))
    few = outliers.quality(spark.createDataFrame(rows[:3], "doc_id long, text string, lang string, source string")).collect()
    assert all(r.kept and r.distance is not None for r in few)


def test_licence_families(docs, texts):
    from quirelight.llm import licenses

    model = licenses.Classifier([])
    assert model.held_out_accuracy > 0.95
    for t, family in (("Licensed under CC BY-NC 4.0.", "cc-by-nc"), ("This work is licensed under the GNU General Public License, version 3.", "gpl"), ("the license of the driver is under review", "unknown"), ("a plain sentence about the weather today", "unknown")):
        assert model.classify(licenses.word_list(t))[0] == family
    marks = {"CC BY-NC 4.0": "cc-by-nc", "GNU General Public": "gpl", "Apache License": "apache", "MIT License": "mit"}
    for r in licenses.scan(docs).collect():
        assert {f for m, f in marks.items() if m in (texts[r.doc_id] or "")} <= set(r.families)


def test_licences_line_by_line(docs, texts):
    """The paragraphs found are those that the classifier names when it is given every line and window; none in prose."""
    from quirelight.llm import licenses

    rows = {r.doc_id: r for r in licenses.scan(docs).collect()}
    marks = re.compile("licen|GPL|SPDX|CC BY|CC0|All rights reserved|Permission|Redistribution|warrant", re.IGNORECASE)
    false = sum(bool(r.families) and not marks.search(texts[i] or "") for i, r in rows.items())
    assert false == 0
    model = licenses.Classifier([])
    for i, text in list(texts.items())[:120]:
        want = set()
        for line in (text or "").split("\n"):
            found = licenses.word_list(line)
            windows = [found] if len(found) <= licenses.WINDOW else [found[k : k + licenses.WINDOW] for k in range(0, len(found) - licenses.WINDOW // 2, licenses.WINDOW // 2)]
            want |= {model.classify(w)[0] for w in windows if len(w) > 2} - {licenses.UNKNOWN}
        assert want <= set(rows[i].families)


def test_licences_within_lines(spark):
    from quirelight.llm import licenses

    around = "We went down to the river in the morning and looked at the boats which the men had left under the trees for the season "
    notices = {"apache": "Licensed under the Apache License, Version 2.0.", "mit": "Released under the MIT License.", "gpl": "Licensed under the GPL version 3.", "cc-by-nc": "Licensed under CC BY-NC 4.0."}
    rows = [(k, around * n + t + " " + around * n) for n in (1, 5) for k, t in enumerate(notices.values(), 10 * n)]
    rows += [(100, around + notices["mit"] + " " + around + notices["apache"] + " " + around)]
    plain = ["The album was released under the label of the band", "studied under the MIT professor of the year", "SPDX-License-Identifier: Zlib", "use of the license and all the rights that you may have"]
    rows += [(200 + k, around + t + " " + around) for k, t in enumerate(plain)]
    found = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for n in (1, 5):
        assert [found[10 * n + k].families for k in range(len(notices))] == [[f] for f in notices]
    assert [x.family for x in found[100].found] == ["mit", "apache"] and found[100].n_paragraphs == 2
    assert not any(found[200 + k].families for k in range(len(plain)))


def test_pipeline(spark, docs, texts):
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, corpus_pipeline.stored(stage(spark, kept, SF), f"test-{name}")
        assert kept.columns == docs.columns
        if name == "ngram_join":
            groups = {r.doc_id: r.class_id for r in ngram_join.join(before).collect()}
            assert sorted(r.doc_id for r in kept.collect()) == sorted(set(groups.values()))
        if name == "decontamination":
            hit = {r.doc_id for r in queries.decontaminate.digest(queries.decontaminate.decontaminate(before, table(spark, SF, "benchmark"))).where("contaminated").collect()}
            assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in before.collect()} - hit
        if name == "source_mix":
            taken = {r.doc_id: r.taken for r in mixing.mix(before).collect()}
            words = collections.Counter()
            for r in kept.collect():
                words[r.doc_id] += len(WORDS.findall(r.text))
            assert {i: n for i, n in taken.items() if n} == dict(words)
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.tokenizer_path())
    last = corpus_pipeline.STAGES[-1][1](spark, kept, SF).orderBy("start").collect()
    ids = lambda r: [*library.encode(r.text or "", add_special_tokens=False).ids, 2]
    # the files keep the order of the mix's rows, partition by partition
    assert [(r.doc_id, r.ids_crc32) for r in last] == [(r.doc_id, zlib.crc32(np.array(ids(r), "<u4").tobytes())) for r in kept.collect()]
