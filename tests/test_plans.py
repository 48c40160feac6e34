"""What a query's plan must not do, so that its work grows with the input and no faster."""

import re

from pyspark.sql import functions as F

from quirelight.operators import features, identity, term_deltas
from quirelight.sources import compounds
from tests.test_title_records import UNIT


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def texts(spark):
    return spark.createDataFrame([("d", 1, "Report of the Board, on water and air"), ("d", 2, "One two three four five six seven eight nine ten eleven twelve thirteen of")], "document_id string, ord int, text string").repartition(2)


def test_phrases_are_cut_within_the_row(spark):
    found = identity.phrases(texts(spark))
    assert "Window" not in plan(found) and "Aggregate" not in plan(found)
    got = sorted((r.ord, r.chunk, r.island, r.part, " ".join(r.words)) for r in found.collect())
    assert [g[-1] for g in got if g[0] == 2] == ["One two three four five six seven eight nine ten eleven twelve", "thirteen"]


def test_presentability_strips_a_text_once(spark):
    assert plan(identity.presentability(texts(spark)).select("presentability")).count("(?U)^") == 1


def test_edges_and_ranks_shuffle_words_only(spark):
    for found in (identity.word_edges(texts(spark)), identity.textrank(texts(spark))):
        assert physical(found).count("Exchange hashpartitioning") == 1
    one = spark.createDataFrame([("d", 1, "water air water fire"), ("d", 2, "alone"), ("e", 1, "of"), (None, 1, "water air")], "document_id string, ord int, text string")
    got = {tuple(r) for r in identity.word_edges(one).collect()}
    near = {("water", "air"), ("water", "fire"), ("air", "fire")}
    assert got == {("d", a, b) for a, b in near | {(b, a) for a, b in near} | {(w, w) for w in ("water", "air", "fire", "alone")}} | {(None, a, b) for a in ("water", "air") for b in ("water", "air")}
    assert {r.word for r in identity.textrank(one).where("document_id = 'd'").collect()} == {"water", "air", "fire", "alone"}


def test_a_matrix_makes_units_once(spark):
    units = spark.createDataFrame([], UNIT)
    assert "Join" not in plan(features.matrix(units))


def test_places_of_pages_are_counted_without_texts(spark):
    docs = spark.createDataFrame([(1, "src1", "en", "a"), (1, "src1", "en", "a"), (None, "src1", "en", "b"), (2, "src1", None, "c"), (2, "src2", "en", "d"), (3, None, "en", "e")], "doc_id long, source string, lang string, text string")
    rows = compounds.doc_pages(docs).orderBy("document_id", "page")
    assert [(r.document_id, r.page, r.k, r.n, r.text) for r in rows.collect()] == [("src1", 1, 1, 1, "c"), ("src1", 2, 1, 3, "b"), ("src1", 3, 2, 3, "a"), ("src1", 4, 3, 3, "a"), ("src2", 1, 1, 1, "d")]
    windows = [line for line in plan(compounds.doc_pages(docs).select("page", F.length("text"))).splitlines() if "Window" in line and "[source" in line]
    assert windows and not any("text" in line for line in windows)


def shuffled_by(df) -> list[set[str]]:
    """The columns that each exchange deals by."""
    return [set(re.findall(r"(\w+)#", keys)) for keys in re.findall(r"Exchange hashpartitioning\((.*?)\), ", physical(df))]


def stacked(spark):
    rows = [("d", 1, k, text, 72.0, 100.0 + 16 * k, 90.0, 12.0, 12.0, False) for k, text in enumerate(["Notice of the", "hearing held", "in open court", "word " * 15 + "end"])]
    rows += [("e", 1, 0, "Notice of the hearing", 72.0, 100.0, 90.0, 12.0, 12.0, False)]
    names = "document_id string, page int, ord int, text string, x double, y double, width double, height double, font_size double, bold boolean"
    return spark.createDataFrame(rows, names).withColumn("page_height", F.lit(792.0))


def test_candidates_meet_by_document_alone(spark):
    """A word, a phrase or a unit that is dealt by more than its document takes its text along once for each."""
    units = stacked(spark)
    table, summary = identity.thaw(spark, None)
    found = identity.phrase_scores(identity.candidates(units), identity.word_scores(units, table, summary))
    assert all(keys == {"document_id"} for keys in shuffled_by(identity.candidates(units))) and "Union" not in plan(found)
    assert all(keys <= {"document_id", "term"} for keys in shuffled_by(found))
    chains = {(r.text, tuple(r.ords)) for r in identity.chains(units).collect()}
    assert chains == {("Notice of the - hearing held", (0, 1)), ("hearing held - in open court", (1, 2)), ("Notice of the - hearing held - in open court", (0, 1, 2))}
    assert {(r.page, r.a, r.b) for r in identity.phrase_edges(units).collect()} == {(1, 0, 1), (1, 1, 2), (1, 2, 3)}
    got = {(r.document_id, r.key): r for r in found.collect()}
    assert got["d", "notice of the hearing held in open court"].y == 100.0 and got["d", "hearing held in open court"].sources == ["composed"]
    assert {k for d, k in got if d == "e"} == {"notice of the hearing"} and all(0 <= r[c] <= 1 for r in got.values() for c in ("rake", "bm25", "textrank"))


def test_ablation_shuffles_a_candidate_once(spark):
    units = stacked(spark)
    scores = identity.fused(units, *identity.thaw(spark, None))
    truth = spark.createDataFrame([("d", "Notice of the hearing held in open court"), ("e", "Another thing")], "document_id string, title string")
    found = identity.ablation(scores, truth)
    lines = physical(found).splitlines()
    masks = [i for i, line in enumerate(lines) if "Generate inline(" in line]
    assert masks and not any("Exchange hashpartitioning(document_id" in line for line in lines[: masks[0]])
    rows = {r.disabled: r for r in found.collect()}
    assert set(rows) == {"none", *identity.SOURCES} and all(r.documents == 2 for r in rows.values()) and rows["none"].top3 == 0.5


PROSE = ["The Kelvin scale, of \u212a and \u0130stanbul; 12th of May 2020 (notes) - it\u2019s the rivers\u2019 \u2018own\u2019 \u03a3\u03a3", "one two three four five six seven eight nine ten eleven twelve thirteen of the", "tab\there\x1cand\x85 'quoted' word\u2019\u2028 of a", "Report of the Board, on water and air", "", "of the", "Stra\u00dfe a b of water - air / fire | water.air"]


def test_words_are_scored_where_candidates_are(spark, monkeypatch):
    """Words that are rows, here of phrases, of terms and of those in a large term table, cost more than all else; what is
    cut within a document's row must be the same."""
    rows = [("d", i, t) for i, t in enumerate(PROSE)] + [("e", 1, PROSE[3]), ("e", 2, None)]
    texts = spark.createDataFrame(rows, "document_id string, ord int, text string")
    table = spark.createDataFrame([("water", 2, 0.5), ("board", 1, 1.25)], "term string, df long, idf double")
    summary = spark.createDataFrame([(3, 7.5, 2.0, 2.0, "v")], "documents long, avgdl double, default_idf double, most double, version string")
    words = identity.word_scores(texts, table, summary)
    assert "Generate" not in plan(words.docs) and "Window" not in plan(words.docs) and "Join" not in plan(words.docs)
    asked = [identity.rake_words(identity.phrases(texts)), identity.bm25_words(texts, table, summary), identity.textrank(texts)]
    for r in words.docs.collect():
        got = identity._words_of(r.texts, None, (words.idf, words.avgdl, words.most))
        for scores, rows in zip(got, asked, strict=True):
            assert scores == {x.word: x.score for x in rows.where(F.col("document_id") == r.document_id).collect()}
    phrases = {(r.ord, tuple(w.lower() for w in r.words)) for r in identity.phrases(texts.where("document_id = 'd'")).collect()}
    assert phrases == {(i, tuple(w)) for i, t in enumerate(PROSE) for w in identity.lower_phrases(t)}
    units = stacked(spark)
    scored = lambda: {tuple(r) for r in identity.phrase_scores(identity.candidates(units), identity.word_scores(units, table, summary)).select("document_id", "key", "rake", "bm25", "textrank").collect()}
    sent = scored()
    monkeypatch.setattr(identity, "SENT_TERMS", 1)
    assert identity.word_scores(units, table, summary).idf is None and scored() == sent


def test_ablation_elects_once(spark):
    """Documents are elected once for all masks, not again for the full score, and only counts are shuffled after."""
    kind = "document_id string, page int, y double, x double, key string, text string, " + ", ".join(f"{c} double" for c in identity.SOURCES) + ", furniture boolean, noise boolean, not_first_page boolean"
    one = lambda d, y, text, typography: (d, 1, y, 0.0, text.lower(), text, *[typography if c == "typography" else 0.1 for c in identity.SOURCES], False, False, None)
    rows = [one("d", 1.0, "Rivers and lakes", 1.0), one("d", 2.0, "Lakes and rivers", 0.9), one("d", 3.0, "Harvest of barley", 0.8), one("e", 1.0, "Water mills", None), one("f", 1.0, "No title here", 1.0)]
    truth = spark.createDataFrame([("d", "Harvest of barley"), ("d", "Rivers lakes"), ("e", "Wind mills"), ("g", "Nothing found")], "document_id string, title string")
    found = identity.ablation(spark.createDataFrame(rows, kind), truth)
    assert sum("MapInArrow" in line for line in physical(found).splitlines()) == 1 and "posexplode" not in plan(found)
    got = {r.disabled: r for r in found.collect()}
    assert set(got) == {"none", *identity.SOURCES} and all((r.documents, r.top1, r.top3) == (2, 0.5, 0.5) for r in got.values())
    assert identity.ablation(spark.createDataFrame(rows, kind), truth.where("document_id = 'g'")).collect() == []


def test_term_deltas_count_where_texts_are(spark, tmp_path):
    rows = [("a", "river levels river"), ("a", "river bank"), ("b", "river"), ("c", None), (None, "lost river"), (None, "lost")]
    corpus = spark.createDataFrame(rows, "document_id string, text string").repartition(3)
    lines = physical(term_deltas.counted(corpus)).splitlines()
    dealt = [line for line in lines if "Exchange hashpartitioning" in line]
    assert len(dealt) == 1 and any("partial_sum" in line for line in lines[lines.index(dealt[0]) :])
    assert [r.document_id for r in term_deltas.repeated(corpus).collect()] == ["a"]
    name = term_deltas.add_delta(corpus, str(tmp_path))
    found = {r.term: r.df for r in spark.read.parquet(str(tmp_path / f"terms/delta={name}")).collect()}
    assert found == {"river": 2, "levels": 1, "bank": 1, "lost": 0}
    lengths = {r.document_id: r.length for r in spark.read.parquet(str(tmp_path / f"documents/delta={name}")).collect()}
    assert lengths == {"a": 5, "b": 1, "c": 0, None: 3}
