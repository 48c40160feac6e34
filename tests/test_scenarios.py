"""Compounds of four scenarios: their plan, draws, pages and seams, and the evaluation over them."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from quirelight.operators import segment
from quirelight.sources import scenarios

PAGE = "document_id string, page int, raw_text string, width double, height double, rotation int, image_count int, fonts array<string>"


def sources(n=150, sizes=(1, 2, 7)):
    """Documents of three producers, every tenth of them scanned."""
    fonts = (["ABCDEF+Serif,Bold"], ["Sans"], ["Mono", "Sans"])
    for i in range(n):
        scan = i % 10 == 3
        for p in range(1, sizes[i % len(sizes)] + 1):
            yield (f"s{i}", p, "" if scan else f"text {i} page {p}", 612.0, 792.0, 0, int(scan), [] if scan else fonts[i % 3])


@pytest.fixture(scope="module")
def made(spark):
    pages = scenarios.distinct_pages(spark.createDataFrame(list(sources()), PAGE))
    found = scenarios.parts(pages, 5, long=7, rounds=1).cache()
    compounds = defaultdict(list)
    for r in found.collect():
        compounds[r.document_id].append(r)
    for rows in compounds.values():
        rows.sort(key=lambda r: r.slot)
    texts = defaultdict(dict)
    rows = scenarios.compound_pages(found, pages).collect()
    for r in rows:
        texts[r.document_id][r.page] = r
    assert len(rows) == sum(map(len, texts.values()))
    return found, compounds, texts


def test_plan_and_draws(made):
    _, compounds, texts = made
    assert Counter(rows[0].scenario for rows in compounds.values()) == scenarios.PLAN
    for name, rows in compounds.items():
        least, most = {"exhibit_binder": (3, 5), "bates_production": (3, 4), "mixed_intake": (4, 4), "single_document": (1, 1)}[rows[0].scenario]
        assert least <= len(rows) <= most and [r.slot for r in rows] == list(range(len(rows)))
        assert len({r.source_id for r in rows}) == len(rows)
        assert sorted(texts[name]) == list(range(1, rows[-1].end_page + 1))
    binders = [r.source_id for rows in compounds.values() for r in rows if r.scenario == "exhibit_binder"]
    assert max(Counter(binders).values()) <= 2  # 10 compounds of up to five places each, from 150, 44 numbers of five places
    kinds = Counter(r.kind for rows in compounds.values() for r in rows if r.scenario == "mixed_intake")
    assert kinds == {"native_filing": 24, "landscape_plate": 12, "scanned_exhibit": 12}
    assert all(r.pages == 7 for rows in compounds.values() for r in rows if r.kind == "single")
    for rows in compounds.values():
        if rows[0].scenario == "bates_production":  # one producer: the number's remainder names it
            assert rows[0].kind == "production_same_producer" and len({int(r.source_id[1:]) % 3 for r in rows}) == 1


def test_pages_and_seams(made):
    found, compounds, texts = made
    seams = defaultdict(dict)
    for r in scenarios.seams(found).collect():
        seams[r.document_id][r.before_page] = r
    for name, rows in compounds.items():
        pages, scenario = texts[name], rows[0].scenario
        if scenario == "exhibit_binder":
            assert pages[1].raw_text == scenarios.COVER and rows[0].start_page == 3
            assert [pages[r.start_page - 1].raw_text for r in rows] == [f"EXHIBIT {c}" for c in "ABCDE"[: len(rows)]]
            assert sorted(seams[name]) == [r.start_page - 1 for r in rows]
            assert {s.difficulty for s in seams[name].values()} == {"easy"}
        else:
            assert sorted(seams[name]) == [r.start_page for r in rows[1:]]
        if scenario == "bates_production":
            stamps = [pages[p].raw_text.split("\n")[-1] for p in sorted(pages)]
            assert stamps == [f"{rows[0].stamp_prefix}{rows[0].stamp_first + k:06}" for k in range(len(stamps))]
            assert {s.difficulty for s in seams[name].values()} == {"hard"}
        for r in rows:
            assert all((pages[p].rotation == 90) == (r.kind == "landscape_plate") for p in range(r.start_page, r.end_page + 1))
            if r.kind != "scanned_exhibit" and scenario != "bates_production" and int(r.source_id[1:]) % 10 != 3:
                assert [pages[p].raw_text for p in range(r.start_page, r.end_page + 1)] == [f"text {r.source_id[1:]} page {k}" for k in range(1, r.pages + 1)]
        if scenario == "single_document":
            assert not seams[name]


def test_seeds_and_growth(spark, made):
    pages = scenarios.distinct_pages(spark.createDataFrame(list(sources()), PAGE)).repartition(7)
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(scenarios.parts(pages, 5, long=7, rounds=1)) == rows(made[0])
    assert rows(scenarios.parts(pages, 6, long=7, rounds=1)) != rows(made[0])
    grown = scenarios.parts(pages, 5, long=7)  # 150 documents: two rounds, the first of which is the same
    assert grown.select("document_id").distinct().count() == 2 * sum(scenarios.PLAN.values())
    assert set(rows(made[0])) <= set(rows(grown))


def test_most_pages_and_odd_tables(spark):
    long = list(sources(20, sizes=(130,)))
    found = scenarios.parts(scenarios.distinct_pages(spark.createDataFrame(long, PAGE)), 1, rounds=1)
    assert {(r.scenario, r.pages) for r in found.collect()} == set(scenarios.MOST_PAGES.items())
    # no producer, no scan, no long document; nulls, a gap, a repeated page and a column of a clashing name
    odd = [("a", 1, None, None, None, None, None, None), ("a", 5, "x", 612.0, 792.0, 0, 0, None), ("a", 5, "x", 612.0, 792.0, 0, 0, None), (None, 1, "y", 1.0, 1.0, 0, 0, []), ("b", None, "z", 1.0, 1.0, 0, 0, [])]
    pages = scenarios.distinct_pages(spark.createDataFrame(odd, PAGE).withColumn("source_id", F.lit("clash")).withColumn("pool", F.lit(1)))
    assert [(r.page, r.raw_text) for r in pages.orderBy("page").collect()] == [(1, ""), (2, "x")]
    found = scenarios.parts(pages, 1)
    assert {(r.source_id, r.pages) for r in found.collect()} == {("a", 2)}
    for r in scenarios.compound_pages(found, pages).where("page = 1 and document_id like '%bates%'").collect():
        assert r.raw_text == next(f"{p.stamp_prefix}{p.stamp_first:06}" for p in found.collect() if p.document_id == r.document_id)
    empty = scenarios.distinct_pages(spark.createDataFrame([], PAGE))
    found = scenarios.parts(empty, 1)
    assert found.count() == scenarios.compound_pages(found, empty).count() == scenarios.seams(found).count() == 0


def test_evaluation_by_document(spark):
    at = lambda *rows: spark.createDataFrame(rows, "document_id string, before_page int")
    truth = spark.createDataFrame([("a", 2, "easy"), ("a", 5, "hard"), ("a", 9, "hard"), ("b", 4, "easy")], "document_id string, before_page int, difficulty string")
    found = segment.outcomes(at(("a", 2), ("a", 3), ("c", 7)), at(("a", 5), ("a", 6), ("a", 2)), truth)
    documents = spark.createDataFrame([(d, "one" if d < "c" else "none") for d in "abcd"], "document_id string, scenario string")
    by_document = segment.evaluation_by_document(found, documents)
    assert {tuple(map(str, r)) for r in by_document.collect()} == {
        ("a", "one", "3", "1", "1", "2", "[5]", "[9]"),
        ("b", "one", "1", "0", "0", "1", "[]", "[4]"),
        ("c", "none", "0", "0", "1", "0", "[]", "[]"),
        ("d", "none", "0", "0", "0", "0", "[]", "[]"),
    }
    assert {tuple(r) for r in segment.evaluation_by_difficulty(found, truth).collect()} == {("easy", 2, 1, 0, 0.5, 0.5), ("hard", 2, 0, 1, 0.0, 0.5)}
    assert {tuple(r) for r in segment.evaluation_by_scenario(by_document).collect()} == {("one", 2, 1, 1, 3, 0.25), ("none", 2, 0, 1, 0, None)}
