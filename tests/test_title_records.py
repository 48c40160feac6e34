"""Records of titles: contributions that add up, what is excluded and why, documents without a candidate."""

import json

import pytest

from quirelight import cli, contracts
from quirelight.operators import features

UNIT = "document_id string, page int, ord int, text string, x double, y double, width double, height double, font_size double, bold boolean, modality string, page_width double, page_height double, span_ids array<int>"


def unit(document, ord, text, y=300.0, size=10.0, page=1, bold=False, modality="native"):
    return (document, page, ord, text, 72.0, y, 100.0, size, size, bold, modality, 612.0, 792.0, [ord * 10])


@pytest.fixture(scope="module")
def scores(spark):
    body = "plain words run on and on " * 9
    rows = [
        unit("a", 1, "Report On The Levels", 60.0, 20.0, bold=True),
        unit("a", 2, "Case No. CV-1234 of 2001", 200.0),
        unit("a", 3, body, 400.0),
        unit("a", 4, "Page 1 of 2", 780.0, 8.0),
        unit("b", 1, "short"),
        unit("b", 2, body),
        unit("c", 1, "Flat words of one size", 60.0, modality="ocr"),
        unit("c", 2, "Flat words that come after", 500.0, page=2, modality="ocr"),
    ]
    return features.title_scores(features.matrix(spark.createDataFrame(rows, UNIT)))


def test_records(scores):
    found = {r.document_id: r for r in features.title_records(scores).collect()}
    assert set(found) == {"a", "b", "c"}
    a, b, c = found["a"], found["b"], found["c"]
    assert (a.candidate, a.ord, a.span_ids, a.reason, a.units, a.excluded, a.role) == ("Report On The Levels", 1, [10], None, 4, 2, "TITLE")
    assert a.contract_versions == contracts.versions() and [x.ord for x in a.ranking] == [1, 2]
    assert (b.title, b.candidate, b.confidence, b.reason, b.margin, b.contributions) == (None, None, "escalate", "no eligible candidate", None, None)
    for r in (a, c):
        assert abs(sum(x.contribution for x in r.contributions) - r.score) < 1e-9
    assert c.flat and not a.flat
    parts = {x.feature: x for x in c.contributions}  # recognised text has no weight; layout counts for less where sizes are flat
    assert (parts["bold_flag"].value, parts["bold_flag"].weight, parts["bold_flag"].contribution) == (None, 0.6, 0.0)
    assert parts["font_rank"].weight == 0.96 and parts["whitespace_isolation"].weight == 1.2


def test_contributions_of_all_units(scores):
    rows = scores.where("score is not null").withColumn("parts", features.title_contributions(scores)).collect()
    for r in rows:
        assert abs(sum(x.contribution for x in r.parts) - r.score) < 1e-9
    penalties = {(r.document_id, r.ord): [(x.feature, x.value, x.contribution) for x in r.parts if x.contribution < 0] for r in rows}
    assert penalties[("a", 2)][0] == ("identifier", 1.0, -1.6) and penalties[("c", 2)] == [("not_first_page", 1.0, -1.2)] and penalties[("a", 1)] == []


def test_excluded(scores):
    found = {(r.document_id, r.ord): r for r in features.excluded_units(scores).collect()}
    assert {k: r.reasons for k, r in found.items()} == {("a", 3): ["too_many_words"], ("a", 4): ["noise_pattern", "footer_zone"], ("b", 1): ["too_short"], ("b", 2): ["too_many_words"]}
    assert max(len(r.text) for r in found.values()) == 80


def test_without_span_ids_and_empty(spark, scores):
    assert {r.span_ids for r in features.title_records(scores.drop("span_ids")).collect()} == {None}
    none = scores.limit(0)
    assert features.title_records(none).count() == features.excluded_units(none).count() == 0


def test_command(spark, tmp_path):
    rows = [("d", 1, 0, "Report On The Levels", 72.0, 40.0, 200.0, 20.0, 20.0, True), ("d", 1, 1, "plain words run on and on " * 9, 72.0, 400.0, 400.0, 10.0, 10.0, False), ("e", 1, 0, "short", 72.0, 40.0, 200.0, 20.0, 20.0, True)]
    spark.createDataFrame(rows, "document_id string, page int, ord int, text string, x double, y double, width double, height double, font_size double, bold boolean").write.parquet(str(tmp_path / "spans"))
    assert cli.main(["title-records", "--input", str(tmp_path / "spans"), "--output", str(tmp_path / "out")]) == 0
    out = {r["document_id"]: r for f in (tmp_path / "out").glob("part-*") for r in map(json.loads, f.read_text().splitlines())}
    assert out["d"]["candidate"] == "Report On The Levels" and out["e"]["reason"] == "no eligible candidate"
