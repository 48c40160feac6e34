"""Hand cases and properties of the engine's operators."""

import datetime
import hashlib
import itertools
import os
import random
import re
import tempfile
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from quirelight import cli, contracts
from quirelight.functions import text as T
from quirelight.operators import assemble, census, evidence, features, identity, outline, pleading, roles, segment, term_deltas, validation
from quirelight.plans import sql_labels
from quirelight.sources import compounds, files, html
from quirelight.sources import pdf as pdf_source
from quirelight.streaming import census_stream, intake
from quirelight.streaming import seams as stream_seams

SF = "/root/testdata/sf0.001"
PAGE = "document_id string, page int, raw_text string, width double, height double, rotation int, image_count int, fonts array<string>"


def pages(spark, texts, **over):
    rows = [("d", i, t, over.get("width", 612.0), 792.0, 0, 0, over.get("fonts", ["Arial"])) for i, t in enumerate(texts, 1)]
    return spark.createDataFrame(rows, PAGE)


def prose(spark, names):
    return spark.createDataFrame([(n,) for n in names], "text string")


def test_stamp_series_rules(spark):
    three = census.measure(pages(spark, ["x ABC0001", "y ABC0002", "z ABC0003"]))
    assert [(r.prefix, r.first, r.last) for r in census.stamp_series(three).collect()] == [("ABC", 1, 3)]
    assert census.stamp_series(census.measure(pages(spark, ["ABC0001", "ABC0002"]))).count() == 0  # two pages
    assert census.stamp_series(census.measure(pages(spark, ["ABC0001", "ABC0002", "ABC00003"]))).count() == 0  # two widths
    rising = [f"ABC{n:04}" for n in (1, 2, 3, 4, 5, 2)]  # four of five pairs rise: exactly the least share
    assert census.stamp_series(census.measure(pages(spark, rising))).count() == 1
    assert census.measure(pages(spark, ["IL 60439"])).head().stamp_prefix is None


def test_page_measurements(spark):
    r = census.measure(pages(spark, ["  Head 12 \n\n body text continues \n tail 7 "])).head()
    assert (r.header_sig, r.footer_sig, r.word_count, r.line_count, r.modality) == ("head ##", "tail #", 7, 3, "native")
    assert r.ends_mid_sentence and not r.starts_lowercase
    empty = census.measure(pages(spark, ["", None])).collect()
    assert all(x.is_blank and x.modality == "scanned" and x.word_count == 0 and not x.is_slip_sheet for x in empty)
    spacer = census.measure(pages(spark, ["This page intentionally left blank"])).head()
    assert spacer.is_spacer and not spacer.is_slip_sheet
    assert census.measure(pages(spark, ["Exhibit A"])).head().is_slip_sheet
    assert census.measure(pages(spark, ["Page 3 / 12 of it"])).head().label_total == 12


def test_font_and_size_classes(spark):
    df = spark.createDataFrame([("ABCDEF+Courier New,Bold",), ("Times-Roman",), ("Arial-BoldItalic",), ("Symbol",)], "f string")
    assert [r[0] for r in df.select(T.font_class(T.font_name(F.col("f")))).collect()] == ["mono", "serif", "sans", "other"]
    sizes = spark.createDataFrame([(596.2, 778.6), (1008.0, 612.0), (595.0, 842.0), (100.0, 100.0)], "w double, h double")
    assert [r[0] for r in sizes.select(T.size_class(F.col("w"), F.col("h"))).collect()] == ["Letter", "Legal", "A4", "other"]


def test_decisions_by_policy(spark):
    text = "Alpha beta gamma delta. " * 10
    two = pages(spark, [text]).unionByName(pages(spark, ["", text.replace("Alpha", "Omega")], fonts=["Courier"]).where("page = 2"))
    scored = segment.scored(segment.signals(segment.seams(census.census(two))))
    row = scored.head()
    assert [s.name for s in row.signals] == ["font_family_change"] and (row.score, row.strong) == (1.0, True)
    assert {p: segment.decided(scored, p).head().is_cut for p in ("balanced", "aggressive")} == {"balanced": False, "aggressive": True}
    assert segment.decided(scored).head().is_candidate


def test_slip_to_slip_does_not_hold_back(spark):
    names = [{s.name for s in r.signals} for r in segment.signals(segment.seams(census.census(pages(spark, ["Exhibit A", "Exhibit B", "long text " * 40])))).orderBy("before_page").collect()]
    assert "slip_sheet_ahead" in names[0] and "slip_sheet_behind" not in names[0]
    assert "slip_sheet_behind" in names[1]


def test_one_page_insert_is_absorbed(spark):
    schema = "document_id string, segment_index int, start_page int, end_page int, page_count int"
    found = spark.createDataFrame([("d", 1, 1, 2, 2), ("d", 2, 3, 3, 1), ("d", 3, 4, 6, 3)], schema)
    c = census.census(pages(spark, ["some text here"] * 6))
    assert [(r.start_page, r.end_page) for r in segment.rejoined(found, c).collect()] == [(1, 6)]


def test_rejoined_against_plain_loop(spark):
    rng = random.Random(4)
    rows, want, all_pages = [], {}, []
    for d in range(30):
        sizes = [rng.choice([1, 1, 2, 3, 4]) for _ in range(rng.randrange(1, 8))]
        fonts = [rng.choice("AB") for _ in range(sum(sizes))]
        at, segs = 1, []
        for n in sizes:
            segs.append([at, at + n - 1])
            at += n
        rows += [(f"d{d}", i, a, b, b - a + 1) for i, (a, b) in enumerate(segs, 1)]
        all_pages += [(f"d{d}", p, f"{chr(96 + p)} text", 612.0, 792.0, 0, 0, [f]) for p, f in enumerate(fonts, 1)]
        changed = True
        while changed:  # leftmost first, until nothing changes
            changed = False
            for i in range(1, len(segs) - 1):
                a, b = segs[i]
                if b - a + 1 <= 2 and fonts[a - 2] == fonts[b]:
                    segs[i - 1][1] = segs[i + 1][1]
                    del segs[i : i + 2]
                    changed = True
                    break
        want[f"d{d}"] = [tuple(s) for s in segs]
    found = spark.createDataFrame(rows, "document_id string, segment_index int, start_page int, end_page int, page_count int")
    got = {}
    for r in segment.rejoined(found, census.measure(spark.createDataFrame(all_pages, PAGE))).orderBy("document_id", "segment_index").collect():
        got.setdefault(r.document_id, []).append((r.start_page, r.end_page))
    assert got == want


def test_phrases(spark):
    texts = spark.createDataFrame([("d", 0, "Motion to Compel Discovery Responses"), ("d", 1, "the Treaty of Peace was signed, of the North")], "document_id string, ord int, text string")
    got = {(r.ord, " ".join(r.words)) for r in identity.phrases(texts).collect()}
    assert got == {(0, "Motion to Compel Discovery Responses"), (1, "Treaty of Peace"), (1, "signed"), (1, "North")}


def test_levels(spark):
    units = spark.createDataFrame([("d", "A seventeen-charh", 20.0), ("d", "x" * 2000, 10.0), ("e", "STAMPED8", 30.0), ("e", "x" * 2000, 10.0)], "document_id string, text string, font_size double")
    got = {(r.document_id, r["size"]): r.level for r in features.levels(units).collect()}
    assert got == {("d", 20.0): "h1", ("d", 10.0): "body", ("e", 30.0): "outlier", ("e", 10.0): "body"}


def test_presentability_prefers_titles(spark):
    rows = {r.text: r.presentability for r in identity.presentability(prose(spark, ["Annual Report on River Levels", "the levels of the rivers were measured each day and it was found that they had risen by some more than was said before.", "", "aaaaaaa (b"])).collect()}
    title, sentence, empty, broken = rows.values()
    assert title - sentence > 0.3 and empty == 0.0 and broken < title


def test_short_text_is_only_too_short(spark):
    units = spark.createDataFrame([("d", 1, 0, "1234567", 0.0, 760.0, 10.0, 10.0, 10.0, False, 612.0, 792.0)], "document_id string, page int, ord int, text string, x double, y double, width double, height double, font_size double, bold boolean, page_width double, page_height double")
    row = features.title_scores(features.matrix(units)).head()
    assert row.reasons == ["too_short"] and row.score is None
    assert row.whitespace_isolation == 0.5 and row.isolation_imputed


def test_unmeasured_boldness_adds_nothing(spark):
    units = spark.createDataFrame([("d", 1, 0, "A title of words", 100.0, 40.0, 200.0, 10.0, 10.0, None, 612.0, 792.0)], "document_id string, page int, ord int, text string, x double, y double, width double, height double, font_size double, bold boolean, page_width double, page_height double")
    row = features.title_scores(features.matrix(units)).head()
    assert row.bold_flag is None and row.score > 0


def test_lines_follow_their_anchor(spark):
    schema = "document_id string, page int, ord int, text string, x double, y double, width double, height double, font_size double, bold boolean"
    rows = [("d", 1, 0, "left ", 10.0, 100.0, 30.0, 10.0, 10.0, False), ("d", 1, 1, "right", 42.0, 103.0, 30.0, 10.0, 10.0, False), ("d", 1, 2, "far", 200.0, 101.0, 30.0, 10.0, 10.0, False), ("d", 1, 3, "next", 10.0, 112.0, 30.0, 10.0, 10.0, True)]
    got = [r.text for r in assemble.lines(spark.createDataFrame(rows, schema)).orderBy("line").collect()]
    assert got == ["left right", "far", "next"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_labels_use_words_of_the_page(spark):
    raw = spark.read.parquet(f"{SF}/pages.parquet")
    spans = html.spans(raw)
    table = identity.idf(spans.select("document_id", "text"))
    found = identity.labels(identity.fused(assemble.units(spans), table, identity.idf_summary(spans.select("document_id", "text"), table)))
    own = {r.document_id: set(re.findall(r"\w+", r.t.lower())) for r in spans.groupBy("document_id").agg(F.array_join(F.collect_list("text"), " ").alias("t")).collect()}
    rows = found.collect()
    assert rows and all(set(re.findall(r"\w+", r.text.lower())) <= own[r.document_id] for r in rows)
    assert all(r["rank"] in (1, 2, 3) for r in rows)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_partitions_do_not_change_results(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    run = lambda: sorted(map(str, segment.decided(segment.scored(segment.signals(segment.seams(census.census(compounds.stamped_pages(docs)))))).select("document_id", "before_page", "score", "change_score", "is_cut").collect()))
    before = run()
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        assert run() == before
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


SPAN = "document_id string, page int, ord int, text string, x double, y double, width double, height double, font_size double, bold boolean"


def test_columns_are_read_one_after_the_other(spark):
    rows = [("d", 1, 2 * k + c, f"{side} {k}", x, 100.0 + 12 * k, 40.0, 10.0, 10.0, False) for k in range(4) for c, (side, x) in enumerate((("left", 72.0), ("right", 320.0)))]
    found = assemble.units(spark.createDataFrame(rows, SPAN)).orderBy("ord").collect()
    assert [u.text for u in found] == ["left 0 left 1 left 2 left 3", "right 0 right 1 right 2 right 3"]
    assert [(u.x, u.y, u.width, u.line_count, u.span_ids, u.median_gap) for u in found] == [(72.0, 100.0, 40.0, 4, [0, 2, 4, 6], 12.0), (320.0, 100.0, 40.0, 4, [1, 3, 5, 7], 12.0)]


def test_unit_gaps_are_from_top_to_top(spark):
    tops = [0, 12, 24, 42, 54, 66]  # median 12: 18 is within 1.6 of it for tall lines too
    rows = [("d", 1, k, f"line {k}", 72.0, float(y), 40.0, 11.0, 10.0, False) for k, y in enumerate(tops)]
    assert [u.line_count for u in assemble.units(spark.createDataFrame(rows, SPAN)).collect()] == [6]
    rows = [(*r[:5], r[5] + 8 * (r[2] > 2), *r[6:]) for r in rows]
    assert sorted(u.line_count for u in assemble.units(spark.createDataFrame(rows, SPAN)).collect()) == [3, 3]


def test_recognised_text_has_no_weight(spark):
    words = spark.createDataFrame([("d", 1, 1, 1, 1, "World", 400, 100, 100, 50), ("d", 1, 1, 1, 1, "Hello", 100, 110, 200, 50)], "document_id string, page int, block int, par int, line int, text string, left int, top int, width int, height int")
    lines = pdf_source.ocr_lines(words).withColumn("ord", F.lit(0))
    (u,) = assemble.units(lines).collect()
    assert (u.text, u.bold, u.modality) == ("Hello World", None, "ocr")
    assert features.matrix(assemble.units(lines)).head().bold_flag is None


def test_lines_of_tabs_are_blank(spark):
    r = census.measure(pages(spark, ["\tHead line\t\n\t\t\nbody"])).head()
    assert (r.header_sig, r.line_count) == ("head line", 2)


def test_short_candidates_and_bold(spark):
    rows = [("d", 1, 0, "Short", 72.0, 40.0, 40.0, 12.0, 12.0, True), ("d", 1, 1, "A bold line of body text", 72.0, 300.0, 90.0, 10.0, 10.0, True), ("d", 1, 2, "plain words run on and on " * 9, 72.0, 500.0, 90.0, 10.0, 10.0, False)]
    units = assemble.units(spark.createDataFrame(rows, SPAN))
    found = {r.text: r for r in identity.fused(units, *identity.thaw(spark, None)).collect()}
    assert "Short" not in found and found["A bold line of body text"].typography == 0.32
    best = identity.elected(identity.fused(units, *identity.thaw(spark, None))).head()
    assert {x.text[:5] for x in best.best} == {"A bol", "plain"} and best.confidence in ("review", "escalate")
    assert abs(sum(x.contribution for x in best.best[0].contributions) - best.best[0].score) < 1e-6


def test_terms_are_frozen(spark, tmp_path):
    corpus = spark.createDataFrame([("a", "river levels report"), ("b", "river of stones"), ("c", "")], "document_id string, text string")
    identity.freeze(corpus, str(tmp_path / "idf"))
    table, summary = identity.thaw(spark, str(tmp_path / "idf"))
    assert {r.term: r.df for r in table.collect()} == {"river": 2, "levels": 1, "report": 1, "stones": 1}
    s = summary.head()
    assert (s.documents, s.avgdl) == (3, 2.0) and s.version.startswith("IDF-3docs-")


def test_titles_by_segment(spark):
    units = spark.createDataFrame([("d", 1, 1, "Cover of the first", 72.0, 40.0), ("d", 3, 2, "Cover of the second", 72.0, 40.0), ("d", 4, 3, "Not a head page", 72.0, 40.0)], "document_id string, page int, ord int, text string, x double, y double")
    units = units.selectExpr("*", "100D AS width", "10D AS height", "10D AS font_size", "false AS bold", "612D AS page_width", "792D AS page_height")
    found = spark.createDataFrame([("d", 1, 1, 2), ("d", 2, 3, 9)], "document_id string, segment_index int, start_page int, end_page int")
    heads = spark.createDataFrame([("d", 1, 1), ("d", 1, 2), ("d", 2, 3)], "document_id string, segment_index int, page int")
    rows = features.matrix(features.by_segment(units, found, heads)).collect()
    assert sorted((r.document_id, r.text, r.page_in_segment) for r in rows) == [("d#1", "Cover of the first", 1), ("d#2", "Cover of the second", 1)]


def test_font_sizes_tip_the_balance(spark):
    two = pages(spark, ["Alpha beta gamma delta. " * 10]).unionByName(pages(spark, ["", "Omega beta gamma delta. " * 10], fonts=["Courier"]).where("page = 2"))
    pairs = segment.seams(census.census(two))
    sizes = spark.createDataFrame([("d", 1, 10.0, 1.0), ("d", 2, 12.0, 1.0)], "document_id string, page int, size double, share double")
    row = segment.decided(segment.refined(pairs, sizes)).head()
    assert [s.name for s in row.signals] == ["font_family_change", "font_size_change"] and row.is_cut and row.refined


def test_reabsorbed_inserts_are_kept(spark):
    schema = "document_id string, segment_index int, start_page int, end_page int, page_count int, opened_by string, score double"
    found = spark.createDataFrame([("d", 1, 1, 2, 2, "document_start", None), ("d", 2, 3, 3, 1, "modality_flip", 1.5), ("d", 3, 4, 6, 3, "modality_flip", 1.6)], schema)
    (r,) = segment.rejoined(found, census.census(pages(spark, ["some text here"] * 6))).collect()
    assert (r.opened_by, [tuple(x) for x in r.reabsorbed]) == ("document_start", [(3, 3, 1.5, "modality_flip")])


def test_contracts(tmp_path):
    assert contracts.verify() == []
    c = contracts.load("segmentation")
    assert set(c["weights"]) == set(segment.CONDITIONS) | {"font_size_change"}
    assert set(c["review_only"]) <= set(c["weights"]) and set(c["policies"]) == {"conservative", "balanced", "aggressive"}
    assert "on" in contracts.load("identity")["connectors"] and "no" in contracts.load("identity")["hard_stopwords"]
    assert cli.main(["policies"]) == 0 and cli.main(["verify"]) == 0


def test_files(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"not a pdf")
    (tmp_path / "b.txt").write_text("x")
    found = files.pdf_files(spark, str(tmp_path)).collect()
    assert [len(r.document_id) for r in found] == [16]
    assert files.expired(files.pdf_files(spark, str(tmp_path)), 3600).count() == 0
    spark.dataSource.register(pdf_source.PdfSource)
    bad = spark.read.format("quirelight_pdf").option("paths", str(tmp_path / "a.pdf")).load().collect()
    assert len(bad) == 1 and bad[0].error
    labels = spark.createDataFrame([("d", "f.pdf", 'A "quoted", title', "pdf_metadata", "high", "no")], files.LABELS)
    files.write_labels(labels, str(tmp_path / "labels"))
    assert files.read_labels(spark, str(tmp_path / "labels")).collect() == labels.collect()
    rows = spark.createDataFrame([("é", 1)], "a string, b int")
    files.write_records(rows, str(tmp_path / "records"))
    (tmp_path / "records" / "broken.json").write_text("{oops\n")
    back = files.read_records(spark, str(tmp_path / "records"), "a string, b int").collect()
    assert sorted((r.a, r.b, r._corrupt_record) for r in back if r.a) == [("é", 1, None)] and sum(r._corrupt_record is not None for r in back) == 1


def test_ocr_lines(spark):
    words = spark.createDataFrame([("d", 1, 1, 1, 1, "World", 400, 100, 100, 50), ("d", 1, 1, 1, 1, "Hello", 100, 110, 200, 50), ("d", 1, 1, 1, 2, " ", 0, 0, 1, 1)], "document_id string, page int, block int, par int, line int, text string, left int, top int, width int, height int")
    (r,) = pdf_source.ocr_lines(words).collect()
    assert (r.text, r.x, r.y, r.width) == ("Hello World", 24.0, 24.0, 96.0) and r.bold is None


class FakePage:
    """What the reader asks of a page."""

    class rect:  # noqa: N801
        width, height = 612.0, 792.0

    rotation = 0

    def __init__(self, *spans):
        self.spans = spans

    def get_text(self, kind=None):
        lines = [{"spans": [{"text": t, "bbox": (72.0, y, 172.0, y + 12.0), "size": 12.0, "font": font, "flags": 0}]} for t, y, font in self.spans]
        return {"blocks": [{"lines": lines}, {"image": b""}]} if kind else "\n".join(t for t, _, _ in self.spans)

    def get_images(self):
        return [1]

    def get_fonts(self):
        return [(0, 0, 0, "Arial")]


def test_pdf_rows(spark, tmp_path):
    page = FakePage(("Title", 40.0, "Arial-Bold"), (" ", 60.0, "Arial"), ("body", 80.0, "Arial"))
    assert list(pdf_source.page_row("d", 1, page)) == [("d", 1, "Title\n \nbody", 612.0, 792.0, 0, 1, ["Arial"], None)]
    rows = spark.createDataFrame(list(pdf_source.span_rows("d", 1, page)), pdf_source.SPANS)
    assert [(u.text, u.bold, u.modality) for u in assemble.units(rows).orderBy("ord").collect()] == [("Title", True, "native"), ("body", False, "native")]
    scanned = list(pdf_source.span_rows("d", 2, FakePage(), lambda p: [("Seen text", 24.0, 30.0, 90.0, 11.0)]))
    (u,) = assemble.units(spark.createDataFrame(scanned, pdf_source.SPANS)).collect()
    assert (u.text, u.bold, u.modality, u.font_size) == ("Seen text", None, "ocr", 11.0)
    (tmp_path / "a.pdf").write_bytes(b"not a pdf")
    (tmp_path / "b.PDF").write_bytes(b"nor this")
    spark.dataSource.register(pdf_source.PdfSource)
    for table in ("pages", "spans"):
        bad = spark.read.format("quirelight_pdf").option("table", table).load(str(tmp_path)).collect()
        assert len(bad) == 2 and all(r.error for r in bad)
    assert [bool(r.error) for r in pdf_source.read_files(files.pdf_files(spark, str(tmp_path)), spans=True).collect()] == [True]


def test_census_of_a_stream(spark, tmp_path):
    pages(spark, ["one page", "Exhibit A"]).write.parquet(str(tmp_path / "in"))
    stream = census_stream(spark.readStream.schema(PAGE).parquet(str(tmp_path / "in")))
    q = stream.select("page", "word_count", "is_slip_sheet").writeStream.format("memory").queryName("censused").outputMode("append").start()
    try:
        q.processAllAvailable()
        assert sorted(tuple(r) for r in spark.table("censused").collect()) == [(1, 2, True), (2, 2, True)]
    finally:
        q.stop()


def test_command_line(spark, tmp_path):
    pages(spark, ["Some text here.", "More text there."]).write.parquet(str(tmp_path / "pages"))
    assert cli.main(["segment", "--input", str(tmp_path / "pages"), "--output", str(tmp_path / "out"), "--validate"]) == 0
    assert cli.main(["census", "--input", str(tmp_path / "pages"), "--output", str(tmp_path / "census")]) == 0


WEB = [
    "<p>one <b>two</b> three<p>four<br>five</p> six <i>x</i> <b> y</b>",
    "<ul><li>a<li>b<ul><li>c</ul><li><p>d</p><p>e</ul>tail",
    "<table><tr><td>a<td>b<br>bb<tr><td><p>c</p><p>cc</p></td><td>d</table>after<nav><ol><li>n1<li>n2</ol>side</nav>main",
    "a < b <> c &lt;p&gt; <p",
    "<table><tr><th>H<td>x<table><tr><td>in<td>in2</table>y<td>z</tr></table>",
    "",
    None,
    "<div><p>u</div></p>v<hr>w<h1>T<b>x</h1>y",
    "<B>up</B><P>q<script>var t='</p>'</script><!-- <p>no</p> -->",
    "<td>lost<td>cell</td>t",
    "<nav>River<b> </b>Levels</nav>" + "<p>line</p>" * 60,
]


def test_tag_automaton_against_sql(spark):
    """Hand-made and random pages, most of them malformed."""
    rng = random.Random(5)
    tags = "p b i a br li ul ol td tr table th nav div h1 h2 footer hr img dd dl /p /b /li /ul /td /tr /table /nav /div /h1 /footer /i /dl".split()
    web = WEB + ["".join(rng.choice([f"<{rng.choice(tags)}>", f"<{rng.choice(tags)}>", "w ", "  ", "x"]) for _ in range(rng.randint(1, 40))) for _ in range(200)]
    con = duckdb.connect()
    con.execute("create table pages(page_id bigint, html varchar)")
    con.executemany("insert into pages values (?, ?)", list(enumerate(web)))
    names = "document_id, page, ord, text, x, y, width, font_size, bold, block, tag"
    want = con.execute(f"{sql_labels.chain(sql_labels.SPANS)} SELECT {names} FROM spans").fetchall()
    got = html.spans(spark.createDataFrame(list(enumerate(web)), "page_id long, html string")).select(*names.split(", ")).collect()
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_blocks_lines_and_cells(spark):
    found = html.spans(spark.createDataFrame(list(enumerate(WEB)), "page_id long, html string"))
    lines = {d: [r.text for r in sorted(rows, key=lambda r: (r.page, r.line))] for d, rows in _by(assemble.lines(found).collect(), "document_id").items()}
    assert lines["0"] == ["one two three", "four", "five", "six x y"]
    assert lines["1"] == ["• a", "• b", "• c", "• d", "e", "tail"]
    assert lines["2"] == ["• n1", "• n2", "side", "a", "c", "cc", "after", "main", "b", "bb", "d"]  # three bands
    assert lines["8"] == ["up", "q"] and "5" not in lines and "6" not in lines
    assert lines["10"][0] == "River Levels" and len(lines["10"]) == 61
    cells = {r.text: (r.x, r.y) for r in found.where("document_id = '2'").collect()}
    assert cells["a"][1] == cells["b"][1] and cells["bb"][0] == cells["b"][0] == cells["d"][0] == cells["a"][0] + 100
    assert cells["c"][1] == cells["d"][1] > cells["bb"][1]


def _by(rows, name):
    out = {}
    for r in rows:
        out.setdefault(r[name], []).append(r)
    return out


def plain_layout(spans):
    """Lines and units of one page by the rules, span by span. spans: ord, text, x, y, w, h, size, bold."""
    tall = sorted(s[5] for s in spans if s[5] > 0)
    mid = lambda v: (v[(len(v) - 1) // 2] + v[len(v) // 2]) / 2
    tol, rows = max(0.6 * (mid(tall) if tall else 12.0), 0.5), []
    for s in sorted(spans, key=lambda s: (round(s[3], 2), s[2], s[0])):
        home = next((r for r in rows if abs(r[0][3] - s[3]) <= tol), None)
        if home is None:
            rows.append([s])
        else:
            home.append(s)
    lines = []
    for r in rows:
        r.sort(key=lambda s: (s[2], s[0]))
        cuts = [0] + [i for i in range(1, len(r)) if r[i][2] - r[i - 1][2] - r[i - 1][4] > max(2.5 * r[i - 1][6], 18)] + [len(r)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            text = " ".join("".join(s[1] for s in r[a:b]).split())
            if text:
                lines.append({"x": r[a][2], "y": min(s[3] for s in r[a:b]), "text": text, "size": max(s[6] for s in r[a:b]), "bold": any(s[7] for s in r[a:b]), "ids": [s[0] for s in r[a:b]]})
    edges = sorted({round(x["x"], 1) for x in lines})
    runs = [[e for e in edges if sum(b - a > 40 for a, b in zip(edges, edges[1:], strict=False) if b <= e) == k] for k in range(len(edges))]
    starts = [r[0] for r in runs if r and sum(r[0] - 0.05 <= x["x"] <= r[-1] + 0.05 for x in lines) >= 3]
    for x in lines:
        left = [k for k, s in enumerate(starts) if s <= x["x"] + 0.05]
        x["band"] = None if len(starts) < 2 else left[-1] if left else sorted((abs(s - x["x"]), k) for k, s in enumerate(starts))[0][1]
    lines.sort(key=lambda x: (x["band"] or 0, x["y"], x["x"]))
    gaps = sorted(b["y"] - a["y"] for a, b in zip(lines, lines[1:], strict=False) if b["y"] > a["y"])
    middle, units = mid(gaps) if gaps else 12.0, []
    for k, x in enumerate(lines):
        a = lines[k - 1]
        if k and abs(x["size"] - a["size"]) < 0.6 and x["bold"] == a["bold"] and x["band"] == a["band"] and x["y"] - a["y"] <= max(1.6 * middle, 1.4 * a["size"]) and (len(units[-1]) < 3 or len(x["text"].split()) <= 12):
            units[-1].append(x)
        else:
            units.append([x])
    return [(x["text"], x["band"], x["ids"]) for x in lines], [(" ".join(x["text"] for x in u), len(u), [i for x in u for i in x["ids"]]) for u in units]


def test_layout_against_plain_rules(spark):
    """Random pages with columns, near baselines, blank spans and long lines."""
    rng, rows, want = random.Random(8), [], {}
    for page in range(1, 41):
        spans = []
        for k in range(rng.randint(1, 40)):
            x = rng.choice([72.0, 72.0, 90.5, 300.0, 300.0, 305.2, 500.0]) + rng.choice([0.0, 0.0, 0.04, 30.0])
            text = rng.choice(["word", " ", "two words", "", "a line of rather many words that a heading would not have at all in it"])
            spans.append((k, text, x, float(rng.randint(10, 40)) * rng.choice([4, 6]), rng.choice([10.0, 40.0, 150.0]), rng.choice([0.0, 9.0, 12.0]), rng.choice([9.0, 9.4, 12.0]), rng.random() < 0.2))
        rows += [("d", page, k, t, x, y, w, h, s, b) for k, t, x, y, w, h, s, b in spans]
        want[page] = plain_layout(spans)
    frame = spark.createDataFrame(rows, SPAN)
    lines, units = _by(assemble.lines(frame).orderBy("page", "line").collect(), "page"), _by(assemble.units(frame).orderBy("ord").collect(), "page")
    for page, (own, groups) in want.items():
        assert [(r.text, r.band, r.span_ids) for r in lines.get(page, [])] == own
        assert [(u.text, u.line_count, u.span_ids) for u in units.get(page, [])] == groups
    assert any(r.band for rs in lines.values() for r in rs) and any(len(r.span_ids) > 1 for rs in lines.values() for r in rs)


def test_values_of_the_rules(spark):
    wide = spark.createDataFrame([("d", 306.0), ("d", 200.0), ("d", 288.0), ("d", 287.0)], "document_id string, x double").select("*", F.lit(0.0).alias("width"), F.lit(612.0).alias("page_width"))
    assert [r.centered for r in assemble.centered(wide).collect()] == [True, False, True, False]  # within 18.36 points
    text = [(30.0, "x" * 40), (26.0, "x" * 40), (22.0, "x" * 40), (18.0, "x" * 40), (14.0, "x" * 40), (12.0, "xx"), (10.0, "x" * 4000), (8.0, "small")]
    units = spark.createDataFrame([("d", 1, k, t, 72.0, 40.0 + 20 * k, 90.0, s, s, False, 612.0, 792.0) for k, (s, t) in enumerate(text)], SPAN + ", page_width double, page_height double")
    assert {r["size"]: r.level for r in features.levels(units).collect()} == {30: "h1", 26: "h2", 22: "h3", 18: "h4", 14: "outlier", 12: "outlier", 10: "body", 8: "body"}
    place = spark.createDataFrame([("d", 1, k, "words of a unit", 72.0, y, 90.0, 10.0, 10.0, False, 612.0, 792.0) for k, y in enumerate((79.17, 79.19, 712.82, 712.90))], SPAN + ", page_width double, page_height double")
    assert [r.zone for r in features.matrix(place).orderBy("ord").collect()] == ["body", "body", "body", "footer"]


def test_blank_pdf_spans_part_words(spark):
    class Line(FakePage):
        def get_text(self, kind=None):
            spans = [{"text": t, "bbox": (x, 40.0, x + w, 52.0), "size": 12.0, "font": "Arial", "flags": 0} for t, x, w in (("River", 72.0, 30.0), (" ", 102.0, 4.0), ("", 106.0, 0.0), ("Levels", 106.0, 30.0))]
            return {"blocks": [{"lines": [{"spans": spans}]}]} if kind else "River Levels"

    rows = [r for n in (1, 2) for r in pdf_source.span_rows("d", n, Line(), first=3 * (n - 1))]
    assert [r[2] for r in rows] == [0, 1, 2, 3, 4, 5]
    found = assemble.units(spark.createDataFrame(rows, pdf_source.SPANS)).orderBy("ord").collect()
    assert [(u.text, u.span_ids) for u in found] == [("River Levels", [0, 1, 2]), ("River Levels", [3, 4, 5])]


def test_outline_against_a_walk(spark):
    rng, rows, want = random.Random(3), [], {}
    for d in range(30):
        stack = []
        for k in range(rng.randint(1, 25)):
            level = rng.randint(1, 6)
            rows.append((str(d), k, 1, level, f"t{k}"))
            stack = [h for h in stack if h[0] < level]
            want[str(d), k] = (stack[-1][1] if stack else None, len(stack) + 1, [f"t{h[1]}" for h in stack] + [f"t{k}"])
            stack.append((level, k))
    found = outline.outline(spark.createDataFrame(rows, "document_id string, ord int, page int, level int, text string")).collect()
    assert {(r.document_id, r.ord): (r.parent, r.depth, r.path) for r in found} == want


def test_headings_and_harvest(spark):
    web = [(0, "<title>no title</title><h2>A <b>bold</b> start of it</h2><p>x</p><h3>Part<br>one</h3><h2> </h2><h1>The whole</h1>"), (1, "<title>A title of its own</title><h1>Another one here</h1>"), (2, "<h1>short</h1>"), (3, None)]
    frame = spark.createDataFrame(web, "page_id long, html string")
    found = outline.headings(html.spans(frame)).orderBy("document_id", "ord").collect()
    assert [(r.document_id, r.level, r.text) for r in found] == [("0", 2, "A bold start of it"), ("0", 3, "Partone"), ("0", 1, "The whole"), ("1", 1, "Another one here"), ("2", 1, "short")]
    rows = {r.document_id: (r.title, r.source, r.confidence, r.needs_review) for r in outline.harvested(frame).collect()}
    assert rows == {"0": ("A bold start of it", "outline", "medium", True), "1": ("A title of its own", "title", "high", False)}


def test_roles_against_all_assignments():
    """Every way to give roles to units, by trying them all."""
    rng = random.Random(4)
    for _ in range(60):
        options = [(p, r, rng.randint(1, 4)) for p in range(1, rng.randint(2, 5)) for r in roles.ROLES if rng.random() < 0.4]
        score = {(p, r): s for p, r, s in options}
        last = 1 + max((p for p, _, _ in options), default=0)
        units = sorted({p for p, _, _ in options})
        best = None
        for given in itertools.product([None, *units], repeat=len(roles.ROLES)):
            used = [p for p in given if p is not None]
            if len(set(used)) == len(used) and all((p, r) in score for p, r in zip(given, roles.ROLES, strict=True) if p is not None):
                total = sum(score[p, r] for p, r in zip(given, roles.ROLES, strict=True) if p is not None)
                key = (-total, [last if p is None else p for p in given])
                best = min(best or (key, given), (key, given), key=lambda x: x[0])
        if best:
            assert roles.solve(options) == {r: p for p, r in zip(best[1], roles.ROLES, strict=True) if p is not None}
    assert roles.solve([]) == {}


def test_roles_share_nothing(spark):
    """A control number that would be the best title is the identifier, and the next unit is the title."""
    rows = [("d", 1, 0, "title", 50000), ("d", 1, 0, "identifier", 40000), ("d", 1, 1, "title", 30000), ("e", 1, 0, "title", 7), ("e", 1, 1, "title", 7)]
    scores = spark.createDataFrame([(d, 1, 10.0 * o, 5.0, o, r, s) for d, _, o, r, s in rows], "document_id string, page int, y double, x double, ord int, role string, score int")
    assert sorted((r.document_id, r.role, r.ord) for r in roles.assigned(scores).collect()) == [("d", "identifier", 0), ("d", "title", 1), ("e", "title", 0)]


def test_captions_in_one_to_three_units(spark):
    texts = ["Ann Smith v. City of Rome", "x", "Ann Smith,", "vs.", "Bob Jones", "x", "Ann Smith versus", "Bob", "x", "Ann Smith", "v. Bob Jones, Jr.", "12 v 14", "Ann v Bob", "Ann Smith", "v", "Bob Jones", "lower v. Upper Case", "Ann Smith v. the others"]
    units = spark.createDataFrame([("d", 1, k, t) for k, t in enumerate(texts)] + [("d", 2, 99, "v."), ("d", 3, 100, "Bob Jones")], "document_id string, page int, ord int, text string")
    found = [(r.ord, r["last"], r.plaintiff, r.defendant) for r in pleading.captions(units).orderBy("ord").collect()]
    assert found == [(0, 0, "Ann Smith", "City of Rome"), (2, 4, "Ann Smith", "Bob Jones"), (6, 7, "Ann Smith", "Bob")]


def test_numbered_margins(spark):
    numbers = lambda page, values, pitch=24.0, x=36.0, top=60.0: [(page, v, x, top + pitch * v) for v in values]
    rows = numbers(1, range(1, 29)) + [(1, 7, 36.0, 333.0), (1, 55, 36.0, 400.0)]  # a stray seven and a number beyond the last
    rows += numbers(2, range(1, 15)) + numbers(3, range(1, 29), x=80.0) + numbers(4, [*range(1, 6), *range(9, 24)]) + numbers(5, [28 - k for k in range(28)], -24.0, top=800.0)[:10]
    spans = spark.createDataFrame([("d", p, k, str(v), x, y, 10.0, 10.0, 10.0, False, 612.0, 792.0) for k, (p, v, x, y) in enumerate(rows)], SPAN + ", page_width double, page_height double")
    assert sorted((r.page, r.first, r["last"], r.numbers, r.pitch) for r in pleading.line_number_runs(spans).collect()) == [(1, 1, 28, 28, 24.0), (4, 1, 23, 20, 24.0)]
    left = sorted((r.page, int(r.text)) for r in pleading.without_numbers(spans).where("page in (1, 4)").collect())
    assert left == [(1, 7), (1, 55)]


def streamed(spark, frames, schema, make, name, until, seconds=60):
    """What a stream gives whose micro-batches are the frames' rows: one file each, one file a batch."""
    folder = tempfile.mkdtemp(prefix="stream-")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    q = None
    try:
        for k, rows in enumerate(frames):
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
            if q is None:
                source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
                q = make(source).writeStream.format("memory").queryName(name).option("checkpointLocation", f"{folder}/state").outputMode("append").start()
            q.processAllAvailable()
        end = time.time() + seconds
        while time.time() < end and spark.table(name).count() < until:
            time.sleep(0.5)
        return spark.table(name).collect()
    finally:
        if q is not None:
            q.stop()
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_stream_of_shuffled_pages_equals_the_batch(spark):
    raw = spark.read.parquet(f"{SF}/documents.parquet").where("source is not null")
    names = ["document_id", "page", "raw_text", "width", "height", "rotation", "image_count", "fonts"]
    rows = [tuple(r) for r in compounds.stamped_pages(raw).where("page <= 6").select(*names).collect()]
    random.Random(1).shuffle(rows)
    start = datetime.datetime(2024, 1, 1)
    found = streamed(spark, [[(*r, start + datetime.timedelta(seconds=k)) for r in rows[k::3]] for k in range(3)], f"{PAGE}, arrived timestamp", lambda s: stream_seams.seams_stream(s).select("document_id", "before_page", "score", "change_score", "is_cut", "p_header", F.transform("signals", lambda x: x["name"]).alias("names")), "shuffled", 1, 5)
    pairs = stream_seams.without_whole(segment.seams(census.census(spark.createDataFrame(rows, PAGE))))
    want = segment.decided(segment.scored(segment.signals(pairs))).select("document_id", "before_page", "score", "change_score", "is_cut", "p_header", F.transform("signals", lambda x: x["name"]).alias("names")).collect()
    assert sorted(map(str, found)) == sorted(map(str, want)) and len(want) > 50
    assert not {x for r in found for x in r.names} & set(stream_seams.WHOLE)


def test_stream_waits_for_missing_pages(spark):
    page = lambda n, text, minute, d="d": (d, n, text, 612.0, 792.0, 0, 0, ["Arial"], datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=minute))
    frames = [[page(2, "second page here.", 0), page(4, "fourth", 0)], [page(1, "first", 1), page(2, "another second", 1), page(1, "again", 1)], [page(6, "sixth", 30)], [page(1, "of another", 60, "e")]]
    found = streamed(spark, frames, f"{PAGE}, arrived timestamp", lambda s: stream_seams.pairs_stream(s, 300_000, "1 minute").select("a_page", "before_page", "b_ends_mid_sentence"), "gaps", 3, 10)
    assert sorted(map(tuple, found)) == [(1, 2, False), (2, 4, True), (4, 6, True)]


def test_uploads_live_for_a_while(spark):
    at = lambda minutes: datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=minutes)
    kind = "content string, arrived timestamp, filename string"
    frames = [[("x", at(0), "a"), ("x", at(5), "b"), ("y", at(1), "c"), (None, at(2), "n"), ("x", None, "never")], [("x", at(10), "d"), ("y", at(12), "e"), ("", at(3), "m")], [("x", at(20.5), "f"), ("x", at(10.5), "g"), ("y", at(22), "h")]]
    found = streamed(spark, frames, kind, lambda s: intake.taken(s, 600, "2 hours").select("filename", "content_id"), "uploads", 5, 5)
    # x lives from 0 to 10 and from 10.5 to 20.5, y from 1 to 11 and from 12 to 22; no bytes are one content
    assert sorted(r.filename for r in found) == ["a", "c", "e", "g", "n"]
    assert {r.content_id for r in found if r.filename == "a"} == {hashlib.sha256(b"x").hexdigest()[:16]}


def test_term_deltas_add_up_in_any_order(spark, tmp_path):
    texts = [(str(k), f"river levels word{k % 3} alpha{k} Alpha{k}" if k else None) for k in range(12)]
    frame = lambda rows: spark.createDataFrame(rows, "document_id string, text string")
    built = {}
    for order in ((0, 1, 2), (2, 0, 1, 0)):
        folder = str(tmp_path / f"d{len(order)}")
        names = [term_deltas.add_delta(frame(texts[k::3]), folder) for k in order]
        assert len(set(names)) == 3
        at = term_deltas.build_version(spark, folder, "v1")
        table, summary = identity.thaw(spark, at)
        built[order] = sorted(map(tuple, table.collect())), summary.collect()
    assert built[0, 1, 2] == built[2, 0, 1, 0]
    whole = identity.idf(frame(texts))
    assert built[0, 1, 2][0] == sorted(map(tuple, whole.collect()))
    assert built[0, 1, 2][1] == identity.idf_summary(frame(texts), whole).select("documents", "avgdl", "default_idf", "most", "version").collect()
    # a version doesn't change as deltas come; one document in two batches is refused
    folder = str(tmp_path / "d3")
    before = identity.thaw(spark, f"{folder}/versions/v1")[1].collect()
    term_deltas.add_delta(frame([("new", "river")]), folder)
    assert identity.thaw(spark, f"{folder}/versions/v1")[1].collect() == before
    assert identity.thaw(spark, term_deltas.build_version(spark, folder, "v2"))[1].head().documents == 13
    assert identity.thaw(spark, term_deltas.build_version(spark, folder, "only", names[:1]))[1].head().documents == 4
    term_deltas.add_delta(frame([("new", "another text")]), folder)
    with pytest.raises(ValueError, match="several deltas"):
        term_deltas.build_version(spark, folder, "v3")


def test_rules_are_counted_in_the_writing_pass(spark, tmp_path):
    rows = [("d", 1, 1, 3, 3), ("d", 2, 5, 6, 2), ("d", 3, 6, 7, 2), ("e", 1, 2, 4, 3), ("f", 1, 1, 2, 2)]
    found = spark.createDataFrame(rows, "document_id string, segment_index int, start_page int, end_page int, page_count int")
    totals = spark.createDataFrame([("d", 8), ("e", 4), ("f", 2)], "document_id string, total int")
    checked, seen = validation.observed(validation.with_neighbours(found, totals), validation.SEGMENTS)
    checked.drop("previous_end", "is_last", "total").write.json(str(tmp_path / "out"))
    assert seen.get["rows"] == 5
    assert validation.broken(seen, validation.SEGMENTS) == {"gap_or_overlap": 2, "late_start": 1, "early_end": 1}
    spans = spark.createDataFrame([("d", 1, 0, "x", 0.0, 0.0, 1.0, 1.0, 10.0), ("d", 1, 1, "", 0.0, 0.0, -1.0, 1.0, 10.0), ("d", 0, 2, None, 0.0, 0.0, 1.0, 1.0, 0.0)], "document_id string, page int, ord int, text string, x double, y double, width double, height double, font_size double")
    checked, seen = validation.observed(spans, validation.SPANS)
    checked.write.format("noop").mode("overwrite").save()
    assert validation.broken(seen, validation.SPANS) == {"missing_field": 1, "impossible_number": 2, "empty_text": 1}


def test_command_line_fails_on_broken_rules(spark, tmp_path, capsys):
    pages(spark, ["Some text here."]).withColumn("page", F.lit(0)).write.parquet(str(tmp_path / "pages"))
    assert cli.main(["census", "--input", str(tmp_path / "pages"), "--output", str(tmp_path / "c")]) == 0
    assert cli.main(["census", "--input", str(tmp_path / "pages"), "--output", str(tmp_path / "c"), "--validate", "--report"]) == 1
    said = capsys.readouterr()
    assert "census: 1 records" in said.out and "impossible_number: 1" in said.err
    spark.createDataFrame([("a", "river levels"), ("b", "river")], "document_id string, text string").write.parquet(str(tmp_path / "texts"))
    assert cli.main(["add-terms", "--input", str(tmp_path / "texts"), "--output", str(tmp_path / "t")]) == 0
    assert cli.main(["build-terms", "--output", str(tmp_path / "t"), "--version", "one"]) == 0
    assert identity.thaw(spark, str(tmp_path / "t/versions/one"))[0].count() == 2


def test_an_eighth_source(spark):
    rows = [("d", 1, 0, "Notice of the hearing", 72.0, 40.0, 90.0, 12.0, 12.0, False), ("d", 1, 1, "Motion upon motion for it", 72.0, 300.0, 90.0, 12.0, 14.0, False), ("d", 1, 2, "plain words run on and on " * 9, 72.0, 500.0, 90.0, 10.0, 10.0, False), ("e", 1, 0, "Only one unit here", 72.0, 40.0, 90.0, 12.0, 12.0, False)]
    units = assemble.units(spark.createDataFrame(rows, SPAN))
    terms = identity.thaw(spark, None)
    plain = {(r.document_id, r.key): r for r in identity.fused(units, *terms).collect()}
    motions = evidence.foreign("motions", 2.0, "tests.evidence_example:says_motion")
    share = evidence.Source("share", 0.5, lambda u, c: c.select("document_id", "key", F.lit(0.25).alias("raw")), scaled=False)
    with evidence.using(motions, share):
        fused = identity.fused(units, *terms)
        found = {(r.document_id, r.key): r for r in fused.collect()}
        masks = {r.disabled: r.top1 for r in identity.ablation(fused, spark.createDataFrame([("d", "Motion upon motion for it")], "document_id string, title string")).collect()}
        best = identity.elected(fused).where("document_id = 'd'").head().best[0]
    assert evidence.REGISTERED == {} and set(found) == set(plain)
    key = ("d", "motion upon motion for it")
    assert {k for k, r in found.items() if r.motions == 1.0} == {key} and found["e", "only one unit here"].motions == 0.5
    for k, r in found.items():
        assert r.score == pytest.approx(plain[k].score + 2.0 * r.motions + 0.125, abs=2e-4) and r.share == 0.25
    assert {c.source: c.contribution for c in found[key].contributions}["motions"] == 2.0
    assert best.text == "Motion upon motion for it" and {"motions", "share"} <= set(masks) and len(masks) == 10 and masks["none"] == 1.0
    with pytest.raises(ValueError, match="column of its own"):
        evidence.register(evidence.Source("bm25", 1.0, motions.raw))
    wide = evidence.ForeignEvidence(units.select("document_id", "ord", "text").asTable(), F.lit("tests.evidence_example:says_motion"), F.lit(True))
    assert wide.columns == ["document_id", "text", "raw", "ord"]
