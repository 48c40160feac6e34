"""Queries over web pages as spans: features, titles, phrases, labels and their evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from quirelight import contracts
from quirelight.functions import text as T
from quirelight.operators import assemble as A
from quirelight.operators import census as N
from quirelight.operators import features as M
from quirelight.operators import identity as I
from quirelight.operators import outline as O
from quirelight.operators import segment as S
from quirelight.plans import sql_labels as Q
from quirelight.sources import html
from quirelight.storage import stored

QUERIES, ORACLES = {}, {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle is not None:
            ORACLES[f.__name__] = oracle
        return f

    return add


def pages(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def spans(spark, sf_dir):
    return html.spans(pages(spark, sf_dir))


def assembled(spark, sf_dir):
    return A.units(spans(spark, sf_dir))


def texts(spark, sf_dir):
    return assembled(spark, sf_dir).select("document_id", "ord", "text")


def frozen(spark, sf_dir):
    """The term table and its summary, of the benchmark's items. The table is written, so that its size is known where
    words meet it: a small one is sent to them."""
    corpus = spark.read.parquet(f"{sf_dir}/benchmark.parquet").where("item_id is not null").select(F.col("item_id").cast("string").alias("document_id"), F.coalesce("text", F.lit("")).alias("text"))
    table = stored(I.idf(corpus), "terms")
    return table, I.idf_summary(corpus, table)


def fused(spark, sf_dir):
    return I.fused(assembled(spark, sf_dir), *frozen(spark, sf_dir))


r6 = lambda c: (F.floor(F.col(c) * 1e6 + 0.5) / 1e6).alias(c)
SPAN = "document_id, page, ord, text, x, y, width, font_size, bold, block, tag"


@query(Q.chain(Q.SPANS) + "SELECT document_id, ord, abs(x + width / 2 - page_width / 2) <= page_width * 0.03 AS centered FROM spans")
def spans_centered(spark, sf_dir):
    return A.centered(spans(spark, sf_dir)).select("document_id", "ord", "centered")


@query(Q.chain(Q.SPANS) + f"SELECT {SPAN} FROM spans")
def spans_html(spark, sf_dir):
    return spans(spark, sf_dir).select(*SPAN.split(", "))


@query(Q.chain(Q.SPANS, Q.HISTOGRAM) + "SELECT document_id, page, size, floor(share * 1e6 + 0.5) / 1e6 AS share FROM histogram")
def font_size_histogram(spark, sf_dir):
    return S.histogram(spans(spark, sf_dir), ["document_id", "page"]).select("document_id", "page", "size", r6("share"))


@query(
    Q.chain(Q.SPANS, Q.HISTOGRAM)
    + """SELECT document_id, before_page, floor(sum(abs(coalesce(x, 0) - coalesce(y, 0))) * 1e6 + 0.5) / 1e6 AS l1 FROM (
  SELECT coalesce(a.document_id, b.document_id) AS document_id, coalesce(a.before_page, b.before_page) AS before_page, a.share AS x, b.share AS y
  FROM (SELECT *, page + 1 AS before_page FROM histogram) a FULL JOIN (SELECT *, page AS before_page FROM histogram) b USING (document_id, before_page, size))
SEMI JOIN (SELECT document_id, page AS before_page FROM histogram INTERSECT SELECT document_id, page + 1 FROM histogram) USING (document_id, before_page) GROUP BY ALL"""
)
def histogram_l1(spark, sf_dir):
    h = S.histogram(spans(spark, sf_dir), ["document_id", "page"])
    a = h.withColumn("before_page", F.col("page") + 1).drop("page")
    return S.histogram_l1(a, h.withColumnRenamed("page", "before_page"), ["document_id", "before_page"]).select("document_id", "before_page", r6("l1"))


@query(Q.chain(Q.SPANS, Q.LINES) + "SELECT document_id, page, line, band, y, x0, x1, bottom, text, font_size, bold, ids AS span_ids FROM lines")
def line_clusters(spark, sf_dir):
    return A.lines(spans(spark, sf_dir)).select("document_id", "page", "line", "band", "y", "x0", "x1", "bottom", "text", "font_size", "bold", ids())


def ids():
    return F.array_join(F.transform("span_ids", lambda x: x.cast("string")), ",").alias("span_ids")


UNIT = "document_id, ord, page, text, x, y, width, height, font_size, bold, line_count, median_gap"


@query(Q.chain(Q.SPANS, Q.UNITS) + f"SELECT {UNIT}, span_ids FROM units")
def units(spark, sf_dir):
    return assembled(spark, sf_dir).select(*UNIT.split(", "), ids())


@query(
    Q.chain(Q.SPANS)
    + """, signs AS (SELECT document_id, ord, unnest(string_split(regexp_replace(text, '[[:space:]]', '', 'g'), '')) AS sign FROM spans)
SELECT document_id, sign, CAST(count(*) AS BIGINT) AS n FROM signs WHERE ord % 7 = 3 AND sign <> '' GROUP BY document_id, sign"""
)
def units_lossless(spark, sf_dir):
    """What is lost where every seventh span is kept from assembly: exactly its characters."""
    found = spans(spark, sf_dir)
    return A.lost_characters(found, A.units(found.where("ord % 7 <> 3")))


@query(Q.chain(Q.SPANS, Q.UNITS, Q.TYPOGRAPHY) + "SELECT document_id, baseline, contrast, flat FROM typography")
def body_baseline(spark, sf_dir):
    return M.typography(assembled(spark, sf_dir))


@query(Q.chain(Q.SPANS, Q.UNITS, Q.TYPOGRAPHY, Q.LEVELS) + "SELECT document_id, size, level FROM levels")
def typography_levels(spark, sf_dir):
    return M.levels(assembled(spark, sf_dir))


@query(Q.chain(Q.SPANS, Q.UNITS, Q.TYPOGRAPHY, Q.FEATURES) + f"SELECT {Q.FEATURE} FROM features")
def feature_matrix(spark, sf_dir):
    return M.matrix(assembled(spark, sf_dir)).select(*Q.FEATURE.split(", "))


@query(Q.chain(Q.SPANS, Q.UNITS, Q.TYPOGRAPHY, Q.FEATURES, Q.SCORES) + "SELECT document_id, ord, array_to_string(reasons, ',') AS reasons FROM scores")
def title_eligibility(spark, sf_dir):
    return M.eligibility(M.matrix(assembled(spark, sf_dir))).select("document_id", "ord", F.array_join("reasons", ",").alias("reasons"))


@query(Q.chain(Q.SPANS, Q.UNITS, Q.TYPOGRAPHY, Q.FEATURES, Q.SCORES) + "SELECT document_id, ord, score FROM scores WHERE score IS NOT NULL")
def title_scores(spark, sf_dir):
    return M.title_scores(M.matrix(assembled(spark, sf_dir))).where(F.size("reasons") == 0).select("document_id", "ord", "score")


@query(Q.chain(Q.SPANS, Q.UNITS, Q.TYPOGRAPHY, Q.FEATURES, Q.SCORES, Q.TITLES) + "SELECT document_id, title, candidate, ord, score, margin, confidence, ranking FROM titles")
def title_assign(spark, sf_dir):
    return M.titles(M.title_scores(M.matrix(assembled(spark, sf_dir)))).withColumn("ranking", F.array_join(F.transform("ranking", lambda x: x["ord"].cast("string")), ","))


def html_pages(units):
    """Units as raw pages of a census."""
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ord", "text"))), lambda x: x["text"]), "\n")
    rows = units.groupBy("document_id", "page").agg(text.alias("raw_text"), F.array_sort(F.collect_set("font_name")).alias("fonts"))
    return rows.select("document_id", "page", "raw_text", F.lit(612.0).alias("width"), F.lit(792.0).alias("height"), F.lit(0).alias("rotation"), F.lit(0).alias("image_count"), "fonts")


@query(Q.SEGMENT_TITLES)
def segment_titles(spark, sf_dir):
    """The whole chain: spans, units, pages, census, seams, segments, their head pages' units, and a title for each."""
    units = stored(assembled(spark, sf_dir), "segment-units")
    census = stored(N.census(html_pages(units)).select("document_id", "page", *S.SIDES), "segment-census")
    found = stored(S.segments(S.decided(S.scored(S.signals(S.seams(census))), "aggressive"), census), "segment-found")
    heads = M.by_segment(units, found, S.head_pages(found, census))
    return M.titles(M.title_scores(M.matrix(heads))).select("document_id", "title", "candidate", "ord", "score", "margin", "confidence")


@query(Q.chain(Q.HARVEST) + "SELECT document_id, title FROM harvest")
def title_harvest(spark, sf_dir):
    return html.titles(pages(spark, sf_dir))


@query(Q.chain(Q.SPANS, Q.OUTLINE) + "SELECT document_id, ord, page, level, text, parent, CAST(depth AS INTEGER) AS depth, array_to_string(path, ' / ') AS path FROM paths")
def outline(spark, sf_dir):
    return O.outline(O.headings(spans(spark, sf_dir))).withColumn("path", F.array_join("path", " / "))


@query(
    Q.chain(Q.SPANS, Q.OUTLINE, Q.HARVEST)
    + f"""SELECT document_id, title, 'title' AS source, 'high' AS confidence, false AS needs_review FROM harvest
UNION ALL SELECT document_id, text, 'outline', 'medium', true FROM headings h WHERE ord = (SELECT min(ord) FROM headings f WHERE f.document_id = h.document_id) AND {Q.usable("text")} AND document_id NOT IN (SELECT document_id FROM harvest)"""
)
def title_harvest_sources(spark, sf_dir):
    """Titles with where they come from: the title element, else the outline's first heading."""
    return O.harvested(pages(spark, sf_dir))


def compared_titles(spark, sf_dir):
    found = M.titles(M.title_scores(M.matrix(assembled(spark, sf_dir)))).withColumnRenamed("title", "emitted")
    rows = found.join(html.titles(pages(spark, sf_dir)), "document_id")
    f1 = M.token_f1(T.evaluation_tokens(F.col("candidate")), T.evaluation_tokens(F.col("title")))
    return rows.withColumn("f1", f1)


share = lambda c: T.rounded(F.avg(c.cast("double")), 4)


@query(Q.chain(Q.SPANS, Q.UNITS, Q.TYPOGRAPHY, Q.FEATURES, Q.SCORES, Q.TITLES, Q.HARVEST, Q.TITLE_F1) + Q.TITLE_METRICS)
def title_eval_f1(spark, sf_dir):
    right, shown = F.col("f1") >= 0.7, F.col("emitted").isNotNull()
    emitted = T.rounded(F.coalesce(F.count_if(right & shown) / F.nullif(F.count_if(shown), F.lit(0)), F.lit(0.0)), 4)
    return compared_titles(spark, sf_dir).agg(F.count("*").alias("documents"), share(shown).alias("coverage"), share(right & shown).alias("accuracy"), share((F.col("f1") >= 0.5) & shown).alias("lenient"), emitted.alias("precision_emit"), share(F.col("confidence") == "escalate").alias("escalation_rate"), share(right).alias("candidate_accuracy"))


@query(
    Q.chain(Q.SPANS, Q.UNITS, Q.TYPOGRAPHY, Q.FEATURES, Q.SCORES, Q.TITLES, Q.HARVEST, Q.TITLE_F1)
    + "SELECT confidence, count(*) AS documents, CAST(count_if(f1 >= 0.7 AND emitted IS NOT NULL) AS BIGINT) AS correct, floor(avg(CAST(f1 >= 0.7 AND emitted IS NOT NULL AS INTEGER)) * 10000 + 0.5) / 10000 AS accuracy FROM title_f1 GROUP BY confidence"
)
def title_eval_by_state(spark, sf_dir):
    right = (F.col("f1") >= 0.7) & F.col("emitted").isNotNull()
    return compared_titles(spark, sf_dir).groupBy("confidence").agg(F.count("*").alias("documents"), F.count_if(right).alias("correct"), share(right).alias("accuracy"))


@query(
    Q.chain(Q.HARVEST)
    + "SELECT CAST(p.page_id AS VARCHAR) AS document_id, length(coalesce(html, '')) AS size, title, title IS NULL AS needs_review FROM pages p LEFT JOIN harvest h ON h.document_id = CAST(p.page_id AS VARCHAR)"
)
def titles_of_pages(spark, sf_dir):
    """Every page with its title, if it has one that could name it."""
    known = html.titles(pages(spark, sf_dir)).withColumnRenamed("document_id", "t_document")
    rows = pages(spark, sf_dir).select(F.col("page_id").cast("string").alias("document_id"), F.length(F.coalesce("html", F.lit(""))).cast("long").alias("size"))
    return rows.join(known, F.col("document_id") == F.col("t_document"), "left").select("document_id", "size", "title", F.col("title").isNull().alias("needs_review"))


@query(Q.chain(Q.SPANS, Q.UNITS, Q.TOKENS) + "SELECT document_id, term, tf, length FROM terms")
def tf(spark, sf_dir):
    return I.terms(texts(spark, sf_dir))


@query(Q.chain(Q.IDF) + "SELECT term, df, idf FROM idf")
def idf_frozen(spark, sf_dir):
    return frozen(spark, sf_dir)[0]


@query(Q.chain(Q.IDF) + "SELECT documents, avgdl, floor(ln((documents + 0.5) / 0.5 + 1) * 1e6 + 0.5) / 1e6 AS default_idf, most FROM idf_summary")
def idf_summary(spark, sf_dir):
    return frozen(spark, sf_dir)[1].drop("version")


@query(Q.chain(Q.SPANS, Q.UNITS, Q.PHRASES) + "SELECT document_id, ord, array_to_string(words, ' ') AS phrase, count(*) AS n FROM phrases GROUP BY ALL")
def rake_phrases(spark, sf_dir):
    return I.phrases(texts(spark, sf_dir)).groupBy("document_id", "ord", F.array_join("words", " ").alias("phrase")).agg(F.count("*").alias("n"))


@query(Q.chain(Q.SPANS, Q.UNITS, Q.PHRASES, Q.RAKE) + "SELECT document_id, word, freq, floor(score * 1e6 + 0.5) / 1e6 AS score FROM rake")
def rake_word_scores(spark, sf_dir):
    return I.rake_words(I.phrases(texts(spark, sf_dir))).select("document_id", "word", "freq", r6("score"))


@query(Q.chain(Q.SPANS, Q.UNITS, Q.TOKENS, Q.IDF, Q.BM25) + "SELECT document_id, word, floor(score * 1e6 + 0.5) / 1e6 AS score FROM bm25")
def bm25_words(spark, sf_dir):
    return I.bm25_words(texts(spark, sf_dir), *frozen(spark, sf_dir)).select("document_id", "word", r6("score"))


@query(Q.chain(Q.SPANS, Q.UNITS, Q.EDGES) + "SELECT document_id, a, b FROM edges")
def textrank_edges(spark, sf_dir):
    return I.word_edges(texts(spark, sf_dir))


@query(Q.chain(Q.SPANS, Q.UNITS, Q.EDGES, Q.TEXTRANK) + "SELECT document_id, word, floor(score * 1e6 + 0.5) / 1e6 AS score FROM textrank")
def textrank_ranks(spark, sf_dir):
    return I.textrank(texts(spark, sf_dir)).select("document_id", "word", r6("score"))


@query(Q.chain(Q.SPANS, Q.UNITS, Q.PRESENTABILITY) + "SELECT document_id, ord, presentability FROM presentability")
def presentability(spark, sf_dir):
    return I.presentability(texts(spark, sf_dir)).select("document_id", "ord", "presentability")


@query(Q.chain(Q.SPANS, Q.UNITS, Q.PHRASE_EDGES) + "SELECT document_id, page, a, b FROM phrase_edges")
def phrase_edges(spark, sf_dir):
    return I.phrase_edges(assembled(spark, sf_dir))


@query(Q.chain(Q.SPANS, Q.UNITS, Q.PHRASE_EDGES, Q.CHAINS) + "SELECT document_id, text FROM chains")
def phrase_chains(spark, sf_dir):
    return I.chains(assembled(spark, sf_dir)).select("document_id", "text")


TO_CANDIDATES = (Q.SPANS, Q.UNITS, Q.TYPOGRAPHY, Q.LEVELS, Q.PHRASES, Q.PHRASE_EDGES, Q.CHAINS, Q.CANDIDATES)
TO_FUSED = (*TO_CANDIDATES, Q.presentability("candidates", "text", "key"), Q.RAKE, Q.TOKENS, Q.IDF, Q.BM25, Q.EDGES, Q.TEXTRANK, Q.FUSED)
TO_LABELS = (*TO_FUSED, Q.LABELS)


@query(Q.chain(*TO_CANDIDATES) + "SELECT document_id, key, text, sources, ord, level FROM candidates")
def candidates(spark, sf_dir):
    units = stored(assembled(spark, sf_dir), "candidate-units")  # read by many steps
    return I.candidates(units).select("document_id", "key", "text", F.array_join("sources", ",").alias("sources"), "ord", "level")


@query(Q.chain(*TO_FUSED) + f"SELECT document_id, key, {', '.join(f'floor({c} * 1e4 + 0.5) / 1e4 AS {c}' for c in I.SOURCES)}, score FROM fused")
def fusion_scores(spark, sf_dir):
    r4 = lambda c: (F.floor(F.col(c) * 1e4 + 0.5) / 1e4).alias(c)
    return fused(spark, sf_dir).select("document_id", "key", *[r4(c) for c in I.SOURCES], "score")


@query(Q.chain(*TO_LABELS) + "SELECT document_id, rank, text, score, presentability FROM labels")
def labels_top3(spark, sf_dir):
    return I.labels(fused(spark, sf_dir))


@query(Q.chain(*TO_LABELS) + Q.LABEL_STATES)
def label_states(spark, sf_dir):
    """Each document's margin, confidence, and number of candidates and of duplicates met."""
    found = I.elected(fused(spark, sf_dir))
    return found.select("document_id", "candidates", "margin", "confidence", F.size("suppressed").cast("long").alias("suppressed"))


@query(Q.chain(*TO_FUSED, Q.HARVEST, Q.ABLATED) + Q.ABLATION)
def ablation(spark, sf_dir):
    return I.ablation(fused(spark, sf_dir), html.titles(pages(spark, sf_dir)))


VERSIONS = [(n, contracts.load(n)["version"], contracts.content_hash(n)) for n in contracts.available()]
#: A manifest with one contract changed under its version, one under another, one that is gone, and one left out.
PLANTED = [(VERSIONS[0][0], VERSIONS[0][1], "0" * 16), (VERSIONS[1][0], "0.0.1", "0" * 16), ("ghost", "1.0.0", "0" * 16)]


@query("SELECT * FROM (VALUES " + ", ".join(f"('{n}', '{v}', '{h}')" for n, v, h in VERSIONS) + ") t(name, version, content_hash)")
def contract_versions(spark, sf_dir):
    listed = spark.createDataFrame([(n, x["version"], x["hash"]) for n, x in contracts.read_manifest().items()], "name string, version string, content_hash string")
    return listed


@query(f"SELECT * FROM (VALUES ('{VERSIONS[0][0]}', 'drifted'), ('{VERSIONS[1][0]}', 'stale'), ('ghost', 'orphan'), ('new', 'missing')) t(name, finding)")
def contract_findings(spark, sf_dir):
    """What is found of PLANTED and of a contract that no manifest lists."""
    kind = "name string, version string, content_hash string"
    return contracts.findings(spark.createDataFrame(PLANTED, kind), spark.createDataFrame([*VERSIONS, ("new", "1.0.0", "1" * 16)], kind))


BASELINE = {"accuracy": 0.2, "precision_emit": 0.3, "candidate_accuracy": 0.2}


@query(
    Q.chain(Q.SPANS, Q.UNITS, Q.TYPOGRAPHY, Q.FEATURES, Q.SCORES, Q.TITLES, Q.HARVEST, Q.TITLE_F1)
    + "SELECT metric, value, floor((value - baseline) * 1e4 + 0.5) / 1e4 AS delta, value - baseline < -0.01 AS failed FROM (UNPIVOT (SELECT accuracy, precision_emit, candidate_accuracy FROM ("
    + Q.TITLE_METRICS
    + ")) ON COLUMNS(*) INTO NAME metric VALUE value) JOIN (VALUES "
    + ", ".join(f"('{k}', {v})" for k, v in BASELINE.items())
    + ") b(metric, baseline) USING (metric)"
)
def regression_gate(spark, sf_dir):
    metrics = title_eval_f1(spark, sf_dir).select(F.explode(F.array(*[F.struct(F.lit(k).alias("metric"), F.col(k).alias("value"), F.lit(v).alias("baseline")) for k, v in BASELINE.items()])).alias("m"))
    gap = F.col("m.value") - F.col("m.baseline")
    return metrics.select("m.metric", "m.value", (F.floor(gap * 1e4 + 0.5) / 1e4).alias("delta"), (gap < -0.01).alias("failed"))


@query(
    Q.chain(Q.SPANS, Q.LINES)
    + """SELECT b.document_id, b.page, CAST(row_number() OVER (PARTITION BY b.document_id, b.page ORDER BY lo) AS INTEGER) AS band, lo AS start, n AS lines
FROM (SELECT b.document_id, b.page, lo, count(*) AS n FROM edge_bands b JOIN made_lines l ON l.document_id = b.document_id AND l.page = b.page AND l.x0 BETWEEN lo - 0.05 AND hi + 0.05 GROUP BY ALL HAVING count(*) >= 3) b"""
)
def column_bands(spark, sf_dir):
    return A.column_bands(A.lines(spans(spark, sf_dir)))


@query(Q.chain(Q.SPANS, Q.LINES) + "SELECT l.document_id, l.page, line, starts[band + 1] AS band_start FROM lines l LEFT JOIN band_starts b ON b.document_id = l.document_id AND b.page = l.page")
def line_bands(spark, sf_dir):
    return A.in_bands(A.lines(spans(spark, sf_dir)).drop("band")).select("document_id", "page", "line", "band_start")


@query(Q.chain(Q.SPANS, Q.UNITS, Q.TYPOGRAPHY, Q.FEATURES, Q.SCORES) + "SELECT s.document_id, s.ord, s.text, f.font_rank, f.score, array_to_string(f.reasons, ',') AS excluded FROM units s LEFT JOIN scores f ON f.document_id = s.document_id AND f.ord = s.ord")
def unit_overlay(spark, sf_dir):
    scored = M.title_scores(M.matrix(assembled(spark, sf_dir), unnamed=True))
    named = lambda c, name: F.when(F.col("document_id").isNotNull(), c).alias(name)
    return scored.select("document_id", "ord", "text", named(F.col("font_rank"), "font_rank"), named(F.col("score"), "score"), named(F.array_join("reasons", ","), "excluded"))


@query(Q.chain(*TO_LABELS, Q.HARVEST) + Q.LABEL_METRICS)
def label_metrics(spark, sf_dir):
    """How labels compare with harvested titles, and how label-like they are."""
    record = I.elected(fused(spark, sf_dir)).join(html.titles(pages(spark, sf_dir)), "document_id")
    f1 = lambda x: M.token_f1(T.evaluation_tokens(x), T.evaluation_tokens(F.col("title")))
    found = record.select("document_id", "candidates", "title", F.posexplode("best").alias("i", "e"))
    found = found.withColumn("f1", f1(F.col("e.text")))
    first = lambda c: F.max(F.when(F.col("i") == 0, c))
    best = found.groupBy("document_id").agg(first(F.col("f1")).alias("first"), F.max("f1").alias("any"), first(F.size(F.split("e.text", " "))).alias("words"), first(F.col("e.presentability")).alias("presentability"), F.max("candidates").alias("candidates"))
    share = lambda c: T.rounded(F.avg(c.cast("double")), 4)
    one = lambda c: T.rounded(F.avg(c.cast("double")), 1)
    return best.agg(F.count("*").alias("documents"), share(F.col("first") >= 0.7).alias("top1"), share(F.col("any") >= 0.7).alias("top3"), share(F.col("first")).alias("mean_f1"), share(F.col("words").between(2, 12)).alias("binder_shaped"), share(F.col("presentability")).alias("presentability"), one(F.col("words")).alias("mean_words"), one(F.col("candidates")).alias("mean_candidates"))


@query(Q.chain(Q.SPANS, Q.UNITS, Q.EDGES) + "SELECT document_id, count(DISTINCT a) AS words, CAST(count_if(a <> b) AS BIGINT) AS edges FROM edges GROUP BY document_id")
def textrank_graph_stats(spark, sf_dir):
    return I.word_edges(texts(spark, sf_dir)).groupBy("document_id").agg(F.count_distinct("a").alias("words"), F.count_if(F.col("a") != F.col("b")).alias("edges"))
