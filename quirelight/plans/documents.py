"""Queries over compounds: the census, seams, segments and their evaluation."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelight import contracts
from quirelight.operators import census as N
from quirelight.operators import segment as S
from quirelight.operators import term_deltas
from quirelight.plans import sql_labels
from quirelight.plans import sql_segments as Q
from quirelight.sources import compounds
from quirelight.storage import shared_folder, stored
from quirelight.streaming.seams import seams_stream

QUERIES, ORACLES = {}, {}
POLICIES = tuple(contracts.load("segmentation")["policies"])


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle is not None:
            ORACLES[f.__name__] = oracle
        return f

    return add


def stamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compounds.stamped_pages(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def measured(spark, sf_dir):
    return N.measure(stamped(spark, sf_dir))


def census(spark, sf_dir):
    return N.census(stamped(spark, sf_dir))


def kept_census(spark, sf_dir):
    """What seams and segments read of the census, written once for queries that read it several times."""
    return stored(census(spark, sf_dir).select("document_id", "page", *S.SIDES), "census")


def scores(spark, sf_dir):
    return S.scored(S.signals(S.seams(census(spark, sf_dir))))


def decisions(spark, sf_dir, policy="balanced"):
    return S.decided(scores(spark, sf_dir), policy)


STATS = "document_id, page, char_count, word_count, line_count, modality, is_blank, is_spacer, is_slip_sheet, ends_mid_sentence, starts_lowercase"


@query(Q.chain(*Q.PAGES) + f"SELECT {STATS} FROM slips")
def census_page_stats(spark, sf_dir):
    return measured(spark, sf_dir).select(*STATS.split(", "))


@query(Q.chain(*Q.PAGES) + "SELECT size_class, orientation, count(*) AS pages FROM slips GROUP BY ALL")
def census_size_class(spark, sf_dir):
    return measured(spark, sf_dir).groupBy("size_class", "orientation").agg(F.count("*").alias("pages"))


@query(
    Q.chain(*Q.PAGES)
    + """SELECT array_to_string(font_families, ',') AS families, CASE lang WHEN 'en' THEN 'serif' WHEN 'fr' THEN 'sans' WHEN 'de' THEN 'mono' ELSE 'sans,serif' END AS classes, count(*) AS pages FROM slips GROUP BY ALL"""
)
def census_font_class(spark, sf_dir):
    return measured(spark, sf_dir).groupBy(F.array_join("font_families", ",").alias("families"), F.array_join("font_classes", ",").alias("classes")).agg(F.count("*").alias("pages"))


@query(Q.chain(*Q.PAGES) + "SELECT document_id, page, header_sig, footer_sig FROM slips")
def census_edge_signature(spark, sf_dir):
    return measured(spark, sf_dir).select("document_id", "page", "header_sig", "footer_sig")


@query(Q.chain(*Q.PAGES, Q.TOKENS) + "SELECT document_id, page, array_to_string(tokens, ' ') AS tokens FROM tokens")
def census_content_tokens(spark, sf_dir):
    return N.content_tokens(measured(spark, sf_dir)).select("document_id", "page", F.array_join("tokens", " ").alias("tokens"))


@query(Q.chain(*Q.UP_TO_SERIES) + "SELECT document_id, prefix, digits, first, last, page_count, array_to_string(pages, ',') AS pages FROM series")
def census_stamp_series(spark, sf_dir):
    return N.stamp_series(measured(spark, sf_dir)).select("document_id", "prefix", "digits", "first", "last", "page_count", F.array_join(F.transform("pages", lambda x: x.cast("string")), ",").alias("pages"))


@query(Q.chain(*Q.PAGES) + "SELECT document_id, page, label_num, label_total FROM slips WHERE label_num IS NOT NULL")
def census_page_labels(spark, sf_dir):
    return measured(spark, sf_dir).where("label_num is not null").select("document_id", "page", "label_num", "label_total")


@query(Q.chain(*Q.PAGES) + "SELECT document_id, page, text_head, text_sha FROM slips")
def census_text_hash(spark, sf_dir):
    return measured(spark, sf_dir).select("document_id", "page", "text_head", "text_sha")


@query("SELECT doc_id, substr(sha256(coalesce(text, '')), 1, 16) AS content_id FROM documents")
def census_content_id(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select("doc_id", F.substring(F.sha2(F.coalesce("text", F.lit("")), 256), 1, 16).alias("content_id"))


@query(Q.chain(*Q.UP_TO_CENSUS, Q.SEAMS) + "SELECT document_id, before_page, s.name AS name, s.weight AS weight FROM (SELECT document_id, before_page, unnest(signals) AS s FROM seams)")
def seam_signals_long(spark, sf_dir):
    return S.signals(S.seams(census(spark, sf_dir))).select("document_id", "before_page", F.inline("signals"))


@query(Q.chain(*Q.UP_TO_SCORES) + "SELECT document_id, before_page, score, change_score, strong FROM scores")
def seam_scores(spark, sf_dir):
    return scores(spark, sf_dir).select("document_id", "before_page", "score", "change_score", "strong")


@query(Q.chain(*Q.UP_TO_CENSUS, Q.SEAMS) + "SELECT DISTINCT document_id, floor(vocab_median * 1e6 + 0.5) / 1e6 AS vocab_median FROM seams")
def seam_vocab_median(spark, sf_dir):
    return S.seams(census(spark, sf_dir)).select("document_id", (F.floor(F.col("vocab_median") * 1e6 + 0.5) / 1e6).alias("vocab_median")).distinct()


DECISION = "document_id, before_page, score, change_score, is_cut, is_candidate, suppressed"
for _policy in POLICIES:
    ORACLES[f"seam_decisions_{_policy}"] = Q.chain(*Q.up_to_decisions(_policy)) + f"SELECT {DECISION} FROM decisions"
    QUERIES[f"seam_decisions_{_policy}"] = lambda spark, sf_dir, p=_policy: decisions(spark, sf_dir, p).select(*DECISION.split(", "))


@query(Q.chain(*Q.up_to_decisions()) + "SELECT document_id, before_page, suppressed FROM decisions WHERE suppressed IS NOT NULL")
def seam_candidates_suppressed(spark, sf_dir):
    return decisions(spark, sf_dir).where("suppressed is not null").select("document_id", "before_page", "suppressed")


@query(Q.chain(*Q.UP_TO_SCORES) + "SELECT document_id, before_page, score FROM scores WHERE score >= 0.7 AND score < 1.5")
def refine_band(spark, sf_dir):
    return S.refine_band(scores(spark, sf_dir)).select("document_id", "before_page", "score")


SEGMENT = "document_id, segment_index, start_page, end_page, page_count, opened_by, score"


@query(Q.chain(*Q.up_to_decisions(), Q.SEGMENTS) + f"SELECT {SEGMENT} FROM segments")
def segments_raw(spark, sf_dir):
    c = kept_census(spark, sf_dir)
    return S.segments(S.decided(S.scored(S.signals(S.seams(c)))), c).select(*SEGMENT.split(", "))


def final_segments(spark, sf_dir, policy="aggressive"):
    c = kept_census(spark, sf_dir)
    return S.rejoined(S.segments(S.decided(S.scored(S.signals(S.seams(c))), policy), c), c), c


@query(Q.chain(*Q.up_to_decisions("aggressive"), Q.SEGMENTS, Q.REJOINED) + "SELECT document_id, segment_index, start_page, end_page, page_count, opened_by, score, inserts FROM rejoined")
def segments_rejoined(spark, sf_dir):
    inserts = F.array_join(F.transform("reabsorbed", lambda x: F.concat_ws("-", x["start_page"], x["end_page"])), ",").alias("inserts")
    return final_segments(spark, sf_dir)[0].select("document_id", "segment_index", "start_page", "end_page", "page_count", "opened_by", "score", inserts)


@query(Q.chain(*Q.UP_TO_SCORES, Q.REFINED) + "SELECT document_id, before_page, score, change_score, strong, refined FROM refined WHERE refined")
def seam_scores_refined(spark, sf_dir):
    """The seams whose pages' font sizes were compared."""
    pages = stamped(spark, sf_dir)
    histograms = S.histogram(compounds.page_spans(pages), ["document_id", "page"])
    return S.refined(S.seams(N.census(pages)), histograms).where("refined").select("document_id", "before_page", "score", "change_score", "strong", "refined")


@query(
    Q.chain(*Q.up_to_decisions(), Q.SEGMENTS)
    + """SELECT g.document_id, segment_index, CAST(unnest(range(start_page, least(end_page, start_page + 1 + CAST(is_slip_sheet AS INTEGER)) + 1)) AS INTEGER) AS page
FROM segments g JOIN census c ON c.document_id = g.document_id AND c.page = g.start_page"""
)
def segment_head_pages(spark, sf_dir):
    c = kept_census(spark, sf_dir)
    return S.head_pages(S.segments(S.decided(S.scored(S.signals(S.seams(c)))), c), c)


@query(
    Q.chain(*Q.up_to_decisions(), Q.SEGMENTS)
    + """SELECT g.document_id, CASE WHEN n.start_page IS NULL THEN g.start_page - 1 ELSE n.start_page END AS at, CASE WHEN n.start_page IS NULL THEN 'end' ELSE 'gap' END AS violation
FROM segments g LEFT JOIN segments n ON n.document_id = g.document_id AND n.segment_index = 3 WHERE g.segment_index = 2"""
)
def segment_tiling_violations(spark, sf_dir):
    """What validation finds where each document's second segment is taken away: exactly the hole that it leaves."""
    c = kept_census(spark, sf_dir)
    found = S.segments(S.decided(S.scored(S.signals(S.seams(c)))), c)
    return S.tiling_violations(found.where("segment_index <> 2"), c)


@query(
    Q.chain(*Q.up_to_decisions(), Q.SEGMENTS)
    + """SELECT t.document_id, total, (SELECT count(*) FROM segments g WHERE g.document_id = t.document_id) AS segments, CAST(count_if(is_cut) AS BIGINT) AS cuts, CAST(count_if(is_candidate) AS BIGINT) AS candidates
FROM totals t LEFT JOIN decisions d USING (document_id) GROUP BY t.document_id, total"""
)
def segment_stats(spark, sf_dir):
    c = kept_census(spark, sf_dir)
    d = S.decided(S.scored(S.signals(S.seams(c))))
    counts = d.groupBy("document_id").agg(F.count_if("is_cut").alias("cuts"), F.count_if("is_candidate").alias("candidates"))
    return c.groupBy("document_id").agg(F.max("page").alias("total")).join(counts, "document_id", "left").join(S.segments(d, c).groupBy("document_id").agg(F.count("*").alias("segments")), "document_id").select("document_id", "total", "segments", F.coalesce("cuts", F.lit(0)).alias("cuts"), F.coalesce("candidates", F.lit(0)).alias("candidates"))


@query(Q.chain(*Q.up_to_decisions(), Q.TRUTH, Q.evaluation("", "")))
def eval_seams_overall(spark, sf_dir):
    return S.evaluation(decisions(spark, sf_dir), compounds.truth(stamped(spark, sf_dir)), [])


@query(Q.chain(*Q.up_to_decisions(), Q.TRUTH, Q.evaluation("GROUP BY GROUPING SETS ((), (difficulty), (scenario))", "difficulty, scenario,")))
def eval_seams_by_group(spark, sf_dir):
    return S.evaluation(decisions(spark, sf_dir), compounds.truth(stamped(spark, sf_dir)), ["difficulty", "scenario"])


@query(Q.chain(Q.SINGLES, *Q.up_to_decisions()[1:]) + "SELECT count(DISTINCT t.document_id) AS documents, CAST(count_if(is_cut) AS BIGINT) AS false_cuts, CAST(count_if(is_candidate) AS BIGINT) AS candidates FROM (SELECT DISTINCT document_id FROM census) t LEFT JOIN decisions d ON d.document_id = t.document_id")
def eval_negative_controls(spark, sf_dir):
    """Cuts and candidates in documents without a seam."""
    c = N.census(compounds.stamped_pages(compounds.singles(spark.read.parquet(f"{sf_dir}/documents.parquet"))))
    found = S.decided(S.scored(S.signals(S.seams(c)))).agg(F.count_if("is_cut").alias("false_cuts"), F.count_if("is_candidate").alias("candidates"))
    return c.agg(F.count_distinct("document_id").alias("documents")).crossJoin(found)  # one row each


@query(Q.chain(*Q.UP_TO_SCORES) + " UNION ALL ".join(f"SELECT '{p}' AS policy, CAST(count_if(score >= {t} AND strong) AS BIGINT) AS cuts, CAST(count_if(NOT (score >= {t} AND strong) AND change_score >= 0.7) AS BIGINT) AS candidates FROM scores" for p, t in contracts.load("segmentation")["policies"].items()))
def policy_sweep(spark, sf_dir):
    # one pass: every seam meets three thresholds
    policies = F.array(*[F.struct(F.lit(p).alias("policy"), F.lit(float(t)).alias("threshold")) for p, t in contracts.load("segmentation")["policies"].items()])
    rows = scores(spark, sf_dir).select("score", "change_score", "strong", F.inline(policies))
    cut = (F.col("score") >= F.col("threshold")) & F.col("strong")
    return rows.groupBy("policy").agg(F.count_if(cut).alias("cuts"), F.count_if(~cut & (F.col("change_score") >= 0.7)).alias("candidates"))


@query(
    """SELECT source AS document_id, CAST(row_number() OVER w AS INTEGER) AS part, lang, pages, CAST(sum(pages) OVER w - pages + 1 AS INTEGER) AS start_page, CAST(sum(pages) OVER w AS INTEGER) AS end_page
FROM (SELECT source, lang, CAST(count(*) AS INTEGER) AS pages FROM documents WHERE source IS NOT NULL GROUP BY source, lang) WINDOW w AS (PARTITION BY source ORDER BY lang)"""
)
def compound_parts(spark, sf_dir):
    return compounds.parts(spark.read.parquet(f"{sf_dir}/documents.parquet"))


@query(Q.chain(Q.DOC_PAGES) + "SELECT document_id, page, 'BATCH' || lpad(CAST(1000 + page - 1 AS VARCHAR), 6, '0') AS stamp FROM doc_pages")
def compound_stamps(spark, sf_dir):
    return compounds.stamps(compounds.doc_pages(spark.read.parquet(f"{sf_dir}/documents.parquet")), "BATCH", 1000)


@query(
    Q.chain(Q.DOC_PAGES, Q.STAMPED)
    + """SELECT CASE lang WHEN 'en' THEN 'ABCDEF+TimesNewRoman-Bold' WHEN 'fr' THEN 'Arial' WHEN 'de' THEN 'CourierNew' ELSE 'Arial,Italic,Georgia' END AS families, CAST(floor(width / 10) * 10 AS BIGINT) AS width, count(*) AS pages
FROM stamped GROUP BY ALL HAVING count(*) >= 10"""
)
def compound_producers(spark, sf_dir):
    return compounds.producers(stamped(spark, sf_dir), 10)


@query("SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS place FROM documents) WHERE (place - 1) % 7 = 0 AND place <= 70")
def systematic_sample(spark, sf_dir):
    return compounds.systematic(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id"), ["doc_id"], 7, 10)


@query(Q.chain(*Q.PAGES) + "SELECT document_id, page, char_count FROM slips WHERE page <= 2")
def first_pages(spark, sf_dir):
    return measured(spark, sf_dir).where("page <= 2").select("document_id", "page", "char_count")


@query(Q.chain(Q.CONVERSATIONS, *Q.up_to_decisions()[2:]).replace("FROM stamped", "FROM conversation_pages") + f"SELECT {DECISION} FROM decisions")
def conversation_seams(spark, sf_dir):
    """Conversations as documents, turns as pages, and the decisions at their seams."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    pages = turns.select(F.col("conv_id").cast("string").alias("document_id"), (F.col("turn") + 1).cast("int").alias("page"), F.col("text").alias("raw_text"), F.lit(612.0).alias("width"), F.lit(792.0).alias("height"), F.lit(0).alias("rotation"), F.lit(0).alias("image_count"), F.array(F.col("role")).alias("fonts"))
    return S.decided(S.scored(S.signals(S.seams(N.census(pages))))).select(*DECISION.split(", "))


def turn_pages(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return turns.select(F.col("conv_id").cast("string").alias("document_id"), (F.col("turn") + 1).cast("int").alias("page"), F.col("text").alias("raw_text"), F.lit(612.0).alias("width"), F.lit(792.0).alias("height"), F.lit(0).alias("rotation"), F.lit(0).alias("image_count"), F.array(F.col("role")).alias("fonts"))


@query(Q.chain(Q.CONVERSATIONS, *Q.up_to_decisions()[2:]).replace("FROM stamped", "FROM conversation_pages").replace("s.prefix IS NOT NULL AS in_series", "false AS in_series").replace("THEN median(vocab_overlap) END", "THEN NULL::DOUBLE END") + f"SELECT {DECISION} FROM decisions")
def stream_seams(spark, sf_dir):
    """Decisions of a stream of pages in shuffled files, less signals that need whole documents."""
    folder = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    pages = turn_pages(spark, sf_dir).withColumn("arrived", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    pages.withColumn("part", F.pmod(F.xxhash64("document_id", "page"), F.lit(4))).write.partitionBy("part").parquet(f"{folder}/pages")
    arriving = spark.readStream.schema(pages.schema).option("recursiveFileLookup", "true").parquet(f"{folder}/pages")
    found = seams_stream(arriving).select(*DECISION.split(", "))
    running = found.writeStream.format("parquet").option("path", f"{folder}/seams").option("checkpointLocation", f"{folder}/state").outputMode("append").trigger(availableNow=True).start()
    running.awaitTermination()
    return spark.read.schema(found.schema).parquet(f"{folder}/seams")


@query(
    Q.chain(*Q.UP_TO_SCORES, Q.REFINED, Q.decisions("balanced").replace("FROM scores)", "FROM refined)"), Q.SEGMENTS, Q.REJOINED)
    + """, compared AS (SELECT document_id, before_page AS page FROM refined WHERE refined UNION SELECT document_id, before_page - 1 FROM refined WHERE refined)
SELECT t.document_id, total, (SELECT count(*) FROM rejoined g WHERE g.document_id = t.document_id) AS segments, CAST(count_if(is_cut) AS BIGINT) AS cuts, CAST(count_if(is_candidate) AS BIGINT) AS candidates,
  (SELECT count(*) FROM compared c WHERE c.document_id = t.document_id) AS tier_b_pages, (SELECT CAST(coalesce(sum(CASE WHEN inserts = '' THEN 0 ELSE len(string_split(inserts, ',')) END), 0) AS BIGINT) FROM rejoined g WHERE g.document_id = t.document_id) AS reabsorbed
FROM totals t LEFT JOIN decisions d USING (document_id) GROUP BY t.document_id, total"""
)
def run_stats(spark, sf_dir):
    """A run's numbers by document: pages, segments after re-joining, cuts, candidates, pages whose font sizes were
    compared, and inserts that were re-joined."""
    pages = stored(stamped(spark, sf_dir), "run-pages")
    c = stored(N.census(pages).select("document_id", "page", *S.SIDES), "run-census")
    d = stored(S.decided(S.refined(S.seams(c), S.histogram(compounds.page_spans(pages), ["document_id", "page"]))).select(*DECISION.split(", "), "refined", "signals"), "run-decisions")
    count = lambda df, *e: df.groupBy(F.col("document_id").alias("n_document")).agg(*e)
    beside = d.where("refined").select("document_id", F.explode(F.array("before_page", F.col("before_page") - 1)).alias("page"))
    parts = (
        count(d, F.count_if("is_cut").alias("cuts"), F.count_if("is_candidate").alias("candidates")),
        count(S.rejoined(S.segments(d, c), c), F.count("*").alias("segments"), F.sum(F.size("reabsorbed")).alias("reabsorbed")),
        count(beside, F.count_distinct("page").alias("tier_b_pages")),
    )
    out = c.groupBy("document_id").agg(F.max("page").alias("total"))
    for part in parts:
        out = out.join(part, F.col("document_id") == F.col("n_document"), "left").drop("n_document")
    return out.select("document_id", "total", *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in ("segments", "cuts", "candidates", "tier_b_pages", "reabsorbed")])


@query(sql_labels.chain(sql_labels.IDF.replace("FROM benchmark WHERE item_id IS NOT NULL", "FROM (SELECT doc_id AS item_id, text FROM documents) WHERE item_id IS NOT NULL")) + "SELECT term, df, idf FROM idf")
def idf_incremental(spark, sf_dir):
    """The term table of all documents from four batches that come in any order, one of them twice."""
    folder = f"{shared_folder(spark)}/terms-{uuid.uuid4().hex}"
    corpus = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id is not null").select(F.col("doc_id").cast("string").alias("document_id"), F.coalesce("text", F.lit("")).alias("text"))
    for part in (2, 0, 3, 0, 1):
        term_deltas.add_delta(corpus.where(F.pmod(F.xxhash64("document_id"), F.lit(4)) == part), folder)
    return spark.read.parquet(f"{term_deltas.build_version(spark, folder, 'all')}/terms")
