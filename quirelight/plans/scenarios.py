"""Queries over compounds of four scenarios, put together from conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from quirelight.operators import census as N
from quirelight.operators import segment as S
from quirelight.plans import sql_scenarios as G
from quirelight.plans import sql_segments as Q
from quirelight.plans.sql_scenarios import LONG, SEED
from quirelight.sources import scenarios
from quirelight.storage import stored

QUERIES, ORACLES = {}, {}


def query(oracle: str):
    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, oracle
        return f

    return add


def sources(spark, sf_dir):
    """Conversations as paged documents of three producers, every ninth of them scanned."""
    i = F.col("conv_id")
    scan, kin = F.pmod(i, F.lit(9)) == 4, F.pmod(i, F.lit(3))
    fonts = F.when(kin == 0, F.array(F.lit("ABCDEF+TimesNewRoman-Bold"))).when(kin == 1, F.array(F.lit("Arial"))).otherwise(F.array(F.lit("CourierNew"), F.lit("Arial,Italic")))
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    pages = turns.select(
        i.cast("string").alias("document_id"), F.col("turn").alias("page"), F.when(scan, "").otherwise(F.col("text")).alias("raw_text"), F.when(kin == 0, 612.0).otherwise(595.0).alias("width"),
        F.when(kin == 0, 792.0).otherwise(842.0).alias("height"), F.when(scan, F.array().cast("array<string>")).otherwise(fonts).alias("fonts"), F.lit(0).alias("rotation"), scan.cast("int").alias("image_count"),
    )
    return scenarios.distinct_pages(pages)


def compounds(spark, sf_dir):
    """The sources' pages, the parts and the compounds' pages."""
    pages = stored(sources(spark, sf_dir), "scenario-sources")
    found = stored(scenarios.parts(pages, SEED, LONG), "scenario-parts")
    return found, scenarios.compound_pages(found, pages)


PART = "document_id, scenario, slot, kind, source_id, pages, start_page, end_page, rotation, stamp_prefix, stamp_first"


@query(Q.chain(*G.PARTS) + f"SELECT {PART} FROM parts")
def scenario_parts(spark, sf_dir):
    return scenarios.parts(sources(spark, sf_dir), SEED, LONG)


@query(Q.chain(*G.PARTS, G.PAGES) + "SELECT document_id, page, raw_text, width, height, rotation, image_count, array_to_string(font_families, '|') AS fonts FROM compound_pages")
def scenario_pages(spark, sf_dir):
    names = F.array_sort(F.transform("fonts", lambda f: F.regexp_replace(F.regexp_replace(f, r"^[A-Z]{6}\+|,.*", ""), "-Bold$", "")))
    return compounds(spark, sf_dir)[1].withColumn("fonts", F.array_join(names, "|"))


@query(Q.chain(*G.PARTS, G.SEAMS) + "SELECT document_id, before_page, difficulty, scenario, reason FROM known_seams")
def scenario_seams(spark, sf_dir):
    return scenarios.seams(scenarios.parts(sources(spark, sf_dir), SEED, LONG))


def judged(spark, sf_dir):
    """The parts, and what the balanced policy, after re-joining, makes of the compounds."""
    found, pages = compounds(spark, sf_dir)
    c = N.census(stored(pages, "scenario-pages"))
    d = stored(S.decided(S.scored(S.signals(S.seams(c)))), "scenario-decisions")
    cuts = S.rejoined(S.segments(d, c), c).where("segment_index > 1").select("document_id", F.col("start_page").alias("before_page"))
    return found, S.outcomes(cuts, d.where("is_candidate"), scenarios.seams(found))


def by_document(spark, sf_dir):
    found, outcomes = judged(spark, sf_dir)
    return S.evaluation_by_document(outcomes, found.select("document_id", "scenario").distinct())


JUDGED = (*G.PARTS, G.PAGES, G.SEAMS, *G.DECIDED, Q.SEGMENTS, Q.REJOINED, G.OUTCOMES)


@query(Q.chain(*JUDGED, G.BY_DOCUMENT) + "SELECT document_id, scenario, true_seams, tp, fp, fn, recovered, missed FROM by_document")
def eval_scenario_documents(spark, sf_dir):
    """Each compound's outcomes, with the pages of seams that are candidates only and of those missed entirely."""
    pages = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c)
    return by_document(spark, sf_dir).select("document_id", "scenario", "true_seams", "tp", "fp", "fn", pages("recovered"), pages("missed"))


@query(Q.chain(*JUDGED) + G.BY_DIFFICULTY)
def eval_scenario_difficulty(spark, sf_dir):
    found, outcomes = judged(spark, sf_dir)
    return S.evaluation_by_difficulty(outcomes, scenarios.seams(found))


@query(Q.chain(*JUDGED, G.BY_DOCUMENT) + G.BY_SCENARIO)
def eval_scenarios(spark, sf_dir):
    """Outcomes by scenario; compounds without a seam are the controls, whose cuts are all false."""
    return S.evaluation_by_scenario(by_document(spark, sf_dir))
