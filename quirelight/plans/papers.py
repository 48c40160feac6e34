"""Queries over court papers made from conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from quirelight.operators import assemble as A
from quirelight.operators import features as M
from quirelight.operators import pleading as P
from quirelight.operators import roles as R
from quirelight.plans import sql_filings as G
from quirelight.plans import sql_labels as Q
from quirelight.sources import filings

QUERIES, ORACLES = {}, {}


def query(oracle: str):
    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, oracle
        return f

    return add


def spans(spark, sf_dir):
    return filings.spans(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def units(spark, sf_dir):
    return A.units(P.without_numbers(spans(spark, sf_dir)))


TO_UNITS = (G.FILINGS, G.NUMBERED, Q.UNITS)


@query(Q.chain(G.FILINGS) + "SELECT document_id, page, ord, text, x, y, font_size, bold FROM filing_spans")
def filing_spans(spark, sf_dir):
    return spans(spark, sf_dir).select("document_id", "page", "ord", "text", "x", "y", "font_size", "bold")


@query(Q.chain(G.FILINGS, G.NUMBERED) + "SELECT document_id, page, first, last, numbers, pitch FROM line_runs")
def line_number_runs(spark, sf_dir):
    return P.line_number_runs(spans(spark, sf_dir))


@query(Q.chain(*TO_UNITS, G.CAPTIONS) + "SELECT document_id, page, ord, last, plaintiff, defendant FROM captions")
def captions(spark, sf_dir):
    return P.captions(units(spark, sf_dir))


@query(Q.chain(*TO_UNITS, Q.TYPOGRAPHY, Q.FEATURES, Q.SCORES, G.CAPTIONS, G.ROLES) + "SELECT r.document_id, role, r.ord, r.score, text FROM roles r JOIN units u ON u.document_id = r.document_id AND u.ord = r.ord")
def roles(spark, sf_dir):
    return R.roles(units(spark, sf_dir))


@query(Q.chain(*TO_UNITS, Q.TYPOGRAPHY, Q.FEATURES) + "SELECT document_id, ord, text, identifier, date, noise FROM features")
def filing_flags(spark, sf_dir):
    """Identifiers, dates and noise among the units."""
    return M.matrix(units(spark, sf_dir)).select("document_id", "ord", "text", "identifier", "date", "noise")


@query(Q.chain(*TO_UNITS, Q.TYPOGRAPHY, Q.LEVELS) + "SELECT document_id, size, level FROM levels")
def filing_levels(spark, sf_dir):
    """Sizes of papers with five sizes and more."""
    return M.levels(units(spark, sf_dir))


@query(Q.chain(*TO_UNITS, Q.TYPOGRAPHY, Q.FEATURES, Q.SCORES, Q.TITLES) + "SELECT document_id, title, candidate, ord, score, margin, confidence FROM titles")
def filing_titles(spark, sf_dir):
    """Titles of papers, whose numbered margins are no candidates."""
    return M.titles(M.title_scores(M.matrix(units(spark, sf_dir)))).drop("ranking")


def title_scores(spark, sf_dir):
    return M.title_scores(M.matrix(units(spark, sf_dir)))


TO_TITLES = (*TO_UNITS, Q.TYPOGRAPHY, Q.FEATURES, Q.SCORES, Q.TITLES)


@query(Q.chain(*TO_TITLES, Q.TITLE_RECORDS) + "SELECT document_id, role, title, candidate, ord, span_ids, score, margin, confidence, reason, units, excluded, flat FROM records")
def title_records(spark, sf_dir):
    """The record of each paper's title, also where there is none."""
    out = M.title_records(title_scores(spark, sf_dir)).drop("contributions", "ranking", "contract_versions")
    return out.withColumn("span_ids", F.array_join(F.transform("span_ids", lambda x: x.cast("string")), ","))


@query(Q.chain(*TO_TITLES, Q.TITLE_CONTRIBUTIONS) + "SELECT document_id, feature, value, weight, contribution FROM contributions")
def title_contributions(spark, sf_dir):
    """What adds up to the score of each paper's title."""
    return M.title_records(title_scores(spark, sf_dir)).select("document_id", F.inline("contributions"))


@query(Q.chain(*TO_TITLES) + "SELECT document_id, ord, left(text, 80) AS text, array_to_string(reasons, ',') AS reasons FROM scores WHERE len(reasons) > 0")
def title_excluded(spark, sf_dir):
    """The units that can't be a paper's title, and why."""
    return M.excluded_units(title_scores(spark, sf_dir)).withColumn("reasons", F.array_join("reasons", ","))
