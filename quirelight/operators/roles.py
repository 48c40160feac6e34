"""Roles of a document's units, assigned jointly: a unit has one role at most and a role one unit at most, and the sum of
the scores is the largest there is."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirelight.operators import features as M
from quirelight.operators import pleading as P
from quirelight.storage import stored

#: The roles, and patterns of courts, exhibits, parties and issuing bodies.
ROLES = ("case", "court", "title", "exhibit", "date", "identifier", "source")
COURT = r"(?i)\b(?:superior|district|circuit|supreme)\s+court\b|\bcourt\s+of\s+(?:appeals|claims)\b|\bin\s+the\b.*\bcourt\b"
EXHIBIT = r"(?i)\b(?:exhibit|ex\.|attachment|appendix)\s+[a-z0-9]{1,4}\b"
PARTY_ROLE = r"(?i)\b(?:plaintiff|defendant|appellant|appellee|petitioner|respondent|movant|claimant)s?\b"
SOURCE = r"(?:\b(?:Inc\.|LLC|Ltd\.|Corp\.|Corporation|Company|Association|Foundation|University|Hospital|Bank|Department|Bureau|Agency|Administration|Ministry)\s*$)|\bOffice of\b|\bU\.S\. [A-Z]"
#: What a mark is worth beside the title's score, and how much less by the place on the page (units of a ten-thousandth).
MARK, SHORT, ABOVE, FURTHER = 30000, 5000, 5000, 12000
SHORT_WORDS = 6


def marks(units: DataFrame) -> DataFrame:
    """The feature matrix with marks of roles: caption (of the unit that begins one), court, exhibit, party_role, source."""
    found = P.captions(units).groupBy(F.col("document_id").alias("c_document"), F.col("ord").alias("c_ord")).agg(F.lit(True).alias("caption"))
    rows = M.title_scores(M.matrix(units)).join(found, (F.col("document_id") == F.col("c_document")) & (F.col("ord") == F.col("c_ord")), "left").drop("c_document", "c_ord")
    text = F.col("text")
    return rows.withColumns({"caption": F.coalesce("caption", F.lit(False)), "court": text.rlike(COURT), "exhibit": text.rlike(EXHIBIT), "party_role": text.rlike(PARTY_ROLE), "source": text.rlike(SOURCE)})


def role_scores(marked: DataFrame) -> DataFrame:
    """document_id, page, y, x, ord, role, score (a whole number, above 0) of each unit for each role that it could have."""
    short = F.when(F.col("word_count") <= SHORT_WORDS, SHORT).otherwise(0)
    place = F.floor((1 - F.col("top_ratio")) * ABOVE + 0.5) - F.when(F.col("page_in_segment") > 1, FURTHER).otherwise(0)
    mark = lambda c, extra=F.lit(0): F.when(c, (F.lit(MARK) + extra + place).cast("int"))
    f = F.col
    scores: dict[str, Column] = {
        "case": mark(f("caption")),
        "court": mark(f("court")),
        "title": F.floor(f("score") * 10000 + 0.5).cast("int"),
        "exhibit": mark(f("exhibit"), short),
        "date": mark(f("date"), short),
        "identifier": mark(f("identifier"), short),
        "source": mark(f("source")),
    }
    each = F.explode(F.array(*[F.struct(F.lit(r).alias("role"), scores[r].alias("score")) for r in ROLES])).alias("e")
    return marked.select("document_id", "page", "y", "x", "ord", each).select("document_id", "page", "y", "x", "ord", "e.role", "e.score").where("score > 0")


def candidates(scores: DataFrame) -> DataFrame:
    """The best units of each role, as many as there are roles: the others can't be needed, as at most that many less one
    are taken by other roles. Adds place: the unit's rank in the total order page, y, x, ord."""
    best = Window.partitionBy("document_id", "role").orderBy(F.desc("score"), "page", "y", "x", "ord")
    kept = scores.withColumn("k", F.row_number().over(best)).where(F.col("k") <= len(ROLES)).drop("k")
    return kept.withColumn("place", F.dense_rank().over(Window.partitionBy("document_id").orderBy("page", "y", "x", "ord")))


def solve(options: list[tuple[int, str, int]]) -> dict[str, int]:
    """options: place, role, score. The unit's place of each role in the assignment of the largest sum; of equal ones that
    whose places are the first, role by role, an empty role last. By unit, over the sets of roles that are filled."""
    last = 1 + max((p for p, _, _ in options), default=0)
    best: dict[int, tuple[int, tuple[int, ...]]] = {0: (0, (-last,) * len(ROLES))}
    for place in sorted({p for p, _, _ in options}):
        own = [(ROLES.index(r), s) for p, r, s in options if p == place]
        for filled, (total, places) in list(best.items()):
            for r, s in own:
                if not filled >> r & 1:
                    found = total + s, (*places[:r], -place, *places[r + 1 :])
                    best[filled | 1 << r] = max(best.get(filled | 1 << r, found), found)
    _, places = max(best.values())
    return {r: -p for r, p in zip(ROLES, places, strict=True) if -p != last}


def assigned(scores: DataFrame) -> DataFrame:
    """document_id, role, ord, score of role_scores(): one solution a document, from at most 49 candidates."""

    def one(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        chosen = solve([(r["place"], r["role"], r["score"]) for r in rows])
        return pa.Table.from_pylist([{"document_id": r["document_id"], "role": r["role"], "ord": r["ord"], "score": r["score"]} for r in rows if chosen.get(r["role"]) == r["place"]], schema)

    schema = pa.schema([("document_id", pa.string()), ("role", pa.string()), ("ord", pa.int32()), ("score", pa.int32())])
    return candidates(scores).select("document_id", "place", "ord", "role", "score").groupBy("document_id").applyInArrow(one, "document_id string, role string, ord int, score int")


def roles(units: DataFrame) -> DataFrame:
    """document_id, role, ord, score, text: the units that were given roles. Which mode a document has shows in which roles
    are filled: none is mandatory."""
    units = stored(units, "role-units")
    found = assigned(role_scores(marks(units)))
    text = units.select(F.col("document_id").alias("t_document"), F.col("ord").alias("t_ord"), "text")
    return found.join(text, (F.col("document_id") == F.col("t_document")) & (F.col("ord") == F.col("t_ord"))).select("document_id", "role", "ord", "score", "text")
