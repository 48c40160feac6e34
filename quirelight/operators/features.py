"""The feature matrix of units and the title that a document's units elect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirelight import contracts
from quirelight.functions import text as T
from quirelight.storage import stored

C = contracts.load("identity")
RANKED = 5
LAYOUT = ("font_rank", "center_score", "bold_flag", "uppercase_ratio")


def sizes(units: DataFrame) -> DataFrame:
    """document_id, size, mass, share: characters by half-point size."""
    by = units.groupBy("document_id", (F.rint(F.col("font_size") * 2) / 2).alias("size")).agg(F.sum(F.greatest(F.length("text"), F.lit(1))).alias("mass"))
    return by.withColumn("share", F.col("mass") / F.sum("mass").over(Window.partitionBy("document_id")))


def typography(units: DataFrame) -> DataFrame:
    """document_id, baseline (the size of most characters, the smaller of equals), contrast, flat."""
    best = F.max_by("size", F.struct("mass", -F.col("size")))
    out = sizes(units).groupBy("document_id").agg(best.alias("baseline"), (F.least(F.count_if(F.col("share") >= 0.05), F.lit(4)) / 4).alias("contrast"))
    return out.withColumn("flat", F.col("contrast") <= 0.25)


def sized(units: DataFrame) -> DataFrame:
    """units with their document's typography(), by windows over its units alone, so that they are made and met once."""
    size, mass = F.rint(F.col("font_size") * 2) / 2, F.greatest(F.length("text"), F.lit(1))
    whole = Window.partitionBy("document_id")
    own = Window.partitionBy("document_id", "ty_size")
    rows = units.withColumn("ty_size", size).withColumn("ty_mass", F.sum(mass).over(own)).withColumn("ty_first", F.row_number().over(own.orderBy("ord")) == 1)
    rows = rows.withColumn("ty_all", F.sum(mass).over(whole))
    often = F.col("ty_first") & (F.col("ty_mass") / F.col("ty_all") >= 0.05)
    best = F.max(F.struct("ty_mass", (-F.col("ty_size")).alias("less"))).over(whole)
    rows = rows.withColumn("ty_best", best).withColumn("contrast", F.least(F.count_if(often).over(whole), F.lit(4)) / 4)
    return rows.withColumn("baseline", -F.col("ty_best")["less"]).withColumn("flat", F.col("contrast") <= 0.25).drop("ty_size", "ty_mass", "ty_first", "ty_all", "ty_best")


def levels(units: DataFrame) -> DataFrame:
    """document_id, size, level: h1 to h4 for the four largest sizes above the baseline with enough text, outlier for
    others above it, body for the rest."""
    rows = sizes(units).join(typography(units), "document_id")
    above = F.col("size") > F.col("baseline")
    heading = above & ((F.col("share") >= 0.03) | (F.col("mass") >= 14))
    rank = F.sum(heading.cast("int")).over(Window.partitionBy("document_id").orderBy(F.desc("size")))
    level = F.when(heading & (F.col("rank") <= 4), F.concat(F.lit("h"), F.col("rank"))).when(above, "outlier").otherwise("body")
    return rows.withColumn("rank", rank).select("document_id", "size", level.alias("level"))


def matrix(units: DataFrame, unnamed: bool = False) -> DataFrame:
    """units with their features; those without a document only if unnamed is set. A unit's size is compared with its document, its place with its page and the page's
    median gap between lines (median_gap), its page with the first of its segment (segment_start, else 1)."""
    for name, default in (("median_gap", F.lit(None).cast("double")), ("modality", F.lit("native")), ("segment_start", F.lit(1))):
        if name not in units.columns:
            units = units.withColumn(name, default)
    page = Window.partitionBy("document_id", "page").orderBy("y", "x", "ord")
    whole = Window.partitionBy("document_id", "page")
    order = Window.partitionBy("document_id", F.lower(F.regexp_replace(T.normalized(F.col("text")), r"\d", "#"))).orderBy("ord")
    pw, ph = F.coalesce(F.nullif("page_width", F.lit(0.0)), F.lit(612.0)), F.coalesce(F.nullif("page_height", F.lit(0.0)), F.lit(792.0))
    clamp = lambda x: F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))
    r4 = lambda x: T.rounded(x, 4)
    rows = units.withColumn("before", F.col("y") - F.lag("y").over(page)).withColumn("after", F.lead("y").over(page) - F.col("y")).withColumn("on_page", F.count("*").over(whole))
    rows = sized(rows if unnamed else rows.where("document_id is not null"))
    determined = (F.col("on_page") >= 3) & (F.coalesce("median_gap", F.lit(0.0)) > 0)
    top = r4(clamp(F.col("y") / ph))
    isolation = r4(F.least((F.coalesce(F.col("before") / F.col("median_gap"), F.lit(2.0)) + F.coalesce(F.col("after") / F.col("median_gap"), F.lit(2.0))) / 4, F.lit(1.0)))
    text = F.col("text")
    return rows.select(
        *units.columns,
        "flat",
        r4(F.least(F.col("font_size") / F.col("baseline"), F.lit(2.5)) / 2.5).alias("font_rank"),
        top.alias("top_ratio"),
        F.when(top < 0.10, "header").when(top > 0.90, "footer").otherwise("body").alias("zone"),
        r4(F.greatest(F.lit(0.0), 1 - F.abs(F.col("x") + F.col("width") / 2 - pw / 2) / (0.25 * pw))).alias("center_score"),
        r4(F.least(F.col("width") * F.col("height") / (pw * ph), F.lit(1.0))).alias("block_area"),
        r4(clamp(F.col("x") / pw)).alias("left_indent"),
        F.when(F.col("modality") != "ocr", F.col("bold").cast("int").cast("double")).alias("bold_flag"),
        T.uppercase_ratio(text).alias("uppercase_ratio"),
        T.digit_ratio(text).alias("digit_ratio"),
        F.size(F.split(text, " ")).alias("word_count"),
        (F.col("page") - F.col("segment_start") + 1).alias("page_in_segment"),
        text.rlike(T.IDENTIFIER).alias("identifier"),
        text.rlike(T.DATE).alias("date"),
        T.is_noise(text).alias("noise"),
        F.when(determined, isolation).otherwise(F.lit(0.5)).alias("whitespace_isolation"),
        (~determined).alias("isolation_imputed"),
        (F.row_number().over(order) == 1).cast("int").cast("double").alias("first_occurrence"),
    )


def eligibility(features: DataFrame) -> DataFrame:
    """Adds reasons: why a unit cannot be the title; none means that it can."""
    f = F.col
    checks = (("too_few_words", f("word_count") < 2), ("too_many_words", f("word_count") > 28), ("noise_pattern", f("noise")), ("footer_zone", f("zone") == "footer"), ("digit_heavy", f("digit_ratio") > 0.55))
    fails = F.filter(F.array(*[F.when(c, n) for n, c in checks]), lambda x: x.isNotNull())
    return features.withColumn("reasons", F.when(F.length("text") < 8, F.array(F.lit("too_short"))).otherwise(fails))


def _terms(rows: DataFrame) -> tuple[list, list]:
    """What a score adds up, in order: (name, value, weight, contribution) of each feature, and (name, weight, condition) of
    each penalty."""
    terms, f, p = [], F.col, C["title_penalties"]
    for name, weight in C["title_weights"].items():
        w = F.when(F.col("flat"), weight * C["flat_damping"]).otherwise(weight) if name in LAYOUT else F.lit(weight)
        terms.append((name, F.col(name), w, T.rounded(F.col(name) * w, 4)))
    rules = (
        ("not_first_page", f("page_in_segment") > 1),
        ("identifier", f("identifier")),
        ("date", f("date") & (f("word_count") <= 6)),
        ("digit_heavy", f("digit_ratio") > 0.30),
        ("all_caps_long", (f("uppercase_ratio") > 0.9) & (f("word_count") > 8)),
    )
    return terms, [(name, p[name], condition) for name, condition in rules]


def title_scores(features: DataFrame) -> DataFrame:
    """Adds score: weighted features in order, each rounded, then penalties; null for those that are not eligible. A
    feature that was not measured adds nothing."""
    rows = eligibility(features).withColumn("top_ratio_inverted", 1 - F.col("top_ratio"))
    terms, penalties = _terms(rows)
    total = F.lit(0.0)
    for _, _, _, contribution in terms:
        total = total + F.coalesce(contribution, F.lit(0.0))
    for _, weight, condition in penalties:
        total = total + F.when(condition, weight).otherwise(0.0)
    return rows.withColumn("score", F.when(F.size("reasons") == 0, T.rounded(total, 4)))


def title_contributions(scores: DataFrame) -> Column:
    """What adds up to each row's score: feature, value, weight, contribution. A feature that was not measured has a null
    value, its whole weight and no contribution; penalties come if they apply, with a value of 1."""
    terms, penalties = _terms(scores)
    entry = lambda name, value, weight, contribution: F.struct(F.lit(name).alias("feature"), value.cast("double").alias("value"), weight.cast("double").alias("weight"), contribution.alias("contribution"))
    parts = [entry(n, v, F.when(v.isNull(), C["title_weights"][n]).otherwise(T.rounded(w, 4)), F.coalesce(c, F.lit(0.0))) for n, v, w, c in terms]
    parts += [F.when(condition, entry(n, F.lit(1.0), F.lit(w), F.lit(w))) for n, w, condition in penalties]
    return F.array_compact(F.array(*parts))


def titles(scores: DataFrame) -> DataFrame:
    """document_id, title, candidate, ord, score, margin, confidence, ranking (the best five: ord, score, text). Below the
    margin the title is null."""
    order = Window.partitionBy("document_id").orderBy(F.desc("score"), "page_in_segment", "top_ratio", "left_indent", "ord")
    # nulls come last; the test for them follows the ranking, as one before it would be pushed below the columns that the
    # score is made from, and repeat them all
    ranked = scores.withColumn("rank", F.row_number().over(order)).where((F.col("rank") <= RANKED) & F.col("score").isNotNull())
    best = ranked.groupBy("document_id").agg(F.sort_array(F.collect_list(F.struct("rank", "ord", "score", "text"))).alias("b"))
    first, second = F.get("b", 0), F.get("b", 1)
    best = best.withColumn("margin", T.rounded(F.coalesce(first["score"] - second["score"], first["score"]), 4))
    state = F.when(F.col("margin") >= C["auto_margin"], "auto").when(F.col("margin") >= C["review_margin"], "review").otherwise("escalate")
    best = best.withColumn("confidence", state)
    ranking = F.transform("b", lambda x: F.struct(x["ord"].alias("ord"), x["score"].alias("score"), F.left(x["text"], F.lit(90)).alias("text")))
    return best.select("document_id", F.when(F.col("confidence") != "escalate", first["text"]).alias("title"), first["text"].alias("candidate"), first["ord"].alias("ord"), first["score"].alias("score"), "margin", "confidence", ranking.alias("ranking"))


def title_records(scores: DataFrame) -> DataFrame:
    """A record for each document, also where no unit can be its title: what titles() gives, with the elected unit's
    span_ids and contributions, how many units there are and how many are excluded, whether its sizes are flat, the reason
    where there is no candidate, and the versions of what decided. Excluded units are rows of excluded_units(), as a
    document may have any number of them."""
    judged = scores.withColumn("span_ids", F.lit(None).cast("array<int>")) if "span_ids" not in scores.columns else scores
    judged = stored(judged, "title-scores")  # read three times
    whole = judged.groupBy("document_id").agg(F.count("*").alias("units"), F.count_if(F.size("reasons") > 0).alias("excluded"), F.bool_or("flat").alias("flat"))
    won = judged.where("score is not null").select(F.col("document_id").alias("w_document"), F.col("ord").alias("w_ord"), "span_ids", title_contributions(judged).alias("contributions"))
    best = titles(judged)
    best = best.join(won, (F.col("document_id") == F.col("w_document")) & (F.col("ord") == F.col("w_ord"))).drop("w_document", "w_ord")
    found = F.col("candidate").isNotNull()
    versions = F.create_map(*[F.lit(x) for kv in sorted(contracts.versions().items()) for x in kv])
    return whole.join(best, "document_id", "left").select(
        "document_id", F.lit("TITLE").alias("role"), "title", "candidate", "ord", "span_ids", "score", "margin", F.coalesce("confidence", F.lit("escalate")).alias("confidence"),
        F.when(~found, "no eligible candidate").alias("reason"), "contributions", "ranking", "units", "excluded", "flat", versions.alias("contract_versions"),
    )


def excluded_units(scores: DataFrame) -> DataFrame:
    """document_id, ord, text (80 characters), reasons: the units that can't be titles."""
    return scores.where(F.size("reasons") > 0).select("document_id", "ord", F.left("text", F.lit(80)).alias("text"), "reasons")


def by_segment(units: DataFrame, segments: DataFrame, heads: DataFrame) -> DataFrame:
    """The units of each segment's head pages as a document of their own: document_id gets the segment's number, and
    segment_start is the segment's first page."""
    start = segments.select(F.col("document_id").alias("s_document"), F.col("segment_index").alias("s_index"), F.col("start_page").alias("segment_start"))
    head = heads.select(F.col("document_id").alias("h_document"), "segment_index", F.col("page").alias("h_page"))
    head = head.join(start, (F.col("h_document") == F.col("s_document")) & (F.col("segment_index") == F.col("s_index")))
    rows = units.join(head, (F.col("document_id") == F.col("h_document")) & (F.col("page") == F.col("h_page")))
    return rows.select(F.concat("document_id", F.lit("#"), F.col("segment_index").cast("string")).alias("document_id"), *[c for c in units.columns if c != "document_id"], "segment_start")


def token_f1(a: F.Column, b: F.Column) -> F.Column:
    common, total = F.size(F.array_intersect(a, b)), F.size(a) + F.size(b)
    return F.when(common > 0, 2.0 * common / total).otherwise(0.0)
