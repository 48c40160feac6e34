"""Seams between pages: signals, scores, decisions, segments and their evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quirelight import contracts
from quirelight.functions import text as T

C = contracts.load("segmentation")
WEIGHTS, REVIEW_ONLY = C["weights"], C["review_only"]
#: Columns of a page that a seam compares.
SIDES = "modality size_class orientation width height label_num label_total font_families header_sig footer_sig rotation is_blank is_slip_sheet ends_mid_sentence starts_lowercase stamp_prefix stamp_number in_series tokens".split()

#: Conditions over the page before the seam (a_), the one after (b_), and p_header, the header before a's. Plain SQL.
BOTH_STAMPED = "(a_in_series AND b_in_series)"
BOTH_LABELLED = "(a_label_num IS NOT NULL AND b_label_num IS NOT NULL)"
RELATIVE = "abs(a_{0} - b_{0}) > {1} * greatest(a_{0}, b_{0})"
CONDITIONS: dict[str, str] = {
    "slip_sheet_ahead": "b_is_slip_sheet",
    "bates_prefix_change": f"{BOTH_STAMPED} AND a_stamp_prefix <> b_stamp_prefix",
    "bates_number_gap": f"{BOTH_STAMPED} AND a_stamp_prefix = b_stamp_prefix AND b_stamp_number - a_stamp_number <> 1",
    "modality_flip": "a_modality <> b_modality",
    "page_size_change": "a_orientation <> b_orientation OR a_size_class <> b_size_class OR (a_size_class = 'other' AND ("
    + RELATIVE.format("width", C["other_size_tolerance"])
    + " OR "
    + RELATIVE.format("height", C["other_size_tolerance"])
    + "))",
    "page_label_restart": f"{BOTH_LABELLED} AND (b_label_num <= a_label_num OR a_label_total <> b_label_total)",
    "font_family_change": f"font_overlap < {C['font_overlap_min']}",
    "running_header_change": "p_header IS NOT NULL AND a_header_sig <> '' AND b_header_sig <> '' AND p_header = a_header_sig AND a_header_sig <> b_header_sig",
    "vocabulary_change": f"vocab_median > 0 AND vocab_overlap <= {C['vocabulary_drop']} * vocab_median",
    "rotation_change": "a_rotation <> b_rotation",
    "blank_page": "a_is_blank",
    "slip_sheet_behind": "a_is_slip_sheet AND NOT b_is_slip_sheet",
    "running_header_match": "a_header_sig <> '' AND a_header_sig = b_header_sig",
    "running_header_alternates": "NOT (a_header_sig <> '' AND a_header_sig = b_header_sig) AND b_header_sig <> '' AND p_header IS NOT NULL AND b_header_sig = p_header",
    "running_footer_match": "a_footer_sig <> '' AND a_footer_sig = b_footer_sig AND a_footer_sig <> a_header_sig",
    "page_label_continues": f"{BOTH_LABELLED} AND b_label_num = a_label_num + 1 AND a_label_total = b_label_total",
    "bates_consecutive": f"{BOTH_STAMPED} AND a_stamp_prefix = b_stamp_prefix AND b_stamp_number - a_stamp_number = 1",
    "sentence_continuation": "a_ends_mid_sentence AND b_starts_lowercase",
}


def seams(census: DataFrame) -> DataFrame:
    """A row per pair of neighbouring pages, with overlaps and the document's median vocabulary overlap."""
    order = Window.partitionBy("document_id").orderBy("page")
    pairs = census.select("document_id", F.col("page").alias("a_page"), *[F.col(c).alias(f"a_{c}") for c in SIDES], F.lead(F.struct("page", *SIDES)).over(order).alias("b"), F.lag("header_sig").over(order).alias("p_header"))
    pairs = pairs.where("b is not null").select("*", F.col("b.page").alias("before_page"), *[F.col(f"b.{c}").alias(f"b_{c}") for c in SIDES]).drop("b")
    pairs = overlaps(pairs)
    whole = Window.partitionBy("document_id")
    median = F.when(F.count("vocab_overlap").over(whole) >= C["min_vocabulary_pairs"], F.expr("median(vocab_overlap)").over(whole))
    return pairs.withColumn("vocab_median", median)


def overlaps(pairs: DataFrame) -> DataFrame:
    """Adds font_overlap and vocab_overlap of the pages beside each seam."""
    enough = F.least(F.size("a_tokens"), F.size("b_tokens")) >= C["min_vocabulary_tokens"]
    return pairs.withColumn("font_overlap", T.overlap(F.col("a_font_families"), F.col("b_font_families"))).withColumn("vocab_overlap", F.when(enough, T.overlap(F.col("a_tokens"), F.col("b_tokens"))))


def signals(pairs: DataFrame, band: DataFrame | None = None) -> DataFrame:
    """Adds signals: the array of (name, weight) that fired, in order. band: document_id, before_page, l1 of font-size
    histograms of seams that were refined."""
    fired = [f"if({condition}, named_struct('name', '{name}', 'weight', {WEIGHTS[name]}D), null)" for name, condition in CONDITIONS.items()]
    if band is not None:
        other = band.select(F.col("document_id").alias("h_document"), F.col("before_page").alias("h_page"), "l1")
        pairs = pairs.join(other, (F.col("document_id") == F.col("h_document")) & (F.col("before_page") == F.col("h_page")), "left").drop("h_document", "h_page")
        fired.append(f"if(l1 > {C['font_size_l1_min']}, named_struct('name', 'font_size_change', 'weight', {WEIGHTS['font_size_change']}D), null)")
    return pairs.withColumn("signals", F.expr(f"filter(array({', '.join(fired)}), x -> x is not null)"))


def scored(pairs: DataFrame) -> DataFrame:
    """Adds score (net, without review-only signals), change_score and strong."""
    review = F.array(*[F.lit(x) for x in REVIEW_ONLY])
    acting = F.filter("signals", lambda s: ~F.array_contains(review, s["name"]))
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda a, s: a + s["weight"])
    return pairs.select(
        "*",
        T.rounded(F.greatest(F.lit(0.0), total(acting)), 3).alias("score"),
        T.rounded(total(F.filter("signals", lambda s: s["weight"] > 0)), 3).alias("change_score"),
        F.exists(acting, lambda s: s["weight"] >= C["strong_min"]).alias("strong"),
    )


def decided(pairs: DataFrame, policy: str = "balanced") -> DataFrame:
    """Adds is_cut, is_candidate and suppressed (by how much continuity outweighs change)."""
    pairs = pairs.withColumn("is_cut", (F.col("score") >= C["policies"][policy]) & F.col("strong"))
    pairs = pairs.withColumn("is_candidate", ~F.col("is_cut") & (F.col("change_score") >= C["candidate_floor"]))
    gap = T.rounded(F.col("change_score") - F.col("score"), 3)
    return pairs.withColumn("suppressed", F.when(F.col("is_candidate") & (gap > 0), gap))


def refine_band(pairs: DataFrame, policy: str = "balanced") -> DataFrame:
    """The seams whose font sizes are worth comparing."""
    return pairs.where((F.col("score") >= C["candidate_floor"]) & (F.col("score") < C["policies"][policy]))


def refined(pairs: DataFrame, histograms: DataFrame, policy: str = "balanced") -> DataFrame:
    """seams() scored with the font sizes of the pages beside them, where these could tip the balance (refine_band()).
    histograms: document_id, page, size, share. Adds refined: whether the pages' sizes were compared."""
    band = refine_band(scored(signals(pairs)), policy).select("document_id", "before_page")
    keys = ["document_id", "before_page"]
    sides = [histograms.withColumn("before_page", F.col("page") + i).drop("page").join(band, keys, "left_semi") for i in (1, 0)]
    compared = histogram_l1(*sides, keys)
    rows = scored(signals(pairs, compared))
    return rows.withColumn("refined", F.col("l1").isNotNull()).drop("l1")


def segments(decisions: DataFrame, census: DataFrame) -> DataFrame:
    """Runs of pages between cuts: document_id, segment_index, start_page, end_page, page_count, opened_by, score."""
    totals = census.groupBy("document_id").agg(F.max("page").alias("total"))
    cuts = decisions.where("is_cut").select("document_id", F.col("before_page").alias("start_page"), F.array_join(F.transform("signals", lambda s: s["name"]), ",").alias("opened_by"), "score")
    first = totals.select("document_id", F.lit(1).alias("start_page"), F.lit("document_start").alias("opened_by"), F.lit(None).cast("double").alias("score"))
    starts = first.unionByName(cuts).join(totals, "document_id")
    order = Window.partitionBy("document_id").orderBy("start_page")
    out = starts.withColumn("segment_index", F.row_number().over(order)).withColumn("end_page", F.coalesce(F.lead("start_page").over(order) - 1, "total"))
    return out.withColumn("page_count", F.col("end_page") - F.col("start_page") + 1).drop("total")


def continuous(a: str, b: str) -> F.Column:
    """Whether two page structs could be neighbours in one document."""
    fonts = F.coalesce(T.overlap(F.col(f"{a}.font_families"), F.col(f"{b}.font_families")), F.lit(1.0))
    header = (F.col(f"{a}.header_sig") != "") & (F.col(f"{a}.header_sig") == F.col(f"{b}.header_sig"))
    same = (F.col(f"{a}.size_class") == F.col(f"{b}.size_class")) & (F.col(f"{a}.orientation") == F.col(f"{b}.orientation")) & (F.col(f"{a}.modality") == F.col(f"{b}.modality"))
    return header | (same & (fonts >= C["font_overlap_min"]))


def rejoined(found: DataFrame, census: DataFrame) -> DataFrame:
    """Short inserts between continuous neighbours merged with both, left to right: document_id, segment_index, start_page,
    end_page, page_count, opened_by, score, reabsorbed (of each insert: start_page, end_page, score, opened_by).

    A merged host has at least three pages, so it is never an insert itself. Of a run of inserts the first, third and so
    on is swallowed, and each takes the segment after it along; so the merges are told by windows over a document's
    segments, and nothing but a segment's own inserts is gathered."""
    for name, kind in (("opened_by", "string"), ("score", "double")):
        if name not in found.columns:
            found = found.withColumn(name, F.lit(None).cast(kind))
    page = F.struct("font_families", "header_sig", "size_class", "orientation", "modality")
    pages = census.select(F.col("document_id").alias("p_document"), F.col("page").alias("p_page"), page.alias("p"))
    order = Window.partitionBy("document_id").orderBy("segment_index")
    rows = found.withColumn("before", F.col("start_page") - 1).withColumn("after", F.col("end_page") + 1).withColumn("last", F.lead("start_page").over(order).isNull())
    for side in ("before", "after"):
        rows = rows.join(pages.select(F.col("p_document").alias("d"), F.col("p_page").alias("q"), F.col("p").alias(f"{side}_page")), (F.col("document_id") == F.col("d")) & (F.col(side) == F.col("q")), "left").drop("d", "q")
    insert = (F.col("page_count") <= C["max_insert_pages"]) & (F.col("segment_index") > 1) & ~F.col("last") & F.coalesce(continuous("before_page", "after_page"), F.lit(False))
    rows = rows.select("document_id", "segment_index", "start_page", "end_page", "opened_by", "score", insert.alias("insert"))
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("plain", F.sum((~F.col("insert")).cast("int")).over(upto))  # inserts of one run share it
    place = F.sum(F.col("insert").cast("int")).over(Window.partitionBy("document_id", "plain").orderBy("segment_index").rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("swallow", F.col("insert") & (place % 2 == 1))
    rows = rows.withColumn("swallow", F.col("swallow") & (F.sum(F.col("swallow").cast("int")).over(upto) <= C["max_merges"]))
    goes_on = F.col("swallow") | F.coalesce(F.lag("swallow").over(order), F.lit(False))
    rows = rows.withColumn("goes_on", goes_on).withColumn("host", F.sum((~F.col("goes_on")).cast("int")).over(upto).cast("int"))
    gone = F.sort_array(F.collect_list(F.when(F.col("swallow"), F.struct("start_page", "end_page", "score", "opened_by"))))
    opened = F.when(~F.col("goes_on"), F.col("opened_by"))
    merged = rows.groupBy("document_id", F.col("host").alias("segment_index")).agg(F.min("start_page").alias("start_page"), F.max("end_page").alias("end_page"), F.max(opened).alias("opened_by"), F.max(F.when(~F.col("goes_on"), F.col("score"))).alias("score"), gone.alias("reabsorbed"))
    return merged.select("document_id", "segment_index", "start_page", "end_page", (F.col("end_page") - F.col("start_page") + 1).alias("page_count"), "opened_by", "score", "reabsorbed")


def head_pages(found: DataFrame, census: DataFrame) -> DataFrame:
    """document_id, segment_index, page: a segment's first pages, one more after a slip sheet."""
    slip = census.select(F.col("document_id").alias("c_document"), F.col("page").alias("c_page"), "is_slip_sheet")
    rows = found.join(slip, (F.col("document_id") == F.col("c_document")) & (F.col("start_page") == F.col("c_page")))
    last = F.least("end_page", F.col("start_page") + C["head_pages"] - 1 + F.col("is_slip_sheet").cast("int"))
    return rows.select("document_id", "segment_index", F.explode(F.sequence("start_page", last)).alias("page"))


def tiling_violations(found: DataFrame, census: DataFrame) -> DataFrame:
    """Segments that don't begin where the one before ends, or documents not covered to the end."""
    order = Window.partitionBy("document_id").orderBy("segment_index")
    gaps = found.withColumn("expected", F.coalesce(F.lag("end_page").over(order) + 1, F.lit(1))).where("start_page <> expected").select("document_id", F.col("start_page").alias("at"), F.lit("gap").alias("violation"))
    totals = census.groupBy("document_id").agg(F.max("page").alias("total"))
    ends = found.groupBy("document_id").agg(F.max("end_page").alias("end")).join(totals, "document_id").where("end <> total").select("document_id", F.col("end").alias("at"), F.lit("end").alias("violation"))
    return gaps.unionByName(ends)


def histogram(spans: DataFrame, keys: list[str]) -> DataFrame:
    """keys, size, share: characters by half-point font size, as shares."""
    sized = spans.groupBy(*keys, (F.rint(F.col("font_size") * 2) / 2).alias("size")).agg(F.sum(F.length("text")).alias("chars"))
    return sized.withColumn("share", F.col("chars") / F.sum("chars").over(Window.partitionBy(*keys))).drop("chars")


def histogram_l1(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """keys, l1: the distance of histograms that both sides have."""
    both = a.select(*keys).distinct().join(b.select(*keys).distinct(), keys)
    whole = a.select(*keys, "size", F.col("share").alias("x")).join(b.select(*keys, "size", F.col("share").alias("y")), [*keys, "size"], "full")
    far = whole.groupBy(*keys).agg(F.sum(F.abs(F.coalesce("x", F.lit(0.0)) - F.coalesce("y", F.lit(0.0)))).alias("l1"))
    return far.join(both, keys)


def evaluation(decisions: DataFrame, truth: DataFrame, groups: list[str]) -> DataFrame:
    """Precision, recall, f1 and assisted recall of cuts, overall and by each group (columns of truth's documents).
    truth: document_id, before_page, is_seam and the groups, a row for every seam."""
    rows = decisions.join(truth, ["document_id", "before_page"])
    level = rows.groupingSets([[], *[[g] for g in groups]], *groups) if groups else rows.groupBy()
    n = lambda c: F.count_if(c)
    cut, real = F.col("is_cut"), F.col("is_seam")
    out = level.agg(n(cut & real).alias("tp"), n(cut & ~real).alias("fp"), n(~cut & real).alias("fn"), n(F.col("is_candidate") & real).alias("assisted"))
    ratio = lambda a, b: F.when(b > 0, T.rounded(a / b, 4)).otherwise(F.lit(0.0))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return out.select(*groups, "tp", "fp", "fn", ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"), ratio(2 * tp, 2 * tp + fp + fn).alias("f1"), ratio(tp + F.col("assisted"), tp + fn).alias("assisted_recall"))


def outcomes(cuts: DataFrame, candidates: DataFrame, truth: DataFrame) -> DataFrame:
    """document_id, before_page, is_cut, is_candidate, is_seam: a row for each page that is any of them. The three tables
    have document_id and before_page."""
    names = ("is_cut", "is_candidate", "is_seam")
    marked = [df.select("document_id", "before_page", *[F.lit(n == name).alias(n) for n in names]) for df, name in zip((cuts, candidates, truth), names, strict=True)]
    return marked[0].unionByName(marked[1]).unionByName(marked[2]).groupBy("document_id", "before_page").agg(*[F.bool_or(n).alias(n) for n in names])


def evaluation_by_document(found: DataFrame, documents: DataFrame) -> DataFrame:
    """documents' columns, true_seams, tp, fp, fn, recovered, missed: the outcomes of each document, with the pages of seams
    that are candidates only and of those that aren't even that. Documents without any outcome have noughts."""
    cut, real, candidate = F.col("is_cut"), F.col("is_seam"), F.col("is_candidate")
    pages = lambda c: F.array_sort(F.collect_list(F.when(c, F.col("before_page"))))
    counts = {"true_seams": real, "tp": cut & real, "fp": cut & ~real, "fn": ~cut & real}
    lists = {"recovered": ~cut & real & candidate, "missed": ~cut & real & ~candidate}
    rows = found.groupBy(F.col("document_id").alias("e_document")).agg(*[F.count_if(c).alias(n) for n, c in counts.items()], *[pages(c).alias(n) for n, c in lists.items()])
    none = F.array().cast("array<int>")
    joined = documents.join(rows, F.col("document_id") == F.col("e_document"), "left")
    return joined.select(*[documents[c] for c in documents.columns], *[F.coalesce(n, F.lit(0)).alias(n) for n in counts], *[F.coalesce(n, none).alias(n) for n in lists])


def evaluation_by_difficulty(found: DataFrame, truth: DataFrame) -> DataFrame:
    """difficulty, total, found, candidate, recall, assisted_recall over true seams."""
    rows = truth.join(found, ["document_id", "before_page"]).groupBy("difficulty")
    out = rows.agg(F.count("*").alias("total"), F.count_if("is_cut").alias("found"), F.count_if(~F.col("is_cut") & F.col("is_candidate")).alias("candidate"))
    share = lambda n: T.rounded(n / F.col("total"), 4)
    return out.withColumns({"recall": share(F.col("found")), "assisted_recall": share(F.col("found") + F.col("candidate"))})


def evaluation_by_scenario(by_document: DataFrame) -> DataFrame:
    """scenario, documents, tp, fp, fn, recall: what evaluation_by_document found; recall is null without a seam."""
    out = by_document.groupBy("scenario").agg(F.count("*").alias("documents"), *[F.sum(c).alias(c) for c in ("tp", "fp", "fn")])
    real = F.col("tp") + F.col("fn")
    return out.withColumn("recall", F.when(real > 0, T.rounded(F.col("tp") / real, 4)))
