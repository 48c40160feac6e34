"""Marks of court papers: numbered margins and case captions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A numbered margin has at least so many bare numbers of 1 to 28 in the leftmost tenth of its page.
LEAST_NUMBERS, LARGEST, MARGIN = 15, 28, 0.10
PAGE = ["document_id", "page"]
#: A party is capitalised words, joined by a few small ones; a bare "v" between them is no caption.
PARTY = r"\p{Lu}[\p{L}.'&-]+(?:\s+(?:(?:of|the|and|de|la)\s+)?\p{Lu}[\p{L}.'&-]*)*"
VERSUS = r"(?:v\.|vs\.?|versus)"


def numbered(spans: DataFrame) -> DataFrame:
    """document_id, page, ord, value of the spans that number a page's margin: bare numbers at its left that lie on one
    line value -> height. The distance from one to the next is the median of that of neighbours whose values follow each
    other; what a number is off by is its height less its value times the distance. Numbers whose offsets are within a
    quarter of the distance are one run, and the page's run of most values counts (of equal ones the upper), if it has
    LEAST_NUMBERS. So a stray number breaks no run and is in none."""
    value = F.when(F.trim("text").rlike("^[0-9]{1,2}$"), F.trim("text").cast("int"))
    rows = spans.withColumn("value", value).where(F.col("value").between(1, LARGEST) & (F.col("page_width") > 0) & (F.col("x") < F.col("page_width") * MARGIN))
    down = Window.partitionBy(*PAGE).orderBy("y", "x", "ord")
    rows = rows.withColumn("next", F.when(F.lead("value").over(down) == F.col("value") + 1, F.lead("y").over(down) - F.col("y")))
    rows = rows.withColumn("pitch", F.median("next").over(Window.partitionBy(*PAGE))).where("pitch > 0")
    rows = rows.withColumn("off", F.col("y") - F.col("value") * F.col("pitch"))
    by_off = Window.partitionBy(*PAGE).orderBy("off", "ord")
    rows = rows.withColumn("new", F.coalesce(F.col("off") - F.lag("off").over(by_off) > F.col("pitch") / 4, F.lit(False)).cast("int"))
    rows = rows.withColumn("run", F.sum("new").over(by_off))
    run = Window.partitionBy(*PAGE, "run")
    rows = rows.withColumn("n", F.size(F.collect_set("value").over(run)))
    best = F.first("run").over(Window.partitionBy(*PAGE).orderBy(F.desc("n"), "run"))
    return rows.withColumn("best", best).where((F.col("run") == F.col("best")) & (F.col("n") >= LEAST_NUMBERS)).select(*PAGE, "ord", "value", "y", "pitch")


def line_number_runs(spans: DataFrame) -> DataFrame:
    """document_id, page, first, last, numbers (distinct), pitch of each page with a numbered margin."""
    return numbered(spans).groupBy(*PAGE).agg(F.min("value").alias("first"), F.max("value").alias("last"), F.count_distinct("value").alias("numbers"), F.max("pitch").alias("pitch"))


def without_numbers(spans: DataFrame) -> DataFrame:
    """spans less those that number a margin, which are no part of a text and can't be a title."""
    gone = numbered(spans).select(F.col("document_id").alias("g_document"), F.col("page").alias("g_page"), F.col("ord").alias("g_ord"))
    return spans.join(gone, (F.col("document_id") == F.col("g_document")) & (F.col("page") == F.col("g_page")) & (F.col("ord") == F.col("g_ord")), "left_anti")


def parties(text: Column) -> tuple[Column, Column]:
    """The two parties of a caption within a text; empty where it has none."""
    pattern = rf"(?:^|\s)({PARTY}),?\s+{VERSUS}\s+({PARTY})"
    return F.regexp_extract(text, pattern, 1), F.regexp_extract(text, pattern, 2)


def captions(units: DataFrame) -> DataFrame:
    """document_id, page, ord, last (the first and last unit), plaintiff, defendant. A caption stands in one unit, or in two
    or three that follow each other on a page: a party with "v." and a party; a party, and "v." with a party; a party, "v.",
    and a party. A state of the automaton is what the units so far have shown, so each unit is looked at with the two
    after it."""
    text = F.trim("text")
    one, other = parties(text)
    whole = lambda p: F.regexp_extract(text, f"^{p}$", 1)
    kinds = F.struct(
        F.col("ord"),
        F.when(one != "", F.struct(one.alias("a"), other.alias("b"))).alias("full"),
        whole(rf"({PARTY}),?\s+{VERSUS}").alias("opens"),
        whole(rf"{VERSUS}\s+({PARTY}),?").alias("closes"),
        whole(rf"({PARTY}),?").alias("party"),
        text.rlike(f"^{VERSUS}$").alias("versus"),
    )
    order = Window.partitionBy(*PAGE).orderBy("ord")
    rows = units.select(*PAGE, "ord", kinds.alias("u")).select("*", F.lead("u", 1).over(order).alias("v"), F.lead("u", 2).over(order).alias("w"))
    u, v, w = F.col("u"), F.col("v"), F.col("w")
    found = lambda a, b, last: F.struct(a.alias("plaintiff"), b.alias("defendant"), last.alias("last"))
    seen = (
        F.when(u["full"].isNotNull(), found(u["full"]["a"], u["full"]["b"], u["ord"]))
        .when((u["opens"] != "") & (v["party"] != ""), found(u["opens"], v["party"], v["ord"]))
        .when((u["party"] != "") & (v["closes"] != ""), found(u["party"], v["closes"], v["ord"]))
        .when((u["party"] != "") & v["versus"] & (w["party"] != ""), found(u["party"], w["party"], w["ord"]))
    )
    return rows.withColumn("c", seen).where("c is not null").select(*PAGE, "ord", F.col("c.last").alias("last"), "c.plaintiff", "c.defendant")
