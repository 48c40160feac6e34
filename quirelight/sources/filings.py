"""Court papers made from conversations: spans of filings with a caption, a court, a date, numbers and titles, some on
pleading paper with numbered margins, so that what looks for them meets it in every form. One document a conversation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the made papers.
COURTS = ("SUPERIOR COURT OF THE FIRST DISTRICT", "COURT OF CLAIMS", "IN THE DISTRICT COURT")
FIRST_DAY = "2001-01-01"
MARGIN, LEFT, RIGHT, TOP, PITCH = 36.0, 100.0, 360.0, 60.0, 24.0
TURNS_A_PAGE, TURN_PITCH = 4, 160.0


def _capital(words: Column) -> Column:
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.substr(w, F.lit(2)))), " ")


def spans(conversations: DataFrame) -> DataFrame:
    """document_id, page, ord, text, x, y, width, height, font_size, bold, page_width, page_height. The first page has the
    caption in one, two or three parts, by the conversation's number; its turns follow, four a page, in five sizes.
    Conversations without a number are left out, turns without text have no span; of repeated turns the first text in
    order stands."""
    turns = conversations.where("conv_id is not null and turn is not null").groupBy("conv_id", "turn").agg(F.coalesce(F.min("text"), F.lit("")).alias("text"))
    words = lambda t: F.regexp_extract_all(F.coalesce(F.max(F.when(F.col("turn") == t, F.col("text"))), F.lit("")), F.lit(r"[A-Za-z]\p{L}+"), F.lit(0))
    papers = turns.groupBy("conv_id").agg(words(0).alias("a"), words(1).alias("b"), F.count("*").alias("n"))
    papers = papers.withColumn("one", _capital(F.slice("a", 1, 2))).withColumn("other", _capital(F.slice("b", 1, 2)))
    i = F.col("conv_id")
    kind = F.pmod(i, F.lit(3))
    both = (F.length("one") > 1) & (F.length("other") > 1)
    span = lambda when, text, x, row, size, bold: F.when(when, F.struct(text.alias("text"), F.lit(x).alias("x"), F.lit(TOP + PITCH * row).alias("y"), F.lit(float(size)).alias("font_size"), F.lit(bold).alias("bold")))
    court = F.pmod(i, F.lit(4)) != 3
    head = [
        span(court, F.get(F.array(*map(F.lit, COURTS)), kind.cast("int")), 220.0, 0, 14, True),
        span(~court & (F.size("a") >= 3), F.concat(_capital(F.slice("a", 3, 1)), F.lit(" Corporation")), 220.0, 0, 16, True),
        span(both & (kind == 0), F.concat("one", F.lit(" v. "), "other"), LEFT, 2, 12, True),
        span(both & (kind == 1), F.concat("one", F.lit(" vs.")), LEFT, 2, 12, True),
        span(both & (kind == 1), F.col("other"), LEFT, 3, 12, False),
        span(both & (kind == 2), F.col("one"), LEFT, 2, 12, True),
        span(both & (kind == 2), F.lit("v."), LEFT, 3, 12, False),
        span(both & (kind == 2), F.col("other"), LEFT, 4, 12, True),
        span(F.pmod(i, F.lit(7)) == 0, F.lit("12 v 14 of the lines"), LEFT, 5, 12, False),
        span(F.lit(True), F.concat(F.lit("Case No. CV-"), (i + 1000).cast("string")), RIGHT, 2, 10, False),
        span(F.lit(True), F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), F.pmod(i, F.lit(3650)).cast("int")), "MMMM d, yyyy"), RIGHT, 3, 11, False),
        span(F.pmod(i, F.lit(5)) == 0, F.concat(F.lit("Exhibit "), F.char(65 + F.pmod(i, F.lit(26)))), RIGHT, 4, 12, True),
        span(F.size("a") >= 6, F.concat(F.lit("Motion For "), _capital(F.slice("a", 3, 4))), LEFT, 7, 20, False),
        span(F.lit(True), F.concat(F.lit("Page 1 of "), (1 + F.ceil(F.col("n") / TURNS_A_PAGE)).cast("string")), 280.0, 29, 8, False),
    ]
    last = F.when(F.pmod(i, F.lit(2)) == 0, 28).otherwise(12)
    numbers = F.transform(F.sequence(F.lit(1), last), lambda k: F.struct(k.cast("string").alias("text"), F.lit(MARGIN).alias("x"), (TOP + PITCH * (k - 1)).alias("y"), F.lit(10.0).alias("font_size"), F.lit(False).alias("bold")))
    first = papers.select("conv_id", F.posexplode(F.concat(F.array_compact(F.array(*head)), numbers)).alias("ord", "s")).select("conv_id", F.lit(1).alias("page"), "ord", "s.*")
    plain = F.trim(F.regexp_replace("text", r"\s+", " "))
    page, place = (2 + F.floor(F.col("turn") / TURNS_A_PAGE)).cast("int"), F.pmod(F.col("turn"), F.lit(TURNS_A_PAGE))
    rest = turns.where(plain != "").select("conv_id", page.alias("page"), (1000 + F.col("turn")).cast("int").alias("ord"), plain.alias("text"), F.lit(72.0).alias("x"), (TOP + TURN_PITCH * place).alias("y"), (10 + 2 * F.pmod(F.col("turn"), F.lit(5))).cast("double").alias("font_size"), F.lit(False).alias("bold"))
    rows = first.unionByName(rest)
    return rows.select(i.cast("string").alias("document_id"), "page", "ord", "text", "x", "y", F.least(F.length("text") * F.col("font_size") * 0.5, F.lit(468.0)).alias("width"), F.col("font_size").alias("height"), "font_size", "bold", F.lit(612.0).alias("page_width"), F.lit(792.0).alias("page_height"))
