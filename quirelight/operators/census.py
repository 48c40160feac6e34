"""The page census: one row per page of measurements, and the series of production stamps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quirelight.functions import text as T

MIN_SERIES_PAGES = 3
MIN_ASCENDING = 0.80
TOKENS_KEPT = 60


def measure(pages: DataFrame) -> DataFrame:
    """pages: document_id, page, raw_text, width, height, rotation, image_count, fonts. Adds the census columns; arrived, a page's
    time in a stream, is kept."""
    norm = F.col("norm")
    pages = pages.withColumn("norm", T.normalized(F.col("raw_text"))).withColumn("lines", T.lines(F.col("raw_text")))
    turned = F.col("rotation").isin(90, 270)
    families = F.array_sort(F.array_distinct(F.transform("fonts", T.font_name)))
    last = F.right(norm, F.lit(1))
    out = pages.select(
        "document_id",
        "page",
        *[c for c in pages.columns if c == "arrived"],
        "norm",
        "width",
        "height",
        "rotation",
        "image_count",
        F.length(norm).alias("char_count"),
        F.size(T.words(norm)).alias("word_count"),
        F.size("lines").alias("line_count"),
        F.when(norm != "", "native").otherwise("scanned").alias("modality"),
        T.size_class(F.col("width"), F.col("height")).alias("size_class"),
        F.when(F.when(turned, F.col("height")).otherwise(F.col("width")) > F.when(turned, F.col("width")).otherwise(F.col("height")), "landscape").otherwise("portrait").alias("orientation"),
        families.alias("font_families"),
        F.array_sort(F.array_distinct(F.transform(families, T.font_class))).alias("font_classes"),
        T.last_match(F.col("raw_text"), T.STAMP, 1).alias("stamp_prefix"),
        T.last_match(F.col("raw_text"), T.STAMP, 2).alias("stamp_digits"),
        T.first_match(norm, T.LABEL, 1).cast("int").alias("label_num"),
        T.first_match(norm, T.LABEL, 2).cast("int").alias("label_total"),
        T.masked_edge(F.try_element_at("lines", F.lit(1))).alias("header_sig"),
        T.masked_edge(F.try_element_at("lines", F.lit(-1))).alias("footer_sig"),
        ((norm != "") & (F.instr(F.lit(T.TERMINAL), last) == 0)).alias("ends_mid_sentence"),
        F.coalesce(F.regexp_extract(norm, r"(\p{L})", 1).rlike(r"\p{Ll}"), F.lit(False)).alias("starts_lowercase"),
        F.left(norm, F.lit(160)).alias("text_head"),
        F.substring(F.sha1(norm), 1, 12).alias("text_sha"),
        norm.rlike(T.SPACER).alias("is_spacer"),
    )
    out = out.withColumn("is_blank", (F.col("char_count") <= 3) & (F.col("image_count") == 0))
    slip = ~F.col("is_blank") & ~F.col("is_spacer") & (norm != "") & (F.col("word_count") <= 15) & (F.col("char_count") <= 120) & (F.col("image_count") <= 1)
    return out.withColumn("is_slip_sheet", slip).withColumn("stamp_number", F.col("stamp_digits").cast("long"))


def with_tokens(census: DataFrame, kept: int = TOKENS_KEPT) -> DataFrame:
    """Adds tokens: a page's most frequent content words, sorted. Words are sorted and their runs measured within the
    row, so that no word is ever shuffled; arrays that are read by place are columns of their own, made once a row."""
    word = F.transform(F.regexp_extract_all("norm", F.lit(T.TOKEN), F.lit(0)), lambda w: F.lower(w))
    out = census.withColumn("ct_words", F.sort_array(F.filter(word, lambda w: ~w.isin(T.word_list("token_stopwords")))))
    new = F.transform("ct_words", lambda w, i: F.when((i == 0) | (w != F.get("ct_words", i - 1)), i))
    out = out.withColumn("ct_at", F.filter(new, lambda i: i.isNotNull()))
    run = F.transform("ct_at", lambda i, k: F.struct((i - F.coalesce(F.get("ct_at", k + 1), F.size("ct_words"))).alias("n"), F.get("ct_words", i).alias("word")))
    out = out.withColumn("tokens", F.sort_array(F.transform(F.slice(F.sort_array(run), 1, kept), lambda x: x["word"])))
    return out.drop("ct_words", "ct_at")


def content_tokens(census: DataFrame, kept: int = TOKENS_KEPT) -> DataFrame:
    """document_id, page, tokens of the pages that have any. The test for any is made on the text: one on tokens would
    be pushed below the columns that tokens are made from, and repeat them for every word."""
    word = F.transform(F.regexp_extract_all("norm", F.lit(T.TOKEN), F.lit(0)), lambda w: F.lower(w))
    some = F.exists(word, lambda w: ~w.isin(T.word_list("token_stopwords")))
    return with_tokens(census.where(some), kept).select("document_id", "page", "tokens")


def stamp_series(census: DataFrame) -> DataFrame:
    """Prefixes that recur on enough pages with one digit width and mostly rising numbers."""
    before = F.lag("stamp_number").over(Window.partitionBy("document_id", "stamp_prefix").orderBy("page"))
    stamped = census.where("stamp_prefix is not null").withColumn("rises", (F.col("stamp_number") > before).cast("double"))
    found = stamped.groupBy("document_id", F.col("stamp_prefix").alias("prefix")).agg(
        F.count("*").alias("page_count"),
        F.count_distinct(F.length("stamp_digits")).alias("widths"),
        F.avg("rises").alias("rising"),
        F.max(F.length("stamp_digits")).alias("digits"),
        F.min("stamp_number").alias("first"),
        F.max("stamp_number").alias("last"),
        F.sort_array(F.collect_list("page")).alias("pages"),
    )
    return found.where((F.col("page_count") >= MIN_SERIES_PAGES) & (F.col("widths") == 1) & (F.col("rising") >= MIN_ASCENDING)).drop("widths", "rising")


def census(pages: DataFrame) -> DataFrame:
    """Everything: measurements, tokens, and whether the page's stamp is of a series. One scan of the pages: the series'
    rules are windows over a document's pages of one prefix."""
    own = Window.partitionBy("document_id", "stamp_prefix")
    rises = (F.col("stamp_number") > F.lag("stamp_number").over(own.orderBy("page"))).cast("double")
    out = with_tokens(measure(pages)).withColumn("rises", rises)
    width = F.length("stamp_digits")
    series = (F.count("stamp_prefix").over(own) >= MIN_SERIES_PAGES) & (F.min(width).over(own) == F.max(width).over(own)) & (F.avg("rises").over(own) >= MIN_ASCENDING)
    return out.withColumn("in_series", F.col("stamp_prefix").isNotNull() & F.coalesce(series, F.lit(False))).drop("rises")


REQUIRED = ("document_id", "page", "char_count", "word_count", "modality", "size_class", "orientation", "text_sha", "is_blank", "is_slip_sheet")


def incomplete():
    """Whether a census row lacks a required field or has an impossible number."""
    out = (F.col("page") < 1) | (F.col("char_count") < 0)
    for c in REQUIRED:
        out |= F.col(c).isNull()
    return out
