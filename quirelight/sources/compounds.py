"""Compounds: documents put together as pages of one file, with production stamps, labels and layout by arithmetic, so
that their true seams are known (the first page of each language in a source)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def doc_pages(documents: DataFrame) -> DataFrame:
    """document_id, page, k (its place among the pages of its language), n (their number), doc_id, lang, text, s. Sources
    are few and long, so places are counted over their keys alone; texts meet them by key, a few rows each, and what is
    measured of them afterwards isn't bound to the number of sources."""
    at = F.struct("source", "lang", "doc_id")  # of equal keys nulls are equal too
    docs = documents.where("source is not null").withColumn("at", at)
    order, own = Window.partitionBy("source").orderBy("lang", "doc_id"), Window.partitionBy("source", "lang")
    places = docs.groupBy("source", "lang", "doc_id").agg(F.count("*").alias("m"))
    before = lambda w: F.sum("m").over(w) - F.col("m")
    places = places.select(at.alias("p_at"), before(order).alias("p_page"), before(own.orderBy("doc_id")).alias("p_k"), F.sum("m").over(own).cast("int").alias("n"))
    again = F.row_number().over(Window.partitionBy("at").orderBy("at"))
    rows = docs.join(places, F.col("at") == F.col("p_at")).withColumn("again", again)
    return rows.select(
        F.col("source").alias("document_id"),
        (F.col("p_page") + F.col("again")).cast("int").alias("page"),
        (F.col("p_k") + F.col("again")).cast("int").alias("k"),
        "n",
        "doc_id",
        "lang",
        F.coalesce("text", F.lit("")).alias("text"),
        F.regexp_extract("source", r"(\d+)", 1).cast("int").alias("s"),
    )


def stamped_pages(documents: DataFrame) -> DataFrame:
    """document_id, page, raw_text, width, height, rotation, image_count, fonts, lang, k."""
    pages, s, d = doc_pages(documents), F.col("s"), F.col("doc_id")
    prefix = F.concat(F.lit("PRD"), F.translate(s.cast("string"), "0123456789", "ABCDEFGHIJ"), F.when(s % 3 == 1, F.upper("lang")).otherwise(""))
    number = 100 + F.col("page") + F.when(d % 53 == 0, 500).otherwise(0)
    stamp = F.concat(prefix, F.lpad(number.cast("string"), 6, "0"))
    header = F.when(s % 4 == 0, F.concat(F.lit("SRC"), s.cast("string"), F.lit(" RECORD "), F.col("k").cast("string")))
    label = F.when(s % 2 == 0, F.concat(F.lit("Page "), F.col("k").cast("string"), F.lit(" of "), F.col("n").cast("string")))
    raw = F.when(d % 29 == 0, "").otherwise(F.concat_ws("\n", header, label, F.col("text"), F.when(s % 3 != 2, stamp)))
    short, long = F.when(F.col("lang") == "de", 595.0).otherwise(612.0), F.when(F.col("lang") == "de", 842.0).otherwise(792.0)
    turned = d % 37 == 0
    fonts = F.when(F.col("lang") == "en", F.array(F.lit("ABCDEF+TimesNewRoman-Bold"))).when(F.col("lang") == "fr", F.array(F.lit("Arial"))).when(F.col("lang") == "de", F.array(F.lit("CourierNew"))).otherwise(F.array(F.lit("Georgia"), F.lit("Arial,Italic")))
    return pages.select(
        "document_id", "page", raw.alias("raw_text"), F.when(turned, long).otherwise(short).alias("width"), F.when(turned, short).otherwise(long).alias("height"), F.when(d % 41 == 0, 90).otherwise(0).alias("rotation"), F.when(d % 5 == 0, 1).otherwise(0).alias("image_count"), fonts.alias("fonts"), "lang", "k"
    )


def singles(documents: DataFrame) -> DataFrame:
    """The documents of each source's first language alone: as compounds they are one document each, without a seam, so
    that every cut in them is false."""
    first = documents.groupBy(F.col("source").alias("f_source")).agg(F.min("lang").alias("f_lang"))
    return documents.join(first, (F.col("source") == F.col("f_source")) & (F.col("lang") == F.col("f_lang")), "left_semi")


def page_spans(stamped: DataFrame) -> DataFrame:
    """document_id, page, text, font_size: each page's first 40 characters as a heading of 16 points and the rest in its
    language's size."""
    body = F.when(F.col("lang") == "en", 10.0).when(F.col("lang") == "fr", 11.5).when(F.col("lang") == "de", 9.0).otherwise(13.0)
    parts = F.array(F.struct(F.left("raw_text", F.lit(40)).alias("text"), F.lit(16.0).alias("font_size")), F.struct(F.substring("raw_text", 41, 1 << 30).alias("text"), body.alias("font_size")))
    return stamped.select("document_id", "page", F.inline(parts)).where("text <> ''")


def truth(stamped: DataFrame) -> DataFrame:
    """A row per seam: document_id, before_page, is_seam, difficulty, scenario."""
    number = F.regexp_extract("document_id", r"(\d+)", 1).cast("int")
    rows = stamped.where("page > 1").select("document_id", F.col("page").alias("before_page"), (F.col("k") == 1).alias("is_seam"), number.alias("s"))
    return rows.select("document_id", "before_page", "is_seam", F.when(F.col("s") % 2 == 0, "easy").when(F.col("s") % 3 == 2, "hard").otherwise("medium").alias("difficulty"), F.when(F.col("s") % 4 == 0, "binder").when(F.col("s") % 3 == 2, "mixed").otherwise("stamped").alias("scenario"))


def parts(documents: DataFrame) -> DataFrame:
    """document_id, part, lang, pages, start_page, end_page: each compound's parts and where a cursor puts them."""
    sizes = documents.where("source is not null").groupBy(F.col("source").alias("document_id"), "lang").agg(F.count("*").cast("int").alias("pages"))
    order = Window.partitionBy("document_id").orderBy("lang")
    end = F.sum("pages").over(order).cast("int")
    return sizes.select("document_id", F.row_number().over(order).alias("part"), "lang", "pages", (end - F.col("pages") + 1).alias("start_page"), end.alias("end_page"))


def stamps(pages: DataFrame, prefix: str, start: int, digits: int = 6) -> DataFrame:
    """document_id, page, stamp: a running number over each document's pages."""
    number = F.row_number().over(Window.partitionBy("document_id").orderBy("page")) + start - 1
    return pages.select("document_id", "page", F.concat(F.lit(prefix), F.lpad(number.cast("string"), digits, "0")).alias("stamp"))


def producers(pages: DataFrame, least: int) -> DataFrame:
    """families, width, pages: groups of documents' pages of one producer that are large enough to mix."""
    rows = pages.select(F.array_join(F.array_sort(F.array_distinct("fonts")), ",").alias("families"), (F.floor(F.col("width") / 10) * 10).cast("long").alias("width"))
    return rows.groupBy("families", "width").agg(F.count("*").alias("pages")).where(F.col("pages") >= least)


def systematic(rows: DataFrame, keys: list[str], step: int, n: int) -> DataFrame:
    """Every step-th row in order of keys, n of them at most: n * step rows are all that is ever ordered at once."""
    first = rows.orderBy(*keys).limit(n * step)
    return first.withColumn("place", F.row_number().over(Window.orderBy(*keys))).where((F.col("place") - 1) % step == 0).drop("place")


def shuffled(rows: DataFrame, key: str, seed: int, n: int) -> DataFrame:
    """n rows by a seeded hash of a key, the same on every run."""
    return rows.orderBy(F.xxhash64(F.lit(seed), key), key).limit(n)
