"""The outline of a document: its headings as a tree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirelight.sources import html

HEADING = "^h[1-6]$"
DEEPEST = 6


def headings(spans: DataFrame) -> DataFrame:
    """document_id, ord, page, level (1 to 6), text of spans that have block and tag: a heading is the spans of one block
    whose element is h1 to h6, joined as a line's; headings without text are left out."""
    rows = spans.where(F.col("tag").rlike(HEADING)).groupBy("document_id", "block", "tag")
    parts = F.transform(F.sort_array(F.collect_list(F.struct("ord", "text"))), lambda e: e["text"])
    text = F.trim(F.regexp_replace(F.array_join(parts, ""), r"\s+", " "))
    found = rows.agg(F.min("ord").alias("ord"), F.min("page").alias("page"), text.alias("text"))
    return found.where("text <> ''").select("document_id", "ord", "page", F.substring("tag", 2, 1).cast("int").alias("level"), "text")


def outline(found: DataFrame) -> DataFrame:
    """headings() with parent (the ord of the last earlier heading of a lower level that no heading of a level as low has
    ended), depth (1 for those without one) and path (the texts from the root down). The headings that are open at a
    place are the last ones of each level, less those that came before a heading of a lower level."""
    earlier = Window.partitionBy("document_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    last: list[Column] = [F.last(F.when(F.col("level") == k, F.struct("ord", "level", "text")), ignorenulls=True).over(earlier) for k in range(1, DEEPEST)]
    rows = found.withColumn("last", F.array(*last))
    above = F.filter("last", lambda h: h.isNotNull() & (h["level"] < F.col("level")))
    rows = rows.withColumn("above", above)
    is_open = F.filter("above", lambda h: ~F.exists("above", lambda o: (o["level"] < h["level"]) & (o["ord"] > h["ord"])))
    rows = rows.withColumn("open", is_open)
    path = F.concat(F.transform("open", lambda h: h["text"]), F.array("text"))
    return rows.select(*found.columns, F.get("open", F.size("open") - 1)["ord"].alias("parent"), (F.size("open") + 1).alias("depth"), path.alias("path"))


def harvested(pages: DataFrame) -> DataFrame:
    """document_id, title, source, confidence, needs_review: the title element where it could name the document (high),
    else the first heading of its outline if that could (medium, to be reviewed, as it often names the first part only).
    Pages without either have no row."""
    named = html.titles(pages).select("document_id", "title", F.lit(0).alias("k"))
    first = headings(html.spans(pages)).groupBy("document_id").agg(F.min_by("text", "ord").alias("title"))
    rows = named.unionByName(first.where(html.usable(F.col("title"))).withColumn("k", F.lit(1)))
    best = rows.groupBy("document_id").agg(F.min(F.struct("k", "title")).alias("b"))
    meta = F.col("b.k") == 0
    return best.select("document_id", "b.title", F.when(meta, "title").otherwise("outline").alias("source"), F.when(meta, "high").otherwise("medium").alias("confidence"), (~meta).alias("needs_review"))
