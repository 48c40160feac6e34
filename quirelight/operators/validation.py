"""Rules that are checked while a table is written: DataFrame.observe counts what breaks them in the writing pass, so that
nothing is read again."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

#: Rules by kind of table: name, and when a row breaks it. A rule over neighbours reads what with_neighbours() adds.
PAGES = {
    "missing_field": " OR ".join(f"{c} IS NULL" for c in ("document_id", "page", "char_count", "word_count", "modality", "size_class", "orientation", "text_sha", "is_blank", "is_slip_sheet")),
    "impossible_number": "page < 1 OR char_count < 0",
}
SPANS = {
    "missing_field": " OR ".join(f"{c} IS NULL" for c in ("document_id", "page", "ord", "text", "x", "y", "width", "height", "font_size")),
    "impossible_number": "page < 1 OR ord < 0 OR width < 0 OR height < 0 OR font_size <= 0",
    "empty_text": "text = ''",
}
SEGMENTS = {
    "missing_field": "document_id IS NULL OR segment_index IS NULL OR start_page IS NULL OR end_page IS NULL",
    "empty_segment": "end_page < start_page OR page_count <> end_page - start_page + 1",
    "gap_or_overlap": "start_page <> previous_end + 1",
    "late_start": "previous_end IS NULL AND start_page <> 1",
    "early_end": "is_last AND end_page <> total",
}
UNITS = {"missing_field": "document_id IS NULL OR ord IS NULL OR text IS NULL", "empty_text": "trim(text) = ''", "no_spans": "size(span_ids) = 0"}


def with_neighbours(segments: DataFrame, totals: DataFrame) -> DataFrame:
    """segments with previous_end, is_last and total (the document's pages: document_id, total)."""
    order = Window.partitionBy("document_id").orderBy("start_page", "segment_index")
    known = totals.select(F.col("document_id").alias("t_document"), "total")
    rows = segments.withColumn("previous_end", F.lag("end_page").over(order)).withColumn("is_last", F.lead("end_page").over(order).isNull())
    return rows.join(known, F.col("document_id") == F.col("t_document"), "left").drop("t_document")


def observed(df: DataFrame, rules: dict[str, str], **more: Column) -> tuple[DataFrame, Observation]:
    """df, and what will be known once it has been written: rows, how many break each rule, and further sums."""
    seen = Observation(f"rules-{uuid.uuid4().hex}")
    counts = [F.coalesce(F.count_if(F.expr(when)), F.lit(0)).alias(name) for name, when in rules.items()]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts, *[c.alias(n) for n, c in more.items()]), seen


def broken(seen: Observation, rules: dict[str, str]) -> dict[str, int]:
    """The rules that a written table broke, and how often."""
    return {name: n for name, n in seen.get.items() if name in rules and n}
