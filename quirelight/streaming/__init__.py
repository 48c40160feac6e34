"""The census of a stream of pages: it looks at one page at a time, so that it needs no state."""

from __future__ import annotations

from pyspark.sql import DataFrame

from quirelight.operators.census import measure


def census_stream(pages: DataFrame, late: str = "1 hour", event_time: str | None = None) -> DataFrame:
    """Measurements of a streaming frame of pages. With an event time, pages seen before within `late` are dropped."""
    if event_time is not None:
        return measure(pages.withWatermark(event_time, late).dropDuplicatesWithinWatermark(["document_id", "page"]))
    return measure(pages)
