"""Seams of a stream of pages, which may come in any order. Pages are measured one by one; a state by document holds the last
page that was passed on, the header of the one before it, and pages that came early. A seam's decision is made by the same
expressions as in a batch as soon as both its pages are there and all before them.

Signals that need the whole document are not given, as it isn't known before its end: those in WHOLE. All others, and so
the decisions wherever WHOLE says nothing, are those of a batch.

Time is that of the pages (`arrived`), so that a stream gives the same whenever it runs.

Cases: of a page that comes again the first stands; a page that never comes is waited for until the stream is `wait` beyond
the document's last arrival, after which the pages held are passed on as neighbours, as in a batch without it; a page that
comes after its place was passed, or later than `delay`, is left out; pages without a document, a number or a time are left
out; very many early pages of one document are held in its state until their turn."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quirelight.operators import segment as S
from quirelight.operators.census import measure, with_tokens

#: Signals that a document's end decides: its stamp series and its median vocabulary overlap.
WHOLE = ("bates_prefix_change", "bates_number_gap", "bates_consecutive", "vocabulary_change")
STATE = "next int, last string, header string, held string"
PAIRS = "document_id string, a_page int, before_page int, a string, b string, p_header string"


def _in_turn(wait_ms: int):
    """The state's step: key, arriving pages (page, header_sig, side) and state to the pairs that are complete."""

    def step(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        following, last, header, held = state.get if state.exists else (1, None, None, "{}")
        latest = 0
        held = {int(k): v for k, v in json.loads(held).items()}
        if not state.hasTimedOut:
            for frame in frames:
                latest = max(latest, int(frame["arrived"].max().timestamp() * 1000))
                for page, sig, side in zip(frame["page"].tolist(), frame["header_sig"].tolist(), frame["side"].tolist(), strict=True):
                    if page >= following:
                        held.setdefault(page, [sig, side])
        before, pairs = json.loads(last) if last else None, []
        for page in sorted(held):
            if page != following and not state.hasTimedOut:
                break
            sig, side = held.pop(page)
            if before:
                pairs.append((key[0], before[0], page, before[2], side, header))
                header = before[1]
            before, following = (page, sig, side), page + 1
        state.update((following, json.dumps(before) if before else None, header, json.dumps(held)))
        if held:
            state.setTimeoutTimestamp(max(latest + wait_ms, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(pairs, columns=[c.split(" ")[0] for c in PAIRS.split(", ")]).astype({"a_page": "int32", "before_page": "int32"})

    return step


def pairs_stream(pages: DataFrame, wait_ms: int = 600_000, delay: str = "1 hour") -> DataFrame:
    """Neighbouring pages of a streaming frame of raw pages with their time (arrived), as segment.seams() gives them for a
    batch."""
    pages = pages.where("document_id is not null and page is not null and arrived is not null").withWatermark("arrived", delay)
    rows = with_tokens(measure(pages)).withColumn("in_series", F.lit(False))
    sides = F.struct(*S.SIDES)
    kind = rows.select(sides.alias("s")).schema["s"].dataType
    rows = rows.select("document_id", F.col("page").cast("int").alias("page"), "header_sig", "arrived", F.to_json(sides).alias("side"))
    paired = rows.groupBy("document_id").applyInPandasWithState(_in_turn(wait_ms), PAIRS, STATE, "append", GroupStateTimeout.EventTimeTimeout)
    both = paired.select("document_id", "a_page", "before_page", F.from_json("a", kind).alias("a"), F.from_json("b", kind).alias("b"), "p_header")
    both = both.select("document_id", "a_page", "before_page", "p_header", *[F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in "ab" for c in S.SIDES])
    return S.overlaps(both).withColumn("vocab_median", F.lit(None).cast("double"))


def seams_stream(pages: DataFrame, policy: str = "balanced", wait_ms: int = 600_000, delay: str = "1 hour") -> DataFrame:
    """Decisions at the seams of a streaming frame of raw pages."""
    return S.decided(S.scored(S.signals(pairs_stream(pages, wait_ms, delay))), policy)


def without_whole(pairs: DataFrame) -> DataFrame:
    """segment.seams() of a batch without what only a whole document tells: what a stream's decisions are equal to."""
    return pairs.withColumns({"a_in_series": F.lit(False), "b_in_series": F.lit(False), "vocab_median": F.lit(None).cast("double")})
