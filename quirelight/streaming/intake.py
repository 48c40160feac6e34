"""Idempotent intake: an upload whose content was taken within its life is not taken again."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def content_id(content: Column) -> Column:
    """The first 16 hex digits of the SHA-256 of bytes or text."""
    return F.substring(F.sha2(F.coalesce(content.cast("binary"), F.lit(b"")), 256), 1, 16)


def taken(uploads: DataFrame, ttl_seconds: int, delay: str = "1 hour") -> DataFrame:
    """uploads: a streaming frame of content (bytes or text) and arrived (a timestamp), and other columns. Those that are
    taken, with content_id. A content lives for ttl_seconds from when it was taken: uploads within that time are dropped and
    don't lengthen it, the first one after it is taken again. States end by the clock of the uploads (event time), so that
    no content is remembered beyond its life and `delay`.

    Cases: null content is that of no bytes; uploads without a time are left out, as are those later than `delay`; of
    uploads of one content at the same time the first in the order of the other columns' text is taken."""
    rows = uploads.where("arrived is not null").withColumn("content_id", content_id(F.col("content"))).withWatermark("arrived", delay)
    schema = rows.schema
    others = [c for c in rows.columns if c not in ("content_id", "arrived")]

    def step(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = reduce(lambda a, b: pd.concat([a, b], ignore_index=True), frames)
        rows = rows.assign(order_=rows[others].astype(str).agg("|".join, axis=1)).sort_values(["arrived", "order_"]).drop(columns="order_")
        life, since, kept = ttl_seconds * 1_000_000, state.get[0] if state.exists else None, []
        for i, at in enumerate(rows["arrived"].astype("datetime64[us]").astype("int64")):
            if since is None or at - since > life:
                since = at
                kept.append(i)
        state.update((int(since),))
        state.setTimeoutTimestamp(max(int((since + life) // 1000) + 1, state.getCurrentWatermarkMs() + 1))
        yield rows.iloc[kept][schema.fieldNames()]

    return rows.groupBy("content_id").applyInPandasWithState(step, schema, "since long", "append", GroupStateTimeout.EventTimeTimeout)
