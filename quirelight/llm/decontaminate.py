"""Benchmark decontamination by a prefix-filtered set join.

A window is WINDOW_WORDS consecutive words of a benchmark item (an item of fewer words, but not none, is one window). A
document contains a window only if it has all its words, so with the words in order of rarity over all documents the
necessary prefix of a window is its rarest word alone: one that isn't there rules the window out.

1. Windows are rows: a key, their word hashes, and (apart) the items that have them.
2. Occurrences of the windows' words are counted over all documents; each window is entered under its rarest word (the
   least hash of equals), with that word's place in it.
3. One pass over the documents emits, for each word that may be such a prefix, its place and the hashes of the words
   around it, and each document's number of words. What may be one is decided by a filter of fixed size.
4. Prefix words and occurrences are joined on the word; the length bound and the positional bounds (the window must begin
   and end within the document) drop most pairs, and the others are verified word by word.

Nothing of the benchmark is sent to the executors but filters of fixed size, so it may be of any size.

Cases: a null or word-less text has no words, no hits and no items; a null or word-less item has no windows; the windows
of items with a null item_id count for hits, but as they have no id they are in neither the list nor the number of
items; items of equal text or id all count, an id once; words equally rare are told apart by their hash; rows that repeat
a doc_id are judged apart, rows that share doc_id and text alike; a null doc_id is kept as a document; very long texts
are read whole; an empty benchmark leaves every document clean; columns other than those named are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirelight.llm.common import FILTER_BITS, bounded, narrow, row_key, small_batches, stored, utf8
from quirelight.llm.text_hash import ALNUM, LOWER, Ranges, words

WINDOW_WORDS = 10
WORDS_AT_ONCE = 1 << 20


def _hashed(column):
    data, offsets = utf8(column)
    data = LOWER[data]
    starts, ends, row = words(data, offsets, ALNUM)
    return row, Ranges(data).of(starts, ends)


def item_windows(benchmark: DataFrame, width: int) -> DataFrame:
    """benchmark: item_id (string), text. item_id, window (hashes of its words): the items' windows."""

    def cut(batches):
        for batch in bounded(batches):
            row, hashes = _hashed(batch.column("text"))
            borders = np.searchsorted(row, np.arange(batch.num_rows + 1))
            ids, found = [], []
            for item, lo, hi in zip(batch.column("item_id").to_pylist(), borders[:-1], borders[1:], strict=True):
                size = min(width, hi - lo)
                for at in range(lo, hi - size + 1) if size else ():
                    ids.append(item)
                    found.append(hashes[at : at + size].astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(found, pa.list_(pa.int64()))], ["item_id", "window"])

    return benchmark.mapInArrow(cut, "item_id string, window array<long>")


def word_filter(found: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """found: one column of hashed words. A filter with a bit for each of `bits` hash values; it lets ever more pass as
    the words grow, and decides nothing."""
    place = F.pmod(F.col(found.columns[0]), F.lit(bits))
    # bits / 64 rows at most
    rows = found.select(place.alias("b")).groupBy(F.shiftright("b", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(b & 63 as int))")).alias("bits")).collect()
    out = np.zeros(bits >> 6, np.int64)
    for word, value in rows:
        out[word] = value
    return np.unpackbits(out.view(np.uint8), bitorder="little").astype(bool)


def passing(hashes: np.ndarray, kept: np.ndarray) -> np.ndarray:
    return kept[(hashes.astype(np.int64) % len(kept)).astype(np.int64)]


def word_counts(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """word, n: occurrences over all documents of the words in vocabulary (column word), and of others that pass."""
    sent = docs.sparkSession.sparkContext.broadcast(word_filter(vocabulary))

    def count(batches):
        held, size = [], 0

        def flush():
            some, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(some.astype(np.int64)), pa.array(n.astype(np.int64))], ["word", "n"])

        for batch in bounded(batches):
            _, hashes = _hashed(batch.column("text"))
            held.append(hashes[passing(hashes, sent.value)])
            size += len(held[-1])
            if size > WORDS_AT_ONCE:
                yield flush()
                size = 0
        if held:
            yield flush()

    return docs.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def occurrences(docs: DataFrame, prefixes: DataFrame, width: int) -> DataFrame:
    """doc_id, text_key, n_words, found: an array of (word, at, around) of the words that may be prefixes (column word);
    around has the words from at - width + 1, or the document's first, to at + width - 1, or its last."""
    sent = docs.sparkSession.sparkContext.broadcast(word_filter(prefixes))
    kind = pa.list_(pa.struct([("word", pa.int64()), ("at", pa.int64()), ("around", pa.list_(pa.int64()))]))

    def search(batches):
        for batch in bounded(batches):
            row, hashes = _hashed(batch.column("text"))
            borders = np.searchsorted(row, np.arange(batch.num_rows + 1))
            at = np.flatnonzero(passing(hashes, sent.value))
            first, stop = borders[row[at]], borders[row[at] + 1]
            lo, hi = np.maximum(at - width + 1, first), np.minimum(at + width, stop)
            size = hi - lo
            inside = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(size.sum())
            around = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(size))).astype(np.int32)), pa.array(hashes[inside].astype(np.int64)))
            one = pa.StructArray.from_arrays([pa.array(hashes[at].astype(np.int64)), pa.array(at - first), around], names=["word", "at", "around"])
            found = pa.ListArray.from_arrays(pa.array(np.searchsorted(at, borders).astype(np.int32)), one).cast(kind)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(np.diff(borders).astype(np.int64)), found], ["doc_id", "text_key", "n_words", "found"])

    return docs.mapInArrow(search, "doc_id long, text_key long, n_words long, found array<struct<word:long,at:long,around:array<long>>>")


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW_WORDS) -> DataFrame:
    """Per document row: doc_id, text_key, n_words, spans (distinct (start, end) of occurrences, in words), items (ids
    found, sorted)."""
    small_batches(docs.sparkSession)
    docs = narrow(docs, "doc_id", "text").select(*row_key(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")), "text")
    benchmark = narrow(benchmark, "item_id", "text").select(F.col("item_id").cast("string").alias("item_id"), "text").where("text is not null")
    owned = stored(item_windows(benchmark, width).withColumn("key", F.xxhash64("window")), "decontamination-windows")
    windows = owned.groupBy("key", "window").agg(F.lit(1).alias("one")).drop("one")
    entries = windows.select("key", F.posexplode("window").alias("place", "word"))
    counts = word_counts(docs, entries.select("word").distinct()).withColumnRenamed("word", "c_word")
    rarest = entries.join(counts, F.col("word") == F.col("c_word"), "left").groupBy("key").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "place")).alias("r"))
    prefixes = windows.join(rarest.select(F.col("key").alias("r_key"), "r"), F.col("key") == F.col("r_key")).select("key", "window", F.col("r.word").alias("p_word"), F.col("r.place").alias("place"))
    prefixes = stored(prefixes, "decontamination-prefixes")
    scanned = stored(occurrences(docs, prefixes.select("p_word").distinct(), width), "decontamination-occurrences")

    one = scanned.where(F.size("found") > 0).select("doc_id", "text_key", "n_words", F.inline("found"))
    begin = F.col("at") - F.col("place")
    within = (begin >= 0) & (begin + F.size("window") <= F.col("n_words"))
    offset = F.least("at", F.lit(width - 1)) - F.col("place")  # of the window's first word in around
    same = F.slice("around", (offset + 1).cast("int"), F.size("window")) == F.col("window")
    hits = one.join(prefixes, F.col("word") == F.col("p_word")).where(F.when(within, same).otherwise(False))
    hits = stored(hits.select("doc_id", "text_key", "key", "window", begin.alias("start"), (begin + F.size("window")).alias("end")).distinct(), "decontamination-hits")
    mine = ["doc_id", "text_key"]
    spans = hits.groupBy(*mine).agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans"))
    ids = owned.where("item_id is not null").select(F.col("key").alias("o_key"), F.col("window").alias("o_window"), "item_id").distinct()
    items = hits.select(*mine, "key", "window").distinct().join(ids, (F.col("key") == F.col("o_key")) & (F.col("window") == F.col("o_window"))).groupBy(*mine).agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    out = scanned.drop("found")
    for name, found in (("spans", spans), ("items", items)):
        out = out.join(found.select(F.col("doc_id").alias("f_doc_id"), F.col("text_key").alias("f_text_key"), name), F.col("doc_id").eqNullSafe(F.col("f_doc_id")) & (F.col("text_key") == F.col("f_text_key")), "left").drop("f_doc_id", "f_text_key")
    return out.select(*mine, "n_words", F.coalesce("spans", F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("spans"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs (all columns) without those in which a window of the benchmark occurs."""
    found = decontaminate(docs, benchmark).where(F.size("spans") > 0).select(F.col("doc_id").alias("ql__hit_doc_id"), F.col("text_key").alias("ql__hit_text_key"))
    rows = docs.withColumn("ql__text_key", F.xxhash64(F.coalesce(docs["text"], F.lit(""))))
    return rows.join(found, F.col("doc_id").cast("long").eqNullSafe(F.col("ql__hit_doc_id")) & (F.col("ql__text_key") == F.col("ql__hit_text_key")), "left_anti").drop("ql__text_key")


def digest(found: DataFrame) -> DataFrame:
    """n_hit (words inside any occurrence), n_items and the item ids' digest, from decontaminate()'s rows."""
    step = lambda s, x: F.struct((s["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(x["start"], s["reach"]))).alias("n"), F.greatest(s["reach"], x["end"]).alias("reach"))
    nothing = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("reach"))
    n_hit = F.aggregate("spans", nothing, step)["n"]
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))
