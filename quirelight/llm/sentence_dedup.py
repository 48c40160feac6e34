"""Substring deduplication by sliding sentence spans.

A sentence ends after a word that ends in . ! or ?, at a line's end, and at the text's end; one of more than
LONG_SENTENCE words also ends after each word whose hash is divisible by 8, so that a long passage without stops is cut
at places that its own words fix. A span is a run of at least SENTENCES consecutive sentences and MIN_WORDS words: from
each sentence the shortest run that starts there, and the shortest that ends there. Spans are hashed over their
lower-cased (A-Z) words and the hashes counted over all documents; the spans that repeat get their hash's first place in
order of (doc_id, place), and the sentences that any other of them covers are removed.

That removes what hashing all runs of the size would: a run that repeats with the same sentences consists of spans, as
from each of its sentences the shortest run either ends within it or, where too little follows, the shortest that ends
at its last sentence begins no later; and each of these spans repeats with it, at the same distance from its start.
(Where the same words are cut into sentences otherwise, by other line ends, the spans that start and end alike count.)

Counts and first places are combined before the shuffle; the joins back are equi-joins on the hash, in which adaptive
execution splits a passage that very many documents share; what meets in one task is one document's own spans.

Cases: a null or empty text has no sentences and stays empty; a text without a run of the size has no spans; rows that
share doc_id and text are one document stored repeatedly, and neither is removed for the other's sake; rows that share
only doc_id are told apart by the text; a null doc_id comes first; columns other than those named are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirelight.llm.common import bounded, narrow, small_batches, stored, utf8
from quirelight.llm.text_hash import LOWER, WORD, Ranges, words

SENTENCES = 2
MIN_WORDS = 16
LONG_SENTENCE = 24
STOPS = np.frombuffer(b".!?", np.uint8)


def sentences(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, Ranges]:
    """Word numbers at which sentences start (and the number of words), each sentence's first byte, its row, and the
    words' hashed values."""
    starts, ends, row = words(data, offsets, WORD)
    n = len(starts)
    if not n:
        return np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), Ranges(np.zeros(0, np.uint64))
    hashes = Ranges(LOWER[data]).of(starts, ends)
    lines = np.concatenate(([0], np.cumsum(data == 0x0A)))
    last = np.ones(n, bool)
    last[:-1] = (row[1:] != row[:-1]) | (lines[starts[1:]] > lines[ends[:-1]]) | np.isin(data[ends[:-1] - 1], STOPS)
    first = np.concatenate(([0], np.flatnonzero(last) + 1))
    long = np.repeat(np.diff(first) > LONG_SENTENCE, np.diff(first))
    last |= long & (hashes & np.uint64(7) == 0)
    first = np.concatenate(([0], np.flatnonzero(last) + 1))
    return first, starts[first[:-1]], row[first[:-1]], Ranges(hashes)


def spans(first: np.ndarray, row: np.ndarray, least: int, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last sentences of the spans, without repeats."""
    k = np.arange(len(row))
    forward = np.maximum(k + least - 1, np.searchsorted(first, first[:-1] + min_words) - 1)
    backward = np.minimum(k - least + 1, np.searchsorted(first, first[1:] - min_words, side="right") - 1)
    some = (backward >= 0) & (forward[np.maximum(backward, 0)] != k)
    lo, hi = np.concatenate([k, backward[some]]), np.concatenate([forward, k[some]])
    lo, hi = lo[hi < len(row)], hi[hi < len(row)]
    same = row[lo] == row[hi]
    order = np.argsort(lo[same], kind="stable")
    return lo[same][order], hi[same][order]


def _found(batches, least: int, min_words: int):
    for batch in bounded(batches):
        data, offsets = utf8(batch.column("text"))
        first, _, row, hashed = sentences(data, offsets)
        lo, hi = spans(first, row, least, min_words)
        of = row[lo] if len(lo) else np.zeros(0, np.int64)
        at = lo - np.searchsorted(row, of)
        yield pa.RecordBatch.from_arrays(
            [pa.array(hashed.of(first[lo], first[hi + 1]).astype(np.int64)), batch.column("doc_id").take(pa.array(of)), batch.column("k").take(pa.array(of)), pa.array(at.astype(np.int32)), pa.array((hi - lo + 1).astype(np.int32))],
            ["h", "doc_id", "k", "at", "n"],
        )


def dedup(docs: DataFrame, least: int = SENTENCES, min_words: int = MIN_WORDS) -> DataFrame:
    """Per document row: doc_id, text without the removed sentences, n_sentences, n_removed."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = narrow(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.hash(F.coalesce("text", F.lit(""))).alias("k"))
    found = docs.mapInArrow(lambda b: _found(b, least, min_words), "h long, doc_id long, k int, at int, n int")
    repeated = stored(found.groupBy(F.col("h").alias("r_h")).count().where("count > 1").select("r_h"), "sentence-hashes")
    found = stored(found.join(repeated, F.col("h") == F.col("r_h"), "left_semi"), "sentence-spans")
    # written, so that adaptive execution can split the join's hot hashes
    first = stored(found.groupBy(F.col("h").alias("f_h")).agg(F.min(F.struct("doc_id", "k", "at")).alias("first")), "sentence-first")
    later = found.join(first, F.col("h") == F.col("f_h")).where(~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("k") == F.col("first.k")) & (F.col("at") == F.col("first.at"))))
    drop = later.groupBy(F.col("doc_id").alias("d_doc"), F.col("k").alias("d_k")).agg(F.collect_set(F.struct("at", "n")).alias("drop"))
    joined = docs.join(drop, F.col("doc_id").eqNullSafe(F.col("d_doc")) & (F.col("k") == F.col("d_k")), "left").select("doc_id", "text", "drop")

    def kept(batches):
        for batch in bounded(batches):
            data, offsets = utf8(batch.column("text"))
            _, byte, row, _ = sentences(data, offsets)
            borders = np.searchsorted(row, np.arange(batch.num_rows + 1))
            texts, totals, removed = [], [], []
            for i, drop in enumerate(batch.column("drop").to_pylist()):
                lo, hi = borders[i], borders[i + 1]
                gone = np.zeros(hi - lo, bool)
                for x in drop or ():
                    gone[x["at"] : x["at"] + x["n"]] = True
                cut = [*byte[lo:hi].tolist(), int(offsets[i + 1])]  # white space before the first sentence goes with it
                if cut:
                    cut[0] = int(offsets[i])
                texts.append(b"".join(data[a:b].tobytes() for a, b, g in zip(cut[:-1], cut[1:], gone, strict=True) if not g).decode() if gone.any() else data[offsets[i] : offsets[i + 1]].tobytes().decode())
                totals.append(int(hi - lo))
                removed.append(int(gone.sum()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string()), pa.array(totals, pa.int64()), pa.array(removed, pa.int64())], ["doc_id", "text", "n_sentences", "n_removed"])

    return joined.mapInArrow(kept, "doc_id long, text string, n_sentences long, n_removed long")


def digest(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_sentences", "n_removed", F.octet_length("text").cast("long").alias("kept_bytes"), F.sha2("text", 256).alias("kept_sha256"))

