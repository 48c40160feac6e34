"""Language ID: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased. A word is a run of letters with a border sign on either side; its n-grams are all pieces of 1 to
ORDERS characters that hold a letter. They are hashed to BUCKETS buckets. Training sums buckets by language over the whole
texts of all training documents; p(bucket | language) is smoothed by SMOOTHING, and a language's prior is its share of the
training documents. The matrix of log probabilities (BUCKETS for each of at most MOST_LANGS languages) is broadcast; texts
are scored in batches by the non-zero counts of their buckets. The score is the posterior probability of the language.

Cases: a text that is null or has no letters is `und` with score 0, as is every text where nothing could be learned (an
empty table, no training row with a language); an empty text has no letters; very long texts are counted in pieces cut
between words; of equally likely languages the first by code point is taken; rows that repeat a doc_id are judged apart;
a null doc_id counts as the empty string where rows are held out; training rows without a text teach nothing; more than
MOST_LANGS languages are refused; columns other than those named are ignored.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirelight.llm.common import bounded, held_out, narrow, release, small_batches

BUCKETS = 1 << 16
ORDERS = 4
SMOOTHING = 0.1
MOST_LANGS = 256
PIECE = 1 << 18
FEW = 16
UNKNOWN = "und"
FOLDS, FOLD = 3, 1
BORDER = 0x20


@cache
def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def pieces(text: str) -> Iterator[str]:
    """The text lower-cased, in parts of about PIECE characters cut at characters that are no letters."""
    text, a = text.lower(), 0
    while a < len(text):
        b = min(len(text), a + PIECE)
        while b < len(text) and text[b].isalpha():
            b += 1
        yield text[a:b]
        a = b


def grams(parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Part and bucket of each n-gram."""
    codes = np.frombuffer("".join(f" {p} " for p in parts).encode("utf-32-le"), "<u4")
    part = np.repeat(np.arange(len(parts)), [len(p) + 2 for p in parts])
    letter = letters()[codes]
    codes = np.where(letter, codes, np.uint32(BORDER))
    h, inner, of, found = np.zeros(len(codes), np.uint32), np.ones(len(codes), bool), [], []
    for k in range(1, ORDERS + 1):
        m = len(codes) - k + 1
        if m <= 0:
            break
        h = h[:m] * np.uint32(0x01000193) + codes[k - 1 :]
        if k > 2:  # no border inside
            inner = inner[:m] & letter[k - 2 : k - 2 + m]
        at = np.flatnonzero(letter if k == 1 else letter[:m] | letter[1:] if k == 2 else inner)
        of.append(part[at])
        found.append((((h[at] + np.uint32(k)) * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int64))
    return np.concatenate(of) if of else np.zeros(0, np.int64), np.concatenate(found) if found else np.zeros(0, np.int64)


def counted(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Sparse counts of a batch: text, bucket and count, for some texts or parts of texts at a time."""
    rows, parts, size = [], [], 0
    for row, text in [(i, p) for i, t in enumerate(texts) if t for p in pieces(t)] + [(-1, "")]:
        if parts and (row < 0 or len(parts) == FEW or size + len(text) > PIECE):
            of, bucket = grams(parts)
            counts = np.bincount(of * BUCKETS + bucket, minlength=1)
            at = np.flatnonzero(counts)
            yield np.array(rows)[at >> 16], at & (BUCKETS - 1), counts[at]
            rows, parts, size = [], [], 0
        rows.append(row)
        parts.append(text)
        size += len(text)


def learn(train: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages in order, their log priors, and the log probabilities of buckets (a row a bucket) from text, lang."""
    train = train.where("text is not null and lang is not null")
    shares = train.groupBy("lang").count().limit(MOST_LANGS + 1).collect()
    if len(shares) > MOST_LANGS:
        raise ValueError(f"more than {MOST_LANGS} languages")
    langs = sorted(r["lang"] for r in shares)
    number = {x: i for i, x in enumerate(langs)}
    prior = np.zeros(len(langs))
    for r in shares:
        prior[number[r["lang"]]] = r["count"]

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for batch in bounded(batches):
            own = batch.column("lang").to_pylist()
            for row, bucket, n in counted(batch.column("text").to_pylist()):
                for x in {own[i] for i in np.unique(row)}:
                    mine = np.array([own[i] == x for i in range(len(own))])[row]
                    np.add.at(total.setdefault(x, np.zeros(BUCKETS, np.int64)), bucket[mine], n[mine])
        for x, counts in total.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict({"l": pa.array(np.full(len(at), number[x], np.int32)), "bucket": pa.array(at.astype(np.int32)), "n": pa.array(counts[at])})
        release()

    found = train.select("text", "lang").mapInArrow(count, "l int, bucket int, n long").groupBy("l", "bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((BUCKETS, len(langs)))  # BUCKETS rows a language at most
    counts[found.column("bucket").to_numpy(), found.column("l").to_numpy()] = found.column("n").to_numpy()
    return langs, np.log(prior / max(1, prior.sum())), np.log((counts + SMOOTHING) / (counts.sum(axis=0) + SMOOTHING * BUCKETS)).astype(np.float32)


def identify(docs: DataFrame, train: DataFrame) -> DataFrame:
    """doc_id, lang_pred, score of docs (doc_id, text), learned from train (text, lang)."""
    small_batches(docs.sparkSession)
    model = learn(narrow(train, "text", "lang"))
    sent = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS * MOST_LANGS numbers of 4 bytes at most

    def score(batches):
        langs, prior, table = sent.value
        for batch in bounded(batches):
            sums, seen = np.tile(prior, (batch.num_rows, 1)), np.zeros(batch.num_rows, bool)
            for row, bucket, n in counted(batch.column("text").to_pylist()) if langs else ():
                if len(row):
                    first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
                    np.add.at(sums, row[first], np.add.reduceat(n[:, None] * table[bucket].astype(float), first))
                    seen[row[first]] = True
            if langs:
                choice = sums.argmax(axis=1)
                top = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
            names = [langs[choice[i]] if seen[i] else UNKNOWN for i in range(batch.num_rows)]
            scores = np.where(seen, top, 0.0) if langs else np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores)], names=["doc_id", "lang_pred", "score"])
        release()

    rows = narrow(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(score, "doc_id long, lang_pred string, score double")


def language(docs: DataFrame) -> DataFrame:
    """identify() of all documents, learned from those whose crc32(doc_id) mod FOLDS is not FOLD, with held_out."""
    own = narrow(docs, "doc_id", "text", "lang")
    apart = held_out(F.col("doc_id"), FOLDS, lambda r: r == FOLD)
    return identify(own, own.where(~apart)).select("doc_id", apart.alias("held_out"), "lang_pred", "score")
