"""Ranked lexical search by a bit-sliced impact index.

Terms are the maximal matches of [^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+ of the whole text, A-Z lower-cased. N
documents have a term, L is the number of all their terms, n that of one, df the number of documents with a term and tf
its occurrences in one. The impact of a term in a document is (1000000000 * tf) div (1000 * tf + 12 * m), with
m = 75 + (25 * n * N) div L, and its weight w = floor(1000 * ln((2 * N + 2) / (2 * df + 1))). A document's score for an
item is the sum of w * impact over the item's terms, repeats included.

The index: documents come in blocks of at most BLOCK_DOCS documents and about BLOCK_BYTES of text, in ascending order of
doc_id within a block. For each block and term there are SLICES bitmaps over the block's documents, one for each bit of
the impact. Bytes that are zero in all slices are left out: `at` has the places of the others and `planes` SLICES bytes
for each. The index holds no weights, as these need df, which is the sum of the index's own counts.

The search: the index rows of asked terms meet the items by term (terms with many blocks are dealt over tasks by block)
and are grouped by block and by chunk of items. Within a group, slices are multiplied by a weight as a sum of shifted
slices, and added to an item's sums, by carry arithmetic on whole bitmaps; the best documents are found by descending
from the most significant slice. A group holds no more than the index of one block. All blocks' best are ranked at last.

Cases: a null or empty text has no term, and its document is found by no item; very long texts are hashed piece by
piece; documents with equal scores come by ascending doc_id (null last); rows that repeat a doc_id are documents of their
own; benchmark rows that share item_id and text are one item, and a null item_id is one like others; an item without a
known term gives no rows; empty tables give no rows; columns other than those named are ignored. Terms are told apart by
64-bit hashes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quirelight.llm.common import HOT_ROWS, bit_filter, bounded, flagged, narrow, release, small_batches, spread_join, stored, utf8
from quirelight.llm.text_hash import ALNUM, LOWER, word_hashes

BLOCK_DOCS = 1 << 13
BLOCK_BYTES = 12 << 20
SLICES = 20  # an impact is under 10**6
CHUNK_TERMS = 4096
ROWS_OUT = 1 << 15
K = 20


def _terms(batch) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each term of a batch's texts."""
    data, offsets = utf8(batch.column("text"))
    return word_hashes(LOWER[data], offsets, ALNUM)


def sizes(docs: DataFrame) -> tuple[int, int]:
    """N and L: documents with a term, and their terms."""

    def count(batches):
        for batch in bounded(batches):
            n = np.bincount(_terms(batch)[1], minlength=1)
            yield pa.RecordBatch.from_pydict({"n_docs": [int((n > 0).sum())], "n_terms": [int(n.sum())]})

    found = docs.select("text").mapInArrow(count, "n_docs long, n_terms long").agg(F.sum("n_docs"), F.sum("n_terms")).first()
    return found[0] or 0, found[1] or 0


def _binary(data: np.ndarray, width: int, borders: np.ndarray) -> pa.Array:
    """Binary values of `width` bytes for each of the places between borders."""
    return pa.Array.from_buffers(pa.binary(), len(borders) - 1, [None, pa.py_buffer((borders * width).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Places where a value differs from the one before, in any column."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


def slices_of(terms: np.ndarray, at: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of a block's terms and their documents' places, with m by document: the distinct terms, their df, the borders of
    their bytes, the bytes' places and slices."""
    order = np.lexsort((at, terms))
    terms, at = terms[order], at[order]
    first = _starts(terms, at)
    tf = np.diff(np.append(first, len(terms)))
    terms, at = terms[first], at[first]
    impact = 10**9 * tf // (1000 * tf + 12 * m[at])
    byte = at >> 3
    first = _starts(terms, byte)
    planes = np.zeros((len(first), SLICES), np.uint8)
    for s in range(SLICES if len(first) else 0):
        planes[:, s] = np.bitwise_or.reduceat((((impact >> s) & 1) << (at & 7)).astype(np.uint8), first)
    own = _starts(terms)
    df = np.diff(np.append(own, len(terms)))
    return terms[own], df, np.append(_starts(terms[first]), len(first)), byte[first].astype("<u2"), planes


INDEX = "block long, term long, df int, at binary, planes binary, doc_ids array<long>"
_ARROW = pa.schema([("block", pa.int64()), ("term", pa.int64()), ("df", pa.int32()), ("at", pa.binary()), ("planes", pa.binary()), ("doc_ids", pa.list_(pa.int64()))])


def _block(block: int, doc_ids: pa.Array, terms: np.ndarray, rows: np.ndarray, n_docs: int, n_terms: int):
    """A row for each term, and one without a term for the block's documents."""
    sort = pa.compute.sort_indices(doc_ids, null_placement="at_end").to_numpy()
    place = np.empty(len(sort), np.int64)
    place[sort] = np.arange(len(sort))
    at = place[rows]
    m = 75 + 25 * np.bincount(at, minlength=len(sort)) * n_docs // max(1, n_terms)
    terms, df, borders, byte, planes = slices_of(terms, at, m)
    yield pa.RecordBatch.from_pydict({"block": [block], "term": [None], "df": [None], "at": [None], "planes": [None], "doc_ids": [doc_ids.take(pa.array(sort)).to_pylist()]}, schema=_ARROW)
    for a in range(0, len(terms), ROWS_OUT):
        b = min(len(terms), a + ROWS_OUT)
        cut, lo, hi = borders[a : b + 1] - borders[a], borders[a], borders[b]
        columns = [pa.array(np.full(b - a, block)), pa.array(terms[a:b].view(np.int64)), pa.array(df[a:b].astype(np.int32)), _binary(byte[lo:hi], 2, cut), _binary(planes[lo:hi], SLICES, cut), pa.nulls(b - a, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, schema=_ARROW)


def indexed(docs: DataFrame) -> tuple[DataFrame, int]:
    """The index of all documents as a stored table (INDEX), and N."""
    small_batches(docs.sparkSession)
    docs = narrow(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    n_docs, n_terms = sizes(docs)

    def build(batches):
        block, ids, terms, rows, held, size = TaskContext.get().partitionId() << 32, [], [], [], 0, 0

        def whole():
            return _block(block, pa.concat_arrays(ids), np.concatenate(terms), np.concatenate(rows), n_docs, n_terms)

        for batch in bounded(batches):
            if not batch.num_rows:
                continue
            if ids and (held + batch.num_rows > BLOCK_DOCS or size + batch.nbytes > BLOCK_BYTES):
                yield from whole()
                block, ids, terms, rows, held, size = block + 1, [], [], [], 0, 0
            found, row = _terms(batch)
            ids.append(batch.column("doc_id"))
            terms.append(found)
            rows.append(row + held)
            held, size = held + batch.num_rows, size + batch.nbytes
        if ids:
            yield from whole()
        release()

    return stored(docs.mapInArrow(build, INDEX), "impact-index"), n_docs


def asked_terms(items: DataFrame) -> DataFrame:
    """item_key, item_id, term, times: the terms of each item; rows alike are one item."""
    items = narrow(items, "item_id", "text").distinct().withColumn("item_key", F.xxhash64("item_id", "text"))
    names = ["item_key", "item_id"]

    def cut(batches):
        for batch in bounded(batches):
            terms, rows = _terms(batch)
            columns = [batch.column(c).take(pa.array(rows)) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(terms.view(np.int64))], names=[*names, "term"])

    kinds = ", ".join(f"{c} {items.schema[c].dataType.simpleString()}" for c in names)
    return items.select(*names, "text").mapInArrow(cut, f"{kinds}, term long").groupBy(*names, "term").agg(F.count(F.lit(1)).alias("times"))


def added(a: list[int], b: list[int], shift: int = 0) -> list[int]:
    """The sum of two numbers for each document, as slices from the least significant; b is first multiplied by 2**shift."""
    out, carry = a[:shift] + [0] * (shift - len(a)), 0
    for i in range(shift, max(len(a), len(b) + shift)):
        x, y = a[i] if i < len(a) else 0, b[i - shift] if i - shift < len(b) else 0
        either = x ^ y
        out.append(either ^ carry)
        carry = (x & y) | (carry & either)
    return [*out, carry] if carry else out


def multiplied(slices: list[int], by: int) -> list[int]:
    """Each document's number times `by`: the sum of the slices shifted by each bit of it."""
    out: list[int] = []
    for bit in range(by.bit_length()):
        if by >> bit & 1:
            out = added(out, slices, bit)
    return out


def best(slices: list[int], k: int) -> list[tuple[int, int]]:
    """Place and number of the k documents with the largest numbers above 0, of equal ones those of the first places."""
    surely, maybe = 0, 0
    for s in slices:
        maybe |= s
    for s in reversed(slices):  # maybe: all that are equal so far to the k-th
        if (surely | maybe).bit_count() <= k:
            break
        larger = surely | (maybe & s)
        if larger.bit_count() > k:
            maybe &= s
        else:
            surely, maybe = larger, maybe & ~s
    out = []
    for group in (surely, maybe):
        while group and len(out) < k:
            low = group & -group
            at = low.bit_length() - 1
            out.append((at, sum((s >> at & 1) << i for i, s in enumerate(slices))))
            group ^= low
    return out


def _slices(at: bytes, planes: bytes) -> list[int]:
    """One term's slices in a block as whole bitmaps."""
    places = np.frombuffer(at, "<u2")
    whole = np.zeros((SLICES, int(places[-1]) + 1), np.uint8)
    whole[:, places] = np.frombuffer(planes, np.uint8).reshape(-1, SLICES).T
    return [int.from_bytes(row.tobytes(), "little") for row in whole]


def search(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """item_id, rank, doc_id, score of the k best documents of each item."""
    index, n_docs = indexed(docs)
    asked = stored(asked_terms(items), "impact-items")
    chunks = max(1, math.ceil(asked.count() / CHUNK_TERMS))
    may_be = flagged(index.where("term is not null"), "term", bit_filter(asked.select("term"))).where("may_be").drop("may_be", "doc_ids")
    known = may_be.groupBy(F.col("term").alias("k_term")).agg(F.sum("df").alias("k_df"), F.count(F.lit(1)).alias("n_blocks"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("k_df") + 1))).cast("long")
    use = F.struct("item_key", "item_id", "times")
    weighed = asked.join(known, F.col("term") == F.col("k_term")).withColumn("chunk", F.pmod("item_key", F.lit(chunks)).cast("int"))
    weighed = stored(weighed.groupBy("chunk", F.col("term").alias("a_term")).agg(F.max(weight).alias("weight"), F.max("n_blocks").alias("n_blocks"), F.collect_list(use).alias("uses")), "impact-weights")
    hot = bit_filter(weighed.where(F.col("n_blocks") > HOT_ROWS).select("a_term"))
    met = spread_join(may_be, "term", "block", weighed.drop("n_blocks"), "a_term", hot)

    def ranked(group: pa.Table) -> pa.Table:
        sums: dict[int, list[int]] = {}
        ids = {}
        for weight, at, planes, uses in zip(*(group.column(c).to_pylist() for c in ("weight", "at", "planes", "uses")), strict=True):
            slices, by_times = _slices(at, planes), {}
            for u in uses:
                times = u["times"]
                if times not in by_times:
                    by_times[times] = multiplied(slices, weight * times)
                sums[u["item_key"]] = added(sums.get(u["item_key"], []), by_times[times])
                ids[u["item_key"]] = u["item_id"]
        block = group.column("block")[0].as_py()
        rows = [(key, ids[key], block, at, score) for key, slices in sums.items() for at, score in best(slices, k)]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), item_kind, pa.int64(), pa.int32(), pa.int64()), strict=True)], names=["item_key", "item_id", "block", "at", "score"])

    item_kind = group_type(items)
    found = met.select("chunk", "block", "weight", "at", "planes", "uses").groupBy("chunk", "block").applyInArrow(ranked, f"item_key long, item_id {items.schema['item_id'].dataType.simpleString()}, block long, at int, score long")
    places = index.where("term is null").select(F.col("block").alias("p_block"), F.posexplode("doc_ids").alias("p_at", "doc_id"))
    found = found.join(places, (F.col("block") == F.col("p_block")) & (F.col("at") == F.col("p_at")))
    order = Window.partitionBy("item_key").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "block", "at")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def group_type(items: DataFrame) -> pa.DataType:
    """The Arrow type of item_id."""
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(items.schema["item_id"].dataType)
