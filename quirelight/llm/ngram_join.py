"""N-gram Jaccard self-join by MinHash banding.

A document's set holds the hashes of its N consecutive lower-cased (A-Z) words [^\\x20\\x09-\\x0D]+; a text of fewer
words has one n-gram of all. Documents of equal sets are one class with a count of copies, so copies meet no further.
Each class has bands * rows MinHash values; the rows are as many as a bound on their product allows and the bands as
many as the target recall of a pair at the threshold then needs. Classes are shuffled on band hashes; each is tied to
its bucket's least class, and the components of these ties are the candidate clusters, within which every pair is
verified on the full sets by products of set-membership matrices. A cluster of more than BLOCK classes (or much text)
is cut into blocks and each pair of blocks is a task of its own, which counts between the two blocks only, so that
memory is bounded; a task returns a row for each of its classes, never pairs. Where rows are joined by a cluster or a
class that has many, they are dealt over many tasks (spread_join()).

Cases: null, empty and word-less texts have no n-grams: each is alone, without links; copies link to each other; a
null doc_id is a document, but names a class only if it has no other; of equal doc_ids the row of the lesser text hash
comes first; rows that repeat a doc_id count as documents; very long texts are read whole; columns other than those
named are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirelight.llm.common import HOT_ROWS, bit_filter, bounded, flagged, narrow, row_key, small_batches, spread_join, stored, utf8
from quirelight.llm.graph import components
from quirelight.llm.text_hash import BASE, LOWER, WORD, Ranges, mix, runs, words

N = 5
THRESHOLD = (4, 5)  # as a fraction, so that the test is exact
RECALL = 0.9995
MOST_HASHES = 256
BLOCK = 1024
BLOCK_SHINGLES = 1_000_000
COLUMNS = 4096


def bands_and_rows(threshold: float, recall: float, most: int = MOST_HASHES) -> tuple[int, int]:
    """The most rows, and the bands that give a pair at the threshold the recall, with at most `most` hashes."""
    best = (math.ceil(math.log(1 - recall) / math.log(1 - threshold)), 1)
    for rows in range(2, 33):
        bands = math.ceil(math.log(1 - recall) / math.log1p(-(threshold**rows)))
        if bands * rows <= most:
            best = bands, rows
    return best


def shingles(column, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram hashes of all rows, and the borders of rows."""
    data, offsets = utf8(column)
    data = LOWER[data]
    starts, ends, row = words(data, offsets, WORD)
    hashes = Ranges(data).of(starts, ends)
    rows = len(offsets) - 1
    at = np.searchsorted(row, np.arange(rows + 1))
    grams = runs(hashes, n)
    whole = grams if len(grams) else np.zeros(0, np.uint64)
    inside = row[: len(whole)] == row[n - 1 :] if len(whole) else np.zeros(0, bool)
    count = np.where(np.diff(at) >= n, np.diff(at) - n + 1, np.minimum(np.diff(at), 1))
    border = np.concatenate(([0], np.cumsum(count)))
    out = np.zeros(border[-1], np.uint64)
    short = np.flatnonzero((np.diff(at) > 0) & (np.diff(at) < n))
    is_short = np.zeros(border[-1], bool)
    is_short[border[short]] = True
    out[~is_short] = whole[inside]
    out[is_short] = [runs(hashes[at[i] : at[i + 1]], at[i + 1] - at[i])[0] for i in short]
    return out, border


def _described(batches, n: int, bands: int, rows: int):
    rng = np.random.default_rng(5)
    a = rng.integers(0, 2**63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 2**63, bands * rows, dtype=np.uint64)
    for batch in bounded(batches):
        grams, border = shingles(batch.column("text"), n)
        full = np.flatnonzero(np.diff(border))
        keys: list[bytes | None] = [None] * batch.num_rows
        sizes = [0] * batch.num_rows
        for i in full:
            own = np.unique(grams[border[i] : border[i + 1]])
            keys[i], sizes[i] = hashlib.blake2b(own.tobytes(), digest_size=16).digest(), len(own)
        buckets = np.zeros((batch.num_rows, bands), np.uint64)
        if len(full):
            for k in range(bands * rows):
                least = np.minimum.reduceat(grams * a[k] + b[k], border[full])
                buckets[full, k // rows] = buckets[full, k // rows] * np.uint64(BASE) + mix(least)
            buckets = mix(buckets * np.uint64(BASE) + np.arange(bands, dtype=np.uint64))
        flat = pa.ListArray.from_arrays(pa.array(np.arange(0, batch.num_rows * bands + 1, bands, dtype=np.int32)), pa.array(buckets.reshape(-1).astype(np.int64)))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), flat], ["doc_id", "text_key", "node", "size", "buckets"])


def _matrix(sets: list[np.ndarray], columns: np.ndarray) -> np.ndarray:
    """Which of the (sorted) values each set has, as 0 and 1."""
    out = np.zeros((len(sets), len(columns)), np.float32)
    for i, own in enumerate(sets):
        lo, hi = np.searchsorted(own, [columns[0], columns[-1]])
        own = own[lo : hi + 1]
        at = np.minimum(np.searchsorted(columns, own), len(columns) - 1)
        out[i, at[columns[at] == own]] = 1
    return out


def links_between(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Whether each set of a and each of b are at the threshold. Only values that both sides have are multiplied, COLUMNS
    at once."""
    shared = np.intersect1d(np.unique(np.concatenate(a)), np.unique(np.concatenate(b)), assume_unique=True)
    common = np.zeros((len(a), len(b)), np.float32)  # exact below 2**24
    for at in range(0, len(shared), COLUMNS):
        part = shared[at : at + COLUMNS]
        common += _matrix(a, part) @ _matrix(b, part).T
    up, down = THRESHOLD
    sizes = [np.array([len(s) for s in sets], np.int64) for sets in (a, b)]
    return down * common >= up * (sizes[0][:, None] + sizes[1][None, :] - common)


def verified(table: pa.Table) -> pa.Table:
    """One task's classes: node, copies, block, i, j, grams (sorted 64-bit values). Per class: the documents it links to
    here (in the other block, or in its own if i is j), and the least class it is connected to by these links."""
    i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    nodes, copies, blocks = table.column("node").to_pylist(), table.column("copies").to_numpy(), table.column("block").to_numpy()
    grams = table.column("grams")
    order = sorted(range(len(nodes)), key=nodes.__getitem__)
    rank = np.empty(len(nodes), np.int64)
    rank[order] = np.arange(len(nodes))
    sides = [np.flatnonzero(blocks == i), np.flatnonzero(blocks == j)]
    sets = [[np.frombuffer(grams[int(k)].as_py(), np.uint64) for k in side] for side in sides]
    label, found = rank.copy(), np.zeros(len(nodes), np.int64)
    if len(sides[0]) and len(sides[1]):
        linked = links_between(*sets)
        if i == j:
            np.fill_diagonal(linked, False)
        found[sides[0]] = linked @ copies[sides[1]]
        if i != j:
            found[sides[1]] = linked.T @ copies[sides[0]]
        while True:
            before = label.copy()
            for x, y, near in ((*sides, linked), (*sides[::-1], linked.T)):
                least = np.where(near, label[y][None, :], len(nodes)).min(axis=1)
                label[x] = np.minimum(label[x], least)
            label = np.minimum(label, label[np.array(order)[label]])
            if (label == before).all():
                break
    return pa.table({"node": pa.array(nodes, pa.binary()), "links": pa.array(found), "root": pa.array([nodes[order[k]] for k in label], pa.binary())})


def join(docs: DataFrame, n: int = N, recall: float = RECALL) -> DataFrame:
    """Per document row: doc_id, text_key, class_id (the least doc_id of those connected by links) and n_links (other
    documents of a similarity of 0.8 or more)."""
    spark = docs.sparkSession
    small_batches(spark)
    bands, rows = bands_and_rows(THRESHOLD[0] / THRESHOLD[1], recall)
    docs = narrow(docs, "doc_id", "text").select(*row_key(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")), "text")
    described = stored(docs.mapInArrow(lambda b: _described(b, n, bands, rows), "doc_id long, text_key long, node binary, size long, buckets array<long>"), "ngram-sets")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    classes = described.where("node is not null").groupBy("node").agg(F.min(place).alias("rep"), F.count("*").alias("copies"), F.max("size").alias("size"), F.min("buckets").alias("buckets"))
    classes = stored(classes, "ngram-classes")

    placed = classes.select("node", F.explode("buckets").alias("bucket"))
    least = placed.groupBy("bucket").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least <> most").select(F.col("bucket").alias("b"), "least")
    least = stored(least, "ngram-buckets")
    shared = flagged(placed, "bucket", bit_filter(least.select("b"))).where("may_be").drop("may_be")
    crowds = bit_filter(shared.groupBy("bucket").count().where(F.col("count") > HOT_ROWS).select("bucket"))
    ties = spread_join(shared, "bucket", "node", least, "b", crowds).where("node <> least").select(F.col("node").alias("a"), F.col("least").alias("b")).distinct()
    clusters = components(ties, "ngram-clusters")

    # the sets of clustered classes, from the text of each one's representative, to the tasks that need them
    sized = clusters.join(classes.select(F.col("node").alias("c_node"), "size", "rep", "copies"), F.col("node") == F.col("c_node")).drop("c_node")
    sized = stored(sized, "ngram-clusters")
    large = sized.groupBy(F.col("root").alias("s_root")).agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("size") / BLOCK_SHINGLES)).cast("int").alias("blocks")).where("blocks > 1")
    large = stored(large, "ngram-large")
    crowds = bit_filter(large.select("s_root"))
    some = flagged(sized, "root", crowds)  # the others have one block
    todo = spread_join(some.where("may_be").drop("may_be"), "root", "node", large, "s_root", crowds, "left").drop("s_root").unionByName(some.where("not may_be").drop("may_be").withColumn("blocks", F.lit(1)))
    todo = todo.select("node", "root", F.coalesce("blocks", F.lit(1)).alias("blocks"), "copies", F.col("rep.doc_id").alias("r_doc"), F.col("rep.text_key").alias("r_key"))
    todo = stored(todo, "ngram-todo")
    texts = flagged(docs, "text_key", bit_filter(todo.select("r_key"))).where("may_be").drop("may_be").join(todo, F.col("doc_id").eqNullSafe(F.col("r_doc")) & (F.col("text_key") == F.col("r_key"))).select("node", "root", "blocks", "copies", "text")

    def with_sets(batches):
        for batch in bounded(batches):
            grams, border = shingles(batch.column("text"), n)
            sets = [np.unique(grams[lo:hi]).tobytes() for lo, hi in zip(border[:-1], border[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("node", "root", "blocks", "copies")] + [pa.array(sets, pa.binary())], ["node", "root", "blocks", "copies", "grams"])

    sets = texts.mapInArrow(with_sets, "node binary, root binary, blocks int, copies long, grams binary")
    sets = sets.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks").cast("long")).cast("int"))
    tasks = sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("root", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "copies", "block", "grams")
    # a representative stored twice would come twice
    checked = tasks.groupBy("root", "i", "j").applyInArrow(lambda t: verified(_once(t)), "node binary, links long, root binary")
    checked = stored(checked, "ngram-links")
    links = checked.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(checked.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")).distinct(), "ngram-classes")

    named = classes.select("node", "rep", "copies").join(joined.select(F.col("node").alias("j_node"), "root"), F.col("node") == F.col("j_node"), "left").withColumn("root", F.coalesce("root", "node")).drop("j_node")
    named = named.join(links.withColumnRenamed("node", "l_node"), F.col("node") == F.col("l_node"), "left").drop("l_node")
    named = stored(named, "ngram-named")
    least_id = stored(named.groupBy(F.col("root").alias("g_root")).agg(F.min("rep").alias("first"), F.count("*").alias("classes")), "ngram-first")
    crowds = bit_filter(least_id.where(F.col("classes") > HOT_ROWS).select("g_root"))
    named = spread_join(named, "root", "node", least_id.drop("classes"), "g_root", crowds)
    named = named.select(F.col("node").alias("n_node"), F.col("first.doc_id").alias("class_id"), F.col("first.text_key").alias("class_key"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "copies")
    named = stored(named, "ngram-classes")
    crowds = bit_filter(named.where(F.col("copies") > HOT_ROWS).select("n_node"))
    rows = described.select("doc_id", "text_key", "node").withColumn("row", F.monotonically_increasing_id())  # only deals a class's rows over tasks
    out = spread_join(rows, "node", "row", named.drop("copies"), "n_node", crowds, "left")
    return out.select("doc_id", "text_key", F.coalesce("class_id", F.when(F.col("n_node").isNull(), F.col("doc_id"))).alias("class_id"), F.coalesce("class_key", "text_key").alias("class_key"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def _once(table: pa.Table) -> pa.Table:
    seen: set[bytes] = set()
    keep = [not (x in seen or seen.add(x)) for x in table.column("node").to_pylist()]
    return table.filter(pa.array(keep)).combine_chunks()


def one_of_each(docs: DataFrame) -> DataFrame:
    """docs (all columns), of each class the document with the least doc_id (then text hash), once."""
    found = join(docs)
    kept = found.where(F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("text_key") == F.col("class_key"))).select(F.col("doc_id").alias("ql__kept_doc_id"), F.col("text_key").alias("ql__kept_text_key")).distinct()
    keyed = docs.withColumn("ql__text_key", F.xxhash64(F.coalesce(docs["text"], F.lit(""))))
    matched = keyed.join(kept, F.col("doc_id").cast("long").eqNullSafe(F.col("ql__kept_doc_id")) & (F.col("ql__text_key") == F.col("ql__kept_text_key")), "left_semi")
    return matched.dropDuplicates(["doc_id", "ql__text_key"]).drop("ql__text_key")
