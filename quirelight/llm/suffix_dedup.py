"""Suffix-array deduplication by a distributed merge sort that is aware of common prefixes.

A byte goes when a string of LENGTH bytes that covers it also starts in a document of a smaller doc_id. Strings are
compared on the input. Not every suffix is sorted: in every string of LENGTH bytes the GRAM bytes of least hash are its
anchor, equal strings have equal anchors, and so the suffixes at anchors, with the bytes before them, decide for all.

1. Candidates. Each task writes its documents as blocks of BLOCK_BYTES to the shared folder, so that texts are never
   shuffled, and sends the sorted distinct hashes of a block's grams as differences, by ranges of the hash. Where
   blocks meet, hashes of two documents or more are found, and go back by block.
2. Runs. A block's candidate anchors give keys: the LENGTH bytes from the anchor on (its suffix), then the LENGTH -
   GRAM bytes before it, backwards. The keys are sorted, equal ones joined, and the rest front-coded (the length of the
   prefix shared with the key before, and what follows it), with each key's least document. Which places have a key
   stays in a file beside the block. Each part of the run goes to the task of its gram's hash, as only keys with the
   same gram have a string in common.
3. Merge. A loser tree combines the runs. It keeps for each run the prefix that its key shares with the last winner:
   the longer prefix wins unseen, and where two are equal only the bytes that follow are compared. What leaves it is
   the sorted suffix array with its common prefixes. Equal keys meet: all but the least document's lose every string
   around the anchor. Where a gram has several keys, the strings around it are grouped one alignment at a time.
4. A bit for each key of a run (whether it has the least document), and the alignments that this document loses too, go
   back to the block, whose places give the ranges that are cut from its texts.

However many copies there are, a block sends a key once and gets a bit for it. The tasks of 1 and 3 are as many as the
text needs, TASK_BYTES each.

Cases: null and empty texts have nothing to remove; very long texts are read whole, one that is longer than a block in a
block of its own; matches never cross documents; rows of one doc_id never remove each other's bytes, whatever their
texts; a null doc_id stands with -2**63, before all others; cuts may split a UTF-8 sequence, so what is kept is binary;
columns other than those named are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import pickle
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirelight.llm.common import bounded, files, narrow, release, shared_folder, small_batches, stored, utf8
from quirelight.llm.packing import large, packed, rising, risen, small, unpacked
from quirelight.llm.text_hash import Ranges, mix

LENGTH = 50
GRAM = 24
TASK_BYTES = 16 << 20
BLOCK_BYTES = 12 << 20
NO_ID = -(2**63)
MEMBERS = ".members"
_RANDOM = np.random.default_rng(20260304)
_VALUES, _COEFFICIENTS = (_RANDOM.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2))  # LENGTH up to 140


def sliding(f, values: np.ndarray, width: int) -> np.ndarray:
    """f (minimum or maximum) over each `width` consecutive values."""
    size = 1
    while size * 2 <= width:
        values = f(values[:-size], values[size:])
        size *= 2
    return f(values[: len(values) - (width - size)], values[width - size :]) if size < width else values


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of all strings of that length, and their rows."""
    if len(data) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    width = length - gram + 1
    hashes = Ranges(data).fixed(gram)
    least = sliding(np.minimum, hashes, width)  # by the string's start
    row = np.searchsorted(offsets, np.arange(len(least)), side="right") - 1
    least = np.where(np.arange(len(least)) + length <= offsets[row + 1], least, 0)  # of strings inside a row
    edge = np.zeros(width - 1, np.uint64)
    at = np.flatnonzero(sliding(np.maximum, np.concatenate([edge, least, edge]), width) == hashes)
    # chosen for being least, the hashes crowd at the low end; mixed again they spread evenly over tasks
    return at, mix(hashes[at] ^ np.uint64(0xA0761D6478BD642F)), np.searchsorted(offsets, at, side="right") - 1


def _dealt(batches, folder: str, buckets: int, length: int, gram: int):
    """Writes blocks. Rows (bucket, path, run): of bucket -1 for each block, and for each range of hashes its sorted
    distinct gram hashes as differences, and whether two documents of the block have them."""
    held, hashes, docs, size = [], [], [], 0
    names = ["bucket", "path", "run"]

    def flush():
        if not held:
            return
        path = f"{folder}/block-{uuid.uuid4().hex}.arrows"
        fs, at = files(path)
        fs.create_dir(at.rpartition("/")[0], recursive=True)
        with fs.open_output_stream(at) as sink, pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            for batch in held:
                out.write_batch(batch)
        h, d = np.concatenate(hashes) >> np.uint64(16), np.concatenate(docs)
        held.clear(), hashes.clear(), docs.clear()
        order = np.lexsort((d, h))
        h, d = h[order], d[order]
        first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.zeros(0, np.int64)
        last = np.append(first[1:], len(h))[: len(first)] - 1
        several, h = d[first] != d[last], h[first]
        cuts = np.searchsorted(h, (np.arange(buckets + 1, dtype=np.float64) * (2.0**48 / buckets)).astype(np.uint64))
        some = [b for b in range(buckets) if cuts[b] < cuts[b + 1]]
        blobs = [packed(rising(h[cuts[b] : cuts[b + 1]]), np.packbits(several[cuts[b] : cuts[b + 1]])) for b in some]
        del h, d, order, first, last, several
        release()
        yield pa.RecordBatch.from_arrays([pa.array([-1, *some], pa.int32()), pa.array([path] * (len(some) + 1)), pa.array([b"", *blobs], pa.binary())], names)

    for batch in bounded(batches):
        data, offsets = utf8(batch.column("text"))
        _, h, row = anchors(data, offsets, length, gram)
        held.append(batch)
        hashes.append(h)
        docs.append(batch.column("doc_id").to_numpy()[row])
        size += len(data)
        if size >= BLOCK_BYTES:
            yield from flush()
            size = 0
    yield from flush()


def _shared(table: pa.Table) -> pa.Table:
    """Of one bucket: for each block, its hashes that another document has too."""
    parts = [unpacked(x.as_py()) for x in table.column("run")]
    each = [risen(x[0]) for x in parts]
    h = np.concatenate(each)
    good = np.concatenate([np.unpackbits(x[1], count=len(e)).astype(bool) for x, e in zip(parts, each, strict=True)])
    order = np.argsort(h, kind="stable")
    h, good = h[order], good[order]
    twice = np.zeros(len(h), bool)
    twice[1:] |= h[1:] == h[:-1]
    twice[:-1] |= h[:-1] == h[1:]
    shared = np.zeros(len(h), bool)
    shared[order] = twice | good
    cuts = np.cumsum([0, *map(len, each)])
    found = [e[shared[lo:hi]] for e, lo, hi in zip(each, cuts[:-1], cuts[1:], strict=True)]
    return pa.table({"path": table.column("path"), "hashes": pa.array([packed(rising(x)) if len(x) else None for x in found], pa.binary())}).drop_null()


def _block(path: str):
    """The batches of a block."""
    fs, at = files(path)
    with fs.open_input_stream(at) as source, pa.ipc.open_stream(source) as found:
        yield from found


def _keys(data: np.ndarray, offsets: np.ndarray, at: np.ndarray, row: np.ndarray, length: int, left: int) -> np.ndarray:
    """A key a row: suffix, bytes before it backwards (zeros beyond the text), and how many of both there are."""
    padded = np.concatenate([np.zeros(left, np.uint8), data, np.zeros(length, np.uint8)])
    right = np.minimum(offsets[row + 1] - at, length)
    before = np.minimum(at - offsets[row], left)
    out = np.zeros((len(at), -(-(length + left + 2) // 8) * 8), np.uint8)
    step = np.arange(length)
    out[:, :length] = np.where(step < right[:, None], padded[at[:, None] + left + step], 0)
    step = np.arange(left)
    out[:, length : length + left] = np.where(step < before[:, None], padded[at[:, None] + left - 1 - step], 0)
    out[:, length + left], out[:, length + left + 1] = right, before
    return out


def _sorted_run(table: pa.Table, buckets: int, length: int, gram: int) -> pa.Table:
    """Of one block: for each bucket, the front-coded sorted distinct keys, with each one's least document. Writes the
    keys' rows and places beside the block."""
    path = table.column("path")[0].as_py()
    known = np.unique(np.concatenate([risen(unpacked(x.as_py())[0]) for x in table.column("hashes")]))
    held, ids, rows = [], [], 0
    for batch in _block(path):
        data, offsets = utf8(batch.column("text"))
        at, h, row = anchors(data, offsets, length, gram)
        h = h >> np.uint64(16)
        keep = known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h
        at, h, row = at[keep], h[keep], row[keep]
        bucket = np.minimum((h.astype(np.float64) * (buckets / 2.0**48)).astype(np.int32), buckets - 1)
        held.append((_keys(data, offsets, at, row, length, length - gram), bucket, row + rows, at - offsets[row]))
        ids.append(batch.column("doc_id").to_numpy())
        rows += batch.num_rows
    keys, bucket, which, place = (np.concatenate([x[i] for x in held]) for i in range(4))
    held.clear()
    ids = np.concatenate(ids)
    columns = keys.view(">u8")
    order = np.lexsort((place, ids[which], *(columns[:, i] for i in reversed(range(columns.shape[1]))), bucket))
    keys, bucket, which, place = keys[order], bucket[order], which[order], place[order]
    cuts = np.searchsorted(bucket, np.arange(buckets + 1))
    some, blobs, members = [b for b in range(buckets) if cuts[b] < cuts[b + 1]], [], {}
    for b in some:
        own = slice(cuts[b], cuts[b + 1])
        k = keys[own]
        differ = k[1:] != k[:-1]
        first = np.flatnonzero(np.concatenate(([True], differ.any(axis=1))))
        shared = np.concatenate(([0], differ.argmax(axis=1)[first[1:] - 1])).astype(np.uint8)
        distinct = k[first]
        rest = distinct[np.arange(k.shape[1]) >= shared[:, None]].tobytes()
        blobs.append(packed(k.shape[1], shared, rest, small(ids[which[own]][first])))
        members[b] = packed(small(np.diff(np.append(first, len(k)))), small(which[own]), small(place[own]))
    fs, at = files(path + MEMBERS)
    if fs.get_file_info(at).type == pafs.FileType.NotFound:  # a task that is run again has the same to write
        draft = f"{at}-{uuid.uuid4().hex}"
        with fs.open_output_stream(draft) as sink:
            sink.write(pickle.dumps(members, protocol=5))
        fs.move(draft, at)
    del keys, columns, held
    release()
    return pa.table({"bucket": pa.array(some, pa.int32()), "path": pa.array([path] * len(some), pa.string()), "run": pa.array(blobs, pa.binary())})


class Run:
    """A front-coded run, read key by key; key: the current one, None at the end."""

    def __init__(self, blob: bytes):
        self.width, shared, self.rest, least = unpacked(blob)
        self.shared, self.least = shared.tolist(), large(least)  # the least document of each key
        self.i, self.at, self.key = -1, 0, b""
        self.step()

    def step(self) -> int:
        """Read the next key; returns the prefix that it shares with the last one."""
        self.i += 1
        if self.i == len(self.shared):
            self.key = None
            return 0
        n = self.shared[self.i]
        upto = self.at + self.width - n
        self.key = self.key[:n] + self.rest[self.at : upto]
        self.at = upto
        return n


def merged(runs: list[Run]):
    """The loser tree: yields (prefix shared with the key before, run's number), the run standing at its key, in order.
    A run's prefix is with the last winner. The longer one is the smaller key, unseen; at equal ones the bytes after it
    are compared, which gives the loser's prefix with the new winner. A prefix of the whole width is an equal key."""
    size = 1
    while size < len(runs):
        size *= 2
    width = runs[0].width
    keys = [r.key for r in runs] + [None] * (size - len(runs))
    prefix = [0] * size

    def play(a: int, b: int) -> tuple[int, int]:
        x, y = keys[a], keys[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        p, q = prefix[a], prefix[b]
        if p != q:
            return (a, b) if p > q else (b, a)
        x, y = int.from_bytes(x[p:], "big"), int.from_bytes(y[p:], "big")
        if x == y:
            prefix[b] = width
            return a, b
        common = width - (((x ^ y).bit_length() + 7) >> 3)
        if x < y:
            prefix[b] = common
            return a, b
        prefix[a] = common
        return b, a

    losers = [0] * size
    winners = list(range(size))
    level = size
    while level > 1:  # the first matches, from the leaves up
        half = level // 2
        after = []
        for k in range(half):
            won, lost = play(winners[2 * k], winners[2 * k + 1])
            losers[half + k] = lost
            after.append(won)
        winners, level = after, half
    top = winners[0]
    while keys[top] is not None:
        run = runs[top]
        yield prefix[top], top
        prefix[top] = run.step()
        keys[top] = run.key
        node = (top + size) >> 1
        while node:
            top, losers[node] = play(top, losers[node])
            node >>= 1


def _decided(table: pa.Table, length: int, gram: int) -> pa.Table:
    """One bucket's runs merged. For each block: which of its run's keys have the key's least document, and of these the
    ranges of alignments (numbers of bytes before the anchor) that an earlier document's other key of the gram has too."""
    left = length - gram
    runs = [Run(x.as_py()) for x in table.column("run")]
    width = runs[0].width
    shared, of_run, distinct = [], [], []
    for n, r in merged(runs):
        shared.append(n)
        of_run.append(r)
        if n < width:
            distinct.append(runs[r].key)
    shared, of_run = np.array(shared), np.array(of_run)
    key = np.cumsum(shared < width) - 1  # of each merged place: the distinct key's number
    keys = np.frombuffer(b"".join(distinct), np.uint8).reshape(len(distinct), -1)
    group = (np.cumsum(shared < gram) - 1)[shared < width]  # of each distinct key: its gram's number
    order = np.argsort(of_run, kind="stable")  # a run's keys leave the tree in the run's order
    key, least = key[order], np.concatenate([r.least for r in runs])
    first = np.full(len(keys), np.iinfo(np.int64).max)
    np.minimum.at(first, key, least)
    has_least = least == first[key]
    sizes = [len(r.least) for r in runs]
    del runs, distinct
    right, before = keys[:, length + left].astype(np.int64), keys[:, length + left + 1].astype(np.int64)

    # strings that the least document of a key shares with an earlier document's other key of the gram
    many = np.flatnonzero((np.bincount(group)[group] > 1) & (right + before >= length))
    number = np.zeros(0, np.int64)
    lo = hi = number
    if len(many):
        own = keys[many]
        earlier = np.zeros((len(many), left + 3), np.int8)  # by the number of bytes before the anchor, from column 1
        ahead = np.zeros(len(many), np.uint64)
        back = [np.zeros(len(many), np.uint64)]
        for i in range(left):
            back.append(back[-1] + _COEFFICIENTS[length + i] * _VALUES[own[:, length + i]])
        for i in range(length):
            ahead += _COEFFICIENTS[i] * _VALUES[own[:, i]]
            o = length - 1 - i
            if o > left:
                continue
            can = np.flatnonzero((right[many] > i) & (before[many] >= o))
            if len(can):
                _, which = np.unique(ahead[can] + back[o][can], return_inverse=True)
                earliest = np.full(which.max() + 1, np.iinfo(np.int64).max)
                np.minimum.at(earliest, which, first[many[can]])
                earlier[can, o + 1] = earliest[which] < first[many[can]]
        change = np.diff(earlier, axis=1)
        row, lo = np.nonzero(change == 1)
        hi = np.nonzero(change == -1)[1] - 1  # alignments lo to hi are one range
        number = many[row]
    ends = np.cumsum(sizes)
    blobs = []
    for a, b in zip(ends - sizes, ends, strict=True):
        # keys of this run that have the least document, with their ranges
        at = np.searchsorted(number, key[a:b])
        n = np.where(has_least[a:b], np.searchsorted(number, key[a:b], side="right") - at, 0)
        pick = np.repeat(at - np.cumsum(n) + n, n) + np.arange(n.sum())
        blobs.append(packed(np.packbits(has_least[a:b]), small(np.repeat(np.arange(b - a), n)), small(lo[pick]), small(hi[pick])))
    out = pa.table({"path": table.column("path"), "bucket": table.column("bucket"), "answer": pa.array(blobs, pa.binary())})
    del keys, key
    release()
    return out


def _ranges(members: bytes, answer: bytes, ids: np.ndarray, sizes: np.ndarray, length: int, left: int) -> tuple[np.ndarray, ...]:
    """Rows, starts and sizes of what goes around one bucket's anchors in a block."""
    counts, rows, places = (large(x) for x in unpacked(members))
    bits, number, lo, hi = unpacked(answer)
    number, lo, hi = large(number), large(lo), large(hi)
    has_least = np.unpackbits(bits, count=len(counts)).astype(bool)
    key, begin = np.repeat(np.arange(len(counts)), counts), np.cumsum(counts) - counts
    before, right = np.minimum(places, left), np.minimum(sizes[rows] - places, length)
    own = ids[rows]
    # places are in order of their documents: the first of a key is of its least document in the block
    later = (~has_least[key] | (own > own[begin[key]])) & (before + right >= length)
    out = [(rows[later], (places - before)[later], (before + right)[later])]
    if len(number):
        n = counts[number]
        at = np.repeat(begin[number] - np.cumsum(n) + n, n) + np.arange(n.sum())
        of = np.repeat(np.arange(len(number)), n)
        least = own[at] == own[begin[number]][of]
        at, of = at[least], of[least]
        out.append((rows[at], places[at] - hi[of], hi[of] + length - lo[of]))
    return tuple(np.concatenate([x[i] for x in out]) for i in range(3))


def _cut(path: str, answers: pa.Table, length: int, gram: int) -> pa.Table:
    """A block's documents without the removed ranges."""
    ids, sizes = [], []
    for batch in _block(path):
        ids.append(batch.column("doc_id").to_numpy())
        sizes.append(np.diff(utf8(batch.column("text"))[1]))
    ids, sizes = np.concatenate(ids), np.concatenate(sizes)
    found = [(np.zeros(0, np.int64),) * 3]
    if answers.num_rows:
        fs, at = files(path + MEMBERS)
        with fs.open_input_stream(at) as source:
            members = pickle.loads(source.read())
        found += [_ranges(members[b], a, ids, sizes, length, length - gram) for b, a in zip(answers.column("bucket").to_pylist(), answers.column("answer").to_pylist(), strict=True)]
        del members
    rows, start, size = (np.concatenate([x[i] for x in found]) for i in range(3))
    order = np.argsort(rows, kind="stable")
    rows, start, size = rows[order], start[order], size[order]
    out, before = [], 0
    for batch in _block(path):
        data, offsets = utf8(batch.column("text"))
        lo, hi = np.searchsorted(rows, [before, before + batch.num_rows])
        begin = offsets[rows[lo:hi] - before] + start[lo:hi]
        change = np.zeros(len(data) + 1, np.int64)
        np.add.at(change, begin, 1)
        np.add.at(change, begin + size[lo:hi], -1)
        gone = np.cumsum(change)[:-1] > 0
        border = np.zeros(len(data) + 1, bool)
        border[offsets] = True
        opens = gone & (np.concatenate(([True], ~gone[:-1]))[: len(gone)] | border[:-1])
        total = lambda x: np.diff(np.concatenate(([0], np.cumsum(x)))[offsets])
        kept = [data[a:b][~gone[a:b]].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        doc_id = pc.if_else(batch.column("no_id"), pa.scalar(None, pa.int64()), batch.column("doc_id"))
        out.append(pa.table({"doc_id": doc_id, "n_bytes": pa.array(np.diff(offsets)), "n_removed": pa.array(total(gone)), "n_spans": pa.array(total(opens)), "kept": pa.array(kept, pa.binary())}))
        before += batch.num_rows
    return pa.concat_tables(out)


def dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Per document row: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept (binary)."""
    spark = docs.sparkSession
    small_batches(spark)
    doc_id = F.col("doc_id").cast("long")
    docs = narrow(docs, "doc_id", "text").select(F.coalesce(doc_id, F.lit(NO_ID)).alias("doc_id"), doc_id.isNull().alias("no_id"), "text")
    size = docs.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    buckets = max(1, -(-size // TASK_BYTES))
    folder = f"{shared_folder(spark)}/suffix-{uuid.uuid4().hex}"
    dealt = stored(docs.mapInArrow(lambda b: _dealt(b, folder, buckets, length, gram), "bucket int, path string, run binary"), "suffix-hashes")
    blocks = dealt.where("bucket = -1").select("path")
    n = max(1, 2 * blocks.count())  # partitions for blocks: most have one, and they are never coalesced
    found = dealt.where("bucket >= 0").repartition(buckets, "bucket").groupBy("bucket").applyInArrow(_shared, "path string, hashes binary")
    runs = found.repartition(n, "path").groupBy("path").applyInArrow(lambda t: _sorted_run(t, buckets, length, gram), "bucket int, path string, run binary")
    answers = runs.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(lambda t: _decided(t, length, gram), "path string, bucket int, answer binary")
    cut = blocks.repartition(n, "path").groupBy("path").cogroup(answers.repartition(n, "path").groupBy("path")).applyInArrow(lambda a, b: _cut(a.column("path")[0].as_py(), b, length, gram), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
    return cut


def digest(cut: DataFrame) -> DataFrame:
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
