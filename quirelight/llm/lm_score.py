"""LM scoring by a probabilistic suffix tree over words, beside a word-count baseline.

A text's symbols are its lower-cased (A-Z) words [^\\x20\\x09-\\x0D]+ and an end. A word that no training text has is one
symbol, unknown, in the model as in the baseline, so both are distributions over the same V + 1 symbols.

A context is up to DEPTH symbols that precede another in the training texts; one that occurs as often as its suffix
without the oldest symbol stands at the same places, and is no state of its own. Of a context's successors those seen LEAST times or
more are kept, the others are left to the shorter context. A context is retained if n times the divergence (in nats) of
its next-symbol distribution, with what isn't kept as one symbol, from that of the context without its oldest symbol is
at least GAIN after a charge of 1 + log(n) / 2 for each kept successor, n being how often it occurs; and with it all its
suffixes. Nothing bounds the number of contexts: it grows with the corpus. Distributions are smoothed by absolute
discounts: a kept successor has (count - DISCOUNT) / n, and what is left over goes to the suffix's distribution. The
root gives unknown the share of training symbols that are words seen once (plus a half), and known ones the rest by
count. A text is scored by its longest retained suffix before each symbol.

Counts of all training documents are needed wherever a text is scored, so documents are written as blocks of
BLOCK_BYTES of text to the shared folder, as numbers of the block's distinct words; texts are never shuffled. In rounds,
each block sends sorted distinct hashes with its training counts by ranges of the hash, where all blocks' counts are
added, and gets the sums back in the order it sent them, which it keeps beside the block: words; pairs of words that
occur LEAST times; runs of three, of four (DEPTH + 1), both of whose parts do; then, for contexts of DEPTH symbols, of
two (in parts, which bounds what a round moves), of one, what its training kept successors say of each (a successor is told of by the first block that has it, so it
is in one sum only), which is answered with what the block needs to score its documents. A round is one job, of which only the sums beside the blocks are
left: its shuffles go with it, and all that was beside the blocks when the scores are stored. A range is what TASK_BYTES
of text need; a frequent word, pair or context is one entry a block like any other.

A run is asked for only if it can matter. A context that occurs n times, and its suffix m times, has a divergence of n
log(m / n) at most (see may_gain()), so many are known not to be retained by these counts alone; and one that occurs less
than worth() times can't have a retained extension either. What follows a context that is neither, and such contexts
themselves, change no score. Counts are of all blocks, so all blocks leave out the same.

Hashes of words have 64 bits. Those of longer runs, of which a clash only adds counts in the model, have SPARE_BITS more
than the number of bytes of all texts has.

Cases: a null or empty text is the end alone; a very long text is a block of its own; without training documents N and V
are 0 and both scores are 0; ties do not arise, as nothing is ranked; rows that repeat a doc_id are scored apart; a null
doc_id hashes as the empty string; columns other than those named are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirelight.llm.common import bounded, files, held_out, narrow, release, shared_folder, shuffles_dropped, small_batches, stored, utf8
from quirelight.llm.packing import packed, planed, planes, rising, risen, unpacked
from quirelight.llm.text_hash import LOWER, WORD, Ranges, mix, runs, words

DEPTH = 3
LEAST = 2
GAIN = 4.0
DISCOUNT = 0.5
BLOCK_BYTES = 8 << 20
TASK_BYTES = 12 << 20
SPARE_BITS = 12
PART_BITS = 1  # longer contexts are judged in 2 ** PART_BITS rounds, by the first bits of their hashes
END_HASH = np.uint64(1)  # as a word
SENT = "path string, bucket int, blob binary"
ANSWERED = "path string, bucket int, blob binary, n long, v long, once long"
KEPT = "n long, v long, once long"
RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
#: What a divergence can lack by rounding: of the sums of shares, which are sent with 24 bits, times a count.
ROUNDING = 1e-6


def worth() -> float:
    """How often a context occurs at least of which some extension can be retained: m / e is the most of n log(m / n)."""
    return np.e * 0.95 * (GAIN + 1)


def may_gain(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Whether contexts that occur n times may be retained, their suffixes occurring m times (for two symbols or more). A successor's share is log(kept / n / (its occurrences after the suffix / m)), and it follows the suffix kept
    times at least, so each of the n occurrences adds log(m / n) at most, those of no kept successor likewise."""
    n, m = np.maximum(n, 1), np.maximum(m, 1)
    return n * np.log(np.maximum(m, n) / n) + 0.05 + ROUNDING * m >= GAIN + 1 + 0.5 * np.log(n)


def _dealt(batches, folder: str):
    """Writes blocks; their paths."""
    held, size, part, number = [], 0, TaskContext.get().partitionId(), 0

    def flush():
        path = f"{folder}/block-{part:06d}-{number:06d}-{uuid.uuid4().hex}"
        _write(path, Block(held).kept())
        held.clear()
        release()
        return pa.RecordBatch.from_arrays([pa.array([path])], ["path"])

    for batch in bounded(batches):
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.nbytes
        if size >= BLOCK_BYTES:
            yield flush()
            size, number = 0, number + 1
    if held:
        yield flush()


def _write(path: str, data: bytes) -> None:
    """A task that is run again has the same to write, or a block of another name."""
    fs, at = files(path)
    if fs.get_file_info(at).type == pafs.FileType.NotFound:
        fs.create_dir(at.rpartition("/")[0], recursive=True)
        draft = f"{at}-{uuid.uuid4().hex}"
        with fs.open_output_stream(draft) as sink:
            sink.write(data)
        fs.move(draft, at)


def _read(path: str) -> tuple:
    fs, at = files(path)
    with fs.open_input_stream(at) as source:
        return unpacked(source.read())


class Block:
    """The symbols of a block's documents. words: hashes of distinct ones, number: which of them each symbol is; place: of
    a symbol in its document; train: whether it may be learned from."""

    def __init__(self, batches):
        ids, held, hashes, sizes = [], [], [], []
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            data = LOWER[data]
            starts, ends, of = words(data, offsets, WORD)
            n = np.bincount(of, minlength=batch.num_rows)
            found = np.full(len(of) + batch.num_rows, END_HASH, np.uint64)
            found[np.arange(len(of)) + of] = Ranges(data).of(starts, ends)  # each earlier row has an end too
            hashes.append(found)
            sizes.append(n + 1)
            ids.append(batch.column("doc_id"))
            held.append(batch.column("held_out").to_numpy(zero_copy_only=False))
        self.doc_id = pa.chunked_array(ids)
        self.words, self.number = np.unique(np.concatenate(hashes), return_inverse=True)
        self._laid_out(np.concatenate(held), np.concatenate(sizes))

    def _laid_out(self, held: np.ndarray, sizes: np.ndarray) -> None:
        self.held, self.sizes, self.hash = held, sizes, self.words[self.number]
        self.place = np.arange(len(self.hash)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.train = np.repeat(~held, sizes)

    def kept(self) -> bytes:
        """As written: words by classes of how often they occur, the most frequent first, so that numbers take few bytes."""
        level = np.frexp(np.bincount(self.number, minlength=len(self.words)))[1]
        order, rank = np.lexsort((self.words, -level)), np.empty(len(level), np.int64)
        rank[order] = np.arange(len(level))
        cuts = np.flatnonzero(np.diff(level[order])) + 1
        return packed(pc.fill_null(self.doc_id, 0).to_numpy(), np.packbits(pc.is_null(self.doc_id).to_numpy()), np.packbits(self.held), planed(self.sizes), [rising(x) for x in np.split(self.words[order], cuts)], planed(rank[self.number]))

    @classmethod
    def read(cls, path: str) -> Block:
        doc_id, null, held, sizes, distinct, number = _read(path)
        out, n = cls.__new__(cls), len(doc_id)
        distinct = np.concatenate([risen(x) for x in distinct])
        order, rank = np.argsort(distinct), np.empty(len(distinct), np.int64)
        rank[order] = np.arange(len(distinct))
        out.words, out.number = distinct[order], rank[planes(number)]
        out.doc_id = pa.array(doc_id, mask=np.unpackbits(null, count=n).astype(bool))
        out._laid_out(np.unpackbits(held, count=n).astype(bool), planes(sizes))
        return out

    def grams(self, k: int, bits: int) -> np.ndarray:
        """Hashes of the k symbols up to each one (of no meaning where a document has fewer before it)."""
        out = np.zeros(len(self.hash), np.uint64)
        out[k - 1 :] = runs(self.hash, k)
        return mix(out ^ np.uint64(k * 0x9E3779B97F4A7C15 % 2**64)) >> np.uint64(64 - bits)


class Counts:
    """Training counts of a block's grams: count[k] of the k symbols up to each one, 0 where it isn't known to be LEAST or
    more (k > 1); first[k]: a place of each gram of LEAST or more that this block is the first to have. Both are filled
    round by round; asked() gives what the next round asks for."""

    def __init__(self, block: Block, depth: int, bits: int):
        self.block, self.depth, self.bits, self.count, self.first = block, depth, bits, {}, {}

    @classmethod
    def known(cls, path: str, depth: int, bits: int, upto: int) -> Counts:
        """A block's counts of grams of up to so many symbols, from the files beside it."""
        out = cls(Block.read(path), depth, bits)
        for k in range(1, upto + 1):
            values, first = _read(f"{path}.counts{k}")
            if k == 1:
                out.count[1] = planes(values)[out.block.number]
            else:
                at = out.places(k)
                out.count[k] = np.zeros(len(out.block.hash), np.int64)
                out.count[k][at] = planes(values)
                out.first[k] = at[np.unpackbits(first, count=len(at)).astype(bool)]
        return out

    def places(self, k: int) -> np.ndarray:
        """Where grams of k symbols are asked for (the indexes of their last symbols)."""
        back = lambda x: np.concatenate((np.zeros(1, x.dtype), x[:-1]))
        n = self.count[k - 1]
        often = (n >= LEAST) & (back(n) >= LEAST) & (self.block.place > 0)
        if k > 2:  # for what follows a context, or an extension of it, or as a context
            at = np.flatnonzero(often)
            often[at] = self.is_state(k - 1, at) & may_gain(n[at - 1], self.count[k - 2][at - 1])
            if k <= self.depth:
                often[at] |= np.maximum(n[at - 1], n[at]) >= worth()
        return np.flatnonzero(often)

    def asked(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The places that are asked for; the distinct hashes, the first place of each, and which of them each place has."""
        at = self.places(k)
        distinct, place, which = np.unique(self.block.grams(k, self.bits)[at], return_index=True, return_inverse=True)
        return at, distinct, place, which

    def sent(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct hashes and their training counts."""
        if k == 1:
            return self.block.words, np.bincount(self.block.number, self.block.train, len(self.block.words)).astype(np.int64)
        at, distinct, _, which = self.asked(k)
        return distinct, np.bincount(which, self.block.train[at], len(distinct)).astype(np.int64)

    def answered(self, k: int, blobs: list[bytes]) -> bytes:
        """What is kept of the answers, which are in order of the ranges."""
        parts = [unpacked(x) for x in blobs]
        total = np.concatenate([np.zeros(0, np.int64), *[planes(n) for n, _ in parts]])
        if k == 1:
            return packed(planed(total), None)
        at, _, place, which = self.asked(k)
        mine = np.concatenate([np.zeros(0, bool), *[np.unpackbits(f, count=n[0]).astype(bool) for n, f in parts]])
        first = np.zeros(len(at), bool)
        first[place[mine & (total >= LEAST)]] = True
        n = np.minimum(total[which], np.minimum(self.count[k - 1][at], self.count[k - 1][at - 1]))  # hashes may clash
        return packed(planed(np.where(n >= LEAST, n, 0)), np.packbits(first))

    def root(self, totals: tuple[int, int, int]) -> np.ndarray:
        """The root's probability of each symbol."""
        n, _, once = totals
        if not n:
            return np.ones(len(self.block.hash))
        unknown = (once + 0.5) / (n + 1)
        return np.where(self.count[1] > 0, (1 - unknown) * self.count[1] / n, unknown)

    def is_state(self, d: int, at: np.ndarray) -> np.ndarray:
        """Whether the d symbols before each of the places are a state of their own, that occurs LEAST times."""
        n = self.count[d][at - 1]
        return (self.block.place[at] >= d) & (n >= LEAST) & ((n < self.count[d - 1][at - 1]) if d > 1 else True)

    def matters(self, d: int, at: np.ndarray) -> np.ndarray:
        """Whether such a state may be retained, or be a suffix of one that is."""
        state = self.is_state(d, at)
        if d > 1:
            n = self.count[d][at - 1]
            state &= may_gain(n, self.count[d - 1][at - 1]) | ((n >= worth()) if d < self.depth else False)
        return state

    def contexts(self, d: int, length: np.ndarray, part: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The places that have a context of that length which may be retained, or a longer one that is (length: of the
        longest known to be retained), of one part or all; the distinct contexts' hashes, a place of each, and which each
        place has."""
        at = np.arange(1, len(self.block.hash))
        at = at[self.is_state(d, at)]
        if d > 1:
            at = at[may_gain(self.count[d][at - 1], self.count[d - 1][at - 1]) | (length[at] > d)]
        at = at[self.in_part(d, at, part)]
        distinct, place, which = np.unique(self.block.grams(d, self.bits)[at - 1], return_index=True, return_inverse=True)
        return at, distinct, at[place], which

    def in_part(self, d: int, at: np.ndarray, part: int | None) -> np.ndarray:
        if part is None:
            return np.ones(len(at), bool)
        return self.block.grams(d, self.bits)[at - 1] >> np.uint64(self.bits - PART_BITS) == np.uint64(part)

    def longest(self, path: str, d: int) -> np.ndarray:
        """The length of the longest retained context of more than d symbols before each place, from the files beside the
        block; 0 without."""
        length = np.zeros(len(self.block.hash), np.int64)
        for k in range(self.depth, d, -1):
            for part in range(1 << PART_BITS):
                _, bits, size = _read(f"{path}.contexts{k}-{part}")
                length[np.unpackbits(bits, count=size).astype(bool) & (length == 0)] = k
        return length


def _range(hashes: np.ndarray, bits: int, buckets: int) -> np.ndarray:
    """Borders in sorted hashes of equal ranges of their values."""
    return np.searchsorted(hashes, np.array([b * 2**bits // buckets for b in range(buckets)], np.uint64)).tolist() + [len(hashes)]


def _rows(path: str, hashes: np.ndarray, bits: int, buckets: int, blob) -> pa.Table:
    """Rows of SENT: for each range that has hashes, blob(slice)."""
    cuts = _range(hashes, bits, buckets)
    some = [b for b in range(buckets) if cuts[b] < cuts[b + 1]]
    return pa.table({"path": pa.array([path] * len(some), pa.string()), "bucket": pa.array(some, pa.int32()), "blob": pa.array([blob(slice(cuts[b], cuts[b + 1])) for b in some], pa.binary())})


def _blobs(answers: pa.Table) -> list[bytes]:
    """In order of the ranges."""
    found = zip(answers.column("bucket").to_pylist(), answers.column("blob").to_pylist(), strict=True)
    return [x for _, x in sorted((b, x) for b, x in found if x is not None)]


def _sent_counts(path: str, k: int, depth: int, bits: int, buckets: int) -> pa.Table:
    hashes, n = Counts.known(path, depth, bits, k - 1).sent(k)
    out = _rows(path, hashes, 64 if k == 1 else bits, buckets, lambda x: packed(rising(hashes[x]), planed(n[x])))
    release()
    return out


def _kept_counts(answers: pa.Table, k: int, depth: int, bits: int) -> pa.Table:
    """Writes a block's answers beside it; the totals of the ranges are passed on."""
    path = answers.column("path")[0].as_py()
    if path is not None:
        _write(f"{path}.counts{k}", Counts.known(path, depth, bits, k - 1).answered(k, _blobs(answers)))
        release()
    return pa.table({c: pa.array([pc.sum(answers.column(c)).as_py() or 0], pa.int64()) for c in ("n", "v", "once")})


def _added(table: pa.Table) -> pa.Table:
    """One range: all blocks' counts added. For each block the sums in the order it sent, and which it is the first to
    have; and one row with how many words there are, how many distinct ones and how many seen once."""
    table = table.sort_by("path")
    paths, parts = table.column("path").to_pylist(), [unpacked(x) for x in table.column("blob").to_pylist()]
    hashes = [risen(x[0]) for x in parts]
    every, place, which = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
    total = np.bincount(which, np.concatenate([planes(x[1]) for x in parts]), len(every)).astype(np.int64)
    first = np.zeros(len(which), bool)
    first[place] = True
    ends = np.cumsum([len(h) for h in hashes])
    blobs = [packed(planed(total[which[b - len(h) : b]]), np.packbits(first[b - len(h) : b])) for h, b in zip(hashes, ends, strict=True)]
    bucket, n = table.column("bucket")[0].as_py(), len(paths)
    out = pa.table({"path": pa.array([*paths, None], pa.string()), "bucket": pa.array([bucket] * (n + 1), pa.int32()), "blob": pa.array([*blobs, None], pa.binary()), **{k: pa.array([0] * n + [int(v)], pa.int64()) for k, v in (("n", total.sum()), ("v", (total > 0).sum()), ("once", (total == 1).sum()))}})
    del every, which, total, hashes, parts
    release()
    return out


def _evidence(path: str, d: int, part: int | None, depth: int, bits: int, buckets: int, totals: tuple[int, int, int]) -> pa.Table:
    """A block's contexts of d symbols, which of them are suffixes of retained ones here, and what the kept successors
    that it is the first to have say of theirs: how often they occur times the log of their share over that in the suffix,
    the latter, how often they occur, and their number; and n."""
    counts = Counts.known(path, depth, bits, depth + 1)
    length = counts.longest(path, d)
    at, own, _, which = counts.contexts(d, length, part)
    inner = np.bincount(which, length[at] > d, len(own)) > 0
    at = counts.first[d + 1]
    at = at[counts.matters(d, at) & counts.in_part(d, at, part)]
    told, of = np.unique(counts.block.grams(d, bits)[at - 1], return_inverse=True)
    n = np.ones(len(told), np.int64)
    n[of] = counts.count[d][at - 1]
    kept = counts.count[d + 1][at].astype(float)
    before = counts.root(totals)[at] if d == 1 else counts.count[d][at] / counts.count[d - 1][at - 1]
    sums = [np.bincount(of, x, len(told)) for x in (kept * np.log(kept / (n[of] * before)), before, kept, np.ones(len(kept)))]
    distinct = np.union1d(own, told)
    asks, has, marked = np.isin(distinct, own), np.isin(distinct, told), np.zeros(len(distinct), bool)
    marked[asks] = inner
    upto = np.concatenate(([0], np.cumsum(has)))

    def blob(x: slice) -> bytes:
        t = slice(upto[x.start], upto[x.stop])
        return packed(rising(distinct[x]), np.packbits(asks[x]), np.packbits(marked[x][asks[x]]), np.packbits(has[x]), planed(n[t]), sums[0][t].astype(np.float32), sums[1][t].astype(np.float32), planed(sums[2][t].astype(np.int64)), planed(sums[3][t].astype(np.int64)))

    out = _rows(path, distinct, bits, buckets, blob)
    release()
    return out


def retained(n: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Whether contexts are retained, from the sums of _evidence()."""
    gain, before, kept, successors = sums
    rest = n - kept
    spread = np.where(rest > 0, rest * np.log(np.maximum(rest, 1) / n / np.maximum(1 - before, 1e-9)), 0)
    return (kept > 0) & (gain + spread - successors * (1 + 0.5 * np.log(n)) >= GAIN)


def _judged(table: pa.Table) -> pa.Table:
    """One range of contexts: for each block, in the order it sent, which of those it asks for are retained; and of these
    and of suffixes of retained ones, how often no kept successor follows, and how many there are."""
    table = table.sort_by("path")
    paths, parts = table.column("path").to_pylist(), [unpacked(x) for x in table.column("blob").to_pylist()]
    hashes = [risen(x[0]) for x in parts]
    every, which = np.unique(np.concatenate(hashes), return_inverse=True)
    n, sums, at, spans = np.ones(len(every), np.int64), np.zeros((4, len(every))), 0, []
    for h, (_, asks, marked, has, times, *values) in zip(hashes, parts, strict=True):
        own = which[at : at + len(h)]
        at += len(h)
        asked = own[np.unpackbits(asks, count=len(h)).astype(bool)]
        spans.append((asked, np.unpackbits(marked, count=len(asked)).astype(bool)))
        own = own[np.unpackbits(has, count=len(h)).astype(bool)]
        n[own] = planes(times)
        for i, x in enumerate((values[0], values[1], planes(values[2]), planes(values[3]))):
            sums[i, own] += x  # a block has a context once
    sums[1], sums[2] = np.minimum(sums[1], 1), np.minimum(sums[2], n)  # hashes may clash
    good, blobs = retained(n, sums), []
    rest, successors = (n - sums[2]).astype(np.int64), sums[3].astype(np.int64)
    for own, inner in spans:
        needed = own[(good[own] | inner) & (sums[3, own] > 0)]
        blobs.append(packed(len(own), np.packbits((good[own] | inner) & (sums[3, own] > 0)), np.packbits(good[needed]), planed(rest[needed]), planed(successors[needed])))
    k = len(paths)
    out = pa.table({"path": pa.array(paths, pa.string()), "bucket": table.column("bucket"), "blob": pa.array(blobs, pa.binary()), **{c: pa.array([0] * k, pa.int64()) for c in ("n", "v", "once")}})
    del every, which, sums, hashes, parts
    release()
    return out


def _answered(blobs: list[bytes], times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of a block's contexts, which occur so many times: whether each is retained, and the share left to its suffix (1
    without kept successors, or where no text here needs it)."""
    good, left, at = np.zeros(len(times), bool), np.ones(len(times)), 0
    for n, some, bits, rest, successors in (unpacked(x) for x in blobs):
        own = at + np.flatnonzero(np.unpackbits(some, count=n))
        at += n
        good[own] = np.unpackbits(bits, count=len(own)).astype(bool)
        left[own] = (planes(rest) + DISCOUNT * planes(successors)) / times[own]
    return good, left


def _kept_contexts(answers: pa.Table, d: int, part: int, depth: int, bits: int) -> pa.Table:
    """Writes a block's answers beside it, and before which symbols a context of d symbols is retained."""
    path, blobs = answers.column("path")[0].as_py(), _blobs(answers)
    counts = Counts.known(path, depth, bits, depth + 1)
    at, _, place, which = counts.contexts(d, counts.longest(path, d), part)
    there = np.zeros(len(counts.block.hash), bool)
    there[at] = _answered(blobs, counts.count[d][place - 1])[0][which]
    _write(f"{path}.contexts{d}-{part}", packed(blobs, np.packbits(there), len(there)))
    release()
    return pa.table({c: pa.array([0], pa.int64()) for c in ("n", "v", "once")})


def probabilities(counts: Counts, totals: tuple[int, int, int], path: str, blobs: list[bytes]) -> np.ndarray:
    """Of each symbol, by the longest retained suffix of what precedes it. blobs: the answers to contexts of one symbol;
    those to longer ones are beside the block."""
    length, levels = np.zeros(len(counts.block.hash), np.int64), []
    for d in range(counts.depth, 0, -1):
        at, _, place, which = counts.contexts(d, length)
        found = blobs if d == 1 else [x for part in range(1 << PART_BITS) for x in _read(f"{path}.contexts{d}-{part}")[0]]
        good, left = _answered(found, counts.count[d][place - 1])
        found = at[good[which]]
        length[found] = np.maximum(length[found], d)
        some = length[at] >= d
        levels.append((d, at[some], left[which[some]]))
    p = counts.root(totals)
    for d, places, share in reversed(levels):
        kept = counts.count[d + 1][places]
        p[places] = np.where(kept >= LEAST, kept - DISCOUNT, 0) / counts.count[d][places - 1] + share * p[places]
    return p


def _scored(answers: pa.Table, depth: int, bits: int, totals: tuple[int, int, int]) -> pa.Table:
    """A block's documents."""
    path = answers.column("path")[0].as_py()
    counts = Counts.known(path, depth, bits, depth + 1)
    block, (n, v, _) = counts.block, totals
    each = np.log10(probabilities(counts, totals, path, _blobs(answers)))
    base = np.log10(counts.count[1] + 1.0) - np.log10(float(n + v + 1))
    begin = np.cumsum(block.sizes) - block.sizes
    known = np.add.reduceat((counts.count[1] > 0).astype(np.int64), begin)
    out = pa.table({"doc_id": block.doc_id, "held_out": pa.array(block.held), "n_tokens": pa.array(block.sizes.astype(np.int64)), "n_known": pa.array(known), "train_tokens": pa.array(np.full(len(begin), n)), "base_score": pa.array(np.add.reduceat(base, begin)), "score": pa.array(np.add.reduceat(each, begin))})
    release()
    return out


def lm_score(docs: DataFrame, folds: int = 7, held: int = 2, depth: int = DEPTH) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every document row."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = narrow(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), held_out(docs["doc_id"], folds, lambda r: r == held).alias("held_out"), "text")
    folder = f"{shared_folder(spark)}/lm-{uuid.uuid4().hex}"
    blocks = stored(docs.mapInArrow(lambda b: _dealt(b, folder), "path string"), "lm-blocks")
    size = docs.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    bits = min(64, SPARE_BITS + int(size).bit_length())
    buckets, n_blocks = max(1, -(-size // TASK_BYTES)), max(1, 2 * blocks.count())  # partitions for blocks: most have one
    first = blocks.select("path", F.lit(0).alias("bucket"), F.lit(None).cast("binary").alias("blob"), *[F.lit(0).cast("long").alias(c) for c in ("n", "v", "once")])

    def by_block(rows: DataFrame, function, schema: str) -> DataFrame:
        return rows.repartition(n_blocks, "path").groupBy("path").applyInArrow(function, schema)

    def answers(send, add) -> DataFrame:
        """What ranges answer to all that blocks send, and an empty row a block, as some have nothing to send."""
        sent = by_block(first.select("path"), lambda t: send(t.column("path")[0].as_py()), SENT)
        return sent.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(add, ANSWERED).unionByName(first)

    def counted(k: int) -> tuple[int, int, int]:
        kept = by_block(answers(lambda p: _sent_counts(p, k, depth, bits, buckets), _added), lambda t: _kept_counts(t, k, depth, bits), KEPT)
        return tuple(int(x) for x in kept.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n", "v", "once")]).head())

    def judged(d: int, part: int) -> None:
        by_block(answers(lambda p: _evidence(p, d, part, depth, bits, buckets, totals), _judged), lambda t: _kept_contexts(t, d, part, depth, bits), KEPT).agg(F.sum("n")).head()

    with shuffles_dropped(spark):
        totals, *_ = [counted(k) for k in range(1, depth + 2)]
        for d in range(depth, 1, -1):
            for part in range(1 << PART_BITS):
                judged(d, part)
        scores = stored(by_block(answers(lambda p: _evidence(p, 1, None, depth, bits, buckets, totals), _judged), lambda t: _scored(t, depth, bits, totals), RESULT), "lm-scores")
    fs, at = files(folder)
    if fs.get_file_info(at).type == pafs.FileType.Directory:
        fs.delete_dir(at)
    return scores
