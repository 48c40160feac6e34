"""Token ids in Arrow files of fixed-size-list batches.

Documents are dealt to shards of about SHARD_BYTES of text by ranges of (doc_id, text hash), so that the shards in order
hold ascending doc_id; or, where the order of the input's rows is to be kept, each partition of it is a shard. A
shard is an Arrow IPC file whose batches have SEQUENCES rows of two columns: `tokens`, a fixed-size list of
SEQUENCE_LENGTH ids, and `mask`, as many booleans, false only in the padding after the shard's last id. Every row has
the same width, so sequence i is row i % SEQUENCES of batch i // SEQUENCES: with a memory map, a view and no copy. An
index file beside it has a row per document: doc_id, its first id's place in the shard, and its number of ids. Ids are
16 bits wide where the vocabulary allows, else 32.

The tokenizer is byte-level BPE whose pre-tokenizer cuts the text into pieces that are encoded independently. So the
library encodes a piece when it is first met, and a document's ids are its pieces' ids, found by a 64-bit hash and the
length (for a wrong match two different pieces among the KNOWN_PIECES must share both). Texts that aren't plain (see
ODD), texts with the first sign of an added token, and tokenizers of another make go to the library whole.

Each task writes under a name of its own and the driver takes the names of the attempts that succeeded, so a task that
is run again does no harm.

Cases: a null or empty text has the end id alone; rows that repeat a doc_id follow each other; a null doc_id comes
first; an empty table gives no shards and no rows; columns other than those named are ignored.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirelight.llm.common import bounded, files, narrow, shared_folder, small_batches, utf8
from quirelight.llm.text_hash import Ranges

SEQUENCE_LENGTH = 2048
SEQUENCES = 64
SHARD_BYTES = 32 << 20
END_ID = 2
KNOWN_PIECES = 1_500_000
SLOT_BITS = 22
#: Plain rows have tab, line feed, carriage return, ASCII less the apostrophe, and the letters U+00C0 to U+017F.
ODD = np.ones(256, bool)
ODD[[0x09, 0x0A, 0x0D, *range(0x20, 0x7F), *range(0x80, 0xC0), 0xC3, 0xC4, 0xC5]] = False
ODD[0x27] = True
KIND = np.full(256, 3, np.uint8)  # white space 0, letters 1, digits 2, other signs 3
KIND[[0x09, 0x0A, 0x0D, 0x20]] = 0
KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
KIND[0x30:0x3A] = 2
_LOADED: dict[str, Encoder] = {}


class Encoder:
    """Texts to ids."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        made = json.loads(self.library.to_str())
        before = made.get("pre_tokenizer") or {}
        self.by_piece = made["model"]["type"] == "BPE" and not made.get("normalizer") and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        self.kind = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        self.odd = ODD.copy()
        for token in made.get("added_tokens", []):
            self.odd[token["content"].encode()[0]] = True
        self.token_bytes = np.zeros(self.library.get_vocab_size(), np.int64)
        for token, i in self.library.get_vocab().items():
            self.token_bytes[i] = len(token)  # the vocabulary spells each byte as one sign
        self.forget()

    def forget(self) -> None:
        """Known pieces: a hash table of open slots, and of each piece its bytes' and ids' numbers and its ids' place."""
        self.slots, self.entry = np.zeros(1 << SLOT_BITS, np.uint64), np.zeros(1 << SLOT_BITS, np.int32)
        self.n = self.used = 0
        self.sizes, self.counts, self.places = (np.zeros(KNOWN_PIECES, np.int32) for _ in range(3))
        self.pool = np.zeros(KNOWN_PIECES * 2, self.kind)

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, self.kind) for x in self.library.encode_batch(texts, add_special_tokens=False)]

    def _many(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces that aren't white space, and how many each has. They are encoded as few texts: each piece
        begins with a space or is put on a line of its own, so that it stays a piece."""
        parts = [x if x[0] == 0x20 else b"\n" + x for x in pieces]
        sizes = np.array([len(x) for x in parts], np.int64)
        extra = np.array([x[0] != 0x20 for x in pieces], np.int64)  # the line feed's id
        texts = [b"".join(parts[i : i + 256]).decode() for i in range(0, len(parts), 256)]
        ids = np.concatenate([np.array(x.ids, np.int64) for x in self.library.encode_batch_fast(texts, add_special_tokens=False)])
        at = np.searchsorted(np.cumsum(self.token_bytes[ids]), np.cumsum(sizes)) + 1  # ids up to each part's end
        before = np.concatenate(([0], at[:-1]))
        keep = np.ones(len(ids), bool)
        keep[before[extra > 0]] = False
        return ids[keep].astype(self.kind), at - before - extra

    def _learn(self, hashes: np.ndarray, pieces: list[bytes]) -> None:
        if len(hashes) > KNOWN_PIECES:  # after forget(); the next batch that doesn't fit forgets again
            bits = len(hashes).bit_length() + 1
            self.slots, self.entry = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int32)
            self.sizes, self.counts, self.places = (np.zeros(len(hashes), np.int32) for _ in range(3))
        blank = np.array([x[-1] in b" \t\n\r" for x in pieces])
        order = np.concatenate([np.flatnonzero(~blank), np.flatnonzero(blank)])
        hashes, pieces = hashes[order], [pieces[i] for i in order]
        words = len(order) - int(blank.sum())
        ids, counts = self._many(pieces[:words]) if words else (np.zeros(0, self.kind), np.zeros(0, np.int64))
        rest = self.whole([x.decode() for x in pieces[words:]])
        ids, counts = np.concatenate([ids, *rest]), np.concatenate([counts, np.array([len(x) for x in rest], np.int64)])
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used : self.used + len(ids)] = ids
        new = slice(self.n, self.n + len(hashes))
        self.sizes[new], self.counts[new], self.places[new] = [len(x) for x in pieces], counts, self.used + np.cumsum(counts) - counts
        todo, number, step = hashes, np.arange(self.n, self.n + len(hashes), dtype=np.int32), 0
        while len(todo):
            at = (todo + np.uint64(step)) & np.uint64(len(self.slots) - 1)
            free = self.slots[at] == 0
            self.slots[at[free]] = todo[free]
            placed = free & (self.slots[at] == todo)
            self.entry[at[placed]] = number[placed]
            todo, number, step = todo[~placed], number[~placed], step + 1
        self.n, self.used = new.stop, self.used + len(ids)

    def _find(self, hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        out, known = np.zeros(len(hashes), np.int32), np.zeros(len(hashes), bool)
        todo, step = np.arange(len(hashes)), 0
        while len(todo):
            at = (hashes[todo] + np.uint64(step)) & np.uint64(len(self.slots) - 1)
            there = self.slots[at]
            same = there == hashes[todo]
            out[todo[same]] = self.entry[at[same]]
            known[todo[same]] = True
            todo, step = todo[~same & (there != 0)], step + 1
        return out, known & (self.sizes[out] == sizes)

    def _plain(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of plain rows one after another, and each row's number of ids."""
        starts, ends, row = pieces(data, offsets)
        hashes, sizes = Ranges(data).of(starts, ends), ends - starts
        at, known = self._find(hashes, sizes)
        if not known.all():
            new, first = np.unique(hashes[~known], return_index=True)
            first = np.flatnonzero(~known)[first]
            if self.n + len(new) > KNOWN_PIECES:  # all that this batch needs is learned anew, however much it is
                self.forget()
                new, first = np.unique(hashes, return_index=True)
            self._learn(new, [data[starts[i] : ends[i]].tobytes() for i in first])
            at, known = self._find(hashes, sizes)
            if not known.all():  # two pieces of one hash
                ids = self.whole([data[a:b].tobytes().decode() for a, b in zip(offsets[:-1], offsets[1:], strict=True)])
                return np.concatenate(ids), np.array([len(x) for x in ids], np.int64)
        counts = self.counts[at].astype(np.int64)
        upto = np.cumsum(counts)
        ids = self.pool[np.repeat(self.places[at] - upto + counts, counts) + np.arange(upto[-1] if len(upto) else 0)]
        return ids, np.bincount(row, counts, len(offsets) - 1).astype(np.int64)

    def __call__(self, column) -> list[np.ndarray]:
        data, offsets = utf8(column)
        n = len(offsets) - 1
        if not self.by_piece or not len(data):
            return self.whole([x or "" for x in column.to_pylist()])
        odd = self.odd[data]
        odd[1:] |= (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7))
        upto = np.concatenate(([0], np.cumsum(odd)))
        rest = np.flatnonzero(upto[offsets[1:]] > upto[offsets[:-1]])
        sizes = np.diff(offsets)
        if len(rest):
            keep = np.ones(n, bool)
            keep[rest] = False
            data = data[np.repeat(keep, sizes)]
            sizes = np.where(keep, sizes, 0)
            offsets = np.concatenate(([0], np.cumsum(sizes)))
        ids, counts = self._plain(data, offsets) if len(data) else (np.zeros(0, self.kind), np.zeros(n, np.int64))
        out = np.split(ids, np.cumsum(counts)[:-1])
        for i, x in zip(rest, self.whole([column[int(i)].as_py() for i in rest]), strict=True):
            out[i] = x
        return out


def pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the pre-tokenizer's pieces of plain rows: runs of letters, digits or other signs, each
    with the space before it; of a run of white space all but its last sign, or all at the row's end."""
    kind = KIND[data]
    border = np.zeros(len(data) + 1, bool)
    border[offsets] = True
    first = border[:-1].copy()
    first[1:] |= kind[1:] != kind[:-1]
    begin = np.flatnonzero(first)
    stop = np.append(begin[1:], len(data))
    blank = kind[begin] == 0
    at_end = border[stop]
    spaced = np.zeros(len(begin), bool)  # the run before gives it a space
    spaced[1:] = ~blank[1:] & blank[:-1] & ~at_end[:-1] & (data[stop[:-1] - 1] == 0x20)
    gives = np.zeros(len(begin), bool)
    gives[:-1] = spaced[1:]
    mark = np.zeros(len(data), bool)
    mark[begin[~blank] - spaced[~blank]] = True
    long = stop - begin > 1
    mark[begin[blank & (at_end | long | ~gives)]] = True
    mark[stop[blank & ~at_end & long & ~gives] - 1] = True
    starts = np.flatnonzero(mark)
    ends = np.append(starts[1:], len(data))
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def encoder(path: str) -> Encoder:
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


def _schema(kind: np.dtype, length: int) -> pa.Schema:
    return pa.schema([("tokens", pa.list_(pa.field("item", pa.from_numpy_dtype(kind), False), length)), ("mask", pa.list_(pa.field("item", pa.bool_(), False), length))])


class Writer:
    """Collects ids and writes whole batches."""

    def __init__(self, sink, kind: np.dtype, length: int, sequences: int):
        self.kind, self.length, self.step = kind, length, length * sequences
        self.out = pa.ipc.new_file(sink, _schema(kind, length))
        self.held = bytearray()
        self.total = 0

    def add(self, ids: bytes) -> None:
        self.held += ids
        self.total += len(ids) // self.kind.itemsize
        full = self.step * self.kind.itemsize
        if len(self.held) >= full:
            for at in range(0, len(self.held) - full + 1, full):
                self._batch(np.frombuffer(bytes(self.held[at : at + full]), self.kind), self.step)
            del self.held[: len(self.held) // full * full]

    def _batch(self, ids: np.ndarray, n: int) -> None:
        schema = _schema(self.kind, self.length)
        arrays = [pa.FixedSizeListArray.from_arrays(pa.array(v), type=schema.field(k).type) for k, v in (("tokens", ids), ("mask", np.arange(len(ids)) < n))]
        self.out.write_batch(pa.RecordBatch.from_arrays(arrays, schema=schema))

    def close(self) -> None:
        if n := len(self.held) // self.kind.itemsize:
            ids = np.zeros(-(-n // self.length) * self.length, self.kind)
            ids[:n] = np.frombuffer(bytes(self.held), self.kind)
            self._batch(ids, n)
        self.out.close()


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, length: int = SEQUENCE_LENGTH, sequences: int = SEQUENCES, by_id: bool = True) -> list[tuple[str, str, int, int]]:
    """Write all documents, by doc_id or in the order of their rows; returns (token file, index file, documents, ids) of
    each shard in order: a row a shard."""
    small_batches(docs.sparkSession)
    docs = narrow(docs, "doc_id", "text")
    if by_id:
        size = docs.agg(F.sum(F.octet_length("text"))).head()[0] or 0
        docs = docs.withColumn("text_key", F.xxhash64(F.coalesce("text", F.lit(""))))
        docs = docs.repartitionByRange(max(1, -(-size // SHARD_BYTES)), "doc_id", "text_key").sortWithinPartitions("doc_id", "text_key").select("doc_id", "text")

    def shard(batches):
        fs, root = files(folder)
        encode = encoder(tokenizer)
        name = f"{root}/shard-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        end = np.array([end_id], encode.kind).tobytes()
        docs = ids = 0
        sink = index_sink = None
        for batch in bounded(batches):
            if not batch.num_rows:
                continue
            if sink is None:
                fs.create_dir(root, recursive=True)
                sink, index_sink = fs.open_output_stream(f"{name}.arrow"), fs.open_output_stream(f"{name}.index.arrow")
                out = Writer(sink, encode.kind, length, sequences)
                columns = pa.schema([("doc_id", batch.schema.field("doc_id").type), ("start", pa.int64()), ("n_tokens", pa.int64())])
                index = pa.ipc.new_file(index_sink, columns)
            encoded = encode(batch.column("text"))
            for x in encoded:
                out.add(x.tobytes() + end)
            lengths = [len(x) + 1 for x in encoded]
            starts = ids + np.concatenate(([0], np.cumsum(lengths)[:-1])).astype(np.int64)
            index.write_batch(pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(starts), pa.array(lengths, pa.int64())], schema=columns))
            docs, ids = docs + len(lengths), ids + sum(lengths)
        if sink is not None:
            out.close()
            index.close()
            sink.close()
            index_sink.close()
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (TaskContext.get().partitionId(), f"{folder}/{name.rpartition('/')[2]}.arrow", f"{folder}/{name.rpartition('/')[2]}.index.arrow", docs, ids)], ["shard", "path", "index", "docs", "ids"])

    found = docs.mapInArrow(shard, "shard long, path string, index string, docs long, ids long").collect()  # a row for each shard
    return [(r["path"], r["index"], r["docs"], r["ids"]) for r in sorted(found, key=lambda r: r["shard"])]


class Shard:
    """Random access to a shard: sequence(i) and mask(i) are views of the file where it can be mapped."""

    def __init__(self, path: str):
        fs, at = files(path)
        self.source = pa.memory_map(at) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(at)
        self.file = pa.ipc.open_file(self.source)
        self.length = self.file.schema.field("tokens").type.list_size
        self.per_batch = self.file.get_batch(0).num_rows if self.file.num_record_batches else 1

    def batch_ids(self, k: int) -> np.ndarray:
        """The ids of batch k without padding, which only the last has."""
        batch = self.file.get_batch(k)
        ids = batch.column("tokens").flatten().to_numpy(zero_copy_only=True)
        return ids[: batch.column("mask").flatten().true_count] if k == self.file.num_record_batches - 1 else ids

    def sequence(self, i: int) -> np.ndarray:
        return self.file.get_batch(i // self.per_batch).column("tokens")[i % self.per_batch].values.to_numpy(zero_copy_only=True)

    def mask(self, i: int) -> pa.BooleanArray:
        return self.file.get_batch(i // self.per_batch).column("mask")[i % self.per_batch].values


def read_back(spark, shards: list[tuple[str, str, int, int]]) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    before = np.concatenate(([0], np.cumsum([s[3] for s in shards])))[:-1] if shards else []
    rows = [(p, i, int(b)) for (p, i, _, _), b in zip(shards, before, strict=True)]
    todo = spark.createDataFrame(rows, "path string, index string, base long").repartition(max(1, len(rows)), "path")

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row["path"])
                fs, at = files(row["index"])
                index = pa.ipc.open_file(fs.open_input_file(at))
                k, held = 0, np.zeros(0, np.uint32)
                for j in range(index.num_record_batches):
                    docs = index.get_batch(j)
                    sums = []
                    for n in docs.column("n_tokens").to_pylist():
                        parts, have = [held], len(held)
                        while have < n:
                            parts.append(shard.batch_ids(k))
                            have += len(parts[-1])
                            k += 1
                        ids = np.concatenate(parts) if len(parts) > 1 else held
                        sums.append(zlib.crc32(ids[:n].astype("<u4").tobytes()))
                        held = ids[n:]
                    starts = docs.column("start").to_numpy() + row["base"]
                    yield pa.RecordBatch.from_arrays([docs.column("doc_id").cast(pa.int64()), pa.array(starts), docs.column("n_tokens"), pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return todo.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = END_ID, by_id: bool = True) -> DataFrame:
    """Write docs as token files in the shared folder and read them back."""
    spark = docs.sparkSession
    return read_back(spark, write(docs, f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}", tokenizer, end_id, by_id=by_id))
