"""Helpers shared by the training-data operators: narrow inputs, shared-folder tables, Arrow text access."""

from __future__ import annotations

import contextlib
import ctypes
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelight.storage import shared_folder, stored  # noqa: F401

#: Rows in one Arrow batch handed to Python; texts are long, so Spark's default of 10,000 is too many.
BATCH_ROWS = 512
BATCH_BYTES = 1 << 20
FILTER_BITS = 1 << 22
#: A group of more than HOT_ROWS rows is dealt over SALTS tasks where it is joined.
HOT_ROWS, SALTS = 512, 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named Parquet table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def narrow(docs: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that other columns of any name cannot clash with what an operator adds."""
    return docs.select(*[docs[n] for n in names])


def small_batches(spark: SparkSession) -> None:
    """Bound the rows of an Arrow batch (a session setting; left alone when it is already smaller)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession):
    """Within it, a job's shuffle files go when it ends, not when the driver comes to collect its garbage: for jobs that
    are run once."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def files(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder that executors share, and the path in it."""
    uri = re.sub(r"^file:/(?!/)", "file:///", uri)
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)


def held_out(doc_id, modulus: int, remainder_is) -> F.Column:
    """crc32(doc_id as text) mod modulus, tested; a null doc_id counts as the empty string."""
    return remainder_is(F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(modulus)))


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column (nulls as empty) and the offsets of its n + 1 row borders, from 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, at - at[0]


def bounded(batches, column: str = "text", most: int = BATCH_BYTES):
    """The same rows in batches of at most `most` bytes of text (a longer text alone), and at least one batch."""
    for batch in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)) if batch.num_rows else []
        at = 0
        while True:
            upto = batch.num_rows if not len(sizes) else max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + most, side="right")))
            yield batch.slice(at, upto - at)
            at = upto
            if at >= batch.num_rows:
                break


def bit_filter(keys: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """A filter for keys (one column) with one bit for each of `bits` hash values, so that it is sent whole at any size of
    the input and lets ever more pass as keys grow: it saves work before a join and decides nothing."""
    bit = F.pmod(F.xxhash64(keys.columns[0]), F.lit(bits)).alias("key_bit")
    found = keys.select(bit).groupBy(F.shiftright("key_bit", 6).alias("filter_word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(key_bit & 63 as int))")).alias("filter_bits"))
    return F.broadcast(stored(found, "filter"))  # bits / 64 rows at most


def flagged(df: DataFrame, column: str, keys: DataFrame, name: str = "may_be", bits: int = FILTER_BITS) -> DataFrame:
    """df with whether a row's column may be among the keys of a bit_filter()."""
    tested = df.withColumn("filter_bit", F.pmod(F.xxhash64(column), F.lit(bits))).join(keys, F.shiftright("filter_bit", 6) == F.col("filter_word"), "left")
    may = F.coalesce(F.expr("(shiftrightunsigned(filter_bits, cast(filter_bit & 63 as int)) & 1) = 1"), F.lit(False))
    return tested.select(*[df[c] for c in df.columns], may.alias(name))


def spread_join(rows: DataFrame, key: str, unique: str, groups: DataFrame, group_key: str, hot: DataFrame, how: str = "inner") -> DataFrame:
    """rows joined with groups (one row a group_key, of another name than any column of rows). Rows whose key may be in
    the bit_filter() hot are dealt over SALTS tasks by `unique`, and those groups are sent to each of them."""
    salt = F.when(F.col("may_be"), F.pmod(F.xxhash64(unique), F.lit(SALTS)).cast("int")).otherwise(F.lit(0))
    left = flagged(rows, key, hot).withColumn("salt", salt).drop("may_be")
    right = flagged(groups, group_key, hot).withColumn("g_salt", F.explode(F.when(F.col("may_be"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))).drop("may_be")
    return left.join(right, (F.col(key) == F.col(group_key)) & (F.col("salt") == F.col("g_salt")), how).drop("salt", "g_salt")


def release() -> None:
    """Give freed memory back to the system: workers live long and share an executor's memory with its JVM."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def row_key(doc_id, text) -> list[F.Column]:
    """Names of a row beyond its doc_id: rows that share doc_id and text are one document stored repeatedly."""
    return [doc_id, F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_key")]
