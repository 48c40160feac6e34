"""Embedding whitening by MLlib's singular value decomposition of the centred rows.

A vector that is null or empty, or holds a null or a non-finite entry, is dropped. Each remaining entry c becomes the
integer x = floor(64 * c) + 1000000. With n vectors and their sums S, a row's deviations n * x - S are exact integers;
divided by n they are its centred row. RowMatrix.computeSVD of the centred rows gives the components and singular values
s, and e = s * s / n are the eigenvalues of the covariance with divisor n. The total variance is not taken from them but
from the exact deviations, whose squares sum up to n**3 times the covariance's trace. A row is whitened by its centred
row's projections on the components, over sqrt(e). The whitened rows' own covariance, centred before multiplying, is
compared with the identity.

Sums and matrix products are made by task, so what comes together is one row of d or k * k numbers a task; the
decomposition gathers a matrix of d * d on the driver, d being the length of a vector, which is refused above MOST_SIZE.
All d values are asked for, so that MLlib decomposes that matrix directly, to double precision.

Cases: vectors of another length than the most frequent one (of equally frequent ones the longest) are dropped; rows that
repeat a vec_id, and null ones, are vectors like others; directions whose singular value is under SMALLEST of the largest
have no component, so one vector alone, or equal ones, give no rows, as does an empty table; of equal eigenvalues any
basis may come; a deviation beyond 64 bits is exact in whiten() and null in digest(); columns other than those named are
ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirelight.llm.common import narrow, small_batches, stored

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
SMALLEST = 1e-5
MOST_SIZE = 8192


def integers(embeddings: DataFrame) -> DataFrame:
    """vec_id, x of the vectors that are whole and of the most frequent length."""
    number = lambda c: c.cast("double")
    whole = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(number(c)) & (F.abs(number(c)) < F.lit(float("inf"))))
    rows = narrow(embeddings, "vec_id", "embedding").where((F.size("embedding") > 0) & whole)
    length = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    rows = rows.where(F.size("embedding") == (length.d if length else 0))
    return rows.select("vec_id", F.transform("embedding", lambda c: F.floor(number(c) * SCALE) + SHIFT).alias("x"))


def matrix(column: pa.Array) -> np.ndarray:
    """A list column without nulls, all lists of one length, as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def summed(rows: DataFrame, column: str, of: Callable[[np.ndarray], np.ndarray], kind: str) -> list:
    """The sum over tasks of what `of` makes of a task's rows, batch by batch; one row a task is exchanged."""

    def part(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                own = of(matrix(batch.column(0))).ravel()
                total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.int64() if kind == "long" else pa.float64()))], names=["part"])

    found = rows.select(column).mapInArrow(part, f"part array<{kind}>").select(F.posexplode("part").alias("at", "v"))
    return [r.v for r in found.groupBy("at").agg(F.sum("v").alias("v")).orderBy("at").collect()]


def exact_squares(deviations: np.ndarray) -> list[int]:
    """The sum of squares of each row of integers, in Python's integers where 64 bits might not hold it."""
    largest = int(np.abs(deviations).max(initial=0))
    if largest * largest * deviations.shape[1] < 2**63:
        return (deviations * deviations).sum(axis=1).tolist()
    return [sum(v * v for v in row) for row in deviations.tolist()]


def centred(rows: DataFrame, n: int, sums: list[int]) -> DataFrame:
    """vec_id, deviation (sum of the squares of n * x - S, exact), centred (x - S / n)."""
    kind = rows.schema["vec_id"].dataType.simpleString()
    sent = rows.sparkSession.sparkContext.broadcast(np.array(sums, np.int64))  # MOST_SIZE numbers at most

    def part(batches):
        for batch in batches:
            if batch.num_rows:
                away = n * matrix(batch.column("x")) - sent.value
                values = pa.ListArray.from_arrays(pa.array(np.arange(0, away.size + 1, away.shape[1], dtype=np.int32)), pa.array((away / n).ravel()))
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(exact_squares(away), pa.decimal128(38, 0)), values], names=["vec_id", "deviation", "centred"])

    return rows.mapInArrow(part, f"vec_id {kind}, deviation decimal(38,0), centred array<double>")


def components(rows: DataFrame, n: int, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (divisor n, falling) and unit eigenvectors (as columns) of the covariance of centred rows."""
    vectors = MLUtils.convertVectorColumnsFromML(rows.select(array_to_vector("centred").alias("v")), "v")
    found = RowMatrix(vectors, n, d).computeSVD(d, computeU=False, rCond=SMALLEST)
    return found.s.toArray() ** 2 / n, found.V.toArray()


def whiten(embeddings: DataFrame, k: int = COMPONENTS) -> DataFrame:
    """vec_id, n, deviation (decimal), whitened and explained (arrays by component), identity_error."""
    spark = embeddings.sparkSession
    small_batches(spark)
    rows = integers(embeddings)
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, n long, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"
    counted = summed(rows, "x", lambda x: np.append(x.sum(axis=0), len(x)), "long")
    if not counted:
        return spark.createDataFrame([], schema)
    *sums, n = counted
    if len(sums) > MOST_SIZE:
        raise ValueError(f"vectors of {len(sums)} entries; at most {MOST_SIZE} are decomposed")
    rows = stored(centred(rows, n, sums), "centred-rows")
    total = int(rows.agg(F.sum("deviation")).first()[0])
    if total == 0:
        return spark.createDataFrame([], schema)
    values, vectors = components(rows, n, len(sums))
    values, vectors = values[:k], vectors[:, :k]
    sent = spark.sparkContext.broadcast(vectors / np.sqrt(values))  # MOST_SIZE * k numbers at most

    def projected(batches):
        for batch in batches:
            if batch.num_rows:
                out = matrix(batch.column("centred")) @ sent.value
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, out.size + 1, out.shape[1], dtype=np.int32)), pa.array(out.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("deviation"), lists], names=["vec_id", "deviation", "whitened"])

    rows = stored(rows.mapInArrow(projected, f"vec_id {kind}, deviation decimal(38,0), whitened array<double>"), "whitened-rows")
    mean = np.array(summed(rows, "whitened", lambda y: y.sum(axis=0), "double")) / n
    product = np.array(summed(rows, "whitened", lambda y: (y - mean).T @ (y - mean), "double")).reshape(len(values), -1) / n
    error = float(np.abs(product - np.eye(len(values))).max())
    explained = [v / float(Fraction(total, n**3)) for v in values.tolist()]
    return rows.select("vec_id", F.lit(n).cast("long").alias("n"), "deviation", "whitened", F.lit(explained).alias("explained"), F.lit(error).alias("identity_error"))


def digest(whitened: DataFrame) -> DataFrame:
    """A row for each vector and component."""
    out = whitened.select("vec_id", "n", F.expr("try_cast(deviation as bigint)").alias("deviation"), "explained", "identity_error", F.posexplode("whitened").alias("at", "value"))
    return out.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", F.col("value").alias("whitened"), F.get("explained", F.col("at")).alias("explained"), "identity_error")
