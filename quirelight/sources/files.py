"""Files in and out: PDF folders, JSON records and label tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LABELS = "document_id string, filename string, title string, source string, confidence string, needs_review string"


def pdf_files(spark: SparkSession, folder: str) -> DataFrame:
    """document_id (16 hex digits of the content's SHA-256), path, modified, content of each *.pdf of a folder."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(folder)
    return found.select(F.substring(F.sha2("content", 256), 1, 16).alias("document_id"), "path", F.col("modificationTime").alias("modified"), "content")


def expired(files: DataFrame, seconds: int) -> DataFrame:
    """Files that were last written more than so many seconds ago."""
    return files.where(F.unix_timestamp("modified") < F.unix_timestamp() - seconds)


def first_pages(pages: DataFrame) -> DataFrame:
    """Pages 1 and 2 of each document."""
    return pages.where("page <= 2")


def write_records(df: DataFrame, folder: str) -> None:
    """One JSON record a row; Unicode as it is."""
    df.write.mode("overwrite").json(folder)


def read_records(spark: SparkSession, folder: str, schema: str | T.StructType) -> DataFrame:
    """JSON records of a known schema; what doesn't parse has nulls and its text in _corrupt_record."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    whole = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    return spark.read.schema(whole).option("mode", "PERMISSIVE").json(folder)


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=LABELS, quote='"', escape='"')


def write_labels(df: DataFrame, path: str) -> None:
    df.select(*[x.split()[0] for x in LABELS.split(", ")]).coalesce(1).write.mode("overwrite").csv(path, header=True, quote='"', escape='"')  # ground truth is written by hand and small
