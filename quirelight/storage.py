"""Tables that a query writes and reads again: they cut lineage, are computed once and survive lost executors."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which all executors share. Where it is unset, a session whose tasks all run in
    the driver's process (as in tests) gets one of its own; a cluster is refused, as its machines share no folder."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found is None:
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
        if known.isDefined():
            found = known.get()
        elif re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            found = tempfile.mkdtemp(prefix="quirelight-")
            spark.sparkContext.setCheckpointDir(found)
        else:
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return found.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it again."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
