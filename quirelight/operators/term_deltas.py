"""A frozen term table that grows by batches. Each batch of documents leaves a delta: the document frequencies of its terms
and the lengths of its documents. Deltas add up in any order, and a delta's name is made of its batch's content, so that one
that is sent again replaces itself. A version is built from deltas and frozen under a name; labels that read it don't change
as more deltas come."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelight.functions import text as T
from quirelight.operators.identity import content_terms


def delta_name(corpus: DataFrame) -> str:
    """Of a batch's documents and texts, whatever their order."""
    whole = F.sum(F.xxhash64("document_id", "text").cast("decimal(38,0)")).cast("string")
    found = corpus.agg(F.sha2(F.concat_ws("-", F.count("*").cast("string"), F.coalesce(whole, F.lit(""))), 256).alias("h")).first()
    return found.h[:16]


def counted(corpus: DataFrame) -> DataFrame:
    """Of a batch in one pass: term and rows (how many rows of a document have it), or document_id and length. Each task adds
    up its own terms, so that no pair of a term and a document is shuffled."""
    kind = corpus.schema["document_id"].dataType
    terms = corpus.select("document_id", F.coalesce(content_terms(F.col("text")), F.array().cast("array<string>")).alias("terms"))
    own = F.struct(F.lit(None).cast("string").alias("term"), F.col("document_id"), F.lit(0).alias("rows"), F.size("terms").alias("length"))
    seen = F.col("document_id").isNotNull().cast("int")
    each = F.transform(F.array_distinct("terms"), lambda t: F.struct(t.alias("term"), F.lit(None).cast(kind).alias("document_id"), seen.alias("rows"), F.lit(0).alias("length")))
    rows = terms.select(F.inline(F.concat(each, F.array(own))))
    return rows.groupBy("term", "document_id").agg(F.sum("rows").alias("rows"), F.sum("length").alias("length"))


def repeated(corpus: DataFrame) -> DataFrame:
    """document_id of documents that have several rows."""
    return corpus.where("document_id is not null").groupBy("document_id").count().where("count > 1").select("document_id")


def add_delta(corpus: DataFrame, folder: str) -> str:
    """Write the delta of a batch (document_id, text; of a document's rows all count) and return its name. The documents
    come last and name the delta as whole: one that was cut short isn't read, and written again when its batch is. Rows
    are counted, and a term that several rows of one document have is then taken off again, from those documents alone."""
    name, spark = delta_name(corpus), corpus.sparkSession

    def kept(df: DataFrame, kind: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{folder}/{kind}/delta={name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{kind}/delta={name}")

    counts, again = kept(counted(corpus), "counted"), kept(repeated(corpus), "repeated")  # written, so a small one is sent
    df = counts.where("term is not null").select("term", F.col("rows").alias("df"))
    if not again.isEmpty():
        terms = corpus.join(again, "document_id", "left_semi").select("document_id", F.explode(F.array_distinct(content_terms(F.col("text")))).alias("term"))
        more = terms.groupBy("document_id", "term").agg((1 - F.count("*")).alias("df")).select("term", "df")
        df = df.unionByName(more).groupBy("term").agg(F.sum("df").alias("df"))
    kept(df, "terms")
    kept(counts.where("term is null").select("document_id", "length"), "documents")
    return name


def _deltas(spark: SparkSession, folder: str, kind: str, schema: str, names: list[str] | None) -> DataFrame:
    rows = spark.read.schema(f"{schema}, delta string").option("basePath", f"{folder}/{kind}").parquet(f"{folder}/{kind}/delta=*")
    return rows if names is None else rows.where(F.col("delta").isin(names))


def build_version(spark: SparkSession, folder: str, version: str, names: list[str] | None = None, kind: str = "string") -> str:
    """Freeze the sum of deltas (all, or those named) as a version; returns its folder, which identity.thaw() reads. A
    document that is in two deltas would count twice, so it is refused. kind: the type of document_id."""
    lengths = _deltas(spark, folder, "documents", f"document_id {kind}, length long", names)
    twice = lengths.groupBy("document_id").agg(F.min("delta").alias("a"), F.max("delta").alias("b")).where("a <> b").limit(1).collect()
    if twice:
        raise ValueError(f"document {twice[0].document_id} is in several deltas")
    whole = lengths.select("delta").distinct()
    sizes = lengths.agg(F.count("*").alias("documents"), T.rounded(F.avg(F.greatest("length", F.lit(1))), 2).alias("avgdl"))
    df = _deltas(spark, folder, "terms", "term string, df long", names).join(whole, "delta", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    n = F.col("documents")
    table = df.crossJoin(F.broadcast(sizes)).select("term", "df", T.rounded(F.log((n - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1), 6).alias("idf"))  # one row
    to = f"{folder}/versions/{version}"
    table.write.mode("overwrite").parquet(f"{to}/terms")
    content = spark.read.parquet(f"{to}/terms").agg(F.max("idf").alias("most"), F.sum(F.xxhash64("term", "idf").cast("decimal(38,0)")).alias("sum"))
    default = T.rounded(F.log((n + 0.5) / 0.5 + 1), 6)
    name = F.concat(F.lit("IDF-"), n.cast("string"), F.lit("docs-"), F.substring(F.sha2(F.col("sum").cast("string"), 256), 1, 16))
    sizes.crossJoin(content).select("documents", "avgdl", default.alias("default_idf"), "most", name.alias("version")).coalesce(1).write.mode("overwrite").json(f"{to}/summary")  # one row each
    return to
