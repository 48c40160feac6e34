"""Further sources of evidence for labels. A source says how much speaks for a candidate; those that are registered enter
the fusion, its contributions and the ablation beside the seven of the contract."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass
from importlib import import_module

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn, udtf
from pyspark.sql.types import StructType

from quirelight import contracts
from quirelight.functions import text as T
from quirelight.storage import stored


@dataclass(frozen=True)
class Source:
    """raw: units and candidates (document_id, key, text) to document_id, key, raw; a candidate without a row has 0.
    scaled: raw values are brought to 0 to 1 within each document, else they are taken as they are."""

    name: str
    weight: float
    raw: Callable[[DataFrame, DataFrame], DataFrame]
    scaled: bool = True


REGISTERED: dict[str, Source] = {}


def register(source: Source) -> None:
    """Add a source, or replace the registered one of its name; the contract's own keep their names."""
    if not source.name.isidentifier() or source.name in contracts.load("identity")["fusion_weights"]:
        raise ValueError(f"a source's name becomes a column of its own: {source.name!r}")
    REGISTERED[source.name] = source


@contextmanager
def using(*sources: Source):
    """Sources that are registered for a while. Plans made within keep them."""
    before = dict(REGISTERED)
    for s in sources:
        register(s)
    try:
        yield
    finally:
        REGISTERED.clear()
        REGISTERED.update(before)


def weights() -> dict[str, float]:
    return {s.name: s.weight for s in REGISTERED.values()}


def added(rows: DataFrame, units: DataFrame) -> DataFrame:
    """rows (document_id, key, text and others) with a column for each registered source. Candidates are written once, as
    each source reads them."""
    if REGISTERED:
        rows = stored(rows, "evidence-candidates")
    own = Window.partitionBy("document_id")
    for s in REGISTERED.values():
        found = s.raw(units, rows.select("document_id", "key", "text")).groupBy(F.col("document_id").alias("e_document"), F.col("key").alias("e_key")).agg(F.max("raw").cast("double").alias("e_raw"))
        rows = rows.join(found, (F.col("document_id") == F.col("e_document")) & (F.col("key") == F.col("e_key")), "left").drop("e_document", "e_key")
        raw = F.coalesce("e_raw", F.lit(0.0))
        lo, hi = F.min(raw).over(own), F.max(raw).over(own)
        value: Column = F.when(hi - lo < 1e-9, 0.5).otherwise((raw - lo) / (hi - lo)) if s.scaled else raw
        rows = rows.withColumn(s.name, T.rounded(value, 4)).drop("e_raw")
    return rows


@udtf
class ForeignEvidence:
    """A document's units, in order, given to a plain function "module:name" of (ord, text) pairs that gives (text, raw)
    pairs. What it returns beside the texts is told by `wide`: with it the unit's ord, as the third of what the function
    gives."""

    def __init__(self):
        self.rows, self.document, self.function, self.wide = [], None, None, False

    @staticmethod
    def analyze(rows: AnalyzeArgument, function: AnalyzeArgument, wide: AnalyzeArgument) -> AnalyzeResult:
        if not rows.isTable or not function.value or ":" not in function.value:
            raise ValueError('a table of units and a function as "module:name" are needed')
        schema = StructType().add("document_id", "string").add("text", "string").add("raw", "double")
        return AnalyzeResult(schema=schema.add("ord", "integer") if wide.value else schema, partitionBy=[PartitioningColumn("document_id")], orderBy=[OrderingColumn("ord")])

    def eval(self, rows, function: str, wide: bool):
        self.document, self.function, self.wide = rows["document_id"], function, wide
        self.rows.append((rows["ord"], rows["text"]))

    def terminate(self):
        if self.function is not None:
            module, _, name = self.function.partition(":")
            for found in getattr(import_module(module), name)(self.rows):
                yield (self.document, *found) if self.wide else (self.document, found[0], float(found[1]))


def foreign(name: str, weight: float, function: str, scaled: bool = True) -> Source:
    """A source that is a plain function over one document's units; it runs where the units are, a document at a time."""

    def raw(units: DataFrame, candidates: DataFrame) -> DataFrame:
        found = ForeignEvidence(units.select("document_id", "ord", "text").asTable(), F.lit(function), F.lit(False))
        return found.select("document_id", F.array_join(T.lexical_tokens(F.col("text")), " ").alias("key"), "raw")

    return Source(name, weight, raw, scaled)
