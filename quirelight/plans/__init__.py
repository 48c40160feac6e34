"""Registered queries and their SQL."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quirelight.plans import documents, labels, papers, scenarios

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {**documents.QUERIES, **labels.QUERIES, **papers.QUERIES, **scenarios.QUERIES}
ORACLES: dict[str, str] = {**documents.ORACLES, **labels.ORACLES, **papers.ORACLES, **scenarios.ORACLES}
