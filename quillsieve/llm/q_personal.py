"""Queries of the search for personal information."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsieve.llm.personal import find_mentions, fit_tagger, redact
from quillsieve.session import table


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every mention of personal information in the documents."""
    docs = table(spark, folder, "documents")
    return find_mentions(docs, "doc_id", "text", fit_tagger(docs, "text")).select("doc_id", "kind", "start_pos")


def p9_redacted(spark: SparkSession, folder: str) -> DataFrame:
    """The documents with typed placeholders."""
    docs = table(spark, folder, "documents")
    return redact(docs, "doc_id", "text", fit_tagger(docs, "text"))


def p9_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Mentions of each kind."""
    return p9_found(spark, folder).groupBy("kind").agg(F.count("*").alias("mentions"))


QUERIES = {"p9_found": (p9_found, None), "p9_redacted": (p9_redacted, None), "p9_counts": (p9_counts, None)}
