"""Queries of the leakage search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsieve.llm.leakage import find_leaks
from quillsieve.session import table


def _leaks(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "eval_v2").select(
        F.col("id").alias("item_id"), F.explode(F.array("question", "reference_answer")).alias("text")
    )
    return find_leaks(table(spark, folder, "documents"), "doc_id", "text", items)


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that repeat an item's question or reference answer, with the item."""
    return _leaks(spark, folder).select("doc_id", "item_id")


def p8_items(spark: SparkSession, folder: str) -> DataFrame:
    """For each leaked item the number of documents that repeat it."""
    return _leaks(spark, folder).groupBy("item_id").agg(F.count("*").alias("documents"))


QUERIES = {"p8_found": (p8_found, None), "p8_items": (p8_items, None)}
