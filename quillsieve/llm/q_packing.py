"""Queries of the packing operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsieve.llm.packing import fill_report, oversized, pack
from quillsieve.session import table


def _packed(spark: SparkSession, folder: str) -> tuple[DataFrame, int]:
    capacity = int(table(spark, folder, "pack_bins").first()["capacity_tokens"])  # a table of one row
    # the public byte-level tokenizers: a token for each UTF-8 byte and one that closes the text
    return pack(table(spark, folder, "documents"), "doc_id", F.octet_length("text") + 1, capacity), capacity


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents larger than a bin: those the operator had to cut."""
    return oversized(_packed(spark, folder)[0], "doc_id")


def p7_bins(spark: SparkSession, folder: str) -> DataFrame:
    """The bin and place of every document or piece."""
    return _packed(spark, folder)[0]


def p7_fill(spark: SparkSession, folder: str) -> DataFrame:
    """Bins used, the fewest possible and the share of room left unused."""
    packed, capacity = _packed(spark, folder)
    return fill_report(packed, capacity)


QUERIES = {
    "p7_found": (p7_found, "SELECT doc_id FROM documents WHERE strlen(text) + 1 > (SELECT capacity_tokens FROM pack_bins)"),
    "p7_bins": (p7_bins, None),
    "p7_fill": (p7_fill, None),
}
