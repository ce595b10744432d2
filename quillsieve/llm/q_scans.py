"""Queries of the scan repair."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsieve.llm.scans import fit_editor, repair
from quillsieve.session import table

SCANNED = "扫描页"


def _fields(spark: SparkSession, folder: str) -> DataFrame:
    """Rows ``(entry_no, scanned, field, text)``; delivered again ones are still there."""
    books = table(spark, folder, "formula_textbook")
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("text")) for c in ("组成", "主治")])
    rows = books.select(F.col("序号").alias("entry_no"), F.col("页码类型").eqNullSafe(SCANNED).alias("scanned"), F.explode(pairs).alias("f"))
    return rows.select("entry_no", "scanned", "f.field", "f.text").filter(F.col("text") != "")


def _repaired(spark: SparkSession, folder: str) -> DataFrame:
    rows = _fields(spark, folder)
    editor = fit_editor(rows, "text", F.col("scanned"))
    return repair(rows.filter(F.col("scanned") & F.col("entry_no").isNotNull()), ["entry_no", "field"], editor)


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """The kinds of noise in each field of the scanned entries."""
    return _repaired(spark, folder).select("entry_no", "field", F.explode("noise").alias("noise")).distinct()


def p6_repaired(spark: SparkSession, folder: str) -> DataFrame:
    """The repaired fields of the scanned entries."""
    return _repaired(spark, folder).select("entry_no", "field", "repaired").distinct()


QUERIES = {"p6_found": (p6_found, None), "p6_repaired": (p6_repaired, None)}
