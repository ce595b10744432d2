"""Queries over fields that pack several values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsieve.operators.multivalue import explode_values
from quillsieve.session import table

SCANNED = "扫描页"


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every value of a composition or alias field that holds two or more, with its position."""
    books = table(spark, folder, "formula_textbook").filter(~F.col("页码类型").eqNullSafe(SCANNED))
    herbs = explode_values(books, F.col("序号"), F.col("组成"), bare_names=True)
    names = explode_values(table(spark, folder, "western_meds"), F.col("序号"), F.col("`别名/商品名`"))
    columns = ("tbl", "rec_key", "pos", "item")
    return (
        herbs.withColumn("tbl", F.lit("formula_textbook"))
        .select(*columns)
        .unionByName(names.withColumn("tbl", F.lit("western_meds")).select(*columns))
    )


QUERIES = {"p3_found": (p3_found, None)}
