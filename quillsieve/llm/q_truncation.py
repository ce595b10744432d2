"""Queries of the truncation operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsieve.llm.truncation import inspected, judge, limits
from quillsieve.session import cut_lineage, table


def chat_and_chosen(spark: SparkSession, folder: str) -> DataFrame:
    """Rows ``(tbl, grp, role, rec_key, turn, text)`` of all texts; delivered again ones are still there."""
    chats = table(spark, folder, "chat_samples").select("id", "src", F.posexplode("messages"))
    chats = chats.select(
        F.lit("chat_samples").alias("tbl"),
        F.coalesce("src", F.lit("")).alias("grp"),
        F.coalesce("col.role", F.lit("")).alias("role"),
        F.col("id").cast("string").alias("rec_key"),
        F.col("pos").cast("bigint").alias("turn"),
        F.col("col.content").alias("text"),
    )
    answers = table(spark, folder, "chosen_rerun_bad").select(
        F.lit("chosen_rerun_bad").alias("tbl"),
        F.coalesce("teacher", F.lit("")).alias("grp"),
        F.lit("assistant").alias("role"),
        F.col("id").cast("string").alias("rec_key"),
        F.lit(0).cast("bigint").alias("turn"),
        F.col("chosen").alias("text"),
    )
    return chats.unionByName(answers).filter(F.col("rec_key").isNotNull() & F.col("text").isNotNull())


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every text that breaks off before its end."""
    return judge(chat_and_chosen(spark, folder)).select("tbl", "rec_key", "turn").distinct()


def p1_rates(spark: SparkSession, folder: str) -> DataFrame:
    """Texts, cut texts and their share for each source and teacher; delivered again ones count once."""
    texts = chat_and_chosen(spark, folder)
    keys = ["tbl", "grp", "rec_key", "turn"]
    filled = texts.filter(F.trim("text") != "").select(*keys).distinct().groupBy("tbl", "grp").agg(F.count("*").alias("texts"))
    cut = judge(texts).select(*keys).distinct().groupBy("tbl", "grp").agg(F.count("*").alias("cut_texts"))
    rates = filled.join(cut, ["tbl", "grp"], "left").na.fill(0, ["cut_texts"])
    return rates.withColumn("cut_share", F.round(F.col("cut_texts") / F.col("texts"), 6))


def p1_limits(spark: SparkSession, folder: str) -> DataFrame:
    """Hidden storage limits by source and role, and the encoding that exposes each."""
    return limits(cut_lineage(inspected(chat_and_chosen(spark, folder))))


QUERIES = {"p1_found": (p1_found, None), "p1_rates": (p1_rates, None), "p1_limits": (p1_limits, None)}
