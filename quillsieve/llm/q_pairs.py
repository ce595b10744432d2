"""Queries of the pair operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsieve.llm.pairs import defects
from quillsieve.llm.q_language import language_model
from quillsieve.llm.q_truncation import chat_and_chosen
from quillsieve.llm.truncation import judge
from quillsieve.session import table


def pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Rows ``(tbl, rec_key, turn, question, answer)``: each answer with the message before it."""
    before = F.transform(
        "messages",
        lambda m, at: F.struct(
            at.cast("bigint").alias("turn"),
            m["role"].alias("role"),
            F.when(at > 0, F.get(F.col("messages"), at - 1)["content"]).alias("question"),
            m["content"].alias("answer"),
        ),
    )
    chats = table(spark, folder, "chat_samples").select("id", F.explode(before).alias("m")).filter("m.role = 'assistant'")
    chats = chats.select(
        F.lit("chat_samples").alias("tbl"), F.col("id").cast("string").alias("rec_key"), "m.turn", "m.question", "m.answer"
    )
    answers = table(spark, folder, "chosen_rerun_bad").select(
        F.lit("chosen_rerun_bad").alias("tbl"),
        F.col("id").cast("string").alias("rec_key"),
        F.lit(0).cast("bigint").alias("turn"),
        F.col("prompt").alias("question"),
        F.col("chosen").alias("answer"),
    )
    return chats.unionByName(answers).filter(F.col("rec_key").isNotNull())


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every defective pair with the kind of its defect."""
    cut = judge(chat_and_chosen(spark, folder)).filter("role = 'assistant'")
    return defects(pairs(spark, folder), cut, language_model(spark, folder))


def p4_counts(spark: SparkSession, folder: str) -> DataFrame:
    """How many answers have each defect."""
    return p4_found(spark, folder).groupBy("tbl", "defect").agg(F.count("*").alias("answers"))


QUERIES = {"p4_found": (p4_found, None), "p4_counts": (p4_counts, None)}
