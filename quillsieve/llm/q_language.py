"""Queries of the language operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsieve.llm.language import LanguageModel, detect, fit, label_code, training_sentences
from quillsieve.session import table

LANGUAGES = ("zh", "en", "ja", "ko", "de", "fr", "es")


def messages(spark: SparkSession, folder: str) -> DataFrame:
    """Rows ``(sample_id, turn, label, text)``, one for each message with text; delivered again ones are still there."""
    samples = table(spark, folder, "chat_samples").select("id", label_code(F.col("lang")).alias("label"), F.posexplode("messages"))
    return samples.select(
        F.col("id").alias("sample_id"), F.col("pos").cast("bigint").alias("turn"), "label", F.col("col.content").alias("text")
    ).filter(F.col("sample_id").isNotNull() & F.col("text").isNotNull())


def language_model(spark: SparkSession, folder: str) -> LanguageModel:
    known = messages(spark, folder).filter(F.col("label").isin(*LANGUAGES))
    return fit(*training_sentences(known, ["sample_id", "turn"], "label", "text"))


def _segments(spark: SparkSession, folder: str) -> DataFrame:
    """Segments of all messages; those of samples delivered again are there again, so no text is shuffled."""
    return detect(messages(spark, folder), ["sample_id", "turn", "label"], "text", language_model(spark, folder))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """The languages of every message whose languages aren't exactly those of its sample's label."""
    by_message = _segments(spark, folder).groupBy("sample_id", "turn", "label").agg(F.collect_set("language").alias("found"))
    agrees = F.coalesce((F.size("found") == 1) & (F.col("found")[0] == F.col("label")), F.lit(False))
    return by_message.filter(~agrees).select("sample_id", "turn", F.explode("found").alias("lang"))


def p5_segments(spark: SparkSession, folder: str) -> DataFrame:
    """Every segment of every message with its language and confidence."""
    columns = ("sample_id", "turn", "segment_no", "segment", "language", F.round("confidence", 6).alias("confidence"))
    return _segments(spark, folder).select(*columns).dropDuplicates(["sample_id", "turn", "segment_no"])


QUERIES = {"p5_found": (p5_found, None), "p5_segments": (p5_segments, None)}
