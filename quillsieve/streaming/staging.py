"""Streams over append-only staging folders: resumable, once per record, with alarms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def stage(spark: SparkSession, source: str, target: str, checkpoint: str, files_per_batch: int = 100) -> None:
    """Append what is new in the Parquet folder ``source`` to ``target`` and stop; a restart goes on where it ended."""
    schema = spark.read.parquet(source).schema
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    query = rows.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(target)
    query.awaitTermination()


def once_per_record(rows: DataFrame, key: str, at: str, late: str) -> DataFrame:
    """Each record once although it is delivered again; state is dropped ``late`` after the latest time seen."""
    return rows.withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def windowed_counts(rows: DataFrame, at: str, width: str, late: str, by: str) -> DataFrame:
    """Rows in each time window and group; windows close ``late`` after the latest time seen."""
    windows = rows.withWatermark(at, late).groupBy(F.window(at, width), by)
    return windows.agg(F.count("*").alias("rows")).select(F.col("window.start").alias("start"), by, "rows")


def staged_with_alarm(rows: DataFrame, target: str, checkpoint: str, bad: Column, most: float) -> list[dict]:
    """Append each micro-batch and return one entry per batch whose share of bad rows exceeds ``most``."""
    alarms: list[dict] = []

    def handle(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        counted = batch.agg(F.count("*").alias("rows"), F.count_if(bad).alias("bad")).first()
        # a batch that is run again after a failure overwrites its own folder, so it isn't there twice
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")
        batch.unpersist()
        if counted["rows"] and counted["bad"] > most * counted["rows"]:
            alarms.append({"batch": number, "rows": counted["rows"], "bad": counted["bad"]})

    query = rows.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return alarms
