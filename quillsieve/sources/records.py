"""Readers and writers of the record formats: lenient and strict JSON lines, CSV with a byte-order mark, page texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lenient_json(spark: SparkSession, path: str, strict_first_line: bool = False) -> DataFrame:
    """Rows ``(file, value, record)`` of JSON lines or of whole files that hold a JSON array; ``record`` is a variant.

    Blank lines and lines that don't parse are skipped.  With ``strict_first_line`` a file whose first line doesn't parse
    gives nothing.  A file is an array if its first character is ``[``; such a file must fit into one task.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value"))
    starts = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), "value")
    starts = starts.withColumn("line", F.monotonically_increasing_id())  # rises within a block
    first = starts.filter("at = 0").groupBy("file").agg(F.min_by("value", "line").alias("first"))
    names = [r["file"] for r in first.filter(F.ltrim("first").startswith("[")).collect()]  # names of files, not their content
    arrays = spark.createDataFrame([(n,) for n in names], "file string")
    whole = spark.createDataFrame([], "file string, value string")
    if names:  # only files that hold an array are read whole
        whole = spark.read.text(names, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    elements = whole.select("file", F.explode(F.from_json("value", "array<variant>")).alias("record"))
    from_arrays = elements.select("file", F.to_json("record").alias("text"), "record")
    plain = lines.join(F.broadcast(arrays), "file", "left_anti").filter(F.trim("value") != "")
    if strict_first_line:
        bad = first.filter(F.try_parse_json("first").isNull()).select("file")
        plain = plain.join(F.broadcast(bad), "file", "left_anti")
    parsed = plain.select("file", F.col("value").alias("text"), F.try_parse_json("value").alias("record")).filter(F.col("record").isNotNull())
    return parsed.unionByName(from_arrays)


def read_sources(spark: SparkSession, sources: Sequence[dict]) -> tuple[DataFrame | None, list[str]]:
    """Rows ``(name, track, system, source_no, file, text, record)`` of all sources, and the names of those that are missing.

    ``sources``: ``name`` and ``path`` (a glob is fine), optionally ``track``, ``system`` and ``disabled``; disabled ones
    are skipped.  The order of the list and the file names is the order that first-wins rules go by.
    """
    whole, missing = None, []
    for at, source in enumerate(sources):
        if source.get("disabled"):
            continue
        try:
            rows = read_lenient_json(spark, source["path"])
        except AnalysisException as problem:
            if "PATH_NOT_FOUND" not in str(problem):
                raise
            missing.append(source["name"])
            continue
        text = lambda key: F.lit(source.get(key)).cast("string").alias(key)  # noqa: B023, E731
        rows = rows.select(F.lit(source["name"]).alias("name"), text("track"), text("system"), F.lit(at).alias("source_no"), "file", "text", "record")
        whole = rows if whole is None else whole.unionByName(rows)
    return whole, missing


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    """The different integers of text files with one in each line; other lines are skipped."""
    return spark.read.text(path).select(F.trim("value").try_cast("bigint").alias("id")).filter(F.col("id").isNotNull()).distinct()


def write_csv(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """CSV of these columns in this order, with a header that begins with a byte-order mark; other columns are left out."""
    first, *rest = columns
    marked = df.select(F.col(f"`{first}`").alias("\ufeff" + first), *[f"`{c}`" for c in rest])
    marked.write.mode("overwrite").csv(path, header=True, quote='"', escape='"')


def read_strict_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines of one schema; a line that doesn't parse fails the job."""
    return spark.read.schema(schema).json(path, mode="FAILFAST")


def read_csv_strings(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header: all columns strings, quoted line breaks allowed, a byte-order mark dropped."""
    df = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', inferSchema=False, encoding="UTF-8")
    return df.toDF(*[c.lstrip("﻿") for c in df.columns])


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Rows ``(page, text)`` of a folder of page texts, the number taken from the file name."""
    rows = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("text"))
    return rows.select(F.regexp_extract("file", r"(\d+)", 1).try_cast("int").alias("page"), "text").filter(F.col("page").isNotNull())


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    """The frame itself; fails at once if a column is missing."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def write_json_lines(df: DataFrame, path: str) -> None:
    """JSON lines with null fields kept and other scripts unescaped; the committer publishes whole files only."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def split_write(df: DataFrame, part: str, path: str) -> None:
    """One folder for each value of ``part``, from one pass over the data."""
    df.write.mode("overwrite").partitionBy(part).parquet(path)
