"""Queries of the mixing operator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsieve.llm.mixing import mix, schedule, shares, unmet
from quillsieve.session import table


def _label(c: Column) -> Column:
    """Labels that differ in case or blanks are one; a generated multiple-choice label counts as the plain one."""
    bare = F.lower(F.regexp_replace(c, r"[\s\p{Z}]+", ""))
    return F.when(bare == "mcq_gen", "mcq").otherwise(bare)


def _file(c: Column) -> Column:
    """File names that differ in folder, case or outer blanks are one."""
    return F.lower(F.regexp_replace(F.regexp_replace(c, r"^.*[/\\]", ""), r"^[\s\p{Z}]+|[\s\p{Z}]+$", ""))


def _size(c: Column) -> Column:
    return F.when(F.regexp_replace(c, r"[\s\p{Z}]+", "") == "", 0).otherwise(F.coalesce(F.length(c), F.lit(0)))


def _inputs(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pool, targets with normalized labels, and the labels as they are written in the targets."""
    seeds = table(spark, folder, "seed_prompts").select("id", _size(F.col("prompt")).alias("size"), "source_file", "category")
    seeds = seeds.dropDuplicates(["id"])
    items = table(spark, folder, "eval_v2").select("id", _size(F.col("question")).alias("size"), "source").dropDuplicates(["id"])
    keyed = F.array(
        F.struct(F.lit("by_file").alias("mix_id"), _file(F.col("source_file")).alias("label")),
        F.struct(F.lit("by_category").alias("mix_id"), _label(F.col("category")).alias("label")),
    )
    pool = seeds.select(F.explode(keyed).alias("k"), F.col("id").alias("rec_id"), "size").select("k.*", "rec_id", "size")
    by_source = items.select(F.lit("by_eval_source").alias("mix_id"), _label(F.col("source")).alias("label"), F.col("id").alias("rec_id"), "size")
    named = table(spark, folder, "mix_targets").withColumn("written", F.col("label"))
    named = named.withColumn("label", F.when(F.col("mix_id") == "by_file", _file(F.col("written"))).otherwise(_label(F.col("written"))))
    return pool.unionByName(by_source), named.drop("written"), named.select("mix_id", "label", "written")


def _as_written(df: DataFrame, written: DataFrame) -> DataFrame:
    columns = df.columns
    return df.join(F.broadcast(written), ["mix_id", "label"]).drop("label").withColumnRenamed("written", "label").select(*columns)


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Targets that cannot be met."""
    pool, targets, written = _inputs(spark, folder)
    return _as_written(unmet(*schedule(pool, targets)), written)


def p2_shares(spark: SparkSession, folder: str) -> DataFrame:
    """Shares asked for and reached, for each target."""
    pool, targets, written = _inputs(spark, folder)
    return _as_written(shares(*schedule(pool, targets)), written)


def p2_mix(spark: SparkSession, folder: str) -> DataFrame:
    """The records of each mix in serving order."""
    pool, targets, written = _inputs(spark, folder)
    return _as_written(mix(pool, targets), written)


P2_FOUND_SQL = r"""
WITH seeds AS (
  SELECT DISTINCT ON (id) id, CASE WHEN regexp_replace(prompt, '[\s\p{Z}]+', '', 'g') = '' THEN 0 ELSE coalesce(length(prompt), 0) END AS size,
         lower(regexp_replace(regexp_replace(source_file, '^.*[/\\]', ''), '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')) AS f,
         lower(regexp_replace(category, '[\s\p{Z}]+', '', 'g')) AS c
  FROM seed_prompts),
pool AS (
  SELECT 'by_file' AS mix_id, f AS label, size FROM seeds
  UNION ALL SELECT 'by_category', CASE WHEN c = 'mcq_gen' THEN 'mcq' ELSE c END, size FROM seeds
  UNION ALL SELECT 'by_eval_source', lower(regexp_replace(source, '[\s\p{Z}]+', '', 'g')), coalesce(length(question), 0) FROM eval_v2),
whole AS (SELECT mix_id, sum(size) AS total FROM pool GROUP BY mix_id),
own AS (SELECT mix_id, label, sum(size) AS chars FROM pool GROUP BY mix_id, label)
SELECT t.mix_id, t.label
FROM mix_targets t
LEFT JOIN whole w ON w.mix_id = t.mix_id
LEFT JOIN own o ON o.mix_id = t.mix_id AND o.label = lower(t.label)
WHERE t.max_repeats * coalesce(o.chars, 0) < t.target_share * t.budget_ratio * coalesce(w.total, 0)
"""

QUERIES = {"p2_found": (p2_found, P2_FOUND_SQL), "p2_shares": (p2_shares, None), "p2_mix": (p2_mix, None)}
