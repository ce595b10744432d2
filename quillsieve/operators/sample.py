"""Reproducible samples: every random choice is a hash of a seed and a key, so it doesn't depend on the partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillsieve.operators.order import with_index
from quillsieve.operators.ranks import scalars


def hash01(key: Column) -> Column:
    """A number in [0, 1) from the first 64 bits of the SHA-256 of the key."""
    return F.conv(F.substring(F.sha2(key, 256), 1, 16), 16, 10).cast("double") / F.lit(2.0**64)


def hash_order(key: Column, seed: int) -> Column:
    """A value to order by at random: the MD5 of seed and key."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def hash_quota(df: DataFrame, key: Column, share: float) -> DataFrame:
    """Rows whose hash lies below ``share``."""
    return df.filter(hash01(key) < share)


def sample_k(df: DataFrame, key: str, k: int, seed: int) -> DataFrame:
    """``k`` rows at random (all, if there are fewer); Spark keeps ``k`` rows a partition before it merges them."""
    return df.orderBy(hash_order(F.col(key), seed), key).limit(k)


def stratified_k(df: DataFrame, stratum: str, key: str, k: int, seed: int) -> DataFrame:
    """``k`` rows at random of each stratum."""
    rank = F.row_number().over(Window.partitionBy(stratum).orderBy(hash_order(F.col(key), seed), key))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= k).drop("_rank")


def stratified_share(df: DataFrame, stratum: str, key: str, total: int, seed: int) -> DataFrame:
    """About ``total`` rows in all, each stratum in proportion (rounded half to even); a hot stratum is split over tasks."""
    counts = df.groupBy(stratum).agg(F.count("*").alias("_n"))
    whole = counts.agg(F.sum("_n").alias("_all"))
    quota = counts.select("*", *scalars(whole)).select(F.col(stratum).alias("_s"), F.bround(F.lit(total) * F.col("_n") / F.col("_all")).alias("_quota"))
    ranked = with_index(df.withColumn("_hash", hash_order(F.col(key), seed)), ["_hash", key], "_rank", [stratum])
    joined = ranked.join(quota, ranked[stratum].eqNullSafe(quota["_s"]))
    return joined.filter(F.col("_rank") < F.col("_quota")).drop("_rank", "_quota", "_hash", "_s")


def drop_bottom(df: DataFrame, score: str, key: str, share: float) -> DataFrame:
    """Without the lowest ``int(n * share)`` rows by score, ties by key: an index over both, so no score is one task."""
    whole = df.agg(F.floor(F.count("*") * share).alias("_drop"))
    ranked = with_index(df, [score, key], "_rank")
    return ranked.select("*", *scalars(whole)).filter(F.col("_rank") >= F.col("_drop")).drop("_rank", "_drop")


def bounded_rows(df: DataFrame, column: str, most: int, rows: int) -> DataFrame:
    """At most ``most`` different values of ``column``, those with the least hashes; ``rows``: how many rows there are.

    Only rows below a hash threshold that lets about twice ``most`` of ``rows`` through are compared at all, so what is
    shuffled and ordered is bounded, however large the table is; repeated values combine before the shuffle.  Nulls
    don't count.
    """
    span = 1 << 31
    below = min(span, -(-2 * most * span // max(rows, 1)))
    hashed = F.xxhash64(column)
    picked = df.select(column).filter(F.col(column).isNotNull() & (F.pmod(hashed, F.lit(span)) < below)).distinct()
    return picked.orderBy(F.pmod(hashed, F.lit(span)), hashed, column).limit(most)
