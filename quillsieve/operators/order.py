"""Operators whose result depends on an order: winners per key, caps, priorities, ids.

Winners are aggregates, which combine before the shuffle, so a key with a third of all rows costs no more than others.  Ranks that are cut at a constant use windows, which Spark limits before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillsieve.operators.ranks import in_ranges


def _winner(df: DataFrame, key: Sequence[Column], order: Sequence[str], columns: Sequence[str] | None, first: bool) -> DataFrame:
    wanted = list(columns) if columns is not None else df.columns
    keys = [c.alias(f"_k{at}") for at, c in enumerate(key)]
    slim = df.select(*keys, *dict.fromkeys([*order, *wanted]))  # only what is asked for is shuffled
    names = [f"_k{at}" for at in range(len(keys))]
    if len(order) == 1 and wanted == list(order):
        best = (F.min if first else F.max)(order[0])
        return slim.groupBy(*names).agg(best.alias(order[0])).select(order[0])
    best = (F.min_by if first else F.max_by)(F.struct(*wanted), F.struct(*order))
    return slim.groupBy(*names).agg(best.alias("_row")).select("_row.*")


def first_wins(df: DataFrame, key: Sequence[Column], order: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """For each key the ``columns`` (all, if not given) of the row that is first by ``order``; null keys are one key.

    Where only the one order column is wanted this is a minimum by hash aggregation, and no other column is read.
    """
    return _winner(df, key, order, columns, True)


def last_wins(df: DataFrame, key: Sequence[Column], order: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """For each key the ``columns`` of the row that is last by ``order``."""
    return _winner(df, key, order, columns, False)


def cap_per_key(df: DataFrame, key: Sequence[Column], order: Sequence[Column], most: int) -> DataFrame:
    """At most ``most`` rows of each key, the first by ``order``; ``order`` must be unique for a defined result."""
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= most).drop("_rank")


def priority_merge(sources: Sequence[DataFrame], key: str, order: str) -> DataFrame:
    """Union of sources of one schema in which an earlier source beats a later one; adds ``priority`` from 0."""
    ranked = [s.withColumn("priority", F.lit(at)) for at, s in enumerate(sources)]
    merged = ranked[0]
    for other in ranked[1:]:
        merged = merged.unionByName(other)
    return first_wins(merged, [F.col(key)], ["priority", order])


def with_index(df: DataFrame, order: str | Sequence[str], out: str, group: Sequence[str] = ()) -> DataFrame:
    """Adds ``out``: 0, 1, ... by the unique ``order``, within ``group`` if given; null groups are one group.

    Rows are sorted once in ranges of group and order, which Spark samples from the data, so a hot group and outliers are
    split like anything else; the offsets are a table of one row per range.
    """
    order = [order] if isinstance(order, str) else list(order)
    placed = in_ranges(df, [*group, *order])
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))  # a row for each range
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    numbered = placed.join(F.broadcast(offsets), "_part").withColumn(out, F.col("_before") + F.col("_place"))
    if group:
        starts = numbered.groupBy(*[F.col(g).alias(f"_g{at}") for at, g in enumerate(group)]).agg(F.min(out).alias("_first"))
        same = [F.col(g).eqNullSafe(F.col(f"_g{at}")) for at, g in enumerate(group)]
        numbered = numbered.join(starts, same).withColumn(out, F.col(out) - F.col("_first"))
        numbered = numbered.drop("_first", *[f"_g{at}" for at in range(len(group))])
    return numbered.drop("_part", "_place", "_before")
