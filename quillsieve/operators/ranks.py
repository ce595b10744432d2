"""Running sums and ranks without one task per group.

A window over a hot group would put a third of all rows into one task.  Here rows are spread over hash or value buckets
first, the small table of bucket totals carries the offsets, and the windows only span one bucket of one group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillsieve.session import cut_lineage

_PLACES = 33  # bits of the place within a partition in `monotonically_increasing_id`


def scalars(df: DataFrame) -> list[Column]:
    """The values of a frame of one row, as literals with their names: totals are read once instead of joined to all rows."""
    row = df.first()
    return [F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in df.schema]


def running_sum(df: DataFrame, group: Sequence[str], bucket: str, order: Sequence[str], size: Column, out: str) -> DataFrame:
    """Adds ``out``: the sum of ``size`` over all rows of the group up to and including this one.

    Rows are ordered by ``bucket`` and then by ``order``, which together must be unique within a group for a defined
    result.  One task sorts one bucket of one group; the offsets come from a table of one row per group and bucket.
    """
    keys = [*group, bucket]
    sized = df.withColumn("_size", size)
    totals = sized.groupBy(*keys).agg(F.sum("_size").alias("_total"))
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("_before", F.coalesce(F.sum("_total").over(before), F.lit(0))).drop("_total")
    within = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = sized.withColumn("_within", F.sum("_size").over(within)).join(totals, keys)
    return summed.withColumn(out, F.col("_before") + F.col("_within")).drop("_size", "_within", "_before")


def in_ranges(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``df`` in ranges of ``order``, written once: adds ``_part``, the number of the range, and ``_place`` in it.

    Spark samples the ranges from the data, so neither outliers nor a value with a third of all rows make a large one, as
    long as ``order`` as a whole is unique.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    part, place = F.shiftright("_id", _PLACES), F.col("_id").bitwiseAND(F.lit((1 << _PLACES) - 1))
    return cut_lineage(placed.withColumn("_part", part).withColumn("_place", place).drop("_id"))


def carry_over(df: DataFrame, by: str, value: Column, out: str, forward: bool) -> DataFrame:
    """Adds ``out``: the latest ``value`` that isn't null of the same ``by``, up to this row (``forward``), or the next one behind it.

    ``df`` comes from ``in_ranges``, ordered by ``by`` first.  A window spans one range of one ``by``; what lies in other
    ranges comes from a table of one row per range and ``by``.
    """
    own = Window.partitionBy("_part", by).orderBy("_place")
    keys = Window.partitionBy(by).orderBy("_part")
    marked = df.withColumn("_value", value)
    if forward:
        near = F.last("_value", ignorenulls=True).over(own.rowsBetween(Window.unboundedPreceding, 0))
        edge = F.max_by("_value", F.when(F.col("_value").isNotNull(), F.col("_place")))
        far = F.last("_edge", ignorenulls=True).over(keys.rowsBetween(Window.unboundedPreceding, -1))
    else:
        near = F.first("_value", ignorenulls=True).over(own.rowsBetween(1, Window.unboundedFollowing))
        edge = F.min_by("_value", F.when(F.col("_value").isNotNull(), F.col("_place")))
        far = F.first("_edge", ignorenulls=True).over(keys.rowsBetween(1, Window.unboundedFollowing))
    edges = marked.groupBy("_part", by).agg(edge.alias("_edge")).withColumn("_far", far)
    edges = edges.select(F.col("_part").alias("_p"), F.col(by).alias("_b"), "_far")
    joined = marked.withColumn("_near", near).join(edges, (F.col("_part") == F.col("_p")) & F.col(by).eqNullSafe(F.col("_b")), "left")
    return joined.withColumn(out, F.coalesce("_near", "_far")).drop("_value", "_near", "_far", "_p", "_b", "_part", "_place")
