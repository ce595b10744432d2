"""Reports: percentiles by index, histograms, shares and reasons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def percentiles_by_index(df: DataFrame, group: str, value: str, shares: Sequence[float]) -> DataFrame:
    """For each group the value at index ``int(n * q)`` of its sorted values, in columns ``p50`` and so on.

    Computed from the histogram of values: a group is never gathered, its distinct values are.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(group, value).agg(F.count("*").alias("_n"))
    order = Window.partitionBy(group).orderBy(value)
    upto = counts.withColumn("_upto", F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    upto = upto.withColumn("_all", F.sum("_n").over(Window.partitionBy(group)))
    picks = []
    for q in shares:
        index = F.least(F.floor(F.col("_all") * F.lit(q)), F.col("_all") - 1)
        picks.append(F.min(F.when(F.col("_upto") > index, F.col(value))).alias(f"p{round(q * 100)}"))
    return upto.groupBy(group).agg(F.max("_all").alias("n"), *picks)


def bucketed(value: Column, edges: Sequence[int]) -> Column:
    """Labels of the ranges between fixed edges, the lower edge in."""
    label = F.when(value < edges[0], f"<{edges[0]}")
    for low, high in zip(edges, edges[1:]):
        label = label.when(value < high, f"{low}-{high - 1}")
    return label.otherwise(f">={edges[-1]}")


def first_reason(*rules: tuple[str, Column]) -> Column:
    """The name of the first rule that holds, null if none does; the order of the rules is part of the result."""
    name, rule = rules[0]
    out = F.when(rule, name)
    for name, rule in rules[1:]:
        out = out.when(rule, name)
    return out
