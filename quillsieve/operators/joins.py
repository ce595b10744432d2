"""Joins beyond equality: as-of, band, containment, update and coverage."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsieve.operators.ranks import carry_over, in_ranges

#: Terms of one automaton.
AUTOMATON_TERMS = 100_000


def asof_backward(left: DataFrame, right: DataFrame, by: str, left_at: str, right_at: str, value: str) -> DataFrame:
    """Each left row with the ``value`` of the latest right row of its key at or before it; before all, null.

    Both sides are merged and sorted once in ranges of key and time, and the last value is carried on, from range to range
    too: no pairs are formed and no key is one task.  A right row of the same time counts as before.
    """
    a = left.select("*", F.col(left_at).alias("_at"), F.lit(1).alias("_side"), F.lit(None).cast(right.schema[value].dataType).alias("_v"))
    b = right.select(F.col(by), F.col(right_at).alias("_at"), F.lit(0).alias("_side"), F.col(value).alias("_v"))
    both = in_ranges(a.unionByName(b, allowMissingColumns=True), [by, "_at", "_side"])
    carried = carry_over(both, by, F.col("_v"), value, forward=True)
    return carried.filter("_side = 1").drop("_at", "_side", "_v")


def band_join(left: DataFrame, right: DataFrame, left_at: str, right_at: str, width: int) -> DataFrame:
    """Pairs with ``right_at`` within ``width`` of the integer ``left_at``: an equality join on cells of that width."""
    size = max(1, width)
    cells = F.explode(F.array(*[F.floor(F.col(left_at) / size) + d for d in (-1, 0, 1)]))
    cut = left.withColumn("_cell", cells)
    own = right.withColumn("_cell", F.floor(F.col(right_at) / size))
    near = F.abs(cut[left_at] - own[right_at]) <= width
    return cut.join(own, (cut["_cell"] == own["_cell"]) & near).drop("_cell")


def contained_terms(texts: DataFrame, key: str, text: str, terms: DataFrame, term: str) -> DataFrame:
    """Pairs ``(key, term)`` where the text contains the term, of any length, without comparing all pairs.

    ``terms`` is a catalogue: its different values come to the driver and go out in automata of ``AUTOMATON_TERMS`` terms,
    each of which reads every text once (Aho and Corasick).  Null texts and null or empty terms give no pairs; ``key``
    must be unique.  The texts stay where they are.
    """
    listed = sorted(r["term"] for r in terms.select(F.col(term).alias("term")).filter("term <> ''").distinct().collect())
    slim = texts.select(key, F.col(text).alias("_text")).filter(F.length("_text") > 0)
    schema = f"`{key}` {slim.schema[key].dataType.simpleString()}, term string"
    found = texts.sparkSession.createDataFrame([], schema)
    for at in range(0, len(listed), AUTOMATON_TERMS):
        sent = texts.sparkSession.sparkContext.broadcast(listed[at : at + AUTOMATON_TERMS])

        def run(batches, sent=sent):
            import ahocorasick

            automaton = ahocorasick.Automaton()
            for word in sent.value:
                automaton.add_word(word, word)
            automaton.make_automaton()
            for batch in batches:
                rows = [(k, w) for k, t in zip(batch[key], batch["_text"]) for w in sorted({w for _, w in automaton.iter(t)})]
                yield pd.DataFrame(rows, columns=[key, "term"])

        found = found.unionByName(slim.mapInPandas(run, schema))
    return found


def _pieces(name: Column) -> Column:
    """All pieces of a short string, the string itself included."""
    size = F.length(name)
    of_start = lambda at: F.transform(F.sequence(F.lit(1), size - at + 1), lambda n: F.substring(name, at, n))
    return F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(1), size), of_start)))


def first_contained(names: DataFrame, key: str, name: str, terms: DataFrame, term: str, order: str) -> DataFrame:
    """Rows ``(key, term)``: for each name the first term by ``order`` that it contains or that contains it.

    Both sides are names, not texts: each is cut into all its pieces, and what contains the other is an equality join on
    them.  Null and empty names match nothing; ties in ``order`` go by the term.
    """
    left = names.select(F.col(key).alias(key), F.col(name).alias("_name")).filter(F.length("_name") > 0)
    right = terms.select(F.col(term).alias("term"), F.col(order).alias("_order")).filter(F.length("term") > 0)
    inside = left.select(key, F.explode(_pieces(F.col("_name"))).alias("term")).join(right, "term").select(key, "term", "_order")
    around = right.withColumn("_name", F.explode(_pieces(F.col("term")))).join(left, "_name").select(key, "term", "_order")
    return inside.unionByName(around).groupBy(key).agg(F.min_by("term", F.struct("_order", "term")).alias("term"))


def update_join(left: DataFrame, right: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """The left rows with their ``fields`` overwritten by the right row's where that isn't empty; ``right`` has unique keys."""
    renamed = right.select(key, *[F.nullif(F.col(f), F.lit("")).alias(f"_{f}") for f in fields])
    joined = left.join(renamed, key, "left")
    for f in fields:
        joined = joined.withColumn(f, F.coalesce(f"_{f}", f)).drop(f"_{f}")
    return joined


def coverage(wanted: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Wanted rows that aren't done."""
    return wanted.join(done.select(key).distinct(), key, "left_anti")
