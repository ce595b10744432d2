"""Normalization of raw records to one chat schema: ``system`` and ``messages`` of one user and one assistant turn."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsieve.functions.text import py_strip
from quillsieve.operators.order import with_index

# Names that a field can have, the first filled one counts; they differ in case.
USER = ("query", "question", "instruction", "prompt", "input", "user", "Question", "Instruction")
ASSISTANT = ("response", "answer", "output", "target", "assistant", "Answer", "Response", "Output")
SYSTEM = ("system", "system_prompt", "System")
INSTRUCTION, INPUT = ("instruction", "Instruction"), ("input", "Input")
# The label before a turn of a pair, at the first line that has one.
TURN_LABEL = r"(?sm)\A(.*?)^(?:问|答)[:：]\s*(.*)\z"


def _field(record: Column, *names: str) -> Column:
    """The first filled of several fields as text, without outer white space; names are told apart by case."""
    values = F.array(*[F.try_variant_get(record, f"$.{name}", "string") for name in names])
    return F.try_element_at(F.filter(F.transform(values, py_strip), lambda v: v != ""), F.lit(1))


def _turn(record: Column, at: int) -> Column:
    text = py_strip(F.try_variant_get(record, f"$.data[{at}]", "string"))
    return F.nullif(py_strip(F.regexp_replace(text, TURN_LABEL, "$1$2")), F.lit(""))


def normalize_records(records: DataFrame, record: str, system: Column) -> DataFrame:
    """``records`` with ``system`` and ``messages`` in place of the variant column ``record``; what lacks a turn is dropped.

    A pair in ``data`` is a turn each, without its label; otherwise instruction and input are joined where both are filled
    and differ, else the first filled user field counts.  A record's own system prompt outranks ``system``.  Null
    records and those that aren't objects are dropped; other columns stay.
    """
    raw = F.col(record)
    fields = {"_pair": F.try_variant_get(raw, "$.data[1]", "variant").isNotNull(), "_first": _turn(raw, 0), "_second": _turn(raw, 1)}
    fields |= {"_told": _field(raw, *INSTRUCTION), "_extra": _field(raw, *INPUT), "_asked": _field(raw, *USER), "_said": _field(raw, *ASSISTANT)}
    rows = records.withColumns(fields | {"_own": _field(raw, *SYSTEM), "_system": system}).drop(record)
    both = F.col("_told").isNotNull() & F.col("_extra").isNotNull() & (F.lower("_told") != F.lower("_extra"))
    asked = F.when(F.col("_pair"), F.col("_first")).when(both, F.concat("_told", F.lit("\n"), "_extra")).otherwise(F.col("_asked"))
    rows = rows.withColumns({"_asked": asked, "_said": F.when(F.col("_pair"), F.col("_second")).otherwise(F.col("_said"))})
    rows = rows.filter(F.col("_asked").isNotNull() & F.col("_said").isNotNull())
    turn = lambda role, c: F.struct(F.lit(role).alias("role"), F.col(c).alias("content"))
    messages = F.array(turn("user", "_asked"), turn("assistant", "_said"))
    done = rows.withColumns({"system": F.coalesce("_own", "_system"), "messages": messages})
    return done.drop("_pair", "_first", "_second", "_told", "_extra", "_asked", "_said", "_own", "_system")


def strict_schema(df: DataFrame, label: str, order: str) -> DataFrame:
    """Only ``id``, ``system`` and ``messages``; a missing id becomes the label and the row's place in it by ``order``."""
    placed = with_index(df.select("id", "system", "messages", label, order), order, "_n", [label])
    filled = F.coalesce(F.col("id").cast("string"), F.concat_ws("_", F.col(label), F.col("_n").cast("string")))
    return placed.select(filled.alias("id"), "system", "messages")
