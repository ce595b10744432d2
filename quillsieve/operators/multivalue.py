"""Fields that pack several values: a quote-aware tokenizer with ordinals.

A finite-state tokenizer walks each field once.  Its state is the quote that is open, the stack of open brackets and
whether an escape is pending; a delimiter counts only with no quote and no bracket open.  It emits the values in order,
Spark turns them into rows with ``posexplode``.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The marks the automaton knows.
QUOTES = {'"': '"', "'": "'", "“": "”", "‘": "’", "「": "」", "『": "』", "＂": "＂", "«": "»"}
BRACKETS = {"(": ")）", "（": "）)", "[": "]］", "［": "］]", "【": "】", "{": "}｝", "｛": "｝}", "《": "》", "〈": "〉", "〔": "〕"}
DELIMITERS = frozenset("、，,；;|｜/／\n\r\t\v\f·•‖¦  ")
BLANKS = frozenset("  　   ﻿")
CIRCLED = re.compile(r"[①-⑳⑴-⒇㈠-㈩❶-❿]")
LIST_MARK = re.compile(r"(?:[(（]\d{1,2}[)）]|\d{1,2}(?:[)）、:：]|[.．](?!\d))|[-*•](?=\s))\s*")
NUMBERED = re.compile(r"[(（]\d{1,2}[)）]")
LATIN = re.compile(r"[A-Za-z0-9À-ɏ.'’&+\-]")


def _is_wrapped(text: str) -> bool:
    """Whether square brackets enclose the whole text: the first one closes at the last character."""
    if len(text) < 2 or text[0] not in "[［" or text[-1] not in "]］":
        return False
    depth = 0
    for at, char in enumerate(text):
        depth += (char in "[［") - (char in "]］")
        if depth == 0:
            return at == len(text) - 1
    return False


def split_values(text: str | None) -> list[str]:
    """The values of one packed field, in order, quotes removed and list marks dropped.

    None, empty and blank texts give no values.  An unclosed quote or bracket runs to the end of the text, so nothing is
    lost.  The cost is linear in the length of the text.
    """
    if text is None:
        return []
    text = text.strip()
    if _is_wrapped(text):
        text = text[1:-1]
    values: list[str] = []
    current: list[str] = []
    stack: list[str] = []
    quote = ""
    quoted = False  # the value began with a quote
    at, size = 0, len(text)

    def emit() -> None:
        nonlocal current, quoted
        value = "".join(current)
        value = value if quoted else value.strip("".join(BLANKS) + "\r\n\t")
        if not quoted:
            mark = LIST_MARK.match(value)
            value = value[mark.end() :] if mark else value
        value = value.strip()
        if value:
            values.append(value)
        current, quoted = [], False

    while at < size:
        char = text[at]
        if quote:
            if char == "\\" and at + 1 < size:
                current.append(text[at + 1])
                at += 2
                continue
            if char == quote:
                if text[at + 1 : at + 2] == quote:  # a doubled quote stands for one
                    current.append(char)
                    at += 2
                    continue
                quote = ""
            else:
                current.append(char)
            at += 1
            continue
        if stack:
            current.append(char)
            if char in stack[-1]:
                stack.pop()
            elif char in BRACKETS:
                stack.append(BRACKETS[char])
            at += 1
            continue
        blank_so_far = not any(not c.isspace() for c in current)
        if char in QUOTES and (blank_so_far or LIST_MARK.fullmatch("".join(current).strip())):
            quote, quoted, current = QUOTES[char], True, []
            at += 1
            continue
        if CIRCLED.match(char) or (char in "(（" and NUMBERED.match(text, at)):
            emit()
            at = at + 1 if CIRCLED.match(char) else NUMBERED.match(text, at).end()
            continue
        if char in BRACKETS:
            stack.append(BRACKETS[char])
            current.append(char)
            at += 1
            continue
        if char == "\\" and at + 1 < size:
            current.append(text[at + 1])
            at += 2
            continue
        if char in DELIMITERS:
            if char == "、" and "".join(current).strip().isdigit():
                current = []  # the mark of a numbered list
            else:
                emit()
            at += 1
            continue
        if char in BLANKS:
            end = at
            while end < size and text[end] in BLANKS:
                end += 1
            before, after = "".join(current).rstrip()[-1:], text[end : end + 1]
            if not before or not after or after in DELIMITERS or after in BRACKETS and not NUMBERED.match(text, end):
                current.extend([" "] if before else [])
            elif end - at > 1 or char == "　" or LIST_MARK.match(text, end) or not (LATIN.match(before) and LATIN.match(after)):
                emit()
            else:
                current.append(char)
            at = end
            continue
        current.append(char)
        at += 1
    emit()
    return values


# How amounts are written.
DOSE = re.compile(
    r"各?\s*(?:\d+(?:\.\d+)?\s*(?:g|G|克|mg|ml|mL|毫克|毫升|钱|两|枚|片|个|条|粒|分|斤|升|对)|[一二三四五六七八九十半两数百]{1,4}(?:钱|两|枚|片|个|条|粒|分|斤|升|对)半?|适量|少许|等分)$"
)
NOTE = re.compile(r"[(（\[【][^()（）\[\]【】]*[)）\]】]?")
HAN = re.compile(r"[㐀-鿿]")


def bare_name(value: str) -> str:
    """The name in an entry of a composition: without notes, Latin names and doses; "" if nothing else is there."""
    before = None
    while before != value:
        before, value = value, NOTE.sub("", value).strip()
    value = re.sub(r"[A-Za-z][A-Za-z. ]{2,}$", "", value).strip() if HAN.search(value) else value
    before = None
    while before != value:
        before = value
        cut = DOSE.search(value)
        value = value[: cut.start()].strip() if cut else value
    return value if HAN.search(value) else ""


def _values(texts: pd.Series) -> pd.Series:
    return texts.map(split_values)


def _names(texts: pd.Series) -> pd.Series:
    return texts.map(lambda text: [name for name in map(bare_name, split_values(text)) if name])


_split_udf = F.pandas_udf(_values, T.ArrayType(T.StringType()))
_names_udf = F.pandas_udf(_names, T.ArrayType(T.StringType()))


def explode_values(df: DataFrame, key: Column, field: Column, *, bare_names: bool = False, least: int = 2) -> DataFrame:
    """Rows ``(rec_key, pos, item)``: one for each value of ``field`` in a record holding at least ``least`` values.

    Positions count from 1, repeats are kept.  Records delivered again (same key and field) count once; records without
    a key or with a null, empty or blank field give no rows; other columns of ``df`` don't matter.  Only the two
    columns used are read and shuffled.
    """
    slim = df.select(key.cast("string").alias("rec_key"), field.cast("string").alias("packed"))
    slim = slim.filter(F.col("rec_key").isNotNull() & F.col("packed").isNotNull() & (F.trim("packed") != "")).distinct()
    split = (_names_udf if bare_names else _split_udf)(F.col("packed"))
    listed = slim.select("rec_key", split.alias("items")).filter(F.size("items") >= least)
    return listed.select("rec_key", F.posexplode("items").alias("at", "item")).select(
        "rec_key", (F.col("at") + 1).cast("bigint").alias("pos"), "item"
    )
