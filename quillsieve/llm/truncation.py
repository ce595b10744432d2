"""Texts that break off before their end.

Two kinds of evidence are combined.  *Lengths*: the length of each text is computed as it would be under several storage
encodings (characters, UTF-8 bytes, UTF-16 units, GB18030 bytes, with entities escaped, quotes too or not, JSON-escaped, JSON-escaped
to ASCII, with CR LF line ends); where the texts of a source pile up at the largest value under one of them, that value is a
hidden limit, and unfinished texts at it were cut there.  *Endings*: the end of each text is inspected for characters cut in
half, open tags, entities and brackets, marks that stand for missing text, and clauses without a stop.  Finished texts
without a stop are known from the corpus itself: question tails from texts that do end in a stop, closing lines from how
often a line ends a text against how often it is the beginning of a longer line.

All of it is DataFrame expressions; no Python touches the texts.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillsieve.session import cut_lineage

# Endings, in the regular expressions of the JVM.
STOP = r"[。！？?!．｡؟।]|(?<![.…])\."
CLOSERS = r"[\"'”’」』》〉】）)\]}*_`~|\s\p{Z}]*"
FINISHED = rf"(?:{STOP}){CLOSERS}$"
MISSING = r"(?:…|\.{2,}|。{2,}|⋯|\[\s*(?:truncated|cut|more)\s*\]|[（(](?:未完|待续|下略|略|续)[^）)]*[）)]|未完待续)[\s\p{Z}]*$"
BROKEN = r"(?:\x{FFFD}|&[A-Za-z#0-9]{0,8}|</?[A-Za-z]*|\\u?[0-9A-Fa-f]{0,4}|%[0-9A-Fa-f]?)$"
DANGLING = r"[，,、；;：:（(\[【{《〈“‘「『<&\-—–/\\=+×~][\s\p{Z}]*$"
DIGIT_STOP = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}][0-9]+\.$"
OPTION = r"^[\p{L} ]{1,12}[:：]\s*[A-Ha-h](?:[、,， ]?[A-H])*$"
UNIT = r"(?:\d|[一二三四五六七八九十半两])\s*(?:g|克|mg|毫克|ml|毫升|片|粒|枚|钱|两|丸|次|天|日|分钟|小时|%|％|℃|度|岁|周|年|月|个月)$"
LISTED = r"^\s*(?:[-*•·]|\d{1,2}[.、．)）])\s*\S"
LABELLED = r"^[\p{L}]{1,6}[:：]\s*[^。！？]+$"
PLACEHOLDER = r"^(?i:[\s\p{Z}\p{P}\p{S}]*(?:null|none|nil|n/?a|nan|undefined|tbd|todo|无|暂无|空|略|待补充|没有)?[\s\p{Z}\p{P}\p{S}]*)$"
HEADING = r"^[\s\p{Z}\p{P}\p{S}]*(?i:答|回答|答案|解答|回复|答复|解析|正文|answer|response|reply|antwort|réponse|respuesta|回答文|답|답변|답안|解答例)[\s\p{Z}\p{P}\p{S}]*$"

#: Fewest texts at the largest length, and how many times their share of the lengths before it, that make a limit.
LIMIT_TEXTS = 5
LIMIT_FACTOR = 8
#: Lengths looked at below the largest one.
LIMIT_WINDOW = 40
#: Records that a line must end to be known as a closing line, and its fewest characters.
CLOSES, CLOSING_SIZE = 3, 3
#: Lengths of the beginnings that closing lines and longer lines are joined on.
BEGINNINGS = (CLOSING_SIZE, 6, 12, 24, 48, 96, 192)


def _count(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


@lru_cache(maxsize=1)
def _two_bytes() -> str:
    """A character class of what GB18030 writes in two bytes."""
    wide = [code for code in range(0x80, 0x10000) if not 0xD800 <= code < 0xE000 and len(chr(code).encode("gb18030")) == 2]
    starts = [c for c, before in zip(wide, [0, *wide]) if c != before + 1]
    ends = [c for c, after in zip(wide, [*wide[1:], 0]) if c != after - 1]
    return "[" + "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in zip(starts, ends)) + "]+"


def encoded_lengths(text: Column) -> dict[str, Column]:
    """The length of a text under each encoding, the plainest first."""
    size, octets = F.length(text), F.octet_length(text)
    wide = _count(text, "&") * 4 + _count(text, "<>") * 3
    escaped = _count(text, '"\\\n\r\t')
    ascii_only = F.length(F.regexp_replace(text, r"[^\x00-\x7F]+", ""))
    lines = _count(text, "\n")
    quotes = _count(text, '"') * 5 + _count(text, "'") * 4
    rare = F.regexp_replace(text, r"[\x00-\x7F\x{4E00}-\x{9FA5}\x{3001}\x{3002}\x{FF01}-\x{FF5E}]+", "")
    four = F.length(F.regexp_replace(rare, _two_bytes(), ""))
    return {
        "characters": size,
        "utf8_bytes": octets,
        "utf16_units": size + F.length(F.regexp_replace(text, r"[^\x{10000}-\x{10FFFF}]+", "")),
        "gb18030_bytes": ascii_only + (size - ascii_only) * 2 + four * 2,
        "entity_characters": size + wide,
        "entity_bytes": octets + wide,
        "json_characters": size + escaped,
        "json_ascii": ascii_only + escaped + (size - ascii_only) * 6,
        "crlf_characters": size + lines,
        "crlf_bytes": octets + lines,
        "entity_quoted_characters": size + wide + quotes,
        "entity_quoted_bytes": octets + wide + quotes,
    }


def _last_line(trimmed: Column) -> Column:
    return F.substring_index(trimmed, "\n", -1)


def _with_tail(states: DataFrame) -> DataFrame:
    """Adds ``tail``: the end of a text behind all stops and closing marks, digits as 0: four characters, or eight in Latin script.

    Only where it is asked for: in open texts and in questions that end in a stop.  Every step is a column of its own, so
    it is computed once.
    """
    marks = r"[\p{P}\p{S}\s\p{Z}]+$"
    asked = (F.col("ending") == "open") | ((F.col("ending") == "stop") & (F.col("role") == "user"))
    near = F.when(asked, F.regexp_replace(F.right("trimmed", F.lit(24)), marks, ""))
    bare = F.when(F.length("_near") >= 8, F.col("_near")).when(asked, F.regexp_replace("trimmed", marks, ""))
    out = states.withColumn("_near", near).withColumn("_bare", bare)
    out = out.withColumn("_bare", F.right(F.lower(F.regexp_replace(F.right("_bare", F.lit(8)), r"\d", "0")), F.lit(8)))
    latin = F.right("_bare", F.lit(1)).rlike("[A-Za-zÀ-ÿ]")
    return out.withColumn("tail", F.when(latin, F.col("_bare")).otherwise(F.right("_bare", F.lit(4)))).drop("_near", "_bare")


def _end(trimmed: Column) -> Column:
    """The end of a text as far as endings can reach: more than 48 characters only for closing marks or a bracket that opened earlier."""
    near = F.right(trimmed, F.lit(48))
    further = near.rlike(f"^{CLOSERS}$") | (near.rlike(r"[）)\]]$") & ~near.rlike(r"[（(\[]"))
    return F.when(further, trimmed).otherwise(near)


def inspected(texts: DataFrame) -> DataFrame:
    """What is known of each text by itself: the text without blanks behind it, its ending, tail and last line."""
    blank = r"[\s\p{Z}]"
    trimmed = F.when(F.right("text", F.lit(1)).rlike(blank), F.regexp_replace("text", f"{blank}+$", "")).otherwise(F.col("text"))
    out = texts.withColumn("trimmed", trimmed).filter(F.col("trimmed") != "").withColumn("end", _end(F.col("trimmed")))
    end = F.col("end")
    filled = ~F.col("trimmed").rlike(PLACEHOLDER) & ~F.col("trimmed").rlike(HEADING)
    open_think = (F.instr("trimmed", "<think>") > 0) & (F.instr("trimmed", "</think>") == 0)
    plain_stop = F.right("trimmed", F.lit(2)).rlike(r"^[\p{L}\p{N}][。！？?!]$")  # most texts; the other tests can't overrule it
    cut = end.rlike(MISSING) | end.rlike(BROKEN) | end.rlike(DANGLING) | end.rlike(DIGIT_STOP)
    ending = F.when(~filled, "filled in").when(open_think, "cut").when(plain_stop, "stop").when(cut, "cut").when(end.rlike(FINISHED), "stop")
    out = _with_tail(out.withColumn("ending", ending.otherwise("open")))
    columns = ("tbl", "grp", "role", "rec_key", "turn", "trimmed", "ending", "tail")
    return out.select(*columns, _last_line(F.col("trimmed")).alias("line"), F.contains("trimmed", F.lit("\n")).alias("lines"))


def limits(states: DataFrame) -> DataFrame:
    """Hidden storage limits: rows ``(tbl, grp, role, encoding, size_limit, at_limit)``, one encoding per group.

    Only texts without a stop are measured, since those are what a limit leaves behind; a group has a limit where they
    pile up at the largest length (for byte encodings, within the width of a character below it).
    """
    measured = states.filter(F.col("ending").isin("open", "cut")).withColumn("whole", F.regexp_replace("trimmed", r"\x{FFFD}+$", ""))
    sizes = F.array(*[F.struct(F.lit(k).alias("encoding"), F.lit(at).alias("rank"), v.cast("int").alias("size")) for at, (k, v) in enumerate(encoded_lengths(F.col("whole")).items())])
    counted = measured.select("tbl", "grp", "role", F.explode(sizes).alias("s")).groupBy("tbl", "grp", "role", "s.encoding", "s.rank", "s.size").count()
    group = ["tbl", "grp", "role", "encoding", "rank"]
    largest = counted.withColumn("top", F.max("size").over(Window.partitionBy(*group)))
    width = F.when(F.col("encoding").endswith("bytes"), 3).otherwise(1)
    near = F.col("size") > F.col("top") - width
    piled = largest.groupBy(*group, "top").agg(
        F.sum(F.when(near, F.col("count")).otherwise(0)).alias("at_limit"),
        F.sum(F.when(~near & (F.col("size") > F.col("top") - LIMIT_WINDOW), F.col("count")).otherwise(0)).alias("below"),
    )
    piled = piled.filter((F.col("at_limit") >= LIMIT_TEXTS) & (F.col("at_limit") * LIMIT_WINDOW >= LIMIT_FACTOR * F.col("below") * width))
    best = F.row_number().over(Window.partitionBy("tbl", "grp", "role").orderBy(F.desc("at_limit"), "rank"))
    return piled.withColumn("_best", best).filter("_best = 1").select("tbl", "grp", "role", "encoding", F.col("top").alias("size_limit"), "at_limit")


def _masked(text: Column) -> Column:
    return F.translate(text, "0123456789", "0000000000")


def closing_lines(states: DataFrame) -> DataFrame:
    """Rows ``(_line, _closed)``: last lines, digits as 0, that are known to end a text without a stop, and their records.

    A line that was cut is the beginning of longer lines far more often than it ends a text, however many texts there
    are, so a closing line ends at least half as many records as have a longer line that begins with it.  Records
    delivered again count once.
    """
    record = F.xxhash64("tbl", "rec_key", "turn")
    last = states.filter((F.col("ending") == "open") & F.col("lines")).select(_masked(_last_line(F.col("trimmed"))).alias("_line"), record.alias("_record"))
    ends = last.filter(F.length("_line") >= CLOSING_SIZE).groupBy("_line").agg(F.count_distinct("_record").alias("_closed"))
    ends = cut_lineage(ends.filter(F.col("_closed") >= CLOSES))  # a small table of known size
    known = [F.when(F.length("_line") >= n, F.left("_line", F.lit(n))) for n in BEGINNINGS]
    keyed = ends.withColumn("_key", F.coalesce(*reversed(known)))
    lines = states.select(record.alias("_record"), F.explode(F.split("trimmed", "\n")).alias("_text"))
    heads = ends.select(F.left("_line", F.lit(CLOSING_SIZE)).alias("_head")).distinct()
    lines = lines.join(heads, _masked(F.left("_text", F.lit(CLOSING_SIZE))) == F.col("_head"), "left_semi")
    lines = lines.withColumn("_text", _masked(F.regexp_replace("_text", r"[\s\p{Z}]+$", "")))
    keys = F.array_distinct(F.array(*[F.left("_text", F.lit(n)) for n in BEGINNINGS]))
    longer = lines.select("_record", "_text", F.explode(keys).alias("_key")).join(keyed.select("_key", "_line"), "_key")
    longer = longer.filter(F.startswith("_text", F.col("_line")) & (F.length("_text") > F.length("_line")))
    begun = longer.groupBy("_line").agg(F.count_distinct("_record").alias("_begun"))
    return ends.join(begun, "_line", "left").filter(F.col("_closed") * 2 >= F.coalesce("_begun", F.lit(0))).select("_line", "_closed")


def judge(texts: DataFrame) -> DataFrame:
    """Rows ``(tbl, grp, role, rec_key, turn, evidence)`` of the texts that break off.

    ``texts``: ``(tbl, grp, role, rec_key, turn, text)``.  Null, blank and placeholder texts never break off; rows
    delivered twice come out twice.  Evidence is ``mark`` (something torn or a mark for missing text), ``limit`` (at a
    hidden limit without a stop) or ``clause`` (no stop, and nothing that is known to end a text).
    """
    states = cut_lineage(inspected(texts))
    open_ = states.filter(F.col("ending") == "open")
    tails = states.filter((F.col("ending") == "stop") & (F.col("role") == "user")).groupBy("tail").agg(F.count("*").alias("_asked"))
    closing = cut_lineage(closing_lines(states))
    ends_so = _masked(_last_line(F.col("trimmed"))) == F.col("_line")
    known = open_.join(tails, "tail", "left").join(closing, ends_so, "left")
    # closing lines alone make no limit, but a limit that others show holds for them too
    found = limits(states.filter(F.col("ending").isin("open", "cut")).join(closing, ends_so, "left_anti"))
    sizes = encoded_lengths(F.col("trimmed"))
    size = F.coalesce(*[F.when(F.col("encoding") == k, v) for k, v in sizes.items()])
    known = known.join(found, ["tbl", "grp", "role"], "left").withColumn("at", size >= F.col("size_limit"))
    before = F.regexp_extract("trimmed", r"([^\n]*)\n+[^\n]*$", 1)
    listed = F.col("lines") & F.col("line").rlike(LISTED) & ~(before.rlike(LISTED) & before.rlike(UNIT) & ~F.col("line").rlike(UNIT))
    labelled = F.col("lines") & F.col("line").rlike(LABELLED) & F.col("line").rlike(UNIT)
    closed = F.col("end_char").rlike(r"[）)》】」』”\"}\]>`]")
    # an answer may end like a question where it only repeats one, so not after a statement
    asks = F.col("_asked").isNotNull() & ((F.col("role") == "user") | ~F.contains("trimmed", F.lit("。")))
    complete = listed | labelled | F.col("line").rlike(OPTION) | closed | asks | F.col("_closed").isNotNull()
    known = known.withColumn("end_char", F.right("trimmed", F.lit(1)))
    evidence = F.when(F.coalesce(F.col("at"), F.lit(False)) & ~closed, "limit").when(~complete, "clause")
    columns = ("tbl", "grp", "role", "rec_key", "turn")
    judged = known.select(*columns, evidence.alias("evidence")).filter(F.col("evidence").isNotNull())
    torn = states.filter(F.col("ending") == "cut").select(*columns, F.lit("mark").alias("evidence"))
    return torn.unionByName(judged)
