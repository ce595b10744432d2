"""Text expressions that stay in the JVM: trimming, script ratios, reasoning blocks, endings, HTML, sentences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and character classes of the curation rules.
SPACE = r"[\s\p{Z}\x{1c}-\x{1f}\x{85}]"
CJK = r"[\x{4e00}-\x{9fff}]"
ALNUM = r"[\p{L}\p{N}]"
LATIN = r"[A-Za-z]"
THINK_CLOSED = r"(?s)<think>.*?</think>"
THINK_OPEN = r"(?s)<think>.*"
# Answers that evade, looked for in the first 300 characters of an answer, or of its final part.
EVASIVE_V4 = "|".join(
    (
        r"必须\s*(?:立即|首先|强调).*?(?:就医|医生|医院|急诊|120)",
        r"建议您?\s*(?:立即|尽快)\s*(?:就医|去医院|看医生|联系医生)",
        r"请务必\s*(?:立即|尽快).*?(?:就医|医生|医院|急诊)",
        r"^[^。!]*请咨询专业医[生师]",
        r"^[^。!]*无法替代医[生师]",
        r"^[^。!]*仅供参考",
    )
)
EVASIVE_V6 = "|".join(
    (
        r"^[^。!]{0,30}?请务必\s*(?:立即|尽快)\s*(?:就医|去医院|看医生|联系医生|咨询医生)",
        r"^[^。!]{0,30}?建议您?\s*(?:立即|尽快)\s*(?:就医|去医院|看医生|咨询医生|联系医生)",
        r"^[^。!]{0,30}?请咨询专业医[生师]",
        r"^[^。!]{0,30}?无法替代医[生师]",
        r"^[^。!]{0,30}?仅供参考,不能替代",
    )
)
HEAD = 300
# Urgent topics.
ACUTE = (
    "儿科|婴|幼儿|新生|孕|妊娠|产|急救|抢救|急诊|中毒|误服|误吞|急性|昏迷|休克|惊厥|抽搐|窒息|溺水|骨折|大出血|烫伤|烧伤|触电|中暑|心梗|脑卒|癫痫"
)
# Noise, lazy refusals and the fewest characters of a text.
NOISE = "汉药|东中业|作为人工智能|我是一个AI|我作为AI"
LAZY = r"^(?:很抱歉|抱歉|很不好意思).{0,30}(?:无法|没有提供|没有提到|不能).{0,200}\n?$"
NOISE_SIZE = 80
# Characters that a prompt of each category must have at least and at most.
PROMPT_SIZES = {"mcq_gen": (60, 800), "acute": (30, 260), "tcm": (20, 240), "short": (8, 130)}
# Answer markers, as they were first written and as they were meant; the choice they mark; formula names.
MARKER, MARKER_FIXED = r"答案[::是为]|Answer[:：]", r"答案[:：是为]|Answer[:：]"
CHOICE, CHOICE_ALONE, CHOICE_TAIL = r"答案[\s\p{Z}]*[:：][\s\p{Z}]*([A-Da-d])", "[A-Da-d]", 120
FORMULA_NAME = r"[\x{4e00}-\x{9fff}]{2,8}(?:汤|散|丸|饮|膏|丹|片|煎|方)"
LATIN_PHRASE = r"[A-Za-z]{2,}(?: [A-Za-z]{2,}){2,}"


def py_strip(c: Column) -> Column:
    """Both ends without Unicode white space; null stays null."""
    return F.regexp_replace(c, f"^{SPACE}+|{SPACE}+$", "")


def matches(c: Column, pattern: str) -> Column:
    """How many characters match a one-character pattern."""
    return F.length(c) - F.length(F.regexp_replace(c, pattern, ""))


def latin_ratio(c: Column) -> Column:
    """Latin letters over Latin letters and CJK characters; 0 where there are neither."""
    latin, cjk = matches(c, LATIN), matches(c, CJK)
    return latin / F.greatest(latin + cjk, F.lit(1))


def cjk_ratio_alnum(c: Column) -> Column:
    """CJK characters over letters and numbers; 0 where there are none."""
    return matches(c, CJK) / F.greatest(matches(c, ALNUM), F.lit(1))


def cjk_ratio_all(c: Column) -> Column:
    """CJK characters over all characters; 0 for an empty text."""
    return matches(c, CJK) / F.greatest(F.length(c), F.lit(1))


def approx_tokens(c: Column) -> Column:
    """1.5 tokens for a CJK character and 0.3 for any other, cut to a whole number."""
    cjk = matches(c, CJK)
    return (cjk * 1.5 + (F.length(c) - cjk) * 0.3).cast("int")


def strip_think(c: Column) -> Column:
    """Without closed reasoning blocks and without an unclosed one up to the end."""
    return py_strip(F.regexp_replace(F.regexp_replace(c, THINK_CLOSED, ""), THINK_OPEN, ""))


def split_think(c: Column) -> tuple[Column, Column]:
    """Thinking and answer, split at the first closing tag; without one all is answer."""
    parts = F.split(c, "</think>", 2)
    closed = F.size(parts) > 1
    thinking = F.when(closed, py_strip(F.replace(parts[0], F.lit("<think>"), F.lit("")))).otherwise("")
    return thinking, F.when(closed, py_strip(parts[1])).otherwise(py_strip(c))


def wrap_response(thinking: Column, answer: Column) -> Column:
    """One response of thinking and answer; plain without thinking."""
    has = F.coalesce(py_strip(thinking), F.lit("")) != ""
    return F.when(has, F.concat(F.lit("<think>\n"), thinking, F.lit("\n</think>\n\n"), answer)).otherwise(answer)


def between_tags(c: Column, start: str, ends: list[str]) -> Column:
    """The text between a start tag and the earliest of the end tags after it, or the end; null without the start."""
    first = F.instr(c, start)
    body = F.substring(c, first + len(start), F.length(c))
    places = F.array(*[F.nullif(F.instr(body, e), F.lit(0)) for e in ends])
    stop = F.coalesce(F.array_min(places), F.length(body) + 1)
    return F.when(first > 0, py_strip(F.substring(body, F.lit(1), stop - 1)))


def sentences(c: Column) -> Column:
    """Sentences, each with its stop."""
    return F.filter(F.split(c, r"(?<=[。！？；;])"), lambda s: s != "")


def html_text(c: Column) -> Column:
    """Plain text of HTML: scripts and styles dropped, breaks as blanks, common entities resolved, blanks collapsed."""
    text = F.regexp_replace(c, r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " ")
    text = F.regexp_replace(text, r"(?i)<br\s*/?>", " ")
    text = F.regexp_replace(text, r"<[^>]+>", "")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return py_strip(F.regexp_replace(text, r"[\s\p{Z}]+", " "))


def first_value(*columns: Column) -> Column:
    """The first of several columns that isn't null or blank."""
    return F.coalesce(*[F.nullif(py_strip(c.cast("string")), F.lit("")) for c in columns])


def final_part(c: Column) -> Column:
    """What follows the first closing tag and the white space behind it; all of it without one."""
    return F.regexp_replace(c, r"(?s)^.*?</think>\s*", "")


def evades(c: Column, pattern: str) -> Column:
    """Whether the head of an answer evades."""
    return F.left(c, F.lit(HEAD)).rlike("(?d)" + pattern)


def choice_of(c: Column) -> tuple[Column, Column]:
    """The last marked choice of an answer, else the last letter near its end, in upper case; and whether it is marked."""
    marked = F.try_element_at(F.regexp_extract_all(c, F.lit(CHOICE), 1), F.lit(-1))
    alone = F.try_element_at(F.regexp_extract_all(F.right(c, F.lit(CHOICE_TAIL)), F.lit(CHOICE_ALONE), 0), F.lit(-1))
    return F.upper(F.coalesce(marked, alone)), marked.isNotNull()


def clean_field(c: Column) -> Column:
    """One line: blanks collapsed, line breaks removed, blanks and joining marks stripped from both ends."""
    text = F.regexp_replace(F.translate(c, "\u3000", " "), r"[ \t\r\f\x0b]+", " ")
    text = F.replace(py_strip(text), F.lit("\n"), F.lit(""))
    text = F.regexp_replace(text, r"[\s\p{Z}]+", " ")
    return F.regexp_replace(text, "^[ ：:；;，,]+|[ ：:；;，,]+$", "")
