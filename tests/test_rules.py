"""The rules of the filters, stated again in plain Python."""

import re

import pytest
from pyspark.sql import functions as F

from quillsieve.functions import text as X

ANSWERS = [
    "必须立即就医，不要拖延。",
    "建议您尽快去医院做检查。",
    "请务必立即前往急诊处理",
    "这种情况请咨询专业医生",
    "本回答无法替代医师面诊",
    "以下内容仅供参考,不能替代面诊。",
    "先清淡饮食。再看情况，请咨询专业医生",
    "建议\n您尽快就医",
    "药" * 299 + "建议尽快就医",
    "药" * 292 + "建议尽快就医",
    "<think>请咨询专业医生</think>\n\n先复查血糖。",
    "<think>先看</think>  这里请咨询专业医生",
    "",
]


def _column(spark, values, column):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, t string").select("i", column(F.col("t")).alias("v")).collect()
    return [r.v for r in sorted(rows, key=lambda r: r.i)]


def test_evasive_heads(spark):
    head = re.compile(
        r"必须\s*(?:立即|首先|强调).*?(?:就医|医生|医院|急诊|120)|建议您?\s*(?:立即|尽快)\s*(?:就医|去医院|看医生|联系医生)"
        r"|请务必\s*(?:立即|尽快).*?(?:就医|医生|医院|急诊)|^[^。!]*请咨询专业医[生师]|^[^。!]*无法替代医[生师]|^[^。!]*仅供参考"
    )
    assert _column(spark, ANSWERS, lambda c: X.evades(c, X.EVASIVE_V4)) == [bool(head.search(a[:300])) for a in ANSWERS]
    final = [a.partition("</think>")[2].lstrip() if "</think>" in a else a for a in ANSWERS]
    assert _column(spark, ANSWERS, X.final_part) == final
    near = re.compile(
        r"^[^。!]{0,30}?(?:请务必\s*(?:立即|尽快)\s*(?:就医|去医院|看医生|联系医生|咨询医生)|建议您?\s*(?:立即|尽快)\s*(?:就医|去医院|看医生|咨询医生|联系医生)"
        r"|请咨询专业医[生师]|无法替代医[生师]|仅供参考,不能替代)"
    )
    assert _column(spark, ANSWERS, lambda c: X.evades(X.final_part(c), X.EVASIVE_V6)) == [bool(near.search(f[:300])) for f in final]


@pytest.mark.parametrize(
    "answer, choice, marked",
    [
        ("答案：B", "B", True),
        ("答案 ： c，理由如下", "C", True),
        ("答案：A。更正：答案:d", "D", True),
        ("选b", "B", False),
        ("A" + "药" * 200, None, False),
        ("答案：E", None, False),
        ("", None, False),
    ],
)
def test_choices(spark, answer, choice, marked):
    found = re.findall(r"答案\s*[:：]\s*([A-Da-d])", answer) or re.findall(r"[A-Da-d]", answer[-120:])
    assert (found[-1].upper() if found else None) == choice
    said, is_marked = X.choice_of(F.col("t"))
    row = spark.createDataFrame([(answer,)], "t string").select(said.alias("said"), is_marked.alias("marked")).first()
    assert (row.said, row.marked) == (choice, marked)


def test_clean_field(spark):
    def plain(text):
        text = re.sub(r"\n+", "\n", re.sub(r"[ \t\r\f\v]+", " ", text.replace("\u3000", " "))).strip().replace("\n", "")
        return re.sub(r"\s+", " ", text).strip(" ：:；;，,")

    values = ["：主治\u3000头痛，\n咳嗽；", "  a \t b\n\nc ,", "，；", "", "清热 \n 解毒"]
    assert _column(spark, values, X.clean_field) == [plain(v) for v in values]


def test_noise(spark):
    lazy = re.compile(r"^(很抱歉|抱歉|很不好意思).{0,30}(无法|没有提供|没有提到|不能).{0,200}$")
    values = ["很抱歉，我无法回答" + "药" * 100, "很抱歉，我无法回答" + "药" * 300, "抱歉" + "药" * 40 + "不能", "抱歉，不能\n" + "药" * 99, "药" * 90, "我是一个AI" + "药" * 90]
    found = _column(spark, values, lambda c: c.rlike("(?d)" + X.LAZY) | c.rlike(X.NOISE))
    assert found == [bool(lazy.match(v) or re.search("汉药|东中业|作为人工智能|我是一个AI|我作为AI", v)) for v in values]
