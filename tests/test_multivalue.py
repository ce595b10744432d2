import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillsieve.operators.multivalue import bare_name, explode_values, split_values


@pytest.mark.parametrize(
    "text, values",
    [
        (None, []),
        ("", []),
        ("　 \n", []),
        ("甲", ["甲"]),
        ("甲、乙，丙;丁|戊／己", list("甲乙丙丁戊己")),
        ("Alpha SR、Beta Forte", ["Alpha SR", "Beta Forte"]),
        ("甲片 乙片 丙片", ["甲片", "乙片", "丙片"]),
        ('甲,"乙,丙",丁', ["甲", "乙,丙", "丁"]),
        ('"甲,""新""乙",丙', ['甲,"新"乙', "丙"]),
        ("「甲；乙」；丙", ["甲；乙", "丙"]),
        ("甲（进口、分装）、乙", ["甲（进口、分装）", "乙"]),
        ('["甲", "乙 b", "丙"]', ["甲", "乙 b", "丙"]),
        ("①甲②乙③丙", ["甲", "乙", "丙"]),
        ("(1)甲；(2)乙；", ["甲", "乙"]),
        ("1.甲 2.乙 3.Alpha SR 4.丁", ["甲", "乙", "Alpha SR", "丁"]),
        ("1、甲\n2、乙", ["甲", "乙"]),
        ("甲//乙，，丙，", ["甲", "乙", "丙"]),
        (r"甲\,乙,丙", ["甲,乙", "丙"]),
        ('甲,"乙,丙', ["甲", "乙,丙"]),
        ("甲（乙、丙", ["甲（乙、丙"]),
        ("O'Neil、Beta", ["O'Neil", "Beta"]),
    ],
)
def test_split_values(text, values):
    assert split_values(text) == values


@pytest.mark.parametrize(
    "value, name",
    [("柴胡12g", "柴胡"), ("甘草（炙） 4.5g", "甘草"), ("柴胡(Radix Bupleuri)半两", "柴胡"), ("大枣一两（各9g）", "大枣"), ("半夏 各4.5g", "半夏"), ("15g", ""), ("柴胡 Radix Bupleuri", "柴胡")],
)
def test_bare_name(value, name):
    assert bare_name(value) == name


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="甲乙丙丁ab1,;、|/ ", min_size=1, max_size=6).filter(lambda s: s.strip()), min_size=1, max_size=6))
def test_quoted_values_come_back(values):
    packed = ",".join('"' + v.replace('"', '""') + '"' for v in values)
    assert split_values(packed) == [v.strip() for v in values]


def test_long_text_is_linear():
    assert len(split_values("甲、" * 200_000)) == 200_000


def test_explode_values(spark):
    rows = [("1", "甲、乙、甲", 1), ("1", "甲、乙、甲", 2), ("2", "甲", 1), (None, "甲、乙", 1), ("3", None, 1), ("4", "  ", 1)]
    df = spark.createDataFrame(rows, "k string, v string, item int")
    found = {(r.rec_key, r.pos, r.item) for r in explode_values(df, F.col("k"), F.col("v")).collect()}
    assert found == {("1", 1, "甲"), ("1", 2, "乙"), ("1", 3, "甲")}
    assert explode_values(df.limit(0), F.col("k"), F.col("v")).count() == 0


def test_only_enclosing_brackets_are_removed():
    assert split_values("[甲、乙]") == ["甲", "乙"] and split_values("［甲、[注]乙］") == ["甲", "[注]乙"]
    assert split_values("[注]甲、乙[外]") == ["[注]甲", "乙[外]"]
