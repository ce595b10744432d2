import random

import pytest
from pyspark.sql import functions as F

from quillsieve.llm import pairs as pairs_module
from quillsieve.llm.language import LanguageModel, segment_languages
from quillsieve.llm.pairs import common_length, defects, is_copy, is_refusal
from quillsieve.llm.truncation import encoded_lengths, inspected, judge, limits

SCHEMA = "tbl string, grp string, role string, rec_key string, turn bigint, text string"
ENDS = {
    "服药期间应先停用，再联系医师调整。": False,
    "服药期间应先停用，再联系医": True,
    "服药期间应先停用，": True,
    "服药期间应先停用…": True,
    "服药期间应先停用...": True,
    "服药期间应先�": True,
    "服药期间应先&am": True,
    "服药期间应先<b": True,
    "The dose should be reduced and the": True,
    "The dose should be reduced.": False,
    "建议复查。\n1. 柴胡10g\n2. 甘草6g": False,
    "建议复查。\n1. 柴胡10g\n2. 甘": True,
    "建议复查。\n组成：柴胡10g、甘草6g": False,
    "建议复查。\n答案：B": False,
    "建议复查。\n（详见上条）": False,
    "<think>先看主诉": True,
    "<think>先看主诉。</think>": False,
    "N/A": False,
    "...": False,
    "答：": False,
    "   ": False,
    "": False,
    None: False,
}


def _texts(spark):
    rows = [("t", "s", "assistant", f"e{i}", 1, text) for i, text in enumerate(ENDS)]
    rows += [("t", "s", "assistant", f"w{i}", 1, f"第{i}次复查正常。\n祝早日康复") for i in range(6)]
    rows += [("t", "s", "user", f"q{i}", 0, "这个药应该怎么吃？") for i in range(4)] + [("t", "s", "user", "open", 0, "那个药应该怎么吃"), ("t", "s", "user", "cut", 0, "那个药应该怎")]
    return spark.createDataFrame(rows, SCHEMA).withColumn("trimmed", F.lit("clash"))


def test_endings(spark):
    found = {(r.rec_key) for r in judge(_texts(spark)).collect()}
    names = list(ENDS)
    assert {k for k in found if k[0] == "e"} == {f"e{i}" for i, t in enumerate(names) if ENDS[t]}
    assert not any(k[0] == "w" for k in found)
    assert {k for k in found if k in ("open", "cut")} == {"cut"}
    assert judge(_texts(spark).limit(0)).count() == 0


def test_cut_lines_that_recur_are_no_closing_lines(spark):
    rows = [("t", "s", "assistant", f"w{i}", 1, "复查" * i + f"正常。\n（详见苏叶丹条下）\n同时应当复查。\n组成：柴胡。\n祝早日康复") for i in range(40)]
    for k, end in enumerate(("（详见苏叶", "同时", "组", "同时应当")):
        rows += [("t", "s", "assistant", f"cut{k}-{i}", 1, "复查" * i + f"正常。\n{end}") for i in range(6)]
    rows += [("t", "s", "assistant", "cut-again", 1, "复查正常。\n服药期间应先停用再")] * 4
    found = {r.rec_key for r in judge(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found == {f"cut{k}-{i}" for k in range(4) for i in range(6)} | {"cut-again"}


def test_a_limit_outranks_a_closing_line(spark):
    rows = [("t", "free", "assistant", f"w{i}", 1, f"第{i}次复查正常。\n祝早日康复") for i in range(9)]
    rows += [("t", "tight", "assistant", f"c{i}", 1, ("药方剂量复查肝肾" * 9)[i : i + 60]) for i in range(8)]
    rows += [("t", "tight", "assistant", "at", 1, "药" * 53 + "。\n祝早日康复"), ("t", "tight", "assistant", "below", 1, "药" * 40 + "。\n祝早日康复")]
    found = {r.rec_key: r.evidence for r in judge(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found == {f"c{i}": "limit" for i in range(8)} | {"at": "limit"}


@pytest.mark.parametrize("encoding, size", [("characters", 60), ("utf8_bytes", 120), ("entity_characters", 60), ("json_ascii", 150)])
def test_hidden_limits(spark, encoding, size):
    rng = random.Random(3)
    measure = {
        "characters": len,
        "utf8_bytes": lambda t: len(t.encode()),
        "entity_characters": lambda t: len(t) + 4 * t.count("&") + 3 * (t.count("<") + t.count(">")),
        "json_ascii": lambda t: sum(1 if ord(c) < 128 else 6 for c in t) + sum(t.count(c) for c in '"\\\n\r\t'),
    }[encoding]
    rows = []
    for i in range(80):
        text = "".join(rng.choice("药方剂量复查肝肾abc&<\"") for _ in range(90))
        while measure(text) > size:
            text = text[:-1]
        rows.append(("t", "s", "assistant", str(i), 0, text + "。" if i % 9 == 0 and measure(text) < size - 20 else text))
    found = limits(inspected(spark.createDataFrame(rows, SCHEMA))).collect()
    assert [(r.encoding, r.size_limit) for r in found] == [(encoding, size)]


def test_lengths_match_python(spark):
    text = 'a<&>"\\\n中文𠮷'
    row = spark.createDataFrame([(text,)], "t string").select(*[c.alias(k) for k, c in encoded_lengths(F.col("t")).items()]).first().asDict()
    assert row["characters"] == len(text) and row["utf8_bytes"] == len(text.encode()) and row["utf16_units"] == len(text.encode("utf-16-le")) // 2
    assert row["entity_characters"] == len(text) + 10 and row["json_characters"] == len(text) + 3 and row["crlf_bytes"] == len(text.encode()) + 1
    assert row["entity_quoted_characters"] == len(text) + 15


def test_gb18030_lengths_match_python(spark):
    texts = ["中文 abc，。", "한국어 문장", "déjà vu — naïve", "Лекарство", "かな・カナ", "𠮷野家", "β受体①Ⅳ°℃", "㐀㚻"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", encoded_lengths(F.col("t"))["gb18030_bytes"].alias("n")).collect()
    assert {r.t: r.n for r in rows} == {t: len(t.encode("gb18030")) for t in texts}


def test_long_endings(spark):
    closers = "。" + "”）" * 40
    rows = [("t", "s", "assistant", "closed", 1, "药" * 9 + closers), ("t", "s", "assistant", "note", 1, "药方剂量" + "（未完" + "甲" * 90 + "）"), ("t", "s", "assistant", "done", 1, "好。" + "（" + "甲" * 90 + "）。")]
    found = {r.rec_key: r.evidence for r in judge(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found == {"note": "mark"}


def test_common_length_matches_the_table():
    rng = random.Random(4)
    for _ in range(200):
        a, b = ("".join(rng.choice("abcd") for _ in range(rng.randrange(9))) for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert common_length(a, b) == table[-1][-1]


def test_refusals_and_copies():
    assert is_refusal("很抱歉，我无法回答这个问题，请咨询专业医师。")
    assert is_refusal("I'm sorry, but I can't help with that request.")
    assert not is_refusal("抱歉让您久等了。建议复查肝功能。")
    assert not is_refusal("很抱歉。") and not is_refusal("")
    question = "体检发现乳酸偏低，需要马上处理吗？"
    for answer in (question, "**体检发现乳酸偏低,需要马上处理吗**", "您问的是：" + question, question + "\n" + question):
        assert is_copy(question, answer)
    assert not is_copy(question, "您问的是体检发现乳酸偏低，需要马上处理吗。建议先复查血糖，再看肝功能。")
    assert not is_copy("好", "好")
    assert is_copy(question, question * 20) and is_copy(question, "\n".join([question.replace("偏低", "偏 低")] * 20))
    long = "体检发现乳酸偏低而血糖偏高肝功能又在正常范围近来夜里睡不好白天没精神想知道是否需要马上处理呢"
    assert is_copy(long, long + long.replace("近来", "近日"))
    whole = "很抱歉我无法回答这个问题请咨询专业医师" * 14
    assert len(whole) > 200 and is_refusal(whole) and is_refusal("i'm sorry but i can't help with that request " * 6)
    assert not is_refusal("我无法回答这个问题" * 9 + "不过乳酸偏低多与饮食有关可以先复查血糖再看肝功能是否正常")


def test_defects(spark):
    model = LanguageModel({"zh": ["体检发现乳酸偏低，需要马上处理吗", "建议先复查血糖，再看肝功能是否正常", "服药期间应先停用再联系医师"] * 9, "en": ["The usual dose should be reduced when the symptoms appear together", "A blood test is the better choice"] * 9})
    question = "体检发现乳酸偏低，需要马上处理吗？"
    english = "The usual dose should be reduced when the symptoms appear."
    rows = [
        ("t", "empty", 1, question, "<think>先看主诉。</think>\n"),
        ("t", "null", 1, question, None),
        ("t", "heading", 1, question, "**答案**："),
        ("t", "copy", 1, question, question),
        ("t", "refusal", 1, question, "对不起，我不能提供任何诊疗建议。"),
        ("t", "language", 1, question, english),
        ("t", "asked", 1, "请用英文回答：" + question, english),
        ("t", "foreign", 1, question, "Лекарство принимают после еды, курс две недели."),
        ("t", "copies", 1, question, "\n".join([question] * 20)),
        ("t", "good", 1, question, "建议先复查血糖，再看肝功能。"),
        ("t", "no question", 1, None, "建议先复查血糖。"),
        ("t", "copy", 1, question, question),
    ]
    pairs = spark.createDataFrame(rows, "tbl string, rec_key string, turn bigint, question string, answer string").withColumn("defect", F.lit("clash"))
    cut = spark.createDataFrame([("t", "good", 1)], "tbl string, rec_key string, turn bigint")
    found = sorted((r.rec_key, r.defect) for r in defects(pairs, cut, model).collect())
    assert found == [
        ("copies", "copies_question"),
        ("copy", "copies_question"),
        ("empty", "empty_answer"),
        ("foreign", "other_language"),
        ("good", "truncated_answer"),
        ("heading", "empty_answer"),
        ("language", "other_language"),
        ("null", "empty_answer"),
        ("refusal", "refusal"),
    ]
    assert defects(pairs.limit(0), cut.limit(0), model).count() == 0


class _Counted(LanguageModel):
    scored = 0

    def code_lengths(self, texts):
        self.scored += sum(map(len, texts))
        return super().code_lengths(texts)


def test_early_stops_change_no_defect():
    chinese = ["体检发现乳酸偏低，需要马上处理吗", "建议先复查血糖，再看肝功能是否正常", "服药期间应先停用再联系医师"]
    english = ["The usual dose should be reduced when the symptoms appear together", "A blood test is the better choice"]
    model = _Counted({"zh": chinese * 9, "en": english * 9})
    rng = random.Random(5)
    pairs = [(rng.choice(english) + "?", " ".join(rng.choice(english) + f" {i} {k}." for k in range(12))) for i in range(60)]
    for first in (english, chinese, ["ok so we do", "药方剂量复查"]):  # the first sentence is, isn't or may be in the question's language
        for rest in (english, chinese):
            for question in (*english, *chinese, "请用英文回答：" + chinese[0], "12?"):
                pairs.append((question, "。\n".join([rng.choice(first), *rng.choices(rest, k=3)])))
    model.scored = 0
    found = pairs_module.other_language(model, pairs)
    scored, model.scored = model.scored, 0
    both = [{s[1] for s in own} for own in segment_languages(model, [t for pair in pairs for t in pair])]
    asked, said = both[::2], both[1::2]
    assert found == [bool(a and s and not a & s and pairs_module._asked_language(q) not in s) for a, s, (q, _) in zip(asked, said, pairs)]
    assert 0 < sum(found) < len(found) / 2 and scored < model.scored / 3

    for size in (3, 9, 40, 300):
        for _ in range(60):
            question = "".join(rng.choice("药方剂量复查肝肾") for _ in range(rng.randrange(1, size)))
            answer = list(question * rng.randrange(1, 4))
            for _ in range(rng.randrange(3)):
                answer.insert(rng.randrange(len(answer) + 1), "新")
            answer = "".join(answer)
            known = {question[i : i + 3] for i in range(len(question) - 2)}
            have = sum(answer[i : i + 3] in known for i in range(len(answer) - 2))
            seams = 2 * (max(1, round(len(answer) / len(question))) - 1)
            enough = min(len(question), len(answer)) > 3 and have >= 0.9 * (len(answer) - 2 - seams)
            assert pairs_module._enough(question, answer) == enough


def test_script_gates_change_nothing():
    parts = ["药方剂量", "ひら", "カ", "한국", "어", "Лек", "аб", "the dose is", "dose", "the  dose", " ", "。", "ᄀᄀᄀ", "é à ü", "\u3041\uac00"]
    patterns = (("kana", pairs_module.KANA), ("hangul", pairs_module.HANGUL), ("han", pairs_module.HAN), ("latin", pairs_module.LATIN), ("other", pairs_module.OTHER))
    rng = random.Random(6)
    for _ in range(2000):
        text = "".join(rng.choices(parts, k=rng.randrange(1, 6)))
        found = [name for name, pattern in patterns if pattern.search(text)]
        if "kana" in found and "han" in found:
            found.remove("han")
        assert list(pairs_module._scripts(text)) == found, text
