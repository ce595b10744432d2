import random

from pyspark.sql import functions as F

from quillsieve.llm.language import LanguageModel, detect, fit, label_code, segment_languages, sentences
from quillsieve.llm.scans import Editor, fit_editor, repair

WORDS = {
    "en": "the dose should be taken with food and the blood test repeated after two weeks when symptoms return in winter".split(),
    "de": "die dosis wird nach dem essen genommen und der zustand bessert sich nicht wenn treten beschwerden gemeinsam auf".split(),
    "fr": "le traitement est conseillé avant le repas et la dose rend les troubles plus rares quand il faut consulter".split(),
}
ZH = "服药期间若出现头痛应先停用再联系医师调整剂量饮食清淡注意休息定期复查肝功能"


def _sentence(rng, language):
    if language == "zh":
        return "".join(rng.choice(ZH) for _ in range(18)) + "。"
    return " ".join(rng.choice(WORDS[language]) for _ in range(9)).capitalize() + "."


def _samples(seed, count, wrong=0.0):
    rng = random.Random(seed)
    names = [*WORDS, "zh"]
    out = {name: [] for name in names}
    for name in names:
        for _ in range(count):
            out[name].append(_sentence(rng, rng.choice(names) if rng.random() < wrong else name))
    return out


def test_held_out_accuracy_with_wrong_labels():
    train = _samples(1, 300, wrong=0.15)
    model = fit(train, {k: len(v) for k, v in train.items()})
    test = _samples(2, 100)
    for name, own in test.items():
        said, sure, _ = model.classify(own)
        assert sum(s == name for s in said) >= 98
        assert min(sure) >= 1 / len(test)


def test_code_length_is_a_sum_over_bytes():
    model = LanguageModel(_samples(3, 50))
    long, short = model.code_lengths(["the dose " * 40_000, ""])
    assert (long > 0).all() and (short == 0).all()
    assert model.classify([])[0] == []


def test_mixed_texts():
    model = LanguageModel(_samples(4, 200))
    rng = random.Random(5)
    text = _sentence(rng, "zh") + " " + _sentence(rng, "en") + "\n" + _sentence(rng, "en") + _sentence(rng, "zh")
    assert [s[1] for s in segment_languages(model, [text])[0]] == ["zh", "en", "zh"]
    assert segment_languages(model, ["", "N/A", "——", None]) == [[], [], [], []]
    assert [s[1] for s in segment_languages(model, [ZH + "（Radix Bupleuri）" + ZH + "。"])[0]] == ["zh"]
    assert sentences("约2.5mg。好") == ["约2.5mg。", "好"]


def test_other_scripts_are_unknown():
    model = LanguageModel(_samples(4, 100))
    for text in ("Лекарство принимают после еды, курс две недели.", "Το φάρμακο λαμβάνεται μετά το φαγητό.", "يؤخذ الدواء بعد الطعام لمدة أسبوعين", "ควรรับประทานยาหลังอาหารทุกวัน"):
        assert [(s[1], s[2]) for s in segment_languages(model, [text])[0]] == [("unknown", 0.0)], text
    assert [s[1] for s in segment_languages(model, [ZH + "（β受体）" + ZH])[0]] == ["zh"]
    rng = random.Random(6)
    russian = ["принимать лекарство следует после еды дважды в день " * 2 for _ in range(60)]
    wider = LanguageModel({**_samples(4, 100), "ru": russian})
    assert [s[1] for s in segment_languages(wider, ["Принимать дважды в день после еды. " + _sentence(rng, "en")])[0]] == ["ru", "en"]


def test_detect(spark):
    model = LanguageModel(_samples(6, 100))
    df = spark.createDataFrame([(1, "The dose should be taken with food."), (2, None), (3, " "), (1, "The dose should be taken with food.")], "id int, text string").withColumn("language", F.lit("clash"))
    rows = detect(df, ["id"], "text", model).collect()
    assert [(r.id, r.language) for r in rows] == [(1, "en"), (1, "en")]
    assert detect(df.limit(0), ["id"], "text", model).count() == 0
    labels = spark.createDataFrame([("zh-CN",), ("EN",), ("und",), ("",), (None,)], "l string").select(label_code(F.col("l")).alias("c")).collect()
    assert [r.c for r in labels] == ["zh", "en", None, None, None]


HERBS = ["柴胡", "甘草", "桔梗", "人参", "川芎", "茯苓", "枳壳", "前胡", "羌活", "独活", "白术", "当归", "熟地黄", "牡丹皮"]
SIGNS = ["头痛", "咳嗽", "腹胀", "失眠", "心悸", "口苦"]


def test_many_running_heads_are_known():
    """No cap on the number of heads, and a head on one page in three hundred is one."""
    rng = random.Random(17)
    strange = [chr(c) for c in range(0x8C00, 0x8F00)]
    heads = ["".join(rng.sample(strange, 3)) + "·" + "".join(rng.sample(strange, 3)) for _ in range(100)]
    typed = [_typed(rng) for _ in range(300)]
    pages = []
    for k in range(900):
        text = _typed(rng)
        at = rng.randrange(2, len(text) - 2)
        pages.append(f"{text[:at]}\n{heads[k % 100]}\n{text[at:]}")
    editor = Editor().fit(typed, pages)
    assert set(editor.heads) == set(heads)
    found = editor.repair_all(pages)
    assert sum("running_head" in noise for _, noise in found) >= 0.95 * len(pages)


def test_statistics_in_spark_are_those_without(spark):
    rng = random.Random(19)
    typed, pages = [_typed(rng) for _ in range(200)], [_scan(rng, _typed(rng))[0] for _ in range(200)]
    rows = [(t, False) for t in typed] + [(t, True) for t in pages] + [(None, True), ("", False)]
    df = spark.createDataFrame(rows, "text string, scanned boolean").repartition(7)
    a, b = fit_editor(df, "text", F.col("scanned")), Editor().fit(typed, pages)
    assert a.confusions == b.confusions and a.heads == b.heads and (a.typed.keys == b.typed.keys).all()
    assert sum(x == y for x, y in zip(a.repair_all(pages), b.repair_all(pages))) >= 0.97 * len(pages)


def _typed(rng):
    if rng.random() < 0.5:
        return "、".join(f"{rng.choice(HERBS)}{rng.choice((3, 6, 9, 12))}g" for _ in range(rng.randrange(2, 7)))
    return f"主治{rng.choice(SIGNS)}、{rng.choice(SIGNS)}日久不愈（附方另见第{rng.randrange(2, 60)}页），舌苔薄白，脉弦细。"


def _scan(rng, text):
    kinds, out = set(), text
    spot = rng.randrange(2, len(out) - 2)
    choice = rng.random()
    if choice < 0.25:
        out, kinds = out[:spot] + "\n方药汇览　卷三\n" + out[spot:], {"running_head"}
    elif choice < 0.5:
        out, kinds = out[:spot] + f"\n{rng.randrange(100, 600)}\n" + out[spot:], {"page_no"}
    elif choice < 0.7 and "苔" in out:
        out, kinds = out.replace("舌苔", "舌若"), {"misread"}
    elif choice < 0.9:
        at = next((i for i in range(spot, len(out) - 1) if "㐀" <= out[i] <= "鿿" and "㐀" <= out[i - 1] <= "鿿"), None)
        if at:
            out, kinds = out[:at] + "\n" + out[at:], {"broken_line"}
    return out, kinds


def test_scans_are_repaired(spark):
    rng = random.Random(7)
    typed = [_typed(rng) for _ in range(400)]
    editor = Editor().fit(typed, [_scan(rng, _typed(rng))[0] for _ in range(400)])
    right = repaired = 0
    for _ in range(200):
        clean = _typed(rng)
        dirty, kinds = _scan(rng, clean)
        text, found = editor.repair(dirty)
        right += set(found) == kinds
        repaired += text == clean
    assert right >= 180 and repaired >= 180
    assert editor.repair("") == ("", [])
    df = spark.createDataFrame([("1", typed[0]), ("1", typed[0]), ("2", None), ("3", ""), ("4", typed[1] * 300)], "k string, text string").withColumn("noise", F.lit("clash"))
    rows = repair(df, ["k"], editor).collect()
    assert sorted(r.k for r in rows) == ["1", "1", "3", "4"]
    assert repair(df.limit(0), ["k"], editor).count() == 0


def test_scans_without_typed_texts(spark):
    df = spark.createDataFrame([("甘草9g、白术", True), (None, False), ("", True)], "text string, scanned boolean").withColumn("k", F.lit(1))
    for own in (df, df.limit(0)):
        rows = repair(own.filter("scanned"), ["k"], fit_editor(own, "text", F.col("scanned"))).collect()
        assert sorted(r.repaired for r in rows) == (["", "甘草9g、白术"] if rows else [])
