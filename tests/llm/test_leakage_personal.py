import random

from pyspark.sql import functions as F

from quillsieve.llm.leakage import ItemIndex, find_leaks, search, simplified, tokens
from quillsieve.llm.personal import Tagger, checked, cue_spans, find_mentions, plain, redact

CHARS = "证候辨治肝肾脾胃血气阴阳寒热虚实表里痰湿舌脉苔弦滑沉细数迟浮紧"


def _items(rng, count=60):
    return [(f"i{k}", "".join(rng.choice(CHARS) for _ in range(60))) for k in range(count)]


def test_block_max_wand_matches_exhaustive_scores():
    rng = random.Random(1)
    items = [(f"i{k}", "".join(rng.choice(CHARS[:9]) for _ in range(40))) for k in range(120)]
    index = ItemIndex(items, {})
    from quillsieve.llm import leakage

    for _ in range(60):
        terms = rng.sample(range(len(index.keys)), min(len(index.keys), 80))
        scores = [0.0] * len(items)
        for t in terms:
            for item, impact in zip(index.ids[t], index.impacts[t]):
                scores[item] += impact
        wanted = [k for k, s in enumerate(scores) if s >= leakage.THRESHOLD]
        assert sorted(index.retrieve(terms)) == wanted


def test_leaks(spark):
    rng = random.Random(2)
    items = _items(rng)
    noise = lambda n: "".join(rng.choice("今日天晴风和市场街道人来往买卖菜果米面油盐") for _ in range(n))
    whole, text = items[5], items[5][1]
    table = simplified(spark)
    back = {v: chr(k) for k, v in table.items()}
    cases = {
        1: noise(50) + text + noise(50),
        2: noise(200) + "，".join(text[k : k + 7] for k in range(0, 60, 7)),
        3: text[:36] + noise(80),
        4: noise(30) + text[:14] + noise(60),
        5: noise(400),
        6: "".join(back.get(c, c) for c in text),
        7: "　".join(text[k : k + 9] for k in range(0, 60, 9)),
        8: "",
        9: None,
        10: noise(30_000) + text + noise(30_000),
        11: noise(20) + text[:28] + "药" + text[29:] + noise(20),
    }
    docs = spark.createDataFrame(list(cases.items()), "doc_id bigint, text string").withColumn("same", F.lit("clash"))
    asked = spark.createDataFrame([*items, ("none", None), ("short", "短")], "item_id string, text string")
    found = {(r.doc_id, r.item_id) for r in find_leaks(docs, "doc_id", "text", asked).collect()}
    assert found == {(k, whole[0]) for k in (1, 2, 3, 6, 7, 10, 11)}
    assert find_leaks(docs.limit(0), "doc_id", "text", asked).count() == 0
    assert find_leaks(docs, "doc_id", "text", asked.limit(0)).count() == 0
    assert search(ItemIndex(items, {}), "") == [] and tokens("ＡＢ12，中", {}) == tokens("ab 7 中", {})
    assert len(tokens("ＡＢ12，中", {})) == 3 and len(tokens("кожа и дыхание", {})) == 3


def test_long_and_short_items(spark):
    rng = random.Random(4)
    letters = "证候辨治肝肾脾胃血气阴阳寒热虚实表里痰湿舌脉苔弦滑沉细数迟浮紧川芎当归白术茯苓甘草柴胡"
    make = lambda n: "".join(rng.choice(letters) for _ in range(n))
    long, short = make(1500), "血府逐瘀"
    noise = lambda n: "".join(rng.choice("今日天晴风和市场街道人来往买卖菜果米面油盐") for _ in range(n))
    changed = "".join("药" if k % 40 == 7 else c for k, c in enumerate(long))
    cases = {1: noise(90) + long, 2: noise(300) + long[200:1010] + noise(70), 3: long[:500] + noise(300), 4: changed, 5: "用血府逐瘀湯治之", 6: "血府，逐", 7: long[:300] + noise(50) + long[300:600]}
    docs = spark.createDataFrame(list(cases.items()), "doc_id bigint, text string")
    asked = spark.createDataFrame([("long", long), ("short", short)], "item_id string, text string")
    found = {(r.doc_id, r.item_id) for r in find_leaks(docs, "doc_id", "text", asked).collect()}
    assert found == {(1, "long"), (2, "long"), (4, "long"), (5, "short")}


def test_several_indexes_give_the_rows_of_one(spark, monkeypatch):
    from quillsieve.llm import leakage

    rng = random.Random(5)
    items = _items(rng, 90)
    docs = spark.createDataFrame([(k, "市场街道" * 9 + t[: rng.randrange(20, 60)] + "买卖菜果" * 5) for k, (_, t) in enumerate(items)], "doc_id bigint, text string")
    asked = spark.createDataFrame(items, "item_id string, text string")
    once = sorted(find_leaks(docs, "doc_id", "text", asked).collect())
    monkeypatch.setattr(leakage, "INDEX_ITEMS", 25)
    assert once and sorted(find_leaks(docs, "doc_id", "text", asked).collect()) == once


FAMILY, GIVEN = "沈梁霍段阮", "砚荞璟湉骁昶"


def _name(rng):
    return rng.choice(FAMILY) + "".join(rng.choice(GIVEN) for _ in range(rng.choice((1, 2))))


def _document(rng):
    name, phone = _name(rng), "1" + rng.choice("3578") + "".join(rng.choice("0123456789") for _ in range(9))
    mail = f"zx{rng.randrange(1000, 9999)}@post.example.net"
    frames = (
        (f"联系人：{name}，电话{phone}。", [(name, "name"), (phone, "phone")]),
        (f"患者{name}，现住南陌市采薇路{rng.randrange(9, 900)}号，可拨打{phone}。", [(name, "name"), (phone, "phone"), ("南陌市采薇路", "address")]),
        (f"经办人{name}的邮箱是{mail}。", [(name, "name"), (mail, "email")]),
        (f"批准文号：国药准字Z2098{rng.randrange(1000, 9999)}。", []),
        ("处方中柴胡与甘草同用，各9g，徐长卿另煎。", []),
    )
    text, spans = "", []
    for body, own in rng.sample(frames, 3):
        for part, kind in own:
            spans.append((len(text) + body.index(part), kind))
        text += body
    return text, set(spans)


def test_mentions_of_held_out_documents(spark):
    rng = random.Random(3)
    tagger = Tagger().fit([_document(rng)[0] for _ in range(400)])
    hit = said = wanted = 0
    for _ in range(150):
        text, spans = _document(rng)
        found = {(a, k) for a, _, k in tagger.mentions(text)}
        hit, said, wanted = hit + len(found & spans), said + len(found), wanted + len(spans)
    assert hit >= 0.97 * wanted and hit >= 0.97 * said
    text, spans = _document(rng)
    df = spark.createDataFrame([(1, text), (1, text), (2, None), (3, ""), (4, "好" * 100_000)], "doc_id bigint, text string").withColumn("kind", F.lit("clash"))
    rows = find_mentions(df, "doc_id", "text", tagger).collect()
    assert len(rows) == 2 * len(tagger.mentions(text)) and all(text[r.start_pos : r.end_pos] == r.mention for r in rows)
    hidden = {r.doc_id: r.text for r in redact(df, "doc_id", "text", tagger).collect()}
    assert hidden[2] is None and hidden[3] == "" and len(hidden[4]) == 100_000
    assert all(p not in hidden[1] for p in (m for m in (r.mention for r in rows)))
    assert find_mentions(df.limit(0), "doc_id", "text", tagger).count() == 0


def test_forms():
    text = plain("登记表：沈砚／４２９９２１２０１２０３１６６２６１／+86 16037834282，写信至zx1@a.example。")
    kinds = {text[a:b]: k for a, b, k in cue_spans(text)}
    assert kinds == {"沈砚": "name", "429921201203166261": "id_number", "+86 16037834282": "phone", "zx1@a.example": "email"}
    place = "现住澄南省溪岑市长芦路879号22栋411室，"
    assert checked(place, 2, 10, "address", (0, len(place))) == (2, len(place) - 1)
    assert checked("国药准字Z20983591", 4, 13, "phone", (0, 13)) is None


def test_phone_separators_and_forms():
    from quillsieve.llm.personal import ADDRESS_TAIL, IDENTITY, PHONE

    for said in ("209.555.0160", "+1.209.555.0160", "(209).555.0160", "138.1234.5678", "138·1234·5678", "0571.8888.1234", "209–555–0160"):
        text = f"Please call {said}."
        at = text.index(said)
        assert checked(text, at, at + len(said), "phone", (0, len(text))) == (at, at + len(said)), said
        assert (at, at + len(said), "phone") in cue_spans(text), said
    for other in ("0.13812345678", "1.209.555.0160", "209.555.0160.5", "v192.168.10.24"):
        assert not PHONE.search(other), other
    for form, said in ((ADDRESS_TAIL, "柳荫胡同5号"), (ADDRESS_TAIL, "安居家园3-2"), (ADDRESS_TAIL, "和平公寓7栋"), (ADDRESS_TAIL, "青山镇柳树村8号"), (ADDRESS_TAIL, "青山镇柳树村"), (IDENTITY, "123-45-6789")):
        assert form.search(said), said


def test_western_names():
    from quillsieve.llm.personal import WESTERN_NAME

    for said in ("José García", "Anne-Marie Dupont", "Ludwig van Beethoven", "J. Müller", "María de la Cruz", "Tessin, Orla"):
        assert checked(said, 0, len(said), "name", (0, len(said))) == (0, len(said)), said
    assert not WESTERN_NAME.fullmatch("the dose")


def test_sentences_left_out_of_the_chains_hold_no_mention():
    import numpy as np

    from quillsieve.llm.personal import _Tokens

    rng = random.Random(8)
    tagger = Tagger().fit([_document(rng)[0] for _ in range(300)])
    tokens = _Tokens([_document(rng)[0] + "今日天晴，风和日丽。街道 12 号市场！" for _ in range(200)])
    rows = tagger._features(tokens)
    unary = tagger._unary(rows)
    none = np.zeros(len(tokens.real), dtype=np.float32)
    first = tagger._first_bound(tokens, rows, none)
    second = tagger._second_bound(tokens, np.ones(len(first), dtype=bool), unary, none)
    labels = tagger._best(unary, tokens.sentence_begin, tokens.sentence_size)
    holds = np.maximum.reduceat(labels > 0, tokens.sentence_begin - 2)
    assert holds.any() and not (holds & ~first).any() and not (holds & ~second).any() and second.mean() < 0.9


def test_cue_words_are_in_every_text_with_a_cue():
    from quillsieve.llm.personal import CUE_WORDS, CUES, cued_names

    texts = ["收件人：沈砚荞。", "儿子叫沈砚，", "13800000000找沈砚。", "负责人沈砚 ", "（沈砚收）", "Patient, Orla Tessin.", "Kontakt: Orla Tessin.", "Parcel for Orla Tessin,", "連絡先：Orla Tessin。", "J. Tessin told us."]
    texts += [f"{label}：沈砚，" for label in ("户主", "备注", "签名")] + ["her sister Orla Tessin can call", "Name: Orla Tessin.", "belongs to Orla Tessin."]
    for text in texts:
        assert cued_names(text), text
        import re

        for cue, words in zip(CUES, CUE_WORDS):
            assert not re.search(cue, text) or any(w in text for w in words), text


def test_names_are_counted_over_all_texts(spark):
    from quillsieve.llm.personal import name_statistics

    rows = [(k, f"联系人：{_name(random.Random(k))}，电话13800000000。") for k in range(300)] + [(1000, None), (1001, "")]
    found = name_statistics(spark.createDataFrame(rows, "doc_id bigint, text string"), "text")
    assert set(found.loc[found["what"] == "family", "part"]) == set(FAMILY) and set(found.loc[found["what"] == "given", "part"]) == set(GIVEN)


def test_nothing_to_fit_and_nothing_to_look_for(spark):
    from quillsieve.llm.personal import fit_tagger

    docs = spark.createDataFrame([(1, None), (2, ""), (3, "你好 José 13800000000"), (4, "用血府逐瘀汤")], "doc_id int, text string")
    for df in (docs.limit(0), docs.filter("doc_id < 3")):
        tagger = fit_tagger(df, "text")
        assert find_mentions(docs, "doc_id", "text", tagger).count() == 0 and redact(docs, "doc_id", "text", tagger).count() == 4
    items = spark.createDataFrame([("a", "血府逐瘀汤"), ("b", None), ("c", ""), ("d", "，，")], "item_id string, text string")
    assert [(r.doc_id, r.item_id) for r in find_leaks(docs, "doc_id", "text", items).collect()] == [(4, "a")]
    assert find_leaks(docs, "doc_id", "text", items.filter("item_id > 'a'")).count() == 0
