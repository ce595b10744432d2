"""Broken prompt and response pairs.

Five defects: an answer with no content, one that breaks off, a refusal, an answer that only repeats its question, and one
written wholly in another language.  Copies are found by aligning the answer with the question (containment of shingles,
then the longest common subsequence), refusals by aligning each of its clauses with refusal templates; languages by the
byte model of ``language``.  Every pair is examined, each step as far as it can still change the result: shingles until too
many are missing for a copy, clauses until one is no refusal, answers until a sentence is surely in the question's language.
"""

from __future__ import annotations

import re
from collections.abc import Container
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillsieve.llm.language import SURE_BITS, LanguageModel, running_pieces, segment_languages

#: Characters in a shingle, and the containment and common share from which an answer is a copy.
SHINGLE = 3
COPY_CONTAINED = 0.9
COPY_COMMON = 0.9
#: Longest question that is searched for shingles as it is; those of longer ones are put into a set.
SEARCHED = 256
#: Share of a clause that must align with a template.
CLAUSE_COMMON = 0.7

# Clauses that refuse.
REFUSALS = """
我无法回答这个问题|我不能回答这个问题|我不能提供任何诊疗建议|我不能提供医疗建议|恕我不能给出具体用量|恕难从命|恕我直言无法作答
相关信息我没有办法提供|该内容暂时不便讨论|这个话题不便讨论|这一问题超出了我的能力范围|我不具备行医资格|不能作答|无可奉告
我无法提供帮助|我无法满足您的要求|无法为您提供建议|我拒绝回答|我没有资格回答
i can't help with that request|i cannot answer this question|i can't answer that|i won't be able to provide that information
i am not able to give medical advice|as a language model i am not able to give medical advice|i'm unable to assist with that|this falls outside what i'm allowed to discuss|i cannot provide medical advice
no puedo ayudarte con esa consulta|no estoy autorizado a dar consejos médicos|no puedo responder a esa pregunta
zu medizinischen fragen darf ich keine auskunft geben|dabei kann ich nicht helfen|das kann ich nicht beantworten
je ne peux pas répondre à cette question|je ne suis pas en mesure de donner un avis médical
そのご質問にはお答えできません|医療に関する助言はいたしかねます|お手伝いできません
그 질문에는 답변할 수 없습니다|의학적 조언은 제공해 드릴 수 없습니다|도와드릴 수 없습니다
"""
# Clauses that go with a refusal and say nothing.
FILLERS = """
很抱歉|抱歉|对不起|非常抱歉|非常遗憾|很遗憾|感谢您的提问|您好|作为一个语言模型|作为人工智能助手|还望理解|敬请谅解|请咨询专业医师|请换一个话题吧
建议您前往正规机构面诊|建议您咨询医生|请及时就医
i'm sorry|but|sorry|unfortunately|as a language model|as an ai model|please consult a licensed professional|please see a doctor
lo siento|es tut mir leid|leider|je suis désolé|désolé|申し訳ありませんが|申し訳ございません|죄송하지만|죄송합니다
"""
CLAUSE = re.compile(r"[。，,.！!？?；;\n：:]+")
ECHO = re.compile(r"^(?:您问的是|您的问题是|你问的是|问题|提问|您提到|question|q|frage|pregunta|質問|질문)+")
# How a question asks for a language.
ASKED = (
    ("en", r"英[文语語]|in english|auf englisch|en anglais|en inglés|英語|영어"),
    ("zh", r"中[文语]|汉语|in chinese|auf chinesisch|en chinois|en chino|中国語|중국어"),
    ("ja", r"日[文语語]|in japanese|auf japanisch|en japonais|en japonés|日本語|일본어"),
    ("ko", r"韩[文语]|韓[文語]|in korean|auf koreanisch|en coréen|en coreano|韓国語|한국어"),
    ("de", r"德[文语語]|in german|auf deutsch|en allemand|en alemán|ドイツ語|독일어"),
    ("fr", r"法[文语語]|in french|auf französisch|en français|en francés|フランス語|프랑스어"),
    ("es", r"西班牙[文语語]|in spanish|auf spanisch|en espagnol|en español|スペイン語|스페인어"),
)


NO_LETTER = re.compile(r"[\W_]+")


def _bare(text: str) -> str:
    """A text in lower case without anything but letters and digits, whatever the layout."""
    return NO_LETTER.sub("", text.lower())


@lru_cache(maxsize=1)
def _templates() -> tuple[list[tuple[str, set[str]]], list[tuple[str, set[str]]]]:
    def read(block: str) -> list[tuple[str, set[str]]]:
        clauses = [_bare(c) for line in block.split("\n") for c in line.split("|") if c.strip()]
        return [(c, {c[i : i + 2] for i in range(len(c) - 1)} or {c}) for c in clauses]

    return read(REFUSALS), read(FILLERS)


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit-parallel: one integer operation per character of ``b``."""
    masks: dict[str, int] = {}
    for at, char in enumerate(a):
        masks[char] = masks.get(char, 0) | (1 << at)
    full = (1 << len(a)) - 1
    row = full
    for char in b:
        hit = row & masks.get(char, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - bin(row).count("1")


@lru_cache(maxsize=20_000)
def _clause_kind(clause: str) -> str:
    """"refusal", "filler" or "" for a bare clause."""
    pairs = {clause[i : i + 2] for i in range(len(clause) - 1)} or {clause}
    if len(pairs & _template_pairs()[0]) * 2 < len(pairs):
        return ""  # all templates together share too few, so each does
    for kind, templates in zip(("refusal", "filler"), _templates()):
        for template, own in templates:
            if len(pairs & own) * 2 >= len(pairs) and common_length(clause, template) >= CLAUSE_COMMON * len(clause):
                return kind
    return ""


@lru_cache(maxsize=1)
def _template_pairs() -> tuple[frozenset[str], int]:
    """The character pairs of all templates, and the length beyond which a clause can't align with a single one."""
    both = [t for templates in _templates() for t in templates]
    return frozenset(p for _, own in both for p in own), int(max(len(t) for t, _ in both) / CLAUSE_COMMON)


def _clause_kinds(clause: str) -> set[str]:
    """The kinds of a bare clause, which may be several templates without a stop between them; {""} if a part is neither."""
    known, longest = _template_pairs()
    if len(clause) <= longest:
        return {_clause_kind(clause)}
    if sum(clause[i : i + 2] in known for i in range(len(clause) - 1)) < CLAUSE_COMMON / 2 * (len(clause) - 1):
        return {""}
    # places that templates laid one behind the other can reach, and the kinds on the way there
    reached: dict[int, set[str]] = {0: set()}
    for at in range(len(clause)):
        if at not in reached:
            continue
        for kind, templates in zip(("refusal", "filler"), _templates()):
            for template, own in templates:
                part = clause[at : at + len(template)]
                shared = sum(part[i : i + 2] in own for i in range(len(part) - 1))
                if shared * 2 >= len(part) - 1 and common_length(part, template) >= CLAUSE_COMMON * len(part):
                    reached.setdefault(at + len(part), set()).update(reached[at], {kind})
    return reached.get(len(clause), {""})


def is_refusal(answer: str) -> bool:
    """Whether every clause aligns with a refusal or with something said beside one, and at least one refuses."""
    refuses, start = False, 0
    while start < len(answer):
        stop = CLAUSE.search(answer, start)
        bare = _bare(answer[start : stop.start() if stop else len(answer)])
        start = stop.end() if stop else len(answer)
        if bare:
            kinds = _clause_kinds(bare)
            if "" in kinds:
                return False  # most answers end here, at their first clause
            refuses |= "refusal" in kinds
    return refuses


def _enough(asked: str, said: str) -> bool:
    """Whether an answer has so many of its question's shingles that it may be a copy; read until too many are missing."""
    if len(asked) < 4 or len(said) < 4:
        return False
    seams = (SHINGLE - 1) * (max(1, round(len(said) / len(asked))) - 1)
    left = len(said) - SHINGLE + 1
    least = COPY_CONTAINED * (left - seams)
    known: Container[str] = asked
    if len(asked) > SEARCHED:
        known = {asked[i : i + SHINGLE] for i in range(len(asked) - SHINGLE + 1)}
    for at in range(left):
        if said[at : at + SHINGLE] not in known:
            left -= 1
            if left < least:
                return False
    return True


def _aligned(asked: str, said: str) -> bool:
    """Whether the common subsequence of an answer and the question, repeated as often as it fits, makes it a copy."""
    parts = max(1, round(len(said) / len(asked)))
    return common_length(asked * parts, said) >= COPY_COMMON * max(len(said), 0.8 * len(asked) * parts)


def is_copy(question: str, answer: str) -> bool:
    """Whether the answer only repeats the question, once or several times, layout aside."""
    asked, said = _bare(question), ECHO.sub("", _bare(answer))
    return _enough(asked, said) and _aligned(asked, said)


def _asked_language(question: str) -> str | None:
    lower = question.lower()
    for code, pattern in ASKED:
        if re.search(pattern, lower):
            return code
    return None


THINK = re.compile(r"(?s)<think>.*?</think>")
EMPTY = re.compile(
    r"(?i)[\W_]*(?:null|none|nil|n/?a|nan|undefined|tbd|todo|无|暂无|空|略|待补充|没有"
    r"|答|回答|答案|解答|回复|答复|解析|正文|answer|response|reply|antwort|réponse|respuesta|回答文|답|답변|답안|解答例)?[\W_]*"
)
KANA, HANGUL, HAN, OTHER = re.compile(r"[ぁ-ヺ]{2}"), re.compile(r"[가-힣]{2}"), re.compile(r"[㐀-鿿]{3}"), re.compile(r"[\u0370-\u1fff]{3}")
LATIN = re.compile(r"[A-Za-zÀ-ɏ'’]+ [A-Za-zÀ-ɏ'’]+ [a-zÀ-ɏ'’]+")
#: Without this a text has neither kana nor hangul nor other letters in a row.
RARE = re.compile(r"[ぁ-ヺ가-힣\u0370-\u1fff][ぁ-ヺ가-힣\u0370-\u1fff]")
#: Scripts that one language is written in, so texts wholly in the same one need no scoring.
ONE_LANGUAGE = frozenset({("kana",), ("hangul",), ("han",)})


def _scripts(text: str) -> tuple[str, ...]:
    """The scripts that running text of these letters is in."""
    rare = RARE.search(text)
    if rare and KANA.search(text):
        found = ["kana", *(["hangul"] if HANGUL.search(text) else [])]
    else:
        found = [name for name, pattern in (("hangul", rare and HANGUL), ("han", HAN)) if pattern and pattern.search(text)]
    if " " in text and LATIN.search(text):
        found.append("latin")
    if rare and OTHER.search(text):
        found.append("other")
    return tuple(found)


def other_language(model: LanguageModel, pairs: list[tuple[str, str]]) -> list[bool]:
    """Whether each answer is in none of its question's languages, nor in the one that the question asks for.

    Only the first piece of an answer is scored where it is surely in a language of the question, which settles the pair.
    """
    asked = [{s[1] for s in found} for found in segment_languages(model, [q for q, _ in pairs])]
    heads = [next(running_pieces(answer), None) if own else None for own, (_, answer) in zip(asked, pairs)]
    once = list(dict.fromkeys(head for head in heads if head is not None))
    names, _, margin = model.classify(once)
    sure = {head: name for head, name, bits in zip(once, names, margin) if bits >= SURE_BITS}
    open_ = [at for at, head in enumerate(heads) if head is not None and sure.get(head) not in asked[at]]
    out = [False] * len(pairs)
    for at, found in zip(open_, segment_languages(model, [pairs[at][1] for at in open_])):
        said = {s[1] for s in found}
        out[at] = bool(said) and not asked[at] & said and _asked_language(pairs[at][0]) not in said
    return out


def pair_defects(model: LanguageModel, questions: list[str | None], answers: list[str | None]) -> list[tuple[int, str]]:
    """The defects of a batch of pairs, other than truncation: the place of the pair and the kind."""
    found: list[tuple[int, str]] = []
    differ: list[tuple[int, str, str]] = []
    for at, (question, answer) in enumerate(zip(questions, answers)):
        core = answer or ""
        if "<think>" in core:
            core = THINK.sub("", core)
        if EMPTY.fullmatch(core):
            found.append((at, "empty_answer"))
            continue
        if is_refusal(core):
            found.append((at, "refusal"))
        if not question or question.isspace():
            continue
        if is_copy(question, core):
            found.append((at, "copies_question"))
        before = _scripts(question)
        after = _scripts(core) if before else ()
        if after and (before != after or before not in ONE_LANGUAGE):
            differ.append((at, question, core))
    others = other_language(model, [(question, core) for _, question, core in differ])
    return found + [(at, "other_language") for (at, _, _), other in zip(differ, others) if other]


def defects(pairs: DataFrame, cut: DataFrame, model: LanguageModel) -> DataFrame:
    """Rows ``(tbl, rec_key, turn, defect)`` of all defective pairs, each defect once.

    ``pairs``: ``(tbl, rec_key, turn, question, answer)``; ``cut``: the keys of the answers that break off.  A null answer
    is empty; without a question (null or blank) an answer can't copy it or differ in language.
    """
    keys = ["tbl", "rec_key", "turn"]
    sent = pairs.sparkSession.sparkContext.broadcast(model)  # bounded by its training sample

    def run(batches):
        for batch in batches:
            found = pair_defects(sent.value, batch["question"].tolist(), batch["answer"].tolist())
            rows = batch[keys].iloc[[at for at, _ in found]].reset_index(drop=True)
            yield rows.assign(defect=pd.Series([name for _, name in found], dtype="object"))

    aligned = pairs.select(*keys, "question", "answer").mapInPandas(run, "tbl string, rec_key string, turn bigint, defect string")
    broken = cut.select(*keys, F.lit("truncated_answer").alias("defect"))
    return aligned.unionByName(broken).distinct()
