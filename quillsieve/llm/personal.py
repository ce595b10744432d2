"""Personal information in free text: a skip-chain conditional random field.

Tokens are single East Asian characters, Latin words, numbers and marks; labels are the beginnings and insides of five
kinds.  Neighbouring tokens share transition potentials; repeated or similar tokens of a document share skip potentials,
which carry the evidence of a clear mention ("patient X") to an unclear one ("X came back").  Labels come from loopy
message passing: forward-backward along each sentence, alternating with messages over the skip edges.

There are no labelled rows, so the field is fitted to mentions that unmistakable cues (labels, titles, verbs of naming and
speaking) mark in a bounded sample of texts; the characters and words of names are counted over all texts.  It is applied
to all.  An exact check follows: a span is kept if its form is possible for its kind, and takes the exact ends of that form.

The sentences of a batch are laid out one behind the other in arrays; features are rows of one weight table, and the chains
of sentences of similar length are worked through together.
"""

from __future__ import annotations

import re
from functools import lru_cache, reduce
from operator import or_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsieve.operators.sample import bounded_rows
from quillsieve.session import spread

#: Documents that cues are looked for in, and sentences the field is fitted to, at most.
FIT_DOCUMENTS, FIT_SENTENCES = 6000, 3600
#: Passes over them, sentences between two updates, and the step size.
PASSES, UPDATE_SENTENCES, RATE = 5, 16, 0.25
#: Rounds of messages over the skip edges, and the most that a skip potential can weigh.
ROUNDS, SKIP_MOST = 2, 3.0
#: Names that a character or word must be part of, and their share of all names that cues mark.
NAME_PART, NAME_PART_SHARE = 2, 2e-4
#: Rows of the weight table, as a power of two; characters of a batch and padded tokens that are worked on at once.
BITS, CHUNK, PADDED = 18, 1 << 18, 1 << 16

KINDS = ("name", "phone", "email", "id_number", "address")
LABELS = ("O", *(f"{b}-{k}" for k in KINDS for b in "BI"))
INDEX = {label: at for at, label in enumerate(LABELS)}
KIND_OF = np.array([0] + [1 + k for k in range(len(KINDS)) for _ in "BI"])
ALLOWED = np.array([[not b.startswith("I-") or a[2:] == b[2:] and a != "O" for b in LABELS] for a in LABELS])

H = "[㐀-鿿]"
CN = "〇零一二三四五六七八九"
# The forms that each kind can have.  Digits of full width have been made plain.
AT = r"@|＠|\[at\]|\(at\)| AT "
EMAIL = re.compile(rf"[A-Za-z0-9][A-Za-z0-9._+-]* ?(?:{AT}) ?[A-Za-z0-9-]+(?:(?:\.| DOT | ?\[dot\] ?)[A-Za-z0-9-]+)+")
SEP = r"[-\s.．·‐‑–—]"
PHONE = re.compile(
    rf"(?:[(（][+＋]\s?86[)）]{SEP}?|[+＋]\s?86{SEP}?|(?<!\d)(?<!\d\.))1[3-9]\d(?:{SEP}?\d{{4}}){{2}}(?!\.?\d)"
    rf"|(?<![{CN}])一[{CN}]{{10}}(?![{CN}])"
    rf"|[(（]0\d{{2,3}}[)）]{SEP}?\d{{3,4}}{SEP}?\d{{4}}(?!\.?\d)|(?<!\d)(?<!\d\.)0\d{{2,3}}{SEP}\d{{3,4}}{SEP}?\d{{4}}(?!\.?\d)"
    rf"|(?:\+1{SEP}?(?:\(\d{{3}}\){SEP}?|\d{{3}}{SEP})|\(\d{{3}}\){SEP}?|(?<!\d)(?<!\d\.)\d{{3}}{SEP})\d{{3}}{SEP}\d{{4}}(?!\.?\d)"
)
IDENTITY = re.compile(
    r"(?<!\d)\d{6}\s?(?:19|20)\d{2}(?:0[1-9]|1[0-2])(?:0[1-9]|[12]\d|3[01])\s?\d{3}[\dXxＸｘ](?!\d)"
    r"|(?<!\d)\d{8}(?:0[1-9]|1[0-2])(?:0[1-9]|[12]\d|3[01])\d{3}(?!\d)"
    r"|(?<![A-Za-z\d])[A-Z]{1,2}\d{7,8}(?!\d)|(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
)
ROADS, ESTATES = "路|街|巷|道|胡同", "小区|花园|新村|里|苑|家园|公寓"
ROAD = rf"{H}{{2,4}}(?:{ROADS})(?:\d+弄)?\d+号?(?:\d+(?:栋|幢|号楼))?(?:\d+单元)?(?:\d+(?:室|户))?"
ESTATE = rf"{H}{{2,4}}(?:{ESTATES})(?:\d+(?:-\d+){{1,2}}|\d+(?:栋|幢|号楼)(?:\d+单元)?\d*(?:室)?)"
IN_TOWN = rf"(?:镇|乡){H}{{2,4}}村"
VILLAGE = rf"{H}{{2,3}}{IN_TOWN}(?:[一二三四五六七八九十\d]+组)?(?:\d+号)?"
REGION = rf"(?:{H}{{2,4}}(?:省|自治区))?(?:{H}{{2,3}}市)?(?:{H}{{2,3}}(?:区|县))?"
ADDRESS = re.compile(rf"{REGION}(?:{ROAD}|{ESTATE}|{VILLAGE})")
ADDRESS_TAIL = re.compile(rf"(?:{ROAD}|{ESTATE}|{VILLAGE})")
WESTERN_ADDRESS = re.compile(r"(?<!\d)\d{1,5} (?:[A-Z][a-z]+ ){1,4}(?:Lane|Street|Avenue|Road|Drive|Court|Way|Close|Square|Terrace|Place|Row|Bend|Hill)(?:,? (?:Apt|Flat|Unit)\.? \d+)?")
CAPITAL = r"[A-ZÀ-ÖØ-Þ](?:['’][A-ZÀ-ÖØ-Þ])?[a-zß-öø-ÿĀ-ɏ]+(?:-[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿĀ-ɏ]+)?"
PARTICLE = r"(?:de |del |de la |van |van der |von |da |di |la |le )?"
WESTERN_NAME = re.compile(rf"(?:[A-Z]\. ?)?{CAPITAL}(?:,? {PARTICLE}{CAPITAL})+|[A-Z]\. ?{CAPITAL}")
COMPOUND = ("欧阳", "司徒", "尉迟", "上官", "诸葛", "慕容", "皇甫", "东方", "夏侯", "司马", "公孙", "令狐", "宇文", "长孙", "端木", "独孤", "南宫")
# What stands before or behind a name: labels, titles, verbs.
LABEL_ZH = "收件人|寄件人|联系人|经办人|负责人|登记表|姓名|签名|户主|备注"
NAMING_ZH = "(?:儿子|女儿|孩子|母亲|父亲|丈夫|妻子|名)叫|[\\d〇零一二三四五六七八九]找"
BEFORE_ZH = "患者|家属|病人|由|的|周|天|日|叫|找"
BEHIND_ZH = "女士|先生|大爷|阿姨|大妈|大叔|口述|留言|来信|说自己|自述|又来|复诊"
LABEL_EN = "[Pp]atient,?|[Bb]rother|[Ss]ister|[Cc]ontact:?|Kontakt:|Contacto:|question :|belongs to|[Pp]arcel for|[Nn]ame:|문의:|連絡先："
ENDS = r"[。，,／/（(、；;\s）)]|的邮箱|$"
NAME = rf"({H}{{2,4}}?)"
CAP = rf"((?:[A-Z]\. ?)?{CAPITAL}(?:,? {PARTICLE}{CAPITAL})?)"
#: Cues that give a name away by themselves; the group is the name.
CUES = (
    rf"(?=[收寄联经负登姓签户备儿女孩母父丈妻名\d〇零一二三四五六七八九])(?:(?:{LABEL_ZH})(?:[：:]|的时候|时)?|{NAMING_ZH}){NAME}(?={BEHIND_ZH}|{ENDS})",
    rf"[（(]{NAME}收[）)]",
    rf"(?=[PpBbSsCcKqNn문連])(?:{LABEL_EN}) ?{CAP}(?=[,.。、]| can | at | is | came |$)",
    rf"([A-Z](?<![A-Za-z.][A-Z])\. ?{CAPITAL})(?= (?:came|said|says|asked|called|was|is|has|had|wrote|told) )",
)
#: Of each cue the strings one of which a text must hold for it: most texts hold none and aren't searched.
CUE_WORDS = (
    (*LABEL_ZH.split("|"), "叫", "找"),
    ("收）", "收)"),
    ("atient", "rother", "ister", "ontact", "Kontakt:", "question :", "belongs to", "arcel for", "ame:", "문의:", "連絡先："),
    (" came ", " said ", " says ", " asked ", " called ", " was ", " is ", " has ", " had ", " wrote ", " told "),
)
CUE_BEFORE = {
    "phone": re.compile(r"(?:电话|手机[：:]?|拨打|微信同号|短信发到|打|联系[：:]|call|on|予約は|예약은|／|[（(])\s*$"),
    "id_number": re.compile(r"(?:身份证|证件[号：:]|证件号为|需提供|／|护照|file|姓名)\s*$"),
    "address": re.compile(r"(?:地址[：:]|现住|家住|住在|寄到|寄往|写的是|lives at|, )\s*$"),
}
WIDE_DIGIT = re.compile(r"[０-９]")
PLAIN = {ord(a): b for a, b in zip("０１２３４５６７８９", "0123456789")}

_TABLED = 0x30000
_STEP, _MIX = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)
WORD, NUMBER, BLANK, MARK, CHARACTER = 1, 2, 3, 4, 5
UPPER = 6  # a word that begins with a capital
PLACE = "省市区县镇乡村路街巷道号栋室组弄里苑"
STOPS = "。！？!?\n"
#: Codes of the two places before and the two behind a sentence.
EDGES = np.array([12, 11, 13, 14], dtype=np.uint64) * _MIX
OUTSIDE = 7  # their class
START = np.array([not label.startswith("I-") for label in LABELS])


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """What each character is: part of a word, of a number, of a blank, an East Asian character or a mark."""
    out = np.full(_TABLED, MARK, dtype=np.uint8)
    for code in range(_TABLED):
        char = chr(code)
        if char.isdecimal():
            out[code] = NUMBER
        elif char.isspace():
            out[code] = BLANK
        elif "㐀" <= char <= "鿿":
            out[code] = CHARACTER
        elif code < 0x250 and char.isalpha():
            out[code] = WORD
    return out


def _hash_words(words) -> np.ndarray:
    """The codes that tokens with these texts have."""
    return _Tokens(list(words)).token_of_text() if words else np.zeros(0, dtype=np.uint64)


class _Tokens:
    """The tokens of a batch of texts in arrays: code, class, place, sentence and text of each."""

    def __init__(self, texts: list[str]):
        joined = "\n".join(texts) + "\n"  # a text ends like a line
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        kind = _classes()[np.minimum(codes, _TABLED - 1)]
        wide = (codes >= 0xFF10) & (codes <= 0xFF19)
        codes = np.where(wide, codes - 0xFF10 + ord("0"), codes)
        sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
        self.text_begin = np.cumsum(sizes) - sizes
        ends = np.isin(codes, np.array([ord(c) for c in STOPS], dtype=np.uint32))
        sentence_starts = np.zeros(len(codes), dtype=bool)
        sentence_starts[1:] = ends[:-1]
        sentence_starts[self.text_begin] = True
        begins = sentence_starts.copy()
        begins |= (kind == MARK) | (kind == CHARACTER)
        begins[1:] |= kind[1:] != kind[:-1]
        at = np.flatnonzero(begins)
        size = np.diff(np.append(at, len(codes)))
        own = kind[at].copy()
        place = np.arange(len(codes)) - np.repeat(at, size)
        powers = np.cumprod(np.full(int(place.max()) + 1, _STEP, dtype=np.uint64))
        powers = powers[place]
        code = np.add.reduceat((codes.astype(np.uint64) + np.uint64(1)) * powers, at)
        number = (np.minimum(size, 21) + 100).astype(np.uint64) * _STEP
        code = np.where(own == NUMBER, number, np.where(own == BLANK, np.uint64(99), code))
        # words that differ in case only are similar, numbers only if they are the same
        lowered = np.where((codes >= 65) & (codes <= 90), codes + 32, codes)
        lower = np.add.reduceat((lowered.astype(np.uint64) + np.uint64(1)) * powers, at)
        first = codes[at]
        own[(own == WORD) & ((first <= 90) | (first >= 0xC0) & (first <= 0xDE))] = UPPER
        sentence = np.cumsum(sentence_starts)[at] - 1
        count = int(sentence[-1]) + 1
        # two edges on either side of each sentence, so that what stands beside a token is what lies beside it
        slot = np.arange(len(at)) + 4 * sentence + 2
        whole = len(at) + 4 * count
        self.sentence_size = np.bincount(sentence, minlength=count)
        self.sentence_begin = np.cumsum(self.sentence_size + 4) - self.sentence_size - 2
        self.real = np.zeros(whole, dtype=bool)
        self.real[slot] = True
        self.code = np.empty(whole, dtype=np.uint64)
        self.code[slot] = (code ^ (code >> np.uint64(31))) * _MIX
        for edge, places in zip(EDGES, (-2, -1, 0, 1)):
            self.code[self.sentence_begin + places + (self.sentence_size if places >= 0 else 0)] = edge
        self.kind = self._laid(own, slot, OUTSIDE)
        self.size, self.lower, self.first = (self._laid(x, slot, 0) for x in (size, lower, first))
        self.sentence = np.repeat(np.arange(count), self.sentence_size + 4)
        text = np.searchsorted(self.text_begin, at, side="right") - 1
        self.text = self._laid(text, slot, -1)
        self.start = self._laid(at - self.text_begin[text], slot, -1)  # in its text
        self.text_first = slot[np.searchsorted(at, self.text_begin)]

    def _laid(self, values: np.ndarray, slot: np.ndarray, edge: int) -> np.ndarray:
        out = np.full(len(self.real), edge, dtype=values.dtype if edge >= 0 else np.int64)
        out[slot] = values
        return out

    def token_of_text(self) -> np.ndarray:
        """The code of the first token of each text."""
        return self.code[self.text_first]

    def beside(self, values: np.ndarray, by: int) -> np.ndarray:
        """The values ``by`` tokens on; edges lie beyond the sentence."""
        return np.roll(values, -by)


def _points(chars) -> np.ndarray:
    """A table of which code points are among ``chars``."""
    out = np.zeros(_TABLED, dtype=bool)
    out[[ord(c) for c in chars]] = True
    return out


_PLACES, _BRACKETS = _points(PLACE), _points("+-(（@")


class Tagger:
    """The fitted field."""

    def __init__(self):
        self.weights = np.zeros((1 << BITS, len(LABELS)), dtype=np.float32)
        self.transitions = np.zeros((len(LABELS), len(LABELS)))
        self.skip = np.zeros(len(KINDS) + 1)
        self._gains: list[np.ndarray] | None = None
        self.family: set[str] = set()
        self.given: set[str] = set()
        self.western: set[str] = set()
        self._learned()

    # -- names ------------------------------------------------------------------------------------------------------

    def learn_names(self, parts: pd.DataFrame) -> None:
        """``parts``: ``(what, part)`` with ``what`` one of family, given and western."""
        self.family, self.given, self.western = (set(parts.loc[parts["what"] == k, "part"]) for k in ("family", "given", "western"))
        self._learned()

    def _learned(self) -> None:
        double = [f for f in self.family if len(f) == 2]
        self._family, self._given = _points(f for f in self.family if len(f) == 1), _points(self.given)
        self._first = _points(f[0] for f in double)
        self._double = np.sort(np.array([(ord(f[0]) << 21) | ord(f[1]) for f in double], dtype=np.int64))
        self._western = np.sort(_hash_words(sorted(self.western)))
        #: names made of known parts, and these before or behind a title or a verb, which alone would say little
        self.known, self.known_cues = None, ()
        if self.family and self.given:
            known = "(?:" + "|".join(sorted(self.family, key=lambda x: (-len(x), x))) + ")[" + "".join(sorted(self.given)) + "]{1,2}"
            self.known = re.compile(known)
            cues = (rf"(?:{BEFORE_ZH})({known})(?={ENDS})", rf"(?:{BEFORE_ZH}|[和与跟])({known})(?={BEHIND_ZH})", rf"(?<!{H})({known})(?={BEHIND_ZH})")
            self.known_cues = tuple(map(re.compile, cues))

    # -- features ---------------------------------------------------------------------------------------------------

    def _flags(self, tokens: _Tokens) -> tuple[np.ndarray, np.ndarray]:
        """Whether tokens are parts of family (1), compound family (2) or western names (4), and of given names."""
        point = np.minimum(tokens.first, _TABLED - 1)
        family = self._family[point].astype(np.int64)
        maybe = np.flatnonzero(self._first[point])
        pair = (tokens.first[maybe].astype(np.int64) << 21) | np.roll(tokens.first, -1)[maybe].astype(np.int64)
        family[maybe] += 2 * np.isin(pair, self._double)
        words = np.flatnonzero((tokens.kind == UPPER) | (tokens.kind == WORD))
        family[words] += 4 * np.isin(tokens.code[words], self._western)
        return family, self._given[point]

    def _features(self, tokens: _Tokens) -> np.ndarray:
        """Rows of the weight table, one for each template and token."""
        code, kind = tokens.code, tokens.kind.astype(np.int64)
        a, b, d, e = (tokens.beside(code, by) for by in (-2, -1, 1, 2))
        kinds = kind
        for by in (-2, -1, 1, 2):
            kinds = kinds * 8 + tokens.beside(kind, by)
        family, own = self._flags(tokens)
        given = own.astype(np.int64)
        for by in (-1, 1, 2):
            given = given * 2 + tokens.beside(own, by)
        point = np.minimum(tokens.first, _TABLED - 1)
        marks = np.where(_BRACKETS[point], tokens.first, 0).astype(np.int64)
        bracket = np.zeros_like(marks)
        for by in (-4, -3, -2, -1):
            near = tokens.beside(marks, by)
            bracket = np.where(near > 0, near, bracket)
        known = family * 16 + given
        templates = (
            (code,), (b, code), (code, d), (a, b), (d, e), (kinds,), (known,), (b,), (d,), (b, d),
            (a,), (e,), (known, b), (bracket * 8 + kind,), (_PLACES[point],),
        )
        rows = np.empty((len(templates), len(code)), dtype=np.int32)
        for at, values in enumerate(templates):
            mixed = values[0].astype(np.uint64) * _STEP + np.uint64(at + 1)
            for value in values[1:]:
                mixed = (mixed ^ (mixed >> np.uint64(33))) * _STEP + value.astype(np.uint64)
            mixed = (mixed ^ (mixed >> np.uint64(32))) * _MIX
            rows[at] = (mixed >> np.uint64(64 - BITS)).astype(np.int32)
        return rows

    def _unary(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros((rows.shape[1], len(LABELS)), dtype=np.float32)
        for own in rows:
            out += self.weights[own]
        return out

    # -- inference --------------------------------------------------------------------------------------------------

    def _blocks(self, sizes: np.ndarray, most: int = PADDED):
        """Sentences of similar length, as many as fit into ``most`` padded tokens."""
        order = np.argsort(sizes, kind="stable")
        begin = 0
        while begin < len(order):
            end = begin + 1
            while end < len(order) and int(sizes[order[end]]) * (end + 1 - begin) <= most:
                end += 1
            yield order[begin:end]
            begin = end

    def _padded(self, unary: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Potentials by place and sentence, and which of them are tokens; padding is certainly outside."""
        place = np.arange(int(size.max()))[:, None]
        real = place < size[None, :]
        out = np.full((*real.shape, len(LABELS)), -50.0)
        out[..., 0] = 0.0
        out[real] = unary[(begin[None, :] + place)[real]]
        return out, real

    def _chains(self, unary: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
        """Forward and backward messages of padded sentences, scaled per token, with node and transition factors."""
        padded, real = self._padded(unary, begin, size)
        factor = np.where(ALLOWED, np.exp(self.transitions), 0.0)
        node = np.exp(padded - padded.max(axis=2, keepdims=True))
        ahead, back = np.empty_like(node), np.ones_like(node)
        ahead[0] = node[0] * START
        ahead[0] /= ahead[0].sum(axis=1, keepdims=True)
        for t in range(1, len(node)):
            row = (ahead[t - 1] @ factor) * node[t]
            ahead[t] = row / row.sum(axis=1, keepdims=True)
        for t in range(len(node) - 2, -1, -1):
            row = (node[t + 1] * back[t + 1]) @ factor.T
            back[t] = np.where(real[t + 1][:, None], row / row.sum(axis=1, keepdims=True), 1.0)
        return ahead, back, node, factor, real

    def _beliefs(self, unary: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The probabilities of the labels of all tokens of these sentences, at the places of their tokens."""
        out = np.zeros_like(unary)
        for own in self._blocks(size):
            ahead, back, _, _, real = self._chains(unary, begin[own], size[own])
            belief = ahead * back
            belief /= belief.sum(axis=2, keepdims=True)
            place = np.arange(len(belief))[:, None] + begin[own][None, :]
            out[place[real]] = belief[real]
        return out

    def _best(self, unary: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The best labels of all tokens of these sentences, 0 elsewhere."""
        out = np.zeros(len(unary), dtype=np.int8)
        scores = np.where(ALLOWED, self.transitions, -1e9).T  # by label, then by the label before
        for own in self._blocks(size):
            padded, real = self._padded(unary, begin[own], size[own])
            now = padded[0] + np.where(START, 0.0, -1e9)
            steps = np.empty((len(padded), len(own), len(LABELS)), dtype=np.int8)
            for t in range(1, len(padded)):
                each = now[:, None, :] + scores
                step = each.argmax(axis=2)
                steps[t] = step
                now = np.take_along_axis(each, step[..., None], axis=2)[..., 0] + padded[t]
            label = now.argmax(axis=1)
            which = np.arange(len(own))
            for t in range(len(padded) - 1, -1, -1):
                inside = real[t]
                out[begin[own][inside] + t] = label[inside]
                if t:
                    label = steps[t][which, label]
        return out

    def _skip_groups(self, tokens: _Tokens, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens that share skip edges, and the group of each: repeated pairs of name characters, capitalised words and long numbers."""
        family, given = self._flags(tokens)
        long = (tokens.size > 3) & ((tokens.kind == UPPER) | (tokens.kind == NUMBER))
        pair = ~long & tokens.beside(given, 1) & ((family & 1 > 0) | given)
        at = np.flatnonzero((long | pair) & among & tokens.real)
        key = np.where(long[at], tokens.lower[at], tokens.code[at] * _STEP + tokens.code[np.minimum(at + 1, len(tokens.code) - 1)])
        key = (key ^ (tokens.text[at].astype(np.uint64) + np.uint64(1)) * _MIX) * _STEP
        _, group, count = np.unique(key, return_inverse=True, return_counts=True)
        shared = count[group] > 1
        at, group = at[shared], group[shared]
        order = np.argsort(group, kind="stable")
        return at[order], np.unique(group[order], return_inverse=True)[1] if len(at) else group

    def _hopeful(self, real: np.ndarray, starts: np.ndarray, begin: np.ndarray, inside: np.ndarray, kind: str) -> np.ndarray:
        """Sentences in which some mention of a kind could score more than none, by an upper bound.

        ``starts``: where the edges before each sentence are; ``begin`` and ``inside``: what each token gains at most as
        the first or another token of a mention.  A mention gains at most what its first token does, the best run of
        insides behind it, and the best transitions into and out of it.
        """
        trans = np.where(ALLOWED, self.transitions, -np.inf) - self.transitions[0, 0]
        b, i = INDEX["B-" + kind], INDEX["I-" + kind]
        on, enter, leave = max(trans[b, i], trans[i, i]), trans[:, b].max(), max(0.0, trans[[b, i]][:, START].max())
        upto = np.cumsum(np.where(real, inside + on, -1e6))  # no run goes on into the next sentence
        best = np.maximum.accumulate(upto[::-1])[::-1]
        whole = np.where(real, begin + (best - upto), -1e6)
        return np.maximum.reduceat(whole, starts) + (enter + leave) > -1e-6

    def _first_bound(self, tokens: _Tokens, rows: np.ndarray, extra: np.ndarray) -> np.ndarray:
        """Sentences that pass the bound in which each feature counts for the kind that it speaks for most."""
        if self._gains is None:
            own = self.weights - self.weights[:, :1]
            self._gains = [own[:, [INDEX[x + k] for k in KINDS]].max(axis=1) for x in ("B-", "I-")]
        begin, inside = extra.copy(), extra.copy()
        for row in rows:
            begin += self._gains[0][row]
            inside += self._gains[1][row]
        return np.logical_or.reduce([self._hopeful(tokens.real, tokens.sentence_begin - 2, begin, inside, k) for k in KINDS])

    def _second_bound(self, tokens: _Tokens, some: np.ndarray, unary: np.ndarray, extra: np.ndarray) -> np.ndarray:
        """Of the sentences ``some``, those that pass the bound of a kind; ``unary`` and ``extra``: of their tokens and edges."""
        sizes = tokens.sentence_size[some] + 4
        starts = np.cumsum(sizes) - sizes
        real = tokens.real[some[tokens.sentence]]
        gain = lambda label: unary[:, INDEX[label]] - unary[:, 0] + extra
        passed = [self._hopeful(real, starts, gain("B-" + k), gain("I-" + k), k) for k in KINDS]
        out = some.copy()
        out[some] = np.logical_or.reduce(passed)
        return out

    def label(self, tokens: _Tokens) -> np.ndarray:
        """Labels of the tokens; skip edges join the tokens of one text.

        Sentences in which no mention could score more than none are left out of the chains, which changes nothing: a
        first bound takes the best kind of each feature for the kind of the mention, a second one each kind by itself.
        Tokens with skip edges may gain as much again as a skip potential.
        """
        rows = self._features(tokens)
        shared = np.zeros(len(tokens.real), dtype=bool)
        shared[self._skip_groups(tokens, tokens.real)[0]] = True
        extra = np.where(shared, np.float32(self.skip.max()), np.float32(0))
        some = self._first_bound(tokens, rows, extra)
        picked = np.flatnonzero(some[tokens.sentence])
        unary = np.zeros((len(tokens.real), len(LABELS)), dtype=np.float32)
        if len(picked):
            unary[picked] = self._unary(rows[:, picked])
            some = self._second_bound(tokens, some, unary[picked], extra[picked])
        begin, size = tokens.sentence_begin[some], tokens.sentence_size[some]
        if not len(begin):
            return np.zeros(len(tokens.real), dtype=np.int8)
        total = unary
        at, group = self._skip_groups(tokens, some[tokens.sentence])
        if len(at):
            first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
            others = np.maximum(1, np.bincount(group)[group] - 1)[:, None]
            touched = np.unique(tokens.sentence[at])
            begin_t, size_t = tokens.sentence_begin[touched], tokens.sentence_size[touched]
            sent = np.zeros((len(at), len(LABELS)))
            by_kind = (KIND_OF[:, None] == np.arange(len(KINDS) + 1)).astype(float)
            for _ in range(ROUNDS):
                belief = self._beliefs(total, begin_t, size_t)[at]
                # a message says how far the others take the token for each kind, without what they heard from it
                own = np.log(belief + 1e-12) - sent
                own = np.exp(own - own.max(axis=1, keepdims=True))
                kind = own / own.sum(axis=1, keepdims=True) @ by_kind
                votes = np.log1p(np.expm1(self.skip) * kind)
                whole = np.add.reduceat(votes, first, axis=0)[group]
                sent = ((whole - votes) / others)[:, KIND_OF]
                total = unary.copy()
                total[at] += sent
        return self._best(total, begin, size)

    # -- fitting ----------------------------------------------------------------------------------------------------

    def fit(self, documents: list[str], seed: int = 5) -> "Tagger":
        """Fit to the mentions that cues mark in ``documents``; names are counted in them where that hasn't been done.

        Without documents nothing is learned, and nothing will be found.
        """
        documents = sorted(documents)
        if not documents:
            return self
        if not self.family and not self.western:
            names = pd.Series([n for d in documents for n in cued_names(plain(d))], dtype="object")
            counted = pd.DataFrame([p for n in names for p in name_parts(n)], columns=["what", "part"]).value_counts().reset_index(name="n")
            self.learn_names(counted[counted["n"] >= max(NAME_PART, NAME_PART_SHARE * len(names))])
        spans = [cue_spans(plain(d), self.known_cues) for d in documents]
        doubt = [_doubtful(plain(d), own, self.known) for d, own in zip(documents, spans)]
        tokens = _Tokens(documents)
        gold, unsure = np.zeros(len(tokens.real), dtype=np.int64), np.zeros(len(tokens.real), dtype=bool)
        slots = np.flatnonzero(tokens.real)
        start = tokens.start[slots]
        bounds = np.append(np.searchsorted(slots, tokens.text_first), len(slots))
        for at, own in enumerate(spans):
            inside = start[bounds[at] : bounds[at + 1]]
            for a, b, kind in own:
                low, high = bounds[at] + np.searchsorted(inside, [a, b])
                gold[slots[low:high]] = INDEX["I-" + kind]
                if low < high and start[low] == a:
                    gold[slots[low]] = INDEX["B-" + kind]
            for a, b in doubt[at]:
                low, high = bounds[at] + np.searchsorted(inside, [a, b])
                unsure[slots[low:high]] = True
        self._fit_skip(tokens, gold)
        edges = tokens.sentence_begin - 2
        marked = np.maximum.reduceat(gold, edges) > 0
        dubious = np.maximum.reduceat(unsure, edges)
        figures = np.maximum.reduceat((tokens.kind == NUMBER) | (tokens.kind == UPPER) | self._flags(tokens)[1], edges)
        rng = np.random.default_rng(seed)
        pick = lambda chosen, share: rng.permutation(np.flatnonzero(chosen & ~dubious))[: int(FIT_SENTENCES * share)]
        train = np.concatenate([pick(marked, 0.5), pick(~marked & figures, 0.35), pick(~marked & ~figures, 0.15)])
        self._descend(tokens, gold, train, rng)
        return self

    def _fit_skip(self, tokens: _Tokens, gold: np.ndarray) -> None:
        """Skip potentials: how much more often tokens that share an edge are of one kind than of two."""
        at, group = self._skip_groups(tokens, tokens.real)
        agree, differ = np.ones(len(KINDS) + 1), np.ones(len(KINDS) + 1)
        if len(at):
            kind = KIND_OF[gold[at]]
            table = np.zeros((group.max() + 1, len(KINDS) + 1))
            np.add.at(table, (group, kind), 1)
            agree += (table * (table - 1)).sum(axis=0)
            differ += (table * (table.sum(axis=1, keepdims=True) - table)).sum(axis=0)
        self.skip = np.clip(np.log(agree / differ), 0.0, SKIP_MOST)
        self.skip[0] = 0.0

    def _descend(self, tokens: _Tokens, gold: np.ndarray, train: np.ndarray, rng: np.random.Generator) -> None:
        """Gradient steps on the likelihood of the labels, scaled by what each weight has moved so far."""
        self._gains = None
        squares = np.full(self.weights.shape, 1e-2, dtype=np.float32)
        transition_squares = np.full_like(self.transitions, 1e-2)
        rows = self._features(tokens)
        size = tokens.sentence_size[train]
        near = train[np.argsort(size, kind="stable")]  # updates with sentences of similar length
        groups = [near[k : k + UPDATE_SENTENCES] for k in range(0, len(near), UPDATE_SENTENCES)]
        for _ in range(PASSES):
            for at in rng.permutation(len(groups)):
                own = groups[at]
                begin, size = tokens.sentence_begin[own], tokens.sentence_size[own]
                place = np.concatenate([np.arange(b, b + n) for b, n in zip(begin, size)])
                unary = self._unary(rows[:, place])
                inner = np.cumsum(size) - size
                ahead, back, node, factor, real = self._chains(unary, inner, size)
                belief = ahead * back
                belief /= belief.sum(axis=2, keepdims=True)
                slope = np.zeros_like(unary)
                flat = np.arange(len(belief))[:, None] + inner[None, :]
                slope[flat[real]] = -belief[real]
                slope[np.arange(len(place)), gold[place]] += 1
                much = np.flatnonzero(np.abs(slope).max(axis=1) > 0.02)
                if len(much):
                    used, which = np.unique(rows[:, place[much]].T, return_inverse=True)
                    change = np.zeros((len(used), len(LABELS)), dtype=np.float32)
                    moved = np.zeros_like(change)
                    each = np.repeat(slope[much], len(rows), axis=0)
                    np.add.at(change, which.ravel(), each)
                    np.add.at(moved, which.ravel(), each**2)
                    squares[used] += moved
                    self.weights[used] += RATE * change / np.sqrt(squares[used])
                if len(belief) > 1:
                    pair = ahead[:-1, :, :, None] * factor * (node[1:] * back[1:])[:, :, None, :]
                    pair /= pair.sum(axis=(2, 3), keepdims=True)
                    step = -pair[real[1:]].sum(axis=0)
                    inside = np.ones(len(place), dtype=bool)
                    inside[inner] = False
                    now = np.flatnonzero(inside)
                    np.add.at(step, (gold[place[now - 1]], gold[place[now]]), 1)
                    transition_squares += step**2
                    self.transitions += RATE * step / np.sqrt(transition_squares)

    # -- use --------------------------------------------------------------------------------------------------------

    def mentions_of(self, documents: list[str]) -> list[list[tuple[int, int, str]]]:
        """For each document ``(start, end, kind)`` of every mention, in order, without overlaps."""
        out: list[list[tuple[int, int, str]]] = []
        begin, room = 0, 0
        for at in range(len(documents) + 1):
            if at == len(documents) or room > CHUNK:
                if at > begin:
                    out += self._mentions(documents[begin:at])
                begin, room = at, 0
            if at < len(documents):
                room += len(documents[at]) + 1
        return out

    def mentions(self, document: str) -> list[tuple[int, int, str]]:
        """The mentions of one document."""
        return self.mentions_of([document])[0]

    def _mentions(self, documents: list[str]) -> list[list[tuple[int, int, str]]]:
        tokens = _Tokens(documents)
        labels = self.label(tokens)
        inside = ~START[labels]
        found: list[list[tuple[int, int, str]]] = [[] for _ in documents]
        plained: dict[int, str] = {}
        ends = tokens.start + tokens.size
        for first in np.flatnonzero((labels > 0) & ~inside):
            last = int(first)
            while inside[last + 1]:  # an edge isn't inside
                last += 1
            at = int(tokens.text[first])
            if at not in plained:
                plained[at] = plain(documents[at])
            low = tokens.sentence_begin[tokens.sentence[first]]
            high = low + tokens.sentence_size[tokens.sentence[first]] - 1
            kind = KINDS[KIND_OF[labels[first]] - 1]
            within = (int(tokens.start[low]), min(int(ends[high]), len(plained[at])))
            span = checked(plained[at], int(tokens.start[first]), min(int(ends[last]), len(plained[at])), kind, within)
            if span:
                found[at].append((*span, kind))
        out = []
        for own in found:
            kept: list[tuple[int, int, str]] = []
            for span in sorted(set(own), key=lambda s: (s[0], -s[1])):
                if not kept or span[0] >= kept[-1][1]:
                    kept.append(span)
            out.append(kept)
        return out


def plain(text: str) -> str:
    """The text with plain digits, of the same length."""
    return text.translate(PLAIN) if WIDE_DIGIT.search(text) else text


def cued_names(text: str) -> list[str]:
    """The names that cues give away by themselves."""
    return [m.group(1) for cue in _compiled() for m in cue.finditer(text)]


@lru_cache(maxsize=1)
def _compiled() -> tuple[re.Pattern, ...]:
    return tuple(re.compile(c) for c in CUES)


def name_parts(name: str) -> list[tuple[str, str]]:
    """``(what, part)``: the family name and the given characters of a Chinese name, the words of another."""
    if not re.match(H, name):
        return [("western", w) for w in re.findall(r"[A-Za-zÀ-ɏ]+", name) if len(w) > 1 and w[0].isupper()]
    cut = 2 if name[:2] in COMPOUND and len(name) > 2 else 1
    return [("family", name[:cut]), *(("given", c) for c in name[cut:])]


def cue_spans(text: str, known: tuple[re.Pattern, ...] = ()) -> list[tuple[int, int, str]]:
    """Mentions that their form or an unmistakable cue gives away; ``known``: cues for names of known parts."""
    out = [(m.start(), m.end(), "email") for m in EMAIL.finditer(text)]
    for kind, pattern in (("id_number", IDENTITY), ("phone", PHONE)):
        for m in pattern.finditer(text):
            if CUE_BEFORE[kind].search(text[max(0, m.start() - 12) : m.start()]):
                out.append((m.start(), m.end(), kind))
    for m in ADDRESS_TAIL.finditer(text):
        begin = max(0, m.start() - 24)
        cue = list(re.finditer(r"地址[：:]|现住|家住|住在|寄到|寄往|写的是", text[begin : m.end()]))
        if cue:
            start = begin + cue[-1].end()
            if ADDRESS.fullmatch(text, start, m.end()):
                out.append((start, m.end(), "address"))
    out += [(m.start(), m.end(), "address") for m in WESTERN_ADDRESS.finditer(text)]
    for cue in (*_compiled(), *known):
        out += [(m.start(1), m.end(1), "name") for m in cue.finditer(text)]
    out.sort(key=lambda s: (s[0], -s[1]))
    kept: list[tuple[int, int, str]] = []
    for span in out:
        if not kept or span[0] >= kept[-1][1]:
            kept.append(span)
    return kept


FORMS = {"email": (EMAIL,), "phone": (PHONE,), "id_number": (IDENTITY,), "address": (ADDRESS, WESTERN_ADDRESS), "name": (WESTERN_NAME,)}


def checked(text: str, start: int, end: int, kind: str, within: tuple[int, int]) -> tuple[int, int] | None:
    """The exact ends of a span whose form is possible for its kind, else None."""
    if kind == "name" and re.match(H, text[start]):
        span = text[start:end].strip()
        return (start, end) if re.fullmatch(rf"{H}{{2,4}}", span) else None
    if kind == "name" and WESTERN_NAME.fullmatch(text, start, end):
        return start, end
    if kind == "address" and re.match(H, text[start]):
        m = ADDRESS.match(text, start, within[1])
        if m and m.end() > start + 4:
            return m.start(), m.end()
    best = None
    for form in FORMS[kind]:
        for m in form.finditer(text, max(within[0], start - 8), within[1]):
            common = min(end, m.end()) - max(start, m.start())
            if common > 0 and 2 * common >= min(end - start, m.end() - m.start()) and (best is None or common > best[0]):
                best = (common, m.start(), m.end())
    return best[1:] if best else None


def _doubtful(text: str, spans: list[tuple[int, int, str]], known: re.Pattern | None) -> list[tuple[int, int]]:
    """Places that look like a name of known parts although no cue marks them: nothing is learned from their sentences."""
    if known is None:
        return []
    return [m.span() for m in known.finditer(text) if not any(a <= m.start() < b for a, b, _ in spans)]


def name_statistics(docs: DataFrame, text: str) -> pd.DataFrame:
    """Rows ``(what, part, n)``: parts of the names that cues mark in all texts, and how many names have each.

    The parts are characters and words above a share of all names, so their number is bounded by that share.
    """
    def cued(cue: str, words: tuple[str, ...]) -> Column:
        some = reduce(or_, [F.contains(F.col(text), F.lit(w)) for w in words])
        return F.when(some, F.regexp_extract_all(F.col(text), F.lit(cue), F.lit(1))).otherwise(F.array().cast("array<string>"))

    names = F.flatten(F.array(*map(cued, CUES, CUE_WORDS)))
    found = docs.filter(F.col(text).isNotNull()).select(F.explode(names).alias("name")).groupBy("name").agg(F.count("*").alias("n"))

    def cut(batches):
        for batch in batches:
            rows = [(*p, n) for name, n in zip(batch["name"], batch["n"]) for p in name_parts(name)]
            yield pd.DataFrame(rows, columns=["what", "part", "n"])

    parts = found.mapInPandas(cut, "what string, part string, n bigint").groupBy("what", "part").agg(F.sum("n").alias("n"))
    whole = parts.groupBy("what").agg(F.sum("n").alias("_all"))
    least = F.greatest(F.lit(NAME_PART), NAME_PART_SHARE * F.col("_all"))
    return parts.join(whole, "what").filter(F.col("n") >= least).select("what", "part", "n").toPandas()


def fit_tagger(docs: DataFrame, text: str, most: int = FIT_DOCUMENTS) -> Tagger:
    """A tagger fitted to at most ``most`` texts, those with the least hashes; parts of names are counted over all texts."""
    tagger = Tagger()
    tagger.learn_names(name_statistics(docs, text))
    short = docs.select(F.col(text).alias("text")).filter(F.length("text").between(10, 4000))
    rows = bounded_rows(short, "text", most, docs.count()).collect()
    return tagger.fit([r["text"] for r in rows])


def find_mentions(docs: DataFrame, key: str, text: str, tagger: Tagger) -> DataFrame:
    """Rows ``(key, kind, start_pos, end_pos, mention)``; null and empty texts give none, long ones are searched whole."""
    sent = docs.sparkSession.sparkContext.broadcast(tagger)  # a weight table of fixed size and the name parts
    slim = spread(docs.select(key, text).filter(F.length(text) > 0))

    def run(batches):
        for batch in batches:
            texts = batch[text].tolist()
            found = sent.value.mentions_of(texts)
            rows = [(k, kind, a, b, t[a:b]) for k, t, own in zip(batch[key].tolist(), texts, found) for a, b, kind in own]
            yield pd.DataFrame(rows, columns=[key, "kind", "start_pos", "end_pos", "mention"])

    return slim.mapInPandas(run, f"`{key}` {slim.schema[key].dataType.simpleString()}, kind string, start_pos bigint, end_pos bigint, mention string")


def redact(docs: DataFrame, key: str, text: str, tagger: Tagger) -> DataFrame:
    """Rows ``(key, text)`` with every mention replaced by a placeholder such as ``[NAME]``; null texts stay null."""
    sent = docs.sparkSession.sparkContext.broadcast(tagger)

    def hide(document: str | None, found: list[tuple[int, int, str]]) -> str | None:
        for start, end, kind in reversed(found):
            document = f"{document[:start]}[{kind.upper()}]{document[end:]}"
        return document

    def run(batches):
        for batch in batches:
            texts = batch[text].tolist()
            found = sent.value.mentions_of([t or "" for t in texts])
            yield batch.assign(**{text: pd.Series([hide(t, own) for t, own in zip(texts, found)], dtype="object", index=batch.index)})

    slim = spread(docs.select(key, text))
    return slim.mapInPandas(run, slim.schema)
