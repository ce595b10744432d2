"""Languages of documents and of the parts of mixed ones: prediction by partial matching.

For each language the statistics of its bytes after their last 0 to ``ORDER`` bytes are counted once and then frozen.
The probability of a byte is that in its longest known context; from an unknown continuation the model escapes to the
next shorter context (method C: the escape has as many counts as the context has different successors).  The code length
of a text is the sum over its bytes; the language with the shortest code wins, and the difference in code length gives
the confidence.  All languages share one table per order, so a byte costs one lookup, whatever their number.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Longest context in bytes.
ORDER = 5
#: Most training sentences taken of one language.
TRAIN_SENTENCES = 2500
#: Longest training sentence in characters; longer ones aren't trained on.
LONGEST = 600
#: A training sentence is dropped if another language saves more bits than this.
DISPUTED_BITS = 10
#: Bits by which a language must beat the next one for a sentence's language not to be in doubt.
SURE_BITS = 6
PAD = b"\n" * ORDER
PROBES = 8
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class _Table:
    """Open-addressed hash table from packed byte strings to row numbers, probed for whole arrays at a time."""

    def __init__(self, keys: np.ndarray):
        bits = max(8, int(np.ceil(np.log2(max(len(keys), 1) * 3))))
        while not self._fill(keys.astype(np.uint64), bits):
            bits += 1

    def _fill(self, keys: np.ndarray, bits: int) -> bool:
        self.shift = np.uint64(64 - bits)
        self.mask = (1 << bits) - 1
        self.keys = np.zeros(1 << bits, dtype=np.uint64)
        self.rows = np.full(1 << bits, -1, dtype=np.int32)
        left = np.arange(len(keys))
        at = ((keys * _MULTIPLIER) >> self.shift).astype(np.int64)
        for _ in range(PROBES):
            free = self.rows[at] < 0
            first = np.unique(at[free], return_index=True)[1]
            chosen = np.flatnonzero(free)[first]
            self.rows[at[chosen]] = left[chosen]
            self.keys[at[chosen]] = keys[left[chosen]]
            stay = np.ones(len(left), dtype=bool)
            stay[chosen] = False
            left, at = left[stay], (at[stay] + 1) & self.mask
            if not len(left):
                return True
        return False

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The row of each key, -1 where it is unknown."""
        at = ((keys * _MULTIPLIER) >> self.shift).astype(np.int64)
        out = np.full(len(keys), -1, dtype=np.int32)
        open_ = np.arange(len(keys))
        for _ in range(PROBES):
            rows = self.rows[at]
            hit = (rows >= 0) & (self.keys[at] == keys[open_])
            out[open_[hit]] = rows[hit]
            go = ~hit & (rows >= 0)
            if not go.any():
                break
            open_, at = open_[go], (at[go] + 1) & self.mask
        return out


def _grams(data: np.ndarray, length: int, starts: np.ndarray) -> np.ndarray:
    """The ``length`` bytes that end at each of ``starts``, packed into integers."""
    packed = np.zeros(len(starts), dtype=np.uint64)
    for back in range(length - 1, -1, -1):
        packed = (packed << np.uint64(8)) | data[starts - back].astype(np.uint64)
    return packed


def _layout(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes behind padding, the places to predict and where each text begins among these."""
    data = np.frombuffer(b"".join(PAD + t for t in texts), dtype=np.uint8)
    sizes = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
    ends = np.cumsum(sizes + ORDER)
    places = np.arange(len(data), dtype=np.int64)
    keep = np.ones(len(data), dtype=bool)
    firsts = ends - sizes - ORDER
    for k in range(ORDER):
        keep[firsts + k] = False
    return data, places[keep], np.cumsum(sizes) - sizes


#: Share of a language's training sentences that must be in a script for texts in that script to be in the language.
SCRIPT_SHARE = 0.05
#: The language of segments in a script that no language of the model is written in, and its confidence.
UNKNOWN, UNKNOWN_SURE = "unknown", 0.0
_TABLED = 0x30000
NOTHING, KANA, HANGUL, HAN, LATIN = range(5)


@lru_cache(maxsize=1)
def _scripts() -> np.ndarray:
    """The script of each letter, by the first word of its Unicode name; 0 for what isn't a letter."""
    out = np.zeros(_TABLED, dtype=np.uint8)
    known = {"HIRAGANA": KANA, "KATAKANA": KANA, "KATAKANA-HIRAGANA": KANA, "HALFWIDTH": KANA, "HANGUL": HANGUL, "CJK": HAN, "LATIN": LATIN}
    for code in range(_TABLED):
        char = chr(code)
        if char.isalpha() or unicodedata.category(char)[0] == "M":
            name = unicodedata.name(char, "").split(" ")[0]
            if char.isalpha() or name in known:
                out[code] = known.setdefault(name, min(len(set(known.values())) + 1, 255))
    return out


def scripts_of(texts: list[str]) -> np.ndarray:
    """The script that most of each text is in: kana also where it is a tenth beside Han; a letter of an alphabet says a third as much."""
    if not texts:
        return np.zeros(0, dtype=np.int64)
    joined = "".join(texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    script = _scripts()[np.minimum(codes, _TABLED - 1)].astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts)))
    width = int(script.max()) + 1 if len(script) else 1
    width = max(width, LATIN + 1)
    counts = np.bincount(owner * width + script, minlength=len(texts) * width).reshape(len(texts), width)
    counts[:, NOTHING] = 0
    japanese = counts[:, KANA] > 0.1 * (counts[:, KANA] + counts[:, HAN])
    counts[japanese, KANA] += counts[japanese, HAN]
    counts[japanese, HAN] = 0
    counts[:, LATIN:] //= 3
    return np.where(counts.any(axis=1), counts.argmax(axis=1), LATIN)


class LanguageModel:
    """Frozen byte statistics of several languages; scores whole arrays of texts."""

    def __init__(self, samples: dict[str, list[str]]):
        self.languages = sorted(samples)
        count = len(self.languages)
        written = np.array([np.bincount(scripts_of(samples[name]), minlength=256) for name in self.languages])
        self.possible = written >= SCRIPT_SHARE * written.sum(axis=1, keepdims=True)  # languages by scripts
        laid = [_layout([s.lower().encode() for s in samples[name]]) for name in self.languages]
        self.tables: list[_Table] = []
        self.values: list[np.ndarray] = []
        self.contexts: list[_Table | None] = []
        self.escapes: list[np.ndarray | None] = []
        before_keys = before_values = None
        for order in range(ORDER + 1):
            found = [np.unique(_grams(d, order + 1, p), return_counts=True) for d, p, _ in laid]
            keys = np.unique(np.concatenate([k for k, _ in found]))
            counts = np.zeros((len(keys), count))
            for at, (k, n) in enumerate(found):
                counts[np.searchsorted(keys, k), at] = n
            own = keys >> np.uint64(8)
            contexts, which = np.unique(own, return_inverse=True)
            total = np.zeros((len(contexts), count))
            kinds = np.zeros((len(contexts), count))
            np.add.at(total, which, counts)
            np.add.at(kinds, which, counts > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, np.log2(np.where(total > 0, kinds / (total + kinds), 1)), 0.0)
                seen = np.log2(counts / (total + kinds)[which])
            if order == 0:
                lower = np.full((len(keys), count), -8.0)
            else:
                shorter = keys & np.uint64((1 << (8 * order)) - 1)
                lower = before_values[np.searchsorted(before_keys, shorter)]
            values = np.where(counts > 0, seen, escape[which] + lower)
            before_keys, before_values = keys, values
            self.tables.append(_Table(keys))
            self.values.append(values.astype(np.float32))
            self.contexts.append(_Table(contexts))
            self.escapes.append(escape.astype(np.float32))

    def code_lengths(self, texts: list[str]) -> np.ndarray:
        """Bits to code each text in each language, an array of texts by languages."""
        out = np.zeros((len(texts), len(self.languages)))
        coded = [t.lower().encode("utf-8", "replace") for t in texts]  # capitals say nothing about the language
        begin, room = 0, 0
        for at in range(len(coded) + 1):
            if at == len(coded) or room > 1 << 18:
                if at > begin:
                    out[begin:at] = self._score(coded[begin:at])
                begin, room = at, 0
            if at < len(coded):
                room += len(coded[at])
        return out

    def _score(self, texts: list[bytes]) -> np.ndarray:
        data, places, firsts = _layout(texts)
        bits = np.zeros((len(places) + 1, len(self.languages)), dtype=np.float32)
        left = np.arange(len(places))
        for order in range(ORDER, -1, -1):
            keys = _grams(data, order + 1, places[left])
            rows = self.tables[order].find(keys)
            hit = rows >= 0
            bits[left[hit]] += self.values[order][rows[hit]]
            left, keys = left[~hit], keys[~hit]
            if not len(left):
                break
            known = self.contexts[order].find(keys >> np.uint64(8))
            some = known >= 0
            bits[left[some]] += self.escapes[order][known[some]]
        bits[left] -= 8.0
        sums = np.add.reduceat(bits, firsts, axis=0)
        empty = np.array([not t for t in texts])
        sums[empty] = 0
        return -sums

    def classify(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The language of each text, its probability, and the bits by which it beats the next language.

        A text in a script that none of the languages is written in is ``UNKNOWN``.
        """
        if not texts:
            return [], np.zeros(0), np.zeros(0)
        bits = self.code_lengths(texts)
        possible = self.possible[:, scripts_of(texts)].T
        foreign = ~possible.any(axis=1)
        possible[foreign] = True
        bits = np.where(possible, bits, bits + 1e6)
        best = bits.argmin(axis=1)
        ordered = np.sort(bits, axis=1)
        margin = ordered[:, 1] - ordered[:, 0] if bits.shape[1] > 1 else np.full(len(texts), 99.0)
        scaled = np.exp2(-np.minimum(bits - ordered[:, :1], 500))
        names = [UNKNOWN if f else self.languages[i] for i, f in zip(best, foreign)]
        return names, np.where(foreign, UNKNOWN_SURE, 1 / scaled.sum(axis=1)), margin


# Sentence ends and what isn't running text.
SENTENCE = re.compile(r"[^。！？!?\n.]*(?:[。！？!?]+|\n+|\.(?!\S)\s*|\.(?=[^\x00-\x7f])|\.|$)")
MARKUP = re.compile(r"</?think>|```\w*|[*#>`_|{}\[\]\"]+|&\w{0,6};?|</?\w*>?")
WORD = re.compile(r"[^\W\d_](?:[^\W\d_]|[\u0300-\u036f\u0900-\u0dff\u0e00-\u0eff'’])*")
LATIN_WORD = re.compile(r"[A-Za-zÀ-ÿ'’]{1,}")
OTHER_SCRIPT = re.compile(r"[\u0370-\u1fff]")
FOUR_EAST_ASIAN = re.compile(r"(?:[^぀-ヿ㐀-鿿가-힯]*[぀-ヿ㐀-鿿가-힯]){4}")
LATIN_START = re.compile(r"[A-Za-zÀ-ÿ]")
LATIN_LANGUAGES = frozenset({"en", "de", "fr", "es"})


def sentences(text: str) -> list[str]:
    """The sentences of a text, without markup; a full stop inside a number or address doesn't end one."""
    return list(_sentences(text))


def _sentences(text: str) -> Iterator[str]:
    held = ""
    for found in SENTENCE.finditer(MARKUP.sub(" ", text)):
        piece = found.group()
        held += piece
        if piece.endswith(".") and held[-2:-1].isdigit() or len(held.strip()) < 2:
            continue
        if held.strip():
            yield held.strip()
        held = ""
    if held.strip():
        yield held.strip()


def is_running(sentence: str) -> bool:
    """Whether a sentence, or its cut beginning, is running text: not a lone term, mark, dose or placeholder."""
    if FOUR_EAST_ASIAN.match(sentence):
        return True
    if OTHER_SCRIPT.search(sentence):
        words = WORD.findall(sentence)
        if sum(len(w) for w in words if OTHER_SCRIPT.match(w)) >= 8:
            return True
    words = LATIN_WORD.findall(sentence)
    if sentence.isupper():
        return len(words) >= 4
    return len(words) >= 3 and sum(map(len, words)) >= 8 and sum(w[:1].islower() for w in words) >= 2


def _pieces(sentence: str) -> list[str]:
    """A sentence, cut where a stretch of Latin words stands beside East Asian text."""
    if not FOUR_EAST_ASIAN.match(sentence) or not LATIN_START.search(sentence):
        return [sentence]
    runs = re.split(r"((?:[A-Za-zÀ-ÿ'’,;:()\d%-]+[ ]+){4,}[A-Za-zÀ-ÿ'’.]+)", sentence)
    return [r for r in runs if r.strip()]


def running_pieces(text: str) -> Iterator[str]:
    """The pieces of a text that are scored, each cut when it is asked for."""
    for sentence in _sentences(text):
        yield from filter(is_running, _pieces(sentence))


def segment_languages(model: LanguageModel, texts: list[str]) -> list[list[tuple[str, str, float]]]:
    """For each text its segments ``(segment, language, confidence)``; neighbours in one language are one segment.

    A sentence whose language is in doubt (under ``SURE_BITS``) takes that of the sentence before it, or else after it, if it
    is written in the same script.
    """
    flat, owner = [], []
    for at, text in enumerate(texts):
        for piece in running_pieces(text or ""):
            flat.append(piece)
            owner.append(at)
    once = list(dict.fromkeys(flat))  # equal sentences are scored once
    where = dict(zip(once, range(len(once))))
    index = [where[piece] for piece in flat]
    names, sure, margin = model.classify(once)
    names, sure, margin = [names[i] for i in index], sure[index], margin[index]
    out: list[list[tuple[str, str, float]]] = [[] for _ in texts]
    for at, name in enumerate(names):
        if margin[at] < SURE_BITS:
            for near in (at - 1, at + 1):
                if 0 <= near < len(names) and owner[near] == owner[at] and margin[near] >= SURE_BITS:
                    if (names[near] in LATIN_LANGUAGES) == (name in LATIN_LANGUAGES):
                        name = names[near]
                        break
        own = out[owner[at]]
        if own and own[-1][1] == name:
            own[-1] = (own[-1][0] + " " + flat[at], name, max(own[-1][2], float(sure[at])))
        else:
            own.append((flat[at], name, float(sure[at])))
    return out


def label_code(label: Column) -> Column:
    """The main language code of a label in lower case; null for null, "", und and blank labels."""
    code = F.lower(F.trim(F.regexp_extract(label, r"^\s*([A-Za-z]+)", 1)))
    return F.when((code != "") & (code != "und"), code)


def training_sentences(texts: DataFrame, keys: list[str], label: str, text: str, most: int = TRAIN_SENTENCES) -> tuple[dict[str, list[str]], dict[str, int]]:
    """At most ``most`` sentences of each label, spread over all texts, and how many each has; labels with under 20 are left out.

    The bounded sample only fits the classifier.  It is picked by the hash of a sentence's place, so frequent sentences
    are as frequent in it and wrongly labelled ones as rare, and by a grouped minimum, which combines before the
    shuffle, so no group is ever gathered whole.
    """
    cut = texts.filter(F.col(label).isNotNull() & F.col(text).isNotNull()).select(
        *keys, F.col(label).alias("label"), F.posexplode(F.split(text, r"(?<=[。！？!?\n])|(?<=[.])\s")).alias("_at", "sentence")
    )
    cut = cut.filter(F.length("sentence").between(12, LONGEST)).withColumn("_hash", F.xxhash64(*keys, "_at"))
    picked = cut.groupBy("label", F.pmod("_hash", F.lit(most)).alias("_slot")).agg(
        F.min_by("sentence", "_hash").alias("sentence"), F.count("*").alias("count")
    )
    found: dict[str, list[str]] = {}
    whole: dict[str, int] = {}
    for row in picked.select("label", "sentence", "count").collect():  # at most `most` rows a label
        found.setdefault(row["label"], []).append(row["sentence"])
        whole[row["label"]] = whole.get(row["label"], 0) + row["count"]
    return {k: sorted(v) for k, v in found.items() if len(v) >= 20}, {k: whole[k] for k, v in found.items() if len(v) >= 20}


def fit(samples: dict[str, list[str]], whole: dict[str, int], rounds: int = 2) -> LanguageModel:
    """A model fitted to sentences with unreliable labels.

    Each half of the sentences is judged by a model of the other half, so that no sentence vouches for its own label.
    One that another language codes clearly shorter is dropped, and the rest is judged again.  Sentences that occur
    under several labels are dropped where they are far rarer.  ``whole`` has the number of sentences of each label:
    what is wrongly labelled comes mostly from the frequent ones.
    """
    times: dict[str, dict[str, int]] = {}
    for label, own in samples.items():
        for sentence in own:
            of = times.setdefault(re.sub(r"\d+", "0", sentence), {})
            of[label] = of.get(label, 0) + 1
    weight = {label: whole[label] / len(own) for label, own in samples.items()}

    def elsewhere(sentence: str, label: str) -> bool:
        of = times[re.sub(r"\d+", "0", sentence)]
        return any(n >= 3 and n * weight[x] > 3 * of[label] * weight[label] for x, n in of.items() if x != label)

    samples = {label: [s for s in own if not elsewhere(s, label)] or own for label, own in samples.items()}
    for _ in range(rounds):
        halves = [{label: own[at::2] for label, own in samples.items()} for at in (0, 1)]
        models = [LanguageModel(half) for half in halves]
        kept: dict[str, list[str]] = {}
        for half, other in zip(halves, reversed(models)):
            for label, own in half.items():
                bits = other.code_lengths(own) if own else np.zeros((0, 1))
                mine = bits[:, other.languages.index(label)] - bits.min(axis=1) if own else []
                kept.setdefault(label, []).extend(s for s, more in zip(own, mine) if more <= DISPUTED_BITS)
        samples = {label: sorted(kept[label]) or own for label, own in samples.items()}
    return LanguageModel(samples)


def detect(texts: DataFrame, columns: list[str], text: str, model: LanguageModel) -> DataFrame:
    """Rows ``(*columns, segment_no, segment, language, confidence)`` for every segment of every text.

    Null, empty and blank texts and texts without running text (lone terms, marks, doses, placeholders) give no rows;
    running text in a script of none of the model's languages is ``UNKNOWN``.  Very long texts are scored whole, in
    chunks.
    """
    sent = texts.sparkSession.sparkContext.broadcast(model)  # bounded by the training sample

    def run(batches):
        for batch in batches:
            found = segment_languages(sent.value, batch[text].tolist())
            at = np.repeat(np.arange(len(batch)), [len(f) for f in found])
            rows = [s for f in found for s in f]
            out = batch[columns].iloc[at].reset_index(drop=True)
            out["segment_no"] = np.concatenate([np.arange(len(f)) for f in found]) if rows else np.zeros(0, dtype="int64")
            for name, column in zip(("segment", "language", "confidence"), zip(*rows) if rows else ([], [], [])):
                out[name] = pd.Series(list(column), dtype="float64" if name == "confidence" else "object")
            yield out

    slim = texts.select(*columns, text).filter(F.col(text).isNotNull())
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.select(*columns).schema)
    return slim.mapInPandas(run, f"{schema}, segment_no bigint, segment string, language string, confidence double")
