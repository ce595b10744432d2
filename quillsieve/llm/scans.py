"""Repair of text from scanned pages: an averaged-perceptron character editor.

For every character the editor predicts one operation: keep, delete (page furniture), join (a line break, blank or hyphen
inside a word), replace by another character, or insert one before it.  What it knows of the corpus is counted over all
texts: which character triples typed texts have, which strings recur on scanned pages only (running heads), and which
characters stand where typed texts have another one (confusions).  The perceptron itself is trained on a bounded sample of
typed texts, damaged on purpose with those heads and confusions.  Its features are the neighbouring characters, with and
without the breaks between them, their types, and the place on the page: line length, place in the line, and whether a
string recurs on scanned pages only.

Texts are laid out one behind the other in arrays of code points, so features and scores of a whole batch are computed at
once: a feature is a row of one weight table.
"""

from __future__ import annotations

import random
import re
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsieve.llm.language import _Table
from quillsieve.operators.sample import bounded_rows
from quillsieve.session import spread

#: Typed texts that are damaged to train the perceptron, at most; passes over them; texts between two updates.
TRAIN_TEXTS, PASSES, UPDATE_TEXTS = 2500, 5, 2
#: Texts, and share of the scanned texts, that a string must recur in to be furniture.
RECURS, RECURS_SHARE = 3, 0.0005
#: Times that a string must be more frequent than a longer one for the longer one to be chance.
LENGTHENED = 4
#: Share of the typed texts' number that a triple must reach to be known; it bounds the table by text length over share.
TYPED_SHARE = 2e-5
#: Share of the scanned texts' number that a pair must reach to be foreign to typed texts.
FOREIGN_SHARE = 1e-4
#: Share of its votes that a confusion's right character needs; so a character has at most five.
AGREED = 0.2
#: Rows of the weight table, as a power of two, and characters scored at once.
BITS, CHUNK = 19, 1 << 17

# Characters that recognition takes for Latin letters and digits.
LOOKALIKES = {"l": "1", "I": "1", "O": "0", "o": "0", "q": "g", "S": "5", "B": "8", "Z": "2"}
BREAKS = frozenset(" \n\r\t　­")
KEEP, DELETE, JOIN, INSERT, REPLACE = range(5)
BEFORE, AFTER = "\x01\x01", "\x02\x02"  # stand on either side of a text
EDGE, HAN, DIGIT, LETTER, NEWLINE, WIDE, BLANK, DASH, OTHER = range(9)
CLOSING = ord("）")
_TABLED = 0x30000
_STEP, _MIX = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)
_PAIR, _TRIPLE = np.uint64(21), np.uint64(42)


@lru_cache(maxsize=1)
def _character_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Type, decimal digit or not, and blank or not, of each character."""
    kinds = np.full(_TABLED, OTHER, dtype=np.uint8)
    decimal, space = np.zeros(_TABLED, dtype=bool), np.zeros(_TABLED, dtype=bool)
    for code in range(_TABLED):
        char = chr(code)
        decimal[code], space[code] = char.isdecimal(), char.isspace()
        if "㐀" <= char <= "鿿":
            kinds[code] = HAN
        elif char.isdigit():
            kinds[code] = DIGIT
        elif char.isalpha():
            kinds[code] = LETTER
        elif char in "\n\r":
            kinds[code] = NEWLINE
        elif char == "　":
            kinds[code] = WIDE
        elif char in BREAKS:
            kinds[code] = BLANK
        elif char in "-—·":
            kinds[code] = DASH
    kinds[[1, 2]] = EDGE
    return kinds, decimal, space


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)


def _triples(codes: np.ndarray) -> np.ndarray:
    """Every three neighbouring code points in one integer; the array is two shorter."""
    return (codes[:-2] << _TRIPLE) | (codes[1:-1] << _PAIR) | codes[2:]


def _unpack(key: int) -> str:
    return "".join(chr(key >> shift & 0x1FFFFF) for shift in (42, 21, 0))


class _Layout:
    """Texts one behind the other, with two edge marks on either side of each, and what stands beside each character."""

    def __init__(self, texts: list[str]):
        kinds, decimal, space = _character_tables()
        self.joined = "".join(f"{BEFORE}{t}{AFTER}" for t in texts)
        self.raw = _codes(self.joined)
        sizes = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
        self.starts = np.cumsum(sizes + 4) - sizes - 2
        self.ends = self.starts + sizes
        small = np.minimum(self.raw, _TABLED - 1)
        self.kind, self.space = kinds[small], space[small]
        self.decimal = decimal[small]
        self.masked = np.where(self.decimal, np.uint64(ord("0")), self.raw)
        self.real = np.ones(len(self.raw), dtype=bool)
        for edge in (self.starts - 2, self.starts - 1, self.ends, self.ends + 1):
            self.real[edge] = False
        self.seen = ~np.isin(self.kind, (NEWLINE, WIDE, BLANK))
        self.rank = np.cumsum(self.seen) - self.seen  # visible characters before each
        self.visible = self.masked[self.seen]
        self.owner = np.repeat(np.arange(len(texts)), sizes + 4)

    def visible_triples(self) -> np.ndarray:
        return _triples(self.visible)


class Editor:
    """The editor: corpus statistics and a weight table; the ``learn`` and ``train`` methods write to it."""

    def __init__(self):
        self.typed = _Table(np.zeros(0, dtype=np.uint64))
        self.heads: list[str] = []
        self.only = _Table(np.zeros(0, dtype=np.uint64))
        self.confusions: dict[int, tuple[int, ...]] = {ord(a): (ord(b),) for a, b in LOOKALIKES.items()}
        self.weights = np.zeros((1 << BITS, 5), dtype=np.float32)

    # -- corpus statistics ------------------------------------------------------------------------------------------

    def learn_grams(self, grams: pd.DataFrame) -> None:
        """``grams``: ``(what, key, typed, scanned)``: known triples of typed texts, strange triples and pairs of scanned ones."""
        known = np.sort(grams.loc[grams["what"] == "packed", "key"].to_numpy().astype(np.uint64))
        self._sorted = known
        self.typed = _Table(known)
        middle = (known >> _PAIR) & np.uint64(0x1FFFFF)
        self._common = np.unique(middle)
        around = ((known >> _TRIPLE) << _PAIR) | (known & np.uint64(0x1FFFFF))
        order = np.argsort(around, kind="stable")
        self._around, self._between = around[order], middle[order]
        self._foreign = _Table(grams.loc[grams["what"] == "pair", "key"].to_numpy().astype(np.uint64))
        self._strange = [_unpack(k) for k in sorted(grams.loc[grams["what"] == "raw", "key"])]

    def votes(self, texts: list[str]) -> pd.DataFrame:
        """Rows ``(char, other, n)``: how often a strange character of scanned texts stands where typed ones have another.

        A character that typed texts have too only counts beside a neighbour that it often has on scanned pages and
        never in typed texts: words that are merely new don't recur.
        """
        page = _Layout(texts)
        line = page.visible
        kinds = _character_tables()[0][np.minimum(line, _TABLED - 1)]
        known = np.zeros(len(line) + 2, dtype=bool)
        known[2 : len(line)] = self.typed.find(page.visible_triples()) >= 0
        at = np.arange(2, max(2, len(line) - 2))
        at = at[np.isin(kinds[at], (HAN, LETTER)) & ~(known[at] | known[at + 1] | known[at + 2])]
        pair = lambda a, b: self._foreign.find((line[a] << _PAIR) | line[b]) >= 0
        both = (kinds[at - 1] == HAN) & (kinds[at] == HAN), (kinds[at + 1] == HAN) & (kinds[at] == HAN)
        beside = pair(at - 1, at) & both[0] | pair(at, at + 1) & both[1]
        at = at[~np.isin(line[at], self._common) | beside]
        around = (line[at - 1] << _PAIR) | line[at + 1]
        low, high = np.searchsorted(self._around, around), np.searchsorted(self._around, around, side="right")
        place = np.repeat(at, high - low)
        other = self._between[np.arange(len(place)) - np.repeat(np.cumsum(high - low) - high, high - low)] if len(place) else self._between[:0]
        agree = self._known_with(line, place, other) >= 2
        agree &= _character_tables()[0][np.minimum(other, _TABLED - 1)] == kinds[place]
        pairs, n = np.unique((line[place[agree]] << _PAIR) | other[agree], return_counts=True)
        return pd.DataFrame({"char": (pairs >> _PAIR).astype(np.int64), "other": (pairs & np.uint64(0x1FFFFF)).astype(np.int64), "n": n})

    def _known_with(self, line: np.ndarray, place: np.ndarray, other: np.ndarray) -> np.ndarray:
        """How many of the three triples are known with ``other`` at ``place``."""
        a, b, d, e = (line[place + k] for k in (-2, -1, 1, 2))
        found = [(a << _TRIPLE) | (b << _PAIR) | other, (b << _TRIPLE) | (other << _PAIR) | d, (other << _TRIPLE) | (d << _PAIR) | e]
        return sum((self.typed.find(key) >= 0).astype(np.int64) for key in found)

    def learn_confusions(self, votes: pd.DataFrame) -> None:
        """``votes``: ``(char, other, n)`` of the right characters that have their share of the votes."""
        found: dict[int, tuple[int, ...]] = {}
        for char, own in votes.sort_values(["char", "n", "other"], ascending=[True, False, True]).groupby("char"):
            found[int(char)] = tuple(int(o) for o in own["other"])
        for char, other in LOOKALIKES.items():
            found[ord(char)] = tuple(dict.fromkeys((*found.get(ord(char), ()), ord(other))))
        self.confusions = found
        # a furniture string recurs with different text beside it; a misread word is one character from a typed one
        strange = [g for g in self._strange if self._is_strange(g)]
        self.only = _Table(np.array([int(_triples(_codes(g))[0]) for g in strange], dtype=np.uint64))

    def _is_strange(self, gram: str) -> bool:
        packed = "".join(c for c in gram if c not in BREAKS)
        if re.search(r"[\n\r 0\x01\x02]", gram) or len(packed) < 3 and gram == gram.strip():
            return False
        if len(packed) < 3:
            return True
        near = [packed]
        for at, char in enumerate(packed):
            near += [packed[:at] + chr(other) + packed[at + 1 :] for other in self.confusions.get(ord(char), ())]
        return not (self.typed.find(np.array([int(_triples(_codes(g))[0]) for g in near], dtype=np.uint64)) >= 0).any()

    def _is_torn(self, head: str) -> bool:
        """Whether a string is only a phrase of typed texts with a break in it or one character misread."""
        packed = _codes("".join(c for c in re.sub(r"\d", "0", head) if c not in BREAKS))
        if len(packed) < 3:
            return False
        if (self.typed.find(_triples(packed)) >= 0).any():
            return True
        for at in range(1, len(packed) - 1):
            around = (packed[at - 1] << _PAIR) | packed[at + 1]
            others = self._between[np.searchsorted(self._around, around) : np.searchsorted(self._around, around, side="right")]
            for other in others:
                mended = packed.copy()
                mended[at] = other
                if (self.typed.find(_triples(mended)) >= 0).all():
                    return True
        return False

    def runs(self, texts: list[str]) -> pd.DataFrame:
        """Rows ``(head, n)``: strings of four characters or more made of strange triples, and how often they occur."""
        page = _Layout(texts)
        flags = self._only_flags(page).astype(np.int8)
        edges = np.flatnonzero(np.diff(np.concatenate([[0], flags, [0]])))
        found = [page.joined[a:b].strip() for a, b in zip(edges[::2], edges[1::2])]
        counted = pd.Series([h for h in found if len(h) >= 4], dtype="object").value_counts()
        return pd.DataFrame({"head": counted.index.astype("object"), "n": counted.to_numpy().astype(np.int64)})

    def learn_heads(self, heads: dict[str, int]) -> None:
        """``heads``: recurring strings and how often each occurs; one that only lengthens a far more frequent one isn't a head."""
        longer = {h for h, n in heads.items() if any(g != h and g in h and m > LENGTHENED * n for g, m in heads.items())}
        self.heads = sorted(h for h in heads if h not in longer and not self._is_torn(h))
        masked = [re.sub(r"\d", "0", h) for h in self.heads]
        keys = [_triples(_codes(h)) for h in masked]
        own = np.unique(np.concatenate(keys)) if keys else np.zeros(0, dtype=np.uint64)
        self.only = _Table(own[self.only.find(own) >= 0])

    # -- features ---------------------------------------------------------------------------------------------------

    def _only_flags(self, page: _Layout) -> np.ndarray:
        """Characters that are part of a string which recurs on scanned pages only."""
        hit = np.zeros(len(page.masked) + 2, dtype=bool)
        hit[2 : len(page.masked)] = self.only.find(_triples(page.masked)) >= 0 if len(page.masked) > 2 else False
        return hit[:-2] | hit[1:-1] | hit[2:]

    def _lines(self, page: _Layout) -> tuple[np.ndarray, ...]:
        """For each character: whether its line is a number, its length, whether it has a wide blank, its first and last place."""
        size = len(page.raw)
        begins = np.zeros(size, dtype=bool)
        begins[page.starts - 2] = begins[page.starts] = begins[page.ends] = True
        begins[1:] |= page.raw[:-1] == ord("\n")
        first = np.flatnonzero(begins)
        of = np.cumsum(begins) - 1
        place = np.arange(size)
        filled = ~page.space & page.real
        low = np.minimum.reduceat(np.where(filled, place, size), first)
        high = np.maximum.reduceat(np.where(filled, place, -1), first)
        length = np.maximum(high - low + 1, 0)
        plain = (page.kind == HAN) & (page.raw != ord("第")) & (page.raw != ord("页"))
        latin = (page.kind == LETTER) & (page.raw < 128)
        latin[:-1] &= ~((page.raw[:-1] == ord("P")) & (page.raw[1:] == ord(".")))
        words = np.add.reduceat((plain | latin | np.isin(page.raw, _codes(",，;；、"))).astype(np.int64), first)
        digits = (words == 0) & (length > 0) & (np.add.reduceat(page.decimal.astype(np.int64), first) > 0)
        wide = np.add.reduceat((page.kind == WIDE).astype(np.int64), first) > 0
        last = np.concatenate([first[1:] - 1, [size - 1]])
        return digits[of], np.minimum(length, 12)[of], wide[of], place == first[of], place == last[of]

    def _near(self, page: _Layout, pattern: str, kept: np.ndarray) -> np.ndarray:
        """Characters with a match of ``pattern`` wholly within six characters on either side, counting those of ``kept``."""
        at = np.flatnonzero(kept | ~page.real)
        text = page.raw[at].astype(np.uint32).tobytes().decode("utf-32-le", "surrogatepass")
        marks = np.zeros(len(at) + 1, dtype=np.int64)
        spans = np.array([m.span() for m in re.finditer(pattern, text)], dtype=np.int64).reshape(-1, 2)
        own = page.owner[at]
        low, high = spans[:, 1] - 7, spans[:, 0] + 7
        ends = np.searchsorted(own, own[spans[:, 0]], side="right") if len(spans) else high
        begins = np.searchsorted(own, own[spans[:, 0]]) if len(spans) else low
        np.add.at(marks, np.maximum(low, begins), 1)
        np.add.at(marks, np.minimum(high, ends), -1)
        out = np.zeros(len(page.raw), dtype=bool)
        out[at] = np.cumsum(marks)[:-1] > 0
        return out

    def _look(self, texts: list[str]) -> dict[str, np.ndarray]:
        """Features of each character: rows of the weight table, and what the candidates are made from."""
        page = _Layout(texts)
        known = np.zeros(len(page.visible) + 4, dtype=np.int8)
        if len(page.visible) > 2:
            known[2 : len(page.visible)] = self.typed.find(page.visible_triples()) >= 0
        at = np.flatnonzero(page.real)
        rank, seen = page.rank[at], page.seen[at]
        own = known[rank] + known[rank + 1] + known[rank + 2] * seen
        left2, left = page.visible[rank - 2], page.visible[rank - 1]
        right, right2 = page.visible[rank + seen], page.visible[rank + seen + 1]
        only = self._only_flags(page)
        digits, length, wide, starts, ends = (x[at] for x in self._lines(page))
        kinds = _character_tables()[0]
        kind, char, m = page.kind[at].astype(np.uint64), page.raw[at], page.masked
        of = lambda codes: kinds[np.minimum(codes, _TABLED - 1)]
        paged = self._near(page, r"第[0-9]+页|P[.][0-9]", page.real)[at]
        cited = self._near(page, "见第|看P", page.seen & ~only)[at]  # a citation goes on behind furniture
        shared = [
            self._rows(0),
            self._rows(1, kind, own),
            self._rows(2, page.kind[at - 1], kind, page.kind[at + 1], own),
            self._rows(3, only[at], only[at - 1], only[at + 1], kind),
            self._rows(4, digits, kind, length),
            self._rows(5, digits, wide, kind, starts, ends),
            self._rows(6, kind, of(left), of(right), own),
        ]
        alone = [
            self._rows(7, char),
            self._rows(8, m[at - 1], m[at]),
            self._rows(9, m[at], m[at + 1]),
            self._rows(10, m[at - 1], m[at], m[at + 1]),
            self._rows(11, m[at - 2], m[at - 1], m[at]),
            self._rows(12, m[at], m[at + 1], m[at + 2]),
            self._rows(13, left, right),
            self._rows(14, paged, cited, kind),
        ]
        size = len(at)
        rows = np.stack([np.broadcast_to(r, size) for r in shared + alone], axis=1)
        doubtful = seen & (own < 3)
        gap = np.zeros(size, dtype=bool)
        for mark in (CLOSING, ord(")")):
            spot = np.flatnonzero(doubtful)
            key = (left[spot] << _TRIPLE) | (np.uint64(mark) << _PAIR) | page.masked[at][spot]
            gap[spot] |= self.typed.find(key) >= 0
        spots, others = self._readings(char, doubtful)
        line, place = page.visible, rank[spots]
        new = self._known_with(line, place, others)
        gain = new - own[spots] + 3
        reading = np.stack([self._rows(15, own[spots], new), self._rows(16, char[spots], others), self._rows(17, gain, kind[spots])], axis=1)
        joins = ~seen | np.isin(char, _codes("-‐‑"))
        bounds = np.concatenate([[0], np.cumsum(page.ends - page.starts)])
        return {
            "bounds": bounds, "rows": rows, "joins": joins, "gap": gap, "spots": spots, "others": others,
            "reading": np.concatenate([rows[spots, : len(shared)], reading], axis=1), "only": only[at],
        }

    def _rows(self, template: int, *values: np.ndarray) -> np.ndarray:
        """Rows of the weight table for one feature template with these values."""
        mixed = np.array([template + 1], dtype=np.uint64) * _MIX
        for value in values:
            mixed = (mixed ^ np.asarray(value).astype(np.uint64)) * _STEP
        mixed = (mixed ^ (mixed >> np.uint64(29))) * _MIX
        return (mixed >> np.uint64(64 - BITS)).astype(np.int32)

    def _readings(self, char: np.ndarray, doubtful: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and the characters that may have been misread there."""
        if not self.confusions:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        misread = np.array(sorted(self.confusions), dtype=np.uint64)
        sizes = np.array([len(self.confusions[int(c)]) for c in misread])
        flat = np.array([o for c in misread for o in self.confusions[int(c)]], dtype=np.uint64)
        spot = np.flatnonzero(doubtful & np.isin(char, misread))
        which = np.searchsorted(misread, char[spot])
        times = sizes[which]
        inner = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        return np.repeat(spot, times), flat[np.repeat((np.cumsum(sizes) - sizes)[which], times) + inner]

    def _decide(self, look: dict[str, np.ndarray], low: int, high: int, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Operation, the reading chosen (an index of ``spots``, else -1) and the candidates, for the characters from ``low`` to ``high``."""
        scores = np.zeros((high - low, 5), dtype=np.float32)
        rows = look["rows"][low:high]
        for column in range(rows.shape[1]):
            scores += weights[rows[:, column]]
        scores[~look["joins"][low:high], JOIN] = -np.inf
        scores[~look["gap"][low:high], INSERT] = -np.inf
        scores[:, REPLACE] = -np.inf
        first, last = np.searchsorted(look["spots"], [low, high])
        chosen = np.full(high - low, -1, dtype=np.int64)
        if last > first:
            own = weights[look["reading"][first:last], REPLACE].sum(axis=1)
            spots = look["spots"][first:last] - low
            order = np.lexsort((-np.arange(len(own)), own, spots))  # the best of each place comes last
            best = order[np.append(spots[order][1:] != spots[order][:-1], True)]
            scores[spots[best], REPLACE] = own[best]
            chosen[spots[best]] = first + best
        ops = scores.argmax(axis=1)
        return ops, np.where(ops == REPLACE, chosen, -1), scores > -np.inf

    # -- training ---------------------------------------------------------------------------------------------------

    def train(self, typed: list[str], seed: int = 7) -> "Editor":
        """Train the perceptron on typed texts, damaged as the scanned ones are."""
        rng = random.Random(seed)
        texts = [self._damage(t, rng) for t in rng.sample(sorted(typed), min(len(typed), TRAIN_TEXTS))]
        texts = [t for t in texts if t[0]]
        look = self._look([t for t, _ in texts])
        gold = np.array([o for _, ops in texts for o, _ in ops], dtype=np.int64)
        right = np.array([c for _, ops in texts for _, c in ops], dtype=np.uint64)
        wanted = np.full(len(gold), -1, dtype=np.int64)  # the reading that is right
        spot, hit = look["spots"], look["others"] == right[look["spots"]]
        wanted[spot[hit]] = np.flatnonzero(hit)
        weights, later = np.zeros((1 << BITS, 5), dtype=np.float32), np.zeros((1 << BITS, 5), dtype=np.float32)
        step = 1
        blocks = np.arange(0, len(texts), UPDATE_TEXTS)
        passes = max(PASSES, min(20, 2 * TRAIN_TEXTS // max(1, len(texts))))
        for _ in range(passes):
            rng.shuffle(blocks)
            for block in blocks:
                low, high = look["bounds"][block], look["bounds"][min(block + UPDATE_TEXTS, len(texts))]
                ops, chosen, possible = self._decide(look, low, high, weights)
                want = gold[low:high]
                mine = np.where(want == REPLACE, wanted[low:high], -1)
                wrong = (ops != want) | (want == REPLACE) & (chosen != mine)
                wrong &= possible[np.arange(high - low), want] & ((want != REPLACE) | (mine >= 0))
                for at in np.flatnonzero(wrong):
                    for op, reading, change in ((want[at], mine[at], 1.0), (ops[at], chosen[at], -1.0)):
                        rows = look["reading"][reading] if op == REPLACE else look["rows"][low + at]
                        np.add.at(weights, (rows, op), change)
                        np.add.at(later, (rows, op), change * step)
                step += 1
        self.weights = weights - later / step  # the average over all steps
        return self

    def fit(self, typed: list[str], scanned: list[str], seed: int = 7) -> "Editor":
        """The same without Spark, for texts that are at hand: statistics of all texts, then training."""
        counted = gram_counts([*typed, *scanned], np.arange(len(typed) + len(scanned)) >= len(typed))
        counted = counted.groupby(["what", "key"], as_index=False).sum()
        self.learn_grams(counted[_wanted(counted, len(typed), len(scanned))])
        votes = self.votes(scanned)
        self.learn_confusions(votes[votes["n"] >= AGREED * votes.groupby("char")["n"].transform("sum")])
        heads = self.runs(scanned)
        heads = heads[heads["n"] >= max(RECURS, RECURS_SHARE * len(scanned))]
        self.learn_heads(dict(zip(heads["head"], heads["n"])))
        return self.train([t for t in typed if len(t) > 1], seed)

    def _damage(self, text: str, rng: random.Random) -> tuple[str, list[tuple[int, int]]]:
        """A damaged text and, for each of its characters, the operation that mends it and the right character."""
        chars: list[str] = []
        ops: list[tuple[int, int]] = []
        back = defaultdict(list)
        for misread, others in self.confusions.items():
            for other in others:
                back[chr(other)].append(chr(misread))
        letter = lambda c: "㐀" <= c <= "鿿"
        spots = set(rng.sample(range(1, max(2, len(text))), min(3, max(1, len(text) - 1)))) if len(text) > 3 else set()
        dirty = rng.random() < 0.7
        rate = rng.choice((0.0, 0.02, 0.08)) if dirty else 0.0
        wrong = rng.choice((0.0, 0.03, 0.08)) if dirty else 0.0
        lost = -1
        for at, char in enumerate(text):
            if dirty and at in spots and rng.random() < 0.5:
                number = str(rng.randint(1, 600))
                if rng.random() < 0.5:
                    body = rng.choice(("\n{}\n", "\n— {} —\n", "\n- {} -\n", "\n·{}·\n", "\n第{}页\n", " P.{}\n")).format(number)
                    body = body.translate(str.maketrans("0123456789", "０１２３４５６７８９")) if rng.random() < 0.15 else body
                elif self.heads:
                    body = rng.choice(("\n{}\n", "\n　{}　\n", "{}\n", "\n{}")).format(rng.choice(self.heads))
                else:
                    body = ""
                chars += body
                ops += [(DELETE, 0)] * len(body)
            left = text[at - 1] if at else ""
            torn = left and (letter(left) and letter(char) or left.isalpha() and left.isascii() and char.isalpha() and char.isascii())
            if torn and rng.random() < rate:
                body = rng.choice(("\n", "\r\n", "\n  ", " ", "　"))
                if char.isascii():
                    body = rng.choice(("-\n", "-\r\n", "- ", "­\n"))
                chars += body
                ops += [(JOIN, 0)] * len(body)
            if at == lost:
                continue
            if rng.random() < wrong and back.get(char):
                chars.append(rng.choice(back[char]))
                ops.append((REPLACE, ord(char)))
            elif dirty and char in "）)" and at + 1 < len(text) and rng.random() < 0.02:
                chars.append(text[at + 1])
                ops.append((INSERT, CLOSING))
                lost = at + 1
            else:
                chars.append(char)
                ops.append((KEEP, 0))
        return "".join(chars), ops

    # -- use --------------------------------------------------------------------------------------------------------

    def _predict(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each text the operations, the right characters of replacements, and what recurs on scanned pages only."""
        out = []
        begin, room = 0, 0
        for at in range(len(texts) + 1):
            if at == len(texts) or room > CHUNK:
                if at > begin:
                    look = self._look(texts[begin:at])
                    ops, chosen, _ = self._decide(look, 0, int(look["bounds"][-1]), self.weights)
                    right = np.where(chosen >= 0, look["others"][chosen], 0) if len(look["others"]) else np.zeros(len(ops), dtype=np.uint64)
                    for low, high in zip(look["bounds"], look["bounds"][1:]):
                        out.append((ops[low:high], right[low:high], look["only"][low:high]))
                begin, room = at, 0
            if at < len(texts):
                room += len(texts[at]) + 4
        return out

    def repair_all(self, texts: list[str]) -> list[tuple[str, list[str]]]:
        """For each text the repaired text and the kinds of noise found in it."""
        noises: list[set[str]] = [set() for _ in texts]
        first = self._predict(texts)
        joined, again = list(texts), []
        for at, (ops, _, only) in enumerate(first):
            if ((ops == DELETE) | (ops == JOIN)).any():
                joined[at] = self._without_layout(texts[at], ops, only, noises[at])
                again.append(at)
        second = dict(zip(again, self._predict([joined[at] for at in again])))
        out = []
        for at, text in enumerate(joined):
            ops, right, _ = second.get(at, first[at])
            if ((ops == REPLACE) | (ops == INSERT)).any():
                chars = list(text)
                for k in np.flatnonzero(ops == REPLACE):
                    chars[k] = chr(int(right[k]))
                    noises[at].add("misread")
                for k in np.flatnonzero(ops == INSERT):
                    chars[k] = chr(CLOSING) + chars[k]
                text = "".join(chars)
            out.append((text, sorted(noises[at])))
        return out

    def _without_layout(self, text: str, ops: np.ndarray, only: np.ndarray, noise: set[str]) -> str:
        """The text without furniture and torn words; what is deleted must be a page number or recur on scanned pages only."""
        ops = ops.copy()
        marks = "".join("KDJIR"[op] for op in ops)
        furniture = np.zeros(len(text), dtype=bool)
        for run in re.finditer(r"D+", marks):
            low, high = run.span()
            pieces = [p.strip(" \t　-—·") for p in re.split(r"[\n\r]+", text[low:high])]
            numbers = [p for p in pieces if re.fullmatch(r"(?:第|P\.?|p\.?)?\s*\d{1,4}\s*(?:页)?", p)]
            head = bool(only[low:high].any())
            if not numbers and not head:
                ops[low:high] = KEEP
                continue
            furniture[low:high] = True
            if numbers:
                noise.add("page_no")
            if head and any(len(re.findall(r"[㐀-鿿A-Za-z]", p)) >= 2 for p in pieces if p not in numbers):
                noise.add("running_head")
        for run in re.finditer(r"J+", marks):
            low, high = run.span()
            if not (low > 0 and furniture[low - 1] or high < len(text) and furniture[high]):
                noise.add("broken_line")
        keep = (ops != DELETE) & (ops != JOIN)
        return "".join(c for c, k in zip(text, keep) if k)

    def repair(self, text: str) -> tuple[str, list[str]]:
        """The repaired text and the kinds of noise found in it."""
        return self.repair_all([text])[0]


def gram_counts(texts: list[str], scanned: np.ndarray) -> pd.DataFrame:
    """Rows ``(what, key, typed, scanned)`` of a batch: triples and pairs without breaks, and the texts with each raw triple."""
    page = _Layout(texts)
    side = np.asarray(scanned, dtype=bool)[page.owner]
    packed, seen = page.visible_triples(), side[page.seen][2:]
    pairs = (page.visible[:-1] << _PAIR) | page.visible[1:]
    raw, owner = _triples(page.masked), page.owner[2:]
    inside = page.real[:-2] & page.real[2:] & (page.owner[:-2] == owner)
    raw, owner = raw[inside], owner[inside]
    order = np.lexsort((raw, owner))
    once = np.ones(len(order), dtype=bool)
    once[1:] = (raw[order][1:] != raw[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    raw, owner = raw[order][once], owner[order][once]
    frames = []
    for what, keys, own in (("packed", packed[~seen], seen[~seen]), ("pair", pairs, side[page.seen][1:]), ("raw", raw, np.asarray(scanned, dtype=bool)[owner])):
        unique, at = np.unique(keys, return_inverse=True)
        counts = np.bincount(at, minlength=len(unique)), np.bincount(at, weights=own, minlength=len(unique)).astype(np.int64)
        frames.append(pd.DataFrame({"what": what, "key": unique.astype(np.int64), "typed": counts[0] - counts[1], "scanned": counts[1]}))
    return pd.concat(frames, ignore_index=True)


def _wanted(grams, typed: int, scanned: int):
    """The grams that matter: known ones of typed texts, and those of scanned texts that recur and typed texts don't have.

    ``grams`` is a pandas frame or the columns of a Spark frame; every kind is bounded by text length over its share.
    """
    strange = grams["typed"] == 0
    return (
        (grams["what"] == "packed") & (grams["typed"] >= max(1.0, TYPED_SHARE * typed))
        | (grams["what"] == "pair") & strange & (grams["scanned"] >= max(RECURS, FOREIGN_SHARE * scanned))
        | (grams["what"] == "raw") & strange & (grams["scanned"] >= max(RECURS, RECURS_SHARE * scanned))
    )


def fit_editor(texts: DataFrame, text: str, scanned: Column, train_texts: int = TRAIN_TEXTS) -> Editor:
    """An editor whose statistics cover all texts and whose perceptron is trained on at most ``train_texts`` typed ones.

    Null and empty texts don't count; repeated rows count each.  The statistics are counted where the texts are and come to
    the driver only above their support, which bounds them by text length over share, whatever the number of texts.
    """
    spark = texts.sparkSession
    rows = texts.select(F.col(text).alias("text"), F.coalesce(scanned, F.lit(False)).alias("scanned")).filter(F.length("text") > 0)
    sizes = rows.agg(F.count_if(~F.col("scanned")).alias("typed"), F.count_if("scanned").alias("scanned")).first()
    editor = Editor()

    def count(batches):
        for batch in batches:
            yield gram_counts(batch["text"].tolist(), batch["scanned"].to_numpy(dtype=bool))

    grams = rows.mapInPandas(count, "what string, key bigint, typed bigint, scanned bigint")
    grams = grams.groupBy("what", "key").agg(F.sum("typed").alias("typed"), F.sum("scanned").alias("scanned"))
    editor.learn_grams(grams.filter(_wanted(grams, sizes["typed"], sizes["scanned"])).toPandas())
    pages = rows.filter("scanned").select("text")

    def over_pages(method: str, schema: str) -> DataFrame:
        sent = spark.sparkContext.broadcast(editor)  # bounded as above

        def run(batches):
            for batch in batches:
                yield getattr(sent.value, method)(batch["text"].tolist())

        return pages.mapInPandas(run, schema)

    votes = over_pages("votes", "char bigint, other bigint, n bigint").groupBy("char", "other").agg(F.sum("n").alias("n"))
    whole = votes.groupBy("char").agg(F.sum("n").alias("_all"))
    agreed = votes.join(whole, "char").filter(F.col("n") >= AGREED * F.col("_all")).drop("_all")
    editor.learn_confusions(agreed.toPandas())
    heads = over_pages("runs", "head string, n bigint").groupBy("head").agg(F.sum("n").alias("n"))
    heads = heads.filter(F.col("n") >= max(RECURS, RECURS_SHARE * sizes["scanned"]))
    editor.learn_heads({r["head"]: r["n"] for r in heads.collect()})
    sample = bounded_rows(rows.filter(~F.col("scanned") & (F.length("text") > 1)).select("text"), "text", train_texts, sizes["typed"])
    return editor.train([r["text"] for r in sample.collect()])


def repair(texts: DataFrame, columns: list[str], editor: Editor) -> DataFrame:
    """Rows ``(*columns, repaired, noise)`` for every text (column ``text``); ``noise`` is the array of kinds found.

    Null texts are left out, empty ones stay empty.  The work is linear in the length of a text.
    """
    sent = texts.sparkSession.sparkContext.broadcast(editor)  # bounded: see `fit_editor`

    def run(batches):
        for batch in batches:
            done = sent.value.repair_all(batch["text"].tolist())
            yield batch[columns].assign(
                repaired=pd.Series([d[0] for d in done], dtype="object", index=batch.index),
                noise=pd.Series([d[1] for d in done], dtype="object", index=batch.index),
            )

    slim = spread(texts.select(*columns, "text").filter(F.col("text").isNotNull()))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.select(*columns).schema)
    return slim.mapInPandas(run, f"{schema}, repaired string, noise array<string>")
