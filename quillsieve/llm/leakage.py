"""Evaluation texts inside training texts: BM25 over an inverted index of the test items, with block-max WAND.

The items are few and stated; the corpus is not.  So the index holds the items, and every passage of every document is a
query against it.  A posting's impact is its BM25 weight over the item's own score, so one threshold fits all items, and a
passage whose terms cannot reach the threshold together is dropped without scoring.  Long items are indexed in parts.  What
is retrieved is then aligned with the whole item, token by token, over the whole document, which decides how much of it the
document repeats.

Tokens and terms are integers: a batch of documents is cut into tokens and looked up in the index with array operations.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsieve.llm.language import _Table
from quillsieve.session import spread

TERM = 3  # tokens in an index term
K1, B = 1.2, 0.4
#: Share of an item's own score that a passage must reach to be retrieved.
THRESHOLD = 0.25
PASSAGE, STRIDE = 240, 120  # tokens
#: Most tokens of one part of an item in the index, so that a passage can hold most of a part.
PART = 200
BLOCK = 16  # items whose postings of a term have one stored maximum
#: Items of one index; more items make more indexes, each searched by all documents, with weights of all items.
INDEX_ITEMS = 50_000
#: Share of an item's tokens that the passage must span, and share of the span that must be the same.
SPANNED, SAME = 0.49, 0.86
#: A passage that spans less than ``WHOLE`` of the item must be closer to it: part of a frame that items share isn't a leak.
WHOLE, SAME_PART = 0.85, 0.95
#: Tokens of other text that may lie between two parts of a passage.
GAP = 14
_TABLED = 0x30000
_A, _B, _MIX = np.uint64(0x100000001B3), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x9E3779B97F4A7C15)
NUMBER = np.uint64(0x51ED270B7A2C4D11)  # all numbers are one token
SINGLE, DIGITS, LETTERS = 1, 2, 3


def simplified(spark: SparkSession) -> dict[int, str]:
    """Traditional to simplified characters, by the transliteration rules that come with Spark's Unicode library."""
    rules = spark.sparkContext._jvm.com.ibm.icu.text.Transliterator.getInstance("Traditional-Simplified")
    chars = [chr(c) for c in range(0x4E00, 0xA000)]
    turned = rules.transliterate("\n".join(chars)).split("\n")
    return {ord(a): b for a, b in zip(chars, turned) if a != b and len(b) == 1}


@lru_cache(maxsize=1)
def _token_classes() -> np.ndarray:
    """What each character is part of: a token of its own (East Asian), a number, a word, or nothing (0)."""
    out = np.zeros(_TABLED, dtype=np.uint8)
    for code in range(_TABLED):
        char = chr(code)
        kind = unicodedata.category(char)
        if "぀" <= char <= "ヿ" or "㐀" <= char <= "鿿" or "가" <= char <= "힯" or code >= 0x20000:
            out[code] = SINGLE if kind[0] == "L" else 0
        elif kind == "Nd":
            out[code] = DIGITS
        elif kind[0] in "LM":
            out[code] = LETTERS
    return out


def fold_table(table: dict[int, str]) -> np.ndarray:
    """Code points of simplified characters by those of any."""
    out = np.arange(_TABLED, dtype=np.uint32)
    for code, char in table.items():
        out[code] = ord(char)
    return out


def token_codes(texts: list[str], fold: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of all texts as integers, whatever the layout, width, case or script, and where each text's begin.

    Tokens are words of letters, numbers (all alike) and single East Asian characters.
    """
    plain = unicodedata.normalize("NFKC", "\0".join(t.replace("\0", " ") for t in texts) + "\0").lower()
    codes = np.frombuffer(plain.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    low = np.minimum(codes, _TABLED - 1)
    codes = np.where(codes < _TABLED, fold[low], codes)
    kind = _token_classes()[np.minimum(codes, _TABLED - 1)]
    begins = kind > 0
    begins[1:] &= (kind[1:] == SINGLE) | (kind[1:] != kind[:-1])
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(codes == 0)  # one behind each text
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), np.zeros(len(texts) + 1, dtype=np.int64)
    place = np.arange(len(codes)) - starts[np.maximum(np.cumsum(begins) - 1, 0)]
    place = np.where(kind > 0, place, 0)
    powers = np.cumprod(np.full(int(place.max()) + 1, _A, dtype=np.uint64))
    hashed = np.add.reduceat(np.where(kind > 0, (codes.astype(np.uint64) + np.uint64(1)) * powers[place], np.uint64(0)), starts)
    hashed = np.where(kind[starts] == DIGITS, NUMBER, (hashed ^ (hashed >> np.uint64(31))) * _MIX)
    return hashed, np.concatenate([[0], np.searchsorted(starts, ends)])


def _runs(codes: np.ndarray, size: int) -> np.ndarray:
    """Every ``size`` neighbouring tokens as one integer."""
    count = max(0, len(codes) - size + 1)
    mixed = np.zeros(count, dtype=np.uint64)
    for k in range(size):
        mixed = (mixed ^ codes[k : k + count]) * _B
        mixed ^= mixed >> np.uint64(32)
    return mixed


def _ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """All numbers from each of ``low`` up to its ``high``, one range behind the other."""
    sizes = high - low
    return np.arange(sizes.sum()) + np.repeat(low - np.cumsum(sizes) + sizes, sizes)


class ItemIndex:
    """Inverted index of item texts with impacts and block maxima.

    ``statistics``: frequencies of all parts of all items, of which ``items`` may be some.
    """

    def __init__(self, items: list[tuple[str, str]], table: dict[int, str], statistics: "Statistics | None" = None):
        self.fold = fold_table(table)
        self.names = [name for name, _ in items]
        codes, bounds = token_codes([text for _, text in items], self.fold)
        self.tokens = [codes[a:b] for a, b in zip(bounds, bounds[1:])]
        self.short: dict[int, dict[int, list[int]]] = {}  # items with few tokens, found whole
        parts: list[tuple[int, np.ndarray]] = []
        for at, own in enumerate(self.tokens):
            if 0 < len(own) < 2 * TERM:
                self.short.setdefault(len(own), {}).setdefault(int(_runs(own, len(own))[0]), []).append(at)
            elif len(own):
                parts += [(at, part) for part in _parts(own)]
        self.owner = np.array([at for at, _ in parts], dtype=np.int64)
        statistics = statistics or Statistics().add_parts([part for _, part in parts])
        rows = []
        for at, (_, part) in enumerate(parts):
            terms, times = np.unique(_runs(part, TERM), return_counts=True)
            df = np.array([statistics.df[int(t)] for t in terms])
            norm = K1 * (1 - B + B * len(part) / statistics.mean)
            weights = np.log(1 + (statistics.count - df + 0.5) / (df + 0.5)) * times * (K1 + 1) / (times + norm)
            rows.append((terms, np.full(len(terms), at), weights / weights.sum()))
        terms, ids, impacts = (np.concatenate(x) if rows else np.zeros(0) for x in zip(*rows)) if rows else (np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), np.zeros(0))
        order = np.lexsort((ids, terms))
        self.keys, first = np.unique(terms[order], return_index=True)
        self.terms = _Table(self.keys)
        self.all_ids, self.all_impacts = ids[order].astype(np.int64), impacts[order]
        self.begin = np.concatenate([first, [len(order)]]).astype(np.int64)
        # of each term the blocks of items that have it, with the largest impact in each
        which = np.repeat(np.arange(len(self.keys)), np.diff(self.begin))
        block = self.all_ids // BLOCK
        new = np.ones(len(order), dtype=bool)
        new[1:] = (block[1:] != block[:-1]) | (which[1:] != which[:-1])
        starts = np.flatnonzero(new)
        self.blocks, self.block_posting = block[starts], np.append(starts, len(order))
        self.block_begin = np.append(np.searchsorted(starts, self.begin[:-1]), len(starts))
        self.block_max = np.maximum.reduceat(self.all_impacts, starts) if len(starts) else np.zeros(0)
        self.most = np.maximum.reduceat(self.all_impacts, self.begin[:-1]) if len(self.keys) else np.zeros(0)
        grams = [_runs(own, 2) for own in self.tokens]
        self.pair_order = [np.argsort(g, kind="stable") for g in grams]
        self.pairs = [g[o] for g, o in zip(grams, self.pair_order)]

    @property
    def ids(self) -> list[np.ndarray]:
        return [self.all_ids[a:b] for a, b in zip(self.begin, self.begin[1:])]

    @property
    def impacts(self) -> list[np.ndarray]:
        return [self.all_impacts[a:b] for a, b in zip(self.begin, self.begin[1:])]

    def retrieve(self, terms) -> list[int]:
        """Parts whose score with these distinct terms reaches the threshold: block-max WAND.

        The lists of the terms move on block by block, all at once.  A block is a pivot if the maxima of the lists that
        have it can reach the threshold together; all others are skipped without a look at their postings, and most
        queries have no pivot at all.
        """
        terms = np.asarray(terms, dtype=np.int64)
        if not len(terms):
            return []
        place = _ranges(self.block_begin[terms], self.block_begin[terms + 1])
        bound = np.bincount(self.blocks[place], weights=self.block_max[place])
        pivot = bound >= THRESHOLD - 1e-9
        if not pivot.any():
            return []
        place = place[pivot[self.blocks[place]]]
        posting = _ranges(self.block_posting[place], self.block_posting[place + 1])
        score = np.bincount(self.all_ids[posting], weights=self.all_impacts[posting])
        return np.flatnonzero(score >= THRESHOLD).tolist()

    def repeats(self, pairs: np.ndarray, item: int) -> tuple[float, float, int, int]:
        """The largest share of the item that one stretch of a text spans with enough the same, how much is the same, and where.

        ``pairs``: the neighbouring tokens of the text, two by two.  Stretches of the same tokens are chained in order,
        with at most ``GAP`` other tokens between two.
        """
        own = self.tokens[item]
        blocks = self._blocks(pairs, item)
        least = SPANNED * len(own)
        best = (0.0, 0.0, 0, 0)
        chains: list[tuple[float, int, int]] = []  # score, block before, tokens the same since then
        for at, (a, b, size) in enumerate(blocks):
            top = (float(size) * (1 - SAME / 2), -1, size)
            for k in range(at - 1, -1, -1):
                a0, b0, size0 = blocks[k]
                if b - b0 > GAP + self.longest:
                    break
                over = max(0, a0 + size0 - a, b0 + size0 - b)
                gap_a, gap_b = a + over - a0 - size0, b + over - b0 - size0
                if over >= size or a <= a0 or max(gap_a, gap_b) > GAP:
                    continue
                same = size - over
                score = chains[k][0] + same - SAME / 2 * (gap_a + size - over)
                if score > top[0]:
                    top = (score, k, same)
            chains.append(top)
            same, k, (_, before, more) = 0, at, top
            while True:
                span = a + size - blocks[k][0]
                whole = same + blocks[k][2]  # the first block counts whole
                if span >= least and whole >= (SAME if span >= WHOLE * len(own) else SAME_PART) * span:
                    best = max(best, (span / len(own), whole / span, blocks[k][1], b + size))
                if before < 0:
                    break
                same, k = same + more, before
                _, before, more = chains[k]
        return best

    def _blocks(self, pairs: np.ndarray, item: int) -> list[tuple[int, int, int]]:
        """Stretches ``(place in the item, place in the text, tokens)`` of two tokens or more that are the same."""
        low, high = np.searchsorted(self.pairs[item], pairs), np.searchsorted(self.pairs[item], pairs, side="right")
        times = high - low
        b = np.repeat(np.arange(len(pairs)), times)
        if not len(b):
            return []
        a = self.pair_order[item][np.repeat(low, times) + np.arange(len(b)) - np.repeat(np.cumsum(times) - times, times)]
        order = np.lexsort((b, b - a))
        a, b = a[order], b[order]
        new = np.ones(len(a), dtype=bool)
        new[1:] = (b[1:] != b[:-1] + 1) | (a[1:] != a[:-1] + 1)
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(a))) + 1
        self.longest = int(size.max())
        order = np.lexsort((a[first], b[first]))
        return list(zip(a[first][order].tolist(), b[first][order].tolist(), size[order].tolist()))

    longest = 0


class Statistics:
    """How many parts of items have each term, the number of parts and their mean length, over all indexes."""

    def __init__(self):
        self.df: Counter[int] = Counter()
        self.count, self.tokens = 0, 0

    def add(self, texts: list[str], fold: np.ndarray) -> "Statistics":
        codes, bounds = token_codes(texts, fold)
        return self.add_parts([p for a, b in zip(bounds, bounds[1:]) if b - a >= 2 * TERM for p in _parts(codes[a:b])])

    def add_parts(self, parts: list[np.ndarray]) -> "Statistics":
        for part in parts:
            self.df.update(np.unique(_runs(part, TERM)).tolist())
            self.count += 1
            self.tokens += len(part)
        return self

    @property
    def mean(self) -> float:
        return max(1.0, self.tokens / max(1, self.count))


def _parts(own: np.ndarray) -> list[np.ndarray]:
    """An item's tokens in equal parts of at most ``PART``, each with the first terms that run into the next."""
    count = math.ceil(len(own) / PART)
    edges = [len(own) * k // count for k in range(count + 1)]
    return [own[a : b + TERM - 1] for a, b in zip(edges, edges[1:])]


def tokens(text: str, table: dict[int, str]) -> list[int]:
    """The tokens of one text as integers."""
    return token_codes([text], fold_table(table))[0].tolist()


def search_all(index: ItemIndex, texts: list[str]) -> list[tuple[int, int, float, float, int, int]]:
    """Items repeated in texts: ``(text, item, span share, same share, first token, token behind)`` before any decision."""
    codes, bounds = token_codes(texts, index.fold)
    out: list[tuple[int, int, float, float, int, int]] = []
    owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
    for size, known in index.short.items():
        runs = _runs(codes, size)
        inside = owner[: len(runs)] == owner[size - 1 :]
        hits = np.flatnonzero(inside & np.isin(runs, np.array(list(known), dtype=np.uint64)))
        found = {(int(owner[at]), item): int(at - bounds[owner[at]]) for at in hits for item in known[int(runs[at])]}
        out += [(text, item, 1.0, 1.0, at, at + size) for (text, item), at in found.items()]
    if not len(index.keys) or len(codes) < TERM:
        return sorted(out)
    term = index.terms.find(_runs(codes, TERM))
    term[owner[: len(term)] != owner[TERM - 1 :]] = -1
    hits = np.flatnonzero(term >= 0)
    place, term = hits, term[hits].astype(np.int64)
    bound = np.bincount(owner[place], weights=index.most[term], minlength=len(texts))
    for text in np.flatnonzero(bound >= THRESHOLD):
        low, high = np.searchsorted(place, [bounds[text], bounds[text + 1]])
        own, at = term[low:high], place[low:high] - bounds[text]
        size = int(bounds[text + 1] - bounds[text])
        parts: set[int] = set()
        asked = None
        for start in range(0, max(1, size - PASSAGE + STRIDE), STRIDE):
            a, b = np.searchsorted(at, [start, start + PASSAGE])
            query = np.unique(own[a:b])
            if index.most[query].sum() < THRESHOLD or asked is not None and np.array_equal(asked, query):
                continue
            asked = query
            parts.update(index.retrieve(query))
        if parts:
            pairs = _runs(codes[bounds[text] : bounds[text + 1]], 2)
            out += [(int(text), int(item), *index.repeats(pairs, item)) for item in np.unique(index.owner[sorted(parts)])]
    return sorted(out)


def search(index: ItemIndex, text: str) -> list[tuple[int, float, float, int, int]]:
    """Items repeated in one text."""
    return [found[1:] for found in search_all(index, [text])]


def find_leaks(docs: DataFrame, key: str, text: str, items: DataFrame) -> DataFrame:
    """Rows ``(key, item_id, spanned, same)``: documents that repeat at least half of an item's text as one passage.

    ``items``: ``(item_id, text)``, several texts per item allowed, of any length; null ones can't be looked for, and
    those of under ``2 * TERM`` tokens must be found whole.  What is only a piece of a longer passage of another item is a
    frame that the two items share and no leak.  Null documents give no rows, long ones are searched whole,
    equal ones are searched each.  The items are collected, since they are the stated query set, and sent out in indexes of
    ``INDEX_ITEMS``, which weigh terms by all items.
    """
    spark = docs.sparkSession
    table = simplified(spark)
    listed = [(r["item_id"], r["text"]) for r in items.filter(F.col("text").isNotNull()).orderBy("item_id", "text").collect()]
    statistics = Statistics().add([t for _, t in listed], fold_table(table))
    slim = spread(docs.select(key, text).filter(F.length(text) > 0))
    kind = slim.schema[key].dataType.simpleString()
    found = spark.createDataFrame([], f"`{key}` {kind}, item_id string, spanned double, same double, first int, behind int")
    for at in range(0, len(listed), INDEX_ITEMS):
        sent = spark.sparkContext.broadcast(ItemIndex(listed[at : at + INDEX_ITEMS], table, statistics))

        def run(batches, sent=sent):
            index = sent.value
            for batch in batches:
                keys = batch[key].tolist()
                hits = search_all(index, batch[text].tolist())
                rows = [(keys[k], index.names[i], s, d, a, b) for k, i, s, d, a, b in hits if s >= SPANNED and d >= SAME]
                yield pd.DataFrame(rows, columns=[key, "item_id", "spanned", "same", "first", "behind"])

        found = found.unionByName(slim.mapInPandas(run, found.schema))
    # a document repeats at most as many items as it has passages, so its list is no larger than its text
    listed_by = found.groupBy(key).agg(F.collect_list(F.struct("item_id", "spanned", "same", "first", "behind")).alias("own"))
    kept = listed_by.select(key, F.explode(F.filter("own", lambda x: ~F.exists("own", lambda y: _is_frame(x, y)))).alias("x"))
    return kept.groupBy(key, "x.item_id").agg(F.max("x.spanned").alias("spanned"), F.max("x.same").alias("same"))


def _is_frame(x: Column, y: Column) -> Column:
    """Whether passage ``x`` is only a piece of the longer passage ``y`` of another item."""
    size = x["behind"] - x["first"]
    common = F.least(x["behind"], y["behind"]) - F.greatest(x["first"], y["first"])
    longer = (y["behind"] - y["first"]) * SAME_PART > size
    return (x["item_id"] != y["item_id"]) & (x["spanned"] < WHOLE) & (common >= 0.9 * size) & longer
