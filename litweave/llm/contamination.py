"""Evaluation texts leaking into training text, by suffix arrays of the training text.

Texts become words (runs of letters or digits) in a form in which case, punctuation, markup, spacing, invisible
characters, hyphens at line ends and Unicode forms make no difference. The corpus is read in shards of whole documents. Of
each shard a suffix array is built by prefix doubling: word positions sorted by all the words that follow, up to the next one
that no item has, which can't be in a match. Every suffix of every item is looked up in it by binary search, all suffixes in
step; the stretch of suffixes that share at least `least` words with it are its locations, and each is followed word by word to
its longest verbatim match. A location that the words before it continue is the tail of a longer match and is dropped
before documents and items are paired, so a repeated passage is paired once, not once for each of its words.
Only positions followed by `least` words of the items' vocabulary enter the array, which drops nothing.

Items are broadcast, in blocks of ITEM_BLOCK if there are more, each block with a pass of its own. Documents never leave
their task; only matches do, in parts of at most PAIRS pairs. Defined results: null and empty texts match nothing; an item of fewer than
`least` words can't be found; items with the same passage are each reported; repeated document ids are one document.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_WORDS = 12
SHARD_CHARS = 4_000_000
ITEM_BLOCK = 20_000
PAIRS = 500_000
MATCHES = "doc_id bigint, item_id bigint, doc_word bigint, item_word int, words int"
WORD = re.compile(r"[^\W_]+")
# Inline HTML elements, which do not end a word.
INLINE_TAG = re.compile(r"</?(?:a|b|i|u|em|strong|sub|sup|span|mark|code|small|font)(?:\s[^<>]*)?/?>", re.I)
TAG = re.compile(r"</?[a-z][a-z0-9]*(?:\s[^<>]*)?/?>|<!--.*?-->", re.I | re.S)
HYPHENS = "-\N{HYPHEN}\N{NON-BREAKING HYPHEN}\N{SOFT HYPHEN}"
LINE_BREAK = rf"[{HYPHENS}][ \t]*(?:\r\n|[\n\r\x85])[ \t]*"
LINE_HYPHEN = re.compile(rf"(?<![^\W_])[^\W_]++(?:{LINE_BREAK}[^\W_]++)+")
HYPHEN_BREAK = re.compile(LINE_BREAK)
NOT_ASCII = re.compile(r"[^\x00-\x7f]")
ODD = re.compile(r"[^\x09-\x0d\x20-\x7e]")


@lru_cache(maxsize=1 << 16)
def invisible(c: str) -> bool:
    return unicodedata.category(c) in ("Cf", "Cc") and not c.isspace() or "\N{VARIATION SELECTOR-1}" <= c <= "\N{VARIATION SELECTOR-16}" or c == "\N{COMBINING GRAPHEME JOINER}"


def words(text: str | None, vocabulary: set[str] | dict | None = None) -> list[str]:
    """The words of a text in their common form.

    A hyphen at a line end either breaks a word or belongs to a compound: hyphens are taken out, over as many lines as the word
    runs, unless the whole is not in the vocabulary but can be put together from words that are.
    """
    if not text:
        return []
    if "<" in text:
        text = TAG.sub(" ", INLINE_TAG.sub("", text))
    if "&" in text:
        text = html.unescape(text)
    if HYPHEN_BREAK.search(text):
        text = LINE_HYPHEN.sub(lambda m: unbroken(HYPHEN_BREAK.split(m.group()), vocabulary), text)
    return WORD.findall(common(text))


def unbroken(parts: list[str], vocabulary: set[str] | dict | None) -> str:
    """The parts of a word broken at line ends as one word, or as the fewest words of the vocabulary that they make up."""
    if vocabulary is None:
        return "".join(parts)
    low = [common(p) for p in parts]
    longest = max(map(len, vocabulary), default=0) if len(parts) > 2 else 1 << 30
    best: list[tuple[int, int] | None] = [(0, 0), *[None] * len(low)]  # for each end: how many words, and where the last begins
    for end in range(1, len(low) + 1):
        word = ""
        for begin in range(end - 1, -1, -1):
            word = low[begin] + word
            if len(word) > longest:
                break
            before = best[begin]
            if before and word in vocabulary and (best[end] is None or before[0] + 1 < best[end][0]):
                best[end] = (before[0] + 1, begin)
    if best[-1] is None:
        return "".join(parts)
    cut, end = [], len(parts)
    while end:
        begin = best[end][1]
        cut.append("".join(parts[begin:end]))
        end = begin
    return " ".join(reversed(cut))


def common(text: str) -> str:
    if ODD.search(text):
        text = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())
        if not text.isascii():
            text = NOT_ASCII.sub(lambda m: "" if invisible(m[0]) else m[0], text)
            text = unicodedata.normalize("NFKC", text)
        return text
    return text.lower()


class Items:
    """Items as one array of word ids, with all suffix starts of `least` words or more."""

    def __init__(self, ids: list[int], texts: list[str | None], least: int = LEAST_WORDS):
        self.least, self.vocabulary = least, {}
        rows = [words(t) for t in texts]
        for r in rows:
            for w in r:
                self.vocabulary.setdefault(w, len(self.vocabulary) + 1)
        flat, owner, place = [], [], []
        for i, r in zip(ids, rows):
            flat += [self.vocabulary[w] for w in r] + [-1]
            owner += [i] * (len(r) + 1)
            place += range(len(r) + 1)
        self.flat = np.array([*flat, *[-1] * least], np.int64)
        self.owner, self.place = np.array([*owner, -1], np.int64), np.array([*place, 0], np.int32)
        self.starts = whole_starts(self.flat, least)


def whole_starts(flat: np.ndarray, least: int) -> np.ndarray:
    """Positions followed, themselves included, by `least` known words."""
    known = np.concatenate([[0], np.cumsum(flat > 0)])
    n = len(flat) - least + 1
    return np.flatnonzero(known[least:] - known[: max(n, 0)] == least) if n > 0 else np.zeros(0, np.int64)


def suffix_array(flat: np.ndarray, starts: np.ndarray, least: int) -> np.ndarray:
    """The starts sorted by the words that follow, up to the first unknown one.

    Prefix doubling: ranks by the first h words give ranks by the first 2h, until all differ or the longest run of known words
    is ranked. Only the positions within runs that hold a start are ranked.
    """
    inside = np.zeros(len(flat) + 1, np.int64)
    np.add.at(inside, starts, 1)
    np.add.at(inside, starts + least, -1)
    spots = np.flatnonzero(np.cumsum(inside[:-1]) > 0)  # every position of a run that can match
    rank = np.zeros(len(flat) + 1, np.int64)
    rank[spots] = np.unique(flat[spots], return_inverse=True)[1].ravel() + 1
    h = 1
    while True:
        pair = rank[spots] * (len(spots) + 2) + rank[np.minimum(spots + h, len(flat))]
        got, order = np.unique(pair, return_inverse=True)
        rank[spots] = order.ravel() + 1
        h *= 2
        if len(got) == len(spots) or not rank[np.minimum(spots + h, len(flat))].any():
            break
    return starts[np.argsort(rank[starts], kind="stable")]


def shared(flat: np.ndarray, at: np.ndarray, other: np.ndarray, it: np.ndarray, known: int = 0) -> np.ndarray:
    """How many words the suffixes flat[at] and other[it] share, pair by pair; the first `known` are known to be the same."""
    length = np.full(len(at), known)
    going = np.arange(len(at))
    while len(going):
        a = flat[np.minimum(at[going] + length[going], len(flat) - 1)]
        b = other[np.minimum(it[going] + length[going], len(other) - 1)]
        going = going[(a == b) & (a > 0)]
        length[going] += 1
    return length


def bound(flat: np.ndarray, array: np.ndarray, items: Items, begin: np.ndarray, words_: int, after: bool) -> np.ndarray:
    """Binary search of item suffixes, cut to `words_` words, in the suffix array, all in step: the first place not below (after: above) each."""
    low, high = np.zeros(len(begin), np.int64), np.full(len(begin), len(array), np.int64)
    going = np.flatnonzero(low < high)
    while len(going):
        mid = (low[going] + high[going]) // 2
        at, it = array[mid], begin[going]
        order = np.zeros(len(going), np.int64)  # of the corpus suffix against the item's
        open_, k = np.arange(len(going)), 0
        while len(open_) and k < words_:
            a = flat[np.minimum(at[open_] + k, len(flat) - 1)]
            b = items.flat[np.minimum(it[open_] + k, len(items.flat) - 1)]
            order[open_] = np.sign(a - b)
            open_ = open_[a == b]
            k += 1
        right = (order < 0) | (after & (order == 0))
        low[going[right]] = mid[right] + 1
        high[going[~right]] = mid[~right]
        going = going[low[going] < high[going]]
    return low


def shard_matches(doc_ids: list[int], texts: list[str | None], items: Items) -> pd.DataFrame:
    """All longest matches of the documents of one shard."""
    parts = list(shard_parts(doc_ids, texts, items))
    return pd.concat(parts) if parts else pd.DataFrame({c.split()[0]: pd.Series(dtype="int64") for c in MATCHES.split(", ")})


def shard_parts(doc_ids: list[int], texts: list[str | None], items: Items) -> Iterator[pd.DataFrame]:
    """The same, a part at a time."""
    least, get = items.least, items.vocabulary.get
    flat: list[int] = []
    begin = []
    for t in texts:
        begin.append(len(flat))
        flat += [get(w, 0) for w in words(t, items.vocabulary)]
        flat.append(0)
    corpus = np.array([*flat, 0], np.int64)
    starts = whole_starts(corpus, least)
    if not len(starts) or not len(items.starts):
        return
    array = suffix_array(corpus, starts, least)
    # Suffixes of items that begin with the same words have the same locations.
    first = items.flat[items.starts[:, None] + np.arange(least)]
    _, sample, group = np.unique(first, axis=0, return_index=True, return_inverse=True)
    asked = items.starts[sample]
    low = bound(corpus, array, items, asked, least, False)
    near = np.minimum(low, len(array) - 1)
    hit = np.flatnonzero((low < len(array)) & (shared(corpus, array[near], items.flat, asked) >= least))
    if not len(hit):
        return
    high = bound(corpus, array, items, asked[hit], least, True)
    order = np.argsort(group.ravel(), kind="stable")
    edges = np.searchsorted(group.ravel()[order], np.arange(len(asked) + 1))
    begin_a, ids = np.array(begin), np.array(doc_ids, np.int64)
    pending: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    for g, lo, hi in zip(hit, low[hit], high):
        places = array[lo:hi]
        mine = items.starts[order[edges[g] : edges[g + 1]]]
        for at, it in heads(corpus, places, items.flat, mine):
            pending.append((at, it))
            size += len(at)
            if size >= PAIRS:
                yield located(corpus, pending, items, begin_a, ids)
                pending, size = [], 0
    if size:
        yield located(corpus, pending, items, begin_a, ids)


def heads(corpus: np.ndarray, places: np.ndarray, flat: np.ndarray, mine: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of corpus and item positions whose words before differ, a part at a time; the others are tails of longer matches."""
    before = np.where(places > 0, corpus[places - 1], 0)
    own = np.where(mine > 0, flat[mine - 1], -1)
    for w in np.unique(before):
        at = places[before == w]
        it = mine[(own != w) | (w <= 0)]
        step = max(1, PAIRS // max(1, len(it)))
        for k in range(0, len(at) if len(it) else 0, step):
            part = at[k : k + step]
            yield np.repeat(part, len(it)), np.tile(it, len(part))


def located(corpus: np.ndarray, pending: list[tuple[np.ndarray, np.ndarray]], items: Items, begin: np.ndarray, ids: np.ndarray) -> pd.DataFrame:
    at, it = (np.concatenate(x) for x in zip(*pending))
    length = shared(corpus, at, items.flat, it, items.least)
    doc = np.searchsorted(begin, at, side="right") - 1
    return pd.DataFrame({"doc_id": ids[doc], "item_id": items.owner[it], "doc_word": at - begin[doc], "item_word": items.place[it], "words": length})


def matches(docs: DataFrame, items: DataFrame, least: int = LEAST_WORDS, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", block: int = ITEM_BLOCK) -> DataFrame:
    """(doc_id, item_id, doc_word, item_word, words): every longest match, with its place in the document and in the item."""
    items = items.select(F.col(item_id).cast("bigint").alias("i"), F.col(item_text).alias("t")).dropna()
    blocks = max(1, -(-items.count() // block))
    parts = []
    for b in range(blocks):
        own = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b).toPandas()
        known = Items(own["i"].tolist(), own["t"].tolist(), least)

        def each(batches: Iterator[pd.DataFrame], known: Items = known) -> Iterator[pd.DataFrame]:
            ids: list[int] = []
            texts: list[str | None] = []
            chars = 0
            for batch in batches:
                for i, t in zip(batch.iloc[:, 0], batch.iloc[:, 1]):
                    ids.append(i)
                    texts.append(t)
                    chars += len(t or "")
                    if chars > SHARD_CHARS:
                        yield from shard_parts(ids, texts, known)
                        ids, texts, chars = [], [], 0
            if ids:
                yield from shard_parts(ids, texts, known)

        parts.append(docs.select(doc_id, text).dropna().mapInPandas(each, MATCHES))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def longest(found: DataFrame) -> DataFrame:
    """Of `matches` the longest one of every document and item, the first of several."""
    best = F.max_by(F.struct("doc_word", "item_word", "words"), F.struct("words", -F.col("doc_word"), -F.col("item_word")))
    return found.groupBy("doc_id", "item_id").agg(best.alias("m")).select("doc_id", "item_id", "m.*")


def clean(docs: DataFrame, found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The documents in which no item was found."""
    return docs.join(found.select(F.col("doc_id").alias(doc_id)).distinct(), doc_id, "left_anti")
