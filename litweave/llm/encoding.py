"""Encoding of texts into the ids of a public byte-level tokenizer, by forced-boundary splitting.

A pair of bytes that never stands side by side inside any token of the vocabulary can never be merged, so between two
such bytes a cut is certain. Every such pair of a text where the pre-tokenizer's pattern, too, must split, or may be split without
changing what is on either side, is cut. The fragments, mostly words, are encoded independently, each distinct one once per task
while it is remembered, and the ids are concatenated.

Defined results: null and empty texts give an empty list; no special tokens, whose strings in a text are ordinary text.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOKENIZER_DIR = "/opt/tokenizers"
BYTE_BPE_50K = f"{TOKENIZER_DIR}/byte_bpe_50k.tiktoken"
# The public pre-tokenizer's pattern.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
REMEMBERED = 500_000


@lru_cache(maxsize=4)
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


@lru_cache(maxsize=4)
def inner_pairs(path: str) -> frozenset[tuple[int, int]]:
    """Pairs of bytes that stand side by side inside some token."""
    return frozenset(pair for token in ranks(path) for pair in zip(token, token[1:]))


@lru_cache(maxsize=4)
def never_inside(pairs: frozenset[tuple[int, int]]) -> np.ndarray:
    """For each pair of bytes (first * 256 + second) whether it stands inside no token."""
    table = np.ones(1 << 16, bool)
    for a, b in pairs:
        table[a << 8 | b] = False
    return table


@lru_cache(maxsize=4)
def encoder(path: str):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks(path), special_tokens={})


# By code point, filled as they are met: bit 0 for white space, bit 1 for what can be printed, bit 7 for known ones.
KINDS = np.zeros(0x110000, np.uint8)


def kinds(points: np.ndarray) -> np.ndarray:
    got = KINDS[points]
    if not got.all():
        for p in np.unique(points[got == 0]).tolist():
            c = chr(p)
            KINDS[p] = 128 | c.isprintable() << 1 | c.isspace()
        got = KINDS[points]
    return got


def cuts(text: str, pairs: frozenset[tuple[int, int]]) -> np.ndarray:
    """All certain boundaries within a text: the bytes never join, and the pattern gives the same pieces.

    Before white space after another character the pattern always splits. Between two other characters it splits or a cut
    leaves the same runs, unless an apostrophe is near, which may begin a contraction.
    """
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int32)
    kind = kinds(points)
    if text.isascii():
        first = last = points
    else:
        first = np.where(points < 0x80, points, np.where(points < 0x800, 0xC0 | points >> 6, np.where(points < 0x10000, 0xE0 | points >> 12, 0xF0 | points >> 18)))
        last = np.where(points < 0x80, points, 0x80 | points & 0x3F)
    blank, printable = kind & 1, kind & 2
    ok = never_inside(pairs)[last[:-1] << 8 | first[1:]] & (blank[:-1] == 0) & (printable[:-1] > 0) & ((printable[1:] > 0) | (blank[1:] > 0))
    if "'" in text:
        near = np.zeros(len(points) + 3, bool)
        for k in np.flatnonzero(points == 0x27).tolist():
            near[k : k + 4] = True
        ok &= (blank[1:] > 0) | ~near[1 : len(points)]
    return np.flatnonzero(ok) + 1


def fragments(text: str, pairs: frozenset[tuple[int, int]], size: int = 1) -> list[str]:
    """The text cut at every certain boundary; size: at the first one after so many characters."""
    at = cuts(text, pairs).tolist()
    if size > 1:
        kept, last = [], 0
        for k in at:
            if k - last >= size:
                kept.append(k)
                last = k
        at = kept
    return [text[i:j] for i, j in zip([0, *at], [*at, None])]


def encode_texts(texts: Iterable[str | None], path: str = BYTE_BPE_50K, size: int = 1, known: dict[str, list[int]] | None = None) -> list[list[int]]:
    """The ids of each text; `known` remembers those of fragments."""
    coder, pairs = encoder(path), inner_pairs(path)
    known = {} if known is None else known
    out = []
    for text in texts:
        if not text:
            out.append([])
            continue
        pieces = fragments(text, pairs, size)
        if len(known) > REMEMBERED:
            known.clear()
        for piece in pieces:
            if piece not in known:
                known[piece] = coder.encode_ordinary(piece)
        out.append(list(chain.from_iterable(map(known.__getitem__, pieces))))
    return out


def encode(column: Column | str, path: str = BYTE_BPE_50K) -> Column:
    """The ids of each text, as an array of int; empty for null and empty texts."""

    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known: dict[bytes, list[int]] = {}
        for batch in batches:
            yield pd.Series(encode_texts(batch, path, known=known))

    return ids(column)


def encoded(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = BYTE_BPE_50K) -> DataFrame:
    """(doc_id, ids) of every document."""
    return docs.select(F.col(doc_id).alias("doc_id"), encode(text, path).alias("ids"))
