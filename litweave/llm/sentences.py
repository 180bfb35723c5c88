"""Sentence boundaries across languages and scripts, by document-centred disambiguation.

A stop is ambiguous where the word before it may be an abbreviation, an initial or an ordinal, and the word after it may be
a name. Both are decided by unambiguous occurrences: first in the same document, then in the corpus, whose evidence
is gathered in one pass of partial counts, and by fixed lists only where both are silent or tied.

- A word is an abbreviation if it stands with a stop where no sentence can end (before a small letter, a comma, inside
  brackets) and hardly ever without the stop. Of a listed abbreviation a use without a stop tells something only if it
  is a word of its own as well (HOMOGRAPHS: 'a fig tree'); 'Dr Smith' and 'A vs B' are the same abbreviation spelt otherwise.
  Before a digit ('no. 3') the list stands.
- A capitalised word after an abbreviation begins a sentence if it occurs in small letters elsewhere; if it occurs
  capitalised in mid-sentence only, it is a name and the sentence goes on.
- Scripts have their own terminators: the ideographic stop, danda, the Arabic question mark; where a text has dandas a full
  stop is none. Thai has no terminator: white space between two Thai characters divides.

Corpus evidence counts from LEAST_COUNT occurrences on, however large the corpus, so a document is cut the same in any. It is kept as
a table. The HOT_WORDS most frequent of its words are sent to the tasks, a bounded number; the others, none of which can
have more than a HOT_WORDS-th of all occurrences, are joined to the documents that ask for them.

Defined results: null and blank texts give no unit. Spans have no outer white space and cover all else. Texts without any
terminator are one unit per paragraph; a blank line always ends a unit. Long texts are read whole; a stop inside brackets
that are closed in the same paragraph divides nothing, however far they reach.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litweave.session import cut

LEAST_COUNT = 3
HOT_WORDS = 100_000
COUNTS = ("nonfinal", "plain", "used", "small", "names")
# Abbreviations that a sentence does not end with, and those it may end with, by general usage.
NEVER_LAST = set(
    "dr prof mr mrs ms mx st sr jr rev hon gen col sgt capt lt fig figs eq eqs ref refs no nos vol vols suppl tab tabs sec ch "
    "pp p ed eds cf vs viz approx ca resp incl dept univ exp e.g i.e eg ie al bzw vgl abb z.b d.h u.a s bd nr hr hrsg evtl ggf sog "
    "env p.ex p.ej pag núm aprox dra sra fig.s nº art cap av mme mlle m ex ej usf.d inkl zzgl tel mt ft maj gov pres".split()
)
MAY_END = set("etc corp inc ltd co llc a.m p.m am pm u.s u.k usw s.d s.e.m sd ave blvd rd ph.d m.d b.sc m.sc min max jan feb mar apr jun jul aug sep sept oct nov dec".split())
# Those of them that are words of their own too, in one of the languages covered, so that a use without a stop tells something.
# The others are the same abbreviation with a stop and without one.
HOMOGRAPHS = set("fig no nos al art gen sec ed tab ref rev hon col ex exp cap pres bd am im mar sept max min inc corp app mt st ch".split())
# Words before an ordinal number in German.
ORDINAL_BEFORE = set("am im vom zum beim zur der die das dem den des ab bis seit nach vor und ein einem einen einer jeder jedem jeden ihr ihrem sein seinem".split())
CLOSERS = "\"'”’“»›)]}」』》〉】）］｣"
QUOTES = {"“": "”", "„": "“”", "«": "»", "‹": "›", "「": "」", "『": "』", "《": "》", "(": ")", "[": "]", "（": "）", "［": "］", "‘": "’"}
BRACKETS = {"(": ")", "[": "]", "（": "）", "［": "］"}
BRACKET = re.compile("[" + re.escape("".join([*BRACKETS, *BRACKETS.values()])) + "]")
STOP = re.compile(r"[.!?…。！？｡．।॥؟۔]+")
WIDE = set("。！？｡．")
BLANK_LINE = re.compile(r"(?:\r\n|\r(?!\n)|[\n\x85\N{LINE SEPARATOR}])[^\S\n\r\x85]*(?:\r\n|\r(?!\n)|[\n\x85\N{LINE SEPARATOR}])\s*|\N{PARAGRAPH SEPARATOR}\s*")
# Vowel signs and other marks belong to words, though the pattern language does not count them as letters.
MARKS = "".join(chr(c) for c in range(0x300, 0x1100) if unicodedata.category(chr(c))[0] == "M")
WORD_BEFORE = re.compile(rf"(?:[^\W\d_]\.)*(?:[^\W_][{MARKS}]*)+(?:[-’'][^\W_]+)*$")
NEXT_WORD = re.compile(r"[^\W_]+(?:[-’'][^\W_]+)*")
CITATION = re.compile(r"(?:\[\s*\d+(?:\s*[,;–-]\s*\d+)*\s*\])+|[⁰¹²³⁴-⁹]+(?:[,⁻–][⁰¹²³⁴-⁹]+)*")
JA_GOES_ON = re.compile(r"[とっがはをにでもやのへなだ]")
THAI_GAP = re.compile(r"(?<=[฀-๿])\s+(?=[฀-๿])")


AFTER = re.compile(r"\s+([^\W_]+)")


def small_word(text: str, at: int) -> bool:
    """Whether an ordinary word in small letters follows; symbols such as p53 may begin a sentence."""
    m = AFTER.match(text, at)
    return m is not None and m[1].islower() and m[1].isalpha()


@dataclass
class Evidence:
    """What the corpus, or one document, tells of words."""

    nonfinal: Counter = field(default_factory=Counter)  # with a stop where no sentence ends
    plain: Counter = field(default_factory=Counter)  # without a stop
    used: Counter = field(default_factory=Counter)  # the same in small letters before a word in small letters
    small: Counter = field(default_factory=Counter)  # in small letters
    names: Counter = field(default_factory=Counter)  # capitalised in mid-sentence


TOKEN = re.compile(r"((?:[^\W\d_]\.)+[^\W\d_]|[^\W\d_][^\W_]*(?:[-’'][^\W_]+)*)(\.?)")


def gather(text: str) -> Evidence:
    """Count the unambiguous occurrences of each word of one document."""
    e = Evidence()
    depth, last, before_small = 0, 0, False
    for m in TOKEN.finditer(text):
        gap = text[last : m.start()]
        if gap != " ":
            depth = max(0, depth + gap.count("(") + gap.count("[") - gap.count(")") - gap.count("]"))
        word, stop = m.groups()
        low = word.lower()
        after = text[m.end() : m.end() + 2]
        if stop:
            if after[:1] in (",", ";", ":") or depth and after[:1].isspace() or after[:1].isspace() and small_word(text, m.end()):
                e.nonfinal[low] += 1
        else:
            e.plain[low] += 1
            if low in HOMOGRAPHS and word == low and after[:1] == " " and after[1:].islower():
                e.used[low] += 1
        if word[:1].islower():
            e.small[low] += 1
        elif word[:1].isupper() and before_small and gap == " ":
            e.names[low] += 1
        before_small = word[:1].islower() and not stop
        last = m.end()
    return e


def evidence_rows(texts: list[str | None]) -> pd.DataFrame:
    total: dict[str, Counter] = {k: Counter() for k in COUNTS}
    for t in texts:
        if t:
            e = gather(t)
            for k, c in total.items():
                c.update(getattr(e, k))
    rows = {w: [total[k][w] for k in total] for w in set().union(*total.values())}
    return pd.DataFrame([(w, *c) for w, c in rows.items()], columns=["word", *total])


@dataclass
class Corpus(Evidence):
    """Evidence of a corpus: that of its most frequent words at hand, that of the others as a table, if there are others."""

    others: DataFrame | None = None


def filled(evidence: Evidence, rows: Iterable) -> Evidence:
    for r in rows:
        for k in COUNTS:
            if r[k]:
                getattr(evidence, k)[r["word"]] = r[k]
    return evidence


def corpus_evidence(docs: DataFrame, text: str, hot_words: int = HOT_WORDS) -> Corpus:
    """Evidence of all documents, of words that occur LEAST_COUNT times."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield evidence_rows(b.iloc[:, 0].tolist())

    counts = docs.select(text).dropna().mapInPandas(each, ", ".join(["word string", *(f"{c} bigint" for c in COUNTS)]))
    sums = counts.groupBy("word").agg(*(F.sum(c).alias(c) for c in COUNTS))
    kept = cut(sums.where(
        ((F.col("nonfinal") >= LEAST_COUNT) & (F.col("nonfinal") >= F.col("plain")))
        | ((F.col("used") >= LEAST_COUNT) & (F.col("used") > F.col("nonfinal")))
        | ((F.col("small") >= LEAST_COUNT) & (F.col("small") >= F.col("names")))
    ))
    often = F.col("nonfinal") + F.col("plain")
    hot = kept.withColumn("often", often).orderBy(F.desc("often"), "word").limit(hot_words + 1).collect()
    corpus = filled(Corpus(), hot[:hot_words])
    if len(hot) > hot_words:
        last = hot[hot_words]
        corpus.others = kept.where((often < last["often"]) | (often == last["often"]) & (F.col("word") >= last["word"]))
    return corpus


def asked(text: str) -> set[str]:
    """The words around the stops of a text, whose evidence the corpus may be asked for."""
    out = set()
    for m in STOP.finditer(text):
        out.add(Splitter.word_before(text, 0, m.start())[0].lower())
        if n := NEXT_WORD.search(text, m.end()):
            out.add(n.group().lower())
    return out


class Splitter:
    def __init__(self, corpus: Evidence | None = None):
        self.corpus = corpus or Evidence()

    def is_abbreviation(self, low: str, doc: Evidence) -> bool:
        if low in NEVER_LAST or low in MAY_END:
            return not self.ordinary(low, doc)
        if not low[:1].isalpha():
            return False
        for e in (doc, self.corpus):
            seen, plain = e.nonfinal[low], e.plain[low]
            if seen or plain:
                if seen > plain and (e is self.corpus or seen > 1):
                    return True
                if plain > seen:
                    return False
        return False

    def ordinary(self, low: str, doc: Evidence) -> bool:
        """Whether a listed abbreviation that is a word of its own is used as that word here: the document decides, then the corpus, then the list."""
        if low in HOMOGRAPHS:
            for e in (doc, self.corpus):
                seen, used = e.nonfinal[low], e.used[low]
                if used != seen:
                    return used > seen
        return False

    def begins(self, word: str, doc: Evidence) -> bool:
        """Whether a capitalised word after an abbreviation begins a sentence."""
        low = word.lower()
        for e in (doc, self.corpus):
            if e.small[low] or e.names[low]:
                return e.small[low] >= e.names[low]
        return False

    def spans(self, text: str | None) -> list[tuple[int, int]]:
        if not text or not text.strip():
            return []
        doc = gather(text)
        danda = "।" in text or "॥" in text
        out: list[tuple[int, int]] = []
        at = 0
        for m in [*BLANK_LINE.finditer(text), None]:
            end = m.start() if m else len(text)
            self.paragraph(text, at, end, doc, danda, out)
            at = m.end() if m else end
        return out

    def paragraph(self, text: str, begin: int, end: int, doc: Evidence, danda: bool, out: list) -> None:
        cuts = [(m.start(), m.end()) for m in THAI_GAP.finditer(text, begin, end)]
        skip = self.bracketed(text, begin, end)
        at = begin
        start = begin
        while (m := STOP.search(text, at, end)) is not None:
            at = m.end()
            if any(a < m.start() < b for a, b in skip):
                continue
            stop = self.boundary(text, start, m, end, doc, danda)
            if stop is not None:
                cuts.append((stop, stop))
                start = at = stop
        cuts.sort()
        last = begin
        for a, b in [*cuts, (end, end)]:
            i, j = last, a
            while i < j and text[i].isspace():
                i += 1
            while i < j and text[j - 1].isspace():
                j -= 1
            if i < j:
                if out and out[-1][1] > begin - 1 and not any(unicodedata.category(c)[0] in "LN" for c in text[i:j]) and out[-1][0] >= begin:
                    out[-1] = (out[-1][0], j)  # punctuation alone is no sentence
                else:
                    out.append((i, j))
            last = max(b, last)

    @staticmethod
    def bracketed(text: str, begin: int, end: int) -> list[tuple[int, int]]:
        """Spans of brackets that close, from the opening to just before a stop that the closing one follows."""
        spans, stack = [], []
        for m in BRACKET.finditer(text, begin, end):
            i, c = m.start(), m.group()
            if c in BRACKETS:
                stack.append(i)
            elif stack and c == BRACKETS[text[stack[-1]]]:
                a = stack.pop()
                spans.append((a, i - 1 if i and text[i - 1] in ".!?。！？" else i))
        return spans

    def boundary(self, text: str, start: int, m: re.Match, end: int, doc: Evidence, danda: bool) -> int | None:
        """The end of the sentence that this stop closes, marks after it included, or None."""
        mark, i = m.group(), m.end()
        wide = mark[-1] in WIDE
        # Closing quotation marks, brackets and citations right after the stop.
        quoted = False
        while i < end:
            if text[i] in CLOSERS and self.closes(text, start, i):
                quoted = quoted or text[i] not in ")]}）］"
                i += 1
            elif (c := CITATION.match(text, i, end)) is not None:
                i = c.end()
            else:
                break
        # A spaced closing guillemet.
        gap = re.compile(r"\s*[»›]").match(text, i, end)
        if gap and text.count("«", start, i) > text.count("»", start, i):
            quoted, i = True, gap.end()
        rest = i
        while rest < end and text[rest].isspace():
            rest += 1
        if rest >= end:
            return i
        spaced, following = rest > i, text[rest]
        if wide or mark[-1] in "।॥":
            if quoted and not spaced and JA_GOES_ON.match(following):
                return None
            if not quoted and self.inside(text, start, m.start()):
                return None
            return i
        if mark[-1] in "؟۔":
            return i
        if following in ",;:)]}、，；：" or (following in "-–—" and not spaced):
            return None
        if mark.startswith("..") or mark[0] == "…":
            return i if self.opens(text, rest, end, doc, spaced) and not following.islower() else None
        if mark[-1] in "!?":
            # A quotation inside a sentence does not divide it.
            if self.opens(text, rest, end, doc, spaced):
                return i
            return i if not following.isascii() and following.isalpha() and not following.islower() else None
        return i if self.full_stop(text, start, m, i, rest, end, doc, danda) else None

    def closes(self, text: str, start: int, i: int) -> bool:
        c = text[i]
        if c == '"':
            return text.count('"', start, i) % 2 == 1
        if c == "'":
            return text.count(" '", start, i) + text.startswith("'", start) > 0
        if c in "“‘":  # a closing mark in German
            return text.count("„", start, i) + text.count("‚", start, i) > 0
        return True

    @staticmethod
    def inside(text: str, start: int, at: int) -> bool:
        """Whether a quotation opened in this sentence is still open."""
        part = text[start:at]
        return any(part.count(a) > part.count(b) for a, b in (("「", "」"), ("『", "』"), ("《", "》"), ("（", "）")))

    def opens(self, text: str, at: int, end: int, doc: Evidence, spaced: bool) -> bool:
        """Whether a sentence can begin here: a capital, a digit, an opening mark, a script without case, or a symbol."""
        c = text[at]
        if c in "“„«‹‘\"'([¿¡「『《（":
            if not spaced and c in "([":
                return False
            k = at + 1
            while k < end and (text[k].isspace() or text[k] in "“„«‹‘\"'([¿¡"):
                k += 1
            return k < end and (not text[k].islower() or c in "¿¡" or self.symbol(text, k, end))
        if c.isdigit():
            return spaced
        if c.isalpha():
            return not c.islower() or self.symbol(text, at, end)
        return unicodedata.category(c)[0] not in "P" or c in "*#•–—-" and spaced

    @staticmethod
    def symbol(text: str, at: int, end: int) -> bool:
        """Whether the word is a symbol such as p53 or mTOR, which keeps its small letter at the beginning."""
        m = NEXT_WORD.match(text, at, end)
        w = m.group().split("-")[0] if m else ""
        return len(w) > 1 and w[0].islower() and any(c.isdigit() or c.isupper() for c in w[1:]) and not text.startswith("://", m.end())

    @staticmethod
    def word_before(text: str, start: int, end: int) -> tuple[str, str]:
        """The word that ends here, and some of what stands before it."""
        size = 60
        while True:
            head = text[max(start, end - size) : end]
            w = WORD_BEFORE.search(head)
            if w is None:
                return "", head
            if w.start() or end - size <= start or "." in head:
                return w.group(), head[: w.start()]
            size *= 4  # a word longer than the part looked at

    def full_stop(self, text: str, start: int, m: re.Match, i: int, rest: int, end: int, doc: Evidence, danda: bool) -> bool:
        spaced, c = rest > i, text[rest]
        word, head = self.word_before(text, start, m.start())
        low = word.lower()
        if danda and "\N{DEVANAGARI SIGN INVERTED CANDRABINDU}" <= text[m.start() - 1] <= "\N{DEVANAGARI LETTER BBA}":
            return False
        if not spaced and i == m.end():
            # Without a space: a small-letter word or a number before, a capitalised word behind, and no address around.
            n = NEXT_WORD.match(text, rest, end)
            nxt = n.group() if n else ""
            around = text[max(start - 1, *(text.rfind(c, start, m.start()) for c in " \t\n\r\xa0")) + 1 : m.start()]
            if "@" in around or "//" in around or around.startswith("www."):
                return False
            caseless = c.isalpha() and not c.islower() and not c.isupper()
            if caseless:
                return len(low) > 1 or not low
            if not (c.isupper() and (nxt[1:2].islower() or len(nxt) == 1 or nxt.isupper() and len(nxt) > 2) or c in "“„«¿¡" or self.symbol(text, rest, end)):
                return False
            if not word:
                return text[m.start() - 1] in ")]%”»\"'"
            if self.is_abbreviation(low, doc) or "." in low:
                return False
            return len(word) >= 3 and (word[-1].islower() or word[-1].isdigit() or word.isupper() and nxt[1:2].islower()) or word.isdigit()
        if not self.opens(text, rest, end, doc, spaced or i > m.end()):
            return False
        if not word:
            return True
        n = NEXT_WORD.search(text, rest, end)
        nxt = n.group() if n else ""
        if text[m.start() - 1 : m.start()] != word[-1:]:
            return True
        if word.isdigit():
            before = head.split()
            if before and before[-1].lower() in ORDINAL_BEFORE and head[-1:].isspace() and len(word) <= 2:
                return False
            return True
        single = len(word) == 1 and word.isalpha()
        chained = "." in word
        caseless = not word[0].islower() and not word[0].isupper()
        if caseless:
            return len([x for x in word if x.isalpha()]) > 1 if word[0] < "ऀ" or word[0] > "฀" else not (len(word) <= 4)
        if i > m.end() and not single:
            return True  # a closing mark stands between
        before = head.rstrip()
        if single and (before[-1:].isdigit() or head[-1:] in tuple("°µ%/")):
            return True  # a unit
        if single and word.islower():
            return False
        if single and len(nxt) == 1 and nxt.isupper() and text.startswith(".", rest + 1):
            return False  # initials
        if single or chained and low not in MAY_END and low not in NEVER_LAST:
            return self.begins(nxt, doc) and not before.endswith(".")
        before_digit = c.isdigit() or c in "([" and text[rest + 1 : rest + 2].isdigit()
        if low in HOMOGRAPHS and not before_digit and not (low == "al" and before.endswith("et")) and self.ordinary(low, doc):
            return True
        if low in NEVER_LAST and not (low in ("no", "al", "ex", "s", "p", "m") and self.plain_use(low, text, m.start(), nxt, c)):
            return low == "al" and c.isupper() and self.begins(nxt, doc)
        if low in MAY_END:
            if c.isdigit():
                return True
            return low == "etc" or low == "usw" or low in ("p.m", "a.m", "min", "max", "am", "pm") or self.begins(nxt, doc) or not nxt[:1].isupper()
        if self.is_abbreviation(low, doc):
            return self.begins(nxt, doc) and not c.isdigit()
        return True

    @staticmethod
    def plain_use(low: str, text: str, at: int, nxt: str, c: str) -> bool:
        """Whether a word that is also an abbreviation is used as a word: 'No.' as an answer."""
        return low == "no" and not c.isdigit() and nxt[:1].isupper() and not nxt[:2].isupper() and len(nxt) > 1


def sentence_units(docs: DataFrame, keys: list[str], text: str, corpus: Evidence) -> DataFrame:
    """(keys, sent_no, start_char, end_char) of every text; keys are bigint columns."""
    key_schema = [f"{k} bigint" for k in keys]
    schema = ", ".join([*key_schema, "sent_no int, start_char int, end_char int"])
    hot = Evidence(*(getattr(corpus, k) for k in COUNTS))
    others = getattr(corpus, "others", None)

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        splitter = Splitter(hot)
        for b in batches:
            rows = []
            for *own, t, met in zip(*(b[k] for k in keys), b[text], b["_met"]):
                at_hand = splitter
                if met is not None and len(met):
                    both = Evidence(*(Met(getattr(hot, k), {r["word"]: r[k] for r in met}) for k in COUNTS))
                    at_hand = Splitter(both)
                rows += [(*own, n, i, j) for n, (i, j) in enumerate(at_hand.spans(t))]
            yield pd.DataFrame(rows, columns=[*keys, "sent_no", "start_char", "end_char"])

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(*own, w) for *own, t in zip(*(b[k] for k in keys), b[text]) for w in asked(t) if not any(w in getattr(hot, k) for k in COUNTS)]
            yield pd.DataFrame(rows, columns=[*keys, "word"])

    typed = docs.select(*(F.col(k).cast("bigint").alias(k) for k in keys), F.col(text)).where(F.col(text).isNotNull())
    if others is None:
        return typed.withColumn("_met", F.lit(None).cast("array<struct<word:string>>")).mapInPandas(each, schema)
    words = typed.mapInPandas(ask, ", ".join([*key_schema, "word string"])).distinct()
    met = words.join(others, "word").groupBy(*keys).agg(F.collect_list(F.struct("word", *COUNTS)).alias("_met"))
    same = [F.col(f"t.{k}").eqNullSafe(F.col(f"m.{k}")) for k in keys]
    joined = typed.alias("t").join(met.alias("m"), same, "left").select("t.*", "_met")
    return joined.mapInPandas(each, schema)


class Met:
    """Counts of words joined to a document, before those at hand."""

    def __init__(self, hot: Counter, own: dict[str, int]):
        self.hot, self.own = hot, own

    def __getitem__(self, word: str) -> int:
        got = self.own.get(word)
        return self.hot[word] if got is None else got
