"""Freely entered values to the entries of a reference list, by a trie searched with a Levenshtein automaton.

Every name and alias of the list is in the trie, whole, once as it stands and once with the words of its own first and the
frame words (classes, directions, numbers, Greek letters: words that stand beside many others in the list) after them, so
that their order in a value does not matter. A value is put in the same form, spelling, abbreviation and plural evened out,
and the trie is walked in step with an automaton that accepts everything within a distance that depends on the length of
the own words. `candidates` gives all entries within it with their distances. Frames rank them: an entry that differs
in a number, class or direction names another thing and is left out, however near. Names that are codes (one word without small
letters, such as symbols) count only without error, as another letter is another code. Where entries of several organisms bear
a name, the organism named decides. `match` takes the nearest entry.

Each row is mapped in place, without a shuffle; a task remembers the values it has seen. The list is broadcast: it must have
at most REFERENCE_ROWS rows, else an error is raised. Defined results: null and blank values give no row; a listed name
always finds its entry; values that name nothing, no listed entry, or several equally near ones are UNMATCHED (`mapped_all` lists
these). Repeated rows are mapped each.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import cached_property

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNMATCHED = "UNMATCHED"
REFERENCE_ROWS = 500_000
FRAME_NEIGHBOURS = 20
CODE_LETTERS = 8
REMEMBERED = 200_000
LINKS = ("of", "the", "a")
# Greek letters, look-alike Cyrillic letters and Roman numerals.
GREEK = dict(zip("αβγδεζηθικλμ", "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()))
CYRILLIC = str.maketrans("аеіјорсухԁһԛѕѵАВЕКМНОРСТУХІЈЅ", "aeijopcyxdhqsvABEKMHOPCTYXIJS")
ROMAN = dict(zip("i ii iii iv v vi vii viii ix x xi xii".split(), map(str, range(1, 13))))
# Words that qualify a name without changing what it names, and spellings of one word.
QUALIFIERS = set("the a an of recombinant endogenous phospho phosphorylated native purified total wild type wt gene genes putative full length protein".split())
SPELLINGS = {
    "organisation": "organization", "signalling": "signaling", "localisation": "localization", "upregulation": "positive regulation",
    "downregulation": "negative regulation", "up regulation": "positive regulation", "down regulation": "negative regulation",
    "positively regulates": "positive regulation", "negatively regulates": "negative regulation", "positively regulating": "positive regulation",
    "negatively regulating": "negative regulation", "upregulates": "positive regulation", "downregulates": "negative regulation",
    "upregulating": "positive regulation", "downregulating": "negative regulation", "regulates": "regulation", "regulating": "regulation",
    "regulatory control": "regulation", "control": "regulation", "activation of": "positive regulation", "inhibition of": "negative regulation",
    "stimulation of": "positive regulation", "differentiating": "differentiation",
}
AROUND = re.compile(r"^\s*(?:go\s*:(?!\s*\d)|the process of|process of)\s*|\s*\((?:go term|go|term)\)\s*$|,?\s+(?:in cells|in vivo|in vitro|wild[ -]type)\s*\W*$", re.I)
CAMEL = re.compile(r"^[A-Z]?[a-z]{2,}(?:[A-Z][a-z]+)+[-_]?(?:\d+|[a-z]+)?$")
GO_ID = re.compile(r"\bgo\s*[:_ ]?\s*(\d{7})\b", re.I)
NOTHING = re.compile(r"^\W*(?:none|null|nil|n/?a|no match|nothing|unknown|none of (?:the above|these|them)|not (?:specified|applicable|found|available)|tbd|see text)?\W*$", re.I)


def even(text: str) -> str:
    """Compatibility forms, look-alikes, accents and invisible characters evened out; case is kept."""
    text = unicodedata.normalize("NFKC", text)
    if not text.isascii():
        text = re.sub("[αβγδεζηθικλμ]", lambda m: f" {GREEK[m.group()]} ", text)
        text = text.translate(CYRILLIC)
        text = "".join(c for c in unicodedata.normalize("NFD", text) if unicodedata.category(c) not in ("Mn", "Cf"))
    return text


def split_camel(text: str) -> str:
    s = text.strip(" \t\"'.,;")
    if CAMEL.match(s):
        s = re.sub(r"(?<=[a-z])(?=[A-Z])|(?<=[a-z]{3})(?=\d)", " ", s)
        return s
    return text


def tokens_of(text: str) -> list[str]:
    text = re.sub(r"\bno\s*\.\s*(?=\d)", " ", text.casefold())
    return re.findall(r"[^\W_]+\.?", text.replace("_", " "))


def listed(name: str) -> str:
    """A name as it is listed, whatever its case and blanks."""
    return " ".join(name.casefold().split())


def allowed(letters: int) -> int:
    """The distance within which words of so many letters may be met."""
    return 0 if letters < 5 else 1 if letters < 9 else 2


def distance(a: str, b: str) -> int:
    """Errors between two words, two letters that changed places counting as one."""
    if not a:
        return len(b)
    before, row = [], [*range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        old, row = row, [i]
        for j, y in enumerate(b, 1):
            d = min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y))
            row.append(min(d, before[j - 2] + 1) if i > 1 and j > 1 and x == b[j - 2] and y == a[i - 2] else d)
        before = old
    return row[-1]


class Trie:
    """Words or whole names; `near` walks it in step with a Levenshtein automaton and returns all within a distance.

    The automaton is run as bit masks, one for none, one and two errors each: bit i is set if the first i letters of the
    pattern can be read with so many errors. Of as many parts of a
    pattern as there may be errors and one more, one has none. So the trie is walked forward from the end of a first part without
    errors and, as a trie of the reversed words, backward from a last one; if the errors are in both, the part between has none, so a
    forward walk with one error up to its end finds the word. Most of the trie stays unvisited.
    """

    def __init__(self, words: set[str]):
        self.words = words
        self.forward, self.backward = self.grown(words), self.grown({w[::-1] for w in words})

    @staticmethod
    def grown(words: set[str]) -> dict:
        root: dict = {}
        for w in sorted(words):
            node = root
            for c in w:
                node = node.setdefault(c, {})
            node[""] = w
        return root

    def near(self, pattern: str, most: int, firm: int = 0, swaps: bool = False) -> list[tuple[int, str]]:
        """(distance, word) of all words within `most`, at most 2, in order; words with errors in the last `firm` letters may be left out. With `swaps` two letters that changed places are one error."""
        if most == 0:
            return [(0, pattern)] if pattern in self.words else []
        own = len(pattern) - firm
        part = own // (most + 1)
        found = {w: e for e, w in self.walk(self.forward, pattern, most, part, 0, swaps)}
        found |= {w[::-1]: e for e, w in self.walk(self.backward, pattern[::-1], most, firm + (own - part if most == 1 else part), 0, swaps)}
        if most == 2:
            found |= {w: e for e, w in self.walk(self.forward, pattern, most, 0, own - part, swaps)}
        return sorted((e, w) for w, e in found.items())

    @staticmethod
    def walk(root: dict, pattern: str, most: int, exact: int, late: int, swaps: bool) -> list[tuple[int, str]]:
        """Words that agree in the first `exact` letters, and have a second error from letter `late` on only."""
        node = root
        skip = max(0, exact - 1)  # the last of them may have changed places with the next one
        for c in pattern[:skip]:
            if (node := node.get(c)) is None:
                return []
        m = len(pattern)
        at: dict[str, int] = {}
        for i, c in enumerate(pattern):
            at[c] = at.get(c, 0) | 1 << i
        full, last = (1 << (m + 1)) - 1, 1 << m
        open1 = full & ~((1 << exact) - 1)
        open2 = open1 & ~((1 << late) - 1) if most > 1 else 0
        found: list[tuple[int, str]] = []
        stack = [(node, 1 << skip, (3 << skip) & open1, (7 << skip) & open2, 0, 0)]
        get = at.get
        while stack:
            node, s0, s1, s2, t0, t1 = stack.pop()
            for c, child in node.items():
                if c:
                    mask = get(c, 0)
                    a0 = (s0 & mask) << 1
                    a1 = ((s1 & mask) << 1 | s0 | (s0 | a0) << 1 | (t0 & mask) << 2) & open1
                    a2 = ((s2 & mask) << 1 | s1 | (s1 | a1) << 1 | (t1 & mask) << 2) & open2
                    if a0 or a1 or a2:
                        ahead = mask >> 1 if swaps else 0
                        stack.append((child, a0, a1, a2, s0 & ahead, s1 & ahead))
                elif (s0 | s1 | s2) & last:
                    found.append((0 if s0 & last else 1 if s1 & last else 2, child))
        return found


@dataclass
class Name:
    """A listed name: its words, which of them are its own, its class words and numbers, and the entries that bear it."""

    own: list[str]
    frame: list[str]
    code: bool
    entries: set = field(default_factory=set)


class Lexicon:
    """A reference list: entries (id, names and aliases, organism), and the organisms' names."""

    def __init__(self, entries: list[tuple[str, list[str], str | None]], organisms: dict[str, str] | None = None):
        self.organisms = {tuple(t.rstrip(".") for t in tokens_of(even(k))): v for k, v in (organisms or {}).items()}
        self.ids = {i for i, _, _ in entries}
        named = [(i, o, n, [t.rstrip(".") for t in tokens_of(self.spell(even(n)))]) for i, names, o in entries for n in names]
        beside: defaultdict[str, set] = defaultdict(set)
        for _, _, _, ts in named:
            for t in ts:
                beside[t].update(x for x in ts if x != t and not x.isdigit())
        self.frames = {t for t, n in beside.items() if len(n) > FRAME_NEIGHBOURS} | set(GREEK.values())
        self.frame_trie = Trie({f for f in self.frames if len(f) > 5})
        self.by_text: defaultdict[str, set] = defaultdict(set)  # the name as it is listed
        self.by_code: defaultdict[str, set] = defaultdict(set)  # names of one word, blanks and hyphens left out
        self.by_key: defaultdict[str, list[Name]] = defaultdict(list)
        self.own_words: set[str] = set()
        for i, o, n, ts in named:
            if not ts:
                continue
            self.by_text[listed(n)].add((i, o))
            if len(ts) == 1:
                self.by_code["".join(ts)].add((i, o))
            own, frame = self.parts(ts)
            self.own_words.update(own)
            code = len(ts) == 1 and not any(c.islower() for c in n) and (len(n) <= CODE_LETTERS or any(c.isdigit() for c in n))
            # A name is kept under its own words followed by its frame, and as it stands, if that differs.
            for key in {" ".join([*own, *frame]), " ".join(ts)}:
                same = next((x for x in self.by_key[key] if (x.own, x.frame, x.code) == (own, frame, code)), None)
                if same is None:
                    same = Name(own, frame, code)
                    self.by_key[key].append(same)
                same.entries.add((i, o))
        self.trie = Trie(set(self.by_key))

    @staticmethod
    def spell(text: str) -> str:
        low = re.sub(r"[-_/]", " ", text.casefold())
        low = re.sub(r"\s+", " ", low)
        for a, b in SPELLINGS.items():
            if a in low:
                low = re.sub(rf"\b{a}\b", b, low)
        return low

    def parts(self, ts: list[str]) -> tuple[list[str], list[str]]:
        own = [t for t in ts if t not in self.frames and not t.isdigit() and t not in LINKS]
        return own, [t for t in ts if t in self.frames and t not in LINKS or t.isdigit()]

    def frame_forms(self, t: str) -> list[str]:
        """The frame words that a word may stand for: itself, without a plural s, or what it abbreviates."""
        w = t.rstrip(".")
        if w in self.frames or w.isdigit():
            return [w]
        if w.endswith("s") and w[:-1] in self.frames:
            return [w[:-1]]
        if t.endswith(".") and len(w) >= 3:
            return sorted(f for f in self.frames if f.startswith(w))
        return []

    def organism(self, ts: list[str]) -> tuple[list[str], set[str]]:
        """The words without those that name an organism, and the organisms named."""
        if not self.organisms:
            return ts, set()
        plain, out, named, i = [t.rstrip(".") for t in ts], [], set(), 0
        while i < len(ts):
            for n in (3, 2, 1):
                key = tuple(plain[i : i + n])
                if len(key) == n and (o := self.organisms.get(key)):
                    named.add(o)
                    i += n
                    break
            else:
                out.append(ts[i])
                i += 1
        return out, named

    def match(self, value: str, organism: str | None = None) -> str:
        """The entry that a value means, or UNMATCHED: of all entries within the distance the nearest, if it is one alone."""
        near = self.candidates(value, organism, nearest=True)
        best = {i for i, e in near.items() if e == min(near.values())}
        return best.pop() if len(best) == 1 else UNMATCHED

    def candidates(self, value: str, organism: str | None = None, nearest: bool = False) -> dict[str, int]:
        """All entries within the distance that a value of its length may have, with their distances; nearest: a wider automaton is run only where the narrower one met none."""
        self.nearest = nearest
        text = even(value)
        named: set[str] = set()
        if organism is not None and organism.strip():
            rest, named = self.organism(tokens_of(even(organism)))
            if rest or not named:
                return {}
        who = next(iter(named)) if len(named) == 1 else None
        if len(named) <= 1 and (hit := self.borne(self.by_text.get(listed(value), ()), who)):
            return dict.fromkeys(hit, 0)
        if NOTHING.match(text):
            return {}
        ids = {f"GO:{m}" for m in GO_ID.findall(text)} & self.ids
        if ids:
            return dict.fromkeys(ids, 0)
        while (bare := AROUND.sub("", text)) != text:
            text = bare
        outside = re.sub(r"[\(\[][^()\[\]]*[\)\]]", " ", text)
        text = outside if re.search(r"\w", outside) else text
        raw, said = self.organism(tokens_of(self.spell(split_camel(text))))
        if len(named | said) > 1:
            return {}
        who = next(iter(named | said), None)
        if hit := self.look_up(raw, who):
            return hit
        core = [t for t in raw if t.rstrip(".") not in QUALIFIERS or t.rstrip(".") in self.frames]
        if core != raw and (hit := self.look_up(core, who)):
            return hit
        if raw and raw[-1].rstrip(".") in QUALIFIERS:
            return self.look_up([t for t in raw[:-1] if t.rstrip(".") not in QUALIFIERS or t.rstrip(".") in self.frames], who)
        return {}

    def look_up(self, raw: list[str], who: str | None) -> dict[str, int]:
        code = "".join(t.rstrip(".") for t in raw)
        if code in self.by_code and (hit := self.borne(self.by_code[code], who)):
            return dict.fromkeys(hit, 0)
        own: list[str] = []
        frame: list[list[str]] = []  # for each frame word what it may stand for
        plain: list[str] = []
        for k, t in enumerate(raw):
            w = t.rstrip(".")
            forms = [str(ROMAN[w])] if w in ROMAN and k else [] if w in LINKS else self.frame_forms(t)
            plain.append(forms[0] if len(forms) == 1 else w)
            if forms:
                frame.append(forms)
            elif w not in LINKS:
                own.append(w)
        if len(own) > 1 and "".join(own) in self.own_words:
            own = ["".join(own)]
        hit = self.search(own, frame, plain, who)
        for x in own if not hit and len(own) > 1 else ():
            # A frame word with a typing error, out of its place: the one it is near to, if there is just one.
            target = [f for e, f in self.frame_trie.near(x, 1)] if len(x) > 5 and x not in self.own_words else []
            if len(target) == 1:
                return self.look_up([target[0] if t.rstrip(".") == x else t for t in raw], who)
        return hit

    def search(self, own: list[str], frame: list[list[str]], plain: list[str], who: str | None) -> dict[str, int]:
        """Entries within the distance whose frame agrees.

        With several own words one may be a frame word with a typing error, so the name is searched as it stands as well. An
        abbreviation is read as each frame word it may stand for, one place after the other.
        """
        if not plain:
            return {}
        whole = " ".join(own)
        most = allowed(len(whole))
        sole = all(len(f) == 1 for f in frame)
        key = " ".join([*own, *(f[0] for f in frame)]) if sole else None
        hits = self.agreeing([(0, key)], own, frame, plain, who) if key in self.by_key else {}
        for e in range(1 if sole else 0, most + 1) if self.nearest else [most] if most or not sole else ():
            if hits and self.nearest:
                break
            if not sole:  # with readings to choose from, the own words are searched alone
                near = [(d, k) for d, w in self.own_trie.near(whole, e, swaps=True) for k in self.own_keys[w]]
            else:
                near = self.trie.near(key, e, len(key) - len(whole) if len(own) == 1 else 0, swaps=True)
                if len(own) > 1 and (stands := " ".join(plain)) != key:
                    near += self.trie.near(stands, e, swaps=True)
            for i, d in self.agreeing(near, own, frame, plain, who).items():
                hits[i] = min(d, hits.get(i, d))
        return hits

    def agreeing(self, near: list[tuple[int, str]], own: list[str], frame: list[list[str]], plain: list[str], who: str | None) -> dict[str, int]:
        """Of the keys that are near, the entries whose numbers and frame words are those of the value."""
        out: dict[str, int] = {}
        digits = [c for w in own for c in w if c.isdigit()]
        for e, key in near:
            for name in self.by_key[key]:
                if e and (name.code or digits != [c for w in name.own for c in w if c.isdigit()]):
                    continue
                same = len(name.frame) == len(frame) and all(f in forms for f, forms in zip(name.frame, frame))
                if not same and len(own) > 1 and e:
                    # No frame word or number of either side is missing on the other, but frame words that an unknown word is near to.
                    there = key.split(" ")
                    lost = [t for t in there if t not in plain and (t in self.frames or t.isdigit())]
                    new = [w for w in own if w not in name.own]
                    same = all(t in there for t in plain if t in self.frames or t.isdigit())
                    same = same and len(lost) <= len(new) and all(any(distance(w, t) <= allowed(len(t)) for w in new) for t in lost)
                if same:
                    for i in self.borne(name.entries, who):
                        out[i] = min(e, out.get(i, e))
        return out

    @cached_property
    def own_keys(self) -> dict[str, list[str]]:
        out: defaultdict[str, list[str]] = defaultdict(list)
        for key, names in self.by_key.items():
            for own in {" ".join(n.own) for n in names if n.own}:
                out[own].append(key)
        return out

    @cached_property
    def own_trie(self) -> Trie:
        return Trie(set(self.own_keys))

    @staticmethod
    def borne(entries: set | tuple, who: str | None) -> set[str]:
        """The ids among the entries that the organism named does not rule out."""
        return {i for i, o in entries if who is None or o is None or o == who}

    def answer(self, value: str) -> str:
        """The entry that a model's answer settles on."""
        text = re.sub(r"<think>.*?(?:</think>|$)", " ", even(value), flags=re.S | re.I)
        if NOTHING.match(text):
            return UNMATCHED
        try:
            v = json.loads(text)
            if isinstance(v, dict):
                text = str(v.get("id") or v.get("name") or "")
        except ValueError:
            pass
        kept = re.sub(r"\b(?:not|instead of|rather than|except)\s+\W*go\s*[:_ ]?\s*\d{7}", " ", text, flags=re.I)
        ids = [f"GO:{m}" for m in GO_ID.findall(kept)]
        if ids:
            return ids[-1] if ids[-1] in self.ids else UNMATCHED
        if GO_ID.search(text):
            return UNMATCHED
        return self.match(re.sub(r"^\W*(?:the best match is|best match\s*:|answer\s*:|the answer is|match\s*:)\s*", "", text.strip(), flags=re.I))


def rows_of(reference: DataFrame) -> list:
    rows = reference.limit(REFERENCE_ROWS + 1).collect()
    if len(rows) > REFERENCE_ROWS:
        raise ValueError(f"a reference list of more than {REFERENCE_ROWS} rows can't be broadcast")
    return rows


def organism_names(rows: list, organism: str, common: str) -> dict[str, str]:
    names: dict[str, str] = {}
    short: Counter = Counter()
    for o in {r[organism] for r in rows if r[organism]}:
        names[o] = o
        first, _, last = o.partition(" ")
        if last:
            short[f"{first[0]}. {last}"] += 1
            names[f"{first[0]}. {last}"] = o
    for s, n in short.items():
        if n > 1:
            del names[s]
    return names | {r[common]: r[organism] for r in rows if r[common] and r[organism]}


def protein_lexicon(reference: DataFrame) -> Lexicon:
    rows = rows_of(reference.select("accession", "protein_name", "gene_symbol", "alt_names", "organism", "organism_common"))
    entries = [(r["accession"], list(dict.fromkeys(n for n in (r["protein_name"], r["gene_symbol"], *(r["alt_names"] or ())) if n)), r["organism"]) for r in rows]
    return Lexicon(entries, organism_names(rows, "organism", "organism_common"))


def term_lexicon(reference: DataFrame) -> Lexicon:
    rows = rows_of(reference.select("go_id", "name", "synonyms"))
    return Lexicon([(r["go_id"], [n for n in (r["name"], *(r["synonyms"] or ())) if n], None) for r in rows])


def given(values: DataFrame) -> DataFrame:
    rows = values.select(F.col("row_id").cast("bigint").alias("row_id"), "value", "organism")
    return rows.where(F.col("value").rlike(r"\S"))


def remembering(of: Callable[[str, str | None], object]) -> Callable[[str, str | None], object]:
    seen: dict[tuple, object] = {}

    def ask(value: str, organism: str | None) -> object:
        got = seen.get((value, organism))
        if got is None:
            if len(seen) > REMEMBERED:
                seen.clear()
            got = seen[value, organism] = of(value, organism)
        return got

    return ask


def mapped(values: DataFrame, lexicon: Lexicon, answers: bool = False) -> DataFrame:
    """values(row_id, value, organism) to (row_id, ref_id); answers: values are a model's answers."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = remembering((lambda v, _: lexicon.answer(v)) if answers else lexicon.match)
        for b in batches:
            yield pd.DataFrame({"row_id": b["row_id"], "ref_id": [ask(v, o) for v, o in zip(b["value"], b["organism"])]})

    return given(values).mapInPandas(each, "row_id bigint, ref_id string")


def mapped_all(values: DataFrame, lexicon: Lexicon) -> DataFrame:
    """values(row_id, value, organism) to (row_id, ref_id, distance) of all entries within the distance."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = remembering(lambda v, o: sorted(lexicon.candidates(v, o).items()))
        for b in batches:
            rows = [(i, *hit) for i, v, o in zip(b["row_id"], b["value"], b["organism"]) for hit in ask(v, o)]
            yield pd.DataFrame(rows, columns=["row_id", "ref_id", "distance"])

    return given(values).mapInPandas(each, "row_id bigint, ref_id string, distance int")
