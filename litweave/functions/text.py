"""Scalar functions on names, answers and free text, as column expressions unless a tolerant parser is needed."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from litweave.functions import deepjson

# The ordered rewrites that bring entity names to a common form.
NAME_REWRITES = (
    (r"(alpha|beta|gamma)(?=\s|$)", ""),
    (r"-\d+(?=\s|$)", ""),
    (r"(\d+)[a-z](?=\s|$)", "$1"),
    (r"-[a-z](?=\s|$)", ""),
    (r"[-_]", " "),
    (r"\s+", " "),
    (r"^\s+|\s+$", ""),
)


def normal_name(name: Column) -> Column:
    """Common form of an entity name; null stays null, a name of nothing but suffixes becomes empty."""
    return reduce(lambda c, r: F.regexp_replace(c, r[0], r[1]), NAME_REWRITES, F.lower(name))


def words(text: Column) -> Column:
    """Words between white space; none for a blank text."""
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def subphrases(phrase: Column, most_words: int | None = None) -> Column:
    """All runs of consecutive words as structs (n words, phrase)."""
    ws = F.split(phrase, " ")
    starts = F.sequence(F.lit(1), F.size(ws))

    def runs(i: Column) -> Column:
        longest = F.size(ws) - i + 1
        longest = longest if most_words is None else F.least(longest, F.lit(most_words))
        return F.transform(F.sequence(F.lit(1), longest), lambda n: F.struct(n.alias("n"), F.array_join(F.slice(ws, i, n), " ").alias("phrase")))

    return F.flatten(F.transform(starts, runs))


def without_brackets(text: Column) -> Column:
    """Drop (...) and [...] and trim."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"\([^)]*\)", ""), r"\[[^\]]*\]", ""))


def search_text(*parts: Column) -> Column:
    """The non-empty parts joined by a comma."""
    return F.concat_ws(", ", *(F.when(F.trim(p) != "", F.trim(p)) for p in parts))


def _bare(answer: Column) -> Column:
    return F.regexp_replace(F.trim(answer), "^[\"'`]+|[\"'`]+$", "")


def hit_contained(answer: Column, hits: Column, strict: bool = False) -> Column:
    """The first hit (struct with id) whose id stands in the answer; strict asks for id boundaries around it."""
    said = F.upper(_bare(answer))

    def named(h: Column) -> Column:
        if not strict:
            return F.instr(said, F.upper(h["id"])) > 0
        return F.concat(F.lit(" "), F.regexp_replace(said, r"[^A-Z0-9:_.-]+", " "), F.lit(" ")).contains(F.concat(F.lit(" "), F.upper(h["id"]), F.lit(" ")))

    return F.when((said != "NONE") & (said != ""), F.get(F.filter(hits, named), F.lit(0)))


def hit_equal(answer: Column, hits: Column, by_name: bool = True) -> Column:
    """The first hit whose id, else whose name, equals the answer without regard to case."""
    said = F.lower(_bare(answer))
    by_id = F.get(F.filter(hits, lambda h: F.lower(h["id"]) == said), F.lit(0))
    return F.coalesce(by_id, F.get(F.filter(hits, lambda h: F.lower(h["name"]) == said), F.lit(0))) if by_name else by_id


def yes_no(answer: Column) -> Column:
    """True for an answer that begins with yes, false with no, else null."""
    a = F.lower(F.trim(answer))
    return F.when(a.startswith("yes"), True).when(a.startswith("no"), False)


def without_thinking(answer: Column) -> Column:
    """Drop the first <think> block and what blanks follow it."""
    return F.trim(F.regexp_replace(answer, r"(?s)^(.*?)<think>.*?</think>", "$1"))


def clean_uri(uri: Column) -> Column:
    """The short form of a term's address: the last part, with PREFIX_digits as PREFIX:digits."""
    tail = F.regexp_replace(F.regexp_replace(uri, r"^.*/obo/", ""), r"^.*[#/]", "")
    return F.regexp_replace(tail, r"^([A-Za-z]+)_(\d+)$", "$1:$2")


def printable(text: Column) -> Column:
    """Without control and format characters, but with newline, return and tab."""
    return F.regexp_replace(text, r"[\p{C}&&[^\n\r\t]]", "")


def one_line(text: Column) -> Column:
    return F.translate(text, "\r\n", "  ")


def simple_sentences(text: Column) -> Column:
    """A plain split after a stop and white space; litweave's text operators have the full one."""
    return F.filter(F.split(F.trim(text), r"(?<=[.!?])\s+"), lambda s: s != "")


def squeeze(text: Column, most: int | None = None) -> Column:
    """White space evened out; beyond `most` characters cut and marked with dots."""
    t = F.trim(F.regexp_replace(text, r"\s+", " "))
    return t if most is None else F.when(F.length(t) > most, F.concat(F.rtrim(F.left(t, F.lit(most))), F.lit("..."))).otherwise(t)


def id_from_path(path: Column) -> Column:
    """The folder that a file lies in, as an id."""
    return F.try_element_at(F.split(path, "/"), F.lit(-2))


def common_pairs(a: Column, b: Column) -> Column:
    """How many key-value pairs two maps share."""
    return F.size(F.map_filter(a, lambda k, v: F.coalesce(b[k] == v, F.lit(False))))


def salvage_array(text: str | None) -> str | None:
    """The first JSON value in a text, as an array; an object is put into one. Null if there is none.

    If nothing can be decoded, what stands between the first [ and the last ] is returned as it is.
    """
    if text is None:
        return None
    at = 0
    while (at := min((i for i in (text.find("[", at), text.find("{", at)) if i >= 0), default=-1)) >= 0:
        try:
            value, end = deepjson.raw_decode(text, at)
            return text[at:end] if isinstance(value, list) else f"[{text[at:end]}]"
        except ValueError:
            at += 1
    first, last = text.find("["), text.rfind("]")
    return text[first : last + 1] if 0 <= first < last else None


def merge_values(base: object, over: object) -> object:
    """Deep merge: objects by key; list items that share two or more pairs with one there are merged into it, others added; else `over` wins."""
    if isinstance(base, dict) and isinstance(over, dict):
        return {**base, **{k: merge_values(base[k], v) if k in base else v for k, v in over.items()}}
    if not (isinstance(base, list) and isinstance(over, list)):
        return over
    out = list(base)
    for item in over:
        twins = (i for i, b in enumerate(out) if isinstance(b, dict) and isinstance(item, dict) and sum(k in b and b[k] == v for k, v in item.items()) >= 2)
        at = next(twins, None)
        if at is None:
            out.append(item)
        else:
            out[at] = merge_values(out[at], item)
    return out


@F.pandas_udf(StringType())
def json_array(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for t in texts:
        yield t.map(salvage_array, na_action="ignore")


def read_json(text: str | None) -> object:
    """The value of a JSON text; None if it is null or unreadable."""
    try:
        return deepjson.loads(text) if isinstance(text, str) else None
    except ValueError:
        return None


def dump_json(value: object) -> str | None:
    return None if value is None else deepjson.dumps(value, sort_keys=True)


def _merged(base: str | None, over: str | None) -> str | None:
    b, o = read_json(base), read_json(over)
    return dump_json(b if o is None else o if b is None else merge_values(b, o))


@F.pandas_udf(StringType())
def json_merge(base: pd.Series, over: pd.Series) -> pd.Series:
    """Deep merge of JSON texts; an unreadable or null side counts as absent."""
    return pd.Series([_merged(b if isinstance(b, str) else None, o if isinstance(o, str) else None) for b, o in zip(base, over)], dtype="object")
