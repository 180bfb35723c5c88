"""Calls of a language model as an ordinary map over rows, and the stages built on them.

A client is any object with `query(prompt) -> str`; it is made once per task by a factory, so that it may hold a connection. Prompts are
answered once each: distinct prompts only are sent, with their digest as key, and what is written to a cache table is not asked
again. A failed call is a row with an error, not a failed job. Tests use the deterministic StubClient.
"""

from __future__ import annotations

import json
import re
import time
from collections import deque
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litweave.functions import text as T
from litweave.functions.prompts import prompt as stored
from litweave.session import cut

ANSWERS = "key string, answer string, error string"
MOST_HITS, HIT_CHARS, PROMPT_CHARS = 30, 400, 8000


class Client(Protocol):
    def query(self, prompt: str) -> str: ...


class StubClient:
    """Answers from the prompt alone: the first id offered, or yes or no by whether the claim's words are in the sentence."""

    def query(self, prompt: str) -> str:
        if "CLAIM:" in prompt:
            given, _, claim = prompt.rpartition("CLAIM:")
            sentence = given.rpartition("GIVEN:")[2]
            said = set(re.findall(r"\w+", sentence.lower()))
            return "yes" if all(w in said for w in re.findall(r"\w+", claim.lower())) else "no"
        if "SPLIT:" in prompt:
            name = prompt.rpartition("SPLIT:")[2].strip()
            first, _, rest = name.partition(" of ")
            return json.dumps({"name": rest, "type": "GO", "meta": [{"name": first, "type": "GO", "meta": []}]}, ensure_ascii=False) if rest else "None"
        m = re.search(r"^- (\S+) \|", prompt, re.M)
        return m[1] if m else "NONE"


class RateLimiter:
    """At most `calls` in any `seconds`, within one task; the number of tasks bounds the whole."""

    def __init__(self, calls: int, seconds: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.calls, self.seconds, self.clock, self.sleep, self.past = calls, seconds, clock, sleep, deque()

    def wait(self) -> None:
        now = self.clock()
        while self.past and now - self.past[0] >= self.seconds:
            self.past.popleft()
        if len(self.past) >= self.calls:
            self.sleep(self.seconds - (now - self.past[0]))
            self.past.popleft()
        self.past.append(self.clock())


def retried(call: Callable[[], str], attempts: int = 3, first_pause: float = 1.0, most_pause: float = 60.0, sleep: Callable[[float], None] = time.sleep) -> str:
    """The result of a call that may fail, with pauses that double."""
    pause = first_pause
    for k in range(attempts):
        try:
            return call()
        except Exception:
            if k == attempts - 1:
                raise
            sleep(min(pause, most_pause))
            pause *= 2
    raise AssertionError


def answered(rows: DataFrame, prompt: str, factory: Callable[[], Client] = StubClient, cache: DataFrame | None = None, attempts: int = 3, pause: float = 2.0) -> DataFrame:
    """rows with answer and error. cache(key, answer) holds what was answered before; null prompts are not asked."""
    keyed = rows.withColumn("key", F.sha2(prompt, 256))
    asked = keyed.where(F.col(prompt).isNotNull()).select("key", F.col(prompt).alias("prompt")).dropDuplicates(["key"])
    if cache is not None:
        asked = asked.join(cache.select("key"), "key", "left_anti")

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = factory()
        for b in batches:
            out = []
            for key, p in zip(b["key"], b["prompt"]):
                try:
                    out.append((key, retried(lambda p=p: client.query(p), attempts, pause), None))
                except Exception as e:
                    out.append((key, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["key", "answer", "error"])

    # Cut, so that no later action calls the model again.
    new = cut(asked.mapInPandas(each, ANSWERS))
    known = new if cache is None else new.unionByName(cache.select("key", "answer", F.lit(None).cast("string").alias("error")))
    return keyed.join(known, "key", "left").withColumn("answer", T.without_thinking(F.col("answer")))


def choice_prompt(name: Column, description: Column, hits: Column, example: Column | None = None) -> Column:
    """Ask which of the hits is meant: at most MOST_HITS lines of HIT_CHARS, cut where PROMPT_CHARS are full."""
    lines = F.transform(F.slice(hits, 1, MOST_HITS), lambda h: F.concat(F.lit("- "), h["id"], F.lit(" | "), T.squeeze(F.concat_ws(" | ", h["name"], h["description"]), HIT_CHARS)))
    start = F.struct(F.lit(0).alias("used"), F.array().cast("array<string>").alias("kept"))

    def add(a: Column, line: Column) -> Column:
        used = a["used"] + F.length(line) + 1
        return F.struct(used.alias("used"), F.when(used <= PROMPT_CHARS, F.concat(a["kept"], F.array(line))).otherwise(a["kept"]).alias("kept"))

    kept = F.aggregate(lines, start, add)["kept"]
    shown = F.coalesce(F.concat(F.lit("\nUsed in: "), example), F.lit("")) if example is not None else F.lit("")
    return F.concat(F.lit("Which entry is meant by: "), T.search_text(name, description), shown, F.lit("\nAnswer with its id, or NONE.\n"), F.array_join(kept, "\n"))


def judged(mentions: DataFrame, factory: Callable[[], Client] = StubClient, method: str = "strict") -> DataFrame:
    """mentions(name, description, hits[, example]) with best, the hit the model chose, and status ok, empty (no hit offered) or failed.

    method is the policy, with a prompt of its own: strict (the same thing only), relaxed (a parent will do) or forced (some hit must be
    taken). example, a relation in which the mention is used, is shown where there is one.
    """
    offered = F.size(F.coalesce("hits", F.array().cast(mentions.schema["hits"].dataType))) > 0
    example = F.col("example") if "example" in mentions.columns else None
    asked = F.concat(F.lit(stored(f"select/{method}.txt") + "\n"), choice_prompt(F.col("name"), F.col("description"), F.col("hits"), example))
    out = answered(mentions.withColumn("prompt", F.when(offered, asked)), "prompt", factory)
    best = T.hit_contained(F.col("answer"), F.col("hits"), strict=method == "strict")
    if method == "forced":
        best = F.coalesce(best, F.get("hits", F.lit(0)))
    status = F.when(~offered, "empty").when(F.col("error").isNotNull(), "failed").otherwise("ok")
    return out.withColumn("best", F.when(offered & F.col("error").isNull(), best)).withColumn("status", status).drop("prompt", "key")


def checked(relations: DataFrame, factory: Callable[[], Client] = StubClient, method: str = "strict") -> DataFrame:
    """relations(sentence, claim) with valid, the model's yes or no; method is strict or loose, each with a prompt of its own."""
    rows = relations.withColumn("prompt", F.concat(F.lit(stored(f"validate/{method}.txt") + "\nGIVEN: "), "sentence", F.lit("\nCLAIM: "), "claim"))
    return answered(rows, "prompt", factory).withColumn("valid", T.yes_no(F.col("answer"))).drop("prompt", "key")


def covered(first: DataFrame, second: DataFrame, doc_id: str, claim: str, factory: Callable[[], Client] = StubClient) -> DataFrame:
    """Each claim of one run with whether the claims of the other run on the same document cover it."""
    others = second.groupBy(doc_id).agg(F.array_join(F.array_sort(F.collect_set(claim)), "\n").alias("others"))
    asked = F.concat(F.lit(stored("cover/claims.txt") + "\nGIVEN: "), "others", F.lit("\nCLAIM: "), claim)
    rows = first.join(others, doc_id, "left").withColumn("prompt", F.when(F.col("others").isNotNull(), asked))
    return answered(rows, "prompt", factory).withColumn("covered", F.coalesce(T.yes_no(F.col("answer")), F.lit(False))).drop("prompt", "key", "others")


def decomposed(entities: DataFrame, factory: Callable[[], Client] = StubClient, types: tuple[str, ...] = ("GO", "cell_type")) -> DataFrame:
    """entities(name, type) with `rewritten`, the JSON of what the model splits the name into, null to keep it."""
    ask = F.col("type").isin(list(types)) & (F.trim("name") != "")
    rows = entities.withColumn("prompt", F.when(ask, F.concat(F.lit(stored("split/entity.txt") + "\nTYPE: "), "type", F.lit("\nSPLIT: "), "name")))
    out = answered(rows, "prompt", factory)
    return out.withColumn("rewritten", F.when(F.trim("answer").startswith("{") & F.try_parse_json("answer").isNotNull(), F.col("answer"))).drop("prompt", "key")


def extracted(sentences: DataFrame, factory: Callable[[], Client]) -> DataFrame:
    """sentences(doc_id, sent_no, sentence) with the model's relations as a JSON array, each asked with the document's
    earlier sentences; an answer that can't be read is a failed sentence, not a failed document."""
    from litweave.operators.relational import running_history

    rows = running_history(sentences, "doc_id", "sent_no", "sentence")
    rows = rows.withColumn("prompt", F.concat(F.lit(stored("extract/relations.txt") + "\nBefore it: "), "history", F.lit("\nThe sentence: "), "sentence"))
    out = answered(rows, "prompt", factory).withColumn("relations", T.json_array("answer"))
    return out.withColumn("status", F.when(F.col("relations").isNull(), "failed").otherwise("ok")).drop("prompt", "key")


def classified(docs: DataFrame, text: str, patterns: list[str], factory: Callable[[], Client]) -> DataFrame:
    """docs with the patterns (names) that the model sees in the text."""
    rows = docs.withColumn("prompt", F.concat(F.lit("Which of these patterns does the text show, as a JSON array: " + ", ".join(patterns) + "\n"), text))
    out = answered(rows, "prompt", factory)
    named = F.from_json(T.json_array("answer"), "array<string>")
    return out.withColumn("patterns", F.array_intersect(named, F.array(*(F.lit(p) for p in patterns)))).drop("prompt", "key")
