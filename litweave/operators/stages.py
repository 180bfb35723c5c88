"""The document pipeline: candidates for every mention, a model's choice, conversion of what failed, and the resolved documents.

Every stage is a function of tables; each distinct search text is searched once and each distinct prompt answered once, however many
documents share it. Statuses are ok, empty (nothing to choose from) and failed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litweave.functions import text as T
from litweave.operators import models, relational, relations, retrieval
from litweave.operators.relations import Ontology
from litweave.session import cut

HITS = "array<struct<id:string,name:string,description:string>>"


@dataclass(frozen=True)
class Pattern:
    """An extraction pattern: what a text may show, and the fields it has."""

    name: str
    description: str
    fields: tuple[str, ...]

    def schema(self) -> dict[str, str]:
        return dict.fromkeys(self.fields, "")


Search = Callable[[DataFrame], DataFrame]


def token_lookup(index: DataFrame, k: int = 30) -> Search:
    """A search of texts(query_id, text) in an index(id, name, description): (query_id, rank, id, name, description)."""
    entries = index.withColumn("entry", F.concat_ws("|", "id", "name"))

    def search(queries: DataFrame) -> DataFrame:
        plain = queries.withColumn("text", F.regexp_replace("text", r"[,;]", " "))
        hits = retrieval.token_search(plain, entries.select("entry", "id", "name"), "query_id", "text", "entry", "id", "name", k)
        return hits.select("query_id", "rank", "entry").join(entries.select("entry", "id", "name", "description").dropDuplicates(["entry"]), "entry").drop("entry")

    return search


def candidates(found: DataFrame, ontology: Ontology, search: Search) -> DataFrame:
    """(doc_id, name, description, species, hits) of the mentions of an ontology's types, one row per name and species of a document."""
    mine = found.where((F.col("level") <= 1) & F.col("type").isin(list(ontology.types)) & (F.trim("name") != ""))
    species = F.coalesce("species", F.lit("")) if ontology.use_species and "species" in found.columns else F.lit("")
    named = mine.select("doc_id", "name", F.coalesce("description", F.lit("")).alias("description"), species.alias("species"))
    one = relational.best_per_key(named, ["doc_id", "name", "species"], -F.length("description"), F.col("description"))
    text = T.search_text(T.without_brackets(F.col("name")), *([F.col("species")] if ontology.use_species else []))
    asked = one.withColumn("query_id", F.sha2(text, 256)).withColumn("text", text)
    hits = search(asked.select("query_id", "text").dropDuplicates(["query_id"]))
    listed = hits.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", F.struct("id", "name", "description").alias("hit")))).alias("h"))
    listed = listed.select("query_id", F.transform("h", lambda h: h["hit"]).cast(HITS).alias("hits"))
    return asked.join(listed, "query_id", "left").select("doc_id", "name", "description", "species", F.coalesce("hits", F.array().cast(HITS)).alias("hits"))


def decomposed(docs: DataFrame, doc_id: str, text: str, factory: Callable[[], models.Client] = models.StubClient, types: tuple[str, ...] = ("GO", "cell_type")) -> DataFrame:
    """(doc_id, relations): the documents with the entities of the types, those in meta aside, put as the model splits them."""
    top = relations.mentions(docs, doc_id, text).where("level = 0").select("doc_id", "pre", "name", "type")
    split = models.decomposed(top, factory, types).where("rewritten is not null")
    return relations.rebuilt(docs, doc_id, text, split)


def chosen(offers: DataFrame, ontology: Ontology, factory: Callable[[], models.Client] = models.StubClient) -> DataFrame:
    """(doc_id, ontology, name, species, best_id, best_name, rank, status)."""
    j = models.judged(offers, factory, ontology.judge)
    rank = F.array_position(F.transform("hits", lambda h: h["id"]), F.col("best.id"))
    return j.select("doc_id", F.lit(ontology.name).alias("ontology"), "name", "species", F.col("best.id").alias("best_id"), F.col("best.name").alias("best_name"), rank.cast("int").alias("rank"), "status")


@dataclass(frozen=True)
class Conversion:
    """What could not be resolved in one ontology is tried in another; what succeeds takes the type."""

    source: str
    target: str
    new_type: str


def resolve(found: DataFrame, ontologies: list[Ontology], searches: dict[str, Search], conversions: list[Conversion] = (), factory: Callable[[], models.Client] = models.StubClient) -> tuple[DataFrame, DataFrame]:
    """(resolved mentions, choices). Mentions of an ontology's types without a choice are dropped, all others kept."""
    by_name = {o.name: o for o in ontologies}
    shown = cut(relations.examples(found))
    offers = {o.name: cut(candidates(found, o, searches[o.name]).join(shown, ["doc_id", "name"], "left")) for o in ontologies}
    choices = {o.name: cut(chosen(offers[o.name], o, factory)) for o in ontologies}
    for c in conversions:
        pending = choices[c.source].where("best_id is null").select("doc_id", "name", "species")
        target = by_name[c.target]
        again = found.where(F.col("type").isin(list(by_name[c.source].types))).withColumn("type", F.lit(target.types[0]))
        again = again.join(pending.select("doc_id", "name").distinct(), ["doc_id", "name"], "left_semi")
        more = cut(chosen(candidates(again, target, searches[c.target]).join(shown, ["doc_id", "name"], "left"), target, factory))
        success = more.where("best_id is not null")
        found = relational.retype(found, success, ["doc_id", "name"], "type", c.new_type)
        choices[c.target] = cut(choices[c.target].unionByName(success))
        choices[c.source] = cut(choices[c.source].join(success.select("doc_id", "name"), ["doc_id", "name"], "left_anti"))
    best = relational.union_branches(*choices.values())
    kept = relations.apply_best(found, best.where("best_id is not null"), ontologies)
    return kept, best


def statuses(choices: DataFrame) -> DataFrame:
    """How many mentions of each ontology were matched, had nothing to choose from, were refused or failed."""
    kind = F.when(F.col("status") != "ok", F.col("status")).when(F.col("best_id").isNull(), "refused").otherwise("matched")
    return choices.groupBy("ontology", kind.alias("status")).agg(F.count("*").alias("n"))
