"""Entity resolution on relation documents, as joins on the flat tables of `nested`.

Mentions are the entity nodes of `nested.nodes` with their links. Collecting looks one level into meta; relabelling and applying
go as deep as it goes. Rebuilding nests the flat tables again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litweave.functions import deepjson
from litweave.functions.text import dump_json, read_json
from litweave.operators import nested
from litweave.operators.relational import best_per_key, fallback_lookup

CELL = "__CELL__::"


@dataclass(frozen=True)
class Ontology:
    """What an ontology maps, and how its answers are judged."""

    types: tuple[str, ...]
    name: str
    use_species: bool = False
    judge: str = "strict"  # strict, relaxed (a parent will do) or forced (some hit must be taken)


def mentions(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row per entity with keys, role, path, level below the role (0 at the top), name, type, description and id."""
    e = nested.entities(nested.nodes(docs, doc_id, text))
    return e.withColumn("level", F.size(F.split("ent_path", r"\.")) - 1)


def collected(found: DataFrame, types: list[str]) -> DataFrame:
    """Distinct (doc_id, name, description) of entities of the types, at the top and one level into meta."""
    return found.where((F.col("level") <= 1) & F.col("type").isin(types) & (F.trim("name") != "")).select("doc_id", "name", F.coalesce("description", F.lit("")).alias("description")).distinct()


def relation_names(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    r = nested.relations(nested.nodes(docs, doc_id, text))
    return r.where(F.trim("name") != "").select("doc_id", "name", F.coalesce("description", F.lit("")).alias("description")).distinct()


def with_species(found: DataFrame, cell_lines: DataFrame | None = None, cell_types: list[str] | None = None) -> DataFrame:
    """Top-level entities with their species: of their own meta, else of the relation's contexts, else of its components and
    targets, each with one meta level, the first in order; else a cell line of the relation stands in as CELL + name."""
    top = found.where("level = 0")
    species = found.where((F.col("type") == "species") & (F.trim("name") != "") & (F.col("level") <= 1))
    own = species.where("level = 1").groupBy("doc_id", F.col("parent").alias("pre")).agg(F.min_by("name", "pre").alias("own"))
    key = ["doc_id", "relation_pre"]
    order = F.struct((F.col("role") != "context").cast("int").alias("r"), F.col("pre"))
    shared = species.groupBy(*key).agg(F.min_by("name", order).alias("shared"))
    out = top.join(own, ["doc_id", "pre"], "left").join(shared, key, "left")
    proxy = F.lit(None).cast("string")
    if cell_lines is not None:
        role = F.when(F.col("role") == "component", 0).when(F.col("role") == "target", 1).otherwise(2)
        cells = found.where(F.col("type").isin(cell_types or ["cell_line"]) & (F.col("level") <= 1)).join(cell_lines.select(F.col("name"), F.lit(1).alias("_known")), "name")
        out = out.join(cells.groupBy(*key).agg(F.min_by("name", F.struct(role.alias("r"), "pre")).alias("cell")), key, "left")
        proxy = F.concat(F.lit(CELL), F.col("cell"))
    return out.withColumn("species", F.coalesce("own", "shared", proxy, F.lit(""))).drop("own", "shared", *(["cell"] if cell_lines is not None else []))


def resolved_species(rows: DataFrame, scientific: DataFrame, cell_lines: DataFrame) -> DataFrame:
    """species replaced by the scientific name: of the cell line for a proxy, else by the name table (name, scientific)."""
    is_cell = F.col("species").startswith(CELL)
    s = rows.withColumn("_cell", F.when(is_cell, F.substr("species", F.lit(len(CELL) + 1)))).withColumn("_name", F.when(~is_cell, F.col("species")))
    s = s.join(cell_lines.select(F.col("name").alias("_cell"), F.col("species").alias("_by_cell")), "_cell", "left")
    s = s.join(scientific.select(F.col("name").alias("_name"), F.col("scientific").alias("_by_name")), "_name", "left")
    return s.withColumn("species", F.coalesce("_by_cell", "_by_name", F.col("_name"), F.lit(""))).drop("_cell", "_name", "_by_cell", "_by_name")


def first_species(found: DataFrame) -> DataFrame:
    """(doc_id, species): the first species named in each document."""
    s = found.where((F.col("type") == "species") & (F.trim("name") != ""))
    return s.groupBy("doc_id").agg(F.min_by("name", F.struct("block_no", "rel_no", "pre")).alias("species"))


def example_relation(found: DataFrame) -> DataFrame:
    """(doc_id, name, block_no, rel_no): the first relation that holds each name, however deep."""
    return best_per_key(found.select("doc_id", "name", "block_no", "rel_no"), ["doc_id", "name"], F.col("block_no"), F.col("rel_no"))


def examples(found: DataFrame) -> DataFrame:
    """(doc_id, name, example): the first relation that holds each name, as JSON of the names in each role, without descriptions."""
    key = ["doc_id", "block_no", "rel_no"]
    names = {r: F.array_sort(F.collect_set(F.when((F.col("role") == r) & (F.col("level") == 0), F.col("name")))).alias(f"{r}s") for r in ("component", "target", "context")}
    shown = found.groupBy(*key).agg(*names.values()).select(*key, F.to_json(F.struct("components", "targets", "contexts")).alias("example"))
    return example_relation(found.where(F.trim("name") != "")).join(shown, key).select("doc_id", "name", "example")


def apply_best(found: DataFrame, best: DataFrame, ontologies: list[Ontology]) -> DataFrame:
    """Mentions under the names and ids they were resolved to.

    best(doc_id, ontology, name, species, best_id, best_name). The first ontology that has the type decides; a mention of such a type
    without a match is dropped, others stay as they are.
    """
    ruling: Column = F.lit(None).cast("string")
    for o in reversed(ontologies):
        ruling = F.when(F.col("type").isin(list(o.types)), o.name).otherwise(ruling)
    rows = found.withColumn("ontology", ruling)
    by_species = [o.name for o in ontologies if o.use_species]
    b = best.select("doc_id", "ontology", "name", F.when(F.col("ontology").isin(by_species), F.coalesce("species", F.lit(""))).otherwise("").alias("species"), F.struct("best_id", "best_name").alias("_best"))
    b = b.groupBy("doc_id", "ontology", "name", "species").agg(F.max("_best").alias("_best"))
    keyed = rows.withColumn("_name", F.struct("doc_id", "ontology", "name")).withColumn("species", F.coalesce("species", F.lit("")) if "species" in rows.columns else F.lit(""))
    met = fallback_lookup(keyed, b.select(F.struct("doc_id", "ontology", "name").alias("_name"), "species", "_best"), "_name", "species", "_best").drop("_name")
    kept = met.where(F.col("ontology").isNull() | F.col("_best").isNotNull())
    return kept.withColumn("id", F.coalesce("_best.best_id", "id")).withColumn("name", F.coalesce("_best.best_name", "_best.best_id", "name")).drop("_best", "ontology")


def converted(pending: DataFrame, resolved: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """(still pending, moved) after another ontology resolved some; the caller merges and retypes."""
    hit = resolved.where("best_id is not null")
    return pending.join(hit.select(*key), key, "left_anti"), pending.join(hit, key)


def flattened(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, block_no, rel_no, relation, component, target) one row per pair of a relation."""
    n = nested.within(nested.within(nested.nodes(docs, doc_id, text), "sentence", "block_"), "relation", "rel_")
    # A relation and the entities right below it share its number, so one aggregate over the nodes, which come sorted by document, puts both together.
    n = n.where("kind = 'relation' or (kind = 'entity' and parent = rel_pre)").withColumn("e", F.struct("pre", "name", "type", "id"))
    kept = n.groupBy("doc_id", F.col("rel_pre").alias("relation_pre")).agg(
        F.max(F.when(F.col("kind") == "relation", F.struct("block_pos", "pos", "name"))).alias("r"),
        *(F.array_sort(F.collect_list(F.when((F.col("kind") == "entity") & (F.col("role") == role), F.col("e")))).alias(role[0]) for role in ("component", "target")),
    )
    pairs = kept.select("doc_id", F.col("r.block_pos").alias("block_no"), F.col("r.pos").alias("rel_no"), F.col("r.name").alias("relation"), "c", "t").withColumn("c", F.explode("c")).withColumn("t", F.explode("t"))
    cols = [F.col(f"{s}.{f}").alias(f"{n}_{f}") for s, n in (("c", "component"), ("t", "target")) for f in ("name", "type", "id")]
    return pairs.select("doc_id", "block_no", "rel_no", "relation", *cols)


def process_facts(flat: DataFrame, accessions: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """Genes and proteins acting on GO terms that have an id, with the protein's accession(name, accession) where known."""
    id_of = F.col("target_id")
    facts = flat.where(F.lower("component_type").isin("gene", "protein") & (F.col("target_type") == "GO"))
    if terms is not None:
        known = terms.groupBy(F.col("name").alias("target_name")).agg(F.min("id").alias("_id"))
        facts = facts.join(known, "target_name", "left")
        id_of = F.coalesce("target_id", "_id")
    facts = facts.withColumn("target_id", id_of).where("target_id is not null")
    a = accessions.groupBy(F.col("name").alias("component_name")).agg(F.min("accession").alias("uniprot_id"))
    return facts.join(a, "component_name", "left").withColumn("uniprot_mapped", F.col("uniprot_id").isNotNull()).select(*flat.columns, "uniprot_id", "uniprot_mapped")


def valid_only(relations: DataFrame) -> DataFrame:
    """Relations without a judgement or judged true."""
    return relations.where(F.coalesce("valid", F.lit(True)))


def rebuilt(docs: DataFrame, doc_id: str, text: str, rewritten: DataFrame | None = None) -> DataFrame:
    """(doc_id, relations): the nested documents built again from the flat tables, as normal JSON with current names.

    rewritten(doc_id, pre, rewritten) has JSON objects that take the place of entities with all that hangs on them.
    """
    n = nested.nodes(docs, doc_id, text)
    new = F.lit(None).cast("string").alias("rewritten") if rewritten is None else F.col("rewritten")
    n = n if rewritten is None else n.join(rewritten.select("doc_id", "pre", "rewritten"), ["doc_id", "pre"], "left")

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [(d, deepjson.dumps(nest(rows))) for d, rows in zip(b["doc_id"], b["rows"])]
            yield pd.DataFrame(out, columns=["doc_id", "relations"])

    own = F.struct("pre", "parent", "kind", "role", "name", "type", "description", "id", "valid", "sentence", new)
    return n.groupBy("doc_id").agg(F.array_sort(F.collect_list(own)).alias("rows")).mapInPandas(each, "doc_id bigint, relations string")


def nest(rows: list) -> list:
    made: dict[int, dict] = {}
    blocks: list[dict] = []
    plural = {"component": "components", "target": "targets", "context": "contexts"}
    kinds: dict[int, str] = {}
    for r in rows:
        pre, parent, kind = r["pre"], r["parent"], r["kind"]
        kinds[pre] = kind
        if kind == "sentence":
            made[pre] = {"sentence": r["sentence"], "rel_from_this_sent": []}
            blocks.append(made[pre])
        elif kind == "relation":
            made[pre] = {"components": [], "targets": [], "contexts": [], "relation": {k: r[k] for k in ("name", "description", "id") if r[k] is not None}}
            if r["valid"] is not None:
                made[pre]["valid"] = bool(r["valid"])
            made[parent]["rel_from_this_sent"].append(made[pre])
        elif parent in made:
            own = {**{k: r[k] for k in ("name", "type", "description", "id") if r[k] is not None}, "meta": []}
            new = read_json(r["rewritten"])
            made[parent]["meta" if kinds[parent] == "entity" else plural[r["role"]]].append(new if isinstance(new, dict) else own)
            if not isinstance(new, dict):  # what hangs on a rewritten entity is gone with it
                made[pre] = own
    return blocks


def without_descriptions(value: object) -> object:
    """A JSON value with every description taken out of it."""
    todo = [value]
    while todo:
        v = todo.pop()
        if isinstance(v, dict):
            v.pop("description", None)
            todo += v.values()
        elif isinstance(v, list):
            todo += v
    return value


def chosen_keys(value: dict, keys: list[str]) -> dict:
    """The chosen keys of a relation, or all of it if it has none of them."""
    kept = {k: v for k, v in value.items() if k in keys}
    return kept or value


def stripped(column: Column | str) -> Column:
    """JSON texts without descriptions at any depth; null if unreadable."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield b.map(lambda t: dump_json(without_descriptions(read_json(t))), na_action="ignore")

    return run(column)


def subset(column: Column | str, keys: list[str]) -> Column:
    """JSON objects with the chosen keys alone, or whole if they have none of them; null if unreadable or no object."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield b.map(lambda t: dump_json(chosen_keys(v, keys)) if isinstance(v := read_json(t), dict) else None, na_action="ignore")

    return run(column)
