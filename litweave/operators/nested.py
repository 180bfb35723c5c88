"""Deeply nested relation documents as flat tables that keep their parent-child links.

Each text is walked depth-first once. Every node gets a pre-order and a post-order number; a node lies below another of
the same document exactly if its interval [pre, post] lies within the other's. Sentence, relation and entity tables are the
nodes of one kind, and `within` links a lower table to a higher one by that containment in one sort per document.

Defined results: null, blank and unreadable (cut off) texts give no nodes. A text may be a list of blocks, an object with
`relations`, one block alone, or any of these as a JSON string, wrapped however often. A lone object or string stands for a list of one;
nulls count as positions but give no node; a bare string is an entity with only a name. Legacy names (target, context) and
current ones (targets, contexts) mean the same; a relation that has both gets the current one's positions first. Depth is
unbounded: reader and walk keep their own stack. Repeated documents under new ids are documents of their own; a document without an
id gives no nodes, as they could not be told apart; ids are taken as unique.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from litweave.functions import deepjson

NODES = (
    "doc_id bigint, pre bigint, post bigint, parent bigint, depth int, kind string, pos int, role string, "
    "name string, type string, description string, id string, valid boolean, sentence string"
)
COLUMNS = [c.split()[0] for c in NODES.split(", ")]
# The field names of a relation's roles, current and legacy.
ROLES = {"component": ("components",), "target": ("targets", "target"), "context": ("contexts", "context")}


def as_list(value: object) -> list:
    return value if isinstance(value, list) else [] if value is None else [value]


def text_of(value: object) -> str | None:
    return value if value is None or isinstance(value, str) else deepjson.dumps(value)


def load(text: str | None) -> object:
    """The value of a JSON text, unwrapped where it is a string of JSON; None if it can't be read."""
    value: object = text
    while isinstance(value, str):
        try:
            value = deepjson.loads(value.lstrip("\N{ZERO WIDTH NO-BREAK SPACE}"))
        except ValueError:
            return None
    return value


def blocks_of(text: str | None) -> list:
    value = load(text)
    while isinstance(value, dict) and "relations" in value:
        inner = value["relations"]
        value = load(inner) if isinstance(inner, str) else inner
    return [x for x in as_list(value)] if not isinstance(value, (int, float, bool)) else []


def children(kind: str, value: dict) -> Iterator[tuple[str, str | None, int, object]]:
    """(kind, role, position, value) of the nodes right below one, in order."""
    if kind == "sentence":
        for i, x in enumerate(as_list(value.get("rel_from_this_sent"))):
            if isinstance(x, dict):
                yield "relation", None, i, x
        return
    if kind == "relation":
        for role, names in ROLES.items():
            i = 0
            for x in (x for n in names for x in as_list(value.get(n))):
                if isinstance(x, (dict, str)):
                    yield "entity", role, i, x
                i += 1
        return
    for i, x in enumerate(as_list(value.get("meta"))):
        if isinstance(x, (dict, str)):
            yield "entity", None, i, x


def walk(text: str | None) -> list[tuple]:
    """Nodes of one text as (pre, post, parent, depth, kind, pos, role, value), in pre-order."""
    nodes: list[list] = []
    tick = 0
    for b, block in enumerate(blocks_of(text)):
        if not isinstance(block, dict):
            continue
        nodes.append([tick, None, None, 0, "sentence", b, None, block])
        stack = [(len(nodes) - 1, children("sentence", block))]
        tick += 1
        while stack:
            at, rest = stack[-1]
            below = next(rest, None)
            if below is None:
                nodes[at][1] = tick
                tick += 1
                stack.pop()
                continue
            kind, role, pos, value = below
            nodes.append([tick, None, nodes[at][0], len(stack), kind, pos, role or nodes[at][6], value])
            tick += 1
            stack.append((len(nodes) - 1, children(kind, value) if isinstance(value, dict) else iter(())))
    return [tuple(n) for n in nodes]


def row(doc_id: int, node: tuple) -> tuple:
    pre, post, parent, depth, kind, pos, role, value = node
    if isinstance(value, str):
        value = {"name": value}
    if kind == "sentence":
        said = (None, None, None, None, None, text_of(value.get("sentence")))
    elif kind == "relation":
        r = value.get("relation")
        r = r if isinstance(r, dict) else {"name": r}
        valid = value.get("valid")
        said = (text_of(r.get("name")), None, text_of(r.get("description")), text_of(r.get("id")), valid if isinstance(valid, bool) else None, None)
    else:
        said = (*(text_of(value.get(k)) for k in ("name", "type", "description", "id")), None, None)
    return (doc_id, pre, post, parent, depth, kind, pos, role, *said)


def nodes(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """All nodes of all documents, one row each (columns NODES)."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: list[tuple] = []
            for i, t in zip(batch.iloc[:, 0], batch.iloc[:, 1]):
                out += [row(i, n) for n in walk(t)]
                if len(out) > 50_000:
                    yield pd.DataFrame(out, columns=COLUMNS).astype({"parent": "Int64"})
                    out = []
            if out:
                yield pd.DataFrame(out, columns=COLUMNS).astype({"parent": "Int64"})

    return docs.select(doc_id, text).where(F.col(doc_id).isNotNull() & F.col(text).rlike(r"\S")).mapInPandas(each, NODES)


def within(all_nodes: DataFrame, kind: str, prefix: str) -> DataFrame:
    """Link every node to the node of `kind` whose interval contains its own, by adding {prefix}pre and {prefix}pos.

    Nodes of `kind` are taken as disjoint (sentences, relations), so the last one begun before a node is the only one that
    can contain it. One sort by (document, pre-order) serves any number of links.
    """
    begun = F.when(F.col("kind") == kind, F.struct("pre", "post", "pos"))
    last = F.last(begun, ignorenulls=True).over(Window.partitionBy("doc_id").orderBy("pre"))
    linked = all_nodes.withColumn("_up", last)
    inside = (F.col("_up.pre") <= F.col("pre")) & (F.col("_up.post") >= F.col("post"))
    return linked.withColumns({f"{prefix}{c}": F.when(inside, F.col(f"_up.{c}")) for c in ("pre", "pos")}).drop("_up")


def sentences(all_nodes: DataFrame) -> DataFrame:
    return all_nodes.where("kind = 'sentence'").select("doc_id", "pre", "post", F.col("pos").alias("block_no"), "sentence")


def relations(all_nodes: DataFrame) -> DataFrame:
    return (
        within(all_nodes, "sentence", "block_").where("kind = 'relation'")
        .select("doc_id", "pre", "post", F.col("block_pre").alias("sentence_pre"), F.col("block_pos").alias("block_no"), F.col("pos").alias("rel_no"), "name", "description", "id", "valid")
    )


def entities(all_nodes: DataFrame) -> DataFrame:
    """One row per entity with the keys of its sentence, relation and parent entity, and its path below the role.

    The path is read off the pre-order: with the nodes of a document sorted, the positions of the entities whose
    intervals are still open are the path, kept as the latest position at each depth.
    """
    linked = within(within(all_nodes, "sentence", "block_"), "relation", "rel_")
    return entity_paths(linked.where("kind = 'entity'")).select(
        "doc_id", "pre", "post", F.col("block_pre").alias("sentence_pre"), F.col("rel_pre").alias("relation_pre"),
        "parent", "depth", F.col("block_pos").alias("block_no"), F.col("rel_pos").alias("rel_no"),
        "role", "ent_path", "name", "type", "description", "id",
    )


def entity_paths(linked: DataFrame) -> DataFrame:
    """Add ent_path by one ordered pass over each document: a fold that carries the open entities' positions."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_: list[tuple[int, str]] = []
        doc = None
        for batch in batches:
            paths = []
            for d, pre, post, pos in zip(batch["doc_id"], batch["pre"], batch["post"], batch["pos"]):
                if d != doc:
                    doc, open_ = d, []
                while open_ and open_[-1][0] < pre:
                    open_.pop()
                open_.append((post, f"{open_[-1][1]}.{pos}" if open_ else str(pos)))
                paths.append(open_[-1][1])
            batch["ent_path"] = paths
            yield batch

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in linked.schema.fields) + ", ent_path string"
    return linked.sortWithinPartitions("doc_id", "pre").mapInPandas(each, schema)


def found(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, block_no, rel_no, role, ent_path): one row per entity."""
    e = entities(nodes(docs, doc_id, text).drop("sentence", "description", "id", "valid", "name", "type").withColumns({c: F.lit(None).cast("string") for c in ("name", "type", "description", "id")}))
    return e.select(F.col("doc_id").alias(doc_id), "block_no", "rel_no", "role", "ent_path")
