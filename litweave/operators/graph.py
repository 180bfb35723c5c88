"""Graphs as node and edge tables: reachability, components, local context, levels.

Edges point from child to parent (u is sub, v is obj). Graphs of at most CORE_EDGES edges, a bound that is counted first, are walked
in tasks to which the edges are sent; larger ones by joins on frontiers, with a reliable checkpoint a round, until
nothing changes. There is no bound on rounds; core_edges=0 runs all as joins, with the same results. Defined results: edges
with a null end are ignored, repeated edges count once, self-loops reach nothing new; an unknown start raises ValueError.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litweave.session import cut

CORE_EDGES = 200_000


def core(edges: DataFrame, most: int) -> list[tuple] | None:
    """The edges (u, v) if there are at most so many, else None."""
    if most <= 0:
        return None
    rows = edges.limit(most + 1).collect()
    return [tuple(r) for r in rows] if len(rows) <= most else None


def last_edge(edges: DataFrame, position: str) -> DataFrame:
    """One relation per pair: the last one given."""
    return edges.dropna(subset=["u", "v"]).groupBy("u", "v").agg(F.max_by("relation", position).alias("relation"))


def reach(edges: DataFrame, starts: DataFrame, core_edges: int = CORE_EDGES) -> DataFrame:
    """(start, node): all nodes reachable along edges u -> v, the start itself included."""
    step = edges.select("u", "v").dropna().distinct()
    begun = starts.select(F.col("node").alias("start")).distinct()
    few = core(step, core_edges)
    if few is not None:
        after: defaultdict = defaultdict(list)
        for u, v in few:
            after[u].append(v)
        after = dict(after)

        def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                for start in b["start"]:
                    seen, todo = {start}, [start]
                    while todo:
                        for v in after.get(todo.pop(), ()):
                            if v not in seen:
                                seen.add(v)
                                todo.append(v)
                    yield pd.DataFrame({"start": [start] * len(seen), "node": list(seen)})

        kind = begun.schema["start"].dataType.simpleString()
        return begun.mapInPandas(each, f"start {kind}, node {kind}")
    seen = cut(begun.select("start", F.col("start").alias("node")))
    front = seen
    while True:
        front = front.join(step, front["node"] == step["u"]).select("start", F.col("v").alias("node")).distinct()
        front = cut(front.join(seen, ["start", "node"], "left_anti"))
        if front.isEmpty():
            return seen
        seen = seen.unionByName(front)  # each part is cut already


def _start(edges: DataFrame, nodes: DataFrame | None, start: str) -> DataFrame:
    known = edges.select(F.explode(F.array("u", "v")).alias("node"))
    known = known if nodes is None else known.unionByName(nodes.select("node"))
    one = known.where(F.col("node") == start).limit(1)
    if one.isEmpty():
        raise ValueError(f"{start} is not in the graph")
    return one


def graph_descendants(edges: DataFrame, start: str, nodes: DataFrame | None = None) -> DataFrame:
    """(node) that start can reach, with it."""
    return reach(edges, _start(edges, nodes, start)).select("node")


def graph_ancestors(edges: DataFrame, start: str, nodes: DataFrame | None = None) -> DataFrame:
    """(node) that can reach start, with it."""
    return reach(turned(edges), _start(edges, nodes, start)).select("node")


def turned(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("v").alias("u"), F.col("u").alias("v"), *(c for c in edges.columns if c not in ("u", "v")))


def induced(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with both ends among the nodes."""
    n = nodes.select("node").distinct()
    return edges.join(n.withColumnRenamed("node", "u"), "u", "left_semi").join(n.withColumnRenamed("node", "v"), "v", "left_semi")


def components(edges: DataFrame, core_edges: int = CORE_EDGES) -> DataFrame:
    """(node, component): connected components without direction, named by their smallest node.

    Beyond the core alternating large-star and small-star steps, which take rounds in the logarithm of a component's size; each
    step hooks neighbours to the smallest one by an aggregate, so no group is collected. A round that gives the links of the one
    before, by count and sum of hashes, is the last.
    """
    both = edges.select("u", "v").dropna()
    nodes = both.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    links = both.where("u != v").select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b")).distinct()
    few = core(links, core_edges)
    if few is not None:
        top: dict = {}

        def root(x: object) -> object:
            way = []
            while (up := top.get(x, x)) != x:
                way.append(x)
                x = up
            for w in way:
                top[w] = x
            return x

        for a, b in few:
            x, y = root(a), root(b)
            if x != y:
                top[max(x, y)] = min(x, y)
        kind = nodes.schema["node"].dataType.simpleString()
        known = edges.sparkSession.createDataFrame(pd.DataFrame({"node": list(top), "component": [root(x) for x in top]}, dtype="object") if top else [], f"node {kind}, component {kind}")
        return nodes.join(known, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
    links, before = cut(links), None
    while True:
        wide = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = wide.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        star = cut(wide.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        low = star.groupBy("a").agg(F.min("b").alias("m"))
        hooked = star.join(low, "a")
        links = cut(hooked.where("b != m").select("b", "m").union(hooked.select("a", "m")).toDF("a", "b").where("a != b").distinct())
        now = tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            return nodes.join(links.groupBy("a").agg(F.min("b").alias("b")).withColumnRenamed("a", "node"), "node", "left").select("node", F.coalesce("b", "node").alias("component"))
        before = now


def alias_means(nodes: DataFrame, aliases: DataFrame, node: str, weight: str) -> DataFrame:
    """(component, mean weight): nodes folded into the smallest of their aliases."""
    c = components(aliases)
    w = nodes.select(F.col(node).alias("node"), F.col(weight).alias("w"))
    return w.join(c, "node", "left").groupBy(F.coalesce("component", "node").alias("node")).agg(F.avg("w").alias("mean_weight"))


def on_hierarchy(nodes: DataFrame, edges: DataFrame, relation: str = "is_a") -> DataFrame:
    """Nodes with an edge of the relation."""
    ends = edges.where(F.col("relation") == relation).select(F.explode(F.array("u", "v")).alias("node")).distinct()
    return nodes.join(ends, "node", "left_semi")


def local_context(nodes: DataFrame, edges: DataFrame, start: str, alias: str = "hasAlternativeId", relation: str = "is_a") -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) around a node: its main alias, all above and below it in the hierarchy, and all their aliases."""
    _start(edges, nodes, start)
    groups = cut(components(edges.where(F.col("relation") == alias)))
    own = groups.where(F.col("node") == start).select("component").first()
    main = own["component"] if own else start
    tree = edges.where(F.col("relation") == relation)
    if tree.where((F.col("u") == main) | (F.col("v") == main)).isEmpty():
        core = groups.where(F.col("component") == main).select("node").unionByName(nodes.where(F.col("node") == start).select("node"))
    else:
        core = graph_ancestors(tree, main).unionByName(graph_descendants(tree, main))
        mates = groups.join(groups.join(core, "node").select("component").distinct(), "component", "left_semi").select("node")
        core = core.unionByName(mates)
    core = cut(core.distinct())
    return core, induced(edges, core)


def longest_ways(few: list[tuple]) -> dict:
    """The longest way up from each node, the nodes without a parent having none; they are peeled off from the top."""
    kids: defaultdict[object, list] = defaultdict(list)
    waits: dict = {}
    for u, v in few:
        kids[v].append(u)
        waits[u] = waits.get(u, 0) + 1
        waits.setdefault(v, 0)
    level = {x: 0 for x, n in waits.items() if not n}
    todo = list(level)
    done = 0
    while todo:
        v = todo.pop()
        done += 1
        for u in kids.get(v, ()):
            level[u] = max(level.get(u, 0), level[v] + 1)
            waits[u] -= 1
            if not waits[u]:
                todo.append(u)
    if done < len(waits):
        raise RuntimeError("the hierarchy has a cycle")
    return level


def levels(edges: DataFrame, nodes: DataFrame | None = None, relation: str = "is_a", core_edges: int = CORE_EDGES) -> DataFrame:
    """(node, level): 0 for nodes without a parent, else one more than the highest parent.

    Nodes outside the hierarchy get one more than their highest neighbour in it, or 0. A cycle raises, as its level grows
    without end. Beyond the core a level takes a round.
    """
    tree = edges.where((F.col("relation") == relation) & (F.col("u") != F.col("v"))).select("u", "v").distinct()
    few = core(tree, core_edges)
    if few is not None:
        kind = tree.schema["u"].dataType.simpleString()
        level = longest_ways(few)
        known = edges.sparkSession.createDataFrame(pd.DataFrame({"node": pd.Series(list(level), dtype="object"), "level": list(level.values())}) if level else [], f"node {kind}, level int")
    else:
        tree = cut(tree)
        known = cut(tree.select(F.explode(F.array("u", "v")).alias("node")).distinct().withColumn("level", F.lit(0)))
        size, turn, moved = known.count(), 0, 1
        while moved:
            up = tree.join(known.withColumnRenamed("node", "v"), "v").groupBy(F.col("u").alias("node")).agg((F.max("level") + 1).alias("new"))
            met = cut(known.join(up, "node", "left").select("node", F.coalesce("new", F.lit(0)).alias("level"), (F.coalesce("new", F.lit(0)) != F.col("level")).alias("moved")))
            moved = met.where("moved").count()
            known = met.drop("moved")
            turn += 1
            if moved and turn > size:
                raise RuntimeError("the hierarchy has a cycle")
    if nodes is None:
        return known
    rest = nodes.select("node").distinct().join(known, "node", "left_anti")
    pairs = edges.select("u", "v").unionByName(turned(edges.select("u", "v")))
    beside = pairs.join(known.withColumnRenamed("node", "v"), "v").groupBy(F.col("u").alias("node")).agg((F.max("level") + 1).alias("level"))
    return known.unionByName(rest.join(beside, "node", "left").select("node", F.coalesce("level", F.lit(0)).alias("level")))
