"""Parent-child links of unknown depth to full hierarchies, by tree contraction.

Links become (node, up, dist): `up` is the nearest ancestor still in the tree and `dist` the links to it. Each round
rakes all leaves and compresses unary chains (a node with one child leaves if a hash ranks it above its neighbours, so no
two neighbours leave together); the link under which a node left is recorded with its round. A tree shrinks to its root in
a number of rounds that grows with the logarithm of its size, however deep or wide. What does not shrink to a root
shrinks to self-links: these are the cycles. The recorded rounds, reversed, give every node its root and depth: those of
the `up` it left under, plus `dist`.

Rounds run as joins on the link table until at most `core_rows` links are left; these few, bounded in number whatever the
input, are raked and compressed to the end in one task. core_rows=0 runs every round as joins.

Defined results: ids in key form; null or blank ends make no link (the other end is a node still); repeated links, in
either type, count once. If a node has several parents, the smallest id is its parent in the tree, and the other links
are listed by `extra_parents` and followed by `cyclic` and `all_descendants` alone. In the tree a node on or below a cycle, a self-link included, has root 'CYCLE' and depth -1.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litweave.operators.orphans import key_form
from litweave.session import cut, new_path

CYCLE = "CYCLE"
CORE_ROWS = 200_000
PART_SIZE = 500_000
LEFT = "node string, up string, dist bigint, way array<string>"


def links(rows: DataFrame, parent: str, child: str) -> DataFrame:
    """(node, up): each child's parent, once."""
    r = rows.select(key_form(child).alias("node"), key_form(parent).alias("up")).dropna()
    return r.groupBy("node").agg(F.min("up").alias("up"))


def extra_parents(rows: DataFrame, parent: str, child: str) -> DataFrame:
    """(node, up) of the links that are not in the tree because the node has a smaller parent."""
    r = rows.select(key_form(child).alias("node"), key_form(parent).alias("up")).dropna().distinct()
    return r.join(links(rows, parent, child), ["node", "up"], "left_anti")


def all_nodes(rows: DataFrame, parent: str, child: str) -> DataFrame:
    both = rows.select(F.explode(F.array(key_form(parent), key_form(child))).alias("node"))
    return both.where("node is not null").distinct()


def contract_core(batch: pd.DataFrame, paths: bool) -> Iterator[pd.DataFrame]:
    """Contract a bounded set of links to the end; (node, up, dist, way) with up the root, or CYCLE, and way what lies between.

    Paths are climbed anew for each node and handed on in parts, so that no more than one part is held.
    """
    link = dict(zip(batch["node"], zip(batch["up"], batch["dist"], batch["way"])))
    names = list(dict.fromkeys([*link, *batch["up"]]))
    number = {n: i for i, n in enumerate(names)}
    up = [number[link[n][0]] if n in link else -1 for n in names]
    dist = [int(link[n][1]) if n in link else 0 for n in names]
    kids, kid = [0] * len(names), [0] * len(names)  # how many children, and their exclusive or: of one child, itself
    for x, u in enumerate(up):
        if u >= 0:
            kids[u] += 1
            kid[u] ^= x
    record: list[tuple[int, int, int]] = []
    alive = [x for x, u in enumerate(up) if u >= 0]
    gone = [False] * len(names)
    while True:
        before = len(record)
        for x in [x for x in alive if not kids[x]]:  # rake: all leaves leave
            u = up[x]
            record.append((x, u, dist[x]))
            gone[x] = True
            kids[u] -= 1
            kid[u] ^= x
        for x in alive:  # compress: every node with one child leaves, its child hangs on its parent
            if not gone[x] and kids[x] == 1 and kid[x] != x:
                u, c = up[x], kid[x]
                record.append((x, u, dist[x]))
                gone[x] = True
                up[c], dist[c] = u, dist[c] + dist[x]
                kid[u] ^= x ^ c
        if len(record) == before:
            break
        alive = [x for x in alive if not gone[x]]
    done: dict[str, tuple[str, int]] = {names[x]: (CYCLE, -1) for x in alive}
    for x, u, d in reversed(record):
        top, above = done.get(names[u], (names[u], 0))
        done[names[x]] = (CYCLE, -1) if top == CYCLE else (top, above + d)
    rows: list[tuple] = []
    size = 0
    for n, (top, d) in done.items():
        way: list[str] | None = None
        if paths and top != CYCLE:
            way, x = [], n
            while x in link:
                u, _, between = link[x]
                way += [*reversed(between), u]
                x = u
            way = way[-2::-1]
        rows.append((n, top, d, way))
        size += 1 + len(way or ())
        if size > PART_SIZE:
            yield pd.DataFrame(rows, columns=["node", "up", "dist", "way"])
            rows, size = [], 0
    yield pd.DataFrame(rows, columns=["node", "up", "dist", "way"])


def contract(tree: DataFrame, paths: bool = False, core_rows: int = CORE_ROWS) -> DataFrame:
    """(node, root, depth[, path]) of every node that has a parent; path runs from the root to the node."""
    spark = tree.sparkSession
    way = F.array().cast("array<string>") if paths else F.lit(None).cast("array<string>")
    now = cut(tree.select("node", "up", F.lit(1).cast("bigint").alias("dist"), way.alias("way")))
    left: list[DataFrame] = []
    count = now.count()
    turn = 0
    while count > core_rows:  # every round removes something, or only self-links are left: there is no bound to run into
        turn += 1
        # Rake: nodes without children leave at once. The count of children combines before the shuffle.
        kids = now.where("node != up").groupBy(F.col("up").alias("node")).agg(F.count("*").alias("kids"))
        marked = now.join(kids, "node", "left").withColumn("kids", F.coalesce("kids", F.lit(0)))
        marked = cut(marked)
        leaves = marked.where("kids = 0 and node != up").select(*now.columns)
        rest = marked.where("kids > 0 or node = up")
        # Compress: among unary nodes, the local maxima of a hash leave; no two neighbours do.
        rank = F.xxhash64("node", F.lit(turn))
        rest = rest.withColumn("rank", rank)
        inner = rest.where("node != up and kids = 1").select(F.col("node").alias("up"), F.col("rank").alias("up_rank"), F.col("up").alias("next"), F.col("dist").alias("next_dist"), F.col("way").alias("next_way"))
        met = cut(rest.where("node != up").join(inner, "up", "left"))
        low = met.where("kids = 1").groupBy(F.col("up")).agg(F.max("rank").alias("low_rank"))
        goes = inner.join(low, "up", "left").join(
            met.select(F.col("node").alias("up"), F.col("up_rank").alias("above_rank")), "up"
        )
        beats_low = F.col("low_rank").isNull() | (F.col("up_rank") > F.col("low_rank"))
        beats_up = F.col("above_rank").isNull() | (F.col("up_rank") > F.col("above_rank"))
        goes = cut(goes.where(beats_low & beats_up).select("up", "next", "next_dist", "next_way"))
        spliced = goes.select(F.col("up").alias("node"), F.col("next").alias("up"), F.col("next_dist").alias("dist"), F.col("next_way").alias("way"))
        left += [leaves, spliced]  # both of what is cut already; in this order: a raked leaf may hang on a node that is spliced out next
        longer = F.concat("next_way", F.array("up"), "way") if paths else F.lit(None).cast("array<string>")
        kept = rest.select(*now.columns).join(goes.select(F.col("up").alias("node")), "node", "left_anti")
        kept = kept.join(goes, "up", "left")
        now = cut(kept.select(
            "node", F.coalesce("next", "up").alias("up"), (F.col("dist") + F.coalesce("next_dist", F.lit(0))).alias("dist"),
            F.when(F.col("next").isNotNull(), longer).otherwise(F.col("way")).alias("way"),
        ))
        after = now.count()
        if after == count:  # only self-links are left: every other core holds a leaf or a unary node that leaves
            break
        count = after

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole = [b for b in batches if len(b)]
        if whole:
            yield from contract_core(pd.concat(whole), paths)

    if count <= core_rows:
        core = now.coalesce(1).mapInPandas(finish, LEFT)
        core = core.select("node", F.col("up").alias("root"), F.col("dist").alias("depth"), F.col("way"))
    else:
        core = now.select("node", F.lit(CYCLE).alias("root"), F.lit(-1).cast("bigint").alias("depth"), F.lit(None).cast("array<string>").alias("way"))
    core = core.select("node", "root", "depth", F.when((F.col("root") != CYCLE) & F.lit(paths), F.concat(F.array("root"), "way", F.array("node"))).alias("path"))
    stem = new_path(spark, "hierarchy")
    core.write.parquet(f"{stem}/part=core")
    schema = "node string, root string, depth bigint, path array<string>"
    done = spark.read.schema(schema).parquet(f"{stem}/part=core")
    # Reverse the record: each node that left takes root and depth from the node it left under.
    for i, gone in enumerate(reversed(left)):
        above = done.select(F.col("node").alias("up"), F.col("root").alias("up_root"), F.col("depth").alias("up_depth"), F.col("path").alias("up_path"))
        got = gone.join(above, "up", "left")
        in_cycle = F.coalesce(F.col("up_root") == CYCLE, F.lit(False))
        path = F.concat(F.coalesce("up_path", F.array("up")), "way", F.array("node")) if paths else F.lit(None).cast("array<string>")
        got = got.select(
            "node", F.coalesce("up_root", "up").alias("root"),
            F.when(in_cycle, F.lit(-1)).otherwise(F.coalesce("up_depth", F.lit(0)) + F.col("dist")).cast("bigint").alias("depth"),
            F.when(~in_cycle, path).alias("path"),
        )
        got.write.parquet(f"{stem}/part=r{i}")
        done = spark.read.schema(schema).parquet(*(f"{stem}/part={p}" for p in ["core", *(f"r{j}" for j in range(i + 1))]))
    return done if paths else done.drop("path")


def hierarchy(rows: DataFrame, parent: str, child: str, paths: bool = False, core_rows: int = CORE_ROWS) -> DataFrame:
    """(node, root, depth[, path]) of every id in rows."""
    nodes = all_nodes(rows, parent, child)
    tree = contract(links(rows, parent, child), paths, core_rows)
    out = nodes.join(tree, "node", "left")
    cols = [F.col("node"), F.coalesce("root", "node").alias("root"), F.coalesce("depth", F.lit(0)).cast("int").alias("depth")]
    if paths:
        cols.append(F.when(F.coalesce("root", "node") != CYCLE, F.coalesce("path", F.array("node"))).alias("path"))
    return out.select(*cols)


def cyclic(rows: DataFrame, parent: str, child: str, core_rows: int = CORE_ROWS) -> DataFrame:
    """(node) of the nodes on or below a cycle of any links, those to other parents than the smallest included.

    Without several parents the tree tells. Else nodes that have no parent left are peeled off, in joins while more than
    `core_rows` links are left and then in one task; what can't be peeled is on or below a cycle.
    """
    if extra_parents(rows, parent, child).isEmpty():
        return hierarchy(rows, parent, child, core_rows=core_rows).where(F.col("root") == CYCLE).select("node")
    now = cut(rows.select(key_form(child).alias("node"), key_form(parent).alias("up")).dropna().distinct())
    count, before = now.count(), -1
    while count > core_rows and count != before:
        now = cut(now.join(now.select(F.col("node").alias("up")).distinct(), "up", "left_semi"))
        before, count = count, now.count()
    if count == before:
        return now.select("node").distinct()

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kids: defaultdict[str, list[str]] = defaultdict(list)
        parents: defaultdict[str, int] = defaultdict(int)
        for b in batches:
            for node, up in zip(b["node"], b["up"]):
                kids[up].append(node)
                parents[node] += 1
        free = [n for n in kids if not parents.get(n)]
        while free:
            for k in kids.get(free.pop(), ()):
                parents[k] -= 1
                if not parents[k]:
                    free.append(k)
        yield pd.DataFrame({"node": [n for n, left in parents.items() if left]}, dtype="object")

    return now.coalesce(1).mapInPandas(finish, "node string")


def all_descendants(rows: DataFrame, parent: str, child: str) -> DataFrame:
    """(node, descendant, distance) over all links, distance being the shortest; nodes on or below a cycle are no descendants.

    The pairs of the tree are widened by one link to another parent a turn, until nothing is new.
    """
    out_of = cyclic(rows, parent, child)
    pairs = descendants(hierarchy(rows, parent, child, paths=True)).join(out_of.withColumnRenamed("node", "descendant"), "descendant", "left_anti")
    extra = cut(extra_parents(rows, parent, child).join(out_of, "node", "left_anti"))
    pairs = pairs.select("node", "descendant", F.col("distance").cast("bigint").alias("distance"))
    if extra.isEmpty():
        return pairs.select("node", "descendant", F.col("distance").cast("int").alias("distance"))
    nodes = all_nodes(rows, parent, child).join(out_of, "node", "left_anti")
    pairs = cut(pairs.unionByName(nodes.select("node", F.col("node").alias("descendant"), F.lit(0).cast("bigint").alias("distance"))))
    size: tuple | None = None
    while (now := tuple(pairs.agg(F.count("*"), F.sum("distance")).first())) != size:
        size = now
        above = pairs.select(F.col("node").alias("top"), F.col("descendant").alias("up"), F.col("distance").alias("d1"))
        below = pairs.select("node", "descendant", F.col("distance").alias("d2"))
        met = extra.join(above, "up").join(below, "node")
        met = met.select(F.col("top").alias("node"), "descendant", (F.col("d1") + F.col("d2") + 1).alias("distance"))
        pairs = cut(pairs.unionByName(met).groupBy("node", "descendant").agg(F.min("distance").alias("distance")))
    return pairs.where("node != descendant").select("node", "descendant", F.col("distance").cast("int").alias("distance"))


def descendants(with_paths: DataFrame) -> DataFrame:
    """(node, descendant, distance): one row per pair, so as many as all depths together."""
    up = with_paths.where("path is not null").select(F.col("node").alias("descendant"), F.posexplode("path").alias("at", "node"), F.size("path").alias("n"))
    return up.where("node != descendant").select("node", "descendant", (F.col("n") - 1 - F.col("at")).alias("distance"))
