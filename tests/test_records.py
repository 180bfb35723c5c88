"""Orphans, nested documents, compaction and hierarchies against brute force and hand-made cases."""

import json
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from litweave.operators import compaction, hierarchy, nested, orphans
from litweave.plans import record_queries


def day(n):
    return datetime(2024, 1, n)


# --- orphans


def orphan_ids(spark, refs, records, salts=3, core_steps=0):
    r = spark.createDataFrame(refs, "row_id bigint, k string, at timestamp, key string, salt string")
    e = spark.createDataFrame(records, "id string, loaded timestamp, retired timestamp")
    out = orphans.orphan_rows(r, "row_id", orphans.key_form("k"), "at", e, "id", "loaded", "retired", salts, core_steps)
    return sorted(x["row_id"] for x in out.collect())


def test_orphans_times_and_dirt(spark):
    records = [("A", day(2), day(5)), (" a ", day(2), day(5)), ("B", day(3), None), ("C", None, None), ("D", day(5), day(4)), (None, day(1), None)]
    refs = [
        (1, "A", day(1), "x", "y"), (2, "A", day(2), None, None), (3, "a ", day(4), None, None), (4, "A", day(5), None, None), (5, "B", day(2), None, None),
        (6, "B", day(3), None, None), (7, "C", day(1), None, None), (8, "D", day(9), None, None), (9, None, day(1), None, None), (10, "  ", day(1), None, None),
        (11, "B", None, None, None), (12, "Z", None, None, None), (12, "Z", None, None, None),
    ]
    assert orphan_ids(spark, refs, records) == [1, 4, 5, 8, 12, 12]


def test_orphans_empty(spark):
    assert orphan_ids(spark, [], [("A", day(1), None)]) == []
    assert orphan_ids(spark, [(1, "A", day(1), None, None)], []) == [1]


def test_orphans_random(spark):
    r = random.Random(1)
    records = [(f"k{r.randint(0, 6)}", day(a := r.randint(1, 20)), r.choice([None, day(a + r.randint(1, 8))])) for _ in range(25)]
    refs = [(i, f"K{r.randint(0, 8)}", day(r.randint(1, 28)), None, None) for i in range(300)]
    want = [i for i, k, t, *_ in refs if not any(a.upper() == k and b <= t and (c is None or c > t) for a, b, c in records)]
    assert orphan_ids(spark, refs, records) == want
    assert orphan_ids(spark, refs, records, core_steps=1000) == want
    hot = [(i, "k1", day(i % 25 + 1), None, None) for i in range(1000, 1400)]  # more than half of all
    want += [i for i, k, t, *_ in hot if not any(a == k and b <= t and (c is None or c > t) for a, b, c in records)]
    assert orphan_ids(spark, refs + hot, records) == want


def test_epoch_counts(spark):
    refs = spark.createDataFrame([(1, "A", day(1)), (2, "A", day(3)), (3, "A", day(3)), (4, "A", day(9)), (5, "B", day(1)), (6, "A", None)], "row_id bigint, key string, at timestamp")
    deltas = orphans.existence_deltas(spark.createDataFrame([("a", day(2), day(5)), ("A", day(2), None)], "id string, loaded timestamp, retired timestamp"), "id", "loaded", "retired")
    for steps in (0, 1000):
        got = sorted((r["key"], r["refs"], r["exists"]) for r in orphans.epoch_counts(orphans.referring(refs, "row_id", orphans.key_form("key"), "at"), deltas, core_steps=steps).collect())
        assert got == [("A", 1, 0), ("A", 1, 1), ("A", 3, 2), ("B", 1, 0)]


def test_counts_fold(spark):
    s = "key string, refs bigint, exists bigint"
    state = spark.createDataFrame([("a", 2, 1), ("b", 1, 0)], s)
    deltas = spark.createDataFrame([("a", -2, -1), ("b", 0, 1), ("c", 3, 0), (None, 1, 1), ("d", None, None)], s)
    out = orphans.fold_counts(state, deltas)
    assert sorted(map(tuple, out.collect())) == [("b", 1, 1), ("c", 3, 0)]
    assert [x["key"] for x in orphans.current_orphans(out).collect()] == ["c"]
    back = orphans.fold_counts(out, spark.createDataFrame([("c", -3, 0), ("b", -1, -1)], s))
    assert back.isEmpty()


def test_states_of_both_tables(spark, tmp_path):
    t = "timestamp_ntz"
    for name, schema, rows in (
        ("member_table", f"member_id bigint, ipr_id string, loaded_at {t}", [(1, "K", day(1)), (2, "i1", day(1))]),
        ("entry_table", f"ipr_id string, loaded_at {t}, retired_at {t}", [("I1", day(1), None)]),
        ("uniprot_idmapping", f"map_id bigint, uniprot_id string, loaded_at {t}", [(1, "K-2", day(1)), (2, " k", day(2)), (3, "P1-1", day(1)), (4, None, day(1))]),
        ("uniprot_ref", f"accession string, loaded_at {t}, retired_at {t}", [("K", day(1), day(3)), ("P1", day(1), None)]),
    ):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    got = record_queries.QUERIES["p1_states"](spark, str(tmp_path)).collect()
    assert {(r["src"], r["key"], r["refs"], r["exists"]) for r in got} == {("member_table", "K", 1, 0), ("uniprot_idmapping", "K", 2, 0)}


# --- nested documents

DOC = [
    {"sentence": "S0", "rel_from_this_sent": {"components": ["plain", None, {"name": "x", "meta": {"name": "m", "meta": ["deep"]}}], "target": {"name": "t"}, "relation": "r", "valid": None}},
    None,
    {"sentence": None, "rel_from_this_sent": [None, {"targets": [{"name": "u"}], "contexts": None, "relation": {"name": "q", "id": "1"}, "valid": False}]},
]
WANT = [(0, 0, "component", "0"), (0, 0, "component", "2"), (0, 0, "component", "2.0"), (0, 0, "component", "2.0.0"), (0, 0, "target", "0"), (2, 1, "target", "0")]


def brute(text):
    def ents(v, role, path, out):
        for i, e in enumerate(v if isinstance(v, list) else [] if v is None else [v]):
            if isinstance(e, (dict, str)):
                out.append((*role, ".".join(map(str, [*path, i]))))
                if isinstance(e, dict):
                    ents(e.get("meta"), role, [*path, i], out)

    out = []
    for b, block in enumerate(json.loads(text)):
        rels = (block or {}).get("rel_from_this_sent")
        for r, rel in enumerate(rels if isinstance(rels, list) else [rels] if rels else []):
            for role, names in nested.ROLES.items():
                for n in names:
                    ents((rel or {}).get(n), (b, r, role), [], out)
    return out


def test_nested_found(spark):
    t = json.dumps(DOC)
    deep = '{"name": "d"}'
    for _ in range(300):
        deep = f'{{"name": "d", "meta": [{deep}]}}'
    texts = [t, json.dumps(t), json.dumps({"pmid": 1, "relations": DOC}), json.dumps({"relations": json.dumps(DOC)}), t[:-9], None, "", " ", "[]", "3", "null", '[{"rel_from_this_sent": [{"components": [%s]}]}]' % deep]
    df = spark.createDataFrame([(i, x, "clash") for i, x in enumerate(texts)], "pre bigint, relations string, doc_id string")
    out = nested.found(df, "pre", "relations").collect()
    for i in range(4):
        assert sorted(tuple(r)[1:] for r in out if r["pre"] == i) == sorted(WANT)
    assert {r["pre"] for r in out} == {0, 1, 2, 3, 11}
    assert sum(r["pre"] == 11 for r in out) == 301
    assert sorted(brute(t)) == sorted(WANT)


def test_nested_tables_link(spark):
    df = spark.createDataFrame([(7, json.dumps(DOC))], "doc_id bigint, text string")
    n = nested.nodes(df, "doc_id", "text")
    s, r, e = nested.sentences(n), nested.relations(n), nested.entities(n)
    assert [(x["block_no"], x["sentence"]) for x in s.orderBy("pre").collect()] == [(0, "S0"), (2, None)]
    assert [(x["block_no"], x["rel_no"], x["name"], x["valid"]) for x in r.orderBy("pre").collect()] == [(0, 0, "r", None), (2, 1, "q", False)]
    up = e.join(r, (e["relation_pre"] == r["pre"]) & (r["pre"] < e["pre"]) & (r["post"] > e["post"]))
    assert up.count() == e.count() == 6


def test_nested_random(spark):
    g = random.Random(5)

    def ent(depth):
        k = g.random()
        if k < 0.15:
            return None
        if k < 0.3:
            return "s"
        e = {"name": "e"}
        if depth < 4 and g.random() < 0.6:
            e["meta"] = [ent(depth + 1) for _ in range(g.randint(0, 3))] if g.random() < 0.8 else ent(depth + 1)
        return e

    docs = [json.dumps([{"sentence": "a", "rel_from_this_sent": [{"components": [ent(0) for _ in range(3)], "target": ent(0), "contexts": [ent(0)]} for _ in range(g.randint(0, 3))]} for _ in range(3)]) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(docs)), "merged_id bigint, relations string").repartition(5)
    got = sorted(tuple(r) for r in nested.found(df, "merged_id", "relations").collect())
    assert got == sorted((i, *b) for i, t in enumerate(docs) for b in brute(t))


# --- compaction


def test_records_of_files():
    rid = lambda t: [r for r, _ in compaction.records(t)]
    assert rid('[{"rid": "a"}, {"rid": "b", "hits": [{"rid": "no"}]}, {"rid": "c"') == ["a", "b"]
    assert rid('﻿{"rid": 1}\n\n{}\n{"rid": " x "}\n{"rid": null}\n{"rid": "cut", "hits": [\n{"id"') == ["1", "x"]
    assert rid('{\n  "rid": "p",\n  "v": "a\\nb"\n}') == ["p"]
    assert rid("#rid\tv\r\na\t1\r\nb\r\n\r\nc\t\r\nrid\tv") == ["a", "c"]
    assert rid("name\trid\nn\tr1\nx") == ["r1"]
    assert rid("name\trid\nn\tr1\n#rid\tname\nr2\tm\n") == ["r1", "r2"]
    assert rid('{"rid": "bad" "x"}\n{"rid": "good"}') == ["good"]
    assert rid(None) == rid("") == rid("﻿") == rid("\n \n") == rid("rid\tv") == []


def test_first_fit_decreasing():
    r = random.Random(3)
    for most in (10, 100):
        sizes = [r.randint(1, most + 5) for _ in range(300)]
        bins = compaction.first_fit_decreasing(sizes, most)
        load = {}
        for s, b in zip(sizes, bins):
            load[b] = load.get(b, 0) + min(s, most)
        assert max(load.values()) <= most and len(load) <= 11 / 9 * -(-sum(min(s, most) for s in sizes) // most) + 1
    assert compaction.first_fit_decreasing([], 10) == []


def test_compact(spark):
    rows = [(i, f'{{"rid": "r{i % 50}", "v": {i}}}\n{{"rid": "only{i}"}}', day(1 + i % 20), "x") for i in range(120)]
    rows += [(200, None, None, None), (201, "", None, None), (None, '{"rid": "no id"}', None, None), rows[0]]
    files = spark.createDataFrame(rows, "file_id bigint, content string, written_at timestamp, bin string")
    c = compaction.compact(files, target_bytes=400)
    got = spark.read.schema(compaction.WRITTEN).parquet(c.path)
    assert got.select("_metadata.file_path").distinct().count() == got.select("bin").distinct().count() <= c.bins
    assert sorted(r["rid"] for r in got.collect()) == sorted([*(f"r{i}" for i in range(50)), *(f"only{i}" for i in range(120)), "no id"])
    assert c.rows == 171 and 10 < c.bins < 60
    v = {r["rid"]: json.loads(r["record"]).get("v") for r in got.collect()}
    assert v["r7"] == max((day(1 + i % 20), i) for i in range(120) if i % 50 == 7)[1]
    assert compaction.compact(files.limit(0)).rows == 0


# --- hierarchies


def expected(links):
    up = {}
    for p, c in links:
        up[c] = min(p, up.get(c, p))
    out = {}
    for n in {x for e in links for x in e}:
        path, x = [n], n
        while path and x in up:
            x = up[x]
            path = [] if x in path else [*path, x]
        out[n] = (path[-1], len(path) - 1, path[::-1]) if path else ("CYCLE", -1, None)
    return out


@pytest.mark.parametrize("core", [0, 100_000])
def test_hierarchy(spark, core):
    links = [(f"N{i}", f"N{i + 1}") for i in range(12)] + [("N3", f"L{i}") for i in range(20)] + [("C1", "C2"), ("C2", "C3"), ("C3", "C1"), ("C2", "T"), ("T", "U"), ("S", "S"), ("S", "V"), ("R", "Q")]
    rows = [*links, *links[:5], (" n0", "n1 "), (None, "ALONE"), ("R", "  ")]
    df = spark.createDataFrame([(p, c, "parent", "clash") for p, c in rows], "parent string, child string, type string, node string")
    got = {r["node"]: (r["root"], r["depth"], r["path"]) for r in hierarchy.hierarchy(df, "parent", "child", paths=True, core_rows=core).collect()}
    assert got == {**expected(links), "ALONE": ("ALONE", 0, ["ALONE"])}


def test_hierarchy_random_core(spark):
    r = random.Random(2)
    links = [(f"x{r.randint(0, 400)}".upper(), f"x{i}".upper()) for i in range(400)]
    df = spark.createDataFrame(links, "parent string, child string")
    h = hierarchy.hierarchy(df, "parent", "child", paths=True)
    want = expected(links)
    assert {x["node"]: (x["root"], x["depth"], x["path"]) for x in h.collect()} == want
    pairs = {(x["node"], x["descendant"]) for x in hierarchy.descendants(h).collect()}
    assert pairs == {(a, n) for n, (_, _, p) in want.items() if p for a in p[:-1]}


def test_hierarchy_empty_and_two_parents(spark):
    s = "parent string, child string"
    assert hierarchy.hierarchy(spark.createDataFrame([], s), "parent", "child").count() == 0
    two = spark.createDataFrame([("B", "X"), ("A", "X")], s)
    got = {r["node"]: r["root"] for r in hierarchy.hierarchy(two, "parent", "child").collect()}
    assert got == {"A": "A", "B": "B", "X": "A"}
    assert [tuple(r) for r in hierarchy.extra_parents(two, "parent", "child").collect()] == [("X", "B")]


@pytest.mark.parametrize("core", [hierarchy.CORE_ROWS, 0])
def test_cycles_through_any_parent(spark, core):
    links = [("A", "X"), ("C1", "X"), ("C2", "C1"), ("C1", "C2"), ("X", "Y"), ("A", "S"), ("S", "S"), ("A", "D"), ("B", "D"), ("D", "E"), ("E", "F"), ("A", "F")]
    df = spark.createDataFrame(links, "parent string, child string")
    assert {r["node"] for r in hierarchy.cyclic(df, "parent", "child", core).collect()} == {"C1", "C2", "X", "Y", "S"}
    pairs = {(r["node"], r["descendant"]): r["distance"] for r in hierarchy.all_descendants(df, "parent", "child").collect()}
    assert pairs == {
        ("A", "D"): 1, ("A", "E"): 2, ("A", "F"): 1, ("B", "D"): 1, ("B", "E"): 2, ("B", "F"): 3, ("D", "E"): 1, ("D", "F"): 2, ("E", "F"): 1,
    }
