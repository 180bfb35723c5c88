"""Hand-derived expectations for the functions and operators."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from litweave.functions import text as T
from litweave.operators import graph, matching, metrics, models, nested, relational, relations, retrieval, stages
from litweave.streaming import queues


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("name", "want"),
    [("TNF-alpha", "tnf"), ("IL-6", "il"), ("caspase 3a", "caspase 3"), ("TGF-beta1", "tgf beta1"), ("HLA-A", "hla"), ("NF_kappa-B", "nf kappa"), ("PKC-alpha-2", "pkc alpha"), ("alphabeta", "alpha"), ("alpha alpha", ""), (None, None)],
)
def test_normal_name(spark, name, want):
    assert one(spark, T.normal_name(F.lit(name).cast("string"))) == want


def test_answers(spark):
    hits = F.array(*(F.struct(F.lit(i).alias("id"), F.lit(n).alias("name")) for i, n in (("GO:0001", "one"), ("P1", "two"))))
    named = lambda f, a: (one(spark, f(F.lit(a).cast("string"), hits)) or {"id": None})["id"]
    assert named(T.hit_contained, "PARENT:GO:0001") == "GO:0001"
    assert named(T.hit_equal, "PARENT:GO:0001") is None
    assert named(T.hit_contained, "P12") == "P1"
    assert named(lambda a, h: T.hit_contained(a, h, strict=True), "P12") is None
    assert named(lambda a, h: T.hit_contained(a, h, strict=True), "it is P1.") in ("P1", None)
    assert named(T.hit_equal, '"TWO"') == "P1"
    assert named(T.hit_contained, "none") is named(T.hit_contained, None) is None
    assert [one(spark, T.yes_no(F.lit(a))) for a in (" Yes.", "no", "maybe")] == [True, False, None]
    assert one(spark, T.without_thinking(F.lit("a <think>x\ny</think> b"))) == "a  b"


def test_salvage_and_merge():
    assert T.salvage_array('Here: {"a":1} done') == '[{"a":1}]'
    assert T.salvage_array('see [1] then [{"a":1}]') == "[1]"
    assert T.salvage_array("no json") is T.salvage_array(None) is T.salvage_array("") is None
    assert T.salvage_array("[a, b]") == "[a, b]"
    base, over = {"a": 1, "l": [{"id": 1, "t": "x", "v": 0}]}, {"a": 2, "l": [{"id": 1, "t": "x", "v": 9}, {"id": 2}]}
    assert T.merge_values(base, over) == {"a": 2, "l": [{"id": 1, "t": "x", "v": 9}, {"id": 2}]}


def test_uri_and_text(spark):
    assert one(spark, T.clean_uri(F.lit("http://purl.obolibrary.org/obo/GO_0008150"))) == "GO:0008150"
    assert one(spark, T.clean_uri(F.lit("http://example.org/formats/oboInOwl#hasAlternativeId"))) == "hasAlternativeId"
    assert one(spark, T.clean_uri(F.lit("is_a"))) == "is_a"
    assert one(spark, T.squeeze(F.lit("a  b\n c"), 3)) == "a b..."
    assert one(spark, T.printable(F.lit("a\x00b​\n"))) == "ab\n"
    assert one(spark, T.without_brackets(F.lit("x (y) [z]"))) == "x"


def test_match_strategies(spark):
    ref = spark.createDataFrame([("TNF-alpha", "G1"), ("interleukin 6", "G2"), ("heat shock protein", "G3")], "name string, v string")
    q = spark.createDataFrame([(x,) for x in ("TNF", "human TNF-beta", "shock", "cold shock response", "interleuk", "zzz", None, "TNF")], "q string")
    got = sorted((r["query"], r["strategy"], r["value"]) for r in matching.match(q, "q", ref, "name", "v").collect() if r["strategy"] != "suffix")
    assert got == [("TNF", "exact", "G1"), ("cold shock response", "parts", "G3"), ("human TNF-beta", "ngram", "G1"), ("interleuk", "prefix", "G2"), ("shock", "part", "G3")]


def test_multimap(spark):
    df = spark.createDataFrame([("A; B", 1), ("nan", 2), (" a ", 3), (None, 4)], "x string, y int")
    got = sorted(map(tuple, relational.multimap(F.col("x"), F.col("y"), df, [";"]).collect()))
    assert got == [("a", 1), ("a", 3), ("b", 1)]


def test_fusion(spark):
    h = spark.createDataFrame([(1, "a", 0.9, 0.0), (1, "b", 0.8, 2.0), (1, "c", 0.5, 4.0)], "q int, d string, dense double, sparse double")
    got = {r["d"]: (r["score"], r["dense_rank"], r["sparse_rank"], r["rank"]) for r in retrieval.fuse(h, "q", "d", digits=4).collect()}
    assert got == {"a": (0.5, 1, 3, 3), "b": (0.6944, 2, 2, 2), "c": (0.7778, 3, 1, 1)}


def test_token_search(spark):
    index = spark.createDataFrame([(1, "t1", "Homo sapiens"), (2, "t2", "Homo sapiens neanderthalensis"), (3, "t3", "Homo"), (4, "t1", "homo homo"), (5, "t5", None)], "e int, id string, name string")
    q = spark.createDataFrame([(9, "homo sapiens"), (10, None), (11, "")], "q int, text string")
    got = [(r["id"], r["raw"], round(r["score"], 6)) for r in retrieval.token_search(q, index, "q", "text", "e", "id", "name").orderBy("rank").collect()]
    assert got == [("t1", 198, 1.0), ("t2", 197, round(197 / 198, 6)), ("t3", 99, 0.5)]


def test_dense_recall_ties_and_nulls(spark):
    v = spark.createDataFrame([(3, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (4, None), (5, [1.0])], "id bigint, v array<float>")
    got = retrieval.dense_recall(v.where("id = 3").withColumnRenamed("id", "q"), v, "q", "id", "v", "v", 2)
    assert sorted((r["q"], r["id"], r["score"]) for r in got.collect()) == [(3, 1, 1.0), (3, 3, 1.0)]
    assert retrieval.dense_recall(v.limit(0).withColumnRenamed("id", "q"), v, "q", "id", "v", "v", 2).count() == 0


def test_fuzzy(spark):
    index = spark.createDataFrame([("m", "Mus musculus", "mouse"), ("h", "Homo sapiens", "human")], "id string, name string, other string")
    q = spark.createDataFrame([(1, "mus muscolus"), (2, "humn"), (3, "nothing")], "q int, text string")
    got = {r["q"]: r["id"] for r in retrieval.fuzzy_search(q, index, "q", "text", "id", {"name": 3.0, "other": 1.0}, 1).collect()}
    assert got == {1: "m", 2: "h"}


EDGES = [("c", "b", "is_a"), ("b", "a", "is_a"), ("d", "b", "part_of"), ("x", "b", "hasAlternativeId")]


def test_graph(spark):
    e = spark.createDataFrame(EDGES, "u string, v string, relation string")
    n = spark.createDataFrame([(x,) for x in "abcdxz"], "node string")
    names = lambda df: sorted(r["node"] for r in df.collect())
    assert names(graph.graph_ancestors(e, "b")) == ["b", "c", "d", "x"]
    assert names(graph.graph_descendants(e, "b")) == ["a", "b"]
    nodes, edges = graph.local_context(n, e, "b")
    assert names(nodes) == ["a", "b", "c", "x"] and edges.count() == 3
    assert {r["node"]: r["level"] for r in graph.levels(e, n).collect()} == {"a": 0, "b": 1, "c": 2, "d": 2, "x": 2, "z": 0}
    assert {r["node"]: r["component"] for r in graph.components(e).collect()} == dict.fromkeys("abcdx", "a")
    assert names(graph.on_hierarchy(n, e)) == ["a", "b", "c"]
    with pytest.raises(ValueError):
        graph.graph_ancestors(e, "nowhere")
    with pytest.raises(RuntimeError):
        graph.levels(spark.createDataFrame([("p", "q", "is_a"), ("q", "p", "is_a")], "u string, v string, relation string"))


def test_last_edge_wins(spark):
    e = spark.createDataFrame([("a", "b", "r1", 1), ("a", "b", "r2", 2), (None, "b", "r", 3)], "u string, v string, relation string, n int")
    assert [tuple(r) for r in graph.last_edge(e, "n").collect()] == [("a", "b", "r2")]


def at(n):
    return datetime(2024, 1, 1, 0, 0, n)


def log(spark, rows):
    return spark.createDataFrame(rows, queues.LOG)


def test_gating(spark):
    rows = [("A", 1, "done", at(1)), ("A", 2, "done", at(2)), ("B", 2, "done", at(3)), ("A", 3, "done", at(4)), ("B", 1, "failed", at(5)), (None, 1, "done", at(1)), ("A", None, "done", at(1)), ("A", 1, "done", at(1))]
    assert [r["item"] for r in queues.claim(log(spark, rows), ["A", "B"], "C").collect()] == [2, 1]
    assert [r["item"] for r in queues.claim(log(spark, [*rows, ("C", 2, "done", at(9))]), ["A", "B"], "C").collect()] == [1]
    assert [r["item"] for r in queues.claim(log(spark, [*rows, ("B", 2, "removed", at(9))]), ["A", "B"], "C").collect()] == [1]
    assert queues.claim(log(spark, []), ["A"], "C").count() == 0


def test_stages_run_in_order(spark, tmp_path):
    path = str(tmp_path / "log")
    log(spark, [("start", i, "done", at(i)) for i in range(5)]).write.parquet(path)
    work = lambda items: items.select("item", (F.col("item") != 3).alias("ok"))
    stages = [queues.Stage("C", ("A", "B"), work), queues.Stage("A", ("start",), work), queues.Stage("B", ("start",), work)]
    assert queues.run_batch(spark, path, stages) == {"A": 5, "B": 5, "C": 5}
    assert queues.run_batch(spark, path, stages) == {"A": 0, "B": 0, "C": 0}
    with pytest.raises(ValueError):
        queues.in_order([queues.Stage("a", ("b",), work), queues.Stage("b", ("a",), work)])


def test_best_and_longest(spark):
    rows = spark.createDataFrame([("g1", "P2", 1), ("g1", "Q9", 5), ("g1", "P1", 3), ("g2", "Q2", 2), ("g2", "Q1", 2)], "g string, p string, n int")
    best = relational.best_per_key(rows, ["g"], ~F.col("p").startswith("P"), -F.col("n"), F.col("p"))
    assert sorted((r["g"], r["p"]) for r in best.collect()) == [("g1", "P1"), ("g2", "Q1")]
    d = spark.createDataFrame([("tp53", "", 1), ("tp53", "tumor suppressor", 2), ("brca1", "x", 3), ("n", None, 4)], "name string, d string, i int")
    assert sorted((r["name"], r["d"]) for r in relational.longest_per_key(d, "name", "d", "i").collect()) == [("brca1", "x"), ("n", None), ("tp53", "tumor suppressor")]


def test_fallback(spark):
    e = spark.createDataFrame([("a", "s1", 1), ("a", "s2", 2), ("b", "", 3), ("b", "s9", 4), ("c", "s1", 5)], "name string, sp string, v int")
    q = spark.createDataFrame([("a", "s1"), ("a", "zz"), ("b", "zz"), ("c", "zz"), (None, "s1")], "name string, sp string")
    got = {(r["name"], r["sp"]): r["v"] for r in relational.fallback_lookup(q, e, "name", "sp", "v").collect()}
    assert got == {("a", "s1"): 1, ("a", "zz"): None, ("b", "zz"): 3, ("c", "zz"): 5, (None, "s1"): None}


def test_completeness(spark):
    df = spark.createDataFrame([("Short.",), ("NO_ABSTRACT",), ("",), (None,), ("x" * 60,), ("x" * 60 + ".",)], "t string")
    got = [tuple(r)[1:] for r in metrics.completeness(df, "t").collect()]
    assert got == [(True, False, False), (False, False, True), (False, False, True), (False, False, True), (False, True, False), (False, False, True)]
    assert metrics.share(df.limit(0), F.lit(True)).first()["ratio"] == 0.0


REL = {"components": [{"name": "TP53", "type": "gene", "meta": [{"name": "mouse", "type": "species"}]}, {"name": "cell", "type": "cell_line"}], "targets": [{"name": "repair", "type": "GO", "id": "GO:1"}], "contexts": [{"name": "human", "type": "species"}], "relation": {"name": "r"}}


def test_relations(spark):
    docs = spark.createDataFrame([(1, json.dumps([{"sentence": "s", "rel_from_this_sent": [REL]}]))], "doc bigint, text string")
    m = relations.mentions(docs, "doc", "text")
    got = {r["name"]: r["species"] for r in relations.with_species(m).collect()}
    assert got == {"TP53": "mouse", "cell": "human", "repair": "human", "human": "human"}
    flat = relations.flattened(docs, "doc", "text")
    assert sorted((r["component_name"], r["target_name"]) for r in flat.collect()) == [("TP53", "repair"), ("cell", "repair")]
    acc = spark.createDataFrame([("TP53", "P04637")], "name string, accession string")
    assert [(r["uniprot_id"], r["uniprot_mapped"]) for r in relations.process_facts(flat, acc).collect()] == [("P04637", True)]
    best = spark.createDataFrame([(1, "gene", "TP53", "mouse", "P02340", None)], "doc_id bigint, ontology string, name string, species string, best_id string, best_name string")
    kept = relations.apply_best(relations.with_species(m), best, [relations.Ontology(("gene",), "gene", True), relations.Ontology(("GO",), "go")])
    assert sorted((r["name"], r["id"]) for r in kept.collect()) == [("P02340", "P02340"), ("cell", None), ("human", None)]
    again = json.loads(relations.rebuilt(docs, "doc", "text").first()["relations"])
    twice = spark.createDataFrame([(1, json.dumps(again))], "doc bigint, text string")
    assert json.loads(relations.rebuilt(twice, "doc", "text").first()["relations"]) == again
    assert nested.found(twice, "doc", "text").count() == nested.found(docs, "doc", "text").count() == 5


def test_models(spark):
    rows = spark.createDataFrame([(1, "x", None, [("A1", "x", None)]), (2, "y", None, []), (3, "z", "d", None)], "i int, name string, description string, hits array<struct<id string, name string, description string>>")
    got = {r["i"]: (r["best"]["id"] if r["best"] else None, r["status"]) for r in models.judged(rows).collect()}
    assert got == {1: ("A1", "ok"), 2: (None, "empty"), 3: (None, "empty")}

    class Broken:
        def query(self, prompt):
            raise OSError("down")

    bad = models.answered(spark.createDataFrame([("p",), (None,)], "prompt string"), "prompt", Broken, attempts=2, pause=0.0)
    assert sorted((r["answer"], r["error"]) for r in bad.where("prompt is not null").collect()) == [(None, "OSError: down")]
    c = spark.createDataFrame([("A binds B", "binds B"), ("A binds B", "kills C")], "sentence string, claim string")
    assert [r["valid"] for r in models.checked(c).orderBy("claim").collect()] == [True, False]
    d = models.decomposed(spark.createDataFrame([("repair of DNA", "GO"), ("x of y", "gene"), ("z", "GO")], "name string, type string"))
    assert {r["name"]: r["rewritten"] is not None for r in d.collect()} == {"repair of DNA": True, "x of y": False, "z": False}


def test_limiter_and_retry():
    now = [0.0]
    slept = []

    def sleep(s):
        slept.append(s)
        now[0] += s

    limiter = models.RateLimiter(2, 1.0, clock=lambda: now[0], sleep=sleep)
    for _ in range(5):
        limiter.wait()
    assert slept == [1.0, 1.0]
    pauses, left = [], [2]

    def call():
        if left[0]:
            left[0] -= 1
            raise OSError
        return "ok"

    assert models.retried(call, sleep=pauses.append) == "ok" and pauses == [1.0, 2.0]


def test_pipeline(spark):
    docs = spark.createDataFrame([(1, json.dumps([{"sentence": "s", "rel_from_this_sent": [REL]}])), (2, json.dumps([{"sentence": "s", "rel_from_this_sent": [{"components": [{"name": "odd thing", "type": "GO"}], "targets": ["x"]}]}]))], "doc bigint, text string")
    found = relations.with_species(relations.mentions(docs, "doc", "text"))
    go = spark.createDataFrame([("GO:1", "DNA repair", "d"), ("GO:2", "repair", None)], "id string, name string, description string")
    genes = spark.createDataFrame([("P1", "TP53", "tumor"), ("P2", "odd", "thing")], "id string, name string, description string")
    ontologies = [relations.Ontology(("GO",), "go"), relations.Ontology(("gene",), "gene", use_species=True)]
    searches = {"go": stages.token_lookup(go), "gene": stages.token_lookup(genes)}
    kept, best = stages.resolve(found, ontologies, searches, [stages.Conversion("go", "gene", "gene")])
    got = sorted((r["doc_id"], r["name"], r["type"], r["id"]) for r in kept.collect())
    assert got == [(1, "TP53", "gene", "P1"), (1, "cell", "cell_line", None), (1, "human", "species", None), (1, "repair", "GO", "GO:2"), (2, "odd", "gene", "P2"), (2, "x", None, None)]
    assert sorted((r["ontology"], r["status"], r["n"]) for r in stages.statuses(best).collect()) == [("gene", "matched", 2), ("go", "matched", 1)]
    empty, _ = stages.resolve(found.limit(0), ontologies, searches)
    assert empty.count() == 0
    assert relations.chosen_keys({"a": 1, "b": 2}, ["a"]) == {"a": 1} and relations.chosen_keys({"b": 2}, ["a"]) == {"b": 2}
    assert stages.Pattern("p", "d", ("x", "y")).schema() == {"x": "", "y": ""}


def test_index(spark, tmp_path):
    rows = spark.createDataFrame([(1, "heart muscle v1.2"), (2, None), (3, "")], "i int, t string")
    retrieval.build_index(rows, "i", "t", F.coalesce("t", F.lit("")), str(tmp_path / "i"))
    got = {r["id"]: r for r in spark.read.parquet(str(tmp_path / "i")).collect()}
    assert got[1]["sparse"] == {"heart": 1.0, "muscle": 1.0} and len(got[1]["vector"]) == 64 and got[3]["sparse"] == {}
    q = got[1]["vector"]
    assert abs(sum(x * x for x in q) - 1) < 1e-5


class Fixed:
    """Answers by a word of the prompt."""

    def __init__(self, answers):
        self.answers = answers

    def query(self, prompt):
        return next((a for w, a in self.answers.items() if w in prompt.rpartition(": ")[2] or w in prompt), "none")


def test_extraction_and_patterns(spark):
    s = spark.createDataFrame([(1, 0, "alpha"), (1, 1, "beta"), (2, 0, "gamma")], "doc_id bigint, sent_no int, sentence string")
    out = models.extracted(s, lambda: Fixed({"gamma": "no", "beta": 'so: [{"a": 1}]', "alpha": '{"b": 2}'}))
    got = {(r["doc_id"], r["sent_no"]): (r["history"], r["relations"], r["status"]) for r in out.collect()}
    assert got == {(1, 0): ("", '[{"b": 2}]', "ok"), (1, 1): ("alpha", '[{"a": 1}]', "ok"), (2, 0): ("", None, "failed")}
    d = spark.createDataFrame([("x y",), (None,)], "t string")
    c = models.classified(d, "t", ["p1", "p2"], lambda: Fixed({"x y": '["p2", "other"]'}))
    assert [r["patterns"] for r in c.orderBy("t").collect()] == [None, ["p2"]]


def test_coverage_of_runs(spark):
    a = spark.createDataFrame([(1, "binds B"), (1, "kills C"), (2, "x")], "doc bigint, claim string")
    b = spark.createDataFrame([(1, "A binds B")], "doc bigint, claim string")
    assert sorted((r["claim"], r["covered"]) for r in models.covered(a, b, "doc", "claim").collect()) == [("binds B", True), ("kills C", False), ("x", False)]


def test_cache_answers_once(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("b",)], "prompt string")
    first = models.answered(rows, "prompt", lambda: Fixed({"a": "1", "b": "2"}))
    cache = first.select("key", "answer").distinct()

    class Never:
        def query(self, prompt):
            raise AssertionError("asked again")

    again = models.answered(rows, "prompt", Never, cache=cache, attempts=1)
    assert sorted((r["prompt"], r["answer"], r["error"]) for r in again.collect()) == [("a", "1", None), ("a", "1", None), ("b", "2", None)]


def test_prompt_budget(spark):
    hits = F.transform(F.sequence(F.lit(1), F.lit(50)), lambda i: F.struct(F.concat(F.lit("id"), i.cast("string")).alias("id"), F.repeat(F.lit("n"), 600).alias("name"), F.lit(None).cast("string").alias("description")))
    p = one(spark, models.choice_prompt(F.lit("x"), F.lit(None).cast("string"), hits))
    lines = [x for x in p.split("\n") if x.startswith("- ")]
    assert 15 < len(lines) <= 30 and sum(len(x) + 1 for x in lines) <= 8000 and all(len(x) < 420 for x in lines)


def test_small_ones(spark):
    m = lambda d: F.create_map(*(F.lit(x) for kv in d.items() for x in kv))
    assert one(spark, T.common_pairs(m({"a": 1, "b": 2}), m({"a": 1, "b": 3, "c": 4}))) == 1
    assert one(spark, retrieval.index_text(F.lit("l"), F.array(F.lit("a"), F.lit("b")))) == "l; Synonyms: a; b"
    assert one(spark, retrieval.index_text(F.lit("l"), F.array().cast("array<string>"))) == "l"
    assert one(spark, retrieval.description(F.lit("l"), retrieval.sorted_names(F.array(F.lit("b"), F.lit("a"), F.lit("b"))))) == "l | a, b"
    assert one(spark, T.id_from_path(F.lit("/x/123/r.json"))) == "123" and one(spark, T.id_from_path(F.lit("r"))) is None
    w = spark.createDataFrame([(1, {"a": 1.0, "b": -1.0, "c": 0.0})], "i int, w map<string,double>")
    assert [tuple(r) for r in retrieval.sparse_weights(w, "i", "w").collect()] == [(1, "a", 1.0)]
    q = spark.createDataFrame([("x", "p"), ("x", "q"), ("y", "p"), (None, "p")], "i string, g string")
    assert [r["i"] for r in relational.in_all(q, "i", "g", ["p", "q"]).collect()] == ["x"]
    into = spark.createDataFrame([(1, "old")], "i int, v string")
    new = spark.createDataFrame([(1, "new"), (2, "new"), (2, "new")], "i int, v string")
    assert sorted(map(tuple, relational.insert_or_ignore(into, new, ["i"]).collect())) == [(1, "old"), (2, "new")]
    roll = metrics.roll_up(spark.createDataFrame([("s", 1, 3), ("s", 1, 0), ("z", 0, 0)], "k string, c int, t int"), ["k"], "c", "t")
    assert sorted((r["k"], r["ratio"]) for r in roll.collect()) == [("s", 0.667), ("z", 0.0)]
    rows = relational.merge_first_wins(spark.createDataFrame([("a", None), ("b", "1")], "k string, v string"), spark.createDataFrame([("a", "2"), ("b", "3"), ("c", "4")], "k string, v string"), ["k"], ["v"])
    assert sorted(map(tuple, rows.collect())) == [("a", "2"), ("b", "1"), ("c", "4")]


def test_species_tables(spark):
    docs = spark.createDataFrame([(1, json.dumps([{"sentence": "s", "rel_from_this_sent": [{"components": [{"name": "HeLa", "type": "cell_line"}, {"name": "p", "type": "protein"}], "targets": [], "relation": {}}]}])), (2, "[]"), (3, None)], "doc bigint, text string")
    m = relations.mentions(docs, "doc", "text")
    lines = spark.createDataFrame([("HeLa", "Homo sapiens")], "name string, species string")
    s = relations.with_species(m, lines, ["cell_line"])
    assert {r["species"] for r in s.collect()} == {relations.CELL + "HeLa"}
    names = spark.createDataFrame([("human", "Homo sapiens")], "name string, scientific string")
    assert {r["species"] for r in relations.resolved_species(s, names, lines).collect()} == {"Homo sapiens"}
    assert relations.first_species(m).count() == 0
    e = relations.example_relation(m)
    assert sorted((r["name"], r["block_no"], r["rel_no"]) for r in e.collect()) == [("HeLa", 0, 0), ("p", 0, 0)]
    assert relations.relation_names(docs, "doc", "text").count() == 0
    assert relations.without_descriptions({"description": "x", "meta": [{"description": "y", "name": "n"}]}) == {"meta": [{"name": "n"}]}


class Recording:
    """Keeps what it is asked in a file, as it runs in other processes."""

    def __init__(self, path, answer):
        self.path, self.answer = path, answer

    def query(self, prompt):
        with open(self.path, "a") as f:
            f.write(json.dumps(prompt) + "\n")
        return self.answer


def test_each_policy_has_its_prompt(spark, tmp_path):
    rows = spark.createDataFrame([("x", "d", [("A1", "x", None)], "used here")], "name string, description string, hits array<struct<id string, name string, description string>>, example string")
    asked = {}
    for method in ("strict", "relaxed", "forced"):
        path = str(tmp_path / method)
        models.judged(rows, lambda path=path: Recording(path, "A1"), method).collect()
        asked[method] = json.loads(open(path).readline())
    assert len(set(asked.values())) == 3 and "PARENT:" in asked["relaxed"] and all("used here" in p for p in asked.values())
    claims = spark.createDataFrame([("A binds B", "binds B")], "sentence string, claim string")
    for method in ("strict", "loose"):
        path = str(tmp_path / f"v{method}")
        models.checked(claims, lambda path=path: Recording(path, "Yes"), method).collect()
        asked[method] = json.loads(open(path).readline())
    assert asked["strict"] != asked["loose"]


def test_decomposition_is_applied(spark):
    doc = [{"sentence": "s", "rel_from_this_sent": [{"components": [{"name": "repair of DNA", "type": "GO", "meta": [{"name": "m"}]}, "x"], "targets": [{"name": "y of z", "type": "gene"}], "relation": "r"}]}]
    docs = spark.createDataFrame([(1, json.dumps(doc)), (2, "broken [")], "doc bigint, text string")
    out = stages.decomposed(docs, "doc", "text").collect()
    rel = json.loads(out[0]["relations"])[0]["rel_from_this_sent"][0]
    assert len(out) == 1 and [e["name"] for e in rel["components"]] == ["DNA", "x"] and rel["components"][0]["meta"][0]["name"] == "repair"
    assert rel["targets"][0]["name"] == "y of z"


def test_json_columns(spark):
    df = spark.createDataFrame([('{"a": 1, "b": {"description": 2, "c": [{"description": 3}]}}',), ('{"x": 1}',), ("bad",), (None,)], "t string")
    got = [tuple(r) for r in df.select(relations.stripped("t"), relations.subset("t", ["a"])).collect()]
    assert got == [('{"a": 1, "b": {"c": [{}]}}', '{"a": 1}'), ('{"x": 1}', '{"x": 1}'), (None, None), (None, None)]


def test_cosine_scores_and_source_columns(spark):
    rows = spark.createDataFrame([(0, [1.0, 0.0], "a"), (1, [2.0, 0.0], "b"), (2, [0.0, 3.0], "c"), (3, [0.0, 0.0], "d"), (4, None, "e")], "i bigint, v array<double>, name string")
    q = rows.where("i = 0").select(F.col("i").alias("q"), "v")
    got = {r["i"]: r["score"] for r in retrieval.dense_recall(q, rows, "q", "i", "v", "v", 5, "cosine01").collect()}
    assert got == {0: 1.0, 1: 1.0, 2: 0.5, 3: 0.5}
    w = spark.createDataFrame([(0, 1, 1.0), (2, 1, 2.0)], "i bigint, token int, weight double")
    hits = retrieval.hybrid_search(q, rows, w.where("i = 0").withColumnRenamed("i", "q"), w, "q", "i", "v", k=2, source=["name"])
    assert {r["name"] for r in hits.collect()} == {"a", "b"}  # all three have 0.5, ids decide


def test_only_changed_input_is_done_again(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None), (3, "c"), (None, "x")], "item bigint, text string").withColumn("digest", queues.digest("text"))
    later = spark.createDataFrame([(1, "a"), (2, ""), (3, "d"), (4, "new")], "item bigint, text string").withColumn("digest", queues.digest("text"))
    assert sorted(r["item"] for r in queues.changed(later, rows).collect()) == [2, 3, 4]
    assert queues.changed(rows, rows).count() == 0 and queues.changed(rows, rows.limit(0)).count() == 3
