"""What used to have a bound: depth, wrappings, rounds, bins."""

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from litweave.functions import deepjson
from litweave.operators import compaction, graph, nested
from litweave.session import shared_dir


def deep(n):
    return '[{"sentence": "s", "rel_from_this_sent": [{"components": [' + '{"name": "a", "meta": [' * n + "]}" * n + '], "target": "t"}]}]'


def test_any_depth():
    nodes = nested.walk(deep(100_000))
    assert len(nodes) == 100_003 and max(n[3] for n in nodes) == 100_001
    assert nested.walk(deep(100_000)[:-1]) == []


def test_depth_in_a_query(spark):
    df = spark.createDataFrame([(1, deep(5_000)), (2, deep(3))], "merged_id bigint, relations string")
    got = nested.found(df, "merged_id", "relations").groupBy("merged_id", "role").count().collect()
    assert sorted(map(tuple, got)) == [(1, "component", 5_000), (1, "target", 1), (2, "component", 3), (2, "target", 1)]


def test_any_number_of_wrappings():
    text = deep(2)
    for _ in range(9):
        text = json.dumps(text)
    assert len(nested.walk(text)) == 5
    assert nested.walk(json.dumps("no json")) == []


values = st.recursive(st.none() | st.booleans() | st.integers(-(10**20), 10**20) | st.floats(allow_nan=False, allow_infinity=False) | st.text(), lambda x: st.lists(x, max_size=4) | st.dictionaries(st.text(), x, max_size=4), max_leaves=20)


@settings(max_examples=200, deadline=None)
@given(values, st.sampled_from([None, 2]))
def test_the_loop_reads_what_the_standard_reader_reads(value, indent):
    text = json.dumps(value, indent=indent)
    assert deepjson.walked(text, 0) == (json.loads(text), len(text))
    for cut in (text[:-1], text[: len(text) // 2]):
        try:
            want = json.JSONDecoder().raw_decode(cut)
        except ValueError:
            with pytest.raises(ValueError):
                deepjson.walked(cut, 0)
        else:
            assert deepjson.walked(cut, 0) == want


def test_deep_values_come_back():
    text = '{"a": [' * 50_000 + "1" + "]}" * 50_000
    assert deepjson.dumps(deepjson.loads(text)) == text
    assert [r for r, _ in compaction.records('{"rid": "x", "v": ' + text + '}\n{"rid": "y"}')] == ["x", "y"]


def test_files_that_change_are_noticed(spark, tmp_path, monkeypatch):
    rows = [(i, f'{{"rid": "r{i}"}}') for i in range(20)] + [(3, '{"rid": "r3"}'), (None, None)]
    df = spark.createDataFrame(rows, "file_id bigint, content string")
    done = compaction.compact(df, written=None)
    assert (done.rows, done.files) == (20, 21)
    other = spark.createDataFrame([(i, t.replace("r7", "r77") if t else t) for i, t in rows], df.schema)
    real = compaction.manifest
    monkeypatch.setattr(compaction, "manifest", lambda files: real(compaction.given(other, None)))
    with pytest.raises(ValueError):
        compaction.compact(df, written=None)


def test_shards_are_bounded_by_files(spark):
    frozen = spark.range(1000).selectExpr("id as file_id", "id as checksum", "cast(1 as bigint) as size", "1 as copies")
    bins = compaction.pack(frozen, target_bytes=1000, shard_files=100)
    assert bins.count() == 1000 and bins.selectExpr("shiftright(bin, 24)").distinct().count() == 10


@pytest.mark.parametrize("most", [graph.CORE_EDGES, 0])
def test_graphs_by_tasks_and_by_joins(spark, most):
    n = 700 if most else 12
    edges = spark.createDataFrame([(i, i + 1, "is_a") for i in range(n)] + [(2000, 2001, "is_a"), (2001, 2001, "is_a"), (5, None, "is_a"), (3, 5, "is_a")], "u bigint, v bigint, relation string")
    starts = spark.createDataFrame([(1,), (2000,)], "node bigint")
    got = graph.reach(edges, starts, core_edges=most).groupBy("start").count().collect()
    assert sorted(map(tuple, got)) == [(1, n), (2000, 2)]
    got = {tuple(r) for r in graph.components(edges, core_edges=most).collect()}
    assert got == {(i, 0) for i in range(n + 1)} | {(2000, 2000), (2001, 2000)}
    got = {tuple(r) for r in graph.levels(edges, core_edges=most).collect()}
    assert got == {(i, n - i) for i in range(n + 1)} | {(2000, 1), (2001, 0)}
    with pytest.raises(RuntimeError):
        graph.levels(spark.createDataFrame([(1, 2, "is_a"), (2, 1, "is_a")], edges.schema), core_edges=most)
    assert graph.components(edges.limit(0), core_edges=most).count() == 0


def test_only_local_masters_get_a_local_folder():
    class Conf:
        def get(self, *_):
            return None

    class Jvm:
        def sc(self):
            return self

        def getCheckpointDir(self):
            return self

        def isDefined(self):
            return False

    class Session:
        conf = Conf()

        class sparkContext:  # noqa: N801
            master, _jsc = "spark://somewhere:7077", Jvm()

    with pytest.raises(RuntimeError):
        shared_dir(Session())
