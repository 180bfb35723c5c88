"""Every query with SQL against the SQL in DuckDB, on the smallest tables; every other one has to run."""

import glob
import json
import math
import os

import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from read_parquet('{p}')")
    return con


def plain(v):
    if v is None or v != v:
        return None
    if isinstance(v, float):
        return f"{v:.6g}" if math.isfinite(v) else str(v)
    if isinstance(v, bool):
        return str(int(v))
    return str(v)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(plain(r[i])) for i in order) for r in data), sorted(columns)


from litweave.plans import catalog  # noqa: E402


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_sql(spark, duck, name):
    got = catalog.QUERIES[name](spark, DATA)
    want = duck.execute(catalog.ORACLE[name])
    columns = [c[0] for c in want.description]
    assert rows(got.columns, got.collect()) == rows(columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE)))
def test_runs(spark, name):
    df = catalog.QUERIES[name](spark, DATA)
    assert df.count() >= 0 and df.columns


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0


def test_folded_json_keeps_the_files_between(spark, tmp_path):
    texts = [(5, '{"c": 3, "l": [{"n": 1}]}'), (1, '{"a": 1, "c": 1}'), (3, '{"b": 2, "c": 2}'), (4, "no json"), (2, None)]
    rows = [(1, "x", i, t) for i, t in texts] + [(1, "y", 6, '{"l": [{"n": 1}]}'), (2, "x", 7, "-"), (None, "x", 8, "{}")]
    spark.createDataFrame(rows, "pmid bigint, name string, file_id bigint, content string").write.parquet(f"{tmp_path}/files.parquet")
    got = {(r["pmid"], r["name"]): r["content"] for r in catalog.QUERIES["deep_merge"](spark, str(tmp_path)).collect()}
    assert got == {(1, "x"): '{"a": 1, "b": 2, "c": 3, "l": [{"n": 1}]}', (1, "y"): '{"l": [{"n": 1}]}', (2, "x"): None}


def test_hybrid_search_recalls_beyond_rank_50(spark, tmp_path):
    """Entry 99 has dense rank 60 for the query, entry 20, and the largest sparse score."""
    rows = [(20, [1.0, 0.5, 1.0]), (99, [2.0, 0.0, -1.5])] + [(i, [0.6, 0.0, 0.0]) for i in range(101, 159)]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {r["vec_id"]: r["rank"] for r in catalog.QUERIES["hybrid_search_200"](spark, str(tmp_path)).where("query_id = 20").collect()}
    assert got[20] == 1 and got[99] == 2
    assert 99 not in {r["vec_id"] for r in catalog.QUERIES["hybrid_search"](spark, str(tmp_path)).where("query_id = 20").collect()}


def plain_records(text):
    """Complete records by whole documents, else by lines."""
    try:
        value = json.loads(text)
    except ValueError:
        value = None
    if value is not None:
        return [r for r in (value if isinstance(value, list) else [value]) if isinstance(r, dict)]
    if text.lstrip("﻿ \t\r\n")[:1] in ("{", "["):
        decoder, out, at = json.JSONDecoder(), [], 0
        while (at := text.find("{", at)) >= 0:
            try:
                r, at = decoder.raw_decode(text, at)
                out.append(r)
            except ValueError:
                at += 1
        return out
    lines = [x.rstrip("\r").split("\t") for x in text.lstrip("﻿").split("\n") if x.strip()]
    out, head = [], None
    for cells in lines:
        names = [c.strip().lstrip("#").strip() for c in cells]
        if "rid" in names:
            head = names
        elif head and len(cells) == len(head):
            out.append(dict(zip(head, cells)))
    return out


def test_records_of_small_files(spark):
    import pandas as pd

    want = set()
    for text in pd.read_parquet(f"{DATA}/files.parquet")["content"].dropna():
        want |= {str(r["rid"]).strip() for r in plain_records(text) if r.get("rid") not in (None, "")}
    got = [r["rid"] for r in catalog.QUERIES["p5_found"](spark, DATA).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_salvaged_arrays(spark):
    got = {r["merged_id"]: r["relations"] for r in catalog.QUERIES["json_salvage"](spark, DATA).collect()}
    texts = {r["merged_id"]: r["relations"] for r in spark.read.parquet(f"{DATA}/merged.parquet").collect()}
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        try:
            value = json.loads(text) if text else None
        except ValueError:
            continue
        if isinstance(value, (list, dict)):
            assert json.loads(got[i]) == (value if isinstance(value, list) else [value])


def test_resolved_documents_and_their_statuses(spark):
    kept = catalog.QUERIES["resolve_documents"](spark, DATA).collect()
    ids = {r["go_id"] for r in spark.read.parquet(f"{DATA}/go_ref.parquet").collect()} | {r["accession"] for r in spark.read.parquet(f"{DATA}/uniprot_ref.parquet").collect()}
    assert kept and all(r["id"] in ids for r in kept if r["type"] in ("GO", "gene", "protein"))
    statuses = {(r["ontology"], r["status"]): r["n"] for r in catalog.QUERIES["resolve_statuses"](spark, DATA).collect()}
    assert {o for o, _ in statuses} == {"go", "uniprot"} and all(s in ("matched", "empty", "refused", "failed") and n > 0 for (_, s), n in statuses.items())
