"""Readers and writers on literal files."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from litweave.sources import delimited, flatfile, store, structured

RECORD = """ID   T1_TEST
AC   P12345; Q67890;
FT   DOMAIN          10..50
FT                   /note="Kinase"
FT                   /evidence="ECO:1"
FT   ACT_SITE        57
FT                   /note="Charge relay"
FT   REGION          60..70
DR   GO; GO:0005634; C:nucleus; IDA:X.
DR   InterPro; IPR000719; Prot_kinase_dom.
SQ   SEQUENCE   12 AA;  1300 MW;  075C8FA17B3C5C56 CRC64;
     MARPLLGKTS SV
//
"""


@pytest.fixture
def flat(tmp_path):
    p = tmp_path / "x.dat.gz"
    with gzip.open(p, "wt") as f:
        f.write(RECORD + RECORD.replace("P12345; Q67890", "A00001"))
    return str(p)


def test_flat_file(spark, flat):
    ft = [tuple(r) for r in flatfile.features(spark, flat).where("accession = 'P12345'").orderBy("start_pos").collect()]
    assert ft == [("P12345", "DOMAIN", 10, 50, "Kinase", "ECO:1"), ("P12345", "REGION", 60, 70, "", "")]
    compat = flatfile.features(spark, flat, compat=True).where("accession = 'P12345'").orderBy("start_pos").first()
    assert compat["note"] == "Charge relay"
    dr = sorted(tuple(r) for r in flatfile.cross_references(spark, flat).where("accession in ('P12345', 'Q67890')").collect())
    assert len(dr) == 4 and dr[0] == ("P12345", "GO", "GO:0005634", "C:nucleus", "IDA:X") and dr[1] == ("P12345", "InterPro", "IPR000719", "Prot_kinase_dom", "")
    sq = [tuple(r) for r in flatfile.sequences(spark, flat).orderBy("accession").collect()]
    assert sq[1] == ("P12345", 12, 1300, "075C8FA17B3C5C56", "MARPLLGKTSSV") and len(sq) == 2


def test_tsv(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("x\ty\na\tb\t\n\na\t\tb\n12abc\t1e2\n")
    cells = [r["cells"] for r in delimited.read_tsv(spark, str(tmp_path / "a.tsv")).collect()]
    assert cells == [["x", "y"], ["a", "b"], ["a", "", "b"], ["12abc", "1e2"]]
    last = delimited.read_tsv(spark, str(tmp_path / "a.tsv")).select(delimited.as_double(F.col("cells")).alias("d"), delimited.as_int(F.col("cells")).alias("i")).collect()[-1]
    assert last["d"] == [12.0, 100.0] and last["i"] == [12, 1]
    (tmp_path / "b.tsv").write_text("x\ty\nc\n")
    got = delimited.read_many(spark, [str(tmp_path / "a.tsv"), str(tmp_path / "b.tsv"), str(tmp_path / "no.tsv")])
    assert sorted(tuple(str(v) for v in r) for r in got.collect()) == [("12abc", "1e2"), ("a", ""), ("a", "b"), ("c", "None")]
    assert delimited.read_tsv(spark, str(tmp_path / "none.tsv"), safe=True).count() == 0
    found = delimited.find_files(spark, str(tmp_path), r"a\.tsv|b\.t.*")
    assert found.count() == 2


def test_tables(spark, tmp_path):
    delimited.write_lines_gz(str(tmp_path / "t.gz"), ["#id\tname", "1\ta\\b", "2\t"])
    got = delimited.read_table(spark, str(tmp_path / "t.gz"))
    assert got.columns == ["id", "name"] and sorted(map(tuple, got.collect())) == [("1", "ab"), ("2", "")]
    assert delimited.read_table(spark, str(tmp_path / "t.gz"), ["p", "q"]).count() == 3
    (tmp_path / "h1.tsv").write_text("a\tb\n1\t2\na\tb\n")
    (tmp_path / "h2.tsv").write_text("a\tb\n3\t4\n")
    got = delimited.read_many(spark, [str(tmp_path / "h1.tsv"), str(tmp_path / "h2.tsv")])
    assert sorted(map(tuple, got.collect())) == [("1", "2"), ("3", "4"), ("a", "b")]
    assert sorted(map(tuple, delimited.read_table(spark, str(tmp_path / "h1.tsv")).collect())) == [("1", "2"), ("a", "b")]
    (tmp_path / "c.csv").write_text('"a","b"\n"x, y",2\n')
    assert [tuple(r) for r in delimited.read_table(spark, str(tmp_path / "c.csv")).collect()] == [("x, y", "2")]


def test_families(spark, tmp_path):
    (tmp_path / "f.xml").write_text(
        '<interprodb><interpro id="IPR1" type="Family" short_name="F1"><name>N</name><abstract>text</abstract><member_list><db_xref db="PFAM" dbkey="PF1" name="m"/></member_list>'
        '<parent_list><rel_ref ipr_ref="IPR0"/></parent_list><child_list><rel_ref ipr_ref="IPR2"/><rel_ref ipr_ref="IPR3"/></child_list>'
        '<class_list><classification id="GO:1" class_type="GO"><category>c</category><description>d</description></classification></class_list></interpro>'
        '<interpro id="IPR2" type="Domain" short_name="F2"><name>M</name></interpro></interprodb>'
    )
    t = structured.families(spark, str(tmp_path / "f.xml"))
    assert sorted(r["ipr_id"] for r in t["entry"].collect()) == ["IPR1", "IPR2"]
    assert [tuple(r) for r in t["member"].collect()] == [("IPR1", "PFAM", "PF1", "m")]
    assert sorted(tuple(r) for r in t["relation"].collect()) == [("IPR0", "IPR1", "parent"), ("IPR1", "IPR2", "child"), ("IPR1", "IPR3", "child")]
    assert [tuple(r) for r in t["classification"].collect()] == [("IPR1", "GO:1", "GO", "c", "d")]
    assert structured.with_links(spark, str(tmp_path / "f.xml")).count() == 1


def test_taxonomy_and_ontology(spark, tmp_path):
    (tmp_path / "names.dmp").write_text("9606\t|\tHomo sapiens\t|\t\t|\tscientific name\t|\n9606\t|\thuman\t|\t\t|\tcommon name\t|\n9606\t|\tman\t|\t\t|\tcommon name\t|\n9606\t|\thuman\t|\t\t|\tsynonym\t|\n")
    assert [tuple(r) for r in structured.taxonomy(spark, str(tmp_path / "names.dmp")).collect()] == [("9606", "Homo sapiens", ["human", "man"])]
    o = "http://purl.obolibrary.org/obo/"
    g = {"graphs": [{"nodes": [{"id": o + "GO_1", "lbl": "one", "meta": {"definition": {"val": "d"}, "basicPropertyValues": [{"pred": "http://x#hasAlternativeId", "val": "GO:9"}]}}, {"id": o + "GO_2", "lbl": "two"}], "edges": [{"sub": o + "GO_2", "pred": "part_of", "obj": o + "GO_1"}, {"sub": o + "GO_2", "pred": "is_a", "obj": o + "GO_1"}]}]}
    (tmp_path / "g.json").write_text(json.dumps(g))
    nodes, edges = structured.ontology(spark, str(tmp_path / "g.json"))
    assert sorted((r["node"], r["lbl"], r["definition"]) for r in nodes.collect()) == [("GO:1", "one", "d"), ("GO:2", "two", None)]
    assert sorted(tuple(r) for r in edges.collect()) == [("GO:2", "GO:1", "is_a"), ("GO:9", "GO:1", "hasAlternativeId")]


def test_abstracts(spark, tmp_path):
    (tmp_path / "p.xml").write_text("<A><MedlineCitation><PMID>1</PMID><Article><Abstract><AbstractText Label='AIM'>a</AbstractText><AbstractText>b</AbstractText></Abstract></Article></MedlineCitation><MedlineCitation><PMID>2</PMID><Article></Article></MedlineCitation></A>")
    asked = spark.createDataFrame([(1,), (2,), (3,)], "pmid bigint")
    got = {r["pmid"]: r["abstract"] for r in structured.abstracts(spark, str(tmp_path / "p.xml"), asked).collect()}
    assert got[1].endswith("b") and "\n\n" in got[1] and got[2] == "NO_ABSTRACT" and got[3] == "NO_ARTICLE"


def test_store(spark, tmp_path):
    f = spark.createDataFrame([(1, "a.json", '{"x": 1}'), (1, "b", "raw"), (2, "a.json", None), (None, None, None)], "pmid bigint, name string, content string")
    assert store.artifact(f, "a.json").count() == 2
    up = store.upsert(f, spark.createDataFrame([(1, "b", "new")], f.schema), ["pmid", "name"])
    assert {(r["pmid"], r["name"]): r["content"] for r in up.collect()}[1, "b"] == "new" and up.count() == 4
    assert store.without(f, ["b"]).count() == 3
    path = str(tmp_path / "t")
    for df in (f, f.limit(1)):
        store.replace_table(df, path)
    assert store.read_replaced(spark, path).count() == 1
    for n in (2, 3):
        before = store.read_replaced(spark, path)
        store.replace_table(f.limit(n), path)
        assert before.count() == n - 1 and store.read_replaced(spark, path).count() == n
    kinds = spark.sql("select 'a' as t, 1 as n, named_struct('x', 1) as s, array(1, 2) as l, cast(null as string) as z")
    got = kinds.select(*(store.as_content(kinds, c).alias(c) for c in kinds.columns)).first()
    assert tuple(got) == ("a", "1", '{"x":1}', "[1,2]", None)
    store.write_pruned(f.where("name is not null"), str(tmp_path / "p"), ["name"], ["pmid"])
    assert spark.read.parquet(str(tmp_path / "p")).where("name = 'b'").count() == 1
    calls = []

    def search(q, k):
        calls.append(q)
        return [{"id": f"{q}{i}", "name": q} for i in range(5)]

    q = spark.createDataFrame([("x",), ("x",), (None,)], "q string")
    assert [(r["query"], r["rank"], r["id"]) for r in store.remote_search(q, "q", search, k=2).orderBy("rank").collect()] == [("x", 1, "x0"), ("x", 2, "x1")]
    assert store.relation_classes(spark, 3).count() == 3 and "NONE" in store.prompt("select/strict.txt")
    folder = tmp_path / "docs" / "123"
    folder.mkdir(parents=True)
    (folder / "r.json").write_text('{"a":\n1}')
    assert [(r["pmid"], json.loads(r["content"])) for r in store.read_folders(spark, str(tmp_path / "docs"), "r.json").collect()] == [("123", {"a": 1})]
    c = store.IndexConfig("/x")
    c.save(str(tmp_path / "c.json"))
    assert store.IndexConfig.load(str(tmp_path / "c.json")) == c
