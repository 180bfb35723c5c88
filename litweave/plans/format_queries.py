"""Queries of the readers and sinks: rows of the test tables are written in a format and read back by the reader of it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from litweave.operators import retrieval
from litweave.operators.orphans import key_form
from litweave.session import new_path, table
from litweave.sources import delimited, flatfile, store, structured

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str) -> Callable:
    def register(f: Callable) -> Callable:
        QUERIES[f.__name__], ORACLE[f.__name__] = f, sql
        return f

    return register


def _written(rows: DataFrame, line: Column, header: str | None = None, footer: str | None = None, **options: str) -> str:
    """The path of a folder of text files with one line, or record, per row; a header stands first in a single file, a footer last."""
    path = new_path(rows.sparkSession, "format")
    out = rows.select(line.alias("value"))
    if header is not None:
        ends = [(n, x) for n, x in ((0, header), (2, footer)) if x is not None]
        out = out.select(F.lit(1).alias("n"), "value").unionByName(rows.sparkSession.createDataFrame(ends, "n int, value string"))
        out = out.repartition(1).sortWithinPartitions("n").select("value")
    out.write.options(**options).text(path)
    return path


def _tabbed(*columns: Column | str) -> Column:
    return F.concat_ws("\t", *columns)


@query("SELECT accession, protein_name, gene_symbol FROM uniprot_ref")
def tsv_rows(spark: SparkSession, d: str) -> DataFrame:
    path = _written(table(spark, d, "uniprot_ref"), _tabbed("accession", "protein_name", "gene_symbol"))
    return delimited.read_tsv(spark, path).select(*(F.get("cells", F.lit(i)).alias(n) for i, n in enumerate(("accession", "protein_name", "gene_symbol"))))


@query("SELECT accession, protein_name FROM uniprot_ref WHERE accession LIKE 'P%'")
def tsv_rows_safe(spark: SparkSession, d: str) -> DataFrame:
    """Compressed files, one of the paths asked for missing."""
    path = _written(table(spark, d, "uniprot_ref").where("accession like 'P%'"), _tabbed("accession", "protein_name"), compression="gzip")
    rows = delimited.read_tsv(spark, path, safe=True).unionByName(delimited.read_tsv(spark, path + "-missing", safe=True))
    return rows.select(F.get("cells", F.lit(0)).alias("accession"), F.get("cells", F.lit(1)).alias("protein_name"))


@query("SELECT CAST(o_orderkey AS INTEGER) AS order_key, CAST(trunc(CAST(o_totalprice AS DOUBLE)) AS INTEGER) AS whole, round(CAST(o_totalprice AS DOUBLE), 2) AS price, CAST(0 AS DOUBLE) AS none FROM orders")
def tsv_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Numbers at the beginning of cells, with text behind them; 0 where there is none."""
    path = _written(table(spark, d, "orders"), _tabbed(F.concat(F.col("o_orderkey").cast("string"), F.lit(" x")), F.col("o_totalprice").cast("decimal(18,4)").cast("string"), F.lit("none")))
    c = delimited.read_tsv(spark, path).select(delimited.as_int(F.col("cells")).alias("i"), delimited.as_double(F.col("cells")).alias("d"))
    return c.select(F.get("i", F.lit(0)).alias("order_key"), F.get("i", F.lit(1)).alias("whole"), F.round(F.get("d", F.lit(1)), 2).alias("price"), F.get("d", F.lit(2)).alias("none"))


@query("SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name FROM nation UNION ALL SELECT CAST(r_regionkey AS VARCHAR), r_name FROM region")
def tsv_many(spark: SparkSession, d: str) -> DataFrame:
    paths = [_written(table(spark, d, t), _tabbed(F.col(f"{t[0]}_{t}key").cast("string"), f"{t[0]}_name"), "#id\tname") for t in ("nation", "region")]
    return delimited.read_many(spark, [*paths, paths[0] + "-missing"])


@query("SELECT go_id, name, namespace FROM go_ref")
def table_with_header(spark: SparkSession, d: str) -> DataFrame:
    path = _written(table(spark, d, "go_ref"), _tabbed("go_id", "name", "namespace"), "#go_id\tname\tnamespace", compression="gzip")
    return delimited.read_table(spark, path)


@query("SELECT p_partkey AS part_key, p_name FROM (SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name FROM part)")
def table_with_commas(spark: SparkSession, d: str) -> DataFrame:
    line = F.concat(F.col("p_partkey").cast("string"), F.lit(',"'), F.col("p_name"), F.lit('"'))
    return delimited.read_table(spark, _written(table(spark, d, "part"), line, '"part_key","p_name"'))


def _records(spark: SparkSession, d: str) -> str:
    """Entries of uniprot_ref as records of a flat file: two accessions each, a feature with a note, one without a range, references, a sequence."""
    letters = F.regexp_replace(F.upper("protein_name"), "[^A-Z]", "")
    size = F.length(letters).cast("string")
    text = F.concat_ws(
        "\n",
        F.concat(F.lit("ID   "), "gene_symbol"), F.concat(F.lit("AC   "), "accession", F.lit("; X"), "accession", F.lit(";")),
        F.concat(F.lit("FT   DOMAIN          1.."), size), F.concat(F.lit('FT                   /note="'), "gene_symbol", F.lit('"')),
        F.lit("FT   ACT_SITE        5"), F.lit('FT                   /note="lost"'),
        F.concat(F.lit("FT   REGION          2.."), size), F.lit('FT                   /evidence="ECO:1"'),
        F.concat(F.lit("DR   Organism; "), F.translate("organism", ";", ","), F.lit("; "), "organism_common", F.lit(".")),
        F.concat(F.lit("SQ   SEQUENCE   "), size, F.lit(" AA;  "), size, F.lit("0 MW;  ABCDEF0123456789 CRC64;")), F.concat(F.lit("     "), letters),
    )
    return _written(table(spark, d, "uniprot_ref"), text, lineSep="\n//\n")


_SIZE = "CAST(length(regexp_replace(upper(protein_name), '[^A-Z]', '', 'g')) AS INTEGER)"


@query(f"""SELECT accession, 'DOMAIN' AS feature_type, 1 AS start_pos, {_SIZE} AS end_pos, gene_symbol AS note, '' AS evidence FROM uniprot_ref
UNION ALL SELECT accession, 'REGION', 2, {_SIZE}, '', 'ECO:1' FROM uniprot_ref""")
def flat_features(spark: SparkSession, d: str) -> DataFrame:
    return flatfile.features(spark, _records(spark, d))


@query("""SELECT accession, 'Organism' AS db_name, organism AS db_id, organism_common AS description, '' AS evidence FROM uniprot_ref
UNION ALL SELECT 'X' || accession, 'Organism', organism, organism_common, '' FROM uniprot_ref""")
def flat_references(spark: SparkSession, d: str) -> DataFrame:
    return flatfile.cross_references(spark, _records(spark, d))


@query(f"SELECT accession, {_SIZE} AS length, {_SIZE} * 10 AS mol_weight, 'ABCDEF0123456789' AS crc64, regexp_replace(upper(protein_name), '[^A-Z]', '', 'g') AS sequence FROM uniprot_ref")
def flat_sequences(spark: SparkSession, d: str) -> DataFrame:
    return flatfile.sequences(spark, _records(spark, d))


def _escaped(c: str) -> Column:
    return F.replace(F.replace(F.replace(F.trim(c), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit('"'), F.lit("&quot;"))


_FAMILIES = "WITH f AS (SELECT upper(trim(ipr_id)) AS ipr_id, type, trim(short_name) AS short_name, trim(name) AS name FROM entry_table WHERE trim(ipr_id) <> '' AND trim(short_name) <> '' AND trim(name) <> '' AND type IS NOT NULL) "


def _families(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    rows = table(spark, d, "entry_table").where("trim(ipr_id) <> '' and trim(short_name) <> '' and trim(name) <> '' and type is not null")
    text = F.concat(
        F.lit('<interpro id="'), F.upper(_escaped("ipr_id")), F.lit('" type="'), _escaped("type"), F.lit('" short_name="'), _escaped("short_name"), F.lit('"><name>'), _escaped("name"),
        F.lit('</name><member_list><db_xref db="PFAM" dbkey="'), _escaped("short_name"), F.lit('" name="m"/></member_list><parent_list><rel_ref ipr_ref="TOP"/></parent_list></interpro>'),
    )
    return structured.families(spark, _written(rows, text, "<interprodb>", "</interprodb>"))


@query(_FAMILIES + "SELECT ipr_id, trim(type) AS type, short_name, name FROM f")
def family_entries(spark: SparkSession, d: str) -> DataFrame:
    return _families(spark, d)["entry"].select("ipr_id", "type", "short_name", "name")


@query(_FAMILIES + "SELECT ipr_id, 'PFAM' AS db, short_name AS dbkey, 'm' AS name FROM f")
def family_members(spark: SparkSession, d: str) -> DataFrame:
    return _families(spark, d)["member"]


@query(_FAMILIES + "SELECT 'TOP' AS parent, ipr_id AS child, 'parent' AS type FROM f")
def family_links(spark: SparkSession, d: str) -> DataFrame:
    return _families(spark, d)["relation"]


@query("SELECT organism AS id, organism AS label, organism_common AS synonyms FROM uniprot_ref GROUP BY 1, 2, 3")
def taxonomy_dump(spark: SparkSession, d: str) -> DataFrame:
    names = table(spark, d, "uniprot_ref").select("organism", "organism_common").distinct()
    lines = names.select("organism", F.inline(F.array(F.struct(F.col("organism").alias("n"), F.lit("scientific name").alias("k")), F.struct(F.col("organism_common").alias("n"), F.lit("common name").alias("k")))))
    path = _written(lines, F.concat_ws("\t|\t", "organism", "n", F.lit(""), F.concat("k", F.lit("\t|"))))
    return structured.taxonomy(spark, path).select("id", "label", F.array_join("synonyms", "|").alias("synonyms"))


@query("SELECT go_id AS node, name AS lbl, namespace AS definition FROM go_ref")
def graph_nodes(spark: SparkSession, d: str) -> DataFrame:
    address = F.concat(F.lit("http://purl.obolibrary.org/obo/"), F.translate("go_id", ":", "_"))
    node = F.struct(address.alias("id"), F.col("name").alias("lbl"), F.struct(F.struct(F.col("namespace").alias("val")).alias("definition")).alias("meta"))
    whole = table(spark, d, "go_ref").groupBy().agg(F.to_json(F.struct(F.array(F.struct(F.collect_list(node).alias("nodes"))).alias("graphs"))).alias("j"))
    return structured.ontology(spark, _written(whole, F.col("j")))[0].select("node", "lbl", "definition")


@query("SELECT pmid, CASE WHEN trim(abstract) IN ('', 'NO_ABSTRACT', 'NO_ARTICLE') OR abstract IS NULL THEN 'NO_ABSTRACT' ELSE 'seen' END AS abstract FROM (SELECT pmid, max(abstract) AS abstract FROM pubmed_abs GROUP BY 1)")
def article_texts(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "pubmed_abs").groupBy("pmid").agg(F.max("abstract").alias("abstract"))
    empty = F.col("abstract").isNull() | F.trim("abstract").isin("", "NO_ABSTRACT", "NO_ARTICLE")
    body = F.when(empty, F.lit("<Article></Article>")).otherwise(F.lit("<Article><Abstract><AbstractText>seen</AbstractText></Abstract></Article>"))
    path = _written(rows, F.concat(F.lit("<MedlineCitation><PMID>"), F.col("pmid").cast("string"), F.lit("</PMID>"), body, F.lit("</MedlineCitation>")), "<Set>", "</Set>")
    return structured.abstracts(spark, path, rows.select("pmid"))


@query("SELECT go_id, CASE WHEN name LIKE 'positive%' THEN 'new' ELSE namespace END AS namespace FROM go_ref")
def upsert_rows(spark: SparkSession, d: str) -> DataFrame:
    old = table(spark, d, "go_ref").select("go_id", "namespace", "name")
    return store.upsert(old, old.where(F.col("name").startswith("positive")).withColumn("namespace", F.lit("new")), ["go_id"]).select("go_id", "namespace")


@query("SELECT pmid, name, content FROM files WHERE name IS NULL OR name NOT IN ('qw_go.json')")
def delete_by_name(spark: SparkSession, d: str) -> DataFrame:
    return store.without(table(spark, d, "files"), ["qw_go.json"]).select("pmid", "name", "content")


@query("SELECT r_regionkey, r_name FROM region")
def replaced_table(spark: SparkSession, d: str) -> DataFrame:
    path = new_path(spark, "replaced")
    for df in (table(spark, d, "region").limit(2), table(spark, d, "region")):
        store.replace_table(df.select("r_regionkey", "r_name"), path)
    return store.read_replaced(spark, path)


@query("SELECT uniprot_id, db_id FROM uniprot_idmapping WHERE db_name = 'GeneID'")
def pruned_layout(spark: SparkSession, d: str) -> DataFrame:
    """One value of the column that the written table is laid out by."""
    path = new_path(spark, "pruned")
    store.write_pruned(table(spark, d, "uniprot_idmapping").where("db_name is not null").select("uniprot_id", "db_id", "db_name"), path, ["db_name"], ["uniprot_id"])
    return spark.read.parquet(path).where("db_name = 'GeneID'").select("uniprot_id", "db_id")


@query(r"""SELECT CAST(pmid AS VARCHAR) AS pmid, regexp_replace(abstract, '[\r\n\t]', ' ', 'g') AS content FROM pubmed_abs WHERE pmid IS NOT NULL AND trim(abstract) <> '' AND NOT contains(abstract, chr(92)) AND NOT contains(abstract, chr(34))""")
def abstracts_sink(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "pubmed_abs").where("pmid is not null and trim(abstract) <> ''").where(~F.col("abstract").contains("\\") & ~F.col("abstract").contains('"'))
    path = new_path(spark, "sink")
    store.write_abstracts(rows, path)
    return spark.read.csv(path, sep="\t", header=True, quote="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


@query("SELECT go_id AS id, name AS label, CASE WHEN len(synonyms) > 0 THEN name || '; Synonyms: ' || array_to_string(synonyms, '; ') ELSE name END AS text_all FROM go_ref")
def index_build(spark: SparkSession, d: str) -> DataFrame:
    path = new_path(spark, "index")
    retrieval.build_index(table(spark, d, "go_ref"), "go_id", "name", retrieval.index_text(F.col("name"), F.col("synonyms")), path)
    return spark.read.parquet(path).select("id", "label", "text_all")


@query("SELECT DISTINCT upper(trim(ipr_id)) AS ipr_id FROM member_table WHERE trim(ipr_id) <> ''")
def bucketed_keys(spark: SparkSession, d: str) -> DataFrame:
    """Distinct keys from a table laid out by them, so without another shuffle."""
    rows = table(spark, d, "member_table").select(key_form("ipr_id").alias("ipr_id")).dropna()
    name = "litweave_" + new_path(spark, "b")[-32:]
    store.write_bucketed(rows, name, "ipr_id", 4)
    return spark.table(name).distinct()
