"""Queries for the relational, matching, retrieval, graph and dataflow operators, each with the SQL that must agree."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litweave.functions import text as T
from litweave.operators import graph, matching, metrics, models, relational, relations, retrieval, stages
from litweave.operators.orphans import base_accession, key_form
from litweave.plans import nested_sql
from litweave.session import cut, new_path, table
from litweave.sources import store
from litweave.streaming import queues

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def register(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register


# --- enrichment -----------------------------------------------------------------------------------------------------------

# The entry types that count as annotations of a protein.
TYPES = ["Family", "Domain", "Homologous_superfamily"]

_ID = "nullif(upper(trim({0})), '')"
_MAPPED = f"""mapped AS (
  SELECT regexp_replace({_ID.format("uniprot_id")}, '-[0-9]+$', '') AS uniprot_id, db_name, {_ID.format("db_id")} AS db_id
  FROM uniprot_idmapping WHERE {_ID.format("uniprot_id")} IS NOT NULL AND {_ID.format("db_id")} IS NOT NULL)"""
_GENES = "genes AS (SELECT DISTINCT db_id AS gene_id, uniprot_id FROM mapped WHERE db_name = 'GeneID')"
_IPR = f"""ipr AS (
  SELECT DISTINCT m.uniprot_id, m.db_id AS ipr_id FROM mapped m
  WHERE m.db_name = 'InterPro' AND m.uniprot_id IN (SELECT uniprot_id FROM genes)
    AND m.db_id IN (SELECT {_ID.format("ipr_id")} FROM entry_table WHERE type IN ('Family', 'Domain', 'Homologous_superfamily'))
    AND m.db_id NOT IN (SELECT {_ID.format("child")} FROM relation_table WHERE {_ID.format("child")} IS NOT NULL))"""


def _mapped(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "uniprot_idmapping")
    return rows.select(base_accession(key_form("uniprot_id")).alias("uniprot_id"), "db_name", key_form("db_id").alias("db_id")).dropna(subset=["uniprot_id", "db_id"])


def _genes(spark: SparkSession, d: str) -> DataFrame:
    return _mapped(spark, d).where("db_name = 'GeneID'").select(F.col("db_id").alias("gene_id"), "uniprot_id").distinct()


def _links(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "relation_table")
    return rows.select(key_form("parent").alias("parent"), key_form("child").alias("child"))


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    """The rows of genes and families, once each, written once for the plans that need them several times: one scan, one pass of key forms."""
    return cut(_mapped(spark, d).where(F.col("db_name").isin("GeneID", "InterPro")).distinct())


def _genes_of(pairs: DataFrame) -> DataFrame:
    return pairs.where("db_name = 'GeneID'").select(F.col("db_id").alias("gene_id"), "uniprot_id")


def _interpro(spark: SparkSession, d: str, pairs: DataFrame | None = None) -> DataFrame:
    pairs = _pairs(spark, d) if pairs is None else pairs
    rows = pairs.where("db_name = 'InterPro'").select("uniprot_id", F.col("db_id").alias("ipr_id"))
    kept = table(spark, d, "entry_table").where(F.col("type").isin(TYPES)).select(key_form("ipr_id").alias("ipr_id"))
    rows = relational.without_children(relational.rows_with_ids(rows, "ipr_id", kept, "ipr_id"), "ipr_id", _links(spark, d), "child")
    return relational.rows_with_ids(rows, "uniprot_id", _genes_of(pairs), "uniprot_id")


@query(f"WITH {_MAPPED}, {_GENES} SELECT gene_id, uniprot_id FROM genes")
def gene_to_protein(spark: SparkSession, d: str) -> DataFrame:
    return _genes(spark, d)


@query(f"""WITH {_MAPPED}, {_GENES}
SELECT g.gene_id, g.uniprot_id, r.gene_symbol, r.organism FROM genes g JOIN uniprot_ref r ON r.accession = g.uniprot_id""")
def map_inner_multiply(spark: SparkSession, d: str) -> DataFrame:
    names = table(spark, d, "uniprot_ref").select(F.col("accession").alias("uniprot_id"), "gene_symbol", "organism")
    return relational.map_ids(_genes(spark, d), names, "uniprot_id").select("gene_id", "uniprot_id", "gene_symbol", "organism")


@query(f"WITH {_MAPPED}, {_GENES}, {_IPR} SELECT uniprot_id, ipr_id FROM ipr")
def protein_interpro_terms(spark: SparkSession, d: str) -> DataFrame:
    return _interpro(spark, d)


@query(f"""WITH {_MAPPED}, {_GENES}
SELECT uniprot_id, db_name, db_id FROM mapped WHERE db_name = 'PDB' AND uniprot_id IN (SELECT uniprot_id FROM genes)
UNION ALL SELECT uniprot_id, db_name, db_id FROM mapped WHERE db_name = 'RefSeq' AND uniprot_id IN (SELECT uniprot_id FROM genes)""")
def enrich_union_semi(spark: SparkSession, d: str) -> DataFrame:
    rows = _mapped(spark, d).where(F.col("db_name").isin("PDB", "RefSeq"))  # both branches in one scan and one join
    return relational.rows_with_ids(rows, "uniprot_id", _genes(spark, d), "uniprot_id").select("uniprot_id", "db_name", "db_id")


@query(f"""WITH {_MAPPED} SELECT DISTINCT m.uniprot_id, m.db_id AS go_id FROM mapped m
WHERE m.db_name = 'GO' AND m.uniprot_id IN (SELECT accession FROM uniprot_ref) AND m.db_id IN (SELECT go_id FROM go_ref)""")
def protein_go_terms(spark: SparkSession, d: str) -> DataFrame:
    rows = _mapped(spark, d).where("db_name = 'GO'").select("uniprot_id", F.col("db_id").alias("go_id"))
    rows = relational.rows_with_ids(rows, "uniprot_id", table(spark, d, "uniprot_ref"), "accession")
    return relational.rows_with_ids(rows, "go_id", table(spark, d, "go_ref"), "go_id").select("uniprot_id", "go_id").distinct()


_BEST = f"""WITH {_MAPPED}, {_GENES}, {_IPR},
n AS (SELECT uniprot_id, count(DISTINCT ipr_id) AS ipr_count FROM ipr GROUP BY 1),
c AS (SELECT g.gene_id, g.uniprot_id, coalesce(n.ipr_count, 0) AS ipr_count FROM genes g LEFT JOIN n ON n.uniprot_id = g.uniprot_id),
best AS (SELECT gene_id, uniprot_id, ipr_count FROM (SELECT *, row_number() OVER (PARTITION BY gene_id
  ORDER BY CASE WHEN uniprot_id LIKE 'P%' THEN 0 ELSE 1 END, ipr_count DESC, uniprot_id) AS rn FROM c) WHERE rn = 1)"""


def _best_protein(pairs: DataFrame, terms: DataFrame) -> DataFrame:
    n = terms.groupBy("uniprot_id").agg(F.count("*").alias("ipr_count"))  # each protein and term stands once
    c = relational.filled_count(_genes_of(pairs), n, "uniprot_id", "ipr_count").select("gene_id", "uniprot_id", "ipr_count")
    return relational.best_per_key(c, ["gene_id"], ~F.col("uniprot_id").startswith("P"), -F.col("ipr_count"), F.col("uniprot_id"))


@query(_BEST + " SELECT gene_id, uniprot_id, ipr_count FROM best")
def best_protein_per_gene(spark: SparkSession, d: str) -> DataFrame:
    pairs = _pairs(spark, d)
    return _best_protein(pairs, _interpro(spark, d, pairs))


@query(_BEST + " SELECT b.gene_id, b.uniprot_id, i.ipr_id FROM best b JOIN ipr i ON i.uniprot_id = b.uniprot_id")
def best_protein_with_terms(spark: SparkSession, d: str) -> DataFrame:
    pairs = _pairs(spark, d)
    terms = cut(_interpro(spark, d, pairs))
    return _best_protein(pairs, terms).join(terms, "uniprot_id").select("gene_id", "uniprot_id", "ipr_id")


@query("""SELECT l_partkey, l_suppkey, n_rows FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY CASE WHEN first_flag = 'N' THEN 0 ELSE 1 END, n_rows DESC, l_suppkey) AS rn
FROM (SELECT l_partkey, l_suppkey, count(*) AS n_rows, max(l_returnflag) AS last_flag, min(l_returnflag) AS first_flag FROM lineitem GROUP BY 1, 2)) WHERE rn = 1""")
def best_row_per_key(spark: SparkSession, d: str) -> DataFrame:
    per = table(spark, d, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.count("*").alias("n_rows"), F.min("l_returnflag").alias("first_flag"))
    best = relational.best_per_key(per, ["l_partkey"], F.col("first_flag") != "N", -F.col("n_rows"), F.col("l_suppkey"))
    return best.select("l_partkey", "l_suppkey", "n_rows")


@query(f"""WITH {_MAPPED}, {_GENES}, p AS (SELECT DISTINCT uniprot_id FROM mapped)
SELECT count(*) AS total, CAST(sum(CASE WHEN uniprot_id IN (SELECT uniprot_id FROM genes) THEN 1 ELSE 0 END) AS BIGINT) AS mapped,
  CAST(sum(CASE WHEN uniprot_id IN (SELECT uniprot_id FROM genes) THEN 0 ELSE 1 END) AS BIGINT) AS unmapped FROM p""")
def coverage_counts(spark: SparkSession, d: str) -> DataFrame:
    m = _mapped(spark, d).groupBy("uniprot_id").agg(F.max((F.col("db_name") == "GeneID")).alias("gene"))
    return m.agg(F.count("*").alias("total"), F.count_if(F.coalesce("gene", F.lit(False))).alias("mapped"), F.count_if(~F.coalesce("gene", F.lit(False))).alias("unmapped"))


@query("SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1")
def first_per_group(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return relational.best_per_key(o, ["o_custkey"], F.col("o_orderdate"), F.col("o_orderkey")).select("o_custkey", "o_orderkey")


@query("SELECT ipr_id, short_name FROM entry_table WHERE type = 'Domain'")
def filter_equality(spark: SparkSession, d: str) -> DataFrame:
    return store.look_up(table(spark, d, "entry_table"), "type", "Domain").select("ipr_id", "short_name")


@query("SELECT member_id, ipr_id, db, dbkey FROM member_table WHERE ipr_id IN (SELECT ipr_id FROM entry_table WHERE retired_at IS NOT NULL)")
def filter_in_list(spark: SparkSession, d: str) -> DataFrame:
    ids = table(spark, d, "entry_table").where("retired_at is not null")
    return relational.rows_with_ids(table(spark, d, "member_table"), "ipr_id", ids, "ipr_id").select("member_id", "ipr_id", "db", "dbkey")


@query(f"SELECT DISTINCT {_ID.format('ipr_id')} AS ipr_id FROM entry_table WHERE type IN ('Family', 'Domain', 'Homologous_superfamily') AND {_ID.format('ipr_id')} NOT IN (SELECT {_ID.format('child')} FROM relation_table)")
def semi_type_anti_child(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "entry_table").where(F.col("type").isin(TYPES)).select(key_form("ipr_id").alias("ipr_id")).distinct()
    return relational.without_children(rows, "ipr_id", _links(spark, d), "child")


@query("SELECT c.c_custkey, coalesce(n.n_orders, 0) AS n_orders FROM customer c LEFT JOIN (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY 1) n ON n.o_custkey = c.c_custkey")
def outer_fill(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n_orders"))
    return relational.filled_count(table(spark, d, "customer").select("c_custkey"), n, "c_custkey", "n_orders")


@query("SELECT go_id, name FROM go_ref WHERE go_id LIKE 'GO:%' AND contains(lower(name), 'binding') AND (contains(lower(name), 'function') OR contains(lower(namespace), 'function')) ORDER BY go_id")
def keyword_and_search(spark: SparkSession, d: str) -> DataFrame:
    rows = relational.keyword_search(table(spark, d, "go_ref"), ["binding", "function"], ["name", "namespace"])
    return rows.where(F.col("go_id").startswith("GO:")).select("go_id", "name").orderBy("go_id")


@query("SELECT gene, max(value) AS value FROM (SELECT gene_symbol AS gene, accession AS value FROM uniprot_ref) GROUP BY gene")
def dictionary_last_wins(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "uniprot_ref").select(F.col("gene_symbol").alias("gene"), F.col("accession").alias("value"))
    return relational.last_wins(rows, ["gene"], "value", F.col("value"))


# --- lookups on mentions ---------------------------------------------------------------------------------------------------

_ENTRIES = """e AS (SELECT gene_symbol AS name, organism AS species, min(accession) AS accession FROM uniprot_ref GROUP BY 1, 2),
sole AS (SELECT name, min(accession) AS accession FROM e GROUP BY 1 HAVING count(DISTINCT species) = 1)"""


@query(f"""WITH {_ENTRIES} SELECT m.match_id, coalesce(e.accession, o.accession) AS accession FROM uniprot_match m
LEFT JOIN e ON e.name = upper(trim(m.original_name)) AND e.species = trim(m.species) LEFT JOIN sole o ON o.name = upper(trim(m.original_name))""")
def fallback_lookup(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "uniprot_ref").groupBy(F.col("gene_symbol").alias("name"), F.col("organism").alias("species")).agg(F.min("accession").alias("accession"))
    rows = table(spark, d, "uniprot_match").select("match_id", F.upper(F.trim("original_name")).alias("name"), F.trim("species").alias("species"))
    return relational.fallback_lookup(rows, e, "name", "species", "accession").select("match_id", "accession")


@query("""SELECT m.match_id, CASE WHEN r.s IS NOT NULL THEN 'symbol' ELSE m.entity_type END AS entity_type FROM uniprot_match m
LEFT JOIN (SELECT DISTINCT gene_symbol AS s FROM uniprot_ref) r ON r.s = m.original_name""")
def retype_by_success(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "uniprot_ref").select(F.col("gene_symbol").alias("original_name"))
    return relational.retype(table(spark, d, "uniprot_match"), s, ["original_name"], "entity_type", "symbol").select("match_id", "entity_type")


@query("""WITH a AS (SELECT name, min(description) AS description FROM go_mapping WHERE name IS NOT NULL AND llm_best_match IS NULL GROUP BY 1),
b AS (SELECT name, min(description) AS description FROM go_mapping WHERE name IS NOT NULL AND llm_best_match IS NOT NULL GROUP BY 1)
SELECT coalesce(a.name, b.name) AS name, coalesce(a.description, b.description) AS description FROM a FULL JOIN b ON a.name = b.name""")
def merge_first_wins(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "go_mapping").where("name is not null")
    a, b = (g.where(c).groupBy("name").agg(F.min("description").alias("description")) for c in ("llm_best_match is null", "llm_best_match is not null"))
    return relational.merge_first_wins(a, b, ["name"], ["description"])


@query("SELECT mapping_id, name FROM go_mapping WHERE llm_best_match IS NULL OR upper(trim(llm_best_match)) IN ('', 'NONE')")
def unresolved_filter(spark: SparkSession, d: str) -> DataFrame:
    best = F.upper(F.trim("llm_best_match"))
    return table(spark, d, "go_mapping").where(best.isNull() | best.isin("", "NONE")).select("mapping_id", "name")


@query("""SELECT name, description FROM (SELECT name, coalesce(description, '') AS description, row_number() OVER (PARTITION BY name
ORDER BY length(coalesce(description, '')) DESC, mapping_id) AS rn FROM go_mapping) WHERE rn = 1 ORDER BY name""")
def longest_desc_per_name(spark: SparkSession, d: str) -> DataFrame:
    rows = relational.longest_per_key(table(spark, d, "go_mapping"), "name", "description", "mapping_id")
    return rows.select("name", F.coalesce("description", F.lit("")).alias("description")).orderBy("name")


@query(r"""WITH s AS (SELECT accession, unnest(string_split(protein_name, ' ')) AS k FROM uniprot_ref)
SELECT lower(trim(k)) AS key, accession AS value FROM s WHERE trim(k) <> '' AND lower(trim(k)) <> 'nan'""")
def multimap_build(spark: SparkSession, d: str) -> DataFrame:
    return relational.multimap(F.col("protein_name"), F.col("accession"), table(spark, d, "uniprot_ref"), [" "])


@query("SELECT organism, array_to_string(list_sort(list(DISTINCT gene_symbol)), '|') AS names FROM uniprot_ref GROUP BY 1")
def names_per_key(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "uniprot_ref").groupBy("organism").agg(F.array_join(F.array_sort(F.collect_set("gene_symbol")), "|").alias("names"))


@query(" UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS n FROM {t}" for t in ("entry_table", "member_table", "relation_table", "uniprot_idmapping")))
def union_of_counts(spark: SparkSession, d: str) -> DataFrame:
    parts = [table(spark, d, t).agg(F.count("*").alias("n")).select(F.lit(t).alias("name"), "n") for t in ("entry_table", "member_table", "relation_table", "uniprot_idmapping")]
    return relational.union_branches(*parts)


# --- text -------------------------------------------------------------------------------------------------------------------

_NORMAL = (
    r"regexp_replace(regexp_replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower({0}), "
    r"'(alpha|beta|gamma)(\s|$)', '\2', 'g'), '(alpha|beta|gamma)(\s|$)', '\2', 'g'), '-[0-9]+(\s|$)', '\1', 'g'), '-[0-9]+(\s|$)', '\1', 'g'), "
    r"'([0-9]+)[a-z](\s|$)', '\1\2', 'g'), '-[a-z](\s|$)', '\1', 'g'), '-', ' '), '_', ' '), '\s+', ' ', 'g'), '^ +| +$', '', 'g')"
)


@query("SELECT DISTINCT protein_name, " + _NORMAL.format("protein_name") + " AS normal FROM uniprot_ref")
def normalize_name(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "uniprot_ref").select("protein_name", T.normal_name(F.col("protein_name")).alias("normal")).distinct()


@query(r"SELECT match_id, trim(regexp_replace(regexp_replace(original_name, '\([^)]*\)', '', 'g'), '\[[^\]]*\]', '', 'g'), ' ') AS cleaned FROM uniprot_match")
def clean_query(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "uniprot_match").select("match_id", T.without_brackets(F.col("original_name")).alias("cleaned"))


@query("SELECT mapping_id, concat_ws(', ', nullif(trim(name), ''), nullif(trim(description), '')) AS search FROM go_mapping")
def search_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "go_mapping").select("mapping_id", T.search_text(F.col("name"), F.col("description")).alias("search"))


@query("""SELECT pmid, CASE WHEN rtrim(coalesce(abstract, '')) IN ('NO_ABSTRACT', 'NO_ARTICLE', '') THEN false ELSE length(rtrim(abstract)) < 50 END AS too_short,
CASE WHEN rtrim(coalesce(abstract, '')) IN ('NO_ABSTRACT', 'NO_ARTICLE', '') THEN false ELSE NOT rtrim(abstract) LIKE '%.' END AS no_final_period FROM pubmed_abs""")
def abstract_completeness(spark: SparkSession, d: str) -> DataFrame:
    return metrics.completeness(table(spark, d, "pubmed_abs"), "abstract").select("pmid", "too_short", "no_final_period")


@query(r"SELECT mapping_id, trim(regexp_replace(llm_best_match, '(?s)^(.*?)<think>.*?</think>', '\1'), ' ') AS answer FROM go_mapping")
def strip_think(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "go_mapping").select("mapping_id", T.without_thinking(F.col("llm_best_match")).alias("answer"))


@query(r"""SELECT pmid, CASE WHEN length(t) > 400 THEN rtrim(left(t, 400)) || '...' ELSE t END AS short
FROM (SELECT pmid, trim(regexp_replace(abstract, '[ \t\n\f\r\v]+', ' ', 'g')) AS t FROM pubmed_abs)""")
def squeeze_truncate(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pubmed_abs").select("pmid", T.squeeze(F.col("abstract"), 400).alias("short"))


@query("""SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def json_props(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", "event_type", F.get_json_object("props", "$.k").try_cast("bigint").alias("k"))


@query(r"""SELECT doc_id, unnest(list_filter(regexp_split_to_array(trim(regexp_replace(text, '([.!?])[ \t\n\f\r\v]+', '\1' || chr(1), 'g')), chr(1)), lambda x: x <> '')) AS part FROM (SELECT doc_id, trim(text) AS text FROM documents WHERE text IS NOT NULL)""")
def sentence_split_plain(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.explode(T.simple_sentences(F.col("text"))).alias("part"))


@query()
def json_salvage(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "merged").select("merged_id", T.json_array("relations").alias("relations"))


@query()
def deep_merge(spark: SparkSession, d: str) -> DataFrame:
    """Of each pmid and name, all files merged in the order of their ids."""
    return relational.folded_json(table(spark, d, "files"), ["pmid", "name"], "file_id", "content")


# --- matching -----------------------------------------------------------------------------------------------------------------

_REF = "ref AS (SELECT " + _NORMAL.format("protein_name") + " AS name, accession AS value FROM uniprot_ref)"
_ASK = "q AS (SELECT DISTINCT original_name AS query, " + _NORMAL.format("original_name") + " AS name FROM uniprot_match WHERE original_name IS NOT NULL)"
_EXACT = "exact AS (SELECT q.query, ref.value FROM q JOIN ref ON ref.name = q.name)"
_LEFT1 = "left1 AS (SELECT * FROM q WHERE query NOT IN (SELECT query FROM exact))"


def _runs(source: str, keep: str) -> str:
    return f"""(SELECT {keep}, j - i + 1 AS n, array_to_string(w[i:j], ' ') AS phrase FROM (SELECT {keep}, w, i, unnest(range(i, len(w) + 1)) AS j
FROM (SELECT {keep}, w, unnest(range(1, len(w) + 1)) AS i FROM (SELECT {keep}, string_split(name, ' ') AS w FROM {source}))))"""


_MATCH = f"""WITH {_REF}, {_ASK}, {_EXACT}, {_LEFT1},
own AS {_runs("left1", "query")},
hit AS (SELECT o.query, o.n, ref.value FROM own o JOIN ref ON ref.name = o.phrase),
ngram AS (SELECT h.query, h.value FROM hit h JOIN (SELECT query, max(n) AS n FROM hit GROUP BY 1) m ON m.query = h.query AND m.n = h.n),
left2 AS (SELECT * FROM left1 WHERE query NOT IN (SELECT query FROM ngram)),
parts AS {_runs("ref", "value")},
part AS (SELECT l.query, p.value FROM left2 l JOIN parts p ON p.phrase = l.query),
left3 AS (SELECT * FROM left2 WHERE query NOT IN (SELECT query FROM part)),
pieces AS (SELECT o.query, p.value FROM {_runs("left3", "query")} o JOIN parts p ON p.phrase = o.phrase),
left4 AS (SELECT * FROM left3 WHERE query NOT IN (SELECT query FROM pieces)),
pre AS (SELECT DISTINCT substr(name, 1, n) AS affix FROM ref, (SELECT unnest(range(1, (SELECT max(length(name)) + 1 FROM ref))) AS n) r WHERE n <= length(name)),
suf AS (SELECT DISTINCT right(name, n) AS affix FROM ref, (SELECT unnest(range(1, (SELECT max(length(name)) + 1 FROM ref))) AS n) r WHERE n <= length(name)),
bpre AS (SELECT query, max_by(affix, length(affix)) AS affix FROM (SELECT l.query, substr(l.name, 1, n) AS affix FROM left4 l, (SELECT unnest(range(1, (SELECT max(length(name)) + 1 FROM ref))) AS n) r WHERE n <= length(l.name)) WHERE affix IN (SELECT affix FROM pre) GROUP BY 1),
bsuf AS (SELECT query, max_by(affix, length(affix)) AS affix FROM (SELECT l.query, right(l.name, n) AS affix FROM left4 l, (SELECT unnest(range(1, (SELECT max(length(name)) + 1 FROM ref))) AS n) r WHERE n <= length(l.name)) WHERE affix IN (SELECT affix FROM suf) GROUP BY 1)
SELECT query, strategy, count(*) AS n_values, min(value) AS first_value, max(value) AS last_value FROM (
SELECT query, 'exact' AS strategy, value FROM exact UNION ALL SELECT query, 'ngram', value FROM ngram UNION ALL SELECT query, 'part', value FROM part
UNION ALL SELECT query, 'parts', value FROM pieces
UNION ALL SELECT b.query, 'prefix', ref.value FROM bpre b JOIN ref ON starts_with(ref.name, b.affix)
UNION ALL SELECT b.query, 'suffix', ref.value FROM bsuf b JOIN ref ON ends_with(ref.name, b.affix)) GROUP BY 1, 2"""


@query(_MATCH)
def match_all(spark: SparkSession, d: str) -> DataFrame:
    """All five strategies: per query and strategy how many values, the least and the greatest."""
    m = matching.match(table(spark, d, "uniprot_match"), "original_name", table(spark, d, "uniprot_ref"), "protein_name", "accession")
    return m.groupBy("query", "strategy").agg(F.count("*").alias("n_values"), F.min("value").alias("first_value"), F.max("value").alias("last_value"))


def _by_strategy(spark: SparkSession, d: str, *strategies: str) -> DataFrame:
    m = matching.match(table(spark, d, "uniprot_match"), "original_name", table(spark, d, "uniprot_ref"), "protein_name", "accession")
    return m.where(F.col("strategy").isin(*strategies)).select("query", "value")


_STEPS = _MATCH[: _MATCH.rindex("SELECT query, strategy, count(*)")]


@query(_STEPS + "SELECT query, value FROM ngram")
def match_ngram_longest(spark: SparkSession, d: str) -> DataFrame:
    return _by_strategy(spark, d, "ngram")


@query(_STEPS + "SELECT query, value FROM part UNION ALL SELECT query, value FROM pieces")
def match_expanded(spark: SparkSession, d: str) -> DataFrame:
    return _by_strategy(spark, d, "part", "parts")


@query(_STEPS + "SELECT b.query, ref.value FROM bpre b JOIN ref ON starts_with(ref.name, b.affix)")
def match_prefix(spark: SparkSession, d: str) -> DataFrame:
    return _by_strategy(spark, d, "prefix")


@query(_STEPS + "SELECT b.query, ref.value FROM bsuf b JOIN ref ON ends_with(ref.name, b.affix)")
def match_suffix(spark: SparkSession, d: str) -> DataFrame:
    return _by_strategy(spark, d, "suffix")


@query(f"WITH {_REF}, {_ASK}, {_EXACT} SELECT query, value FROM exact")
def match_exact(spark: SparkSession, d: str) -> DataFrame:
    ref = matching.reference_names(table(spark, d, "uniprot_ref"), "protein_name", "accession")
    q = table(spark, d, "uniprot_match").select(F.col("original_name").alias("query")).dropna().distinct()
    return q.withColumn("name", T.normal_name(F.col("query"))).join(ref, "name").select("query", "value")


# --- retrieval ------------------------------------------------------------------------------------------------------------------

_DOT = "list_sum(list_transform(range(1, len(q.embedding) + 1), lambda i: CAST(q.embedding[i] AS DOUBLE) * CAST(x.embedding[i] AS DOUBLE)))"
_KNN = f"""knn AS (SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM (
SELECT q.vec_id AS query_id, x.vec_id AS vec_id, {_DOT} AS score FROM embeddings q, embeddings x WHERE q.vec_id % 20 = 0))"""


def _asked(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding")


@query(f"WITH {_KNN} SELECT query_id, vec_id, round(score, 6) AS score FROM knn WHERE rank <= 10")
def knn_dense(spark: SparkSession, d: str) -> DataFrame:
    k = retrieval.dense_recall(_asked(spark, d), table(spark, d, "embeddings"), "query_id", "vec_id", "embedding", "embedding", 10)
    return k.select("query_id", "vec_id", F.round("score", 6).alias("score"))


_SPARSE = "w AS (SELECT vec_id, i AS token, CAST(embedding[i] AS DOUBLE) AS weight FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings) WHERE embedding[i] > 0.1)"


def _weights(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings").select("vec_id", F.posexplode("embedding").alias("token", "weight"))
    return e.where(F.col("weight") > F.lit(0.1)).select("vec_id", "token", F.col("weight").cast("double").alias("weight"))


@query(f"""WITH {_SPARSE}, s AS (SELECT q.vec_id AS query_id, x.vec_id, sum(q.weight * x.weight) AS sparse FROM w q JOIN w x ON x.token = q.token WHERE q.vec_id % 20 = 0 GROUP BY 1, 2)
SELECT query_id, vec_id, round(sparse, 6) AS sparse FROM s""")
def sparse_dot(spark: SparkSession, d: str) -> DataFrame:
    w = _weights(spark, d)
    q = w.where("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id")
    return retrieval.sparse_scores(q, w, "query_id", "vec_id").withColumn("sparse", F.round("sparse", 6))


@query(f"""WITH {_KNN}, {_SPARSE}, h AS (SELECT k.query_id, k.vec_id, k.score AS dense, coalesce(sum(q.weight * x.weight), 0) AS sparse FROM knn k
LEFT JOIN (w x JOIN w q ON q.token = x.token) ON x.vec_id = k.vec_id AND q.vec_id = k.query_id WHERE k.rank <= 50 GROUP BY 1, 2, 3),
f AS (SELECT *, 0.5 * dense / max(dense) OVER (PARTITION BY query_id) + 0.5 * sparse / CASE WHEN max(sparse) OVER (PARTITION BY query_id) = 0 THEN 1e-9 ELSE max(sparse) OVER (PARTITION BY query_id) END AS score FROM h)
SELECT query_id, vec_id, CAST(rank AS INTEGER) AS rank, round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM f) WHERE rank <= 10""")
def hybrid_search(spark: SparkSession, d: str) -> DataFrame:
    w = _weights(spark, d)
    q = w.where("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id")
    hits = retrieval.hybrid_search(_asked(spark, d), table(spark, d, "embeddings"), q, w, "query_id", "vec_id", "embedding", k=10, recall=50)
    return hits.select("query_id", "vec_id", "rank", F.round("score", 6).alias("score"))


@query(ORACLE["hybrid_search"].replace("k.rank <= 50", "k.rank <= 200"))
def hybrid_search_200(spark: SparkSession, d: str) -> DataFrame:
    """The same with the operator's own dense recall, 200, which is that of the reference; `hybrid_search` is held at 50 by its SQL."""
    w = _weights(spark, d)
    q = w.where("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id")
    hits = retrieval.hybrid_search(_asked(spark, d), table(spark, d, "embeddings"), q, w, "query_id", "vec_id", "embedding", k=10)
    return hits.select("query_id", "vec_id", "rank", F.round("score", 6).alias("score"))


@query(r"""WITH q AS (SELECT match_id, token, count(*) AS times FROM (SELECT match_id, unnest(list_filter(regexp_split_to_array(lower(trim(original_name)), '[ \t\n\f\r\v]+'), lambda x: x <> '')) AS token FROM uniprot_match WHERE match_id % 20 = 0) GROUP BY 1, 2),
dd AS (SELECT accession, unnest(list_distinct(string_split(lower(protein_name), ' '))) AS token FROM uniprot_ref),
s AS (SELECT q.match_id, dd.accession, CAST(sum(q.times) AS BIGINT) * 100 AS hundred FROM q JOIN dd ON dd.token = q.token GROUP BY 1, 2),
r AS (SELECT s.match_id, s.accession, s.hundred - len(string_split(protein_name, ' ')) AS raw FROM s JOIN uniprot_ref u ON u.accession = s.accession),
k AS (SELECT *, row_number() OVER (PARTITION BY match_id ORDER BY raw DESC, accession) AS rank FROM r)
SELECT match_id, accession, CAST(rank AS INTEGER) AS rank, round(CAST(raw AS DOUBLE) / max(raw) OVER (PARTITION BY match_id), 6) AS score FROM k WHERE rank <= 10""")
def token_search(spark: SparkSession, d: str) -> DataFrame:
    q = table(spark, d, "uniprot_match").where("match_id % 20 = 0")
    index = table(spark, d, "uniprot_ref").select(F.col("accession").alias("entry"), "accession", "protein_name")
    hits = retrieval.token_search(q, index, "match_id", "original_name", "entry", "accession", "protein_name", 10)
    return hits.select("match_id", "accession", "rank", F.round("score", 6).alias("score"))


@query(f"""WITH {_KNN}, first AS (SELECT k.query_id, min(k.rank) AS rank FROM knn k JOIN embeddings a ON a.vec_id = k.query_id JOIN embeddings b ON b.vec_id = k.vec_id
WHERE a.label = b.label AND k.query_id <> k.vec_id AND k.rank <= 30 GROUP BY 1), n AS (SELECT rank, count(*) AS n FROM first GROUP BY 1)
SELECT CAST(rank AS INTEGER) AS rank, n, round(CAST(sum(n) OVER (ORDER BY rank) AS DOUBLE) / CAST(sum(n) OVER () AS DOUBLE), 6) AS cdf FROM n""")
def rank_cdf(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    k = retrieval.dense_recall(_asked(spark, d), e, "query_id", "vec_id", "embedding", "embedding", 30)
    k = retrieval.top_k(k, ["query_id"], 30, F.col("score").desc(), F.col("vec_id")).where("query_id != vec_id")
    k = k.join(e.select("vec_id", F.col("label").alias("b")), "vec_id").join(e.select(F.col("vec_id").alias("query_id"), F.col("label").alias("a")), "query_id")
    first = k.where("a = b").groupBy("query_id").agg(F.min("rank").alias("rank"))
    return metrics.rank_cdf(first, "rank").withColumn("cdf", F.round("cdf", 6))


# --- metrics ----------------------------------------------------------------------------------------------------------------------

@query("""SELECT event_type, CAST(sum(CASE WHEN value > 50 THEN 1 ELSE 0 END) AS BIGINT) AS correct, count(*) AS total,
round(CAST(sum(CASE WHEN value > 50 THEN 1 ELSE 0 END) AS DOUBLE) / count(*), 3) AS ratio FROM events GROUP BY 1""")
def metric_rollup(spark: SparkSession, d: str) -> DataFrame:
    infos = table(spark, d, "events").select("event_type", F.coalesce((F.col("value") > 50).cast("int"), F.lit(0)).alias("correct"), F.lit(1).alias("total"))
    return metrics.roll_up(infos, ["event_type"], "correct", "total")


@query("""SELECT entity_type, count(*) FILTER (WHERE original_name IN (SELECT protein_name FROM uniprot_ref)) AS covered, count(*) AS total,
round(CAST(count(*) FILTER (WHERE original_name IN (SELECT protein_name FROM uniprot_ref)) AS DOUBLE) / count(*), 6) AS ratio FROM uniprot_match GROUP BY 1""")
def coverage_ratio(spark: SparkSession, d: str) -> DataFrame:
    known = table(spark, d, "uniprot_ref").select(F.col("protein_name").alias("original_name")).distinct().withColumn("known", F.lit(True))
    rows = table(spark, d, "uniprot_match").join(known, "original_name", "left")
    return metrics.share(rows, F.col("known"), ["entity_type"]).withColumn("ratio", F.round("ratio", 6))


@query("""SELECT count(*) FILTER (WHERE lower(trim(name)) = lower(trim(llm_best_match))) AS covered, count(*) AS total,
round(CAST(count(*) FILTER (WHERE lower(trim(name)) = lower(trim(llm_best_match))) AS DOUBLE) / count(*), 6) AS ratio FROM go_mapping""")
def agreement_rate(spark: SparkSession, d: str) -> DataFrame:
    """How often the answer repeats the name it was asked about."""
    same = F.lower(F.trim("name")) == F.lower(F.trim("llm_best_match"))
    return metrics.share(table(spark, d, "go_mapping"), same).withColumn("ratio", F.round("ratio", 6))


@query("SELECT min(value) AS least, max(value) AS most FROM events")
def weight_range(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").agg(F.min("value").alias("least"), F.max("value").alias("most"))


# --- windows and sets ----------------------------------------------------------------------------------------------------------------

@query("""SELECT event_id, used FROM (SELECT event_id, CAST(sum(length(props) + 1) OVER w AS BIGINT) AS used, row_number() OVER w AS place FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
WHERE used <= 60 AND place <= 30""")
def budgeted_prefix(spark: SparkSession, d: str) -> DataFrame:
    return relational.budgeted(table(spark, d, "events"), "user_id", "event_id", "props", 60, 30).select("event_id", "used")


@query("""SELECT event_id, coalesce(array_to_string(list(event_type) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), ' '), '') AS history FROM events""")
def running_history(spark: SparkSession, d: str) -> DataFrame:
    return relational.running_history(table(spark, d, "events"), "user_id", "event_id", "event_type").select("event_id", "history")


@query("SELECT DISTINCT pmid FROM go_mapping WHERE pmid IN (SELECT pmid FROM uniprot_match) AND pmid NOT IN (SELECT pmid FROM merged WHERE pmid IS NOT NULL)")
def set_operations(spark: SparkSession, d: str) -> DataFrame:
    a, b, c = (table(spark, d, t).select("pmid").dropna() for t in ("go_mapping", "uniprot_match", "merged"))
    return a.intersect(b).subtract(c)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5")
def top_n_sort(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(5)


@query("SELECT pmid, species FROM (SELECT pmid, trim(species) AS species, row_number() OVER (PARTITION BY pmid ORDER BY match_id) AS rn FROM uniprot_match WHERE trim(species) <> '') WHERE rn = 1")
def first_named_species(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "uniprot_match").where(F.trim("species") != "")
    return m.groupBy("pmid").agg(F.min_by(F.trim("species"), "match_id").alias("species"))


# --- nested documents ------------------------------------------------------------------------------------------------------------------

@query("""SELECT l_orderkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS INTEGER) AS pos, l_partkey FROM lineitem""")
def nested_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    items = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey"))).alias("items")
    nest = table(spark, d, "lineitem").groupBy("l_orderkey").agg(items)
    return nest.select("l_orderkey", F.posexplode("items").alias("pos", "item")).select("l_orderkey", "pos", "item.l_partkey")


@query("""SELECT a.l_orderkey, a.l_partkey AS component, b.l_partkey AS target FROM (SELECT * FROM lineitem WHERE l_returnflag = 'R') a
JOIN (SELECT * FROM lineitem WHERE l_returnflag = 'A') b ON b.l_orderkey = a.l_orderkey""")
def cross_components_targets(spark: SparkSession, d: str) -> DataFrame:
    side = lambda flag: F.collect_list(F.when(F.col("l_returnflag") == flag, F.col("l_partkey")))
    per = table(spark, d, "lineitem").groupBy("l_orderkey").agg(side("R").alias("c"), side("A").alias("t"))
    return per.withColumn("component", F.explode("c")).withColumn("target", F.explode("t")).select("l_orderkey", "component", "target")


@query(nested_sql.FLAT)
def flatten_relations(spark: SparkSession, d: str) -> DataFrame:
    return relations.flattened(table(spark, d, "merged"), "merged_id", "relations")


@query(nested_sql.FACTS)
def process_facts(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "uniprot_ref").select(F.col("gene_symbol").alias("name"), "accession")
    terms = table(spark, d, "go_ref").select("name", F.col("go_id").alias("id"))
    return relations.process_facts(flatten_relations(spark, d), a, terms)


@query(nested_sql.SPECIES)
def species_priority(spark: SparkSession, d: str) -> DataFrame:
    m = cut(relations.mentions(table(spark, d, "merged"), "merged_id", "relations"))
    return relations.with_species(m).select("doc_id", "pre", "name", "type", "species")


@query(nested_sql.COLLECTED)
def collected_entities(spark: SparkSession, d: str) -> DataFrame:
    m = relations.mentions(table(spark, d, "merged"), "merged_id", "relations")
    return relational.longest_per_key(relations.collected(m, ["gene", "protein"]).select(F.struct("doc_id", "name").alias("k"), "description"), "k", "description", "description").select("k.doc_id", "k.name", "description")


@query(nested_sql.APPLIED)
def apply_mapping_drop(spark: SparkSession, d: str) -> DataFrame:
    m = cut(relations.mentions(table(spark, d, "merged"), "merged_id", "relations"))
    go = table(spark, d, "go_ref").select(F.col("name").alias("n"), F.col("go_id").alias("best_id"), F.col("name").alias("best_name"))
    genes = table(spark, d, "uniprot_ref").groupBy(F.col("gene_symbol").alias("n")).agg(F.min("accession").alias("best_id"), F.min("protein_name").alias("best_name"))
    hits = m.select("doc_id", "name").distinct()
    best = [hits.join(t.withColumnRenamed("n", "name"), "name").select("doc_id", F.lit(o).alias("ontology"), "name", F.lit("").alias("species"), "best_id", "best_name") for o, t in (("go", go), ("gene", genes))]
    ontologies = [relations.Ontology(("GO",), "go"), relations.Ontology(("gene", "protein"), "gene", use_species=True)]
    return relations.apply_best(m, best[0].unionByName(best[1]), ontologies).select("doc_id", "pre", "name", "type", "id")


@query()
def nested_rebuild(spark: SparkSession, d: str) -> DataFrame:
    return relations.rebuilt(table(spark, d, "merged"), "merged_id", "relations")


@query(nested_sql.VALID)
def valid_filter(spark: SparkSession, d: str) -> DataFrame:
    from litweave.operators import nested

    r = nested.relations(nested.nodes(table(spark, d, "merged"), "merged_id", "relations"))
    return relations.valid_only(r).select("doc_id", "block_no", "rel_no", "name")


# --- artifacts ---------------------------------------------------------------------------------------------------------------------

@query("SELECT name, count(*) AS n FROM files GROUP BY 1")
def count_by_name(spark: SparkSession, d: str) -> DataFrame:
    return store.counted(table(spark, d, "files"))


@query("SELECT DISTINCT pmid, name FROM files ORDER BY 1, 2")
def list_artifacts(spark: SparkSession, d: str) -> DataFrame:
    return store.listed(table(spark, d, "files"))


@query("SELECT p.pmid, p.pmid IN (SELECT pmid FROM files WHERE name = 'qw_go.json' AND pmid IS NOT NULL) AS \"exists\" FROM (SELECT DISTINCT pmid FROM pubmed_abs) p")
def artifact_exists(spark: SparkSession, d: str) -> DataFrame:
    return store.has(table(spark, d, "files"), table(spark, d, "pubmed_abs").select("pmid").distinct(), "qw_go.json")


# --- graph -------------------------------------------------------------------------------------------------------------------------

_EDGES = f"e AS (SELECT DISTINCT {_ID.format('child')} AS u, {_ID.format('parent')} AS v FROM relation_table)"
_TOP = "top AS (SELECT v AS node FROM e GROUP BY v ORDER BY count(*) DESC, v LIMIT 1)"


def _edges(spark: SparkSession, d: str) -> DataFrame:
    return _links(spark, d).select(F.col("child").alias("u"), F.col("parent").alias("v"), F.lit("is_a").alias("relation")).distinct()


def _widest(spark: SparkSession, d: str) -> str:
    """The node with most children: where the graph queries start."""
    return _edges(spark, d).groupBy("v").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "v").first()["v"]


@query(f"WITH RECURSIVE {_EDGES}, {_TOP}, r AS (SELECT node FROM top UNION SELECT e.u FROM r JOIN e ON e.v = r.node) SELECT node FROM r")
def graph_ancestors(spark: SparkSession, d: str) -> DataFrame:
    return graph.graph_ancestors(_edges(spark, d), _widest(spark, d))


@query(f"WITH RECURSIVE {_EDGES}, {_TOP}, r AS (SELECT node FROM top UNION SELECT e.v FROM r JOIN e ON e.u = r.node) SELECT node FROM r")
def graph_descendants(spark: SparkSession, d: str) -> DataFrame:
    return graph.graph_descendants(_edges(spark, d), _widest(spark, d))


@query(f"WITH {_EDGES} SELECT u, v FROM e WHERE u IN (SELECT {_ID.format('ipr_id')} FROM entry_table) AND v IN (SELECT {_ID.format('ipr_id')} FROM entry_table)")
def graph_induced(spark: SparkSession, d: str) -> DataFrame:
    nodes = table(spark, d, "entry_table").select(key_form("ipr_id").alias("node"))
    return graph.induced(_edges(spark, d).select("u", "v"), nodes)


@query(f"""WITH RECURSIVE {_EDGES}, b AS (SELECT u AS x, v AS y FROM e UNION SELECT v, u FROM e), r AS (SELECT x AS node, x AS seen FROM b UNION SELECT r.node, b.y FROM r JOIN b ON b.x = r.seen)
SELECT node, min(seen) AS component FROM r GROUP BY 1""")
def graph_components(spark: SparkSession, d: str) -> DataFrame:
    return graph.components(_edges(spark, d))


@query(f"""WITH RECURSIVE {_EDGES}, b AS (SELECT u AS x, v AS y FROM e UNION SELECT v, u FROM e), r AS (SELECT x AS node, x AS seen FROM b UNION SELECT r.node, b.y FROM r JOIN b ON b.x = r.seen),
c AS (SELECT node, min(seen) AS component FROM r GROUP BY 1), m AS (SELECT {_ID.format('ipr_id')} AS node, CAST(length(dbkey) AS DOUBLE) AS w FROM member_table WHERE {_ID.format('ipr_id')} IS NOT NULL)
SELECT coalesce(c.component, m.node) AS node, round(avg(m.w), 6) AS mean_weight FROM m LEFT JOIN c ON c.node = m.node GROUP BY 1""")
def alias_mean(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "member_table").select(key_form("ipr_id").alias("node"), F.length("dbkey").cast("double").alias("w")).where("node is not null")
    return graph.alias_means(m, _edges(spark, d), "node", "w").withColumn("mean_weight", F.round("mean_weight", 6))


_TERMS = """t AS (SELECT go_id, name, CASE WHEN starts_with(name, 'positive regulation') OR starts_with(name, 'negative regulation') THEN substr(name, 10)
  WHEN starts_with(name, 'regulation of ') THEN substr(name, 15) END AS above FROM go_ref),
te AS (SELECT a.go_id AS u, b.go_id AS v FROM t a JOIN t b ON b.name = a.above)"""


def _term_edges(spark: SparkSession, d: str) -> DataFrame:
    """The terms' hierarchy as their names tell it."""
    name = F.col("name")
    signed = name.startswith("positive regulation") | name.startswith("negative regulation")
    above = F.when(signed, F.substr(name, F.lit(10))).when(name.startswith("regulation of "), F.substr(name, F.lit(15)))
    t = table(spark, d, "go_ref").select(F.col("go_id").alias("u"), "name", above.alias("above"))
    return t.select("u", F.col("above").alias("name")).join(t.select("name", F.col("u").alias("v")), "name").select("u", "v", F.lit("is_a").alias("relation"))


@query(f"""WITH RECURSIVE {_TERMS}, l AS (SELECT go_id AS node, 0 AS level FROM t UNION ALL SELECT te.u, l.level + 1 FROM l JOIN te ON te.v = l.node)
SELECT node, CAST(max(level) AS INTEGER) AS level FROM l GROUP BY 1""")
def graph_levels(spark: SparkSession, d: str) -> DataFrame:
    nodes = table(spark, d, "go_ref").select(F.col("go_id").alias("node"))
    return graph.levels(_term_edges(spark, d), nodes).select("node", F.col("level").cast("int").alias("level"))


@query(f"WITH {_TERMS} SELECT go_id FROM t WHERE go_id IN (SELECT u FROM te) OR go_id IN (SELECT v FROM te)")
def on_hierarchy(spark: SparkSession, d: str) -> DataFrame:
    nodes = table(spark, d, "go_ref").select(F.col("go_id").alias("node"))
    return graph.on_hierarchy(nodes, _term_edges(spark, d)).select(F.col("node").alias("go_id"))


@query(f"WITH RECURSIVE {_TERMS}, s AS (SELECT min(v) AS node FROM te), up AS (SELECT node FROM s UNION SELECT te.v FROM up JOIN te ON te.u = up.node), dn AS (SELECT node FROM s UNION SELECT te.u FROM dn JOIN te ON te.v = dn.node) SELECT node FROM up UNION SELECT node FROM dn")
def local_context(spark: SparkSession, d: str) -> DataFrame:
    edges = _term_edges(spark, d)
    nodes = table(spark, d, "go_ref").select(F.col("go_id").alias("node"))
    return graph.local_context(nodes, edges, edges.agg(F.min("v")).first()[0])[0]


@query(f"WITH {_EDGES} SELECT u, v FROM e WHERE regexp_matches(u, '^IPR[0-9]+$') AND regexp_matches(v, '^IPR[0-9]+$')")
def id_pattern_subgraph(spark: SparkSession, d: str) -> DataFrame:
    edges = _edges(spark, d).select("u", "v")
    nodes = edges.select(F.explode(F.array("u", "v")).alias("node")).where(F.col("node").rlike(r"^IPR\d+$"))
    return graph.induced(edges, nodes)


@query("SELECT go_id, name FROM go_ref")
def clean_uris(spark: SparkSession, d: str) -> DataFrame:
    """Term addresses made from the ids, brought back to ids."""
    uri = F.concat(F.lit("http://purl.obolibrary.org/obo/"), F.translate("go_id", ":", "_"))
    return table(spark, d, "go_ref").select(T.clean_uri(uri).alias("go_id"), "name")


@query("""SELECT g.mapping_id, CASE WHEN upper(trim(g.llm_best_match)) <> 'NONE' AND contains(upper(g.llm_best_match), upper(r.go_id)) THEN r.go_id END AS hit
FROM go_mapping g LEFT JOIN go_ref r ON r.name = g.name""")
def answer_containment(spark: SparkSession, d: str) -> DataFrame:
    offer = table(spark, d, "go_ref").select("name", F.array(F.struct(F.col("go_id").alias("id"), "name")).alias("hits"))
    rows = table(spark, d, "go_mapping").select("mapping_id", "name", "llm_best_match").join(offer, "name", "left")
    return rows.select("mapping_id", T.hit_contained(F.col("llm_best_match"), F.col("hits"))["id"].alias("hit"))


@query("""SELECT g.mapping_id, r.go_id AS hit FROM go_mapping g LEFT JOIN go_ref r ON r.name = g.name
AND regexp_replace(lower(trim(g.llm_best_match)), '^["''`]+|["''`]+$', '', 'g') IN (lower(r.go_id), lower(r.name))""")
def answer_equality(spark: SparkSession, d: str) -> DataFrame:
    offer = table(spark, d, "go_ref").select("name", F.array(F.struct(F.col("go_id").alias("id"), "name")).alias("hits"))
    rows = table(spark, d, "go_mapping").select("mapping_id", "name", "llm_best_match").join(offer, "name", "left")
    return rows.select("mapping_id", T.hit_equal(F.col("llm_best_match"), F.col("hits"))["id"].alias("hit"))


@query("SELECT pmid, replace(replace(abstract, chr(13), ' '), chr(10), ' ') AS line FROM pubmed_abs")
def newline_flatten(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pubmed_abs").select("pmid", T.one_line(F.col("abstract")).alias("line"))


@query(r"SELECT doc_id, regexp_replace(text, '[^\P{C}\n\r\t]', '', 'g') AS text FROM documents")
def control_strip(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", T.printable(F.col("text")).alias("text"))


@query(r"""WITH w AS (SELECT match_id, unnest(list_distinct(regexp_split_to_array(lower(trim(species)), '[ \t\n\f\r\v]+'))) AS token FROM uniprot_match WHERE match_id % 20 = 0),
n AS (SELECT organism AS id, unnest(string_split(lower(organism), ' ')) AS word, 3.0 AS boost FROM uniprot_ref UNION SELECT organism, unnest(string_split(lower(organism_common), ' ')), 1.0 FROM uniprot_ref),
m AS (SELECT match_id, id, token, max(boost / (1 + levenshtein(token, word))) AS s FROM w JOIN n ON levenshtein(token, word) <= CASE WHEN length(token) <= 2 THEN 0 WHEN length(token) <= 5 THEN 1 ELSE 2 END WHERE token <> '' GROUP BY 1, 2, 3),
r AS (SELECT match_id, id, sum(s) AS raw FROM m GROUP BY 1, 2)
SELECT match_id, id, CAST(rank AS INTEGER) AS rank, round(CAST(score AS DOUBLE), 3) AS score FROM (SELECT match_id, id, raw / max(raw) OVER (PARTITION BY match_id) AS score, row_number() OVER (PARTITION BY match_id ORDER BY raw DESC, id) AS rank FROM r) WHERE rank <= 3""")
def fuzzy_species(spark: SparkSession, d: str) -> DataFrame:
    """Species as entered against the organisms' names, with typing errors."""
    names = table(spark, d, "uniprot_ref").select("organism", "organism_common").distinct()
    asked = table(spark, d, "uniprot_match").where("match_id % 20 = 0").select("match_id", "species")
    return retrieval.fuzzy_search(asked, names.withColumn("id", F.col("organism")), "match_id", "species", "id", {"organism": 3.0, "organism_common": 1.0}, 3).select("match_id", "id", "rank", "score")


@query("WITH named AS (SELECT accession, " + _NORMAL.format("protein_name") + " AS name FROM uniprot_ref) SELECT accession, CAST(n AS INTEGER) AS n, phrase FROM " + _runs("named", "accession"))
def sub_phrases(spark: SparkSession, d: str) -> DataFrame:
    names = table(spark, d, "uniprot_ref").select("accession", T.normal_name(F.col("protein_name")).alias("name"))
    return matching.runs(names, "name", None).select("accession", "n", "phrase")


@query("SELECT * FROM (VALUES " + ", ".join(f"({i + 1}, '{c}', '{n}', '{t}')" for i, (c, n, t) in enumerate(store.CPR)) + ") v(rank, id, name, description)")
def relation_classes(spark: SparkSession, d: str) -> DataFrame:
    return store.relation_classes(spark)


# --- dataflow -----------------------------------------------------------------------------------------------------------------------

_NEED = ["click", "view", "purchase"]
# An item is what one user did on one day.
_ITEM = "CAST(user_id * 100 + day(ts) AS BIGINT)"
_READY = f"""ev AS (SELECT {_ITEM} AS item, event_type, max(ts) AS ts FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL GROUP BY 1, 2),
up AS (SELECT item, max(ts) AS at_, count(*) AS n FROM ev WHERE event_type IN ('click', 'view', 'purchase') GROUP BY 1),
done AS (SELECT item FROM ev WHERE event_type = 'error')"""


def _log(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(F.col("event_type").alias("stage"), (F.col("user_id") * 100 + F.dayofmonth("ts")).alias("item"), F.lit("done").alias("event"), F.col("ts").alias("at"))


@query(f"WITH {_READY} SELECT item, at_ AS ready_at FROM up WHERE n = 3 AND item NOT IN (SELECT item FROM done WHERE item IS NOT NULL) ORDER BY at_, item")
def queue_claim_all(spark: SparkSession, d: str) -> DataFrame:
    return queues.claim(_log(spark, d), _NEED, "error").withColumnRenamed("at", "ready_at")


@query("SELECT count(DISTINCT CAST(user_id * 100 + day(ts) AS BIGINT)) AS n FROM events WHERE event_type = 'click' AND CAST(user_id * 100 + day(ts) AS BIGINT) IN (SELECT c_custkey FROM customer)")
def done_count_in(spark: SparkSession, d: str) -> DataFrame:
    return queues.count_done(_log(spark, d), "click", table(spark, d, "customer").select(F.col("c_custkey").alias("item")))


@query("SELECT CAST(user_id * 100 + day(ts) AS BIGINT) AS item, max(ts) AS done_at FROM events WHERE event_type = 'signup' AND user_id IS NOT NULL GROUP BY 1 ORDER BY 2, 1")
def done_list_ordered(spark: SparkSession, d: str) -> DataFrame:
    return queues.done_in_order(_log(spark, d), "signup").withColumnRenamed("at", "done_at")


@query(f"WITH {_READY}, two AS (SELECT item, max(ts) AS at_ FROM ev WHERE event_type IN ('click', 'view') GROUP BY 1 HAVING count(*) = 2) SELECT item, at_ AS queued_at FROM two WHERE item NOT IN (SELECT item FROM done)")
def queue_pop_not_done(spark: SparkSession, d: str) -> DataFrame:
    """Queued in both stages and not ended in the next."""
    log = _log(spark, d).withColumn("event", F.when(F.col("stage").isin("click", "view"), "queued").otherwise(F.col("event")))
    return queues.queued(log, ["click", "view"]).join(queues.ended(log, "error").select("item"), "item", "left_anti").withColumnRenamed("at", "queued_at")


@query(f"WITH {_READY} SELECT item FROM ev WHERE event_type = 'click' AND item NOT IN (SELECT item FROM done)")
def seed_from_done(spark: SparkSession, d: str) -> DataFrame:
    return queues.seed(_log(spark, d), "click", "error").select("item")


@query(f"WITH {_READY} SELECT item FROM up WHERE n = 3 AND item NOT IN (SELECT item FROM done WHERE item IS NOT NULL)")
def stream_gate_equals_batch(spark: SparkSession, d: str) -> DataFrame:
    """The batch claim, done as a stream over the log's files."""
    home = new_path(spark, "gate")
    _log(spark, d).repartitionByRange(4, "at").write.parquet(f"{home}/source")
    queues.gate_stream(spark, f"{home}/source", _NEED, "error", f"{home}/out", f"{home}/checkpoint").awaitTermination()
    passed = spark.read.schema("item bigint, at timestamp").parquet(f"{home}/out/ready").select("item").distinct()
    # What an early batch let pass and a later one showed to be done already.
    return passed.join(queues.ended(_log(spark, d), "error"), "item", "left_anti")


# --- models --------------------------------------------------------------------------------------------------------------------------

_JUDGED = "j AS (SELECT m.mapping_id, m.name, g.go_id AS best_id, CASE WHEN g.go_id IS NULL THEN 'empty' ELSE 'ok' END AS status FROM go_mapping m LEFT JOIN (SELECT name, min(go_id) AS go_id FROM go_ref GROUP BY 1) g ON g.name = m.name)"


@query(f"WITH {_JUDGED} SELECT * FROM j")
def llm_judge_stub(spark: SparkSession, d: str) -> DataFrame:
    hits = F.array_sort(F.collect_list(F.struct(F.col("go_id").alias("id"), "name", F.col("namespace").alias("description"))))
    offers = table(spark, d, "go_ref").groupBy("name").agg(hits.alias("hits"))
    names = table(spark, d, "go_mapping").select("mapping_id", "name", "description").join(offers, "name", "left")
    return models.judged(names).select("mapping_id", "name", F.col("best.id").alias("best_id"), "status")


@query(f"""WITH {_JUDGED}, u AS (SELECT upper(gene_symbol) AS k, min(accession) AS accession FROM uniprot_ref GROUP BY 1)
SELECT j.mapping_id, u.accession AS best_id FROM j LEFT JOIN u ON u.k = upper(trim(j.name)) WHERE j.best_id IS NULL AND j.name IS NOT NULL""")
def convert_failed_stub(spark: SparkSession, d: str) -> DataFrame:
    """What the terms could not resolve is looked for among the proteins; what is found moves there."""
    judged = cut(llm_judge_stub(spark, d))
    pending = judged.where("best_id is null and name is not null").select("mapping_id", "name")
    other = table(spark, d, "uniprot_ref").groupBy(F.upper("gene_symbol").alias("k")).agg(F.min("accession").alias("best_id"))
    found = pending.join(other, F.upper(F.trim("name")) == F.col("k"), "left").select("mapping_id", "name", "best_id")
    still, moved = relations.converted(pending, found, ["mapping_id"])
    return still.select("mapping_id", F.lit(None).cast("string").alias("best_id")).unionByName(moved.select("mapping_id", F.col("best_id")))


@query("""WITH n AS (SELECT mapping_id, name, trim(name, chr(9) || chr(10) || chr(13) || ' ' || chr(160) || chr(8203)) AS t FROM go_mapping), p AS (SELECT *, strpos(t, ' of ') AS i FROM n)
SELECT mapping_id, name, CASE WHEN trim(name) <> '' AND i > 0 AND substr(t, i + 4) <> '' THEN '{"name": ' || CAST(to_json(substr(t, i + 4)) AS VARCHAR) || ', "type": "GO", "meta": [{"name": ' || CAST(to_json(left(t, i - 1)) AS VARCHAR) || ', "type": "GO", "meta": []}]}' END AS rewritten FROM p""")
def decompose_stub(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "go_mapping").select("mapping_id", "name", F.lit("GO").alias("type"))
    return models.decomposed(rows).select("mapping_id", "name", "rewritten")


@query(nested_sql.WITH + r"""SELECT r.merged_id AS doc_id, r.block_no, r.rel_no, list_has_all(regexp_extract_all(lower(s.sentence), '[\p{L}\p{N}_]+'), regexp_extract_all(lower(r.name), '[\p{L}\p{N}_]+')) AS valid
FROM node r JOIN node s ON s.kind = 'sentence' AND s.merged_id = r.merged_id AND s.block_no = r.block_no WHERE r.kind = 'relation'""")
def validate_stub(spark: SparkSession, d: str) -> DataFrame:
    from litweave.operators import nested

    n = cut(nested.nodes(table(spark, d, "merged"), "merged_id", "relations"))  # one walk for both tables
    r = nested.relations(n).select("doc_id", "sentence_pre", "block_no", "rel_no", F.col("name").alias("claim"))
    s = nested.sentences(n).select("doc_id", F.col("pre").alias("sentence_pre"), "sentence")
    return models.checked(r.join(s, ["doc_id", "sentence_pre"])).select("doc_id", "block_no", "rel_no", "valid")


def _resolved(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The merged documents resolved against terms and proteins; terms that fail are tried as proteins."""
    found = cut(relations.with_species(cut(relations.mentions(table(spark, d, "merged"), "merged_id", "relations"))))
    go = table(spark, d, "go_ref").select(F.col("go_id").alias("id"), "name", F.col("namespace").alias("description"))
    up = table(spark, d, "uniprot_ref").select(F.col("accession").alias("id"), F.col("gene_symbol").alias("name"), F.col("protein_name").alias("description"))
    ontologies = [relations.Ontology(("GO",), "go", judge="relaxed"), relations.Ontology(("gene", "protein"), "uniprot")]
    searches = {"go": stages.token_lookup(go), "uniprot": stages.token_lookup(up)}
    return stages.resolve(found, ontologies, searches, [stages.Conversion("go", "uniprot", "protein")])


@query()
def resolve_documents(spark: SparkSession, d: str) -> DataFrame:
    return _resolved(spark, d)[0].select("doc_id", "pre", "name", "type", "id")


@query()
def resolve_statuses(spark: SparkSession, d: str) -> DataFrame:
    return stages.statuses(_resolved(spark, d)[1])
