"""Queries on records: orphan references, nested documents, small files and hierarchies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litweave.operators import compaction, hierarchy, nested, orphans
from litweave.plans import nested_sql
from litweave.session import table


def _references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(src, row_id, key, at) of both tables; ids of proteins without isoform."""
    member = orphans.referring(table(spark, sf_dir, "member_table"), "member_id", orphans.key_form("ipr_id"), "loaded_at")
    mapped = orphans.referring(table(spark, sf_dir, "uniprot_idmapping"), "map_id", orphans.base_accession(orphans.key_form("uniprot_id")), "loaded_at")
    return member.withColumn("src", F.lit("member_table")).unionByName(mapped.withColumn("src", F.lit("uniprot_idmapping")))


def _existence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(src, key, at, exists) of the tables that they refer to."""
    entries = table(spark, sf_dir, "entry_table").select(F.lit("member_table").alias("src"), F.col("ipr_id").alias("id"), "loaded_at", "retired_at")
    proteins = table(spark, sf_dir, "uniprot_ref").select(F.lit("uniprot_idmapping").alias("src"), F.col("accession").alias("id"), "loaded_at", "retired_at")
    return orphans.existence_deltas(entries.unionByName(proteins), "id", "loaded_at", "retired_at", "src")


def p1_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphans.found_orphans(_references(spark, sf_dir), _existence(spark, sf_dir), ("src",))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p1_orphans(spark, sf_dir).select("src", "row_id", F.date_format("at", "yyyy-MM").alias("period"))


def p1_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphans.orphan_report(p1_orphans(spark, sf_dir))


def p1_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of entry_table that are referenced now but exist no more, from one fold of all deltas."""
    refs = table(spark, sf_dir, "member_table").select(orphans.key_form("ipr_id").alias("key"), F.lit(1).alias("refs"), F.lit(0).alias("exists"))
    steps = orphans.existence_deltas(table(spark, sf_dir, "entry_table"), "ipr_id", "loaded_at", "retired_at")
    state = orphans.fold_counts(refs.limit(0), refs.unionByName(steps.select("key", F.lit(0).alias("refs"), "exists")))
    return orphans.current_orphans(state)


def p1_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for both tables, each key with its table; ids of proteins without isoform."""
    refs = _references(spark, sf_dir).select("src", "key", F.lit(1).alias("refs"), F.lit(0).alias("exists"))
    deltas = refs.unionByName(_existence(spark, sf_dir).select("src", "key", F.lit(0).alias("refs"), "exists"))
    return orphans.current_orphans(orphans.fold_counts(deltas.limit(0), deltas, ("src", "key")))


def p1_epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signed reference and existence counts of every key and epoch with references: orphans where exists is 0."""
    counts = orphans.epoch_counts(_references(spark, sf_dir), _existence(spark, sf_dir), ("src",))
    return counts.groupBy("src", (F.col("exists") <= 0).alias("orphan")).agg(F.sum("refs").alias("refs"), F.count("*").alias("epochs"))


def _nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.nodes(table(spark, sf_dir, "merged"), "merged_id", "relations")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.found(table(spark, sf_dir, "merged"), "merged_id", "relations")


def p2_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.sentences(_nodes(spark, sf_dir)).withColumnRenamed("doc_id", "merged_id")


def p2_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.relations(_nodes(spark, sf_dir)).withColumnRenamed("doc_id", "merged_id")


def p2_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.entities(_nodes(spark, sf_dir)).withColumnRenamed("doc_id", "merged_id")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = compaction.compact(table(spark, sf_dir, "files"))
    return spark.read.schema("rid string").parquet(done.path)


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hierarchy.hierarchy(table(spark, sf_dir, "relation_table"), "parent", "child")


def p6_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = hierarchy.hierarchy(table(spark, sf_dir, "relation_table"), "parent", "child", paths=True)
    return h.select("node", "depth", F.array_join("path", "/").alias("path"))


def p6_descendants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hierarchy.all_descendants(table(spark, sf_dir, "relation_table"), "parent", "child")


def p6_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The links to other parents than the smallest, which p6_found and p6_paths leave out as their SQL does."""
    return hierarchy.extra_parents(table(spark, sf_dir, "relation_table"), "parent", "child")


def p6_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes on or below a cycle of any links."""
    return hierarchy.cyclic(table(spark, sf_dir, "relation_table"), "parent", "child")


QUERIES = {f.__name__: f for f in (p1_found, p1_report, p1_state, p1_states, p1_epochs, p2_found, p2_sentences, p2_relations, p2_entities, p5_found, p6_found, p6_paths, p6_descendants, p6_parents, p6_cycles)}

_P1 = """
WITH refs AS (
  SELECT 'member_table' AS src, member_id AS row_id, nullif(upper(trim(ipr_id)), '') AS k, loaded_at AS ts FROM member_table
  UNION ALL
  SELECT 'uniprot_idmapping', map_id, regexp_replace(nullif(upper(trim(uniprot_id)), ''), '-[0-9]+$', ''), loaded_at FROM uniprot_idmapping),
recs AS (
  SELECT DISTINCT 'member_table' AS src, nullif(upper(trim(ipr_id)), '') AS k, loaded_at, retired_at FROM entry_table
  UNION ALL
  SELECT DISTINCT 'uniprot_idmapping', accession, loaded_at, retired_at FROM uniprot_ref),
orphan AS (
  SELECT r.src, r.row_id, r.k, r.ts FROM refs r WHERE r.k IS NOT NULL AND NOT EXISTS (
    SELECT 1 FROM recs e WHERE e.src = r.src AND e.k = r.k AND e.loaded_at <= r.ts AND (e.retired_at IS NULL OR e.retired_at > r.ts)))
"""
_P6 = """
WITH RECURSIVE e AS (
  SELECT upper(trim(child)) AS c, min(upper(trim(parent))) AS p FROM relation_table GROUP BY 1),
n AS (SELECT c AS node FROM e UNION SELECT p FROM e),
t AS (
  SELECT node, node AS root, 0 AS depth, node AS path FROM n WHERE node NOT IN (SELECT c FROM e)
  UNION ALL
  SELECT e.c, t.root, t.depth + 1, t.path || '/' || e.c FROM t JOIN e ON e.p = t.node)
"""
_P6_ALL = """
WITH RECURSIVE e AS (SELECT DISTINCT upper(trim(child)) AS c, upper(trim(parent)) AS p FROM relation_table),
up AS (SELECT c AS node, p AS above FROM e UNION SELECT up.node, e.p FROM up JOIN e ON e.c = up.above),
cyc AS (SELECT node FROM up WHERE above = node),
out AS (SELECT DISTINCT node FROM up WHERE above IN (SELECT node FROM cyc) OR node IN (SELECT node FROM cyc)),
t AS (SELECT c AS descendant, p AS node, 1 AS distance FROM e WHERE c NOT IN (SELECT node FROM out)
  UNION SELECT t.descendant, e.p, t.distance + 1 FROM t JOIN e ON e.c = t.node)
"""
ORACLE = {
    "p2_found": nested_sql.FOUND, "p2_sentences": nested_sql.SENTENCES, "p2_relations": nested_sql.RELATIONS, "p2_entities": nested_sql.ENTITIES,
    "p6_parents": _P6_ALL + "SELECT c AS node, p AS up FROM e WHERE p <> (SELECT min(x.p) FROM e x WHERE x.c = e.c)",
    "p6_cycles": _P6_ALL + "SELECT node FROM out",
    "p6_descendants": _P6_ALL + "SELECT node, descendant, CAST(min(distance) AS INTEGER) AS distance FROM t GROUP BY 1, 2",
    "p1_found": _P1 + "SELECT src, row_id, strftime(ts, '%Y-%m') AS period FROM orphan",
    "p1_report": _P1 + "SELECT src, strftime(ts, '%Y-%m') AS period, count(*) AS orphan_rows, count(DISTINCT k) AS orphan_keys FROM orphan GROUP BY 1, 2",
    "p1_epochs": _P1 + """,
step AS (SELECT src, k, t, sum(d) AS d FROM (
    SELECT src, k, loaded_at AS t, 1 AS d FROM (SELECT 'member_table' AS src, upper(trim(ipr_id)) AS k, loaded_at, retired_at FROM entry_table UNION ALL SELECT 'uniprot_idmapping', accession, loaded_at, retired_at FROM uniprot_ref) WHERE retired_at IS NULL OR retired_at > loaded_at
    UNION ALL SELECT src, k, retired_at, -1 FROM (SELECT 'member_table' AS src, upper(trim(ipr_id)) AS k, loaded_at, retired_at FROM entry_table UNION ALL SELECT 'uniprot_idmapping', accession, loaded_at, retired_at FROM uniprot_ref) WHERE retired_at > loaded_at) GROUP BY 1, 2, 3 HAVING sum(d) <> 0),
run AS (SELECT src, k, t, sum(d) OVER (PARTITION BY src, k ORDER BY t) AS n FROM step),
met AS (SELECT r.src, r.k, run.t AS epoch, coalesce(run.n, 0) AS n FROM (SELECT * FROM refs WHERE k IS NOT NULL) r ASOF LEFT JOIN run ON run.src = r.src AND run.k = r.k AND run.t <= r.ts)
SELECT src, n <= 0 AS orphan, count(*) AS refs, count(DISTINCT (k, epoch)) AS epochs FROM met GROUP BY 1, 2""",
    "p1_state": """
WITH x AS (SELECT nullif(upper(trim(ipr_id)), '') AS k, count(*) AS refs FROM member_table GROUP BY 1),
y AS (SELECT upper(trim(ipr_id)) AS k, sum(CASE WHEN retired_at IS NULL THEN 1 ELSE 0 END) AS n FROM entry_table GROUP BY 1)
SELECT x.k AS "key", x.refs AS refs, CAST(coalesce(y.n, 0) AS BIGINT) AS "exists" FROM x LEFT JOIN y ON x.k = y.k
WHERE x.k IS NOT NULL AND coalesce(y.n, 0) <= 0""",
    "p1_states": _P1 + """,
x AS (SELECT src, k, count(*) AS refs FROM refs WHERE k IS NOT NULL GROUP BY 1, 2),
y AS (SELECT 'member_table' AS src, upper(trim(ipr_id)) AS k, sum(CASE WHEN retired_at IS NULL THEN 1 ELSE 0 END) AS n FROM entry_table GROUP BY 1, 2
  UNION ALL
  SELECT 'uniprot_idmapping', upper(trim(accession)), sum(CASE WHEN retired_at IS NULL THEN 1 ELSE 0 END) FROM uniprot_ref GROUP BY 1, 2)
SELECT x.src, x.k AS "key", x.refs AS refs, CAST(coalesce(y.n, 0) AS BIGINT) AS "exists" FROM x LEFT JOIN y ON x.src = y.src AND x.k = y.k
WHERE coalesce(y.n, 0) <= 0""",
    "p6_found": _P6 + "SELECT n.node, coalesce(t.root, 'CYCLE') AS root, CAST(coalesce(t.depth, -1) AS INTEGER) AS depth FROM n LEFT JOIN t ON n.node = t.node",
    "p6_paths": _P6 + "SELECT n.node, CAST(coalesce(t.depth, -1) AS INTEGER) AS depth, t.path FROM n LEFT JOIN t ON n.node = t.node",
}
