"""The nodes of relation documents in SQL, for the queries on them."""

from __future__ import annotations


def _list(value: str) -> str:
    return f"(CASE WHEN {value} IS NULL OR json_type({value}) = 'NULL' THEN [] WHEN json_type({value}) = 'ARRAY' THEN json_extract({value}, '$[*]') ELSE [{value}] END)"


def _text(value: str, key: str) -> str:
    return f"(CASE WHEN json_type({value}->'{key}') = 'VARCHAR' THEN {value}->>'{key}' WHEN json_type({value}->'{key}') = 'NULL' THEN NULL ELSE CAST({value}->'{key}' AS VARCHAR) END)"


def _each(columns: str, elements: str, source: str) -> str:
    return f"SELECT {columns}, unnest(l) AS v, generate_subscripts(l, 1) - 1 AS i FROM (SELECT *, {elements} AS l FROM {source})"


# e(merged_id, block_no, rel_no, role, path, v): entities. node(merged_id, kind, k, d, way, v, ...): all nodes with their place in the
# pre-order and their depth, from which the numbers of the depth-first walk follow: it has passed two numbers for every node before,
# but one for those still open.
NODES = f"""
env AS (
  SELECT merged_id, CASE WHEN json_valid(relations) THEN CAST(relations AS JSON) END AS j FROM merged WHERE merged_id IS NOT NULL
  UNION ALL
  SELECT merged_id, CASE WHEN json_type(j) = 'OBJECT' THEN j->'relations' WHEN json_valid(j->>'$') THEN CAST(j->>'$' AS JSON) END
  FROM env WHERE json_type(j) = 'VARCHAR' OR json_type(j) = 'OBJECT' AND json_exists(j, '$.relations')),
b AS ({_each("merged_id", _list("j"), "env WHERE json_type(j) = 'ARRAY' OR json_type(j) = 'OBJECT' AND NOT json_exists(j, '$.relations')")}),
s AS (SELECT merged_id, i AS block_no, v FROM b WHERE json_type(v) = 'OBJECT'),
r AS (SELECT merged_id, block_no, i AS rel_no, v FROM ({_each("merged_id, block_no", _list("(v->'rel_from_this_sent')"), "s")}) WHERE json_type(v) = 'OBJECT'),
sides AS (
  SELECT merged_id, block_no, rel_no, 0 AS role_no, 'component' AS role, {_list("(v->'components')")} AS m FROM r
  UNION ALL SELECT merged_id, block_no, rel_no, 1, 'target', list_concat({_list("(v->'targets')")}, {_list("(v->'target')")}) FROM r
  UNION ALL SELECT merged_id, block_no, rel_no, 2, 'context', list_concat({_list("(v->'contexts')")}, {_list("(v->'context')")}) FROM r),
e AS (
  SELECT merged_id, block_no, rel_no, role_no, role, [i] AS path, v FROM ({_each("merged_id, block_no, rel_no, role_no, role", "m", "sides")}) WHERE json_type(v) IN ('OBJECT', 'VARCHAR')
  UNION ALL
  SELECT merged_id, block_no, rel_no, role_no, role, list_append(path, i), v FROM ({_each("merged_id, block_no, rel_no, role_no, role, path", _list("(v->'meta')"), "e WHERE json_type(v) = 'OBJECT'")}) WHERE json_type(v) IN ('OBJECT', 'VARCHAR')),
every AS (
  SELECT merged_id, 'sentence' AS kind, block_no, CAST(NULL AS BIGINT) AS rel_no, CAST(NULL AS VARCHAR) AS role, CAST(NULL AS BIGINT[]) AS path, [block_no] AS way, 0 AS d, v FROM s
  UNION ALL SELECT merged_id, 'relation', block_no, rel_no, NULL, NULL, [block_no, rel_no], 1, v FROM r
  UNION ALL SELECT merged_id, 'entity', block_no, rel_no, role, path, list_concat([block_no, rel_no, role_no], path), 1 + len(path), v FROM e),
placed AS (SELECT *, row_number() OVER (PARTITION BY merged_id ORDER BY way) - 1 AS k FROM every),
sized AS (SELECT a.merged_id, a.way, count(*) AS n FROM placed a JOIN placed x ON x.merged_id = a.merged_id AND x.way[1:len(a.way)] = a.way GROUP BY 1, 2),
said AS (SELECT *, CASE WHEN kind = 'relation' AND json_type(v->'relation') = 'OBJECT' THEN v->'relation' WHEN kind = 'relation' THEN json_object('name', v->'relation') WHEN json_type(v) = 'VARCHAR' THEN json_object('name', v) ELSE v END AS o FROM placed),
node AS (
  SELECT p.merged_id, p.kind, p.block_no, p.rel_no, p.role, p.path, p.way, p.d, 2 * p.k - p.d AS pre, 2 * p.k - p.d + 2 * z.n - 1 AS post,
    array_to_string(p.path, '.') AS ent_path, {_text("p.o", "name")} AS name, {_text("p.o", "type")} AS type, {_text("p.o", "description")} AS description, {_text("p.o", "id")} AS id,
    CASE WHEN p.kind = 'sentence' THEN {_text("p.v", "sentence")} END AS sentence, CASE WHEN p.kind = 'relation' AND json_type(p.v->'valid') = 'BOOLEAN' THEN CAST(p.v->>'valid' AS BOOLEAN) END AS valid
  FROM said p JOIN sized z ON z.merged_id = p.merged_id AND z.way = p.way)
"""
WITH = f"WITH RECURSIVE {NODES}"
FOUND = WITH + "SELECT merged_id, block_no, rel_no, role, ent_path FROM node WHERE kind = 'entity'"
SENTENCES = WITH + "SELECT merged_id, pre, post, block_no, sentence FROM node WHERE kind = 'sentence'"
RELATIONS = WITH + """SELECT n.merged_id, n.pre, n.post, s.pre AS sentence_pre, n.block_no, n.rel_no, n.name, n.description, n.id, n.valid
FROM node n JOIN node s ON s.kind = 'sentence' AND s.merged_id = n.merged_id AND s.block_no = n.block_no WHERE n.kind = 'relation'"""
_ENTITIES = """ents AS (SELECT n.merged_id, n.pre, n.post, s.pre AS sentence_pre, r.pre AS relation_pre, u.pre AS parent, n.d AS depth, n.block_no, n.rel_no, n.role, n.ent_path, n.name, n.type, n.description, n.id, len(n.path) - 1 AS level
FROM node n JOIN node s ON s.kind = 'sentence' AND s.merged_id = n.merged_id AND s.block_no = n.block_no
JOIN node r ON r.kind = 'relation' AND r.merged_id = n.merged_id AND r.block_no = n.block_no AND r.rel_no = n.rel_no
JOIN node u ON u.merged_id = n.merged_id AND u.way = CASE WHEN len(n.path) = 1 THEN n.way[1:2] ELSE n.way[1:len(n.way) - 1] END WHERE n.kind = 'entity')"""
WITH_ENTITIES = f"{WITH}, {_ENTITIES}"
ENTITIES = WITH_ENTITIES + " SELECT * EXCLUDE (level) FROM ents"
VALID = WITH + "SELECT merged_id AS doc_id, block_no, rel_no, name FROM node WHERE kind = 'relation' AND coalesce(valid, true)"
_FLAT = """flat AS (SELECT c.merged_id AS doc_id, c.block_no, c.rel_no, r.name AS relation, c.name AS component_name, c.type AS component_type, c.id AS component_id, t.name AS target_name, t.type AS target_type, t.id AS target_id
FROM node c JOIN node t ON t.merged_id = c.merged_id AND t.block_no = c.block_no AND t.rel_no = c.rel_no AND t.role = 'target' AND len(t.path) = 1
JOIN node r ON r.kind = 'relation' AND r.merged_id = c.merged_id AND r.block_no = c.block_no AND r.rel_no = c.rel_no WHERE c.role = 'component' AND len(c.path) = 1)"""
FLAT = f"{WITH}, {_FLAT} SELECT * FROM flat"
FACTS = f"""{WITH}, {_FLAT}, g AS (SELECT name, min(go_id) AS go_id FROM go_ref GROUP BY 1), a AS (SELECT gene_symbol AS name, min(accession) AS accession FROM uniprot_ref GROUP BY 1),
f AS (SELECT flat.* REPLACE (coalesce(flat.target_id, g.go_id) AS target_id) FROM flat LEFT JOIN g ON g.name = flat.target_name WHERE lower(component_type) IN ('gene', 'protein') AND target_type = 'GO')
SELECT f.*, a.accession AS uniprot_id, a.accession IS NOT NULL AS uniprot_mapped FROM f LEFT JOIN a ON a.name = f.component_name WHERE f.target_id IS NOT NULL"""
COLLECTED = WITH_ENTITIES + """ SELECT merged_id AS doc_id, name, description FROM (SELECT *, row_number() OVER (PARTITION BY merged_id, name ORDER BY length(description) DESC, description) AS rn
FROM (SELECT DISTINCT merged_id, name, coalesce(description, '') AS description FROM ents WHERE level <= 1 AND type IN ('gene', 'protein') AND trim(name, ' ') <> '')) WHERE rn = 1"""
_SPECIES = """sp AS (SELECT * FROM ents WHERE type = 'species' AND trim(name, ' ') <> '' AND level <= 1),
own AS (SELECT merged_id, parent, arg_min(name, pre) AS name FROM sp WHERE level = 1 GROUP BY 1, 2),
shared AS (SELECT merged_id, relation_pre, arg_min(name, CASE WHEN role = 'context' THEN 0 ELSE 1000000000 END + pre) AS name FROM sp GROUP BY 1, 2)"""
SPECIES = f"""{WITH_ENTITIES}, {_SPECIES} SELECT x.merged_id AS doc_id, x.pre, x.name, x.type, coalesce(o.name, h.name, '') AS species FROM ents x
LEFT JOIN own o ON o.merged_id = x.merged_id AND o.parent = x.pre LEFT JOIN shared h ON h.merged_id = x.merged_id AND h.relation_pre = x.relation_pre WHERE x.level = 0"""
APPLIED = WITH_ENTITIES + """, best AS (
  SELECT 'go' AS ontology, name AS n, max({'best_id': go_id, 'best_name': name}) AS best FROM go_ref GROUP BY 1, 2
  UNION ALL SELECT 'gene', gene_symbol, {'best_id': min(accession), 'best_name': min(protein_name)} FROM uniprot_ref GROUP BY 1, 2),
x AS (SELECT *, CASE WHEN type = 'GO' THEN 'go' WHEN type IN ('gene', 'protein') THEN 'gene' END AS ontology FROM ents)
SELECT x.merged_id AS doc_id, x.pre, coalesce(best.best.best_name, best.best.best_id, x.name) AS name, x.type, coalesce(best.best.best_id, x.id) AS id
FROM x LEFT JOIN best ON best.ontology = x.ontology AND best.n = x.name WHERE x.ontology IS NULL OR best.best IS NOT NULL"""
