"""XML, taxonomy dumps and graph JSON as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litweave.functions.text import clean_uri, printable

FAMILY = (
    "_id string, _type string, _short_name string, name string, abstract string, "
    "member_list struct<db_xref: array<struct<_db: string, _dbkey: string, _name: string>>>, "
    "parent_list struct<rel_ref: array<struct<_ipr_ref: string>>>, child_list struct<rel_ref: array<struct<_ipr_ref: string>>>, "
    "class_list struct<classification: array<struct<_id: string, _class_type: string, category: string, description: string>>>"
)


def families(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """entry, member, relation and classification tables of a family XML. A link told by both sides comes as 'parent' and 'child'."""
    x = spark.read.format("xml").option("rowTag", "interpro").schema(FAMILY).load(path)
    inline = lambda c, *cols: x.select(F.col("_id").alias("ipr_id"), F.inline(c)).select("ipr_id", *cols)
    links = [
        x.select(F.col("_id").alias("node"), F.explode(f"{side}_list.rel_ref._ipr_ref").alias("other"), F.lit(side).alias("type")) for side in ("parent", "child")
    ]
    up, down = links
    relation = up.select(F.col("other").alias("parent"), F.col("node").alias("child"), "type").unionByName(down.select(F.col("node").alias("parent"), F.col("other").alias("child"), "type"))
    return {
        "entry": x.select(F.col("_id").alias("ipr_id"), F.col("_type").alias("type"), F.col("_short_name").alias("short_name"), "name", F.trim("abstract").alias("abstract")),
        "member": inline("member_list.db_xref", F.col("_db").alias("db"), F.col("_dbkey").alias("dbkey"), F.col("_name").alias("name")),
        "relation": relation,
        "classification": inline("class_list.classification", F.col("_id").alias("class_id"), F.col("_class_type").alias("class_type"), "category", "description"),
    }


def with_links(spark: SparkSession, path: str, most: int = 3) -> DataFrame:
    """The first entries that have members of every list, to look at."""
    x = spark.read.format("xml").option("rowTag", "interpro").schema(FAMILY).load(path)
    return x.where("size(class_list.classification) > 0 and size(parent_list.rel_ref) > 0 and size(child_list.rel_ref) > 0").orderBy("_id").limit(most)


def taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """(id, label, synonyms): the scientific name as label, all other names once each, in order."""
    parts = F.transform(F.split("value", r"\|"), lambda c: F.trim(F.regexp_replace(c, r"\t", "")))
    rows = spark.read.text(path).select(parts.alias("p"), F.monotonically_increasing_id().alias("n"))
    rows = rows.where(F.size("p") >= 4).select(F.get("p", F.lit(0)).alias("id"), F.get("p", F.lit(1)).alias("name"), F.get("p", F.lit(3)).alias("kind"), "n")
    names = F.array_distinct(F.transform(F.array_sort(F.collect_list(F.when(F.col("kind") != "scientific name", F.struct("n", "name")))), lambda s: s["name"]))
    g = rows.groupBy("id").agg(F.min(F.when(F.col("kind") == "scientific name", F.col("name"))).alias("label"), names.alias("synonyms"))
    return g.withColumn("synonyms", F.array_remove("synonyms", F.coalesce("label", F.lit(""))))


OBO = (
    "graphs array<struct<nodes: array<struct<id: string, lbl: string, type: string, meta: struct<definition: struct<val: string>, comments: array<string>, "
    "basicPropertyValues: array<struct<pred: string, val: string>>>>>, edges: array<struct<sub: string, pred: string, obj: string>>>>"
)


def ontology(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of a graph JSON; alternative ids become edges, and of several relations of a pair the last counts."""
    g = spark.read.schema(OBO).json(path, multiLine=True).select(F.col("graphs")[0].alias("g"))
    n = g.select(F.posexplode("g.nodes").alias("at", "n")).select("at", clean_uri(F.col("n.id")).alias("node"), "n.lbl", "n.type", F.col("n.meta.definition.val").alias("definition"), F.col("n.meta.comments").alias("comments"), F.col("n.meta.basicPropertyValues").alias("props"))
    alias = n.select("at", F.col("node").alias("main"), F.inline("props")).where(F.col("pred").endswith("hasAlternativeId"))
    alias = alias.select(F.struct(F.lit(0).alias("k"), F.col("at").cast("bigint").alias("i")).alias("pos"), clean_uri(F.col("val")).alias("u"), F.col("main").alias("v"), clean_uri(F.col("pred")).alias("relation"))
    given = g.select(F.posexplode("g.edges").alias("at", "e")).select(F.struct(F.lit(1).alias("k"), F.col("at").cast("bigint").alias("i")).alias("pos"), clean_uri(F.col("e.sub")).alias("u"), clean_uri(F.col("e.obj")).alias("v"), clean_uri(F.col("e.pred")).alias("relation"))
    edges = alias.unionByName(given).groupBy("u", "v").agg(F.max_by("relation", "pos").alias("relation"))
    return n.drop("at", "props"), edges


ARTICLE = "PMID string, Article struct<Abstract: struct<AbstractText: array<struct<_Label: string, _VALUE: string>>>>"


def abstracts(spark: SparkSession, path: str, asked: DataFrame | None = None) -> DataFrame:
    """(pmid, abstract): labelled sections joined by blank lines; NO_ABSTRACT where there is none, NO_ARTICLE where an id was asked for in vain."""
    x = spark.read.format("xml").option("rowTag", "MedlineCitation").schema(ARTICLE).load(path)
    part = F.transform("Article.Abstract.AbstractText", lambda s: F.when(s["_Label"].isNotNull(), F.concat_ws(": ", s["_Label"], F.trim(s["_VALUE"]))).otherwise(F.trim(s["_VALUE"])))
    text = printable(F.array_join(part, "\n\n"))
    rows = x.select(F.col("PMID").try_cast("bigint").alias("pmid"), F.when(F.trim(text) != "", text).otherwise("NO_ABSTRACT").alias("abstract"))
    if asked is None:
        return rows
    return asked.select("pmid").distinct().join(rows, "pmid", "left").withColumn("abstract", F.coalesce("abstract", F.lit("NO_ARTICLE")))
