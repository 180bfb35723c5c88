"""Queries of the operators on texts. None has SQL: they are tested against brute force, round trips and tokenizers."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litweave.llm import canonical, contamination, encoding, pii, sentences
from litweave.operators import nested
from litweave.session import table

# What stands for a text that could not be fetched.
SENTINELS = ("NO_ABSTRACT", "NO_ARTICLE")


def _mapped(spark: SparkSession, sf_dir: str, src: str, field: str, row_id: str, lexicon: canonical.Lexicon, organism: str | None = None, answers: bool = False) -> DataFrame:
    who = F.col(organism) if organism else F.lit(None).cast("string")
    values = table(spark, sf_dir, src).select(F.col(row_id).alias("row_id"), F.col(field).alias("value"), who.alias("organism"))
    m = canonical.mapped(values, lexicon, answers)
    return m.select(F.lit(src).alias("src"), F.lit(field).alias("field"), "row_id", "ref_id")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    proteins = canonical.protein_lexicon(table(spark, sf_dir, "uniprot_ref"))
    terms = canonical.term_lexicon(table(spark, sf_dir, "go_ref"))
    return (
        _mapped(spark, sf_dir, "uniprot_match", "original_name", "match_id", proteins, organism="species")
        .unionByName(_mapped(spark, sf_dir, "go_mapping", "name", "mapping_id", terms))
        .unionByName(_mapped(spark, sf_dir, "go_mapping", "llm_best_match", "mapping_id", terms, answers=True))
    )


def p3_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each value all entries within its distance, with the distance: what p3_found chooses among, model answers aside."""
    proteins = canonical.protein_lexicon(table(spark, sf_dir, "uniprot_ref"))
    terms = canonical.term_lexicon(table(spark, sf_dir, "go_ref"))
    parts = []
    for src, field, row_id, lexicon, who in (("uniprot_match", "original_name", "match_id", proteins, "species"), ("go_mapping", "name", "mapping_id", terms, None)):
        organism = F.col(who) if who else F.lit(None).cast("string")
        values = table(spark, sf_dir, src).select(F.col(row_id).alias("row_id"), F.col(field).alias("value"), organism.alias("organism"))
        parts.append(canonical.mapped_all(values, lexicon).select(F.lit(src).alias("src"), F.lit(field).alias("field"), "row_id", "ref_id", "distance"))
    return parts[0].unionByName(parts[1])


def p3_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values without an entry, per field: how many."""
    m = p3_found(spark, sf_dir)
    return m.groupBy("src", "field").agg(F.count("*").alias("n_values"), F.count_if(F.col("ref_id") == canonical.UNMATCHED).alias("n_unmatched"))


def _blocks(merged: DataFrame) -> DataFrame:
    """(row_id, block_no, text) of the sentence of every block."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [
                (i, n, x["sentence"])
                for i, t in zip(b["merged_id"], b["relations"])
                for n, x in enumerate(nested.blocks_of(t))
                if isinstance(x, dict) and isinstance(x.get("sentence"), str)
            ]
            yield pd.DataFrame(rows, columns=["row_id", "block_no", "text"])

    return merged.select("merged_id", "relations").where("relations is not null").mapInPandas(each, "row_id bigint, block_no bigint, text string")


def p4_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(src, row_id, block_no, text): abstracts once per pmid, the one fetched last, and the sentences of merged blocks."""
    fetched = table(spark, sf_dir, "pubmed_abs").where(F.col("abstract").rlike(r"\S") & ~F.trim("abstract").isin(*SENTINELS))
    abstracts = fetched.groupBy("pmid").agg(F.max_by("abstract", F.struct("fetched_at", "abstract")).alias("text"))
    abstracts = abstracts.select(F.lit("pubmed_abs").alias("src"), F.col("pmid").alias("row_id"), F.lit(-1).cast("bigint").alias("block_no"), "text")
    return abstracts.unionByName(_blocks(table(spark, sf_dir, "merged")).withColumn("src", F.lit("merged")))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = p4_texts(spark, sf_dir)
    corpus = sentences.corpus_evidence(texts, "text")
    keyed = texts.withColumn("kind", F.when(F.col("src") == "merged", 1).otherwise(0))
    units = sentences.sentence_units(keyed.select("kind", "row_id", "block_no", "text"), ["kind", "row_id", "block_no"], "text", corpus)
    src = F.when(F.col("kind") == 1, "merged").otherwise("pubmed_abs").alias("src")
    return units.select(src, "row_id", F.col("block_no").cast("int").alias("block_no"), "sent_no", "start_char", "end_char")


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.encoded(table(spark, sf_dir, "documents"))


def p8_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every longest match with its places."""
    return contamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p8_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.longest(p8_locations(spark, sf_dir))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p8_locations(spark, sf_dir).select("doc_id", "item_id").distinct()


def p8_leaked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with a leak: in how many documents, and their longest match."""
    return p8_matches(spark, sf_dir).groupBy("item_id").agg(F.count("*").alias("n_docs"), F.max("words").alias("most_words"))


def p8_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return contamination.clean(docs, p8_found(spark, sf_dir)).select("doc_id")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.found(table(spark, sf_dir, "documents"))


def p9_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", pii.redacted("text").alias("text"))


def p9_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", pii.surrogates("text").alias("text"))


QUERIES = {f.__name__: f for f in (p3_found, p3_candidates, p3_unmatched, p4_found, p7_ids, p8_found, p8_locations, p8_matches, p8_leaked, p8_clean, p9_found, p9_redacted, p9_surrogates)}
ORACLE: dict[str, str] = {}
