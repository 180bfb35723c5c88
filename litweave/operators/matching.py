"""Names matched to a dictionary by five strategies, each applied to what the ones before left unmatched.

exact: the normal name; ngram: the longest run of the query's words that is a reference name; part: the raw query as a run of
a reference's words; parts: all runs of the query's words among those of references; affix: the references that share the
longest prefix, and those that share the longest suffix. All are equi-joins on exploded runs or affixes. A query's runs and
affixes are made only as long as the longest reference name, as no longer one can match. Values keep their duplicates.

Defined results: queries are taken once; null queries and names give nothing; a query without any match is absent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litweave.functions.text import normal_name, subphrases
from litweave.session import cut


def reference_names(reference: DataFrame, name: str, value: str) -> DataFrame:
    return reference.select(normal_name(F.col(name)).alias("name"), F.col(value).alias("value")).dropna(subset=["name"])


def runs(rows: DataFrame, column: str, most_words: int | None) -> DataFrame:
    keep = [c for c in rows.columns if c != column] + [column]
    return rows.select(*keep, F.inline(subphrases(F.col(column), most_words)))


def affixes(rows: DataFrame, column: str, end: bool, most_chars: int) -> DataFrame:
    """rows with (n, affix) for every prefix or suffix of a column."""
    c = F.col(column)
    longest = F.least(F.length(c), F.lit(most_chars))
    cuts = F.transform(F.sequence(F.lit(1), longest), lambda n: F.struct(n.alias("n"), (F.right(c, n) if end else F.left(c, n)).alias("affix")))
    return rows.where(F.length(column) > 0).select(*rows.columns, F.inline(cuts))


def match(queries: DataFrame, query: str, reference: DataFrame, name: str, value: str) -> DataFrame:
    """(query, strategy, value), one row per matched value."""
    ref = cut(reference_names(reference, name, value))  # normalised once for all strategies
    longest = ref.agg(F.max(F.size(F.split("name", " "))), F.max(F.length("name"))).first()
    most_words, most_chars = (max(1, n or 0) for n in longest)
    q = cut(queries.select(F.col(query).alias("query")).dropna().distinct().withColumn("name", normal_name(F.col("query"))))
    names = ref.withColumnRenamed("name", "phrase")
    parts = runs(ref, "name", most_words).select("phrase", "value")
    known_names, known_parts = names.select("phrase").distinct(), parts.select("phrase").distinct()
    out = []

    def rest(matched: DataFrame, found: DataFrame, strategy: str) -> DataFrame:
        """What is left after a strategy. Only that is written: values are joined once, where the result is read."""
        out.append(found.select("query", F.lit(strategy).alias("strategy"), "value"))
        return cut(left.join(matched.select("query").distinct(), "query", "left_anti"))

    left = q
    left = rest(left.join(ref, "name", "left_semi"), left.join(ref, "name"), "exact")
    hits = runs(left, "name", most_words).drop("name").join(known_names, "phrase", "left_semi")
    longest = hits.groupBy("query").agg(F.max("n").alias("n"))
    left = rest(hits, hits.join(longest, ["query", "n"]).join(names, "phrase"), "ngram")
    whole = left.select("query", F.col("query").alias("phrase"))
    left = rest(whole.join(known_parts, "phrase", "left_semi"), whole.join(parts, "phrase"), "part")
    own = runs(left, "name", most_words).drop("name")
    left = rest(own.join(known_parts, "phrase", "left_semi"), own.join(parts, "phrase"), "parts")
    for end in (False, True):
        mine, theirs = affixes(left, "name", end, most_chars), affixes(ref, "name", end, most_chars)
        shared = mine.select("query", "n", "affix").join(theirs.select("affix").distinct(), "affix", "left_semi")
        best = shared.groupBy("query").agg(F.max_by("affix", "n").alias("affix"))
        out.append(best.join(theirs.select("affix", "value"), "affix").select("query", F.lit("suffix" if end else "prefix").alias("strategy"), "value"))
    result = out[0]
    for o in out[1:]:
        result = result.unionByName(o)
    return result
