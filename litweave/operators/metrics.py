"""Quality metrics: roll-ups, ratios, distributions of ranks, completeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# What stands for a text that could not be fetched; such rows count as complete.
SENTINELS = ("NO_ABSTRACT", "NO_ARTICLE", "")
SHORT = 50


def roll_up(infos: DataFrame, keys: list[str], correct: str, total: str) -> DataFrame:
    """Sums of correct and total per key and their ratio to three digits; 0 where the total is 0."""
    sums = infos.groupBy(*keys).agg(F.sum(correct).alias("correct"), F.sum(total).alias("total"))
    return sums.withColumn("ratio", F.round(F.when(F.col("total") != 0, F.col("correct") / F.col("total")).otherwise(0.0), 3))


def share(rows: DataFrame, flag: Column, keys: list[str] | None = None) -> DataFrame:
    """(covered, total, ratio) of a flag, null as false; 0 for no rows."""
    sums = rows.groupBy(*(keys or [])).agg(F.count_if(F.coalesce(flag, F.lit(False))).alias("covered"), F.count("*").alias("total"))
    return sums.withColumn("ratio", F.when(F.col("total") > 0, F.col("covered") / F.col("total")).otherwise(0.0))


def rank_cdf(ranks: DataFrame, rank: str) -> DataFrame:
    """How many cases have each rank, and which share has it or a better one. As many rows as ranks."""
    n = ranks.groupBy(rank).agg(F.count("*").alias("n"))
    w = Window.orderBy(rank)
    upto = F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return n.withColumn("cdf", upto / F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))


def completeness(docs: DataFrame, text: str) -> DataFrame:
    """docs with too_short, no_final_period and complete; sentinels have no flag and are complete."""
    t = F.rtrim(F.coalesce(text, F.lit("")))
    exempt = t.isin(*SENTINELS)
    short = ~exempt & (F.length(t) < SHORT)
    open_end = ~exempt & ~t.endswith(".")
    return docs.withColumn("too_short", short).withColumn("no_final_period", open_end).withColumn("complete", ~(short | open_end))
