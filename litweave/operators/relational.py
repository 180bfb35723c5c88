"""Relational enrichment: id mapping, semi and anti joins, preferences, coverage, merges.

Results have a total order wherever one row is chosen. Choices are aggregates over structs rather than windows, so they combine
before the shuffle and a hot key never meets in one task. Joins are left to the optimizer; id lists are distinct
before a join, and no side is broadcast by hint.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from litweave.functions.text import dump_json, merge_values, read_json


def rows_with_ids(rows: DataFrame, column: str, ids: DataFrame, id_column: str) -> DataFrame:
    """Rows whose column is among the ids; one semi join in place of batches of IN lists."""
    return rows.join(ids.select(F.col(id_column).alias(column)).dropna().distinct(), column, "left_semi")


def without_children(rows: DataFrame, column: str, links: DataFrame, child: str) -> DataFrame:
    """Rows whose column is not the child of anything."""
    return rows.join(links.select(F.col(child).alias(column)).dropna().distinct(), column, "left_anti")


def map_ids(rows: DataFrame, mapping: DataFrame, key: str) -> DataFrame:
    """Rows joined to the distinct mapping on key; a key with several targets multiplies its rows."""
    return rows.join(mapping.distinct(), key)


def best_per_key(rows: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The row of each key that is smallest in `order`, which must be total."""
    rest = [c for c in rows.columns if c not in keys]
    if not rest:
        return rows.distinct()
    best = F.min_by(F.struct(*rest), F.struct(*(o.alias(f"o{i}") for i, o in enumerate(order))))
    return rows.groupBy(*keys).agg(best.alias("_best")).select(*keys, "_best.*")


def filled_count(rows: DataFrame, counts: DataFrame, key: str, column: str) -> DataFrame:
    """Rows with their count, 0 where there is none."""
    return rows.join(counts.select(key, column), key, "left").fillna({column: 0})


def union_branches(*branches: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, branches)


def last_wins(rows: DataFrame, key: list[str], value: str, position: Column) -> DataFrame:
    """A dictionary filled row by row: the value at the last position of each key."""
    return rows.groupBy(*key).agg(F.max_by(value, position).alias(value))


def fallback_lookup(rows: DataFrame, entries: DataFrame, name: str, kind: str, value: str) -> DataFrame:
    """The value for (name, kind), else for (name, ''), else the only one that the name has under any kind."""
    e = entries.select(name, F.coalesce(kind, F.lit("")).alias(kind), value)
    exact = e.select(name, kind, F.col(value).alias("_exact"))
    general = e.where(F.col(kind) == "").select(name, F.col(value).alias("_general"))
    only = e.groupBy(name).agg(F.countDistinct(kind).alias("_n"), F.min(value).alias("_only")).where("_n = 1").drop("_n")
    met = rows.join(exact, [name, kind], "left").join(general, name, "left").join(only, name, "left")
    return met.withColumn(value, F.coalesce("_exact", "_general", "_only")).drop("_exact", "_general", "_only")


def retype(rows: DataFrame, success: DataFrame, key: list[str], column: str, new: str) -> DataFrame:
    """Rows with `column` set to `new` where the key was resolved."""
    hit = success.select(*key).distinct().withColumn("_hit", F.lit(True))
    return rows.join(hit, key, "left").withColumn(column, F.when(F.col("_hit"), F.lit(new)).otherwise(F.col(column))).drop("_hit")


def merge_first_wins(old: DataFrame, new: DataFrame, key: list[str], fill: list[str]) -> DataFrame:
    """Old entries and those new by key; where an old one lacks a value in `fill`, the new one's is taken."""
    n = new.select(*key, *(F.col(c).alias(f"_{c}") for c in fill))
    return old.select(*key, *fill).join(n, key, "full").select(*key, *(F.coalesce(c, f"_{c}").alias(c) for c in fill))


def insert_or_ignore(into: DataFrame, rows: DataFrame, key: list[str]) -> DataFrame:
    return into.unionByName(rows.dropDuplicates(key).join(into.select(*key), key, "left_anti"))


def in_all(rows: DataFrame, item: str, group: str, groups: list[str]) -> DataFrame:
    """Items that occur in every one of the groups, with the last position of each left to the caller."""
    return rows.where(F.col(group).isin(groups)).groupBy(item).agg(F.countDistinct(group).alias("_n")).where(F.col("_n") == len(groups)).select(item)


def multimap(keys: Column, values: Column, rows: DataFrame, split: list[str] | None = None) -> DataFrame:
    """(key, value) pairs in long form: keys split by each delimiter in turn, trimmed, in small letters, without 'nan'."""
    parts = F.concat(*(F.split(keys, rf"\Q{d}\E") for d in split)) if split else F.array(keys)
    pairs = rows.select(F.explode(parts).alias("key"), values.alias("value")).withColumn("key", F.lower(F.trim("key")))
    return pairs.where((F.col("key") != "") & (F.col("key") != "nan"))


def longest_per_key(rows: DataFrame, key: str, text: str, tie: str) -> DataFrame:
    """The longest text of each key, the first by `tie` among equals; null counts as empty."""
    return best_per_key(rows.select(*dict.fromkeys((key, text, tie))), [key], -F.length(F.coalesce(text, F.lit(""))), F.col(tie))


def budgeted(rows: DataFrame, group: str, order: str, text: str, budget: int, most: int) -> DataFrame:
    """The first rows of each group whose texts, each with a line end, fit a budget of characters."""
    w = Window.partitionBy(group).orderBy(order)
    so_far = F.sum(F.length(text) + 1).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("used", so_far).withColumn("place", F.row_number().over(w)).where((F.col("used") <= budget) & (F.col("place") <= most))


def running_history(rows: DataFrame, group: str, order: str, text: str) -> DataFrame:
    """Each row with all earlier texts of its group joined by spaces."""
    w = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("history", F.array_join(F.collect_list(text).over(w), " "))


def keyword_search(rows: DataFrame, keywords: list[str], columns: list[str], regex: bool = False, case: bool = False) -> DataFrame:
    """Rows in which each keyword stands in at least one of the columns."""

    def has(c: str, k: str) -> Column:
        col = F.coalesce(F.col(c), F.lit(""))
        if regex:
            return col.rlike(k if case else f"(?i){k}")
        return F.instr(col, k) > 0 if case else F.instr(F.lower(col), k.lower()) > 0

    every = [reduce(Column.__or__, [has(c, k) for c in columns]) for k in keywords]
    return rows.where(reduce(Column.__and__, every, F.lit(True)))


def folded_json(rows: DataFrame, keys: list[str], order: str, text: str) -> DataFrame:
    """(keys, text): the JSON texts of each key deep-merged in order, later ones over earlier ones; see `text.merge_values`.

    Unreadable and null texts count as absent, a key without any other has null; rows with a null key are left out. Equal
    places in the order are taken by text. The rows of a key come sorted in batches and only its merged value is held.
    """
    schema = rows.select(*keys).schema.add(text, "string")

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last: tuple | None = None
        value: object = None
        for b in batches:
            done = []
            for *key, t in zip(*(b[k] for k in keys), b[text]):
                if last is not None and tuple(key) != last:
                    done.append((*last, dump_json(value)))
                    value = None
                last = tuple(key)
                over = read_json(t)
                value = value if over is None else over if value is None else merge_values(value, over)
            yield pd.DataFrame(done, columns=[*keys, text])
        if last is not None:
            yield pd.DataFrame([(*last, dump_json(value))], columns=[*keys, text])

    r = rows.select(*keys, order, text).dropna(subset=keys).repartition(*keys).sortWithinPartitions(*keys, order, text)
    return r.select(*keys, text).mapInPandas(each, schema)
