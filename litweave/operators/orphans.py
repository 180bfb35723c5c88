"""References to records that do not exist.

All changes are signed deltas of two counts per key, of references and of existence: a row that refers to a key brings +1
reference at its time, a record +1 existence when it is loaded and -1 when it is retired. `epoch_counts` runs the existence deltas of
each key up to epochs with their count, puts every reference into the epoch of its key in which it falls, and folds: per
epoch the references and the existence. Epochs with positive references and no existence are the orphans, then and now;
`found_orphans` gives their rows, `orphan_report` their sums per table and month. `fold_counts` keeps the same counts per key without
epochs, for the current report, batch by batch.

The epochs of all keys are sent to the tasks where they are at most CORE_STEPS, which is counted; then references are not shuffled at all.
Else they are joined, and as a key may hold a third of all references, keys are counted first, by partial counts, and those with more than their share of a
task (HOT_PARTS a partition, so at most HOT_PARTS times the partitions of keys) are spread over as many salts as they have
shares; only their epochs are copied, and no other key is.

Defined results: ids are compared in key form (outer blanks trimmed, upper case); null and blank ids refer to nothing. A
record without loaded_at has always existed, one whose retired_at is not after its loaded_at never has. A row without a
time is an orphan only if its key never exists. Repeated records count once or more, to the same effect; repeated
rows are reported each. Empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from litweave.session import cut

# White space, no-break and zero-width blanks.
BLANKS = " \t\n\x0b\f\r\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000\ufeff" + "".join(map(chr, range(0x2000, 0x200C)))
HOT_PARTS = 4
CORE_STEPS = 500_000
EVER = "0001-01-01 00:00:00"


def key_form(column: Column | str) -> Column:
    """Outer blanks trimmed, upper case, blank as null."""
    c = F.col(column) if isinstance(column, str) else column
    k = F.upper(F.btrim(c, F.lit(BLANKS)))
    return F.when(k != "", k)


def base_accession(key: Column) -> Column:
    """An accession without its isoform suffix."""
    return F.when(key.contains("-"), F.regexp_replace(key, r"-\d+$", "")).otherwise(key)


def fold_counts(state: DataFrame, deltas: DataFrame, keys: tuple[str, ...] = ("key",)) -> DataFrame:
    """Fold deltas(keys, refs, exists) of signed counts into state of the same columns; keys back at zero leave it.

    Null counts are zero; null keys are ignored. Partial sums run before the shuffle, so a hot key moves one row a task.
    """
    counts = ["refs", "exists"]
    both = state.select(*keys, *counts).unionByName(deltas.select(*keys, *counts)).dropna(subset=list(keys))
    sums = both.groupBy(*keys).agg(*(F.sum(F.coalesce(c, F.lit(0))).cast("bigint").alias(c) for c in counts))
    return sums.where((F.col("refs") != 0) | (F.col("exists") != 0))


def current_orphans(state: DataFrame) -> DataFrame:
    """Keys with positive references and no existence."""
    return state.where((F.col("refs") > 0) & (F.col("exists") <= 0))


def existence_deltas(records: DataFrame, key: str, loaded: str, retired: str | None = None, *by: str) -> DataFrame:
    """(by, key, at, exists): +1 when a record is loaded and -1 when it is retired, summed per key and time."""
    gone = (F.col(retired) if retired else F.lit(None)).cast("timestamp_ntz")
    r = records.select(*by, key_form(key).alias("key"), F.coalesce(F.col(loaded).cast("timestamp_ntz"), F.lit(EVER).cast("timestamp_ntz")).alias("start"), gone.alias("end"))
    r = r.where(F.col("key").isNotNull() & (F.col("end").isNull() | (F.col("end") > F.col("start"))))
    steps = F.array(
        F.struct(F.col("start").alias("at"), F.lit(1).alias("by_")),
        F.struct(F.col("end").alias("at"), F.lit(-1).alias("by_")),
    )
    r = r.select(*by, "key", F.inline(steps)).where(F.col("at").isNotNull())
    return r.groupBy(*by, "key", "at").agg(F.sum("by_").alias("exists")).where(F.col("exists") != 0)


def epochs(deltas: DataFrame, *by: str) -> DataFrame:
    """(by, key, spans): the epochs of each key in order, each from its first moment on with the count of existence in it."""
    w = Window.partitionBy(*by, "key").orderBy("at")
    run = deltas.withColumn("n", F.sum("exists").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return run.groupBy(*by, "key").agg(F.array_sort(F.collect_list(F.struct(F.col("at").alias("from"), "n"))).alias("spans"))


def referring(rows: DataFrame, row_id: str, key: Column, at: str) -> DataFrame:
    """(row_id, key, at) of the rows that refer to something: each is a delta of +1 reference."""
    r = rows.select(F.col(row_id).alias("row_id"), key.alias("key"), F.col(at).cast("timestamp_ntz").alias("at"))
    return r.where(F.col("key").isNotNull())


def hot_keys(refs: DataFrame, by: list[str], hot_parts: int = HOT_PARTS) -> DataFrame:
    """(by, key, salts) of the keys with more references than a hot_parts-th of a partition's share."""
    parts = hot_parts * int(refs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = refs.count() / parts
    counts = refs.groupBy(*by, "key").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") > share).select(*by, "key", F.ceil(F.col("n") / max(share, 1.0)).cast("int").alias("salts"))


def placed(refs: DataFrame, deltas: DataFrame, by: tuple[str, ...] = (), hot_parts: int = HOT_PARTS, core_steps: int = CORE_STEPS) -> DataFrame:
    """refs(by, row_id, key, at) with the epoch each falls into, its first moment, and the existence in it; both of no record: null and 0.

    A reference without a time is placed into the epoch with the most existence.
    """
    on = [*by, "key"]
    spans = cut(epochs(deltas, *by))
    if spans.agg(F.coalesce(F.sum(F.size("spans")), F.lit(0))).first()[0] <= core_steps:
        met = refs.join(F.broadcast(spans), on, "left")
    else:
        spread = F.broadcast(cut(hot_keys(refs, list(by), hot_parts)))  # at most hot_parts times as many rows as there are partitions
        salts = F.coalesce("salts", F.lit(1))
        copied = spans.join(spread, on, "left").select(*on, "spans", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"))
        salted = refs.join(spread, on, "left").withColumn("salt", F.pmod(F.xxhash64("row_id", "at"), salts).cast("int")).drop("salts")
        met = salted.join(copied, [*on, "salt"], "left").drop("salt")
    timeless = F.array_max(F.transform("spans", lambda s: F.struct(s["n"].alias("n"), s["from"].alias("from"))))
    begun = F.filter("spans", lambda s: s["from"] <= F.col("at"))
    latest = F.try_element_at(begun, F.lit(-1))
    epoch = F.when(F.col("at").isNull(), timeless["from"]).otherwise(latest["from"])
    there = F.when(F.col("at").isNull(), timeless["n"]).otherwise(latest["n"])
    return met.select(*by, "row_id", "key", "at", epoch.alias("epoch"), F.coalesce(there, F.lit(0)).alias("exists"))


def epoch_counts(refs: DataFrame, deltas: DataFrame, by: tuple[str, ...] = (), core_steps: int = CORE_STEPS) -> DataFrame:
    """(by, key, epoch, refs, exists): the signed counts folded per key and epoch."""
    return placed(refs, deltas, by, core_steps=core_steps).groupBy(*by, "key", "epoch").agg(F.count("*").alias("refs"), F.first("exists").alias("exists"))


def found_orphans(refs: DataFrame, deltas: DataFrame, by: tuple[str, ...] = (), hot_parts: int = HOT_PARTS, core_steps: int = CORE_STEPS) -> DataFrame:
    """(by, row_id, key, at) of the references in epochs without existence; each is itself the positive reference of its epoch."""
    return placed(refs, deltas, by, hot_parts, core_steps).where("exists <= 0").select(*by, "row_id", "key", "at")


def orphan_rows(rows: DataFrame, row_id: str, key: Column, at: str, records: DataFrame, record_key: str, loaded: str, retired: str | None = None, hot_parts: int = HOT_PARTS, core_steps: int = CORE_STEPS) -> DataFrame:
    """(row_id, key, at) of the rows of one table whose key has no record at the row's time."""
    return found_orphans(referring(rows, row_id, key, at), existence_deltas(records, record_key, loaded, retired), (), hot_parts, core_steps)


def orphan_report(rows: DataFrame) -> DataFrame:
    """rows(src, key, at) of orphans to one row per table and month: orphan rows and keys."""
    per_key = rows.groupBy("src", F.date_format("at", "yyyy-MM").alias("period"), "key").agg(F.count("*").alias("n"))
    return per_key.groupBy("src", "period").agg(F.sum("n").alias("orphan_rows"), F.count("*").alias("orphan_keys"))
