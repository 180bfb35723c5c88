"""Staged dataflow: an append-only log of what each stage did, and gating on all upstream stages.

The log has (stage, item, event, at): event is 'queued', 'done', 'failed' or 'removed'; the latest event of a (stage, item) counts.
Nothing is changed in place, so re-running a stage or losing an executor changes nothing. A claim takes a whole batch: all items
done upstream in every required stage and not yet done here. Failed items count as done, as upstream work must not block.

Defined results: null stages or items are ignored; repeated events count once; of events at the same time 'removed' loses.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LOG = "stage string, item bigint, event string, at timestamp"
ENDED = ("done", "failed")


def event(rows: DataFrame, stage: str, kind: str, at: Column | None = None) -> DataFrame:
    """Log rows for rows(item)."""
    return rows.select(F.lit(stage).alias("stage"), F.col("item").cast("bigint").alias("item"), F.lit(kind).alias("event"), (F.current_timestamp() if at is None else at).alias("at"))


def state(log: DataFrame) -> DataFrame:
    """(stage, item, event, at): the latest event of each; an aggregate, so it combines before the shuffle."""
    order = F.struct("at", (F.col("event") != "removed").cast("int").alias("r"), "event")
    return log.dropna(subset=["stage", "item"]).groupBy("stage", "item").agg(F.max_by("event", order).alias("event"), F.max("at").alias("at"))


def ended(log: DataFrame, stage: str) -> DataFrame:
    """(item, at) done or failed in a stage."""
    return state(log.where(F.col("stage") == stage)).where(F.col("event").isin(*ENDED)).select("item", "at")


def done_in_order(log: DataFrame, stage: str) -> DataFrame:
    return ended(log, stage).orderBy("at", "item")


def count_done(log: DataFrame, stage: str, items: DataFrame) -> DataFrame:
    return ended(log, stage).join(items.select("item").distinct(), "item", "left_semi").agg(F.count("*").alias("n"))


def queued(log: DataFrame, stages: list[str]) -> DataFrame:
    """(item, at) queued in every stage, the last time it was."""
    now = state(log.where(F.col("stage").isin(stages))).where(F.col("event") == "queued")
    return now.groupBy("item").agg(F.count("*").alias("n"), F.max("at").alias("at")).where(F.col("n") == len(stages)).select("item", "at")


def ready(log: DataFrame, upstream: list[str], stage: str, targets: DataFrame | None = None) -> DataFrame:
    """(item, at) ended in all upstream stages and not in this one, first come first."""
    up = state(log.where(F.col("stage").isin(upstream))).where(F.col("event").isin(*ENDED))
    complete = up.groupBy("item").agg(F.count("*").alias("n"), F.max("at").alias("at")).where(F.col("n") == len(upstream)).select("item", "at")
    complete = complete.join(ended(log, stage).select("item"), "item", "left_anti")
    if targets is not None:
        complete = complete.join(targets.select("item").distinct(), "item", "left_semi")
    return complete


def claim(log: DataFrame, upstream: list[str], stage: str, most: int | None = None) -> DataFrame:
    """Ready items in the order in which their last upstream stage ended."""
    out = ready(log, upstream, stage).orderBy("at", "item")
    return out if most is None else out.limit(most)


def seed(log: DataFrame, source: str, stage: str) -> DataFrame:
    """Log rows that queue what the source stage has ended and this stage has not seen."""
    known = log.where(F.col("stage") == stage).select("item").distinct()
    return event(ended(log, source).join(known, "item", "left_anti"), stage, "queued")


def digest(*columns: str) -> Column:
    """What an item's input is told by: a digest of its columns, nulls included."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def changed(items: DataFrame, before: DataFrame) -> DataFrame:
    """items(item, digest, ...) that were not done with this very input; before(item, digest) is what was done.

    An item whose input is another than last time is done again, one with the same input is skipped, null items are ignored.
    """
    return items.dropna(subset=["item"]).join(before.select("item", "digest").distinct(), ["item", "digest"], "left_anti")


@dataclass(frozen=True)
class Stage:
    """A stage of the dataflow: run(items) returns (item, ok, ...) for each item."""

    name: str
    upstream: tuple[str, ...]
    run: Callable[[DataFrame], DataFrame]


def in_order(stages: list[Stage]) -> list[Stage]:
    """Stages with those they need before them; a circle raises."""
    names, out, left = {s.name for s in stages}, [], list(stages)
    while left:
        free = [s for s in left if all(u not in names or any(u == o.name for o in out) for u in s.upstream)]
        if not free:
            raise ValueError("stages need each other in a circle: " + ", ".join(s.name for s in left))
        out += free
        left = [s for s in left if s not in free]
    return out


def run_batch(spark: SparkSession, log_path: str, stages: list[Stage], targets: DataFrame | None = None) -> dict[str, int]:
    """Run every stage once over what is ready, in order, each result appended to the log; how many items each one took."""
    took = {}
    for s in in_order(stages):
        log = spark.read.schema(LOG).parquet(log_path)
        items = ready(log, list(s.upstream), s.name, targets).select("item")
        result = s.run(items).select(F.lit(s.name).alias("stage"), "item", F.when(F.col("ok"), "done").otherwise("failed").alias("event"), F.current_timestamp().alias("at"))
        before = log.where(F.col("stage") == s.name).count()
        result.write.mode("append").parquet(log_path)
        took[s.name] = spark.read.schema(LOG).parquet(log_path).where(F.col("stage") == s.name).count() - before
    return took


def gate_stream(spark: SparkSession, source: str, upstream: list[str], stage: str, out: str, checkpoint: str, run: Callable[[DataFrame], DataFrame] | None = None):
    """A Structured Streaming query over the log's files: each micro-batch folds its events into the state of the batch before
    (the latest event of each stage and item, at `out`/state) and appends what has become ready to `out`/ready, each item once.
    A batch reads its own events and one state, however long the stream; one that runs again after a failure replaces its own files.
    """
    passed = f"{stage} passed"

    def step(batch: DataFrame, number: int) -> None:
        log = batch.select("stage", "item", "event", "at")
        if number:
            log = log.unionByName(spark.read.schema(LOG).parquet(f"{out}/state/batch={number - 1}"))
        new = ready(log, upstream, stage).join(ended(log, passed).select("item"), "item", "left_anti")
        (run(new) if run else new).write.mode("overwrite").parquet(f"{out}/ready/batch={number}")
        gone = spark.read.schema("item bigint, at timestamp").parquet(f"{out}/ready/batch={number}")
        state(log.unionByName(event(gone, passed, "done", F.col("at")))).write.mode("overwrite").parquet(f"{out}/state/batch={number}")

    stream = spark.readStream.schema(LOG).option("maxFilesPerTrigger", 4).parquet(source)
    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
