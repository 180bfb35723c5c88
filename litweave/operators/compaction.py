"""Far too many small files: consolidate their records into few well-sized files, each complete record exactly once.

1. Freeze a manifest: id, size and checksum of every file as of now, and in how many copies it is given, written to the shared folder.
2. Bin-pack it by size with first-fit decreasing. The manifest is dealt by hash into shards of about `SHARD_BINS` bins and at most
   about `SHARD_FILES` files each, so packing is parallel and no task sees the whole list; a shard ends with at most one bin less than half full.
3. Parse the files into records where they lie, keep each record id once (partial aggregation before the shuffle) and write
   the records of each bin as one file, in a folder of its own, into a staging folder. A record finds its bin by id and checksum of its
   file, so nothing goes in but what the manifest froze.
4. Verify: the files parsed must be those of the manifest, checksum by checksum, and rows and an order-free checksum of what was read
   back must equal those of what was parsed.
5. Commit: one rename of the staging folder to its final name.

Format is taken from the content, never from the name: JSON (one object, objects in a list or one after the other) or
tab-separated text under a header line. A JSON record is complete if it closes, a tab-separated one if it has as many cells
as its header. Defined results: null, empty and blank files, header lines, blank lines, empty objects and records without a
non-blank rid give nothing; what is cut off at the end of a file spoils nothing before it. Of the copies of one rid the
latest written wins (then the higher file id). Rows of files that repeat count as one file. A byte order mark, a leading # in the header and CR line ends do not count.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from litweave.functions import deepjson
from litweave.session import new_path, remove, rename

TARGET_BYTES = 128 << 20
SHARD_BINS = 16
SHARD_FILES = 200_000
BINS_A_TASK = 8
LEAST_BYTES = 64
RECORD = "file_id bigint, checksum bigint, at timestamp_ntz, rec_no int, rid string, record string"
WRITTEN = "rid string, record string, bin bigint"


def json_records(text: str) -> Iterator[dict]:
    """Objects that close, at the top or in a list; after a broken one, reading goes on at the next line that begins one."""
    at, n = 0, len(text)
    while at < n:
        if text[at] != "{":
            at = at + 1 if text[at] in "[], \t\r\n" else nxt if (nxt := text.find("{", at)) >= 0 else n
            continue
        try:
            value, at = deepjson.raw_decode(text, at)
            yield value
        except ValueError:
            nxt = text.find("\n{", at)
            at = n if nxt < 0 else nxt + 1


def tsv_records(text: str) -> Iterator[dict]:
    header: list[str] | None = None
    for line in text.split("\n"):
        line = line.removesuffix("\r").lstrip("\N{ZERO WIDTH NO-BREAK SPACE}")
        if not line.strip():
            continue
        cells = line.split("\t")
        names = [c.strip() for c in cells]
        names[0] = names[0].lstrip("#").strip()
        if header is None or "rid" in names:  # files put together bring their header lines along
            header = names
        elif len(cells) == len(header):
            yield dict(zip(header, cells))


def records(text: str | None) -> list[tuple[str, str]]:
    """(rid, record as JSON) of the complete records of one file, in order."""
    if text is None:
        return []
    body = text.lstrip("﻿ \t\r\n")
    out = []
    for r in json_records(body) if body[:1] in ("{", "[") else tsv_records(text.lstrip("﻿")):
        rid = r.get("rid")
        rid = rid.strip() if isinstance(rid, str) else None if rid is None or isinstance(rid, (dict, list, bool)) else str(rid)
        if rid:
            out.append((rid, deepjson.dumps(r)))
    return out


def given(files: DataFrame, written: str | None) -> DataFrame:
    """(file_id, content, at, checksum); a file without an id is known by its content."""
    at = F.col(written) if written else F.lit(None)
    sum_ = F.xxhash64(F.coalesce("content", F.lit("")))
    return files.select(F.coalesce(F.col("file_id").cast("bigint"), F.xxhash64("content")).alias("file_id"), "content", at.cast("timestamp_ntz").alias("at"), sum_.alias("checksum"))


def parse(files: DataFrame) -> DataFrame:
    """One row per complete record of each of the `given` files (columns RECORD)."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [(i, c, at, k, *r) for i, t, at, c in zip(b["file_id"], b["content"], b["at"], b["checksum"]) for k, r in enumerate(records(t))]
            yield pd.DataFrame(out, columns=["file_id", "checksum", "at", "rec_no", "rid", "record"])

    return files.where("content is not null").mapInPandas(each, RECORD)


def first_fit_decreasing(sizes: list[int], most: int) -> list[int]:
    """The bin of each size. First fit is found in a tree of the bins' free space, so packing takes n log n."""
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    leaves = 1
    while leaves < max(1, len(sizes)):
        leaves *= 2
    free = [most] * (2 * leaves)
    bins = [0] * len(sizes)
    for i in order:
        need = min(sizes[i], most)
        k = 1
        while k < leaves:
            k = 2 * k if free[2 * k] >= need else 2 * k + 1
        bins[i] = k - leaves
        free[k] -= need
        k //= 2
        while k:
            free[k] = max(free[2 * k], free[2 * k + 1])
            k //= 2
    return bins


def manifest(files: DataFrame) -> DataFrame:
    """(file_id, checksum, size, copies) of every file; size in bytes of one copy, LEAST_BYTES at least, as an empty file is an entry too."""
    size = F.greatest(F.octet_length(F.coalesce("content", F.lit(""))), F.lit(LEAST_BYTES)).cast("bigint")
    return files.groupBy("file_id", "checksum").agg(F.max(size).alias("size"), F.count("*").alias("copies"))


def tally(copies: Column) -> list[Column]:
    """Counts that two sets of files have in common only if they are the same, copies included; no order and no cancelling."""
    mark = F.pmod(F.xxhash64("file_id", "checksum"), F.lit(1 << 40))
    return [F.coalesce(F.sum(copies), F.lit(0)).alias("files"), F.coalesce(F.sum(copies * mark.cast("decimal(38,0)")), F.lit(0)).alias("marks")]


def pack(frozen: DataFrame, target_bytes: int = TARGET_BYTES, shard_bins: int = SHARD_BINS, shard_files: int = SHARD_FILES) -> DataFrame:
    """(file_id, checksum, bin) by first-fit decreasing within hash shards of about shard_bins bins or shard_files files."""
    total = frozen.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("size"), F.count("*").alias("n")).first()
    shards = max(1, round(total["size"] / (target_bytes * shard_bins)), -(-total["n"] // shard_files))
    dealt = frozen.withColumn("shard", F.pmod(F.xxhash64("file_id", "checksum"), F.lit(shards)).cast("int")).select("shard", "file_id", "checksum", "size")

    def each(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["size", "file_id", "checksum"], ascending=[False, True, True])
        bins = first_fit_decreasing(shard["size"].tolist(), target_bytes)
        return pd.DataFrame({"file_id": shard["file_id"], "checksum": shard["checksum"], "bin": [int(shard["shard"].iloc[0]) * (1 << 24) + b for b in bins]})

    return dealt.groupBy("shard").applyInPandas(each, "file_id bigint, checksum bigint, bin bigint")


@dataclass
class Commit:
    """Where the compacted records lie and what was verified."""

    path: str
    files: int
    bins: int
    rows: int
    checksum: int


def checked(df: DataFrame) -> tuple[int, int]:
    """(rows, checksum), the checksum free of order."""
    n, x = df.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("rid", "record")), F.lit(0))).first()
    return n, x


def distinct_records(parsed: DataFrame) -> DataFrame:
    """(rid, record, file_id, checksum): each rid once, from the file written last."""
    best = F.max_by(F.struct("record", "file_id", "checksum"), F.struct("at", "file_id", "rec_no")).alias("best")
    return parsed.groupBy("rid").agg(best).select("rid", "best.record", "best.file_id", "best.checksum")


def compact(files: DataFrame, target_bytes: int = TARGET_BYTES, target: str | None = None, written: str | None = "written_at") -> Commit:
    """Consolidate the records of files(file_id, content, written_at) and commit them at `target` in the shared folder."""
    spark = files.sparkSession
    target = target or new_path(spark, "compacted")
    staging = new_path(spark, "staging")
    frozen_at = f"{staging}/manifest"
    files = given(files, written)
    manifest(files).write.parquet(frozen_at)
    frozen = spark.read.parquet(frozen_at)
    bins = pack(frozen, target_bytes)
    bins.write.parquet(f"{staging}/bins")
    bins = spark.read.parquet(f"{staging}/bins")
    shape = bins.agg(F.count("*").alias("files"), F.countDistinct("bin").alias("bins")).first()
    if shape["files"] != frozen.count():
        raise ValueError("the manifest has files that were not packed")
    seen, taken = Observation(), Observation()
    unique = distinct_records(parse(files.observe(taken, *tally(F.lit(1)))))
    counted = unique.observe(seen, F.count(F.lit(1)).alias("rows"), F.coalesce(F.bit_xor(F.xxhash64("rid", "record")), F.lit(0)).alias("checksum"))
    placed = counted.join(bins, ["file_id", "checksum"]).select("rid", "record", "bin")
    tasks = max(1, min(shape["bins"], max(10_000, -(-shape["bins"] // BINS_A_TASK))))
    placed.repartition(tasks, "bin").sortWithinPartitions("bin", "rid").write.partitionBy("bin").parquet(f"{staging}/data")
    rows, checksum = checked(spark.read.schema(WRITTEN).parquet(f"{staging}/data"))
    # What is read is counted as it passes by; a stage that ran again after a loss may have been counted twice, so a difference
    # is looked into by reading anew.
    listed = frozen.agg(*tally(F.col("copies"))).first()
    if (listed["files"], listed["marks"]) != observed(taken, "files", "marks"):
        anew = files.agg(*tally(F.lit(1))).first()
        if (listed["files"], listed["marks"]) != (anew["files"], anew["marks"]):
            raise ValueError("the files read are not those of the manifest")
    if (rows, checksum) != observed(seen, "rows", "checksum") and (rows, checksum) != checked(distinct_records(parse(files))):
        raise ValueError("what was written is not what was read")
    rename(spark, f"{staging}/data", target)
    remove(spark, staging)
    return Commit(target, shape["files"], shape["bins"], rows, checksum)


def observed(what: Observation, *names: str) -> tuple | None:
    """What was counted in passing; None where the plan was empty, so that nothing ran."""
    try:
        return tuple(what.get[n] for n in names)
    except Py4JJavaError:
        return None
