"""Artifact tables and their life: read, list, upsert by key, delete, write in the layouts that later reads prune by."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from litweave.functions.prompts import prompt  # noqa: F401  prompts are sources too
from litweave.operators.models import RateLimiter, retried
from litweave.session import new_path, remove, rename


def get_table(spark: SparkSession, name: str, limit: int | None = None) -> DataFrame:
    df = spark.table(name)
    return df if limit is None else df.limit(limit)


def look_up(rows: DataFrame, column: str, value: object) -> DataFrame:
    """Equality filter, pushed to the scan."""
    return rows.where(F.col(column) == F.lit(value))


def execute(spark: SparkSession, sql: str) -> DataFrame:
    return spark.sql(sql)


def artifact(files: DataFrame, name: str) -> DataFrame:
    """Artifacts of a name with `value`, the content as JSON; null if it is not JSON, while content stays."""
    return files.where(F.col("name") == name).withColumn("value", F.try_parse_json("content"))


def has(files: DataFrame, keys: DataFrame, name: str) -> DataFrame:
    """keys(pmid) with exists."""
    there = files.where(F.col("name") == name).select("pmid").distinct().withColumn("_there", F.lit(True))
    return keys.join(there, "pmid", "left").withColumn("exists", F.coalesce("_there", F.lit(False))).drop("_there")


def listed(files: DataFrame) -> DataFrame:
    """(pmid, name) sorted."""
    return files.select("pmid", "name").distinct().orderBy("pmid", "name")


def counted(files: DataFrame) -> DataFrame:
    return files.groupBy("name").agg(F.count("*").alias("n"))


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of new in place of those of old with the same key."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def without(files: DataFrame, names: list[str]) -> DataFrame:
    return files.where(~F.coalesce(F.col("name").isin(names), F.lit(False)))


def as_content(rows: DataFrame, column: str) -> Column:
    """A column as content: structs, arrays, maps and variants as JSON, all else as text; null stays null."""
    kind = rows.select(column).schema[0].dataType
    if isinstance(kind, (StructType, ArrayType, MapType, VariantType)):
        return F.to_json(F.col(column))
    return F.col(column).cast("string")


POINTER = "_current"


def replace_table(df: DataFrame, path: str) -> None:
    """Replace a table that `read_replaced` reads, so that readers see the old rows or the new ones at any moment.

    The rows are written as a new version below the path; then the pointer, an empty file named after the version, is put down by
    one rename, the highest being the current one. Versions before the one replaced are removed, as readers may still be at that.
    """
    spark = df.sparkSession
    known = versions(spark, path)
    version = (known[-1] if known else 0) + 1
    df.write.mode("overwrite").parquet(f"{path}/v{version:012d}")  # what a failed attempt left there is no version yet
    mark = new_path(spark, "pointer")
    files, conf = spark._jvm.org.apache.hadoop.fs.Path(mark), spark.sparkContext._jsc.hadoopConfiguration()
    files.getFileSystem(conf).create(files).close()
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{POINTER}")
    place.getFileSystem(conf).mkdirs(place)
    rename(spark, mark, f"{path}/{POINTER}/{version:012d}")
    for old in known[:-1]:
        remove(spark, f"{path}/v{old:012d}")
        remove(spark, f"{path}/{POINTER}/{old:012d}")


def versions(spark: SparkSession, path: str) -> list[int]:
    """The versions that were put down, in order."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{POINTER}")
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(int(f.getPath().getName()) for f in files.listStatus(place) if f.getPath().getName().isdigit()) if files.exists(place) else []


def read_replaced(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a table written by `replace_table`."""
    known = versions(spark, path)
    if not known:
        raise FileNotFoundError(path)
    return spark.read.parquet(f"{path}/v{known[-1]:012d}")


def write_pruned(df: DataFrame, path: str, partition: list[str] | None = None, sort: list[str] | None = None, rows_per_file: int = 5_000_000) -> None:
    """Parquet by a column of few values and sorted within files, in the place of secondary and partial indexes."""
    out = df.repartition(*(F.col(c) for c in partition)) if partition else df
    out = out.sortWithinPartitions(*(partition or []), *sort) if sort else out
    w = out.write.option("maxRecordsPerFile", rows_per_file).mode("overwrite")
    (w.partitionBy(*partition) if partition else w).parquet(path)


def append_table(df: DataFrame, name: str, rows_per_file: int = 5_000_000) -> None:
    """Append to a table; a job's rows come in together or not at all."""
    df.write.option("maxRecordsPerFile", rows_per_file).mode("append").saveAsTable(name)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def write_bucketed(df: DataFrame, name: str, column: str, buckets: int) -> None:
    """A table bucketed and sorted by a join key, so that later joins on it need no shuffle."""
    df.write.bucketBy(buckets, column).sortBy(column).mode("overwrite").saveAsTable(name)


def write_abstracts(rows: DataFrame, path: str) -> None:
    """pmid and one-line content, tab-separated."""
    rows.select("pmid", F.translate("abstract", "\r\n\t", "   ").alias("content")).write.mode("overwrite").csv(path, sep="\t", header=True, quote="", escape="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def read_folders(spark: SparkSession, root: str, name: str) -> DataFrame:
    """(pmid, path, content) of the files of one name below root, the folder being the pmid."""
    rows = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", name).text(root, wholetext=True)
    path = F.col("_metadata.file_path")
    return rows.select(F.regexp_extract(path, r"([^/]+)/[^/]+$", 1).alias("pmid"), path.alias("path"), F.col("value").alias("content"))


@dataclass(frozen=True)
class IndexConfig:
    """Where an index table lies and which of its columns are searched."""

    path: str
    vector: str = "vector"
    sparse: str = "sparse"
    label: str = "label"

    def save(self, file: str) -> None:
        with open(file, "w", encoding="utf-8") as f:
            json.dump(asdict(self), f)

    @classmethod
    def load(cls, file: str) -> IndexConfig:
        with open(file, encoding="utf-8") as f:
            return cls(**json.load(f))


def remote_search(queries: DataFrame, column: str, search: Callable[[str, int], list[dict]], k: int = 30, calls: int = 5, seconds: float = 1.0, tasks: int = 1, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """(query, rank, id, name, description) from an injected client: each distinct query once, at most `calls` in `seconds` per task,
    retried with growing pauses; `tasks` bounds the rate over all."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        limiter = RateLimiter(calls, seconds)
        for b in batches:
            out = []
            for q in b["query"]:
                limiter.wait()
                hits = retried(lambda q=q: search(q, k), sleep=sleep)
                out += [(q, i + 1, h.get("id"), h.get("name"), h.get("description")) for i, h in enumerate(hits[:k])]
            yield pd.DataFrame(out, columns=["query", "rank", "id", "name", "description"])

    return queries.select(F.col(column).alias("query")).dropna().distinct().coalesce(tasks).mapInPandas(each, "query string, rank int, id string, name string, description string")


# The ten classes of chemical-protein relations under their public names (ChemProt corpus of BioCreative VI).
CPR = (
    ("CPR:1", "PART_OF", "The chemical is a part of the protein."),
    ("CPR:2", "REGULATOR", "The chemical regulates the protein, directly or not."),
    ("CPR:3", "UPREGULATOR", "The chemical raises or activates the protein, directly or not."),
    ("CPR:4", "DOWNREGULATOR", "The chemical lowers or inhibits the protein, directly or not."),
    ("CPR:5", "AGONIST", "The chemical is an agonist of the protein."),
    ("CPR:6", "ANTAGONIST", "The chemical is an antagonist of the protein."),
    ("CPR:7", "MODULATOR", "The chemical modulates the protein."),
    ("CPR:8", "COFACTOR", "The chemical is a cofactor of the protein."),
    ("CPR:9", "SUBSTRATE_OR_PRODUCT", "The chemical is a substrate or a product of what the protein does."),
    ("CPR:10", "NOT", "The text says that there is no such relation."),
)


def relation_classes(spark: SparkSession, k: int = 10) -> DataFrame:
    """The first k classes in their order, as search hits: id, name, description, rank."""
    rows = [(i + 1, *c) for i, c in enumerate(CPR)]
    return spark.createDataFrame(rows, "rank int, id string, name string, description string").where(F.col("rank") <= k)
