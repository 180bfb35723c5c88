"""Files by name pattern, tab-separated text, and delimited tables with a header.

Text is split rather than read as CSV, so that an inner empty cell stays an empty string. One trailing empty cell is dropped; empty
lines are skipped; a carriage return stays. Missing or unreadable files give an error unless `safe`.
"""

from __future__ import annotations

import csv
import gzip
import io

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def find_files(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """(path) of all files below a folder whose whole name matches; only paths are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.select("path").where(F.try_element_at(F.split("path", "/"), F.lit(-1)).rlike(f"^(?:{pattern})$"))


def lines(spark: SparkSession, path: str | list[str], safe: bool = False) -> DataFrame:
    reader = spark.read.option("ignoreMissingFiles", safe).option("ignoreCorruptFiles", safe).option("recursiveFileLookup", True)
    if safe and isinstance(path, str) and not exists(spark, path):
        return spark.createDataFrame([], "line string, path string")
    return reader.text(path, lineSep="\n").select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("path"))


def data_lines(rows: DataFrame, header: str) -> DataFrame:
    """lines(line, path) without the header line that stands first in a file; rows that repeat it further down stay.

    Only where a file has the header at all is it looked up which line of it comes first, from the place of each such line in its file.
    """
    placed = rows.withColumn("_at", F.monotonically_increasing_id())
    first = placed.where(F.col("line") == header).groupBy("path").agg(F.min("_at").alias("_at")).withColumn("_first", F.lit(True))
    return placed.join(first, ["path", "_at"], "left").where(F.col("_first").isNull()).drop("_at", "_first")


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p))


def cells(line: Column, sep: str = "\t") -> Column:
    parts = F.split(line, sep, -1)
    return F.when((F.size(parts) > 1) & (F.try_element_at(parts, F.lit(-1)) == ""), F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def read_tsv(spark: SparkSession, path: str | list[str], safe: bool = False) -> DataFrame:
    """(path, cells) of all lines that are not empty."""
    return lines(spark, path, safe).where(F.col("line") != "").select("path", cells(F.col("line")).alias("cells"))


def as_double(row: Column) -> Column:
    """Each cell's number, of its beginning if more follows; 0.0 if there is none."""
    number = r"^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)"
    return F.transform(row, lambda c: F.coalesce(F.regexp_extract(c, number, 1).try_cast("double"), F.lit(0.0)))


def as_int(row: Column) -> Column:
    return F.transform(row, lambda c: F.coalesce(F.regexp_extract(c, r"^\s*([+-]?\d+)", 1).try_cast("int"), F.lit(0)))


def header_of(spark: SparkSession, path: str) -> str:
    """The first line of the first file, read by the driver alone."""
    first = spark.read.text(path, lineSep="\n").limit(1).first()
    return first["value"] if first else ""


def sniffed(header: str) -> str:
    return "\t" if "\t" in header else "," if "," in header else "\t"


def clean_header(names: list[str]) -> list[str]:
    return [n.strip().strip('"').replace("#", "").strip() for n in names]


def read_table(spark: SparkSession, path: str, header: list[str] | None = None) -> DataFrame:
    """A delimited table, gzipped or not, all columns text: delimiter found from the header, # taken off names, backslashes
    deleted. With a header given, the first line is data."""
    first = header_of(spark, path)
    sep = sniffed(first)
    names = header or clean_header(next(csv.reader(io.StringIO(first), delimiter=sep), []))
    rows = lines(spark, path).where(F.col("line") != "")
    if header is None:
        rows = data_lines(rows, first)
    if sep == ",":
        parsed = F.from_csv(F.regexp_replace("line", r"\\", ""), ", ".join(f"`{n}` string" for n in names), {"sep": ",", "quote": '"'})
        return rows.select(parsed.alias("r")).select("r.*")
    parts = F.split(F.regexp_replace("line", r"\\", ""), sep, -1)
    return rows.select(*(F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(names)))


def read_many(spark: SparkSession, paths: list[str], safe: bool = True) -> DataFrame:
    """Tables of one header from many files: the header of the first, header lines at the top of later ones dropped, missing cells null."""
    found = [p for p in paths if not safe or exists(spark, p)]
    first = next((h for p in found if (h := header_of(spark, p))), "")
    names = clean_header(first.split("\t"))
    rows = data_lines(lines(spark, found).where(F.col("line") != ""), first).select(cells(F.col("line")).alias("c"))
    return rows.select(*(F.get("c", F.lit(i)).alias(n) for i, n in enumerate(names)))


def write_lines_gz(path: str, rows: list[str]) -> None:
    """For tests and small exports."""
    with gzip.open(path, "wt", encoding="utf-8") as f:
        f.write("\n".join(rows) + "\n")
