"""Protein flat files: features, cross-references and sequences, one record per entry.

Records are split by the reader on their end line, so large files are read in parallel where their codec allows. Within a record,
features are folded over the lines by higher-order functions. `clean` readings give each feature its own note and evidence;
`compat` readings let a later note overwrite that of the last feature with a range, as the line-by-line reading does.

Defined results: records without an accession give nothing; a missing note or evidence is an empty string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def entries(spark: SparkSession, path: str) -> DataFrame:
    """(lines) of each record, without carriage returns."""
    text = spark.read.text(path, lineSep="\n//").select(F.regexp_replace("value", r"\r", "").alias("v"))
    ls = F.filter(F.split("v", "\n"), lambda x: (x != "") & (x != "//"))
    return text.select(ls.alias("lines")).where(F.size("lines") > 0)


def tagged(lines: Column | str, tag: str) -> Column:
    """What stands on the lines of a tag."""
    c = F.col(lines) if isinstance(lines, str) else lines
    return F.transform(F.filter(c, lambda x: x.startswith(f"{tag}   ")), lambda x: F.substr(x, F.lit(6)))


def accessions(lines: str) -> Column:
    """All accessions of a record, in order."""
    joined = F.array_join(tagged(lines, "AC"), " ")
    return F.filter(F.transform(F.split(joined, ";"), lambda x: F.trim(x)), lambda x: x != "")


def first_of_last_ac(lines: str) -> Column:
    last = F.try_element_at(tagged(lines, "AC"), F.lit(-1))
    return F.trim(F.get(F.split(last, ";"), F.lit(0)))


def features(spark: SparkSession, path: str, compat: bool = False) -> DataFrame:
    """(accession, feature_type, start_pos, end_pos, note, evidence) of features with a range."""
    ft = F.transform(tagged("lines", "FT"), lambda x: F.regexp_replace(F.rtrim(x), r"\.$", ""))
    range_at = r"^(\S+)\s+(\d+)\.\.(\d+)\s*$"
    starts = r"^\S+\s"
    kind = "array<struct<t:string,a:string,b:string,n:string,e:string>>"
    begin = F.struct(F.array().cast(kind).alias("done"), F.lit(False).alias("open"))

    def add(state: Column, line: Column) -> Column:
        is_range, is_start = line.rlike(range_at), line.rlike(starts)
        new = F.struct(
            F.regexp_extract(line, range_at, 1).alias("t"), F.regexp_extract(line, range_at, 2).alias("a"), F.regexp_extract(line, range_at, 3).alias("b"),
            F.lit("").alias("n"), F.lit("").alias("e"),
        )
        note, evidence = F.regexp_extract(line, r'/note="([^"]*)"\s*$', 1), F.regexp_extract(line, r'/evidence="([^"]*)"\s*$', 1)
        last = F.try_element_at(state["done"], F.lit(-1))
        fixed = F.struct(
            last["t"].alias("t"), last["a"].alias("a"), last["b"].alias("b"), F.when(line.contains("/note="), note).otherwise(last["n"]).alias("n"),
            F.when(line.contains("/evidence="), evidence).otherwise(last["e"]).alias("e"),
        )
        whole = line.rlike(r'/(?:note|evidence)="[^"]*"\s*$')
        takes = whole & (F.size(state["done"]) > 0) & (F.lit(True) if compat else state["open"])
        changed = F.concat(F.slice(state["done"], F.lit(1), F.greatest(F.size(state["done"]) - 1, F.lit(0))), F.array(fixed))
        done = F.when(is_range, F.concat(state["done"], F.array(new))).when(~is_start & takes, changed).otherwise(state["done"])
        return F.struct(done.cast(kind).alias("done"), F.when(is_range, True).when(is_start, False).otherwise(state["open"]).alias("open"))

    rows = entries(spark, path).select(first_of_last_ac("lines").alias("accession"), F.aggregate(ft, begin, add)["done"].alias("f")).where("accession is not null")
    return rows.select("accession", F.inline("f")).select("accession", F.col("t").alias("feature_type"), F.col("a").cast("int").alias("start_pos"), F.col("b").cast("int").alias("end_pos"), F.col("n").alias("note"), F.col("e").alias("evidence"))


def cross_references(spark: SparkSession, path: str) -> DataFrame:
    """(accession, db_name, db_id, description, evidence), each line for every accession of its record."""
    rows = entries(spark, path).select(F.explode(accessions("lines")).alias("accession"), tagged("lines", "DR").alias("dr"))
    parts = rows.select("accession", F.explode("dr").alias("l")).select("accession", F.transform(F.split(F.regexp_replace(F.rtrim("l"), r"\.$", ""), ";"), lambda x: F.trim(x)).alias("p"))
    return parts.where(F.size("p") >= 2).select("accession", *(F.coalesce(F.get("p", F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(("db_name", "db_id", "description", "evidence"))))


def sequences(spark: SparkSession, path: str) -> DataFrame:
    """(accession, length, mol_weight, crc64, sequence)."""
    head = r"SEQUENCE\s+(\d+)\s+AA;\s+(\d+)\s+MW;\s+([0-9A-Fa-f]+)\s+CRC64"
    rows = entries(spark, path).select(first_of_last_ac("lines").alias("accession"), F.get(tagged("lines", "SQ"), F.lit(0)).alias("sq"), F.filter("lines", lambda x: x.startswith("     ")).alias("body"))
    return rows.where("accession is not null and sq is not null").select(
        "accession", F.regexp_extract("sq", head, 1).try_cast("int").alias("length"), F.regexp_extract("sq", head, 2).try_cast("int").alias("mol_weight"),
        F.regexp_extract("sq", head, 3).alias("crc64"), F.regexp_replace(F.array_join("body", ""), "[^A-Z]", "").alias("sequence"),
    )
