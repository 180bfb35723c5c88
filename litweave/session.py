"""Session helpers: table loading, lineage cuts and the folder shared by all executors."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, partitions: int = 8, name: str = "litweave") -> SparkSession:
    """A session for tests and benches on one machine; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per context, so that their Python finds it wherever it was started."""
    context = spark.sparkContext
    if getattr(context, "_litweave_shipped", False):
        return
    root = Path(__file__).resolve().parent
    if root.parent.is_dir():  # not when run from a zip, which has been sent already
        folder = shared_dir(spark).removeprefix("file://")
        if "://" in folder or ":/" in folder:
            folder = tempfile.mkdtemp(prefix="litweave-code-")  # read by the driver alone, which hands it out
        os.makedirs(folder, exist_ok=True)
        place = os.path.join(folder, f"litweave-{uuid.uuid4().hex}.zip")
        with zipfile.ZipFile(place, "w") as z:
            for file in sorted(root.rglob("*")):
                if file.suffix in (".py", ".txt"):
                    z.write(file, file.relative_to(root.parent))
        context.addPyFile(place)
    context._litweave_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where it is unset a new local one is set, but only if all runs on this machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not folder:
        known = context._jsc.sc().getCheckpointDir()
        folder = known.get() if known.isDefined() else None
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="litweave-shared-")
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def new_path(spark: SparkSession, stem: str) -> str:
    """A path in the shared folder that no other run uses."""
    return os.path.join(shared_dir(spark), f"{stem}-{uuid.uuid4().hex}")


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder in one step; it fails if the target exists."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    start, end = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    files = start.getFileSystem(conf)
    if files.exists(end) or not files.rename(start, end):
        raise OSError(f"could not commit {source} as {target}")


def remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
