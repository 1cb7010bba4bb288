"""Shared storage, lineage cuts and packaging for the training-data operators.

Everything that one stage leaves for another is a table in the folder that the
session names in ``spark.checkpoint.dir``. Driver and executors share that
folder; a lost executor loses nothing that was written there.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PACKAGE_ROOT = Path(__file__).resolve().parents[2]


def shared_dir(spark: SparkSession) -> str:
    """URI of the shared folder that the session names.

    A session of one machine (tests) gets a folder of its own where none is
    named. A cluster's driver and executors share no other folder, so there the
    setting must be made.
    """
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        hadoop = spark.sparkContext._jsc.sc().getCheckpointDir()
        at = hadoop.get() if hadoop.isDefined() else None
    if not at:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir names no folder that driver and executors share")
        at = "file://" + tempfile.mkdtemp(prefix="factlake-")
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: lineage ends here."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def drop_stored(*frames: DataFrame) -> None:
    """Delete the tables behind frames that ``stored`` returned, once nothing reads them any more."""
    for df in frames:
        spark = df.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def settle_driver(spark: SparkSession) -> None:
    """Collect the driver's garbage after a series of short jobs.

    Each stage and each scan leaves a 4 MB broadcast buffer, and plans hold their
    broadcast variables until a collection; a driver that works through hundreds
    of them lets its heap grow instead of collecting. This gives the heap back,
    and Spark's cleaner drops what executors keep for those plans.
    """
    spark.sparkContext._jvm.System.gc()


#: Files whose numbers may be broadcast (a path each); rows of more files are numbered by writing them once.
BROADCAST_FILES = 50_000


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """Adds ``name``: a number of each row's own that stays the same however often the frame is computed.

    Rows of a plain scan are numbered by their file and their place in it, from
    the files' metadata. Rows of any other frame have no such place; they are
    written with their numbers and read back.
    """
    spark = docs.sparkSession
    plain = docs._jdf.queryExecution().analyzed().getClass().getSimpleName() == "LogicalRelation"
    if plain and "_metadata" not in docs.columns:
        at = docs.select(F.col("_metadata.file_path").alias("path")).groupBy("path").agg(F.count("*").alias("n"))
        files = stored(at, "files")
        if files.count() <= BROADCAST_FILES:
            ahead = F.sum("n").over(Window.orderBy("path")) - F.col("n")  # one row per file
            first = F.broadcast(files.select(F.col("path").alias(f"{name}_path"), ahead.alias(f"{name}_first")))
            rows = docs.select("*", F.col("_metadata.file_path").alias(f"{name}_path"), F.col("_metadata.row_index").alias(f"{name}_at"))
            return rows.join(first, f"{name}_path").select(*[F.col(f"`{c}`") for c in docs.columns], (F.col(f"{name}_first") + F.col(f"{name}_at")).alias(name))
    return stored(docs.withColumn(name, F.monotonically_increasing_id()), "numbered")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers that don't start in the repository."""
    on_path = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    root = str(PACKAGE_ROOT)
    app = spark.sparkContext.applicationId
    if root in on_path or os.path.realpath(os.getcwd()) == root or app in _shipped:
        return
    archive = Path(tempfile.mkdtemp(prefix="factlake-ship-")) / "factlake_pkg.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted((PACKAGE_ROOT / "factlake").rglob("*.py")):
            z.write(f, f.relative_to(PACKAGE_ROOT))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)
