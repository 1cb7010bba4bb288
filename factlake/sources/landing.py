"""Tables and files that one step leaves for another.

They lie in the folder that the session names in ``spark.checkpoint.dir``, which
driver and executors share. A session of one machine without that setting gets
a folder of its own; on a cluster the setting must be made.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        hadoop = spark.sparkContext._jsc.sc().getCheckpointDir()
        at = hadoop.get() if hadoop.isDefined() else None
    if not at:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir names no folder that driver and executors share")
        at = "file://" + tempfile.mkdtemp(prefix="factlake-landing-")
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame and read it back: lineage ends here."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
