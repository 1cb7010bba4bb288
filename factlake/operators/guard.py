"""Which rows may be inserted; the others go to a table of rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_polluted_path


def reject_reason(concept: Column, path: Column) -> Column:
    """NULL for a row that may be inserted: no quarantined path, no abstract heading but a custom one."""
    abstract = concept.endswith("Abstract") & ~concept.startswith("custom:")
    return F.when(concept.isNull() | (concept == ""), "no_concept").when(abstract, "abstract").when(is_polluted_path(path), "polluted_path")


def admitted(rows: DataFrame) -> DataFrame:
    return rows.filter(reject_reason(F.col("concept"), F.col("path")).isNull())


def rejects(rows: DataFrame) -> DataFrame:
    return rows.withColumn("reason", reject_reason(F.col("concept"), F.col("path"))).filter("reason is not null")
