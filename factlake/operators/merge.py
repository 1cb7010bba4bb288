"""Keyed writes without MERGE: a full outer join gives the next version of a table.

Every function returns the new version (or the rows to add); the caller writes
it beside the old one and swaps. Keys compare null-safe. Running a merge twice
with the same batch gives the same table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
RELATIVE_DIFFERENCE = 1e-6
LEAST_DIFFERENCE = 1.0


def same_keys(a: str, b: str, keys: list[str]) -> Column:
    return reduce(lambda x, y: x & y, (F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys))


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``left`` with the other columns of ``right``; in ``keys`` null equals null."""
    named = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = reduce(lambda x, y: x & y, (F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys))
    return left.join(named, on, how).drop(*[f"_r_{k}" for k in keys])


def differs(new: Column, old: Column) -> Column:
    return F.abs(new - old) > F.greatest(F.abs(new) * RELATIVE_DIFFERENCE, F.lit(LEAST_DIFFERENCE))


def upsert_values(stored: DataFrame, batch: DataFrame, keys: list[str], value: str = "value", carried: tuple[str, ...] = ()) -> DataFrame:
    """keys, value, carried, corrected_from, action.

    A stored row is always updated by a batch row with its key; where the value
    differs by more than a millionth and by more than 1, the old one is kept in
    ``corrected_from``. ``action``: insert, update or keep.
    """
    s = stored.withColumn("_s", F.lit(True)).alias("s")
    b = batch.withColumn("_b", F.lit(True)).alias("b")
    new, old = F.col(f"b.{value}"), F.col(f"s.{value}")
    hit_s, hit_b = F.col("_s").isNotNull(), F.col("_b").isNotNull()
    return s.join(b, same_keys("s", "b", keys), "full_outer").select(
        *[F.when(hit_b, F.col(f"b.{k}")).otherwise(F.col(f"s.{k}")).alias(k) for k in keys],
        F.when(hit_b, new).otherwise(old).alias(value),
        *[F.when(hit_b, F.col(f"b.{c}")).otherwise(F.col(f"s.{c}")).alias(c) for c in carried],
        F.when(hit_s & hit_b & differs(new, old), old).alias("corrected_from"),
        F.when(~hit_s, "insert").when(hit_b, "update").otherwise("keep").alias("action"),
    )


def insert_missing(stored: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Batch rows whose key isn't stored."""
    return batch.alias("b").join(stored.select(*keys).distinct().alias("s"), same_keys("s", "b", keys), "left_anti")


def replace_scope(stored: DataFrame, batch: DataFrame, scope: list[str]) -> DataFrame:
    """Stored rows outside the batch's scope, and the batch."""
    kept = stored.alias("s").join(batch.select(*scope).distinct().alias("b"), same_keys("s", "b", scope), "left_anti")
    return kept.select(*stored.columns).unionByName(batch.select(*stored.columns))


def align_periods(rows: DataFrame, keys: list[str], columns: list[str], order: list[Column]) -> DataFrame:
    """All rows of a fiscal period take ``columns`` from its first row in ``order``."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return rows.withColumns({c: F.first(c).over(w) for c in columns})


def promote(values: DataFrame, pairs: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Values with losing concepts repointed to their winners, and a receipt.

    ``pairs``: cik, loser, winner (a concept loses once). On the same period the
    winner's own row stays. Receipt per pair: moved, dropped.
    """
    named = pairs.select(F.col("cik").alias("_cik"), F.col("loser").alias("_loser"), "winner")
    at = values.join(named, (F.col("cik") == F.col("_cik")) & (F.col("concept") == F.col("_loser")), "left").drop("_cik", "_loser")
    moved = at.withColumns({"was": F.col("concept"), "concept": F.coalesce("winner", "concept")})
    w = Window.partitionBy("cik", "concept", *keys).orderBy(F.col("winner").isNotNull().cast("int"), "was")
    ranked = moved.withColumn("_n", F.row_number().over(w))
    kept = ranked.filter("_n = 1").select(*values.columns)
    receipt = ranked.filter("winner is not null").groupBy("cik", "was", "concept").agg(F.count_if(F.col("_n") == 1).alias("moved"), F.count_if(F.col("_n") > 1).alias("dropped"))
    return kept, receipt


def duplicate_groups(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def newest_of_duplicates(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*[c.desc() for c in order])
    return rows.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def without_members(rows: DataFrame, members: list[str], column: str = "member") -> DataFrame:
    return rows.filter(~F.coalesce(F.col(column).isin(*members), F.lit(False)))


def parent_links(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Adds parent_id: the row at the parent path in the same company and statement; quarantined paths have none."""
    from ..functions.text import is_polluted_path, parent_path

    at = rows.withColumn("_up", F.when(~is_polluted_path(F.col("path")), parent_path(F.col("path"))))
    up = rows.filter("path is not null").groupBy(*keys, F.col("path").alias("_up")).agg(F.min("id").alias("parent_id"))
    return at.join(up, [*keys, "_up"], "left").drop("_up")
