"""Exact deduplication with DataFrame operations only.

Texts are equal when they are identical after white space is deleted. Rows are
grouped by the 128-bit hash of the normalised text *and* by its bytes, so a
hash collision can't merge two texts; the text is a grouping key, which each
task folds before the shuffle, so a hot group arrives as one row per task. The
decision goes back to the rows by (128-bit hash, SHA-256) without texts.

Defined cases: null text counts as empty; empty texts equal each other; of rows
that repeat a doc_id with an equal text all carry the same decision; a row
without doc_id stays only if no other row of its group is at least as long; an
empty table gives no rows. Columns beyond ``id_col``, ``text_col`` and those
carried are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters that normalisation deletes.
DELETED = " \t\n\x0b\x0c\r"
_ID_SPAN = 2**64
_BASE = 2**65


def normalised(text: Column) -> Column:
    out = F.coalesce(text, F.lit(""))
    for c in DELETED:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def _dec(x) -> Column:
    return (x if isinstance(x, Column) else F.lit(str(x))).cast("decimal(38,0)")


def _packed(n_code: Column, doc_id: Column) -> Column:
    """Orders rows by code points, then by smaller id, as one fixed-width number that hash aggregation can hold."""
    place = F.coalesce(_dec(_ID_SPAN // 2) - _dec(doc_id), _dec(0))
    return (_dec(n_code) * F.lit(str(_BASE)).cast("decimal(20,0)")).cast("decimal(38,0)") + place


def _id_of(packed: Column) -> Column:
    place = packed % _dec(_BASE)
    return F.when(place > 0, (_dec(_ID_SPAN // 2) - place).cast("bigint"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_of=F.md5, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, and the columns ``carry``.

    Of equal texts the row with the most code points stays, then the smallest
    id. ``hash_of``: the 128-bit hash of the normalised text; tests pass a weak
    one to force collisions.
    """
    rows = docs.select(
        *carry,
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.length(F.coalesce(F.col(text_col), F.lit(""))).alias("n_code"),
        normalised(F.col(text_col)).alias("norm"),
    ).select(*carry, "doc_id", "n_code", "norm", hash_of(F.col("norm")).alias("h128"))
    groups = (
        rows.groupBy("h128", "norm")
        .agg(F.count("*").alias("group_size"), F.max(_packed(F.col("n_code"), F.col("doc_id"))).alias("best"))
        .select("h128", F.sha2("norm", 256).alias("sha"), "group_size", _id_of(F.col("best")).alias("keep_id"))
    )
    keys = rows.select(*carry, "doc_id", "h128", F.sha2("norm", 256).alias("sha"))
    return keys.join(groups, ["h128", "sha"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"),
        F.col("sha").alias("text_sha256"),
        *carry,
    )
