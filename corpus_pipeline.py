"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as
Parquet and read again as the next stage's docs. All but the last return the
columns of ``documents``, whatever they are.

Decisions belong to rows and not to ids: stages that drop or repeat rows number
them first and apply each decision by that number. Rows that share a doc_id but
not a text are therefore judged apart, and so are rows without a doc_id. An
empty table passes every stage as an empty table; null and empty texts go in the
first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factlake.llm import exact_dedup, langid, minhash, mixing, sentencepiece_fst
from factlake.llm.queries import tokenizer_path
from factlake.llm.workspace import drop_stored, numbered, stored


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows with a lasting number each, and the number's column."""
    name = "row_of_stage"
    while any(c.lower().startswith(name) for c in docs.columns):
        name += "_"
    return numbered(docs, name), name


def _without(docs: DataFrame, row: str, decided: DataFrame, first: DataFrame) -> DataFrame:
    """The rows but those that ``decided`` has and ``first`` hasn't: what goes is less than what stays, and often small enough for a broadcast."""
    gone = decided.select(row).join(first.select(row), row, "left_anti")
    return docs.join(gone, row, "left_anti").drop(row)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are near some language; null texts and texts without a letter go."""
    return langid.accepted(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts: the longest, then the one with the smallest doc_id, then the first."""
    docs, row = _numbered(docs)
    decided = stored(exact_dedup.exact_dedup(docs, carry=(row,)).select(row, "kept", "text_sha256"), "exact-decisions")
    return _without(docs, row, decided, decided.filter("kept").groupBy("text_sha256").agg(F.min(row).alias(row)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each connected group of near duplicates: the one with the smallest doc_id, then the first."""
    docs, row = _numbered(docs)
    found = minhash.near_duplicates(docs, id_col=row).select(F.col("doc_id").alias(row), "component_id")
    decided = stored(found.join(docs.select(row, "doc_id"), row), "near-decisions")
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", row))
    return _without(docs, row, decided, decided.groupBy("component_id").agg(least[row].alias(row)))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in whole rows: a row as often as its taken words make up its text, rounded."""
    docs, row = _numbered(docs)
    copies = row + "_copies"
    often = F.floor(F.try_divide("taken", "size") + 0.5).cast("int")
    taken = mixing.mix(docs, carry=(row,)).select(row, often.alias(copies)).filter(f"{copies} > 0")
    return docs.join(taken, row).withColumn(copies, F.explode(F.sequence(F.lit(1), copies))).drop(row, copies)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_crc32, decoded_sha256, exact, tokens of each document of the mix."""
    return sentencepiece_fst.coded(docs, tokenizer_path("piece_bpe_32k.model"), with_tokens=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", language_id),
    ("exact dedup", exact_duplicates),
    ("MinHash near-dedup", near_duplicates),
    ("mixing", source_mix),
    ("SentencePiece", sentencepiece),
]

#: Language ID is fitted, mixing is by hashed order, encoding needs a model: not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before, docs = docs, stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if name != STAGES[0][0]:
            drop_stored(before)
    return STAGES[-1][1](spark, docs, sf_dir)
