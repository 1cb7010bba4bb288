"""The bounded, reproducible samples that classifiers are fitted on.

Only the fit uses them; scoring reads every row. A class of more documents than
``per_class`` is cut by a hash of the id to a share that holds so many of them
on average: the size of the sample is binomial, it exceeds ``per_class`` by six
of its standard deviations (a tenth, at 3,000) once in a billion draws. So no
ranking gathers a class. Sampled texts are taken whole, whatever their length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's text modulo ``folds``; null without id."""
    return F.crc32(doc_id.cast("string")) % folds


def _one_label(labelled: DataFrame) -> DataFrame:
    """doc_id, label: a document that has several labels counts with the largest."""
    return labelled.filter("label is not null and doc_id is not null").groupBy("doc_id").agg(F.max("label").alias("label"))


def class_sizes(labelled: DataFrame) -> dict:
    """Documents of each label; a model has a part for each class, so the driver may hold one number for each."""
    return {r["label"]: r["n"] for r in _one_label(labelled).groupBy("label").agg(F.count("*").alias("n")).collect()}


def share_of(n: int, per_class: int) -> float:
    """Share of a class of ``n`` documents that holds ``per_class`` of them on average; all of a smaller class."""
    return min(1.0, per_class / max(n, 1))


def sample_ids(labelled: DataFrame, per_class: int, sizes: dict) -> DataFrame:
    """doc_id, label: about ``per_class`` documents of each label, those with the least hashes of the id.

    ``sizes``: from ``class_sizes``; each class is cut by its own share.
    """
    if not sizes:
        return _one_label(labelled.filter("false"))
    hashed = F.xxhash64("doc_id")
    cuts = {k: min(2**63 - 1, int(share_of(n, per_class) * 2**64) - 2**63) for k, n in sizes.items()}
    # Every row under the largest cut first (before the aggregation), then each class under its own.
    rows = _one_label(labelled.filter(hashed <= F.lit(max(cuts.values()))))
    cut = F.create_map(*[F.lit(x) for pair in cuts.items() for x in pair])
    return rows.filter(hashed <= F.element_at(cut, F.col("label")))


def odds(sizes: dict, labels) -> float:
    """Label 1 to label 0 in the population over that in the sample: what a balanced sample has to be corrected by."""
    ones, zeros = int((labels == 1).sum()), int((labels == 0).sum())
    if not ones or not zeros:
        return 1.0
    return (sizes.get(1, 0) / max(1, sizes.get(0, 0))) / (ones / zeros)


def sample_texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id, label, text of the sampled rows; ``ids`` has a bounded number of rows, so it is broadcast."""
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("doc_id", "label", "text")
