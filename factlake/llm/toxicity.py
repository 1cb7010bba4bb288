"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Words are runs of letters and digits (any non-ASCII byte counts as a letter),
lower-cased. A document's features are the presence of its words, word stems
(first ``stem`` bytes), word pairs and pairs with one word between, hashed into
``2**bits`` places; places of fewer than ``least_docs`` sampled documents aren't fitted. FTRL-proximal
keeps a learning rate per coordinate and, by its L1 term, exact zeros, so the
model that goes to the executors is the list of its non-zero weights.

The fit reads a bounded sample of labelled rows (about ``per_class`` documents of
each label, whole texts; see ``sampling``); scoring reads everything. The intercept is corrected from
the sample's odds to those of all labelled rows.

Defined cases: a text without words (null, empty, punctuation) gets the score
of the bias alone; without labelled rows of both kinds every score is 0; equal
texts have equal scores; repeated rows are scored each; a document labelled
both 1 and 0 counts as 1; sampled rows that repeat a doc_id all count; an
empty table gives no rows. Columns beyond those named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .sampling import class_sizes, fold, odds, sample_ids, sample_texts
from .workspace import ship


@dataclass(frozen=True)
class Ftrl:
    bits: int = 20
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 3.0
    l2: float = 0.0
    epochs: int = 4
    per_class: int = 5000
    folds: int = 5
    seed: int = 7
    stem: int = 6
    least_docs: int = 4


_breaks = np.zeros(256, bool)
_breaks[:128] = True
_breaks[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False


def features(col: pa.Array, bits: int, stem: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature places (with repeats) and the index of the row of each."""
    data, offsets = tv.utf8(col)
    w = tv.Words(tv.latin_lowered(data), offsets, _breaks, stem)
    parts = [(w.hashes, w.rows), (tv.mix(w.prefixes + tv.STEP), w.rows), tv.grams(w.hashes, w.rows, 2), tv.grams(w.hashes, w.rows, 2, skip=1)]
    places = np.concatenate([h >> tv.U(64 - bits) for h, _ in parts]).astype(np.int64)
    return places, np.concatenate([tv.row_index(o) for _, o in parts])


def _sets(m: Ftrl):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in tv.held(batches, "text"):
            places, row = features(s.column(2), m.bits, m.stem)
            sets = [b""] * s.num_rows
            order = np.argsort(row, kind="stable")
            cuts = np.searchsorted(row[order], np.arange(s.num_rows + 1))
            for d in range(s.num_rows):
                sets[d] = np.unique(places[order[cuts[d] : cuts[d + 1]]]).astype(np.uint32).tobytes()
            yield pa.record_batch([s.column(0), s.column(1), pa.array(sets, pa.binary())], names=["doc_id", "label", "places"])

    return run


@dataclass(frozen=True)
class Weights:
    places: np.ndarray
    values: np.ndarray
    bias: float
    fitted: bool = True


def fit_ftrl(sets: list[np.ndarray], labels: np.ndarray, m: Ftrl, odds: float = 1.0) -> Weights:
    """Per-coordinate FTRL-proximal; ``odds``: label 1 to label 0 in the population over that in the sample."""
    if not len(labels) or labels.min() == labels.max():
        return Weights(np.zeros(0, np.int64), np.zeros(0, np.float32), 0.0, False)
    docs_with = np.bincount(np.concatenate(sets), minlength=1 << m.bits)
    used = np.flatnonzero(docs_with >= m.least_docs)
    dense = np.full(1 << m.bits, -1, np.int32)
    dense[used] = np.arange(len(used), dtype=np.int32)
    sets = [x[x >= 0] for x in (dense[s] for s in sets)]
    z, n = np.zeros(len(used)), np.zeros(len(used))
    zb = nb = 0.0
    order = np.random.default_rng(m.seed)

    def weight(z, n):
        return np.where(np.abs(z) <= m.l1, 0.0, -(z - np.sign(z) * m.l1) / ((m.beta + np.sqrt(n)) / m.alpha + m.l2))

    for _ in range(m.epochs):
        for i in order.permutation(len(sets)):
            x = sets[i]
            w = weight(z[x], n[x])
            wb = -zb / ((m.beta + nb**0.5) / m.alpha)
            p = 1 / (1 + np.exp(-np.clip(w.sum() + wb, -30, 30)))
            g = p - labels[i]
            sigma = (np.sqrt(n[x] + g * g) - np.sqrt(n[x])) / m.alpha
            z[x] += g - sigma * w
            n[x] += g * g
            zb += g - ((nb + g * g) ** 0.5 - nb**0.5) / m.alpha * wb
            nb += g * g
    w = weight(z, n)
    at = np.flatnonzero(w)
    return Weights(used[at], w[at].astype(np.float32), float(-zb / ((m.beta + nb**0.5) / m.alpha) + np.log(odds)))


def _score(m: Ftrl, weights: Weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << m.bits, np.float32)
        table[weights.places] = weights.values
        for s in tv.held(batches, "text"):
            places, row = features(s.column(1), m.bits, m.stem)
            hit = np.flatnonzero(table[places])
            # Presence, not counts: of the few places with a weight, each counts once per row.
            once = np.unique(row[hit] << m.bits | places[hit])
            total = np.bincount(once >> m.bits, table[once & ((1 << m.bits) - 1)], s.num_rows) + weights.bias
            p = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
            yield pa.record_batch([s.column(0), pa.array(p if weights.fitted else np.zeros(s.num_rows))], names=["doc_id", "score"])

    return run


def fit(docs: DataFrame, labels: DataFrame, m: Ftrl = Ftrl(), label_col: str = "toxic") -> Weights:
    ship(docs.sparkSession)
    learn = labels.select("doc_id", F.col(label_col).cast("int").alias("label")).filter(fold(F.col("doc_id"), m.folds) != 0)
    learn = learn.filter("label in (0, 1)")
    sizes = class_sizes(learn)
    ids = sample_ids(learn, m.per_class, sizes)
    rows = sample_texts(docs, ids).mapInArrow(_sets(m), "doc_id long, label int, places binary").toArrow().sort_by([("doc_id", "ascending"), ("places", "ascending")])
    y = rows["label"].to_numpy()
    sets = [np.frombuffer(x, np.uint32).astype(np.int64) for x in rows["places"].to_pylist()]
    return fit_ftrl(sets, y, m, odds(sizes, y))


def toxicity(docs: DataFrame, labels: DataFrame, m: Ftrl = Ftrl(), weights: Weights | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per row of ``docs``."""
    ship(docs.sparkSession)
    weights = weights or fit(docs, labels, m)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = rows.mapInArrow(_score(m, weights), "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(fold(F.col("doc_id"), m.folds) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
