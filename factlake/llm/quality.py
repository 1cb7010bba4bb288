"""Quality: supervised subword embeddings, averaged per document, softmax output.

Features are the words, the pairs of neighbouring words in their order and the
character 3- and 4-grams of words (a blank marks a word's edge), hashed into
``2**bits`` learned vectors. In a pair, a word equal to the one before it is
written as a repeat mark and not as itself, so that what the sample shows of
repeated words holds for words that it doesn't have. A document is the mean of its vectors; a linear layer and a
softmax give the classes. Numpy stochastic gradient descent on the cross entropy
learns vectors, layer and intercept together, one document a step, the rate
falling linearly. Because mean and layer are linear, scoring needs one number
per place: its vector times the layer.

The fit reads a bounded sample of labelled rows (about ``per_class`` documents of
each label, whole texts; see ``sampling``); scoring reads everything. The intercept is corrected from
the sample's odds to those of all labelled rows.

Defined cases: a text without words (null, empty, white space) gets the score
of the intercept; without labelled rows of both kinds every score is 0; equal
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
class Subword:
    bits: int = 17
    widths: tuple[int, ...] = (3, 4)
    dim: int = 12
    epochs: int = 6
    rate: float = 4.0
    per_class: int = 2000
    folds: int = 5
    seed: int = 7


def features(col: pa.Array, m: Subword) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each kind of feature: place at each position (-1: none) and the rows' offsets."""
    wide = tv.spaced(col)
    w = tv.Words(*tv.utf8(wide))
    shift = tv.U(64 - m.bits)
    pairs, pair_rows = tv.grams(w.hashes, w.rows, 2)
    pairs[_repeats(w, pair_rows)] = tv.STEP
    kinds = [((w.hashes >> shift).astype(np.int32), w.rows), ((pairs >> shift).astype(np.int32), pair_rows)]
    points, rows = tv.code_points(wide)
    return kinds + [(g, rows) for g in tv.char_grams(points, m.widths, m.bits)]


def _repeats(w: tv.Words, pair_rows: np.ndarray) -> np.ndarray:
    """Whether the words of each pair are equal."""
    counts = np.diff(pair_rows)
    first = np.repeat(w.rows[:-1] - pair_rows[:-1], counts) + np.arange(pair_rows[-1])
    return w.hashes[first] == w.hashes[first + 1]


def _bags(m: Subword):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in tv.held(batches, "text"):
            kinds = features(s.column(2), m)
            places, counts = [], []
            for d in range(s.num_rows):
                x = np.concatenate([p[o[d] : o[d + 1]] for p, o in kinds])
                u, c = np.unique(x[x >= 0], return_counts=True)
                places.append(u.astype(np.int32).tobytes())
                counts.append(c.astype(np.int32).tobytes())
            yield pa.record_batch([s.column(0), s.column(1), pa.array(places, pa.binary()), pa.array(counts, pa.binary())], names=["doc_id", "label", "places", "counts"])

    return run


@dataclass(frozen=True)
class Model:
    #: Per place: its vector times the difference of the classes' weights.
    margin: np.ndarray
    bias: float
    fitted: bool = True


def fit_sgd(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, m: Subword, odds: float = 1.0) -> Model:
    """Plain SGD; ``odds``: label 1 to label 0 in the population over that in the sample."""
    rng = np.random.default_rng(m.seed)
    if not len(labels) or labels.min() == labels.max():
        return Model(np.zeros(1 << m.bits, np.float32), 0.0, False)
    vectors = rng.uniform(-1 / m.dim, 1 / m.dim, (1 << m.bits, m.dim)).astype(np.float32)
    layer, bias = np.zeros((2, m.dim), np.float32), np.zeros(2, np.float32)
    steps, done = m.epochs * len(bags), 0
    for _ in range(m.epochs):
        for i in rng.permutation(len(bags)):
            rate = np.float32(m.rate * (1 - done / steps))
            done += 1
            at, count = bags[i]
            if not len(at):
                continue
            part = (count / count.sum()).astype(np.float32)
            mean = part @ vectors[at]
            out = layer @ mean + bias
            p = np.exp(out - out.max())
            p /= p.sum()
            p[labels[i]] -= 1
            back = p @ layer
            layer -= rate * np.outer(p, mean)
            bias -= rate * p
            vectors[at] -= rate * part[:, None] * back[None, :]
    return Model(vectors @ (layer[1] - layer[0]), float(bias[1] - bias[0] + np.log(odds)))


def _score(m: Subword, model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        margin = np.append(model.margin, np.float32(0)).astype(np.float64)  # place -1: nothing
        for s in tv.held(batches, "text"):
            total, n = np.zeros(s.num_rows), np.zeros(s.num_rows)
            for places, offsets in features(s.column(1), m):
                run_sum = np.concatenate([[0.0], np.cumsum(margin[places])])
                total += np.diff(run_sum[offsets])
                run_n = np.concatenate([[0], np.cumsum(places >= 0)])
                n += np.diff(run_n[offsets])
            out = total / np.maximum(n, 1) + model.bias
            p = 1 / (1 + np.exp(-np.clip(out, -30, 30)))
            yield pa.record_batch([s.column(0), pa.array(p if model.fitted else np.zeros(s.num_rows))], names=["doc_id", "score"])

    return run


def fit(docs: DataFrame, labels: DataFrame, m: Subword = Subword(), label_col: str = "quality") -> Model:
    ship(docs.sparkSession)
    learn = labels.select("doc_id", F.col(label_col).cast("int").alias("label")).filter(fold(F.col("doc_id"), m.folds) != 0)
    learn = learn.filter("label in (0, 1)")
    sizes = class_sizes(learn)
    ids = sample_ids(learn, m.per_class, sizes)
    rows = sample_texts(docs, ids).mapInArrow(_bags(m), "doc_id long, label int, places binary, counts binary").toArrow().sort_by([("doc_id", "ascending"), ("places", "ascending"), ("counts", "ascending")])
    bags = [(np.frombuffer(a, np.int32), np.frombuffer(c, np.int32)) for a, c in zip(rows["places"].to_pylist(), rows["counts"].to_pylist(), strict=True)]
    y = rows["label"].to_numpy()
    return fit_sgd(bags, y, m, odds(sizes, y))


def quality(docs: DataFrame, labels: DataFrame, m: Subword = Subword(), model: Model | None = None, keep_from: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per row of ``docs``."""
    ship(docs.sparkSession)
    model = model or fit(docs, labels, m)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = rows.mapInArrow(_score(m, model), "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(fold(F.col("doc_id"), m.folds) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= keep_from).cast("int").alias("predicted"))
