"""Language identification by nearest centroid.

A text is the L2-normalised TF-IDF vector of its hashed byte 2- and 3-grams
(lower-cased words, a blank marks a word's edge; ASCII signs part words and
words with a digit, such as keys and hex, don't count). Spherical k-means gives
``clusters`` centroids per language; a text takes the language of the centroid
with the highest cosine.

A text is far from every language and is rejected when its best cosine is under
that language's threshold: the ``low_quantile`` of the best cosines of the
language's own learning rows, times ``slack``. A text with few different grams
covers little of a centroid, so below ``full_grams`` of them the threshold falls
with the root of their number; it is ``reject_below`` at least.

The fit reads a bounded sample (about ``sample_rows`` documents in all, equally
many of each language, whole texts; see ``sampling``); scoring reads everything.

Defined cases: null text and text without a letter (Unicode category L) are
``und`` with score 0 and rejected; without any learnable row everything is.
Equal texts have equal results; of equally near centroids the first wins
(languages in the order of their names); repeated rows are judged each; a
document given with several languages counts with the last by name; an empty
table gives no rows. ``languages`` ignores other columns, ``accepted`` returns
all of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .sampling import class_sizes, fold, sample_ids, sample_texts
from .workspace import ship

UNKNOWN = "und"


@dataclass(frozen=True)
class Centroid:
    bits: int = 12
    widths: tuple[int, ...] = (2, 3)
    clusters: int = 4
    rounds: int = 8
    sample_rows: int = 6000
    folds: int = 3
    held_out_fold: int = 1
    reject_below: float = 0.02
    low_quantile: float = 0.002
    slack: float = 0.5
    full_grams: int = 128
    seed: int = 7
    rows_at_once: int = 512


def _worded(data: np.ndarray) -> np.ndarray:
    """The bytes of words without a digit; words are letters, digits and everything beyond ASCII."""
    digit = (data >= 0x30) & (data <= 0x39)
    word = tv.LETTER[data] | digit | (data >= 0x80)
    run = np.cumsum(~word)  # one number for a word and the byte before it
    return word & (np.bincount(run, weights=digit) == 0)[run]


def _reach(grams: np.ndarray, m: Centroid) -> np.ndarray:
    """By the number of different grams of a text, the share of a threshold that holds for it."""
    return np.sqrt(np.minimum(grams / m.full_grams, 1.0))


def _counts(col: pa.Array, m: Centroid) -> np.ndarray:
    data, offsets = tv.utf8(tv.spaced(col))
    data = tv.latin_lowered(data)
    data[~_worded(data)] = 0x20
    row = tv.row_index(offsets)
    size = 1 << m.bits
    total = np.zeros(len(col) * size, np.int64)
    for g in tv.byte_grams(data, m.widths, m.bits):
        on = g >= 0
        total += np.bincount(row[on] * size + g[on], minlength=len(total))
    return total.reshape(len(col), size)


def _blocks(batches: Iterator[pa.RecordBatch], m: Centroid) -> Iterator[pa.RecordBatch]:
    for s in tv.held(batches, "text"):
        for at in range(0, s.num_rows, m.rows_at_once):
            yield s.slice(at, m.rows_at_once)


def _bags(m: Centroid):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in _blocks(batches, m):
            c = _counts(s.column(2), m)
            at = [np.flatnonzero(x) for x in c]
            places = pa.array([x.astype(np.uint16).tobytes() for x in at], pa.binary())
            counts = pa.array([c[d, x].astype(np.uint32).tobytes() for d, x in enumerate(at)], pa.binary())
            yield pa.record_batch([s.column(0), s.column(1), places, counts], names=["doc_id", "label", "places", "counts"])

    return run


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    idf: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray
    least: np.ndarray  #: by language, the cosine under which a text is rejected


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _cluster(x: np.ndarray, m: Centroid) -> np.ndarray:
    """Spherical k-means; the first centroids are spread out: each is the row furthest from those before."""
    at = [0]
    for _ in range(min(m.clusters, len(x)) - 1):
        at.append(int((x @ x[at].T).max(axis=1).argmin()))
    c = x[at]
    for _ in range(m.rounds):
        near = (x @ c.T).argmax(axis=1)
        sums = np.stack([x[near == k].sum(axis=0) if (near == k).any() else c[k] for k in range(len(c))])
        c = _unit(sums)
    return c


def fit_centroids(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, m: Centroid) -> Model:
    size = 1 << m.bits
    df = np.zeros(size)
    for at, _ in bags:
        df[at] += 1
    idf = (np.log((1 + len(bags)) / (1 + df)) + 1).astype(np.float32)
    names, parts, owner = tuple(sorted(set(labels.tolist()))), [], []

    def rows_of(name: str) -> np.ndarray:
        rows = np.flatnonzero(labels == name)
        x = np.zeros((len(rows), size), np.float32)
        for i, r in enumerate(rows):
            x[i, bags[r][0]] = bags[r][1] * idf[bags[r][0]]
        x /= np.maximum(np.sqrt(np.einsum("ij,ij->i", x, x))[:, None], 1e-12)
        return x

    for k, name in enumerate(names):
        c = _cluster(rows_of(name), m)
        parts.append(c)
        owner += [k] * len(c)
    centroids, owners = np.concatenate(parts) if parts else np.zeros((0, size), np.float32), np.array(owner, np.int64)
    least = np.full(len(names), m.reject_below)
    for k, name in enumerate(names):
        cos = rows_of(name) @ centroids.T
        reach = _reach(np.array([len(bags[r][0]) for r in np.flatnonzero(labels == name)]), m)
        own = (cos.max(axis=1) / reach)[owners[cos.argmax(axis=1)] == k]  # a row that is nearer to another language has a wrong label
        if len(own):
            least[k] = max(m.reject_below, m.slack * float(np.quantile(own, m.low_quantile)))
    return Model(names, idf, centroids, owners, least)


def fit(docs: DataFrame, m: Centroid = Centroid(), lang_col: str = "lang") -> Model:
    ship(docs.sparkSession)
    learn = docs.select("doc_id", F.col(lang_col).cast("string").alias("label")).filter(fold(F.col("doc_id"), m.folds) != m.held_out_fold).filter("label is not null")
    sizes = class_sizes(learn)
    ids = sample_ids(learn, max(1, m.sample_rows // max(1, len(sizes))), sizes)
    rows = sample_texts(docs, ids).mapInArrow(_bags(m), "doc_id long, label string, places binary, counts binary").toArrow().sort_by([("doc_id", "ascending"), ("places", "ascending"), ("counts", "ascending")])
    bags = [(np.frombuffer(a, np.uint16), np.frombuffer(c, np.uint32)) for a, c in zip(rows["places"].to_pylist(), rows["counts"].to_pylist(), strict=True)]
    labels = np.array(rows["label"].to_pylist(), object)
    del rows
    pa.default_memory_pool().release_unused()
    used = [i for i, b in enumerate(bags) if len(b[0])]
    return fit_centroids([bags[i] for i in used], labels[used], m)


def _score(m: Centroid, model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weighted = (model.centroids * model.idf).T.copy()
        for s in _blocks(batches, m):
            n = s.num_rows
            lang, best, least = np.full(n, UNKNOWN, object), np.zeros(n), np.full(n, m.reject_below)
            letters = s.column(2).to_numpy(zero_copy_only=False)
            if len(model.languages):
                c = _counts(s.column(1), m).astype(np.float32)
                cos = (c @ weighted) / np.maximum(np.linalg.norm(c * model.idf, axis=1, keepdims=True), 1e-12)
                top = cos.argmax(axis=1)
                best = np.where(letters, np.clip(cos[np.arange(n), top], 0, 1), 0.0)
                least = np.maximum(m.reject_below, model.least[model.owner[top]] * _reach((c > 0).sum(axis=1), m))
                lang = np.where(letters, np.array(model.languages, object)[model.owner[top]], UNKNOWN)
            far = ~letters | (best < least)
            yield pa.record_batch([s.column(0), pa.array(lang.tolist(), pa.string()), pa.array(best.astype(np.float64)), pa.array(far)], names=["doc_id", "lang_pred", "score", "rejected"])

    return run


def accepted(docs: DataFrame, m: Centroid = Centroid(), model: Model | None = None) -> DataFrame:
    """The rows of ``docs``, all columns, that aren't rejected."""
    ship(docs.sparkSession)
    model = model or fit(docs, m)
    run = _score(m, model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for s in _blocks(iter([whole]), m):
                ids = pa.array(np.arange(s.num_rows))
                text, letter = s.column(s.schema.get_field_index("text")), s.column(s.num_columns - 1)
                scored = run(iter([pa.record_batch([ids, text, letter], names=["doc_id", "text", "letter"])]))
                far = np.concatenate([b.column(3).to_numpy(zero_copy_only=False) for b in scored])
                yield s.select(range(s.num_columns - 1)).filter(pa.array(~far))

    # The last column says whether the text has a letter; its name can't clash, it is read by place.
    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return docs.select("*", letter.alias("__letter__")).mapInArrow(keep, docs.schema)


def languages(docs: DataFrame, m: Centroid = Centroid(), model: Model | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected: one row per row of ``docs``."""
    ship(docs.sparkSession)
    model = model or fit(docs, m)
    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), letter.alias("letter"))
    scored = rows.mapInArrow(_score(m, model), "doc_id long, lang_pred string, score double, rejected boolean")
    held = F.coalesce(fold(F.col("doc_id"), m.folds) == m.held_out_fold, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")
