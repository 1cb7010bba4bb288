"""MinHash near-deduplication with tensored banding.

Two small collections, A and B, hold ``side`` groups of ``width`` minhashes
each. Table (i, j) is keyed by the pair of group i of A and group j of B, so
``side**2`` tables of ``2 * width`` minhashes need ``2 * side * width``
minhashes per document and not ``2 * side**2 * width``. At similarity s a pair
meets in some table with probability (1 - (1 - s**width)**side)**2: 0.9999 at
0.75 for the defaults.

1. Documents with equal shingle sets become one class. Sets count as equal when
   their sizes and two 64-bit sums over their members agree. Classes are the
   nodes; a document id that has rows in several classes links them.
2. A group of A (or B) whose value nobody shares can't be half of a shared key:
   keys are made only from groups that two classes share.
3. In each bucket the least member is compared with the others by minhashes.
   Plausible pairs make rough clusters. Members of a bucket that lie in
   different clusters are compared with one member picked by hash. What is
   apart still joins the bucket's dominant cluster without more ado, or else is
   compared in blocks of bounded size, where one plausible pair joins two
   clusters. So every plausible pair that meets in a bucket lies inside one
   cluster; a dominant cluster only makes clusters larger, that is, more pairs
   are compared by full sets, and none fewer.
4. In each cluster the member nearest to the cluster's consensus (the most
   frequent minhash of each place), its pivot, is confirmed against the others,
   and each member against its best counterpart. A member that many are compared
   with is sent to several tasks, each with a bounded part of the others.
5. What this leaves apart from a cluster's main component is compared with the
   whole cluster by full shingle sets, in blocks of bounded shingles; a block
   reports only the links that connect something. Two exact tests leave out
   pairs that can't be linked: set sizes must be within the threshold of each
   other (blocks are made by size band, and only neighbouring bands meet), and
   since Jaccard distance is a metric, so must the distances to the pivot.
   No bucket or cluster is cut short, and pairs within a component aren't listed.
6. A confirmation compares the full shingle sets of the two whole texts, as sets
   of 64-bit hashes. Components come from distributed star contraction.

Intermediate tables are deleted as soon as nothing reads them any more.

Defined cases: with fewer than ``words`` words the whole sequence is the one
shingle; null text, empty text and text without words have no shingle, are
linked with nothing and form a component each. Rows that share a doc_id are one
node. Rows without doc_id get no component and are kept. An empty table gives no
rows. Columns beyond id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .components import components
from .workspace import drop_stored, ship, stored

U = np.uint64


@dataclass(frozen=True)
class Banding:
    words: int = 5
    percent: int = 75
    side: int = 12
    width: int = 2
    #: Pairs with fewer equal minhashes (share of all) aren't confirmed: at 0.75 a pair has fewer with probability 1e-6.
    plausible: float = 0.45
    #: Members of a bucket in a block (a signature each).
    block: int = 4096
    #: Shingles in a block of texts, and of those that one task compares with a pivot.
    block_shingles: int = 2_000_000
    #: Rows whose sets are intersected at once.
    tile: int = 512
    #: A cluster dominates a bucket with so many members at least, and so large a share of the bucket.
    dominant: int = 8
    dominant_share: float = 0.75
    seed: int = 20240607

    @property
    def hashes(self) -> int:
        return 2 * self.side * self.width

    def multipliers(self) -> np.ndarray:
        return np.random.default_rng(self.seed).integers(1, 2**63, self.hashes, dtype=np.uint64) * U(2) + U(1)


def shingles(col: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of a string column and the rows' offsets; repeated shingles are still there."""
    w = tv.Words(*tv.lowered(col))
    counts = np.diff(w.rows)
    h, offsets = tv.grams(w.hashes, w.rows, words)
    few = (counts > 0) & (counts < words)
    if not few.any():
        return h, offsets
    sizes = np.diff(offsets) + few
    to = np.concatenate([[0], np.cumsum(sizes)])
    out = np.empty(to[-1], np.uint64)
    full = np.flatnonzero(np.diff(offsets))
    at = np.repeat(to[:-1][full] - offsets[:-1][full], np.diff(offsets)[full]) + np.arange(len(h))
    out[at] = h
    for k in range(1, words):
        rows = np.flatnonzero(counts == k)
        if len(rows):
            hk, ok = tv.grams(w.hashes, w.rows, k)
            out[to[:-1][rows]] = hk[ok[:-1][rows]]
    return out, to


def _signatures(b: Banding):
    schema = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("n_shingles", pa.int64()), ("set_a", pa.int64()), ("set_b", pa.int64()), ("sig", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mult = b.multipliers()
        for s in tv.held(batches, "text"):
            h, off = shingles(s.column(1), b.words)
            n = np.diff(off)
            some = np.flatnonzero(n)
            sig = np.zeros((len(n), b.hashes), np.uint32)
            if len(some):
                starts = off[:-1][some]
                for r in range(b.hashes):
                    sig[some, r] = np.minimum.reduceat((h * mult[r]) >> U(32), starts)
            count, set_a, set_b = np.zeros(len(n), np.int64), np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
            for d in some.tolist():
                u = np.unique(h[off[d] : off[d + 1]])
                count[d] = len(u)
                set_a[d] = np.add.reduce(u * tv.MIX_B)
                set_b[d] = np.add.reduce(tv.mix(u))
            size = 4 * b.hashes
            packed = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(np.arange(0, (len(n) + 1) * size, size, dtype=np.int32)), pa.py_buffer(sig.tobytes())])
            yield pa.record_batch([s.column(0), s.column(2), pa.array(count), pa.array(set_a.view(np.int64)), pa.array(set_b.view(np.int64)), packed], schema=schema)

    return run


def _unpacked(col: pa.Array, hashes: int) -> np.ndarray:
    data, _ = tv.utf8(col)
    return data.view(np.uint8).copy().view(np.uint32).reshape(-1, hashes)


def _group_keys(sig: np.ndarray, b: Banding) -> np.ndarray:
    """One 64-bit value for each group of minhashes: columns 0..side-1 are A, the others B."""
    parts = sig.astype(np.uint64).reshape(len(sig), 2 * b.side, b.width)
    h = np.arange(1, 2 * b.side + 1, dtype=np.uint64)[None, :] * tv.STEP + np.zeros((len(sig), 1), np.uint64)
    for k in range(b.width):
        h = tv.mix(h + parts[:, :, k] * tv.PLACE[k])
    return h


def _groups(b: Banding):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in batches:
            keys = _group_keys(_unpacked(s.column(1), b.hashes), b)
            rep = np.repeat(s.column(0).to_numpy(zero_copy_only=False), 2 * b.side)
            at = np.tile(np.arange(2 * b.side, dtype=np.int32), len(keys))
            yield pa.record_batch({"rep": rep, "at": at, "key": keys.ravel().view(np.int64)})

    return run


def _tables(b: Banding):
    """Pair keys from the shared groups of A and of B."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                s = whole.slice(at, 4096)
                keys = _group_keys(_unpacked(s.column(1), b.hashes), b)
                mask = s.column(2).to_numpy(zero_copy_only=False)
                on = (mask[:, None] >> np.arange(2 * b.side)) & 1 == 1
                both = on[:, : b.side, None] & on[:, None, b.side :]
                pair = tv.mix(keys[:, : b.side, None] * tv.PLACE[1] + keys[:, None, b.side :] * tv.PLACE[2])
                row, _, _ = np.nonzero(both)
                yield pa.record_batch({"rep": s.column(0).to_numpy(zero_copy_only=False)[row], "key": pair[both].view(np.int64)})

    return run


def _agree(b: Banding):
    """Plausible pairs with their number of equal minhashes; columns lo, hi, sig_lo, sig_hi."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in batches:
            same = (_unpacked(s.column(2), b.hashes) == _unpacked(s.column(3), b.hashes)).sum(axis=1)
            on = pa.array(same >= b.plausible * b.hashes)
            yield pa.record_batch({"lo": s.column(0), "hi": s.column(1), "same": pa.array(same.astype(np.int32))}).filter(on)

    return run


class _Forest:
    """Union-find over the labels that one block pair sees."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = self.up.get(y, y)
            x = y
        return x

    def joins(self, x: int, y: int) -> bool:
        """Whether x and y were apart; they aren't afterwards."""
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def _keyed(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """All rows of each value of the first ``width`` columns; rows come sorted by them, and a value has a bounded number of rows."""
    open_key, kept = None, []

    def whole() -> pa.RecordBatch:
        return pa.Table.from_batches(kept).combine_chunks().to_batches()[0]

    for s in batches:
        if not s.num_rows:
            continue
        k = np.stack([s.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in range(width)], axis=1)
        cuts = [0, *(np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1).tolist(), len(k)]
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            if tuple(k[i]) != open_key and kept:
                yield whole()
                kept = []
            open_key = tuple(k[i])
            kept.append(s.slice(i, j - i))
    if kept:
        yield whole()
    tv.give_back()


def _pairs(lo: list[int], hi: list[int]) -> pa.RecordBatch:
    x, y = np.array(lo, np.int64), np.array(hi, np.int64)
    return pa.record_batch({"lo": np.minimum(x, y), "hi": np.maximum(x, y)})


def _bridges(b: Banding):
    """In each (key, left, right) block pair, plausible pairs that connect rough clusters.

    Columns: key, left, right, block, rep, cluster, sig. A block pair holds two
    blocks at most, which bounds the rows kept here.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _keyed(batches, 3):
            left, right = t.column(1)[0].as_py(), t.column(2)[0].as_py()
            block, rep, cluster = (t.column(k).to_numpy(zero_copy_only=False) for k in (3, 4, 5))
            sig, forest, lo, hi = _unpacked(t.column(6), b.hashes), _Forest(), [], []
            x, y = np.flatnonzero(block == left), np.flatnonzero(block == right)
            for i in x.tolist():
                js = y[y > i] if left == right else y
                js = js[cluster[js] != cluster[i]]
                if len(js):
                    for j in js[(sig[js] == sig[i]).sum(axis=1) >= b.plausible * b.hashes].tolist():
                        if forest.joins(int(cluster[i]), int(cluster[j])):
                            lo.append(int(rep[i]))
                            hi.append(int(rep[j]))
            if lo:
                yield _pairs(lo, hi)

    return run


def _places(b: Banding):
    """cluster, place, value for each minhash; columns cluster, sig."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in batches:
            sig = _unpacked(s.column(1), b.hashes)
            cluster = np.repeat(s.column(0).to_numpy(zero_copy_only=False), b.hashes)
            yield pa.record_batch({"cluster": cluster, "place": np.tile(np.arange(b.hashes, dtype=np.int32), len(sig)), "value": sig.ravel().astype(np.int64)})

    return run


def _nearness(b: Banding):
    """cluster, rep and the number of minhashes equal to the consensus; columns cluster, rep, sig, consensus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in batches:
            if not s.num_rows:
                continue
            consensus = s.column(3).flatten().to_numpy(zero_copy_only=False).reshape(-1, b.hashes)
            same = (_unpacked(s.column(2), b.hashes) == consensus).sum(axis=1)
            yield pa.record_batch({"cluster": s.column(0), "rep": s.column(1), "near": pa.array(same.astype(np.int32))})

    return run


def _sets(col: pa.Array, words: int) -> list[np.ndarray]:
    h, off = shingles(col, words)
    return [np.unique(h[off[d] : off[d + 1]]) for d in range(len(off) - 1)]


def _common(center: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of one set with many."""
    sizes = np.array([len(x) for x in others])
    if not len(center) or not sizes.sum():
        return np.zeros(len(others), np.int64)
    flat = np.concatenate(others)
    at = np.minimum(np.searchsorted(center, flat), len(center) - 1)
    ends = np.concatenate([[0], np.cumsum(center[at] == flat)])
    to = np.concatenate([[0], np.cumsum(sizes)])
    return ends[to[1:]] - ends[to[:-1]]


def _confirm(b: Banding):
    """center, other, inter, union of the full shingle sets.

    Columns: center, part, role, other, text. In the rows of a center's part, its
    own text comes first (role 0), then the others, which are compared with it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(0, np.uint64)
        for s in tv.held(batches, "text"):
            role, sets = s.column(2).to_numpy(zero_copy_only=False), _sets(s.column(4), b.words)
            inter, size = np.zeros(len(sets), np.int64), np.zeros(len(sets), np.int64)
            cuts = [*np.flatnonzero(role == 0).tolist(), len(sets)]
            for i, j in zip([0, *cuts[:-1]], cuts, strict=True):
                if i < len(sets) and role[i] == 0:
                    own = sets[i]
                inter[i:j], size[i:j] = _common(own, sets[i:j]), len(own)
            union = size + np.array([len(x) for x in sets], np.int64) - inter
            yield pa.record_batch([s.column(0), s.column(3), pa.array(inter), pa.array(union)], names=["center", "other", "inter", "union"]).filter(pa.array(role == 1))

    return run


#: Columns of the 0/1 matrices (rows by shingles) that are multiplied at once.
_COLUMNS = 4096


def _intersections(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of x with all of y."""
    nx, ny = np.array([len(s) for s in x]), np.array([len(s) for s in y])
    flat_x, flat_y = np.concatenate(x), np.concatenate(y)
    both = np.intersect1d(flat_x, flat_y)
    out = np.zeros((len(x), len(y)), np.float32)

    def cells(flat: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(both, flat)
        on = (at < len(both)) & (both[np.minimum(at, len(both) - 1)] == flat) if len(both) else np.zeros(len(flat), bool)
        return np.repeat(np.arange(len(counts)), counts)[on], at[on]

    (rx, cx), (ry, cy) = cells(flat_x, nx), cells(flat_y, ny)
    for first in range(0, len(both), _COLUMNS):
        parts = []
        for rows, cols, n in ((rx, cx, len(x)), (ry, cy, len(y))):
            m = np.zeros((n, _COLUMNS), np.float32)
            on = (cols >= first) & (cols < first + _COLUMNS)
            m[rows[on], cols[on] - first] = 1
            parts.append(m)
        out += parts[0] @ parts[1].T
    return out


def _connecting(b: Banding):
    """In each (cluster, i, j) block, the links that connect components.

    Columns: cluster, i, j, minor, rep, component, far, text: a block of the
    cluster's members and a block of those outside its main component, with
    their distances to the pivot. Both blocks are gone through in tiles, in the
    order of that distance, and a tile meets only what the triangle inequality
    leaves.
    """
    reach = 1 - b.percent / 100 + 1e-9

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _keyed(batches, 3):
            minor, rep, comp, far = (t.column(k).to_numpy(zero_copy_only=False) for k in (3, 4, 5, 6))
            x, y = np.flatnonzero(~minor), np.flatnonzero(minor)
            if not len(x) or not len(y):
                continue
            sets = [z for s in tv.slices(t, "text") for z in _sets(s.column(7), b.words)]
            size = np.array([len(z) for z in sets])
            x, y = x[np.argsort(far[x], kind="stable")], y[np.argsort(far[y], kind="stable")]
            forest, lo, hi = _Forest(), [], []
            for at in range(0, len(x), b.tile):
                p = x[at : at + b.tile]
                near = y[np.searchsorted(far[y], far[p[0]] - reach) : np.searchsorted(far[y], far[p[-1]] + reach, side="right")]
                for to in range(0, len(near), b.tile):
                    q = near[to : to + b.tile]
                    inter = _intersections([sets[k] for k in p], [sets[k] for k in q])
                    union = size[p][:, None] + size[q][None, :] - inter
                    hit = (inter * 100 >= union * b.percent) & (comp[p][:, None] != comp[q][None, :])
                    for i, j in zip(*np.nonzero(hit), strict=True):
                        if forest.joins(int(comp[p[i]]), int(comp[q[j]])):
                            lo.append(int(rep[p[i]]))
                            hi.append(int(rep[q[j]]))
            if lo:
                yield _pairs(lo, hi)

    return run


def _compared(pairs: DataFrame, texts: DataFrame, sizes: DataFrame, b: Banding, name: str) -> DataFrame:
    """center, other, inter, union of each pair (center, other).

    A center with many others goes to as many parts as their shingles fill, so a
    task reads a center's text once per part and a bounded number of others.
    """
    sized = pairs.join(sizes.select(F.col("rep").alias("other"), "n_shingles"), "other")
    load = sized.groupBy("center").agg(F.greatest(F.ceil(F.sum("n_shingles") / b.block_shingles), F.lit(1)).alias("parts"))
    part = F.pmod(F.xxhash64("other"), F.col("parts"))
    others = pairs.join(load, "center").select("center", part.alias("part"), F.lit(1).alias("role"), "other")
    centers = load.select("center", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"), F.lit(0).alias("role"), F.col("center").alias("other"))
    rows = others.unionByName(centers).join(texts.withColumnRenamed("rep", "other"), "other").select("center", "part", "role", "other", "text")
    rows = rows.repartition("center", "part").sortWithinPartitions("center", "part", "role")
    return stored(rows.mapInArrow(_confirm(b), "center long, other long, inter long, `union` long"), name)


def _plausible(pairs: DataFrame, reps: DataFrame, b: Banding, name: str) -> DataFrame:
    lo, hi = (reps.select(F.col("rep").alias(x), F.col("sig").alias(f"sig_{x}")) for x in ("lo", "hi"))
    both = pairs.distinct().join(hi, "hi").join(lo, "lo").select("lo", "hi", "sig_lo", "sig_hi")
    return stored(both.mapInArrow(_agree(b), "lo long, hi long, same int"), name)


def _links(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("lo").alias("u"), F.col("hi").alias("v"))


def _grown(found: DataFrame, links: DataFrame) -> DataFrame:
    """Components of those found and further links (u, v)."""
    out = components(found.select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(links))
    drop_stored(found)
    return out


def _placed(members: DataFrame, found: DataFrame) -> DataFrame:
    near = found.select(F.col("node").alias("rep"), F.col("component").alias("cluster"))
    return members.join(near, "rep", "left").withColumn("cluster", F.coalesce("cluster", "rep"))


def _rough_clusters(members: DataFrame, reps: DataFrame, b: Banding) -> tuple[DataFrame, DataFrame]:
    """Plausible pairs (lo, hi, same) and the clusters (rep, cluster) that they make."""
    stars = _plausible(members.filter("rep > least").select(F.col("least").alias("lo"), F.col("rep").alias("hi")), reps, b, "stars")
    found = components(_links(stars))

    # Buckets in several clusters: who isn't in the cluster of a member picked by hash is compared with that one.
    placed = first_placed = stored(_placed(members, found), "placed")
    spot = F.col("rep").bitwiseXOR(F.col("key"))
    picked = placed.groupBy("key").agg(F.min("cluster").alias("x"), F.max("cluster").alias("y"), F.min(spot).alias("spot"), F.min_by("cluster", spot).alias("at"))
    picked = picked.filter("x <> y").select(F.col("key").alias("k"), "at", F.col("spot").bitwiseXOR(F.col("key")).alias("other"))
    across = placed.join(picked, (F.col("key") == F.col("k")) & (F.col("cluster") != F.col("at")))
    more = _plausible(across.select(F.least("rep", "other").alias("lo"), F.greatest("rep", "other").alias("hi")), reps, b, "more-stars")
    pairs = stars.unionByName(more)
    if not more.isEmpty():
        found = _grown(found, _links(more))
        placed = _placed(members, found)

    # A bucket with a dominant cluster puts its few others into that cluster, where full sets decide.
    # What is apart in other buckets is compared in blocks.
    per = placed.groupBy("key", "cluster").agg(F.count("*").alias("m"), F.max("n").alias("n"))
    main = per.groupBy("key").agg(F.max(F.struct("m", "cluster")).alias("top"), F.max("n").alias("n")).filter("top.m < n")
    main = main.select(F.col("key").alias("k"), F.col("top.cluster").alias("main"), ((F.col("top.m") >= b.dominant) & (F.col("top.m") >= F.col("n") * b.dominant_share)).alias("dominated"))
    main = stored(main, "apart")
    forced = per.join(main.filter("dominated"), F.col("key") == F.col("k")).filter("cluster <> main").select(F.col("cluster").alias("u"), F.col("main").alias("v")).distinct()
    forced = stored(forced, "forced")
    apart = main.filter("not dominated").select(F.col("k").alias("key"))
    n_blocks = F.ceil(F.col("n") / b.block)
    rest = placed.join(apart, "key").withColumn("block", F.pmod(F.xxhash64("rep", "key"), n_blocks))
    rest = rest.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), n_blocks - 1)))
    rest = rest.select("key", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"), "block", "rep", "cluster")
    rest = rest.join(reps, "rep").select("key", "left", "right", "block", "rep", "cluster", "sig")
    rest = rest.repartition("key", "left", "right").sortWithinPartitions("key", "left", "right", "rep")
    bridges = stored(rest.mapInArrow(_bridges(b), "lo long, hi long").distinct(), "bridges")
    if not (bridges.isEmpty() and forced.isEmpty()):
        found = _grown(found, forced.unionByName(_links(bridges)))
        pairs = pairs.unionByName(bridges.withColumn("same", F.lit(0)))
    pairs = stored(pairs, "star-pairs")
    cluster = found.select(F.col("node").alias("rep"), F.col("component").alias("cluster"))
    cluster = cluster.unionByName(cluster.select(F.col("cluster").alias("rep"), "cluster").distinct())
    cluster = stored(cluster, "clusters")
    drop_stored(stars, more, first_placed, main, forced, bridges, found)
    return pairs, cluster


def _pivots(clusters: DataFrame, reps: DataFrame, b: Banding) -> DataFrame:
    """lo, hi: each cluster's member nearest to its consensus, paired with every other member."""
    sigs = clusters.join(reps, "rep").select("cluster", "rep", "sig")
    counts = sigs.select("cluster", "sig").mapInArrow(_places(b), "cluster long, place int, value long").groupBy("cluster", "place", "value").agg(F.count("*").alias("n"))
    top = counts.groupBy("cluster", "place").agg(F.max(F.struct("n", "value")).alias("top")).select("cluster", "place", F.col("top.value").alias("value"))
    consensus = top.groupBy("cluster").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "value"))), lambda x: x["value"]).alias("consensus"))
    near = sigs.join(consensus, "cluster").select("cluster", "rep", "sig", "consensus").mapInArrow(_nearness(b), "cluster long, rep long, near int")
    pivot = near.groupBy("cluster").agg(F.max(F.struct("near", (-F.col("rep")).alias("m"))).alias("p")).select("cluster", (-F.col("p.m")).alias("pivot"))
    return pivot


def _left_apart(clusters: DataFrame, found: DataFrame, distances: DataFrame, texts: DataFrame, sizes: DataFrame, b: Banding) -> tuple[DataFrame, DataFrame]:
    """Links u, v between what lies outside a cluster's main component and the rest of the cluster.

    ``distances``: rep, far (Jaccard distance to the cluster's pivot; the pivot
    itself isn't in it). Also returns the table that the links are read from.
    """
    at = clusters.join(found.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    per = at.groupBy("cluster", "component").agg(F.count("*").alias("n"))
    main = per.groupBy("cluster").agg(F.max(F.struct("n", "component"))["component"].alias("main"), F.sum("n").alias("n"), F.max("n").alias("most")).filter("n > most").select("cluster", "main")
    # Sizes of linked sets differ by less than a band.
    band = F.floor(F.log(F.col("n_shingles").cast("double")) / F.log(F.lit(100.0 / b.percent)) * (1 - 1e-12)).cast("int")
    at = at.join(main, "cluster").join(sizes, "rep").join(distances, "rep", "left")
    parted = stored(at.select("cluster", "rep", "component", F.coalesce("far", F.lit(0.0)).alias("far"), band.alias("band"), "n_shingles", (F.col("component") != F.col("main")).alias("minor")), "parted")

    def blocks(rows: DataFrame) -> DataFrame:
        return rows.groupBy("cluster", "band").agg(F.greatest(F.ceil(F.sum("n_shingles") / b.block_shingles), F.lit(1)).alias("blocks"))

    zero, beside = F.lit(0).cast("bigint"), F.explode(F.array(*[F.col("band") + k for k in (-1, 0, 1)]))
    all_blocks, minor_blocks = blocks(parted), blocks(parted.filter("minor"))

    def spread(rows: DataFrame, own: DataFrame, opposite: DataFrame, salt: int, minor: bool) -> DataFrame:
        """Each row in its own block, once for each block of the other side in its band and the two beside it."""
        mine = F.format_string("%d:%d", F.col("band"), F.pmod(F.xxhash64("rep", F.lit(salt)), F.col("blocks")))
        out = rows.join(own, ["cluster", "band"]).withColumn("mine", mine).drop("blocks").withColumn("beside", beside)
        out = out.join(opposite.withColumnRenamed("band", "beside"), ["cluster", "beside"])
        out = out.withColumn("k", F.explode(F.sequence(zero, F.col("blocks") - 1)))
        theirs = F.format_string("%d:%d", F.col("beside"), F.col("k"))
        i, j = (theirs, F.col("mine")) if minor else (F.col("mine"), theirs)
        return out.select("cluster", i.alias("at_i"), j.alias("at_j"), F.lit(minor).alias("minor"), "rep", "component", "far")

    every = spread(parted, all_blocks, minor_blocks, 0, False)
    minors = spread(parted.filter("minor"), minor_blocks, all_blocks, 1, True)
    both = every.unionByName(minors).join(texts.select("rep", "text"), "rep")
    both = both.select("cluster", F.xxhash64("at_i").alias("i"), F.xxhash64("at_j").alias("j"), "minor", "rep", "component", "far", "text")
    both = both.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")
    return both.mapInArrow(_connecting(b), "lo long, hi long").select(F.col("lo").alias("u"), F.col("hi").alias("v")), parted


#: Ids (8 bytes each) that may be broadcast to pick the texts of clusters; beyond, the texts are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def near_duplicates(docs: DataFrame, banding: Banding = Banding(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of ``docs``."""
    b = banding
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn("h", F.xxhash64("text"))
    sigs = stored(rows.mapInArrow(_signatures(b), "doc_id long, h long, n_shingles long, set_a long, set_b long, sig binary"), "minhash")
    same = ["set_a", "set_b", "n_shingles"]
    with_set = sigs.filter("n_shingles > 0 and doc_id is not null")
    classes = with_set.groupBy(*same).agg(F.min(F.struct("doc_id", "h")).alias("head"), F.any_value("sig").alias("sig"))
    classes = stored(classes.select(F.monotonically_increasing_id().alias("rep"), *same, F.col("head.doc_id").alias("least_id"), F.col("head.h").alias("h"), "sig"), "classes")
    reps = classes.select("rep", "n_shingles", "sig")
    repeated = stored(sigs.filter("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id"), "repeated")

    # Groups of minhashes that two classes share, as a bit mask per class.
    groups = reps.select("rep", "sig").mapInArrow(_groups(b), "rep long, at int, key long")
    shared = groups.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    bit = F.expr("shiftleft(1L, at)")
    masks = groups.join(shared, "key", "left_semi").groupBy("rep").agg(F.bit_or(bit).alias("mask"))
    sides = (1 << b.side) - 1
    masks = masks.filter((F.col("mask").bitwiseAND(F.lit(sides)) > 0) & (F.col("mask") > sides))
    keys = reps.join(masks, "rep").select("rep", "sig", "mask").mapInArrow(_tables(b), "rep long, key long")
    keys = stored(keys.distinct(), "keys")
    buckets = keys.groupBy("key").agg(F.count("*").alias("n"), F.min("rep").alias("least"), F.sum(F.xxhash64("rep").cast("decimal(38,0)")).alias("who")).filter("n > 1")
    # Buckets with the same members say the same: one of them is enough.
    buckets = buckets.groupBy("n", "least", "who").agg(F.min("key").alias("key")).select("key", "n", "least")
    members = stored(keys.join(buckets, "key"), "members")
    drop_stored(keys)

    pairs, clusters = _rough_clusters(members, reps, b)
    drop_stored(members)
    wanted = clusters.join(classes, "rep").select("rep", F.col("least_id").alias("doc_id"), "h")
    if clusters.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    texts = rows.join(wanted, ["doc_id", "h"]).select("rep", "text")
    ids_repeat = not repeated.isEmpty()
    if ids_repeat:
        texts = texts.dropDuplicates(["rep"])
    texts = stored(texts, "near-texts", compression="zstd")
    sizes = classes.select("rep", "n_shingles")

    pivot = stored(_pivots(clusters, reps, b), "pivots")
    from_pivot = clusters.join(pivot, "cluster").filter("rep <> pivot").select(F.col("pivot").alias("center"), F.col("rep").alias("other"))
    best = pairs.groupBy("hi").agg(F.max(F.struct("same", "lo"))["lo"].alias("center")).select("center", F.col("hi").alias("other"))
    done = _compared(from_pivot.unionByName(best).distinct(), texts, sizes, b, "compared")
    links = done.filter(F.col("inter") * 100 >= F.col("union") * b.percent).select(F.col("center").alias("u"), F.col("other").alias("v"))
    if ids_repeat:
        # The classes of one document id are one node.
        owners = with_set.join(repeated, "doc_id", "left_semi").join(classes.select(*same, "rep"), same).select("doc_id", "rep").distinct()
        links = links.unionByName(owners.join(owners.groupBy("doc_id").agg(F.min("rep").alias("u")), "doc_id").select("u", F.col("rep").alias("v")))
    found = components(links)
    far = (1 - F.col("inter") / F.col("union")).alias("far")
    of_pivot = clusters.join(pivot, "cluster").select(F.col("pivot").alias("center"), F.col("rep").alias("other"))
    distances = done.join(of_pivot, ["center", "other"]).select(F.col("other").alias("rep"), far)
    late, parted = _left_apart(clusters, found, distances, texts, sizes, b)
    more = stored(late, "late-links")
    if not more.isEmpty():
        found = _grown(found, more)
    drop_stored(pairs, clusters, texts, pivot, done, parted, more)

    # A component is named by the least document id of its classes.
    placed = classes.select("rep", *same, "least_id").join(found.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    names = placed.groupBy("component").agg(F.min("least_id").alias("component_id"))
    named = sigs.select("doc_id", *same).join(placed.join(names, "component").select(*same, "component_id"), same, "left")
    if ids_repeat:
        # A row without shingles has the component of its id's other rows.
        of_id = with_set.join(repeated, "doc_id", "left_semi").join(placed.join(names, "component").select(*same, F.col("component_id").alias("of_id")), same).groupBy("doc_id").agg(F.min("of_id").alias("of_id"))
        named = named.join(of_id, "doc_id", "left").withColumn("component_id", F.coalesce("component_id", "of_id"))
    named = named.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")))
    return named.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
