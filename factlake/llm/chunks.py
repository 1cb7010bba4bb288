"""Encoding texts by their distinct chunks.

A tokenizer that treats a text as a sequence of independent chunks gives the
same ids whether it gets the text or its chunks. Arrow finds the distinct
chunks of a slice of rows; only those not seen before are encoded; the ids of
the rows are then gathered with numpy. The memory of seen chunks is bounded.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

#: Chunks that a Python worker remembers, and ids for each on average; when full, it keeps those and encodes others each time.
MOST_CHUNKS = 1_000_000
IDS_PER_CHUNK = 6


def _room(x: np.ndarray, n: int) -> np.ndarray:
    return x if n <= len(x) else np.concatenate([x, np.zeros(max(n - len(x), len(x)), x.dtype)])


class ChunkEncoder:
    """``encode``: list of chunks (bytes) -> the chunks in an order of its own, their flat ids, the ids of each chunk."""

    def __init__(self, encode: Callable[[list[bytes]], tuple[list[bytes], np.ndarray, np.ndarray]], most_chunks: int = MOST_CHUNKS):
        self.encode, self.most_chunks = encode, most_chunks
        self.seen: dict[bytes, int] = {}
        self.starts = np.zeros(1024, np.int32)
        self.ids = np.zeros(4096, np.int32)

    def _places(self, distinct: list[bytes]) -> np.ndarray:
        """Index into ``starts`` of each chunk; new chunks are encoded behind the remembered ones."""
        get, known = self.seen.get, len(self.seen)
        place = np.array([get(c, -1) for c in distinct], np.int64)
        new = np.flatnonzero(place < 0)
        if not len(new):
            return place
        chunks, ids, counts = self.encode([distinct[k] for k in new.tolist()])
        n_ids = int(self.starts[known])
        self.starts = _room(self.starts, known + len(new) + 1)
        self.ids = _room(self.ids, n_ids + len(ids))
        self.ids[n_ids : n_ids + len(ids)] = ids
        self.starts[known + 1 : known + len(new) + 1] = n_ids + np.cumsum(counts)
        at = dict(zip(chunks, range(known, known + len(chunks)), strict=True))
        place[new] = [at[distinct[k]] for k in new.tolist()]
        if known + len(chunks) <= self.most_chunks and n_ids + len(ids) <= IDS_PER_CHUNK * self.most_chunks:
            self.seen.update(at)
        return place

    def rows(self, data: np.ndarray, cuts: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows and the rows' offsets into them.

        ``cuts``: the bytes at which chunks begin, rows' first bytes among them.
        """
        if not len(cuts):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        ends = np.append(cuts, len(data)).astype(np.int32)
        chunks = pa.Array.from_buffers(pa.binary(), len(cuts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])
        coded = chunks.dictionary_encode()
        place = self._places(coded.dictionary.to_pylist())
        begin, count = self.starts[place], np.diff(self.starts)[place]
        which = coded.indices.to_numpy(zero_copy_only=False)
        begin, count = begin[which], count[which]
        to = np.concatenate([[0], np.cumsum(count)])
        ids = self.ids[np.repeat(begin - to[:-1], count) + np.arange(to[-1])]
        return ids, to[np.searchsorted(cuts, offsets)]


def blank_cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Marks where chunks may begin: at rows' first bytes and at each single blank between two visible characters.

    A neighbour counts as visible if it is an ASCII character above the blank,
    or a two-byte character from U+00C0 on; others (Unicode has white space
    among them) just make longer chunks.
    """
    n = len(data)
    cut = np.zeros(n, bool)
    if n > 2:
        visible = (data > 0x20) & (data < 0x7F)
        lead = (data >= 0xC3) & (data <= 0xDF)
        ends = visible.copy()
        ends[1:] |= lead[:-1]
        cut[1:-1] = (data[1:-1] == 0x20) & ends[:-2] & (visible | lead)[2:]
        inside = np.ones(n + 1, bool)
        inside[offsets] = False  # neighbours must lie in the same row
        cut[1:-1] &= inside[1 : n - 1] & inside[2:n]
    cut[offsets[:-1][np.diff(offsets) > 0]] = True
    return cut
