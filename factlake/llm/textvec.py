"""Whole-batch text work on Arrow buffers: words, word hashes, n-gram hashes.

All functions see the UTF-8 bytes of a slice of rows at once, so the cost is a
few numpy passes over the bytes and not Python work per word. Slices hold
``SLICE_BYTES`` of text at most (one longer document makes a slice of its own),
which bounds the temporaries.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
U = np.uint64

#: `[\x20\x09-\x0D]`
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: ASCII letters, and the visible ASCII characters that are neither letter nor digit.
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True
SIGN = np.zeros(256, bool)
SIGN[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_rng = np.random.default_rng(20240607)
BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | U(1)
STEP = U(0x9E3779B97F4A7C15)
MIX_A, MIX_B = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
#: One odd multiplier for each place in an n-gram.
PLACE = _rng.integers(1, 2**63, 64, dtype=np.uint64) | U(1)


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    h = h ^ (h >> U(30))
    h *= MIX_A
    h ^= h >> U(27)
    h *= MIX_B
    h ^= h >> U(31)
    return h


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts have ``most`` bytes together at most, one row at least."""
    col = batch.column(batch.schema.get_field_index(column))
    n = len(col)
    if not n:
        return
    off = offsets_of(col)
    at = 0
    while at < n:
        end = int(np.searchsorted(off, off[at] + most, side="right")) - 1
        end = min(max(end, at + 1), n)
        yield batch.slice(at, end - at)
        at = end


def offsets_of(col: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else np.int32
    buf = col.buffers()[1]
    if buf is None:
        return np.zeros(len(col) + 1, np.int64)
    return np.frombuffer(buf, kind, len(col) + 1, col.offset * np.dtype(kind).itemsize).astype(np.int64)


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null rows are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    off = offsets_of(col)
    buf = col.buffers()[2]
    if buf is None or off[-1] == off[0]:
        return np.zeros(0, np.uint8), off - off[0]
    return np.frombuffer(buf, np.uint8, int(off[-1] - off[0]), int(off[0])), off - off[0]


class Words:
    """The words `[^\\x20\\x09-\\x0D]+` of a slice of rows.

    ``space``: the bytes that part words. ``starts``: byte at which each word begins; ``rows``: for each row, the
    index of its first word (one more entry than rows); ``hashes``: 64 bits of
    each word's bytes and length; ``prefixes``: of its first ``prefix`` bytes.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE, prefix: int = 0):
        self.data, self.offsets = data, offsets
        space_of = space
        n = len(data)
        if not n:
            self.starts = self.lengths = np.zeros(0, np.int64)
            self.hashes = self.prefixes = np.zeros(0, np.uint64)
            self.rows = np.zeros(len(offsets), np.int64)
            return
        space = space_of[data]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        before = np.empty(n, bool)
        before[0] = True
        before[1:] = space[:-1]
        self.starts = np.flatnonzero(~space & (before | edge[:-1]))
        after = np.empty(n, bool)
        after[-1] = True
        after[:-1] = space[1:]
        ends = np.flatnonzero(~space & (after | edge[1:]))
        self.lengths = ends - self.starts + 1
        self.rows = np.searchsorted(self.starts, offsets)
        self.hashes, self.prefixes = self._hash(space, prefix)

    def _hash(self, space: np.ndarray, prefix: int) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.starts):
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        first = int(self.starts[0])
        span = np.diff(np.append(self.starts, len(self.data)))
        place = np.arange(first, len(self.data)) - np.repeat(self.starts, span)
        powers = np.cumprod(np.full(int(self.lengths.max()), STEP))
        np.minimum(place, len(powers) - 1, out=place)
        value = BYTE_CODE[self.data[first:]]
        value[space[first:]] = 0
        value *= powers[place]
        h = np.add.reduceat(value, self.starts - first)
        h += self.lengths.astype(np.uint64) * MIX_A
        if not prefix:
            return mix(h), h
        value[place >= prefix] = 0
        return mix(h), mix(np.add.reduceat(value, self.starts - first))


def grams(hashes: np.ndarray, rows: np.ndarray, width: int, skip: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``width`` words inside rows, and the rows' offsets into them.

    With ``skip``, pairs whose words have ``skip`` words between them (width 2).
    """
    reach = width + skip
    n = len(hashes) - reach + 1
    counts = np.maximum(np.diff(rows) - reach + 1, 0)
    offsets = np.concatenate([[0], np.cumsum(counts)])
    if n <= 0 or not offsets[-1]:
        return np.zeros(0, np.uint64), offsets
    places = [0, width - 1 + skip] if skip else range(width)
    h = np.full(n, U((width * 64 + skip) * 0x51ED2701 + 1))
    for k, p in enumerate(places):
        h += hashes[p : p + n] * PLACE[k]
    owner = np.repeat(np.arange(len(rows) - 1), counts)
    at = rows[:-1][owner] + np.arange(offsets[-1]) - offsets[:-1][owner]
    return mix(h[at]), offsets


def row_index(offsets: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def lowered(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """As ``utf8``, with A-Z as a-z."""
    data, offsets = utf8(col)
    return LOWER[data], offsets


_kept: dict[str, Any] = {}
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def kept(key: str, make: Callable[[], Any]) -> Any:
    """What this process keeps under ``key`` between the tasks of one operator; one thing at a time."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def give_back() -> None:
    """Return freed memory to the system: Arrow's pool and malloc hold on to it, and a Python worker outlives its tasks."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def held(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES, keep: str | None = None) -> Iterator[pa.RecordBatch]:
    """All slices of all batches of a task. First the worker forgets what it keeps under another key than ``keep``."""
    if keep not in _kept:
        _kept.clear()
    try:
        for batch in batches:
            yield from slices(batch, column, most)
    finally:
        give_back()


def latin_lowered(data: np.ndarray) -> np.ndarray:
    """A-Z and the capitals of Latin-1 (two bytes, C3 80 to C3 9E) as small letters."""
    out = LOWER[data]
    if len(data) > 1:
        capital = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        out[1:][capital] += 0x20
    return out


def spaced(col: pa.Array) -> pa.Array:
    """Each text with a blank before and after; null is two blanks."""
    blank = pa.scalar(" ", col.type)
    return pc.binary_join_element_wise(blank, col.fill_null(""), blank, pa.scalar("", col.type))


def byte_grams(data: np.ndarray, widths: tuple[int, ...], bits: int) -> list[np.ndarray]:
    """For each width, the bucket of the bytes from each position on; -1 where white space is inside.

    White space may be the first or last byte, where it marks a word's edge.
    Rows made by ``spaced`` touch in two blanks, so no gram crosses rows.
    """
    space = SPACE[data]
    code = BYTE_CODE[np.where(space, np.uint8(32), data)]
    powers = np.cumprod(np.full(max(widths), STEP))
    out, h, bad = [], code, None
    for k in range(1, max(widths)):
        n = len(data) - k
        if n <= 0:
            out += [np.full(len(data), -1, np.int32) for w in widths if w == k + 1]
            continue
        h = h[:n] + code[k:] * powers[k - 1]
        inner = space[k - 1 : k - 1 + n] if k > 1 else None
        bad = inner if bad is None else bad[:n] | inner
        if k + 1 in widths:
            b = ((h ^ (h >> U(29))) * MIX_A >> U(64 - bits)).astype(np.int32)
            if bad is not None:
                b[bad] = -1
            else:
                b[space[:n] & space[k:]] = -1
            out.append(np.concatenate([b, np.full(k, -1, np.int32)]))
    return out


def code_points(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Unicode code points of a string column and the rows' offsets into them; null rows are empty."""
    data, offsets = utf8(col)
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return points, before[offsets]


def char_grams(points: np.ndarray, widths: tuple[int, ...], bits: int) -> list[np.ndarray]:
    """For each width, the bucket of the characters from each position on; -1 where white space is inside.

    White space may be the first or last character, where it marks a word's
    edge. Rows made by ``spaced`` touch in two blanks, so no gram crosses rows.
    """
    space = (points == 0x20) | ((points >= 9) & (points <= 13))
    code = mix(np.where(space, U(0x20), points.astype(U)) + STEP)
    powers = np.cumprod(np.full(max(widths), STEP))
    out, h, bad = [], code, np.zeros(len(points), bool)
    for k in range(1, max(widths)):
        n = max(0, len(points) - k)
        h = h[:n] + code[k:] * powers[k - 1]
        bad = bad[:n] | space[k - 1 : k - 1 + n] if k > 1 else bad[:n]
        if k + 1 in widths:
            b = (mix(h + U(k)) >> U(64 - bits)).astype(np.int32)
            b[bad | (space[:n] & space[k : k + n])] = -1
            out.append(np.concatenate([b, np.full(len(points) - n, -1, np.int32)]))
    return out
