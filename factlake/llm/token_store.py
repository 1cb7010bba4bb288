"""Token ids in Parquet, written in document order and read back selectively.

File format: rows in ascending doc_id order with the columns doc_id, n_tokens
and tokens (list of int32, each document ending with ``end_id``). Dictionary
encoding with a delta fallback (format version 2), row groups of bounded bytes,
small pages with a page index, so a reader gets the metadata columns or the
tokens of a range of documents without the rest. The files' paths are in
document order (Spark numbers them by partition).

Encoding is the tokenizers library's; it gets the distinct chunks of a slice of
rows (see ``chunks``). A byte-level pre-tokenizer with its own pattern and no
normaliser begins a new token at a single blank between two visible characters
and after an ASCII letter before ASCII punctuation, and no token crosses, so
chunks cut there have the same ids as the whole text. Whether a tokenizer file
is of that kind is read from the file; texts of any other file go to the
library whole. Strings of special tokens inside a text are what the library
takes them for, special tokens; no chunk is cut inside one.

Defined cases: null and empty texts have the end id alone; rows that repeat a
doc_id are ordered by text, equal rows are interchangeable; rows without doc_id
come first; an empty table gives no rows. Columns beyond doc_id and text are
ignored.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textvec as tv
from .chunks import ChunkEncoder, blank_cuts
from .workspace import new_path, ship

END_ID = 0
#: Chunks that go to the library as one text.
JOINED = 256
#: Text that is encoded at once.
SLICE_BYTES = 2 << 20
#: Bytes of input that make a file, as Spark estimates them from the scan.
FILE_BYTES = 128 << 20
MOST_FILES = 100_000
WRITER = {
    "compression": "zstd",
    "parquet.enable.dictionary": "true",
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "parquet.dictionary.page.size": str(1 << 20),
}


def byte_lengths(tokenizer) -> np.ndarray:
    """Bytes that each id stands for: the byte-level alphabet has one character per byte."""
    size = np.zeros(tokenizer.get_vocab_size(with_added_tokens=True), np.int64)
    for token, k in tokenizer.get_vocab(with_added_tokens=True).items():
        size[k] = len(token)
    return size


#: A chunk that is one piece for the pre-tokenizer: letters of ASCII and Latin-1, a blank before them or not.
_WORD = re.compile(rb" ?(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")


def byte_alphabet() -> dict[int, str]:
    """The byte-level alphabet: printable bytes as themselves, the others as characters from U+0100 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) if b in own else chr(256 + others.index(b)) for b in range(256)}


def chunk_encode(tokenizer):
    """Encode chunks.

    Single words go straight to the library's BPE model. Of the others, those
    that begin with a blank and end visibly are joined into longer texts, whose
    ids are cut again by the bytes that they stand for.
    """
    size, alphabet, model = byte_lengths(tokenizer), byte_alphabet(), tokenizer.model

    def encode(chunks: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        words, parts, whole = [], [], []
        for c in chunks:
            if _WORD.fullmatch(c):
                words.append(c)
            elif len(c) > 1 and c[0] == 32 and 32 < c[1] < 127 and 32 < c[-1] < 127:
                parts.append(c)
            else:
                whole.append(c)
        pieces = [[t.id for t in model.tokenize(c.decode("latin-1").translate(alphabet))] for c in words]
        joined = [b"".join(parts[i : i + JOINED]) for i in range(0, len(parts), JOINED)]
        coded = [e.ids for e in tokenizer.encode_batch_fast([t.decode() for t in [*whole, *joined]], add_special_tokens=False)]
        pieces += coded[: len(whole)]
        counts = [np.fromiter(map(len, pieces), np.int64, len(pieces))]
        ids = [np.fromiter(chain.from_iterable(pieces), np.int32, int(counts[0].sum()))]
        if parts:
            last = np.fromiter(chain.from_iterable(coded[len(whole) :]), np.int32)
            ends = np.searchsorted(np.cumsum(size[last]), np.cumsum([len(c) for c in parts])) + 1
            ids.append(last)
            counts.append(np.diff(ends, prepend=0))
        return words + whole + parts, np.concatenate(ids), np.concatenate(counts)

    return encode


@dataclass(frozen=True)
class Coder:
    """A tokenizer with the encoder of its chunks (None: texts must stay whole) and the strings of its added tokens."""

    tokenizer: object
    encoder: ChunkEncoder | None
    added: tuple[bytes, ...]


def cuts_allowed(spec: dict) -> bool:
    """Whether a tokenizer file is plain byte-level BPE, for which the cuts of ``cuts_of`` hold."""
    pre, model = spec.get("pre_tokenizer") or {}, spec.get("model") or {}
    byte_level = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space", True)
    plain_model = model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    plain_added = not any(t.get(k) for t in spec.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip", "normalized"))
    return bool(byte_level and plain_model and plain_added and spec.get("normalizer") is None)


@lru_cache(maxsize=2)
def _coder(path: str) -> Coder:
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    tokenizer = Tokenizer.from_file(path)
    added = tuple(t["content"].encode() for t in spec.get("added_tokens", []) if t["content"])
    return Coder(tokenizer, ChunkEncoder(chunk_encode(tokenizer)) if cuts_allowed(spec) else None, added)


def cuts_of(data: np.ndarray, offsets: np.ndarray, added: tuple[bytes, ...] = ()) -> np.ndarray:
    """The bytes at which chunks begin: none inside an occurrence of an added token's string."""
    cut = blank_cuts(data, offsets)
    cut[1:] |= tv.LETTER[data[:-1]] & tv.SIGN[data[1:]]
    raw = data.tobytes()
    for token in added:
        at = raw.find(token)
        while at >= 0:
            cut[at + 1 : at + len(token)] = False
            at = raw.find(token, at + 1)
    cut[offsets[:-1][np.diff(offsets) > 0]] = True  # rows begin chunks even where a string reaches over two of them
    return np.flatnonzero(cut)


def encode_rows(col: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the rows (without end ids) and the rows' offsets into them."""
    coder = _coder(path)
    if coder.encoder is None:
        coded = coder.tokenizer.encode_batch_fast(col.fill_null("").to_pylist(), add_special_tokens=False)
        ids = [e.ids for e in coded]
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.int32, int(counts.sum())), np.concatenate([[0], np.cumsum(counts)])
    data, offsets = tv.utf8(col)
    return coder.encoder.rows(data, cuts_of(data, offsets, coder.added), offsets)


def _with_end(ids: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    to = offsets + np.arange(len(offsets))
    out = np.full(to[-1], end_id, np.int32)
    keep = np.ones(to[-1], bool)
    keep[to[1:] - 1] = False
    out[keep] = ids
    return out, to


def _tokens(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in tv.held(batches, "text", SLICE_BYTES):
            ids, to = _with_end(*encode_rows(s.column(1), path), end_id)
            tokens = pa.ListArray.from_arrays(pa.array(to.astype(np.int32)), pa.array(ids))
            yield pa.record_batch([s.column(0), pa.array(np.diff(to).astype(np.int32)), tokens], names=["doc_id", "n_tokens", "tokens"])

    return run


def file_count(rows: DataFrame) -> int:
    """Ranges that the rows are written in: by the estimated size of the scan, and one per shuffle partition at least."""
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(least, min(math.ceil(size / FILE_BYTES), MOST_FILES))


def write_tokens(docs: DataFrame, tokenizer_path: str, path: str, end_id: int = END_ID) -> None:
    """Write the files of ``docs`` (doc_id, text) to the folder ``path``."""
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.repartitionByRange(file_count(rows), "doc_id").sortWithinPartitions("doc_id", "text")
    coded = rows.mapInArrow(_tokens(tokenizer_path, end_id), "doc_id long, n_tokens int, tokens array<int>")
    coded.write.options(**WRITER).parquet(path)


def read_tokens(spark, path: str) -> DataFrame:
    """doc_id, n_tokens, tokens and part (the file's place in document order).

    A task may write several files (``spark.sql.files.maxRecordsPerFile``), so
    the place is made of the task's number and the file's number in the task.
    """
    name = F.col("_metadata.file_name")
    task, nth = (F.regexp_extract(name, x, 1).cast("bigint") for x in (r"part-(\d+)", r"[-.]c(\d+)\."))
    part = task * F.lit(1 << 31) + nth
    return spark.read.schema("doc_id long, n_tokens int, tokens array<int>").parquet(path).withColumn("part", part)


def starts(tokens: DataFrame) -> DataFrame:
    """doc_id, place, part, start: ids before each document, from the metadata columns alone.

    A file is one sorted partition, so a running sum over the files' totals and
    one inside each file give the place in the whole.
    """
    meta = tokens.select("doc_id", "n_tokens", "part", F.col("_metadata.row_index").alias("place"))
    totals = meta.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    ahead = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("ahead"))
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, 0))
    return meta.withColumn("upto", inside).join(ahead, "part").select("part", "place", (F.col("ahead") + F.col("upto") - F.col("n_tokens")).alias("start"))


def _crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        col = b.column(3)
        off = np.frombuffer(col.buffers()[1], np.int32, len(col) + 1, col.offset * 4)
        flat = np.ascontiguousarray(col.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False))
        raw = memoryview(flat).cast("B")
        sums = [zlib.crc32(raw[4 * off[k] : 4 * off[k + 1]]) for k in range(len(col))]
        yield pa.record_batch([b.column(0), b.column(1), b.column(2), pa.array(sums, pa.int64()), pa.array(np.diff(off).astype(np.int64))], names=["part", "place", "doc_id", "ids_crc32", "n_tokens"])


def token_digests(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of the files that ``write_tokens`` makes, read back."""
    spark = docs.sparkSession
    path = new_path(spark, "tokens")
    write_tokens(docs, tokenizer_path, path, end_id)
    tokens = read_tokens(spark, path)
    sums = tokens.select("part", F.col("_metadata.row_index").alias("place"), "doc_id", "tokens").mapInArrow(_crc, "part long, place long, doc_id long, ids_crc32 long, n_tokens long")
    return sums.join(starts(tokens), ["part", "place"]).select("doc_id", "start", "n_tokens", "ids_crc32")
