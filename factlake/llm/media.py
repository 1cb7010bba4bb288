"""Media columns: content-addressed payloads in tar shards.

A text's UTF-8, padded with zero bytes to a positive multiple of 64, is a
greyscale image of 64 samples a row, stored losslessly as PNG. Tasks append the
images to tar shards in the shared folder; a member is named by the SHA-256 of
its payload, and rows carry that digest with shard, offset and length. A
payload is stored once per shard at most; of the copies in several shards the
catalogue keeps one address. The image header (a range read of the first 33
bytes) gives width and height; features come from the whole member.

A task names its shards uniquely. Its rows are written as a table and count only
when the whole task has succeeded, that is, when all its shards are closed; a
retried task leaves an unused file behind and nothing else. A task holds the
rows of one Arrow batch and the addresses of one shard.

Defined cases: null text is empty; equal texts have equal values; repeated rows
are rows of their own; an empty table gives no rows and no shards. Columns
beyond doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
import io
import struct
import tarfile
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .workspace import new_path, ship, stored

SAMPLES = 64
SHARD_BYTES = 64 << 20
HEADER_BYTES = 33
LEVEL = 6
_SIGNATURE = b"\x89PNG\r\n\x1a\n"


def padded(raw: bytes) -> bytes:
    return raw + bytes(max(SAMPLES, -(-len(raw) // SAMPLES) * SAMPLES) - len(raw))


def _part(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def to_png(payload: bytes) -> bytes:
    """8-bit greyscale, unfiltered rows."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, SAMPLES)
    lines = np.zeros((len(rows), SAMPLES + 1), np.uint8)
    lines[:, 1:] = rows
    head = struct.pack(">IIBBBBB", SAMPLES, len(rows), 8, 0, 0, 0, 0)
    return _SIGNATURE + _part(b"IHDR", head) + _part(b"IDAT", zlib.compress(lines.tobytes(), LEVEL)) + _part(b"IEND", b"")


def png_size(header: bytes) -> tuple[int, int]:
    """Width and height from the first bytes."""
    if header[:8] != _SIGNATURE or header[12:16] != b"IHDR":
        raise ValueError("not a PNG header")
    return struct.unpack(">II", header[16:24])


def from_png(media: bytes) -> bytes:
    width, height = png_size(media)
    at, data = 8, b""
    while at < len(media):
        (n,) = struct.unpack(">I", media[at : at + 4])
        kind, body = media[at + 4 : at + 8], media[at + 8 : at + 8 + n]
        if zlib.crc32(kind + body) != struct.unpack(">I", media[at + 8 + n : at + 12 + n])[0]:
            raise ValueError("damaged PNG part")
        if kind == b"IDAT":
            data += body
        at += 12 + n
    lines = np.frombuffer(zlib.decompress(data), np.uint8).reshape(height, width + 1)
    if lines[:, 0].any():
        raise ValueError("filtered rows aren't written here")
    return lines[:, 1:].tobytes()


def features(payload: bytes) -> str:
    """Counts over the samples, as text: rows, mean, deviation, edges (neighbours over 32 apart), samples by 32 levels."""
    x = np.frombuffer(payload, np.uint8).astype(np.int32)
    edges = int((np.abs(np.diff(x)) > 32).sum())
    levels = np.bincount(x >> 5, minlength=8)
    return f"rows={len(x) // SAMPLES};mean={x.mean():.3f};dev={x.std():.3f};edges={edges};levels={','.join(map(str, levels))}"


class _Shard:
    def __init__(self, store: fs.FileSystem, folder: str, uri: str):
        name = f"{uuid.uuid4().hex}.tar"
        self.uri, self.out, self.size = f"{uri}/{name}", store.open_output_stream(f"{folder}/{name}"), 0
        self.at: dict[str, tuple[int, int]] = {}

    def add(self, digest: str, media: bytes) -> None:
        info = tarfile.TarInfo(f"{digest}.png")
        info.size = len(media)
        head = info.tobuf(tarfile.USTAR_FORMAT)
        self.out.write(head + media + bytes(-len(media) % 512))
        self.at[digest] = (self.size + len(head), len(media))
        self.size += len(head) + len(media) + -len(media) % 512

    def close(self) -> None:
        self.out.write(bytes(1024))
        self.out.close()


def _writer(uri: str):
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_sha256", pa.string()), ("shard", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = fs.FileSystem.from_uri(uri)
        store.create_dir(folder, recursive=True)
        shard = None
        for batch in batches:
            rows = []
            for i, scalar in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = scalar.as_buffer().to_pybytes() if scalar.is_valid else b""
                payload = padded(raw)
                digest = hashlib.sha256(payload).hexdigest()
                if shard and shard.size >= SHARD_BYTES:
                    shard.close()
                    shard = None
                shard = shard or _Shard(store, folder, uri)
                if digest not in shard.at:
                    shard.add(digest, to_png(payload))
                offset, length = shard.at[digest]
                rows.append((i, len(raw), digest, shard.uri, offset, length))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True) if rows else [()] * 6, schema.types, strict=True)], schema=schema)
        if shard:
            shard.close()

    return run


def store_payloads(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """doc_id, n_bytes, payload_sha256, shard, offset, length: one row per row of ``docs``; the shards are written."""
    spark = docs.sparkSession
    ship(spark)
    folder = folder or new_path(spark, "media")
    if "://" not in folder and folder.startswith("file:"):
        folder = "file://" + folder[5:]
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, n_bytes long, payload_sha256 string, shard string, offset long, length long"
    return stored(rows.mapInArrow(_writer(folder), schema), "media-rows")


def catalogue(stored_rows: DataFrame) -> DataFrame:
    """payload_sha256, shard, offset, length: one address per payload."""
    at = F.min(F.struct("shard", "offset", "length")).alias("at")
    return stored_rows.groupBy("payload_sha256").agg(at).select("payload_sha256", "at.shard", "at.offset", "at.length")


def _by_shard(addresses: DataFrame) -> DataFrame:
    return addresses.repartition("shard").sortWithinPartitions("shard", "offset").select("payload_sha256", "shard", "offset", "length")


def _members(batches: Iterator[pa.RecordBatch], most: int | None) -> Iterator[tuple[pa.RecordBatch, Iterator[bytes]]]:
    """Each batch with the bytes of its members, or their first ``most`` bytes."""
    open_uri, file = None, None
    for batch in batches:

        def read(batch=batch) -> Iterator[bytes]:
            nonlocal open_uri, file
            for uri, offset, length in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)), strict=True):
                if uri != open_uri:
                    if file:
                        file.close()
                    store, path = fs.FileSystem.from_uri(uri)
                    open_uri, file = uri, store.open_input_file(path)
                yield file.read_at(length if most is None else min(most, length), offset)

        yield batch, read()
    if file:
        file.close()


def _headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, members in _members(batches, HEADER_BYTES):
        sizes = [png_size(x) for x in members]
        yield pa.record_batch({"payload_sha256": batch.column(0), "width": pa.array([w for w, _ in sizes], pa.int32()), "height": pa.array([h for _, h in sizes], pa.int32())})


def media_headers(addresses: DataFrame) -> DataFrame:
    """payload_sha256, width, height from range reads of the image headers alone."""
    return _by_shard(addresses).mapInArrow(_headers, "payload_sha256 string, width int, height int")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["payload_sha256", "read_sha256", "payload_bytes", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    for batch, members in _members(batches, None):
        out: list[tuple] = []
        for digest, media in zip(batch.column(0).to_pylist(), members, strict=True):
            payload = from_png(media)
            out.append((digest, hashlib.sha256(payload).hexdigest(), len(payload), zlib.crc32(payload[-SAMPLES:]), len(media), hashlib.sha256(media).hexdigest(), features(payload)))
        kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        yield pa.record_batch([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], names=names)


def media_digests(addresses: DataFrame) -> DataFrame:
    """Per payload, from the stored bytes: read_sha256, payload_bytes, tail_crc32, media_bytes, media_sha256, feature."""
    schema = "payload_sha256 string, read_sha256 string, payload_bytes long, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return _by_shard(addresses).mapInArrow(_digests, schema)


def media_table(docs: DataFrame) -> DataFrame:
    """Store all payloads, read them back, and give each row of ``docs`` its media columns."""
    rows = store_payloads(docs)
    addresses = stored(catalogue(rows), "media-catalogue")
    read = media_digests(addresses).join(media_headers(addresses), "payload_sha256")
    return rows.select("doc_id", "n_bytes", "payload_sha256").join(read, "payload_sha256").select(
        "doc_id", "n_bytes", "payload_bytes", F.col("read_sha256").alias("payload_sha256"), "tail_crc32", "media_bytes", "media_sha256", "feature", "width", "height"
    )


def tar_names(data: bytes) -> list[str]:
    """Members of a shard (any tar reader reads it)."""
    with tarfile.open(fileobj=io.BytesIO(data)) as t:
        return t.getnames()
