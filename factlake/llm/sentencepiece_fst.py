"""SentencePiece encoding and decoding as shortest paths of a compiled transducer.

``compile_model`` reads a model file and builds the parts of a cascade:

* the normaliser: rules of the model's character map (the longest rule at a
  place rewrites it, any other character is copied), then the flags for extra
  white space, dummy prefix and escaped blanks. It is deterministic and has one
  output, so its composition with a text is again one string;
* the piece transducer: arcs that read a piece's characters and write its id,
  found by walking a trie of all pieces along the string;
* byte fallback: an arc that reads one character without a piece and writes the
  ids of its UTF-8 bytes (or the unknown id).

``Transducer.shortest`` composes a string with the piece transducer: composed
states are (position, state), and the path of least weight is found by relaxing
arcs in the tropical semiring (weights add along a path, the least total wins),
the lightest state first and of equally light ones the farthest.

For a unigram model there is one state, and the weight of a piece is minus its
score. For a BPE model weights of single pieces can't say which segmentation
merging gives, so a state is the last piece read, and from x there is an arc for
piece y (weight 0) if merging the string xy ends with exactly [x, y]; all other
arcs have infinite weight, that is, they don't exist. Both pieces being results
of merging themselves, a sequence is the BPE result of its string if and only if
all neighbours agree in this sense. The same holds for every prefix, so at each
position one composed state can be reached, and the path is the library's.

White space begins chunks that no piece crosses (checked when compiling), so a
text's path is the sequence of its chunks' paths, and each distinct chunk is
solved once (see ``chunks``).

Defined cases: null text is empty and has no ids; ids decode to the text with
the literal character U+2581 as a blank; equal texts have equal ids; repeated
rows are coded each; an empty table gives no rows. Columns beyond doc_id and
text are ignored.
"""

from __future__ import annotations

import hashlib
import pickle
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from heapq import heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .chunks import ChunkEncoder
from .workspace import ship

BLANK = "▁"
#: Values of the model file: model types, and the types of its pieces.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = range(1, 7)
UNKNOWN_PENALTY = 10.0
#: Pairs of pieces whose agreement a worker remembers.
MOST_PAIRS = 400_000
#: Chunks it remembers.
MOST_CHUNKS = 500_000
_LETTER_SIGN = re.compile(r"[A-Za-z][!-/:-@\[-`{-~]")


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protocol buffer message."""

    def varint(i: int) -> tuple[int, int]:
        out = shift = 0
        while True:
            b = raw[i]
            out |= (b & 127) << shift
            i, shift = i + 1, shift + 7
            if b < 128:
                return out, i

    i = 0
    while i < len(raw):
        tag, i = varint(i)
        kind = tag & 7
        if kind == 0:
            value, i = varint(i)
        elif kind == 2:
            n, i = varint(i)
            value, i = raw[i : i + n], i + n
        else:
            n = 8 if kind == 1 else 4
            value, i = raw[i : i + n], i + n
        yield tag >> 3, value


def charsmap_rules(blob: bytes) -> dict[str, str]:
    """Rules of a compiled character map: a double-array trie of UTF-8 keys, then the replacements.

    A unit of the array holds its label, whether its node ends a key, and the
    offset of its children: child c of node p with offset o is at p ^ o ^ c.
    """
    if not blob:
        return {}
    (size,) = struct.unpack_from("<I", blob)
    units, texts = np.frombuffer(blob, np.uint32, size // 4, 4).astype(np.int64), blob[4 + size :]

    def base(at: np.ndarray) -> np.ndarray:
        u = units[at]
        return at ^ ((u >> 10) << ((u & 512) >> 6))

    rules: dict[str, str] = {}
    nodes, keys = np.zeros(1, np.int64), [b""]
    labels = np.arange(1, 256)
    while len(nodes):
        to = base(nodes)[:, None] ^ labels[None, :]
        inside = to < len(units)
        hit = inside & ((units[np.where(inside, to, 0)] & 0x800000FF) == labels[None, :])
        row, col = np.nonzero(hit)
        nodes = to[row, col]
        keys = [keys[r] + bytes([labels[c]]) for r, c in zip(row.tolist(), col.tolist(), strict=True)]
        for k in np.flatnonzero((units[nodes] >> 8) & 1).tolist():
            at = int(units[base(nodes[k : k + 1])[0]] & 0x7FFFFFFF)
            rules[keys[k].decode()] = texts[at : texts.index(0, at)].decode()
    return rules


@dataclass
class Transducer:
    bpe: bool
    add_prefix: bool
    squeeze: bool
    escape: bool
    ids: dict[str, int]
    #: Per piece: cost (unigram), or rank in merge order (BPE; single characters are -1).
    cost: dict[str, float]
    #: BPE: the two pieces that a piece's last merge joins.
    split: dict[str, tuple[str, str]]
    byte_ids: list[int]
    unknown_id: int
    surface: list[bytes]
    split_at_blank: bool
    #: No piece has an ASCII letter right before an ASCII sign.
    split_at_sign: bool = False
    unknown_cost: float = 0.0
    #: The normaliser's rules.
    rules: dict[str, str] = field(default_factory=dict)
    agree_memo: dict[tuple[str, str], bool] = field(default_factory=dict)
    #: Trie of the pieces: (node, character) as one number -> node; and each node's piece.
    trie: dict[int, int] = field(default_factory=dict)
    at_node: list[str | None] = field(default_factory=list)

    @property
    def fingerprint(self) -> str:
        return hashlib.sha256(repr((self.bpe, self.add_prefix, self.squeeze, self.escape, list(self.ids.items()), list(self.cost.items()), self.byte_ids, list(self.rules.items()))).encode()).hexdigest()

    def agree(self, x: str, y: str) -> bool:
        """Whether merging the string xy ends with [x, y].

        It doesn't if some pair of pieces that meet at the border while x and y
        are merged would have merged first. The later merge of the two sides is
        undone step by step; a border pair that is a piece of its own must rank
        behind the merge that came next on either side.
        """
        known = self.agree_memo.get((x, y))
        if known is not None:
            return known
        rank, split = self.cost, self.split
        a, b, limit, out = x, y, float("inf"), True
        while True:
            joined = rank.get(a + b)
            if joined is not None and joined < limit:
                out = False
                break
            # On equal ranks the left one merges first, so the right one is undone first.
            if rank[a] > rank[b]:
                limit = rank[a]
                a = split[a][1] if a in split else ""
                if not a:
                    break
            else:
                if b not in split:
                    if a not in split:
                        break
                    limit, a = rank[a], split[a][1]
                    continue
                limit = rank[b] + 0.5
                b = split[b][0]
        if len(self.agree_memo) >= MOST_PAIRS:
            self.agree_memo.clear()
        self.agree_memo[x, y] = out
        return out

    def _grow_trie(self) -> None:
        self.at_node = [None]
        for piece in self.cost:
            node = 0
            for c in piece:
                key = node << 21 | ord(c)
                node = self.trie.setdefault(key, len(self.at_node))
                if node == len(self.at_node):
                    self.at_node.append(None)
            self.at_node[node] = piece

    def readable(self, text: str, at: int) -> list[str]:
        """Pieces that ``text`` goes on with, shortest first."""
        if not self.at_node:
            self._grow_trie()
        step, at_node, node, out = self.trie.get, self.at_node, 0, []
        for k in range(at, len(text)):
            node = step(node << 21 | ord(text[k]))
            if node is None:
                break
            if at_node[node] is not None:
                out.append(at_node[node])
        return out

    def arcs(self, state: str, pieces: list[str], char: str) -> list[tuple[str, str, float]]:
        """Arcs of a state where the string goes on with ``pieces`` (or only ``char``): characters read, next state, weight."""
        if not self.bpe:
            out = [(p, "", self.cost[p]) for p in pieces]
        elif not state:
            out = [(p, p, 0.0) for p in pieces]
        else:
            memo, out = self.agree_memo, []
            for p in pieces:
                agreed = memo.get((state, p))
                if agreed or (agreed is None and self.agree(state, p)):
                    out.append((p, p, 0.0))
        if not pieces or len(pieces[0]) > 1:
            out.append((char, "", self.unknown_cost))
        return out

    def shortest(self, text: str) -> list[str]:
        """The characters read by each arc of the path of least weight.

        Composed states are taken in order of weight, of equal ones the farthest
        first, so a state is left with its least weight and the first one at the
        end closes the search. Of equal paths to a state the one whose last arc
        begins first stays.
        """
        end = len(text)
        reached: dict[tuple[int, str], tuple] = {(0, ""): (0.0, 0, "", "")}
        frontier, left = [(0.0, 0, "")], set()
        while frontier:
            weight, minus, state = heappop(frontier)
            at = -minus
            if at == end:
                break
            if (at, state) in left:
                continue
            left.add((at, state))
            for read, to, cost in self.arcs(state, self.readable(text, at), text[at]):
                key, total = (at + len(read), to), weight + cost
                old = reached.get(key)
                if old is None or total < old[0] or (total == old[0] and at < old[1]):
                    reached[key] = (total, at, state, read)
                    heappush(frontier, (total, -key[0], to))
        out: list[str] = []
        while at:
            _, at, state, read = reached[at, state]
            out.append(read)
        return out[::-1]

    def path(self, chunk: str) -> list[int]:
        """Ids on the shortest path of a chunk's characters; without byte pieces a run of unknown ones is one id."""
        ids: list[int] = []
        unknown = False
        for piece in self.shortest(chunk):
            k = self.ids.get(piece)
            if k is not None:
                ids.append(k)
            elif self.byte_ids:
                ids += [self.byte_ids[b] for b in piece.encode("utf-8", "surrogatepass")]
            elif not unknown:
                ids.append(self.unknown_id)
            unknown = k is None
        return ids


def _merge(text: str, rank: dict[str, float]) -> tuple[list[str], tuple[str, str] | None]:
    """Merge the best-ranked pair, the leftmost first, until none is left; and the last pair merged."""
    parts, last = list(text), None
    while len(parts) > 1:
        found = [(rank[a + b], i) for i, (a, b) in enumerate(zip(parts[:-1], parts[1:], strict=True)) if a + b in rank]
        if not found:
            break
        _, i = min(found)
        last = (parts[i], parts[i + 1])
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts, last


def compile_model(path: str) -> Transducer:
    kind, spec, pieces = UNIGRAM, {}, []
    with open(path, "rb") as f:
        for number, value in _fields(f.read()):
            if number == 1:
                piece = dict(_fields(value))
                pieces.append((piece[1].decode(), struct.unpack("<f", piece.get(2, bytes(4)))[0], piece.get(3, NORMAL)))
            elif number == 2:
                kind = dict(_fields(value)).get(3, UNIGRAM)
            elif number == 3:
                spec = dict(_fields(value))
    if kind not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models are compiled")
    if any(t == USER_DEFINED for _, _, t in pieces):
        raise ValueError("pieces that a user defined aren't compiled")
    plain = [k for k, (_, _, t) in enumerate(pieces) if t == NORMAL]
    byte_ids = [k for k, (_, _, t) in enumerate(pieces) if t == BYTE]
    unknown_id = next(k for k, (_, _, t) in enumerate(pieces) if t == UNKNOWN)
    score = {pieces[k][0]: pieces[k][1] for k in plain}
    bpe = kind == BPE
    split: dict[str, tuple[str, str]] = {}
    if bpe:
        order = sorted((p for p in score if len(p) > 1), key=lambda p: -score[p])
        rank = {p: float(k) for k, p in enumerate(order)}
        cost = {p: -1.0 for p in score if len(p) == 1}
        for p in order:
            parts, last = _merge(p, rank)
            if len(parts) == 1 and last:
                split[p] = last
                cost[p] = rank[p]
    else:
        cost = {p: -s for p, s in score.items()}
    surface = [b""] * len(pieces)
    for k in plain:
        surface[k] = pieces[k][0].replace(BLANK, " ").encode()
    for b, k in enumerate(byte_ids):
        surface[k] = bytes([b])
    surface[unknown_id] = " ⁇ ".encode()
    return Transducer(
        bpe=bpe, add_prefix=bool(spec.get(3, 1)), squeeze=bool(spec.get(4, 1)), escape=bool(spec.get(5, 1)),
        ids={pieces[k][0]: k for k in plain}, cost=cost, split=split, byte_ids=byte_ids, unknown_id=unknown_id, surface=surface,
        split_at_sign=not any(_LETTER_SIGN.search(p) for p in score), split_at_blank=bool(spec.get(5, 1)) and not any(BLANK in p.lstrip(BLANK) for p in score),
        unknown_cost=max(cost.values()) + UNKNOWN_PENALTY, rules=charsmap_rules(spec.get(2, b"")),
    )


def _live(key: str, load: Callable[[], Transducer]) -> tuple[Transducer, ChunkEncoder]:
    """The one transducer that this process keeps, with its encoder; ``load`` makes it where it isn't kept."""

    def make() -> tuple[Transducer, ChunkEncoder]:
        t = load()

        def encode(chunks: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
            texts = (c.decode("utf-8", "replace") for c in chunks)
            ids = [t.path(x.replace(" ", BLANK) if t.escape else x) for x in texts]
            counts = np.fromiter(map(len, ids), np.int64, len(ids))
            return chunks, np.fromiter(chain.from_iterable(ids), np.int32, int(counts.sum())), counts

        return t, ChunkEncoder(encode, MOST_CHUNKS)

    return tv.kept(key, make)


def rewritten(text: str, rules: dict[str, str], longest: int, begins: re.Pattern) -> str:
    """The output of the normaliser's rules; ``begins``: characters that some rule begins with."""
    out, at = [], 0
    while found := begins.search(text, at):
        k = found.start()
        out.append(text[at:k])
        for n in range(min(longest, len(text) - k), 0, -1):
            to = rules.get(text[k : k + n])
            if to is not None:
                out.append(to)
                at = k + n
                break
        else:
            out.append(text[k])
            at = k + 1
    return "".join([*out, text[at:]])


def _normalised(col: pa.Array, t: Transducer) -> pa.Array:
    raw = col = col.fill_null("")
    if t.rules:
        begins = re.compile("[" + "".join(sorted({re.escape(k[0]) for k in t.rules})) + "]")
        longest = max(map(len, t.rules))
        col = pa.array([rewritten(x, t.rules, longest, begins) for x in col.to_pylist()], pa.string())
    if t.squeeze:
        col = pc.utf8_trim(pc.replace_substring_regex(col, " +", " "), " ")
    if t.add_prefix:
        some = pc.greater(pc.binary_length(col if t.squeeze else raw), 0)
        col = pc.binary_join_element_wise(pc.if_else(some, " ", ""), col, "")
    return col


def encode_rows(col: pa.Array, t: Transducer, key: str | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a string column's rows and the rows' offsets into them."""
    data, offsets = tv.utf8(_normalised(col, t))
    cut = np.zeros(len(data), bool)
    if t.split_at_blank and len(data) > 3:
        # A blank begins a chunk unless a blank (or the character that stands for one) is before it.
        cut[1:] = (data[1:] == 32) & (data[:-1] != 32)
        cut[3:] &= ~((data[2:-1] == 0x81) & (data[1:-2] == 0x96) & (data[:-3] == 0xE2))
    if t.split_at_sign and len(data):
        cut[1:] |= tv.LETTER[data[:-1]] & tv.SIGN[data[1:]]
    cut[offsets[:-1][np.diff(offsets) > 0]] = True
    return _live(key or t.fingerprint, lambda: t)[1].rows(data, np.flatnonzero(cut), offsets)


def decode_rows(ids: np.ndarray, offsets: np.ndarray, t: Transducer) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 of the rows and the rows' offsets into it."""
    pool = np.frombuffer(b"".join(t.surface), np.uint8)
    size = np.array([len(x) for x in t.surface], np.int32)
    begin = (np.cumsum(size) - size).astype(np.int32)
    count = size[ids]
    to = np.concatenate([[0], np.cumsum(count)])
    data = pool[np.repeat((begin[ids] - to[:-1]).astype(np.int32), count) + np.arange(to[-1], dtype=np.int32)]
    at = to[offsets]
    if not t.add_prefix or not len(data):
        return data, at
    first = at[:-1][np.diff(at) > 0]
    first = first[data[first] == 32]
    keep = np.ones(len(data), bool)
    keep[first] = False
    return data[keep], at - np.searchsorted(first, at)


def _coded(t: Transducer, key: str, with_tokens: bool):
    packed = pickle.dumps(t)  # unpacked once per worker and not once per task

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in tv.held(batches, "text", keep=key):
            t, _ = _live(key, lambda: pickle.loads(packed))
            ids, offsets = encode_rows(s.column(1), t, key)
            data, at = decode_rows(ids, offsets, t)
            original, start = tv.utf8(s.column(1))
            raw, plain, texts = memoryview(np.ascontiguousarray(ids.astype("<u4"))).cast("B") if len(ids) else b"", data.tobytes(), original.tobytes()
            rows = range(s.num_rows)
            out = [
                s.column(0),
                pa.array(np.diff(offsets).astype(np.int64)),
                pa.array([zlib.crc32(raw[4 * offsets[k] : 4 * offsets[k + 1]]) for k in rows], pa.int64()),
                pa.array([hashlib.sha256(plain[at[k] : at[k + 1]]).hexdigest() for k in rows], pa.string()),
                pa.array([plain[at[k] : at[k + 1]] == texts[start[k] : start[k + 1]] for k in rows], pa.bool_()),
            ]
            names = ["doc_id", "n_tokens", "ids_crc32", "decoded_sha256", "exact"]
            if with_tokens:
                out.append(pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids)))
                names.append("tokens")
            yield pa.record_batch(out, names=names)

    return run


def coded(docs: DataFrame, model_path: str, with_tokens: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_crc32, decoded_sha256, exact (and tokens): one row per row of ``docs``.

    Texts are encoded, and the ids decoded again; ``exact`` says that the decoded text is the text.
    """
    ship(docs.sparkSession)
    t = compile_model(model_path)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, n_tokens long, ids_crc32 long, decoded_sha256 string, exact boolean" + ", tokens array<int>" * with_tokens
    return rows.mapInArrow(_coded(t, t.fingerprint, with_tokens), schema)
