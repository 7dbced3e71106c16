"""Byte-level BPE encoding and decoding over segment trees.

A piece is a row of byte positions. A segment tree over the positions holds, at each node, the
smallest (rank, position) of a live pair below it, so its root is the leftmost pair of the lowest
rank. A merge joins two live neighbours and updates three leaves: the pair that begins at the
merged token, the one that ends there, and the position that died. Short pieces of one width
are merged in lockstep, a tree in each row of an array; long ones one at a time, so a piece of n
bytes takes n log n steps whatever it holds.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pieces, and chunks, that a generation of a Python worker's memory holds.
CHUNKS_HELD = 250_000
#: Pieces up to this many bytes are merged in lockstep.
LOCKSTEP = 64
#: Characters of text that are worked on at a time.
SLICE_CHARS = 1_000_000
_BITS = 20
_NONE = 1 << 60
#: Long pieces: plain integers, so positions may be as large as any text asks for.
_LONG_BITS = 40
_LONG_NONE = 1 << 80
#: White space of the Unicode property; no piece goes on past a change from other characters
#: to white space, so texts can be cut there.
_SPACE = "\t-\r \x85\xa0  -     　"
_CHUNKS = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")


@lru_cache(1)
def _stand_ins() -> tuple[frozenset[str], dict[int, str]]:
    """Characters that the regex module and tiktoken class differently, since they know
    different versions of Unicode, and for each a character of the class that tiktoken gives it:
    a letter, a digit, or neither."""
    import tiktoken

    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    table: dict[int, str] = {}
    for kind, stand_in in ((r"\p{L}", "z"), (r"\p{N}", "1")):
        finder = tiktoken.Encoding("classes", pat_str=kind, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
        ours, theirs = set(regex.findall(kind, every)), set(finder.decode(finder.encode_ordinary(every)))
        for c in ours - theirs:
            table.setdefault(ord(c), "\uffff")
        table.update((ord(c), stand_in) for c in theirs - ours)
    return frozenset(map(chr, table)), table


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Merges:
    """Which two tokens make which third one; the new token's id is its rank."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.byte_ids = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        self.pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    self.pairs[left << _BITS | right] = rank
        self.keys = np.array(sorted(self.pairs), np.int64)
        self.values = np.array([self.pairs[k] for k in self.keys.tolist()], np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, _NONE where it makes no token or a side is missing (-1)."""
        key = np.where((left >= 0) & (right >= 0), left << _BITS | right, -1)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], _NONE)


def encode_long(piece: bytes, merges: Merges) -> list[int]:
    """The ids of one piece over one segment tree."""
    n = len(piece)
    leaves = 1 << max(0, (n - 1).bit_length())
    token = [int(merges.byte_ids[b]) for b in piece]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    pairs = merges.pairs

    def leaf(i: int) -> int:
        j = after[i]
        rank = pairs.get(token[i] << _BITS | token[j]) if j < n else None
        return _LONG_NONE if rank is None else rank << _LONG_BITS | i

    tree = [_LONG_NONE] * (2 * leaves)
    tree[leaves : leaves + n] = map(leaf, range(n))
    for node in range(leaves - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])

    def put(i: int, value: int) -> None:
        node = leaves + i
        tree[node] = value
        while node > 1:
            node //= 2
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

    while tree[1] < _LONG_NONE:
        rank, i = tree[1] >> _LONG_BITS, tree[1] & ((1 << _LONG_BITS) - 1)
        gone = after[i]
        token[i], token[gone], after[i] = rank, -1, after[gone]
        if after[i] < n:
            before[after[i]] = i
        put(gone, _LONG_NONE)
        put(i, leaf(i))
        if before[i] >= 0:
            put(before[i], leaf(before[i]))
    return [t for t in token if t >= 0]


def encode_lockstep(pieces: list[bytes], width: int, merges: Merges) -> list[np.ndarray]:
    """The ids of pieces of at most width bytes (a power of two): a tree in each row."""
    ids, ends = _lockstep(pieces, width, merges)
    return np.split(ids, ends[:-1])


def _lockstep(pieces: list[bytes], width: int, merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all pieces one after the other, and where each piece's end."""
    m = len(pieces)
    data = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(m, width)
    size = np.array([len(p) for p in pieces])
    token = np.full((m, width + 1), -1, np.int64)  # the last column stands for no neighbour
    token[:, :width] = np.where(np.arange(width) < size[:, None], merges.byte_ids[data], -1)
    after = np.tile(np.minimum(np.arange(1, width + 2), width), (m, 1))
    before = np.tile(np.concatenate([[width], np.arange(width)]), (m, 1))
    tree = np.full((m, 2 * width), _NONE, np.int64)

    def combined(rank: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.where(rank < _NONE, rank << _BITS | at, _NONE)

    tree[:, width:] = combined(merges.rank(token[:, :-1], token[:, 1:]), np.arange(width))
    for node in range(width - 1, 0, -1):
        tree[:, node] = np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1])
    rows = np.flatnonzero(tree[:, 1] < _NONE)
    while len(rows):
        best = tree[rows, 1]
        rank, at = best >> _BITS, best & ((1 << _BITS) - 1)
        gone = after[rows, at]
        follow, prior = after[rows, gone], before[rows, at]
        token[rows, at], token[rows, gone] = rank, -1
        after[rows, at], before[rows, follow] = follow, at
        old = token[rows, prior]
        for place, value in (
            (gone, np.full(len(rows), _NONE)),
            (at, combined(merges.rank(rank, token[rows, follow]), at)),
            (np.where(prior < width, prior, gone), np.where(prior < width, combined(merges.rank(old, rank), prior), _NONE)),
        ):
            node = width + place
            tree[rows, node] = value
            while node[0] > 1:
                node = node >> 1
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
        rows = rows[tree[rows, 1] < _NONE]
    live = token[:, :-1] >= 0
    return token[:, :-1][live], np.cumsum(live.sum(axis=1))


class Held:
    """What is known of strings, in two generations: when the young one is full it becomes the
    old one, and what is asked for again moves on. Holds twice `bound` entries at most, plus
    those of one slice of text."""

    def __init__(self, bound: int):
        self.bound, self.young, self.old = bound, {}, {}

    def missing(self, wanted: set) -> set:
        """Makes room, moves what is known to the young generation and returns the rest."""
        if len(self.young) > self.bound:
            self.young, self.old = {}, self.young
        wanted.difference_update(self.young)
        again = wanted.intersection(self.old)
        self.young.update((x, self.old[x]) for x in again)
        return wanted.difference(again)


class Encoder:
    """Encodes and decodes texts; remembers pieces and chunks up to a bound."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, held: int = CHUNKS_HELD):
        self.merges, self.pattern = Merges(ranks), regex.compile(pattern)
        self.unlike, self.stand_ins = _stand_ins()
        self.decimal = [str(i).encode() for i in range(len(self.merges.tokens))]
        #: Ids as decimal numbers joined by commas, and packed, of pieces and of chunks.
        self.pieces, self.chunks = Held(held), Held(held)

    def encode_pieces(self, pieces: set[bytes]) -> dict[bytes, list[int]]:
        """Ids of distinct pieces; a piece that is a token is that token."""
        found, groups = {}, {}
        for piece in pieces:
            rank = self.merges.ranks.get(piece)
            if rank is not None:
                found[piece] = [rank]
            elif len(piece) > LOCKSTEP:
                found[piece] = encode_long(piece, self.merges)
            else:
                groups.setdefault(1 << (len(piece) - 1).bit_length(), []).append(piece)
        for width, some in groups.items():
            ids, ends = (x.tolist() for x in _lockstep(some, width, self.merges))
            found.update((p, ids[a:b]) for p, a, b in zip(some, [0, *ends], ends, strict=False))
        return found

    def cut(self, chunk: str) -> list[str]:
        """The matches of the pattern, by the classes that tiktoken knows."""
        if chunk.isascii() or self.unlike.isdisjoint(chunk):
            return self.pattern.findall(chunk)
        ends = [m.end() for m in self.pattern.finditer(chunk.translate(self.stand_ins))]
        return [chunk[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def _learn(self, chunks: set[str]) -> None:
        cut = {c: [p.encode("utf-8", "surrogatepass") for p in self.cut(c)] for c in chunks}
        pieces, decimal = self.pieces, self.decimal
        new = self.encode_pieces(pieces.missing(set(chain.from_iterable(cut.values()))))
        pieces.young.update((p, (b",".join([decimal[i] for i in ids]), struct.pack(f"<{len(ids)}I", *ids))) for p, ids in new.items())
        known, of = self.chunks.young, pieces.young
        for chunk, some in cut.items():
            known[chunk] = of[some[0]] if len(some) == 1 else (b",".join([of[p][0] for p in some]), b"".join([of[p][1] for p in some]))

    def encode_all(self, texts: list[str | None]) -> Iterator[tuple[bytes, bytes]]:
        """For each text its ids as decimal numbers joined by commas, and as packed integers."""
        start = 0
        while start < len(texts):
            end, chars = start, 0
            while end < len(texts) and chars < SLICE_CHARS:
                chars += len(texts[end] or "")
                end += 1
            split = [_CHUNKS.findall(t) if t else [] for t in texts[start:end]]
            if new := self.chunks.missing(set(chain.from_iterable(split))):
                self._learn(new)
            known = self.chunks.young.__getitem__
            for chunks in split:
                parts = list(map(known, chunks))
                yield b",".join([p[0] for p in parts]), b"".join([p[1] for p in parts])
            start = end

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(next(self.encode_all([text]))[1], "<u4").tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.merges.tokens.__getitem__, ids))


@lru_cache(1)
def _encoder(ranks: bytes, pattern: str) -> Encoder:
    """One for all tasks of a Python worker, so what it remembers serves the next task too."""
    return Encoder({base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}, pattern)


def _encoded(docs: DataFrame, rank_path: str, pattern: str, row_of, schema: str) -> DataFrame:
    with open(rank_path, "rb") as f:
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks.value, pattern)
        for batch in batches:
            rows = [row_of(encoder, i, *found) for i, found in zip(batch["doc_id"].to_pylist(), encoder.encode_all(batch["text"].to_pylist()), strict=True)]
            yield pa.RecordBatch.from_pylist(rows, run_schema)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    run_schema = to_arrow_schema(StructType.fromDDL(schema))
    return docs.mapInArrow(run, schema)


def encode_documents(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) of every whole text. Null and empty texts have no ids; repeated rows are
    encoded each; an empty table gives an empty result; other columns are not read."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return _encoded(docs, rank_path, pattern, lambda e, i, text, ids: {"doc_id": i, "ids": np.frombuffer(ids, "<u4").tolist()}, "doc_id long, ids array<int>")


def encode_digests(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256: the texts encoded as by
    encode_documents, and their ids decoded again."""

    def row(encoder: Encoder, doc_id: int, text: bytes, ids: bytes) -> dict:
        decoded = encoder.decode(np.frombuffer(ids, "<u4").tolist())
        return {"doc_id": doc_id, "n_tokens": len(ids) // 4, "ids_sha256": hashlib.sha256(text).hexdigest(), "decoded_sha256": hashlib.sha256(decoded).hexdigest()}

    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return _encoded(docs, rank_path, pattern, row, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
