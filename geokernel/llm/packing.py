"""Packing documents into fixed-length training sequences: first-fit decreasing.

Each document is tokenized whole, ended by one id, and cut at multiples of the sequence length.
Full pieces are sequences of their own. The rest are packed first-fit decreasing, independently
in randomised groups of documents: a tournament tree over the bins keeps the larger remaining
capacity of each pair, so the leftmost bin that takes a piece is found by one walk down the tree.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import as_table
from .tokenized import shared_tokenizer

SEQUENCE_TOKENS = 4096
#: Pieces that a randomised group holds on average: a group is one task's work.
PIECES_PER_GROUP = 8192
#: Sequence ids of group g start at g times this; no group has as many sequences.
GROUP_STRIDE = 1 << 32
PIECE_COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
PIECE_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PACKED_SCHEMA = PIECE_SCHEMA + ", sequence_id long, offset long"


class BinTree:
    """Tournament tree of bin capacities: every node has the largest capacity below it."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, (bins - 1).bit_length())
        self.best = [capacity] * (2 * self.leaves)

    def put(self, need: int) -> tuple[int, int]:
        """Place need in the leftmost bin with room: the bin and its capacity before."""
        best, at = self.best, 1
        while at < self.leaves:
            at *= 2
            if best[at] < need:
                at += 1
        slot, before = at - self.leaves, best[at]
        best[at] = before - need
        while at > 1:
            at //= 2
            high = max(best[2 * at], best[2 * at + 1])
            if best[at] == high:
                break
            best[at] = high
        return slot, before


def first_fit_decreasing(lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each length, in the order given; ties keep that order."""
    tree, out = BinTree(max(1, len(lengths)), capacity), [(0, 0)] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        slot, before = tree.put(lengths[i])
        out[i] = (slot, capacity - before)
    return out


def pieces_of(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int) -> DataFrame:
    """The pieces of every whole document, cut at multiples of the capacity."""
    with open(tokenizer_path, encoding="utf-8") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    end = end_id.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = shared_tokenizer(model.value)
        for batch in batches:
            rows = []
            for doc_id, ids in zip(batch["doc_id"].to_pylist(), tokenizer.encode_all(batch["text"].to_pylist()), strict=True):
                ids = memoryview(ids + end)
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    length = min(capacity, total - start)
                    rows.append((doc_id, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), total))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (zip(*rows, strict=True) if rows else [[]] * 5)], PIECE_COLUMNS)

    return docs.mapInArrow(cut, PIECE_SCHEMA)


def pack(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", capacity: int = SEQUENCE_TOKENS, pieces_per_group: int = PIECES_PER_GROUP, seed: int = 17) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Full pieces are sequences of their own; the others fill sequences to within a piece of the
    smallest kind in each group, so padding is a matter of the last sequences of a group.
    A null or empty text is the end id alone. Rows that repeat a doc_id, or have none, are
    packed as documents of their own. An empty table gives an empty result; other columns of
    the input are not read."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # Numbers are drawn once, as the pieces are written; groups are dealt by them alone, so equal
    # documents, repeated ids and the pieces of one long text spread over all groups.
    pieces = as_table(pieces_of(docs, tokenizer_path, end_id, capacity).withColumn("piece", F.monotonically_increasing_id()), "pieces")
    part = pieces.filter(F.col("length") < capacity)
    groups = max(1, -(-part.count() // pieces_per_group))
    grouped = part.withColumn("g", F.pmod(F.xxhash64("piece", F.lit(seed)), F.lit(groups)))

    def pack_group(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("piece")
        placed = first_fit_decreasing(rows["length"].to_pylist(), capacity)
        base = key[0].as_py() * GROUP_STRIDE
        rows = rows.append_column("sequence_id", pa.array([base + slot for slot, _ in placed], pa.int64()))
        return rows.append_column("offset", pa.array([offset for _, offset in placed], pa.int64())).drop_columns(["g", "piece"])

    packed = grouped.groupBy("g").applyInArrow(pack_group, PACKED_SCHEMA)
    whole = pieces.filter(F.col("length") == capacity).select(*PIECE_COLUMNS, (F.col("piece") + groups * GROUP_STRIDE).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.union(whole)
