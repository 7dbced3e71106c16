"""Exact deduplication through a minimal perfect hash over historical distinct digests.

The history's distinct digests are dealt into buckets by digest prefix. Each bucket carries its
own minimal perfect hash: a cascade of bit arrays in which a key owns the first bit that no other
key of that level hits, numbered by rank (Limasset et al., 2017). A slot holds the full 32-byte
digest, the locator of the winner (its smallest doc_id) and the number of historical rows. A
lookup computes a slot and compares all 32 bytes, so a digest that is not in the history is never
taken for a member; such digests are grouped among themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import as_table, mix64

#: Historical digests that one bucket of the index holds on average.
KEYS_PER_BUCKET = 20_000
#: Bits that a level of the cascade has for each key still without a slot.
GAMMA = 2
INDEX_SCHEMA = "bucket long, levels array<long>, bits binary, digests binary, winners array<long>, sizes array<long>"
RESOLVED_SCHEMA = "digest binary, keep_id long, group_size long"


def normalised(text):
    """Each run of ASCII white space becomes one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def with_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    key = [F.col(row_col).alias("row_key")] if row_col else []
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.unhex(F.sha2(normalised(F.col(text_col)), 256)).alias("digest"), *key)


def _words(digests: np.ndarray) -> np.ndarray:
    """(n, 32) bytes -> (n, 4) uint64."""
    return np.ascontiguousarray(digests).view("<u8").reshape(-1, 4)


def _places(words: np.ndarray, level: int, size: int) -> np.ndarray:
    """Where the keys fall in a level; another mixture of all digest bytes at each level."""
    x = words[:, level % 4] + np.uint64(level * 0x9E3779B97F4A7C15 % 2**64)
    x = mix64(x ^ mix64(words[:, (level + 1) % 4] + np.uint64(level // 4)))
    return (x % np.uint64(size)).astype(np.int64)


def build_hash(words: np.ndarray) -> tuple[list[int], np.ndarray]:
    """The sizes of the levels and their bits, one level after the other."""
    left, sizes, bits = words, [], []
    while len(left):
        size = max(64, GAMMA * len(left))
        at = _places(left, len(sizes), size)
        hits = np.bincount(at, minlength=size)
        bits.append(hits == 1)
        sizes.append(size)
        left = left[hits[at] != 1]
    return sizes, np.concatenate(bits) if bits else np.zeros(0, bool)


def slots_of(words: np.ndarray, sizes: list[int], bits: np.ndarray) -> np.ndarray:
    """Slot of each key: a bijection on the keys of build_hash, anything or -1 for others."""
    ranks = np.cumsum(bits) - 1
    out = np.full(len(words), -1, np.int64)
    left, start = np.arange(len(words)), 0
    for level, size in enumerate(sizes):
        at = start + _places(words[left], level, size)
        hit = bits[at]
        out[left[hit]] = ranks[at[hit]]
        left, start = left[~hit], start + size
    return out


def _digest_array(column) -> np.ndarray:
    return np.frombuffer(b"".join(bytes(x) for x in column), np.uint8).reshape(-1, 32)


def _build_bucket(rows: pd.DataFrame) -> pd.DataFrame:
    digests = _digest_array(rows["digest"])
    sizes, bits = build_hash(_words(digests))
    order = np.argsort(slots_of(_words(digests), sizes, bits))
    return pd.DataFrame(
        {
            "bucket": [rows["bucket"].iloc[0]],
            "levels": [sizes],
            "bits": [np.packbits(bits).tobytes()],
            "digests": [digests[order].tobytes()],
            "winners": [rows["winner"].to_numpy()[order]],
            "sizes": [rows["n"].to_numpy()[order]],
        }
    )


def _resolve(index: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
    """One row for each digest of the bucket, historical or new, with its winner and size."""
    new = _digest_array(rows["digest"])
    keep, n = rows["winner"].to_numpy(np.int64).copy(), rows["n"].to_numpy(np.int64).copy()
    if not len(index):
        return pd.DataFrame({"digest": list(map(bytes, new)), "keep_id": keep, "group_size": n})
    row = index.iloc[0]
    levels = [int(x) for x in row["levels"]]
    bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8))[: sum(levels)].astype(bool)
    held = np.frombuffer(row["digests"], np.uint8).reshape(-1, 32)
    winners, sizes = np.array(row["winners"], np.int64), np.array(row["sizes"], np.int64)
    slot = slots_of(_words(new), levels, bits)
    member = slot >= 0
    member[member] = (held[slot[member]] == new[member]).all(axis=1)
    at = slot[member]
    winners[at] = np.minimum(winners[at], keep[member])
    sizes[at] += n[member]
    digests = np.concatenate([held, new[~member]])
    return pd.DataFrame({"digest": list(map(bytes, digests)), "keep_id": np.concatenate([winners, keep[~member]]), "group_size": np.concatenate([sizes, n[~member]])})


#: Stands for "no doc_id" inside the index: larger than any winner.
_NONE = 2**63 - 1


def _distinct(digests: DataFrame, buckets: int) -> DataFrame:
    """One row a digest; partial aggregation leaves one row for each task of a hot digest."""
    found = digests.groupBy("digest").agg(F.coalesce(F.min("doc_id"), F.lit(_NONE)).alias("winner"), F.count("*").alias("n"))
    return found.withColumn("bucket", F.pmod(F.conv(F.substring(F.hex("digest"), 1, 14), 16, 10).cast("long"), F.lit(buckets)))


def build_index(history: DataFrame, buckets: int) -> DataFrame:
    """Index table over the distinct digests of the history (doc_id, digest), a row a bucket."""
    return as_table(_distinct(history, buckets).groupBy("bucket").applyInPandas(_build_bucket, INDEX_SCHEMA), "digest-index")


def resolve(index: DataFrame, incoming: DataFrame, buckets: int) -> DataFrame:
    """(digest, keep_id, group_size) for every digest of the index or the incoming rows."""
    new = _distinct(incoming, buckets)
    found = index.groupBy("bucket").cogroup(new.groupBy("bucket")).applyInPandas(_resolve, RESOLVED_SCHEMA)
    return found.withColumn("keep_id", F.when(F.col("keep_id") != _NONE, F.col("keep_id")))


def exact_dedup(digests: DataFrame, is_history, keys_per_bucket: int = KEYS_PER_BUCKET) -> DataFrame:
    """One row for each row of digests (doc_id, digest): doc_id, keep_id, group_size, kept, digest.

    is_history: boolean column; its rows feed the index, the others are looked up in it. The
    winner is the smallest doc_id on either side, so the result does not depend on the split.
    Rows without a doc_id never win over rows with one; where no row of a text has a doc_id,
    keep_id is null and all of them are kept, since none can be told from another. Rows that
    repeat the winning doc_id are all kept. An empty table gives an empty result. Of other
    columns of the input, row_key alone is read and passed on."""
    history = digests.filter(F.coalesce(is_history, F.lit(False)))
    incoming = digests.filter(~F.coalesce(is_history, F.lit(False)))
    buckets = max(1, -(-digests.select("digest").count() // keys_per_bucket))
    winners = as_table(resolve(build_index(history, buckets), incoming, buckets), "digest-winners")
    return digests.join(winners, "digest").select("doc_id", "keep_id", "group_size", F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"), "digest", *(c for c in digests.columns if c == "row_key"))


def dedup_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """Digest every whole text once and deduplicate; even halves by hashed id act as the
    history that is indexed and as the rows that arrive afterwards. With row_col, a column that
    tells rows apart, the result has that column too, as row_key."""
    digests = as_table(with_digest(docs, id_col, text_col, row_col), "digests")
    return exact_dedup(digests, F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(2)) == 0)
