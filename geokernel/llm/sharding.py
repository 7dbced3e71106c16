"""Sharding by vector bin packing: bytes, tokens and rows balanced jointly.

Groups of equal texts are the things to place. A group's demand and a shard's capacity have three
dimensions, each in units of an equal share of the whole; a group goes where the dot product of its
demand with the residual capacity is highest, larger groups first.

Groups that need more than a small part of a shard are few (their number is bounded by the number
of shards) and are placed first, together. All others are dealt into random chunks, each of which
fills its own part of what the large groups have left, independently of the other chunks. A group
that is larger than a shard in any dimension is cut into pieces by hashed rows; every other group
stays whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import as_table, with_row_key

SHARDS = 40
ROW_BYTES = 16
#: A large group needs more than this part of a shard: at most 3 * shards * LARGE_PART of them.
LARGE_PART = 256
#: Pieces that a group larger than a shard is cut into, for each shard that it would fill.
PIECES_PER_SHARD = 16
#: Small groups of one chunk, and rows of a numbered part of a shard, on average.
GROUPS_PER_CHUNK, ROWS_PER_PART = 16_384, 20_000
DIMENSIONS = ("bytes", "tokens", "rows")
#: How much a dimension counts in the dot product: equal bytes are what readers of shards wait for.
WEIGHTS = (3.0, 1.0, 1.0)


def place(demands: np.ndarray, residual: np.ndarray, weights: tuple[float, ...] = WEIGHTS, first: int = 0) -> np.ndarray:
    """The shard of each demand (n, dimensions), larger ones placed first; ties of demands go by
    their order, ties of shards to the next one after `first`. residual (shards, dimensions) is
    what the shards have left; it may end below zero."""
    turned = np.roll(residual, -first, axis=0) * weights
    needs, out = demands * weights, np.empty(len(demands), np.int64)
    for i in np.argsort(-demands.max(axis=1, initial=0), kind="stable"):
        out[i] = best = (turned @ needs[i]).argmax()
        turned[best] -= needs[i]
    return (out + first) % max(1, len(residual))


def measured(docs: DataFrame, id_col: str, text_col: str, tokens_col: str | None, row_col: str | None = None) -> DataFrame:
    """doc_id, bytes, tokens, text_crc32, digest and a number of each row. Null texts are empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    tokens = F.coalesce(F.col(tokens_col).cast("long"), F.lit(0)) if tokens_col else F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    key = [F.col(row_col).alias("row_key")] if row_col else []
    return docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + ROW_BYTES).cast("long").alias("bytes"), tokens.alias("tokens"), F.crc32(text).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("digest"), F.monotonically_increasing_id().alias("row"), *key)


def _summed(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum("bytes").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows"))


def _shares(rows: list, equal: np.ndarray) -> np.ndarray:
    return np.array([[r[d] for d in DIMENSIONS] for r in rows], float).reshape(-1, len(DIMENSIONS)) / equal


def place_groups(rows: DataFrame, shards: int = SHARDS, weights: tuple[float, ...] = WEIGHTS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """cuts (digest, pieces), large (digest, piece, shard) and small (digest, shard): the first two
    bounded by the number of shards, the last with a row for each other group."""
    spark = rows.sparkSession
    groups = as_table(_summed(rows, "digest"), "shard-groups")
    total = groups.agg(*(F.sum(d).alias(d) for d in DIMENSIONS)).first()
    equal = np.array([max(total[d] or 0, 1) / shards for d in DIMENSIONS])
    share = F.greatest(*(F.col(d) / float(e) for d, e in zip(DIMENSIONS, equal, strict=True)))
    is_large = share > 1 / LARGE_PART
    found = groups.filter(is_large).collect()
    needs = _shares(found, equal)
    pieces = {bytes(r["digest"]): min(r["rows"], PIECES_PER_SHARD * int(np.ceil(need))) for r, need in zip(found, needs.max(axis=1, initial=0), strict=True) if need > 1 and r["rows"] > 1}
    cuts = spark.createDataFrame([(bytearray(k), n) for k, n in pieces.items()], "digest binary, pieces int")
    cut = _summed(rows.join(F.broadcast(cuts), "digest").withColumn("piece", _piece()), "digest", "piece").collect() if pieces else []
    items = sorted([(bytes(r["digest"]), 0, r) for r in found if bytes(r["digest"]) not in pieces] + [(bytes(r["digest"]), r["piece"], r) for r in cut], key=lambda x: x[:2])
    needs = _shares([r for *_, r in items], equal)
    at = place(needs, np.ones((shards, len(DIMENSIONS))), weights)
    left = np.ones((shards, len(DIMENSIONS)))
    np.subtract.at(left, at, needs)
    large = spark.createDataFrame([(bytearray(digest), piece, int(s)) for (digest, piece, _), s in zip(items, at, strict=True)], "digest binary, piece int, shard int")

    rest = groups.filter(~is_large)
    whole = rest.agg(*(F.sum(d).alias(d) for d in DIMENSIONS), F.count("*").alias("groups")).first()
    chunks = max(1, -(-whole["groups"] // GROUPS_PER_CHUNK))
    of_whole = np.array([max(whole[d] or 0, 1) for d in DIMENSIONS], float)

    def fill(key: tuple, part: pa.Table) -> pa.Table:
        part = part.sort_by("digest")
        amounts = np.stack([part[d].to_numpy() for d in DIMENSIONS], axis=1).astype(float)
        shard = place(amounts / equal, left * (amounts.sum(axis=0) / of_whole), weights, key[0].as_py() % shards)
        return pa.Table.from_arrays([part["digest"], pa.array(shard, pa.int32())], ["digest", "shard"])

    chunk = F.pmod(F.xxhash64("digest"), F.lit(chunks)).alias("chunk")
    small = rest.select("digest", *DIMENSIONS, chunk).groupBy("chunk").applyInArrow(fill, "digest binary, shard int")
    return cuts, large, small


def _piece():
    """The piece of a row of a group that is cut."""
    return F.coalesce(F.pmod(F.xxhash64("row"), F.col("pieces")), F.lit(0)).cast("int")


def shard_documents(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", tokens_col: str | None = None, weights: tuple[float, ...] = WEIGHTS, row_col: str | None = None) -> DataFrame:
    """A row for each row of docs: doc_id, size, tokens, text_crc32, shard, slot.

    size: UTF-8 bytes of the text and ROW_BYTES for the row; tokens: tokens_col or else words;
    slot: gapless from 0 in each shard. Rows of equal texts share a shard, unless together they
    exceed an equal share of bytes, tokens or rows. Null texts are empty ones, with which they form a
    group; rows that repeat a doc_id or have none are rows of their own; an empty table gives an
    empty result; other columns are not read. With row_col, a column that tells rows apart, the
    result has that column too, as row_key."""
    rows = as_table(measured(docs, id_col, text_col, tokens_col, row_col), "shard-rows")
    cuts, large, small = place_groups(rows, shards, weights)
    dealt = rows.join(F.broadcast(cuts), "digest", "left").withColumn("piece", _piece()).join(F.broadcast(large), ["digest", "piece"], "left")
    columns = ["doc_id", "bytes", "tokens", "text_crc32", "row", "shard", *(c for c in rows.columns if c == "row_key")]
    dealt = dealt.filter("shard IS NOT NULL").select(*columns).union(dealt.filter("shard IS NULL").drop("shard").join(small, "digest").select(*columns))
    parts = max(1, -(-rows.count() // (shards * ROWS_PER_PART)))
    dealt = as_table(dealt.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts))), "shard-placed")
    counts = dealt.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = counts.select("shard", "part", (F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")).alias("before"))
    numbered = dealt.withColumn("slot", F.row_number().over(Window.partitionBy("shard", "part").orderBy("row")) - 1)
    numbered = numbered.join(before, ["shard", "part"])
    return numbered.select("doc_id", F.col("bytes").alias("size"), "tokens", "text_crc32", "shard", (F.col("slot") + F.col("before")).alias("slot"), *(c for c in rows.columns if c == "row_key"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", tokens_col: str | None = None) -> None:
    """Write docs, all columns, as a folder shard=<n> for each shard, in the order of slots. A shard
    is written by as many tasks as its rows need."""
    keyed, name = with_row_key(docs)
    placed = as_table(shard_documents(keyed, shards, id_col, text_col, tokens_col, row_col=name).select(F.col("row_key").alias(name), "shard", "slot"), "shard-slots")
    clash = {"shard", "slot"} & set(docs.columns)
    if clash:
        raise ValueError(f"rename the columns {sorted(clash)}: shards are written under these names")
    out = keyed.join(placed, name).drop(name)
    out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
