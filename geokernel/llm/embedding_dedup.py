"""Near-duplicate vectors by cross-polytope hashing with multiprobe buckets.

A hash is the nearest signed axis after a pseudo-random rotation: three rounds of random signs
and a fast Hadamard transform (Andoni et al., 2015). Several hashes make a bucket of a table.
Each vector is put into the bucket of its nearest axes and, hash by hash, of the second nearest.
Vectors that share a bucket are compared by cosine in double precision.

Equal vectors of a label are one class throughout. A large bucket is cut into blocks and each
pair of blocks is a unit of work, so no task holds a whole bucket and no bucket is cut short.
Links never leave their unit of work as pairs: a unit counts the links that it owns (the first
bucket that two vectors share) for each vector and names one vector of each connected piece.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geokernel.operators.graph import linked_roots

from .shared import as_table, mix64, pieces

THRESHOLD = 0.98
TABLES = 10
#: Vectors of a bucket that are compared with each other at a time.
BLOCK = 512
#: Rows of whole buckets that one call works on, on average.
ROWS_PER_GROUP = 20_000
_BIG = np.int64(2**62)


def hashes_for(rows: int, dimensions: int = 64) -> int:
    """Hashes a bucket so that unrelated vectors seldom meet: about as many buckets as rows."""
    return max(2, math.ceil(math.log(max(rows, 2)) / math.log(2 * dimensions)))


def hadamard(x: np.ndarray) -> np.ndarray:
    """Orthonormal fast Hadamard transform of the rows; their width is a power of two."""
    n, d = x.shape
    step = 1
    while step < d:
        y = x.reshape(n, d // (2 * step), 2, step)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, d)
        step *= 2
    return x / math.sqrt(d)


def bucket_codes(vectors: np.ndarray, hashes: int, tables: int = TABLES, seed: int = 7) -> np.ndarray:
    """(n, tables * (hashes + 1)) bucket numbers: of each table the nearest and the probes."""
    n, d = vectors.shape
    width = 1 << max(0, (d - 1).bit_length())
    padded = np.zeros((n, width))
    padded[:, :d] = vectors
    rng, rows, out = np.random.default_rng(seed), np.arange(n), []
    for table in range(tables):
        best, other = [], []
        for _ in range(hashes):
            y = padded
            for _ in range(3):
                y = hadamard(y * rng.choice([-1.0, 1.0], width))
            size = np.abs(y)
            first = size.argmax(axis=1)
            best.append(2 * first + (y[rows, first] < 0))
            size[rows, first] = -1
            second = size.argmax(axis=1)
            other.append(2 * second + (y[rows, second] < 0))
        for probe in range(-1, hashes):
            code = np.full(n, table, np.uint64)
            for k in range(hashes):
                code = mix64(code * np.uint64(2 * width) + (other[k] if k == probe else best[k]).astype(np.uint64))
            # Below _BIG, however wide the vectors and however many the hashes.
            out.append((code >> np.uint64(2)).astype(np.int64))
    return np.stack(out, axis=1)


def _codes(count: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_size: dict[int, list[int]] = {}
            vectors = batch["vector"].to_pylist()
            for i, v in enumerate(vectors):
                by_size.setdefault(len(v), []).append(i)
            found: list = [None] * len(vectors)
            for rows in by_size.values():
                for i, codes in zip(rows, bucket_codes(np.array([vectors[i] for i in rows], float), hashes_for(count, len(vectors[rows[0]]))), strict=True):
                    found[i] = codes
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.int64()))], [*batch.schema.names, "codes"])

    return run


def _owners(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest code that both rows of codes hold, row by row."""
    out = np.empty(len(a), np.int64)
    for at in range(0, len(a), 10_000):
        x, y = a[at : at + 10_000], b[at : at + 10_000]
        shared = (x[:, :, None] == y[:, None, :]).any(axis=2)
        out[at : at + 10_000] = np.where(shared, x, _BIG).min(axis=1)
    return out


def _compare(threshold: float):
    def unit(code: int, ids: np.ndarray, copies: np.ndarray, vectors: np.ndarray, codes: np.ndarray, side: np.ndarray, within: bool) -> tuple:
        unit_vectors = vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]
        i, j = np.nonzero(unit_vectors @ unit_vectors.T >= threshold - 1e-9)
        keep = (i < j) & (ids[i] != ids[j]) & (True if within else side[i] != side[j])
        i, j = i[keep], j[keep]
        dot = (vectors[i] * vectors[j]).sum(axis=1)
        norms = np.sqrt((vectors[i] ** 2).sum(axis=1)) * np.sqrt((vectors[j] ** 2).sum(axis=1))
        linked = dot / norms >= threshold
        i, j = i[linked], j[linked]
        own = _owners(codes[i], codes[j]) == code
        links = np.zeros(len(ids), np.int64)
        np.add.at(links, i[own], copies[j[own]])
        np.add.at(links, j[own], copies[i[own]])
        low = pieces(len(ids), i, j)
        some = (links > 0) | (low != np.arange(len(ids)))
        return ids[some], links[some], ids[low[some]]

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([(c, "ascending") for c in ("label", "dims", "code", "lo", "hi", "id")])
        keys = np.array([rows[c].to_numpy() for c in ("label", "dims", "code", "lo", "hi")])
        cuts = np.flatnonzero((np.diff(keys, axis=1) != 0).any(axis=0)) + 1
        found = []
        for a, b in zip([0, *cuts], [*cuts, rows.num_rows], strict=True):
            if b - a < 2:
                continue
            part = rows.slice(a, b - a)
            column = lambda c: part[c].to_numpy()
            vectors = np.array(part["vector"].to_pylist(), float)
            found.append(unit(keys[2, a], column("id"), column("copies"), vectors, np.array(part["codes"].to_pylist()), column("block"), keys[3, a] == keys[4, a]))
        columns = [np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in range(3)]
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], ["id", "links", "near"])

    return run


def near_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD) -> DataFrame:
    """One row for each row of the table: vec_id, n_links, component_id, kept.

    Compared are rows of one non-null label and one number of dimensions. Vectors that are null,
    empty, zero or hold null or non-finite components, and rows without label or id, link with
    nothing and are kept; their component is their own id. Rows that repeat an id are vectors of
    their own. An empty table gives an empty result; other columns are not read."""
    components = F.col("v")
    sound = F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("v") > 0) & F.forall(components, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(components, lambda x: x != 0)
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"), F.col(label_col).cast("long").alias("label"))
    rows = rows.withColumn("sound", F.coalesce(sound, F.lit(False)))
    classes = rows.filter("sound").groupBy("label", F.col("v").alias("vector")).agg(F.min("id").alias("first_id"), F.count("*").alias("copies"))
    classes = classes.withColumn("dims", F.size("vector").cast("long")).withColumn("id", F.monotonically_increasing_id())
    classes = as_table(classes, "vector-classes")  # numbers are drawn once, as the table is written
    schema = f"label long, vector {classes.schema['vector'].dataType.simpleString()}, id long, copies long, dims long, codes array<long>"
    coded = as_table(classes.select("label", "vector", "id", "copies", "dims").mapInArrow(_codes(classes.count()), schema), "vector-codes")

    placed = coded.select("label", "dims", "id", F.explode(F.array_distinct("codes")).alias("code"))
    sizes = placed.groupBy("label", "dims", "code").agg(F.count("*").alias("members")).filter("members > 1")
    shared = placed.join(sizes, ["label", "dims", "code"])
    blocks = F.ceil(F.col("members") / BLOCK).cast("long")
    shared = shared.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    units = shared.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    units = units.select("label", "dims", "code", "id", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))
    units = as_table(units, "vector-units")
    groups = max(1, -(-units.count() // ROWS_PER_GROUP))
    work = units.join(coded.select("id", "label", "vector", "copies", "codes"), ["id", "label"])
    work = work.withColumn("g", F.pmod(F.xxhash64("label", "dims", "code", "lo", "hi"), F.lit(groups)))
    found = as_table(work.groupBy("g").applyInArrow(_compare(threshold), "id long, links long, near long"), "vector-links")

    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    roots = linked_roots(found.select(F.col("id").alias("a"), F.col("near").alias("b")))
    named = classes.select("label", "vector", "id", "first_id", "copies").join(links, "id", "left").join(roots.withColumnRenamed("node", "id"), "id", "left")
    named = named.withColumn("root", F.coalesce("root", "id"))
    named = named.join(named.groupBy("root").agg(F.min("first_id").alias("component_id")), "root")
    named = named.select(F.col("label").alias("l"), "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    out = rows.filter("sound").join(named, (F.col("label") == F.col("l")) & (F.col("v") == F.col("vector"))).select("id", "n_links", "component_id")
    out = out.union(rows.filter("NOT sound").select("id", F.lit(0).cast("long"), "id"))
    return out.select(F.col("id").alias("vec_id"), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))
