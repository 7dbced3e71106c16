"""Near-duplicate detection on five-word shingles by min-max hashing.

Under each permutation a document keeps the smallest and the largest shingle, so half as many
hash evaluations give a signature of the same length (Ji et al., 2013). A band is two
permutations, that is four signature values. Documents that share a band are candidates; a link
is confirmed on the full shingle sets.

Documents of one shingle set are collapsed before anything is compared. A set with too many
shingles of its own can be linked to no other, whatever its buckets say, and goes. Inside a
bucket the comparison is a star around the member with the fewest shingles of its own, not all
pairs. Members that the stars leave in different components are compared block by block inside
tasks, by products of 0/1 matrices, where the number of shingles that they share with anyone
allows a link: those outside a bucket's largest component with one another and with it, never
that component with itself. Pairs are no rows of a table there, and no candidate is skipped.

Texts are not shuffled: a bitmap of bounded size tells which rows may be candidates when the
texts are read again, and what the shuffle carries are the shingle sets of those.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geokernel.operators.graph import linked_roots

from .shared import WordHashes, ascii_words, as_table, mix64, pieces

SHINGLE_WORDS = 5
#: Linked where DEN * intersection >= NUM * union.
NUM, DEN = 75, 100
BANDS = 32
#: Two permutations a band, each with its minimum and its maximum.
PERMUTATIONS = 2 * BANDS
#: A block of a bucket has about so many members and shingles at most; a pair of blocks is
#: compared at a time.
BLOCK, BLOCK_SHINGLES = 512, 400_000
#: Shingles that one call compares, on average.
SHINGLES_PER_GROUP = 2_000_000
#: Rows of a bucket that go to one task where buckets meet what is known of them.
BAND_ROWS = 2048
#: Bits of the candidate bitmap for each candidate, and bound on its size (16 MB of bits).
BITS_PER_ROW, BITMAP_BITS = 16, 1 << 27

_rng = np.random.default_rng(20240117)
_WORD_FACTORS = _rng.integers(0, 2**63, SHINGLE_WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PERM_A = _rng.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PERM_B = _rng.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64)
_BAND_FACTORS = _rng.integers(0, 2**63, 4, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str | None, hashes: WordHashes) -> np.ndarray:
    """The sorted distinct 64-bit shingles of a text; one for the whole of a shorter text."""
    words = ascii_words(text)
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    width = min(n, SHINGLE_WORDS)
    x = np.full(n - width + 1, width, np.uint64)
    for i in range(width):
        x += h[i : n - width + 1 + i] * _WORD_FACTORS[i]
    return np.unique(mix64(x))


def min_max(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest value under each permutation."""
    low, high = np.full(PERMUTATIONS, 2**64 - 1, np.uint64), np.zeros(PERMUTATIONS, np.uint64)
    for at in range(0, len(values), 2048):
        y = values[at : at + 2048][None, :] * _PERM_A[:, None] + _PERM_B[:, None]
        np.minimum(low, y.min(axis=1), out=low)
        np.maximum(high, y.max(axis=1), out=high)
    return low, high


def band_keys(values: np.ndarray) -> np.ndarray:
    low, high = min_max(values)
    parts = np.stack([low[0::2], high[0::2], low[1::2], high[1::2]])
    x = (mix64(parts) * _BAND_FACTORS[:, None]).sum(axis=0) + np.arange(BANDS, dtype=np.uint64)
    return mix64(x).view(np.int64)


def _node(values: np.ndarray) -> bytes | None:
    """Names a shingle set; null for the empty one."""
    return xxhash.xxh3_128_digest(values.tobytes()) if len(values) else None


def _signatures(kept: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            nodes, sizes, bands = [], [], []
            for text in batch["text"].to_pylist():
                values = shingles(text, hashes)
                sizes.append(len(values))
                nodes.append(_node(values))
                bands.append(band_keys(values) if len(values) else None)
            found = [pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()), pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), *found], [*kept, "n_shingles", "node", "bands"])

    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        found = [shingles(text, hashes).view(np.int64) for text in batch["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["text_key"], pa.array(found, pa.list_(pa.int64()))], ["doc_id", "text_key", "shingles"])


def _maybe_in(rows: DataFrame, chosen: DataFrame, *key: str) -> DataFrame:
    """The rows whose key may be among the chosen ones, by a bitmap over hashed keys.

    All chosen rows pass, and a few others. The bitmap is a table of 64-bit words whose size is
    bounded, so it is broadcast at any size of the input and the rows stay where they are."""
    bits = min(BITMAP_BITS, max(64, 1 << (BITS_PER_ROW * chosen.count()).bit_length()))
    place = F.pmod(F.xxhash64(*key, F.lit(5)), F.lit(bits))
    word, bit = F.shiftright(place, 6), F.expr("shiftleft(1L, CAST(place % 64 AS INT))")
    words = chosen.select(place.alias("place")).groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(bit).alias("set"))
    words = as_table(words, "candidate-bits")
    seen = rows.withColumn("place", place).withColumn("word", word).join(F.broadcast(words), "word")
    return seen.filter(F.col("set").bitwiseAND(bit) != 0).drop("place", "word", "set")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The candidate pairs (a, b) whose full sets are similar enough."""
    joined = (
        pairs.join(sets.select(F.col("num").alias("a"), F.col("shingles").alias("sa")), "a")
        .join(sets.select(F.col("num").alias("b"), F.col("shingles").alias("sb")), "b")
        .withColumn("both", F.size(F.array_intersect("sa", "sb")))
    )
    return joined.filter(DEN * F.col("both") >= NUM * (F.size("sa") + F.size("sb") - F.col("both"))).select("a", "b")


def _may_link(n, shared, other_n, other_shared):
    """Whether two sets can be linked, given how many of their shingles any other set holds:
    DEN * both >= NUM * union is (DEN + NUM) * both >= NUM * (n + other_n)."""
    return (DEN + NUM) * F.least(shared, other_shared) >= NUM * (n + other_n)


def _private(sets: DataFrame) -> DataFrame:
    """(num, private): for each set how many of its shingles no other set holds."""
    held = sets.select("num", F.explode("shingles").alias("shingle")).groupBy("shingle").agg(F.count("*").alias("holders"), F.min("num").alias("num"))
    return held.filter("holders = 1").groupBy("num").agg(F.count("*").alias("private"))


def _salt(num: str, members: Column) -> Column:
    """Deals the rows of a bucket out to as many tasks as it needs."""
    return F.pmod(F.xxhash64(num), F.ceil(members / BAND_ROWS).cast("long"))


def _told(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """rows (band, salt, ...) with the facts of their band (band, members, ...); a band with many
    members is in as many tasks as it has salts."""
    salts = F.sequence(F.lit(0).cast("long"), F.ceil(F.col("members") / BAND_ROWS).cast("long") - 1)
    return rows.join(facts.withColumn("salt", F.explode(salts)).drop("members"), ["band", "salt"])


def _star_pairs(buckets: DataFrame) -> DataFrame:
    """Each member of a bucket with its hub: the one of the fewest private shingles, and among
    those the one whose buckets are fullest."""
    degree = buckets.groupBy("num").agg(F.sum("members").alias("degree"))
    ranked = as_table(buckets.join(degree, "num"), "ranked-buckets")
    hubs = ranked.groupBy("band").agg(F.max("members").alias("members"), F.max(F.struct((F.col("shared") / F.col("n")).alias("share"), "degree", "num", "n", "shared")).alias("hub"))
    pairs = _told(ranked, hubs).filter((F.col("num") != F.col("hub.num")) & _may_link(F.col("n"), F.col("shared"), F.col("hub.n"), F.col("hub.shared")))
    return pairs.select(F.least("num", "hub.num").alias("a"), F.greatest("num", "hub.num").alias("b")).distinct()


def _open_units(buckets: DataFrame, roots: DataFrame) -> DataFrame:
    """Work units (band, lo, hi) with their members, for buckets that still hold members of
    several components.

    The members of the bucket's largest component are one side, all others the other side; each
    side is cut into blocks. A unit is two blocks of the other side, or one of either side."""
    left = buckets.join(roots.withColumnRenamed("node", "num"), "num", "left").withColumn("root", F.coalesce("root", "num"))
    left = as_table(left, "open-members")
    least = left.groupBy("band").agg(F.max("members").alias("members"), F.min("n").alias("least"), F.min("root").alias("low"), F.max("root").alias("high")).filter("low != high")
    left = _told(left, least.drop("low", "high")).filter(_may_link(F.col("n"), F.col("shared"), F.col("least"), F.col("shared"))).drop("least")
    left = as_table(left, "open-members")
    held = left.groupBy("band", "root").agg(F.max("members").alias("members"), F.count("*").alias("rows"), F.sum("n").alias("load"))
    blocks = lambda rows, load: F.greatest(F.ceil(rows / BLOCK), F.ceil(load / BLOCK_SHINGLES)).cast("long")
    sides = held.groupBy("band").agg(
        F.max("members").alias("members"), F.max(F.struct("rows", "root", "load")).alias("main"),
        F.sum("rows").alias("rows"), F.sum("load").alias("load"), F.count("*").alias("roots"),
    ).filter("roots > 1")
    sides = sides.select("band", "members", F.col("main.root").alias("main"), blocks(F.col("main.rows"), F.col("main.load")).alias("mains"), blocks(F.col("rows") - F.col("main.rows"), F.col("load") - F.col("main.load")).alias("others"))
    left = _told(left, sides)
    # Blocks of the other side are numbered from 0, those of the main side from there on.
    is_main, h = F.col("root") == F.col("main"), F.xxhash64("num", F.lit(3))
    left = left.withColumn("block", F.when(is_main, F.col("others") + F.pmod(h, F.col("mains"))).otherwise(F.pmod(h, F.col("others"))))
    meets = F.when(is_main, F.col("others")).otherwise(F.col("others") + F.col("mains"))
    left = left.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), meets - 1)))
    return left.select("band", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "num", "root", "n")


def _intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections within a block, from 0/1 rows over the shingles two sets share."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    names, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    both = count[place] > 1
    column = (np.cumsum(count > 1) - 1)[place[both]]
    owner = owner[both]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    out = np.zeros((len(sets), len(sets)), np.float32)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        a, b = np.searchsorted(column, (at, at + 4096))
        part = np.zeros((len(sets), 4096), np.float32)
        part[owner[a:b], column[a:b] - at] = 1
        out += part @ part.T
    return out


def _linked_units(rows: pa.Table) -> pa.Table:
    """(a, b): a forest over the members of each unit that links to others of its unit hold
    together; every pair of different components was compared."""
    rows = rows.sort_by([(c, "ascending") for c in ("band", "lo", "hi", "num")])
    keys = np.array([rows[c].to_numpy() for c in ("band", "lo", "hi")])
    cuts = np.flatnonzero((np.diff(keys, axis=1) != 0).any(axis=0)) + 1
    a, b = [], []
    for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), rows.num_rows], strict=True):
        part = rows.slice(start, end - start)
        num, root, n = (part[c].to_numpy() for c in ("num", "root", "n"))
        if len(num) < 2 or (root == root[0]).all():
            continue
        both = _intersections([x.values.to_numpy() for x in part["shingles"]])
        linked = (DEN * both >= NUM * (n[:, None] + n[None, :] - both)) & (root[:, None] != root[None, :])
        low = pieces(len(num), *np.nonzero(linked))
        some = low != np.arange(len(num))
        a.append(num[some])
        b.append(num[low[some]])
    return pa.Table.from_arrays([pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64()) for x in (a, b)], ["a", "b"])


def _cross_links(buckets: DataFrame, roots: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between members of a bucket that lie in different components, as many as join what
    belongs together; compared inside the work units, on full sets."""
    units = as_table(_open_units(buckets, roots), "open-units")
    load = units.agg(F.sum("n")).first()[0] or 0
    groups = max(1, -(-load // SHINGLES_PER_GROUP))
    work = units.withColumn("g", F.pmod(F.xxhash64("band", "lo", "hi"), F.lit(groups))).join(sets, "num")
    return as_table(work.groupBy("g").applyInArrow(_linked_units, "a long, b long"), "links")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """One row for each row of docs: doc_id, n_shingles, component_id, kept.

    Null, empty or blank texts have no shingles and are linked with nothing. A row without a
    doc_id is linked like any other but names no component; it is kept only where no row of its
    component has a doc_id. Rows that repeat the component's doc_id are all kept. An empty
    table gives an empty result; other columns are not read. With row_col, a column that tells
    rows apart, the result also has that column as row_key, and group, which rows of one
    component share and rows without shingles lack."""
    key = [F.col(row_col).alias("row_key")] if row_col else []
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_key"), *key)
    extra = [f"row_key {docs.schema['row_key'].dataType.simpleString()}"] if row_col else []
    schema = ", ".join(["doc_id long, text_key long", *extra, "n_shingles long, node binary, bands array<long>"])
    signed = as_table(docs.mapInArrow(_signatures(["doc_id", "text_key", *(["row_key"] if row_col else [])]), schema), "signatures")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key", "n_shingles", "bands")).alias("first")
    classes = signed.filter("node IS NOT NULL").groupBy("node").agg(first).select("node", "first.doc_id", "first.text_key", F.col("first.n_shingles").alias("n"), "first.bands")
    # Numbers are drawn once, as the table is written.
    classes = as_table(classes.withColumn("num", F.monotonically_increasing_id()), "classes")

    rows = classes.select("num", "n", F.explode("bands").alias("band"))
    full = rows.groupBy("band").agg(F.count("*").alias("members")).filter("members > 1")
    buckets = as_table(rows.join(full, "band").withColumn("salt", _salt("num", F.col("members"))), "buckets")

    # Only texts that share a bucket are read again, for their full sets.
    chosen = as_table(buckets.select("num").distinct().join(classes.drop("bands"), "num"), "candidates")
    texts = _maybe_in(docs.select("doc_id", "text_key", "text"), chosen, "doc_id", "text_key")
    named = chosen.select(F.col("doc_id").alias("id"), F.col("text_key").alias("key"), "num")
    sets = texts.mapInArrow(_sets, "doc_id long, text_key long, shingles array<long>")
    sets = sets.join(named, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("key"))).select("num", "shingles")
    sets = as_table(sets.dropDuplicates(["num"]), "sets", "lz4")

    shared = chosen.select("num", "n").join(_private(sets), "num", "left").select("num", (F.col("n") - F.coalesce("private", F.lit(0))).alias("shared"))
    buckets = as_table(buckets.join(shared, "num").filter(DEN * F.col("shared") >= NUM * F.col("n")), "open-buckets")
    stars = as_table(_star_pairs(buckets), "star-pairs")
    links = as_table(_confirmed(stars, sets), "links")
    roots = as_table(linked_roots(links), "roots")
    # Every pair of candidates now lies in one component or is compared here.
    links = links.union(_cross_links(buckets, roots, sets))
    roots = as_table(linked_roots(links), "roots")

    named = classes.select("node", "num", "doc_id").join(roots.withColumnRenamed("node", "num"), "num", "left").withColumn("root", F.coalesce("root", "num"))
    # Written first, so that a large component is a skewed side that adaptive execution can split.
    named = as_table(named.select("node", "root", "doc_id"), "named")
    component = as_table(named.groupBy("root").agg(F.min("doc_id").alias("component_id")), "components")
    named = named.join(component, "root").select("node", "root", "component_id")
    placed = signed.drop("bands", "text_key").join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    more = ["row_key", F.col("root").alias("group")] if row_col else []
    return placed.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"), *more)
