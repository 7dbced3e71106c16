"""Spelling variants: words one edit apart, found by k-d trees over letter counts.

One inserted, deleted or replaced letter changes a word's vector of letter counts by an L1 distance
of one (an insertion) or two (one count up, one down). So near words of one length lie in boxes at
most one up and one down from a word's vector, near words one letter longer in boxes at most one up.

Words of each length have a k-d tree whose upper part deals them out: its cuts are medians of a
bounded sample of words, but every word is placed, and every word visits all boxes that may hold
near words, so the result does not depend on the sample. A box and its visitors are a unit of work:
the task goes on with a k-d tree over the box's own words, compares vectors leaf by leaf, and
verifies the order of letters of what is left. No pairs leave a task: a unit tells, for each word,
how many near words it has found and the most frequent of them. Boxes that hold too many words (all
anagrams of each other, say) are cut into blocks, and visitors into parts, by hash.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geokernel.operators.tables import Rounds

from .shared import as_table

MIN_LENGTH, MIN_COUNT = 7, 2
#: A form occurs so many times as often as its variant.
FORM_FACTOR = 10
#: One of so many words of a document, chosen by checksum, loses a letter before it is counted.
DELETION_EVERY = 31
#: Words that one unit of work holds on average, at most so many visitors for each of them, words
#: of a leaf of a unit's own tree.
BOX_WORDS, VISITORS, LEAF_WORDS = 32_768, 16, 64
#: Words whose letter counts decide the cuts of the upper trees.
SAMPLE_WORDS = 50_000
#: Letters of the words of one unit, for very long words.
BOX_LETTERS = 64_000_000
#: Distinct words that a task counts before it passes them on.
HELD_WORDS = 300_000

#: Letters, A-Z lower-cased, in ISO 8859-1; everything else becomes a space.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def words_of(text: str) -> list[bytes]:
    """Maximal runs [A-Za-z\\u00C0-\\u00FF]+ with A-Z lower-cased, in ISO 8859-1."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split()


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, deletion_every: int | None = DELETION_EVERY) -> DataFrame:
    """(word, n) over all whole texts, for words of at least min_length letters and min_count
    occurrences.

    With deletion_every, an occurrence whose crc32 of "<doc_id>:<word>" that number divides loses
    the letter at crc32 % length first. Null texts have no words; a null doc_id is an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}

        def batch_of() -> pa.RecordBatch:
            found = pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in held], pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])
            held.clear()
            return found

        for batch in batches:
            for doc_id, text in zip(batch["id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                start = zlib.crc32(doc_id.encode() + b":")
                for word, n in Counter(words_of(text)).items():
                    if len(word) < min_length:
                        continue
                    if deletion_every:
                        h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
                        if h % deletion_every == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < min_length:
                                continue
                    held[word] = held.get(word, 0) + n
                if len(held) > HELD_WORDS:
                    yield batch_of()
        yield batch_of()

    texts = docs.filter(F.col(text_col).isNotNull()).select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def letters_of(words: list[bytes], length: int) -> np.ndarray:
    return np.frombuffer(b"".join(words), np.uint8).reshape(-1, length)


def letter_counts(letters: np.ndarray) -> np.ndarray:
    """(n, 90) counts of a-z and \\u00C0-\\u00FF."""
    n, length = letters.shape
    place = np.where(letters < 0xC0, letters - np.uint8(97), letters - np.uint8(0xC0 - 26)).astype(np.int64)
    return np.bincount((place + 90 * np.arange(n)[:, None]).ravel(), minlength=90 * n).reshape(n, 90).astype(np.int32)


class BoxTree:
    """A k-d tree over whole-number points: inner nodes cut one dimension (<= cut, > cut)."""

    def __init__(self, points: np.ndarray, leaf_size: float):
        #: Of each node: dimension (-1: a leaf), cut, left, right, and the bounds that the nodes
        #: above it set in that dimension; of leaves: their number.
        self.nodes: list[list[int]] = []
        self.members: list[np.ndarray] = []
        d = points.shape[1]
        stack = [(np.arange(len(points)), {}, {}, -1, 0)]
        while stack:
            rows, low, high, parent, side = stack.pop()
            me = len(self.nodes)
            if parent >= 0:
                self.nodes[parent][2 + side] = me
            dim, cut = self._cut(points[rows]) if len(rows) > leaf_size and d else (-1, 0)
            if dim < 0:
                self.nodes.append([-1, len(self.members), 0, 0, 0, 0])
                self.members.append(rows)
                continue
            self.nodes.append([dim, cut, 0, 0, low.get(dim, -(2**30)), high.get(dim, 2**30)])
            below = points[rows, dim] <= cut
            stack.append((rows[~below], low | {dim: cut + 1}, high, me, 1))
            stack.append((rows[below], low, high | {dim: cut}, me, 0))

    @staticmethod
    def _cut(points: np.ndarray) -> tuple[int, int]:
        """The dimension of the widest spread and its most even cut; -1 where points are equal."""
        dim = int(points.var(axis=0).argmax())
        values, n = np.unique(points[:, dim], return_counts=True)
        if len(values) < 2:
            return -1, 0
        return dim, int(values[np.abs(np.cumsum(n)[:-1] - len(points) / 2).argmin()])

    def reached(self, points: np.ndarray, up: int, down: int) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, rows of points whose vector lies at most `up` below and `down` above its box)."""
        columns = np.ascontiguousarray(points.T)
        stack = [(0, np.arange(len(points)), np.full(len(points), up), np.full(len(points), down))]
        while stack:
            at, rows, up_left, down_left = stack.pop()
            if not len(rows):
                continue
            dim, cut, left, right, low, high = self.nodes[at]
            if dim < 0:
                yield cut, rows
                continue
            x = columns[dim][rows]
            d = down_left - np.maximum(x - cut, 0) + np.maximum(x - high, 0)
            u = up_left - np.maximum(cut + 1 - x, 0) + np.maximum(low - x, 0)
            for child, keep in ((left, d >= 0), (right, u >= 0)):
                stack.append((child, rows[keep], up_left[keep] if child == left else u[keep], d[keep] if child == left else down_left[keep]))

    def homes(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), np.int64)
        for leaf, rows in self.reached(points, 0, 0):
            out[rows] = leaf
        return out


def box_trees(sample: list[str], sizes: dict[int, int]) -> dict[int, BoxTree]:
    """A tree for each length with words; sizes: words by length."""
    by_length: dict[int, list[bytes]] = {}
    for word in sample:
        by_length.setdefault(len(word), []).append(word.encode("latin-1"))
    trees = {}
    for length, count in sizes.items():
        words = by_length.get(length, [])
        boxes = max(1.0, count / BOX_WORDS, count * length / BOX_LETTERS)
        points = letter_counts(letters_of(words, length)) if words and boxes > 1 else np.zeros((0, 90), np.int32)
        trees[length] = BoxTree(points, max(4.0, len(words) / boxes))
    return trees


def _visits(trees):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [w.encode("latin-1") for w in batch["word"].to_pylist()]
            sizes = np.array([len(w) for w in words])
            out: list[tuple[np.ndarray, ...]] = []
            for length in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == length)
                points = letter_counts(letters_of([words[i] for i in rows], length))
                home = trees.value[length].homes(points)
                out.append((rows, np.full(len(rows), length), home, np.ones(len(rows), bool)))
                # Of two boxes of one length, the words of the first visit the second.
                found = [(length, leaf, at[home[at] < leaf]) for leaf, at in trees.value[length].reached(points, 1, 1)]
                if length + 1 in trees.value:
                    found += [(length + 1, leaf, at) for leaf, at in trees.value[length + 1].reached(points, 1, 0)]
                out += [(rows[at], np.full(len(at), of), np.full(len(at), leaf), np.zeros(len(at), bool)) for of, leaf, at in found]
            if out:
                rows, of, leaf, home = (np.concatenate([o[k] for o in out]) for k in range(4))
                yield pa.RecordBatch.from_arrays([pa.array(of), pa.array(leaf), pa.array(home), batch["word"].take(pa.array(rows)), batch["n"].take(pa.array(rows))], ["of", "leaf", "home", "word", "n"])

    return run


def _near(letters: np.ndarray, homes: np.ndarray, same: np.ndarray, shorter: np.ndarray, within: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of near words of a unit. letters: a row a word, shorter ones with a 0 at the end;
    homes, same and shorter are row numbers; within: also pairs among the homes."""
    n, length = letters.shape
    counts = np.zeros((n, 90), np.int32)
    long = np.concatenate([homes, same])
    counts[long] = letter_counts(letters[long])
    if len(shorter):
        counts[shorter] = letter_counts(np.ascontiguousarray(letters[shorter, :-1]))
    used = counts[homes].any(axis=0)
    strange = counts[:, ~used].sum(axis=1)
    counts = np.ascontiguousarray(counts[:, used])
    tree = BoxTree(counts[homes], LEAF_WORDS)
    exact = counts.astype(np.float32 if length < 4096 else np.float64)
    norms = (exact * exact).sum(axis=1)
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def compare(queries: np.ndarray, up: int, down: int, distance: int, verify, rank: np.ndarray | None = None) -> None:
        queries = queries[strange[queries] <= down]
        for leaf, at in tree.reached(counts[queries], up, down):
            members = homes[tree.members[leaf]]
            at = queries[at]
            for part in np.array_split(at, -(-len(at) * len(members) // 500_000) or 1):
                squares = norms[part][:, None] + norms[members] + strange[part][:, None] - 2 * (exact[part] @ exact[members].T)
                i, j = np.nonzero(squares == distance)
                i, j = part[i], members[j]
                if rank is not None:  # of two homes only one order
                    ordered = (rank[i] < 0) | (rank[i] < rank[j])
                    i, j = i[ordered], j[ordered]
                for at_pairs in range(0, len(i), max(1, 4_000_000 // length)):
                    a, b = (x[at_pairs : at_pairs + max(1, 4_000_000 // length)] for x in (i, j))
                    good = verify(letters[a], letters[b])
                    found.append((a[good], b[good]))

    def replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a != b).sum(axis=1) == 1

    def inserted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """a without its last 0 is b without one letter: the start and the end they share meet."""
        ahead = a[:, :-1] == b[:, :-1]
        behind = (a[:, :-1] == b[:, 1:])[:, ::-1]
        shared = lambda equal: np.where(equal.all(axis=1), length - 1, equal.argmin(axis=1))
        return shared(ahead) + shared(behind) >= length - 1

    rank = np.full(n, -1)
    rank[homes] = np.arange(len(homes))
    compare(np.concatenate([homes, same]) if within else same, 1, 1, 2, replaced, rank)
    compare(shorter, 1, 0, 1, inserted)
    return tuple(np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in range(2))


def _compare(rows: pa.Table) -> pa.Table:
    """(word, n_near, best_n, best) of the words of one unit that have near words in it."""
    length = rows["of"][0].as_py()
    words = [w.encode("latin-1") for w in rows["word"].to_pylist()]
    n, home = rows["n"].to_numpy(), rows["home"].to_numpy()
    letters = letters_of([w.ljust(length, b"\0") for w in words], length)
    short = letters[:, -1] == 0
    i, j = _near(letters, np.flatnonzero(home), np.flatnonzero(~home & ~short), np.flatnonzero(short), rows["part"][0].as_py() == 0)
    i, j = np.concatenate([i, j]), np.concatenate([j, i])
    rank = np.empty(len(words), np.int64)
    rank[np.ascontiguousarray(letters).view(f"S{length}").ravel().argsort(kind="stable")] = np.arange(len(words))
    order = np.lexsort((rank[j], -n[j], i))
    i, j = i[order], j[order]
    first = np.flatnonzero(np.diff(i, prepend=-1))
    near = np.diff(first, append=len(i))
    took = lambda at: rows["word"].take(pa.array(at))
    return pa.Table.from_arrays([took(i[first]), pa.array(near, pa.int64()), pa.array(n[j[first]], pa.int64()), took(j[first])], ["word", "n_near", "best_n", "best"])


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best, best_n) for the words of (word, n) that have near words: how many, and
    the most frequent of them (ties: the smallest in code-point order). Words are distinct runs
    of a-z and \\u00C0-\\u00FF, already lower-cased."""
    spark = words.sparkSession
    sizes = {r["length"]: r["count"] for r in words.groupBy(F.length("word").alias("length")).count().collect()}
    sample = [r["word"] for r in words.select("word").orderBy(F.xxhash64("word")).limit(SAMPLE_WORDS).collect()] if max(sizes.values(), default=0) > BOX_WORDS else []
    trees = spark.sparkContext.broadcast(box_trees(sample, sizes))
    visits = as_table(words.mapInArrow(_visits(trees), "of long, leaf long, home boolean, word string, n long"), "spelling-visits")
    members = visits.groupBy("of", "leaf").agg(F.sum(F.col("home").cast("long")).alias("homes"), F.count("*").alias("members"))
    whole = lambda rows, most: F.greatest(F.ceil(rows / F.greatest(F.lit(1.0), most)), F.lit(1)).cast("int")
    most = F.least(F.lit(float(2 * BOX_WORDS)), F.lit(float(BOX_LETTERS)) / F.col("of"))
    members = members.filter("homes > 0").select("of", "leaf", whole(F.col("homes"), most).alias("blocks"), whole(F.col("members"), VISITORS * most).alias("parts"))
    placed = visits.join(members, ["of", "leaf"]).withColumn("own_block", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")).withColumn("own_part", F.pmod(F.xxhash64("word", F.lit(1)), F.col("parts")).cast("int"))
    # A word is at home in one block, in each of its parts, and visits the later blocks of its box.
    steps = lambda low, high, home, part: F.transform(F.filter(F.sequence(F.lit(0), high), lambda k: k >= low), lambda k: F.struct(F.lit(home).alias("home"), (part if part is not None else k).cast("int").alias("part"), (k if part is not None else F.col("own_block")).cast("int").alias("block")))
    at_home = F.concat(steps(F.lit(0), F.col("parts") - 1, True, None), steps(F.col("own_block") + 1, F.col("blocks") - 1, False, F.col("own_part")))
    visiting = steps(F.lit(0), F.col("blocks") - 1, False, F.col("own_part"))
    units = placed.select("of", "leaf", "word", "n", F.inline(F.when(F.col("home"), at_home).otherwise(visiting)))
    found = units.groupBy("of", "leaf", "block", "part").applyInArrow(_compare, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("first")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", F.col("first.best").alias("best"), (-F.col("first.less")).alias("best_n"))


def last_forms(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): where the forms end. A form occurs more often than its word
    by a factor, so chains are short; each round doubles the steps, in the shared folder."""
    rounds = Rounds(forms.sparkSession, "spelling-forms")
    hops = rounds.write(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = hops.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = hops.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        moved = rounds.write(moved)
        hops = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return hops


def spelling_variants(words: DataFrame, factor: int = FORM_FACTOR) -> DataFrame:
    """A row for each word of (word, n): word, form, root, n, n_near, form_n.

    Near are words one inserted, deleted or replaced letter apart. form: the near word of largest
    n (ties: the smallest in code-point order) if it occurs at least factor times as often, else
    null; root: the last form in the chain, the word itself if it has no form; n_near: near words,
    0 if none. Words are distinct; without words the result is empty."""
    words = as_table(words.select("word", "n"), "spelling-words")
    near = near_words(words)
    formed = F.col("best_n") >= factor * F.col("n")
    named = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(formed, F.col("best")).alias("form"), F.when(formed, F.col("best_n")).alias("form_n"))
    named = as_table(named, "spelling-named")
    roots = last_forms(named.filter("form IS NOT NULL"))
    return named.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def group_spellings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """spelling_variants of the words of all whole texts. Null and empty texts have no words, rows
    that repeat are counted as often, an empty table gives an empty result; other columns are not
    read."""
    return spelling_variants(count_words(docs, id_col, text_col))
