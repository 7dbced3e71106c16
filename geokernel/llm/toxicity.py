"""Toxicity categories predicted by a chain of linear models.

The categories are predicted one after the other; each model sees the hashed features of the
text and the probabilities of all categories before it (Read et al., 2011). While a later model
is trained, those earlier probabilities come from models that did not see the row (out of fold),
so training and scoring feed it the same kind of input.

labels has one toxic flag. Two weak categories stand before it in the chain: `explicit` (several
words of the text have marked stems) and `dense` (such words are a larger share of the text than
in the median text that holds any). Marked are the stems that toxic rows of the fit use and its
clean rows hardly do; the two categories ask only for the words, so clean rows may have them.
`toxic`, the given label, is last and decides. Stems, features and their weights are drawn anew
in each fold from the rows that the fold's models are fitted on.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .grams import gram_counts
from .samples import Bags, gathered, lowest_draws
from .shared import as_table

GRAMS = (4, 5)
BITS = 18
#: Bounds on the labelled rows of the fit.
TOXIC_ROWS, CLEAN_ROWS = 4000, 5000
FOLDS = 3
#: Every model takes this many steps over so many rows each, whatever the size of the sample.
STEPS, BATCH = 800, 64
#: Hashed n-grams that a model uses: those that tell toxic rows from clean ones best.
FEATURES = 2048
#: Rows that are turned into features at a time.
BLOCK = 512
#: Keeps the features of a text with few of them from being blown up.
DAMPING = 200.0
SCALE = 8.0
#: Share of clean rows that the rejection threshold may cost, by out-of-fold scores.
CLEAN_LOST, LEAST_SCORE = 0.002, 0.5
CATEGORIES = ("explicit", "dense", "toxic")
#: Marked stems occur in this many toxic rows at least and in clean ones this share of that at
#: most; `explicit` texts hold so many words with one.
STEM, STEM_ROWS, STEM_CLEAN, EXPLICIT_WORDS = 5, 8, 0.05, 2
_WORD = re.compile(r"[^\W\d_]+")

@dataclass
class Linear:
    weights: np.ndarray
    bias: float
    extra: np.ndarray

    def score(self, u: np.ndarray, v: np.ndarray, earlier: np.ndarray) -> float:
        return float(self.weights[u] @ v + self.bias + self.extra @ earlier)


@dataclass
class Vectors:
    """Sparse rows: where each begins, and the columns and values of all, one after the other."""

    starts: np.ndarray
    column: np.ndarray
    value: np.ndarray

    def scores(self, model: Linear, rows: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        at, row = gathered(self.starts, rows)
        return np.bincount(row, model.weights[self.column[at]] * self.value[at], len(rows)) + model.bias + earlier[rows] @ model.extra


@dataclass
class Chain:
    #: The column of each hashed n-gram, -1 for those that no model uses.
    place: np.ndarray
    #: Of each column, how rare its n-gram is.
    idf: np.ndarray
    models: list[Linear] = field(default_factory=list)
    categories: tuple[str, ...] = CATEGORIES
    threshold: float = 2.0

    def vector(self, columns: np.ndarray, counts: np.ndarray) -> np.ndarray:
        v = np.log1p(counts) * self.idf[columns]
        return (SCALE * v / np.sqrt(v @ v + DAMPING)).astype(np.float32)

    def vectors(self, bags: Bags) -> Vectors:
        """Rows of hashed n-grams and counts as rows of columns and values."""
        starts, ids, counts = bags.flat()
        lengths, columns, values = [np.zeros(1, np.int64)], [], []
        for low in range(0, len(bags), BLOCK):
            high = min(len(bags), low + BLOCK)
            part = slice(starts[low], starts[high])
            at = self.place[ids[part]]
            used = np.flatnonzero(at >= 0)
            row = np.searchsorted(starts[low : high + 1] - starts[low], used, "right") - 1
            value = np.log1p(counts[part][used]) * self.idf[at[used]]
            value *= SCALE / np.sqrt(np.bincount(row, value * value, high - low) + DAMPING)[row]
            lengths.append(np.bincount(row, minlength=high - low))
            columns.append(at[used])
            values.append(value.astype(np.float32))
        return Vectors(np.cumsum(np.concatenate(lengths)), np.concatenate([*columns, np.zeros(0, np.int32)]), np.concatenate([*values, np.zeros(0, np.float32)]))

    def predict(self, text: str | None) -> list[float]:
        """The probability of each category, in the chain's order."""
        if not text or not self.models:
            return [0.0] * len(self.categories)
        columns, counts = gram_counts(text, GRAMS, BITS, self.place, len(self.idf))
        if not len(columns):
            return [0.0] * len(self.categories)
        v, found = self.vector(columns, counts), np.zeros(0)
        for model in self.models:
            found = np.append(found, _sigmoid(model.score(columns, v, found)))
        return found.tolist()


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_linear(vectors: Vectors, fit: np.ndarray, y: np.ndarray, earlier: np.ndarray, width: int, steps: int = STEPS, rate: float = 0.08, seed: int = 5) -> Linear:
    """Logistic regression on the rows `fit` by mini-batches with a step size for each feature."""
    w, g2 = np.zeros(width), np.full(width, 1e-6)
    extra, e2 = np.zeros(earlier.shape[1]), np.full(earlier.shape[1], 1e-6)
    bias, rng, n = -2.0, np.random.default_rng(seed), len(fit)
    order = np.concatenate([rng.permutation(fit) for _ in range(-(-steps * BATCH // n))]) if n else fit
    for at in range(0, min(len(order), steps * BATCH), BATCH):
        some = order[at : at + BATCH]
        place, row = gathered(vectors.starts, some)
        u, v = vectors.column[place], vectors.value[place]
        z = np.bincount(row, w[u] * v, len(some)) + bias + earlier[some] @ extra
        d = _sigmoid(z) - y[some]
        g = np.bincount(u, d[row] * v, width) + 1e-4 * w
        g2 += g * g
        w -= rate * g / np.sqrt(g2)
        if len(extra):
            ge = d @ earlier[some]
            e2 += ge * ge
            extra -= rate * ge / np.sqrt(e2)
        bias -= 0.05 * d.mean()
    return Linear(w.astype(np.float32), bias, extra)


def telling(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int, features: int = FEATURES) -> np.ndarray:
    """The n-grams whose share of toxic rows differs most from that of clean ones, by the
    two-proportion z score; toxic and clean: how many rows of either kind hold each n-gram."""
    p = (toxic + clean) / max(1, n_toxic + n_clean)
    spread = np.sqrt(p * (1 - p) * (1 / max(1, n_toxic) + 1 / max(1, n_clean)))
    z = np.abs(toxic / max(1, n_toxic) - clean / max(1, n_clean)) / np.maximum(spread, 1e-9)
    z[p == 0] = -1
    best = np.argsort(-z, kind="stable")[:features]
    return best[z[best] >= 0]


def _opened(bags: Bags, fit: np.ndarray, y: np.ndarray, categories: tuple[str, ...]) -> Chain:
    """A chain without models: the features of the rows `fit` and their rarity."""
    starts, ids, _ = bags.flat()
    lengths, kind = np.diff(starts), np.full(len(bags), -1, np.int8)
    kind[fit] = y[fit]
    kind = np.repeat(kind, lengths)
    held = [np.bincount(ids[kind == t], minlength=1 << BITS) for t in (0, 1)]
    best = np.sort(telling(held[1], held[0], int(y[fit].sum()), int((1 - y[fit]).sum())))
    place = np.full(1 << BITS, -1, np.int32)
    place[best] = np.arange(len(best))
    idf = np.log((len(fit) + 1) / (held[0][best] + held[1][best] + 1)).astype(np.float32)
    return Chain(place, idf, categories=tuple(categories))


def train_chain(bags: list[np.ndarray], counts: list[np.ndarray], labels: np.ndarray, categories: tuple[str, ...] = CATEGORIES, folds: int = FOLDS) -> Chain:
    """Fit the chain on sparse rows (feature ids, counts) and a column of labels a category."""
    fold = np.random.default_rng(9).permutation(len(bags)) % folds
    return train_rows(Bags.of(zip(bags, counts, strict=True), "<u4", "<u4"), lambda fit: labels, categories, fold)


def train_rows(bags: Bags, label_of: Callable[[np.ndarray], np.ndarray], categories: tuple[str, ...], fold: np.ndarray) -> Chain:
    """Fit the chain on sparse rows whose fold is given.

    label_of: gives a column a category for all rows, as the rows of a fit define them. The last
    category decides and is the same for all fits."""
    everything = np.arange(len(bags))
    y = label_of(everything)
    fits = []
    for f in np.unique(fold):
        fit = np.flatnonzero(fold != f)
        fits.append((fit, np.flatnonzero(fold == f), _opened(bags, fit, y[:, -1], categories), label_of(fit)))
    chain = _opened(bags, everything, y[:, -1], categories)
    earlier, out = np.zeros((len(bags), 0)), np.zeros(len(bags))
    for k in range(len(categories)):
        out = np.zeros(len(bags))
        for fit, rest, part, own in fits:
            vectors = part.vectors(bags)
            model = fit_linear(vectors, fit, own[:, k].astype(float), earlier, len(part.idf))
            out[rest] = _sigmoid(vectors.scores(model, rest, earlier))
        chain.models.append(fit_linear(chain.vectors(bags), everything, y[:, k].astype(float), earlier, len(chain.idf)))
        earlier = np.column_stack([earlier, out])
    chain.threshold = _threshold(y[:, -1], out)
    return chain


def _threshold(y: np.ndarray, p: np.ndarray) -> float:
    """The score that only so many clean rows reach out of fold, and at least LEAST_SCORE."""
    clean = p[y == 0]
    return float(max(LEAST_SCORE, np.quantile(clean, 1 - CLEAN_LOST))) if len(clean) and y.any() else 2.0


class Stems:
    """Hashed stems of the sample's words, over all rows."""

    def __init__(self, bags: Bags, toxic: np.ndarray):
        starts, ids, counts = bags.flat()
        self.row = np.repeat(np.arange(len(bags), dtype=np.int32), np.diff(starts))
        self.names, self.stem = np.unique(ids, return_inverse=True)
        self.count, self.toxic, self.words = counts, toxic, np.bincount(self.row, counts, len(bags))

    def marked(self, fit: np.ndarray) -> np.ndarray:
        """Which stems these rows mark."""
        used = np.zeros(len(self.toxic), bool)
        used[fit] = True
        used = used[self.row]
        bad = np.bincount(self.stem[used & (self.toxic[self.row] == 1)], minlength=len(self.names))
        good = np.bincount(self.stem[used & (self.toxic[self.row] == 0)], minlength=len(self.names))
        scale = max(1, int((self.toxic[fit] == 1).sum())) / max(1, int((self.toxic[fit] == 0).sum()))
        return (bad >= STEM_ROWS) & (good * scale <= STEM_CLEAN * bad)

    def categories(self, fit: np.ndarray) -> np.ndarray:
        """Columns explicit, dense and toxic of all rows, by the stems that the given ones mark."""
        marked = self.marked(fit)[self.stem]
        hits = np.bincount(self.row[marked], self.count[marked], len(self.toxic))
        share = hits / np.maximum(1, self.words)
        some = share[fit][hits[fit] > 0]
        dense = share > (np.median(some) if len(some) else 1)
        return np.column_stack([hits >= EXPLICIT_WORDS, dense, self.toxic]).astype(np.int8)


def stems_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    hashed = [xxhash.xxh32_intdigest(w[:STEM].encode("utf-8", "surrogatepass")) for w in _WORD.findall(text.lower())]
    return np.unique(np.array(hashed, np.uint32), return_counts=True)


def _packed(values: np.ndarray, counts: np.ndarray) -> bytes:
    return zlib.compress(values.astype("<u4").tobytes() + counts.astype("<u8").tobytes(), 1)


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zlib.decompress(data)
    n = len(raw) // 12
    return np.frombuffer(raw, "<u4", n), np.frombuffer(raw, "<u8", n, 4 * n)


def labelled_sample(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS) -> DataFrame:
    """(doc_id, toxic, bag, stems) of a bounded sample of the labelled documents, chosen by a hash
    of the id and written to the shared folder. A document whose label rows disagree is left
    out; null ids, flags and texts are too."""
    flags = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("hi")).filter("toxic = hi").select(F.col("doc_id").alias("label_id"), "toxic")
    draw = F.xxhash64("label_id", F.lit(23))
    chosen = lowest_draws(flags.filter("toxic = 1"), "toxic", toxic_rows, draw).union(lowest_draws(flags.filter("toxic = 0"), "toxic", clean_rows, draw))
    texts = docs.filter("text IS NOT NULL").select(F.col("doc_id").alias("label_id"), "text", F.xxhash64("text").alias("text_key"))

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text"].to_pylist()
            bags = pa.array([_packed(*gram_counts(t, GRAMS, BITS)) for t in texts], pa.binary())
            stems = pa.array([_packed(*stems_of(t)) for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([batch["label_id"], batch["toxic"].cast(pa.int32()), bags, stems], ["doc_id", "toxic", "bag", "stems"])

    # Both tables are bounded by the parameters, so they go to the texts and the texts stay
    # where they are. Of several texts with one doc_id, one is taken.
    ids = as_table(F.broadcast(chosen).join(texts.drop("text"), "label_id").groupBy("label_id", "toxic").agg(F.min("text_key").alias("text_key")), "toxic-ids")
    rows = F.broadcast(ids).join(texts, ["label_id", "text_key"]).select("label_id", "toxic", "text")
    return as_table(rows.mapInArrow(featured, "doc_id long, toxic int, bag binary, stems binary").dropDuplicates(["doc_id"]), "toxic-sample")


def fit_from_labels(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS) -> Chain:
    """Fit on labelled_sample."""
    return fit_from_sample(labelled_sample(docs, labels, toxic_rows, clean_rows))


def fit_from_sample(sample: DataFrame) -> Chain:
    """The chain of a labelled_sample, which is gone through twice, row by row: once for how many
    rows hold each n-gram, once for the n-grams that some fit uses. Only the latter are held on
    the driver."""
    # Steps are taken in the order of the ids, so the fit does not depend on files or tasks.
    sample = sample.orderBy("doc_id")
    seen = np.zeros((FOLDS, 2, 1 << BITS), np.int32)
    rows, stems, bags = [], Bags("<u4", "<u4"), Bags("<u4", "<u4")
    for r in sample.toLocalIterator():
        fold = zlib.crc32(str(r["doc_id"]).encode()) % FOLDS
        seen[fold, r["toxic"]][_unpacked(r["bag"])[0]] += 1
        stems.append(*_unpacked(r["stems"]))
        rows.append((fold, r["toxic"]))
    fold, toxic = (np.array([x[k] for x in rows], int) for k in (0, 1))
    if not toxic.any():
        return Chain(np.full(1 << BITS, -1, np.int32), np.zeros(0, np.float32))
    wanted = np.zeros(1 << BITS, bool)
    for f in range(-1, FOLDS):
        held = seen.sum(axis=0) - (seen[f] if f >= 0 else 0)
        wanted[telling(held[1], held[0], int((toxic[fold != f] == 1).sum()), int((toxic[fold != f] == 0).sum()))] = True
    for r in sample.select("bag").toLocalIterator():
        u, c = _unpacked(r["bag"])
        bags.append(u[wanted[u]], c[wanted[u]])
    return train_rows(bags, Stems(stems, toxic).categories, CATEGORIES, fold)


def score_documents(docs: DataFrame, chain: Chain, keep_columns: bool = False) -> DataFrame:
    """docs with a probability p_<category> for each category and rejected.

    A text without any of the model's n-grams, so a null, empty or letterless one, has
    probability 0 everywhere and is not rejected; without labelled toxic rows none is. Columns of
    docs with the names of the results are replaced. Rows that repeat are judged each and alike.
    An empty table gives an empty result."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    names = [f"p_{c}" for c in chain.categories] + ["rejected"]
    docs = docs.drop(*names) if keep_columns else docs.select("doc_id", "text")
    kept = docs.columns if keep_columns else ["doc_id"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in kept)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([shared.value.predict(t) for t in batch["text"].to_pylist()]).reshape(-1, len(names) - 1)
            extra = [pa.array(found[:, i], pa.float64()) for i in range(len(names) - 1)] + [pa.array(found[:, -1] >= shared.value.threshold, pa.bool_())]
            yield pa.RecordBatch.from_arrays([batch[c] for c in kept] + extra, kept + names)

    return docs.mapInArrow(predict, f"{schema}, {', '.join(f'{n} double' for n in names[:-1])}, rejected boolean")
