"""Language identification by averaged hashed subword embeddings and a linear softmax.

The model is the one of fastText-style classifiers (Joulin et al., 2016): a text is the mean of
the embeddings of its hashed character n-grams, and a linear softmax turns the mean into
languages. It is trained on the driver in numpy by stochastic gradient descent over a bounded
sample of labelled rows. A temperature calibrates the score; it is fitted on the logits that
each row has from a model that was trained without it, and so is the score below which a
prediction is rejected.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .grams import gram_counts, has_letter
from .samples import Bags, lowest_draws
from .shared import as_table

GRAMS = (2, 3, 4)
BITS = 16
DIMENSIONS = 16
#: Bounds on the labelled rows that a language brings to the fit, and on those of all.
ROWS_PER_LANGUAGE, FIT_ROWS = 1500, 8000
#: Bound on the languages that are learned: those with the most labelled rows.
LANGUAGES = 256
EPOCHS = 4
#: Parts of the sample; each is scored by a model of the others for the calibration.
FOLDS = 2
#: Share of correct calibration rows that the rejection score may cost at most.
CORRECT_LOST = 0.0005
#: A prediction with at least this score is never rejected.
SURE = 0.5


@dataclass
class LanguageModel:
    languages: list[str]
    #: Embeddings and softmax weights multiplied out: a row of logits for each hashed n-gram.
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    reject_below: float

    def logits(self, text: str) -> np.ndarray:
        grams, counts = gram_counts(text, GRAMS, BITS)
        return self.bias + (counts @ self.table[grams] / counts.sum() if len(grams) else 0)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, calibrated score, rejected); und, 0 and rejected without a letter."""
        if not has_letter(text) or not self.languages:
            return "und", 0.0, True
        p = _softmax(self.logits(text) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best]), bool(p[best] < self.reject_below)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def descend(bags: Bags, language: np.ndarray, fit: np.ndarray, languages: int, epochs: int = EPOCHS, rate: float = 8.0, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """The logits of each hashed n-gram and the bias, from the rows `fit` of the bags."""
    starts, ids, shares = bags.flat()
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 1 / DIMENSIONS, (1 << BITS, DIMENSIONS)).astype(np.float32)
    weights, bias = np.zeros((languages, DIMENSIONS), np.float32), np.zeros(languages, np.float32)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for i in rng.permutation(fit):
            u, share = ids[starts[i] : starts[i + 1]], shares[starts[i] : starts[i + 1]]
            mean = share @ embed[u]
            error = _softmax(weights @ mean + bias)
            error[language[i]] -= 1
            down = error @ weights
            weights -= step * 0.1 * np.outer(error, mean)
            bias -= step * 0.001 * error
            embed[u] -= step * share[:, None] * down
    return (embed @ weights.T).astype(np.float32), bias


def train(bags: Bags, tags: list[str]) -> LanguageModel:
    """Fit on rows of distinct hashed n-grams with their shares of the text, and a language each."""
    languages = sorted(set(tags))
    if not languages:
        return LanguageModel([], np.zeros((1 << BITS, 0), np.float32), np.zeros(0), 1.0, 0.0)
    language = np.array([languages.index(tag) for tag in tags], int)
    starts, ids, shares = bags.flat()
    fold, z = np.random.default_rng(4).permutation(len(tags)) % FOLDS, np.zeros((len(tags), len(languages)))
    for f in range(FOLDS):
        table, bias = descend(bags, language, np.flatnonzero(fold != f), len(languages))
        for i in np.flatnonzero(fold == f):
            z[i] = bias + shares[starts[i] : starts[i + 1]] @ table[ids[starts[i] : starts[i + 1]]]
    temperature, reject_below = _calibrate(z, language)
    table, bias = descend(bags, language, np.arange(len(tags)), len(languages))
    return LanguageModel(languages, table, bias, temperature, reject_below)


def _calibrate(z: np.ndarray, truth: np.ndarray) -> tuple[float, float]:
    if not len(z):
        return 1.0, 0.0
    # As in Platt scaling, targets a little short of certainty keep separable rows calibrated.
    short = 1 / (len(z) + 2)
    target = np.full(z.shape, short / max(1, z.shape[1] - 1))
    target[np.arange(len(z)), truth] = 1 - short
    choices = np.geomspace(0.05, 20, 121)
    losses = [-(target * np.log(_softmax(z / t) + 1e-12)).sum(axis=1).mean() for t in choices]
    temperature = float(choices[int(np.argmin(losses))])
    p = _softmax(z / temperature)
    right = p.max(axis=1)[p.argmax(axis=1) == truth]
    return temperature, float(min(SURE, np.quantile(right, CORRECT_LOST))) if len(right) else 0.0


def in_fold(id_col: str, fold: int):
    """Whether crc32 of the id as text leaves this remainder at 5; false without an id."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(5)) == fold, F.lit(False))


def _features(docs: DataFrame, rows_per_language: int) -> DataFrame:
    """(lang, grams, counts) of the sample, written to the shared folder."""
    labelled = docs.filter(~in_fold("doc_id", 0) & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    labelled = labelled.select("lang", "text", F.xxhash64("doc_id", "text", F.lit(11)).alias("key"))
    learned = as_table(labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).select("lang"), "languages")
    most = min(rows_per_language, FIT_ROWS // max(1, learned.count()))
    keys = labelled.select("lang", "key").join(F.broadcast(learned), "lang")
    # Bounded by the parameters, so the sample goes to the texts; repeated rows count once.
    keys = as_table(lowest_draws(keys, "lang", most, F.col("key")).distinct(), "language-keys")

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [gram_counts(t, GRAMS, BITS) for t in batch["text"].to_pylist()]
            packed = [pa.array([zlib.compress(f[k].astype(kind).tobytes(), 1) for f in found], pa.binary()) for k, kind in ((0, "<u2"), (1, "<u8"))]
            yield pa.RecordBatch.from_arrays([batch["key"], batch["lang"], *packed], ["key", "lang", "grams", "counts"])

    rows = F.broadcast(keys).join(labelled, ["lang", "key"]).mapInArrow(featured, "key long, lang string, grams binary, counts binary")
    return as_table(rows.dropDuplicates(["lang", "key"]), "language-sample")


def fit_from_documents(docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE) -> LanguageModel:
    """Fit on at most rows_per_language labelled rows a language and FIT_ROWS rows in all,
    chosen by a hash of the row, outside fold 0. The LANGUAGES most frequent values of lang are
    learned, so neither rows nor tags that grow in number reach the driver."""
    bags, tags = Bags("<u2", "<f4"), []
    # The order of steps matters to the last digits: rows go by their keys.
    for r in _features(docs, rows_per_language).orderBy("key", "lang").toLocalIterator():
        grams, counts = (np.frombuffer(zlib.decompress(r[c]), kind) for c, kind in (("grams", "<u2"), ("counts", "<u8")))
        if len(grams):
            bags.append(grams, counts / counts.sum())
            tags.append(r["lang"])
    return train(bags, tags)


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text", keep_columns: bool = False) -> DataFrame:
    """docs with lang_pred, score and rejected, from the whole text alone.

    Only the text is an input. Null texts and texts without a letter are und with score 0 and
    rejected. Columns of docs with the names of the results are replaced. Rows that repeat are
    judged each and alike. An empty table gives an empty result; without labelled rows every text
    is und."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["lang_pred", "score", "rejected"]
    docs = docs.drop(*names) if keep_columns else docs.select("doc_id", text_col)
    kept = docs.columns if keep_columns else ["doc_id"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in kept)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.predict(t) for t in batch[text_col].to_pylist()]
            extra = [pa.array([x[i] for x in found], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([batch[c] for c in kept] + extra, kept + names)

    return docs.mapInArrow(predict, f"{schema}, lang_pred string, score double, rejected boolean")
