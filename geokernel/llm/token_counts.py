"""Token-count rollups that are maintained by deltas.

Totals of documents and tokens by source, language and tokenizer version are never recounted:
each batch of inserts, deletes and revised counts becomes signed amounts, is added up by key and
committed once under its batch id. Committing a batch again changes nothing, whether the first
attempt ended or not: rows of an attempt count only if the commit log names that attempt.

The log is a folder of numbered files. A driver takes the next number by creating its file where
none may be yet. A file that its driver did not live to fill is no entry and is passed over; its
batch is not committed, and whoever sends the batch again takes a later number. Of several entries
of one batch id, as two drivers may write at once, the lowest counts. fold() adds the amounts of all
entries so far to stored totals; later reads take those and the amounts of newer entries only.

Creating a file where none may be is exclusive on HDFS and local file systems. Object stores
without conditional writes give no such promise: there, let one driver at a time commit.
"""

from __future__ import annotations

import base64
import json
import uuid
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geokernel.operators.tables import remove

KEYS = ("source", "lang", "tokenizer")
INSERT, DELETE, REVISE = "insert", "delete", "revise"


def signed(changes: DataFrame) -> DataFrame:
    """Additive amounts (source, lang, tokenizer, docs, tokens) of a batch of changes.

    changes: op, source, lang, tokenizer, n_tokens, old_tokens. An insert adds n_tokens and a
    document, a delete takes them away, a revision adds n_tokens - old_tokens. Null keys are a
    key like any other, null counts are 0, other operations are an error. Rows that repeat are
    changes of their own, an empty batch has no amounts, other columns are not read. Sums are
    built before the shuffle, so a hot source costs one row for each task."""
    n, old = F.coalesce("n_tokens", F.lit(0)), F.coalesce("old_tokens", F.lit(0))
    unknown = F.raise_error(F.concat(F.lit("unknown change: "), F.coalesce("op", F.lit("null")))).cast("long")
    docs = F.when(F.col("op") == INSERT, 1).when(F.col("op") == DELETE, -1).when(F.col("op") == REVISE, 0).otherwise(unknown)
    tokens = F.when(F.col("op") == INSERT, n).when(F.col("op") == DELETE, -n).when(F.col("op") == REVISE, n - old).otherwise(unknown)
    return changes.select(*KEYS, docs.cast("long").alias("docs"), tokens.cast("long").alias("tokens")).groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))


class TokenRollup:
    """A rollup in a folder that driver and executors share. An empty batch is committed like any
    other; without commits the totals are empty."""

    AMOUNTS = "source string, lang string, tokenizer string, docs long, tokens long"
    LOG = "n long, batch_id string, attempt string"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.deltas, self.commits, self.folds = spark, f"{path}/deltas", f"{path}/commits", f"{path}/folds"
        for folder in (self.commits, self.folds):
            place, fs = self._at(folder)
            fs.mkdirs(place)

    def _at(self, path: str) -> tuple:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _created(self, path: str, content: str) -> bool:
        """Whether the file was not there and has been written."""
        place, fs = self._at(path)
        try:
            out = fs.create(place, False)
        except Py4JJavaError:
            if fs.exists(place):
                return False
            raise
        out.write(bytearray(content.encode()))
        out.close()
        return True

    def _names(self, folder: str) -> list[str]:
        place, fs = self._at(folder)
        return [s.getPath().getName() for s in fs.listStatus(place)]

    def _folded(self) -> list[tuple[int, str]]:
        """(last entry, folder) of every finished fold, newest first."""
        _, fs = self._at(self.folds)
        done = [n for n in self._names(self.folds) if fs.exists(self._at(f"{self.folds}/{n}/batches/_SUCCESS")[0])]
        return sorted(((int(n.split("-")[0]), f"{self.folds}/{n}") for n in done), reverse=True)

    def _in_folds(self, folded: list[tuple[int, str]], batch_ids: list[str]) -> set[str]:
        """Which of these batches the folds hold. Each fold lists the ids that it took in."""
        if not folded or not batch_ids:
            return set()
        known = self.spark.read.schema("batch_id string").parquet(*(f"{path}/batches" for _, path in folded))
        return {r["batch_id"] for r in known.filter(F.col("batch_id").isin(batch_ids)).distinct().collect()}

    def _entries(self, folded: list[tuple[int, str]]) -> list:
        """The entries that count and that no fold holds: as many as there were commits since."""
        last = folded[0][0] if folded else 0
        log = self.spark.read.schema(self.LOG).json(self.commits)
        found = log.filter((F.col("n") > last) & F.col("attempt").isNotNull()).orderBy("n").collect()
        known = self._in_folds(folded, [e["batch_id"] for e in found])
        first = {e["batch_id"]: e for e in reversed(found)}
        return [e for e in found if e["batch_id"] not in known and first[e["batch_id"]] is e]

    def committed(self, batch_id: str) -> bool:
        return self._attempt(batch_id) is not None

    def _attempt(self, batch_id: str) -> str | None:
        """The attempt that counts for a batch; "" where a fold holds it."""
        folded = self._folded()
        for e in self._entries(folded):
            if e["batch_id"] == batch_id:
                return e["attempt"]
        return "" if self._in_folds(folded, [batch_id]) else None

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Add a batch unless its id is known; whether it was added."""
        if self.committed(batch_id):
            return False
        attempt = uuid.uuid4().hex
        signed(changes).write.parquet(f"{self.deltas}/attempt={attempt}")
        while True:
            folded = self._folded()
            n = max([folded[0][0] if folded else 0, *(int(x.split(".")[0]) for x in self._names(self.commits) if x.endswith(".json"))]) + 1
            if not self._created(f"{self.commits}/{n:012d}.json", json.dumps({"n": n, "batch_id": batch_id, "attempt": attempt})):
                continue  # another driver was faster: there is one more number now
            counted = self._attempt(batch_id)
            if counted is None:
                continue  # a fold went past the number before it was filled
            # A fold that holds the batch took it from this entry or from another driver's.
            if counted not in ("", attempt):
                remove(self.spark, f"{self.deltas}/attempt={attempt}")
            return counted in ("", attempt)

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, docs, tokens; keys whose amounts are all used up are gone."""
        folded = self._folded()
        return self._sums(folded, self._entries(folded)).filter("docs <> 0 OR tokens <> 0")

    def _sums(self, folded: list[tuple[int, str]], entries: list) -> DataFrame:
        parts = ([f"{folded[0][1]}/totals"] if folded else []) + [f"{self.deltas}/attempt={e['attempt']}" for e in entries]
        if not parts:
            return self.spark.createDataFrame([], self.AMOUNTS)
        return self.spark.read.schema(self.AMOUNTS).parquet(*parts).groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))

    def fold(self) -> None:
        """Store the totals of all entries so far, and the ids of those that are new. What the
        fold before this one had taken in already is removed; readers of that fold can still
        finish."""
        folded = self._folded()
        entries = self._entries(folded)
        if not entries:
            return
        path = f"{self.folds}/{entries[-1]['n']}-{uuid.uuid4().hex}"
        self._sums(folded, entries).filter("docs <> 0 OR tokens <> 0").write.parquet(f"{path}/totals")
        self.spark.createDataFrame([(e["batch_id"],) for e in entries], "batch_id string").write.parquet(f"{path}/batches")
        if folded:
            log = self.spark.read.schema(self.LOG).json(self.commits)
            for e in log.filter((F.col("n") <= folded[0][0]) & F.col("attempt").isNotNull()).collect():
                remove(self.spark, f"{self.deltas}/attempt={e['attempt']}")
            for name in self._names(self.commits):
                if name.endswith(".json") and int(name.split(".")[0]) <= folded[0][0]:
                    remove(self.spark, f"{self.commits}/{name}")
            for _, older in folded[1:]:
                remove(self.spark, f"{older}/totals")


@lru_cache(1)
def _encoding(ranks: bytes, pattern: str):
    """One for all tasks of a Python worker."""
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def count_tokens(docs: DataFrame, rank_path: str, pattern: str, columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars")) -> DataFrame:
    """The columns and, of every whole text, n_words and n_bpe (null and empty texts: 0). Rows that
    repeat are counted each; an empty table gives an empty result. Columns named n_words or n_bpe
    may not be asked for; others of the input are not read."""
    with open(rank_path, "rb") as f:
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(ranks.value, pattern).encode_ordinary
        for batch in batches:
            texts = batch["text"].to_pylist()
            extra = [pa.array([len(t.encode("utf-8").split()) if t else 0 for t in texts], pa.int64()), pa.array([len(encode(t)) if t else 0 for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([batch[c] for c in columns] + extra, [*columns, "n_words", "n_bpe"])

    docs = docs.select(*columns, "text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    return docs.mapInArrow(count, f"{schema}, n_words long, n_bpe long")
