"""What several operators need: shared tables, hashed words, table access."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geokernel.operators.tables import shared_path as shared_path
from geokernel.operators.tables import written as as_table

_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_row_key(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with a column that tells every row from every other, equal ones included, and the
    column's name, which none of docs has: the digest of its file's full path and its place there.
    Rows that come from no file are written to the shared folder first."""
    name = "row_key"
    while name in docs.columns:
        name = f"_{name}"

    def keyed(table: DataFrame) -> DataFrame:
        place = table.metadataColumn("_metadata")
        return table.select(*(F.col(f"`{c}`") for c in table.columns), F.concat_ws(":", F.md5(place["file_path"]), place["row_index"]).alias(name))

    try:
        return keyed(docs), name
    except AnalysisException:
        return keyed(as_table(docs, "rows")), name


def ascii_words(text: str | None) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+ of the text with A-Z lower-cased, as UTF-8.

    bytes.lower() and bytes.split() work on ASCII alone, which is just this definition."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


class WordHashes(dict):
    """Word -> 64-bit hash, remembered up to a bound on memory."""

    def __init__(self, bound: int = 400_000):
        super().__init__()
        self.bound = bound

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.bound:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def mix64(x):
    """A bijective finisher over uint64 arrays."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(_MIX[0])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_MIX[1])
    return x ^ (x >> np.uint64(31))


def pieces(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest index of each one's connected piece."""
    low = np.arange(n)
    while True:
        new = low.copy()
        np.minimum.at(new, i, low[j])
        np.minimum.at(new, j, low[i])
        new = new[new]
        if (new == low).all():
            return low
        low = new
