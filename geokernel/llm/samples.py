"""Bounded samples of rows on which classifiers are fitted."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Shards of a value's rows. Spark prunes each shard in every task before anything is shuffled.
SHARDS = 64


def lowest_draws(rows: DataFrame, by: str, per_value: int, draw: Column) -> DataFrame:
    """At most per_value rows of each value of `by`: those whose draw (a 64-bit hash) is lowest
    among the lowest of each of SHARDS shards. Rows that repeat share a draw, so they fill one
    shard alone; what the shards leave is little more than per_value rows."""
    each = max(1, -(-per_value // SHARDS))
    shard = Window.partitionBy(by, F.pmod("draw", F.lit(SHARDS))).orderBy("draw")
    kept = rows.withColumn("draw", draw).withColumn("place", F.row_number().over(shard)).filter(F.col("place") <= each)
    whole = Window.partitionBy(by).orderBy("draw")
    return kept.withColumn("place", F.row_number().over(whole)).filter(F.col("place") <= per_value).drop("place", "draw")


class Bags:
    """Sparse rows in two flat arrays: ids and a number for each. They grow in place, so a
    sample takes what it holds and gives it back at once."""

    def __init__(self, id_type: str, number_type: str):
        self._ids, self._numbers, self.types = bytearray(), bytearray(), (np.dtype(id_type), np.dtype(number_type))
        self._ends = [0]

    @staticmethod
    def of(rows: Iterable[tuple[np.ndarray, np.ndarray]], id_type: str, number_type: str) -> Bags:
        out = Bags(id_type, number_type)
        for ids, numbers in rows:
            out.append(ids, numbers)
        return out

    def append(self, ids: np.ndarray, numbers: np.ndarray) -> None:
        self._ids += ids.astype(self.types[0]).tobytes()
        self._numbers += numbers.astype(self.types[1]).tobytes()
        self._ends.append(self._ends[-1] + len(ids))

    def __len__(self) -> int:
        return len(self._ends) - 1

    def flat(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts of the rows and the end of the last, ids, numbers); nothing may be appended
        while the arrays are in use."""
        return np.array(self._ends, np.int64), np.frombuffer(self._ids, self.types[0]), np.frombuffer(self._numbers, self.types[1])


def gathered(starts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the flat arrays of these rows, one row after the other, and the row's place
    among them for each."""
    lengths = starts[rows + 1] - starts[rows]
    row = np.repeat(np.arange(len(rows)), lengths)
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(rows) else 0) + np.repeat(starts[rows] - ends + lengths, lengths), row
