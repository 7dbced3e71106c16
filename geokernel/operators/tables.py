"""Tables in the folder that driver and executors share: results between the steps of a job."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder named by spark.checkpoint.dir.

    Where that is unset, a local session gets a folder of its own; a cluster is an error, since
    its machines would each write to their own disk."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str = "step", codec: str = "zstd") -> DataFrame:
    """df written once into the shared folder and read back, so that later stages survive lost
    executors without recomputing what came before."""
    path = shared_path(df.sparkSession, name)
    if _SCRATCH:
        _SCRATCH[-1].append(path)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Tables written inside the blocks of scratch that are open, the innermost last.
_SCRATCH: list[list[str]] = []
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """A block whose steps leave nothing behind: tables that written() makes inside are removed at its
    end, and the shuffle files of a query when it is done. Its tables must not be read afterwards."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    _SCRATCH.append([])
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
        for path in _SCRATCH.pop():
            remove(spark, path)


def dealt(df: DataFrame) -> DataFrame:
    """df as the side of a join that grows with the input: both sides are shuffled, whatever size
    their files suggest. Files of a few megabytes can hold millions of rows, which a broadcast
    would unpack in the driver's memory."""
    return df.hint("merge")


class Rounds:
    """The tables of an iteration. Once a round is written, the one before it is removed, so
    nothing but the newest may be read afterwards."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name, self.path = spark, name, None

    def write(self, df: DataFrame) -> DataFrame:
        before, self.path = self.path, shared_path(self.spark, self.name)
        df.write.option("compression", "zstd").parquet(self.path)
        if before:
            remove(self.spark, before)
        return self.spark.read.schema(df.schema).parquet(self.path)


def remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
