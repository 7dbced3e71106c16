"""Bounded state kept up to date from streams: top-k views, finished tiles, epochs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from geokernel.operators import topk
from geokernel.operators.tables import remove


class TopKState:
    """The k heaviest rows of each group over all batches so far, as a versioned table.

    A batch is merged into the version before it and written as its own version, so a batch
    that is delivered again writes the same version again. Versions that no batch can be merged
    into any more are removed; which one is newest is read off the folder, so a restarted driver
    goes on where the one before it ended."""

    def __init__(self, spark: SparkSession, path: str, schema: str, group: str, weight: str, tie: str, k: int = 4):
        self.spark, self.path, self.schema, self.spec = spark, path, schema, (group, weight, tie, k)

    def _version(self, batch: int) -> DataFrame:
        if batch < 0:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/batch={batch}")

    def versions(self) -> list[int]:
        """The finished versions, oldest first."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = place.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(place)] if fs.exists(place) else []
        done = [n for n in names if n.startswith("batch=") and fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{n}/_SUCCESS"))]
        return sorted(int(n.removeprefix("batch=")) for n in done)

    def merge(self, rows: DataFrame, batch: int) -> None:
        group, weight, tie, k = self.spec
        before = [v for v in self.versions() if v < batch]
        both = self._version(before[-1] if before else -1).unionByName(rows.select(*self._version(-1).columns))
        topk.top_k(both, group, weight, tie, k).drop("rank").write.mode("overwrite").parquet(f"{self.path}/batch={batch}")
        for old in before[:-1]:
            remove(self.spark, f"{self.path}/batch={old}")

    @property
    def last(self) -> int:
        """The newest finished version, -1 before the first."""
        return (self.versions() or [-1])[-1]

    def current(self) -> DataFrame:
        return self._version(self.last)

    def start(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        return stream.writeStream.foreachBatch(self.merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def finished_tiles(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Tile results (id, ...) written by tile; a tile that is done again replaces itself."""

    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("id").parquet(path)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def epoch_changes(stream: DataFrame, reference: DataFrame) -> DataFrame:
    """Cells (epoch, r, c, v) of arriving epochs beside the fixed reference: epoch, r, c, dz."""
    fixed = reference.select("r", "c", F.col("v").alias("before"))
    return stream.join(fixed, ["r", "c"]).select("epoch", "r", "c", (F.col("v") - F.col("before")).alias("dz"))


def windowed_means(stream: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Count and mean of observations (ts, image, logc) by image and event-time window."""
    timed = stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return timed.groupBy("image", F.window("ts", width)).agg(F.count("*").alias("n"), F.avg("logc").alias("mean"))
