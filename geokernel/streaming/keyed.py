"""Streams with state by key: what a key needs of its past is kept for it alone, so a batch reads
and writes the state of the keys that it brings and of no others. State lives in the checkpoint
of the stream; a restarted stream goes on from there.

Sources deliver at least once. Each processor is written so that rows which arrive again change
nothing, whichever batch they come in."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from geokernel.operators.tables import shared_path

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_keyed_state(spark: SparkSession) -> None:
    """Streams with state by key need this store of state; it has to be set before they start."""
    spark.conf.set(_PROVIDER, _ROCKS)


class _Heaviest(StatefulProcessor):
    """The k heaviest members of each group, ties by the lower member, repeated members by their
    largest weight; a row for each group that a batch changes."""

    def __init__(self, group: str, member: str, weight: str, member_type: str, k: int, ttl_ms: int | None):
        self.names, self.member_type, self.k, self.ttl_ms = (group, member, weight), member_type, k, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getValueState("kept", f"members array<{self.member_type}>, weights array<double>", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        group, member, weight = self.names
        kept = self.kept.get()  # one question to the store: none is there yet if it is None
        before = dict(zip(*kept, strict=True)) if kept is not None else {}
        best = dict(before)
        for row in rows:
            if row[weight] is not None and (row[member] not in best or best[row[member]] < row[weight]):
                best[row[member]] = row[weight]
        top = sorted(best.items(), key=lambda x: (-x[1], x[0]))[: self.k]
        if dict(top) != before:
            members, weights = [m for m, _ in top], [float(w) for _, w in top]
            self.kept.update((members, weights))
            yield Row(**{group: key[0], "members": members, "weights": weights})

    def close(self) -> None:
        pass


def running_top_k(stream: DataFrame, group: str, member: str, weight: str, k: int = 4, ttl_ms: int | None = None) -> DataFrame:
    """(group, members, weights) of the groups whose k heaviest members a batch changes, heaviest
    first. The last row of a group is its state. With ttl_ms, groups that no row has changed for so
    long are forgotten. Output mode update."""
    kinds = dict(stream.dtypes)
    schema = f"{group} {kinds[group]}, members array<{kinds[member]}>, weights array<double>"
    return stream.groupBy(group).transformWithState(_Heaviest(group, member, weight, kinds[member], k, ttl_ms), schema, "Update", "None")


STARTED, DONE, LOST = "started", "done", "lost"


class _Ledger(StatefulProcessor):
    """The first attempt that ends a tile counts. A started attempt holds a lease in event time;
    when it runs out before the tile is done, the tile is reported lost."""

    def __init__(self, lease_ms: int):
        self.lease_ms = lease_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", "status string, attempt string, deadline long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        status, attempt, deadline = self.state.get() if self.state.exists() else (None, None, None)
        if status == DONE:
            return
        for row in sorted(rows, key=lambda r: (r["ms"], r["attempt"], r["status"] != STARTED)):
            if row["status"] == DONE:
                if deadline is not None:
                    self.handle.deleteTimer(deadline)
                self.state.update((DONE, row["attempt"], None))
                yield Row(tile=key[0], attempt=row["attempt"], status=DONE, ms=row["ms"])
                return
            until = row["ms"] + self.lease_ms
            if row["status"] == STARTED and until > timerValues.getCurrentWatermarkInMs() and (deadline is None or until > deadline):
                if deadline is not None:
                    self.handle.deleteTimer(deadline)
                status, attempt, deadline = STARTED, row["attempt"], until
                self.handle.registerTimer(deadline)
        if status is not None:
            self.state.update((status, attempt, deadline))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        status, attempt, deadline = self.state.get()
        if status == STARTED and expiredTimerInfo.getExpiryTimeInMs() == deadline:
            self.state.update((LOST, attempt, None))
            yield Row(tile=key[0], attempt=attempt, status=LOST, ms=deadline)

    def close(self) -> None:
        pass


def tile_ledger(stream: DataFrame, lease_ms: int = 3_600_000, late: str = "10 minutes") -> DataFrame:
    """(tile, attempt, status, ms) from reports (tile, attempt, status, ts) of workers: a row "done"
    once for each tile, whatever is reported again or later, and a row "lost" for an attempt that
    started and did not end its tile within the lease. Output mode append."""
    timed = stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).withColumn("ms", F.unix_millis("ts"))
    return timed.groupBy("tile").transformWithState(_Ledger(lease_ms), f"tile {dict(stream.dtypes)['tile']}, attempt string, status string, ms long", "Append", "EventTime")


class _Epochs(StatefulProcessor):
    """Cells of arriving epochs beside the fixed reference; a cell that an epoch does not know has
    the value of the latest epoch before it that does."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.reference = handle.getValueState("reference", "v double")
        self.known = handle.getMapState("known", "epoch long", "v double")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        if initialState["v"] is not None:
            self.reference.update((float(initialState["v"]),))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        before = self.reference.get()[0] if self.reference.exists() else None
        for row in sorted(rows, key=lambda r: r["epoch"]):
            epoch = row["epoch"]
            if self.known.containsKey((epoch,)):
                continue
            self.known.updateValue((epoch,), (None if row["v"] is None else float(row["v"]),))
            now, carried = row["v"], False
            if now is None:
                earlier = [(e, v) for (e,), (v,) in self.known.iterator() if e < epoch and v is not None]
                now, carried = (max(earlier)[1], True) if earlier else (before, before is not None)
            yield Row(epoch=epoch, r=key[0], c=key[1], v=now, dz=None if now is None or before is None else now - before, carried=carried)

    def close(self) -> None:
        pass


def epoch_states(stream: DataFrame, reference: DataFrame) -> DataFrame:
    """(epoch, r, c, v, dz, carried) for cells (epoch, r, c, v) of arriving epochs: v, carried
    forward where it is null, and its difference from the reference (r, c, v).

    A cell of an epoch is reported once, with what is known when it arrives. The reference is
    read when the stream first starts and is state from then on. Output mode append."""
    first = reference.select(F.col("r").cast("long"), F.col("c").cast("long"), F.col("v").cast("double")).groupBy("r", "c")
    typed = stream.select(F.col("epoch").cast("long"), F.col("r").cast("long"), F.col("c").cast("long"), F.col("v").cast("double"))
    schema = "epoch long, r long, c long, v double, dz double, carried boolean"
    return typed.groupBy("r", "c").transformWithState(_Epochs(), schema, "Append", "None", initialState=first)


def run_to_table(result: DataFrame, mode: str, path: str | None = None) -> DataFrame:
    """Runs a stream over all that its source has now; its rows with the batch they came in.

    Batches are written below the path, each in a folder of its own that a batch which is
    delivered again replaces. A stream that goes on later is given the same path."""
    spark = result.sparkSession
    path = path or shared_path(spark, "stream")

    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/rows/batch={batch}")

    result.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in result.schema)
    return spark.read.schema(f"{schema}, batch long").parquet(f"{path}/rows")
