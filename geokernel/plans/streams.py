"""Queries that run a stream with state by key over a whole table and return what it leaves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geokernel.operators.tables import shared_path
from geokernel.plans.catalogue import query
from geokernel.sources import adapters as A
from geokernel.sources.adapters import with_views
from geokernel.streaming import keyed


#: Rows of a file that arrives.
FILE_ROWS = 2_000_000


def _arriving(parts: list[DataFrame], key: str | None = None) -> DataFrame:
    """The parts as a stream of the shared folder, one after the other: each is a file, or several
    in the order they were written, and so come in this order.

    The rows of a part that share the key come in one file, so a part reads and writes the state of
    a key once, however many batches its files make."""
    spark, path = parts[0].sparkSession, shared_path(parts[0].sparkSession, "arriving")
    keyed.use_keyed_state(spark)
    for part in parts:
        if key is not None:
            part = part.repartition(1 + part.count() // FILE_ROWS, key)
        part.write.mode("append").parquet(path)
    return spark.readStream.schema(parts[0].schema).option("maxFilesPerTrigger", 4).parquet(path)


@query("""WITH w AS (SELECT l_partkey AS pt, l_suppkey AS image, max(CAST(floor(l_extendedprice) AS DOUBLE) / 8) AS weight FROM lineitem GROUP BY 1, 2)
SELECT pt, image, weight FROM (SELECT *, row_number() OVER (PARTITION BY pt ORDER BY weight DESC, image) AS k FROM w) WHERE k <= 4""")
def streamed_top_views(spark: SparkSession, d: str) -> DataFrame:
    """The four heaviest views of each part, kept by key as line items arrive."""
    rows = A.table(spark, d, "lineitem").select(F.col("l_partkey").alias("pt"), F.col("l_suppkey").alias("image"), (F.floor("l_extendedprice") / F.lit(8.0)).alias("weight"))
    states = keyed.run_to_table(keyed.running_top_k(_arriving([rows.filter(F.col("image") % 3 == k) for k in range(3)], "pt"), "pt", "image", "weight"), "update")
    last = states.groupBy("pt").agg(F.max_by(F.struct("members", "weights"), "batch").alias("s"))
    return last.select("pt", F.inline(F.arrays_zip(F.col("s.members").alias("image"), F.col("s.weights").alias("weight"))))


_REPORTS = "reports AS (SELECT user_id AS tile, CAST(event_id AS VARCHAR) AS attempt, event_id % 3 = 0 AS done, epoch_us(CAST(ts AS TIMESTAMP)) // 1000 AS ms FROM events)"


@query(f"WITH {_REPORTS} SELECT tile, attempt, 'done' AS status, ms FROM (SELECT *, row_number() OVER (PARTITION BY tile ORDER BY ms, attempt) AS k FROM reports WHERE done) WHERE k = 1")
def streamed_tiles(spark: SparkSession, d: str) -> DataFrame:
    """Tiles of users: each event reports an attempt, every third of them as done. A tile is done
    once, by its first attempt."""
    e = A.table(spark, d, "events")
    status = F.when(F.col("event_id") % 3 == 0, keyed.DONE).otherwise(keyed.STARTED)
    reports = e.select(F.col("user_id").alias("tile"), F.col("event_id").cast("string").alias("attempt"), status.alias("status"), F.col("ts").cast("timestamp").alias("ts"))
    low, high = (F.lit(x) for x in reports.agg(F.min("ts"), F.max("ts")).first())
    third = F.least(F.lit(2), F.floor(3 * (F.unix_micros("ts") - F.unix_micros(low)) / (F.unix_micros(high) - F.unix_micros(low) + 1)))
    found = keyed.run_to_table(keyed.tile_ledger(_arriving([reports.filter(third == k) for k in range(3)]), lease_ms=10**13), "append")
    return found.filter(F.col("status") == keyed.DONE).select("tile", "attempt", "status", "ms")


_CELLS = """cells AS (SELECT CAST(month(ts) AS BIGINT) AS epoch, day(ts) - 1 AS r, hour(ts) AS c, max(CASE WHEN event_id % 4 > 0 THEN floor(value * 128) / 128 END) AS v FROM events GROUP BY ALL)"""


@query(
    with_views(
        f"""{_CELLS}, known AS (SELECT c.*, last_value(c.v IGNORE NULLS) OVER (PARTITION BY r, c ORDER BY epoch) AS held FROM cells c)
SELECT epoch, k.r, k.c, coalesce(k.held, a.v) AS v, coalesce(k.held, a.v) - a.v AS dz, k.v IS NULL AND coalesce(k.held, a.v) IS NOT NULL AS carried FROM known k LEFT JOIN rast_a a ON a.r = k.r AND a.c = k.c""",
        "rast_a",
    )
)
def streamed_epochs(spark: SparkSession, d: str) -> DataFrame:
    """Months as epochs of cells (day, hour), beside the raster of even users as the reference."""
    e = A.table(spark, d, "events")
    cells = e.groupBy(F.month("ts").cast("long").alias("epoch"), (F.dayofmonth("ts") - 1).cast("long").alias("r"), F.hour("ts").cast("long").alias("c")).agg(F.max(F.when(F.col("event_id") % 4 > 0, F.floor(F.col("value") * 128) / F.lit(128.0))).alias("v"))
    # An epoch arrives whole, after those before it.
    stream = _arriving([cells.filter(F.col("epoch") == k) for k in range(1, 13)])
    found = keyed.run_to_table(keyed.epoch_states(stream, A.raster(spark, d, 0)), "append")
    return found.select("epoch", "r", "c", "v", "dz", "carried")
