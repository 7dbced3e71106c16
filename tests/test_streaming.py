from pyspark.sql import functions as F

from geokernel.operators import topk
from geokernel.sources import adapters as A
from geokernel.streaming.updates import TopKState, epoch_changes, finished_tiles, windowed_means

SF = "/root/testdata/sf0.001"
WEIGHTS = "pt long, image long, weight double"


def parts(spark, df, path, n):
    df.repartition(n).write.parquet(str(path))
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(path))


def test_running_top_k_equals_the_batch_one(spark, tmp_path):
    rows = A.observations(spark, SF).groupBy("pt", "image").agg(F.max("logc").alias("weight"))
    state = TopKState(spark, str(tmp_path / "state"), WEIGHTS, "pt", "weight", "image")
    state.start(parts(spark, rows, tmp_path / "in", 3), str(tmp_path / "check")).awaitTermination()
    want = topk.top_k(rows, "pt", "weight", "image").drop("rank")
    assert sorted(map(tuple, state.current().collect())) == sorted(map(tuple, want.select("pt", "image", "weight").collect()))
    before = sorted(map(tuple, state.current().collect()))
    state.merge(rows.limit(0), state.last)  # a batch delivered again takes its own place
    assert state.last == 2 and len(before) == want.count()


def test_tiles_done_twice_replace_themselves(spark, tmp_path):
    out = str(tmp_path / "out")
    first = spark.createDataFrame([("a", 1), ("b", 2)], "id string, n int")
    finished_tiles(parts(spark, first, tmp_path / "one", 1), out, str(tmp_path / "c1")).awaitTermination()
    again = spark.createDataFrame([("b", 3)], "id string, n int")
    finished_tiles(parts(spark, again, tmp_path / "two", 1), out, str(tmp_path / "c2")).awaitTermination()
    assert sorted((r.id, r.n) for r in spark.read.parquet(out).collect()) == [("a", 1), ("b", 3)]


def test_epochs_against_a_fixed_reference(spark, tmp_path):
    epochs = spark.createDataFrame([(1, 0, 0, 5.0), (1, 0, 1, 6.0), (2, 0, 0, 4.0)], "epoch int, r long, c long, v double")
    reference = spark.createDataFrame([(0, 0, 4.5)], "r long, c long, v double")
    stream = epoch_changes(parts(spark, epochs, tmp_path / "in", 2), reference)
    stream.writeStream.format("memory").queryName("epochs").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(map(tuple, spark.table("epochs").collect())) == [(1, 0, 0, 0.5), (2, 0, 0, -0.5)]


def test_windowed_means_equal_the_batch_ones(spark, tmp_path):
    rows = A.table(spark, SF, "events").select(F.col("ts").cast("timestamp").alias("ts"), F.col("user_id").alias("image"), F.col("value").alias("logc"))
    stream = windowed_means(parts(spark, rows.coalesce(1), tmp_path / "in", 1))
    stream.writeStream.outputMode("complete").format("memory").queryName("windows").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    want = rows.groupBy("image", F.window("ts", "1 hour")).agg(F.count("*").alias("n")).count()
    assert spark.table("windows").count() == want
