import random

import pytest
from pyspark.sql import functions as F

from geokernel.operators import topk
from geokernel.streaming import keyed


@pytest.fixture()
def source(spark, tmp_path):
    """A folder that files of rows are added to, and a stream of it, a file a batch."""
    keyed.use_keyed_state(spark)

    class Source:
        def __init__(self, schema):
            self.schema, self.n = schema, 0

        def add(self, rows):
            spark.createDataFrame(rows, self.schema).coalesce(1).write.parquet(f"{tmp_path}/in/{self.n:03d}")
            self.n += 1

        def stream(self):
            return spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")

    return Source


def test_top_k_over_restarts_and_redelivery(spark, source, tmp_path):
    rng = random.Random(1)
    rows = [(rng.randrange(12), rng.randrange(40), float(rng.randrange(60))) for _ in range(400)] + [(3, 1, None)]
    s = source("pt int, image int, weight double")
    run = lambda: keyed.run_to_table(keyed.running_top_k(s.stream(), "pt", "image", "weight", 3), "update", f"{tmp_path}/out")
    s.add(rows[:150])
    s.add(rows[150:250])
    run()
    s.add(rows[100:250])  # again
    s.add(rows[250:])
    states = run()  # a restarted stream goes on
    last = states.groupBy("pt").agg(F.max_by(F.struct("members", "weights"), "batch").alias("s")).collect()
    table = spark.createDataFrame(rows, s.schema).groupBy("pt", "image").agg(F.max("weight").alias("weight")).filter("weight IS NOT NULL")
    want = {}
    for r in topk.top_k(table, "pt", "weight", "image", 3).orderBy("pt", "rank").collect():
        want.setdefault(r["pt"], []).append((r["image"], r["weight"]))
    assert {r["pt"]: list(zip(r["s"]["members"], r["s"]["weights"], strict=True)) for r in last} == want
    assert states.filter("batch = 2").count() == 0  # nothing new, nothing said


def test_only_keys_of_a_batch_are_touched(spark, source, tmp_path):
    s = source("pt int, image int, weight double")
    s.add([(k, 1, 1.0) for k in range(50)])
    s.add([(7, 2, 2.0), (60, 1, 1.0), (8, 3, 0.5)])
    states = keyed.run_to_table(keyed.running_top_k(s.stream(), "pt", "image", "weight", 1), "update", f"{tmp_path}/out")
    assert {r["pt"]: r["members"] for r in states.filter("batch = 1").collect()} == {7: [2], 60: [1]}


def test_tiles_are_done_once_and_leases_run_out(spark, source, tmp_path):
    s = source("tile string, attempt string, status string, ts timestamp")
    at = lambda minutes: F.timestamp_seconds(F.lit(1_700_000_000 + 60 * minutes))
    when = {m: spark.range(1).select(at(m)).first()[0] for m in (0, 5, 20, 30, 90, 200, 400, 500)}
    s.add([("a", "1", "started", when[0]), ("b", "1", "started", when[0]), ("c", "1", "started", when[5])])
    s.add([("a", "1", "done", when[20]), ("a", "2", "started", when[20]), ("c", "2", "started", when[30])])
    s.add([("a", "2", "done", when[30]), ("a", "1", "done", when[20]), ("z", "1", "started", when[90])])
    run = lambda: keyed.run_to_table(keyed.tile_ledger(s.stream(), 60 * 60_000, "1 minute"), "append", f"{tmp_path}/out")
    run()
    s.add([("c", "2", "done", when[200]), ("y", "1", "started", when[400])])
    s.add([("b", "2", "started", when[500])])
    found = sorted((r["tile"], r["attempt"], r["status"]) for r in run().collect())
    # b's and c's leases run out; c is done late all the same, a once.
    assert [f for f in found if f[2] == "done"] == [("a", "1", "done"), ("c", "2", "done")]
    assert {("b", "1", "lost"), ("z", "1", "lost")} <= set(found) and not any(f[0] == "a" and f[2] == "lost" for f in found)
    assert len(found) == len(set(found))


def test_epochs_carry_forward_beside_the_reference(spark, source, tmp_path):
    s = source("epoch long, r long, c long, v double")
    reference = spark.createDataFrame([(0, 0, 5.0), (0, 1, 2.0), (1, 1, 9.0)], "r int, c int, v double")
    s.add([(1, 0, 0, 6.0), (1, 0, 1, None), (1, 9, 9, 4.0), (1, 8, 8, None)])
    s.add([(2, 0, 0, None), (1, 0, 0, 77.0), (2, 0, 1, 3.0)])
    run = lambda: keyed.run_to_table(keyed.epoch_states(s.stream(), reference), "append", f"{tmp_path}/out")
    run()
    s.add([(4, 0, 0, 8.0), (3, 0, 0, None), (3, 0, 1, None)])
    got = {(r["epoch"], r["r"], r["c"]): (r["v"], r["dz"], r["carried"]) for r in run().collect()}
    assert got == {
        (1, 0, 0): (6.0, 1.0, False), (1, 0, 1): (2.0, 0.0, True), (1, 9, 9): (4.0, None, False), (1, 8, 8): (None, None, False),
        (2, 0, 0): (6.0, 1.0, True), (2, 0, 1): (3.0, 1.0, False), (3, 0, 0): (6.0, 1.0, True), (3, 0, 1): (3.0, 1.0, True), (4, 0, 0): (8.0, 3.0, False),
    }
