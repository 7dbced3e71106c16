from pyspark.sql import functions as F

from geokernel.operators import tiling
from geokernel.plans import catalogue

SF = "/root/testdata/sf0.001"


def test_all_pairs_are_dealt_by_blocks(spark, monkeypatch):
    monkeypatch.setattr(tiling, "BLOCK_ROWS", 7)
    a, b, places = tiling.block_pairs(spark.range(40).select(F.col("id").alias("m")), "m")
    a, b = a.alias("a"), b.alias("b")
    got = a.join(b, [F.col(f"a.{c}") == F.col(f"b.{c}") for c in places]).select(F.col("a.m").alias("a"), F.col("b.m").alias("b"))
    assert sorted(tuple(r) for r in got.collect()) == [(i, j) for i in range(40) for j in range(40)]
    plan = catalogue.marker_pair_distances(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "NestedLoop" not in plan


def test_unequal_rows_are_found_by_one_grouping(spark):
    got = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "tile long, name string")
    wanted = spark.createDataFrame([("a", 1), ("b", 1), ("b", 1), (None, 2)], "name string, tile long")
    found = tiling.unequal(got, wanted)
    assert [tuple(r) for r in found.collect()] == [(1, "b", "missing")]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1
    back = tiling.unequal(wanted, got)
    assert [tuple(r) for r in back.collect()] == [("b", 1, "extra")]
