import numpy as np
import pandas as pd

from geokernel.operators import change, tiles


def cloud(spark, p):
    return spark.createDataFrame([(i, *map(float, row)) for i, row in enumerate(p)], "id long, x double, y double, z double")


def test_sums_of_dealt_tiles_are_those_of_all_pairs(spark, monkeypatch):
    rng = np.random.default_rng(3)
    q, p = rng.integers(0, 640, (150, 3)) / 64, rng.integers(0, 640, (900, 3)) / 64
    monkeypatch.setattr(tiles, "MOST_QUERIES", 20)
    monkeypatch.setattr(tiles, "MOST_POINTS", 70)
    monkeypatch.setattr(tiles, "PARTITION_ROWS", 20)

    def kernel(queries, points):
        a, b = queries[["x", "y", "z"]].to_numpy(), points[["x", "y", "z"]].to_numpy()
        out = np.zeros(len(a))
        for rows, near in tiles.blocks(a[:, :2], a[:, :2] - 1.5, a[:, :2] + 1.5, b, 0.5):
            out[rows] += (((a[rows, None] - b[near]) ** 2).sum(axis=2) <= 2.25).sum(axis=1)
        return pd.DataFrame({"id": queries["id"], "n": out})

    got = {r["id"]: r["n"] for r in tiles.tile_sums(cloud(spark, q), cloud(spark, p), 1.5, kernel, "id long, n double").collect()}
    want = (((q[:, None] - p) ** 2).sum(axis=2) <= 2.25).sum(axis=1)
    assert all(got.get(i, 0) == n for i, n in enumerate(want)) and want.max() > 3


def test_change_of_clouds_makes_no_rows_of_pairs(spark):
    rng = np.random.default_rng(4)
    p = cloud(spark, rng.integers(0, 1024, (2000, 3)) / 1024 + np.array([0, 0, 5.0]))
    for found in (change.normals(p, p, (0.25, 0.5)), change.m3c2(p, p, p, 0.5, 3.0)):
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "cell_x" not in plan and found.count() == 2000


def test_cylinders_leave_out_places_that_are_not_finite(spark):
    p = cloud(spark, [(0, 0, 1), (0, 0, 2), (0, 0, float("nan"))])
    core = cloud(spark, [(0, 0, 0)])
    assert change.m3c2(core, p, p, 1.0, 5.0).first()["distance"] == 0.0
