import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from geokernel.operators import change, radiometry

OBS = "image int, pt int, red double, green double, blue double, x double, y double"


def basis(x, y):
    return np.array([x, y, x * x, x * y, y * y])


def test_gains_and_fields_are_recovered(spark):
    """Planted gains and fields come back; images by the rules of how many observations they have."""
    rng = np.random.default_rng(1)
    gain = rng.normal(0, 0.2, (6, 3))
    field = rng.normal(0, 0.12, (6, 5))
    field[4:] = 0
    light = rng.uniform(3, 4.5, (300, 3))
    rows, places = [], [[] for _ in range(6)]
    for i, n in enumerate((280, 260, 250, 240, 90, 12)):
        for p in rng.permutation(300)[:n]:
            x, y = rng.uniform(-1, 1, 2)
            places[i].append(basis(x, y))
            rows.append((i, int(p), gain[i] + light[p] + places[i][-1] @ field[i] + rng.normal(0, 0.002, 3), x, y))
    mean = np.array([np.mean(b, axis=0) for b in places])
    # What is constant in a field belongs to the gain, and the point lights are free to a constant.
    true = gain + (mean * field).sum(axis=1)[:, None]
    true -= true[:5].mean(axis=0)
    table = spark.createDataFrame([(i, p, *map(float, np.exp(c)), float(x), float(y)) for i, p, c, x, y in rows], OBS)
    solved = radiometry.photometric_solve(table)
    found = {r["image"]: r for r in solved.collect()}
    for i in range(5):
        assert np.abs(np.array([found[i][f"g_{b}"] for b in radiometry.BANDS]) - true[i]).max() < 0.02
    # A ridge of a thousandth of the observations shrinks the fields a little.
    seen = np.array([[found[i][f"c{k}"] for k in range(5)] for i in range(6)])
    fields = seen - seen[:4].mean(axis=0) - (field - field[:4].mean(axis=0))
    assert np.abs(fields[:4]).max() < 0.05
    assert not seen[4:].any() and [found[5][f"g_{b}"] for b in radiometry.BANDS] == [0, 0, 0]
    assert {i: r["n"] for i, r in found.items()} == {0: 280, 1: 260, 2: 250, 3: 240, 4: 90, 5: 12}

    spread = lambda df: df.groupBy("pt").agg(F.stddev_pop(F.log("red")).alias("s"), F.count("*").alias("n")).filter("n > 2").agg(F.avg("s")).first()[0]
    kept = table.filter("image < 5")
    assert spread(radiometry.photometric_corrected(kept, solved)) < 0.15 * spread(kept)
    unknown = table.limit(1).withColumn("image", F.lit(77))
    assert radiometry.photometric_corrected(unknown, solved).first() == unknown.first()


def test_one_round_equals_a_dense_solve(spark):
    rng = np.random.default_rng(2)
    rows = [(i, p, *map(float, rng.uniform(0.2, 250, 3)), *map(float, rng.uniform(-1, 1, 2))) for i in range(3) for p in range(130)]
    found = {r["image"]: r for r in radiometry.photometric_solve(spark.createDataFrame(rows, OBS), rounds=1).collect()}
    logs = np.log(np.maximum([r[2:5] for r in rows], 1)).reshape(3, 130, 3)
    rest = logs - logs.mean(axis=0)
    gains = rest.mean(axis=1)
    gains -= gains.mean(axis=0)
    for i in range(3):
        b = np.array([basis(*r[5:]) for r in rows if r[0] == i])
        b = b - b.mean(axis=0)
        c = np.linalg.solve(b.T @ b + 130e-3 * np.eye(5), b.T @ rest[i].mean(axis=1))
        assert np.allclose([found[i][f"c{k}"] for k in range(5)], c, atol=1e-9)
        assert np.allclose([found[i][f"g_{x}"] for x in radiometry.BANDS], gains[i], atol=1e-9)


def test_levelling_solves_the_system(spark):
    rng = np.random.default_rng(3)
    n = 40
    links = [(i, i + 1) for i in range(n - 3)] + [(i, (i * 7 + 5) % (n - 3)) for i in range(0, n - 3, 3)] + [(n - 2, n - 1), (4, 4)]
    data = {i: [float(v) for v in rng.normal(0, 20, 2)] for i in range(0, n - 3, 5)}
    data[5][1] = None
    nodes = [(i, *data.get(i, [None, None])) for i in range(n)]
    found, residuals = radiometry.levelled(spark.createDataFrame(nodes, "node int, a double, b double"), spark.createDataFrame(links + links[:5], "a int, b int"), ("a", "b"), tolerance=1e-9)
    got = {r["node"]: (r["a"], r["b"]) for r in found.collect()}
    lap = np.zeros((n, n))
    for i, j in {(min(p), max(p)) for p in links if p[0] != p[1]}:
        lap[[i, j], [i, j]] += 1
        lap[[i, j], [j, i]] -= 1
    for band in (0, 1):
        d = np.array([float(i in data and data[i][band] is not None) for i in range(n)])
        b = np.array([(data[i][band] or 0.0) if i in data else 0.0 for i in range(n)])
        # The pair that no data reaches has no unique solution and stays 0.
        want = np.append(np.linalg.solve((np.diag(d) + 0.15 * lap)[: n - 2, : n - 2], b[: n - 2]), [0, 0])
        assert np.allclose([got[i][band] for i in range(n)], want, atol=1e-6)
    assert residuals[-1]["a"] <= 1e-9 and len(residuals) <= n
    clipped, _ = radiometry.levelled(spark.createDataFrame([(1, 500.0), (2, None)], "node int, a double"), spark.createDataFrame([(1, 2)], "a int, b int"), ("a",))
    assert [r["a"] for r in clipped.orderBy("node").collect()] == [60.0, 60.0]
    flat, none = radiometry.levelled(spark.createDataFrame([(1, None)], "node int, a double"), spark.createDataFrame([], "a int, b int"), ("a",))
    assert flat.first()["a"] == 0.0 and none == []


def cloud(spark, points):
    return spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], "id int, x double, y double, z double")


def slope(rng, n, lift=0.0):
    """Points on a plane that rises at 45 degrees along x, lifted along its normal where x > 5."""
    x, y = rng.uniform(0, 10, n), rng.uniform(0, 6, n)
    up = np.array([-1, 0, 1]) / math.sqrt(2)
    return np.stack([x, y, x], axis=1) + (rng.normal(0, 0.01, n) + lift * (x > 5))[:, None] * up


def brute_change(core, normal, before, after, radius, depth):
    places = []
    for c in (before, after):
        d = c - core
        h = d @ normal
        inside = (np.abs(h) <= depth) & ((d * d).sum(axis=1) - h * h <= radius**2)
        places.append(h[inside])
    if not all(map(len, places)):
        return None, None
    return places[1].mean() - places[0].mean(), 1.96 * (math.sqrt(sum(p.var() / len(p) for p in places)) + 0.01)


def test_slanted_change_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    before, after = slope(rng, 3000), slope(rng, 3000, 0.8)
    core = np.concatenate([after[::60], [[100.0, 100.0, 100.0]]])
    normals = {r["id"]: np.array([r["nx"], r["ny"], r["nz"]]) for r in change.normals(cloud(spark, core), cloud(spark, before), (0.5, 1.0, 2.0)).collect()}
    assert 50 not in normals and len(normals) == 50
    assert min(v @ [-1, 0, 1] / math.sqrt(2) for v in normals.values()) > 0.99
    for i in range(0, 50, 7):
        best = None
        for r in (0.5, 1.0, 2.0):
            near = before[((before - core[i]) ** 2).sum(axis=1) <= r * r]
            if len(near) >= 3:
                values, vectors = np.linalg.eigh(np.cov(near.T, bias=True))
                planar = (values[1] - values[0]) / values[2]
                best = max(best or (-1, None), (planar, vectors[:, 0] * np.sign(vectors[2, 0])), key=lambda x: x[0])
        assert np.allclose(normals[i], best[1], atol=1e-6)
    found = {r["id"]: r for r in change.m3c2_surveyed(cloud(spark, core), cloud(spark, before), cloud(spark, after), 0.5, depth=6.0, registration_error=0.01).collect()}
    for i, n in normals.items():
        distance, lod = brute_change(core[i], n, before, after, 0.5, 6.0)
        assert found[i]["distance"] == pytest.approx(distance, abs=1e-9) and found[i]["lod"] == pytest.approx(lod, abs=1e-9)
        assert abs(distance - (0.8 if core[i][0] > 6 else 0.0)) < 0.05 or 4 < core[i][0] <= 6
        assert found[i]["significant"] == (abs(distance) > lod)
    assert (found[50]["distance"], found[50]["lod"], found[50]["significant"]) == (None, None, False)


def test_points_on_a_line_have_no_normal(spark):
    line = cloud(spark, [(t, 2 * t, 0) for t in range(5)])
    assert change.normals(line, line, (10.0,)).count() == 0
    same = cloud(spark, [(1, 1, 1)] * 5)
    assert change.normals(same, same, (1.0,)).count() == 0
