import numpy as np
import pytest
from pyspark.sql import functions as F

from geokernel.operators import ground, merging, mesh


def cloud(spark, points):
    return spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], "id long, x double, y double, z double")


def scene(rng):
    """Sloping ground, a building of 8 x 8 by 6 high, and points far above and below."""
    x, y = rng.uniform(0, 40, 4000), rng.uniform(0, 40, 4000)
    roof = (np.abs(x - 20) < 4) & (np.abs(y - 20) < 4)
    z = 0.05 * x + rng.normal(0, 0.03, 4000) + np.where(roof, 6.0, 0.0)
    stray = [(10.0, 10.0, -25.0), (30.0, 8.0, 40.0), (5.0, 35.0, -18.0)]
    return np.concatenate([np.stack([x, y, z], axis=1), stray]), roof


def test_buildings_and_strays_are_told_from_ground(spark):
    points, roof = scene(np.random.default_rng(1))
    found = {r["id"]: r["class"] for r in ground.classified(cloud(spark, points), 1.0).collect()}
    assert len(found) == 4003 and [found[k] for k in (4000, 4001, 4002)] == [ground.NOISE] * 3
    told = np.array([found[k] for k in range(4000)])
    judged = told != ground.NOISE
    assert judged.mean() > 0.95
    assert (told[judged & roof] == ground.OTHER).mean() > 0.97
    assert (told[judged & ~roof] == ground.GROUND).mean() > 0.99


def test_outliers_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    points = np.round(np.concatenate([rng.normal(0, 1, (150, 3)), rng.normal(0, 9, (6, 3)), [[0.5, 0.5, 0.5]] * 3]), 3)
    d = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2))
    np.fill_diagonal(d, np.inf)
    mean = np.sort(d, axis=1)[:, :8].mean(axis=1)
    most = mean.mean() + 2 * mean.std(ddof=1)
    got = {r["id"]: (r["mean"], r["outlier"]) for r in ground.outliers(cloud(spark, points)).collect()}
    assert got == {i: (pytest.approx(m), bool(m > most)) for i, m in enumerate(mean)}
    assert [tuple(r) for r in ground.outliers(cloud(spark, [(1, 2, 3)])).collect()] == [(0, None, False)]


def test_ground_below_objects_comes_from_the_nearest_and_has_a_slope(spark):
    cells = spark.createDataFrame([(0, c, 0.4 * c, c == 2) for c in range(5)] + [(1, 0, 1.0, False)], "r long, c long, v double, object boolean")
    got = {(r["r"], r["c"]): (round(r["v"], 9), round(r["steep"], 9)) for r in ground.ground_surface(cells, 2.0).collect()}
    assert got[0, 2] == (0.4, pytest.approx(0.2)) and got[0, 4] == (1.6, pytest.approx(0.2))
    assert got[0, 0] == (0.0, pytest.approx(round(float(np.hypot(0.5, 0.2)), 9))) and got[1, 0] == (1.0, pytest.approx(0.5))


def tiles(spark, wobble=2e-4):
    """A strip of 6 x 2 squares of two triangles, held by two tiles that overlap by a square."""
    vid = lambda i, j: 10 * i + j
    vertices, faces = [], []
    for tile, columns in ((0, range(0, 4)), (1, range(2, 6))):
        for i in range(columns[0], columns[-1] + 2):
            vertices += [(tile, vid(i, j), float(i) + wobble * tile, float(j), 0.0) for j in range(3)]
        for i in columns:
            for j in range(2):
                fid = 100 * i + 10 * j
                faces += [(tile, fid, vid(i, j), vid(i + 1, j), vid(i, j + 1), j), (tile, fid + 1, vid(i + 1, j), vid(i + 1, j + 1), vid(i, j + 1), j)]
    bounds = spark.createDataFrame([(0, 0.0, 0.0, 3.0, 2.0), (1, 3.0, 0.0, 6.0, 2.0)], "tile int, x0 double, y0 double, x1 double, y1 double")
    pages = spark.createDataFrame([(0, 0, "a/p.ppm"), (0, 1, "a/q.ppm"), (1, 0, "b/p.ppm"), (1, 1, "b/q.ppm"), (1, 2, None)], "tile int, slot int, page string")
    return spark.createDataFrame(vertices, "tile int, vid int, x double, y double, z double"), spark.createDataFrame(faces, "tile int, fid int, v0 int, v1 int, v2 int, slot int"), bounds, pages


def test_tiles_meet_without_cracks(spark):
    v, f, materials = merging.merged_tiles(*tiles(spark))
    assert (v.count(), f.count()) == (21, 24)
    assert sorted(r["vid"] for r in v.collect()) == list(range(21))
    assert merging.boundary_edges(f).count() == 16  # around the strip, and nowhere else
    assert sorted(map(tuple, materials.collect())) == [("0_mat0", "0_p.ppm"), ("0_mat1", "0_q.ppm"), ("1_mat0", "1_p.ppm"), ("1_mat1", "1_q.ppm")]
    area = mesh.with_measures(mesh.triangles(v, f)).agg(F.sum("area")).first()[0]
    assert area == pytest.approx(12, abs=1e-2)
    apart, _, _ = merging.merged_tiles(*tiles(spark, wobble=0.01))
    assert apart.count() == 24  # further away than the tolerance: two edges


def test_faces_without_a_page_or_outside_go(spark):
    v, f, bounds, pages = tiles(spark)
    _, kept, materials = merging.merged_tiles(v, f, bounds, pages.filter("NOT (tile = 0 AND slot = 1)"))
    assert kept.count() == 18 and materials.count() == 3
    with pytest.raises(ValueError, match="no face"):
        merging.merged_tiles(v, f, bounds.withColumn("x1", F.col("x0")), pages)
