import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from geokernel.operators import imagery, mesh, neighbours, quantiles, stats, tiling

SCHEMA = "r long, c long, red int, green int, blue int, alpha int"


def picture(n=24, seed=0):
    rng = np.random.default_rng(seed)
    rgb = rng.integers(0, 256, (n, n, 3))
    alpha = np.where(rng.random((n, n)) < 0.1, 0, 255)
    return rgb, alpha


def frame(spark, rgb, alpha):
    return spark.createDataFrame([(r, c, *map(int, rgb[r, c]), int(alpha[r, c])) for r in range(len(rgb)) for c in range(len(rgb))], SCHEMA)


def back(df, n):
    out = np.zeros((n, n, 3), int)
    for p in df.collect():
        out[p.r, p.c] = p.red, p.green, p.blue
    return out


LUMA = np.array([0.299, 0.587, 0.114])


def smooth(lum, valid, sigma):
    reach = int(4 * sigma + 0.5)
    k = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    s, w = np.zeros_like(lum), np.zeros_like(lum)
    n = len(lum)
    for i in range(n):
        for j in range(n):
            for a in range(max(0, i - reach), min(n, i + reach + 1)):
                for b in range(max(0, j - reach), min(n, j + reach + 1)):
                    if valid[a, b]:
                        f = k[a - i + reach] * k[b - j + reach]
                        s[i, j] += f * lum[a, b]
                        w[i, j] += f
    return s / np.maximum(w, 1e-6)


def test_finishing_against_arrays(spark):
    rgb, alpha = picture()
    valid, df = alpha > 0, frame(spark, rgb, alpha)
    lum = rgb @ LUMA
    low = smooth(lum, valid, 1.5)
    got = imagery.tonal_variation(df, 1.0, 3.0).first()
    assert got.valid_px == valid.sum() and math.isclose(got.total_std, lum[valid].std(), rel_tol=1e-9) and math.isclose(got.lowfreq_std, low[valid].std(), rel_tol=1e-9)

    def near(df, want):
        out = back(df, 24)
        assert np.array_equal(out[~valid], rgb[~valid])
        # Truncation may differ where a product is a whole number but for rounding.
        assert np.abs(out[valid] - np.floor(np.clip(want, 0, 255))[valid]).max() <= 1 and (out[valid] != np.floor(np.clip(want, 0, 255))[valid]).mean() < 0.01

    means = rgb[valid].mean(axis=0)
    near(imagery.white_balanced(df), rgb * (means @ LUMA / means))
    near(imagery.flattened(df, 1.0, 0.7, 3.0), rgb * ((lum[valid].mean() / low) ** 0.7)[:, :, None])
    a, b = np.percentile(lum[valid], [1, 99])
    near(imagery.contrasted(df), rgb * (np.clip((lum - a) * 255 / (b - a), 0, 255) / np.maximum(lum, 1e-6))[:, :, None])
    same, steps = imagery.finished(df, 1.0)
    assert steps == [] and np.array_equal(back(same, 24), rgb)
    _, steps = imagery.finished(df, 1.0, "auto", 0.5, 0.1, 1.2)
    assert steps == ["white-balance", "flatten", "auto-contrast", "tone"]
    with pytest.raises(ValueError, match="unknown"):
        imagery.finished(df, 1.0, "sepia")


def test_finishing_without_data(spark):
    rgb, _ = picture(4)
    df = frame(spark, rgb, np.zeros((4, 4)))
    out, _ = imagery.finished(df, 1.0, "auto", 0.5, 0.1, 1.2)
    assert np.array_equal(back(out, 4), rgb)
    assert imagery.tonal_variation(df, 1.0).first().valid_px == 0
    assert imagery.finished(df.limit(0), 1.0, "auto", 0.5)[0].collect() == []


@pytest.mark.parametrize("kind", ["spread", "tied", "steps", "tiny", "wide"])
def test_quantiles_against_sorting(spark, kind, monkeypatch):
    monkeypatch.setattr(quantiles, "FEW", 50)
    monkeypatch.setattr(quantiles, "BINS", 16)
    rng = np.random.default_rng(1)
    values = {
        "spread": rng.normal(0, 10, 5000),
        "tied": np.where(rng.random(5000) < 0.6, 3.25, rng.normal(0, 1, 5000)),
        "steps": rng.integers(0, 3, 5000).astype(float),
        "tiny": 1.0 + np.arange(300) * 2.0**-52,
        "wide": rng.choice([-1e300, 0.0, 1e-300, 1e300], 400),
    }[kind]
    table = quantiles.values_of(spark.createDataFrame([(float(v),) for v in values] + [(None,), (math.nan,)], "x double"), F.col("x"))
    shares = [0.0, 0.01, 0.5, 0.95, 1.0]
    for got, want in zip(quantiles.quantiles(table, shares), np.quantile(values, shares), strict=True):
        assert math.isclose(got, want, rel_tol=1e-12, abs_tol=1e-12)
    mid, mad = quantiles.median_and_deviation(table)
    assert math.isclose(mad, np.median(np.abs(values - np.median(values))), rel_tol=1e-12, abs_tol=1e-12) and math.isclose(mid, np.median(values))


def test_quantiles_of_nothing(spark):
    empty = quantiles.values_of(spark.createDataFrame([(None,)], "x double"), F.col("x"))
    assert quantiles.quantiles(empty, [0.5]) == [None] and quantiles.median_and_deviation(empty) == (None, None)
    nothing = spark.createDataFrame([], "id int, d double")
    assert stats.stable_mask(nothing).collect() == [] and neighbours.distance_summary(spark.createDataFrame([], "d2 double")).first().p95 is None


@pytest.mark.parametrize("n", [0, 1, 5, 6, 17, 100])
def test_check_points_are_evenly_spaced(spark, n):
    rows = [(i, float((i * 37) % 101), float((i * 37) % 101) * 0.5) for i in range(n)]
    got = {r.rid: r.is_check for r in stats.choose_check(spark.createDataFrame(rows, "rid int, x double, y double"), 0.3, "rid").collect()}
    order = sorted(range(n), key=lambda i: rows[i][1])
    inner = max(0, n - 2)
    wanted = min(max(1, round(0.3 * n)), n - 4, inner)
    picks = {order[int(inner / wanted * (i + 0.5)) + 1] for i in range(wanted)} if wanted > 0 else set()
    assert {i for i, c in got.items() if c} == picks and len(got) == n


def test_even_samples(spark):
    for n, target in ((0, 5), (3, 5), (10, 4), (1000, 77)):
        got = sorted(r.k for r in imagery.evenly_spaced(spark.createDataFrame([(i,) for i in range(n)], "k int"), "k", target).collect())
        want = list(range(n)) if n <= target else np.linspace(0, n - 1, target).astype(int).tolist()
        assert got == want


def test_views_see_what_is_in_their_frame(spark):
    rng = np.random.default_rng(5)
    points = np.column_stack([rng.uniform(-50, 50, (3000, 2)), rng.uniform(0, 3, 3000)])
    turn = lambda a: np.array([[1, 0, 0], [0, -math.cos(a), -math.sin(a)], [0, math.sin(a), -math.cos(a)]])
    views, want = [], {}
    for k, (x, y, z, a) in enumerate([(0, 0, 30, 0.0), (20, -10, 25, 0.4), (-45, 40, 30, 1.3), (0, 0, 2, 0.0), (500, 0, 30, 0.0)]):
        r = turn(a)
        t = -r @ [x, y, z]
        views.append((k, r.ravel().tolist(), t.tolist(), 400.0, 300.0, 200.0, 600, 400))
        p = points @ r.T + t
        u, v = 400 * p[:, 0] / p[:, 2] + 300, 400 * p[:, 1] / p[:, 2] + 200
        inside = (p[:, 2] > 1e-6) & (u >= 0) & (u < 600) & (v >= 0) & (v < 400)
        want |= {(k, i): np.linalg.norm(p[i]) for i in np.flatnonzero(inside).tolist()}
    views = spark.createDataFrame(views, "view int, r array<double>, t array<double>, f double, cx double, cy double, width int, height int")
    cloud = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], "pid long, x double, y double, z double")
    got = {(r.view, r.pid): r.distance for r in imagery.seen(views, cloud).collect()}
    assert set(got) == set(want) and all(math.isclose(got[k], want[k]) for k in want)
    medians = [np.median([d for (k, _), d in want.items() if k == view]) / 400 for view in range(5) if sum(k == view for k, _ in want) >= 20]
    assert math.isclose(imagery.native_gsd(views, cloud, 2.0).first().gsd, 2 * np.median(medians))
    assert imagery.native_gsd(views, cloud.limit(50)).first().gsd is None
    assert imagery.seen(views, cloud.limit(0)).collect() == []


def test_surface_samples_follow_area(spark):
    tri = spark.createDataFrame([(1, 0.0, 0.0, 0.0, 4.0, 0.0, 0.0, 0.0, 4.0, 0.0), (2, 10.0, 0.0, 1.0, 11.0, 0.0, 1.0, 10.0, 1.0, 1.0)], "fid long, x0 double, y0 double, z0 double, x1 double, y1 double, z1 double, x2 double, y2 double, z2 double")
    got = imagery.surface_samples(tri, 3400).collect()
    big = [r for r in got if r.fid == 1]
    assert abs(len(got) - 3400) <= 2 and abs(len(big) / len(got) - 16 / 17) < 0.001
    assert all(r.x >= 0 and r.y >= 0 and r.x + r.y <= 4 + 1e-9 for r in big) and abs(np.mean([r.x for r in big]) - 4 / 3) < 0.1
    assert imagery.surface_samples(tri, 3400).count() == len(got)


def test_large_triangles_are_rasterised_in_blocks(spark, monkeypatch):
    tri = spark.createDataFrame([(1, 0.0, 0.0, 0.0, 40.0, 0.0, 1.0, 0.0, 40.0, 2.0), (2, 1.0, 1.0, 5.0, 3.0, 1.0, 5.0, 1.0, 3.0, 5.0)], "fid long, x0 double, y0 double, z0 double, x1 double, y1 double, z1 double, x2 double, y2 double, z2 double")
    whole = sorted(mesh.fragments(tri, 1.0, 0.0, 40.0).collect())
    monkeypatch.setattr(mesh, "BLOCK_PIXELS", 7)
    assert sorted(mesh.fragments(tri, 1.0, 0.0, 40.0).collect()) == whole and len(whole) > 800


def test_subsets_and_their_check(spark):
    images = spark.createDataFrame([("a", 1), ("b", 2), ("c", 1)], "name string, camera_id int")
    cameras = spark.createDataFrame([(1,), (2,), (3,)], "camera_id int")
    members = spark.createDataFrame([("t", "a"), ("t", "c"), ("t", "a"), ("s", "b"), ("s", "z")], "tile string, name string")
    kept, used = tiling.subset_model(images, cameras, members)
    assert sorted((r.tile, r.name) for r in kept.collect()) == [("s", "b"), ("t", "a"), ("t", "c")]
    assert sorted((r.tile, r.camera_id) for r in used.collect()) == [("s", 2), ("t", 1)]
    assert [tuple(r) for r in tiling.unequal(kept.select("tile", "name"), members).collect()] == [("s", "z", "missing")]


@pytest.mark.parametrize("k", [1, 3])
def test_nearest_with_copies_and_clusters(spark, k):
    """A third of the points in one place, a dense cluster, a few far away: as by brute force."""
    rng = np.random.default_rng(2)
    p = np.concatenate([np.full((60, 3), 5.0), rng.normal(0, 0.01, (80, 3)), rng.uniform(-100, 100, (40, 3))])
    q = np.concatenate([rng.uniform(-120, 120, (30, 3)), p[:5], rng.normal(0, 0.02, (20, 3))])
    schema = "id long, x double, y double, z double"
    make = lambda a: spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(a)], schema)
    d2 = ((q[:, None] - p[None]) ** 2).sum(axis=2)
    want = {(i, r + 1): int(j) for i in range(len(q)) for r, j in enumerate(np.lexsort([np.arange(len(p)), d2[i]])[:k])}
    got = {(r.id, r.rank): r.other for r in neighbours.nearest(make(q), make(p), k=k).collect()}
    assert got == want
    own = ((p[:, None] - p[None]) ** 2).sum(axis=2)
    np.fill_diagonal(own, np.inf)
    want = {(i, r + 1): int(j) for i in range(len(p)) for r, j in enumerate(np.lexsort([np.arange(len(p)), own[i]])[:k])}
    got = {(r.id, r.rank): r.other for r in neighbours.nearest(make(p), make(p), k=k, exclude_self=True).collect()}
    assert got == want
