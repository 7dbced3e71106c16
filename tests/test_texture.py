import numpy as np
import pytest
from pyspark.sql import functions as F

from geokernel.operators import mesh, quantiles, texture

DOWN = [1.0, 0.0, 0.0, 0.0, -1.0, 0.0, 0.0, 0.0, -1.0]


def views_of(spark, centres, f=50.0, width=60.0, height=40.0):
    """Cameras that look straight down."""
    rows = [(name, DOWN, [-x, y, z], f, width / 2, height / 2, width, height) for name, x, y, z in centres]
    return spark.createDataFrame(rows, "view string, r array<double>, t array<double>, f double, cx double, cy double, width double, height double")


def sheet(first, x0, y0, x1, y1, z, n=6):
    """A square of 2 n n triangles that faces up: vertices and faces."""
    xs, ys = np.linspace(x0, x1, n + 1), np.linspace(y0, y1, n + 1)
    at = lambda i, j: first + i * (n + 1) + j
    v = [(at(i, j), float(xs[i]), float(ys[j]), float(z)) for i in range(n + 1) for j in range(n + 1)]
    f = []
    for i in range(n):
        for j in range(n):
            f += [(at(i, j), at(i + 1, j), at(i, j + 1)), (at(i + 1, j), at(i + 1, j + 1), at(i, j + 1))]
    return v, f


def triangles(spark, *sheets):
    v = [x for s in sheets for x in s[0]]
    f = [(k, *x) for k, x in enumerate(x for s in sheets for x in s[1])]
    return mesh.triangles(spark.createDataFrame(v, "vid int, x double, y double, z double"), spark.createDataFrame(f, "fid int, v0 int, v1 int, v2 int")), v, f


def pixmap(image):
    h, w = image.shape[:2]
    return bytearray(b"P6\n# made here\n%d %d\n255\n" % (w, h) + image.tobytes())


def test_what_lies_behind_is_not_seen(spark):
    low, roof = sheet(0, 0, 0, 4, 4, 0.0), sheet(100, 1, 1, 3, 3, 2.0)
    tri, v, f = triangles(spark, low, roof)
    seen = texture.face_views(tri, views_of(spark, [("above", 2.0, 2.0, 10.0), ("beside", 6.0, 2.0, 10.0)], f=40.0, width=120.0, height=120.0))
    got = {(r["fid"], r["view"]) for r in seen.collect()}
    xyz = {i: np.array(p) for i, *p in v}
    middle = {k: np.mean([xyz[i] for i in c], axis=0) for k, *c in f}
    roofs = {k for k, m in middle.items() if m[2] > 1}
    assert {(k, "above") for k in roofs} <= got and {(k, "beside") for k in roofs} <= got
    # Seen from 10 up, the roof at 2 covers 1.25 times its own extent below; from the side it is shifted.
    for k in set(middle) - roofs:
        x, y, _ = middle[k]
        if max(abs(x - 2), abs(y - 2)) < 1.0:
            assert (k, "above") not in got
        if max(abs(x - 2), abs(y - 2)) > 1.5:
            assert (k, "above") in got
    hidden = [k for k in set(middle) - roofs if 0.6 < middle[k][0] < 1.6 and abs(middle[k][1] - 2) < 0.8]
    assert hidden and all((k, "beside") not in got for k in hidden)
    untested = texture.face_views(tri, views_of(spark, [("above", 2.0, 2.0, 10.0)], f=40.0, width=120.0, height=120.0), depth_test=False)
    assert untested.count() == len(f)


def test_faces_turned_away_or_out_of_frame(spark):
    up = sheet(0, 0, 0, 2, 2, 0.0, 1)
    tri, _, _ = triangles(spark, (up[0], [(a, c, b) for a, b, c in up[1]]))
    assert texture.face_views(tri, views_of(spark, [("v", 1.0, 1.0, 10.0)])).count() == 0
    tri, _, _ = triangles(spark, up)
    assert texture.face_views(tri, views_of(spark, [("v", 30.0, 1.0, 10.0)])).count() == 0
    assert texture.face_views(tri, views_of(spark, [("under", 1.0, 1.0, -10.0)])).count() == 0


def brute_bake(faces, uv, page, views, images, shares):
    total = {}
    for k, corners in enumerate(faces):
        p = np.array([(u * (page[0] - 1), (1 - v) * (page[1] - 1)) for u, v in uv[k]])
        for r in range(page[1]):
            for c in range(page[0]):
                a = np.array([[*q, 1.0] for q in p]).T
                w = np.linalg.solve(a, [c + 0.5, r + 0.5, 1])
                if w.min() < -0.02 or not (np.floor(p.min(0)) <= (c, r)).all() or not ((c, r) <= np.ceil(p.max(0))).all():
                    continue
                place, mixed = w @ corners, np.zeros(3)
                if not any(shares.get((k, n)) for n in views):
                    continue
                for n, (x, y, z, f, cx, cy) in views.items():
                    if s := shares.get((k, n)):
                        h, wd = images[n].shape[:2]
                        u = np.clip(f * (place[0] - x) / (z - place[2]) + cx, 0, wd - 1.001)
                        v = np.clip(-f * (place[1] - y) / (z - place[2]) + cy, 0, h - 1.001)
                        i, j = int(v), int(u)
                        fu, fv = u - j, v - i
                        img = images[n].astype(float)
                        mixed += s * ((1 - fv) * ((1 - fu) * img[i, j] + fu * img[i, j + 1]) + fv * ((1 - fu) * img[i + 1, j] + fu * img[i + 1, j + 1]))
                total.setdefault((r, c), []).append(mixed)
    return {at: np.floor(np.clip(np.mean(m, axis=0), 0, 255)).astype(int).tolist() for at, m in total.items()}


@pytest.mark.parametrize("per_part", [500_000, 40])
def test_bake_equals_brute_force(spark, tmp_path, monkeypatch, per_part):
    monkeypatch.setattr(texture, "SAMPLES_PER_PART", per_part)
    rng = np.random.default_rng(1)
    tri, v, f = triangles(spark, sheet(0, 0, 0, 4, 4, 0.0, 2))
    centres = [("a.ppm", 1.0, 1.5, 9.0), ("deep/b.ppm", 3.0, 2.5, 8.0), ("c.ppm", 2.0, 2.0, 60.0)]
    views = views_of(spark, centres)
    images = {n: rng.integers(0, 256, (40, 60, 3), dtype=np.uint8) for n, *_ in centres}
    (tmp_path / "deep").mkdir()
    for n in images:
        (tmp_path / n).write_bytes(pixmap(images[n]))
    xyz = {i: np.array(p) for i, *p in v}
    corners = [np.array([xyz[i] for i in c]) for _, *c in f]
    uv = [[(p[0] / 4.5, p[1] / 5) for p in c] for c in corners]
    table = spark.createDataFrame([(k, 0, *[float(x) for p in uv[k] for x in p]) for k in range(len(f))], "fid int, page int, u0 double, v0 double, u1 double, v1 double, u2 double, v2 double")
    pages = spark.createDataFrame([(0, 14, 12)], "page int, width long, height long")
    chosen = texture.blended_views(texture.face_views(tri, views))
    shares = {(r["fid"], r["view"]): r["share"] for r in chosen.collect()}
    assert all(n != "c.ppm" for _, n in shares)  # far away: below the floor of the weights
    got = texture.baked(tri, table, pages, views, texture.image_files(spark, str(tmp_path)))
    want = brute_bake(corners, uv, (14, 12), {n: (x, y, z, 50.0, 30.0, 20.0) for n, x, y, z in centres}, images, shares)
    assert {(r["r"], r["c"]): [r[b] for b in texture.BANDS] for r in got.collect()} == want
    page = rng.integers(0, 256, (12, 14, 3), dtype=np.uint8)
    before = texture.page_texels(spark.createDataFrame([(0, pixmap(page))], "page int, content binary"))
    after = {(r["r"], r["c"]): [r[b] for b in texture.BANDS] for r in texture.over_pages(before, got).collect()}
    assert after == {(r, c): want.get((r, c), page[r, c].tolist()) for r in range(12) for c in range(14)}


def test_places_without_an_image_are_left_out(spark):
    places = spark.createDataFrame([("a", 1.0, 1.0, 7), ("gone", 1.0, 1.0, 8)], "view string, u double, v double, k int")
    image = np.full((1, 1, 3), 9, np.uint8)
    images = spark.createDataFrame([("a", pixmap(image)), ("unused", pixmap(image))], "view string, content binary")
    assert [tuple(r) for r in texture.sampled(places, images).collect()] == [("a", 7, 9.0, 9.0, 9.0)]
    with pytest.raises(ValueError, match="P6"):
        texture.decode_pnm(b"P5\n1 1\n255\n\0")


def test_grouped_medians_equal_sorted_ones(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "FEW", 5)
    monkeypatch.setattr(quantiles, "BINS", 4)
    monkeypatch.setattr(quantiles, "SORTED", 50)
    rng = np.random.default_rng(2)
    groups = {k: np.round(rng.gamma(0.4, 50, n), int(k % 3)) for k, n in enumerate((1, 2, 3, 40, 401, 1000))} | {9: np.full(50, 3.5)}
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs] + [(3, None), (77, None), (4, float("nan"))]
    found = quantiles.grouped_medians(spark.createDataFrame(rows, "k int, v double"), "k", F.col("v"))
    assert {r["k"]: (r["n"], r["median"]) for r in found.collect()} == {k: (len(v), pytest.approx(np.median(v))) for k, v in groups.items()}
