import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from geokernel.functions import scalar as S
from geokernel.operators import fit, georef

MARKINGS = "line long, wx double, wy double, wz double, u double, v double, image string, label string"
IMAGES = "name string, q array<double>, t array<double>, camera_id int"
CAMERAS = "camera_id int, model string, width long, height long, params array<double>"
KEYPOINTS = "image string, ordinal long, u double, v double, pid long"
POINTS = "pid long, x double, y double, z double"


def scene(spark):
    """Four control points; three cameras look straight down from 10. The fourth point is marked
    in one image alone, beside an observed point."""
    rng = np.random.default_rng(3)
    cams = {f"flight/im{i}.jpg": np.array([x, y, 10.0]) for i, (x, y) in enumerate([(0, 0), (6, 0), (0, 5)])}
    images = [(n, [0.0, 1.0, 0.0, 0.0], [float(-c[0]), float(c[1]), float(c[2])], 1) for n, c in cams.items()]
    local = rng.uniform(0, 5, (4, 3)) * [1, 1, 0.2]
    world = 2 * local[:, [1, 0, 2]] * [-1, 1, 1] + [100, 200, 30]
    rows = []
    for i, (p, w) in enumerate(zip(local, world, strict=True)):
        for j, (n, c) in enumerate(cams.items()):
            if i == 3 and j:
                continue
            d = p - c
            u, v = 800 * d[0] / -d[2] + 500, 800 * -d[1] / -d[2] + 400
            named = n if i % 2 else "elsewhere/" + n.split("/")[1]
            rows.append((10 * i + j, *map(float, w), float(u), float(v), named if i % 2 else n, f"m{i}_c0" if j == 0 else None))
    rows.append((99, *map(float, world[0]), 1.0, 1.0, "unknown.jpg", "m9_c9"))
    cameras = [(1, "PINHOLE", 1000, 800, [800.0, 800.0, 500.0, 400.0])]
    u, v = rows[-2][4:6]
    points = [(7, *map(float, local[3] + 0.01)), (8, 0.0, 0.0, 0.0)]
    u, v = float(u), float(v)
    seen = [("flight/im0.jpg", 0, u + 3, v, 7), ("flight/im0.jpg", 1, u - 3, v, 8), ("flight/im0.jpg", 2, u, v, 404), ("flight/im1.jpg", 3, u, v, 8)]
    frames = [spark.createDataFrame(r, s) for r, s in ((rows, MARKINGS), (images, IMAGES), (cameras, CAMERAS), (seen, KEYPOINTS), (points, POINTS))]
    return local, world, frames


def test_control_points_are_found(spark):
    local, world, frames = scene(spark)
    got = sorted(georef.control_points(*frames).collect(), key=lambda r: r.label)
    assert [(r.label, r.method) for r in got] == [("m0_c0", "triangulated"), ("m1_c0", "triangulated"), ("m2_c0", "triangulated"), ("m3_c0", "nearest_point")]
    found = np.array([[r.lx, r.ly, r.lz] for r in got])
    assert np.allclose(found[:3], local[:3], atol=1e-9)
    # Of two observed points equally near the first observation counts; unknown points do not.
    assert np.allclose(found[3], local[3] + 0.01)
    assert np.allclose([[r.wx, r.wy, r.wz] for r in got], world, atol=1e-4)
    with pytest.raises(ValueError, match="5 are needed"):
        georef.control_points(*frames, least=5)


def test_names_fall_back_to_their_last_part(spark):
    marks = spark.createDataFrame([(1, "a/x.jpg"), (2, "x.jpg"), (3, "b/y.jpg"), (4, "z.jpg"), (5, None), (1, "a/x.jpg")], "rid int, image string")
    names = spark.createDataFrame([("a/x.jpg",), ("x.jpg",), ("y.jpg",), (None,), ("x.jpg",)], "name string")
    got = sorted((r.rid, r.name) for r in georef.matched_names(marks, names).collect())
    assert got == [(1, "a/x.jpg"), (1, "a/x.jpg"), (2, "x.jpg"), (3, "y.jpg")]
    assert georef.matched_names(marks.limit(0), names).collect() == []


def corners(noise=0.0, method="triangulated"):
    rng = np.random.default_rng(0)
    rows = []
    for m in range(4):
        at, turn = rng.uniform(0, 10, 3), rng.uniform(0, 6)
        for k in range(4 if m else 2):
            p = at + 0.1 * np.array([math.cos(turn + k * math.pi / 2), math.sin(turn + k * math.pi / 2), 0])
            w = 3 * p[[1, 0, 2]] * [-1, 1, 1] + [50, 60, 70]
            p = p + rng.normal(0, noise, 3)
            rows.append((m, k, *map(float, p), *map(float, w), "nearest_point" if (m, k) == (2, 1) else method))
    return rows


SCHEMA = "m int, k int, lx double, ly double, lz double, wx double, wy double, wz double, method string"


def test_markers_are_judged_by_the_others(spark):
    rows = corners()
    # One marker is twice as large as its corners say: only its own size is off.
    rows = [(*r[:5], *(r[5:8] if r[0] != 3 else [2 * v for v in r[5:8]]), r[8]) for r in rows]
    got = {r.m: r for r in fit.marker_check(spark.createDataFrame([r for r in rows if r[0] != 3], SCHEMA)).collect()}
    side = 1000 * 3 * 0.1 * math.sqrt(2)
    assert {m: r.corners for m, r in got.items()} == {0: 2, 1: 4, 2: 4}
    assert all(abs(r.estimated_mm - side) < 1e-6 and abs(r.expected_mm - side) < 1e-6 for r in got.values())
    assert [got[m].low_confidence for m in (0, 1, 2)] == [False, False, True]
    assert fit.marker_check(spark.createDataFrame([r for r in rows if r[0] == 1], SCHEMA)).collect() == []
    assert fit.marker_check(spark.createDataFrame([], SCHEMA)).collect() == []


def test_left_out_fits_against_fits_of_the_rest(spark):
    rows = spark.createDataFrame(corners(0.01), SCHEMA)
    got = {r.m: r for r in fit.left_out_similarity(rows, "m").collect()}
    for m in range(4):
        s, r, t = fit.fit_similarity(rows.filter(F.col("m") != m))
        assert abs(got[m].s - s) < 1e-9 and np.allclose(got[m].r, r.ravel(), atol=1e-9) and np.allclose(got[m].t, t, atol=1e-7)


def test_position_fixes(spark):
    centres = spark.createDataFrame([(f"i{k}", float(k), 0.0, 0.0) for k in range(4)], "name string, x double, y double, z double")
    fixes = spark.createDataFrame([("i0", 48.0, 9.0, 12.0), ("i1", -33.0, 9.5, None), ("i2", 48.2, 8.7, 1.0), ("i3", None, 9.0, 1.0), ("x", 1.0, 1.0, 1.0)], "name string, lat double, lon double, alt double")
    pairs, epsg = georef.position_fixes(centres, fixes)
    got = {r.name: r for r in pairs.collect()}
    assert epsg == 32632 and sorted(got) == ["i0", "i1", "i2"] and got["i1"].wz == 0
    # On the central meridian: 0.9996 times the meridian arc of 48 degrees.
    assert abs(got["i0"].wx - 500_000) < 1e-6 and abs(got["i0"].wy - 5_316_300.77) < 1
    with pytest.raises(ValueError, match="fixes"):
        georef.position_fixes(centres, fixes.limit(2))


def test_modes(spark):
    rows = [("gcp", 2, 9), ("gcp", 3, 0), ("exif", 9, 2), ("auto", 3, 3), ("auto", 0, 3), ("auto", 0, 0), (None, 0, 0), ("local", 9, 9)]
    df = spark.createDataFrame(rows, "a string, g int, f int").select(georef.mode(F.col("a"), F.col("g"), F.col("f")))
    assert [r[0] for r in df.collect()] == [None, "gcp", None, "gcp", "exif", "local", "local", "local"]


def test_undistorted_rays_meet(spark):
    """What distort() bends, viewing_rays() straightens."""
    rows = [("OPENCV", [900.0, 910.0, 500.0, 400.0, -0.1, 0.02, 0.001, -0.002])]
    df = spark.createDataFrame(rows, "model string, params array<double>").withColumns({"q": F.array(*map(F.lit, (1.0, 0.0, 0.0, 0.0))), "t": F.array(*map(F.lit, (0.0, 0.0, 0.0)))})
    k = S.intrinsics(F.col("model"), F.col("params"))
    bent = S.distort(F.col("model"), k["dist"], F.lit(0.2), F.lit(-0.1))
    df = df.withColumns({"u": k["fx"] * bent["x"] + k["cx"], "v": k["fy"] * bent["y"] + k["cy"]})
    r = georef.viewing_rays(df).first()
    assert abs(r.dx / r.dz - 0.2) < 1e-9 and abs(r.dy / r.dz + 0.1) < 1e-9


def test_control_points_that_markers_share_have_the_lowest_label(spark, tmp_path):
    import shutil

    import duckdb

    from geokernel.plans.catalogue import ORACLES, QUERIES

    shutil.copytree("/root/testdata/sf0.001", tmp_path / "sf")
    con = duckdb.connect()
    source = "/root/testdata/sf0.001/supplier.parquet"
    con.execute(f"COPY (SELECT * REPLACE (s_suppkey + i * 1024 AS s_suppkey) FROM '{source}', range(0, 3) r(i)) TO '{tmp_path}/shared.parquet'")
    shutil.copyfile(tmp_path / "shared.parquet", tmp_path / "sf" / "supplier.parquet")
    for name in ("supplier", "customer", "nation", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/sf/{name}.parquet')")
    columns = ["wx", "wy", "wz", "label", "lx", "ly", "lz", "method"]
    got = QUERIES["control_point_solve"](spark, str(tmp_path / "sf")).select(columns).collect()
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES['control_point_solve']})").fetchall()
    assert sorted(map(tuple, got)) == sorted(want)
