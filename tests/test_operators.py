import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from geokernel.functions import scalar as S
from geokernel.operators import change, fit, graph, grid, mesh, neighbours, stats, tiling
from geokernel.plans import catalogue

CELLS = "r long, c long, v double"


def rotation(rng):
    q = rng.normal(size=4)
    w, x, y, z = q / np.linalg.norm(q)
    return q, np.array([[1 - 2 * (y * y + z * z), 2 * (x * y - w * z), 2 * (x * z + w * y)], [2 * (x * y + w * z), 1 - 2 * (x * x + z * z), 2 * (y * z - w * x)], [2 * (x * z - w * y), 2 * (y * z + w * x), 1 - 2 * (x * x + y * y)]])


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_rotations_and_quaternions(spark):
    rng = np.random.default_rng(0)
    turns = [rotation(rng) for _ in range(6)] + [(np.eye(4)[i], np.diag(d)) for i, d in enumerate([[1, 1, 1], [1, -1, -1], [-1, 1, -1], [-1, -1, 1]])]
    for q, r in turns:
        got = one(spark, S.quat_to_rot(*map(S.lit, q)).alias("r"), S.rot_to_quat([S.lit(v) for v in r.ravel()]).alias("q"), F.array(*S.rot_to_axis_angle([S.lit(v) for v in r.ravel()])).alias("a"))
        assert np.allclose(np.array(got.r).reshape(3, 3), r, atol=1e-12)
        back = np.array(got.q)
        assert np.allclose(np.outer(back, back), np.outer(q, q) / (q @ q), atol=1e-9)


@pytest.mark.parametrize("model, params", [("PINHOLE", []), ("SIMPLE_RADIAL", [0.1]), ("RADIAL", [0.1, -0.02]), ("OPENCV", [0.1, -0.05, 0.001, -0.002]), ("FULL_OPENCV", [0.1, -0.05, 0.001, -0.002, 0.01, 0.02, 0.0, 0.001]), ("OPENCV_FISHEYE", [0.05, 0.01, -0.003, 0.001])])
def test_distortion_round_trip(spark, model, params):
    dist = F.array(*map(S.lit, params)) if params else F.array().cast("array<double>")
    there = one(spark, S.distort(F.lit(model), dist, S.lit(0.31), S.lit(-0.22)).alias("p")).p
    back = one(spark, S.undistort(F.lit(model), dist, S.lit(there.x), S.lit(there.y)).alias("p")).p
    assert abs(back.x - 0.31) < 1e-9 and abs(back.y + 0.22) < 1e-9


def test_scalars(spark):
    assert one(spark, S.utm_text(F.lit(32637)).alias("t"), S.utm_text(F.lit(3857)).alias("u"))[:] == ("WGS84 UTM 37N", "EPSG:3857")
    got = one(spark, *[S.signed_altitude(S.lit(a), F.lit(r).cast("int")).alias(f"a{i}") for i, (a, r) in enumerate([(186.3, 1), (186.3, 0), (50, None)])])
    assert got[:] == (-186.3, 186.3, 50.0)
    assert one(spark, S.parse_matrix(F.lit(" ".join(map(str, range(16))))).alias("m"), S.parse_matrix(F.lit("1 2")).alias("n"))[:] == ([float(i) for i in range(16)], None)
    assert one(spark, S.resolve_gsd(S.lit(30000), S.lit(40000)).alias("g"), S.resolve_gsd(F.lit(None).cast("double"), S.lit(1)).alias("h"))[:] == (1.0, 0.05)
    assert one(spark, S.budget_gsd(S.lit(1), S.lit(1e6), 4.0, 1e6).alias("g"))[0] == 2.0
    parts = S.marker_parts(F.lit("m12_c3")) + S.marker_parts(F.lit("x"))
    assert one(spark, *[p.alias(f"p{i}") for i, p in enumerate(parts)])[:] == (12, 3, None, None)


def cells(spark, array):
    rows = [(r, c, float(v)) for r, row in enumerate(array) for c, v in enumerate(row) if v is not None]
    return spark.createDataFrame(rows, CELLS)


def test_change_report_of_a_raised_block(spark):
    before = cells(spark, np.zeros((10, 10)))
    raised = np.zeros((10, 10))
    raised[2:5, 2:5] = 0.5
    dz = grid.difference(before, cells(spark, raised))
    got = grid.change_report(dz, spark.range(1).select(F.lit(0.1).alias("lod")), 0.25).first()
    assert (got.valid_cells, got.fill, got.cut, got.changed_area, got.net) == (100, 1.125, 0.0, 2.25, 1.125)
    nothing = grid.change_report(dz.limit(0), spark.range(1).select(F.lit(0.1).alias("lod")), 0.25).first()
    assert nothing.valid_cells == 0 and nothing.net == 0


def test_level_of_detection(spark):
    rng = np.random.default_rng(1)
    dz = grid.difference(cells(spark, np.zeros((50, 50))), cells(spark, rng.normal(0, 0.02, (50, 50))))
    assert 0.025 < grid.level_of_detection(dz).first().lod < 0.055
    assert grid.level_of_detection(dz, 0.10).first().lod >= 0.196
    assert grid.level_of_detection(dz.limit(0)).first().lod == 0


def test_transitions_carry_forward(spark):
    a, b = cells(spark, [[3, 1], [2, None]]), cells(spark, [[1, 1], [None, 1]])
    got = {(r.r, r.c): (r.carried, r.code) for r in grid.transitions(a, b).collect()}
    assert got == {(0, 0): (1, 31), (0, 1): (1, 0), (1, 0): (2, 0), (1, 1): (1, 0)}
    assert grid.transition_areas(grid.transitions(a, b), 0.25).collect()[0][:] == (31, 0.25)


def test_contours_of_a_plane(spark):
    got = grid.contour_segments(cells(spark, [[c + 0.5 for c in range(6)] for _ in range(4)]), 2.0).collect()
    assert {r.level for r in got} == {2.0, 4.0} and len(got) == 6
    assert all(r.x0 == r.x1 == r.level - 0.5 for r in got)


def test_saddle_gives_two_segments(spark):
    assert grid.contour_segments(cells(spark, [[1, 0], [0, 1]]), 0.4).filter("level = 0.4").count() == 2


def test_ground_filter_removes_a_building(spark):
    surface = np.zeros((20, 20))
    surface[8:11, 8:11] = 5.0
    kept = {(r.r, r.c) for r in grid.ground_cells(cells(spark, surface), 1.0).collect()}
    assert not kept & {(r, c) for r in range(8, 11) for c in range(8, 11)} and len(kept) == 391


def test_holes(spark):
    array = [[1.0] * 30 for _ in range(30)]
    for r in range(5, 8):
        for c in range(5, 8):
            array[r][c] = None
    for r in range(12, 22):
        for c in range(12, 22):
            array[r][c] = None
    array[0][3] = array[1][3] = None
    filled = cells(spark, array)
    assert graph.interior_holes(filled, 30, 30, 50).count() == 9
    assert graph.fill_holes(filled, 30, 30, 50).count() == filled.count() + 9


def test_components_and_connectivity(spark):
    rng = random.Random(4)
    n = 300
    edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(40)]
    ids = sorted({*range(n), *(i for e in edges for i in e)})
    low = {i: i for i in ids}

    def root(i):
        while low[i] != i:
            i = low[i]
        return i

    for a, b in edges:
        low[max(root(a), root(b))] = min(root(a), root(b))
    nodes = spark.createDataFrame([(i,) for i in ids], "id long")
    got = dict(graph.components(nodes, spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {i: root(i) for i in ids}
    lattice = spark.createDataFrame([(i, 10.0 * (i % 3), 10.0 * (i // 3)) for i in range(9)], "id long, x double, y double")
    assert graph.is_connected(lattice, 15.0) and not graph.is_connected(lattice, 9.0)


@pytest.mark.parametrize("k, width", [(1, 0.5), (3, 2.0), (50, 1.0)])
def test_nearest_matches_brute_force(spark, k, width):
    rng = np.random.default_rng(k)
    q, p = rng.normal(0, 4, (40, 3)).round(2), rng.normal(0, 4, (30, 3)).round(2)
    q[0] = [200, -300, 90]
    frame = lambda a: spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(a)], "id long, x double, y double, z double")
    got = {}
    for r in neighbours.nearest(frame(q), frame(p), width, k=k).collect():
        got.setdefault(r.id, []).append((r.rank, r.other))
    for i, v in enumerate(q):
        d2 = [((v - w) ** 2)[0] + ((v - w) ** 2)[1] + ((v - w) ** 2)[2] for w in p]
        want = sorted(range(len(p)), key=lambda j: (d2[j], j))[:k]
        assert [o for _, o in sorted(got[i])] == want


def test_radius_join(spark):
    points = spark.createDataFrame([(i, float(i), 0.0, 0.0) for i in range(-3, 4)], "id long, x double, y double, z double")
    got = {(r.id, r.other) for r in neighbours.within_radius(points, points, 1.0).collect()}
    assert got == {(a, b) for a in range(-3, 4) for b in range(-3, 4) if abs(a - b) <= 1}


def test_roughness_of_a_plane(spark):
    rng = np.random.default_rng(0)
    xy = rng.uniform(0, 10, (150, 2))
    rows = [(i, float(x), float(y), float(0.3 * x - 0.2 * y)) for i, (x, y) in enumerate(xy)]
    got = neighbours.roughness(spark.createDataFrame(rows, "id long, x double, y double, z double"), 2.0, 8).agg(F.max("residual")).first()[0]
    assert got < 1e-9


def pairs(spark, s=2.5, noise=0.0, n=8, seed=2):
    rng = np.random.default_rng(seed)
    local = rng.normal(0, 5, (n, 3))
    c, si = math.cos(0.4), math.sin(0.4)
    world = s * local @ np.array([[c, -si, 0], [si, c, 0], [0, 0, 1]]).T + [100, 200, 30] + rng.normal(0, noise, (n, 3))
    return spark.createDataFrame([(*map(float, a), *map(float, b), i % 2) for i, (a, b) in enumerate(zip(local, world, strict=True))], "lx double, ly double, lz double, wx double, wy double, wz double, g int")


def test_similarity_is_recovered(spark):
    s, r, t = fit.fit_similarity(pairs(spark))
    assert abs(s - 2.5) < 1e-9 and np.allclose(t, [100, 200, 30]) and abs(np.linalg.det(r) - 1) < 1e-9
    assert stats.residual_stats(fit.fit_residuals(pairs(spark), s, r, t)).first().max_3d < 1e-9
    assert all(abs(x.s - 2.5) < 1e-9 for x in fit.grouped_similarity(pairs(spark), "g").collect())
    with pytest.raises(ValueError, match="three pairs"):
        fit.fit_similarity(pairs(spark, n=2))


def test_rays_meet(spark):
    target = np.array([1.0, 2.0, 3.0])
    rows = []
    for g, centres in {0: [[10, 0, 0], [0, 10, 0], [5, 5, 20]], 1: [[10, 0, 0]], 2: [[10, 0, 0], [10.0, 0.0, 1e-7]]}.items():
        for c in centres:
            d = target - c
            rows.append((g, *map(float, c), *map(float, d / np.linalg.norm(d))))
    rows.append((3, 10.0, 0.0, 0.0, *map(float, -(target - [10, 0, 0]) / np.linalg.norm(target - [10, 0, 0]))))
    rows.append((3, 0.0, 10.0, 0.0, *map(float, (target - [0, 10, 0]) / np.linalg.norm(target - [0, 10, 0]))))
    got = fit.triangulated(spark.createDataFrame(rows, "g int, cx double, cy double, cz double, dx double, dy double, dz double"), "g").collect()
    assert [r.g for r in got] == [0] and np.allclose(got[0][1:4], target)


def test_registration_of_a_changed_cloud(spark):
    rng = np.random.default_rng(3)
    xy = rng.uniform(0, 30, (1500, 2))
    z = np.sin(xy[:, 0] / 3) + np.cos(xy[:, 1] / 4)
    fixed = [(i, float(x), float(y), float(h)) for i, ((x, y), h) in enumerate(zip(xy, z, strict=True))]
    moved = [(i, x - 0.04, y + 0.02, h - 0.03 - (0.4 if 10 < x < 16 and 10 < y < 16 else 0)) for i, x, y, h in fixed]
    schema = "id long, x double, y double, z double"
    found = fit.stable_registration(spark.createDataFrame(moved, schema), spark.createDataFrame(fixed, schema), 1.0)
    assert 0.7 < found["stable_fraction"] < 0.999 and found["registration_error"] < 0.05
    assert np.allclose(found["t"], [0.04, -0.02, 0.03], atol=0.02)


def test_exposure_gains(spark):
    rng = np.random.default_rng(7)
    gain, light = rng.normal(0, 0.25, 8), rng.normal(3, 1, 300)
    gain -= gain.mean()
    rows = [(i, p, float(gain[i] + light[p] + rng.normal(0, 0.02))) for i in range(8) for p in range(300)] + [(99, 0, 1.0)]
    got = dict(fit.exposure_gains(spark.createDataFrame(rows, "image int, pt int, logc double"), rounds=6).collect())
    assert got[99] == 1.0 and max(abs(got[i] - math.exp(gain[i])) for i in range(8)) < 0.03


def square(spark, z=0.0, first=0):
    v = [(first + i, x, y, z) for i, (x, y) in enumerate([(0.0, 0.0), (20.0, 0.0), (20.0, 15.0), (0.0, 15.0)])]
    return v, [(first, first, first + 1, first + 2), (first + 1, first, first + 2, first + 3)]


def test_upper_surface_wins(spark):
    v0, f0 = square(spark)
    v1, f1 = square(spark, 5.0, 10)
    v1 = [(i, x / 2, y / 2, z) for i, x, y, z in v1]
    tri = mesh.triangles(spark.createDataFrame(v0 + v1, "vid long, x double, y double, z double"), spark.createDataFrame(f0 + f1, "fid long, v0 long, v1 long, v2 long"))
    got = mesh.rasterised(tri, 0.5, 0.0, 15.0)
    assert got.count() == 40 * 30
    high = got.filter("z > 4").agg(F.min("fid"), F.count("*"), F.max("c"), F.min("r")).first()
    assert high[:] == (10, 300, 19, 15)


def test_patches(spark):
    faces = spark.createDataFrame([(0,), (1,), (2,)], "fid long")
    place = {0: (0.0, 0.0), 1: (1.0, 0.0), 2: (1.0, 1.0), 3: (0.0, 1.0), 4: (2.0, 0.0)}
    rows = [(f, k, v, *place[v], 0) for f, vs in enumerate([(0, 1, 2), (0, 2, 3), (1, 4, 2)]) for k, v in enumerate(vs)]
    rows = [(f, k, v, u + (0.1 if f == 2 else 0), w, p) for f, k, v, u, w, p in rows]
    got = dict(mesh.patches(faces, spark.createDataFrame(rows, "fid long, k int, vid long, u double, v double, page int")).collect())
    assert got == {0: 0, 1: 0, 2: 2}


def test_tile_meshes_merge(spark):
    v, f = square(spark)
    tiles = spark.createDataFrame([(t, *row) for t in (1, 2) for row in v], "tile int, vid long, x double, y double, z double")
    faces = spark.createDataFrame([(t, *row) for t in (1, 2) for row in f], "tile int, fid long, v0 long, v1 long, v2 long")
    vertices, merged = mesh.merged(tiles, faces)
    assert sorted(r.vid for r in vertices.collect()) == list(range(8))
    assert sorted((r.fid, r.v2) for r in merged.collect()) == [(0, 2), (1, 3), (2, 6), (3, 7)]


def test_view_weights(spark):
    v, f = square(spark)
    tri = mesh.triangles(spark.createDataFrame(v, "vid long, x double, y double, z double"), spark.createDataFrame(f, "fid long, v0 long, v1 long, v2 long"))
    down = [1.0, 0.0, 0.0, 0.0, -1.0, 0.0, 0.0, 0.0, -1.0]
    views = spark.createDataFrame([(0, down, [-10.0, 7.5, 50.0], 100.0, 50.0, 50.0, 100, 100), (1, down, [500.0, 7.5, 50.0], 100.0, 50.0, 50.0, 100, 100)], "view int, r array<double>, t array<double>, f double, cx double, cy double, width int, height int")
    got = mesh.view_weights(tri, views).collect()
    assert {(r.fid, r.view) for r in got} == {(0, 0), (1, 0)} and all(0 < r.weight <= 1 / 2500 for r in got)


def test_bilinear_sampling(spark):
    image = spark.createDataFrame([(r, c, 10.0 * r + c) for r in range(4) for c in range(5)], "r long, c long, value double")
    samples = spark.createDataFrame([(0, 1.25, 2.5), (1, -3.0, 0.0), (2, 99.0, 99.0)], "id long, u double, v double")
    got = dict(mesh.bilinear(samples, image, 5, 4).collect())
    assert abs(got[0] - 26.25) < 1e-9 and got[1] == 0 and abs(got[2] - 33.989) < 1e-6


def test_tiles_cover_and_halo(spark):
    points = spark.createDataFrame([(f"p{i:02d}", 10.0 * (i % 4), 10.0 * (i // 4)) for i in range(16)], "name string, x double, y double")
    g = tiling.Grid.over(points, 4)
    tiles = tiling.partition(points, g, 5.0).collect()
    assert len(tiles) == 4 and all(t.n_core == 4 and t.n_halo > 0 for t in tiles)
    core, around = ({(r.i, r.j, r.name) for r in tiling.members(points, g, 5.0).filter(F.col("part") == p).collect()} for p in ("core", "halo"))
    assert sorted(n for _, _, n in core) == sorted(f"p{i:02d}" for i in range(16)) and not core & around
    assert {t.first_name for t in tiles} == {min(n for i, j, n in core if (i, j) == (t.i, t.j)) for t in tiles}
    areas = spark.createDataFrame([(a,) for a in (0.0, 1e4, 4e4, 4e4 + 1, 16e4, 64e4, 64e4 + 1, 1e12)], "a double")
    assert [r[0] for r in areas.select(S.tile_divisions(F.col("a"))).collect()] == [1, 1, 1, 2, 2, 3, 4, 4]
    area = g.cells(spark).agg(F.sum((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0")))).first()[0]
    assert abs(area - 900) < 1e-9
    assert spark.range(1).select(tiling.tile_count(F.lit(0), 1e6, 100), tiling.tile_count(F.lit(20000), 1e6, 100)).first()[:] == (1, 2)


def test_check_points_are_interior_and_leave_control(spark):
    points = spark.createDataFrame([(i, float(i), 0.1 * (i % 2)) for i in range(10)], "rid long, x double, y double")
    got = {r.rid for r in stats.choose_check(points, 0.3, "rid").filter("is_check").collect()}
    assert len(got) == 3 and not got & {0, 9}
    assert stats.choose_check(points.limit(4), 0.3, "rid").filter("is_check").count() == 0


def test_resampling_reads_the_whole_raster(spark):
    cells = spark.createDataFrame([(r, c, float(100 * r + c)) for r in range(31) for c in range(24)], "r long, c long, v double")
    target = grid.whole_target(cells, 1.0, 0.75)
    assert target.count() == 42 * 32
    assert {x.v for x in grid.nearest_resample(cells, 1.0, 0.75, target).collect()} == {x.v for x in cells.collect()}
    filled = grid.inverse_distance_fill(cells.filter("NOT (r = 30 AND c = 5)"), grid.whole_target(cells)).collect()
    assert len(filled) == 31 * 24 and all(x.v is not None for x in filled)


def test_registered_fill_keeps_a_31st_day(spark, tmp_path):
    rows = [(2, f"2024-01-{day:02d} {hour:02d}:00:00", 1.0 + day) for day in (1, 30, 31) for hour in (0, 23)]
    events = spark.createDataFrame([(u + 1, ts, v) for u, ts, v in rows], "user_id long, ts string, value double").withColumn("ts", F.to_timestamp("ts"))
    events.write.parquet(f"{tmp_path}/events.parquet")
    got = {(x.r, x.c) for x in catalogue.inverse_distance_fill(spark, str(tmp_path)).collect()}
    assert {(30, 0), (30, 23)} <= got


def test_registered_raster_components_are_labelled(spark, tmp_path):
    cells = [(1, 0), (1, 1), (2, 1), (2, 3), (3, 0)]
    rows = [(2, f"2024-01-{day:02d} {hour:02d}:00:00", 150.0) for day, hour in cells] + [(2, "2024-01-01 02:00:00", 3.0)]
    spark.createDataFrame(rows, "user_id long, ts string, value double").withColumn("ts", F.to_timestamp("ts")).write.parquet(f"{tmp_path}/events.parquet")
    got = catalogue.QUERIES["raster_component_labels"](spark, str(tmp_path)).collect()
    groups = {}
    for x in got:
        groups.setdefault(x.component, set()).add((x.r + 1, x.c))
        assert x.cells == sum(y.component == x.component for y in got)
    assert sorted(map(sorted, groups.values())) == [[(1, 0), (1, 1), (2, 1)], [(2, 3)], [(3, 0)]]


def test_core_points_without_an_epoch_are_kept(spark):
    cloud = lambda rows: spark.createDataFrame(rows, "id long, x double, y double, z double")
    core = cloud([(1, 0.0, 0.0, 0.0), (2, 50.0, 0.0, 0.0), (3, 90.0, 0.0, 0.0)])
    before = cloud([(1, 0.0, 0.0, 0.0), (2, 0.5, 0.0, 0.0), (3, 90.0, 0.0, 40.0)])
    after = cloud([(1, 0.0, 0.0, 2.0), (2, 0.5, 0.0, 2.0), (3, 50.0, 0.0, 0.0)])
    got = {x.id: (x.distance, x.significant) for x in change.m3c2(core, before, after, 2.0, 3.0).collect()}
    assert got == {1: (2.0, True), 2: (None, False), 3: (None, False)}
