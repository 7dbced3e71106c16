import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from geokernel.operators import graph, grid


def raster(spark, values):
    return spark.createDataFrame([(r, c, float(v)) for (r, c), v in np.ndenumerate(values)], "r long, c long, v double")


def flood(cells):
    left, out = set(cells), {}
    for start in sorted(cells):
        if start not in left:
            continue
        todo, left = [start], left - {start}
        while todo:
            r, c = todo.pop()
            out[r, c] = start[0] * 2**31 + start[1]
            for near in ((r + 1, c), (r - 1, c), (r, c + 1), (r, c - 1)):
                if near in left:
                    left.remove(near)
                    todo.append(near)
    return out


@pytest.mark.parametrize("tile", [4, 7, 512])
def test_components_across_tiles_equal_a_flood(spark, tile):
    rng = random.Random(tile)
    cells = [(r, c) for r in range(-6, 20) for c in range(-5, 22) if rng.random() < 0.58]
    cells = [(r, c) for r, c in cells if r >= 0 and c >= 0]
    got = {(x["r"], x["c"]): x["component"] for x in graph.raster_components(spark.createDataFrame(cells, "r int, c int"), tile).collect()}
    assert got == flood(cells)
    # A snake through all tiles is one component.
    snake = [(r, c) for r in range(16) for c in range(16) if r % 2 == 0 or c == (0 if r % 4 == 1 else 15)]
    found = graph.raster_components(spark.createDataFrame(snake, "r int, c int"), tile)
    assert found.select("component").distinct().count() == 1 and found.count() == len(snake)
    assert graph.raster_components(spark.createDataFrame([], "r int, c int"), tile).count() == 0


def test_holes_are_told_and_filled(spark):
    values = np.arange(100.0).reshape(10, 10)
    gaps = {(0, 3), (1, 3), (4, 4), (4, 5), (5, 4), (7, 7), (6, 1), (6, 2), (7, 1), (7, 2), (8, 1), (8, 2)}
    filled = raster(spark, values).filter(~F.concat_ws(",", "r", "c").isin([f"{r},{c}" for r, c in gaps]))
    assert tuple(graph.hole_report(filled, 10, 10).first()) == (12, 3, 10, 0.1)
    new = {(x["r"], x["c"]): x["v"] for x in graph.fill_holes(filled, 10, 10, 3).collect() if (x["r"], x["c"]) in gaps}
    assert set(new) == {(4, 4), (4, 5), (5, 4), (7, 7)}
    assert new[7, 7] == 67.0 and new[4, 4] == 34.0 and new[4, 5] == 35.0
    assert tuple(graph.hole_report(raster(spark, values), 10, 10).first()) == (0, 0, 0, 0.0)


def lines_of(df):
    out = {}
    for r in df.orderBy("line", "position").collect():
        out.setdefault((r["line"], r["level"], r["closed"]), []).append((r["position"], r["x"], r["y"]))
    return out


def test_lines_run_in_order(spark):
    y, x = np.mgrid[0:24, 0:30]
    hill = 10 - np.hypot(x - 11.3, y - 12.1)
    found = lines_of(grid.contour_lines(grid.contour_segments(raster(spark, hill), 3.0)))
    assert {(level, closed) for _, level, closed in found} >= {(3.0, True), (6.0, True), (9.0, True), (-3.0, False)}
    for (_, level, closed), points in found.items():
        assert [p for p, _, _ in points] == list(range(len(points)))
        xy = np.array([p[1:] for p in points])
        steps = np.hypot(*np.diff(xy, axis=0).T)
        assert steps.max() <= np.sqrt(2) + 1e-9
        assert closed == bool((xy[0] == xy[-1]).all())
        assert np.abs(np.hypot(xy[:, 0] - 11.3, xy[:, 1] - 12.1) - (10 - level)).max() < 0.3
    ring = next(np.array([p[1:] for p in v]) for (_, level, _), v in found.items() if level == 6.0)
    area = 0.5 * np.sum(ring[:-1, 0] * ring[1:, 1] - ring[1:, 0] * ring[:-1, 1])
    assert abs(abs(area) - np.pi * 16) < 1.5


def test_saddles_and_corners_at_the_level(spark):
    board = np.array([[(r + c) % 2 for c in range(6)] for r in range(6)], float)
    segments = grid.contour_segments(raster(spark, board), 0.5)
    found = lines_of(grid.contour_lines(segments))
    assert sum(len(v) - 1 for v in found.values()) == segments.count()
    flat = np.array([[0, 0, 0, 0, 0], [0, 2, 2, 2, 0], [0, 2, 3, 2, 0], [0, 2, 2, 2, 0], [0, 0, 0, 0, 0]], float)
    found = lines_of(grid.contour_lines(grid.contour_segments(raster(spark, flat), 2.0)))
    # The level's own cells are above it: one line around them.
    assert [level for _, level, _ in found].count(2.0) == 1
    assert all(closed for _, _, closed in found)
    assert grid.contour_lines(grid.contour_segments(raster(spark, np.zeros((3, 3))), 1.0)).count() == 0
