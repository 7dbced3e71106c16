import math

import numpy as np

from geokernel.operators import georef


def test_markings_meet_observations_in_pieces_and_never_as_rows(spark, monkeypatch):
    monkeypatch.setattr(georef, "PARTITION_SEEN", 60)
    monkeypatch.setattr(georef, "MOST_SEEN", 40)
    monkeypatch.setattr(georef, "MOST_PAIRS", 100)
    rng = np.random.default_rng(3)
    # One image has most observations; coordinates are coarse, so that there are ties.
    seen = [("big" if i % 3 else f"img_{i % 5}", i, float(rng.integers(0, 12)), float(rng.integers(0, 12)), int(rng.integers(0, 30))) for i in range(300)]
    seen.append(("img_1", 999, None, 3.0, 2))
    marked = [(k, ["big", "img_0", "img_1", "none"][k % 4], float(rng.integers(0, 12)), float(rng.integers(0, 12))) for k in range(80)]
    points = [(p, p + 0.5, 1.0, 2.0) for p in range(0, 30, 2)]
    frames = [spark.createDataFrame(rows, s) for rows, s in ((marked, "line long, name string, u double, v double"), (seen, "image string, ordinal long, u double, v double, pid long"), (points, "pid long, x double, y double, z double"))]
    plans, asked = [], georef._nearest_pixels

    def kept(*args):
        plans.append((found := asked(*args))._jdf.queryExecution().optimizedPlan().toString())
        return found

    monkeypatch.setattr(georef, "_nearest_pixels", kept)
    got = {r["line"]: tuple(r)[1:] for r in georef.nearest_observed(*frames).collect()}
    assert len(plans) == 1 and "FlatMapCoGroupsInPandas" in plans[0]
    want = {}
    for k, name, u, v in marked:
        near = [(math.inf if su is None else (su - u) ** 2 + (sv - v) ** 2, o, p) for image, o, su, sv, p in seen if image == name and p % 2 == 0]
        if near:
            d2, _, p = min(near)
            want[k] = (p, d2, p + 0.5, 1.0, 2.0)
    assert got == want and len(want) == 60
