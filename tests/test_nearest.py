import numpy as np

from geokernel.operators import neighbours


def cloud(spark, p):
    return spark.createDataFrame([(i, *map(float, row)) for i, row in enumerate(p)], "id long, x double, y double, z double")


def test_tiles_in_pieces_find_what_all_pairs_do_and_make_no_rows_of_pairs(spark, monkeypatch):
    rng = np.random.default_rng(5)
    p = np.unique(rng.integers(0, 96, (300, 3)) / 16, axis=0)
    p = np.concatenate([p, [[np.nan, 1, 1]]])
    monkeypatch.setattr(neighbours, "TILE_QUERIES", 40.0)
    monkeypatch.setattr(neighbours, "TILE_MOST", 30)
    monkeypatch.setattr(neighbours, "MOST_POINTS", 50)
    asked = neighbours._candidates
    plans = []

    def candidates(*args):
        found = asked(*args)
        plans.append(found._jdf.queryExecution().optimizedPlan().toString())
        return found

    monkeypatch.setattr(neighbours, "_candidates", candidates)
    got = {(r.id, r.rank): (r.other, r.d2) for r in neighbours.nearest(cloud(spark, p), cloud(spark, p), k=5, exclude_self=True).collect()}
    assert plans and all("FlatMapCoGroupsInPandas" in plan and "cell_" not in plan for plan in plans)
    p = p[:-1]
    d2 = ((p[:, None] - p) ** 2).sum(axis=2)
    np.fill_diagonal(d2, np.inf)
    want = {(i, k + 1): (j, d2[i, j]) for i in range(len(p)) for k, j in enumerate(np.lexsort((np.arange(len(p)), d2[i]))[:5])}
    assert got == want
