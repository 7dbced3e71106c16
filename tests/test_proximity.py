import numpy as np

from pyspark.sql import functions as F

from geokernel.operators import graph


def test_components_by_cells_are_those_of_all_links(spark, monkeypatch):
    monkeypatch.setattr(graph, "CELL_PIECE", 3)
    rng = np.random.default_rng(6)
    p = np.vstack([rng.integers(0, 64 * 14, (260, 2)) / 64, [[20.0, 20.0], [21.5, 20.0], [20.0, 21.5], [23.0, 20.0 + 2**-20], [np.nan, 1.0], [np.inf, 1.0]]])
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(p)], "id long, x double, y double")
    for radius in (0.75, 1.5):
        low = np.arange(len(p))
        with np.errstate(invalid="ignore"):
            near = ((p[:, None] - p) ** 2).sum(axis=2) <= radius * radius
        for _ in range(len(p)):
            low = np.array([min(low[near[i]], default=i) for i in range(len(p))])
        got = dict(graph.proximity_components(df, radius).collect())
        assert got == dict(enumerate(low.tolist())) and len(set(low)) > 3


def test_a_dense_place_is_linked_without_its_pairs(spark):
    points = spark.range(20000).select("id", (F.col("id") % 100 / 1000).alias("x"), F.lit(0.0).alias("y"))
    found = graph.proximity_components(points, 1.5)
    assert found.select("component").distinct().count() == 1
    # All links of these points are 4 * 10^8 rows; the edges kept for them are none.
    assert "d2" not in found._jdf.queryExecution().optimizedPlan().toString()
