from pyspark.sql import functions as F

from geokernel.operators import imagery
from geokernel.plans import imagery as plans
from geokernel.sources import adapters as A

SF = "/root/testdata/sf0.001"


def test_counts_in_pieces_are_those_of_the_pairs(spark, monkeypatch):
    monkeypatch.setattr(imagery, "TILE_VIEWS", 20)
    monkeypatch.setattr(imagery, "TILE_MOST", 100)
    monkeypatch.setattr(imagery, "TILE_POINTS", 300.0)
    views, points = plans._views(spark, SF), A.cloud_a(spark, SF)
    found = imagery.seen_counts(views, points)
    assert "FlatMapCoGroupsInPandas" in found._jdf.queryExecution().optimizedPlan().toString()
    want = imagery.seen(views, points).groupBy("view").agg(F.count("*").alias("n"), F.max("distance").alias("far"))
    rows = lambda df: sorted((r.view, r.n, round(r.far, 9)) for r in df.collect())
    assert rows(found) == rows(want)
