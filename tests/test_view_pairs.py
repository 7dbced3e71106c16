from pyspark.sql import functions as F

from geokernel.operators import imagery, mesh, texture
from geokernel.plans import texture as plans
from geokernel.sources import adapters as A

SF = "/root/testdata/sf0.001"


def test_pairs_of_faces_and_views_are_shuffled_and_measured_as_arrays(spark):
    tri = mesh.triangles(A.vertices(spark, SF), A.faces(spark, SF))
    views = plans._views(spark, SF)
    for found in (texture.face_views(tri, views), texture.depth_cells(tri, views)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "MapInPandas" in plan and "BroadcastHashJoin" not in plan
    points = tri.select("fid", F.col("x0").alias("x"), F.col("y0").alias("y"), F.col("z0").alias("z"))
    assert "Broadcast" not in imagery.near_pairs(views, points)._jdf.queryExecution().executedPlan().toString()
