from geokernel.operators import imagery, mesh
from geokernel.plans.catalogue import QUERIES
from geokernel.sources import adapters as A

SF = "/root/testdata/sf0.001"


def test_triangles_of_surface_samples_are_gathered_once(spark):
    got = QUERIES["surface_samples"](spark, SF)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    tri = mesh.triangles(A.vertices(spark, SF), A.faces(spark, SF))
    assert sorted(got.collect()) == sorted(imagery.surface_samples(tri, 4 * tri.count()).collect())
