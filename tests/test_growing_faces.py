from geokernel.operators import mesh
from geokernel.sources import adapters as A

SF = "/root/testdata/sf0.001"


def test_tasks_of_the_corner_joins_go_by_the_number_of_faces(spark, monkeypatch):
    vertices, faces = A.vertices(spark, SF), A.faces(spark, SF)
    want = sorted(mesh.triangles(vertices, faces).collect())
    monkeypatch.setattr(mesh, "PARTITION_FACES", 25)
    tri = mesh.triangles(vertices, faces)
    parts = 1 + len(want) // 25
    assert parts > 4 and "hashpartitioning(v2#" in (plan := tri._jdf.queryExecution().executedPlan().toString()) and f", {parts}), REPARTITION_BY_NUM" in plan
    assert sorted(tri.collect()) == want
