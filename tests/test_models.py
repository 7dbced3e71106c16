import numpy as np
import pytest

from geokernel.sources import models, survey


def test_first_existing_model_and_mesh(spark, tmp_path):
    assert models.find_model(spark, str(tmp_path)) is None and models.find_mesh(spark, str(tmp_path)) is None
    (tmp_path / "sparse").mkdir()
    (tmp_path / "sparse/images.txt").write_text("")
    (tmp_path / "scene_dense_mesh.obj").write_text("")
    assert models.find_model(spark, str(tmp_path)) == f"{tmp_path}/sparse"
    (tmp_path / "sparse/0").mkdir()
    assert models.find_model(spark, str(tmp_path)) == f"{tmp_path}/sparse"  # no images in there yet
    (tmp_path / "sparse/0/images.txt").write_text("")
    (tmp_path / "scene_dense_mesh_texture.obj").write_text("")
    assert models.find_model(spark, str(tmp_path)) == f"{tmp_path}/sparse/0"
    assert models.find_mesh(spark, str(tmp_path)) == f"{tmp_path}/scene_dense_mesh_texture.obj"


def test_counts_of_headers_and_lines(spark, tmp_path):
    (tmp_path / "a.ply").write_bytes(b"ply\nformat binary_little_endian 1.0\nelement vertex 1234\nproperty float x\nend_header\n" + bytes(range(256)) * 600)
    (tmp_path / "b.ply").write_bytes(b"ply\nformat ascii 1.0\nend_header\nelement vertex 7\n")
    got = {r["path"].split("/")[-1]: r["vertices"] for r in models.point_counts(spark, f"{tmp_path}/*.ply").collect()}
    assert got == {"a.ply": 1234, "b.ply": None}
    (tmp_path / "m.obj").write_text("v 0 0 0\nvt 0 0\nv 1 0 0\nv 0 1 0\nf 1 2 3\nvn 0 0 1\n")
    assert tuple(models.mesh_counts(spark, f"{tmp_path}/m.obj").first()) == (3, 1)


def test_a_mesh_is_rewritten_in_its_place(spark, tmp_path):
    rng = np.random.default_rng(1)
    points = rng.normal(0, 10, (400, 3)).round(4)
    text = ["mtllib m.mtl", *[f"v {x} {y} {z}" for x, y, z in points], "vt 0.5 0.25", "usemtl a", "f 1/1 2/1 3/1", "# end"]
    path = tmp_path / "m.obj"
    path.write_text("\n".join(text) + "\n")
    turn = np.array([[0.0, -1.0, 0.0], [1.0, 0.0, 0.0], [0.0, 0.0, 1.0]])
    models.rewrite_mesh(spark, str(path), 2.5, turn, np.array([500_000.25, 10.0, -3.0]), np.array([500_000.0, 0.0, 0.0]))
    parts = sorted(p for p in path.iterdir() if p.name.startswith("part-"))
    lines = "".join(p.read_text() for p in parts).splitlines()
    want = points @ turn.T * 2.5 + [0.25, 10.0, -3.0]
    assert [x for x in lines if not x.startswith("v ")] == [x for x in text if not x.startswith("v ")]
    assert np.allclose([[float(n) for n in x.split()[1:]] for x in lines if x.startswith("v ")], want, atol=1e-6)
    assert not (tmp_path / "m.obj.new").exists()
    vertices, _, faces = survey.textured_mesh(spark, str(path))
    assert vertices.count() == 400 and faces.count() == 1


@pytest.mark.parametrize("only", [False, True])
def test_polygons_are_fans_or_left_out(spark, tmp_path, only):
    (tmp_path / "m.obj").write_text("v 0 0 0\nv 1 0 0\nv 1 1 0\nv 0 1 0\nf 1 2 3 4\nf 1 2 3\n")
    _, _, faces = survey.textured_mesh(spark, f"{tmp_path}/m.obj", triangles_only=only)
    assert faces.count() == (1 if only else 3)
