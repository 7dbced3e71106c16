import json
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from geokernel.sources import colmap, sinks, survey


def put(tmp_path, name, text):
    path = tmp_path / name
    path.write_bytes(text) if isinstance(text, bytes) else path.write_text(text)
    return str(path)


def test_text_model(spark, tmp_path):
    cameras = colmap.cameras_text(spark, put(tmp_path, "cameras.txt", "# c\n1 PINHOLE 100 80 50 51 52 53\n\n2 SIMPLE_RADIAL 10 20 9 5 10 0.1\nbad\n")).orderBy("camera_id").collect()
    assert [(c.camera_id, c.model, c.params) for c in cameras] == [(1, "PINHOLE", [50.0, 51.0, 52.0, 53.0]), (2, "SIMPLE_RADIAL", [9.0, 5.0, 10.0, 0.1])]
    points = colmap.points_text(spark, put(tmp_path, "points.txt", "# p\n7 1 2 3 0 0 0 0.5 1 0\n")).collect()
    assert [tuple(p) for p in points] == [(7, 1.0, 2.0, 3.0)]
    text = "# two lines an image\n1 1 0 0 0 0 0 0 1 a b.jpg\n1.5 2.5 7 3 4 -1\n2 1 0 0 0 -1 0 0 1 c.jpg\n\n3 0 0 0 1 -2 5 0 2 d.jpg\n9 9 8\n"
    images = colmap.images_text(spark, put(tmp_path, "images.txt", text))
    assert [(o.image, o.u, o.v, o.pid) for o in colmap.observations(images).orderBy("image").collect()] == [("a b.jpg", 1.5, 2.5, 7), ("d.jpg", 9.0, 9.0, 8)]
    centres = {c.name: (c.x, c.y, c.z) for c in colmap.centres(images).collect()}
    assert np.allclose(centres["c.jpg"], (1, 0, 0)) and np.allclose(centres["d.jpg"], (-2, 5, 0))


def test_binary_model(spark, tmp_path):
    raw = struct.pack("<Q", 2) + struct.pack("<iiQQ4d", 1, 1, 100, 80, 50, 51, 52, 53) + struct.pack("<iiQQ3d", 2, 0, 10, 20, 9, 5, 10)
    assert [c.params for c in colmap.cameras_binary(spark, put(tmp_path, "cameras.bin", raw)).orderBy("camera_id").collect()] == [[50.0, 51.0, 52.0, 53.0], [9.0, 5.0, 10.0]]
    raw = struct.pack("<Q", 2) + struct.pack("<I7dI", 1, 1, 0, 0, 0, 0, 0, 0, 1) + b"a.jpg\0" + struct.pack("<Q", 2) + struct.pack("<ddq", 1, 2, 7) + struct.pack("<ddq", 3, 4, -1)
    raw += struct.pack("<I7dI", 2, 1, 0, 0, 0, 1, 2, 3, 1) + b"b.jpg\0" + struct.pack("<Q", 0)
    images = colmap.images_binary(spark, put(tmp_path, "images.bin", raw)).orderBy("image_id").collect()
    assert [(i.name, len(i.obs), i.t) for i in images] == [("a.jpg", 1, [0.0, 0.0, 0.0]), ("b.jpg", 0, [1.0, 2.0, 3.0])]
    raw = struct.pack("<Q", 2) + b"".join(struct.pack("<Q3d3BdQ", p, p, 0, 1, 1, 2, 3, 0.5, 1) + struct.pack("<II", 1, 1) for p in (4, 5))
    assert [p.pid for p in colmap.points_binary(spark, put(tmp_path, "points.bin", raw)).orderBy("pid").collect()] == [4, 5]
    with pytest.raises(Exception, match="not supported"):
        colmap.cameras_binary(spark, put(tmp_path, "bad.bin", struct.pack("<Q", 1) + struct.pack("<iiQQ4d", 1, 4, 1, 1, 0, 0, 0, 0))).collect()


def test_control_list(spark, tmp_path):
    text = "EPSG:32637\n# x\n1 2 3 10 20 a.jpg m4_c1\n1.00001 2 3 11 21 b.jpg m4_c2 check\n1 2 3 4 5\n7 8 9 1 2 c.jpg check label\n7 8 9 1 2 d.jpg gcp2\n"
    rows = survey.control_points(spark, put(tmp_path, "gcp.txt", text)).orderBy("line").collect()
    assert [(r.image, r.label, r.is_check) for r in rows] == [("a.jpg", "m4_c1", False), ("b.jpg", "m4_c2", True), ("c.jpg", None, False), ("d.jpg", None, False)]
    grouped = survey.grouped_control(survey.control_points(spark, str(tmp_path / "gcp.txt"))).orderBy("wx").collect()
    assert [(g.wx, g.n, g.label) for g in grouped] == [(1.0, 2, "m4_c1"), (7.0, 2, None)]


def test_check_pairs(spark, tmp_path):
    path = put(tmp_path, "cp.csv", "id;x;y;z;a;b;c\np1;1;2;3;1.01;2.02;3.03\n1,2,3\n4,5,6,7,8,9\n")
    assert sorted(tuple(r) for r in survey.check_pairs(spark, path).collect()) == [(1.0, 2.0, 3.0, 1.01, 2.02, 3.03), (4.0, 5.0, 6.0, 7.0, 8.0, 9.0)]
    with pytest.raises(Exception, match="more than six"):
        survey.check_pairs(spark, put(tmp_path, "bad.csv", "1,2,3,4,5,6,7\n")).collect()


def test_textured_mesh(spark, tmp_path):
    text = "mtllib m\nv 0 0 0\nv 1 0 0\nv 1 1 0\nv 0 1 0\nvt 0 0\nvt 1 0\nvt 1 1\nvt 0 1\nusemtl one\nf 1/1 2/2 3/3 4/4\nusemtl two\nf -4/-4 -3/-3 -2/-2\nv 9 9 9\nf -1 1 2\n"
    vertices, places, faces = survey.textured_mesh(spark, put(tmp_path, "m.obj", text))
    assert vertices.count() == 5 and places.count() == 4
    got = [(r.polygon, r.material, r.v0, r.v1, r.v2, r.t0) for r in faces.orderBy("polygon", "i").collect()]
    assert got == [(0, "one", 0, 1, 2, 0), (0, "one", 0, 2, 3, 0), (1, "two", 0, 1, 2, 0), (2, "two", 4, 0, 1, None)]


def test_raster_points(spark):
    cells = spark.createDataFrame([(0, 0, 10.0), (0, 1, -9999.0), (1, 0, float("nan")), (1, 2, 5.0)], "r long, c long, v double")
    assert sorted(tuple(r) for r in survey.raster_points(cells, 100, 200, 1.0).collect()) == [(100.5, 199.5, 10.0), (102.5, 198.5, 5.0)]


def test_documents(spark, tmp_path):
    cameras = spark.createDataFrame([(1, "OPENCV", 2048, 1536, [1419.92, 1419.92, 1024.0, 768.0, 0.1, 0.0, 0.0, 0.0])], "camera_id int, model string, width bigint, height bigint, params array<double>")
    body = json.loads(sinks.camera_documents(cameras).first().document)
    assert body["projection_type"] == "brown" and abs(body["focal_x"] - 1419.92 / 2048) < 1e-12 and body["c_x"] == 0 and body["distortion"][0] == 0.1
    shots = spark.createDataFrame([("a.jpg", 37.1, 55.2, 100.0, [1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0])], "name string, lon double, lat double, z double, r array<double>")
    assert json.loads(sinks.shot_documents(shots).first().document)["geometry"]["coordinates"] == [37.1, 55.2, 100.0]
    assert spark.range(1).select(sinks.coordinate_note(F.lit(32737), F.lit(1.0), F.lit(2.0))).first()[0] == "WGS84 UTM 37S\n1 2"
    cloud = spark.createDataFrame([(1, 1.00049, 2.0, 3.0), (2, 300.0, -1.0, 3.0)], "pid long, x double, y double, z double")
    sinks.write_cloud(cloud, str(tmp_path / "cloud"))
    back = spark.read.parquet(str(tmp_path / "cloud")).orderBy("pid").collect()
    assert [(r.x, r.tile_x, r.tile_y) for r in back] == [(1.0, 0, 0), (300.0, 1, -1)]
