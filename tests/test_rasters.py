import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from geokernel.sources import rasters, tiff


def cells_of(spark, values, nodata):
    rows = [(r, c, float(v)) for (r, c), v in np.ndenumerate(values) if v != nodata]
    return spark.createDataFrame(rows, "r long, c long, v double")


def test_round_trip_of_a_mosaic(spark, tmp_path):
    rng = np.random.default_rng(1)
    values = np.round(rng.normal(100, 30, (70, 45)), 3).astype(np.float32)
    values[rng.random(values.shape) < 0.2] = -9999
    values[32:64, 32:45] = -9999  # a block without cells
    path = f"{tmp_path}/dsm"
    rasters.write_grid(cells_of(spark, values, -9999), path, 500_000.0, 4_100_000.0, 0.25, 70, 45, epsg=32636, block=32)
    assert sorted(p.name for p in (tmp_path / "dsm").glob("*")) == ["r0_c0.tif", "r0_c32.tif", "r32_c0.tif", "r64_c0.tif", "r64_c32.tif"]
    back = {(r["r"], r["c"]): r["v"] for r in rasters.read_grid(spark, path).collect()}
    assert back == {(r, c): float(v) for (r, c), v in np.ndenumerate(values) if v != -9999}
    g = rasters.grid_header(f"{path}/r64_c32.tif")
    assert (g.width, g.height, g.x0, g.y1, g.gsd, g.nodata, g.epsg, g.kind) == (13, 6, 500_008.0, 4_099_984.0, 0.25, -9999.0, 32636, "f4")
    # Written again with fewer cells: nothing of the first mosaic is left.
    rasters.write_grid(cells_of(spark, values, -9999).filter("r < 5 AND c < 5"), path, 0.0, 0.0, 1.0, 70, 45, block=32)
    assert [p.name for p in (tmp_path / "dsm").glob("*")] == ["r0_c0.tif"]


def test_windows_prune_files_and_tiles(spark, tmp_path):
    values = np.arange(96 * 96, dtype=np.float32).reshape(96, 96)
    path = f"{tmp_path}/g"
    rasters.write_grid(cells_of(spark, values, None), path, 0.0, 0.0, 1.0, 96, 96, nodata=None, block=48)
    found = rasters.read_grid(spark, path, window=(40, 60, 10, 20))
    assert {(r["r"], r["c"]): r["v"] for r in found.collect()} == {(r, c): float(values[r, c]) for r in range(40, 60) for c in range(10, 20)}
    (tmp_path / "g/r48_c48.tif").write_bytes(b"not opened")
    assert rasters.read_grid(spark, path, window=(0, 48, 0, 96)).count() == 48 * 96
    scan = rasters._Scan({"path": path, "r0": "0", "r1": "10", "c0": "0", "c1": "10"})
    assert [(p.path.split("/")[-1], p.tiles) for p in scan.partitions()] == [("r0_c0.tif", [0])]


def test_colours_and_classes(spark, tmp_path):
    rng = np.random.default_rng(2)
    image = rng.integers(0, 256, (20, 30, 4), dtype=np.uint8)
    rows = [(r, c, *map(int, image[r, c])) for r in range(20) for c in range(30)]
    bands = ("red", "green", "blue", "alpha")
    rasters.write_grid(spark.createDataFrame(rows, "r int, c int, " + ", ".join(f"{b} int" for b in bands)), f"{tmp_path}/rgb", 0.0, 0.0, 1.0, 20, 30, bands, "u1", None)
    found = rasters.read_grid(spark, f"{tmp_path}/rgb/r0_c0.tif", bands=4)
    assert sorted(map(tuple, found.collect())) == [tuple(map(float, r)) for r in rows]
    part = spark.createDataFrame([(0, 0, 3.0), (1, 1, None), (7, 7, 9.0)], "r int, c int, v double")
    rasters.write_grid(part, f"{tmp_path}/cls", 0.0, 0.0, 1.0, 2, 2, kind="u1", nodata=255.0)
    assert [tuple(r) for r in rasters.read_grid(spark, f"{tmp_path}/cls").collect()] == [(0, 0, 3.0)]


def strips(order, cells, rows_per_strip, predictor=1):
    """A file of strips in either byte order, with the differences that the predictor takes."""
    h, w = cells.shape
    data = np.diff(cells, axis=1, prepend=cells.dtype.type(0)) if predictor == 2 else cells
    parts = [zlib.compress(data[k : k + rows_per_strip].astype(cells.dtype.newbyteorder(order)).tobytes()) for k in range(0, h, rows_per_strip)]
    starts = [8 + sum(map(len, parts[:k])) for k in range(len(parts))]
    at = 8 + sum(map(len, parts))
    n = len(parts)
    lists = struct.pack(f"{order}{2 * n}I", *starts, *map(len, parts))
    entries = [(256, 3, 1, w), (257, 3, 1, h), (258, 3, 1, 8 * cells.itemsize), (259, 3, 1, 8), (273, 4, n, at), (277, 3, 1, 1), (278, 3, 1, rows_per_strip), (279, 4, n, at + 4 * n), (317, 3, 1, predictor), (339, 3, 1, 1)]
    body = b"".join(struct.pack(f"{order}HHI", t, k, c) + (struct.pack(f"{order}HH", v, 0) if k == 3 else struct.pack(f"{order}I", v)) for t, k, c, v in entries)
    head = (b"II" if order == "<" else b"MM") + struct.pack(f"{order}HI", 42, at + len(lists))
    return head + b"".join(parts) + lists + struct.pack(f"{order}H", len(entries)) + body + struct.pack(f"{order}I", 0)


@pytest.mark.parametrize("order", ["<", ">"])
@pytest.mark.parametrize("predictor", [1, 2])
def test_strips_in_both_byte_orders(spark, tmp_path, order, predictor):
    cells = np.random.default_rng(3).integers(0, 60_000, (11, 7)).astype(np.uint16)
    (tmp_path / "s.tif").write_bytes(strips(order, cells, 4, predictor))
    found = rasters.read_grid(spark, f"{tmp_path}/s.tif")
    assert {(r["r"], r["c"]): r["v"] for r in found.collect()} == {k: float(v) for k, v in np.ndenumerate(cells)}


def exif(order, tags):
    """A TIFF block whose first directory points to a position block of (tag, kind, values)."""
    sizes = {2: 1, 1: 1, 5: 8}
    gps_at, n = 26, len(tags)
    rest, entries, body = gps_at + 2 + 12 * n + 4, b"", b""
    for tag, kind, values in tags:
        data = values if isinstance(values, bytes) else struct.pack(f"{order}{len(values)}{'I' if kind == 5 else 'B'}", *values)
        entries += struct.pack(f"{order}HHI", tag, kind, len(data) // sizes[kind])
        if len(data) > 4:
            entries += struct.pack(f"{order}I", rest + len(body))
            body += data
        else:
            entries += data.ljust(4, b"\0")
    head = (b"II" if order == "<" else b"MM") + struct.pack(f"{order}HI", 42, 8) + struct.pack(f"{order}HHHII", 1, 34853, 4, 1, gps_at) + struct.pack(f"{order}I", 0)
    return head + struct.pack(f"{order}H", n) + entries + struct.pack(f"{order}I", 0) + body


def jpeg(block):
    other = b"\xff\xe0" + struct.pack(">H", 16) + b"JFIF\0" + bytes(9)
    return b"\xff\xd8" + other + b"\xff\xe1" + struct.pack(">H", len(block) + 8) + b"Exif\0\0" + block + b"\xff\xda" + bytes(500_000)


LAT, LON = (32, 1, 30, 1, 36, 1), (35, 1, 0, 1, 1800, 100)


@pytest.mark.parametrize("whole", [False, True])
def test_positions_of_photos(spark, tmp_path, whole):
    full = [(1, 2, b"S\0"), (2, 5, LAT), (3, 2, b"W\0"), (4, 5, LON), (5, 1, (1,)), (6, 5, (1863, 10))]
    photos = {
        "little.jpg": jpeg(exif("<", full)), "big.jpg": jpeg(exif(">", full)), "plain.jpg": jpeg(exif("<", [(2, 5, LAT), (4, 5, LON)])), "bare.tif": exif(">", full),
        "half.jpg": jpeg(exif("<", [(2, 5, LAT)])), "zero.jpg": jpeg(exif("<", [(2, 5, (32, 0, 1, 1, 1, 1)), (4, 5, LON)])), "none.jpg": b"\xff\xd8\xff\xda" + bytes(100), "cut.jpg": jpeg(exif("<", full))[:60],
    }
    for name, data in photos.items():
        (tmp_path / name).write_bytes(data)
    got = {r["name"]: (r["lat"], r["lon"], r["alt"]) for r in rasters.position_fixes(spark, str(tmp_path), whole=whole).collect()}
    south = (pytest.approx(-32.51), pytest.approx(-35.005), pytest.approx(-186.3))
    assert got == {n: south for n in ("little.jpg", "big.jpg", "bare.tif")} | {"plain.jpg": (pytest.approx(32.51), pytest.approx(35.005), 0.0)} | {n: (None, None, None) for n in ("half.jpg", "zero.jpg", "none.jpg", "cut.jpg")}


def test_unknown_layouts_are_errors():
    with pytest.raises(ValueError, match="not a TIFF"):
        tiff.grid(lambda at, size: b"PNG....."[at : at + size])
