"""Queries of the column functions: rotations, lenses, cell sizes, exports, samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geokernel.functions import scalar as S
from geokernel.operators import grid, mesh, neighbours, tiling
from geokernel.plans.catalogue import D, query
from geokernel.sources import adapters as A
from geokernel.sources import sinks, survey
from geokernel.sources.adapters import with_views

def _k() -> Column:
    return F.col("c_custkey")


def _customers(spark: SparkSession, d: str) -> DataFrame:
    return A.table(spark, d, "customer")


def _quaternion() -> list[Column]:
    return [(1 + _k() % 3).cast("double"), (_k() % 5 - 2).cast("double"), (_k() % 7 - 3).cast("double"), (_k() % 11 - 5).cast("double")]


def _rounded(values, digits: int = 9) -> list[Column]:
    # Adding zero turns a negative zero into a positive one.
    return [F.round(v, digits) + 0.0 for v in values]


_R = """q AS (SELECT c_custkey AS k, CAST(1 + c_custkey % 3 AS DOUBLE) AS w, CAST(c_custkey % 5 - 2 AS DOUBLE) AS x, CAST(c_custkey % 7 - 3 AS DOUBLE) AS y, CAST(c_custkey % 11 - 5 AS DOUBLE) AS z FROM customer),
u AS (SELECT k, w / n AS w, x / n AS x, y / n AS y, z / n AS z FROM (SELECT *, sqrt(w * w + x * x + y * y + z * z) AS n FROM q)),
r AS (SELECT k, w, x, y, z, 1 - 2 * (y * y + z * z) AS r0, 2 * (x * y - w * z) AS r1, 2 * (x * z + w * y) AS r2, 2 * (x * y + w * z) AS r3, 1 - 2 * (x * x + z * z) AS r4, 2 * (y * z - w * x) AS r5, 2 * (x * z - w * y) AS r6, 2 * (y * z + w * x) AS r7, 1 - 2 * (x * x + y * y) AS r8 FROM u)"""


@query(f"WITH {_R} SELECT k, " + ", ".join(f"round(r{i}, 9) + 0 AS r{i}" for i in range(9)) + " FROM r")
def quaternion_rotation(spark: SparkSession, d: str) -> DataFrame:
    r = S.quat_to_rot(*_quaternion())
    return _customers(spark, d).select(_k().alias("k"), r.alias("r")).select("k", *[v.alias(f"r{i}") for i, v in enumerate(_rounded(F.col("r")[i] for i in range(9)))])


_PRODUCTS = [(a, b) for i, a in enumerate("wxyz") for b in "wxyz"[i:]]


@query(f"WITH {_R} SELECT k, " + ", ".join(f"round({a} * {b}, 9) + 0 AS {a}{b}" for a, b in _PRODUCTS) + " FROM r")
def rotation_quaternion(spark: SparkSession, d: str) -> DataFrame:
    """Quaternions of all rotations, by the products of their parts: those do not depend on the
    sign, which is free where two parts tie for the pivot."""
    rows = _customers(spark, d).select(_k().alias("k"), S.quat_to_rot(*_quaternion()).alias("r"))
    q = rows.select("k", S.rot_to_quat([F.col("r")[i] for i in range(9)]).alias("q"))
    part = {c: F.col("q")[i] for i, c in enumerate("wxyz")}
    products = _rounded(part[a] * part[b] for a, b in _PRODUCTS)
    return q.select("k", *[v.alias(a + b) for v, (a, b) in zip(products, _PRODUCTS, strict=True)])


_AXIS = ", ".join(f"round(CASE WHEN a < 1e-8 THEN 0 ELSE a / (2 * sin(a)) * ({x} - {y}) END, 7) + 0 AS {n}" for n, x, y in (("ax", "r7", "r5"), ("ay", "r2", "r6"), ("az", "r3", "r1")))


@query(f"WITH {_R}, a AS (SELECT *, acos(greatest(-1, least(1, (r0 + r4 + r8 - 1) / 2))) AS a FROM r) SELECT k, {_AXIS} FROM a")
def rotation_axis_angle(spark: SparkSession, d: str) -> DataFrame:
    rows = _customers(spark, d).select(_k().alias("k"), S.quat_to_rot(*_quaternion()).alias("r"))
    axis = S.rot_to_axis_angle([F.col("r")[i] for i in range(9)])
    return rows.select("k", *[v.alias(n) for v, n in zip(_rounded(axis, 7), ("ax", "ay", "az"), strict=True)])


_MODELS = ("SIMPLE_PINHOLE", "PINHOLE", "SIMPLE_RADIAL", "RADIAL", "OPENCV", "FULL_OPENCV", "OPENCV_FISHEYE")
_NUMBERS = (0, 1, 1, 2, 4, 8, 4)


def _lens(spark: SparkSession, d: str) -> DataFrame:
    """(k, model, params, x, y): the seven lens models in turn, with small coefficients."""
    i = (_k() % 7).cast("int")
    model = F.get(F.array(*map(F.lit, _MODELS)), i)
    single = i.isin(0, 2, 3)
    size = F.get(F.array(*map(F.lit, _NUMBERS)), i)
    focal = F.when(single, F.array((1000 + _k() % 100).cast("double"))).otherwise(F.array((1000 + _k() % 100).cast("double"), (1100 + _k() % 50).cast("double")))
    bends = F.slice(F.array(*[((_k() * (j + 3)) % 16 - 8) / F.lit(1024.0) for j in range(8)]), F.lit(1), size)
    params = F.concat(focal, F.array(F.lit(640.0), F.lit(480.0)), bends)
    return _customers(spark, d).select(_k().alias("k"), model.alias("model"), params.alias("params"), (_k() * 7 % 64 / F.lit(128.0) - 0.25).alias("x"), (_k() * 11 % 64 / F.lit(128.0) - 0.25).alias("y"))


_LENS = """lens AS (SELECT c_custkey AS k, c_custkey % 7 AS i, CAST(1000 + c_custkey % 100 AS DOUBLE) AS fx, CASE WHEN c_custkey % 7 IN (0, 2, 3) THEN CAST(1000 + c_custkey % 100 AS DOUBLE) ELSE CAST(1100 + c_custkey % 50 AS DOUBLE) END AS fy,
  CASE c_custkey % 7 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 1 WHEN 3 THEN 2 WHEN 4 THEN 4 WHEN 5 THEN 8 ELSE 4 END AS m, CAST(c_custkey * 7 % 64 AS DOUBLE) / 128 - 0.25::DOUBLE AS x, CAST(c_custkey * 11 % 64 AS DOUBLE) / 128 - 0.25::DOUBLE AS y FROM customer)"""
_COEFFICIENTS = ", ".join(f"CASE WHEN m > {j} THEN CAST(k * {j + 3} % 16 - 8 AS DOUBLE) / 1024 ELSE 0 END AS k{j}" for j in range(8))


@query(f"WITH {_LENS} SELECT k, fx, fy, {D('640')} AS cx, {D('480')} AS cy, m AS coefficients, CASE WHEN m > 0 THEN CAST(k * 3 % 16 - 8 AS DOUBLE) / 1024 END AS first FROM lens")
def intrinsics_split(spark: SparkSession, d: str) -> DataFrame:
    p = S.intrinsics(F.col("model"), F.col("params"))
    return _lens(spark, d).select("k", p.alias("p")).select("k", "p.fx", "p.fy", "p.cx", "p.cy", F.size("p.dist").alias("coefficients"), F.get("p.dist", 0).alias("first"))


_BENT = f"""{_LENS}, c AS (SELECT *, x * x + y * y AS r2, {_COEFFICIENTS} FROM lens),
b AS (SELECT k, i, x, y, atan(sqrt(r2)) AS a, sqrt(r2) AS r, CASE i WHEN 2 THEN 1 + k0 * r2 WHEN 3 THEN 1 + r2 * (k0 + r2 * k1) ELSE (1 + r2 * (k0 + r2 * (k1 + r2 * k4))) / (1 + r2 * (k5 + r2 * (k6 + r2 * k7))) END AS s,
  2 * k2 * x * y + k3 * (r2 + 2 * x * x) AS tx, k2 * (r2 + 2 * y * y) + 2 * k3 * x * y AS ty, k0, k1, k2, k3 FROM c),
f AS (SELECT *, CASE WHEN r < 1e-12 THEN 1 ELSE a * (1 + a * a * (k0 + a * a * (k1 + a * a * (k2 + a * a * k3)))) / r END AS fish FROM b),
bent AS (SELECT k, x, y, CASE WHEN i IN (2, 3) THEN x * s WHEN i IN (4, 5) THEN x * s + tx WHEN i = 6 THEN x * fish ELSE x END AS bent_x, CASE WHEN i IN (2, 3) THEN y * s WHEN i IN (4, 5) THEN y * s + ty WHEN i = 6 THEN y * fish ELSE y END AS bent_y FROM f)"""


def _with_bent(spark: SparkSession, d: str) -> DataFrame:
    p = S.intrinsics(F.col("model"), F.col("params"))
    rows = _lens(spark, d).withColumn("dist", p["dist"])
    return rows.withColumn("bent", S.distort(F.col("model"), F.col("dist"), F.col("x"), F.col("y")))


@query(f"WITH {_BENT} SELECT k, round(bent_x, 12) + 0 AS bent_x, round(bent_y, 12) + 0 AS bent_y FROM bent")
def lens_distortion(spark: SparkSession, d: str) -> DataFrame:
    bx, by = _rounded((F.col("bent.x"), F.col("bent.y")), 12)
    return _with_bent(spark, d).select("k", bx.alias("bent_x"), by.alias("bent_y"))


@query("SELECT c_custkey AS k, CAST(c_custkey * 7 % 64 AS DOUBLE) / 128 - 0.25::DOUBLE AS x, CAST(c_custkey * 11 % 64 AS DOUBLE) / 128 - 0.25::DOUBLE AS y FROM customer")
def lens_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Bent points straightened again: the points that they were."""
    back = S.undistort(F.col("model"), F.col("dist"), F.col("bent.x"), F.col("bent.y"))
    rows = _with_bent(spark, d).select("k", back.alias("p"))
    x, y = _rounded((F.col("p.x"), F.col("p.y")), 9)
    return rows.select("k", x.alias("x"), y.alias("y"))


@query("SELECT k, round(CASE WHEN z > 1e-6 THEN f * x / z + 640 END, 9) AS u, round(CASE WHEN z > 1e-6 THEN f * y / z + 480 END, 9) AS v, CASE WHEN c > 0.15::DOUBLE THEN c * c / (x * x + y * y + z * z) END AS weight FROM (SELECT c_custkey AS k, CAST(c_custkey % 33 - 16 AS DOUBLE) / 4 AS x, CAST(c_custkey % 29 - 14 AS DOUBLE) / 4 AS y, CAST(c_custkey % 13 - 4 AS DOUBLE) / 2 AS z, CAST(1000 + c_custkey % 100 AS DOUBLE) AS f, CAST(c_custkey % 64 AS DOUBLE) / 64 AS c FROM customer) WHERE x * x + y * y + z * z > 0")
def pinhole_views(spark: SparkSession, d: str) -> DataFrame:
    x, y, z = (_k() % 33 - 16) / F.lit(4.0), (_k() % 29 - 14) / F.lit(4.0), (_k() % 13 - 4) / F.lit(2.0)
    f = (1000 + _k() % 100).cast("double")
    u, v = S.pinhole((x, y, z), f, f, F.lit(640.0), F.lit(480.0))
    d2 = x * x + y * y + z * z
    rows = _customers(spark, d).filter(d2 > 0)
    return rows.select(_k().alias("k"), F.round(u, 9).alias("u"), F.round(v, 9).alias("v"), S.view_weight(_k() % 64 / F.lit(64.0), d2).alias("weight"))


@query("SELECT c_custkey AS k, c_custkey % 7 > 0 AS whole, CASE WHEN c_custkey % 7 > 0 THEN round(list_sum(list_transform(range(1, 17), lambda i: CAST(c_custkey * i % 97 AS DOUBLE) / 4)), 9) END AS total, CASE WHEN c_custkey % 7 > 0 THEN CAST(c_custkey * 5 % 97 AS DOUBLE) / 4 END AS fifth FROM customer")
def matrix_texts(spark: SparkSession, d: str) -> DataFrame:
    numbers = F.transform(F.sequence(F.lit(1), F.when(_k() % 7 > 0, 16).otherwise(15)), lambda i: (_k() * i % 97 / F.lit(4.0)).cast("string"))
    m = S.parse_matrix(F.concat(F.lit("  "), F.array_join(numbers, " \n")))
    rows = _customers(spark, d).select(_k().alias("k"), m.alias("m"))
    return rows.select("k", F.col("m").isNotNull().alias("whole"), F.round(F.aggregate("m", F.lit(0.0), lambda a, x: a + x), 9).alias("total"), F.get("m", 4).alias("fifth"))


@query("SELECT k, x, y, x * x AS xx, x * y AS xy, y * y AS yy, round(v / greatest(0.4::DOUBLE, least(2.5::DOUBLE, exp(g + greatest(-ln(1.6::DOUBLE), least(ln(1.6::DOUBLE), x + y))))), 9) AS corrected FROM (SELECT c_custkey AS k, CAST(c_custkey % 32 - 16 AS DOUBLE) / 16 AS x, CAST(c_custkey * 7 % 32 - 16 AS DOUBLE) / 16 AS y, CAST(c_custkey % 256 AS DOUBLE) AS v, CAST(c_custkey % 17 - 8 AS DOUBLE) / 16 AS g FROM customer)")
def photometric_correction(spark: SparkSession, d: str) -> DataFrame:
    x, y = (_k() % 32 - 16) / F.lit(16.0), (_k() * 7 % 32 - 16) / F.lit(16.0)
    basis = S.quadratic_basis(x, y)
    corrected = S.photometric((_k() % 256).cast("double"), (_k() % 17 - 8) / F.lit(16.0), x + y)
    return _customers(spark, d).select(_k().alias("k"), *[b.alias(n) for b, n in zip(basis, ("x", "y", "xx", "xy", "yy"), strict=True)], F.round(corrected, 9).alias("corrected"))


@query(
    """WITH s AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 5 > 0 THEN CAST(c_custkey * 7919 % 9000 AS DOUBLE) / 4 END AS w, CAST(c_custkey * 31 % 9000 AS DOUBLE) / 4 AS h, CASE WHEN c_custkey % 3 = 0 THEN CAST(1 + c_custkey % 20 AS DOUBLE) / 2 END AS cm FROM customer),
g AS (SELECT *, coalesce(cm / 100, CASE WHEN w IS NULL THEN 0.05::DOUBLE ELSE greatest(0.01::DOUBLE, least(1, sqrt(w * w + h * h) / 4096)) END) AS gsd FROM s)
SELECT k, round(gsd, 12) AS gsd, round(gsd * 2 ** greatest(0, ceil(ln(1e6::DOUBLE * 4 / (gsd * gsd * 3e7)) / ln(4.0::DOUBLE))), 12) AS fitted FROM g"""
)
def cell_sizes(spark: SparkSession, d: str) -> DataFrame:
    w = F.when(_k() % 5 > 0, _k() * 7919 % 9000 / F.lit(4.0))
    cm = F.when(_k() % 3 == 0, (1 + _k() % 20) / F.lit(2.0))
    rows = _customers(spark, d).select(_k().alias("k"), S.resolve_gsd(w, _k() * 31 % 9000 / F.lit(4.0), cm).alias("gsd"))
    return rows.select("k", F.round("gsd", 12).alias("gsd"), F.round(S.budget_gsd(F.col("gsd"), F.lit(1e6), 4.0, 3e7), 12).alias("fitted"))


@query("SELECT CAST(l_suppkey AS BIGINT) AS view, CAST(floor(l_quantity) AS BIGINT) % 16 AS r, l_partkey % 16 AS c, min(CAST(floor(l_extendedprice) AS BIGINT) % 1000 / CAST(8 AS DOUBLE)) AS z FROM lineitem GROUP BY 1, 2, 3")
def view_depths(spark: SparkSession, d: str) -> DataFrame:
    """Nearest depth of each pixel of each view, over fragments read off the line items."""
    li = A.table(spark, d, "lineitem")
    z = F.floor("l_extendedprice").cast("long") % 1000 / F.lit(8.0)
    return mesh.depth_map(li.select(F.col("l_suppkey").cast("long").alias("view"), (F.floor("l_quantity").cast("long") % 16).alias("r"), (F.col("l_partkey") % 16).alias("c"), z.alias("z")))


@query(
    with_views(
        """s AS (SELECT c_custkey AS id, greatest(0, least(CAST(23 AS DOUBLE) - 0.001::DOUBLE, CAST(c_custkey * 7 % 200 AS DOUBLE) / 8)) AS u, greatest(0, least(CAST(29 AS DOUBLE) - 0.001::DOUBLE, CAST(c_custkey * 11 % 240 AS DOUBLE) / 8)) AS v FROM customer),
p AS (SELECT id, CAST(floor(v) AS BIGINT) AS r0, CAST(floor(u) AS BIGINT) AS c0, u - floor(u) AS fu, v - floor(v) AS fv FROM s),
w AS (SELECT id, r0 + dr AS r, c0 + dc AS c, (CASE dr WHEN 1 THEN fv ELSE 1 - fv END) * (CASE dc WHEN 1 THEN fu ELSE 1 - fu END) AS w FROM p, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) AS o(dr, dc))
SELECT id, round(sum(w * v), 6) AS value FROM w JOIN rast_a USING (r, c) GROUP BY id""",
        "rast_a",
    )
)
def image_samples(spark: SparkSession, d: str) -> DataFrame:
    image = A.raster(spark, d, 0).withColumnRenamed("v", "value")
    at = _customers(spark, d).select(_k().alias("id"), (_k() * 7 % 200 / F.lit(8.0)).alias("u"), (_k() * 11 % 240 / F.lit(8.0)).alias("v"))
    return mesh.bilinear(at, image, 24, 30).select("id", F.round("value", 6).alias("value"))


@query(with_views("near AS (SELECT a.name, min((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS d2 FROM centres a, centres b WHERE a.name <> b.name GROUP BY a.name) SELECT round(median(sqrt(d2)), 9) AS spacing FROM near WHERE d2 > 0", "centres"))
def centre_spacing(spark: SparkSession, d: str) -> DataFrame:
    points = A.centres(spark, d).select(F.xxhash64("name").alias("id"), "x", "y")
    return neighbours.spacing(points, axes=("x", "y")).select(F.round("spacing", 9).alias("spacing"))


@query("SELECT c_custkey AS k, greatest(1, CAST(ceil(CAST(c_custkey * 7919 % 2000000 AS DOUBLE) * CASE c_custkey % 4 WHEN 0 THEN 400 WHEN 1 THEN 100 WHEN 2 THEN 25 ELSE 8 END / 40000000) AS BIGINT)) AS tiles FROM customer")
def tile_counts(spark: SparkSession, d: str) -> DataFrame:
    factor = F.get(F.array(*map(F.lit, tiling.DENSITY_FACTORS)), (_k() % 4).cast("int"))
    n = (_k() * 7919 % 2_000_000).cast("double") * factor
    return _customers(spark, d).select(_k().alias("k"), tiling.tile_count(n, 40_000_000.0, 1.0).alias("tiles"))


@query("SELECT round_even(CAST(l_suppkey AS DOUBLE) + 0.25::DOUBLE, 4) AS wx, round_even(CAST(l_partkey % 50 AS DOUBLE) / 8, 4) AS wy, CAST(l_linenumber AS DOUBLE) AS wz, count(*) AS n, min_by('m' || l_orderkey || '_c1', l_orderkey) AS label, bool_or(l_orderkey % 2 = 0) AS is_check FROM lineitem GROUP BY 1, 2, 3")
def grouped_markings(spark: SparkSession, d: str) -> DataFrame:
    li = A.table(spark, d, "lineitem")
    rows = li.select(F.col("l_orderkey").alias("line"), (F.col("l_suppkey") + 0.25).alias("wx"), (F.col("l_partkey") % 50 / F.lit(8.0)).alias("wy"), F.col("l_linenumber").cast("double").alias("wz"), F.concat(F.lit("m"), F.col("l_orderkey").cast("string"), F.lit("_c1")).alias("label"), (F.col("l_orderkey") % 2 == 0).alias("is_check"))
    return survey.grouped_control(rows)


@query(f"WITH {_LENS} SELECT k, round(fx / 1280, 9) AS focal_x, round(fy / 1280, 9) AS focal_y, CASE WHEN i IN (4, 5) THEN 'brown' WHEN i = 6 THEN 'fisheye' ELSE 'perspective' END AS projection, m AS coefficients FROM lens")
def exported_intrinsics(spark: SparkSession, d: str) -> DataFrame:
    """The numbers of the camera documents, read back from their text."""
    cameras = _lens(spark, d).select(F.col("k").alias("camera_id"), "model", F.lit(1280).alias("width"), F.lit(960).alias("height"), "params")
    text = sinks.camera_documents(cameras)
    body = F.from_json("document", "projection_type string, focal_x double, focal_y double, distortion array<double>")
    k = F.element_at(F.split("key", " "), -1).cast("long")
    return text.select(k.alias("k"), body.alias("b")).select("k", F.round("b.focal_x", 9).alias("focal_x"), F.round("b.focal_y", 9).alias("focal_y"), F.col("b.projection_type").alias("projection"), F.size("b.distortion").alias("coefficients"))


@query(with_views("SELECT count(*) AS valid, count(*) FILTER (WHERE v > 120) AS high FROM rast_a", "rast_a"))
def valid_pixels(spark: SparkSession, d: str) -> DataFrame:
    """How many cells of a raster have data: none is a reason to stop."""
    return grid.valid_cells(A.raster(spark, d, 0)).join(grid.valid_cells(A.raster(spark, d, 0).filter("v > 120")).withColumnRenamed("valid", "high"))
