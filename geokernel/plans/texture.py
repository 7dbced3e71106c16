"""Queries of texture blending over the lattice mesh and views planted above it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geokernel.operators import mesh, texture
from geokernel.operators.tables import written
from geokernel.plans.catalogue import query
from geokernel.sources import adapters as A
from geokernel.sources.adapters import with_views

#: Pixels of a view and of a page.
WIDTH, HEIGHT, PAGE = 64, 48, 48
_HEADER = f"P6\n{WIDTH} {HEIGHT}\n255\n"


def _views(spark: SparkSession, d: str) -> DataFrame:
    """Cameras of suppliers that look straight down from a height of 12."""
    k = F.col("s_suppkey")
    x, y = k * 7 % 20 + 0.5, k + 0.25
    pose = F.array(*map(F.lit, (1.0, 0.0, 0.0, 0.0, -1.0, 0.0, 0.0, 0.0, -1.0)))
    number = lambda v: F.lit(float(v))
    return A.table(spark, d, "supplier").select(k.alias("view"), pose.alias("r"), F.array(-x, y, number(12)).alias("t"), number(40).alias("f"), number(WIDTH / 2).alias("cx"), number(HEIGHT / 2).alias("cy"), number(WIDTH).alias("width"), number(HEIGHT).alias("height"))


def _images(spark: SparkSession, d: str) -> DataFrame:
    """(view, content): pixmaps whose bands are sums of the view's number, row and column."""
    at = np.arange(3 * WIDTH * HEIGHT)
    steps = at // (3 * WIDTH) * 3 + at // 3 % WIDTH * 5 + at % 3 * 11

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for view in batch["view"].to_pylist():
                content = _HEADER.encode() + ((view * 7 + steps) % 256).astype(np.uint8).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([view], pa.int64()), pa.array([content], pa.binary())], ["view", "content"])

    return A.table(spark, d, "supplier").select(F.col("s_suppkey").cast("long").alias("view")).mapInArrow(draw, "view long, content binary")


def _uv(tri: DataFrame) -> DataFrame:
    page = F.floor(F.col("v0") / 400).cast("long")
    return tri.select("fid", page.alias("page"), *[(F.col(f"x{k}") / 20 + 1 / 64).alias(f"u{k}") for k in mesh.CORNERS], *[((F.col(f"y{k}") - 20 * page) / 21).alias(f"v{k}") for k in mesh.CORNERS])


def _bary(px: str, py: str, a: str, b: str) -> str:
    """Weights w0, w1, w2 of (px, py) in the triangle of columns a0, b0 .. a2, b2, as columns."""
    area = f"(({a}1 - {a}0) * ({b}2 - {b}0) - ({b}1 - {b}0) * ({a}2 - {a}0))"
    det = f"CASE WHEN abs({area}) > 1e-12 THEN {area} END"
    v = f"(({px} - {a}0) * ({b}2 - {b}0) - ({py} - {b}0) * ({a}2 - {a}0)) / {det}"
    w = f"(({a}1 - {a}0) * ({py} - {b}0) - ({b}1 - {b}0) * ({px} - {a}0)) / {det}"
    return f"{v} AS w1, {w} AS w2, 1.0::DOUBLE - w1 - w2 AS w0"


_U = "40.0::DOUBLE * ({x} - ox) / (12.0::DOUBLE - {z}) + 32"
_V = "40.0::DOUBLE * (oy - {y}) / (12.0::DOUBLE - {z}) + 24"
_CORNERS = ", ".join(f"({_U.format(x=f'x{k}', z=f'z{k}')}) / 4 AS u{k}, ({_V.format(y=f'y{k}', z=f'z{k}')}) / 4 AS v{k}, 12.0::DOUBLE - z{k} AS d{k}" for k in (0, 1, 2))
_SEEN = f"""views AS (SELECT s_suppkey AS view, CAST(s_suppkey * 7 % 20 AS DOUBLE) + 0.5 AS ox, CAST(s_suppkey AS DOUBLE) + 0.25 AS oy FROM supplier),
placed AS (SELECT fid, view, {_CORNERS} FROM triangles, views),
boxed AS (SELECT * FROM (SELECT *, greatest(floor(least(u0, u1, u2)), 0) AS c0, least(ceil(greatest(u0, u1, u2)) + 1, 16) AS c1, greatest(floor(least(v0, v1, v2)), 0) AS r0, least(ceil(greatest(v0, v1, v2)) + 1, 12) AS r1 FROM placed) WHERE c1 > c0 AND r1 > r0 AND c1 - c0 <= 32 AND r1 - r0 <= 32),
rows_ AS (SELECT *, unnest(range(CAST(r0 AS BIGINT), CAST(r1 AS BIGINT))) AS r FROM boxed),
cells_ AS (SELECT *, unnest(range(CAST(c0 AS BIGINT), CAST(c1 AS BIGINT))) AS c FROM rows_),
weighed AS (SELECT view, r, c, d0, d1, d2, {_bary("(c + 0.5::DOUBLE)", "(r + 0.5::DOUBLE)", "u", "v")} FROM cells_),
depth AS (SELECT view, r, c, min(w0 * d0 + w1 * d1 + w2 * d2) AS depth FROM weighed WHERE w0 >= 0 AND w1 >= 0 AND w2 >= 0 GROUP BY ALL),
face AS (SELECT fid, (x0 + x1 + x2) / 3 AS x, (y0 + y1 + y2) / 3 AS y, (z0 + z1 + z2) / 3 AS z, (y1 - y0) * (z2 - z0) - (z1 - z0) * (y2 - y0) AS nx, (z1 - z0) * (x2 - x0) - (x1 - x0) * (z2 - z0) AS ny, (x1 - x0) * (y2 - y0) - (y1 - y0) * (x2 - x0) AS nz FROM triangles),
ray AS (SELECT *, sqrt(nx * nx + ny * ny + nz * nz) AS size, (ox - x) ** 2 + (oy - y) ** 2 + (12 - z) ** 2 AS d2, {_U.format(x="x", z="z")} AS u, {_V.format(y="y", z="z")} AS v FROM face, views),
front AS (SELECT *, ((ox - x) * nx + (oy - y) * ny + (12 - z) * nz) / size / sqrt(d2) AS cosine FROM ray WHERE u >= 4 AND u < 60 AND v >= 4 AND v < 44),
seen AS (SELECT fid, view, cosine * cosine / d2 AS weight FROM front f LEFT JOIN depth d USING (view) WHERE cosine > 0.15::DOUBLE AND d.r = least(floor(v / 4), 11) AND d.c = least(floor(u / 4), 15) AND 12 - z <= depth * 1.01::DOUBLE + 0.05::DOUBLE
  UNION ALL SELECT fid, view, cosine * cosine / d2 FROM front f WHERE cosine > 0.15::DOUBLE AND NOT EXISTS (SELECT 1 FROM depth d WHERE d.view = f.view AND d.r = least(floor(f.v / 4), 11) AND d.c = least(floor(f.u / 4), 15))),
ranked AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY fid ORDER BY weight DESC, view) AS k, max(weight) OVER (PARTITION BY fid) AS best FROM seen) WHERE k <= 4 AND weight >= 0.15::DOUBLE * best),
chosen AS MATERIALIZED (SELECT fid, view, weight / sum(weight) OVER (PARTITION BY fid) AS share FROM ranked)"""


@query(with_views(_SEEN + " SELECT fid, view, round(weight, 12) AS weight FROM seen", "vertices", "faces", "triangles"))
def visible_faces(spark: SparkSession, d: str) -> DataFrame:
    tri = written(mesh.triangles(A.vertices(spark, d), A.faces(spark, d)), "triangles")
    return texture.face_views(tri, _views(spark, d)).withColumn("weight", F.round("weight", 12))


_TAP = "({w}) * ((view * 7 + ({r}) * 3 + ({c}) * 5 + {b}) % 256)"


def _sample(b: int) -> str:
    taps = [_TAP.format(w=f"{v} * {u}", r=f"sr + {dr}", c=f"sc + {dc}", b=b) for dr, v in ((0, "(1 - fv)"), (1, "fv")) for dc, u in ((0, "(1 - fu)"), (1, "fu"))]
    return " + ".join(taps)


_BAKED = f"""{_SEEN},
uv AS (SELECT triangles.*, v0 // 400 AS page FROM triangles),
px AS (SELECT *, {", ".join(f"(x{k} / 20 + 1 / 64::DOUBLE) * {PAGE - 1} AS px{k}, (1.0::DOUBLE - (y{k} - 20 * page) / 21) * {PAGE - 1} AS py{k}" for k in (0, 1, 2))} FROM uv),
pbox AS (SELECT * FROM (SELECT *, greatest(floor(least(px0, px1, px2)), 0) AS c0, least(ceil(greatest(px0, px1, px2)), {PAGE - 1}) AS c1, greatest(floor(least(py0, py1, py2)), 0) AS r0, least(ceil(greatest(py0, py1, py2)), {PAGE - 1}) AS r1 FROM px) WHERE c1 >= c0 AND r1 >= r0),
prow AS (SELECT *, unnest(range(CAST(r0 AS BIGINT), CAST(r1 AS BIGINT) + 1)) AS tr FROM pbox),
pcell AS (SELECT *, unnest(range(CAST(c0 AS BIGINT), CAST(c1 AS BIGINT) + 1)) AS tc FROM prow),
texel AS (SELECT fid, page, tr, tc, w0 * x0 + w1 * x1 + w2 * x2 AS x, w0 * y0 + w1 * y1 + w2 * y2 AS y, w0 * z0 + w1 * z1 + w2 * z2 AS z FROM (SELECT *, {_bary("(tc + 0.5::DOUBLE)", "(tr + 0.5::DOUBLE)", "px", "py")} FROM pcell) WHERE w0 >= -0.02::DOUBLE AND w1 >= -0.02::DOUBLE AND w2 >= -0.02::DOUBLE),
spot AS (SELECT view, fid, page, tr, tc, share, greatest(0::DOUBLE, least({WIDTH} - 1.001::DOUBLE, {_U.format(x="x", z="z")})) AS u, greatest(0::DOUBLE, least({HEIGHT} - 1.001::DOUBLE, {_V.format(y="y", z="z")})) AS v FROM texel JOIN chosen USING (fid) JOIN views USING (view)),
tap AS (SELECT *, CAST(floor(u) AS BIGINT) AS sc, CAST(floor(v) AS BIGINT) AS sr, u - floor(u) AS fu, v - floor(v) AS fv FROM spot),
colour AS (SELECT *, {_sample(0)} AS red, {_sample(11)} AS green, {_sample(22)} AS blue FROM tap),
mixed AS (SELECT page, tr, tc, fid, {", ".join(f"sum(share * {b}) / sum(share) AS {b}" for b in texture.BANDS)} FROM colour GROUP BY ALL)"""


@query(with_views(f"{_BAKED} SELECT page, tr AS r, tc AS c, {', '.join(f'CAST(floor(avg({b})) AS INT) AS {b}' for b in texture.BANDS)} FROM mixed GROUP BY page, tr, tc", "vertices", "faces", "triangles"))
def baked_texels(spark: SparkSession, d: str) -> DataFrame:
    """Every texel of the lattice's pages, mixed from the images of the views that see its faces."""
    tri = written(mesh.triangles(A.vertices(spark, d), A.faces(spark, d)), "triangles")
    uv = _uv(tri)
    pages = uv.select("page").distinct().select("page", F.lit(PAGE).cast("long").alias("width"), F.lit(PAGE).cast("long").alias("height"))
    return texture.baked(tri, uv, pages, _views(spark, d), _images(spark, d))


_MEAN = "(" + " + ".join(f"(view * 7 + (sr + {i}) * 3 + (sc + {j}) * 5 + {{b}}) % 256" for i in (-1, 0, 1) for j in (-1, 0, 1)) + ") / 9::DOUBLE"


@query(f"""WITH o AS (SELECT l_suppkey AS view, l_orderkey * 8 + l_linenumber AS ordinal, l_partkey AS pid, CAST((l_orderkey * 8 + l_linenumber) * 31 % 6400 AS DOUBLE) / 100 AS u, CAST((l_orderkey * 8 + l_linenumber) * 17 % 4800 AS DOUBLE) / 100 AS v FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier)),
k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY view ORDER BY md5(pid || ':' || ordinal), ordinal) AS n, CAST(round_even(u, 0) AS BIGINT) AS sc, CAST(round_even(v, 0) AS BIGINT) AS sr FROM o) WHERE n <= 1500 AND sc BETWEEN 1 AND {WIDTH - 2} AND sr BETWEEN 1 AND {HEIGHT - 2}),
m AS (SELECT view, pid, ordinal, u, v, {_MEAN.format(b=0)} AS red, {_MEAN.format(b=11)} AS green, {_MEAN.format(b=22)} AS blue FROM k)
SELECT view, pid, ordinal, round(2 * u / {WIDTH} - 1, 9) AS x, round(2 * v / {HEIGHT} - 1, 9) AS y, round(red, 9) AS red, round(green, 9) AS green, round(blue, 9) AS blue FROM m WHERE least(red, green, blue) >= 8 AND greatest(red, green, blue) <= 247""")
def sampled_observations(spark: SparkSession, d: str) -> DataFrame:
    """Colours at the observed points of line items in the suppliers' images: at most 1,500 of an
    image, as the exposure solve takes them."""
    k = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    obs = A.table(spark, d, "lineitem").select(F.col("l_suppkey").alias("view"), k.alias("ordinal"), F.col("l_partkey").alias("pid"), (k * 31 % 6400 / F.lit(100.0)).alias("u"), (k * 17 % 4800 / F.lit(100.0)).alias("v"))
    found = texture.observed_colours(obs, _images(spark, d))
    return found.select("view", "pid", "ordinal", *[F.round(c, 9).alias(c) for c in ("x", "y", *texture.BANDS)])
