"""Queries of radiometric solves and of change along surveyed normals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geokernel.operators import change, mesh, radiometry
from geokernel.operators import fit as fits
from geokernel.operators.tables import dealt
from geokernel.plans.catalogue import D, _points, query
from geokernel.sources import adapters as A
from geokernel.sources.adapters import with_views

_BANDS = radiometry.BANDS
_TERMS = radiometry.TERMS


def _each(template: str, sep: str = ", ", over=_BANDS) -> str:
    return sep.join(template.format(b) for b in over)


def _elimination() -> str:
    """Solves s c = t for the columns s_i_j (i <= j) and t0..t4 of a table: the columns c0..c4, by
    elimination without pivots and substitution backwards."""
    a = {(i, j): f"s_{i}_{j}" for i in _TERMS for j in range(i, 5)}
    t, steps = [f"t{k}" for k in _TERMS], []
    for k in _TERMS:
        for i in range(k + 1, 5):
            factor = f"({a[k, i]} / {a[k, k]})"
            for j in range(i, 5):
                steps.append(f"{a[i, j]} - {factor} * {a[k, j]} AS e{k}_{i}_{j}")
            steps.append(f"{t[i]} - {factor} * {t[k]} AS u{k}_{i}")
        for i in range(k + 1, 5):
            t[i] = f"u{k}_{i}"
            for j in range(i, 5):
                a[i, j] = f"e{k}_{i}_{j}"
    for k in reversed(_TERMS):
        known = "".join(f" - {a[k, j]} * c{j}" for j in range(k + 1, 5))
        steps.append(f"({t[k]}{known}) / {a[k, k]} AS c{k}")
    return ", ".join(steps)


def _photometric_sql(rounds: int) -> str:
    basis = ("x", "y", "x * x", "x * y", "y * y")
    pairs = [(i, j) for i in _TERMS for j in range(i, 5)]
    field = _each("d{0} * c{0}", " + ", _TERMS)
    grey = "(" + _each("e_{0}", " + ") + ") / 3"
    parts = [
        f"o AS (SELECT image, pt, {_each('ln(greatest({0}, 1)) AS l_{0}')}, {', '.join(f'{b} AS b{k}' for k, b in enumerate(basis))} FROM colours)",
        f"i0 AS (SELECT image, count(*) AS n, {_each('avg(b{0}) AS m{0}', over=_TERMS)} FROM o GROUP BY image)",
        f"d AS MATERIALIZED (SELECT image, pt, n, {_each('l_{0}')}, {_each('b{0} - m{0} AS d{0}', over=_TERMS)} FROM o JOIN i0 USING (image))",
        f"i AS MATERIALIZED (SELECT image, any_value(n) AS n, {', '.join(f'sum(d{i} * d{j})' + (f' + {radiometry.RIDGE}::DOUBLE * any_value(n)' if i == j else '') + f' AS s_{i}_{j}' for i, j in pairs)} FROM d GROUP BY image)",
        f"g0 AS (SELECT image, n, {_each('0::DOUBLE AS g_{0}')}, {_each('0::DOUBLE AS c{0}', over=_TERMS)} FROM i)",
    ]
    for k in range(rounds):
        parts += [
            f"p{k} AS (SELECT pt, {_each(f'avg(l_{{0}} - g_{{0}} - ({field})) AS a_{{0}}')} FROM d JOIN g{k} USING (image) GROUP BY pt)",
            f"e{k} AS (SELECT d.*, {_each('l_{0} - a_{0} AS e_{0}')} FROM d JOIN p{k} USING (pt))",
            f"f{k} AS (SELECT image, {_each('avg(e_{0}) AS e_{0}')}, {_each(f'sum(d{{0}} * {grey}) AS t{{0}}', over=_TERMS)} FROM e{k} GROUP BY image)",
            f"h{k} AS (SELECT *, {_elimination()} FROM f{k} JOIN i USING (image))",
            f"g{k + 1} AS MATERIALIZED (SELECT image, n, {_each(f'CASE WHEN n >= {radiometry.WEAK} THEN e_{{0}} ELSE 0 END AS g_{{0}}')}, {_each(f'CASE WHEN n >= {radiometry.SPATIAL} THEN c{{0}} ELSE 0 END AS c{{0}}', over=_TERMS)} FROM h{k})",
        ]
    parts.append(f"middle AS (SELECT {_each('coalesce(avg(g_{0}), 0) AS v_{0}')} FROM g{rounds} WHERE n >= {radiometry.WEAK})")
    gains = _each(f"round(CASE WHEN n >= {radiometry.WEAK} THEN greatest(ln(0.5::DOUBLE), least(ln(2::DOUBLE), g_{{0}} - v_{{0}})) ELSE 0 END, 6) + 0 AS g_{{0}}")
    return with_views(", ".join(parts) + f" SELECT image, n, {gains}, {_each('round(c{0}, 6) + 0 AS c{0}', over=_TERMS)} FROM g{rounds}, middle", "colours")


@query(_photometric_sql(3))
def photometric_gains(spark: SparkSession, d: str) -> DataFrame:
    """Three rounds of the solve for gains and fields over the colours of all line items."""
    found = radiometry.photometric_solve(A.colours(spark, d), rounds=3)
    return found.select("image", "n", *[(F.round(f"g_{b}", 6) + 0.0).alias(f"g_{b}") for b in _BANDS], *[(F.round(f"c{k}", 6) + 0.0).alias(f"c{k}") for k in _TERMS])


def _exposure_sql(rounds: int) -> str:
    parts = ["g0 AS (SELECT DISTINCT image, 0::DOUBLE AS g FROM obs)"]
    for k in range(rounds):
        parts.append(f"g{k + 1} AS (SELECT o.image, avg(o.logc - p.a) AS g FROM obs o JOIN (SELECT pt, avg(logc - g) AS a FROM obs JOIN g{k} USING (image) GROUP BY pt) p USING (pt) GROUP BY o.image)")
    parts += ["n AS (SELECT image, count(*) >= 20 AS strong FROM obs GROUP BY image)", f"m AS (SELECT avg(g) AS m FROM g{rounds} JOIN n USING (image) WHERE strong)"]
    return with_views(", ".join(parts) + f" SELECT image, round(CASE WHEN strong THEN greatest(0.5::DOUBLE, least(2::DOUBLE, exp(g - coalesce(m, 0)))) ELSE 1 END, 6) AS gain FROM g{rounds} JOIN n USING (image), m", "obs")


@query(_exposure_sql(5))
def exposure_gains(spark: SparkSession, d: str) -> DataFrame:
    return fits.exposure_gains(A.observations(spark, d), rounds=5).withColumn("gain", F.round("gain", 6))


def _patch_colours(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Patches of the lattice mesh (bands of 64 vertex numbers), and the colour that each of them
    gives a vertex."""
    faces = A.faces(spark, d)
    patch = faces.select("fid", F.floor(F.col("v0") / 64).cast("long").alias("patch"))
    corners = faces.join(dealt(patch), "fid").select("patch", F.explode(F.array("v0", "v1", "v2")).alias("vid")).distinct()
    band = lambda n: ((F.col("vid") * n + F.col("patch") * 37) % 256).cast("double")
    return patch, corners.select("vid", "patch", band(5).alias("red"), band(11).alias("green"), band(3).alias("blue"))


def _levelling_sql(rounds: int) -> str:
    """Conjugate gradients as a chain of tables; a band that is done takes steps of no length."""
    w, tol2 = "0.15::DOUBLE", "1e-6::DOUBLE"
    parts = [
        "patches AS (SELECT fid, v0 // 64 AS patch FROM faces)",
        "corner AS (SELECT DISTINCT patch, unnest([v0, v1, v2]) AS vid FROM faces JOIN patches USING (fid))",
        "colour AS (SELECT vid, patch, vid * 100000 + patch AS node, CAST((vid * 5 + patch * 37) % 256 AS DOUBLE) AS red, CAST((vid * 11 + patch * 37) % 256 AS DOUBLE) AS green, CAST((vid * 3 + patch * 37) % 256 AS DOUBLE) AS blue FROM corner)",
        f"seam AS (SELECT node, c.vid, c.patch, {_each('CASE WHEN k > 1 THEN m_{0} - {0} END AS {0}')} FROM colour c JOIN (SELECT vid, count(*) AS k, {_each('avg({0}) AS m_{0}')} FROM colour GROUP BY vid) USING (vid))",
        "side AS (SELECT DISTINCT vid_a * 100000 + patch AS a, vid_b * 100000 + patch AS b FROM (SELECT fid, unnest([v0, v1, v2, v1, v2, v0]) AS vid_a, unnest([v1, v2, v0, v0, v1, v2]) AS vid_b FROM faces) JOIN patches USING (fid))",
        "degree AS (SELECT a AS node, count(*) AS degree FROM side GROUP BY a)",
        f"s0 AS MATERIALIZED (SELECT node, coalesce(degree, 0) AS degree, {_each('CASE WHEN {0} IS NULL THEN 0 ELSE 1 END AS has_{0}, 0::DOUBLE AS x_{0}, coalesce({0}, 0) AS r_{0}, coalesce({0}, 0) AS p_{0}')} FROM seam LEFT JOIN degree USING (node))",
        f"rr0 AS MATERIALIZED (SELECT {_each('sum(r_{0} * r_{0}) AS rr_{0}')} FROM s0)",
    ]
    for k in range(rounds):
        step = f"CASE WHEN z.rr_{{0}} > {tol2} * n.rr_{{0}} AND pq_{{0}} <> 0 THEN z.rr_{{0}} / pq_{{0}} ELSE 0 END"
        parts += [
            f"q{k} AS MATERIALIZED (SELECT s.*, {_each(f'(has_{{0}} + {w} * degree) * s.p_{{0}} - {w} * coalesce(t_{{0}}, 0) AS q_{{0}}')} FROM s{k} s LEFT JOIN (SELECT a AS node, {_each('sum(p_{0}) AS t_{0}')} FROM side JOIN s{k} ON b = node GROUP BY a) USING (node))",
            f"a{k} AS (SELECT {_each(step + ' AS a_{0}')} FROM (SELECT {_each('sum(p_{0} * q_{0}) AS pq_{0}')} FROM q{k}), rr{k} z, rr0 n)",
            f"m{k} AS MATERIALIZED (SELECT node, degree, {_each('has_{0}, x_{0} + a_{0} * p_{0} AS x_{0}, r_{0} - a_{0} * q_{0} AS r_{0}, p_{0}')} FROM q{k}, a{k})",
            f"rr{k + 1} AS MATERIALIZED (SELECT {_each('sum(r_{0} * r_{0}) AS rr_{0}')} FROM m{k})",
            f"s{k + 1} AS MATERIALIZED (SELECT node, degree, {_each('has_{0}, x_{0}, r_{0}, r_{0} + CASE WHEN z.rr_{0} > 0 THEN y.rr_{0} / z.rr_{0} ELSE 0 END * p_{0} AS p_{0}')} FROM m{k}, rr{k} z, rr{k + 1} y)",
        ]
    return with_views(", ".join(parts) + f" SELECT vid, patch, {_each('round(greatest(-60::DOUBLE, least(60::DOUBLE, x_{0})), 3) + 0 AS {0}')} FROM s{rounds} JOIN seam USING (node)", "vertices", "faces")


@query(_levelling_sql(40))
def seam_levelling(spark: SparkSession, d: str) -> DataFrame:
    """Offsets that close the steps of colour between patches, to a residual of a thousandth."""
    patch, colours = _patch_colours(spark, d)
    nodes = radiometry.seam_data(colours)
    found, _ = radiometry.levelled(nodes, radiometry.seam_links(A.faces(spark, d), patch), near=radiometry.seam_runs)
    return found.select("node.vid", "node.patch", *[(F.round(b, 3) + 0.0).alias(b) for b in _BANDS])


# -- change along normals -----------------------------------------------------------------

#: The cylinder's radius; normals are surveyed at 1, 2 and 4 times that.
RADIUS = 1.0


def _normal_sql() -> str:
    """The closed forms of change.normals, one table a step."""
    pairs = change.PAIRS
    scales = ", ".join(f"({k}::DOUBLE)" for k in (1, 2, 4))
    c = lambda i, j: f"c{min(i, j)}{max(i, j)}"
    row = lambda i: [f"({c(i, j)} - l0)" if i == j else c(i, j) for j in range(3)]
    cross = lambda a, b: (f"{a[1]} * {b[2]} - {a[2]} * {b[1]}", f"{a[2]} * {b[0]} - {a[0]} * {b[2]}", f"{a[0]} * {b[1]} - {a[1]} * {b[0]}")
    products = [cross(row(a), row(b)) for a, b in ((0, 1), (0, 2), (1, 2))]
    options = " UNION ALL ".join(f"SELECT id, {-k} AS k, {v[0]} AS x, {v[1]} AS y, {v[2]} AS z FROM best" for k, v in enumerate(products))
    return f"""near AS (SELECT b.pid AS id, a.x - b.x AS d0, a.y - b.y AS d1, a.z - b.z AS d2 FROM cloud_b b JOIN cloud_a a ON abs(a.x - b.x) <= 4 AND abs(a.y - b.y) <= 4),
sums AS (SELECT id, radius, count(*) AS n, {", ".join(f"sum(d{i} * d{j}) / count(*) - sum(d{i}) * sum(d{j}) / count(*) / count(*) AS c{i}{j}" for i, j in pairs)}
  FROM near, (VALUES {scales}) AS s(radius) WHERE d0 * d0 + d1 * d1 + d2 * d2 <= radius * radius GROUP BY id, radius HAVING count(*) >= 3),
mid AS (SELECT *, (c00 + c11 + c22) / 3 AS q FROM sums),
spread AS (SELECT *, sqrt(((c00 - q) ** 2 + (c11 - q) ** 2 + (c22 - q) ** 2 + 2 * (c01 * c01 + c02 * c02 + c12 * c12)) / 6) AS p FROM mid),
angle AS (SELECT *, CASE WHEN p > 0 THEN acos(greatest(-1::DOUBLE, least(1::DOUBLE, ((c00 - q) * ((c11 - q) * (c22 - q) - c12 * c12) - c01 * (c01 * (c22 - q) - c12 * c02) + c02 * (c01 * c12 - (c11 - q) * c02)) / (2 * p * p * p)))) / 3 ELSE 0 END AS phi FROM spread),
eigen AS (SELECT *, q + 2 * p * cos(phi + 2 * pi() / 3) AS l0, q + 2 * p * cos(phi) AS l2 FROM angle),
scale AS (SELECT *, 3 * q - l0 - l2 AS l1 FROM eigen),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY (l1 - l0) / l2 DESC, radius) AS i FROM scale WHERE l2 > 0 AND l1 > 1e-12 * l2) WHERE i = 1),
aim AS (SELECT id, x, y, z FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY x * x + y * y + z * z DESC, k DESC) AS i FROM ({options})) WHERE i = 1 AND x * x + y * y + z * z > 0),
normal AS (SELECT aim.id, s * x AS nx, s * y AS ny, s * z AS nz, radius FROM (SELECT *, CASE WHEN (CASE WHEN abs(z) > 1e-9 * n THEN z WHEN abs(y) > 1e-9 * n THEN y ELSE x END) < 0 THEN -1 ELSE 1 END / n AS s FROM (SELECT *, sqrt(x * x + y * y + z * z) AS n FROM aim)) aim JOIN best USING (id))"""


@query(with_views(_normal_sql() + " SELECT id, round(nx, 4) + 0 AS nx, round(ny, 4) + 0 AS ny, round(nz, 4) + 0 AS nz, radius FROM normal", "cloud_a", "cloud_b"))
def surveyed_normals(spark: SparkSession, d: str) -> DataFrame:
    a, b = _points(A.cloud_a(spark, d)), _points(A.cloud_b(spark, d))
    found = change.normals(b, a, (RADIUS, 2 * RADIUS, 4 * RADIUS))
    return found.select("id", *[(F.round(n, 4) + 0.0).alias(n) for n in ("nx", "ny", "nz")], "radius")


def _cylinder_sql(name: str, cloud: str) -> str:
    return f"""{name} AS (SELECT id, avg(h) AS mean, var_pop(h) AS var, count(*) AS n FROM (SELECT c.id, (p.x - c.x) * nx + (p.y - c.y) * ny + (p.z - c.z) * nz AS h, (p.x - c.x) ** 2 + (p.y - c.y) ** 2 + (p.z - c.z) ** 2 AS dd FROM core c JOIN {cloud} p ON abs(p.x - c.x) <= 6 AND abs(p.y - c.y) <= 6)
  WHERE abs(h) <= 5 AND dd - h * h <= 1 GROUP BY id)"""


@query(
    with_views(
        f"""{_normal_sql()}, core AS MATERIALIZED (SELECT pid AS id, b.x, b.y, b.z, nx, ny, nz FROM cloud_b b LEFT JOIN normal ON pid = id), {_cylinder_sql("c0", "cloud_a")}, {_cylinder_sql("c1", "cloud_b")}
SELECT core.id, round(c1.mean - c0.mean, 4) + 0 AS distance, round(1.96::DOUBLE * (sqrt(c0.var / c0.n + c1.var / c1.n) + 0.01::DOUBLE), 4) AS lod FROM core LEFT JOIN c0 USING (id) LEFT JOIN c1 ON core.id = c1.id""",
        "cloud_a",
        "cloud_b",
    )
)
def m3c2_normals(spark: SparkSession, d: str) -> DataFrame:
    """Change of every point of the later epoch along the normal of the earlier one, as deep as
    both clouds are high, with a registration error of 1 cm."""
    a, b = _points(A.cloud_a(spark, d)), _points(A.cloud_b(spark, d))
    found = change.m3c2_surveyed(b, a, b, RADIUS, depth=5.0, registration_error=0.01)
    return found.select("id", (F.round("distance", 4) + 0.0).alias("distance"), F.round("lod", 4).alias("lod"))
