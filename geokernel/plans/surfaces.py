"""Queries of holes in rasters, contour lines, ground points and merged tiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geokernel.operators import graph, grid, ground, merging
from geokernel.operators.tables import dealt, shared_path
from geokernel.plans.catalogue import _CONTOURS, _points, query
from geokernel.sources import adapters as A
from geokernel.sources import models
from geokernel.sources.adapters import with_views

#: Days and hours: the grid that rasters of events lie on.
ROWS, COLS = 31, 24


def _filled(spark: SparkSession, d: str) -> DataFrame:
    """Cells of even users whose value is no more than 120: the others count as without data."""
    return A.raster(spark, d, 0).filter("v <= 120")


_HOLES = f"""filled AS (SELECT r, c, v FROM rast_a WHERE v <= 120),
empty AS MATERIALIZED (SELECT i // {COLS} AS r, i % {COLS} AS c, i // {COLS} * 2147483648 + i % {COLS} AS id FROM range({ROWS * COLS}) t(i) WHERE NOT EXISTS (SELECT 1 FROM filled f WHERE f.r = i // {COLS} AND f.c = i % {COLS})),
links AS (SELECT a.id AS a, b.id AS b FROM empty a JOIN empty b ON abs(a.r - b.r) + abs(a.c - b.c) = 1),
reach(root, id) AS (SELECT id, id FROM empty UNION SELECT root, b FROM reach JOIN links ON id = a),
part AS MATERIALIZED (SELECT r, c, min(root) AS component FROM reach JOIN empty USING (id) GROUP BY r, c),
hole AS MATERIALIZED (SELECT component, count(*) AS cells, NOT bool_or(r = 0 OR c = 0 OR r = {ROWS - 1} OR c = {COLS - 1}) AS interior FROM part GROUP BY component)"""
_RECURSIVE = "WITH RECURSIVE " + A.SQL["rast_a"] + ", " + _HOLES


@query(_RECURSIVE + " SELECT component, cells, interior FROM hole")
def hole_components(spark: SparkSession, d: str) -> DataFrame:
    return graph.hole_sizes(graph.empty_components(_filled(spark, d), ROWS, COLS), ROWS, COLS)


@query(_RECURSIVE + f" SELECT CAST(coalesce(sum(cells), 0) AS BIGINT) AS empty, count(*) FILTER (interior) AS holes, CAST(coalesce(sum(cells) FILTER (interior), 0) AS BIGINT) AS inside, round(coalesce(sum(cells) FILTER (interior), 0) / {ROWS * COLS}::DOUBLE, 9) AS share FROM hole")
def hole_report(spark: SparkSession, d: str) -> DataFrame:
    return graph.hole_report(_filled(spark, d), ROWS, COLS).withColumn("share", F.round("share", 9))


@query(
    _RECURSIVE
    + """, open AS (SELECT p.r, p.c FROM part p JOIN hole USING (component) WHERE interior AND cells <= 12)
SELECT r, c, v FROM filled UNION ALL
SELECT r, c, v FROM (SELECT o.r, o.c, f.v, row_number() OVER (PARTITION BY o.r, o.c ORDER BY (o.r - f.r) ** 2 + (o.c - f.c) ** 2, f.r, f.c) AS k FROM open o, filled f) WHERE k = 1"""
)
def filled_holes(spark: SparkSession, d: str) -> DataFrame:
    """The raster with its small interior holes filled by the nearest value."""
    return graph.fill_holes(_filled(spark, d), ROWS, COLS, 12)


@query(
    "WITH RECURSIVE " + A.SQL["rast_a"] + f", {_CONTOURS}, n AS MATERIALIZED (SELECT row_number() OVER () AS id, level, p[1].e AS e0, p[2].e AS e1, sqrt((p[1].x - p[2].x) ** 2 + (p[1].y - p[2].y) ** 2) AS length FROM seg),"
    """ends AS MATERIALIZED (SELECT id, level, unnest([e0, e1]) AS e FROM n), links AS MATERIALIZED (SELECT a.id AS a, b.id AS b FROM ends a JOIN ends b ON a.level = b.level AND a.e = b.e AND a.id <> b.id),
reach(root, id) AS (SELECT id, id FROM n UNION SELECT root, b FROM reach JOIN links ON id = a),
line AS (SELECT id, min(root) AS line FROM reach GROUP BY id), degree AS (SELECT a AS id, count(*) AS k FROM links GROUP BY a)
SELECT level, closed, points, length, count(*) AS lines FROM (SELECT any_value(level) AS level, bool_and(coalesce(k, 0) = 2) AS closed, count(*) + 1 AS points, round(sum(length), 6) AS length FROM n JOIN line USING (id) LEFT JOIN degree USING (id) GROUP BY line) GROUP BY ALL"""
)
def contour_polylines(spark: SparkSession, d: str) -> DataFrame:
    """Lines of each level by their shape: closed or not, points, length along the points in order."""
    points = grid.contour_lines(grid.contour_segments(A.raster(spark, d, 0), 20.0))
    before = points.select("line", (F.col("position") + 1).alias("position"), F.col("x").alias("px"), F.col("y").alias("py"))
    step = F.coalesce(F.sqrt((F.col("x") - F.col("px")) ** 2 + (F.col("y") - F.col("py")) ** 2), F.lit(0.0))
    lines = points.join(before, ["line", "position"], "left").groupBy("line", "level", "closed").agg(F.count("*").alias("points"), F.round(F.sum(step), 6).alias("length"))
    return lines.groupBy("level", "closed", "points", "length").agg(F.count("*").alias("lines"))


# -- ground -------------------------------------------------------------------------------

_OUTLIERS = """pair AS (SELECT a.pid AS id, sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2) AS d FROM cloud_a a JOIN cloud_a b ON a.pid <> b.pid AND abs(a.x - b.x) <= 12 AND abs(a.y - b.y) <= 12),
near AS (SELECT id, avg(d) AS mean FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d) AS k FROM pair) WHERE k <= 8 GROUP BY id),
level AS (SELECT avg(mean) + 2 * stddev_samp(mean) AS most FROM near),
flag AS MATERIALIZED (SELECT id, mean, mean > most AS outlier FROM near, level)"""


@query(with_views(_OUTLIERS + " SELECT id, round(mean, 6) AS mean, outlier FROM flag", "cloud_a"))
def outlier_points(spark: SparkSession, d: str) -> DataFrame:
    """Points whose eight nearest others are far away. The SQL looks 12 units around, which holds
    eight others everywhere at these densities."""
    return ground.outliers(_points(A.cloud_a(spark, d))).withColumn("mean", F.round("mean", 6))


def _ground_sql(windows: tuple[int, ...], gsd: float) -> str:
    parts = [
        f"rows_ AS (SELECT pid AS id, x, y, z, outlier, CAST(floor(y / {gsd}) AS BIGINT) AS r, CAST(floor(x / {gsd}) AS BIGINT) AS c FROM cloud_a JOIN flag ON pid = id)",
        "s0 AS MATERIALIZED (SELECT r, c, min(z) AS v, min(z) AS h, false AS object FROM rows_ WHERE NOT outlier GROUP BY r, c)",
    ]
    for k, w in enumerate(windows):
        around = f"abs(a.r - b.r) <= {w} AND abs(a.c - b.c) <= {w}"
        parts += [
            f"e{k} AS (SELECT a.r, a.c, min(b.h) AS h FROM s{k} a JOIN s{k} b ON {around} GROUP BY a.r, a.c)",
            f"o{k} AS (SELECT a.r, a.c, max(b.h) AS h FROM e{k} a JOIN e{k} b ON {around} GROUP BY a.r, a.c)",
            f"s{k + 1} AS MATERIALIZED (SELECT r, c, s.v, o.h, s.object OR s.h - o.h > {ground.SLOPE}::DOUBLE * {w} * {gsd} AS object FROM s{k} s JOIN o{k} o USING (r, c))",
        ]
    last = f"s{len(windows)}"
    parts += [
        f"g AS MATERIALIZED (SELECT r, c, v FROM {last} WHERE NOT object UNION ALL SELECT r, c, v FROM (SELECT a.r, a.c, b.v, row_number() OVER (PARTITION BY a.r, a.c ORDER BY (a.r - b.r) ** 2 + (a.c - b.c) ** 2, b.r, b.c) AS k FROM {last} a JOIN {last} b ON a.object AND NOT b.object) WHERE k = 1)",
        f"slope AS (SELECT g.r, g.c, g.v, {', '.join(f'CASE WHEN {lo}.v IS NULL AND {hi}.v IS NULL THEN 0 ELSE (coalesce({hi}.v, g.v) - coalesce({lo}.v, g.v)) / (CASE WHEN {lo}.v IS NULL THEN 0 ELSE 1 END + CASE WHEN {hi}.v IS NULL THEN 0 ELSE 1 END) / {gsd} END AS {n}' for lo, hi, n in (('up', 'down', 'dr'), ('west', 'east', 'dc')))} FROM g"
        " LEFT JOIN g up ON up.r = g.r - 1 AND up.c = g.c LEFT JOIN g down ON down.r = g.r + 1 AND down.c = g.c LEFT JOIN g west ON west.r = g.r AND west.c = g.c - 1 LEFT JOIN g east ON east.r = g.r AND east.c = g.c + 1)",
    ]
    return ", ".join(parts)


_WINDOWS, _GSD = (1, 2, 4), 4.0


@query(with_views(f"{_OUTLIERS}, {_ground_sql(_WINDOWS, _GSD)} SELECT id, CASE WHEN outlier THEN 7 WHEN abs(z - v) <= 0.5::DOUBLE + 1.25::DOUBLE * sqrt(dr * dr + dc * dc) THEN 2 ELSE 1 END AS class FROM rows_ LEFT JOIN slope USING (r, c)", "cloud_a"))
def ground_points(spark: SparkSession, d: str) -> DataFrame:
    """Every point of the earlier cloud as noise, ground or other."""
    return ground.classified(_points(A.cloud_a(spark, d)), _GSD, windows=_WINDOWS).select("id", "class")


# -- merged tiles -------------------------------------------------------------------------


@query(
    with_views(
        """tiles AS (SELECT DISTINCT CAST(y // 4 AS BIGINT) AS tile FROM vertices),
part AS (SELECT tile, fid, v0, v1, v2, (y0 + y1 + y2) / 3 AS cy, v0 % 3 AS slot FROM triangles JOIN tiles ON least(y0, y1, y2) >= 4 * tile - 2 AND greatest(y0, y1, y2) <= 4 * tile + 6),
kept AS (SELECT * FROM part WHERE cy BETWEEN 4 * tile AND 4 * tile + 4 AND NOT (slot = 2 AND tile % 2 = 1))
SELECT (SELECT count(DISTINCT v) FROM (SELECT unnest([v0, v1, v2]) AS v FROM kept)) AS vertices, count(*) AS faces, count(DISTINCT tile * 3 + slot) AS pages FROM kept""",
        "vertices",
        "faces",
        "triangles",
    )
)
def tile_merge_counts(spark: SparkSession, d: str) -> DataFrame:
    """The lattice in bands of four rows, each with copies of what lies two rows around it that are
    a little off, merged into one mesh."""
    v, f = A.vertices(spark, d), A.faces(spark, d)
    tiles = v.select(F.floor(F.col("y") / 4).alias("tile")).distinct()
    reach = F.explode(F.sequence(F.floor((F.col("y") - 6) / 4), F.floor((F.col("y") + 2) / 4)))
    copies = v.withColumn("tile", reach).filter(F.col("y").between(4 * F.col("tile") - 2, 4 * F.col("tile") + 6)).join(tiles, "tile")
    copies = copies.withColumn("x", F.col("x") + F.col("tile") % 2 / F.lit(4096.0))
    held = [copies.select("tile", F.col("vid").alias(f"v{k}")) for k in (0, 1, 2)]
    faces = f.join(dealt(held[0]), "v0").join(dealt(held[1]), ["tile", "v1"]).join(dealt(held[2]), ["tile", "v2"]).withColumn("slot", F.col("v0") % 3)
    bounds = tiles.select("tile", F.lit(-1.0).alias("x0"), (4 * F.col("tile")).cast("double").alias("y0"), F.lit(100.0).alias("x1"), (4 * F.col("tile") + 4).cast("double").alias("y1"))
    pages = tiles.select("tile", F.explode(F.array(*[F.lit(k).cast("long") for k in range(3)])).alias("slot")).withColumn("page", F.when(~((F.col("slot") == 2) & (F.col("tile") % 2 == 1)), F.lit("tex/page.ppm")))
    vertices, merged, materials = merging.merged_tiles(copies, faces, bounds, pages)
    return merged.agg(F.count("*").alias("faces")).join(F.broadcast(vertices.agg(F.count("*").alias("vertices")))).join(F.broadcast(materials.agg(F.count("*").alias("pages")))).select("vertices", "faces", "pages")


@query(with_views("SELECT 'v ' || printf('%.6f', 2 * y * -1 + 100.015625::DOUBLE) || ' ' || printf('%.6f', 2 * x + 200 - 64) || ' ' || printf('%.6f', 2 * z + 30.5::DOUBLE) AS value, count(*) AS n FROM vertices GROUP BY 1 UNION ALL SELECT 'f ' || v0 || ' ' || v1 || ' ' || v2, 1 FROM faces", "vertices", "faces"))
def rewritten_mesh(spark: SparkSession, d: str) -> DataFrame:
    """The lattice mesh as text, moved by a scaled quarter turn and an offset."""
    path = shared_path(spark, "mesh")
    v = A.vertices(spark, d).select(F.concat_ws(" ", F.lit("v"), "x", "y", "z").alias("value"))
    f = A.faces(spark, d).select(F.concat_ws(" ", F.lit("f"), "v0", "v1", "v2").alias("value"))
    v.union(f).write.text(path)
    lines = models.rewritten_lines(spark, path, 2.0, [[0, -1, 0], [1, 0, 0], [0, 0, 1]], [100.015625, 200.0, 30.5], [0.0, 64.0, 0.0])
    return lines.groupBy("value").agg(F.count("*").alias("n"))
