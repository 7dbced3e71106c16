"""Registered queries of the engine and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geokernel.functions import scalar as S
from geokernel.operators import change, graph, grid, mesh, neighbours, stats, tiling, topk
from geokernel.operators import fit as fits
from geokernel.operators.tables import written
from geokernel.sources import adapters as A
from geokernel.sources.adapters import with_views

FLAGSHIP = "dod_report"
QUERIES: dict = {}
ORACLES: dict = {}
GSD, AREA = 4.0, 16.0

D = "CAST({} AS DOUBLE)".format
L = "CAST({} AS BIGINT)".format


def query(sql: str | None = None):
    """Register a function under its name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


# -- elevation change ---------------------------------------------------------------------

_DSM = "dsm_{0} AS (SELECT CAST(floor(y / 4) AS BIGINT) AS r, CAST(floor(x / 4) AS BIGINT) AS c, max(z) AS v FROM cloud_{0} GROUP BY 1, 2)"
_DZ = f"{_DSM.format('a')}, {_DSM.format('b')}, dz AS (SELECT r, c, b.v - a.v AS dz FROM dsm_a a JOIN dsm_b b USING (r, c))"
_LOD = "mid AS (SELECT median(dz) AS m FROM dz), lod AS (SELECT 1.96 * (1.4826 * median(abs(dz - m))) AS lod FROM dz, mid)"


def _dz(spark: SparkSession, d: str) -> DataFrame:
    return grid.difference(grid.max_surface(A.cloud_a(spark, d), GSD), grid.max_surface(A.cloud_b(spark, d), GSD))


@query(
    with_views(
        f"""{_DZ}, {_LOD}
SELECT count(*) AS valid_cells, round(max(lod), 9) AS lod, round(avg(dz), 9) AS mean_dz, max(dz) AS max_dz, min(dz) AS min_dz, sum(CASE WHEN abs(dz) > lod THEN {D(16)} ELSE 0 END) AS changed_area,
  sum(CASE WHEN abs(dz) > lod AND dz > 0 THEN dz ELSE 0 END) * 16 AS fill, sum(CASE WHEN abs(dz) > lod AND dz < 0 THEN -dz ELSE 0 END) * 16 AS cut,
  sum(CASE WHEN abs(dz) > lod THEN dz ELSE 0 END) * 16 AS net, sum(dz) * 16 AS net_raw FROM dz, lod""",
        "cloud_a",
        "cloud_b",
    )
)
def dod_report(spark: SparkSession, d: str) -> DataFrame:
    dz = _dz(spark, d)
    return grid.change_report(dz, grid.level_of_detection(dz), AREA).withColumns({"lod": F.round("lod", 9), "mean_dz": F.round("mean_dz", 9)})


@query(with_views("SELECT CAST(floor(y / 4) AS BIGINT) AS r, CAST(floor(x / 4) AS BIGINT) AS c, max(z) AS v FROM cloud_a GROUP BY 1, 2", "cloud_a"))
def dsm_max_grid(spark: SparkSession, d: str) -> DataFrame:
    return grid.max_surface(A.cloud_a(spark, d), GSD)


@query(
    with_views(
        f"""p AS (SELECT x, y FROM cloud_a UNION ALL SELECT x, y FROM cloud_b),
b AS (SELECT floor(min(x) / 4) * 4 AS xmin, floor(min(y) / 4) * 4 AS ymin, ceil(max(x) / 4) * 4 AS xmax, ceil(max(y) / 4) * 4 AS ymax FROM p)
SELECT xmin, ymin, xmax, ymax, {L("(xmax - xmin) / 4")} AS width, {L("(ymax - ymin) / 4")} AS height FROM b""",
        "cloud_a",
        "cloud_b",
    )
)
def shared_grid(spark: SparkSession, d: str) -> DataFrame:
    return grid.shared_bounds(A.cloud_a(spark, d), A.cloud_b(spark, d), GSD)


@query(with_views(f"{_DZ}, {_LOD} SELECT round(lod, 9) AS lod FROM lod", "cloud_a", "cloud_b"))
def robust_lod(spark: SparkSession, d: str) -> DataFrame:
    return grid.level_of_detection(_dz(spark, d)).select(F.round("lod", 9).alias("lod"))


@query(with_views("SELECT r, c, b.v - a.v AS dz FROM rast_a a JOIN rast_b b USING (r, c)", "rast_a", "rast_b"))
def raster_difference(spark: SparkSession, d: str) -> DataFrame:
    return grid.difference(A.raster(spark, d, 0), A.raster(spark, d, 1)).select("r", "c", "dz")


# -- classes ------------------------------------------------------------------------------


@query(with_views("SELECT cls, count(*) AS n FROM cloud_a GROUP BY cls", "cloud_a"))
def class_histogram(spark: SparkSession, d: str) -> DataFrame:
    return stats.class_histogram(A.cloud_a(spark, d))


@query(with_views("SELECT CAST(floor(y / 4) AS BIGINT) AS r, CAST(floor(x / 4) AS BIGINT) AS c, max(z) AS v FROM cloud_a WHERE cls = 6 GROUP BY 1, 2", "cloud_a"))
def class_max_surface(spark: SparkSession, d: str) -> DataFrame:
    return grid.max_surface(A.cloud_a(spark, d), GSD, (6,))


_FOLD = "CASE WHEN cls = 2 THEN 1 WHEN cls IN (3, 4, 5) THEN 2 WHEN cls IN (6, 64) THEN 3 ELSE 0 END"
_MAJ = "maj_{0} AS (SELECT r, c, arg_max(k, {{'n': n, 'k': -k}}) AS v FROM (SELECT CAST(floor(y / 4) AS BIGINT) AS r, CAST(floor(x / 4) AS BIGINT) AS c, " + _FOLD + " AS k, count(*) AS n FROM cloud_{0} GROUP BY 1, 2, 3) WHERE k > 0 GROUP BY r, c)"


def _classes(cloud: DataFrame) -> DataFrame:
    return grid.majority_class(cloud, GSD, S.fold_class(F.col("cls")))


@query(with_views(_MAJ.format("a") + " SELECT r, c, v FROM maj_a", "cloud_a"))
def majority_class_grid(spark: SparkSession, d: str) -> DataFrame:
    return _classes(A.cloud_a(spark, d))


_CODES = _MAJ.format("a") + ", " + _MAJ.format("b") + ", codes AS (SELECT coalesce(a.r, b.r) AS r, coalesce(a.c, b.c) AS c, coalesce(b.v, a.v) AS carried, CASE WHEN a.v <> b.v THEN a.v * 10 + b.v ELSE 0 END AS code, b.v IS NULL AS from_before FROM maj_a a FULL JOIN maj_b b ON a.r = b.r AND a.c = b.c)"


@query(with_views(_CODES + " SELECT r, c, carried, code, from_before FROM codes", "cloud_a", "cloud_b"))
def semantic_change_codes(spark: SparkSession, d: str) -> DataFrame:
    return grid.transitions(_classes(A.cloud_a(spark, d)), _classes(A.cloud_b(spark, d)))


@query(with_views(_CODES + f" SELECT code, count(*) * {D(16)} AS area FROM codes WHERE code > 0 GROUP BY code", "cloud_a", "cloud_b"))
def semantic_transition_areas(spark: SparkSession, d: str) -> DataFrame:
    return grid.transition_areas(semantic_change_codes(spark, d), AREA)


# -- transforms and fits ------------------------------------------------------------------


@query(with_views("SELECT pid, -2 * y + 100 AS x, 2 * x + 200 AS y, 2 * z + 30 AS z FROM cloud_a", "cloud_a"))
def apply_similarity(spark: SparkSession, d: str) -> DataFrame:
    r = [S.lit(v) for v in (0, -1, 0, 1, 0, 0, 0, 0, 1)]
    out = S.similarity((F.col("x"), F.col("y"), F.col("z")), S.lit(2), r, tuple(map(S.lit, (100, 200, 30))))
    return A.cloud_a(spark, d).select("pid", *[v.alias(a) for v, a in zip(out, "xyz", strict=True)])


@query(with_views(f"o AS (SELECT floor(avg(x)) AS ox, floor(avg(y)) AS oy, floor(avg(z)) AS oz FROM cloud_a) SELECT {D('0.5')} + ox + oy AS tx, {D('-0.25')} + oy - ox AS ty, {D('0.125')} AS tz FROM o", "cloud_a"))
def decentre_transform(spark: SparkSession, d: str) -> DataFrame:
    r = [S.lit(v) for v in (0, -1, 0, 1, 0, 0, 0, 0, 1)]
    o = A.cloud_a(spark, d).agg(*[F.floor(F.avg(a)).cast("double").alias(f"o{a}") for a in "xyz"])
    t = S.decentred_translation(r, tuple(map(S.lit, (0.5, -0.25, 0.125))), (F.col("ox"), F.col("oy"), F.col("oz")))
    return o.select(*[v.alias(f"t{a}") for v, a in zip(t, "xyz", strict=True)])


@query(with_views(f"SELECT round(avg(wx), 6) AS ox, round(avg(wy), 6) AS oy, {D(0)} AS oz FROM gcp", "gcp"))
def xy_offset(spark: SparkSession, d: str) -> DataFrame:
    return A.markings(spark, d).agg(F.round(F.avg("wx"), 6).alias("ox"), F.round(F.avg("wy"), 6).alias("oy"), F.lit(0.0).alias("oz"))


_E = "e AS (SELECT -2 * ly + 100 - wx AS ex, 2 * lx + 200 - wy AS ey, 2 * lz + 30 - wz AS ez, is_check FROM gcp)"


@query(with_views(_E + " SELECT count(*) AS n, round(sqrt(avg(ex * ex + ey * ey + ez * ez)), 9) AS rms_3d, round(sqrt(avg(ex * ex + ey * ey)), 9) AS rms_horizontal, round(sqrt(avg(ez * ez)), 9) AS rms_vertical, round(sqrt(max(ex * ex + ey * ey + ez * ez)), 9) AS max_3d FROM e", "gcp"))
def residual_stats(spark: SparkSession, d: str) -> DataFrame:
    import numpy as np

    e = fits.fit_residuals(A.markings(spark, d), 2.0, np.array([[0, -1, 0], [1, 0, 0], [0, 0, 1]], float), np.array([100.0, 200.0, 30.0]))
    out = stats.residual_stats(e)
    return out.select("n", *[F.round(c, 9).alias(c) for c in out.columns if c != "n"])


@query(with_views(_E + " SELECT count(*) AS n, round(sqrt(avg(ex * ex)), 9) AS rmse_x, round(sqrt(avg(ey * ey)), 9) AS rmse_y, round(sqrt(avg(ez * ez)), 9) AS rmse_z, round(sqrt(avg(ex * ex + ey * ey + ez * ez)), 9) AS rmse_3d FROM e WHERE is_check", "gcp"))
def cp_rmse(spark: SparkSession, d: str) -> DataFrame:
    rows = A.markings(spark, d).filter("is_check").withColumns({"mx": -2 * F.col("ly") + 100, "my": 2 * F.col("lx") + 200, "mz": 2 * F.col("lz") + 30})
    out = stats.axis_rmse(rows)
    return out.select("n", *[F.round(c, 9).alias(c) for c in out.columns if c != "n"])


@query(with_views("SELECT is_check, count(*) AS n, count(DISTINCT label) AS labels FROM gcp GROUP BY is_check", "gcp"))
def control_check_split(spark: SparkSession, d: str) -> DataFrame:
    return A.markings(spark, d).groupBy("is_check").agg(F.count("*").alias("n"), F.countDistinct("label").alias("labels"))


_MARKERS = "marks AS (SELECT CAST(regexp_extract(label, '^m([0-9]+)_c([0-9]+)$', 1) AS INT) AS m, CAST(regexp_extract(label, '^m([0-9]+)_c([0-9]+)$', 2) AS INT) AS k, * FROM gcp), cen AS (SELECT m, avg(lx) AS lx, avg(ly) AS ly, avg(lz) AS lz, avg(wx) AS wx, avg(wy) AS wy, avg(wz) AS wz FROM marks GROUP BY m)"


def _marked(spark: SparkSession, d: str) -> DataFrame:
    m, k = S.marker_parts(F.col("label"))
    return A.markings(spark, d).withColumns({"m": m, "k": k})


@query(with_views(_MARKERS + " SELECT a.m AS a, b.m AS b, round(2 * sqrt((a.lx - b.lx) ** 2 + (a.ly - b.ly) ** 2 + (a.lz - b.lz) ** 2), 6) AS estimated, round(sqrt((a.wx - b.wx) ** 2 + (a.wy - b.wy) ** 2 + (a.wz - b.wz) ** 2), 6) AS expected FROM cen a JOIN cen b ON a.m < b.m", "gcp"))
def marker_pair_distances(spark: SparkSession, d: str) -> DataFrame:
    """All pairs of markers: a report over the markers of a site, as many as their number squared."""
    centres = written(_marked(spark, d).groupBy("m").agg(*[F.avg(c).alias(c) for c in ("lx", "ly", "lz", "wx", "wy", "wz")]), "centres")
    left, right, places = tiling.block_pairs(centres, "m")
    a, b = left.alias("a"), right.alias("b")
    far = lambda p: F.sqrt(sum(((F.col(f"a.{p}{c}") - F.col(f"b.{p}{c}")) ** 2 for c in "xyz"), F.lit(0.0)))
    return a.join(b, [F.col(f"a.{c}") == F.col(f"b.{c}") for c in places] + [F.col("a.m") < F.col("b.m")]).select(F.col("a.m").alias("a"), F.col("b.m").alias("b"), F.round(2.0 * far("l"), 6).alias("estimated"), F.round(far("w"), 6).alias("expected"))


@query(with_views(_MARKERS + " SELECT a.m AS m, count(*) AS edges, round(avg(sqrt((a.wx - b.wx) ** 2 + (a.wy - b.wy) ** 2 + (a.wz - b.wz) ** 2)), 6) AS edge FROM marks a JOIN marks b ON a.m = b.m AND b.k = (a.k + 1) % 4 GROUP BY a.m", "gcp"))
def marker_edges(spark: SparkSession, d: str) -> DataFrame:
    rows = _marked(spark, d)
    nxt = rows.select("m", ((F.col("k") + 3) % 4).alias("k"), *[F.col(f"w{c}").alias(f"n{c}") for c in "xyz"])
    size = F.sqrt(sum(((F.col(f"w{c}") - F.col(f"n{c}")) ** 2 for c in "xyz"), F.lit(0.0)))
    return rows.join(nxt, ["m", "k"]).groupBy("m").agg(F.count("*").alias("edges"), F.round(F.avg(size), 6).alias("edge"))


@query()
def similarity_fit_residuals(spark: SparkSession, d: str) -> DataFrame:
    """Residuals of the check rows under the fit of the control rows."""
    return stats.residual_stats(fits.held_out_residuals(A.markings(spark, d)))


# -- masks, samples, crops ----------------------------------------------------------------


@query(with_views(_DZ + f", mid AS (SELECT median(abs(dz)) AS m FROM dz), mad AS (SELECT m, median(abs(abs(dz) - m)) AS mad FROM dz, mid GROUP BY m) SELECT r * 100000 + c AS id, abs(dz) AS d, abs(dz) <= CASE WHEN mad = 0 THEN m + 1e-9 ELSE m + {D('2.5')} * {D('1.4826')} * mad END AS stable FROM dz, mad", "cloud_a", "cloud_b"))
def stable_mask(spark: SparkSession, d: str) -> DataFrame:
    return stats.stable_mask(_dz(spark, d).select((F.col("r") * 100000 + F.col("c")).alias("id"), F.abs("dz").alias("d")))


@query(with_views("n AS (SELECT greatest(1, count(*) // 400) AS step FROM cloud_a) SELECT pid, x, y, z FROM (SELECT *, row_number() OVER (ORDER BY pid) - 1 AS i FROM cloud_a), n WHERE i % step = 0", "cloud_a"))
def stride_decimate(spark: SparkSession, d: str) -> DataFrame:
    return stats.stride(A.cloud_a(spark, d), "pid", 400).select("pid", "x", "y", "z")


@query(with_views("SELECT pid, x, y, z FROM cloud_a WHERE x BETWEEN 20 AND 60 AND y BETWEEN 30 AND 70", "cloud_a"))
def crop_xy(spark: SparkSession, d: str) -> DataFrame:
    return A.cloud_a(spark, d).filter(F.col("x").between(20, 60) & F.col("y").between(30, 70)).select("pid", "x", "y", "z")


def _tri(spark: SparkSession, d: str) -> DataFrame:
    return mesh.triangles(A.vertices(spark, d), A.faces(spark, d))


@query(with_views(f"SELECT fid FROM triangles WHERE (x0 + x1 + x2) / 3 >= 3 AND (x0 + x1 + x2) / 3 < {D('11.5')} AND (y0 + y1 + y2) / 3 >= 2 AND (y0 + y1 + y2) / 3 < {D('40.5')}", "vertices", "faces", "triangles"))
def centroid_ownership(spark: SparkSession, d: str) -> DataFrame:
    return mesh.owned_faces(_tri(spark, d), 3, 2, 11.5, 40.5).select("fid")


# -- statistics ---------------------------------------------------------------------------


@query(with_views("SELECT count(*) AS n, min(x) AS min_x, max(x) AS max_x, min(y) AS min_y, max(y) AS max_y, min(z) AS min_z, max(z) AS max_z, round(count(*) / ((max(x) - min(x)) * (max(y) - min(y))), 9) AS density FROM cloud_a", "cloud_a"))
def cloud_stats(spark: SparkSession, d: str) -> DataFrame:
    return stats.cloud_stats(A.cloud_a(spark, d)).withColumn("density", F.round("density", 9))


_CROSS = "sqrt(((y1-y0)*(z2-z0)-(z1-z0)*(y2-y0))**2 + ((z1-z0)*(x2-x0)-(x1-x0)*(z2-z0))**2 + ((x1-x0)*(y2-y0)-(y1-y0)*(x2-x0))**2)"


@query(with_views(f"t AS (SELECT count(*) AS n_faces, round(sum({_CROSS} / 2), 6) AS area FROM triangles) SELECT count(*) AS n_vertices, min(x) AS min_x, max(x) AS max_x, min(y) AS min_y, max(y) AS max_y, min(z) AS min_z, max(z) AS max_z, any_value(n_faces) AS n_faces, any_value(area) AS area FROM vertices, t", "vertices", "faces", "triangles"))
def mesh_stats(spark: SparkSession, d: str) -> DataFrame:
    return mesh.mesh_stats(A.vertices(spark, d), _tri(spark, d)).withColumn("area", F.round("area", 6))


_EDGES = "e AS (SELECT fid, least(a, b) AS lo, greatest(a, b) AS hi FROM (SELECT fid, v0 AS a, v1 AS b FROM faces UNION ALL SELECT fid, v1, v2 FROM faces UNION ALL SELECT fid, v2, v0 FROM faces))"


@query(with_views(f"{_EDGES}, m AS (SELECT lo, hi, count(*) AS n FROM e GROUP BY lo, hi) SELECT count(*) FILTER (WHERE n = 1) AS boundary, count(*) FILTER (WHERE n = 2) AS manifold, count(*) FILTER (WHERE n > 2) AS non_manifold FROM m", "vertices", "faces"))
def edge_multiplicity(spark: SparkSession, d: str) -> DataFrame:
    return mesh.edge_multiplicity(A.faces(spark, d))


_LUMA = "(0.299::DOUBLE * r + 0.587::DOUBLE * g + 0.114::DOUBLE * b)"


@query(with_views("m AS (SELECT avg(r) AS r, avg(g) AS g, avg(b) AS b FROM pixels) SELECT " + ", ".join(f"round({_LUMA} / {c}, 9) AS gain_{c}" for c in "rgb") + " FROM m", "pixels"))
def gray_world_gains(spark: SparkSession, d: str) -> DataFrame:
    g = stats.gray_world_gains(A.pixels(spark, d))
    return g.select(*[F.round(c, 9).alias(c) for c in g.columns])


@query(with_views(f"SELECT round(quantile_cont({_LUMA}, 0.01), 6) AS low, round(quantile_cont({_LUMA}, 0.99), 6) AS high FROM pixels", "pixels"))
def contrast_percentiles(spark: SparkSession, d: str) -> DataFrame:
    b = stats.contrast_bounds(A.pixels(spark, d))
    return b.select(F.round("low", 6).alias("low"), F.round("high", 6).alias("high"))


@query(with_views("t AS (SELECT CAST(floor(greatest(0, least(255, 255 * pow(greatest(0, least(1, (r + 0.125::DOUBLE * 255) / 255)), 2)))) AS INT) AS toned FROM pixels) SELECT toned, count(*) AS n FROM t GROUP BY toned", "pixels"))
def tone_curve(spark: SparkSession, d: str) -> DataFrame:
    return A.pixels(spark, d).select(S.tone(F.col("r"), 0.125, 2.0).alias("toned")).groupBy("toned").agg(F.count("*").alias("n"))


@query("SELECT user_id, event_id, CAST(epoch_us(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) - epoch_us(ts) AS DOUBLE) / 1000000 AS seconds FROM events")
def stage_durations(spark: SparkSession, d: str) -> DataFrame:
    return stats.stage_durations(A.table(spark, d, "events"), ["user_id"], "ts", "event_id")


@query(
    with_views(
        """m AS (SELECT avg(wx) AS mx, avg(wy) AS my, var_pop(wx) AS sxx, var_pop(wy) AS syy, covar_pop(wx, wy) AS sxy FROM gcp),
v AS (SELECT *, (sxx + syy) / 2 + sqrt(greatest(((sxx + syy) / 2) ** 2 - (sxx * syy - sxy * sxy), 0)) AS lam FROM m)
SELECT rid, round(((wx - mx) * (lam - syy) + (wy - my) * sxy) / sqrt((lam - syy) ** 2 + sxy ** 2), 6) AS proj FROM gcp, v""",
        "gcp",
    )
)
def pca_axis_order(spark: SparkSession, d: str) -> DataFrame:
    return stats.principal_projection(A.markings(spark, d), "wx", "wy").select("rid", F.round("proj", 6).alias("proj"))


@query(
    with_views(
        """m AS (SELECT avg(wx) AS mx, avg(wy) AS my, var_pop(wx) AS sxx, var_pop(wy) AS syy, covar_pop(wx, wy) AS sxy FROM gcp),
v AS (SELECT *, (sxx + syy) / 2 + sqrt(greatest(((sxx + syy) / 2) ** 2 - (sxx * syy - sxy * sxy), 0)) AS lam FROM m),
p AS (SELECT rid, row_number() OVER (ORDER BY ((wx - mx) * (lam - syy) + (wy - my) * sxy) / sqrt((lam - syy) ** 2 + sxy ** 2), rid) - 1 AS place FROM gcp, v),
n AS (SELECT count(*) AS n, least(greatest(1, CAST(round_even(0.3::DOUBLE * count(*), 0) AS BIGINT)), count(*) - 4, count(*) - 2) AS wanted FROM p),
i AS (SELECT CAST(floor(CAST(n - 2 AS DOUBLE) / wanted * (unnest(range(wanted)) + 0.5::DOUBLE)) AS BIGINT) + 1 AS place FROM n)
SELECT rid, place IN (SELECT place FROM i) AS is_check FROM p""",
        "gcp",
    )
)
def check_selection(spark: SparkSession, d: str) -> DataFrame:
    rows = A.markings(spark, d).select("rid", F.col("wx").alias("x"), F.col("wy").alias("y"))
    return stats.choose_check(rows, 0.3, "rid").select("rid", "is_check")


# -- geodesy and rules --------------------------------------------------------------------

_LONLAT = "SELECT c_custkey AS k, CAST(c_custkey * 7919 % 36000 AS DOUBLE) / 100 - 180 AS lon, CAST(c_custkey * 104729 % 16000 AS DOUBLE) / 100 - 80 AS lat FROM customer"


@query(f"WITH p AS ({_LONLAT}), e AS (SELECT k, CAST(floor((lon + 180) / 6) AS INT) + 1 + CASE WHEN lat >= 0 THEN 32600 ELSE 32700 END AS epsg FROM p) SELECT k, epsg, 'WGS84 UTM ' || CAST(substring(CAST(epsg AS VARCHAR), 4, 2) AS INT) || CASE WHEN epsg < 32700 THEN 'N' ELSE 'S' END AS name FROM e")
def utm_zone(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    p = A.table(spark, d, "customer").select(k.alias("k"), (k * 7919 % 36000 / F.lit(100.0) - 180).alias("lon"), (k * 104729 % 16000 / F.lit(100.0) - 80).alias("lat"))
    return p.select("k", S.utm_epsg(F.col("lon"), F.col("lat")).alias("epsg")).withColumn("name", S.utm_text(F.col("epsg")))


@query("SELECT c_custkey AS k, round(CASE WHEN c_custkey % 4 IN (1, 3) THEN -1 ELSE 1 END * (c_custkey % 180 + CAST(c_custkey * 7 % 60 AS DOUBLE) / 60 + CAST(c_custkey * 11 % 60 AS DOUBLE) / 3600), 9) AS degrees, CASE WHEN c_custkey % 3 = 1 THEN -CAST(c_custkey AS DOUBLE) / 8 ELSE CAST(c_custkey AS DOUBLE) / 8 END AS altitude FROM customer")
def dms_to_degrees(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    ref = F.get(F.array(*map(F.lit, ("N", "S", "E", "w"))), (k % 4).cast("int"))
    return A.table(spark, d, "customer").select(k.alias("k"), F.round(S.dms_to_degrees(k % 180, (k * 7 % 60).cast("double"), (k * 11 % 60).cast("double"), ref), 9).alias("degrees"), S.signed_altitude(k / F.lit(8.0), k % 3).alias("altitude"))


@query(
    """SELECT c_custkey AS k, CASE WHEN n > 150 AND matcher = 'exhaustive' THEN 'vocab_tree' ELSE matcher END AS matcher, CASE WHEN n > 500 AND mapper = 'incremental' THEN 'global' ELSE mapper END AS mapper, CASE WHEN n > 500 AND level = 0 THEN 1 ELSE level END AS level
FROM (SELECT c_custkey, c_custkey * 7919 % 1000 AS n, CASE WHEN c_custkey % 2 = 0 THEN 'exhaustive' ELSE 'spatial' END AS matcher, CASE WHEN c_custkey % 3 = 0 THEN 'global' ELSE 'incremental' END AS mapper, c_custkey % 3 AS level FROM customer)"""
)
def autoscale_rules(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    a, b, c = stats.autoscale(k * 7919 % 1000, F.when(k % 2 == 0, "exhaustive").otherwise("spatial"), F.when(k % 3 == 0, "global").otherwise("incremental"), k % 3)
    return A.table(spark, d, "customer").select(k.alias("k"), a.alias("matcher"), b.alias("mapper"), c.alias("level"))


@query("SELECT c_custkey AS k, CASE WHEN n = 0 OR u IS NULL THEN 'fallback' WHEN u - b > 0.1::DOUBLE * u AND u - b > 0.001::DOUBLE THEN 'ba' ELSE 'umeyama' END AS choice FROM (SELECT c_custkey, CASE WHEN c_custkey % 11 > 0 THEN CAST(c_custkey % 64 AS DOUBLE) / 1024 END AS u, CAST(c_custkey * 7919 % 64 AS DOUBLE) / 1024 AS b, c_custkey % 5 AS n FROM customer)")
def arbitration(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    return A.table(spark, d, "customer").select(k.alias("k"), stats.arbitration(F.when(k % 11 > 0, k % 64 / F.lit(1024.0)), k * 7919 % 64 / F.lit(1024.0), k % 5).alias("choice"))


@query("SELECT c_custkey AS k, CASE WHEN a <= 10000 THEN 1 WHEN a <= 40000 THEN 1 WHEN a <= 160000 THEN 2 WHEN a <= 640000 THEN 3 ELSE 4 END AS divisions FROM (SELECT c_custkey, c_custkey * 7919 % 1000003 + 1 AS a FROM customer)")
def tile_divisions(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    return A.table(spark, d, "customer").select(k.alias("k"), S.tile_divisions((k * 7919 % 1000003 + 1).cast("double")).alias("divisions"))


# -- tiles --------------------------------------------------------------------------------

_CELLS = """b AS (SELECT min(x) AS x0, min(y) AS y0, max(x) AS x1, max(y) AS y1 FROM centres), g AS (SELECT *, greatest(1, CAST(round_even(sqrt(12 * ((x1 - x0) / (y1 - y0))), 0) AS BIGINT)) AS cols FROM b),
gr AS (SELECT *, CAST(ceil(CAST(12 AS DOUBLE) / cols) AS BIGINT) AS rows FROM g)"""
_OWN = "own AS (SELECT name, x, y, CAST(least(cols - 1, greatest(0, floor((x - x0) / (x1 - x0) * cols))) AS BIGINT) AS i, CAST(least(rows - 1, greatest(0, floor((y - y0) / (y1 - y0) * rows))) AS BIGINT) AS j FROM centres, gr)"
_RECT = """rect AS (SELECT i, j, x0 + i * ((x1 - x0) / cols) AS rx0, y0 + j * ((y1 - y0) / rows) AS ry0, CASE WHEN i + 1 = cols THEN x1 ELSE x0 + (i + 1) * ((x1 - x0) / cols) END AS rx1, CASE WHEN j + 1 = rows THEN y1 ELSE y0 + (j + 1) * ((y1 - y0) / rows) END AS ry1
FROM gr, (SELECT unnest(range(0, 40)) AS i), (SELECT unnest(range(0, 40)) AS j) WHERE i < cols AND j < rows)"""


def _grid(spark: SparkSession, d: str) -> tuple[DataFrame, tiling.Grid]:
    c = A.centres(spark, d)
    return c, tiling.Grid.over(c, 12)


@query(with_views(f"{_CELLS}, {_RECT} SELECT i, j, round(rx0, 9) AS x0, round(ry0, 9) AS y0, round(rx1, 9) AS x1, round(ry1, 9) AS y1 FROM rect", "centres"))
def grid_cells(spark: SparkSession, d: str) -> DataFrame:
    cells = _grid(spark, d)[1].cells(spark)
    return cells.select("i", "j", *[F.round(c, 9).alias(c) for c in ("x0", "y0", "x1", "y1")])


@query(with_views(f"{_CELLS}, {_OWN} SELECT name, i, j FROM own", "centres"))
def cell_assignment(spark: SparkSession, d: str) -> DataFrame:
    return tiling.assigned(*_grid(spark, d)).select("name", "i", "j")


_HALO = "halo AS (SELECT name, rect.i, rect.j FROM own JOIN rect ON x BETWEEN rx0 - 3 AND rx1 + 3 AND y BETWEEN ry0 - 3 AND ry1 + 3 AND (own.i <> rect.i OR own.j <> rect.j))"


@query(with_views(f"{_CELLS}, {_OWN}, {_RECT}, {_HALO} SELECT name, i, j FROM halo", "centres"))
def halo_members(spark: SparkSession, d: str) -> DataFrame:
    return tiling.halo(*_grid(spark, d), 3.0)


@query(with_views(f"{_CELLS}, {_OWN}, {_RECT}, {_HALO}, h AS (SELECT i, j, count(*) AS n FROM halo GROUP BY i, j) SELECT 'tile_' || lpad(CAST(i AS VARCHAR), 2, '0') || '_' || lpad(CAST(j AS VARCHAR), 2, '0') AS id, count(*) AS n_core, any_value(coalesce(h.n, 0)) AS n_halo, min(name) AS first_name FROM own LEFT JOIN h USING (i, j) GROUP BY i, j", "centres"))
def tile_partition(spark: SparkSession, d: str) -> DataFrame:
    return tiling.partition(*_grid(spark, d), 3.0).select("id", "n_core", "n_halo", "first_name")


@query(with_views(f"{_CELLS}, {_OWN} SELECT DISTINCT 'tile_' || lpad(CAST(i AS VARCHAR), 2, '0') || '_' || lpad(CAST(j AS VARCHAR), 2, '0') AS id FROM own WHERE (i + j) % 2 = 1", "centres"))
def pending_tiles(spark: SparkSession, d: str) -> DataFrame:
    tiles = tiling.partition(*_grid(spark, d), 0.0)
    status = tiles.select("id", F.when((F.col("i") + F.col("j")) % 2 == 0, "done").otherwise("running").alias("status"))
    return tiling.pending(tiles.select("id"), status)


# -- windows and numbering ----------------------------------------------------------------

_PT = "w AS (SELECT pt, image, max(logc) AS weight FROM obs GROUP BY pt, image)"
_TOP = "top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pt ORDER BY weight DESC, image) AS rank FROM w) WHERE rank <= 4)"


def _weights(spark: SparkSession, d: str) -> DataFrame:
    return A.observations(spark, d).groupBy("pt", "image").agg(F.max("logc").alias("weight"))


@query(with_views(f"{_PT}, {_TOP} SELECT pt, image, weight, CAST(rank AS INT) AS rank FROM top", "obs"))
def topk_weights(spark: SparkSession, d: str) -> DataFrame:
    return topk.top_k(_weights(spark, d), "pt", "weight", "image")


@query(with_views(f"{_PT}, {_TOP}, k AS (SELECT *, max(weight) OVER (PARTITION BY pt) AS best FROM top) SELECT pt, image, round(weight / nullif(sum(weight) OVER (PARTITION BY pt), 0), 9) AS share FROM (SELECT * FROM k WHERE weight >= 0.15::DOUBLE * best)", "obs"))
def weight_normalise(spark: SparkSession, d: str) -> DataFrame:
    return topk.normalised(topk_weights(spark, d), "pt", "weight").select("pt", "image", F.round("share", 9).alias("share"))


@query(with_views(f"{_EDGES} SELECT lo, hi, row_number() OVER (ORDER BY lo, hi) - 1 AS number FROM (SELECT DISTINCT lo, hi FROM e)", "vertices", "faces"))
def dense_renumber(spark: SparkSession, d: str) -> DataFrame:
    keys = mesh.edges(A.faces(spark, d)).select("lo", "hi").distinct().withColumn("key", F.struct("lo", "hi"))
    return stats.numbered(keys, "key").select("lo", "hi", F.col("ordinal").alias("number"))


@query(with_views("s AS (SELECT cls, count(*) AS n FROM cloud_a GROUP BY cls) SELECT cls, n, CAST(coalesce(sum(n) OVER (ORDER BY cls ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS \"offset\" FROM s", "cloud_a"))
def running_offsets(spark: SparkSession, d: str) -> DataFrame:
    return topk.running_offsets(stats.class_histogram(A.cloud_a(spark, d)), "cls", "n")


@query(with_views(f"{_EDGES} SELECT lo, hi, min(fid) AS fid FROM e GROUP BY lo, hi", "vertices", "faces"))
def first_occurrence(spark: SparkSession, d: str) -> DataFrame:
    return topk.first_occurrence(mesh.edges(A.faces(spark, d)), ["lo", "hi"], "fid", "fid")


@query(with_views(f"{_EDGES} SELECT fid, lo, hi, coalesce(lag(hi) OVER (PARTITION BY lo ORDER BY hi, fid) = hi, false) AS same FROM e", "vertices", "faces"))
def adjacent_equal(spark: SparkSession, d: str) -> DataFrame:
    return topk.adjacent_equal(mesh.edges(A.faces(spark, d)), "lo", ["hi", "fid"], "hi")


# -- neighbours ---------------------------------------------------------------------------


def _points(cloud: DataFrame) -> DataFrame:
    return cloud.select(F.col("pid").alias("id"), "x", "y", "z")


_NN = "near AS (SELECT b.pid AS id, min((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z)) AS d2 FROM cloud_b b, cloud_a a WHERE abs(a.x - b.x) <= 4 AND abs(a.y - b.y) <= 4 GROUP BY b.pid)"


@query(with_views(f"{_NN} SELECT id, d2 FROM near", "cloud_a", "cloud_b"))
def nn_distance(spark: SparkSession, d: str) -> DataFrame:
    return neighbours.nearest(_points(A.cloud_b(spark, d)), _points(A.cloud_a(spark, d))).select("id", "d2")


@query(with_views(f"{_NN} SELECT count(*) AS n, round(avg(sqrt(d2)), 6) AS mean, round(stddev_pop(sqrt(d2)), 6) AS std, round(sqrt(avg(d2)), 6) AS rms, round(quantile_cont(sqrt(d2), 0.95), 6) AS p95, round(max(sqrt(d2)), 6) AS max, round(avg(CASE WHEN sqrt(d2) <= 0.125 THEN 1.0::DOUBLE ELSE 0 END), 9) AS completeness FROM near", "cloud_a", "cloud_b"))
def completeness(spark: SparkSession, d: str) -> DataFrame:
    near = written(nn_distance(spark, d), "near")
    out = neighbours.distance_summary(near).join(F.broadcast(near.agg(F.avg(F.when(F.sqrt("d2") <= 0.125, 1.0).otherwise(0.0)).alias("completeness"))))
    return out.select("n", *[F.round(c, 6).alias(c) for c in ("mean", "std", "rms", "p95", "max")], F.round("completeness", 9).alias("completeness"))


@query(with_views("near AS (SELECT b.pid AS id, arg_min(a.cls, {'d': (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z), 'p': a.pid}) AS cls FROM cloud_b b, cloud_a a WHERE abs(a.x - b.x) <= 4 AND abs(a.y - b.y) <= 4 GROUP BY b.pid) SELECT id, cls FROM near", "cloud_a", "cloud_b"))
def nn_class_transfer(spark: SparkSession, d: str) -> DataFrame:
    fixed = A.cloud_a(spark, d).select(F.col("pid").alias("id"), "x", "y", "z", "cls")
    return neighbours.nearest(_points(A.cloud_b(spark, d)), fixed, payload=("cls",)).select("id", "cls")


@query(with_views("near AS (SELECT b.name, min((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS d2 FROM centres a, centres b WHERE a.name <> b.name GROUP BY b.name) SELECT round(2 * median(sqrt(d2)), 9) AS eps FROM near WHERE d2 > 0", "centres"))
def auto_eps(spark: SparkSession, d: str) -> DataFrame:
    points = A.centres(spark, d).select(F.col("name").alias("id"), "x", "y")
    return neighbours.spacing(points, axes=("x", "y")).select(F.round(2.0 * F.col("spacing"), 9).alias("eps"))


@query()
def surface_roughness(spark: SparkSession, d: str) -> DataFrame:
    """Distance of lattice vertices to the plane of their neighbourhood."""
    v = A.vertices(spark, d).select(F.col("vid").alias("id"), "x", "y", "z")
    return neighbours.roughness(v, k=8).select("id", F.round("residual", 6).alias("residual"))


# -- meshes and rasters -------------------------------------------------------------------

_FRAG = """f AS (SELECT *, x0 / 0.5 AS px0, (50 - y0) / 0.5 AS py0, x1 / 0.5 AS px1, (50 - y1) / 0.5 AS py1, x2 / 0.5 AS px2, (50 - y2) / 0.5 AS py2 FROM triangles),
px AS (SELECT *, unnest(range(CAST(ceil(least(py0, py1, py2) - 0.5) AS BIGINT), CAST(floor(greatest(py0, py1, py2) - 0.5) AS BIGINT) + 1)) AS r FROM f),
pc AS (SELECT *, unnest(range(CAST(ceil(least(px0, px1, px2) - 0.5) AS BIGINT), CAST(floor(greatest(px0, px1, px2) - 0.5) AS BIGINT) + 1)) AS c FROM px),
ar AS (SELECT *, (px1 - px0) * (py2 - py0) - (py1 - py0) * (px2 - px0) AS det FROM pc),
bw AS (SELECT *, ((c + 0.5 - px0) * (py2 - py0) - (r + 0.5 - py0) * (px2 - px0)) / det AS w1, ((px1 - px0) * (r + 0.5 - py0) - (py1 - py0) * (c + 0.5 - px0)) / det AS w2 FROM ar WHERE abs(det) > 1e-12),
fr AS (SELECT fid, r, c, (1 - w1 - w2) * z0 + w1 * z1 + w2 * z2 AS z FROM bw WHERE w1 >= 0 AND w2 >= 0 AND 1 - w1 - w2 >= 0)"""


@query(with_views(f"{_FRAG} SELECT r, c, round(max(z), 9) AS z, arg_max(fid, {{'z': z, 'f': -fid}}) AS fid FROM fr GROUP BY r, c", "vertices", "faces", "triangles"))
def rasterise_winners(spark: SparkSession, d: str) -> DataFrame:
    return mesh.rasterised(_tri(spark, d), 0.5, 0.0, 50.0).select("r", "c", F.round("z", 9).alias("z"), "fid")


_MAJ3 = "CASE WHEN (a = b OR a = c) AND a > 0 THEN a WHEN b = c AND b > 0 THEN b ELSE coalesce(nullif(least(CASE WHEN a > 0 THEN a ELSE 99 END, CASE WHEN b > 0 THEN b ELSE 99 END, CASE WHEN c > 0 THEN c ELSE 99 END), 99), 0) END"


@query(with_views(f"SELECT fid, {_MAJ3} AS cls FROM (SELECT fid, v0 % 4 AS a, v1 % 3 AS b, v2 % 4 AS c FROM faces)", "vertices", "faces"))
def triangle_classes(spark: SparkSession, d: str) -> DataFrame:
    return A.faces(spark, d).select("fid", S.majority_of_three(F.col("v0") % 4, F.col("v1") % 3, F.col("v2") % 4).alias("cls"))


@query(with_views("SELECT r, c, v FROM rast_a", "rast_a"))
def raster_cells(spark: SparkSession, d: str) -> DataFrame:
    return A.raster(spark, d, 0)


@query(with_views("o AS (SELECT a.r, a.c, (SELECT min(b.v) FROM rast_a b WHERE abs(b.r - a.r) <= 1 AND abs(b.c - a.c) <= 1) AS v FROM rast_a a) SELECT r, c, v FROM o", "rast_a"))
def focal_minimum(spark: SparkSession, d: str) -> DataFrame:
    return grid.focal(A.raster(spark, d, 0), 1, "min")


@query(with_views("t AS (SELECT unnest(range(0, 30)) AS r), u AS (SELECT unnest(range(0, 24)) AS c), grid AS (SELECT r, c FROM t, u), gap AS (SELECT * FROM grid ANTI JOIN rast_b USING (r, c)), near AS (SELECT gap.r, gap.c, sum(v / ((gap.r - b.r) ** 2 + (gap.c - b.c) ** 2)) / sum(1 / ((gap.r - b.r) ** 2 + (gap.c - b.c) ** 2)) AS v FROM gap JOIN rast_b b ON abs(gap.r - b.r) <= 3 AND abs(gap.c - b.c) <= 3 GROUP BY 1, 2) SELECT r, c, round(v, 6) AS v FROM (SELECT grid.r, grid.c, v FROM grid JOIN rast_b USING (r, c) UNION ALL SELECT * FROM near)", "rast_b"))
def inverse_distance_fill(spark: SparkSession, d: str) -> DataFrame:
    cells = A.raster(spark, d, 1)
    return grid.inverse_distance_fill(cells, grid.whole_target(cells)).withColumn("v", F.round("v", 6))


@query(with_views("t AS (SELECT unnest(range(1, 28)) AS r), u AS (SELECT unnest(range(1, 22)) AS c), g AS (SELECT r, c, CAST(floor((r + 0.5) * 0.75) AS BIGINT) AS sr, CAST(floor((c + 0.5) * 0.75) AS BIGINT) AS sc FROM t, u) SELECT g.r, g.c, v FROM g JOIN rast_a s ON s.r = sr AND s.c = sc", "rast_a"))
def nearest_resample(spark: SparkSession, d: str) -> DataFrame:
    target = spark.range(27 * 21).select((F.floor(F.col("id") / 21) + 1).cast("long").alias("r"), (F.col("id") % 21 + 1).alias("c"))
    return grid.nearest_resample(A.raster(spark, d, 0), 1.0, 0.75, target)


@query(
    with_views(
        """t AS (SELECT unnest(range(1, 28)) AS r), u AS (SELECT unnest(range(1, 22)) AS c), g AS (SELECT r, c, (r + 0.5::DOUBLE) * 0.75 - 0.5 AS y, (c + 0.5::DOUBLE) * 0.75 - 0.5 AS x FROM t, u),
s AS (SELECT g.r, g.c, v * (1 - abs(y - a.r)) * (1 - abs(x - a.c)) AS part FROM g JOIN rast_a a ON a.r - floor(y) IN (0, 1) AND a.c - floor(x) IN (0, 1)) SELECT r, c, round(sum(part), 6) AS v FROM s GROUP BY r, c HAVING count(*) = 4""",
        "rast_a",
    )
)
def bilinear_resample(spark: SparkSession, d: str) -> DataFrame:
    target = spark.range(27 * 21).select((F.floor(F.col("id") / 21) + 1).cast("long").alias("r"), (F.col("id") % 21 + 1).alias("c"))
    return grid.bilinear_resample(A.raster(spark, d, 0), 1.0, 0.75, target).withColumn("v", F.round("v", 6))


_WHOLE = """e AS (SELECT min(r) AS r0, max(r) AS r1, min(c) AS c0, max(c) AS c1 FROM rast_a),
t AS (SELECT unnest(range(CAST(floor(r0 / 0.75) AS BIGINT), CAST(ceil((r1 + 1) / 0.75) AS BIGINT))) AS r FROM e), u AS (SELECT unnest(range(CAST(floor(c0 / 0.75) AS BIGINT), CAST(ceil((c1 + 1) / 0.75) AS BIGINT))) AS c FROM e)"""


@query(with_views(f"{_WHOLE}, g AS (SELECT r, c, CAST(floor((r + 0.5) * 0.75) AS BIGINT) AS sr, CAST(floor((c + 0.5) * 0.75) AS BIGINT) AS sc FROM t, u) SELECT g.r, g.c, v FROM g JOIN rast_a s ON s.r = sr AND s.c = sc", "rast_a"))
def nearest_resample_whole(spark: SparkSession, d: str) -> DataFrame:
    """As nearest_resample, over the raster's own bounds instead of a fixed window."""
    cells = A.raster(spark, d, 0)
    return grid.nearest_resample(cells, 1.0, 0.75, grid.whole_target(cells, 1.0, 0.75))


@query(
    with_views(
        f"""{_WHOLE}, g AS (SELECT r, c, (r + 0.5::DOUBLE) * 0.75 - 0.5 AS y, (c + 0.5::DOUBLE) * 0.75 - 0.5 AS x FROM t, u),
s AS (SELECT g.r, g.c, v * (1 - abs(y - a.r)) * (1 - abs(x - a.c)) AS part FROM g JOIN rast_a a ON a.r - floor(y) IN (0, 1) AND a.c - floor(x) IN (0, 1)) SELECT r, c, round(sum(part), 6) AS v FROM s GROUP BY r, c HAVING count(*) = 4""",
        "rast_a",
    )
)
def bilinear_resample_whole(spark: SparkSession, d: str) -> DataFrame:
    """As bilinear_resample, over the raster's own bounds instead of a fixed window."""
    cells = A.raster(spark, d, 0)
    return grid.bilinear_resample(cells, 1.0, 0.75, grid.whole_target(cells, 1.0, 0.75)).withColumn("v", F.round("v", 6))


def lowpass_sql(cells: str, sigma: float, name: str = "smooth") -> str:
    """A common table expression (r, c, v, low) over the cells (r, c, v) of another one."""
    reach = int(4 * sigma + 0.5)
    kernel = f"exp(-0.5::DOUBLE * ((b.r - a.r) ** 2 + (b.c - a.c) ** 2) / {D(sigma)} ** 2)"
    return f"{name} AS (SELECT a.r AS r, a.c AS c, any_value(a.v) AS v, sum(b.v * {kernel}) / greatest(sum({kernel}), 1e-6) AS low FROM {cells} a JOIN {cells} b ON abs(a.r - b.r) <= {reach} AND abs(a.c - b.c) <= {reach} GROUP BY a.r, a.c)"


@query(with_views(lowpass_sql("rast_a", 1.5) + " SELECT r, c, round(low, 6) AS low FROM smooth", "rast_a"))
def raster_lowpass(spark: SparkSession, d: str) -> DataFrame:
    return grid.lowpass(A.raster(spark, d, 0), 1.5).select("r", "c", F.round("low", 6).alias("low"))


_POINTS = {
    "top": ("a", "b", "c + (level - a) / (b - a)", "r + 0.0::DOUBLE", "b", "r", "c", 0),
    "right": ("b", "e", "c + 1.0::DOUBLE", "r + (level - b) / (e - b)", "e", "r", "c + 1", 1),
    "bottom": ("d", "e", "c + (level - d) / (e - d)", "r + 1.0::DOUBLE", "d", "r + 1", "c", 0),
    "left": ("a", "d", "c + 0.0::DOUBLE", "r + (level - a) / (d - a)", "a", "r", "c", 1),
}
_CONTOURS = f"""sq AS (SELECT w.r, w.c, w.v AS a, x.v AS b, y.v AS d, z.v AS e FROM rast_a w JOIN rast_a x ON x.r = w.r AND x.c = w.c + 1 JOIN rast_a y ON y.r = w.r + 1 AND y.c = w.c JOIN rast_a z ON z.r = w.r + 1 AND z.c = w.c + 1),
lv AS (SELECT * FROM (SELECT *, 20.0::DOUBLE * unnest(range(CAST(floor(least(a, b, d, e) / 20) AS BIGINT), CAST(floor(greatest(a, b, d, e) / 20) AS BIGINT) + 1)) AS level FROM sq) WHERE level > least(a, b, d, e) AND level <= greatest(a, b, d, e)),
pt AS (SELECT *, {", ".join(f"CASE WHEN ({p} >= level) <> ({q} >= level) THEN {{'x': {x}, 'y': {y}, 'up': {up} >= level, 'e': ({er}) * 1000000 + ({ec}) * 2 + {down}}} END AS {n}" for n, (p, q, x, y, up, er, ec, down) in _POINTS.items())} FROM lv),
pair AS (SELECT *, list_filter(["top", "right", bottom, "left"], lambda p: p IS NOT NULL) AS p, ((a + b + d + e) / 4 >= level) = (a >= level) AS joined FROM pt),
seg AS (SELECT r, c, level, unnest(CASE WHEN len(p) < 4 THEN [p] WHEN joined THEN [["top", "right"], [bottom, "left"]] ELSE [["top", "left"], [bottom, "right"]] END) AS p FROM pair)"""


@query(with_views(f"{_CONTOURS} SELECT r, c, level, round(p[1].x, 6) AS x0, round(p[1].y, 6) AS y0, round(p[2].x, 6) AS x1, round(p[2].y, 6) AS y1 FROM seg", "rast_a"))
def contours(spark: SparkSession, d: str) -> DataFrame:
    out = grid.contour_segments(A.raster(spark, d, 0), 20.0)
    return out.select("r", "c", "level", *[F.round(c, 6).alias(c) for c in ("x0", "y0", "x1", "y1")])


def _opened_sql() -> str:
    """Openings of the lowest cells by windows of 1, 2 and 4, and which of them lower a cell too much."""
    parts = [f"w0 AS MATERIALIZED (SELECT CAST(floor(y / {GSD}) AS BIGINT) AS r, CAST(floor(x / {GSD}) AS BIGINT) AS c, min(z) AS v, min(z) AS h, false AS object FROM cloud_a GROUP BY 1, 2)"]
    for k, radius in enumerate((1, 2, 4)):
        around = f"abs(a.r - b.r) <= {radius} AND abs(a.c - b.c) <= {radius}"
        parts += [
            f"low{k} AS (SELECT a.r, a.c, min(b.h) AS h FROM w{k} a JOIN w{k} b ON {around} GROUP BY a.r, a.c)",
            f"open{k} AS (SELECT a.r, a.c, max(b.h) AS h FROM low{k} a JOIN low{k} b ON {around} GROUP BY a.r, a.c)",
            f"w{k + 1} AS MATERIALIZED (SELECT r, c, w.v, o.h, w.object OR w.h - o.h > 0.15::DOUBLE * {radius} * {GSD} + 0.5 AS object FROM w{k} w JOIN open{k} o USING (r, c))",
        ]
    return ", ".join(parts)


@query(with_views(_opened_sql() + " SELECT r, c, v FROM w3 WHERE NOT object", "cloud_a"))
def ground_filter(spark: SparkSession, d: str) -> DataFrame:
    lowest = grid.binned(A.cloud_a(spark, d), GSD).groupBy("r", "c").agg(F.min("z").alias("v"))
    return grid.ground_cells(lowest, GSD)


@query(with_views("s AS (SELECT r, c FROM rast_a WHERE v > 120) SELECT count(*) AS cells FROM s", "rast_a"))
def raster_component_cells(spark: SparkSession, d: str) -> DataFrame:
    return graph.raster_components(A.raster(spark, d, 0).filter("v > 120")).agg(F.count("*").alias("cells"))


@query(
    "WITH RECURSIVE " + A.SQL["rast_a"] + """, s AS (SELECT r, c, r * 2147483648 + c AS id FROM rast_a WHERE v > 120),
links AS (SELECT a.id AS a, b.id AS b FROM s a JOIN s b ON abs(a.r - b.r) + abs(a.c - b.c) = 1),
reach(root, id) AS (SELECT id, id FROM s UNION SELECT root, b FROM reach JOIN links ON id = a),
low AS (SELECT id, min(root) AS component FROM reach GROUP BY id)
SELECT r, c, component, count(*) OVER (PARTITION BY component) AS cells FROM s JOIN low USING (id)"""
)
def raster_component_labels(spark: SparkSession, d: str) -> DataFrame:
    """The component of each cell and how many cells it has."""
    found = written(graph.raster_components(A.raster(spark, d, 0).filter("v > 120")).select("r", "c", "component"), "components")
    return found.join(found.groupBy("component").agg(F.count("*").alias("cells")), "component").select("r", "c", "component", "cells")


# -- graphs -------------------------------------------------------------------------------

_LINKS = "links AS (SELECT a.name AS a, b.name AS b FROM centres a JOIN centres b ON (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 2.25)"


@query(
    "WITH RECURSIVE " + A.SQL["centres"] + f", {_LINKS}, reach(root, name) AS (SELECT name, name FROM centres UNION SELECT root, b FROM reach JOIN links ON name = a) SELECT name AS id, min(root) AS component FROM reach GROUP BY name"
)
def proximity_components(spark: SparkSession, d: str) -> DataFrame:
    points = A.centres(spark, d).select(F.col("name").alias("id"), "x", "y")
    return graph.proximity_components(points, 1.5)


# -- exposure -----------------------------------------------------------------------------

_HALF = """{0} AS (SELECT o.image, avg(o.logc - p.a) AS g FROM obs o JOIN (SELECT pt, avg(logc - g) AS a FROM obs JOIN {1} USING (image) GROUP BY pt) p USING (pt) GROUP BY o.image)"""


@query(with_views(f"g0 AS (SELECT DISTINCT image, {D(0)} AS g FROM obs), {_HALF.format('g1', 'g0')}, {_HALF.format('g2', 'g1')}, {_HALF.format('g3', 'g2')} SELECT image, round(g, 6) AS g FROM g3", "obs"))
def exposure_half_steps(spark: SparkSession, d: str) -> DataFrame:
    obs = A.observations(spark, d)
    g = obs.select("image").distinct().withColumn("g", F.lit(0.0))
    for _ in range(3):
        g = fits.exposure_half_steps(obs, g)
    return g.select("image", F.round("g", 6).alias("g"))


@query()
def icp_report(spark: SparkSession, d: str) -> DataFrame:
    """Registration of the later epoch on the earlier one over the area that did not change."""
    a, b = _points(A.cloud_a(spark, d)), _points(A.cloud_b(spark, d))
    found = fits.stable_registration(b, a)
    t = [float(x) for x in found["t"]]
    row = (found["stable_fraction"], found["registration_error"], *t)
    return spark.createDataFrame([row], "stable_fraction double, registration_error double, tx double, ty double, tz double")


def _cylinder(name: str, cloud: str) -> str:
    return f"""{name} AS (SELECT b.pid AS id, avg(p.z) AS mean, var_pop(p.z) AS var, count(*) AS n FROM cloud_b b JOIN {cloud} p ON abs(p.x - b.x) <= 2 AND abs(p.y - b.y) <= 2
  WHERE (p.x - b.x) * (p.x - b.x) + (p.y - b.y) * (p.y - b.y) <= 4 AND abs(p.z - b.z) <= 60 GROUP BY b.pid)"""


M3C2_SQL = f"""{_cylinder("c1", "cloud_a")}, {_cylinder("c2", "cloud_b")},
m3c2 AS (SELECT b.pid AS id, c2.mean - c1.mean AS distance, 1.96::DOUBLE * sqrt(c1.var / c1.n + c2.var / c2.n) AS lod FROM cloud_b b LEFT JOIN c1 ON b.pid = c1.id LEFT JOIN c2 ON b.pid = c2.id)"""


@query(with_views(M3C2_SQL + " SELECT id, round(distance, 6) + 0 AS distance, round(lod, 6) AS lod, coalesce(abs(distance) > lod, false) AS significant FROM m3c2", "cloud_a", "cloud_b"))
def m3c2_vertical(spark: SparkSession, d: str) -> DataFrame:
    a, b = _points(A.cloud_a(spark, d)), _points(A.cloud_b(spark, d))
    radius = 2.0
    found = change.m3c2(b, a, b, radius, max(30 * radius, 3.0))
    return found.select("id", (F.round("distance", 6) + 0.0).alias("distance"), F.round("lod", 6).alias("lod"), "significant")
