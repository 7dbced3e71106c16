"""Queries of image finishing, native resolution, reports, tiles and option rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geokernel.functions import scalar as S
from geokernel.operators import change, imagery, stats, tiling
from geokernel.operators.tables import written
from geokernel.plans.catalogue import M3C2_SQL, D, L, lowpass_sql, query
from geokernel.sources import adapters as A
from geokernel.sources.adapters import with_views

_LUM = "0.299::DOUBLE * red + 0.587::DOUBLE * green + 0.114::DOUBLE * blue"
_CELLS = f"lum AS (SELECT r, c, {_LUM} AS v FROM image WHERE alpha > 0)"


@query(with_views(f"{_CELLS}, {lowpass_sql('lum', 2.0)}, s AS (SELECT count(*) AS valid_px, stddev_pop(low) AS l, stddev_pop(v) AS t FROM smooth) SELECT valid_px, round(l, 6) AS lowfreq_std, round(t, 6) AS total_std, round(CASE WHEN t > 1e-9 THEN l / t ELSE 0 END, 6) AS ratio FROM s", "rast_a", "image"))
def tonal_variation(spark: SparkSession, d: str) -> DataFrame:
    found = imagery.tonal_variation(A.image(spark, d), 1.0, 4.0)
    return found.select("valid_px", *[F.round(c, 6).alias(c) for c in ("lowfreq_std", "total_std", "ratio")])


_BANDS = ("red", "green", "blue")


@query(with_views(f"{_CELLS}, {lowpass_sql('lum', 2.0)}, m AS (SELECT avg(v) AS m FROM lum), f AS (SELECT image.r AS r, image.c AS c, alpha, red, green, blue, sqrt(m / greatest(low, 1e-6)) AS k FROM m, image LEFT JOIN smooth ON image.r = smooth.r AND image.c = smooth.c) SELECT r, c, " + ", ".join(f"CAST(CASE WHEN alpha > 0 THEN floor(greatest(0, least(255, {b} * k))) ELSE {b} END AS INT) AS {b}" for b in _BANDS) + ", alpha FROM f", "rast_a", "image"))
def flattened_image(spark: SparkSession, d: str) -> DataFrame:
    return imagery.flattened(A.image(spark, d), 1.0, 0.5, 4.0)


_GAIN = ", ".join(f"{_LUM.replace('red', 'r0').replace('green', 'g0').replace('blue', 'b0')} AS target" for _ in range(1))


@query(
    with_views(
        f"""g AS (SELECT avg(red) AS r0, avg(green) AS g0, avg(blue) AS b0 FROM image WHERE alpha > 0), t AS (SELECT *, {_GAIN} FROM g),
w AS (SELECT r, c, alpha, """ + ", ".join(f"CAST(CASE WHEN alpha > 0 THEN floor(greatest(0, least(255, {b} * (target / greatest({b[0]}0, 1e-6))))) ELSE {b} END AS INT) AS {b}" for b in _BANDS) + f""" FROM image, t),
q AS (SELECT quantile_cont({_LUM}, 0.01) AS lo, quantile_cont({_LUM}, 0.99) AS hi FROM w WHERE alpha > 0),
k AS (SELECT *, greatest(0, least(255, ({_LUM} - lo) * (255 / (hi - lo)))) / greatest({_LUM}, 1e-6) AS k FROM w, q),
s AS (SELECT r, c, alpha, """ + ", ".join(f"CAST(CASE WHEN alpha > 0 THEN floor(greatest(0, least(255, {b} * k))) ELSE {b} END AS INT) AS {b}" for b in _BANDS) + """ FROM k)
SELECT r, c, """ + ", ".join(f"CAST(CASE WHEN alpha > 0 THEN floor(greatest(0, least(255, 255 * pow(greatest(0, least(1, ({b} + 0.125::DOUBLE * 255) / 255)), 2)))) ELSE {b} END AS INT) AS {b}" for b in _BANDS) + ", alpha FROM s",
        "rast_a", "image",
    )
)
def finished_image(spark: SparkSession, d: str) -> DataFrame:
    """White balance, contrast and tone, in that order."""
    return imagery.finished(A.image(spark, d), 1.0, "auto", 0.0, 0.125, 2.0)[0]


@query(
    with_views(
        f"""i AS (SELECT {D(24)} AS width, {D(31)} AS height, {D(100)} AS gsd_cm, CAST(count(*) FILTER (WHERE alpha > 0) AS DOUBLE) AS area_m2, count(*) FILTER (WHERE alpha > 0) * {D(100)} / (24 * 31) AS coverage_pct FROM image),
s AS (SELECT CAST(count(v) AS DOUBLE) AS cells, min(v) AS zmin, max(v) AS zmax FROM rast_a)
SELECT 'ortho' AS section, item, round(value, 6) AS value FROM (UNPIVOT i ON width, height, gsd_cm, area_m2, coverage_pct INTO NAME item VALUE value)
UNION ALL SELECT 'dsm', item, round(value, 6) FROM (UNPIVOT s ON cells, zmin, zmax INTO NAME item VALUE value)""",
        "rast_a", "image",
    )
)
def report_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = imagery.report_rows(("ortho", imagery.image_report(A.image(spark, d), 24, 31, 1.0)), ("dsm", imagery.surface_report(A.raster(spark, d, 0))))
    return rows.withColumn("value", F.round("value", 6))


def _views(spark: SparkSession, d: str) -> DataFrame:
    """The cameras of the planted scene as pinhole views."""
    _, images, cameras = A.site(spark, d)
    r = S.quat_to_rot(*[F.col("q")[i] for i in range(4)])
    return images.join(cameras, "camera_id").select(F.col("name").alias("view"), r.alias("r"), "t", F.col("params")[0].alias("f"), F.col("params")[1].alias("cx"), F.col("params")[2].alias("cy"), "width", "height")


_SEEN = """v AS (SELECT 'img_' || c_custkey AS view, CAST(c_custkey * 7919 % 12800 AS DOUBLE) / 128 AS x0, CAST(c_custkey * 104729 % 12799 AS DOUBLE) / 128 AS y0, f FROM customer JOIN cameras ON camera_id = c_nationkey),
p AS (SELECT view, f, pid, x - x0 AS px, y0 - y AS py, 40 - z AS pz FROM v, cloud_a),
seen AS (SELECT view, f, pid, sqrt(px * px + py * py + pz * pz) AS distance FROM p WHERE pz > 1e-6 AND f * px / pz + 2000 >= 0 AND f * px / pz + 2000 < 4000 AND f * py / pz + 1500 >= 0 AND f * py / pz + 1500 < 3000)"""


@query(with_views(_SEEN + " SELECT view, count(*) AS n, round(max(distance), 6) AS far FROM seen GROUP BY view", "cameras", "cloud_a"))
def points_in_view(spark: SparkSession, d: str) -> DataFrame:
    return imagery.seen_counts(_views(spark, d), A.cloud_a(spark, d)).withColumn("far", F.round("far", 6))


@query(with_views(_SEEN + ", m AS (SELECT view, median(distance) / any_value(f) AS g FROM seen GROUP BY view HAVING count(*) >= 20) SELECT round(median(g), 9) AS gsd FROM m", "cameras", "cloud_a"))
def native_gsd(spark: SparkSession, d: str) -> DataFrame:
    return imagery.native_gsd(_views(spark, d), A.cloud_a(spark, d)).select(F.round("gsd", 9).alias("gsd"))


@query("WITH n AS (SELECT l_partkey AS vid, l_suppkey AS patch, CAST(floor(l_extendedprice) AS BIGINT) % 256 / CAST(8 AS DOUBLE) AS value FROM lineitem), m AS (SELECT vid, avg(value) AS target FROM n GROUP BY vid HAVING count(*) > 1) SELECT vid, patch, round(target - value, 9) + 0 AS data FROM n JOIN m USING (vid)")
def seam_targets(spark: SparkSession, d: str) -> DataFrame:
    li = A.table(spark, d, "lineitem")
    nodes = li.select(F.col("l_partkey").alias("vid"), F.col("l_suppkey").alias("patch"), (F.floor("l_extendedprice").cast("long") % 256 / F.lit(8.0)).alias("value"))
    return imagery.seam_targets(nodes).withColumn("data", F.round("data", 9) + 0.0)


@query("WITH s AS (SELECT l_orderkey AS fid, l_linenumber % 2 AS page, l_partkey % 16 AS r, l_suppkey % 16 AS c, CAST(floor(l_quantity) AS BIGINT) / CAST(64 AS DOUBLE) AS w, CAST(floor(l_extendedprice) AS BIGINT) % 256 AS v FROM lineitem), f AS (SELECT fid, page, r, c, sum(w * v) / sum(w) AS v FROM s GROUP BY ALL) SELECT CAST(page AS BIGINT) AS page, r, c, round(avg(v), 6) AS value FROM f GROUP BY page, r, c")
def texel_colours(spark: SparkSession, d: str) -> DataFrame:
    li = A.table(spark, d, "lineitem")
    rows = li.select(F.col("l_orderkey").alias("fid"), (F.col("l_linenumber") % 2).cast("long").alias("page"), (F.col("l_partkey") % 16).alias("r"), (F.col("l_suppkey") % 16).alias("c"), (F.floor("l_quantity") / F.lit(64.0)).alias("weight"), (F.floor("l_extendedprice").cast("long") % 256).alias("value"))
    return imagery.texel_colours(rows).withColumn("value", F.round("value", 6))


@query(with_views(M3C2_SQL + " SELECT CAST(count(*) AS DOUBLE) AS core_points, round(median(distance), 6) + 0 AS median_change, round(median(lod), 6) AS median_lod, round(avg(CASE WHEN coalesce(abs(distance) > lod, false) THEN 1.0::DOUBLE ELSE 0 END), 9) AS significant FROM m3c2", "cloud_a", "cloud_b"))
def m3c2_summary(spark: SparkSession, d: str) -> DataFrame:
    points = lambda c: c.select(F.col("pid").alias("id"), "x", "y", "z")
    a, b = points(A.cloud_a(spark, d)), points(A.cloud_b(spark, d))
    found = imagery.change_summary(change.m3c2(b, a, b, 2.0, 60.0))
    return found.select("core_points", (F.round("median_change", 6) + 0.0).alias("median_change"), F.round("median_lod", 6).alias("median_lod"), F.round("significant", 9).alias("significant"))


@query("SELECT c_custkey AS k, coalesce(CASE WHEN c_custkey % 3 = 0 THEN CAST(c_custkey % 16 AS DOUBLE) / 8 END, CASE WHEN c_custkey % 5 = 0 THEN CAST(c_custkey % 32 AS DOUBLE) / 8 END, CASE WHEN c_custkey % 7 = 0 THEN CAST(c_custkey % 64 AS DOUBLE) / 8 END, 0) AS error FROM customer")
def registration_errors(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    part = lambda n, m: F.when(k % n == 0, k % m / F.lit(8.0))
    return A.table(spark, d, "customer").select(k.alias("k"), imagery.registration_error(part(3, 16), part(5, 32), part(7, 64)).alias("error"))


@query(with_views(f"n AS (SELECT count(*) AS n FROM cloud_a), i AS (SELECT CASE k WHEN 999 THEN n - 1 ELSE CAST(floor(CAST(n - 1 AS DOUBLE) / 999 * k) AS BIGINT) END AS i FROM range(1000) r(k), n) SELECT pid, x, y, cls FROM (SELECT *, row_number() OVER (ORDER BY pid) - 1 AS i FROM cloud_a) WHERE i IN (SELECT i FROM i)", "cloud_a"))
def classified_sample(spark: SparkSession, d: str) -> DataFrame:
    """A sample of even steps over a classified cloud; its size is the parameter of the scan."""
    return imagery.evenly_spaced(A.cloud_a(spark, d), "pid", 1000).select("pid", "x", "y", "cls")


_TILES = "b AS (SELECT tile, CAST(tile % 4 * 25 AS DOUBLE) AS x0, CAST(tile // 4 * 25 AS DOUBLE) AS y0 FROM range(16) t(tile))"


@query(with_views(f"{_TILES} SELECT pid, tile, x, y FROM (SELECT pid, pid % 16 AS tile, x, y FROM cloud_a) JOIN b USING (tile) WHERE x BETWEEN x0 AND x0 + 25 AND y BETWEEN y0 AND y0 + 25", "cloud_a"))
def tile_cloud_merge(spark: SparkSession, d: str) -> DataFrame:
    """Points dealt to tiles by number; only those within their tile's core are merged."""
    clouds = A.cloud_a(spark, d).select("pid", (F.col("pid") % 16).alias("tile"), "x", "y")
    t = F.col("id")
    x0, y0 = (t % 4 * 25).cast("double"), (F.floor(t / 4) * 25).cast("double")
    bounds = spark.range(16).select(t.alias("tile"), x0.alias("x0"), y0.alias("y0"), (x0 + 25).alias("x1"), (y0 + 25).alias("y1"))
    return tiling.merged_clouds(clouds, bounds)


_MEMBERS = "members AS (SELECT DISTINCT o_orderkey % 7 AS tile, 'img_' || o_custkey AS name FROM orders)"


@query(with_views(f"{_MEMBERS} SELECT tile, name, camera_id FROM members JOIN names USING (name)", "names"))
def tile_subset_images(spark: SparkSession, d: str) -> DataFrame:
    return tiling.subset_model(A.names(spark, d), A.cameras(spark, d), _members(spark, d))[0].select("tile", "name", "camera_id")


@query(with_views(f"{_MEMBERS} SELECT DISTINCT tile, camera_id, f FROM members JOIN names USING (name) JOIN cameras USING (camera_id)", "names", "cameras"))
def tile_subset_cameras(spark: SparkSession, d: str) -> DataFrame:
    used = tiling.subset_model(A.names(spark, d), A.cameras(spark, d), _members(spark, d))[1]
    return used.select("tile", "camera_id", F.col("params")[0].alias("f"))


@query(with_views(f"{_MEMBERS} SELECT tile, name, 'missing' AS side FROM members WHERE name NOT IN (SELECT name FROM names)", "names"))
def tile_subset_check(spark: SparkSession, d: str) -> DataFrame:
    """What the written subset lacks of what was asked for."""
    members = _members(spark, d)
    got = tiling.subset_model(A.names(spark, d), A.cameras(spark, d), members)[0].select("tile", "name")
    return tiling.unequal(got, members)


def _members(spark: SparkSession, d: str) -> DataFrame:
    o = A.table(spark, d, "orders")
    return o.select((F.col("o_orderkey") % 7).alias("tile"), F.concat(F.lit("img_"), F.col("o_custkey").cast("string")).alias("name"))


@query("SELECT c_custkey AS k, coalesce(CASE WHEN c_custkey % 3 = 0 THEN 'EPSG:4326' END, CASE c_custkey % 5 WHEN 0 THEN 'EPSG:2056' WHEN 1 THEN 'EPSG:25832' WHEN 2 THEN 'EPSG:27700' END) AS crs FROM customer")
def reference_systems(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    preset = F.get(F.array(*map(F.lit, ("swiss-lv95", "etrs89-utm32n", "british-ng", "none", "elsewhere"))), (k % 5).cast("int"))
    return A.table(spark, d, "customer").select(k.alias("k"), stats.reference_system(F.when(k % 3 == 0, "EPSG:4326"), preset).alias("crs"))


@query(
    """WITH g AS (SELECT c_custkey AS run, CASE c_custkey % 3 WHEN 0 THEN 'drone' WHEN 1 THEN 'object' ELSE 'none' END AS profile, CASE WHEN c_custkey % 4 = 0 THEN 'spatial' WHEN c_custkey % 4 = 1 THEN 'vocab_tree' END AS matcher, c_custkey * 7919 % 1000 > 150 AS big FROM customer),
o AS (SELECT run, profile, matcher, big, unnest(['matcher', 'mapper', 'level']) AS option FROM g),
v AS (SELECT run, option, CASE WHEN option = 'matcher' THEN matcher END AS explicit, CASE profile || ' ' || option WHEN 'drone matcher' THEN 'spatial' WHEN 'drone level' THEN '1' WHEN 'object matcher' THEN 'exhaustive' WHEN 'object level' THEN '0' END AS by_profile, CASE WHEN big AND option = 'matcher' THEN 'vocab_tree' END AS by_size, CASE option WHEN 'matcher' THEN 'exhaustive' WHEN 'mapper' THEN 'incremental' ELSE '2' END AS by_default FROM o)
SELECT run, option, coalesce(explicit, by_profile, by_size, by_default) AS value, CASE WHEN explicit IS NOT NULL THEN 'given' WHEN by_profile IS NOT NULL THEN 'profile' WHEN by_size IS NOT NULL THEN 'size' ELSE 'default' END AS origin FROM v"""
)
def resolved_options(spark: SparkSession, d: str) -> DataFrame:
    k, c = F.col("c_custkey"), A.table(spark, d, "customer")
    profile = F.get(F.array(*map(F.lit, ("drone", "object", "none"))), (k % 3).cast("int"))
    value = F.when(k % 4 == 0, "spatial").when(k % 4 == 1, "vocab_tree")
    given = c.select(k.alias("run"), profile.alias("profile"), F.when(value.isNotNull(), "matcher").alias("option"), value.alias("value"))
    raised = c.filter(k * 7919 % 1000 > 150).select(k.alias("run"), F.lit("matcher").alias("option"), F.lit("vocab_tree").alias("value"))
    profiles = spark.createDataFrame([("drone", "matcher", "spatial"), ("drone", "level", "1"), ("object", "matcher", "exhaustive"), ("object", "level", "0")], "profile string, option string, value string")
    return stats.resolved_options({"matcher": "exhaustive", "mapper": "incremental", "level": "2"}, profiles, given, raised)


@query("SELECT c_custkey AS k, CASE WHEN c_custkey % 3 > 0 AND c_custkey % 4 < 2 AND c_custkey % 5 > 0 THEN CASE c_custkey % 3 WHEN 1 THEN 'on' ELSE 'auto' END ELSE 'off' END AS adjustment FROM customer")
def control_in_adjustment(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    pick = lambda n, *names: F.get(F.array(*map(F.lit, names)), (k % n).cast("int"))
    return A.table(spark, d, "customer").select(k.alias("k"), stats.bundle_adjustment(pick(3, "off", "on", "auto"), pick(4, "auto", "gcp", "exif", "none"), k % 5 > 0).alias("adjustment"))


@query(f"SELECT c_custkey AS k, coalesce(CASE WHEN c_custkey % 4 > 0 THEN CAST(c_custkey % 100 AS DOUBLE) / 4 END > CAST(c_custkey % 20 AS DOUBLE), false) AS refused, {L(1)} AS one FROM customer")
def frame_refusals(spark: SparkSession, d: str) -> DataFrame:
    from geokernel.operators import georef

    k = F.col("c_custkey")
    refused = georef.frame_refusal(F.when(k % 4 > 0, k % 100 / F.lit(4.0)), (k % 20).cast("double"))
    return A.table(spark, d, "customer").select(k.alias("k"), refused.alias("refused"), F.lit(1).cast("long").alias("one"))


@query()
def surface_samples(spark: SparkSession, d: str) -> DataFrame:
    """About four points on each triangle of average size. Triangles are gathered once for their
    number, their area and their points."""
    from geokernel.operators import mesh

    tri = written(mesh.triangles(A.vertices(spark, d), A.faces(spark, d)).drop("v0", "v1", "v2"), "triangles")
    return imagery.surface_samples(tri, 4 * tri.count())
