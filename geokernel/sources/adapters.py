"""The tables at hand seen as clouds, cameras, observations, rasters, meshes and markings.

Every coordinate is a multiple of 1/1024, so sums and maxima are exact in any order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geokernel.operators.tables import dealt


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hashed_xy(k: Column, mx: int = 12800, my: int = 12799) -> tuple[Column, Column]:
    return (k * 7919 % mx) / F.lit(128.0), (k * 104729 % my) / F.lit(128.0)


def cloud_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    x, y = hashed_xy(F.col("o_orderkey"))
    cls = F.get(F.array(*map(F.lit, (2, 3, 4, 5, 6, 64, 7))), (F.col("o_custkey") % 7).cast("int"))
    return o.select(F.col("o_orderkey").alias("pid"), x.alias("x"), y.alias("y"), (F.floor("o_totalprice") % 640 / F.lit(128.0)).alias("z"), cls.alias("cls"))


def cloud_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = cloud_a(spark, sf_dir)
    dug = F.col("x").between(35, 64.9999999) & F.col("y").between(35, 64.9999999)
    z = F.col("z") + 1 / 32 + (F.col("pid") * 31 % 64) / F.lit(1024.0) - F.when(dug, 0.5).otherwise(0.0)
    return a.select("pid", (F.col("x") + 1 / 32).alias("x"), (F.col("y") - 1 / 64).alias("y"), z.alias("z"), "cls")


def centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    x, y = hashed_xy(F.col("c_custkey"))
    return c.select(F.concat(F.lit("img_"), F.col("c_custkey").cast("string")).alias("name"), x.alias("x"), y.alias("y"))


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select("event_id", F.col("user_id").alias("image"), (F.col("event_id") % 500).alias("pt"), (F.floor(F.col("value") * 4) % 1024 / F.lit(128.0)).alias("logc"))


def raster(spark: SparkSession, sf_dir: str, odd: int | None = None) -> DataFrame:
    """Cells (r, c, v) of all events, or those of even or odd users: day by hour, largest value."""
    e = table(spark, sf_dir, "events")
    e = e if odd is None else e.filter(F.col("user_id") % 2 == odd)
    return e.groupBy((F.dayofmonth("ts") - 1).cast("long").alias("r"), F.hour("ts").cast("long").alias("c")).agg(F.max(F.floor(F.col("value") * 128) / F.lit(128.0)).alias("v"))


def vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    vid = F.col("p_partkey")
    return p.select(vid.alias("vid"), (vid % 20).cast("double").alias("x"), ((vid - vid % 20) / 20).cast("double").alias("y"), (F.col("p_size") % 16 / F.lit(8.0)).alias("z"))


def faces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(fid, v0, v1, v2): two triangles for each cell of the lattice whose corners exist."""
    v = vertices(spark, sf_dir).select("vid")
    cells = v.filter(F.col("vid") % 20 < 19)
    cells = cells.join(dealt(v.select((F.col("vid") - 21).alias("vid"))), "vid", "left_semi")
    a = F.struct((2 * F.col("vid")).alias("fid"), F.col("vid").alias("v0"), (F.col("vid") + 1).alias("v1"), (F.col("vid") + 20).alias("v2"))
    b = F.struct((2 * F.col("vid") + 1).alias("fid"), (F.col("vid") + 1).alias("v0"), (F.col("vid") + 21).alias("v1"), (F.col("vid") + 20).alias("v2"))
    return cells.select(F.inline(F.array(a, b)))


def markings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ground-control rows: local and world coordinates (a scaled quarter turn and a shift, with
    small errors), marker label, check flag."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    x, y = hashed_xy(k, 1024, 1024)
    rows = s.select(k.alias("rid"), F.concat(F.lit("m"), (k - k % 4).cast("string"), F.lit("_c"), (k % 4).cast("string")).alias("label"), x.alias("lx"), y.alias("ly"), (k * 31 % 64 / F.lit(128.0)).alias("lz"), (k % 5 == 0).alias("is_check"))
    k = F.col("rid")
    return rows.withColumns({"wx": -2.0 * F.col("ly") + 100.0 + (k * 17 % 16) / F.lit(1024.0), "wy": 2.0 * F.col("lx") + 200.0 - (k * 13 % 16) / F.lit(1024.0), "wz": 2.0 * F.col("lz") + 30.0 + (k * 11 % 8) / F.lit(1024.0)})


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pid, r, g, b, alpha): three columns of lineitem as 0..255 channels."""
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", (F.floor("l_extendedprice") % 256).cast("long").alias("r"), (F.floor(F.col("l_quantity")) * 5 % 256).cast("long").alias("g"), (F.col("l_partkey") % 256).alias("b"))


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(name, camera_id): images of customers, every third in a folder."""
    c = table(spark, sf_dir, "customer")
    image = F.concat(F.when(F.col("c_custkey") % 3 == 0, "flight/img_").otherwise("img_"), F.col("c_custkey").cast("string"))
    return c.select(image.alias("name"), F.col("c_nationkey").alias("camera_id"))


def cameras(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(camera_id, model, width, height, params) of nations, with one focal length."""
    k = F.col("n_nationkey")
    params = F.array((3000 + 10 * k).cast("double"), F.lit(2000.0), F.lit(1500.0), k / F.lit(1024.0))
    return table(spark, sf_dir, "nation").select(k.alias("camera_id"), F.lit("SIMPLE_RADIAL").alias("model"), F.lit(4000).cast("long").alias("width"), F.lit(3000).cast("long").alias("height"), params.alias("params"))


def marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(rid, image, u, v): marked pixels of orders; some images are known by their last part
    alone, some not at all."""
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    folder = F.get(F.array(F.lit("img_"), F.lit("other/img_"), F.lit("flight/img_"), F.lit("img-")), (k % 4).cast("int"))
    return o.select(k.alias("rid"), F.concat(folder, F.col("o_custkey").cast("string")).alias("image"), (k * 7919 % 4000).cast("double").alias("u"), (k * 104729 % 3000).cast("double").alias("v"))


def keypoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(image, ordinal, u, v, pid): observed points of line items, in the order of their number."""
    li, k = table(spark, sf_dir, "lineitem"), F.col("l_orderkey") * 8 + F.col("l_linenumber")
    image = F.concat(F.when(F.col("l_suppkey") % 3 == 0, "flight/img_").otherwise("img_"), F.col("l_suppkey").cast("string"))
    return li.select(image.alias("image"), k.alias("ordinal"), (k * 31 % 4000).cast("double").alias("u"), (k * 17 % 3000).cast("double").alias("v"), F.col("l_partkey").alias("pid"))


def site(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Markings, images and cameras of a planted scene: each control point of markings() as
    three cameras that look straight down from 40 see it, through a lens with distortion."""
    from geokernel.functions import scalar as S

    c = table(spark, sf_dir, "customer")
    first, n = c.agg(F.min("c_custkey"), F.count("*")).first()
    x, y = hashed_xy(F.col("c_custkey"))
    name = F.concat(F.lit("img_"), F.col("c_custkey").cast("string"))
    # A half turn about x takes world to camera; t = -R C.
    images = c.select(F.col("c_custkey").alias("k"), name.alias("name"), F.array(*map(F.lit, (0.0, 1.0, 0.0, 0.0))).alias("q"), F.array(-x, y, F.lit(40.0)).alias("t"), F.col("c_nationkey").alias("camera_id"))
    lens = cameras(spark, sf_dir)
    seen = markings(spark, sf_dir).withColumn("i", F.explode(F.array(*map(F.lit, (0, 1, 2))))).withColumn("k", (F.col("rid") * 3 + F.col("i")) % n + first)
    seen = seen.join(images, "k").join(lens, "camera_id")
    z = 40.0 - F.col("lz")
    px, py = (F.col("lx") + F.col("t")[0]) / z, (F.col("t")[1] - F.col("ly")) / z
    k = S.intrinsics(F.col("model"), F.col("params"))
    bent = S.distort(F.col("model"), k["dist"], px, py)
    marked = seen.select((F.col("rid") * 4 + F.col("i")).alias("line"), "wx", "wy", "wz", (k["fx"] * bent["x"] + k["cx"]).alias("u"), (k["fy"] * bent["y"] + k["cy"]).alias("v"), F.concat(F.lit("raw/"), F.col("name")).alias("image"), "label")
    return marked, images.drop("k"), lens


def image(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels (r, c, red, green, blue, alpha) over the cells of the raster of all events, every
    ninth without data."""
    v = raster(spark, sf_dir).select("r", "c", (F.col("v") * 8).alias("v"))
    band = lambda k: (F.floor(F.col("v") * k) % 256).cast("int")
    return v.select("r", "c", band(1).alias("red"), band(2).alias("green"), band(3).alias("blue"), F.when((F.col("r") * 24 + F.col("c")) % 9 == 0, 0).otherwise(255).alias("alpha"))


def fixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(name, lat, lon, alt): position fixes of the customers whose number is no multiple of 4,
    around 37 E 48 N."""
    k = F.col("c_custkey")
    c = table(spark, sf_dir, "customer").filter(k % 4 > 0)
    return c.select(F.concat(F.lit("img_"), k.cast("string")).alias("name"), (48 + k * 7919 % 1000 / F.lit(1024.0)).alias("lat"), (37 + k * 104729 % 1000 / F.lit(1024.0)).alias("lon"), (k % 64 / F.lit(8.0)).alias("alt"))


def colours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(image, pt, red, green, blue, x, y): sampled colours of line items. Images of suppliers have
    many, those of runs of orders some, those of single orders few."""
    li, o = table(spark, sf_dir, "lineitem"), F.col("l_orderkey")
    k = o * 8 + F.col("l_linenumber")
    image = F.when(o % 8 == 0, -1 - F.floor(o / 128)).when(o % 64 == 1, -1_000_000_000 - o).otherwise(F.col("l_suppkey")).cast("long")
    price = F.floor("l_extendedprice")
    band = lambda n: (20 + price * n % 200).cast("double")
    return li.select(image.alias("image"), F.col("l_partkey").alias("pt"), band(1).alias("red"), band(3).alias("green"), band(7).alias("blue"), ((k * 31 % 2048 - 1024) / F.lit(1024.0)).alias("x"), ((k * 17 % 2048 - 1024) / F.lit(1024.0)).alias("y"))


#: The same views for the SQL engine, as common table expressions.
SQL = {
    "cloud_a": """cloud_a AS (SELECT o_orderkey AS pid, CAST(o_orderkey * 7919 % 12800 AS DOUBLE) / 128 AS x, CAST(o_orderkey * 104729 % 12799 AS DOUBLE) / 128 AS y,
  CAST(CAST(floor(o_totalprice) AS BIGINT) % 640 AS DOUBLE) / 128 AS z, CASE o_custkey % 7 WHEN 0 THEN 2 WHEN 1 THEN 3 WHEN 2 THEN 4 WHEN 3 THEN 5 WHEN 4 THEN 6 WHEN 5 THEN 64 ELSE 7 END AS cls FROM orders)""",
    "cloud_b": """cloud_b AS (SELECT pid, x + CAST(1 AS DOUBLE) / 32 AS x, y - CAST(1 AS DOUBLE) / 64 AS y, z + CAST(1 AS DOUBLE) / 32 + CAST(pid * 31 % 64 AS DOUBLE) / 1024
  - CASE WHEN x >= 35 AND x < 65 AND y >= 35 AND y < 65 THEN CAST(0.5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS z, cls FROM cloud_a)""",
    "centres": "centres AS (SELECT 'img_' || c_custkey AS name, CAST(c_custkey * 7919 % 12800 AS DOUBLE) / 128 AS x, CAST(c_custkey * 104729 % 12799 AS DOUBLE) / 128 AS y FROM customer)",
    "obs": "obs AS (SELECT event_id, user_id AS image, event_id % 500 AS pt, CAST(CAST(floor(value * 4) AS BIGINT) % 1024 AS DOUBLE) / 128 AS logc FROM events)",
    "rast_a": "rast_a AS (SELECT CAST(day(ts) - 1 AS BIGINT) AS r, CAST(hour(ts) AS BIGINT) AS c, max(floor(value * 128) / CAST(128 AS DOUBLE)) AS v FROM events WHERE user_id % 2 = 0 GROUP BY 1, 2)",
    "rast_b": "rast_b AS (SELECT CAST(day(ts) - 1 AS BIGINT) AS r, CAST(hour(ts) AS BIGINT) AS c, max(floor(value * 128) / CAST(128 AS DOUBLE)) AS v FROM events WHERE user_id % 2 = 1 GROUP BY 1, 2)",
    "vertices": "vertices AS (SELECT p_partkey AS vid, CAST(p_partkey % 20 AS DOUBLE) AS x, CAST(p_partkey - p_partkey % 20 AS DOUBLE) / 20 AS y, CAST(p_size % 16 AS DOUBLE) / 8 AS z FROM part)",
    "faces": """faces AS (SELECT 2 * vid AS fid, vid AS v0, vid + 1 AS v1, vid + 20 AS v2 FROM vertices WHERE vid % 20 < 19 AND vid + 21 IN (SELECT vid FROM vertices)
  UNION ALL SELECT 2 * vid + 1, vid + 1, vid + 21, vid + 20 FROM vertices WHERE vid % 20 < 19 AND vid + 21 IN (SELECT vid FROM vertices))""",
    "triangles": """triangles AS (SELECT fid, v0, v1, v2, a.x AS x0, a.y AS y0, a.z AS z0, b.x AS x1, b.y AS y1, b.z AS z1, c.x AS x2, c.y AS y2, c.z AS z2
  FROM faces JOIN vertices a ON v0 = a.vid JOIN vertices b ON v1 = b.vid JOIN vertices c ON v2 = c.vid)""",
    "gcp": """gcp AS (SELECT rid, label, is_check, lx, ly, lz, -2 * ly + 100 + CAST(rid * 17 % 16 AS DOUBLE) / 1024 AS wx, 2 * lx + 200 - CAST(rid * 13 % 16 AS DOUBLE) / 1024 AS wy, 2 * lz + 30 + CAST(rid * 11 % 8 AS DOUBLE) / 1024 AS wz FROM (
  SELECT s_suppkey AS rid, 'm' || (s_suppkey - s_suppkey % 4) || '_c' || (s_suppkey % 4) AS label, s_suppkey % 5 = 0 AS is_check, CAST(s_suppkey * 7919 % 1024 AS DOUBLE) / 128 AS lx,
  CAST(s_suppkey * 104729 % 1024 AS DOUBLE) / 128 AS ly, CAST(s_suppkey * 31 % 64 AS DOUBLE) / 128 AS lz FROM supplier))""",
    "names": "names AS (SELECT CASE WHEN c_custkey % 3 = 0 THEN 'flight/img_' ELSE 'img_' END || c_custkey AS name, c_nationkey AS camera_id FROM customer)",
    "cameras": "cameras AS (SELECT n_nationkey AS camera_id, CAST(3000 + 10 * n_nationkey AS DOUBLE) AS f, CAST(n_nationkey AS DOUBLE) / 1024 AS k1 FROM nation)",
    "marks": """marks AS (SELECT o_orderkey AS rid, CASE o_orderkey % 4 WHEN 0 THEN 'img_' WHEN 1 THEN 'other/img_' WHEN 2 THEN 'flight/img_' ELSE 'img-' END || o_custkey AS image,
  CAST(o_orderkey * 7919 % 4000 AS DOUBLE) AS u, CAST(o_orderkey * 104729 % 3000 AS DOUBLE) AS v FROM orders)""",
    "named": """named AS (SELECT rid, u, v, coalesce(a.name, b.name) AS name, a.name IS NOT NULL AS exact FROM marks LEFT JOIN names a ON image = a.name
  LEFT JOIN names b ON regexp_extract(image, '([^/]*)$', 1) = b.name WHERE coalesce(a.name, b.name) IS NOT NULL)""",
    "keypoints": """keypoints AS (SELECT CASE WHEN l_suppkey % 3 = 0 THEN 'flight/img_' ELSE 'img_' END || l_suppkey AS image, ordinal, CAST(ordinal * 31 % 4000 AS DOUBLE) AS u, CAST(ordinal * 17 % 3000 AS DOUBLE) AS v, pid
  FROM (SELECT l_suppkey, l_orderkey * 8 + l_linenumber AS ordinal, l_partkey AS pid FROM lineitem))""",
    "fixes": "fixes AS (SELECT 'img_' || c_custkey AS name, 48 + CAST(c_custkey * 7919 % 1000 AS DOUBLE) / 1024 AS lat, 37 + CAST(c_custkey * 104729 % 1000 AS DOUBLE) / 1024 AS lon, CAST(c_custkey % 64 AS DOUBLE) / 8 AS alt FROM customer WHERE c_custkey % 4 > 0)",
    "image": """image AS (SELECT r, c, CAST(floor(v * 8) AS BIGINT) % 256 AS red, CAST(floor(v * 8 * 2) AS BIGINT) % 256 AS green, CAST(floor(v * 8 * 3) AS BIGINT) % 256 AS blue, CASE WHEN (r * 24 + c) % 9 = 0 THEN 0 ELSE 255 END AS alpha
  FROM (SELECT CAST(day(ts) - 1 AS BIGINT) AS r, CAST(hour(ts) AS BIGINT) AS c, max(floor(value * 128) / CAST(128 AS DOUBLE)) AS v FROM events GROUP BY 1, 2))""",
    "colours": """colours AS (SELECT CASE WHEN o % 8 = 0 THEN -1 - o // 128 WHEN o % 64 = 1 THEN -1000000000 - o ELSE l_suppkey END AS image, pt, CAST(20 + price % 200 AS DOUBLE) AS red, CAST(20 + price * 3 % 200 AS DOUBLE) AS green,
  CAST(20 + price * 7 % 200 AS DOUBLE) AS blue, CAST(k * 31 % 2048 - 1024 AS DOUBLE) / 1024 AS x, CAST(k * 17 % 2048 - 1024 AS DOUBLE) / 1024 AS y
  FROM (SELECT l_orderkey AS o, l_suppkey, l_partkey AS pt, CAST(floor(l_extendedprice) AS BIGINT) AS price, l_orderkey * 8 + l_linenumber AS k FROM lineitem))""",
    "pixels": "pixels AS (SELECT l_orderkey, CAST(floor(l_extendedprice) AS BIGINT) % 256 AS r, CAST(floor(l_quantity) AS BIGINT) * 5 % 256 AS g, l_partkey % 256 AS b FROM lineitem)",
}


def with_views(body: str, *names: str) -> str:
    """SQL over the views, which are defined in front of it. body may go on with more CTEs."""
    return "WITH " + ",\n".join(SQL[n] for n in names) + ("\n" if body.lstrip().startswith("SELECT") else ",\n") + body
