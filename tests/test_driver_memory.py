"""Tables that grow with the input are never sent through the driver, however small they look."""

from pyspark.sql import functions as F

from geokernel.operators import merging, mesh, neighbours


def broadcasts(df):
    return "Broadcast" in df._jdf.queryExecution().executedPlan().toString()


def lattice(spark):
    n = spark.range(60)
    vertices = n.select(F.col("id").alias("vid"), (F.col("id") % 6).cast("double").alias("x"), F.floor(F.col("id") / 6).cast("double").alias("y"), F.lit(0.0).alias("z"))
    faces = n.filter("id < 50 AND id % 6 < 5").select(F.col("id").alias("fid"), F.col("id").alias("v0"), (F.col("id") + 1).alias("v1"), (F.col("id") + 6).alias("v2"))
    return vertices, faces


def test_corners_and_tiles_are_shuffled(spark):
    vertices, faces = lattice(spark)
    assert not broadcasts(mesh.triangles(vertices, faces))
    tile = lambda df: df.withColumn("tile", F.lit(0).cast("long"))
    bounds = spark.range(1).select(F.col("id").alias("tile"), *[F.lit(v).alias(n) for n, v in (("x0", 0.0), ("y0", 0.0), ("x1", 9.0), ("y1", 9.0))])
    pages = spark.range(1).select(F.col("id").alias("tile"), F.col("id").alias("slot"), F.lit("p").alias("page"))
    plan = merging.kept_faces(tile(vertices), tile(faces).withColumn("slot", F.lit(0).cast("long")), bounds, pages)
    assert "BroadcastExchange HashedRelationBroadcastMode(List(input[0, bigint, false], input[1, bigint" not in plan._jdf.queryExecution().executedPlan().toString()


def test_points_of_cells_are_shuffled(spark):
    vertices, _ = lattice(spark)
    points = vertices.withColumnRenamed("vid", "id")
    assert not broadcasts(neighbours._candidates(points, points, ("x", "y", "z"), ("x", "y", "z"), 1.0, 3, True, (), True))
    assert not broadcasts(neighbours.roughness(points, k=3))
