import numpy as np
from pyspark.sql import functions as F

from geokernel.operators import texture


def test_images_are_never_sent_through_the_driver(spark):
    """A column of binary counts as a hundred bytes, so a table of images looks small enough to broadcast."""
    image = b"P6\n4 3\n255\n" + bytes(range(36))
    images = spark.range(8).select(F.col("id").alias("view"), F.lit(image).alias("content"))
    places = spark.range(40).select((F.col("id") % 8).alias("view"), F.col("id").alias("fid"), F.lit(1.0).alias("u"), F.lit(1.0).alias("v"))
    found = texture.sampled(places, images)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    rows = found.collect()
    want = np.frombuffer(image[-36:], np.uint8).reshape(3, 4, 3)[1, 1]
    assert sorted(r["fid"] for r in rows) == list(range(40))
    assert {(r["red"], r["green"], r["blue"]) for r in rows} == {tuple(float(x) for x in want)}
