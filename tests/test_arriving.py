from pyspark.sql import functions as F

from geokernel.plans import streams


def test_rows_of_a_key_arrive_in_one_file_of_a_part(spark, monkeypatch):
    monkeypatch.setattr(streams, "FILE_ROWS", 100, raising=False)
    rows = spark.range(1200).repartition(5).select((F.col("id") % 40).alias("pt"), F.col("id").alias("image"))
    read = []
    path = streams.shared_path
    monkeypatch.setattr(streams, "shared_path", lambda *a: read.append(path(*a)) or read[-1])
    streams._arriving([rows.filter(F.col("image") % 3 == k) for k in range(3)], "pt")
    files = spark.read.parquet(read[0]).select("pt", F.col("_metadata.file_path").alias("file"))
    assert files.count() == 1200 and files.select("file").distinct().count() > 3
    # 40 keys in each of 3 parts
    assert files.distinct().count() == 120
