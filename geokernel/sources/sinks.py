"""Exports: camera and shot documents, coordinate notes, tiled clouds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geokernel.functions import scalar as S


def camera_documents(cameras: DataFrame) -> DataFrame:
    """(key, document): intrinsics as shares of the longer side, as JSON."""
    p = S.intrinsics(F.col("model"), F.col("params"))
    size = F.greatest("width", "height").cast("double")
    kind = F.when(F.col("model").isin("OPENCV", "FULL_OPENCV"), "brown").when(F.col("model") == "OPENCV_FISHEYE", "fisheye").otherwise("perspective")
    named = cameras.withColumn("p", p).withColumn("size", size)
    middle = lambda c, s: ((F.col(f"p.{c}") - F.col(s) / 2.0) / F.col("size")).alias(f"c_{c[-1]}")
    body = F.struct(kind.alias("projection_type"), "width", "height", (F.col("p.fx") / F.col("size")).alias("focal_x"), (F.col("p.fy") / F.col("size")).alias("focal_y"), middle("cx", "width"), middle("cy", "height"), F.col("p.dist").alias("distortion"))
    return named.select(F.concat_ws(" ", F.lower("model"), "width", "height", "camera_id").alias("key"), F.to_json(body).alias("document"))


def shot_documents(shots: DataFrame) -> DataFrame:
    """(name, document): GeoJSON points of shots (name, lon, lat, z, r)."""
    turn = F.struct(*[v.alias(f"r{a}") for v, a in zip(S.rot_to_axis_angle([F.col("r")[i] for i in range(9)]), "xyz", strict=True)])
    body = F.struct(F.lit("Feature").alias("type"), F.struct(F.lit("Point").alias("type"), F.array("lon", "lat", "z").alias("coordinates")).alias("geometry"), F.struct(F.col("name").alias("filename"), turn.alias("rotation")).alias("properties"))
    return shots.select("name", F.to_json(body).alias("document"))


def coordinate_note(epsg: Column, east: Column, north: Column) -> Column:
    """Two lines: the reference system and the whole-metre offset."""
    return F.format_string("%s\n%.0f %.0f", S.utm_text(epsg), east, north)


def write_cloud(cloud: DataFrame, path: str, tile: float = 256.0) -> None:
    """Millimetre coordinates as Parquet, one folder a square tile, rows of a tile together."""
    rounded = cloud.withColumns({a: F.round(a, 3) for a in "xyz"})
    tiled = rounded.withColumns({"tile_x": F.floor(F.col("x") / tile).cast("long"), "tile_y": F.floor(F.col("y") / tile).cast("long")})
    spread = F.pmod(F.xxhash64("x", "y", "z"), F.lit(8))  # a full tile is several files, not one task
    tiled.repartition("tile_x", "tile_y", spread).write.mode("overwrite").partitionBy("tile_x", "tile_y").parquet(path)
