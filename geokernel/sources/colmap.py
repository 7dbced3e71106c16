"""Sparse reconstruction models in their public text and binary forms."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CAMERAS = "camera_id int, model string, width bigint, height bigint, params array<double>"
IMAGES = "image_id bigint, q array<double>, t array<double>, camera_id int, name string, obs array<struct<u:double,v:double,pid:bigint>>"
POINTS = "pid bigint, x double, y double, z double"
#: The binary format's codes of the models without distortion, and their sizes.
BINARY_MODELS = {0: ("SIMPLE_PINHOLE", 3), 1: ("PINHOLE", 4)}


def _fields(spark: SparkSession, path: str, least: int) -> DataFrame:
    """Lines split at white space, without comments, blank and short lines."""
    lines = spark.read.text(path).filter(~F.col("value").startswith("#"))
    return lines.select(F.split(F.trim("value"), r"\s+").alias("f")).filter(F.size("f") >= least)


def cameras_text(spark: SparkSession, path: str) -> DataFrame:
    f = F.col("f")
    params = F.transform(F.slice(f, 5, F.size(f)), lambda x: x.cast("double"))
    return _fields(spark, path, 5).select(f[0].cast("int").alias("camera_id"), f[1].alias("model"), f[2].cast("bigint").alias("width"), f[3].cast("bigint").alias("height"), params.alias("params"))


def points_text(spark: SparkSession, path: str) -> DataFrame:
    f = F.col("f")
    return _fields(spark, path, 4).select(f[0].cast("bigint").alias("pid"), *[f[i + 1].cast("double").alias(a) for i, a in enumerate("xyz")])


def images_text(spark: SparkSession, path: str) -> DataFrame:
    """Two lines an image; the second may be empty and still counts. Comments do not. Files are
    read whole, one a task, as a record's lines cannot be told apart by themselves."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for text in batch["value"]:
                lines = [x for x in text.split("\n") if not x.startswith("#")]
                while lines and not lines[0].strip():
                    lines.pop(0)
                rows = []
                for head, tail in zip(lines[0::2], [*lines[1::2], ""], strict=False):
                    f = head.split()
                    if len(f) < 10:
                        continue
                    o = tail.split()
                    obs = [{"u": float(o[i]), "v": float(o[i + 1]), "pid": int(o[i + 2])} for i in range(0, len(o) - 2, 3) if int(o[i + 2]) != -1]
                    rows.append((int(f[0]), [float(x) for x in f[1:5]], [float(x) for x in f[5:8]], int(f[8]), " ".join(f[9:]), obs))
                yield pd.DataFrame(rows, columns=["image_id", "q", "t", "camera_id", "name", "obs"])

    return spark.read.text(path, wholetext=True).mapInPandas(parse, IMAGES)


def _binary(spark: SparkSession, path: str, records, schema: str) -> DataFrame:
    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                columns = [c.split()[0] for c in schema.replace("array<struct<u:double,v:double,pid:bigint>>", "array").split(", ")]
                yield pd.DataFrame(list(records(bytes(content))), columns=columns)

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(parse, schema)


def cameras_binary(spark: SparkSession, path: str) -> DataFrame:
    def records(raw: bytes):
        (n,), at = struct.unpack_from("<Q", raw), 8
        for _ in range(n):
            camera_id, code, width, height = struct.unpack_from("<iiQQ", raw, at)
            if code not in BINARY_MODELS:
                raise ValueError(f"camera model {code} of the binary format is not supported")
            model, size = BINARY_MODELS[code]
            yield camera_id, model, width, height, list(struct.unpack_from(f"<{size}d", raw, at + 24))
            at += 24 + 8 * size

    return _binary(spark, path, records, CAMERAS)


def images_binary(spark: SparkSession, path: str) -> DataFrame:
    def records(raw: bytes):
        (n,), at = struct.unpack_from("<Q", raw), 8
        for _ in range(n):
            head = struct.unpack_from("<I7dI", raw, at)
            start = at + 64
            end = raw.index(b"\0", start)
            (m,) = struct.unpack_from("<Q", raw, end + 1)
            at = end + 9
            obs = [dict(zip(("u", "v", "pid"), struct.unpack_from("<ddq", raw, at + 24 * i), strict=True)) for i in range(m)]
            at += 24 * m
            yield head[0], list(head[1:5]), list(head[5:8]), head[8], raw[start:end].decode(), [o for o in obs if o["pid"] != -1]

    return _binary(spark, path, records, IMAGES)


def points_binary(spark: SparkSession, path: str) -> DataFrame:
    def records(raw: bytes):
        (n,), at = struct.unpack_from("<Q", raw), 8
        for _ in range(n):
            pid, x, y, z = struct.unpack_from("<Q3d", raw, at)
            (track,) = struct.unpack_from("<Q", raw, at + 43)
            yield pid, x, y, z
            at += 51 + 8 * track

    return _binary(spark, path, records, POINTS)


def observations(images: DataFrame) -> DataFrame:
    """(image, u, v, pid): the keypoints that belong to a point."""
    return images.select(F.col("name").alias("image"), F.inline("obs"))


def centres(images: DataFrame) -> DataFrame:
    """(name, x, y, z) of the cameras."""
    from geokernel.functions import scalar as S

    r = S.quat_to_rot(*[F.col("q")[i] for i in range(4)])
    c = S.camera_centre([F.col("r")[i] for i in range(9)], tuple(F.col("t")[i] for i in range(3)))
    return images.select("name", "t", r.alias("r")).select("name", *[v.alias(a) for v, a in zip(c, "xyz", strict=True)])
