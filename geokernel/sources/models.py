"""Finding models and meshes in a work folder, counts from their headers, and meshes rewritten under
a similarity."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geokernel.operators.tables import remove
from geokernel.sources.survey import _lines

#: Where a model may lie, and the names that a mesh may have, first come first.
MODEL_FOLDERS = ("sparse/0", "sparse")
MESHES = ("scene_dense_mesh_refine_texture.obj", "scene_dense_mesh_texture.obj", "scene_dense_mesh_refine.obj", "scene_dense_mesh.obj")
#: Bytes that hold the header of a point file.
HEADER_BYTES = 1 << 16


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def find_model(spark: SparkSession, work: str) -> str | None:
    """The first of the model folders below the work folder that has text images, or None."""
    found = (f"{work.rstrip('/')}/{folder}" for folder in MODEL_FOLDERS)
    return next((path for path in found if _exists(spark, f"{path}/images.txt")), None)


def find_mesh(spark: SparkSession, work: str) -> str | None:
    """The first mesh of a work folder in the order of MESHES, or None."""
    found = (f"{work.rstrip('/')}/{name}" for name in MESHES)
    return next((path for path in found if _exists(spark, path)), None)


def point_counts(spark: SparkSession, path: str) -> DataFrame:
    """(path, vertices) that the headers of PLY files tell; null where a header tells none."""
    files = spark.read.format("binaryFile").load(path)
    header = F.element_at(F.split(F.decode(F.substring("content", 1, HEADER_BYTES), "ISO-8859-1"), "(?m)^end_header"), 1)
    return files.select("path", F.regexp_extract(header, r"(?m)^element vertex[ \t]+(\d+)", 1).try_cast("long").alias("vertices"))


def mesh_counts(spark: SparkSession, path: str) -> DataFrame:
    """One row (vertices, faces): the lines of an OBJ file that begin with v and f."""
    return spark.read.text(path).agg(F.count_if(F.col("value").startswith("v ")).alias("vertices"), F.count_if(F.col("value").startswith("f ")).alias("faces"))


def rewritten_lines(spark: SparkSession, path: str, s: float, r: np.ndarray, t: np.ndarray, offset: np.ndarray) -> DataFrame:
    """(line, value): the lines of an OBJ file in order, with s R v + t - offset for its vertices, at
    six decimals. Other lines stay as they are."""
    f = F.split(F.trim("value"), r"\s+")
    v = [F.get(f, k + 1).try_cast("double") for k in range(3)]
    moved = [s * sum((float(r[i][k]) * v[k] for k in range(3)), F.lit(0.0)) + float(t[i]) - float(offset[i]) for i in range(3)]
    new = F.format_string("v %.6f %.6f %.6f", *[m + 0.0 for m in moved])
    return _lines(spark, path).select("line", F.when(F.col("value").startswith("v "), new).otherwise(F.col("value")).alias("value"))


def rewrite_mesh(spark: SparkSession, path: str, s: float, r: np.ndarray, t: np.ndarray, offset: np.ndarray) -> None:
    """Puts the mesh under a similarity in the place of an OBJ file: a folder of that name whose
    parts, one after the other, are its lines. The old file goes once the new one is whole."""
    lines = rewritten_lines(spark, path, s, r, t, offset)
    lines.repartitionByRange("line").sortWithinPartitions("line").select("value").write.mode("overwrite").text(f"{path}.new")
    remove(spark, path)
    place = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p)
    place(path).getFileSystem(spark._jsc.hadoopConfiguration()).rename(place(f"{path}.new"), place(path))
