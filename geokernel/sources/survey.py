"""Ground-control lists, check-point tables, textured meshes, rasters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, value) in file order: blocks by their place in the file, lines by their place in
    the block, whatever partitions the blocks went to."""
    text = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n"), "value")
    return text.select(F.struct("file", "block", "n").alias("line"), F.rtrim("value").alias("value"))


def control_points(spark: SparkSession, path: str) -> DataFrame:
    """(line, wx, wy, wz, u, v, image, label, is_check) of a list whose first line is the CRS.

    Lines of fewer than six fields are left out. A row is a check row if its last field says so;
    the label is the first further field of the form m<id>_c<k>."""
    lines = _lines(spark, path)
    first = lines.agg(F.min("line").alias("line"))
    f = F.col("f")
    rows = lines.join(first, "line", "left_anti").filter(~F.col("value").startswith("#"))
    rows = rows.select("line", F.split(F.trim("value"), r"\s+").alias("f")).filter(F.size("f") >= 6)
    extra = F.slice(f, 7, F.size(f))
    numbers = [f[i].try_cast("double").alias(n) for i, n in enumerate(("wx", "wy", "wz", "u", "v"))]
    label = F.get(F.filter(extra, lambda x: x.rlike(r"^m[0-9]+_c[0-9]+$")), 0)
    check = (F.size(f) > 6) & (F.lower(F.element_at(f, -1)) == "check")
    return rows.select("line", *numbers, f[5].alias("image"), label.alias("label"), check.alias("is_check"))


def grouped_control(points: DataFrame) -> DataFrame:
    """Markings by their world coordinate, rounded half to even at four decimals; the label is
    that of the first line."""
    key = [F.bround(c, 4).alias(c) for c in ("wx", "wy", "wz")]
    return points.groupBy(*key).agg(F.count("*").alias("n"), F.min_by("label", "line").alias("label"), F.max("is_check").alias("is_check"))


def check_pairs(spark: SparkSession, path: str) -> DataFrame:
    """(wx, wy, wz, mx, my, mz) of lines of six numbers, an id in front allowed; fewer numbers
    are left out, more are an error."""
    f = F.filter(F.transform(F.split("value", r"[;,]"), lambda x: F.trim(x).try_cast("double")), lambda x: x.isNotNull())
    first_is_id = F.trim(F.split("value", r"[;,]")[0]).try_cast("double").isNull()
    rows = spark.read.text(path).select(f.alias("f"), first_is_id.alias("named"), "value").filter(F.size("f") >= 6)
    bad = F.when(F.size("f") > 6, F.raise_error(F.concat(F.lit("more than six numbers: "), "value")).cast("double"))
    return rows.select(*[F.coalesce(bad, F.col("f")[i]).alias(n) for i, n in enumerate(("wx", "wy", "wz", "mx", "my", "mz"))])


def textured_mesh(spark: SparkSession, path: str, triangles_only: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(vertices, texture places, faces) of an OBJ file; polygons become fans of triangles (with
    triangles_only they are left out), negative indices count from the end of what stands before,
    materials carry forward."""
    from geokernel.operators.stats import numbered

    lines = _lines(spark, path).select("line", F.split(F.trim("value"), r"\s+").alias("f"))
    f = F.col("f")

    def listed(tag: str, names: tuple[str, ...], number: str) -> DataFrame:
        rows = lines.filter(f[0] == tag)
        return numbered(rows, "line").select("line", F.col("ordinal").alias(number), *[f[i + 1].cast("double").alias(n) for i, n in enumerate(names)])

    vertices, places = listed("v", ("x", "y", "z"), "vid"), listed("vt", ("u", "v"), "tid")
    wanted = (f[0] == "f") & (F.size(f) == 4) if triangles_only else f[0] == "f"
    faces = numbered(lines.filter(wanted), "line")
    # What stands before a face: found by its line among the materials and, for negative
    # indices, the vertices; both are intervals of lines, joined as of the face's line.
    for name, other, value in (("material", lines.filter(f[0] == "usemtl").select("line", f[1].alias("value")), "string"), ("v_before", vertices.select("line", (F.col("vid") + 1).alias("value")), "bigint"), ("t_before", places.select("line", (F.col("tid") + 1).alias("value")), "bigint")):
        faces = _as_of(faces, other, name, value)
    corner = lambda x, k: F.get(F.split(x, "/"), k).try_cast("bigint")
    index = lambda i, before: F.when(i > 0, i - 1).when(i < 0, before + i)
    corners = F.transform(F.slice(f, 2, F.size(f) - 1), lambda x: F.struct(index(corner(x, 0), F.col("v_before")).alias("v"), index(corner(x, 1), F.col("t_before")).alias("t")))
    fans = faces.withColumn("p", corners).withColumn("i", F.explode(F.sequence(F.lit(1), F.size("p") - 2)))
    p, i = F.col("p"), F.col("i")
    pick = [F.struct(*[F.get(p, k)[c].alias(f"{c}{n}") for n, k in enumerate((F.lit(0), i, i + 1))]) for c in ("v", "t")]
    out = fans.select(F.col("ordinal").alias("polygon"), "i", "material", pick[0].alias("v"), pick[1].alias("t")).select("polygon", "i", "material", "v.*", "t.*")
    return vertices.drop("line"), places.drop("line"), out


def _as_of(rows: DataFrame, marks: DataFrame, name: str, kind: str) -> DataFrame:
    """rows with the value of the last mark before their line (null before the first)."""
    from pyspark.sql import Window

    block = F.struct("line.file", "line.block")
    both = rows.select("line", F.lit(None).cast(kind).alias("value"), F.lit(True).alias("is_row")).union(marks.select("line", F.col("value").cast(kind), F.lit(False)))
    inner = Window.partitionBy(block).orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    filled = both.withColumn("own", F.last("value", ignorenulls=True).over(inner))
    # What a block starts with is the last mark of the blocks before: one row a block.
    ends = marks.groupBy(block.alias("block")).agg(F.max_by("value", "line").cast(kind).alias("end"))
    blocks = both.select(block.alias("block")).distinct().join(ends, "block", "left")
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.withColumn("start", F.last("end", ignorenulls=True).over(before)).select("block", "start")
    out = filled.filter("is_row").withColumn("block", block).join(starts, "block").select("line", F.coalesce("own", "start").alias(name))
    return rows.join(out, "line")


def raster_points(cells: DataFrame, x0: float, y1: float, gsd: float, nodata: float = -9999.0) -> DataFrame:
    """(x, y, z) at the centres of north-up cells (r, c, v) with data."""
    return cells.filter((F.col("v") != nodata) & ~F.isnan("v")).select((x0 + (F.col("c") + 0.5) * gsd).alias("x"), (y1 - (F.col("r") + 0.5) * gsd).alias("y"), F.col("v").alias("z"))
